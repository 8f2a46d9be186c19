"""Mixing sources to target weights with a hierarchical budget.

Weights travel down a tree of levels, such as domain, language and source, to a token budget for
every leaf. A leaf that has too little gives the shortage to its siblings; only when a whole branch
has too little do the branch's own siblings get it. Every leaf then yields the token prefix of its
documents in a seeded order, epoch after epoch.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.session import written

Path = tuple[str | None, ...]
#: Slices of the seeded order; only the slice in which a leaf's budget ends is put in exact order.
SLICES = 1024


def word_count(text: str = "text") -> Column:
    """Words of a text: runs of anything but ASCII white space. A null text has none."""
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def budgets(supply: Mapping[Path, int], weights: Mapping[Path, float], total: float) -> dict[Path, float]:
    """Tokens for each leaf of ``supply``, which holds the most each leaf can give.

    ``weights`` gives a node's weight among its siblings by its path from the root, 1 if it is not
    named. The amount of a node is split among its children by weight; children that cannot take
    their share are filled and the rest is split again among their siblings, so what a branch as a
    whole cannot take is seen, and shared out, one level higher.
    """
    children: dict[Path, set[Path]] = defaultdict(set)
    room: dict[Path, float] = defaultdict(float)
    for leaf, most in supply.items():
        for depth in range(len(leaf) + 1):
            room[leaf[:depth]] += most
            if depth:
                children[leaf[: depth - 1]].add(leaf[:depth])

    amounts: dict[Path, float] = {}
    todo: list[tuple[Path, float]] = [((), min(total, room[()]))]
    while todo:
        node, amount = todo.pop()
        if node not in children:
            amounts[node] = amount
            continue
        open_ = {c: weights.get(c, 1.0) for c in sorted(children[node], key=lambda p: [(x is not None, x or "") for x in p])}
        if not any(open_.values()):
            open_ = dict.fromkeys(open_, 1.0)
        shares = dict.fromkeys(open_, 0.0)
        while open_ and amount > 0:
            whole = sum(open_.values())
            if not whole:  # only children of weight 0 are left
                break
            full = [c for c, w in open_.items() if amount * w / whole >= room[c] - shares[c]]
            if not full:
                for c, w in open_.items():
                    shares[c] += amount * w / whole
                break
            for c in full:
                amount -= room[c]
                shares[c] = room[c]
                del open_[c]
        todo += shares.items()
    return amounts


def mixed(
    docs: DataFrame, levels: tuple[str, ...], weights: Mapping[Path, float], share: float, epochs: int = 2,
    seed: int = 17, tokens: Column | None = None, most_leaves: int = 100_000,
) -> DataFrame:
    """The chosen rows, with all their columns and the ``epoch`` they are read in, from 0.

    ``share`` is the budget as a share of all tokens, and each leaf gives at most ``epochs`` times
    what it has. A leaf is read in an order fixed by ``seed``, the epoch, ``doc_id`` and text: whole
    epochs first, and of the next one the documents that begin before the budget is reached. A row
    chosen in two epochs comes twice. Null levels are leaves of their own; a text without tokens is
    read with its leaf's whole epochs, and in the last one if it comes before the end. Repeated
    rows are documents each. The tree must have at most ``most_leaves`` leaves. No rows give no rows.
    """
    spark = docs.sparkSession
    tokens = word_count() if tokens is None else tokens
    leaf = [F.col(c).cast("string").alias(f"_l{i}") for i, c in enumerate(levels)]
    names = [f"_l{i}" for i in range(len(levels))]
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    small = written(docs.select(*leaf, "doc_id", key.alias("_key"), tokens.alias("_tokens")), "mix")
    leaves = small.groupBy(*names).agg(F.sum("_tokens").alias("n")).limit(most_leaves + 1).collect()
    if len(leaves) > most_leaves:
        raise ValueError(f"more than {most_leaves} leaves")
    supply = {tuple(r)[:-1]: r.n for r in leaves}
    amounts = budgets({k: n * epochs for k, n in supply.items()}, weights, share * sum(supply.values()))
    plan = []
    for path, n in supply.items():
        amount = round(amounts[path])
        whole = min(epochs, amount // n) if n else 1
        plan.append((*path, whole, amount - whole * n if n else 0))
    schema = ", ".join([*(f"_p{i} string" for i in range(len(levels))), "_whole int, _rest long"])
    budget = F.broadcast(spark.createDataFrame(plan, schema))  # at most most_leaves rows

    def on_leaf(rows: DataFrame) -> Column:
        same = F.lit(True)
        for i in range(len(levels)):
            same = same & rows[f"_l{i}"].eqNullSafe(F.col(f"_p{i}"))
        return same

    # the order of the epoch in which the budget ends, and the slice of it in which it ends
    order = F.xxhash64(F.lit(seed), F.col("_whole"), F.col("doc_id"), F.col("_key"))
    part = F.shiftrightunsigned("_order", 64 - SLICES.bit_length() + 1)
    slices = (
        small.join(budget, on_leaf(small)).filter("_rest > 0").withColumn("_order", order).withColumn("_slice", part)
        .groupBy(*names, "_rest", "_slice").agg(F.sum("_tokens").alias("_n"))
    )
    upto = Window.partitionBy(*names).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    ends = slices.withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0))).filter("_before < _rest").groupBy(*names).agg(
        F.max(F.struct("_slice", "_before")).alias("_end")
    )
    cut = {tuple(r)[:-1]: tuple(r[-1]) for r in ends.collect()}  # one row a leaf
    plan = [(*row, *cut.get(tuple(row[: len(levels)]), (-1, 0))) for row in plan]
    budget = F.broadcast(spark.createDataFrame(plan, schema + ", _cut long, _before long"))

    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    rows = docs.select(row, *leaf, "doc_id", key.alias("_key"), tokens.alias("_tokens"))
    rows = rows.join(budget, on_leaf(rows)).withColumn("_order", order).withColumn("_slice", part)
    columns = [F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c != "epoch"]
    some = F.when(F.col("_slice") < F.col("_cut"), F.col("_whole")).otherwise(F.col("_whole") - 1)
    early = rows.filter(some >= 0).select("_row", F.explode(F.sequence(F.lit(0), some)).alias("epoch"))
    before = Window.partitionBy(*names).orderBy("_order", "doc_id", "_key").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        rows.filter("_slice = _cut").withColumn("_at", F.col("_before") + F.coalesce(F.sum("_tokens").over(before), F.lit(0)))
        .filter("_at < _rest").select("_row", F.col("_whole").alias("epoch"))
    )
    return early.union(last).select(*columns, "epoch")


def domain(source: str = "source") -> Column:
    """The domain of a source, for tables without one: sources are dealt to three domains by name."""
    return F.concat(F.lit("d"), (F.crc32(F.coalesce(F.col(source), F.lit("")).cast("binary")) % 3).cast("string"))


#: Target weights among siblings for tables of the form of ``documents``.
LEVELS = ("domain", "lang", "source")
WEIGHTS: dict[Path, float] = {("d0",): 3, ("d1",): 2, ("d2",): 1, **{(d, "en"): 3 for d in ("d0", "d1", "d2")}}
