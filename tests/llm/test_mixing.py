import pytest
from cases import ODD, SCHEMA, SF, clashing, docs, prose, table
from pyspark.sql import functions as F

from panelcast.llm import mixing, queries


def plain(rows, amounts, epochs, seed=17):
    """Chosen (doc_id, epoch), leaf by leaf; rows: leaf -> [(order of each epoch, doc_id, key, tokens)]."""
    chosen = []
    for leaf, members in rows.items():
        supply, left = sum(m[3] for m in members), round(amounts[leaf])
        if not supply:
            chosen += [(m[1], 0) for m in members]
            continue
        for epoch in range(epochs):
            if left >= supply:
                chosen += [(m[1], epoch) for m in members]
                left -= supply
                continue
            at = 0
            for m in sorted(members, key=lambda m: (m[0][epoch], m[1], m[2])):
                if at < left:
                    chosen.append((m[1], epoch))
                at += m[3]
            break
    return sorted(chosen)


def leaves(frame, epochs, seed=17):
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    # signed order is compared as the sorted slices are: by the unsigned value of its first bits
    orders = F.array(*(F.xxhash64(F.lit(seed), F.lit(e), F.col("doc_id"), key) for e in range(epochs)))
    out = {}
    for r in frame.select("doc_id", "text", "lang", "source", mixing.domain().alias("domain"), orders.alias("o"), key.alias("k")).collect():
        tokens = len((r.text or "").encode().split())
        slices = [((o % 2**64) >> 54, o) for o in r.o]
        out.setdefault((r.domain, r.lang, r.source), []).append((slices, r.doc_id, r.k, tokens))
    return out


@pytest.mark.parametrize(("share", "epochs"), [(0.8, 2), (0.2, 1), (1.7, 2), (5.0, 3), (0.0, 1)])
def test_matches_plain_selection(spark, share, epochs):
    frame = table(spark).withColumn("domain", mixing.domain())
    rows = leaves(frame, epochs)
    supply = {k: sum(m[3] for m in v) for k, v in rows.items()}
    amounts = mixing.budgets({k: n * epochs for k, n in supply.items()}, mixing.WEIGHTS, share * sum(supply.values()))
    found = mixing.mixed(frame, mixing.LEVELS, mixing.WEIGHTS, share, epochs)
    assert sorted((r.doc_id, r.epoch) for r in found.collect()) == plain(rows, amounts, epochs)


def test_query_meets_its_budget(spark):
    found = queries.op9_source_mixing(spark, SF).collect()
    total = sum(len((r.text or "").split()) for r in table(spark).collect())
    assert 0.8 * total <= sum(r.tokens for r in found) <= 0.8 * total + 60 * 4000


def test_shortages_go_to_siblings_first():
    supply = {("a", "x"): 10, ("a", "y"): 1000, ("b", "x"): 50, ("b", "y"): 1000}
    found = mixing.budgets(supply, {("a",): 1, ("b",): 1}, 400)
    assert found == {("a", "x"): 10, ("a", "y"): 190, ("b", "x"): 50, ("b", "y"): 150}
    short = mixing.budgets({("a", "x"): 10, ("a", "y"): 20, ("b", "x"): 1000}, {}, 400)
    assert short == {("a", "x"): 10, ("a", "y"): 20, ("b", "x"): 370}
    weighted = mixing.budgets({("a",): 1000, ("b",): 1000, ("c",): 1000}, {("a",): 3, ("c",): 0}, 400)
    assert weighted == {("a",): 300, ("b",): 100, ("c",): 0}
    assert mixing.budgets({}, {}, 5) == {(): 0}


def test_odd_rows(spark):
    frame = docs(spark, [*ODD, *(prose(i) for i in range(60))]).withColumn("source", F.when(F.col("doc_id") % 3 > 0, "s"))
    frame = clashing(frame.withColumn("domain", mixing.domain()), "epoch", "_key", "tokens", "key")
    full = mixing.mixed(frame, mixing.LEVELS, {}, share=1.0, epochs=1)
    assert sorted(r.doc_id for r in full.collect()) == list(range(len(ODD) + 60))
    assert set(full.columns) == set(frame.columns)
    assert mixing.mixed(spark.createDataFrame([], SCHEMA), ("lang", "source"), {}, 0.5).count() == 0
    again = spark.createDataFrame([(1, "a b", "en", "s", 3)] * 4 + [(None, None, None, None, None)], SCHEMA)
    assert mixing.mixed(again, ("lang", "source"), {}, 0.5, 1).filter("doc_id = 1").count() == 2
    with pytest.raises(ValueError, match="leaves"):
        mixing.mixed(frame, ("doc_id",), {}, 0.5, most_leaves=5)
