"""Ranked lexical search for many items at once, sharing what their term sets have in common.

The items to search for are cut into blocks. Sets of terms that several items of a block share are
mined: terms that stand in the same items form one set, and pairs of sets that often meet are joined,
round by round, into larger ones. They make a query-sharing DAG whose leaves are terms and whose tops
are items. Tasks read an index of the documents, a batch at a time: every shared node's partial
accumulator over the batch is added up once, and the items combine those accumulators with the terms
they alone have. Only each task's best documents of each item leave it.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import in_few_files, released, slices
from panelcast.session import written

#: About as many terms as the items of a block hold together.
BLOCK_TERMS = 50_000
#: Bytes of accumulators a task holds, and bytes of text it splits at a time.
ACCUMULATORS, SLICE = 48 << 20, 1 << 20
#: Rounds in which pairs of shared sets are joined, and the sets of an item that take part in one.
ROUNDS, WIDEST = 8, 64

#: What is not part of a term becomes a space, and A to Z become a to z; bytes above 127 stay.
TERM_BYTES = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: str | None) -> list[bytes]:
    """The maximal runs of letters and digits, where all beyond ASCII count as letters."""
    return (text or "").encode().translate(TERM_BYTES).split()


@dataclass(frozen=True)
class Plan:
    """The query-sharing DAG of a block.

    Nodes are numbered from the terms on, which come first: node ``terms + i`` is the sum of
    ``nodes[i]``, all of smaller numbers. ``tops[i]`` are the shared nodes and the single terms whose
    sums make item ``i``.
    """

    nodes: list[list[int]]
    tops: list[tuple[list[int], list[int]]]


def shared_plan(items: Sequence[set[int]], term_count: int, cost: Sequence[int]) -> Plan:
    """Mine the sets of terms that items share. ``cost`` gives the documents that hold a term.

    The plan decides only what is added up once; the sums are the same whatever it shares.
    """
    holders: dict[int, list[int]] = defaultdict(list)
    for i, item in enumerate(items):
        for term in sorted(item):
            holders[term].append(i)
    alike: dict[tuple[int, ...], list[int]] = defaultdict(list)
    for term, of in holders.items():
        alike[tuple(of)].append(term)
    nodes: list[list[int]] = []
    single: list[list[int]] = [[] for _ in items]
    tops: list[set[int]] = [set() for _ in items]
    work: dict[int, int] = {}
    for of, members in sorted(alike.items()):
        if len(of) == 1:
            single[of[0]] = members
            continue
        node = term_count + len(nodes)
        nodes.append(members)
        work[node] = sum(cost[t] for t in members)
        for i in of:
            tops[i].add(node)
    for _ in range(ROUNDS):
        met: Counter = Counter()
        for top in tops:
            widest = sorted(sorted(top, key=lambda n: (-work[n], n))[:WIDEST])
            met.update((a, b) for k, a in enumerate(widest) for b in widest[k + 1 :])
        joined: dict[int, tuple[int, int]] = {}
        for (a, b), times in sorted(met.items(), key=lambda m: (-m[1], m[0])):
            if times < 3:
                break  # two items gain nothing by one sum more
            if a not in joined and b not in joined:
                joined[a] = joined[b] = (a, b)
        for a, b in sorted(set(joined.values())):
            node = term_count + len(nodes)
            nodes.append([a, b])
            work[node] = work[a] + work[b]
            for top in tops:
                if a in top and b in top:
                    top -= {a, b}
                    top.add(node)
        if not joined:
            break
    return Plan(nodes, [(sorted(top), own) for top, own in zip(tops, single, strict=True)])


def accumulated(plan: Plan, term_count: int, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, docs: int) -> Iterator[np.ndarray]:
    """For each item the scores of the ``docs`` documents of a batch, from postings sorted by term."""
    edges = np.searchsorted(term, np.arange(term_count + 1))

    def add(to: np.ndarray, members: list[int]) -> None:
        for t in members:
            low, high = edges[t], edges[t + 1]
            to[doc[low:high]] += impact[low:high]  # a document stands once among a term's postings

    partial: list[np.ndarray] = []
    for members in plan.nodes:
        sums = np.zeros(docs, np.int64)
        if members[0] < term_count:
            add(sums, members)
        else:
            for node in members:
                sums += partial[node - term_count]
        partial.append(sums)
    for shared, single in plan.tops:
        scores = np.zeros(docs, np.int64)
        for node in shared:
            scores += partial[node - term_count]
        add(scores, single)
        yield scores


def index(docs: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """``doc_id, n, terms, counts``: a row's number of terms, and those in the vocabulary, by number."""
    number = {t.encode(): i for i, t in enumerate(vocabulary)}

    @released
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, SLICE):
                sizes, ends, at, counts = [], [0], [], []
                for text in batch.column("text").to_pylist():
                    words = terms(text)
                    found = Counter(map(number.get, words))
                    found.pop(None, None)
                    sizes.append(len(words))
                    at += found.keys()
                    counts += found.values()
                    ends.append(len(at))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (at, counts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sizes, pa.int64()), *lists], names=["doc_id", "n", "terms", "counts"]
                )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(count, f"doc_id {kind}, n long, terms array<int>, counts array<int>")


class Best:
    """The best documents met so far of each item: highest scores, then smallest ids, null ids last."""

    def __init__(self, items: int, most: int):
        self.most = most
        self.rows: list[list[tuple[int, bool, object]]] = [[] for _ in range(items)]

    def add(self, item: int, scores: np.ndarray, ids: pa.Array) -> None:
        held = self.rows[item]
        least = max(1, -held[-1][0] if len(held) == self.most else 1)
        at = np.flatnonzero(scores >= least)
        if len(at) > self.most:  # equal to the last that fits: ids decide
            at = at[scores[at] >= np.partition(scores[at], -self.most)[-self.most]]
        if len(at):
            new = zip((-scores[at]).tolist(), ids.take(pa.array(at)).to_pylist(), strict=True)
            self.rows[item] = sorted([*held, *((s, i is None, 0 if i is None else i) for s, i in new)])[: self.most]


def searched(found: DataFrame, plan: Plan, weights: Sequence[int], documents: int, total: int, most: int) -> DataFrame:
    """``item, doc_id, score``: of each task the best ``most`` documents of each item of the plan."""
    weight = np.array(weights, np.int64)
    batch_rows = max(64, min(8192, ACCUMULATORS // (8 * (len(plan.nodes) + 2))))

    @released
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, kind = Best(len(plan.tops), most), None
        for whole in batches:
            kind = whole.schema.field("doc_id").type
            for begin in range(0, whole.num_rows, batch_rows):
                batch = whole.slice(begin, batch_rows)
                rows = batch.num_rows
                sizes = np.diff(batch.column("terms").offsets.to_numpy())
                doc = np.repeat(np.arange(rows), sizes)
                term = batch.column("terms").flatten().to_numpy()
                tf = batch.column("counts").flatten().to_numpy().astype(np.int64)
                m = 100 - 90 + 90 * batch.column("n").to_numpy() * documents // total
                impact = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
                order = np.argsort(term, kind="stable")
                scores = accumulated(plan, len(weight), term[order], doc[order], impact[order], rows)
                for item, of in enumerate(scores):
                    best.add(item, of, batch.column("doc_id"))
        rows = [(i, None if null else doc, -s) for i, held in enumerate(best.rows) for s, null, doc in held]
        if rows:
            item, ids, scores = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int32()), pa.array(ids, kind), pa.array(scores, pa.int64())], names=["item", "doc_id", "score"]
            )

    return found.mapInArrow(search, f"item int, doc_id {dict(found.dtypes)['doc_id']}, score long")


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, key, terms``: the different terms of each different item, and a hash that names it."""

    @released
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({t.decode() for t in terms(x)}) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), batch.column("key"), pa.array(found, pa.list_(pa.string()))], names=["item_id", "key", "terms"]
            )

    kind = dict(items.dtypes)["item_id"]
    known = items.select("item_id", "text").distinct().select("item_id", F.xxhash64("item_id", "text").alias("key"), "text")
    return known.mapInArrow(split, f"item_id {kind}, key long, terms array<string>").filter(F.size("terms") > 0)


def ranked(docs: DataFrame, items: DataFrame, most: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``most`` best documents with a score above 0.

    A term's weight is ``floor(1000 ln((2N + 2) / (2df + 1)))`` and a document's score for it
    ``weight * (10^9 tf div (1000 tf + 8m))`` with ``m = 10 + 90 n N div L``: N documents have terms, L
    in all, n in this one. Equal scores are ranked by ascending ``doc_id``, null ids last; rows that
    share an id are documents each. Null texts have no term. Equal rows of ``items`` are one item,
    rows that share an ``item_id`` but not the text are items each, and an item that finds nothing has
    no row. Other columns are not read.

    Items are taken in blocks of about ``block_terms`` terms, each of which reads the texts once. What
    a block sends to tasks or gathers grows with its terms alone.
    """
    spark = docs.sparkSession
    kind = dict(items.dtypes)["item_id"]
    wanted = written(in_few_files(item_terms(items), items.count(), 10_000), "items")
    total = wanted.agg(F.sum(F.size("terms"))).first()[0]
    blocks = max(1, -(-(total or 0) // block_terms))
    results, facts = [], None
    for block in range(blocks):
        own = wanted.filter(F.pmod("key", F.lit(blocks)) == block).orderBy("key").collect()  # one block
        vocabulary = sorted({t for r in own for t in r.terms})
        if not own:
            continue
        found = written(index(docs, vocabulary), "index")
        facts = facts or found.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("total")).first()
        counted = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        df = [0] * len(vocabulary)
        for r in counted.collect():  # one row a term of the block
            df[r.term] = r.df
        weights = [math.floor(1000 * math.log((2 * facts.documents + 2) / (2 * n + 1))) for n in df]
        number = {t: i for i, t in enumerate(vocabulary)}
        plan = shared_plan([{number[t] for t in r.terms if df[number[t]]} for r in own], len(vocabulary), df)
        scores = searched(found, plan, weights, facts.documents, facts.total or 1, most)
        names = spark.createDataFrame([(i, r.item_id, r.key) for i, r in enumerate(own)], f"item int, item_id {kind}, key long")
        results.append(scores.join(F.broadcast(names), "item").select("item_id", "key", "doc_id", "score"))
    if not results:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id {dict(docs.dtypes)['doc_id']}, score long")
    rows = results[0]
    for other in results[1:]:
        rows = rows.union(other)
    place = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= most).select("item_id", "rank", "doc_id", "score")
