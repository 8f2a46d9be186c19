import math
import re
from collections import Counter

import numpy as np
import pytest
from cases import ODD, SCHEMA, SF, clashing, docs, prose, table

from panelcast.llm import lexical, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII = {c: c + 32 for c in range(65, 91)}


def plain_terms(text):
    return TERM.findall((text or "").translate(ASCII))


def plain(documents, items, most=10):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    counts = [(i, Counter(plain_terms(t))) for i, t in documents]
    n_docs, total = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, c in counts:
            if c:
                m = 100 - 90 + 90 * c.total() * n_docs // total
                w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in set(plain_terms(text)) if t in c}
                scored.append((sum(w[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in w), doc_id))
        best = sorted((-s, i is None, i) for s, i in scored if s > 0)[:most]
        out += [(item_id, rank, i, -s) for rank, (s, _, i) in enumerate(best, 1)]
    return sorted(out)


def as_rows(frame):
    return sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect())


def test_query_matches_brute_force(spark):
    documents = [(r.doc_id, r.text) for r in table(spark).collect()]
    items = [(r.item_id, r.text) for r in table(spark, "benchmark").collect()]
    assert as_rows(queries.op12_lexical_search(spark, SF)) == plain(documents, items)


@pytest.mark.parametrize("block_terms", [40, 10**6])
def test_blocks_and_sharing_change_nothing(spark, block_terms):
    texts = [prose(i, 5 + i % 60) for i in range(300)]
    wanted = [(i, prose(i % 9, 30) + " " + prose(100 + i, 12)) for i in range(25)]
    items = spark.createDataFrame(wanted, "item_id long, text string")
    found = lexical.ranked(docs(spark, texts), items, block_terms=block_terms)
    assert as_rows(found) == plain(list(enumerate(texts)), wanted)


def test_plan_adds_every_term_of_an_item_once():
    rng = np.random.default_rng(1)
    items = [set(rng.choice(60, rng.integers(0, 40), replace=False).tolist()) | set(range(50, 55)) for _ in range(40)]
    plan = lexical.shared_plan(items, 60, [1] * 60)

    def leaves(node):
        return [node] if node < 60 else [t for child in plan.nodes[node - 60] for t in leaves(child)]

    for item, (shared, single) in zip(items, plan.tops, strict=True):
        assert sorted([t for node in shared for t in leaves(node)] + single) == sorted(item)
    assert all(child < 60 + i for i, members in enumerate(plan.nodes) for child in members)
    sums = sum(len(m) for m in plan.nodes) + sum(len(a) + len(b) for a, b in plan.tops)
    assert sums < sum(map(len, items))


def test_terms_match_the_pattern():
    for text in [*ODD, "A-B_c d.E", "naïve Çé", "x\x7fy\x80z", "ÀB{C}", "\x00a\x00"]:
        assert [t.decode() for t in lexical.terms(text)] == plain_terms(text)


def test_ties_nulls_and_odd_rows(spark):
    texts = [*ODD, *["alpha beta"] * 30, "alpha", None, ""]
    frame = clashing(docs(spark, texts), "item_id", "score", "n", "terms", "key")
    wanted = [(1, "alpha"), (2, "Alpha, ALPHA beta!"), (3, None), (4, ""), (5, "absent"), (None, "beta")]
    items = clashing(spark.createDataFrame([*wanted, (1, "alpha")], "item_id long, text string"), "doc_id", "key", "rank")
    found = sorted(((r.item_id or 0, r["rank"], r.doc_id, r.score) for r in lexical.ranked(frame, items).collect()))
    assert found == sorted((i or 0, *rest) for i, *rest in plain(list(enumerate(texts)), [(w[0] or 0, w[1]) for w in wanted]))
    unnamed = spark.createDataFrame([(None, "alpha", None, None, 1)] * 2 + [(7, "alpha", None, None, 1)] * 2, SCHEMA)
    one = spark.createDataFrame([(1, "alpha gamma")], "item_id long, text string")
    assert [(r["rank"], r.doc_id) for r in lexical.ranked(unnamed, one).orderBy("rank").collect()] == [(1, 7), (2, 7), (3, None), (4, None)]
    both = spark.createDataFrame([(1, "alpha"), (1, "beta")], "item_id long, text string")
    assert lexical.ranked(frame, both).filter("rank = 1").count() == 2
    empty = spark.createDataFrame([], SCHEMA)
    assert lexical.ranked(empty, one).count() == 0 == lexical.ranked(frame, items.limit(0)).count()
