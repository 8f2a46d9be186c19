import numpy as np
import pytest
from cases import SF, clashing, table

from panelcast.llm import queries, vectors


def plain(rows, threshold=0.9):
    """vec_id -> (n_links, component) by comparing all pairs; ids unique."""
    good = [(i, np.array(v, float)) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {i: [0, i] for i, _ in rows}
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for size in {len(v) for _, v in good}:
        part = [(i, v) for i, v in good if len(v) == size]
        x = np.array([v / np.abs(v).max() for _, v in part])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for a, b in np.argwhere(np.triu(x @ x.T >= threshold, 1)):
            i, j = part[a][0], part[b][0]
            out[i][0] += 1
            out[j][0] += 1
            low, high = sorted((find(i), find(j)))
            root[high] = low
    return {i: (n, find(i)) for i, (n, _) in out.items()}


def check(found, rows):
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == plain(rows)
    assert len(found) == len(rows) and all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_query_matches_all_pairs(spark):
    check(queries.op10_embedding_near_dedup(spark, SF).collect(), [(r.vec_id, r.embedding) for r in table(spark, "embeddings").collect()])


@pytest.mark.parametrize(("slab", "blocks"), [(50, 4), (300, 3), (97, 8)])
def test_slabs_and_blocks_lose_no_link(spark, slab, blocks):
    rng = np.random.default_rng(slab)
    centers = rng.normal(size=(30, 16))
    x = [(centers[rng.integers(30)] + rng.normal(size=16) * rng.choice([0.05, 0.2, 0.35])) * rng.uniform(0.1, 9) for _ in range(700)]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(700 + i, x[0].tolist()) for i in range(40)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    check(vectors.near_duplicates(frame, 0.9, blocks, slab).collect(), rows)


def test_odd_vectors(spark):
    one = [1.0, 0.0, 0.0]
    odd = [one, None, [], [0.0] * 3, [None, 1.0, 0.0], [float("nan"), 1.0, 0.0], [float("inf"), 0.0, 0.0], [2.0, 0.0, 0.0], [1.0, 0.0], [1.0],
           [3.0], one, [1e300, 1e290, 0.0], [1e-300, 0.0, 0.0], [-1.0, 0.0, 0.0]]
    rows = list(enumerate(odd))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    check(vectors.near_duplicates(clashing(frame, "node", "root", "links", "good")).collect(), rows)
    assert vectors.near_duplicates(frame.limit(0)).count() == 0
    again = spark.createDataFrame([(1, one)] * 3 + [(None, one), (None, None)], frame.schema)
    found = vectors.near_duplicates(again).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0) for r in found) == [(0, 0, 0), (0, 3, 1), (1, 3, 1), (1, 3, 1), (1, 3, 1)]
