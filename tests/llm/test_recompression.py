import hashlib

import numpy as np
import pytest
from cases import ODD, SCHEMA, SF, clashing, docs, prose, table

from panelcast.llm import queries, recompression


def plain_words(text):
    return [w for w in (text or "").translate(dict.fromkeys(range(9, 14), " ")).split(" ") if w]


def plain(rows, width=13):
    """(doc_id, n_words, n_removed, kept_sha256) by a dictionary of all windows."""
    first = {}
    split = [(i, plain_words(t)) for i, t in rows]
    for i, words in split:
        for k in range(len(words) - width + 1 if i is not None else 0):
            window = tuple(words[k : k + width])
            first[window] = min(first.get(window, i), i)
    out = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - width + 1 if i is not None else 0):
            if first[tuple(words[k : k + width])] < i:
                gone.update(range(k, k + width))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def as_rows(frame):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in frame.collect()), key=str)


def test_query_matches_all_windows(spark):
    rows = [(r.doc_id, r.text) for r in table(spark).collect()]
    found = as_rows(queries.op13_substring_dedup(spark, SF))
    assert found == plain(rows) and sum(r[2] > 0 for r in found) > 20


@pytest.mark.parametrize("width", [2, 5, 13, 40])
def test_random_texts_of_few_words(spark, width):
    rng = np.random.default_rng(width)
    parts = [" ".join(rng.choice(["a", "b", "c"], rng.integers(1, 60))) for _ in range(40)]
    texts = [" ".join(rng.choice(parts, rng.integers(0, 6))) for _ in range(150)] + ["a " * 200, "a " * 150, "b a " * 90]
    found = as_rows(recompression.deduplicated(docs(spark, texts), width))
    assert found == plain(list(enumerate(texts)), width)


def test_a_passage_in_every_document(spark):
    common = prose(0, 30)
    texts = [f"{prose(2 * i + 1, 15)} {common} {prose(2 * i + 2, 15)}" for i in range(1500)]
    frame = docs(spark, texts)
    assert as_rows(recompression.deduplicated(frame)) == plain(list(enumerate(texts)))


def test_borders_and_names_depend_on_their_words_alone():
    rng = np.random.default_rng(9)
    passage = rng.integers(0, 5, 60)
    texts = [np.r_[rng.integers(0, 5, n), passage, rng.integers(0, 5, 70 - n)] for n in (3, 19, 47)]
    name = recompression.mixed(np.arange(5))
    seen = []
    for words, n in zip(texts, (3, 19, 47), strict=True):
        rounds = recompression.borders(name[words], np.array([0, len(words)]), 40)
        assert len(rounds) > 3
        # all that words of the passage decide, by round
        seen.append([
            sorted((int(a) - n, int(b) - n, int(k)) for a, b, k in zip(low, high, key, strict=True) if a >= n and b <= n + 60)
            for low, high, key in rounds
        ])
    assert seen[0] == seen[1] == seen[2] and len(seen[0][3]) > 3


def test_rounds_end_runs_and_pairs():
    symbols = np.array([7, 7, 7, 8, 8, 3, 7, 8], np.uint64)
    names, first = recompression.named(symbols, np.array([True, True, True, True, False, False, True]))
    assert first.tolist() == [0, 5, 6] and names[1] == 3 and names[0] != names[2]
    again, _ = recompression.named(symbols[:5], np.array([True, True, True, True]))
    assert again[0] == names[0]


def test_odd_rows(spark):
    long = prose(3, 40)
    texts = [*ODD, long, long, " ".join(long.split()[5:30]), None, ""]
    frame = clashing(docs(spark, texts), "version", "key", "start", "gone", "n", "first")
    assert as_rows(recompression.deduplicated(frame)) == plain(list(enumerate(texts)))
    rows = [(1, long), (1, long), (1, long + " more"), (None, long), (None, long), (2, long), (2, None)]
    again = spark.createDataFrame([(i, t, None, None, 1) for i, t in rows], SCHEMA)
    assert as_rows(recompression.deduplicated(again)) == plain(rows)
    kept = recompression.deduplicated(again).filter("doc_id = 1 AND n_words = 41").first()
    assert bytes(kept.kept).decode() == long + " more"
    assert recompression.deduplicated(spark.createDataFrame([], SCHEMA)).count() == 0
    names = spark.createDataFrame([("b", long), ("a", long)], "doc_id string, text string")
    assert {r.doc_id: r.n_removed for r in recompression.deduplicated(names).collect()} == {"a": 0, "b": 40}
