import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pytest
from cases import ODD, SCHEMA, SF, clashing, docs, prose, table

from panelcast.llm import queries, runs


def plain_runs(words, least=24, repeats=3):
    """For every period the maximal stretches, the smallest period of each."""
    found = {}
    n = len(words)
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            e = i
            while e + q < n and words[e] == words[e + q]:
                e += 1
            if e - i + q >= max(least, repeats * q):
                found.setdefault((i, e + q - i), q)
            i = max(e, i + 1) if e == i else e + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def plain_row(doc_id, text):
    words = [w for w in (text or "").translate(dict.fromkeys(range(9, 14), " ")).split(" ") if w]
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    return (
        doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    )


def as_numbers(words):
    known = {}
    return np.array([known.setdefault(w, len(known) + 1) for w in words], np.int64)


def test_query_matches_every_period_tried(spark):
    found = {r.doc_id: tuple(r) for r in queries.op11_periodic_runs(spark, SF).collect()}
    short = [r for r in table(spark).collect() if len((r.text or "").split()) < 1500]
    assert len(short) > 150
    assert found.keys() >= {r.doc_id for r in short} and len(found) == table(spark).count()
    assert sum(found[r.doc_id][1] > 0 for r in short) > 5
    for r in short:
        assert found[r.doc_id] == plain_row(r.doc_id, r.text)


@pytest.mark.parametrize("letters", [1, 2, 3])
def test_random_texts_of_few_words(letters):
    rng = np.random.default_rng(letters)
    texts = []
    for _ in range(120):
        parts = [rng.integers(0, letters, rng.integers(1, 30))]
        for _ in range(rng.integers(1, 4)):
            block = rng.integers(0, letters, rng.integers(1, 25))
            parts += [np.tile(block, 8)[: rng.integers(1, 6 * len(block) + 1)], rng.integers(0, letters, rng.integers(0, 9))]
        texts.append(np.concatenate(parts) + 1)
    for text, got in zip(texts, runs.found_runs(texts), strict=True):
        assert [tuple(r) for r in got.tolist()] == plain_runs(text.tolist())


def test_extensions_equal_word_by_word_comparison():
    rng = np.random.default_rng(5)
    words = np.append(np.r_[np.tile(rng.integers(1, 3, 17), 9), rng.integers(1, 3, 200), np.full(60, 1)], 9)
    extension = runs.Extensions(words)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(words)), np.arange(len(words))))
    a, b = a[a != b], b[a != b]

    def plain(i, j):
        k = 0
        while max(i, j) + k < len(words) and words[i + k] == words[j + k]:
            k += 1
        return k

    some = rng.choice(len(a), 3000, replace=False)
    assert extension(a, b)[some].tolist() == [plain(a[i], b[i]) for i in some]


def test_long_texts_and_held_bounds(monkeypatch):
    monkeypatch.setattr(runs, "HELD", 50)
    text = as_numbers(("a b c " * 300 + prose(1, 500) + " " + "x y " * 400 + prose(2, 300) + " z" * 90).split())
    (got,) = runs.found_runs([text])
    assert [tuple(r) for r in got.tolist()] == plain_runs(text.tolist())


def test_odd_rows(spark):
    texts = [*ODD, "a " * 23, "a " * 24, "a b c d e f g h i " * 3, "a b c d e f g h " * 3, None, ""]
    frame = clashing(docs(spark, texts), "h", "runs", "start", "n_runs")
    rows = {r.doc_id: r for r in runs.periodic_runs(frame).collect()}
    for i, text in enumerate(texts):
        words = (text or "").encode().split()
        assert [tuple(x) for x in rows[i].runs] == plain_runs(words)
    n = len(ODD)
    assert [rows[n + i].n_runs for i in range(6)] == [0, 1, 1, 1, 0, 0]
    assert bytes(rows[n + 2].collapsed) == b"a b c d e f g h i"
    assert hashlib.sha256(b"").hexdigest() == rows[n + 4].collapsed_sha256 == rows[n + 4].runs_sha256
    assert (rows[n + 1].start, rows[n + 1].length, rows[n + 1].period, rows[n + 1].exponent_milli) == (0, 24, 1, 24000)
    again = spark.createDataFrame([(1, "b " * 30, None, None, 1)] * 2 + [(None, "b " * 30, None, None, 1)], SCHEMA)
    assert [r.n_runs for r in runs.periodic_runs(again).collect()] == [1, 1, 1]
    assert runs.periodic_runs(spark.createDataFrame([], SCHEMA)).count() == 0
