import base64
import hashlib
import struct

import pytest
from cases import ODD, SCHEMA, SF, clashing, docs, prose, table
from pyspark.sql import functions as F

from panelcast.llm import queries, syncmers


def plain_edits(rows):
    """doc_id -> (text, edited, next) by plain slicing; rows: (doc_id, text), ids unique."""
    order = sorted(rows, reverse=True)
    out = {}
    for i, (doc, text) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        half = len(text) // 2
        out[doc] = (text, text[: len(text) - half] + following[:half], following)
    return out


def decoded(fingerprint):
    """Lists of (hash, place): by words, and by code points if the text is short."""
    parts = [base64.b64decode(p) for p in fingerprint.split(".")]
    return [list(struct.iter_unpack(">iI", p)) for p in parts] + [None] * (2 - len(parts))


def plain_likeness(one, two):
    (words, chars), (other_words, other_chars) = decoded(one), decoded(two)
    a, b = (chars, other_chars) if chars and other_chars else (words, other_words)
    places = [dict(reversed(x)) for x in (a, b)]  # the first place of each hash
    first = next((h for h, _ in a if h in places[1]), None)
    if first is None:
        return 0.0
    best = 0.0
    for moved in (0, places[0][first] - places[1][first]):
        x, y = {(h, p // 64) for h, p in a}, {(h, (p + moved) // 64) for h, p in b}
        best = max(best, 2 * len(x & y) / (len(x) + len(y)))
    return best


def alike(spark, pairs):
    frame = spark.createDataFrame(pairs, "a string, b string")
    found = frame.select(syncmers.likeness(syncmers.anchors(F.col("a")), syncmers.anchors(F.col("b"))).alias("n")).collect()
    return [r.n for r in found]


def test_place_and_order_count(spark):
    x, y, other = prose(1, 300), prose(2, 300), prose(3, 300)
    short = prose(4, 9)
    unspaced = "".join(chr(0x3042 + i * 37 % 80) for i in range(700))
    more = "".join(chr(0x30A2 + i * 29 % 80) for i in range(350))
    same, half, swapped, inserted, moved, unlike = alike(spark, [
        (x, x), (f"{x} {y}", f"{x} {other}"), (f"{x} {y}", f"{y} {x}"), (f"{x} {y}", f"{x} word {y}"), (x, f"{other} {x}"), (x, y)])
    assert same == 1 and 0.4 < half < 0.6 and swapped < 0.6 and inserted > 0.9 and 0.5 < moved < 0.8 and unlike < 0.05
    assert 0.35 < alike(spark, [(unspaced, unspaced[:350] + more)])[0] < 0.65
    assert 0.3 < alike(spark, [(short, short[: len(short) // 2] + "q" * (len(short) // 2))])[0] < 0.7
    once, often = alike(spark, [(x, f"{x} {y}"), (x, " ".join([x] + [y] * 20))])
    assert often < once / 2  # a passage counts as often as it stands there


def check(found, expected):
    assert sorted(r.doc_id for r in found) == sorted(expected)
    by_text = {}
    for r in found:
        text, edited, following = expected[r.doc_id]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        assert by_text.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint
        assert r.near_edited == pytest.approx(plain_likeness(r.fingerprint, r.edited_fingerprint))
        if following in by_text:
            assert r.near_next == pytest.approx(plain_likeness(r.fingerprint, by_text[following]))


def test_query_matches_plain_edits(spark):
    rows = [(r.doc_id, r.text or "") for r in table(spark).collect()]
    found = queries.op2_document_fingerprints(spark, SF).collect()
    check(found, plain_edits(rows))
    long = [r for r in found if r.n_chars > 800]
    assert sum(r.near_edited for r in long) / len(long) > 0.25 > 0.05 > sum(r.near_next for r in long) / len(long)


def test_anchors_are_closed_and_context_free(spark):
    text, more = prose(3, 200), prose(4, 30)
    frame = spark.createDataFrame([(text,), (more + " " + text,)], "t string").select(syncmers.anchors(F.col("t"))["words"].alias("a"))
    (inner, places), (longer, later) = ((r.a.hashes, r.a.places) for r in frame.collect())
    assert [p + 30 for p in places] == later[-len(places) :]
    assert longer[-len(inner) :] == inner
    assert 0.35 < len(inner) / 196 < 0.65


def test_no_python_on_the_path(spark):
    plan = queries.op2_document_fingerprints(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_odd_rows(spark):
    texts = [*ODD, prose(1), prose(1), *(prose(i) for i in range(40))]
    found = syncmers.fingerprints(clashing(docs(spark, texts), "bucket", "tie", "value", "copy", "next_text")).collect()
    check(found, plain_edits([(i, t or "") for i, t in enumerate(texts)]))
    assert syncmers.fingerprints(spark.createDataFrame([], SCHEMA)).count() == 0
    one = syncmers.fingerprints(docs(spark, ["abcd"])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1
    again = spark.createDataFrame([(1, "a b", None, None, 3)] * 3 + [(None, "c", None, None, 1)] * 2, SCHEMA)
    assert syncmers.fingerprints(again).count() == 5
