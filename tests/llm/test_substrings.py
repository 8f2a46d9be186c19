import hashlib
import random

import numpy as np
import pytest
from cases import ODD, SCHEMA, SF, clashing, docs, prose, table
from pyspark.sql import functions as F

from panelcast.llm import queries, substrings


def plain(rows, length=100):
    """doc_id -> covered bytes, by looking up every window of the texts in order."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        covered = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                covered[i : i + length] = True
            seen.add(window)
        out[doc] = (data, covered)
    return out


def check(found, rows, length=100):
    expected = plain(rows, length)
    assert len(found) == len(rows)
    for r in found:
        data, covered = expected[r.doc_id]
        kept = np.frombuffer(data, np.uint8)[~covered].tobytes()
        spans = int((covered & ~np.r_[False, covered[:-1]]).sum())
        got = (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
        assert got == (len(data), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()), (r.doc_id, data[:80])


def test_query_matches_plain_version(spark):
    rows = [(r.doc_id, r.text) for r in table(spark).collect()]
    found = queries.op7_substring_dedup(spark, SF).collect()
    check(found, rows)
    assert sum(r.n_removed for r in found) > 0


@pytest.mark.parametrize(("most", "share"), [(2, 1000), (100_000, 1000), (100_000, 10**9)])
def test_repeats_of_all_kinds(spark, monkeypatch, most, share):
    if share > 1000:  # every trigger counts as hot
        monkeypatch.setattr(substrings, "hot_triggers", lambda parse, share: parse.select("trigger").distinct())
    rng = random.Random(4)
    passage = prose(99, 25)
    texts = [*ODD, *ODD]
    for i in range(120):
        text = prose(i % 70, rng.randint(3, 120))
        if i % 3 == 0:
            at = rng.randint(0, len(text))
            text = text[:at] + passage[rng.randint(0, 40) : rng.randint(60, len(passage))] + text[at:]
        if i % 5 == 0:
            text = text[:50] + rng.choice("xyz") + text[51:]
        texts.append(text)
    texts += ["ab" * 400, "abc" * 100 + "ab" * 200, "é" * 120, "é" * 49 + "e" + "é" * 60, passage * 4, "x" * 99, "x" * 100, "y" * 101]
    found = substrings.deduplicated(clashing(docs(spark, texts), "start", "version", "gone", "data"), most=most, share=share).collect()
    check(found, list(enumerate(texts)))


def test_long_texts_are_parsed_piece_by_piece(monkeypatch):
    text = (prose(1, 900) * 2).encode()
    whole = np.concatenate([np.stack(p[:3]) for p in substrings.phrases(text, 100)], 1)
    monkeypatch.setattr(substrings, "PIECE", 777)
    parts = np.concatenate([np.stack(p[:3]) for p in substrings.phrases(text, 100)], 1)
    for p in (whole, parts):
        assert p[1].sum() == len(text) - 99 and (np.cumsum(p[1]) - p[1] == p[0]).all()
    triggers = [np.repeat(p[0] + p[2], p[1]) for p in (whole, parts)]
    assert (triggers[0] == triggers[1]).all()


def test_odd_tables(spark):
    assert substrings.deduplicated(spark.createDataFrame([], SCHEMA)).count() == 0
    text = prose(5, 60)
    frame = spark.createDataFrame([(1, text, None, None, 1)] * 3 + [(2, text, None, None, 1), (None, text[:120], None, None, 1), (2, "z", None, None, 1)], SCHEMA)
    rows = substrings.deduplicated(frame).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in rows) == [(0, 0), *[(1, 120)] * 3, (2, 0), (2, len(text))]


def test_a_passage_in_very_many_documents_is_no_one_task(spark):
    passage = prose(0, 24)[:140]
    texts = [f"{prose(2 * i + 1, 12)} {passage} {prose(2 * i + 2, 12)}" for i in range(4000)]
    frame = docs(spark, texts)
    rows = frame.select("doc_id", substrings.version(F.col("text")).alias("version"), "text")
    parse = substrings.written(substrings.parsed(rows, 100), "parse")
    hot = substrings.hot_triggers(parse)
    assert 0 < hot.count() < 10
    tasks = substrings.marked(parse, hot).withColumn("task", F.spark_partition_id()).filter("mixed").groupBy("task").count().collect()
    assert max(r["count"] for r in tasks) < 3 * sorted(r["count"] for r in tasks)[len(tasks) // 2]
    check(substrings.deduplicated(frame).collect(), list(enumerate(texts)))
