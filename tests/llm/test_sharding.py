import zlib

import pytest
from cases import ODD, SCHEMA, SF, clashing, docs, prose, table
from pyspark.sql import functions as F

from panelcast.llm import queries, sharding


def check(rows, texts, shards=16):
    by_shard = {}
    for r in rows:
        assert r.size == len((texts[r.doc_id] or "").encode()) + 1
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert set(by_shard) <= set(range(shards))
    totals = [sum(r.size for r in rows if r.shard == k) for k in range(shards)]
    largest = max((r.size for r in rows), default=0)
    slack = 0.004 * sum(totals) / shards + largest
    assert all(abs(t - sum(totals) / shards) <= slack for t in totals), totals


def test_query_keeps_its_law(spark):
    rows = queries.op4_sharding(spark, SF).collect()
    texts = {r.doc_id: r.text for r in table(spark).collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert all(r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode()) for r in rows)
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
    check(rows, texts)


@pytest.mark.parametrize("copies", [0, 400])
def test_a_text_with_most_rows_is_split(spark, copies):
    texts = [*ODD, *(prose(i, 20) for i in range(500)), *["the same text again"] * copies]
    frame = docs(spark, texts)
    check(sharding.sharded(frame).collect(), dict(enumerate(texts)))


def test_small_groups_stay_together(spark):
    texts = [prose(i // 4, 40) for i in range(2000)]
    rows = sharding.sharded(docs(spark, texts), shards=4, tolerance=0.02).collect()
    shards = {}
    for r in rows:
        shards.setdefault(r.text, set()).add(r.shard)
    assert all(len(s) == 1 for s in shards.values())


def test_odd_tables(spark):
    assert sharding.sharded(spark.createDataFrame([], SCHEMA)).count() == 0
    same = spark.createDataFrame([(1, "a", None, None, 1)] * 40 + [(None, None, None, None, None)], SCHEMA)
    rows = sharding.sharded(clashing(same, "shard", "slot", "size")).collect()
    assert len(rows) == 41 and all(isinstance(r.slot, int) for r in rows)
    frame = docs(spark, [prose(i) for i in range(50)])
    first, again = (sharding.sharded(x).orderBy("doc_id").collect() for x in (frame, frame.orderBy(F.rand())))
    assert first == again


def test_columns_with_working_names_come_back_as_they_were(spark):
    names = ("_h", "_t", "_size", "_cell", "_before", "_inside", "_row", "_doc", "_group0", "_order0", "_rows")
    frame = clashing(docs(spark, [prose(i) for i in range(30)]), *names)
    rows = sharding.sharded(frame, shards=4)
    assert rows.columns == [*frame.columns, "size", "shard", "slot"]
    assert all(r[c] == "clash" for r in rows.collect() for c in names)
