import json
import random

import pytest

from panelcast.sources import elements, feeds

ELEMENT = "id bigint, web_name string, team bigint, stats struct<total_points: double>, tags array<string>"


def document(seed, count):
    rng = random.Random(seed)
    odd = ['}', '{', '"', '\\', '},{', ']', '"elements":[', 'é🙂', '\n', 'plain', '\\"}']
    items = [
        {"id": i, "web_name": "".join(rng.choice(odd) for _ in range(rng.randint(0, 6))), "team": None if i % 7 == 0 else i % 20,
         "stats": {"total_points": i / 4}, "tags": [rng.choice(odd) for _ in range(i % 3)]}
        for i in range(count)
    ]
    return {"events": [{"id": -1, "elements": [{"id": -2}]}], "elements": items, "teams": [{"id": -3, "short_name": "}{"}], "total": "]"}


def simple(spark, path):
    rows = spark.read.schema(f"elements array<struct<{', '.join(p.replace(' ', ': ', 1) for p in split(ELEMENT))}>>").option("multiLine", True).json(path)
    return sorted(map(str, rows.selectExpr("inline(elements)").collect()))


def split(schema):
    return ["id bigint", "web_name string", "team bigint", "stats struct<total_points: double>", "tags array<string>"]


@pytest.mark.parametrize("size", [97, 1000, 100_000_000])
@pytest.mark.parametrize("indent", [None, 2])
def test_ranges_of_any_size_give_the_same_elements(spark, tmp_path, size, indent):
    for i, count in enumerate((0, 1, 300)):
        (tmp_path / f"{i}.json").write_text(json.dumps(document(i, count), indent=indent, ensure_ascii=bool(i % 2)))
    (tmp_path / "none.json").write_text('{"teams": [{"id": 1}]}\n')
    (tmp_path / "empty.json").write_text("")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = elements.read_elements(spark, f"{tmp_path}/*.json", "elements", ELEMENT)
        assert sorted(map(str, got.collect())) == simple(spark, f"{tmp_path}/[0-9].json")
        assert elements.read_elements(spark, f"{tmp_path}/*.json", "absent", ELEMENT).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_long_list_is_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "long.json"
    with path.open("w") as out:
        out.write('{"elements":[')
        out.write(",".join(f'{{"id":{i},"web_name":"n}}{i}","stats":{{"total_points":{i % 9}.5}}}}' for i in range(200_000)))
        out.write("]}")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1 << 20)
    try:
        got = elements.read_elements(spark, str(path), "elements", ELEMENT)
        found = got.selectExpr("count(*) AS n", "count(DISTINCT id) AS ids", "sum(stats.total_points) AS points", "max(web_name) AS name").first()
        assert (found.n, found.ids, found.points, found.name) == (200_000, 200_000, sum(i % 9 + 0.5 for i in range(200_000)), "n}99999")
        assert spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions() >= 8
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    whole = feeds.read_documents(spark, str(path), f"elements array<struct<{ELEMENT.split(', stats')[0].replace(' ', ': ').replace(',:', ',')}>>")
    assert whole.selectExpr("size(elements) AS n").first().n == 200_000
