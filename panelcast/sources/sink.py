"""Partitioned tables that replace only the periods written, and CSV exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from panelcast.operators.blocks import number_rows
from panelcast.sources.tree import CSV_OPTIONS, list_files

# Text is written as it is, with its spaces.
CSV_WRITE_OPTIONS = {**CSV_OPTIONS, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_periods(df: DataFrame, path: str, by: Sequence[str] = ("season", "gameweek"), file_format: str = "parquet") -> int:
    """Write one folder per period, replace only the periods that ``df`` holds, and return the rows written.

    The rebalance hint lets Spark merge small periods into few files and split a very large one. The
    count is observed during the write, without a second job.
    """
    seen = Observation()
    (
        df.observe(seen, F.count(F.lit(1)).alias("rows"))
        .hint("rebalance", *[F.col(c) for c in by])
        .write.mode("overwrite").options(partitionOverwriteMode="dynamic", **CSV_WRITE_OPTIONS if file_format == "csv" else {})
        .partitionBy(*by).format(file_format).save(path)
    )
    return seen.get["rows"]


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and no index."""
    df.write.mode("overwrite").options(**CSV_WRITE_OPTIONS).csv(path)



def done_periods(spark: SparkSession, path: str, by: Sequence[str] = ("season", "gameweek")) -> DataFrame:
    """The periods that ``write_periods`` has written at ``path``, by the names of their folders; none if there is nothing yet."""
    if not list_files(spark, f"{path}{'/*' * (len(by) + 1)}"):
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in by))
    folders = spark.read.format("binaryFile").option("recursiveFileLookup", False).load(path)  # paths only, no content
    return folders.select(*by).distinct()


def write_ordered(df: DataFrame, path: str, order: Sequence[str | Column], rank: str = "rank") -> None:
    """An export in one order over all its files, with a list of where each begins.

    Rows get their ``rank`` from 1 in the order of ``order``, which must have no ties. The files under
    ``rows`` hold ranks one after the other in the order of their names, and ``parts`` lists ``part,
    first_rank, last_rank, rows`` of each, so a reader takes a range of ranks without a sort or a scan.
    """
    numbered = number_rows(df, order, "_at").withColumn(rank, F.col("_at") + 1).drop("_at")
    ranked = numbered.select(rank, *df.columns).repartitionByRange(rank).sortWithinPartitions(rank)
    ranked.write.mode("overwrite").options(**CSV_WRITE_OPTIONS).csv(f"{path}/rows")
    written = df.sparkSession.read.schema(f"{rank} long").options(**CSV_OPTIONS, enforceSchema=True).csv(f"{path}/rows")
    parts = written.groupBy(F.col("_metadata.file_name").alias("part")).agg(
        F.min(rank).alias("first_rank"), F.max(rank).alias("last_rank"), F.count(F.lit(1)).alias("rows"))
    parts.coalesce(1).write.mode("overwrite").json(f"{path}/parts")


def ordered_parts(spark: SparkSession, path: str) -> DataFrame:
    """``part, first_rank, last_rank, rows`` of the files of an ordered export."""
    return spark.read.schema("part string, first_rank long, last_rank long, rows long").json(f"{path}/parts")


def read_ranks(spark: SparkSession, path: str, schema: str, first: int, last: int, rank: str = "rank") -> DataFrame:
    """The rows of an ordered export from one rank to another; only files that hold some of them are read.

    ``schema`` is that of the exported rows, without the rank.
    """
    wanted = ordered_parts(spark, path).where((F.col("last_rank") >= first) & (F.col("first_rank") <= last)).select("part")
    files = [f"{path}/rows/{r['part']}" for r in wanted.collect()]  # as many as files are to be read
    rows = spark.read.schema(f"{rank} long, {schema}").options(**CSV_OPTIONS)
    if not files:
        return spark.createDataFrame([], f"{rank} long, {schema}")
    return rows.csv(files).where(F.col(rank).between(first, last))
