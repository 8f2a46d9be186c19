"""Secret scans with an incremental ledger of blobs.

Every version of a document is addressed by the SHA-256 of its content. A ledger, a Parquet table
that only grows, says which blob was scanned by which version of which rule and what was found.
An update scans the pairs of blob and rule version that the ledger lacks, each blob once however
many paths hold it, and findings are joined back to all paths.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = "blob string, rule string, version int, spans array<struct<start:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """What a kind of secret looks like. A new ``version`` makes the ledger scan every blob again.

    Matches are leftmost and do not overlap; those whose ``group`` is shorter than ``least`` are
    dropped and not tried again from another start. ``words`` holds lower-case strings one of which
    every matching text contains; without one of them the pattern is not tried.
    """

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0
    words: tuple[str, ...] = ()


# The kinds of secrets and their patterns, in this order.
BASE_RULES = (
    Rule(
        "assign", 1,
        r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2, least=6, words=("password", "passwd", "secret", "token", "apikey", "api_key"),
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", least=20, words=("akia",)),
    Rule("hex", 1, r"[0-9a-f]{24,}"),  # the longest runs of 24 characters and more
)
# What the scan adds: private keys in PEM form.
MORE_RULES = (Rule("pem", 1, r"-----BEGIN (?:[A-Z]{1,20} ){0,4}PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END (?:[A-Z]{1,20} ){0,4}PRIVATE KEY-----)?", words=("private key",)),)
RULES = BASE_RULES + MORE_RULES


def scanner(rule: Rule) -> Callable[[str, str], list[tuple[int, int]]]:
    """Spans of a rule in a text, given also in lower case."""
    compiled = re.compile(rule.pattern)

    def spans(text: str, lower: str) -> list[tuple[int, int]]:
        if rule.words and not any(w in lower for w in rule.words):
            return []
        return [m.span() for m in compiled.finditer(text) if len(m.group(rule.group)) >= rule.least]

    return spans


def blob(text: str = "text") -> Column:
    """The address of a version: SHA-256 of its UTF-8 bytes, null counting as empty."""
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``; empty if nothing was written there yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as absent:
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def update(versions: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> None:
    """Scan what the ledger at ``path`` has not seen of the column ``text`` and append it.

    ``versions`` holds one row per version of a path; other columns are not read. Texts without a
    finding are entered too, so they are never scanned twice. A write that was cut short leaves
    the ledger as it was, and two that overlap enter the same findings twice, which readers unite.
    """
    spark = versions.sparkSession
    current = {r.kind: r.version for r in rules}
    wanted = F.create_map(*(F.lit(x) for pair in current.items() for x in pair))
    seen = (
        read_ledger(spark, path).filter(F.col("version") == wanted[F.col("rule")])
        .groupBy("blob").agg(F.collect_set("rule").alias("_seen"))
    )
    fresh = versions.select(blob().alias("blob"), "text").dropDuplicates(["blob"])
    todo = fresh.join(seen, "blob", "left").filter(
        F.col("_seen").isNull() | (F.size("_seen") < len(rules))
    ).select("blob", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("_seen", F.array().cast("array<string>")).alias("_seen"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanners = [(r.kind, r.version, scanner(r)) for r in rules]
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                rows = whole.slice(start, 256).to_pylist()
                found = []
                for row in rows:
                    text = row["text"]
                    lower = text.lower()
                    found += [
                        {"blob": row["blob"], "rule": kind, "version": version,
                         "spans": [{"start": a, "end": b} for a, b in spans(text, lower)]}
                        for kind, version, spans in scanners if kind not in row["_seen"]
                    ]
                yield pa.RecordBatch.from_pylist(found, pa.schema([
                    ("blob", pa.string()), ("rule", pa.string()), ("version", pa.int32()),
                    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                ]))

    todo.mapInArrow(scan, LEDGER).write.mode("append").parquet(path)


def findings(versions: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``versions`` with ``_spans``: ``start, kind number, end`` of every finding in order.

    Start and end count code points, the end is exclusive. A path with no finding has an empty list;
    a version that the ledger has not seen yet has one too, so run :func:`update` first.
    """
    number = F.create_map(*(F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)))
    version = F.create_map(*(F.lit(x) for r in rules for x in (r.kind, r.version)))
    ledger = read_ledger(versions.sparkSession, path)
    found = (
        ledger.filter((F.col("version") == version[F.col("rule")]) & (F.size("spans") > 0))
        .select("blob", F.explode(F.transform("spans", lambda s: F.struct(
            s["start"].alias("start"), number[F.col("rule")].alias("kind"), s["end"].alias("end")))).alias("_span"))
        .groupBy("blob").agg(F.array_sort(F.collect_set("_span")).alias("_spans"))
        .withColumnRenamed("blob", "_blob")
    )
    joined = versions.withColumn("_blob", blob()).join(found, "_blob", "left").drop("_blob")
    return joined.withColumn("_spans", F.coalesce("_spans", F.array().cast("array<struct<start:int,kind:int,end:int>>")))


def span_text(spans: Column, kinds: list[str]) -> Column:
    """Spans ``start, kind number, end`` as ``kind:start:end``, joined by commas."""
    names = F.array(*map(F.lit, kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def counted(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def report(versions: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of every row, from the ledger."""
    kinds = [r.kind for r in RULES]
    found = findings(versions.select("doc_id", "text"), path)
    base = F.filter("_spans", lambda s: s["kind"] < len(BASE_RULES))
    return found.select(
        "doc_id", *(counted(F.col("_spans"), i).alias(f"n_{r.kind}") for i, r in enumerate(BASE_RULES)),
        F.sha2(span_text(base, kinds), 256).alias("base_sha256"), span_text(F.col("_spans"), kinds).alias("spans"),
    )
