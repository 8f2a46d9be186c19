"""The elements of a list in one large JSON document, read by many tasks.

A JSON document has no line breaks to cut at, and whether a brace is one or stands in a string depends
on all that comes before it. So the file is read in byte ranges that end at a closing brace. A first
pass tells for each range, once as if it began inside a string and once as if not, which of the
containers open at its begin it closes and which it leaves open. Put together in order, a few values a
range, these say how every range really begins; a second pass then cuts out the elements. Those that
reach over the end of a range are put together from their parts.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key with its colon, another string, a bracket, or the quote of a string that has not ended.
TOKEN = re.compile(r'"((?:[^"\\]|\\.)*)"\s*:|"(?:[^"\\]|\\.)*"|[{}\[\]]|"', re.DOTALL)
SUMMARY = "file string, block long, quoted boolean, ends_quoted boolean, closed int, opened string"
CUT = "file string, block long, whole boolean, begins boolean, text string"


class Range:
    """Reads one byte range that begins inside the containers of ``stack``, of ``(bracket, key)`` each.

    ``stack`` becomes those open at its end, ``closed`` counts those closed that were not in it, and
    ``quoted`` says whether a string is open. With ``field``, the elements of that list are cut out.
    """

    def __init__(self, stack: list, quoted: bool, field: str | None = None):
        self.stack, self.quoted, self.field, self.closed = list(stack), quoted, field, 0
        self.key: str | None = None
        # what is still needed of the text read, where to go on, and where the element at hand begins
        self.text, self.at = '"' if quoted else "", 0
        self.start = 0 if len(self.stack) > 2 and self.in_list(self.stack[:2]) else None
        # an element that began in an earlier range; the quote above is no part of it
        self.cut_off, self.added = self.start is not None, int(quoted)

    def in_list(self, stack: list) -> bool:
        return self.field is not None and len(stack) == 2 and stack[1] == ("[", self.field)

    def element(self, end: int | None = None) -> str:
        return self.text[self.start + (self.added if self.cut_off else 0) : end]

    def read(self, more: str) -> Iterator[tuple[bool, str]]:
        """Go on by ``more``, up to a brace, and give ``(whole, text)`` of each element that ends there."""
        self.text += more
        self.quoted, reached = False, len(self.text)
        for token in TOKEN.finditer(self.text, self.at):
            kind = token[0]
            if kind == '"':  # a string that goes on in what is read next
                self.quoted, reached = True, token.start()
                break
            if kind in "{[":
                if self.in_list(self.stack):
                    self.start = token.start()
                self.stack.append((kind, self.key))
            elif kind in "}]":
                if self.stack:
                    self.stack.pop()
                else:
                    self.closed += 1
                if self.start is not None and self.in_list(self.stack):
                    yield not self.cut_off, self.element(token.end())
                    self.start, self.cut_off = None, False
            self.key = token[1]
        kept = reached if self.start is None else self.start
        self.text, self.at = self.text[kept:], reached - kept
        self.start = None if self.start is None else 0


def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, str]]:
    """``file, block, text`` in order; the reader has taken the closing brace off every piece."""
    for batch in batches:
        files, blocks, values = (batch.column(c).to_pylist() for c in ("file", "block", "value"))
        start = 0
        for i in range(1, len(values) + 1):
            if i == len(values) or (files[i], blocks[i]) != (files[start], blocks[start]):
                yield files[start], blocks[start], "}".join(values[start:i]) + "}"
                start = i


def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, both = None, []

    def rows() -> pa.RecordBatch:
        found = [(*now, q, r.quoted, r.closed, json.dumps(r.stack)) for q, r in zip((False, True), both, strict=True)]
        types = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int32(), pa.string())
        columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["file", "block", "quoted", "ends_quoted", "closed", "opened"])

    for file, block, text in ranges(batches):
        if (file, block) != now:
            if now:
                yield rows()
            now, both = (file, block), [Range([], False), Range([], True)]
        for one in both:
            for _ in one.read(text):
                pass
    if now:
        yield rows()


def begins(found: list) -> dict[tuple[str, int], tuple[list, bool]]:
    """How each range begins: the open containers, and whether inside a string."""
    out: dict[tuple[str, int], tuple[list, bool]] = {}
    by_range = {(r["file"], r["block"], r["quoted"]): r for r in found}
    stack, quoted, last = [], False, None
    for file, block in sorted({k[:2] for k in by_range}):
        if file != last:
            stack, quoted, last = [], False, file
        out[file, block] = (stack, quoted)
        row = by_range[file, block, quoted]
        kept = stack[: max(0, len(stack) - row["closed"])]
        stack, quoted = [*kept, *map(tuple, json.loads(row["opened"]))], row["ends_quoted"]
    return out


def read_elements(spark: SparkSession, path: str, field: str, element: str | T.DataType) -> DataFrame:
    """One row for each object in the top-level list ``field`` of the documents at ``path``, parsed as ``element``.

    Equal to reading whole documents and exploding the list, but one document is spread over as many
    tasks as it has byte ranges (``spark.sql.files.maxPartitionBytes``). Documents without the list, and
    empty files, give no row; elements that are no objects or lists are left out.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    known = begins(pieces.mapInArrow(summaries, SUMMARY).collect())  # two short rows a range, as the listing has one

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, reader, out = None, None, []

        def close() -> None:
            if reader is not None and reader.start is not None:  # the element goes on in the next range
                out.append((*now, False, not reader.cut_off, reader.element()))

        def flush() -> pa.RecordBatch:
            types = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.string())
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=["file", "block", "whole", "begins", "text"])

        for file, block, text in ranges(batches):
            if (file, block) != now:
                close()
                now, reader = (file, block), Range(*known[file, block], field)
            out += [(*now, whole, whole, element_text) for whole, element_text in reader.read(text)]
            if len(out) >= 5_000:
                yield flush()
        close()
        if out:
            yield flush()

    texts = pieces.mapInArrow(cut, CUT)
    parts = texts.where(~F.col("whole"))
    run = W.partitionBy("file").orderBy("block", F.col("begins").cast("int"))  # an end comes before the next begin
    joined = (
        parts.withColumn("number", F.sum(F.col("begins").cast("int")).over(run)).groupBy("file", "number")
        .agg(F.array_sort(F.collect_list(F.struct("block", F.col("begins").cast("int").alias("late"), "text"))).alias("parts"))
        .select(F.array_join("parts.text", "").alias("text"))
    )
    everything = texts.where("whole").select("text").unionByName(joined)
    return everything.select(F.from_json("text", element).alias("element")).select("element.*")
