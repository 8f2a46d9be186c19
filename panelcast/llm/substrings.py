"""Exact removal of repeated byte strings by prefix-free parsing.

A rolling hash over the bytes has a trigger in every window of ``length`` bytes: the place of its
smallest value there. Triggers cut a text into phrases that overlap so far that every window lies
whole in exactly one phrase, the one of its trigger. Equal windows have the same trigger at the same
place, so only phrases with a common trigger hash need be compared.

The parse, one short row for each phrase, is sorted by trigger, phrase and place in the corpus. That
alone decides phrases that occur again as a whole, most of highly repetitive text. What is left is
the dictionary of different phrases with a common trigger: their suffixes are sorted, neighbours
that agree in ``length`` bytes are copies, and the place of the phrase in the corpus says which of
them come later.

A trigger in a passage that very many documents share has as many different phrases, since a phrase
reaches into the text around the passage. Such hot triggers are found by a count of the parse; their
phrases are dealt one by one, and their windows, named by 128-bit hashes, are compared by a grouped
minimum, so no task sees all of one trigger.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import HOT_SHARE, grouped_rows, in_few_files, released, shuffle_width
from panelcast.session import dropped, written

#: Bytes under the rolling hash.
GRAM = 24
#: Windows hashed at a time; a longer text is parsed piece by piece.
PIECE = 1 << 20
#: Most different phrases of one trigger that a task sorts; more are compared window by window.
MOST = 100_000
PARSE = "doc_id {0}, version long, start long, shape int, trigger long, phrase long, again boolean"
MARKS = "doc_id {0}, version long, start long, shape int, trigger long, mixed boolean, hot boolean"
RANGES = "doc_id {0}, version long, start long, windows long, window binary"


def rolling(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every ``GRAM`` bytes."""
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, 8)).view("<u8")[:, 0]
    count = len(data) - GRAM + 1
    mixed = words[:count] * np.uint64(0x9E3779B97F4A7C15)
    for step in range(8, GRAM, 8):
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= words[step : step + count] * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0x94D049BB133111EB)
    return mixed ^ (mixed >> np.uint64(29))


def phrases(text: bytes, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """First window, number of windows, trigger's distance from the first window and trigger hash of each phrase.

    A phrase of ``n`` windows from ``s`` on is ``text[s : s + n - 1 + length]``.
    """
    reach = length - GRAM + 1
    for begin in range(0, len(text) - length + 1, PIECE):
        data = np.frombuffer(text, np.uint8, min(PIECE + length - 1, len(text) - begin), begin)
        hashes = rolling(data)
        windows = len(data) - length + 1
        # leftmost smallest: the place in the low bits breaks ties
        ranked = (hashes & ~np.uint64(0x1FFFFF)) | np.arange(len(hashes), dtype=np.uint64)
        padded = np.full(-(-len(ranked) // reach) * reach, np.iinfo(np.uint64).max)
        padded[: len(ranked)] = ranked
        rows = padded.reshape(-1, reach)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:windows], ahead[reach - 1 : reach - 1 + windows])
        first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        place = (least[first] & np.uint64(0x1FFFFF)).astype(np.int64)
        yield first + begin, np.diff(np.r_[first, windows]), place - first, hashes[place]


def version(text: Column) -> Column:
    """Tells texts apart that share a ``doc_id``."""
    return F.xxhash64(text)


def parsed(docs: DataFrame, length: int) -> DataFrame:
    """The parse of all texts: ``doc_id, version, start, shape, trigger, phrase, again``.

    ``shape`` is the number of windows plus 1024 times the trigger's distance from the first. A phrase
    that stands further back than an equal one in the rows a task has at hand is known to repeat:
    it is marked ``again`` and need not meet the others of its trigger, however many they are.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for whole in batches:
            ids, versions = whole.column("doc_id"), whole.column("version")
            texts = whole.column("text")
            for i in range(whole.num_rows):
                text = texts[i].as_py().encode()
                for start, count, ahead, trigger in phrases(text, length):
                    ends = start + count - 1 + length
                    digests = [xxhash.xxh64_intdigest(text[a:b]) for a, b in zip(start.tolist(), ends.tolist(), strict=True)]
                    at = pa.array(np.full(len(start), i))
                    yield pa.RecordBatch.from_arrays([
                        ids.take(at), versions.take(at), pa.array(start), pa.array((count + 1024 * ahead).astype(np.int32)),
                        pa.array(trigger.view(np.int64)), pa.array(np.array(digests, np.uint64).view(np.int64)),
                    ], names=["doc_id", "version", "start", "shape", "trigger", "phrase"])

    def combined(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        places = [(c, "ascending") for c in ("doc_id", "version", "start")]
        rows = rows.take(pc.sort_indices(rows, places, null_placement="at_start")).combine_chunks()
        trigger, phrase = rows.column("trigger").to_numpy(), rows.column("phrase").to_numpy()
        order = np.lexsort((phrase, trigger))  # stable: equal phrases stay in the order of the corpus
        equal = (np.diff(trigger[order]) == 0) & (np.diff(phrase[order]) == 0)
        start = rows.column("start").to_numpy()[order]
        doc = pc.rank(rows.column("doc_id"), tiebreaker="dense").to_numpy()[order]
        identical = (np.diff(start) == 0) & (np.diff(doc) == 0)  # rows of one document, or nearly so: left for later
        again = np.zeros(len(order), bool)
        again[order[1:]] = equal & ~identical
        yield from rows.append_column("again", pa.array(again)).to_batches()

    @released
    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in parse(batches):
            held.append(batch)
            rows += batch.num_rows
            if rows >= 50_000:
                yield from combined(held)
                held, rows = [], 0
        if held:
            yield from combined(held)

    return docs.mapInArrow(grouped, PARSE.format(dict(docs.dtypes)["doc_id"]))


def hot_triggers(parse: DataFrame, share: int = HOT_SHARE, sample: int = 64) -> DataFrame:
    """``trigger`` of those with more than one in ``share`` of all phrases, by a count of one different phrase in ``sample``.

    Which are hot decides only where rows are dealt, not what is found, so an estimate will do. There are
    about ``share`` of them at most.
    """
    rows = parse.count()
    least = max(4, rows // share // sample)
    some = parse.filter("NOT again").filter(F.pmod("phrase", F.lit(sample)) == 0)
    counts = some.groupBy("trigger").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > least)
    return written(in_few_files(counts.select("trigger"), rows // sample), "hot")


def marked(parse: DataFrame, hot: DataFrame) -> DataFrame:
    """Phrases that repeat an earlier one as a whole, and those (``mixed``) that share a trigger with others.

    Phrases of a hot trigger are dealt by themselves and taken for mixed.
    """
    kind = dict(parse.dtypes)["doc_id"]
    columns = ["doc_id", "version", "start", "shape", "trigger"]
    parse = parse.join(F.broadcast(hot.withColumn("hot", F.lit(True))), "trigger", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    deal = F.when(F.col("again"), F.xxhash64("doc_id", "start")).when(F.col("hot"), F.xxhash64("trigger", "phrase")).otherwise(F.col("trigger"))
    dealt = parse.select(*columns, "phrase", "again", "hot").repartition(shuffle_width(parse.sparkSession), deal).sortWithinPartitions(
        "trigger", "phrase", "doc_id", "version", "start"
    )

    def sent_on(rows: pa.RecordBatch, mixed: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [*(rows.column(c) for c in columns), pa.array([mixed] * rows.num_rows), rows.column("hot")], names=[*columns, "mixed", "hot"]
        )

    @released
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        previous = None  # the last row
        tail, tail_sent = None, False  # the last different phrase; one more with its trigger makes it mixed
        for whole in batches:
            known = whole.column("again")
            batch = whole.filter(pc.invert(known))
            if batch.num_rows < whole.num_rows:
                yield sent_on(whole.filter(known), False)
            if not batch.num_rows:
                continue
            rows = batch if previous is None else pa.concat_batches([previous, batch])
            trigger, phrase = rows.column("trigger").to_numpy(), rows.column("phrase").to_numpy()
            again = (trigger[1:] == trigger[:-1]) & (phrase[1:] == phrase[:-1])
            identical = again.copy()
            for name in ("doc_id", "version", "start"):
                place = pc.rank(rows.column(name), tiebreaker="dense").to_numpy()
                identical &= place[1:] == place[:-1]
            if previous is None:
                again, identical = np.r_[False, again], np.r_[False, identical]
            else:
                rows = batch
            previous = batch.slice(batch.num_rows - 1, 1)
            repeats = rows.filter(pa.array(again & ~identical))
            different = rows.filter(pa.array(~again))
            if tail is not None:
                different = pa.concat_batches([tail, different])
            shared = different.column("trigger").to_numpy()
            equal = shared[1:] == shared[:-1]
            mixed = np.r_[False, equal] | np.r_[equal, False] | different.column("hot").to_numpy(zero_copy_only=False)
            sent = mixed.copy()
            sent[0] &= not tail_sent
            tail, tail_sent = different.slice(len(mixed) - 1, 1), bool(mixed[-1] or (len(mixed) == 1 and tail_sent))
            for part, flag in ((repeats, False), (different.filter(pa.array(sent)), True)):
                if part.num_rows:
                    yield sent_on(part, flag)

    return dealt.mapInArrow(mark, MARKS.format(kind))


def copied_windows(members: list[tuple[int, int, bytes]], length: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each phrase of one trigger the windows that an earlier phrase holds too.

    ``members`` are windows, the trigger's distance and the bytes of the phrases, in corpus order.
    Windows that agree have the trigger at the same place, so suffixes are sorted for one place at
    a time; among neighbours that agree in ``length`` bytes all but the first are copies.
    """
    found: dict[int, list[int]] = {}
    for place in range(max(ahead for _, ahead, _ in members), min(ahead - count for count, ahead, _ in members), -1):
        suffixes = sorted(
            (data[ahead - place : ahead - place + length], i)
            for i, (count, ahead, data) in enumerate(members) if 0 <= ahead - place < count
        )
        for (one, _), (two, i) in zip(suffixes, suffixes[1:], strict=False):
            if one == two:
                found.setdefault(i, []).append(members[i][1] - place)
    for i, windows in found.items():
        yield i, np.array(windows)


def copies(contexts: DataFrame, length: int, most: int) -> DataFrame:
    """Ranges of copied windows among the phrases ``trigger, doc_id, version, start, shape, data``.

    A trigger with more than ``most`` phrases is not held: its windows go out with their bytes,
    one range each, and are compared by a grouped minimum.
    """
    kind = dict(contexts.dtypes)["doc_id"]
    dealt = contexts.repartition(shuffle_width(contexts.sparkSession), "trigger").sortWithinPartitions(
        "trigger", "doc_id", "version", "start"
    )

    @released
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, last, held, large = None, None, [], False
        out: list[tuple] = []

        def flush():
            types = [ids, pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "version", "start", "windows", "window"])

        def close():
            if len(held) > 1:
                members = [(shape % 1024, shape // 1024, data) for _, _, _, shape, data in held]
                for i, at in copied_windows(members, length):
                    at.sort()
                    runs = np.flatnonzero(np.r_[True, np.diff(at) != 1])
                    for first, windows in zip(at[runs], np.diff(np.r_[runs, len(at)]), strict=True):
                        out.append((*held[i][:2], held[i][2] + int(first), int(windows), None))

        for batch in batches:
            ids = batch.schema.field("doc_id").type
            for trigger, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if trigger != now:
                    close()
                    now, last, held, large = trigger, None, [], False
                if row[:3] == last:  # a row of an identical document
                    continue
                last = row[:3]
                held.append(row)
                if large or len(held) > most:
                    for doc, text, start, shape, data in held:
                        out += [(doc, text, start + i, 1, data[i : i + length]) for i in range(shape % 1024)]
                        if len(out) > 20_000:
                            yield flush()
                    held, large = [], True
                if len(out) > 20_000:
                    yield flush()
        close()
        if out:
            yield flush()

    columns = ("trigger", "doc_id", "version", "start", "shape", "data")
    return dealt.select(*columns).mapInArrow(compare, RANGES.format(kind))


def later(open_: DataFrame) -> DataFrame:
    """Of windows ``window, doc_id, version, start, windows`` those that also start earlier, without their names."""
    place = F.struct("doc_id", "version", "start")
    groups = open_.groupBy("window").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).filter("n > 1")
    met = grouped_rows(open_, written(in_few_files(groups, open_.count()), "common"), ["window"])
    return met.filter(place > F.col("first")).select("doc_id", "version", "start", "windows")


def deduplicated(docs: DataFrame, length: int = 100, most: int = MOST, with_kept: bool = True, share: int = HOT_SHARE) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, if asked for, the ``kept`` bytes of every row.

    A byte goes if some ``length`` bytes that cover it also start earlier: in a document with a
    smaller ``doc_id``, or before in the same one. Null texts count as empty, shorter texts lose
    nothing. A null ``doc_id`` comes before all others; rows with one ``doc_id`` but different texts
    are ordered by a hash of the text, and identical rows are one document and lose the same bytes.
    Triggers with more than one in ``share`` of all phrases are hot; this and ``most`` change no result.
    Columns other than ``doc_id`` and ``text`` are not read; no rows give no rows.
    """
    kind = dict(docs.dtypes)["doc_id"]
    text = F.coalesce("text", F.lit(""))
    texts = docs.select("doc_id", version(text).alias("version"), text.alias("text"))
    parse = written(parsed(texts, length), "parse")
    marks = written(in_few_files(marked(parse, hot_triggers(parse, share)), parse.count()), "marks")
    dropped(parse)
    wanted = marks.filter("mixed").groupBy("doc_id", "version").agg(
        F.collect_list(F.struct("trigger", "start", "shape", "hot")).alias("asked")
    )

    @released
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bytes of the phrases asked for; of those of hot triggers each window's hash, with no shape."""
        import xxhash

        for batch in batches:
            asked, all_texts = batch.column("asked"), batch.column("text")
            for i in range(batch.num_rows):
                data = all_texts[i].as_py().encode()
                rows = asked[i].values
                start, shape = rows.field("start").to_numpy(), rows.field("shape").to_numpy()
                hot = rows.field("hot").to_numpy(zero_copy_only=False)
                places = np.concatenate([start[~hot], *(a + np.arange(n) for a, n in zip(start[hot], shape[hot] % 1024, strict=True))]).astype(np.int64)
                cold = int((~hot).sum())
                cut = [data[a : a + n + length - 1] for a, n in zip(start[~hot].tolist(), (shape[~hot] % 1024).tolist(), strict=True)]
                cut += [xxhash.xxh128_digest(data[a : a + length]) for a in places[cold:].tolist()]
                at = pa.array(np.full(len(places), i))
                trigger, shapes = np.zeros(len(places), np.int64), np.zeros(len(places), np.int32)
                trigger[:cold], shapes[:cold] = rows.field("trigger").to_numpy()[~hot], shape[~hot]
                yield pa.RecordBatch.from_arrays([
                    pa.array(trigger), batch.column("doc_id").take(at), batch.column("version").take(at),
                    pa.array(places), pa.array(shapes), pa.array(cut, pa.binary()),
                ], names=["trigger", "doc_id", "version", "start", "shape", "data"])

    def same(left: DataFrame, right: DataFrame) -> Column:
        return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["version"] == right["version"])

    once = texts.join(wanted, same(texts, wanted)).select(texts["doc_id"], texts["version"], "text", "asked")
    fetched = once.mapInArrow(fetch, f"trigger long, doc_id {kind}, version long, start long, shape int, data binary")
    contexts = written(in_few_files(fetched, marks.filter("mixed").count(), 50_000), "contexts")
    whole = marks.filter("NOT mixed").select("doc_id", "version", "start", (F.col("shape") % 1024).cast("long").alias("windows"))
    found = written(in_few_files(copies(contexts.filter("shape > 0"), length, most), contexts.count(), 50_000), "ranges")
    places = ("window", "doc_id", "version", "start", "windows")
    hot_windows = contexts.filter("shape = 0").withColumn("windows", F.lit(1).cast("long")).withColumnRenamed("data", "window")
    ranges = whole.union(found.filter("window IS NULL").select(*places[1:]))
    for open_ in (found.filter("window IS NOT NULL"), hot_windows):
        ranges = ranges.union(later(open_.select(*places)))
    gone = ranges.groupBy("doc_id", "version").agg(F.collect_list(F.struct("start", "windows")).alias("gone"))

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_kept]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), *[pa.binary()] * with_kept]

    @released
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text_, gone_ in zip(batch.column("text"), batch.column("gone"), strict=True):
                data = text_.as_py().encode()
                if not gone_.is_valid:
                    rows.append((len(data), 0, 0, hashlib.sha256(data).hexdigest(), data))
                    continue
                start = gone_.values.field("start").to_numpy()
                end = start + gone_.values.field("windows").to_numpy() + length - 1
                steps = np.zeros(len(data) + 1, np.int64)
                np.add.at(steps, start, 1)
                np.add.at(steps, end, -1)
                covered = np.cumsum(steps)[:-1] > 0
                kept = np.frombuffer(data, np.uint8)[~covered].tobytes()
                spans = int(np.count_nonzero(covered & ~np.r_[False, covered[:-1]]))
                rows.append((len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=False)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=names)

    out = texts.join(gone, same(texts, gone), "left").select(texts["doc_id"], "text", "gone")
    return out.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_kept)
