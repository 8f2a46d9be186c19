"""Removal of repeated word sequences by recompression.

In every round two things get new names, alike in all documents: runs of one symbol, and pairs of a
left and a right symbol, where a bit of a symbol's name says which it is. A name is a 64-bit hash of what
it stands for, so tasks agree on all names without a word between them. Whether the border between two
symbols survives a round depends on these two alone; so equal word sequences get equal symbols and
borders, but for a few at either end, and for every border it is known which words have decided it.

Every window is told by its anchor: of the borders of the highest round that its own words decide, the
one whose name is smallest, made of the symbols on both sides and the words that decided it. Windows
with one anchor form a phrase. Spark then finds the anchors that several documents share. Phrases that
agree as a whole are repeats in all documents but the first; where phrases with a common anchor differ,
their windows are compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import grouped_rows, in_few_files, released, slices
from panelcast.session import dropped, written

#: Bytes of text parsed together.
SLICE = 1 << 20
ODD = 0x9E3779B97F4A7C15


def rounds_for(width: int) -> int:
    """Rounds of naming after which a border is decided by 0.4 of a window's words, on average.

    A round leaves three quarters of the borders, and each adds a symbol on both sides to what decides.
    Fewer words would be shared by chance, more leave a window too few borders to choose from.
    """
    rounds, symbol, words = 0, 1.0, 2.0
    while words + 2 * symbol * 4 / 3 <= 0.4 * width:
        rounds, symbol, words = rounds + 1, symbol * 4 / 3, words + 2 * symbol * 4 / 3
    return rounds


def mixed(*parts: np.ndarray | int) -> np.ndarray:
    """One 64-bit name for several numbers in their order."""
    name = np.uint64(0x243F6A8885A308D3)
    for part in parts:
        name = (name ^ np.asarray(part, np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        name = name ^ (name >> np.uint64(29))
        name = name * np.uint64(0x94D049BB133111EB)
        name = name ^ (name >> np.uint64(32))
    return name


class Sums:
    """A 64-bit hash of any stretch of a sequence of names, from prefix sums."""

    def __init__(self, names: np.ndarray):
        count = len(names) + 1
        self.back = self.powers(pow(ODD, -1, 1 << 64), count)
        self.sums = np.zeros(count, np.uint64)
        np.cumsum(names * self.powers(ODD, count)[:-1], out=self.sums[1:])

    @staticmethod
    def powers(base: int, count: int) -> np.ndarray:
        factors = np.full(count, base, np.uint64)
        factors[0] = 1
        return np.cumprod(factors)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start], end - start)


def named(symbols: np.ndarray, dies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and first symbols of the groups that remain when the marked inner borders go.

    A group is a symbol as it was, or a run of one symbol, or a run of a left and one of a right symbol.
    """
    first = np.flatnonzero(np.r_[True, ~dies])
    last = np.r_[first[1:], len(symbols)] - 1
    names = symbols[first].copy()
    turn = last + 1  # where the right symbol begins, if there is one
    change = np.flatnonzero(dies & (symbols[1:] != symbols[:-1])) + 1
    turn[np.searchsorted(first, change, "right") - 1] = change
    many = last > first
    f, t, z = first[many], turn[many], last[many]
    right = np.where(t <= z, symbols[z], np.uint64(0))
    names[many] = mixed(symbols[f], t - f, right, z + 1 - t)
    return names, first


def borders(words: np.ndarray, edges: np.ndarray, width: int) -> list[tuple[np.ndarray, ...]]:
    """For each round the borders that at most ``width`` words decide: ``low, high, key``, in order.

    ``words`` are the names of the words of several texts one after the other, and ``edges`` the places
    where a text begins or ends. Words ``low`` to ``high - 1`` decide that the border is there, and
    the symbols on both sides of it; ``key`` names these and those words.
    """
    sums = Sums(words)
    symbols, at = words, np.arange(len(words) + 1)
    low, high = at.copy(), at.copy()  # what decides that a border is there: nothing as yet
    fixed = np.zeros(len(words) + 1, bool)
    fixed[edges] = True
    rounds = []
    for turn in range(rounds_for(width) + 1):
        inner = np.flatnonzero(~fixed[1:-1]) + 1
        near, far = low[inner - 1], high[inner + 1]
        known = (far - near <= width) & (near >= 0) & (far <= len(words))
        inner, near, far = inner[known], near[known], far[known]
        rounds.append((near, far, mixed(symbols[inner - 1], symbols[inner], sums(near, far), at[inner] - near, turn)))
        right = (mixed(symbols, turn) & np.uint64(1)).astype(bool)
        dies = ((symbols[1:] == symbols[:-1]) | (~right[:-1] & right[1:])) & ~fixed[1:-1]
        # a border that stays was decided by its neighbours; that of a text lies outside all windows
        low, high = np.r_[low[:1], low[:-1]], np.r_[high[1:], high[-1:]]
        low[fixed], high[fixed] = at[fixed] - 1, at[fixed] + 1
        symbols, _ = named(symbols, dies)
        stays = np.r_[True, ~dies, True]
        at, low, high, fixed = at[stays], low[stays], high[stays], fixed[stays]
    return rounds


def phrases(words: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """``text, start, count, key, phrase`` of the phrases of several texts of ``sizes`` words.

    A phrase is ``count`` windows from word ``start`` of its text on; ``key`` names their anchor and
    ``phrase`` all their words.
    """
    begins = np.r_[0, np.cumsum(sizes)]
    counts = np.maximum(sizes - width + 1, 0)
    text = np.repeat(np.arange(len(sizes)), counts)
    windows = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + begins[text]
    if not len(windows):
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    anchor, key = np.full(len(windows), -1), np.empty(len(windows), np.uint64)
    left = np.arange(len(windows))
    rounds = borders(words, np.unique(begins), width)
    for turn, (low, high, name) in reversed(list(enumerate(rounds))):
        # a window's borders are neighbours: from the first that begins in it to the last that ends in it
        first = np.searchsorted(low, windows[left])
        end = np.searchsorted(high, windows[left] + width, "right")
        left, first, end = left[end > first], first[end > first], end[end > first]
        best, least = first.copy(), name[first]
        for step in range(1, int((end - first).max(initial=0))):
            more = np.flatnonzero(first + step < end)
            other = name[first[more] + step]
            less = other < least[more]
            best[more[less]], least[more[less]] = first[more[less]] + step, other[less]
        anchor[left], key[left] = best * len(rounds) + turn, least
        left = np.flatnonzero(anchor < 0)
    first = np.flatnonzero(np.r_[True, (np.diff(anchor) != 0) | (np.diff(text) != 0)])
    count = np.diff(np.r_[first, len(windows)])
    start = windows[first]
    return text[first], start - begins[text[first]], count, key[first], Sums(words)(start, start + count + width - 1)


class Words:
    """Words of texts as 64-bit names; those of a slice of texts are named together."""

    def __init__(self, texts: list[str | None]):
        import xxhash

        split = [(t or "").encode().split() for t in texts]
        number: dict[bytes, int] = {}
        ids = [number.setdefault(w, len(number)) for words in split for w in words]
        names = np.array([xxhash.xxh64_intdigest(w) for w in number], np.uint64)
        self.names = names[np.array(ids, np.int64)] if ids else np.empty(0, np.uint64)
        self.sizes = np.array([len(words) for words in split], np.int64)
        self.split = split


def parsed(texts: DataFrame, width: int) -> DataFrame:
    """``key, phrase, doc_id, version, start, count`` of every phrase."""

    @released
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, SLICE):
                words = Words(batch.column("text").to_pylist())
                text, start, count, key, phrase = phrases(words.names, words.sizes, width)
                at = pa.array(text)
                yield pa.RecordBatch.from_arrays([
                    pa.array(key.view(np.int64)), pa.array(phrase.view(np.int64)), batch.column("doc_id").take(at),
                    batch.column("version").take(at), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32)),
                ], names=["key", "phrase", "doc_id", "version", "start", "count"])

    kind = dict(texts.dtypes)["doc_id"]
    return texts.mapInArrow(parse, f"key long, phrase long, doc_id {kind}, version long, start int, count int")


def windows(texts: DataFrame, asked: DataFrame, width: int) -> DataFrame:
    """``key, window, doc_id, version, start, count``: each window of the phrases asked for, named by its words."""
    wanted = asked.groupBy("doc_id", "version").agg(F.collect_list(F.struct("key", "start", "count")).alias("asked"))

    @released
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, SLICE):
                words = Words(batch.column("text").to_pylist())
                lists = batch.column("asked")
                begins = np.r_[0, np.cumsum(words.sizes)[:-1]]
                text = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
                rows = lists.flatten()
                start, count = (rows.field(c).to_numpy().astype(np.int64) for c in ("start", "count"))
                own = np.repeat(np.arange(len(text)), count)
                place = start[own] + np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
                begin = begins[text[own]] + place
                names = Sums(words.names)(begin, begin + width)
                yield pa.RecordBatch.from_arrays([
                    rows.field("key").take(pa.array(own)), pa.array(names.view(np.int64)), batch.column("doc_id").take(pa.array(text[own])),
                    batch.column("version").take(pa.array(text[own])), pa.array(place.astype(np.int32)), pa.array(np.ones(len(own), np.int32)),
                ], names=["key", "window", "doc_id", "version", "start", "count"])

    kind = dict(texts.dtypes)["doc_id"]
    return texts.join(wanted, ["doc_id", "version"]).select("doc_id", "version", "text", "asked").mapInArrow(
        fetch, f"key long, window long, doc_id {kind}, version long, start int, count int"
    )


def repeats(texts: DataFrame, width: int) -> DataFrame:
    """``doc_id, version, start, count``: the windows that also start in a document with a smaller id."""
    parse = written(parsed(texts, width), "parse")
    count = parse.count()
    by_key = parse.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    shared = written(in_few_files(by_key.filter("least < most").select("key", "n"), count), "shared")
    # phrases whose anchor several documents hold: the first document of each phrase, the phrases of each anchor
    met = written(in_few_files(grouped_rows(parse, shared, ["key"]), count), "met")
    dropped(parse)
    count = met.count()
    by_phrase = met.groupBy("key", "phrase").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))
    firsts = written(in_few_files(by_phrase, count), "firsts")
    several = firsts.groupBy("key").agg(F.count(F.lit(1)).alias("phrases"), F.sum("n").alias("n")).filter("phrases > 1")
    places = ("doc_id", "version", "start", "count")
    compared = written(in_few_files(grouped_rows(met, firsts, ["key", "phrase"]), count), "compared")
    dropped(met)
    whole = compared.filter("doc_id > first").select(*places)
    open_ = compared.filter("doc_id = first").select("key", *places)
    asked = grouped_rows(open_, written(in_few_files(several.select("key", "n"), count), "several"), ["key"])
    single = written(in_few_files(windows(texts, asked, width), count, 50_000), "windows")
    by_window = single.groupBy("key", "window").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    common = written(in_few_files(by_window.filter("first < last").select("key", "window", "n", "first"), single.count()), "common")
    later = grouped_rows(single, common, ["key", "window"]).filter("doc_id > first").select(*places)
    return whole.union(later)


def deduplicated(docs: DataFrame, width: int = 13, with_kept: bool = True) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` and, if asked for, the ``kept`` words of every row.

    A word goes if some ``width`` words that cover it also start in a document with a smaller
    ``doc_id``; what is left is joined by one space. Null texts have no words, shorter ones lose
    nothing, and repetitions inside one document stay. Rows that share a ``doc_id`` remove nothing from
    each other; a null ``doc_id`` is neither smaller nor larger than others, so its rows neither lose
    nor remove anything. Columns other than ``doc_id`` and ``text`` are not read; no rows give no rows.
    """
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.xxhash64("text").alias("version"), "text")
    # identical rows are one document, and the version tells apart texts that share an id
    texts = rows.filter("doc_id IS NOT NULL AND text IS NOT NULL")
    gone = repeats(texts, width).groupBy("doc_id", "version").agg(F.collect_list(F.struct("start", "count")).alias("gone"))

    names = ["doc_id", "n_words", "n_removed", "kept_sha256", *["kept"] * with_kept]
    types = [pa.int64(), pa.int64(), pa.string(), *[pa.binary()] * with_kept]

    @released
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, SLICE):
                found = []
                for text, ranges in zip(batch.column("text").to_pylist(), batch.column("gone"), strict=True):
                    words = (text or "").encode().split()
                    kept = words
                    if ranges.is_valid:
                        start = ranges.values.field("start").to_numpy()
                        steps = np.zeros(len(words) + 1, np.int64)
                        np.add.at(steps, start, 1)
                        np.add.at(steps, start + ranges.values.field("count").to_numpy() + width - 1, -1)
                        kept = [words[i] for i in np.flatnonzero(np.cumsum(steps)[:-1] == 0).tolist()]
                    joined = b" ".join(kept)
                    found.append((len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), joined))
                columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=False)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=names)

    out = rows.join(gone, ["doc_id", "version"], "left").select("doc_id", "text", "gone")
    return out.mapInArrow(cut, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept binary" * with_kept)
