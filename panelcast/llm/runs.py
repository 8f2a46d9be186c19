"""Periodic runs of words by difference-cover LCE queries on a harmonic grid.

A run of period ``q`` that is three periods long covers two neighbouring points ``kq`` and
``(k + 1)q`` of the grid of its period, whatever its place, so all periods together have only a
harmonic sum of points to look at. Points whose words differ from the next two are passed over. From
the others the run is grown both ways by the longest common extension (LCE) of the two places.

LCE queries sort only the suffixes that begin in a difference cover: residues modulo 13 such that any
two places reach sampled ones after the same few steps. Those steps are compared word by word, the
rest is a minimum over the sorted samples' common prefixes, from a sparse table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import released, slices

#: Every difference modulo 13 is one between two of these residues.
COVER, MODULUS = (0, 1, 3, 9), 13
#: Bytes of text handled together, and most grid points or queries held at a time.
SLICE, HELD = 1 << 20, 1 << 20


def steps_to_samples() -> np.ndarray:
    """For each pair of residues the fewest steps after which both are in the cover."""
    sampled = np.isin(np.arange(MODULUS), COVER)
    steps = np.zeros((MODULUS, MODULUS), np.int64)
    for i in range(MODULUS):
        for j in range(MODULUS):
            steps[i, j] = next(s for s in range(MODULUS) if sampled[(i + s) % MODULUS] and sampled[(j + s) % MODULUS])
    return steps


class Extensions:
    """Longest common extensions between places of a sequence of positive numbers.

    The last number must stand nowhere else, so that no two suffixes are equal.
    """

    def __init__(self, sequence: np.ndarray):
        self.length = len(sequence)
        self.words = np.concatenate([sequence, np.zeros(2 * MODULUS, np.int64)])
        self.steps = steps_to_samples()
        places = np.flatnonzero(np.isin(np.arange(self.length) % MODULUS, COVER))
        self.rank, levels = self.sorted(places)
        order = np.empty(len(places), np.int64)
        order[self.rank[places] - 1] = places
        self.minima = [self.prefixes(order, levels)]
        while 2 * (1 << len(self.minima) - 1) <= len(places):  # sparse table: minima of twice as many
            last, half = self.minima[-1], 1 << len(self.minima) - 1
            self.minima.append(np.minimum(last[:-half], last[half:]))

    def sorted(self, places: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Ranks from 1 of the sampled suffixes by place (0 elsewhere), and those by 13, 26, 52... words."""
        base = int(self.words.max()) + 1
        together = max(1, int(63 / np.log2(base + 1)))
        keys = []
        for start in range(0, MODULUS, together):
            key = np.zeros(len(places), np.int64)
            for step in range(start, min(MODULUS, start + together)):
                key = key * base + self.words[places + step]
            keys.append(key)
        levels, width = [], MODULUS
        while True:
            order = np.lexsort(keys[::-1])
            new = np.zeros(len(places), bool)
            for key in keys:
                new[1:] |= key[order[1:]] != key[order[:-1]]
            rank = np.zeros(self.length + 1, np.int32)
            rank[places[order]] = np.cumsum(new) + 1
            levels.append(rank)
            if not len(places) or rank[places].max() == len(places):
                return rank, levels
            keys = [rank[places], rank[np.minimum(places + width, self.length)]]
            width *= 2

    def prefixes(self, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefix of each sorted sample and the one before it."""
        a, b = order[:-1], order[1:]
        shared = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            x, y = (levels[k][np.minimum(side + shared, self.length)] for side in (a, b))
            shared += np.where((x == y) & (x > 0), MODULUS << k, 0)
        return self.compared(a, b, shared, np.full(len(a), MODULUS))

    def compared(self, a: np.ndarray, b: np.ndarray, shared: np.ndarray, most: np.ndarray) -> np.ndarray:
        """``shared`` plus the equal words that follow, up to ``most`` in all of these."""
        open_, total = np.arange(len(a)), shared.copy()
        for step in range(int(most.max(initial=0))):
            open_ = open_[most[open_] > step]
            at = shared[open_] + step
            open_ = open_[self.words[np.minimum(a[open_] + at, self.length)] == self.words[np.minimum(b[open_] + at, self.length)]]
            if not len(open_):
                break
            total[open_] += 1
        return total

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from places ``a`` and ``b`` on agree; no pair is of equal places."""
        steps = self.steps[a % MODULUS, b % MODULUS]
        total = self.compared(a, b, np.zeros(len(a), np.int64), steps)
        far = np.flatnonzero(total == steps)
        x, y = self.rank[a[far] + steps[far]] - 1, self.rank[b[far] + steps[far]] - 1
        low, high = np.minimum(x, y), np.maximum(x, y)  # the minimum over prefixes low .. high - 1
        level = np.frexp((high - low).astype(float))[1] - 1
        least = np.zeros(len(far), np.int64)
        for k in np.unique(level):
            at = level == k
            table = self.minima[k]
            least[at] = np.minimum(table[low[at]], table[high[at] - (1 << int(k))])
        total[far] += least
        return total


def grid(words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``place, period`` of grid points whose word is that of the next two points of their period."""
    n = len(words)
    edge = min(n // 3, int(n**0.5))
    for period in range(1, edge + 1):
        same = words[:-period:period][: (n - 1) // period] == words[period::period]
        at = np.flatnonzero(same[:-1] & same[1:]) * period
        yield at, np.full(len(at), period)
    for k in range(n // (edge + 1)):  # longer periods: the k-th point of all of them
        periods = np.arange(edge + 1, min(n // 3, (n - 1) // (k + 2)) + 1)
        if not len(periods):
            break
        first = words[k * periods]
        same = (first == words[(k + 1) * periods]) & (first == words[(k + 2) * periods])
        yield k * periods[same], periods[same]


def gathered(texts: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``text, place, period`` of the grid points of several texts, a bounded number at a time."""
    held, count = [], 0
    for i, words in enumerate(texts):
        if len(words) < 3:
            continue
        for place, period in grid(words):
            if len(place):
                held.append((np.full(len(place), i), place, period))
                count += len(place)
            if count >= HELD:
                yield tuple(np.concatenate(c) for c in zip(*held, strict=True))
                held, count = [], 0
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held, strict=True))


def found_runs(texts: list[np.ndarray], least: int = 24, repeats: int = 3) -> list[np.ndarray]:
    """For each text, rows ``start, length, period`` of its runs, by start, then period.

    Texts are arrays of positive numbers. A run has at least ``least`` words and ``repeats`` (3 or
    more) of its smallest period, and no word beside it continues the period.
    """
    none = np.empty((0, 3), np.int64)
    busy = [i for i, words in enumerate(texts) if len(words) >= least and any(len(p) for p, _ in grid(words))]
    out = [none] * len(texts)
    if not busy:
        return out
    some = [texts[i] for i in busy]
    sizes = np.array([len(w) for w in some])
    begins = np.r_[0, np.cumsum(sizes + 1)[:-1]]
    most = max(int(w.max()) for w in some)
    # each text is ended by a number of its own, so no extension leaves it
    joined = np.concatenate([np.append(w, most + 1 + i) for i, w in enumerate(some)])
    forward = Extensions(joined)
    backward = Extensions(np.append(joined[::-1], most + 1 + len(some)))
    runs = np.empty((0, 4), np.int64)
    for text, place, period in gathered(some):
        for k in range(0, len(text), HELD):
            t, p = text[k : k + HELD], period[k : k + HELD]
            at = begins[t] + place[k : k + HELD]
            # backwards from the word before both places; the first word of a text has none
            behind, ahead = np.zeros(len(t), np.int64), forward(at, at + p)
            inner = np.flatnonzero(place[k : k + HELD] > 0)
            mirror = len(joined) - at[inner]
            behind[inner] = np.minimum(backward(mirror - p[inner], mirror), place[k : k + HELD][inner])
            length = behind + ahead + p
            long = (length >= least) & (length >= repeats * p)
            rows = np.column_stack([t, at - begins[t] - behind, length, p])[long]
            runs = np.unique(np.concatenate([runs, rows]), axis=0)
    # a stretch found with several periods counts with its smallest
    runs = runs[np.lexsort(runs.T[::-1])]
    first = np.r_[True, (np.diff(runs[:, :3], axis=0) != 0).any(axis=1)] if len(runs) else np.empty(0, bool)
    runs = runs[first]
    runs = runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]
    edges = np.searchsorted(runs[:, 0], np.arange(len(some) + 1))
    for i, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
        out[busy[i]] = runs[low:high, 1:]
    return out


def planted(n: int, h: int | None) -> np.ndarray | None:
    """Which original word each word becomes in a document whose id hashes to ``h``; None if all stay."""
    if h is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % period
    return at


def collapsed(runs: np.ndarray, n: int) -> np.ndarray:
    """Places of the words that no run holds after its first period."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    return np.flatnonzero(np.cumsum(steps)[:-1] == 0)


def strongest(runs: np.ndarray) -> tuple[int, int, int]:
    """The run with the greatest length in periods; of equal ones that with the smallest start, then period."""
    ratio = runs[:, 1] / runs[:, 2]
    near = runs[ratio >= ratio.max() * (1 - 1e-9)].tolist()  # what rounding can hide is compared exactly
    return min(near, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))


SCHEMA = (
    "doc_id {}, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
)


def periodic_runs(docs: DataFrame, hashed: Column | None = None, least: int = 24, repeats: int = 3) -> DataFrame:
    """The runs of every row's text, the strongest of them, digests, and the text without repetitions.

    ``doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256, runs`` and
    ``collapsed``, the kept words joined by one space, in UTF-8. ``hashed`` gives a number a row by
    which repetitions are planted (see ``planted``); without it, or where it is null, texts stay as
    they are. Texts without a word, null ones too, have no run and an empty collapsed text. Every row
    is judged by itself, so repeated rows get equal answers and a null ``doc_id`` is an id like any
    other; other columns are not read, and no rows give no rows.
    """
    kind = dict(docs.dtypes)["doc_id"]
    schema = SCHEMA.format(kind)
    names = [part.split(" ")[0] for part in schema.replace("struct<start:long,length:long,period:long>", "").split(", ")]
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.list_(run), pa.binary()]

    @released
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, SLICE):
                numbers: dict[bytes, int] = {}
                words = [(t or "").encode().split() for t in batch.column("text").to_pylist()]
                arrays = []
                for i, h in enumerate(batch.column("h").to_pylist()):
                    ids = [numbers.setdefault(w, len(numbers) + 1) for w in words[i]]
                    array, at = np.array(ids, np.int64), planted(len(ids), h)
                    if at is not None:
                        array, words[i] = array[at], [words[i][k] for k in at.tolist()]
                    arrays.append(array)
                rows = []
                for own, runs in zip(words, found_runs(arrays, least, repeats), strict=True):
                    best, listed = (None,) * 4, runs.tolist()
                    if listed:
                        start, length, period = strongest(runs)
                        best = (start, length, period, 1000 * length // period)
                        own = [own[k] for k in collapsed(runs, len(own)).tolist()]
                    text = b" ".join(own)
                    lines = "".join(f"{a},{b},{c}\n" for a, b, c in listed)
                    rows.append((
                        len(listed), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(text).hexdigest(),
                        [dict(zip(("start", "length", "period"), r, strict=True)) for r in listed], text,
                    ))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=names)

    h = F.lit(None).cast("long") if hashed is None else hashed.cast("long")
    return docs.select("doc_id", "text", h.alias("h")).mapInArrow(find, schema)
