"""Best-fit packing of token sequences, in bulk-synchronous rounds.

Documents are tokenised and cut into pieces. Pieces and open gaps are kept sorted by size, as runs
of equal size: a round matches every run of pieces with its successor among the gaps, runs that
want the same gap share it by rank, the gaps shrink, and the next round begins. Since sizes are
whole numbers up to the capacity, the runs are bounded by the capacity and not by the rows; every
row finds its place by its rank among the pieces of its length, which Spark counts without
gathering a length.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import numbered, released, slices
from panelcast.session import written

#: Words in each of the two generations a worker remembers, at most some 200 MB together.
WORDS_KEPT = 500_000
#: Bytes of text tokenised at a time; a longer text is cut at white space.
STRETCH = 1 << 17
#: ASCII punctuation but the apostrophe begins a token of its own after a letter or digit.
MARK = re.compile(rb"(?<=[a-z0-9])[!-&(-/:-@\[-`{-~]")
WORD_END = "</w>"
PIECES = "doc_id {}, piece int, start long, length long, ids_crc32 long, row long"


class Encoder:
    """Token ids of whole texts as little-endian bytes, in bounded memory.

    The tokenizer lower-cases, drops white space and never joins what stands on both sides of it,
    nor a letter or digit and the punctuation after it. So a text's ids are those of its words and
    marks in turn, and each of them is encoded once. Added tokens such as ``<|endoftext|>`` are cut
    out of the text as it stands beforehand and give their own ids, as the tokenizer does it.
    """

    def __init__(self, path: str, words_kept: int = WORDS_KEPT):
        # threads of its own would each keep memory, and a task has one core
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word or not t.special for t in added.values()):
            raise ValueError("an added token of the vocabulary is not matched as it stands")
        self.added = {t.content: np.array([i], "<u4").tobytes() for i, t in added.items()}
        self.cuts = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        # lower case can make an added token of what is none in the text
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        # words met lately and those before them: a word met again moves up, the others are forgotten
        self.words_kept = words_kept
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, "<u4") for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: list[bytes]) -> None:
        """Encode words together where each is one run of letters, and the rest one by one.

        Words that stand together are told apart by the tokens that end a word; should there not be
        one for each of them, they are encoded one by one as well.
        """
        letters, alone = [], []
        for word in words:
            (letters if word.isalpha() or word.decode().isalpha() else alone).append(word)
        groups = [letters[i : i + 500] for i in range(0, len(letters), 500)]
        for group, ids in zip(groups, self.encode([b" ".join(g).decode() for g in groups]), strict=True):
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(group):
                alone += group
                continue
            packed, edges = ids.tobytes(), (4 * ends).tolist()
            self.words.update(zip(group, map(packed.__getitem__, map(slice, [0, *edges], edges)), strict=True))
        for word, ids in zip(alone, self.encode([x.decode() for x in alone]), strict=True):
            self.words[word] = ids.tobytes()

    def texts(self, texts: list[str | None]) -> list[bytes]:
        # stretches between added tokens, and the tokens at the odd places
        parts = [self.cuts.split(t) if t and any(map(t.__contains__, self.added)) else [t or ""] for t in texts]
        ids = iter(self.stretches([stretch for part in parts for stretch in part[::2]]))
        return [b"".join(self.added[x] if i % 2 else next(ids) for i, x in enumerate(part)) for part in parts]

    def stretches(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without added tokens, however long one is."""
        if sum(map(len, texts)) <= STRETCH:
            return self.short(texts)
        return [b"".join(self.short([x])[0] for x in cut_at_spaces(text)) for text in texts]

    def short(self, texts: list[str]) -> list[bytes]:
        split = [MARK.sub(rb" \g<0>", text.encode().lower()).split() for text in texts]
        if len(self.words) > self.words_kept:
            self.older, self.words = self.words, {}
        known, before = self.words.get, self.older.get
        found = [list(map(known, words)) for words in split]
        gaps = [[i for i, ids in enumerate(ids_) if ids is None] for ids_ in found]
        missing = {words[i] for words, at in zip(split, gaps, strict=True) for i in at}
        again = {word: ids for word in missing if (ids := before(word)) is not None}
        self.words.update(again)
        self.learn(list(missing - again.keys()))
        for words, ids_, at in zip(split, found, gaps, strict=True):
            for i in at:
                ids_[i] = known(words[i])
        return [b"".join(ids_) for ids_ in found]


SPACE = re.compile(r"[ \t\n\r\f\v]")


def cut_at_spaces(text: str) -> Iterator[str]:
    """The text in stretches of about ``STRETCH`` characters, each but the last ended by white space."""
    start = 0
    while start < len(text):
        found = SPACE.search(text, start + STRETCH)
        end = found.end() if found else len(text)
        yield text[start:end]
        start = end


ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, words_kept: int = WORDS_KEPT) -> Encoder:
    """The one encoder of a worker process."""
    if (path, words_kept) not in ENCODERS:
        ENCODERS.clear()
        ENCODERS[path, words_kept] = Encoder(path, words_kept)
    return ENCODERS[path, words_kept]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, words_kept: int = WORDS_KEPT) -> DataFrame:
    """Cut every document's ids, ended by ``end_id``, into pieces of ``capacity``; the last may be shorter.

    ``doc_id, piece, start, length, ids_crc32`` and ``row``, a hash of the text. A null or empty
    text is the end id alone. ``tokenizer`` is the path of the vocabulary on every machine.
    """
    end = np.array([end_id], "<u4").tobytes()

    @released
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, words_kept)
        for whole in batches:
            for batch in slices(whole, STRETCH):
                rows = [
                    (i, k // capacity, k, min(capacity, n - k), zlib.crc32(ids[4 * k : 4 * (k + capacity)]))
                    for i, ids in enumerate(x + end for x in encode.texts(batch.column("text").to_pylist()))
                    for n in [len(ids) // 4]
                    for k in range(0, n, capacity)
                ]
                at, piece, start, length, crc = zip(*rows, strict=True)
                at = pa.array(at, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(at), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64()), batch.column("row").take(at)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "row"],
                )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text", F.xxhash64("text").alias("row")).mapInArrow(cut, PIECES.format(kind))


@dataclass
class Gap:
    """Sequences ``first`` to ``first + count - 1``, all with the same room left."""

    first: int
    count: int


@dataclass
class Run:
    """Pieces ``rank`` to ``rank + count - 1`` of one length.

    Piece ``i`` of them goes to sequence ``first + i % width``, ``i // width`` lengths after ``offset``.
    """

    length: int
    rank: int
    count: int
    first: int
    width: int
    offset: int


def matched(counts: dict[int, int], capacity: int) -> list[Run]:
    """Place ``counts[length]`` pieces of each length, longest first.

    A round takes the pieces of one length. Their successor among the sorted gaps, the smallest that
    holds them, is filled first: pieces that want the same gaps share them by rank, as many to a
    sequence as fit, and what is left over goes on to the next larger gaps and then to new
    sequences. The shrunk gaps are sorted in before the next round.
    """
    runs: list[Run] = []
    gaps: dict[int, list[Gap]] = defaultdict(list)
    rooms: list[int] = []
    sequences = 0

    def open_gap(room: int, first: int, count: int) -> None:
        if room and count:
            if room not in gaps:
                bisect.insort(rooms, room)
            gaps[room].append(Gap(first, count))

    for length in sorted(counts, reverse=True):
        rank, left, shrunk = 0, counts[length], []
        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):  # nothing holds this length
                need = -(-left // (capacity // length))
                open_gap(capacity, sequences, need)
                sequences += need
                continue
            room = rooms[at]
            gap, fits = gaps[room].pop(), room // length
            if not gaps[room]:
                del gaps[room]
                rooms.pop(at)
            full = min(gap.count, left // fits)
            if full:
                runs.append(Run(length, rank, full * fits, gap.first, full, capacity - room))
                shrunk.append((room - fits * length, gap.first, full))
                rank, left = rank + full * fits, left - full * fits
            if full < gap.count:
                rest = 1 if left else 0  # fewer pieces are left than one sequence holds
                if rest:
                    runs.append(Run(length, rank, left, gap.first + full, 1, capacity - room))
                    shrunk.append((room - left * length, gap.first + full, 1))
                    left = 0
                open_gap(room, gap.first + full + rest, gap.count - full - rest)
        for change in shrunk:
            open_gap(*change)
    return runs


def packed(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, words_kept: int = WORDS_KEPT) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece.

    A null text counts as empty, rows that share a ``doc_id`` are packed each for itself, an empty
    table gives no rows, and other columns are not read. Which of several pieces of one length goes
    where is decided by ``doc_id``, text and piece number. ``words_kept`` trades memory of the workers
    for time and changes no result.
    """
    cut = written(pieces(docs, tokenizer, capacity, end_id, words_kept), "pieces")
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = sorted(matched(counts, capacity), key=lambda r: (r.length, r.rank))
    plan = np.array([(r.length << 40 | r.rank, r.rank, r.first, r.width, r.offset) for r in runs], np.int64).reshape(-1, 5)
    order = [F.col("doc_id"), F.col("row"), F.col("piece")]
    ranked = numbered(cut, ["length"], F.struct("doc_id", "row", "piece"), order, "rank")

    @released
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            _, start, first, width, offset = plan[np.searchsorted(plan[:, 0], length << 40 | rank, "right") - 1].T
            inside = rank - start
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array(first + inside % width), pa.array(offset + inside // width * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
