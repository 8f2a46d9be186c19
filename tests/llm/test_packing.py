import random
import zlib
from collections import defaultdict

import numpy as np
from cases import ODD, SCHEMA, SF, clashing, docs, prose, table
from hypothesis import given, settings
from hypothesis import strategies as st

from panelcast.llm import packing, queries

PATH = queries.word_tokenizer()


def plain_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]


def check(rows, texts, capacity=2048):
    """The pieces give back every id, sequences have no hole, none is too long."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    ids = dict(zip(texts, plain_ids(texts.values()), strict=True))
    assert set(by_doc) == set(ids)
    for doc, parts in by_doc.items():
        parts.sort(key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(-(-len(ids[doc]) // capacity)))
        for r in parts:
            want = ids[doc][r.piece * capacity : (r.piece + 1) * capacity]
            assert (r.start, r.length) == (r.piece * capacity, len(want))
            assert r.ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence), sum(map(len, ids.values()))


def best_fit(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [i for i, room in enumerate(rooms) if room >= length]
        if fitting:
            rooms[min(fitting, key=rooms.__getitem__)] -= length
        else:
            rooms.append(capacity - length)
    return len(rooms)


def test_query_packs_every_id(spark):
    rows = queries.op5_best_fit_packing(spark, SF).collect()
    sequences, tokens = check(rows, {r.doc_id: r.text for r in table(spark).collect()})
    assert sequences <= best_fit([r.length for r in rows], 2048)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=25))
def test_rounds_are_as_good_as_best_fit(counts):
    runs = packing.matched(counts, 40)
    room = defaultdict(list)
    for r in runs:
        for i in range(r.count):
            room[r.first + i % r.width].append((r.offset + i // r.width * r.length, r.length))
    for parts in room.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 40
    for length, n in counts.items():
        ranks = sorted((r.rank, r.count) for r in runs if r.length == length)
        assert [a for a, _ in ranks] == [sum(c for _, c in ranks[:i]) for i in range(len(ranks))]
        assert sum(c for _, c in ranks) == n
    plain = best_fit([x for x, n in counts.items() for _ in range(n)], 40)
    assert len(room) <= plain + 1


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(st.sampled_from("aE é́'st 1\t\n\x0b\x1c  .İſ🙂<|endoftext|>")), max_size=6))
def test_words_give_the_ids_of_the_text(texts):
    encoder = packing.encoder(PATH)
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.texts(texts)] == [x[:-1] for x in plain_ids(texts)]


def test_odd_rows(spark):
    texts = [*ODD, *[None] * 50, *(prose(i, random.Random(i).randint(1, 900)) for i in range(60))]
    frame = clashing(docs(spark, texts), "length", "rank", "row", "piece")
    check(packing.packed(frame, PATH).collect(), dict(enumerate(texts)))
    assert packing.packed(spark.createDataFrame([], SCHEMA), PATH).count() == 0
    again = spark.createDataFrame([(1, "a b", None, None, 3)] * 3 + [(None, "c", None, None, 1)], SCHEMA)
    assert sorted(r.offset for r in packing.packed(again, PATH).collect()) == [0, 3, 6, 9]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.sampled_from(
    ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endoftext", "|>", "<", " ", "\n", "it's", "'s", "e", "́", "é", "A", "1", ".", "🙂", "İ"]
)).map("".join), max_size=6))
def test_added_tokens_are_those_of_the_tokenizer_as_loaded(texts):
    from tokenizers import Tokenizer

    loaded, encoder = Tokenizer.from_file(PATH), packing.encoder(PATH)
    texts = ["hello <|endoftext|> world", *texts]
    want = [loaded.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [3306, 49407, 1002]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.texts(texts)] == want
