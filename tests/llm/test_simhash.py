import itertools

import numpy as np
import xxhash
from cases import ODD, SCHEMA, SF, clashing, docs, prose, table

from panelcast.llm import queries, simhash


def plain(text, shingle=4):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, bits=4):
    """fps by doc_id -> smallest doc_id reachable."""
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(ids, 2):
        if (fps[a] ^ fps[b]).bit_count() <= bits:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in ids}


def test_fingerprints_match_plain_version(spark):
    texts = [*ODD, "A b C d", "a B c D", "one two three", "x y", prose(1), prose(1).upper()]
    assert [simhash.fingerprint(t) for t in texts] == [plain(t) for t in texts]


def test_query_matches_brute_force(spark):
    found = {r.doc_id: r for r in queries.op3_simhash(spark, SF).collect()}
    fps = {r.doc_id: plain(r.text) for r in table(spark).collect()}
    assert {i: int(r.fingerprint, 16) for i, r in found.items()} == fps
    assert {i: r.component_id for i, r in found.items()} == plain_components(fps)


def test_keys_too_large_are_split_without_losing_a_link(spark):
    rng = np.random.default_rng(3)
    center = int(rng.integers(0, 2**63))
    fps = {center ^ sum(1 << int(b) for b in rng.choice(44, 5, replace=False)) for _ in range(300)}
    fps |= {int(x) for x in rng.integers(0, 2**63, 50)}
    frame = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    links = simhash.linked(frame, bits=4, most=100).collect()
    named = dict(enumerate(sorted(fps)))
    expected = plain_components(named)
    number = {simhash.signed(f): i for i, f in named.items()}
    assert all((fpa := named[number[r.a]]) ^ (fpb := named[number[r.b]]) and (fpa ^ fpb).bit_count() <= 4 for r in links)
    root = {i: i for i in named}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for r in links:
        x, y = sorted((find(number[r.a]), find(number[r.b])))
        root[y] = x
    assert {i: find(i) for i in named} == expected


def test_odd_rows_and_extra_columns(spark):
    frame = clashing(docs(spark, [*ODD, None, "", "a"]), "fp", "fingerprint", "key")
    rows = simhash.near_duplicates(frame).collect()
    assert len(rows) == len(ODD) + 3
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {0}
    kept = simhash.first_of_each(frame)
    assert kept.columns == frame.columns
    assert kept.count() == len({r.component_id for r in rows})
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).count() == 0 == simhash.first_of_each(empty).count()


def test_one_row_of_each_component_stays_whatever_the_ids(spark):
    same = [(5, "a b c d", None, None, 7)] * 3
    frame = spark.createDataFrame([*same, (5, prose(9), None, None, 1), (None, prose(8), "en", "s", 1), (None, prose(7), "en", "s", 1)], SCHEMA)
    kept = simhash.first_of_each(frame).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(5, "a b c d"), (5, prose(9)), (0, prose(8)), (0, prose(7))])


def test_documents_without_ids_are_not_lost(spark):
    texts = [prose(i) for i in range(40)]
    frame = spark.createDataFrame([(None, t, "en", "s", 1) for t in texts * 2], SCHEMA)
    assert sorted(r.text for r in simhash.first_of_each(frame).collect()) == sorted(texts)


def test_columns_with_working_names_come_back_as_they_were(spark):
    frame = clashing(docs(spark, [prose(1), prose(1), prose(2)]), "_name", "_rank", "rank", "row", "doc", "id", "text_hash", "root", "fp")
    kept = simhash.first_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2]
    assert all(r[c] == "clash" for r in kept.collect() for c in frame.columns[5:])
