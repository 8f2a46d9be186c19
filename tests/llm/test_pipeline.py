"""The pipeline as wired: every stage against a plain version on rows of all kinds, and the whole of it."""

import zlib

import corpus_pipeline
import numpy as np
import pytest
from cases import ODD, SCHEMA, SF, clashing, prose, table
from test_packing import plain_ids
from test_pii import plain
from test_simhash import plain as plain_fingerprint
from test_simhash import plain_components

from panelcast.llm import language

NAMES = ("_domain", "domain", "doc", "_row", "_rank", "_name", "rank", "row", "key", "spans", "clean", "_runs", "epoch", "_order", "tokens")


@pytest.fixture(scope="module")
def docs(spark):
    """Own documents, copies, near copies, odd texts, rows without ids and rows that share one."""
    own = [tuple(r) for r in table(spark).limit(60).collect()]
    near = [(1000 + i, prose(i, 200), "en", "s1", 1) for i in range(4)] + [(1100 + i, prose(i, 200) + " more", "en", "s2", 1) for i in range(4)]
    odd = [(2000 + i, t, None, None, None) for i, t in enumerate(ODD)]
    again = [(None, prose(50 + i, 60), "en", "s", 1) for i in range(3)] + [(7, prose(60 + i, 60), None, "s", 1) for i in range(2)] * 2
    personal = [(3000, "Mail a@b.c or +49 30 1234567, from 1.2.3.4 " + prose(70, 30), "en", "s", 1)]
    return clashing(spark.createDataFrame([*own, *near, *odd, *again, *personal], SCHEMA), *NAMES).persist()


def as_rows(df):
    return sorted(map(str, df.collect()))


def test_columns_and_rows_of_every_stage_but_the_last(spark, docs):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert all(r[n] == "clash" for r in out.collect() for n in NAMES)
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert corpus_pipeline.pack(spark, docs.limit(0), SF).count() == 0


def test_language_keeps_clean_documents(spark, docs):
    kept = {(r.doc_id, r.text) for r in corpus_pipeline.identify_language(spark, docs, SF).collect()}
    own = {(r.doc_id, r.text) for r in table(spark).limit(60).collect() if language.has_letter(r.text)}
    assert own <= kept and all(language.has_letter(t) for _, t in kept)


def test_one_document_of_each_group_stays(spark, docs):
    rows = docs.collect()
    numbers = plain_components({i: plain_fingerprint(r.text) for i, r in enumerate(rows)})
    groups = {}
    for i, root in numbers.items():
        groups.setdefault(root, []).append(rows[i])
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    assert len(kept) == len(groups)
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    assert sorted(map(str, (r.doc_id for r in kept))) == sorted(str(least(r.doc_id for r in g)) for g in groups.values())
    texts = {r.text for r in kept}
    assert all(any(r.text in texts for r in g) for g in groups.values())


def test_personal_data_goes_and_all_else_stays(spark, docs):
    before = {(r.doc_id, r.source): r.text for r in docs.collect() if r.doc_id is not None and r.doc_id != 7}
    after = {(r.doc_id, r.source): r.text for r in corpus_pipeline.remove_personal_data(spark, docs, SF).collect()}
    assert corpus_pipeline.remove_personal_data(spark, docs, SF).count() == docs.count()
    for k, text in before.items():
        assert not plain(after[k]) and (after[k] == text or plain(text))
    assert after[3000, "s"].startswith("Mail [EMAIL] or [PHONE], from [IP] ")


def test_mixing_meets_its_budget_with_whole_rows(spark, docs):
    rows, given = docs.collect(), set(as_rows(docs))
    out = corpus_pipeline.mix_sources(spark, docs, SF)
    assert set(as_rows(out)) <= given
    words = lambda r: len((r.text or "").split())
    total, got = sum(map(words, rows)), sum(map(words, out.collect()))
    # a leaf ends with the document that reaches its budget
    longest = {}
    for r in rows:
        longest[r.lang, r.source] = max(longest.get((r.lang, r.source), 0), words(r))
    assert 0.8 * total - len(longest) <= got <= 0.8 * total + sum(longest.values())


def test_packing_holds_every_piece_once(spark, docs):
    out = corpus_pipeline.pack(spark, docs, SF).collect()
    rows = docs.collect()
    wanted = sorted((
        (r.doc_id, k // 2048, k, len(ids[k : k + 2048]), zlib.crc32(np.array(ids[k : k + 2048], "<u4").tobytes()))
        for r, ids in zip(rows, plain_ids([r.text for r in rows]), strict=True) for k in range(0, len(ids), 2048)
    ), key=str)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out), key=str) == wanted
    by_sequence = {}
    for r in out:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_whole_run(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert set(rows.columns) >= {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    assert rows.count() > 100
