"""One named query per corpus operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import language, lexical, mixing, packing, pii, recompression, runs, secrets, sharding, simhash, substrings, syncmers, vectors
from panelcast.llm.common import table
from panelcast.session import scratch_path
from panelcast.workload.registry import Query

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs))


@query("op3_simhash")
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_sharding")
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32")
    placed = sharding.sharded(docs.withColumn("text_crc32", crc).select("doc_id", "text", "text_crc32"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), word_tokenizer())


@query("op6_secret_scan")
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, ledger = table(spark, sf_dir, "documents"), scratch_path(spark, "ledger")
    secrets.update(docs, ledger)
    return secrets.report(docs, ledger)


@query("op2_document_fingerprints")
def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(table(spark, sf_dir, "documents"))


@query("op7_substring_dedup")
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicated(table(spark, sf_dir, "documents"), with_kept=False)


@query("op8_pii")
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


VECTORS_SQL = """WITH RECURSIVE good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
unit AS (SELECT vec_id, e, len(e) AS size, sqrt(list_inner_product(e, e)) AS norm FROM good),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.size = b.size AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT r.a AS vec_id, coalesce(any_value(n), 0) AS n_links, min(r.b) AS component_id, r.a = min(r.b) AS kept
FROM reach r LEFT JOIN counts c ON c.a = r.a GROUP BY r.a"""


@query("op10_embedding_near_dedup", VECTORS_SQL)
def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op9_source_mixing")
def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source").withColumns(
        {"domain": mixing.domain(), "tokens": mixing.word_count()}
    )
    chosen = mixing.mixed(docs, mixing.LEVELS, mixing.WEIGHTS, share=0.8, tokens=F.col("tokens"))
    return chosen.select("doc_id", "domain", "lang", "source", "tokens", "epoch")


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return runs.periodic_runs(table(spark, sf_dir, "documents"), hashed).drop("runs", "collapsed")


LEXICAL_SQL = r"""WITH split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
facts AS (SELECT count(*) FILTER (WHERE len(terms) > 0) AS documents, CAST(sum(len(terms)) AS BIGINT) AS total FROM split),
postings AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM split) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM postings, facts GROUP BY term),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * documents) // total)))) AS BIGINT) AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term), facts GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10"""


@query("op12_lexical_search", LEXICAL_SQL)
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


REPEATS_SQL = r"""WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
places AS (SELECT doc_id, words, unnest(range(len(words) - 12)) AS i FROM split WHERE len(words) >= 13),
starts AS (SELECT doc_id, i, sha256(array_to_string(words[i + 1:i + 13], ' ')) AS w FROM places),
firsts AS (SELECT w, min(doc_id) AS first FROM starts GROUP BY w),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS word FROM starts JOIN firsts USING (w) WHERE doc_id > first),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS k FROM split) t
  WHERE NOT EXISTS (FROM gone g WHERE g.doc_id = t.doc_id AND g.word = t.k) GROUP BY doc_id)
SELECT s.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256 FROM split s LEFT JOIN kept k ON k.doc_id = s.doc_id"""


@query("op13_substring_dedup", REPEATS_SQL)
def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.deduplicated(table(spark, sf_dir, "documents"), with_kept=False)


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
