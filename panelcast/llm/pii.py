"""Information-theoretic sanitisation of personal data, with built-in functions only.

Patterns find the protected entities: mail and IP addresses, card and phone numbers. The corpus
then says how strongly the words around an entity reveal it: with p estimated from counts, the
mutual information PMI(e, t) = log p(e, t) / (p(e) p(t)) of entity and term is set against the
information IC(e) = -log p(e) that the entity carries. A term that reveals at least a share
``alpha`` of it is generalised wherever it stands in a document with that entity.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.syncmers import let
from panelcast.session import checked_broadcast, written

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"
#: A term: a run of letters and digits of any length, with its combining marks.
WORD = r"[\p{L}\p{N}][\p{L}\p{N}\p{M}]*+"


#: Matches, or spans, handled at a time: arrays only grow inside a chunk, so a text may have any number of them.
CHUNK = 128


def chunks(items: Column) -> Column:
    """An array cut into arrays of ``CHUNK``."""
    begins = F.sequence(F.lit(0), F.greatest(F.size(items) - 1, F.lit(0)), F.lit(CHUNK))
    return F.transform(begins, lambda i: F.slice(items, i + 1, F.lit(CHUNK)))


def before_each(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """For each of a short array of numbers what all before it come to, from 0."""
    start = F.struct(F.lit(0).alias("all"), F.array().cast("array<int>").alias("before"))
    return F.aggregate(values, start, lambda s, v: F.struct(
        combine(s["all"], v).alias("all"), F.concat(s["before"], F.array(s["all"])).alias("before")), lambda s: s["before"])


def matches(text: Column, source: Column, pattern: str, keep: Callable[[Column], Column], kind: int) -> Column:
    """Spans of the leftmost non-overlapping matches of ``pattern`` in ``source`` that pass ``keep``.

    ``source`` has the length of ``text``. Positions are summed up from the lengths of the matches and
    of what lies between them, in code points: inside each chunk, and then over the chunks.
    """
    pieces = F.arrays_zip(
        F.split(source, pattern, -1).alias("gap"), F.regexp_extract_all(source, F.lit(pattern), F.lit(0)).alias("hit")
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("found"))

    def step(state: Column, piece: Column) -> Column:
        begin = state["at"] + F.char_length(piece["gap"])
        end = begin + F.coalesce(F.char_length(piece["hit"]), F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), piece["hit"].alias("value"))
        return F.struct(end.alias("at"), F.when(piece["hit"].isNotNull(), F.concat(state["found"], F.array(span))).otherwise(state["found"]).alias("found"))

    def placed(parts: Column) -> Column:
        offsets = before_each(F.transform(parts, lambda p: p["at"]), lambda a, b: a + b)
        moved = lambda s, at: F.struct((s["start"] + at).alias("start"), s["kind"].alias("kind"), (s["end"] + at).alias("end"), s["value"].alias("value"))
        return F.flatten(F.zip_with(parts, offsets, lambda p, at: F.transform(p["found"], lambda s: moved(s, at))))

    found = let(pieces, lambda all_: let(F.transform(chunks(all_), lambda c: F.aggregate(c, start, step)), placed))
    return F.filter(found, lambda s: keep(s["value"]))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether 14 to 19 digits pass the Luhn check."""
    def passes(number: Column) -> Column:
        total = F.aggregate(
            F.sequence(F.lit(1), F.char_length(number)), F.lit(0),
            lambda s, i: s + let(
                F.substr(number, i, F.lit(1)).cast("int") * F.when((F.char_length(number) - i) % 2 == 1, 2).otherwise(1),
                lambda d: d - F.when(d > 9, 9).otherwise(0),
            ),
        )
        return F.when(F.char_length(number).between(14, 19), total % 10 == 0).otherwise(False)

    return let(digits(value), passes)


# What the four kinds look like. Possessive parts keep long runs linear; where a
# pattern would repeat a group, characters that cannot belong to it are blanked out beforehand by
# ones of the same length, so that plain runs of characters remain.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++"
LOOSE_DOT = r"(?<![A-Za-z0-9-])\.|\.(?![A-Za-z0-9-])"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
CARD = r"[0-9][0-9\x20-]++"
LOOSE_SIGN = r"(?<![0-9])[\x20-]|[\x20-](?![0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def base_spans(text: Column) -> Column:
    """All spans of the four kinds in ``text``, by start and then kind."""
    none = F.array().cast(SPAN)
    dots, signs = F.regexp_replace(text, LOOSE_DOT, "%"), F.regexp_replace(text, LOOSE_SIGN, "_")
    always = lambda value: F.lit(True)
    found = (
        F.when(F.contains(text, F.lit("@")), matches(text, dots, EMAIL, always, 0)),
        F.when(F.rlike(text, F.lit(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]")),
               matches(text, text, IP, lambda v: F.rlike(v, F.lit(rf"^{BYTE}(?:\.{BYTE}){{3}}$")), 1)),
        F.when(F.rlike(text, F.lit(r"[0-9](?:[\x20-]?[0-9]){13}")), matches(text, signs, CARD, luhn, 2)),
        F.when(F.rlike(text, F.lit(r"\+[0-9]")),
               matches(text, text, PHONE, lambda v: F.char_length(digits(v)).between(10, 15), 3)),
    )
    return F.array_sort(F.concat(*(F.coalesce(f, none) for f in found)))


def span_text(spans: Column) -> Column:
    names = F.array(*map(F.lit, (*KINDS, TERM)))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def entity(span: Column) -> Column:
    """What two spans of the same entity have in common."""
    return F.concat_ws(":", span["kind"].cast("string"), F.lower(span["value"]))


def marked(docs: DataFrame) -> DataFrame:
    """Write ``doc_id, key, spans`` of every row, and its text if it has a span; ``key`` is a hash of the text."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", "text", F.xxhash64("text").alias("key"), base_spans(F.col("text")).alias("spans")
    )
    return written(rows.select("doc_id", "key", "spans", F.when(F.size("spans") > 0, F.col("text")).alias("text")), "pii")


def same_texts(rows: DataFrame, name: str) -> DataFrame:
    """``name, n, texts`` of the entities or terms in rows of ``key, name``: how many texts hold one, and a hash of which."""
    which = F.xxhash64(F.count(F.lit(1)), F.bit_xor("key"), F.bit_xor(F.xxhash64("key")))
    return rows.groupBy(name).agg(F.count(F.lit(1)).alias("n"), which.alias("texts"))


def revealing_terms(docs: DataFrame, found: DataFrame, alpha: float = 0.9, support: int = 2) -> tuple[DataFrame, DataFrame]:
    """``entity, group`` of protected entities, and ``group, term`` of the terms that give at least ``alpha`` of their information away.

    Everything is counted over whole documents, once for each different text of the corpus: entities,
    terms, both together and the total. So copies neither make a term revealing nor hide one.
    ``support`` texts are needed: with one, every word that stands nowhere else would share all of
    the entity's information.

    Entities of the same texts are one group, and so are terms of the same texts with entities: what a
    text pairs are its groups, not its entities and words, and only those whose counts alone leave room
    for a share of ``alpha``.
    """
    texts = found.filter(F.size("spans") > 0).dropDuplicates(["key"])
    held = texts.select("key", F.explode(F.array_distinct(F.transform("spans", entity))).alias("entity"))
    entities = written(same_texts(held, "entity").filter(F.col("n") >= support).select("entity", F.col("n").alias("n_e"), F.col("texts").alias("group")), "pii-entities")
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))
    near_words = texts.select("key", F.explode(words).alias("term"))
    # a term is in no fewer texts than those that have it and some entity
    near = written(same_texts(near_words, "term").filter(F.col("n") >= support).select("term", F.col("n").alias("n_near"), F.col("texts").alias("set")), "pii-near")
    total = F.lit(float(found.select("key").distinct().count()))

    def revealing(n_both: Column, n_term: Column) -> Column:
        p_entity, p_both = F.col("n_e") / total, n_both / total
        share = F.log(p_both / (p_entity * n_term / total)) / -F.log(p_entity)
        return (p_entity < 1) & (share >= alpha)

    groups = held.join(entities, "entity").select("key", "group", "n_e").distinct()
    sets = near_words.join(near, "term").select("key", "set", "n_near").distinct()
    room = revealing(F.least("n_e", "n_near"), F.col("n_near"))
    together = groups.join(sets, "key").filter(room).groupBy("group", "n_e", "set", "n_near").agg(F.count(F.lit(1)).alias("n_et"))
    pairs = written(together.filter((F.col("n_et") >= support) & revealing(F.col("n_et"), F.col("n_near"))).select("group", "n_e", "set", "n_et"), "pii-pairs")
    if pairs.isEmpty():
        return entities.select("entity", "group"), pairs.select("group", F.lit("").alias("term"))
    members = near.join(pairs.select("set").distinct(), "set", "left_semi").select("set", "term")
    everywhere = docs.select(F.xxhash64("text").alias("key"), F.explode(words).alias("term")).join(checked_broadcast(members.select("term")), "term")
    alone = everywhere.distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    terms = pairs.join(members, "set").join(alone, "term").filter(revealing(F.col("n_et"), F.col("n_t"))).select("group", "term").distinct()
    return entities.select("entity", "group"), written(terms, "pii-revealing")


def term_spans(found: DataFrame, entities: DataFrame, terms: DataFrame) -> DataFrame:
    """``doc_id, key, extra``: spans of revealing terms in documents that hold their entity, outside all other spans."""
    rows = found.filter(F.size("spans") > 0).select("doc_id", "key", F.explode("spans").alias("span"))
    there = rows.select("doc_id", "key", entity(F.col("span")).alias("entity")).join(entities, "entity").select("doc_id", "key", "group").distinct()
    wanted = there.join(terms, "group").groupBy("doc_id", "key").agg(F.collect_set("term").alias("terms"))
    texts = found.filter(F.size("spans") > 0).dropDuplicates(["doc_id", "key"])
    same = texts["doc_id"].eqNullSafe(wanted["doc_id"]) & (texts["key"] == wanted["key"])
    rows = texts.join(wanted, same).select(texts["doc_id"], texts["key"], "text", "spans", "terms")
    hits = matches(F.col("text"), F.col("text"), WORD, lambda v: F.array_contains(F.col("terms"), F.lower(v)), len(KINDS))
    outside = F.filter(hits, lambda t: ~F.exists("spans", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    return rows.select(F.col("doc_id").alias("_doc"), F.col("key").alias("_key"), outside.alias("extra")).filter(F.size("extra") > 0)


def with_all_spans(rows: DataFrame, found: DataFrame, docs: DataFrame, alpha: float, support: int) -> DataFrame:
    """``rows`` (with ``doc_id``, ``key``, ``spans``) with the spans of revealing terms in ``all_spans``."""
    entities, terms = revealing_terms(docs, found, alpha, support)
    if terms.isEmpty():
        return rows.withColumn("all_spans", F.col("spans"))
    extra = checked_broadcast(written(term_spans(found, entities, terms), "pii-terms"))
    same = rows["doc_id"].eqNullSafe(extra["_doc"]) & (rows["key"] == extra["_key"])
    both = F.array_sort(F.concat("spans", F.coalesce("extra", F.array().cast(SPAN))))
    return rows.join(extra, same, "left").withColumn("all_spans", both).drop("_doc", "_key", "extra")


def counted(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def report(docs: DataFrame, alpha: float = 0.9, support: int = 2) -> DataFrame:
    """``doc_id``, the number of spans of each kind, ``base_sha256`` and ``spans`` of every row.

    A null text counts as empty. Repeated rows get the same answer each, no rows give no rows, and
    columns other than ``doc_id`` and ``text`` are not read.
    """
    found = marked(docs)
    rows = with_all_spans(found.select("doc_id", "key", "spans"), found, docs.select("text"), alpha, support)
    counts = [counted(F.col("spans"), i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return rows.select(
        "doc_id", *counts, F.sha2(span_text(F.col("spans")), 256).alias("base_sha256"), span_text(F.col("all_spans")).alias("spans")
    )


def with_clean_text(rows: DataFrame, text: Column, spans: str, name: str = "clean") -> DataFrame:
    """Add ``text`` with every span, or run of overlapping spans, replaced by the kind of its first one in brackets.

    Each chunk of runs takes its own piece of the text, so that places are sought in short pieces.
    """
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in (*KINDS, TERM)))
    own = [F.col(f"`{c}`") for c in rows.columns]
    # how far the spans before each one go: a run begins where they end
    parts = F.transform(chunks(F.col(spans)), lambda part: F.struct(
        before_each(F.transform(part, lambda s: s["end"]), F.greatest).alias("before"), F.array_max(F.transform(part, lambda s: s["end"])).alias("all")))
    step = rows.select(*own, parts.alias("_parts"))
    step = step.select(*own, F.flatten(F.zip_with(
        "_parts", before_each(F.transform("_parts", lambda p: p["all"]), F.greatest), lambda p, at: F.transform(p["before"], lambda x: F.greatest(x, at)))
    ).alias("_reached"))
    heads = F.filter(F.sequence(F.lit(0), F.size(spans) - 1), lambda i: F.get(spans, i)["start"] >= F.get("_reached", i))
    last = F.array_max(F.transform(spans, lambda s: s["end"]))
    step = step.select(*own, "_reached", F.when(F.size(spans) > 0, heads).alias("_heads"), last.alias("_last"))
    runs = F.transform("_heads", lambda i, k: F.struct(
        F.get(spans, i)["start"].alias("start"), F.get(spans, i)["kind"].alias("kind"),
        F.coalesce(F.get("_reached", F.get("_heads", k + 1)), F.col("_last")).alias("end")))
    step = step.select(*own, chunks(runs).alias("_runs"))
    step = step.select(*own, "_runs", F.transform("_runs", lambda part: F.get(part, F.lit(0))["start"]).alias("_begins"))

    def piece(part: Column, i: Column) -> Column:
        low = F.when(i == 0, 0).otherwise(F.get("_begins", i))
        high = F.coalesce(F.get("_begins", i + 1), F.char_length(text))
        return F.struct(part.alias("part"), low.alias("low"), high.alias("high"), F.substr(text, low + 1, high - low).alias("own"))

    step = step.select(*own, F.transform("_runs", piece).alias("_pieces"))

    def replaced(p: Column) -> Column:
        return F.array_join(F.transform(p["part"], lambda run, i: F.concat(
            F.when(i == 0, F.substr(p["own"], F.lit(1), run["start"] - p["low"])).otherwise(""),
            F.element_at(names, run["kind"] + 1),
            F.substr(p["own"], run["end"] - p["low"] + 1, F.coalesce(F.get(p["part"], i + 1)["start"], p["high"]) - run["end"]),
        )), "")

    clean = F.when(F.size(spans) > 0, F.array_join(F.transform("_pieces", replaced), "")).otherwise(text)
    return step.select(*own, clean.alias(name))


def sanitised(docs: DataFrame, alpha: float = 0.9, support: int = 2) -> DataFrame:
    """The rows with all their columns; spans in ``text`` are generalised and ``n_chars``, if there, counts anew.

    Null texts stay null. Texts without a span stay as they are.
    """
    found = marked(docs)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(row, F.col("doc_id"), F.xxhash64(text).alias("key"), base_spans(text).alias("spans"))
    rows = with_all_spans(rows, found, docs.select("text"), alpha, support)
    new = with_clean_text(rows.select("row", "all_spans"), F.col("row.text"), "all_spans")
    changed = {"text": F.col("clean"), "n_chars": F.char_length("clean").cast("long")}
    touched = (F.size("all_spans") > 0) & F.col("row.text").isNotNull()
    return new.select(*(
        (F.when(touched, changed[c]).otherwise(F.col(f"row.`{c}`")) if c in changed else F.col(f"row.`{c}`")).alias(c) for c in docs.columns
    ))
