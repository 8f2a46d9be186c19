"""Document fingerprints from closed syncmers, with built-in functions only.

A k-mer of words is kept if the smallest hash of its inner s-mers is that of the first or of the
last one. That depends on the k-mer alone, not on its surroundings, so an edit moves or changes
only the anchors it touches, and what two texts share gives the same anchors in the same order.
Anchors are kept with their places, and two texts are compared by anchors at the same place: as they
stand, and with one text moved so that the first anchor they share comes to lie on itself.

Characters of scripts that are written without spaces are words of their own. Texts of few characters
have a second set of anchors, of code points, and two such texts are compared by these.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import shuffle_width

#: Words (or code points) in a k-mer and in an inner s-mer.
K, S = 5, 2
#: Anchors match if they are equal and lie in the same cell of this many words (or code points).
CELL = 64
#: Most code points of a text that is also compared by code points.
SHORT = 400
#: Scripts without spaces between words.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"
ANCHORS = "struct<hashes:array<int>,places:array<int>>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also inside further lambdas."""
    return F.transform(F.array(value), use)[0]


def closed_syncmers(units: Column, whole: Column) -> Column:
    """``hashes`` and ``places`` of the closed syncmers of an array of hashed units, in order; ``whole`` at 0 if there is none."""
    alone = F.struct(F.array(whole).alias("hashes"), F.array(F.lit(0)).alias("places")).cast(ANCHORS)

    def closed(g: Column) -> Column:
        # g[i] is the hash of the s-mer at unit i; a k-mer has K - S + 1 of them
        inner = K - S
        starts = F.sequence(F.lit(0), F.size(g) - inner - 1)
        places = F.filter(starts, lambda i: F.least(g[i], g[i + inner]) <= F.least(*(g[i + j] for j in range(1, inner))))

        def kept(at: Column) -> Column:
            hashes = F.transform(at, lambda i: F.hash(g[i], g[i + inner - 1], g[i + inner]))
            return F.when(F.size(at) > 0, F.struct(hashes.alias("hashes"), at.alias("places")).cast(ANCHORS)).otherwise(alone)

        return let(places, kept)

    def hashed(h: Column) -> Column:
        n = F.size(h)
        pairs = F.zip_with(F.slice(h, F.lit(1), n - 1), F.slice(h, F.lit(2), n - 1), lambda a, b: F.xxhash64(a, b))
        return F.when(n >= K, let(pairs, closed)).otherwise(alone)

    return let(F.transform(units, lambda u: F.xxhash64(u)), hashed)


def anchors(text: Column) -> Column:
    """``words``, the anchors of a text by words, and ``chars``, those by code points of a text that has few; else null.

    Words are what spaces, tabs and line breaks separate, and single characters of unspaced scripts. A
    text of fewer than ``K`` units, or one without an anchor, is one anchor as a whole.
    """
    spaced = F.translate(text, "\t\n\x0b\x0c\r", " " * 5)
    apart = F.split(F.btrim(F.regexp_replace(spaced, f"({UNSPACED})", " $1 ")), " +")
    words = F.when(F.rlike(text, F.lit(UNSPACED)), apart).otherwise(F.split(spaced, " "))
    chars = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
    whole = F.hash(text)
    return F.struct(
        closed_syncmers(words, whole).alias("words"),
        F.when(F.char_length(text) <= SHORT, closed_syncmers(chars, whole)).alias("chars"),
    )


def fingerprint(found: Column) -> Column:
    """Anchors as text: four bytes for the hash and four for the place of each, in text order, in base 64."""
    def packed(part: Column) -> Column:
        four = lambda x: F.right(F.lpad(F.hex(x), 16, "0"), F.lit(8))
        return F.base64(F.unhex(F.array_join(F.zip_with(part["hashes"], part["places"], lambda h, p: F.concat(four(h), four(p))), "")))

    return F.concat_ws(".", packed(found["words"]), packed(found["chars"]))


def aligned_share(a: Column, b: Column) -> Column:
    """Twice the anchors that agree in hash and place over all anchors of both, for the better of two alignments."""
    def placed(part: Column, moved: Column) -> Column:
        return F.zip_with(part["hashes"], part["places"], lambda h, p: F.xxhash64(h, F.floor((p + moved) / CELL)))

    def share(x: Column, y: Column) -> Column:
        # distinct in each, as a cell counts a repeated anchor once
        return let(F.array_distinct(x), lambda u: let(F.array_distinct(y), lambda v: 2 * F.size(F.array_intersect(u, v)) / (F.size(u) + F.size(v))))

    def place_of(part: Column, anchor: Column) -> Column:
        return F.element_at(part["places"], F.array_position(part["hashes"], anchor).cast("int"))

    def shared(common: Column) -> Column:
        zero, first = F.lit(0), common[0]
        as_they_stand = share(placed(a, zero), placed(b, zero))
        moved = let(place_of(a, first) - place_of(b, first), lambda d: F.when(d == 0, 0.0).otherwise(share(placed(a, zero), placed(b, d))))
        return F.when(F.size(common) == 0, 0.0).otherwise(F.greatest(as_they_stand, moved))

    return let(F.array_intersect(a["hashes"], b["hashes"]), shared)


def likeness(a: Column, b: Column) -> Column:
    """How much of two texts agrees in content and place, 0 to 1; equal texts are 1, texts that share a half 0.5."""
    both_short = a["chars"].isNotNull() & b["chars"].isNotNull()
    return F.when(both_short, aligned_share(a["chars"], b["chars"])).otherwise(aligned_share(a["words"], b["words"]))


def with_next(docs: DataFrame, value: Callable[[Column], Column]) -> DataFrame:
    """``doc_id, text, value, next_text, next_value`` by descending ``doc_id``; after the last comes the first.

    Null texts count as empty. Rows that share a ``doc_id`` follow by text hash, null ids come last.
    The ids are cut into buckets of about equal size, and the first row of each bucket is also sent
    to the bucket before it: one exchange of the texts, and no task sees more than its buckets.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("tie"))
    count = 4 * shuffle_width(spark)
    cuts = docs.agg(F.percentile_approx("doc_id", [i / count for i in range(1, count)], 10_000)).first()[0]
    bounds = F.array(*(F.lit(c).cast("long") for c in sorted(set(cuts or [])))).cast("array<long>")
    # null ids get the bucket below all others
    bucket = F.when(F.col("doc_id").isNull(), -1).otherwise(F.size(F.filter(bounds, lambda b: b <= F.col("doc_id"))))
    rows = rows.withColumn("bucket", bucket)
    # one row a bucket: what comes first in it
    heads = sorted(rows.groupBy("bucket").agg(F.max(F.struct("doc_id", "tie")).alias("head")).collect(), reverse=True)
    before = [heads[-1], *heads[:-1]] if heads else []
    sent = spark.createDataFrame(
        [(h.head.doc_id, h.head.tie, b.bucket) for h, b in zip(heads, before, strict=True)], "head_id long, head_tie long, to int"
    )
    is_head = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie"))
    places = F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("copy")))
    copied = F.array(F.struct(F.col("to").alias("bucket"), F.lit(True).alias("copy")))
    dealt = (
        rows.join(F.broadcast(sent), is_head, "left")
        .withColumn("place", F.explode(F.when(F.col("to").isNull(), places).otherwise(F.concat(places, copied))))
        .select("doc_id", "text", "tie", "place.bucket", "place.copy")
        .repartition(shuffle_width(spark), "bucket")
        .withColumn("value", value(F.col("text")))
    )
    order = Window.partitionBy("bucket").orderBy("copy", F.desc_nulls_last("doc_id"), F.desc("tie"))
    return dealt.select(
        "doc_id", "text", "value", "copy", F.lead("text").over(order).alias("next_text"), F.lead("value").over(order).alias("next_value")
    ).filter(~F.col("copy")).drop("copy")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text, of its edited text, and how alike they and the next text are.

    The edited text has its last half replaced by the first code points of the next document, as
    many or all it has. An empty text has an empty edited text. No rows give no rows; columns other
    than ``doc_id`` and ``text`` are not read.
    """
    half = F.floor(F.col("n_chars") / 2).cast("int")
    chars = F.char_length("text")
    edited = F.concat(F.substr("text", F.lit(1), (chars - half).cast("int")), F.substr("next_text", F.lit(1), half))
    rows = with_next(docs, anchors).withColumn("n_chars", chars.cast("long")).withColumn("edited", edited)
    rows = rows.withColumn("edited_value", anchors(F.col("edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("value")).alias("fingerprint"), fingerprint(F.col("edited_value")).alias("edited_fingerprint"),
        likeness(F.col("value"), F.col("edited_value")).alias("near_edited"),
        likeness(F.col("value"), F.col("next_value")).alias("near_next"),
    )
