"""Rows that the tests of the corpus operators share."""

import random

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " ", "\t\n", "a", "é", "🙂 🙂", "12345", "ß" * 3, "İstanbul ſecret", "a\x1cb", "x" * 30_000, "wort " * 6_000]


def prose(seed: int, words: int = 80) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["an", "ti", "re", "ou", "le", "sh", "wo"]) for _ in range(rng.randint(1, 4))) for _ in range(words))


def rows(texts):
    return [(i, t, "en", "src0", len(t or "")) for i, t in enumerate(texts)]


def docs(spark, texts):
    return spark.createDataFrame(rows(texts), SCHEMA)


def clashing(df, *names):
    """The same rows with extra columns of the given names."""
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit("clash") for n in names})


def table(spark, name="documents"):
    return spark.read.parquet(f"{SF}/{name}.parquet")
