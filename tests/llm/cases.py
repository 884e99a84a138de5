"""Awkward rows that every operator must survive."""

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = [f"w{i}" for i in range(400)]


def prose(start: int, n: int, step: int = 1) -> str:
    return " ".join(WORDS[(start + i * step) % 400] + str((start * 7 + i * step) % 13) for i in range(n))


def odd_docs(spark, clash: str = ""):
    """Nulls in every column, empty and blank texts, a very long one, repeats, ties, and with ``clash`` extra columns of those names."""
    long_text = prose(3, 60_000, 7)
    rows = [
        (1, prose(1, 80), "en", "a", 1), (1, prose(1, 80), "en", "a", 1), (2, prose(1, 80), "en", "a", 1), (3, None, "en", "a", 0), (4, "", "en", None, 0), (5, " \t\n", None, "b", 3), (None, prose(5, 70), "en", "b", 9), (None, None, None, None, None),
        (6, long_text, "de", "b", len(long_text)), (7, "é ß 漢字 " * 60, "fr", "c", 5), (8, "one", "en", "a", 3), (9, prose(9, 90) + "\n" + prose(9, 90), "en", "a", 2), (10, "a\x00b " * 60, "en", "a", 4), (-5, prose(20, 120, 3), "en", "a", 4),
    ]
    df = spark.createDataFrame(rows, DOCS)
    for name in clash.split():
        from pyspark.sql import functions as F

        df = df.withColumn(name, F.lit("x"))
    return df


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def key(rows):
    return sorted(rows, key=repr)
