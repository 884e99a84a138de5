"""Benchmark decontamination (DataFrame functions only).

The normalised word n-grams of the test items form a hash set that is broadcast to the scan of the training texts: every window of a text is
hashed, looked up, and a hit is verified against the words themselves inside the same stage. Only hits and one row per document are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atomweft.llm.common import cut, lower_ascii, sized, words

#: Everything in ASCII that is neither a digit nor a letter separates words; all other characters belong to words.
WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: Item windows (about 200 bytes each) that may be broadcast; a larger set is joined by a shuffle on the window hash.
BROADCAST_WINDOWS = 200_000


def item_words(text: Column) -> Column:
    return words(lower_ascii(text), WORD_GAP)


def _hash(found: Column, start: Column | int, length: int) -> Column:
    return F.xxhash64(*(F.get(found, (start + k) if isinstance(start, Column) else F.lit(start + k)) for k in range(length)))


def benchmark_windows(items: DataFrame, n: int = WINDOW) -> DataFrame:
    """(len, h, win, items): the distinct windows of all items with the ids of the items that have them.

    An item of fewer words than ``n`` is one window; one without words has none. Null ids mark words but are not listed.
    """
    each = items.select("item_id", item_words(F.col("text")).alias("w")).where(F.size("w") > 0)
    each = each.select("item_id", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - n + 1, F.lit(1))), lambda i: F.slice(F.col("w"), i, n))).alias("win"))
    found = each.groupBy("win").agg(F.collect_set("item_id").alias("items")).withColumn("len", F.size("win"))
    h = F.lit(None).cast("bigint")
    for length in range(1, n + 1):
        h = F.when(F.col("len") == length, _hash(F.col("win"), 0, length)).otherwise(h)
    return found.select("len", h.alias("h"), "win", "items")


def _exploded(docs: DataFrame, lengths: list[int], *carried: str) -> DataFrame:
    """A row per window of every document (p counts words from 1), and one with p = 0 for the document itself.

    The array is never empty; the outer form keeps the optimiser from adding a filter on its size, which would build it twice.
    """
    size = F.size("w")

    def windows(n: int) -> Column:
        return F.when(size >= n, F.transform(F.sequence(F.lit(0), size - n), lambda i: F.struct(F.lit(n).alias("len"), (i + 1).alias("p"), _hash(F.col("w"), i, n).alias("h"))))

    own = F.array(F.struct(F.lit(0).alias("len"), F.lit(0).alias("p"), F.lit(None).cast("bigint").alias("h")))
    every = own
    for n in lengths:
        every = F.concat(every, F.coalesce(windows(n), F.array().cast("array<struct<len:int,p:int,h:bigint>>")))
    return docs.withColumn("windows", every).select(*carried, F.explode_outer("windows").alias("x")).select(*carried, "x.*")


def find_contamination(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """(doc_id, text_hash, n_words, at array<int>, items array<long>) per row of ``docs``.

    ``at`` lists the word numbers, from 1 and ascending, that lie inside an occurrence of a window; ``items`` the ids of the items with
    occurring windows. A null text has no words; repeated rows each get their result; with an empty benchmark nothing is hit.
    """
    wanted = cut(benchmark_windows(benchmark, n))
    lengths = sorted(r[0] for r in wanted.select("len").distinct().collect())  # n numbers at most
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), item_words(F.col("text")).alias("w"))
    key = ("doc_id", "text_hash")
    if wanted.count() <= broadcast_windows:
        rows = _exploded(texts, lengths, *key, "w").alias("d")
        match = (F.col("d.h") == F.col("b.h")) & (F.col("d.len") == F.col("b.len")) & (F.slice(F.col("d.w"), F.greatest(F.col("d.p"), F.lit(1)), F.col("b.len")) == F.col("b.win"))
        rows = rows.join(F.broadcast(wanted).alias("b"), match, "left").where("d.p = 0 OR b.items IS NOT NULL")
        rows = rows.select("d.doc_id", "d.text_hash", F.when(F.col("d.p") == 0, F.size("d.w")).alias("n_words"), "d.p", "d.len", "b.items")
    else:
        hits = _exploded(texts, lengths, *key).where("p > 0").join(wanted, ["h", "len"])
        own = texts.distinct().select(F.col("doc_id").alias("own_id"), F.col("text_hash").alias("own_hash"), "w")
        hits = hits.join(own, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash")) & (F.slice("w", F.col("p"), F.col("len")) == F.col("win")))
        hits = hits.select(*key, F.lit(None).cast("int").alias("n_words"), "p", "len", "items").distinct()
        rows = texts.select(*key, F.size("w").alias("n_words"), F.lit(0).alias("p"), F.lit(0).alias("len"), F.lit(None).cast("array<bigint>").alias("items")).unionByName(hits)
    found = rows.groupBy(*key).agg(
        F.max("n_words").alias("n_words"),
        F.count("n_words").alias("copies"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(F.col("p") > 0, F.sequence(F.col("p"), F.col("p") + F.col("len") - 1)))))).alias("at"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copy", "copies")


def summarise(found: DataFrame) -> DataFrame:
    """The counts and the digest of item ids per document."""
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        F.col("n_words").cast("bigint").alias("n_words"),
        F.size("at").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.size("at") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", n: int = WINDOW) -> DataFrame:
    """``docs`` without contaminated documents (``remove="documents"``), or with the hit words and the gaps after them cut out of ``text``
    (``remove="spans"``). All columns stay; rows are matched by doc_id and text hash (null-safe)."""
    hit = cut(find_contamination(docs, benchmark, n).where(F.size("at") > 0).select(F.col("doc_id").alias("_aw_id"), F.col("text_hash").alias("_aw_hash"), F.col("at").alias("_aw_at")).distinct())
    on = F.col("doc_id").eqNullSafe(F.col("_aw_id")) & (F.xxhash64("text") == F.col("_aw_hash"))
    if remove == "documents":
        return docs.join(sized(hit.drop("_aw_at")), on, "left_anti")
    parts = F.regexp_extract_all("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), 0)
    shift = F.when(F.get(parts, F.lit(0)).rlike(r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"), 1).otherwise(0)
    left = F.filter(parts, lambda x, i: ~F.array_contains("_aw_at", F.floor((i - shift) / 2).cast("int") + 1))
    return docs.join(hit, on, "left").withColumn("text", F.when(F.col("_aw_at").isNotNull(), F.array_join(left, "")).otherwise(F.col("text"))).select(docs.columns)
