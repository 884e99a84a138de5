"""URL filter rules as a sort-merge range join.

A host is keyed by its reversed labels ("www.example.com" -> "com.example.www."), so that a rule's host is a prefix of the keys of all its
subdomains, and a rule is the interval of keys with that prefix. Urls are range-partitioned by key (ties broken by id, so one hot host is
spread over many ranges); a rule goes to every range that its interval meets; one sorted sweep per range keeps a stack of the nested rules
that are open at the current key, and asks their path prefixes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atomweft.llm.common import cut, lower_ascii, partitions

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Ranges for each shuffle partition: many small ones even out when they are dealt by hash.
RANGES = 4


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty for null or no ``://``."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _meets(ranges: list[tuple[int, str, str]]):
    """Deals each rule to the ranges (range id, least key, greatest key) that hold a key with its prefix."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            out = [r | {"range": i} for r in rows for i, least, most in ranges if r["key"] <= most and (least < r["key"][:-1] + "/" or least.startswith(r["key"]))]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("range", pa.int32()), ("key", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string())]))

    return deal


class _Open:
    """The rules of one host that is open in the sweep."""

    def __init__(self, key: str):
        self.key, self.by_path, self.lengths = key, {}, []

    def add(self, path: str, rule: str, verdict: str) -> None:
        self.by_path.setdefault(path, (rule, verdict))
        self.lengths = sorted({len(p) for p in self.by_path}, reverse=True)

    def longest(self, path: str) -> tuple[str, str] | None:
        return next((found for n in self.lengths if n <= len(path) and (found := self.by_path.get(path[:n]))), None)


def _sweep(default: str):
    """Reads rows ordered by (range, key, rules first); the stack holds the hosts whose interval contains the current key."""

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[_Open] = []
        at = None
        for batch in batches:
            cols = {c: batch.column(c).to_pylist() for c in ("range", "key", "is_url", "path", "rule", "verdict")}
            rules, verdicts, keep = [], [], []
            for i, (rng, key, is_url, path) in enumerate(zip(cols["range"], cols["key"], cols["is_url"], cols["path"])):
                if rng != at:
                    stack, at = [], rng
                while stack and not key.startswith(stack[-1].key):
                    stack.pop()
                if not is_url:
                    if not stack or stack[-1].key != key:
                        stack.append(_Open(key))
                    stack[-1].add(path, cols["rule"][i], cols["verdict"][i])
                    continue
                fits = [(len(found[0]), len(level.key), found) for level in stack if (found := level.longest(path))]
                rule, verdict = max(fits)[2] if fits else (None, default)
                keep.append(i)
                rules.append(rule)
                verdicts.append(verdict)
            kept = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([kept.column("id"), kept.column("host"), kept.column("path"), pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], ["id", "host", "path", "rule", "verdict"])

    return sweep


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) per row of ``pages``; rule is null and the verdict ``default`` where none fits.

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains where the path starts with its path; the longest host
    and path together wins, then the longest host; of equal rules with different verdicts the first verdict in order. Rules without a host
    fit nothing. Null urls, and urls without ``://``, have an empty host and path. Repeated rows stay; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    n = RANGES * partitions(spark)
    urls = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")).withColumn("key", host_key(F.col("host")))
    placed = cut(urls.repartitionByRange(n, "key", F.xxhash64("path"), "id").withColumn("range", F.spark_partition_id()))
    ranges = [tuple(r) for r in placed.groupBy("range").agg(F.min("key"), F.max("key")).collect()]  # one row for each range
    clean = rules.where("host <> ''").select(lower_ascii(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    clean = clean.groupBy("host", "path").agg(F.min("verdict").alias("verdict")).select(host_key(F.col("host")).alias("key"), "path", F.concat("host", "path").alias("rule"), "verdict")
    dealt = clean.mapInArrow(_meets(ranges), "range int, key string, path string, rule string, verdict string")
    rows = placed.withColumn("is_url", F.lit(True)).unionByName(dealt.withColumn("is_url", F.lit(False)), allowMissingColumns=True)
    rows = rows.repartition(partitions(spark), "range").sortWithinPartitions("range", "key", "is_url")
    swept = rows.mapInArrow(_sweep(default), f"id {dict(urls.dtypes)['id']}, host string, path string, rule string, verdict string")
    return swept.withColumnRenamed("id", id_col)
