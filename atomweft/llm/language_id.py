"""Language of web pages by fusing evidence.

The posterior of a page's language is the product of the likelihood of its text (byte trigrams), the likelihood of the language that its
markup declares, and a prior of its host. The prior is hierarchical: a host's counts are smoothed by its address suffix, those by all pages.
Counts come from grouped aggregations of the languages that the texts alone suggest; a page's own guess is left out of its priors.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atomweft.llm.common import cut, sized, stored
from atomweft.llm.url_rules import host_of

BUCKETS = 1 << 16
#: Bound on the labelled texts that the trigram model is fitted on: those with the least hashes, by a threshold on the hash.
FIT_ROWS = 20_000
#: Neighbouring trigrams are not independent: a text counts as so many independent ones at most.
EVIDENCE = 60.0
HOST_WEIGHT, SUFFIX_WEIGHT, DECLARED_WEIGHT = 5.0, 50.0, 1.0

_HIDES = re.compile(r"<(script|style)\b|<!--", re.I)
_ENDS = {"script": re.compile(r"</script\s*>", re.I), "style": re.compile(r"</style\s*>", re.I), None: re.compile("-->")}
_SKIP = bytes(b + 32 if 65 <= b <= 90 else 32 if b < 65 or 91 <= b <= 96 or 123 <= b <= 127 else b for b in range(256))


def visible(html: str) -> str:
    """The text of a page: scripts, styles, comments and tags are blanks, character references are characters.

    One pass from left to right; what is never closed is looked for once, so a page takes time in proportion to its length.
    """
    out, at, gone = [], 0, set()
    while (start := html.find("<", at)) >= 0:
        out.append(html[at:start])
        end = None
        if (m := _HIDES.match(html, start)) and (kind := m[1] and m[1].lower()) not in gone:
            end = _ENDS[kind].search(html, m.end())
            if end is None:
                gone.add(kind)
        if end is None and (close := html.find(">", start)) < 0:
            at = start
            break
        at = end.end() if end else close + 1
    return unescape(" ".join([*out, html[at:]]))


def trigrams(text: bytes) -> np.ndarray:
    """Bucket numbers of the byte trigrams of the words of a text, A-Z in lower case, gaps between words as one space."""
    data = np.frombuffer(b" " + b" ".join(text.translate(_SKIP).split()) + b" ", np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64)
    code = (data[:-2] << 16 | data[1:-1] << 8 | data[2:]) * np.uint32(2654435761)
    return (code >> np.uint32(16)).astype(np.int64)


def fit(docs: DataFrame, rows: int = FIT_ROWS) -> tuple[list[str], np.ndarray]:
    """(languages, log-probabilities by bucket and language) from rows with lang and text; rows without either are left out, repeated texts count
    once. Every language of the fitted texts has a column of 65 536 numbers."""
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text", F.xxhash64("text").alias("h"))
    n = labelled.select("h").distinct().count()
    if n > rows:  # hashes are uniform over 2**64: the threshold keeps about ``rows`` distinct texts
        labelled = labelled.where(F.col("h") < F.lit(int((rows / n - 0.5) * 2**64)))
    labelled = labelled.groupBy("lang", "h").agg(F.any_value("text").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                sums[lang] += np.bincount(trigrams(text.encode("utf-8", "surrogatepass")), minlength=BUCKETS)
        for lang, c in sums.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(c[at])], ["lang", "bucket", "c"])

    found = cut(labelled.mapInArrow(count, "lang string, bucket int, c bigint").groupBy("lang", "bucket").agg(F.sum("c").alias("c")))
    langs = sorted(r.lang for r in found.groupBy("lang").agg(F.sum("c").alias("n")).collect())
    table = np.full((BUCKETS, max(len(langs), 1)), 0.5)
    number = {x: i for i, x in enumerate(langs)}
    for r in found.toArrow().to_pylist() if langs else []:  # at most BUCKETS rows for each language
        table[r["bucket"], number[r["lang"]]] += r["c"]
    return langs, np.log(table / table.sum(axis=0)).astype(np.float32)


def declared_of(html: Column) -> Column:
    """The primary subtag of the lang attribute of the html element, in lower case; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b", 1), F.lit("")))


def suffix_of(host: Column) -> Column:
    return F.coalesce(F.element_at(F.split(host, r"\."), -1), F.lit(""))


def identify(pages: DataFrame, docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(page_id, host, declared, text_lang, lang, probability) per row of ``pages``.

    A null html or url is empty: such evidence is uniform. text_lang is what the text alone suggests (null for no text), lang the fused
    result; ties go to the first language in order. Repeated rows get equal results; without labelled texts lang and probability are null.
    """
    spark = pages.sparkSession
    langs, table = fit(docs, fit_rows)
    shared = spark.sparkContext.broadcast(table)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            out = []
            for html in batch.column("html").to_pylist():
                at = trigrams(visible(html or "").encode("utf-8", "surrogatepass"))
                score = model[at].sum(axis=0, dtype=np.float64) if len(at) else np.zeros(model.shape[1])
                score *= min(1.0, EVIDENCE / max(len(at), 1))
                out.append((score - score.max()).tolist() if len(at) else None)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "host", "declared")), pa.array(out, pa.list_(pa.float64()))], ["page_id", "host", "declared", "text"])

    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), declared_of(F.col("html")).alias("declared"), "html")
    rows = rows.mapInArrow(read, f"page_id {dict(pages.dtypes)['page_id']}, host string, declared string, text array<double>")
    if not langs:
        return rows.select("page_id", "host", "declared", *(F.lit(None).cast("string").alias(c) for c in ("text_lang", "lang")), F.lit(None).cast("double").alias("probability"))
    names = F.array(*(F.lit(x) for x in langs))
    best = lambda a: F.get(names, (F.array_position(a, F.array_max(a)) - 1).cast("int"))
    rows = cut(rows.withColumn("text_lang", best(F.col("text"))).withColumn("suffix", suffix_of(F.col("host"))))
    sums = [F.sum((F.col("text_lang") == x).cast("double")) for x in langs]
    counts = lambda by, to: sized(stored(rows.where("text_lang IS NOT NULL").groupBy(F.col(by).alias(f"_{by}")).agg(F.array(*(F.coalesce(s, F.lit(0.0)) for s in sums)).alias(to)), to))
    whole = [float(x or 0) for x in rows.agg(*sums).first()]
    total = sum(whole)
    base = [(x + 1) / (total + len(langs)) for x in whole]
    n_declared = max(rows.select("declared").distinct().count(), 1)
    found = rows.join(counts("suffix", "by_suffix"), F.col("suffix") == F.col("_suffix"), "left").join(counts("declared", "by_declared"), F.col("declared") == F.col("_declared"), "left").join(counts("host", "by_host"), F.col("host") == F.col("_host"), "left")

    def posterior(i: int, x: str) -> Column:
        own = F.when(F.col("text_lang") == x, 1.0).otherwise(0.0)
        mine = F.when(F.col("text_lang").isNotNull(), 1.0).otherwise(0.0)
        at = lambda c: F.coalesce(F.get(c, F.lit(i)), F.lit(0.0))
        size = lambda c: F.coalesce(F.aggregate(c, F.lit(0.0), lambda a, b: a + b), F.lit(0.0))
        by_suffix = (at("by_suffix") - own + SUFFIX_WEIGHT * base[i]) / (size("by_suffix") - mine + SUFFIX_WEIGHT)
        by_host = (at("by_host") - own + HOST_WEIGHT * by_suffix) / (size("by_host") - mine + HOST_WEIGHT)
        declared = F.when(F.col("declared") == "", 1.0).otherwise((at("by_declared") - own + DECLARED_WEIGHT) / (F.lit(whole[i]) - own + DECLARED_WEIGHT * n_declared))
        return at("text") + F.log(by_host) + F.log(declared)

    found = found.withColumn("log", F.array(*(posterior(i, x) for i, x in enumerate(langs)))).withColumn("top", F.array_max("log"))
    share = 1 / F.aggregate("log", F.lit(0.0), lambda a, b: a + F.exp(b - F.col("top")))
    return found.select("page_id", "host", "declared", "text_lang", best(F.col("log")).alias("lang"), share.alias("probability"))
