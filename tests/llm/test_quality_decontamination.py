import hashlib
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from atomweft.llm import decontamination, quality

from .cases import empty_docs, key, odd_docs, prose

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ITEM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_measures(text):
    text = text or ""
    words = SPACE.findall(text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def test_measures_of_odd_rows(spark):
    docs = odd_docs(spark, "kept n_words text_hash _words")
    got = quality.quality_rules(docs).collect()
    want = [(r.doc_id, *brute_measures(r.text)) for r in docs.collect()]
    assert key([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got]) == key(want)
    assert all(not (r.kept and r.base_failed) for r in got)
    assert quality.quality_rules(empty_docs(spark)).count() == 0


def test_limits_are_learnt_by_group(spark):
    rows = [(i, prose(i, 60), "en", "plain" if i % 2 else "table", 1) for i in range(200)]
    rows = [(i, t.replace(" ", " | ") if s == "table" else t, lang, s, n) for i, t, lang, s, n in rows]
    rows += [(900, prose(7, 60).replace(" ", " # "), "en", "plain", 1), (901, prose(9, 60).replace(" ", " | "), "en", "table", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = {r.doc_id for r in quality.quality_rules(docs).where("kept").collect()}
    assert 900 not in kept and 901 in kept and len(kept) >= 200
    out = quality.keep_good(docs)
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == kept


def measured_rows(spark, rows):
    """Rows of (lang, source, n_words, n_symbols, word_chars) as measured ones of ten-word lines without repeats."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id bigint, lang string, source string, n_words bigint, n_symbols bigint, word_chars bigint")
    ratios = {"symbol_ratio": F.col("n_symbols") / F.col("n_words"), "dup_line_ratio": F.lit(0.0), "repeat_ratio": F.lit(0.0), "word_length": F.col("word_chars") / F.col("n_words"), "line_words": F.lit(10.0), "word_spread": F.lit(0.0)}
    return df.withColumns({"n_lines": F.ceil(F.col("n_words") / 10), "base_failed": F.lit(False), **ratios})


def test_limits_of_large_groups_are_within_the_error_of_the_sketch(spark):
    rng = np.random.default_rng(1)
    rows = [("en", "ab"[i % 2], int(n), int(n * r), int(n * (5 + i % 2) + w * n**0.5)) for i, (n, r, w) in enumerate(zip(rng.integers(50, 900, 60_000), rng.random(60_000), rng.normal(0, 2, 60_000)))]  # means of words scatter by the root of their number
    measured = measured_rows(spark, rows).cache()
    limits = {r._source: r for r in quality.thresholds(measured).collect()}
    for source in "ab":
        own = measured.where(F.col("source") == source)
        for ratio, side, q in [(r, side, q) for r in ("symbol_ratio", "word_length") for side, q in (("low", 0.25), ("high", 0.75))] + [("n_words", "mid", 0.5)]:
            value = limits[source][f"{side}_{ratio}"]
            below, upto = own.agg(F.avg((F.col(ratio) < value).cast("int")), F.avg((F.col(ratio) <= value).cast("int"))).first()
            assert below - 0.006 <= q <= upto + 0.006
    kept = quality.judge(measured, quality.thresholds(measured))
    assert kept.where("NOT kept").count() < 60


def test_the_groups_spread_decides_on_both_sides_and_one_event_where_there_is_none(spark):
    rows = [("en", "wide", 100, i % 21, 480 + i % 41) for i in range(300)] + [("en", "plain", 100, 0, 500) for _ in range(300)]
    odd = [("en", "wide", 100, 40, 500), ("en", "wide", 100, 50, 500), ("en", "plain", 100, 3, 500), ("en", "plain", 100, 4, 500), ("en", "wide", 100, 5, 430), ("en", "wide", 100, 5, 420), ("en", "wide", 100, 5, 580), ("en", "wide", 25, 5, 105)]
    measured = measured_rows(spark, rows + odd)
    got = {r.doc_id - 600: r.beyond for r in quality.judge(measured, quality.thresholds(measured)).collect()}
    assert all(not x for i, x in got.items() if i < 0)
    assert [got[i] for i in range(8)] == [[], ["symbol_ratio"], [], ["symbol_ratio"], [], ["word_length"], ["word_length"], []]


def test_copies_of_one_text_do_not_set_the_limits(spark):
    rng = np.random.default_rng(3)
    clean = [(i, " ".join(f"{'abcdefghijklmnop'[:rng.integers(2, 12)]}{rng.integers(90)}" for _ in range(80 + i % 7)), "en", "a", 1) for i in range(100)]
    odd = [(900, " ".join(["x" * 40 + str(i) for i in range(80)]), "en", "a", 1)]
    for copies in (0, 50, 150, 400):
        docs = spark.createDataFrame(clean + odd + [(1000 + i, *clean[7][1:]) for i in range(copies)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
        kept = {r.doc_id for r in quality.quality_rules(docs).where("kept").select("doc_id").collect()}
        assert kept == set(range(100)) | set(range(1000, 1000 + copies))


def test_no_limits_of_too_few_rows(spark):
    docs = spark.createDataFrame([(i, prose(i, 60), "en", "a", 1) for i in range(30)] + [(30, prose(3, 60).replace(" ", " # "), "en", "a", 1)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert quality.quality_rules(docs).where("kept").count() == 31


def test_keep_good_of_odd_rows(spark):
    docs = odd_docs(spark, "_id _hash kept")
    out = quality.keep_good(docs)
    assert out.columns == docs.columns and sorted(r.doc_id or 0 for r in out.select("doc_id").collect())[:2] == [-5, 0]


def brute_hits(text, items):
    low = lambda t: ITEM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, found = low(text), set(), set()
    for item, t in items:
        w = low(t)
        n = min(10, len(w))
        for g in {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else ():
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) == g:
                    hit |= set(range(i + 1, i + n + 1))
                    found.add(item)
    ids = sorted(str(i) for i in found if i is not None)
    return len(words), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)


ITEMS = [(1, prose(1, 30)), (10, prose(1, 12).upper()), (2, "One!"), (3, None), (4, ""), (5, "é-ß"), (None, prose(5, 15)), (1, prose(1, 30)), (9, prose(9, 11))]


def test_contamination_of_odd_rows_by_both_joins(spark):
    docs = odd_docs(spark, "w p len items at n_words")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    want = key([(r.doc_id, *brute_hits(r.text, ITEMS)) for r in docs.collect()])
    for limit in (decontamination.BROADCAST_WINDOWS, 0):
        got = decontamination.summarise(decontamination.find_contamination(docs, items, broadcast_windows=limit)).collect()
        assert key([tuple(r) for r in got]) == want
    none = decontamination.summarise(decontamination.find_contamination(docs, items.limit(0))).collect()
    assert len(none) == docs.count() and not any(r.contaminated for r in none)
    assert decontamination.find_contamination(empty_docs(spark), items).count() == 0


def test_removal(spark):
    docs = odd_docs(spark, "_at _id")
    items = spark.createDataFrame([(1, prose(1, 30))], "item_id bigint, text string")
    clean = decontamination.decontaminate(docs, items)
    assert clean.columns == docs.columns and not {1, 2} & {r.doc_id for r in clean.collect()} and clean.count() == docs.count() - 3
    cut = {r.doc_id: r.text for r in decontamination.decontaminate(docs, items, remove="spans").collect()}
    assert cut[2] == " ".join(prose(1, 80).split()[30:]) and cut[8] == "one"
