"""Quality rules with adaptive thresholds (DataFrame functions only).

Fixed cut-offs fail across languages and sources, so the limits are learnt from the rows: each (language, source) keeps a mergeable KLL
quantile sketch per measure, and sketches of small groups are merged upwards (source -> language -> all); if even all rows are too few there is
no adaptive verdict. Equal texts of a group have one vote, so that copies of one page do not set the limits. A row is rejected when a ratio is
more than ``whisker`` spreads beyond the quartiles of its group. The spread is the distance of the quartiles, wider for texts shorter than
the group's median by the root of their lengths, as means of few words scatter more; and no less than what one event adds to the ratio of
that text (one symbol, one repeated line, or the words of a line and its copy, by the group's median line) or, for the word length, than the
standard error of a mean of so many words, by the group's median scatter of the words of a text: neither can be told more finely. No limit is fixed beforehand.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atomweft.llm.common import ASCII_SPACE, cut, sized, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Fences:
    """``whisker`` spreads beyond a quartile are tolerated. Groups under ``min_rows`` distinct texts borrow the merged sketch of the level above."""

    whisker: float = 3.0
    min_rows: int = 50
    sketch_k: int = 800


RATIOS = ["symbol_ratio", "dup_line_ratio", "repeat_ratio", "word_length"]
#: Ratios for which too little is as odd as too much.
TWO_SIDED = ["word_length"]
#: Measures of which the limits need the median.
SIZES = ["n_words", "line_words", "word_spread"]


def _repeat_words(found: Column, n: Column) -> tuple[Column, Column, Callable[[Column], Column], Callable[[Column], Column]]:
    """(whether a 3-word window occurs twice, the windows, the positions of repeated ones, the number of words that these cover).

    Most texts repeat no window, which their distinct hashes tell; only others sort their windows by hash with the position, so that equal
    ones are neighbours. A word counts once however many windows hold it.
    """
    of = lambda i: F.xxhash64(F.get(found, i), F.get(found, i + 1), F.get(found, i + 2))
    starts = F.sequence(F.lit(0), n - 3)
    again = F.coalesce(F.size(F.array_distinct(F.when(n >= 3, F.transform(starts, of)))) < n - 2, F.lit(False)) & (n >= 3)
    windows = F.array_sort(F.transform(starts, lambda i: F.struct(of(i).alias("h"), i.alias("p"))))
    same = lambda s, i, j: F.coalesce(F.get(s, i).h == F.get(s, j).h, F.lit(False))
    repeated = lambda s: F.array_sort(F.transform(F.filter(s, lambda x, i: same(s, i, i - 1) | same(s, i, i + 1)), lambda x: x.p))
    covered = lambda at: F.aggregate(F.transform(at, lambda p, i: F.least(F.coalesce(F.get(at, i + 1) - p, F.lit(3)), F.lit(3))), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return again, windows, repeated, covered


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (long), base_failed and the ratios. A null text counts as empty."""
    value = F.coalesce(F.col(text), F.lit(""))
    again, windows, repeated, covered = _repeat_words(F.col("_words"), F.col("n_words").cast("int"))
    lines = F.filter(F.split(value, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return (
        docs.withColumn("_words", words(F.col(text)))
        .withColumn("_lines", lines)
        .select(
            "*",
            F.size("_words").cast("bigint").alias("n_words"),
            F.length(F.regexp_replace(value, ASCII_SPACE, "")).cast("bigint").alias("word_chars"),
            (F.length(value) - F.length(F.translate(value, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
            F.size("_lines").cast("bigint").alias("n_lines"),
            F.aggregate("_words", F.lit(0).cast("bigint"), lambda a, w: a + F.length(w) * F.length(w)).alias("_squares"),
        )
        .withColumn("_windows", F.when(again, windows))
        .withColumn("_at", repeated(F.col("_windows")))
        .withColumn("n_repeat_words", F.coalesce(covered(F.col("_at")), F.lit(0)).cast("bigint"))
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
        .withColumns({"symbol_ratio": _per("n_symbols", "n_words"), "dup_line_ratio": _per("n_dup_lines", "n_lines"), "repeat_ratio": _per("n_repeat_words", "n_words"), "word_length": _per("word_chars", "n_words"), "line_words": _per("n_words", "n_lines")})
        .withColumn("word_spread", F.sqrt(F.greatest(F.lit(0.0), _per("_squares", "n_words") - F.col("word_length") * F.col("word_length"))))
        .drop("_words", "_lines", "_windows", "_at", "_squares")
    )


def _per(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def thresholds(measured: DataFrame, fences: Fences = Fences(), lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per (lang, source) with ``low_<ratio>`` and ``high_<ratio>`` (the quartiles) and ``mid_<size>`` (medians) of its level, null where
    all rows together are fewer than ``min_rows``. Every row has a vote, but those that failed the base rules.

    Only sketches move: partial sketches are merged per group, then per language, then once for all groups.
    """
    names = [*RATIOS, *SIZES]
    good = measured.where("NOT base_failed")
    group = good.groupBy(F.col(lang).alias("_lang"), F.col(source).alias("_source")).agg(F.count(F.lit(1)).alias("_n"), *(F.kll_sketch_agg_double(F.col(r).cast("double"), fences.sketch_k).alias(r) for r in names))
    group = cut(group)
    by_lang = group.groupBy("_lang").agg(F.sum("_n").alias("_n_lang"), *(F.kll_merge_agg_double(r, fences.sketch_k).alias(f"{r}_lang") for r in names))
    overall = by_lang.agg(F.coalesce(F.sum("_n_lang"), F.lit(0)).alias("_n"), *(F.kll_merge_agg_double(f"{r}_lang", fences.sketch_k).alias(r) for r in names)).first()  # one sketch per measure
    pairs = measured.select(F.col(lang).alias("_lang"), F.col(source).alias("_source")).distinct()
    joined = (
        pairs.alias("p")
        .join(group.alias("g"), F.col("p._lang").eqNullSafe(F.col("g._lang")) & F.col("p._source").eqNullSafe(F.col("g._source")), "left")
        .join(by_lang.alias("l"), F.col("p._lang").eqNullSafe(F.col("l._lang")), "left")
    )

    def quantile(name: str, q: float) -> Column:
        sketch = F.when(F.col("_n") >= fences.min_rows, F.col(f"g.{name}")).when(F.col("_n_lang") >= fences.min_rows, F.col(f"{name}_lang")).when(F.lit(overall["_n"] >= fences.min_rows), F.lit(overall[name]))
        return F.kll_sketch_get_quantile_double(sketch, F.lit(q))

    quartiles = [quantile(r, q).alias(f"{side}_{r}") for r in RATIOS for side, q in (("low", 0.25), ("high", 0.75))]
    return joined.select(F.col("p._lang").alias("_lang"), F.col("p._source").alias("_source"), *quartiles, *(quantile(r, 0.5).alias(f"mid_{r}") for r in SIZES))


def beyond(fences: Fences = Fences()) -> Column:
    """The names of the ratios of a row (with its group's quartiles and medians) that lie beyond the limits, as an array; no limits, none."""
    shorter = F.sqrt(F.greatest(F.lit(1.0), F.col("mid_n_words") / F.col("n_words")))
    event = {"symbol_ratio": 1 / F.col("n_words"), "dup_line_ratio": 1 / F.col("n_lines"), "repeat_ratio": 2 * F.col("mid_line_words") / F.col("n_words"), "word_length": F.col("mid_word_spread") / F.sqrt("n_words")}
    names = []
    for r in RATIOS:
        reach = fences.whisker * F.greatest((F.col(f"high_{r}") - F.col(f"low_{r}")) * shorter, event[r])
        odd = F.col(r) > F.col(f"high_{r}") + reach
        names.append(F.when(odd | (F.col(r) < F.col(f"low_{r}") - reach) if r in TWO_SIDED else odd, F.lit(r)))
    return F.array_compact(F.array(*names))


def judge(measured: DataFrame, limits: DataFrame, fences: Fences = Fences(), lang: str = "lang", source: str = "source") -> DataFrame:
    """``measured`` with ``beyond`` (the ratios beyond their group's limits; none for base_failed) and ``kept``: neither base_failed nor any beyond.

    The limits have one row per (lang, source), which may be many; they are broadcast only up to a checked number of rows.
    """
    on = F.col(lang).eqNullSafe(F.col("_lang")) & F.col(source).eqNullSafe(F.col("_source"))
    joined = measured.join(sized(limits), on, "left").withColumn("beyond", F.when(F.col("base_failed"), F.array().cast("array<string>")).otherwise(beyond(fences)))
    return joined.withColumn("kept", ~F.col("base_failed") & (F.size("beyond") == 0)).drop(*(c for c in limits.columns))


def quality_rules(docs: DataFrame, fences: Fences = Fences()) -> DataFrame:
    """(doc_id, lang, source, text_hash, measures, base_failed, beyond, kept) for every row of ``docs``.

    Texts are read once: the measures are small and are kept in the shared folder, and the limits and verdicts come from them. Null or
    empty texts have no words and fail; null lang or source form groups of their own; repeated rows get the same verdict, and texts that a
    group holds more than once have one vote (told apart by text_hash); an empty table gives an empty result. Columns other than doc_id, text, lang and source are not looked at.
    """
    narrow = docs.select("doc_id", "text", "lang", "source")
    measured = cut(measure(narrow).withColumn("text_hash", F.xxhash64("text")).drop("text"))
    votes = measured.dropDuplicates(["lang", "source", "text_hash"])  # narrow rows; copies meet before the shuffle
    return judge(measured, cut(thresholds(votes, fences)), fences)


def keep_good(docs: DataFrame, fences: Fences = Fences()) -> DataFrame:
    """The rows of ``docs`` that pass, all columns kept. Rejected rows are matched by doc_id and text hash (null-safe)."""
    bad = cut(quality_rules(docs, fences).where("NOT kept").select(F.col("doc_id").alias("_aw_id"), F.col("text_hash").alias("_aw_hash")).distinct())
    return docs.join(sized(bad), F.col("doc_id").eqNullSafe(F.col("_aw_id")) & (F.xxhash64("text") == F.col("_aw_hash")), "left_anti")
