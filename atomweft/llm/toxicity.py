"""Toxicity of restored text.

A token that looks disguised (digits or signs among letters, repeated letters, letters set apart) is a noisy copy of a clean spelling. Its
lattice has for each character the letters that it may stand for, for each run the shorter runs, and, where letters are set apart, for each
gap a word's end or nothing; Viterbi decoding under a character trigram model of the corpus picks the likeliest clean spelling. Accents are
taken off before. Documents are then scored by restored words.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atomweft.llm.common import cut, sized, stored

#: What a sign may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "aeiou", "€": "e", "£": "l", "¡": "i"}
LETTERS = "abcdefghijklmnopqrstuvwxyz"
EDGE = "^"
#: Code of a character in the model: letters, then the edge of a word; trigrams over 27 codes bound the model.
CODES = {c: i for i, c in enumerate(LETTERS + EDGE)}
SIZE = len(CODES)
#: Channel costs (natural logs): a letter as written, a sign read as a letter, a repeated letter dropped.
KEEP, SWAP, DROP = 0.0, -1.5, -0.7
#: A letter written twice is mostly spelling, so dropping it costs more than in a run of three or more.
DROP_PAIR = -4.0
#: Bounds on the labelled rows that the weights are fitted on, and on the terms (words and word beginnings) that get a weight.
FIT_ROWS = 30_000
FIT_TERMS = 256
#: A term counts if at least so many toxic texts, and this share of them, have it, and its excess over chance is so many deviations.
MIN_TOXIC, MIN_SHARE, MIN_DEVIATIONS = 4, 0.01, 6.0
#: Lengths of word beginnings that serve as terms, so that inflected forms of a word are learnt together.
STEMS = (4, 5, 6, 7)
RIDGE = 0.02

_WORD = re.compile(r"[^\W_]+")
_SIGN = re.compile("[" + re.escape("".join(LEET)) + "]")
_LETTER = re.compile("[a-z]")
#: A letter three times, or two letters twice: spelling seldom has these.
_STRETCHED = re.compile(r"([a-z])\1\1|([a-z])\2.*([a-z])\3")
_RUN = re.compile(r"(.)\1{3,}", re.S)
#: Signs that stand at the end of a token as punctuation do not belong to its word.
_EDGES = ".,;:?\"'()[]{}<>=~`^%&#-_/\\!|+*"
#: Single characters set apart, within a token by signs or over several by blanks.
_DOTTED = re.compile(r"[a-z0-9@$!](?:[.\-_*][a-z0-9@$!]){2,}")
_BLANKS = re.compile(r"(?<!\S)[a-z0-9@$!](?:\s{1,3}[a-z0-9@$!]){2,}(?!\S)")
_GAPS = re.compile(r"[\s.\-_*]+")
#: Characters that are decoded together; what is longer is decoded piece by piece.
PIECE = 64


def plain(token: str) -> str:
    """``token`` without accents and with runs of over three equal characters cut to three."""
    if not token.isascii():
        token = "".join(c for c in unicodedata.normalize("NFKD", token) if not unicodedata.combining(c))
    return _RUN.sub(r"\1\1\1", token)


@dataclass
class Decoder:
    """Viterbi over the lattice of a token; ``model[a, b, c]`` is the log-probability of c after a, b."""

    model: np.ndarray
    known: dict[str, str] = field(default_factory=dict)

    def __call__(self, token: str, gaps: bool = False) -> str:
        """The clean spelling; with ``gaps`` every place between two characters may end a word, which a blank then marks."""
        key = " " * gaps + token
        found = self.known.get(key)
        if found is None:
            if len(self.known) > 200_000:
                self.known.clear()  # a cache, bounded
            found = self.known[key] = "".join(self._decode(token[k : k + PIECE], gaps) for k in range(0, len(token), PIECE))
        return found

    def _decode(self, token: str, gaps: bool) -> str:
        model, edge = self.model, CODES[EDGE]
        fresh = (edge, edge)
        states: dict[tuple[int, int], tuple[float, str]] = {fresh: (0.0, "")}
        for at, char in enumerate(token):
            after: dict[tuple[int, int], tuple[float, str]] = {}

            def offer(key: tuple[int, int], score: float, text: str) -> None:
                if key not in after or score > after[key][0]:
                    after[key] = (score, text)

            options = [(char, KEEP)] if char in CODES else [(c, SWAP) for c in LEET.get(char, "")]
            repeat = at > 0 and token[at - 1] == char
            run = char * 3 in token[max(at - 2, 0) : at + 3]
            for (a, b), (score, text) in states.items():
                if not options:
                    offer((a, b), score + DROP, text)
                for letter, cost in options:
                    c = CODES[letter]
                    offer((b, c), score + cost + float(model[a, b, c]), text + letter)
                    if repeat and text[-1:] == letter:
                        offer((a, b), score + (DROP if run else DROP_PAIR), text)
            if gaps:
                for (a, b), (score, text) in list(after.items()):
                    if (a, b) != fresh:
                        offer(fresh, score + float(model[a, b, edge]), text + " ")
            states = after
        return max(((score + (float(model[a, b, edge]) if (a, b) != fresh or not text else 0.0), text) for (a, b), (score, text) in states.items()), default=(0.0, ""))[1]


def token_words(token: str, decode: Decoder) -> tuple[str, ...]:
    """The words of a lower-case token; a disguised token gives its plain words and the restored one."""
    core = token.strip(_EDGES)
    if core.isalpha():
        base = plain(core)
        return (core, decode(base)) if base.isascii() and _STRETCHED.search(base) else (core,)
    found = _WORD.findall(token)
    base = plain(token)
    core = base.strip(_EDGES)
    if _LETTER.search(core):
        if _DOTTED.fullmatch(core):
            found += apart(core, decode)
        else:
            marked = base.lstrip(_EDGES).rstrip(".,;:?\"')]}>=~`^%&#-_/\\!|+*") if base[-1:] != "$" else base.lstrip(_EDGES)
            if _SIGN.search(marked):
                found.append(decode(marked))
    return tuple(found)


def apart(text: str, decode: Decoder) -> list[str]:
    """The words of characters that were set apart: as one word, and as the likeliest words where that is several."""
    letters = _GAPS.sub("", text)
    several = decode(letters, gaps=True).split()
    return [decode(letters), *(several if len(several) > 1 else [])]


def tokens_of(text: str | None, decode: Decoder) -> Counter:
    """The distinct tokens of the text with their counts; letters set apart by blanks are restored and added as tokens."""
    low = (text or "").lower()
    found = Counter(low.split())
    singles = sum(n for x, n in found.items() if len(x) == 1)
    if singles >= 3:
        for m in _BLANKS.finditer(low):
            found.update(apart(m[0], decode))
    return found


def restored_words(text: str | None, decode: Decoder) -> Counter:
    """The words of the text with their counts, disguised ones restored."""
    out: Counter = Counter()
    for token, n in tokens_of(text, decode).items():
        for word in token_words(token, decode):
            out[word] += n
    return out


def terms(word: str) -> list[str]:
    return ["=" + word, *(word[:n] for n in STEMS if len(word) > n)]


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Character trigram counts of plain words, each distinct word of a batch of texts counted once."""
    counts, edge = np.zeros(SIZE**3, np.int64), CODES[EDGE]
    table = np.full(256, edge, np.int64)
    for c, i in CODES.items():
        table[ord(c)] = i
    for batch in batches:
        words: set[str] = set()
        for text in batch.column("text").to_pylist():
            words.update((text or "").lower().split())
        words = {w for x in words if (w := x.strip(_EDGES)).isalpha() and w.isascii()}
        if words:
            codes = table[np.frombuffer((EDGE + EDGE + (EDGE + EDGE).join(words) + EDGE).encode(), np.uint8)]
            code = (codes[:-2] * SIZE + codes[1:-1]) * SIZE + codes[2:]
            counts += np.bincount(code, minlength=SIZE**3)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["code", "c"])


def char_model(docs: DataFrame) -> np.ndarray:
    """Interpolated trigram log-probabilities over the letters and the word edge: at most 27**3 rows come to the driver."""
    rows = docs.select("text").mapInArrow(_trigrams, "code bigint, c bigint").groupBy("code").agg(F.sum("c").alias("c")).collect()
    three = np.zeros(SIZE**3)
    for r in rows:
        three[r.code] = r.c
    three = three.reshape(SIZE, SIZE, SIZE)
    three[:, CODES[EDGE], CODES[EDGE]] = 0  # joins between words
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p1 = (one + 1) / (one.sum() + SIZE)
    p2 = (two + 5 * p1) / (two.sum(axis=1, keepdims=True) + 5)
    p3 = (three + 5 * p2[None]) / (three.sum(axis=2, keepdims=True) + 5)
    return np.log(p3)


@dataclass
class Weights:
    """A logistic model over the densities of terms: occurrences for each hundred words, five at most."""

    bias: float
    index: dict[str, int]
    values: np.ndarray
    _seen: dict[str, tuple[int, ...]] = field(default_factory=dict)

    @cached_property
    def starts(self) -> set[str]:
        """The first letters of the terms: no other word can hit."""
        return {x.removeprefix("=")[: STEMS[0]] for x in self.index}


    def _hits(self, token: str, decode: Decoder) -> tuple[int, ...]:
        index, starts, hits = self.index, self.starts, []
        for word in token_words(token, decode):
            if word[: STEMS[0]] in starts:
                hits += [index[x] for x in terms(word) if x in index]
        return tuple(hits)

    def densities(self, text: str | None, decode: Decoder) -> dict[int, float]:
        """Term number to density. Most tokens hit nothing, which a bounded cache knows."""
        seen, out, found = self._seen, {}, tokens_of(text, decode)
        if len(seen) > 300_000:
            seen.clear()
        for token, n in found.items():
            hits = seen.get(token)
            if hits is None:
                hits = seen[token] = self._hits(token, decode)
            for i in hits:
                out[i] = out.get(i, 0) + n
        scale = 100 / max(found.total(), 1)
        return {i: min(n * scale, 5.0) for i, n in out.items()}

    def score(self, text: str | None, decode: Decoder) -> float:
        x = self.bias + sum(self.values[i] * d for i, d in self.densities(text, decode).items())
        return float(1 / (1 + math.exp(-max(-50.0, min(50.0, x)))))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float, rounds: int = 25) -> np.ndarray:
    """Newton steps for ridge logistic regression; the first column is the constant and is not penalised."""
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge * len(y) / 100 + 1e-6)
    penalty[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def labelled_sample(docs: DataFrame, marks: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(text, toxic) of about ``rows`` distinct labelled texts, or all if there are fewer: those whose hash is under a threshold.

    Ids and hashes choose the rows; only the chosen texts are read, where they lie.
    """
    keyed = docs.select("doc_id", F.xxhash64("text").alias("_h")).join(sized(cut(marks)), F.col("doc_id") == F.col("_id"))
    distinct = cut(keyed.groupBy("_h").agg(F.min("doc_id").alias("_id"), F.max("toxic").alias("toxic")))
    n = distinct.count()
    if n > rows:
        distinct = distinct.where(F.col("_h") < F.lit(int((rows / n - 0.5) * 2**64)))
    chosen = F.broadcast(distinct)  # about ``rows`` rows of three numbers
    texts = docs.select("doc_id", "text").join(chosen, (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_h")))
    return stored(texts.select("text", F.col("toxic").cast("int").alias("toxic")), "labelled")


def fit(train: DataFrame, model: np.ndarray, limit: int = FIT_TERMS) -> Weights:
    """Fits on (text, toxic) rows, at most ``limit`` terms. A term is a feature if it is in clearly more toxic texts than chance explains."""
    shared = train.sparkSession.sparkContext.broadcast(model)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = Decoder(shared.value)
        for batch in batches:
            every: Counter = Counter()
            toxics: Counter = Counter()
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                found = {x for w in restored_words(text, decode) for x in terms(w)} | {""}
                every.update(found)
                if toxic:
                    toxics.update(found)
            yield pa.RecordBatch.from_arrays([pa.array(list(every), pa.string()), pa.array([toxics[x] for x in every], pa.int64()), pa.array(list(every.values()), pa.int64())], ["term", "t", "n"])

    counts = train.mapInArrow(spread, "term string, t bigint, n bigint").groupBy("term").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
    counts = cut(counts.where((F.col("t") >= MIN_TOXIC) | (F.col("term") == "")))
    whole = counts.where("term = ''").first()
    toxic, total = (int(whole.t), int(whole.n)) if whole else (0, 0)
    share = F.lit(toxic / max(total, 1))
    excess = (F.col("t") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share))
    usual = (F.col("term") != "") & (F.col("t") >= F.lit(max(MIN_TOXIC, MIN_SHARE * toxic)))
    top = [r.term for r in counts.where(usual).select("term", excess.alias("z")).where(F.col("z") >= MIN_DEVIATIONS).orderBy(F.desc("z"), "term").limit(limit).collect()]
    if not top:
        return Weights(min(math.log((toxic + 0.5) / (total - toxic + 0.5)), -1.0), {}, np.zeros(0))
    empty = Weights(0.0, {x: i for i, x in enumerate(top)}, np.zeros(len(top)))
    given = train.sparkSession.sparkContext.broadcast(empty)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = Decoder(shared.value)
        for batch in batches:
            found = [given.value.densities(t, decode) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array([list(d) for d in found], pa.list_(pa.int32())), pa.array([list(d.values()) for d in found], pa.list_(pa.float32()))], ["toxic", "at", "value"])

    sample = train.mapInArrow(measure, "toxic int, at array<int>, value array<float>").toArrow()
    x, y = np.zeros((sample.num_rows, len(top) + 1)), sample.column("toxic").to_numpy().astype(float)
    x[:, 0] = 1
    for i, (at, value) in enumerate(zip(sample.column("at").to_pylist(), sample.column("value").to_pylist())):
        x[i, [k + 1 for k in at]] = value
    w = _logistic(x, y, RIDGE)
    return Weights(float(w[0]), empty.index, w[1:])


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``.

    Labels are used only for rows whose crc32(doc_id) is not in the held-out fold; scores read nothing but the text. Null and empty texts
    have no words and get the bias alone; rows without a doc_id, a label or with a null label are not learnt from; repeated rows get equal
    scores; without labels every score is the same low value. The character model reads all texts.
    """
    spark = docs.sparkSession
    held = lambda c: F.coalesce(F.pmod(F.crc32(c.cast("string")), F.lit(folds)) == fold, F.lit(False))
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).select(F.col("doc_id").alias("_id"), "toxic")
    model = char_model(docs)
    texts = docs.select("doc_id", "text")
    weights = fit(labelled_sample(docs, marks), model)
    shared = spark.sparkContext.broadcast((model, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, weights = shared.value
        decode = Decoder(model)
        for batch in batches:
            scores = [weights.score(t, decode) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = texts.mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", held(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
