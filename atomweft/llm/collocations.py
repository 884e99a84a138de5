"""Phrase collocations by best-first branch-and-bound growth.

A phrase of two to five words is as strong as its weakest cut: floor(1000 a n / (l r)), with its count a, those of its parts l and r, and n words
in all of the language. As a <= r, no phrase that begins with a word of count c scores over 1000 n / c: the counts of prefixes bound all that
grows from them.

1. Texts are tokenised once, in chunks of about half a million words of one language: numbers of words with zeros between pieces, and the chunk's own
   list of words. Words are named by 64-bit hashes; should two words share one, all are hashed anew with another seed, so that names are exact.
2. The frontier is ordered by its bounds, so by the counts of first words. A band takes the best of it, first words that cover a small share
   of all words, then twice as much each time, and grows it level by level. The phrases of a level go to the chunks as a prefix tree, at most
   ``NODES`` at a time (a bound of what is sent at once, not of the search); each chunk adds up which words follow them, and the sums of all
   chunks that reach ``least`` are the next level.
3. A phrase is part of a longer one that is as frequent if all its occurrences have the same word after them (then a child has its count) or
   before them (seen while counting). The others survive; the counts of their suffixes come from the chunks in the same way, and give scores.
4. A language is settled when no bound in the frontier reaches the score of its last place; ties reach it.

Between steps everything is a table in the shared folder; only up to NODES phrases at a time come to the driver.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from atomweft.llm.common import sized, stored

LEAST, LONGEST, TOP = 100, 5, 2000
UNKNOWN = "und"
#: Phrases that are sent to the chunks at once, and the share of all words that the first band covers (a count of first words at least).
NODES, SHARE = 200_000, 8
CHUNK_WORDS = 1 << 19
#: Bytes of text that are tokenised at once, and rows that a task hands over at once: a worker holds a few dozen times as much, beside its chunk.
SLICE_BYTES, ROWS = 1 << 20, 1 << 16

_LOWER = bytes(b + 32 if 0x41 <= b < 0x5B else b for b in range(256))
#: 0: part of a word, 1: blank, 2: end of a piece.
_KIND = bytes(1 if b in b" \t" else 2 if b in b".,;:!?\n\v\f\r" else 0 for b in range(256))

THOUSAND = "CAST(1000 AS DECIMAL(4,0))"
CHUNK = "lang string, codes binary, words array<string>, counts array<bigint>"
NAMES = [f"w{k}" for k in range(1, LONGEST + 1)]
COUNTS = [f"c{k}" for k in range(1, LONGEST + 1)]


# --- chunks


def _through(data: np.ndarray, table: bytes) -> np.ndarray:
    return np.frombuffer(data.tobytes().translate(table), np.uint8)


def split_words(data: np.ndarray, starts: np.ndarray, broken: bool) -> tuple[pa.Array, np.ndarray, bool]:
    """(the words, whether a piece begins at each, whether one begins after them) of texts in a row that start at ``starts``; ``broken``: at the first word too."""
    kind = _through(data, _KIND)
    inside = kind == 0
    first = np.zeros(data.size, bool)
    first[starts[starts < data.size]] = True
    begins = inside & (first | np.concatenate([[True], ~inside[:-1]])) if data.size else inside
    at = np.flatnonzero(begins)
    borders = np.cumsum((kind == 2) | first, dtype=np.int32)
    kept = np.cumsum(inside, dtype=np.int32)
    here = borders[at]
    breaks = np.empty(at.size, bool)
    if at.size:
        breaks[0] = broken or here[0] > 0
        breaks[1:] = here[1:] > here[:-1]
    after = bool(borders[-1] > here[-1]) if at.size else broken or bool(data.size and borders[-1] > 0)
    offsets = np.append(kept[at] - 1, kept[-1] if data.size else 0).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), at.size, [None, pa.py_buffer(offsets), pa.py_buffer(_through(data[inside], _LOWER))])
    return words, breaks, after


def _windows(text: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in parts of about SLICE_BYTES, cut at the ends of pieces if there are any, else at blanks; a part without either is longer."""
    at, size = 0, SLICE_BYTES
    while at + size < text.size:
        kind = _through(text[at : at + size], _KIND)
        ends = np.flatnonzero(kind[1:] == 2)
        ends = ends if ends.size else np.flatnonzero(kind[1:])
        if not ends.size:
            size *= 2
            continue
        yield text[at : at + int(ends[-1]) + 1]
        at, size = at + int(ends[-1]) + 1, SLICE_BYTES
    yield text[at:]


def _list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


class _Held:
    """Words of a language that wait for their chunk to be full."""

    def __init__(self, lang: str) -> None:
        self.lang, self.size, self.broken = lang, 0, True
        self.words: list[pa.Array] = []
        self.breaks: list[np.ndarray] = []

    def add(self, data: np.ndarray, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        words, breaks, self.broken = split_words(data, starts, self.broken)
        if not len(words):
            return
        if self.size >= CHUNK_WORDS and breaks[0]:
            yield self.flush()
        self.words.append(words)
        self.breaks.append(breaks)
        self.size += len(words)

    def flush(self) -> pa.RecordBatch:
        words, self.words = pa.concat_arrays(self.words), []
        found = words.dictionary_encode()
        del words
        codes = found.indices.to_numpy().astype(np.uint32) + 1
        counts = np.bincount(codes, minlength=len(found.dictionary) + 1)[1:]
        out = np.insert(codes, np.flatnonzero(np.concatenate(self.breaks)), 0).astype("<u4")
        self.breaks, self.size = [], 0
        values = [pa.array([self.lang]), pa.array([out.tobytes()], pa.binary()), _list(found.dictionary.cast(pa.binary()).cast(pa.string())), _list(pa.array(counts))]
        return pa.RecordBatch.from_arrays(values, ["lang", "codes", "words", "counts"])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, _Held] = {}
    for batch in batches:
        for lang in batch.column("lang").unique().to_pylist():
            own = held.setdefault(lang, _Held(lang))
            texts = batch.filter(pc.equal(batch.column("lang"), lang)).column("text").cast(pa.large_binary())
            _, offsets, buffer = texts.buffers()
            at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
            data = np.frombuffer(buffer, np.uint8) if buffer else np.zeros(0, np.uint8)
            k = 0
            while k < len(texts):
                to = max(k + 1, int(np.searchsorted(at, at[k] + SLICE_BYTES, "right")) - 1)
                own.broken = True
                if to == k + 1:
                    for i, part in enumerate(_windows(data[at[k] : at[to]])):
                        yield from own.add(part, np.zeros(1 - min(i, 1), np.int64))
                else:
                    yield from own.add(data[at[k] : at[to]], at[k:to] - at[k])
                k = to
        if sum(x.size for x in held.values()) >= 4 * CHUNK_WORDS:  # many languages
            for own in held.values():
                if own.size:
                    yield own.flush()
                    own.broken = True
            held.clear()
    for own in held.values():
        if own.size:
            yield own.flush()


def tokenised(docs: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """(chunks, words): stored rows (lang, codes, hashes) and (lang, word, h, f), the hashes under ``seed``."""
    rows = docs.select(F.coalesce(F.col("lang"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    for salt in range(seed, seed + 64):
        name = lambda lang, word: F.xxhash64(F.lit(salt), lang, word)  # noqa: B023, E731
        chunks = stored(rows.mapInArrow(_chunks, CHUNK).withColumn("hashes", F.transform("words", lambda w: name(F.col("lang"), w))), "chunks")
        each = chunks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x")).select("lang", F.col("x.words").alias("word"), F.col("x.counts").alias("c"))
        words = stored(each.groupBy("lang", "word").agg(F.sum("c").alias("f")).withColumn("h", name(F.col("lang"), F.col("word"))), "words")
        if not words.groupBy("h").count().where("count > 1").limit(1).count():
            return chunks.select("lang", "codes", "hashes"), words
    raise AssertionError("words share hashes under every seed")


# --- prefix trees over chunks


class Tree:
    """Phrases (rows of hashes, ``size`` of them in each, with their ids) as a prefix tree; a chunk follows them through its numbers of words."""

    def __init__(self, words: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        self.ids = ids
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # parent, word and phrase (or -1) of each node
        node = np.zeros(size.size, np.int64)
        for k in range(int(size.max(initial=0))):
            there = np.flatnonzero(size > k)
            keys = np.empty(there.size, [("p", np.int64), ("w", np.int64)])
            keys["p"], keys["w"] = node[there], words[there, k]
            nodes, node_of = np.unique(keys, return_inverse=True)
            phrase = np.full(nodes.size, -1, np.int64)
            ends = size[there] == k + 1
            phrase[node_of[ends]] = there[ends]
            self.levels.append((nodes["p"].copy(), nodes["w"].copy(), phrase))
            node[there] = node_of

    def follow(self, codes: np.ndarray, hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, places, phrases) of all occurrences in a chunk, by length. ``codes`` ends with a zero for each further word."""
        order = np.argsort(hashes)
        known = hashes[order]
        wide = hashes.size + 1
        at = node = None
        for k, (parent, word, phrase) in enumerate(self.levels):
            place = np.minimum(np.searchsorted(known, word), known.size - 1)
            own = np.flatnonzero(known[place] == word)
            code = order[place[own]] + 1
            if at is None:
                first = np.full(wide, -1, np.int32)  # a tree has far fewer nodes
                first[code] = own
                node = first[codes]
                at = np.flatnonzero(node >= 0)
                node = node[at]
            else:
                keys = parent[own] * wide + code
                rank = np.argsort(keys)
                keys, own = keys[rank], own[rank]
                following = codes[at + k].astype(np.int64)
                if keys.size:
                    key = node * wide + following
                    place = np.minimum(np.searchsorted(keys, key), keys.size - 1)
                    hit = (keys[place] == key) & (following > 0)
                    at, node = at[hit], own[place[hit]]
                else:
                    at = node = np.zeros(0, np.int64)
            found = phrase[node]
            yield k + 1, at[found >= 0], found[found >= 0]


def _each_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for codes, hashes in zip(batch.column("codes"), batch.column("hashes")):
            yield np.concatenate([[np.uint32(0)], np.frombuffer(codes.as_buffer(), "<u4"), np.zeros(LONGEST, np.uint32)]), hashes.values.to_numpy()


def _batches(columns: list[np.ndarray], names: list[str]) -> Iterator[pa.RecordBatch]:
    for k in range(0, columns[0].size, ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(c[k : k + ROWS]) for c in columns], names)


def _extend(tree: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (id, next, c, with_prev, low, high): how often a word follows a phrase in the chunk, how often a word is before both, its least and greatest hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, hashes in _each_chunk(batches):
            named = np.concatenate([[np.int64(0)], hashes])
            for length, at, phrase in tree.value.follow(codes, hashes):
                following = codes[at + length].astype(np.int64)
                there = following > 0
                at, phrase, following = at[there], phrase[there], following[there]
                if not at.size:
                    continue
                key = phrase * named.size + following
                order = np.argsort(key)
                key, before = key[order], codes[at[order] - 1]
                starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                prev = named[before]
                columns = [tree.value.ids[key[starts] // named.size], named[key[starts] % named.size], np.diff(np.append(starts, key.size)), np.add.reduceat((before > 0).astype(np.int64), starts)]
                columns += [np.minimum.reduceat(prev, starts), np.maximum.reduceat(prev, starts)] if length + 1 < LONGEST else [np.zeros(starts.size, np.int64)] * 2
                del at, phrase, following, order, key, before, prev
                yield from _batches(columns, ["id", "next", "c", "with_prev", "low", "high"])

    return run


def _count(tree: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (id, c): how often the phrases occur in the chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, hashes in _each_chunk(batches):
            for _, _, phrase in tree.value.follow(codes, hashes):
                found, c = np.unique(phrase, return_counts=True)
                yield from _batches([tree.value.ids[found], c], ["id", "c"])

    return run


def _trees(phrases: DataFrame, nodes: int) -> Iterator[tuple[DataFrame, Broadcast]]:
    """(some of the stored ``phrases`` (id, len and their words), their tree), at most ``nodes`` at once: classes of a hash of the words, about half full."""
    total = phrases.count()
    parts = 1 if total <= nodes else -(-2 * total // nodes)
    names = [n for n in NAMES if n in phrases.columns]
    for k in range(parts if total else 0):
        some = phrases if parts == 1 else phrases.where(F.pmod(F.xxhash64(*names), F.lit(parts)) == k)
        table = some.select("id", "len", *names).toArrow()
        words = np.stack([table.column(w).fill_null(0).to_numpy() for w in names], axis=1)
        yield some, phrases.sparkSession.sparkContext.broadcast(Tree(words, table.column("len").to_numpy(), table.column("id").to_numpy()))


def _named(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored with a unique id for each row."""
    return stored(df.withColumn("id", F.monotonically_increasing_id()), name)


# --- the search


def _grow(level: DataFrame, chunks: DataFrame, least: int, nodes: int) -> tuple[DataFrame | None, list[DataFrame]]:
    """(the next level, the phrases of this one that no child is as frequent as) of the phrases in ``level``."""
    parts, ended = [], []
    for some, tree in _trees(level, nodes):
        sums = chunks.mapInArrow(_extend(tree), "id bigint, next bigint, c bigint, with_prev bigint, low bigint, high bigint").groupBy("id", "next")
        sums = sums.agg(F.sum("c").alias("c"), F.sum("with_prev").alias("with_prev"), F.min("low").alias("low"), F.max("high").alias("high")).where(F.col("c") >= least)
        grown = sums.join(F.broadcast(some.drop("left", "parent")), "id").select(
            "lang",
            (F.col("len") + 1).alias("len"),
            F.col("c").alias("a"),
            *(F.when(F.col("len") == k, F.col("next")).otherwise(F.col(w)).alias(w) for k, w in enumerate(NAMES)),
            *(F.when(F.col("len") == k, F.col("c")).otherwise(F.col(x)).alias(x) for k, x in enumerate(COUNTS)),
            ((F.col("with_prev") == F.col("c")) & (F.col("low") == F.col("high"))).alias("left"),
            F.col("id").alias("parent"),
        )
        grown = _named(grown, "level")
        most = grown.groupBy(F.col("parent").alias("id")).agg(F.max("a").alias("most"))  # no more rows than were sent
        ended.append(some.where("len > 1 AND NOT left").join(F.broadcast(most), "id", "left").where("most IS NULL OR most < a"))
        parts.append(grown)
    if len(parts) < 2:
        return (parts or [None])[0], ended
    return _named(functools.reduce(DataFrame.unionAll, parts).drop("id"), "level"), ended  # ids were unique in each part only


SUFFIX = [f"s{k}" for k in range(1, LONGEST)]


def _scored(found: DataFrame, chunks: DataFrame, totals: DataFrame, nodes: int) -> DataFrame:
    """``found`` (surviving phrases) with l, r, score and n of the weakest cut; the counts of all suffixes come from the chunks."""
    cuts = found.select("*", F.explode(F.sequence(F.lit(1), F.col("len") - 1)).alias("k"))
    suffix = (F.coalesce(F.get(F.array(*NAMES), F.col("k") + i), F.lit(0)).alias(s) for i, s in enumerate(SUFFIX))
    cuts = stored(cuts.select("*", *suffix, (F.col("len") - F.col("k")).alias("rest"), F.get(F.array(*COUNTS), F.col("k") - 1).alias("l")), "cuts")
    wanted = _named(cuts.select(*(F.col(s).alias(w) for s, w in zip(SUFFIX, NAMES)), F.col("rest").alias("len")).distinct(), "suffixes")
    counts = []
    for some, tree in _trees(wanted, nodes):
        sums = chunks.mapInArrow(_count(tree), "id bigint, c bigint").groupBy("id").agg(F.sum("c").alias("r"))
        counts.append(stored(sums.join(F.broadcast(some), "id").select(*(F.col(w).alias(s) for s, w in zip(SUFFIX, NAMES)), F.col("len").alias("rest"), "r"), "counted"))
    if not counts:
        return cuts.select("lang", *NAMES, "len", "a", "l", F.col("l").alias("r"), F.col("l").alias("n"), F.col("l").alias("score"))  # no rows
    rows = cuts.join(sized(functools.reduce(DataFrame.unionAll, counts)), [*SUFFIX, "rest"]).join(sized(totals), "lang")
    score = F.expr(f"{THOUSAND} * CAST(a AS DECIMAL(17,0)) * CAST(n AS DECIMAL(17,0)) div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))")
    best = rows.withColumn("score", score).groupBy("lang", *NAMES, "len", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))
    return best.select("lang", *NAMES, "len", "a", "x.l", "x.r", "n", "x.score")


def _leaders(scored: DataFrame, top: int) -> DataFrame:
    """(lang, last): the score of the last place of each language that has ``top`` phrases."""
    ranked = scored.select("lang", "score", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"))).alias("place")).where(F.col("place") <= top)
    return ranked.groupBy("lang").agg(F.min("score").alias("last"), F.count(F.lit(1)).alias("there")).where(F.col("there") == top).drop("there")


def _band(frontier: DataFrame, cover: int) -> int | None:
    """The greatest count of first words in the next band: so many counts as cover ``cover`` words at most, one at least. None if there are none."""
    rows = frontier.groupBy("a").agg(F.sum("a").alias("cover")).orderBy("a").limit(10_000).collect()
    covered, last = 0, None
    for row in rows:
        covered += row.cover
        if last is not None and covered > cover:
            break
        last = row.a
    return last


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, nodes: int = NODES, share: int = SHARE, seed: int = 42) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language by score, then a (both descending), then phrase.

    Words are lower-cased in A-Z only; pieces end at line breaks and at . , ; : ! ? and no phrase goes beyond one. A null lang counts as ``und``, a
    null text as empty; repeated rows count each; an empty table gives an empty result. Columns other than text and lang are not looked at.
    """
    if least < 1 or top < 1:
        raise ValueError("least and top must be positive")
    spark = docs.sparkSession
    chunks, words = tokenised(docs, seed)
    totals = stored(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    cover = max(1, (totals.agg(F.sum("n")).first()[0] or 0) // share)
    none = F.lit(None).cast("bigint")
    first = words.where(F.col("f") >= least).select("lang", F.lit(1).alias("len"), F.col("f").alias("a"), F.col("h").alias("w1"), *(none.alias(w) for w in NAMES[1:]), F.col("f").alias("c1"), *(none.alias(c) for c in COUNTS[1:]), F.lit(False).alias("left"), none.alias("parent"))
    frontier = _named(first.join(sized(totals), "lang").withColumn("bound", F.expr(f"{THOUSAND} * CAST(n AS DECIMAL(17,0)) div a")).drop("n"), "frontier")
    kept = ["lang", "len", "a", *NAMES, *COUNTS]
    scored: DataFrame | None = None
    while (most := _band(frontier, cover)) is not None:
        level, found = frontier.where(F.col("a") <= most).drop("bound"), []
        for _ in range(LONGEST - 1):
            level, ended = _grow(level, chunks, least, nodes)
            found += ended
            if level is None:
                break
        found = [x.select(kept) for x in ([*found, level] if level is not None else found)]
        if found:
            new = _scored(functools.reduce(DataFrame.unionAll, found), chunks, totals, nodes)
            scored = stored(new if scored is None else scored.unionAll(new), "scored")
        frontier, cover = frontier.where(F.col("a") > most), cover * 2
        if scored is not None:
            leaders = sized(stored(_leaders(scored, top), "leaders"))
            frontier = frontier.join(leaders, "lang", "left").where("last IS NULL OR bound >= last").drop("last")
            scored = scored.join(leaders, "lang", "left").where("last IS NULL OR score >= last").drop("last")
    if scored is None:
        return spark.createDataFrame([], "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint")
    scored = stored(scored, "scored")
    each = stored(scored.select("lang", *NAMES, F.posexplode(F.array_compact(F.array(*NAMES))).alias("at", "h")), "each")
    texts = words.select("h", "word").join(sized(each), "h").groupBy("lang", *NAMES).agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("x"))
    texts = texts.select(*(F.col(c).alias(f"_{c}") for c in ("lang", *NAMES)), F.array_join("x.word", " ").alias("phrase"))
    full = scored.join(texts, functools.reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("lang", *NAMES)))).select("lang", "phrase", "a", "l", "r", "n", "score")
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return full.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
