"""Language-model scores from a weighted backoff automaton over all n-grams of the training texts, up to three words.

A state is a context that training texts have: a pair of words, a word, or nothing. It has an arc for each word that followed it, and a
failure arc to the context without its first word for all others. Counts are smoothed by hierarchical Dirichlet priors, so an arc weighs
log((c + k * p) / (C + k)) with the probability p of the word in the shorter context, the failure arc log(k / (C + k)), and every state's
arcs and failure path sum to one. Nothing is pruned: states and arcs grow with the corpus, and no table of them is ever in one place.

1. Texts are tokenised once, in chunks of about a million tokens, kept as packed numbers of words in the shared folder.
2. Each chunk sends the distinct n-grams of its texts, dealt over ``parts`` by hash, with their counts in its training texts. An n-gram comes
   from a chunk once at most, so that no n-gram weighs more than the number of chunks, and a part adds the counts up.
3. The counts go back to the chunks: each gets just the states and arcs of the automaton that its texts can reach. One left-to-right
   traversal of the texts carries the state (the longest context that training texts have), follows failure arcs where a word has no arc, and
   adds log-probabilities. The two words before a token determine the state, so the steps of all texts of a chunk are taken at once.

N-grams are told apart by 40 bits of a hash besides those of their part (words by 48): about one n-gram in a million shares its count with
another; that two of a hundred million words do has a chance under one in a hundred.
"""

from __future__ import annotations

import math
import struct
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atomweft.llm.common import stored

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: The token that ends a text, and the mark before it, which is context only. No word is empty or holds a blank.
END, START = b"", b" "
#: A chunk ends at so many tokens, distinct words or documents.
CHUNK_TOKENS, CHUNK_WORDS, CHUNK_DOCS = 1_400_000, 1 << 18, 60_000
#: Bytes of text for each part.
PART_BYTES = 16 << 20
#: Weights of the shorter context, in counts, for contexts of one and of two words.
KAPPA = (256.0, 4.0)
_CODEC = "zstd"
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


def tokens(text: str | None) -> list[bytes]:
    found = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    found.append(END)
    return found


def _packed(*arrays: np.ndarray) -> bytes:
    """Unsigned numbers as planes of bytes, lowest first, compressed."""
    out = []
    for a in arrays:
        width = max(1, (int(a.max(initial=0)).bit_length() + 7) // 8)
        planes = np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
        body = pa.Codec(_CODEC, compression_level=1).compress(planes, asbytes=True)
        out.append(struct.pack("<QQB", len(a), len(body), width) + body)
    return b"".join(out)


def _unpacked(data: bytes) -> list[np.ndarray]:
    found, at = [], 0
    while at < len(data):
        n, size, width = struct.unpack_from("<QQB", data, at)
        at += 17
        planes = np.frombuffer(pa.Codec(_CODEC).decompress(data[at : at + size], n * width, asbytes=True), np.uint8).reshape(width, n)
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :width] = planes.T
        found.append(wide.view("<u8").ravel())
        at += size
    return found



def _chunks(most: int):
    """A row per chunk: packed word numbers (frequent words have small ones), the words' hashes, and the documents in order."""

    def fresh():
        number = defaultdict(count().__next__)
        return number, [number[START], number[END]], [], [], [], []

    def packed(seq: int, number: dict[bytes, int], seqs: list[np.ndarray], ids: list, lengths: list[int], trains: list[bool]) -> pa.RecordBatch:
        flat = np.concatenate(seqs)
        times = np.bincount(flat, minlength=len(number))
        times[:2] = flat.size + 1  # the marks are numbers 0 and 1
        order = np.argsort(-times, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        words = list(number)
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(words[i]) for i in order), np.uint64, len(order))
        data = _packed(rank[flat].astype(np.uint64), hashes)
        return pa.RecordBatch.from_arrays([pa.array([seq]), pa.array([data], pa.binary()), pa.array([ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int32())), pa.array([trains], pa.list_(pa.bool_()))], ["chunk", "data", "doc_id", "length", "train"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, size = TaskContext.get().partitionId() << 24, 0
        number, _, seqs, ids, lengths, trains = fresh()
        for batch in batches:
            for i, text in enumerate(batch.column("text")):
                found = tokens(text.as_py())
                seqs.append(np.fromiter(map(number.__getitem__, found), np.int64, len(found)))
                ids.append(batch.column("doc_id")[i].as_py())
                trains.append(batch.column("train")[i].as_py())
                lengths.append(len(found))
                size += len(found)
                if size >= most or len(number) >= CHUNK_WORDS or len(ids) >= CHUNK_DOCS:
                    yield packed(seq, number, seqs, ids, lengths, trains)
                    seq, size = seq + 1, 0
                    number, _, seqs, ids, lengths, trains = fresh()
        if ids:
            yield packed(seq, number, seqs, ids, lengths, trains)

    return run


@dataclass
class Grams:
    """The n-grams of a chunk: for each order the distinct ones (part and low hash bits in one number, ascending), and which each step has."""

    doc: np.ndarray
    steps: np.ndarray
    inner: np.ndarray
    first: np.ndarray
    keys: list[np.ndarray]
    at: list[np.ndarray]


def _bits(n: int, part_bits: int) -> int:
    """Hash bits of an n-gram besides those of its part."""
    return min(48 if n == 1 else 40, 64 - part_bits)


def grams(data: bytes, lengths: np.ndarray, part_bits: int, orders: tuple[int, ...] = (1, 2, 3)) -> Grams:
    """``steps`` are the word numbers in order; ``inner`` tells which have two words (marks included) before them in their text."""
    steps, hashes = _unpacked(data)
    steps = steps.astype(np.int32)
    ends = np.cumsum(lengths)
    doc = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    first = np.zeros(len(steps), bool)
    first[ends - lengths] = True
    inner = ~first
    h = hashes[steps]
    before = np.r_[hashes[:1], h[:-1]]
    before[first] = hashes[0]
    keys, at = [], []
    with np.errstate(over="ignore"):
        two = _mixed(before * _FACTORS[0] + h)
        del before
        three = _mixed(np.r_[two[:1], two[:-1]] * _FACTORS[1] + h)[inner] if 3 in orders else None
        del h
    for n in orders:
        value = [hashes, two, three][n - 1] >> np.uint64(64 - part_bits - _bits(n, part_bits))
        distinct, inverse = np.unique(value, return_inverse=True)
        keys.append(distinct)
        at.append(inverse.astype(np.int32))
    return Grams(doc, steps, inner, first, keys, at)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _split(keys: np.ndarray, n: int, part_bits: int) -> list[tuple[int, slice]]:
    """(part, its slice) of ascending keys."""
    part = (keys >> np.uint64(_bits(n, part_bits))).astype(np.int64)
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.zeros(0, np.int64)
    return [(int(part[a]), slice(a, b)) for a, b in zip(starts, np.r_[starts[1:], len(part)])]


SENT = "chunk bigint, n int, part int, data binary"


def _send(part_bits: int, orders: tuple[int, ...]):
    """The distinct n-grams of each chunk by part, as steps between ascending hashes, with their counts in training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = grams(row["data"], np.array(row["length"], np.int64), part_bits, orders)
                train = np.array(row["train"], bool)[found.doc]
                out = []
                for n, keys, at in zip(orders, found.keys, found.at):
                    if n == 1:
                        times = np.bincount(at[found.steps], weights=train, minlength=len(keys))
                        times[at[0]] = np.array(row["train"], bool).sum()  # the mark before each text
                    else:
                        times = np.bincount(at, weights=train if n == 2 else train[found.inner], minlength=len(keys))
                    times, low = times.astype(np.uint64), keys & np.uint64((1 << _bits(n, part_bits)) - 1)
                    out += [(n, part, _packed(np.diff(low[s], prepend=np.uint64(0)), times[s])) for part, s in _split(keys, n, part_bits)]
                for k in range(0, len(out), 1000):
                    some = out[k : k + 1000]
                    yield pa.RecordBatch.from_arrays([pa.array([row["chunk"]] * len(some), pa.int64()), pa.array([x[0] for x in some], pa.int32()), pa.array([x[1] for x in some], pa.int32()), pa.array([x[2] for x in some], pa.binary())], ["chunk", "n", "part", "data"])

    return run


FIGURES = "total bigint, types bigint, ones bigint, twos bigint"


def _add_up(part_bits: int):
    """One part: the counts of all chunks added up and given back to each, in its order. For words also a row of figures, without the start mark."""
    schema = pa.schema([("chunk", pa.int64()), ("n", pa.int32()), ("part", pa.int32()), ("data", pa.binary()), ("total", pa.int64()), ("types", pa.int64()), ("ones", pa.int64()), ("twos", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        n, part = table.column("n")[0].as_py(), table.column("part")[0].as_py()
        lows, counts, sizes = [], [], []
        for data in table.column("data"):
            steps, times = _unpacked(data.as_py())
            lows.append(np.cumsum(steps, dtype=np.uint64))
            counts.append(times)
            sizes.append(len(times))
        distinct, at = np.unique(np.concatenate(lows), return_inverse=True)
        sums = np.bincount(at, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.uint64)
        back = [_packed(x) for x in np.split(sums[at], np.cumsum(sizes)[:-1])]
        m = len(back)
        rows = pa.Table.from_arrays([table.column("chunk").combine_chunks(), pa.array(np.full(m, n, np.int32)), pa.array(np.full(m, part, np.int32)), pa.array(back, pa.binary()), *(pa.nulls(m, pa.int64()) for _ in range(4))], schema=schema)
        if n > 1:
            return rows
        mark = np.uint64(xxhash.xxh3_64_intdigest(START)) >> np.uint64(64 - part_bits - _bits(1, part_bits))
        if int(mark) >> _bits(1, part_bits) == part:
            sums = np.delete(sums, np.flatnonzero(distinct == (mark & np.uint64((1 << _bits(1, part_bits)) - 1))))
        figures = pa.Table.from_arrays([pa.nulls(1, pa.int64()), pa.array([1], pa.int32()), pa.array([part], pa.int32()), pa.nulls(1, pa.binary()), *(pa.array([int(x)], pa.int64()) for x in (sums.sum(), (sums > 0).sum(), (sums == 1).sum(), (sums == 2).sum()))], schema=schema)
        return pa.concat_tables([rows, figures])

    return run


@dataclass(frozen=True)
class Corpus:
    """Figures of the training tokens: all, distinct words, and words seen once and twice."""

    total: int
    types: int
    ones: int
    twos: int

    def word_log(self, c: np.ndarray) -> np.ndarray:
        """log10 probability of a word in the state without context: absolute discounting, the discounted mass goes to the one unknown word."""
        if not self.total:
            return np.full(len(c), math.log10(0.5))
        d = self.ones / (self.ones + 2 * self.twos) if self.ones and self.twos else 0.5
        return np.where(c > 0, np.log10(np.maximum(c - d, 1e-9)) - math.log10(self.total), math.log10(d * self.types / self.total))


def follow(c: np.ndarray, context: np.ndarray, kappa: float, lower: np.ndarray) -> np.ndarray:
    """log10 weights of one step from a state seen ``context`` times: its arc where it has one (count ``c``), else the failure arc and the
    step from the shorter context, ``lower``."""
    fail = math.log10(kappa) - np.log10(context + kappa)
    return np.where(c > 0, np.log10(c + kappa * 10.0**lower) - np.log10(context + kappa), fail + lower)


def traverse(found: Grams, counts: list[np.ndarray], corpus: Corpus, kappa: tuple[float, float] = KAPPA) -> np.ndarray:
    """log10 probability of each step of the texts; ``counts`` are those of the chunk's distinct n-grams, by order."""
    word, pair = counts[0][found.at[0]], counts[1][found.at[1]]
    c1 = word[found.steps]
    before = np.r_[word[:1], c1[:-1]]
    before[found.first] = word[0]
    log = follow(pair, before, kappa[0], corpus.word_log(c1))
    context = np.r_[0.0, pair[:-1]][found.inner]
    log[found.inner] = follow(counts[2][found.at[2]], context, kappa[1], log[found.inner])
    return log


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds)) == fold, F.lit(False))


def _score(part_bits: int, corpus: Corpus):
    """One chunk with the counts of its n-grams: a row per document."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["n"], r["part"]))
        chunk = rows[0]
        lengths = np.array(chunk["length"], np.int64)
        found = grams(chunk["data"], lengths, part_bits)
        counts = [np.concatenate([*(_unpacked(r["data"])[0] for r in rows if r["n"] == n), np.zeros(0, np.uint64)]).astype(np.float64) for n in (1, 2, 3)]
        c = counts[0][found.at[0]][found.steps]
        add = lambda x: np.bincount(found.doc, weights=x, minlength=len(lengths))
        base = add(np.log10(c + 1)) - lengths * math.log10(corpus.total + corpus.types + 1)
        cols = [pa.array(chunk["doc_id"], pa.int64()), pa.array(lengths), pa.array(add(c > 0).astype(np.int64)), pa.array(base), pa.array(add(traverse(found, counts, corpus)))]
        return pa.Table.from_arrays(cols, ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return run


def score_documents(docs: DataFrame, folds: int = 7, fold: int = 2, chunk_tokens: int = CHUNK_TOKENS, part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs``.

    Texts of the held-out fold of crc32(doc_id) teach nothing. A null text has the end token only; a null doc_id is a training row;
    repeated rows each count and get equal scores; without any training token all words are unknown and scores are finite. A text is in one
    chunk, however long.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    part_bits = min(20, max(3, math.ceil(math.log2(max(size / part_bytes, 1)))))
    texts = docs.select("doc_id", "text", (~held_out(F.col("doc_id"), folds, fold)).alias("train"))
    chunks = stored(texts.mapInArrow(_chunks(chunk_tokens), "chunk bigint, data binary, doc_id array<bigint>, length array<int>, train array<boolean>"), "chunks")
    sent = lambda *orders: chunks.select("chunk", "data", "length", "train").mapInArrow(_send(part_bits, orders), SENT).groupBy("n", "part").applyInArrow(_add_up(part_bits), f"{SENT}, {FIGURES}")
    words = stored(sent(1), "words")
    corpus = Corpus(*(x or 0 for x in words.agg(*(F.sum(x.split()[0]) for x in FIGURES.split(", "))).first()))
    back = words.where("chunk IS NOT NULL").unionByName(sent(2, 3)).select("chunk", "n", "part", "data")
    rows = chunks.select("chunk", F.lit(0).alias("n"), F.lit(0).alias("part"), "data", "doc_id", "length").unionByName(back, allowMissingColumns=True)
    scored = rows.groupBy("chunk").applyInArrow(_score(part_bits, corpus), "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double")
    return scored.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "n_tokens", "n_known", F.lit(corpus.total).cast("bigint").alias("train_tokens"), "base_score", "score")
