"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints that share a bucket (the bits of one table's mask) are compared. A batch stores its fingerprints as vertical bit planes: word k
of plane b holds bit b of 64 fingerprints. The distances of 64 pairs are then updated at once by carry-save adders, and words whose 64 pairs
are all beyond the radius are abandoned. With ``exact_tables`` every pair within the radius shares a bucket, so no link is lost.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atomweft.llm.common import connected_components, cut, partitions, sized, stored

#: Byte table that lower-cases A-Z; bytes.split() without arguments splits at exactly \x20 and \x09-\x0D.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SEED = 42
#: Members of one bucket that one task compares with each other; larger buckets are cut into tiles and every pair of tiles is a task's group.
TILE = 4096
#: Rows that a task compares in one batch of small buckets.
BATCH = 1 << 16
#: Members of a tile and rows of a batch where every pair is looked at, not a forest: bounds the pairs that a task holds. Shingles compared at once.
EVERY_TILE, EVERY_BATCH, COLUMNS = 1024, 1 << 13, 4096
#: Up to this many members all shifts of a bucket stay within neighbouring 64-bit words.
SMALL = 64
CHUNK = 1 << 20


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()


def _grams(found: list[bytes], shingle: int) -> Iterator[bytes]:
    return map(b" ".join, zip(*(found[k:] for k in range(shingle)))) if len(found) >= shingle else iter([b" ".join(found)])


def fingerprint(found: list[bytes], shingle: int, lanes: int, distinct: set[bytes] | None = None) -> list[int]:
    """``lanes`` unsigned 64-bit words of a text's words; a bit is 1 if it is set in over half of the shingle hashes. A repeated shingle counts
    as often as it occurs, unless the set of the text's shingles is given as ``distinct``."""
    if not found:
        return [0] * lanes
    grams, total = (_grams(found, shingle), max(len(found) - shingle + 1, 1)) if distinct is None else (iter(distinct), len(distinct))
    n, counts = 0, np.zeros((lanes, 64), np.int64)
    while n < total:
        part = [g for g, _ in zip(grams, range(min(CHUNK, total - n)))]
        n += len(part)
        for lane in range(lanes):
            hashes = np.array([xxhash.xxh64_intdigest(g, SEED + lane) for g in part], dtype="<u8")
            counts[lane] += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > total).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel().tolist()


def fingerprints(docs: DataFrame, shingle: int = 4, lanes: int = 1, sets: bool = False) -> DataFrame:
    """(doc_id, text_hash, content, size, f0, f1, ...) with the fingerprint's words as longs, a row per row of ``docs``; content is a hash of
    the text's words in order, size the number of distinct shingles. With ``sets`` a fingerprint counts each shingle once; without, repeats count and size is 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, contents, sizes = [], [], []
            for text in batch.column("text"):
                words = words_of(text.as_py())
                distinct = set(_grams(words, shingle)) if sets else None
                found.append(fingerprint(words, shingle, lanes, distinct))
                sizes.append(len(distinct) if sets else 0)
                contents.append(xxhash.xxh64_intdigest(b" ".join(words), ~SEED & 0xFFFF))
            rows = np.array(found, dtype=np.uint64).reshape(-1, lanes)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(np.array(contents, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()), *(pa.array(rows[:, k].view(np.int64)) for k in range(lanes))], ["doc_id", "text_hash", "content", "size", *(f"f{k}" for k in range(lanes))])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(run, ", ".join([f"doc_id {kind}", "text_hash bigint", "content bigint", "size bigint", *(f"f{k} bigint" for k in range(lanes))]))


def exact_tables(bits: int = 64, radius: int = 4) -> list[list[int]]:
    """Masks as bit lists such that any two fingerprints within ``radius`` agree on one: of ``radius + 2`` blocks at least two are equal."""
    blocks = [list(map(int, x)) for x in np.array_split(np.arange(bits), radius + 2)]
    return [a + b for a, b in combinations(blocks, 2)]


def sampled_tables(n: int, bits: int, similarity: float, recall: float = 0.995, seed: int = 7) -> list[list[int]]:
    """Random masks for radii too wide for ``exact_tables``.

    Masks widen with the logarithm of the number ``n`` of fingerprints, so that a bucket of unrelated ones keeps a few hundred members, and
    there are as many as a pair needs to share a bucket with the chance ``recall`` that differs in two deviations more bits than the mean
    of that Jaccard ``similarity``; most pairs differ in fewer.
    """
    width = min(bits // 2, max(10, math.ceil(math.log2(max(n, 1))) - 9))
    agree = (1 - _angle(similarity) - 2 * _deviation(bits, similarity) / bits) ** width
    rng = random.Random(seed)
    return [sorted(rng.sample(range(bits), width)) for _ in range(math.ceil(math.log(1 - recall) / math.log(1 - agree)))]


def _deviation(bits: int, similarity: float) -> float:
    p = _angle(similarity)
    return math.sqrt(bits * p * (1 - p))


def _angle(similarity: float) -> float:
    """The share of fingerprint bits in which two shingle sets of this Jaccard similarity differ: their angle, by its cosine, over pi."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def wide_radius(bits: int, similarity: float) -> int:
    """The mean number of differing bits at that similarity and 3.2 deviations: one pair in a thousand is beyond."""
    return math.ceil(bits * _angle(similarity) + 3.2 * _deviation(bits, similarity))


class _Counters:
    """Bit-sliced sums: level l holds one word of weight 2**l per 64 pairs, and at most one word that waits for its partner."""

    def __init__(self, like: np.ndarray):
        self.zero, self.sums, self.waiting = np.zeros_like(like), [], []

    def add(self, word: np.ndarray, level: int = 0) -> None:
        if level == len(self.sums):
            self.sums.append(self.zero)
            self.waiting.append(None)
        if (other := self.waiting[level]) is None:
            self.waiting[level] = word
            return
        self.waiting[level] = None
        held = self.sums[level]
        half = held ^ other
        self.sums[level] = half ^ word
        self.add((held & other) | (half & word), level + 1)

    def flush(self) -> None:
        level = 0
        while level < len(self.sums):
            if (word := self.waiting[level]) is not None:
                self.waiting[level] = None
                held = self.sums[level]
                self.sums[level] = held ^ word
                if (carry := held & word).any():
                    self.add(carry, level + 1)
            level += 1

    def beyond(self, radius: int) -> np.ndarray:
        """A 1 for every pair whose sum (without the waiting words) is over ``radius``."""
        over, equal = self.zero.copy(), ~self.zero
        for level in range(max(len(self.sums), radius.bit_length()) - 1, -1, -1):
            held = self.sums[level] if level < len(self.sums) else self.zero
            if radius >> level & 1:
                equal &= held
            else:
                over |= equal & held
                equal &= ~held
        return over

    def keep(self, at: np.ndarray) -> None:
        self.zero = self.zero[at]
        self.sums = [x[at] for x in self.sums]
        self.waiting = [None if x is None else x[at] for x in self.waiting]


def _within(difference, bits: int, dead: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(word numbers, match words): 1 where a pair that is not ``dead`` differs in ``radius`` bits at most.

    ``difference(b, at)`` gives plane b of the pairs in the words ``at``. Words in which every pair is dead or beyond are abandoned.
    """
    at = np.flatnonzero(~dead)
    dead, counters = dead[at], _Counters(dead[at])
    for b in range(bits):
        if not len(at):
            break
        counters.add(difference(b, at))
        if b % 8 == 7 and b + 1 < bits:
            gone = dead | counters.beyond(radius)
            alive = np.flatnonzero(~gone)
            if 4 * len(alive) < 3 * len(at):
                at, dead = at[alive], dead[alive]
                counters.keep(alive)
    counters.flush()
    return at, ~(dead | counters.beyond(radius)) if len(at) else np.zeros(0, np.uint64)


def _planes(rows: np.ndarray) -> np.ndarray:
    """(bits, words) planes of (n, lanes) fingerprints, one spare word at the end."""
    bits = np.unpackbits(np.ascontiguousarray(rows).view(np.uint8), axis=1, bitorder="little").T
    padded = np.zeros((bits.shape[0], (len(rows) // 64 + 2) * 64), np.uint8)
    padded[:, : len(rows)] = bits
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


def _packed(flags: np.ndarray, words: int) -> np.ndarray:
    out = np.zeros(words * 8, np.uint8)
    packed = np.packbits(flags, bitorder="little")
    out[: len(packed)] = packed
    return out.view("<u8")


def _lanes(at: np.ndarray, match: np.ndarray) -> np.ndarray:
    hit = np.flatnonzero(match)
    bits = np.unpackbits(match[hit].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, bit = np.nonzero(bits)
    return at[hit][row] * 64 + bit


def forest(n: int, a: np.ndarray, b: np.ndarray, distance: np.ndarray) -> np.ndarray:
    """Numbers of the edges of a minimum spanning forest: it joins, for every r, exactly what the edges of distance up to r join."""
    order = np.argsort(distance, kind="stable")
    a, b = a[order], b[order]
    label, kept, open_ = np.arange(n), [], np.arange(len(a))
    while len(open_):
        la, lb = label[a[open_]], label[b[open_]]
        cross = la != lb
        open_, la, lb = open_[cross], la[cross], lb[cross]
        if not len(open_):
            break
        first = np.full(n, len(open_))
        at = np.arange(len(open_))
        np.minimum.at(first, la, at)
        np.minimum.at(first, lb, at)
        pick = np.unique(first[first < len(open_)])
        high, low = np.maximum(la[pick], lb[pick]), np.minimum(la[pick], lb[pick])
        own = (first[high] == pick).nonzero()[0]  # one hook for each label, by its own least edge
        if not len(own):
            own = np.array([0])
        parent = np.arange(n)
        parent[high[own]] = low[own]
        kept.append(open_[pick[own]])
        while not np.array_equal(above := parent[parent], parent):
            parent = above
        label = parent[label]
    return order[np.concatenate(kept)] if kept else np.zeros(0, np.int64)


def _links(rows: np.ndarray, group: np.ndarray, side: np.ndarray, radius: int, comp: np.ndarray | None = None, size: np.ndarray | None = None, least: float = 0.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forest edges (i, j, distance) between rows of equal ``group``; ``side`` -1 compares all, else only rows of different sides.

    With ``comp`` every pair of different components, not a forest, whose set sizes allow the Jaccard similarity ``least``."""
    found = []
    bits = rows.shape[1] * 64
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    size_of = np.repeat(sizes, sizes)

    def note(i: np.ndarray, j: np.ndarray) -> None:
        if len(i):
            found.append((i, j, np.bitwise_count(rows[i] ^ rows[j]).sum(axis=1, dtype=np.int64)))

    def open_(i, j) -> np.ndarray:
        return (comp[i] != comp[j]) & (np.minimum(size[i], size[j]) >= least * np.maximum(size[i], size[j]) - 1e-9)

    planes = _planes(rows)
    words = planes.shape[1] - 1
    small = size_of <= SMALL
    for lag in range(1, int(sizes[sizes <= SMALL].max(initial=0))):
        pair = (group[lag:] == group[:-lag]) & small[lag:] & ((side[lag:] < 0) | (side[lag:] != side[:-lag]))
        if comp is not None:
            pair &= open_(slice(lag, None), slice(None, -lag))
        if not pair.any():
            continue
        low, high = np.uint64(lag), np.uint64(64 - lag)
        at, match = _within(lambda b, k: planes[b][k] ^ (planes[b][k] >> low | planes[b][k + 1] << high), bits, ~_packed(pair, words), radius)
        i = _lanes(at, match)
        note(i, i + lag)
    for s, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
        own = _planes(rows[s : s + n])[:, :-1]
        width, kept = own.shape[1], (np.zeros(0, np.int64),) * 3
        step = max(64, 8192 // width)
        for q in range(0, n, step):
            query = np.arange(q, min(q + step, n))
            ones = np.where(np.unpackbits(np.ascontiguousarray(rows[s + query]).view(np.uint8), axis=1, bitorder="little").T > 0, ~np.uint64(0), np.uint64(0))
            live = np.zeros((len(query), 64 * width), bool)
            live[:, :n] = np.arange(n)[None, :] > query[:, None]
            live[:, :n] &= (side[s : s + n][None, :] < 0) | (side[s : s + n][None, :] != side[s + query][:, None])
            if comp is not None:
                live[:, :n] &= open_(slice(s, s + n), (s + query)[:, None])
            dead = ~np.packbits(live, axis=1, bitorder="little").view("<u8").ravel()
            at, match = _within(lambda b, k: own[b][k % width] ^ ones[b][k // width], bits, dead, radius)
            lane = _lanes(at, match)
            i, j = query[lane // (64 * width)], lane % (64 * width)
            if comp is not None:
                note(s + i, s + j)
                continue
            d = np.bitwise_count(rows[s + i] ^ rows[s + j]).sum(axis=1, dtype=np.int64)
            a, b, d = (np.concatenate(x) for x in zip(kept, (i, j, d)))
            e = forest(n, a, b, d)
            kept = a[e], b[e], d[e]
        if comp is None:
            found.append((s + kept[0], s + kept[1], kept[2]))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    a, b, d = (np.concatenate(x) for x in zip(*found))
    if comp is not None:
        return a, b, d
    e = forest(len(rows), a, b, d)
    return a[e], b[e], d[e]


def _whole_groups(names: list[str], limit: int, work):
    """Runs ``work`` on columns of a stream sorted by (bucket, t1, t2): whole groups, gathered up to ``limit`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            part = pa.Table.from_batches([batch]).select(names)
            held = part if held is None else pa.concat_tables([held, part])
            if held.num_rows >= limit:
                keys = [held.column(k).to_numpy() for k in ("bucket", "t1", "t2")]
                ends = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1
                if len(ends):
                    yield work(held.slice(0, ends[-1]).combine_chunks())
                    held = held.slice(ends[-1]).combine_chunks()
        if held is not None and held.num_rows:
            yield work(held.combine_chunks())

    return run


def _groups(cols: dict[str, np.ndarray]) -> np.ndarray:
    change = np.zeros(len(cols["bucket"]), bool)
    for k in ("bucket", "t1", "t2"):
        change[1:] |= cols[k][1:] != cols[k][:-1]
    return np.cumsum(change)


def _compare(lanes: int, radius: int, least: float | None = None):
    """Compares streams sorted by (bucket, t1, t2, rep), so that ties always break alike. With ``least`` the rows of each group that are within the
    radius of one of another component come out, else the links of a forest."""
    names = ["bucket", "t1", "t2", "tile", "rep", *(f"f{k}" for k in range(lanes)), *(["comp", "size"] if least is not None else [])]

    def work(table: pa.Table) -> pa.RecordBatch:
        cols = {k: table.column(k).to_numpy().astype(np.int64) for k in names}
        rows = np.stack([cols[f"f{k}"].view(np.uint64) for k in range(lanes)], axis=1)
        side = np.where(cols["t1"] == cols["t2"], -1, cols["tile"])
        i, j, d = _links(rows, _groups(cols), side, radius, *((cols["comp"], cols["size"], least) if least is not None else ()))
        if least is not None:
            at = np.unique(np.r_[i, j])
            return pa.RecordBatch.from_arrays([pa.array(cols[k][at]) for k in CLOSE], CLOSE)
        return pa.RecordBatch.from_arrays([pa.array(cols["rep"][i]), pa.array(cols["rep"][j]), pa.array(d.astype(np.int32))], ["a", "b", "distance"])

    return _whole_groups(names, BATCH if least is None else EVERY_BATCH, work)


CLOSE = ["bucket", "t1", "t2", "tile", "rep", "comp"]


def shared_shingles(sets: list[np.ndarray]) -> np.ndarray:
    """The number of common elements of each two sets, by products of blocks of their incidence matrix."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(x) for x in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = times[column] > 1  # others are common to none
    owner, column = owner[often], column[often]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], np.cumsum(np.r_[False, np.diff(column[order]) != 0]) if len(column) else column
    common = np.zeros((m, m), np.float32)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        block = np.zeros((m, COLUMNS), np.float32)
        block[owner[a:b], column[a:b] - low] = 1
        common += block @ block.T
    return common


def _verify(least: float):
    """A forest of the links of each group of rows (CLOSE and shingles) that join different components: only verified links leave the task."""

    def work(table: pa.Table) -> pa.RecordBatch:
        cols = {k: table.column(k).to_numpy() for k in CLOSE}
        sets = [x.values.to_numpy() for x in table.column("shingles")]
        group = _groups(cols)
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for start, end in zip(starts := np.flatnonzero(np.r_[True, group[1:] != group[:-1]]), np.r_[starts[1:], len(group)]):
            own = {k: v[start:end] for k, v in cols.items()}
            common, sizes = shared_shingles(sets[start:end]), np.array([len(x) for x in sets[start:end]])
            link = (common >= least * (sizes[:, None] + sizes[None] - common) - 1e-6) & (own["comp"][:, None] != own["comp"][None])
            if own["t1"][0] != own["t2"][0]:
                link &= own["tile"][:, None] != own["tile"][None]
            i, j = np.nonzero(np.triu(link, 1))
            e = forest(end - start, i, j, np.zeros(len(i)))
            out.append((own["rep"][i[e]], own["rep"][j[e]]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*out)], ["a", "b"])

    return _whole_groups([*CLOSE, "shingles"], EVERY_TILE, work)


def bucket_links(reps: DataFrame, tables: list[list[int]], lanes: int, radius: int, tile: int = TILE, least: float | None = None) -> DataFrame:
    """(a, b, distance): links between rows (rep, f0, ...) of ``reps`` that share a bucket, as a spanning forest of each bucket.

    With ``least`` rows also have comp and size (of the shingle set), and the result is the rows (CLOSE) of each bucket and pair of tiles that are
    within the radius of a row of another component whose size allows that Jaccard similarity.
    Buckets with one member are dropped after a grouped count; one with more than ``tile`` members is split over tasks by pairs of tiles.
    """
    spark = reps.sparkSession
    fs = [*(f"f{k}" for k in range(lanes)), *(["comp", "size"] if least is not None else [])]
    shares = "n > 1" if least is None else "n > 1 AND least <> most"
    counts = [F.count(F.lit(1)).alias("n"), *([F.min("comp").alias("least"), F.max("comp").alias("most")] if least is not None else [])]

    def key(number: int, mask: list[int]) -> Column:
        parts = [F.lit(number)]
        for lane in range(lanes):
            if m := sum(1 << (b - 64 * lane) for b in mask if b // 64 == lane):
                parts.append(F.col(f"f{lane}").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)))
        return F.xxhash64(*parts)

    rows = reps.select("rep", *fs, F.explode(F.array(*(key(i, m) for i, m in enumerate(tables)))).alias("bucket"))
    shared = sized(stored(rows.groupBy("bucket").agg(*counts).where(shares).select("bucket", "n"), "buckets"))
    rows = rows.join(shared, "bucket").withColumn("k", F.ceil(F.col("n") / tile).cast("int")).withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("k")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other")
    rows = rows.select("bucket", "tile", "rep", *fs, other).select("bucket", F.least("tile", "other").alias("t1"), F.greatest("tile", "other").alias("t2"), "tile", "rep", *fs)
    rows = rows.repartition(partitions(spark), "bucket", "t1", "t2").sortWithinPartitions("bucket", "t1", "t2", "rep")
    return rows.mapInArrow(_compare(lanes, radius, least), "a bigint, b bigint, distance int" if least is None else ", ".join(f"{c} bigint" for c in CLOSE))


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, lanes: int = 1, similarity: float | None = None) -> DataFrame:
    """(doc_id, text_hash, f0, ..., component_id) per row of ``docs``; component_id is the smallest doc_id reachable over links.

    Copies cost one row each: without ``similarity`` equal fingerprints are one node and every pair within ``radius`` links; a null or
    wordless text has the fingerprint zero and links like any other. With ``similarity`` equal word sequences are one node; candidates are
    pairs of a radius that suits it (found by sampled tables: first a forest of each bucket, then, inside the tasks, every pair whose ends the verified links leave apart), and a link counts if the shingle sets of the two texts have that Jaccard
    similarity. A row without doc_id gets a component if it shares its node with a row that has one, else null. Repeated rows get equal
    results.
    """
    node = [*(f"f{k}" for k in range(lanes)), *(["content"] if similarity is not None else [])]
    prints = cut(fingerprints(docs, shingle, lanes, similarity is not None))
    nodes = cut(prints.groupBy(*node).agg(F.min("doc_id").alias("rep"), F.max("size").alias("size")))
    if similarity is None:
        tables = exact_tables(64 * lanes, radius)
    else:
        radius, tables = wide_radius(64 * lanes, similarity), sampled_tables(nodes.count(), 64 * lanes, similarity)
    listed = lambda links: cut(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    reps = nodes.where("rep IS NOT NULL")
    edges = listed(bucket_links(reps, tables, lanes, radius))
    if similarity is not None:
        edges = cut(_similar(docs, edges, shingle, similarity))
    components = cut(connected_components(edges))
    if similarity is not None:  # a forest may have chosen pairs that fail the check in place of pairs that pass it
        apart = cut(reps.join(sized(components), F.col("rep") == F.col("node"), "left").withColumn("comp", F.coalesce("component", "rep")))
        close = stored(bucket_links(apart, tables, lanes, radius, EVERY_TILE, similarity), "close")
        sets = stored(_sets(docs, close.select(F.col("rep").alias("id")), shingle), "sets")
        close = close.join(sets, F.col("rep") == F.col("doc_id")).drop("doc_id").repartition(partitions(docs.sparkSession), "bucket", "t1", "t2").sortWithinPartitions("bucket", "t1", "t2", "rep")
        more = listed(close.mapInArrow(_verify(similarity), "a bigint, b bigint"))
        components = cut(connected_components(edges.unionAll(more)))
    nodes = nodes.join(components, F.col("rep") == F.col("node"), "left").select(*node, F.coalesce("component", "rep").alias("component_id"))
    return prints.drop("size").join(nodes, node, "left")


def _sets(docs: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, shingles) of the documents in ``ids`` (id): the sorted hashes of their distinct shingles."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column("text"):
                w = words_of(t.as_py())
                out.append(np.unique(np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in _grams(w, shingle)), np.uint64)).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.list_(pa.int64()))], ["doc_id", "shingles"])

    texts = docs.join(sized(cut(ids.distinct())), F.col("doc_id") == F.col("id"), "left_semi").select("doc_id", "text")
    return texts.mapInArrow(sets, "doc_id bigint, shingles array<bigint>").dropDuplicates(["doc_id"])


def _similar(docs: DataFrame, edges: DataFrame, shingle: int, least: float) -> DataFrame:
    """The edges whose texts have shingle sets of Jaccard similarity ``least`` or more; only texts on an edge are read into sets."""
    found = cut(_sets(docs, edges.select(F.col("a").alias("id")).unionAll(edges.select(F.col("b").alias("id"))), shingle))
    a, b = (found.select(F.col("doc_id").alias(k), F.col("shingles").alias(f"s{k}")) for k in "ab")
    both = edges.join(a, "a").join(b, "b").withColumn("common", F.size(F.array_intersect("sa", "sb")))
    return both.where(F.col("common") >= F.lit(least) * (F.size("sa") + F.size("sb") - F.col("common"))).select("a", "b")


def drop_near_duplicates(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, lanes: int = 2) -> DataFrame:
    """``docs`` with one document of each group: that with the smallest doc_id. Groups are chains of links of five-word shingle sets with the
    given Jaccard similarity. Rows are matched by doc_id and text hash (null-safe); of rows equal in both one stays. A row without doc_id
    stays unless its words equal those of a row with one."""
    found = cut(near_duplicates(docs, shingle, lanes=lanes, similarity=similarity).select("doc_id", "text_hash", "component_id"))
    extra = found.where("component_id IS NOT NULL AND NOT (doc_id <=> component_id)")
    extra = cut(extra.select(F.col("doc_id").alias("_aw_id"), F.col("text_hash").alias("_aw_hash")).distinct())
    left = docs.join(sized(extra), F.col("doc_id").eqNullSafe(F.col("_aw_id")) & (F.xxhash64("text") == F.col("_aw_hash")), "left_anti")
    repeated = found.groupBy("doc_id", "text_hash").count().where("count > 1").limit(1).count()
    return left.withColumn("_aw_hash", F.xxhash64("text")).dropDuplicates(["doc_id", "_aw_hash"]).drop("_aw_hash") if repeated else left
