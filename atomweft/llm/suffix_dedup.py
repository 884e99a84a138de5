"""Repeated substrings by column-wise construction of a multi-document suffix order.

1. Anchors. In every window of ``length`` bytes the k-byte string with the least hash is the window's anchor, so equal windows have equal
   anchors at equal offsets. Anchors that occur once in the corpus rule out all their windows; the others name candidate segments.
   Windows of a text with a short period equal their own neighbours: they are repeated as they stand, and only those of the first period stay
   to be compared with other places.
2. Construction. Segments with the same anchor are one collection, aligned at the anchor. One symbol of each segment is inserted per round,
   from the last column to the first: a stable sort by the new symbol updates the order of the suffixes (the column of the collection's
   Burrows-Wheeler transform), and range minima update their common prefixes. A window is repeated if, in the round of its first symbol, the
   common prefix with a neighbour is ``length`` bytes or more.

A collection over ``max_group`` segments would be one long task. Its windows are dealt anew by their distance to the anchor and all the bytes
that windows at such distances share, so that equal windows stay together; equal segments, counted before the shuffle, are then one. Of a part
that has more segments even so, the single windows are reduced to digests, which combine before the shuffle, too.
Segments and orders of a task are kept in bounded batches; what is larger waits in Spark's shuffle files, read in sequence.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atomweft.llm.common import BROADCAST_ROWS, partitions, sized, stored

LENGTH = 400
#: Segments of an anchor that are built as they are, in one task.
MAX_GROUP = 512
#: Parts that the windows of an anchor are dealt over, by distance, if it has more segments.
PARTS = 16
#: Segments whose columns are built together.
BATCH = 4096
BLOCK = 1 << 23
#: Periods up to this are taken out before segments are cut: of such texts every few bytes would be an anchor with a segment of its own.
PERIODS = 64
#: Bytes of segments in one batch of rows.
BATCH_BYTES = 16 << 20
_POS = np.uint64((1 << 24) - 1)


def _gram(length: int) -> int:
    """Bytes of an anchor: a power of two of about a third of the window."""
    return 1 << max(2, (length * 2 // 5).bit_length() - 1)


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor position, its hash, first window start, last window start) of the runs of windows that share an anchor."""
    k, n = _gram(length), len(data)
    parts = []
    for base in range(0, max(n - length + 1, 0), BLOCK):
        h = data[base : min(n, base + BLOCK + length - 1)].astype(np.uint64) + np.uint64(1)
        step, factor = 1, np.uint64(0x9E3779B97F4A7C15)
        with np.errstate(over="ignore"):
            while step < k:
                h = h[:-step] * factor + h[step:]
                factor, step = factor * factor, step * 2
            h ^= h >> np.uint64(31)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
        least, size, width = (h & ~_POS) | np.arange(len(h), dtype=np.uint64), 1, length - k + 1
        while 2 * size <= width:
            least, size = np.minimum(least[:-size], least[size:]), size * 2
        if size < width:
            least = np.minimum(least[: len(least) - (width - size)], least[width - size :])
        at = (least & _POS).astype(np.int64)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        parts.append((base + at[first], h[at[first]].view(np.int64), base + first, base + np.r_[first[1:], len(at)] - 1))
    return tuple(np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 4


def without_periods(data: np.ndarray, length: int, found: tuple[np.ndarray, ...]) -> tuple[tuple[np.ndarray, ...], list[tuple[int, int]]]:
    """(``found`` of ``anchors`` without the windows that equal the one a period before, spans of periodic text)."""
    at, h, low, high = found
    step = np.diff(at)
    spans: list[tuple[int, int]] = []
    for p in np.unique(step[(h[1:] == h[:-1]) & (step > 0) & (step <= PERIODS)]).tolist():
        ends = np.flatnonzero(np.r_[True, data[p:] != data[:-p], True])  # data[i] equals data[i + p] between two of these
        long = np.flatnonzero(np.diff(ends) > length)
        for start, end in zip(ends[long].tolist(), (ends[long + 1] - 1).tolist()):
            spans.append((start, end + p))
            first, last = start + p, end + p - length  # these windows equal the one a period before
            a, b = np.searchsorted(high, first), np.searchsorted(low, last, side="right")
            if a >= b:
                continue
            head, tail = int(low[a] < first), int(high[b - 1] > last)
            keep = np.r_[np.arange(a), [a] * head, [b - 1] * tail, np.arange(b, len(low))].astype(np.int64)
            new_low, new_high = low[keep].copy(), high[keep].copy()
            if head:
                new_high[a] = first - 1
            if tail:
                new_low[a + head] = last + 1
            at, h, low, high = at[keep], h[keep], new_low, new_high
    return (at, h, low, high), spans


def repeated_windows(segments: list[bytes], rel: np.ndarray, count: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """(segments, offsets) flags: the window at that offset of the segment occurs at another place of the same group.

    ``rel`` is the anchor's offset in each segment, ``count`` the number of windows; ``group`` is ascending.
    """
    m, left = len(segments), int(rel.max())
    sizes = np.array([len(s) for s in segments])
    width = left + int((sizes - rel).max())
    table = np.full((m, width), 256, np.int16)
    for i, s in enumerate(segments):
        table[i, left - rel[i] : left - rel[i] + len(s)] = np.frombuffer(s, np.uint8)
    columns = np.ascontiguousarray(table.T)
    shift = (left - rel).astype(np.int64)
    flags = np.zeros((m, int(count.max())), bool)
    order, common = np.arange(m), np.zeros(m + 1, np.int32)  # common[i]: prefix shared by the suffixes at i - 1 and i
    rank_key = np.cumsum(np.r_[False, group[1:] != group[:-1]]).astype(np.int64) * 512  # sorted by group first, so a position keeps its group
    for col in range(width - 1, -1, -1):
        symbol = columns[col][order]
        key = rank_key + symbol
        same = np.zeros(m, bool)
        if (key[1:] >= key[:-1]).all():
            same[1:] = (key[1:] == key[:-1]) & (symbol[1:] < 256)
            common[:-1] = np.where(same, common[:-1] + 1, 0)
        else:
            moved = np.argsort(key, kind="stable")
            key, low, high = key[moved], moved[:-1] + 1, moved[1:]
            same[1:] = (key[1:] == key[:-1]) & (key[1:] % 512 < 256)
            at = np.flatnonzero(same[1:])
            least = np.minimum.reduceat(common, np.column_stack([low[at], high[at] + 1]).ravel())[::2] if len(at) else 0
            order = order[moved]
            common = np.zeros(m + 1, np.int32)
            common[at + 1] = least + 1
        hit = (common[:-1] >= length) | (common[1:] >= length)
        if hit.any():
            who = order[hit]
            offset = col - shift[who]
            ok = (offset >= 0) & (offset < count[who])
            flags[who[ok], offset[ok]] = True
    return flags


def _anchor_rows(length: int):
    schema = pa.schema([("id", pa.int64()), ("hash", pa.int64()), ("anchor", pa.int64()), ("at", pa.int32()), ("low", pa.int32()), ("high", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column("text")):
                data = np.frombuffer((text.as_py() or "").encode("utf-8", "surrogatepass"), np.uint8)
                (at, h, low, high), spans = without_periods(data, length, anchors(data, length))
                if spans:  # rows without an anchor are spans
                    m, start, end = len(spans), *zip(*spans)
                    yield pa.RecordBatch.from_arrays([pa.array([batch.column("doc_id")[i].as_py()] * m, pa.int64()), pa.array([batch.column("text_hash")[i].as_py()] * m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32()), pa.array(start, pa.int32()), pa.array(end, pa.int32())], schema=schema)
                if len(at):
                    n = len(at)
                    id_, th = batch.column("doc_id")[i].as_py(), batch.column("text_hash")[i].as_py()
                    yield pa.RecordBatch.from_arrays([pa.array([id_] * n, pa.int64()), pa.array(np.full(n, th, np.int64)), pa.array(h), pa.array(at.astype(np.int32)), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))], schema=schema)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in run(batches):
            held.append(batch)
            n += batch.num_rows
            if n >= 20_000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return merged


def _part_rows(length: int):
    """Segments of large collections in parts: windows of a part lie at most ``step`` - 1 bytes apart, and ``key`` names it and what they share."""
    step = -(-(length - _gram(length) + 1) // PARTS)
    schema = pa.schema([("key", pa.int64()), ("same", pa.binary()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("at", pa.int32()), ("low", pa.int32()), ("high", pa.int32())])

    def parts(row: dict) -> Iterator[tuple]:
        data = row["text"].encode("utf-8", "surrogatepass")
        for x in row["found"]:
            at = x["at"]
            for part in range((at - x["high"]) // step, (at - x["low"]) // step + 1):
                last = at - part * step  # the part's windows start from last - step + 1 to last
                low, high = max(x["low"], last - step + 1), min(x["high"], last)
                key = xxhash.xxh3_64_intdigest(data[last : last - step + 1 + length], part)
                yield key - (key >> 63 << 64), xxhash.xxh3_128_digest(data[low : high + length], at - low), row["doc_id"], row["text_hash"], at, low, high

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (x for batch in batches for row in batch.to_pylist() for x in parts(row))
        while some := list(itertools.islice(rows, 20_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), schema.types)], schema=schema)

    return run


def _segment_rows(length: int):
    names = ["anchor", "n", "doc_id", "text_hash", "low", "rel", "starts", "segment"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data = row["text"].encode("utf-8", "surrogatepass")
                step = max(1, BATCH_BYTES // (2 * length))
                for k in range(0, len(row["found"]), step):
                    found = row["found"][k : k + step]
                    lows = [x["low"] for x in found]
                    cols = [[x["anchor"] for x in found], [x["n"] for x in found], [row["doc_id"]] * len(found), [row["text_hash"]] * len(found), lows, [x["at"] - x["low"] for x in found], [x["high"] - x["low"] + 1 for x in found], [data[x["low"] : x["high"] + length] for x in found]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()])], names)

    return run


def _mark(length: int):
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])

    def work(table: pa.Table) -> pa.RecordBatch:
        col = lambda name: table.column(name).to_numpy().astype(np.int64)
        low, group = col("low"), col("anchor")
        flags = repeated_windows(table.column("segment").to_pylist(), col("rel"), col("starts"), group, length)
        edge = np.diff(np.pad(flags, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        (i, start), (_, end) = np.nonzero(edge == 1), np.nonzero(edge == -1)
        who = table.take(pa.array(i))
        return pa.RecordBatch.from_arrays([who.column("doc_id").combine_chunks(), who.column("text_hash").combine_chunks(), pa.array((low[i] + start).astype(np.int32)), pa.array((low[i] + end - 1 + length).astype(np.int32))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part])
            if held.num_rows >= BATCH:
                key = held.column("anchor").to_numpy()
                ends = np.flatnonzero(key[1:] != key[:-1])
                if len(ends):
                    yield work(held.slice(0, ends[-1] + 1).combine_chunks())
                    held = held.slice(ends[-1] + 1)
        if held is not None and held.num_rows:
            yield work(held.combine_chunks())

    return run


def _window_rows(length: int):
    """Every window of a segment as a digest, for parts of collections that are still too large for one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = row["starts"]
                digests = [xxhash.xxh3_128_digest(row["segment"][k : k + length]) for k in range(n)]
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array([row["doc_id"]] * n, pa.int64()), pa.array([row["text_hash"]] * n, pa.int64()), pa.array(np.arange(row["low"], row["low"] + n, dtype=np.int32))], ["digest", "doc_id", "text_hash", "start"])

    return run


def _cut_rows(with_text: bool):
    def rest_of(data: bytes, spans: list[dict] | None, whole: bool | None) -> tuple[bytes, int]:
        """What is kept, and the number of maximal removed runs."""
        if whole:
            return b"", 1
        kept, at, runs = [], 0, 0
        for s, e in sorted((x["start"], x["end"]) for x in spans or ()):
            if s > at or not runs:
                kept.append(data[at:s])
                runs += 1
            at = max(at, e)
        return b"".join([*kept, data[at:]]), runs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("text", "_aw_spans", "_aw_whole"))):
                data = row[0].encode("utf-8", "surrogatepass")
                rest, runs = rest_of(data, *row[1:])
                out.append((len(data) - len(rest), runs, hashlib.sha256(rest).hexdigest()) + ((rest.decode("utf-8", "ignore"),) if with_text else ()))
            cols = list(zip(*out)) if out else [[]] * (3 + with_text)
            kinds = [pa.int64(), pa.int64(), pa.string()] + [pa.string()] * with_text
            names = [c for c in batch.schema.names if c not in ("text", "text_hash", "_aw_spans", "_aw_whole")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *(pa.array(c, k) for c, k in zip(cols, kinds))], names + ["n_removed", "n_spans", "kept_sha256"] + ["text"] * with_text)

    return run


def _with_items(texts: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of ``texts`` that have a row in ``items`` (_aw_id, _aw_hash, ...), joined to it.

    The ids alone filter the texts first, broadcast up to a checked number; what is left is shuffled to the items, which may be wide.
    """
    on = F.col("doc_id").eqNullSafe(F.col("_aw_id")) & (F.col("text_hash") == F.col("_aw_hash"))
    if (n := items.count()) <= BROADCAST_ROWS:
        texts = texts.join(sized(items.select("_aw_id", "_aw_hash"), n), on, "left_semi")
    return texts.join(items.hint("shuffle_hash"), on).drop("_aw_id", "_aw_hash")


def _cut_out(single: DataFrame, found: DataFrame, rows_of, schema: str) -> DataFrame:
    """``rows_of`` the texts that have segments in ``found`` (doc_id, text_hash, ...), each with all of its own; no other text moves."""
    found = found.groupBy(F.col("doc_id").alias("_aw_id"), F.col("text_hash").alias("_aw_hash")).agg(F.collect_list(F.struct(*(c for c in found.columns if c not in ("doc_id", "text_hash")))).alias("found"))
    return _with_items(single, stored(found, "found")).select("doc_id", "text_hash", "text", "found").mapInArrow(rows_of, schema)


def _split(single: DataFrame, large: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Segments (doc_id, text_hash, anchor, at, low, high) of collections that are too large, dealt anew.

    Gives (segments that differ from each other, with the number ``n`` in their part; spans of those that have an equal one).
    """
    parts = _cut_out(single, large.select("doc_id", "text_hash", "at", "low", "high"), _part_rows(length), "key bigint, same binary, doc_id bigint, text_hash bigint, at int, low int, high int")
    parts = stored(parts, "parts")
    equal = stored(parts.groupBy("key", "same").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("doc_id", "text_hash", "low")).alias("first")), "equal")
    groups = stored(equal.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("m").alias("m")).where("m > 1").drop("m"), "groups")
    equal = stored(equal.join(sized(groups), "key"), "dealt")
    parts = stored(parts.join(sized(equal), ["key", "same"]), "segments")
    one = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash")) & (F.col("low") == F.col("first.low"))
    spans = parts.where("m > 1").select("doc_id", "text_hash", F.col("low").alias("start"), (F.col("high") + length).alias("end"))
    return parts.where((F.col("n") > 1) & one).select("doc_id", "text_hash", F.col("key").alias("anchor"), "n", "at", "low", "high"), spans


def repeated_spans(docs: DataFrame, length: int = LENGTH, max_group: int = MAX_GROUP) -> DataFrame:
    """(doc_id, text_hash, spans array<struct<start, end>>, whole): bytes of each row's text that a repeated string of ``length`` covers.

    Equal texts are one text here: all but the row with the smallest doc_id are set aside, and all of them are ``whole`` (removed entirely)
    if they have ``length`` bytes. Rows without such bytes are absent.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text")).where(F.octet_length("text") >= length)
    keyed = texts.withColumn("sha", F.unhex(F.sha2("text", 256)))
    copies = stored(keyed.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"), "copies")
    n_copies = copies.count()
    joined = keyed.join(sized(copies, n_copies), "sha", "left")
    single = joined.where("n IS NULL OR doc_id <=> first").select("doc_id", "text_hash", "text")
    rows = stored(single.mapInArrow(_anchor_rows(length), "doc_id bigint, text_hash bigint, anchor bigint, at int, low int, high int"), "anchors")
    often = stored(rows.where("anchor IS NOT NULL").groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "often")
    found = rows.join(sized(often), "anchor").select("doc_id", "text_hash", "anchor", "n", "at", "low", "high")
    spans = rows.where("anchor IS NULL").select("doc_id", "text_hash", F.col("low").alias("start"), F.col("high").alias("end"))
    schema = "anchor bigint, n bigint, doc_id bigint, text_hash bigint, low int, rel int, starts int, segment binary"
    if often.where(F.col("n") > max_group).limit(1).count():
        parts, equal = _split(single, found.where(F.col("n") > max_group), length)
        found, spans = found.where(F.col("n") <= max_group).unionByName(parts.where(F.col("n") <= max_group)), spans.unionByName(equal)
        large = parts.where(F.col("n") > max_group)
        if large.limit(1).count():
            windows = _cut_out(single, large, _segment_rows(length), schema).mapInArrow(_window_rows(length), "digest binary, doc_id bigint, text_hash bigint, start int")
            windows = stored(windows, "windows")
            twice = stored(windows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "twice")
            spans = spans.unionByName(windows.join(sized(twice), "digest").select("doc_id", "text_hash", "start", (F.col("start") + length).alias("end")))
    small = _cut_out(single, found, _segment_rows(length), schema).repartition(partitions(spark), "anchor").sortWithinPartitions("anchor")
    spans = small.mapInArrow(_mark(length), "doc_id bigint, text_hash bigint, start int, end int").unionByName(spans)
    spans = spans.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "end")).alias("spans"), F.lit(False).alias("whole"))
    whole = joined.where("n > 1").select("doc_id", "text_hash", F.lit(None).cast("array<struct<start:int,end:int>>").alias("spans"), F.lit(True).alias("whole")).distinct()
    # the row that stands for a group of copies may have spans too: it is whole in any case
    return stored(spans.join(whole.select("doc_id", "text_hash"), [spans.doc_id.eqNullSafe(whole.doc_id), spans.text_hash == whole.text_hash], "left_anti").unionByName(whole), "spans")


def remove_repeats(docs: DataFrame, length: int = LENGTH, max_group: int = MAX_GROUP, with_text: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row of ``docs``, or all columns of ``docs`` and these with the text cut.

    A null text is empty. Cut texts drop the bytes of characters that a cut splits. Repeated rows are copies of each other, so their texts
    are removed; texts under ``length`` bytes and an empty table pass through. The id and a hash of the text stand for a row. Columns of
    ``docs`` with the names of the results are replaced, and text_hash goes.
    """
    results = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    spans = repeated_spans(docs, length, max_group)
    spans = spans.select(F.col("doc_id").alias("_aw_id"), F.col("text_hash").alias("_aw_hash"), F.col("spans").alias("_aw_spans"), F.col("whole").alias("_aw_whole"))
    kept = [c for c in docs.columns if c not in (*results, "text_hash")] if with_text else ["doc_id"]
    rows = docs.select(*(c for c in kept if c != "text"), F.coalesce("text", F.lit("")).alias("text")).withColumns({"n_bytes": F.octet_length("text").cast("bigint"), "text_hash": F.xxhash64("text")})
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes if n not in ("text", "text_hash")) + ", n_removed bigint, n_spans bigint, kept_sha256 string" + ", text string" * with_text
    out = [*kept, *results]
    if spans.count() > BROADCAST_ROWS:
        on = F.col("doc_id").eqNullSafe(F.col("_aw_id")) & (F.col("text_hash") == F.col("_aw_hash"))
        return rows.join(spans.hint("shuffle_hash"), on, "left").drop("_aw_id", "_aw_hash").mapInArrow(_cut_rows(with_text), schema).select(out)
    changed = _with_items(rows, spans).mapInArrow(_cut_rows(with_text), schema)
    plain = rows.join(sized(spans.select("_aw_id", "_aw_hash"), 0), F.col("doc_id").eqNullSafe(F.col("_aw_id")) & (F.col("text_hash") == F.col("_aw_hash")), "left_anti")
    plain = plain.withColumns({"n_removed": F.lit(0).cast("bigint"), "n_spans": F.lit(0).cast("bigint"), "kept_sha256": F.sha2("text", 256)})
    return plain.select(out).unionByName(changed.select(out))
