"""Token ids in binary files: blocks in patched frame-of-reference coding.

Texts are dealt over files by ranges of doc_id, encoded in the tasks and written in ascending order. A file is a row of segments, each with
whole documents (about ``SEGMENT_IDS`` ids) and all that is needed to read it:

    magic "AWT1" | five u32: documents, blocks, words of the payload, exceptions, and the length of the segment in units of 8 bytes
    i64 doc_id of each document | u32 its number of ids | u8 whether its doc_id is null
    u32 minimum of each block | u32 its first payload word | u32 its first exception | u8 its width
    u64 payload words | u32 high part of each exception | u8 its place in the block | zero bytes up to a multiple of 8

A block has ``BLOCK`` ids. Its minimum is subtracted and the differences are packed at the width that holds ``PERCENT`` per cent of them: 64
values of w bits are w words. What is above that width goes to the exceptions. The starts of the blocks make any range of ids readable alone.
Spark's text writer puts the segments into files, with one zero byte after each.
"""

from __future__ import annotations

import functools
import itertools
import os
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from atomweft.llm.common import sized, stored

BLOCK = 256
PERCENT = 95
SEGMENT_IDS = 1 << 20
#: A segment is closed at so many documents too.
SEGMENT_DOCS = 1 << 16
#: Bytes of text for a file; a file has at most so many segments, and running sums are taken over so many files at a time.
FILE_BYTES = 32 << 20
FILE_SEGMENTS = 64
FILE_RANGE = 1000
#: Bytes of text that are cut into pieces at once, bytes of text of which the distinct pieces are looked up together, and pieces of text of which
#: a worker remembers the ids.
ENCODE_BYTES = 2 << 20
LOOKUP_BYTES = 4 << 20
PIECES = 300_000
#: New pieces that are encoded as the lines of one text.
LINES = 64
MAGIC = b"AWT1"
READ = "doc_id bigint, file bigint, at bigint, n_tokens bigint, ids_crc32 bigint"


# --- blocks


def _widths(values: np.ndarray) -> np.ndarray:
    """The number of bits of each value."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of 64 values under 2**width as rows of ``width`` words."""
    lanes = np.ascontiguousarray(values.T.astype(np.uint64))
    out = np.zeros((width, values.shape[0]), np.uint64)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        out[word] |= lanes[i] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= lanes[i] >> np.uint64(64 - shift)
    return out.T


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    """What ``pack`` has packed."""
    rows = np.ascontiguousarray(words.T)
    out = np.empty((64, words.shape[0]), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        value = rows[word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | rows[word + 1] << np.uint64(64 - shift)
        out[i] = value & mask
    return out.T


def write_segment(ids: np.ndarray, doc_ids: list[int | None], lengths: np.ndarray, percent: int = PERCENT) -> bytes:
    """The segment of these documents, of which ``ids`` (unsigned, 32 bits) has all ids in a row."""
    n_blocks = -(-ids.size // BLOCK)
    padded = np.pad(ids.astype(np.uint32), (0, n_blocks * BLOCK - ids.size), mode="edge" if ids.size else "constant").reshape(n_blocks, BLOCK)
    least = padded.min(axis=1) if n_blocks else np.zeros(0, np.uint32)
    rest = padded - least[:, None]
    bits = _widths(rest)
    place = min(BLOCK - 1, BLOCK * percent // 100)
    width = np.partition(bits, place, axis=1)[:, place] if n_blocks else np.zeros(0, np.uint8)
    starts = np.concatenate([[0], np.cumsum(width.astype(np.int64) * (BLOCK // 64))])
    payload = np.zeros(starts[-1], np.uint64)
    for w in np.unique(width[width > 0]):
        own = np.flatnonzero(width == w)
        low = (rest[own] & np.uint32((1 << int(w)) - 1)).reshape(-1, 64)
        payload[starts[own][:, None] + np.arange(BLOCK // 64 * int(w))] = pack(low, int(w)).reshape(own.size, -1)
    above = bits > width[:, None]
    block, at = np.nonzero(above)
    high = (rest[block, at].astype(np.uint64) >> width[block].astype(np.uint64)).astype("<u4")
    exceptions = np.concatenate([[0], np.cumsum(above.sum(axis=1))])
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    parts = [np.array([d or 0 for d in doc_ids], "<i8"), lengths.astype("<u4"), nulls, least.astype("<u4"), starts[:-1].astype("<u4"), exceptions[:-1].astype("<u4"), width, payload.astype("<u8"), high, at.astype(np.uint8)]
    body = b"".join(p.tobytes() for p in parts)
    units = -(-(len(body) + 24) // 8)
    return (MAGIC + struct.pack("<5I", len(doc_ids), n_blocks, payload.size, high.size, units) + body).ljust(units * 8, b"\0")


class Segment:
    """A segment that starts at ``start`` of ``data``; blocks are decoded on demand."""

    def __init__(self, data: bytes, start: int = 0) -> None:
        if bytes(data[start : start + 4]) != MAGIC:
            raise ValueError("not a segment of token ids")
        docs, self.n_blocks, words, exceptions, units = struct.unpack_from("<5I", data, start + 4)
        self.end = start + units * 8
        at = start + 24

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, n, at)
            at += found.nbytes
            return found

        ids, self.lengths, nulls = take("<i8", docs), take("<u4", docs).astype(np.int64), take("u1", docs)
        self.doc_ids = [None if x else d for d, x in zip(ids.tolist(), nulls.tolist())]
        self.least, self.starts, self.exceptions = take("<u4", self.n_blocks), take("<u4", self.n_blocks).astype(np.int64), take("<u4", self.n_blocks).astype(np.int64)
        self.width, self.payload, self.high, self.place = take("u1", self.n_blocks), take("<u8", words), take("<u4", exceptions), take("u1", exceptions)
        self.size = int(self.lengths.sum())

    def ids(self, first: int = 0, end: int | None = None) -> np.ndarray:
        """The ids from ``first`` up to ``end``; only the blocks that hold them are decoded."""
        end = self.size if end is None else min(end, self.size)
        if first >= end:
            return np.zeros(0, np.uint32)
        low, high = first // BLOCK, -(-end // BLOCK)
        width = self.width[low:high]
        out = np.zeros((high - low, BLOCK), np.uint32)
        for w in np.unique(width[width > 0]):
            own = np.flatnonzero(width == w)
            words = self.payload[self.starts[low + own][:, None] + np.arange(BLOCK // 64 * int(w))]
            out[own] = unpack(words.reshape(-1, int(w)), int(w)).reshape(own.size, BLOCK)
        a, b = self.exceptions[low], self.exceptions[high] if high < self.n_blocks else self.high.size
        block = np.repeat(np.arange(high - low), np.diff(np.append(self.exceptions[low:high], b)))
        out[block, self.place[a:b]] |= (self.high[a:b].astype(np.uint64) << width[block].astype(np.uint64)).astype(np.uint32)
        return (out + self.least[low:high, None]).reshape(-1)[first - low * BLOCK : end - low * BLOCK]


def segments(data: bytes) -> Iterator[Segment]:
    """The segments of a file's content, in order."""
    at = 0
    while at < len(data):
        found = Segment(data, at)
        yield found
        at = found.end + 1


# --- pieces of text

_PRINTS = np.zeros(256, bool)
_PRINTS[0x21:0x7F] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = np.zeros(256, bool)
_MARK[[*b".,;:!?"]] = True


def _edges(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte whether a character begins, or ends, with it that is surely not white space: those of two bytes from 0xC3 on and of three
    bytes from 0xE4 to 0xED never are."""
    two, three, tail = (data >= 0xC3) & (data <= 0xDF), (data >= 0xE4) & (data <= 0xED), (data & 0xC0) == 0x80
    ends = _PRINTS[data]
    begins = ends | two | three
    ends[1:] |= tail[1:] & two[:-1]
    ends[2:] |= tail[2:] & three[:-2]
    return begins, ends


def piece_starts(data: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Where texts in a row may be cut without changing what a byte-level tokenizer makes of them; ``docs`` (starts of the texts) are among them.

    The tokenizer's pattern never joins a character that is not white space with a blank after it; a blank belongs to what follows unless that
    is white space; a single line feed between two such characters stands alone; and no part has a letter before a mark.
    """
    n = data.size
    if not n:
        return np.zeros(0, np.int64)
    begins, ends = _edges(data)
    cut = np.zeros(n + 1, bool)
    between = np.zeros(n, bool)
    between[1:-1] = ends[:-2] & begins[2:]
    feed = np.flatnonzero(between & (data == 0x0A))
    cut[:-1] = between & (data == 0x20)
    cut[feed] = True
    cut[feed + 1] = True
    cut[1:-1] |= _LETTER[data[:-1]] & _MARK[data[1:]]
    cut[docs[docs < n]] = True
    return np.flatnonzero(cut[:-1])


def line_like(pieces: pa.Array) -> np.ndarray:
    """Whether each piece may stand in a line of its own: no line feed in it, no white space at its end and none but one blank at its start."""
    data, at = _bytes(pieces)
    begins, ends = _edges(data)
    first, last = at[:-1], at[1:] - 1
    feeds = np.append(0, np.cumsum(data == 0x0A))
    return begins[np.minimum(first + (data[first] == 0x20), last)] & ends[last] & (feeds[at[1:]] == feeds[first])


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes of these large_binary values in a row, where each one's begin and the last ones end)."""
    _, offsets, buffer = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(buffer, np.uint8)[at[0] : at[-1]] if buffer else np.zeros(0, np.uint8)
    return data, at - at[0]


def _cut(texts: pa.Array | list) -> tuple[pa.DictionaryArray, np.ndarray]:
    """(the pieces of all texts in a row, the number of pieces before each text and in all)."""
    data, at = _bytes(pc.fill_null(pa.array(texts, pa.large_binary()) if isinstance(texts, list) else texts.cast(pa.large_binary()), b""))
    starts = piece_starts(data, at[:-1])
    pieces = pa.Array.from_buffers(pa.large_binary(), starts.size, [None, pa.py_buffer(np.append(starts, data.size).astype(np.int64)), pa.py_buffer(data)])
    return pieces.dictionary_encode(), np.searchsorted(starts, at)  # a text's pieces: from its own start up to that of the next


def _gather(flat: np.ndarray, first: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the ids of entries in this order, where each one's end); those of entry i are ``sizes[i]`` numbers of ``flat`` from ``first[i]`` on."""
    lengths = sizes[order]
    ends = np.cumsum(lengths)
    place = np.repeat((first[order] - (ends - lengths)).astype(np.int32), lengths)
    place += np.arange(place.size, dtype=np.int32)
    return flat[place], ends


class Encoder:
    """Ids of whole texts by a tokenizers file, each distinct piece of a call encoded once.

    Pieces are remembered from call to call, at most ``pieces`` of them: those of the last call (``known``) and of calls before it (``before``)
    that were seen most, where what a call has seen counts half in the next.
    """

    def __init__(self, file: str, end_id: int | None, pieces: int = PIECES) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores already
        from tokenizers import Tokenizer

        self.tokenizer, self.pieces = Tokenizer.from_file(file), pieces
        self.end = np.array([] if end_id is None else [end_id], np.uint32)
        self.known = self.before = pa.array([], pa.large_binary())
        self.ids, self.sizes, self.seen = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.float32)  # of known, then before
        feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.feed = feed[0] if len(feed) == 1 else None

    def __call__(self, texts: pa.Array | list) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all texts in a row, the number of ids of each)."""
        return next(self.parts([texts]))

    def parts(self, parts: list[pa.Array]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """What a call gives for each of these arrays of texts; their pieces are looked up together."""
        nothing = pa.array([], pa.int32())
        old = [pa.DictionaryArray.from_arrays(nothing, x) for x in (self.known, self.before)]
        cut, per_texts = zip(*map(_cut, parts))
        chunks = pa.chunked_array([*old, *cut]).unify_dictionaries().chunks  # what is remembered comes first
        pieces, orders = chunks[0].dictionary, [c.indices.to_numpy() for c in chunks[2:]]
        del cut, chunks
        n_old = len(self.known) + len(self.before)
        flat, first, sizes = self._encode(pieces.slice(n_old))
        flat, first, sizes = np.concatenate([self.ids, flat]), np.append(np.cumsum(self.sizes) - self.sizes, self.ids.size + first), np.append(self.sizes, sizes)
        self._keep(pieces, flat, first, sizes, sum(np.bincount(x, minlength=len(pieces)) for x in orders))
        flat, first, sizes = np.append(flat, self.end), np.append(first, flat.size), np.append(sizes, self.end.size)
        for order, per_text in zip(orders, per_texts):
            ids, ends = _gather(flat, first, sizes, np.insert(order, per_text[1:], len(pieces)))
            yield ids, np.diff(np.append(0, ends)[per_text[1:] + np.arange(1, per_text.size)], prepend=0)

    def _keep(self, pieces: pa.Array, flat: np.ndarray, first: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> None:
        seen = counts.astype(np.float32)
        seen[: self.seen.size] += self.seen / 2
        kept = np.flatnonzero(pc.binary_length(pieces).to_numpy() <= 64)
        if kept.size > self.pieces:
            kept = np.sort(kept[np.argpartition(seen[kept], kept.size - self.pieces)[kept.size - self.pieces :]])
        now = counts[kept] > 0
        known, before = kept[now], kept[~now]
        kept = np.append(known, before)
        self.known, self.before = pieces.take(pa.array(known)), pieces.take(pa.array(before))
        self.ids, self.sizes, self.seen = _gather(flat, first, sizes, kept)[0], sizes[kept], seen[kept]

    def _encode(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where those of each piece begin, the number of ids of each piece)."""
        first, sizes = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        found, n = [np.zeros(0, np.uint32)], 0
        lines = line_like(pieces) if self.feed is not None else np.zeros(len(pieces), bool)
        for own, find in ((np.flatnonzero(lines), self._lines), (np.flatnonzero(~lines), self._each)):
            for k in range(0, own.size, 4096):
                part = own[k : k + 4096]
                flat, sizes[part] = find(pieces.take(pa.array(part)))
                first[part] = n + np.cumsum(sizes[part]) - sizes[part]
                found.append(flat)
                n += flat.size
        return np.concatenate(found), first, sizes

    def _ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all texts in a row, the number of ids of each)."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts.cast(pa.large_string()).to_pylist(), add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    _each = _ids

    def _lines(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Pieces are encoded as the lines of fewer texts, whose ids are cut at the line feeds; one by one should the feeds not come out as they went in."""
        groups = np.append(np.arange(0, len(pieces), LINES), len(pieces))
        flat, sizes = self._ids(pc.binary_join(pa.LargeListArray.from_arrays(pa.array(groups), pieces), pa.scalar(b"\n", pa.large_binary())))
        feeds, ends = np.flatnonzero(flat == self.feed), np.append(0, np.cumsum(sizes))
        if (np.diff(np.searchsorted(feeds, ends)) != np.diff(groups) - 1).any():
            return self._each(pieces)
        first, end = np.sort(np.append(ends[:-1], feeds + 1)), np.sort(np.append(feeds, ends[1:]))
        return np.delete(flat, feeds), end - first


@functools.lru_cache(maxsize=1)
def _encoder(file: str, state: tuple[int, ...], end_id: int | None) -> Encoder:
    return Encoder(file, end_id)


def encoder(file: str, end_id: int | None) -> Encoder:
    """The encoder of this worker, which one task after another uses; another one once the file has changed."""
    now = os.stat(file)
    return _encoder(file, (now.st_ino, now.st_size, now.st_mtime_ns), end_id)


# --- files


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Slices with about ENCODE_BYTES of text, a row at least; those with about LOOKUP_BYTES together."""
    held, size = [], 0
    for batch in batches:
        sizes = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)))
        first = 0
        while first < batch.num_rows:
            end = max(first + 1, int(np.searchsorted(sizes, sizes[first] + ENCODE_BYTES, "right")) - 1)
            held.append(batch.slice(first, end - first))
            size += int(sizes[end] - sizes[first])
            first = end
            if size >= LOOKUP_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


def _segments(tokenizer: str, end_id: int | None, segment_ids: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, end_id)
        docs: list[int | None] = []
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            data = write_segment(np.concatenate([ids for ids, _ in held]), docs, np.concatenate([n for _, n in held]), percent)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["value"])

        for slices in _slices(batches):
            for names, (ids, lengths) in zip([s.column("doc_id").to_pylist() for s in slices], encode.parts([s.column("text") for s in slices])):
                ends = np.cumsum(lengths)
                k = 0
                while k < lengths.size:  # whole documents until the segment is full
                    base = ends[k - 1] if k else 0
                    to = min(max(k + 1, int(np.searchsorted(ends, base + segment_ids - size, "right"))), k + SEGMENT_DOCS - len(docs), lengths.size)
                    held.append((ids[base : ends[to - 1]], lengths[k:to]))
                    docs += names[k:to]
                    size += int(ends[to - 1] - base)
                    k = to
                    if size >= segment_ids or len(docs) >= SEGMENT_DOCS or k < lengths.size:
                        yield flush()
                        docs, held, size = [], [], 0
        if docs:
            yield flush()

    return run


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = None, file_bytes: int = FILE_BYTES, segment_ids: int = SEGMENT_IDS, percent: int = PERCENT) -> None:
    """Writes the ids of every whole text of ``docs``, each followed by ``end_id`` if there is one, to files under ``path``.

    ``tokenizer`` is a byte-level file of the tokenizers library that every machine has. Documents are in ascending order of doc_id, null first;
    rows of one doc_id by a hash of the text. A null text counts as empty. Rows are dealt by ranges of (doc_id, hash, place in the input), so that
    a doc_id which very many rows have is split too; texts move once. Columns other than doc_id and text are not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    keys = ["doc_id", "_h", "_at"]
    dealt = rows.withColumns({"_h": F.xxhash64("text"), "_at": F.monotonically_increasing_id()}).repartitionByRange(max(1, -(-size // file_bytes)), *keys).sortWithinPartitions(*keys)
    packed = dealt.select("doc_id", "text").mapInArrow(_segments(tokenizer, end_id, segment_ids, percent), "value binary")
    packed.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\0").option("maxRecordsPerFile", FILE_SEGMENTS).text(path)


def _read(with_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("file").to_pylist(), batch.column("content")):
                base = 0
                for segment in segments(content.as_buffer()):
                    ids = segment.ids().astype("<u4", copy=False)
                    ends = np.cumsum(segment.lengths)
                    begins = ends - segment.lengths
                    sums = [zlib.crc32(ids[a:b]) for a, b in zip(begins.tolist(), ends.tolist())]
                    columns = [pa.array(segment.doc_ids, pa.int64()), pa.array(np.full(len(sums), file, np.int64)), pa.array(base + begins), pa.array(segment.lengths), pa.array(sums, pa.int64())]
                    if with_ids:
                        columns.append(pa.ListArray.from_arrays(pa.array(np.append(begins, segment.size).astype(np.int32)), pa.array(ids.astype(np.int64))))
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "file", "at", "n_tokens", "ids_crc32", *["ids"] * with_ids])
                    base += segment.size

    return run


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, file, at, n_tokens, ids_crc32) of every document under ``path``: its file, its place among the ids of the file, and the checksum
    of its ids as unsigned 32-bit numbers in little-endian order; with ``with_ids`` also the ids. Files are in the order of their numbers."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    part = F.regexp_extract("path", r"part-(\d+)-[^/]*$", 1).cast("bigint")
    turn = F.coalesce(F.nullif(F.regexp_extract("path", r"-c(\d+)[^/]*$", 1), F.lit("")), F.lit("0")).cast("bigint")
    return files.select((part * 1_000_000 + turn).alias("file"), "content").mapInArrow(_read(with_ids), READ + ", ids array<bigint>" * with_ids)


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` of ``read_ids`` with ``start``, the number of ids of all documents before: running sums over files, ranges of files at a time."""
    rows = stored(rows, "ids")
    files = stored(rows.groupBy("file").agg(F.sum("n_tokens").alias("n")).withColumn("part", F.floor(F.col("file") / (FILE_RANGE * 1_000_000))), "files")
    ranges = files.groupBy("part").agg(F.sum("n").alias("n"))  # a row for a thousand files
    ranges = ranges.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("base"))
    bases = files.join(F.broadcast(ranges), "part").select("file", (F.col("base") + F.sum("n").over(W.partitionBy("part").orderBy("file")) - F.col("n")).alias("base"))
    return rows.join(sized(stored(bases, "bases")), "file").withColumn("start", F.col("base") + F.col("at")).drop("base")
