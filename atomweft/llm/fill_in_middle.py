"""Fill-in-the-middle: texts are cut at random token borders and their parts rearranged.

Tokens are words with the white space before them (white space at the end of a text is one more). Texts are cut into chunks where a rolling
hash of the last 32 bytes says so, so that equal passages have equal chunks wherever they stand. What a chunk adds is remembered by its
content (a lookup compares the bytes): the words that start in it, its code points, whether it begins and ends inside a word, and how far the
first word goes on. Summaries combine from left to right, which gives the number of tokens of a text and the chunk of each cut; only that chunk
is looked into.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A chunk ends where these bits of the rolling hash are zero: every 512 bytes on average; it has so many bytes at least and at most.
CHUNK_MASK = np.uint32(511 << 20)
LEAST, MOST = 128, 8192
#: Bytes of chunks that a worker remembers.
CACHE_BYTES = 64 << 20
SEED = 42
MARKS = {"prefix": "<P>", "suffix": "<S>", "middle": "<M>"}
PLAIN_PERCENT, SPM_PERCENT = 50, 80
RESULTS = ("n", "form", "prefix_chars", "middle_chars", "output")
#: Bytes of output text in a batch.
BATCH_BYTES = 8 << 20

_GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)
_TAILS = bytes(range(0x80, 0xC0))
_SPACE = b" \t\n\v\f\r"
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


@dataclass(slots=True)
class Summary:
    """``words`` that start in a chunk if white space is before it, ``chars`` (code points that start in it), whether its first and last byte are
    inside a word, and the bytes of the word at its front (all of them if the chunk has no white space)."""

    words: int
    chars: int
    joins: bool
    open: bool
    head: int
    size: int


def summarise(chunk: bytes) -> Summary:
    blank = _BLANK.search(chunk)
    return Summary(len(chunk.split()), len(chunk.translate(None, _TAILS)), chunk[0] not in _SPACE, chunk[-1] not in _SPACE, blank.start() if blank else len(chunk), len(chunk))


def chunk_ends(text: bytes) -> list[int]:
    """Where the chunks of a text end. The hash of a place sums the last 32 bytes, each shifted once more; no chunk ends before the first 32."""
    n = len(text)
    if n <= LEAST:
        return [n] if n else []
    h = _GEAR[np.frombuffer(text, np.uint8)]
    for k in (1, 2, 4, 8, 16):  # sums over 2, 4, 8, 16 and 32 bytes
        h[k:] = h[k:] + (h[:-k] << np.uint32(k))  # the right side is computed before it is stored
    places = np.flatnonzero((h & CHUNK_MASK) == 0) + 1
    out, at = [], 0
    while at < n:
        k = int(np.searchsorted(places, at + LEAST))
        at = min(int(places[k]) if k < places.size else n, at + MOST, n)
        out.append(at)
    return out


class Cutter:
    """Counts and cuts texts by the summaries of their chunks."""

    def __init__(self, cache_bytes: int = CACHE_BYTES) -> None:
        self.known: dict[bytes, Summary] = {}
        self.room, self.left = cache_bytes, cache_bytes

    def chunks(self, text: bytes) -> tuple[list[int], list[Summary]]:
        at, ends, out = 0, chunk_ends(text), []
        for end in ends:
            chunk = text[at:end]
            found = self.known.get(chunk)
            if found is None:
                found = summarise(chunk)
                self.left -= found.size
                if self.left < 0:
                    self.known.clear()
                    self.left = self.room - found.size
                self.known[chunk] = found
            out.append(found)
            at = end
        return ends, out

    def cut(self, text: bytes, choose: Callable[[int], list[int]]) -> tuple[int, list[tuple[int, int]]]:
        """(n, the (byte, code point) where each number of tokens that ``choose(n)`` gives ends), numbers in ascending order."""
        ends, parts = self.chunks(text)
        words, inside = 0, False
        before = []  # words that have started, and whether a word is open, before each chunk
        for part in parts:
            before.append((words, inside))
            words += part.words - (inside and part.joins)
            inside = part.open
        n = words + (bool(text) and not inside)
        return n, [self._place(text, ends, parts, before, words, n, c) for c in choose(n)]

    def _place(self, text: bytes, ends: list[int], parts: list[Summary], before: list[tuple[int, bool]], words: int, n: int, c: int) -> tuple[int, int]:
        if c == 0:
            return 0, 0
        if c > words or c == n:
            return len(text), sum(p.chars for p in parts)
        low, high = 0, len(parts)  # the last chunk before which fewer than c words have started: word c starts in it
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if before[middle][0] < c else (low, middle)
        start = ends[low] - parts[low].size
        chunk = text[start : ends[low]]
        k = c - before[low][0] + (before[low][1] and parts[low].joins)  # among the words of the chunk taken alone
        for m, word in enumerate(re.finditer(rb"[^\x20\x09-\x0D]+", chunk), 1):
            if m == k:
                at = start + word.end()
                break
        k = low
        while at == ends[k] and k + 1 < len(parts) and parts[k + 1].joins:  # the word goes on in the next chunks
            k += 1
            at += parts[k].head
            if parts[k].head < parts[k].size:
                break
        own = ends[k] - parts[k].size
        return at, sum(p.chars for p in parts[:k]) + len(text[own:at].translate(None, _TAILS))


def _draws(doc_id: int | None, seed: int) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def rearrange(cutter: Cutter, doc_id: int | None, text: bytes, seed: int = SEED) -> tuple[int, str, int | None, int | None, bytes]:
    """(n, form, prefix_chars, middle_chars, output) of a text."""
    h = _draws(doc_id, seed)
    if not text or any(m.encode() in text for m in MARKS.values()) or h[2] % 100 >= PLAIN_PERCENT:
        return cutter.cut(text, lambda n: [])[0], "plain", None, None, text
    n, ((a, a_chars), (b, b_chars)) = cutter.cut(text, lambda n: sorted((h[0] % (n + 1), h[1] % (n + 1))))
    p, s, m = (MARKS[x].encode() for x in ("prefix", "suffix", "middle"))
    if h[3] % 100 < SPM_PERCENT:
        return n, "spm", a_chars, b_chars - a_chars, b"".join((s, text[b:], p, text[:a], m, text[a:b]))
    return n, "psm", a_chars, b_chars - a_chars, b"".join((p, text[:a], s, text[b:], m, text[a:b]))


def _rows(seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter()
        for batch in batches:
            texts = batch.column("_aw_text").cast(pa.large_binary())
            rest = batch.select([c for c in batch.schema.names if not c.startswith("_aw_")])
            first, out, size = 0, [], 0
            for i, (doc_id, text) in enumerate(zip(batch.column("_aw_id").to_pylist(), texts), 1):
                out.append(rearrange(cutter, doc_id, text.as_py() or b"", seed))
                size += len(out[-1][4])
                if size >= BATCH_BYTES or i == batch.num_rows:
                    n, form, prefix, middle, output = zip(*out)
                    made = [pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())]
                    yield pa.RecordBatch.from_arrays([*rest.slice(first, i - first).columns, *made], [*rest.schema.names, *RESULTS])
                    first, out, size = i, [], 0

    return run


def fill_in_middle(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` with their text rearranged: n, form (plain, psm or spm), prefix_chars, middle_chars (null if plain) and output.

    The cuts and the form follow from ``seed`` and doc_id alone. A null text counts as empty; empty texts and texts that hold a mark stay plain;
    rows without a doc_id draw as if it were an empty text; repeated rows give repeated results; an empty table gives an empty result. Columns of
    ``docs`` with the names of the results are replaced; the text itself is not among them. Nothing is shuffled.
    """
    keep = [c for c in docs.columns if c not in (*RESULTS, "text")]
    rows = docs.select(*keep, F.col("doc_id").alias("_aw_id"), F.col("text").alias("_aw_text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema), "n bigint", "form string", "prefix_chars bigint", "middle_chars bigint", "output string"])
    return rows.mapInArrow(_rows(seed), schema)


def restore(output: Column, form: Column) -> Column:
    """The text from which ``output`` of this form was made. No part holds a mark, and no mark overlaps another, so the marks are found again."""
    parts = F.split(output, "<[PSM]>")
    return F.when(form == "plain", output).when(form == "psm", F.concat(parts[1], parts[3], parts[2])).otherwise(F.concat(parts[2], parts[3], parts[1]))
