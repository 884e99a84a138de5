import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from atomweft.llm import token_files
from atomweft.llm.common import checkpoint_dir

from .cases import empty_docs, key, odd_docs

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("width", range(1, 33))
def test_packed_values_come_back(width):
    values = np.random.default_rng(width).integers(0, 1 << width, (7, 64), dtype=np.uint64)
    packed = token_files.pack(values, width)
    assert packed.shape == (7, width) and (token_files.unpack(packed, width) == values).all()


def test_segments_come_back_whole_and_in_ranges():
    rng = np.random.default_rng(1)
    for n in (0, 1, 255, 256, 257, 5000):
        for top in (1, 2, 300, 50_257, 1 << 32):
            ids = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
            ids[rng.random(n) < 0.03] = top - 1  # outliers
            lengths = np.array([n // 3, 0, n - n // 3])
            data = token_files.write_segment(ids, [-7, None, 1 << 40], lengths)
            one, two = token_files.segments(data + b"\0" + data + b"\0")
            assert one.doc_ids == [-7, None, 1 << 40] and one.lengths.tolist() == lengths.tolist() and (two.ids() == ids).all()
            for _ in range(20):
                a, b = sorted(rng.integers(0, n + 1, 2))
                assert (one.ids(a, b) == ids[a:b]).all()
    steady = token_files.write_segment(np.full(1 << 14, 9, np.uint32), [1], np.array([1 << 14]))
    assert len(steady) < 1000  # width 0
    rare = np.random.default_rng(2).integers(0, 16, 1 << 14).astype(np.uint32)
    rare[::100] = 1 << 31
    assert len(token_files.write_segment(rare, [1], np.array([1 << 14]))) < (1 << 14)  # 4 bits and exceptions, not 32


def awkward_texts():
    rng = random.Random(3)
    parts = ["a", "Zeta", "é", "ß", "漢字", "🙂", " ", "  ", "\n", "\n\n", "\t", "\r\n", " ", " ", "　", "\u0085", ".", ",", "'s", "'", "123", "<|endoftext|>", "|", "<", "don't", "x" * 90, "\x1c", "\x00", "-", "​", "́"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    return [*texts, "", " ", "\n", " a", "a ", "a\n", "\na", "a \nb", "a\n b", "a. b", "a .b", "".join(rng.choice(parts) for _ in range(50_000))]


def test_pieces_give_the_ids_of_whole_texts():
    tokenizer, texts = Tokenizer.from_file(FILE), awkward_texts()
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for pieces in (token_files.PIECES, 10):
        encode = token_files.Encoder(FILE, 2, pieces)
        for _ in range(2):
            ids, lengths = encode(pa.array(texts))
            got = np.split(ids, np.cumsum(lengths)[:-1])
            assert [x.tolist() for x in got] == [[*w, 2] for w in want]
    ids, lengths = token_files.Encoder(FILE, None)(pa.array(["", None, "one two"]))
    assert lengths.tolist() == [0, 0, len(ids)]
    assert [x.size for x in token_files.Encoder(FILE, None)(pa.array([], pa.string()))] == [0, 0]


class Counting:
    """The tokenizer, with the numbers of texts and words that it was given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts, self.words = tokenizer, 0, 0

    def encode_batch_fast(self, texts, **how):
        self.texts += len(texts)
        self.words += sum(len(t.split()) for t in texts)
        return self.tokenizer.encode_batch_fast(texts, **how)


def test_new_pieces_are_encoded_as_lines_of_few_texts():
    texts = [" ".join(f"{a}{i}{b}" for i in range(k, k + 50)) for k in range(0, 5000, 50) for a, b in (("word", ""), ("é", "漢"), ("'s", "!"), ("<|endoftext|>", "ß"), ("a\tb", "\u3000c"))]
    encode = token_files.Encoder(FILE, None)
    encode.tokenizer = counting = Counting(encode.tokenizer)
    want = [i for t in texts for i in counting.tokenizer.encode(t, add_special_tokens=False).ids]
    assert encode(pa.array(texts))[0].tolist() == want
    assert counting.texts < 25_000 / 32
    apart = token_files.Encoder(FILE, None)
    apart.feed = 11  # not what a line feed gives: the pieces are encoded one by one
    assert apart(pa.array(texts))[0].tolist() == want
    apart = token_files.Encoder(FILE, None)
    apart.feed = None
    assert apart(pa.array(texts))[0].tolist() == want


def test_common_pieces_stay_known_as_others_pass():
    encode = token_files.Encoder(FILE, None, pieces=100)
    encode.tokenizer = counting = Counting(encode.tokenizer)
    common = " ".join(f"common{i}" for i in range(20))
    seen = []
    for k in range(30):
        text = common + " " + " ".join(f"rare{k}x{i}" for i in range(20))
        assert encode(pa.array([text]))[0].tolist() == counting.tokenizer.encode(text, add_special_tokens=False).ids
        seen.append(counting.words)
        assert len(encode.known) + len(encode.before) <= 100
    assert np.diff(seen).tolist() == [20] * 29  # only the rare ones are new


def test_tasks_of_a_worker_share_what_is_known(tmp_path):
    texts = [f"word{i}a common é{i} line\nend{i}, 漢{i}." for i in range(300)]
    batches = [pa.record_batch({"doc_id": pa.array(range(k, k + 100)), "text": texts[k : k + 100]}) for k in range(0, 300, 100)]
    file = tmp_path / "tokenizer.json"
    file.write_bytes(open(FILE, "rb").read())

    def task():
        return [x["value"] for b in token_files._segments(str(file), 2, 1000, 95)(iter(batches)) for x in b.to_pylist()]

    encode = token_files.encoder(str(file), 2)
    encode.tokenizer = counting = Counting(encode.tokenizer)
    written = task()
    words = counting.words
    assert words > 0 and task() == written and counting.words == words  # nothing is new to the second task
    ids = np.concatenate([s.ids() for x in written for s in token_files.segments(x + b"\0")])
    assert ids.tolist() == [i for t in texts for i in [*counting.tokenizer.encode(t, add_special_tokens=False).ids, 2]]
    file.write_bytes(file.read_bytes() + b"\n")  # another file under the same name
    assert token_files.encoder(str(file), 2) is not encode


def test_pieces_are_lines_if_white_space_is_only_a_blank_before():
    line = re.compile(rb" ?(?=[!-~\xC3-\xDF\xE4-\xED])[^\n]*(?:[!-~]|[\xC3-\xDF][\x80-\xBF]|[\xE4-\xED][\x80-\xBF]{2})").fullmatch
    pieces = [*(t.encode() for t in awkward_texts() if t), b" ", b"a", b" a", b"  a", "é".encode(), " 漢".encode(), "ж".encode(), "a\u3000".encode(), b"a\nb"]
    assert token_files.line_like(pa.array(pieces, pa.large_binary())).tolist() == [line(p) is not None for p in pieces]
    assert token_files.line_like(pa.array(pieces, pa.large_binary()).slice(5, 9)).tolist() == [line(p) is not None for p in pieces[5:14]]


def expected(rows):
    tokenizer, start, out = Tokenizer.from_file(FILE), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def through(spark, docs, name, **how):
    path = f"{checkpoint_dir(spark)}/{name}"
    token_files.write_ids(docs, path, FILE, end_id=2, **how)
    return token_files.placed(token_files.read_ids(spark, path))


def test_files_of_awkward_texts_against_the_tokenizer(spark):
    rows = list(enumerate(awkward_texts()))
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    for k, how in enumerate(({}, {"file_bytes": 20_000, "segment_ids": 700})):
        got = through(spark, docs, f"awkward{k}", **how).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("start").collect()
        assert [tuple(r) for r in got] == expected(rows)


def test_files_of_odd_rows(spark):
    docs = odd_docs(spark, "file at _h value").withColumn("n_tokens", F.lit(1))
    got = through(spark, docs, "odd", file_bytes=1000).collect()
    want = expected([(r.doc_id, r.text) for r in docs.collect()])
    drop_start = lambda rows: key([(a, c, d) for a, _, c, d in rows])  # noqa: E731 - rows of one doc_id are in the order of a hash
    assert drop_start((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == drop_start(want)
    ends = sorted((r.start, r.start + r.n_tokens, r.doc_id is not None, r.doc_id or 0) for r in got)
    assert ends[0][0] == 0 and all(a[1] == b[0] and a[2:] <= b[2:] for a, b in zip(ends, ends[1:]))
    assert through(spark, empty_docs(spark), "empty").count() == 0


def test_one_doc_id_of_most_rows_is_dealt_over_files(spark):
    docs = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("same words in every row").alias("text"))
    path = f"{checkpoint_dir(spark)}/hot"
    token_files.write_ids(docs, path, FILE, end_id=2, file_bytes=6_000)
    rows = token_files.read_ids(spark, path, with_ids=True).cache()
    assert rows.count() == 3000 and rows.groupBy("file").count().agg(F.max("count")).first()[0] < 900
    assert {tuple(r.ids) for r in rows.select("ids").distinct().collect()} == {(*Tokenizer.from_file(FILE).encode("same words in every row").ids, 2)}
