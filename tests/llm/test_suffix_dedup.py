import hashlib
import uuid
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from atomweft.llm import suffix_dedup as S

from .cases import empty_docs, key, odd_docs, prose


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    n = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        mark = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - length + 1):
            if n[d[i : i + length]] > 1:
                mark[i : i + length] = True
        rest = bytes(b for b, m in zip(d, mark) if not m)
        out.append((len(d), int(mark.sum()), int((mark[:-1] & ~mark[1:]).sum()), hashlib.sha256(rest).hexdigest()))
    return out


@pytest.mark.parametrize("max_group", [S.MAX_GROUP, 2])
@pytest.mark.parametrize("length", [40, 400])
def test_removed_bytes_by_brute_force(spark, length, max_group):
    shared = prose(50, 120)
    docs = odd_docs(spark, "_aw n_bytes spans whole found").where("doc_id <> 6 OR doc_id IS NULL")
    more = [(100 + i, prose(i, 30) + " " + shared[: 60 * (i + 1)] + " " + prose(90 + i, 20) + ("ab" * 300 if i == 5 else ""), "en", "a", 1) for i in range(12)]
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(spark.createDataFrame(more, docs.select("doc_id", "text", "lang", "source", "n_chars").schema))
    rows = docs.collect()
    got = S.remove_repeats(docs, length, max_group, with_text=False).collect()
    want = brute([r.text for r in rows], length)
    assert key([tuple(r) for r in got]) == key([(r.doc_id, *w) for r, w in zip(rows, want)])


PERIODIC = ["a" * 399, "a" * 400, "a" * 401 + "b", "xy" + "a" * 900 + "z", "ab" * 250, "b" + "ab" * 200, "abc" * 133 + "abX", "abc" * 200 + "q" + "a" * 420 + "abc" * 150, "abcdefgh" * 60, "tail " + "abcdefgh" * 50 + "!", "0123456789" * 41]


@pytest.mark.parametrize("some", [PERIODIC, PERIODIC[3:4], PERIODIC[4:6], PERIODIC[7:8], PERIODIC[8:10]])
def test_periodic_texts_by_brute_force(spark, some):
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id bigint, text string")
    got = S.remove_repeats(docs, 400, with_text=False).collect()
    assert key([tuple(r) for r in got]) == key([(i, *w) for i, w in enumerate(brute(some, 400))])


def test_periodic_texts_of_megabytes_leave_few_segments(spark):
    texts = ["a" * 10_000_000, "head " + "ab" * 1_000_000, "-" * 400 + "=" * 399]
    for t in texts:
        data = np.frombuffer(t.encode(), np.uint8)
        assert len(S.without_periods(data, 400, S.anchors(data, 400))[0][0]) < 300
    got = S.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), 400, with_text=False).collect()
    assert sorted((r.doc_id, r.n_removed, r.n_spans) for r in got) == [(0, 10_000_000, 1), (1, 2_000_000, 1), (2, 0, 0)]


def test_very_long_texts_share_a_passage(spark):
    a, b, shared = prose(3, 400_000, 7), prose(11, 300_000, 11), prose(50, 200, 3).replace("w", "q")
    a, b = " ".join(f"{w}-{i}" for i, w in enumerate(a.split())), " ".join(f"{w}+{i}" for i, w in enumerate(b.split()))
    docs = spark.createDataFrame([(1, a + shared + "1"), (2, "0" + shared + b)], "doc_id bigint, text string")
    assert {(r.n_removed, r.n_spans) for r in S.remove_repeats(docs, 400, with_text=False).collect()} == {(len(shared), 1)}


def test_texts_are_cut(spark):
    docs = odd_docs(spark, "n_bytes kept_sha256 _aw_x")
    out = S.remove_repeats(docs, 100)
    assert set(docs.columns) < set(out.columns) and out.count() == docs.count()
    by = {r.doc_id: r for r in out.collect() if r.doc_id is not None}
    assert by[1].text == "" == by[2].text and by[8].text == "one" and by[-5].n_removed == 0 and by[9].text == "\n"
    assert S.remove_repeats(empty_docs(spark), 100).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=8, max_size=40), min_size=2, max_size=6))
def test_construction_finds_repeats_of_aligned_segments(texts):
    """Segments aligned at their first byte: a window is repeated if another segment has it at the same offset."""
    length, data = 8, [t.encode() for t in texts]
    count = np.array([len(d) - length + 1 for d in data])
    flags = S.repeated_windows(data, np.zeros(len(data), int), count, np.zeros(len(data), int), length)
    for i, d in enumerate(data):
        for at in range(count[i]):
            twins = sum(e[at : at + length] == d[at : at + length] for e in data)
            assert flags[i, at] == (twins > 1)


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(1)
    part = rng.integers(97, 101, 900).astype(np.uint8)
    a = np.concatenate([rng.integers(97, 101, 333).astype(np.uint8), part])
    runs = {}
    for name, data in (("a", a), ("part", part)):
        at, h, low, high = S.anchors(data, 400)
        assert low[0] == 0 and high[-1] == len(data) - 400 and (low[1:] == high[:-1] + 1).all()
        runs[name] = {s: (h_, p - s) for p, h_, lo, hi in zip(at, h, low, high) for s in range(lo, hi + 1)}
    assert all(runs["a"][333 + s] == x for s, x in runs["part"].items())


def test_many_affected_rows_take_one_shuffle(spark, monkeypatch):
    docs = odd_docs(spark)
    want = key([tuple(r) for r in S.remove_repeats(docs, 100).collect()])
    monkeypatch.setattr(S, "BROADCAST_ROWS", 0)
    assert key([tuple(r) for r in S.remove_repeats(docs, 100).collect()]) == want


def test_no_task_builds_the_segments_of_a_hot_anchor_alone(spark, monkeypatch, tmp_path):
    """700 texts around one passage, and 700 copies of a text with one letter changed, all of them different."""
    rng = np.random.default_rng(9)
    letters = lambda n: rng.integers(97, 123, n).astype(np.uint8).tobytes().decode()
    passage, base = letters(160), letters(240)
    texts = [letters(60) + passage + letters(60) for _ in range(700)] + [base[:k] + c + base[k + 1 :] for k in range(0, 240, 8) for c in "0123456789ABCDEFGHIJKLMN"][:700]
    assert len(set(texts)) == 1400
    mark = S._mark

    def watched(length):
        inner = mark(length)

        def run(batches):
            held = list(batches)
            keys = [k for b in held for k in b.column("anchor").to_pylist()]
            (tmp_path / uuid.uuid4().hex).write_text(str(max(Counter(keys).values(), default=0)))
            return inner(iter(held))

        return run

    monkeypatch.setattr(S, "_mark", watched)
    got = S.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), 100, with_text=False).collect()
    assert key([tuple(r) for r in got]) == key([(i, *w) for i, w in enumerate(brute(texts, 100))])
    assert 1 < max(int(f.read_text()) for f in tmp_path.iterdir()) <= 512
