import hashlib
import random
import re

from pyspark.sql import functions as F

from atomweft.llm import fill_in_middle as fim

from .cases import empty_docs, key, odd_docs

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text, seed=42):
    text = text or ""
    tokens = TOKEN.findall(text)
    assert "".join(tokens) == text
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if h[3] % 100 < 80:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    rng = random.Random(1)
    parts = ["a", "wörter", "漢字", "🙂", " ", "  ", "\n", "\t\x0b", " ", "<P>", "<", "S>", "x" * 300, "\x1c", "end "]
    weights = [9, 9, 5, 2, 30, 3, 5, 2, 2, 0.05, 1, 1, 2, 1, 9]
    shared = "".join(rng.choices(parts, weights, k=4000))
    out = ["".join(rng.choices(parts, weights, k=rng.randrange(1, 60))) for _ in range(800)]
    out += ["".join(rng.choices(parts, weights, k=rng.randrange(1, 3000))) + shared + "".join(rng.choices(parts, weights, k=50)) for _ in range(40)]
    return [*out, "", " ", "one", " one", "one ", "y" * 50_000, " " * 50_000, "<", "<S", "z " * 30_000, ("word " * 300 + "é" * 9000) * 3]


def test_cuts_against_whole_texts(spark):
    rows = [(i, t.replace("<P>", "<p>") if i % 2 else t) for i, t in enumerate(texts() * 4)]
    got = fim.fill_in_middle(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
    got = got.withColumn("restored", fim.restore(F.col("output"), F.col("form"))).collect()
    want = {i: (*brute(i, t), t) for i, t in rows}
    assert len(got) == len(rows) and all(tuple(r) == want[r.doc_id] for r in got)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_every_cut_of_a_text():
    for small in (1 << 20, 3000):
        cutter = fim.Cutter(small)
        for text in texts():
            tokens = TOKEN.findall(text)
            every = range(0, len(tokens) + 1, max(1, len(tokens) // 150))
            n, places = cutter.cut(text.encode(), lambda n: every)
            ends = [0]
            for t in tokens:
                ends.append(ends[-1] + len(t))
            assert n == len(tokens) and places == [(len(text[: ends[c]].encode()), ends[c]) for c in every]


def test_equal_passages_have_equal_chunks():
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randrange(2, 9)))
    passage = " ".join(word() for _ in range(4000)).encode()
    cutter = fim.Cutter()
    one = cutter.chunks(b"some front " + passage)[1]
    known = len(cutter.known)
    two = cutter.chunks(b"quite another, longer front of this text " + passage + b" and an end")[1]
    assert len(one) > 20 and len(cutter.known) - known <= 4 and len(two) > 20


def test_odd_rows(spark):
    docs = odd_docs(spark, "n form output h")
    got = fim.fill_in_middle(docs)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "h", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert key([tuple(r) for r in got.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()]) == key([brute(r.doc_id, r.text) for r in docs.collect()])
    assert fim.fill_in_middle(empty_docs(spark)).count() == 0
