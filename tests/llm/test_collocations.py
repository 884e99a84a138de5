import random
import re
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from atomweft.llm import collocations

from .cases import empty_docs, odd_docs


def brute(rows, least, top):
    """Everything counted, then cut, dropped and ranked as defined."""
    f, n = {}, Counter()
    for lang, text in rows:
        own = f.setdefault(lang or "und", Counter())
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    own[tuple(w[i : i + k])] += 1
    out = []
    for lang, own in f.items():
        candidates = {g: a for g, a in own.items() if len(g) > 1 and a >= least}
        inside = lambda g, q: any(q[i : i + len(g)] == g for i in range(len(q) - len(g) + 1))
        strong = {}
        for q, a in candidates.items():
            for k in range(2, len(q)):
                for i in range(len(q) - k + 1):
                    assert inside(q[i : i + k], q)
                    strong[q[i : i + k]] = max(a, strong.get(q[i : i + k], 0))
        found = []
        for g, a in candidates.items():
            if strong.get(g, 0) < a:
                score, _, l, r = min((1000 * a * n[lang] // (own[g[:k]] * own[g[k:]]), k, own[g[:k]], own[g[k:]]) for k in range(1, len(g)))
                found.append((-score, -a, " ".join(g).encode(), l, r))
        out += [(lang, k, p.decode(), -a, l, r, n[lang], -s) for k, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def corpus(n=1500, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(120)]
    fixed = ["new york city", "ad hoc", "in spite of all that", "a b c d e f g", "the the the", "Ünder Über", "zz top"]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(5, 40)):
            words += [rng.choice(vocabulary[: rng.choice([3, 10, 120])])] if rng.random() < 0.8 else rng.choice(fixed).split()
            if rng.random() < 0.1:
                words[-1] += rng.choice([".", ",", "!?", "\n", "\t", " ;"])
        rows.append((["en", "de", None][i % 7 % 3], " ".join(words) if i % 50 else ["", None, " ,. "][i % 3]))
    return rows


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("how", [{"top": 5, "share": 8}, {"top": 40, "nodes": 150, "share": 1}])
def test_phrases_against_brute_force(spark, monkeypatch, how):
    rows = corpus()
    got = collocations.collocations(spark.createDataFrame(rows, "lang string, text string").repartition(6), least=25, **how)
    assert got.columns == COLUMNS
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 25, how["top"])


def test_odd_rows(spark):
    docs = odd_docs(spark, "phrase w1 n")
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert sorted(tuple(r) for r in collocations.collocations(docs, least=3, top=50).collect()) == brute(rows, 3, 50)
    assert collocations.collocations(empty_docs(spark)).collect() == [] and collocations.collocations(docs, least=10**9).collect() == []


def test_long_texts_are_cut_without_losing_phrases(monkeypatch):
    rng = random.Random(5)
    text = "".join(rng.choice(["ab", "c", "é", " ", "  ", "\t", ". ", "\n"]) for _ in range(3000))
    for size in (7, 64, 1000):
        monkeypatch.setattr(collocations, "SLICE_BYTES", size)
        monkeypatch.setattr(collocations, "CHUNK_WORDS", 50)
        import numpy as np

        held, parts = collocations._Held("x"), []
        for i, part in enumerate(collocations._windows(np.frombuffer(text.encode(), np.uint8))):
            parts += held.add(part, np.zeros(1 - min(i, 1), np.int64))
        parts.append(held.flush())
        pieces = []
        for p in parts:
            words = p.column("words")[0].as_py()
            for c in np.frombuffer(p.column("codes")[0].as_py(), "<u4").tolist():
                pieces = [*pieces, []] if c == 0 else [*pieces[:-1], [*pieces[-1], words[c - 1]]]
        assert pieces == [w for x in re.split(r"[.,;:!?\x0A-\x0D]", text) if (w := re.findall(r"[^\x20\x09]+", x))]


def test_words_that_share_a_hash_are_hashed_anew(spark, monkeypatch):
    docs = spark.createDataFrame(corpus(60), "lang string, text string")
    real, calls = collocations.F.xxhash64, []

    def weak(*columns):
        calls.append(columns)
        return collocations.F.length(columns[-1]).cast("bigint") if len(calls) <= 2 else real(*columns)

    monkeypatch.setattr(collocations.F, "xxhash64", weak)
    _, words = collocations.tokenised(docs, 42)
    assert len(calls) == 4 and words.select("h").distinct().count() == words.count()


def test_workers_hold_little_at_once():
    """A worker's arrays are a small part of the 600 MB that two workers leave each other; rows leave it in bounded batches."""
    rng = np.random.default_rng(3)
    words = np.array([f"word{i}" for i in range(150_000)])
    texts = [" ".join(rng.choice(words, 2000)) for _ in range(600)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array(texts)], ["lang", "text"])
    tracemalloc.start()
    chunks = list(collocations._chunks(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20
    numbers = {w: i + 1 for i, w in enumerate(words.tolist())}
    named = [pa.RecordBatch.from_arrays([c.column("codes"), pa.array([[numbers[w] for w in c.column("words")[0].as_py()]])], ["codes", "hashes"]) for c in chunks]
    tree = SimpleNamespace(value=collocations.Tree(np.arange(1, len(words) + 1)[:, None], np.ones(len(words), np.int64), np.arange(len(words))))
    sizes, total = [], 0
    for rows in collocations._extend(tree)(iter(named)):
        sizes.append(rows.num_rows)
        total += sum(rows.column("c").to_pylist())
    assert total == sum(len(t.split()) - 1 for t in texts) and max(sizes) <= 1 << 16 < sum(sizes)
