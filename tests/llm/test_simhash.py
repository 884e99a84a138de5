import numpy as np
import pytest
import xxhash

from atomweft.llm import simhash as S
from atomweft.llm.common import connected_components

from .cases import empty_docs, odd_docs, prose


def components(n, edges):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def brute_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    grams = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("lanes, radius, keys", [(1, 4, 40), (1, 4, 300), (2, 28, 3), (2, 28, 60)])
@pytest.mark.parametrize("sided", [False, True])
def test_bit_sliced_links_join_what_brute_force_joins(lanes, radius, keys, sided):
    rng = np.random.default_rng(keys)
    n = 600
    rows = rng.integers(0, 2**63, (30, lanes), dtype=np.uint64)[rng.integers(0, 30, n)]
    for _ in range(radius):
        at = rng.integers(0, n, n // 3)
        rows[at, rng.integers(0, lanes)] ^= np.uint64(1) << rng.integers(0, 64, len(at)).astype(np.uint64)
    group, side = np.sort(rng.integers(0, keys, n)), rng.integers(0, 2, n) if sided else np.full(n, -1)
    i, j, d = S._links(rows, group, side, radius)
    distance = np.bitwise_count(rows[:, None] ^ rows[None]).sum(axis=2)
    allowed = (group[:, None] == group[None]) & ((side[:, None] < 0) | (side[:, None] != side[None]))
    for r in (radius // 2, radius):
        want = components(n, zip(*np.nonzero(np.triu(allowed & (distance <= r), 1))))
        assert components(n, [(a, b) for a, b, x in zip(i, j, d) if x <= r]) == want


def test_exact_tables_hold_every_pair_within_the_radius():
    rng = np.random.default_rng(0)
    tables = S.exact_tables(64, 4)
    for _ in range(300):
        flipped = set(rng.choice(64, 4, replace=False).tolist())
        assert any(not flipped & set(t) for t in tables)


@pytest.mark.parametrize("tile", [4096, 7])
def test_fingerprints_and_components_by_brute_force(spark, tile, monkeypatch):
    monkeypatch.setattr(S, "TILE", tile)
    rows = [(i, prose(i % 17, 60).replace("w3", f"X{i % 5}", 1 + i % 3), "en", "a", 1) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").unionByName(odd_docs(spark).where("doc_id IS NOT NULL").selectExpr("doc_id + 1000 as doc_id", "text", "lang", "source", "n_chars"))
    reps = S.fingerprints(docs).groupBy("f0").agg({"doc_id": "min"}).withColumnRenamed("min(doc_id)", "rep")
    got = {(r.doc_id, r.f0 & (1 << 64) - 1): r.component_id for r in S.near_duplicates(docs).collect()}
    ids = sorted({(r.doc_id, brute_print(r.text)) for r in docs.collect()})
    want = components(len(ids), [(a, b) for a in range(len(ids)) for b in range(a) if bin(ids[a][1] ^ ids[b][1]).count("1") <= 4 or ids[a][0] == ids[b][0]])
    assert got == {x: ids[c][0] for x, c in zip(ids, want)}
    links = S.bucket_links(reps, S.exact_tables(), 1, 4, tile=tile).collect()
    assert all(x.distance <= 4 for x in links)


def test_odd_rows(spark):
    got = S.near_duplicates(odd_docs(spark, "f0 rep bucket component_id")).collect()
    assert len(got) == 14
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[3].f0 == by[4].f0 == by[5].f0 == 0 and by[5].component_id == 3 and by[2].component_id == 1
    assert S.near_duplicates(empty_docs(spark)).count() == 0
    left = S.drop_near_duplicates(odd_docs(spark, "_id"))
    assert sorted(r.doc_id or 0 for r in left.select("doc_id").collect()) == [-5, 0, 1, 3, 6, 7, 8, 9, 10]
    assert S.drop_near_duplicates(empty_docs(spark)).count() == 0


def test_pipeline_form_agrees_with_shingle_similarity(spark):
    rng = np.random.default_rng(3)
    texts = []
    for base in range(40):
        words = prose(base * 9, 150, base + 1).split()
        for copy in range(4):
            w = list(words)
            for at in rng.choice(150, copy * 3, replace=False):
                w[at] = f"z{rng.integers(1000)}"
            texts.append(" ".join(w))
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    sets = [{tuple(t.split()[i : i + 5]) for i in range(146)} for t in texts]
    n = len(texts)
    want = components(n, [(a, b) for a in range(n) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])
    got = {r.doc_id: r.component_id for r in S.near_duplicates(docs, 5, lanes=2, similarity=0.8).collect()}
    assert [got[i] for i in range(n)] == want


def shingle_components(texts):
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    return components(len(texts), [(a, b) for a in range(len(texts)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])


def similar_components(spark, texts):
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r.doc_id: r.component_id for r in S.near_duplicates(docs, 5, lanes=2, similarity=0.8).collect()}
    return [got[i] for i in range(len(texts))]


def test_variants_that_are_nearer_to_each_other_by_fingerprint_still_link_to_their_original(spark):
    rng = np.random.default_rng(5)
    words = [f"v{i}" for i in range(300)]
    texts = [" ".join(words)]
    for copy in range(400):
        w = list(words)
        for at in rng.choice(60, 6, replace=False) * 5:
            w[at] = f"z{copy}y{at}"
        texts.append(" ".join(w))
    want = shingle_components(texts)
    assert set(want) == {0} and similar_components(spark, texts) == want


def test_common_elements_of_sets():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 9000, n)) for n in (1, 50, 3000, 3000, 8000, 7)]
    got = S.shared_shingles(sets)
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(6) for j in range(6) if i != j)


def test_large_families_lose_no_link_that_the_tables_hold(spark):
    rng = np.random.default_rng(6)
    texts = []
    for family in range(40):
        words = [f"f{family}w{i}" for i in range(120)]
        for copy in range(60):
            w, n = list(words), int(rng.integers(4, 9))
            at = int(rng.integers(0, 120 - n))
            w[at : at + n] = [f"z{family}c{copy}k{k}" for k in range(n)]
            texts.append(" ".join(w))
    got, want = similar_components(spark, texts), shingle_components(texts)
    assert sum(a != b for a, b in zip(got, want)) <= 60  # pairs that share no table


def test_texts_that_differ_in_how_often_a_line_repeats_link(spark):
    words, line = " ".join(f"v{i}" for i in range(100)), " ".join(f"r{i}" for i in range(10))
    texts = [f"{words} {line}", words + f" {line}" * 9]
    assert shingle_components(texts) == similar_components(spark, texts) == [0, 0]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, k) for k in range(1001, 1200)] + [(5, 5), (0, 1)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).distinct().collect()}
    assert got == {i: 0 for i in range(61)} | {k: 1000 for k in range(1000, 1200)}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
