"""Toxicity, language identification and language-model scores."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from atomweft.llm import language_id, lm_scoring, toxicity

from .cases import empty_docs, key, odd_docs, prose

BAD = ["grumbol", "snarkle"]


def toxic_docs(spark, disguise=lambda w: w):
    rows, labels = [], []
    for i in range(400):
        words = prose(i, 40).split()
        if i % 4 == 0:
            words[5], words[20] = disguise(BAD[i % 8 // 4]), disguise(BAD[(i + 4) % 8 // 4])
        else:
            words[7] = ["grand", "snail", "marble", "gumbo"][i % 4]
        rows.append((i, " ".join(words), "en", "a", 1))
        labels.append((i, 1, int(i % 4 == 0)))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_docs(spark)
    got = {r.doc_id: r for r in toxicity.score_documents(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(r.predicted == int(i % 4 == 0) == int(r.score >= 0.5) for i, r in got.items() if r.held_out)


def test_disguised_words_are_restored(spark):
    docs, _ = toxic_docs(spark)
    decode = toxicity.Decoder(toxicity.char_model(docs))
    for text, word in [("gr0mbol", "grombol"), ("snark1e", "snarkle"), ("s n a r k l e", "snarkle"), ("snaaaarkle", "snarkle"), ("$narkle", "snarkle"), ("G.R.U.M.B.O.L", "grumbol"), ("grumb0l", "grumbol")]:
        assert word in toxicity.restored_words(text, decode), text


def test_long_stretched_spaced_and_accented_words_are_restored(spark):
    docs, _ = toxic_docs(spark)
    decode = toxicity.Decoder(toxicity.char_model(docs))
    for text, word in [("sn" + "a" * 60 + "rkle", "snarkle"), ("a s n a r k l e", "snarkle"), ("s  n\ta\nr k l e", "snarkle"), ("snnaarrkle", "snarkle"), ("sn\u00e4rk1e", "snarkle"), ("g r u m b o l s n a r k l e g r u m b o l s n a r k l e", "snarkle"), ("g.r.u.m.b.o.l.s.n.a.r.k.l.e.g.r.u.m.b.o.l.s.n.a.r.k.l.e", "grumbol")]:
        assert word in toxicity.restored_words(text, decode), text
    assert len(toxicity.restored_words("4" * 500_000 + "a " + "x1" * 100_000, decode)) > 0


def paths(token, model, gaps):
    """All spellings of the lattice with their scores."""
    code, edge = toxicity.CODES, toxicity.CODES["^"]

    def go(at, a, b, text, score):
        if at == len(token):
            yield score + (model[a, b, edge] if (a, b) != (edge, edge) or not text else 0.0), text
            return
        char = token[at]
        options = [(char, toxicity.KEEP)] if char in code else [(c, toxicity.SWAP) for c in toxicity.LEET.get(char, "")]
        steps = [(a, b, text, score + toxicity.DROP)] if not options else []
        for letter, cost in options:
            steps.append((b, code[letter], text + letter, score + cost + model[a, b, code[letter]]))
            if at and token[at - 1] == char and text[-1:] == letter:
                steps.append((a, b, text, score + (toxicity.DROP if char * 3 in token[max(at - 2, 0) : at + 3] else toxicity.DROP_PAIR)))
        for x, y, t, s in steps:
            yield from go(at + 1, x, y, t, s)
            if gaps and (x, y) != (edge, edge):
                yield from go(at + 1, edge, edge, t + " ", s + model[x, y, edge])

    yield from go(0, edge, edge, "", 0.0)


@pytest.mark.parametrize("gaps", [False, True])
def test_decoding_finds_the_best_of_all_paths(gaps):
    rng = np.random.default_rng(2)
    model = np.log(rng.dirichlet(np.ones(toxicity.SIZE), (toxicity.SIZE, toxicity.SIZE)))
    for token in ["a1b", "1*1", "aab", "abc", "$0", "x", "7ab1", "é1a"] + (["aaab1", "b**b", "1111"] if not gaps else []):
        score, text = max(paths(token, model, gaps))
        got = toxicity.Decoder(model)(token, gaps)
        assert any(math.isclose(s, score, rel_tol=1e-12) for s, t in paths(token, model, gaps) if t == got), (token, text, got)


def test_disguised_held_out_documents_score_high(spark):
    docs, labels = toxic_docs(spark)
    hidden, _ = toxic_docs(spark, lambda w: w.replace("o", "0").replace("a", "@"))
    both = docs.where("crc32(cast(doc_id as string)) % 5 <> 0").unionByName(hidden.where("crc32(cast(doc_id as string)) % 5 = 0"))
    got = toxicity.score_documents(both, labels).where("held_out").collect()
    assert all(r.predicted == int(r.doc_id % 4 == 0) for r in got)


def test_toxicity_of_odd_rows(spark):
    docs = odd_docs(spark, "score toxic word")
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (2, None, None), (None, 1, 1), (77, 1, 1)], "doc_id bigint, quality int, toxic int")
    got = toxicity.score_documents(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score < 0.5 for r in got)
    assert toxicity.score_documents(empty_docs(spark), labels.limit(0)).count() == 0


class PlainModel:
    """The same automaton in plain Python: counts of whole n-grams, one step at a time."""

    def __init__(self, texts):
        self.counts = Counter()
        for t in texts:
            seq = [lm_scoring.START, *lm_scoring.tokens(t)]
            self.counts.update((n, *seq[i - n + 1 : i + 1]) for n in (1, 2, 3) for i in range(1, len(seq)) if i - n + 1 >= 0)
            self.counts[1, lm_scoring.START] += 1
        words = {g[1]: c for g, c in self.counts.items() if g[0] == 1 and g[1] != lm_scoring.START}
        ones, twos = (sum(c == k for c in words.values()) for k in (1, 2))
        self.total, self.words, self.d = sum(words.values()), words, ones / (ones + 2 * twos) if ones and twos else 0.5

    def p(self, context, word):
        if not context:
            if not self.total:
                return 0.5
            return (self.words[word] - self.d) / self.total if word in self.words else self.d * len(self.words) / self.total
        k, seen = lm_scoring.KAPPA[len(context) - 1], self.counts[len(context), *context]
        return (self.counts[len(context) + 1, *context, word] + k * self.p(context[1:], word)) / (seen + k)

    def score(self, text):
        seq = [lm_scoring.START, *lm_scoring.tokens(text)]
        return sum(math.log10(self.p(tuple(seq[max(0, i - 2) : i]), seq[i])) for i in range(1, len(seq)))


def lm_docs(spark, name):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    some = [(i, prose(i, 20 + i % 9) + " Same Words here" * (i % 3), "en", "a", 1) for i in range(60)]
    return {"odd": lambda: odd_docs(spark, "word chunk train"), "prose": lambda: spark.createDataFrame(some, schema), "none": lambda: empty_docs(spark), "all held out": lambda: spark.createDataFrame([(8, "a b a b", "en", "a", 1)], schema)}[name]()


def test_every_state_sums_to_one():
    model = PlainModel(["a b a c", "b a c", "a b a b", "c"])
    for context in [(), (b"a",), (b"b",), (lm_scoring.START,), (b"a", b"b"), (lm_scoring.START, b"a"), (b"b", b"a")]:
        assert math.isclose(sum(model.p(context, w) for w in [b"a", b"b", b"c", lm_scoring.END, b"unknown"]), 1)


@pytest.mark.parametrize("docs", ["odd", "prose", "all held out"])
@pytest.mark.parametrize("chunk, part_bytes", [(1 << 21, 1 << 24), (50, 100)])
def test_scores_are_those_of_a_plain_model(spark, docs, chunk, part_bytes):
    df = lm_docs(spark, docs)
    rows = df.collect()
    model = PlainModel([r.text for r in rows if r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 7 != 2])
    got = lm_scoring.score_documents(df, chunk_tokens=chunk, part_bytes=part_bytes).collect()
    assert key([(r.doc_id, round(r.score, 6)) for r in got]) == key([(r.doc_id, round(model.score(r.text), 6)) for r in rows])


def test_packed_numbers_come_back():
    rng = np.random.default_rng(0)
    some = [rng.integers(0, 2**k, 100).astype(np.uint64) for k in (1, 8, 33, 63)] + [np.zeros(0, np.uint64), np.array([2**64 - 1], np.uint64)]
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(some, lm_scoring._unpacked(lm_scoring._packed(*some)), strict=True))


@pytest.mark.parametrize("docs", ["odd", "prose", "none"])
def test_lm_figures_by_brute_force(spark, docs):
    df = lm_docs(spark, docs)
    rows = df.collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    tok = [lm_scoring.tokens(r.text) for r in rows]
    c = Counter(w for r, t in zip(rows, tok) if not held(r.doc_id) for w in t)
    n, v = sum(c.values()), len(c)
    got = lm_scoring.score_documents(df, chunk_tokens=99).collect()
    want = [(r.doc_id, held(r.doc_id), len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 6)) for r, t in zip(rows, tok)]
    assert key([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got]) == key(want)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    if docs == "prose":
        assert sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out)


def test_counts_over_16_bits(spark):
    df = spark.createDataFrame([(1, "x " * 150_000, "en", "a", 1), (2, "x y", "en", "a", 1)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r.doc_id: r for r in lm_scoring.score_documents(df).collect()}
    assert got[1].n_known == got[1].n_tokens == 150_001


LANGS = {"en": "the house of the people and their city", "de": "das haus der leute und ihre stadt nicht", "fr": "la maison des gens et leur ville avec"}


def test_language_id(spark):
    docs = spark.createDataFrame([(i, " ".join(LANGS[x].split()[(i * 3 + k) % 7] for k in range(30)), x, "a", 1) for i in range(90) for x in LANGS], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    names = list(LANGS)
    rows = [(i, f"http://{names[i % 3]}.host/{i}", f'<html lang="{names[i % 3]}-XX"><script>das der</script><p>' + " ".join(LANGS[names[i % 3]].split()[(i + k) % 7] for k in range(12)) + "</p></html>") for i in range(90)]
    rows += [(900, "http://de.host/x", '<html lang="de"></html>'), (901, None, None), (None, "http://x.y/", "<html lang=>la maison des gens et leur ville</html>"), (900, "http://de.host/x", '<html lang="de"></html>')]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'q' as lang", "'r' as host", "1 as text")
    got = language_id.identify(pages, docs).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == len(rows) and all(by[i].lang == names[i % 3] for i in range(90)) and all(r.probability is None or 0 < r.probability <= 1 for r in got)
    assert by[900].text_lang is None and by[900].lang == "de" and by[None].lang == "fr" and by[901].lang in names
    assert language_id.identify(pages.limit(0), docs).count() == 0
    assert {r.lang for r in language_id.identify(pages, docs.limit(0)).collect()} == {None}


def test_visible_text_of_pages():
    for html, text in [("a<script>x<b>y</SCRIPT >b", "a b"), ("caf&eacute; <!-- <p> --> &lt;b", "café <b"), ("a <b", "a <b"), ("<style>x", "x"), ("<!-- a > b", "b"), ("<scripts>x</scripts>", "x"), ("x</script>y<script>", "x y"), ("", "")]:
        assert language_id.visible(html).split() == text.split(), html
    for part in ("<script>", "<!--", "<style ", "<", "<script><!--</b>"):
        assert len(language_id.visible(part * 200_000)) <= 400_000 * len(part)


def test_language_posterior_by_brute_force(spark):
    docs = spark.createDataFrame([(i, " ".join(LANGS[x].split()[(i * 3 + k) % 7] for k in range(9)), x) for i in range(30) for x in LANGS], "doc_id bigint, text string, lang string")
    names = sorted(LANGS)
    pages = [(i, f"http://h{i % 4}.{'xyz'[i % 3]}/", f'<html lang="{names[i % 2]}">' * (i % 3 > 0) + " ".join(LANGS[names[i * i % 3]].split()[: i % 5])) for i in range(60)]
    pages += [(100, "http://h1.x/", "the la das"), (101, "http://new.q/", "the house"), (102, "http://h1.x/", None), (103, "http://h2.y/", "x " * 200_000)]
    langs, table = language_id.fit(docs)
    rows = []
    for i, url, html in pages:
        at = language_id.trigrams(language_id.visible(html or "").encode())
        score = table[at].sum(axis=0, dtype=np.float64) * min(1.0, language_id.EVIDENCE / max(len(at), 1)) if len(at) else np.zeros(3)
        host = url.split("/")[2]
        declared = html[12:14] if (html or "").startswith("<html") else ""
        rows.append((i, host, host.split(".")[-1], declared, score, int(np.argmax(score)) if len(at) else None))
    votes = [r for r in rows if r[5] is not None]
    n_declared = len({r[3] for r in rows})
    got = {r.page_id: r for r in language_id.identify(spark.createDataFrame(pages, "page_id bigint, url string, html string"), docs).collect()}
    for i, host, suffix, declared, score, own in rows:
        log = []
        for k in range(3):
            count = lambda at, value: sum(v[5] == k for v in votes if v[at] == value) - (own == k)  # noqa: B023, E731
            size = lambda at, value: sum(v[at] == value for v in votes) - (own is not None)  # noqa: B023, E731
            base = (sum(v[5] == k for v in votes) + 1) / (len(votes) + 3)
            by_suffix = (count(2, suffix) + language_id.SUFFIX_WEIGHT * base) / (size(2, suffix) + language_id.SUFFIX_WEIGHT)
            by_host = (count(1, host) + language_id.HOST_WEIGHT * by_suffix) / (size(1, host) + language_id.HOST_WEIGHT)
            said = (count(3, declared) + language_id.DECLARED_WEIGHT) / (sum(v[5] == k for v in votes) - (own == k) + language_id.DECLARED_WEIGHT * n_declared) if declared else 1.0
            log.append(score[k] + math.log(by_host) + math.log(said))
        p = np.exp(np.array(log) - max(log))
        p /= p.sum()
        assert math.isclose(got[i].probability, p.max(), rel_tol=1e-9) and got[i].lang in {x for x, y in zip(langs, p) if math.isclose(y, p.max(), rel_tol=1e-9)}
        assert got[i].text_lang == (None if own is None else langs[own])
