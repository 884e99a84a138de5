import itertools
import math
import random
from fractions import Fraction
from pathlib import Path

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from atomweft.llm import mixing

from .cases import empty_docs, odd_docs


@pytest.mark.parametrize("seed", range(6))
def test_every_block_meets_its_window_and_the_lag_stays_under_one(seed):
    rng = random.Random(seed)
    weights = {f"s{i}": round(rng.choice([1, 2, 5, 50, 300]) * rng.random() + 0.01, 2) for i in range(rng.randint(1, 30))}
    parts = mixing.parts_of(weights)
    whole, total = sum(parts.values()), sum(Fraction(str(w)) for w in weights.values())
    assert all(Fraction(parts[s], whole) == Fraction(str(w)) / total for s, w in weights.items())
    slots = mixing.schedule(parts)
    assert sorted(t for x in slots.values() for t in x) == list(range(whole))
    for s, a in parts.items():
        for i, t in enumerate(slots[s]):
            assert i * whole // a <= t < -(-(i + 1) * whole // a)
    order = sorted((t, s) for s, x in slots.items() for t in x)
    assert lag([s for _, s in order], parts) < 1


@pytest.mark.parametrize("seed", range(8))
def test_phases_by_arithmetic_are_those_of_the_walk(seed):
    rng = random.Random(seed)
    weights = {f"s{i}": rng.choice([1, 2, 3, 0.7, 12.5]) for i in range(rng.randint(1, 6))}
    blocks = {s: rng.choice([1, 5, 60, 400]) for s in weights}
    got = {}
    for p in mixing.phases(blocks, weights):
        for s, first in p.first.items():
            for i in range(first, p.end[s]):
                n = len(p.offsets[s])
                got[p.start + (i - first) // n * p.period + p.offsets[s][(i - first) % n]] = (s, i)
    assert got == dict(enumerate(mixing.timetable(blocks, weights)))
    assert mixing.phases(blocks, weights, most=0) is None


@pytest.mark.parametrize("weights", [None, {"a": 3.0, "b": 1.0}, {"a": 0.123456789012, "b": 1.7}])
@pytest.mark.parametrize("periods", [mixing.PERIODS, 0])
def test_mix_keeps_all_rows_in_the_places_of_a_plain_simulation(spark, weights, periods):
    rows = [(i, "abcd"[min(3, i % 7 % 4)] if i % 5 else "a") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string")
    got = mixing.mix(docs, weights, block_docs=4, bucket_rows=100, periods=periods).collect()
    assert sorted(r.doc_id for r in got) == list(range(1500))
    totals = {s: sum(x == s for _, x in rows) for s in "abcd"}
    target = {s: round(1000 * (n / max(totals.values())) ** 0.5) for s, n in totals.items()} if weights is None else {s: weights.get(s, min(weights.values())) for s in totals}
    want, done, t = {}, dict.fromkeys(totals, 0), 0
    while active := [s for s, n in totals.items() if 4 * done[s] < n]:
        share = {s: Fraction(str(target[s])) / sum(Fraction(str(target[x])) for x in active) for s in active}
        own, base, ended = dict.fromkeys(active, 0), t, False
        while not ended:  # the definition: of the released blocks that with the least deadline, then the least name
            ready = [(math.ceil((own[s] + 1) / share[s]), s) for s in active if math.floor(own[s] / share[s]) <= t - base]
            s = min(ready)[1]
            want[t], own[s], done[s], t = (s, done[s]), own[s] + 1, done[s] + 1, t + 1
            ended = 4 * done[s] >= totals[s]
    assert {r.mix_slot: (r.source, r.mix_block) for r in got} == want
    assert len({r.mix_position for r in got}) == 1500 and all(r.mix_position // 4 == r.mix_slot for r in got)


def lag(slots, weights):
    """The largest deviation from the target weights, in blocks, of sources by slot."""
    total, got, worst = sum(weights.values()), dict.fromkeys(weights, 0), 0.0
    for t, s in enumerate(slots, 1):
        got[s] += 1
        worst = max(worst, *(abs(w / total * t - got[x]) for x, w in weights.items()))
    return worst


def test_lag_behind_target_weights_stays_under_one_block_over_many_periods(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "concat('s', id % 20) as source")
    rows = mixing.mix(docs, block_docs=1).select("source", "mix_slot").collect()
    assert sorted(r.mix_slot for r in rows) == list(range(20_000))
    assert lag([r.source for r in sorted(rows, key=lambda r: r.mix_slot)], {f"s{k}": 1.0 for k in range(20)}) < 1
    assert lag([s for s, _ in itertools.islice(mixing.timetable({"a": 10**9, "b": 10**9, "c": 10**9}, {"a": 3, "b": 1, "c": 0.7}), 100_000)], {"a": 3, "b": 1, "c": 0.7}) < 1
    rng = random.Random(1)
    for _ in range(3):
        weights = {f"s{k}": rng.choice([1, 30, 900]) * rng.random() for k in range(12)} | {"rare": 0.3}
        plan = mixing.timetable(dict.fromkeys(weights, 10**9), weights)
        assert lag([next(plan)[0] for _ in range(20_000)], weights) < 1


def test_mix_of_many_sources_in_phases(spark):
    docs = spark.range(1500).selectExpr("id as doc_id", "concat('s', id % 400) as source")
    rows = mixing.mix(docs, block_docs=2, bucket_rows=1).collect()
    assert sorted(r.doc_id for r in rows) == list(range(1500)) and len({r.mix_position for r in rows}) == 1500
    blocks = {f"s{k}": 2 for k in range(400)}
    want = {t: x for t, x in enumerate(mixing.timetable(blocks, {f"s{k}": 1000 if k < 300 else 866 for k in range(400)}))}
    assert {r.mix_slot: (r.source, r.mix_block) for r in rows} == want and all(r.mix_position // 2 == r.mix_slot for r in rows)


def test_mix_of_odd_rows(spark):
    docs = odd_docs(spark, "mix_slot phase j _h")
    out = mixing.mix(docs)
    assert out.count() == docs.count() and out.select("mix_position").distinct().count() == docs.count() and out.columns.count("mix_slot") == 1
    assert mixing.mix(empty_docs(spark)).count() == 0
    assert mixing.mix(spark.range(600).selectExpr("id as doc_id", "cast(id as string) as source")).select("mix_slot").distinct().count() == 600
    with pytest.raises(ValueError):
        mixing.mix(docs, {"a": 0.0})


DATA = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not DATA.exists(), reason="needs the test tables")
def test_pipeline_and_queries(spark):
    out = corpus_pipeline.run(spark, str(DATA)).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(str(DATA / "documents.parquet")).collect()}
    assert 0.5 * len(docs) < len(out) < len(docs) and len({r.doc_id for r in out}) == len(out)
    assert all(r.text == docs[r.doc_id].text or len(r.text) < len(docs[r.doc_id].text) for r in out)
    names = entry.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}


def test_stages_take_odd_and_empty_tables(spark, tmp_path):
    spark.createDataFrame([(1, "some words of an item that nobody has in a text at all")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for docs in (odd_docs(spark), empty_docs(spark)):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            assert out.columns[:5] == corpus_pipeline.COLUMNS
            out.count()


@pytest.mark.skipif(not DATA.exists(), reason="needs the test tables")
@pytest.mark.parametrize("name", ["op2_url_rules", "op3_warc_revisits", "op6_decontamination", "op7_quality_rules", "op12_fill_in_middle", "op13_collocations"])
def test_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got, want = entry.queries()[name](spark, str(DATA)).toArrow(), con.execute(entry.oracle_sql()[name]).to_arrow_table()
    rows = lambda t: sorted(repr(tuple(r[n] for n in sorted(t.column_names))) for r in t.to_pylist())
    assert rows(got) == rows(want)
