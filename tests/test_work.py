"""Written intermediate tables, and packing over all rows against the same packing done row by row."""

import json
import random

import atomweft.operators.store
import atomweft.run
import numpy as np
import pytest
from atomweft.config import PredictConfig
from atomweft.functions.digest import structure_digest, structure_id
from atomweft.operators.packing import pack_all
from atomweft.operators.store import CacheStore, compact_index, index_files, log_parts, snapshot_index
from atomweft.provenance import write_record
from atomweft.run import run_predict
from atomweft.work import Workspace
from pyspark.sql import functions as F

from .helpers import Ramp, hco, write


def greedy(sizes, limit_rows, limit_bytes):
    out, no, n, held = [], 0, 0, 0
    for b in sizes:
        if n >= limit_rows or (n and held + b > limit_bytes):
            no, n, held = no + 1, 0, 0
        n, held = n + 1, held + b
        out.append(no)
    return out


@pytest.mark.parametrize(("n", "limit_rows", "limit_bytes", "block_rows", "most"), [(0, 3, 10, None, 5), (1, 3, 10, None, 50), (7, 10, 100, None, 30), (500, 7, 100, 7, 40), (500, 7, 100, 50, 40), (503, 20, 1 << 30, 20, 40), (400, 9, 5, 13, 40), (300, 1, 100, 1, 9)])
def test_packing_side_by_side_is_the_greedy_one(spark, tmp_path, n, limit_rows, limit_bytes, block_rows, most):
    draw = random.Random(n + limit_rows)
    sizes = [draw.choice([0, 1, most, draw.randrange(most + 1)]) for _ in range(n)]
    rows = [(f"{i:04d}", b, None) for i, b in enumerate(sizes)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "key string, bytes bigint, block string")
    with Workspace(spark, tmp_path) as work:
        got = pack_all(df.withColumnRenamed("block", "extra"), ["key"], limit_rows, limit_bytes, work, block_rows).orderBy("key").collect()
    assert [r.chunk_no for r in got] == greedy(sizes, limit_rows, limit_bytes)
    assert [r.place for r in got] == list(range(n))


def test_tables_are_kept_observed_and_removed(spark, tmp_path):
    df = spark.range(10).withColumn("at", F.monotonically_increasing_id())
    shared = spark.conf.get("spark.checkpoint.dir", None)
    with Workspace(spark, tmp_path) as work:
        table, seen = work.keep(df, n=F.count(F.lit(1)), top=F.max("id"))
        assert seen == {"n": 10, "top": 9} and table.schema["at"].dataType == df.schema["at"].dataType
        assert "Range" not in table._jdf.queryExecution().toString() and table.count() == 10
        empty, seen = work.keep(spark.createDataFrame([], "a int"), n=F.count(F.lit(1)))
        assert not seen["n"] and empty.columns == ["a"] and empty.count() == 0
        empty, seen = work.keep(df.where("id < 0"), n=F.count(F.lit(1)))
        assert not seen["n"] and empty.count() == 0
    assert not list(tmp_path.glob(".work-*")) or shared


def test_the_store_packs_in_the_order_given(spark, tmp_path):
    """Chunks hold frames that follow each other in the given order, whatever their keys; equal places are ordered by key."""
    rows = spark.createDataFrame([(f"k{(i * 7) % 10}", a, 1.0, i // 2) for i in range(10) for a in range(2)], "frame_cache_key string, atom_i bigint, cs_iso double, frame int")
    store = CacheStore(spark, tmp_path / "c")
    assert store.store(rows, chunk_size=4, order=["frame"]) == 3
    found = sorted((r.line_no, r.cache_key, r.chunk_path) for r in _lines(spark, store))
    by_frame = [k for i in range(5) for k in sorted((f"k{(14 * i) % 10}", f"k{(14 * i + 7) % 10}"))]
    assert [k for _, k, _ in found] == by_frame
    assert [c.rpartition("=")[2] for _, _, c in found] == ["000000000"] * 4 + ["000000001"] * 4 + ["000000002"] * 2
    assert store.lookup(rows.select("frame_cache_key")).count() == 20
    assert not list((tmp_path / "c").glob(".work-*"))


def _lines(spark, store):
    from atomweft.operators.store import index_files
    from atomweft.sources.index_log import read_index

    return read_index(spark, index_files(store.index_dir)).select(F.col("seq").alias("line_no"), "cache_key", "chunk_path").collect()


def _index_line(key, path, at, form="parquet", seq=1):
    return json.dumps({"cache_key": key, "chunk_path": path, "output_format": form, "seq": seq, "writer_id": "w", "written_at_utc": f"2024-01-{at:02d}T00:00:00Z"}) + "\n"


def test_a_snapshot_and_the_files_after_it_give_the_whole_manifest(spark, tmp_path):
    index = tmp_path / "index"
    found = lambda: {r.cache_key: r.chunk_path for r in CacheStore(spark, tmp_path).manifest().collect()}
    assert found() == {} and snapshot_index(spark, tmp_path).is_dir() and found() == {}
    (index / "index_a.jsonl").write_text(_index_line("k", "1", 1) + _index_line("k", "2", 2, "csv") + _index_line("m", "3", 1) + "{broken")
    first = snapshot_index(spark, tmp_path)
    assert log_parts(index)[:2] == (first, []) and found() == {"k": "1", "m": "3"}
    (index / "index_b.jsonl").write_text(_index_line("k", "4", 3))
    assert log_parts(index)[1] == [str(index / "index_b.jsonl")] and found() == {"k": "4", "m": "3"}
    with (index / "index_a.jsonl").open("a") as f:  # a line that was being written, and one more
        f.write("\n" + _index_line("m", "5", 4))
    assert log_parts(index)[1] == index_files(index) and found() == {"k": "4", "m": "5"}
    second, third = snapshot_index(spark, tmp_path), snapshot_index(spark, tmp_path)
    assert log_parts(index)[:2] == (third, []) and found() == {"k": "4", "m": "5"} and second.is_dir() and not first.exists()
    (third / "files.json").write_text("{")  # one that cannot be read is passed over
    assert log_parts(index)[0] == second and found() == {"k": "4", "m": "5"}
    compact_index(spark, tmp_path, remove_source_indexes=True)  # what it was made of is gone
    assert log_parts(index)[0] is None and found() == {"k": "4", "m": "5"}


def test_a_store_renews_its_snapshot(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(atomweft.operators.store, "SNAPSHOT_BYTES", 1)
    store = CacheStore(spark, tmp_path / "c")
    rows = lambda n: spark.range(n).select(F.col("id").cast("string").alias("frame_cache_key"), F.lit(0).cast("bigint").alias("atom_i"), F.col("id").cast("double").alias("cs_iso"))
    store.store(rows(9))
    assert log_parts(store.index_dir)[1] == []
    store.store(rows(1))  # less than half of what the snapshot covers
    assert len(log_parts(store.index_dir)[1]) == 1
    assert store.lookup(rows(20).select("frame_cache_key")).count() == 9


def test_the_digest_column_is_that_of_one_structure(spark):
    """Signs of zero, the least and greatest doubles, no atoms, nulls and NaN; null arrays and null integers give null."""
    odd = [0.0, -0.0, 1.5, -1.1, 5e-324, -2.2250738585072014e-308, 1.7976931348623157e308, 1e-7, 123456.789]
    cell, pbc = [float(i) / 3 for i in range(9)], [1, 0, 1]
    rows = [([1, 118, 6], odd, cell, pbc), ([], [], [0.0] * 9, [0, 0, 0]), ([-1, 2**31 - 1, 256], odd[::-1], odd, [255, 1, 0]), ([1], [None, float("nan"), 0.0], cell, pbc)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, numbers array<int>, positions array<double>, cell array<double>, pbc array<int>")
    got = [r.s for r in df.select("i", structure_id("numbers", "positions", "cell", "pbc").alias("s")).orderBy("i").collect()]
    assert got == [structure_digest(n, np.array(p, "f8"), c, b) for n, p, c, b in rows]
    assert df.select(structure_id(F.array(F.lit(None).cast("int")), "positions", "cell", "pbc").alias("s")).distinct().collect() == [(None,)]
    column = df.select(structure_id(F.lit(None).cast("array<int>"), "positions", "cell", "pbc").alias("s"))
    assert {r.s for r in column.collect()} == {None} and "ArrowEvalPython" not in column._jdf.queryExecution().toString()


def test_a_large_run_has_all_keys_in_its_record(spark, tmp_path, monkeypatch):
    """The same text as if the driver held the keys, and a run beyond KEYS_IN_RECORD has the record of one below it."""
    record = {"a": 1, "z": [2], "cache_keys": sorted(f"{i % 40:02x}" for i in range(50))}
    keys = spark.createDataFrame([(k,) for k in reversed(record["cache_keys"])], "k string").repartition(5)
    write_record(tmp_path / "small.json", record)
    write_record(tmp_path / "large.json", record, keys)
    assert (tmp_path / "large.json").read_text() == (tmp_path / "small.json").read_text()
    source, found = write(tmp_path / "a.xyz", hco(), hco(2.0), hco()), []
    for name, held in (("o1", 100), ("o2", 1)):
        monkeypatch.setattr(atomweft.run, "KEYS_IN_RECORD", held)
        done = run_predict(spark, [source], PredictConfig(tmp_path / name, device="cpu", output_format="parquet"), Ramp)
        found.append(json.loads((tmp_path / name / "run.json").read_text())["cache_keys"])
    assert done.cache_keys == [] and found[0] == found[1] == sorted(found[0]) and len(found[0]) == 3
    assert {p.name for p in (tmp_path / "o2").iterdir()} == {"results.parquet", "run.json"}
