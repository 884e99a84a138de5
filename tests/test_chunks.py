"""Chunks that tasks read for the keys they hold, GPU profiles of the stage that predicts, and predictors named by a configuration file."""

import json

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.resource import ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import functions as F

from atomweft.cli import run_command
from atomweft.config import build_config, json_safe, layered
from atomweft.errors import ConfigError, MissingDependencyError
from atomweft.operators.predict import device_profile, load_factory, predict_frames, prediction_tasks
from atomweft.operators.store import CacheStore
from atomweft.sources.chunks import chunk_files, file_batches, file_columns, matching_groups
from tests.helpers import Ramp, hco, record, write


def test_row_groups_without_a_wanted_key_are_not_read(tmp_path):
    path = str(tmp_path / "c.parquet")
    keys = [f"{i:04d}" for i in range(100) for _ in range(3)]
    pq.write_table(pa.table({"frame_cache_key": keys, "v": range(300)}), path, row_group_size=30)
    with pq.ParquetFile(path) as file:
        assert matching_groups(file, ["0000", "0057", "2"]) == [0, 5] and matching_groups(file, ["00595", "a"]) == [] and matching_groups(file, []) == []
    got = pa.Table.from_batches(file_batches(path, "parquet", ["0000", "0057", "2"]))
    assert got["v"].to_pylist() == [0, 1, 2, 171, 172, 173]


def test_files_of_a_chunk(tmp_path):
    (tmp_path / "c").mkdir()
    for name in ("part-1", "part-0", "_SUCCESS", ".part-0.crc"):
        (tmp_path / "c" / name).write_text("frame_cache_key,v\nk,1\n")
    assert [p[-6:] for p in chunk_files(str(tmp_path / "c"))] == ["part-0", "part-1"] and chunk_files(str(tmp_path / "none")) == []
    one = chunk_files(str(tmp_path / "c" / "part-0"))
    assert len(one) == 1 and file_columns(one[0], "csv") == [["frame_cache_key", "string"], ["v", "string"]]
    assert file_columns(one[0], "parquet") == [] and file_columns(str(tmp_path / "none"), "csv") == []


def test_a_lookup_opens_few_chunks_and_the_driver_lists_none(spark, tmp_path):
    store = CacheStore(spark, tmp_path / "c")
    rows = spark.range(1000).select(F.format_string("%05d", F.col("id") * 7919 % 1000).alias("frame_cache_key"), F.lit(0).cast("bigint").alias("atom_i"), F.col("id").cast("double").alias("cs_iso"), F.col("id").alias("t"))
    assert store.store(rows, chunk_size=10, order=["t"]) == 100
    keys = rows.where("t >= 500 AND t < 510").select("frame_cache_key")
    assert store.wanted(keys).select("chunk_path").distinct().count() == 1
    found = store.lookup(keys)
    assert sorted(r.t for r in found.collect()) == list(range(500, 510)) and found.inputFiles() == []
    assert store.lookup(rows.where("t % 100 = 0").select("frame_cache_key")).agg(F.count_distinct("t"), F.count(F.lit(1))).first()[:] == (10, 10)


def test_csv_chunks_of_odd_cells(spark, tmp_path):
    """Empty cells, infinities, text where a number belongs, line feeds in quotes, a cut line, other columns, and no rows at all."""
    store = CacheStore(spark, tmp_path / "c", "csv")
    a, b, empty = tmp_path / "a.csv", tmp_path / "b.csv", tmp_path / "e.csv"
    a.write_text('frame_cache_key,atom_i,cs_iso,note\nk,0,inf,"x\ny"\nk,1,,z\nk,2,bad,\nother,0,1.0,n\nk,3\n')
    b.write_text("cs_xx,frame_cache_key,atom_i\n-inf,m,0\n")
    empty.write_text("")
    (store.index_dir / "index_x.jsonl").write_text("\n".join(record(k, p, seq=i) for i, (k, p) in enumerate({"k": a, "m": b, "e": empty}.items())))
    got = store.lookup(spark.createDataFrame([(k,) for k in ("k", "m", "e")] + [(None,)], "frame_cache_key string"))
    assert dict(got.dtypes)["cs_iso"] == dict(got.dtypes)["cs_xx"] == "double" and dict(got.dtypes)["atom_i"] == "bigint"
    rows = sorted((r.frame_cache_key, r.atom_i, r.cs_iso, r.cs_xx, r.note) for r in got.collect())
    assert rows == [("k", 0, float("inf"), None, "x\ny"), ("k", 1, None, None, "z"), ("k", 2, None, None, None), ("m", 0, None, float("-inf"), None)]


def test_rows_of_a_key_keep_the_order_of_its_chunk(spark, tmp_path):
    store = CacheStore(spark, tmp_path / "c")
    chunk = tmp_path / "chunk"
    chunk.mkdir()
    for n, values in enumerate(([1.0, 2.0], [3.0])):
        pd.DataFrame({"frame_cache_key": "k", "atom_i": 0, "cs_iso": values}).to_parquet(chunk / f"part-{n}.parquet")
    (store.index_dir / "index_x.jsonl").write_text(record("k", chunk, form="parquet"))
    got = store.lookup(spark.createDataFrame([("k",), ("k",)], "frame_cache_key string"))
    assert [r.cs_iso for r in got.orderBy("_row").collect()] == [1.0, 2.0, 3.0]


def test_gpu_tasks(spark, monkeypatch):
    assert device_profile(spark, "cuda", 1) is None and device_profile(spark, "cpu", 4) is None  # a local session has no profiles
    shared = ResourceProfileBuilder().require(TaskResourceRequests().cpus(1).resource("gpu", 0.5)).build
    assert [prediction_tasks(1001, 100, d, 2, p) for d, p in (("cpu", None), ("cuda", None), ("cuda", shared))] == [11, 2, 11]

    class Cluster:
        sparkContext = type("C", (), {"master": "spark://host:7077"})
        conf = {"spark.executor.resource.gpu.amount": "2"}

    built = device_profile(Cluster, "cuda", 4)
    assert {k: r.amount for k, r in built.taskResources.items()} == {"cpus": 1.0, "gpu": 0.25} and built.executorResources == {}
    Cluster.conf = {}
    assert device_profile(Cluster, "cuda", 4) is None
    frames = spark.createDataFrame([], "frame_cache_key string, numbers array<int>, element array<string>, positions array<struct<x: double, y: double, z: double>>, cell array<double>, pbc array<int>")
    plan = lambda profile: predict_frames(frames, Ramp, device="cuda", committee=False, property_mode="iso", chunk_size=5, tasks=2, profile=profile)._jdf.queryExecution().logical().profile()
    assert plan(None).isEmpty() and plan(shared).get().taskResources().contains("gpu")


def test_a_configuration_file_names_the_predictor(spark, tmp_path):
    source, options = write(tmp_path / "a.xyz", hco(), hco(2.0)), tmp_path / "c.json"
    options.write_text(json.dumps({"predictor": "tests.helpers:Ramp", "device": "cpu", "format": "csv"}))
    said = run_command(["predict", source, "--out", str(tmp_path / "o"), "--config", str(options)], spark)
    assert pd.read_csv(said["output"]).cs_iso.tolist() == [1.0, 2.0, 3.0] * 2
    assert json.loads((tmp_path / "o" / "run.json").read_text())["config"]["predictor"] == "tests.helpers:Ramp"
    assert build_config(tmp_path, {"predictor": "a:b"}, options).predictor == "a:b"
    with pytest.raises(MissingDependencyError):
        load_factory("no_such_module_at_all:f")
    for bad in ("json:no_such_name", "json", ":"):
        with pytest.raises(ConfigError):
            load_factory(bad)


def test_layers_and_safe_values(tmp_path):
    assert layered({"a": None, "b": 0}, {"a": 1, "b": 2, "c": None}).get("a") == 1 and layered({"b": 0}, {"b": 2})["b"] == 0 and layered({"c": None}).get("c", 7) == 7
    assert json_safe({1: (tmp_path, None), "x": {"y": (1, 2.5)}}) == {"1": [str(tmp_path), None], "x": {"y": [1, 2.5]}}
