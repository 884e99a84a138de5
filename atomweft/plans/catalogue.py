"""Registered queries and the SQL they are held against. Each applies an operator of the engine to whole tables in adapter views."""

from __future__ import annotations

import json
from collections.abc import Callable
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from atomweft.cli import run_command
from atomweft.config import PredictConfig
from atomweft.functions import columns as C
from atomweft.functions.digest import structure_id
from atomweft.operators import average, cache
from atomweft.operators.explode import explode_atoms, explode_predictions
from atomweft.operators.packing import pack_all
from atomweft.operators.predict import FramePrediction, ModelPredictor, predict_frames
from atomweft.operators.store import CacheStore, compact_index, index_files, log_parts, snapshot_index
from atomweft.operators.validate import failure, validate_frames
from atomweft.plans import views as V
from atomweft.plans.views import RESULTS_SQL, table
from atomweft.run import run_predict
from atomweft.schema import TENSOR_COLUMNS, fill_missing, required_columns
from atomweft.sinks import magres_blocks, write_lines, write_magres, write_table, write_text
from atomweft.sources.index_log import latest, rank, read_index, read_lines
from atomweft.sources.structures import load_structures
from atomweft.sources.tables import file_digests, read_results
from atomweft.work import Workspace

BLOCK_LINES = 53  # of 21 atoms and a cell, with the blank line after it
PACK_GROUP = 500  # frames that one writer packs
Query = Callable[[SparkSession, str], DataFrame]


class Norms:
    """A predictor that needs no model: an atom's value is its distance from the origin."""

    name = "norms"

    def predict(self, frames, *, device="auto", committee=False, property="iso"):
        return [FramePrediction(np.sqrt((f.positions**2).sum(axis=1))) for f in frames]


def avg_unweighted(spark, sf_dir):
    return average.grouped_mean(V.results(spark, sf_dir).withColumn("_weight", F.lit(1.0)), ["cs_iso", "cs_xx"])


def _weights(rows: DataFrame, weight) -> DataFrame:
    return rows.select(C.frame_key(F.col("source_file"), F.col("frame")).alias("frame_key"), "frame").distinct().select("frame_key", weight.cast("double").alias("weight"))


def avg_weighted(spark, sf_dir):
    rows = V.results(spark, sf_dir)
    return average.grouped_mean(average.with_weights(rows, _weights(rows, 1 + F.col("frame") % 7)), ["cs_iso", "cs_xx"])


def avg_nonfinite(spark, sf_dir):
    value = F.when(F.col("frame") % 5 == 0, F.lit(float("nan"))).when(F.col("frame") % 5 == 1, F.lit(float("inf"))).when((F.col("frame") % 5 == 2) | (F.col("atom_i") == 0), None).otherwise(F.col("cs_iso"))
    rows = V.results(spark, sf_dir).withColumns({"cs_iso": value, "x": F.lit(0.0), "y": F.lit(0.0), "_weight": F.lit(1.0)})
    return average.grouped_mean(rows, ["cs_iso"]).select("atom_i", "element", "cs_iso")


def avg_zero_weight(spark, sf_dir):
    rows = V.results(spark, sf_dir)
    return average.grouped_mean(average.with_weights(rows, _weights(rows, F.col("frame") % 3 - 1)), ["cs_iso", "cs_xx"])


def weights_missing(spark, sf_dir):
    frames = table(spark, sf_dir, "documents").select(F.lit("d").alias("source_file"), F.col("doc_id").alias("frame"))
    labels = table(spark, sf_dir, "labels").select(F.concat(F.lit("d#"), F.col("doc_id").cast("string")).alias("frame_key"), (F.col("quality") + 1.0).alias("weight"))
    return average.uncovered(average.with_weights(frames, labels)).select("frame")


def manifest_latest(spark, sf_dir):
    return cache.manifest(V.index_records(spark, sf_dir), "click").select("cache_key", "output_format", "seq", "value")


def index_compact(spark, sf_dir):
    return cache.compacted(V.index_records(spark, sf_dir)).select("cache_key", "output_format", "seq", "value")


def index_parse(spark, sf_dir):
    """Index lines, some of them broken, written to files and read back."""
    broken = F.when(F.col("event_id") % 7 == 0, F.lit("{broken")).when(F.col("event_id") % 7 == 1, F.lit("[]"))
    fields = {"cache_key": F.col("user_id").cast("string"), "chunk_path": F.col("event_type"), "output_format": F.lit("csv"), "seq": F.when(F.col("event_id") % 7 != 2, F.col("event_id")), "writer_id": F.lit("w"), "written_at_utc": F.when(F.col("event_id") % 7 == 3, F.lit("yesterday")).otherwise(C.format_utc(F.col("ts").cast("timestamp")))}
    path = V.folder(spark, "index")
    table(spark, sf_dir, "events").select(F.coalesce(broken, F.to_json(F.struct(*(c.alias(n) for n, c in fields.items())))).alias("value")).write.text(path)
    return read_index(spark, [path]).select("cache_key", "chunk_path", "seq", "written_at_utc")


def _write_index(spark, sf_dir, path: Path, name: str, chosen) -> None:
    """The chosen index records as lines of an index file, a seventh of them broken."""
    broken = F.when(F.col("seq") % 7 == 0, F.lit("{broken"))
    line = C.index_payload("cache_key", "chunk_path", "output_format", "seq", "writer_id", "written_at_utc")
    rows = V.index_records(spark, sf_dir).withColumns({"cache_key": F.col("cache_key").cast("string"), "chunk_path": F.col("value").cast("string"), "written_at_utc": C.format_utc(F.col("written_at").cast("timestamp"))})
    write_lines(rows.where(chosen).orderBy("seq").select(F.coalesce(broken, line).alias("value")), path / f"index/index_{name}.jsonl")


def index_snapshot(spark, sf_dir):
    """The manifest from a snapshot of the index log and the file that came after it, with the number of files that were read again."""
    path = Path(V.folder(spark, "cache"))
    late = F.col("seq") % 5 == 0
    _write_index(spark, sf_dir, path, "a", ~late & (F.col("writer_id") == "0"))
    _write_index(spark, sf_dir, path, "b", ~late & (F.col("writer_id") != "0"))
    snapshot_index(spark, path)
    _write_index(spark, sf_dir, path, "c", late)
    store = CacheStore(spark, path, "click")
    return store.manifest().select("cache_key", "output_format", "seq", "writer_id", F.lit(len(log_parts(store.index_dir)[1])).alias("replayed"))


def index_compacted(spark, sf_dir):
    """Index files of three writers, some of their lines broken, compacted into one file that is read back."""
    path = Path(V.folder(spark, "cache"))
    for writer in "012":
        _write_index(spark, sf_dir, path, writer, F.col("writer_id") == writer)
    done = compact_index(spark, path, remove_source_indexes=True)
    found = read_index(spark, [done["compacted_index_file"]])
    return found.select("cache_key", "output_format", "seq", "writer_id", "line_no", F.lit(done["scanned_records"]).cast("bigint").alias("scanned"), F.lit(len(index_files(path / "index"))).alias("files"))


def index_write(spark, sf_dir):
    rows = V.index_records(spark, sf_dir).select(F.col("cache_key").cast("string").alias("cache_key"), "output_format", "seq", F.when(F.col("seq") % 2 == 0, F.lit("m")).alias("model_name"))
    return rows.select("seq", C.index_payload("cache_key", "model_name", "output_format", "seq").alias("line"))


def utc_text(spark, sf_dir):
    text = C.format_utc(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select("event_id", text.alias("text"), (F.unix_timestamp(C.parse_utc(text))).alias("seconds"))


def explode_rows(spark, sf_dir):
    frames = V.frames(spark, sf_dir).withColumn("structure_id", F.col("frame").cast("string"))
    return explode_atoms(frames).select("frame", "source_file", "atom_i", "element", "x", "y", "z")


def tensor_unpack(spark, sf_dir):
    value = F.transform("embedding", lambda x: x.cast("double"))
    return table(spark, sf_dir, "embeddings").select("vec_id", *C.unpack_tensor(value))


def committee_std(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(C.committee_std(F.col("embedding")), 5).alias("std"))


def schema_fill(spark, sf_dir):
    needed = required_columns("tensor", True)
    rows = V.results(spark, sf_dir).withColumn("structure_id", F.col("frame").cast("string"))
    return fill_missing(rows, needed).select(needed)


def cache_keys(spark, sf_dir):
    key = C.cache_key(F.col("structure_id"), "model", "1", "1", False, "iso")
    return V.contents(spark, sf_dir).select("frame_ord", key.alias("cache_key"))


def content_hash(spark, sf_dir):
    return V.contents(spark, sf_dir).select("frame_ord", "structure_id")


def structure_ids(spark, sf_dir):
    flat = F.flatten(F.transform("positions", lambda p: F.array(p.x, p.y, p.z)))
    return V.frames(spark, sf_dir).select("frame", structure_id("numbers", flat, "cell", "pbc").alias("structure_id"))


def cell_missing(spark, sf_dir):
    return V.frames(spark, sf_dir).select("frame", C.missing_cell(F.col("cell"), F.col("pbc")).alias("missing"))


def frame_slice(spark, sf_dir):
    """Frames 1:400:3 of each structure file."""
    found = load_structures(spark, [V.structure_files(spark, sf_dir)], "1:400:3")
    end = F.element_at("positions", -1)
    return found.select(_part(), "frame", F.size("element").alias("n_atoms"), F.array_join("element", "").alias("elements"), F.col("positions")[0].x.alias("x"), end.z.alias("z"), F.col("cell")[0].alias("cell"), F.col("normalized_cell_pbc").alias("missing"))


def _part():
    return F.regexp_extract("source_file", r"part=(\d+)", 1).cast("bigint").alias("part")


def frame_last(spark, sf_dir):
    """Frame -1 of each conversation: a grouped maximum needs no window."""
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.max("turn").alias("turn"), F.max_by("role", "turn").alias("role"))


def _cached(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("frame_cache_key"), (F.col("l_linenumber") - 1).alias("atom_i"), F.col("l_extendedprice").alias("cs_iso"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"), F.col("l_shipdate").alias("t"))


def _canonical(spark, sf_dir) -> DataFrame:
    return cache.canonical(_cached(spark, sf_dir), "frame_cache_key", F.struct("t", "p", "s", "cs_iso"))


def cache_canonical(spark, sf_dir):
    return _canonical(spark, sf_dir).select("frame_cache_key", "atom_i", "cs_iso", "p")


def cache_complete(spark, sf_dir):
    return cache.complete_keys(_canonical(spark, sf_dir), "frame_cache_key")


def cache_complete_turns(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("frame_cache_key"), F.col("turn").alias("atom_i"))
    return cache.complete_keys(turns, "frame_cache_key")


def cache_materialize(spark, sf_dir):
    """One stored value for each content, given to every frame that has it."""
    frames = V.contents(spark, sf_dir).select(F.col("frame_ord").alias("frame"), F.col("structure_id").alias("frame_cache_key"), F.lit(0).cast("bigint").alias("atom_i"))
    values = V.contents(spark, sf_dir).groupBy(F.col("structure_id").alias("frame_cache_key")).agg(F.min("frame_ord").alias("first")).withColumn("atom_i", F.lit(0).cast("bigint"))
    return cache.materialise(frames, values).select("frame", "first")


def cache_hit(spark, sf_dir):
    """Orders as frames of one to seven atoms that have a cached row for each atom."""
    frames = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("frame_cache_key"), F.col("o_orderkey").alias("frame_ord"), F.array_repeat(F.lit("H"), (F.col("o_custkey") % 7 + 1).cast("int")).alias("element"))
    return cache.hits(frames, _canonical(spark, sf_dir)).select("frame_ord")


def _later_and_hits(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    docs = V.contents(spark, sf_dir)
    later, earlier = docs.where("frame_ord % 2 = 1"), docs.where("frame_ord % 2 = 0")
    return later, later.join(earlier.select("structure_id").distinct(), "structure_id", "left_semi")


def cache_miss(spark, sf_dir):
    return cache.misses(*_later_and_hits(spark, sf_dir)).select("frame_ord", "structure_id")


def manifest_probe(spark, sf_dir):
    """Every customer with the latest record of its key, or none."""
    keys = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cache_key"))
    return keys.join(latest(V.index_records(spark, sf_dir), ["cache_key"], rank()), "cache_key", "left").select("cache_key", F.coalesce("seq", F.lit(-1)).alias("seq"), "output_format")


def union_align(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", "p_brand").unionByName(part.select("p_partkey", F.col("p_size").cast("double").alias("p_size")), allowMissingColumns=True)


def unsupported(spark, sf_dir):
    """Elements outside the supported set by brand; sizes stand for atomic numbers."""
    symbols = F.array(*(F.lit(s) for s in ("H", "He", "C", "Ne", "N", "Na", "O")))
    rows = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.collect_set(F.get(symbols, F.col("p_size") % 7)).alias("found"))
    return rows.select("p_brand", F.array_join(C.unsupported(F.col("found")), ", ").alias("unsupported"))


def first_failure(spark, sf_dir):
    """What is wrong with each frame, or null: frames of label 3 have no atoms, of label 5 a position that is not finite."""
    frames = V.frames(spark, sf_dir)
    positions = F.when(F.col("label") == 5, F.transform("positions", lambda p: F.struct(F.lit(float("nan")).alias("x"), p.y.alias("y"), p.z.alias("z")))).otherwise(F.col("positions"))
    frames = frames.withColumns({"positions": positions, "element": F.when(F.col("label") == 3, F.array().cast("array<string>")).when(F.col("label") == 7, F.array(F.lit("Xe"), F.lit("He"))).otherwise(F.col("element"))})
    return frames.select("frame", failure().alias("failure"))


def warn_skip(spark, sf_dir):
    """Frames with a cell by source, and those without one as the warning lists them."""
    frames = V.frames(spark, sf_dir).withColumn("normalized_cell_pbc", C.missing_cell(F.col("cell"), F.col("pbc")))
    kept, warnings, _ = validate_frames(frames, "skip")
    listed = spark.createDataFrame([(w.partition(": ")[2],) for w in warnings], "text string").select(F.explode(F.split("text", ", ")).alias("name"), F.lit(0).cast("bigint").alias("kept"))
    return kept.groupBy(F.col("source_file").alias("name")).agg(F.count(F.lit(1)).alias("kept")).unionByName(listed)


def _sizes(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / PACK_GROUP).alias("writer"), "doc_id", F.col("n_chars").alias("bytes"))


def pack_count(spark, sf_dir):
    return cache.chunk_numbers(_sizes(spark, sf_dir), "writer", ["doc_id"], 200).select("doc_id", "writer", "chunk_no")


def pack_bytes(spark, sf_dir):
    return cache.pack(_sizes(spark, sf_dir), "doc_id", "writer", 20, 30_000).select("doc_id", "writer", "chunk_no")


def pack_whole(spark, sf_dir):
    """Documents as one stream of rows packed by number and size, in blocks side by side."""
    sizes = table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.col("n_chars"), F.lit(0)).cast("bigint").alias("bytes"))
    return pack_all(sizes, ["doc_id"], 20, 30_000, Workspace(spark, V.folder(spark, "packing"))).select("doc_id", "place", "chunk_no")


def result_order(spark, sf_dir):
    """Places of rows in the one result file, written in order and read back."""
    path = write_table(V.results(spark, sf_dir), V.folder(spark, "results") + ".parquet", "parquet", ["source_file", "frame", "atom_i", "element", "x", "y", "cs_iso", "cs_xx"])
    return read_results(spark, path).select("source_file", "frame", "atom_i", "cs_iso", F.col("_metadata.row_index").alias("place"))


def results_csv(spark, sf_dir):
    """Result rows with missing and infinite values through a CSV file."""
    value = F.when(F.col("frame") % 5 == 0, F.lit(float("nan"))).when(F.col("frame") % 5 == 1, F.lit(float("inf"))).when(F.col("frame") % 5 == 2, F.lit(float("-inf"))).otherwise(F.col("cs_iso"))
    path = write_table(V.results(spark, sf_dir).withColumn("cs_iso", value), V.folder(spark, "results") + ".csv", "csv")
    return read_results(spark, path).select("source_file", "frame", "atom_i", "element", "x", "y", "cs_iso", "cs_xx")


def avg_per_atom(spark, sf_dir):
    """The average as the command line makes it, with a weight for every frame."""
    rows = V.results(spark, sf_dir)
    return average.average_per_atom(rows, _weights(rows, 1 + F.col("frame") % 7))


def cache_store(spark, sf_dir):
    """Rows stored twice with other values for some keys; a look-up of half of the keys finds the later ones."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_orderkey").cast("string").alias("frame_cache_key"), (F.col("l_linenumber") - 1).cast("bigint").alias("atom_i"), F.col("l_extendedprice").alias("cs_iso"))
    store = CacheStore(spark, V.folder(spark, "cache"))
    store.store(rows.drop("k"))
    store.store(rows.where("k % 10 = 0").withColumn("cs_iso", F.col("cs_iso") + 1).drop("k"))
    return store.lookup(rows.where("k % 2 = 0").select("frame_cache_key")).select("frame_cache_key", "atom_i", "cs_iso")


def predict_run(spark, sf_dir):
    """Two whole runs over structure files with one cache: the second finds every frame, and its result table is read back."""
    pattern, cached = V.structure_files(spark, sf_dir), Path(V.folder(spark, "cache"))
    for _ in range(2):
        done = run_predict(spark, [pattern], PredictConfig(Path(V.folder(spark, "run")), device="cpu", cache_dir=cached, output_format="parquet"), lambda device: Norms(), "norms", "1")
    return read_results(spark, done.output_path).select(_part(), "frame", "atom_i", "element", F.round("cs_iso", 5).alias("cs_iso"), F.lit(done.cache_misses).cast("bigint").alias("misses"))


def run_figures(spark, sf_dir):
    """Frames, atoms, hits and misses of two runs with one cache: every second frame first, then all, of which the first run's are found."""
    pattern, cached, figures = V.structure_files(spark, sf_dir), Path(V.folder(spark, "cache")), []
    for run, chosen in enumerate(("::2", ":")):
        done = run_predict(spark, [pattern], PredictConfig(Path(V.folder(spark, "run")), device="cpu", frames=chosen, cache_dir=cached, output_format="parquet"), lambda device: Norms(), "norms", "1")
        figures.append((run, done.frame_count, done.atom_count, done.cache_hits, done.cache_misses))
    return spark.createDataFrame(figures, "run int, frames bigint, atoms bigint, hits bigint, misses bigint")


def distinct_keys(spark, sf_dir):
    return V.index_records(spark, sf_dir).select("cache_key", "output_format").distinct()


def text_block(spark, sf_dir):
    lines = F.array_sort(F.collect_list(F.struct("turn", F.concat_ws(" ", "role", "text").alias("line"))))
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(lines, lambda x: x.line), "\n").alias("block"))


def counts(spark, sf_dir):
    return table(spark, sf_dir, "conversations").groupBy("role").agg(F.count_distinct("conv_id").alias("frames"), F.count(F.lit(1)).alias("atoms"))


def frame_keys(spark, sf_dir):
    return V.results(spark, sf_dir).select(C.frame_key(F.col("source_file"), F.col("frame")).alias("frame_key")).distinct()


def number_coercion(spark, sf_dir):
    """Text that is not a number becomes null, and so does what is not finite."""
    text = F.when(F.col("event_id") % 4 == 0, F.lit("bad")).when(F.col("event_id") % 4 == 1, F.lit("NaN")).when(F.col("event_id") % 4 == 2, F.lit("Infinity")).otherwise(F.col("event_id").cast("string"))
    return table(spark, sf_dir, "events").select("event_id", C.only_finite(C.number(text)).alias("number"))


def predict_norms(spark, sf_dir):
    """Predictions of all frames by a deterministic predictor, one for each content, joined to the atoms."""
    flat = F.flatten(F.transform("positions", lambda p: F.array(p.x, p.y, p.z)))
    frames = V.frames(spark, sf_dir).withColumn("structure_id", structure_id("numbers", flat, "cell", "pbc"))
    frames = frames.withColumn("frame_cache_key", C.cache_key(F.col("structure_id"), "norms", "1", "1", False, "iso"))
    made = predict_frames(frames.dropDuplicates(["frame_cache_key"]), lambda device: Norms(), device="cpu", committee=False, property_mode="iso", chunk_size=200, tasks=8)
    rows = cache.materialise(explode_atoms(frames, "frame_cache_key"), explode_predictions(made, False, False))
    return rows.select("frame", "atom_i", "element", F.round("cs_iso", 5).alias("cs_iso"))


def magres_text(spark, sf_dir):
    """Magres blocks of all frames."""
    frames = V.frames(spark, sf_dir).withColumn("structure_id", F.col("frame").cast("string"))
    return magres_blocks(explode_atoms(frames).withColumn("cs_iso", F.col("x")), frames)


def magres_files(spark, sf_dir):
    """Blocks of all frames through the one file, with their places in it, and through a file for each frame, with its name."""
    frames = V.frames(spark, sf_dir).withColumn("structure_id", F.col("frame").cast("string"))
    results, out = explode_atoms(frames).withColumn("cs_iso", F.col("x")), V.folder(spark, "magres")
    (one,), (folder,) = write_magres(results, out, "single", frames), write_magres(results, out, "per-frame", frames)
    block = F.floor((F.col("line_no") - 1) / BLOCK_LINES)
    lines = read_lines(spark, [str(one)]).withColumn("place", block).groupBy("place").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("x"))
    text = F.concat(F.array_join(F.slice("x.line", 1, BLOCK_LINES - 1), "\n"), F.lit("\n"))
    each = spark.read.text(str(folder), wholetext=True).select(F.lit("per-frame").alias("mode"), F.lit(None).cast("bigint").alias("place"), F.col("_metadata.file_name").alias("name"), F.col("value").alias("text"))
    return lines.select(F.lit("single").alias("mode"), "place", F.lit(None).cast("string").alias("name"), text.alias("text")).unionAll(each)


class Ramps:
    """A model with the method names that the adapter falls back to: values are x, those of two members lie 1 beside them, tensors are multiples of x."""

    def __init__(self, device="cpu"):
        self.device = device

    def get_cs(self, f):
        return f.positions[:, 0]

    def get_cs_committee(self, f):
        return f.positions[:, :1] + np.array([[-1.0, 1.0]])

    def get_tensor(self, f):
        return f.positions[:, 0].reshape(-1, 1, 1) * np.arange(1.0, 10).reshape(1, 3, 3)


def ramp_predictor(device):
    return ModelPredictor(Ramps, device)


def predict_command(spark, sf_dir):
    """The command with a configuration file that names the predictor: every second frame, those without a cell skipped, committee and tensors; its table
    and what its record says of it."""
    out = Path(V.folder(spark, "command"))
    options = {"frames": "::2", "property": "both", "on_warning": "skip", "strict": "no", "committee": "yes", "device": "cpu", "workers": 2, "predictor": f"{__name__}:ramp_predictor"}
    write_text(out / "options.json", json.dumps(options))
    said = run_command(["predict", V.structure_files(spark, sf_dir), "--out", str(out / "run"), "--config", str(out / "options.json"), "--format", "parquet", "--workers", "1"], spark)
    record = json.loads((out / "run/run.json").read_text())
    told = {"status": record["status"], "workers": record["runtime"]["workers"], "frames": said["frames"], "keys": len(record["cache_keys"]), "warnings": len(said["warnings"]), "inputs": len(record["input_files"])}
    values = (F.floor(F.col(c) * 100_000).alias(c) for c in ("cs_iso", "cs_xx", "cs_yz"))
    told = (F.lit(v).cast("string" if isinstance(v, str) else "bigint").alias(k) for k, v in told.items())
    return read_results(spark, said["output"]).select(_part(), "frame", "atom_i", *values, F.round("cs_iso_uncertainty", 5).alias("cs_iso_uncertainty"), "cs_zz_uncertainty", *told)


def average_command(spark, sf_dir):
    """The command over a result table with a file of weights, into a CSV file that is read back."""
    out = Path(V.folder(spark, "command"))
    rows = explode_atoms(V.frames(spark, sf_dir).withColumn("structure_id", F.lit("s"))).withColumns({"cs_iso": F.floor(F.col("x") * 1000).cast("double"), **{a: F.lit(0.0) for a in "xyz"}})
    write_table(rows, out / "results.parquet", "parquet", ["source_file", "frame", "atom_i"])
    weight = V.frames(spark, sf_dir).select(F.concat(F.lit('"'), C.frame_key(F.col("source_file"), F.col("frame")), F.lit('": '), F.col("label") + 1, F.lit(",")).alias("value"))
    write_lines(weight, out / "weights.json", cut=2, head=b"{", tail=b"}")
    said = run_command(["average", str(out / "results.parquet"), "--weights", str(out / "weights.json"), "--out", str(out / "means.csv")], spark)
    return read_results(spark, said["output"]).select("atom_i", "element", "x", "z", "cs_iso", F.lit(said["rows"]).cast("bigint").alias("rows"), F.lit(said["weights_applied"]).alias("weighted"))


def compact_command(spark, sf_dir):
    """The command over index files of two writers, which stay: the manifest after it, with the number of index files."""
    path = Path(V.folder(spark, "cache"))
    for writer in "12":
        _write_index(spark, sf_dir, path, writer, F.col("writer_id") == writer)
    said = run_command(["cache-compact", str(path)], spark)
    store = CacheStore(spark, path, "click")
    return store.manifest().select("cache_key", "output_format", "seq", F.lit(said["kept_records"]).cast("bigint").alias("kept"), F.lit(said["removed_source_index_files"]).alias("removed"), F.lit(len(index_files(store.index_dir))).alias("files"))


def input_digests(spark, sf_dir):
    """Digests of files of documents, as a run record has them."""
    text = F.array_sort(F.collect_list(F.struct("doc_id", F.coalesce("text", F.lit("")).alias("text"))))
    files = table(spark, sf_dir, "documents").groupBy(F.floor(F.col("doc_id") / V.FILE_FRAMES).alias("part")).agg(F.array_join(F.transform(text, lambda x: x.text), "\n").alias("value"))
    path = V.folder(spark, "texts")
    files.write.partitionBy("part").text(path)
    found = file_digests(spark, [str(p) for p in Path(path).glob("part=*/part-*")])
    rows = spark.createDataFrame([(r["path"], r["sha256"]) for r in found], "source_file string, sha256 string")
    return rows.select(_part(), "sha256")


def frame_tail(spark, sf_dir):
    """The last five frames of each structure file, the last one first."""
    return load_structures(spark, [V.structure_files(spark, sf_dir)], ":-6:-1").select(_part(), "frame", F.element_at("positions", 1).x.alias("x"))


def magres_tensors(spark, sf_dir):
    """Magres blocks of all frames with whole tensors, without cells."""
    frames = V.frames(spark, sf_dir).withColumn("structure_id", F.col("frame").cast("string"))
    tensors = {c: F.col("x") * (k + 1) for k, c in enumerate(TENSOR_COLUMNS)}
    return magres_blocks(explode_atoms(frames).withColumn("cs_iso", F.col("x")).withColumns(tensors)).select("frame", "text")


def _orders_as_frames(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_orderkey").cast("string").alias("frame_cache_key"), F.col("l_shipdate").alias("t"), (F.col("l_linenumber") - 1).cast("bigint").alias("atom_i"), F.col("l_extendedprice").alias("cs_iso"))


def lookup_chunks(spark, sf_dir):
    """Frames stored in order of their first dates, those of one quarter looked up: their rows with the chunk that each is in."""
    rows = _orders_as_frames(spark, sf_dir)
    store = CacheStore(spark, V.folder(spark, "cache"))
    store.store(rows.drop("k"), order=["t"])
    first = rows.groupBy("frame_cache_key").agg(F.min("t").alias("t"))
    keys = first.where("t >= '1996-01-01' AND t < '1996-04-01'").select("frame_cache_key")
    chunk = F.regexp_extract("chunk_path", r"chunk=(\d+)$", 1).cast("bigint").alias("chunk")
    return store.lookup(keys).join(store.wanted(keys).select("frame_cache_key", chunk), "frame_cache_key").select("frame_cache_key", "atom_i", "cs_iso", "chunk")


def lookup_rounds(spark, sf_dir):
    """One store, asked for all keys before, between and after two stores of rows with other columns: what it has at the end, and how much before."""
    rows = _orders_as_frames(spark, sf_dir)
    keys, store = rows.select("frame_cache_key"), CacheStore(spark, V.folder(spark, "cache"))
    before = store.lookup(keys)
    store.store(rows.where("k % 3 = 0").drop("k", "t"))
    between = store.lookup(keys).count()
    store.store(rows.where("k % 3 = 1").withColumn("cs_xx", F.col("cs_iso") * 2).drop("k", "t"))
    return store.lookup(keys).select("frame_cache_key", "atom_i", "cs_iso", "cs_xx", F.lit(before is None).alias("empty_before"), F.lit(between).cast("bigint").alias("between"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    avg_unweighted, avg_weighted, avg_nonfinite, avg_zero_weight, weights_missing, manifest_latest, manifest_probe, index_compact, index_parse, index_write, utc_text, tensor_unpack, committee_std,
    schema_fill, content_hash, structure_ids, cell_missing, frame_slice, frame_last, cache_canonical, cache_complete, cache_complete_turns, cache_materialize, cache_hit, cache_miss, union_align, unsupported, first_failure,
    warn_skip, pack_count, pack_bytes, pack_whole, result_order, results_csv, avg_per_atom, cache_store, predict_run, run_figures, distinct_keys, text_block, counts, frame_keys, number_coercion, predict_norms, magres_text, magres_files, index_compacted, index_snapshot,
    predict_command, average_command, compact_command, input_digests, frame_tail, magres_tensors, lookup_chunks, lookup_rounds,
)} | {"explode_atoms": explode_rows, "cache_key": cache_keys}

_MEAN = "SELECT atom_i, element, x, y, z, sum(cs_iso * w) / nullif(sum(w), 0) AS cs_iso, sum(cs_xx * w) / nullif(sum(w), 0) AS cs_xx FROM (SELECT *, {w} AS w FROM r) GROUP BY ALL HAVING sum(w) <> 0"
_INDEX = "SELECT user_id AS cache_key, event_type AS output_format, ts AS written_at, CAST(user_id % 3 AS VARCHAR) AS writer_id, event_id AS seq, value FROM events"
_DOCS = "SELECT doc_id AS frame_ord, sha256(text) AS structure_id FROM documents"
_CANON = "SELECT l_orderkey AS frame_cache_key, CAST(l_linenumber - 1 AS BIGINT) AS atom_i, l_extendedprice AS cs_iso, l_partkey AS p FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1"

ORACLES: dict[str, str] = {
    "avg_unweighted": f"WITH r AS ({RESULTS_SQL}) " + _MEAN.format(w="CAST(1 AS DOUBLE)"),
    "avg_weighted": f"WITH r AS ({RESULTS_SQL}) " + _MEAN.format(w="CAST(1 + frame % 7 AS DOUBLE)"),
    "avg_zero_weight": f"WITH r AS ({RESULTS_SQL}) " + _MEAN.format(w="CAST(frame % 3 - 1 AS DOUBLE)"),
    "avg_nonfinite": f"WITH r AS ({RESULTS_SQL}) SELECT atom_i, element, sum(CASE WHEN frame % 5 > 2 AND atom_i <> 0 THEN cs_iso END) / nullif(count(CASE WHEN frame % 5 > 2 AND atom_i <> 0 THEN 1 END), 0) AS cs_iso FROM r GROUP BY ALL",
    "weights_missing": "SELECT doc_id AS frame FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "manifest_latest": f"SELECT cache_key, output_format, seq, value FROM ({_INDEX}) QUALIFY row_number() OVER (PARTITION BY cache_key ORDER BY (output_format = 'click') DESC, written_at DESC, writer_id DESC, seq DESC) = 1",
    "manifest_probe": f"SELECT c_custkey AS cache_key, coalesce(seq, -1) AS seq, output_format FROM customer LEFT JOIN (SELECT * FROM ({_INDEX}) QUALIFY row_number() OVER (PARTITION BY cache_key ORDER BY written_at DESC, writer_id DESC, seq DESC) = 1) ON cache_key = c_custkey",
    "index_compact": f"SELECT cache_key, output_format, seq, value FROM ({_INDEX}) QUALIFY row_number() OVER (PARTITION BY cache_key, output_format ORDER BY written_at DESC, writer_id DESC, seq DESC) = 1",
    "index_parse": "SELECT CAST(user_id AS VARCHAR) AS cache_key, event_type AS chunk_path, event_id AS seq, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS written_at_utc FROM events WHERE event_id % 7 > 3",
    "index_write": """SELECT event_id AS seq, '{"cache_key":"' || user_id || '"' || CASE WHEN event_id % 2 = 0 THEN ',"model_name":"m"' ELSE '' END || ',"output_format":"' || event_type || '","seq":' || event_id || '}' AS line FROM events""",
    "utc_text": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS text, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS seconds FROM events",
    "explode_atoms": "SELECT vec_id AS frame, 'label' || label AS source_file, CAST(i AS BIGINT) AS atom_i, (['H', 'C', 'N', 'O'])[i % 4 + 1] AS element, CAST(embedding[3 * i + 1] AS DOUBLE) AS x, CAST(embedding[3 * i + 2] AS DOUBLE) AS y, CAST(embedding[3 * i + 3] AS DOUBLE) AS z FROM (SELECT *, unnest(range(0, 21)) AS i FROM embeddings)",
    "tensor_unpack": "SELECT vec_id, " + ", ".join(f"CAST(embedding[{i}] AS DOUBLE) AS cs_{a}" for a, i in C.UPPER.items()) + " FROM embeddings",
    "committee_std": "SELECT vec_id, round(stddev_pop(CAST(v AS DOUBLE)), 5) AS std FROM (SELECT vec_id, unnest(embedding) AS v FROM embeddings) GROUP BY 1",
    "schema_fill": f"SELECT CAST(frame AS VARCHAR) AS structure_id, source_file, frame, atom_i, element, x, y, z, cs_iso, cs_xx, " + ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in required_columns("tensor", True)[9:] if c != "cs_xx") + f" FROM ({RESULTS_SQL})",
    "cache_key": """SELECT doc_id AS frame_ord, sha256('{"flags":{"committee":false,"property":"iso"},"model_name":"model","model_version":"1","schema_version":"1","structure_id":"' || sha256(text) || '"}') AS cache_key FROM documents""",
    "content_hash": _DOCS,
    "cell_missing": "SELECT vec_id AS frame, label = 0 AS missing FROM embeddings",
    "frame_slice": f"SELECT part, frame, 21 AS n_atoms, 'HCNOHCNOHCNOHCNOHCNOH' AS elements, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[63] AS DOUBLE) AS z, CASE WHEN label = 0 THEN 0.0 ELSE 8.0 END::DOUBLE AS cell, label = 0 AS missing FROM ({V.FILES_SQL}) WHERE frame BETWEEN 1 AND 399 AND frame % 3 = 1",
    "frame_last": "SELECT conv_id, max(turn) AS turn, arg_max(role, turn) AS role FROM conversations GROUP BY 1",
    "cache_canonical": _CANON,
    "cache_complete": f"SELECT frame_cache_key, count(*) AS n_atoms FROM ({_CANON}) GROUP BY 1 HAVING min(atom_i) = 0 AND max(atom_i) = count(*) - 1",
    "cache_complete_turns": "SELECT conv_id AS frame_cache_key, count(*) AS n_atoms FROM conversations GROUP BY 1 HAVING min(turn) = 0 AND max(turn) = count(*) - 1",
    "cache_materialize": f"SELECT frame_ord AS frame, min(frame_ord) OVER (PARTITION BY structure_id) AS first FROM ({_DOCS})",
    "cache_hit": f"SELECT o_orderkey AS frame_ord FROM orders JOIN (SELECT frame_cache_key, count(*) AS n FROM ({_CANON}) GROUP BY 1 HAVING min(atom_i) = 0 AND max(atom_i) = count(*) - 1) ON frame_cache_key = o_orderkey AND n = o_custkey % 7 + 1",
    "cache_miss": f"WITH d AS ({_DOCS}) SELECT * FROM d WHERE frame_ord % 2 = 1 AND structure_id NOT IN (SELECT structure_id FROM d WHERE frame_ord % 2 = 0)",
    "union_align": "SELECT p_partkey, p_brand, CAST(NULL AS DOUBLE) AS p_size FROM part UNION ALL SELECT p_partkey, NULL, CAST(p_size AS DOUBLE) FROM part",
    "unsupported": "SELECT p_brand, coalesce(string_agg(DISTINCT s, ', ' ORDER BY s) FILTER (s IN ('He', 'Ne', 'Na')), '') AS unsupported FROM (SELECT p_brand, (['H', 'He', 'C', 'Ne', 'N', 'Na', 'O'])[p_size % 7 + 1] AS s FROM part) GROUP BY 1",
    "first_failure": "SELECT vec_id AS frame, CASE label WHEN 3 THEN 'the frame has no atoms: label3#' || vec_id WHEN 5 THEN 'positions are not finite in label5#' || vec_id WHEN 7 THEN 'unsupported elements in label7#' || vec_id || ': He, Xe' END AS failure FROM embeddings",
    "warn_skip": "SELECT 'label' || label AS name, count(*) AS kept FROM embeddings WHERE label <> 0 GROUP BY 1 UNION ALL SELECT 'label0#' || vec_id, 0 FROM embeddings WHERE label = 0",
    "pack_count": f"SELECT doc_id, doc_id // {PACK_GROUP} AS writer, (row_number() OVER (PARTITION BY doc_id // {PACK_GROUP} ORDER BY doc_id) - 1) // 200 AS chunk_no FROM documents",
    "pack_bytes": f"""WITH RECURSIVE d AS (SELECT doc_id, doc_id // {PACK_GROUP} AS writer, n_chars AS b, row_number() OVER (PARTITION BY doc_id // {PACK_GROUP} ORDER BY doc_id) AS i FROM documents),
p AS (SELECT doc_id, writer, i, b AS held, 1 AS n, CAST(0 AS BIGINT) AS chunk_no FROM d WHERE i = 1 UNION ALL
SELECT d.doc_id, d.writer, d.i, CASE WHEN n >= 20 OR held + b > 30000 THEN b ELSE held + b END, CASE WHEN n >= 20 OR held + b > 30000 THEN 1 ELSE n + 1 END, CASE WHEN n >= 20 OR held + b > 30000 THEN chunk_no + 1 ELSE chunk_no END
FROM p JOIN d ON d.writer = p.writer AND d.i = p.i + 1) SELECT doc_id, writer, chunk_no FROM p""",
    "pack_whole": """WITH RECURSIVE d AS (SELECT doc_id, coalesce(n_chars, 0) AS b, row_number() OVER (ORDER BY doc_id) - 1 AS place FROM documents),
p AS (SELECT doc_id, place, b AS held, 1 AS n, CAST(0 AS BIGINT) AS chunk_no FROM d WHERE place = 0 UNION ALL
SELECT d.doc_id, d.place, CASE WHEN n >= 20 OR held + b > 30000 THEN b ELSE held + b END, CASE WHEN n >= 20 OR held + b > 30000 THEN 1 ELSE n + 1 END, CASE WHEN n >= 20 OR held + b > 30000 THEN chunk_no + 1 ELSE chunk_no END
FROM p JOIN d ON d.place = p.place + 1) SELECT doc_id, place, chunk_no FROM p""",
    "result_order": f"SELECT source_file, frame, atom_i, cs_iso, row_number() OVER (ORDER BY source_file, frame, atom_i, element, x, y, cs_iso, cs_xx) - 1 AS place FROM ({RESULTS_SQL})",
    "results_csv": f"SELECT source_file, frame, atom_i, element, x, y, CASE frame % 5 WHEN 0 THEN NULL WHEN 1 THEN 'inf'::DOUBLE WHEN 2 THEN '-inf'::DOUBLE ELSE cs_iso END AS cs_iso, cs_xx FROM ({RESULTS_SQL})",
    "avg_per_atom": f"WITH r AS ({RESULTS_SQL}) " + _MEAN.format(w="CAST(1 + frame % 7 AS DOUBLE)"),
    "cache_store": "SELECT CAST(l_orderkey AS VARCHAR) AS frame_cache_key, CAST(l_linenumber - 1 AS BIGINT) AS atom_i, l_extendedprice + CASE WHEN l_orderkey % 10 = 0 THEN 1 ELSE 0 END AS cs_iso FROM lineitem WHERE l_orderkey % 2 = 0",
    "predict_run": f"SELECT part, frame, CAST(i AS BIGINT) AS atom_i, (['H', 'C', 'N', 'O'])[i % 4 + 1] AS element, round(sqrt(CAST(embedding[3 * i + 1] AS DOUBLE) ** 2 + CAST(embedding[3 * i + 2] AS DOUBLE) ** 2 + CAST(embedding[3 * i + 3] AS DOUBLE) ** 2), 5) AS cs_iso, 0 AS misses FROM (SELECT *, unnest(range(0, 21)) AS i FROM ({V.FILES_SQL}))",
    "magres_text": """SELECT CAST(vec_id AS VARCHAR) AS structure_id, vec_id AS frame, '#$magres-abinitio-v1.0' || chr(10) || '[atoms]' || chr(10) || 'units lattice Angstrom' || chr(10) || 'lattice ' || CASE WHEN label = 0 THEN repeat('0.00000000 ', 8) || '0.00000000' ELSE '8.00000000' || repeat(' 0.00000000', 3) || ' 8.00000000' || repeat(' 0.00000000', 3) || ' 8.00000000' END || chr(10)
|| CASE WHEN label = 0 THEN '# pbc 0 0 0' ELSE '# pbc 1 1 1' END || chr(10) || 'units atom Angstrom' || chr(10) || string_agg('atom ' || e || ' ' || e || (i + 1) || ' ' || (i + 1) || printf(' %.8f %.8f %.8f', x, y, z), chr(10) ORDER BY i) || chr(10) || '[/atoms]' || chr(10) || '[magres]' || chr(10) || 'units ms ppm' || chr(10)
|| string_agg('ms ' || e || ' ' || (i + 1) || printf(' %.8f 0.00000000 0.00000000 0.00000000 %.8f 0.00000000 0.00000000 0.00000000 %.8f', x, x, x), chr(10) ORDER BY i) || chr(10) || '[/magres]' || chr(10) AS text
FROM (SELECT vec_id, label, i, (['H', 'C', 'N', 'O'])[i % 4 + 1] AS e, CAST(embedding[3 * i + 1] AS DOUBLE) AS x, CAST(embedding[3 * i + 2] AS DOUBLE) AS y, CAST(embedding[3 * i + 3] AS DOUBLE) AS z FROM (SELECT *, unnest(range(0, 21)) AS i FROM embeddings)) GROUP BY vec_id, label""",
    "run_figures": f"""WITH f AS ({V.FILES_SQL}) SELECT 0 AS run, count(*) AS frames, 21 * count(*) AS atoms, 0 AS hits, count(*) AS misses FROM f WHERE frame % 2 = 0
UNION ALL SELECT 1, count(*), 21 * count(*), count(*) FILTER (frame % 2 = 0), count(*) FILTER (frame % 2 = 1) FROM f""",
    "distinct_keys": "SELECT DISTINCT user_id AS cache_key, event_type AS output_format FROM events",
    "text_block": "SELECT conv_id, string_agg(role || ' ' || text, chr(10) ORDER BY turn) AS block FROM conversations GROUP BY 1",
    "counts": "SELECT role, count(DISTINCT conv_id) AS frames, count(*) AS atoms FROM conversations GROUP BY 1",
    "frame_keys": f"SELECT DISTINCT source_file || '#' || frame AS frame_key FROM ({RESULTS_SQL})",
    "number_coercion": "SELECT event_id, CASE WHEN event_id % 4 = 3 THEN CAST(event_id AS DOUBLE) END AS number FROM events",
    "predict_norms": "SELECT vec_id AS frame, CAST(i AS BIGINT) AS atom_i, (['H', 'C', 'N', 'O'])[i % 4 + 1] AS element, round(sqrt(CAST(embedding[3 * i + 1] AS DOUBLE) ** 2 + CAST(embedding[3 * i + 2] AS DOUBLE) ** 2 + CAST(embedding[3 * i + 3] AS DOUBLE) ** 2), 5) AS cs_iso FROM (SELECT *, unnest(range(0, 21)) AS i FROM embeddings)",
}

ORACLES["magres_files"] = f"WITH m AS ({ORACLES['magres_text']}) SELECT 'single' AS mode, row_number() OVER (ORDER BY structure_id) - 1 AS place, NULL::VARCHAR AS name, text FROM m UNION ALL SELECT 'per-frame', NULL, structure_id || '_f' || frame || '.magres', text FROM m"
ORACLES["index_compacted"] = f"""WITH v AS (SELECT *, CAST(cache_key AS VARCHAR) AS k FROM ({_INDEX}) WHERE seq % 7 <> 0),
b AS (SELECT k, output_format, seq, writer_id FROM v QUALIFY row_number() OVER (PARTITION BY k, output_format ORDER BY date_trunc('second', written_at) DESC, writer_id DESC, seq DESC) = 1)
SELECT k AS cache_key, output_format, seq, writer_id, row_number() OVER (ORDER BY k, output_format) AS line_no, (SELECT count(*) FROM v) AS scanned, 1 AS files FROM b"""

ORACLES["index_snapshot"] = f"""SELECT CAST(cache_key AS VARCHAR) AS cache_key, output_format, seq, writer_id, 1 AS replayed FROM ({_INDEX}) WHERE seq % 7 <> 0
QUALIFY row_number() OVER (PARTITION BY cache_key ORDER BY (output_format = 'click') DESC, date_trunc('second', written_at) DESC, writer_id DESC, seq DESC) = 1"""

_LITTLE = lambda v, n: " || ".join(f"substr(hex(({v})::BIT::BLOB), {i}, 2)" for i in range(2 * n - 1, 0, -2))
ORACLES["structure_ids"] = f"""SELECT vec_id AS frame, sha256(encode('normalization_version=1' || chr(10) || 'numbers:(21,):<i4' || chr(10))
|| unhex(array_to_string([{_LITTLE("[1, 6, 7, 8][i % 4 + 1]::INTEGER", 4)} for i in range(0, 21)], '')) || encode('positions:(21, 3):<f8' || chr(10))
|| unhex(array_to_string([{_LITTLE("embedding[i]::DOUBLE", 8)} for i in range(1, 64)], '')) || encode('cell:(3, 3):<f8' || chr(10))
|| unhex(array_to_string([{_LITTLE("(CASE WHEN label <> 0 AND i % 4 = 0 THEN 8 ELSE 0 END)::DOUBLE", 8)} for i in range(0, 9)], '')) || encode('pbc:(3,):|u1' || chr(10))
|| unhex(CASE WHEN label = 0 THEN '000000' ELSE '010101' END)) AS structure_id FROM embeddings"""

_ATOMS = "SELECT vec_id, label, i, (['H', 'C', 'N', 'O'])[i % 4 + 1] AS e, CAST(embedding[3 * i + 1] AS DOUBLE) AS x, CAST(embedding[3 * i + 2] AS DOUBLE) AS y, CAST(embedding[3 * i + 3] AS DOUBLE) AS z FROM (SELECT *, unnest(range(0, 21)) AS i FROM embeddings)"
ORACLES["predict_command"] = f"""WITH f AS (SELECT * FROM ({V.FILES_SQL}) WHERE frame % 2 = 0 AND label <> 0), a AS (SELECT part, frame, i, CAST(embedding[3 * i + 1] AS DOUBLE) AS x FROM (SELECT *, unnest(range(0, 21)) AS i FROM f))
SELECT part, frame, CAST(i AS BIGINT) AS atom_i, CAST(floor(x * 100000) AS BIGINT) AS cs_iso, 1.0::DOUBLE AS cs_iso_uncertainty, CAST(floor(x * 100000) AS BIGINT) AS cs_xx, CAST(floor(6 * x * 100000) AS BIGINT) AS cs_yz, NULL::DOUBLE AS cs_zz_uncertainty,
'success' AS status, 1::BIGINT AS workers, (SELECT count(*) FROM f) AS frames, (SELECT count(*) FROM f) AS keys, 1::BIGINT AS warnings, (SELECT count(DISTINCT vec_id // {V.FILE_FRAMES}) FROM embeddings) AS inputs FROM a"""
ORACLES["average_command"] = f"WITH a AS ({_ATOMS}), m AS (SELECT CAST(i AS BIGINT) AS atom_i, e AS element, 0.0::DOUBLE AS x, 0.0::DOUBLE AS z, sum(floor(x * 1000) * (label + 1)) / sum(label + 1) AS cs_iso FROM a GROUP BY ALL) SELECT *, (SELECT count(*) FROM m) AS rows, true AS weighted FROM m"
ORACLES["compact_command"] = f"""WITH v AS (SELECT * FROM ({_INDEX}) WHERE seq % 7 <> 0 AND writer_id <> '0')
SELECT CAST(cache_key AS VARCHAR) AS cache_key, output_format, seq, (SELECT count(*) FROM (SELECT DISTINCT cache_key, output_format FROM v)) AS kept, 0 AS removed, 3 AS files FROM v
QUALIFY row_number() OVER (PARTITION BY cache_key ORDER BY (output_format = 'click') DESC, date_trunc('second', written_at) DESC, writer_id DESC, seq DESC) = 1"""
ORACLES["input_digests"] = f"SELECT doc_id // {V.FILE_FRAMES} AS part, sha256(string_agg(coalesce(text, ''), chr(10) ORDER BY doc_id) || chr(10)) AS sha256 FROM documents GROUP BY 1"
ORACLES["frame_tail"] = f"SELECT part, frame, CAST(embedding[1] AS DOUBLE) AS x FROM ({V.FILES_SQL}) QUALIFY row_number() OVER (PARTITION BY part ORDER BY frame DESC) <= 5"
ORACLES["magres_tensors"] = f"""SELECT vec_id AS frame, '#$magres-abinitio-v1.0' || chr(10) || '[atoms]' || chr(10) || 'units atom Angstrom' || chr(10) || string_agg('atom ' || e || ' ' || e || (i + 1) || ' ' || (i + 1) || printf(' %.8f %.8f %.8f', x, y, z), chr(10) ORDER BY i) || chr(10) || '[/atoms]' || chr(10) || '[magres]' || chr(10) || 'units ms ppm' || chr(10)
|| string_agg('ms ' || e || ' ' || (i + 1) || printf(' %.8f %.8f %.8f %.8f %.8f %.8f %.8f %.8f %.8f', x, x * 2, x * 3, x * 2, x * 4, x * 5, x * 3, x * 5, x * 6), chr(10) ORDER BY i) || chr(10) || '[/magres]' || chr(10) AS text FROM ({_ATOMS}) GROUP BY vec_id"""
ORACLES["lookup_chunks"] = """WITH p AS (SELECT k, t, (row_number() OVER (ORDER BY t, CAST(k AS VARCHAR)) - 1) // 200 AS chunk FROM (SELECT l_orderkey AS k, min(l_shipdate) AS t FROM lineitem GROUP BY 1))
SELECT CAST(k AS VARCHAR) AS frame_cache_key, CAST(l_linenumber - 1 AS BIGINT) AS atom_i, l_extendedprice AS cs_iso, chunk FROM p JOIN lineitem ON l_orderkey = k WHERE t >= '1996-01-01' AND t < '1996-04-01'"""
ORACLES["lookup_rounds"] = "SELECT CAST(l_orderkey AS VARCHAR) AS frame_cache_key, CAST(l_linenumber - 1 AS BIGINT) AS atom_i, l_extendedprice AS cs_iso, CASE l_orderkey % 3 WHEN 1 THEN l_extendedprice * 2 END AS cs_xx, true AS empty_before, (SELECT count(*) FROM lineitem WHERE l_orderkey % 3 = 0) AS between FROM lineitem WHERE l_orderkey % 3 < 2"


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
