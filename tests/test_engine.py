"""Scan, validation, prediction, cache, averaging, sinks and the command line."""

import hashlib
import json
import os
import subprocess
import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from atomweft.cli import average_output, main
from atomweft.config import build_config, to_bool
from atomweft.errors import BackendRuntimeError, ConfigError, InputError, MissingDependencyError, ValidationError
from atomweft.functions.columns import cache_key, committee_std, is_finite, number, parse_utc
from atomweft.functions.digest import structure_digest
from atomweft.operators.average import average_per_atom
from atomweft.operators.cache import canonical, complete_keys, pack
from atomweft.operators.predict import ModelPredictor, Structure, allowed_workers
from atomweft.operators.store import CacheStore, compact_index, prepare_rows
from atomweft.run import run_predict
from atomweft.schema import required_columns
from atomweft.sources.index_log import read_index
from atomweft.sources.structures import load_structures, parse_xyz, resolve_inputs, select_frames
from atomweft.sources.tables import file_digests, load_weights, read_results, weights_frame

from .helpers import ByX, Failing, Ramp, hco, record, write


def config(out, **given):
    return build_config(out, given)


# --- scan


def test_selectors_follow_python_slices():
    for text in (":", "0:10:2", "-3:", "::-1", "5:2", "1:"):
        assert select_frames(text, 7) == list(range(7))[slice(*(int(x) if x else None for x in text.split(":")))]
    assert select_frames("-1", 4) == [3]
    for bad in ("x", "1:2:3:4", "9", "-9"):
        with pytest.raises(InputError):
            select_frames(bad, 4)
    for bad in ("a:b", "::0"):
        with pytest.raises(ValueError) as e:
            select_frames(bad, 4)
        assert not isinstance(e.value, InputError)


def test_xyz_variants():
    by_number = '1\nLattice="2 0 0 0 3 0 0 0 4" Properties=Z:I:1:pos:R:3\n8 0.5 1 2\n'
    (frame,) = parse_xyz(by_number)
    assert frame == {"numbers": [8], "element": ["O"], "positions": [0.5, 1.0, 2.0], "cell": [2.0, 0, 0, 0, 3, 0, 0, 0, 4], "pbc": [1, 1, 1]}
    with pytest.raises(ValueError):
        list(parse_xyz("2\n\nH 0 0 0\n"))


def test_poscar(spark, tmp_path):
    text = "c\n2.0\n1 0 0\n0 2 0\n0 0 3\nH O\n1 2\n{kind}\n0.5 0.5 0.5\n0 0 0\n0.1 0 0\n"
    direct, cartesian = (write(tmp_path / n, text.format(kind=k)) for n, k in (("POSCAR", "Direct"), ("a.vasp", "Selective\nCartesian")))
    rows = {r.source_file: r for r in load_structures(spark, [direct, cartesian]).collect()}
    assert rows[direct].element == ["H", "O", "O"] and tuple(rows[direct].positions[0]) == (1.0, 2.0, 3.0) and rows[direct].cell[8] == 6.0
    assert tuple(rows[cartesian].positions[0]) == (1.0, 1.0, 1.0) and rows[cartesian].pbc == [1, 1, 1] and not rows[cartesian].normalized_cell_pbc
    with pytest.raises(InputError):
        load_structures(spark, [write(tmp_path / "CONTCAR", "c\n1\n")])


CIF = """data_salt
_cell_length_a 4.0(1)
_cell_length_b 4.0
_cell_length_c 6.0
_cell_angle_alpha 90
_cell_angle_beta 90
_cell_angle_gamma 120
_note
;
loop_ in a text field
;
loop_
_symmetry_equiv_pos_as_xyz
x,y,z
'-x, -y, z+1/2' # a comment
loop_
_atom_site_label
_atom_site_type_symbol
_atom_site_fract_x
_atom_site_fract_y
_atom_site_fract_z
Na1 Na1+ 0 0 0.25(3)
"O1'" O 0.25 0.5 1.5
data_empty
_cell_length_a 1
"""


def test_crystal_and_molecule_files(spark, tmp_path):
    pdb = "CRYST1   10.000   11.000   12.000  90.00  90.00  90.00 P 1\n" + "".join(f"MODEL {k}\nHETATM    1  C1  LIG A   1    {k:8.3f}   2.000   3.000  1.00  0.00{e:>12}\nENDMDL\n" for k, e in ((1, "C"), (2, ""))) + "END\n"
    magres = "#$magres-abinitio-v1.0\n[atoms]\nunits lattice Angstrom\nlattice 5 0 0 0 5 0 0 0 5\nunits atom Angstrom\natom H H 1 0.5 0 0\natom O O 1 1 1 1\n[/atoms]\n[magres]\nms H 1 1 0 0 0 1 0 0 0 1\n[/magres]\n"
    cif, two, three = write(tmp_path / "a.cif", CIF), write(tmp_path / "b.pdb", pdb), write(tmp_path / "c.magres", magres)
    rows = {(r.source_file, r.frame): r for r in load_structures(spark, [cif, two, three]).collect()}
    assert sorted(rows) == [(cif, 0), (two, 0), (two, 1), (three, 0)] and all(r.pbc == [1, 1, 1] for r in rows.values())
    salt = rows[cif, 0]
    assert salt.element == ["Na", "Na", "O", "O"] and np.allclose(np.reshape(salt.cell, (3, 3)), [[4, 0, 0], [-2, 12**0.5, 0], [0, 0, 6]])
    assert np.allclose([tuple(p) for p in salt.positions], [(0, 0, 1.5), (0, 0, 4.5), (0, 3**0.5, 3), (2, 3**0.5, 0)])
    assert [tuple(rows[two, k].positions[0]) for k in (0, 1)] == [(1, 2, 3), (2, 2, 3)] and rows[two, 1].element == ["C"]
    assert rows[three, 0].numbers == [1, 8] and tuple(rows[three, 0].positions[0]) == (0.5, 0, 0)
    twice = CIF.replace("'-x, -y, z+1/2'", "'-x, -y, z+1'")
    assert load_structures(spark, [write(tmp_path / "d.cif", twice)]).first().element == ["Na", "O", "O"]  # on the axis the images are one atom
    for name, text in (("e.cif", CIF.replace("_symmetry_equiv_pos_as_xyz", "_symmetry_space_group_name_H-M")), ("f.cif", "x " + CIF), ("g.cif", CIF.replace("gamma 120", "gamma 200")), ("h.magres", magres.replace("atom Angstrom", "atom bohr")), ("i.pdb", "")):
        with pytest.raises(InputError):
            load_structures(spark, [write(tmp_path / name, text)])


def test_load_structures(spark, tmp_path):
    a, b = write(tmp_path / "a.xyz", hco(cell=False), hco(2.0, cell=False)), write(tmp_path / "b.xyz", hco())
    assert resolve_inputs([str(tmp_path / "*.xyz"), a]) == sorted([a, b])
    rows = load_structures(spark, [str(tmp_path / "*.xyz")]).orderBy("frame_ord").collect()
    assert [(r.source_file, r.frame, r.normalized_cell_pbc) for r in rows] == [(a, 0, True), (a, 1, True), (b, 0, False)]
    assert rows[0].structure_id == structure_digest([1, 6, 8], [0, 0, 0, 0, 0, 1.1, 0, 1, 0], [0] * 9, [0] * 3)
    assert rows[0].structure_id.startswith("4b89fbc4") and rows[0].structure_id.endswith("6610b0")
    assert [r.frame for r in load_structures(spark, [a], "1").collect()] == [1]
    assert [r.frame for r in load_structures(spark, [a], "::-1").orderBy("frame_ord").collect()] == [1, 0]
    write(tmp_path / "empty.xyz", "")
    for given, selector in (([str(tmp_path / "none*.xyz")], ":"), ([str(tmp_path / "empty.xyz")], ":"), ([a], "7"), ([a], "5:9"), ([], ":")):
        with pytest.raises(InputError):
            load_structures(spark, given, selector)


def test_digests(spark, tmp_path):
    p = write(tmp_path / "a.xyz", hco())
    assert file_digests(spark, [p, p, str(tmp_path)]) == [{"path": p, "sha256": hashlib.sha256(Path(p).read_bytes()).hexdigest()}]


# --- columns


def test_columns(spark):
    row = spark.sql("select 'NaN' a, '1.5' b, 'x' c, '-Infinity' d, array(1.0D, 3.0D) m").select(*(is_finite(number(F.col(c))).alias(c) for c in "abcd"), committee_std(F.col("m")).alias("m")).first()
    assert tuple(row) == (False, True, False, False, 1.0)
    key = spark.range(1).select(cache_key(F.lit("s"), "m", "v", "1", True, "iso").alias("k")).first().k
    flat = json.dumps({"flags": {"committee": True, "property": "iso"}, "model_name": "m", "model_version": "v", "schema_version": "1", "structure_id": "s"}, sort_keys=True, separators=(",", ":"))
    assert key == hashlib.sha256(flat.encode()).hexdigest()
    times = spark.createDataFrame([("2024-01-01T00:00:00Z",), ("2024-01-01T00:00:00",), ("bad",)], "t string").select(parse_utc(F.col("t")).isNotNull().alias("ok")).collect()
    assert [r.ok for r in times] == [True, False, False]
    assert required_columns("both", True)[8:11] == ["cs_iso", "cs_iso_uncertainty", "cs_xx"] and len(required_columns("tensor", True)) == 22


def test_config(tmp_path):
    assert to_bool("Yes", "x") and not to_bool(0, "x")
    for bad in ("maybe", 2, None, 1.0):
        with pytest.raises(ConfigError):
            to_bool(bad, "x")
    (tmp_path / "c.yml").write_text("workers: 3\nproperty: Tensor\nformat: csv\nstrict: 'on'\nunknown: 1\n")
    c = build_config(tmp_path, {"workers": 2}, tmp_path / "c.yml")
    assert (c.workers, c.property_mode, c.output_format, c.on_warning, c.chunk_size) == (2, "tensor", "csv", "error", 200)
    (tmp_path / "e.yml").write_text("")
    assert build_config(tmp_path, {}, tmp_path / "e.yml").frames == ":"
    (tmp_path / "bad.json").write_text("[1]")
    for given, path in (({"device": "tpu"}, None), ({"workers": 0}, None), ({"cache_chunk_max_mb": 0}, None), ({"workers": "x"}, None), ({}, tmp_path / "bad.json"), ({}, tmp_path / "none.json")):
        with pytest.raises(ConfigError):
            build_config(tmp_path, given, path)
    assert json.dumps(c.as_dict())
    assert average_output(Path("a.csv"), "parquet") == (Path("a.csv"), "parquet")
    assert average_output(Path("a.txt"), "auto") == (Path("a.csv"), "csv")


# --- averaging


ROWS = [("a.xyz", 0, 0, "H", 0.0, 0.0, 0.0, 10.0, 1.0), ("a.xyz", 0, 1, "C", 0.0, 0.0, 1.0, 20.0, 2.0), ("a.xyz", 1, 0, "H", 0.0, 0.0, 0.0, 14.0, 3.0), ("a.xyz", 1, 1, "C", 0.0, 0.0, 1.0, 28.0, 6.0)]
COLS = "source_file string, frame bigint, atom_i bigint, element string, x double, y double, z double, cs_iso double, cs_xx double"


def test_average(spark):
    df = spark.createDataFrame(ROWS, COLS)
    assert [(r.cs_iso, r.cs_xx) for r in average_per_atom(df).collect()] == [(12.0, 2.0), (24.0, 4.0)]
    w = lambda d: weights_frame(spark, d)
    assert [(r.cs_iso, r.cs_xx) for r in average_per_atom(df, w({"a.xyz#0": 1.0, "a.xyz#1": 3.0, "b#0": 9.0})).collect()] == [(13.0, 2.5), (26.0, 5.0)]
    assert average_per_atom(df, w({"a.xyz#0": 1.0, "a.xyz#1": -1.0})).count() == 0
    for bad in ({"a.xyz#0": 1.0}, {"a.xyz#0": 1.0, "a.xyz#1": float("nan")}):
        with pytest.raises(ValueError):
            average_per_atom(df, w(bad))
    with pytest.raises(ValueError):
        average_per_atom(df.drop("cs_iso"))
    with pytest.raises(ValueError):
        average_per_atom(df.drop("element"))


def test_average_of_odd_values(spark):
    rows = [("a", f, 0, None, float("nan"), 0.0, 0.0, v, float("inf")) for f, v in enumerate((1.0, float("nan"), None, 3.0))]
    (row,) = average_per_atom(spark.createDataFrame(rows, COLS)).collect()
    assert (row.element, row.x, row.cs_iso, row.cs_xx) == (None, None, 2.0, None)


def test_weights_file(tmp_path):
    (tmp_path / "w.json").write_text('{"a#0": 1}')
    (tmp_path / "w.yaml").write_text("a#0: 2.5\n")
    assert load_weights(tmp_path / "w.json") == {"a#0": 1.0} and load_weights(tmp_path / "w.yaml") == {"a#0": 2.5}
    (tmp_path / "l.json").write_text("[]")
    with pytest.raises(ValueError):
        load_weights(tmp_path / "l.json")


# --- cache


CACHED = "frame_cache_key string, structure_id string, source_file string, frame bigint, atom_i bigint, element string, x double, y double, z double, cs_iso double"


def cached_rows(spark, *values, key="k"):
    return spark.createDataFrame([(key, "s", "f", 0, i, "H", 0.0, 0.0, 0.0, v) for i, v in enumerate(values)], CACHED)


def chunk(tmp_path, name, value, key="k"):
    path = tmp_path / f"{name}.csv"
    pd.DataFrame({"frame_cache_key": [key], "atom_i": [0], "cs_iso": [value]}).to_csv(path, index=False)
    return path


@pytest.mark.parametrize(
    "lines, expected",
    [
        ([("a", dict(at="2024-01-01T00:00:00Z")), ("b", dict(at="2024-01-01T00:00:01Z", writer="a"))], 2.0),
        ([("a", {}), ("b", {})], 2.0),
        ([("a", dict(form="csv", at="2024-01-01T00:00:00Z")), ("b", dict(form="other", at="2025-01-01T00:00:00Z"))], 1.0),
    ],
)
def test_newest_record_wins(spark, tmp_path, lines, expected):
    store = CacheStore(spark, tmp_path / "cache", "csv")
    paths = {"a": chunk(tmp_path, "a", 1.0), "b": chunk(tmp_path, "b", 2.0)}
    (store.index_dir / "index_x.jsonl").write_text("\n".join(record("k", paths[n], **kw) for n, kw in lines) + "\n{broken\n\n")
    keys = spark.createDataFrame([("k",), ("other",)], "frame_cache_key string")
    assert [r.cs_iso for r in store.lookup(keys).collect()] == [expected]


def test_larger_index_path_wins_and_missing_chunk_is_a_miss(spark, tmp_path):
    store = CacheStore(spark, tmp_path / "cache", "csv")
    a, b = chunk(tmp_path, "a", 1.0), chunk(tmp_path, "b", 5.0)
    (store.index_dir / "index_a.jsonl").write_text(record("k", a) + "\n")
    (store.index_dir / "index_b.jsonl").write_text(record("k", b) + "\n")
    keys = spark.createDataFrame([("k",)], "frame_cache_key string")
    assert [r.cs_iso for r in store.lookup(keys).collect()] == [5.0]
    os.unlink(b)
    assert CacheStore(spark, tmp_path / "cache", "csv").lookup(keys) is None


@pytest.mark.parametrize("form", ["parquet", "csv"])
def test_store_and_look_up(spark, tmp_path, form):
    store = CacheStore(spark, tmp_path / "with space", form, "m", "1", "1")
    keys = spark.createDataFrame([("k0",), ("k3",), ("none",)], "frame_cache_key string")
    assert store.lookup(keys) is None
    rows = cached_rows(spark, 1.0, 2.0, key="k0")
    for k in range(1, 5):
        rows = rows.unionByName(cached_rows(spark, float(k), key=f"k{k}"))
    assert store.store(rows, chunk_size=2) >= 3
    got = store.lookup(keys).orderBy("frame_cache_key", "atom_i").collect()
    assert [(r.frame_cache_key, r.atom_i, r.cs_iso) for r in got] == [("k0", 0, 1.0), ("k0", 1, 2.0), ("k3", 0, 3.0)]
    seqs = [json.loads(x)["seq"] for p in store.index_dir.glob("*.jsonl") for x in p.read_text().splitlines()]
    assert len(set(seqs)) == 5
    with pytest.raises(ValueError):
        store.store(rows.drop("frame_cache_key"))
    assert store.store(rows.limit(0)) == 0


def test_canonical_and_complete(spark):
    rows = [("a", "0", 1.0, 0), ("a", "0", 2.0, 1), ("a", "1.000001", 3.0, 2), ("b", "0", 1.0, 3), ("b", "x", 1.0, 4), ("c", "1", 1.0, 5), (None, "0", 1.0, 6), ("d", "inf", 0.0, 7)]
    df = spark.createDataFrame(rows, "k string, atom_i string, v double, o int")
    good = canonical(df, "k", F.col("o"))
    assert sorted((r.k, r.atom_i, r.v) for r in good.collect()) == [("a", 0, 2.0), ("a", 1, 3.0), ("c", 1, 1.0)]
    assert [(r.k, r.n_atoms) for r in complete_keys(good, "k").collect()] == [("a", 2)]
    kept = prepare_rows(df.withColumnRenamed("k", "frame_cache_key"), F.col("o"))
    assert kept.where("frame_cache_key = 'b'").count() == 2


def test_pack_is_greedy(spark):
    sizes = [5, 5, 90, 3, 200, 1, 1, 1, 1]
    df = spark.createDataFrame([("g", i, b) for i, b in enumerate(sizes)], "g string, o bigint, bytes bigint")
    got = [r.chunk_no for r in pack(df, "o", "g", 3, 100).orderBy("o").collect()]
    want, no, n, held = [], 0, 0, 0
    for b in sizes:
        if n >= 3 or (n and held + b > 100):
            no, n, held = no + 1, 0, 0
        n, held = n + 1, held + b
        want.append(no)
    assert got == want


def test_compaction(spark, tmp_path):
    index = tmp_path / "index"
    index.mkdir()
    (index / "index_a.jsonl").write_text("\n".join([record("k", "1"), record("k", "2", at="2024-01-02T00:00:00Z", model_name="m"), record("k", "3", form="parquet"), '{"cache_key": "k']))
    done = compact_index(spark, tmp_path)
    assert (done["scanned_records"], done["kept_records"], done["removed_source_index_files"]) == (3, 2, 0)
    lines = Path(done["compacted_index_file"]).read_text().splitlines()
    assert [json.loads(x)["chunk_path"] for x in lines] == ["2", "3"] and '"model_name":"m"' in lines[0] and "model_name" not in lines[1]
    again = compact_index(spark, tmp_path, remove_source_indexes=True)
    assert again["removed_source_index_files"] == 2 and again["kept_records"] == 2 and len(list(index.iterdir())) == 1
    assert compact_index(spark, tmp_path / "new")["kept_records"] == 0


def test_index_tolerance(spark, tmp_path):
    path = tmp_path / "index_t.jsonl"
    good = json.loads(record("k", "c"))
    lines = [json.dumps(good | {"seq": s}) for s in ("5", 5.7, True, "x", None)] + ["[]", "", json.dumps(good | {"written_at_utc": "2024-01-01"}), json.dumps({k: v for k, v in good.items() if k != "writer_id"})]
    path.write_text("\r\n".join(lines))
    assert [(r.line_no, r.seq) for r in read_index(spark, [str(path)]).orderBy("line_no").collect()] == [(1, 5), (2, 5), (3, 1)]


# --- runs


def test_run_is_sorted_and_recorded(spark, tmp_path):
    source = write(tmp_path / "a.xyz", hco(cell=False), hco(2.0, cell=False))
    s = run_predict(spark, [source], config(tmp_path / "out", output_format="csv"), Ramp)
    df = pd.read_csv(s.output_path)
    assert list(df.columns) == ["structure_id", "source_file", "frame", "atom_i", "element", "x", "y", "z", "cs_iso", "frame_cache_key"]
    assert df[["frame", "atom_i"]].values.tolist() == [[f, a] for f in (0, 1) for a in range(3)] and df.cs_iso.tolist() == [1.0, 2.0, 3.0] * 2
    run = json.loads((tmp_path / "out/run.json").read_text())
    assert run["status"] == "success" and run["normalized_cell_pbc"] and len(run["cache_keys"]) == 2 and run["input_files"][0]["path"] == source
    assert s.warnings == [f"Missing cell/PBC normalized to zeros for frames: {source}#0, {source}#1"]
    assert {p.name for p in (tmp_path / "out").iterdir()} == {"results.csv", "run.json"}


def test_warning_policies(spark, tmp_path):
    bare, good, odd = write(tmp_path / "bare.xyz", hco(cell=False)), write(tmp_path / "good.xyz", hco()), write(tmp_path / "odd.xyz", "1\n\nHe 0 0 0\n")
    s = run_predict(spark, [bare, good], config(tmp_path / "o", on_warning="skip"), Ramp)
    assert s.frame_count == 1 and s.normalized_cell_pbc and len(s.warnings) == 1
    for given, kw in (([bare], {"on_warning": "skip"}), ([odd], {"on_warning": "skip"}), ([bare], {"on_warning": "error"}), ([bare], {"strict": True})):
        with pytest.raises(ValidationError):
            run_predict(spark, given, config(tmp_path / "o", **kw), Ramp)
    assert json.loads((tmp_path / "o/run.json").read_text())["status"] == "failed"
    nan = write(tmp_path / "nan.xyz", "1\n\nH nan 0 0\n")
    with pytest.raises(ValidationError, match="not finite"):
        run_predict(spark, [nan], config(tmp_path / "o"), Ramp)


def test_failures_and_dry_run(spark, tmp_path):
    source = write(tmp_path / "a.xyz", hco())
    with pytest.raises(BackendRuntimeError, match="boom"):
        run_predict(spark, [source], config(tmp_path / "f"), Failing)
    assert "boom" in json.loads((tmp_path / "f/run.json").read_text())["error"]
    with pytest.raises(MissingDependencyError):
        run_predict(spark, [source], config(tmp_path / "f"), None)
    s = run_predict(spark, [source], config(tmp_path / "d", dry_run=True), None)
    assert (s.frame_count, s.atom_count, s.cache_misses, s.cache_keys) == (1, 3, 1, []) and not list((tmp_path / "d").iterdir())


def test_cache_round_trip(spark, tmp_path):
    first = write(tmp_path / "a.xyz", hco(), hco(2.0))
    kw = dict(cache_dir=tmp_path / "cache", output_format="parquet", property_mode="both", committee=True)
    one = run_predict(spark, [first], config(tmp_path / "o1", **kw), Ramp)
    assert (one.cache_hits, one.cache_misses) == (0, 2)
    second = write(tmp_path / "b.xyz", hco(2.0), hco(), hco(2.0), hco(3.0))
    two = run_predict(spark, [second], config(tmp_path / "o2", **kw), Ramp)
    assert (two.cache_hits, two.cache_misses) == (3, 1)
    warm = run_predict(spark, [second], config(tmp_path / "o3", **kw), Failing)
    a, b = pd.read_parquet(two.output_path), pd.read_parquet(warm.output_path)
    pd.testing.assert_frame_equal(a, b)
    assert set(a.source_file) == {second} and len(a) == 12 and list(a.columns[8:11]) == ["cs_iso", "frame_cache_key", "cs_iso_uncertainty"]
    assert a.cs_yz.tolist()[:3] == [5.0, 14.0, 23.0] and a.cs_yz_uncertainty[0] == 0.5


def test_incomplete_cached_frame_is_a_miss(spark, tmp_path):
    source = write(tmp_path / "a.xyz", hco())
    kw = dict(cache_dir=tmp_path / "cache", output_format="csv")
    run_predict(spark, [source], config(tmp_path / "o", **kw), Ramp)
    (part,) = (tmp_path / "cache/chunks").rglob("part-*.csv")
    part.write_text("\n".join(part.read_text().splitlines()[:-1]) + "\n")
    part.with_name(f".{part.name}.crc").unlink(missing_ok=True)
    assert run_predict(spark, [source], config(tmp_path / "o", **kw), Ramp).cache_misses == 1


def test_order_of_many_chunks(spark, tmp_path):
    frames = ["1\nLattice=\"8 0 0 0 8 0 0 0 8\" pbc=\"T T T\"\nH {x} 0 0\n".format(x=x) for x in range(6)]
    s = run_predict(spark, [write(tmp_path / "m.xyz", *frames)], config(tmp_path / "o", workers=2, chunk_size=2, device="cpu"), ByX)
    assert pd.read_parquet(s.output_path).cs_iso.tolist() == [0.0, 1, 2, 3, 4, 5]
    assert allowed_workers("cuda", 2, False)[0] == 1 and allowed_workers("cuda", 2, True) == (2, [])


def test_magres(spark, tmp_path):
    text = '3\nLattice="8 0 0 0 9 0 0 0 10" pbc="T F T"\nH 0 0 0\nC 0 0 0.001953125\nO 0 1 0\n'
    source = write(tmp_path / "a.xyz", text)
    run_predict(spark, [source], config(tmp_path / "s", magres_mode="single"), Ramp)
    got = (tmp_path / "s/predictions.magres").read_text()
    assert "lattice 8.00000000 0.00000000 0.00000000 0.00000000 9.00000000" in got and "# pbc 1 0 1" in got
    assert "atom C C2 2 0.00000000 0.00000000 0.00195312" in got and "ms O 3 3.00000000 0.00000000" in got and got.endswith("[/magres]\n")
    run_predict(spark, [source], config(tmp_path / "p", magres_mode="per-frame", property_mode="tensor"), Ramp)
    (path,) = (tmp_path / "p/magres").iterdir()
    assert path.name.endswith("_f0.magres") and "ms H 1 0.00000000 1.00000000 2.00000000 1.00000000 4.00000000 5.00000000 2.00000000 5.00000000 8.00000000" in path.read_text()


def test_model_adapter():
    import numpy as np

    class Model:
        def get_cs(self, f):
            return [1.0, 2.0]

        def get_cs_committee(self, f):
            return [[1.0, 3.0], [2.0, 2.0]]

        def get_tensor(self, f):
            return np.ones((2, 3, 3))

    f = Structure(np.array([1, 1]), ["H", "H"], np.zeros((2, 3)), np.zeros((3, 3)), np.zeros(3))
    (p,) = ModelPredictor(lambda d: Model(), "cpu").predict([f], device="cpu", committee=True, property="both")
    assert p.cs_iso_uncertainty.tolist() == [1.0, 0.0] and p.tensor.shape == (2, 3, 3) and p.tensor_uncertainty is None


# --- command line


def run_cli(*args, cwd=None):
    return subprocess.run([sys.executable, "-m", "atomweft", *map(str, args)], capture_output=True, text=True, cwd=Path(__file__).parents[1], timeout=300)


def test_cli_in_process(capsys, tmp_path):
    assert main(["info"]) == 0 and json.loads(capsys.readouterr().out)["schema_version"] == "1"
    assert main(["average", str(tmp_path / "none.csv"), "--out", str(tmp_path / "o.csv"), "--format", "xml"]) == 2
    assert main(["predict", "x", "--out", str(tmp_path / "o"), "--device", "tpu"]) == 2
    assert main(["predict", "x", "--out", str(tmp_path / "o"), "--predictor", "no_such_module:f"]) in (3, 4)


def test_cli_process(tmp_path):
    source = write(tmp_path / "a.xyz", hco())
    done = run_cli("predict", source, "--out", tmp_path / "o", "--predictor", "tests.helpers:Ramp", "--format", "csv")
    assert done.returncode == 0, done.stderr[-800:]
    done = run_cli("average", tmp_path / "o/results.csv", "--out", tmp_path / "avg.parquet")
    assert done.returncode == 0 and pd.read_parquet(tmp_path / "avg.parquet").cs_iso.tolist() == [1.0, 2.0, 3.0]


def test_results_suffix(spark, tmp_path):
    with pytest.raises(ConfigError):
        read_results(spark, tmp_path / "x.csv")
    (tmp_path / "x.txt").write_text("")
    with pytest.raises(ConfigError):
        read_results(spark, tmp_path / "x.txt")


# --- stream


def test_streaming_manifest(spark, tmp_path):
    from atomweft.sources.index_log import read_index
    from atomweft.streaming.manifest import stream_latest

    (tmp_path / "index_a.jsonl").write_text("\n".join([record("k", "1"), record("k", "2", at="2024-02-01T00:00:00Z"), record("j", "3")]))
    query = stream_latest(spark, str(tmp_path)).writeStream.format("memory").queryName("latest").outputMode("complete").start()
    try:
        query.processAllAvailable()
        (tmp_path / "index_b.jsonl").write_text(record("j", "4", at="2024-03-01T00:00:00Z"))
        query.processAllAvailable()
        assert sorted((r.cache_key, r.chunk_path) for r in spark.table("latest").collect()) == [("j", "4"), ("k", "2")]
    finally:
        query.stop()
    assert read_index(spark, [str(tmp_path / "index_b.jsonl")]).count() == 1


def test_broken_and_mixed_chunks(spark, tmp_path):
    store = CacheStore(spark, tmp_path / "cache", "parquet")
    broken, keyless = tmp_path / "broken.parquet", tmp_path / "keyless.parquet"
    broken.write_bytes(b"no parquet")
    pd.DataFrame({"x": [1]}).to_parquet(keyless)
    iso, both = tmp_path / "iso.parquet", tmp_path / "both.parquet"
    pd.DataFrame({"frame_cache_key": ["i"], "atom_i": [0], "cs_iso": [1.0]}).to_parquet(iso)
    pd.DataFrame({"frame_cache_key": ["t"], "atom_i": [0], "cs_iso": [2.0], "cs_xx": [3.0]}).to_parquet(both)
    lines = [record(k, p, form="parquet", seq=i) for i, (k, p) in enumerate({"b": broken, "n": keyless, "i": iso, "t": both}.items())]
    (store.index_dir / "index_x.jsonl").write_text("\n".join(lines))
    keys = spark.createDataFrame([(k,) for k in "bnit"], "frame_cache_key string")
    assert sorted((r.frame_cache_key, r.cs_iso, r.cs_xx) for r in store.lookup(keys).collect()) == [("i", 1.0, None), ("t", 2.0, 3.0)]


def test_warning_of_many_frames_is_bounded(spark):
    from atomweft.operators.validate import missing_cell_text

    frames = spark.range(30).selectExpr("'a' as source_file", "id as frame", "id % 2 = 0 as normalized_cell_pbc")
    assert missing_cell_text(frames, 3).endswith("frames: a#0, a#2, a#4 and 12 more") and missing_cell_text(frames.where("frame = 1")) is None
