"""Files read in byte ranges and written as one by many tasks."""

import csv
import json
import random
import re
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from atomweft.errors import InputError
from atomweft.operators.store import compact_index
from atomweft.sinks import concatenate, write_magres, write_table
from atomweft.sources.index_log import read_lines
from atomweft.sources.structures import load_structures, parse_selector, parse_xyz, select_frames
from atomweft.sources.trajectories import cut_frames, place


@pytest.fixture
def small_blocks(spark):
    """Files are read in ranges of 300 bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    old = {n: spark.conf.get(n, None) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in old.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def trajectory(rng, frames=120):
    """Frames of none to nine atoms; comments are text, blank or a lone number, and blank lines stand between some frames."""
    out = []
    for k in range(frames):
        n = rng.choice([0, 1, 1, 2, 3, 9])
        out += [str(n), rng.choice(["", "7", "frame", 'Lattice="8 0 0 0 8 0 0 0 8"', "0"])]
        out += [f"{rng.choice('HCNO')} {k} {i} {rng.randrange(9)}" for i in range(n)]
        out += [""] * rng.choice([0, 0, 0, 2])
    return "\n".join(out) + rng.choice(["", "\n"])


def test_frames_of_any_cut_are_those_of_the_file():
    rng = random.Random(4)
    for _ in range(60):
        text = trajectory(rng, 30)
        lines = [x.encode() for x in text.split("\n")]
        cuts = sorted(rng.sample(range(1, len(lines)), min(5, len(lines) - 1)))
        held, got = b"", []
        join = lambda part: b"".join(x + b"\n" for x in part)
        for a, b in zip([0, *cuts], [*cuts, len(lines)]):
            for kind, part in cut_frames(iter(lines[a:b]), a == 0):
                if kind == "frame":
                    got += parse_xyz(join(part).decode())
                elif kind == "head":
                    held += join(part)
                    started = a == 0
                else:
                    tail, started = join(part), True
            if started:  # what is held is whole once a start is sure
                inner = [list(parse_xyz(join(p).decode()))[0] for k, p in cut_frames(iter(lines[a:b]), a == 0) if k == "frame"]
                got = got[: len(got) - len(inner)] + list(parse_xyz(held.decode() or "\n")) + inner
                held = tail
        got += list(parse_xyz(held.decode() or "\n"))
        assert got == list(parse_xyz(text))


@pytest.mark.parametrize("selector", [":", "-5:", "::-1", "3:90:4", "-1", "90:3:-7", "5:2"])
def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_blocks, selector):
    rng = random.Random(7)
    texts = {f"t{k}.xyz": trajectory(rng) for k in range(2)}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    want = []
    for k, text in enumerate(texts.values()):
        frames = list(parse_xyz(text))
        want += [((k << 32) + at, f, tuple(frames[f]["element"]), tuple(frames[f]["positions"])) for at, f in enumerate(select_frames(selector, len(frames)))]
    if not want:
        with pytest.raises(InputError):
            load_structures(spark, [str(tmp_path / "*.xyz")], selector)
        return
    found = load_structures(spark, [str(tmp_path / "*.xyz")], selector)
    got = [(r.frame_ord, r.frame, tuple(r.element), tuple(x for p in r.positions for x in (p.x, p.y, p.z))) for r in found.collect()]
    assert sorted(got) == sorted(want)
    assert spark.read.text(str(tmp_path / "t0.xyz")).select("_metadata.file_block_start").distinct().count() > 5


def test_broken_trajectories(spark, tmp_path, small_blocks):
    good = trajectory(random.Random(1))
    for name, text, message in [("a", "", "no frames"), ("b", " \n\n", "no frames"), ("c", good + "\n3\nx\nH 0 0 0\n", "announced"), ("d", good + "\n1\nx\nH 0 zero 0\n" + good, "cannot be read"), ("e", good + "\n2\n\nH 0 0 0\n\n" + good, "cannot be read")]:
        (tmp_path / f"{name}.xyz").write_text(text)
        with pytest.raises(InputError, match=message):
            load_structures(spark, [str(tmp_path / f"{name}.xyz")])
    (tmp_path / "f.xyz").write_text("1\n\nH 0 0 0\n")
    with pytest.raises(InputError, match="out of bounds"):
        load_structures(spark, [str(tmp_path / "f.xyz")], "-2")
    (tmp_path / "g.xyz").write_bytes(b"1\n\xff\xfe\nH 0 0 0\n")
    with pytest.raises(InputError, match="UnicodeDecodeError"):
        load_structures(spark, [str(tmp_path / "g.xyz")])


def test_places_of_selectors(spark):
    frames = spark.range(9).select(F.col("id").alias("frame"))
    for text in (":", "2:", ":-2", "::2", "::-1", "-3:", "7:1:-3", "-100:100", "100:-100:-2", "0", "-9", "5:5"):
        for n in (1, 4, 9):
            rows = frames.where(F.col("frame") < n).select("frame", place(parse_selector(text), F.col("frame"), F.lit(n)).alias("at")).where("at IS NOT NULL").orderBy("at").collect()
            want = select_frames(text, n) if text not in ("-9",) or n == 9 else []
            assert [(r.at, r.frame) for r in rows] == list(enumerate(want))


def test_lines_are_numbered_across_ranges(spark, tmp_path, small_blocks):
    rng = random.Random(2)
    want = []
    for name in ("one", "two", "none"):
        lines = ["x" * rng.choice([0, 3, 40, 900]) + str(k) for k in range(0 if name == "none" else 300)]
        ends = [rng.choice(["\n", "\r\n", "\r"]) for _ in lines]
        (tmp_path / name).write_bytes("".join(a + b for a, b in zip(lines, ends)).encode())
        want += [(name, k, x) for k, x in enumerate(lines, 1)]
    rows = read_lines(spark, [str(tmp_path / n) for n in ("one", "two", "none")])
    assert sorted(tuple(r) for r in rows.select("index_path", "line_no", "line").collect()) == sorted(want)


def test_single_files_are_sorted_and_put_together_by_many_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(5000).select(F.format_string("s%02d", F.col("id") % 7).alias("source_file"), F.col("id").alias("frame"), F.when(F.col("id") % 3 > 0, F.col("id") / 8).alias("cs_iso"), F.lit("one, two").alias("a,b"))
        want = sorted((r.source_file, r.frame, r.cs_iso) for r in rows.collect())
        order = ["source_file", "frame"]
        assert rows.orderBy(*order).rdd.getNumPartitions() > 3
        path = write_table(rows, tmp_path / "r.csv", "csv", order)
        with path.open(newline="") as f:
            head, *lines = csv.reader(f)
        assert head == rows.columns and [(a, int(b), float(c) if c else None) for a, b, c, _ in lines] == want
        path = write_table(rows, tmp_path / "r.parquet", "parquet", order)
        assert [tuple(r.values())[:3] for r in pq.read_table(path).to_pylist()] == want and spark.read.parquet(str(path)).dtypes == rows.dtypes
        for form in ("csv", "parquet"):
            empty = write_table(rows.where("false"), tmp_path / f"e.{form}", form, order)
            assert spark.read.format(form).option("header", True).load(str(empty)).columns == rows.columns
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(p.name for p in tmp_path.iterdir()) == ["e.csv", "e.parquet", "r.csv", "r.parquet"]


def test_concatenation_of_nothing_and_of_ends(spark, tmp_path):
    concatenate(spark, [], tmp_path / "none", b"head\n", cut=1)
    parts = [tmp_path / f"p{k}" for k in range(12)]
    for k, p in enumerate(parts):
        p.write_bytes(bytes([65 + k]) * (k * 1000))
    concatenate(spark, parts[::-1], tmp_path / "all", b"<", cut=2)
    assert (tmp_path / "none").read_bytes() == b"head\n" and (tmp_path / "all").read_bytes() == b"<" + b"".join(p.read_bytes() for p in parts[::-1])[:-2]


def test_magres_of_many_frames(spark, tmp_path):
    rows = spark.range(600).selectExpr("format_string('s%03d', id div 2) structure_id", "id div 2 frame", "id % 2 atom_i", "'H' element", "0D x", "1D y", "cast(id as double) z", "cast(id as double) cs_iso")
    (one,) = write_magres(rows, tmp_path, "single")
    (folder,) = write_magres(rows, tmp_path, "per-frame")
    each = [p.read_text() for p in sorted(Path(folder).iterdir())]
    assert len(each) == 300 and one.read_text() == "\n".join(each) and [float(re.search(r"ms H 1 (\S+)", t)[1]) for t in each] == [2.0 * k for k in range(300)]
    assert write_magres(rows, tmp_path / "n", "none") == [] and not (tmp_path / "n").exists()
    (empty,) = write_magres(rows.where("false"), tmp_path / "e", "single")
    assert empty.read_text() == ""


def test_compaction_of_many_records(spark, tmp_path, small_blocks):
    index = tmp_path / "index"
    index.mkdir()
    for w in "ab":
        record = lambda k: json.dumps({"cache_key": f"k{k % 400:03d}", "chunk_path": f"{w}{k}", "output_format": "csv", "seq": k, "writer_id": w, "written_at_utc": "2024-01-01T00:00:00Z"})  # noqa: B023, E731
        (index / f"index_{w}.jsonl").write_text("\n".join(record(k) for k in range(1000)))
    done = compact_index(spark, tmp_path, remove_source_indexes=True)
    lines = [json.loads(x) for x in Path(done["compacted_index_file"]).read_text().splitlines()]
    assert (done["scanned_records"], done["kept_records"], len(list(index.iterdir()))) == (2000, 400, 1)
    assert [(x["cache_key"], x["chunk_path"]) for x in lines] == [(f"k{k:03d}", f"b{k + 800 if k < 200 else k + 400}") for k in range(400)]
