"""Structure files to frame rows: XYZ and extended XYZ, and by their names VASP's POSCAR, CIF, PDB and magres.

XYZ files are read in byte ranges by many tasks (trajectories.py), the other formats, which hold one structure or a few, file by file; a row is
one selected frame. What is wrong with a file comes back as a row with ``error``, so that the driver can name the first failing file.
"""

from __future__ import annotations

import functools
import glob
import re
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atomweft.errors import InputError
from atomweft.functions.columns import missing_cell
from atomweft.functions.digest import structure_id
from atomweft.sources.trajectories import scan_xyz

#: Element symbols in the order of their numbers, from 1.
SYMBOLS = (
    "H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br Kr Rb Sr Y Zr Nb Mo Tc Ru Rh Pd Ag Cd "
    "In Sn Sb Te I Xe Cs Ba La Ce Pr Nd Pm Sm Eu Gd Tb Dy Ho Er Tm Yb Lu Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Po At Rn Fr Ra Ac Th Pa U Np Pu "
    "Am Cm Bk Cf Es Fm Md No Lr Rf Db Sg Bh Hs Mt Ds Rg Cn Nh Fl Mc Lv Ts Og"
).split()
NUMBERS = {s: i for i, s in enumerate(SYMBOLS, 1)}
RAW = "source_file string, n_frames bigint, frame bigint, at bigint, numbers array<int>, element array<string>, positions array<double>, cell array<double>, pbc array<int>, error string"
_PAIR = re.compile(r"""(\w+)\s*=\s*(?:"([^"]*)"|\{([^}]*)\}|'([^']*)'|(\S+))""")
#: Values of a CIF text: text fields, comments (no group), quoted and bare words.
_CIF = re.compile(r"""^;(.*?)\n;|\#[^\n]*|'([^\n]*?)'(?=\s|\Z)|"([^\n]*?)"(?=\s|\Z)|(\S+)""", re.S | re.M)
_TERM = re.compile(r"([+-]?)(?:([xyz])|(\d+\.?\d*|\.\d+)(?:/(\d+))?)")
#: Images of a CIF site closer than this, in fractions of the cell, are one atom.
SAME_SITE = 1e-3
BATCH = 500


def resolve_inputs(inputs: list[str]) -> list[str]:
    """Absolute paths, distinct and sorted. An existing path wins over a pattern; one that matches nothing is an error."""
    found: set[str] = set()
    for given in inputs:
        matches = [given] if Path(given).exists() else glob.glob(given)
        if not matches:
            raise InputError(f"no file matches {given}")
        found |= {Path(m).resolve().as_posix() for m in matches}
    if not found:
        raise InputError("no input files were given")
    return sorted(found)


def parse_selector(text: str) -> slice | int:
    """``:``, Python slices and single indices. A bad index is an InputError, a bad slice bound a plain ValueError."""
    if ":" not in text:
        try:
            return int(text)
        except ValueError as e:
            raise InputError(f"not a frame selector: {text}") from e
    bounds = text.split(":")
    if len(bounds) > 3:
        raise InputError(f"not a frame selector: {text}")
    chosen = slice(*(int(b) if b else None for b in bounds))
    chosen.indices(0)  # a step of zero is refused here
    return chosen


def select_frames(text: str, n: int) -> list[int]:
    """Original indices of the chosen frames, in the order of the selector."""
    chosen = parse_selector(text)
    if isinstance(chosen, slice):
        return list(range(n))[chosen]
    at = chosen + n if chosen < 0 else chosen
    if not 0 <= at < n:
        raise InputError(f"frame {at} is out of bounds for {n} frames")
    return [at]


def _columns(properties: str) -> tuple[int, int, bool]:
    """(column of the element, first column of the position, element given by number) of an extended XYZ layout."""
    fields, at, places = properties.split(":"), 0, {}
    for name, _, width in zip(fields[::3], fields[1::3], fields[2::3]):
        places[name.lower()] = at
        at += int(width)
    kind = "species" if "species" in places else "z"
    return places[kind], places["pos"], kind == "z"


def parse_xyz(text: str) -> Iterator[dict]:
    """Frames of an XYZ text, in order."""
    lines = re.split("\r\n|[\r\n]", text)
    if not lines[-1]:
        lines.pop()
    at = 0
    while at < len(lines):
        if not lines[at].strip():
            at += 1
            continue
        n = int(lines[at])
        if n < 0 or len(lines) < at + 2 + n:
            raise ValueError(f"line {at + 1}: {n} atoms are announced")
        info = {m[1].lower(): next(g for g in m.groups()[1:] if g is not None) for m in _PAIR.finditer(lines[at + 1])}
        element_at, position_at, by_number = _columns(info.get("properties", "species:S:1:pos:R:3"))
        numbers, positions = [], []
        for line in lines[at + 2 : at + 2 + n]:
            parts = line.split()
            name = parts[element_at]
            number = int(name) if by_number or name.isdigit() else NUMBERS[name.capitalize()]
            numbers.append(number)
            positions += map(float, parts[position_at : position_at + 3])
        if len(positions) != 3 * n:
            raise ValueError(f"line {at + 1}: positions are incomplete")
        cell = [float(x) for x in info["lattice"].split()] if "lattice" in info else [0.0] * 9
        if len(cell) == 3:
            cell = [cell[0], 0, 0, 0, cell[1], 0, 0, 0, cell[2]]
        pbc = [int(x.upper() in ("T", "TRUE", "1")) for x in info["pbc"].split()] if "pbc" in info else [int("lattice" in info)] * 3
        yield {"numbers": numbers, "element": [SYMBOLS[z - 1] if z else "X" for z in numbers], "positions": positions, "cell": [float(x) for x in cell], "pbc": pbc * 3 if len(pbc) == 1 else pbc}
        at += 2 + n


def parse_poscar(text: str) -> Iterator[dict]:
    """The one frame of a POSCAR text: a periodic cell, with direct or Cartesian positions. A negative scale is the cell's volume."""
    lines = text.splitlines()
    scale = float(lines[1].split()[0])
    cell = np.array([[float(x) for x in line.split()[:3]] for line in lines[2:5]])
    cell *= scale if scale > 0 else (-scale / abs(np.linalg.det(cell))) ** (1 / 3)
    counts = [int(x) for x in lines[6].split()]
    numbers = [NUMBERS[s.capitalize()] for s, n in zip(lines[5].split(), counts) for _ in range(n)]
    at = 8 if lines[7].strip()[:1].lower() == "s" else 7
    points = np.array([[float(x) for x in line.split()[:3]] for line in lines[at + 1 : at + 1 + len(numbers)]]).reshape(-1, 3)
    if len(points) != len(numbers):
        raise ValueError(f"{len(numbers)} atoms are announced")
    cartesian = lines[at].strip()[:1].lower() in ("c", "k")
    points = points * (scale if scale > 0 else 1.0) if cartesian else points @ cell
    yield {"numbers": numbers, "element": [SYMBOLS[z - 1] for z in numbers], "positions": points.ravel().tolist(), "cell": cell.ravel().tolist(), "pbc": [1, 1, 1]}


def _frame(symbols: list[str], points: np.ndarray, cell: np.ndarray | None) -> dict:
    """A frame, periodic if it has a cell; deuterium counts as hydrogen."""
    numbers = [NUMBERS["H" if s in ("D", "d") else s.capitalize()] for s in symbols]
    cell = np.zeros(9) if cell is None else np.asarray(cell, float)
    return {"numbers": numbers, "element": [SYMBOLS[z - 1] for z in numbers], "positions": np.asarray(points, float).ravel().tolist(), "cell": cell.ravel().tolist(), "pbc": [int(cell.any())] * 3}


def cell_of(a: float, b: float, c: float, alpha: float, beta: float, gamma: float) -> np.ndarray:
    """Cell vectors of lengths and angles in degrees: the first along x, the second in the plane of x and y."""
    if not all(0 < angle < 180 for angle in (alpha, beta, gamma)):
        raise ValueError(f"no cell has the angles {alpha}, {beta}, {gamma}")
    x, y, z = (0.0 if abs(angle - 90) < 1e-10 else float(np.cos(np.radians(angle))) for angle in (alpha, beta, gamma))
    sine = np.sqrt(1 - z * z)
    up = (x - y * z) / sine
    if not (height := 1 - y * y - up * up) > 0:
        raise ValueError(f"no cell has the angles {alpha}, {beta}, {gamma}")
    return np.array([[a, 0, 0], [b * z, b * sine, 0], [c * y, c * up, c * np.sqrt(height)]])


def _cif_blocks(text: str) -> Iterator[dict[str, list[str]]]:
    """The data blocks of a CIF text: values by lower-case name, a list for each."""
    block: dict[str, list[str]] | None = None
    names, loop, seen = [], False, 0
    for m in _CIF.finditer(text):
        if m.lastindex is None:
            continue
        word, bare = m[m.lastindex], m.lastindex == 4
        low = word.lower() if bare else ""
        if low.startswith("data_"):
            if block is not None:
                yield block
            block, names = {}, []
        elif block is None:
            raise ValueError("a value stands before the first data block")
        elif low == "loop_":
            names, loop, seen = [], True, 0
        elif low.startswith("_"):
            if not loop or seen:
                names, loop, seen = [], False, 0
            names.append(low)
            block[low] = []
        elif names:
            block[names[seen % len(names)]].append(word)
            seen += 1
    if block is not None:
        yield block


def symmetry_operation(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Rotation and shift of an operation such as ``-x+1/2, y, -z``."""
    parts = text.lower().replace(" ", "").split(",")
    if len(parts) != 3:
        raise ValueError(f"not a symmetry operation: {text}")
    turn, shift = np.zeros((3, 3)), np.zeros(3)
    for k, part in enumerate(parts):
        for sign, axis, number, below in _TERM.findall(part):
            value = -1.0 if sign == "-" else 1.0
            if axis:
                turn[k, "xyz".index(axis)] += value
            else:
                shift[k] += value * float(number) / float(below or 1)
    return turn, shift


def parse_cif(text: str) -> Iterator[dict]:
    """A frame for each data block with atom sites: every site's distinct images under the listed symmetry operations, inside the cell.

    Standard uncertainties are dropped. A block of a space group other than P 1 must list its operations; occupancies are not read.
    """
    for block in _cif_blocks(text):
        site = lambda name: block.get(f"_atom_site_{name}")
        given = next((axes for kind in ("fract", "cartn") if all(axes := [site(f"{kind}_{k}") for k in "xyz"])), None)
        if given is None:
            continue
        number = lambda word: float(word.partition("(")[0])
        cell = cell_of(*(number(block[f"_cell_{n}"][0]) for n in ("length_a", "length_b", "length_c", "angle_alpha", "angle_beta", "angle_gamma")))
        points = np.array([[number(word) for word in axis] for axis in given]).T
        points = points if site("fract_x") else points @ np.linalg.inv(cell)
        listed = next((block[n] for n in ("_space_group_symop_operation_xyz", "_symmetry_equiv_pos_as_xyz", "_space_group_symop.operation_xyz") if block.get(n)), None)
        if listed is None:
            group = next((block[n][0] for n in ("_space_group_name_h-m_alt", "_symmetry_space_group_name_h-m", "_space_group_it_number", "_symmetry_int_tables_number") if block.get(n)), "1")
            if group.replace(" ", "").upper() not in ("P1", "1", "?", "."):
                raise ValueError(f"the operations of the space group {group} are not listed")
            listed = ["x,y,z"]
        operations = [symmetry_operation(x) for x in listed]
        symbols, images = [], []
        for name, point in zip(site("type_symbol") or site("label"), points):
            kept: list[np.ndarray] = []
            for turn, shift in operations:
                image = (turn @ point + shift) % 1.0
                if all(np.abs(d - np.round(d)).max() > SAME_SITE for d in (image - k for k in kept)):
                    kept.append(image)
            images += kept
            symbols += [re.match("[A-Z][a-z]?", name)[0]] * len(kept)
        yield _frame(symbols, np.array(images) @ cell, cell)


def parse_pdb(text: str) -> Iterator[dict]:
    """A frame for each model of a PDB text, or one; CRYST1 gives the cell."""
    cell, symbols, points = None, [], []
    for line in [*text.splitlines(), "END"]:
        if line.startswith("CRYST1"):
            cell = cell_of(*(float(line[k:n]) for k, n in ((6, 15), (15, 24), (24, 33), (33, 40), (40, 47), (47, 54))))
        elif line.startswith(("ATOM  ", "HETATM")):
            symbols.append(line[76:78].strip() or line[12:14].strip(" 0123456789"))
            points.append([float(line[k : k + 8]) for k in (30, 38, 46)])
        elif line.startswith("END") and symbols:
            yield _frame(symbols, np.array(points), cell)
            symbols, points = [], []


def parse_magres(text: str) -> Iterator[dict]:
    """A frame for each block of atoms of a magres text, in Angstrom."""
    cell, symbols, points, inside = None, [], [], False
    for line in text.splitlines():
        parts = line.partition("#")[0].split()
        if not parts:
            continue
        if parts[0].strip("[]<>") in ("atoms", "/atoms"):
            inside = "/" not in parts[0]
            if not inside:
                yield _frame(symbols, np.array(points), cell)
            cell, symbols, points = None, [], []
        elif inside and parts[0] == "units" and parts[1] in ("atom", "lattice") and parts[2] != "Angstrom":
            raise ValueError(f"unit {parts[2]} of {parts[1]}")
        elif inside and parts[0] == "lattice":
            cell = np.array([float(x) for x in parts[1:10]]).reshape(3, 3)
        elif inside and parts[0] == "atom":
            symbols.append(parts[1])
            points.append([float(x) for x in parts[-3:]])


def parser(path: str):
    """What reads the frames of a file, told by its name."""
    name = path.rpartition("/")[2].lower()
    if name.startswith(("poscar", "contcar")):
        return parse_poscar
    known = {"poscar": parse_poscar, "vasp": parse_poscar, "cif": parse_cif, "pdb": parse_pdb, "magres": parse_magres}
    return known.get(name.rpartition(".")[2], parse_xyz)


def _scan(selector: str):
    names = [x.split()[0] for x in RAW.split(", ")]

    def rows(path: str, content: bytes) -> Iterator[dict]:
        try:
            frames = list(parser(path)(content.decode("utf-8")))
            if not frames:
                raise InputError(f"the file has no frames: {path}")
            chosen = select_frames(selector, len(frames))
        except InputError as e:
            yield dict.fromkeys(names) | {"source_file": path, "error": str(e)}
            return
        except Exception as e:
            yield dict.fromkeys(names) | {"source_file": path, "error": f"structures cannot be read from {path}: {type(e).__name__} {e}"}
            return
        for at, frame in enumerate(chosen):
            yield {"source_file": path, "n_frames": len(frames), "frame": frame, "at": at, **frames[frame], "error": None}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                held = []
                for row in rows(re.sub("^file:/+", "/", path), content):
                    held.append(row)
                    if len(held) == BATCH:
                        yield pd.DataFrame(held, columns=names)
                        held = []
                if held:
                    yield pd.DataFrame(held, columns=names)

    return run


def scan(spark: SparkSession, files: list[str], selector: str = ":") -> DataFrame:
    """A row per selected frame with the columns of RAW; a row with ``error`` per unreadable file."""
    chosen = parse_selector(selector)
    long = [f for f in files if parser(f) is parse_xyz]
    parts = [scan_xyz(spark, long, chosen, parse_xyz)] if long else []
    if small := sorted(set(files) - set(long)):
        parts.append(spark.read.format("binaryFile").load(small).select("path", "content").mapInPandas(_scan(selector), RAW))
    return functools.reduce(DataFrame.unionByName, parts)


def as_frames(raw: DataFrame, files: list[str]) -> DataFrame:
    """Frame rows (schema.FRAMES) of scanned rows: cell and periodicity normalised, content hash and load order added."""
    order = raw.sparkSession.createDataFrame([(f, i) for i, f in enumerate(files)], "source_file string, file_ord bigint")
    missing = missing_cell(F.col("cell"), F.col("pbc"))
    rows = raw.where("error IS NULL").join(F.broadcast(order), "source_file").withColumn("normalized_cell_pbc", missing)
    rows = rows.withColumns({"cell": F.when(missing, F.array_repeat(F.lit(0.0), 9)).otherwise(F.col("cell")), "pbc": F.when(missing, F.array_repeat(F.lit(0), 3)).otherwise(F.col("pbc"))})
    xyz = F.transform(F.sequence(F.lit(0), F.size("numbers") - 1), lambda i: F.struct(*(F.get("positions", i * 3 + k).alias(a) for k, a in enumerate("xyz"))))
    return rows.select(
        (F.col("file_ord") * F.lit(1 << 32) + F.col("at")).alias("frame_ord"),
        "source_file",
        "frame",
        structure_id("numbers", "positions", "cell", "pbc").alias("structure_id"),
        "normalized_cell_pbc",
        "numbers",
        "element",
        F.when(F.size("numbers") > 0, xyz).otherwise(F.array().cast("array<struct<x: double, y: double, z: double>>")).alias("positions"),
        "cell",
        "pbc",
    )


def load_structures(spark: SparkSession, inputs: list[str], selector: str = ":", keep: Callable[[DataFrame], DataFrame] = DataFrame.persist) -> DataFrame:
    """Frames of all inputs. The first unreadable file, or no selected frame at all, is an InputError. ``keep`` holds the scanned rows for the caller."""
    files = resolve_inputs(inputs)
    raw = keep(scan(spark, files, selector))
    bad = raw.where("error IS NOT NULL").select("source_file", "error").orderBy("source_file").limit(1).collect()
    if bad:
        raise InputError(bad[0].error)
    if not raw.limit(1).count():
        raise InputError("no frames were selected from the inputs")
    return as_frames(raw, files)
