"""Files named by registry rows: existence, size, hash, predictor metrics, structures, FASTA.

Paths are columns.  Each different path is looked at once, on the
executors, through ``pyarrow.fs``; files are streamed, so their size
doesn't matter.
"""

from __future__ import annotations

import hashlib
import json
import posixpath
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Predictor output keys, normalised, and the metric they hold.
PREDICTOR_KEYS = {
    "plddt": "plddt", "plddt_binder": "plddt",
    "iptm": "iptm", "i_ptm": "iptm", "iptm_complex": "iptm",
    "ptm": "ptm",
    "i_pae": "i_pae", "ipae": "i_pae", "pae": "i_pae", "min_pae": "i_pae", "interface_pae": "i_pae",
    "rmsd": "rmsd", "monomer_rmsd": "rmsd", "monomer_rmsd_a": "rmsd",
    "affinity_prob": "boltz2_affinity_prob", "affinity_probability": "boltz2_affinity_prob", "binding_prob": "boltz2_affinity_prob",
}

# Three-letter and one-letter names of the amino acids.
RESIDUES = {
    "ALA": "A", "CYS": "C", "ASP": "D", "GLU": "E", "PHE": "F", "GLY": "G", "HIS": "H", "ILE": "I", "LYS": "K", "LEU": "L",
    "MET": "M", "ASN": "N", "PRO": "P", "GLN": "Q", "ARG": "R", "SER": "S", "THR": "T", "VAL": "V", "TRP": "W", "TYR": "Y",
}


def open_uri(uri: str):
    """(file system, path on it) of a URI or a local path."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri if "://" in uri else posixpath.abspath(uri))
    return system, path


def find(path: str | None, bases: list[str]) -> str | None:
    """Where a path leads: an absolute path or URI itself, a relative one under the first base that has it; None if there's nothing."""
    from pyarrow import fs

    if not path:
        return None
    for place in [path] if path.startswith("/") or "://" in path else [f"{base.rstrip('/')}/{path}" for base in bases]:
        system, full = open_uri(place)
        if system.get_file_info(full).type != fs.FileType.NotFound:
            return place
    return None


def sha256_file(uri: str, chunk: int = 1 << 20) -> str:
    system, path = open_uri(uri)
    digest = hashlib.sha256()
    with system.open_input_stream(path, compression=None) as stream:
        while block := stream.read(chunk):
            digest.update(block)
    return digest.hexdigest()


def read_text(uri: str) -> str:
    system, path = open_uri(uri)
    with system.open_input_stream(path, compression=None) as stream:
        return stream.read().decode("utf-8")


def write_text(uri: str, text: str) -> None:
    """Write a text file, in place of one that is there."""
    system, path = open_uri(uri)
    with system.open_output_stream(path, compression=None) as out:
        out.write(text.encode("utf-8"))


def make_folder(uri: str) -> None:
    system, path = open_uri(uri)
    system.create_dir(path)


def write_texts(rows: DataFrame, folder: str) -> int:
    """Write rows (name, text) as files of a folder, by the executors; returns their number.  A null text is an empty file."""
    make_folder(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                write_text(f"{folder}/{name}", text or "")
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    return rows.select("name", "text").mapInArrow(write, "n long").agg(F.sum("n").alias("n")).first()["n"] or 0


def remove_tree(uri: str) -> None:
    """Delete a folder and all in it, if it is there."""
    from pyarrow import fs

    system, path = open_uri(uri)
    if system.get_file_info(path).type == fs.FileType.Directory:
        system.delete_dir(path)


def _per_path(paths: DataFrame, one: Callable[[str], tuple], schema: str, types: list[pa.DataType], names: list[str]) -> DataFrame:
    """``one`` for every different non-null value of column ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(p, *one(p)) for p in batch.column(0).to_pylist()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.string(), *types], strict=True)], ["path", *names])

    return paths.select("path").where("path is not null").distinct().mapInArrow(run, f"path string, {schema}")


def probe(paths: DataFrame, bases: list[str], hashed: bool = False) -> DataFrame:
    """(path, found, size, sha256): where a path leads, and the file's size and hash; nulls where there's no file."""

    def one(path: str) -> tuple:
        from pyarrow import fs

        where = find(path, bases)
        if where is None:
            return None, None, None
        system, full = open_uri(where)
        info = system.get_file_info(full)
        if info.type != fs.FileType.File:
            return (where if info.type == fs.FileType.Directory else None), None, None
        return where, info.size, sha256_file(where) if hashed else None

    return _per_path(paths, one, "found string, size long, sha256 string", [pa.string(), pa.int64(), pa.string()], ["found", "size", "sha256"])


def flatten_metrics(data: object) -> dict[str, float]:
    """Known metrics in nested JSON, level by level in document order; the first of a name counts, strings don't."""
    found: dict[str, float] = {}
    level = [data]
    while level:
        below = []
        for node in level:
            if isinstance(node, dict):
                for key, value in node.items():
                    name = PREDICTOR_KEYS.get(str(key).strip().lower().replace("-", "_").replace(" ", ""))
                    if name and isinstance(value, int | float):
                        found.setdefault(name, float(value))
                    if isinstance(value, dict):
                        below.append(value)
                    elif isinstance(value, list):
                        below += [x for x in value if isinstance(x, dict)]
        level = below
    return found


def predictor_metrics(paths: DataFrame, bases: list[str]) -> DataFrame:
    """(path, found, values): metrics of predictor outputs; only readable ``.json`` has any."""

    def one(path: str) -> tuple:
        where = find(path, bases)
        if where is None or not where.lower().endswith(".json"):
            return where, []
        try:
            return where, list(flatten_metrics(json.loads(read_text(where))).items())
        except (OSError, ValueError):
            return where, []

    return _per_path(paths, one, "found string, values map<string,double>", [pa.string(), pa.map_(pa.string(), pa.float64())], ["found", "values"])


def binder_chain(text: str) -> list[tuple[str, tuple[float, float, float] | None]] | None:
    """(residue, CA place) along chain B, or else the shortest chain, in the first model of PDB text; X for other residues; None without chains."""
    chains: dict[str, dict[tuple, list]] = {}
    sizes: dict[str, set] = {}
    for line in text.splitlines():
        kind = line[:6]
        if kind == "ENDMDL":
            break
        if kind in ("ATOM  ", "HETATM"):
            chain, place = line[21:22], (kind, line[22:27])
            sizes.setdefault(chain, set()).add(place)
            chains.setdefault(chain, {})
            if kind == "ATOM  ":
                residue = chains[chain].setdefault(place, [RESIDUES.get(line[17:20].strip(), "X"), None])
                if line[12:16].strip() == "CA" and residue[1] is None:
                    residue[1] = line[30:54]
    if not chains:
        return None
    chosen = "B" if "B" in chains else min(chains, key=lambda c: len(sizes[c]))
    at = lambda x: tuple(float(x[i : i + 8]) for i in (0, 8, 16)) if x else None
    return [(letter, at(where)) for letter, where in chains[chosen].values()]


def binder_sequence(text: str) -> str | None:
    """Sequence of the binder's chain; None without chains."""
    chain = binder_chain(text)
    return None if chain is None else "".join(letter for letter, _ in chain)


def structures(paths: DataFrame, bases: list[str]) -> DataFrame:
    """(path, found, sequence, error) of PDB files; other files have neither sequence nor error."""

    def one(path: str) -> tuple:
        where = find(path, bases)
        if where is None or not where.lower().endswith(".pdb"):
            return where, None, None
        try:
            sequence = binder_sequence(read_text(where))
        except FileNotFoundError:
            return None, None, None
        except (OSError, ValueError) as error:
            return where, None, f"not readable: {error}"
        return where, sequence, None if sequence is not None else "no chain"

    return _per_path(paths, one, "found string, sequence string, error string", [pa.string()] * 3, ["found", "sequence", "error"])


def traces(paths: DataFrame, bases: list[str]) -> DataFrame:
    """(path, found, xyz): places of the CA atoms of the binder's chain, one after another; null where none can be read."""

    def one(path: str) -> tuple:
        where = find(path, bases)
        if where is None or not where.lower().endswith(".pdb"):
            return where, None
        try:
            chain = binder_chain(read_text(where)) or []
        except (OSError, ValueError):
            return where, None
        return where, [x for _, place in chain if place for x in place] or None

    return _per_path(paths, one, "found string, xyz array<double>", [pa.string(), pa.list_(pa.float64())], ["found", "xyz"])


def pdb_atoms(text: str) -> list[tuple]:
    """(atom, side, residue_no, residue, name, element, x, y, z) of the first model's ATOM lines; lines without a place are left out."""
    out = []
    for line in text.splitlines():
        if line.startswith("ENDMDL"):
            break
        if line.startswith("ATOM  "):
            try:
                place = tuple(float(line[i : i + 8]) for i in (30, 38, 46))
            except ValueError:
                continue
            name = line[12:16].strip()
            out.append((len(out) + 1, line[21:22], line[22:27].strip(), line[17:20].strip(), name, line[76:78].strip() or name.lstrip("0123456789")[:1], *place))
    return out


def atoms(paths: DataFrame, bases: list[str]) -> DataFrame:
    """(structure, atom, side, residue_no, residue, name, element, x, y, z) of PDB files; ``structure`` is the path as given."""
    fields = [("atom", pa.int64()), ("side", pa.string()), ("residue_no", pa.string()), ("residue", pa.string()), ("name", pa.string()), ("element", pa.string()), *[(c, pa.float64()) for c in "xyz"]]

    def one(path: str) -> tuple:
        where = find(path, bases)
        try:
            read = pdb_atoms(read_text(where)) if where and where.lower().endswith(".pdb") else []
        except (OSError, ValueError):
            read = []
        return where, [dict(zip([n for n, _ in fields], row, strict=True)) for row in read]

    schema = "array<struct<atom:long,side:string,residue_no:string,residue:string,name:string,element:string,x:double,y:double,z:double>>"
    found = _per_path(paths, one, f"found string, atoms {schema}", [pa.string(), pa.list_(pa.struct(fields))], ["found", "atoms"])
    return found.select(F.col("path").alias("structure"), F.explode("atoms").alias("a")).select("structure", "a.*")


def read_fasta(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, header, sequence) of FASTA files; wrapped lines are joined, records without sequence are left out.

    Text before the first header is a record with null header.
    """
    whole = spark.read.text(paths, wholetext=True).select(F.input_file_name().alias("file"), F.concat(F.lit("\n"), "value").alias("value"))
    parts = whole.select("file", F.posexplode(F.split("value", r"\n>")).alias("pos", "part"))
    lines = F.split("part", r"\r?\n")
    body = F.when(F.col("pos") == 0, lines).otherwise(F.slice(lines, 2, F.size(lines)))
    joined = F.array_join(F.transform(body, lambda x: F.trim(x)), "")
    return parts.select("file", F.when(F.col("pos") > 0, lines[0]).alias("header"), joined.alias("sequence")).where("sequence <> ''")
