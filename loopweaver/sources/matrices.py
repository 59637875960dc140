"""Matrices that other tools imputed, as a data source that reads one file in many tasks.

An npz file holds a dense square matrix, whose rows are dealt into stretches: a member that is stored is read from the
stretch's place on, one that is deflated is inflated up to its end. An HDF5 file holds `coordinates` and one `cell_<k>` per
cell; its partitions are stretches of one cell's values (h5py is needed). Chromosomes are named by the option `chrom`, or by
files called <cell>.<chrom>.npz; the option `chroms` leaves out files of others before they are opened. (That is an option and
no pushed filter, as Spark 4.1 keeps the filters of one query for later queries of the same DataFrame.)
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "cell string, chrom string, i bigint, j bigint, v double"
#: Bytes of a partition, about.
STRETCH_BYTES = 64 << 20
#: Pairs of a batch.
BATCH = 200_000


@dataclass
class Stretch(InputPartition):
    """Rows of a matrix (or values of a cell) in a file."""

    path: str
    cell: str
    chrom: str
    start: int
    stop: int


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def files(path: str, suffix: str) -> list[str]:
    """Files of a folder that end with the suffix, or the file itself."""
    from pyarrow import fs

    where, name = _file_system(path)
    info = where.get_file_info(name)
    found = [info] if info.type == fs.FileType.File else where.get_file_info(fs.FileSelector(name))
    scheme = path.split("://")[0] + "://" if "://" in path else ""
    return sorted(scheme + f.path if scheme and not f.path.startswith(scheme) else f.path for f in found if f.type == fs.FileType.File and f.path.endswith(suffix))


class Member:
    """The first member of an npz file: its shape, kind and order, and rows of it."""

    def __init__(self, file):
        self.zip = zipfile.ZipFile(file)
        self.info = self.zip.infolist()[0]
        with self.zip.open(self.info) as f:
            version = np.lib.format.read_magic(f)
            self.shape, self.by_columns, self.kind = (np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0)(f)
            self.head = f.tell()
        if len(self.shape) != 2 or self.shape[0] != self.shape[1] or self.kind.hasobject:
            raise ValueError(f"{self.info.filename} is no square matrix of numbers")

    def lines(self, start: int, stop: int) -> np.ndarray:
        """Rows, or columns of a matrix stored by columns."""
        width = self.shape[0] * self.kind.itemsize
        with self.zip.open(self.info) as f:
            f.seek(self.head + start * width)  # goes there at once where the member is stored
            data = f.read((stop - start) * width)
        return np.frombuffer(data, self.kind).reshape(stop - start, self.shape[0])


class MatrixReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.format, self.chrom = options["path"], options.get("kind", "npz"), options.get("chrom")
        self.stretch = int(options.get("stretchbytes", STRETCH_BYTES))
        self.wanted = set(options["chroms"].split()) if options.get("chroms") else None

    def partitions(self) -> list[Stretch]:
        return list(self._npz() if self.format == "npz" else self._hdf5()) or [Stretch("", "", "", 0, 0)]

    def _named(self, suffix: str) -> Iterator[tuple[str, str, str]]:
        for path in files(self.path, suffix):
            name = path.rsplit("/", 1)[-1]
            name = name.removesuffix(suffix)
            cell, chrom = (name, self.chrom) if self.chrom else name.rsplit(".", 1) if "." in name else (name, None)
            if chrom is None:
                raise ValueError(f"name the chromosome of {path}, by the option chrom or as <cell>.<chrom>{suffix}")
            if self.wanted is None or chrom in self.wanted:
                yield path, cell, chrom

    def _npz(self) -> Iterator[Stretch]:
        for path, cell, chrom in self._named(".npz"):
            where, name = _file_system(path)
            with where.open_input_file(name) as f:
                m = Member(f)
            n = m.shape[0]
            step = max(1, self.stretch // max(1, n * m.kind.itemsize))
            for s in range(0, n, step):
                yield Stretch(path, cell, chrom, s, min(n, s + step))

    def _hdf5(self) -> Iterator[Stretch]:
        for path, _, chrom in self._named(""):
            with _hdf5_file(path) as f:
                n = len(f["coordinates"])
                cells = [k for k in f if k.startswith("cell_")]
            step = max(1, self.stretch // 8)
            for cell in cells:
                for s in range(0, n, step):
                    yield Stretch(path, cell, chrom, s, min(n, s + step))

    def read(self, part: Stretch) -> Iterator:
        import pyarrow as pa

        if not part.path:
            return
        if self.format == "npz":
            where, name = _file_system(part.path)
            with where.open_input_file(name) as file:
                m = Member(file)
                some = max(1, BATCH // m.shape[0])
                for s in range(part.start, part.stop, some):
                    lines = m.lines(s, min(part.stop, s + some))
                    a, b = np.nonzero(lines)
                    v, a = lines[a, b].astype(float), a + s
                    i, j = (b, a) if m.by_columns else (a, b)
                    above = i < j
                    yield self._batch(pa, part, i[above], j[above], v[above])
        else:
            with _hdf5_file(part.path) as f:
                for s in range(part.start, part.stop, BATCH):
                    t = min(part.stop, s + BATCH)
                    at = np.asarray(f["coordinates"][s:t])
                    yield self._batch(pa, part, at.min(1), at.max(1), np.asarray(f[part.cell][s:t], float))

    def _batch(self, pa, part: Stretch, i: np.ndarray, j: np.ndarray, v: np.ndarray):
        text = lambda x: pa.array([x] * len(i), pa.string())
        return pa.RecordBatch.from_arrays([text(part.cell), text(part.chrom), pa.array(i.astype(np.int64)), pa.array(j.astype(np.int64)), pa.array(v)], names=["cell", "chrom", "i", "j", "v"])


def _hdf5_file(path: str):
    try:
        import h5py
    except ImportError as e:
        raise RuntimeError("reading HDF5 needs h5py; Parquet, TSV and npz do not") from e
    where, name = _file_system(path)
    return h5py.File(io.BufferedReader(where.open_input_file(name)), "r")


class MatrixSource(DataSource):
    """spark.read.format("imputed_matrix").option("path", ...).option("chrom", ...).option("kind", "npz" or "hdf5").load()"""

    @classmethod
    def name(cls) -> str:
        return "imputed_matrix"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> MatrixReader:
        return MatrixReader({k.lower(): v for k, v in self.options.items()} | {"path": self.options["path"]})
