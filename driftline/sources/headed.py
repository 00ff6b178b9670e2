"""A Spark data source for text tables whose head lines say what their columns are.

``spark.read.format("headed_text")`` plans byte ranges of the files, and every task reads the
head of its file itself, so the names and units of a file are never joined to its lines and
no line is looked at twice. A gzipped file is one range. The columns asked for are found by
the file's own names; a column that a file lacks is null, and ``has_<column>`` tells so.

Files are opened with pyarrow's file systems (local and mounted folders, HDFS, S3, GCS),
where the executors run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of a range, of what a task reads at once, and of a head at most.
RANGE = 32 << 20
READ = 4 << 20
HEAD = 1 << 20


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int | None  # None: to the end, of a stream that cannot be cut


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if re.match(r"[a-z0-9]+:", path, re.IGNORECASE):
        return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/+", "file:///", path)))
    return pafs.LocalFileSystem(), path


def _paths(path: str) -> list[tuple[str, int]]:
    """Files below ``path`` with their sizes, in order, leaving out those that begin with ``_`` or a dot."""
    fs, place = _open(path)
    scheme = path[: len(path) - len(place)] if path.endswith(place) else ""
    info = fs.get_file_info(place)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(place, recursive=True))
    return sorted((scheme + f.path, f.size) for f in found if f.is_file and f.base_name[0] not in "_.")


def _text(raw: bytes) -> str:
    """UTF-8 with or without a mark, else latin-1."""
    try:
        return raw.decode("utf-8-sig")
    except UnicodeDecodeError:
        return raw.decode("latin-1")


@dataclass(frozen=True)
class Head:
    """Names, units by name, and the bytes that the head takes; ``preamble`` is what stands before the names."""

    names: list[str]
    units: dict[str, str]
    size: int
    preamble: str = ""


def hash_head(raw: bytes, path: str) -> Head:
    """Two lines that begin with #, of names and units, cut at blanks."""
    lines = raw.split(b"\n", 2)
    if len(lines) < 2 or not all(x.startswith(b"#") for x in lines[:2]):
        raise ValueError(f"{path}: two # lines are expected, of names and of units")
    names, units = (_text(x).lstrip("#").split() for x in lines[:2])
    return Head(names, dict(zip(names, units)), sum(len(x) + 1 for x in lines[:2]))


def names_head(raw: bytes, path: str) -> Head:
    """One line of names, cut at commas."""
    line = raw.split(b"\n", 1)[0]
    return Head([c.strip() for c in _text(line).rstrip("\r").split(",")], {}, len(line) + 1)


def units_head(raw: bytes, path: str) -> Head:
    """A line of names and a line of units, cut at commas."""
    lines = raw.split(b"\n", 2)
    names, units = ([c.strip() for c in _text(x).rstrip("\r").split(",")] for x in (*lines[:2], b"")[:2])
    return Head(names, dict(zip(names, units)), sum(len(x) + 1 for x in lines[:2]))


def year_head(raw: bytes, path: str) -> Head:
    """Free text, then a line of names that begins with YEAR, cut at commas."""
    found = re.search(rb"(?m)^(?:\xef\xbb\xbf)?YEAR[^\n]*(?:\n|\Z)", raw)
    if not found:
        raise ValueError(f"{path}: no line of names begins with YEAR")
    return Head([c.strip() for c in _text(found[0]).strip().split(",")], {}, found.end(), _text(raw[: found.start()]).replace("\r", ""))


HEADS = {"hash": (hash_head, None), "names": (names_head, ","), "units": (units_head, ","), "year": (year_head, ",")}


def _named(columns: str) -> dict[str, str]:
    """``name`` or ``name=column of the file``, joined by commas."""
    return {c.partition("=")[0]: c.partition("=")[2] or c for c in columns.split(",")}


class HeadedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.layout = options["path"], options.get("layout", "names")
        self.columns = _named(options["columns"])
        self.has = [c for c in options.get("has", "").split(",") if c]
        self.units = dict(u.split("=", 1) for u in options.get("units", "").split(",") if u)
        self.first = [c for c in options.get("first", "").split(",") if c]
        self.range = int(options.get("range", RANGE))

    def partitions(self) -> list[Range]:
        out = []
        for path, size in _paths(self.path):
            if path.endswith(".gz"):
                out.append(Range(path, 0, None))
            else:
                out += [Range(path, a, min(size, a + self.range)) for a in range(0, size, self.range)]
        return out or [Range("", 0, 0)]

    def _head(self, raw: bytes, path: str) -> Head:
        head = HEADS[self.layout][0](raw, path)
        if head.names[: len(self.first)] != self.first:
            raise ValueError(f"{path}: the first columns are {head.names[: len(self.first)]}, expected are {self.first}")
        for c, unit in self.units.items():
            if c in head.names and head.units.get(c) != unit:
                raise ValueError(f"{path}: {c} is declared in {head.units.get(c)!r}, expected is {unit!r}")
        return head

    def _blocks(self, part: Range) -> Iterator[tuple[int, bytes, Head]]:
        """Blocks of whole lines that begin in the range, below the head, with the place of each block."""
        fs, place = _open(part.path)
        if part.end is None:
            with fs.open_input_stream(place, compression="gzip") as f:
                held = f.read(HEAD)
                head = self._head(held, part.path)
                at, held = head.size, held[head.size :]
                while True:
                    more = f.read(READ)
                    cut = held.rfind(b"\n") + 1 if more else len(held)
                    if cut:
                        yield at, held[:cut], head
                    at, held = at + cut, held[cut:] + more
                    if not more:
                        return
        with fs.open_input_file(place) as f:
            head = self._head(f.read(HEAD), part.path)
            at = max(part.start, head.size)
            if at > head.size:  # the line that crosses into the range belongs to the one before
                at = self._next_line(f, at - 1)
            f.seek(at)
            while at < part.end:
                raw = f.read(min(READ, part.end - at))
                if not raw:
                    return
                if not raw.endswith(b"\n"):
                    raw += self._rest_of_line(f)
                yield at, raw, head
                at += len(raw)

    @staticmethod
    def _rest_of_line(f: pa.NativeFile) -> bytes:
        out = []
        while raw := f.read(1 << 16):
            end = raw.find(b"\n")
            if end >= 0:
                f.seek(f.tell() - len(raw) + end + 1)
                return b"".join([*out, raw[: end + 1]])
            out.append(raw)
        return b"".join(out)

    def _next_line(self, f: pa.NativeFile, at: int) -> int:
        f.seek(at)
        return at + len(self._rest_of_line(f))

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        name, cut = partition.path.rsplit("/", 1)[-1], HEADS[self.layout][1]
        for at, raw, head in self._blocks(partition):
            places, rows = [], []
            for line in raw.split(b"\n"):
                text = line.strip()
                if text and not text.startswith(b"#"):
                    places.append(at)
                    rows.append(_text(line).rstrip("\r").split(cut))
                at += len(line) + 1
            where = [head.names.index(c) if c in head.names else None for c in self.columns.values()]
            cells = [pa.array([None if i is None or i >= len(r) else r[i] for r in rows], pa.string()) for i in where]
            n = len(rows)
            fixed = [pa.array([name] * n, pa.string()), pa.array(places, pa.int64())]
            flags = [pa.array([c in head.names] * n, pa.bool_()) for c in self.has]
            yield pa.RecordBatch.from_arrays([*fixed, *cells, *flags], names=["file", "place", *self.columns, *(f"has_{c}" for c in self.has)])


class HeadedText(DataSource):
    """Options: path, layout (a key of HEADS), columns (name or name=column), and as wanted has, units (column=unit), first, range."""

    @classmethod
    def name(cls) -> str:
        return "headed_text"

    def schema(self) -> str:
        has = [f"`has_{c}` boolean" for c in self.options.get("has", "").split(",") if c]
        return ", ".join(["file string", "place long", *(f"`{c}` string" for c in _named(self.options["columns"])), *has])

    def reader(self, schema) -> HeadedReader:
        return HeadedReader(dict(self.options))


def read(
    spark: SparkSession, path: str, layout: str, columns: list[str] | dict[str, str], has: list[str] = (), units: dict[str, str] | None = None, first: list[str] = (), range_bytes: int = RANGE
) -> DataFrame:
    """file, place (the byte where a line begins), the columns as text, and has_<column> of ``has``.

    ``columns`` are the file's names, or maps names to them where those differ in case alone.
    Blank lines and lines that begin with # are left out. A column of ``units`` that a file has
    under another unit is refused, as is a file whose first columns are not ``first``.
    """
    spark.dataSource.register(HeadedText)
    options = {"layout": layout, "columns": ",".join(f"{k}={c}" for k, c in columns.items()) if isinstance(columns, dict) else ",".join(columns), "has": ",".join(has), "units": ",".join(f"{c}={u}" for c, u in (units or {}).items()), "first": ",".join(first), "range": str(range_bytes)}
    return spark.read.format("headed_text").options(**options).load(path)
