"""FITS and PDS3 files as Spark data sources: read in splits, written in parallel with commit and rollback.

Reading. The driver lists files and sizes only; a file of more than `split` bytes
is shared by as many tasks, each of which reads the headers (a few blocks) and
then its own lines or rows, and no others. Of tables, splits of several files are
packed into a task up to READ bytes, so that tasks grow with bytes, not with files.
Conditions on lat_ix, lon_ix, name and
file narrow what is read, if spark.sql.python.filterPushdown.enabled is set; the
options `lines` and `samples` ("from:to") do so always.

Writing. Every task writes whole files into a folder beside the output. When all
have ended, the folder takes the output's place: the old one is moved aside before
and comes back if that fails. Files of failed or repeated attempts never get in; a
failed job leaves what was there before. On stores whose folders cannot be renamed
at once, the change is not atomic.

Edge cases: an empty table gives a folder without files, which reads as empty;
null and missing cells are NaN in images and null when read; null whole numbers
are the type's least value, which then must not occur as a value; trailing blanks
of texts are lost, as FITS has it.
"""

from __future__ import annotations

import fnmatch
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

from gridlark.sources.rasters import BLOCK, CARD, CELL_SCHEMA, CELLS, FITS_TYPES, PDS3_TYPES, _number, _values, card_value, pds3_label, unit_name

#: Bytes of a file for which one task is made.
SPLIT = 64 << 20
#: Bytes of the data units that a task reads at a time, and of the small splits of tables that one task reads.
READ = 8 << 20
#: Rows of a written table file; lines of a written image file.
FILE_ROWS, FILE_LINES = 500_000, 1024


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The filesystem of a path and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def listed(path: str, pattern: str) -> list[tuple[str, int]]:
    """(file, bytes) below a path, or of the file itself; hidden ones and those of unfinished writes are left out."""
    place, inner = opened(path)
    info = place.get_file_info(inner)
    if info.type == fs.FileType.File:
        return [(inner, info.size)]
    inside = lambda p: p[len(inner.rstrip("/")) + 1 :].split("/")
    found = [f for f in place.get_file_info(fs.FileSelector(inner, recursive=True)) if f.type == fs.FileType.File]
    return sorted((f.path, f.size) for f in found if fnmatch.fnmatch(f.base_name, pattern) and not any(x.startswith(("_", ".")) for x in inside(f.path)))


def headers(file, size: int) -> Iterator[tuple[int, dict[str, str | None], int]]:
    """(number, header, offset of the data) of each unit, by reading header blocks only."""
    at, number = 0, 0
    while at + BLOCK <= size:
        header: dict[str, str | None] = {}
        ended = False
        while not ended and at + BLOCK <= size:
            file.seek(at)
            raw = file.read(BLOCK)
            at += BLOCK
            for i in range(0, BLOCK, CARD):
                card = raw[i : i + CARD].decode("latin-1")
                key = card[:8].strip()
                if key == "END":
                    ended = True
                    break
                if card[8:10] == "= ":
                    header.setdefault(key, card_value(card[10:]))
        if not header:
            return
        yield number, header, at
        axes = [int(header.get(f"NAXIS{i + 1}") or 0) for i in range(int(header.get("NAXIS") or 0))]
        bytes_ = abs(int(header.get("BITPIX") or 8)) // 8 * (math.prod(axes) if axes else 0)
        bytes_ = int(header.get("GCOUNT") or 1) * (bytes_ + int(header.get("PCOUNT") or 0))
        at += -(-bytes_ // BLOCK) * BLOCK
        number += 1


@dataclass
class Split(InputPartition):
    """The share-th of `of` parts of a file, and the `more` that follow it."""

    file: str
    size: int
    share: int
    of: int
    more: int = 0

    def lines(self, lo: int, hi: int) -> tuple[int, int]:
        """This split's part of the lines from lo to hi."""
        n = max(0, hi - lo)
        return lo + n * self.share // self.of, lo + n * (self.share + 1 + self.more) // self.of


@dataclass
class Pack(InputPartition):
    """Splits that one task reads."""

    splits: list[Split]


def packed(splits: list[Split], most: int) -> list[Pack]:
    """Splits in their order, together up to `most` bytes; neighbours of a file become one."""
    out, n = [], 0
    for s in splits:
        size = -(-s.size // s.of)
        if not out or n + size > most:
            out.append(Pack([]))
            n = 0
        own = out[-1].splits
        if own and own[-1].file == s.file:
            own[-1].more += 1
        else:
            own.append(s)
        n += size
    return out


@dataclass
class Image:
    """A two-dimensional image in a file."""

    name: str
    kind: str
    at: int
    lines: int
    samples: int
    first: int = 0
    scale: float = 1.0
    zero: float = 0.0
    blank: float | None = None


@dataclass
class Box:
    """Half-open bounds of cells, and what names and files must be."""

    lines: tuple[int, float] = (0, math.inf)
    samples: tuple[int, float] = (0, math.inf)
    equal: dict[str, str] = field(default_factory=dict)

    def narrow(self, f: Filter) -> None:
        column = ".".join(f.attribute) if hasattr(f, "attribute") else ""
        if column in ("name", "file") and isinstance(f, EqualTo):
            self.equal.setdefault(column, f.value)
        if column not in ("lat_ix", "lon_ix") or not isinstance(getattr(f, "value", None), int):
            return
        lo, hi = {
            EqualTo: lambda v: (v, v + 1), GreaterThan: lambda v: (v + 1, math.inf), GreaterThanOrEqual: lambda v: (v, math.inf),
            LessThan: lambda v: (0, v), LessThanOrEqual: lambda v: (0, v + 1),
        }.get(type(f), lambda v: (0, math.inf))(f.value)
        own = self.lines if column == "lat_ix" else self.samples
        new = max(own[0], lo), min(own[1], hi)
        if column == "lat_ix":
            self.lines = new
        else:
            self.samples = new


def bounds(text: str | None) -> tuple[int, float]:
    """"from:to" as numbers; either may be left out."""
    lo, _, hi = (text or ":").partition(":")
    return int(lo or 0), int(hi) if hi else math.inf


class FileReader(DataSourceReader):
    """Splits of the listed files."""

    def __init__(self, options: dict[str, str]):
        self.path, self.pattern, self.split = options["path"], options.get("pattern", "*"), int(options.get("split", SPLIT))

    def partitions(self) -> list[Split]:
        out = []
        for file, size in listed(self.path, self.pattern):
            of = max(1, -(-size // self.split))
            out += [Split(file, size, k, of) for k in range(of)]
        return out or [Split("", 0, 0, 1)]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        with opened(self.path)[0].open_input_file(partition.file) as file:
            yield from self.rows(file, partition)

    def rows(self, file, split: Split) -> Iterator[pa.RecordBatch]:
        raise NotImplementedError


class ImageReader(FileReader):
    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.prefix, self.kind = options.get("prefix", ""), options.get("format", "fits")
        self.box = Box(bounds(options.get("lines")), bounds(options.get("samples")))

    def partitions(self) -> list[Split]:
        own = self.box.equal.get("file")
        return [x for x in super().partitions() if own is None or x.file == own]

    def images(self, file, size: int) -> Iterator[Image]:
        if self.kind == "pds3":
            h = pds3_label(file.read_at(min(size, 1 << 16), 0))
            start = h["^IMAGE"]
            at = int(_number(start)) - 1
            scale = _number(h.get("SCALING_FACTOR"))
            yield Image(h.get("PRODUCT_ID", ""), f"{PDS3_TYPES[h['SAMPLE_TYPE']]}{int(h['SAMPLE_BITS']) // 8}", at if "BYTES" in start.upper() else at * int(h["RECORD_BYTES"]), int(h["LINES"]), int(h["LINE_SAMPLES"]), 0, 1.0 if scale is None else scale, _number(h.get("OFFSET")) or 0.0, _number(h.get("MISSING_CONSTANT")))
            return
        for number, h, at in headers(file, size):
            if (number == 0 or h.get("XTENSION") == "IMAGE") and h.get("NAXIS") == "2":
                yield Image(unit_name(number, h), FITS_TYPES[int(h["BITPIX"])], at, int(h["NAXIS2"]), int(h["NAXIS1"]), int(h.get("LINE0") or 0), float(h.get("BSCALE") or 1), float(h.get("BZERO") or 0), float(h["BLANK"]) if h.get("BLANK") else None)

    def rows(self, file, split: Split) -> Iterator[pa.RecordBatch]:
        for x in self.images(file, split.size):
            if not x.name.startswith(self.prefix) or self.box.equal.get("name", x.name) != x.name:
                continue
            lo, hi = split.lines(max(0, self.box.lines[0] - x.first), int(min(x.lines, self.box.lines[1] - x.first)))
            a, b = int(self.box.samples[0]), int(min(x.samples, self.box.samples[1]))
            if lo >= hi or a >= b:
                continue
            kind = np.dtype(x.kind)
            # of narrow crops only the samples asked for are read, else whole lines
            apart = (b - a) * 4 < x.samples
            step = max(1, min(READ // (kind.itemsize * x.samples), CELLS // (b - a)))
            for i in range(lo, hi, step):
                n = min(step, hi - i)
                if apart:
                    grid = np.stack([np.frombuffer(file.read_at((b - a) * kind.itemsize, x.at + (k * x.samples + a) * kind.itemsize), kind) for k in range(i, i + n)])
                else:
                    grid = np.frombuffer(file.read_at(n * x.samples * kind.itemsize, x.at + i * x.samples * kind.itemsize), kind).reshape(n, x.samples)[:, a:b]
                lat = np.repeat(np.arange(i + x.first, i + x.first + n, dtype=np.int32), b - a)
                lon = np.tile(np.arange(a, b, dtype=np.int32), n)
                text = lambda v: pa.DictionaryArray.from_arrays(pa.array(np.zeros(n * (b - a), np.int8)), pa.array([v])).cast(pa.string())
                yield pa.RecordBatch.from_arrays([text(split.file), text(x.name), pa.array(lat), pa.array(lon), _values(grid.ravel(), x.scale, x.zero, x.blank)], names=["file", "name", "lat_ix", "lon_ix", "value"])


class PushedImageReader(ImageReader):
    """For sessions that push conditions into Python sources; others refuse a reader that takes them. All are checked again by Spark."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            self.box.narrow(f)
            yield f


@dataclass
class Written(WriterCommitMessage):
    """Names of a task's files as written, and as they are to be."""

    files: list[tuple[str, str]]


class StagedWriter(DataSourceArrowWriter):
    """Tasks write files beside the output; commit moves them into its place, abort deletes them."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.place, self.overwrite = options["path"].rstrip("/"), overwrite
        self.token = uuid.uuid4().hex

    @property
    def beside(self) -> str:
        return f"{self.place}__{self.token}"

    def files(self, batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
        """The contents of a task's files, each as parts."""
        raise NotImplementedError

    def named(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str | None, list[bytes]]]:
        """files() with the names that they should have, if that matters."""
        return ((None, parts) for parts in self.files(batches))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        task, names = TaskContext.get(), []
        place, folder = opened(self.beside)
        place.create_dir(folder, recursive=True)
        for k, (wanted, parts) in enumerate(self.named(iterator)):
            # the attempt is in the name, so that a repeated task cannot write into another's file
            name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{k:03d}.fits"
            with place.open_output_stream(f"{folder}/{name}") as out:
                for x in parts:
                    out.write(x)
            names.append((name, wanted or name))
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        place, folder = opened(self.beside)
        _, path = opened(self.place)
        wanted = {name: new for m in messages if m is not None for name, new in m.files}
        kept = set(wanted.values())
        if len(kept) < len(wanted):
            self.abort(messages)
            raise ValueError("two rows ask for one file name")
        place.create_dir(folder, recursive=True)
        for f in place.get_file_info(fs.FileSelector(folder)):
            if f.base_name not in wanted:
                place.delete_file(f.path)
            elif wanted[f.base_name] != f.base_name:
                place.move(f.path, f"{folder}/{wanted[f.base_name]}")
        there = place.get_file_info(path).type != fs.FileType.NotFound
        if there and not self.overwrite:  # appended: files have names of their own
            for name in sorted(kept):
                place.move(f"{folder}/{name}", f"{path}/{name}")
            place.delete_dir(folder)
            return
        with place.open_output_stream(f"{folder}/_SUCCESS"):
            pass
        aside = f"{folder}.old"
        if there:
            place.move(path, aside)
        try:
            place.move(folder, path)
        except BaseException:
            if there:
                place.move(aside, path)
            place.delete_dir(folder)
            raise
        if there:
            place.delete_dir(aside)

    def abort(self, messages: list[Written | None]) -> None:
        place, folder = opened(self.beside)
        if place.get_file_info(folder).type != fs.FileType.NotFound:
            place.delete_dir(folder)


def cards(values: list[tuple[str, object]]) -> bytes:
    """A FITS header."""
    def one(key: str, v: object) -> bytes:
        if isinstance(v, bool):
            text = f"{'T' if v else 'F':>20}"
        elif isinstance(v, str):
            text = "'" + v.replace("'", "''") + "'"
        else:
            text = f"{v!r:>20}"
        card = f"{key:<8}= {text}".encode("latin-1")
        if len(card) > CARD:
            raise ValueError(f"{key}: {v!r} does not fit into a card")
        return card.ljust(CARD)

    raw = b"".join(one(k, v) for k, v in values) + b"END".ljust(CARD)
    return raw + b" " * (-len(raw) % BLOCK)


def padded(data: bytes) -> list[bytes]:
    return [data, bytes(-len(data) % BLOCK)]


class ImageWriter(StagedWriter):
    """Blocks of lines as images of doubles. Rows (name, lat_ix, lon_ix, value) come sorted by name and lat_ix, all of a block in one task."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        super().__init__(options, overwrite)
        self.samples, self.lines = int(options["samples"]), int(options.get("lines", FILE_LINES))

    def files(self, batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
        now, grid = None, None
        for b in batches:
            if not b.num_rows:
                continue
            name, lat, lon = np.array(b.column("name").to_pylist(), object), b.column("lat_ix").to_numpy(), b.column("lon_ix").to_numpy()
            value = b.column("value").cast(pa.float64()).fill_null(math.nan).to_numpy()
            if lat.min() < 0 or lon.min() < 0 or lon.max() >= self.samples:
                raise ValueError(f"a cell is outside of the image, which has {self.samples} samples a line")
            block = lat // self.lines
            new = np.flatnonzero(np.r_[True, (name[1:] != name[:-1]) | (block[1:] != block[:-1])])
            for i, j in zip(new, [*new[1:], b.num_rows]):
                if now != (name[i], int(block[i])):
                    if grid is not None:
                        yield self.image(now, grid)
                    now, grid = (name[i], int(block[i])), np.full((self.lines, self.samples), np.nan, ">f8")
                grid[lat[i:j] - now[1] * self.lines, lon[i:j]] = value[i:j]
        if grid is not None:
            yield self.image(now, grid)

    def image(self, now: tuple[str, int], grid: np.ndarray) -> list[bytes]:
        held = np.flatnonzero(~np.isnan(grid).all(axis=1))
        grid = grid[: int(held[-1]) + 1] if len(held) else grid[:1]
        head = [("SIMPLE", True), ("BITPIX", -64), ("NAXIS", 2), ("NAXIS1", grid.shape[1]), ("NAXIS2", grid.shape[0]), ("EXTNAME", now[0] or ""), ("LINE0", now[1] * self.lines)]
        return [cards(head), *padded(grid.tobytes())]


#: Letter and numpy type of the columns of binary tables.
TABLE_TYPES = {"boolean": ("L", "S1"), "smallint": ("I", ">i2"), "int": ("J", ">i4"), "bigint": ("K", ">i8"), "float": ("E", ">f4"), "double": ("D", ">f8"), "string": ("A", "S")}
SPARK_TYPES = {letter: name for name, (letter, _) in TABLE_TYPES.items()}


class TableWriter(StagedWriter):
    """Rows as binary tables, FILE_ROWS to a file."""

    def __init__(self, schema: T.StructType, options: dict[str, str], overwrite: bool):
        super().__init__(options, overwrite)
        self.names, self.kinds = schema.fieldNames(), [f.dataType.simpleString() for f in schema]
        for n, k in zip(self.names, self.kinds):
            if k not in TABLE_TYPES:
                raise ValueError(f"{n}: binary tables have no {k}; cast it")
        self.rows = int(options.get("rows", FILE_ROWS))

    def files(self, batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
        held, n = [], 0
        for b in batches:
            while b.num_rows:
                part = b.slice(0, self.rows - n)
                held.append(part)
                n += part.num_rows
                b = b.slice(part.num_rows)
                if n == self.rows:
                    yield self.table(pa.Table.from_batches(held))
                    held, n = [], 0
        if n:
            yield self.table(pa.Table.from_batches(held))

    def table(self, t: pa.Table) -> list[bytes]:
        columns, head = [], []
        for i, (name, kind) in enumerate(zip(self.names, self.kinds), 1):
            letter, form = TABLE_TYPES[kind]
            c = t.column(i - 1).combine_chunks()
            if kind == "string":
                columns.append(fixed_texts(c))
                letter = f"{columns[-1].dtype.itemsize}A"
            elif kind == "boolean":
                true, null = (x.to_numpy(zero_copy_only=False) for x in (c.fill_null(False), c.is_null()))
                columns.append(np.where(null, b"\0", np.where(true, b"T", b"F")).astype("S1"))
            elif kind in ("float", "double"):
                columns.append(c.fill_null(math.nan).to_numpy().astype(form))
            else:
                least = int(np.iinfo(np.dtype(form)).min)
                if c.null_count:
                    if (c.drop_null().to_numpy() == least).any():
                        raise ValueError(f"{name}: {least} stands for null and is a value too")
                    head.append((f"TNULL{i}", least))
                columns.append(c.fill_null(least).to_numpy().astype(form))
            head += [(f"TTYPE{i}", name), (f"TFORM{i}", letter)]
        data = np.rec.fromarrays(columns, names=[f"c{i}" for i in range(len(columns))]) if columns else np.zeros(0)
        first = cards([("SIMPLE", True), ("BITPIX", 8), ("NAXIS", 0)])
        size = data.dtype.itemsize
        return [first, cards([("XTENSION", "BINTABLE"), ("BITPIX", 8), ("NAXIS", 2), ("NAXIS1", size), ("NAXIS2", len(data)), ("PCOUNT", 0), ("GCOUNT", 1), ("TFIELDS", len(columns)), *head]), *padded(data.tobytes())]


def fixed_texts(c: pa.Array) -> np.ndarray:
    """Texts as bytes of one width, blanks behind; a null text is zero bytes, an empty one is blank."""
    n, null = len(c), c.is_null().to_numpy(zero_copy_only=False)
    raw = c.fill_null("").cast(pa.large_binary())
    _, at, data = raw.buffers()
    at = np.frombuffer(at, np.int64)[raw.offset : raw.offset + n + 1]
    size = np.diff(at)
    width = max(1, int(size.max()))
    out = np.full((n, width), ord(" "), np.uint8)
    out[null] = 0
    if at[-1] > at[0]:
        out[np.arange(width) < size[:, None]] = np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    return out.view(f"S{width}").ravel()


def texts(raw: np.ndarray) -> pa.Array:
    """Bytes of one width as texts, without zero bytes and then blanks behind; null if they begin with a zero byte."""
    m = np.ascontiguousarray(raw).view(np.uint8).reshape(len(raw), raw.dtype.itemsize)
    size = lambda kept: np.where(kept.any(axis=1), m.shape[1] - kept[:, ::-1].argmax(axis=1), 0)
    inside = np.arange(m.shape[1]) < size(m != 0)[:, None]
    size = size(inside & (m != ord(" ")))
    at = np.r_[0, np.cumsum(size)].astype(np.int64)
    data = m[np.arange(m.shape[1]) < size[:, None]]
    held = pa.Array.from_buffers(pa.large_binary(), len(raw), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.string())
    return pc.if_else(pa.array(m[:, 0] == 0), pa.scalar(None, pa.string()), held)


def table_fields(h: dict[str, str | None]) -> list[tuple[str, str, str, int | None]]:
    """(name, Spark type, numpy type, value of null) of a binary table's columns."""
    out = []
    for i in range(1, int(h["TFIELDS"]) + 1):
        form = (h[f"TFORM{i}"] or "").strip()
        width, letter = int(form[:-1] or 1), form[-1]
        if letter not in SPARK_TYPES or letter != "A" and width != 1:
            raise ValueError(f"columns of form {form} are not read")
        kind = SPARK_TYPES[letter]
        null = h.get(f"TNULL{i}")
        out.append((h.get(f"TTYPE{i}") or f"col{i}", kind, f"S{width}" if letter == "A" else TABLE_TYPES[kind][1], None if null is None else int(null)))
    return out


class TextWriter(StagedWriter):
    """Rows (name, label): a file a row."""

    def named(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
        for b in batches:
            for name, text in zip(b.column("name").to_pylist(), b.column("label").to_pylist()):
                if not name or "/" in name or name.startswith(("_", ".")):
                    raise ValueError(f"{name!r} is no name for a file")
                yield name, [(text or "").encode()]


class TableReader(FileReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        super().__init__(options)
        self.names = schema.fieldNames()

    def partitions(self) -> list[Pack]:
        return packed(super().partitions(), READ)

    def read(self, partition: Pack) -> Iterator[pa.RecordBatch]:
        for s in partition.splits:
            yield from super().read(s)

    def rows(self, file, split: Split) -> Iterator[pa.RecordBatch]:
        for _, h, at in headers(file, split.size):
            if h.get("XTENSION") != "BINTABLE":
                continue
            fields = table_fields(h)
            kind = np.dtype([(f"c{i}", f) for i, (_, _, f, _) in enumerate(fields)])
            lo, hi = split.lines(0, int(h["NAXIS2"]))
            step = max(1, READ // kind.itemsize)
            where = {name.lower(): i for i, (name, *_) in enumerate(fields)}
            for i in range(lo, hi, step):
                n = min(step, hi - i)
                data = np.frombuffer(file.read_at(n * kind.itemsize, at + i * kind.itemsize), kind)
                yield pa.RecordBatch.from_arrays([self.column(data[f"c{where[x.lower()]}"], *fields[where[x.lower()]]) for x in self.names], names=self.names)

    @staticmethod
    def column(raw: np.ndarray, name: str, kind: str, form: str, null: int | None) -> pa.Array:
        if kind == "string":
            return texts(raw)
        if kind == "boolean":
            true = raw == b"T"
            return pa.array(true, mask=~(true | (raw == b"F")))
        own = raw.astype(raw.dtype.newbyteorder("="))
        return pa.array(own, mask=np.isnan(own) if own.dtype.kind == "f" else own == null if null is not None else None)


class ImageSource(DataSource):
    """Images as cells. Options: path, pattern, format (fits, pds3), prefix of names, lines, samples, split, push; written ones: samples, lines a file."""

    @classmethod
    def name(cls) -> str:
        return "gridlark_images"

    def schema(self) -> str:
        return CELL_SCHEMA

    def reader(self, schema: T.StructType) -> ImageReader:
        return (PushedImageReader if self.options.get("push") == "true" else ImageReader)(dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> ImageWriter:
        return ImageWriter(dict(self.options), overwrite)


class TableSource(DataSource):
    """Binary tables as rows. Options: path, pattern, split; written ones: rows a file."""

    @classmethod
    def name(cls) -> str:
        return "gridlark_tables"

    def schema(self) -> str:
        path = self.options["path"]
        for file, size in listed(path, self.options.get("pattern", "*")):
            with opened(path)[0].open_input_file(file) as f:
                for _, h, _ in headers(f, size):
                    if h.get("XTENSION") == "BINTABLE":
                        return ", ".join(f"`{name}` {kind}" for name, kind, _, _ in table_fields(h))
        raise ValueError(f"{path} has no binary table; give a schema")

    def reader(self, schema: T.StructType) -> TableReader:
        return TableReader(schema, dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> TableWriter:
        return TableWriter(schema, dict(self.options), overwrite)


class TextSource(DataSource):
    """Texts, written to a file each. Option: path."""

    @classmethod
    def name(cls) -> str:
        return "gridlark_texts"

    def schema(self) -> str:
        return "name string, label string"

    def writer(self, schema: T.StructType, overwrite: bool) -> TextWriter:
        return TextWriter(dict(self.options), overwrite)


def write_text_files(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Rows (name, label): label is the content of the file `name` in path."""
    _with_sources(df.sparkSession)
    df.select(F.col("name").cast("string").alias("name"), F.col("label").cast("string").alias("label")).write.format(TextSource.name()).mode(mode).save(path)


def copy_files(df: DataFrame, chunk: int = READ) -> DataFrame:
    """(source, target, bytes) of every row (source, target) of paths: tasks copy the files, a chunk at a time. A target appears when it is whole."""
    def run(batches):
        for b in batches:
            sizes = []
            for source, target in zip(b.column("source").to_pylist(), b.column("target").to_pylist()):
                (a, x), (to, y) = opened(source), opened(target)
                to.create_dir(y.rsplit("/", 1)[0], recursive=True)
                beside, n = f"{y}__{uuid.uuid4().hex}", 0
                with a.open_input_stream(x) as data, to.open_output_stream(beside) as out:
                    while part := data.read(chunk):
                        out.write(part)
                        n += len(part)
                to.move(beside, y)
                sizes.append(n)
            yield pa.RecordBatch.from_arrays([b.column("source"), b.column("target"), pa.array(sizes, pa.int64())], names=["source", "target", "bytes"])

    return df.select("source", "target").mapInArrow(run, "source string, target string, bytes long")


def _with_sources(spark: SparkSession) -> SparkSession:
    for source in (ImageSource, TableSource, TextSource):
        spark.dataSource.register(source)
    return spark


def read_images(spark: SparkSession, path: str, pattern: str = "*.fit*", kind: str = "fits", prefix: str = "", lines: tuple[int, int] | None = None, samples: tuple[int, int] | None = None, split: int = SPLIT) -> DataFrame:
    """(file, name, lat_ix, lon_ix, value), read in splits; lines and samples crop half-open."""
    push = spark.conf.get("spark.sql.python.filterPushdown.enabled")
    r = _with_sources(spark).read.format(ImageSource.name()).options(pattern=pattern, format=kind, prefix=prefix, split=split, push=push)
    for key, x in (("lines", lines), ("samples", samples)):
        r = r.option(key, f"{x[0]}:{x[1]}") if x else r
    return r.load(path)


def write_images(df: DataFrame, path: str, samples: int, lines: int = FILE_LINES, mode: str = "overwrite") -> None:
    """Cells (name, lat_ix, lon_ix, value) as images of `lines` lines each; a block of lines is one task's."""
    block = F.floor(F.col("lat_ix") / lines)
    rows = df.select(F.coalesce(F.col("name"), F.lit("")).alias("name"), F.col("lat_ix").cast("int").alias("lat_ix"), F.col("lon_ix").cast("int").alias("lon_ix"), F.col("value").cast("double").alias("value"))
    rows = rows.repartition("name", block).sortWithinPartitions("name", "lat_ix", "lon_ix")
    _with_sources(df.sparkSession)
    rows.write.format(ImageSource.name()).mode(mode).options(samples=samples, lines=lines).save(path)


def read_binary_table(spark: SparkSession, path: str, pattern: str = "*.fit*", split: int = SPLIT, schema: str | None = None) -> DataFrame:
    r = _with_sources(spark).read.format(TableSource.name()).options(pattern=pattern, split=split)
    return (r.schema(schema) if schema else r).load(path)


def write_binary_table(df: DataFrame, path: str, rows: int = FILE_ROWS, mode: str = "overwrite") -> None:
    """Every task's rows as binary tables of at most `rows` rows."""
    _with_sources(df.sparkSession)
    df.write.format(TableSource.name()).mode(mode).option("rows", rows).save(path)
