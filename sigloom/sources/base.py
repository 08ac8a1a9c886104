"""Python data sources for recording formats.

A format plans partitions from a file's header and decodes one partition at a time (on
executors) into Arrow batches, so no file is ever held whole. Small files that stand for
themselves share partitions, and the tasks read their headers; the driver lists files and
reads the headers of large ones. Paths may be local or any URI that pyarrow's file systems open.
"""

from __future__ import annotations

import io
import os
import tarfile
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from sigloom import schema

#: Samples in a batch.
BATCH = 131_072


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), os.path.abspath(path)


#: Between an archive's path and a member's name.
MEMBER = ".tar!/"


@lru_cache(maxsize=64)
def members(archive: str) -> dict[str, tuple[int, int]]:
    """Where the files of an uncompressed tar archive lie: name to place and bytes. Resource forks are left out. Read once by a process."""
    fs, p = filesystem(archive)
    with fs.open_input_file(p) as f, tarfile.open(fileobj=f, mode="r:") as t:
        found = [m for m in t if m.isfile() and not os.path.basename(m.name).startswith("._")]
        if any(m.issparse() for m in found):
            raise ValueError(f"{archive}: sparse members can't be read in place")
        return {m.name.removeprefix("./"): (m.offset_data, m.size) for m in found}


def member_of(path: str) -> tuple[str, int, int] | None:
    """The archive, place and bytes of a member's path."""
    if MEMBER not in path:
        return None
    archive, name = path.split("!/", 1)
    return archive, *members(archive)[name]


class Window(io.RawIOBase):
    """A range of an open file as a file of its own."""

    def __init__(self, file, first: int, size: int):
        self.file, self.first, self.size, self.at = file, first, size, 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, offset: int, whence: int = 0) -> int:
        self.at = max(0, (0, self.at, self.size)[whence] + offset)
        return self.at

    def read(self, n: int = -1) -> bytes:
        left = max(self.size - self.at, 0)
        n = left if n is None or n < 0 else min(n, left)
        self.file.seek(self.first + self.at)
        data = self.file.read(n)
        self.at += len(data)
        return data

    def readinto(self, buffer) -> int:
        data = self.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)

    def readall(self) -> bytes:
        return self.read()

    def close(self) -> None:
        if not self.closed:
            self.file.close()
        super().close()


def open_file(path: str):
    """An open file to read anywhere in; a member of an archive in place."""
    found = member_of(path)
    fs, p = filesystem(found[0] if found else path)
    f = fs.open_input_file(p)
    return pa.PythonFile(Window(f, *found[1:]), mode="r") if found else f


def read_at(path: str, offset: int = 0, length: int | None = None) -> bytes:
    with open_file(path) as f:
        f.seek(offset)
        return f.read() if length is None else f.read(length)


def file_size(path: str) -> int:
    found = member_of(path)
    if found:
        return found[2]
    fs, p = filesystem(path)
    return fs.get_file_info(p).size


def sized_files(path: str) -> list[tuple[str, int]]:
    """The files under a folder, or the one file, with their bytes; of an uncompressed tar archive its members, which are read in place."""
    if member := member_of(path):
        return [(path, member[2])]
    fs, p = filesystem(path)
    info = fs.get_file_info(p)
    if info.type == pafs.FileType.File:
        found = [(path, info.size)]
    elif info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    else:
        prefix = path[: len(path) - len(p)] if path.endswith(p) else ""
        found = [(prefix + i.path, i.size) for i in fs.get_file_info(pafs.FileSelector(p, recursive=True)) if i.type == pafs.FileType.File]
    return sorted(x for f, n in found for x in ([(f"{f}!/{m}", size) for m, (_, size) in members(f).items()] if f.endswith(".tar") else [(f, n)]))


def list_files(path: str) -> list[str]:
    return [f for f, _ in sized_files(path)]


def is_file(path: str) -> bool:
    if MEMBER in path:
        archive, name = path.split("!/", 1)
        return name in members(archive)
    fs, p = filesystem(path)
    return fs.get_file_info(p).type == pafs.FileType.File


@dataclass
class Piece(InputPartition):
    """A unit of decoding: a file and where in it."""

    path: str
    info: dict[str, Any] = field(default_factory=dict)

    def __post_init__(self):
        super().__init__(self.path)


def whole_micros(t: np.ndarray) -> np.ndarray:
    """Truncated to whole microseconds, a thousandth's rounding error forgiven."""
    t = np.asarray(t)
    return t.astype(np.int64) if t.dtype.kind in "iu" else np.floor(t + 1e-3).astype(np.int64)


def sample_batch(channel: str, unit: str, rate: float, t_us: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    n = len(values)
    return pa.RecordBatch.from_arrays([pa.array([channel] * n, pa.string()), pa.array([unit] * n, pa.string()), pa.array(np.full(n, rate, np.float64)), pa.array(whole_micros(t_us)), pa.array(np.asarray(values, np.float64))], names=["channel", "unit", "rate", "t_us", "value"])


def spike_batch(channel: str, t_us: np.ndarray, units: np.ndarray, waveforms: np.ndarray) -> pa.RecordBatch:
    n, width = waveforms.shape
    lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(waveforms.astype(np.float64).ravel()))
    return pa.RecordBatch.from_arrays([pa.array([channel] * n, pa.string()), pa.array(whole_micros(t_us)), pa.array(np.asarray(units).astype(np.int16)), lists], names=["channel", "t_us", "unit", "waveform"])


def event_batch(source: str, kind: list[str], t_us: list[int], label: list[str], props: list[dict]) -> pa.RecordBatch:
    n = len(t_us)
    return pa.RecordBatch.from_arrays([pa.array([source] * n, pa.string()), pa.array(kind, pa.string()), pa.array(t_us, pa.int64()), pa.array([None] * n, pa.int64()), pa.array(label, pa.string()), pa.array([list(p.items()) for p in props], pa.map_(pa.string(), pa.string()))], names=["source", "type", "t_us", "duration_us", "label", "props"])


#: Bytes of small files in a partition; a file of more is planned by the driver. What opening a file counts as. Partitions to have at least, if there are the files.
SHARE, OPENING, LEAST = 1 << 25, 1 << 18, 64


def shared_out(works: list[tuple[Any, int]]) -> list[list[Any]]:
    """Works in their order in groups of bounded bytes."""
    total = sum(n + OPENING for _, n in works)
    most = max(OPENING, min(SHARE, total // LEAST))
    out, held = [], most
    for work, n in works:
        if held + n + OPENING > most:
            out.append([])
            held = 0
        out[-1].append(work)
        held += n + OPENING
    return out


class Format(DataSource):
    """Subclasses set NAME and KIND, and define plan and decode.

    APART: files stand for themselves, so that any task may plan some of them. Where a recording is several files, `works` says which are planned together.
    """

    NAME = ""
    KIND = "samples"
    APART = False
    #: What the names of files end in.
    ENDS: tuple[str, ...] = ("",)

    @classmethod
    def name(cls) -> str:
        return cls.NAME

    def schema(self):
        return {"samples": schema.SOURCE, "spikes": schema.SOURCE_SPIKES, "events": schema.ANNOTATIONS}[self.KIND]

    def reader(self, schema) -> DataSourceReader:  # noqa: ARG002
        return FormatReader(type(self), dict(self.options))

    @staticmethod
    def plan(path: str, options: dict[str, str]) -> list[Piece]:
        raise NotImplementedError

    @classmethod
    def works(cls, path: str, options: dict[str, str]) -> list[tuple[Any, int]]:  # noqa: ARG003
        """What is planned apart, with its bytes."""
        return [(f, n) for f, n in sized_files(path) if f.endswith(cls.ENDS)]

    @classmethod
    def plan_work(cls, work: Any, options: dict[str, str]) -> list[Piece]:
        return cls.plan(work, options)

    @staticmethod
    def decode(piece: Piece, options: dict[str, str]) -> Iterator[pa.RecordBatch]:
        raise NotImplementedError


class FormatReader(DataSourceReader):
    def __init__(self, kind: type[Format], options: dict[str, str]):
        self.kind, self.opts = kind, options

    def partitions(self):
        if not self.kind.APART:
            return self.kind.plan(self.opts["path"], self.opts) or [Piece("", {"empty": True})]
        works = self.kind.works(self.opts["path"], self.opts)
        out = [p for w, n in works if n > SHARE for p in self.kind.plan_work(w, self.opts)]
        out += [Piece("", {"works": group}) for group in shared_out([(w, n) for w, n in works if n <= SHARE])]
        return out or [Piece("", {"empty": True})]

    def read(self, partition):
        if "works" in partition.info:
            for work in partition.info["works"]:
                for piece in self.kind.plan_work(work, self.opts):
                    yield from self.kind.decode(piece, self.opts)
        elif not partition.info.get("empty"):
            yield from self.kind.decode(partition, self.opts)


def split(n: int, parts_of: int) -> list[tuple[int, int]]:
    """[first, end) cuts of n items."""
    return [(a, min(a + parts_of, n)) for a in range(0, n, parts_of)]


def flag(options: dict[str, str], name: str) -> bool:
    return options.get(name.lower(), options.get(name, "false")).lower() == "true"
