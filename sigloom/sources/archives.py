"""Compressed archives: unpacked by executors into the shared folder, from where every format reads them.

Uncompressed tar archives need none of this: sources read their members in place. `unpacked` is for archives that have to
be read from their beginning (.tar.gz, .tgz, .tar.bz2, .tar.xz), for files compressed by themselves (.gz), and for such files within any
of these. A member of an uncompressed archive is a task of its own; a compressed archive is one, as it can be read in order only, a
megabyte at a time. Files are written under their names, whole: a repeated task writes the same again.
"""

from __future__ import annotations

import gzip
import os
import shutil
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.session import scratch, ship
from sigloom.sources.base import filesystem, list_files, open_file

CHUNK = 1 << 20
COMPRESSED = (".tar.gz", ".tgz", ".tar.bz2", ".tbz2", ".tar.xz", ".txz")


def inner_name(name: str) -> str:
    """A member's name within the folder; one that leads out of it fails."""
    out = os.path.normpath(name.removesuffix(".gz"))
    if os.path.isabs(out) or out.split("/")[0] == "..":
        raise ValueError(f"{name} leads out of its archive")
    return out


def put(source, name: str, folder: str) -> tuple[str, int]:
    """Writes an open file, inflated where its name ends in .gz, and gives its name and bytes."""
    out = f"{folder}/{inner_name(name)}"
    fs, p = filesystem(out)
    fs.create_dir(os.path.dirname(p), recursive=True)
    with fs.open_output_stream(p, compression=None) as sink:
        shutil.copyfileobj(gzip.GzipFile(fileobj=source) if name.endswith(".gz") else source, sink, CHUNK)
        return inner_name(name), sink.tell()


def unpack_file(path: str, name: str, folder: str) -> Iterator[tuple[str, int]]:
    """The files that one file or member of an archive comes to. Resource forks are left out."""
    with open_file(path) as f:
        if path.endswith(COMPRESSED):
            with tarfile.open(fileobj=f, mode="r|*") as t:
                for m in t:
                    if m.isfile() and not os.path.basename(m.name).startswith("._"):
                        yield put(t.extractfile(m), m.name, folder)
        else:
            yield put(f, name, folder)


def contents(path: str) -> list[tuple[str, str]]:
    """Files to unpack and their names: members of uncompressed archives, and other files by their place in the folder."""
    root = path.rstrip("/")
    return [(f, f.split("!/", 1)[1] if "!/" in f else os.path.relpath(f, root) if f != root else os.path.basename(f)) for f in list_files(path)]


def unpack(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """(archive, name, bytes) of every file written to the folder, which all nodes share."""
    ship(spark)
    work = contents(path)

    def run(batches):
        for batch in batches:
            for source, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                got = list(unpack_file(source, name, folder))
                yield pa.RecordBatch.from_arrays([pa.array([source] * len(got), pa.string()), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.int64())], names=["archive", "name", "bytes"])

    tasks = max(1, min(len(work), 1000))
    rows = spark.createDataFrame(work, "path string, name string").repartition(tasks)
    return rows.mapInArrow(run, "archive string, name string, bytes long")


def unpacked(spark: SparkSession, path: str) -> str:
    """A folder in the shared scratch with all that path's archives and compressed files hold, to load by any format."""
    folder = scratch(spark, "unpacked")
    unpack(spark, path, folder).agg(F.sum("bytes")).collect()
    return folder
