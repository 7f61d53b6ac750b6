"""Helpers the text operators share: code for the workers, row locators, files in the shared folder."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
import zipfile
from collections.abc import Sequence

import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import crownframe
from crownframe.session import cut, scratch_path

#: Bytes of a table that may be sent to every executor; its rows are counted first.
BROADCAST_BYTES = 64 << 20

#: Tasks per core that thin rows are dealt to, at most.
WAVES = 8

#: Names of the columns that say where a row is stored.
FILE, ROW = "__llm_file", "__llm_row"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this library, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(crownframe.__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="spark-"), "crownframe_llm.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(os.path.join(top, "crownframe")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, top))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text as a string, null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def located(df: DataFrame) -> DataFrame:
    """`df` with the file and the position in it of each row; a table that isn't read straight from
    files is written to the shared folder first, so that the position is the same in every pass."""
    def marked(x: DataFrame) -> DataFrame:
        at = x.metadataColumn("_metadata")
        return x.select(*[x[f"`{c}`"] for c in x.columns], at["file_path"].alias(FILE),
                        at["row_index"].alias(ROW))
    try:
        out = marked(df)
        out.schema
        return out
    except AnalysisException:
        return marked(cut(df, "located"))


def bounded(df: DataFrame, row_bytes: int) -> DataFrame:
    """`df` marked for broadcast if its counted rows are few enough, else as it is (Spark shuffles)."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def without(df: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of a located table whose place isn't in `dropped`, in the columns of the table."""
    gone = cut(dropped.select(FILE, ROW), "dropped")
    return df.join(bounded(gone, 200), [FILE, ROW], "left_anti").drop(FILE, ROW)


def fresh_folder(spark: SparkSession, label: str) -> str:
    """URI of a new folder below the shared one."""
    path = scratch_path(spark, label)
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


@functools.lru_cache(maxsize=64)
def _store(root: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(root if not root.startswith("file:/") or root.startswith("file://")
                                    else "file://" + root[5:])


def open_input(root: str, name: str):
    """A file of the shared folder for random reads."""
    fs, base = _store(root)
    return fs.open_input_file(f"{base}/{name}")


def file_size(root: str, name: str) -> int:
    fs, base = _store(root)
    return fs.get_file_info(f"{base}/{name}").size


class Output:
    """A new file below `root`. It appears under its name when it is closed, whole, so a task that is
    run again or twice at once leaves the same file."""

    def __init__(self, root: str, name: str):
        self.fs, base = _store(root)
        self.fs.create_dir(base, recursive=True)
        self.target, self.part = f"{base}/{name}", f"{base}/.{name}.{uuid.uuid4().hex}"
        self.stream = self.fs.open_output_stream(self.part)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.stream.close()
        self.fs.move(self.part, self.target)

    def discard(self) -> None:
        self.stream.close()
        self.fs.delete_file(self.part)


def dealt(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A thin table whose rows stand for much work each, one row a task as far as there are cores; adaptive execution
    would put such rows together by their own few bytes."""
    rows = df.count() if rows is None else rows
    return df.repartition(max(1, min(rows, WAVES * df.sparkSession.sparkContext.defaultParallelism)))


def pick(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{n}`") for n in names])
