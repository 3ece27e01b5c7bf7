"""Files of a folder as rows, and their bytes once it is known which files and how many bytes are wanted."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FILES_PER_TASK = 4096
BATCH_BYTES = 8 << 20  # contents handed to Spark at once, one file at least


def storage(path: str) -> tuple[fs.FileSystem, str, str]:
    """The file system of a path, the path inside it, and what the full path has before that.

    Paths are plain text, not escaped: blanks and per cent signs in names are kept. ``s3a`` is the ``s3`` of Arrow.
    """
    scheme, _, rest = path.partition("://")
    if not rest:
        return fs.LocalFileSystem(), path.removeprefix("file:"), ""
    if scheme == "file":
        return fs.LocalFileSystem(), rest, ""
    host, _, inner = rest.partition("/")
    store, base = fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}://{host}/")
    base = base.rstrip("/")
    return store, f"{base}/{inner}", path[: len(path) - len(f"{base}/{inner}")]


class _Names(InputPartition):
    def __init__(self, names: list[tuple[str, int]]):
        self.names = names


class _Lister(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.suffix = options["path"], options.get("suffix", "")

    def partitions(self) -> Sequence[InputPartition]:
        """The folder is listed once, by the driver, as Spark's own file sources do; names and lengths only."""
        store, inner, before = storage(self.folder)
        found = store.get_file_info(fs.FileSelector(inner.rstrip("/") or "/"))
        shown = lambda f: not f.base_name.startswith((".", "_")) and f.base_name.endswith(self.suffix)
        names = sorted((before + f.path, f.size or 0) for f in found if f.is_file and shown(f))
        return [_Names(names[i : i + FILES_PER_TASK]) for i in range(0, len(names), FILES_PER_TASK)] or [_Names([])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        path, length = [p for p, _ in partition.names], [n for _, n in partition.names]
        yield pa.RecordBatch.from_arrays([pa.array(path, pa.string()), pa.array(length, pa.int64())], ["path", "length"])


class FolderSource(DataSource):
    """``format("board_files")``: path and length of every file right in a folder, empty ones too, hidden ones not. No file is opened."""

    @classmethod
    def name(cls) -> str:
        return "board_files"

    def schema(self) -> str:
        return "path string, length bigint"

    def reader(self, schema) -> DataSourceReader:
        return _Lister(dict(self.options))


def list_files(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """path, length of the files of a folder whose names end in ``suffix``."""
    spark.dataSource.register(FolderSource)
    return spark.read.format(FolderSource.name()).option("suffix", suffix).load(folder)


def read_head(path: str, size: int | None = None) -> bytes:
    """The first ``size`` bytes of a file, or all; nothing more is asked of the storage."""
    store, inner, _ = storage(path)
    with store.open_input_file(inner) as f:
        return f.read_at(size, 0) if size is not None else f.read()


def with_content(files: DataFrame, size: int | None = None, tasks: int | None = None) -> DataFrame:
    """``files`` with the first ``size`` bytes (None: all) of each file in ``path`` as ``content``; reading is spread over ``tasks``.

    Filter before: only the files that are left are opened. A file gone since the listing stops the job.
    """
    names = files.columns

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            start, held, weight = 0, [], 0
            for path in batch["path"]:
                held.append(read_head(path, size))
                weight += len(held[-1])
                if weight >= BATCH_BYTES:
                    yield batch.iloc[start : start + len(held)].assign(content=held)
                    start, held, weight = start + len(held), [], 0
            if held:
                yield batch.iloc[start:].assign(content=held)

    spread = files.repartition(tasks or 4 * files.sparkSession.sparkContext.defaultParallelism)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.select(*names).schema)
    return spread.mapInPandas(read, f"{kinds}, content binary")
