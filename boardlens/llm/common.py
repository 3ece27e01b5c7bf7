"""Small helpers shared by the operators."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_SPACE = b" \t\n\v\f\r"
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}
SUM_GROUPS = 64  # rows that reach the driver when partition sums are added up


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder, with the session's Arrow batches kept small: texts may be long, and a worker holds a few copies of a batch."""
    for setting, value in BATCH.items():
        spark.conf.set(setting, value)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Rows kept away from learning: crc32 of the id as text leaves 2 modulo 4. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def labelled(documents: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """The rows of ``documents`` that may be learnt from, with the mean of their labels as ``label``.

    Several labels of one id are averaged, null labels are ignored, held-out and unlabelled rows are left out.
    """
    means = labels.groupBy("doc_id").agg(F.avg(label).alias("label")).filter("label is not null")
    return documents.filter(~held_out(F.col("doc_id"))).join(means, "doc_id")


def sum_arrays(partials: DataFrame, size: int) -> np.ndarray:
    """Add up float64 vectors given one per task as (part int, data binary).

    The tasks' vectors are first added in at most SUM_GROUPS groups, so that the driver gets a bounded
    number of vectors however many tasks there were.
    """

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(size)
        for data in rows["data"]:
            total += np.frombuffer(data)
        return pd.DataFrame({"part": [0], "data": [total.tobytes()]})

    groups = partials.withColumn("part", F.pmod("part", F.lit(SUM_GROUPS)))
    total = np.zeros(size)
    for row in groups.groupBy("part").applyInPandas(add, "part int, data binary").collect():
        total += np.frombuffer(row.data)
    return total


def sum_slices(partials: DataFrame, width: int, slices: int) -> np.ndarray:
    """Add up float64 vectors of ``slices`` equal slices of ``width`` numbers, given as (part int, slice int, data binary).

    Slices are added in up to SUM_GROUPS groups of parts and these once more, so that a group holds little however long the
    vectors are and however many tasks gave one, and the driver gets every slice once. A slice that nobody gave is zero.
    """

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width)
        for data in rows["data"]:
            total += np.frombuffer(data)
        return pd.DataFrame({"slice": rows["slice"].iloc[:1], "data": [total.tobytes()]})

    partly = partials.groupBy("slice", F.pmod("part", F.lit(SUM_GROUPS))).applyInPandas(add, "slice int, data binary")
    total = np.zeros((slices, width))
    for row in partly.groupBy("slice").applyInPandas(add, "slice int, data binary").collect():
        total[row.slice] = np.frombuffer(row.data)
    return total.reshape(-1)


def word_bytes(text: str) -> list[bytes]:
    """The words of a text: runs of anything but ASCII white space, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").split()
