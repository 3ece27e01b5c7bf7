"""Quality scores: random Fourier features, ridge regression from partition sums, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlens.llm.common import labelled, sum_arrays
from boardlens.llm.textstats import FEATURES, text_statistics

SEED = 7
DIMENSIONS = 192  # random features
WIDTH = 2.5  # of the Gaussian kernel, in standard deviations of a statistic
RIDGE = 1e-4  # per learnt row
CLIP = 6.0  # standard deviations
BINS = 4096  # of the raw score, between -1 and 2
CUTOFF = 0.7


@dataclass
class QualityModel:
    """Everything a score needs; its size depends on DIMENSIONS and BINS only."""

    mean: np.ndarray
    scale: np.ndarray
    phases: np.ndarray
    directions: np.ndarray
    weights: np.ndarray
    points: np.ndarray
    levels: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -CLIP, CLIP)
        waves = np.cos(z @ self.directions + self.phases) * np.sqrt(2.0 / DIMENSIONS)
        return np.hstack([waves, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.points, self.levels)


def isotonic(mean: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence closest to ``mean`` by weighted squares: pools of adjacent violators."""
    pools: list[list[float]] = []
    for m, w in zip(mean, weight, strict=True):
        pools.append([float(m), float(w), 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            m2, w2, n2 = pools.pop()
            m1, w1, n1 = pools.pop()
            pools.append([(m1 * w1 + m2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(int(n), m) for m, _, n in pools]) if pools else np.zeros(0)


def with_statistics(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """(doc_id, stats array<double>): the FEATURES of every row, in that order."""
    s = text_statistics(F.col(text_col))
    return documents.select("doc_id", s.alias("_s")).select("doc_id", F.array(*[F.col("_s")[n] for n in FEATURES]).alias("stats"))


def fit_quality(stats: DataFrame, labels: DataFrame, label: str = "quality") -> QualityModel:
    """Learn from every labelled row of ``stats`` (doc_id, stats) that is not held out.

    Three quarters of them, by a hash of the id, give the normal equations; the rest calibrates. Labels
    outside 0..1 are clipped; without any labelled row every score is 0.5.
    """
    rows = labelled(stats, labels.select("doc_id", label), label).select(
        "stats", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "label")).alias("label"), (F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0).alias("calibrates")
    )
    k = len(FEATURES)
    sums = [f(F.col("stats")[i]) for i in range(k) for f in (F.avg, F.stddev_pop)]
    first = np.array([x if x is not None else 0.0 for x in rows.agg(*sums).first()], np.float64)
    rng = np.random.default_rng(SEED)
    model = QualityModel(
        mean=first[0::2], scale=np.maximum(first[1::2], 1e-6), phases=rng.uniform(0, 2 * np.pi, DIMENSIONS),
        directions=rng.normal(0, 1 / WIDTH, (k, DIMENSIONS)), weights=np.zeros(DIMENSIONS + 1),
        points=np.array([-1.0, 2.0]), levels=np.array([0.5, 0.5]),
    )
    d = DIMENSIONS + 1

    def sums_of_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((d, d + 1))
        for batch in batches:
            if len(batch):
                x = model.features(np.stack(batch["stats"].to_numpy()))
                total += x.T @ np.hstack([x, batch[["label"]].to_numpy()])
        yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "data": [total.tobytes()]})

    learns = rows.filter("not calibrates").select("stats", "label")
    total = sum_arrays(learns.mapInPandas(sums_of_task, "part int, data binary"), d * (d + 1)).reshape(d, d + 1)
    n = total[d - 1, d - 1]  # the constant feature counts the rows
    if n == 0:
        return model
    model.weights = np.linalg.solve(total[:, :d] + np.eye(d) * (RIDGE * n), total[:, d])

    @F.pandas_udf("int")
    def bin_of(stats: pd.Series) -> pd.Series:
        raw = model.raw(np.stack(stats.to_numpy())) if len(stats) else np.zeros(0)
        return pd.Series(np.clip((raw + 1) / 3 * BINS, 0, BINS - 1).astype(np.int32))

    bins = rows.filter("calibrates").select(bin_of("stats").alias("bin"), "label")
    held = sorted(bins.groupBy("bin").agg(F.avg("label").alias("mean"), F.count(F.lit(1)).alias("n")).collect(), key=lambda r: r.bin)
    if held:
        model.points = np.array([(r.bin + 0.5) / BINS * 3 - 1 for r in held])
        model.levels = isotonic(np.array([r["mean"] for r in held]), np.array([r.n for r in held]))
    return model


def score_udf(model: QualityModel):
    """A pandas UDF from the statistics array to the calibrated score."""

    @F.pandas_udf("double")
    def score(stats: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(stats.to_numpy())) if len(stats) else np.zeros(0))

    return score


def text_score_udf(model: QualityModel):
    """A pandas UDF from the text itself to the calibrated score."""
    from boardlens.llm.textstats import BASE, statistics

    skip = len(BASE)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array([statistics(x)[skip:] for x in texts])) if len(texts) else np.zeros(0))

    return score
