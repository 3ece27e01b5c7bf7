"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlens.llm.common import held_out, sum_slices

ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
SMOOTHING = 0.5
MAX_LANGUAGES = 512  # more distinct values than this are no language codes; learning stops with an error
CHUNK = 1 << 18  # characters handled at once
CELLS = 1 << 22  # log probabilities picked at once
UNKNOWN = "und"
_MIX = np.uint32(0x9E3779B1)


def gram_matrix(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of every n-gram of the lower-cased texts, each order over the whole of every text.

    These are the entries of a sparse count matrix of texts and buckets, ascending by row within what is yielded at once:
    one order over texts of about CHUNK characters together, or over a chunk of a longer text.
    """
    reach = max(ORDERS) - 1
    held: list[tuple[int, str, int]] = []  # text, its piece, n-grams start within so many characters of it
    size = 0

    def entries() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        codes = np.frombuffer("".join(x for _, x, _ in held).encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.array([len(x) for _, x, _ in held])
        row = np.repeat([i for i, _, _ in held], lengths)
        at = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        starts, ends = np.repeat([n for _, _, n in held], lengths), np.repeat(lengths, lengths)
        for order in ORDERS:
            n = len(codes) - order + 1
            if n <= 0:
                continue
            h = np.full(n, order, np.uint32)
            for k in range(order):
                h = (h ^ codes[k : k + n]) * _MIX
                h ^= h >> np.uint32(15)
            inside = (at[:n] + order <= ends[:n]) & (at[:n] < starts[:n])
            yield row[:n][inside], (h[inside] % np.uint32(BUCKETS)).astype(np.int64)

    for i, text in enumerate(texts):
        text = text.lower()
        for at in range(0, len(text), CHUNK):
            piece = text[at : at + CHUNK + reach]
            held.append((i, piece, min(CHUNK, len(text) - at)))
            size += len(piece)
            if size >= CHUNK:
                yield from entries()
                held.clear()
                size = 0
    if held:
        yield from entries()


@dataclass
class LanguageModel:
    languages: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray  # BUCKETS x languages, float32

    def log_joint(self, texts: list[str]) -> np.ndarray:
        """Log prior plus log likelihood, texts x languages: the sparse matrix of the batch times the log probabilities.

        An entry picks the row of its bucket, and rows of one text are added up; CELLS numbers are picked at once.
        """
        total = np.tile(self.log_prior, (len(texts), 1))
        step = max(1, CELLS // len(self.languages))
        for row, bucket in gram_matrix(texts):
            for at in range(0, len(row), step):
                here = row[at : at + step]
                first = np.flatnonzero(np.append(True, np.diff(here) != 0))
                total[here[first]] += np.add.reduceat(self.log_prob[bucket[at : at + step]], first, axis=0, dtype=np.float64)
        return total

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The likeliest language of every text (ties: the first by name) and its posterior; ``und`` and 0 without a letter."""
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        known = [i for i, x in enumerate(texts) if x and self.languages and any(map(str.isalpha, x))]
        if known:
            joint = self.log_joint([texts[i] for i in known])
            best = joint.argmax(axis=1)
            scores[known] = 1 / np.exp(joint - joint.max(axis=1, keepdims=True)).sum(axis=1)
            for i, k in zip(known, best, strict=True):
                names[i] = self.languages[k]
        return names, scores


def fit_languages(documents: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learn from every row with text and lang that is not held out.

    Each task counts n-grams in one (languages x BUCKETS) matrix; the matrices are added up by language in two steps. Repeated
    rows count each time. Without such a row nothing is learnt and every prediction is ``und``.
    """
    rows = documents.select("doc_id", F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter(
        "text is not null and lang is not null"
    ).filter(~held_out(F.col("doc_id"))).select("text", "lang")
    seen = sorted((r.lang, r["count"]) for r in rows.groupBy("lang").count().orderBy("lang").limit(MAX_LANGUAGES + 1).collect())
    if len(seen) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    names = [name for name, _ in seen]
    number = {name: i for i, name in enumerate(names)}
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(names), BUCKETS))
        for batch in batches:
            spoken = batch["lang"].map(number).to_numpy()
            for row, bucket in gram_matrix(list(batch["text"])):
                of = spoken[row]
                for k in np.unique(of):
                    total[k] += np.bincount(bucket[of == k], minlength=BUCKETS)
        met = np.flatnonzero(total.any(axis=1))
        yield pd.DataFrame({"part": TaskContext.get().partitionId(), "slice": met, "data": [total[k].tobytes() for k in met]})

    if not names:
        return LanguageModel([], np.zeros(0), np.zeros((BUCKETS, 0), np.float32))
    counts = sum_slices(rows.mapInPandas(count, "part int, slice int, data binary"), BUCKETS, len(names)).reshape(len(names), BUCKETS) + SMOOTHING
    priors = np.array([n for _, n in seen], np.float64)
    return LanguageModel(
        names, np.log(priors / priors.sum()), np.log(counts / counts.sum(axis=1, keepdims=True)).T.astype(np.float32).copy()
    )


def predict_udf(model: LanguageModel):
    """A pandas UDF from a text column to (lang_pred, score); the model travels once per executor. Equal texts have equal results."""
    from pyspark.sql import SparkSession

    sent = SparkSession.getActiveSession().sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang_pred: string, score: double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = sent.value
        for texts in batches:
            names, scores = known.predict(list(texts))
            yield pd.DataFrame({"lang_pred": pd.Series(names, dtype=object), "score": scores})

    return predict
