"""Statistics of one text, for the quality classifier and the quality rules."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

WINDOW = 8  # words of a repeated window
SYMBOLS = b"#*$%&|<>"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = [
    "log_words", "chars_per_word", "symbol_share", "pipe_share", "upper_share", "digit_share", "stop_share", "mark_share",
    "non_ascii_share", "distinct_share", "common_share", "dup_line_share", "repeat_share", "lines_per_word",
]


def _mask(chars: bytes) -> np.ndarray:
    mask = np.zeros(256, np.int64)
    mask[list(chars)] = 1
    return mask


_SPACE = _mask(b" \t\n\v\f\r")
_LEAD = np.array([not 0x80 <= b <= 0xBF for b in range(256)], np.int64)  # one per code point
_KINDS = np.stack([
    _LEAD * (1 - _SPACE), _mask(SYMBOLS), _mask(b"|"), _mask(bytes(range(65, 91))), _mask(bytes(range(97, 123))),
    _mask(b"0123456789"), _mask(b".,;:"), _mask(b"!?"), _LEAD * (np.arange(256) >= 128), _mask(b"\n"),
])


def repeated_words(words: list[bytes], window: int = WINDOW) -> tuple[int, int, int]:
    """Words inside windows that occur twice or more, distinct words, and occurrences of the commonest word."""
    if not words:
        return 0, 0, 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    common = int(np.bincount(ids).max())
    n = len(words) - window + 1
    if n < 2:
        return 0, len(known), common
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    hashed = np.zeros(n, np.uint64)
    for k in range(window):
        hashed = hashed * np.uint64(0xD6E8FEB86659FD93) + mixed[k : k + n]
    ordered = np.sort(hashed)
    if not (ordered[1:] == ordered[:-1]).any():  # equal windows have equal hashes
        return 0, len(known), common
    names, width = ids, 1
    while width < window:  # names of windows of doubled width, so equal names mean equal words
        size = min(width, window - width)
        keys = names[: len(names) - size] * (int(names.max()) + 1) + names[size:]
        names = np.unique(keys, return_inverse=True)[1].astype(np.int64)
        width += size
    again = np.bincount(names)[names] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += again
    edges[window : window + n] -= again
    return int((np.cumsum(edges) > 0).sum()), len(known), common


def base_counts(text: str | None) -> tuple[list[int], np.ndarray, tuple[int, ...]]:
    """The five counts of BASE, the character counts, and (distinct words, commonest word, lines with a word)."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    kinds = _KINDS @ np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    lines = [x for x in data.split(b"\n") if x.strip()]
    repeats, distinct, common = repeated_words(words)
    counts = [len(words), int(kinds[0]), int(kinds[1]), len(lines) - len(set(lines)), repeats]
    return counts, kinds, (distinct, common, len(lines))


def statistics(text: str | None) -> list[float]:
    """BASE counts, then FEATURES; an empty or null text has zeros for all of them."""
    counts, kinds, (distinct, common, lines) = base_counts(text)
    words, chars = max(counts[0], 1), max(int(kinds[0]), 1)
    letters = max(int(kinds[3] + kinds[4]), 1)
    shares = [
        float(np.log1p(counts[0])), kinds[0] / words, kinds[1] / chars, kinds[2] / words, kinds[3] / letters, kinds[5] / chars,
        kinds[6] / words, kinds[7] / words, kinds[8] / chars, distinct / words, common / words,
        counts[3] / max(lines, 1), counts[4] / words, lines / words,
    ]
    return [*counts, *shares]


_TYPE = StructType([*(StructField(n, LongType()) for n in BASE), *(StructField(n, DoubleType()) for n in FEATURES)])


@F.pandas_udf(_TYPE)
def _statistics(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        rows = np.array([statistics(x) for x in batch], np.float64).reshape(len(batch), len(BASE) + len(FEATURES))
        out = pd.DataFrame(rows, columns=[*BASE, *FEATURES])
        yield out.astype({n: np.int64 for n in BASE})


def text_statistics(text: Column) -> Column:
    """A struct with BASE and FEATURES of a text column."""
    return _statistics(text)
