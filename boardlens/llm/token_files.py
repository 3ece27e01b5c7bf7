"""Token-id files: Simple-8b words with selectors, escapes and block offsets, written and read by Spark.

A file is a Parquet folder whose rows are segments, each one byte string in the layout below, so that Spark's own
readers and writers reach it in any store. Numbers are little-endian.

    magic "S8B1" | documents u32 | ids u64 | ids of the shard before it u64 | blocks u32 | words u64 | escapes u32
    document ids i64[documents] | document lengths u64[documents] | first word of each block u64[blocks + 1]
    words u64[words] | escaped positions u64[escapes] | escaped values u64[escapes]

A block holds BLOCK ids (the last one fewer) and starts with a new word, so any range of ids decodes from its blocks alone.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlens.llm.tokens import word_tokens

# Fixed values: (values, bits of each) by selector, as Simple-8b defines them.
SELECTORS = [
    (240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
]
ESCAPE_BITS = 30  # larger values go to the escapes and leave a zero
BLOCK = 16_384
SEGMENT_IDS = 1 << 20
_HEAD = struct.Struct("<4sIQQIQI")
_COUNT = np.array([c for c, _ in SELECTORS])
_U = np.uint64


def pack_words(values: np.ndarray) -> np.ndarray:
    """Simple-8b words of uint64 values below 2**ESCAPE_BITS; each word takes as many of the next values as any selector can."""
    n = len(values)
    if not n:
        return np.zeros(0, _U)
    reach = _COUNT[0]
    bits = np.zeros(n + reach, np.int8)  # what follows the last value fits anywhere
    bits[:n] = np.frexp(values.astype(np.float64))[1]
    most = int(bits.max())
    selector = np.full(n, len(SELECTORS) - 1, np.int64)
    fits = np.arange(n)  # where the selector before can start, and so the only places for the finer ones
    for s in range(len(SELECTORS) - 2, -1, -1):
        count, width = SELECTORS[s]
        if most > width:
            narrow = bits <= width
            for k in range(count):
                fits = fits[narrow[fits + k]]
                if not len(fits):
                    break
        if not len(fits):
            break
        selector[fits] = s
    following = (np.arange(n) + _COUNT[selector]).tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at = following[at]
    start = np.array(starts)
    chosen = selector[start]
    words = chosen.astype(_U) << _U(60)
    padded = np.concatenate([values.astype(_U), np.zeros(reach, _U)])
    for s in np.unique(chosen).tolist():
        count, width = SELECTORS[s]
        if width:
            rows = np.flatnonzero(chosen == s)
            k = np.arange(count)
            taken = padded[start[rows][:, None] + k] << (k * width).astype(_U)
            words[rows] |= np.bitwise_or.reduce(taken, axis=1)
    return words


def unpack_words(words: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` values of Simple-8b words."""
    selector = (words >> _U(60)).astype(np.int64)
    counts = _COUNT[selector]
    ends = np.cumsum(counts)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, _U)
    for s in np.unique(selector).tolist():
        count, width = SELECTORS[s]
        if width:
            rows = np.flatnonzero(selector == s)
            k = np.arange(count)
            out[(ends[rows] - count)[:, None] + k] = (words[rows][:, None] >> (k * width).astype(_U)) & _U((1 << width) - 1)
    return out[:n]


def encode_segment(doc_ids: list[int], ids: list[np.ndarray], before: int = 0) -> bytes:
    """One segment of whole documents; ``before`` counts the ids of its shard that precede it."""
    values = np.concatenate(ids).astype(_U) if ids else np.zeros(0, _U)
    wide = np.flatnonzero(values >> _U(ESCAPE_BITS))
    escaped = values[wide]
    values[wide] = 0
    blocks = [pack_words(values[i : i + BLOCK]) for i in range(0, len(values), BLOCK)]
    offsets = np.cumsum([0, *map(len, blocks)]).astype("<u8")
    words = np.concatenate(blocks) if blocks else np.zeros(0, _U)
    head = _HEAD.pack(b"S8B1", len(doc_ids), len(values), before, len(blocks), len(words), len(wide))
    lengths = np.array([len(x) for x in ids], "<u8")
    return b"".join([
        head, np.array(doc_ids, "<i8").tobytes(), lengths.tobytes(), offsets.tobytes(), words.astype("<u8").tobytes(),
        wide.astype("<u8").tobytes(), escaped.astype("<u8").tobytes(),
    ])


class Segment:
    """A view of a segment's parts; ids are decoded on demand."""

    def __init__(self, data: bytes) -> None:
        magic, docs, self.n, self.before, blocks, words, escapes = _HEAD.unpack_from(data)
        if magic != b"S8B1":
            raise ValueError("not a token segment")
        at = _HEAD.size
        parts = []
        for kind, count in (("<i8", docs), ("<u8", docs), ("<u8", blocks + 1), ("<u8", words), ("<u8", escapes), ("<u8", escapes)):
            parts.append(np.frombuffer(data, kind, count, at))
            at += 8 * count
        self.doc_ids, self.lengths, self.offsets, self.words, self.escaped_at, self.escaped = parts

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """The ids of positions [start, stop), from their blocks only."""
        stop = self.n if stop is None else min(stop, self.n)
        if start >= stop:
            return np.zeros(0, _U)
        first, last = start // BLOCK, (stop - 1) // BLOCK
        base = first * BLOCK
        parts = [
            unpack_words(self.words[int(self.offsets[b]) : int(self.offsets[b + 1])], min(BLOCK, self.n - b * BLOCK)) for b in range(first, last + 1)
        ]
        out = np.concatenate(parts)
        a, b = np.searchsorted(self.escaped_at, [base, base + len(out)])
        out[(self.escaped_at[a:b] - _U(base)).astype(np.int64)] = self.escaped[a:b]
        return out[start - base : stop - base]


def write_token_files(documents: DataFrame, path: str, tokenizer: str, end_id: int = 1, text_col: str = "text") -> None:
    """Write the ids of every document, each followed by ``end_id``, in ascending order of doc_id.

    The order is made by range partitions, one shard each; equal ids follow one another by a hash of their text. Null
    ids come first (stored as the smallest integer), a null text is empty. An empty table writes no segment.
    """

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, number, before = TaskContext.get().partitionId(), 0, 0
        docs: list[int] = []
        ids: list[np.ndarray] = []
        held = 0

        def segment() -> pd.DataFrame:
            return pd.DataFrame({"shard": [shard], "segment": [number], "n_docs": [len(docs)], "n_ids": [held], "data": [encode_segment(docs, ids, before)]})

        coder = word_tokens(tokenizer)
        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                row = np.frombuffer(coder.encode([text], end_id)[0], "<u4")
                docs.append(int(doc))
                ids.append(row)
                held += len(row)
                if held >= SEGMENT_IDS:
                    yield segment()
                    number, before, held = number + 1, before + held, 0
                    docs.clear()
                    ids.clear()
        if docs:
            yield segment()

    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).alias("doc_id")
    rows = documents.select(key, F.col(text_col).alias("text")).withColumn("_tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").drop("_tie")
    ordered.mapInPandas(encode, "shard int, segment int, n_docs bigint, n_ids bigint, data binary").write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): each document's ids as little-endian uint32, ``start`` counted over all files.

    The driver gets one total for each shard, whose number is that of the tasks that wrote them.
    """
    files = spark.read.schema("shard int, segment int, n_docs bigint, n_ids bigint, data binary").parquet(path)
    totals = {r.shard: r.n for r in files.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()}
    bases, total = {}, 0
    for shard in sorted(totals):
        bases[shard] = total
        total += totals[shard]

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, data in zip(batch["shard"], batch["data"], strict=True):
                segment = Segment(data)
                ids = segment.ids().astype("<u4")
                ends = np.cumsum(segment.lengths.astype(np.int64))
                starts = ends - segment.lengths.astype(np.int64)
                yield pd.DataFrame({
                    "doc_id": segment.doc_ids, "start": bases[shard] + segment.before + starts, "n_tokens": ends - starts,
                    "ids": [ids[a:b].tobytes() for a, b in zip(starts, ends, strict=True)],
                })

    out = files.select("shard", "data").mapInPandas(decode, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id")))
