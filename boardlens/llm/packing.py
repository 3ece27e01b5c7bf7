"""Packing of documents into fixed-length sequences: shortest pack first over the histogram of piece lengths."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType

from boardlens.llm.tokens import word_tokens
from boardlens.operators.lineage import cut

MAX_TOKENS = 4096
END_ID = 2


def token_pieces(documents: DataFrame, tokenizer: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID, text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids): every document's ids, cut each ``max_tokens`` ids.

    ``ids`` are little-endian uint32. Every document ends with ``end_id``; a null or empty text has that id alone.
    """
    step = 4 * max_tokens

    @F.pandas_udf(ArrayType(BinaryType()))
    def pieces(texts: pd.Series) -> pd.Series:
        ids = word_tokens(tokenizer).encode(texts, end_id)
        return pd.Series([[x[i : i + step] for i in range(0, len(x), step)] for x in ids], dtype=object)

    cut_up = documents.select("doc_id", pieces(F.col(text_col)).alias("_p"))
    tokens = F.aggregate("_p", F.lit(0).cast("bigint"), lambda n, p: n + F.octet_length(p)) / 4
    # outer: a plain explode puts a filter on its input, for which the tokenizer would run a second time; every document has a piece
    rows = cut_up.select("doc_id", tokens.cast("bigint").alias("doc_tokens"), F.posexplode_outer("_p").alias("_i", "ids"))
    return rows.select(
        "doc_id", (F.col("_i").cast("bigint") * max_tokens).alias("start"), (F.octet_length("ids") / 4).cast("bigint").alias("length"),
        "doc_tokens", "ids",
    )


def pack_histogram(counts: dict[int, int], max_tokens: int = MAX_TOKENS) -> list[tuple[int, dict[int, int]]]:
    """Packing patterns (number of sequences, {length: pieces of it in each}) for a histogram of lengths.

    Lengths are placed from the longest on, always into the packs that are shortest so far, else into new ones.
    The work and the patterns depend on the number of distinct lengths, not on the pieces.
    """
    open_packs: dict[int, list[tuple[int, dict[int, int]]]] = {}  # by room left
    rooms: list[int] = []
    done: list[tuple[int, dict[int, int]]] = []

    def put(room: int, packs: int, pattern: dict[int, int]) -> None:
        if room == 0:
            done.append((packs, pattern))
            return
        if room not in open_packs:
            open_packs[room] = []
            heapq.heappush(rooms, -room)
        open_packs[room].append((packs, pattern))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = -rooms[0] if rooms else 0
            if room < length:
                put(max_tokens - length, left, {length: 1})
                break
            packs, pattern = open_packs[room].pop()
            if not open_packs[room]:
                del open_packs[room]
                heapq.heappop(rooms)
            following = -rooms[0] if rooms else 0
            each = max(1, min((room - max(following, length)) // length + 1 if room > following else 1, room // length, left // packs))
            used = min(packs, left // each)
            if used < packs:
                put(room, packs - used, pattern)
            put(room - each * length, used, {**pattern, length: pattern.get(length, 0) + each})
            left -= used * each
    return done + [x for packs in open_packs.values() for x in packs]


def pattern_slots(patterns: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Rows (length, first rank, pieces in each sequence, first sequence, offset), sorted by length and rank."""
    rows, ranks, sequence = [], {}, 0
    for packs, pattern in patterns:
        offset = 0
        for length, each in pattern.items():
            rank = ranks.get(length, 0)
            rows.append((length, rank, each, sequence, offset))
            ranks[length] = rank + packs * each
            offset += length * each
        sequence += packs
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _ranked(pieces: DataFrame, rows: int) -> DataFrame:
    """0-based ``_rank`` among the pieces of one length.

    A length may be that of a third of all pieces, so each length is dealt into about sqrt(rows) buckets by a hash of the
    piece; ranks are counted inside a bucket and follow those of the buckets before it.
    """
    buckets = max(1, round(rows**0.5))
    tagged = pieces.withColumn("_bucket", F.pmod(F.xxhash64("_piece"), F.lit(buckets)))
    sizes = tagged.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_bucket").orderBy("_piece")
    numbered = tagged.withColumn("_in", F.row_number().over(inside)).join(offsets, ["length", "_bucket"])
    return numbered.withColumn("_rank", F.col("_before") + F.col("_in") - 1).drop("_bucket", "_in", "_before")


def pack(pieces: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table with an integer ``length`` of 1..max_tokens per row.

    ``pieces`` is evaluated once, into a written table; its other columns are carried along. Pieces of one length are
    interchangeable: rank r of a length takes the r-th slot of that length in the patterns. Equal rows are separate
    pieces. An empty table gives an empty result.
    """
    keyed = cut(pieces.withColumn("_piece", F.monotonically_increasing_id()))
    counts = {int(r.length): int(r.n) for r in keyed.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if counts and (min(counts) < 1 or max(counts) > max_tokens):
        raise ValueError(f"lengths have to be between 1 and {max_tokens}")
    slots = pattern_slots(pack_histogram(counts, max_tokens))
    slot_key = slots[:, 0] << 48 | slots[:, 1]  # ranks stay below 2**48

    @F.pandas_udf("struct<sequence_id: bigint, offset: bigint>")
    def place(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for length, rank in batches:
            size, at = length.to_numpy(np.int64), rank.to_numpy(np.int64)
            s = slots[np.searchsorted(slot_key, size << 48 | at, side="right") - 1]
            nth = at - s[:, 1]
            yield pd.DataFrame({"sequence_id": s[:, 3] + nth // s[:, 2], "offset": s[:, 4] + nth % s[:, 2] * size})

    ranked = _ranked(keyed, sum(counts.values()))
    return ranked.withColumn("_s", place("length", "_rank")).withColumns(
        {"sequence_id": F.col("_s.sequence_id"), "offset": F.col("_s.offset")}
    ).drop("_s", "_rank", "_piece")


def sequences(packed: DataFrame, max_tokens: int = MAX_TOKENS, pad_id: int = 0) -> DataFrame:
    """(sequence_id, length, ids): the packed pieces' ids joined and padded with ``pad_id`` to ``max_tokens`` ids.

    A sequence whose length is a power of two is left unpadded. A sequence holds at most ``max_tokens`` ids, so the groups are small.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("_p")).withColumn(
        "ids", F.aggregate("_p", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    )
    return joined.select("sequence_id", "length", padded("ids", "length", max_tokens, pad_id).alias("ids"))


def padded(ids: str, length: str, max_tokens: int, pad_id: int) -> Column:
    """``ids`` filled up with ``pad_id``, except at a power of two."""
    n = F.col(length)
    fill = F.unhex(F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), (F.lit(max_tokens) - n).cast("int")))
    return F.when(n.bitwiseAND(n - 1) == 0, F.col(ids)).otherwise(F.concat(F.col(ids), fill))
