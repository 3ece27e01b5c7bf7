"""Benchmark decontamination: greedy string tiling of documents against benchmark items."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEED_WORDS = 4  # words of a seed and the least length of a tile; a shorter item is one seed
COVERAGE = 0.5  # covered share of an item's words that marks a document
FILTER_BITS = 24  # of the bitmap that drops seeds no item has, before the shuffle
BROADCAST_SEEDS = 500_000  # item seeds up to here travel to the executors (about 20 MB), more are joined by a shuffle
MEMO_WORDS = 200_000  # words whose hashes a Python worker remembers; a speed setting only
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LETTERS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, 3)
        return value


_hashes = _Hashes()


def rolling_hashes(text: str | None, size: int = SEED_WORDS) -> tuple[np.ndarray, int]:
    """Karp-Rabin hashes of every run of ``size`` words, and the number of words.

    Words are lower-cased runs of letters and digits; ASCII punctuation and white space separate them.
    """
    words = text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split() if text else []
    values = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * _BASE + values[k : k + n]
    return out, len(words)


def short_hashes(text: str | None, size: int) -> np.ndarray:
    """The hashes of the runs of ``size`` < SEED_WORDS words, apart from those of other sizes."""
    return rolling_hashes(text, size)[0] ^ (np.uint64(size) * _BASE)


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def greedy_tiles(at_text: np.ndarray, at_item: np.ndarray, least: int = SEED_WORDS) -> list[tuple[int, int, int]]:
    """Tiles (text word, item word, words) from the places where runs of ``least`` words are equal.

    Runs on one diagonal join into maximal matches. The longest match of unmarked words is marked again and again
    (ties: the first in the text, then in the item); one that meets marked words is cut down to its unmarked stretches.
    """
    order = np.lexsort((at_text, at_text - at_item))
    p, q = at_text[order].astype(np.int64), at_item[order].astype(np.int64)
    if not len(p):
        return []
    fresh = np.concatenate([[True], (np.diff(p - q) != 0) | (np.diff(p) > 1)])
    first = np.flatnonzero(fresh)
    last = np.concatenate([first[1:], [len(p)]]) - 1
    heap = [(-(int(p[b] - p[a]) + least), int(p[a]), int(q[a])) for a, b in zip(first, last, strict=True)]
    heapq.heapify(heap)
    text_marks = np.zeros(int(p.max()) + least, bool)
    item_marks = np.zeros(int(q.max()) + least, bool)
    tiles = []
    while heap:
        size, i, j = heapq.heappop(heap)
        size = -size
        taken = text_marks[i : i + size] | item_marks[j : j + size]
        if not taken.any():
            text_marks[i : i + size] = item_marks[j : j + size] = True
            tiles.append((i, j, size))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[1], taken.astype(np.int8), [1]])))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a >= least:
                heapq.heappush(heap, (-(b - a), i + a, j + a))
    return tiles


def item_seeds(benchmark: DataFrame, size: int = SEED_WORDS) -> DataFrame:
    """(item_id, n_words, h, q): the seeds of every benchmark item; one shorter than a seed is one seed, one without words has none."""

    @F.pandas_udf("struct<n_words: int, h: array<bigint>>")
    def seeds(texts: pd.Series) -> pd.DataFrame:
        found = [rolling_hashes(x, size) for x in texts]
        found = [(short_hashes(x, n) if 0 < n < size else h, n) for x, (h, n) in zip(texts, found, strict=True)]
        return pd.DataFrame({"n_words": [n for _, n in found], "h": [h.view(np.int64).tolist() for h, _ in found]})

    rows = benchmark.select("item_id", seeds(F.col("text")).alias("s"))
    return rows.select("item_id", F.col("s.n_words").alias("n_words"), F.posexplode("s.h").alias("q", "h"))


def contaminated(documents: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *keep, item_id, coverage, n_tiles, longest): every row and item whose tiles cover ``coverage`` of the item's words.

    A bitmap of fixed size drops the words that start no item seed where they are read; the seeds left are joined with
    the items' seeds, and the places of one row and item are tiled together. Their number is bounded by the text and
    the item. Tiles of SEED_WORDS words and more count wherever they stand, so reordered passages are found. Rows are
    judged one by one; an item of fewer words counts where its whole word sequence stands. Null texts match nothing, nor do
    items without words; an empty benchmark gives no rows.
    """
    seeds = item_seeds(benchmark)
    slots = seeds.select(F.shiftrightunsigned("h", 64 - FILTER_BITS).alias("slot")).groupBy((F.col("slot") / 65536).cast("int").alias("high")).agg(
        F.collect_set((F.col("slot") % 65536).cast("int")).alias("low")
    )
    bitmap = np.zeros(1 << FILTER_BITS, bool)
    for r in slots.toLocalIterator():
        bitmap[np.array(r.low, np.int64) + r.high * 65536] = True
    sent = documents.sparkSession.sparkContext.broadcast(np.packbits(bitmap))
    short = sorted(r.n_words for r in seeds.filter(F.col("n_words") < SEED_WORDS).select("n_words").distinct().collect())

    @F.pandas_udf("array<struct<p: int, h: bigint>>")
    def hits(texts: pd.Series) -> pd.Series:
        known = np.unpackbits(sent.value).view(bool)
        out = []
        for text in texts:
            h = rolling_hashes(text)[0]
            p = np.flatnonzero(known[_slot(h)])
            found = [{"p": a, "h": b} for a, b in zip(p.tolist(), h[p].view(np.int64).tolist(), strict=True)]
            for size in short:  # the first place of each run is enough for a whole short item
                h, first = np.unique(short_hashes(text, size), return_index=True)
                hit = known[_slot(h)]
                found += [{"p": a, "h": b} for a, b in zip(first[hit].tolist(), h[hit].view(np.int64).tolist(), strict=True)]
            out.append(found)
        return pd.Series(out, dtype=object)

    @F.pandas_udf("struct<covered: int, n_tiles: int, longest: int>")
    def tile(places: pd.Series, n_words: pd.Series) -> pd.DataFrame:
        out = []
        for place, n in zip(places, n_words, strict=True):
            tiles = greedy_tiles(np.array([x["p"] for x in place], np.int64), np.array([x["q"] for x in place], np.int64), min(SEED_WORDS, n))
            sizes = [n for _, _, n in tiles]
            out.append((sum(sizes), len(sizes), max(sizes)))
        return pd.DataFrame(out, columns=["covered", "n_tiles", "longest"])

    rows = documents.select("doc_id", *keep, F.monotonically_increasing_id().alias("_row"), hits(F.col(text_col)).alias("_h"))
    places = rows.filter(F.size("_h") > 0).select("doc_id", *keep, "_row", F.explode("_h").alias("_x")).select("doc_id", *keep, "_row", "_x.p", "_x.h")
    side = F.broadcast(seeds) if seeds.count() <= BROADCAST_SEEDS else seeds
    met = places.join(side, "h").groupBy("_row", "item_id").agg(
        F.first(F.struct("doc_id", *keep)).alias("_doc"), F.first("n_words").alias("n_words"), F.collect_list(F.struct("p", "q")).alias("_places")
    ).select("_doc.*", "item_id", "n_words", tile("_places", "n_words").alias("_t"))
    return met.select("doc_id", *keep, "item_id", (F.col("_t.covered") / F.col("n_words")).alias("coverage"), "_t.n_tiles", "_t.longest").filter(
        F.col("coverage") >= coverage
    )
