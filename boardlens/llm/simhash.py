"""SimHash near duplicates: fingerprints of word shingles, compared exactly tile by tile with exclusive-or and bit counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from boardlens.llm.common import word_bytes
from boardlens.llm.graph import components
from boardlens.operators.lineage import cut

BITS = 64
SEED = 42
TILE = 1024  # fingerprints of a tile
BANDED_RADIUS = 3  # up to here linked fingerprints are looked for among those that agree on one of radius + 1 bands
HASHES_AT_ONCE = 1 << 16
_U = np.uint64


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of every shingle of ``words`` words, repeats included; a shorter text is one shingle, one without words none."""
    found = word_bytes(text) if text else []
    if not found:
        return np.zeros(0, _U)
    found = b" ".join(found).lower().split(b" ")  # bytes: only A-Z change
    joined = b" ".join(found)
    n = max(1, len(found) - words + 1)
    lengths = np.fromiter(map(len, found), np.int64, len(found)) + 1
    starts = np.concatenate([[0], np.cumsum(lengths)])
    stops = (starts[min(words, len(found)) :][:n] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), stops)), _U, n)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit k is 1 if it is 1 in more than half of the hashes; zero without hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), HASHES_AT_ONCE):
        part = hashes[at : at + HASHES_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, words: int = 3) -> Column:
    """The fingerprint of a text column as a signed 64-bit integer; a null text is one without words."""

    @F.pandas_udf(LongType())
    def fingerprints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(shingle_hashes(x, words)) for x in texts], _U).astype(np.int64))

    return fingerprints(text)


def linked_matrix(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Whether each fingerprint of ``a`` and each of ``b`` differ in at most ``radius`` bits."""
    return np.bitwise_count(a[:, None] ^ b[None, :]) <= radius


def tile_stars(fingerprints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, smallest of its group) inside one tile: as many links as connect what is linked, never all pairs.

    The tile is sorted by bit count and compared stripe against stripe; stripes whose bit counts differ by more than
    the radius are skipped.
    """
    order = np.argsort(np.bitwise_count(fingerprints), kind="stable")
    fps = fingerprints[order]
    ones = np.bitwise_count(fps).astype(np.int64)
    n, stripe = len(fps), 256
    label = np.arange(n)
    pairs: list[tuple[slice, slice, np.ndarray]] = []
    for i in range(0, n, stripe):
        for j in range(i, n, stripe):
            rows, cols = slice(i, min(i + stripe, n)), slice(j, min(j + stripe, n))
            if ones[cols][0] - ones[rows][-1] > radius:
                break
            near = linked_matrix(fps[rows], fps[cols], radius)
            if near.sum() > (len(near) if i == j else 0):
                pairs.append((rows, cols, near))
    while True:
        before = label.copy()
        for rows, cols, near in pairs:
            label[rows] = np.minimum(label[rows], np.where(near, label[cols][None, :], n).min(axis=1))
            label[cols] = np.minimum(label[cols], np.where(near, label[rows][:, None], n).min(axis=0))
        label = label[label]
        if (label == before).all():
            break
    tied = np.flatnonzero(label != np.arange(n))
    return fps[tied], fps[label[tied]]


def _bands(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of radius + 1 bit ranges that cover the fingerprint: two that differ in radius bits agree on one."""
    cuts = [round(i * BITS / (radius + 1)) for i in range(radius + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def fingerprint_links(fingerprints: DataFrame, radius: int = 2) -> DataFrame:
    """(a, b): links that connect all distinct ``fp`` of ``fingerprints`` within ``radius`` bits, a being a smaller tile mate of b.

    A tile key is a band and its value. Keys with up to TILE fingerprints are one tile. Larger ones are dealt by bit
    count and a hash into tiles of about that size, and those pairs of tiles are compared whose bit counts differ by at
    most the radius. Comparison is exact: no pair within the radius is missed, and none beyond is made.
    """
    if not 0 <= radius <= BANDED_RADIUS:
        raise ValueError(f"bands serve radii up to {BANDED_RADIUS}")
    fps = fingerprints.select("fp").filter("fp is not null").distinct()
    keys = [F.struct(F.lit(i).alias("band"), F.shiftrightunsigned("fp", s).bitwiseAND(F.lit((1 << w) - 1)).alias("value")) for i, (s, w) in enumerate(_bands(radius))]
    keyed = cut(fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.band", "k.value", "fp", F.bit_count("fp").alias("ones")))
    sizes = keyed.groupBy("band", "value", "ones").agg(F.count(F.lit(1)).alias("n"))
    totals = sizes.groupBy("band", "value").agg(F.sum("n").alias("total"))
    crowded = totals.filter(F.col("total") > TILE).select("band", "value")
    key = ["band", "value"]

    @F.pandas_udf("array<struct<a: bigint, b: bigint>>")
    def stars(tiles: pd.Series) -> pd.Series:
        out = []
        for tile in tiles:
            b, a = tile_stars(np.asarray(tile, np.int64).view(_U), radius)
            out.append([{"a": x, "b": y} for x, y in zip(a.view(np.int64).tolist(), b.view(np.int64).tolist(), strict=True)])
        return pd.Series(out, dtype=object)

    small = keyed.join(totals.filter(f"total between 2 and {TILE}").select(*key), key, "left_semi")
    tiles = small.groupBy(*key).agg(F.collect_list("fp").alias("fps")).select("fps")

    # crowded keys: tiles by bit count and hash, and the pairs of tiles to compare
    dealt = sizes.join(crowded, key, "left_semi").select(*key, "ones", F.ceil(F.col("n") / F.lit(TILE // 2)).cast("int").alias("parts"))
    tile_of = dealt.select(*key, "ones", "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    left = tile_of.select(*key, F.col("ones").alias("ones_a"), F.col("part").alias("part_a"))
    right = tile_of.select(*key, F.col("ones").alias("ones_b"), F.col("part").alias("part_b"), F.explode(F.sequence(F.col("ones") - radius, F.col("ones"))).alias("ones_a"))
    pairs = left.join(right, [*key, "ones_a"]).filter("ones_a < ones_b or part_a <= part_b")
    sides = pairs.withColumn("pair", F.xxhash64(*key, "ones_a", "part_a", "ones_b", "part_b")).select(
        *key, "pair", F.explode(F.array_distinct(F.array(F.struct(F.col("ones_a").alias("ones"), F.col("part_a").alias("part")), F.struct(F.col("ones_b").alias("ones"), F.col("part_b").alias("part"))))).alias("s")
    ).select(*key, "pair", "s.ones", "s.part")
    rows = keyed.join(dealt, [*key, "ones"]).withColumn("part", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("parts")).cast("int"))
    big = rows.join(sides, [*key, "ones", "part"]).groupBy("pair", *key).agg(F.collect_list("fp").alias("fps")).select("fps")
    return tiles.unionByName(big).select(F.explode(stars("fps")).alias("l")).select("l.a", "l.b").distinct()


def near_duplicates(documents: DataFrame, radius: int = 2, words: int = 3, text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row: component_id is the smallest doc_id linked to it over any number of links.

    ``fingerprint`` has 16 lower-case hex digits. Copies share a fingerprint and are never paired. Null texts and texts
    without words have fingerprint zero, which links like any other. Null ids take part; a component of null ids only
    has a null component_id.
    """
    prints = cut(documents.select("doc_id", fingerprint_column(F.col(text_col), words).alias("fp")))
    lowest = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    joined = components(fingerprint_links(lowest, radius))
    groups = lowest.join(joined, lowest.fp == joined.node, "left").select("fp", "low", F.coalesce("component", "fp").alias("component"))
    ids = groups.groupBy("component").agg(F.min("low").alias("component_id"))
    named = groups.join(ids, "component").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
