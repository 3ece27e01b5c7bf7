"""Near duplicates by word shingles: SimHash and rare shingles propose, the shingle sets decide, one document of each group stays."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardlens.llm.graph import components
from boardlens.llm.simhash import fingerprint, fingerprint_links, shingle_hashes
from boardlens.operators.lineage import cut

WORDS = 5  # of the shingles whose sets are compared
SIMILARITY = 0.8  # shared share of the union of two sets
RADIUS = 3  # bits; the closest texts meet by their fingerprints, all others by rare shingles
SAMPLE = 4096  # texts that show which shingles are common; this orders the shingles and drops none
MARKS = 1 << 24  # bits of the map of keys that a join needs
LEVEL = 1.06  # step between the sizes that rows of crowded shingles are dealt by
CROWDED = 64  # texts with a shingle in common
PART = 512  # shingles that a chunk of prefixes sends to a range of shingle hashes
_U = np.uint64


def text_key(text: Column) -> Column:
    """128 bits of a text's content; null and empty texts share one key."""
    text = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(text).alias("hi"), F.xxhash64(text, F.lit(1)).alias("lo"))


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted."""
    return np.unique(shingle_hashes(text, words))


def prefix(shingles: np.ndarray, common: np.ndarray, met: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """The rarest n - ceil(similarity * n) + 1 of n shingles: two sets of that similarity share one of these.

    That holds for any fixed order of all shingles. This one is by how often the sample met them (``common`` sorted, with
    its counts ``met``), then by hash.
    """
    n = len(shingles)
    times = np.zeros(n, np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
        times = np.where(common[at] == shingles, met[at], 0)
    return shingles[np.lexsort((shingles, times))[: n - ceil(similarity * n - 1e-9) + 1 if n else 0]]


def _common_shingles(documents: DataFrame, words: int, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that more than two of about SAMPLE texts hold, sorted, and how many hold them."""
    ids = F.pandas_udf(lambda texts: pd.Series([shingle_set(x, words).view(np.int64).tolist() for x in texts], dtype=object), "array<bigint>")
    keyed = documents.select(F.xxhash64(F.col(text_col), F.lit(11)).alias("place"), F.col(text_col).alias("text"))
    step = max(1, documents.count() // SAMPLE)
    met = keyed.filter(F.pmod("place", F.lit(step)) == 0).dropDuplicates(["place"]).select(F.explode_outer(ids("text")).alias("s"))
    often = met.groupBy("s").count().filter("count > 2 and s is not null").orderBy(F.desc("count"), "s").limit(SAMPLE * 64).collect()
    often.sort(key=lambda r: r.s & 0xFFFFFFFFFFFFFFFF)
    return np.array([r.s for r in often], np.int64).view(_U), np.array([r["count"] for r in often], np.int64)


def _portion(shingles: int) -> int:
    """Shingles of a chunk and of a range: a chunk's part of a range has about PART of them, however many there are."""
    return int(min(max(round((PART * shingles) ** 0.5), 1 << 14), 1 << 22))


def _sharing(prefixes: DataFrame) -> DataFrame:
    """(shingle, hi, lo, n, pos, low_hi, low_lo, low_n, low_pos, crowded) for every text whose prefix holds a shingle of another text's prefix.

    ``pos`` is the shingle's place in the text's prefix, ``n`` its set's size; ``low`` is, among the texts of about that size that share
    the shingle, the one that has it first in its prefix: the text with the fewest rare shingles of its own, so that edited copies
    meet the text they come from. More than CROWDED texts share a ``crowded`` shingle. Prefixes travel packed: chunks of documents send their parts of ranges of shingle hashes.
    Copies of a text are one text.
    """
    total = prefixes.agg(F.coalesce(F.sum(F.length("shingles")), F.lit(0))).first()[0] // 8
    portion = _portion(total)
    buckets = 1 + total // portion
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], _U)

    def chunked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, tuple]] = []

        def packed() -> pd.DataFrame:
            shingles = np.concatenate([s for s, _ in held])
            doc = np.repeat(np.arange(len(held)), [len(s) for s, _ in held])
            pos = np.concatenate([np.arange(len(s)) for s, _ in held])
            order = np.argsort(shingles, kind="stable")
            shingles, doc, pos = shingles[order], doc[order], pos[order]
            docs = np.array([d for _, d in held], np.int64).reshape(len(held), 3)
            cuts = [0, *np.searchsorted(shingles, edges).tolist(), len(shingles)]
            out = []
            for b in range(buckets):
                part = slice(cuts[b], cuts[b + 1])
                if part.stop > part.start:
                    own, at = np.unique(doc[part], return_inverse=True)
                    out.append((b, shingles[part].tobytes(), docs[own].tobytes(), at.astype(np.uint32).tobytes(), pos[part].astype(np.uint32).tobytes()))
            return pd.DataFrame(out, columns=["bucket", "shingles", "docs", "at", "pos"])

        n = 0
        for batch in batches:
            for r in batch.itertuples():
                held.append((np.frombuffer(r.shingles, _U), (r.hi, r.lo, r.n)))
                n += len(held[-1][0])
                if n >= portion:
                    yield packed()
                    held.clear()
                    n = 0
        if held:
            yield packed()

    def shared(part: pd.DataFrame) -> pd.DataFrame:
        shingles = np.concatenate([np.frombuffer(x, _U) for x in part["shingles"]])
        own = [np.frombuffer(x, np.int64).reshape(-1, 3) for x in part["docs"]]
        starts = np.cumsum([0, *[len(x) for x in own[:-1]]])
        doc = np.concatenate([np.frombuffer(x, np.uint32).astype(np.int64) + k for x, k in zip(part["at"], starts, strict=True)])
        pos = np.concatenate([np.frombuffer(x, np.uint32) for x in part["pos"]])
        docs, text = np.unique(np.concatenate(own), axis=0, return_inverse=True)  # in the order of the keys, copies as one
        doc = text.reshape(-1)[doc]
        level = (np.log(docs[:, 2]) / np.log(1.25)).astype(np.int64)[doc]
        order = np.lexsort((doc, pos, level, shingles))
        shingles, level, doc, pos = shingles[order], level[order], doc[order], pos[order]
        first = np.append(True, (np.diff(shingles) != 0) | (np.diff(doc) != 0))
        shingles, level, doc, pos = shingles[first], level[first], doc[first], pos[first]
        fresh = np.append(True, np.diff(shingles) != 0)
        run = np.cumsum(fresh) - 1
        texts = np.bincount(run)[run]
        hit = texts > 1
        begins = fresh | np.append(True, np.diff(level) != 0)
        run = np.cumsum(begins) - 1
        found, low = docs[doc[hit]], docs[doc[begins][run[hit]]]
        low_pos = pos[begins][run[hit]].astype(np.int64)
        return pd.DataFrame({
            "shingle": shingles[hit].view(np.int64), "hi": found[:, 0], "lo": found[:, 1], "n": found[:, 2], "pos": pos[hit].astype(np.int64),
            "low_hi": low[:, 0], "low_lo": low[:, 1], "low_n": low[:, 2], "low_pos": low_pos,
            "crowded": texts[hit] > CROWDED,
        })

    flat = prefixes.select(F.col("key.hi").alias("hi"), F.col("key.lo").alias("lo"), "n", "shingles")
    dealt = flat.mapInPandas(chunked, "bucket int, shingles binary, docs binary, at binary, pos binary")
    kinds = "shingle bigint, hi bigint, lo bigint, n bigint, pos bigint, low_hi bigint, low_lo bigint, low_n bigint, low_pos bigint, crowded boolean"
    return dealt.groupBy("bucket").applyInPandas(shared, kinds)


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of keys whose sets share ``similarity`` of their union."""

    @F.pandas_udf("boolean")
    def similar(one: pd.Series, other: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(one, other, strict=True):
            x, y = np.frombuffer(x, _U), np.frombuffer(y, _U)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(both >= similarity * (len(x) + len(y) - both))
        return pd.Series(out, dtype=bool)

    side = lambda name: sets.select(F.col("key").alias(name), F.col("shingles").alias(f"s_{name}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").filter(similar("s_a", "s_b")).select("a", "b")


def _grouped(keys: DataFrame, links: DataFrame) -> DataFrame:
    """(key, component) for all ``keys``, component being the smallest key linked over any number of links."""
    found = components(links)
    return keys.join(found, keys.key == found.node, "left").select("key", F.coalesce("component", "key").alias("component"))


def _hits(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows with ``_hit``: false only if their key is none of ``wanted``, by a map of MARKS bits (2 MB for any number of keys).

    So rows that have no part in a join don't have to be shuffled for it, as long as the map isn't full; exact joins follow.
    """
    mark = F.pmod("key.hi", F.lit(MARKS))
    bits = wanted.select(mark.alias("_m")).groupBy(F.bitmap_bucket_number("_m").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_m")).alias("_bits"))
    place = F.bitmap_bit_position("_mark")
    byte = F.conv(F.hex(F.substring("_bits", (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = rows.withColumn("_mark", mark).join(F.broadcast(bits), F.bitmap_bucket_number("_mark") == F.col("_bucket"), "left")
    return found.select(*rows.columns, F.coalesce(F.floor(byte / F.pow(F.lit(2.0), place % 8)) % 2 == 1, F.lit(False)).alias("_hit"))


def _size_fits(x: Column, y: Column, similarity: float) -> Column:
    return F.least(x, y) >= F.lit(similarity) * F.greatest(x, y) - F.lit(1e-6)


def _first_fits(n_a: Column, pos_a: Column, n_b: Column, pos_b: Column, similarity: float) -> Column:
    """Sets whose first common shingle may be at these places: what they share are this one and shingles behind it in both."""
    wanted = F.lit(similarity / (1 + similarity)) * (n_a + n_b) - F.lit(1e-6)
    return _size_fits(n_a, n_b, similarity) & (F.least(n_a - pos_a, n_b - pos_b) >= wanted)


def _any_fits(n_a: Column, pos_a: Column, n_b: Column, pos_b: Column, similarity: float) -> Column:
    """Sets that share a shingle at these places: all before it can be shared too, but not more than the smaller place."""
    wanted = F.lit(similarity / (1 + similarity)) * (n_a + n_b) - F.lit(1e-6)
    return _size_fits(n_a, n_b, similarity) & (F.least(n_a - pos_a, n_b - pos_b) + F.least(pos_a, pos_b) >= wanted)


def _enough(rows: DataFrame, similarity: float, hidden: DataFrame | None = None) -> DataFrame:
    """(a, b) of rows (a, b, n_a, n_b, _seen, _first) with as many common rare shingles as the similarity needs, one that may be the first.

    Of the text whose rare shingles end first in their order, none but these can meet rare ones of the other; its others are
    ceil(similarity * n) - 1, so the rest of what has to be shared are rare shingles of both. ``hidden`` (key, _hidden) tells how many of
    a text's rare shingles are not counted in ``_seen``.
    """
    pairs = rows.groupBy("a", "b", "n_a", "n_b").agg(F.sum("_seen").alias("_seen"), F.max("_first").alias("_first")).filter("_first")
    others = F.ceil(F.lit(similarity) * F.greatest("n_a", "n_b") - F.lit(1e-9)) - 1
    needs = F.lit(similarity / (1 + similarity)) * (F.col("n_a") + F.col("n_b")) - F.lit(1e-6) - others
    seen = F.col("_seen")
    if hidden is not None:
        for side in "ab":
            pairs = pairs.join(hidden.select(F.col("key").alias(side), F.col("_hidden").alias(f"_hidden_{side}")), side, "left")
        seen += F.least(F.coalesce("_hidden_a", F.lit(0)), F.coalesce("_hidden_b", F.lit(0)))
    return pairs.filter(seen >= needs).select("a", "b")


def _meetings(rows: DataFrame, similarity: float) -> DataFrame:
    """(a, b) of ``rows`` (shingle, key, component, n, pos, crowded): texts of different components that may be similar.

    Texts of a shingle that few have all meet there, and their common shingles are counted. In crowded shingles only those meet
    whose first common shingle it may be: a place leaves n - pos shingles to share, so it bounds the other's size, and rows meet by
    levels of both sizes within these bounds; side a is the smaller set. As one of a pair is not of the shingle's largest
    component, rows of that one don't meet each other.
    """
    parts = rows.filter("crowded").groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("_n"))
    lists = parts.groupBy("shingle").agg(F.max(F.struct("_n", "component")).alias("_m")).select("shingle", F.col("_m.component").alias("_most"))
    hidden = rows.filter("crowded").groupBy("key").agg(F.count(F.lit(1)).alias("_hidden"))
    names = lambda side: [F.col(x).alias(f"{x}_{side}") for x in ("key", "component", "n", "pos")]
    places = [F.col(x) for x in ("n_a", "pos_a", "n_b", "pos_b")]
    plain = rows.filter("not crowded")
    met = plain.select("shingle", *names("a")).join(plain.select("shingle", *names("b")), "shingle")
    met = met.filter(F.expr("component_a < component_b") & _any_fits(*places, similarity))
    ends = [F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b"), F.least("n_a", "n_b").alias("n_a"), F.greatest("n_a", "n_b").alias("n_b")]
    one = lambda met, seen, first: met.select(*ends, F.lit(seen).alias("_seen"), first.alias("_first"))
    found = one(met, 1, _first_fits(*places, similarity))

    n = F.col("n").cast("double")
    share = similarity / (1 + similarity)
    other = (n - F.col("pos") + F.lit(1e-6)) / F.lit(share) - n + F.lit(1e-3)  # shingles the other may have
    least = n * F.lit(similarity) - F.lit(1e-3)
    level = lambda x: F.floor(F.log(F.greatest(x, F.lit(1.0))) / F.log(F.lit(LEVEL))).cast("int")
    reach = lambda low, high: F.explode(F.sequence(level(low), level(high)))
    crowd = cut(rows.filter("crowded").join(lists, "shingle").withColumn("_other", other))
    minor = (F.col("component") != F.col("_most")).alias("_minor")
    a = crowd.filter("_other >= n").select("shingle", level(n).alias("_la"), reach(n, F.least(F.col("_other"), n / F.lit(similarity) + 1)).alias("_lb"), minor, *names("a"))
    b = crowd.filter(F.col("_other") >= least).select("shingle", level(n).alias("_lb"), reach(least, F.least(F.col("_other"), n)).alias("_la"), minor, *names("b"))
    for small, large in ((a.filter("_minor"), b), (a.filter("not _minor"), b.filter("_minor"))):
        met = small.drop("_minor").join(large.drop("_minor"), ["shingle", "_la", "_lb"])
        met = met.filter(F.expr("component_a <> component_b and (n_a < n_b or n_a = n_b and key_a < key_b)") & _first_fits(*places, similarity))
        found = found.unionByName(one(met, 0, F.lit(True)))
    return _enough(found, similarity, hidden)


def similar_groups(
    documents: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, radius: int = RADIUS, text_col: str = "text"
) -> DataFrame:
    """(key, component) for every distinct text: its ``text_key`` and the smallest key that similar pairs connect it to.

    Two texts are similar if their sets of ``words``-word shingles share ``similarity`` of their union. Every text's shingles are hashed
    once, into its fingerprint and its rarest shingles; equal texts are one text, those without words stay alone. Candidates
    are, first, texts of one group of fingerprints linked within ``radius`` bits with the smallest of the group, and texts that share
    a rare shingle with the smallest text that has it: a group of k near copies makes about k pairs. Then all pairs
    with a shared rare shingle between the groups found so, as far as sizes and places leave enough to share. Sets of texts
    that are candidates are made once and decide, so no similar pair is missed: two similar texts always meet at the first rare
    shingle that they share.
    """
    common = documents.sparkSession.sparkContext.broadcast(_common_shingles(documents, words, text_col))

    @F.pandas_udf("struct<fp: bigint, n: int, shingles: binary>")
    def prepared(texts: pd.Series) -> pd.DataFrame:
        found = [shingle_set(x, words) for x in texts]
        fps = np.array([fingerprint(x) for x in found], _U).astype(np.int64)
        rare = [prefix(x, *common.value, similarity).tobytes() for x in found]
        return pd.DataFrame({"fp": fps, "n": [len(x) for x in found], "shingles": rare})

    sets = F.pandas_udf(lambda texts: pd.Series([shingle_set(x, words).tobytes() for x in texts], dtype=object), "binary")

    def sets_of(pairs: DataFrame, but: DataFrame | None = None) -> DataFrame:
        """The sets of the texts in the pairs, copies once, added to the sets known."""
        wanted = pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key"))).distinct()
        if but is not None:
            wanted = cut(wanted.join(but.select("key"), "key", "left_anti"))
            if wanted.isEmpty():
                return but
            return but.unionByName(sets_of(wanted.select(F.col("key").alias("a"), F.col("key").alias("b"))))
        # merged, so that dropping the copies finds the texts dealt by key already; inner, as a semi join would be moved before the map
        wanted = cut(wanted)
        return cut(_hits(rows, wanted).filter("_hit").drop("_hit").join(wanted.hint("merge"), "key").dropDuplicates(["key"]).select("key", sets("text").alias("shingles")))

    rows = documents.select(text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    known = cut(rows.select("key", prepared("text").alias("p")).select("key", "p.fp", "p.n", "p.shingles"))
    keys = known.select("key").distinct()
    worded = known.filter("n > 0")

    # texts whose fingerprints are linked, each with the smallest of its group
    prints = cut(worded.select("key", "fp", "n").distinct())
    tied = components(fingerprint_links(prints, radius))
    tops = prints.join(tied, prints.fp == tied.node, "left").select("key", "n", F.coalesce("component", "fp").alias("top"))
    lows = tops.groupBy("top").agg(F.min(F.struct("key", "n")).alias("low"))
    printed = tops.join(lows, "top").filter((F.col("key") != F.col("low.key")) & _size_fits(F.col("n"), F.col("low.n"), similarity))
    printed = printed.select(F.col("low.key").alias("a"), F.col("key").alias("b"))

    # texts that share a rare shingle, each with the one of about its size that has it first
    ends = cut(_sharing(worded.select("key", "n", "shingles")))
    ends = ends.select("shingle", F.struct("hi", "lo").alias("key"), "n", "pos", F.struct(F.col("low_hi").alias("hi"), F.col("low_lo").alias("lo")).alias("low"), "low_n", "low_pos", "crowded")
    places = [F.col(x) for x in ("n", "pos", "low_n", "low_pos")]
    starred = ends.filter((F.col("key") != F.col("low")) & _any_fits(*places, similarity)).select(
        F.least("low", "key").alias("a"), F.greatest("low", "key").alias("b"), F.least("low_n", "n").alias("n_a"), F.greatest("low_n", "n").alias("n_b"),
        F.lit(1).alias("_seen"), _first_fits(*places, similarity).alias("_first"), "crowded",
    )
    crowds = starred.filter("crowded and _first").select("a", "b")  # edited copies share few of the shingles that one text has first
    first = cut(printed.unionByName(_enough(starred, similarity)).unionByName(crowds).distinct())
    heavy = sets_of(first)
    groups = cut(_grouped(keys, _verified(first, heavy, similarity)))

    # all other pairs with a rare shingle in common, between different groups
    placed = ends.select("shingle", "key", "n", "pos", "crowded").join(groups, "key")
    mixed = placed.groupBy("shingle").agg(F.min("component").alias("_l"), F.max("component").alias("_h")).filter("_l <> _h").select("shingle")
    open_ = cut(placed.join(mixed, "shingle", "left_semi"))
    pairs = cut(_meetings(open_, similarity).join(first, ["a", "b"], "left_anti"))
    more = cut(_verified(pairs, sets_of(pairs, heavy), similarity))
    of = lambda name: groups.select(F.col("key").alias(name), F.col("component").alias(f"c_{name}"))
    joined = components(more.join(of("a"), "a").join(of("b"), "b").select(F.col("c_a").alias("a"), F.col("c_b").alias("b"))).withColumnRenamed("component", "_top")
    return groups.join(joined, groups.component == joined.node, "left").select("key", F.coalesce("_top", "component").alias("component"))


def distinct_documents(documents: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``documents`` that stay: of each group of similar texts the one with the smallest doc_id.

    A null id counts as larger than any other; of equal ids the smaller text key stays, of equal rows one. Texts without
    words are similar to nothing: copies of one such text are equal texts and leave one row. All columns are kept.
    """
    doc = F.struct("*").alias("doc")
    rows = documents.select(text_key(F.col(text_col)).alias("key"), F.coalesce(F.col("doc_id"), F.lit((1 << 63) - 1)).alias("_id"), doc)
    groups = similar_groups(documents, text_col=text_col, **options)
    firsts = cut(rows.groupBy("key").agg(F.min("_id").alias("_id"), F.count(F.lit(1)).alias("_copies")).join(groups, "key"))
    staying = firsts.groupBy("component").agg(F.min(F.struct("_id", "key")).alias("s"), F.count(F.lit(1)).alias("_texts"))
    shared = firsts.join(staying.filter("_texts > 1").select("component", F.lit(True).alias("_many")), "component", "left")
    touched = cut(shared.filter("_copies > 1 or _many").select("key"))
    kept = staying.select("s._id", "s.key").hint("merge")
    # a text without copies and partners stays, and is not shuffled
    hits = _hits(rows, touched)
    chosen = hits.filter("_hit").select("key", "_id", "doc").join(kept, ["key", "_id"]).dropDuplicates(["key", "_id"]).select("doc.*")
    return hits.filter("not _hit").select("doc.*").unionByName(chosen)
