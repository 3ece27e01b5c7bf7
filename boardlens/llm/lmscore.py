"""Language-model scores: cross-entropy difference of a target and a background bigram model with exact counts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlens.llm.common import word_bytes
from boardlens.operators.lineage import cut

MIN_COUNT = 2  # occurrences in the corpus that put a word into the vocabulary
SHARE = 0.7  # weight of the pair estimate
SMOOTHING = 0.1
MEMO_WORDS = 200_000  # words whose hashes a Python worker remembers; a speed setting only
CHUNK_WORDS = 1 << 20  # words of a chunk of documents, unless one document alone has more
CHUNK_ROWS = 50_000
BUCKET_WORDS = 1 << 19  # running words for each bucket of keys
_START = np.uint64(0)  # the key before the first word
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_NEXT = np.uint64(0xC2B2AE3D27D4EB4F)


class _Keys(dict):
    """The 64-bit key of a word, never _START."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        key = self[word] = xxhash.xxh64_intdigest(word, 1) or 1
        return key


_keys = _Keys()


def word_keys(text: str | None) -> np.ndarray:
    """The keys of a text's words in lower case; the words are runs of anything but ASCII white space."""
    words = word_bytes(text.lower()) if text else []
    return np.fromiter(map(_keys.__getitem__, words), np.uint64, len(words))


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """64-bit keys of (word before, word): as many as there are pairs, none is folded into a table of slots."""
    mixed = before * _PAIR
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _NEXT + word
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _PAIR
    return mixed ^ (mixed >> np.uint64(31))


def _packed(counts: np.ndarray) -> bytes:
    """Counts in the fewest bytes each: most of them are small."""
    for kind in ("u1", "u2", "u4"):
        if not len(counts) or counts.max() <= np.iinfo(kind).max:
            break
    else:
        kind = "u8"
    return bytes([int(kind[1])]) + counts.astype(f"<{kind}").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def _planes(places: np.ndarray) -> bytes:
    """Small numbers byte by byte of their places: the upper bytes, mostly zero, compress to almost nothing."""
    return places.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _first(sizes: np.ndarray) -> np.ndarray:
    """Which words start a document, from the documents' numbers of words."""
    out = np.zeros(int(sizes.sum()), bool)
    out[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    return out


@dataclass
class _Chunk:
    """The distinct keys of a chunk, sorted, and the place of each of its words and pairs among them."""

    words: np.ndarray
    at: np.ndarray
    first: np.ndarray
    pairs: np.ndarray
    pair_at: np.ndarray

    @classmethod
    def of(cls, words: bytes, at: bytes, sizes: np.ndarray) -> _Chunk:
        stored = np.frombuffer(words, np.uint64)  # the most frequent ones first
        order = np.argsort(stored)
        keys, rank = stored[order], np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order))
        place = rank[_from_planes(at)]
        first = _first(sizes)
        running = keys[place]
        pairs, pair_at = np.unique(pair_keys(np.concatenate([running[:1], running[:-1]])[~first], running[~first]), return_inverse=True)
        return cls(keys, place, first, pairs, pair_at)


def _chunks(documents: DataFrame, in_target: str | None, text_col: str) -> DataFrame:
    """(chunk, ids, sizes, targets, n, n_target, words, at): documents of a task together, their words as places among distinct keys."""

    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        made = n = 0

        def row() -> pd.DataFrame:
            words, at, met = np.unique(np.concatenate([x[2] for x in held]), return_inverse=True, return_counts=True)
            frequent = np.argsort(-met, kind="stable")
            words, rank = words[frequent], np.argsort(frequent)
            sizes = np.array([len(x[2]) for x in held], np.int64)
            targets = np.array([x[1] for x in held], np.int64)
            return pd.DataFrame({
                "chunk": [task + made], "ids": [[x[0] for x in held]], "sizes": [sizes.tobytes()], "targets": [targets.astype(np.uint8).tobytes()],
                "n": [int(sizes.sum())], "n_target": [int((sizes * targets).sum())], "words": [words.tobytes()], "at": [_planes(rank[at])],
            })

        for batch in batches:
            for doc, target, text in zip(batch["id"].astype(object), batch["target"], batch["text"], strict=True):
                keys = word_keys(text)
                if held and (n + len(keys) > CHUNK_WORDS or len(held) >= CHUNK_ROWS):
                    yield row()
                    held.clear()
                    made, n = made + 1, 0
                held.append((None if pd.isna(doc) else doc, target, keys))
                n += len(keys)
        if held:
            yield row()

    target = F.coalesce(F.col(in_target), F.lit(False)).cast("int") if in_target else F.lit(0)
    rows = documents.select(F.col("doc_id").cast("string").alias("id"), target.alias("target"), F.col(text_col).alias("text"))
    return rows.mapInPandas(chunks, "chunk bigint, ids array<string>, sizes binary, targets binary, n bigint, n_target bigint, words binary, at binary")


_PARTS = [f"{kind}_{what}" for kind in ("word", "pair") for what in ("keys", "background", "target")]
_PARTS_TYPE = ", ".join(f"{x} binary" for x in _PARTS)


def _parts(chunks: DataFrame, buckets: int) -> DataFrame:
    """(bucket, chunk, keys and counts): a chunk's distinct keys with their counts, cut into ranges of keys.

    A key comes once from each chunk that has it, however often it occurs there, and hashes spread evenly over the
    ranges, so frequent words and pairs make no range larger than the others.
    """
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                sizes = np.frombuffer(r.sizes, np.int64)
                c = _Chunk.of(r.words, r.at, sizes)
                good = np.repeat(np.frombuffer(r.targets, np.uint8).astype(bool), sizes)
                kinds = []
                for keys, at, hit in ((c.words, c.at, good), (c.pairs, c.pair_at, good[~c.first])):
                    cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
                    kinds.append((keys, np.bincount(at, minlength=len(keys)), np.bincount(at[hit], minlength=len(keys)), cuts))
                out = []
                for b in range(buckets):
                    spans = [(k, n, t, slice(cuts[b], cuts[b + 1])) for k, n, t, cuts in kinds]
                    if any(s.stop > s.start for *_, s in spans):
                        out.append((b, r.chunk, *[x for k, n, t, s in spans for x in (k[s].tobytes(), _packed(n[s]), _packed(t[s]))]))
                yield pd.DataFrame(out, columns=["bucket", "chunk", *_PARTS])

    return chunks.select("chunk", "sizes", "targets", "words", "at").mapInPandas(parts, f"bucket int, chunk bigint, {_PARTS_TYPE}")


def _sums(rows: pd.DataFrame, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """The distinct keys of a bucket, their two counts over all chunks, and the place of every chunk's keys among them."""
    each = [np.frombuffer(x, np.uint64) for x in rows[f"{kind}_keys"]]
    keys, at = np.unique(np.concatenate(each), return_inverse=True)
    counts = []
    for side in ("background", "target"):
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, at, np.concatenate([_unpacked(x) for x in rows[f"{kind}_{side}"]]))
        counts.append(total)
    return keys, *counts, np.split(at, np.cumsum([len(x) for x in each])[:-1])


@dataclass
class _Totals:
    """What the losses need beside the counts of a word, its context and the pair; ``words`` and ``known`` are (background, target)."""

    size: int
    words: np.ndarray
    known: np.ndarray

    def losses(self, word: np.ndarray, context: np.ndarray, pair: np.ndarray, known: np.ndarray, known_before: np.ndarray) -> np.ndarray:
        """2 x words: the background's and the target's loss of every word, in nats, from 2 x words counts each.

        An unknown word has its share of the unknown mass; both models mix the pair estimate with the word estimate. The
        background is matched to the target: its counts are scaled to the target's number of words, so that both are
        smoothed alike. Without a target word the target has the background's counts.
        """
        sides = []
        for side in (0, 1 if self.words[1] else 0):
            words = self.words[1] or self.words[0]
            mass = np.where(known, word[side], self.words[side] - self.known[side]) * (words / self.words[side])
            single = (mass + SMOOTHING) / (words + SMOOTHING * (self.size + 1))
            before = np.where(known_before, context[side], 0)
            seen = np.divide(pair[side], before, out=np.zeros(len(single)), where=before > 0)
            weight = np.where(before > 0, SHARE, 0.0)
            sides.append(-np.log(weight * seen + (1 - weight) * single))
        return np.stack(sides)


def _chunk_losses(c: _Chunk, words: np.ndarray, pairs: np.ndarray, totals: _Totals) -> np.ndarray:
    """2 x words: the losses of a chunk's words, given 2 x distinct words and 2 x distinct pairs counts."""
    before = np.concatenate([c.at[:1], c.at[:-1]])
    known = words[0] >= MIN_COUNT
    pair = np.zeros((2, len(c.at)))
    pair[:, ~c.first] = pairs[:, c.pair_at]
    return totals.losses(words[:, c.at], words[:, before], pair, known[c.at], known[before] & ~c.first)


def scores(documents: DataFrame, in_target: str, text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, loss_target, loss_background, score) for every row of ``documents``, scored by the models of all of them.

    Every word and pair of every text counts for the background, those of rows with a true ``in_target`` for the target
    too; the vocabulary are the words met MIN_COUNT times or more. Documents are put into chunks once. Each chunk sends its
    distinct keys and their counts to ranges of keys, gets the counts of the whole corpus back, and adds up its documents'
    losses. The number of ranges follows the corpus, so no task holds more than a range or a chunk and the driver holds
    three sums. The losses are means per word, the score is target minus background: lower is closer to the target. A
    null text or one without words has no words and zeros.
    """
    chunks = cut(_chunks(documents, in_target, text_col))
    n, n_target = chunks.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("n_target"), F.lit(0))).first()
    id_type = documents.schema["doc_id"].dataType

    def answers(rows: pd.DataFrame) -> pd.DataFrame:
        out = {"chunk": rows["chunk"], "bucket": rows["bucket"]}
        for kind in ("word", "pair"):
            _, *counts, places = _sums(rows, kind)
            for side, total in zip(("background", "target"), counts, strict=True):
                out[f"{kind}_{side}"] = [_packed(total[x]) for x in places]
                if kind == "word":
                    known = counts[0] >= MIN_COUNT
                    out[f"known_{side}"] = [int(total[known].sum())] + [0] * (len(rows) - 1)
                    out["size"] = [int(known.sum())] + [0] * (len(rows) - 1)
        return pd.DataFrame(out)[["chunk", "bucket", "word_background", "word_target", "pair_background", "pair_target", "known_background", "known_target", "size"]]

    answer = "chunk bigint, bucket int, word_background binary, word_target binary, pair_background binary, pair_target binary, known_background bigint, known_target bigint, size bigint"
    counted = cut(_parts(chunks, 1 + n // BUCKET_WORDS).groupBy("bucket").applyInPandas(answers, answer))
    known = counted.agg(*[F.coalesce(F.sum(x), F.lit(0)) for x in ("size", "known_background", "known_target")]).first()
    totals = _Totals(known[0], np.array([n, n_target]), np.array([known[1], known[2]]))

    def score(chunk: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        out = []
        counts = counts.sort_values("bucket")
        for r in chunk.itertuples():
            sizes = np.frombuffer(r.sizes, np.int64)
            sums = np.zeros((2, len(sizes)))
            if sizes.any():
                c = _Chunk.of(r.words, r.at, sizes)
                words, pairs = (np.stack([np.concatenate([_unpacked(x) for x in counts[f"{kind}_{side}"]]) for side in ("background", "target")]) for kind in ("word", "pair"))
                losses = _chunk_losses(c, words, pairs, totals)
                of = np.repeat(np.arange(len(sizes)), sizes)
                sums = np.stack([np.bincount(of, x, len(sizes)) for x in losses]) / np.maximum(sizes, 1)
            out.append(pd.DataFrame({"doc_id": r.ids, "n_words": sizes, "loss_target": sums[1], "loss_background": sums[0], "score": sums[1] - sums[0]}))
        return pd.concat(out) if out else pd.DataFrame({x: [] for x in ("doc_id", "n_words", "loss_target", "loss_background", "score")})

    found = chunks.select("chunk", "ids", "sizes", "words", "at").groupBy("chunk").cogroup(
        counted.drop("known_background", "known_target", "size").groupBy("chunk")
    ).applyInPandas(score, "doc_id string, n_words bigint, loss_target double, loss_background double, score double")
    return found.withColumn("doc_id", F.col("doc_id").cast(id_type))


@dataclass
class DifferenceModel:
    """The exact counts of a corpus that one process can hold, keys sorted."""

    words: np.ndarray
    word_counts: np.ndarray  # 2 x words
    pairs: np.ndarray
    pair_counts: np.ndarray  # 2 x pairs
    totals: _Totals

    def losses(self, keys: np.ndarray) -> np.ndarray:
        """2 x words: the background's and the target's loss of every word of a text."""
        words, at = np.unique(keys, return_inverse=True)
        c = _Chunk.of(words.tobytes(), _planes(at), np.array([len(keys)]))
        return _chunk_losses(c, _looked_up(self.words, self.word_counts, words), _looked_up(self.pairs, self.pair_counts, c.pairs), self.totals)


def _looked_up(keys: np.ndarray, counts: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros((2, len(wanted)), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, counts[:, at], 0)


def fit_difference(documents: DataFrame, in_target: str, text_col: str = "text") -> DifferenceModel:
    """The models of ``scores`` with all counts on the driver, for other texts and a corpus that fits there."""
    rows = documents if "doc_id" in documents.columns else documents.withColumn("doc_id", F.lit(None).cast("bigint"))
    chunks = cut(_chunks(rows, in_target, text_col))
    n, n_target = chunks.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("n_target"), F.lit(0))).first()

    def sums(rows: pd.DataFrame) -> pd.DataFrame:
        found = [_sums(rows, kind)[:3] for kind in ("word", "pair")]
        return pd.DataFrame([[rows["bucket"].iloc[0], *[x.astype(np.int64).tobytes() if i else x.tobytes() for f in found for i, x in enumerate(f)]]])

    found = sorted(_parts(chunks, 1 + n // BUCKET_WORDS).groupBy("bucket").applyInPandas(sums, f"bucket int, {_PARTS_TYPE}").toLocalIterator(), key=lambda r: r.bucket)
    word, wb, wt, pair, pb, pt = (np.concatenate([np.frombuffer(r[x], np.uint64 if x.endswith("keys") else np.int64) for r in found] or [np.zeros(0, np.uint64)]) for x in _PARTS)
    known = wb >= MIN_COUNT
    totals = _Totals(int(known.sum()), np.array([n, n_target]), np.array([wb[known].sum(), wt[known].sum()]))
    return DifferenceModel(word, np.stack([wb, wt]), pair, np.stack([pb, pt]), totals)


def score_udf(spark: SparkSession, model: DifferenceModel):
    """A pandas UDF from a text column to (n_words, loss_target, loss_background, score) as in ``scores``."""
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("struct<n_words: bigint, loss_target: double, loss_background: double, score: double>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = sent.value
        for texts in batches:
            out = []
            for text in texts:
                keys = word_keys(text)
                background, target = known.losses(keys).mean(axis=1) if len(keys) else (0.0, 0.0)
                out.append((len(keys), target, background, target - background))
            yield pd.DataFrame(out, columns=["n_words", "loss_target", "loss_background", "score"])

    return score
