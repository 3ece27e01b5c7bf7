"""Mixing of sources to target weights: nested hash thresholds found by histograms, refined in the boundary bucket only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardlens.operators.lineage import cut
from boardlens.operators.ranking import global_rank

WEIGHTS = (3, 1, 2)  # of the sources in their order, repeating
SHARE = 1.5  # of all words together
MOST = 2.0  # times the words of its source that a target may reach
KEY_BITS = 60
LEVELS = (12, 12, 18, 18)  # bits of the key that each histogram reads
SMALL = 50_000  # sources whose table is broadcast, a few MB
SALTS = 64


def n_words(text: Column) -> Column:
    """Runs of anything but ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def place(doc_id: Column, text: Column) -> Column:
    """60 bits of a document's id and text: its place in the order in which documents of a source are taken."""
    said = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(said.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Add ``target`` to (source, source_size): ``share`` of all sizes by weight, none above ``most`` times its own size.

    Sources are ordered by code point, null last. What a stopped source leaves is shared anew by weight; a round is
    one sum over the sources, and the shares of the others only grow, so a stopped source stays so.
    """
    ranked = cut(
        global_rank(sources, [F.col("source").asc_nulls_last()], "_rank").select(
            "source", "source_size", F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int")).alias("_weight")
        )
    )
    cap, level = F.col("source_size") * most, F.lit(-1.0)
    total = F.sum("source_size")
    words = ranked.agg(F.coalesce(total, F.lit(0)).alias("n")).first().n
    while True:
        stopped = cap < level * F.col("_weight")
        left = ranked.agg(
            F.coalesce(F.sum(F.when(stopped, cap)), F.lit(0.0)).alias("caps"), F.sum(F.when(~stopped, F.col("_weight"))).alias("open")
        ).first()
        if left.open is None:
            break
        raised = (words * share - left.caps) / left.open
        now = F.lit(raised)
        changed = ranked.filter(~stopped & (cap < now * F.col("_weight"))).limit(1).count()
        level = now
        if not changed:
            break
    return ranked.select("source", "source_size", F.least(cap, level * F.col("_weight")).alias("target"))


def _by_source(rows: DataFrame, table: DataFrame, sources: int) -> DataFrame:
    """``rows`` (with ``_s``) and the one row of ``table`` (with ``source``) for each, without any source's rows in one task.

    A table of up to SMALL sources is broadcast; of a larger one every source has SALTS rows, to which its documents are dealt.
    """
    if sources <= SMALL:
        return rows.join(F.broadcast(table), F.col("_s").eqNullSafe(F.col("source")))
    salted = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("_deal", F.pmod(F.xxhash64("_key"), F.lit(SALTS)))
    return dealt.join(salted, F.col("_s").eqNullSafe(F.col("source")) & (F.col("_deal") == F.col("_salt"))).drop("_deal", "_salt")


def _thresholds(rows: DataFrame, goals: DataFrame, sources: int) -> DataFrame:
    """(source, whole, _edge, _at_edge): whole passes over each source, and the key below which documents are taken once more.

    ``rows`` are (_s, size, _key), _s being the source. A level sums the words of the boundary bucket's rows by their next bits; the bucket
    in which the budget runs out is the next boundary. After the last level that bucket is one key, which is taken if that
    comes nearer to the budget.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    state = cut(
        goals.select(
            "source", whole.alias("whole"), (F.col("target") - whole * F.col("source_size")).alias("_left"), F.lit(0).cast("bigint").alias("_edge")
        )
    )
    below = KEY_BITS
    for bits in LEVELS:
        above, below = below, below - bits
        keyed = rows.select("_s", "size", "_key", F.shiftright("_key", above).alias("_prefix"), F.shiftright("_key", below).alias("_bucket"))
        if above < KEY_BITS:  # the first level has one bucket, which is every source's boundary
            keyed = _by_source(keyed, state, sources).filter(F.col("_prefix") == F.shiftright("_edge", above))
        sums = keyed.groupBy("_s", "_bucket").agg(F.sum("size").alias("_n")).filter("_n > 0")
        # at most 2**bits sums of a source: a fold over them finds where the budget runs out
        folded = sums.groupBy("_s").agg(F.array_sort(F.collect_list(F.struct("_bucket", "_n"))).alias("_b"))
        start = F.struct(F.col("_left").alias("left"), F.lit(None).cast("bigint").alias("at"))
        step = lambda a, x: F.when(
            a["at"].isNull() & (x["_n"] <= a["left"]), F.struct((a["left"] - x["_n"]).alias("left"), a["at"].alias("at"))
        ).otherwise(F.struct(a["left"].alias("left"), F.coalesce(a["at"], x["_bucket"]).alias("at")))
        met = state.join(folded, state["source"].eqNullSafe(folded["_s"]), "left").withColumn("_f", F.aggregate("_b", start, step))
        behind = F.element_at("_b", -1)["_bucket"] + 1  # of the last bucket, where a budget ends that every bucket fits into
        state = cut(
            met.select(
                "source", "whole", F.coalesce("_f.left", "_left").alias("_left"),
                F.when(F.col("_b").isNull(), F.col("_edge")).otherwise(F.shiftleft(F.coalesce("_f.at", behind), below)).alias("_edge"),
            )
        )
    return state


def mix(
    documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, text_col: str = "text"
) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of ``documents``; ``taken`` is ``size`` times the passes over it.

    Which documents are taken once more depends on their id and text alone, so reruns agree and a larger budget takes
    a superset. A null text has no words; a null source is a source. Rows with equal id and text share one place: at the
    boundary all or none of them are taken. No document is taken more than ``most`` times rounded up. No rows give no rows.
    Documents are read once, into a table of places; nothing is sorted, and a source of any size is summed before the shuffle.
    """
    rows = cut(
        documents.select("doc_id", F.col("source").alias("_s"), n_words(F.col(text_col)).alias("size"), place(F.col("doc_id"), F.col(text_col)).alias("_key"))
    )
    sizes = rows.groupBy(F.col("_s").alias("source")).agg(F.sum("size").alias("source_size"))
    goals = cut(targets(sizes, weights, share, most))
    sources = goals.count()
    edges = _thresholds(rows, goals, sources)
    # after the last level _edge is one key, and _left what is missing there
    tied = _by_source(rows, edges, sources).filter("_key = _edge").groupBy(F.col("_s").alias("_t")).agg(F.sum("size").alias("_tied"))
    plan = goals.join(edges.withColumnRenamed("source", "_e"), F.col("source").eqNullSafe(F.col("_e")))
    plan = plan.join(tied, F.col("source").eqNullSafe(F.col("_t")), "left").select(
        "source", "source_size", "target", "whole", (F.col("_edge") + F.when(2 * F.col("_left") >= F.col("_tied"), 1).otherwise(0)).alias("_below")
    )
    more = F.when(F.col("_key") < F.col("_below"), 1).otherwise(0)
    return _by_source(rows, cut(plan), sources).select("doc_id", "size", "source_size", "target", (F.col("size") * (F.col("whole") + more)).alias("taken"))
