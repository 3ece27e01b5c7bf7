"""Prefix trie of conversations: range shards of turn-id sequences, sorted and counted as matrices, joined at their borders."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardlens.operators.lineage import cut

ID = 16  # bytes of a turn's id
SHARD_TURNS = 1 << 18  # turns that a range shard should hold
_EMPTY = hashlib.sha256(b"").hexdigest()
_NODE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, "
    "ends_sha256 string, shard bigint, node binary, parent binary, last_words bigint, ends string, running bigint, fresh bigint"
)


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, ids, words): the turns of each conversation by turn (null first), as 16-byte ids of role and text and word counts.

    A null role or text is empty. Equal turns have equal ids; unequal ones share the 128 bits of an MD5 by chance only. Rows of one
    conversation with equal ``turn`` follow by id. Rows without conv_id belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    row = F.struct(
        "turn", F.unhex(F.md5(said.cast("binary"))).alias("id"), F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("int").alias("words")
    )
    per = turns.filter("conv_id is not null").groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("_t"))
    return per.select("conv_id", F.col("_t.id").alias("ids"), F.col("_t.words").alias("words"))


def rebuilt(conversations: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Every conversation with its first h turns replaced by those of the first conversation of its group of ``group`` ids.

    h is crc32 of the id modulo ``most``; a missing first conversation has no turns. ``conversations`` is read twice.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    heads = conversations.filter(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("_head"), F.slice("ids", 1, most - 1).alias("_ids"), F.slice("words", 1, most - 1).alias("_words")
    )
    both = conversations.withColumns({"_of": F.col("conv_id") - F.col("conv_id") % group, "_h": h}).join(heads, F.col("_of") == F.col("_head"), "left")

    def put(own: str, head: str) -> Column:
        mine = F.slice(own, F.col("_h") + 1, F.greatest(F.size(own) - F.col("_h"), F.lit(0)))
        return F.when(F.col(head).isNull(), mine).otherwise(F.concat(F.slice(head, F.lit(1), F.col("_h")), mine))

    return both.select("conv_id", put("ids", "_ids").alias("ids"), put("words", "_words").alias("words"))


def _slabs(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Column ranges of growing width, so that padding at most doubles the cells."""
    at = 0
    while at < lengths.max(initial=0):
        width = max(1, at)
        yield at, width
        at += width


def _padded(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, at: int, width: int) -> np.ndarray:
    """Columns ``at`` to ``at + width`` of the rows, -1 behind their ends."""
    columns = at + np.arange(width)
    inside = columns[None, :] < lengths[:, None]
    return np.where(inside, flat[np.where(inside, starts[:, None] + columns[None, :], 0)], -1)


def _sorted_rows(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, convs: np.ndarray) -> np.ndarray:
    """The order of the rows by their ids, a prefix first, equal rows by conversation."""
    rank = np.zeros(len(lengths), np.int64)
    for at, width in _slabs(lengths):
        rows = np.flatnonzero(lengths > at)
        cells = _padded(flat, starts[rows], lengths[rows], at, width)
        order = np.lexsort((*cells.T[::-1], rank[rows]))
        changed = np.zeros(len(rows), bool)
        changed[1:] = (cells[order][1:] != cells[order][:-1]).any(axis=1) | (np.diff(rank[rows][order]) != 0)
        inner = np.zeros(len(lengths), np.int64)  # rows that have ended stand before their group
        inner[rows[order]] = 1 + np.cumsum(changed)
        by = np.lexsort((inner, rank))
        steps = (np.diff(rank[by]) != 0) | (np.diff(inner[by]) != 0)
        rank[by] = np.concatenate([[0], np.cumsum(steps)])
    return np.lexsort((convs, rank))


def _shared(a: bytes | None, b: bytes | None) -> int:
    """Leading turns that two sequences share; -1 where there is none to compare with."""
    if a is None or b is None:
        return -1
    n = min(len(a), len(b)) // ID
    x, y = (np.frombuffer(s, f"V{ID}", n) for s in (a, b))
    differ = np.flatnonzero(x != y)
    return int(differ[0]) if len(differ) else n


def _shard_nodes(key: tuple, rows: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
    """The nodes of one range shard; those that reach into a neighbouring shard carry their key and are partial."""
    convs = rows["conv_id"].to_numpy(np.int64)
    seqs, n = rows["seq"].tolist(), len(rows)
    lengths = np.array([len(s) // ID for s in seqs], np.int64)
    digests = np.frombuffer(b"".join(seqs), ">u8").reshape(-1, 2).astype(np.uint64)
    by = np.lexsort((digests[:, 1], digests[:, 0]))
    flat = np.zeros(len(by), np.int64)  # digests as numbers in the order of their bytes
    if len(by):
        flat[by] = np.concatenate([[0], np.cumsum((digests[by][1:] != digests[by][:-1]).any(axis=1))])
    else:
        flat = np.zeros(1, np.int64)
    words = np.concatenate([np.zeros(0, np.int64), *(np.asarray(w, np.int64) for w in rows["words"])])
    starts = np.cumsum(lengths) - lengths
    order = _sorted_rows(flat, starts, lengths, convs)
    convs, starts, lengths = convs[order], starts[order], lengths[order]
    said = np.concatenate([[0], np.cumsum(words)])
    total = said[starts + lengths] - said[starts]
    first, last = seqs[order[0]], seqs[order[-1]]
    from_before, to_next = _shared(first, edges["prev_seq"].iloc[0]), _shared(last, edges["next_seq"].iloc[0])

    # depth by depth: where nodes start (change masks OR-accumulated over the columns), in the order of the rows
    levels = [(np.arange(n), np.arange(n) == 0, np.zeros(n, np.int64))]  # rows long enough, start flags, words of the turn
    shared = np.zeros(n, np.int64)  # turns that a row shares with the row before
    shared[0] = from_before
    group = np.zeros(n, np.int64)
    for at, width in _slabs(lengths):
        active = np.flatnonzero(lengths > at)
        cells = _padded(flat, starts[active], lengths[active], at, width)
        mask = np.zeros(cells.shape, bool)
        mask[1:] = cells[1:] != cells[:-1]
        mask[0] = True
        mask[1:, 0] |= np.diff(group[active]) != 0
        mask = np.logical_or.accumulate(mask, axis=1)
        group = np.zeros(n, np.int64)
        group[active] = np.cumsum(mask[:, -1])
        for j in range(width):
            alive = cells[:, j] >= 0
            if alive.any():
                at_depth, begins = active[alive], mask[alive, j].copy()
                begins[0] = True
                levels.append((at_depth, begins, words[starts[at_depth] + at + j]))
                same = at_depth[~begins]
                shared[same] = at + j + 1
    above = said[starts + np.minimum(np.maximum(shared, 0), lengths)] - said[starts]
    fresh = total - above  # words of the nodes that begin in a row
    after = np.append(shared[1:], to_next)
    leaf = (after < lengths).astype(np.int64)

    path_first, path_last = hashlib.sha256(), hashlib.sha256()
    parts, before = [], None
    for depth, (at_depth, begins, said_here) in enumerate(levels):
        if depth:
            path_first.update(first[ID * (depth - 1) : ID * depth])
            path_last.update(last[ID * (depth - 1) : ID * depth])
        begin = np.flatnonzero(begins)
        count = len(begin)
        add = lambda x, b=begin: np.add.reduceat(x, b)
        members = np.diff(np.append(begin, len(at_depth)))
        until = np.zeros(n, np.int64) if not depth else said[starts + np.minimum(depth - 1, lengths)] - said[starts]
        top = at_depth[begin]
        running = add(total[at_depth]) - members * until[top]
        begun = shared[top] < depth  # here, and not carried on from an earlier shard
        new = add(fresh[at_depth]) - np.where(begun, until[top] - above[top], 0)  # without the nodes above that begin in the same row
        children = np.zeros(n, np.int64)
        if depth + 1 < len(levels):
            next_rows, next_begins, _ = levels[depth + 1]
            born = next_rows[next_begins]
            children[born[shared[born] < depth + 1]] = 1
        node_of = np.zeros(n, np.int64)
        node_of[at_depth] = np.cumsum(begins) - 1
        out = {
            "conv_id": np.minimum.reduceat(convs[at_depth], begin), "depth": np.full(count, depth), "n_convs": members, "n_children": add(children[at_depth]),
            "n_leaves": add(leaf[at_depth]), "last_words": said_here[begin], "running": running, "fresh": new,
        }
        out["saved_tokens"] = running - new
        ended = np.flatnonzero(lengths[at_depth] == depth)
        ends = [""] * count
        if len(ended):
            cuts = np.flatnonzero(np.diff(node_of[at_depth[ended]])) + 1
            for some in np.split(ended, cuts):
                ends[node_of[at_depth[some[0]]]] = ",".join(map(str, convs[at_depth[some]].tolist()))
        nodes: list[bytes | None] = [None] * count
        if at_depth[0] == 0 and depth <= from_before:
            nodes[0] = path_first.digest()
        if at_depth[-1] == n - 1 and depth <= to_next:
            nodes[-1] = path_last.digest()
        parent = node_of_before[top] if depth else np.zeros(count, np.int64)
        parents = [None] * count if not depth else [before[0][p] for p in parent]
        out["parent_conv_id"] = [None] * count if not depth else [None if k is not None else int(before[1][p]) for k, p in zip(parents, parent, strict=True)]
        out["ends_sha256"] = [None if k is not None else _EMPTY if not e else hashlib.sha256(e.encode()).hexdigest() for k, e in zip(nodes, ends, strict=True)]
        out |= {"node": nodes, "parent": parents, "ends": [e if k is not None else None for k, e in zip(nodes, ends, strict=True)], "shard": np.full(count, key[0])}
        parts.append(pd.DataFrame(out))
        before, node_of_before = (nodes, out["conv_id"]), node_of
    found = pd.concat(parts, ignore_index=True)
    found["parent_conv_id"] = found["parent_conv_id"].astype("Int64")
    return found[[c.split()[0] for c in _NODE.split(", ")]]


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node of the trie.

    ``conversations`` are (conv_id, ids, words) with distinct ids of conversations. A node is a distinct sequence of first turns; its
    conv_id is its smallest member, the root's parent is null. ``saved_tokens`` sums, over the node and all below, the words of the last
    turn times the members but one. Conversations without turns end at the root. No conversations give no nodes.

    Sequences are sorted into ranges by (ids, conv_id), so a crowd of equal or nearly equal conversations spreads over shards. A shard knows
    the last sequence before it and the first one after it, hence which nodes begin in it, and all its figures add up. Only nodes
    that reach over a border, at most one on either side for each depth, are added up by key. Of a node only the ids of the members
    that end in it meet in one value, as the digest of their list demands.
    """
    spark = conversations.sparkSession
    rows = conversations.select("conv_id", F.unhex(F.array_join(F.transform("ids", lambda x: F.hex(x)), "")).alias("seq"), "words")
    rows = cut(rows)
    turns = rows.agg(F.sum(F.octet_length("seq").cast("bigint"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // ID // shard_turns))
    dealt = cut(rows.repartitionByRange(shards, "seq", "conv_id").withColumn("shard", F.spark_partition_id().cast("bigint")))
    borders = dealt.groupBy("shard").agg(F.min("seq").alias("low"), F.max("seq").alias("high"))
    by_shard = Window.orderBy("shard")  # a row for each shard
    edges = borders.select("shard", F.lag("high").over(by_shard).alias("prev_seq"), F.lead("low").over(by_shard).alias("next_seq"))
    nodes = cut(dealt.groupBy("shard").cogroup(edges.groupBy("shard")).applyInPandas(_shard_nodes, _NODE))

    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    pieces = F.array_sort(F.collect_list(F.when(F.col("ends") != "", F.struct("shard", "ends"))))
    joined = cut(
        nodes.filter("node is not null").groupBy("node").agg(
            F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent").alias("parent"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "running", "fresh")], pieces.alias("_p"),
        ).select(
            "node", "conv_id", "depth", "parent", "n_convs", "n_children", "n_leaves", (F.col("running") - F.col("fresh")).alias("saved_tokens"),
            F.sha2(F.array_join("_p.ends", ",").cast("binary"), 256).alias("ends_sha256"),
        )
    )
    above = joined.select(F.col("node").alias("_above"), F.col("conv_id").alias("_conv"))
    inside = nodes.filter("node is null")
    done = inside.filter("parent is null").select(*names)
    rest = [n for n in names if n != "parent_conv_id"]
    hung = inside.filter("parent is not null").select("parent", *rest).unionByName(joined.select("parent", *rest))
    linked = hung.join(above, F.col("parent") == F.col("_above"), "left").withColumn("parent_conv_id", F.col("_conv"))
    return done.select(*names).unionByName(linked.select(*names))
