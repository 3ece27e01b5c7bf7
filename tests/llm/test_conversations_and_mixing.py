"""Conversation tries, mixing and conversation repair against brute force and SQL; odd rows in each."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import compare
from boardlens.llm import mixing, queries, repair, trie
from boardlens.llm.common import read_table

SF = "/root/testdata/sf0.001"
TURNS = "conv_id bigint, turn bigint, role string, text string, shard string, node int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_conversation(rows):
    per = defaultdict(list)
    for r in rows:
        per[r.conv_id].append(r)
    return per


def plain_trie(rows):
    own = {}
    for c, turns in by_conversation(rows).items():
        turns = sorted(turns, key=lambda r: (r.turn is not None, r.turn or 0))
        own[c] = [(r.role or "", r.text or "") for r in turns]
    number, above, depth, words, members, ends = {}, [None], [0], [0], [[]], [[]]
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4
        at = 0
        members[0].append(c)
        for turn in own.get(c - c % 20, [])[:h] + own[c][h:]:
            if (at, turn) not in number:
                number[at, turn] = len(above)
                above.append(at), depth.append(depth[at] + 1), words.append(len(WORD.findall(turn[1]))), members.append([]), ends.append([])
            at = number[at, turn]
            members[at].append(c)
        ends[at].append(c)
    nodes = range(len(above) if own else 0)
    children, leaves, saved = [0] * len(above), [0] * len(above), [(len(m) - 1) * w for m, w in zip(members, words)]
    for x in reversed(nodes):  # a node is numbered after the one above it
        leaves[x] = leaves[x] or 1
        if x:
            for total in (leaves, saved):
                total[above[x]] += total[x]
            children[above[x]] += 1
    digest = lambda x: hashlib.sha256(",".join(map(str, ends[x])).encode()).hexdigest()
    return {(members[x][0], depth[x], members[above[x]][0] if x else None, len(members[x]), children[x], leaves[x], saved[x], digest(x)) for x in nodes}


@pytest.mark.parametrize("shards", ["1", "5"])
def test_trie(spark, shards):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", shards)
        got = queries.op11_conversation_trie(spark, SF).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = plain_trie(read_table(spark, SF, "conversations").collect())
    assert len(got) == len(want) and {tuple(r) for r in got} == want


ODD = [(1, None, None, None), (1, 0, "user", ""), (2, None, "", ""), (2, 0, "user", None), (3, 5, "user", "a b c " * 9000), (None, 0, "user", "no id"), (20, 0, "user", "hi there")]
ODD += [(c, t, ("user", "assistant")[t % 2], f"turn {t if t < 9 else c % 3}") for c in range(100, 230) for t in range(12 + c % 2)]
ODD += [(400, t, "user", f"long {t}") for t in range(300)] + [(401, t, "user", f"long {t}") for t in range(290)]


@pytest.mark.parametrize("shards", ["1", "7"])
def test_trie_on_odd_rows(spark, shards):
    rows = spark.createDataFrame([(*r, "clash", 1) for r in ODD], TURNS)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", shards)
        got = trie.prefix_trie(trie.rebuilt(trie.sequences(rows))).collect()
        assert trie.prefix_trie(trie.rebuilt(trie.sequences(rows.filter("false")))).collect() == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = plain_trie([r for r in rows.collect() if r.conv_id is not None])
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def check_mix(rows, got):
    """Sizes, targets by filling up step by step, and sums within the largest document."""
    size = lambda text: len(WORD.findall(text or ""))
    per = defaultdict(int)
    for r in rows:
        per[r.source] += size(r.text)
    names = sorted(per, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    goal, open_, left = {}, set(names), 1.5 * sum(per.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * per[s]}
        goal |= {s: 2.0 * per[s] for s in over} | ({} if over else {s: level * weight[s] for s in open_})
        left -= sum(2.0 * per[s] for s in over)
        open_ = open_ - over if over else set()
    assert len(got) == len(rows)
    by_source = defaultdict(int)
    sources = defaultdict(list)
    for r in rows:
        sources[r.doc_id, size(r.text)].append(r.source)
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size)
    for s in names:
        mine = [r for r in got if s in sources[r.doc_id, r.size] and r.source_size == per[s]]
        assert all(abs(r.target - goal[s]) <= 1e-9 * max(1, goal[s]) for r in mine)
        by_source[s] = sum(r.taken for r in mine)
        largest = max((r.size for r in mine), default=0)
        assert abs(by_source[s] - goal[s]) <= largest / 2 + 1e-6, (s, by_source[s], goal[s])


@pytest.mark.parametrize("sf", ["0.01"])
def test_mix(spark, sf):
    d = f"/root/testdata/sf{sf}"
    got = queries.op12_source_mixing(spark, d).collect()
    check_mix(read_table(spark, d, "documents").collect(), got)
    again = queries.op12_source_mixing(spark, d).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


@pytest.mark.parametrize("small", [mixing.SMALL, 0])
def test_mix_on_odd_rows(spark, monkeypatch, small):
    monkeypatch.setattr(mixing, "SMALL", small)
    rows = [(i, f"w{i} " * (i % 7), "hot") for i in range(300)] + [(1000 + i, "one two", f"s{i % 5}") for i in range(40)]
    rows += [(5000, None, None), (5001, "", None), (None, "no id", "none"), (5002, "x " * 50000, "long"), (5003, None, "empty")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumns({"size": F.lit("clash"), "_key": F.lit(1), "target": F.lit(0)})
    check_mix(docs.collect(), mixing.mix(docs).collect())
    assert mixing.mix(docs.filter("false")).collect() == []


def test_mix_larger_budget_takes_a_superset(spark):
    docs = read_table(spark, SF, "documents").select("doc_id", "text", F.lit("one").alias("source"))
    taken = [{r.doc_id for r in mixing.mix(docs, share=s).collect() if r.taken} for s in (0.2, 0.5, 0.9)]
    assert taken[0] < taken[1] < taken[2]


def plain_alignment(codes):
    """Every cell of every target length, with the audits kept."""
    n, best = len(codes), None
    for m in (m for m in range(n + 4) if m != 1):
        target = "s" * (m % 2) + "ua" * (m // 2)
        cells = [[None] * (m + 1) for _ in range(n + 1)]
        for i in range(n + 1):
            for j in range(m + 1):
                found = [(0, "")] if i == j == 0 else []
                if i and cells[i - 1][j]:
                    found.append((cells[i - 1][j][0] + 2, cells[i - 1][j][1] + "D"))
                if j and target[j - 1] != "s" and cells[i][j - 1]:
                    found.append((cells[i][j - 1][0] + 5, cells[i][j - 1][1] + "I"))
                if i and j and cells[i - 1][j - 1] and codes[i - 1] % 4 != 1:
                    cost, audit = cells[i - 1][j - 1]
                    cost += 5 * (codes[i - 1] % 4 == 2)
                    if "sua?"[codes[i - 1] // 4] == target[j - 1]:
                        found.append((cost, audit + "K"))
                    elif target[j - 1] != "s":
                        found.append((cost + 1, audit + "R"))
                cells[i][j] = min(found, default=None)
        if cells[n][m] and (best is None or cells[n][m] < best):
            best = cells[n][m]
    return best


@pytest.mark.parametrize("block", [1, 2, 3, 5, 512])
def test_alignment_against_all_cells(monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(400):
        codes = bytes(4 * rng.choice([0, 1, 1, 2, 2, 2, 3]) + rng.choice([0, 0, 0, 1, 2]) for _ in range(rng.randrange(12)))
        assert repair._align(codes) == plain_alignment(codes), codes


def plain_repair(rows):
    out = {}
    for c, turns in by_conversation(rows).items():
        after = []
        for r in turns:
            role, text = " " if r.role is None else r.role, " " if r.text is None else r.text
            fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if r.turn is None else r.turn}".encode()) % 20
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            after += [(r.turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
        after.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        numbers = [t[0] for t in after if t[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        codes, counts, seen = [], [0, 0, 0], set()
        for _, role, text in after:
            marks = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = 0 if not marks else 1 if (role, text) in seen else 2 if marks[-1] not in ".!?" else 3
            seen.add((role, text))
            if fault < 3:
                counts[fault] += 1
            codes.append(4 * ("sua".find(role[0]) if role[:1] in ("s", "u", "a") else 3) + (1, 1, 2, 0)[fault])
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(after, after[1:]))
        cost, audit = plain_alignment(codes)
        made, at = [], 0
        length = sum(x != "D" for x in audit)
        target = "s" * (length % 2) + "ua" * (length // 2)
        for x in audit:
            name = {"s": "system", "u": "user", "a": "assistant"}.get(target[len(made)]) if x != "D" else None
            if x == "K":
                made.append(after[at][1] + ":" + after[at][2])
            elif x != "D":
                made.append(name + ":" + (after[at][2] if x == "R" else ""))
            at += x != "I"
        out[c] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest())
    return out


def repaired(spark, rows):
    convs = repair.by_conversation(rows)
    done = repair.repair(convs.select("conv_id", repair.damaged(F.col("conv_id"), F.col("turns")).alias("turns")))
    lines = F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    return done.select("*", F.sha2(lines.cast("binary"), 256).alias("sha")).drop("repaired")


def test_repair(spark):
    got = {r[0]: tuple(r[1:]) for r in queries.op13_conversation_repair(spark, SF).collect()}
    assert got == plain_repair(read_table(spark, SF, "conversations").collect())


def test_repair_on_odd_rows(spark):
    odd = [(1, None, None, None), (1, None, "user", "Hi."), (2, 3, "tool", "x"), (2, 3, "", "y."), (2, 3, "user", "y."), (None, 0, "user", "No id."), (3, 0, "system", None)]
    odd += [(c, t, random.Random(c * 99 + t).choice(["user", "assistant", "system", "u"]), f"Turn {t % 5}.") for c in range(10, 60) for t in range(c % 13)]
    rows = spark.createDataFrame([(*r, "clash", 1) for r in odd], TURNS)
    assert {r[0]: tuple(r[1:]) for r in repaired(spark, rows).collect()} == plain_repair(rows.collect())
    assert repaired(spark, rows.filter("false")).collect() == []


def test_repair_of_a_long_conversation(spark):
    rows = spark.range(3000).selectExpr("7L conv_id", "id turn", "if(id % 2 = 0, 'user', 'assistant') role", "concat('Said ', id, '.') text")
    row = repaired(spark, rows).first()
    assert row.gaps > 100 and len(row.audit.replace("D", "")) % 2 == 0 and row.cost > 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    df = queries.queries()[name](spark, SF)
    con = compare.connect(SF)
    assert compare.type_diff(df, con, queries.oracle_sql()[name]) == []
    assert compare.diff(df, con, queries.oracle_sql()[name]) is None
