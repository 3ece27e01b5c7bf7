"""Conversation structure repair: alignment of turns with the alternating grammar ``(s?(ua)+)?`` by edit costs."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5  # costs; a kept turn costs 0, TRUNCATED is added to a truncated one that stays
BLOCK = 512  # turns aligned in one table
FIRST_BAND = 12  # cost above the unavoidable one that the first band allows
SLACK = 15  # two states of a block's ends differ by less
NEVER = 1 << 40
START, SYSTEM, USER, ASSISTANT = range(4)  # what the grammar has read last; nothing, s, u, a
_EXPECTS = {START: 0, SYSTEM: 0, ASSISTANT: 0, USER: 1}  # 0: u, 1: a
SPACE = " \t\n\v\f\r"


def by_conversation(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the rows of each conversation as (turn, role, text), by turn (null first), role and text.

    A null role or text is one space. Rows without conv_id are one conversation. A conversation has to fit into a value.
    """
    space = F.lit(" ")
    row = F.struct("turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("turns"))


def damaged(conv_id: Column, turns: Column) -> Column:
    """The turns with faults put in by crc32 of ``conv_id:turn`` modulo 20; a null id or turn is one space there.

    0 drops the turn, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats the turn, 4 makes its role user.
    The result is ordered by turn (null first), role and text again.
    """
    space = F.lit(" ")

    def one(t: Column) -> Column:
        said = F.concat(F.coalesce(conv_id.cast("string"), space), F.lit(":"), F.coalesce(t["turn"].cast("string"), space))
        fate = F.crc32(said.cast("binary")) % 20
        text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(t["text"], "[.!?]", "")).otherwise(t["text"])
        out = F.struct(t["turn"].alias("turn"), F.when(fate == 4, "user").otherwise(t["role"]).alias("role"), text.alias("text"))
        return F.array_repeat(out, F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1))

    return F.array_sort(F.flatten(F.transform(turns, one)))


def faults(roles: list[str], texts: list[str]) -> tuple[bytes, list[int]]:
    """A code for each turn and (blank, duplicate, truncated, illegal) counts; the first fault of a turn counts.

    A code is 4 times the initial (0 s, 1 u, 2 a, 3 any other) plus 0, 1 if the turn has to go, or 2 if it is truncated.
    """
    seen: set[tuple[str, str]] = set()
    codes, blank, duplicate, truncated, illegal, before = bytearray(), 0, 0, 0, 0, None
    for role, text in zip(roles, texts, strict=True):
        initial, said = role[:1], text.strip(SPACE)
        fault = 0
        if not said:
            blank, fault = blank + 1, 1
        elif (role, text) in seen:
            duplicate, fault = duplicate + 1, 1
        elif said[-1] not in ".!?":
            truncated, fault = truncated + 1, 2
        seen.add((role, text))
        codes.append(4 * ("sua".find(initial) if initial in ("s", "u", "a") else 3) + fault)
        illegal += before is not None and before + initial not in ("su", "ua", "au")
        before = initial
    return bytes(codes), [blank, duplicate, truncated, illegal]


class _Block:
    """The edit-distance tables of consecutive turns against every feasible stretch of ``uaua...``.

    ``tables[e][i][k]`` is the least cost of turning the turns from i on into exactly k letters and what follows the block,
    where the letters end so that a user (e = 0) or an assistant (e = 1) is expected next. Every target is the end of one
    alternating string, so one table holds them all. Cells lie in a band: the letters left can differ from the turns left
    only as far as the insertions and deletions stay within the cost of an alignment found before.
    """

    def __init__(self, codes: bytes, after: list[int] | None):
        code = np.frombuffer(codes, np.uint8).astype(np.int64)
        initial, fault = code // 4, code % 4
        self.n, self.last, self.after = len(codes), after is None, after or [0, NEVER, NEVER, 0]
        self.must = fault == 1
        stays = np.where(self.must, NEVER, np.where(fault == 2, TRUNCATED, 0))
        self.keep = [initial == 1, initial == 2]
        self.cost = [np.where(self.must, NEVER, stays + np.where(k, 0, REROLE)) for k in self.keep]  # of a turn as u, as a
        self.system = np.where((initial == 0) & ~self.must, stays, NEVER)
        self.needed = np.append(np.cumsum(~self.must[::-1])[::-1], 0)  # turns from i on that may stay
        self._fill(FIRST_BAND)
        found = max(self._open(a)[0] for a in (SYSTEM, USER)) - min(self.after) - DELETE * int(self.must.sum())
        if found + SLACK > FIRST_BAND:  # the alignments found bound the band of the best ones
            self._fill(min(found + SLACK, (DELETE + INSERT) * (self.n + 3)))

    def _fill(self, spare: int) -> None:
        fewer, more, n = spare // DELETE, spare // INSERT, self.n
        self.width = int(self.needed[0]) + more + 1
        self.tables = np.full((2, n + 1, self.width), NEVER, np.int64)
        letters = np.arange(self.width)
        for e in (0, 1):
            t = self.tables[e]
            if self.last and not e:
                t[n, : more + 1] = INSERT * letters[: more + 1]
            elif not self.last:
                t[n, 0] = self.after[USER if e else ASSISTANT]
            for i in range(n - 1, -1, -1):
                lo, hi = max(0, int(self.needed[i]) - fewer), min(self.width - 1, int(self.needed[i]) + more)
                row = t[i + 1, lo : hi + 1] + DELETE
                first = max(lo, 1)
                as_letter = np.where((letters[first : hi + 1] + e) % 2 == 0, self.cost[0][i], self.cost[1][i])
                row[first - lo :] = np.minimum(row[first - lo :], t[i + 1, first - 1 : hi] + as_letter)
                ramp = INSERT * np.arange(len(row))
                t[i, lo : hi + 1] = np.minimum(np.minimum.accumulate(row - ramp) + ramp, NEVER)

    def _ends(self, expects: int, i: int) -> list[tuple[int, int]]:
        """(table, letters) of the feasible targets from turn i on that are cheapest, one letter at least."""
        costs = [self.tables[e, i, 2 - (expects ^ e) :: 2] for e in (0, 1)]  # an even number of letters keeps what is expected
        best = min(int(c.min()) if len(c) else NEVER for c in costs)
        return [] if best >= NEVER else [(e, 2 - (expects ^ e) + 2 * int(k)) for e in (0, 1) for k in np.flatnonzero(costs[e] == best)]

    def _open(self, state: int, i: int = 0) -> tuple[int, list[tuple[int, int]]]:
        """Least cost from turn i on in a state, with the targets that reach it; (-1, 0) leaves the state as it is."""
        ends = self._ends(_EXPECTS[state], i)
        cost = int(self.tables[ends[0][0], i, ends[0][1]]) if ends else NEVER
        still = DELETE * (self.n - i) + self.after[state]
        return min(cost, still), ([(-1, 0)] if still <= cost and still < NEVER else []) + (ends if cost <= still else [])

    def _starts(self) -> tuple[int, list[int]]:
        """Least cost from the start, with the turns kept as the system turn; -1 for none."""
        plain = self._open(START)[0]
        kept = {int(p): DELETE * int(p) + int(self.system[p]) + self._open(SYSTEM, int(p) + 1)[0] for p in np.flatnonzero(self.system < NEVER)}
        best = min([plain, *kept.values()])
        return best, [-1] * (plain == best) + [p for p, c in kept.items() if c == best]

    def before(self) -> list[int]:
        """Least cost from the block on, for each state in which it is entered."""
        return [self._starts()[0], *(self._open(s)[0] for s in (SYSTEM, USER, ASSISTANT))]

    def _trace(self, state: int, i: int) -> tuple[str, int]:
        audits = []
        for e, k in self._open(state, i)[1]:
            if e < 0:
                audits.append(("D" * (self.n - i), state))
                continue
            t, at, left, letters = self.tables[e], i, k, []
            while at < self.n or left:
                if at < self.n and t[at + 1, left] + DELETE == t[at, left]:
                    at, letter = at + 1, "D"
                elif left and t[at, left - 1] + INSERT == t[at, left]:
                    left, letter = left - 1, "I"
                else:
                    letter = "K" if self.keep[(left + e) % 2][at] else "R"
                    at, left = at + 1, left - 1
                letters.append(letter)
            audits.append(("".join(letters), USER if e else ASSISTANT))
        return min(audits)

    def trace(self, state: int) -> tuple[str, int]:
        """The least audit of the cheapest edits in this block, and the state behind it."""
        if state != START:
            return self._trace(state, 0)
        audits = []
        for p in self._starts()[1]:
            audit, end = self._trace(START, 0) if p < 0 else self._trace(SYSTEM, p + 1)
            audits.append((audit if p < 0 else "D" * p + "K" + audit, end))
        return min(audits)


def _align(codes: bytes) -> tuple[int, str]:
    cuts = list(range(0, len(codes), BLOCK)) or [0]
    after: list[list[int] | None] = [None]
    for at in reversed(cuts):
        after.append(_Block(codes[at : at + BLOCK], after[-1]).before())
    cost, state, audit = after[-1][START], START, []
    for at, behind in zip(cuts, reversed(after[:-1]), strict=True):
        part, state = _Block(codes[at : at + BLOCK], behind).trace(state)
        audit.append(part)
    return cost, "".join(audit)


_remembered = lru_cache(1 << 16)(_align)


def align(codes: bytes) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits; of equal ones the audit that is least in ASCII.

    Turns are aligned in blocks of at most BLOCK, from the last one on, each given what its ends cost afterwards; then the audits are
    read off from the first block on. So time is linear in the turns and memory bounded. Short conversations repeat and are remembered.
    """
    return _remembered(codes) if len(codes) <= 16 else _align(codes)


_COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost"]
_JUDGED = StructType()
for _name in _COUNTS:
    _JUDGED.add(_name, LongType())
_JUDGED.add("audit", StringType()).add("source", ArrayType(IntegerType())).add("turned", ArrayType(StringType()))


@F.pandas_udf(_JUDGED)
def _repaired(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for roles, texts in batches:
        rows = []
        for r, t in zip(roles, texts, strict=True):
            codes, counts = faults(list(r), list(t))
            cost, audit = align(codes)
            source, turned, at, system = [], [], 0, 0
            for letter in audit:
                stays = letter in "KR"
                if letter != "D":
                    system = system or int(not source and letter == "K" and codes[at] // 4 == 0)
                    turned.append(None if letter == "K" else ("user", "assistant")[(len(source) - system) % 2])
                    source.append(at if stays else -1)
                at += letter != "I"
            rows.append((*counts, cost, audit, source, turned))
        yield pd.DataFrame(rows, columns=_JUDGED.names)


def repair(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired) for (conv_id, turns) rows.

    ``turns`` are (turn, role, text) in order and without nulls but in ``turn``. ``repaired`` are the (role, text) left after the cheapest
    edits; an inserted turn has an empty text. A conversation without turns has zeros, an empty audit and no turns. An empty or unknown
    role fits nowhere as it is. Rows are judged one by one, so equal ones give equal results, and no rows give no rows.
    """
    numbers = F.filter(F.col("turns.turn"), lambda t: t.isNotNull())
    gaps = F.coalesce(F.array_max(numbers) - F.array_min(numbers) + 1 - F.size(F.array_distinct(numbers)), F.lit(0)).cast("bigint")
    judged = conversations.select("conv_id", "turns", gaps.alias("gaps"), _repaired(F.col("turns.role"), F.col("turns.text")).alias("_r"))

    def turn(source: Column, role: Column) -> Column:
        said = F.get("turns", source)
        return F.struct(F.coalesce(role, said["role"]).alias("role"), F.coalesce(said["text"], F.lit("")).alias("text"))

    counts = [F.col(f"_r.{n}").alias(n) for n in (*_COUNTS, "audit")]
    return judged.select("conv_id", "gaps", *counts, F.zip_with("_r.source", "_r.turned", turn).alias("repaired"))
