"""Many small groups per call: tasks stream their rows in group order and work on whole groups, a batch of them at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BATCH_ROWS = 1 << 17

Work = Callable[[pa.Table, np.ndarray], pa.Table]


def column(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy()


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """First row of each group of rows in group order; nulls are a group."""
    fresh = np.zeros(table.num_rows, dtype=bool)
    fresh[:1] = True
    for key in keys:
        values = table[key].combine_chunks()
        if values.null_count or not pa.types.is_integer(values.type):
            values = values.dictionary_encode(null_encoding="encode").indices
        codes = values.to_numpy(zero_copy_only=False)
        fresh[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(fresh)


def _weighed(batches: Iterator[pa.RecordBatch], weigh: Callable[[pa.Table], np.ndarray] | None, budget: int) -> Iterator[tuple[pa.Table, int]]:
    """The rows as tables that each weigh about the budget at most, with their weights."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if weigh is None:
            yield table, table.num_rows
            continue
        upto = np.cumsum(weigh(table))
        start = 0
        while start < len(upto):
            before = int(upto[start - 1]) if start else 0
            end = max(start + 1, int(np.searchsorted(upto, before + budget, side="right")))
            yield table.slice(start, end - start), int(upto[end - 1]) - before
            start = end


def whole_groups(
    df: DataFrame, keys: list[str], order: list, work: Work, schema: T.StructType | str, budget: int = BATCH_ROWS,
    weigh: Callable[[pa.Table], np.ndarray] | None = None, shrink: Callable[[pa.Table], pa.Table] | None = None,
) -> DataFrame:
    """``work`` on batches of whole groups: it gets rows in the order (keys, order) with the first row of each group.

    A task holds about ``budget`` rows, or their weight, and the group it is in. ``shrink`` replaces the rows of a group seen so far by fewer
    that stand for them, so a group of any size passes through; without it the caller bounds the groups.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        weight, limit = 0, budget
        for table, more in _weighed(batches, weigh, budget):
            held.append(table)
            weight += more
            if weight < limit:
                continue
            rows = pa.concat_tables(held).combine_chunks()
            starts = group_starts(rows, keys)
            last = int(starts[-1])
            if last:
                yield from work(rows.slice(0, last), starts[:-1]).to_batches(10_000)
                rows = rows.slice(last)
            size = lambda t: t.num_rows if weigh is None else int(weigh(t).sum())
            weight = size(rows)
            if shrink is not None and 2 * weight > budget:
                rows = pa.Table.from_arrays(shrink(rows).columns, schema=rows.schema)
                weight = size(rows)
            held, limit = [rows], max(budget, 2 * weight)
        if held:
            rows = pa.concat_tables(held).combine_chunks()
            yield from work(rows, group_starts(rows, keys)).to_batches(10_000)

    dealt = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    return dealt.mapInArrow(run, schema)
