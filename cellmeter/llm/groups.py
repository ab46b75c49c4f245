"""Rows of one key together, as they stream through a task."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Rows of the results of small groups that are handed on together.
_TOGETHER_ROWS = 1_000

Work = Callable[[pa.Table], Iterator[pa.RecordBatch]]
PairWork = Callable[[pa.RecordBatch, np.ndarray], Iterator[pa.RecordBatch]]


def by_group(
    rows: DataFrame, keys: Sequence[str], work: Work, schema: str, pairs: PairWork | None = None
) -> DataFrame:
    """``work`` on the rows of each key; ``keys`` are integers, and groups are small.

    Like ``applyInArrow``, without its cost per group: a task sorts its rows and
    hands them on in order, so one call of a task serves many groups. Where most
    groups are of two rows, ``pairs`` does the work for many of them: it gets a
    batch and the first row of each in it. Others of two may still go to ``work``.
    """
    keys = list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _together(_worked(batches, keys, work, pairs))

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, count = [], 0
    for batch in batches:
        parts.append(batch)
        count += batch.num_rows
        if count >= _TOGETHER_ROWS:
            yield from pa.Table.from_batches(parts).combine_chunks().to_batches()
            parts, count = [], 0
    if count:
        yield from pa.Table.from_batches(parts).combine_chunks().to_batches()


def _worked(
    batches: Iterator[pa.RecordBatch], keys: list[str], work: Work, pairs: PairWork | None
) -> Iterator[pa.RecordBatch]:
    parts: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        values = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        changed = np.zeros(batch.num_rows - 1, bool)
        for v in values:
            changed |= v[1:] != v[:-1]
        starts = np.concatenate([[0], np.flatnonzero(changed) + 1])
        ends = np.append(starts[1:], batch.num_rows)
        if pairs is not None:
            # The first and the last group may have rows in other batches.
            two = ends - starts == 2
            two[[0, -1]] = False
            yield from pairs(batch, starts[two])
            starts, ends = starts[~two], ends[~two]
        for begin, end in zip(starts.tolist(), ends.tolist()):
            key = tuple(v[begin] for v in values)
            if parts and key != last:
                yield from work(pa.Table.from_batches(parts))
                parts = []
            parts.append(batch.slice(begin, end - begin))
            last = key
    if parts:
        yield from work(pa.Table.from_batches(parts))
