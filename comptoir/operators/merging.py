"""A user's own aggregates as partial states: tasks update states over their rows, and only states are shuffled and merged.

No group is ever held whole, so one key may have any share of the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from comptoir.functions.columns import ref

#: Groups whose states a task holds before it sends them on.
_STATES = 50_000


@dataclass(frozen=True)
class MergeAggregate:
    """An aggregate in four steps over a state, a tuple of the fields named in ``state`` (DDL).

    ``init()`` is the state of no rows. ``update(state, values, *others)`` takes some rows of a group, as pandas Series of the
    aggregated column and of ``columns``, with missing values in them. ``merge(a, b)`` joins two states, in any
    order, and ``finish(state)`` gives the result, of type ``result`` (DDL).
    """

    init: Callable[[], tuple]
    update: Callable[..., tuple]
    merge: Callable[[tuple, tuple], tuple]
    finish: Callable[[tuple], Any]
    state: str
    result: str
    columns: tuple[str, ...] = ()
    name: str = "merged"

    @property
    def __name__(self) -> str:
        return self.name


def merged_aggregates(df: DataFrame, keys: Sequence[str], planned: Sequence[tuple[str, MergeAggregate, str]]) -> DataFrame:
    """One row per key combination with the result of each planned (column, aggregate, output name).

    Rows whose keys are equal, NULL included, are one group. One pass over the rows; its shuffle has at most
    one row per key and task, or per 50,000 keys met in a task. Sorted partitions of states are merged one key at a time.
    """
    keys = list(keys)
    used = list(dict.fromkeys(c for column, how, _ in planned for c in (column, *how.columns)))
    rows = df.select(*[ref(k).alias(f"k{i}") for i, k in enumerate(keys)], *[ref(c).alias(f"v{i}") for i, c in enumerate(used)])
    key_fields = [T.StructField(f"k{i}", df.schema[k].dataType) for i, k in enumerate(keys)]
    states = T.StructType([*key_fields, *[T.StructField(f"s{i}", T.StructType.fromDDL(how.state)) for i, (_, how, _) in enumerate(planned)]])
    results = T.StructType([*key_fields, *[T.StructField(f"r{i}", T.StructType.fromDDL(f"r {how.result}")[0].dataType) for i, (_, how, _) in enumerate(planned)]])
    state_arrow, result_arrow = to_arrow_schema(states), to_arrow_schema(results)
    hows = [how for _, how, _ in planned]
    inputs = [[len(keys) + used.index(c) for c in (column, *how.columns)] for column, how, _ in planned]
    fields = [T.StructType.fromDDL(how.state).names for how in hows]
    n_keys = len(keys)

    def batch_of(found: list[tuple], values: list[list], schema: pa.Schema) -> pa.RecordBatch:
        columns = [*(zip(*found) if found else [[]] * n_keys), *values]
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)

    def as_rows(held: dict[tuple, list]) -> pa.RecordBatch:
        values = [[dict(zip(fields[j], own[j])) for own in held.values()] for j in range(len(hows))]
        return batch_of(list(held), values, state_arrow)

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            code: dict[tuple, int] = {}
            own = list(zip(*(batch.column(i).to_pylist() for i in range(n_keys)))) if n_keys else [()] * batch.num_rows
            codes = np.fromiter((code.setdefault(k, len(code)) for k in own), np.int64, len(own))
            order = np.argsort(codes, kind="stable")
            ends = np.cumsum(np.bincount(codes))
            series = {i: batch.column(i).to_pandas().iloc[order] for i in {i for own in inputs for i in own}}
            for key, a, b in zip(code, [0, *ends[:-1]], ends):
                state = held.setdefault(key, [how.init() for how in hows])
                for j, how in enumerate(hows):
                    state[j] = how.update(state[j], *[series[i].iloc[a:b] for i in inputs[j]])
            if len(held) >= _STATES:
                yield as_rows(held)
                held = {}
        if held:
            yield as_rows(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns):
                new = [tuple(s[f] for f in names) for s, names in zip(row[n_keys:], fields)]
                if state is not None and row[:n_keys] == key:
                    state = [how.merge(a, b) for how, a, b in zip(hows, state, new)]
                    continue
                if state is not None:
                    done.append((key, state))
                key, state = row[:n_keys], new
            if len(done) >= 10_000:
                yield finished(done)
                done = []
        if state is not None:
            yield finished([*done, (key, state)])

    def finished(done: list[tuple[tuple, list]]) -> pa.RecordBatch:
        values = [[how.finish(state[j]) for _, state in done] for j, how in enumerate(hows)]
        return batch_of([key for key, _ in done], values, result_arrow)

    partial = rows.mapInArrow(update, states)
    by = [f"k{i}" for i in range(n_keys)]
    met = partial.repartition(*by).sortWithinPartitions(*by) if by else partial.repartition(1)
    return met.mapInArrow(merge, results).toDF(*keys, *[name for _, _, name in planned])
