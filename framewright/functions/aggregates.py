"""User-defined aggregates: a mergeable state, filled and merged in Arrow batches.

An aggregate says how a batch of rows fills a state per group (``update``), how states of one group
become one (``merge``) and what a state means (``finish``); each works on whole NumPy arrays.  A map task
keeps one state per group it has seen, so what is shuffled is states, not rows: a key with a third of
all rows sends one state per task, and no task holds a group's rows.

Workers import this module, so the package has to be on their path (``--py-files`` on a cluster).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, FloatType, StructField, StructType

#: States that a map task holds before it sends them on.
HELD = 1 << 17

State = dict[str, np.ndarray]


class Aggregate:
    """One aggregate.  ``state`` and ``result`` are DDL: the fields of the state (numbers, or arrays of a
    fixed length as two-dimensional NumPy arrays) and the type of the result."""

    state: str
    result: str

    def update(self, group: np.ndarray, groups: int, *columns: pa.Array) -> State:
        """States of ``groups`` groups from a batch; ``group`` is the group number of each row."""
        raise NotImplementedError

    def merge(self, starts: np.ndarray, state: State) -> State:
        """One state per run of rows; a run begins at each of ``starts`` and has one group's states."""
        raise NotImplementedError

    def finish(self, state: State) -> pa.Array:
        raise NotImplementedError


def numbers(group: np.ndarray, *columns: pa.Array) -> list[np.ndarray]:
    """Group numbers and columns as doubles, without the rows in which a column is null or NaN."""
    values = [c.cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False) for c in columns]
    here = ~np.any([np.isnan(v) for v in values], axis=0)
    return [group[here], *(v[here] for v in values)]


class GeometricMean(Aggregate):
    """Geometric mean of the positive values; null where there is none."""

    state = "n long, logs double"
    result = "double"

    def update(self, group, groups, values):
        g, x = numbers(group, values)
        g, x = g[x > 0], x[x > 0]
        return {"n": np.bincount(g, minlength=groups), "logs": np.bincount(g, np.log(x), groups)}

    def merge(self, starts, state):
        return {name: np.add.reduceat(x, starts) for name, x in state.items()}

    def finish(self, state):
        none = state["n"] == 0
        return pa.array(np.exp(state["logs"] / np.where(none, 1, state["n"])), mask=none)


class LargestMean(Aggregate):
    """Mean of the ``k`` largest values (all, if fewer); null where there is none."""

    state = "top array<double>"
    result = "double"

    def __init__(self, k: int):
        if k < 1:
            raise ValueError("k must be at least 1")
        self.k = k

    def _top(self, group: np.ndarray, groups: int, x: np.ndarray) -> State:
        order = np.lexsort((-x, group))
        g, x = group[order], x[order]
        nth = np.arange(len(g)) - np.searchsorted(g, g)
        top = np.full((groups, self.k), np.nan)
        top[g[nth < self.k], nth[nth < self.k]] = x[nth < self.k]
        return {"top": top}

    def update(self, group, groups, values):
        g, x = numbers(group, values)
        return self._top(g, groups, x)

    def merge(self, starts, state):
        top = state["top"]
        run = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(top)]))
        g, x = np.repeat(run, self.k), top.ravel()
        return self._top(g[~np.isnan(x)], len(starts), x[~np.isnan(x)])

    def finish(self, state):
        n = (~np.isnan(state["top"])).sum(axis=1)
        return pa.array(np.nansum(state["top"], axis=1) / np.maximum(n, 1), mask=n == 0)


class Slope(Aggregate):
    """Slope of the least-squares line of y over x (columns y, x); null where x does not vary.

    The state holds means and products of deviations, merged pairwise around the joint mean, so that large
    values that vary little lose no digits."""

    state = "n double, mx double, my double, sxx double, sxy double"
    result = "double"

    def update(self, group, groups, y, x):
        g, y, x = numbers(group, y, x)
        n = np.bincount(g, minlength=groups).astype(float)
        mx, my = (np.bincount(g, v, groups) / np.maximum(n, 1) for v in (x, y))
        dx, dy = x - mx[g], y - my[g]
        return {"n": n, "mx": mx, "my": my, "sxx": np.bincount(g, dx * dx, groups), "sxy": np.bincount(g, dx * dy, groups)}

    def merge(self, starts, state):
        n = np.add.reduceat(state["n"], starts)
        size = np.diff(np.r_[starts, len(state["n"])])
        mx, my = (np.add.reduceat(state["n"] * state[m], starts) / np.maximum(n, 1) for m in ("mx", "my"))
        dx, dy = (state[m] - np.repeat(joint, size) for m, joint in (("mx", mx), ("my", my)))
        return {"n": n, "mx": mx, "my": my,
                "sxx": np.add.reduceat(state["sxx"] + state["n"] * dx * dx, starts),
                "sxy": np.add.reduceat(state["sxy"] + state["n"] * dx * dy, starts)}

    def finish(self, state):
        flat = state["sxx"] <= 0
        return pa.array(state["sxy"] / np.where(flat, 1, state["sxx"]), mask=flat)


def _grouped(keys: Sequence[pa.Array], n: int) -> tuple[np.ndarray, np.ndarray]:
    """The group number of each row (nulls are a value) and the first row of each group."""
    codes = np.zeros(n, np.int64)
    for key in keys:
        coded = key.dictionary_encode(null_encoding="encode")
        codes = codes * max(len(coded.dictionary), 1) + coded.indices.to_numpy(zero_copy_only=False)
        codes = np.unique(codes, return_inverse=True)[1]
    _, first, codes = np.unique(codes, return_index=True, return_inverse=True)
    return codes, first


class _Job:
    """The two passes over batches: rows to states, states to results."""

    def __init__(self, n_keys: int, aggregates: Sequence[tuple[Aggregate, int]], states: pa.Schema, results: pa.Schema, held: int):
        self.n_keys, self.aggregates, self.states, self.results, self.held = n_keys, aggregates, states, results, held
        self.fields = [StructType.fromDDL(a.state).names for a, _ in aggregates]

    def _column(self, values, kind: pa.DataType) -> pa.Array:
        if getattr(values, "ndim", 1) == 2:
            width = values.shape[1]
            flat = pa.array(values.ravel(), kind.value_type)
            return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * width, pa.int32()), flat).cast(kind)
        made = values if isinstance(values, pa.Array) else pa.array(values)
        return made.cast(kind)

    def _batch(self, keys: Sequence[pa.Array], columns: Iterable, schema: pa.Schema) -> pa.RecordBatch:
        kinds = schema.types[self.n_keys:]
        return pa.RecordBatch.from_arrays([k.cast(t) for k, t in zip(keys, schema.types)] + [self._column(c, t) for c, t in zip(columns, kinds)],
                                          schema=schema)

    def _read(self, batch: pa.RecordBatch) -> list[State]:
        at, out = self.n_keys, []
        for names in self.fields:
            state = {}
            for name in names:
                c = batch.column(at)
                if pa.types.is_list(c.type):
                    state[name] = c.flatten().to_numpy(zero_copy_only=False).reshape(len(c), -1)
                else:
                    state[name] = c.to_numpy(zero_copy_only=False)
                at += 1
            out.append(state)
        return out

    def _filled(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = batch.columns[:self.n_keys]
        group, first = _grouped(keys, batch.num_rows)
        groups = len(first) if self.n_keys else 1
        at, columns = self.n_keys, []
        for (aggregate, inputs), names in zip(self.aggregates, self.fields):
            state = aggregate.update(group, groups, *batch.columns[at:at + inputs])
            columns += [state[name] for name in names]
            at += inputs
        return self._batch([k.take(pa.array(first)) for k in keys], columns, self.states)

    def _merged(self, batches: list[pa.RecordBatch]) -> tuple[pa.RecordBatch, int]:
        """One state per group, and the place of the last row's group."""
        batch = pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
        keys = batch.columns[:self.n_keys]
        group, first = _grouped(keys, batch.num_rows)
        order = np.argsort(group, kind="stable")
        starts = np.searchsorted(group[order], np.arange(len(first)))
        ordered = batch.take(pa.array(order))
        columns = []
        for (aggregate, _), names, state in zip(self.aggregates, self.fields, self._read(ordered)):
            state = aggregate.merge(starts, state)
            columns += [state[name] for name in names]
        return self._batch([k.take(pa.array(first)) for k in keys], columns, self.states), int(group[-1])

    def partial(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(self._filled(batch))
                n += held[-1].num_rows
            if n > self.held:
                one = self._merged(held)[0]
                if one.num_rows > self.held // 2:        # many groups: keeping them saves little
                    yield one
                    held, n = [], 0
                else:
                    held, n = [one], one.num_rows
        if held:
            yield self._merged(held)[0]

    def nothing(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The state of no rows, for a total without keys."""
        for batch in batches:
            if batch.num_rows:
                yield self._filled(batch.slice(0, 0))

    def _results(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        done = [aggregate.finish(state) for (aggregate, _), state in zip(self.aggregates, self._read(batch))]
        return self._batch(batch.columns[:self.n_keys], done, self.results)

    def final(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """States sorted by key: all groups of a batch but the last one are complete."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            one, last = self._merged([*held, batch])
            complete = np.delete(np.arange(one.num_rows), last)
            if len(complete):
                yield self._results(one.take(pa.array(complete)))
            held = [one.slice(last, 1)]
        if held:
            yield self._results(held[0])


def aggregate_by(df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, tuple[Aggregate, Sequence[str]]],
                 held: int = HELD) -> DataFrame:
    """``keys`` and one column per aggregate: ``{"name": (aggregate, its columns)}``, all in one pass.

    Null keys are a group; without keys there is one row, also for an empty table.  NaN keys are one group,
    and so are 0.0 and -0.0.  Keys are of any type that Arrow can hash (no arrays, maps or structs).
    ``held``: states that a map task keeps; it changes no result."""
    spark = df.sparkSession
    fields = [df.schema[k] for k in keys]
    nth = [f"__k{i}" for i in range(len(keys))]
    floats = (FloatType, DoubleType)
    columns = [(F.col(f"`{k}`") + F.lit(0).cast(f.dataType) if isinstance(f.dataType, floats) else F.col(f"`{k}`")).alias(n)
               for k, f, n in zip(keys, fields, nth)]
    for i, (_, inputs) in enumerate(aggregates.values()):
        columns += [F.col(f"`{c}`").alias(f"__i{i}_{j}") for j, c in enumerate(inputs)]
    kept = [StructField(n, f.dataType) for n, f in zip(nth, fields)]
    states = StructType(kept + [StructField(f"__s{i}_{f.name}", f.dataType)
                                for i, (a, _) in enumerate(aggregates.values()) for f in StructType.fromDDL(a.state)])
    results = StructType(kept + [StructField(f"__r{i}", StructType.fromDDL(f"r {a.result}")["r"].dataType)
                                 for i, (a, _) in enumerate(aggregates.values())])
    job = _Job(len(nth), [(a, len(c)) for a, c in aggregates.values()], to_arrow_schema(states),
               to_arrow_schema(results), held)
    rows = df.select(*columns)
    found = rows.mapInArrow(job.partial, states)
    if nth:
        dealt = found.repartition(*nth).sortWithinPartitions(*nth)
    else:
        one = spark.range(1, numPartitions=1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema])
        dealt = found.unionByName(one.mapInArrow(job.nothing, states)).coalesce(1)      # one state per task
    done = dealt.mapInArrow(job.final, results)
    return done.select(*[F.col(n).alias(k) for n, k in zip(nth, keys)], *[F.col(f"__r{i}").alias(name) for i, name in enumerate(aggregates)])
