"""The N least distinct values of every column, as a partial aggregate.

Each task keeps N values a column and hands on no more than that; Spark adds the tasks' few rows up.
A batch is cut by the held bound before anything is sorted, so after the first batches a value
costs one vectorised comparison.

Values come as typed slots (see ``profile``): ``i`` (whole numbers, times), ``d`` (doubles; decimals with their
text), ``s`` (first characters of a text) with a digest ``h``, ``g``. Order is that of Spark: numbers by number
with NaN last, text by its bytes, equal texts by digest.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Task functions travel by value: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLOT_TYPES = {"i": "long", "d": "double", "s": "string", "h": "long", "g": "long"}
VALUE_SCHEMA = "ordinal int, i long, d double, s string, h long, g long"


class _Numbers:
    """One numeric slot."""

    def __init__(self, n: int):
        self.n, self.held = n, None

    def add(self, columns: list[pa.Array]) -> None:
        values = columns[0].drop_null().to_numpy(zero_copy_only=False)
        if values.dtype.kind == "f":
            values = values + 0.0     # -0.0 and 0.0 are one value
        if self.held is not None and len(self.held) == self.n:
            last = self.held[-1]
            values = values[~np.isnan(values)] if last != last else values[values < last]
        if len(values):
            values = np.unique(values)[:self.n]
            self.held = values if self.held is None else np.unique(np.concatenate([self.held, values]))[:self.n]

    def rows(self) -> list[tuple]:
        return [] if self.held is None else [(v,) for v in self.held.tolist()]


class _Tuples:
    """Several slots: the first leads, all together tell values apart."""

    def __init__(self, n: int):
        self.n, self.held = n, []

    def add(self, columns: list[pa.Array]) -> None:
        import pyarrow.compute as pc
        there = pc.is_valid(columns[0])
        if len(self.held) == self.n:
            last = self.held[-1]
            lead = last[0].decode() if isinstance(last[0], bytes) else last[0]
            # What equals the held bound in all slots is held already.
            same = pc.equal(columns[0], lead)
            for column, value in zip(columns[1:], last[1:]):
                same = pc.and_(same, pc.equal(column, value.decode() if isinstance(value, bytes) else value))
            there = pc.and_(there, pc.and_(pc.less_equal(columns[0], lead), pc.invert(same)))
        places = np.flatnonzero(pc.fill_null(there, False).to_numpy(zero_copy_only=False))
        if not len(places):
            return
        # One row of each value: by digest where there is one, else by the values themselves.
        keys = [c.take(pa.array(places)) for c in columns[-2:]]
        if all(pa.types.is_integer(k.type) for k in keys):
            a, b = (k.to_numpy(zero_copy_only=False) for k in keys)
            order = np.lexsort((a, b))
            a, b = a[order], b[order]
            places = places[order[np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])]]
        rows = zip(*([v.encode() if isinstance(v, str) else v for v in c.take(pa.array(places)).to_pylist()] for c in columns))
        self.held = sorted(set(self.held) | set(rows))[:self.n]

    def rows(self) -> list[tuple]:
        return [tuple(v.decode() if isinstance(v, bytes) else v for v in row) for row in self.held]


def _partial(slots: list[tuple[int, list[str]]], n: int) -> Callable:
    """``slots``: per column its ordinal and the slots it uses, in the order of the batch's columns."""
    def run(batches):
        held = [_Numbers(n) if len(names) == 1 else _Tuples(n) for _, names in slots]
        for batch in batches:
            at = 0
            for part, (_, names) in zip(held, slots):
                part.add([batch.column(at + k) for k in range(len(names))])
                at += len(names)
        out = {name: [] for name in ("ordinal", *SLOT_TYPES)}
        for part, (ordinal, names) in zip(held, slots):
            for row in part.rows():
                value = dict(zip(names, row))
                out["ordinal"].append(ordinal)
                for name in SLOT_TYPES:
                    out[name].append(value.get(name))
        types = {"ordinal": pa.int32(), "i": pa.int64(), "d": pa.float64(), "s": pa.string(), "h": pa.int64(), "g": pa.int64()}
        yield pa.RecordBatch.from_arrays([pa.array(v, types[k]) for k, v in out.items()], list(out))
    return run


def least_values(df: DataFrame, slots: list[tuple[int, dict]], n: int) -> DataFrame:
    """(ordinal, slots) of at least the ``n`` least distinct values of each column: at most ``n`` a task
    and column. ``slots``: per column its ordinal and its used slots as columns of ``df``."""
    columns = [value.cast(SLOT_TYPES[name]).alias(f"c{ordinal}_{name}") for ordinal, used in slots for name, value in used.items()]
    if not columns or n < 1:
        return df.select(F.lit(0).alias("x")).where(F.lit(False)).selectExpr(*[
            f"CAST(NULL AS {t}) AS {c}" for c, t in (x.split() for x in VALUE_SCHEMA.split(", "))])
    return (df.select(*columns).mapInArrow(_partial([(ordinal, list(used)) for ordinal, used in slots], n), VALUE_SCHEMA)
            .distinct())
