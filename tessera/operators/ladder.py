"""Threshold ladders: many bounds on one column judged by one comparison and a binary search.

Bounds of one column, direction and type are sorted so that a value fails a prefix of them: upper bounds
from the least, lower bounds from the greatest. Whether a row fails any is the comparison with the first bound
(which reaches the scan); how many it fails is a branchless binary search over the sorted literal array, and the
failing checks are that many from the start of a literal array of their ids. Cost per row does not grow with the
number of bounds, nor does the generated code.

Counts come from a histogram of (ladder, number of bounds failed): a bound's failures are the rows that fail at
least as many as its place.

A bound joins a ladder only where Spark's order of the literals is the order used here: numbers on numeric or text
columns (whole numbers and doubles apart), text on text columns of the default collation, lengths, days, instants.
Anything else stays a condition of its own.
"""

from __future__ import annotations

import datetime as dt
import math
from collections import defaultdict
from dataclasses import dataclass
from typing import Any

from pyspark.sql import types as T

from tessera.functions import predicates as P

LEAST_RUNGS = 4  # fewer bounds than this cost less as conditions of their own


@dataclass(frozen=True)
class Rung:
    """One bound: its group (column, direction, type), its SQL and its place in Spark's order."""
    lhs: str
    op: str
    kind: str
    bound: str
    order: Any

    @property
    def group(self) -> tuple[str, str, str]:
        return self.lhs, self.op, self.kind


def rung_of(key: str, columns: tuple[str, ...], dtype: T.DataType, value: Any, today: dt.date, now: dt.datetime) -> Rung | None:
    """The rung of a valid single-column bound, or None where it cannot join a ladder."""
    if len(columns) != 1:
        return None
    col = columns[0]
    if key in ("min", "max"):
        lhs, bound = P.value_operands(col, dtype, value)
        number = P.as_number(value)
        if isinstance(dtype, P.TEMPORAL):
            return None
        if number is not None:
            kind, order = ("int" if P.is_whole_literal(number) and isinstance(dtype, P.NUMERIC) else "double"), number
            if kind == "double":
                order = float(number)
                if math.isnan(order):
                    return None
        elif dtype == T.StringType():
            kind, order = "text", str(value).encode()
        else:
            return None
    elif key in ("min_length", "max_length"):
        lhs, bound = P.length_operands(col, value)
        kind, order = "length", int(P.as_number(value))
    elif key in ("min_date", "max_date"):
        lhs, bound = P.date_operands(col, dtype, value, today, now)
        order = P.resolve_date_bound(value[0] if isinstance(value, (list, tuple)) else value, today, now)
        if isinstance(order, dt.datetime) and order.tzinfo is not None:
            return None
        kind = "instant" if isinstance(order, dt.datetime) else "day"
    else:
        return None
    return Rung(lhs, "<" if key.startswith("min") else ">", kind, bound, order)


@dataclass(frozen=True)
class Ladder:
    """Checks in the order in which a value fails them."""
    rungs: tuple[Rung, ...]
    checks: tuple  # CompiledCheck of each rung

    @property
    def raw(self) -> str:
        """Whether a row fails any; NULL where that cannot be told."""
        return self.checks[0].raw

    @property
    def rank(self) -> str:
        """How many bounds a row fails: 0 for NULL. Halving steps over the sorted bounds."""
        first = self.rungs[0]
        bounds = f"array({', '.join(r.bound for r in self.rungs)})"
        steps = ", ".join(str(1 << k) for k in reversed(range(len(self.rungs).bit_length())))
        further = f"get({bounds}, _at + _step - 1) {'<' if first.op == '>' else '>'} {first.lhs}"
        return f"aggregate(array({steps}), 0, (_at, _step) -> IF({further}, _at + _step, _at))"


def split(compiled: list) -> tuple[list[Ladder], list]:
    """(ladders, checks that stay conditions of their own)."""
    groups = defaultdict(list)
    for cc in compiled:
        if cc.rung is not None:
            groups[cc.rung.group].append(cc)
    ladders, used = [], set()
    for members in groups.values():
        if len(members) < LEAST_RUNGS:
            continue
        members = sorted(members, key=lambda cc: cc.rung.order, reverse=members[0].rung.op == "<")
        ladders.append(Ladder(tuple(cc.rung for cc in members), tuple(members)))
        used |= {id(cc) for cc in members}
    return ladders, [cc for cc in compiled if id(cc) not in used]
