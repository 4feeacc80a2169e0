"""Dimensions from dimensions: the containment lattice of a star.

``SELECT DISTINCT a, b`` over the base equals the same over any dimension that
holds ``a`` and ``b``, because a dimension keeps every combination of its
columns. So only the dimensions that no other one holds (the roots) need the
base; each of the others is derived from the smallest dimension that holds
its columns, which is far smaller than the base.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.functions.columns import quoted

Columns = Sequence[str]


@dataclass(frozen=True)
class Member:
    """A table that holds each combination of ``columns`` once; ``finish``
    makes the table of the distinct rows (adds a key, say). ``holds`` are the
    columns whose combinations the finished table still has, if not all."""

    columns: Columns
    finish: Callable[[DataFrame], DataFrame] | None = None
    holds: Columns | None = None

    def table(self, source: DataFrame) -> DataFrame:
        rows = distinct_rows(source, self.columns)
        return self.finish(rows) if self.finish else rows


def containment(members: Mapping[str, Member]) -> dict[str, str | None]:
    """For every member the one to derive it from, None for a root.

    That is the smallest one, by number of columns and then in declared order,
    that holds all the columns it needs. Of members with the same columns the
    first is the parent of the others.
    """
    needs = {name: set(m.columns) for name, m in members.items()}
    holds = {name: set(m.columns if m.holds is None else m.holds) for name, m in members.items()}
    order = list(members)
    out: dict[str, str | None] = {}
    for i, name in enumerate(order):
        able = [o for j, o in enumerate(order) if o != name and holds[o] >= needs[name]
                and (j < i or not holds[name] >= needs[o])]
        out[name] = min(able, key=lambda o: (len(holds[o]), order.index(o)), default=None)
    return out


def depth(parents: Mapping[str, str | None], name: str) -> int:
    """Steps from the base: 0 for a root and for what is no dimension."""
    steps = 0
    while parents.get(name) is not None:
        name, steps = parents[name], steps + 1
    return steps


def distinct_rows(frame: DataFrame, columns: Columns) -> DataFrame:
    return frame.select(*[F.col(quoted(c)) for c in columns]).distinct()

