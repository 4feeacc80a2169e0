"""Kimball-style dimensions and facts (M1-M6).

A dimension is ``SELECT DISTINCT <columns>`` over the base: Spark runs it as a
partial hash aggregate before the exchange and a final one after, so a hot
value (even a third of all rows) collapses to one row per map task before it
is shuffled. NULLs compare equal, so a NULL member is kept. A fact is a plain
projection: no shuffle, duplicates kept, one output row per base row.

``build_star`` derives every output of a ``StarSpec`` from one base, pruned
to the columns they use and shared as ``share`` says (see ``sharing``). When a
star is written, a dimension whose columns another one holds is derived from
that one in place of the base (see ``lattice``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.functions.columns import quoted
from starload.operators.lattice import Member, distinct_rows
from starload.operators.sharing import Outputs, resolve_share, share_base, write_outputs
from starload.sinks.tables import Sink


def _cols(columns: Sequence[str]):
    return [F.col(quoted(c)) for c in columns]


def dimension(base: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations of ``columns`` (several rows per business key
    when its attributes vary)."""
    return distinct_rows(base, columns)


def fact(base: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Projection of ``columns``; one row per base row."""
    return base.select(*_cols(columns))


@dataclass(frozen=True)
class StarSpec:
    """Output tables of a star as data: name -> columns."""

    dimensions: Mapping[str, Sequence[str]]
    facts: Mapping[str, Sequence[str]]

    def columns(self) -> list[str]:
        """Every column any output needs, in order of first use."""
        seen: dict[str, None] = {}
        for cols in [*self.dimensions.values(), *self.facts.values()]:
            for c in cols:
                seen.setdefault(c, None)
        return list(seen)

    def tables(self) -> list[str]:
        return [*self.dimensions, *self.facts]

    def members(self) -> dict[str, Member]:
        return {name: Member(cols) for name, cols in self.dimensions.items()}


Star = Outputs


def star_frames(base: DataFrame, spec: StarSpec) -> dict[str, DataFrame]:
    """Every output of ``spec``, lazily."""
    return {**{name: dimension(base, cols) for name, cols in spec.dimensions.items()},
            **{name: fact(base, cols) for name, cols in spec.facts.items()}}


def build_star(base: DataFrame, spec: StarSpec, share: str = "auto") -> Star:
    """All outputs of ``spec`` from one base, pruned to the columns they use.

    ``share="auto"`` (default) re-reads a plain Parquet/ORC base and stages
    any costlier one (joins, JDBC, row formats) once; see ``sharing``.
    """
    share = resolve_share(base, share)
    pruned, staged = share_base(base, spec.columns(), share)
    return Star(frames=star_frames(pruned, spec), base=pruned, share=share, staged_path=staged, members=spec.members())


def run_star(star: Star, sink: Sink, parallel: int | None = None) -> dict[str, object]:
    """Write every output of ``star`` with ``sink(frame, table_name)``, then
    release the shared base (all writes at once by default)."""
    return write_outputs(star, sink, parallel)
