"""Normalised relational tables (R1).

Each parent table holds the distinct natural-key (and attribute) rows of the
base plus a deterministic hash key over all of them, so a key names one row; the child table holds its own columns and
one foreign-key column per parent. Keys come from the row content alone
(``hash_key``), so there is no global sort or sequence to number rows and
nothing to coordinate between tasks: the child is a projection and each
parent one partial + final hash aggregate.

Parents may hang together (a snowflake): a city row holds the key of its
state, and the child holds the city's key only. That needs every city to have
one state; a base in which one has two fails the load, with the key named.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.functions.columns import hash_key, quoted
from starload.operators.lattice import Member
from starload.operators.sharing import Outputs, resolve_share, share_base
from starload.session import scratch_path
from starload.sinks.tables import run_jobs


@dataclass(frozen=True)
class Parent:
    """``references`` names the parent whose key this one's rows hold. The
    columns of that parent which belong to this one's own key stay here too."""

    name: str
    key: str
    natural_key: Sequence[str]
    attributes: Sequence[str] = ()
    references: str | None = None

    @property
    def columns(self) -> list[str]:
        return [*self.natural_key, *self.attributes]


@dataclass(frozen=True)
class RelationalSpec:
    child: str
    child_columns: Sequence[str]
    parents: Sequence[Parent]

    def __post_init__(self) -> None:
        names = {p.name for p in self.parents}
        for p in self.parents:
            seen, at = set(), p
            while at.references is not None:
                if at.references not in names or at.name in seen:
                    raise ValueError(f"{p.name}: the references {at.references!r} lead nowhere or round")
                seen.add(at.name)
                at = self.parent(at.references)

    def parent(self, name: str) -> Parent:
        return next(p for p in self.parents if p.name == name)

    def held_by_child(self) -> list[Parent]:
        """Parents whose key the child holds: those that no other parent leads to."""
        led_to = {p.references for p in self.parents}
        return [p for p in self.parents if p.name not in led_to]


def _key(parent: Parent):
    return hash_key(parent.columns).alias(parent.key)


def _member(parent: Parent, referenced: Parent | None = None) -> Member:
    """The key is computed after the distinct, so only distinct rows are
    hashed and the shuffle carries no key column."""
    own = [F.col(quoted(c)) for c in parent.columns]
    if referenced is None:
        return Member(parent.columns, lambda rows: rows.select(_key(parent), *own))

    def table(rows: DataFrame) -> DataFrame:
        other = F.struct(*[F.col(quoted(c)) for c in referenced.columns])
        one = rows.groupBy(*own).agg(F.min(other).alias("lo"), F.max(other).alias("hi"))
        shown = F.concat_ws("|", *[F.coalesce(F.col(quoted(c)).cast("string"), F.lit("NULL")) for c in parent.columns])
        broken = F.raise_error(F.concat(F.lit(f"{parent.name}: more than one row of {referenced.name} for "), shown))
        key = hash_key([F.col("lo").getField(c) for c in referenced.columns])
        return one.select(_key(parent), *own,
                          F.when(F.col("lo").eqNullSafe(F.col("hi")), key).otherwise(broken.cast("string")).alias(referenced.key))
    return Member(list(dict.fromkeys([*parent.columns, *referenced.columns])), table, holds=parent.columns)


def parent_table(base: DataFrame, parent: Parent, referenced: Parent | None = None) -> DataFrame:
    """Distinct parent rows, keyed, with the key of the parent they reference."""
    return _member(parent, referenced).table(base)


def parent_members(spec: RelationalSpec) -> dict[str, Member]:
    return {p.name: _member(p, spec.parent(p.references) if p.references else None) for p in spec.parents}


def child_table(base: DataFrame, spec: RelationalSpec) -> DataFrame:
    """Child rows with a foreign key per parent that no other parent leads to;
    one row per base row."""
    return base.select(*[F.col(quoted(c)) for c in spec.child_columns], *[_key(p) for p in spec.held_by_child()])


def relational(base: DataFrame, spec: RelationalSpec) -> dict[str, DataFrame]:
    """Parent tables and the child table of ``spec``, lazily."""
    out = {name: member.table(base) for name, member in parent_members(spec).items()}
    out[spec.child] = child_table(base, spec)
    return out


def parents_kept(tables: Mapping[str, DataFrame], spec: RelationalSpec) -> dict[str, DataFrame]:
    """The tables with every parent written to the shared folder and read back.
    Their sizes are then known before a join is planned, so the child's wide
    rows are shuffled only to a parent that is too large to be broadcast."""
    def kept(name: str) -> DataFrame:
        df = tables[name]
        path = scratch_path(df.sparkSession, f"parent-{name}")
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    spark = tables[spec.child].sparkSession
    return {**tables, **run_jobs(spark, {p.name: partial(kept, p.name) for p in spec.parents})}


def joined_back(tables: Mapping[str, DataFrame], spec: RelationalSpec) -> DataFrame:
    """The base's rows again: the child with its parents, along their keys.
    Columns that several of them hold are taken once."""
    rows = tables[spec.child]
    waiting = spec.held_by_child()
    while waiting:
        p = waiting.pop(0)
        more = [c for c in tables[p.name].columns if c not in rows.columns]
        rows = rows.join(tables[p.name].select(p.key, *[F.col(quoted(c)) for c in more]), p.key)
        if p.references:
            waiting.append(spec.parent(p.references))
    return rows


def spec_columns(spec: RelationalSpec) -> list[str]:
    cols = dict.fromkeys(spec.child_columns)
    for p in spec.parents:
        cols.update(dict.fromkeys(p.columns))
    return list(cols)


def build_relational(base: DataFrame, spec: RelationalSpec, share: str = "auto") -> Outputs:
    """``relational`` over one shared base (see ``sharing``); write with
    ``write_outputs``."""
    share = resolve_share(base, share)
    pruned, staged = share_base(base, spec_columns(spec), share)
    return Outputs(frames=relational(pruned, spec), base=pruned, share=share, staged_path=staged,
                   members=parent_members(spec))
