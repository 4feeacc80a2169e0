"""The loading flows as plain compositions.

``extract_load``: any Spark data source -> declared schema -> one table (the
single comprehensive table). ``star_load``: base -> dimensions and facts ->
one table each. ``load_all``: single table, star and relational tables of one
load, written together. A base that is costly to read again is staged once
for all of them, and the staged copy is dropped after the load. With an
appending sink, facts, children and the single table get this load's rows,
and dimensions and parents get the members they do not hold yet. All run on
the executors end to end; the driver only plans and commits.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starload.operators.conform import Rejects, rejected_rows
from starload.operators.dimensional import StarSpec, build_star, star_frames
from starload.operators.relational import RelationalSpec, parent_members, relational as relational_frames
from starload.operators.sharing import Outputs, resolve_share, share_base, write_outputs
from starload.schemas import get_schema
from starload.sinks.tables import Existing, write_and_reread
from starload.sources.generic import load_base, read_source


def extract_load(spark: SparkSession, fmt: str, schema: T.StructType | str | None, sink: Callable[..., object],
                 table: str, options: Mapping[str, str] | None = None, path: str | None = None,
                 row_cap: int | None = None, strict: bool = False, rejects: Rejects | None = None,
                 reject_table: str | None = None) -> object:
    """Read a source, bind the declared schema by name and write ``table``.

    ``schema`` may be the name of a declared schema; None means the one
    declared for ``table``. ``rejects`` counts the values that the lenient
    casts lose, in the pass that writes; with ``reject_table`` the source rows
    that lose one are written too, as they were, by a scan of their own.
    """
    src = read_source(spark, fmt, options=options, path=path, row_cap=row_cap)
    declared = _declared(schema, table)
    written = sink(load_base(src, declared, strict=strict, rejects=rejects), table)
    if reject_table and not strict:
        sink(rejected_rows(src, declared), reject_table)
    return written


def _declared(schema: T.StructType | str | None, table: str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else get_schema(schema or table)


def star_load(base: DataFrame, spec: StarSpec, sink: Callable[..., object], share: str = "auto",
              parallel: int | None = None, existing: Existing | None = None) -> dict[str, object]:
    """Build every output of ``spec`` from ``base`` and write each one;
    appending, dimensions get only new members (see ``new_members``)."""
    return write_outputs(build_star(base, spec, share=share), sink, parallel, existing)


def load_all(base: DataFrame, schema: T.StructType | str | None, sink: Callable[..., object], single_table: str,
             star: StarSpec | None = None, relational: RelationalSpec | None = None,
             parallel: int | None = None, share: str = "auto", strict: bool = False,
             existing: Existing | None = None, rejects: Rejects | None = None) -> dict[str, object]:
    """Write the single comprehensive table and every star and relational
    table of this load's rows, ``parallel`` at a time (default: all at once).

    Every output is derived from the conformed base, which ``share`` keeps for
    all of them at once (see ``sharing``). Where a base has to be staged and
    the sink can give back the single table it has just written, that table is
    the staged copy, so the wide rows are not encoded a further time.
    Dimensions and parents are derived from one another (see ``lattice``).
    ``rejects`` counts the values that the lenient casts lose, in the pass
    that writes all columns anyway.
    """
    declared = _declared(schema, single_table)
    loaded = load_base(base, declared, strict=strict)
    counted = loaded if rejects is None else load_base(base, declared, strict=strict, rejects=rejects)
    share = resolve_share(loaded, share)
    done: dict[str, object] = {}
    written = write_and_reread(sink, loaded, single_table, counted) if share == "stage" else None
    if written is not None:
        done[single_table], rows = written
        staged, share = None, "none"
    else:
        rows, staged = share_base(counted if share == "stage" else loaded, loaded.columns, share)
    frames, members = {} if done else {single_table: counted if share == "none" else rows}, {}
    if star is not None:
        frames |= star_frames(rows, star)
        members |= star.members()
    if relational is not None:
        frames |= relational_frames(rows, relational)
        members |= parent_members(relational)
    outputs = Outputs(frames=frames, base=rows, share=share, staged_path=staged, members=members)
    return done | write_outputs(outputs, sink, parallel, existing)
