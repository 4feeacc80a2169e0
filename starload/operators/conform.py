"""Schema conform (C1-C6), what its casts lose, and schema subset (C7).

``conform`` is a single projection: every declared column in declared order,
cast to its declared type, absent ones as typed NULLs, undeclared ones
dropped. Catalyst folds it into the scan's projection, so only the declared
columns that exist are read.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.functions.columns import quoted, sql_type


def _sources(df: DataFrame, schema: T.StructType) -> list[tuple[T.StructField, T.StructField | None]]:
    """Every declared field with the frame's field of its name, or None.

    Names are matched as Spark resolves them (case-insensitively unless
    ``spark.sql.caseSensitive`` is on).
    """
    case_sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"
    norm = (lambda n: n) if case_sensitive else str.lower
    present: dict[str, T.StructField] = {}
    for f in df.schema.fields:
        present.setdefault(norm(f.name), f)
    return [(field, present.get(norm(field.name))) for field in schema.fields]


def conform_exprs(df: DataFrame, schema: T.StructType, strict: bool = False) -> list[str]:
    """The select list (SQL expressions) that conforms ``df`` to ``schema``."""
    cast = "cast" if strict else "try_cast"
    out = []
    for field, src in _sources(df, schema):
        target = sql_type(field.dataType)
        if src is None:
            expr = f"cast(NULL AS {target})"
        elif src.dataType == field.dataType:
            expr = quoted(src.name)
        else:
            expr = f"{cast}({quoted(src.name)} AS {target})"
        out.append(f"{expr} AS {quoted(field.name)}")
    return out


@dataclass
class Rejects:
    """Values that the lenient casts of one ``conform`` turn into NULL.

    They are counted by the pass that first runs the conformed frame (Spark's
    observed metrics), so counting reads nothing a second time. ``counts``
    waits for that pass; a frame without lossy casts needs none.
    """

    _lossy: dict[str, str] = field(default_factory=dict)  # declared column -> metric
    _columns: list[str] = field(default_factory=list)
    _observation: Observation | None = None

    def counts(self) -> dict[str, int]:
        """Declared column -> number of values lost; 0 where no cast can lose any."""
        got = self._observation.get if self._observation is not None else {}
        return {c: int(got[self._lossy[c]]) if c in self._lossy else 0 for c in self._columns}

    def total(self) -> int:
        return sum(self.counts().values())

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row per declared column: column, lost."""
        return spark.createDataFrame(list(self.counts().items()), "column string, lost long")


def _lost_values(df: DataFrame, schema: T.StructType) -> dict[str, Column]:
    """For every declared column that is cast: whether the lenient cast makes a NULL of a value."""
    return {field.name: F.expr(f"{quoted(src.name)} IS NOT NULL AND "
                               f"try_cast({quoted(src.name)} AS {sql_type(field.dataType)}) IS NULL")
            for field, src in _sources(df, schema) if src is not None and src.dataType != field.dataType}


def conform(df: DataFrame, schema: T.StructType, strict: bool = False, rejects: Rejects | None = None) -> DataFrame:
    """Give ``df`` exactly the columns, order and types of ``schema``.

    Lenient by default: a value that does not cast becomes NULL
    (``try_cast``). With ``strict=True`` a bad value fails the job. The
    projection is handed to Spark in one call, however wide the schema.
    ``rejects`` gets the numbers of values that become NULL, once the frame
    has run; it serves one frame.
    """
    exprs = conform_exprs(df, schema, strict=strict)
    if rejects is not None:
        if rejects._columns:
            raise ValueError("these rejects belong to another frame")
        rejects._columns = schema.names
        lost = {} if strict else _lost_values(df, schema)
        if lost:
            rejects._observation = Observation()
            rejects._lossy = {name: f"m{i}" for i, name in enumerate(lost)}
            df = df.observe(rejects._observation, *[F.count_if(lost[n]).alias(m) for n, m in rejects._lossy.items()])
    return df.selectExpr(*exprs)


def rejected_rows(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of ``df``, as they are, of which the lenient ``conform`` loses a
    value, and the names of the declared columns that lose it (``rejected``)."""
    names = [F.when(lost, F.lit(name)) for name, lost in _lost_values(df, schema).items()]
    rejected = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
    return df.filter(F.size(rejected) > 0).select("*", rejected.alias("rejected"))


def subset_schema(schema: T.StructType, columns: Iterable[str]) -> T.StructType:
    """Declared fields whose names are in ``columns`` (in any case), in declared order."""
    wanted = {c.lower() for c in columns}
    return T.StructType([f for f in schema.fields if f.name.lower() in wanted])


def select_in_schema_order(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Keep the frame's columns that the schema declares, in declared order."""
    sub = subset_schema(schema, df.columns)
    return df.select(*[F.col(quoted(f.name)) for f in sub.fields])
