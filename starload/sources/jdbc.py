"""JDBC source (S2) and the connection description shared with the sink.

Reads run on the executors. Without partition options Spark reads a table
in one task; ``JdbcPartitioning`` splits it into ``num_partitions`` ranges of
equal width on a numeric, date or timestamp column, and ``predicates`` gives
one task per WHERE clause. ``jdbc_quantiles`` makes predicates of about equal
numbers of rows, whatever the values' distribution. Column pruning and filters are pushed into the
generated query by Catalyst.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions.columns import quoted


@dataclass(frozen=True)
class JdbcConnection:
    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    properties: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def postgres(cls, host: str, port: int | str, database: str, user: str,
                 password: str, **properties: str) -> "JdbcConnection":
        return cls(url=f"jdbc:postgresql://{host}:{port}/{database}", user=user,
                   password=password, driver="org.postgresql.Driver", properties=properties)

    def options(self) -> dict[str, str]:
        opts = {"url": self.url, **{k: str(v) for k, v in self.properties.items()}}
        if self.user is not None:
            opts["user"] = self.user
        if self.password is not None:
            opts["password"] = self.password
        if self.driver is not None:
            opts["driver"] = self.driver
        return opts


@dataclass(frozen=True)
class JdbcPartitioning:
    column: str
    lower_bound: int | str
    upper_bound: int | str
    num_partitions: int

    def options(self) -> dict[str, str]:
        return {"partitionColumn": self.column, "lowerBound": str(self.lower_bound),
                "upperBound": str(self.upper_bound), "numPartitions": str(self.num_partitions)}


def jdbc_read_options(conn: JdbcConnection, table: str | None = None, query: str | None = None,
                      partitioning: JdbcPartitioning | None = None,
                      fetch_size: int | None = 10_000) -> dict[str, str]:
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    opts = conn.options()
    if table is not None:
        opts["dbtable"] = table
    else:
        opts["query"] = query
    if partitioning is not None:
        if query is not None:
            raise ValueError("partitioned reads need a table (or a subquery as table)")
        opts.update(partitioning.options())
    if fetch_size:
        opts["fetchsize"] = str(fetch_size)
    return opts


def jdbc_properties(conn: JdbcConnection, fetch_size: int | None = 10_000) -> dict[str, str]:
    """Connection properties for ``spark.read.jdbc`` (one task per predicate)."""
    return {k: v for k, v in jdbc_read_options(conn, table="_", fetch_size=fetch_size).items()
            if k not in ("url", "dbtable")}


def read_jdbc(spark: SparkSession, conn: JdbcConnection, table: str | None = None,
              query: str | None = None, partitioning: JdbcPartitioning | None = None,
              predicates: Sequence[str] | None = None, fetch_size: int | None = 10_000) -> DataFrame:
    """Read a table (or query) over JDBC, in parallel when partitioned."""
    if predicates:
        if table is None:
            raise ValueError("predicates need a table")
        return spark.read.jdbc(conn.url, table, predicates=list(predicates),
                               properties=jdbc_properties(conn, fetch_size))
    opts = jdbc_read_options(conn, table=table, query=query, partitioning=partitioning,
                             fetch_size=fetch_size)
    return spark.read.format("jdbc").options(**opts).load()


def jdbc_partitioning(spark: SparkSession, conn: JdbcConnection, table: str, column: str,
                      num_partitions: int) -> JdbcPartitioning:
    """Range partitioning over ``column`` with bounds taken from the data.

    ``min``/``max`` are pushed into the database as one aggregate query
    (``pushDownAggregate``), so a single row comes back to the driver.
    Bounds only set the stride: rows outside them still go to the first or
    last partition, so nothing is lost.
    """
    opts = {**jdbc_read_options(conn, table=table), "pushDownAggregate": "true"}
    row = (spark.read.format("jdbc").options(**opts).load()
           .agg(F.min(quoted(column)).alias("lo"), F.max(quoted(column)).alias("hi")).first())
    lo, hi = (row.lo, row.hi) if row is not None else (None, None)
    if lo is None:
        return JdbcPartitioning(column, 0, 1, 1)
    return JdbcPartitioning(column, *whole_bounds(lo, hi), max(1, int(num_partitions)))


def whole_bounds(lo, hi):
    """Bounds as Spark reads them: numeric ones are whole numbers."""
    if isinstance(lo, (Decimal, float)):
        return math.floor(lo), math.ceil(hi)
    return lo, hi


def quantile_query(table: str, column: str, parts: int) -> str:
    """SQL that gives the first value of each of ``parts`` equal shares of a
    table's rows, in order of a column. The database sorts; one row per share
    comes back. ``column`` is written as the database wants it (quoted, say)."""
    return (f"SELECT MIN(v) AS bound FROM (SELECT {column} AS v, NTILE({int(parts)}) OVER (ORDER BY {column}) AS part "
            f"FROM {table} WHERE {column} IS NOT NULL) shares GROUP BY part")


def literal(value) -> str:
    """A value as SQL text that databases agree on."""
    if isinstance(value, bool) or value is None:
        raise TypeError("no bounds over booleans or NULL")
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, float):
        if not math.isfinite(value):
            raise TypeError(f"no bound at {value}")
        return repr(value)
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    raise TypeError(f"no bounds over values of type {type(value).__name__}")


def quantile_predicates(column: str, bounds: Sequence[object]) -> list[str]:
    """WHERE clauses, one per task, that hold every row exactly once.

    ``bounds`` are the first values of equal shares, in any order. A value that
    fills several shares comes several times; it gets a task of its own, so
    that a hot value and the range behind it do not meet in one task. NULL
    goes with the first range, and so do values below the smallest bound, as
    rows may have come since.
    """
    times = Counter(bounds)
    cuts = sorted(times)
    if not cuts:
        return ["1 = 1"]
    out = []
    for i, cut in enumerate(cuts):
        upper = [f"{column} < {literal(cuts[i + 1])}"] if i + 1 < len(cuts) else []
        if times[cut] > 1:
            out.append(f"{column} = {literal(cut)}")
            out.append(" AND ".join([f"{column} > {literal(cut)}", *upper]))
        else:
            out.append(" AND ".join([f"{column} >= {literal(cut)}", *upper]))
    first = f"{column} < {literal(cuts[0])} OR {column} IS NULL"
    if times[cuts[0]] > 1:
        return [first, *out]
    rest = [f"({out[0]})"] if len(cuts) > 1 else [f"{column} >= {literal(cuts[0])}"]
    return [" OR ".join([first, *rest]), *out[1:]]


def jdbc_quantiles(spark: SparkSession, conn: JdbcConnection, table: str, column: str, parts: int) -> list[str]:
    """``predicates`` for ``read_jdbc`` that give each task about the same
    number of rows. The database finds the bounds in one query; ``parts``
    values come back to the driver."""
    rows = read_jdbc(spark, conn, query=quantile_query(table, column, parts)).collect()
    return quantile_predicates(column, [r[0] for r in rows])
