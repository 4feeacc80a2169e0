"""JDBC sink (W5) with typed table creation (W6).

The table is created by Spark's JDBC writer, with the declared column types
passed as ``createTableColumnTypes`` (identifiers are quoted by the
database's dialect, so names with spaces work). Overwrite uses ``truncate``,
which keeps an existing table and its declared types instead of dropping
and re-creating it with default types. ``num_partitions`` caps the number
of concurrent connections; every executor task writes its own rows in
batches, nothing passes through the driver.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from starload.functions.columns import quoted
from starload.operators.conform import conform
from starload.schemas import sql_types
from starload.session import _context
from starload.sources.inputs import jdbc_tables
from starload.sources.jdbc import JdbcConnection


def create_table_column_types(schema: T.StructType, lengths: Mapping[str, int] | None = None) -> str:
    """``createTableColumnTypes`` for a schema: bounded strings only.

    Spark's writer rejects a bare ``VARCHAR``; other columns are left to the
    dialect's default mapping (unbounded text, BOOLEAN, REAL...).
    """
    types = sql_types(schema, lengths)
    return ", ".join(f"{quoted(n)} {t}" for n, t in types.items()
                     if t.startswith("VARCHAR(") and n in (lengths or {}))


def jdbc_write_options(conn: JdbcConnection, table: str, schema: T.StructType | None = None,
                       lengths: Mapping[str, int] | None = None, mode: str = "overwrite",
                       num_partitions: int | None = None, batch_size: int = 10_000,
                       truncate: bool = True) -> dict[str, str]:
    opts = {**conn.options(), "dbtable": table, "batchsize": str(batch_size)}
    if schema is not None:
        types = create_table_column_types(schema, lengths)
        if types:
            opts["createTableColumnTypes"] = types
    if mode == "overwrite" and truncate:
        opts["truncate"] = "true"
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    return opts


def assert_table_not_read(read: set[tuple[str, str]], url: str, table: str) -> None:
    """Refuse to overwrite a table that is among those read as (url, table or
    query): the database clears it before the first row is read. Names are
    compared without quotes and case; a query that names the table counts."""
    def bare(name: str) -> str:
        return name.replace('"', "").replace("`", "").lower().strip()

    for source_url, source in read:
        text = bare(source)
        named = text == bare(table) or (" " in text and bare(table) in re.split(r"[\s,()]+", text))
        if source_url == url and named:
            raise ValueError(f"refusing to overwrite {table}: the frame reads from it")


def write_jdbc(df: DataFrame, conn: JdbcConnection, table: str, mode: str = "overwrite",
               schema: T.StructType | None = None, lengths: Mapping[str, int] | None = None,
               num_partitions: int | None = None, batch_size: int = 10_000,
               truncate: bool = True, strict: bool = False) -> None:
    """Write all rows of ``df`` to ``table``; with ``schema``, conform first
    and create the table with the declared column types. Overwriting a table
    that the frame reads at the same url is refused."""
    if mode == "overwrite" and _context(df.sparkSession) is not None:
        assert_table_not_read(jdbc_tables(df), conn.url, table)
    if schema is not None:
        df = conform(df, schema, strict=strict)
    elif lengths:
        schema = df.schema
    opts = jdbc_write_options(conn, table, schema, lengths, mode, num_partitions, batch_size, truncate)
    df.write.format("jdbc").options(**opts).mode(mode).save()


def jdbc_sink(conn: JdbcConnection, mode: str = "overwrite", lengths: Mapping[str, int] | None = None,
              num_partitions: int | None = None, strict: bool = False):
    """A ``sink(frame, table, schema=None)`` writing to ``conn``."""
    def sink(df: DataFrame, table: str, schema: T.StructType | None = None) -> str:
        write_jdbc(df, conn, table, mode=mode, schema=schema, lengths=lengths,
                   num_partitions=num_partitions, strict=strict)
        return table
    sink.mode = mode
    return sink
