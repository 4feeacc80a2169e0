"""starload: load a wide source table into analytical tables on Spark.

Sources (Parquet, CSV, JDBC, any Spark data source) -> schema conform ->
Kimball dimensions and facts, one comprehensive table, normalised relational
tables -> sinks (Parquet, CSV, JDBC). Every function takes and returns
DataFrames on the caller's session; only sinks run jobs.
"""

from starload.functions.columns import hash_key, hash_key_sql
from starload.operators.conform import Rejects, conform, rejected_rows, select_in_schema_order, subset_schema
from starload.operators.dimensional import Star, StarSpec, build_star, dimension, fact, run_star
from starload.operators.relational import (Parent, RelationalSpec, build_relational, child_table, joined_back,
                                          parent_table, relational)
from starload.operators.sharing import SHARE_MODES, Outputs, resolve_share, share_base, write_outputs
from starload.plans.flows import extract_load, load_all, star_load
from starload.plans.star import BANK_RELATIONAL, BANK_SNOWFLAKE, BANK_STAR, query_to_table, single_table, type_declared
from starload.schemas import EXAMPLE, FDIC_BANKS, SCHEMAS, get_schema, register_schema, sql_types
from starload.session import scratch_path, shared_dir
from starload.sinks.files import FileSink, assert_not_reading, csv_sink, parquet_sink, rebalance, write_csv, write_parquet
from starload.sinks.store import CommitConflict, Snapshot, StoreSink, TableStore
from starload.sinks.tables import new_members, write_tables
from starload.sinks.jdbc import create_table_column_types, jdbc_sink, write_jdbc
from starload.sources.files import read_csv, read_parquet, table_path
from starload.sources.generic import capped, load_base, read_source
from starload.sources.jdbc import JdbcConnection, JdbcPartitioning, jdbc_partitioning, jdbc_quantiles, read_jdbc

__all__ = [
    "BANK_RELATIONAL", "BANK_SNOWFLAKE", "BANK_STAR", "CommitConflict", "EXAMPLE", "FDIC_BANKS", "FileSink", "JdbcConnection", "JdbcPartitioning",
    "Outputs", "Parent", "Rejects", "RelationalSpec", "SCHEMAS", "SHARE_MODES", "Snapshot", "Star", "StarSpec",
    "StoreSink", "TableStore",
    "assert_not_reading", "build_relational", "build_star", "capped", "child_table", "conform",
    "create_table_column_types", "csv_sink", "dimension", "extract_load",
    "fact", "get_schema", "hash_key", "hash_key_sql", "jdbc_partitioning", "jdbc_quantiles", "jdbc_sink", "joined_back", "load_all", "load_base",
    "new_members", "parent_table", "parquet_sink", "query_to_table", "read_csv", "read_jdbc", "read_parquet",
    "read_source", "rebalance", "register_schema", "rejected_rows", "relational", "resolve_share", "run_star",
    "scratch_path", "select_in_schema_order", "share_base", "shared_dir", "single_table",
    "sql_types", "star_load", "subset_schema", "table_path", "type_declared", "write_csv",
    "write_jdbc", "write_outputs", "write_parquet", "write_tables",
]
