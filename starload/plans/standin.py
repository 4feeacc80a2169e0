"""A stand-in base table built from the TPC-H-style test tables.

``standin_base`` is one row per order with its customer, nation and region
(orders ⋈ customer ⋈ nation ⋈ region). The join strategy is Catalyst's:
nation and region are broadcast when their size estimate is under the
broadcast threshold; orders ⋈ customer is a sort-merge join on the customer
key at scale, where adaptive execution splits a customer that owns a large
share of all orders. ``bank_base`` maps it onto the declared 121-column bank
schema so the bank star runs unchanged over the whole test data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.operators.conform import conform
from starload.operators.dimensional import StarSpec
from starload.operators.relational import Parent, RelationalSpec
from starload.schemas import FDIC_BANKS
from starload.session import _context
from starload.sources.files import read_parquet, table_path

STANDIN_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()),
    T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()),
    T.StructField("o_orderstatus", T.StringType()),
    T.StructField("o_orderpriority", T.StringType()),
    T.StructField("c_custkey", T.LongType()),
    T.StructField("c_name", T.StringType()),
    T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType()),
    T.StructField("n_nationkey", T.IntegerType()),
    T.StructField("n_name", T.StringType()),
    T.StructField("r_name", T.StringType()),
])

# Declared schemas of the test tables the stand-in reads: reading with them
# skips Parquet schema inference (one Spark job per table otherwise).
TABLE_SCHEMAS = {
    "orders": T.StructType([
        T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()), T.StructField("o_orderpriority", T.StringType())]),
    "customer": T.StructType([
        T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType())]),
    "nation": T.StructType([
        T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType()),
        T.StructField("n_regionkey", T.IntegerType())]),
    "region": T.StructType([
        T.StructField("r_regionkey", T.IntegerType()), T.StructField("r_name", T.StringType())]),
    "supplier": T.StructType([
        T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()),
        T.StructField("s_nationkey", T.IntegerType()), T.StructField("s_acctbal", T.DoubleType())]),
}

STANDIN_STAR = StarSpec(
    dimensions={
        "dim_entity": ["c_custkey", "c_name", "c_mktsegment", "n_name", "r_name"],
        "dim_code_name": ["n_name", "n_nationkey"],
        "dim_pair": ["o_orderpriority", "r_name"],
        "dim_single": ["c_mktsegment"],
    },
    facts={
        "fact": ["c_custkey", "o_totalprice", "c_acctbal", "n_nationkey", "o_orderpriority",
                 "c_mktsegment", "o_orderdate"],
    },
)

#: Tasks for each slot, over which wide rows are dealt.
WAVES = 3

# Bank-schema column <- SQL expression over the stand-in base, for the columns
# of the star. The i-th declared column follows ``_filler`` otherwise, so no two
# columns are alike and none is NULL throughout.
_STAR_COLUMNS = {
    "fdic_certificate_number": "c_custkey",
    "institution_name": "c_name",
    "fdic_id": "o_orderkey",
    "state_name": "CASE WHEN n_nationkey = 3 THEN NULL ELSE n_name END",
    "state_fips_code": "CASE WHEN n_nationkey = 4 THEN NULL ELSE n_nationkey END",
    "city": "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END",
    "bank_charter_class": "o_orderstatus",
    "chartering_agency": "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END",
    "federal_charter": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus = 'F' END",
    "total_assets": "o_totalprice",
    "equity_capital": "c_acctbal",
    "effective_date": "o_orderdate",
    "address": "concat(c_custkey % 97, ' ', r_name)",
    "zip_code": "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_custkey % 1000 END",
    "occ_charter": "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey * 2 END",
    "fdic_field_office": "r_name",
    "total_deposits": "concat('D', o_orderkey % 1009)",
    "net_income": "concat('N', o_orderkey % 499)",
    "return_on_assets": "concat('A', o_orderkey % 251)",
    "return_on_equity": "concat('E', o_orderkey % 241)",
}


def _filler(i: int, kind: str) -> str:
    if kind == "boolean":
        return f"CASE WHEN o_orderkey % {7 + i} < 2 THEN NULL ELSE o_orderkey % {7 + i} % 2 = 0 END"
    return f"CASE WHEN o_orderkey % {3 + i} = 0 THEN NULL ELSE {_numbered(f'{i}-', 13 + i)} END"


def _numbered(prefix: str, modulus: int) -> str:
    """``concat(prefix, o_orderkey % modulus)``, whose few texts are made once
    for the plan and not for each row: remainders run from 1 - modulus."""
    texts = " ".join(f"{prefix}{r}" for r in range(1 - modulus, modulus))
    return f"get(split('{texts}', ' '), CAST(o_orderkey % {modulus} AS INT) + {modulus - 1})"


BANK_FROM_STANDIN = {
    f.name: _STAR_COLUMNS.get(f.name) or _filler(i, f.dataType.typeName())
    for i, f in enumerate(FDIC_BANKS.fields)
}

CUSTOMER_RELATIONAL = RelationalSpec(
    child="customer_rel",
    child_columns=["c_custkey"],
    parents=[Parent(name="segment_nation", key="k", natural_key=["c_mktsegment", "c_nationkey"])],
)


def _slots(df: DataFrame) -> int:
    """Tasks that the cluster runs at once, or the shuffle's partitions where
    the driver's context is out of reach (Spark Connect)."""
    sc = _context(df.sparkSession)
    return sc.defaultParallelism if sc is not None else int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, read with its declared schema when there is one."""
    return read_parquet(spark, table_path(sf_dir, f"{name}.parquet"), TABLE_SCHEMAS.get(name))


def standin_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with customer, nation and region columns."""
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    w = (o.join(c, o.o_custkey == c.c_custkey)
          .join(n, c.c_nationkey == n.n_nationkey)
          .join(r, n.n_regionkey == r.r_regionkey))
    return w.select(*[f.name for f in STANDIN_SCHEMA.fields])


def bank_base(standin: DataFrame, dealt: bool = False) -> DataFrame:
    """The stand-in base as a 121-column bank table (strings and booleans).

    ``dealt`` is for uses of all columns: the narrow rows are dealt evenly
    among the tasks first, so that the work of making, hashing and encoding
    the wide ones does not hang on how few splits or join partitions the
    narrow ones come in."""
    if dealt:
        standin = standin.repartition(WAVES * _slots(standin))
    mapped = standin.select(*[F.expr(e).alias(n) for n, e in BANK_FROM_STANDIN.items()])
    return conform(mapped, FDIC_BANKS)
