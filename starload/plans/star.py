"""The reference's data products as plans: the five-table bank star (M1-M6),
the query-to-table step (M7) and the single comprehensive table (M8)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starload.functions.columns import quoted, sql_type
from starload.operators.conform import conform, subset_schema
from starload.operators.dimensional import StarSpec
from starload.operators.relational import Parent, RelationalSpec
from starload.schemas import FDIC_BANKS

# Output tables of the bank star and their columns, in the
# order the original loader selects them. Natural keys only; the fact keeps
# ``city`` but not ``state_name``.
BANK_STAR = StarSpec(
    dimensions={
        "bank_dimension_table": [
            "fdic_certificate_number", "institution_name", "address", "city", "state_name",
            "zip_code", "bank_charter_class", "occ_charter", "chartering_agency",
            "federal_charter", "fdic_field_office",
        ],
        "state_dimension_table": ["state_name", "state_fips_code"],
        "city_dimension_table": ["city", "state_name"],
        "chartering_agency_dimension_table": ["chartering_agency"],
    },
    facts={
        "fact_table": [
            "fdic_certificate_number", "total_assets", "total_deposits", "equity_capital",
            "net_income", "return_on_assets", "return_on_equity", "state_fips_code", "city",
            "chartering_agency", "effective_date",
        ],
    },
)


# Relational modelling of the same base (our design; the original names the
# table kind only). Each parent is keyed by a hash over all of its columns,
# so a key identifies exactly one parent row; the institution table keeps
# every column that no parent holds and one foreign key per parent, so that
# joining the parents back gives the base.
_PARENTS = [
    Parent(name="state_table", key="state_key", natural_key=["state_name", "state_fips_code"]),
    Parent(name="city_table", key="city_key", natural_key=["city", "state_name"]),
    Parent(name="chartering_agency_table", key="chartering_agency_key",
           natural_key=["chartering_agency"]),
]
_HELD = {c for p in _PARENTS for c in p.natural_key}
BANK_RELATIONAL = RelationalSpec(
    child="institution_table",
    child_columns=[c for c in FDIC_BANKS.names if c not in _HELD],
    parents=_PARENTS,
)

# The same as a snowflake: a city's row holds its state's key, and an
# institution's row the city's alone.
BANK_SNOWFLAKE = RelationalSpec(
    child=BANK_RELATIONAL.child,
    child_columns=BANK_RELATIONAL.child_columns,
    parents=[replace(p, references="state_table") if p.name == "city_table" else p for p in _PARENTS],
)


def type_declared(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Cast the columns ``schema`` declares to their declared types, keeping
    the frame's own column order and any undeclared column as it is."""
    declared = {c: f.dataType for f in subset_schema(schema, df.columns).fields
                for c in df.columns if c.lower() == f.name.lower()}
    cast = "cast" if strict else "try_cast"
    exprs = []
    for f in df.schema.fields:
        t = declared.get(f.name)
        c = quoted(f.name)
        exprs.append(c if t is None or t == f.dataType else f"{cast}({c} AS {sql_type(t)}) AS {c}")
    return df.selectExpr(*exprs)


def query_to_table(spark: SparkSession, sql: str, sink: Callable[..., object], table: str,
                   schema: T.StructType | None = None, strict: bool = False, **frames: DataFrame) -> object:
    """Run Spark SQL and hand the result to ``sink`` as ``table``.

    Frames are bound by name (``{base}`` in the text), so no global view is
    registered. Result columns keep select-list order; those the base schema
    declares get their declared type. A trailing ``;`` is accepted.
    """
    df = spark.sql(sql.strip().rstrip(";"), **frames) if frames else spark.sql(sql.strip().rstrip(";"))
    if schema is not None:
        df = type_declared(df, schema, strict)
    return sink(df, table)


def single_table(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """The comprehensive table: the whole base conformed to its declared schema."""
    return conform(df, schema, strict=strict)
