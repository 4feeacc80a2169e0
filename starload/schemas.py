"""Declared table schemas.

One ``StructType`` per table, registered by name in ``SCHEMAS``. SQL column
types (for typed JDBC tables) are derived from it by ``sql_types`` rather
than declared a second time.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "float": T.FloatType(),
}


def _struct(columns: Iterable[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t], True) for n, t in columns])


# The example table, in declared order (name, type).
EXAMPLE_COLUMNS = [
    ("Country name", "string"),
    ("Series name", "string"),
    ("Value", "float"),
    ("value_percentile", "float"),
]

# The wide base table of bank institutions, 121 columns in
# declared order (name, type); every column nullable.
FDIC_BANKS_COLUMNS = [
    ("fdic_certificate_number", "string"),
    ("institution_name", "string"),
    ("state_name", "string"),
    ("fdic_id", "string"),
    ("docket", "string"),
    ("active", "boolean"),
    ("address", "string"),
    ("total_assets", "string"),
    ("bank_charter_class", "string"),
    ("change_code_1", "string"),
    ("change_code_2", "string"),
    ("change_code_3", "string"),
    ("change_code_4", "string"),
    ("change_code_5", "string"),
    ("change_code_6", "string"),
    ("change_code_7", "string"),
    ("change_code_8", "string"),
    ("change_code_9", "string"),
    ("change_code_10", "string"),
    ("change_code_11", "string"),
    ("change_code_12", "string"),
    ("change_code_13", "string"),
    ("change_code_14", "string"),
    ("change_code_15", "string"),
    ("occ_charter", "string"),
    ("chartering_agency", "string"),
    ("conservatorship", "boolean"),
    ("city", "string"),
    ("category_code", "string"),
    ("county_fips_code", "string"),
    ("county_name", "string"),
    ("established_date", "string"),
    ("last_updated", "string"),
    ("effective_date", "string"),
    ("end_effective_date", "string"),
    ("denovo_institute", "string"),
    ("total_deposits", "string"),
    ("equity_capital", "string"),
    ("fdic_geo_region", "string"),
    ("fdic_supervisory_region", "string"),
    ("fdic_supervisory_region_code", "string"),
    ("fed_reserve_district", "string"),
    ("fed_reserve_district_id", "string"),
    ("fed_reserve_unique_id", "string"),
    ("federal_charter", "boolean"),
    ("fdic_field_office", "string"),
    ("iba", "boolean"),
    ("inactive_flag", "boolean"),
    ("insurance_fund_membership", "string"),
    ("secondary_insurance_fund", "string"),
    ("deposit_insurance_date", "string"),
    ("credit_card_institution", "string"),
    ("bank_insurance_fund_member", "boolean"),
    ("insured_commercial_bank", "boolean"),
    ("deposit_insurance_fund_member", "boolean"),
    ("fdic_insured", "boolean"),
    ("saif_insured", "boolean"),
    ("insured_savings_institute", "boolean"),
    ("new_cert_number", "string"),
    ("oakar_institute", "boolean"),
    ("ots_region", "string"),
    ("last_structural_change", "string"),
    ("qbp_region", "string"),
    ("regulator", "string"),
    ("report_date", "string"),
    ("reporting_period_end_date", "string"),
    ("state_chartered", "boolean"),
    ("return_on_assets", "string"),
    ("roa_quarterly", "string"),
    ("roa_pretax", "string"),
    ("row_pretax_quarterly", "string"),
    ("return_on_equity", "string"),
    ("roe_quarterly", "string"),
    ("run_date", "string"),
    ("sasser_institute", "boolean"),
    ("law_sasser", "boolean"),
    ("state", "string"),
    ("state_fips_code", "string"),
    ("trade_name_1", "string"),
    ("trade_name_2", "string"),
    ("trade_name_3", "string"),
    ("trade_name_4", "string"),
    ("trade_name_5", "string"),
    ("trade_name_6", "string"),
    ("zip_code", "string"),
    ("occ_district", "string"),
    ("ultimate_cert_number", "string"),
    ("cfpb_supervisory_flag", "boolean"),
    ("cfpb_supervisory_start_date", "string"),
    ("cfpb_supervisory_end_date", "string"),
    ("offices_count", "string"),
    ("parent_fdic_cert", "string"),
    ("parent_parcert", "string"),
    ("high_holder_city", "string"),
    ("total_domestic_deposits", "string"),
    ("ffiec_call_report_filer", "string"),
    ("holding_company_flag", "string"),
    ("ag_lending_flag", "string"),
    ("ownership_type", "string"),
    ("top_holder", "string"),
    ("net_income", "string"),
    ("quarterly_net_income", "string"),
    ("office_count_domestic", "string"),
    ("office_count_foreign", "string"),
    ("office_count_us_territories", "string"),
    ("rssd_id", "string"),
    ("holding_company_state", "string"),
    ("subchap_s_indicator", "string"),
    ("trust_powers_status", "string"),
    ("asset_concentration_hierarchy", "string"),
    ("primary_specialization", "string"),
    ("csa_name", "string"),
    ("csa_fips_code", "string"),
    ("csa_indicator", "boolean"),
    ("cbsa_name", "string"),
    ("cbsa_fips_code", "string"),
    ("cbsa_metro_flag", "boolean"),
    ("cbsa_micro_flag", "boolean"),
    ("cbsa_division_name", "string"),
    ("cbsa_division_fips_code", "string"),
    ("cbsa_division_flag", "boolean"),
]

EXAMPLE = _struct(EXAMPLE_COLUMNS)
FDIC_BANKS = _struct(FDIC_BANKS_COLUMNS)

SCHEMAS: dict[str, T.StructType] = {
    "example": EXAMPLE,
    "fdic_banks": FDIC_BANKS,
}


def get_schema(name: str) -> T.StructType:
    """Look a declared schema up by table name."""
    try:
        return SCHEMAS[name]
    except KeyError:
        raise KeyError(f"no declared schema for table {name!r}; known: {sorted(SCHEMAS)}") from None


def register_schema(name: str, schema: T.StructType) -> None:
    SCHEMAS[name] = schema


_SQL = {
    T.StringType: "VARCHAR",
    T.BooleanType: "BOOLEAN",
    T.FloatType: "REAL",
    T.DoubleType: "DOUBLE PRECISION",
    T.IntegerType: "INTEGER",
    T.LongType: "BIGINT",
    T.ShortType: "SMALLINT",
    T.DateType: "DATE",
    T.TimestampType: "TIMESTAMP",
    T.TimestampNTZType: "TIMESTAMP",
}


def sql_types(schema: T.StructType, lengths: Mapping[str, int] | None = None) -> dict[str, str]:
    """Column name -> SQL type, in schema order. ``lengths`` bounds strings."""
    lengths = lengths or {}
    out = {}
    for f in schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            out[f.name] = f"DECIMAL({f.dataType.precision},{f.dataType.scale})"
            continue
        base = _SQL.get(type(f.dataType))
        if base is None:
            raise TypeError(f"no SQL type for column {f.name!r} of type {f.dataType.simpleString()}")
        if base == "VARCHAR" and f.name in lengths:
            base = f"VARCHAR({int(lengths[f.name])})"
        out[f.name] = base
    return out
