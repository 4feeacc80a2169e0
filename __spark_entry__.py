"""

Every query reads the driver's test tables at ``sf_dir`` in whole. The star
and relational queries run over the stand-in base (orders ⋈ customer ⋈
nation ⋈ region); the ``ref_*`` queries run the bank star itself over that
base mapped onto the declared 121-column bank schema. Round-trip queries
write into a fresh folder under the session's ``spark.checkpoint.dir`` and
return what they read back.

JDBC queries are not registered: checking them needs a database, and none
may be started here (see README).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.operators.conform import Rejects, conform, select_in_schema_order, subset_schema
from starload.operators.dimensional import build_star, dimension
from starload.operators.relational import joined_back, parents_kept, relational
from starload.plans.standin import (CUSTOMER_RELATIONAL, STANDIN_SCHEMA, STANDIN_STAR, bank_base,
                                    read_table, standin_base)
from starload.plans.flows import extract_load, load_all, star_load
from starload.plans.star import BANK_RELATIONAL, BANK_SNOWFLAKE, BANK_STAR, query_to_table, single_table
from starload.schemas import EXAMPLE, FDIC_BANKS
from starload.session import scratch_path
from starload.sinks.files import csv_sink, parquet_sink, write_csv, write_parquet
from starload.sinks.store import TableStore
from starload.sources.files import read_csv, read_parquet, table_path
from starload.sources.generic import load_base, read_source

try:  # the training-data operators are a part that may be taken out
    import corpus_pipeline
    from starload.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith(("starload.llm", "corpus_pipeline")):
        raise
    corpus_pipeline = llm_queries = None

SF_SMOKE = "/root/testdata/sf0.001"

CUSTOMER_CONFORMED = T.StructType([
    T.StructField("c_custkey", T.StringType()),
    T.StructField("c_name", T.StringType()),
    T.StructField("active", T.BooleanType()),
    T.StructField("c_acctbal", T.FloatType()),
])
CUSTOMER_DECLARED = T.StructType([
    T.StructField("c_custkey", T.LongType()),
    T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()),
    T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType()),
])
ORDERS_INGEST = T.StructType([
    T.StructField("o_orderkey", T.LongType()),
    T.StructField("o_custkey", T.StringType()),
    T.StructField("o_orderdate", T.StringType()),
    T.StructField("o_totalprice", T.DoubleType()),
])
SUPPLIER_DECLARED = T.StructType([
    T.StructField("s_suppkey", T.LongType()),
    T.StructField("s_name", T.StringType()),
    T.StructField("s_nationkey", T.IntegerType()),
    T.StructField("s_acctbal", T.DoubleType()),
])
ROW_CAP = 100


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the fact table of the bank star over the sf0.001 stand-in base."""
    star = build_star(bank_base(standin_base(spark, SF_SMOKE)), BANK_STAR, share="none")
    return star["fact_table"]


# ---------------------------------------------------------------- star (stand-in)

def _star_output(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build_star(standin_base(spark, sf_dir), STANDIN_STAR, share="none")[name]
    return q


def _bank_output(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build_star(bank_base(standin_base(spark, sf_dir)), BANK_STAR, share="none")[name]
    return q


def q_single_table(spark, sf_dir):
    return single_table(standin_base(spark, sf_dir), STANDIN_SCHEMA)


def q_ref_single_table(spark, sf_dir):
    return single_table(bank_base(standin_base(spark, sf_dir)), FDIC_BANKS)


def _bank_relational(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return relational(bank_base(standin_base(spark, sf_dir)), BANK_RELATIONAL)[name]
    return q


def q_ref_extract_load(spark, sf_dir):
    """The bank-shaped stand-in written as a source table, then extracted
    through the generic source reader, bound to the schema declared under the
    table's name and loaded as the single comprehensive table."""
    source = scratch_path(spark, "bank_source")
    write_parquet(bank_base(standin_base(spark, sf_dir), dealt=True), source)
    root = scratch_path(spark, "extract_load")
    path = extract_load(spark, "parquet", None, parquet_sink(root), "fdic_banks", path=source, strict=True)
    return read_parquet(spark, path, FDIC_BANKS)


def _load_all(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """Single table, star and relational tables loaded by ``load_all``; one
    table read back."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        paths = load_all(bank_base(standin_base(spark, sf_dir), dealt=True), FDIC_BANKS,
                         parquet_sink(scratch_path(spark, "load_all")), "fdic_banks",
                         star=BANK_STAR, relational=BANK_RELATIONAL)
        return read_parquet(spark, paths[name])
    return q


def _load_all_twice(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """Two loads of the same base, appended; one table read back."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        sink = parquet_sink(scratch_path(spark, "load_all_twice"), mode="append")
        for _ in range(2):
            paths = load_all(bank_base(standin_base(spark, sf_dir), dealt=True), FDIC_BANKS, sink, "fdic_banks",
                             star=BANK_STAR, relational=BANK_RELATIONAL)
        return read_parquet(spark, paths[name])
    return q


def _store_load(store: TableStore, load_id: str, base: DataFrame, breaks_at: str | None = None) -> None:
    """One appended load of all bank tables; with ``breaks_at`` it dies when it comes to that table."""
    def write(sink):
        def until(df, table):
            if table == breaks_at:
                raise InterruptedError(f"stopped at {table}")
            return sink(df, table)
        for attr in ("mode", "existing", "shaped", "rereads", "reread"):
            setattr(until, attr, getattr(sink, attr))
        load_all(base, FDIC_BANKS, until if breaks_at else sink, "fdic_banks", star=BANK_STAR, relational=BANK_RELATIONAL)
    store.load(load_id, write, mode="append")


def _rerun(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """The same load three times: done, then again under its id, then again by
    a store opened anew. It counts once."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_path(spark, "rerun")
        base = bank_base(standin_base(spark, sf_dir), dealt=True)
        for store in [TableStore(spark, root)] * 2 + [TableStore(spark, root)]:
            _store_load(store, "day 1", base)
        return store.read(name)
    return q


def _killed(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """A load, and a second one that dies half-way: readers see the first."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = TableStore(spark, scratch_path(spark, "killed"))
        base = bank_base(standin_base(spark, sf_dir), dealt=True)
        _store_load(store, "day 1", base)
        try:
            _store_load(store, "day 2", base, breaks_at="city_dimension_table")
        except InterruptedError:
            pass
        return store.read(name)
    return q


def _appended(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """Two loads of the same rows under ids of their own, appended to a store."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = TableStore(spark, scratch_path(spark, "appended"))
        for day in ("day 1", "day 2"):
            _store_load(store, day, bank_base(standin_base(spark, sf_dir), dealt=True))
        return store.read(name)
    return q


def q_load_all_csv(spark, sf_dir):
    paths = load_all(bank_base(standin_base(spark, sf_dir), dealt=True), "fdic_banks",
                     csv_sink(scratch_path(spark, "load_all_csv")), "fdic_banks", star=BANK_STAR)
    name = "state_dimension_table"
    return read_csv(spark, paths[name], subset_schema(FDIC_BANKS, BANK_STAR.dimensions[name]))


def _snowflake(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """The snowflake written by ``load_all``; one table read back."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        paths = load_all(bank_base(standin_base(spark, sf_dir), dealt=True), FDIC_BANKS,
                         parquet_sink(scratch_path(spark, "snowflake")), "fdic_banks", star=BANK_STAR,
                         relational=BANK_SNOWFLAKE)
        return read_parquet(spark, paths[name])
    return q


def q_snow_joined_back(spark, sf_dir):
    """The base again, along the chain of keys: institution, city, state."""
    tables = parents_kept(relational(bank_base(standin_base(spark, sf_dir), dealt=True), BANK_SNOWFLAKE), BANK_SNOWFLAKE)
    return joined_back(tables, BANK_SNOWFLAKE).select(*FDIC_BANKS.names)


def q_rel_joined_back(spark, sf_dir):
    """The base again, from the child and its parents."""
    tables = parents_kept(relational(bank_base(standin_base(spark, sf_dir), dealt=True), BANK_RELATIONAL), BANK_RELATIONAL)
    rows = tables[BANK_RELATIONAL.child]
    for p in BANK_RELATIONAL.parents:
        held = [c for c in p.natural_key if c not in rows.columns]
        rows = rows.join(tables[p.name].select(p.key, *held), p.key)
    return rows.select(*FDIC_BANKS.names)


def _written_star(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """The whole bank star loaded by ``star_load`` (staged base, all five
    tables written); one of its tables read back."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        paths = star_load(bank_base(standin_base(spark, sf_dir), dealt=True), BANK_STAR,
                          parquet_sink(scratch_path(spark, "bank_star")))
        return read_parquet(spark, paths[name])
    return q


def q_ref_query_to_table(spark, sf_dir):
    root = scratch_path(spark, "ref_query_to_table")
    columns = ", ".join(BANK_STAR.dimensions["state_dimension_table"])
    sql = f"SELECT {columns} FROM {{base}} GROUP BY ALL"
    path = query_to_table(spark, sql, parquet_sink(root), "state_dimension_table", schema=FDIC_BANKS,
                          base=bank_base(standin_base(spark, sf_dir)))
    return read_parquet(spark, path)


def q_dim_entity_versions(spark, sf_dir):
    return dimension(read_table(spark, sf_dir, "orders"), ["o_custkey", "o_orderstatus"])


def q_query_to_table(spark, sf_dir):
    root = scratch_path(spark, "query_to_table")
    path = query_to_table(spark, "SELECT DISTINCT n_name, n_nationkey FROM {base};",
                          parquet_sink(root), "state_dimension", schema=STANDIN_SCHEMA,
                          base=standin_base(spark, sf_dir))
    return read_parquet(spark, path)


# ---------------------------------------------------------------- conform

def q_conform(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    shuffled = c.select("c_acctbal", "c_mktsegment", "c_name", "c_nationkey", "c_custkey")
    return conform(shuffled, CUSTOMER_CONFORMED)


def q_conform_missing(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return conform(c, CUSTOMER_CONFORMED)


def q_conform_drop(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    extra = c.withColumn("c_extra", F.lit("x"))
    return conform(extra, CUSTOMER_CONFORMED)


def q_conform_cast(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("v"))
    return conform(c, T.StructType([T.StructField("c_custkey", T.LongType()),
                                    T.StructField("v", T.IntegerType())]))


CASTS = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("v", T.IntegerType()),
                      T.StructField("w", T.BooleanType()), T.StructField("absent", T.DateType())])


def _customer_texts(spark, sf_dir):
    """Texts of which some are whole numbers and some are not, some NULL."""
    return read_table(spark, sf_dir, "customer").select(
        "c_custkey", F.expr("CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN c_name "
                            "ELSE CAST(c_custkey AS string) END").alias("v"),
        F.col("c_mktsegment").alias("w"))


def q_conform_cast_rejects(spark, sf_dir):
    """Values that the lenient casts lose, counted by the pass that writes the rows."""
    rejects = Rejects()
    write_parquet(conform(_customer_texts(spark, sf_dir), CASTS, rejects=rejects), scratch_path(spark, "rejects"))
    return rejects.frame(spark)


def q_conform_cast_rejected_rows(spark, sf_dir):
    """The rows that lose a value, as an extract writes them beside its table."""
    source = scratch_path(spark, "rejected_source")
    write_parquet(_customer_texts(spark, sf_dir), source)
    root = scratch_path(spark, "rejected")
    extract_load(spark, "parquet", CASTS, parquet_sink(root), "customers", path=source, rejects=Rejects(),
                 reject_table="customers_rejected")
    rows = read_parquet(spark, table_path(root, "customers_rejected"))
    return rows.select("c_custkey", "v", "w", F.array_join("rejected", ",").alias("rejected"))


def q_typed_ingest(spark, sf_dir):
    src = read_source(spark, "parquet", path=table_path(sf_dir, "orders.parquet"))
    return load_base(src, ORDERS_INGEST)


def _customer_as_example(spark, sf_dir):
    """Customer rows under the example table's names (spaces in two of them)."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(F.col("c_mktsegment").alias("Country name"), F.col("c_name").alias("Series name"),
                    F.col("c_acctbal").alias("Value"))


def q_example_conform(spark, sf_dir):
    return conform(_customer_as_example(spark, sf_dir), EXAMPLE)


def q_example_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "example_csv")
    write_csv(_customer_as_example(spark, sf_dir), path, schema=EXAMPLE)
    return read_csv(spark, path, EXAMPLE)


def q_example_partitioned(spark, sf_dir):
    path = scratch_path(spark, "example_partitioned")
    write_parquet(_customer_as_example(spark, sf_dir), path, schema=EXAMPLE, partition_by=["Country name"])
    return read_parquet(spark, path, EXAMPLE)


def q_csv_types_roundtrip(spark, sf_dir):
    """Types whose text form could lose digits, written as CSV and read back."""
    o = read_table(spark, sf_dir, "orders")
    def micro(n):
        return F.expr(f"o_orderdate + make_dt_interval(0, 0, 0, cast((o_orderkey % {n}) / 1000000 as decimal(18, 6)))")
    df = o.select("o_orderkey", micro(1000003).alias("at_time"), micro(999983).cast("timestamp").alias("instant"),
                  F.col("o_orderdate").cast("date").alias("day"), F.col("o_totalprice").cast("decimal(18,3)").alias("price"),
                  (F.col("o_orderkey") % 2 == 0).alias("even"))
    path = scratch_path(spark, "csv_types")
    write_csv(df, path)
    return read_csv(spark, path, df.schema).withColumn("instant", F.unix_micros("instant"))


def q_csv_lines_roundtrip(spark, sf_dir):
    """Texts full of line breaks and backslashes, one line a record, read by as many tasks as the file asks for."""
    c = read_table(spark, sf_dir, "customer")
    text = F.concat("c_name", F.lit("\r\n"), F.repeat(F.lit("\\"), (F.col("c_custkey") % 5).cast("int")), F.lit("n\n\\N,\""),
                    F.when(F.col("c_custkey") % 13 != 0, F.col("c_mktsegment")))
    path = scratch_path(spark, "csv_lines")
    df = c.select("c_custkey", text.alias("text"), F.when(F.col("c_custkey") % 3 == 0, F.lit("\\N")).otherwise("").alias("mark"))
    write_csv(df, path, line_breaks="escaped")
    return read_csv(spark, path, df.schema, line_breaks="escaped")


def q_schema_subset(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer").select("c_mktsegment", "c_custkey")
    return select_in_schema_order(c, CUSTOMER_DECLARED)


# ---------------------------------------------------------------- sources and sinks

def q_parquet_scan(spark, sf_dir):
    return read_parquet(spark, table_path(sf_dir, "supplier.parquet"), SUPPLIER_DECLARED)


def q_source_scan(spark, sf_dir):
    return read_source(spark, "parquet", path=table_path(sf_dir, "supplier.parquet"))


def _source_format(fmt: str, options: dict[str, str] | None = None) -> Callable[[SparkSession, str], DataFrame]:
    """A source of another format, extracted and bound to its declared schema."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = scratch_path(spark, f"source_{fmt}")
        read_table(spark, sf_dir, "supplier").write.format(fmt).options(**(options or {})).save(source)
        path = extract_load(spark, fmt, SUPPLIER_DECLARED, parquet_sink(scratch_path(spark, f"from_{fmt}")), "supplier",
                            options=options, path=source, strict=True)
        return read_parquet(spark, path, SUPPLIER_DECLARED)
    return q


def q_row_cap_formats(spark, sf_dir):
    """Rows kept and rows of the source, for caps below, at and beyond its size, in several formats and files."""
    orders = read_table(spark, sf_dir, "orders").repartition(7)
    total, parts = orders.count(), []
    for fmt in ("parquet", "orc", "json", "csv"):
        path = scratch_path(spark, f"row_cap_{fmt}")
        orders.write.format(fmt).save(path)
        for cap in (0, 1, ROW_CAP, total // 2, total, total + 1):
            kept = read_source(spark, fmt, path=path, row_cap=cap)
            parts.append(kept.agg(F.count(F.struct(*kept.columns)).alias("kept")).select(
                F.lit(fmt).alias("format"), F.lit(cap).cast("long").alias("cap"), "kept"))
    return reduce(DataFrame.unionByName, parts)


def q_parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "parquet_roundtrip")
    write_parquet(read_table(spark, sf_dir, "supplier"), path, schema=SUPPLIER_DECLARED)
    return read_parquet(spark, path, SUPPLIER_DECLARED)


def q_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv_roundtrip")
    write_csv(read_table(spark, sf_dir, "supplier"), path, schema=SUPPLIER_DECLARED)
    return read_csv(spark, path, SUPPLIER_DECLARED)


def q_parquet_partitioned(spark, sf_dir):
    path = scratch_path(spark, "parquet_partitioned")
    write_parquet(standin_base(spark, sf_dir), path, schema=STANDIN_SCHEMA,
                  partition_by=["r_name", "o_orderpriority"])
    return read_parquet(spark, path, STANDIN_SCHEMA)


def q_parquet_append(spark, sf_dir):
    path = scratch_path(spark, "parquet_append")
    supplier = read_table(spark, sf_dir, "supplier")
    write_parquet(supplier, path, schema=SUPPLIER_DECLARED, mode="overwrite")
    write_parquet(supplier, path, schema=SUPPLIER_DECLARED, mode="append")
    return read_parquet(spark, path, SUPPLIER_DECLARED)


def q_row_cap(spark, sf_dir):
    path = table_path(sf_dir, "customer.parquet")
    whole = read_source(spark, "parquet", path=path).select(F.lit(False).alias("capped"))
    capped = read_source(spark, "parquet", path=path, row_cap=ROW_CAP).select(F.lit(True).alias("capped"))
    both = whole.unionByName(capped)
    return both.agg(F.count(F.when(F.col("capped"), 1)).alias("n"),
                    F.count(F.when(~F.col("capped"), 1)).alias("m"))


# ---------------------------------------------------------------- relational

def q_rel_parent(spark, sf_dir):
    return relational(read_table(spark, sf_dir, "customer"), CUSTOMER_RELATIONAL)["segment_nation"]


def q_rel_child(spark, sf_dir):
    return relational(read_table(spark, sf_dir, "customer"), CUSTOMER_RELATIONAL)["customer_rel"]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    qs: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "single_table": q_single_table,
        "dim_entity": _star_output("dim_entity"),
        "dim_entity_versions": q_dim_entity_versions,
        "dim_code_name": _star_output("dim_code_name"),
        "dim_pair": _star_output("dim_pair"),
        "dim_single": _star_output("dim_single"),
        "fact": _star_output("fact"),
        "query_to_table": q_query_to_table,
        "conform": q_conform,
        "conform_missing": q_conform_missing,
        "conform_drop": q_conform_drop,
        "conform_cast": q_conform_cast,
        "conform_cast_rejects": q_conform_cast_rejects,
        "conform_cast_rejected_rows": q_conform_cast_rejected_rows,
        "source_scan_orc": _source_format("orc"),
        "source_scan_json": _source_format("json"),
        "source_scan_csv": _source_format("csv", {"header": "true"}),
        "row_cap_formats": q_row_cap_formats,
        "typed_ingest": q_typed_ingest,
        "schema_subset": q_schema_subset,
        "example_conform": q_example_conform,
        "example_csv_roundtrip": q_example_csv_roundtrip,
        "parquet_scan": q_parquet_scan,
        "source_scan": q_source_scan,
        "parquet_roundtrip": q_parquet_roundtrip,
        "csv_roundtrip": q_csv_roundtrip,
        "parquet_partitioned": q_parquet_partitioned,
        "parquet_append": q_parquet_append,
        "row_cap": q_row_cap,
        "rel_parent": q_rel_parent,
        "rel_child": q_rel_child,
        "ref_single_table": q_ref_single_table,
    }
    for name in BANK_STAR.tables():
        qs[f"ref_{name}"] = _bank_output(name)
    qs["ref_query_to_table"] = q_ref_query_to_table
    qs["ref_extract_load"] = q_ref_extract_load
    qs["ref_written_fact_table"] = _written_star("fact_table")
    qs["ref_written_bank_dimension_table"] = _written_star("bank_dimension_table")
    for name in ("city_dimension_table", "chartering_agency_dimension_table"):  # derived from the bank dimension
        qs[f"ref_written_{name}"] = _written_star(name)
    qs["ref_load_all_city_table"] = _load_all("city_table")
    qs["ref_load_all_rerun_fact_table"] = _rerun("fact_table")
    qs["ref_load_all_killed_fact_table"] = _killed("fact_table")
    qs["ref_load_all_appended_fact_table"] = _appended("fact_table")
    qs["ref_load_all_appended_city_dimension_table"] = _appended("city_dimension_table")
    qs["ref_load_all_fact_table"] = _load_all("fact_table")
    qs["ref_load_all_institution_table"] = _load_all("institution_table")
    qs["ref_load_all_twice_fact_table"] = _load_all_twice("fact_table")
    qs["ref_load_all_twice_state_dimension_table"] = _load_all_twice("state_dimension_table")
    qs["ref_load_all_csv_state_dimension_table"] = q_load_all_csv
    qs["ref_rel_joined_back"] = q_rel_joined_back
    qs["ref_snow_joined_back"] = q_snow_joined_back
    for name in ("city_table", "institution_table"):
        qs[f"ref_snow_{name}"] = _snowflake(name)
    qs["csv_lines_roundtrip"] = q_csv_lines_roundtrip
    qs["example_partitioned"] = q_example_partitioned
    qs["csv_types_roundtrip"] = q_csv_types_roundtrip
    for p in BANK_RELATIONAL.parents:
        qs[f"ref_rel_{p.name}"] = _bank_relational(p.name)
    qs[f"ref_rel_{BANK_RELATIONAL.child}"] = _bank_relational(BANK_RELATIONAL.child)
    if llm_queries:
        qs |= {"pipeline": corpus_pipeline.run, **llm_queries.QUERIES}
    return qs


# ---------------------------------------------------------------- oracle SQL

W_CTE = """with w as (
  select o.o_orderkey, o.o_totalprice, o.o_orderdate, o.o_orderstatus, o.o_orderpriority,
         c.c_custkey, c.c_name, c.c_acctbal, c.c_mktsegment,
         n.n_nationkey, n.n_name, r.r_name
  from orders o
  join customer c on o.o_custkey = c.c_custkey
  join nation n on c.c_nationkey = n.n_nationkey
  join region r on n.n_regionkey = r.r_regionkey
)"""

# The declared columns of the bank table, in order; booleans end in "?".
BANK_COLUMNS = """
    fdic_certificate_number institution_name state_name fdic_id docket active? address total_assets
    bank_charter_class change_code_1 change_code_2 change_code_3 change_code_4 change_code_5 change_code_6
    change_code_7 change_code_8 change_code_9 change_code_10 change_code_11 change_code_12 change_code_13
    change_code_14 change_code_15 occ_charter chartering_agency conservatorship? city category_code
    county_fips_code county_name established_date last_updated effective_date end_effective_date
    denovo_institute total_deposits equity_capital fdic_geo_region fdic_supervisory_region
    fdic_supervisory_region_code fed_reserve_district fed_reserve_district_id fed_reserve_unique_id
    federal_charter? fdic_field_office iba? inactive_flag? insurance_fund_membership
    secondary_insurance_fund deposit_insurance_date credit_card_institution bank_insurance_fund_member?
    insured_commercial_bank? deposit_insurance_fund_member? fdic_insured? saif_insured?
    insured_savings_institute? new_cert_number oakar_institute? ots_region last_structural_change qbp_region
    regulator report_date reporting_period_end_date state_chartered? return_on_assets roa_quarterly
    roa_pretax row_pretax_quarterly return_on_equity roe_quarterly run_date sasser_institute? law_sasser?
    state state_fips_code trade_name_1 trade_name_2 trade_name_3 trade_name_4 trade_name_5 trade_name_6
    zip_code occ_district ultimate_cert_number cfpb_supervisory_flag? cfpb_supervisory_start_date
    cfpb_supervisory_end_date offices_count parent_fdic_cert parent_parcert high_holder_city
    total_domestic_deposits ffiec_call_report_filer holding_company_flag ag_lending_flag ownership_type
    top_holder net_income quarterly_net_income office_count_domestic office_count_foreign
    office_count_us_territories rssd_id holding_company_state subchap_s_indicator trust_powers_status
    asset_concentration_hierarchy primary_specialization csa_name csa_fips_code csa_indicator? cbsa_name
    cbsa_fips_code cbsa_metro_flag? cbsa_micro_flag? cbsa_division_name cbsa_division_fips_code
    cbsa_division_flag?
""".split()

BANK_SQL = {
    "fdic_certificate_number": "c_custkey",
    "institution_name": "c_name",
    "fdic_id": "o_orderkey",
    "state_name": "case when n_nationkey = 3 then null else n_name end",
    "state_fips_code": "case when n_nationkey = 4 then null else n_nationkey end",
    "city": "case when o_orderkey % 11 = 0 then null else o_orderpriority end",
    "bank_charter_class": "o_orderstatus",
    "chartering_agency": "case when c_custkey % 7 = 0 then null else c_mktsegment end",
    "federal_charter": "case when o_orderkey % 5 = 0 then null else o_orderstatus = 'F' end",
    "total_assets": "o_totalprice",
    "equity_capital": "c_acctbal",
    "effective_date": "o_orderdate",
    "address": "concat(c_custkey % 97, ' ', r_name)",
    "zip_code": "case when c_custkey % 13 = 0 then null else c_custkey % 1000 end",
    "occ_charter": "case when c_custkey % 3 = 0 then null else c_custkey * 2 end",
    "fdic_field_office": "r_name",
    "total_deposits": "concat('D', o_orderkey % 1009)",
    "net_income": "concat('N', o_orderkey % 499)",
    "return_on_assets": "concat('A', o_orderkey % 251)",
    "return_on_equity": "concat('E', o_orderkey % 241)",
}


def _bank_cte() -> str:
    """The stand-in as the bank table, in SQL of its own."""
    cols = []
    for i, column in enumerate(BANK_COLUMNS):
        name = column.rstrip("?")
        if column.endswith("?"):
            rule = f"case when o_orderkey % {7 + i} < 2 then null else o_orderkey % {7 + i} % 2 = 0 end"
        else:
            rule = f"case when o_orderkey % {3 + i} = 0 then null else concat('{i}-', o_orderkey % {13 + i}) end"
        kind = "boolean" if column.endswith("?") else "varchar"
        cols.append(f'cast(({BANK_SQL.get(name, rule)}) as {kind}) as "{name}"')
    return W_CTE + ",\nb as (\n  select " + ",\n         ".join(cols) + "\n  from w\n)"


STAR_SQL = {
    "bank_dimension_table": """select distinct fdic_certificate_number, institution_name, address, city, state_name,
        zip_code, bank_charter_class, occ_charter, chartering_agency, federal_charter, fdic_field_office from b""",
    "state_dimension_table": "select distinct state_name, state_fips_code from b",
    "city_dimension_table": "select distinct city, state_name from b",
    "chartering_agency_dimension_table": "select distinct chartering_agency from b",
    "fact_table": """select fdic_certificate_number, total_assets, total_deposits, equity_capital, net_income,
        return_on_assets, return_on_equity, state_fips_code, city, chartering_agency, effective_date from b""",
}


def _key_sql(*columns: str) -> str:
    """md5 over the parts of a key: the length and text of each, "~" for NULL."""
    parts = [f"coalesce(length(cast({c} as varchar)) || ':' || cast({c} as varchar), '~')" for c in columns]
    return "md5(" + " || '|' || ".join(parts) + ")"


def oracle_sql() -> dict[str, str]:
    key = _key_sql("c_mktsegment", "c_nationkey")
    sql = {
        "single_table": f"{W_CTE} select * from w",
        "dim_entity": f"{W_CTE} select distinct c_custkey, c_name, c_mktsegment, n_name, r_name from w",
        "dim_entity_versions": "select distinct o_custkey, o_orderstatus from orders",
        "dim_code_name": f"{W_CTE} select distinct n_name, n_nationkey from w",
        "dim_pair": f"{W_CTE} select distinct o_orderpriority, r_name from w",
        "dim_single": f"{W_CTE} select distinct c_mktsegment from w",
        "fact": (f"{W_CTE} select c_custkey, o_totalprice, c_acctbal, n_nationkey, o_orderpriority, "
                 "c_mktsegment, o_orderdate from w"),
        "query_to_table": f"{W_CTE} select distinct n_name, n_nationkey from w",
        "typed_ingest": ("select o_orderkey, cast(o_custkey as varchar) as o_custkey, "
                         "cast(o_orderdate as varchar) as o_orderdate, o_totalprice from orders"),
        "schema_subset": "select c_custkey, c_mktsegment from customer",
        "conform_cast": "select c_custkey, try_cast(c_name as integer) as v from customer",
        "parquet_partitioned": f"{W_CTE} select * from w",
        "parquet_append": "select * from supplier union all select * from supplier",
        "row_cap": f"select least({ROW_CAP}, count(*)) as n, count(*) as m from customer",
        "rel_parent": f"select distinct {key} as k, c_mktsegment, c_nationkey from customer",
        "rel_child": f"select c_custkey, {key} as k from customer",
    }
    texts = """with t as (
      select c_custkey, c_mktsegment as w,
        case when c_custkey % 11 = 0 then null when c_custkey % 7 = 0 then c_name else cast(c_custkey as varchar) end as v
      from customer
    ), l as (
      select *, v is not null and try_cast(v as integer) is null as lost_v,
        w is not null and try_cast(w as boolean) is null as lost_w from t
    )"""
    sql["conform_cast_rejects"] = f"""{texts}
      select 'c_custkey' as "column", 0::bigint as lost union all select 'absent', 0
      union all select 'v', count(*) filter (where lost_v) from l union all select 'w', count(*) filter (where lost_w) from l"""
    sql["conform_cast_rejected_rows"] = f"""{texts}
      select c_custkey, v, w, concat_ws(',', case when lost_v then 'v' end, case when lost_w then 'w' end) as rejected
      from l where lost_v or lost_w"""
    sql["row_cap_formats"] = f"""
      select f as format, c.cap, least(c.cap, n) as kept from (select count(*) as n from orders) t,
        unnest([0, 1, {ROW_CAP}, n // 2, n, n + 1]) as c(cap), unnest(['parquet', 'orc', 'json', 'csv']) as f(f)"""
    example = ('select c_mktsegment as "Country name", c_name as "Series name", '
               'cast(c_acctbal as float) as "Value", cast(null as float) as "value_percentile" from customer')
    sql["example_conform"] = example
    sql["example_csv_roundtrip"] = example
    conformed = ("select cast(c_custkey as varchar) as c_custkey, c_name, cast(null as boolean) as active, "
                 "cast(c_acctbal as float) as c_acctbal from customer")
    for q in ("conform", "conform_missing", "conform_drop"):
        sql[q] = conformed
    for q in ("parquet_scan", "source_scan", "parquet_roundtrip", "csv_roundtrip", "source_scan_orc", "source_scan_json",
              "source_scan_csv"):
        sql[q] = "select * from supplier"
    bank = _bank_cte()
    sql["ref_single_table"] = f"{bank} select * from b"
    for name, text in STAR_SQL.items():
        sql[f"ref_{name}"] = f"{bank} {text}"
    sql["ref_query_to_table"] = sql["ref_state_dimension_table"]
    sql["ref_extract_load"] = sql["ref_single_table"]
    sql["ref_rel_joined_back"] = sql["ref_single_table"]
    sql["ref_written_fact_table"] = sql["ref_fact_table"]
    sql["ref_written_bank_dimension_table"] = sql["ref_bank_dimension_table"]
    sql["ref_load_all_fact_table"] = sql["ref_fact_table"]
    sql["ref_load_all_csv_state_dimension_table"] = sql["ref_state_dimension_table"]
    sql["ref_load_all_twice_state_dimension_table"] = sql["ref_state_dimension_table"]
    fact_sql = STAR_SQL["fact_table"]
    sql["ref_load_all_twice_fact_table"] = f"{bank} {fact_sql} union all {fact_sql}"
    state, city = _key_sql("state_name", "state_fips_code"), _key_sql("city", "state_name")
    agency = _key_sql("chartering_agency")
    sql["ref_rel_state_table"] = f"{bank} select distinct {state} as state_key, state_name, state_fips_code from b"
    sql["ref_rel_city_table"] = f"{bank} select distinct {city} as city_key, city, state_name from b"
    sql["ref_rel_chartering_agency_table"] = (
        f"{bank} select distinct {agency} as chartering_agency_key, chartering_agency from b")
    sql["ref_rel_institution_table"] = (
        f"{bank} select * exclude (state_name, state_fips_code, city, chartering_agency), {state} as state_key, "
        f"{city} as city_key, {agency} as chartering_agency_key from b")
    sql["ref_snow_joined_back"] = sql["ref_single_table"]
    sql["ref_snow_city_table"] = (f"{bank} select distinct {city} as city_key, city, state_name, {state} as state_key from b")
    sql["ref_snow_institution_table"] = (
        f"{bank} select * exclude (state_name, state_fips_code, city, chartering_agency), "
        f"{city} as city_key, {agency} as chartering_agency_key from b")
    sql["csv_lines_roundtrip"] = r"""
        select c_custkey, c_name || chr(13) || chr(10) || repeat('\', c_custkey % 5) || 'n' || chr(10) || '\N,"'
          || case when c_custkey % 13 <> 0 then c_mktsegment end as text,
          case when c_custkey % 3 = 0 then '\N' else '' end as mark from customer"""
    sql["ref_load_all_institution_table"] = sql["ref_rel_institution_table"]
    sql["ref_load_all_city_table"] = sql["ref_rel_city_table"]
    for name in ("city_dimension_table", "chartering_agency_dimension_table"):
        sql[f"ref_written_{name}"] = sql[f"ref_{name}"]
    sql["ref_load_all_rerun_fact_table"] = sql["ref_load_all_killed_fact_table"] = sql["ref_fact_table"]
    sql["ref_load_all_appended_fact_table"] = sql["ref_load_all_twice_fact_table"]
    sql["ref_load_all_appended_city_dimension_table"] = sql["ref_city_dimension_table"]
    sql["example_partitioned"] = example
    sql["csv_types_roundtrip"] = """
        select o_orderkey, o_orderdate + to_microseconds(o_orderkey % 1000003) as at_time,
          epoch_us(o_orderdate + to_microseconds(o_orderkey % 999983)) as instant,
          cast(o_orderdate as date) as day, cast(o_totalprice as decimal(18, 3)) as price, o_orderkey % 2 = 0 as even
        from orders"""
    if llm_queries:
        sql |= llm_queries.ORACLES
    return sql
