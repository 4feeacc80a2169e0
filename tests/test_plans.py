"""Physical-plan properties the operators rely on at scale."""

from starload import build_star, conform, relational
from starload.plans.standin import CUSTOMER_RELATIONAL, STANDIN_SCHEMA, STANDIN_STAR, read_table, standin_base

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_and_single_table_do_not_shuffle(spark):
    base = standin_base(spark, SF)
    star = build_star(base, STANDIN_STAR, share="none")
    assert "Exchange hashpartitioning" not in _plan(star["fact"])
    assert "Exchange hashpartitioning" not in _plan(conform(base, STANDIN_SCHEMA))


def test_each_dimension_shuffles_once(spark):
    star = build_star(standin_base(spark, SF), STANDIN_STAR, share="none")
    for name in STANDIN_STAR.dimensions:
        assert _plan(star[name]).count("Exchange hashpartitioning") == 1, name


def test_relational_child_is_a_projection_and_parent_hashes_after_distinct(spark):
    out = relational(read_table(spark, SF, "customer"), CUSTOMER_RELATIONAL)
    assert "Exchange" not in _plan(out["customer_rel"])
    parent = _plan(out["segment_nation"])
    final, _, below = parent.partition("Exchange hashpartitioning(c_mktsegment")
    assert "output=[k#" in final  # key computed by the final aggregate
    assert "k#" not in below  # the shuffle carries natural columns only
    assert "ReadSchema: struct<c_nationkey:int,c_mktsegment:string>" in parent


def test_staged_star_outputs_read_only_their_columns(spark):
    star = build_star(standin_base(spark, SF), STANDIN_STAR, share="stage")
    plan = _plan(star["dim_single"])
    assert "ReadSchema: struct<c_mktsegment:string>" in plan
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" not in plan


def test_hot_customer_join_is_split_by_adaptive_execution(spark):
    """A third of all orders re-keyed to one customer: with broadcast off,
    the orders ⋈ customer sort-merge join splits the hot partition and
    every order is still joined once."""
    from pyspark.sql import functions as F
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.shuffle.partitions": "32"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        orders = read_table(spark, "/root/testdata/sf0.01", "orders")
        hot = (orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(0))
                                 .otherwise(F.col("o_custkey")))
               .repartition(16))  # several map tasks, as many input splits give at scale
        customer = read_table(spark, "/root/testdata/sf0.01", "customer")
        joined = hot.join(customer, hot.o_custkey == customer.c_custkey)
        rows = joined.collect()
        plan = _plan(joined)  # the final adaptive plan of that run
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert len(rows) == len({r.o_orderkey for r in rows}) == orders.count()
    assert "SortMergeJoin(skew=true)" in plan


def test_auto_share_restages_only_costly_bases(spark, tmp_path):
    from starload.operators.sharing import resolve_share
    orders = read_table(spark, SF, "orders")
    assert resolve_share(orders, "auto") == "none"
    assert resolve_share(orders.where("o_totalprice > 10").select("o_orderkey"), "auto") == "none"
    assert resolve_share(standin_base(spark, SF), "auto") == "stage"  # joins
    assert resolve_share(orders.distinct(), "auto") == "stage"
    path = str(tmp_path / "orders_csv")
    orders.write.option("header", True).csv(path)
    assert resolve_share(spark.read.option("header", True).csv(path), "auto") == "stage"  # row format
    joined = standin_base(spark, SF).cache()
    try:
        assert resolve_share(joined, "auto") == "none"  # already cached by the caller
    finally:
        joined.unpersist()
    assert resolve_share(orders, "persist") == "persist"


def test_bank_rows_are_dealt_while_they_are_narrow(spark):
    from pyspark.sql import functions as F
    from starload.plans.standin import BANK_FROM_STANDIN, bank_base
    row = standin_base(spark, SF).limit(1)
    keys = spark.range(-300, 300).selectExpr("id AS o_orderkey").union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    rows = keys.join(row.drop("o_orderkey")).select(*STANDIN_SCHEMA.names)
    dealt = bank_base(rows.coalesce(1), dealt=True)
    sizes = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > spark.sparkContext.defaultParallelism and max(r["count"] for r in sizes) < 100
    name = next(n for n, e in BANK_FROM_STANDIN.items() if "split('9-" in e or "split('10-" in e)
    i = list(BANK_FROM_STANDIN).index(name)
    plain = f"CASE WHEN o_orderkey % {3 + i} = 0 THEN NULL ELSE concat('{i}-', o_orderkey % {13 + i}) END"
    got, want = dealt.select("fdic_id", name), rows.selectExpr("CAST(o_orderkey AS STRING) AS fdic_id", f"{plain} AS {name}")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
