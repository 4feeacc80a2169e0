from oracle_check import compare

SF = "/root/testdata/sf0.001"


def test_entry_returns_the_bank_fact(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert len(df.columns) == 11 and df.columns[0] == "fdic_certificate_number"
    assert df.count() == 1500


def own_queries():
    """The reference's queries; those of the training-data operators have tests of their own."""
    import __spark_entry__ as e
    return [q for q in e.queries() if q != "pipeline" and not (q.startswith("op") and q[2].isdigit())]


def test_every_query_has_an_oracle():
    import __spark_entry__ as e
    assert set(own_queries()) <= set(e.oracle_sql()) <= set(e.queries())


def test_bank_fixture_has_no_empty_and_no_equal_columns(spark):
    import __spark_entry__ as e
    rows = e.queries()["ref_single_table"](spark, SF).toPandas()
    columns = [tuple(rows[c].map(str)) for c in rows.columns]
    assert len(set(columns)) == len(rows.columns) == 121
    assert rows.notna().any().all()
    flags = [c for c in rows if rows[c].dropna().map(type).eq(bool).all()]
    assert len(flags) == 20 and all(set(rows[c].map(str)) >= {"True", "False", "None"} for c in flags)


def test_queries_match_duckdb(spark):
    result = compare(spark, SF, own_queries())
    bad = {k: v for k, v in result.items() if not v["ok"]}
    assert not bad, bad


def test_queries_do_not_depend_on_ansi_mode_or_time_zone(spark):
    conf = {"spark.sql.ansi.enabled": "false", "spark.sql.session.timeZone": "America/Los_Angeles"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        names = ["conform_cast", "typed_ingest", "example_csv_roundtrip", "ref_fact_table", "rel_parent"]
        result = compare(spark, SF, names)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert all(v["ok"] for v in result.values()), result
