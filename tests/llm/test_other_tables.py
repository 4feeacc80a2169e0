"""URL rules, top-k search and chat formatting against SQL and brute force."""

import json
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from starload.llm.chat import canonical_turns, canonical_turns_json, format_chats, read_chats, unmapped_records
from starload.llm.queries import ORACLES, QUERIES
from starload.llm.topk import _dtype, best_of_block, integer_vectors, search_embeddings, top_k
from starload.llm.url_filter import cascade, filter_urls

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op3_url_filter", "op5_exact_top_k", "op6_chat_format"])
def test_queries_equal_their_sql(spark, name):
    rows = QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in ("pages", "embeddings", "conversations"):
        con.sql(f"create view {t} as from '{SF}/{t}.parquet'")
    want = con.sql(f"select {', '.join(rows.columns)} from ({ORACLES[name]})").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in rows.collect())


URLS = ["http://EXAMPLE.net/en/x", "https://a.b.example.net/de/", "//example.net/", None, "", "x://net", "x://net/",
        "x://xample.net?q=/en/", "http://notexample.com/de/", "http://example.com/de", "http://example.com/de/?a#b",
        "http://é.İ.org/fr/1", "http://org/fr/", "http://a/b://net/en/", "http://example.net:80/en/", "http:///en/",
        "http://" + "a." * 40_000 + "net/" + "p/" * 40_000, "http://example.net/en/x"]


def test_url_rules_equal_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(URLS)],
                                  "page_id long, url string, html string, rule string")
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    want = {}
    for i, u in enumerate(URLS):
        rest = (u or "").partition("://")[2]
        head = rest.split("?")[0].split("#")[0]
        host, slash, path = head.partition("/")
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        path = slash + path
        fits = [(len(h + p), h + p, v) for h, p, v in rules if ("." + host).endswith("." + h) and path.startswith(p)]
        want[i] = (host, path, *(max(fits)[1:] if fits else (None, "allow")))
    for bound in (1 << 20, 0):  # by cascades, and by the join for lists beyond the bound
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in filter_urls(pages, literal_bytes=bound).collect()}
        assert got == want
    assert filter_urls(pages.limit(0)).collect() == []
    assert {r.verdict for r in filter_urls(pages, rules=pages.limit(0).selectExpr(
        "url as host", "url as path", "url as verdict"), default="block").collect()} == {"block"}


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(30_000).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    listed = universe.filter(F.xxhash64("key") % 5 == 0)
    found = cascade(listed, universe)
    assert len(found.levels) >= 3 and len(found.levels[1].bits) < len(found.levels[0].bits)
    said = universe.filter(found.listed(F.col("key")))
    assert said.exceptAll(listed).isEmpty() and listed.exceptAll(said).isEmpty()


def brute_top(x, ids, row, k):
    """Of the query in one row: every other row is a candidate, whatever its id."""
    scores = sorted((-int(x[i] @ x[row]), int(ids[i])) for i in range(len(ids)) if i != row)[:k]
    return [(i, -s) for s, i in scores]


@pytest.mark.parametrize("scale,n", [(5, 900), (3000, 300), (2**30, 60), (1, 15), (2**40, 30)])
def test_block_search_equals_brute_force(scale, n):
    rng = np.random.default_rng(n)
    x = rng.integers(-scale, scale + 1, (n, 12))
    if scale == 2**40:
        x = x.astype(object)  # scores beyond a long are refused by pandas; bounds are not
        x[:, 1:] = 0
        x[:, 0] >>= 12
    x[n // 3:2 * n // 3] = x[0]  # a third of the vectors are one
    ids = rng.permutation(n) // 2  # ids repeat
    rows = rng.permutation(9 * n)[:n]
    asked, found, scores, read = best_of_block(rows[:40], x[:40], rows, ids, x, 20, depths=(0.1, 0.5, 0.9, 1.0))
    for q in range(min(n, 40)):
        mine = [(int(v), int(s)) for a, v, s in zip(asked, found, scores) if a == q]
        assert sorted(mine, key=lambda t: (-t[1], t[0])) == brute_top(x, ids, q, 20)
    assert _dtype(x, x) in (np.float32, np.float64, object) and set(read) <= {0.1, 0.5, 0.9, 1.0}


def test_search_stops_before_the_lists_end_where_scores_are_spread():
    """A few candidates stand out in the dimensions that a query asks for."""
    rng = np.random.default_rng(7)
    x = np.sort(rng.geometric(0.002, (3000, 1)), axis=0) * rng.integers(8, 11, (1, 6)) + rng.integers(0, 3, (3000, 6))
    read = best_of_block(np.arange(50), x[:50], np.arange(3000), np.arange(3000), x, 20)[3]
    assert read.max() <= 0.5


def test_search_meets_all_blocks(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(-9, 10, (300, 6))
    rows = spark.createDataFrame([(i, i, v.tolist()) for i, v in enumerate(x)], "row long, vec_id long, x array<long>")
    got = {}
    for r in top_k(rows, rows.filter("vec_id % 3 = 0"), 5, query_block=20, candidate_block=40).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert len(got) == 100
    for q, found in got.items():
        assert [(v, s) for _, v, s in sorted(found)] == brute_top(x, np.arange(300), q, 5)


def test_search_with_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (20, [0.0, nan]), (1, [0.1, inf]), (2, None), (3, [None, 1.0]), (4, [0.01, -0.01]),
            (4, [0.01, -0.01]), (None, [1.0, 1.0]), (5, [1.0]), (40, []), (41, [])]
    e = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, row int")
    assert {r.vec_id: r.x for r in integer_vectors(e).collect()} == {0: [64, 32], 4: [0, -1], 5: [64], 40: [], 41: []}
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in search_embeddings(e).collect())
    assert got == [(0, 1, 4, -32), (0, 2, 4, -32), (40, 1, 41, 0)]
    assert search_embeddings(e.limit(0)).collect() == []


def test_rows_that_share_an_id_are_all_candidates(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(0, [1.0, 1.0]), (1, [1.0, 1.0]), (1, [0.25, 0.25]), (2, [0.1, 0.0]), (0, [2.0, 2.0])]
    rows += [(int(i), [float(v) for v in rng.normal(0, 1, 2)]) for i in rng.integers(0, 60, 300)]
    path = str(tmp_path / "e.parquet")
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(path)
    got = [tuple(r) for r in search_embeddings(spark.read.parquet(path)).select("query_id", "rank", "vec_id", "score").collect()]
    con = duckdb.connect()
    con.sql(f"create view embeddings as from '{path}/*.parquet'")
    assert sorted(got) == sorted(con.sql(f"select query_id, rank, vec_id, score from ({ORACLES['op5_exact_top_k']})").fetchall())
    few = spark.createDataFrame(rows[:4], "vec_id long, embedding array<float>")
    assert [r.score for r in search_embeddings(few).orderBy("rank").collect()] == [8192, 2048, 384]


HARD = ["", "\\", "</turn>", "\\</turn>\n", "<turn user>\nx\n</turn>\n", "a\\\\<turn", "\n</turn>\n\\", "$1 \\1 é\U0001f600",
        "\\### Assistant: </turn> ok", "x" * 100_000]


def test_chats_read_back_exactly(spark):
    roles = ["user", "assistant", None, "a>b\\n\n<turn", "\\0", "\\g>", "assistant"]
    rows = [(1, i, roles[i % len(roles)], t) for i, t in enumerate(HARD)] + [
        (2, None, "user", "first"), (2, 5, "assistant", None), (2, 5, "assistant", None), (None, 0, "user", "no id")]
    df = spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn long, role string, text string, formatted int")
    out = {r.conv_id: r for r in read_chats(format_chats(canonical_turns(df, "conv_id", order="turn"))).collect()}
    assert [(t.role, t.text) for t in out[1].turns] == [
        (r, t) for c, _, r, t in rows if c == 1]
    assert out[1].loss_texts == [t for c, _, r, t in rows if c == 1 and r == "assistant"]
    assert out[2].loss_texts == ["", ""] and [t.text for t in out[2].turns] == ["first", "", ""]
    assert out[None].turns[0].text == "no id"
    text = out[1].formatted
    for span in filter(None, out[1].loss):
        assert text[span.end:span.end + 9] == "\n</turn>\n" and text[:span.start].endswith("<turn assistant>\n")
    assert format_chats(canonical_turns(df.limit(0), "conv_id", order="turn")).collect() == []


def test_roles_of_any_characters_read_back(spark):
    controls = [chr(i) for i in range(128)] + ["\u0080", "\u2028", "é"]
    roles = [f"a{c}gb" for c in controls] + [f"{c}\\{c}n\\g\\\\{c}>" for c in controls] + ["", "\\", "\\0", "\\\\0", "\\\\g>", None, "\x00\\g"]
    df = spark.createDataFrame([(i, 0, r, "t") for i, r in enumerate(roles)], "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r.turns[0].role for r in read_chats(format_chats(canonical_turns(df, "conv_id", order="turn"))).collect()}
    assert [out[i] for i in range(len(roles))] == roles


RECORDS = [
    {"messages": [{"role": "user", "content": "q"}, {"content": "a", "role": "assistant"}]},
    {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
    {"prompt": "q", "completion": "a"}, {"response": "a", "prompt": "q"}, {"instruction": "q", "output": "a"},
    {"instruction": "q", "input": "more", "output": "a"}, {"instruction": "q", "input": "", "output": "a"}]


def test_mixed_records_become_the_same_turns(spark):
    texts = [*map(json.dumps, RECORDS), None, "{broken", '{"other": 1}']
    df = spark.createDataFrame(list(enumerate(texts)), "id long, json string")
    got = {}
    for r in canonical_turns_json(df, "id", "json").orderBy("conv_id", "turn").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    pair = [("user", "q"), ("assistant", "a")]
    assert got == {i: pair if i != 5 else [("user", "q"), ("user", "more"), ("assistant", "a")] for i in range(7)}


def test_records_with_extra_fields_keep_their_turns(spark):
    extra = [{"id": i, "source": "s", **r} for i, r in enumerate(RECORDS[:5])]
    extra[0]["messages"] = [{"name": "n", **m} for m in extra[0]["messages"]]
    texts = [*map(json.dumps, extra), None, "{broken", '{"other": 1}', '{"messages": []}']
    df = spark.createDataFrame(list(enumerate(texts)), "id long, json string")
    got = sorted((r.conv_id, r.turn, r.role, r.text) for r in canonical_turns_json(df, "id", "json").collect())
    assert got == [t for i in range(5) for t in ((i, 0, "user", "q"), (i, 1, "assistant", "a"))]
    assert {(r.conv_id, r.reason) for r in unmapped_records(df, "id", "json").collect()} == {
        (5, "malformed"), (6, "malformed"), (7, "layout"), (8, "layout")}
    typed = spark.read.json(spark.sparkContext.parallelize([json.dumps({"id": 9, **RECORDS[1]})]))
    assert {r.role for r in canonical_turns(typed, "id").collect()} == {"user", "assistant"}


def test_tables_of_other_layouts(spark):
    for i, record in enumerate(RECORDS):
        if i in (5, 6):
            continue
        df = spark.read.json(spark.sparkContext.parallelize([json.dumps({"id": 9, "note": "x", **record})]))
        roles = [(r.role, r.text) for r in canonical_turns(df, "id").orderBy("turn").collect()]
        assert [t for _, t in roles] == ["q", "a"] and len(roles) == 2
    with pytest.raises(ValueError):
        canonical_turns(spark.range(1), "id")


def test_entry_works_without_the_subpackage(tmp_path):
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for name in ("__spark_entry__.py", "starload"):
        os.symlink(f"{root}/{name}", tmp_path / name) if name.endswith("py") else None
    pkg = tmp_path / "starload"
    pkg.mkdir()
    for name in os.listdir(f"{root}/starload"):
        if name != "llm":
            os.symlink(f"{root}/starload/{name}", pkg / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", f"import sys; sys.path.insert(0, {str(tmp_path)!r})\n{code}"],
                   check=True, cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)})
