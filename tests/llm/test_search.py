"""Exact top-k, URL filter and the queries' SQL."""

import importlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tillroll.llm import topk, url_filter
from tillroll.llm.queries import QUERIES
from tillroll.llm.sql import SQL


def brute_top(rows, queries, k, scale=1024):
    ints = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        ints[i] = min(ints.get(i, list(v)), list(v))
    width = max((len(v) for v in ints.values()), default=0)
    ints = {i: [int(np.floor(x * scale)) for x in v] + [0] * (width - len(v)) for i, v in ints.items()}
    out = []
    for q in sorted(i for i in ints if i in queries):
        scores = sorted((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return out


def vectors(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, id string, v string, block string, part string, rank int"
    return spark.createDataFrame([(i, v, 0, "x", "x", "x", "x", 0) for i, v in rows], schema)


@pytest.mark.parametrize("block_rows", [7, 4096])
def test_topk_against_brute_force(spark, monkeypatch, block_rows):
    """Ties, copies, NULLs, non-finite components, repeated ids, short vectors."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=6))]) for i in range(60)]
    rows += [(i, [0.5] * 6) for i in range(60, 90)]
    rows += [(90, None), (91, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (92, [float("nan")] * 6), (93, [float("inf")] * 6),
             (None, [1.0] * 6), (94, [2.0, 1.0]), (0, rows[0][1]), (95, [-0.25] * 6)]
    df = vectors(spark, rows)
    got = topk.topk(df, df.where("vec_id % 10 = 0"), k=10).collect()
    assert sorted(map(tuple, got)) == brute_top(rows, set(range(0, 96, 10)), 10)


def test_topk_of_few_and_none(spark):
    few = vectors(spark, [(0, [1.0]), (1, [2.0])])
    assert [tuple(r) for r in topk.topk(few, few.where("vec_id = 0")).collect()] == [(0, 1, 1, 2 * 1024 * 1024)]
    none = few.limit(0)
    assert topk.topk(none, none).collect() == [] and topk.topk(few, none).collect() == []


def test_url_parts_rules_and_list(spark):
    urls = ["https://A.Example.org/es/1?x#y", "http://example.org/en/12", "http://notexample.org/en/1", "no scheme",
            None, "http://x.com/de/1", "http://x.com/fr/1", "http://bad.net/p/?utm_a=1&b=2", "http://www.BAD.net/p.html?b=2#z",
            "http://ok.net/p", "ftp://org", "http://bad.net/p/?utm_a=1&b=2", "a://b://c/d", "http://bad.net?b=2"]
    pages = spark.createDataFrame([(i, u, "x", "x", 1, "x") for i, u in enumerate(urls)],
                                  "page_id long, url string, html string, canon string, bloom_block long, listed string")
    listed = spark.createDataFrame([("https://m.bad.net/p?b=2",), (None,), ("junk",)], "url string")
    got = {r["page_id"]: tuple(r)[1:] for r in url_filter.url_filter(pages, listed).collect()}
    assert len(got) == len(urls)
    assert got[0] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert got[1] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert got[2] == ("notexample.org", "/en/1", "org/", "allow")
    assert got[3] == got[4] == ("", "", None, "allow")
    assert got[5][2:] == ("com/de/", "block") and got[6][2:] == ("com/fr/", "allow")
    assert [got[i][3] for i in (7, 8, 11, 9, 13)] == ["block", "block", "block", "allow", "allow"]
    assert got[10][:3] == ("org", "", None) and got[12][:2] == ("b:", "//c/d")


def test_bloom_has_no_false_negatives(spark):
    keys = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    for blocks in (1, url_filter.bloom_blocks(5000)):
        bloom = url_filter.build_bloom(keys, "k", blocks)
        assert url_filter.possible_hits(keys, "k", bloom, blocks).where("possible").count() == 5000
    others = keys.select(F.concat(F.lit("z"), "k").alias("k"))
    assert url_filter.possible_hits(others, "k", bloom, blocks).where("possible").count() < 250


def test_url_filter_of_nothing(spark):
    pages = spark.createDataFrame([(1, "http://a.net/b")], "page_id long, url string")
    none = pages.limit(0)
    assert url_filter.url_filter(none, none).collect() == []
    assert url_filter.url_filter(pages, none).first()["verdict"] == "allow"


def test_registry():
    found = entry.queries()
    assert set(QUERIES) <= set(found) and "pipeline" in found and set(SQL) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert not importlib.import_module("corpus_pipeline").ORACLE_SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, smoke_dir, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{smoke_dir}/{t}.parquet')")
    res = con.execute(SQL[name])
    cols = [c[0] for c in res.description]
    df = QUERIES[name](spark, smoke_dir)
    assert sorted(df.columns) == sorted(cols)
    assert sorted(map(repr, map(tuple, df.select(cols).collect()))) == sorted(map(repr, res.fetchall()))
