"""Rules and mined rules against SQL, and against brute force where rules exist."""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from itertools import combinations

from strata.llm import url_filter as uf
from strata.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, database


def made():
    rng = random.Random(2)
    pages, labels = [], []
    for i in range(400):
        host = rng.choice(["a.org", "casino.org", "www.b.org", "x.net", "example.com", "www.example.com", "shop.c.org"])
        path = rng.choice(["/win/1", "/news/2.html", "/en/3", "/es/4", "", "/fr"])
        query = rng.choice(["", "?ref=1", "?utm=2&ref=3", "#top"])
        pages.append((i, f"http{rng.choice(['', 's'])}://{host}{path}{query}"))
        bad = ("casino" in host and rng.random() < 0.8) or ("win" in path and "ref" in query and rng.random() < 0.9) or rng.random() < 0.1
        if rng.random() < 0.7:
            labels.append((i, int(not bad), 0))
    pages += [(1000, None), (1001, "no scheme"), (1002, "HTTP://A.ORG/Win"), (1003, "http://casino.org"), (1004, "x://Example.COM/en/\n1?q"), (5, pages[5][1])]
    labels += [(1000, 0, 0), (7, None, None), (7, None, 1)]
    return pages, labels


def test_made_up(spark, tmp_path):
    pages, labels = made()
    for name, data, schema in (("pages", pages, "page_id long, url string"), ("labels", labels, "doc_id long, quality int, toxic int")):
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}_dir"))
        next((tmp_path / f"{name}_dir").glob("part-*.parquet")).rename(tmp_path / f"{name}.parquet")
    import duckdb

    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet'")
    df = QUERIES["op9_url_filters"](spark, str(tmp_path))
    assert compare(df, con, ORACLES["op9_url_filters"]) == ""
    got = {r.page_id: r for r in df.collect()}
    assert got[1003].verdict == "block" and got[1003].rule is None  # mined
    assert got[1000].verdict == got[1001].verdict == "allow" and got[1000].host == got[1001].path == ""
    assert got[1004].rule == "example.com/en/" and got[1002].host == "a.org"
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_mined_rules_by_brute_force(spark):
    rng = random.Random(4)
    rows = [(sorted({rng.choice("abcdefg") for _ in range(4)}), rng.random() < 0.4) for _ in range(300)]
    rows = [(t, True if {"a", "b"} <= set(t) else b) for t, b in rows]
    settings = uf.Mining(min_support=0.02, min_count=5, confidence_pct=70, max_tokens=3)
    mined = uf.mine(spark.createDataFrame(rows, "tokens array<string>, bad boolean"), settings)
    want = {}
    for size in (1, 2, 3):
        for c in combinations("abcdefg", size):
            n = [b for t, b in rows if set(c) <= set(t)]
            if sum(n) >= 6 and 100 * sum(n) >= 70 * len(n):
                want[c] = (sum(n), len(n))
    assert want and {tuple(r.body): (r.hits, r.rows) for r in mined.collect()} == want


def subsets(tokens):
    return (c for size in range(1, len(tokens) + 1) for c in combinations(sorted(tokens), size))


def plain_tokens(url):
    scheme, host, path = re.match(r"(?s)(.*?)://([^/?#]*)([^?#]*)", url).groups()
    query = re.match(r"(?s)[^?#]*\?([^#]*)", url)
    parted = [("s:", scheme.split(":")), ("h:", host.lower().split(".")), ("p:", path.split("/")),
              ("q:", [x.split("=")[0] for x in query[1].split("&")] if query else [])]
    return {mark + re.sub("[0-9]+", "#", x) for mark, found in parted for x in found if x}


def test_rules_of_all_sizes(spark):
    rng = random.Random(5)
    rows = [(sorted(rng.sample("abcdef", 5)), False) for _ in range(200)]
    rows = [(t, "f" not in t) for t, _ in rows]  # only all of a to e together are bad
    mined = uf.mine(spark.createDataFrame(rows, "tokens array<string>, bad boolean"))
    assert {"".join(r.body) for r in mined.collect()} == {"abcde"}


def test_query_by_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url").collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    rows = [(plain_tokens(pages[r.doc_id]), r.toxic == 1 or r.quality == 0) for r in labels
            if r.doc_id in pages and (r.toxic is not None or r.quality is not None)]
    seen, hits = Counter(c for t, _ in rows for c in subsets(t)), Counter(c for t, bad in rows if bad for c in subsets(t))
    least = max(5, math.ceil(len(rows) * 0.002))
    rules = {c for c, n in hits.items() if n >= least and 100 * n >= 60 * seen[c]}
    got = [r for r in QUERIES["op9_url_filters"](spark, folder).collect() if r.rule is None]
    want = {r.page_id for r in got if any(c in rules for c in subsets(plain_tokens(pages[r.page_id])))}
    assert max(map(len, rules)) > 3 and {r.page_id for r in got if r.verdict == "block"} == want


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(QUERIES["op9_url_filters"](spark, folder), database(folder), ORACLES["op9_url_filters"]) == ""


def test_odd_rows(spark):
    pages = spark.createDataFrame([(None, None, "r"), (1, "http://x.net/es/", "r"), (1, "http://x.net/es/", "r"), (2, "a://" + "h" * 100_000 + ".com/", "r")],
                                  "page_id long, url string, rule string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert sorted((repr(r.page_id), r.rule, r.verdict) for r in uf.judge(pages, labels).collect()) == [
        ("1", "net/es/", "block"), ("1", "net/es/", "block"), ("2", "com/", "allow"), ("None", None, "allow")]
    assert uf.judge(pages.limit(0), labels).collect() == []
