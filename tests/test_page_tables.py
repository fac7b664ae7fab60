"""Table functions over pages, and rules that are rows."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from catalog.base import Tables
from catalog.pages import detail
from strata.operators import page_tables, pages

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def site(spark):
    page_tables.register(spark)
    detail(Tables(spark, FOLDER)).createOrReplaceTempView("site_pages")
    return spark.table("site_pages")


def rows_of(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_functions_give_what_operators_give(spark, site):
    facts = spark.sql("""select page_id, f.* from site_pages, lateral page_rows(html, 'facts') f
        union all select page_id, f.* from site_pages, lateral page_rows(html, 'sheet') f""")
    assert rows_of(facts) == rows_of(pages.page_facts(site))
    units = spark.sql("select u.* from page_units(table(site_pages) partition by page_id) u")
    assert units.columns == ["page_id", "unit", "from_table", "key", "value"]
    lateral = spark.sql("select page_id, u.* from site_pages, lateral page_rows(html, 'units') u")
    assert rows_of(units) == rows_of(lateral) == rows_of(pages.page_units(site))


def test_columns_follow_the_arguments(spark, site):
    spark.range(1).selectExpr("cast(7 as decimal(9, 2)) as ref", "'<p>' as html").createOrReplaceTempView("odd_pages")
    found = spark.sql("select * from page_units(table(odd_pages) partition by ref, key => 'ref')")
    assert dict(found.dtypes)["ref"] == "decimal(9,2)" and found.collect() == []
    assert spark.sql("select * from site_pages, lateral page_rows(html, part => 'units')").columns[-4:] == ["unit", "from_table", "key", "value"]


@pytest.mark.parametrize(("call", "message"), [
    ("site_pages, lateral page_rows(html, 'prices')", "part must be one of"),
    ("site_pages, lateral page_rows(html, url)", "part must be a constant text"),
    ("site_pages, lateral page_rows(page_id, 'facts')", "reads a text column"),
    ("site_pages, lateral page_rows(html, 'facts', '{\"colour\": \"p\"}')", "names among"),
    ("page_units('x')", "reads TABLE"),
    ("page_units(table(select 1 as page_id) partition by page_id)", "page_units needs html"),
])
def test_wrong_arguments_fail_while_planning(spark, site, call, message):
    with pytest.raises(Exception, match=message):
        spark.sql(f"select * from {call}")


def test_other_selectors(spark, site):
    other = json.dumps({"fact_row": "div.location-header", "fact_cell": "p"})
    html = "<div class='location-header'><p>Key</p><p>¡Pregúntale!</p></div>"
    spark.createDataFrame([(1, html), (2, None), (3, "")], "page_id int, html string").createOrReplaceTempView("few_pages")
    found = spark.sql(f"select page_id, f.* from few_pages, lateral page_rows(html, 'facts', '{other}') f").collect()
    assert [tuple(r) for r in found] == [(1, "facts", "Key", "No disponible")]


def test_partitions_see_equal_versions_once(spark, site):
    one = site.filter("page_id = (select min(page_id) from site_pages where html like '%unit_item%')")
    changed = one.withColumn("html", F.regexp_replace("html", "Precio:", "Valor:"))
    one.unionByName(one).unionByName(changed).unionByName(one).repartition(3).createOrReplaceTempView("versions")
    got = spark.sql("select * from page_units(table(versions) partition by page_id)").collect()
    once = pages.page_units(one).collect()
    assert len(got) == 2 * len(once) and sum(r.key == "Valor" for r in got) == sum(r.key == "Precio" for r in once)


def test_lateral_does_not_shuffle_and_table_argument_does(spark, site):
    def plan(sql):
        return spark.sql(sql)._jdf.queryExecution().executedPlan().toString()

    spark.range(3).selectExpr("id as page_id", "'<p>' as html").createOrReplaceTempView("plain_pages")
    assert "Exchange" not in plan("select page_id, f.* from plain_pages, lateral page_rows(html, 'facts') f")
    assert "hashpartitioning(partition_by_0" in plan("select * from page_units(table(plain_pages) partition by page_id)")


RULES = {
    "a": [("facts", 1, "li", None, "b", "i[1]"), ("facts", 2, "li", None, "b", "i"), ("facts", 3, "ul", "u", "=Old", "=yes"),
          ("facts", 4, "ul", "!u", "=Old", "=no"), ("more", 1, "ul", None, "=Total", "^em.sum")],
    "b": [("facts", 1, "p", None, "=Text", "s"), ("facts", 2, "p", None, "=Text", "q")],
}


def test_rules(spark, rows):
    html = "<ul><li><b>k</b><i>1</i><i>2</i></li><li><b>l</b><i>¡Pregúntale!</i></li><li><i>no key</i></li></ul>"
    data = [(1, "a", html), (2, "a", html + "<em class='x sum'> 9 </em>"), (3, "b", "<p><q>x</q>"), (4, "b", "<p>"), (5, "none", html),
            (6, None, html), (7, "a", None), (8, "b", "")]
    df = rows("page_id int, site string, html string", data)
    got = page_tables.page_facts_by_rules(df, page_tables.rule_sets(spark, RULES), F.col("site")).collect()
    a = [("facts", "k", "2"), ("facts", "l", "No disponible"), ("facts", "Old", "no")]
    assert sorted(map(repr, ((r.page_id, r.part, r.key, r.value) for r in got))) == sorted(map(repr, [
        *((1, *f) for f in a), (1, "more", "Total", None), *((2, *f) for f in a), (2, "more", "Total", "9"), (3, "facts", "Text", "x"),
        (4, "facts", "Text", None)]))
    assert all(r.error is None for r in got)


def test_rules_change_without_code(spark, rows):
    df = rows("page_id int, html string", [(1, "<p>new<s>old</s></p>")])
    rules = page_tables.rule_sets(spark, {"b": [("facts", 1, "p", None, "=Text", "s")]})
    more = rules.unionByName(page_tables.rule_sets(spark, {"b": [("facts", 0, "p", None, "=Text", "^p")]}))
    value = lambda r: [x.value for x in page_tables.page_facts_by_rules(df, r, F.lit("b")).collect()]
    assert value(rules) == ["old"] and value(more) == ["newold"]
    assert page_tables.page_facts_by_rules(df, rules.limit(0), F.lit("b")).collect() == []


def test_bad_rules_are_told(spark, rows):
    df = rows("page_id int, html string", [(1, "<p>x")])
    bad = page_tables.rule_sets(spark, {"b": [("facts", 1, "p", None, "=Text", "s[x]")]})
    found = page_tables.page_facts_by_rules(df, bad, F.lit("b")).collect()
    assert len(found) == 1 and found[0].value is None and "not a path" in found[0].error


def test_rules_of_the_site_equal_the_code(spark, site):
    rules = page_tables.rule_sets(spark, {"listing": page_tables.LISTING_RULES})
    got = page_tables.page_facts_by_rules(site, rules, F.lit("listing")).select("page_id", "part", "key", "value")
    assert rows_of(got) == rows_of(pages.page_facts(site))
