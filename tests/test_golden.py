"""Literal edge cases of parsers and operators."""

from __future__ import annotations

import csv
import datetime as dt
import json as pyjson

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strata import schemas
from strata.functions import geo, json, text
from strata.operators import (
    aggregates, dedup, features, filters, ids, pages, places, projection, quality, upsert,
)
from strata.plans import flows
from strata.sources import files


def one(df):
    return [r[0] for r in df.collect()]


def parsed(rows, values, fn):
    numbered = rows("i int, x string", list(enumerate(values)))
    return [r.y for r in numbered.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize("mode,expected", [
    ("reference", [450000000.0, 45000000050.0, 1200.0, None, None, None]),
    ("locale", [450000000.0, 450000000.5, 1200.0, None, None, None]),
])
def test_price(rows, mode, expected):
    texts = ["$ 450.000.000", "$ 450.000.000,50", "Desde $ 1.200", "A convenir", "", None]
    assert parsed(rows, texts, lambda c: text.parse_price(c, mode)) == expected


@pytest.mark.parametrize("mode,expected", [
    ("reference", [120.0, 85.5, 1.2, 1.2005, 852.0, None]),
    ("locale", [120.0, 85.0, 1200.0, 1200.5, 85.0, None]),
])
def test_area(rows, mode, expected):
    texts = ["120 m²", "85.5 m2", "1.200 m2", "1.200,5 m2", "85 m2 aprox", None]
    assert parsed(rows, texts, lambda c: text.parse_area(c, mode)) == expected


def test_counts_and_flags(rows):
    assert parsed(rows, ["3 habitaciones", "2-4", "sin", None, "99999999999"], text.first_int) == [3, 2, 0, 0, 0]
    assert parsed(rows, [None, "No disponible", "Si", ""], text.presence_flag) == [0, 0, 1, 1]
    assert parsed(rows, ["4", " 4 ", "4.0", "", "Campestre"], text.try_int) == [4, 4, None, None, None]
    assert parsed(rows, [None, "No disponible", "2"], text.default_if_missing) == ["1", "1", "2"]
    assert parsed(rows, ["12", "1a", "", None], text.numeric_text) == [True, False, False, None]


def test_points_and_boxes(rows):
    texts = ["(6.24, -75.57)", "(None, None)", ""]
    assert parsed(rows, texts, geo.point_lat) == [6.24, None, None]
    assert parsed(rows, texts, geo.point_lon) == [-75.57, None, None]
    box = parsed(rows, ["api?data=(11.0020,-74.8787,11.0479,-74.8239);out"], geo.box_midpoint)[0]
    assert (round(box.lat, 5), round(box.lon, 4)) == (11.02495, -74.8513)


def test_dates(rows):
    texts = ["2025-05-01", "01/05/2025", "2025-05-01 12:00:00.123", "x", None]
    day = dt.date(2025, 5, 1)
    assert parsed(rows, texts, text.parse_date) == [day, day, day, None, None]
    assert parsed(rows, texts[2:3], text.parse_timestamp) == [dt.datetime(2025, 5, 1, 12, 0, 0, 123000)]


def test_links_and_sentinels(rows):
    assert parsed(rows, ["/a", "", None, "https://o.example/b"], lambda c: text.absolute_url(F.lit("https://h.example"), c)) == [
        "https://h.example/a", "No disponible", "No disponible", "https://o.example/b",
    ]
    assert parsed(rows, ["¡Pregúntale!", "", " x ", None], text.sentinel) == ["No disponible", "No disponible", "x", "No disponible"]
    assert parsed(rows, ["a,b", None, ""], text.split_or_empty) == [["a", "b"], [], [""]]


def test_json_struct(rows):
    got = parsed(rows, ["0", "", "bad", '{"Estrato": "4"}'], lambda c: json.parse_struct(c, schemas.FULL_INFO))
    assert got[1] is None and got[0].Estrato is None and got[2].Estrato is None and got[3].Estrato == "4"


def test_units_in_both_forms(rows):
    table = "['{\\n  \"area_construida\": \"56 m2\",\\n  \"precio\": \"$ 9\"\\n}']"
    got = parsed(rows, [
        "[{'m² const.': '56', 'Hab/Amb': '3', 'Precio': '$ 1,200.000'}, {'m² const.': '60'}]",
        "[]", "", "[{'m² const.': \"d'x\"}]", table,
    ], json.parse_units)
    assert [u.area_construida for u in got[0]] == ["56", "60"] and got[0][0].precio == "$ 1,200.000"
    assert got[1] == [] and got[2] is None
    assert got[3][0].area_construida == "d'x"
    assert (got[4][0].area_construida, got[4][0].precio) == ("56 m2", "$ 9")


def test_explode_keeps_listings_without_units(rows):
    df = rows("id int, u array<int>", [(1, [5, 6]), (2, []), (3, None)])
    assert sorted(map(tuple, projection.explode_outer_units(df, "u").collect()), key=str) == [
        (1, 5), (1, 6), (2, None), (3, None),
    ]


def test_location_and_names(rows):
    located = projection.with_location(rows("p string", [("cali/valle-del-cauca",)]), "p").first()
    assert (located.city, located.department) == ("cali", "valle-del-cauca")
    assert projection.standardize_names(rows("`Tipo de Inmueble ` string, `d'x` int", [])).columns == ["Tipo_de_Inmueble", "dx"]
    assert projection.plain_name("m² const.", True) == "m2_const_"
    with pytest.raises(ValueError, match="collide"):
        projection.standardize_names(rows("`a b` int, a_b int", []))


def test_csv_keeps_quotes_and_lines(spark, tmp_path):
    cell = pyjson.dumps({"Estado": 'Nuevo, "lujo"', "Estrato": "4"}, indent=2)
    with open(tmp_path / "a.csv", "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(schemas.RAW.fieldNames())
        out.writerow(["2025-05-01", "u", "t", "c", cell, "[]", "0", "d", "e", "(1, 2)"])
        out.writerow(["2025-05-02", "v", "t", "c", "{}", "[]", "0", "d", "e", "(1, 2)"])
    got = projection.rename(files.read_listings_csv(spark, str(tmp_path))).orderBy("url").collect()
    assert len(got) == 2 and got[0].item == cell and got[0].lat_lon == "(1, 2)"


def test_latest_per_key_after_trim(rows):
    batch = rows("url string, fecha string, titulo string, constructor string", [
        ("u", "2025-05-02", "a", None), ("u ", "2025-05-01", "b", None), ("", "2025-05-01", "c", None),
        (None, "2025-05-01", "d", None), ("w", "2025-05-01", None, None), ("w", "01/05/2025", "b", None),
    ])
    best = dedup.latest_per_key(flows.prepared(batch))
    assert sorted((r.url, r.titulo) for r in best.collect()) == [("u", "a"), ("w", "b")]


TABLE = "url string, fecha string, id_house long"


@pytest.mark.parametrize("limit", [1 << 20, -1])
@pytest.mark.parametrize("strategy,kept", [("latest_wins", "2025-05-02"), ("append_only", "2025-05-02"), ("overwrite", "2025-05-01")])
def test_upsert(rows, strategy, kept, limit):
    target = rows(TABLE, [("u", "2025-05-02", 7), ("x", "2025-05-02", 8)])
    batch = rows("url string, fecha string", [("u", "2025-05-01"), ("w", "2025-05-01")])
    got = {r.url: r for r in upsert.upsert(target, batch, strategy=strategy, broadcast_bytes=limit).collect()}
    assert got["u"].fecha == kept and got["u"].id_house == 7
    assert got["w"].fecha == "2025-05-01" and got["w"].id_house is None and got["w"]._action == "inserted"
    assert got["x"]._action == "unchanged" and len(got) == 3


def test_upsert_refuses_a_repeated_key(rows):
    target = rows(TABLE, [])
    batch = rows("url string, fecha string", [("u", "2025-05-01"), ("u", "2025-05-02")])
    with pytest.raises(PySparkException, match="more than once"):
        upsert.upsert(target, batch).collect()


def test_features_at_zero(rows):
    df = rows(
        "precio double, area_construida double, area_privada double, habitaciones int, banos int, estrato int, hospital long",
        [(100.0, 0.0, 5.0, 2, 1, 3, None), (100.0, 50.0, None, 0, 1, 3, 2)],
    )
    assert features.price_per_m2(df).count() == 1
    zero = features.poi_density(features.area_ratio(df)).filter("area_construida = 0").first()
    assert (zero.ratio_area, zero.poi_density) == (1.0, 0.0)
    empty = features.engineer(df).first()
    assert (empty.precio_por_habitacion, empty.area_por_habitacion, empty.poi_total) == (100.0, 50.0, 2)


def test_encodings(rows):
    df = rows("id int, c string", [(0, "b"), (1, "a"), (2, "c"), (3, "a"), (4, None)])
    hot = features.one_hot(df, ["c"])
    assert hot.columns == ["id", "c_b", "c_c"] and hot.filter("id = 1").first()[1:] == (0, 0)
    labels = {r.id: r.c for r in features.label_encode(df, ["c"]).collect()}
    assert labels == {0: 1, 1: 0, 2: 2, 3: 0, 4: None}
    with pytest.raises(ValueError, match="one_hot_sparse"):
        features.categories(df, "c", limit=2)


def test_iqr(rows):
    four = rows("x double", [(v,) for v in (1.0, 2.0, 4.0, 9.0)])
    assert filters.iqr_bounds(four, "x") == (-3.5, 10.5)
    five = rows("x double", [(v,) for v in (1.0, 2.0, 4.0, 9.0, 100.0)])
    assert sorted(one(filters.iqr_filter(five, "x"))) == [1.0, 2.0, 4.0, 9.0]
    assert filters.iqr_filter(rows("x double", [(None,)]), "x").count() == 0


def test_pivot_has_no_null_category(rows):
    counts = places.cell_counts(rows("lat double, lon double, category string", [
        (4.0, -74.0, "park"), (4.0, -74.0, None), (4.0, -74.0, "kiosk"), (None, None, "park"),
    ]))
    assert counts.columns == ["hex_id", "hospital", "mall", "park", "school"]
    assert counts.first()[1:] == (0, 0, 1, 0) and counts.count() == 1


def test_places_without_input(spark):
    empty = places.poi_counts(None, spark)
    assert empty.schema == schemas.POI_COUNTS and empty.count() == 0


def test_validate(rows):
    def passed(df, *need):
        return {r.check: r.passed for r in quality.validate(df, need).collect()}

    assert passed(rows("url string", []), "url") == {"column:url": True, "not_empty": False}
    assert passed(rows("URL string", [("u",)]), "url", "x") == {"column:url": True, "column:x": False, "not_empty": True}
    with pytest.raises(ValueError, match="column:x"):
        quality.require_valid(rows("url string", [("u",)]), ["x"])


def test_quality_report_counts_copies(rows):
    df = rows("`a b` string, `lat/lon` string", [("", "1"), ("", "1"), (None, "50"), ("x", "z")])
    got = {(r.metric, r.column): r.value for r in quality.quality_report(df, {"lat/lon": (0, 10)}).collect()}
    assert got == {
        ("total_rows", ""): 4, ("duplicate_rows", ""): 1, ("null_count", "a b"): 1, ("null_count", "lat/lon"): 0,
        ("empty_count", "a b"): 3, ("empty_count", "lat/lon"): 0, ("outlier_count", "lat/lon"): 1,
    }
    short = {(r.metric, r.column): r.value for r in quality.quality_report(df, duplicates=False).collect()}
    assert short[("total_rows", "")] == 4 and ("duplicate_rows", "") not in short
    none = {(r.metric, r.column): r.value for r in quality.quality_report(df.limit(0)).collect()}
    assert set(none.values()) == {0}


def test_duplication_counts_null_as_a_key(rows):
    got = aggregates.duplication_stats(rows("k string", [("a",), ("a",), (None,), (None,), (None,)]), "k").first()
    assert (got.total_records, got.unique_records, got.duplicate_records, got.alert) == (5, 2, 3, True)


def test_ids_follow_the_key(rows):
    df = ids.assign_ids(rows("k string", [("c",), ("a",), ("b",)]), "k", start=10)
    assert {r.k: r.id_house for r in df.collect()} == {"a": 10, "b": 11, "c": 12}


SHEET = """<div class="x technical-sheet"><div class="ant-row ant-row-space-between">
<div class="ant-col"><span class="ant-typography">i</span><span class="ant-typography">Estado</span></div>
<div class="ant-col"></div><div class="ant-col">%s</div></div></div>"""


@pytest.mark.parametrize("cell,value", [
    ("<strong> Usado </strong>", "Usado"), ("texto", "texto"), ("", "No disponible"),
    ("<strong>x</strong><button class='btnQuestion'>?</button>", "No disponible"),
])
def test_sheet(cell, value):
    got = {e["key"]: e["value"] for e in pages._content(SHEET % cell, pages.SELECTORS)["sheet"]}
    assert got == {"Estado": value, "Precio": None}


def test_pages_that_fail_stay(rows):
    df = rows("page_id long, url string, html string", [(1, "u", None), (2, "v", "<p>x<p><b>y")])
    got = {r.page_id: r for r in pages.page_content(df).collect()}
    assert got[1].error == "no content" and got[1].facts is None
    assert got[2].error is None and got[2].facts == [] and got[2].units == []


def test_page_numbers(rows):
    html = '<ul class="list"><li class="ant-pagination-item a"><a>2</a></li><li class="ant-pagination-item">11</li><li class="ant-pagination-next">x</li></ul>'
    df = rows("page_id long, url string, html string", [(1, "h/c", html), (2, "h/d", "<p>none")])
    got = pages.crawl_frontier(df).orderBy("page", "url").collect()
    assert len(got) == 12 and got[-1].url == "h/c/pagina11" and got[1].url == "h/d/pagina1"


def test_run_log_keeps_going(spark, tmp_path):
    def broken():
        raise OSError("no such tier")

    log = str(tmp_path / "log")
    assert flows.run_sources(spark, {"a": broken, "b": lambda: 1}, log) == "partial_failure"
    assert flows.run_sources(spark, {"a": broken}, log) == "failed"
    got = spark.read.parquet(log)
    assert got.filter("source = 'a' and status = 'failed' and detail like '%no such tier%'").count() == 2


def test_markup_nests_open_elements_and_keeps_inner_blanks():
    from strata.functions.markup import tree

    page = tree('<div class="a b"><p>x<p> y <i>z</i> w<br>v</div><script>"</p>"</script><p>t</p></b>')
    assert [p.text() for p in page.all("p")] == ["xyzwv", "yzwv", "t"]
    assert page.first("div.a.b p").whole_text() == "x y z wv"
    assert page.first("div.c") is None and page.first("div i").text() == "z"


def test_page_functions_from_sql(spark, rows):
    pages.register(spark)
    rows("html string", [("<ul class='ant-list-items'><li class='ant-list-item'><div class='ant-col'>a b</div><div class='ant-col'>¡Pregúntale!</div></li></ul>",)]).createOrReplaceTempView("one_page")
    got = spark.sql("select inline(page_content(html).facts) from one_page").collect()
    assert [tuple(r) for r in got] == [("a b", "No disponible")]
