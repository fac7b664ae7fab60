"""Listing pages to rows.

Pages are a table (page_id, url, html), spread over tasks like any other. Flat things
(links, page numbers, boxes) are read by JVM expressions; nested ones by one Arrow
batch function that returns (key, value) pairs for Spark to explode, join and encode.
What to look for is data: a dict of selectors handed to the job. Reading a page takes far
longer than moving it, so pages are dealt to all tasks before they are read.
"""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.config import ASK_MARKERS, NOT_AVAILABLE
from strata.functions import geo, text
from strata.functions.markup import Node, tree
from strata.operators.places import bbox_midpoint
from strata.plans.sizing import materialize

# Where listing pages keep their data.
SELECTORS = {
    "fact_row": "ul.ant-list-items li.ant-list-item",
    "fact_cell": "div.ant-col",
    "sheet": "div.technical-sheet",
    "sheet_row": "div.ant-row.ant-row-space-between",
    "sheet_cell": "div.ant-col",
    "sheet_label": "span.ant-typography",
    "sheet_ask": "button.btnQuestion",
    "price": "div.property-price-tag span.price",
    "unit_block": "li.proyect_units_list_item",
    "unit_item": "div.unit_item",
    "unit_table_row": "div.ant-table-container table tbody tr",
    "address": "div.location-header p",
    "card": "div.search-page-container section.listingsWrapper div",
    "card_link": "div.lc-dataWrapper a.lc-data",
    "card_publisher": "div.lc-dataWrapper div.publisher strong",
}
# Both occur in the class text of a card.
CARD_WORDS = ("listingCard", "CO")
UNIT_COLUMNS = ("area_construida", "area_privada", "tipo_inmueble", "hab_amb", "banos", "precio")
PAGE_BLOCK = 50_000  # page numbers that one row is expanded to at once
LINK = r"""<a\s[^>]*?href="([^"]*)"[^>]*>"""
PAGE_ITEM = r"""<li[^>]*ant-pagination-item[^>]*>(?:\s*<[^>]+>)*\s*([0-9]+)\s*<"""
H1 = r"(?is)<h1[^>]*>(.*?)</h1>"

PAIRS = "array<struct<key string, value string>>"
CONTENT = (
    f"facts {PAIRS}, sheet {PAIRS}, units array<{PAIRS}>, table_units boolean, "
    "direccion_principal string, direccion_asociadas string, error string"
)
CARDS = "array<struct<href string, title string, publisher string>>"
_TEXT = pa.string()
_PAIRS = pa.list_(pa.struct([("key", _TEXT), ("value", _TEXT)]))
_CONTENT = pa.struct([
    ("facts", _PAIRS), ("sheet", _PAIRS), ("units", pa.list_(_PAIRS)), ("table_units", pa.bool_()),
    ("direccion_principal", _TEXT), ("direccion_asociadas", _TEXT), ("error", _TEXT),
])
_CARDS = pa.list_(pa.struct([("href", _TEXT), ("title", _TEXT), ("publisher", _TEXT)]))
PART = 256  # pages whose elements and results are Python objects at once


def dealt(pages: DataFrame) -> DataFrame:
    """The same pages, dealt to as many tasks as there is work for, however few files or
    partitions they come from. Pages of one id, or of none, go to different tasks."""
    return pages.repartition(F.xxhash64("page_id", "html"))


def _value(raw: str) -> str:
    return NOT_AVAILABLE if raw in ASK_MARKERS else raw


def _pairs(found: Mapping[str, str | None]) -> list[dict[str, str | None]]:
    return [{"key": k, "value": v} for k, v in found.items()]


def _facts(page: Node, at: Mapping[str, str]) -> dict[str, str]:
    """Two-column list."""
    rows = (row.all(at["fact_cell"]) for row in page.all(at["fact_row"]))
    return {cells[0].whole_text(): _value(cells[1].text()) for cells in rows if len(cells) == 2}


def _sheet(page: Node, at: Mapping[str, str]) -> dict[str, str | None]:
    """Technical sheet: label in the second span of column one, value in column three;
    the price tag of the page belongs to it. A page without a sheet has neither."""
    found: dict[str, str | None] = {}
    sheet = page.first(at["sheet"])
    if sheet is None:
        return found
    for row in sheet.all(at["sheet_row"]):
        cells = row.all(at["sheet_cell"])
        labels = cells[0].all(at["sheet_label"]) if len(cells) > 2 else []
        if len(labels) > 1:
            bold = cells[2].first("strong")
            shown = (bold or cells[2]).text()
            asked = cells[2].first(at["sheet_ask"]) is not None
            found[labels[1].text()] = NOT_AVAILABLE if asked or not shown else shown
    tag = page.first(at["price"])
    price = tag.first("strong") if tag else None
    found["Precio"] = price.whole_text() if price else None
    return found


def _units(page: Node, at: Mapping[str, str]) -> tuple[list[dict[str, str]], bool]:
    """Repeated blocks; rows of the table only if there is no block."""
    blocks = []
    for block in page.all(at["unit_block"]):
        spans = [item.all("span") for item in block.all(at["unit_item"])]
        blocks.append({s[0].text().replace(":", ""): s[1].text() for s in spans if len(s) > 1})
    if blocks:
        return blocks, False
    rows = (row.all("td") for row in page.all(at["unit_table_row"]))
    table = [dict(zip(UNIT_COLUMNS, (c.text() for c in cells))) for cells in rows if len(cells) >= len(UNIT_COLUMNS)]
    return table, True


def _content(html: str | None, at: Mapping[str, str]) -> dict:
    out: dict = dict.fromkeys(
        ("facts", "sheet", "units", "table_units", "direccion_principal", "direccion_asociadas", "error")
    )
    if not html:
        return out | {"error": "no content"}
    try:
        page = tree(html)
    except Exception as e:  # noqa: BLE001 - a page that cannot be read is a row with its error
        return out | {"error": f"{type(e).__name__}: {e}"}

    def facts() -> None:
        out["facts"] = _pairs(_facts(page, at))

    def sheet() -> None:
        out["sheet"] = _pairs(_sheet(page, at))

    def units() -> None:
        found, from_table = _units(page, at)
        out["units"], out["table_units"] = [_pairs(u) for u in found], from_table

    def lines() -> None:
        found = [p.text() for p in page.all(at["address"])]
        out["direccion_principal"] = found[1] if len(found) > 1 else None
        out["direccion_asociadas"] = found[3] if len(found) > 3 else None

    failed = []
    for part in (facts, sheet, units, lines):
        try:
            part()
        except Exception as e:  # noqa: BLE001 - the other parts of the page are kept
            failed.append(f"{part.__name__}: {type(e).__name__}: {e}")
    page.forget()
    return out | {"error": "; ".join(failed) or None}


def _by_parts(html: pa.Array, read, returns: pa.DataType) -> pa.Array:
    """What ``read`` makes of every page, as Python objects for a few pages at a time."""
    starts = range(0, len(html), PART)
    made = [pa.array([read(h) for h in html.slice(at, PART).to_pylist()], returns) for at in starts]
    return pa.concat_arrays(made) if made else pa.array([], returns)


def content_of(selectors: Mapping[str, str] = SELECTORS):
    """The batch function html -> struct of everything a listing page holds."""

    @F.arrow_udf(CONTENT)
    def page_content(html: pa.Array) -> pa.Array:
        return _by_parts(html, lambda h: _content(h, selectors), _CONTENT)

    # So that no filter inferred from its result runs it a second time.
    return page_content.asNondeterministic()


def cards_of(selectors: Mapping[str, str] = SELECTORS):
    """The batch function html -> cards of an index page."""

    def cards(html: str | None) -> list[dict]:
        out = []
        try:
            page = tree(html or "")
        except Exception:  # noqa: BLE001 - a page that cannot be read has no cards
            return out
        for card in page.all(selectors["card"]):
            if not all(w in (card.attrs.get("class") or "") for w in CARD_WORDS):
                continue
            link, publisher = card.first(selectors["card_link"]), card.first(selectors["card_publisher"])
            attrs = link.attrs if link else {}
            out.append({
                "href": attrs.get("href"),
                "title": attrs.get("title"),
                "publisher": publisher.whole_text() if publisher else NOT_AVAILABLE,
            })
        page.forget()
        return out

    @F.arrow_udf(CARDS)
    def page_cards(html: pa.Array) -> pa.Array:
        return _by_parts(html, cards, _CARDS)

    return page_cards.asNondeterministic()


def register(spark) -> None:
    """Make ``page_content(html)`` and ``page_cards(html)`` callable from SQL."""
    spark.udf.register("page_content", content_of())
    spark.udf.register("page_cards", cards_of())


def page_content(pages: DataFrame, selectors: Mapping[str, str] = SELECTORS) -> DataFrame:
    """(page_id, url, and the fields of CONTENT); a page without content stays, with
    its error."""
    parsed = dealt(pages.select("page_id", "url", "html")).select("page_id", "url", content_of(selectors)(F.col("html")).alias("_c"))
    return parsed.select("page_id", "url", "_c.*")


def page_facts(pages: DataFrame, selectors: Mapping[str, str] = SELECTORS) -> DataFrame:
    """(page_id, part, key, value) from the two-column list and the technical sheet."""
    content = page_content(pages, selectors)

    def tagged(part: str) -> Column:
        def one(e: Column) -> Column:
            return F.struct(F.lit(part).alias("part"), e.getField("key").alias("key"), e.getField("value").alias("value"))

        return F.transform(F.coalesce(F.col(part), F.array().cast(PAIRS)), one)

    return content.select("page_id", F.inline(F.concat(tagged("facts"), tagged("sheet"))))


def page_units(pages: DataFrame, selectors: Mapping[str, str] = SELECTORS) -> DataFrame:
    """(page_id, unit, from_table, key, value): one row per field of each unit."""
    content = page_content(pages, selectors)
    each = content.select("page_id", F.col("table_units").alias("from_table"), F.posexplode("units").alias("unit", "_u"))
    return each.select("page_id", "unit", "from_table", F.inline("_u"))


def page_title(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", F.trim(F.regexp_extract("html", H1, 1)).alias("title"))


def page_links(pages: DataFrame, base: str | None = None) -> DataFrame:
    """(page_id, href) of every link, made absolute when a base is given."""
    hrefs = pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("href"))
    return hrefs if base is None else hrefs.withColumn("href", text.absolute_url(F.lit(base), text.unescaped(F.col("href"))))


def listing_cards(pages: DataFrame, base: str, selectors: Mapping[str, str] = SELECTORS) -> DataFrame:
    """(page_id, url, titulo, constructor) of every card on index pages."""
    cards = dealt(pages.select("page_id", "html")).select("page_id", F.inline(cards_of(selectors)(F.col("html"))))
    return cards.select(
        "page_id",
        text.absolute_url(F.lit(base), F.col("href")).alias("url"),
        F.col("title").alias("titulo"),
        F.col("publisher").alias("constructor"),
    )


def page_count(html: Column) -> Column:
    """Largest numeric page item of an index page; the last page carries it wherever it
    stands in the list."""
    items = F.regexp_extract_all(html, F.lit(PAGE_ITEM), F.lit(1))
    return F.array_max(F.transform(F.filter(items, text.numeric_text), lambda i: i.try_cast("int")))


def crawl_frontier(pages: DataFrame, pattern: str = "%s/pagina%d", block: int = PAGE_BLOCK) -> DataFrame:
    """(page_id, page, url): one row per page of every index; one that shows no page
    numbers has one page.

    An index may claim billions of pages: its numbers are cut into blocks, and blocks are
    dealt to all tasks before they become rows.
    """
    count = F.greatest(F.coalesce(page_count(F.col("html")), F.lit(1)), F.lit(1)).cast("long")
    counted = materialize(pages.select("page_id", "url", count.alias("_n")))
    longest, total = counted.agg(F.max("_n"), F.sum("_n")).first()
    first, last = F.lit(1).cast("long"), F.col("_n")
    if longest is not None and longest > block:
        blocks = counted.select("page_id", "url", "_n", F.explode(F.expr(f"sequence(0L, (_n - 1) div {block})")).alias("_b"))
        tasks = max(pages.sparkSession.sparkContext.defaultParallelism, total // (50 * block))
        counted = blocks.repartition(min(tasks, 100_000))
        first, last = F.col("_b") * block + 1, F.least(F.col("_n"), (F.col("_b") + 1) * block)
    each = counted.select("page_id", "url", F.explode(F.sequence(first, last)).alias("page")).withColumn("page", F.col("page").cast("int"))
    return each.select("page_id", "page", F.format_string(pattern, "url", "page").alias("url"))


def page_location(requests: DataFrame, points: DataFrame) -> DataFrame:
    """(page_id, lat, lon): box midpoint of the points a page answered with, else of the
    box in the request url. ``requests`` is (page_id, url), ``points`` (page_id, lat, lon).

    Points fold to one row per page before they are joined.
    """
    seen = bbox_midpoint(points, "page_id").select(
        F.col("page_id"), F.col("lat").alias("_lat"), F.col("lon").alias("_lon")
    )
    asked = requests.withColumn("_box", geo.box_midpoint(F.col("url")))
    return asked.join(seen, "page_id", "left").select(
        "page_id",
        F.coalesce("_lat", F.col("_box.lat")).alias("lat"),
        F.coalesce("_lon", F.col("_box.lon")).alias("lon"),
    )


def page_record(
    pages: DataFrame, cards: DataFrame, locations: DataFrame, fecha: Column,
    selectors: Mapping[str, str] = SELECTORS,
) -> DataFrame:
    """The raw listing row of every page, blank where a page failed, plus ``error``.

    ``full_info`` is taken from the technical sheet only where facts or units are
    missing.
    """
    content = page_content(pages, selectors)
    has_facts, has_units = F.size("facts") > 0, F.size("units") > 0
    maps = F.transform("units", lambda u: F.map_from_entries(u))
    units = F.when(F.col("table_units"), F.to_json(F.transform(maps, lambda m: F.to_json(m)))).otherwise(F.to_json(maps))
    sheet = F.when(~(has_facts & has_units), F.to_json(F.map_from_entries("sheet")))
    blank = lambda c: F.coalesce(c, F.lit(""))
    # Of several cards of a page, the same one on every run.
    titled = cards.groupBy("url").agg(F.min(F.struct("titulo", "constructor")).alias("_t")).select("url", "_t.*")
    point = F.format_string("(%s, %s)", F.col("lat").cast("string"), F.col("lon").cast("string"))
    return (
        content.join(titled, "url", "left").join(locations, "page_id", "left").select(
            "page_id",
            fecha.alias("fecha"),
            "url",
            blank(F.col("titulo")).alias("titulo"),
            F.coalesce("constructor", F.lit(NOT_AVAILABLE)).alias("constructor"),
            blank(F.to_json(F.map_from_entries("facts"))).alias("item"),
            blank(units).alias("unidades"),
            blank(sheet).alias("full_info"),
            blank(F.col("direccion_principal")).alias("direccion_principal"),
            blank(F.col("direccion_asociadas")).alias("direccion_asociadas"),
            F.when(F.col("lat").isNotNull(), point).otherwise(F.lit("")).alias("lat_lon"),
            "error",
        )
    )
