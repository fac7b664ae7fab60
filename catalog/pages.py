"""Page queries, over the given pages and over listing pages made from orders and parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import Tables, cte, query
from strata.operators import page_tables, pages

BASE = "https://listings.example"


@query("page_title_h1", r"""
select page_id, trim(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)) as title from pages""")
def _(t: Tables):
    return pages.page_title(t.table("pages"))


@query("page_links", r"""
select page_id, unnest(regexp_extract_all(html, '<a\s[^>]*?href="([^"]*)"[^>]*>', 1)) as href from pages""")
def _(t: Tables):
    return pages.page_links(t.table("pages"))


# One page per order. Facts as a two-column list; a technical sheet where has_info is 1,
# with a price tag on some; units as blocks on even orders, as a table on odd ones.
DETAIL = cte("v_text", "v_unit") + """, u as (
 select l_orderkey, array_join(transform(array_sort(collect_list(struct(l_linenumber, precio_txt, const_txt, tipo_txt, blk))), x -> x.blk), '') as blocks,
  array_join(transform(array_sort(collect_list(struct(l_linenumber, precio_txt, const_txt, tipo_txt, tr))), x -> x.tr), '') as trs
 from (select l_orderkey, l_linenumber, precio_txt, const_txt, tipo_txt,
  concat('<li class="proyect_units_list_item"><div class="unit_item"><span>Hab/Amb:</span><span> ', hab_txt,
   '</span></div><div class="unit_item"><span>Precio:</span><span>', precio_txt, '</span></div></li>') as blk,
  concat('<tr><td>', const_txt, '</td><td>', priv_txt, '</td><td>', tipo_txt, '</td><td>', hab_txt, '</td><td>', banos_txt,
   '</td><td><b>', precio_txt, '</b></td></tr>') as tr from v_unit) x group by l_orderkey)
select o_orderkey as page_id, url, concat('<html><script>var t="</p>";</script><body>',
 '<p><b><div class="location-header"><p>Inicio</p><p>Calle ', estrato, '</p><p>y</p><p>Barrio ', estado, '</p></div>',
 '<ul class="ant-list-items"><li class="ant-list-item x"><div class="ant-col"> Estrato </div><div class="ant-col c2">', estrato,
 '</div></li><li class="ant-list-item"><div class="ant-col">Pisos</div><div class="ant-col">',
 case when pisos = 'No disponible' then '¡Pregúntale!' else pisos end, '</div></li></ul>',
 case when has_info = 1 then concat('<div class="jsx technical-sheet"><div class="ant-row ant-row-space-between">',
  '<div class="ant-col"><span class="ant-typography">i</span><span class="ant-typography">Estado</span></div><div class="ant-col">:</div>',
  '<div class="ant-col"><strong>', estado, '</strong></div></div><div class="ant-row ant-row-space-between">',
  '<div class="ant-col"><span class="ant-typography">i</span><span class="ant-typography">Remodelado</span></div><div class="ant-col"></div>',
  '<div class="ant-col"><button class="btnQuestion">?</button></div></div></div>') else '' end,
 case when estado = 'F' then concat('<div class="property-price-tag"><span class="ant-typography price high"><strong>', precio,
  '</strong></span></div>') else '' end,
 case when o_orderkey % 2 = 0 then concat('<ul>', coalesce(blocks, ''), '</ul>')
  else concat('<div class="ant-table-container"><table><tbody>', coalesce(trs, ''), '</tbody></table></div>') end,
 '</body></html>') as html
from v_text left join u on o_orderkey = l_orderkey"""


def detail(t: Tables):
    return t.sql(DETAIL)


FACTS = cte("v_text") + """
select o_orderkey as page_id, 'facts' as part, 'Estrato' as "key", estrato as value from v_text
union all select o_orderkey, 'facts', 'Pisos', pisos from v_text
union all select o_orderkey, 'sheet', 'Estado', estado from v_text where has_info = 1
union all select o_orderkey, 'sheet', 'Remodelado', 'No disponible' from v_text where has_info = 1
union all select o_orderkey, 'sheet', 'Precio', case when estado = 'F' then precio end from v_text where has_info = 1"""


@query("page_facts", FACTS)
def _(t: Tables):
    return pages.page_facts(detail(t))


@query("page_facts_sql", FACTS)
def _(t: Tables):
    pages.dealt(detail(t)).createOrReplaceTempView("detail_pages")
    page_tables.register(t.spark)
    return t.spark.sql("""
        select page_id, f.* from detail_pages, lateral page_rows(html, 'facts') f
        union all select page_id, f.* from detail_pages, lateral page_rows(html, part => 'sheet') f""")


UNITS = cte("v_unit") + """, n as (
 select *, cast(row_number() over (partition by l_orderkey order by l_linenumber, precio_txt, const_txt, tipo_txt) - 1 as int) as unit from v_unit)
select l_orderkey as page_id, unit, false as from_table, k as "key", case k when 'Precio' then precio_txt else hab_txt end as value
from n, (values ('Precio'), ('Hab/Amb')) v(k) where l_orderkey % 2 = 0
union all select l_orderkey, unit, true, k, case k when 'area_construida' then const_txt when 'area_privada' then priv_txt
 when 'tipo_inmueble' then tipo_txt when 'hab_amb' then hab_txt when 'banos' then banos_txt else precio_txt end
from n, (values ('area_construida'), ('area_privada'), ('tipo_inmueble'), ('hab_amb'), ('banos'), ('precio')) v(k)
where l_orderkey % 2 = 1"""


@query("page_units", UNITS)
def _(t: Tables):
    return pages.page_units(detail(t))


@query("page_units_sql", UNITS)
def _(t: Tables):
    pages_ = detail(t)
    # Some pages are there in two equal versions.
    pages_.unionByName(pages_.filter("page_id % 3 = 0")).createOrReplaceTempView("detail_pages")
    page_tables.register(t.spark)
    return t.spark.sql("select u.* from page_units(table(detail_pages) partition by page_id) u")


# The same facts in the markup of another site, and its rules.
OTHER_SITE = cte("v_text") + """
select o_orderkey as page_id, concat('<div id="x"><dl class="data"><dt>Estrato</dt><dd> ', estrato, '</dd><dt>Pisos</dt><dd>',
 case when pisos = 'No disponible' then '¡Pregúntale!' else pisos end, '</dl>',
 case when has_info = 1 then concat('<p class="state"><i>', estado, '</i></p>') else '' end,
 case when estado = 'F' then concat('<b class="amount old">1</b><span class="amount">', precio, '</span>') else '' end, '</div>') as html
from v_text"""
OTHER_RULES = (
    ("facts", 1, "dl.data", None, "dt[0]", "dd[0]"),
    ("facts", 2, "dl.data", None, "dt[1]", "dd[1]"),
    ("sheet", 1, "p.state", None, "=Estado", "i"),
    ("sheet", 2, "div", None, "=Precio", "span.amount"),
    ("sheet", 3, "div", None, "=Precio", "b.amount"),
)


@query("page_facts_by_rules", cte("v_text") + """, f as (
 select o_orderkey as page_id, 'listing' as page_set, 'facts' as part, 'Estrato' as "key", estrato as value from v_text
 union all select o_orderkey, 'listing', 'facts', 'Pisos', pisos from v_text
 union all select o_orderkey, 'listing', 'sheet', 'Estado', estado from v_text where has_info = 1
 union all select o_orderkey, 'listing', 'sheet', 'Remodelado', 'No disponible' from v_text where has_info = 1
 union all select o_orderkey, 'listing', 'sheet', 'Precio', case when estado = 'F' then precio end from v_text where has_info = 1
 union all select o_orderkey, 'other', 'facts', 'Estrato', estrato from v_text
 union all select o_orderkey, 'other', 'facts', 'Pisos', pisos from v_text
 union all select o_orderkey, 'other', 'sheet', 'Estado', estado from v_text where has_info = 1
 union all select o_orderkey, 'other', 'sheet', 'Precio', case when estado = 'F' then precio end from v_text)
select *, cast(null as varchar) as error from f""")
def _(t: Tables):
    both = detail(t).select("page_id", "html", F.lit("listing").alias("site")).unionByName(
        t.sql(OTHER_SITE).select("page_id", "html", F.lit("other").alias("site")))
    rules = page_tables.rule_sets(t.spark, {"listing": page_tables.LISTING_RULES, "other": OTHER_RULES})
    return page_tables.page_facts_by_rules(both, rules, F.col("site"))


# One index page per twenty order numbers: a card per order, page items up to their count.
INDEX = cte("v_text") + """
select page_id, concat('https://listings.example/venta/', cast(page_id as string)) as url,
 concat('<div class="search-page-container"><section class="listingsWrapper">', array_join(transform(array_sort(collect_list(struct(o_orderkey, card))), x -> x.card), ''),
 '</section></div><ul class="list"><li class="ant-pagination-prev"><a>‹</a></li>',
 case when page_id % 5 = 0 then '' else array_join(transform(sequence(1, cast(count(*) as int)), i -> concat('<li class="ant-pagination-item ant-pagination-item-',
  cast(i as string), '"><a>', cast(i as string), '</a></li>')), '') end, '<li class="ant-pagination-next"><a>›</a></li></ul>') as html
from (select cast(floor(o_orderkey / 20) as bigint) as page_id, o_orderkey, concat('<div class="listingCard CO"><div class="lc-dataWrapper">',
  '<a class="lc-data" href="', url, '" title="Casa ', estado, ' &amp; patio">ver</a>',
  case when has_info = 1 then concat('<div class="publisher">por <strong>', constructor, '</strong></div>') else '' end,
  '</div></div>') as card from v_text) x group by page_id"""


@query("listing_cards", cte("v_text") + f"""
select cast(floor(o_orderkey / 20) as bigint) as page_id, concat('{BASE}', url) as url, concat('Casa ', estado, ' & patio') as titulo,
 case when has_info = 1 then constructor else 'No disponible' end as constructor from v_text""")
def _(t: Tables):
    return pages.listing_cards(t.sql(INDEX), BASE)


@query("crawl_frontier", cte("v_text") + """, n as (select cast(floor(o_orderkey / 20) as bigint) as page_id, count(*) as n from v_text group by 1)
select page_id, cast(i as int) as page,
 concat('https://listings.example/venta/', cast(page_id as varchar), '/pagina', cast(i as varchar)) as url
from (select page_id, unnest(generate_series(1, case when page_id % 5 = 0 then 1 else n end)) as i from n) x""")
def _(t: Tables):
    return pages.crawl_frontier(t.sql(INDEX))


REQUESTS = """select o_orderkey as page_id, concat('/api?data=(', cast(estrato as string), '.5,-75.25,', cast(estrato as string), '.75,-75);') as url
 from v_text"""


@query("page_location", cte("v_text", "v_poi") + """, p as (
 select id as page_id, lat, lon from v_poi union all select id, lat + 1, lon + 1 from v_poi),
b as (select page_id, (min(lat) + max(lat)) / 2.0 as lat, (min(lon) + max(lon)) / 2.0 as lon from p group by page_id)
select o_orderkey as page_id, coalesce(b.lat, (cast(estrato as double) + 0.5 + (cast(estrato as double) + 0.75)) / 2.0) as lat,
 coalesce(b.lon, (-75.25 + -75) / 2.0) as lon from v_text left join b on b.page_id = o_orderkey""")
def _(t: Tables):
    return pages.page_location(*_located(t))


def _located(t: Tables):
    points = t.sql(cte("v_poi") + """select id as page_id, lat, lon from v_poi
        union all select id, lat + 1, lon + 1 from v_poi""")
    return t.sql(cte("v_text") + REQUESTS), points


# Units of an order as the text a record holds: objects of blocks, or JSON texts of table rows.
# Every seventh page is empty, and keeps nothing but its card, its place and the error.
@query("page_record", cte("v_text", "v_unit", "v_poi") + """, p as (
 select id as page_id, lat, lon from v_poi union all select id, lat + 1, lon + 1 from v_poi),
b as (select page_id, (min(lat) + max(lat)) / 2.0 as lat, (min(lon) + max(lon)) / 2.0 as lon from p group by page_id),
u as (select l_orderkey, count(*) as units, string_agg(precio_txt, '|' order by l_linenumber, precio_txt, const_txt, tipo_txt) as precios,
 string_agg(hab_txt, '|' order by l_linenumber, precio_txt, const_txt, tipo_txt) as habs from v_unit group by l_orderkey),
r as (select *, o_orderkey % 7 = 0 as gone, coalesce(units, 0) as n from v_text left join u on o_orderkey = l_orderkey)
select o_orderkey as page_id, '2025-05-01' as fecha, url, titulo,
 case when has_info = 1 then constructor else 'No disponible' end as constructor,
 case when gone then '' else concat('{"Estrato":"', estrato, '","Pisos":"', pisos, '"}') end as item,
 case when gone then null else n end as units, case when gone then null else precios end as precios, case when gone then null else habs end as habs,
 not gone and n = 0 as has_sheet,
 case when not gone and has_info = 1 and n = 0 then estado end as sheet_estado,
 case when not gone and has_info = 1 and n = 0 and estado = 'F' then r.precio end as sheet_precio,
 case when gone then '' else concat('Calle ', estrato) end as direccion_principal,
 case when gone then '' else concat('Barrio ', estado) end as direccion_asociadas,
 coalesce(b.lat, (cast(estrato as double) + 0.5 + (cast(estrato as double) + 0.75)) / 2.0) as lat, coalesce(b.lon, (-75.25 + -75) / 2.0) as lon,
 case when gone then 'no content' end as error
from r left join b on b.page_id = o_orderkey""")
def _(t: Tables):
    cards = t.view("v_text").select("url", "titulo", F.when(F.col("has_info") == 1, F.col("constructor")).alias("constructor"))
    where = pages.page_location(*_located(t))
    shown = detail(t).withColumn("html", F.when(F.col("page_id") % 7 != 0, F.col("html")))
    rows = pages.page_record(shown, cards, where, F.lit("2025-05-01"))
    # Blocks are objects, rows of a table JSON texts.
    objects = F.from_json("unidades", "array<map<string, string>>")
    texts = F.transform(F.from_json("unidades", "array<string>"), lambda x: F.from_json(x, "map<string, string>"))
    units = F.when(F.col("unidades").startswith('["'), texts).otherwise(objects)
    joined = lambda *keys: F.when(F.size("_u") > 0, F.array_join(F.transform("_u", lambda m: F.coalesce(*[m[k] for k in keys])), "|"))
    point = lambda i: F.regexp_extract("lat_lon", r"\(([^,]+), ([^)]+)\)", i).cast("double")
    return rows.withColumn("_u", units).select(
        "page_id", "fecha", "url", "titulo", "constructor", "item", F.when(F.col("unidades") != "", F.size("_u")).cast("long").alias("units"),
        joined("Precio", "precio").alias("precios"), joined("Hab/Amb", "hab_amb").alias("habs"), (F.col("full_info") != "").alias("has_sheet"),
        F.get_json_object("full_info", "$.Estado").alias("sheet_estado"), F.get_json_object("full_info", "$.Precio").alias("sheet_precio"),
        "direccion_principal", "direccion_asociadas", point(1).alias("lat"), point(2).alias("lon"), "error")
