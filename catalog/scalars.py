"""Scalar parsing and JSON queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.base import Tables, cte, query
from strata import schemas
from strata.config import TRIMMED
from strata.functions import geo, json, text
from strata.operators import places, projection


def _raw(t: Tables, **columns):
    return t.view("v_raw").select("id_house", *[c.alias(n) for n, c in columns.items()])


@query("fn_parse_price", cte("v_raw") + """
select id_house, try_cast(regexp_replace(precio_txt, '[^0-9]', '', 'g') as double) as precio from v_raw""")
def _(t: Tables):
    return _raw(t, precio=text.parse_price(F.col("precio_txt")))


@query("fn_parse_area", cte("v_raw") + r"""
select id_house, try_cast(regexp_replace(regexp_replace(area_txt, '(?i)\s*m2\s*$', ''), '[^0-9\.]', '', 'g') as double) as area
from v_raw""")
def _(t: Tables):
    return _raw(t, area=text.parse_area(F.col("area_txt")))


@query("fn_first_int", cte("v_raw") + r"""
select id_house, coalesce(try_cast(regexp_extract(hab_txt, '(\d+)', 1) as int), 0) as habitaciones from v_raw""")
def _(t: Tables):
    return _raw(t, habitaciones=text.first_int(F.col("hab_txt")))


@query("fn_presence_flag", cte("v_raw") + """
select id_house, case when financiacion_txt is null or financiacion_txt = 'No disponible' then 0 else 1 end as financiacion
from v_raw""")
def _(t: Tables):
    return _raw(t, financiacion=text.presence_flag(F.col("financiacion_txt")))


@query("fn_default_missing", cte("v_raw") + """
select id_house, case when financiacion_txt is null or financiacion_txt = 'No disponible' then '1' else financiacion_txt end as pisos,
 try_cast(case when hab_txt is null then '1' else hab_txt end as int) as pisos_int from v_raw""")
def _(t: Tables):
    return _raw(
        t, pisos=text.default_if_missing(F.col("financiacion_txt")),
        pisos_int=text.try_int(text.default_if_missing(F.col("hab_txt"))),
    )


@query("fn_area_fallback", cte("v_raw") + r"""
select id_house, coalesce(try_cast(regexp_replace(hab_txt, '[^0-9\.]', '', 'g') as double),
 try_cast(regexp_replace(regexp_replace(area_txt, '(?i)\s*m2\s*$', ''), '[^0-9\.]', '', 'g') as double)) as area_privada
from v_raw""")
def _(t: Tables):
    return _raw(t, area_privada=F.coalesce(text.parse_area(F.col("hab_txt")), text.parse_area(F.col("area_txt"))))


@query("fn_try_int", cte("v_raw") + "select id_house, try_cast(estrato_txt as int) as estrato from v_raw")
def _(t: Tables):
    return _raw(t, estrato=text.try_int(F.col("estrato_txt")))


@query("fn_parse_point", cte("v_raw") + r"""
select id_house, try_cast(regexp_extract(lat_lon, '\(([^,]+),', 1) as double) as lat,
 try_cast(regexp_extract(lat_lon, ',\s*([^)]+)\)', 1) as double) as lon from v_raw""")
def _(t: Tables):
    return _raw(t, lat=geo.point_lat(F.col("lat_lon")), lon=geo.point_lon(F.col("lat_lon")))


# Every column that is trimmed, with blanks before, behind or both; one is all blanks.
UNTRIMMED = cte("v_located") + """
select o_orderkey, concat(' ', url) as url, concat(titulo, '  ') as titulo, concat(' ', constructor, ' ') as constructor,
 concat('Calle  ', estrato, ' ') as direccion_principal, '   ' as direccion_asociadas, concat(' ', lat_lon) as lat_lon,
 concat(' ', department, '  ') as department, concat(city, ' ') as city from v_located"""


@query("fn_trim_all", cte("v_located") + """
select o_orderkey, url, titulo, constructor, concat('Calle  ', estrato) as direccion_principal, '' as direccion_asociadas, lat_lon,
 department, city from v_located""")
def _(t: Tables):
    return t.sql(UNTRIMMED).withColumns(text.trimmed(TRIMMED))


# The same day written as day/month/year, as a date, as a time and as no date at all.
DATE_TEXTS = """select o_orderkey, case o_orderkey % 4
 when 0 then concat(substr(d, 9, 2), '/', substr(d, 6, 2), '/', substr(d, 1, 4))
 when 1 then d when 2 then concat(d, ' 12:30:00.123') else 'x' end as fecha_txt
 from (select o_orderkey, substr(cast(o_orderdate as string), 1, 10) as d from orders) o"""


@query("fn_parse_date", """
select o_orderkey, case when o_orderkey % 4 <> 3 then cast(o_orderdate as date) end as fecha,
 case when o_orderkey % 4 = 2 then cast(cast(o_orderdate as date) as timestamp) + interval '45000123' milliseconds
  when o_orderkey % 4 <> 3 then cast(cast(o_orderdate as date) as timestamp) end as fecha_ts from orders""")
def _(t: Tables):
    return t.sql(DATE_TEXTS).select(
        "o_orderkey", text.parse_date(F.col("fecha_txt")).alias("fecha"), text.parse_timestamp(F.col("fecha_txt")).alias("fecha_ts")
    )


@query("fn_split_or_empty", cte("v_raw") + """
select id_house, coalesce(len(string_split(hab_txt, ' ')), 0) as pieces,
 coalesce(array_to_string(string_split(hab_txt, ' '), '|'), '') as joined from v_raw""")
def _(t: Tables):
    pieces = text.split_or_empty(F.col("hab_txt"), " ")
    return _raw(t, pieces=F.size(pieces).cast("long"), joined=F.array_join(pieces, "|"))


@query("fn_poi_category", cte("v_osm") + "select type, id, coalesce(amenity, shop, leisure) as category from v_osm")
def _(t: Tables):
    elements = t.view("v_osm").withColumn("tags", F.struct("amenity", "shop", "leisure"))
    return elements.select("type", "id", places.category().alias("category"))


@query("fn_sentinel", cte("v_raw") + """
select id_house, case when estrato_txt is null or trim(estrato_txt) = '' then 'No disponible' else trim(estrato_txt) end as estrato,
 case when hab_txt is null then 'No disponible' else hab_txt end as hab from v_raw""")
def _(t: Tables):
    asked = F.when(F.col("hab_txt").isNull(), "¡Pregúntale!").otherwise(F.col("hab_txt"))
    return _raw(t, estrato=text.sentinel(F.col("estrato_txt")), hab=text.sentinel(asked))


@query("fn_absolute_url", cte("v_raw") + """
select id_house, case when hab_txt is null then 'No disponible' else concat('https://listings.example', trim(url)) end as full_url
from v_raw""")
def _(t: Tables):
    href = F.when(F.col("hab_txt").isNotNull(), F.trim("url"))
    return _raw(t, full_url=text.absolute_url(F.lit("https://listings.example"), href))


@query("fn_batch_id", "select event_id, strftime(ts, '%Y-%m-%d_%H-%M-%S') as batch_id from events")
def _(t: Tables):
    return t.table("events").select("event_id", text.batch_id(F.col("ts")).alias("batch_id"))


@query("json_parse_struct", "select event_id, try_cast(json_extract_string(props, '$.k') as bigint) as k from events")
def _(t: Tables):
    schema = T.StructType([T.StructField("k", T.LongType())])
    return t.table("events").select("event_id", json.parse_struct(F.col("props"), schema).getField("k").alias("k"))


@query("json_variant_get", """
select event_id, try_cast(json_extract_string(props, '$.k') as bigint) as k,
 cast(null as varchar) as absent from events""")
def _(t: Tables):
    return t.table("events").select(
        "event_id", json.variant_field(F.col("props"), "$.k", "bigint").alias("k"),
        json.variant_field(F.col("props"), "$.absent", "string").alias("absent"),
    )


@query("json_emit", cte("v_raw") + "select id_house, trim(url) as url, financiacion_txt as financiacion from v_raw")
def _(t: Tables):
    record = json.to_record(url=F.trim("url"), financiacion=F.col("financiacion_txt"))
    read = _raw(t, record=record)
    return read.select(
        "id_house", F.get_json_object("record", "$.url").alias("url"),
        F.get_json_object("record", "$.financiacion").alias("financiacion"),
    )


# Units of a listing as the text of a Python list: single quotes around every name and value.
UNIT_TEXTS = cte("v_unit") + """
select o_orderkey, coalesce(u.unidades, '') as unidades from orders left join (
 select l_orderkey, concat('[', array_join(transform(array_sort(collect_list(struct(l_linenumber, txt))), x -> x.txt), ', '), ']') as unidades
 from (select l_orderkey, l_linenumber, concat('{''m² const.'': ''', const_txt, ''', ''m² priv.'': ''', priv_txt,
  ''', ''Tipo de Inmueble'': ''', tipo_txt, ''', ''Hab/Amb'': ''', hab_txt, ''', ''Baños'': ''', banos_txt,
  ''', ''Precio'': ''', precio_txt, '''}') as txt from v_unit) x group by l_orderkey) u on o_orderkey = l_orderkey"""

# The same units in the form tables give them: a list of JSON texts.
UNIT_TABLE_TEXTS = cte("v_unit") + """
select o_orderkey, coalesce(u.unidades, '') as unidades from orders left join (
 select l_orderkey, to_json(transform(array_sort(collect_list(struct(l_linenumber, txt))), x -> x.txt)) as unidades
 from (select l_orderkey, l_linenumber, to_json(named_struct('area_construida', const_txt, 'area_privada', priv_txt,
  'tipo_inmueble', tipo_txt, 'hab_amb', hab_txt, 'banos', banos_txt, 'precio', precio_txt)) as txt
  from v_unit) x group by l_orderkey) u on o_orderkey = l_orderkey"""

UNIT_ROWS = """select o_orderkey, const_txt as area_construida, priv_txt as area_privada, tipo_txt as tipo_de_inmueble,
 hab_txt as habitaciones, banos_txt as banos, precio_txt as precio from orders left join v_unit on o_orderkey = l_orderkey"""


@query("json_parse_array", cte("v_unit") + """
select o_orderkey, cast(count(const_txt) as int) as units, min(const_txt) as least_area
from orders left join v_unit on o_orderkey = l_orderkey group by o_orderkey""")
def _(t: Tables):
    parsed = t.sql(UNIT_TEXTS).withColumn("u", json.parse_array(F.col("unidades"), schemas.UNIT))
    areas = F.transform("u", lambda u: u.getField("m² const."))
    return parsed.select(
        "o_orderkey", F.coalesce(F.size("u"), F.lit(0)).cast("int").alias("units"), F.array_min(areas).alias("least_area")
    ).withColumn("units", F.greatest("units", F.lit(0)))


def _units(t: Tables, texts: str):
    parsed = t.sql(texts).withColumn("u", json.parse_units(F.col("unidades")))
    return projection.flatten_struct(projection.explode_outer_units(parsed, "u"), "u").drop("unidades")


@query("json_explode_outer", cte("v_unit") + UNIT_ROWS)
def _(t: Tables):
    return _units(t, UNIT_TEXTS)


@query("json_units_table_form", cte("v_unit") + UNIT_ROWS)
def _(t: Tables):
    return _units(t, UNIT_TABLE_TEXTS)


@query("json_explode_inner", """
select l_orderkey, l_linenumber, 'quantity' as item, l_quantity as amount from lineitem
union all select l_orderkey, l_linenumber, 'price', l_extendedprice from lineitem""")
def _(t: Tables):
    nested = t.sql("""select l_orderkey, l_linenumber, array(named_struct('item', 'quantity', 'amount', l_quantity),
        named_struct('item', 'price', 'amount', l_extendedprice)) as elements from lineitem""")
    return nested.select("l_orderkey", "l_linenumber", F.inline("elements"))


@query("flt_numeric_text", cte("v_raw") + r"""
select id_house, area_txt, estrato_txt from v_raw where regexp_matches(estrato_txt, '^[0-9]+$')""")
def _(t: Tables):
    return t.view("v_raw").filter(text.numeric_text(F.col("estrato_txt"))).select("id_house", "area_txt", "estrato_txt")
