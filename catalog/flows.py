"""Flow queries: whole tables in, the result of a whole flow out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from catalog.aggregates import rounded
from catalog.base import Tables, cte, query
from catalog.features import BOUNDS, DATASET, FEATURES
from catalog.keyed import LATEST
from catalog.places import CELL_KM, COUNTS, POI, elements, hex_sql
from catalog.scalars import UNIT_TEXTS
from catalog.sources import RAW_ROWS
from strata.config import Settings
from strata.operators import places
from strata.operators.dedup import latest_per_key
from strata.operators.ids import assign_ids
from strata.plans import flows
from strata.plans.sizing import scratch_path
from strata.sources import files

SETTINGS = Settings(price_bounds=BOUNDS["price_bounds"], area_bounds=BOUNDS["area_bounds"], cell_km=CELL_KM)
RAW_COLUMNS = (
    "fecha", "url", "titulo", "constructor", "item", "unidades", "full_info",
    "direccion_principal", "direccion_asociadas", "lat_lon",
)


@query("pipe_bronze", "select 'total_rows' as metric, '' as \"column\", count(*) as value from orders\n" + "\n".join(
    [f"union all select 'duplicate_rows', '', 0"]
    + [f"union all select '{m}', '{c}', 0" for m in ("null_count", "empty_count") for c in RAW_COLUMNS]
))
def _(t: Tables):
    landed = scratch_path(t.spark, "landed")
    files.write_csv(t.sql(RAW_ROWS), landed)
    return flows.bronze(t.spark, landed, scratch_path(t.spark, "bronze"), "2025-05-01_00-00-00").report


@query("pipe_dedup_merge", cte("v_daily") + f""", old as (select url, cast(fecha as date) as fecha, titulo, precio from
 (select *, {LATEST} as rn from v_daily where batch_id = 'b1') x where rn = 1),
target as (select row_number() over (order by url) as id_house, * from old),
updates as (select url, cast(fecha as date) as fecha, titulo, precio from
 (select *, {LATEST} as rn from v_daily where batch_id = 'b2') x where rn = 1),
fresh as (select url, (select max(id_house) from target) + row_number() over (order by url) as id_house
 from updates where url not in (select url from target))
select coalesce(t.id_house, f.id_house) as id_house, coalesce(u.url, t.url) as url, coalesce(u.fecha, t.fecha) as fecha,
 case when u.url is not null then u.titulo else t.titulo end as titulo,
 case when u.url is not null then u.precio else t.precio end as precio,
 case when t.url is null then 'inserted' when u.url is null then 'unchanged' else 'updated' end as action
from target t full outer join updates u on t.url = u.url left join fresh f on f.url = u.url""")
def _(t: Tables):
    """A day's record keeps its date, so every matched update is at least as new."""
    rows = t.view("v_daily")
    old = latest_per_key(rows.filter(F.col("batch_id") == "b1")).select("url", F.to_date("fecha").alias("fecha"), "titulo", "precio")
    target = assign_ids(old, "url").select("id_house", "url", "fecha", "titulo", "precio")
    # Keys arrive with blanks around them and dates as text.
    batch = rows.filter(F.col("batch_id") == "b2").select(
        F.concat(F.lit(" "), F.col("url"), F.lit(" ")).alias("url"), F.col("fecha").cast("string").alias("fecha"), "titulo", "precio"
    )
    return flows.dedup_merge(batch, target, "b2").rows.withColumnRenamed("_action", "action")


# Keyed rows with their JSON columns.
KEYED_ROWS = cte("v_located") + """
select o_orderkey as id_house, fecha, url, titulo, constructor,
 concat('{"Estado": "', estado, '", "Estrato": "', estrato, '", "Financiación": "', financiacion,
  '", "Pisos interiores": "', pisos, '"}') as item,
 case when has_info = 0 then '0' else concat('{"Tipo de Inmueble": "Casa", "Precio": "', precio, '", "Parqueaderos": "2"}') end as full_info,
 lat_lon, department, city from v_located"""


@query("pipe_silver", cte("v_located", "v_unit", "v_osm") + f""", ways as (
 select w.id, (min(n.lat) + max(n.lat)) / 2.0 as lat, (min(n.lon) + max(n.lon)) / 2.0 as lon
 from (select id, n1 as node from v_osm where type = 'way' union all select id, n2 from v_osm where type = 'way') w
 join v_osm n on n.type = 'node' and n.id = w.node group by w.id),
points as (select lat, lon, coalesce(amenity, shop, leisure) as category from v_osm
 where type = 'node' and coalesce(amenity, shop, leisure) is not null union all select lat, lon, 'park' from ways),
cells as ({COUNTS.replace('v_poi', 'points')}),
s as (select o_orderkey as id_house, url, department, city, try_cast(estrato as int) as estrato, estado,
 case when has_info = 1 then 'Casa' else tipo_txt end as tipo_de_inmueble,
 cast(has_info as int) as parqueaderos, case when financiacion = 'No disponible' then 0 else 1 end as financiacion,
 case when pisos = 'No disponible' then '1' else pisos end as pisos_interiores,
 try_cast(banos_txt as int) as banos, coalesce(try_cast(regexp_extract(hab_txt, '([0-9]+)', 1) as int), 0) as habitaciones,
 try_cast(regexp_replace(regexp_replace(const_txt, '(?i) *m2 *$', ''), '[^0-9.]', '', 'g') as double) as area_construida,
 try_cast(regexp_replace(regexp_replace(priv_txt, '(?i) *m2 *$', ''), '[^0-9.]', '', 'g') as double) as area_privada,
 try_cast(regexp_replace(case when has_info = 1 then precio else precio_txt end, '[^0-9]', '', 'g') as double) as precio,
 try_cast(regexp_extract(lat_lon, '[(]([^,]+),', 1) as double) as lat,
 try_cast(regexp_extract(lat_lon, ', *([^)]+)[)]', 1) as double) as lon
 from v_located left join v_unit on o_orderkey = l_orderkey),
h as ({hex_sql('s', '*').replace('select *, case when', 'select id_house, url, department, city, estrato, estado, tipo_de_inmueble, parqueaderos, financiacion, pisos_interiores, banos, habitaciones, area_construida, area_privada, precio, lat, lon, case when', 1)})
select h.*, """ + ", ".join(f"coalesce({c}, 0) as {c}" for c in POI) + " from h left join cells on h.hex_id = cells.hex_id")
def _(t: Tables):
    rows = t.sql(KEYED_ROWS).join(t.sql(UNIT_TEXTS).withColumnRenamed("o_orderkey", "id_house"), "id_house")
    done = flows.silver(t.spark, rows, places.poi_counts(elements(t), t.spark, CELL_KM), scratch_path(t.spark, "silver"),
                        "2025-05-01_00-00-00", settings=SETTINGS)
    return done.rows.select(
        "id_house", "url", "department", "city", "estrato", "estado", "tipo_de_inmueble", "parqueaderos", "financiacion",
        "pisos_interiores", "banos", "habitaciones", "area_construida", "area_privada", "precio", "lat", "lon", "hex_id", *POI,
    )


GOLD_VIEWS = {
    "price_by_department": ("department", {
        "total_properties": "count(*)", "avg_price": "avg(precio)", "median_price": "median(precio)",
        "min_price": "min(precio)", "max_price": "max(precio)",
    }),
    "price_by_type": ("tipo_de_inmueble", {
        "total_properties": "count(*)", "avg_price": "avg(precio)", "avg_price_per_sqm": "avg(precio_por_m2)",
    }),
    "area_analysis": ("department", {
        "avg_area": "avg(area_construida)", "avg_private_area": "avg(area_privada)", "avg_area_ratio": "avg(ratio_area)",
    }),
    "poi_analysis": ("department", {
        "avg_poi_count": "avg(poi_total)", "avg_poi_density": "avg(poi_total / area_construida)", "avg_hospitals": "avg(hospital)",
        "avg_malls": "avg(mall)", "avg_parks": "avg(park)", "avg_schools": "avg(school)",
    }),
}


def _gold_sql() -> str:
    """Every view over the features of listings with the place counts of their cell."""
    listing = "id_house, department, city, lat, lon, estrato, tipo_de_inmueble, estado, banos, habitaciones, area_construida, area_privada, precio"
    near = ", ".join(f"coalesce({c}, 0) as {c}" for c in POI)
    dataset = DATASET.replace("from v_listing", "from near").replace("select distinct ", "select distinct hospital, mall, park, school, ")
    views = "\nunion all ".join(
        f"""select '{v}' as "view", {key} as item, '{m}' as metric, round(cast({e} as double), 4) as value from g group by {key}"""
        for v, (key, metrics) in GOLD_VIEWS.items() for m, e in metrics.items()
    )
    return cte("v_listing", "v_poi") + f""", cells as ({COUNTS}),
near as (select l.*, {near} from ({hex_sql('v_listing', listing)}) l left join cells on l.hex_id = cells.hex_id),
{FEATURES.replace(DATASET, dataset)},
g as (select *, hospital + mall + park + school as poi_total from f) {views}"""


@query("pipe_gold", _gold_sql())
def _(t: Tables):
    enriched = places.enrich_poi(t.view("v_listing"), places.cell_counts(t.view("v_poi"), CELL_KM), CELL_KM)
    done = flows.gold(enriched, SETTINGS)
    long = []
    for name, (key, metrics) in GOLD_VIEWS.items():
        numbers = done.view(name).select(key, *[F.col(m).cast("double").alias(m) for m in metrics])
        long.append(numbers.unpivot([key], list(metrics), "metric", "value").select(
            F.lit(name).alias("view"), F.col(key).alias("item"), "metric", "value"
        ))
    return rounded(reduce(lambda a, b: a.unionByName(b), long), 4)


@query("run_log", """
select '2025-05-01_00-00-00' as run_id, 'listings' as source, 'success' as status, cast(count(*) as varchar) as detail from orders
union all select '2025-05-01_00-00-00', 'events', 'success', cast(count(distinct user_id) as varchar) from events
union all select '2025-05-01_00-00-00', 'places', 'failed', 'PATH_NOT_FOUND'
union all select '2025-05-01_00-00-00', '', 'partial_failure', '2 of 3 sources'""")
def _(t: Tables):
    """What each source says of itself; one of them is not there."""
    log, landed = scratch_path(t.spark, "run_log"), scratch_path(t.spark, "landed")
    files.write_csv(t.sql(RAW_ROWS), landed)
    flows.run_sources(t.spark, {
        "listings": lambda: flows.bronze(t.spark, landed, scratch_path(t.spark, "bronze")).rows.count(),
        "events": lambda: t.table("events").agg(F.count_distinct("user_id")).first()[0],
        "places": lambda: files.read_osm_json(t.spark, scratch_path(t.spark, "absent")).count(),
    }, log, "2025-05-01_00-00-00")
    code = F.regexp_extract("detail", r"\[([A-Z_]+)\]", 1)
    return t.spark.read.parquet(log).select(
        "run_id", "source", "status", F.when(F.col("status") == "failed", code).otherwise(F.col("detail")).alias("detail"))
