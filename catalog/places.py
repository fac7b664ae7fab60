"""Geo and point-of-interest queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.aggregates import PIVOT_SQL, rounded
from catalog.base import Tables, cte, query
from strata.functions import geo
from strata.operators import features, places, summary

CELL_KM = 20.0
POI = ("hospital", "mall", "park", "school")


def hex_sql(source: str, keep: str) -> str:
    """The cell formula, written out for the other engine; keeps the named columns."""
    return f"""select {keep}, case when lat is null or lon is null then null else
 concat(cast(case when dq > dr and dq > ds then -r - s else q end as bigint), ':',
  cast(case when not (dq > dr and dq > ds) and dr > ds then -q - s else r end as bigint)) end as hex_id
from (select *, abs(q - qf) as dq, abs(r - rf) as dr, abs(s - sf) as ds
from (select *, floor(qf + 0.5) as q, floor(rf + 0.5) as r, floor(sf + 0.5) as s
from (select *, -qf - rf as sf
from (select *, (cast(0.5773502691896257 as double) * x - y / cast(3.0 as double)) / cast(20.0 as double) as qf,
 (cast(0.6666666666666666 as double) * y) / cast(20.0 as double) as rf
from (select *, lon * cast(111.1949 as double) * cast(0.9945218953682733 as double) as x, lat * cast(111.1949 as double) as y
 from {source}) h1) h2) h3) h4) h5"""


@query("geo_hex_cell", cte("v_poi") + hex_sql("v_poi", "id"))
def _(t: Tables):
    return t.view("v_poi").select("id", geo.hex_cell(F.col("lat"), F.col("lon"), CELL_KM).alias("hex_id"))


COUNTS = f"select hex_id, {PIVOT_SQL} from ({hex_sql('v_poi', 'category')}) x group by hex_id"


@query("join_poi_cell", cte("v_listing", "v_poi") + f""", cells as ({COUNTS})
select id_house, l.hex_id, """ + ", ".join(f"coalesce({c}, 0) as {c}" for c in POI) + f"""
from ({hex_sql('v_listing', 'id_house')}) l left join cells on l.hex_id = cells.hex_id""")
def _(t: Tables):
    counts = places.cell_counts(t.view("v_poi"), CELL_KM)
    return places.enrich_poi(t.view("v_listing"), counts, CELL_KM).select("id_house", "hex_id", *POI)


@query("join_broadcast_left", cte("v_listing") + """
select id_house, v_listing.city, coalesce(suppliers, 0) as suppliers from v_listing
left join (select n_name as city, count(*) as suppliers from supplier join nation on s_nationkey = n_nationkey group by n_name) d
on v_listing.city = d.city""")
def _(t: Tables):
    dim = t.sql("""select n_name as city, count(*) as suppliers from supplier
        join nation on s_nationkey = n_nationkey group by n_name""")
    return places.enrich(t.view("v_listing"), dim, "city", ["suppliers"]).select("id_house", "city", "suppliers")


def elements(t: Tables):
    """Map elements as the document reader gives them."""
    return t.view("v_osm").select(
        "type", "id", "lat", "lon",
        F.when(F.col("type") == "way", F.array("n1", "n2")).alias("nodes"),
        F.struct("amenity", "shop", "leisure").alias("tags"),
    )


WAYS = """select w.id, (min(n.lat) + max(n.lat)) / 2.0 as lat, (min(n.lon) + max(n.lon)) / 2.0 as lon
from (select id, n1 as node from v_osm where type = 'way' union all select id, n2 from v_osm where type = 'way') w
join v_osm n on n.type = 'node' and n.id = w.node group by w.id"""


@query("join_way_nodes", cte("v_osm") + WAYS)
def _(t: Tables):
    return places.way_geometry(elements(t))


LOCATED = f"""select lat, lon, coalesce(amenity, shop, leisure) as category from v_osm
 where type = 'node' and coalesce(amenity, shop, leisure) is not null
union all select lat, lon, 'park' from ({WAYS}) y"""


@query("geo_poi_counts", cte("v_osm") + f"""select hex_id, {PIVOT_SQL} from (
{hex_sql('(' + LOCATED + ') z', 'category')}) x group by hex_id""")
def _(t: Tables):
    return places.poi_counts(elements(t), t.spark, CELL_KM)


BOXES = """select id, concat('/api?data=[out:json];(', cast(lat as string), ',', cast(lon as string), ', ',
 cast(lat + 1 as string), ',', cast(lon + 1 as string), ');out;') as url from v_poi"""


@query("geo_bbox_from_url", cte("v_poi") + """
select id, (lat + (lat + 1)) / 2.0 as lat, (lon + (lon + 1)) / 2.0 as lon from v_poi""")
def _(t: Tables):
    requests = t.sql(cte("v_poi") + BOXES)
    return requests.withColumn("box", geo.box_midpoint(F.col("url"))).select("id", "box.lat", "box.lon")


@query("view_poi_analysis", cte("v_listing", "v_poi") + f""", cells as ({COUNTS}),
j as (select department, area_construida, """ + ", ".join(f"coalesce({c}, 0) as {c}" for c in POI) + f"""
from ({hex_sql('v_listing', 'department, area_construida')}) l left join cells on l.hex_id = cells.hex_id),
f as (select *, hospital + mall + park + school as poi_total from j)
select department, round(avg(poi_total), 4) as avg_poi_count,
 round(avg(coalesce(poi_total / nullif(area_construida, 0), 0)), 4) as avg_poi_density,
 round(avg(hospital), 4) as avg_hospitals, round(avg(mall), 4) as avg_malls,
 round(avg(park), 4) as avg_parks, round(avg(school), 4) as avg_schools from f group by department""")
def _(t: Tables):
    counts = places.cell_counts(t.view("v_poi"), CELL_KM)
    enriched = places.enrich_poi(t.view("v_listing"), counts, CELL_KM)
    return rounded(summary.poi_analysis(features.poi_density(enriched)), 4)
