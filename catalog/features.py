"""Feature, encoding and data set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.aggregates import counts_sql, describe_sql, rounded
from catalog.base import Tables, cte, query
from strata.operators import features, summary

BOUNDS = {"price_bounds": (100_000, 400_000), "area_bounds": (20, 200)}
DATASET_COLUMNS = (
    "department, city, lat, lon, estrato, tipo_de_inmueble, estado, banos, habitaciones, area_construida, area_privada, precio"
)


def _feature(name: str, step, sql: str, *columns: str):
    @query(name, cte("v_listing") + f"select id_house, {sql} from v_listing")
    def _(t: Tables):
        return step(t.view("v_listing")).select("id_house", *columns)


_feature("feat_price_per_m2", features.price_per_m2, "precio / area_construida as precio_por_m2", "precio_por_m2")
_feature(
    "feat_area_ratio", features.area_ratio,
    "coalesce(area_privada / nullif(area_construida, 0), 1.0) as ratio_area", "ratio_area",
)
_feature(
    "feat_interactions", features.interactions,
    "estrato * area_construida as estrato_area, habitaciones * banos as habitaciones_banos", "estrato_area", "habitaciones_banos",
)
_feature("feat_latlon", features.lat_lon_product, "lat * lon as lat_lon_combined", "lat_lon_combined")
_feature(
    "feat_price_per_room", features.price_per_room,
    "coalesce(precio / nullif(habitaciones, 0), precio) as precio_por_habitacion", "precio_por_habitacion",
)
_feature(
    "feat_area_per_room", features.area_per_room,
    "coalesce(area_construida / nullif(habitaciones, 0), area_construida) as area_por_habitacion", "area_por_habitacion",
)


@query("feat_poi_density", cte("v_listing") + """
select id_house, cast(estrato + banos as bigint) as poi_total,
 coalesce((estrato + banos) / nullif(area_construida, 0), 0.0) as poi_density from v_listing""")
def _(t: Tables):
    counted = t.view("v_listing").withColumnsRenamed({"estrato": "hospital", "banos": "school"})
    return features.poi_density(counted).select("id_house", "poi_total", "poi_density")


@query("feat_label_encode", cte("v_listing") + """
select id_house, (dense_rank() over (order by city)) - 1 as city,
 (dense_rank() over (order by tipo_de_inmueble)) - 1 as tipo_de_inmueble from v_listing""")
def _(t: Tables):
    return features.label_encode(
        t.view("v_listing").select("id_house", "city", "tipo_de_inmueble"), ["city", "tipo_de_inmueble"]
    )


@query("feat_one_hot", cte("v_listing") + """
select id_house, case when estado = 'O' then 1 else 0 end as "estado_O", case when estado = 'P' then 1 else 0 end as "estado_P",
 case when department = 'AMERICA' then 1 else 0 end as "department_AMERICA",
 case when department = 'ASIA' then 1 else 0 end as "department_ASIA",
 case when department = 'EUROPE' then 1 else 0 end as "department_EUROPE",
 case when department = 'MIDDLE EAST' then 1 else 0 end as "department_MIDDLE EAST" from v_listing""")
def _(t: Tables):
    return features.one_hot(t.view("v_listing").select("id_house", "estado", "department"), ["estado", "department"])


@query("feat_one_hot_sparse", cte("v_listing") + """
select id_house, 'url' as "column", url as value from v_listing where url <> (select min(url) from v_listing)
union all select id_house, 'estado', estado from v_listing where estado <> (select min(estado) from v_listing)""")
def _(t: Tables):
    """As many categories as listings; read back by the names of the slots."""
    rows, slots = features.one_hot_sparse(t.view("v_listing").select("id_house", "url", "estado"), ["url", "estado"])
    return rows.select("id_house", F.explode("hot").alias("slot")).join(slots, "slot").select("id_house", "column", "value")


DATASET = f"""select distinct {DATASET_COLUMNS} from v_listing
where precio between 100000 and 400000 and area_construida between 20 and 200"""


@query("gold_dataset", cte("v_listing") + DATASET)
def _(t: Tables):
    return features.gold_dataset(t.view("v_listing"), **BOUNDS)


FEATURES = f"""d as ({DATASET}), q as (select quantile_cont(precio, 0.25) as q1, quantile_cont(precio, 0.75) as q3 from d),
f as (select d.*, precio / area_construida as precio_por_m2, area_privada / area_construida as ratio_area,
 estrato * area_construida as estrato_area, habitaciones * banos as habitaciones_banos, lat * lon as lat_lon_combined,
 precio / habitaciones as precio_por_habitacion, area_construida / habitaciones as area_por_habitacion
 from d, q where precio between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))"""


@query("gold_features", cte("v_listing") + f", {FEATURES} select * from f")
def _(t: Tables):
    return features.gold_features(t.view("v_listing"), **BOUNDS)


NUMERIC = ["lat", "lon", "estrato", "banos", "habitaciones", "area_construida", "area_privada", "precio"]


def summary_sql(source: str, columns: int, numeric) -> str:
    """The summary of a relation with the given number of columns, without its bytes."""
    return f"""select 'dataset_info' as section, '' as "column", 'total_records' as item, cast(count(*) as double) as value from {source}
union all select 'dataset_info', '', 'total_columns', {columns}.0
union all select 'analytics', "column", stat, value from ({describe_sql('precio', source, 4)}
union all {describe_sql('area_construida', source, 4)}) x
union all select 'counts', "column", value, cast(count as double) from ({counts_sql(['department', 'estrato', 'tipo_de_inmueble', 'estado'], source)}) y
union all select * from (select 'counts', 'city', city, cast(count(*) as double) from {source} group by city order by count(*) desc, city limit 10) z
union all """ + "\nunion all ".join(
        f"select 'correlation', 'precio', '{c}', round(corr({c}, precio), 4) from {source}" for c in numeric
    )


@query("gold_summary", cte("v_listing") + f", d as ({DATASET}) " + summary_sql("d", 12, NUMERIC))
def _(t: Tables):
    return rounded(summary.summary(features.gold_dataset(t.view("v_listing"), **BOUNDS)).filter("item <> 'total_bytes'"), 4)
