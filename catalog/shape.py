"""Projection, filter, set and quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import Tables, cte, query
from strata.operators import aggregates, filters, places, projection, quality


@query("proj_rename", "select o_orderkey as id_house, o_totalprice as precio, o_orderstatus as estado from orders")
def _(t: Tables):
    names = {"o_orderkey": "id_house", "o_totalprice": "precio", "o_orderstatus": "estado"}
    return projection.rename(t.table("orders").select(*names), names)


@query("proj_standardize_names", """
select o_orderkey as "Id_Casa", o_totalprice as "Area_Construida", o_orderpriority as "Tipo_de_Inmueble" from orders""")
def _(t: Tables):
    orders = t.table("orders").select(
        F.col("o_orderkey").alias("Id Casa "), F.col("o_totalprice").alias("'Área Construida'"),
        F.col("o_orderpriority").alias("Tipo de Inmueble"),
    )
    return projection.standardize_names(orders, ascii_only=True)


@query("proj_split_location", """
select c_custkey, n_name as city, r_name as department from customer
join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")
def _(t: Tables):
    crawled = t.sql("""select c_custkey, concat(n_name, '/', r_name) as path from customer
        join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")
    return projection.with_location(crawled, "path").drop("path")


@query("proj_select_existing", """
select o_orderkey as "O_ORDERKEY", o_totalprice as "O_TotalPrice" from orders""")
def _(t: Tables):
    return projection.select_existing(t.table("orders"), ["O_ORDERKEY", "absent", "O_TotalPrice"])


@query("proj_flatten_struct", """
select o_orderkey, o_orderstatus as estado, o_totalprice as area_construida from orders""")
def _(t: Tables):
    nested = t.table("orders").select(
        "o_orderkey",
        F.struct(F.col("o_orderstatus").alias("Estado"), F.col("o_totalprice").alias("Área Construida")).alias("full_info"),
    )
    return projection.flatten_struct(nested, "full_info")


@query("proj_coalesce_priority", cte("v_raw") + """
select id_house, coalesce(financiacion_txt, hab_txt, estrato_txt) as first_text,
 coalesce(hab_txt, area_txt) as size_text from v_raw""")
def _(t: Tables):
    filled = projection.coalesce_sources(t.view("v_raw"), {
        "first_text": ["financiacion_txt", "hab_txt", "estrato_txt"], "size_text": ["hab_txt", "area_txt"],
    })
    return filled.select("id_house", "first_text", "size_text")


@query("flt_require_key", cte("v_raw") + """
select id_house, estrato_txt, hab_txt from v_raw
where estrato_txt is not null and trim(estrato_txt) <> '' and hab_txt is not null and trim(hab_txt) <> ''""")
def _(t: Tables):
    return filters.require_key(t.view("v_raw"), ["estrato_txt", "hab_txt"]).select("id_house", "estrato_txt", "hab_txt")


@query("flt_range", cte("v_listing") + """
select id_house, precio, area_construida from v_listing
where precio between 100000 and 400000 and area_construida between 20 and 200""")
def _(t: Tables):
    bounds = {"precio": (100_000, 400_000), "area_construida": (20, 200)}
    return filters.in_range(t.view("v_listing"), bounds).select("id_house", "precio", "area_construida")


@query("flt_dropna", cte("v_raw") + """
select id_house, hab_txt, financiacion_txt from v_raw where hab_txt is not null and financiacion_txt is not null""")
def _(t: Tables):
    return filters.drop_nulls(t.view("v_raw"), ["hab_txt", "financiacion_txt"]).select("id_house", "hab_txt", "financiacion_txt")


@query("flt_iqr", cte("v_batch") + """, q as (select quantile_cont(precio, 0.25) as q1, quantile_cont(precio, 0.75) as q3 from v_batch)
select event_id, precio from v_batch, q
where precio >= q1 - 1.5 * (q3 - q1) and precio <= q3 + 1.5 * (q3 - q1)""")
def _(t: Tables):
    return filters.iqr_filter(t.view("v_batch").select("event_id", "precio"), "precio")


@query("flt_poi_tags", cte("v_osm") + """
select type, id from v_osm where type in ('node', 'way')
and (amenity in ('hospital', 'school') or shop = 'mall' or leisure = 'park')""")
def _(t: Tables):
    elements = t.view("v_osm").withColumn("tags", F.struct("amenity", "shop", "leisure"))
    return filters.poi_tag_filter(elements).select("type", "id")


@query("flt_batch_stats", cte("v_batch") + """
select count(*) as total_records, count(distinct url) as unique_url from v_batch where batch_id = 'b2'""")
def _(t: Tables):
    batch = t.view("v_batch").filter(F.col("batch_id") == "b2")
    return aggregates.distinct_stats(batch, ["url"])


@query("set_distinct", cte("v_batch") + "select distinct url, titulo, batch_id from v_batch")
def _(t: Tables):
    return aggregates.distinct_rows(t.view("v_batch").select("url", "titulo", "batch_id"))


@query("set_append", """
select c_custkey as id, c_name as name, 'customer' as kind from customer
union all select s_suppkey, s_name, 'supplier' from supplier
union all select p_partkey, p_name, 'part' from part""")
def _(t: Tables):
    kinds = (("customer", "c_custkey", "c_name"), ("supplier", "s_suppkey", "s_name"), ("part", "p_partkey", "p_name"))
    return projection.append(
        t.table(k).select(F.col(i).alias("id"), F.col(n).alias("name"), F.lit(k).alias("kind")) for k, i, n in kinds
    )


@query("set_union_poi", cte("v_osm") + "select distinct type, id from v_osm")
def _(t: Tables):
    elements = t.view("v_osm")
    nodes, ways = (elements.filter(F.col("type") == k).select("type", "id") for k in ("node", "way"))
    # Ways come twice, as they do when two categories of the search match one element.
    return places.union_poi(nodes, ways.union(ways))


@query("schema_evolution_union", """
select o_orderkey as id, o_orderstatus as estado, cast(null as double) as precio from orders
union all select o_orderkey, cast(null as varchar), o_totalprice from orders""")
def _(t: Tables):
    orders = t.table("orders")
    old = orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("estado"))
    new = orders.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("precio"))
    return projection.union_evolved(old, new)


@query("lineage_batch_counts", """
select '2025-05-01_12-00-00' as batch_id, concat('city/', o_orderpriority) as source_file, count(*) as records
from orders group by o_orderpriority""")
def _(t: Tables):
    stamped = projection.lineage(
        t.table("orders").select("o_orderpriority"), F.concat(F.lit("city/"), F.col("o_orderpriority")), "2025-05-01_12-00-00"
    )
    return stamped.groupBy("batch_id", "source_file").agg(F.count("ingestion_timestamp").alias("records"))


@query("dq_contract", cte("v_listing") + """
select 'column:url' as "check", true as passed union all select 'column:FECHA', true
union all select 'column:absent', false
union all select 'not_empty', count(*) > 0 from v_listing""")
def _(t: Tables):
    return quality.validate(t.view("v_listing"), ["url", "FECHA", "absent"])


@query("dq_dataset_info", cte("v_listing") + """
select count(*) as total_records, cast(15 as bigint) as total_columns from v_listing""")
def _(t: Tables):
    return quality.profile_shape(t.view("v_listing")).select("total_records", "total_columns")


RAW_TEXT = ["url", "precio_txt", "area_txt", "hab_txt", "financiacion_txt", "estrato_txt", "lat_lon"]


def _union(view: str, rows: list[str]) -> str:
    return cte(view) + "\nunion all ".join(rows)


def _null_sql(columns, view="v_raw", metric=False):
    head = "'null_count' as metric, " if metric else ""
    return [
        f"""select {head}'{c}' as "column", count(*) filter ({c} is null) as value from {view}""" for c in columns
    ]


def _empty_sql(columns, view="v_raw", metric=False):
    head = "'empty_count' as metric, " if metric else ""
    return [
        f"""select {head}'{c}' as "column", count(*) filter ({c} is null or {c} = '') as value from {view}""" for c in columns
    ]


@query("dq_null_counts", _union("v_raw", _null_sql(["id_house", *RAW_TEXT])))
def _(t: Tables):
    return quality.null_counts(t.view("v_raw"))


@query("dq_empty_counts", _union("v_raw", _empty_sql(RAW_TEXT)))
def _(t: Tables):
    return quality.empty_counts(t.view("v_raw"))


DUPLICATED = "select url, titulo, batch_id from v_batch"


@query("dq_duplicate_rows", cte("v_batch") + f""", d as (select distinct * from ({DUPLICATED}) x)
select (select count(*) from v_batch) as total_rows,
 (select count(*) from v_batch) - (select count(*) from d) as duplicate_rows""")
def _(t: Tables):
    return quality.duplicate_rows(t.view("v_batch").select("url", "titulo", "batch_id"))


@query("dq_outlier_counts", cte("v_listing") + """
select 'precio' as "column", count(*) filter (precio < 100000 or precio > 400000) as value from v_listing
union all select 'area_construida', count(*) filter (area_construida < 20 or area_construida > 200) from v_listing""")
def _(t: Tables):
    return quality.outlier_counts(t.view("v_listing"), {"precio": (100_000, 400_000), "area_construida": (20, 200)})


@query("dq_report", cte("v_raw") + """, d as (select distinct * from v_raw)
select 'total_rows' as metric, '' as "column", count(*) as value from v_raw
union all select 'duplicate_rows', '', (select count(*) from v_raw) - (select count(*) from d)
union all """ + "\nunion all ".join(
    _null_sql(["id_house", *RAW_TEXT], metric=True) + _empty_sql(RAW_TEXT, metric=True)
) + """
union all select 'outlier_count', 'estrato_txt',
 count(*) filter (try_cast(estrato_txt as double) < 2 or try_cast(estrato_txt as double) > 5) from v_raw""")
def _(t: Tables):
    return quality.quality_report(t.view("v_raw"), {"estrato_txt": (2, 5)})


@query("dq_duplication_stats", cte("v_batch") + """
select count(*) as total_records, count(distinct url) as unique_records,
 count(*) - count(distinct url) as duplicate_records,
 cast(count(*) - count(distinct url) as double) / count(*) as duplicate_ratio,
 cast(count(*) - count(distinct url) as double) / count(*) > 0.5 as alert from v_batch""")
def _(t: Tables):
    return aggregates.duplication_stats(t.view("v_batch"), "url")


@query("dq_top_duplicates", cte("v_batch") + """
select url, count(*) as count from v_batch group by url having count(*) > 1 order by count desc, url limit 10""")
def _(t: Tables):
    return aggregates.top_duplicates(t.view("v_batch"), "url")


@query("dq_by_window", """
select date_trunc('hour', ts) as window_start, count(*) as records, count(*) filter (value is null) as nulls,
 min(value) as low, max(value) as high from events group by 1""")
def _(t: Tables):
    return quality.quality_by_window(t.table("events"), "ts", "value", "1 hour")


@query("dq_volume_anomaly", """
with c as (select cast(ts as date) as batch, count(*) as records from events group by 1),
w as (select batch, records, lag(records) over (order by batch) as previous,
 avg(records) over e as mean, stddev_samp(records) over e as deviation
 from c window e as (order by batch rows between unbounded preceding and 1 preceding))
select batch, records, previous, round(mean, 4) as mean, round(deviation, 4) as deviation,
 coalesce(abs(records - mean) > 2.0 * deviation, false) as anomaly from w""")
def _(t: Tables):
    days = t.table("events").select(F.to_date("ts").alias("day"))
    return quality.volume_anomaly(days, "day", 2.0).withColumns(
        {"mean": F.round("mean", 4), "deviation": F.round("deviation", 4)}
    )
