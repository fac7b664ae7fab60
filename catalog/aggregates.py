"""Aggregation, summary and top-k queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import Tables, cte, query
from strata.operators import aggregates, features, places, sketches, summary
from strata.plans.sizing import scratch_path

FEATURED = "select *, precio / nullif(area_construida, 0) as precio_por_m2, coalesce(area_privada / nullif(area_construida, 0), 1.0) as ratio_area from v_listing"


def rounded(df, digits: int = 2):
    """Doubles rounded, so that the order of summing does not show."""
    return df.withColumns({n: F.round(n, digits) for n, k in df.dtypes if k == "double"})


@query("agg_count_by", cte("v_poi") + "select category, count(*) as count from v_poi group by category")
def _(t: Tables):
    return aggregates.count_by(t.view("v_poi"), "category")


PIVOT_SQL = ", ".join(
    f"count(*) filter (category = '{c}') as {c}" for c in ("hospital", "mall", "park", "school")
)


@query("agg_pivot", cte("v_poi") + f"select cast(floor(lat) as bigint) as parallel, {PIVOT_SQL} from v_poi group by 1")
def _(t: Tables):
    return aggregates.pivot_counts(t.view("v_poi").withColumn("parallel", F.floor("lat")), "parallel", "category")


@query("view_price_by_department", cte("v_listing") + """
select department, count(*) as total_properties, round(avg(precio), 2) as avg_price,
 round(median(precio), 2) as median_price, round(min(precio), 2) as min_price, round(max(precio), 2) as max_price
from v_listing group by department order by avg_price desc""")
def price_by_department(t: Tables):
    return rounded(summary.price_by_department(t.view("v_listing")))


def _featured(t: Tables):
    return t.view("v_listing").transform(features.price_per_m2).transform(features.area_ratio)


@query("view_price_by_type", cte("v_listing") + f"""
select tipo_de_inmueble, count(*) as total_properties, round(avg(precio), 2) as avg_price,
 round(avg(precio_por_m2), 2) as avg_price_per_sqm from ({FEATURED}) f group by tipo_de_inmueble""")
def _(t: Tables):
    return rounded(summary.price_by_type(_featured(t)))


@query("view_area_analysis", cte("v_listing") + f"""
select department, round(avg(area_construida), 4) as avg_area, round(avg(area_privada), 4) as avg_private_area,
 round(avg(ratio_area), 4) as avg_area_ratio from ({FEATURED}) f group by department""")
def _(t: Tables):
    return rounded(summary.area_analysis(_featured(t)), 4)


@query("agg_distribution", cte("v_listing") + """
select round(min(precio), 2) as min, round(max(precio), 2) as max, round(avg(precio), 2) as avg,
 round(stddev_samp(precio), 2) as stddev from v_listing""")
def _(t: Tables):
    return rounded(aggregates.distribution(t.view("v_listing"), "precio"))


def describe_sql(column: str, source: str, digits: int = 2) -> str:
    stats = {
        "mean": f"avg({column})", "median": f"quantile_cont({column}, 0.5)", "std": f"stddev_samp({column})",
        "min": f"min({column})", "max": f"max({column})",
        "q25": f"quantile_cont({column}, 0.25)", "q75": f"quantile_cont({column}, 0.75)",
    }
    return "\nunion all ".join(
        f"""select '{column}' as "column", '{s}' as stat, round({e}, {digits}) as value from {source}""" for s, e in stats.items()
    )


@query("agg_describe", cte("v_listing") + describe_sql("precio", "v_listing") + "\nunion all " + describe_sql("area_construida", "v_listing"))
def _(t: Tables):
    return rounded(aggregates.describe_numeric(t.view("v_listing"), ["precio", "area_construida"]))


def counts_sql(columns, source: str) -> str:
    return "\nunion all ".join(
        f"""select '{c}' as "column", cast({c} as varchar) as value, count(*) as count from {source} where {c} is not null group by {c}"""
        for c in columns
    )


@query("agg_value_counts", cte("v_listing") + counts_sql(["department", "estrato", "tipo_de_inmueble", "estado"], "v_listing"))
def _(t: Tables):
    return aggregates.value_counts(t.view("v_listing"), ["department", "estrato", "tipo_de_inmueble", "estado"])


CORRELATED = ["estrato", "banos", "habitaciones", "area_construida", "area_privada", "precio", "lat", "lon"]


@query("agg_correlations", cte("v_listing") + "\nunion all ".join(
    f"""select '{c}' as "column", round(corr({c}, precio), 6) as correlation from v_listing""" for c in CORRELATED
))
def _(t: Tables):
    return rounded(aggregates.correlate(t.view("v_listing"), "precio", CORRELATED), 6)


@query("agg_distinct_stats", cte("v_listing") + """
select count(*) as total_records, count(distinct url) as unique_url,
 count(distinct department) as unique_department, count(distinct city) as unique_city from v_listing""")
def _(t: Tables):
    return aggregates.distinct_stats(t.view("v_listing"), ["url", "department", "city"])


@query("topk_cities", cte("v_listing") + "select city, count(*) as count from v_listing group by city order by count desc, city limit 10")
def _(t: Tables):
    return aggregates.top_k(t.view("v_listing"), "city", 10)


@query("geo_bbox_midpoint", cte("v_poi") + """
select category, (min(lat) + max(lat)) / 2.0 as lat, (min(lon) + max(lon)) / 2.0 as lon from v_poi group by category""")
def _(t: Tables):
    return places.bbox_midpoint(t.view("v_poi"), "category")


@query("eda_histogram", cte("v_batch") + """, m as (select min(precio) as lo, max(precio) as hi from v_batch),
w as (select lo, hi, (hi - lo) / 20 as width from m),
s as (select cast(least(floor((precio - lo) / width), 19) as int) as bin, lo, width from v_batch, w)
select bin, round(lo + bin * width, 6) as low, round(lo + (bin + 1) * width, 6) as high, count(*) as count
from s group by bin, lo, width""")
def _(t: Tables):
    return rounded(aggregates.histogram(t.view("v_batch").select("precio"), "precio", 20), 6)


@query("first_n_listings", cte("v_listing") + "select id_house, url, precio from v_listing order by precio desc, id_house limit 25")
def _(t: Tables):
    """The first rows of an order are the feature."""
    return aggregates.first_n(t.view("v_listing").select("id_house", "url", "precio"), 25, F.desc("precio"), F.asc("id_house"))


@query("agg_distinct_merged", cte("v_batch") + """
select 'url' as "column", count(*) as rows, count(url) as filled, true as close from v_batch
union all select 'event_id', count(*), count(event_id), true from v_batch
union all select 'precio', count(*), count(precio), true from v_batch""")
def _(t: Tables):
    """Sketches of each batch are written, then only they are read; ``close`` says that the
    estimate is within 3 % of the exact count."""
    path, columns = scratch_path(t.spark, "sketches"), ["url", "event_id", "precio"]
    rows = t.view("v_batch")
    for batch in ("b1", "b2"):
        sketches.write_sketches(rows.filter(F.col("batch_id") == batch), columns, path, batch)
    merged = sketches.merged_distinct(sketches.read_sketches(t.spark, path))
    exact = rows.agg(*[F.count_distinct(c).alias(c) for c in columns]).select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("exact")) for c in columns])))
    close = F.abs(F.col("distinct") - F.col("exact")) * 100 <= 3 * F.col("exact")
    return merged.join(F.broadcast(exact), "column").select("column", "rows", "filled", close.alias("close"))
