"""Source and sink queries: each writes a whole derived table and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.aggregates import rounded
from catalog.base import Tables, cte, query
from catalog.features import BOUNDS
from catalog.places import elements
from strata.functions.geo import morton
from strata.operators import features, summary
from strata.operators.projection import rename
from strata.plans.sizing import materialize, measured, scratch_path
from strata.sources import files, layout, snapshots, variants

# A raw listing file: multi-line JSON cells with quotes and commas in them.
RAW_ROWS = cte("v_text") + """
select fecha as Fecha, url as URL, titulo as `Título`, constructor as Constructor,
 concat('{', chr(10), '  "Estado": "', estado, '",', chr(10), '  "Estrato": "', estrato, '"', chr(10), '}') as Item,
 '[]' as Unidades, '0' as full_info, concat('Calle ', estrato) as Direccion_Principal,
 'No disponible' as Direccion_Asociadas, lat_lon as `lat/lon` from v_text"""
RAW_BACK = cte("v_text") + """
select fecha, url, titulo, constructor,
 concat('{', chr(10), '  "Estado": "', estado, '",', chr(10), '  "Estrato": "', estrato, '"', chr(10), '}') as item,
 '[]' as unidades, '0' as full_info, concat('Calle ', estrato) as direccion_principal,
 'No disponible' as direccion_asociadas, lat_lon from v_text"""


@query("src_csv_roundtrip", RAW_BACK)
def _(t: Tables):
    path = scratch_path(t.spark, "raw_csv")
    files.write_csv(t.sql(RAW_ROWS), path)
    return rename(files.read_listings_csv(t.spark, path))


@query("src_csv_quoted", cte("v_text") + "select url, titulo, lat_lon from v_text")
def _(t: Tables):
    path = scratch_path(t.spark, "spaced_csv")
    # Lines with a blank after each delimiter, as some tools write them.
    line = F.concat(*[
        F.concat(F.lit(before), F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
        for before, c in (("", F.col("url")), (", ", F.col("titulo")), (", ", F.col("lat_lon")))
    ])
    t.view("v_text").select(line.alias("value")).write.text(path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("url", "titulo", "lat_lon")])
    return files.read_quoted_csv(t.spark, path, schema, header=False)


# A record per order as a line of a landed file; some lost cells, some have one too many.
BROKEN = "case when o_orderkey % 11 = 0 then 'too few cells' when o_orderkey % 13 = 0 then 'too many cells' end"


@query("src_csv_refused", cte("v_text") + f"""
select url, {BROKEN} as reason, case when {BROKEN} is null then titulo end as titulo, true as has_file from v_text""")
def _(t: Tables):
    """Read and refused records together are what landed."""
    path = scratch_path(t.spark, "broken_csv")
    cell = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    whole = [F.col("url"), F.col("titulo"), F.concat("constructor", F.lit("\n"), "estado"), F.col("lat_lon")]
    line = (
        F.when(F.expr(BROKEN) == "too few cells", F.concat_ws(",", *map(cell, whole[:2])))
        .when(F.expr(BROKEN) == "too many cells", F.concat_ws(",", *map(cell, [*whole, F.col("estrato")])))
        .otherwise(F.concat_ws(",", *map(cell, whole)))
    )
    t.view("v_text").select(line.alias("value")).repartition(4).write.option("lineSep", "\n").text(path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("url", "titulo", "detail", "lat_lon")])
    checked = files.read_checked_csv(t.spark, path, schema, header=False).withColumn("_file", F.col("_metadata.file_path"))
    landed = materialize(checked)
    read = landed.filter(F.col(files.CORRUPT).isNull()).select("url", F.lit(None).cast("string").alias("reason"), "titulo", F.lit(True).alias("has_file"))
    refused = files.refused_rows(landed, "_file", "lat_lon")
    url = F.regexp_extract("record", '^\\s*"([^"]*)"', 1)
    return read.unionByName(refused.select(url.alias("url"), "reason", F.lit(None).cast("string").alias("titulo"), F.col("file").endswith(".txt").alias("has_file")))


@query("src_osm_json", cte("v_osm") + "select type, id, lat, lon, amenity, shop, leisure, n1, n2 from v_osm")
def _(t: Tables):
    path = scratch_path(t.spark, "osm_json")
    # A document holds a bounded number of neighbouring elements.
    documents = elements(t).groupBy(F.floor(F.col("id") / 5_000).alias("doc"), "type").agg(
        F.to_json(F.struct(F.collect_list(F.struct("type", "id", "lat", "lon", "nodes", "tags")).alias("elements"))).alias("value")
    )
    documents.withColumnRenamed("type", "kind").write.partitionBy("doc", "kind").text(path)
    read = files.read_osm_json(t.spark, [f"{path}/*/*"])
    return read.select(
        "type", "id", "lat", "lon", "tags.amenity", "tags.shop", "tags.leisure",
        F.get("nodes", F.lit(0)).alias("n1"), F.get("nodes", F.lit(1)).alias("n2"),
    )


LISTING = "select id_house, url, department, city, precio from v_listing"


def _listing(t: Tables):
    return t.view("v_listing").select("id_house", "url", "department", "city", "precio")


@query("src_snapshot", cte("v_listing") + LISTING)
def _(t: Tables):
    table = scratch_path(t.spark, "listing")
    snapshots.write_snapshot(_listing(t), table, "2025-05-01_00-00-00")
    return snapshots.read_snapshot(t.spark, table)


@query("sink_snapshot_latest", cte("v_listing") + "select id_house, url, department, city, precio * 2 as precio from v_listing")
def _(t: Tables):
    table = scratch_path(t.spark, "listing")
    snapshots.write_snapshot(_listing(t), table, "2025-05-01_00-00-00")
    snapshots.write_snapshot(_listing(t).withColumn("precio", F.col("precio") * 2), table, "2025-05-02_00-00-00")
    return snapshots.read_snapshot(t.spark, table)


@query("sink_partitioned_prune", cte("v_listing") + LISTING + " where department = 'ASIA'")
def _(t: Tables):
    path = scratch_path(t.spark, "partitioned")
    files.write_partitioned(_listing(t), path)
    # Reading one partition is the feature: the other folders are not opened.
    return t.spark.read.parquet(path).filter(F.col("department") == "ASIA")


@query("sink_csv_by_city", cte("v_listing") + "select url, city, cast(id_house as varchar) as id_house from v_listing")
def _(t: Tables):
    path = scratch_path(t.spark, "by_city")
    files.write_csv(_listing(t).select("id_house", "url", "city"), path, ["city"])
    return t.spark.read.option("header", True).csv(path).select("url", "city", F.col("id_house").cast("string").alias("id_house"))


@query("summary_as_json")
def _(t: Tables):
    path = scratch_path(t.spark, "summary")
    files.write_json_rows(rounded(summary.summary(features.gold_dataset(t.view("v_listing"), **BOUNDS))), path)
    return t.spark.read.text(path)


@query("layout_zorder_code", cte("v_poi") + "select id, " + " + ".join(
    f"((({c}) >> {b}) & 1) * {1 << (2 * b + i)}" for i, c in enumerate(("a", "b")) for b in range(8)
) + """ as z from (select id, cast(greatest(0, least(255, floor((lat - 4.0) * 256.0 / 11.0))) as bigint) as a,
 cast(greatest(0, least(255, floor((lon - -76.0) * 256.0 / 6.0))) as bigint) as b from v_poi) x""")
def _(t: Tables):
    codes = [layout.width_code(F.col("lat"), 4.0, 15.0, 8), layout.width_code(F.col("lon"), -76.0, -70.0, 8)]
    return t.view("v_poi").select("id", morton(codes, 8).alias("z"))


@query("layout_clustered_rows", cte("v_batch") + "select url, fecha, titulo, event_id, precio, batch_id from v_batch")
def _(t: Tables):
    """Clustering by text and time moves rows and loses none."""
    path = scratch_path(t.spark, "clustered")
    rows, size = measured(t.view("v_batch"))
    layout.compact(rows, path, ["url", "fecha"], total_bytes=size)
    return t.spark.read.parquet(path)


@query("layout_clustered_hot", """
select count(*) as rows, true as balanced, count(distinct case when event_id % 3 = 0 then '/u/hot' else concat('/u/', cast(user_id as string)) end) as urls
from events""")
def _(t: Tables):
    """A third of the rows have one text; still no file is above 1.5 times its share."""
    path = scratch_path(t.spark, "clustered")
    hot = t.view("v_batch").withColumn("url", F.when(F.col("event_id") % 3 == 0, "/u/hot").otherwise(F.col("url")))
    rows, size = measured(hot.select("url", "titulo", "event_id"))
    layout.compact(rows, path, ["url", "titulo"], total_bytes=size, file_bytes=max(1, size // 12))
    read = t.spark.read.parquet(path).withColumn("file", F.col("_metadata.file_path"))
    each = read.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    return each.agg(F.sum("n").alias("rows"), (F.max("n") <= 1.5 * F.avg("n")).alias("balanced")).select(
        "rows", "balanced", read.agg(F.count_distinct("url").alias("urls")).scalar().alias("urls"))


# JSON columns of a listing: an object, an object that may be missing, and units as blocks
# or, on odd orders, as an array of JSON texts.
VARIANT_ROWS = cte("v_located", "v_unit") + """, u as (select l_orderkey,
  array_sort(collect_list(struct(l_linenumber, precio_txt, const_txt))) as units from v_unit group by l_orderkey)
select url, department, to_json(named_struct('Estado', estado, 'Estrato', cast(estrato as int))) as item,
 case when has_info = 1 then to_json(named_struct('Precio', precio)) when o_orderkey % 2 = 0 then 'not json' end as full_info,
 case when o_orderkey % 2 = 0 then to_json(transform(units, u -> named_struct('m² const.', u.const_txt, 'Precio', u.precio_txt)))
  else to_json(transform(units, u -> to_json(named_struct('m² const.', u.const_txt, 'Precio', u.precio_txt)))) end as unidades
from v_located left join u on o_orderkey = l_orderkey"""


@query("json_variant_roundtrip", cte("v_located", "v_unit") + """
select url, department, estado, cast(estrato as int) as estrato, case when has_info = 1 then precio end as precio,
 cast(row_number() over (partition by o_orderkey order by l_linenumber, precio_txt, const_txt) - 1 as int) as pos, const_txt as area, precio_txt as precio_unidad,
 case when has_info <> 1 and o_orderkey % 2 = 0 then 'not json' end as refused
from v_located join v_unit on o_orderkey = l_orderkey""")
def _(t: Tables):
    path = scratch_path(t.spark, "variants")
    variants.write_variants(t.sql(VARIANT_ROWS), ["item", "full_info", "unidades"], path, refused="refused")
    back = t.spark.read.parquet(path)
    named = back.select(
        "url", "department", "unidades", F.col("refused")["full_info"].alias("refused"),
        *variants.fields("item", {"estado": ("$.Estado", "string"), "estrato": ("$.Estrato", "int")}),
        *variants.fields("full_info", {"precio": ("$.Precio", "string")}))
    units = {"area": ("$['m² const.']", "string"), "precio_unidad": ("$.Precio", "string")}
    return variants.explode_variant(named, "unidades", units, ["url", "department", "estado", "estrato", "precio", "refused"])


@query("json_variant_schema", cte("v_located") + """
select 'item' as "column", 'OBJECT<Estado: STRING, Estrato: BIGINT>' as "schema", count(*) as filled from v_located
union all select 'full_info', 'OBJECT<Precio: STRING>', count_if(has_info = 1) from v_located""")
def _(t: Tables):
    path = scratch_path(t.spark, "variants")
    variants.write_variants(t.sql(VARIANT_ROWS), ["item", "full_info", "unidades"], path)
    return variants.field_schemas(t.spark.read.parquet(path), ["item", "full_info"])


@query("load_newest_batch", cte("v_batch") + """
select url, titulo, event_id, batch_id from v_batch where batch_id = (select max(batch_id) from v_batch)""")
def _(t: Tables):
    path = scratch_path(t.spark, "batches")
    t.view("v_batch").select("url", "titulo", "event_id", "batch_id").write.partitionBy("batch_id").parquet(path)
    return snapshots.newest_batch(t.spark, path).select("url", "titulo", "event_id", "batch_id")


INVENTORY = {"bronze": ("orders", "o_orderstatus"), "silver": ("events", "event_type"), "gold": ("nation", "n_regionkey")}


@query("tier_inventory", "\nunion all ".join(
    f"select '{tier}' as tier, count(distinct {by}) as files, true as has_bytes from {table}" for tier, (table, by) in INVENTORY.items()))
def _(t: Tables):
    """A file for each value of a column."""
    tiers = {}
    for tier, (table, by) in INVENTORY.items():
        tiers[tier] = scratch_path(t.spark, tier)
        t.table(table).repartition(by).write.partitionBy(by).parquet(tiers[tier])
    return files.tier_inventory(t.spark, tiers, "*.parquet").select("tier", "files", (F.col("bytes") > 400 * F.col("files")).alias("has_bytes"))
