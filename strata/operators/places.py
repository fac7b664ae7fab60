"""Points of interest: way geometry, cells, counts, and their join to listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schemas
from strata.config import DEFAULTS, POI_CATEGORIES
from strata.functions import geo
from strata.operators.aggregates import pivot_counts
from strata.operators.filters import drop_nulls
from strata.operators.projection import quoted
from strata.plans.sizing import broadcast_if_small


def category(tags: str = "tags"):
    """Kind of place: amenity, else shop, else leisure."""
    t = quoted(tags)
    return F.coalesce(t.getField("amenity"), t.getField("shop"), t.getField("leisure"))


def bbox_midpoint(points: DataFrame, *group: str) -> DataFrame:
    """Middle of the bounding box of each group's points."""
    return points.groupBy(*group).agg(
        ((F.min("lat") + F.max("lat")) / F.lit(2.0)).alias("lat"),
        ((F.min("lon") + F.max("lon")) / F.lit(2.0)).alias("lon"),
    )


def way_geometry(osm: DataFrame) -> DataFrame:
    """(id, lat, lon) of each way that has at least one known node.

    Node references are what is shuffled, as two longs each; a way with many nodes is
    spread over its nodes' partitions and folded before it is grouped.
    """
    nodes = osm.filter(F.col("type") == "node").select(F.col("id").alias("_node"), "lat", "lon")
    refs = osm.filter(F.col("type") == "way").select("id", F.explode("nodes").alias("_node"))
    return bbox_midpoint(refs.join(nodes, "_node"), "id")


def union_poi(nodes: DataFrame, ways: DataFrame) -> DataFrame:
    """Elements of both kinds, each once by type and id."""
    both = nodes.unionByName(ways, allowMissingColumns=True)
    whole = F.struct(*both.columns)
    # Of unlike elements of one name, the same one on every run.
    return both.groupBy("type", "id").agg(F.min_by(whole, F.xxhash64(whole)).alias("_e")).select("_e.*")


def located(osm: DataFrame) -> DataFrame:
    """(type, id, lat, lon, category): nodes as they are, ways at their box midpoint;
    elements without a category or a place are left out."""
    tagged = osm.withColumn("category", category()).filter(F.col("category").isNotNull())
    nodes = tagged.filter(F.col("type") == "node").select("type", "id", "lat", "lon", "category")
    ways = tagged.filter(F.col("type") == "way").select("type", "id", "category").join(way_geometry(osm), "id")
    return drop_nulls(union_poi(nodes, ways.select("type", "id", "lat", "lon", "category")), ["lat", "lon"])


def cell_counts(
    points: DataFrame, cell_km: float = DEFAULTS.cell_km, categories: Sequence[str] = POI_CATEGORIES
) -> DataFrame:
    """Points per cell and category, wide: ``hex_id`` and one count per category."""
    binned = drop_nulls(points, ["lat", "lon"]).withColumn(
        "hex_id", geo.hex_cell(F.col("lat"), F.col("lon"), cell_km)
    )
    return pivot_counts(binned, "hex_id", "category", categories)


def poi_counts(osm: DataFrame | None, spark: SparkSession, cell_km: float = DEFAULTS.cell_km) -> DataFrame:
    """Cell counts of an element table; no table at all gives the typed empty frame."""
    if osm is None:
        return spark.createDataFrame([], schemas.POI_COUNTS)
    return cell_counts(located(osm), cell_km)


def enrich(
    df: DataFrame, dim: DataFrame, key: str, zero_fill: Sequence[str] = (),
    broadcast_bytes: int = DEFAULTS.broadcast_bytes,
) -> DataFrame:
    """Left join to a dimension; listed columns become 0 where nothing matched.

    The dimension is broadcast if its measured size allows, so the big side is not
    shuffled; otherwise the join shuffles and adaptive execution splits hot keys.
    """
    joined = df.join(broadcast_if_small(dim, broadcast_bytes), key, "left")
    return joined.fillna(0, subset=list(zero_fill)) if zero_fill else joined


def enrich_poi(listings: DataFrame, counts: DataFrame, cell_km: float = DEFAULTS.cell_km) -> DataFrame:
    """Listings with ``lat``/``lon`` get the place counts of their cell."""
    celled = listings.withColumn("hex_id", geo.hex_cell(F.col("lat"), F.col("lon"), cell_km))
    return enrich(celled, counts, "hex_id", zero_fill=POI_CATEGORIES)
