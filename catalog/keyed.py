"""Dedup, ids and upsert queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import Tables, cte, query
from strata.operators.dedup import latest_per_key
from strata.operators.ids import assign_ids
from strata.operators.upsert import merge_stats, upsert
from strata.plans import flows
from strata.plans.sizing import scratch_path
from strata.sources.partitioned import read_current, upsert_partitions
from strata.streaming import ingest

LATEST = "row_number() over (partition by url order by fecha desc, titulo desc)"


@query("dedup_latest", cte("v_batch") + f"""
select url, fecha, titulo, event_id, precio from (select *, {LATEST} as rn from v_batch) x where rn = 1""")
def _(t: Tables):
    return latest_per_key(t.view("v_batch")).select("url", "fecha", "titulo", "event_id", "precio")


@query("assign_surrogate_ids", cte("v_daily") + """
select url, 1000 + row_number() over (order by url) - 1 as id_house from (select distinct url from v_daily) x""")
def _(t: Tables):
    return assign_ids(t.view("v_daily").select("url").distinct(), "url", start=1000)


BATCHES = cte("v_daily") + f""", target as (select url, fecha, titulo, precio from
 (select *, {LATEST} as rn from v_daily where batch_id = 'b1') x where rn = 1),
updates as (select url, fecha, titulo, precio from
 (select *, {LATEST} as rn from v_daily where batch_id = 'b2') x where rn = 1)
"""
WINS = {"latest_wins": "t.fecha is null or u.fecha >= t.fecha", "append_only": "false", "overwrite": "true"}


def upsert_sql(strategy: str) -> str:
    wins = WINS[strategy]
    pick = ", ".join(
        f"case when t.url is null or (u.url is not null and ({wins})) then u.{c} else t.{c} end as {c}"
        for c in ("url", "fecha", "titulo", "precio")
    )
    return BATCHES + f"""select {pick}, case when t.url is null then 'inserted' when u.url is null then 'unchanged'
 when {wins} then 'updated' else 'refused' end as action
from target t full outer join updates u on t.url = u.url"""


def batches(t: Tables):
    """Newest rows of batch b1 as the table, of b2 as the update."""
    rows = t.view("v_daily")
    return [
        latest_per_key(rows.filter(F.col("batch_id") == b)).select("url", "fecha", "titulo", "precio") for b in ("b1", "b2")
    ]


def _upsert(strategy: str):
    @query(f"upsert_{strategy}", upsert_sql(strategy))
    def _(t: Tables):
        return upsert(*batches(t), strategy=strategy).withColumnRenamed("_action", "action")


for _strategy in WINS:
    _upsert(_strategy)


@query("upsert_stats", BATCHES + f"""select action, count(*) as count from (
 select case when t.url is null then 'inserted' when u.url is null then 'unchanged'
 when {WINS['latest_wins']} then 'updated' else 'refused' end as action
 from target t full outer join updates u on t.url = u.url) x group by action""")
def _(t: Tables):
    return merge_stats(upsert(*batches(t)))


@query("upsert_large_batch", upsert_sql("latest_wins"))
def _(t: Tables):
    """The plan for a batch too large to broadcast."""
    return upsert(*batches(t), broadcast_bytes=-1).withColumnRenamed("_action", "action")


@query("upsert_partitioned", upsert_sql("latest_wins").replace("action\nfrom target", "action, case when t.url is null or (u.url is not null and u.fecha >= t.fecha) then u.titulo else t.titulo end as department\nfrom target"))
def _(t: Tables):
    """The batch on a table in partitions, of which only the touched ones are rewritten;
    a record moves to another partition when its kind changes."""
    table = scratch_path(t.spark, "partitioned")
    old, new = (df.withColumn("department", F.col("titulo")) for df in batches(t))
    upsert_partitions(t.spark, table, old, by=["department"])
    upsert_partitions(t.spark, table, new, by=["department"])
    before = old.select("url", F.col("fecha").alias("_old"))
    after = new.select("url", F.col("fecha").alias("_new"))
    # Every partition is touched here; the action is told from both inputs for the check.
    known = before.join(after, "url", "full_outer").select("url", F.when(F.col("_old").isNull(), "inserted").when(
        F.col("_new").isNull(), "unchanged").when(F.col("_new") >= F.col("_old"), "updated").otherwise("refused").alias("action"))
    return read_current(t.spark, table, ["department"]).join(known, "url").select("url", "fecha", "titulo", "precio", "department", "action")


@query("upsert_late_batch", cte("v_daily") + """, part as (select *, case event_id % 3 when 0 then 1 when 1 then 2 else 3 end as applied from v_daily)
select url, cast(fecha as date) as fecha, titulo, cast(event_id as varchar) as constructor from (
 select *, row_number() over (partition by url order by applied desc, fecha desc, titulo desc) as rn from part) x where rn = 1""")
def _(t: Tables):
    """Two batches of one second, then one under an older id; a day's record keeps its
    date, so whichever comes last counts, and records move between partitions."""
    table = scratch_path(t.spark, "late")
    rows = t.view("v_daily").select("event_id", "url", "fecha", "titulo", F.col("event_id").cast("string").alias("constructor"),
                                    F.col("titulo").alias("department"), F.lit("c").alias("city"))
    for part, batch in enumerate(("2025-05-02_00-00-00", "2025-05-02_00-00-00", "2025-05-01_00-00-00")):
        flows.merge_into_table(t.spark, rows.filter(F.col("event_id") % 3 == part).drop("event_id"), table, batch)
    return read_current(t.spark, table).select("url", "fecha", "titulo", "constructor")


PLACED = """select concat('/e/', cast(event_id as string)) as url, ts as fecha, event_type as titulo,
 case event_id % 4 when 0 then null when 1 then '' when 2 then '~null' else event_type end as department from events"""


@query("upsert_null_partition", PLACED.replace("as string", "as varchar").replace("event_id % 4", "(event_id + case when event_id % 5 = 0 then 1 else 0 end) % 4"))
def _(t: Tables):
    """Null and empty partition values; every fifth record moves to the next partition."""
    table, rows = scratch_path(t.spark, "unplaced"), t.sql(PLACED)
    upsert_partitions(t.spark, table, rows, by=["department"])
    moved = t.sql(PLACED.replace("event_id % 4", "(event_id + 1) % 4") + " where event_id % 5 = 0")
    upsert_partitions(t.spark, table, moved, by=["department"])
    return read_current(t.spark, table, ["department"]).select("url", "fecha", "titulo", "department")


@query("stream_upsert", cte("v_daily") + f"""
select url, fecha, titulo, event_id, precio from (select *, {LATEST} as rn from v_daily) x where rn = 1""")
def _(t: Tables):
    """Two streams with checkpoints of their own into one table."""
    table, rows = scratch_path(t.spark, "streamed"), t.view("v_daily")
    for batch in ("b1", "b2"):
        src = scratch_path(t.spark, batch)
        rows.filter(F.col("batch_id") == batch).drop("batch_id").write.parquet(src)
        stream = ingest.read_batches(t.spark, src, rows.drop("batch_id").schema)
        ingest.upsert_stream(stream, table, scratch_path(t.spark, "mark"), ["titulo"]).awaitTermination()
    return read_current(t.spark, table, ["titulo"]).select("url", "fecha", "titulo", "event_id", "precio")


@query("stream_ingest", cte("v_batch") + "select url, fecha, titulo, event_id, precio, batch_id from v_batch")
def _(t: Tables):
    src, out, mark = (scratch_path(t.spark, n) for n in ("landed", "out", "mark"))
    rows = t.view("v_batch").select("url", "fecha", "titulo", "event_id", "precio", "batch_id")
    for batch in ("b1", "b2"):
        rows.filter(F.col("batch_id") == batch).write.mode("append").parquet(src)
        ingest.append_stream(ingest.read_batches(t.spark, src, rows.schema), out, mark).awaitTermination()
    return t.spark.read.schema(rows.schema).parquet(out)
