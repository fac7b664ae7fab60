"""Query registry and the views both engines derive from the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# One text for both engines.
VIEWS: dict[str, str] = {
    "v_listing": """
select o.o_orderkey as id_house, concat('/l/', cast(o.o_orderkey as string)) as url,
 cast(o.o_orderdate as date) as fecha, r.r_name as department, n.n_name as city,
 o.o_orderpriority as tipo_de_inmueble, o.o_orderstatus as estado,
 cast(o.o_custkey % 6 + 1 as int) as estrato, cast(l.banos as int) as banos,
 cast(l.habitaciones as int) as habitaciones, l.area_construida, l.area_privada,
 o.o_totalprice as precio,
 cast(400 + o.o_custkey % 700 as double) / 100 as lat,
 cast(7300 + o.o_custkey % 300 as double) / -100 as lon
from orders o join customer c on o.o_custkey = c.c_custkey
join nation n on c.c_nationkey = n.n_nationkey
join region r on n.n_regionkey = r.r_regionkey
join (select l_orderkey, count(*) as habitaciones, count(distinct l_suppkey) as banos,
  sum(l_quantity) as area_construida,
  round(sum(l_quantity * (1 - l_discount)), 4) as area_privada
  from lineitem group by l_orderkey) l on l.l_orderkey = o.o_orderkey""",
    "v_raw": """
select o_orderkey as id_house, concat(' /l/', cast(o_orderkey as string), ' ') as url,
 concat('$ ', cast(cast(floor(o_totalprice) as bigint) as string), ' COP') as precio_txt,
 concat(cast(20 + o_orderkey % 300 as string),
   case when o_orderkey % 2 = 0 then ' m2' else ' M2 ' end) as area_txt,
 case when o_orderkey % 7 = 0 then null
   else concat(cast(o_orderkey % 5 + 1 as string), ' habitaciones') end as hab_txt,
 case when o_orderkey % 5 = 0 then null when o_orderkey % 5 = 1 then 'No disponible'
   else 'Si' end as financiacion_txt,
 case when o_orderkey % 11 = 0 then '' else cast(o_custkey % 6 + 1 as string) end as estrato_txt,
 concat('(', cast(4 + o_custkey % 7 as string), '.', lpad(cast(o_custkey % 100 as string), 2, '0'),
   ', -', cast(73 + o_custkey % 3 as string), '.', lpad(cast(o_custkey % 100 as string), 2, '0'), ')') as lat_lon
from orders""",
    # A user's events as versions of one record.
    "v_batch": """
select concat('/u/', cast(user_id as string)) as url, ts as fecha, event_type as titulo,
 event_id, value as precio,
 case when event_id % 2 = 0 then 'b1' else 'b2' end as batch_id
from events""",
    # A user's day as one record, so that batches share only some keys.
    "v_daily": """
select concat('/u/', cast(user_id as string), '/', cast(cast(ts as date) as string)) as url,
 ts as fecha, event_type as titulo, event_id, value as precio,
 case when event_id % 2 = 0 then 'b1' else 'b2' end as batch_id
from events""",
    "v_poi": """
select event_id as id, cast(4000 + event_id * 7919 % 10007 as double) / 1000 as lat,
 cast(-152000 + event_id * 104729 % 10007 as double) / 2000 as lon,
 case event_type when 'click' then 'hospital' when 'view' then 'school'
  when 'signup' then 'park' when 'purchase' then 'mall' end as category
from events""",
    "v_osm": """
select 'node' as type, id, cast(lat as double) as lat, cast(lon as double) as lon,
 case when category in ('hospital','school') then category end as amenity,
 case when category = 'mall' then category end as shop,
 case when category = 'park' then category end as leisure,
 cast(null as bigint) as n1, cast(null as bigint) as n2 from v_poi
union all
select 'way', id, null, null, null, null, 'park', id + 1, id + 2 from v_poi where category = 'park'""",
    # Parts of an order as units of a listing.
    "v_unit": """
select l_orderkey, l_linenumber,
 concat(cast(cast(l_quantity as bigint) as string), ' m2') as const_txt,
 concat(cast(cast(l_quantity as bigint) - 1 as string), '.5 m2') as priv_txt,
 concat('Tipo ', l_returnflag) as tipo_txt,
 concat(cast(l_linenumber as string), ' habitaciones') as hab_txt,
 cast(l_linenumber % 4 + 1 as string) as banos_txt,
 concat('$ ', cast(cast(floor(l_extendedprice) as bigint) as string)) as precio_txt
from lineitem""",
    # Texts of a raw listing, before they are put together as JSON.
    "v_text": """
select o_orderkey, o_custkey, concat('/l/', cast(o_orderkey as string)) as url,
 concat(cast(cast(o_orderdate as date) as string), ' ', lpad(cast(hour(o_orderdate) as string), 2, '0'), ':',
  lpad(cast(minute(o_orderdate) as string), 2, '0'), ':', lpad(cast(cast(floor(second(o_orderdate)) as int) as string), 2, '0')) as fecha,
 concat('Casa "', o_orderpriority, '", ', o_clerk) as titulo, o_clerk as constructor,
 case when o_orderkey % 7 = 0 then 'No disponible' else 'Si' end as financiacion,
 cast(o_custkey % 6 + 1 as string) as estrato,
 case when o_orderkey % 5 = 0 then 'No disponible' else cast(o_orderkey % 3 + 1 as string) end as pisos,
 o_orderstatus as estado,
 case when o_orderkey % 3 = 0 then 0 else 1 end as has_info,
 concat('$ ', cast(cast(floor(o_totalprice) as bigint) as string)) as precio,
 concat('(', cast(4 + o_custkey % 7 as string), '.', lpad(cast(o_custkey % 100 as string), 2, '0'),
   ', -', cast(73 + o_custkey % 3 as string), '.', lpad(cast(o_custkey % 100 as string), 2, '0'), ')') as lat_lon
from (select o_orderkey, o_custkey, o_orderdate, o_orderpriority, o_orderstatus, o_totalprice,
 concat('Agente ', cast(o_custkey % 50 as string)) as o_clerk from orders) o""",
    "v_located": """
select t.*, r.r_name as department, n.n_name as city from v_text t
join customer c on t.o_custkey = c.c_custkey
join nation n on c.c_nationkey = n.n_nationkey
join region r on n.n_regionkey = r.r_regionkey""",
}

# Views other views read, so that a query names only what it uses itself.
_NEEDS = {"v_osm": ("v_poi",), "v_located": ("v_text",)}


def cte(*names: str) -> str:
    """``with`` clause that defines the named views and what they read."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for below in _NEEDS.get(name, ()):
            add(below)
        if name not in ordered:
            ordered.append(name)

    for n in names:
        add(n)
    return "with " + ",\n".join(f"{n} as ({VIEWS[n]})" for n in ordered) + "\n"


@cache
def _read(spark: SparkSession, path: str) -> DataFrame:
    """The given tables do not change, so each schema is read once per session."""
    return spark.read.parquet(path)


class Tables:
    """The given tables of one folder, and views on them, as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return _read(self.spark, f"{self.folder}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        for name in TABLES:
            if name in text:
                self.table(name).createOrReplaceTempView(name)
        return self.spark.sql(text)

    def view(self, name: str) -> DataFrame:
        return self.sql(cte(name) + f"select * from {name}")


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` and its SQL twin."""

    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap
