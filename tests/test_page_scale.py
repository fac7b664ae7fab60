"""Pages are dealt to tasks before they are read, and read fast without being read differently."""

import random

from pyspark.sql import functions as F

from strata.config import Settings
from strata.functions import markup
from strata.operators import page_tables, pages
from strata.plans import flows

PAGE = '<ul class="ant-list-items"><li class="ant-list-item"><div class="ant-col">Pisos</div><div class="ant-col">3</div></li></ul>'
PIECES = (
    "<p>", "</p>", '<div class="a b">', "</div>", "<br>", "<br/>", '<img src="x&amp;y"/>', "a &amp; b", "&lt", "<script>", "</script>",
    "</SCRIPT>", "</script >", "<script/>", "<style>", "</style>", "x<y", " > ", "<!-- c -->", "<!--", "<!doctype html>", "<?x?>",
    "<a href='q'>", '<a href="x>y">', '<a href="x<y">', "<a b=c>", "</a b>", "</ p>", "</>", "<", '<A Href="1" href="2" dis>', "<td/>",
    "text", "\n", "<title>", "</title>", '"', '<a  b ="c">', "<textarea>", "<x-y>", "</x-y>", "&copy",
)


def shape(root):
    return [(n.tag, n.attrs, n.classes, n.start, n.end, [c if isinstance(c, str) else c.start for c in n.children]) for n in root.page]


def test_plain_pages_have_the_tree_of_the_standard_parser():
    deal, plain = random.Random(5), 0
    for _ in range(5_000):
        html = "".join(deal.choices(PIECES, k=deal.randint(0, 8)))
        builder = markup._Builder()
        builder.feed(html)
        builder.close()
        root = builder.open[0]
        builder._close(0)
        assert shape(markup.tree(html)) == shape(root), html
        plain += markup._plain_tree(html) is not None
    assert plain > 500


def dealt_in(frame):
    return "hashpartitioning(xxhash64(" in frame._jdf.queryExecution().executedPlan().toString()


def test_pages_of_one_file_are_read_by_many_tasks(spark):
    df = spark.range(20).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.lit(PAGE).alias("html")).coalesce(1)
    rules = page_tables.rule_sets(spark, {"a": page_tables.LISTING_RULES})
    for frame in (pages.page_facts(df), pages.page_units(df), pages.listing_cards(df, "https://x"),
                  page_tables.page_facts_by_rules(df, rules, F.lit("a"))):
        assert dealt_in(frame)
    assert pages.page_facts(df).count() == 20


def test_equal_ids_and_null_ids_are_spread(spark):
    html = F.concat(F.lit(PAGE), F.col("id").cast("string"))
    df = spark.range(400).select(F.lit(None).cast("long").alias("page_id"), F.lit("u").alias("url"), html.alias("html"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        places = pages.dealt(df).select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert places > 1


def test_a_batch_of_pages_becomes_objects_part_by_part():
    import pyarrow as pa

    alive, most = set(), []

    class Kept(dict):
        def __init__(self, i):
            super().__init__(key=str(i), value=None)
            alive.add(i)

        def __del__(self):
            alive.discard(int(self["key"]))

    def read(h):
        most.append(len(alive))
        return [Kept(int(h))]

    out = pages._by_parts(pa.array(map(str, range(3_000))), read, pages._PAIRS)
    assert [r[0]["key"] for r in out.to_pylist()] == list(map(str, range(3_000)))
    assert max(most) <= 2 * pages.PART


def test_results_of_the_table_functions_travel_in_batches_of_pages(spark):
    spark.createDataFrame([(1, PAGE)], "page_id long, html string").createOrReplaceTempView("scale_pages")
    page_tables.register(spark)
    frame = spark.sql("select page_id, f.* from scale_pages, lateral page_rows(html, 'facts') f")
    assert "BatchEvalPythonUDTF" in frame._jdf.queryExecution().executedPlan().toString()
    assert frame.collect() == [(1, "facts", "Pisos", "3")]


def test_rows_of_one_file_are_parsed_by_many_tasks_however_many_bytes(spark):
    df = spark.range(1_000, numPartitions=1)
    cores = spark.sparkContext.defaultParallelism
    settings = Settings(parse_bytes=1_000)
    dealt = flows.balanced(df, cores * settings.parse_bytes, settings)
    assert dealt.rdd.getNumPartitions() == 4 * cores
    assert flows.balanced(df, 400 * cores * settings.parse_bytes, settings).rdd.getNumPartitions() == 100 * cores
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1_000 and max(sizes) < 2 * 1_000 / (4 * cores) + 10
