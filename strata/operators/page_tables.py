"""Pages as table functions, and pages read by rules that are rows themselves.

``page_rows(html, part)`` is called by ``LATERAL`` and stays in the stage that scans the
pages. ``page_units(TABLE(...) PARTITION BY page_id)`` gets the rows of a page together, and
reads equal versions of it once; it costs a shuffle. Both decide their columns while the
query is planned, from constant arguments, and refuse wrong ones there.

``page_facts_by_rules`` joins pages to the rules of their page set, so that a set of pages
with another markup is another few rows in a table.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from strata.functions.markup import Node, tree
from strata.operators.pages import PART, SELECTORS, _facts, _sheet, _units, _value, dealt
from strata.plans.sizing import broadcast_if_small

FACT = T.StructType().add("part", T.StringType()).add("key", T.StringType()).add("value", T.StringType())
UNIT = (
    T.StructType().add("unit", T.IntegerType()).add("from_table", T.BooleanType())
    .add("key", T.StringType()).add("value", T.StringType())
)
PARTS = {"facts": FACT, "sheet": FACT, "units": UNIT}


@dataclass
class _Plan(AnalyzeResult):
    """What planning found out, for the workers."""

    part: str = ""
    selectors: str = "{}"
    key: str = ""


def _constant(argument: AnalyzeArgument | None, name: str, default: str | None = None) -> str:
    if argument is None and default is not None:
        return default
    if argument is None or not argument.isConstantExpression or not isinstance(argument.value, str):
        raise ValueError(f"{name} must be a constant text")
    return argument.value


def _selectors(given: str) -> dict[str, str]:
    """The usual selectors, some of them replaced by a JSON object."""
    replaced = json.loads(given)
    if not isinstance(replaced, dict) or set(replaced) - set(SELECTORS):
        raise ValueError(f"selectors must be a JSON object with names among {', '.join(SELECTORS)}")
    return SELECTORS | replaced


def _rows(html: str | None, part: str, at: Mapping[str, str]) -> Iterator[tuple]:
    """Rows of one part; none for a page that is empty or cannot be read."""
    try:
        page = tree(html or "")
        found = _units(page, at) if part == "units" else (_facts if part == "facts" else _sheet)(page, at)
        page.forget()
    except Exception:  # noqa: BLE001 - ``page_content`` tells the error of such a page
        return
    if part == "units":
        units, from_table = found
        for i, unit in enumerate(units):
            for key, value in unit.items():
                yield i, from_table, key, value
    else:
        for key, value in found.items():
            yield part, key, value


class PageRows:
    """``page_rows(html, part [, selectors])``: rows of ``facts``, ``sheet`` or ``units``."""

    def __init__(self, plan: _Plan | None = None):
        self.at = _selectors(plan.selectors) if plan else SELECTORS

    @staticmethod
    def analyze(html: AnalyzeArgument, part: AnalyzeArgument, selectors: AnalyzeArgument | None = None) -> _Plan:
        if html.isTable or not isinstance(html.dataType, T.StringType):
            raise ValueError("page_rows reads a text column")
        wanted = _constant(part, "part")
        if wanted not in PARTS:
            raise ValueError(f"part must be one of {', '.join(PARTS)}")
        given = _constant(selectors, "selectors", "{}")
        _selectors(given)
        return _Plan(schema=PARTS[wanted], part=wanted, selectors=given)

    def eval(self, html: str | None, part: str, selectors: str | None = None):
        yield from _rows(html, part, self.at)


class PageUnits:
    """``page_units(TABLE(t) PARTITION BY key [, key] [, selectors])``: ``key`` and the rows
    of units of every page, equal pages of a partition once.

    Rows of a partition pass one by one; what is kept of them is a number for each different
    page.
    """

    def __init__(self, plan: _Plan | None = None):
        self.key, self.at = (plan.key, _selectors(plan.selectors)) if plan else ("page_id", SELECTORS)
        self.seen: set[int] = set()

    @staticmethod
    def analyze(pages: AnalyzeArgument, key: AnalyzeArgument | None = None, selectors: AnalyzeArgument | None = None) -> _Plan:
        if not pages.isTable:
            raise ValueError("page_units reads TABLE(...)")
        name, given = _constant(key, "key", "page_id"), _constant(selectors, "selectors", "{}")
        columns = {f.name: f.dataType for f in pages.dataType.fields}
        missing = [c for c in (name, "html") if c not in columns]
        if missing:
            raise ValueError(f"page_units needs {', '.join(missing)}; the table has {', '.join(columns)}")
        _selectors(given)
        schema = T.StructType([T.StructField(name, columns[name]), *UNIT.fields])
        return _Plan(schema=schema, part="units", selectors=given, key=name)

    def eval(self, row: Row, key: str | None = None, selectors: str | None = None):
        mark = hash((row[self.key], row["html"]))
        if mark not in self.seen:
            self.seen.add(mark)
            for found in _rows(row["html"], "units", self.at):
                yield row[self.key], *found


def register(spark: SparkSession) -> None:
    """Make ``page_rows`` and ``page_units`` callable from SQL. They give few rows a page:
    these travel in batches of many pages, where Arrow would make a batch for each page."""
    spark.udtf.register("page_rows", F.udtf(PageRows, useArrow=False))
    spark.udtf.register("page_units", F.udtf(PageUnits, useArrow=False))


# --- Rules. ---

#: A rule looks below each element that ``row`` selects. ``key`` and ``value`` are paths there,
#: like ``div.ant-col[2] strong``: each step is the first, or the numbered, match below the
#: step before; ``^`` starts from the page; ``=text`` is the text itself. Rows without ``has``,
#: or with what ``!has`` names, are passed over. Rules go by ``ord``; what an earlier one found
#: for a key stays.
RULES = "page_set string, part string, ord int, row string, has string, key string, value string"
_STEP = re.compile(r"([^\s\[\]]+)(?:\[(\d+)\])?")

_SHEET_ROW = f"{SELECTORS['sheet']} {SELECTORS['sheet_row']}"
_SHEET_KEY = f"{SELECTORS['sheet_cell']}[0] {SELECTORS['sheet_label']}[1]"
LISTING_RULES = (
    ("facts", 1, SELECTORS["fact_row"], f"!{SELECTORS['fact_cell']}[2]", f"{SELECTORS['fact_cell']}[0]", f"{SELECTORS['fact_cell']}[1]"),
    ("sheet", 1, _SHEET_ROW, f"{SELECTORS['sheet_cell']}[2] {SELECTORS['sheet_ask']}", _SHEET_KEY, "=No disponible"),
    ("sheet", 2, _SHEET_ROW, None, _SHEET_KEY, f"{SELECTORS['sheet_cell']}[2] strong"),
    ("sheet", 3, _SHEET_ROW, None, _SHEET_KEY, f"{SELECTORS['sheet_cell']}[2]"),
    ("sheet", 4, SELECTORS["sheet"], None, "=Precio", f"^{SELECTORS['price']} strong"),
)


@lru_cache(1 << 12)
def _path(path: str) -> tuple[tuple[str, int], ...]:
    """``a.b[1] c`` as ((a.b, 1), (c, 0))."""
    steps = tuple((s, int(n or 0)) for s, n in _STEP.findall(path))
    if not steps or " ".join(f"{s}[{n}]" for s, n in steps) != re.sub(r"(?<!\])(?=\s|$)", "[0]", " ".join(path.split())):
        raise ValueError(f"not a path: {path!r}")
    return steps


def _find(page: Node, at: Node, path: str) -> Node | None:
    if path.startswith("^"):
        at, path = page, path[1:]
    for selector, n in _path(path):
        found = at.all(selector)
        if len(found) <= n:
            return None
        at = found[n]
    return at


def _read(page: Node, at: Node, path: str) -> str | None:
    if path.startswith("="):
        return path[1:]
    found = _find(page, at, path)
    return None if found is None else found.text()


def apply_rules(html: str | None, rules: Iterable[Mapping]) -> list[tuple[str, str, str | None]]:
    """(part, key, value) of one page. A key given as text whose row is there stands with
    null if no rule finds its value."""
    page = tree(html or "")
    found: dict[tuple[str, str], str | None] = {}
    for rule in rules:
        earlier = {k for k, v in found.items() if v is not None}
        for at in page.all(rule["row"]):
            has = rule["has"]
            if has and (_find(page, at, has.lstrip("!")) is None) != has.startswith("!"):
                continue
            key = _read(page, at, rule["key"])
            if not key or (rule["part"], key) in earlier:
                continue
            value = _read(page, at, rule["value"])
            if value:
                found[rule["part"], key] = _value(value)
            elif rule["key"].startswith("="):
                found.setdefault((rule["part"], key), None)
    page.forget()
    return [(part, key, value) for (part, key), value in found.items()]


def rule_sets(spark: SparkSession, sets: Mapping[str, Iterable[tuple]]) -> DataFrame:
    """A rules table out of (part, ord, row, has, key, value) of each page set."""
    return spark.createDataFrame([(name, *rule) for name, rules in sets.items() for rule in rules], RULES)


def page_facts_by_rules(pages: DataFrame, rules: DataFrame, page_set: Column) -> DataFrame:
    """(page_id, page_set, part, key, value, error) by the rules of each page's set.

    ``page_set`` is an expression over ``pages``. Pages of a set without rules give no rows.
    A page that cannot be read, or whose rules cannot be, gives one row with the error.
    """
    order = F.sort_array(F.collect_list(F.struct("ord", "part", "row", "has", "key", "value")))
    by_set = broadcast_if_small(rules.groupBy(F.col("page_set").alias("_set")).agg(order.alias("_rules")))
    id_type = pages.schema["page_id"].dataType.simpleString()

    def run(batches):
        for batch in (b.slice(at, PART) for b in batches for at in range(0, b.num_rows, PART)):
            ids, sets, facts = [], [], []
            of_set: dict[str, list] = {}
            for i, (html, name) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("html", "page_set")))):
                if name not in of_set:
                    of_set[name] = batch.column("_rules")[i].as_py()
                try:
                    found = [(*f, None) for f in apply_rules(html, of_set[name])]
                except Exception as e:  # noqa: BLE001 - a page that cannot be read is a row with its error
                    found = [(None, None, None, f"{type(e).__name__}: {e}")]
                ids += [i] * len(found)
                sets += [name] * len(found)
                facts += found
            columns = list(zip(*facts)) if facts else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id").take(pa.array(ids, pa.int32())), pa.array(sets, pa.string()), *(pa.array(c, pa.string()) for c in columns)],
                names=["page_id", "page_set", "part", "key", "value", "error"])

    # Sets that are null have no rules.
    placed = dealt(pages.select("page_id", "html", page_set.cast("string").alias("page_set")))
    joined = placed.join(by_set, F.col("page_set") == F.col("_set")).select("page_id", "page_set", "html", "_rules")
    return joined.mapInArrow(run, f"page_id {id_type}, page_set string, part string, key string, value string, error string")
