"""HTML extraction: deduce the template of a host's pages, return what fills its slots.

Tokens of pages are markup, and blocks of text, each told apart by where it stands (see
``page_events``). The template of a host comes out of how often they occur in its pages:

* The occurrence vector of a token is its count in every page of the host. Vectors are never
  made; a sum over pages of a hash of (page, count) stands for one, so tasks add up their own
  pages, and a host with a third of all pages is a few sums from each task.
* Tokens with equal vectors that are frequent on the host are an equivalence class.
  Headings, footers and their fixed lines occur once a page and fall into one; the tags of
  a menu entry, once per entry, into another. A class without markup is no part of a
  template: passages that pages share are content.
* A class is valid if its tokens take turns in the same order in all pages, and if the
  spans of any two classes lie apart or one lies within one slot of the other, which a stack
  decides. Valid classes, nested, are the template.
* The rest of a page lies in the slots between tokens of valid classes. Slots are judged by
  all pages of the host together; those that hold mostly links are menus.

What remains in slots of the article is its text. Elements and names that say that they are
something else (``nav``, ``class="ad"`` ...) are left out also on hosts with too few pages for
a template.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import or_empty, parts
from strata.llm.page_events import ARTICLE, BODY, MAIN, Event, events
from strata.llm.url_filter import host_of
from strata.plans.sizing import broadcast_if_small, materialize

SUPPORT_PCT = 10  # of a host's pages that hold a token of the template
FIXED_TEXT_PAGES = 10  # pages from which a line in all of them is the template's
MENU_PCT = 60  # of a slot's text in links
HELD = 100_000  # sums a task remembers

_LANE = (1 << 21) - 1


def _lanes(page: int, n: int) -> tuple[int, int, int]:
    """63 bits of (page, count) in three lanes: sums of 2^42 pages stay below 2^63."""
    h = xxhash.xxh64_intdigest(page.to_bytes(8, "little", signed=True), seed=n)
    return h & _LANE, h >> 21 & _LANE, h >> 42 & _LANE


def _sources(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, host, page``: null html is empty; ``host`` and ``page`` are
    hashes of the host's name and of all of the row."""
    url, source = F.col("url").cast("string"), or_empty("html")
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), url.alias("url"), source.alias("html"), F.xxhash64(host_of(url)).alias("host"),
        F.xxhash64(F.coalesce(F.col("page_id").cast("long"), F.lit(-1)), F.coalesce(url, F.lit("")), source).alias("page"))


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_I64 = pa.int64()
_COUNTS = pa.schema([(n, _I64) for n in ("host", "token")] + [("markup", pa.bool_())] + [(n, _I64) for n in ("pages", "total", "a", "b", "c")])


def occurrences(pages: DataFrame) -> DataFrame:
    """``host, token, markup, pages, total, a, b, c``: in how many pages of the host a token
    stands, how often, and the hash of its vector. Text that is left out anyway is not counted."""
    def run(batches):
        held: dict[tuple, list[int]] = {}

        def flush():
            rows = [(*key, *sums) for key, sums in held.items()]
            held.clear()
            for at in range(0, len(rows), 20_000):
                yield _batch(_COUNTS, rows[at:at + 20_000])

        for batch in parts(batches):
            columns = (batch.column(n).to_pylist() for n in ("html", "host", "page"))
            for source, host, page in zip(*columns):
                counted = Counter((e.token, e.text is None) for e in events(source))
                lanes = {n: _lanes(page, n) for n in set(counted.values())}
                for (token, markup), n in counted.items():
                    sums = held.setdefault((host, token, markup), [0] * 5)
                    for i, v in enumerate((1, n, *lanes[n])):
                        sums[i] += v
                if len(held) > HELD:
                    yield from flush()
        yield from flush()

    found = pages.select("html", "host", "page").mapInArrow(
        run, "host long, token long, markup boolean, pages long, total long, a long, b long, c long")
    return found.groupBy("host", "token", "markup").agg(*[F.sum(n).alias(n) for n in ("pages", "total", "a", "b", "c")])


def classes(counts: DataFrame) -> DataFrame:
    """``host, classes``, one row for each host: arrays of tokens with equal vectors. At most
    100 / ``SUPPORT_PCT`` times as many tokens as an average page has."""
    sizes = counts.filter(F.col("markup") & (F.col("token") == BODY)).select("host", F.col("pages").alias("of"))
    frequent = counts.join(broadcast_if_small(sizes), "host").filter(
        (F.col("pages") >= 2) & (F.col("pages") * 100 >= F.col("of") * SUPPORT_PCT) & (F.col("markup") | (F.col("of") >= FIXED_TEXT_PAGES)))
    alike = frequent.groupBy("host", "pages", "total", "a", "b", "c").agg(
        F.sort_array(F.collect_list("token")).alias("tokens"), F.bool_or("markup").alias("markup"))
    return alike.filter("markup").groupBy("host").agg(F.sort_array(F.collect_list("tokens")).alias("classes"))


def _order(tokens: list[int], size: int) -> tuple[int, ...] | None:
    """The order in which ``size`` tokens take turns, if they do."""
    first = tuple(tokens[:size])
    if len(set(first)) < size or len(tokens) % size:
        return None
    return first if all(tokens[i] == first[i % size] for i in range(len(tokens))) else None


def _by_token(found: Iterable[Iterable[int]]) -> dict[int, tuple[int, int]]:
    """Token to (name of its class, size of the class)."""
    out = {}
    for tokens in found:
        name = min(tokens)
        out |= {t: (name, len(tokens)) for t in tokens}
    return out


def _slots(page: list[Event], member: dict[int, tuple[int, int]], places: dict[int, dict[int, int]], bad: set[int]) -> list[tuple[int, int]]:
    """For each event, the class and slot it stands in, (0, 0) outside of all. ``places``:
    place of a token in the order of its class. Of two classes whose spans overlap the
    smaller goes to ``bad``."""
    stack: list[list[int]] = []  # class, last place seen, size
    out = []
    for event in page:
        name, size = member.get(event.token, (0, 0))
        if name and name not in bad:
            at = places[name][event.token]
            while True:
                if at == 0 and not any(s[0] == name for s in stack):
                    stack.append([name, 0, size])
                elif stack and stack[-1][0] == name and stack[-1][1] == at - 1:
                    stack[-1][1] = at
                else:
                    over = next((s for s in reversed(stack) if s[0] != name), None)
                    if over is None or (size, name) < (over[2], over[0]):
                        bad.add(name)
                        stack = [s for s in stack if s[0] != name]
                        break
                    bad.add(over[0])
                    stack.remove(over)
                    continue
                if at == size - 1:
                    stack.pop()
                break
        out.append((stack[-1][0], stack[-1][1]) if stack else (0, 0))
    return out


_JUDGED = pa.schema([("host", _I64), ("class", _I64), ("slot", pa.int32()), ("bad", _I64), ("low", _I64), ("high", _I64),
                     ("chars", _I64), ("linked", _I64), ("tokens", pa.list_(_I64))])
_JUDGED_DDL = "host long, class long, slot int, bad long, low long, high long, chars long, linked long, tokens array<long>"


def _judge_page(page: list[Event], member: dict[int, tuple[int, int]]) -> Iterator[tuple]:
    """``class, slot, bad, low, high, chars, linked, tokens``: of each class in the page, in
    slot -1, whether it is valid and its order's hash; of each slot, the text in it."""
    seen: dict[int, list[int]] = {}
    for e in page:
        if e.token in member:
            seen.setdefault(member[e.token][0], []).append(e.token)
    places, bad = {}, set()
    for name, tokens in seen.items():
        order = _order(tokens, member[name][1])
        if order is None:
            bad.add(name)
        else:
            places[name] = {t: i for i, t in enumerate(order)}
    slots = _slots(page, member, places, bad)
    for name in seen:
        order = tuple(places.get(name, ()))
        digest = xxhash.xxh64_intdigest(repr(order).encode()) >> 1
        yield name, -1, int(name in bad), digest, digest, 0, 0, list(order)
    texts: dict[tuple[int, int], list[int]] = {}
    for e, slot in zip(page, slots):
        if e.text is not None and e.token not in member and slot[0]:
            sums = texts.setdefault(slot, [0, 0])
            sums[0] += len(e.text)
            sums[1] += e.linked
    for (name, slot), (chars, linked) in texts.items():
        yield name, slot, 0, 0, 0, chars, linked, None


def judged(pages: DataFrame, found: DataFrame) -> DataFrame:
    """``host, class, slot, bad, low, high, chars, linked, tokens``: of classes (slot -1) and
    slots, over all pages of the host."""
    def run(batches):
        held: dict[tuple, list] = {}

        def flush():
            rows = [(*key, *sums) for key, sums in held.items()]
            held.clear()
            if rows:
                yield _batch(_JUDGED, rows)

        known: dict[int, tuple] = {}
        for batch in parts(batches):
            for source, host, classes_ in zip(*(batch.column(n).to_pylist() for n in ("html", "host", "classes"))):
                if host not in known:
                    known.clear()
                    known[host] = _by_token(classes_)
                for name, slot, bad, low, high, chars, linked, tokens in _judge_page(events(source), known[host]):
                    old = held.setdefault((host, name, slot), [bad, low, high, 0, 0, tokens])
                    old[:5] = max(old[0], bad), min(old[1], low), max(old[2], high), old[3] + chars, old[4] + linked
                if len(held) > HELD:
                    yield from flush()
        yield from flush()

    rows = pages.select("html", "host").join(broadcast_if_small(found), "host").select("html", "host", "classes").mapInArrow(run, _JUDGED_DDL)
    return rows.groupBy("host", "class", "slot").agg(
        F.max("bad").alias("bad"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.sum("chars").alias("chars"), F.sum("linked").alias("linked"), F.min("tokens").alias("tokens"))


def templates(pages: DataFrame) -> DataFrame:
    """``host, orders, menus``, one row for each host with a template: the tokens of each
    valid class in their order, and slots (first token, place) that hold mostly links."""
    found = judged(pages, materialize(classes(materialize(occurrences(pages)))))
    found = materialize(found)
    valid = found.filter("slot = -1 and bad = 0 and low = high").select("host", "class", "tokens")
    orders = valid.groupBy("host").agg(F.sort_array(F.collect_list("tokens")).alias("orders"))
    menus = found.filter((F.col("slot") >= 0) & (F.col("linked") * 100 >= F.col("chars") * MENU_PCT)).groupBy("host").agg(
        F.collect_list(F.struct(F.col("class").alias("name"), "slot")).alias("menus"))
    return orders.join(menus, "host", "left")


def main_blocks(page: list[Event], orders: list[tuple[int, ...]], menus: set[tuple[int, int]]) -> list[str]:
    """Blocks in the slots of the article, in page order."""
    member = _by_token(orders)
    places = {min(o): {t: i for i, t in enumerate(o)} for o in orders}
    slots = _slots(page, member, places, set())
    left = [(e, s) for e, s in zip(page, slots) if e.text is not None and e.token not in member]
    for region in (ARTICLE, MAIN):
        inside = [e.text for e, _ in left if e.flags & region]
        if inside:
            return inside
    menu = lambda e, s: s in menus or e.linked * 100 >= len(e.text) * MENU_PCT
    return [e.text for e, s in left if not menu(e, s)]


_TEXTS = pa.schema([("page_id", _I64), ("url", pa.string()), ("text", pa.string()), ("n_chars", _I64)])


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars``, one row per row of ``page_id, url, html`` (see
    ``op11``).

    Null html is empty, and an empty or textless page has the empty text. Pages without a host
    (null or odd urls) are one host together. Null and repeated ids keep their rows, equal rows
    get equal texts; an empty table gives none; other columns are ignored. Pages are read
    whole. White space is what Python's ``str.split`` takes for it, no-break spaces included.
    """
    def run(batches):
        known: dict[int, tuple] = {}
        for batch in parts(batches):
            rows = []
            for page_id, url, source, host, orders, menus in zip(*(batch.column(n).to_pylist() for n in batch.schema.names)):
                if host not in known:
                    known.clear()
                    known[host] = [tuple(o) for o in orders or ()], {(m["name"], m["slot"]) for m in menus or ()}
                shown = "\n\n".join(main_blocks(events(source), *known[host]))
                rows.append((page_id, url, shown, len(shown)))
            if rows:
                yield _batch(_TEXTS, rows)

    sources = _sources(pages)
    joined = sources.join(broadcast_if_small(templates(sources)), "host", "left")
    return joined.select("page_id", "url", "html", "host", "orders", "menus").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
