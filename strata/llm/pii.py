"""Personal data in text, also where it is disguised, at its place in the source.

Plain identifiers are found in the text as it is. For disguised ones, a chain of
transducers rewrites the text: look-alike and full-width characters become ASCII and
invisible ones go; spelled digits become digits; "(at)", "[dot]" and the like become signs.
Each transducer keeps, for every character of its output, which characters of its input it
came from; composed, these maps take a span found in the normal form back to the source.
Texts in which no transducer has anything to do are not rewritten at all.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import parts, texts

# --- Fixed values: kinds in the order of the contract, and its patterns. ---
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Starting within a run of digits succeeds only if starting at its first does, so the run
# is never tried twice, however long.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Letters of other scripts that look like Latin ones.
_LOOKALIKES = dict(zip(
    "АВЕКМНОРСТХУаеорсухіјѕԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧοανρ",
    "ABEKMHOPCTXYaeopcyxijsdqwABEZHIKMNOPTYXoavp", strict=True))
_INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
_DIGIT_WORDS = {
    w: str(i) for words in (
        "zero one two three four five six seven eight nine",
        "zéro un deux trois quatre cinq six sept huit neuf",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
    ) for i, w in enumerate(words.split())
} | {"oh": "0"}
# Where a spoken domain ends; codes that are English words (in, it,
# is, me, my, no, so, to, us, ...) are not among them, as "at this point it" is prose.
_ENDS = frozenset(
    "com org net edu gov mil int info biz io app dev eu uk fr de es ch at ie nl lu dk se fi pl pt cz sk hu ro bg gr hr si ee lv lt mt cy "
    "li mc ca mx ar cl co pe uy ve ec bo py cr gt hn ni pa cu au nz jp cn hk tw kr sg th vn id ph ru ua by tr il ae sa eg ma tn dz za ng ke br tv cc "
    "xyz example".split())
# --- End of fixed values. ---

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each @: what may stand before it, not beyond the last match, and a domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def plain_spans(text: str) -> list[Span]:
    """Identifiers as they stand, by start, then kind."""
    found: list[Span] = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.groups()]
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                found.append(("phone", m.start(), m.end()))
    found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return found


class Rewrite:
    """A text with, for each character, the source places [start, end) it stands for."""

    def __init__(self, text: str):
        self.text, self.start, self.end = text, list(range(len(text))), list(range(1, len(text) + 1))

    def edit(self, changes: list[tuple[int, int, str]]) -> None:
        """Replace [a, b) by a text, for changes in order that do not overlap."""
        if not changes:
            return
        text, start, end, at = [], [], [], 0
        for a, b, new in changes:
            text.append(self.text[at:a])
            start += self.start[at:a]
            end += self.end[at:a]
            text.append(new)
            start += [self.start[a]] * len(new)
            end += [self.end[b - 1]] * len(new)
            at = b
        self.text = "".join([*text, self.text[at:]])
        self.start, self.end = start + self.start[at:], end + self.end[at:]

    def source(self, a: int, b: int) -> tuple[int, int]:
        return self.start[a], self.end[b - 1]


# Look-alikes, invisible and full-width characters, and digits of other scripts or forms.
_ODD = re.compile("[" + "".join(_LOOKALIKES) + _INVISIBLE + "\uff01-\uff5e\u0660-\u0669\u06f0-\u06f9\u0966-\u096f"
                  "\u2460-\u2468\U0001d7ce-\U0001d7ff\u00b2\u00b3\u00b9\u2070-\u2079\u2080-\u2089]")
_DIGIT_WORD = "|".join(sorted(map(re.escape, _DIGIT_WORDS), key=len, reverse=True))
_SPELLED = re.compile(
    rf"(?<!\w)(?:(?:plus|\+)[ -]*)?(?:{_DIGIT_WORD}|[0-9]+)(?:(?:[ ,.-]+|[ ]*(?:dot|point|punkt|punto)[ ]*)(?:{_DIGIT_WORD}|[0-9]+)){{3,}}(?!\w)", re.I)
_SPELLED_PART = re.compile(rf"({_DIGIT_WORD})(?!\w)|[0-9]+|(plus)(?!\w)[ -]*|(dot|point|punkt|punto)(?!\w)|([ ]+)|[,.+-]", re.I)
_HAS_WORD = re.compile(rf"(?<!\w)(?:{_DIGIT_WORD})(?!\w)[ ,.-]+(?:{_DIGIT_WORD}|dot|point|punkt|punto)(?!\w)", re.I)
_BRACKETS = re.compile(r"[\[({<]\s*(?:(at|arroba|@)|(?:dot|punkt|point|punto|\.))\s*[\])}>]\s*", re.I)
_AT = re.compile(" (?=at )", re.I)
_SPOKEN_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:(?:\.| (?i:dot|point|punkt|punto) )[A-Za-z0-9-]+)+")
_SPOKEN_SIGN = re.compile(" (dot|point|punkt|punto) ", re.I)
_SPOKEN_DOT = re.compile(" dot ", re.I)
_MIXED = re.compile(r"(?<=@)[A-Za-z0-9-]+(?:(?: dot |\.)[A-Za-z0-9-]+)+", re.I)


def _ascii(c: str) -> str:
    if c in _INVISIBLE:
        return ""
    if c in _LOOKALIKES:
        return _LOOKALIKES[c]
    digit = unicodedata.digit(c, None)
    if digit is not None:
        return str(digit)
    plain = unicodedata.normalize("NFKC", c)
    return plain if len(plain) == 1 and plain.isascii() else c


def _spoken(text: str) -> Iterator[tuple[int, int, str]]:
    """Signs of spoken addresses, around each " at ": a domain with stops or words for them,
    and a local part not beyond the last match. Some word for a stop must be there: "look at
    example.com" is prose, as are "at this point in time" and "at 5 dot 30" (``_ENDS``)."""
    done = 0
    for m in _AT.finditer(text):
        at = m.start()
        domain = _SPOKEN_DOMAIN.match(text, at + 4) if at > done else None
        if not domain:
            continue
        after = list(_SPOKEN_SIGN.finditer(text, domain.start(), domain.end()))
        words = {d[1].lower() for d in after}
        if re.split("[ .]", domain[0])[-1].lower() not in _ENDS:
            continue
        start, before = at, []
        while True:
            low = start
            while low > done and text[low - 1] in _LOCAL:
                low -= 1
            if low == start:  # no label before this word for a stop: it is not part of it
                start = before.pop().end() if before else at
                break
            start = low
            sign = next((d for w in words | {"dot"} if start - len(w) - 2 >= done and (d := _SPOKEN_SIGN.match(text, start - len(w) - 2, start))), None)
            if not sign:
                break
            before.append(sign)
            start = sign.start()
        if (before or after) and any(c.isalnum() for c in text[start:at]):
            signs = [(d.start(), d.end(), ".") for d in reversed(before)]
            yield from [*signs, (at, at + 4, "@"), *((d.start(), d.end(), ".") for d in after)]
            done = domain.end()


def rewritten(text: str) -> Rewrite | None:
    """The normal form with its map, or None if it is the text itself."""
    odd = not text.isascii() and _ODD.search(text)
    low = text.lower()
    said = " dot " in low or (" at " in low and any(w in low for w in (" point ", " punkt ", " punto ")))
    if not (odd or _BRACKETS.search(text) or said or _HAS_WORD.search(text)):
        return None
    r = Rewrite(text)
    if odd:
        r.edit([(m.start(), m.end(), _ascii(m[0])) for m in _ODD.finditer(text) if _ascii(m[0]) != m[0]])
    changes = []
    for run in _SPELLED.finditer(r.text):
        parts = list(_SPELLED_PART.finditer(r.text, run.start(), run.end()))
        dotted = any(m[3] for m in parts)  # then blanks only part the digits of one number
        for m in parts:
            if m[1]:
                changes.append((m.start(), m.end(), _DIGIT_WORDS[m[1].lower()]))
            elif m[2] or m[3] or (m[4] and dotted):
                changes.append((m.start(), m.end(), "+" if m[2] else "." if m[3] else ""))
    r.edit(changes)
    changes = []
    for m in _BRACKETS.finditer(r.text):
        start, low = m.start(), changes[-1][1] if changes else 0
        while start > low and r.text[start - 1].isspace():
            start -= 1
        changes.append((start, m.end(), "@" if m[1] else "."))
    r.edit(changes)
    r.edit(list(_spoken(r.text)))
    r.edit([(d.start(), d.end(), ".") for m in _MIXED.finditer(r.text) for d in _SPOKEN_DOT.finditer(r.text, m.start(), m.end())])
    return r if r.text != text else None


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans, and plain and disguised spans together. A disguised one is added where
    it overlaps no other, or where a plain one is only a part of it."""
    base = plain_spans(text)
    form = rewritten(text)
    if form is None:
        return base, base
    full = list(base)
    for kind, a, b in plain_spans(form.text):
        start, end = form.source(a, b)
        within = [s for s in full if s[1] < end and start < s[2]]
        if (kind, start, end) not in within and all(k == kind and start <= s and e <= end for k, s, e in within):
            full.append((kind, start, end))
    full.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return base, full


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redacted(text: str) -> str:
    """The text with each identifier replaced by its kind, like ``[EMAIL]``; overlapping
    ones become one, named after the first."""
    merged: list[list] = []
    for kind, a, b in all_spans(text)[1]:
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(b, merged[-1][2])
        else:
            merged.append([kind, a, b])
    if not merged:
        return text
    out, at = [], 0
    for kind, a, b in merged:
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


_FOUND = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string()),
                    *((f"n_{k}_found", pa.int64()) for k in KINDS)])


def find_personal_data(documents: DataFrame) -> DataFrame:
    """One row per row (see ``op2``): ``n_<kind>`` and ``base_sha256`` tell of plain
    identifiers, ``n_<kind>_found`` and ``spans`` of plain and disguised ones.

    Null text is empty. Null or repeated ids keep their rows; an empty table gives none.
    Other columns are ignored.
    """
    def run(batches):
        for batch in parts(batches):
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                base, full = all_spans(text)
                plain, found = [s[0] for s in base], [s[0] for s in full]
                rows.append((doc, *(plain.count(k) for k in KINDS), hashlib.sha256(written(base).encode()).hexdigest(), written(full),
                             *(found.count(k) for k in KINDS)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _FOUND)], schema=_FOUND)

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    found = ", ".join(f"n_{k}_found long" for k in KINDS)
    return texts(documents).mapInArrow(run, f"doc_id long, {counts}, base_sha256 string, spans string, {found}")


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """The same rows and columns with identifiers in ``text`` replaced; null stays null."""
    at = df.columns.index(text)

    def run(batches):
        for batch in parts(batches):
            done = pa.array([None if t is None else redacted(t) for t in batch.column(at).to_pylist()], pa.string())
            yield batch.set_column(at, text, done)

    return df.mapInArrow(run, df.schema)
