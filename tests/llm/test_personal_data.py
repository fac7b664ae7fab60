"""Plain identifiers against the patterns as given, disguised ones against their place."""

from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import pii
from strata.llm.queries import QUERIES

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(d[::-1])) % 10 == 0


def brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "_", "@", ".", "-", " ", "+", "(", "1", "25", "256", "4111 1111 1111 1111", "x@y.z", "1.2.3.4", "é", "\n"]),
                max_size=25).map("".join))
def test_plain_spans(text):
    assert pii.plain_spans(text) == brute(text)
    base, full = pii.all_spans(text)
    assert base == brute(text) and set(base) <= set(full)


@pytest.mark.parametrize("text,kind,part", [
    ("mail jоhn@exаmple.com now", "email", "jоhn@exаmple.com"),  # Cyrillic o and a
    ("to john.doe (at) example [dot] com, please", "email", "john.doe (at) example [dot] com"),
    ("to john at example dot co dot uk", "email", "john at example dot co dot uk"),
    ("to john.doe at example dot com.", "email", "john.doe at example dot com"),
    ("to hein.19 at mail5.example dot com, please", "email", "hein.19 at mail5.example dot com"),
    ("to john at mail.example dot com now", "email", "john at mail.example dot com"),
    ("to john at example point com now", "email", "john at example point com"),
    ("to jean point du.pont AT mail point exemple point fr.", "email", "jean point du.pont AT mail point exemple point fr"),
    ("to john dot doe at example.com now", "email", "john dot doe at example.com"),
    ("to dot john at example dot com", "email", "to dot john at example dot com"),
    (" dot john at example dot com", "email", "john at example dot com"),
    ("at ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("jo​hn@example.com", "email", "jo​hn@example.com"),
    ("call plus one five five five one two three four five six seven.", "phone", "plus one five five five one two three four five six seven"),
    ("host one nine two dot 168 dot zero dot one", "ip", "one nine two dot 168 dot zero dot one"),
    ("ip １０.０.０.１ up", "ip", "１０.０.０.１"),
    ("card ４１１１ 1111 1111 1111", "card", "４１１１ 1111 1111 1111"),
])
def test_disguises(text, kind, part):
    base, full = pii.all_spans(text)
    extra = [s for s in full if s not in base]
    assert [(k, text[a:b]) for k, a, b in extra] == [(kind, part)]
    assert pii.redacted(text) == text.replace(part, f"[{kind.upper()}]")


@pytest.mark.parametrize("text", ["one of two at home", "look at that dot", "a (at last) b", "vier dot fünf", "null und nichts", "five, six", "Ελλάς, Москва, ½ x² é"])
def test_clean_text_stays(text):
    assert pii.all_spans(text) == ([], []) and pii.redacted(text) == text


@pytest.mark.parametrize("text", ["but at this point in time", "ended.But at one point it fell", "stood at 5 point 3", "look at example.com", "... at example dot com",
                                  "see a.b at once", "at the dot at that point", "we met at noon dot it was fun", "meet at 5 dot 30",
                                  "arrive at 10 dot 15 pm", "the dot at 3.30 moved"])
def test_prose_with_at_stays(text):
    assert pii.all_spans(text) == ([], []) and pii.redacted(text) == text


def test_spoken_form_of_every_plain_address(spark):
    seen = 0
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect():
        for m in EMAIL.finditer(r.text or ""):
            local, domain = m[0].split("@")
            for said in (f"{local} at {domain.replace('.', ' dot ')}", f"{local} at {' dot '.join(domain.rsplit('.', 1))}"):
                assert pii.redacted(f"to {said} now") == "to [EMAIL] now"
                seen += 1
    assert seen


@pytest.mark.parametrize("text", ["x at " * 40_000, "a dot " * 40_000 + "b at c", "a at b dot " * 3_000, "dot at " * 40_000, "a." * 100_000 + " at b dot c", "x at b" + ".c" * 100_000])
def test_long_spoken_texts_take_linear_time(text):
    pii.all_spans(text)


@pytest.mark.parametrize("text", ["1" * 200_000, "a" * 200_000, "1." * 100_000, " " * 100_000 + "(at)", "+1" + " " * 100_000, "@" * 50_000,
                                  "one " * 50_000, "((" * 50_000, "x dot " * 40_000, "1 " * 100_000 + "z"])
def test_long_texts_take_linear_time(text):
    pii.all_spans(text)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op2_personal_data"](spark, folder).collect()}
    total = 0
    for d in spark.read.parquet(f"{folder}/documents.parquet").collect():
        base = brute(d.text or "")
        total += len(base)
        r = got.pop(d.doc_id)
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert r.base_sha256 == hashlib.sha256(pii.written(base).encode()).hexdigest()
        assert set(pii.written(base).split(",")) <= set(r.spans.split(",")) | {""}
    assert not got and total > 50


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, None, 1), (1, "", 1), (1, "a@b.c", 1), (1, "a@b.c", 1)], "doc_id long, text string, spans int")
    assert sorted((repr(r.doc_id), r.n_email, r.spans) for r in pii.find_personal_data(df).collect()) == [
        ("1", 0, ""), ("1", 1, "email:0:5"), ("1", 1, "email:0:5"), ("None", 0, "")]
    assert sorted(map(repr, (r.text for r in pii.redact(df).collect()))) == ["''", "'[EMAIL]'", "'[EMAIL]'", "None"]
    assert pii.find_personal_data(df.limit(0)).collect() == []
