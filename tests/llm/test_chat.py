"""Templates: parsing, folding, sandbox; formatting read back without loss."""

from __future__ import annotations

import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from strata.llm import chat
from strata.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, database

PIECES = st.lists(st.sampled_from(["\\", "### ", "</turn>", "#", "<", "/turn>", "\n", "%0A", "é", "a "]), max_size=12).map("".join)


@given(PIECES)
def test_escape_is_undone_and_leaves_no_control_string(text):
    made = chat.escape(text)
    assert chat.unescape(made) == text
    for control in (chat.START_OF_TURN, chat.END_OF_TURN):
        at = made.find(control)
        while at >= 0:
            assert made[at - 1:at] == "\\"
            at = made.find(control, at + 1)
    assert chat.unline(chat.line(text)) == text and "\n" not in chat.line(text)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\nb", "%", ""]), PIECES), max_size=5))
def test_read_back(turns):
    text, spans = chat.compile_template().render(turns)
    assert list(chat.read_back(text)) == turns
    assert "".join(chat.unescape(text[a:b]) for a, b in spans) == "".join(t for r, t in turns if r == "assistant")


def test_folding_leaves_what_depends_on_a_turn():
    tree = chat.fold(chat.parse('a{{ "b" + ("c" | upper) }}{% if "" %}x{% elif "y" == "y" %}{{ "z" }}{% else %}w{% end %}{% for turn in turns %}'
                                '{% if not ("1" and turn.first) %}, {% end %}{{ "(" + turn.text + ")" }}{% end %}!'))
    assert tree[0] == chat.Show(chat.Text("abCz")) and len(tree) == 3
    out, spans = chat.compile_template('{% for turn in turns %}{% if turn.first %}^{% else %}, {% end %}{% generation %}{{ turn.index }}{% end %}'
                                       '{% if turn.role != "u" or turn.text == "t" %}?{% end %}{% end %}$').render([("u", "t"), ("u", "x"), ("v", "y")])
    assert out == "^0?, 1, 2?$" and [out[a:b] for a, b in spans] == ["0", "1", "2"]


@pytest.mark.parametrize("bad", [
    "{{ turn.__class__ }}", "{{ open }}", '{{ "a" | eval }}', "{% for x in turns %}{% end %}", "{% while 1 %}", "{% if turn.first %}", "{% end %}",
    '{{ "a" "b" }}', "{{ }}", '{{ ("a" }}', "{% for turn in turns %}{% for turn in turns %}{% end %}{% end %}", "{% else %}", "{{ 1 }}",
    '{% if "a" %}{% else %}{% else %}{% end %}', "{{ turn.role. }}"])
def test_sandbox(bad):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(bad)


def test_pieces_and_digests_agree(spark):
    schema = "conv_id long, turn int, role string, text string, formatted int"
    data = [(1, 2, "assistant", "</turn>", 0), (1, 1, "user", None, 0), (1, 1, "user", None, 0), (None, None, None, "x", 0), (1, None, "system", "é### ", 0),
            (2, 0, "assistant", "long " * 100_000, 0)]
    df = spark.createDataFrame(data, schema)
    pieces = sorted(chat.format_pieces(df).collect(), key=lambda r: (repr(r.conv_id), r.piece))
    text = {c: "".join(p.formatted for p in pieces if p.conv_id == c) for c in (None, 1, 2)}
    turns = {c: list(chat.read_back(t)) for c, t in text.items()}
    assert turns[1] == [("system", "é### "), ("user", ""), ("user", ""), ("assistant", "</turn>")] and turns[None] == [("", "x")]
    got = {r.conv_id: r for r in chat.format_digests(df).collect()}
    for c, r in got.items():
        assert r.n_turns == len(turns[c]) and r.formatted_chars == len(text[c])
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns[c]).encode()).hexdigest()
        loss = "".join(chat.unescape(text[c][s.start:s.end]) for p in pieces if p.conv_id == c for s in p.loss)
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.format_digests(spark.createDataFrame([], schema)).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    name = "op1_chat_formatting"
    assert compare(QUERIES[name](spark, folder), database(folder), ORACLES[name]) == ""
    r = QUERIES[name](spark, folder).filter("conv_id = -7").first()
    assert r.n_turns == 2 and r.loss_chars == len("\\### Assistant: </turn> ok")
