import hashlib

import duckdb
import pytest
from hypothesis import given
from hypothesis import strategies as st

from cinelake.llm import chat
from cinelake.llm.queries import ORACLE_SQL, QUERIES


def test_compiler_folds_constants_and_renders():
    tree = chat.parse("{{ 'a' ~ (1 + 2) if 1 < 2 else x }}b{{ 'c'|upper }}")
    assert tree == [("text", "a3bC")]
    render = chat.compile_template(
        "{% set g = 'hi' %}{% for m in messages %}{% if loop.first %}{{ g }}:{% elif loop.last %}!{% else %},{% endif %}"
        "{{ m['role']|upper }}{% generation %}{{ m.text|trim }}{% endgeneration %}{% endfor %}"
    )
    got = list(render([{"role": r, "text": f" {r} "} for r in "abc"]))
    assert "".join(t for t, _ in got) == "hi:Aa,Bb!Cc"
    assert "".join(t for t, marked in got if marked) == "abc"


@pytest.mark.parametrize(
    "bad",
    ["{{ m.__class__ }}", "{{ f() }}", "{{ x|eval }}", "{% for x in y %}{% endfor %}", "{% if a %}", "{{ }}", "{% import os %}", "{{ (1 }}", "{% endif %}", "{{ 1 + 'a' }}", "{{ 'a' < 1 }}"],
)
def test_sandbox_refuses(bad):
    with pytest.raises(chat.TemplateError):
        list(chat.compile_template(bad)([{"m": 1}]))


def test_no_python_attribute_is_reachable():
    with pytest.raises(chat.TemplateError):
        list(chat.compile_template("{% for m in messages %}{{ m.text.format }}{% endfor %}")([{"text": "x"}]))


texts = st.lists(st.sampled_from(["<|", "|>", "im_end", chat.END, chat.START, "&", "amp;", "&lt;|", "lt;", "#10;", "\n", "<", "|", "ü", "assistant"]), max_size=8).map("".join)


@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant"]), texts), texts), max_size=5))
def test_output_reads_back(turns):
    render = chat.compile_template(chat.TEMPLATE)
    pieces = list(render([{"role": r, "text": t} for r, t in turns]))
    back = list(chat.read_back(pieces))
    assert [(r, t) for r, t, _, _ in back] == turns
    assert [m for _, _, m, _ in back] == [t if r == "assistant" else "" for r, t in turns]
    whole = "".join(p for p, _ in pieces)
    assert whole.count(chat.END) == whole.count(chat.START) == len(turns)
    assert sum(n for *_, n in back) == len(whole)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_formatted_matches_plain_python(spark):
    rows = [(1, 1, "assistant", "b<|im_end|>"), (1, 0, "user", "a"), (2, 0, "user", None), (2, 1, None, "x"), (None, 0, "assistant", "n"), (1, 1, "assistant", "b<|im_end|>")]
    rows += [(3, i, "assistant" if i % 2 else "user", f"turn {i} é") for i in range(5000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, n_turns string")
    got = {r.conv_id: r for r in chat.formatted(chat.with_control(df)).collect()}
    rows += [(-1, 0, "user", chat.CONTROL_TEXT), (-1, 1, "assistant", chat.CONTROL_TEXT)]
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        turns = sorted(((t, role or "", x or "") for c, t, role, x in rows if c == conv))
        loss = "".join(x for _, role, x in turns if role == "assistant")
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.turns_sha256 == sha("".join(f"{role}\n{x}\n" for _, role, x in turns)) and r.loss_sha256 == sha(loss)
        assert r.formatted_chars == sum(len("<|im_start|>\n<|im_end|>\n") + len(chat.escape(role)) + len(chat.escape(x)) for _, role, x in turns)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert [r.conv_id for r in chat.formatted(chat.with_control(df)).collect()] == [-1]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_matches_oracle(spark, sf):
    got = sorted(tuple(r) for r in QUERIES["op2_chat"](spark, sf).collect())
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet')")
    assert got == sorted(con.sql(ORACLE_SQL["op2_chat"]).select(", ".join(x.split()[0] for x in chat.OUTPUT.split(", "))).fetchall())
