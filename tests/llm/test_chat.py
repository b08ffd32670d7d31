import random

import pytest

from retrograph.llm import chat


def render(source, **env):
    return chat.compile_template(source)(env)


def brute(messages):
    text, spans = "", []
    for role, body in messages:
        text += f"<|im_start|>{role}\n"
        start = len(text)
        text += body + "<|im_end|>"
        if role == "assistant":
            spans.append((start, len(text)))
        text += "\n"
    return text, spans


@pytest.mark.parametrize(
    "source, env, want",
    [
        ("a{{ x }}b", {"x": 1}, "a1b"),
        ("{{ missing }}{{ m.none.deep }}", {"m": {}}, ""),
        ("{% for i in l %}{{ loop.index }}{{ i }}{% if not loop.last %},{% endif %}{% endfor %}", {"l": ["a", "b"]}, "1a,2b"),
        ("x  {%- if true -%}  y  {%- endif -%}  z", {}, "xyz"),
        ("{% if a == 1 %}one{% elif a == 2 %}two{% else %}many{% endif %}", {"a": 2}, "two"),
        ("{% set n = 'q' ~ 1 %}{{ n | upper }}{# gone #}", {}, "Q1"),
        ("{{ ' a ' | trim + 'b' }}", {}, "ab"),
        ("{{ 'y' if 'b' in s and not (1 > 2) else 'n' }}", {"s": "abc"}, "y"),
        ("{{ m['k'][1] }}{{ m.k | length }}", {"m": {"k": ["a", "b"]}}, "b2"),
        ("{{ none }}{{ true }}{{ 'it\\'s\\n' }}", {}, "trueit's\n"),
        ("{{ 1 < 'a' }}{{ 3 - 1 }}", {}, "false2"),
    ],
)
def test_language(source, env, want):
    assert render(source, **env)[0] == want


@pytest.mark.parametrize("source", ["{{ x.__class__ }}", "{{ _x }}", "{{ x | eval }}", "{% import os %}", "{{ f(1) }}", "{% for x in y %}", "{{ 'a }}", "{{ 1 + }}", "{% if %}{% endif %}", "{{ 1 - 'a' }}", "{% generation %}"])
def test_refused(source):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(source)


def test_fail_and_objects_are_closed():
    with pytest.raises(chat.TemplateError, match="no roles"):
        render("{{ fail('no ' ~ 'roles') }}")
    assert render("{{ x.real }}{{ x['__class__'] }}", x=5)[0] == ""


def test_folding():
    tree = chat.fold(chat.parse("a{{ 'x' ~ 1 + 2 }}b{% if 1 == 2 %}no{% else %}yes{% endif %}{{ v or 'k' }}{% if v and false %}{% endif %}"))
    assert tree[0] == ("text", "ax12byes")
    assert tree[1][0] == "out"


def test_generation_spans_nest():
    text, spans = render("a{% generation %}b{% generation %}c{% endgeneration %}{% endgeneration %}d")
    assert text == "abcd" and spans == [(2, 3), (1, 3)]


def test_conversations(spark):
    rnd = random.Random(1)
    rows = [(c, t, rnd.choice(["user", "assistant", "system"]), rnd.choice(["hi", "é😀", "{{ x }}", "", "w " * 40_000])) for c in range(20) for t in range(rnd.randint(1, 5))]
    rows += [(99, None, None, None), (99, 1, "assistant", None), (99, 1, "assistant", "b"), (99, 1, "assistant", "b"), (None, 1, "user", "lost")]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, messages string, m int")
    got = {r["conv_id"]: r for r in chat.format_chats(frame).collect()}
    assert set(got) == {r[0] for r in rows if r[0] is not None}
    for c, r in got.items():
        own = sorted((x for x in rows if x[0] == c), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        text, spans = brute([(x[2] or "", x[3] or "") for x in own])
        assert (r["text"], list(zip(r["starts"], r["ends"], strict=True)), r["n_messages"]) == (text, spans, len(own))
    assert chat.format_chats(frame.limit(0)).collect() == []
