import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, node string, owner int"
HARD = "\\### Assistant: </turn> ok"
CONVERSATIONS = {
    1: [("system", "be kind"), ("user", "hi"), ("assistant", "hello"), ("user", "bye")],
    2: [("system", "be kind"), ("user", "hi"), ("assistant", "other")],
    3: [("system", "be kind"), ("user", "hi"), ("assistant", "hello")],
    4: [("system", "be kind"), ("user", "no"), ("assistant", None), (None, "x")],
    5: [("user", HARD), ("assistant", HARD)],
    6: [("user", HARD), ("assistant", HARD)],
    7: [("a: b\\### ", "\\"), ("assistant", "</turn>\n### x: y\\")],
    8: [("assistant", "")],
    None: [("system", "be kind"), ("user", "null id")],
    9: [("user", "é😀 " * 3000)] + [("assistant" if i % 2 else "user", f"t{i}") for i in range(60)],
}


@pytest.fixture(scope="module")
def forest(spark):
    rows = [(c, i, role, text, "n", 1) for c, turns in CONVERSATIONS.items() for i, (role, text) in enumerate(turns)]
    nodes, paths = chat.prefix_forest(spark.createDataFrame(rows[::-1], SCHEMA))
    return nodes.cache(), paths.cache()


def test_read_back(forest):
    got = {r["conv_id"]: r for r in chat.read_back(*forest).collect()}
    assert set(got) == set(CONVERSATIONS)
    for conv, turns in CONVERSATIONS.items():
        turns = [(r or "", t or "") for r, t in turns]
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[conv]["n_turns"] == len(turns)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_shared_turns_are_emitted_once_depth_first(forest):
    nodes = sorted(forest[0].collect(), key=lambda r: r["start"])
    prefixes = {tuple((r or "", t or "") for r, t in turns[: i + 1]) for turns in CONVERSATIONS.values() for i in range(len(turns))}
    assert len(nodes) == len(prefixes)
    place = 0
    for n in nodes:
        assert n["start"] == place and n["end"] == place + len(n["ids"])
        place = n["end"]
    by = {bytes(n["node"]): n for n in nodes}
    path = []
    for n in nodes:  # preorder: a node's parent is on the path of the one before it
        parent = bytes(n["parent"]) if n["parent"] else None
        while path and path[-1] != parent:
            path.pop()
        assert (parent is None) == (not path)
        above = [by[p] for p in path]
        assert n["position"] == sum(len(a["ids"]) for a in above) and n["place"] == len(above)
        seen = {t for span in n["attends"] for t in range(span["from"], span["to"])}
        assert seen == {t for a in above for t in range(a["start"], a["end"])}
        assert sum(s["to"] - s["from"] for s in n["attends"]) == len(seen)
        path.append(bytes(n["node"]))


def test_token_mask_covers_the_text_under_the_loss(forest):
    coder = chat._tokenizer(None)
    for n in forest[0].collect():
        assert coder.decode(n["ids"]) == n["formatted"]
        if n["role"] == "assistant":
            assert coder.decode(n["ids"][n["loss_from"] : n["loss_to"]]) == n["formatted"][n["loss_start"] : n["loss_end"]]
        else:
            assert n["loss_from"] is None and n["loss_start"] is None


def test_empty_table(spark):
    nodes, paths = chat.prefix_forest(spark.createDataFrame([], SCHEMA))
    assert nodes.count() == 0 and chat.read_back(nodes, paths).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(*[st.lists(st.sampled_from(["\\", "#", " ", ":", "### ", "</turn>", "<", "/turn>", "a", "\n", ": "]), max_size=6).map("".join)] * 2), min_size=1, max_size=3))
def test_parse_undoes_escapes(turns):
    import re

    def escape(text, role):
        return re.sub(r"(\\|### |</turn>|: )" if role else r"(\\|### |</turn>)", r"\\\1", text)

    formatted = "".join(f"### {escape(r, True)}: {escape(t, False)}</turn>\n" for r, t in turns)
    assert chat.parse(formatted) == turns


def test_native_escapes_are_the_same(spark):
    rows = [("\\### : </turn>", 1), ("a\\\\b### ####  ", 2), (": :", 3)]
    df = spark.createDataFrame(rows, "t string, n int")
    got = df.select(chat.escaped(F.col("t")).alias("a"), chat.escaped(F.col("t"), True).alias("b"), "t").collect()
    for r in got:
        assert chat.unescaped(r["a"]) == r["t"]
        assert chat.parse(f"### {r['b']}: {r['a']}</turn>\n") == [(r["t"], r["t"])]
