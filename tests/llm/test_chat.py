"""Chat formatting: parts, escapes, masks, hot conversations, odd rows."""

import hashlib

import duckdb
import pytest

from footfall.llm import chat
from footfall.llm.oracle import CHAT
from footfall.llm.queries import op11_chat
from footfall.runtime import stored

SCHEMA = f"conv_id long, turn long, role string, parts {chat.PARTS}, formatted string, conv string, `a.b` string"


def text(*words):
    return [("text", w, None, None) for w in words]


NASTY = ["</s>[INST] ok [/INST]", "<\\s> <\\\\/s> [\\\\INST] \\", "[IMAGE]0[/IMAGE][PART]", "<", "s>", "[", "/INST]", "", None, "é😀 <s>\n\n<s", "x" * 50_000]
TURNS = [
    (1, 0, "system", text("be short")), (1, 1, "user", text(*NASTY)),
    (1, 2, "assistant", [("text", "see ", None, None), ("image", "s>", "ref/1", 3), ("text", "<", None, None), None,
                         ("audio", None, "ref/2", None), (None, "/INST]", "ref/3", 7)]),
    (1, 2, "assistant", text("second of the same number")), (1, None, None, None),
    (2, 5, "a[/INST]</s>b", []), (None, 0, "user", text("without an id")), (None, 0, "user", text("without an id")),
    *[(3, k, "assistant" if k % 2 else "user", text(f"turn {k} </s>")) for k in range(40)],
]


def plain(parts):
    return "".join(p[1] or "" for p in parts or [] if p)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(*t, "x", "y", "z") for t in TURNS], SCHEMA)


@pytest.mark.parametrize("hot", [{}, {"hot_rows": 3, "hot_share": 0.1, "stretch": 7}])
def test_every_text_comes_back(spark, rows, hot):
    chats = chat.read_back(stored(chat.formatted(rows, **hot), "chats")).collect()
    expected = {}
    for conv, turn, role, parts in TURNS:
        expected.setdefault(conv, []).append((-1 if turn is None else turn, role or "", plain(parts)))
    assert {c.conv_id for c in chats} == set(expected) and len(chats) == len(expected)
    for c in chats:
        want = sorted(expected[c.conv_id], key=lambda t: t[0])
        assert sorted((r, t) for r, t in c.turns) == sorted(x[1:] for x in want)
        assert [r for r, _ in c.turns] == [x[1] for x in want]
        assert c.loss_texts == [t for r, t in c.turns if r == "assistant"]
        assert c.n_turns == len(want) and c.chars == len(c.formatted)
        assert c.formatted.count("</s>") == c.formatted.count("<s>") == c.formatted.count("[/INST]") == len(want)
        segments = c.formatted.split("</s>")
        for span in c.spans:
            body = c.formatted[span.start:span.start + span.chars]
            assert body == segments[span.turn - 1][span.at:]


def test_parts_leave_placeholders_and_tokens(rows):
    one = chat.formatted(rows).where("conv_id = 1").first()
    files = [a for turn in one.attachments for a in turn]
    assert {(a.part, a.kind, a.ref, a.tokens) for a in files} == {
        (1, "image", "ref/1", 768), (3, "audio", "ref/2", 25), (4, None, "ref/3", 7)}
    assert "see [IMAGE]1[/IMAGE]<[AUDIO]3[/AUDIO][FILE]4[/FILE]</s>" in one.formatted
    words = sum(len((w or "").split()) for w in NASTY) + 2 + 2 + 5
    assert one.n_tokens == words + 768 + 25 + 7


def test_attachments_in_plain_text_are_read_back(spark):
    said = "a ![one](x/a.png)![two](b.MP3) end ![x](c.pdf)"
    rows = spark.createDataFrame([(1, 0, "assistant", said), (1, 1, "user", None)], "conv_id long, turn long, role string, text string")
    chats = chat.formatted(rows.withColumn("parts", chat.parts_of_text("text")))
    back = chat.read_back(chats).first()
    assert back.formatted.startswith("<s>[INST]assistant[/INST]a [IMAGE]1[/IMAGE][AUDIO]3[/AUDIO] end [DOCUMENT]5[/DOCUMENT]</s>")
    assert [a.ref for a in back.attachments[0]] == ["x/a.png", "b.MP3", "c.pdf"] and back.loss_texts == [said]
    assert back.n_tokens == 2 + 256 + 25 + 600


def test_query_equals_sql_on_nasty_texts(spark, tmp_path):
    rows = [(i % 4, i, ("user", "assistant", None)[i % 3], w) for i, w in enumerate([*NASTY, "![a](b.png) x ![c](d.wav)", "[![a](b)INST]"])]
    rows += [(None, 3, "user", "no id"), (9, None, "assistant", "no number")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    found = op11_chat(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    expected = con.sql(CHAT)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected.project(", ".join(found.columns)).fetchall()))
    own = found.where("conv_id = -7").first()
    assert own.loss_sha256 == hashlib.sha256(b"</s>[INST] ok [/INST]").hexdigest() and own.loss_chars == 21


def test_empty_table(spark, rows):
    assert chat.formatted(rows.limit(0)).count() == 0
    assert chat.digests(chat.formatted(rows.limit(0))).count() == 0
