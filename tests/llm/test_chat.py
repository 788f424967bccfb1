import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgermatch.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = st.text(alphabet="\\<>/turn: ok\n#é<image:0></turn>", max_size=60)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a>b\\", ""]), NASTY), max_size=6))
def test_round_trip(turns):
    f = chat.Flattener(chat.TOKEN_UNITS)
    for role, text in turns:
        f.turn(role, [{"kind": "text", "text": text, "ref": None, "size": None}])
    out = "".join(f.out)
    assert [(role, chat.text_of(parts)) for role, parts in chat.read(out)] == turns
    assert all(kind == "text" for _, parts in chat.read(out) for kind, _ in parts)
    assert f.length == len(out)
    assert [chat.unescape(out[a:b]) for a, b in f.loss] == [t for r, t in turns if r == "assistant"]


def test_parts_keep_their_order_and_tokens(spark):
    parts = [("text", "see <image:9> ", None, None), ("image", None, "s3://x.png", 1569), ("audio", None, "b.wav", None), ("text", None, None, None), ("document", None, "c.pdf", 8)]
    turns = spark.createDataFrame([(1, 0, "user", parts), (1, 1, None, None)], f"conv_id long, turn long, role string, parts {chat.PARTS}")
    row = chat.format_conversations(turns).first()
    assert chat.read(row["formatted"]) == [("user", [("text", "see <image:9> "), ("image", 0), ("audio", 1), ("document", 2)]), ("", [])]
    assert [(a["kind"], a["ref"], a["tokens"]) for a in row["attachments"]] == [("image", "s3://x.png", 3), ("audio", "b.wav", 1), ("document", "c.pdf", 2)]
    for a in row["attachments"]:
        assert row["formatted"][a["at"] :].startswith(f"<{a['kind']}:")


def test_order_ties_nulls_and_repeats(spark):
    rows = [(2, 1, "assistant", "b"), (2, 0, "user", "a"), (2, 1, "assistant", "b"), (2, None, None, None), (None, 0, "user", "no id"), (3, 0, "assistant", None)]
    turns = spark.createDataFrame(rows, SCHEMA).select("conv_id", "turn", "role", chat.text_part(chat.F.col("text")).alias("parts"))
    found = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(turns)).collect()}
    assert set(found) == {2, None, 3}
    assert found[2]["n_turns"] == 4 and found[2]["loss_chars"] == 2
    assert found[2]["turns_sha256"] == hashlib.sha256(b"\n\nuser\na\nassistant\nb\nassistant\nb\n").hexdigest()
    assert found[3]["loss_sha256"] == hashlib.sha256(b"").hexdigest()


def test_hostile_conversation_and_empty_table(spark, small, tmp_path):
    found = {r["conv_id"]: r for r in chat.op5_chat(spark, small).collect()}
    text = chat.HOSTILE
    assert found[-7]["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert found[-7]["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    assert [r["conv_id"] for r in chat.op5_chat(spark, str(tmp_path)).collect()] == [-7]


def test_what_is_not_a_conversation():
    for bad in ("x", "<turn user>\nhi</turn>\n", "<turn user>\nhi\n</turn>"):
        with pytest.raises(ValueError):
            chat.read(bad)


def test_null_and_unknown_parts_are_skipped(spark):
    parts = [("text", "a", None, None), None, ("video", None, "v", 1), (None, "b", None, None), ("attachment", "c", "r", 1), ("image", None, None, None), ("text", "d", None, None)]
    turns = spark.createDataFrame([(1, 0, "user", parts)], f"conv_id long, turn long, role string, parts {chat.PARTS}")
    row = chat.digests(chat.format_conversations(turns)).first()
    assert (row["n_skipped"], row["n_attachments"], row["attachment_tokens"]) == (4, 1, 1)
    assert chat.read(chat.format_conversations(turns).first()["formatted"]) == [("user", [("text", "a"), ("image", 0), ("text", "d")])]


def test_ids_beyond_doubles_and_null_ids(spark):
    big = (1 << 60) + 1
    turns = spark.createDataFrame([(big, 0, "user", "x"), (None, 0, "user", "y")], SCHEMA).coalesce(1).select("conv_id", "turn", "role", chat.text_part(chat.F.col("text")).alias("parts"))
    assert {r["conv_id"] for r in chat.digests(chat.format_conversations(turns)).collect()} == {big, None}
