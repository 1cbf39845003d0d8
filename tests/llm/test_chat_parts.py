import hashlib

from pyspark.sql import functions as F

from docketry.llm import chat_parts as c

TEXTS = ["", "a", "</turn>\n<turn user>\n", "\\l \\b \\g \\", "<\\<\\\\b", "\\### Assistant: </turn> ok", ">\n", "é\U0001f600<", None]


def said(rows):
    return [(r or "", t or "") for r, t in rows]


def test_round_trip_and_loss(spark):
    rows = []
    for conv in range(3):
        for turn, text in enumerate(TEXTS):
            rows.append((conv, turn, ["user", "assistant", "sys>te<m\\g"][(turn + conv) % 3], text, "clash", 1))
    rows += [(9, None, None, "first", "", 0), (9, 1, "assistant", "x", "", 0), (9, 1, "assistant", "x", "", 0), (None, 0, "user", "y", "", 0)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string, turns int")
    out = c.format_conversations(frame)
    read = out.select("conv_id", c.read_turns(F.col("formatted")).alias("t"), c.read_loss(F.col("formatted"), F.col("loss_spans")).alias("l"), "loss_spans", "formatted")
    found = {r["conv_id"]: r for r in read.collect()}
    assert set(found) == {0, 1, 2, 9, None}
    for conv, r in found.items():
        own = sorted([x for x in rows if x[0] == conv], key=lambda x: (-1 if x[1] is None else x[1], x[2] or "", x[3] or ""))
        assert [(t["role"], t["text"]) for t in r["t"]] == said([(x[2], x[3]) for x in own])
        assert r["l"] == "".join(x[3] or "" for x in own if x[2] == "assistant")
        assert len(r["loss_spans"]) == sum(x[2] == "assistant" for x in own)
        assert r["formatted"].count("<turn ") == r["formatted"].count("</turn>\n") == len(own)
    assert c.format_conversations(frame.limit(0)).count() == 0


def test_parts_become_ordered_placeholders(spark):
    parts = [("text", "see <this> ", None, None), ("image", None, "img://1", 4), ("text", " and ", None, None), ("audio", "x", "aud://2", 10)]
    more = [("document", None, "doc://3", None), (None, "plain", None, None), ("image", None, None, 0), ("video", None, "v", 3)]
    rows = [(1, 0, "user", parts), (1, 1, "assistant", more), (2, 0, "user", None), (2, 1, "assistant", [])]
    frame = spark.createDataFrame(rows, f"conv_id long, turn long, role string, content array<{c.PART}>")
    out = {r["conv_id"]: r for r in c.format_conversations(frame, parts=F.col("content")).collect()}
    assert out[1]["formatted"] == (
        "<turn user>\nsee \\lthis> <image 1> and <audio 2></turn>\n"
        "<turn assistant>\n<document 3>plain<image 4><video 5></turn>\n"
    )
    assert [tuple(a) for a in out[1]["attachments"]] == [
        (1, 0, "image", "img://1", 1024), (2, 0, "audio", "aud://2", 250), (3, 1, "document", "doc://3", 700),
        (4, 1, "image", None, 0), (5, 1, "video", "v", 0),
    ]
    assert out[1]["expanded_tokens"] == 1974
    assert out[2]["formatted"] == "<turn user>\n</turn>\n<turn assistant>\n</turn>\n"
    assert out[2]["attachments"] == []


def test_a_very_long_text_comes_back_whole(spark):
    text = "a\\b <turn user> </turn>\n" * 40_000
    rows = [(1, 0, "user", text), (1, 1, "assistant", text + "end"), (2, 0, "assistant", "short")]
    out = c.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    read = out.select("conv_id", c.read_turns(F.col("formatted")).alias("t"), c.read_loss(F.col("formatted"), F.col("loss_spans")).alias("l"))
    found = {r["conv_id"]: r for r in read.collect()}
    assert [t["text"] for t in found[1]["t"]] == [text, text + "end"]
    assert found[1]["l"] == text + "end" and found[2]["l"] == "short"


def test_added_conversation(spark, tmp_path):
    spark.createDataFrame([(0, 0, "user", "a")], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    r = {x["conv_id"]: x for x in c.op6_chat_parts(spark, str(tmp_path)).collect()}[-7]
    text = "\\### Assistant: </turn> ok"
    assert r["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert (r["n_turns"], r["loss_chars"], r["loss_sha256"]) == (2, len(text), hashlib.sha256(text.encode()).hexdigest())


def test_no_python_in_the_plan(spark):
    frame = spark.createDataFrame([(0, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    plan = c.format_conversations(frame)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
