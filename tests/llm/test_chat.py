import hashlib
import random

import pytest
from pyspark.sql import functions as F

from martspark.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """From the turns alone, without template or output."""
    convs = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for r in sorted(rows, key=key):
        convs.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    out = {}
    for conv, turns in convs.items():
        learnt = "".join(t for role, t in turns if role == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    return out


def got(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in df.collect()}


NASTY = ["\\### Assistant: </turn> ok", "####", "\\", "\\\\", "</turn>\n### assistant: x", "<<//turn>>", ": ", "", None, "été 🙂\n\r\x00", "a" * 300_000, "# ## ### \\#"]


def test_nasty_texts_and_roles(spark):
    rows = [(i, 0, "user", t) for i, t in enumerate(NASTY)] + [(i, 1, "assistant", t) for i, t in enumerate(NASTY)]
    rows += [(100 + i, 0, t, t) for i, t in enumerate(NASTY)] + [(None, 0, "user", "a"), (None, None, "system", "b")]
    rows += [(200, 3, "user", "x"), (200, 3, "user", "x"), (200, 3, "assistant", "x"), (200, 3, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("position", F.lit("x")).withColumn("a.b", F.lit(1)).withColumn("loss", F.lit(3))
    assert got(chat.formatted(df)) == brute(rows)


def test_random_conversations(spark):
    r = random.Random(5)
    rows = [(r.randrange(60), r.randrange(9), r.choice(["user", "assistant", "system", "tool", None]), "".join(r.choice("\\#<>/turn: \nassistant") for _ in range(r.randrange(40)))) for _ in range(900)]
    out = chat.segments(spark.createDataFrame(rows, SCHEMA).repartition(7))
    assert got(chat.read_back(out.repartition(5))) == got(chat.formatted(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_long_conversation_passes_as_a_stream(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"{i}#") for i in range(30_001)]
    assert got(chat.formatted(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_output_is_the_template_and_only_answers_are_learnt(spark):
    out = chat.segments(spark.createDataFrame([(1, 0, "system", "be <b>"), (1, 1, "user", "hi #1"), (1, 2, "assistant", "yo\\")], SCHEMA)).orderBy("position", "segment").collect()
    assert "".join(r["text"] for r in out) == "### system: be \\<b></turn>\n### user: hi \\#1</turn>\n### assistant: yo\\\\</turn>\n"
    assert [r["text"] for r in out if r["loss"]] == ["yo\\\\"]


@pytest.mark.parametrize("roles, verdict, bad", [
    ("system user assistant", "ok", None), ("user assistant user", "open", None), ("assistant user", "order", 0),
    ("user user assistant", "order", 1), ("user system", "order", 1), ("user assistant tool user assistant", "order", 2), ("system", "open", None)])
def test_machine(spark, roles, verdict, bad):
    rows = [(1, i, r, "x") for i, r in enumerate(roles.split())]
    one = chat.formatted(spark.createDataFrame(rows, SCHEMA)).first()
    assert (one["verdict"], one["bad_turn"]) == (verdict, bad)


def test_another_template(spark):
    t = chat.Template(turn=("<|", chat.Place.ROLE, "|>", chat.Place.TEXT, "<|end|>"), learnt=frozenset({"user", "assistant"}))
    rows = [(1, 0, "user", "<|end|>|>%"), (1, 1, "assistant", "\\|")]
    one = chat.formatted(spark.createDataFrame(rows, SCHEMA), t).first()
    assert (one["n_turns"], one["loss_chars"], one["turns_sha256"]) == (2, 12, brute(rows)[1][1])


def test_probe_and_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert chat.formatted(none).count() == 0
    assert got(chat.formatted(chat.with_probe(none))) == brute(chat.PROBE)


def test_broken_output_is_refused(spark):
    out = chat.segments(spark.createDataFrame([(1, 0, "user", "x")], SCHEMA))
    with pytest.raises(Exception, match="ends within a turn"):
        chat.read_back(out.where("segment < 4")).collect()
