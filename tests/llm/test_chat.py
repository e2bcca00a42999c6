import hashlib
import random

from pyspark.sql import functions as F

from waypost.llm.chat import CHAT, format_chats, read_chats

SCHEMA = "conv_id long, turn long, role string, text string, id string, violation int"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def rows():
    r = random.Random(4)
    bits = [*CHAT.controls, "\\", "<", "|", "s>", "im_end", "\n", "é", "😀", " ", "[", "INST]", "hello"]
    out = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    for conv in range(60):
        for turn in range(r.randrange(1, 9)):
            role = r.choice(["user", "assistant"]) if conv % 5 == 0 else ("user", "assistant")[turn % 2]
            text = None if r.random() < 0.05 else "".join(r.choice(bits) for _ in range(r.choice([0, 1, 4, 50])))
            out.append((conv, turn, role, text))
    out += [(100, 0, "system", "x"), (100, 1, "user", "y" * 200_000), (100, 2, None, "z"), (100, 3, "a\nb<s>", "q")]
    out += [(101, 0, "user", "a"), (101, 0, "user", "a"), (101, None, "assistant", "n"), (None, 0, "user", "lost")]
    return out


def test_read_back_equals_the_turns(spark):
    data = rows()
    turns = spark.createDataFrame([(*x, "i", 1) for x in data], SCHEMA).repartition(3)
    got = {r.conv_id: r for r in read_chats(format_chats(turns)).collect()}
    assert set(got) == {x[0] for x in data}
    for conv, r in got.items():
        own = sorted((x for x in data if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0, x[2] is not None, x[2] or ""))
        said = "".join(x[3] or "" for x in own if x[2] == "assistant")
        assert r.n_turns == len(own)
        assert r.turns_sha256 == sha("".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own))
        assert (r.loss_chars, r.loss_sha256) == (len(said), sha(said))
    assert got[-7].valid and not got[100].valid and not got[101].valid and got[1].valid


def test_no_control_string_is_left_in_a_text(spark):
    texts = format_chats(spark.createDataFrame([(*x, "i", 1) for x in rows()], SCHEMA)).filter("loss")
    assert texts.filter(" OR ".join(f"contains(text, '{c}')" for c in CHAT.controls)).count() == 0
    assert texts.count() > 20


def test_violations_and_lengths(spark):
    turns = spark.createDataFrame([(1, 0, "assistant", "a"), (1, 1, "system", "b")], "conv_id long, turn long, role string, text string")
    made = format_chats(turns)
    assert {r.violation for r in made.collect()} == {"assistant after the start", "system after assistant"}
    whole = made.agg(F.sum(F.length("text"))).first()[0]
    assert read_chats(made).first().formatted_chars == whole
    assert format_chats(turns.limit(0)).collect() == [] and read_chats(format_chats(turns.limit(0))).collect() == []
