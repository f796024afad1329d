import hashlib
import random

from pyspark.sql import functions as F

from tallyrisk.llm import chat_format as C

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def _sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def _brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        out[conv] = (len(turns), _sha("".join(f"{t[2]}\n{t[3]}\n" for t in turns)), len(loss), _sha(loss))
    return out


def test_round_trip_of_control_strings(spark):
    random.seed(5)
    parts = ["\\", "###", "#", "</turn>", "</turn", ">", "\n", ": ", "\\0", "\\1", "\\9", "é", "😀", "User", "a"]
    rows = []
    for c in range(150):
        for t in range(random.randint(1, 5)):
            role = random.choice(["user", "assistant", "system", None, "User", "x: y", "\\9", "##</turn>\n#", ""])
            rows.append((c, t, role, random.choice([None, "".join(random.choices(parts, k=random.randint(0, 9)))]), "clash"))
    got = C.digest(C.format_chats(spark.createDataFrame(rows, SCHEMA)))
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got.collect()} == _brute(rows)


def test_turn_order_ties_repeats_nulls_and_long_texts(spark):
    long = "x" * 300_000
    rows = [(1, 0, "system", "s", ""), (1, 1, "user", "u", ""), (1, 2, "assistant", long, ""),
            (2, 0, "user", "u", ""), (2, 0, "user", "u", ""), (2, 1, "assistant", "a", ""),
            (3, 0, "assistant", "a", ""), (None, None, None, None, None), (4, 0, "user", "", ""), (4, 1, "assistant", "", ""),
            (4, 2, "user", "", "")]
    got = {r.conv_id: r for r in C.digest(C.format_chats(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert {k: v.valid for k, v in got.items()} == {1: True, 2: False, 3: False, None: False, 4: False}
    assert got[1].loss_chars == 300_000 and got[None].n_turns == 1 and got[2].n_turns == 3


def test_segments_tile_the_text_and_empty_table(spark):
    df = spark.createDataFrame([(1, 0, "user", "a###b", ""), (1, 1, "assistant", "c", "")], SCHEMA)
    row = C.format_chats(df).first()
    assert row.formatted == "".join(s.text for s in row.segments) == "### User: a\\1b</turn>\n### Assistant: c</turn>\n"
    assert [s.loss for s in row.segments] == [False] * 4 + [True, False]
    assert C.digest(C.format_chats(df.filter(F.lit(False)))).count() == 0
