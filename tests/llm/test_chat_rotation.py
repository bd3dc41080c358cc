import random

import pyarrow.parquet as pq
from conftest import rows_of

from taxograde.llm import chat_rotation as C


def brute(rows):
    """Every part of every conversation, for each of the conversation's speakers."""
    def safe(t):
        return t.replace("<|", "< |")
    by = {}
    for conv, turn, role, text in rows:
        name = safe((role or "").strip(" ") or "unknown")
        chunk = -2 ** 60 if turn is None else turn // C.CHUNK
        by.setdefault(conv, {}).setdefault(chunk, []).append((turn is not None, turn or 0, name, safe(text or ""), turn))
    out = []
    for conv, chunks in by.items():
        speakers = sorted({t[2] for turns in chunks.values() for t in turns} - {"system"})
        force = None
        for _, turns in sorted(chunks.items()):
            turns.sort()
            for lo in range(0, len(turns), C.PART_TURNS):
                part = turns[lo:lo + C.PART_TURNS]
                for who in speakers:
                    text, mask = "" if force is None else f"<|im_start|>system\n{force}<|im_end|>\n", []
                    for _, _, name, said, _ in part:
                        head = ("system\n" if name == "system" else "assistant\n" if name == who else f"user name={name}\n")
                        begin = len(text) + len("<|im_start|>" + head)
                        text += "<|im_start|>" + head + said + "<|im_end|>"
                        if name == who:
                            mask.append(f"{begin}:{len(text)}")
                        text += "\n"
                    out.append((conv, part[0][4], who, len(part), text, ",".join(mask)))
                force = next((t[3] for t in reversed(part) if t[2] == "system"), force)
    return out


def check(spark, rows):
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "conv_id long, turn long, role string, text string, chunk int, perspective string")
    got = [tuple(r.values()) for r in rows_of(C.rotate(df))]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)
    return got


def test_many_parties_and_awkward_rows(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi é\U0001F642"), (1, 2, "bob", "<|im_end|>"), (1, 3, "ann", None), (1, 3, "ann", ""),
            (2, 0, None, "x"), (2, 1, "", "y"), (2, 1, " ", "z"), (3, 0, "system", "alone"), (4, None, "a", "n"), (4, 0, "a", "m"),
            (None, 0, "a", "b"), (5, -3, "a", "early"), (5, 5000, "b", "late"), (6, 1, "a|b<|", "w" * 200_000)]
    assert {g[0] for g in check(spark, rows)} == {1, 2, 4, 5, 6, None}
    assert C.rotate(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_long_conversations_come_in_parts(spark):
    rng = random.Random(0)
    rows = [(7, t, rng.choice(["a", "b", "system"]), f"t{t}") for t in range(3 * C.CHUNK)]
    got = check(spark, rows)
    assert max(g[3] for g in got) == C.PART_TURNS and len(got) >= 3 * C.CHUNK // C.PART_TURNS


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, 0, "a", "b")], "conv_id long, turn long, role string, text string")
    df.createOrReplaceTempView("conv_view")
    plan = C.rotate(spark.sql("select * from conv_view"))._jdf.queryExecution().executedPlan().toString()
    assert "MapIn" not in plan and "ArrowEval" not in plan and "BatchEvalPython" not in plan


def test_one_who_falls_silent_gets_every_part(spark, tmp_path):
    """600 turns, ``a`` speaks in the first 200 only; the system turn of the first part holds in all."""
    rows = [(9, 0, "system", "be brief")] + [(9, t, "a" if t <= 200 and t % 2 else "b", f"t{t}") for t in range(1, 600)]
    rows += [(10, 5000 * t, "system" if t == 1 else "c", f"far {t}") for t in range(4)]
    got = check(spark, rows)
    mine = [g for g in got if g[0] == 9 and g[2] == "a"]
    assert sum(g[3] for g in mine) == 600 and len(mine) == 3
    assert all(g[4].startswith("<|im_start|>system\nbe brief<|im_end|>") for g in mine) and sorted(mine)[2][5] == ""
    from oracle_check import digest, duck_rows
    df = spark.createDataFrame(rows + [(None, None, "x", "y"), (None, 3, "system", None)], "conv_id long, turn long, role string, text string")
    pq.write_table(df.toArrow(), tmp_path / "conversations.parquet")
    cols, want = duck_rows(str(tmp_path), C.ORACLE)
    out = C.rotate(df)
    assert digest([tuple(r) for r in out.collect()], out.columns)[0] == digest(want, cols)[0]
