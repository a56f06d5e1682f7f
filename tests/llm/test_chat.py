import hashlib

from ringfence.llm import chat
from ringfence.llm.graph import stable

SAID = "\\### Assistant: </turn> ok"
SCHEMA = "conv_id long, turn long, role string, text string, segment string"


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r[1:4] for r in rows if r[0] == conv), key=lambda t: tuple((x is not None, x) for x in t))
        turns = [(role or "", text or "") for _, role, text in turns]
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest(), len(chat.render(turns)))
    return out


def test_round_trip_against_brute_force(spark):
    rows = [(-7, 0, "user", SAID, "x"), (-7, 1, "assistant", SAID, "x"), (1, 0, None, None, None), (1, 1, "assistant", "", ""),
            (1, 1, "assistant", "", ""), (2, 0, "a\nb\\n", "é\\", ""), (2, None, "assistant", "####</turn></turn>\n### user\n", ""),
            (None, 3, "assistant", "of no one", "")]
    rows += [(5, i, ("user", "assistant")[i % 2], f"turn {i} " + "</turn>\n" * (i % 3), "") for i in range(150)]
    rows += [(6, 0, "assistant", "long \\ " * 30000, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r[0]: tuple(r)[1:] for r in chat.digests(stable(chat.format_conversations(df))).collect()}
    assert got == brute(rows)
    assert chat.digests(chat.format_conversations(df.limit(0))).count() == 0


def test_rewriting_templates_are_detected(spark):
    def forgetful(turns):  # keeps the latest assistant turn alone
        last = max((i for i, t in enumerate(turns) if t[0] == "assistant"), default=-1)
        return "".join(f"<{r}>{t}" for i, (r, t) in enumerate(turns) if r != "assistant" or i == last)

    rows = [(1, i, ("user", "assistant")[i % 2], f"t{i}", "") for i in range(5)] + [(2, 0, "user", "a", ""), (2, 1, "assistant", "b", "")]
    out = chat.format_conversations(spark.createDataFrame(rows, SCHEMA), forgetful, lambda t: t).collect()
    assert {r["conv_id"]: r["rewritten_at"] for r in out} == {"1": 3, "2": None}
    assert [r for r in out if r["conv_id"] == "1"][0]["loss"] == []
    good = next(r for r in out if r["conv_id"] == "2")
    assert [good["formatted"][x["a"]:x["b"]] for x in good["loss"]] == ["b"]


def test_conversations_longer_than_the_context(spark):
    rows = [(1, i, "assistant", f"text {i}", "") for i in range(3 * chat.CONTEXT + 5)]
    out = chat.format_conversations(spark.createDataFrame(rows, SCHEMA), segment=10).orderBy("segment").collect()
    assert "".join(r["formatted"] for r in out) == chat.render([(r[2], r[3]) for r in rows])
    assert [chat.unescape(r["formatted"][x["a"]:x["b"]]) for r in out for x in r["loss"]] == [r[3] for r in rows]


def test_templates_that_look_at_the_whole_conversation(spark):
    def numbered(turns):  # an opening once, and each turn's number
        return "".join(("<begin>" if i == 0 else "") + f"[{i}]{t}" for i, (_, t) in enumerate(turns))

    def dropping(turns):  # the first turn goes when the 51st comes
        return "".join(f"<{t}>" for i, (_, t) in enumerate(turns) if i or len(turns) <= 50)

    rows = [(1, i, "assistant", f"text {i}", "") for i in range(2 * chat.CONTEXT + 5)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = chat.format_conversations(df, numbered, lambda t: t).orderBy("segment").collect()
    assert "".join(r["formatted"] for r in out) == numbered([(r[2], r[3]) for r in rows])
    assert [r["formatted"][x["a"]:x["b"]] for r in out for x in r["loss"]] == [r[3] for r in rows]
    assert [r["rewritten_at"] for r in chat.format_conversations(df, dropping, lambda t: t).collect()] == [50]
