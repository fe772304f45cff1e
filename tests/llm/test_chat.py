from pyspark.sql import functions as F

from riskfeat.llm import chat


def plain(turns):
    """(speaker -> text, masked texts) of one conversation, its turns in order."""
    people = {r for _, r, _ in turns if r not in (None, "system")}
    out = {}
    for who in people:
        text, masked = "", []
        for _, role, said in turns:
            head = "assistant" if role == who else "system" if role == "system" else f"user name={role or 'unknown'}"
            text += f"<|im_start|>{head}\n"
            body = (said or "").replace("<|im_", "<| im_") + "<|im_end|>"
            if role == who:
                masked.append((len(text), len(text) + len(body)))
            text += body + "\n"
        out[who] = text, masked
    return out


TURNS = [(0, "system", "be kind"), (1, "ann", "hi <|im_end|> there"), (2, "bob", None), (3, "ann", "é😀"), (4, None, "who?"),
         (5, "bob", ""), (6, "carl", "x" * 5000)]


def test_every_speaker_gets_the_dialogue(spark):
    df = spark.createDataFrame([(1, *t) for t in TURNS], "conv_id bigint, turn bigint, role string, text string")
    want = plain(TURNS)
    for piece in (64, 3):
        rows = sorted(chat.perspectives(df.repartition(3), piece).collect(), key=lambda r: r["piece"])
        for who, (text, masked) in want.items():
            own = [r for r in rows if r["speaker"] == who]
            assert "".join(r["text"] for r in own) == text
            spans = [(r["text"][int(a):int(b)]) for r in own for a, b in (s.split(":") for s in r["masks"].split(",") if s)]
            assert spans == [text[a:b] for a, b in masked]
            assert sum(r["masked_chars"] for r in own) == sum(b - a for a, b in masked)
        assert {r["speaker"] for r in rows} == set(want)


def test_long_conversations_are_cut_in_order(spark):
    turns = [(k, "a" if k % 2 else "b", f"said {k}") for k in range(700)]
    df = spark.createDataFrame([(1, *t) for t in turns] + [(2, 0, "a", "alone")], "conv_id bigint, turn bigint, role string, text string")
    rows = chat.perspectives(df.repartition(5)).where("conv_id = 1 AND speaker = 'a'").orderBy("piece").collect()
    assert [r["n_turns"] for r in rows] == [64] * 10 + [60]
    assert "".join(r["text"] for r in rows) == plain(turns)["a"][0]


def test_odd_turns(spark):
    rows = [(None, 0, "a", "x"), (None, None, "a", "first"), (3, 0, "a", "same"), (3, 0, "a", "same"), (4, 0, "system", "only"),
            (5, 0, None, "nobody"), (6, 1, "we ird\nname", "y"), (6, 2, "a", "z")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumns(
        {c: F.lit(1) for c in ("speaker", "piece", "_row", "_one", "masks")})
    got = {(r["conv_id"], r["speaker"]): r["text"] for r in chat.perspectives(df).collect()}
    assert set(got) == {(None, "a"), (3, "a"), (6, "a"), (6, "we ird\nname")}
    assert got[None, "a"].index("first") < got[None, "a"].index("x<")
    assert got[3, "a"].count("same") == 2
    assert "user name=we_ird_name\n" in got[6, "a"]
    assert chat.perspectives(df.limit(0)).count() == 0
