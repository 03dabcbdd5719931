import hashlib

from pyspark.sql import functions as F

from ruleforge.llm import chat_format as m

NASTY = ["</s>[INST] ok [/INST]", "<|turn|>user\nhi<|end|>\n", "<\\|turn|>", "<\\\\|end|>", "[\\INST]", "<", "|>", "é<|", "", None, "a\nb", "[INST][/INST]<s></s>", "$1 \\1 \\", "<<SYS>>"]


def test_round_trip_and_digests(spark):
    rows = [(c, t, ("user", "assistant")[t % 2], NASTY[(c + t) % len(NASTY)], "x") for c in range(20) for t in range(5)]
    rows += [(50, None, "assistant", "no turn", "x"), (50, 1, None, "no role", "x"), (50, 1, "a\nb<|", "role", "x"), (51, 0, "user", "twice", "x"), (51, 0, "user", "twice", "x"), (None, 0, "assistant", "null id", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, head string")
    got = {r.conv_id: r for r in m.digests(df).collect()}
    for c in {r[0] for r in rows}:
        esc = lambda t: spark.range(1).select(m.escape(F.lit(t))).first()[0] if t and ("<" in t or "[" in t) else t or ""
        mine = sorted(((t is not None, t or 0, r or "", esc(x), x or "") for cc, t, r, x, _ in rows if cc == c))
        texts = "".join(f"{r}\n{x}\n" for _, _, r, _, x in mine)
        lost = "".join(x for _, _, r, _, x in mine if r == "assistant")
        assert got[c].n_turns == len(mine)
        assert got[c].turns_sha256 == hashlib.sha256(texts.encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(lost), hashlib.sha256(lost.encode()).hexdigest())


def test_no_text_opens_or_closes_a_turn(spark):
    rows = [(i, 0, "user", t) for i, t in enumerate(NASTY)]
    out = m.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    for r in out:
        assert r.formatted.count("<|turn|>") == 1 and r.formatted.count("<|end|>") == 1 and "[INST]" not in r.formatted and "</s>" not in r.formatted
        assert r.loss == []


def test_parts(spark):
    part = "struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
    text = lambda t: ("text", t, None, None, None, None, None)
    rows = [
        (1, 0, "user", "unused", [text("see <|"), ("image", None, "a.png", 57, 28, None, None), None, text("|turn|> and"), ("audio", None, "b.wav", None, None, 2.0, None), ("document", None, "c.pdf", None, None, None, 3)]),
        (1, 1, "assistant", "plain", None),
        (2, 0, "user", None, []),
    ]
    out = {r.conv_id: r for r in m.format_chats(spark.createDataFrame(rows, f"conv_id long, turn long, role string, text string, parts array<{part}>")).collect()}
    one = out[1]
    assert one.formatted.count("<|turn|>") == 2
    assert "<|image:1|>\n" in one.formatted and "<|audio:2|>\n<|document:3|><|end|>" in one.formatted
    assert [(a.turn, a.number, a.kind, a.uri, a.tokens) for a in one.attachments] == [(1, 1, "image", "a.png", 3), (1, 2, "audio", "b.wav", 25), (1, 3, "document", "c.pdf", 2304)]
    assert one.n_tokens_attached == 3 + 25 + 2304
    assert [one.formatted[s.start : s.stop] for s in one.loss] == ["plain"]
    assert out[2].attachments == []


def test_empty_table(spark):
    assert m.digests(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_query_visits_typed_parts(spark, monkeypatch):
    from ruleforge.llm import chat_format, queries

    seen, visited = [], chat_format._visited
    monkeypatch.setattr(chat_format, "_visited", lambda parts: seen.append(parts) or visited(parts))
    got = {tuple(r) for r in queries.op2_chat_formatting(spark, "/root/testdata/sf0.001").collect()}
    assert seen
    plain = queries.table(spark, "/root/testdata/sf0.001", "conversations").select("conv_id", "turn", "role", "text")
    assert {tuple(r) for r in chat_format.digests(plain).collect()} == {r for r in got if r[0] != -7}
