import hashlib

from hypothesis import given, settings, strategies as st

from lithosense.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, formatted string"


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)


def expected(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_conflicting_and_odd_conversations(spark):
    hard = "</s>[INST] ok [/INST]"
    rows = [
        (1, 0, "user", hard), (1, 1, "assistant", hard),
        (2, 1, "assistant", "second"), (2, 0, "user", "<|im_end|>\n<|im_start|>user<|im_sep|>"),
        (3, 0, None, None), (3, None, "system", ""),
        (4, 0, "us<|im_sep|>er\n", "␛␛<␛/s>␛"), (4, 0, "us<|im_sep|>er\n", "␛␛<␛/s>␛"),
        (None, 0, "user", "hi"), (5, 0, "user", "<" * 3000 + "s>"),
    ]
    df = chat.format_conversations(rows_of(spark, rows))
    out = {r["conv_id"]: r for r in df.collect()}
    assert len(out) == 6 and all(r["identical"] for r in out.values())
    assert [tuple(t) for t in out[2]["turns"]] == [("user", "<|im_end|>\n<|im_start|>user<|im_sep|>"), ("assistant", "second")]
    assert [tuple(t) for t in out[3]["turns"]] == [("system", ""), ("", "")]
    assert out[1]["level"] == 1 and out[4]["level"] == 2 and out[None]["level"] == 0
    assert hard not in out[1]["formatted"] and out[1]["formatted"].count("<|im_start|>") == 2
    d = {r["conv_id"]: r for r in chat.digests(df).collect()}
    assert d[1]["turns_sha256"] == expected([("user", hard), ("assistant", hard)])
    assert d[1]["loss_chars"] == len(hard) and d[1]["loss_sha256"] == hashlib.sha256(hard.encode()).hexdigest()
    assert d[4]["n_turns"] == 2 and d[4]["loss_chars"] == 0


def test_empty_table(spark):
    assert chat.digests(chat.format_conversations(rows_of(spark, []))).count() == 0


def test_the_plan_is_native(spark):
    plan = chat.digests(chat.format_conversations(rows_of(spark, [(1, 0, "user", "a")])))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@settings(max_examples=8, deadline=None)
@given(texts=st.lists(st.lists(st.sampled_from([*chat.CONTROL, "␛", "<", "[", "|", "s>", "/s>", "a", "\n", "\\", "$1"]), max_size=6).map("".join), min_size=20, max_size=40))
def test_any_text_survives(spark, texts):
    rows = [(i, k, role, t) for i, t in enumerate(texts) for k, role in enumerate(("user", t))]
    assert {r["identical"] for r in chat.format_conversations(rows_of(spark, rows)).collect()} == {True}
