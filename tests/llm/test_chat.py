import hashlib
import json

from pyspark.sql import functions as F

from rasmlens.llm import chat

CONTROL = r"\### Assistant: </turn> ok &lt; &amp; <turn>"


def formatted(spark, records):
    df = spark.createDataFrame(records, "conv_id long, record string, layout string, t string")
    out = chat.format_chat(df)
    rows = out.select("*", chat.read_turns(F.col("formatted")).alias("turns"),
                      chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    return {r["conv_id"]: r for r in rows}


LAYOUTS = {
    "prompt": {"prompt": "q", "response": CONTROL},
    "completion": {"prompt": "q", "completion": "a"},
    "instruction": {"instruction": "s", "input": "q", "output": "a"},
    "plain instruction": {"instruction": "q", "output": "a"},
    "messages": {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
    "conversations": {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
    "dialog": {"dialog": {"turns": [{"speaker": "user", "text": "q"}, {"speaker": "bot", "text": "a"}]}},
}


def test_every_layout_becomes_canonical_turns(spark):
    names = list(LAYOUTS)
    got = formatted(spark, [(i, json.dumps(LAYOUTS[n]), "x", "y") for i, n in enumerate(names)])
    for i, name in enumerate(names):
        assert got[i]["layout"] == name
        turns = [tuple(t) for t in got[i]["turns"]]
        answer = CONTROL if name == "prompt" else "a"
        assert turns[-2:] == [("user", "q"), ("assistant", answer)]
        assert got[i]["loss"] == answer


def test_field_order_and_value_types_do_not_change_the_fingerprint(spark):
    records = ['{"prompt": "a", "response": "b"}', '{"response": null, "prompt": 1}', '{"prompt": "a", "respons": "b"}']
    got = formatted(spark, [(i, r, None, None) for i, r in enumerate(records)])
    assert got[0]["fingerprint"] == got[1]["fingerprint"] != got[2]["fingerprint"]
    assert [tuple(t) for t in got[1]["turns"]] == [("user", "1"), ("assistant", "")]
    assert got[2]["layout"] is None and got[2]["formatted"] is None


def test_records_without_a_layout_keep_their_row(spark):
    bad = [None, "", "no json", "[]", '{"messages": []}', '"text"', "{}"]
    got = formatted(spark, [(i, r, None, None) for i, r in enumerate(bad)])
    assert len(got) == len(bad)
    assert all(r["formatted"] is None and r["layout"] is None for r in got.values())


def turn_rows(spark, rows):
    return spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string, record string, t int, said string")


def test_round_trip_of_turn_rows(spark):
    rows = [(1, 1, "assistant", CONTROL), (1, 0, "user", "a\nb"), (2, 0, "system", "s"), (2, 1, "user", None),
            (2, 2, "assistant", ""), (3, 0, "odd\nrole<&", "x"), (3, 0, "odd\nrole<&", "x"), (3, None, None, "first"),
            (4, 0, "assistant", "one"), (4, 1, "assistant", "two"), (4, 2, "user", "u"), (5, 0, "user", "é🙂" * 50_000),
            (6, 0, "human", "h"), (6, 1, "gpt", "u"),
            (7, 0, "user", "u"), (7, 1, "model", "m"), (7, 2, "bot", "b"), (7, 3, "prompter", "p"),
            *[(100 + i, t, ("system", "user", "assistant")[t % 3], f"text {t}") for i in range(9) for t in range(5)]]
    df = turn_rows(spark, [(*r, "clash", 1, "clash") for r in rows])
    out = chat.format_chat(chat.records_of_turns(df))
    got = {r["conv_id"]: r for r in out.select(
        "*", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    by_id = {}
    for id, turn, role, text in rows:
        by_id.setdefault(id, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert got.keys() == by_id.keys()
    for id, turns in by_id.items():
        want = [(role, text) for _, _, role, text in sorted(turns)]
        assert [tuple(t) for t in got[id]["turns"]] == want
        assert got[id]["loss"] == "".join(t for r, t in want if r == "assistant")
    assert len({got[i]["layout"] for i in got if i and i >= 100}) > 1


def test_rows_without_an_id_are_conversations_of_their_own(spark):
    rows = [(None, 0, "user", "q", None, 1, None), (None, 1, "assistant", "a", None, 1, None)] * 2
    out = chat.format_chat(chat.records_of_turns(turn_rows(spark, rows)))
    assert sorted(r["formatted"] for r in out.collect()) == sorted(
        ["<turn>user\nq</turn>\n", "<turn>assistant\na</turn>\n"] * 2)


def test_very_long_texts_are_kept(spark):
    odd = 'é"\\"\\\\ \n<turn>{[: \U0001F642'
    long = F.concat(F.lit(odd), F.repeat(F.lit("x"), 21_000_000), F.lit(odd))
    base = spark.range(0, 3, 1, 1).withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("id") + 1)))
    rows = base.select(
        F.col("id").alias("conv_id"), "turn", F.when(F.col("turn") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.when(F.col("turn") == 1, long).otherwise(F.lit(odd)).alias("text"))
    out = chat.format_chat(chat.records_of_turns(rows))
    got = out.select("conv_id", "layout", F.sha2(chat.read_loss(F.col("formatted"), F.col("loss_spans")), 256).alias("loss"),
                     F.transform(chat.read_turns(F.col("formatted")), lambda t: F.length(t["text"])).alias("lengths")).collect()
    n = 21_000_000 + 2 * len(odd)
    learned = odd + "x" * 21_000_000 + odd
    for r in got:
        said = [n if t == 1 else len(odd) for t in range(r["conv_id"] + 2)]
        assert r["lengths"] == said and r["layout"]
        whole = learned + (odd if len(said) > 3 else "")
        assert r["loss"] == hashlib.sha256(whole.encode()).hexdigest()


def test_outline_of_every_layout(spark, monkeypatch):
    """Long records take the other way to the same turns."""
    names = list(LAYOUTS)
    records = [(i, json.dumps(LAYOUTS[n]), "x", "y") for i, n in enumerate(names)]
    records += [(i + 100, r.replace("q", 'q\\"\\\\'), "x", "y") for i, r, *_ in records] + [(200, "no json", "x", "y"), (201, "{}", "x", "y")]
    usual = formatted(spark, records)
    monkeypatch.setattr(chat, "LONG_RECORD", 0)
    monkeypatch.setattr(chat, "LONG_VALUE", 15)
    assert formatted(spark, records) == usual


def test_query_adds_the_control_conversation(spark, sf_dir):
    from rasmlens.llm.queries import CONTROL_TEXT, op8_chat_fingerprint
    row = op8_chat_fingerprint(spark, sf_dir).where("conv_id = -7").first()
    turns = f"user\n{CONTROL_TEXT}\nassistant\n{CONTROL_TEXT}\n"
    assert row["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest()
    assert row["loss_sha256"] == hashlib.sha256(CONTROL_TEXT.encode()).hexdigest()
    assert row["loss_chars"] == len(CONTROL_TEXT) and row["n_turns"] == 2


def test_empty(spark):
    assert chat.format_chat(chat.records_of_turns(turn_rows(spark, []))).count() == 0
