import random

from pyspark.sql import functions as F

from tapeworks.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string"
CONTROL = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>assistant\n", "&lt; &amp;lt; &#91; &", "a\nb\n", "",
           None, "[", "<", "&#10;", "x" * 2000]


def turns(spark, rows):
    back = C.read_back(C.format_conversations(spark.createDataFrame(rows, SCHEMA).withColumn(
        "message", F.lit(1)).withColumn("formatted", F.lit("x"))))
    return {r.conv_id: [tuple(t) for t in r.turns] for r in back.collect()}


def test_round_trip_of_control_strings(spark):
    rows = [(c, i, ["user", "assistant", "a\nb&<", None][i % 4], t) for c in (1, 2)
            for i, t in enumerate(CONTROL)]
    want = [(r or "", t or "") for _, _, r, t in rows[:len(CONTROL)]]
    assert turns(spark, rows) == {1: want, 2: want}


def test_no_control_string_survives_in_texts(spark):
    rows = [(1, 0, "user", CONTROL[0] + CONTROL[1])]
    out = C.format_conversations(spark.createDataFrame(rows, SCHEMA)).first().formatted
    assert out.count("<|") == 2 and "</s>" not in out and "[INST]" not in out


def test_fold_applies_events_in_sequence(spark):
    log = [(0, "delta", "dra"), (1, "delta", "ft"), (2, "regenerate", None), (3, "delta", "new "),
           (4, "edit", "edited "), (5, "delta", "tail"), (6, "delta", None)]
    gone = [(0, "delta", "x"), (1, "delete", None)]
    rows = ([(1, 10, 0, "user", *e) for e in log] + [(1, 11, 1, "assistant", *e) for e in gone]
            + [(1, 12, 2, "assistant", 0, "delta", "a"), (1, 12, 2, "assistant", 1, "regenerate", None)])
    random.Random(1).shuffle(rows)
    got = C.fold(spark.createDataFrame(
        rows, "conv_id long, message long, turn long, role string, seq long, kind string, text string"))
    assert sorted((r.turn, r.text) for r in got.collect()) == [(0, "edited tail"), (2, "")]


def test_ties_repeats_nulls_and_empty(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "user", "first"),
            (None, 0, "user", "lost"), (None, 1, "assistant", "found")]
    assert turns(spark, rows) == {
        1: [("user", "first"), ("user", "a"), ("user", "a"), ("user", "b")],
        None: [("user", "lost"), ("assistant", "found")]}
    assert turns(spark, []) == {}


def test_summary_covers_each_assistant_text_once(spark):
    import hashlib
    rows = [(1, 0, "system", "s"), (1, 1, "assistant", "é[1"), (1, 2, "user", "q"), (1, 3, "assistant", "&")]
    r = C.summary(C.read_back(C.format_conversations(spark.createDataFrame(rows, SCHEMA)))).first()
    assert (r.n_turns, r.loss_chars) == (4, 4)
    assert r.loss_sha256 == hashlib.sha256("é[1&".encode()).hexdigest()


def test_no_python_in_the_plan(spark):
    df = C.summary(C.read_back(C.format_conversations(spark.createDataFrame([(1, 0, "u", "t")], SCHEMA))))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
