"""Answer normalisation, JSON comparison, templates."""

import pytest
from pyspark.sql import functions as F

from qaprep.functions import templates as T
from qaprep.functions import text as X
from qaprep.operators import evaluation as E

TAGGED = [
    ("<answer>7</answer>", "7"),
    ("so <answer> C2H6. </answer> it is", "C2H6"),
    ("<answer>wait...</answer>", "wait.."),
    ("<answer>2.50</answer>", "2.50"),
    ("<answer>2.50.</answer>", "2.50"),
    ("<answer>\n\t8\n</answer>\n", "8"),
    ("<answer>a\n  b</answer>", "a\n  b"),
    ("<answer>1</answer> or <answer>2</answer>", "2"),
    ("<answer>1</answer> or <answer>2", "<answer>1</answer> or <answer>2"),
    ("<answer>1", "<answer>1"),
    ("1</answer>", "1</answer>"),
    ("<answer></answer>", ""),
    ("<answer> \t </answer>", ""),
    ("<Answer>1</Answer>", "<Answer>1</Answer>"),
    ("  plain  ", "plain"),
    ("  wide　", "wide"),
    ("   ", ""),
    ("", ""),
]


def test_norm_tagged(evaluate):
    texts, wanted = zip(*TAGGED)
    assert evaluate(X.norm_tagged, texts) == list(wanted)


COLON = [
    ("Atoms: 12", None, "12"),
    ("Name: toluene\n", None, "toluene"),
    ("Name: toluene. It smells", None, "toluene"),
    ("a: b c: d", None, "d"),
    ("At 09:15, total: 3", None, "3"),
    ("Dose: 2.5e-3", None, "2"),
    ("Dose: 5; see below", None, "5;"),
    ("Atoms: 5<|end|>", None, "5<|end|>"),
    ("Atoms: 5<|end|>", "<|end|>", "5"),
    ("Atoms: 5<|end|>rest", "<|end|>", "5"),
    ("Atoms: <|end|>", "<|end|>", ""),
    ("Atoms: ", None, ""),
    ("the result is toluene", None, "toluene"),
    ("the result is toluene..<|end|>", "<|end|>", "toluene"),
    ("toluene.", None, "toluene"),
    ("  <|end|>", "<|end|>", ""),
    ("", None, ""),
]


def test_norm_colon(evaluate):
    for text, end, wanted in COLON:
        assert evaluate(lambda c: X.norm_colon(c, end), [text]) == [wanted], (text, end)


def test_thinking(evaluate):
    outputs = ["<think>a</think>\n\nb</think>\n42\n", "42\n", None]
    assert evaluate(X.visible_answer, outputs) == ["42", "42", None]
    assert evaluate(X.thinking_part, outputs) == ["<think>a</think>\n\nb</think>", None, None]


def test_answers_match(spark):
    rows = [
        ('{"a": 1, "b": [1, 2]}', '{"b":[1,2],"a":1.0}', True),
        ('{"a": 1}', '{"a": 2}', False),
        ('{"a": 1}', "not json", False),
        ('{"a": 1', '{"a": 1', False),
        ("5", "5", True),
        ("5", "5.0", False),
        ("[1]", "[1 ]", False),
        ("x", None, False),
    ]
    df = spark.createDataFrame(rows, "gold string, pred string, wanted boolean")
    got = df.select(X.answers_match(F.col("pred"), F.col("gold")).alias("m"), "wanted").collect()
    assert [r.m for r in got] == [r.wanted for r in got]


def test_empty_metrics(spark):
    empty = spark.createDataFrame([], "question_id string, prediction string, gold string")
    assert E.exact_match(E.with_match(empty)).first().exact_match == 0.0
    assert E.accuracy_summary(empty).count() == 0
    arrays = spark.createDataFrame([], "input_ids array<int>, labels array<int>")
    assert tuple(E.padding_stats(arrays).first()) == (0.0, 0.0, 0.0)
    assert tuple(E.label_mask_stats(arrays).first()) == (0.0, 0.0, 0.0)


def test_accuracy_breakdown(spark):
    rows = [("q", "<answer>0</answer>", "0"), ("q", "<answer>0</answer>", "1"), ("q", "5", "<answer>5.</answer>"), ("r", '{"a":1}', '{"a": 1}')]
    df = spark.createDataFrame(rows, "question_id string, gold string, prediction string")
    got = {r.question_id: r for r in E.accuracy_by_question(df).collect()}
    assert (got["q"].total, got["q"].correct, got["q"].zero_total, got["q"].zero_correct) == (3, 2, 2, 1)
    assert got["q"].non_zero_accuracy == 1.0 and got["r"].zero_accuracy is None
    assert got["r"].correct == 0  # by question, JSON is compared as text
    total = {r.answer_type: (r.total, r.correct) for r in E.accuracy_summary(df).collect()}
    assert total == {"zero": (2, 1), "non_zero": (2, 1), "overall": (4, 2)}


def test_templates(spark):
    config = T.read_config(
        {
            "system_prompt": "Be brief.",
            "question_set": "structure",
            "questions": [{"id": "q", "user_template": "{a}?", "assistant_template": "{{{b}}}", "level": 3}],
        }
    )
    assert config.templates[0].type == "generic" and config.templates[0].extras == {"level": 3}
    assert T.templates_table(spark, config).first().extras == {"level": "3"}
    with pytest.raises(KeyError):
        T.read_config({"system_prompt": "", "questions": []})
    df = spark.createDataFrame([("{b}", 5, None, True)], "a string, b int, c double, d boolean")
    assert df.select(T.render("{a} {{x}} {b} {c} {d}", df.schema).alias("t")).first().t == "{b} {x} 5 None True"
    with pytest.raises(KeyError):
        T.render("{missing}", df.schema)
    values = T.value_map(df.schema)
    stored = df.withColumn("t", F.lit("{a} {{x}} {b} {c} {d}"))
    assert stored.select(T.render_column(F.col("t"), values).alias("t")).first().t == "{b} {x} 5 None True"
    with pytest.raises(Exception, match="unknown template field: zz"):
        df.select(T.render_column(F.lit("{zz}"), values).alias("t")).collect()
    with pytest.raises(ValueError):
        T.render("{b:>5}", df.schema)


def test_numbers_as_python_writes_them(spark):
    values = [0.00001, 12345678.0, 1e15, 123456789012345680.0, 1e16, 0.0001, 0.00012, 0.001, 1.5, -2.5e-7, -12345678.5, 0.0, 1e100, float("inf"), float("-inf"), 1e22, 9999999.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(T.format_value(F.col("v"), df.schema["v"].dataType)).collect()]
    assert got == [str(v) for v in values]
    nan = spark.createDataFrame([(float("nan"),), (None,)], "v double")
    assert [r[0] for r in nan.select(T.format_value(F.col("v"), nan.schema["v"].dataType)).collect()] == ["nan", "None"]
