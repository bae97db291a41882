import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from glossaflow.functions.text import (
    SplitRules,
    merge_sentences,
    mark_sentences,
    pair_label,
    path_slug,
    split_sentences,
    strip_newlines,
)
from glossaflow.plans.oracle import sentence_ctes


def split_all(spark, texts, rules=SplitRules()):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rows = df.select("id", split_sentences(F.col("text"), rules).alias("s")).collect()
    return [row["s"] for row in sorted(rows, key=lambda row: row["id"])]


CASES = [
    (None, None),
    ("", []),
    ("   ", []),
    (" \n \n", []),
    ("No end mark", ["No end mark"]),
    ("One. Two.", ["One.", "Two."]),
    ("one. two.", ["one. two."]),
    ("Line one\nline two", ["Line one", "line two"]),
    ("a\n\n\nb", ["a", "b"]),
    ("Dr. Smith came. He left.", ["Dr. Smith came.", "He left."]),
    ("See No. 5 and stop. No. Not that.", ["See No. 5 and stop.", "No.", "Not that."]),
    ("The U.S. Army won. It did.", ["The U.S. Army won.", "It did."]),
    ("Fruits, e.g. Apples. Fine.", ["Fruits, e.g. Apples.", "Fine."]),
    ("What?! Yes. Why? Because.", ["What?!", "Yes.", "Why?", "Because."]),
    ("Wait... What? no", ["Wait...", "What? no"]),
    ('He said "Stop." Then left.', ['He said "Stop."', "Then left."]),
    ("It ended (truly.) Then more.", ["It ended (truly.)", "Then more."]),
    ("End. (Next one.)", ["End.", "(Next one.)"]),
    ("¿Qué? ¡Sí! Él vino.", ["¿Qué?", "¡Sí!", "Él vino."]),
    ("It was 3.5 m. 7 came.", ["It was 3.5 m.", "7 came."]),
    ("Many   blanks.   Next   one.", ["Many blanks.", "Next one."]),
    ("Über alles. Élan. Ça va.", ["Über alles.", "Élan.", "Ça va."]),
    ("これは文です。次の文です。", ["これは文です。次の文です。"]),
]


def test_known_texts(spark):
    got = split_all(spark, [text for text, _ in CASES])
    for (text, want), have in zip(CASES, got):
        assert have == want, text


def test_rules_are_an_argument(spark):
    german = SplitRules(prefixes=("bzw",), numeric_prefixes=())
    assert split_all(spark, ["Hier bzw. Dort. Dr. Weg."], german) == [["Hier bzw. Dort.", "Dr.", "Weg."]]
    assert split_all(spark, ["क? ख"], SplitRules(starters=r"\p{Lu}\p{Lo}")) == [["क?", "ख"]]
    assert split_all(spark, ["A. B"], SplitRules(prefixes=(), numeric_prefixes=())) == [["A.", "B"]]


def test_random_texts_against_the_word_by_word_form(spark):
    rng = random.Random(7)
    bits = [
        "Dr", "Mr", "No", "pp", "Art", "e.g", "i.e", "U.S", "A", "x", "Hello", "world", "Élan", "über", "42", "7",
        ".", ".", ".", "..", "...", "?", "!", "?!", '"', "'", "(", ")", "[", "]", "¿", "¡", "«", "»", "“", "”",
        " ", " ", " ", " ", "  ", "\n", "\n\n", ",", "-", "%", "_", "Ω.", ".B.", "-C.",
    ]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    got = split_all(spark, texts)
    table = pa.table({"id": list(range(len(texts))), "text": texts})
    con = duckdb.connect()
    con.register("random_texts", table)
    rows = con.execute(f"WITH {sentence_ctes('random_texts', 'id')} SELECT id, sentences FROM sentence_lists").fetchall()
    want = dict(rows)
    differing = [(texts[i], have, want[i]) for i, have in enumerate(got) if have != want[i]]
    assert not differing, differing[:3]


def test_split_and_merge_keep_all_but_white_space(spark):
    texts = [text for text, _ in CASES if text is not None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rows = df.select("text", merge_sentences(split_sentences(F.col("text"))).alias("merged")).collect()
    for row in rows:
        assert row["merged"] == " ".join(row["text"].split())


def test_splitter_runs_in_generated_code(spark):
    df = spark.range(1).select(F.lit("a. B").alias("t")).select(mark_sentences(F.col("t")).alias("m"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


@pytest.mark.parametrize("text,want", [("a\nb", "ab"), ("\n", ""), (None, None), ("plain", "plain")])
def test_newlines_are_dropped(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(strip_newlines(F.col("t"))).first()[0] == want


def test_labels(spark):
    row = spark.range(1).select(path_slug(F.lit("a/b/c")), pair_label(F.lit("x"), F.lit("y"))).first()
    assert tuple(row) == ("a-b-c", "x_to_y")
