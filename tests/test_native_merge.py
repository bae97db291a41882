"""A native backend that glues the units of a text itself gives what it gives unit by unit."""

from glossaflow.operators.backends import TAG, NativeBackend
from glossaflow.operators.translate import translate


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_tagged_texts_are_made_without_a_function_per_unit(spark):
    rows = [(1, "eng_Latn", None), (2, None, ""), (3, "deu_Latn", "One. Two three.\nFour"), (4, "fra_Latn", " \n"),
            (5, "zul_Latn", "x"), (6, "eng_Latn", "Said $1 \\ and <arz_Arab>. Ünd so.")]
    df = spark.createDataFrame(rows, "row_id long, source string, text string")
    targets = ["fra_Latn", "zul_Latn", "arz_Arab"]
    whole = translate(df, ["text"], targets, TAG)
    by_unit = translate(df, ["text"], targets, NativeBackend("tag", TAG.column))
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, by_unit.collect()))
    assert "lambdafunction" in _plan(by_unit) and "lambdafunction" not in _plan(whole)
