"""Toxicity scores: gradient-boosted trees over dense features, with isotonic calibration.

A bounded sample of labelled rows (``sample_rows``, chosen by a hash of the id) is dealt into three parts. From the
first a lexicon is learned: words, and beginnings of words, that are much more frequent in toxic texts. The second
trains the trees on the features of :data:`FEATURES`: lexicon densities, second-person proximity, capitals,
punctuation and obfuscation rates. The third calibrates their output by isotonic regression. Trees and calibration
are Spark's own (``pyspark.ml``); features are computed for every row of the table, over whole texts.

Results: null and empty texts get a score like any other (all features 0); without labels of both kinds the score
is the share of toxic labels (0 without labels). A document labelled twice counts as toxic if one label says so.
Null labels and null ids are not learned from. Repeated rows are scored each; added columns replace input columns
of their names.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from glossaflow.llm.common import Sent, map_batches, quoted, without, worker_state
from glossaflow.scratch import stage

SAMPLE_ROWS = 24_000
LEXICON_SIZE = 20_000
# Tenths of the sample: the first make the lexicon, those up to the second number the trees, the rest calibrate.
LEXICON_PARTS, TREE_PARTS = 6, 8
# A word or beginning enters the lexicon from so many toxic texts on, and from this log odds ratio on.
LEAST_TEXTS = 3
LEAST_LOG_ODDS = 2.5
# Characters of the beginnings of words that are looked at.
BEGINNINGS = (4, 5)
# A lexicon word this many words from a second-person word is near it.
NEAR = 5

# Second-person words of some languages.
SECOND_PERSON = """
you your yours yourself yourselves u ya
du dich dir dein deine deinen deinem deiner ihr euch euer eure
tu te toi ton ta tes vous votre vos
tú ti tus usted ustedes vosotros vuestro vuestra
""".split()
# Signs used in place of letters.
DISGUISES = str.maketrans("013457@$!*", "oieastasi ")

FEATURES = [
    "words", "lexicon_hits", "lexicon_density", "beginning_hits", "beginning_density", "heaviest", "mean_weight",
    "second_person", "near_second_person", "capitals", "shouted", "exclaimed", "asked", "punctuation",
    "obfuscated", "obfuscated_hits",
]

_WORD = re.compile(r"[^\W\d_]+")
_SHOUTED = re.compile(r"\b[A-Z]{3,}\b")
_DISGUISED = re.compile(r"[^\W\d_]+[@$!*0134578]+[^\W\d_]+")
_REMEMBERED = 400_000
_NONE, _SECOND, _BEGINNING, _LEXICON = range(4)


@dataclass(frozen=True)
class Lexicon:
    words: dict[str, float]
    beginnings: dict[str, float]


class _Marks(dict):
    """Kind and weight by word, worked out when first asked for."""

    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.lexicon = lexicon
        self.second = frozenset(SECOND_PERSON)

    def weigh(self, word: str) -> tuple[int, float]:
        if word in self.lexicon.words:
            return _LEXICON, self.lexicon.words[word]
        if word in self.second:
            return _SECOND, 0.0
        weights = [self.lexicon.beginnings[word[:n]] for n in BEGINNINGS if word[:n] in self.lexicon.beginnings]
        return (_BEGINNING, max(weights)) if weights else (_NONE, 0.0)

    def __missing__(self, word: str) -> int:
        kind = self[word] = self.weigh(word)[0]
        return kind

    def features(self, text: str | None) -> list[float]:
        if not text:
            return [0.0] * len(FEATURES)
        if len(self) > _REMEMBERED:
            self.clear()
        words = _WORD.findall(text.lower())
        n = max(len(words), 1)
        kinds = np.frombuffer(bytes(map(self.__getitem__, words)), np.uint8)
        toxic = np.flatnonzero(kinds >= _BEGINNING)
        second = np.flatnonzero(kinds == _SECOND)
        weights = np.array([self.weigh(words[i])[1] for i in toxic]) if len(toxic) else np.zeros(1)
        exact = int((kinds == _LEXICON).sum())
        near = 0
        if len(toxic) and len(second):
            at = np.searchsorted(second, toxic)
            after = np.abs(second[np.minimum(at, len(second) - 1)] - toxic)
            before = np.abs(second[np.maximum(at - 1, 0)] - toxic)
            near = int((np.minimum(after, before) <= NEAR).sum())
        raw = np.frombuffer(text.encode(), np.uint8)
        capitals = int(((raw >= 65) & (raw <= 90)).sum())
        marks = int(((raw > 32) & (raw < 48) | (raw > 57) & (raw < 65)).sum())
        disguised = _DISGUISED.findall(text)
        uncovered = sum(self.weigh(w.lower().translate(DISGUISES).replace(" ", ""))[0] == _LEXICON for w in disguised)
        return [
            float(np.log1p(len(words))),
            float(np.log1p(exact)),
            exact / n,
            float(np.log1p(len(toxic) - exact)),
            (len(toxic) - exact) / n,
            float(weights.max()),
            float(weights.sum()) / n,
            len(second) / n,
            near / n,
            capitals / len(raw),
            len(_SHOUTED.findall(text)) / n,
            text.count("!") / n,
            text.count("?") / n,
            marks / len(raw),
            len(disguised) / n,
            uncovered / n,
        ]


def with_features(docs: DataFrame, lexicon: Lexicon, text: str, drop_text: bool = True) -> DataFrame:
    """``docs`` with a column per feature; no shuffle."""
    sent, key = Sent(docs.sparkSession, lexicon), uuid.uuid4().hex
    names = [c for c in docs.columns if c != text or not drop_text]
    fields = docs.select(*map(quoted, names)).schema.fields
    schema = StructType([*fields, *(StructField(f"__{f}", DoubleType(), False) for f in FEATURES)])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        marks = worker_state("toxicity", key, lambda: _Marks(sent.open()))
        made = np.array([marks.features(value) for value in batch.column(text).to_pylist()]).reshape(-1, len(FEATURES))
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in names), *(pa.array(column) for column in made.T)],
            [*names, *(f"__{f}" for f in FEATURES)],
        )

    return map_batches(docs, run, schema, text)


def learn_lexicon(labelled: DataFrame, size: int = LEXICON_SIZE) -> Lexicon:
    """Words and beginnings by how much more frequent they are in toxic texts of ``labelled`` (``text, toxic``)."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: dict[str, list[int]] = {}
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = set(_WORD.findall((text or "").lower()))
            keys = {f"w{w}" for w in words} | {f"b{w[:n]}" for w in words for n in BEGINNINGS if len(w) > n}
            for key in keys:
                found.setdefault(key, [0, 0])[toxic] += 1
        clean, toxic = zip(*found.values()) if found else ((), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), pa.array(clean, pa.int64()), pa.array(toxic, pa.int64())],
            ["key", "clean", "toxic"],
        )

    totals = labelled.agg(F.sum(F.col("toxic").cast("long")), F.count("*")).first()
    toxic_texts = totals[0] or 0
    clean_texts = totals[1] - toxic_texts
    counts = map_batches(labelled, count, "key string, clean long, toxic long").groupBy("key").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    )
    odds = F.log((F.col("toxic") + 0.5) / (toxic_texts + 1.0)) - F.log((F.col("clean") + 0.5) / (clean_texts + 1.0))
    kept = (
        counts.where(F.col("toxic") >= LEAST_TEXTS).select("key", odds.alias("weight"), "toxic")
        .where(F.col("weight") >= LEAST_LOG_ODDS)
        .orderBy(F.desc(F.col("weight") * F.log1p("toxic")), "key").limit(size).toArrow().to_pydict()
    )
    pairs = list(zip(kept["key"], kept["weight"]))
    return Lexicon({k[1:]: w for k, w in pairs if k[0] == "w"}, {k[1:]: w for k, w in pairs if k[0] == "b"})


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    prior: float


def _margin(trees: GBTClassificationModel, features: DataFrame) -> DataFrame:
    """``features`` with the trees' probability as ``__margin``, without the feature columns."""
    names = [f"__{f}" for f in FEATURES]
    row = F.struct(*(quoted(c) for c in features.columns if c not in names))  # its names cannot clash here
    assembled = VectorAssembler(inputCols=names, outputCol="__vector").transform(features.select(row.alias("__row"), *names))
    return trees.transform(assembled).select("__row.*", vector_to_array("probability")[1].alias("__margin"))


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, label: str = "toxic", text: str = "text",
        id_column: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Learn from documents with a label for which ``allowed`` (over the id) holds, ``sample_rows`` at most."""
    spark = docs.sparkSession
    ids = labels.where(allowed & quoted(id_column).isNotNull() & quoted(label).isNotNull()).groupBy(
        quoted(id_column).alias("id")
    ).agg(F.max(quoted(label).cast("int")).alias("toxic"))
    order = F.xxhash64(F.col("id").cast("string"), F.lit("toxicity"))
    drawn = ids.orderBy(order, "id").limit(sample_rows).withColumn("part", F.pmod(order, F.lit(10)).cast("int"))
    rows = docs.select(quoted(id_column).alias("id"), quoted(text).alias("text")).join(F.broadcast(drawn), "id")
    rows = rows.select("text", F.least(F.col("toxic"), F.lit(1)).alias("toxic"), "part")
    lexicon = learn_lexicon(rows.where(F.col("part") < LEXICON_PARTS).select("text", "toxic"))
    features = stage(with_features(rows.where(F.col("part") >= LEXICON_PARTS), lexicon, "text"), "toxicity_features")
    seen = {(r["last"], r["toxic"]): r["n"] for r in features.groupBy(
        (F.col("part") >= TREE_PARTS).alias("last"), "toxic").agg(F.count("*").alias("n")).collect()}
    total = sum(seen.values())
    prior = sum(n for (_, toxic), n in seen.items() if toxic == 1) / total if total else 0.0
    if not all((False, toxic) in seen for toxic in (0, 1)):
        return ToxicityModel(lexicon, None, None, prior)
    few = features.coalesce(max(1, spark.sparkContext.defaultParallelism))
    train = VectorAssembler(inputCols=[f"__{f}" for f in FEATURES], outputCol="__vector").transform(
        few.where(F.col("part") < TREE_PARTS)
    ).select("__vector", F.col("toxic").cast("double").alias("__label"))
    trees = GBTClassifier(
        featuresCol="__vector", labelCol="__label", maxIter=20, maxDepth=3, stepSize=0.3, seed=7
    ).fit(train)
    last = _margin(trees, few.where(F.col("part") >= TREE_PARTS)).select("__margin", F.col("toxic").cast("double").alias("__label"))
    calibration = None
    if all((True, toxic) in seen for toxic in (0, 1)):
        calibration = IsotonicRegression(featuresCol="__margin", labelCol="__label", predictionCol="__score").fit(last)
    return ToxicityModel(lexicon, trees, calibration, prior)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", drop_text: bool = False) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on). No shuffle."""
    kept = without(docs, "score", "predicted")
    if model.trees is None:
        found = (kept.drop(text) if drop_text else kept).withColumn("score", F.lit(float(model.prior)))
    else:
        found = _margin(model.trees, with_features(kept, model.lexicon, text, drop_text))
        if model.calibration is not None:
            found = model.calibration.transform(found).withColumn("score", F.col("__score")).drop("__score", "__margin")
        else:
            found = found.withColumnRenamed("__margin", "score")
    bounded = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score")))
    return found.withColumn("score", bounded).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
