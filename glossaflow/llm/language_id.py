"""Language identification by character language models.

Per language an interpolated Kneser-Ney model over the characters of words (a word stands between two blanks) is
estimated from a bounded sample of labelled texts. The models of all languages share sorted arrays of n-gram
hashes, one per order; beside each hash stand the log probabilities of all languages, and beside each context hash
the log weights for going on to the next shorter n-gram. A text gets the language of the lowest cross-entropy per
character. A part of the sample is kept out of the counts and calibrates the confidence (a temperature) and the
rejection: a text is rejected if its cross-entropy lies further above the usual one of its language than that of
any calibration text, by a margin, at its length.

The sample holds at most ``sample_chars`` characters per language: whole texts, chosen by a hash of the text, so that
copies count once, are learned once, and never both teach and calibrate. Texts longer than ``sample_chars`` are not
learned from; of a language whose first step of the choice is longer, only its longest text. Everything else covers
all rows.

Results: null texts, and texts without a letter, get ``und``, score 0 and are rejected; so does every text if
nothing was learned. Ties go to the first language in alphabetical order. Rows are scored each on their own,
repeated ones too. Added columns replace input columns of their names.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from glossaflow.llm.common import Sent, give_back_memory, map_batches, quoted, without, worker_state

UNKNOWN = "und"
ORDER = 5
SAMPLE_CHARS = 1_500_000
# Share of the sample, in 64ths, that calibrates instead of being counted.
CALIBRATION_64THS = 13
# A text is rejected this many times further out than the furthest calibration text.
REJECT_MARGIN = 3.0
_STEPS = 8  # steps of the sample choice per factor of two
_WORD = re.compile(r"[^\W\d_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_REMEMBERED = 400_000
# Words whose characters are hashed at once when models are trained.
_WORDS_AT_ONCE = 1 << 13


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _hashes(words: list[str], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Word number, place in the word, code and n-gram hashes (by length) of every character of ``' word '``."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    codes = np.frombuffer((" " + "  ".join(words) + " ").encode("utf-32-le"), np.uint32).astype(np.uint64)
    starts = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(codes)) - starts[owner]
    grams, power = [np.zeros(len(codes), np.uint64)], np.uint64(1)
    with np.errstate(over="ignore"):
        for k in range(1, order + 1):
            shifted = np.zeros(len(codes), np.uint64)
            if len(codes) >= k:
                shifted[k - 1 :] = codes[: len(codes) - k + 1]
            grams.append(grams[-1] + (shifted + np.uint64(1)) * power)
            power = power * _BASE
    return owner, place, codes, grams


def _find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(table, wanted)
    at[at == len(table)] = 0
    return at, (table[at] == wanted) if len(table) else np.zeros(len(wanted), bool)


@dataclass
class _Grams:
    """The distinct n-grams of one length, by their hashes."""

    hashes: np.ndarray
    counts: np.ndarray  # hashes x languages
    shorter: np.ndarray  # hash without the first character
    before: np.ndarray  # hash without the last character
    initial: np.ndarray  # whether it stands at the start of a word

    def joined(self, other: _Grams) -> _Grams:
        both = np.concatenate([self.hashes, other.hashes])
        hashes, first, place = np.unique(both, return_index=True, return_inverse=True)
        counts = np.zeros((len(hashes), self.counts.shape[1]))
        counts[place[: len(self.hashes)]] = self.counts
        counts[place[len(self.hashes) :]] += other.counts
        rest = (np.concatenate([getattr(self, name), getattr(other, name)])[first] for name in ("shorter", "before", "initial"))
        return _Grams(hashes, counts, *rest)


@dataclass
class Models:
    """Models of all languages, and how sure they are."""

    languages: list[str]
    order: int
    grams: list[np.ndarray] = field(default_factory=list)  # by length: sorted hashes
    log_probs: list[np.ndarray] = field(default_factory=list)  # by length: hashes x languages
    contexts: list[np.ndarray] = field(default_factory=list)
    log_weights: list[np.ndarray] = field(default_factory=list)
    floor: float = 0.0  # log probability of a character never seen
    temperature: float = 1.0
    usual: np.ndarray | None = None  # by language: mean, variance between texts, variance per character
    limit: float = np.inf

    @classmethod
    def train(cls, counts: dict[tuple[str, str], int], order: int = ORDER) -> Models:
        """``counts`` holds how often each (language, word) occurs."""
        labels, words = zip(*counts) if counts else ((), ())
        return cls.train_table(pa.table({"label": pa.array(labels, pa.string()), "word": pa.array(words, pa.string()),
                                         "n": pa.array(counts.values(), pa.int64())}), order)

    @classmethod
    def train_table(cls, counts: pa.Table, order: int = ORDER) -> Models:
        """``counts`` holds how often each word of a language occurs: ``(label, word, n)``.

        Characters are hashed for ``_WORDS_AT_ONCE`` words at a time; only the tables of distinct n-grams stay.
        """
        counts = counts.sort_by([("label", "ascending"), ("word", "ascending")])
        model = cls(counts.column("label").unique().to_pylist(), order)
        if not model.languages:
            return model
        wide = len(model.languages)
        numbers = pa.compute.index_in(counts.column("label"), pa.array(model.languages, pa.string())).to_numpy()
        weights = counts.column("n").to_numpy()
        signs, tables = np.zeros(0, np.uint64), [None] * (order + 1)
        for start in range(0, counts.num_rows, _WORDS_AT_ONCE):
            words = counts.column("word").slice(start, _WORDS_AT_ONCE).to_pylist()
            owner, place, codes, grams = _hashes(words, order)
            signs = np.union1d(signs, codes)
            language, weight = numbers[start : start + len(words)][owner], weights[start : start + len(words)][owner]
            for k in range(1, order + 1):
                # An n-gram ends at a predicted character; the leading blank is context only.
                ends = np.flatnonzero(place >= max(k - 1, 1))
                table, first, inverse = np.unique(grams[k][ends], return_index=True, return_inverse=True)
                matrix = np.bincount(inverse * wide + language[ends], weight[ends], len(table) * wide)
                at = ends[first]
                found = _Grams(table, matrix.reshape(-1, wide), grams[k - 1][at], grams[k - 1][at - 1], place[at] == k - 1)
                tables[k] = found if tables[k] is None else tables[k].joined(found)
        used = [None] * (order + 1)
        used[order] = tables[order].counts
        for k in range(order - 1, 0, -1):
            # Shorter n-grams count the characters seen before them; at the start of a word there are none.
            raw, longer = tables[k].counts, tables[k + 1]
            below, _ = _find(tables[k].hashes, longer.shorter)
            continued = np.zeros_like(raw)
            np.add.at(continued, below, (longer.counts > 0).astype(float))
            used[k] = np.where(tables[k].initial[:, None], raw, continued)
        size = len(signs) + 1
        model.floor = float(-np.log(size))
        lower = None
        for k in range(1, order + 1):
            table, counted = tables[k].hashes, used[k]
            ones, twos = (counted == 1).sum(0), (counted == 2).sum(0)
            discount = np.clip(ones / np.maximum(ones + 2 * twos, 1), 0.1, 0.95)
            contexts, group = np.unique(tables[k].before, return_inverse=True)
            total = np.zeros((len(contexts), wide))
            kinds = np.zeros((len(contexts), wide))
            np.add.at(total, group, counted)
            np.add.at(kinds, group, (counted > 0).astype(float))
            rest = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
            if k == 1:
                shorter = np.full((len(table), wide), 1.0 / size)
            else:
                at, _ = _find(tables[k - 1].hashes, tables[k].shorter)
                shorter = lower[at]
            probs = np.maximum(counted - discount, 0) / np.maximum(total, 1)[group] + rest[group] * shorter
            lower = probs
            model.grams.append(table)
            model.log_probs.append(np.log(probs).astype(np.float32))
            model.contexts.append(contexts)
            model.log_weights.append(np.log(rest).astype(np.float32))
        return model

    def score_words(self, words: list[str]) -> np.ndarray:
        """One row per word: the log probability by language, then the number of characters predicted."""
        result = np.zeros((len(words), len(self.languages) + 1), np.float32)
        if not words or not self.languages:
            return result
        owner, place, _, grams = _hashes(words, self.order)
        logs = np.zeros((len(owner), len(self.languages)), np.float32)
        open_ = np.flatnonzero(place >= 1)
        for k in range(self.order, 0, -1):
            able = open_[place[open_] >= k - 1]
            later = open_[place[open_] < k - 1]
            at, hit = _find(self.grams[k - 1], grams[k][able])
            logs[able[hit]] += self.log_probs[k - 1][at[hit]]
            missed = able[~hit]
            if k > 1:
                context, known = _find(self.contexts[k - 1], grams[k - 1][missed - 1])
                logs[missed[known]] += self.log_weights[k - 1][context[known]]
            else:
                logs[missed] += self.log_weights[0][0] + self.floor
            open_ = np.concatenate([missed, later])
        np.add.at(result[:, :-1], owner, logs)
        result[:, -1] = np.fromiter(map(len, words), np.float32, len(words)) + 1
        return result

    def calibrate(self, totals: np.ndarray, truth: list[str]) -> None:
        """``totals`` are summed word scores of texts whose language is ``truth``."""
        wide = len(self.languages)
        number = {language: i for i, language in enumerate(self.languages)}
        label = np.array([number.get(name, -1) for name in truth], int)
        usable = (label >= 0) & (totals[:, -1] > 0)
        totals, label = totals[usable].astype(float), label[usable]
        if not len(label):
            return
        logs, chars = totals[:, :-1], totals[:, -1]
        losses = []
        grid = [2.0**e for e in range(0, 9)]
        for t in grid:
            scaled = logs / t
            scaled = scaled - scaled.max(1, keepdims=True)
            losses.append(-(scaled[np.arange(len(label)), label] - np.log(np.exp(scaled).sum(1))).mean())
        self.temperature = grid[int(np.argmin(losses))]
        entropy = -logs[np.arange(len(label)), label] / chars
        self.usual = np.zeros((wide, 3))
        for i in range(wide):
            own = label == i
            own = own if own.sum() >= 20 else np.ones(len(label), bool)
            mean = np.median(entropy[own])
            square = (entropy[own] - mean) ** 2
            terms = np.stack([np.ones(own.sum()), 1 / chars[own]], 1)
            between, within = np.maximum(np.linalg.lstsq(terms, square, rcond=None)[0], 1e-6)
            self.usual[i] = mean, max(between, 1e-4), max(within, 1e-2)
        self.limit = REJECT_MARGIN * max(self.distance(entropy, chars, label).max(), 4.0)

    def distance(self, entropy: np.ndarray, chars: np.ndarray, language: np.ndarray) -> np.ndarray:
        mean, between, within = self.usual[language].T
        return (entropy - mean) / np.sqrt(between + within / chars)

    def decide(self, totals: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, confidence and rejection of texts by their summed word scores."""
        if not self.languages:
            return [UNKNOWN] * len(totals), np.zeros(len(totals)), np.ones(len(totals), bool)
        logs, chars = totals[:, :-1].astype(float), totals[:, -1].astype(float)
        best = logs.argmax(1)
        scaled = logs / self.temperature
        odds = np.exp(scaled - scaled.max(1, keepdims=True))
        score = np.where(chars > 0, (1 / odds.sum(1)), 0.0)
        rejected = chars <= 0
        if self.usual is not None:
            entropy = -logs[np.arange(len(best)), best] / np.maximum(chars, 1)
            rejected |= self.distance(entropy, np.maximum(chars, 1), best) > self.limit
        names = [self.languages[i] if n > 0 else UNKNOWN for i, n in zip(best, chars)]
        return names, score, rejected


class _Scores(dict):
    """Row number by word in a growing matrix of word scores."""

    def __init__(self, models: Models):
        super().__init__()
        self.models = models
        self.matrix = np.zeros((0, len(models.languages) + 1), np.float32)

    def texts(self, texts: list[str | None]) -> np.ndarray:
        """Summed word scores of each text."""
        if len(self) > _REMEMBERED:
            self.clear()
            self.matrix = self.matrix[:0]
        rows = [words_of(text) for text in texts]
        flat = list(chain.from_iterable(rows))
        new = list(set(flat).difference(self))
        scored = self.models.score_words(new)
        lettered = np.fromiter((any(map(str.isalpha, word)) for word in new), bool, len(new))
        scored[~lettered] = 0
        base = len(self.matrix)
        self.update(zip(new, range(base, base + len(new))))
        self.matrix = np.concatenate([self.matrix, scored])
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        result = np.zeros((len(rows), self.matrix.shape[1]))
        places = np.fromiter(map(self.__getitem__, flat), np.int64, len(flat))
        full = np.flatnonzero(lengths)
        if len(full):
            starts = (np.cumsum(lengths) - lengths)[full]
            result[full] = np.add.reduceat(self.matrix[places], starts, axis=0, dtype=np.float64)
        return result


def sample(docs: DataFrame, allowed, label: str, text: str, chars: int = SAMPLE_CHARS) -> DataFrame:
    """Distinct labelled texts of at most ``chars`` characters per label: ``(label, text, __part)``, ``__part`` in 0..63.

    Texts are ranked by a hash in steps of an eighth of a factor of two; per label the steps that fit are taken,
    from the rarest on. If the rarest is too long, its longest text is taken. Only hashes and lengths are moved to
    find the steps.
    """
    uniform = (F.shiftrightunsigned(F.xxhash64("text", F.lit("sample")), 12) + 1) / F.lit(2.0**52)
    usable = (
        docs.where(allowed & quoted(label).isNotNull() & quoted(text).isNotNull())
        .select(quoted(label).cast("string").alias("label"), quoted(text).alias("text"))
        .where(F.length("text") <= chars)
        .select(
            "label", "text", F.floor(-F.log2(uniform) * _STEPS).cast("int").alias("step"),
            F.xxhash64("text").alias("hash"),
            (F.pmod(F.xxhash64("text", F.lit("part")), F.lit(64))).cast("int").alias("__part"),
        )
    )
    texts = usable.groupBy("label", "step", "hash").agg(F.max(F.length("text")).alias("chars"))
    sizes = texts.groupBy("label", "step").agg(
        F.sum("chars").alias("chars"), F.max(F.struct("chars", "hash"))["hash"].alias("longest"))
    order = Window.partitionBy("label").orderBy(F.desc("step"))  # a few hundred steps per label at most
    running = sizes.withColumn("sum", F.sum("chars").over(order)).withColumn("rank", F.row_number().over(order))
    first = running.where((F.col("sum") <= chars) | (F.col("rank") == 1)).groupBy("label").agg(
        F.min("step").alias("from"), F.max(F.when(F.col("sum") > chars, F.col("longest"))).alias("only"))
    taken = usable.join(F.broadcast(first), "label").where(
        (F.col("step") >= F.col("from")) & F.coalesce(F.col("hash") == F.col("only"), F.lit(True)))
    return taken.select("label", "text", "__part").distinct()


def fit(docs: DataFrame, allowed, label: str = "lang", text: str = "text",
        sample_chars: int = SAMPLE_CHARS, order: int = ORDER) -> Models:
    """Models from the rows for which ``allowed`` holds. What reaches the driver is bounded by ``sample_chars``."""
    drawn = sample(docs, allowed, label, text, sample_chars)

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: dict[tuple[str, str], int] = {}
        for name, value in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
            for word in words_of(value):
                found[name, word] = found.get((name, word), 0) + 1
        names, words = zip(*found) if found else ((), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(words, pa.string()), pa.array(found.values(), pa.int64())],
            ["label", "word", "n"],
        )

    counted = map_batches(drawn.where(F.col("__part") >= CALIBRATION_64THS), count, "label string, word string, n long")
    models = Models.train_table(counted.groupBy("label", "word").agg(F.sum("n").alias("n")).toArrow(), order)
    give_back_memory()
    if models.languages:
        kept = drawn.where(F.col("__part") < CALIBRATION_64THS).select("label", "text")
        sent, key = Sent(docs.sparkSession, models), uuid.uuid4().hex

        def totals(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores = worker_state("language", key, lambda: _Scores(sent.open()))
            sums = scores.texts(batch.column("text").to_pylist())
            return pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(list(sums), pa.list_(pa.float64()))], ["label", "totals"]
            )

        held = map_batches(kept, totals, "label string, totals array<double>").toArrow().to_pydict()
        if held["label"]:
            models.calibrate(np.array(held["totals"]), held["label"])
    return models


def identify(docs: DataFrame, models: Models, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``rejected``. No shuffle."""
    sent, key = Sent(docs.sparkSession, models), uuid.uuid4().hex
    kept = without(docs, "lang_pred", "score", "rejected")
    added = [StructField("lang_pred", StringType()), StructField("score", DoubleType()),
             StructField("rejected", BooleanType())]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = worker_state("language", key, lambda: _Scores(sent.open()))
        names, score, rejected = scores.models.decide(scores.texts(batch.column(text).to_pylist()))
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(names, pa.string()), pa.array(score), pa.array(rejected)],
            [*batch.schema.names, "lang_pred", "score", "rejected"],
        )

    return map_batches(kept, run, StructType([*kept.schema.fields, *added]), text)
