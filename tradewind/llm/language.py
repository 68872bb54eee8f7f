"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed n-grams of one to three lower-cased characters. Document frequencies are counted over all
training documents. The weights are learned on a bounded sample of them, with follow-the-regularised-
leader and an elastic-net penalty (the absolute part keeps most weights at exactly zero). A part of the
sample is held back to fit the temperatures that make scores honest probabilities: of the whole texts, and of
short pieces of them, as a few letters are less evidence than a page. Each size of text has its own
temperature. So that no number of right answers makes a score certain, one more answer per language is counted
as wrong. Only text and language of training documents are used, and a prediction sees nothing but the text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.columns import unit_draw

FEATURES = 1 << 15
#: Documents per language that the weights are fitted on, and languages at most; more are an error.
SAMPLE = 1000
MAX_LANGUAGES = 500
UNKNOWN = "und"
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The hashed n-grams of a text and their counts."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    counts = np.zeros(FEATURES, dtype=np.int64)
    gram = np.zeros(len(codes), dtype=np.uint32)
    for n in range(3):
        gram = gram[: len(codes) - n] * np.uint32(31) + codes[n:] * _FACTORS[n]
        spread = (gram ^ (gram >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * n)
        counts += np.bincount(spread >> np.uint32(32 - 15), minlength=FEATURES)
    at = np.flatnonzero(counts)
    return at, counts[at]


def weighted(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features with their sublinear TF-IDF weights, of length one."""
    at, counts = features(text)
    values = (1.0 + np.log(counts)) * idf[at]
    norm = math.sqrt(float(values @ values))
    return at, values / norm if norm else values


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each feature is, and the number of texts, over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(FEATURES, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                total[features(text.as_py() or "")[0]] += 1
                rows += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([*at.tolist(), -1]), pa.array([*total[at].tolist(), rows])], names=["feature", "docs"])

    # At most one row per feature.
    sums = texts.mapInArrow(count, "feature bigint, docs bigint").groupBy("feature").agg(F.sum("docs").alias("docs")).collect()
    out, rows = np.zeros(FEATURES), 0
    for feature, docs in sums:
        if feature < 0:
            rows = docs
        else:
            out[feature] = docs
    return out, rows


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list, labels: np.ndarray, classes: int, passes: int = 3, alpha: float = 0.5, beta: float = 1.0,
          l1: float = 0.02, l2: float = 0.001) -> np.ndarray:
    """FTRL-proximal weights; ``rows`` are (features, values) pairs."""
    z, n = np.zeros((FEATURES, classes)), np.zeros((FEATURES, classes))

    def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        shrunk = np.sign(zi) * np.maximum(np.abs(zi) - l1, 0.0)
        return -shrunk / ((beta + np.sqrt(ni)) / alpha + l2)

    draw = np.random.default_rng(17)
    for _ in range(passes):
        for i in draw.permutation(len(rows)):
            at, x = rows[i]
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            p = _softmax(x @ w)
            p[labels[i]] -= 1.0
            g = x[:, None] * p[None, :]
            step = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[at] = zi + g - step * w
            n[at] = ni + g * g
    return weights(z, n)


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores with the least log loss, by golden-section search on its logarithm.

    Besides the given answers each class counts once more, with all classes as likely, so that scores that
    are always right keep a loss that forbids certainty.
    """
    if not len(labels):
        return 1.0
    n, classes = len(labels), scores.shape[1]
    wrong = classes / (n + classes)

    def loss(log_t: float) -> float:
        log_p = np.log(np.maximum(_softmax(scores / math.exp(log_t)), 1e-300))
        return float(-((1 - wrong) * log_p[np.arange(n), labels] + wrong * log_p.mean(axis=1)).mean())

    low, high, ratio = math.log(0.02), math.log(20.0), (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        if loss(a) < loss(b):
            high = b
        else:
            low = a
    return math.exp((low + high) / 2)


#: Pieces of so many words of each held-back text are calibrated on, besides the whole text.
PIECES = (1, 2, 4, 8, 16, 32)
#: Sizes of text with a temperature of their own: powers of two of characters.
SIZES = 16
LEAST_OF_A_SIZE = 30


def pieces_of(text: str, number: int) -> list[str]:
    """The text, and parts of it that begin at places that depend on ``number``."""
    words, out = text.split(), [text]
    for n in PIECES:
        if n < len(words):
            start = (number * 2654435761 + n) % (len(words) - n + 1)
            out.append(" ".join(words[start : start + n]))
    return [piece for piece in out if has_letter(piece)]


def size_of(text: str) -> int:
    return min(len(text).bit_length(), SIZES - 1)


def temperatures(sizes: np.ndarray, scores: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """A temperature for each size of text; sizes with few examples take part in their neighbours'."""
    heats = []
    for size in range(SIZES):
        reach, some = 0, sizes == size
        while some.sum() < LEAST_OF_A_SIZE and reach < SIZES:
            reach += 1
            some = np.abs(sizes - size) <= reach
        heats.append(temperature(scores[some], labels[some]))
    return np.array(heats)


class Model:
    """Languages, IDF, weights and the temperatures by size of text."""

    def __init__(self, languages: list[str], idf: np.ndarray, weights: np.ndarray, heats: np.ndarray):
        self.languages, self.idf, self.weights, self.heats = languages, idf, weights.astype(np.float32), heats

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        at, x = weighted(text, self.idf)
        p = _softmax((x @ self.weights[at]) / self.heats[size_of(text)])
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def fit(training: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from all rows of ``training`` (doc_id, text, lang); rows without text or language are left out.

    The weights see at most ``sample`` documents per language, those with the smallest draws of their id.
    """
    known = training.where("text is not null and lang is not null")
    frequencies, rows = document_frequencies(known.select("text"))
    idf = np.log((1.0 + rows) / (1.0 + frequencies)) + 1.0
    sizes = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages; none is left out silently")
    languages = sorted(row[0] for row in sizes)
    if not languages:
        return Model([], idf, np.zeros((FEATURES, 0)), np.ones(SIZES))
    number = {lang: i for i, lang in enumerate(languages)}
    spark = training.sparkSession
    shares = spark.createDataFrame([(row[0], min(1.0, 2.0 * sample / row[1])) for row in sizes], "lang string, share double")
    chosen = (
        known.select("doc_id", "text", "lang").withColumn("draw", unit_draw(F.lit("language"), F.col("doc_id")))
        .join(F.broadcast(shares), "lang").where("draw <= share")
        .withColumn("turn", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "text"))).where(F.col("turn") <= sample)
        .select("text", "lang", "turn")
    )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = sorted((turn, lang, text) for b in batches for text, lang, turn in zip(*[c.to_pylist() for c in b.columns]))
        rows = [(weighted(text, idf), number[lang]) for turn, lang, text in given if turn % 5]
        weights = train([v for v, _ in rows], np.array([label for _, label in rows], dtype=np.int64), len(languages))
        held = [(piece, number[lang]) for turn, lang, text in given if turn % 5 == 0 for piece in pieces_of(text, turn)]
        vectors = [weighted(piece, idf) for piece, _ in held]
        scores = np.array([x @ weights[at] for at, x in vectors]).reshape(-1, len(languages))
        heats = temperatures(np.array([size_of(piece) for piece, _ in held]), scores, np.array([label for _, label in held], dtype=np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array([weights.astype("<f8").tobytes()], pa.binary()), pa.array([heats.astype("<f8").tobytes()], pa.binary())], names=["weights", "heats"])

    # A bounded sample, learned from in one task.
    blob, heats = chosen.repartition(1).mapInArrow(learn, "weights binary, heats binary").first()
    return Model(languages, idf, np.frombuffer(blob, dtype="<f8").reshape(FEATURES, len(languages)), np.frombuffer(heats, dtype="<f8"))


def held_out(doc_id: Column) -> Column:
    """Whether the CRC-32 of the id's digits leaves 1 when divided by 3; so do null ids, from which nothing is learned."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, lang_pred, score; ``und`` and 0 for null texts and texts without a letter."""
    # At most FEATURES x MAX_LANGUAGES numbers.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predicted(text: pa.Array) -> pa.Array:
        told = [shared.value.predict(t.as_py()) for t in text]
        return pa.StructArray.from_arrays([pa.array([t[0] for t in told], pa.string()), pa.array([t[1] for t in told], pa.float64())], names=["lang_pred", "score"])

    return docs.select("doc_id", predicted("text").alias("p")).select("doc_id", "p.*")


def predict_all(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, learned from those that are not held out.

    Repeated rows are learned from and predicted as often as they occur. Without anything to learn from
    all are ``und``. Only doc_id, text and lang are read. No rows give no rows.
    """
    rows = docs.select("doc_id", "text", "lang")
    model = fit(rows.where(~held_out(F.col("doc_id"))), sample)
    told = identify(rows, model)
    return told.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
