"""Quality classifier: a support vector machine on naive-Bayes features.

Features are indicators of hashed n-grams: word unigrams and bigrams, and n-grams of word shapes
(letter case, trailing marks, same word as before).  An indicator is scaled by its log-count
ratio between the classes; scaled rows have length 1.  A linear model with hinge loss is fitted
by dual coordinate descent, and a sigmoid fitted on labelled rows that it hasn't seen turns
margins into scores.

The model is fitted on a bounded sample of labelled rows (``SAMPLE_PER_CLASS`` of each class,
those with the least hash of their id, and ``SAMPLE_FEATURES`` features in all, so that a sample
of very long texts fits the driver too); every document is scored, whole.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.llm.common import id_type, materialize, ship_package, table, text_or_empty

DIM_BITS = 18
DIM = 1 << DIM_BITS
SAMPLE_PER_CLASS = 4000
SAMPLE_FEATURES = 20_000_000  # features of the sample in all (80 MB); rows beyond it, by hash of the id, aren't learned from
HELD_OUT = 2  # remainder of crc32(id as text) by 4 that is never learned from
CALIBRATION = 3  # the remainder on which the sigmoid is fitted
COST = 1.0
EPOCHS = 12
SMOOTHING = 1.0
CUT = 0.7
MEMO_WORDS = 300_000
_MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD)]
_memo: dict[str, int] = {}


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, by 4."""
    return F.crc32(id_col.cast("string").cast("binary")) % 4


def _shape(word: str) -> int:
    """Letter case (8) times trailing marks (8)."""
    core = word.rstrip("".join(set(re.sub(r"\w", "", word)))) if not word[-1].isalnum() else word
    tail = word[len(core):]
    letters = core.strip("\"'([{")
    case = (0 if not letters else 1 if letters.isdigit() else 2 if letters.islower() else 3 if len(letters) > 1 and letters.isupper()
            else 4 if letters[:1].isupper() else 5 if letters.isalpha() else 6)
    mark = 0 if not tail else 1 if tail in (".", ",", ";", ":", "?", "!") else 2 if len(set(tail)) == 1 and len(tail) > 1 else 3 if len(tail) == 1 else 4
    return case * 8 + mark


def _words(text: str) -> np.ndarray:
    """Each word as hash << 6 | shape."""
    words = text.split()
    new = set(words).difference(_memo)
    if new:
        if len(_memo) > MEMO_WORDS:
            _memo.clear()
            new = set(words)
        _memo.update((w, zlib.crc32(w.lower().encode()) << 6 | _shape(w)) for w in new)
    return np.fromiter(map(_memo.__getitem__, words), np.uint64, len(words))


def _grams(x: np.ndarray, n: int, kind: int) -> np.ndarray:
    """Hashes of the n-grams of ``x``."""
    if len(x) < n:
        return x[:0]
    size = len(x) - n + 1
    h = np.full(size, kind * 0x27D4EB2F165667C5, np.uint64)
    for i in range(n):
        h = (h ^ x[i:i + size]) * _MULTIPLIERS[i % 4]
        h ^= h >> np.uint64(29)
    return h * _MULTIPLIERS[0] >> np.uint64(64 - DIM_BITS)


def features(text: str, scratch: np.ndarray | None = None) -> np.ndarray:
    """Distinct feature numbers of a text."""
    packed = _words(text)
    if not len(packed):
        return np.zeros(0, np.int64)
    hashes, shapes = packed >> np.uint64(6), packed & np.uint64(63)
    same = np.zeros(len(packed), np.uint64)
    same[1:] = hashes[1:] == hashes[:-1]
    shapes = shapes | same << np.uint64(6)
    found = np.concatenate([_grams(hashes, 1, 1), _grams(hashes, 2, 2), *(_grams(shapes, n, n + 2) for n in (1, 2, 3, 4))]).astype(np.int64)
    scratch = np.zeros(DIM, np.int32) if scratch is None else scratch
    order = np.arange(len(found), dtype=np.int32)
    scratch[found] = order  # the last one of equal numbers stays
    return found[scratch[found] == order]


class NaiveBayesSvm:
    """Weights over hashed features and a sigmoid; plain arrays, so that it is sent in a closure."""

    def __init__(self, ratio: np.ndarray, weight: np.ndarray, bias: float, slope: float, shift: float):
        self.gain = (ratio * weight).astype(np.float32)
        self.square = (ratio * ratio).astype(np.float32)
        self.bias, self.slope, self.shift = bias, slope, shift

    def margin(self, found: np.ndarray) -> float:
        norm = float(self.square[found].sum(dtype=np.float64)) ** 0.5
        return (float(self.gain[found].sum(dtype=np.float64)) / norm if norm else 0.0) + self.bias

    def score(self, found: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(found) + self.shift, -30, 30))))


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """log of the smoothed shares of each feature in the two classes; 0 for unseen features."""
    counts = []
    for label in (1, -1):
        own = [r for r, k in zip(rows, y) if k == label]
        counts.append(np.bincount(np.concatenate(own), minlength=DIM).astype(float))
    p, q = (c + SMOOTHING for c in counts)
    return np.where(counts[0] + counts[1] > 0, np.log(p / p.sum()) - np.log(q / q.sum()), 0.0)


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray,
                            cost: float = COST, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear hinge-loss machine; each step solves one dual variable."""
    w, bias, alpha = np.zeros(DIM), 0.0, np.zeros(len(rows))
    norms = [float(v @ v) + 1.0 for v in values]  # the bias is a feature that is always 1
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            r, v, k = rows[i], values[i], y[i]
            gradient = k * (float(w[r] @ v) + bias) - 1.0
            new = min(max(alpha[i] - gradient / norms[i], 0.0), cost)
            step = (new - alpha[i]) * k
            if step:
                w[r] += step * v
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w, bias


def fit_sigmoid(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through (margin, class), by Newton steps."""
    good, bad = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.column_stack([margins, np.ones(len(margins))])
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = x.T @ (x * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (target - p))
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(beta[0]), 0.0), float(beta[1])


def train(rows: list[np.ndarray], y: np.ndarray, held: np.ndarray) -> NaiveBayesSvm | None:
    """The model from features, classes (1, -1) and marks of calibration rows; None if a class is missing."""
    at = np.flatnonzero(~held)
    if not {1, -1} <= set(y[at].tolist()):
        return None
    own, k = [rows[i] for i in at], y[at]
    ratio = log_count_ratio(own, k)
    values = []
    for r in own:
        v = ratio[r]
        norm = np.sqrt(v @ v)
        values.append(v / norm if norm else v)
    weight, bias = dual_coordinate_descent(own, values, k)
    model = NaiveBayesSvm(ratio, weight, bias, 1.0, 0.0)
    test = np.flatnonzero(held) if {1, -1} <= set(y[held].tolist()) else at
    model.slope, model.shift = fit_sigmoid(np.array([model.margin(rows[i]) for i in test]), y[test])
    return model


def _featurize(parts):
    import pyarrow as pa

    scratch = np.zeros(DIM, np.int32)
    for part in parts:
        found = [features(t, scratch).astype(np.int32) for t in part.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(pa.int32())), part.column(2)], ["_id", "found", "quality"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        per_class: int = SAMPLE_PER_CLASS) -> NaiveBayesSvm | None:
    """Fit on at most ``per_class`` labelled rows of each class outside the held-out fold."""
    known = (labels.select(F.col(id_col).alias("_id"), F.col("quality").cast("int").alias("quality"))
             .where("_id IS NOT NULL AND quality IN (0, 1)").groupBy("_id").agg(F.min("quality").alias("quality"))
             .where(fold(F.col("_id")) != HELD_OUT))
    order = [F.xxhash64("_id"), F.col("_id")]
    sample = known.where("quality = 1").orderBy(*order).limit(per_class).unionByName(known.where("quality = 0").orderBy(*order).limit(per_class))
    texts = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text")).join(F.broadcast(sample), "_id")
    found = texts.dropDuplicates(["_id"]).mapInArrow(_featurize, f"_id {id_type(docs, id_col)}, found array<int>, quality int")
    found = materialize(found.withColumn("_order", F.xxhash64("_id")), "features")
    sizes = found.select("_order", "_id", F.size("found").alias("n")).orderBy("_order", "_id").collect()  # 2 * per_class rows at most
    total = np.cumsum([r.n for r in sizes])
    last = int(np.searchsorted(total, SAMPLE_FEATURES, "right"))
    if last < len(sizes):
        order, first = sizes[last]["_order"], sizes[last]["_id"]
        found = found.where((F.col("_order") < order) | ((F.col("_order") == order) & (F.col("_id") < first)))
    got = found.select("found", "quality", (fold(F.col("_id")) == CALIBRATION).alias("held"), "_id").orderBy("_id").toArrow()
    lists = got["found"].combine_chunks()
    flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
    rows = [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
    return train(rows, np.where(got["quality"].to_numpy() == 1, 1, -1), got["held"].to_numpy(zero_copy_only=False))


def score_column(model: NaiveBayesSvm | None, text: Column) -> Column:
    """Score of a text column, in Arrow batches; 0.5 without a model."""
    if model is None:
        return F.lit(0.5)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        scratch = np.zeros(DIM, np.int32)
        return pd.Series([model.score(features(t, scratch)) for t in texts], dtype=float)

    return score(text)


def classify_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     cut: float = CUT, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """One row per input row: id, held_out, score, predicted.

    Null and empty texts have no features and get the score of the bias; null ids are scored and
    never held out; repeated rows each get a row; labels other than 0 and 1 are no labels, an id
    labelled both ways counts as 0; other columns are ignored; an empty table gives an empty
    result.  If a class has no labelled row, every score is 0.5.
    """
    ship_package(docs.sparkSession)
    model = fit(docs, labels, id_col, text_col, per_class)
    scored = docs.select(F.col(id_col), score_column(model, text_or_empty(text_col)).alias("score"))
    return scored.select(id_col, F.coalesce(fold(F.col(id_col)) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= cut).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier predicts to be of quality; each row is
    scored where it lies, so nothing is joined or shuffled.  Cases as in ``classify_quality``."""
    ship_package(docs.sparkSession)
    model = fit(docs, labels, id_col, text_col)
    return docs.where(score_column(model, text_or_empty(text_col)) >= cut)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned outside the held-out fold."""
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
