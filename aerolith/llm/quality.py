"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Class means and covariances come from sums over all labelled rows.  Covariances shrink towards the pooled
one and its diagonal; scores are Mahalanobis log-density differences from cached Cholesky factors, put on
a probability scale that is fitted on a histogram of all training scores.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import checkpointed, held_out

FEATURES = ["chars", "words", "word_length", "word_spread", "upper", "digits", "blanks", "stops", "symbols", "closing_symbols", "distinct_words", "top_word", "echoes", "distinct_pairs", "short_words", "line_length", "distinct_lines", "squeeze"]
#: Histogram of log-density differences for the calibration: bins of this width, this many on either side; the outermost take what lies beyond.
BIN, BINS = 0.25, 400


#: Flags of a character.
ALNUM, STOP, DIGIT, SPACE, PLAIN_END = 1, 2, 4, 8, 16


@lru_cache(maxsize=1)
def character_flags() -> np.ndarray:
    """Flags by code point: letters and digits, stops, 0-9, white space, what may end a word without being a symbol."""
    flags = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        x = chr(c)
        if x.isalnum():
            flags[c] = ALNUM | PLAIN_END
        elif x.isspace():
            flags[c] = SPACE
    for x in ".,;:'\"()-?":
        flags[ord(x)] |= STOP
    for x in ".,;:?'\")-":
        flags[ord(x)] |= PLAIN_END
    for x in "0123456789":
        flags[ord(x)] |= DIGIT
    return flags


def statistics(text: str) -> list[float]:
    """Transformed statistics of a whole text: logarithms of sizes, log odds of shares."""
    import zlib

    def odds(part: float, whole: float) -> float:
        return math.log((part + 0.5) / (max(whole - part, 0) + 0.5))

    n = len(text)
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    lower = text.lower()
    upper = int((points != np.frombuffer(lower.encode("utf-32-le", "replace"), "<u4")).sum()) if len(lower) == n else 0
    flags = character_flags()[points]
    kinds = np.bincount(flags, minlength=32)
    of = lambda flag: int(kinds[(np.arange(32) & flag) > 0].sum())
    stops, spaces = of(STOP), of(SPACE)
    space = (flags & SPACE) > 0
    ends = ~space
    ends[:-1] &= space[1:]
    closing = int(((flags[ends] & PLAIN_END) == 0).sum())
    words = text.split()
    lines = text.split("\n")
    w = len(words)
    lengths = np.fromiter(map(len, words), np.int64, w) if w else np.zeros(1, np.int64)
    mean = float(lengths.mean())
    counts = Counter(words)
    raw = text.encode("utf-8", "replace")
    return [
        math.log1p(n),
        math.log1p(w),
        math.log1p(mean),
        math.log1p(float(lengths.std())),
        odds(upper, n),
        odds(of(DIGIT), n),
        odds(spaces, n),
        odds(stops, n),
        odds(n - stops - of(ALNUM) - spaces, n),
        odds(closing, w),
        math.log1p(len(counts)) - 0.8 * math.log1p(w),
        odds(max(counts.values(), default=0), w),
        odds(sum(map(str.__eq__, words, words[1:])), w),
        odds(len(set(zip(words, words[1:]))), max(w - 1, 0)),
        odds(int((lengths <= 3).sum()) if w else 0, w),
        math.log1p(n / len(lines)),
        odds(len(set(lines)), len(lines)),
        math.log((len(zlib.compress(raw, 1)) + 16) / (len(raw) + 16)),
    ]


def features(text: Column) -> Column:
    """array<double> of :func:`statistics`; a null text counts as empty."""

    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics("" if t is None else t) for t in texts])

    return run(text)


@dataclass
class QualityModel:
    prior: float  # log odds of class 1
    means: np.ndarray | None  # 2 x features
    factors: np.ndarray | None  # inverse Cholesky factors
    log_dets: np.ndarray | None
    slope: float = 1.0
    shift: float = 0.0

    def differences(self, x: np.ndarray) -> np.ndarray:
        """log p(x | 1) - log p(x | 0) + prior."""
        if self.means is None:
            return np.full(len(x), self.prior)
        y = [(x - self.means[c]) @ self.factors[c].T for c in (0, 1)]
        d = [-0.5 * (v * v).sum(1) - 0.5 * self.log_dets[c] for c, v in enumerate(y)]
        return d[1] - d[0] + self.prior

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = self.slope * self.differences(x) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))  # what a double can hold


def _platt(bins: np.ndarray, n0: np.ndarray, n1: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through a histogram, by Newton steps with a slight penalty."""
    a, b = 0.1, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * bins + b, -40, 40)))
        n, w = n0 + n1, (n0 + n1) * p * (1 - p)
        g = np.array([(bins * (n * p - n1)).sum() + 1e-3 * a, (n * p - n1).sum()])
        h = np.array([[(w * bins * bins).sum() + 1e-3, (w * bins).sum()], [(w * bins).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 1.0 / max(1e-12, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return max(float(a), 1e-3), float(b)


def fit_quality(labelled: DataFrame, pooling: float = 0.1, diagonal: float = 0.02) -> QualityModel:
    """Fit on columns f (features) and y (0 or 1), over all rows.

    `pooling` is the weight of the pooled covariance, `diagonal` that of the diagonal.  With fewer than two rows of
    a class, every score is the smoothed share of class 1.
    """
    k = len(FEATURES)

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, 1 + k + k * k))
        for pdf in batches:
            x, y = np.array(pdf["f"].tolist()).reshape(-1, k), pdf["y"].to_numpy()
            for c in (0, 1):
                v = x[y == c]
                total[c] += np.concatenate([[len(v)], v.sum(0), (v.T @ v).ravel()])
        yield pd.DataFrame({"c": np.repeat([0, 1], total.shape[1]), "at": np.tile(np.arange(total.shape[1]), 2), "v": total.ravel()})

    sums = np.zeros((2, 1 + k + k * k))
    for r in labelled.mapInPandas(moments, "c int, at int, v double").groupBy("c", "at").agg(F.sum("v").alias("v")).collect():
        sums[r["c"], r["at"]] = r["v"]
    n = sums[:, 0]
    prior = math.log((n[1] + 1) / (n[0] + 1))
    if n.min() < 2:
        return QualityModel(prior, None, None, None)
    means = sums[:, 1 : 1 + k] / n[:, None]
    covariances = np.stack([(sums[c, 1 + k :].reshape(k, k) - n[c] * np.outer(means[c], means[c])) / (n[c] - 1) for c in (0, 1)])
    pooled = ((n - 1)[:, None, None] * covariances).sum(0) / (n.sum() - 2)
    factors, log_dets = [], []
    for c in (0, 1):
        s = (1 - pooling) * covariances[c] + pooling * pooled
        s = (1 - diagonal) * s + diagonal * np.diag(np.diag(pooled)) + 1e-4 * np.eye(k)
        low = np.linalg.cholesky(s)
        factors.append(np.linalg.inv(low))
        log_dets.append(2 * np.log(np.diag(low)).sum())
    model = QualityModel(prior, means, np.stack(factors), np.array(log_dets))

    @F.pandas_udf("int")
    def place(f: pd.Series) -> pd.Series:
        d = model.differences(np.array(f.tolist()).reshape(-1, k))
        return pd.Series(np.clip(np.round(d / BIN), -BINS, BINS).astype("int32"))

    bins = np.arange(-BINS, BINS + 1) * BIN
    counts = np.zeros((2, len(bins)))
    for r in labelled.groupBy(place("f").alias("bin"), "y").agg(F.count("*").alias("n")).collect():
        counts[r["y"], r["bin"] + BINS] = r["n"]
    model.slope, model.shift = _platt(bins, counts[0], counts[1])
    return model


def train(described: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", **options) -> QualityModel:
    """Fit on rows of `described` (doc_id, f) that are not held out and have a label of 0 or 1 in `labels`.

    A label that is repeated counts once; an id with both labels counts for both.
    """
    marks = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1)").distinct()
    rows = described.where(~held_out(F.col("doc_id"))).join(marks, "doc_id").select("f", "y")
    return fit_quality(rows, **options)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Columns doc_id, held_out, score, predicted: one row per row of `docs`.

    Labels are learned from rows alone whose crc32 of the id as text leaves a remainder by 5; only the text is an
    input of a score.  A null text scores as an empty one.  Repeated rows are learned from and scored each; a null id has no label; an id
    with both labels counts for both.  Very long texts are read whole.  Without labels of both kinds all scores are equal.  An empty table
    gives no rows; other columns are ignored.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), features(F.col(text_col).cast("string")).alias("f"))
    described = checkpointed(slim)  # the statistics alone, for training and scoring
    score = score_features(train(described, labels, **options))(F.col("f"))
    out = described.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def score_features(model: QualityModel):
    """Column function from features to scores."""

    @F.pandas_udf("double")
    def run(f: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.array(f.tolist()).reshape(-1, len(FEATURES))))

    return run


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs`, all columns, that score at least `threshold`; texts are scored where they are, without a shuffle.

    The rules are those of :func:`score_quality`: null and empty texts are scored too, equal texts stay or go together, repeated rows
    stay each, texts are read whole at any length, an empty table stays empty, and columns may have any names.
    """
    described = checkpointed(docs.where(~held_out(F.col(id_col))).select(F.col(id_col).cast("long").alias("doc_id"), features(F.col(text_col).cast("string")).alias("f")))
    model = train(described, labels, **options)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        x = [statistics("" if t is None else t) for t in texts]
        return pd.Series(model.scores(np.array(x).reshape(-1, len(FEATURES))))

    return docs.where(score(F.col(text_col).cast("string")) >= threshold)
