"""Language ID: sparse multinomial logistic regression on hashed TF-IDF character n-grams.

Document frequencies are counted over every learnable document.  The weights are trained with
follow-the-regularised-leader and elastic-net penalties on a bounded sample of labelled rows (the
number per language is a parameter), and a temperature is fitted on a fold of that sample that
training did not see.  Prediction reads whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import held_out, sum_arrays
from aerolith.llm.hashing import mix

BITS, ORDERS = 16, 3
#: TF-IDF vectors have the sum 1; the learner sees them times this.
SCALE = 64.0
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letter_codes() -> np.ndarray:
    """Code point of each letter, and a blank for everything else."""
    codes = np.full(0x110000, 32, np.uint32)
    letters = [c for c in range(0x110000) if chr(c).isalpha()]
    codes[letters] = letters
    return codes


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-gram ids of all orders (orders x code points), where each text begins, and its number of letters.

    Texts are lower-cased and set between blanks; runs of other characters count as one blank.
    An n-gram that would leave its text, or begins or ends in a blank next to another, has the id 0.
    """
    lowered = [" " + t.lower() + " " for t in texts]
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in lowered], out=begins[1:])
    codes = letter_codes()[np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), "<u4")]
    blank = codes == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    heads = begins[:-1]
    keep[heads] = True
    kept = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(keep, out=kept[1:])
    alpha = np.add.reduceat((~blank).astype(np.int64), heads) if len(texts) else np.zeros(0, np.int64)
    codes, begins = codes[keep].astype(np.uint64), kept[begins]
    n = len(codes)
    ids = np.zeros((ORDERS, n), np.int64)
    owner = np.repeat(np.arange(len(texts)), np.diff(begins))
    h = np.zeros(n, np.uint64)
    for order in range(1, ORDERS + 1):
        m = n - order + 1
        if m <= 0:
            break
        h[:m] = h[:m] * np.uint64(0x9E3779B97F4A7C15) + codes[order - 1 :] + np.uint64(order)
        inside = owner[:m] == owner[order - 1 :]
        ids[order - 1, :m] = np.where(inside, (mix(h[:m]) >> np.uint64(64 - BITS)).astype(np.int64) | 1 << BITS, 0)
    ids[0, codes == 32] = 0
    return ids & ((1 << BITS) - 1), begins, alpha


def chunks(texts: list[str], limit: int = 1 << 18, most: int = 256) -> Iterator[list[str]]:
    """Runs of at most so many texts of about `limit` characters; a longer text is a run of its own."""
    run, size = [], 0
    for t in texts:
        if run and (size + len(t) > limit or len(run) == most):
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # 2**BITS x languages, of TF-IDF vectors times SCALE
    bias: np.ndarray
    temperature: float

    @cached_property
    def table(self) -> np.ndarray:
        """By n-gram: what it adds to each logit, and its weight; made once in each Python worker."""
        return np.concatenate([self.weights * self.idf[:, None] * SCALE, self.idf[:, None]], 1).astype(np.float32)

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Logits by language, and the number of letters of each text."""
        table, rows, letters = self.table, [], []
        for run in chunks(texts):
            ids, begins, alpha = grams(run)
            total = np.zeros((len(run), table.shape[1]))
            for order in ids:
                total += np.add.reduceat(table[order], begins[:-1], axis=0, dtype=np.float64)
            rows.append(total[:, :-1] / np.maximum(total[:, -1:], 1e-12) + self.bias)
            letters.append(alpha)
        return (np.concatenate(rows), np.concatenate(letters)) if rows else (np.zeros((0, len(self.languages))), np.zeros(0))

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and probability; texts without letters get `und` and 0."""
        z, letters = self.logits(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        p = softmax(z / self.temperature)
        best = p.argmax(1)
        return [self.languages[b] if n else UNKNOWN for b, n in zip(best, letters, strict=True)], np.where(letters > 0, p.max(1), 0.0) if len(best) else np.zeros(0)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts of the column `text` each hashed n-gram occurs, and the number of texts."""

    def partial(batches: Iterator[pd.DataFrame]) -> dict[str, np.ndarray]:
        df, n = np.zeros(1 << BITS, np.int64), np.zeros(1, np.int64)
        for pdf in batches:
            for run in chunks(list(pdf["text"])):
                ids, begins, _ = grams(run)
                seen = np.zeros((len(run), 1 << BITS), bool)
                owner = np.repeat(np.arange(len(run)), np.diff(begins))
                for order in ids:
                    seen[owner, order] = True
                df += seen.sum(0)
                n += len(run)
        return {"df": df, "n": n}

    sums = sum_arrays(docs.select("text"), partial)
    return sums.get("df", np.zeros(1 << BITS, np.int64)), int(sums["n"][0]) if "n" in sums else 0


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int, alpha: float, beta: float, l1: float, l2: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Follow-the-regularised-leader (proximal) for multinomial logistic loss; the last feature is the bias."""
    size = 1 << BITS
    z, n = np.zeros((size + 1, classes)), np.zeros((size + 1, classes))
    order = np.arange(len(rows))
    rng = np.random.default_rng(seed)

    def solve(at: np.ndarray) -> np.ndarray:
        pull = np.where(at == size, 0.0, 1.0)[:, None]
        small = np.abs(z[at]) <= l1 * pull
        return np.where(small, 0.0, -(z[at] - np.sign(z[at]) * l1 * pull) / ((beta + np.sqrt(n[at])) / alpha + l2 * pull))

    for _ in range(epochs):
        rng.shuffle(order)
        for i in order:
            at, x, label = rows[i]
            w = solve(at)
            p = softmax((x @ w)[None, :])[0]
            p[label] -= 1
            g = x[:, None] * p[None, :]
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    w = solve(np.arange(size + 1))
    return w[:-1], w[-1]


def fit_temperature(z: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search over its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        return float(-np.log(np.maximum(softmax(z / np.exp(t))[np.arange(len(labels)), labels], 1e-12)).mean())

    a, b, ratio = -4.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def fit_language_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 600, epochs: int = 4, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01, seed: int = 7) -> LanguageModel:
    """Learn from all rows of `docs` that have a text and a language; the caller leaves out what must not be learned from.

    About `per_language` rows of each language, chosen by a hash of id and text, train the weights (four fifths) and
    the temperature (the rest).  Document frequencies cover all rows.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(text.alias("text"), F.col(lang_col).cast("string").alias("lang"), F.pmod(F.xxhash64(F.lit(seed), F.col(id_col), text), F.lit(1 << 30)).alias("pick")).where("text is not null and lang is not null")
    df, n = document_frequencies(rows)
    idf = np.log((1 + n) / (1 + df)) + 1
    idf[0] = 0
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return LanguageModel([], idf, np.zeros((1 << BITS, 0)), np.zeros(0), 1.0)
    below = F.coalesce(*(F.when(F.col("lang") == k, F.lit(int(min(1.0, per_language / v) * (1 << 30)))) for k, v in counts.items()))

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for t, lang, pick in zip(pdf["text"], pdf["lang"], pdf["pick"], strict=True):
                ids, _, letters = grams([t])
                at, tf = np.unique(ids, return_counts=True)
                x = tf * idf[at]
                if letters[0]:
                    out.append((lang, pick, at[x > 0].tolist(), (x[x > 0] * (SCALE / x.sum())).tolist()))
            yield pd.DataFrame(out, columns=["lang", "pick", "at", "x"])

    sample = rows.where(F.col("pick") < below).mapInPandas(vectors, "lang string, pick long, at array<int>, x array<float>").collect()
    sample = sorted(sample, key=lambda r: (r["pick"], r["lang"], len(r["at"])))
    code = {k: i for i, k in enumerate(languages)}
    made = [(np.array([*r["at"], 1 << BITS]), np.array([*r["x"], 1.0]), code[r["lang"]]) for r in sample]
    held = [r for i, r in enumerate(made) if i % 5 == 4] or made
    weights, bias = ftrl([r for i, r in enumerate(made) if i % 5 != 4], len(languages), epochs, alpha, beta, l1, l2, seed)
    z = np.array([x[:-1] @ weights[at[:-1]] + bias for at, x, _ in held]).reshape(-1, len(languages))
    return LanguageModel(languages, idf, weights, bias, fit_temperature(z, np.array([r[2] for r in held], np.int64)))


def identify_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """Columns doc_id, held_out, lang_pred, score: one row per row of `docs`.

    Only rows that are not held out (crc32 of the id as text leaves a remainder by 5), with text and language, are
    learned from; language, source and id are no inputs of a prediction.  lang_pred is a learned language, or `und`
    with score 0 for a null text or one without letters, and where nothing could be learned.  Of languages that tie the first by
    name is taken.  Repeated rows are learned from and predicted each; a null id counts as the text ''; very long texts are read whole.  An
    empty table gives no rows; other columns are ignored.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang"))
    model = fit_language_model(slim.where(~held_out(F.col("doc_id"))), "doc_id", "text", "lang", **options)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed by BITS and the languages

    @F.pandas_udf("lang_pred string, score double")
    def predict(text: pd.Series) -> pd.DataFrame:
        lang, score = shared.value.predict(["" if t is None else t for t in text])
        return pd.DataFrame({"lang_pred": lang, "score": score})

    scored = slim.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), predict("text").alias("p"))
    return scored.select("doc_id", "held_out", "p.lang_pred", "p.score")
