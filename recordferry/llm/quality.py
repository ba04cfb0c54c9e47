"""Quality scores by Bradley-Terry ranking: preference pairs, logistic loss on feature differences, a quantile threshold.

Every labelled good document is preferred to labelled bad ones.  The probability that a beats b is sigmoid(w (x_a - x_b)), so
w is fitted by logistic regression without intercept on feature differences of random (good, bad) pairs.  The rank w x is
then placed on 0..1: the quantile of the training ranks at the share of bad labels becomes CUT, so a document is predicted
good from score CUT on, and the score rises with the rank.

The fit uses at most SAMPLE labelled documents (those with the least hashes of their ids) and PAIRS pairs; features of that
sample alone come to the driver.  Scoring reads every whole text once, in tasks, and shuffles nothing.

Null and empty texts have all-zero features and get the score of that point, like any other text.  Null labels or ids train
nothing; contradicting labels of one id are both used.
Of rows that share an id the least text trains.  Without two classes in the sample every score is 1 or 0 by majority.
Columns of the input named score or predicted are replaced, and the text may be read from one of them; other columns stay.  A
very long text is held whole, with the counts of its different words, by the task that scores it.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordferry.llm.rules import measure

SAMPLE, PAIRS = 6000, 60000
CUT = 0.3
FEATURES = 12
HASHED = 52
LINE = re.compile(r"[.!?]")


def features(text: str | None) -> np.ndarray:
    """Rates that do not depend on language, then signed hashed shares of the first three bytes of words."""
    out = np.zeros(FEATURES + HASHED)
    n_words, chars, symbols, n_lines, dup_lines, repeated, upper, letters = measure(text)
    if not n_words:
        return out
    data = text.encode()
    words = data.split()
    times = Counter(words)
    out[:FEATURES] = (1, np.log1p(n_words) / 10, chars / n_words / 10, min(symbols / n_words, 3), dup_lines / max(n_lines, 1),
                      repeated / n_words, upper / max(letters, 1), len(times) / n_words, max(times.values()) / n_words,
                      min(len(LINE.findall(text)) / n_words, 2), letters / len(data),
                      sum(a == b for a, b in zip(words, words[1:])) / n_words)
    for word, n in times.items():
        head = word[:3]
        h = int.from_bytes(head, "little") * 0x9E3779B1 >> 7
        out[FEATURES + h % HASHED] += n / n_words if h >> 13 & 1 else -n / n_words
    return out


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def featured(texts: pa.Array) -> pa.Array:
    return pa.array([features(t).tolist() for t in texts.to_pylist()], pa.list_(pa.float64()))


def fit(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, ridge: float = 1e-3, seed: int = 1) -> dict:
    """Weights and the line that turns ranks into scores, from features and 0/1 labels.  Newton steps, in float64."""
    good, bad = x[y == 1], x[y == 0]
    if not len(good) or not len(bad):
        return {"weights": np.zeros(x.shape[1]), "at": 0.0, "constant": 1.0 if len(good) or not len(y) else 0.0}
    rng = np.random.default_rng(seed)
    d = good[rng.integers(len(good), size=pairs)] - bad[rng.integers(len(bad), size=pairs)]
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        gradient = d.T @ (1 - p) / pairs - ridge * w
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d / pairs + ridge * np.eye(len(w)), gradient)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    ranks = x @ w
    # The cut is the middle between the ranks on both sides of the quantile.
    share = (y == 0).mean()
    at = sum(float(np.quantile(ranks, share, method=m)) for m in ("lower", "higher")) / 2
    return {"weights": w, "at": at, "constant": None}


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, pairs: int = PAIRS) -> dict:
    """Fit on `docs` (doc_id, text) and `labels` (doc_id, label 0/1); the caller leaves out what is to be held out."""
    chosen = (labels.filter("doc_id is not null and label is not null")
              .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample).select("doc_id", "label"))
    # At most `sample` rows: the broadcast is bounded, and so are the features, one row for an id and label.
    rows = (docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
            .select(featured("text").alias("x"), "label"))
    table = rows.toArrow()
    x = np.array(table["x"].to_pylist(), float).reshape(-1, FEATURES + HASHED)
    y = table["label"].to_numpy()
    order = np.lexsort([*x.T, y])
    return fit(x[order], y[order], pairs)


def score(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """`docs` with `score` in 0..1 (CUT at the threshold rank) and `predicted`."""
    weights, at, constant = model["weights"], model["at"], model["constant"]
    shift = np.log(CUT / (1 - CUT))

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        if constant is not None:
            return pa.array([constant] * len(texts), pa.float64())
        ranks = np.array([features(t) @ weights for t in texts.to_pylist()], float)
        return pa.array(1 / (1 + np.exp(-np.clip(ranks - at + shift, -700, 700))))

    return docs.withColumn("score", scored(docs[text])).withColumn("predicted", (F.col("score") >= CUT).cast("int"))
