"""Quality scores by positive-unlabelled learning with the non-negative risk.

Trusted positives and unlabelled web text train a scorer; negatives are never
named. With the class prior pi, the risk is pi * E_p[l(g)] + max(0, E_u[l(-g)] -
pi * E_p[l(-g)]): the unlabelled texts count as negative, less the part that the
positives among them must make up, and that part cannot go below zero. The prior
is estimated from the scores of texts that were held back: the smallest ratio of
unlabelled to positive texts above any score, with a margin for chance.

Features are shares over the whole text: bytes, word shapes, repetition. Only
the training sample is bounded; every text is read whole and scored.

Defined cases: a null text is empty; texts without words have the features of
nothing and get the score of such texts; without positives the score is 0.5;
repeated rows are scored alike; only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POSITIVES = 6_000  # bound of the trusted rows that are fitted, taken in hash order
UNLABELLED = 12_000  # bound of the unlabelled rows that are fitted, taken in hash order
SEED = 7
HIDDEN, STEPS, RATE, DECAY, FOLDS = 16, 400, 0.02, 3e-3, 3

_ENDS = re.compile(rb"[!?.,;:]+$")
_RANGES = {  # fixed values: byte ranges whose shares are features
    "upper": (65, 90), "lower": (97, 122), "digit": (48, 57), "high": (128, 255), "control": (0, 31),
}
_SINGLE = b" \n!\"#$%&'()*+,-./:;<=>?@[]_|{}~"


def features(text: bytes) -> np.ndarray:
    """Shares of one whole text; independent of its length but for one term."""
    n = max(1, len(text))
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256) / n
    out = [count[a : b + 1].sum() for a, b in _RANGES.values()] + [count[c] for c in _SINGLE]
    words = text.split()
    m = max(1, len(words))
    lines = [x for x in text.split(b"\n") if x.strip()]
    size = np.fromiter(map(len, words), np.int64, len(words))
    same = sum(map(bytes.__eq__, words[1:], words))
    out += [
        len(set(words)) / m, same / m, len(set(lines)) / max(1, len(lines)), size.mean() / 10 if len(words) else 0.0,
        size.std() / 10 if len(words) else 0.0, (size == 1).mean() if len(words) else 0.0,
        len(lines) / m, np.log1p(m) / 10,
        len({b" ".join(words[i : i + 3]) for i in range(0, len(words) - 2, 3)}) / max(1, len(words[:-2]) / 3),
    ]
    return np.sqrt(np.minimum(np.array(out, "f8"), 4.0))


@dataclass(frozen=True)
class Scorer:
    """One hidden layer on standardised features; ``prior`` is the share of positives it was fitted with."""

    mean: np.ndarray
    scale: np.ndarray
    weights: tuple[np.ndarray, ...]
    prior: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(_forward(self.weights, (x - self.mean) / self.scale)[1])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def _forward(w: tuple[np.ndarray, ...], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.tanh(x @ w[0] + w[1])
    return hidden, hidden @ w[2] + w[3]


def _fit(p: np.ndarray, u: np.ndarray, prior: float | None) -> tuple[np.ndarray, ...]:
    """Adam on the non-negative risk; without a prior, plain positive against unlabelled."""
    rng = np.random.default_rng(SEED)
    d = p.shape[1]
    w = [rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    x, np_, nu = np.concatenate([p, u]), len(p), len(u)
    first, second = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
    for step in range(1, STEPS + 1):
        hidden, z = _forward(tuple(w), x)
        s = _sigmoid(z)  # the slope of l(-g) = log(1 + e^g); that of l(g) is s - 1
        grad = np.empty(len(x))
        if prior is None:
            grad[:np_], grad[np_:] = (s[:np_] - 1) / np_, s[np_:] / nu
        else:
            soft = np.logaddexp(0, z)
            negative = soft[np_:].mean() - prior * soft[:np_].mean()
            grad[:np_] = prior * (s[:np_] - 1) / np_
            if negative >= 0:
                grad[:np_] -= prior * s[:np_] / np_
                grad[np_:] = s[np_:] / nu
            else:  # the negative part went below zero: step back along it alone
                grad[:np_] = prior * s[:np_] / np_
                grad[np_:] = -s[np_:] / nu
        back = grad[:, None] * w[2] * (1 - hidden**2)
        slopes = [x.T @ back + DECAY * w[0], back.sum(0), hidden.T @ grad + DECAY * w[2], np.array([grad.sum()])]
        for a, g, m, v in zip(w, slopes, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            a -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return tuple(w)


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, from scores: the smallest ratio of the parts above a score.

    Above a score that hardly any negative reaches, unlabelled texts are as
    frequent as positives times the prior. One standard error is added for the
    choice, so small tails do not pass for small ratios, and taken off in the
    end: a prior that is too high hides negatives, one a little low costs nothing.
    """
    cuts = np.quantile(positive, np.linspace(0.02, 0.7, 35))
    above_p = np.array([(positive >= c).mean() for c in cuts])
    above_u = np.array([(unlabelled >= c).mean() for c in cuts])
    error = np.sqrt(above_u * (1 - above_u) / len(unlabelled)) + np.sqrt(above_p * (1 - above_p) / len(positive))
    best = int(np.argmin((above_u + error) / above_p))
    return float(np.clip((above_u[best] - error[best]) / above_p[best], 0.05, 0.98))


def train(positive: np.ndarray, unlabelled: np.ndarray) -> Scorer:
    """Estimates the prior from scores of texts that their scorer has not seen, then fits the non-negative risk on all."""
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(0), both.std(0) + 1e-3
    p, u = (positive - mean) / scale, (unlabelled - mean) / scale
    a, b = p[: POSITIVES // FOLDS], u[: UNLABELLED // FOLDS]
    seen_p, seen_u = np.arange(len(a)) % FOLDS, np.arange(len(b)) % FOLDS
    sp, su = np.zeros(len(a)), np.zeros(len(b))
    for fold in range(FOLDS if min(len(a), len(b)) >= 2 * FOLDS else 0):
        rough = _fit(a[seen_p != fold], b[seen_u != fold], None)
        sp[seen_p == fold] = _forward(rough, a[seen_p == fold])[1]
        su[seen_u == fold] = _forward(rough, b[seen_u == fold])[1]
    prior = class_prior(sp, su)
    return Scorer(mean, scale, _fit(p, u, prior), prior)


def _sampled(docs: DataFrame, ids: DataFrame, bound: int, key: str, text: str) -> np.ndarray:
    """Features of the first ``bound`` ids in hash order; no more rows than that reach the driver."""
    chosen = ids.select(F.col(key).alias("_id")).distinct().orderBy(F.xxhash64(F.lit(SEED), "_id"), "_id").limit(bound)
    found = docs.select(F.col(key).alias("_id"), F.col(text).cast("binary").alias("_body")).join(F.broadcast(chosen), "_id", "left_semi")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"id": f["_id"], "x": [features(b or b"").astype("<f8").tobytes() for b in f["_body"]]})

    rows = found.mapInPandas(run, "id long, x binary").dropDuplicates(["id"]).limit(bound).toPandas()
    rows = rows.sort_values("id").sample(frac=1, random_state=SEED)
    return np.stack([np.frombuffer(b, "<f8") for b in rows["x"]]) if len(rows) else np.empty((0, 0))


def fit_scorer(docs: DataFrame, trusted: DataFrame, unlabelled: DataFrame, key: str = "doc_id", text: str = "text") -> Scorer | None:
    """``trusted`` and ``unlabelled`` hold the keys to learn from; None if either is empty."""
    p = _sampled(docs, trusted, POSITIVES, key, text)
    u = _sampled(docs, unlabelled, UNLABELLED, key, text)
    return train(p, u) if len(p) and len(u) else None


def score_texts(docs: DataFrame, scorer: Scorer | None, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` and ``score`` in 0 to 1; one map stage over the whole texts."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("double")
    def score(bodies: pd.Series) -> pd.Series:
        if scorer is None or not len(bodies):
            return pd.Series(np.full(len(bodies), 0.5))
        return pd.Series(scorer(np.stack([features(b or b"") for b in bodies])))

    return docs.select(*keep, score(F.col(text).cast("binary")).alias("score"))


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string")) % 5 == 0
