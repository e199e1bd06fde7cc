"""Quality classifier by Bradley-Terry ranking: from pairs of a good and a bad
document, logistic loss on the difference of their features gives a score; a
quantile of the scores separates the classes."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.llm.common import map_batches, strings

#: Byte classes of a text: white space, line break, lower, upper, digit, sentence end, symbol, other, beyond ASCII.
CLASSES = 9
_CLASS = np.full(256, 7, np.int64)
_CLASS[128:] = 8
for _i, _chars in enumerate((b" \t\r\x0b\x0c", b"\n", bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789",
                             b".!?:;,", b"#*$%&|<>@^~_=+{}[]\\/")):
    _CLASS[list(_chars)] = _i
TRIGRAMS = CLASSES ** 3
EXTRA = 6
WIDTH = TRIGRAMS + EXTRA
MAX_SAMPLE = 6000      # labelled rows a model is fitted on, at most half of each label
PAIRS_PER_ROW = 6
SEED = 7


def features(text: str) -> np.ndarray:
    """Frequencies of byte-class trigrams, with repetition and length
    measures; from the whole text.  The empty text gives zeros."""
    out = np.zeros(WIDTH, np.float32)
    data = text.encode("utf-8", "surrogatepass")
    if not data:
        return out
    c = _CLASS[np.frombuffer(data, np.uint8)]
    if len(c) > 2:
        grams = np.bincount(c[:-2] * CLASSES ** 2 + c[1:-1] * CLASSES + c[2:], minlength=TRIGRAMS)
        out[:TRIGRAMS] = np.sqrt(grams / (len(c) - 2))
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    if words:
        ids: dict = {}
        rank = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
        pairs = np.unique(rank[:-1] * len(ids) + rank[1:]).size
        n = len(words)
        out[TRIGRAMS:] = (math.log1p(n) / 10, len(ids) / n, pairs / max(1, n - 1),
                          float((rank[1:] == rank[:-1]).mean()) if n > 1 else 0.0,
                          len(set(lines)) / len(lines), min(40.0, len(data) / n) / 10)
    return out


@dataclass(frozen=True)
class RankModel:
    weights: np.ndarray
    threshold: float
    scale: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x @ self.weights - self.threshold) / self.scale, -30, 30)
        return 1 / (1 + np.exp(-z))


def fit_pairs(x: np.ndarray, good: np.ndarray, steps: int = 300, l2: float = 1e-3, rate: float = 0.05) -> RankModel:
    """Fit on feature rows and their labels.  Every row meets
    ``PAIRS_PER_ROW`` rows of the other label; Adam on the mean logistic loss
    of score differences.  The threshold is the score quantile with the best
    share of right labels, halfway to the next score.  Without both labels
    there is no pair: all weights are zero and every score is one half."""
    x = x.astype(np.float64)
    up, down = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(up) or not len(down):
        return RankModel(np.zeros(x.shape[1] if x.ndim == 2 else WIDTH), 0.0, 1.0)
    rng = np.random.default_rng(SEED)
    left = np.concatenate([np.repeat(up, PAIRS_PER_ROW), rng.choice(up, len(down) * PAIRS_PER_ROW)])
    right = np.concatenate([rng.choice(down, len(up) * PAIRS_PER_ROW), np.repeat(down, PAIRS_PER_ROW)])
    spread = x.std(axis=0) + 1e-3
    z = x / spread
    w, m, v = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for t in range(1, steps + 1):
        s = z @ w
        p = -1 / (1 + np.exp(np.clip(s[left] - s[right], -30, 30))) / len(left)
        pull = np.bincount(left, p, len(x)) - np.bincount(right, p, len(x))
        g = z.T @ pull + l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    scores = z @ w
    order = np.argsort(scores, kind="stable")
    s, y = scores[order], good[order]
    # rows below the cut are called bad: right are the bad ones below it and the good ones above
    weight = np.where(y, 1 / y.sum(), 1 / (~y).sum())
    right_at = np.concatenate([[0], np.cumsum(np.where(y, 0, weight))]) + (1 - np.concatenate([[0], np.cumsum(np.where(y, weight, 0))]))
    cut = int(np.argmax(right_at[1:-1])) + 1 if len(s) > 2 else 1
    return RankModel(w / spread, float((s[cut - 1] + s[cut]) / 2), float(s.std() + 1e-9))


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_SAMPLE) -> RankModel:
    """Fit on at most ``max_rows`` labelled documents (half of each label at
    most, chosen by a hash of the id).  ``labels``: doc_id, quality 0/1; rows
    with a null or other label are left out, of repeated ids the larger label
    counts.  Only the bounded sample's features reach the driver."""
    known = (labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    half = max(1, max_rows // 2)
    sample = [known.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(half) for q in (0, 1)]
    chosen = F.broadcast(sample[0].unionByName(sample[1]))  # at most max_rows rows of two numbers
    texts = docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "quality", "text")
    rows = map_batches(texts, _feature_rows, "doc_id bigint, quality int, x binary").collect()
    rows.sort(key=lambda r: (r.doc_id, bytes(r.x)))
    if not rows:
        return fit_pairs(np.zeros((0, WIDTH)), np.zeros(0, bool))
    x = np.stack([np.frombuffer(r.x, np.float32) for r in rows])
    return fit_pairs(x, np.array([r.quality == 1 for r in rows]))


def _feature_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    xs = [features(t).tobytes() for t in strings(batch, "text")]
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id").cast(pa.int64()), batch.column("quality").cast(pa.int32()), pa.array(xs, pa.binary())],
        names=["doc_id", "quality", "x"])


def score_quality(docs: DataFrame, model: RankModel, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns with ``score`` (0 to 1) and ``predicted`` (1 from
    one half on) for every row.  A null text is the empty one; its features are
    zero.  Only the text is read for the score.  Repeated rows score alike."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carry).schema]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = strings(batch, "text")
        s = np.array([model.score(features(t)) for t in texts], np.float64)
        return pa.RecordBatch.from_arrays(
            [batch.column(c) for c in carry] + [pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))],
            names=[*carry, "score", "predicted"])
    return map_batches(docs.select(*dict.fromkeys([*carry, "text"])), run, ", ".join(fields) + ", score double, predicted int")
