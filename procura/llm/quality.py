"""Quality classifier: random Fourier features over document statistics.

A document is described by a few statistics of its whole text.  Random Fourier
features turn a Gaussian kernel over the standardised statistics into a linear
model; its normal equations are summed per partition and solved once (their
size depends on the number of features alone).  Isotonic regression on rows
that the ridge fit has not seen turns raw scores into probabilities.

The fit uses at most about ``max_rows`` labelled rows, drawn by a hash of
their ids; the scores cover every row.  Defined cases: a null text is empty;
an empty text is scored like any other; rows with a null label are not used; a
null id is scored, never learnt from; repeated rows count each; without
labelled rows every score is 0.5; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procura.llm.common import held_out, map_batches, read_table, stage, texts_of

#: Labelled rows that a fit may use.
MAX_ROWS = 60_000
N_FEATURES = 384
RIDGE = 1e-4
THRESHOLD = 0.7
#: Tasks that sum the normal equations (one small matrix each to the driver).
FIT_TASKS = 12
BINS = 512

_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_STOPS = np.frombuffer(b".,;:", np.uint8)
_MARKS = np.frombuffer(b"!?", np.uint8)


def statistics(text: str) -> list[float]:
    """Statistics of a whole text; all zero for one without words."""
    raw = text.encode()
    words = raw.split()
    n, n_words = len(raw), len(words)
    if not words:
        return [0.0] * N_STATISTICS
    byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    letters = max(1, byte[65:91].sum() + byte[97:123].sum() + byte[128:].sum())
    share = byte[byte > 0] / n
    length = np.fromiter(map(len, words), np.int64, n_words)
    count = Counter(words)
    pairs = len(set(zip(words, words[1:], strict=False)))
    triples = len(set(zip(words, words[1:], words[2:], strict=False)))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return [
        np.log1p(n), np.log1p(n_words), length.mean(), length.std(), np.log1p(length.max()),
        (length <= 3).mean(), (length > 12).mean(),
        byte[65:91].sum() / letters, byte[48:58].sum() / n, byte[_SYMBOLS].sum() / n, byte[_MARKS].sum() / n,
        byte[_STOPS].sum() / n, byte[128:].sum() / n, (byte[9:14].sum() + byte[32]) / n,
        -(share * np.log2(share)).sum(), len(count) / n_words, max(count.values()) / n_words,
        pairs / max(1, n_words - 1), triples / max(1, n_words - 2),
        sum(map(bytes.__eq__, words, words[1:])) / n_words,
        np.log1p(len(lines)), 1 - len(set(lines)) / len(lines), np.log1p(n / len(lines)),
        len(zlib.compress(raw, 1)) / n, raw.count(b"http") / n_words, byte[64] / n_words, 1.0,
    ]


N_STATISTICS = 27


def describe(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out`` and the statistics ``x`` of every row."""
    def run(batches):
        for batch in batches:
            yield {"doc_id": batch.column(0), "held_out": batch.column(2),
                   "x": [np.asarray(statistics(t), np.float32) for t in texts_of(batch.column(1))]}

    doc_id = F.col("doc_id").cast("long")
    return map_batches(docs.select(doc_id.alias("doc_id"), "text", held_out(doc_id).alias("held_out")), run,
                       "doc_id long, held_out boolean, x array<float>")


#: Hashes that a draw compares, and how much more than needed it lets through.
DRAW_RANGE, DRAW_MORE = 1 << 62, 1.2


def draw_below(max_rows: int, n: int) -> int:
    """The hashes under this bound are about ``DRAW_MORE * max_rows`` of ``n``
    (all of them if there are no more)."""
    return min(DRAW_RANGE, int(DRAW_RANGE * DRAW_MORE) * max_rows // max(n, 1))


def drawn_labels(labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """``doc_id`` and ``y`` of the labels that may be learnt from: the
    ``max_rows`` smallest by a hash of the id, so small enough to broadcast; a
    fifth is marked ``calibrate``.  An id with several labels is one, with the
    largest of them.  The bound on the hash leaves few rows to sort."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("y"))
             .filter("y is not null and doc_id is not null").filter(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("y").alias("y")))
    place = F.pmod(F.xxhash64("doc_id", F.lit("draw")), F.lit(DRAW_RANGE))
    drawn = known.filter(place < draw_below(max_rows, known.count())).orderBy(place, "doc_id").limit(max_rows)
    fold = (F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(5)) == 0).alias("calibrate")
    return drawn.select("doc_id", "y", fold)


def matrix(column) -> np.ndarray:
    """A list column of equal lengths as a float matrix."""
    return column.flatten().to_numpy().reshape(len(column), -1).astype(np.float64)


def summed(df: DataFrame, fn) -> np.ndarray | None:
    """Sum over all rows of ``fn(batch) -> array``: one array a task."""
    def run(batches):
        total = None
        for batch in batches:
            part = fn(batch)
            total = part if total is None else total + part
        if total is not None:
            yield {"total": [total.astype(np.float64).tobytes()], "shape": [list(total.shape)]}

    rows = map_batches(df, run, "total binary, shape array<int>").collect()
    return sum(np.frombuffer(r["total"]).reshape(r["shape"]) for r in rows) if rows else None


def isotonic(positive: np.ndarray, total: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins: (knots, non-decreasing rates)."""
    blocks: list[list[float]] = []  # positives, rows, sum of centre * rows
    for p, n, c in zip(positive, total, centre):
        if n:
            blocks.append([p, n, c * n])
            while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
                last = blocks.pop()
                blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[2] / b[1] for b in blocks]), np.array([b[0] / b[1] for b in blocks])


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    phase: np.ndarray
    beta: np.ndarray
    knots: np.ndarray
    rates: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.cos(np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.phase)
        return np.concatenate([z * np.sqrt(2 / len(self.phase)), np.ones((len(x), 1))], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability; a thousandth of the raw score breaks ties."""
        raw = self.features(x) @ self.beta
        return 0.999 * np.interp(raw, self.knots, self.rates) + 0.001 * np.clip(raw, 0, 1)


def fit(described: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on the described rows with ``drawn_labels``; None without rows."""
    train = described.join(F.broadcast(labels), "doc_id")
    train = stage(train.select("x", "y", "calibrate").repartition(FIT_TASKS), "train")

    def sums(batch):
        x = matrix(batch.column(0))
        return np.stack([x.sum(0), (x * x).sum(0), np.full(x.shape[1], len(x))])

    moments = summed(train, sums)
    if moments is None:
        return None
    mean = moments[0] / moments[2]
    scale = np.sqrt(np.maximum(moments[1] / moments[2] - mean ** 2, 0))
    scale[scale < 1e-6] = 1.0
    rng = np.random.default_rng(7)
    d = len(mean)
    model = Model(mean, scale, rng.normal(size=(d, N_FEATURES)) / (0.8 * np.sqrt(d)),
                  rng.uniform(0, 2 * np.pi, N_FEATURES), np.zeros(N_FEATURES + 1), np.array([0.0]), np.array([0.5]))

    def equations(batch):
        z, y = model.features(matrix(batch.column(0))), batch.column(1).to_numpy()
        return np.concatenate([z.T @ z, (z.T @ y)[None, :]])

    total = summed(train.filter("not calibrate"), equations)
    if total is not None:
        n = total[N_FEATURES, N_FEATURES]
        model.beta = np.linalg.solve(total[:-1] + RIDGE * n * np.eye(N_FEATURES + 1), total[-1])
    edges = np.linspace(-0.5, 1.5, BINS + 1)

    def histogram(batch):
        raw = np.clip(model.features(matrix(batch.column(0))) @ model.beta, -0.5, 1.5)
        y = batch.column(1).to_numpy()
        return np.stack([np.histogram(raw, edges, weights=y)[0], np.histogram(raw, edges)[0]])

    bins = summed(train.filter("calibrate"), histogram)
    if bins is not None:
        model.knots, model.rates = isotonic(bins[0], bins[1], (edges[1:] + edges[:-1]) / 2)
    return model


OUT = "doc_id long, held_out boolean, score double, predicted int"


def score(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD,
          max_rows: int = MAX_ROWS) -> DataFrame:
    """Score every row of ``docs`` for ``label``."""
    described = stage(describe(docs), "described")
    model = fit(described, drawn_labels(labels, label, max_rows))

    def run(batches):
        for batch in batches:
            x = matrix(batch.column(2))
            s = np.full(len(x), 0.5) if model is None else np.clip(model.score(x), 0, 1)
            yield {"doc_id": batch.column(0), "held_out": batch.column(1), "score": s,
                   "predicted": (s >= threshold).astype(np.int32)}

    return map_batches(described, run, OUT)


def drop_rejected(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD,
                  max_rows: int = MAX_ROWS) -> DataFrame:
    """``docs`` without the rows whose score is under ``threshold``.  The
    documents are filtered where they are read, with no join or shuffle."""
    drawn = drawn_labels(labels, label, max_rows)
    model = fit(describe(docs.join(F.broadcast(drawn.select("doc_id").distinct()), "doc_id", "left_semi")), drawn)

    @F.pandas_udf("boolean")
    def keeps(text: pd.Series) -> pd.Series:
        x = np.array([statistics(t or "") for t in text], np.float32).reshape(-1, N_STATISTICS).astype(np.float64)
        return pd.Series(np.full(len(x), 0.5) >= threshold if model is None else model.score(x) >= threshold)

    return docs.filter(keeps("text"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
