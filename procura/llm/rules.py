"""Quality rules: fixed base rules, then a hashed n-gram model.

Every whole text gets rule counts (see ``base_counts``) and the probability of
being good by logistic regression over hashed word and character n-grams,
trained on labelled quality rows.  Training is distributed: each step of L-BFGS
sums the loss and gradient (of the fixed hashed size) per task.  The scores are
calibrated on rows outside the fit (Platt scaling) and held, in Arrow batches,
against fixed thresholds.

The fit uses at most ``max_rows`` labelled rows, drawn by a hash of their
ids; held-out rows are never learnt from.  Defined cases: null text is empty
(fails the base rules); rows with a null label are not used; a null id is
judged, never learnt from; repeated rows are judged each; without labelled rows
the base rules alone decide; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procura.llm.common import (covered, hash_words, map_batches, per_process, read_table, stage, texts_of,
                                window_hashes, word_hasher)
from procura.llm.quality import drawn_labels

#: Labelled rows that the fit may use, and hashed features of each kind.
MAX_ROWS = 24_000
WORD_BITS, CHAR_BITS = 13, 13
STEPS = 25
PENALTY = 2e-4
FIT_TASKS = 12
KEEP_AT = 0.5
MIN_WORDS, MAX_REPEATED_PERCENT, REPEAT_WINDOW = 20, 30, 8

_SYMBOL = bytes.maketrans(b"", b""), b"#*$%&|<>"


def base_counts(text: str, words: list[bytes], hashed: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    raw = text.encode()
    joined = b"".join(words).decode()
    symbols = len(raw) - len(raw.translate(*_SYMBOL))
    seen, duplicates = set(), 0
    for line in raw.split(b"\n"):
        if line.split():
            duplicates += line in seen
            seen.add(line)
    windows = window_hashes(hashed, REPEAT_WINDOW)
    repeated = 0
    if len(windows):
        _, inverse, count = np.unique(windows, return_inverse=True, return_counts=True)
        starts = np.flatnonzero(count[inverse] > 1)
        if len(starts):
            repeated = int(covered(starts, REPEAT_WINDOW, len(words)).sum())
    return len(words), len(joined), symbols, duplicates, repeated


def base_fails(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEATED_PERCENT * n_words


def hashed_grams(text: str, hashed: np.ndarray) -> np.ndarray:
    """Hashed counts of words, of pairs of neighbouring words and of character
    trigrams (bytes, blanks included), each kind damped and of unit length."""
    raw = np.frombuffer(f" {text} ".encode(), np.uint8).astype(np.uint32)
    grams = raw[:-2] | raw[1:-1] << 8 | raw[2:] << 16
    grams = (grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - CHAR_BITS)
    out = []
    words, pairs = ((h >> np.uint64(64 - WORD_BITS)).astype(np.int64) for h in (hashed, window_hashes(hashed, 2)))
    for bits, buckets in ((WORD_BITS, words), (WORD_BITS, pairs), (CHAR_BITS, grams)):
        v = np.log1p(np.bincount(buckets, minlength=1 << bits))
        norm = np.sqrt(v @ v)
        out.append(v / norm if norm else v)
    return np.concatenate(out)


def _words(text: str, hashes: dict) -> tuple[list[bytes], np.ndarray]:
    words = text.encode().split()
    return words, hash_words(words, hashes)


# --- training ---------------------------------------------------------------

def minimise(value_and_gradient: Callable, x: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """L-BFGS with step halving; each evaluation is one pass over the rows."""
    f, g = value_and_gradient(x)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        q, alphas = g.copy(), []
        for s, y in reversed(pairs):
            a = (s @ q) / (s @ y)
            alphas.append(a)
            q -= a * y
        if pairs:
            s, y = pairs[-1]
            q *= (s @ y) / (y @ y)
        for (s, y), a in zip(pairs, reversed(alphas)):
            q += (a - (y @ q) / (s @ y)) * s
        rate = 1.0 if pairs else 1.0 / max(1.0, np.abs(q).sum())
        for _ in range(6):
            moved = x - rate * q
            f2, g2 = value_and_gradient(moved)
            if f2 <= f - 1e-4 * rate * (g @ q):
                break
            rate /= 2
        else:
            return x
        s, y = moved - x, g2 - g
        if s @ y > 1e-12:
            pairs = (pairs + [(s, y)])[-memory:]
        done = f - f2 < 1e-5 * abs(f)
        x, f, g = moved, f2, g2
        if done:
            break
    return x


def training_rows(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """Hashed n-grams of the labelled rows that may be learnt from: non-zero
    places and values, label ``y`` and ``calibrate`` (a fifth of the rows)."""
    drawn = drawn_labels(labels, label, max_rows)

    def run(batches):
        hashes = per_process("word hashes", word_hasher)
        for batch in batches:
            texts = texts_of(batch.column(0))
            for at in range(0, len(texts), 64):
                place, value = [], []
                for text in texts[at:at + 64]:
                    v = hashed_grams(text, _words(text, hashes)[1])
                    where = np.flatnonzero(v).astype(np.int32)
                    place.append(where.tobytes())
                    value.append(v[where].astype(np.float32).tobytes())
                yield {"place": place, "value": value, "y": batch.column(1)[at:at + 64],
                       "calibrate": batch.column(2)[at:at + 64]}

    rows = docs.select(F.col("doc_id").cast("long"), "text").join(
        F.broadcast(drawn), "doc_id").select("text", "y", "calibrate")
    return map_batches(rows, run, "place binary, value binary, y double, calibrate boolean")


def _sparse(batch):
    for place, value, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
        yield np.frombuffer(place, np.int32), np.frombuffer(value, np.float32), y


def _total(df: DataFrame, fn: Callable, size: int) -> np.ndarray:
    """Sum over tasks (``FIT_TASKS`` of them) of a vector of ``size``."""
    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            fn(batch, total)
        yield {"total": [total.tobytes()]}

    return sum((np.frombuffer(r["total"]) for r in map_batches(df, run, "total binary").collect()), np.zeros(size))


class Model:
    """Weights over the hashed n-grams, a bias, and the calibration."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float = 1.0, shift: float = 0.0):
        self.weights, self.bias, self.slope, self.shift = weights, bias, slope, shift

    def margin(self, grams: np.ndarray) -> float:
        return float(grams @ self.weights + self.bias)

    def probability(self, margin: float) -> float:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def fit(train: DataFrame) -> Model | None:
    """Logistic regression on the rows of ``training_rows``; None without
    rows.  Rows of both labels weigh the same in sum."""
    train = stage(train.repartition(FIT_TASKS), "grams")
    size = 2 * (1 << WORD_BITS) + (1 << CHAR_BITS)
    count = {(r["calibrate"], r["y"] > 0): r["n"] for r in
             train.groupBy("calibrate", "y").agg(F.count("*").alias("n")).collect()}
    good, bad = count.get((False, True), 0), count.get((False, False), 0)
    if not good + bad:
        return None
    weigh = {True: 0.5 / max(good, 1), False: 0.5 / max(bad, 1)}
    rows = train.filter("not calibrate").persist()

    def loss(x):
        def add(batch, total):
            for place, value, y in _sparse(batch):
                sign, w = (1.0 if y > 0 else -1.0), weigh[y > 0]
                m = sign * (value @ x[place] + x[-1])
                total[-1] += w * np.logaddexp(0, -m)
                g = -w * sign / (1 + np.exp(np.clip(m, -30, 30)))
                total[place] += g * value
                total[-2] += g
        total = _total(rows, add, size + 2)
        total[:size] += PENALTY * x[:size]
        return total[-1] + 0.5 * PENALTY * (x[:size] @ x[:size]), total[:-1]

    x = minimise(loss, np.zeros(size + 1), STEPS)
    rows.unpersist()
    model = Model(x[:-1], float(x[-1]))

    def add_margins(batch, total):  # of calibration rows: counts by margin, for either label
        for place, value, y in _sparse(batch):
            at = int(np.clip((value @ model.weights[place] + model.bias) * 20 + 400, 0, 799))
            total[at + 800 * (y > 0)] += 1

    if count.get((True, True)) and count.get((True, False)):
        bins = _total(train.filter("calibrate"), add_margins, 1600).reshape(2, 800)
        model.slope, model.shift = _platt(bins, (np.arange(800) - 399.5) / 20)
    return model


def _platt(bins: np.ndarray, margin: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make counts by margin likeliest (Newton)."""
    a, b, n = 1.0, 0.0, bins.sum(0)
    rate = (bins[1] + n / (n.sum() + 2)) / np.maximum(n + 2 * n / (n.sum() + 2), 1e-9)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        r, w = n * (p - rate), n * p * (1 - p) + 1e-9
        h = np.array([[w @ margin ** 2 + 1e-3, w @ margin], [w @ margin, w.sum() + 1e-3]])
        step = np.linalg.solve(h, [r @ margin + 1e-3 * (a - 1), r.sum()])
        a, b = max(a - step[0], 0.05), b - step[1]
    return float(a), float(b)


OUT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
       "base_failed boolean, kept boolean, probability double")


def judge(docs: DataFrame, labels: DataFrame, label: str = "quality", keep_at: float = KEEP_AT,
          max_rows: int = MAX_ROWS) -> DataFrame:
    """Rule counts, the calibrated probability and the verdict of every row."""
    model = fit(training_rows(docs, labels, label, max_rows))
    names = [c.split()[0] for c in OUT.split(", ")]

    def run(batches):
        hashes = per_process("word hashes", word_hasher)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                words, hashed = _words(text, hashes)
                counts = base_counts(text, words, hashed)
                failed = base_fails(counts[0], counts[4])
                p = model.probability(model.margin(hashed_grams(text, hashed))) if model else 1.0
                rows.append((doc, *counts, failed, not failed and bool(p >= keep_at), float(p)))
            yield dict(zip(names, zip(*rows) if rows else [()] * len(names)))

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), run, OUT)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
