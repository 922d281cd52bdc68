import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from procura.llm import quality, rules


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


@pytest.fixture(scope="module")
def marked(spark):
    rng = random.Random(1)
    words = "the of and to river stone light water paper house green small morning".split()
    rows, labels = [], []
    for i in range(600):
        good = rng.random() < 0.7
        text = " ".join(rng.choice(words) + str(rng.randint(0, 99) if good else "###") for _ in range(rng.randint(25, 80)))
        rows.append((i, text))
        if i % 3:
            labels.append((i, int(good)))
    rows += [(700, None), (701, ""), (702, "x " * 30_000), (703, " ".join(f"w{k}" for k in range(19))), (5, rows[5][1]),
             (None, rows[6][1])]
    labels += [(700, None), (None, 1), (999, 0)]
    return (spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as score", "'q' as x", "0 as y").repartition(3),
            spark.createDataFrame(labels, "doc_id long, quality int"), rows, dict(labels))


def test_scores_separate_held_out_rows(marked):
    docs, labels, rows, y = marked
    out = quality.score(docs, labels).collect()
    assert len(out) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= quality.THRESHOLD) for r in out)
    assert all(r.held_out == (r.doc_id is not None and held(r.doc_id)) for r in out)
    told = [(r.predicted, y[r.doc_id]) for r in out if r.held_out and y.get(r.doc_id) is not None]
    assert np.mean([p == t for p, t in told]) > 0.95


def test_held_out_labels_change_nothing(spark, marked):
    docs, labels, _, _ = marked
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2,
                                                 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({(r.doc_id, r.predicted) for r in quality.score(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_dropping_agrees_with_the_scores(marked):
    docs, labels, _, _ = marked
    kept = sorted((r.doc_id for r in quality.drop_rejected(docs, labels).collect()), key=repr)
    assert kept == sorted((r.doc_id for r in quality.score(docs, labels).collect() if r.predicted), key=repr)
    assert quality.drop_rejected(docs, labels).columns == docs.columns


def test_isotonic_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(50):
        total = rng.integers(0, 6, 12)
        positive = np.array([rng.integers(0, n + 1) for n in total])
        knots, rates = quality.isotonic(positive, total, np.arange(12.0))
        assert (np.diff(rates) >= 0).all() and (np.diff(knots) > 0).all()
        at = np.flatnonzero(total)
        for k, i in enumerate(at):  # min-max formula of the isotonic fit
            want = max(min(positive[at[a:b + 1]].sum() / total[at[a:b + 1]].sum() for b in range(k, len(at))) for a in range(k + 1))
            # the block that holds bin i has this rate
            assert np.isclose(rates, want).any()


def test_no_labels_and_empty_tables(spark, marked):
    docs, labels, _, _ = marked
    assert {r.score for r in quality.score(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score(docs.limit(0), labels).collect() == []
    assert rules.judge(docs.limit(0), labels).collect() == []
    assert all(r.kept != r.base_failed for r in rules.judge(docs, labels.limit(0)).collect())


def brute_counts(text):
    text = text or ""
    words = text.encode().split()
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    again = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else set(windows)
    covered = {k for i, w in enumerate(windows) if w in again for k in range(i, i + 8)}
    return (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), dup, len(covered))


def test_rule_counts_and_verdicts(marked):
    docs, labels, rows, y = marked
    out = rules.judge(docs, labels).collect()
    want = sorted((d, *brute_counts(t)) for d, t in rows if d is not None)
    assert sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                  for r in out if r.doc_id is not None) == want
    for r in out:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and r.probability >= rules.KEEP_AT)
    told = [(r.kept, y[r.doc_id]) for r in out if not r.base_failed and r.doc_id is not None and held(r.doc_id)
            and y.get(r.doc_id) is not None]
    assert np.mean([k == bool(t) for k, t in told]) > 0.95


def test_repeats_lines_and_symbols():
    for text in ["", "a b c d e f g h a b c d e f g h", "x\n\nx\n \nx\ty\nx\ty", "é#*$%&|<>    w", "a " * 40,
                 "a b c d e f g h i a b c d e f g h", "line\r\nline\r\n"]:
        words, hashed = rules._words(text, rules.word_hasher())
        assert rules.base_counts(text, words, hashed) == brute_counts(text)


def test_minimise_finds_the_optimum():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(8, 8))
    a, b = a @ a.T + np.eye(8), rng.normal(size=8)
    x = rules.minimise(lambda x: (0.5 * x @ a @ x - b @ x, a @ x - b), np.zeros(8), 200)
    assert np.allclose(x, np.linalg.solve(a, b), atol=0.05)


def test_some_labels_are_drawn_from_any_number():
    for n in (10, 10 ** 6, 10 ** 11, 10 ** 15):
        share = quality.draw_below(60_000, n) / quality.DRAW_RANGE
        assert share == 1 if n <= 60_000 else abs(share * n / 72_000 - 1) < 0.01


def test_drawn_labels_are_bounded(spark):
    rows = [(k, k % 2) for k in range(4000)] + [(1, 0)] * 3000 + [(None, 1), (7, None)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int").repartition(5)
    drawn = [tuple(r) for r in quality.drawn_labels(labels, "quality", 500).collect()]
    ids = [d for d, _, _ in drawn]
    assert len(ids) == len(set(ids)) == 500 and not any(held(i) for i in ids)
    assert all(y == i % 2 for i, y, _ in drawn)
    assert 60 < sum(c for _, _, c in drawn) < 150
    every = {r.doc_id: r.y for r in quality.drawn_labels(labels, "quality", 10 ** 6).collect()}
    assert every == {i: float(i % 2) for i in range(4000) if not held(i)}  # the largest label of an id


def test_scores_against_a_brute_force_fit(spark, marked):
    """The whole query against the same model fitted on plain arrays."""
    docs, labels, rows, y = marked
    out = {r.doc_id: r.score for r in quality.score(docs, labels).collect() if r.doc_id is not None and r.doc_id != 5}
    fold = {r.doc_id: r.calibrate for r in quality.drawn_labels(labels, "quality", quality.MAX_ROWS).collect()}
    text = {}
    for d, t in rows:
        if d is not None:
            text.setdefault(d, []).append(t or "")
    train = [(np.array(quality.statistics(t), np.float32).astype(float), float(y[d]), fold[d])
             for d in fold if d in text for t in text[d]]
    x, target, calibrate = (np.array(v) for v in zip(*train))
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-6] = 1.0
    rng = np.random.default_rng(7)
    n = quality.N_FEATURES
    weights = rng.normal(size=(x.shape[1], n)) / (0.8 * np.sqrt(x.shape[1]))
    phase = rng.uniform(0, 2 * np.pi, n)

    def features(v):
        z = np.cos(np.clip((v - mean) / scale, -8, 8) @ weights + phase) * np.sqrt(2 / n)
        return np.concatenate([z, np.ones((len(v), 1))], axis=1)

    z = features(x[~calibrate])
    beta = np.linalg.solve(z.T @ z + quality.RIDGE * len(z) * np.eye(n + 1), z.T @ target[~calibrate])
    edges = np.linspace(-0.5, 1.5, quality.BINS + 1)
    raw = np.clip(features(x[calibrate]) @ beta, -0.5, 1.5)
    knots, rates = quality.isotonic(np.histogram(raw, edges, weights=target[calibrate])[0], np.histogram(raw, edges)[0],
                                    (edges[1:] + edges[:-1]) / 2)
    for d, texts in text.items():
        if d == 5:
            continue
        r = features(np.array([quality.statistics(texts[0])], np.float32).astype(float)) @ beta
        want = np.clip(0.999 * np.interp(r, knots, rates) + 0.001 * np.clip(r, 0, 1), 0, 1)[0]
        assert abs(out[d] - want) < 1e-5, d


def test_pairs_of_words_are_features():
    a, b = "alpha beta gamma delta", "delta gamma beta alpha"
    grams = [rules.hashed_grams(t, rules._words(t, rules.word_hasher())[1]) for t in (a, b)]
    words = 1 << rules.WORD_BITS
    assert len(grams[0]) == 2 * words + (1 << rules.CHAR_BITS)
    assert (grams[0][:words] == grams[1][:words]).all() and (grams[0][words:2 * words] != grams[1][words:2 * words]).any()
    assert not rules.hashed_grams("one", rules._words("one", rules.word_hasher())[1])[words:2 * words].any()
