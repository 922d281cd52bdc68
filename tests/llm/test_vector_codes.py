import math
import random

import numpy as np
import pytest
from procura.llm.vector_codes import compress, digest, nearest, nearest_from, pack, unpack

SCHEMA = "vec_id long, embedding array<float>, label int, code string, part int"


def brute(rows, parts=16, entries=64, rounds=2):
    """rows of (vec_id, vector, label) with 16k components, all kept."""
    rows = sorted((i, [math.floor(256 * x) for x in v]) for i, v, _ in rows)
    width = len(rows[0][1]) // parts
    cut = {i: [v[p * width:(p + 1) * width] for p in range(parts)] for i, v in rows}
    books = [[cut[i][p] for i, _ in rows[:entries]] for p in range(parts)]

    def best(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            of = {}
            for i, _ in rows:
                of.setdefault(best(cut[i][p], books[p])[1], []).append(cut[i][p])
            books[p] = [[sum(c) // len(of[k]) for c in zip(*of[k])] if k in of else c for k, c in enumerate(books[p])]
    found = {i: [best(x[p], books[p]) for p in range(parts)] for i, x in cut.items()}
    return {i: ("".join("%02x" % k for _, k in f), sum(d for d, _ in f)) for i, f in found.items()}, books


def result(df):
    return {r.vec_id: (bytes(r.codes).hex(), r.error) for r in df.collect()}


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 0) for i, v, label in rows], SCHEMA)


def vectors(n, seed, dims=32, spread=1.0):
    r = random.Random(seed)
    return [(i, [float(np.float32(r.gauss(0, spread))) for _ in range(dims)], i % 3) for i in r.sample(range(10 * n), n)]


@pytest.mark.parametrize("n, spread", [(300, 1.0), (200, 0.004), (20, 1.0)])
def test_against_brute_force(spark, n, spread):
    rows = vectors(n, n, spread=spread)  # the small spread makes ties and equal entries
    got, books = compress(frame(spark, rows).repartition(5))
    want, plain = brute(rows)
    assert result(got) == want
    assert digest(books) == digest([np.array(b) for b in plain])


def test_dropped_vectors_and_odd_lengths(spark):
    good = vectors(90, 3, dims=16)
    bad = [(1000, None, 1), (1001, [None] + [0.0] * 15, 1), (1002, [float("nan")] * 16, 1), (1003, [float("inf")] + [0.0] * 15, 1),
           (1004, [0.5] * 32, 1), (1005, [], 1)]
    got, _ = compress(frame(spark, good + bad))
    assert result(got) == brute(good)[0]
    short = [(i, v[:10], None) for i, v, _ in vectors(70, 4, dims=16)]
    got, _ = compress(frame(spark, short))
    assert result(got) == brute([(i, v + [0.0] * 6, None) for i, v, _ in short])[0]
    got, books = compress(frame(spark, [(1, [], 1), (2, [], 2)]))
    assert result(got) == {1: ("00" * 16, 0), 2: ("00" * 16, 0)}


def test_empty_repeated_and_missing_ids(spark):
    got, books = compress(frame(spark, []))
    assert got.collect() == [] and books == []
    got, books = compress(frame(spark, [(1, None, 1)]))
    assert got.collect() == [] and books == []
    same = [0.25] * 16
    got, books = compress(frame(spark, [(7, same, 1)] * 5), entries=2)
    # the smallest rows are equal: ties go to the lower entry, the other is never used
    assert [[int(x) for x in e] for e in books[0]] == [[64], [64]]
    assert [(bytes(r.codes), r.error) for r in got.collect()] == [(b"\0" * 16, 0)] * 5
    # rows without an id come last, and are coded and counted as any other
    rows = [(None, [9.0] * 16, None), (7, [0.5] * 16, 2), (7, same, 1), (9, [8.0] * 16, 3)]
    got, books = compress(frame(spark, rows), entries=2)
    want, plain = brute([(7, same, 1), (8, [0.5] * 16, 2), (9, [8.0] * 16, 3), (10, [9.0] * 16, None)], entries=2)
    assert digest(books) == digest([np.array(b) for b in plain])
    assert sorted((bytes(r.codes).hex(), r.error) for r in got.collect()) == sorted(want.values())


def test_huge_components_are_exact(spark):
    rows = [(i, [x * (1 if k % 2 else -1) for k in range(16)], 0) for i, x in enumerate([1e30, 3e30, 2.5e5, 1.5, 0.001, 7e9])]
    rows = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows]
    got, books = compress(frame(spark, rows), entries=2)
    want, plain = brute(rows, entries=2)
    assert digest(books) == digest([np.array(b, object) for b in plain])
    assert {i: c for i, (c, _) in result(got).items()} == {i: c for i, (c, _) in want.items()}
    for i, (_, error) in result(got).items():
        assert error == (want[i][1] if want[i][1] < 1 << 63 else None)


def test_balls_give_the_nearest_entry_and_skip_work():
    rng = np.random.default_rng(1)
    centres = rng.integers(-2000, 2000, (64, 4))
    points = centres[rng.integers(0, 64, 5000)] + rng.integers(-60, 60, (5000, 4))
    last, _ = nearest(points, centres)
    moved = centres + rng.integers(-20, 20, centres.shape)
    met = []
    got = nearest_from(points, moved, last, met)
    want = nearest(points, moved)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
    assert met[0] < 5000 * 63 / 20
    # any earlier assignment gives the same result, however bad
    worst = nearest_from(points, moved, rng.integers(0, 64, 5000))
    assert (worst[0] == want[0]).all() and (worst[1] == want[1]).all()
    grid = rng.integers(-2, 2, (3000, 2))  # many ties
    book = rng.integers(-2, 2, (20, 2))
    got = nearest_from(grid, book, rng.integers(0, 20, 3000))
    assert (got[0] == nearest(grid, book)[0]).all()


def test_packed_integers():
    for v in ([], [1, -2], [70_000, -70_000], [1 << 70, -5]):
        a = np.array(v, object if v and max(map(abs, v)) > 1 << 62 else np.int64)
        assert unpack([pack(a)])[0].tolist() == v
    mixed = unpack([pack(np.array([1, 2])), pack(np.array([1 << 40, 2]))])
    assert mixed.tolist() == [[1, 2], [1 << 40, 2]]
