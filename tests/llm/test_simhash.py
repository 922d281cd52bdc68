import random

import numpy as np
import pytest
import xxhash

from procura.llm import simhash


def brute_fingerprint(text, k):
    words = [w for w in text.encode().lower().replace(b"\t", b" ").replace(b"\n", b" ").split(b" ") if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    value = 0
    for bit in range(64):
        ones = sum(xxhash.xxh64_intdigest(s, 42) >> bit & 1 for s in shingles)
        value |= (2 * ones > len(shingles)) << bit
    return value


def brute_components(prints, bits):
    """prints: (id, fingerprint) -> component of each row, by all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= bits:
                root[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(prints):
        groups.setdefault(find(i), []).append(doc)
    return [min((d for d in groups[find(i)] if d is not None), default=None) for i in range(len(prints))]


def rows_of(rng):
    words = ["Ab", "cd", "É", "ef", "gh,", "ij", "kl", "mn"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(80)]
    for i in range(80, 160):  # near copies of one text, exact copies of another
        base = rows[0][1].split(" ") if i % 2 else rows[1][1].split(" ")
        if i % 2:
            base[rng.randrange(len(base))] = rng.choice(words)
        rows.append((i, " ".join(base)))
    return rows + [(200, None), (201, ""), (202, " \t\n"), (203, "one"), (204, "one two"), (5, "one two"), (None, "one")]


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_against_all_pairs(spark, table, bits):
    rows = rows_of(random.Random(bits))
    prints = [(d, brute_fingerprint(t or "", 3)) for d, t in rows]
    want = sorted(((d, f, c) for (d, f), c in zip(prints, brute_components(prints, bits))), key=repr)
    got = simhash.near_duplicates(table(rows).repartition(3), 3, bits).collect()
    assert sorted(((r.doc_id, r.fp & (2 ** 64 - 1), r.component_id) for r in got), key=repr) == want


@pytest.mark.parametrize("bits", [3, 4])
def test_keys_over_the_limit_are_dealt_out_anew(spark, table, monkeypatch, bits):
    monkeypatch.setattr(simhash, "KEY_LIMIT", 3)
    rows = rows_of(random.Random(3))
    prints = [(d, brute_fingerprint(t or "", 3)) for d, t in rows]
    want = sorted(zip((d for d, _ in prints), brute_components(prints, bits)), key=repr)
    got = simhash.near_duplicates(table(rows), 3, bits).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=repr) == want


def test_links_join_up_a_dense_group_with_few_links():
    rng = np.random.default_rng(1)
    fps = np.unique((np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64)) ^
                    (np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64)))
    assert len(simhash.link_group(fps, 3)) == len(fps) - 1


def test_flooded_runs_over_batch_borders():
    import pyarrow as pa
    rng = random.Random(4)
    rows = sorted((t, k, rng.getrandbits(40)) for t in range(2) for k in range(6) for _ in range(rng.choice([1, 2, 9])))
    for size in (1, 2, 5, 100):
        batches = [pa.RecordBatch.from_pydict({c: [r[i] for r in rows[at:at + size]] for i, c in enumerate("tkf")})
                   for at in range(0, len(rows), size)]
        over = sorted(a for out in simhash._links_by_key(3, 4)(iter(batches)) for a, o in zip(out["a"], out["over"]) if o)
        count = {}
        for t, k, f in rows:
            count.setdefault((t, k), []).append(f)
        want = sorted(f for fs in count.values() if len(fs) > 4 for f in fs)
        assert over == want


def test_empty_table(spark, table):
    assert simhash.near_duplicates(table([])).collect() == []


def test_longer_keys_find_every_pair():
    rng = random.Random(6)
    for bits in (1, 3, 4, 7):
        blocks, keep = simhash.fine_blocks(bits)
        masks = simhash._masks(blocks, keep) if bits < 7 else None
        assert blocks - keep == bits and blocks <= 16
        for _ in range(30 if masks else 0):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), bits):
                b ^= 1 << bit
            assert any(a & m == b & m for m in masks)


def test_pivots_discard_nearly_all_pairs():
    """Of the pairs that meet, the table of distances leaves few to verify."""
    rng = np.random.default_rng(3)
    fps = rng.integers(0, 1 << 63, 400, dtype=np.uint64) << np.uint64(1)
    table = simhash.pivot_table(fps).astype(int)
    far = np.abs(table[:, :, None] - table[:, None, :]).max(0)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    assert (far[near] <= 3).all() and (far <= 3).sum() - len(fps) < 0.001 * len(fps) ** 2
