import random

import pytest

from procura.llm import substrings


def brute(rows, window):
    words = [(d, (t or "").encode().split()) for d, t in rows]
    low = {}
    for d, w in words:
        if d is not None:
            for i in range(len(w) - window + 1):
                key = tuple(w[i:i + window])
                low[key] = min(low.get(key, d), d)
    out = []
    for d, w in words:
        gone = set()
        if d is not None:
            for i in range(len(w) - window + 1):
                if low[tuple(w[i:i + window])] < d:
                    gone.update(range(i, i + window))
        left = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), b" ".join(left).decode()))
    return sorted(out, key=repr)


def fixture(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["é", "x\u00a0y"]
    passages = [[rng.choice(words) for _ in range(rng.randint(8, 70))] for _ in range(4)]
    rows = []
    for d in rng.sample(range(-50, 5000), 70):
        text = []
        for _ in range(rng.randint(0, 4)):
            text += [rng.choice(words) for _ in range(rng.randint(0, 30))]
            p = rng.choice(passages)
            a = rng.randint(0, 5)
            text += p[a:a + rng.randint(0, len(p))]
        rows.append((d, rng.choice([" ", "\n", "\t "]).join(text)))
    rows += [(6000, rows[0][1]), (6001, rows[0][1]), (6001, rows[0][1]), (6002, None), (6003, ""), (None, rows[0][1])]
    rows += [(6004, "same " * 200), (6005, "same " * 90), (6006, "other " * 60 + "same " * 7), (6001, rows[1][1])]
    return rows


@pytest.mark.parametrize("window", [4, 10, 50])
def test_against_all_windows(spark, table, window):
    rows = fixture(window)
    got = substrings.remove_repeats(table(rows).repartition(5), window).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=repr) == brute(rows, window)


def test_small_word_groups_and_extreme_ids(spark, table, monkeypatch):
    monkeypatch.setattr(substrings, "GROUP_WORDS", 40)
    rows = fixture(3) + [(-2 ** 63, "same " * 60), (2 ** 63 - 1, "same " * 60)]
    got = substrings.remove_repeats(table(rows), 10).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=repr) == brute(rows, 10)


def test_empty_table_and_odd_window(spark, table):
    assert substrings.remove_repeats(table([])).collect() == []
    with pytest.raises(ValueError):
        substrings.remove_repeats(table([]), 7)
