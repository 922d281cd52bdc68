import random
import re
from collections import Counter, defaultdict

import pytest
from procura.llm.divergence import Audit, audit

TERM = re.compile("[A-Za-z\x80-\U0010ffff]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, min_docs, limit=50):
    docs = [(lower(t or ""), lang or "", s or "") for t, lang, s in rows]
    counts, in_docs = defaultdict(Counter), defaultdict(Counter)
    for t, lang, s in docs:
        words = TERM.findall(t)
        counts[lang, s].update(words)
        in_docs[lang].update(set(words))
    out = []
    for lang, source in counts:
        kept = sorted((t for t, n in in_docs[lang].items() if n >= min_docs), key=str.encode)
        fellows = [s for one, s in counts if one == lang]

        def shares(n):
            total = sum(n[t] for t in kept)
            return {t: 1 + 10 ** 9 * (n[t] + 5) // (total + 5 * len(kept)) for t in kept}
        mine, whole = shares(counts[lang, source]), shares(sum((counts[lang, s] for s in fellows), Counter()))
        pairs = [(s, sum(abs(mine[t] - p) for t, p in shares(counts[lang, s]).items())) for s in fellows if s != source]
        terms = [(t, mine[t] - whole[t]) for t in kept if counts[lang, source][t] and mine[t] > whole[t]]
        for part, items in (("pair", pairs), ("term", terms)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, x, v, k) for k, (x, v) in enumerate(ranked, 1) if part == "pair" or k <= limit]
    return sorted(out)


def result(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def corpus(spark):
    def make(rows):
        return spark.createDataFrame([(*r, k, "x") for k, r in enumerate(rows)],
                                     "text string, lang string, source string, term int, rank string")
    return make


def random_rows(seed, n=120):
    r = random.Random(seed)
    words = ["Alpha", "beta", "γάμμα", "über", "日本", "a", "zz", "É", "é"] + ["w" + chr(97 + k) for k in range(20)]
    return [(None if r.random() < .05 else " ".join(r.choice(words[:r.randrange(1, len(words))]) + r.choice([".", " 7", "_", "-x"])
                                                   for _ in range(r.randrange(15))),
             r.choice(["en", "de", None, "en"]), r.choice(["s1", "s2", "s3", None, "ß"])) for _ in range(n)]


@pytest.mark.parametrize("min_docs, limit", [(1, 3), (4, 50), (1000, 50)])
def test_against_brute_force(corpus, min_docs, limit):
    rows = random_rows(min_docs)
    assert result(audit(corpus(rows), min_docs, limit)) == brute(rows, min_docs, limit)


def test_small_blocks_and_slices(corpus):
    rows = random_rows(9)
    want = [r for r in brute(rows, 2) if r[2] == "pair"]
    assert result(Audit(corpus(rows), 2).source_pairs(block_cells=12, block_pairs=6)) == want


def test_cells_of_equal_value_are_cut_in_utf8_order(corpus):
    # 80 terms of one cell: ranks go by UTF-8 order, which is not UTF-16 order
    odd = ["\U0001f600", "￮", "z", "é"] + ["t" + chr(97 + k // 26) + chr(97 + k % 26) for k in range(76)]
    rows = [(" ".join(odd), "en", "a"), (" ".join(odd), "en", "a"), ("other words here", "en", "b"), ("other words", "en", "b")]
    got = result(audit(corpus(rows), 2))
    assert got == brute(rows, 2)
    assert len([r for r in got if r[2] == "term" and r[1] == "a"]) == 50


def test_defined_cases(corpus):
    assert audit(corpus([])).collect() == []
    rows = [("1 2 3", "en", "a"), (None, "en", "b"), ("", "fr", "a"), ("one", None, None), ("one", "", "a")]
    assert result(audit(corpus(rows), 1)) == brute(rows, 1)
    assert ("en", "a", "pair", "b", 0, 1) in result(audit(corpus(rows), 1))
    long = "Word " * 200_000
    rows = [(long, "en", "a"), (long, "en", "a"), ("x" * 1_000_000, "en", "b"), ("word x", "en", "b")]
    assert result(audit(corpus(rows), 1)) == brute(rows, 1)
