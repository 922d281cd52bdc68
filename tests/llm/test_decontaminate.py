import random

import pytest

from procura.llm import decontaminate as dc


def brute(docs, items, width, threshold):
    def grams(words, w):
        return {tuple(words[i:i + w]) for i in range(len(words) - w + 1)}
    out = []
    for doc, text in docs:
        words = dc.words_of(text or "")
        for item, t in items:
            own = dc.words_of(t or "")
            if own:
                w = min(width, len(own))
                s = grams(own, w)
                shared = len(s & grams(words, w))
                if shared >= threshold * len(s) - 1e-9:
                    out.append((doc, item, len(s), shared))
    return sorted(out, key=repr)


def fixture(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 8, 20, 45])))) for i in range(25)]
    items += [(90, None), (91, ""), (92, "!!"), (3, items[3][1]), (None, items[4][1])]
    docs = []
    for d in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 120))]
        own = (rng.choice(items)[1] or "").upper().split(" ")
        for _ in range(rng.choice([0, 0, 1, 3])):  # a damaged item in another shape
            own[rng.randrange(len(own))] = "other"
        at = rng.randint(0, len(words))
        docs.append((d, ", ".join(words[:at] + own + words[at:])))
    return docs + [(70, None), (71, ""), (5, docs[5][1]), (None, docs[6][1])], items


@pytest.mark.parametrize("threshold, block", [(0.8, 10 ** 9), (0.5, 200), (1.0, 10 ** 9)])
def test_against_all_pairs(spark, table, threshold, block):
    docs, items = fixture(int(threshold * 10))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = dc.find_items(table(docs).repartition(3), bench, 5, threshold, block).collect()
    assert sorted(((r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in got), key=repr) == brute(docs, items, 5, threshold)
    found = {d for d, *_ in brute(docs, items, 5, threshold)}
    left = dc.drop_contaminated(table(docs), bench, 5, threshold, block)
    assert left.columns == table(docs).columns
    assert {r.doc_id for r in left.collect()} == {d for d, _ in docs if d not in found}


def test_kept_values_leave_no_contained_item_out():
    for n in range(1, 200):
        for threshold in (0.5, 0.8, 0.9, 1.0):
            k = dc.kept_values(n, threshold)
            missing = max(m for m in range(n + 1) if n - m >= threshold * n - 1e-9)
            assert k == missing + 1


def test_empty_tables(spark, table):
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.find_items(table([]), none).collect() == []
    assert dc.find_items(table([(1, "a b c d e f")]), none).collect() == []
    assert dc.drop_contaminated(table([(1, "a b")]), none).count() == 1


def test_sql_against_all_pairs():
    """Short items and repeated rows included."""
    import duckdb
    import pyarrow as pa
    docs, items = fixture(8)
    con = duckdb.connect()
    for name, key, rows in (("documents", "doc_id", docs), ("benchmark", "item_id", items)):
        con.register(name, pa.table({key: pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string())}))
    got = con.execute(f"SELECT doc_id, item_id, n_shingles, n_shared FROM ({dc.SQL})").fetchall()
    assert sorted(got, key=repr) == brute(docs, items, 5, 0.8)
