import random

import numpy as np
import pytest
from procura.llm.lines import CuckooFilter, LineLedger, drop_repeated_lines

SPACE = " \t\n\x0b\x0c\r"


def brute(rows, min_chars=10):
    """rows of (doc_id, text) -> the same ids with (n_lines, n_dropped, kept text)."""
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))
    low = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None:
                low[key(line)] = min(doc, low.get(key(line), doc))
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if doc is None or len(key(x)) < min_chars or low[key(x)] == doc]
        out.append((doc, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=repr)


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


def random_rows(seed, n, docs=40):
    r = random.Random(seed)
    pool = ["a shared line of text %d" % k for k in range(12)] + ["short", "", "Ä long line with umlauts ÄÖ", "  A Shared line of TEXT 3\t"]
    return [(r.choice([None, *range(docs)]) if k % 9 == 0 else 100 + k,
             None if r.random() < .05 else "\n".join(r.choice([*pool, "own line number %d" % r.randrange(400)])
                                                     for _ in range(r.randrange(12)))) for k in range(n)]


@pytest.mark.parametrize("deliveries", [1, 3])
def test_against_brute_force(spark, table, deliveries):
    rows = random_rows(1, 120)
    assert result(drop_repeated_lines(table(rows), deliveries=deliveries)) == brute(rows)


def test_defined_cases(spark, table):
    assert drop_repeated_lines(table([])).collect() == []
    line = "0123456789"
    rows = [(5, None), (6, ""), (7, line + "\n" + line), (8, " " + line + "\r\nx"), (8, line), (None, line), (7, line),
            (9, "012345678"), (10, "012345678"), (11, "ééééééééé"), (12, "ééééééééé"), (13, "É" * 10), (14, "é" * 10), (15, "É" * 10)]
    got = result(drop_repeated_lines(table(rows)))
    assert got == brute(rows)
    assert (15, 1, 1, "") in got and (14, 1, 0, "é" * 10) in got and (7, 2, 0, line + "\n" + line) in got


def test_a_line_of_all_documents_and_a_long_text(spark, table):
    rows = [(k, "the one line that all share\nline of %d alone, long" % k) for k in range(3000)]
    rows.append((-1, "\n".join("a line that repeats within its text" for _ in range(50_000))))
    got = {r.doc_id: r for r in drop_repeated_lines(table(rows)).collect()}
    assert got[0].n_dropped == 0 and all(got[k].n_dropped == 1 for k in range(1, 3000))
    assert got[-1].n_dropped == 0 and got[-1].n_lines == 50_000


def test_deletions_bring_lines_back(spark, table, tmp):
    rows = [(d, t) for d, t in random_rows(2, 90, docs=5) if d is not None and d >= 100]
    ledger = LineLedger(spark, shards=4)
    first, second = rows[::2], rows[1::2]
    ledger.insert(table(first))
    ledger.insert(table(second))
    assert result(ledger.clean(table(rows))) == brute(rows)
    gone = {d for d, _ in rows[:30]}
    ledger.delete(spark.createDataFrame([(d,) for d in gone] + [(None,), (10 ** 9,)], "doc_id long"))
    left = [r for r in rows if r[0] not in gone]
    assert result(ledger.clean(table(left))) == brute(left)
    exact = {}
    for d, text in left:
        for k in {x for x in (text or "").split("\n")}:
            exact.setdefault(k, set()).add(d)
    # as if the deleted documents had never been there, filters included
    ledger.save(tmp + "/ledger")
    ledger = LineLedger.open(spark, tmp + "/ledger")
    assert ledger.filters.agg({"items": "sum"}).first()[0] == ledger.counts.count()
    back = [r for r in rows if r[0] in gone]
    ledger.insert(table(back))
    assert result(ledger.clean(table(rows))) == brute(rows)
    assert ledger.filters.agg({"items": "sum"}).first()[0] == ledger.counts.count()


def test_emptied_ledger(spark, table):
    rows = [(k, "a line that they all have") for k in range(6)]
    ledger = LineLedger(spark, shards=2)
    ledger.insert(table(rows))
    ledger.delete(table(rows).select("doc_id"))
    assert ledger.counts.count() == 0 and ledger.filters.agg({"items": "sum"}).first()[0] == 0
    ledger.insert(table(rows[3:]))
    assert result(ledger.clean(table(rows[3:]))) == brute(rows[3:])


def keys(n, seed):
    return np.random.default_rng(seed).integers(0, 1 << 63, (n, 2), dtype=np.uint64)


def test_cuckoo_filter():
    one = CuckooFilter.for_keys(20_000)
    mine, others = keys(20_000, 1), keys(100_000, 2)
    one.insert(mine[:12_000])
    one.insert(mine[12_000:])
    assert one.contains(mine).all() and one.items == 20_000
    assert one.contains(others).mean() < 0.001
    one.remove(mine[:15_000])
    again = CuckooFilter(0, one.to_bytes())
    assert again.items == 5_000 and again.contains(mine[15_000:]).all()
    assert again.contains(mine[:15_000]).mean() < 0.001


def test_cuckoo_filter_keeps_what_finds_no_place():
    small = CuckooFilter(16)
    mine = keys(300, 3)  # more than it has places
    small.insert(mine)
    assert small.contains(mine).all() and len(small.stash) > 200 and small.items == 300
    again = CuckooFilter(0, small.to_bytes())
    again.remove(mine[:250])
    assert again.contains(mine[250:]).all() and again.items == 50
    same = np.repeat(keys(1, 4), 20, axis=0)  # equal fingerprints fill both buckets
    small = CuckooFilter(64)
    small.insert(same)
    assert small.items == 20 and small.contains(same).all()
    small.remove(same[:19])
    assert small.contains(same).all()


def test_shards_get_more_room(spark, table):
    ledger = LineLedger(spark, shards=2)
    ledger.insert(table([(1, "a line that they all have")]))
    rows = [(k, "\n".join("line %d of document %d" % (j, k) for j in range(40))) for k in range(2, 60)]
    ledger.insert(table(rows))
    assert ledger.filters.agg({"items": "sum"}).first()[0] == ledger.counts.count() == 1 + 58 * 40
    rows.append((1, "a line that they all have"))
    assert result(ledger.clean(table(rows))) == brute(rows)
