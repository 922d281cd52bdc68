import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from procura.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def lower_bound(counts, capacity):
    return -(-sum(w * n for w, n in counts.items()) // capacity)


def exhaustive(items, capacity):
    """Fewest bins by trying every placement."""
    best = len(items)

    def go(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(items):
            best = len(bins)
            return
        for i in sorted(set(range(len(bins)))):
            if bins[i] >= items[k]:
                go(k + 1, bins[:i] + [bins[i] - items[k]] + bins[i + 1:])
        go(k + 1, bins + [capacity - items[k]])

    items = sorted(items, reverse=True)
    go(0, [])
    return best


def test_patterns_hold_every_item_once_and_equal_plain_best_fit():
    rng = random.Random(1)
    for _ in range(150):
        capacity = rng.choice([10, 20, 50])
        counts = Counter(rng.randint(1, capacity) for _ in range(rng.randint(1, 80)))
        packed = packing.pack_counts(counts, capacity)
        got = Counter()
        for sizes, times in packed:
            assert sum(sizes) <= capacity
            for w in sizes:
                got[w] += times
        assert got == counts
        rooms = []
        for w in sorted(counts.elements(), reverse=True):
            fit = [r for r in rooms if r >= w]
            if fit:
                rooms.remove(min(fit))
                rooms.append(min(fit) - w)
            else:
                rooms.append(capacity - w)
        assert sum(t for _, t in packing.best_fit(counts, capacity)) == len(rooms)


def test_fixed_bins_never_cost_a_bin():
    rng = random.Random(2)
    for _ in range(200):
        capacity = rng.choice([10, 14, 20])
        items = [rng.randint(2, capacity) for _ in range(rng.randint(1, 8))]
        fixed, rest = packing.reduce_instance(Counter(items), capacity)
        left = list(Counter(rest).elements())
        assert sum(t for _, t in fixed) + exhaustive(left, capacity) == exhaustive(items, capacity)


def check(rows, out, capacity):
    tok = Tokenizer.from_file(PATH)
    pieces = {}
    for r in out:
        pieces.setdefault(r.doc_id, []).append(r)
    want = Counter()
    for doc, text in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [0]
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(doc, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_pack_whole_table(spark, table):
    rng = random.Random(3)
    words = ["alpha", "it's", "naïve", "don't,", "x=1", "\tgap", "日本", "  ", "a\n\nb", "!!", "\x1c", "end."]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 5, 40, 300])))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "same text"), (202, "same text"), (203, "long word " * 4000), (204, "\n \n")]
    n = check(rows, packing.pack(table(rows).repartition(5), PATH, 256).collect(), 256)
    counts = Counter()
    tok = Tokenizer.from_file(PATH)
    for _, t in rows:
        ids = len(tok.encode(t or "", add_special_tokens=False).ids) + 1
        counts[(ids - 1) % 256 + 1] += 1
        counts[256] += (ids - 1) // 256
    assert n == sum(t for _, t in packing.pack_counts(counts, 256))
    assert n <= lower_bound(counts, 256) + 2


def test_null_id_and_empty_table(spark, table):
    assert packing.pack(table([]), PATH).collect() == []
    out = packing.pack(table([(None, "a b"), (1, None)]), PATH).collect()
    assert check([(None, "a b"), (1, None)], out, packing.CAPACITY) == 1


def test_long_white_space(spark):
    """Runs that overflow a recursive matcher give the ids of ``tokenizers``."""
    texts = ["x" + "\n" * 2_000_000 + "x", " " * 2_000_000 + "x", "a b  c" + " \n\t" * 400_000 + "z\r\n", "x" * 3000 + " " * 2500]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packing.pack(docs, PATH).collect())
    tokenizer = Tokenizer.from_file(PATH)
    want = []
    for i, text in enumerate(texts):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        cut = [(len(ids) - 1) % 2048 + 1]
        cut += [2048] * ((len(ids) - cut[0]) // 2048)
        at = 0
        for piece, size in enumerate(cut):
            want.append((i, piece, at, size, zlib.crc32(np.array(ids[at:at + size], "<u4").tobytes())))
            at += size
    assert out == want


def test_the_table_of_chunks_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(packing, "KEPT_BYTES", 50_000)
    ids = packing.ChunkIds(PATH)
    for k in range(20):
        ids.learn({f"{k}-{j}-" + "ab9" * 300 for j in range(20)})
        assert ids.bytes < 150_000 and len(ids) < 100


def test_a_worker_reads_a_batch_of_texts_in_parts(monkeypatch):
    import pyarrow as pa

    read, texts_of = [], packing.texts_of
    monkeypatch.setattr(packing, "texts_of", lambda column: read.append(len(column)) or texts_of(column))
    monkeypatch.setattr(packing.TaskContext, "get", staticmethod(lambda: type("Task", (), {"partitionId": lambda self: 0})()))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(1000)), "text": [f"text {i}" for i in range(999)] + [None]})
    out = [i for part in packing.piece_rows(PATH, 64)([batch]) for i in part["doc_id"]]
    assert out == list(range(1000)) and max(read) <= packing.TEXTS_AT_ONCE and sum(read) == 1000
