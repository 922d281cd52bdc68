"""SimHash near-duplicates, paired by pivot distance tables.

A document's fingerprint has bit i set if more than half of its word shingles
have it set in their XXH64.  Copies collapse to one row per fingerprint before
any pairing.  Two fingerprints at ``d`` or fewer differing bits agree on at
least half of ``2 d`` bit blocks, so each fingerprint is dealt out once for
every choice of half of the blocks; fingerprints that meet are the only ones
compared.  Where they meet, a table of their Hamming distances to many
reference fingerprints is made once; a pair whose largest coordinate
difference exceeds ``d`` cannot be within ``d`` (triangle inequality) and is
discarded, the survivors are verified.  A fingerprint that a neighbour has
already reached is not compared again, so a dense group of n members yields at
most n - 1 links, not all its pairs.  Components are joined up on the cluster.

Defined cases: null or blank text has fingerprint zero, linked like any other;
rows that share an id are judged each by its own text; a null id never is the
smallest, its row gets the smallest id of its component (null if there is
none); an empty table gives no rows.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procura.llm.common import map_batches, read_table, stage, texts_of
from procura.llm.graph import components

SHINGLE_WORDS = 3
MAX_BITS = 3
#: Reference fingerprints whose distances make up the pivot table.
PIVOTS = 24
#: Fingerprints that may meet under one key before they are dealt out anew
#: under longer keys.
KEY_LIMIT = 65_536
#: Blocks of the longer keys.  A pair differs in at most ``max_bits`` of them, so
#: keys of all the others find every pair; at 3 bits they have 46 bits or more,
#: and at most 2^18 fingerprints can share one.
FINE_BLOCKS = 12


def fingerprint(text: str, words_per_shingle: int) -> int:
    """Unsigned 64-bit SimHash of a text."""
    import xxhash
    words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII blanks split
    if not words:
        return 0
    if len(words) < words_per_shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(words_per_shingle)), strict=False))
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=42), shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at:at + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id`` and ``text`` -> ``doc_id``, ``text_key`` (a hash of the
    text), ``fp`` (the signed long)."""
    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, words_per_shingle) for t in texts_of(batch.column(1))], np.uint64)
            yield {"doc_id": batch.column(0), "text_key": batch.column(2), "fp": fps.view(np.int64)}

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_key")), run,
                       "doc_id long, text_key long, fp long")


def _masks(blocks: int, keep: int) -> list[int]:
    """For every choice of ``keep`` of the bit blocks, the mask of their bits."""
    edges = np.linspace(0, 64, blocks + 1).round().astype(int).tolist()
    block = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(block, keep)]


def fine_blocks(bits: int) -> tuple[int, int]:
    """Blocks of the longer keys, and how many of them make one."""
    blocks = max(FINE_BLOCKS, 2 * bits + 2)
    return blocks, blocks - bits


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pivot_table(fps: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Hamming distances (one row per pivot) of the fingerprints to fixed
    pseudo-random reference fingerprints."""
    import xxhash
    refs = [np.uint64(xxhash.xxh64_intdigest(str(i).encode(), 1)) for i in range(pivots)]
    return np.stack([np.bitwise_count(fps ^ r) for r in refs]).astype(np.int8)


def link_group(fps: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links (index pairs) that join up all fingerprints within ``bits``."""
    table = pivot_table(fps)
    links, left = [], np.arange(len(fps))
    while len(left) > 1:
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            x = reached.pop()
            near = left
            for row in table:
                near = near[np.abs(row[near] - row[x]) <= bits]
                if len(near) < 2:
                    break
            near = near[np.bitwise_count(fps[near] ^ fps[x]) <= bits]
            if len(near):
                links += [(int(x), int(y)) for y in near]
                reached += near.tolist()
                left = np.setdiff1d(left, near, assume_unique=True)
    return links


def _links_by_key(bits: int, limit: int | None):
    """Arrow batches sorted by (table, key) -> links (a, b), and, marked
    ``over``, the members (a) of keys with more than ``limit``."""
    def emit(rows):
        a, b, over = zip(*rows) if rows else ((), (), ())
        return {"a": a, "b": b, "over": over}

    def linked(fps):
        return [(int(fps[i]), int(fps[j]), False) for i, j in link_group(fps.view(np.uint64), bits)]

    def run(batches):
        held = None  # the members of the key that the last batch ended with
        flooding = None
        for batch in batches:
            t, key, fp = (batch.column(c).to_numpy() for c in range(3))
            if held is not None:
                t, key, fp = (np.concatenate([x, y]) for x, y in zip(held, (t, key, fp)))
            starts = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (key[1:] != key[:-1])])
            ends, rows = np.r_[starts[1:], len(t)], []
            shared = np.flatnonzero(ends - starts > 1) if flooding is None else np.arange(len(starts))
            for s, e in zip(starts[shared], ends[shared]):
                if e == len(t):
                    break
                if flooding == (t[s], key[s]) or limit and e - s > limit:
                    rows += [(int(x), 0, True) for x in fp[s:e]]
                else:
                    rows += linked(fp[s:e])
            last = starts[-1]
            held = (t[last:], key[last:], fp[last:])
            if flooding != (t[last], key[last]):
                flooding = None
            if flooding or limit and len(held[0]) > limit:
                flooding = (t[last], key[last])
                rows += [(int(x), 0, True) for x in held[2]]
                held = None
            yield emit(rows)
        if held is not None:
            yield emit(linked(held[2]))

    return run


def _links(fps: DataFrame, bits: int, blocks: int, keep: int, limit: int | None) -> DataFrame:
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in _masks(blocks, keep)])
    dealt = (fps.select(F.posexplode(keys).alias("t", "key"), "fp")
             .repartition("t", "key").sortWithinPartitions("t", "key"))
    return map_batches(dealt, _links_by_key(bits, limit), "a long, b long, over boolean")


def near_duplicates(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id``, ``text_key``, ``fp`` (signed long), ``component_id`` and
    ``root`` (the component's smallest fingerprint) of every row."""
    prints = stage(fingerprints(docs, words_per_shingle), "prints")
    fps = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    if max_bits > 0:
        found = stage(_links(fps.select("fp"), max_bits, 2 * max_bits, max_bits, KEY_LIMIT), "links")
        links = found.filter("not over").select("a", "b")
        if found.filter("over").limit(1).count():
            again = found.filter("over").select(F.col("a").alias("fp")).distinct()
            links = links.union(_links(again, max_bits, *fine_blocks(max_bits), None).select("a", "b"))
        fps = fps.join(components(links), F.col("fp") == F.col("node"), "left").select(
            "fp", "low", F.coalesce("root", "fp").alias("root"))
    else:
        fps = fps.withColumn("root", F.col("fp"))
    lowest = fps.groupBy("root").agg(F.min("low").alias("component_id"))
    return prints.join(fps.join(lowest, "root").select("fp", "component_id", "root"), "fp")


def drop_near_duplicates(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS,
                         max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (of
    the smallest text hash if the id is repeated).  Where a component has null
    ids alone, nothing names its rows: one row of each text stays."""
    nameless = F.lit(-(1 << 63)).cast("long")
    found = near_duplicates(docs, words_per_shingle, max_bits)
    first = F.coalesce("doc_id", nameless)
    kept = (found.filter("doc_id <=> component_id")
            .groupBy("root", F.when(F.col("doc_id").isNull(), F.col("text_key")).alias("each"))
            .agg(F.min(first).alias("__id"), F.min("text_key").alias("__key")).select("__id", "__key"))
    keyed = docs.withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), nameless)).withColumn("__key", F.xxhash64("text"))
    return keyed.join(kept, ["__id", "__key"], "left_semi").dropDuplicates(["__id", "__key"]).select(*docs.columns)


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"), SHINGLE_WORDS, MAX_BITS)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
