"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item is contained in a document if at least ``threshold`` of its
distinct word shingles occur in it.  Items are partitioned by their number of
shingles (powers of two).  Of each item the index keeps the smallest shingle
hashes, its bottom MinHash values under one hash function: as many as the size
class needs so that a document that lacks all of them lacks more than
``1 - threshold`` of any item of the class.  Hence every contained item shares
a kept value with the document, however long that is, and no document needs a
sketch of its own: its shingle hashes are looked up in one pass.  Each pair
found this way is verified on the exact shingle sets.

The items are searched in blocks of bounded size (``BLOCK_CHARS`` of their
text), each a bounded broadcast; every block meets all documents.

Words are runs of letters and digits in lower case.  Defined cases: an item
with fewer words than a shingle has one shingle, all its words in sequence; an
item without words (or null) is never found; null or empty documents contain
nothing; repeated rows on either side are each reported.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procura.llm.common import hash_words, map_batches, per_process, read_table, texts_of, window_hashes, word_hasher

SHINGLE_WORDS = 5
THRESHOLD = 0.8
#: Characters of test items that are searched for at a time.
BLOCK_CHARS = 8_000_000

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def shingles(words: list[str], width: int) -> set[tuple[str, ...]]:
    return set(zip(*(words[i:] for i in range(width)), strict=False))


def kept_values(n: int, threshold: float) -> int:
    """How many of ``n`` shingles must be looked up to meet one of any
    ``threshold * n`` that a document has."""
    return n - math.ceil(threshold * n - 1e-9) + 1


class Index:
    """Items by shingle width and size class."""

    def __init__(self, items: list[tuple], width: int, threshold: float):
        self.threshold = threshold
        self.items = []  # (item id, shingle width, shingle set)
        kept: dict[int, dict[int, list[int]]] = {}  # width -> hash -> item numbers
        hashes = word_hasher()
        for item_id, text in items:
            words = words_of(text or "")
            if not words:
                continue
            w = min(width, len(words))
            own = window_hashes(hash_words([x.encode() for x in words], hashes), w)
            values, sets = np.unique(own), shingles(words, w)
            size_class = 1 << (len(sets) - 1).bit_length()
            for h in values[:kept_values(size_class, threshold)].tolist():
                kept.setdefault(w, {}).setdefault(h, []).append(len(self.items))
            self.items.append((item_id, w, sets))
        self.kept = {}
        for w, owners in kept.items():
            first = np.zeros(1 << 16, bool)  # whether any kept value begins with these bits
            first[np.array(list(owners), np.uint64) >> np.uint64(48)] = True
            self.kept[w] = (first, owners)

    def candidates(self, hashes: np.ndarray) -> set[int]:
        found = set()
        for w, (first, owners) in self.kept.items():
            own = window_hashes(hashes, w)
            for h in own[first[own >> np.uint64(48)]].tolist():
                found.update(owners.get(h, ()))
        return found

    def contained(self, text: str, hashes: dict) -> list[tuple]:
        """(item id, its shingles, those in the text) of each contained item."""
        words = words_of(text)
        found = self.candidates(hash_words([w.encode() for w in words], hashes))
        out, sets = [], {}
        for k in sorted(found):
            item_id, w, own = self.items[k]
            if w not in sets:
                sets[w] = shingles(words, w)
            shared = len(own & sets[w])
            if shared >= self.threshold * len(own) - 1e-9:
                out.append((item_id, len(own), shared))
        return out


OUT = "doc_id long, item_id long, n_shingles int, n_shared int, containment double"


def indexes(benchmark: DataFrame, width: int, threshold: float, block_chars: int) -> Iterator[Index]:
    """The items in blocks, each small enough to travel with a task function."""
    items = benchmark.select(F.col("item_id").cast("long"), "text")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield Index([tuple(r) for r in part.collect()], width, threshold)


def find_items(docs: DataFrame, benchmark: DataFrame, width: int = SHINGLE_WORDS, threshold: float = THRESHOLD,
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row for each test item contained in a document."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")

    def search(index: Index) -> DataFrame:
        def run(batches):
            hashes = per_process("alphanumeric word hashes", word_hasher)
            for batch in batches:
                rows = [(doc, *hit) for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)))
                        for hit in index.contained(text, hashes)]
                doc, item, n, shared = zip(*rows) if rows else ((), (), (), ())
                yield {"doc_id": doc, "item_id": item, "n_shingles": n, "n_shared": shared,
                       "containment": [s / k for s, k in zip(shared, n)]}

        return map_batches(docs, run, OUT)

    return reduce(DataFrame.union, map(search, indexes(benchmark, width, threshold, block_chars)))


def _is_clean(index: Index):
    @F.pandas_udf("boolean")
    def clean(text: pd.Series) -> pd.Series:
        hashes = per_process("alphanumeric word hashes", word_hasher)
        return pd.Series([not index.contained(t or "", hashes) for t in text], dtype=bool)

    return clean


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = SHINGLE_WORDS, threshold: float = THRESHOLD,
                      block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the rows that contain a test item."""
    for index in indexes(benchmark, width, threshold, block_chars):
        docs = docs.filter(_is_clean(index)("text"))
    return docs


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS drow, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
b AS (SELECT row_number() OVER () AS brow, item_id, w, least(5, len(w)) AS k
      FROM (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark) WHERE len(w) > 0),
ds AS (SELECT DISTINCT drow, doc_id, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS s
       FROM d, (SELECT DISTINCT k FROM b)),
bs AS (SELECT DISTINCT brow, item_id, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS s FROM b),
n AS (SELECT brow, count(*) AS n FROM bs GROUP BY brow)
SELECT any_value(ds.doc_id) AS doc_id, any_value(bs.item_id) AS item_id, any_value(n.n)::INTEGER AS n_shingles,
       count(*)::INTEGER AS n_shared, count(*)::DOUBLE / any_value(n.n) AS containment
FROM ds JOIN bs USING (k, s) JOIN n USING (brow)
GROUP BY drow, brow HAVING count(*) >= 0.8 * any_value(n.n) - 1e-9
"""
