"""Reversible removal of lines that repeat between documents.

A line's key is the line without the white space at its ends, A-Z in lower
case; keys of under ``min_chars`` code points don't count.  Of the documents
that hold a key the one with the smallest id keeps its lines, the others lose
all of theirs.

:class:`LineLedger` keeps three tables, written under the checkpoint folder:

* postings: for each key and chunk of documents (a few Arrow batches of one
  task) the ids that hold it, so a line of very many documents is one row a chunk;
* reference counts: key, number of documents, smallest document, exact.  An
  insertion appends its own counts, a deletion counts the keys it met anew;
* one cuckoo filter for each shard of the key range (16-bit fingerprints, four
  to a bucket, a stash for those that find no place) over the keys that have a
  reference.

An insertion probes the filter of each key's shard.  A key that the filter
does not know is new, and if one document alone brings it, nothing is looked
up.  Only the other keys, the suspects, are counted in the exact table; what
the filter took for another key falls out there.  A key whose last document is
deleted leaves its filter, so the filters need no rebuild; when a shard gets
too full, all are laid out anew from the counts.

A key is the 128-bit BLAKE2b of its bytes.  A shard has about ``SHARD_BYTES``
of input, whatever the table's size; a filter, or a shard's keys of one
insertion, are what a task holds.  Counts are aggregated before the shuffle; the
joins are on the key or the id alone, which adaptive execution splits if hot.

Defined cases: a null or empty text is one empty line; a null id neither loses
lines nor holds a key; rows that share an id are one holder, each is judged by
its own lines (they add to the count once per chunk); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procura.llm.common import _arrow_schema, map_batches, read_table, stage, texts_of

MIN_CHARS = 10
#: Input bytes (as the optimizer estimates them) a shard of the key range stands for.
SHARD_BYTES = 32_000_000
#: Insertions in which ``op12`` brings the documents.
DELIVERIES = 2
#: Characters of text whose postings are put together (a chunk of a task).
CHUNK_CHARS = 8_000_000

SPACE = " \t\n\x0b\x0c\r"
SLOTS, FILL, ROUNDS = 4, 0.8, 200

COUNTS = "shard int, key binary, n long, low long"
POSTINGS = COUNTS + ", docs array<long>"


def line_key(line: str, min_chars: int) -> bytes | None:
    """16 bytes that stand for the line's key; None if the key is too short."""
    line = line.strip(SPACE)
    if len(line) < min_chars:
        return None
    return hashlib.blake2b(line.encode().lower(), digest_size=16).digest()  # bytes.lower: A-Z alone


class CuckooFilter:
    """Set of 16-byte keys with deletion; no false negatives.  Keys come as an
    array of two 64-bit numbers each; a key must be inserted once."""

    def __init__(self, buckets: int, raw: bytes | None = None):
        if raw is None:
            self.table, self.stash = np.zeros((buckets, SLOTS), np.uint16), np.empty(0, np.uint64)
        else:
            m = int.from_bytes(raw[:8], "little")
            end = 8 + 2 * SLOTS * m
            self.table = np.frombuffer(raw[8:end], "<u2").reshape(m, SLOTS).copy()
            self.stash = np.frombuffer(raw[end:], "<u8").copy()

    @staticmethod
    def for_keys(n: int) -> CuckooFilter:
        """Room for twice ``n`` keys below the fill that insertion takes."""
        return CuckooFilter(1 << max(4, int(2 * n / (SLOTS * FILL))).bit_length())

    def to_bytes(self) -> bytes:
        return (len(self.table).to_bytes(8, "little") + self.table.astype("<u2").tobytes()
                + self.stash.astype("<u8").tobytes())

    @property
    def items(self) -> int:
        return int(np.count_nonzero(self.table)) + len(self.stash)

    @property
    def capacity(self) -> int:
        return int(self.table.size * FILL)

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return bucket ^ ((mark.astype(np.uint64) * np.uint64(0x9E3779B1)) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _place(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mark = (keys[:, 1] & np.uint64(0xFFFF)).astype(np.uint16)
        mark[mark == 0] = 1
        first = (keys[:, 0] & np.uint64(len(self.table) - 1)).astype(np.int64)
        return mark, first, self._other(first, mark)

    def _code(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """A stashed item: the lesser of its buckets and its fingerprint."""
        low = np.minimum(bucket, self._other(bucket, mark))
        return low.astype(np.uint64) << np.uint64(16) | mark.astype(np.uint64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        mark, one, two = self._place(keys)
        found = (self.table[one] == mark[:, None]).any(1) | (self.table[two] == mark[:, None]).any(1)
        return found | np.isin(self._code(mark, one), self.stash) if len(self.stash) else found

    def insert(self, keys: np.ndarray) -> None:
        """All pending items move at once: as many as a bucket has room for are
        placed, each full bucket lets one of the others push an item out."""
        mark, bucket, _ = self._place(keys)
        for k in range(ROUNDS):
            if not len(mark):
                return
            order = np.argsort(bucket, kind="stable")
            mark, bucket = mark[order], bucket[order]
            first = np.r_[True, bucket[1:] != bucket[:-1]]
            rank = np.arange(len(bucket)) - np.flatnonzero(first)[np.cumsum(first) - 1]
            free = self.table[bucket] == 0
            room = free.sum(1)
            fits = rank < room
            slot = np.argsort(~free[fits], axis=1, kind="stable")[np.arange(fits.sum()), rank[fits]]
            self.table[bucket[fits], slot] = mark[fits]
            pushes = ~fits & (rank == room) & (k % 2 == 1)
            at, victim = bucket[pushes], (bucket[pushes] + k // 2) % SLOTS
            out = self.table[at, victim]
            self.table[at, victim] = mark[pushes]
            mark = np.r_[mark[~fits & ~pushes], out]
            bucket = np.r_[bucket[~fits & ~pushes], at]
            bucket = self._other(bucket, mark)
        self.stash = np.r_[self.stash, self._code(mark, bucket)]

    def remove(self, keys: np.ndarray) -> None:
        """Take out keys that were inserted, one fingerprint for each."""
        for mark, one, two, code in zip(*self._place(keys), self._code(*self._place(keys)[:2])):
            for bucket in (one, two):
                at = np.flatnonzero(self.table[bucket] == mark)
                if len(at):
                    self.table[bucket, at[0]] = 0
                    break
            else:
                at = np.flatnonzero(self.stash == code)[:1]
                self.stash = np.delete(self.stash, at)


def _numbers(keys: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(keys.to_pylist()), "<u8").reshape(-1, 2)


class LineLedger:
    """Which lines of which documents repeat, kept through insertions and deletions."""

    def __init__(self, spark: SparkSession, shards: int = 64, min_chars: int = MIN_CHARS):
        self.spark, self.shards, self.min_chars = spark, shards, min_chars
        self.generation = 0
        self.postings = spark.createDataFrame([], POSTINGS + ", generation int")
        self.deleted = spark.createDataFrame([], "doc_id long, generation int")
        self.counted = spark.createDataFrame([], COUNTS)
        self.suspects = spark.createDataFrame([], "shard int, key binary")
        self.filters = spark.createDataFrame([], "shard int, raw binary, items long, capacity long")

    # -- state ------------------------------------------------------------

    TABLES = ("postings", "deleted", "counted", "suspects", "filters")

    def save(self, folder: str) -> None:
        """Write the ledger; ``folder`` must be new."""
        for name in self.TABLES:
            getattr(self, name).write.parquet(f"{folder}/{name}")
        self.spark.createDataFrame([(self.generation, self.shards, self.min_chars)],
                                   "generation int, shards int, min_chars int").write.parquet(f"{folder}/ledger")

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> LineLedger:
        head = spark.read.parquet(f"{folder}/ledger").first()
        ledger = cls(spark, head.shards, head.min_chars)
        ledger.generation = head.generation
        for name in cls.TABLES:
            schema = getattr(ledger, name).schema
            setattr(ledger, name, spark.read.schema(schema).parquet(f"{folder}/{name}"))
        return ledger

    @property
    def counts(self) -> DataFrame:
        """Exact reference counts, one row per key: ``n`` documents, the
        smallest is ``low``."""
        return self.counted.groupBy("shard", "key").agg(F.sum("n").alias("n"), F.min("low").alias("low"))

    # -- insertion --------------------------------------------------------

    def _keyed(self, docs: DataFrame) -> DataFrame:
        shards, min_chars = self.shards, self.min_chars

        def run(batches):
            chunk, chars = [], 0

            def rows():
                held: dict[bytes, list[int]] = {}
                for doc, text in sorted(chunk):
                    for key in {line_key(line, min_chars) for line in text.split("\n")} - {None}:
                        ids = held.setdefault(key, [])
                        if not ids or ids[-1] != doc:
                            ids.append(doc)
                keys, ids = list(held), list(held.values())
                return {"shard": [int.from_bytes(k[12:], "little") % shards for k in keys], "key": keys,
                        "n": [len(i) for i in ids], "low": [i[0] for i in ids], "docs": ids}

            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                    chunk.append((doc, text))
                    chars += len(text)
                    if chars >= CHUNK_CHARS:
                        yield rows()
                        chunk, chars = [], 0
            if chunk:
                yield rows()

        return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                           .filter("doc_id is not null"), run, POSTINGS)

    def insert(self, docs: DataFrame) -> None:
        """Add documents (``doc_id``, ``text``) that the ledger does not hold."""
        self.generation += 1
        new = stage(self._keyed(docs), "line-postings")
        counts = stage(new.groupBy("shard", "key").agg(F.sum("n").alias("n"), F.min("low").alias("low")), "line-counts")
        probed = stage(self._probe(counts), "line-probes")
        known = probed.filter("seen").select("shard", "key")
        unknown = known.join(self.counted, ["shard", "key"], "left_anti").union(
            probed.filter("not seen").select("shard", "key"))
        self._enter(stage(unknown, "line-new-keys"))
        self.suspects = self.suspects.union(stage(probed.filter("seen or n > 1").select("shard", "key"), "line-suspects"))
        self.counted = self.counted.unionByName(counts)
        self.postings = self.postings.unionByName(new.withColumn("generation", F.lit(self.generation)))

    def _probe(self, counts: DataFrame) -> DataFrame:
        """``counts`` with ``seen``: the filter of the shard knows the key."""
        out = _arrow_schema(self.spark, COUNTS + ", seen boolean")

        def probe(filters: pa.Table, rows: pa.Table) -> pa.Table:
            if not filters.num_rows or not rows.num_rows:
                seen = np.zeros(rows.num_rows, bool)
            else:
                seen = CuckooFilter(0, filters.column("raw")[0].as_py()).contains(_numbers(rows.column("key")))
            return rows.append_column("seen", pa.array(seen)).cast(out)

        rows = counts.select("shard", "key", "n", "low")
        return self.filters.groupBy("shard").cogroup(rows.groupBy("shard")).applyInArrow(probe, COUNTS + ", seen boolean")

    def _enter(self, keys: DataFrame) -> None:
        """Put new keys into the filters, laid out anew if one gets too full."""
        fill = (keys.groupBy("shard").agg(F.count("*").alias("more")).join(self.filters, "shard", "left")
                .agg(F.max(F.when(F.expr("items + more <= capacity"), 0).otherwise(1))).first()[0])
        if fill:
            keys = self.counted.select("shard", "key").distinct().union(keys)
            self.filters = self.filters.limit(0)
        self.filters = self._change(keys, CuckooFilter.insert)

    def _change(self, keys: DataFrame, change) -> DataFrame:
        out = _arrow_schema(self.spark, "shard int, raw binary, items long, capacity long")

        def run(filters: pa.Table, rows: pa.Table) -> pa.Table:
            if filters.num_rows:
                one = CuckooFilter(0, filters.column("raw")[0].as_py())
            else:
                one = CuckooFilter.for_keys(rows.num_rows)
            if rows.num_rows:
                change(one, _numbers(rows.column("key")))
            shard = (filters if filters.num_rows else rows).column("shard")[0].as_py()
            return pa.Table.from_pydict({"shard": [shard], "raw": [one.to_bytes()], "items": [one.items],
                                         "capacity": [one.capacity]}, schema=out)

        return stage(self.filters.groupBy("shard").cogroup(keys.groupBy("shard")).applyInArrow(
            run, "shard int, raw binary, items long, capacity long"), "line-filters")

    # -- deletion ---------------------------------------------------------

    def _holders(self) -> DataFrame:
        """(shard, key, doc_id) of the documents that are in the ledger now."""
        rows = self.postings.select("shard", "key", "generation", F.explode("docs").alias("doc_id"))
        gone = self.deleted.groupBy("doc_id").agg(F.max("generation").alias("until"))
        return rows.join(gone, "doc_id", "left").filter("until is null or generation > until").select(
            "shard", "key", "doc_id")

    def delete(self, ids: DataFrame) -> None:
        """Take documents (``doc_id``) out; lines that only they made repeat come back."""
        ids = stage(ids.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id is not null").distinct(),
                    "line-deletions")
        met = stage(self._holders().join(ids, "doc_id", "left_semi").select("shard", "key").distinct(), "line-met")
        before = self.counts
        self.generation += 1
        self.deleted = self.deleted.union(ids.withColumn("generation", F.lit(self.generation)))
        left = stage(self._holders().join(met, ["shard", "key"], "left_semi").groupBy("shard", "key").agg(
            F.count("*").alias("n"), F.min("doc_id").alias("low")), "line-recounts")
        self.counted = stage(before.join(met, ["shard", "key"], "left_anti").unionByName(left), "line-counts")
        gone = met.join(left, ["shard", "key"], "left_anti")
        self.filters = self._change(gone, CuckooFilter.remove)

    # -- reading ----------------------------------------------------------

    def repeated(self) -> DataFrame:
        """(key, low) of the keys that several documents hold."""
        some = self.suspects.distinct()
        return self.counted.join(some, ["shard", "key"], "left_semi").groupBy("shard", "key").agg(
            F.sum("n").alias("n"), F.min("low").alias("low")).filter("n > 1").select("shard", "key", "low")

    def lost_lines(self) -> DataFrame:
        """(doc_id, keys): the keys whose lines a document loses.  A deleted
        document has none, whether it is read again or not."""
        rows = (self.postings.drop("n", "low").join(self.repeated(), ["shard", "key"])
                .select("key", "generation", F.explode(F.expr("filter(docs, d -> d > low)")).alias("doc_id")))
        if self.deleted.limit(1).count():
            gone = self.deleted.groupBy("doc_id").agg(F.max("generation").alias("until"))
            rows = rows.join(gone, "doc_id", "left").filter("until is null or generation > until")
        return rows.groupBy("doc_id").agg(F.collect_set("key").alias("keys"))

    def clean(self, docs: DataFrame) -> DataFrame:
        """``doc_id``, ``n_lines``, ``n_dropped`` and ``kept_text`` of documents of the ledger."""
        min_chars = self.min_chars

        def run(batches):
            for batch in batches:
                kept, n, dropped = [], [], []
                for text, keys in zip(texts_of(batch.column(1)), batch.column(2).to_pylist()):
                    lines = left = text.split("\n")
                    if keys:
                        gone = set(keys)
                        left = [line for line in lines if line_key(line, min_chars) not in gone]
                    n.append(len(lines))
                    dropped.append(len(lines) - len(left))
                    kept.append("\n".join(left))
                yield {"doc_id": batch.column(0), "n_lines": n, "n_dropped": dropped, "kept_text": kept}

        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        return map_batches(docs.join(self.lost_lines(), "doc_id", "left").select("doc_id", "text", "keys"), run,
                           "doc_id long, n_lines long, n_dropped long, kept_text string")


def n_shards(docs: DataFrame) -> int:
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return int(min(1 << 20, max(16, size // SHARD_BYTES)))


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, deliveries: int = DELIVERIES) -> DataFrame:
    """All of ``docs`` brought into a new ledger in some deliveries and cleaned by it."""
    docs = docs.select("doc_id", "text")
    ledger = LineLedger(docs.sparkSession, n_shards(docs), min_chars)
    part = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(deliveries))
    for k in range(deliveries):
        ledger.insert(docs.filter(part == k))
    return ledger.clean(docs)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_repeated_lines(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT rid, doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
low AS (SELECT key, min(doc_id) AS low FROM k WHERE length(key) >= 10 GROUP BY key),
m AS (SELECT k.*, coalesce(length(k.key) >= 10 AND k.doc_id > low.low, false) AS gone FROM k LEFT JOIN low USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid, doc_id
"""
