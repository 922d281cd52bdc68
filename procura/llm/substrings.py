"""Removal of word runs that repeat from an earlier document.

A window is ``window`` (50) consecutive words of one document.  Words covered
by a window that also occurs in a document with a smaller id are removed.

Anchors: every document is cut into non-overlapping blocks of half a window,
and a window contains at least one whole block of any document it occurs in.
So the blocks of all documents are the index, and every rolling block-long run
of words probes it.  Extension: around each hit, in the probing document and
in the one the block is from, the windows that hold the hit are matched as a
whole; overlapping matched windows make up the maximal exact repeats.

Runs travel as packed hashes: one row per group of documents and bucket of the
hash range holds many runs (a few bytes a word), and a bucket is joined in one
task whose size ``BUCKET_BYTES`` of input sets.  Before they travel, the equal
runs of a group of documents are settled among themselves: all but those of the
group's smallest document have a smaller one beside them and are hits on the
spot, so a run that very many documents share is sent once or twice a group.
Settled runs meet nobody: they are dealt evenly, whatever their hash.
The anchor hashes may collide (32 bits and the bucket's): a false anchor only
costs a comparison of whole windows, by 128 bits (two rolling hashes).

Defined cases: null text has no words; a document with fewer words than a
window loses none; a null id neither loses words nor counts as smaller; rows
that share an id don't repeat from one another, each is judged by its own
words; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procura.llm.common import (_MULT, _arrow_schema, covered, hash_words, map_batches, per_process, read_table, stage,
                                texts_of, window_hashes, word_hasher)

WINDOW = 50
#: Input bytes (as the optimizer estimates them) whose runs meet in a bucket.
BUCKET_BYTES = 4_000_000
#: Words whose runs are packed together.
GROUP_WORDS = 500_000

PACKED = "bucket int, docs binary, counts binary, places binary, hashes binary"


def n_buckets(docs: DataFrame) -> int:
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return int(min(1 << 20, max(64, size // BUCKET_BYTES)))


def _pack(values: np.ndarray) -> bytes:
    """Unsigned numbers in the narrowest type that holds them."""
    top = int(values.max()) if len(values) else 0
    kind = next(k for k in (1, 2, 4, 8) if top < 1 << 8 * k)
    return bytes([kind]) + values.astype(f"<u{kind}").tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1)


def pack_runs(doc: np.ndarray, place: np.ndarray, hashes: np.ndarray, buckets: int, settled: bool = False) -> dict[str, list]:
    """Rows of ``PACKED`` for runs sorted by document.  The upper bits of the
    (first) hash give the bucket; its lower 32 bits travel, or both hashes of a
    run that has two.  Runs that are settled already get a bucket below 0, a
    different one in each group of documents."""
    both = hashes.ndim > 1
    sent, hashes = hashes, hashes[:, 0] if both else hashes
    bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    doc = np.asarray(doc, np.int64)
    shift = zlib.crc32(doc.tobytes()) if settled else 0
    out: dict[str, list] = {k: [] for k in ("bucket", "docs", "counts", "places", "hashes")}
    for i in np.split(order, edges[1:]) if len(order) else []:
        first = np.flatnonzero(np.r_[True, doc[i][1:] != doc[i][:-1]])
        ids = doc[i][first]
        out["bucket"].append(-1 - (int(bucket[i[0]]) + shift) % buckets if settled else int(bucket[i[0]]))
        out["docs"].append(int(ids[0]).to_bytes(8, "little", signed=True) + _pack(np.diff(ids).astype(np.uint64)))
        out["counts"].append(_pack(np.diff(np.r_[first, len(i)])))
        out["places"].append(_pack(place[i]))
        out["hashes"].append(sent[i].astype("<u8" if both else "<u4").tobytes())
    return out


def unpack_runs(table: pa.Table, both: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, place, hash) of all the runs in the rows of a bucket."""
    doc, place, hashes = [], [], []
    for docs, counts, places, raw in zip(*(table.column(c).to_pylist() for c in ("docs", "counts", "places", "hashes"))):
        step = _unpack(docs[8:]).astype(np.uint64).view(np.int64)
        ids = int.from_bytes(docs[:8], "little", signed=True) + np.r_[np.zeros(1, np.int64), np.cumsum(step)]
        doc.append(np.repeat(ids, _unpack(counts)))
        place.append(_unpack(places).astype(np.int64))
        hashes.append(np.frombuffer(raw, "<u8").reshape(-1, 2) if both else np.frombuffer(raw, "<u4"))
    return np.concatenate(doc), np.concatenate(place), np.concatenate(hashes)


def _word_groups(batches, hashes: dict):
    """Documents of the batches, sorted by id and about ``GROUP_WORDS`` words
    at a time: (ids, number of words, all their word hashes, extra column)."""
    for batch in batches:
        keep = np.flatnonzero(batch.column(0).is_valid().to_numpy(zero_copy_only=False))
        ids = batch.column(0).fill_null(0).to_numpy()
        keep = keep[np.argsort(ids[keep], kind="stable")]
        texts = batch.column(1)
        extra = batch.column(2) if batch.num_columns > 2 else None
        group, words = [], 0
        for k, i in enumerate(keep.tolist()):
            own = (texts[i].as_py() or "").encode().split()
            group.append((int(ids[i]), hash_words(own, hashes), extra[i].as_py() if extra is not None else None))
            words += len(own)
            if words >= GROUP_WORDS or k == len(keep) - 1:
                yield (np.array([g[0] for g in group], np.int64), np.array([len(g[1]) for g in group]),
                       np.concatenate([g[1] for g in group]), [g[2] for g in group])
                group, words = [], 0


def _rolled(sizes: np.ndarray, words: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the runs inside one document, with its number and place."""
    own = window_hashes(words, length)
    start = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(sizes)), sizes)[:len(own)]
    place = np.arange(len(own)) - start[doc]
    inside = place + length <= sizes[doc]
    return own[inside], doc[inside], place[inside]


def grouped(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal hashes (or pairs of hashes) together, stable,
    and where each group begins."""
    if hashes.ndim > 1:
        order = np.lexsort((hashes[:, 1], hashes[:, 0]))
        own = hashes[order]
        new = (own[1:] != own[:-1]).any(1)
    else:
        order = np.argsort(hashes, kind="stable")
        own = hashes[order]
        new = own[1:] != own[:-1]
    return order, np.flatnonzero(np.r_[True, new]) if len(order) else order


def settle(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Equal runs of a group of documents (sorted by id): the places in the
    arrays, grouped by hash, the group of each, and for each group whether it
    holds several documents; and which places belong to the smallest one."""
    order, first = grouped(hashes)
    group = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(order)]))
    smallest = doc[order] == doc[order][first][group]
    last = np.r_[first[1:], len(order)] - 1
    several = doc[order][last] != doc[order][first] if len(order) else np.zeros(0, bool)
    return order, group, several, smallest


def anchors(docs: DataFrame, window: int, buckets: int) -> DataFrame:
    """(doc_id, place) of block-long runs that a smaller document has, and of
    those that a larger document has, as far as one of the two is a block.
    Found within a group of documents, runs need not be blocks."""
    block = window // 2

    def probe(batches):
        hashes = per_process("word hashes", word_hasher)
        for ids, sizes, words, _ in _word_groups(batches, hashes):
            own, number, place = _rolled(sizes, words, block)
            doc = ids[number]
            order, group, several, smallest = settle(doc, own)
            shared = several[group]
            # settled here: the runs of all documents of a group of several
            here = np.sort(order[shared])
            yield pack_runs(doc[here], place[here], own[here], buckets, settled=True)
            # sent: those of the smallest document and one of the largest
            last = np.flatnonzero(np.r_[group[1:] != group[:-1], True]) if len(group) else group
            sent = np.sort(np.r_[order[smallest], order[last[several]]])
            yield pack_runs(doc[sent], place[sent], own[sent], buckets)
            # a block of any of them stands for the smallest document (place 0 is a block's)
            blocks = np.zeros(len(several), bool)
            np.logical_or.at(blocks, group[shared], place[order[shared]] % block == 0)
            first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else group
            mark = np.sort(order[first[blocks]])
            yield pack_runs(doc[mark], np.zeros(len(mark), np.int64), own[mark], buckets)

    out = _arrow_schema(docs.sparkSession, "doc_id long, place int")

    def meet(table: pa.Table) -> pa.Table:
        doc, place, own = unpack_runs(table)
        if table.column("bucket")[0].as_py() >= 0:
            order, first = grouped(own)
            doc, place = doc[order], place[order]
            size = np.diff(np.r_[first, len(own)])
            is_block = place % block == 0
            lowest = np.minimum.reduceat(np.where(is_block, doc, np.iinfo(np.int64).max), first)
            highest = np.maximum.reduceat(doc, first)
            hit = (doc > np.repeat(lowest, size)) | is_block & (doc < np.repeat(highest, size))
            doc, place = doc[hit], place[hit]
        return pa.Table.from_arrays([pa.array(doc), pa.array(place.astype(np.int32))], schema=out)

    return map_batches(docs, probe, PACKED).groupBy("bucket").applyInArrow(meet, "doc_id long, place int")


#: Multipliers of the second hash of a window, and of its halves' join.
_SECOND, _JOIN = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def _windows(words: np.ndarray, window: int) -> np.ndarray:
    """Two hashes (a row) of each whole window, both from those of its halves:
    of the words as they are and of a second product of each."""
    n = max(0, len(words) - window + 1)
    out = np.empty((n, 2), np.uint64)
    if n:
        second = (words ^ (words >> np.uint64(29))) * _SECOND
        for k, own in enumerate((words, second ^ (second >> np.uint64(32)))):
            half = window_hashes(own, window // 2)
            joined = half[:n] * (_MULT if k == 0 else _JOIN) + half[window - window // 2:][:n]
            out[:, k] = joined ^ (joined >> np.uint64(31))
    return out


FOUND = "doc_id long, place int, hash long, second long"


def repeats(docs: DataFrame, hits: DataFrame, window: int, buckets: int) -> DataFrame:
    """(doc_id, place, both hashes) of the windows around hits that occur in a
    smaller document."""
    block = window // 2
    found = docs.join(hits.groupBy("doc_id").agg(F.collect_set("place").alias("places")), "doc_id").select(
        "doc_id", "text", "places")

    def extend(batches):
        hashes = per_process("word hashes", word_hasher)
        for ids, sizes, words, places in _word_groups(batches, hashes):
            own, doc, place = [], [], []
            for k, end in enumerate(np.cumsum(sizes)):
                values = _windows(words[end - sizes[k]:end], window)
                mask = covered(np.maximum(np.array(places[k]) - (window - block), 0), window - block + 1, len(values))
                here = np.flatnonzero(mask)
                own.append(values[here])
                place.append(here)
                doc.append(np.full(len(here), ids[k]))
            own, doc, place = np.concatenate(own), np.concatenate(doc), np.concatenate(place)
            order, _, _, smallest = settle(doc, own)
            for chosen, settled in ((~smallest, True), (smallest, False)):
                i = np.sort(order[chosen])
                yield pack_runs(doc[i], place[i], own[i], buckets, settled)

    out = _arrow_schema(docs.sparkSession, FOUND)

    def meet(table: pa.Table) -> pa.Table:
        doc, place, own = unpack_runs(table, both=True)
        if table.column("bucket")[0].as_py() >= 0:
            order, first = grouped(own)
            doc, place, own = doc[order], place[order], own[order]
            hit = doc > np.repeat(np.minimum.reduceat(doc, first), np.diff(np.r_[first, len(own)]))
            doc, place, own = doc[hit], place[hit], own[hit]
        both = np.ascontiguousarray(own.T).view(np.int64)
        return pa.Table.from_arrays([pa.array(doc), pa.array(place.astype(np.int32)), *map(pa.array, both)], schema=out)

    return map_batches(found, extend, PACKED).groupBy("bucket").applyInArrow(meet, FOUND)


OUT = "doc_id long, n_words long, n_removed long, kept_text string"


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id`` and ``text`` -> the numbers of words and removed words and
    the kept words joined by one blank."""
    if window % 2:
        raise ValueError("the window must be even: its halves are the anchor blocks")
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    buckets = n_buckets(docs)
    hits = stage(anchors(docs, window, buckets), "anchors")
    found = stage(repeats(docs, hits, window, buckets), "repeats")
    gone = found.groupBy("doc_id").agg(F.collect_list(F.struct("place", "hash", "second")).alias("gone"))

    def run(batches):
        hashes = per_process("word hashes", word_hasher)
        for batch in batches:
            kept, n, removed = [], [], []
            for text, gone in zip(texts_of(batch.column(1)), batch.column(2)):
                words = text.encode().split()
                left = words
                if gone.is_valid:
                    place = gone.values.field("place").to_numpy()
                    value = np.stack([gone.values.field(c).to_numpy().view(np.uint64) for c in ("hash", "second")], 1)
                    own = _windows(hash_words(words, hashes), window)
                    there = place < len(own)
                    starts = place[there][(own[place[there]] == value[there]).all(1)]
                    mask = covered(starts, window, len(words))
                    left = [w for w, m in zip(words, mask.tolist()) if not m]
                n.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode())
            yield {"doc_id": batch.column(0), "n_words": n, "n_removed": removed, "kept_text": kept}

    return map_batches(docs.join(gone, "doc_id", "left").select("doc_id", "text", "gone"), run, OUT)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))



SQL = r"""
WITH w AS (SELECT doc_id, row_number() OVER () AS rid,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, rid, unnest(range(1, len(w) - 48)) AS p, w FROM w WHERE len(w) >= 50),
h AS (SELECT doc_id, rid, p, md5(array_to_string(w[p:p + 49], ' ')) AS h FROM win),
low AS (SELECT h, min(doc_id) AS low FROM h GROUP BY h),
gone AS (SELECT DISTINCT rid, unnest(range(p, p + 50)) AS i FROM h JOIN low USING (h) WHERE doc_id > low),
gl AS (SELECT rid, list(i) AS g FROM gone GROUP BY rid),
k AS (SELECT doc_id, w, list_filter(range(1, len(w) + 1), lambda i: g IS NULL OR NOT list_contains(g, i)) AS keep
      FROM w LEFT JOIN gl USING (rid))
SELECT doc_id, len(w) AS n_words, len(w) - len(keep) AS n_removed,
       sha256(coalesce(array_to_string(list_transform(keep, lambda i: w[i]), ' '), '')) AS kept_sha256
FROM k
"""
