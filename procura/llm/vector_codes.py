"""Vectors as codes of sixteen bytes, by codebooks from ball k-means.

Components become integers (floor of 256 x), vectors are cut into 16 parts, and
every part position has a codebook of at most 64 entries.  A round assigns each
part to the nearest entry and moves every entry to the floor of its parts' mean;
all arithmetic is exact.

After the first assignment an entry is the centre of a ball: its radius is the
largest distance of the parts that were last assigned to it (of one batch of
rows) to the moved entry.  Another entry is a neighbour only if the gap between
the two is at most twice the radius; parts within half the gap to the
nearest neighbour are the stable core and skip all work.  The neighbours'
half gaps cut the rest of the ball into rings, and a part in a ring meets only
the neighbours whose half gap it reaches: the others are provably farther.  The
nearest entry, ties to the lower index, is so found exactly.

Assignments are written after every round, with the sums of each task, which
Spark adds up.  The driver holds the codebooks alone (64 vectors).

Defined cases: vectors that are null, or have a null or non-finite component,
are dropped, as are those whose length is not that of the first kept one (by
id); if that length is no multiple of 16 the last parts are filled with zeros;
fewer than 64 rows give fewer entries; equal ids are ordered by the vector,
null ids come last, and such rows count as any other; without kept rows the
result is empty.  Numbers too large for 64 bits are computed as Python integers;
an ``error`` or ``label_error`` that is no long is null.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procura.llm.common import _arrow_schema, map_batches, read_table, stage

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Rows whose parts are assigned together; they share the balls' radii.
BLOCK_ROWS = 20_000
LONG = 1 << 63


def pack(v: np.ndarray) -> bytes:
    """A vector of integers, 2 or 4 bytes each, or as text if one needs more."""
    top = max((abs(int(x)) for x in (v.max(), v.min())), default=0) if len(v) else 0
    kind = 2 if top < 1 << 15 else 4 if top < 1 << 31 else 0
    return bytes([kind]) + (v.astype(f"<i{kind}").tobytes() if kind else ",".join(map(str, v)).encode())


def unpack(rows: list[bytes]) -> np.ndarray:
    """Matrix of packed vectors of one length, 64-bit or of Python integers."""
    kinds = {r[0] for r in rows}
    if len(kinds) == 1 and 0 not in kinds:
        kind = kinds.pop()
        width = (len(rows[0]) - 1) // kind
        return np.frombuffer(b"".join(r[1:] for r in rows), f"<i{kind}").reshape(len(rows), width).astype(np.int64)
    every = [np.frombuffer(r, f"<i{r[0]}", offset=1).astype(object) if r[0] else
             np.array([int(x) for x in r[1:].split(b",")], object) for r in rows]
    return np.array([[int(x) for x in v] for v in every], object if 0 in kinds else np.int64)


def _safe(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as Python integers unless distances times the entries fit 64 bits."""
    if parts.dtype != object and book.dtype != object and parts.size and parts.shape[1]:
        top = max(int(np.abs(parts).max()), int(np.abs(book).max()))
        if parts.shape[1] * 4 * (2 * top) ** 2 * len(book) < LONG:
            return parts, book
    return parts.astype(object), book.astype(object)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return (d * d).sum(-1)


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry, ties to the lower, and its squared distance."""
    parts, book = _safe(parts, book)
    every = np.stack([_squares(parts, entry) for entry in book], 1)
    code = every.argmin(1)
    return code, every[np.arange(len(parts)), code]


def nearest_from(parts: np.ndarray, book: np.ndarray, last: np.ndarray, met: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The same by balls around the entries of the ``last`` assignment.
    ``met`` takes the number of distances that were needed beyond the own."""
    parts, book = _safe(parts, book)
    gaps = np.stack([_squares(book, entry) for entry in book])
    own = _squares(parts, book[last])
    rows, entries = [], []
    for a in np.unique(last):
        members = np.flatnonzero(last == a)
        radius = own[members].max()
        around = np.argsort(gaps[a], kind="stable")
        around = around[(around != a) & (gaps[a][around] <= 4 * radius)]
        # how many neighbours each member's ring reaches; none in the stable core
        ring = np.searchsorted(gaps[a][around], 4 * own[members], side="right")
        rows.append(np.repeat(members, ring))
        entries.append(around[np.arange(ring.sum()) - np.repeat(np.cumsum(ring) - ring, ring)])
    row, entry = np.concatenate(rows), np.concatenate(entries)
    if met is not None:
        met.append(len(row))
    k = len(book)
    best = own * k + last
    if len(row):
        order = np.argsort(row, kind="stable")
        row, entry = row[order], entry[order]
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        rival = np.minimum.reduceat(_squares(parts[row], book[entry]) * k + entry, first)
        best[row[first]] = np.minimum(best[row[first]], rival)
    return (best % k).astype(np.int64), best // k


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vec, size): kept vectors as packed integers."""
    label = vectors.schema["label"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            lists = batch.column(2)
            flat = lists.flatten()
            good = flat.is_valid().to_numpy(zero_copy_only=False)
            x = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
            good &= np.isfinite(x)
            sizes = lists.value_lengths().fill_null(0).to_numpy()
            end = np.cumsum(sizes)
            bad = np.r_[0, np.cumsum(~good)]
            kept = lists.is_valid().to_numpy(zero_copy_only=False) & (bad[end] == bad[end - sizes])
            rows = np.flatnonzero(kept)
            small = np.abs(x) < 2.0 ** 40
            scaled = np.floor(np.where(good & small, x, 0) * SCALE).astype(np.int64)
            vec = []
            for i in rows:
                at = slice(end[i] - sizes[i], end[i])
                v = scaled[at]
                if not small[at].all():
                    # doubles of that size times a power of two: exact as long as finite
                    v = np.array([math.floor(y * SCALE) if abs(y) < 1e300 else int(y) * SCALE for y in x[at].tolist()], object)
                vec.append(pack(v))
            keep = pa.array(rows)
            yield {"vec_id": batch.column(0).take(keep), "label": batch.column(1).take(keep), "vec": vec, "size": sizes[rows]}

    return map_batches(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label",
                                      F.col("embedding").cast("array<double>").alias("embedding")),
                       run, f"vec_id long, label {label}, vec binary, size int")


def cut(vectors: np.ndarray, parts: int = PARTS) -> np.ndarray:
    """(rows, parts, width), filled up with zeros."""
    width = -(-vectors.shape[1] // parts)
    full = np.zeros((len(vectors), parts * width), vectors.dtype)
    full[:, :vectors.shape[1]] = vectors
    return full.reshape(len(vectors), parts, width)


def assign(vectors: DataFrame, books: list[np.ndarray], sums: bool) -> DataFrame:
    """Every vector with the codes and the summed distance under ``books``;
    with ``sums`` also rows (part, entry, total, n) of each task."""
    label = vectors.schema["label"].dataType.simpleString()
    first = "codes" not in vectors.columns
    rows = vectors.select("vec_id", "label", "vec", F.lit(None).cast("binary").alias("codes") if first else "codes")
    schema = f"vec_id long, label {label}, vec binary, codes binary, error long, part int, entry int, total binary, n long"

    def run(batches):
        added: dict[tuple[int, int], list] = {}
        for batch in _blocks(batches):
            vec = batch.column(2).to_pylist()
            pieces = cut(unpack(vec), len(books))
            last = None if first else np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(len(vec), -1)
            codes, error = np.empty((len(vec), len(books)), np.uint8), 0
            for p, book in enumerate(books):
                part = np.ascontiguousarray(pieces[:, p])
                code, far = nearest(part, book) if first else nearest_from(part, book, last[:, p].astype(np.int64))
                codes[:, p] = code
                error = error + far.astype(object)
                if sums:
                    for entry in np.unique(code):
                        mine = part[code == entry]
                        total = added.setdefault((p, int(entry)), [0, [0] * part.shape[1]])
                        total[0] += len(mine)
                        total[1] = [a + int(b) for a, b in zip(total[1], mine.sum(0))]
            none = [None] * len(vec)
            yield {"vec_id": batch.column(0), "label": batch.column(1), "vec": vec, "codes": [c.tobytes() for c in codes],
                   "error": [int(e) if e < LONG else None for e in error], "part": none, "entry": none, "total": none, "n": none}
        none = [None] * len(added)
        if added:
            yield {"vec_id": none, "label": none, "vec": none, "codes": none, "error": none, "part": [k[0] for k in added],
                   "entry": [k[1] for k in added], "total": [_text(t) for _, t in added.values()],
                   "n": [n for n, _ in added.values()]}

    return map_batches(rows, run, schema)


def _blocks(batches):
    """Record batches joined to about ``BLOCK_ROWS`` rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= BLOCK_ROWS:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _text(numbers: list[int]) -> bytes:
    return ",".join(map(str, numbers)).encode()


def _read(text: bytes) -> list[int]:
    return [int(x) for x in text.split(b",")] if text else []


def moved(books: list[np.ndarray], assigned: DataFrame) -> list[np.ndarray]:
    """The codebooks after a round: each used entry at the floor of the mean."""
    out = _arrow_schema(assigned.sparkSession, "part int, entry int, total binary")

    def mean(t: pa.Table) -> pa.Table:
        total, n = None, sum(t.column("n").to_pylist())
        for row in t.column("total").to_pylist():
            total = _read(row) if total is None else [a + b for a, b in zip(total, _read(row))]
        return pa.Table.from_pydict({"part": t.column("part")[:1], "entry": t.column("entry")[:1],
                                     "total": [_text([x // n for x in total])]}, schema=out)

    used = (assigned.filter("part is not null").select("part", "entry", "total", "n")
            .groupBy("part", "entry").applyInArrow(mean, "part int, entry int, total binary").collect())
    lists = [[[int(x) for x in entry] for entry in book] for book in books]
    for r in used:  # at most a row per part and entry
        lists[r.part][r.entry] = _read(r.total)
    return [_book(b) for b in lists]


def _book(entries: list[list[int]]) -> np.ndarray:
    big = any(abs(x) >= 1 << 62 for e in entries for x in e)
    return np.array(entries, object if big else np.int64).reshape(len(entries), -1)


def first_entries(vectors: DataFrame, parts: int, entries: int) -> tuple[int, list[np.ndarray]]:
    """The vectors' length and the codebooks of the smallest ids."""
    ordered = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vec")
    rows = ordered.limit(entries).collect()
    if not rows:
        return 0, []
    size = rows[0].size
    if any(r.size != size for r in rows):
        rows = ordered.filter(F.col("size") == size).limit(entries).collect()
    pieces = cut(unpack([r.vec for r in rows]), parts)
    return size, [_book([[int(x) for x in row] for row in pieces[:, p]]) for p in range(parts)]


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """``vec_id``, ``embedding`` and ``label`` -> (vec_id, label, codes, error) and the codebooks."""
    if not 0 < entries <= 256:
        raise ValueError("codes are bytes: 1 to 256 entries")
    state = stage(integer_vectors(vectors), "vectors")
    size, books = first_entries(state, parts, entries)
    state = state.filter(F.col("size") == size)
    if not books:
        return assign(state, [np.zeros((1, 1), np.int64)] * parts, False).select("vec_id", "label", "codes", "error"), books
    for _ in range(rounds):
        written = stage(assign(state, books, True), "assigned")
        books = moved(books, written)
        state = written.filter("part is null")
    return assign(state, books, False).select("vec_id", "label", "codes", "error"), books


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for book in books for entry in book for x in entry).encode()).hexdigest()


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(read_table(spark, sf_dir, "embeddings"))
    coded = stage(coded, "codes")
    by_label = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("sum"))
    of = by_label.select(F.col("label").alias("of_label"), F.expr("try_cast(sum as bigint)").alias("label_error"))
    return coded.join(of, coded.label.eqNullSafe(of.of_label), "left").select(
        "vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _round_sql(k: int) -> str:
    """Assignment to codebook ``k`` and the codebook after it."""
    return f"""
a{k} AS MATERIALIZED (
  SELECT rn, p.part, arg_min(e, (xx - 2 * list_inner_product(x, c) + cc) * 64 + e) AS e,
         min(xx - 2 * list_inner_product(x, c) + cc) AS dist
  FROM p JOIN b{k} USING (part) GROUP BY rn, p.part),
m{k} AS (SELECT part, e, i, floor(sum(x[i]) / count(*)) AS c
         FROM a{k} JOIN p USING (rn, part), unnest(range(1, 5)) AS t(i) GROUP BY part, e, i),
b{k + 1} AS MATERIALIZED (
  SELECT part, e, c, list_inner_product(c, c) AS cc
  FROM (SELECT part, e, coalesce(n.c, o.c) AS c FROM b{k} o
        LEFT JOIN (SELECT part, e, list(c ORDER BY i) AS c FROM m{k} GROUP BY part, e) n USING (part, e))),"""


#: For vectors of 64 components.
SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rn, vec_id, label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (
  SELECT rn, part, v[4 * part + 1:4 * part + 4] AS x, list_inner_product(v[4 * part + 1:4 * part + 4], v[4 * part + 1:4 * part + 4]) AS xx
  FROM kept, unnest(range(0, 16)) AS t(part)),
b0 AS MATERIALIZED (SELECT part, rn - 1 AS e, x AS c, xx AS cc FROM p WHERE rn <= 64),
{"".join(_round_sql(k) for k in range(3))}
h AS (SELECT sha256(string_agg(c[i]::BIGINT::VARCHAR, ',' ORDER BY part, e, i)) AS codebooks_sha256
      FROM b2, unnest(range(1, 5)) AS t(i)),
o AS (SELECT rn, string_agg(format('{{:02x}}', e), '' ORDER BY part) AS code, sum(dist)::BIGINT AS error FROM a2 GROUP BY rn)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM o JOIN kept USING (rn), h
"""
