"""Best-fit packing after Martello-Toth dominance reduction.

Documents become token sequences; a sequence longer than the capacity is cut
into capacity-long pieces (the first takes the remainder).  How pieces share
bins depends on their lengths alone, so the packing is solved on the table of
counts by length, which never has more than ``capacity`` rows, whatever the
input size.  The solution is a list of bin patterns with multiplicities.  Each
piece then gets its rank among the pieces of equal length (local rank in its
task plus a prefix sum of per-task counts, no length gathered in one task) and
looks its place up in the pattern that owns this rank.

Defined cases: null or empty text is the closing id alone; a null id is kept;
repeated rows are packed each for itself; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import re
import zlib
from array import array

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from procura.llm.common import map_batches, per_process, read_table, stage, texts_of

CAPACITY = 2048
END_ID = 0
#: Chunks of text whose token ids a worker keeps: so many, and so many bytes
#: of text and ids.
KEPT_CHUNKS, KEPT_BYTES = 200_000, 64_000_000
#: Documents whose texts a worker has as strings at once.
TEXTS_AT_ONCE = 256
#: White space of this length is left to ``tokenizers``: the other matches it
#: by recursion, which a run of a million characters brings down.
LONG_SPACE = 2_000

#: Places where the byte-level pre-tokeniser always splits: before one blank
#: or line end that stands between two characters that aren't white space.
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
_LONG_SPACE = re.compile(r"\s{%d}" % LONG_SPACE)


class ChunkIds(dict):
    """Chunk of text -> its token ids as bytes, kept between documents.

    The ids are those of the ``tokenizers`` file at ``path``.  Chunks not met
    before are merged by ``tiktoken`` on that file's vocabulary, which gives
    the same ids in a third of the time; a chunk with the text of a special
    token or with very long white space goes to ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        super().__init__()
        self.bytes = 0
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        byte = {chr(b): b for b in plain}  # the byte-level alphabet: other bytes follow from 256 on
        byte |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        ranks = {bytes(byte[c] for c in token): k for token, k in self.tokenizer.get_vocab().items()
                 if token not in self.special}
        self.merge = tiktoken.Encoding("of the file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                       special_tokens={}).encode_ordinary

    def learn(self, chunks: set[str]) -> None:
        if len(self) + len(chunks) > KEPT_CHUNKS or self.bytes > KEPT_BYTES:
            self.clear()
            self.bytes = 0
        new = chunks.difference(self)
        odd = [c for c in new if len(c) >= LONG_SPACE and _LONG_SPACE.search(c)]
        for special in self.special:
            odd += [c for c in new if special in c]
        new.difference_update(odd)
        for c in odd:
            self[c] = array("I", self.tokenizer.encode(c, add_special_tokens=False).ids).tobytes()
        self.update(zip(new, [array("I", ids).tobytes() for ids in map(self.merge, new)]))
        self.bytes += sum(map(len, new)) + sum(map(len, odd)) + sum(len(self[c]) for c in new)


#: What makes the plain cuts of ``chunks_of`` unsafe, beside other white space.
_RUNS = ("  ", " \n", "\n ", "\n\n", "\0")
_UNSAFE_STOP = re.compile(r"[^0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff][.,]")


def chunks_of(text: str) -> list[str]:
    """``text`` cut at places where the pre-tokeniser always splits.  Usual
    text (single blanks and line ends, stops after letters or digits) is cut
    by plain replacements, any other by ``_CUT``."""
    if (text.count(" ") + text.count("\n") + 1 != len(text.split()) or any(r in text for r in _RUNS)
            or text[0] in " \n.," or text[-1] in " \n" or _UNSAFE_STOP.search(text)):
        return _CUT.split(text)
    return (text.replace(" ", "\0 ").replace("\n", "\0\n").replace(".", "\0.").replace(",", "\0,")).split("\0")


def piece_rows(path: str, capacity: int):
    """Arrow batches of (doc id, text) -> one row per piece, with the rank of
    the piece among those of its length in this task."""
    end = array("I", [END_ID]).tobytes()

    def run(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ids = per_process(f"chunk ids {path}", lambda: ChunkIds(path))
        part = TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                some = batch.slice(at, TEXTS_AT_ONCE)
                cut = [chunks_of(t) for t in texts_of(some.column(1))]
                ids.learn(set().union(*cut))
                out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "part", "rank")}
                for doc, chunks in zip(some.column(0).to_pylist(), cut):
                    raw = b"".join(map(ids.__getitem__, chunks)) + end
                    total, start, piece = len(raw) // 4, 0, 0
                    size = (total - 1) % capacity + 1
                    while start < total:
                        out["doc_id"].append(doc)
                        out["piece"].append(piece)
                        out["start"].append(start)
                        out["length"].append(size)
                        out["ids_crc32"].append(zlib.crc32(raw[4 * start:4 * (start + size)]))
                        out["part"].append(part)
                        out["rank"].append(seen.get(size, 0))
                        seen[size] = seen.get(size, 0) + 1
                        start, piece, size = start + size, piece + 1, capacity
                yield out

    return run


# --- the packing of a table of counts -------------------------------------

Pattern = tuple[tuple[int, ...], int]  # lengths in one bin, number of such bins


class Counts:
    """Counts by length with the lengths that are left in ascending order."""

    def __init__(self, counts: dict[int, int]):
        self.n = {w: c for w, c in counts.items() if c > 0}
        self.sizes = sorted(self.n)

    def take(self, sizes: tuple[int, ...], times: int) -> None:
        for w in sizes:
            self.n[w] -= times
            if not self.n[w]:
                del self.n[w]
                self.sizes.remove(w)

    def without(self, w: int) -> Counts:
        return Counts({x: c - (x == w) for x, c in self.n.items()})

    def smallest(self, k: int, above: int = 0) -> list[int]:
        """The ``k`` smallest items longer than ``above`` (fewer if not there)."""
        out: list[int] = []
        for w in self.sizes[bisect.bisect_right(self.sizes, above):]:
            out += [w] * min(self.n[w], k - len(out))
            if len(out) == k:
                break
        return out

    def largest_fitting(self, room: int) -> int | None:
        at = bisect.bisect_right(self.sizes, room)
        return self.sizes[at - 1] if at else None

    def best_pair(self, room: int) -> tuple[int, int] | None:
        """Two items (larger first) of the largest sum within ``room``."""
        best, lo, hi = None, 0, len(self.sizes) - 1
        while lo <= hi:
            a, b = self.sizes[hi], self.sizes[lo]
            if a + b > room:
                hi -= 1
                continue
            if (a != b or self.n[a] > 1) and (best is None or a + b > sum(best)):
                best = (a, b)
            lo += 1
        return best


def dominating_set(left: Counts, w: int, capacity: int) -> tuple[int, ...] | None:
    """The bin that dominates every other feasible bin with an item of length
    ``w`` (the reduction procedure of Martello and Toth), or None."""
    rest, room = left.without(w), capacity - w
    partner = rest.largest_fitting(room)
    if partner is None:
        return (w,)
    if partner == room or sum(rest.smallest(2)) > room or len(rest.smallest(2)) < 2:
        return (w, partner)
    if len(three := rest.smallest(3)) == 3 and sum(three) <= room:
        return None
    pair = rest.best_pair(room)
    if pair is None or partner >= sum(pair):
        return (w, partner)
    if pair[0] == partner:
        larger = rest.smallest(2, above=pair[1])
        if len(larger) < 2 or sum(larger) > room:
            return (w, *pair)
    return None


def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Fix dominating bins from the longest item down, until none is left to
    fix.  Returns the fixed bins and the counts of the remainder."""
    left, fixed = Counts(counts), []
    changed = True
    while changed:
        changed = False
        for w in list(reversed(left.sizes)):
            while w in left.n and (bin_ := dominating_set(left, w, capacity)):
                times = min(left.n[x] // bin_.count(x) for x in bin_)
                left.take(bin_, times)
                fixed.append((bin_, times))
                changed = True
    return fixed, left.n


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing on counts: bins of equal content are one group, and
    all items of a length are placed group by group, fullest fitting first."""
    groups: dict[tuple[int, ...], int] = {}
    by_room: dict[int, list[tuple[int, ...]]] = {}
    rooms: list[int] = []

    def put(content, room, times):
        if times <= 0:
            return
        if content not in groups:
            groups[content] = 0
            if room not in by_room:
                by_room[room] = []
                bisect.insort(rooms, room)
            by_room[room].append(content)
        groups[content] += times

    def drop(content, room, times):
        groups[content] -= times
        if not groups[content]:
            del groups[content]
            by_room[room].remove(content)
            if not by_room[room]:
                del by_room[room]
                rooms.remove(room)

    for w in sorted(counts, reverse=True):
        n = counts[w]
        while n:
            at = bisect.bisect_left(rooms, w)
            if at < len(rooms):
                room = rooms[at]
                content = by_room[room][0]
                bins, each = groups[content], room // w
            else:
                room, content, each = capacity, (), capacity // w
                bins = -(-n // each)
            whole = min(bins, n // each)
            if content:
                drop(content, room, whole if whole else 1)
            if whole:
                put(content + (w,) * each, room - each * w, whole)
                n -= whole * each
            elif n:
                put(content + (w,) * n, room - n * w, 1)
                n = 0
    return [(content, times) for content, times in groups.items()]


def pack_counts(counts: dict[int, int], capacity: int) -> list[Pattern]:
    fixed, rest = reduce_instance(counts, capacity)
    return fixed + best_fit(rest, capacity)


def slots(patterns: list[Pattern]) -> dict[int, np.ndarray]:
    """Length -> rows (first rank, first bin, offset in the bin): the rank-th
    piece of that length sits in bin ``first bin + rank - first rank``."""
    rows: dict[int, list] = {}
    taken: dict[int, int] = {}
    first_bin = 0
    for sizes, times in patterns:
        offset = 0
        for w in sizes:
            rows.setdefault(w, []).append((taken.get(w, 0), first_bin, offset))
            taken[w] = taken.get(w, 0) + times
            offset += w
        first_bin += times
    return {w: np.array(r, np.int64) for w, r in rows.items()}


OUT = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Columns ``doc_id`` and ``text`` of ``docs`` -> one row per piece with
    its sequence and offset.  The tokenizer file must be at the same path on
    the executors (an installed package)."""
    pieces = stage(
        map_batches(docs.select(F.col("doc_id").cast("long"), "text"), piece_rows(tokenizer_path, capacity),
                    "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"), "pieces")
    by_task = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    spark = docs.sparkSession
    place = spark.sparkContext.broadcast(slots(pack_counts(counts, capacity)))
    before = by_task.select("part", "length", F.coalesce(
        F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))

    def run(batches):
        for batch in batches:
            cols = {name: batch.column(name) for name in ("doc_id", "piece", "start", "length", "ids_crc32")}
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            edges = np.flatnonzero(np.diff(length[order], prepend=-1))
            for i in np.split(order, edges[1:]) if len(order) else []:
                table = place.value[int(length[i[0]])]
                row = table[np.searchsorted(table[:, 0], rank[i], side="right") - 1]
                sequence[i], offset[i] = row[:, 1] + rank[i] - row[:, 0], row[:, 2]
            yield {**cols, "sequence_id": sequence, "offset": offset}

    return map_batches(ranked, run, OUT)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
