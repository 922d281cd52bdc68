"""How far the word use of a source departs from its language and its fellows.

Terms are runs of letters (ASCII letters, A-Z in lower case, and everything
beyond ASCII).  A language keeps the terms of at least ``min_docs`` of its
documents.  Each (lang, source) group and each language gives a kept term the
smoothed share ``p = 1 + floor(10^9 (count + 5) / (N + 5 V))``; all integers.

Terms, by ranking count cells: all terms of a group with the same count there
and the same count in the language have the same shares, so the terms are
grouped into cells (group count, language count) with a multiplicity and the
difference is taken once a cell.  Cells of equal difference are merged, the
values are ranked, largest first, and the multiplicities added up; only cells
of values that begin before the limit are expanded into terms, in UTF-8 order.

Pairs of sources: the sum of the differences over all kept terms.  The terms
of a language are dealt into blocks of about ``BLOCK_CELLS`` counts (sources
times terms); a task holds one block as a matrix, zero counts included, and
gives each pair its partial sum, and the partial sums are added up.  With very
many sources a block is repeated for slices of the sources, so neither matrix
nor result of a task grows with them.  The result itself has each pair of
sources of a language twice; that is its definition.

Counts are added up within each task before the first shuffle, by (lang,
source, term) and then by (lang, term), so that frequent words, hot sources and
hot languages reach a task as one row per task and source at most.

Defined cases: null text, lang and source are empty strings (an empty lang is a
language); a row is a document, rows that share an id count each; a group
without terms still has its pairs; with no kept term every pair has the value 0
and there are no term rows; a source alone in its language has no pairs; ties
are ranked by item in UTF-8 order; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from procura.llm.common import _arrow_schema, map_batches, read_table, stage, texts_of

MIN_DOCS = 30
TOP_TERMS = 50
#: Counts (sources times terms) in the matrix of one task.
BLOCK_CELLS = 2_000_000
#: Pairs that one task reports.
BLOCK_PAIRS = 500_000
#: Distinct (lang, source, term) that a task adds up before it passes them on.
HELD_TERMS = 300_000

SCALE, SMOOTH = 1_000_000_000, 5
TERM = re.compile(rb"[a-z\x80-\xff]+")  # of UTF-8 in lower case

RESULT = ["lang", "source", "part", "item", "value", "rank"]


def count_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, as far as a
    task adds them up; a row with a null term for each group."""
    def run(batches):
        seen: dict[tuple, tuple[Counter, Counter]] = {}
        held = 0

        def rows():
            out = {"lang": [], "source": [], "term": [], "n": [], "docs": []}
            for (lang, source), (n, in_docs) in seen.items():
                out["lang"] += [lang] * (len(n) + 1)
                out["source"] += [source] * (len(n) + 1)
                out["term"] += [None, *(t.decode() for t in n)]
                out["n"] += [0, *n.values()]
                out["docs"] += [0, *map(in_docs.__getitem__, n)]
            return out

        for batch in batches:
            for text, lang, source in zip(*map(texts_of, batch.columns)):
                n, in_docs = seen.setdefault((lang, source), (Counter(), Counter()))
                found = TERM.findall(text.encode().lower())
                held -= len(n)
                n.update(found)
                in_docs.update(set(found))
                held += len(n)
                if held >= HELD_TERMS:
                    yield rows()
                    seen, held = {}, 0
        yield rows()

    return map_batches(docs.select("text", "lang", "source"), run,
                       "lang string, source string, term string, n long, docs long")


def share(count: str, total: str, terms: str) -> F.Column:
    """1 + floor(10^9 (count + 5) / (total + 5 terms)), exact; null without terms."""
    return F.expr(f"1 + (cast({SCALE} as decimal(10,0)) * cast({count} + {SMOOTH} as decimal(20,0)))"
                  f" div nullif(cast({total} + {SMOOTH} * {terms} as decimal(20,0)), 0)")


class Audit:
    """Counts of one table and the two rankings over them."""

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS):
        docs = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang", "source")])
        by_group = count_terms(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        same = Window.partitionBy("lang", "term")
        table = (by_group.withColumn("lang_n", F.sum("n").over(same)).withColumn("lang_docs", F.sum("docs").over(same))
                 .withColumn("one", F.row_number().over(same.orderBy("source")) == 1)
                 .filter((F.col("lang_docs") >= min_docs) | F.col("term").isNull()))
        table = stage(table.drop("docs", "lang_docs"), "term-counts")
        #: a row per (lang, source) and kept term that occurs there
        self.kept = table.filter("term is not null")
        langs = self.kept.filter("one").groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
        sources = self.kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        sizes = table.filter("term is null").groupBy("lang").agg(F.count("*").alias("sources"))
        #: a row per group with its totals
        self.groups = stage(table.filter("term is null").select("lang", "source").join(sizes, "lang")
                            .join(langs, "lang", "left").join(sources, ["lang", "source"], "left")
                            .fillna(0, ["terms", "lang_total", "total"]), "group-counts")

    def top_terms(self, limit: int = TOP_TERMS) -> DataFrame:
        """The kept terms of a group that it uses more than its language does."""
        group = Window.partitionBy("lang", "source")
        cells = (self.kept.groupBy("lang", "source", "n", "lang_n").agg(F.count("*").alias("terms_in_cell"))
                 .join(self.groups, ["lang", "source"])
                 .withColumn("value", share("n", "total", "terms") - share("lang_n", "lang_total", "terms"))
                 .filter("value > 0").select("lang", "source", "n", "lang_n", "terms_in_cell", "value"))
        cells = stage(cells, "cells")
        # every value has a term, so values past the limit cannot be reached
        values = (cells.groupBy("lang", "source", "value").agg(F.sum("terms_in_cell").alias("size"))
                  .withColumn("place", F.row_number().over(group.orderBy(F.desc("value")))).filter(F.col("place") <= limit)
                  .withColumn("before", F.sum("size").over(group.orderBy(F.desc("value"))) - F.col("size"))
                  .filter(F.col("before") < limit).drop("size", "place"))
        chosen = cells.join(values, ["lang", "source", "value"]).drop("terms_in_cell")
        same = Window.partitionBy("lang", "source", "value").orderBy("term")
        return (self.kept.select("lang", "source", "term", "n", "lang_n").join(chosen, ["lang", "source", "n", "lang_n"])
                .withColumn("place", F.row_number().over(same)).filter(F.col("place") <= limit)
                .withColumn("rank", (F.col("before") + F.col("place")).cast("int")).filter(F.col("rank") <= limit)
                .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"))

    def source_pairs(self, block_cells: int = BLOCK_CELLS, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
        """Each source against each other one of its language."""
        groups = self.groups.withColumn("floor_p", share("0", "total", "terms")).withColumn(
            "blocks", F.greatest(F.lit(1), F.expr(f"cast(terms div greatest(1, {block_cells} div sources) as int) + 1"))).withColumn(
            "slices", F.expr(f"cast(sources div greatest(1, {block_pairs} div sources) as int) + 1"))
        own = F.expr("pmod(xxhash64(source), slices) = slice")
        spread = F.explode(F.expr("sequence(0, slices - 1)")).alias("slice")
        found = (self.kept.join(groups, ["lang", "source"])
                 .select("lang", F.expr("cast(pmod(xxhash64(term), blocks) as int)").alias("block"), spread, "source", "slices",
                         "term", share("n", "total", "terms").alias("p")))
        # what a source gives the terms it lacks
        lacking = (groups.select("lang", "source", "slices", "floor_p", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"))
                   .select("lang", "block", spread, "source", "slices", F.lit(None).cast("string").alias("term"),
                           F.col("floor_p").alias("p")))
        rows = found.unionByName(lacking).withColumn("own", own).drop("slices")
        out = _arrow_schema(rows.sparkSession, "lang string, source string, item string, value long")

        def differences(t: pa.Table) -> pa.Table:
            names, number = _numbered(t.column("source"))
            term = t.column("term").combine_chunks()
            known = term.is_valid().to_numpy(zero_copy_only=False)
            terms, place = _numbered(term.filter(pa.array(known)))
            p = t.column("p").fill_null(0).to_numpy()
            shares = np.zeros((len(names), len(terms)), np.int64)
            shares[number[~known]] = p[~known][:, None]
            shares[number[known], place] = p[known]
            mine = np.unique(number[t.column("own").to_numpy()])
            value = np.empty((len(mine), len(names)), np.int64)
            for k, i in enumerate(mine):
                value[k] = np.abs(shares - shares[i]).sum(1)
            a, b = np.repeat(mine, len(names)), np.tile(np.arange(len(names)), len(mine))
            a, b, value = a[a != b], b[a != b], value.ravel()[a != b]
            return pa.Table.from_arrays([pa.repeat(t.column("lang")[0], len(a)).cast(pa.string()), names.take(pa.array(a)),
                                         names.take(pa.array(b)), pa.array(value)], schema=out)

        group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return (rows.groupBy("lang", "block", "slice").applyInArrow(differences, "lang string, source string, item string, value long")
                .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
                .withColumn("rank", F.row_number().over(group))
                .select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank"))


def _numbered(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct strings and the number of each row's string."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    coded = column.cast(pa.string()).dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return coded.dictionary, coded.indices.to_numpy()


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, limit: int = TOP_TERMS) -> DataFrame:
    """Both rankings of ``text``, ``lang`` and ``source``."""
    a = Audit(docs, min_docs)
    return a.source_pairs().unionByName(a.top_terms(limit)).select(*RESULT)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read_table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT rid, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
tc AS MATERIALIZED (SELECT lang, source, term, count(*) AS c, count(DISTINCT rid) AS dd FROM w GROUP BY ALL),
lt AS MATERIALIZED (SELECT lang, term, sum(c)::BIGINT AS cc FROM tc GROUP BY ALL HAVING sum(dd) >= 30),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(cc)::BIGINT AS nl FROM lt GROUP BY lang),
gt AS MATERIALIZED (SELECT g.lang, g.source, lt.term, coalesce(tc.c, 0) AS c, lt.cc
                    FROM g JOIN lt USING (lang) LEFT JOIN tc ON tc.lang = g.lang AND tc.source = g.source AND tc.term = lt.term),
gn AS (SELECT lang, source, sum(c)::BIGINT AS n FROM gt GROUP BY ALL),
s AS MATERIALIZED (SELECT lang, source, term, c,
                          (1 + 1000000000::HUGEINT * (c + 5) // (n + 5 * v))::BIGINT AS p,
                          (1 + 1000000000::HUGEINT * (cc + 5) // (nl + 5 * v))::BIGINT AS q
                   FROM gt JOIN v USING (lang) JOIN gn USING (lang, source)),
pv AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value
       FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pr AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pv.value, 0) AS value
       FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
       LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source),
tr AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM s WHERE c > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
      FROM (SELECT * FROM pr UNION ALL SELECT * FROM tr))
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 50
"""
