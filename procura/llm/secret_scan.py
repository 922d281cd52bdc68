"""Secret scans over an incremental ledger of content-addressed blobs.

Every version of a document is a blob, addressed by the SHA-256 of its text.
The ledger has a row for each blob and rule version that has been scanned,
with the spans found; a scan looks at unseen (blob, rule version) pairs alone,
each distinct blob once however many paths hold it, and joins the findings
back to all paths.  DataFrame functions only: the matches of a pattern and the
pieces between them give the code-point positions.

Defined cases: null text is the empty blob; repeated rows and null ids each
get their row; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from procura.llm.common import read_table, stage


@dataclass(frozen=True)
class Rule:
    """``pattern`` is matched from left to right without overlap; a match
    counts if its ``group`` has ``least`` characters or more."""
    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1


ASSIGN = Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
              2, 12)
ACCESS = Rule("access", 1, "AKIA[A-Z0-9]{14,}")
#: Greedy runs of 16 or more are exactly the runs of any length that pass.
HEX = Rule("hex", 1, "[0-9a-f]{16,}")
#: Added by this operator: first lines of private key blocks, and signed tokens.
PEM = Rule("pem", 1, "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----")
JWT = Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}")
RULES = (ASSIGN, ACCESS, HEX, PEM, JWT)


def _pem_block() -> str:
    """Pattern of a whole private key block: header lines and base64 body up to
    the END line, or without one up to the last body line.  Lines may be parted
    by blanks, escaped line ends or quotes.  Possessive, so that matching needs
    no stack however long a body is."""
    line_end = r"""(?:\\[nrt]|[\s\\"'`,;>|*#&<])"""
    headers = rf"(?:{line_end}++[A-Za-z][A-Za-z0-9-]{{0,40}}:\x20?[^\r\n\\]{{0,200}}+(?=[\r\n\\]))*+"
    to_end = rf"""{headers}[A-Za-z0-9+/=\s\\"'`,;&#<>|*]*+-----END [A-Z ]{{0,40}}PRIVATE KEY-----"""
    last = rf"""(?:{line_end}++(?:[A-Za-z0-9+/]{{0,39}}+={{1,2}}|[A-Za-z0-9+/]{{1,39}}+(?=\s*+\z|\s*?[\r\n]|[\\"'`])))?"""
    lines = rf"(?:{line_end}*+[A-Za-z0-9+/=]{{40,}}+)"
    short = rf"(?:{line_end}++[A-Za-z0-9+/=]{{20,39}}+(?![A-Za-z0-9+/=]))"
    cut = rf"{headers}(?:{lines}++|{short}++){last}"
    only = rf"{headers}\s++[A-Za-z0-9+/]{{1,39}}={{0,2}}\s*+\z"
    return rf"{PEM.pattern}(?:{to_end}|{cut}|{only})?"


#: The pipeline redacts the whole block, key and END line included; the query
#: marks first lines, as its SQL does.
PEM_BLOCK = Rule("pem", 2, _pem_block())
REDACTED = (ASSIGN, ACCESS, HEX, PEM_BLOCK, JWT)

SPAN = "array<struct<start:int,kind:string,rank:int,stop:int>>"
LEDGER = f"blob string, kind string, version int, spans {SPAN}"


def _matches(text: Column, rule: Rule) -> tuple[Column, Column, Column]:
    """All matches, the checked groups, and the pieces between the matches."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    checked = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    return whole, checked, F.split(text, rule.pattern, -1)


def find_matches(text: Column, rule: Rule) -> Column:
    """A rule's matches in ``text``: the code points before each (since the
    last one) and in it, and whether it counts."""
    whole, checked, pieces = _matches(text, rule)
    rows = F.arrays_zip(whole.alias("m"), checked.alias("g"), F.slice(pieces, 1, F.size(whole)).alias("p"))
    found = F.transform(rows, lambda x: F.struct(F.length(x["p"]).alias("gap"), F.length(x["m"]).alias("size"),
                                                 (F.length(x["g"]) >= rule.least).alias("counts")))
    return F.when(text.rlike(rule.pattern), found).otherwise(F.array().cast("array<struct<gap:int,size:int,counts:boolean>>"))


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def scan_unseen(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows for the unseen (blob, rule version) pairs of ``versions``
    (columns ``blob`` and ``text``; append them to the ledger).  Positions are
    running sums over the matches as rows, so a text with very many costs no
    more for each."""
    known = F.lit(None).cast("array<string>")
    blobs = versions.select("blob", F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["blob"])
    if ledger is not None:
        seen = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws(":", "kind", "version")).alias("seen"))
        blobs = blobs.join(seen, "blob", "left")
        known = F.col("seen")
    wanted = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(k).alias("rank"), F.lit(r.version).alias("version"),
                                F.when(~F.coalesce(F.array_contains(known, f"{r.kind}:{r.version}"), F.lit(False)),
                                       find_matches(F.col("text"), r)).alias("matches"))
                       for k, r in enumerate(rules)])
    matches = (blobs.select("blob", F.explode(wanted).alias("r")).filter("r.matches is not null")
               .select("blob", "r.kind", "r.rank", "r.version", F.posexplode_outer("r.matches").alias("place", "m")))
    stop = F.sum(F.col("m.gap") + F.col("m.size")).over(Window.partitionBy("blob", "rank").orderBy("place")).cast("int")
    span = F.when(F.col("m.counts"), F.struct((F.col("stop") - F.col("m.size")).alias("start"), "kind", "rank", "stop"))
    return (matches.withColumn("stop", stop).groupBy("blob", "kind", "version")
            .agg(F.array_sort(F.collect_list(span)).cast(SPAN).alias("spans")))


def findings(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per blob with the spans of the given rules, sorted by start,
    then rule."""
    current = " or ".join(f"kind = '{r.kind}' and version = {r.version}" for r in rules)
    return (ledger.filter(current).filter(F.size("spans") > 0).groupBy("blob")
            .agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans")))


def scan(docs: DataFrame, ledger: DataFrame | None = None,
         rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """``doc_id`` and ``text`` -> (``doc_id``, ``spans`` for every row, new
    ledger rows).  ``spans`` is an array of (start, kind, rank, stop)."""
    versions = docs.select(F.col("doc_id").cast("long"), "text", blob_of(F.col("text")).alias("blob"))
    new = stage(scan_unseen(versions, ledger, rules), "ledger")
    found = findings(new if ledger is None else ledger.select(new.columns).union(new), rules)
    out = versions.select("doc_id", "blob").join(found, "blob", "left")
    return out.select("doc_id", F.coalesce("spans", F.array().cast(SPAN)).alias("spans")), new


#: Code points of a text that are cut together.
BLOCK = 4096


def _cut(blocks: Column, start: Column, stop: Column) -> Column:
    """Code points ``start`` to ``stop`` of a text in blocks of ``BLOCK``."""
    i, j = F.floor(start / BLOCK).cast("int"), F.floor((stop - 1) / BLOCK).cast("int")
    one = F.substring(F.get(blocks, i), start - i * BLOCK + 1, stop - start)
    more = F.concat(F.substring(F.get(blocks, i), start - i * BLOCK + 1, F.lit(BLOCK)),
                    F.array_join(F.slice(blocks, i + 2, F.greatest(j - i - 1, F.lit(0))), ""),
                    F.substring(F.get(blocks, j), F.lit(1), stop - j * BLOCK))
    return F.when(stop <= start, F.lit("")).when(i == j, one).otherwise(more)


def redact(blocks: Column, length: Column, spans: Column) -> Column:
    """The text with each span (sorted by start, with the end ``before`` it of
    all earlier ones) replaced by ``[kind]``; of overlapping spans the first
    gives the kind.  The text comes in blocks, so that a piece costs its own
    length and not its distance from the start."""
    parts = F.transform(spans, lambda s: F.when(
        s["start"] >= s["before"], F.concat(_cut(blocks, s["before"], s["start"]), F.lit("["), s["kind"], F.lit("]")))
        .otherwise(F.lit("")))
    return F.concat(F.array_join(parts, ""), _cut(blocks, F.array_max(F.transform(spans, lambda s: s["stop"])), length))


def redact_secrets(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by its kind (and
    ``n_chars``, if there, counted anew)."""
    keyed = docs.withColumn("__blob", blob_of(F.col("text")))
    new = stage(scan_unseen(keyed.select(F.col("__blob").alias("blob"), "text"), ledger, rules), "ledger")
    found = findings(new if ledger is None else ledger.select(new.columns).union(new), rules)
    # the furthest end of the earlier spans of a blob, as a running maximum over rows
    earlier = Window.partitionBy("blob").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    found = (found.select("blob", F.posexplode("spans").alias("place", "s"))
             .withColumn("before", F.coalesce(F.max("s.stop").over(earlier), F.lit(0)))
             .groupBy(F.col("blob").alias("__blob"))
             .agg(F.array_sort(F.collect_list(F.struct("place", "s.start", "s.stop", "s.kind", "before"))).alias("__spans")))
    blocks = F.when(F.col("__spans").isNotNull(), F.regexp_extract_all("text", F.lit(r"(?s).{1,%d}" % BLOCK), F.lit(0)))
    out = keyed.join(found, "__blob", "left").withColumn("__blocks", blocks).withColumn(
        "text", F.when(F.col("__spans").isNull(), F.col("text"))
        .otherwise(redact(F.col("__blocks"), F.length("text"), F.col("__spans"))))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__spans").isNull(), F.col("n_chars")).otherwise(
            F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["stop"].cast("string"))), ",")


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = scan(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["rank"] < 3)
    count = [F.size(F.filter("spans", lambda s: s["rank"] == k)).cast("long").alias(f"n_{r.kind}")  # noqa: B023
             for k, r in enumerate(RULES[:3])]
    return found.select("doc_id", *count, F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"),
                        span_text(F.col("spans")).alias("spans"))


def _sql_spans(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    """Spans of one rule as a DuckDB list of (start, rank, stop, kind)."""
    p = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, rid, list_filter(list_transform(range(1, len(m) + 1), lambda i: {{
      'start': list_sum(list_transform(p[1:i], lambda x: len(x)))::BIGINT
               + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: len(x))), 0)::BIGINT,
      'rank': {rank},
      'stop': list_sum(list_transform(p[1:i], lambda x: len(x)))::BIGINT
              + list_sum(list_transform(m[1:i], lambda x: len(x)))::BIGINT,
      'kind': '{kind}', 'ok': len(g[i]) >= {least}}}), lambda s: s.ok) AS s
  FROM (SELECT doc_id, rid, regexp_extract_all(t, '{p}') AS m, regexp_extract_all(t, '{p}', {group}) AS g,
               regexp_split_to_array(t, '{p}') AS p FROM d)"""


def _sql() -> str:
    parts = " UNION ALL ".join(_sql_spans(r.kind, k, r.pattern, r.group, r.least) for k, r in enumerate(RULES))
    show = "lambda x: x.kind || ':' || x.start || ':' || x.stop"
    n = ", ".join(f"len(list_filter(s, lambda x: x.kind = '{k}')) AS n_{k}" for k in ("assign", "access", "hex"))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS rid FROM documents),
f AS ({parts}),
a AS (SELECT doc_id, rid, list_sort(flatten(list(s))) AS s FROM f GROUP BY doc_id, rid)
SELECT doc_id, {n},
       sha256(coalesce(array_to_string(list_transform(list_filter(s, lambda x: x.rank < 3), {show}), ','), '')) AS base_sha256,
       coalesce(array_to_string(list_transform(s, {show}), ','), '') AS spans
FROM a"""


SQL = _sql()
