"""URL filter: longest allow/block rule, else a weighted vocabulary.

Rules name a host (it fits itself and all its subdomains) and a path prefix;
the longest fitting rule decides.  Any other url is judged by its terms: an
Aho-Corasick automaton finds every vocabulary term in one pass over the url (A-Z
in lower case), an occurrence counts if neither neighbour is a letter or digit,
and the url is rejected on one strict term or on ``SOFT_HITS`` distinct soft
ones.

The vocabulary is an argument, or a table of (term, kind) rows; a term is
compared in lower case, repeated terms are one, empty ones are left out, and a
term of both kinds is strict.  The automaton is built once per worker.

Defined cases: a null url or one without ``://`` has empty host and path (no
rule fits), its terms still count; a null id and repeated rows are judged each;
an empty table gives no rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from procura.llm.common import map_batches, per_process, read_table, texts_of


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("com", "/", "allow"), Rule("example.com", "/en/", "block"), Rule("www.example.com", "/en/", "allow"),
         Rule("net", "/es/", "block"), Rule("net", "/fr/", "block"))

#: One of these rejects a url.
STRICT = ("casino", "porn", "xxx", "viagra", "cialis", "escort", "gambling", "spam", "malware", "phishing", "warez")
#: Several different ones of these do.
SOFT = ("ads", "adult", "bet", "bets", "bonus", "buy", "cheap", "click", "credit", "deal", "farm", "free", "hot", "loan",
        "loans", "offer", "pill", "pills", "poker", "prize", "promo", "sale", "slots", "track", "win", "winner")
SOFT_HITS = 2
#: Terms of a table that travel with a task.
MAX_TERMS = 1_000_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


@dataclass(frozen=True)
class Vocabulary:
    """Strict and soft terms, and how many distinct soft ones reject."""
    strict: frozenset[str]
    soft: frozenset[str]
    soft_hits: int = SOFT_HITS

    @staticmethod
    def of(strict, soft, soft_hits: int = SOFT_HITS) -> Vocabulary:
        lower = str.maketrans(_UPPER, _LOWER)
        kinds = [frozenset(t.translate(lower) for t in terms if t) for terms in (strict, soft)]
        return Vocabulary(kinds[0], kinds[1] - kinds[0], soft_hits)

    @staticmethod
    def read(table: DataFrame, soft_hits: int = SOFT_HITS) -> Vocabulary:
        """From (``term``, ``kind``) rows, kind "strict" or "soft"."""
        rows = table.select("term", "kind").filter("term <> '' and kind in ('strict', 'soft')").distinct()
        terms = rows.limit(MAX_TERMS + 1).collect()
        if len(terms) > MAX_TERMS:
            raise ValueError(f"the vocabulary has more than {MAX_TERMS} terms")
        return Vocabulary.of(*([t.term for t in terms if t.kind == k] for k in ("strict", "soft")), soft_hits)

    def automaton(self):
        import ahocorasick
        finder = ahocorasick.Automaton()
        for kind, terms in enumerate((self.strict, self.soft)):
            for term in terms:
                finder.add_word(term, (kind, term))
        finder.make_automaton()
        return finder


DEFAULT = Vocabulary.of(STRICT, SOFT)


def term_hits(urls: DataFrame, vocabulary: Vocabulary = DEFAULT) -> DataFrame:
    """Adds ``n_strict`` and ``n_soft``, the distinct terms of either kind in
    each url of (page_id, url, host, path)."""
    name = f"vocabulary {uuid.uuid4().hex}"

    def run(batches):
        finder = per_process(name, vocabulary.automaton)
        lower = str.maketrans(_UPPER, _LOWER)
        inside = frozenset(_LOWER + "0123456789")
        for batch in batches:
            counts = ([], [])
            for url in texts_of(batch.column(1)):
                text, found = url.translate(lower), (set(), set())
                for end, (kind, term) in finder.iter(text) if len(finder) else ():
                    start = end - len(term) + 1
                    if text[end + 1:end + 2] not in inside and (not start or text[start - 1] not in inside):
                        found[kind].add(term)
                for kind in (0, 1):
                    counts[kind].append(len(found[kind]))
            yield {"page_id": batch.column(0), "host": batch.column(2), "path": batch.column(3),
                   "n_strict": counts[0], "n_soft": counts[1]}

    return map_batches(urls, run, "page_id long, host string, path string, n_strict int, n_soft int")


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, vocabulary: Vocabulary = DEFAULT) -> DataFrame:
    """``page_id`` and ``url`` -> host, path, rule, verdict and term counts."""
    url = F.col("url")
    hits = term_hits(pages.select(F.col("page_id").cast("long"), url, host_of(url).alias("host"), path_of(url).alias("path")),
                     vocabulary)
    longest = sorted(rules, key=lambda r: -len(r.name))
    fit = [(fits(r, F.col("host"), F.col("path")), r) for r in longest]
    by_terms = F.when((F.col("n_strict") > 0) | (F.col("n_soft") >= vocabulary.soft_hits), "block").otherwise("allow")
    rule, verdict = F.lit(None).cast("string"), by_terms
    for ok, r in reversed(fit):
        rule, verdict = F.when(ok, r.name).otherwise(rule), F.when(ok, r.verdict).otherwise(verdict)
    return hits.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "n_strict", "n_soft")


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "pages"))


def _sql() -> str:
    def count(terms):
        listed = ", ".join(f"'{t}'" for t in terms)
        return (f"len(list_filter([{listed}], lambda t: regexp_matches(u, '(^|[^a-z0-9])' || t || '([^a-z0-9]|$)')))"
                "::INTEGER")
    longest = sorted(RULES, key=lambda r: -len(r.name))
    fit = [f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in longest]
    case = "CASE " + " ".join(f"WHEN {f} THEN '{{}}'" for f in fit) + " {} END"
    lower = f"translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}')"
    return f"""
WITH p AS (SELECT page_id, {lower} AS u,
    translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM pages),
t AS (SELECT *, {count(STRICT)} AS n_strict, {count(SOFT)} AS n_soft FROM p)
SELECT page_id, host, path, {case.format(*[r.name for r in longest], "")} AS rule,
    {case.format(*[r.verdict for r in longest],
                 f"ELSE CASE WHEN n_strict > 0 OR n_soft >= {SOFT_HITS} THEN 'block' ELSE 'allow' END")} AS verdict,
    n_strict, n_soft
FROM t"""


SQL = _sql()
