"""Language identification by cross-parsing entropy.

For every language a suffix automaton of labelled training text is built.  A
text is parsed greedily into the longest phrases that occur in that language's
training text; the fewer phrases a character takes, the lower its cross
entropy (phrases per character times the log of the training length).  The
language that needs the fewest normalised phrases wins, ties going to the
first name.

Phrases end at word borders (a word is a run of letters and their combining
marks, in lower case; number signs like ½ or ② are no letters), so the phrases of a word are counted once per distinct word; the words of a batch
are parsed together, one character position at a time, on the automata's dense
transition tables.

The training text is at most ``TRAIN_CHARS`` characters a language, drawn from
its documents of every length in the order of a hash of their ids.  A document
gives at most ``DOC_PART`` of it (a slice of its words, placed by the hash),
more only if the language has no other text.  A draw that brings too little is
repeated at a higher rate, so a language with a letter is always learnt.
Defined cases: null text or text
without a letter is ``und`` with score 0; a letter that no training text has
costs a phrase in every language; training rows with null text, language or id
are not used; a null id is judged, never learnt from; repeated rows are judged
each; without training text everything is ``und``; an empty table gives no
rows.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procura.llm.common import held_out, map_batches, read_table, texts_of

#: Training characters a language, and the part of them one document may give.
TRAIN_CHARS = 30_000
DOC_PART = 0.2
#: Growth of the rate if a language's draw brings too little.
REDRAW = 8
#: Languages share this many training characters if they are very many.
ALL_CHARS = 6_000_000
#: Words whose phrases a task keeps counted.
KEPT_WORDS = 300_000



def _category(*kinds: str) -> str:
    """The characters whose Unicode category begins with one of ``kinds``, as
    ranges of a regular expression's set."""
    ranges, last = [], -2
    for c in (c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)).startswith(kinds)):
        if c == last + 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
        last = c
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


#: A letter, then letters and the marks that combine with them.
_WORD = re.compile(f"[{_category('L')}][{_category('L', 'M')}]*")
#: The same for texts without the characters of ``_RARE``, among which all marks
#: and all but six of the number signs are; several times as fast.
_PLAIN = re.compile(r"[^\W\d_²³¹¼½¾]+")
_RARE = re.compile("[\u0300-\u1fff\u2070-\u209f\u20d0-\U0010ffff]")
BREAK = " "


def words_of(text: str) -> list[str]:
    text = text.lower()
    plain = text.isascii() or not _RARE.search(text)
    return (_PLAIN if plain else _WORD).findall(text)


def automaton(text: str, code: dict[str, int]) -> np.ndarray:
    """Transition table (state, character code) -> state or -1 of the suffix
    automaton of ``text``: a walk from state 0 exists for its substrings only."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for ch in text:
        c = code[ch]
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    table = np.full((len(step), len(code) + 1), -1, np.int32)
    for state, moves in enumerate(step):
        for c, to in moves.items():
            table[state, c] = to
    return table


def count_phrases(table: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Greedy phrases of each row of ``codes`` (padded words, longest first).
    A character without any transition is a phrase of its own."""
    state, phrases = np.zeros(len(codes), np.int32), np.ones(len(codes), np.int32)
    active = np.arange(len(codes))
    for at in range(codes.shape[1]):
        active = active[:np.searchsorted(-lengths[active], -at, side="left")]
        if not len(active):
            break
        c = codes[active, at]
        to = table[state[active], c]
        stuck = to < 0
        fresh = table[0, c]
        # an unfinished phrase ends here; at its first character there is none
        phrases[active] += stuck & (state[active] > 0)
        to = np.where(stuck, fresh, to)
        lost = to < 0  # not in the training text at all
        phrases[active] += lost & (at + 1 < lengths[active])
        state[active] = np.where(lost, 0, to)
    return phrases


@dataclass
class Model:
    names: list[str]
    code: dict[str, int]
    tables: list[np.ndarray]
    unit: np.ndarray  # log2 of each training length


class Parser(dict):
    """Word -> row of ``costs`` (normalised phrases of it in each language)."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.costs = model, np.empty((1024, len(model.names)))

    def learn(self, words: set[str]) -> None:
        if len(self) + len(words) > KEPT_WORDS:
            self.clear()
        new = sorted((w for w in words if w not in self), key=len, reverse=True)
        while len(self.costs) < len(self) + len(new):
            self.costs = np.concatenate([self.costs, np.empty_like(self.costs)])
        unknown, get = len(self.model.code), self.model.code.get
        for at in range(0, len(new), 4096):
            part = new[at:at + 4096]
            lengths = np.array([len(w) + 1 for w in part])
            for low in range(0, len(part), 512):  # equal lengths together: little padding
                some, size = part[low:low + 512], lengths[low:low + 512]
                codes = np.zeros((len(some), int(size[0])), np.int32)
                for i, w in enumerate(some):
                    codes[i, :len(w) + 1] = [get(c, unknown) for c in w + BREAK]
                cost = np.stack([count_phrases(t, codes, size) * u
                                 for t, u in zip(self.model.tables, self.model.unit)], axis=1)
                first = len(self)
                self.costs[first:first + len(some)] = cost
                for i, w in enumerate(some):
                    self[w] = first + i

    def cost(self, words: list[str]) -> np.ndarray:
        """Normalised phrases a character in each language."""
        rows = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        total = np.zeros(len(self.model.names))
        for at in range(0, len(rows), 100_000):
            total += self.costs[rows[at:at + 100_000]].sum(0)
        return total / (sum(map(len, words)) + len(words))


#: How fast the score falls with a runner-up's closeness.
SHARPNESS = 12.0


def verdict(cost: np.ndarray, names: list[str]) -> tuple[str, float]:
    best = int(np.argmin(cost))
    return names[best], float(1 / np.exp(-SHARPNESS * (cost - cost[best])).sum())


def slice_of(text: str, size: int, key: int) -> str:
    """At most ``size`` characters of ``text`` (words joined by ``BREAK``) from
    a place given by ``key``; whole words if one fits."""
    if len(text) <= size:
        return text
    at = key % (len(text) - size + 1)
    words = text[at:at + size].split(BREAK)
    if at and text[at - 1] != BREAK:
        words = words[1:]
    if at + size < len(text) and text[at + size] != BREAK:
        words = words[:-1]
    return BREAK.join(words).strip(BREAK) or text[at:at + size].strip(BREAK)


def _draw(usable: DataFrame, rate: dict[str, float], size: dict[str, int]) -> list:
    """(lang, key, text) of the drawn documents that have words, cut to the
    language's ``size``."""
    limit = F.create_map(*[F.lit(x) for k, v in rate.items() for x in (k, int(v * 1_000_000_000))])
    key = F.pmod(F.xxhash64("doc_id", F.lit("draw")), F.lit(1_000_000_000))
    drawn = usable.withColumn("key", key).filter(F.col("key") < limit[F.col("lang")])

    def run(batches):
        for batch in batches:
            out = {k: [] for k in ("lang", "key", "doc_id", "text")}
            for lang, key, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = words_of(text)
                if words:
                    for k, v in zip(out, (lang, key, doc_id, slice_of(BREAK.join(words), size[lang], key))):
                        out[k].append(v)
            yield out

    cut = map_batches(drawn.select("lang", "key", "doc_id", "text"), run, "lang string, key long, doc_id long, text string")
    return sorted(map(tuple, cut.collect()), key=lambda r: r[1:])


def training_text(docs: DataFrame, train_chars: int = TRAIN_CHARS) -> dict[str, str]:
    """Language -> words of its training text, joined by blanks."""
    usable = docs.select(F.col("doc_id").cast("long"), "lang", "text").filter(
        "doc_id is not null and lang is not null and text is not null").filter(~held_out(F.col("doc_id")))
    part = F.lit(max(1, int(train_chars * DOC_PART)))
    rows = usable.groupBy("lang").agg(F.sum(F.least(F.greatest(F.length("text"), F.lit(1)), part)).alias("chars")).collect()
    each = max(1, min(train_chars, ALL_CHARS // max(1, len(rows))))
    rate = {r["lang"]: min(1.0, 1.5 * each / r["chars"]) for r in rows}
    size = dict.fromkeys(rate, max(1, int(each * DOC_PART)))
    found: dict[str, list[tuple[int, str]]] = {}
    while rate:
        got: dict[str, list[tuple[int, str]]] = {k: [] for k in rate}
        for lang, key, _, text in _draw(usable, rate, size):
            got[lang].append((key, text))
        found.update(got)
        short = [k for k, v in got.items() if sum(len(t) + 1 for _, t in v) < each and (rate[k] < 1 or size[k] < each)]
        # more documents first, longer slices of them if there are no more
        size = {k: size[k] if rate[k] < 1 else each for k in short}
        rate = {k: min(1.0, rate[k] * REDRAW) for k in short}
    out = {}
    for lang, drawn in sorted(found.items()):
        text, room = [], each
        for key, piece in drawn:
            if len(piece) >= room and text:
                piece = slice_of(piece, room - 1, key) if room > 1 else ""
            if piece:
                text.append(piece)
            room -= len(piece) + 1
            if room <= 0:
                break
        if text:
            out[lang] = BREAK + BREAK.join(text) + BREAK
    return out


def train(text: dict[str, str]) -> Model:
    code = {c: i for i, c in enumerate(sorted(set().union(*text.values()) if text else ()))}
    names = sorted(text)
    return Model(names, code, [automaton(text[k], code) for k in names],
                 np.array([np.log2(len(text[k]) + 1) for k in names]))


OUT = "doc_id long, held_out boolean, lang_pred string, score double"


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Language and score of every whole text."""
    spark = docs.sparkSession
    parts = spark.sparkContext.broadcast((model.names, model.code, model.tables, model.unit))

    def run(batches):
        parser = Parser(Model(*parts.value))
        for batch in batches:
            texts, out = texts_of(batch.column(1)), []
            for at in range(0, len(texts), 256):
                split = [words_of(t) for t in texts[at:at + 256]]
                if parser.model.names:
                    parser.learn(set().union(*split))
                out += [verdict(parser.cost(w), parser.model.names) if w and parser.model.names else ("und", 0.0)
                        for w in split]
            lang, score = zip(*out) if out else ((), ())
            yield {"doc_id": batch.column(0), "held_out": batch.column(2), "lang_pred": lang, "score": score}

    doc_id = F.col("doc_id").cast("long")
    return map_batches(docs.select(doc_id.alias("doc_id"), "text", held_out(doc_id).alias("held_out")), run, OUT)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return identify(docs, train(training_text(docs)))
