import re

import pytest

from procura.llm import urls


def brute(url):
    text = (url or "").translate(str.maketrans(urls._UPPER, urls._LOWER))
    hits = [sum(bool(re.search(rf"(?<![a-z0-9]){t}(?![a-z0-9])", text)) for t in terms) for terms in (urls.STRICT, urls.SOFT)]
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = host.translate(str.maketrans(urls._UPPER, urls._LOWER))
    fit = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fit:
        best = max(fit, key=lambda r: len(r.name))
        return host, path, best.name, best.verdict
    return host, path, None, "block" if hits[0] or hits[1] >= urls.SOFT_HITS else "allow"


URLS = [None, "", "nothing", "http://", "http://A.Example.com/en/1", "https://www.example.com/en/", "http://xexample.com/en/",
        "http://example.com", "http://com/", "http://shop.net/es/casino", "http://net/fr/", "http://a.org/casino", "http://a.org/casinos",
        "http://cheap-free.org", "http://cheap.org/cheap", "http://a.org/x?y=free#win", "HTTP://SPAM.org", "a://b://c/d?e://f",
        "http://a.org/\ncasino", "http://é.org/bonus_poker", "http://a.org:80/x", "http://x.com?en", "http://x.net#/es/", "x" * 50_000]


def test_against_python(spark):
    rows = list(enumerate(URLS)) + [(3, "http://a.org/"), (3, "http://a.org/"), (None, "http://spam.com")]
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' as host", "'y' as rule", "1 as path")
    got = urls.judge(df.repartition(3)).collect()
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got), key=repr) == sorted(
        ((i, *brute(u)) for i, u in rows), key=repr)


def test_empty_table(spark):
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).collect() == []


def test_other_vocabularies(spark):
    rows = [(0, "http://a.org/roulette"), (1, "http://a.org/red-Blue"), (2, "http://a.org/red"), (3, "http://a.org/casino"),
            (4, "http://a.org/redblue"), (5, None)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    table = spark.createDataFrame([("ROULETTE", "strict"), ("red", "soft"), ("blue", "soft"), ("Red", "soft"), ("", "strict"),
                                   (None, "soft"), ("casino", "other"), ("green", "soft"), ("green", "strict")], "term string, kind string")
    words = urls.Vocabulary.read(table)
    assert words == urls.Vocabulary.of(["roulette", "green"], ["red", "blue"])
    assert {r.page_id: r.verdict for r in urls.judge(df, vocabulary=words).collect()} == {
        0: "block", 1: "block", 2: "allow", 3: "allow", 4: "allow", 5: "allow"}
    assert {r.verdict for r in urls.judge(df, vocabulary=urls.Vocabulary.of([], [])).collect()} == {"allow"}
    one = urls.Vocabulary.of([], ["red"], soft_hits=1)
    assert {r.page_id for r in urls.judge(df, vocabulary=one).collect() if r.verdict == "block"} == {1, 2}


def test_a_vocabulary_table_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(urls, "MAX_TERMS", 3)
    table = spark.range(4).selectExpr("concat('t', id) as term", "'soft' as kind")
    with pytest.raises(ValueError, match="more than 3"):
        urls.Vocabulary.read(table)
