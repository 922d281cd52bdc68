import math
import random
from collections import Counter

import pytest

from procura.llm import extraction as ex


def text_of(html):
    return "\n\n".join(t for _, t in ex.blocks_of(html))


@pytest.mark.parametrize("html, want", [
    ("", ""),
    ("just  text\n here", "just text here"),
    ("<p>one<p>two &amp; &lt;b&gt; &#233;", "one\n\ntwo & <b> é"),
    ("<article><h1>T</h1><p><b>lead.<br><p>a <i>b</i>c</p></article><footer>x</footer>", "T\n\nlead.\n\na bc"),
    ("<nav><ul><li><a href=/>m</a></li></ul></nav><div class='ad'>x</div><article><p>y</p></article>", "y"),
    ("<header><h1>Site</h1></header><main><header><h1>T</h1></header><p>y</p></main>", "T\n\ny"),
    ("<div id=comments><p>c</p></div><article><p>y</p><section class='comment-list'><p>z</p></section></article>", "y"),
    ("<script>var t='</p><p>no';</script><style>p{}</style><p>yes</p><!-- <p>no</p> -->", "yes"),
    ("<p>\u0130\u0130\u0130</p><SCRIPT>x</Script><p>b</p>", "\u0130\u0130\u0130\n\nb"),
    ("<p>a<script>if(a<b){}</script>b</p>", "ab"),
    ("<article><p>before<aside>side</aside>after</p></article>", "before\n\nafter"),
    ("<article><p>a<form><input value='>'>f</form></p>b</article>", "a\n\nb"),
    ("<p title='a > b'>x</p><p>cut <b", "x\n\ncut"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a\n\nb\n\nc\n\nd"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\n\nb\n\nc"),
    ("<p>x</div></section>y</p><p></p><p> &nbsp; </p>", "x\n\ny"),
    ("<article><p>no close", "no close"),
    ("<p>a <span class=ad>buy</span> b <button>x</button>c</p>", "a b c"),
    ("<script>never closed <p>x</p>", ""),
    ("a < b and 1<2", "a < b and 1<2"),
    ("<body class='has-sidebar menu'><main id=comments><p class=with-ads>y</p></main>", "y"),
    ("<div role=contentinfo>f</div><div class=story>s</div>", "s"),
])
def test_blocks(html, want):
    assert text_of(html) == want


def brute_importance(rows):
    """rows: (node, children, contents) of one tree -> node -> (pages, value)."""
    out = {}
    for node in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == node]
        m = len(own)
        if m == 1:
            out[node] = (1, 1.0)
            continue
        shown = Counter(r[1] for r in own)
        style = -sum(n / m * math.log(n / m, m) for n in shown.values())
        seen = Counter(c for r in own for c in r[2])
        content = 1 - sum(k * math.log(k, m) for k in seen.values()) / sum(seen.values())
        out[node] = (m, ex.CONTENT_WEIGHT * content + (1 - ex.CONTENT_WEIGHT) * style)
    return out


def test_importance_against_formula(spark):
    rng = random.Random(1)
    rows = [(rng.choice("abcd"), rng.randint(0, 3), sorted({rng.randint(0, 9) for _ in range(rng.randint(1, 4))}))
            for _ in range(200)] + [("e", 1, [1, 2])]
    df = spark.createDataFrame(rows, "node string, children long, contents array<long>")
    got = {r["node"]: (r["m"], r["importance"]) for r in ex.importance(df, ["node"]).collect()}
    want = brute_importance(rows)
    assert got.keys() == want.keys()
    for node, (m, value) in want.items():
        assert got[node][0] == m and got[node][1] == pytest.approx(value)


def test_shared_branches_of_a_host_are_cut_without_a_telling_name(spark):
    rng = random.Random(2)
    def words():
        return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(rng.random()) for _ in range(8))
    pages = []
    for i in range(120):
        body = "".join(f"<p>{words()}</p>" for _ in range(3))
        pages.append((i, f"http://H{i % 2}.org/{i}", f"<div class=blurb><p>Read our other pages {i % 3}</p></div>"
                      f"<div class=story>{body}</div><div class=legal>All rights kept.</div>"))
    pages += [(500, None, None), (501, "http://h0.org/", ""), (500, "http://h0.org/", "<p>lone page style</p>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'x' as host", "1 as texts")
    out = ex.main_text(df.repartition(4)).collect()
    assert len(out) == len(pages) and out[0].__fields__ == ["page_id", "url", "text", "n_chars"]
    for r in out:
        assert r.n_chars == len(r.text)
        if r.page_id < 500:
            html = pages[r.page_id][2]
            assert r.text == "\n\n".join(html.split("<div class=story><p>")[1].split("</p></div>")[0].split("</p><p>"))
    rest = sorted((r.url is None, r.text) for r in out if r.page_id >= 500)
    assert rest == [(False, ""), (False, "lone page style"), (True, "")]


def test_a_host_of_copies_keeps_its_text(spark):
    pages = [(i, "http://same.org/", "<div class=story><p>One story.</p><p>Its end.</p></div>") for i in range(300)]
    out = ex.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r.text for r in out} == {"One story.\n\nIts end."}


def test_empty_table(spark):
    assert ex.main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


@pytest.mark.parametrize("html, want", [
    ("<p>one</p><img alt=John's><p>two</p><p>three</p>", "one\n\ntwo\n\nthree"),
    ("<div class=\"a\"\"><p>two</p></div><p>three</p>", "two\n\nthree"),
    ("<p title='it's fine'>one</p><p>two</p>", "one\n\ntwo"),
    ("<a href = \"x>y\" title = 'a\"b>c'>one</a><p>two</p>", "one\n\ntwo"),
    ("<p \"odd' name>one</p><p class=>two</p></p \">three", "one\n\ntwo\n\nthree"),
    ("<a href=a=\"x>one</a><p>two\" </p>", "one\n\ntwo\""),
    ("<div class='ad'x=\"y\">no</div><p>yes</p>", "yes"),
    ("<svg class=icon/><p>one</p><svg><path d='M0'/></svg><p>two</p>", "one\n\ntwo"),
    ("<svg viewBox='0 0 1 1' /><p>one</p><math/><p>two</p>", "one\n\ntwo"),
    ("<svg><path><p>one</p><svg><path></svg><p>two</p>", "one\n\ntwo"),
    ("<svg><foreignObject><p>no</p></foreignObject></svg><p>yes</p>", "yes"),
    ("<svg><text>no</text></svg><p>yes</p>", "yes"),
    *((f"<p>one</p><{tag}><p>two</p>", "one\n\ntwo") for tag in ("svg", "math", "iframe", "noscript", "template", "xmp")),
    *((f"<p>one</p><{tag}><p>two</p>", "one") for tag in ("script", "style", "textarea", "title")),
])
def test_malformed_markup_swallows_no_text(html, want):
    assert text_of(html) == want


def test_long_runs_in_a_tag_take_linear_time():
    for run in ("' ", "a=", "= ", "/ ", "a=' "):
        assert text_of(f"<p>one</p><img {run * 50_001}'><p>two</p>").startswith("one")


def test_copies_under_own_headings_keep_their_text(spark):
    """Groups of pages share six paragraphs under headings of their own; the
    host's unnamed menu and notice still go, its unique articles stay."""
    def story(key):
        return [f"Paragraph {j} of the article {key}, long enough to be told from a notice." for j in range(6)]

    pages, want = [], {}
    for i in range(2_400):
        body = story(i % 12 if i < 2_300 else i)
        pages.append((i, "http://copies.org/", "<div class=blurb><p>Home and more</p></div><div class=story>"
                      f"<h1>Heading {i}</h1>{''.join(f'<p>{t}</p>' for t in body)}</div><div class=legal><p>All rights kept.</p></div>"))
        want[i] = "\n\n".join([f"Heading {i}", *body])
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in ex.main_text(df).collect()}
    assert got == want


LONG = "This paragraph of the article is long enough to be running text, and not an entry of some menu or a label beside it."


@pytest.mark.parametrize("html, want", [
    # a page inside one form, as some frameworks write it
    (f"<body><form id=aspnetForm><div class=menu><a>Home</a></div><div class=content><h1>T</h1><p>{LONG}</p><p>b</p></div>"
     "<div class=footer>f</div></form></body>", f"T\n\n{LONG}\n\nb"),
    (f"<form><nav>n</nav><article><p>short</p><form><input>f</form></article><p>{LONG}</p></form>", f"short\n\n{LONG}"),
    # wrappers whose class tells of the layout
    (f"<div class=content-sidebar-wrap><main><p>{LONG}</p></main><aside>a</aside></div><footer>f</footer>", LONG),
    (f"<div class='page-with-sidebar'><div class=story><p>{LONG}</p></div><div class=sidebar><p>s</p></div></div>", LONG),
    (f"<div class=sidebar-layout><div class=text><p>{LONG}</p><p>{LONG}</p></div><div class=sidebar>s</div></div>", f"{LONG}\n\n{LONG}"),
    ("<div class='post comment-open'><p>short</p></div><div class=comments><p>c</p></div>", "short"),
    ("<div class=comments-closed><article><p>short</p></article></div>", "short"),
    # an ordinary word in a name of its own
    ("<article><p>a</p><section class=alert-levels><h2>Levels</h2><p>b</p></section></article>", "a\n\nLevels\n\nb"),
    ("<article><p>a</p><div class=menu-ideas><p>b</p></div><div class='alert alert-info'>no</div><div class=share-buttons>no</div></article>",
     "a\n\nb"),
    # headings of the block that has the paragraphs
    ("<body><header>Site</header><div class=post><header><h1>T</h1></header><p>one</p></div></body>", "T\n\none"),
    ("<section><header><h2>T</h2></header><p>one</p></section>", "T\n\none"),
    ("<div id=page><header><h1>Site</h1></header><div class=story><p>one</p></div></div>", "one"),
    (f"<form id=f><div><header><h1>T</h1></header><p>{LONG}</p></div></form>", f"T\n\n{LONG}"),
    # the side is no body, however long it is
    (f"<article><p>short</p></article><div class=sidebar><p>{LONG}</p></div>", "short"),
    (f"<main><p>short</p></main><form><p>{LONG}</p></form>", "short"),
    (f"<div class=story><p>{LONG}</p></div><div class=sidebar><p>{LONG}</p></div>", LONG),
    (f"<p>short</p><div id=comments><article class=comment-body><p>{LONG}</p></article></div>", "short"),
    (f"<div class=comments><p>{LONG}</p></div>", ""),
    (f"<p>short</p><div class=related><article><p>{LONG}</p></article></div>", "short"),
])
def test_names_are_no_verdict_over_the_article(html, want):
    assert text_of(html) == want


def test_deep_and_stray_tags_take_linear_time():
    import time
    t0 = time.time()
    deep = "".join(f"<div class=c{k % 7}>t{k} " for k in range(5_000))
    assert len(ex.blocks_of(deep)) == 5_000
    assert max(path.count("/") for path, _ in ex.blocks_of(deep)) == ex.MAX_DEPTH
    assert text_of("<div>" * 20_000 + "</x></b></p>" * 20_000 + "end") == "end"
    assert text_of("<b>" * 5_000 + "<h1>x</h1>" * 5_000).startswith("x\n\nx")
    assert time.time() - t0 < 10


def test_a_deep_page_in_the_whole_query(spark):
    deep = "".join(f"<div>t{k} " for k in range(5_000))
    df = spark.createDataFrame([(1, "http://a.org/", deep), (2, "http://a.org/", "<p>x</p>")], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in ex.main_text(df).collect()}
    assert got[1].count("\n\n") == 4_999 and got[2] == "x"


def brute_main_text(pages):
    """The whole method on plain lists: page -> text."""
    parsed = {i: (host, ex.blocks_of(html or "")) for i, host, html in pages}
    told = {i: ex.telling(blocks) for i, (_, blocks) in parsed.items()}
    of_host = {}
    for i, (host, blocks) in parsed.items():
        if any(len(path.split("/")) > 1 for path, _ in blocks):
            of_host.setdefault(host, []).append(i)
    article = {}
    for ids in of_host.values():
        n = Counter(t for i in ids for t in set(told[i]))
        for i in ids:
            own = [t for t in told[i] if not (n[t] > 1 and n[t] > ex.WIDE * len(ids))]
            article[i] = own[0] if own else told[i][-1]

    def tree(ids):
        """node -> (articles, value) of the merged trees of pages."""
        shown, contents = {}, {}
        for i in ids:
            for path, text in parsed[i][1]:
                steps = path.split("/")
                for d in range(2, len(steps) + 1):
                    node = "/".join(steps[:d])
                    contents.setdefault(node, set()).add((parsed[i][0] if whole else "", article[i], text))
                    shown.setdefault(node, {}).setdefault(i, set()).add(path[len(node):])
        out = {}
        for node in shown:
            styles = Counter(s for _, s in {(article[i], tuple(sorted(v))) for i, v in shown[node].items()})
            m = len({article[i] for i in shown[node]})
            s, k = sum(styles.values()), Counter(t for _, t in {(a, t) for _, a, t in contents[node]})
            if m <= 1:
                out[node] = (m, 1.0)
                continue
            style = -sum(c / s * math.log(c / s) for c in styles.values()) / math.log(max(s, 2))
            content = 1 - sum(c * math.log(c) for c in k.values()) / sum(k.values()) / math.log(m)
            out[node] = (m, ex.CONTENT_WEIGHT * content + (1 - ex.CONTENT_WEIGHT) * style)
        return out

    whole = True
    every = tree([i for ids in of_host.values() for i in ids])
    whole = False
    low = {}
    for host, ids in of_host.items():
        for node, (m, own) in tree(ids).items():
            share = m / (m + ex.BACKING_PAGES)
            if share * own + (1 - share) * every[node][1] < ex.LEAST:
                low.setdefault(host, set()).add(node)
    out = {}
    for i, (host, blocks) in parsed.items():
        drop = tuple(n + "/" for n in low.get(host, ()))
        out[i] = "\n\n".join([t for path, t in blocks if not (path + "/").startswith(drop)] or [t for _, t in blocks])
    return out


def test_whole_query_against_a_brute_force_style_tree(spark):
    rng = random.Random(7)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()

    def some(n):
        return " ".join(rng.choice(words) for _ in range(n))

    pages = []
    for i in range(400):
        host = rng.choice("abbbccccc")
        parts = [f"<div class=blurb><p>Our other pages {rng.randrange(4)}</p></div>" if host != "a" else "",
                 f"<div class=story><h1>{some(3)}</h1>" + "".join(f"<p>{some(rng.randrange(2, 12))}</p>" for _ in range(rng.randrange(1, 5)))
                 + "</div>", rng.choice(["", "<div class=legal>All rights kept.</div>", "<div class=legal><ul><li>All rights</ul></div>"]),
                 f"<div class=x{chr(97 + i % 3)}>{some(rng.randrange(1, 3))}</div>"]
        pages.append((i, f"http://{host}.org/{i}", f"<body>{''.join(parts)}</body>" if rng.random() < .95 else rng.choice(["", None, "bare text"])))
    pages += [(1000 + k, "http://c.org/", pages[7][2]) for k in range(30)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5)
    got = {r.page_id: r.text for r in ex.main_text(df).collect()}
    want = brute_main_text([(i, u.split("/")[2], h) for i, u, h in pages])
    assert got == want
    assert any(len(ex.blocks_of(h or "")) > want[i].count("\n\n") + 1 for i, _, h in pages)
