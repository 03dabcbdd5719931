import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ruleforge.llm import html_extract as m
from tests.llm.conftest import prose


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body><nav><a href='/'>Home</a></nav>{body}<footer>&copy; x</footer></body></html>"


CASES = [
    (page("<article><h1>A &amp; B</h1><p>One<b>two</b>\n  three<br>four<p>five&nbsp;six &eacute; &#x41;</article>"), "A & B Onetwo three four five six é A"),
    (page("<div class='ad'>Buy</div><main><p>x<script>var a='</p>'</script><style>p{}</style> y<!-- no --></p></main>"), "x y"),
    (page("<article><p>text</p><div class='comments'><p>reader</p></div><aside>side</aside><form><p>f</p><input value=1></form></article>"), "text"),
    (page("<article><header><h1>Head</h1></header><p>p</p><footer>by me</footer></article>"), "Head p"),
    (page("<div id='cookie-notice'>We use</div><div><p>no article here</p></div><div class=sidebar>s</div>"), "no article here"),
    (page("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table><pre> e  f </pre></article>"), "a b c d e f"),
    (page("<article><p>1 < 2 and a<b</p></article>"), "1 < 2 and a"),
    (page("<article><p title='>'>q</p></article><article><p>r</p></article>"), "q r"),
    (page("<div class='has-sidebar no-comments' data-hidden='1'><article class='post with-banner'><div class='entry-header'><h1>T</h1></div><p>a</p><div class='articleFooter'>f</div></article></div>"), "T a"),
    (page("<section id='comments'><article class='comment'>c</article></section><article class='post'>a<div class='relatedPosts'>r</div></article>"), "a"),
    (page("<main><p>News.</p><div class='share-price'>Price rose.</div><div class='notice-period'>Thirty days.</div><div class='share-buttons'>Share</div></main>"), "News. Price rose. Thirty days."),
    (page("<div class='alert-system-article'><p>Alarms in towns.</p></div><div class='cookie_banner'>OK?</div><div class='relatedPosts'>more</div>"), "Alarms in towns."),
    (page("<main><p>a</p><article><p>b</p></article><div><article>c</article></div></main><main>d</main>"), "b c d"),
    (page("<article><p>a <!-- x > --> b<![CDATA[c]]><?d?>e</p></article>"), "a be"),
    (page("<ul><li><a href='/'>l</a></li></ul><div><p>body <a href='/'>link</a></p></div>"), "body link"),
    ("", ""),
    (None, ""),
    ("plain text", "plain text"),
    ("<p>unclosed <script>never ends", "unclosed"),
    ("</div></p>stray", "stray"),
]


def test_extraction():
    for html, text in CASES:
        assert m.extract(html) == text


def test_template_goes_and_slots_stay():
    made = lambda i: f"<html><body><div><p>Welcome to our site</p><div><p>story number {i} " + "word " * i + "</p></div><p>All rights reserved</p></div></body></html>"
    wrapper = m.induce([made(i) for i in range(8)])
    assert {wrapper.base.text[i] for i in wrapper.constant} == {"Welcome to our site", "All rights reserved"}
    assert m.extract(made(3), wrapper) == "story number 3 word word word"
    assert m.induce([made(1)] * 20) is None


def test_copies_of_an_article_are_no_template():
    pages = [page(f"<article><p>the same story</p></article><p>{'x' * i}</p>") for i in range(6)] + [page(f"<article><p>another story {i}</p></article>") for i in range(4)]
    wrapper = m.induce(pages)
    assert all(m.extract(p, wrapper) == m.extract(p) for p in pages)


def matching(x, y, i=0, j=0):
    """Simple tree matching as published, by plain recursion: the most node pairs of two trees (2 an element, 1 a text, 2 an equal one)."""
    if x.text[i] is not None or y.text[j] is not None:
        return 0 if x.text[i] is None or y.text[j] is None else 1 + (x.text[i].split() == y.text[j].split())
    if x.label[i] != y.label[j]:
        return 0
    a, b = x.kids[i], y.kids[j]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for p in range(len(a)):
        for q in range(len(b)):
            best[p + 1][q + 1] = max(best[p][q + 1], best[p + 1][q], best[p][q] + matching(x, y, a[p], b[q]))
    return 2 + best[-1][-1]


def test_alignment_against_plain_tree_matching():
    rng = random.Random(3)

    def tree(depth):
        if not depth or rng.random() < 0.25:
            return rng.choice(["same text", "other", prose(rng, 2)])
        return "".join(f"<{t}>{tree(depth - 1)}</{t}>" for t in (rng.choice(["div", "section", "b", "ul"]) for _ in range(rng.randint(1, 4))))

    for _ in range(60):
        x, y = (m.parse(tree(3)) for _ in range(2))
        pairs = m.aligned(x, y)
        assert all(" ".join(x.text[i].split()) == " ".join(y.text[j].split()) for i, j in pairs)
        # in order and one to one, and never more than the best matching holds
        assert [j for _, j in sorted(pairs)] == sorted({j for _, j in pairs}) and len({i for i, _ in pairs}) == len(pairs)
        assert 2 * len(pairs) <= matching(x, y)
    one = m.parse("<div><p>a</p><ul><li>x</li><li>y</li></ul><p>end</p></div>")
    two = m.parse("<div><ul><li>x</li><li>new</li><li>y</li></ul><p>more</p><p>end</p></div>")
    assert sorted(one.text[i] for i, _ in m.aligned(one, two)) == ["end", "x", "y"]


def test_deep_and_broken_pages_take_linear_time():
    start = time.process_time()
    assert m.extract("<div>" * 10_000 + "x" + "</div>" * 10_000) == "x"
    assert m.extract("<p>a</p>" + "<a " * 1_700_000).startswith("a")
    assert m.extract("<p>a</p>" + '<a "' * 1_250_000).startswith("a")
    assert m.extract("<p>a</p>" + "<a '\">" * 200_000) == "a"
    assert m.extract("<i><div>" + "<b>" * 20_000 + "x" + "</i>" * 20_000) == "x"
    assert m.extract("<ul><li>" * 10_000 + "x") == "x"
    assert m.extract("<!--" * 100_000 + "x") == ""
    deep = "<div>" * 10_000
    assert m.extract(deep + "own", m.induce([f"{deep}<p>same</p>{i}" for i in range(5)])) == "own"
    assert time.process_time() - start < 60


def site(rng, layout):
    """Pages of a host with what stays and what varies, and the text that each one's article has."""
    menu = "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in prose(rng, 6).split())
    hello, legal, box = (prose(rng, 8) for _ in range(3))
    for i in range(12):
        blocks = [prose(rng, rng.randint(5, 25)) for _ in range(rng.randint(1, 6))]
        extra = f"<div class='promo-box'>{prose(rng, 5)}</div>" if i % 3 == 0 else ""
        body = "".join(f"<p>{b}</p>" for b in blocks)
        if layout == 0:
            html = f"<html><body><div><ul>{menu}</ul><p>{hello}</p></div>{extra}<div id='text'>{body}</div><p>{legal}</p></body></html>"
        elif layout == 1:
            html = f"<html><body><section><h2>{hello}</h2></section><table><tr><td><ul>{menu}</ul></td><td>{body}</td></tr></table><div>{legal}<br>{box}</div>{extra}</body></html>"
        else:
            html = f"<html><body><div><p>{hello}</p></div><article>{body}<div><p>{box}</p></div></article><div>{legal}</div></body></html>"
        yield html, " ".join(blocks)


def test_sites_whose_articles_are_known(spark, monkeypatch):
    """Whole hosts, of one layout or of all, with the wrappers broadcast and joined: the text is exactly the article's."""
    rng = random.Random(21)
    rows, expected = [], {}
    for host in range(8):
        for layout in (0, 1, 2) if host > 4 else (host % 3,):
            for html, text in site(rng, layout):
                expected[len(rows)] = text
                rows.append((len(rows), f"http://h{host}.example/{len(rows)}", html))
                if rng.random() < 0.3:
                    expected[len(rows)] = text
                    rows.append((len(rows), f"http://h{host}.example/copy", html))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    assert {r.page_id: r.text for r in m.main_texts(df).collect()} == expected
    monkeypatch.setattr(m, "BROADCAST_BYTES", -1)
    assert {r.page_id: r.text for r in m.main_texts(df).collect()} == expected


def test_table(spark):
    rows = [(i, f"http://h{i % 2}.example.com/{i}", html, "t", "h") for i, (html, _) in enumerate(CASES)] + [(50, None, CASES[0][0], "t", "h"), (None, "http://h0.example.com/x", CASES[0][0], "t", "h"), (0, "http://h0.example.com/0", CASES[0][0], "t", "h"), (60, "http://h0.example.com/l", page("<article>" + "<p>long text</p>" * 20000 + "</article>"), "t", "h")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, template string, host string").repartition(3)
    got = m.counted(df).collect()
    assert len(got) == len(rows)
    for r in got:
        html = next(x[2] for x in rows if (x[0], x[1]) == (r.page_id, r.url))
        assert (r.text, r.n_chars) == (m.extract(html), len(m.extract(html)))
    assert m.counted(spark.createDataFrame([], df.schema)).count() == 0
    assert spark.range(1).select(m.host_of(__import__("pyspark").sql.functions.lit("HTTPS://u:p@Ex.COM:80/a"))).first()[0] == "ex.com"


def story(i, body, size=3):
    return f"<html><body>{body}<div class='text'>" + "".join(f"<p>story {i} line {j}</p>" for j in range(size)) + "</div></body></html>"


def test_every_page_of_a_host_counts(spark):
    """Hosts of mostly copies, of two layouts, of large pages, of many constants."""
    greet, other = "<div class='greet'>Welcome all</div>", "<section class='hi'>Hello there</section>"
    rows = [("copies", story(i if i < 40 else 0, greet), "story") for i in range(400)]
    rows += [("two", story(i, (greet, other)[i % 2]), f"story {i}") for i in range(40)]
    rows += [("inside", f"<html><body><section class='s{i % 2}'><article><p>Only here {i % 2}</p><p>story {i} in full length</p></article></section></body></html>", f"story {i} in full length") for i in range(20)]
    rows += [("large", story(i, greet, 1600), f"story {i}") for i in range(5)]
    rows += [("many", story(i, "".join(f"<div class='c{k}'>Constant {k}</div>" for k in range(600))), f"story {i}") for i in range(6)]
    df = spark.createDataFrame([(i, f"http://{host}.example/{i}", html) for i, (host, html, _) in enumerate(rows)], "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in m.main_texts(df).collect()}
    assert len(got) == len(rows)
    for i, (host, _, start) in enumerate(rows):
        assert not any(x in got[i] for x in ("Welcome", "Hello", "Only here", "Constant")), host
        assert got[i].startswith(start)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=40), st.lists(st.sampled_from("abcd"), max_size=40), st.sampled_from([1, 30, 1 << 20]))
def test_common_subsequences(a, b, bits):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    old, m.TABLE_BITS = m.TABLE_BITS, bits
    try:
        pairs = m.common(a, b)
    finally:
        m.TABLE_BITS = old
    assert len(pairs) == best[-1][-1] and all(a[i] == b[j] for i, j in pairs)
    assert all(i < k and j < n for (i, j), (k, n) in zip(pairs, pairs[1:], strict=False))


@pytest.mark.parametrize("items", [15, 21, 30, 500])
@pytest.mark.parametrize("depth", [0, 2])
def test_long_menus_are_template(spark, items, depth):
    """Of a menu of any length nothing is left, with an item more in front of every second page, one that varies at its end, and lists inside lists."""
    inner = "".join(f"<em>part {d}</em>" for d in range(depth))
    rows = []
    for i in range(10):
        menu = [f"<li><b>entry {k}</b>{inner}</li>" for k in range(items)]
        menu = (["<li><b>further</b></li>"] if i % 2 else []) + menu + [f"<li>last {i}</li>"]
        rows.append((i, f"http://long.example/{i}", f"<html><body><ul>{''.join(menu)}</ul><div>" + "".join(f"<p>story {i} says {j} of {i * 7 + j}</p>" for j in range(3)) + "</div></body></html>"))
    got = m.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    for r in got:
        assert f"story {r.page_id} says 0" in r.text and "entry" not in r.text and "part" not in r.text
        assert len(r.text.split()) <= 3 * 6 + 3, r.text
