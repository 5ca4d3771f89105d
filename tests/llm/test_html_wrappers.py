import html as entities
import random
import re

import pytest

from weekcast.llm import html_wrappers as h

from .conftest import sentence


def alone(page):
    """The text of a page that is the only one of its host."""
    return next(iter(run_plain([(1, "http://x.org/1", page)]).values()))


def run_plain(rows):
    """The same steps by loops over all pages of a host, without Spark: id -> text."""
    hosts = {}
    for i, url, page in rows:
        m = re.match(r"\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]*)", url or "")
        hosts.setdefault(m[1].lower() if m else "", []).append((i, page or ""))
    out = {}
    for pages in hosts.values():
        template = None
        for _, p in pages:
            shape = h.fold(h.parse(p))
            template = shape if template is None else h.merge(template, shape)
        template = h.numbered(h.Slot.of(template.as_list()))
        seen, chars, links = {}, {}, {}
        for _, p in pages:
            page = h.fold(h.parse(p))
            h.place(page, template)
            slots = [s for s in page.walk() if s.texts and s.id >= 0]
            longest = max((t for s in slots for _, t, _ in s.texts), key=lambda t: (len(t), t), default="")
            for s in slots:
                key = s.texts[0][1] if not s.repeats and len(s.texts) == 1 else None
                if key is not None:
                    seen.setdefault(s.id, {}).setdefault(key, set()).add(longest)
                for into, n in ((chars, sum(len(t) for _, t, _ in s.texts)), (links, sum(n for _, _, n in s.texts))):
                    into.setdefault(s.id, {}).setdefault(key, 0)
                    into[s.id][key] += n
        top = {k: max(texts, key=lambda t: (len(texts[t]), h.text_hash(t))) for k, texts in seen.items()}
        constant = {(k, t) for k, t in top.items() if len(seen[k][t]) >= 3 and 2 * len(seen[k][t]) >= sum(map(len, seen[k].values()))}
        vary = lambda found: {k: sum(n for t, n in by.items() if (k, t) not in constant) for k, by in found.items()}
        kept = h.content(template, vary(chars), vary(links))
        w = h.Wrapper.__new__(h.Wrapper)
        w.template, w.kept, w.constants = template, kept, {(k, h.text_hash(t)) for k, t in constant}
        out.update((i, w.text(p)) for i, p in pages)
    return out


def spark_texts(spark, rows, **more):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in h.extract(df, **more).collect()}


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), ("plain words", "plain words"), ("<p>a<p>b<ul><li>c<li>d</ul>e", "a b c d e"),
    ("<article><p>fo<b>o</b>\n  bar&amp;baz &eacute;&#233;&#x41;&nbsp;x<br>y</p></article>", "foo bar&baz ééA x y"),
    ("<article><p>one</article><footer>no</footer>", "one"), ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a b c"),
    ("<article>x<script>var t='</p><p>no';</script>y<style>p{}</style><!-- no <p>no</p> --></article>", "xy"),
    ("<article><p>a <a href='x>y'>link</a> b</p></article></div></b>", "a link b"), ("<article><p>cut off <b>here", "cut off here"),
    ("<article>a<script>never closed <p>no", "a"), ("<article>1 < 2 and 3 > 2</article>", "1 < 2 and 3 > 2"), ("<article><h1>T</h1><p>a</p></article>", "T a"),
    ("<ARTICLE CLASS=x><P>Up</P></ARTICLE>", "Up"), ("<article><p>a</p><section class='reader-comments'><p>no</p></section></article>", "a"),
    ("<article><p>text of the page</p><div class='ad'>buy</div><form><input><button>Go</button></form><aside>no</aside><p>more</p></article>", "text of the page more"),
    ("<article><header><h1>Title</h1></header><p>body</p></article><header>no</header>", "Title body"),
    ("<div hidden>no no</div><div style='display: none'>no no</div><div><p>some text that is seen</p><p>more</p></div>", "some text that is seen more"),
])
def test_pages(page, text):
    assert alone(page) == text


def soup(i, rng):
    """A page without elements or names that say what is what: (html, main text)."""
    paragraphs = [sentence(1000 * i + k, rng.randint(8, 60)) for k in range(rng.randint(2, 9))]
    menu = "".join(f"<td><a href='/{k}'>{sentence(k, 2)}</a></td>" for k in range(5))
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    note = "<div><i>Read our terms before you copy anything from here.</i></div>"
    page = (f"<html><body><table><tr>{menu}</tr></table><div><div>Welcome to the daily news</div><div><h2>{sentence(i, 4)}</h2>{body}{note}</div>"
            f"<div>Visitors today: {i}</div></div><div>All rights reserved</div></body></html>")
    return page, " ".join([sentence(i, 4), *paragraphs])


def test_constant_nodes_are_template_without_any_names(spark):
    rng = random.Random(3)
    made = [soup(i, rng) for i in range(12)]
    rows = [(i, f"http://soup.org/{i}", page) for i, (page, _) in enumerate(made)]
    assert run_plain(rows) == {i: text for i, (_, text) in enumerate(made)} == spark_texts(spark, rows)


def test_copies_of_an_article_are_no_template(spark):
    def page(nav, body):
        return f"<nav>{nav}</nav><article><h1>Same title</h1><div>{body}</div></article><footer>f</footer>"
    body = sentence(5, 90)
    rows = [(i, "http://copies.org/x", page(i, body)) for i in range(20)] + [(30, "http://copies.org/y", page(1, sentence(6, 70)))]
    got = spark_texts(spark, rows)
    assert all(got[i] == f"Same title {body}" for i in range(20)) and got[30] == f"Same title {sentence(6, 70)}" and got == run_plain(rows)


def test_a_constant_notice_inside_the_article(spark):
    rows = [(i, "http://n.org/x", f"<article><h2>{sentence(i, 3)}</h2><div>Please support our work today.</div><p>{sentence(i + 50, 40)}</p></article>") for i in range(6)]
    assert spark_texts(spark, rows) == {i: f"{sentence(i, 3)} {sentence(i + 50, 40)}" for i in range(6)} == run_plain(rows)


def test_two_layouts_of_one_host(spark):
    rows = [(i, "http://two.org/x", f"<div class=menu>m</div><main><p>{sentence(i, 30)}</p></main>") for i in range(5)]
    rows += [(10 + i, "http://two.org/y", f"<div id=story><p>{sentence(i + 20, 30)}</p><p>{sentence(i, 9)}</p></div><div class=sidebar>s</div>") for i in range(2)]
    got = spark_texts(spark, rows)
    assert got == {**{i: sentence(i, 30) for i in range(5)}, **{10 + i: f"{sentence(i + 20, 30)} {sentence(i, 9)}" for i in range(2)}}


def test_matching_is_the_largest():
    rng = random.Random(1)

    def tree(depth):
        return h.Slot(rng.choice("ab"), False, 1, [tree(depth - 1) for _ in range(rng.randint(0, 3))] if depth else [])

    def most(a, b):  # all ways of matching the children in order
        def rest(x, y):
            if not x or not y:
                return 0
            take = 1 + most(x[0], y[0]) + rest(x[1:], y[1:]) if x[0].label == y[0].label else 0
            return max(take, rest(x[1:], y), rest(x, y[1:]))
        return rest(a.kids, b.kids)
    for _ in range(100):
        a, b = tree(3), tree(3)
        assert h.align(a, b, {})[0] == most(a, b)
        merged = h.merge(a, b)
        size = lambda t: sum(1 for _ in t.walk())
        assert size(merged) == size(a) + size(b) - most(a, b) - 1


def test_edges(spark):
    page = "<nav>n</nav><article><p>text é</p></article>"
    rows = [(1, None, page), (2, "not a url", page), (3, "http://a.org", None), (4, "http://a.org", ""), (None, "HTTP://A.ORG:80/x", page), (5, "//b.org", page),
            (5, "//b.org", page), (6, "http://a.org", "<div>" * 3000 + "deep" + "</div>" * 10), (7, "http://a.org", "<p>" + "word " * 200_000),
            (8, "http://c.org", "<a <a \"<a '" * 2000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as _host", "1 as text", "2 as shape", "3 as _salt")
    got = {(r["page_id"], r["url"]): (r["text"], r["n_chars"]) for r in h.extract(df).collect()}
    assert got[1, None] == got[5, "//b.org"] == got[None, "HTTP://A.ORG:80/x"] == ("text é", 6) and got[3, "http://a.org"] == got[4, "http://a.org"] == ("", 0)
    assert got[6, "http://a.org"] == ("deep", 4) and got[7, "http://a.org"][1] == 5 * 200_000 - 1
    assert h.extract(df).count() == len(rows) and h.extract(df.limit(0)).collect() == []


def test_rounds_and_shuffled_joins_give_the_same(spark):
    rng = random.Random(4)
    rows = [(i, f"http://h{i % 2}.org/{i}", soup(i, rng)[0].replace("<i>", "<section>" * (i % 7))) for i in range(24)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = df.selectExpr("page_id as _id", "url as _url", "html as _html", "concat('h', page_id % 2, '.org') as _host")
    assert h.templates(pages, fan_in=2).count() == 2
    few = {r["page_id"]: r["text"] for r in h.extract(df, salt_rows=3, most_hosts=0).collect()}
    assert few == spark_texts(spark, rows) == run_plain(rows)


def test_query_against_the_article_element(spark):
    got = {r["page_id"]: r for r in h.op12(spark, "/root/testdata/sf0.001").collect()}
    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        want = " ".join(entities.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner))).split())
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want) and got[r["page_id"]]["url"] == r["url"]
