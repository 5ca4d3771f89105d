"""Main text of web pages by wrapper induction.

1. ``parse`` makes a tree of a page's block elements; inline markup stays inside a block's text.  ``fold`` turns it into a
   tree of slots: siblings that repeat (paragraphs, items, rows) are one slot, so a page's *shape* has the size of its
   layout, not of its text.
2. Shapes are counted per host, and those of one host merged by simple tree matching: the order-preserving matching of two
   trees' children with the most matched nodes, the unmatched ones kept as optional.  Merging goes in rounds of at most
   ``fan_in`` shapes a task until each host has one template, so a host of any size is no bottleneck.
3. All pages are aligned with their host's template.  Counted over all pages: the texts of every single slot, and the
   text that every slot holds.  The most frequent text of a single slot is constant, that is template, if at least half of the pages have
   it (three at least, that differ in their longest text, so that copies of an article aren't taken for template).  The others vary.
4. The varying slots hold content where they are part of the page's article: below ``article`` or ``main``, else below the node
   to which most of the varying text leads.  Navigation, header, footer, sidebar, notice, advert, form and
   comment nodes (by element, role, or a word of class or id) vary too but are no part of it; such a name doesn't count on a
   node around the article (the ``article`` element, or most of the page's text).
5. The text of a page is that of its content slots in page order, whole, without the constant ones.

Pages are joined with wrappers by (host, salt), a host's salts growing with its pages; nothing is gathered by host but
counts and shapes.

Edge cases: null html is an empty text; null urls and urls without a host form one host; a host with one page has no
constants; a page without the host's content slots, or of a layout unlike it, is judged by itself; unclosed, misnested and truncated markup is read as
browsers do (paragraphs, items, rows and cells close themselves; unknown end tags are skipped); an unclosed script or
comment runs to the end of the page; a page of any length is read whole; each row gives a row, equal rows equal ones; null ids
stay; an empty table gives an empty result; columns other than id, url and html aren't read.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded, pieces, saved
from .registry import query

# Elements of HTML by how they behave.
BLOCKS = frozenset("""address article aside blockquote button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre section select summary table tbody td
    textarea tfoot th thead tr ul search datalist""".split())
NOT_NESTED = frozenset(["html", "head", "body"])
RAW = frozenset("script style title noscript template iframe svg canvas video audio object noframes noembed xmp".split())
VOID = frozenset(["hr"])
REPEATING = frozenset("p li tr td th dt dd h2 h3 h4 h5 h6 blockquote pre figure option #text".split())
# Start tags that close what is open, up to an element of the second set.
CLOSES = {"li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr", "table"), "td": ("td th", "tr table"),
          "th": ("td th", "tr table"), "thead": ("thead tbody tfoot", "table"), "tbody": ("thead tbody tfoot", "table"),
          "tfoot": ("thead tbody tfoot", "table"), "option": ("option", "select datalist"), "optgroup": ("optgroup option", "select")}
CLOSES = {tag: (frozenset(a.split()), frozenset(b.split())) for tag, (a, b) in CLOSES.items()}
CLOSES |= {tag: (frozenset([tag]), frozenset(["table", "td", "th"])) for tag in ("h1", "h2", "h3", "h4", "h5", "h6")}
SCOPE = frozenset("table td th caption button".split())
TABLE_PARTS = frozenset("table thead tbody tfoot tr td th caption".split())
# Names of page parts that are no article.
OTHER_TAGS = frozenset("nav footer aside form menu dialog select option button textarea datalist search legend fieldset".split())
OTHER_WORDS = frozenset("""nav navbar navigation menu submenu breadcrumb breadcrumbs masthead banner footer sidebar aside ad ads advert adverts
    advertisement advertising sponsor sponsored promo promoted promotion notice notices alert cookie cookies consent gdpr popup modal overlay
    newsletter subscribe subscription signup login share sharing social related
    recommended recommendations widget widgets toolbar pagination pager copyright contentinfo complementary search hidden""".split())
COMMENT_WORDS = frozenset("comment comments reply replies respond disqus discussion".split())
ARTICLE_WORDS = frozenset(["articlebody"])

_TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?/][^<>]*+>""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
_WORD = re.compile("[A-Z]?[a-z]+|[A-Z]+")
_NAMING = ("class", "id", "role", "itemprop")


class Node:
    __slots__ = ("tag", "label", "kids", "text", "links")

    def __init__(self, tag: str, label: str, text: str | None = None, links: int = 0):
        self.tag, self.label, self.kids, self.text, self.links = tag, label, [], text, links


@lru_cache(maxsize=4096)
def _label(tag: str, attributes: str) -> str:
    """``tag.word.role``: the first word of id or class, and what the names say (c: comments, o: other part, a: article, h: header)."""
    found, words = {}, []
    for m in _ATTRIBUTE.finditer(attributes):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    for name in _NAMING:
        words += [w.lower() for w in _WORD.findall(found.get(name, ""))]
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", ""):
        words.append("hidden")
    if not COMMENT_WORDS.isdisjoint(words):
        role = "c"
    elif tag in OTHER_TAGS or not OTHER_WORDS.isdisjoint(words):
        role = "o"
    elif tag in ("article", "main") or not ARTICLE_WORDS.isdisjoint(words) or found.get("role") in ("main", "article"):
        role = "a"
    else:
        role = "h" if tag == "header" or "header" in words else ""
    return f"{tag}.{words[0] if words and role != 'a' else ''}.{role}"


def parse(page: str) -> Node:
    """The tree of a page's block elements; texts are leaves, or children ``#text`` beside blocks."""
    root = Node("#page", "#page..")
    stack, text, links, in_link, at = [root], [], 0, False, 0

    def close_text():
        nonlocal links
        if text:
            words = " ".join("".join(text).split())
            if words:
                stack[-1].kids.append(Node("#text", "#text..", words, links))
            text.clear()
            links = 0

    def pop(to: int):
        close_text()
        while len(stack) > to:
            node = stack.pop()
            if len(node.kids) == 1 and node.kids[0].tag == "#text":
                node.text, node.links = node.kids[0].text, node.kids[0].links
                node.kids = []

    def add(chunk: str):
        nonlocal links
        if chunk:
            chunk = entities.unescape(chunk) if "&" in chunk else chunk
            text.append(chunk)
            if in_link:
                links += len(chunk)

    while (m := _TOKEN.search(page, at)) is not None:
        add(page[at:m.start()])
        at, tag = m.end(), m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "a":
                in_link = False
            elif tag in BLOCKS:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        pop(k)
                        break
                    if stack[k].tag in SCOPE and tag not in TABLE_PARTS:
                        break
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag == "a":
            in_link = True
        elif tag == "br":
            text.append(" ")
        elif tag in BLOCKS:
            for k in range(len(stack) - 1, 0, -1):  # an open paragraph ends where a block starts
                if stack[k].tag == "p":
                    pop(k)
                    break
                if stack[k].tag in SCOPE:
                    break
            if tag in CLOSES:
                closed, limit = CLOSES[tag]
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in limit:
                        break
                    if stack[k].tag in closed:
                        pop(k)
                        break
            close_text()
            if tag not in VOID:
                node = Node(tag, _label(tag, m[3]))
                stack[-1].kids.append(node)
                stack.append(node)
    add(page[at:])
    pop(1)
    close_text()
    return root


class Slot:
    """A place in a layout: its label, whether it repeats, how many pages have it, its children and, for a page, its texts."""
    __slots__ = ("label", "repeats", "pages", "kids", "texts", "id")

    def __init__(self, label, repeats, pages=1, kids=()):
        self.label, self.repeats, self.pages, self.kids, self.texts, self.id = label, repeats, pages, list(kids), [], -1

    def walk(self) -> Iterator[Slot]:
        yield self
        for k in self.kids:
            yield from k.walk()

    def as_list(self):
        return [self.label, int(self.repeats), self.pages, [k.as_list() for k in self.kids]]

    @staticmethod
    def of(made) -> Slot:
        return Slot(made[0], bool(made[1]), made[2], [Slot.of(k) for k in made[3]])


def fold(page: Node, most_alike: int = 8, deepest: int = 200) -> Slot:
    """The slots of a page, with (order, text, link characters) of their texts."""
    def into(slot: Slot, nodes: list[Node], depth: int):
        groups: dict = {}
        for node in nodes:
            if node.text is not None:
                slot.texts.append((numbers[id(node)], node.text, node.links))
            alike = Counter(k.label for k in node.kids)
            seen: Counter = Counter()
            for k in node.kids:
                many = slot.repeats or alike[k.label] > most_alike or (alike[k.label] > 1 and k.tag in REPEATING)
                groups.setdefault((k.label, -1 if many else seen[k.label]), []).append(k)
                seen[k.label] += 1
        for (label, at), found in groups.items():
            kid = Slot(label, at == -1)
            slot.kids.append(kid)
            if depth >= deepest:
                for n in found:
                    _texts_below(n, kid, numbers)
            else:
                into(kid, found, depth + 1)

    numbers, stack = {}, [page]
    while stack:  # texts are numbered in page order before slots part them
        n = stack.pop()
        if n.text is not None:
            numbers[id(n)] = len(numbers)
        stack += reversed(n.kids)
    root = Slot(page.label, False)
    into(root, [page], 0)
    return root


def _texts_below(node: Node, slot: Slot, numbers: dict) -> None:
    stack = [node]
    while stack:
        n = stack.pop()
        if n.text is not None:
            slot.texts.append((numbers[id(n)], n.text, n.links))
        stack += n.kids


def align(a: Slot, b: Slot, memo: dict) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching: the most nodes below a and b that match in order, and which children do."""
    known = memo.get((id(a), id(b)))
    if known is not None:
        return known
    n, m = len(a.kids), len(b.kids)
    weight = [[1 + align(x, y, memo)[0] if x.label == y.label else 0 for y in b.kids] for x in a.kids]
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1], (weight[i][j] + best[i + 1][j + 1]) if weight[i][j] else 0)
    pairs, i, j = [], 0, 0
    while i < n and j < m:
        if weight[i][j] and best[i][j] == weight[i][j] + best[i + 1][j + 1]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            i += 1
        else:
            j += 1
    memo[id(a), id(b)] = best[0][0], pairs
    return memo[id(a), id(b)]


def merge(a: Slot, b: Slot, memo: dict | None = None) -> Slot:
    """A template of both: matched slots once, the others in their places."""
    memo = {} if memo is None else memo
    out, i, j = Slot(a.label, a.repeats or b.repeats, a.pages + b.pages), 0, 0
    for x, y in [*align(a, b, memo)[1], (len(a.kids), len(b.kids))]:
        out.kids += a.kids[i:x] + b.kids[j:y]
        if x < len(a.kids):
            out.kids.append(merge(a.kids[x], b.kids[y], memo))
        i, j = x + 1, y + 1
    return out


def place(page: Slot, template: Slot) -> None:
    """Give a page's slots the numbers of the template's slots that they match."""
    memo: dict = {}

    def go(a, b):
        a.id = b.id
        for x, y in align(a, b, memo)[1]:
            go(a.kids[x], b.kids[y])
    go(page, template)


def numbered(template: Slot) -> Slot:
    for i, slot in enumerate(template.walk()):
        slot.id = i
    return template


def content(root: Slot, own: dict[int, int], links: dict[int, int]) -> set[int]:
    """The slots (by id) whose texts are the article, given the characters that vary, and those in links, by slot id."""
    total: dict[int, int] = {}

    def add(slot):
        total[slot.id] = own.get(slot.id, 0) + sum(map(add, slot.kids))
        return total[slot.id]
    whole = add(root)
    named = any(k.label.endswith(".a") for k in root.walk())

    def other(slot, inside):  # another part of the page, if the name can be believed
        role = slot.label.rsplit(".", 1)[1]
        if role != "o" and (role != "h" or inside):
            return role == "c"
        if named:
            return not any(k.label.endswith(".a") for k in slot.walk())
        return 2 * total[slot.id] < max(whole, 1)

    articles: list[Slot] = []

    def find(slot):
        if other(slot, False):
            return
        if slot.label.endswith(".a"):
            inner = [k for k in slot.walk() if k is not slot and k.label.endswith(".a")]
            deeper = max(inner, key=lambda k: total[k.id], default=None)
            articles.append(deeper if deeper is not None and 2 * total[deeper.id] > total[slot.id] else slot)
            return
        for k in slot.kids:
            find(k)
    find(root)
    top, sure = max(articles, key=lambda s: total[s.id], default=None), True
    if top is None or (not total[top.id] and whole):
        top, sure = root, False
        while True:
            inner = [k for k in top.kids if not other(k, False)]
            heaviest = max(inner, key=lambda k: total[k.id], default=None)
            if heaviest is None or not heaviest.kids or 5 * total[heaviest.id] < 3 * sum(total[k.id] for k in inner) + 3 * own.get(top.id, 0):
                break
            top = heaviest
    kept: set[int] = set()

    def keep(slot):
        kept.add(slot.id)
        for k in slot.kids:
            menu = not sure and total[k.id] and 2 * sum(links.get(s.id, 0) for s in k.walk()) > total[k.id]
            if not other(k, sure) and not menu:
                keep(k)
    keep(top)
    return kept


def text_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def masses(page: Slot) -> tuple[dict[int, int], dict[int, int]]:
    own, links = Counter(), Counter()
    for slot in page.walk():
        for _, text, n in slot.texts:
            own[slot.id] += len(text)
            links[slot.id] += n
    return own, links


class Wrapper:
    """What was learned of a host: its template, the constant texts by slot, and the slots of content."""

    def __init__(self, made: str):
        template, found = json.loads(made)
        self.template = numbered(Slot.of(template))
        self.constants = {(k, t) for k, texts, _, _ in found for t in texts}
        self.kept = content(self.template, {k: n for k, texts, n, _ in found}, {k: n for k, _, _, n in found})

    def text(self, html: str | None) -> str:
        page = fold(parse(html or ""))
        place(page, self.template)
        found = self._of(page, self.kept)
        if not found:  # a layout of its own
            numbered(page)
            found = self._of(page, content(page, *masses(page)), alone=True)
        return " ".join(t for _, t in sorted(found))

    def _of(self, page: Slot, kept: set[int], alone: bool = False) -> list[tuple[int, str]]:
        out = []

        def go(slot, inside):
            # what the template doesn't know goes with what is around it, unless its name says otherwise
            inside = slot.id in kept if slot.id >= 0 else inside and not slot.label.endswith((".o", ".c"))
            if inside:
                out.extend((at, t) for at, t, _ in slot.texts if alone or slot.repeats or (slot.id, text_hash(t)) not in self.constants)
            for k in slot.kids:
                go(k, inside)
        go(page, False)
        return out


def host_of(url: F.Column) -> F.Column:
    """The host of a URL in lower case, without port; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]*)", 1))


def _shapes(pages: DataFrame) -> DataFrame:
    """_host, shape (JSON), pages: how often each layout occurs."""
    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "_html"):
                made = [json.dumps(fold(parse(t or "")).as_list(), separators=(",", ":")) for t in piece.column("_html").to_pylist()]
                yield pa.RecordBatch.from_arrays([piece.column("_host"), pa.array(made, pa.string())], names=["_host", "shape"])
    return pages.select("_host", "_html").mapInArrow(run, "_host string, shape string").groupBy("_host", "shape").agg(F.count(F.lit(1)).alias("pages"))


def _weighted(made, n: int):
    """A shape's pages times n."""
    return [made[0], made[1], made[2] * n, [_weighted(k, n) for k in made[3]]]


def templates(pages: DataFrame, fan_in: int = 64) -> DataFrame:
    """_host, shape: one template per host, merged from all of its pages' layouts."""
    def run(key, rows):
        found = sorted(zip(rows.column("pages").to_pylist(), rows.column("shape").to_pylist(), strict=True), key=lambda x: (-x[0], x[1]))
        template = None
        for n, shape in found:
            slot = Slot.of(_weighted(json.loads(shape), n))
            template = slot if template is None else merge(template, slot)
        return pa.table({"_host": [key[0].as_py()], "shape": [json.dumps(template.as_list(), separators=(",", ":"))], "pages": pa.array([1], pa.int64())})

    left = saved(_shapes(pages))
    while True:
        counts = left.groupBy("_host").agg(F.ceil(F.count(F.lit(1)) / fan_in).alias("_tasks"))
        most = counts.agg(F.max("_tasks")).first()[0]
        dealt = left.join(counts, "_host").withColumn("_task", F.pmod(F.xxhash64("shape"), F.col("_tasks")))
        left = saved(dealt.select("_host", "_task", "shape", "pages").groupBy("_host", "_task").applyInArrow(run, "_host string, shape string, pages long"))
        if most is None or most <= 1:
            return left.select("_host", "shape")


def _joined(pages: DataFrame, hosts: DataFrame, column: str, salt_rows: int, most: int) -> DataFrame:
    """Pages with their host's ``column``; a host that has many pages has several keys."""
    sizes = saved(pages.groupBy("_host").agg(F.ceil(F.count(F.lit(1)) / salt_rows).cast("long").alias("_salts")))
    keyed = hosts.join(sizes, "_host").select("_host", column, "_salts", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1)).alias("_salt"))
    few = bounded(saved(keyed.select("_host", "_salt", column)), most)
    salted = pages.join(bounded(sizes, 100_000), "_host").withColumn("_salt", F.pmod(F.xxhash64("_id", "_url"), F.col("_salts"))).drop("_salts")
    return salted.join(few, ["_host", "_salt"]).drop("_salt")


def _observed(placed: DataFrame) -> DataFrame:
    """Per page and slot: the hash of a single slot's text and of the page's longest text, and the characters held."""
    def run(batches):
        cache: dict[str, Slot] = {}
        for batch in batches:
            for piece in pieces(batch, "_html"):
                out = []
                for host, html, made in zip(*(piece.column(c).to_pylist() for c in ("_host", "_html", "shape")), strict=True):
                    if made not in cache:
                        if len(cache) >= 256:
                            cache.clear()
                        cache[made] = numbered(Slot.of(json.loads(made)))
                    page = fold(parse(html or ""))
                    place(page, cache[made])
                    slots = [s for s in page.walk() if s.texts and s.id >= 0]
                    longest = text_hash(max((t for s in slots for _, t, _ in s.texts), key=lambda t: (len(t), t), default=""))
                    for s in slots:
                        single = not s.repeats and len(s.texts) == 1
                        out.append((host, s.id, text_hash(s.texts[0][1]) if single else None, longest if single else None,
                                    sum(len(t) for _, t, _ in s.texts), sum(n for _, _, n in s.texts)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 6, (
                    pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["_host", "slot", "text", "longest", "chars", "links"])
    return placed.select("_host", "_html", "shape").mapInArrow(run, "_host string, slot int, text long, longest long, chars long, links long")


def induce(pages: DataFrame, share: float = 0.5, least: int = 3, salt_rows: int = 5_000, most_hosts: int = 20_000) -> DataFrame:
    """_host and wrapper (JSON): the template with, by slot, its constant texts and the characters that vary, from all pages."""
    made = templates(pages)
    observed = _observed(_joined(pages, made, "shape", salt_rows, most_hosts))
    # pages that differ in their longest text, per text of a slot and per slot
    texts = observed.groupBy("_host", "slot", "text", "longest").agg(F.sum("chars").alias("chars"), F.sum("links").alias("links"))
    texts = texts.groupBy("_host", "slot", "text").agg(F.count("longest").alias("n"), F.sum("chars").alias("chars"), F.sum("links").alias("links"))
    # the most frequent text by aggregates alone: a slot of a hot host is combined where its rows are
    top = F.max(F.when(F.col("text").isNotNull(), F.struct("n", "text", "chars", "links")))
    slots = texts.groupBy("_host", "slot").agg(F.sum("n").alias("_all"), F.sum("chars").alias("chars"), F.sum("links").alias("links"), top.alias("_top"))
    constant = F.coalesce((F.col("_top.n") >= least) & (F.col("_top.n") >= share * F.col("_all")), F.lit(False))
    per_slot = slots.select("_host", "slot", F.when(constant, F.array("_top.text")).otherwise(F.array().cast("array<bigint>")).alias("texts"),
                            *[(F.col(c) - F.when(constant, F.col(f"_top.{c}")).otherwise(0)).alias(c) for c in ("chars", "links")])
    found = per_slot.groupBy("_host").agg(F.sort_array(F.collect_list(F.struct("slot", "texts", "chars", "links"))).alias("_found"))
    rows = F.concat(F.lit("["), F.array_join(F.transform("_found", lambda x: F.concat(
        F.lit("["), x["slot"].cast("string"), F.lit(","), F.to_json(x["texts"]), F.lit(","), x["chars"].cast("string"), F.lit(","),
        x["links"].cast("string"), F.lit("]"))), ","), F.lit("]"))
    return made.join(found, "_host", "left").select("_host", F.concat(F.lit("["), "shape", F.lit(","), F.coalesce(rows, F.lit("[]")), F.lit("]")).alias("wrapper"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", salt_rows: int = 5_000,
            most_hosts: int = 20_000) -> DataFrame:
    """Per row: id, url, text (the page's article as one line, empty if none) and n_chars (its code points)."""
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.coalesce(F.col(html_col), F.lit("")).alias("_html"),
                        host_of(F.col(url_col)).alias("_host"))
    wrappers = saved(induce(rows, salt_rows=salt_rows, most_hosts=most_hosts))
    schema = T.StructType([T.StructField("_id", rows.schema["_id"].dataType), T.StructField("_url", T.StringType()),
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches):
        cache: dict[str, Wrapper] = {}
        for batch in batches:
            for piece in pieces(batch, "_html"):
                texts = []
                for html, made in zip(piece.column("_html").to_pylist(), piece.column("wrapper").to_pylist(), strict=True):
                    if made not in cache:
                        if len(cache) >= 256:
                            cache.clear()
                        cache[made] = Wrapper(made)
                    texts.append(cache[made].text(html))
                yield pa.RecordBatch.from_arrays([piece.column("_id"), piece.column("_url"), pa.array(texts, pa.string()),
                                                  pa.array(list(map(len, texts)), pa.int64())], names=schema.names)

    out = _joined(rows, wrappers, "wrapper", salt_rows, most_hosts).select("_id", "_url", "_html", "wrapper").mapInArrow(run, schema)
    return out.select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), "text", "n_chars")


#: DuckDB, for pages whose article is one ``article`` element without other parts inside and few kinds of character references, as in
#: the given tables.  Nothing of this is used above.
SQL = r"""
with a as (select page_id, url, regexp_extract(coalesce(html, ''), '<article[^>]*>(.*?)(</article>|$)', 1, 's') as t from pages),
b as (select page_id, url, trim(regexp_replace(regexp_replace(regexp_replace(t, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) as t from a),
c as (select page_id, url, regexp_replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;?', '&', 'g') as text from b)
select page_id, url, text, length(text) as n_chars from c"""


@query("op12_html_wrappers", SQL)
def op12(spark, sf_dir):
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
