"""HTML extraction: element subtrees that recur on many pages of a host are templates and are deleted.

Pages are parsed in Arrow functions; every element outside the article gets a hash of its subtree (tag,
attributes without addresses, text, children). Spark counts, for each (host, hash), the different main texts
beside which the subtree stands: the longest piece of text of the page outside of it, lists and links left out. So near
copies of a page count once, and what recurs only with them is their own text; nor is a subtree counted that holds most of
a page's text and is long enough for an article. A subtree beside MIN_PAGES main texts of its host or more
goes, however many pages the host has, and so does one beside all of a smaller host's, LEAST_PAGES at least. Elements
whose tag, role or class says menu, header, footer, sidebar, notice, advert, form, script, style or reader comments
go too; inside an article only class words for adverts and comments count. What
is left is decoded, white space (of ASCII; a no-break or wide space is a character) becomes one space, and
the blocks are joined by one space in page order.
"""

from __future__ import annotations

import hashlib
import html as _html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyflow.llm.common import join_groups, materialize, text_of, tune
from skyflow.llm.url_filter import split_url

MIN_PAGES, LEAST_PAGES = 5, 3
#: Characters from which a subtree with most of a page's text is its article.
ARTICLE_CHARS = 60
#: Templates up to which their list is broadcast (8 bytes each); longer lists are joined by shuffle, hot hosts apart.
BROADCAST_TEMPLATES = 1_000_000

# Fixed values of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea title svg iframe".split())
_INLINE = frozenset("a abbr acronym area b bdi bdo big cite code data del dfn em embed font i img input ins kbd label mark q s samp small span strike strong source sub sup time track tt u var wbr math mi mn mo mrow ms msup msub msubsup mfrac msqrt mroot mtext mover munder semantics".split())
_DROP_TAGS = frozenset("head nav footer aside form button select option dialog menu canvas audio video".split()) | _RAW
_DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
_MAIN = frozenset(("article", "main"))
_ASIDE = ("nav", "footer", "aside", "form", "header", "head", "li", "a")  # their texts are no page's main text
_CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_DROP_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo menu nav navbar navigation breadcrumb breadcrumbs sidebar footer header masthead cookie cookies consent gdpr notice notices notification alert popup modal "
    "overlay newsletter subscribe subscription signup login search share sharing social related recommended comment comments disqus pagination pager toolbar widget skip".split()
)

#: Those that count inside an article, where notices, related parts or searches may be what it is about.
_DROP_WORDS_INSIDE = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo comment comments disqus".split())

#: In a class or id these words behind a word of _DROP_WORDS name its box; the last word says what the element is.
_BOX_WORDS = frozenset("area bar block body bottom box button buttons col column container content group holder inner item items left link links list message outer pane panel region right row section slot strip text top unit wrap wrapper".split())
_MODIFIERS = frozenset("has is no non not with without".split())

# a quote counts only behind an equals sign; anywhere else it is a character of the tag
_PIECE = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACES = re.compile(r"[ \t\n\r\f]+")
_NAMES = re.compile(r"[a-z]+")


class Node:
    """An element; ``inside`` an article, or one that ``holds`` an article; of the page's main texts it has those from
    ``first`` to before ``last``. A root has them all in ``texts``."""

    __slots__ = ("attrs", "first", "holds", "inside", "kids", "last", "tag", "texts")

    def __init__(self, tag: str, attrs: dict[str, str], inside: bool, first: int):
        self.tag, self.attrs, self.inside, self.holds, self.kids, self.first, self.last = tag, attrs, inside, False, [], first, first


def parse(page: str) -> Node:
    """A tree of elements and texts at any depth; end tags that match nothing are ignored, open elements end with the page."""
    root, texts = Node("", {}, False, 0), []
    stack, at, marked = [root], 0, 0  # the first ``marked`` of the stack hold an article
    is_open: dict[str, int] = {}

    def close(k: int) -> None:
        nonlocal marked
        for n in stack[k:]:
            is_open[n.tag] -= 1
            n.last = len(texts)
        del stack[k:]
        marked = min(marked, k)

    def add(text: str) -> None:
        stack[-1].kids.append(text)
        if (own := text.strip()) and not any(is_open.get(t) for t in _ASIDE):
            texts.append(own)

    while m := _PIECE.search(page, at):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if is_open.get(tag):
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
            continue
        same = "li" if tag == "li" else "p"
        if (tag in _CLOSES_P or tag == "li") and is_open.get(same):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == same:
                    close(k)
                    break
                if stack[k].tag not in _INLINE and stack[k].tag != "p":
                    break
        attrs = {a[1].lower(): next((x for x in a.groups()[1:] if x is not None), "") for a in _ATTR.finditer(m[3])} if m[3] else {}
        node = Node(tag, attrs, stack[-1].inside or tag in _MAIN, len(texts))
        if tag in _MAIN:
            for n in stack[marked:]:
                n.holds = True
            marked = len(stack)
        stack[-1].kids.append(node)
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            node.kids.append(page[at : end.start() if end else len(page)])
            at = end.end() if end else len(page)
        elif tag not in _VOID and not m[3].endswith("/"):
            stack.append(node)
            is_open[tag] = is_open.get(tag, 0) + 1
    if at < len(page):
        add(page[at:])
    for n in stack:
        n.last = len(texts)
    root.texts = texts
    return root


def _names_furniture(name: str, drop: frozenset[str]) -> bool:
    """Whether a class or id names furniture: its last word does, or an earlier one before words for a box."""
    words = _NAMES.findall(name)
    if not words or words[0] in _MODIFIERS:
        return False
    while len(words) > 1 and words[-1] in _BOX_WORDS:
        words.pop()
    return words[-1] in drop


def is_furniture(node: Node) -> bool:
    """Whether tag, role, class or id say that this is not the article."""
    if node.tag in _DROP_TAGS or node.tag == "header" and not node.inside or node.attrs.get("role", "").lower() in _DROP_ROLES or "hidden" in node.attrs:
        return True
    if node.holds or node.tag in _MAIN or node.tag in ("body", "html"):
        return False
    drop = _DROP_WORDS_INSIDE if node.inside else _DROP_WORDS
    return any(_names_furniture(n, drop) for n in f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}".lower().split())


def subtree_hashes(root: Node) -> list[tuple[Node, int]]:
    """Every element that could be a template, outside the article and not around it, with its subtree's hash."""
    out: list[tuple[Node, int]] = []
    upto = [0]
    for text in root.texts:
        upto.append(upto[-1] + len(text))
    hashes: dict[int, int] = {}
    todo = [(root, False)]
    while todo:
        node, done = todo.pop()
        if not done:
            todo.append((node, True))
            todo.extend((k, False) for k in node.kids if not isinstance(k, str))
            continue
        parts = [node.tag, *(f"{k}={v}" for k, v in sorted(node.attrs.items()) if k in ("class", "id", "role"))]
        parts += [_SPACES.sub(" ", k) if isinstance(k, str) else str(hashes.pop(id(k))) for k in node.kids]
        h = _hash("\x1f".join(parts))
        hashes[id(node)] = h
        own = upto[node.last] - upto[node.first]
        article = own >= ARTICLE_CHARS and 2 * own > upto[-1]
        if node.tag and not article and not node.inside and node.tag not in ("html", "body") and node.tag not in _RAW and not node.holds:
            out.append((node, h))
    return out


def extract(root: Node, gone: set[int]) -> str:
    """Text of what is neither furniture nor template (``gone``: ids of template nodes)."""
    blocks, line = [], []

    def end_block() -> None:
        if line:
            if text := _SPACES.sub(" ", _html.unescape("".join(line))).strip(" "):
                blocks.append(text)
            line.clear()

    todo: list = [root]
    while todo:
        x = todo.pop()
        if x is None:
            end_block()
        elif isinstance(x, str):
            line.append(x)
        elif id(x) not in gone and not is_furniture(x):
            block = x.tag not in _INLINE
            if block:
                end_block()
                todo.append(None)
            todo.extend(reversed(x.kids))
    end_block()
    return " ".join(blocks)


def _with_host(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    return pages.select(pages[id_col].alias("id"), pages[url_col].alias("url"), split_url(pages[url_col].cast("string"))[0].alias("host"), text_of(pages, html_col).alias("html"))


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


class MainTexts:
    """Hashes of the longest of a page's main texts outside a subtree."""

    def __init__(self, root: Node):
        self.texts, n, self.known = root.texts, len(root.texts), {}
        longer = lambda i, j: j if i < 0 or len(self.texts[j]) > len(self.texts[i]) else i
        self.before, self.after = [-1] * (n + 1), [-1] * (n + 1)
        for k in range(n):
            self.before[k + 1] = longer(self.before[k], k)
            self.after[n - 1 - k] = longer(self.after[n - k], n - 1 - k)

    def outside(self, first: int, last: int) -> int:
        i, j = self.before[first], self.after[last]
        k = i if j < 0 or i >= 0 and len(self.texts[i]) >= len(self.texts[j]) else j
        if k not in self.known:
            self.known[k] = _hash(_SPACES.sub(" ", self.texts[k])) if k >= 0 else 0
        return self.known[k]


def template_hashes(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, hash) of subtrees beside at least ``min_pages`` different main texts of their host, or beside all of a host with fewer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: set[tuple[str, int | None, int]] = set()
            for host, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                root = parse(page)
                main = MainTexts(root)
                seen.update((host, h, main.outside(n.first, n.last)) for n, h in subtree_hashes(root))
                seen.add((host, None, main.outside(0, 0)))  # stands for the host
            hosts, hashes, mains = zip(*seen) if seen else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(hashes, pa.int64()), pa.array(mains, pa.int64())], ["host", "hash", "main"])

    found = pages.select("host", "html").mapInArrow(run, "host string, hash bigint, main bigint").distinct().groupBy("host", "hash").agg(F.count("*").alias("n"))
    counts = materialize(found.filter(F.col("n") >= min(LEAST_PAGES, min_pages)), "html-counts")
    often = counts.filter((F.col("n") >= min_pages) & F.col("hash").isNotNull()).select("host", "hash")
    seldom = counts.filter((F.col("n") < min_pages) & F.col("hash").isNotNull())
    sizes = seldom.groupBy("host").agg(F.count("*").alias("rows")).join(counts.filter("hash is null").select("host", F.col("n").alias("texts")), "host")
    sizes = materialize(sizes.filter(F.col("texts") < min_pages), "html-small-hosts")
    everywhere = join_groups(seldom, sizes, "host", "rows", sizes.agg(F.sum("rows")).first()[0] or 0).filter("n = texts")
    return often.unionByName(everywhere.select("host", "hash"))


def _with_templates(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows with the templates of their host. Pages move only where the list of all templates is too long to broadcast."""
    by_host = materialize(known.groupBy("host").agg(F.collect_set("hash").alias("templates")), "html-templates")
    if (by_host.agg(F.sum(F.size("templates"))).first()[0] or 0) <= BROADCAST_TEMPLATES:
        return rows.join(F.broadcast(by_host), "host", "left")
    sizes = materialize(rows.groupBy("host").agg(F.count("*").alias("pages")), "html-hosts")
    every = sizes.join(by_host, "host", "left")
    return join_groups(rows, every, "host", "pages", sizes.agg(F.sum("pages")).first()[0])


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_pages: int = MIN_PAGES) -> DataFrame:
    """The main text of every page.

    Returns one row for each input row: the id, the url, ``text``, ``n_chars`` (code points). Null and
    empty pages give an empty text; pages without a host (null url) are counted as one host. Repeated rows
    stay and count each; a page cut off anywhere is parsed as far as it goes. Template removal never
    touches what is inside an article element, and a page that it would leave empty, such as one of many
    copies of a page, keeps its text. An empty table gives an empty result; other columns are
    ignored.
    """
    tune(pages.sparkSession)
    rows = _with_host(pages, id_col, url_col, html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = []
            for page, templates in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                root, known = parse(page), set(templates or ())
                gone = {id(n) for n, h in subtree_hashes(root) if h in known} if known else set()
                text.append(extract(root, gone) or (extract(root, set()) if gone else ""))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], ["id", "url", "text", "n_chars"])

    kind = pages.schema[id_col].dataType.simpleString()
    out = _with_templates(rows, template_hashes(rows, min_pages)).select("id", "url", "html", "templates").mapInArrow(run, f"id {kind}, url string, text string, n_chars bigint")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
