"""Operator 8: main text of web pages, by site style trees.

The pages of one host are merged into a style tree. A node of the tree is a path of
elements (tag and class names) from the root; every distinct page of the host adds to
it the way the node is laid out there (the sequence of its children) and what it says
(its whole text). With m pages the node's importance is the larger of the two entropies
-sum p_i log_m p_i: near 0 for a branch that looks and reads the same everywhere, near 1
for one that is different on each page, and 1 if there is but one page. Branches of
low importance are removed from each page, topmost first.

Entropy alone can't give the wanted article: a menu, an advert or a footer whose words
change from page to page is as important to it as the article. So what an element says
about itself counts too: landmarks, forms, hidden parts, scripts, and class names or
roles of menus, notices, adverts, comments and the like are removed, and where a page
marks its article or main part, only that is read. A class name doesn't count where its
element holds the page's article or most of the text (`has-sidebar`, `widget`); then
importance alone decides. Where a page would be left without
any text, its low-importance branches stay (copies of one article on one host).

A branch goes only where it says what it often says: a content that m pages have with
share p stays unless -log_m p, its part of the entropy, is below the same bound. An
article that stands where most pages of its host have copies of another one stays whole.
Pages count once if the blocks that make up most of their article are the same (what they
mark as one, or else their paragraphs; without either, the html), so near copies that
differ in an advert, a date or a link don't make an article look like a footer.

Two passes parse the pages: one sends a few hashes per page and node, the other cuts.
Rows are dealt by (host, node, value), and a host's list of removable contents is joined
to its pages.

Defined results: a null html is empty; a null or odd url is a host of its own (''),
and pages are never matched by page_id, so nulls and repeats there do no harm; broken
markup is read as far as it goes; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailmeter.llm.common import stored

#: Below this importance a branch is removed, if so many distinct pages have it.
MIN_IMPORTANCE = 0.15
MIN_PAGES = 5
#: Pages are copies if the longest blocks that make up this share of their text agree.
SAME_SHARE = 0.75

# Names of the HTML standard, and words of common class names.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe xmp noembed noframes".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rp"
    " rt s samp small span strike strong sub sup time tt u var wbr".split()
)
ENDS_PARAGRAPH = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table"
    " ul".split()
)
ENDED_BY = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
    "tbody": {"thead", "tr", "td", "th"},
}
SCOPES = set("table ul ol dl div article section main body html td th".split())
DROPPED_TAGS = set(
    "head nav footer aside form button select input textarea script style noscript template iframe"
    " svg canvas object embed audio video map dialog menu datalist".split()
)
ARTICLE_TAGS = {"article", "main"}
DROPPED_ROLES = set(
    "navigation banner complementary contentinfo search form alert alertdialog dialog menu menubar"
    " toolbar tablist status".split()
)
DROPPED_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promoted"
    " promotion nav navbar navigation menu menus submenu breadcrumb breadcrumbs sidebar sidebars"
    " aside footer foot cookie cookies consent gdpr newsletter subscribe subscription signup login"
    " share sharing social comment comments commentlist disqus reply replies respond related"
    " recommended popup modal overlay paywall pagination pager toolbar masthead topbar notice"
    " notices notification alert skip copyright widget widgets teaser".split()
)
WEAK_WORDS = {"header", "head", "banner", "legal", "disclaimer", "tags", "meta", "search", "form"}
#: What readers wrote may be most of a page and still be no part of its article.
REPLY_WORDS = set("comment comments commentlist disqus reply replies respond".split())
#: An element that a class name would drop stays if it holds so much of the text (that it
#: stands for the page, whatever its length; that it does so from some length on).
ALL_SHARE, MOST_SHARE, MOST_CHARS = 0.9, 0.5, 200
CONTENT_WORDS = set("article content post entry story main body text maincontent".split())

# No alternative gives anything back: a quote opens a value if it is closed anywhere behind,
# else it stands for itself, so a markup token is read once.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)"
    r"(?P<attrs>(?>[^>\"'/]++|\"[^\"]*+\"|'[^']*+'|[\"']|/(?!>))*+)(?P<self>/?)>",
    re.S,
)
#: A tag whose quotes hide its end: it ends at the next `>`.
_BROKEN = re.compile(
    r"<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>[^>]*?)(?P<self>/?)>(?P<cdata>(?!))?", re.S
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class Node:
    __slots__ = (
        "tag", "words", "parent", "children", "drop", "named", "main", "article", "path", "inside"
    )

    def __init__(self, tag: str, words: tuple[str, ...], parent: Node | None):
        self.tag = tag
        self.words = words
        self.parent = parent
        self.children: list[Node | str] = []
        # named: dropped by a class name only; main: says that it is an article
        self.drop = self.named = self.main = self.article = False
        self.inside = parent is not None and (parent.main or parent.inside)
        self.path = 0


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    if text:
        for m in _ATTRIBUTE.finditer(text):
            found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return found


def _judge(node: Node, attrs: dict[str, str]) -> None:
    """Whether the element says that it is no part of an article, or that it is one."""
    tag, words = node.tag, set(node.words)
    role = attrs.get("role", "").lower()
    if tag in ("html", "body"):
        return
    node.drop = (
        tag in DROPPED_TAGS
        or (tag == "header" and not node.inside)
        or role in DROPPED_ROLES
        or "hidden" in attrs
        or attrs.get("aria-hidden", "").lower() == "true"
        or bool(_HIDDEN.search(attrs.get("style", "").lower()))
    )
    is_article = tag in ARTICLE_TAGS or role in ("main", "article")
    if words and not node.drop:
        strong = bool(words & DROPPED_WORDS)
        weak = bool(words & WEAK_WORDS) and not words & CONTENT_WORDS
        node.named = (strong and not (is_article and tag == "main")) or (weak and not is_article)
    node.main = is_article and not node.drop
    node.drop = node.drop or node.named
    node.article = node.main and not node.drop


def _keep_wrappers(root: Node) -> None:
    """Elements dropped by a class name that hold the page's article or most text stay.

    `has-sidebar` or `widget` are also names of wrappers. Of a marked page the text of its
    articles counts, of others all text; what other rules drop never does.
    """
    nodes: list[Node] = []
    stack = [root]
    while stack:
        node = stack.pop()
        nodes.append(node)
        stack.extend(
            c
            for c in reversed(node.children)
            if isinstance(c, Node) and (c.named or not c.drop)
        )
    if not any(n.named for n in nodes):
        return
    chars: dict[int, int] = {}
    articles: dict[int, int] = {}
    largest: dict[int, int] = {}
    for node in reversed(nodes):
        size, mains, most = 0, int(node.main), 0
        for c in node.children:
            if isinstance(c, str):
                size += len(c.strip())
            else:
                size += chars.get(id(c), 0)
                mains += articles.get(id(c), 0)
                most = max(most, largest.get(id(c), 0))
        chars[id(node)], articles[id(node)] = size, mains
        largest[id(node)] = size if node.main else most
    every = articles[id(root)]

    def stands_for(size: int, whole: int) -> bool:
        return size > 0 and (
            size >= ALL_SHARE * whole or (size > MOST_SHARE * whole and size >= MOST_CHARS)
        )

    def keep(node: Node) -> None:
        node.drop = node.named = False
        node.article = node.main

    def visit(top: Node, whole: int) -> tuple[bool, list[Node]]:
        """Whether an article is left below `top`, and what names still drop, topmost first."""
        found, dropped = False, []
        stack = [(top, whole)]
        while stack:
            node, whole = stack.pop()
            if node.named:
                size, held = chars[id(node)], articles[id(node)]
                if set(node.words) & REPLY_WORDS:
                    stays = held == every and size >= ALL_SHARE * whole > 0
                else:
                    # a list of related articles may be long, but none of them is the page's
                    if held and size < ALL_SHARE * whole:
                        size = largest[id(node)]
                    stays = (held > 0 or not every or node.inside) and stands_for(size, whole)
                if not stays:
                    dropped.append(node)
                    continue
                keep(node)
            if node.article:
                found, whole = True, chars[id(node)]
            stack.extend((c, whole) for c in reversed(node.children) if id(c) in chars)
        return found, dropped

    found, dropped = visit(root, chars[id(root)])
    while every and not found:
        # the only articles stand in what names drop: the largest such element is no notice
        holders = [n for n in dropped if articles[id(n)]]
        if not holders:
            break
        best = max(holders, key=lambda n: (not set(n.words) & REPLY_WORDS, chars[id(n)]))
        keep(best)
        found, inner = visit(best, chars[id(best)])
        dropped = [n for n in dropped if n is not best] + inner
    # many elements of one name, each with a part of the text
    groups: dict[tuple, list[Node]] = {}
    wholes: dict[int, int] = {}
    for node in dropped:
        scope = root
        if every:
            scope = node.parent
            while scope is not None and not scope.article:
                scope = scope.parent
            if scope is None:
                continue
        says = frozenset(set(node.words) & (DROPPED_WORDS | WEAK_WORDS))
        if not says & REPLY_WORDS:
            wholes[id(scope)] = chars[id(scope)]
            groups.setdefault((id(scope), says), []).append(node)
    for (scope, _), same in groups.items():
        if len(same) > 1 and stands_for(sum(chars[id(n)] for n in same), wholes[scope]):
            for node in same:
                keep(node)
                visit(node, wholes[scope])


def _next_token(html: str, at: int, last: int) -> re.Match | None:
    """The next piece of markup; each is found in time that grows with its own length.

    What opens behind the last `>` never ends and is text, but for comments and the like.
    """
    while (at := html.find("<", at)) >= 0:
        if at < last or html.startswith(("<!--", "<![CDATA["), at):
            m = _TOKEN.match(html, at) or _BROKEN.match(html, at)
            if m:
                return m
        at += 1
    return None


def parse(html: str) -> Node:
    """A forgiving tree: unclosed and crossed elements end where their parent ends."""
    root = Node("#root", (), None)
    at, here, end = 0, root, len(html)
    last = html.rfind(">")  # nothing that is behind it ends
    opened: Counter[str] = Counter()  # elements around `here`, by tag

    def leave(node: Node) -> Node:
        """The parent of an element around `here`; elements inside it end with it."""
        inner = here
        while inner is not node.parent:
            opened[inner.tag] -= 1
            inner = inner.parent
        return inner

    while at < end:
        m = _next_token(html, at, last)
        text = html[at : m.start() if m else end]
        if text:
            here.children.append(text)
        if not m:
            break
        at = m.end()
        if m["cdata"] is not None:
            here.children.append(m["cdata"].replace("&", "&amp;"))
        tag = m["tag"] and m["tag"].lower()
        if not tag:
            continue
        if m["close"]:
            if opened[tag]:
                node = here
                while node.tag != tag:
                    node = node.parent
                here = leave(node)
            elif tag in ("p", "br"):
                here.children.append(" ")
            continue
        if tag in ENDS_PARAGRAPH or tag in ENDED_BY:
            ends = ENDED_BY.get(tag, set()) | ({"p"} if tag in ENDS_PARAGRAPH else set())
            if any(opened[t] for t in ends):
                node = here
                while node.parent is not None and node.tag not in ends and node.tag not in SCOPES:
                    node = node.parent
                if node.tag in ends:
                    here = leave(node)
        attrs = _attributes(m["attrs"])
        names = f"{attrs.get('class', '')} {attrs.get('id', '')}".lower()
        node = Node(tag, tuple(_NAME.findall(names)) if names != " " else (), here)
        _judge(node, attrs)
        here.children.append(node)
        if tag in RAW and not m["self"]:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            if tag == "textarea" or tag == "title":
                node.children.append(html[at : close.start() if close else end])
            at = close.end() if close else end
        elif tag not in VOID and not m["self"]:
            here = node
            opened[tag] += 1
    _keep_wrappers(root)
    return root


def _paths(root: Node, known: dict[tuple[int, str], int]) -> list[Node]:
    """Elements in page order, each with the name of its path; nothing of dropped ones."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.parent is not None:
            key = (node.parent.path, f"{node.tag}.{'.'.join(node.words)}")
            if key not in known:
                if len(known) > 200_000:
                    known.clear()
                digest = blake2b(f"{key[0]}/{key[1]}".encode(), digest_size=8).digest()
                known[key] = int.from_bytes(digest, "little", signed=True)
            node.path = known[key]
            out.append(node)
            if node.drop:
                continue
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return out


def _blocks(root: Node, low: set[int], only_articles: bool) -> list[str]:
    """Texts of the blocks that stay, white space made single."""
    blocks: list[str] = []
    own: list[str] = []

    def close() -> None:
        if own:
            text = " ".join(unescape("".join(own)).split())
            if text:
                blocks.append(text)
            own.clear()

    # (node, inside an article); a None node ends a block
    stack: list[tuple[Node | str | None, bool]] = [(root, not only_articles)]
    while stack:
        node, read = stack.pop()
        if node is None:
            close()
        elif isinstance(node, str):
            if read:
                own.append(node)
        else:
            block = node.tag not in INLINE
            if block:
                if node.tag == "br":
                    if read:
                        own.append(" ")
                    continue
                close()
            if node.drop or node.path in low:
                continue
            read = read or node.article
            if block:
                stack.append((None, read))
            stack.extend((c, read) for c in reversed(node.children))
    close()
    return blocks


def _hash(parts: list[str]) -> int:
    digest = blake2b("\x1f".join(parts).encode("utf-8", "replace"), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def _features(root: Node, nodes: list[Node]) -> dict[int, tuple[int, int]]:
    """path -> (layout, content) of a page; equal paths of one page are taken together."""
    texts: dict[int, int] = {}

    def content(node: Node) -> None:
        parts = []
        for c in node.children:
            if isinstance(c, str):
                parts.append(" ".join(c.split()))
            else:
                parts.append(str(texts.get(id(c), 0)))
        texts[id(node)] = _hash(parts)

    for node in reversed(nodes):
        content(node)
    layouts: dict[int, list[str]] = {}
    says: dict[int, list[str]] = {}
    for node in nodes:
        children = [c.tag for c in node.children if isinstance(c, Node)]
        layouts.setdefault(node.path, []).append(",".join(children))
        says.setdefault(node.path, []).append(str(texts[id(node)]))
    return {path: (_hash(layouts[path]), _hash(says[path])) for path in layouts}


def _main_blocks(html: str, nodes: list[Node]) -> int:
    """Name of a page by the longest blocks of its article or paragraphs, without links."""
    marked = any(n.article for n in nodes)
    blocks: list[tuple[int, str]] = []
    linked: set[int] = set()
    for node in nodes:
        if node.tag == "a" or id(node.parent) in linked:
            linked.add(id(node))
        elif (node.article or node.inside) if marked else node.tag == "p":
            text = " ".join("".join(c for c in node.children if isinstance(c, str)).split())
            if text:
                blocks.append((-len(text), text))
    wanted = SAME_SHARE * sum(-n for n, _ in blocks)
    main: list[str] = []
    for n, text in sorted(blocks):
        if wanted <= 0:
            break
        wanted += n
        main.append(text)
    return _hash(main or [html])


TREE_SCHEMA = "host string, node long, layout long, content long, page long"


def _tree_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[tuple[int, str], int] = {}
    for batch in batches:
        rows: list[tuple] = []
        for host, html in zip(
            batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True
        ):
            root = parse(html or "")
            nodes = [n for n in _paths(root, known) if not n.drop]
            features = _features(root, nodes)
            page = _main_blocks(html or "", nodes)
            rows += [(host, path, a, b, page) for path, (a, b) in features.items()]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])],
            names=["host", "node", "layout", "content", "page"],
        )


def _entropy(seen: DataFrame, value: str) -> DataFrame:
    """Entropy of a node's values over its pages, in logarithms to the number of pages."""
    n = F.col("n")
    per_value = seen.groupBy("host", "node", value).agg(F.count("*").alias("n"))
    return (
        per_value.groupBy("host", "node")
        .agg(F.sum("n").alias("pages"), F.sum(n * F.log(n)).alias("s"))
        .select(
            "host",
            "node",
            "pages",
            F.when(F.col("pages") == 1, 1.0)
            .otherwise(1 - F.col("s") / (F.col("pages") * F.log("pages")))
            .alias(value),
        )
    )


def tree_rows(pages: DataFrame) -> DataFrame:
    """(host, node, layout, content, page) of all pages; `pages` has host and html."""
    seen = pages.select("host", "html").mapInArrow(_tree_batches, TREE_SCHEMA).distinct()
    return stored(seen, "style-tree")


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, node, pages, importance) of every node of the hosts' style trees.

    `pages` has host and html.
    """
    return importances(tree_rows(pages))


def importances(seen: DataFrame) -> DataFrame:
    layout, content = _entropy(seen, "layout"), _entropy(seen, "content").drop("pages")
    return layout.join(content, ["host", "node"]).select(
        "host", "node", "pages", F.greatest("layout", "content").alias("importance")
    )


def removable(seen: DataFrame, min_importance: float, min_pages: int) -> DataFrame:
    """(host, low): the frequent contents of nodes of low importance."""
    low = importances(seen).filter(
        (F.col("pages") >= min_pages) & (F.col("importance") < min_importance)
    )
    # the bound of the fewest pages first: most contents are unique and need not be joined
    says = (
        seen.groupBy("host", "node", "content")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > min_pages ** (1 - min_importance))
    )
    return (
        says.join(low, ["host", "node"])
        .filter(F.col("n") > F.pow("pages", F.lit(1 - min_importance)))
        .groupBy("host")
        .agg(F.collect_list(F.struct("node", "content")).alias("low"))
    )


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[tuple[int, str], int] = {}
    for batch in batches:
        texts = []
        for html, low in zip(
            batch.column("html").to_pylist(), batch.column("low").to_pylist(), strict=True
        ):
            root = parse(html or "")
            nodes = _paths(root, known)
            marked = any(n.article for n in nodes)
            cut = set()
            if low:
                here = _features(root, [n for n in nodes if not n.drop])
                cut = {v["node"] for v in low if here.get(v["node"], (0, None))[1] == v["content"]}
            blocks = _blocks(root, cut, marked) or _blocks(root, set(), marked)
            texts.append(" ".join(blocks))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ],
            names=["page_id", "url", "text", "n_chars"],
        )


def host_of(url: Column) -> Column:
    """Lower-case host of a URL, without user and port; '' where there is none."""
    return F.lower(
        F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))
    )


def main_text(
    pages: DataFrame, min_importance: float = MIN_IMPORTANCE, min_pages: int = MIN_PAGES
) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        host_of(F.col("url")).alias("host"),
        F.col("html").cast("string").alias("html"),
    )
    low = stored(removable(tree_rows(rows), min_importance, min_pages), "style-tree-low")
    return rows.join(low, "host", "left").mapInArrow(
        _text_batches, "page_id long, url string, text string, n_chars long"
    )
