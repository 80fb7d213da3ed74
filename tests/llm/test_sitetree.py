import time

import pytest
from pyspark.sql import functions as F

from hailmeter.llm import sitetree

PAGE = "page_id long, url string, html string"


def text_of(html: str) -> str:
    root = sitetree.parse(html)
    nodes = sitetree._paths(root, {})
    return " ".join(sitetree._blocks(root, set(), any(n.article for n in nodes)))


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>one<p>two<br>three</p>", "one two three"),
        ("<p>a<b>b</b>c</p><p>d</p>", "abc d"),
        ("<body><nav>menu</nav><p>text</p><footer>foot</footer></body>", "text"),
        ("<article><header><h1>T</h1></header><p>x</p></article><p>after</p>", "T x"),
        ("<header>site</header><main><p>x &lt;y&gt; &#233;&nbsp;z</p></main>", "x <y> é z"),
        ("<div class='ad'>buy</div><div id='sidebar'>s</div><div>text</div>", "text"),
        ("<article><p>a</p><div class='share-buttons'>share</div><p>b</p></article>", "a b"),
        ("<article>story</article><section class='comments'><article>no</article></section>", "story"),
        ("<script>if (a<b) {}</script><style>p{}</style><p>x</p><!-- c --><form>f</form>", "x"),
        ("<div hidden>h</div><div style='display: none'>n</div><p aria-hidden='true'>a</p>t", "t"),
        ("<div role='navigation'>n</div><div class='cookie-notice'>c</div>t", "t"),
        ("<ul><li>one<li>two</ul><table><tr><td>a<td>b</table>", "one two a b"),
        ("<p>unclosed <b>bold <i>both", "unclosed bold both"),
        ("</div></p>stray > signs < here &unknown;", "stray > signs < here &unknown;"),
        ("<p>" + "<b>" * 3000 + "deep", "deep"),
        ("<p title=\"a > b\">quoted</p><img alt='x>y'>", "quoted"),
    ],
)
def test_text(html, text):
    assert text_of(html) == text


STORY = " ".join(f"the {i}th part of the story is told here." for i in range(12))


@pytest.mark.parametrize(
    "html, text",
    [
        ("<div class='layout has-sidebar'><article><p>x</p></article></div>", "x"),
        ("<div class='no-sidebar'><div class='sidebar'>s</div><main><p>x</p></main></div>", "x"),
        ("<article class='post promoted'><header><h1>T</h1></header><p>x</p></article>", "T x"),
        ("<div id='comments-open'><article>x</article><div class='comments'>no</div></div>", "x"),
        (f"<div class='elementor-widget'><p>{STORY}</p></div><div class='ad'>buy</div>", STORY),
        ("<div class='elementor-widget'><p>short</p></div>", "short"),
        (f"<div class='widget'><div class='widget-box'><p>{STORY}</p></div></div>t", f"{STORY} t"),
        ("<h1>T</h1>" + f"<div class='widget'>{STORY}</div>" * 3, f"T {STORY} {STORY} {STORY}"),
        (f"<article><h1>T</h1><div class='has-sidebar'>{STORY}</div></article>", f"T {STORY}"),
        # names still count where they don't hold the page
        (f"<article>x</article><div class='related'>{STORY}</div>", "x"),
        (f"<article>x</article><section class='comments'><article>{STORY}</article></section>", "x"),
        (
            f"<article>{STORY}</article><div class='related'>"
            + f"<article>{STORY}</article>" * 3
            + "</div>",
            STORY,
        ),
        ("<article>x</article><article class='promoted'>buy</article>", "x"),
        (f"<p>{STORY}</p><div class='comments'>{STORY} {STORY}</div>", STORY),
        (f"<p>{STORY}</p><div class='sidebar'>s</div><nav class='widget'>{STORY}</nav>", STORY),
    ],
)
def test_names_of_wrappers_dont_drop_the_text(html, text):
    assert text_of(html) == text


def test_branches_that_are_the_same_on_every_page_go(spark):
    pages = [
        (
            i,
            f"http://User@Host.example:80/{i}",
            "<div><div class='x1'>About this site</div>"
            f"<div class='x2'><p>story {i} is told</p><p>with {i * 7} parts</p></div></div>",
        )
        for i in range(12)
    ]
    # one page many times over, and the same markup on a host with few pages
    pages += [pages[3]] * 30 + [(90, "http://other.example/", pages[0][2])]
    pages += [(91, None, None), (None, "no url", "<p>x</p>"), (92, "http://u.example", "")]
    out = sitetree.main_text(spark.createDataFrame(pages, PAGE)).collect()
    assert len(out) == len(pages)
    by_id = {r.page_id: r.text for r in out}
    assert by_id[5] == "story 5 is told with 35 parts"
    assert by_id[90] == "About this site story 0 is told with 0 parts"
    assert by_id[91] == "" and by_id[92] == "" and by_id[None] == "x"
    assert all(r.n_chars == len(r.text) for r in out)


def test_other_articles_of_a_host_of_near_copies_stay(spark):
    def page(i, title, date, *paragraphs):
        told = "".join(f"<p>{p}</p>" for p in paragraphs)
        body = f"<h1>{title}</h1><div class='on'>{date}</div>{told}<div class='x'>About this site</div>"
        return (i, "http://h.example/", f"<body><nav>n{i}</nav><article>{body}</article></body>")

    copied = ("the harbour was closed for a day", "ships waited out at sea until noon")
    pages = [page(i, "Harbour closed", f"day {i}", *copied) for i in range(190)]
    others = [(f"story {i} of the town begins here", f"and it ends with part {i}") for i in range(10)]
    pages += [page(900 + i, f"Title {i}", f"on {i}", *told) for i, told in enumerate(others)]
    out = {r.page_id: r.text for r in sitetree.main_text(spark.createDataFrame(pages, PAGE)).collect()}
    for i, told in enumerate(others):
        assert out[900 + i].startswith(f"Title {i} on {i} {' '.join(told)}")
    for i in range(190):
        assert out[i].startswith(f"Harbour closed day {i} {' '.join(copied)}")


def test_rare_content_of_a_node_of_low_importance_stays(spark):
    # no article and no paragraphs: what 190 pages say is of low importance
    def page(i, told):
        own = f"<div class='x1'>{f'other words of page {i} ' * 20}</div>"
        return (i, "http://h.example/", f"<body>{own}<div class='x2'>{told}</div></body>")

    pages = [page(i, "all say this") for i in range(190)]
    pages += [page(900 + i, f"only number {i} says this") for i in range(10)]
    out = {r.page_id: r.text for r in sitetree.main_text(spark.createDataFrame(pages, PAGE)).collect()}
    assert "all say this" not in out[7]
    for i in range(10):
        assert out[900 + i].endswith(f"only number {i} says this")


def test_importance(spark):
    pages = [(i, "http://h.example/", f"<body><i>same</i><u>{i}</u></body>") for i in range(8)]
    df = spark.createDataFrame(pages, PAGE).selectExpr("'h.example' host", "html")
    values = sorted(round(r.importance, 6) for r in sitetree.style_tree(df).collect())
    assert values == [0.0, 1.0, 1.0]


def test_pages_of_the_given_tables(spark, given):
    out = sitetree.main_text(given("pages")).collect()
    assert len(out) == given("pages").count()
    html = {r.page_id: r.html for r in given("pages").collect()}
    for r in out:
        assert "<" in html[r.page_id] and "track(" not in r.text and "&copy;" not in r.text
        assert "©" not in r.text and r.text


def test_no_pages(spark):
    assert sitetree.main_text(spark.createDataFrame([], PAGE)).count() == 0


@pytest.mark.parametrize(
    "html",
    [
        "<a " + '"' * 100_001,
        "<a " + '"' * 100_001 + ">",
        "<a " * 100_000,
        "<a " * 100_000 + ">",
        "<a '\"" * 50_000 + ">x",
        "<a \"'" * 50_000 + '">t</a>',
        "<b>" * 50_000 + "</i>" * 50_000,
        "<b>" * 50_000 + "<p>" * 50_000,
        "<" * 200_000,
        "<!--" * 50_000,
        "<script>" * 50_000,
        "<a " + "a='" * 50_000 + ">",
    ],
)
def test_hostile_markup_is_read_once(html):
    started = time.process_time()
    sitetree.parse(html)
    assert time.process_time() - started < 5


def test_broken_quotes_end_at_the_next_bracket():
    assert text_of("<p title=\"open>one</p><p>two</p>") == "one two"
    assert text_of("<p>one</p><a href='x>two") == "one two"
    assert text_of("<p>one</p><a href='x") == "one <a href='x"
    assert text_of("a <b") == "a <b"


def test_awkward_pages(spark):
    """Nulls, empty and very long html, repeated rows and clashing columns."""
    page = "<article><p>a story of its own</p></article>"
    long = "<article>" + "<p>word</p>" * 50_000 + "</article>"
    rows = [
        (1, "http://a.example/x", page), (1, "http://a.example/x", page), (None, None, page),
        (2, None, None), (3, "http://a.example/y", ""), (4, "no url", long), (None, None, None),
    ]
    df = spark.createDataFrame(rows, PAGE)
    story = "a story of its own"
    want = [
        (1, story), (1, story), (None, story), (2, ""), (3, ""),
        (4, " ".join(["word"] * 50_000)), (None, ""),
    ]
    got = sitetree.main_text(df)
    assert sorted(map(str, [(r.page_id, r.text) for r in got.collect()])) == sorted(map(str, want))
    for name in ("host", "path", "text", "n", "removed", "node", "content"):
        df = df.withColumn(name, F.lit("?"))
    again = sitetree.main_text(df)
    assert sorted(map(str, again.collect())) == sorted(map(str, got.collect()))
    assert sitetree.main_text(df.limit(0)).count() == 0
