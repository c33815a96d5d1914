import html
import random
import re

import pytest

from edgeweave.llm import queries, wrappers
from edgeweave.sources.derived import table


def text_of(*pages, of=0):
    """The main text of one page among pages of one host."""
    wrapper = wrappers.Wrapper()
    for page in pages:
        wrapper.add_page(wrappers.page_tree(page))
    return wrappers.main_text(wrappers.page_tree(pages[of]), *wrapper.plan())


def plain_article(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner).replace("<br>", " "))
    return "\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)


def test_tables_pages(spark):
    sf = "/root/testdata/sf0.01"
    want = {r.page_id: (r.url, plain_article(r.html)) for r in table(spark, sf, "pages").collect()}
    rows = queries.op6_wrapper_text(spark, sf).collect()
    assert {r.page_id: (r.url, r.text) for r in rows} == want and len(rows) == len(want)
    assert all(r.n_chars == len(r.text) for r in rows)


def test_main_text_of_a_rich_page():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
    <header><h1>Site</h1></header><nav>Menu</nav><div id="cookie-notice">We use cookies</div>
    <main><article class="post"><header><h1>Title &amp;  more</h1></header><p>One <b>b</b>old &lt;tag&gt; a<i>b</i>c
    <p>Two&nbsp;words<br>end<ul><li>x<li>y</ul><div class="ad">Buy</div><script>var a = "<p>no</p>";</script>
    <table><tr><td>c1<td>c2</table><form>Mail</form><pre>a   b</pre><p hidden>no</p><!-- <p>no</p> -->last</article>
    <section class="comments"><article class="comment">No</article></section></main><aside>side</aside><footer>f</footer>"""
    want = ["Title & more", "One bold <tag> abc", "Two words end", "x", "y", "c1", "c2", "a b", "last"]
    assert text_of(page).split("\n") == want


def test_pages_without_article_use_what_the_wrapper_knows():
    page = "<body><div>About us, always the same</div><div class='box'><p>Story {}</p><p>More {}</p></div></body>"
    pages = [page.format(i, i) for i in range(5)]
    assert text_of(*pages, of=3) == "Story 3\nMore 3"  # the constant slot is template
    assert text_of(pages[0]) == "About us, always the same\nStory 0\nMore 0"  # one page shows no constants
    content = "<body><div>x{}</div><div id='content'><p>Body {}</p></div></body>"
    assert text_of(content.format(1, 1), content.format(2, 2)) == "Body 1"
    both = ["<body><article>A</article><p>rest</p></body>", "<body><main>M</main><p>rest</p></body>", "<body><p>only</p></body>"]
    assert [text_of(*both, of=i) for i in range(3)] == ["A", "M", "only"]


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("plain text", "plain text"),
        ("a < b & c &unknown; &#65;&#x42;", "a < b & c &unknown; AB"),
        ("<p>open", "open"),
        ("<article><p>a<p>b</article>c", "a\nb"),
        ("<div>a</span>b</p>c</div>d", "abc\nd"),
        ("<!-- never ends <p>x", ""),
        ("<script>never ends <p>x", ""),
        ("<p title='a>b'>x</p>", "x"),
        ("<head><title>t<body>shown", "shown"),
        ("<article>" * 3000 + "deep" + "</article>" * 3000, "deep"),
    ],
)
def test_odd_pages(page, text):
    assert text_of(page) == text


def shape(items):
    mark = lambda i: ("?" if i[1] else "") + ("+" if i[2] else "")
    return " ".join((f"({shape(i[3])})" if i[0] == "(" else i[0] + (f"[{shape(i[3])}]" if i[3] else "")) + mark(i) for i in items)


def expression(*pages):
    wrapper = wrappers.Wrapper()
    for page in pages:
        wrapper.add_page(wrappers.page_tree(page))
    return shape(wrapper.items)


def test_inference():
    assert expression("<ul><li>a<li>b<li>c</ul>") == "ul[li[#]+]"
    assert expression("<p>a</p>", "<p>a</p><p>b</p>") == "p[#]+"
    assert expression("<h1>a</h1><p>b</p>", "<p>b</p>") == "h1[#]? p[#]"
    assert expression("<dl><dt>a<dd>b<dt>c<dd>d</dl>") == "dl[(dt[#]? dd[#]?)+]"
    assert expression("<p>a</p><h2>x</h2><p>b</p>", "<p>a</p><hr>") == "(p[#]? h2[#]?)+ hr?"
    assert expression("<p>a</p>", "") == "p[#]?"


def test_folding_order_does_not_matter():
    rng = random.Random(6)
    tags = ["p", "h2", "div class='x'", "ul", "article", "section"]

    def page():
        return "".join(f"<{t}>{rng.randrange(3)}</{t.split()[0]}>" for t in rng.choices(tags, k=rng.randrange(7)))

    pages = [page() for _ in range(40)]
    plans = []
    for _ in range(5):
        rng.shuffle(pages)
        parts = [wrappers.Wrapper() for _ in range(3)]
        for i, p in enumerate(pages):
            parts[i % 3].add_page(wrappers.page_tree(p))
        whole = wrappers.Wrapper()
        for part in parts:
            whole.add(wrappers.Wrapper.loaded(part.dumped()))
        plans.append((whole.pages, whole.plan()))
        labels = [i[0] for i in wrappers._unrolled(whole.items)]
        assert len(set(labels)) == len({i[0] for item in whole.items for i in ([item] if item[0] != "(" else item[3])})
    assert all(p == plans[0] for p in plans)


def test_odd_rows(spark):
    rows = [(1, "http://a/x", None), (2, None, "<p>x</p>"), (None, "no scheme", "<p>y</p>"), (3, "http://a/y", ""), (3, "http://a/y", "")]
    rows += [(4, "HTTP://A/z", "<p>" + "long " * 100_000 + "</p>")]
    pages = spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, text string")
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in wrappers.main_texts(pages).collect()), key=str)
    long = ("long " * 100_000).strip()
    want = [(1, "http://a/x", "", 0), (2, None, "x", 1), (None, "no scheme", "y", 1), (3, "http://a/y", "", 0), (3, "http://a/y", "", 0)]
    assert got == sorted([*want, (4, "HTTP://A/z", long, len(long))], key=str)
    assert wrappers.main_texts(pages.limit(0)).collect() == []


@pytest.mark.parametrize(
    "page, text",
    [
        ('<html class="js no-search"><body class="home no-sidebar"><article><p>a</article><footer>f</footer>', "a"),
        ('<body class="sidebar"><p>a</p><div class="sidebar">b</div></body>', "a"),
        ('<body><article class="post comments-open"><p>a</article><p>b</body>', "a"),
        ('<body><article class="widget"><p>a</article></body>', "a"),
        ('<body><main class="search"><p>a</main><p>b</body>', "a"),
        ('<body><div class="content with-sidebar"><p>a</div><p>b</body>', "a"),
        ('<body><form id="aspnetForm"><div class="menu">m</div><p>long text</p><input></form><p>c</body>', "long text\nc"),
        ('<body><form><article><p>long text</p><form>Mail</form></article></form><p>b</body>', "long text"),
        ('<body><main><form><p>long text</form></main></body>', "long text"),
        ('<body><div class="social"><article>a</article></div>b</body>', "a"),
        ('<body><div class="widget"><div class="entry">a</div></div></body>', "a"),
        ('<body><p>a</p><div class="comments"><article>b</article><article>c</article></div></body>', "a"),
        ('<body><p>long text</p><form>Mail</form><div id="cookie-notice">c</div></body>', "long text"),
    ],
)
def test_marks_of_side_matter(page, text):
    assert text_of(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ('<main><p>long text</p><article class="teaser">x</article></main>', "long text\nx"),
        ('<main><p>long text</p></main><article class="teaser">x</article>', "long text"),
        ('<main>x</main><article>long text</article>', "long text"),
        ('<article></article><div class="content">long text</div><p>b</p>', "long text"),
        ('<div class="content"><p>long text</p><article>x</article></div><p>b</p>', "long text\nx"),
        ('<div class="content"><p>x</p><article>long text</article></div><p>b</p>', "long text"),
        ('<main></main><div id="main"><article> </article></div><div class="entry"></div><p>b</p>', "b"),
        ('<article><main>a</main>b</article>', "a b"),
    ],
)
def test_choice_of_the_container(page, text):
    assert text_of(page).split() == text.split()


def test_constant_text_around_articles_is_template():
    pages = [f"<main><h2>Latest posts</h2><p>Of day {i}</p><article>Post {i}</article></main>" for i in range(4)]
    assert text_of(*pages, of=2) == "Of day 2\nPost 2"
    assert text_of(pages[0]) == "Latest posts\nOf day 0\nPost 0"


def test_copies_of_a_page_are_no_template():
    page = "<body><nav>{}</nav><h1>Title</h1><p>Text</p><div>End</div></body>"
    for copies in (3, 50):
        assert text_of(*[page.format("m")] * copies) == "Title\nText\nEnd"
        assert text_of(*[page.format(i) for i in range(copies)]) == "Title\nText\nEnd"  # only side matter differs
        assert text_of(*["<p>Text</p>"] * copies) == "Text"
    two = ["<div>Same</div><p>One</p>", "<div>Same</div><p>Two</p>"]
    assert text_of(*two * 5) == "Same\nOne"
    assert text_of(*two, "<div>Same</div><p>Three</p>") == "One"


def test_copies_in_parts_of_a_host():
    parts = [wrappers.Wrapper() for _ in range(5)]
    for part in parts:
        part.add_page(wrappers.page_tree("<h1>Title</h1><p>Text</p>"))
    whole = wrappers.Wrapper()
    for part in parts:
        whole.add(wrappers.Wrapper.loaded(part.dumped()))
    assert whole.plan()[1] == frozenset()


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article><p>a <svg class='i'/> b<p>c</article><svg><text>no</text></svg>", "a b\nc"),
        ("<article>a<object data='x'/>b<iframe src='x'/>c<math/>d<template/>e<select/>f</article>", "abcdef"),
        ("<article>a<svg><p>b</p><svg><text>no</text></svg>c</article>", "a\nb\nc"),
        ("<article>a<svg><svg/><g><svg><text>no</text></svg></g>no</svg>b</article>", "ab"),
        ("<article>a<template>b</article>", "ab"),
        ("<article>a<iframe src='x'><p>b</p><iframe>no</iframe>c</article>", "a\nb\nc"),
        ("<article>a<select>b</article>", "ab"),
        ("<article>a<iframe>b<noscript>c<iframe>d</article>", "abcd"),
        ("<article>a<template><p>no</template><select><option>no</select><noscript>no</noscript><iframe>no</iframe>b</article>", "ab"),
        ("<article>If <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math> then</article>", "If x=2 then"),
        ("<article>a <object data='x'><p>fallback</p></object> b</article>", "a\nfallback\nb"),
        ("<article>a<svg><!-- </svg> --><script>'</svg>'</script></svg>b<script>c", "ab"),
        ("<svg>" * 20_000 + "a", "a"),
    ],
)
def test_raw_elements_take_no_text(page, text):
    assert text_of(page) == text


def test_link_lists_that_vary():
    page = "<body><ul>{}</ul><div><a href='/'>Home</a> | <a href='/x'>Part {}</a></div><h2><a href='#'>Title {}</a></h2>{}</body>"
    items = lambda i: "".join(f"<li><a href='/{k}'>Link {k}</a>" for k in range(i, i + 1 + i % 3))
    pages = [page.format(items(i), i, i, f"<p>Story {i}</p><ol><li><a href='/'>Source</a><li>Note {i}</ol>") for i in range(5)]
    for i in range(5):  # a list of one link is known by the host's other pages, a list with text on some page is text
        assert text_of(*pages, of=i) == f"Title {i}\nStory {i}\nSource\nNote {i}"
    mixed = ["<ul><li><a href='/'>A</a><li><a href='/'>B</a></ul><p>c</p>", "<ul><li>Text</ul><p>d</p>"]
    assert text_of(*mixed) == "A\nB\nc"
    assert text_of("<ul><li><a href='/'>A</a><li><a href='/'>B</a></ul>") == "A\nB"  # nothing else: the page
    assert text_of("<article><ul><li><a href='/'>A</a><li><a href='/'>B</a></ul>c</article>") == "A\nB\nc"
    assert expression(pages[0]).startswith("body[ul[li[@]] div[@ @@] h2[@]")


ARTICLE = "<article><p>First words of the story.</p>{}<p>Last words of the story.</p></article>"


@pytest.mark.parametrize(
    "side",
    [
        '<ol class="comment-list"><li>Nice</ol>',
        '<div class="comments-area"><p>Nice</p></div>',
        '<section class="user-comments">Nice</section>',
        '<div id="kommentare">Gut</div>',
        '<div class="ad-container"><p>Buy</p></div>',
        '<div class="x ad-slot">Buy</div>',
        '<div class="cookie-bar">We use cookies</div>',
        '<div class="related-posts"><a href="/a">Other</a></div>',
        '<div class="site-footer">Imprint</div>',
        '<p class="ad">Buy</p>',
    ],
)
def test_hyphenated_side_matter(side):
    want = "First words of the story.\nLast words of the story."
    assert text_of(f"<body>{ARTICLE.format(side)}</body>") == want
    assert text_of(f"<body><div class='content'><p>Words around.</p>{side}<p>More of them.</p></div></body>") == "Words around.\nMore of them."


def test_paragraphs_and_negations_stay():
    page = f"<body class='no-sidebar'>{ARTICLE.format('<p class=alert>Mind the gap.</p><div class=with-sidebar>Kept.</div>')}</body>"
    assert text_of(page) == "First words of the story.\nMind the gap.\nKept.\nLast words of the story."


STORY = "<body><div class=a><h1>Title {i}</h1></div>{notice}<div class=b>{blocks}</div></body>"


def stories():
    """A host without telling names: a notice that comes and goes, and a story of one to four paragraphs."""
    out = []
    for i in range(6):
        notice = f"<div class=c>Offer of day {i} only</div>" if i % 2 else ""
        blocks = "".join(f"<p>Paragraph {j} of the long story number {i}, with words enough to weigh.</p>" for j in range(1 + i % 4))
        out.append(STORY.format(i=i, notice=notice, blocks=blocks))
    return out


def test_marks_of_the_aligned_expression_choose():
    pages = stories()
    want = "Title 3\n" + "\n".join(f"Paragraph {j} of the long story number 3, with words enough to weigh." for j in range(4))
    assert text_of(*pages, of=3) == want  # the optional element is none of the story, the repeated ones are
    assert "Offer" in text_of(*pages[:2], of=1)  # two pages tell nothing


def test_a_union_of_labels_is_no_alignment(monkeypatch):
    """Without aligning and folding, no mark tells what comes and goes, and the notice stays."""
    pages = stories()
    aligned_text = text_of(*pages, of=3)

    def union(a, b):
        known = {i[0]: list(i) for i in a}
        for item in b:
            known[item[0]] = [item[0], False, False, union(known[item[0]][3], item[3])] if item[0] in known else list(item)
        return list(known.values())

    monkeypatch.setattr(wrappers, "aligned", union)
    monkeypatch.setattr(wrappers, "folded", lambda items: union([], items))
    assert "Offer" in text_of(*pages, of=3) and "Offer" not in aligned_text


def covers(expression, items):
    """Brute force: whether a page's unfolded children match an expression, by trying all ways."""

    def match(e, i):
        if e == len(expression):
            return i == len(items)
        label, optional, repeated, children = expression[e]
        if optional and match(e + 1, i):
            return True
        ends = {i}
        first = True
        while ends and (first or repeated):
            step = set()
            for at in ends:
                if label == "(":
                    step |= {end for end in prefixes(children, items, at) if end > at}
                elif at < len(items) and items[at][0] == label and covers(children, items[at][1]):
                    step.add(at + 1)
            first = False
            ends = step
            if any(match(e + 1, end) for end in ends):
                return True
        return label == "(" and match(e + 1, i)

    return match(0, 0)


def prefixes(members, items, at):
    """Where a run of optional members in order may end."""
    ends = {at}
    for label, _, repeated, children in members:
        step = set(ends)
        for end in ends:
            while end < len(items) and items[end][0] == label and covers(children, items[end][1]):
                end += 1
                step.add(end)
                if not repeated:
                    break
        ends = step
    return ends


def test_wrappers_cover_their_pages():
    """Every page of a host matches the expression that was inferred from all of them."""
    rng = random.Random(5)

    def some(depth):
        out = []
        for _ in range(rng.randrange(4)):
            tag = rng.choice("abc")
            out.append(f"<div class={tag}>{some(depth - 1) if depth else 'text'}</div>")
        return "".join(out)

    def children(element):
        return [(p.label, children(p)) for p in element.parts if not isinstance(p, str)]

    def bare(items):
        return [[i[0], i[1], i[2], bare(i[3])] for i in items if i[0] not in ("#", "@", "@@")]

    for _ in range(60):
        pages = [f"<body>{some(2)}</body>" for _ in range(4)]
        wrapper = wrappers.Wrapper()
        for page in pages:
            wrapper.add_page(wrappers.page_tree(page))
        assert all(covers(bare(wrapper.items), children(wrappers.page_tree(p))) for p in pages)
