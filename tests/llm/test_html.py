from tabrail.llm import html_extract as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">A</a></li></ul></nav><!-- ad --><div class="ad">Buy</div><header>Site</header>
<article><h1>Head &amp; line</h1><p><b>First   block.<br><p>Second &lt;block&gt; with <a href="x">a link</a>.</p><ul><li>one<li>two</ul>
<form>Search</form><div class="comments"><p>nice post</p></div></article><aside>Side</aside><div id="cookie-notice">We use cookies</div>
<footer>&copy; x</footer></body></html>"""


def test_blocks_of_the_article_only():
    assert H.extract(PAGE) == "Head & line\n\nFirst block.\n\nSecond <block> with a link.\n\none\n\ntwo"


def test_density_picks_the_content_without_semantic_tags():
    links = "".join(f'<li><a href="/{i}">item {i} here</a></li>' for i in range(30))
    paras = "".join(f"<p>Paragraph {i} has quite a lot of plain text in it, more than any menu has.</p>" for i in range(5))
    got = H.extract(f"<body><div><ul>{links}</ul></div><div>{paras}</div><div><a href='/'>home</a></div></body>")
    assert got.count("Paragraph") == 5 and "item" not in got and "home" not in got


def test_edges():
    for bad in (None, "", "<", "<p", "<article><p>x", "<!-- open", "<script>", "</p></div>", "<a href='x", "&#xZZ; &bogus;"):
        assert isinstance(H.extract(bad), str)
    assert H.extract("<article><p>cut off in the mid") == "cut off in the mid"
    assert len(H.extract("<article>" + "<div>" * 20000 + "deep" + "</div>" * 20000)) == 4
    assert H.extract("<body>plain words</body>") == "plain words"


def test_dropped_elements_end_where_html_ends_them():
    for page, want in (
        ("<body><p class=notice>We use cookies<p>first paragraph<div>rest</div>", "first paragraph\n\nrest"),
        ("<ul><li class=share>Share this<li>main text</ul><p>rest", "main text\n\nrest"),
        ("<ul><li class=share><p>Share this<ul><li>all</ul><li>main text</ul><p>rest", "main text\n\nrest"),
        ("<table><tr><td class=sidebar><ul><li>links<li>more</ul><td>main text</table><p>rest", "main text\n\nrest"),
        ("<table><tr class=menu><td>links<tr><td>main text</table>", "main text"),
        ("<table><thead class=menu><tr><td>links<tbody><tr><td>main text</table>", "main text"),
        ("<dl><dt class=share>Share<dd>main text</dl>", "main text"),
        ("<div><div><nav><ul><li>menu</div><p>main text</div><p>rest", "main text\n\nrest"),
        ("<html><head><title>T</title><meta charset=utf-8><body><p>main text", "main text"),
        ("<head><title>T</title><p>main text", "main text"),
        ("<nav><ul><li>a<p>b</nav><nav><table><tr><td>x<table><tr><td>y</table></nav><p>main text", "main text"),
    ):
        assert H.extract(page) == want, page


def test_wrappers_of_the_content_are_kept():
    text = "".join(f"<p>Paragraph {i} has quite a lot of plain text in it, more than any menu has.</p>" for i in range(4))
    for page in (
        f'<div class="content with-sidebar">{text}</div>',
        f'<div class="no-sidebar">{text}</div><div class="sidebar">links</div>',
        f'<div class="hasComments">{text}<div class="comments">nice post</div></div>',
        f'<div id="page-header-fixed"><div class="menu"><p>Home</p></div><article>{text}<div class="share">Share this</div></article></div>',
        f'<div id="header-top"><div class="sidebar-left"><main>{text}</main></div></div><p>Some other line</p>',
        f'<form id=aspnetForm><div class=nav>menu</div><div>{text}</div><fieldset><label>Your mail</label></fieldset></form>',
        f'<form id=aspnetForm><article>{text}</article><div class=related><article><p>A teaser of another page</p></article></div></form>',
        f'<article>{text}</article><div class=comments><article><p>A comment</p></article><article><p>Another one</p></article></div>',
    ):
        got = H.extract(f"<html><body>{page}</body></html>")
        assert got.count("Paragraph") == 4 and got.startswith("Paragraph 0") and got.endswith("menu has."), page
    assert H.extract("<p>main text of it<div class='sidebar no-border'>side</div><form>Search</form>") == "main text of it"
    assert H.extract("<div class=menu>" * 5000 + "deep" + "</div>" * 5000) == "deep"


def test_rows(spark):
    df = spark.createDataFrame([(1, "u", PAGE, 5), (1, "u", PAGE, 5), (None, None, None, 1)], "page_id long, url string, html string, text int")
    rows = H.extract_pages(df).collect()
    assert len(rows) == 3 and sum(r.n_chars == 0 and r.text == "" for r in rows) == 1
    assert H.extract_pages(df.limit(0)).count() == 0


def _paras(n, start=0):
    return "".join(f"<p>Paragraph {i} has quite a lot of plain text in it, more than any menu has.</p>" for i in range(start, start + n))


MENU = "<div><ul>" + "".join(f'<li><a href="/{i}">section {i}</a></li>' for i in range(12)) + "</ul></div>"
FOOT = '<div><a href="/a">About</a> <a href="/b">Imprint</a> <a href="/c">Contact us</a></div>'


def test_articles_in_several_parts_stay_whole():
    items = "".join(f"<li>item {i} of a list with plain words</li>" for i in range(20))
    for body, count in (
        (f"<div><section>{_paras(6)}</section><section>{_paras(6, 6)}</section></div>", 12),
        (f"<div>{_paras(3)}<ul>{items}</ul>{_paras(3, 3)}</div>", 6),
        (f"<div>{_paras(2)}<blockquote>{_paras(8, 2)}</blockquote>{_paras(2, 10)}</div>", 12),
        (f"<div><div>{_paras(4)}</div><div><div>{_paras(4, 4)}</div></div></div>", 8),
        (f"<article>{_paras(3)}</article><article>{_paras(4, 3)}</article>", 7),
        (f"<main><article>{_paras(3)}<section>{_paras(4, 3)}</section></article></main>", 7),
    ):
        got = H.extract(f"<html><body>{MENU}{body}{FOOT}</body></html>")
        assert [f"Paragraph {i} " in got for i in range(count)] == [True] * count, (body, got)
        assert "section 1" not in got and "Imprint" not in got, got
        assert ("item 19 of" in got) == ("<ul>" in body)
        # In page order, each block once.
        seen = [b for b in got.split("\n\n") if b.startswith("Paragraph")]
        assert seen == [f"Paragraph {i} has quite a lot of plain text in it, more than any menu has." for i in range(count)]


def test_short_blocks_and_bare_text_beside_content():
    got = H.extract(f"<body>{MENU}<div><h2>Title</h2>{_paras(3)}<p>Yes.</p>{_paras(3, 3)}<p>The end.</p></div>{FOOT}</body>")
    assert got.split("\n\n") == ["Title", *_paras(3).replace("</p>", "").split("<p>")[1:], "Yes.", *_paras(3, 3).replace("</p>", "").split("<p>")[1:], "The end."]
    bare = "Words that stand in no paragraph but are many, with <b>bold</b> ones and <a href='/x'>a link</a> among them, all of one run."
    got = H.extract(f"<body>{MENU}<div>{_paras(3)}{bare}{_paras(3, 3)}</div>{FOOT}</body>")
    assert "Words that stand in no paragraph but are many, with bold ones and a link among them, all of one run." in got.split("\n\n")


def test_threshold_decides():
    """With a threshold of its own the same tree gives less."""
    page = f"<body><div>{_paras(6)}</div><div><div><span>thin</span><span>text</span><span>of</span><span>tags</span></div></div></body>"
    assert "thin" not in H.extract(page) and H.extract(page).count("Paragraph") == 6


def test_densities_against_plain_recursion():
    import random
    from math import e, log

    rng = random.Random(4)

    def tree(depth):
        tag = rng.choice(("div", "p", "a", "b", "ul", "span"))
        kids = [rng.choice(("", " ", "some words ", "a b c d e f g")) if rng.random() < 0.5 or not depth else tree(depth - 1) for _ in range(rng.randrange(4))]
        return tag, kids

    def build(node, parent):
        x = H._Node(node[0], parent)
        for k in node[1]:
            if isinstance(k, str):
                x.kids.append(k)
            else:
                build(k, x)
        return x

    def chars(node, only_links=False, inside=False):
        inside = inside or node[0] == "a"
        return sum((len("".join(k.split())) if inside or not only_links else 0) if isinstance(k, str) else chars(k, only_links, inside) for k in node[1])

    def tags(node, link=False):
        return sum((not link or k[0] == "a") + tags(k, link) for k in node[1] if not isinstance(k, str))

    def flat(node, inside=False):
        yield node, inside or node[0] == "a"
        for k in node[1]:
            if not isinstance(k, str):
                yield from flat(k, inside or node[0] == "a")

    def plain(node, inside, share):
        c, lc = chars(node), chars(node, not inside)
        if not c:
            return 0.0
        t, lt = max(1, tags(node)), max(1, tags(node, True))
        base = log(c / max(1, c - lc) * max(1, lc) + share * c + e)
        return max(0.0, c / t * log(max(1.0, c / max(1, lc) * t / lt) * e) / log(base * e))

    for _ in range(200):
        spec = ("body", [tree(4) for _ in range(3)])
        root = H._Node("body", None)
        for k in spec[1]:
            build(k, root)
        order, wanted = H.weigh(root), list(flat(spec))
        share = chars(spec, True) / max(1, chars(spec))
        assert [x.tag for x in order] == [n[0] for n, _ in wanted]
        dense = [plain(n, inside, share) for n, inside in wanted]
        assert all(abs(x.density - d) < 1e-9 * max(1, d) for x, d in zip(order, dense))
        best = H._heaviest(order)
        at = {x: i for i, x in enumerate(order)}
        for x in order:
            below = [y for y in order if y is x or any(p is x for p in _up(y))]
            top = max(y.total for y in below)
            assert best[x] is next(y for y in below if y.total == top) and at[best[x]] >= at[x]


def _up(x):
    while x.parent is not None:
        x = x.parent
        yield x


def test_long_page():
    text = "word " * 400_000
    assert H.extract(f"<body>{MENU}<div><p>{text}</p>{_paras(2)}</div></body>").startswith(text.strip())
