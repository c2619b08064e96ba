import pytest

from prismtab.llm import html

CASES = {
    "": "",
    "plain  text": "plain text",
    "<p>a<p>b<br>c</p> d": "a\n\nb c\n\nd",
    "<body><nav>menu</nav><header>site</header><article><header><h1>T &amp; U</h1></header><p>x <b>y</b>z&nbsp;&eacute;&#233;&lt;p&gt;</p></article><aside>s</aside><footer>f</footer>": "T & U\n\nx yz éé<p>",
    "<div class='cookie-notice'>c</div><p>keep</p><div id=comments><p>nice</p></div><form>f</form><script>var a='<p>no</p>'</script><style>p{}</style>": "keep",
    "<main><p>m</p><article class='comment'><p>reader</p></article></main>": "m",
    "<article><p>short</p></article><article><p>the longer one</p></article>": "short\n\nthe longer one",
    'See <a href="/the-hidden-valley">the valley</a> now.': "See the valley now.",
    '<p title="The hidden gems">All this text.</p>': "All this text.",
    '<div aria-hidden="false"><p>Shown text.</p></div>': "Shown text.",
    'Read <a href="/p?id=search">this link</a> and <a data-id="menu">this link</a>': "Read this link and this link",
    "<p data-x=don't>Hello it's me</p><p>and you</p>": "Hello it's me\n\nand you",
    '<p title="open>Hello</p> <p>it is me</p>': "Hello\n\nit is me",
    "<p title = 'a > b' class = x>kept</p><p hidden>gone</p><p HIDDEN=''>gone</p>": "kept",
    "<p style='color:red; display : none !important'>gone</p><p style='--display:none-ish'>kept</p><p style='content:\"display:none\"'>too</p>": "kept\n\ntoo",
    "<a href=/x/y/>link</a><p data-hidden=style id=a/b>kept": "link\n\nkept",
    "<p " + "a='" * 2000 + ">kept</p>": "kept",
    "<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>": "a\n\nb\n\nc\n\nd",
    "<article><p>cut &am": "cut &am",
    "<article><p>cut <a href='x": "cut",
    "<!-- <p>no</p> --><p hidden>h</p><p style='display: none'>i</p><p>\n a \t b </p>": "a b",
    "<p>1 < 2 & 3</p></div></p>": "1 < 2 & 3",
    "<article class='ad-free'><p>kept</p></article>": "kept",
    "<p>" * 3000 + "deep" + "<div>" * 3000 + "x": "deep\n\nx",
}


@pytest.mark.parametrize("page", CASES)
def test_single_pages(page):
    assert html.parse(page)[0] == CASES[page]


def site(host, pages, template, start=0):
    return [(start + i, f"http://{host}/{i}", template.format(f"<p>page {start + i} of {host}</p>")) for i in range(pages)]


def run(spark, rows):
    df = spark.createDataFrame([(*r, "h", "t", 1) for r in rows], "page_id long, url string, html string, host string, text string, row int")
    out = html.main_text(df)
    assert out.columns == ["page_id", "url", "html", "host", "row", "text"]
    return {r.page_id: r.text for r in out.collect()}


def test_subtrees_that_recur_on_a_host_go(spark):
    frame = "<body><div class=top><p>Welcome to us</p></div>{}<div><p>All rights kept</p></div>"
    rows = site("a.com", 20, frame) + site("b.com", 3, frame, 100) + site("c.com", 30, "<article>{}<p>A common sentence.</p></article>", 200)
    # copies of one page are one page
    rows += [(500 + i, f"http://d.com/{i}", "<body><div><p>news</p></div><div><p>copy</p></div>") for i in range(30)]
    rows += [(600, None, None), (601, None, ""), (602, "http://a.com/x", None), (0, "http://a.com/0", rows[0][2])]
    got = run(spark, rows)
    assert got[3] == "page 3 of a.com"
    assert got[101] == "Welcome to us\n\npage 101 of b.com\n\nAll rights kept"
    assert got[205] == "page 205 of c.com\n\nA common sentence."
    assert got[510] == "news\n\ncopy"
    assert got[600] == got[601] == got[602] == ""


def test_only_counting_finds_a_frame_without_tags_or_words(spark):
    """Nothing in the markup tells the frame from the text; the same frame on a host of few pages stays."""
    frame = "<body><div class=x1><div>Our shop</div><div>Offers of today</div></div><div class=x2>{}</div><div class=x3>Call us</div></body>"
    got = run(spark, site("a.com", 12, frame) + site("few.com", 3, frame, 100))
    assert got[4] == "page 4 of a.com"
    assert got[101] == "Our shop\n\nOffers of today\n\npage 101 of few.com\n\nCall us"
    found = html.parse("<body><nav><ul><li>Home</ul></nav><p>text</p>")[1]
    assert len(found) == 4  # li, ul and nav count as well as p


def test_many_templates_are_joined_without_a_broadcast(spark, monkeypatch):
    rows = site("a.com", 20, "<body><div><p>Welcome</p></div>{}")
    want = run(spark, rows)
    monkeypatch.setattr(html, "BROADCAST_ROWS", -1)
    assert run(spark, rows) == want == {i: f"page {i} of a.com" for i in range(20)}


def test_empty_table(spark):
    assert run(spark, []) == {}


def test_all_text_that_is_left_is_taken():
    two = "<article><h1>A</h1><p>one</p></article><article><p>two, the longer</p></article><main><p>three</p></main>"
    assert html.parse(two)[0] == "A\n\none\n\ntwo, the longer\n\nthree"
    for block in ("<aside>{}</aside>", "<nav>{}</nav>", "<div class=related>{}</div>"):
        teaser = block.format("<article><p>read this as well, a teaser</p></article>")
        assert html.parse(f"<div><p>the text, longer than the teaser</p></div>{teaser}<p>goes on</p>")[0] == "the text, longer than the teaser\n\ngoes on"
    assert html.parse("<article><p>a</p></article><div><p>the text beside it</p></div>")[0] == "a\n\nthe text beside it"


def test_copies_of_an_article_beside_other_text_are_one_page(spark):
    page = "<body><article><div><p>news</p></div></article>{}"
    assert run(spark, site("a.com", 20, page))[3] == "news\n\npage 3 of a.com"


@pytest.mark.parametrize("page", [
    "<html class='nav-open'><body class='no-sidebar search'>{}</body></html>",
    "<div class='content-with-sidebar'>{}</div>",
    "<div id='page' class='logged-in nav-open'>{}</div>",
    "<article><div class='post-body share-enabled'>{}</div></article>",
    "<div class='share-post'><article>{}</article></div>",
    "<div class='social'><main>{}</main></div>",
    "<div class='related'><article>{}</article></div>",
    "<div class='widget-page'><div class='sidebar'>menu</div>{}<div class='search-box'>find</div></div>",
])
def test_marks_do_not_delete_what_holds_the_text(page):
    text = "<p>the text of the page</p><p>in two parts</p>"
    assert html.parse(page.format(text))[0] == "the text of the page\n\nin two parts"


def test_marked_blocks_beside_the_text_go():
    posts = "".join(f"<div class='share-post'><article><p>post {i}</p></article></div>" for i in range(3))
    assert html.parse(posts)[0] == "post 0\n\npost 1\n\npost 2"
    for block in ("<div class='sidebar left'>{}</div>", "<div id=comments>{}</div>", "<div class='related-posts'><article>{}</article></div>", "<p role=search>{}</p>"):
        assert html.parse(f"<div><p>the text of the page</p></div>{block.format('something else')}<p>goes on</p>")[0] == "the text of the page\n\ngoes on"
    # an advert longer than the article beside it
    assert html.parse("<div class=ad>buy this, and that, and more</div><article><p>A.</p></article>")[0] == "A."
    assert html.parse("<div class=ad>buy this, and that, and more</div><article>")[0] == ""
