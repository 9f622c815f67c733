import pytest
from corpusloom.llm import extract

ARTICLE = "<h1>A title</h1><p>First &amp; long\n paragraph, with <b>bold</b> text. It goes on, and on; really.<p>Second one, also long enough to count.</p><ul><li>one<li>two</ul><p>Short.</p>"
TEXT = "A title First & long paragraph, with bold text. It goes on, and on; really. Second one, also long enough to count. one two Short."
AROUND = {
    "plain": "<html><head><title>t</title></head><body>{}</body></html>",
    "article": "<nav><ul><li><a href=x>Menu</a></li></ul></nav><article>{}</article><footer>&copy; me</footer>",
    "classes": "<div id='menu'>a b</div><div class='cookie-notice'>We use cookies, here.</div><div class=content>{}</div><div class='sidebar'>side, text.</div>",
    "comments": "<main><div class=post>{}</div><section id=comments><p>Nice article, thank you! I liked it a lot, really.</p></section></main>",
    "scripts": "<script>var a='<p>x</p>';</script><style>p{{}}</style><!-- no <p>no</p> --><div>{}</div><form>Mail <input><button>go</button></form><div class='ad-box'>Buy, now.</div>",
    "unclosed": "<body><div class='nav'><a>x</a></div><div>{}</div>",
    "roles": "<div role=banner>top</div><div role=main>{}</div><div role='complementary'>other</div><p hidden>secret text, here.</p>",
    "article comments": "<div>{}<article class='comment'><p>I disagree, but well written.</p></article></div>",
}


@pytest.mark.parametrize("name", list(AROUND))
def test_only_the_article_is_left(name):
    assert extract.main_text(AROUND[name].format(ARTICLE)) == TEXT


def test_odd_pages():
    assert extract.main_text(None) == ""
    assert extract.main_text("") == ""
    assert extract.main_text("no tags at all") == "no tags at all"
    assert extract.main_text("<p>a &lt; b &#233; &nbsp; c</p>") == "a < b é c"
    assert extract.main_text("</div></p><p>stray ends.") == "stray ends."
    assert extract.main_text("<script>never closed <p>x") == ""
    assert extract.main_text("a < b and c > d") == "a < b and c > d"


def test_long_texts_stay_whole():
    body = "".join(f"<p>Paragraph {i}, with some text.</p>" for i in range(20_000))
    assert extract.main_text(f"<nav>x</nav><article>{body}</article>").count("Paragraph") == 20_000


def test_columns_and_rows(spark):
    rows = [(1, "u", AROUND["article"].format(ARTICLE), "old", 5), (None, None, None, "old", 5), (1, "u", "", "old", 5)]
    frame = spark.createDataFrame([*rows, rows[0]], "page_id long, url string, html string, text string, n_chars int")
    got = extract.extract(frame)
    assert got.columns == ["page_id", "url", "html", "text", "n_chars"]
    assert sorted((r.text, r.n_chars) for r in got.collect()) == [("", 0), ("", 0), (TEXT, len(TEXT)), (TEXT, len(TEXT))]
    assert extract.extract(frame.limit(0)).collect() == []


LONG = "Some words of a sentence, which goes on for a while; it ends here."
WHOLE = {
    "title and lead": f"<article><h1>Title</h1><p>{LONG}</p><div class=body>{LONG * 12}</div></article>",
    "two sections": f"<div><section>{f'<p>{LONG}</p>' * 9}</section><section><p>{LONG} Last.</p></section></div>",
    "long list": f"<article><p>First. {LONG}</p><ul>{f'<li>{LONG}' * 20}</ul><p>Last. {LONG}</p></article>",
    "no element around": f"<div>{f'<p>{LONG}</p>' * 9}</div><div><p>Last. {LONG}</p></div>",
}


@pytest.mark.parametrize("name", list(WHOLE))
def test_all_selected_text_is_kept(name):
    nodes = extract.blocks(WHOLE[name])
    assert extract.main_text(WHOLE[name]) == " ".join(text for _, _, text in nodes)


KEPT = {
    "style": '<div style="overflow:hidden">{}</div>',
    "link": '<div data-link="a" href="/hidden-gems">{}</div>',
    "data-hidden": '<div data-hidden="false">{}</div>',
    "query": '<div data-href="?id=search">{}</div>',
    "data-id": '<div data-id="ad">{}</div>',
    "title": "<div title='see id=search, class=ad'>{}</div>",
    "section": '<section id="legal-background">{}</section>',
    "topic": '<section id="binary-search">{}</section>',
    "class": '<div class="related-work">{}</div>',
    "heading": '<div><h2 id="search">Search</h2><h3 id="search-algorithms" class="legal">On it</h3>{}</div>',
    "closed svg": '<div><svg width="1" />{}</div><svg><text>no</text></svg>',
    "form": '<form id="aspnetForm" action="x.aspx"><div class="nav-links">no</div><div>{}</div></form>',
    "form by number": '<form id="form1" role="form"><div class="site-header">no</div><div>{}</div></form>',
    "custom element": "<title-block>{}</title-block>",
}
LEFT_OUT = ["site-header", "nav-links", "cookie-notice", "adBox", "related-posts", "main-nav", "ad_1", "x sidebar"]


@pytest.mark.parametrize("name", list(KEPT))
def test_only_whole_names_leave_text_out(name):
    text = extract.main_text(KEPT[name].format(ARTICLE))
    assert text == {"heading": "Search On it "}.get(name, "") + TEXT


@pytest.mark.parametrize("label", LEFT_OUT)
def test_compound_names_still_leave_text_out(label):
    assert extract.main_text(f"<div class='{label}'>{LONG}</div><div>{ARTICLE}</div>") == TEXT
