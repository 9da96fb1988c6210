import pytest

from recordforge.llm import html_consensus as H

PAGES = "page_id bigint, url string, html string"


def own(html):
    found = H.best_paths(html)
    return H.extract(html, found[0][0]) if found else ""


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<article><h1>Ti &amp; tle</h1><p>One  <b>wor</b>d\n two<p>Three<br>four</article>", "Ti & tle One word two Three four"),
        ("<article><p>a &lt; b &#233; &#x1F600; &nbsp; c&copy</p></article>", "a < b é 😀 c©"),
        ("<body><nav><a href=x>Menu</a></nav><div class=post><p>Body text here.</p></div><footer>Foot</footer></body>", "Body text here."),
        ("<article><p>Text.</p><div class='ad'>Buy</div><aside>Side</aside><form><p>Name</p></form><p>More.</p></article>", "Text. More."),
        ("<article><p>Text.</p><section id='comments'><p>I disagree strongly with every word of it</p></section></article>", "Text."),
        ("<article><p>Text</p><script>if (a</b>) { x(\"</p>\") }</script><style>p > b {}</style><noscript>no</noscript></article>", "Text"),
        ("<article><!-- <p>gone</p> --><p>kept <!-- ad --> on</p></article>", "kept on"),
        ("<article><header><h1>Title</h1></header><p>Text</p></article>", "Title Text"),
        ("<div class='page no-sidebar'><p>Whole text.</p></div>", "Whole text."),
        ("<div><p title='a > b'>attr</p></div>", "attr"),
        ("<ul><li>one<li>two</ul><table><tr><td>three<td>four</table>", "one two three four"),
        ("<article><h1>Title</h1><div class='text'><p>One long paragraph.</p></div><div><p>Two.</p></div></article>", "Title One long paragraph. Two."),
        ("<body><h1>Site</h1><div class='post'><h2>Title</h2><div><p>The long text of it.</p></div></div></body>", "Title The long text of it."),
        ("<body><div class='part'><p>Part one.</p></div><div class='part'><p>Part two.</p></div></body>", "Part one. Part two."),
        ("<div class='wrapper ad-free'><main><p>Kept text.</p></main><div class='comments'><article class='comment'>No</article></div></div>", "Kept text."),
        ("<div id='notice-board'><p>The only text of this page.</p></div><div class='related'><p>" + "other " * 50 + "</p></div>", "The only text of this page."),
        ("<div id='notice-board'><p>The only text of this page.</p></div><footer>Foot</footer>", "The only text of this page."),
        ("<div class='ad'>" + "buy " * 50 + "</div><article>Short.</article>", "Short."),
        ("plain &amp; simple", "plain & simple"),
        ("<p>unclosed <i>tags", "unclosed tags"),
        ("<article><p>a<b>b</p><p>c</b>d</p></article>", "ab cd"),
        ("a < b and <3", "a < b and <3"),
        ("", ""),
        ("<script>only()</script>", ""),
        ("<article><div hidden>x</div><div style='display:none'>y</div><p>z</p></article>", "z"),
    ],
)
def test_extraction(html, text):
    assert own(html) == text


POST = "<h2>Title</h2><p>The long text of it, at some length.</p>"
KEPT = "Title The long text of it, at some length."


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (f"<body><form><label>Search</label><input><button>Go</button><article>{POST}</article></form></body>", KEPT),
        (f"<body><form><h1>Site</h1><div class=post>{POST}</div><select><option>One</select><textarea>No</textarea></form></body>", KEPT),
        (f"<body><form><input><article>{POST}</article><footer>Foot</footer></body>", KEPT),
        (f"<body><form action=x><input><div class=post>{POST}</div><footer>Foot</footer>", KEPT),
        (f"<body><main><form><div>{POST}</div></form></main></body>", KEPT),
        (f"<body><form><form class=search><p>Name</p></form><article>{POST}</article></body>", KEPT),
        (f"<body><div role=form><main>{POST}</main></div></body>", KEPT),
        (f"<body style='display: none'><article>{POST}</article></body>", KEPT),
        (f"<div hidden><article>{POST}</article></div><footer>Foot</footer>", KEPT),
        (f"<div aria-hidden=true><form><div class=post>{POST}</div></form></div><nav>Nav</nav>", KEPT),
        (f"<dialog open><article>{POST}</article></dialog>", KEPT),
        (f"<article>Short.</article><form><p>{POST}</p></form><div hidden><article>{POST}</article></div>", "Short."),
        (f"<article>Short.<div hidden>{POST}</div></article><div role=dialog><p>{POST * 3}</p></div>", "Short."),
        (f"<div class=post><p>Short text.</p></div><div role=navigation>{POST * 3}</div>", "Short text."),
    ],
)
def test_wrappers_that_hold_the_text_stay(html, text):
    assert own(html) == text


def test_host_built_in_forms(spark):
    body = "<body><form id=aspnetForm><div class=top><a href=/>Home</a></div><div class=post><p>{}</p><label>Mail</label><button>Send</button></div></form></body>"
    rows = [(i, f"http://f.example/{i}", body.format(f"Text number {i} of this host.")) for i in range(5)]
    got = {r.page_id: r.text for r in H.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: f"Text number {i} of this host." for i in range(5)}


def test_paths_are_generalised():
    assert H.best_paths("<body><div class='post-123 x'><p>words</p></div>")[0][0] == "page>body>div.post-#.x"


def test_host(spark):
    urls = ["http://A.example.com/x", "https://u:p@b.org:8080?q", "no host", None, "HTTP://c.net#x"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, url string")
    assert [r.h for r in df.select("i", H.host(df.url).alias("h")).orderBy("i").collect()] == ["a.example.com", "b.org", "", "", "c.net"]


def page(body, teaser=""):
    return f"<html><body><div class='box'>{teaser}</div><div class='main'>{body}</div></body></html>"


def test_consensus_overrules_a_page(spark):
    """One page's sidebox is longer than its text; the host's other pages tell where the text is."""
    rows = [(i, f"http://h.example/{i}", page("<p>A good long text about something or other.</p>", "<p>short</p>")) for i in range(10)]
    rows.append((99, "http://h.example/99", page("<p>Brief.</p>", "<p>An uncommonly long teaser that is no text at all.</p>")))
    got = {r.page_id: r.text for r in H.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[99] == "Brief." and got[3] == "A good long text about something or other."


def test_table_with_nulls_repeats_extra_columns(spark, monkeypatch):
    long = "<article>" + "<p>para graph</p>" * 30_000 + "</article>"
    rows = [(1, "http://a/1", "<article><p>x</p></article>"), (1, "http://a/1", "<article><p>x</p></article>"), (2, None, None), (None, "u", "")]
    rows += [(3, "http://a/3", "<div><p>other layout</p></div>"), (4, "http://a/4", long)]
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "'clash' AS path", "1 AS host", "2 AS text")
    want = {(1, "x"), (2, ""), (None, ""), (3, "other layout"), (4, " ".join(["para graph"] * 30_000))}
    for limit in (H.BROADCAST_ROWS, 0):  # broadcast and salted join
        monkeypatch.setattr(H, "BROADCAST_ROWS", limit)
        got = H.main_text(df).collect()
        assert len(got) == 6 and {(r.page_id, r.text) for r in got} == want and all(r.n_chars == len(r.text) for r in got)
    assert H.main_text(spark.createDataFrame([], PAGES)).collect() == []


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<article><p>İstanbul İİİ</p><script>var a = 1;</script><p>Second one.</p></article>", "İstanbul İİİ Second one."),
        ("<html><head><title>İİİİİİİİ</title><STYLE>p > b {}</Style></head><body><article><p>Some text.</p></article></body>", "Some text."),
        ("<article><p>İ</p><SCRIPT>if (a </b) {}</ScRiPt ><p>After it.</p><style>no end", "İ After it."),
    ],
)
def test_letters_whose_lower_case_is_longer(html, text):
    assert own(html) == text


@pytest.mark.parametrize("tag", ["div", "b", "section", "ul"])
def test_very_deep_pages_keep_their_text(tag):
    words = [f"word{i}" for i in range(8000)]
    body = "<p>First words of the page.</p>" + "".join(f"<{tag}>{w} " for w in words) + f"</{tag}>" * 7900 + "</table>" * 5000
    html = f"<body><article>{body}<p>Last &<b>amp;</b> words.</p></article><footer>foot</footer></body>"
    (path, _), *_ = H.best_paths(html)
    got = H.extract(html, "page>body>article" if path.count(">") > 2 else path)
    assert got.split()[:2] == ["First", "words"] and [w for w in got.split() if w.startswith("word") and w[4:].isdigit()] == words
    assert got.endswith("Last &amp; words.") and "foot" not in got
