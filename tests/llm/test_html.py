"""HTML extraction: hand-made layouts, wrappers, a plain reading of the test pages."""

import html
import re

from mercato.llm import html_extract as H
from mercato.llm import queries
from tests.conftest import SF_SMALL

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a><li>More</ul></nav>
<div class="cookie-notice">We use cookies</div>{extra}<article class="post"><h1>{title}</h1>
<p>One &amp; two<b> bold</b>.<br>next</p><script>var x="</p>";</script><p>un<i>closed
<p>Third&nbsp;&lt;p&gt;</p><div class="ad">Buy!</div><ul><li>a<li>b</ul><form>Name <input></form>
<!-- <p>hidden</p> --></article><section id="comments"><p>I disagree</p></section>
<aside>Side</aside><footer>&copy; me</footer></body></html>"""
WANT = "{title}\n\nOne & two bold. next\n\nunclosed\n\nThird <p>\n\na\n\nb"


def test_layouts(spark):
    rows = [(i, "http://A.example/x?%d" % i, PAGE.format(title=f"Title {i}", extra="<p>x</p>" * (i % 3)))
            for i in range(5)]
    rows += [(5, None, None), (6, "odd", ""), (7, "http://a.example/y", "plain text"),
             (None, "http://a.example", "<article><p>x"), (None, "http://a.example", "<article><p>x")]
    body = "Long varying text of page {i}, and {i} more words. " * 5
    rows += [(10 + i, "http://b.example/", f"<div id=top><p>Same on all</p></div><div class=c><h2>H{i}</h2>"
              f"<p>{body.format(i=i)}</p></div><div><a href=x>links {i} links</a></div>") for i in range(4)]
    pages = spark.createDataFrame([(*r, "w", "h") for r in rows],
                                  "page_id long, url string, html string, wrapper string, host string")
    got = {r.page_id: r.text for r in H.extract(pages).collect()}
    for i in range(5):
        assert got[i] == WANT.format(title=f"Title {i}")
    assert got[5] == got[6] == "" and got[7] == "plain text" and got[None] == "x"
    for i in range(4):
        assert got[10 + i] == f"H{i}\n\n{body.format(i=i).strip()}"
    assert H.extract(pages.limit(0)).count() == 0
    assert H.extract(pages).count() == len(rows)


def test_wrapper_has_optional_and_repeated_groups():
    trees = [H.folded(H.parse(t)[H.CHILDREN]) for t in (
        "<div><h1>a</h1><p>x</p><p>y</p></div>", "<div><p>z</p></div>",
        "<div><h1>a</h1><table><tr><td>1</table></div>")]
    whole = trees[0]
    for t in trees[1:]:
        whole = H.align(whole, t)
    (div,) = whole
    assert [(n[H.KIND], n[H.TIMES]) for n in div[H.CHILDREN]] == [("h1", "?"), ("p", "*"), ("table", "?")]
    assert div[H.CHILDREN][0][H.CHILDREN][0][H.TEXT] == "a"      # a constant
    assert div[H.CHILDREN][1][H.CHILDREN][0][H.TEXT] is None     # a slot


def test_broken_markup_does_not_hang():
    for page in ("<" * 50_000, "<a " * 20_000, "<p class='" * 20_000, "<!--" * 20_000, "<script>" * 9_000,
                 "<div>" * 20_000, "<div class=ad>" * 20_000, "</p>" * 20_000, '<p a="' + "x" * 100_000, "&" * 50_000):
        H.article(page, {("article",)})


def plain(page):
    """The article of the test pages, read by their one layout."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", body)
    texts = (" ".join(html.unescape(re.sub(r"<br>|</?b>", " ", b)).split()) for b in blocks)
    return "\n\n".join(t for t in texts if t)


def test_query_equals_a_plain_reading(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    got = queries.op8_html_extract(spark, SF_SMALL).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == plain(pages[r.page_id]) and r.n_chars == len(r.text)


def test_words_in_classes_and_ids_do_not_cost_text(spark):
    inner = ('<h1>T{i}</h1><section id="login-flow"><h2 id="related-work">R{i}</h2><p>s{i}</p></section>'
             '<h2 id="how-to-share-files">H</h2><table class="header"><tr><td>c{i}</table>'
             '<p class="ad-hoc">a <span class="comment"># x</span> <i data-id="ad">y</i></p>'
             '<div class="cookie-notice">We bake</div><div class="share-links"><a>{i} Tweet</a></div>'
             '<div class="share-price">up {i}</div><p class="ad">Buy {i}</p><div class="menu">m{i}</div>')
    want = "T{i}\n\nR{i}\n\ns{i}\n\nH\n\nc{i}\n\na # x y\n\nup {i}"
    pages = [f'<body class="no-sidebar"><article class="post has-comments">{inner}'
             '<article class="comment">no {i}</article></article></body>',
             f'<body class="no-sidebar"><div class="modal"><article>{inner}</article></div></body>',
             f'<form id=all><main class="header">{inner}</main></form>',
             f'<article class="related">{inner}</article>']
    rows = [(10 * k + i, f"http://h{k}/{i}", p.replace("{i}", str(i))) for k, p in enumerate(pages) for i in range(3)]
    alone = '<div class="modal"><article><p>a</p><p>b</p><div class="ad-hoc">c</div></article></div>'
    rows += [(97, "http://once", alone), (98, "http://twice", alone), (99, "http://twice", alone)]
    got = {r.page_id: r.text for r in H.extract(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(len(pages)):
        for i in range(3):
            assert got[10 * k + i] == want.format(i=i), (k, i)
    assert got[99] == got[98] == got[97] == "a\n\nb\n\nc"


def test_elements_that_are_not_closed_cost_no_text():
    for tag in ("<svg-icon name=x></svg-icon>", "<video-js>", "<button-group>", "<select-menu>", "<style-guide>",
                '<svg viewBox="0 0 1 1"/>', "<svg><path d=x/><g/></svg>", "<math/>", "<button>", "<object>",
                "<iframe src='x>y'>", "<select>", "</button>", "<SVG\n/>", "<button>b</button>",
                "<noscript><p>n</p></noscript>", "<script>s</script >", "<select><option>o<option>p</select>",
                "<button><svg/><b>b</button>", "<template><button>x</template>", "<svg><svg/>x</svg>"):
        page = f"<article><div><p>a {tag} b</p><p>c</div>{tag}<p>d</p></article><button>x</button>"
        assert H.article(page, {("article",)}).split() == ["a", "b", "c", "d"], tag
        if "-" not in tag:
            assert H.article(page, {("article",)}) == "a b\n\nc\n\nd", tag
    assert H.article("<article>a<button>b<p>c</p><button>x</button><p>d</article>e</button>",
                     {("article",)}) == "a b\n\nc\n\nd"
    for page in ("<button>" * 20_000, "<svg><p>" * 20_000 + "</svg>" * 20_000, "<script " + "a='b' " * 5_000):
        H.article(page, {("article",)})


def test_figures_addresses_formulas_and_objects_are_text():
    page = ("<article><figure><table><tr><td>1<td>2</table><figcaption>Cap</figcaption></figure>"
            "<figure class=quote><blockquote>Q</blockquote></figure><address>Road 1</address>"
            "<p>If <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math> then</p>"
            "<object data=x><p>Object</p></object><p>a<canvas>b</canvas>c</p><video><source src=x>Film</video>"
            "<audio>Song</audio><form>F</form><fieldset>G</fieldset><button>B</button></article>")
    assert H.article(page, {("article",)}).split("\n\n") == [
        "1", "2", "Cap", "Q", "Road 1", "If x = 1 2 then", "Object", "a b c", "Film Song"]


def test_deep_nests_close_no_ancestor():
    for tag, depth in (("div", 250), ("div", 20_000), ("blockquote", 300)):
        nest = f"<{tag}>" * depth + "<p>deep<ul><li>l<li>m</ul>" + f"</{tag}>" * depth
        page = f"<div id=page><article><p>a</p>{nest}<p>b</p>{nest}<p>c</article><p>no</p></div>"
        assert H.article(page, {("div.page", "article")}) == (
            "a\n\ndeep\n\nl\n\nm\n\nb\n\ndeep\n\nl\n\nm\n\nc"), (tag, depth)
    page = "<div>" * 300 + "<p>x</p><article><p>a<div class=ad><p>no</div><p>b</article>" + "</div>" * 300 + "y"
    assert H.article(page, {("article",)}) == "a\n\nb"
    for page in ("<td><div>" + "<blockquote>" * 20_000 + "<td></td>" * 20_000, "<article>" * 20_000 + "x",
                 "<div>" * 20_000 + "</p></div>" * 20_000, "<nav><article>" * 9_000 + "x"):
        H.folded(H.parse(page)[H.CHILDREN])


BODY = "<h1>Title {i}</h1><p>" + "Words of page {i}, told at length. " * 4 + "</p><p>End {i}.</p>"
SAID = "Title {i}\n\n" + ("Words of page {i}, told at length. " * 4).strip() + "\n\nEnd {i}."


def _host(spark, layouts, pages=6):
    """Layouts (one host each) -> texts per layout."""
    rows = [(k * 100 + i, f"http://h{k}/{i}", x.replace("{body}", BODY).replace("{i}", str(i)))
            for k, x in enumerate(layouts) for i in range(pages)]
    got = {r.page_id: r.text for r in H.extract(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    return [[got[k * 100 + i] for i in range(pages)] for k in range(len(layouts))]


def _says(more=""):
    return [(SAID + more).replace("{i}", str(i)) for i in range(6)]


def test_pages_without_a_head_end_tag(spark):
    layouts = ["<html><head><title>T</title><meta charset=x><body><article>{body}</article>",
               "<head><title>T</title><link rel=x><div id=content>{body}</div>",
               "<head><script>x</script><style>y</style><p>lead {i}</p>{body}"]
    got = _host(spark, layouts)
    assert got[0] == got[1] == _says()
    assert got[2] == [f"lead {i}\n\n" + t for i, t in enumerate(_says())]


def test_forms_around_a_page(spark):
    layouts = ["<body><form id=f><div id=content>{body}</div></form>",
               "<body><form id=f><nav><a>n</a></nav><div id=content>{body}</div><input></form><footer>f</footer>",
               "<body><div id=content>{body}</div><form><p>Your name {i}</p><p>Your mail</p></form>"]
    assert _host(spark, layouts) == [_says()] * 3


def test_reader_comments_and_adverts_in_compound_names(spark):
    around = ['<section id="comments"><p>I say {i} and {i}</p></section>',
              '<section id="comments" class="comments-area"><p>I say {i}</p></section>',
              '<div class="comment-list"><p>I say {i}</p><p>No {i}</p></div>',
              '<ol class="commentlist"><li>I say {i}<li>No {i}</ol>',
              '<div class="ad-container"><p>Buy {i} now</p></div>',
              '<div class="sidebar-left"><p>Side {i}</p></div>']
    layouts = [f"<body><article>{{body}}{x}</article>" for x in around]
    layouts += [f"<body><div id=content>{{body}}</div>{x}" for x in around]
    assert _host(spark, layouts) == [_says()] * len(layouts)
    # on some pages only
    some = _host(spark, ["<body><article>{body}<div class='ad-slot'>Buy {i}</div></article>"])[0]
    assert some == _says()


def test_sections_of_the_article_with_such_names(spark):
    layouts = ['<body><article>{body}<div class="discussion"><p>Shown {i}</p></div></article>',
               '<body><article>{body}<section class="related"><p>Shown {i}</p></section></article>',
               '<body><article>{body}<div class="no-comments"><p>Shown {i}</p></div></article>',
               '<body><div class="post has-comments">{body}<p>Shown {i}</p></div>',
               '<body class="sidebar-left"><article>{body}<p>Shown {i}</p></article>']
    assert _host(spark, layouts) == [_says("\n\nShown {i}")] * len(layouts)


def test_own_identifiers_do_not_widen_a_wrapper():
    """Sections, headings and paragraphs with identifiers of their own on every page."""
    def page(i):
        return "<article>" + "".join(
            f'<section id="s{chr(97 + i % 26)}{chr(97 + j)}"><h2 id="about-{i}-{j}">h</h2><p id=p{i}{j}>x{i}</p></section>'
            for j in range(10)) + "</article>"

    whole = H.folded(H.parse(page(0))[H.CHILDREN])
    first = len(str(whole))
    for i in range(1, 300):
        whole = H.align(whole, H.folded(H.parse(page(i))[H.CHILDREN]))
    assert len(str(whole)) <= first + 20
