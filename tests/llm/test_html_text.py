import pytest

from waypost.llm.html_text import extract_text, lines, main_text, shared

SCHEMA = "page_id long, url string, html string, host string, path int"

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x:"</p>"}</style><script>var a="<p>no</p>";</script></head>
<body class="has-sidebar"><header><a href=/>Site</a></header><nav><ul><li>Home</li></ul></nav><div class="cookie-notice">We use cookies</div>
<div class="ad">Buy</div><article><h1>Title &amp; more</h1><p><b>First
  line<br>goes on<br><p>Second &#233;&nbsp;x<div class="advert">Buy again</div><ul><li>one</li><li>two</li></ul>
<section id="comments"><p>me too</p></section></article><aside>See also</aside><form><p>mail</p></form>
<footer>&copy; me</footer></body></html>"""


def plain(page):
    return main_text(lines(page), None)


def test_article_only():
    assert plain(PAGE) == "Title & more\nFirst line goes on\nSecond é x\none\ntwo"


@pytest.mark.parametrize("cut", range(0, len(PAGE), 7))
def test_cut_pages_do_not_fail(cut):
    whole = plain(PAGE).split("\n")
    got = plain(PAGE[:cut])
    assert "var a" not in got and "Home" not in got and "<" not in got.replace("<p", "")
    assert len(got.split("\n")) <= len(whole)


def test_odd_markup():
    assert plain("") == "" and plain("just text") == "just text" and plain("a < b <c>d</c>") == "a < b d"
    assert plain("<p>x<!-- <p>no --><p>y<!-- open") == "x\ny"
    assert plain("<div class=ad>z<article><p>kept</article>") == "kept"
    assert plain('<p title="a>b">q</p><p class="lead address">r</p><p hidden>s</p>') == "q\nr"
    assert plain("<p>" * 50_000 + "deep") == "deep"
    assert len(plain("<div>" * 20_000 + "x" * 100_000)) == 100_000


def test_shared_is_a_longest_common_subsequence():
    assert shared(list("abcde"), list("xbydz")) == {1, 3}
    assert len(shared(list("abab"), list("baba"))) in (2, 3)
    assert shared([], ["a"]) == set() and shared(["a"], []) == set()


def test_shared_lines_of_the_nearest_page_go(spark):
    frame = "<div><p>Menu</p></div><p>{}</p><p>Imprint</p>"
    rows = [
        (1, "http://h.org/a/1", frame.format("one"), None, None),
        (2, "https://H.org/a/2?x=1", frame.format("two"), None, None),
        (3, "http://h.org/z", "<p>Menu</p><p>three</p>", None, None),
        (4, "http://alone.org/", frame.format("four"), None, None),
        (5, None, frame.format("five"), None, None),
        (6, "http://h.org/a/3", PAGE, "h", 1),
        (6, "http://h.org/a/3", PAGE, "h", 1),
        (None, "not a url", None, None, None),
    ]
    got = extract_text(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()
    text = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert text[1] == "one" and text[2] == "two" and text[3] in ("three", "Menu\nthree")
    assert text[4] == "Menu\nfour\nImprint" and text[5] == "Menu\nfive\nImprint" and text[None] == ""
    assert text[6].startswith("Title & more")  # a copy next to it deletes nothing of an article
    assert extract_text(spark.createDataFrame([], SCHEMA)).collect() == []
