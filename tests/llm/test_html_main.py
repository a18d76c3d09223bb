import pytest

from holdfast.llm import html_main

PAGE = """<!DOCTYPE html><html><head><title>x</title></head><body class="has-sidebar"><header><a>Site</a></header>
<nav><ul><li>a</ul></nav><div class="cookie-notice">We use</div><main><article><header><h1>Title &amp; more</h1></header>
<p>One <b>two</b><br>three&nbsp;four<p>Five<script>var a="</p>"</script> six</p><ul><li>x<li>y</ul><div class="ad">buy</div>
<pre>a
 b</pre><aside>rel</aside><form><p>mail</p></form></article><section id="comments"><article class="comment"><p>first!</p></article></section></main>
<footer>&copy; z</footer></body></html><p"""


@pytest.mark.parametrize(
    "html, text",
    [
        (PAGE, "Title & more\nOne two three four\nFive six\nx\ny\na b"),
        ("", ""),
        ("<p>a<p>b &am", "a\nb &am"),
        ("plain < 5 text <b", "plain < 5 text"),
        ("<div>" * 3000 + "deep", "deep"),
        ("<p>x</div></p><p>y</b>", "x\ny"),
        ("<article><p>a</article><article><p>b</article>", "a\nb"),
        ("<body><div id=sidebar>s</div><div><p>kept</p></div><div hidden>no</div></body>", "kept"),
        ("<p>&lt;b&gt; &#233; &eacute; &#x1F600;</p>", "<b> é é 😀"),
        ("<!-- a --><p>b<!-- c -->d</p>", "bd"),
    ],
)
def test_main_text(html, text):
    assert html_main.main_text(html) == text


def test_templates_of_a_host_go(spark):
    def page(n):
        return f"<body><div><span>Brand bar</span></div><div><h1>Story {n}</h1><p>Body of {n}.</p><p>Shared line.</p></div><div><p>Call us now</p></div></body>"

    pages = [(n, f"https://user@Site.example:80/{n}", page(n)) for n in range(9)]
    # copies of one page make none of its parts a template; another host has too few pages
    pages += [(100 + n, f"http://copies.example/{n}", "<body><div><p>Same story</p></div></body>") for n in range(9)]
    pages += [(200, "http://small.example/", page(200)), (201, None, page(201)), (202, "no host", page(202)), (203, "http://a/", None), (None, "http://a/", "<p>t</p>"), (203, "http://a/", None)]
    frame = spark.createDataFrame([(*p, "x", "x") for p in pages], "page_id long, url string, html string, host string, templates string")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_main.extract(frame).collect()}
    assert got[3][0] == "Story 3\nBody of 3."
    assert got[104][0] == "Same story"
    whole = "Brand bar\nStory 200\nBody of 200.\nShared line.\nCall us now"
    assert got[200] == (whole, len(whole))
    assert got[201][0].startswith("Brand bar") and got[202][0].startswith("Brand bar")
    assert got[203] == ("", 0) and got[None] == ("t", 1)
    assert html_main.extract(frame).count() == len(pages)


def test_paragraphs_of_articles_are_no_templates(spark):
    pages = [(n, f"http://a.example/{n}", f"<body><article><h1>T{n}</h1><p>Shared line.</p><div><a>Follow the author</a></div></article></body>") for n in range(8)]
    got = {r["page_id"]: r["text"] for r in html_main.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {n: f"T{n}\nShared line." for n in range(8)}


def test_empty_table(spark):
    assert html_main.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("long", [2_000, 0])
def test_boxes_of_one_section_of_a_large_host_go(spark, long):
    def page(n):
        box = "<div><p>Offer of the section</p></div>" if n % 4 == 0 else ""
        rare = "<div><p>Said twice</p></div>" if n in (1, 2) else ""
        return f"<body><div><h1>Story {n}</h1><p>Body of {n}.</p></div>{box}{rare}<div><span>Brand bar</span></div></body>"

    pages = [(n, f"http://large.example/s{n % 4}/{n}", page(n)) for n in range(400)]
    pages += [(None, "http://large.example/s0/0", page(0)), (1000, None, page(0)), (1001, "http://other.example/", page(0)), (1002, "http://large.example/", None)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    rows = html_main.extract(frame, long=long).collect()
    got = {r["page_id"]: r["text"] for r in rows}
    assert len(rows) == len(pages) and got[1002] == ""
    for n in range(400):
        assert got[n] == f"Story {n}\nBody of {n}." + ("\nSaid twice" if n in (1, 2) else "")
    assert got[None] == got[0]
    assert got[1000] == got[1001] == "Story 0\nBody of 0.\nOffer of the section\nBrand bar"
