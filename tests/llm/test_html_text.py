from chunksink.llm.html_text import extract, main_text

PAGE = """<!DOCTYPE html><html><head><title>No</title><script>var t="</p>";</script></head><body>
<div id="cookie-notice">We use cookies on this site to give you the best experience of it, and to measure.</div>
<header><h1>Site name</h1></header><nav><ul><li><a href="/a">A</a></li></ul></nav>
<main><article><header><h1>A &amp; B</h1></header><p>The first   paragraph of the article is\nlong enough to be kept for its own sake.</p>
<div class="ad-slot">Buy the best of the things that are on sale in the shops of the town today.</div>
<p>Short.</p><p>See <a href="/x">this</a>, a second paragraph with some words of the language in it and a link.<br>Next line</p>
<ul><li><a href="/r">Read more of that</a></li></ul><form>Name <input><button>Send</button></form>
<section class="comments"><p>I think that this is the best of all the articles I have read on the site.</p></section>
</article></main><aside>Other words that stand at the side of the page and are of no use to the reader.</aside>
<footer>&copy; 2024 all rights</footer><style>p{}</style></body></html>"""


def test_article_alone_is_kept():
    assert main_text(PAGE).split("\n\n") == [
        "A & B",
        "The first paragraph of the article is long enough to be kept for its own sake.",
        "Short.",
        "See this, a second paragraph with some words of the language in it and a link. Next line",
        "Read more of that",
    ]


def test_page_without_article_uses_density():
    html = "<body><div><a href=1>Home</a> <a href=2>News</a></div><div><p>It is the story of a man and of the town that he was born in, and it ends well.<p>The end.</div><div>Terms</div>"
    assert main_text(html) == "It is the story of a man and of the town that he was born in, and it ends well.\n\nThe end.\n\nTerms"


def test_broken_markup():
    assert main_text("<article><p><b>One two.<br><p>Three</article") == "One two.\n\nThree"
    assert main_text("a < b & c") == ""
    assert main_text("<article>a < b &lt;i&gt;</article>") == "a < b <i>"
    assert main_text("<article><!-- x --><p>yes<!-- never closed") == "yes"


def test_table_cases(spark):
    df = spark.createDataFrame([(1, None, "u"), (2, "", "u"), (3, PAGE, "u"), (3, PAGE, "u"), (4, "<article><p>" + "the word " * 200_000, "u")], "page_id long, html string, text string")
    got = [(r.page_id, len(r.text)) for r in extract(df).collect()]
    n = len(main_text(PAGE))
    assert sorted(got) == [(1, 0), (2, 0), (3, n), (3, n), (4, 9 * 200_000 - 1)]
    assert extract(df.limit(0)).count() == 0


def test_names_inside_an_article():
    body = "<p>The text of the article is here and it is long enough to be kept as it is.</p>"
    for kind in ("advert", "comment", "ad-slot", "comments", "related-posts"):
        assert main_text(f'<article>{body}<p class="{kind}">Some other words that are not of the article at all, as you see.<p>End</article>').endswith("End")
        assert "other words" not in main_text(f'<article>{body}<ul><li class="{kind}">Some other words that are not of the article.<li>End</ul></article>')
    for kind in ("related-work", "discussion", "legal"):
        assert main_text(f'<article><div class="{kind}"><h2>Head</h2>{body}</div></article>').count("\n\n") == 1
    links = "<article><p><a href=1>A paragraph of the article that is one link and nothing else at all.</a></p><ul><li><a href=2>One</a><li><a href=3>Two</a></ul></article>"
    assert main_text(links).split("\n\n") == ["A paragraph of the article that is one link and nothing else at all.", "One", "Two"]
    table = "<article><table><tr><td>a<td class=ad>b<tr><th>c</table></article>"
    assert main_text(table).split("\n\n") == ["a", "c"]


def test_unclosed_elements_hide_nothing():
    assert main_text("<article><video><p>One.</p><select><p>Two.</article>").split("\n\n") == ["One.", "Two."]
    assert main_text("<article><video>No</video><p>One.</article>") == "One."


def test_many_blocks_take_linear_time():
    import time

    def seconds(n):
        page = "<article>" + "<p>short</p>" * n + "</article>"
        began = time.process_time()
        assert main_text(page).count("short") == n
        return time.process_time() - began

    small = seconds(4000)
    assert seconds(64_000) < 16 * 8 * max(small, 0.02)


def test_tables_match_an_independent_reading(spark):
    """The pages of the generated tables, read by another parser: text of the article but for adverts, block by block."""
    from html.parser import HTMLParser

    from chunksink.llm import queries

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__()
            self.inside, self.off, self.blocks, self.words = False, 0, [], []

        def flush(self):
            if text := " ".join("".join(self.words).split()):
                self.blocks.append(text)
            self.words = []

        def handle_starttag(self, tag, attrs):
            if tag == "article":
                self.inside = True
            elif tag == "div" and dict(attrs).get("class") == "ad":
                self.off += 1
            elif tag == "br":
                self.words.append(" ")
            if tag in ("p", "h1", "article", "div"):
                self.flush()

        def handle_endtag(self, tag):
            if tag in ("p", "h1", "article", "div"):
                self.flush()
            if tag == "article":
                self.inside = False
            elif tag == "div" and self.off:
                self.off -= 1

        def handle_data(self, data):
            if self.inside and not self.off:
                self.words.append(data)

    for sf in ("sf0.001", "sf0.01"):
        pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet").collect()
        want = {}
        for r in pages:
            reader = Reader()
            reader.feed(r.html or "")
            reader.close()
            reader.flush()
            want[r.page_id] = "\n\n".join(reader.blocks)
        assert {r.page_id: r.text for r in queries.op7_html_text(spark, f"/root/testdata/{sf}").collect()} == want
