import html
import re
import time

from tests.llm.cases import with_clashes

from pitchlake.llm import page_text, registry


def pages(spark, sources):
    return spark.createDataFrame([(i, f"http://x/{i}", h) for i, h in enumerate(sources)], "page_id long, url string, html string")


def test_whole_table_is_the_article(spark, sf_dir):
    sources = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = registry.op7_page_text(spark, sf_dir).collect()
    assert {r["page_id"] for r in found} == set(sources)
    for r in found:
        inside = re.search(r"<article>(.*?)</article>", sources[r["page_id"]], re.S).group(1)
        plain = re.sub(r"<(?!/?b>)[^>]*>", " ", inside).replace("<b>", "").replace("</b>", "")
        assert r["text"] == " ".join(html.unescape(plain).split()) and r["n_chars"] == len(r["text"])


WORDS = "Readers of this paper have long known, and said so, that rivers rise in spring. "
NAMELESS = (
    "<html><body><div><ul><li><a href=a>Home</a></li><li><a href=b>Shop</a></li><li><a href=c>About us</a></li></ul></div>"
    f"<div><h1>Rivers</h1><p>{WORDS * 3}</p><p>{WORDS * 4}<i>Really</i>, they do.</p><p>{WORDS * 2}</p></div>"
    "<div class='comments'><p>first!</p></div><div><a href=x>one</a> <a href=y>two</a> <a href=z>three</a></div></body></html>")


def test_pages_that_name_nothing(spark, sf_dir):
    known = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    found = page_text.main_text(known.unionByName(pages(spark, [NAMELESS]).selectExpr("-1L page_id", "url", "html"))).where("page_id = -1")
    text = found.first()["text"]
    assert "Really, they do." in text and text.count("Readers") == 9
    assert "first!" not in text and "Shop" not in text and "three" not in text


def test_parsing():
    nodes, texts = page_text.parse(
        "<!-- <p>no</p> --><p>a<b>b</b> &amp; c<p>d<br>e<script>x < y</script><ul><li>1<li>2</ul></div>z<img src='a>b'> <a>l</a>, <p")
    page_text.measure(nodes, texts)
    assert page_text.joined(texts, [True] * len(nodes)) == "ab & c d e 1 2 z l, <p"
    assert [n.tag for n in nodes] == ["root", "p", "p", "ul", "li", "li", "a"]
    assert nodes[4].parent == nodes[5].parent == 3
    assert page_text.parse(None)[1] == [] and page_text.parse("")[1] == []


def test_nothing_is_kept_below_a_dropped_element():
    nodes, texts = page_text.parse("<div><p>good good good</p><div><p>good</p></div></div><div>bad<p>fine</p></div>")
    page_text.measure(nodes, texts)
    odds = [0, 1, 3, -1, 2, -9, 1]
    keep = page_text.decode(nodes, odds)
    for i, node in enumerate(nodes[1:], 1):
        assert not keep[i] or keep[node.parent]
    assert page_text.joined(texts, keep) == "good good good good"


def test_awkward_rows(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    sources = [None, "", "plain text", "<p>", deep, NAMELESS, NAMELESS, "<article>" + "x " * 50_000 + "</article><nav>menu</nav>"]
    df = with_clashes(pages(spark, sources), "text", "values", "label", "features")
    found = {r["page_id"]: r for r in page_text.main_text(df).collect()}
    assert found[0]["text"] == found[1]["text"] == found[3]["text"] == ""
    assert len(found[7]["text"]) == 99_999 and "menu" not in found[7]["text"]
    assert found[5]["text"] == found[6]["text"] and all(r["label"] == "extra" for r in found.values())
    assert page_text.main_text(df.limit(0)).collect() == []
    unnamed = page_text.main_text(pages(spark, [NAMELESS.replace("class='comments'", ""), None])).first()["text"]
    assert "Really, they do." in unnamed


def words(page):
    nodes, found = page_text.parse(page)
    return page_text.joined(found, [True] * len(nodes))


def test_self_closed_and_unclosed_elements_hide_nothing():
    assert words("<article><p>Before <svg class='i'/> after the icon.</p><p>Second</p></article>") == "Before after the icon. Second"
    assert words("<p>a <svg><path/> b <iframe> c <noscript> d</p>") == "a b c d"
    assert words("<p>a <svg><title>x</title><g/></svg> b <script>c</p>") == "a b"


def test_stray_quotes_and_ends():
    assert words("<p class='x>one</p><p>two</p>") == "one two"
    assert words("<p title='a>b' class=\"c>d\">one</p>") == "one"
    assert words("one <b two") == "one <b two" and words("<! one") == "<! one" and words("a < b") == "a < b"
    assert words("<![CDATA[hello world") == "hello world" and words("<![CDATA[a <b> c]]> d") == "a <b> c d"
    assert words("a <!-- b") == "a" and words("a <!-- b > --> c") == "a c"


def test_references_end_with_their_piece():
    assert words("&lt<i>;x</i> &amp;lt; &#65;") == "<;x &lt; A"


def test_odd_pages_take_time_in_proportion():
    def seconds(page):
        start = time.process_time()
        page_text.parse(page)
        return time.process_time() - start

    for piece in ("<a '", "<a '>' ", "<!", "<svg>", "<p \"'>", "&lt<i>", "<", "<![CDATA[", "</svg", "<a href=\"x>"):
        assert seconds(piece * (1_000_000 // len(piece))) < 20, piece
