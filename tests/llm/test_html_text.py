import pytest

from fraudlane.llm.html_text import extract_main_text, main_text

ARTICLE = "<h1>Title &amp; more</h1><p>First, with a comma and enough words to count.<p>Second,   of <b>two</b>\n lines &lt;x&gt;."
TEXT = "Title & more\n\nFirst, with a comma and enough words to count.\n\nSecond, of two lines <x>."


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain & simple", "plain & simple"),
        (f"<nav><a href=/>Menu</a></nav><article>{ARTICLE}</article><footer>&copy; x</footer>", TEXT),
        (f"<div id=content>{ARTICLE}<div class='ad-box'>Buy, buy, buy</div></div><div class=sidebar>a, b, c, d, e</div>", TEXT),
        (f"<div class='cookie-notice'>We use, as you know, cookies.</div><main>{ARTICLE}</main><section id=comments><p>So true, so true, yes, yes</p></section>", TEXT),
        (f"<header><h2>Site</h2></header><article><script>if (a < b) '<p>'</script>{ARTICLE}<style>p{{}}</style><form>Name <input></form></article>", TEXT),
        (f"<article>{ARTICLE}<ul><li>one<li>two</ul><table><tr><td>a<td>b</table><!-- <p>no</p> --></article>", TEXT + "\n\none\n\ntwo\n\na b"),
        ("<article><p>cut off here and the<b", "cut off here and the"),
        ("<article><p>a &notaref; &#x41;&#66; &am", "a ¬aref; AB &am"),
        ("<p>a</p>" * 3 + "<script>unclosed", "a\n\na\n\na"),
        ("<article><p>x<a title='>'>y</a>z</p><p a='never closed>w</p></article>", "xyz\n\nw"),
    ],
)
def test_pages(page, text):
    assert main_text(page) == text


def test_nothing_is_capped():
    page = "<article>" + "".join(f"<p>Paragraph {i}</p>" for i in range(20_000)) + "</article>"
    assert main_text(page).count("\n\n") == 19_999
    assert main_text("<div>" * 5_000 + "deep text, it is") == "deep text, it is"


def test_odd_rows(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, "<article><p>ä　b漢</article>"), (2, "v", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(map(tuple, extract_main_text(pages.selectExpr("*", "1 AS text", "2 AS n_chars")).collect()), key=str)
    assert got == sorted([(1, "u", "", 0), (1, "u", "", 0), (None, None, "ä b漢", 4), (2, "v", "", 0)], key=str)
    assert extract_main_text(pages.limit(0)).count() == 0
