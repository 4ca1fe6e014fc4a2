import math
from random import Random

from terroir.llm.extraction import extract_text, main_text, smoothed, threshold

LONG = "A sentence of the article with quite a few words in it, which goes on for a while."


def test_article_without_the_rest():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
    <header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="ad">{LONG}</div>
    <div id="cookie-notice">{LONG}</div><article><h1>Title &amp; more</h1><p><b>{LONG}<br><p>Short.</p><!-- no -->
    <ul><li>one<li>two</ul><table><tr><td>x<td>y</table><form><input value=q>Subscribe</form>
    <p>caf&eacute;&nbsp;&#8364;\n\t  au   lait</p><script>no()</script><aside>{LONG}</aside>
    <section class="comments"><p>{LONG}</p></section></article>
    <div class="sidebar">{LONG}</div><footer>&copy; {LONG}</footer></body></html>"""
    blocks = ["Title & more", LONG, "Short.", "one", "two", "x", "y", "café € au lait"]
    assert main_text(page) == "\n".join(blocks)


def test_page_without_content_elements():
    page = f"""<body><div><a href=a>Home</a> <a href=b>News</a></div><h2>Heading</h2><p>{LONG} {LONG}</p><p>Short.</p>
    <p>{LONG}</p><div><a href=c>Next</a></div><div><a href=d>Imprint</a></div><div><a>x</a></div></body>"""
    assert main_text(page).endswith(f"{LONG} {LONG}\nShort.\n{LONG}") and "Imprint" not in main_text(page)


def test_a_heading_in_the_article_header_stays():
    page = f"<article><header><h1>Title</h1><span>by me</span></header><p>{LONG}</p></article>"
    assert main_text(page) == f"Title\n{LONG}"


def test_a_layout_class_drops_no_article():
    for name in ("page has-sidebar", "no-header", "with-menu article", "layout-without-footer"):
        assert main_text(f'<div class="{name}"><article><p>{LONG}</p></article></div>') == LONG
    assert main_text(f'<div class="sidebar"><p>{LONG}</p></div><article><p>{LONG} b</p></article>') == f"{LONG} b"


def test_a_text_of_a_listed_name_in_an_article_stays():
    page = f'<article><p>{LONG}</p><div class="share-text">{LONG} c</div><div class="share-buttons">Share</div></article>'
    assert main_text(page) == f"{LONG}\n{LONG} c"


def test_short_first_and_last_paragraphs_without_an_article():
    assert main_text(f"<p>Short start.</p><p>{LONG}</p><p>{LONG}</p><p>Short end.</p>") == f"Short start.\n{LONG}\n{LONG}\nShort end."
    page = f"<body><div><a>Home</a></div><div><p>So.</p><p>{LONG}</p><p>{LONG}</p><p>End.</p></div><div><a>Next</a> <a>Up</a></div></body>"
    assert main_text(page) == f"So.\n{LONG}\n{LONG}\nEnd."


def test_the_ratio_chooses_the_region():
    """A tiny article beside a long text isn't the page's text; a long one is, whatever stands around it."""
    assert main_text(f"<body><article>a</article><div><p>{LONG}</p><p>{LONG}</p></div></body>") == f"{LONG}\n{LONG}"
    page = f"<body><div><p>{LONG}</p></div><article><p>{LONG}</p><p>{LONG}</p><p>b</p></article></body>"
    assert main_text(page) == f"{LONG}\n{LONG}\nb"


def brute_region(blocks):
    """Regions of (region, text, tags): the plain rule, with sums over all pairs."""
    logs = [math.log1p(len(t) / (1 + tags)) for _, t, tags in blocks]
    smooth = []
    for i in range(len(logs)):
        near = {j: math.exp(-((i - j) ** 2) / 2) for j in range(len(logs)) if abs(i - j) <= 2}
        smooth.append(sum(w * logs[j] for j, w in near.items()) / sum(near.values()))
    cut = threshold(smooth)
    regions = {r for (r, _, _), v in zip(blocks, smooth, strict=True) if v >= cut}
    high = [i for i, v in enumerate(smooth) if v >= cut]
    return [t for i, (r, t, _) in enumerate(blocks) if r in regions or high[0] - 1 <= i <= high[-1]]


def test_regions_against_brute_force():
    random = Random(3)
    for _ in range(200):
        blocks, html = [], ""
        for region in range(random.randint(1, 5)):
            long = random.random() < 0.5
            html += "<div>"
            for k in range(random.randint(1, 5)):
                text = LONG if long and random.random() < 0.8 else f"w{region} {k}"
                # The tags since the last line, the one that ends this line included.
                html += f"<p>{text}</p>"
                blocks.append((region, text, 2 if k else 4 if blocks else 3))
            html += "</div>"
        assert main_text(html) == "\n".join(brute_region(blocks))


def test_broken_markup():
    assert main_text("") == "" and main_text("just text") == "just text"
    assert main_text("<article>a<![foo bar]>b") == "a<![foo bar]>b"
    assert main_text(f"<article><p>{LONG}</div></span><p>b</article></article>") == f"{LONG}\nb"


def test_smoothing_and_threshold():
    assert smoothed([2.0] * 5) == [2.0] * 5 and abs(threshold([1, 1, 1, 9, 9]) - 5) < 1e-9
    assert threshold([3.0]) == 3.0


def test_rows(spark):
    rows = [(1, "http://a", f"<article><p>{LONG}</p></article>", "x"), (None, None, None, "x"), (3, "u", "<p></p>", "x")]
    rows += [(4, "u", "<article>" + f"<p>{LONG}</p>" * 3000 + "</article>", "x")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((tuple(r) for r in extract_text(pages).collect()), key=str)
    whole = "\n".join([LONG] * 3000)
    expected = [(1, "http://a", LONG, len(LONG)), (None, None, "", 0), (3, "u", "", 0), *[(4, "u", whole, len(whole))] * 2]
    assert got == sorted(expected, key=str)
    assert extract_text(pages.limit(0)).collect() == []
