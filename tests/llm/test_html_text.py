"""HTML extraction on hand-made pages."""

import pytest
from awkward import clashing

from pedalflow.llm.html_text import article_nodes, extract, extract_pages, measure, parse

P = "A paragraph with a good number of words in it, so that it weighs something."


@pytest.mark.parametrize("page", [None, "", " ", "<", "<>", "<html></html>", "<script>x</script>", "<!-- only -->", "<p", "</p>"])
def test_no_text(page):
    assert extract(page) in ("", "<", "<>")


def test_plain_article():
    page = (
        f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href=/a>A</a></li></ul></nav>"
        f"<!-- ad --><div class=\"ad\">Buy!</div><article><h1>Head &amp; line</h1><p><b>{P}<br><p>Second\n  &eacute;&#x21;&nbsp;x</p><p></p></article>"
        f"<footer>&copy; me</footer></body></html>"
    )
    assert extract(page) == f"Head & line\n{P}\nSecond é! x"


NOISE = [
    "<header><p>Site name with words</p></header>", "<aside><p>Side words here</p></aside>", "<form>Mail <input></form>",
    '<div class="cookie-notice">We use things</div>', '<div id="sidebar">Links here</div>', '<section class="comments"><p>First reader!</p><p>Second reader!</p></section>',
    '<div role="navigation">Home About</div>', "<noscript>Turn it on</noscript>", "<svg><text>x</text></svg>", "<button>Press</button>",
    '<ul class="menu"><li>One</li></ul>', '<article class="comment"><p>A reader writes</p></article>', "<textarea>t</textarea>", "<select><option>o</select>",
]


@pytest.mark.parametrize("noise", NOISE)
def test_noise_goes_wherever_it_stands(noise):
    for page in (f"<body>{noise}<article><h1>Title</h1><p>{P}</p><p>{P}</p></article></body>", f"<body><article><h1>Title</h1><p>{P}</p>{noise}<p>{P}</p></article></body>", f"<body><article><h1>Title</h1><p>{P}</p><p>{P}</p></article>{noise}"):
        assert extract(page) == f"Title\n{P}\n{P}"


def test_density_finds_the_text_without_semantic_tags():
    links = "".join(f"<li><a href=/{i}>Link number {i}</a></li>" for i in range(30))
    page = f"<body><div><ul>{links}</ul></div><div><h2>Title</h2><p>{P}</p><p>{P}</p><p>{P}</p></div><div><a href=/>Imprint</a></div></body>"
    assert extract(page) == f"Title\n{P}\n{P}\n{P}"


def test_wrappers_with_noise_words_beside_content_stay():
    assert extract(f'<body class="no-sidebar"><div class="content-with-sidebar"><p>{P}</p><p>{P}</p></div></body>') == f"{P}\n{P}"


def test_blocks_and_white_space():
    page = f"<article>Loose text<p>a<i>b</i>\n c<br>d<ul><li>one<li>two</ul>tail<table><tr><td>x<td>y</table><p>{P}</article>"
    assert extract(page) == f"Loose text\nab c d\none\ntwo\ntail\nx\ny\n{P}"


def test_truncated_and_misnested():
    assert extract(f"<article><p>{P}</p><p>{P} <b>un</i>closed</p><p class=\"x") == f"{P}\n{P} unclosed"
    assert extract(f"<article><p>{P} a < b &amp; c > d &unknown; &am") == f"{P} a < b & c > d &unknown; &am"
    assert extract(f'<article><p title="a > b">{P}</p></div></article>') == P


def test_article_header_keeps_its_heading():
    assert extract(f"<article><header><nav>x</nav><h1>Title</h1><p>by me</p></header><p>{P}</p></article>") == f"Title\n{P}"


@pytest.mark.parametrize("outer", ["main", "div", "body"])
def test_text_in_several_articles(outer):
    parts = "".join(f"<article><h2>Part {i}</h2><p>{P}</p><p>{P} {'And more. ' * i}</p></article>" for i in range(1, 4))
    got = extract(f"<body><{outer}><h1>Title</h1>{parts}<div><a href=/a>One</a> <a href=/b>Two</a></div></{outer}></body>")
    want = "\n".join(f"Part {i}\n{P}\n{P} {'And more. ' * i}".strip() for i in range(1, 4))
    assert got == f"Title\n{want}"


def test_an_article_nested_in_the_article():
    page = f"<body><article><h1>Title</h1><p>{P}</p><article><p>{P * 9}</p><p>{P * 9}</p></article><p>{P}</p><p>Short.</p></article></body>"
    assert extract(page) == f"Title\n{P}\n{P * 9}\n{P * 9}\n{P}\nShort."


def test_a_menu_of_any_name_inside_the_article_goes():
    links = "".join(f"<li><a href=/{i}>Link number {i}</a></li>" for i in range(30))
    page = f'<body><article><h1>Title</h1><p>{P}</p><ul class="xyz">{links}</ul><p>{P}</p><p>Short.</p><ul><li>one</ul></article></body>'
    assert extract(page) == f"Title\n{P}\n{P}\nShort.\none"


@pytest.mark.parametrize("inset", ['<svg viewBox="0 0 1 1"/>', "<svg><title/><path d=''/></svg>", "<math/>", "<object>a<object>b</object>c</object>", "<template><p>a<template>b</template>c</template>", "<svg><foreignObject><p>x</p></foreignObject></svg>", "<svg><path>", "<svg><style>a<b</style></svg>"])
def test_insets_end_where_they_end(inset):
    assert extract(f"<body><article><p>{P}</p>{inset}<p>{P}</p><p>end</p></article><p>{inset}") == f"{P}\n{P}\nend"
    assert extract(f"<article><p>{P} a{inset}<b>b</b> c</p><p>{P}</p></article>").endswith(f"c\n{P}")


@pytest.mark.parametrize("tag", ["object", "noscript", "template", "svg"])
def test_left_open_insets_do_not_take_the_rest_of_the_page(tag):
    assert extract(f"<body><article><p>{P}</p><{tag}><p>{P}</p><p>end</p></article></body>") == f"{P}\n{P}\nend"
    assert extract(f"<body><article><div><p>{P}</p><{tag}></div><p>{P}</p><p>end</p>") == f"{P}\n{P}\nend"


def test_formulas_are_text():
    page = f"<article><p>{P} <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x = 2</annotation></math> so</p><p>{P}</p></article>"
    assert extract(page) == f"{P} x=2 so\n{P}"


def test_headings_of_an_article_header_are_in_page_order():
    assert extract(f"<article><header><h1>One</h1><div><h2>Two</h2></div><h3>Three</h3></header><p>{P}</p></article>") == f"One\nTwo\nThree\n{P}"


def test_very_long_and_deep_pages():
    page = "<body><article>" + f"<p>{P}</p>" * 20_000 + "</article></body>"
    assert extract(page).count("\n") == 19_999
    assert extract("<div>" * 5000 + P + "</div>" * 5000) == P
    assert extract("<a title='" * 3000 + f"<p>{P}") is not None


def test_link_text_lowers_density():
    root = parse(f"<body><div>{P}</div><div><a>{P}</a></div></body>")
    measure(root)
    plain, linked = root.items[0].items
    assert plain.density > linked.density
    assert len(article_nodes(root)) >= 1


def test_table(spark):
    rows = [(1, "u", f"<article><p>{P}</p></article>"), (2, None, None), (None, "", ""), (1, "u", f"<article><p>{P}</p></article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = sorted([(1, "u", P, len(P)), (2, None, "", 0), (None, "", "", 0), (1, "u", P, len(P))], key=repr)
    for d in (df, clashing(df)):
        assert sorted(map(tuple, extract_pages(d).collect()), key=repr) == want
    assert extract_pages(df.limit(0)).count() == 0


def test_deep_pages_take_linear_time():
    import time

    deep = "<div>" * 100_000
    pages = [deep + "</p></ul>" * 50_000, "<ul><li>" + deep + "<li>x" * 50_000, "<table><tr>" * 30_000 + "<li>y" * 30_000,
             "<dl>" + "<dd><li>" * 50_000, "<svg><g>" * 50_000 + "</object>" * 50_000]
    for page in pages:
        t = time.perf_counter()
        extract(f"<html><body><article><p>{'Some words of the article. ' * 9}</p></article>{page}")
        assert time.perf_counter() - t < 10
