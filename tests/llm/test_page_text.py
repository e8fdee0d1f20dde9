"""Main text of planted pages, the region scan against all spans, and odd tables."""

from __future__ import annotations

import random
import time

import pytest

from martkit.llm import page_text

WORDS = "alder brook cedar delta ember fjord grove heath inlet knoll larch marsh".split()
#: What pages have around and between their text.
APART = [
    "<nav><ul><li><a href='/a'>Home</a></li><li><a href=/b>News</a></li></ul></nav>",
    '<div class="ad">Buy two, get one</div>',
    "<aside><h3>Also read</h3><p>Other story here today</p></aside>",
    '<div id="cookie-banner"><p>We use cookies</p><button>Fine</button></div>',
    "<form action=x><label>Mail</label><input name=q><select><option>one<option>two</select></form>",
    '<section class="commentList comments"><article class="comment"><p>First! I liked it a lot, it was good.</p></article></section>',
    "<script>var t='</p><p>not text';</script><style>p{}</style><!-- <p>nor this</p> -->",
    '<div role="complementary">Most read of the week</div><div style="display: none">unseen</div>',
    '<ul class="breadcrumbs"><li>Top<li>Sub</ul>',
    "<footer>&copy; the makers</footer>",
]
SHAPES = [  # the whole, and how a block of text is set
    ("<html><body>{top}<article>{text}</article>{end}</body></html>", "<p>{}</p>"),
    ("<body>{top}<main><article>{text}{end}</article></main>", "<p>{}"),
    ("{top}<main id=main-content>{text}</main>{end}", "<h2>{}</h2>"),
    ('<div class="page has-sidebar">{top}<div id="content">{text}</div>{end}</div>', "<p>{}</p>"),
    ("<table><tr><td>{top}</td><td>{text}</td></tr></table>{end}", "<p class=lead>{}</p>"),
]


def _line(rng):
    return " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 30))) + "."


def _planted(rng, shape):
    whole, one = shape
    lines = [_line(rng) for _ in range(rng.randint(3, 8))]
    marked = [x.replace("alder", "<b>alder</b>").replace("brook ", "brook&#32;\n ").replace("cedar", "<a href='#'>c&#101;dar</a>", x.count(" ") // 4) for x in lines]
    body = []
    for k, x in enumerate(marked):
        body.append(one.format(x))
        if rng.random() < 0.3 and k + 1 < len(marked):
            body.append(rng.choice(APART[1:]))
    top = "".join(rng.sample(APART[:4], rng.randint(0, 3)))
    return whole.format(top=top, text="".join(body), end=rng.choice(APART[5:])), "\n".join(lines)


@pytest.mark.parametrize("shape", range(len(SHAPES)))
def test_planted_text_comes_back_whole(shape):
    rng = random.Random(shape)
    for _ in range(60):
        page, text = _planted(rng, SHAPES[shape])
        assert page_text.main_text(page, {}) == text, page


def test_learned_weights_keep_planted_texts(spark):
    rng = random.Random(9)
    planted = [_planted(rng, SHAPES[k % len(SHAPES)]) for k in range(200)]
    table = spark.createDataFrame([(k, p, t) for k, (p, t) in enumerate(planted)], "page_id int, html string, want string")
    weights = page_text.learn_weights(table)
    assert weights["word|inside|True|False|block"] > 1 > 0 > weights["tag|unknown|False|nav"]
    assert [r for r in page_text.extract_pages(table).collect() if r.text != r.want] == []


def test_scan_equals_all_spans():
    rng = random.Random(2)
    for _ in range(500):
        scores = [(-rng.randint(0, 4) - 0.01, rng.randint(-4, 6)) for _ in range(rng.randint(0, 9))]
        total = lambda i, j: sum(t for t, _ in scores[i + 1 : j]) + sum(w for _, w in scores[i:j])
        most = max([total(i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)], default=0)
        low, high = page_text.best_region(scores)
        assert total(low, high) == pytest.approx(max(most, 0)) if high else most <= 0


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""),
        ("", ""),
        ("just words", "just words"),
        ("<p>a &lt; b &amp;amp; c&nbsp;d &copy e</p>", "a < b &amp; c d © e"),
        ("<p>one<p>two<br>three<div>four</div>", "one\ntwo three\nfour"),
        ("<article><p>kept</p><nav>gone<article><p>also kept</p></article>", "kept\nalso kept"),
        ("<p>before <", "before <"),
        ("<p>before</p><a href='never ends", "before"),
        ("<!-- never ends <p>x</p>", ""),
        ("<p>a</p><script>b", "a"),
        ('<p title="a > b">c</p></div></article>', "c"),
        ("<article><header><h1>Head</h1></header><p>Body.</p><footer>Tags</footer></article>", "Head\nBody."),
        ("<main><h1>Head</h1><article><p>Body.</p></article><div>More</div></main>", "Head\nBody."),
        ("<p>x <span class=ad>buy</span> y</p>", "x\ny"),
    ],
)
def test_odd_pages(page, text):
    assert page_text.main_text(page, {}) == text


def test_long_and_hostile_pages_end_soon():
    long = "<article>" + "<p>word</p>" * 50_000 + "</article>"
    assert page_text.main_text(long, {}).count("\n") == 49_999
    for part in ("<a ", "<a b=\"", "<a b='", "<b>", "</div>", "<div class=ad>", "&", "<!-- x", "<!", "<li>", "<p><b>"):
        began = time.time()
        page_text.main_text(part * 20_000, {})
        assert time.time() - began < 10, part


def test_tables_with_odd_rows_and_columns(spark):
    schema = "page_id int, text string, html string, n_chars string, page_body int, url string"
    rows = [(1, "t", "<p>x y</p>", "n", 5, None), (1, "t", "<p>x y</p>", "n", 5, None), (None, None, None, None, None, "u")]
    got = page_text.extract_pages(spark.createDataFrame(rows, schema))
    assert sorted(got.columns) == sorted(["page_id", "html", "page_body", "url", "text", "n_chars"])
    assert sorted((r.page_id or 0, r.text, r.n_chars, r.page_body) for r in got.collect()) == [(0, "", 0, None), (1, "x y", 3, 5), (1, "x y", 3, 5)]
    assert page_text.extract_pages(spark.createDataFrame([], schema)).collect() == []
