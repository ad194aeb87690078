"""Chat formatting round trips and templates that rewrite history; main text of pages."""

import hashlib
import html
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopmetrics.llm import chat, htmltext
from shopmetrics.llm.store import on_workers, table

SF = "/root/testdata/sf0.01"
TALK = "conv_id long, turn long, role string, text string"
HARD = st.lists(st.sampled_from(["<", "|", "\\", ">", "<|im_end|>", "<|im_start|>", "assistant", "\n", "a", "<\\|", chat.PROBE % 0, chat.PROBE % 1, "\u2063", "é", " "]), max_size=12).map("".join)


@pytest.fixture(autouse=True)
def _workers(spark):
    on_workers(spark)


@settings(max_examples=200, deadline=None)
@given(HARD)
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(HARD, HARD), max_size=5))
def test_turns_are_read_back_from_the_output(turns):
    out, where = chat.spans(turns)
    assert out == chat.chat_template(turns) and where is not None
    back = [(chat.read_role(out[a + len(chat.START) : b - 1]), chat.unescape(out[b:c])) for a, b, c, _ in where]
    assert back == turns
    assert [a for a, *_ in where] + [len(out)] == [0, *(d for *_, d in where)]


def test_a_template_that_rewrites_history_is_detected(spark):
    def counts_turns(turns):
        return f"[{len(turns)}]" + "".join(t for _, t in turns)

    def drops_old(turns):
        return "".join(f"{r}:{t};" for r, t in turns[-1:])

    def trims(turns):
        return "".join(f"{r}:{t.strip()};" for r, t in turns)

    turns = [("user", "a"), ("assistant", "bb")]
    assert chat.spans(turns, counts_turns)[1] is None and chat.spans(turns, drops_old)[1] is None
    assert chat.spans(turns, trims) == ("user:a;assistant:bb;", [(0, 5, 6, 7), (7, 17, 19, 20)])
    talk = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], TALK)
    row = chat.format_chats(talk, drops_old).first()
    assert row["rewrites"] and row["spans"] is None and chat.digest(chat.format_chats(talk, drops_old)).collect() == []


def test_formatted_conversations(spark):
    rows = [(1, 1, "assistant", "x <|im_end|>"), (1, 0, "user", None), (2, 0, None, "hi"), (2, 0, None, "hi"), (2, None, "system", "s"), (None, 3, "assistant", "q" * 200_000),
            (3, 5, "as\nsistant", ""), (4, 0, "assistant", "é"), (4, 1, "assistant", "z")]
    talk = spark.createDataFrame(rows, TALK).withColumn("spans", F.lit(1)).withColumn("formatted", F.lit("f"))
    got = {r["conv_id"]: r for r in chat.digest(chat.format_chats(talk)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got[1]["turns_sha256"] == sha("user\n\nassistant\nx <|im_end|>\n") and got[1]["loss_chars"] == 12
    assert got[2]["turns_sha256"] == sha("system\ns\n\nhi\n\nhi\n") and got[2]["n_turns"] == 3 and got[2]["loss_sha256"] == sha("")
    assert got[3]["turns_sha256"] == sha("as\nsistant\n\n") and got[4]["loss_sha256"] == sha("éz") and got[4]["loss_chars"] == 2
    assert got[None]["loss_chars"] == 200_000 and got[4]["formatted_chars"] == len(chat.chat_template([("assistant", "é"), ("assistant", "z")]))
    assert chat.digest(chat.format_chats(talk.limit(0))).collect() == []


def own_text(page):
    """The article of the generated pages, by their known shape: blocks start at h1, p and br."""
    article = page[page.index("<article>") + 9 : page.index("</article>")]
    blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"<(?:/?h1|/?p|br)>", article)]
    return "\n".join(b for b in blocks if b)


def test_text_of_the_given_pages(spark):
    pages = table(spark, SF, "pages")
    want = {r.page_id: own_text(r.html) for r in pages.collect()}
    got = {r["page_id"]: r for r in htmltext.extract(pages).collect()}
    assert {p: r["text"] for p, r in got.items()} == want and all(r["n_chars"] == len(r["text"]) for r in got.values())


BODY = "<p>The first paragraph is long enough, it has commas, stops and several clauses; so it counts.</p><p>A second one, as long as the first, with more of the same, and an end.</p>"
TEXT = "The first paragraph is long enough, it has commas, stops and several clauses; so it counts.\nA second one, as long as the first, with more of the same, and an end."
AROUND = ("<header><a href=/>Site</a> Our motto</header><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>", "<footer>&copy; all rights</footer>")


@pytest.mark.parametrize("page", [
    f"<html><body>{AROUND[0]}<article>{BODY}</article>{AROUND[1]}</body></html>",
    f"<body>{AROUND[0]}<main>{BODY}<div class='comments'><p>First! A reader, who says things, at length, of the article.</p></div></main>{AROUND[1]}",
    f"<body>{AROUND[0]}<div id=content>{BODY}</div><div class=\"sidebar\"><p>Related items, and more of them, and others.</p></div>{AROUND[1]}",
    f"<body><div class='cookie-notice'>We use cookies, as all do, to follow you about. <button>OK</button></div><div>{BODY}</div><div class=ad>Buy now, it is cheap, and good, and new!</div>",
    f"<body>{AROUND[0]}<div><a href=1>More</a> <a href=2>Less</a></div><div class=story>{BODY}</div><form>Name, address, and more, please.<input></form>{AROUND[1]}",
    f"<body><article>{BODY}<aside>An aside, which is no part, of the text.</aside><section id='comments'><p>Reader: nice, very nice, thanks.</p></section></article>",
])
def test_main_text_of_other_pages(page):
    assert htmltext.main_text(page) == TEXT


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("   ", ""), ("<html></html>", ""),
    ("<article>a &amp; b&nbsp;c &#233; &lt;p&gt;</article>", "a & b c é <p>"),
    ("<article><p>one<p>two <b>bo</b>ld\n\n x<script>var p='</p>';</script></article>", "one\ntwo bold x"),
    ("<article><h1>T</h1><p>a<br>b</p><!-- no --><style>p{}</style>c</article>", "T\na\nb\nc"),
    ("<article><p>never closed, a < b and <i", "never closed, a < b and <i"),
    ("<article><ul><li>x<li>y</ul><table><tr><td>1<td>2</table></article>", "x\ny\n1\n2"),
    ("<article><p class=lead title='a > b'>q</p></article>", "q"),
])
def test_main_text_of_odd_pages(page, text):
    assert htmltext.main_text(page) == text


def test_very_long_and_deep_pages_are_whole():
    long = "word, " * 200_000
    assert htmltext.main_text(f"<article><p>{long}</p></article>") == long.strip()
    deep = "<div>" * 3000 + "<article><p>x, y.</p></article>" + "</div>" * 3000
    assert htmltext.main_text(deep) == "x, y."
    assert htmltext.main_text("<article>" + "<a \"" * 3000) is not None


def test_the_ratio_decides_between_marked_regions():
    prose = "".join(f"<p>Words of the {n}th paragraph, which go on, and on. They end here.</p>" for n in range(12))
    page = f"<body><div><article class=teaser><a href=x>more</a></article></div><article class=story><h1>Head</h1>{prose}<p>end</p></article></body>"
    got = htmltext.main_text(page)
    assert got.startswith("Head\nWords of the 0th") and got.endswith("\nend") and "more" not in got


def test_given_pages_read_the_same_without_the_article_mark():
    import duckdb
    pages = [r[0] or "" for r in duckdb.sql("SELECT html FROM '/root/testdata/sf0.01/pages.parquet'").fetchall()]
    bare = [p.replace("<article", "<div").replace("</article", "</div") for p in pages]
    assert bare != pages
    assert [htmltext.main_text(p) for p in bare] == [htmltext.main_text(p) for p in pages]


def test_extract_edges(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, "<article>a</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("old")).withColumn("row", F.lit(1))
    got = htmltext.extract(df).collect()
    assert sorted(((r["page_id"], r["text"], r["n_chars"], r["row"]) for r in got), key=str) == sorted([(1, "", 0, 1), (1, "", 0, 1), (None, "a", 1, 1)], key=str)
    assert htmltext.extract(df.limit(0)).collect() == []


@pytest.mark.parametrize("part", [
    *(f"<section id='{i}'><h2>A heading</h2><p>Short text, of it.</p></section>" for i in ("side-effects", "related-work", "search-algorithms", "notice-period", "data-sharing")),
    "<section aria-label='Share of the market'><h2>A heading</h2><p>Short text, of it.</p></section>",
    "<section itemprop='comment'><h2>A heading</h2><p>Short text, of it.</p></section>",
    "<section aria-label='The hidden cost' aria-hidden=false data-class=ad><h2>A heading</h2><p>Short text, of it.</p></section>",
    "<figure><img src=x><figcaption>A heading</figcaption></figure><p>Short text, of it.</p>",
    "<h2>A heading</h2><svg viewBox='0 0 1 1'/><math/><p>Short text, of it.</p>",
    "<h2><svg-icon name=x></svg-icon>A heading</h2><p><math-renderer>Short text, of it.</math-renderer></p>",
])
def test_names_of_the_articles_own_parts_are_no_marks(part):
    want = [*TEXT.split("\n"), "A heading", "Short text, of it."]
    assert htmltext.main_text(f"<body>{AROUND[0]}<article>{BODY}{part}{BODY}</article>{AROUND[1]}").split("\n") == [*want, *want[:2]]


@pytest.mark.parametrize("name", ["class='cookie-notice'", "class='box sidebar'", "role=search", "id=comments", "id='sidebar2'", "hidden", "style='display: none'", "aria-hidden=true"])
def test_marks_still_leave_out(name):
    assert htmltext.main_text(f"<body><article>{BODY}<div {name}><p>{TEXT}</p></div></article>") == TEXT


LINE = TEXT.replace("\n", " ")


@pytest.mark.parametrize("wrapper", ["content no-sidebar", "layout-sidebar-left", "has-related", "sidebar", "page with-header-search"])
def test_a_wrapper_of_the_article_is_never_marked_away(wrapper):
    side = f'<div class="related"><article><p>{LINE[:30]}</p></article></div>'
    page = f'<body><div class="{wrapper}"><article><h1>T</h1><p>{LINE}</p><p>Sh.</p></article></div>{side}</body>'
    assert htmltext.main_text(page) == f"T\n{LINE}\nSh."


@pytest.mark.parametrize("name", ["side-effects", "related-work", "alert-levels", "search-algorithms", "footer-notes-explained"])
def test_sections_of_the_article_stay_by_their_ratio(name):
    page = f'<body><nav><a>x</a></nav><article><h1>T</h1><section class="{name}"><h2>S</h2><p>{LINE}</p><ul><li>a</li></ul></section></article></body>'
    assert htmltext.main_text(page) == f"T\nS\n{LINE}\na"


@pytest.mark.parametrize("box", ['<div class="author-box"><p>Jane Doe</p></div>', '<ul class="tags"><li>foxes</li></ul>', '<div class="pager"><a>Next page</a></div>'])
def test_boxes_of_low_ratio_inside_the_article_go(box):
    page = f"<body><nav><a>x</a></nav><main><h1>T</h1><p>{LINE}</p>{box}<ul><li>one</li></ul><p>{LINE}</p></main></body>"
    assert htmltext.main_text(page) == f"T\n{LINE}\none\n{LINE}"
