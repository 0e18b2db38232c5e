import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from compare import connect, differences
from stratiform.llm import queries
from stratiform.llm.pages import _Run, common_lines, extract_main_text, page_lines
from stratiform.llm.preferences import format_preferences, render_turns, shared_turns

ARTICLE = (
    "<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a='</p>';</script></head><body><header>Top</header>"
    "<nav><ul><li><a href='/a'>Menu</a></li></ul></nav><!-- ad --><div class=\"ad\">Buy</div><article><h1>Head &amp; line</h1><p>One\n two&nbsp;three"
    "<p><b>Open <i>bold<br><p>Last &lt;b&gt;</p><div class='comments'><p>First!</p></div><form><input>Send</form></article>"
    "<aside>Side</aside><div id=cookie-notice>Cookies</div><footer>&copy; host</footer></body></html>"
)


def test_lines_of_an_article():
    lines, kinds = page_lines(ARTICLE)
    assert lines == ["Head & line", "One two three", "Open bold", "Last <b>"] and set(kinds) == {1}


@pytest.mark.parametrize(
    "page,lines",
    [("", []), ("plain text", ["plain text"]), ("a < b and c > d", ["a < b and c > d"]), ("<p>a<!-- never ends", ["a"]), ("<script>x", []), ("<p>x<", ["x<"]),
     ("<div class=sidebar>no<div>no</div></div>yes", ["yes"]), ("<p>one <span class=ad>no</span>two", ["one two"]), ("<ul><li class=menu>no<li>yes</ul>", ["yes"]),
     ("<p title='a>b'>x</p>", ["x"]), ('<p title="unclosed>x</p>', ["x"]), ("<div hidden>no</div><p>&#233;&eacute;&bogus;</p>", ["éé&bogus;"]),
     ("<div class='add header-image'>in</div>", []), ("<article><header><h1>kept</h1></header>x</article>", ["kept", "x"]), ("</p></div>x</article>", ["x"]),
     ("<td>a</td><td>b</td>", ["a", "b"]), ("x" * 200_000, ["x" * 200_000])],
)
def test_lines_of_odd_pages(page, lines):
    assert page_lines(page)[0] == lines


@pytest.mark.parametrize(
    "page,lines",
    [("<body class='single has-sidebar'>x</body>", ["x"]), ("<article class='post comments-open'>x</article>", ["x"]), ("<main class='with-sidebar'>x</main>", ["x"]),
     ("<article><p class='share-price'>x<div class='related-work'>y</div></article>", ["x", "y"]), ("<article id=banner><div class=notice>x</div></article>", ["x"]),
     ("<div class='share-price'>x</div>", ["x"]), ("<div class='site-nav'>no</div><div class='sidebar-left'>no</div><div id=related-posts>no</div>x", ["x"]),
     ("<article class='comment'>no</article><article>x<article class='comment reply'>no</article></article>", ["x"]),
     ("<main>x<div class=sidebar>no</div><div class=cookie-notice>no</div><div class=related>no</div><div class='promo box'>no</div></main>", ["x"]),
     ("<div class='article-tools'>a</div><p>x</p>", ["a", "x"]), ("<div id='story-list'>a</div><article>x</article>", ["a", "x"]),
     ("<p>x</p><article class='teaser'>y</article>", ["x", "y"]), ("<article class='card'>y</article><div class='article-body'>x</div>", ["y", "x"]),
     ("<article><div class='comment-list'>no</div><div class='ad-slot-2'>no</div><div class=share>x</div></article>", ["x"])],
)
def test_classes_that_only_hold_a_word_drop_nothing(page, lines):
    assert page_lines(page)[0] == lines


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=14), st.lists(st.integers(0, 6), max_size=14))
def test_common_lines_are_a_longest_common_subsequence(a, b):
    got = common_lines(a, b)
    best = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1, j + 1] = best[i, j] + 1 if x == y else max(best[i, j + 1], best[i + 1, j])
    assert len(got) == best[-1, -1] and got == sorted(set(got))
    rest = iter(b)
    assert all(any(a[i] == y for y in rest) for i in got)


@pytest.mark.parametrize("bits", [1, 500, 1 << 26])
def test_common_lines_of_many_repeats(bits):
    draw = np.random.default_rng(3)
    for _ in range(40):
        a, b = (draw.integers(0, 3, draw.integers(40, 90)).tolist() for _ in "ab")
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1, j + 1] = best[i, j] + 1 if x == y else max(best[i, j + 1], best[i + 1, j])
        got = common_lines(a, b, bits)
        rest = iter(b)
        assert len(got) == best[-1, -1] and got == sorted(set(got)) and all(any(a[i] == y for y in rest) for i in got)
    # One more occurrence in front shifts none of the others.
    a, b = [v for k in range(30) for v in (7, 100 + k)], [v for k in range(30) for v in (7, 200 + k)]
    assert common_lines(a, [7, 300, *b], bits) == list(range(0, 60, 2))


def test_lines_shared_with_the_nearest_page_go(frame):
    page = lambda *lines: "<body>" + "".join(f"<div>{x}</div>" for x in lines) + "</body>"
    rows = [
        (1, "http://h.com/news/1", page("Site name", "First story", "All rights")), (2, "https://h.com/news/2?x=1", page("Site name", "Second story", "All rights")),
        (3, "http://h.com/shop/9", page("Site name", "Wares", "Contact")), (4, "http://other.com/1", page("Site name", "Alone")), (5, None, None),
        (6, "http://h.com/news/3", "<main><p>Site name</p><p>Third</p></main><div>x</div>"), (7, "http://copy.com/a", page("Same", "copy")), (8, "http://copy.com/a", page("Same", "copy")),
    ]
    df = frame([(*r, "z") for r in rows], "page_id long, url string, html string, text string").coalesce(1)
    out = {r.page_id: (r.text, r.n_chars) for r in extract_main_text(df).collect()}
    assert out[1][0] == "First story" and out[2][0] == "Second story" and out[4][0] == "Site name\nAlone"
    assert out[5] == ("", 0) and out[6] == ("Site name\nThird", 15) and out[7] == out[8] == ("Same\ncopy", 9)
    assert extract_main_text(frame([], "page_id long, url string, html string")).count() == 0


def test_marked_pages_are_aligned_and_checked_by_their_mark(frame):
    story = lambda k: f"Story {k} of words told at length, and of that page alone"
    page = lambda k: f"<div>Site name</div><article><p>Both say so<p>{story(k)}</article><div>All rights</div>"
    rows = [(k, f"http://h.com/news/{k}", page(k)) for k in range(3)] + [(9, "http://alone.com/1", page(9))]
    out = {r.page_id: (r.text, r.n_shared) for r in extract_main_text(frame(rows, "page_id long, url string, html string")).collect()}
    assert out == {k: (f"Both say so\n{story(k)}", 0 if k == 9 else 3) for k in (0, 1, 2, 9)}


def test_long_runs_lie_in_a_file():
    run = _Run(held=2)
    for _ in range(2):
        pages = [("h", str(k), k, [k], [1]) for k in range(5)]
        for page in pages:
            run.append(page)
        assert len(run.pages) == 2 and list(run.taken()) == pages and list(run.taken()) == []


def _pages(frame, parts=1):
    page = lambda *lines: "<body>" + "".join(f"<div>{x}</div>" for x in lines) + "</body>"
    story = lambda k: [f"Story {k} line {n} of words told at length" for n in range(6)]
    rows = [(k, f"http://h.com/news/{k:02}", page("Site name", *story(k), "All rights")) for k in range(12)]
    rows += [(100 + n, f"http://h.com/news/05{end}", page("Site name", *story(5), "All rights")) for n, end in enumerate(("?page=2", "?utm_source=feed", "#top", "/"))]
    rows += [(200, "http://h.com/news/07b", page("Site name", *story(7)[:-1], "Changed", "All rights"))]
    rows += [(300 + n, f"http://alone.com/a{end}", page("Only", *story(5))) for n, end in enumerate(("", "?x=1", "?x=2"))]
    return frame(rows, "page_id long, url string, html string").repartition(parts)


def test_copies_under_other_urls_keep_their_article(frame):
    out = {r.page_id: r.text.split("\n") for r in extract_main_text(_pages(frame)).collect()}
    story = lambda k: [f"Story {k} line {n} of words told at length" for n in range(6)]
    assert all(out[k] == story(k) for k in range(12)) and all(out[100 + n] == story(5) for n in range(4))
    assert out[200] == [*story(7)[:-1], "Changed"] and all(out[300 + n] == ["Only", *story(5)] for n in range(3))


def test_results_do_not_depend_on_partitions(spark, frame):
    def texts():
        return sorted((r.page_id, r.text) for r in extract_main_text(_pages(frame, 3)).collect())

    coalesced = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = []
        for n in (1, 5, 17):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got.append(texts())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesced)
    assert got[0] == got[1] == got[2]


def test_given_pages_give_their_articles(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    out = {r.page_id: r.text for r in extract_main_text(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html or "", re.S)
        parts = re.split(r"</?(?:p|h1|br)>", inner[1]) if inner else []
        import html

        lines = [" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in parts]
        assert out[r.page_id] == "\n".join(x for x in lines if x)


def test_shared_turns_are_the_prompt():
    a, b = [("user", "q"), ("assistant", "x"), ("user", "r")], [("user", "q"), ("assistant", "y")]
    assert shared_turns(a, b) == 1 and shared_turns(a, a) == 3 and shared_turns([], b) == 0 and shared_turns(a[:1], [("system", "q")]) == 0
    text, spans = render_turns(a, queries.preferences.ChatTemplate())
    assert text == "<|user|>\nq\n<|assistant|>\nx\n<|user|>\nr\n" and [text[s:e] for s, e in spans] == ["x\n"]


def test_preference_rows(frame):
    rows = [
        (1, "chosen", 0, "user", "hé"), (1, "chosen", 1, "assistant", "yes"), (1, "rejected", 1, "assistant", "no"), (1, "rejected", 0, "user", "hé"),
        (2, "chosen", 0, "user", "only one side"), (3, "chosen", None, None, None), (3, "rejected", 0, "user", None), (None, "chosen", 0, "user", "x"),
        (4, "chosen", 0, "user", "same"), (4, "rejected", 0, "user", "same"), (5, "other", 0, "user", "x"), (5, "chosen", 0, "user", "x"),
    ]
    df = frame([(*r, "p") for r in rows], "pair_id long, side string, turn long, role string, text string, prompt string")
    out = {r.pair_id: r for r in format_preferences(df).collect()}
    assert set(out) == {1, 3, 4}
    r = out[1]
    assert (r.n_shared, r.prompt, r.chosen, r.rejected) == (1, "<|user|>\nhé\n", "<|assistant|>\nyes\n", "<|assistant|>\nno\n")
    assert [r.chosen[m.start : m.end] for m in r.chosen_mask] == ["yes\n"] and [r.rejected[m.start : m.end] for m in r.rejected_mask] == ["no\n"]
    assert (out[4].prompt, out[4].chosen, out[4].rejected, out[4].chosen_mask) == ("<|user|>\nsame\n", "", "", [])
    assert (out[3].n_shared, out[3].chosen, out[3].rejected) == (0, "<||>\n\n", "<|user|>\n\n")
    assert format_preferences(df.limit(0)).count() == 0


def test_preferences_agree_with_sql(spark, sf):
    assert differences(queries.QUERIES["op4_preference_formatting"](spark, sf), connect(sf), queries.ORACLES["op4_preference_formatting"]) == []


def test_preferences_agree_with_sql_where_turns_are_shared(spark, sf, tmp_path):
    """Conversation 2k + 1 made a copy of 2k up to its third turn."""
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    copied = turns.where("conv_id % 2 = 0").select((F.col("conv_id") + 1).alias("conv_id"), "turn", "role", F.when(F.col("turn") >= F.col("conv_id") % 5, F.lit("other")).otherwise(F.col("text")).alias("text"))
    turns.where("conv_id % 2 = 0").unionByName(copied).coalesce(1).write.parquet(str(tmp_path / "c"))
    next((tmp_path / "c").glob("part-*.parquet")).rename(tmp_path / "conversations.parquet")
    con = connect(str(tmp_path))
    made = queries.QUERIES["op4_preference_formatting"](spark, str(tmp_path))
    assert differences(made, con, queries.ORACLES["op4_preference_formatting"]) == [] and made.where("n_shared > 1").count() > 3


@pytest.mark.parametrize(
    "page,main",
    [("<div id='story-list'>a</div><article>x</article>", ["x"]), ("<div class='article-tools'>a</div><article>x</article>", ["x"]), ("<p>x</p><article class='teaser'>y</article>", []),
     ("<article class='card'>y</article><div class='article-body'>x</div>", ["x"]), ("<main class='site-main'>x</main>", ["x"]), ("<article class='comment'>x</article>", [])],
)
def test_what_is_main_text(page, main):
    assert [line for line, kind in zip(*page_lines(page), strict=True) if kind] == main
