import html
import re

import pytest
from paperloom.llm import extraction
from paperloom.llm.dom import parse
from paperloom.llm.queries import QUERIES

PATH = "/root/testdata/sf0.01"


def article(page):
    inner = re.search("<article>(.*?)</article>", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
    return "\n".join(b for b in blocks if b)


@pytest.fixture(scope="module")
def model(spark):
    return extraction.trained(spark.read.parquet(f"{PATH}/pages.parquet"))


def test_query_gives_the_articles(spark):
    got = {r["page_id"]: r for r in QUERIES["op9_html_extraction"](spark, PATH).collect()}
    pages = spark.read.parquet(f"{PATH}/pages.parquet").collect()
    assert len(got) == len(pages)
    for r in pages:
        found = got[r["page_id"]]
        assert found["text"] == article(r["html"]) and found["n_chars"] == len(found["text"]) and found["url"] == r["url"]


BODY = "<h1>Head</h1><p>First para is long enough. It has two sentences.</p><ul><li>item one<li>item two</ul><p>Last &eacute;&nbsp;<a href=x>one</a>, here.</p>"
TEXT = "Head\nFirst para is long enough. It has two sentences.\nitem one\nitem two\nLast é one, here."


@pytest.mark.parametrize("opens,closes", [("<article>", "</article>"), ("<main>", "</main>"), ("<div class=story>", "</div>"), ("<div>", ""), ("", "")])
def test_side_parts_go_wherever_they_stand(model, opens, closes):
    page = (
        "<html><head><title>T</title><script>var x='<p>no</p>'</script></head><body>"
        "<header><h1>Site</h1></header><div id='cookie-notice'><p>We use cookies. Accept them all.</p></div>"
        f"{opens}<div class='ad'>Buy this now. Today.</div>{BODY}<form><p>Sign up here. Now.</p></form>"
        f"<section class='reader comments'><p>A reader says this. It is long.</p><p>And more of it here.</p></section>{closes}"
        "<aside><p>Read this too. It is good.</p></aside><nav><ul><li><a href=a>a</a></li></ul></nav><footer>end</footer></body></html>"
    )
    assert model.text(page) == TEXT


def test_broken_pages_are_read_to_their_end(model):
    for page in ("", "<", "<<<>>", "<p a='", "<script>", "<!-- ", "</p></div>", "<p>" * 3000, "<b><i>" * 2000 + "x", "& &#0; &amp", "<a\x00b>"):
        assert isinstance(model.text(page), str)
    unclosed = "<article><p><b>One.<br>Two.<p>Three <b>four</b> five."
    assert model.text(unclosed) == "One. Two.\nThree four five."
    assert model.text("<article><p>" + "word " * 200_000 + "</article>").count("word") == 200_000


def test_tree_has_parents_before_children():
    tree = parse("<div><p>a<p>b<table><tr><td>c<td>d</table></div>e")
    assert all(parent < node for node, parent in enumerate(tree.parent))
    assert [t for t in tree.text if t] == ["a", "b", "c", "d", "e"]


def test_marginals_equal_the_sum_over_all_states(model):
    """Brute force over every assignment of a small tree without observed parts."""
    import itertools

    tree = parse("<div><p>Some words. Here.</p><a href=x>link</a></div>")
    own = [model.own(tree, node) for node in range(len(tree.parent))]
    sums = [[0.0] * 3 for _ in own]
    for states in itertools.product(extraction.STATES, repeat=len(own)):
        weight = 1.0
        for node, state in enumerate(states):
            weight *= own[node][state]
            if node:
                weight *= model.edge[states[tree.parent[node]]][state]
        for node, state in enumerate(states):
            sums[node][state] += weight
    for got, raw in zip(model.marginals(tree), sums):
        assert got == pytest.approx([x / sum(raw) for x in raw], rel=1e-6)


def test_awkward_rows(spark):
    rows = [(1, None, None), (2, "u", ""), (None, "v", f"<article>{BODY}</article>"), (3, "w", "plain words"), (3, "w", "plain words")]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, text string, kind string")
    got = extraction.extracted(frame, extraction.trained(frame))
    assert got.columns == ["page_id", "url", "text"]
    texts = [(r["page_id"], r["text"]) for r in got.collect()]
    assert len(texts) == 5 and (1, "") in texts and (2, "") in texts and (None, TEXT) in texts
    empty = frame.where("false")
    assert extraction.extracted(empty, extraction.trained(empty)).count() == 0


WRAPPERS = [
    ("<div class='content has-sidebar'>", "</div>"),
    ("<div class='overflow-hidden'>", "</div>"),
    ("<section aria-label='Related work'>", "</section>"),
    ("<form id=aspnetForm action=x>", "</form>"),
    ("<form><div class='page sidebar'>", "</div></form>"),
    ("<div class='sidebar'><article>", "</article></div>"),
    ("<form><main>", "</main></form>"),
]


@pytest.mark.parametrize("opens,closes", WRAPPERS)
def test_marked_wrappers_keep_the_text_of_the_page(model, opens, closes):
    side = "<section class='comments'><p>A reader says this. It is long.</p></section>"
    page = f"<html><body><nav><ul><li><a href=a>a</a></ul></nav>{opens}{BODY}{side}{closes}<footer>end</footer></body></html>"
    assert model.text(page) == TEXT


PARTED = "<p>A second part is as long as the first one here. It has two sentences too.</p>"
_PARTS = [BODY[: BODY.index("<p>")], BODY[BODY.index("<p>") : BODY.index("<ul>")], BODY[BODY.index("<ul>") :]]
INNER = [
    f"<main><div class='elementor-widget elementor-widget-text'>{BODY}</div></main>",
    "<main>" + "".join(f"<div class='wp-widget'>{part}</div>" for part in _PARTS) + "</main>",
    f"<article><div class='post search-result'>{BODY}</div></article>",
    f"<article><section id='notice-of-meeting'>{BODY}</section></article>",
    f"<article><div class='post-content hidden'>{BODY}</div></article>",
    "".join(f"<div class=widget>{part}</div>" for part in _PARTS),
]


@pytest.mark.parametrize("page", INNER)
def test_marked_elements_that_hold_the_article_keep_it(model, page):
    side = "<div class='cookie-banner'><p>We use cookies. Accept them.</p></div>"
    assert model.text(f"<html><body><nav><ul><li><a href=a>a</a></ul></nav>{page}{side}<footer>end</footer></body></html>") == TEXT


def test_a_marked_section_of_the_article_stays(model):
    page = f"<body><nav><a href=a>a</a></nav><article>{BODY}<section class='related-work'>{PARTED}</section></article></body>"
    assert model.text(page).endswith("It has two sentences too.") and model.text(page).startswith(TEXT)
    beside = f"<body><article>{BODY}{PARTED * 4}<div class='related-posts'><p>Read it. Now.</p></div></article></body>"
    assert "Read it" not in model.text(beside)


def test_the_table_follows_labelled_pages(spark):
    """A mark that only ever stands around articles loses its weight against the prior."""
    page = "<body><div class='comments'><article>" + BODY + "</article></div><div class='comments'><p>Short. One.</p></div></body>"
    frame = spark.createDataFrame([(k, page) for k in range(50)], "page_id long, html string")
    side = extraction.trained(frame).side
    assert side["whole", 0, 3] < 0.05 < 0.97 < side["whole", 2, 0]


def test_labels_of_an_article_below_a_marked_wrapper():
    tree = parse(f"<body><form><article>{BODY}<div class=ad>Buy this.</div></article></form><form>Search</form></body>")
    states = dict(zip(tree.text, extraction.labelled(tree)))
    assert states["Head"] == extraction.CONTENT
    assert states["Buy this."] == states["Search"] == extraction.EXCLUDED


def test_long_side_parts_stay_out(model):
    long = "".join(f"<p>Reader {k} says this about it. It is a long one.</p>" for k in range(9))
    comments = f"<section class=comments>{long}</section>"
    assert model.text(f"<body><article>{BODY}{comments}</article></body>") == TEXT
    assert model.text(f"<body><article>{BODY}</article>{comments}</body>") == TEXT
    assert model.text(f"<body><form><article>{BODY}{comments}</article></form></body>") == TEXT


def test_raw_elements_end_in_any_case_beside_letters_that_grow_when_lowered():
    tree = parse("<SCRIPT>var a = 1</SCRIPT><p>İstanbul.<style>p{}</Style><p>After.")
    assert [t for t in tree.text if t] == ["İstanbul.", "After."]


def test_sample_is_drawn_from_pages_that_name_their_article(spark):
    rows = [(k, "<body><div><p>No name here.</p></div></body>") for k in range(200)]
    rows += [(1000 + k, f"<body><nav>n</nav><ARTICLE>{BODY}</ARTICLE></body>") for k in range(3)]
    trained = extraction.trained(spark.createDataFrame(rows, "page_id long, html string"), sample=3)
    assert "name p" in trained.feature
