from __future__ import annotations

import numpy as np
import pytest
from .conftest import rows

from ledgerline.llm import html_blocks
from ledgerline.llm.html_training import PAGES

PARAGRAPH = "Every morning the ferryman counted the ropes twice, since nobody had ever paid him for the third."
SECOND = "On Sundays he did not count them at all, and the ropes were none the worse for it."


def text(page: str) -> str:
    return html_blocks.main_texts([page], html_blocks.trained_tree())[0]


def test_blocks_and_features():
    page = "<p>one <b>two</b> <a href=x>three four</a></p><div>five<br>six &amp; seven</div>tail"
    found = html_blocks.blocks(page)
    assert [(b.text, b.words, b.linked) for b in found] == [("one two three four", 4, 2), ("five six & seven", 4, 0), ("tail", 1, 0)]
    table = html_blocks.features(found)
    assert table[1, :6].tolist() == [4, 0, 4, 0.5, 1, 0]


def test_training_pages_are_learned():
    tree = html_blocks.trained_tree()
    for page in PAGES:
        found = html_blocks.blocks(page)
        kept = tree.predict(html_blocks.features(found)) > 0.5
        assert kept.tolist() == [b.label == 1 for b in found]


def test_tree_splits_by_impurity():
    table = np.array([[0.0, 5], [1, 5], [2, 5], [3, 5]])
    tree = html_blocks.train(table, np.array([0, 0, 1, 1]))
    assert tree.column == [0, -1, -1] and tree.limit[0] == 1.5
    assert tree.predict(np.array([[1.4, 0], [1.6, 0]])).tolist() == [0, 1]


FRAMES = [
    '<nav><ul><li><a href="/">Home</a></li><li>About us and our long history on the river.</li></ul></nav>',
    f"<header><p>{SECOND}</p></header>",
    f"<footer><p>{SECOND}</p></footer>",
    f'<aside><h3>More</h3><p>{SECOND}</p></aside>',
    f'<div class="sidebar-left"><p>{SECOND}</p></div>',
    f'<div id="cookieNotice"><p>{SECOND}</p><button>Accept</button></div>',
    f'<div class="advert"><p>{SECOND}</p></div>',
    f'<div class="ad">{SECOND}</div>',
    f"<form><label>Name</label><p>{SECOND}</p><select><option>One</select></form>",
    f'<section id="comments"><div class="comment"><p>{SECOND}</p></div></section>',
    f'<article class="comment"><p>{SECOND}</p></article>',
    f'<ol class="commentlist"><li><p>{SECOND}</p></li></ol>',
    f'<div class="main-header"><p>{SECOND}</p></div>',
    f'<div class="AdSlot1">{SECOND}</div>',
    f'<div aria-label="Comments"><p>{SECOND}</p></div>',
    f'<div class="post-meta"><p>{SECOND}</p></div>',
    f'<div role="alert"><p>{SECOND}</p></div>',
    f'<div hidden><p>{SECOND}</p></div><p style="display: none">{SECOND}</p>',
    "<script>if (a<b) document.write('<p>no text</p>')</script><style>p{margin:0}</style><!-- <p>not here</p> -->",
]


@pytest.mark.parametrize("frame", FRAMES)
def test_frames_are_left_out(frame):
    article = f"<h1>Ropes</h1><p>{PARAGRAPH}</p><p>Short one.</p>"
    want = f"Ropes\n{PARAGRAPH}\nShort one."
    assert text(f"<body>{frame}<article>{article}</article></body>") == want
    assert text(f"<body><main>{article}</main>{frame}</body>") == want
    if not frame.startswith("<header>"):  # in an article it is the article's head
        assert text(f"<body><article>{article}{frame}</article></body>") == want
    assert text(f'<body>{frame}<div class="post-content">{article}</div>{frame}</body>') == want


def test_head_of_the_article_and_layout_names():
    page = f'<div class="wrapper has-sidebar"><article class="post"><header><h1>Ropes</h1></header><p>{PARAGRAPH}</p></article></div>'
    assert text(page) == f"Ropes\n{PARAGRAPH}"
    page = f'<div class="page no-sidebar"><div class="entry-header"><h1>Ropes</h1></div><div class="entry-content"><p>{PARAGRAPH}</p></div></div>'
    assert text(page).endswith(PARAGRAPH)


def test_page_without_marks():
    menu = "".join(f'<div><a href="/{x}">{x} and more</a></div>' for x in "abcdef")
    assert text(f"<body>{menu}<div><p>{PARAGRAPH}</p><p>{SECOND}</p></div>{menu}</body>") == f"{PARAGRAPH}\n{SECOND}"


def test_white_space_and_references():
    page = "<article><p>a&nbsp;b \n\t c&#8217;s &lt;tag&gt; &copy; &unknown; x < y</p><p> \n </p><p>d<b>e</b>f g</p></article>"
    assert text(page) == "a b c’s <tag> © &unknown; x < y\ndef g"


@pytest.mark.parametrize(
    "page",
    ["", " ", "<", "<p", "<!-- open", "<script>open", "</p></div>", "<p><p><p", "<a href='x>" + "<b>" * 50, "&#xfffffff;", "\x00"],
)
def test_broken_pages_are_read_as_far_as_they_go(page):
    assert isinstance(text(page), str)
    assert text(f"<article><p>{PARAGRAPH}</p></article>{page}").startswith(PARAGRAPH)


@pytest.mark.parametrize("tag", "svg math canvas object noscript template iframe audio video select".split())
def test_open_silent_tags_end_with_their_parent(tag):
    for parent in ("<div>{}</div>", "<p><b>{}</b></p>", "<p>{}</p>"):
        page = f"<article><h1>Ropes</h1>{parent.format(f'<{tag} id=x>')}<p>{PARAGRAPH}</p><p>{SECOND}</p></article>"
        assert text(page) == f"Ropes\n{PARAGRAPH}\n{SECOND}"
    page = f"<article><p>{PARAGRAPH}<{tag}><b>silent</b> words</{tag}></p><p>{SECOND}</p></article>"
    assert text(page) == f"{PARAGRAPH}\n{SECOND}"
    inline = f"<article><p>Every morning <b><{tag}>silent</b>{PARAGRAPH}</p></article>"
    assert text(inline) == f"Every morning {PARAGRAPH}"


def test_head_without_end_tag_and_empty_drawings():
    article = f"<article><h1>Ropes</h1><p>{PARAGRAPH}</p>{{}}<p>{SECOND}</p></article>"
    want = f"Ropes\n{PARAGRAPH}\n{SECOND}"
    for head in ("<head>", '<head class="head">'):
        assert text(f"<html>{head}<title>x</title><style>p{{}}</style><body>{article.format('')}") == want
    for drawing in ("<svg/>", '<svg viewBox="0 0 1 1" />', "<math/>", "<svg><path d=x>"):
        assert text(article.format(drawing)) == want
        assert text(article.format(drawing) + "<footer><svg></svg></footer>") == want


def test_special_cases(spark):
    page = f"<article><p>{PARAGRAPH}</p></article>"
    long = "<article>" + f"<p>{PARAGRAPH}</p>" * 20_000 + "</article>"
    data = [(1, "u", page, "x"), (1, "u", page, "x"), (2, None, None, "x"), (None, "v", "", "x"), (3, "w", long, None)]
    names = "page_id bigint, url string, html string, text string"
    found = rows(html_blocks.extract(spark.createDataFrame(data, names)), "page_id", "url", "text", "n_chars")
    whole = "\n".join([PARAGRAPH] * 20_000)
    n = len(PARAGRAPH)
    want = [(1, "u", PARAGRAPH, n), (1, "u", PARAGRAPH, n), (2, None, "", 0), (None, "v", "", 0), (3, "w", whole, len(whole))]
    assert found == sorted(want, key=repr)
    assert rows(html_blocks.extract(spark.createDataFrame([], names))) == []


LONG_HEADINGS = [
    "<aside><h3>More stories from around the whole region</h3></aside>",
    "<footer><h4>Ways to get in touch with our newsroom</h4></footer>",
    '<div class="newsletter"><h3>Sign up for the best stories of the week</h3></div>',
    '<section id="comments"><h2>What our readers had to say about this story</h2></section>',
    '<div class="cookie-banner"><h2>We value your privacy and so do our partners</h2></div>',
    "<form><h3>Tell us what you think of our new pages</h3></form>",
    "<nav><h2>All the sections of the paper in one list</h2></nav>",
    "<aside><article><h3>Another story that many people have read today</h3></article></aside>",
]


@pytest.mark.parametrize("frame", LONG_HEADINGS)
def test_headings_of_frames_are_left_out(frame):
    article = f"<h1>The ferry that never came back to town</h1><p>{PARAGRAPH}</p><p>{SECOND}</p>"
    want = f"The ferry that never came back to town\n{PARAGRAPH}\n{SECOND}"
    assert text(f"<body><article>{article}</article>{frame}</body>") == want
    assert text(f"<body>{frame}<article>{article}{frame}</article></body>") == want


NAMES = [
    "post type-post category-social hentry", "post hentry tag-search", "post hentry category-legal", "post comments-open",
    "story thread", "post status-publish format-standard has-sidebar", "entry topic-newsletter", "article sidebar-off",
]


@pytest.mark.parametrize("tag", ["article", "div", "section"])
@pytest.mark.parametrize("names", NAMES)
def test_names_of_topics_and_states_make_no_frame(names, tag):
    page = f'<nav><a href="/">Home</a></nav><{tag} class="{names}"><h1>Word</h1><p>{PARAGRAPH}</p><p>{SECOND}</p></{tag}>'
    assert text(f"<body>{page}</body>") == f"Word\n{PARAGRAPH}\n{SECOND}"


@pytest.mark.parametrize("mark", ['id="social-media-and-the-law"', 'id="comments-nobody-wrote"', 'aria-label="Response of the council to its critics"'])
def test_titles_in_ids_and_labels_make_no_frame(mark):
    assert text(f"<article {mark}><p>{PARAGRAPH}</p></article>") == PARAGRAPH


@pytest.mark.parametrize("name", ["legal", "thread", "social", "survey", "discussion"])
def test_ambiguous_names_are_weighed(name):
    alone = f'<div><a href="/">Home</a> <a href="/x">News</a></div><div class="{name}"><p>{PARAGRAPH}</p><p>{SECOND}</p><p>{PARAGRAPH}</p></div>'
    assert text(f"<body>{alone}</body>") == f"{PARAGRAPH}\n{SECOND}\n{PARAGRAPH}"
    beside = f'<article><p>{PARAGRAPH}</p></article><div class="{name}"><p>{SECOND}</p></div>'
    assert text(f"<body>{beside}</body>") == PARAGRAPH


def plain_article(page: str) -> str:
    """The article of a page that is marked by tags alone, by the standard library's parser."""
    from html.parser import HTMLParser

    blocks = "address article aside blockquote body dd div dl dt figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td tr ul".split()

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.out, self.now, self.path = [], [], []

        def cut(self):
            own = " ".join("".join(self.now).split())
            self.out += [own] * bool(own)
            self.now = []

        def handle_starttag(self, tag, attrs):
            if tag in blocks:
                self.cut()
            if tag == "br":
                self.now.append(" ")
            if tag not in ("br", "img", "hr", "meta", "link", "input"):
                self.path.append("ad" if dict(attrs).get("class") == "ad" else tag)

        def handle_endtag(self, tag):
            if tag in blocks:
                self.cut()
            for i in range(len(self.path) - 1, -1, -1):
                if self.path[i] == tag or (self.path[i] == "ad" and tag == "div"):
                    del self.path[i:]
                    break

        def handle_data(self, data):
            frames = {"nav", "aside", "footer", "form", "script", "style", "ad"}
            if "article" in self.path and not frames & set(self.path):
                self.now.append(data)

    reader = Reader()
    reader.feed(page)
    reader.cut()
    return "\n".join(reader.out)


def test_query_on_the_smallest_pages(spark, tables):
    from ledgerline.llm.queries import op1_html_extraction

    from .conftest import SF_DIR

    want = sorted(((r[0], r[1], t := plain_article(r[2] or ""), len(t)) for r in tables["pages"]), key=repr)
    assert rows(op1_html_extraction(spark, SF_DIR), "page_id", "url", "text", "n_chars") == want


def test_query_on_the_same_pages_without_marks(spark, tables):
    """Words and links alone: with every mark taken off, most of the articles' text is found, and little else."""
    import re

    pages, want = [], {}
    for page_id, url, page, *_ in tables["pages"]:
        want[page_id] = plain_article(page or "").split("\n")
        bare = re.sub(r"<(/?)(article|main|nav|header|footer|aside|section)\b[^>]*>", r"<\1div>", page or "")
        pages.append((page_id, url, re.sub(r' (class|id|role)="[^"]*"', "", bare)))
    found = html_blocks.extract(spark.createDataFrame(pages, "page_id bigint, url string, html string"))
    right = kept = whole = 0
    for r in found.collect():
        own, theirs = r.text.split("\n"), want[r.page_id]
        words = lambda lines: sum(len(x.split()) for x in lines)
        right += words([x for x in own if x in theirs])
        kept, whole = kept + words(own), whole + words(theirs)
    assert right / whole > 0.85 and right / kept > 0.8, (right / whole, right / kept)
