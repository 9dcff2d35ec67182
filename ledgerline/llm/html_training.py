"""Labelled pages from which the block classifier is trained.

``data-label`` tells whether the blocks inside belong to the article. The pages
show the usual parts of a site: with marked-up parts, with class names only, and
with no marks at all, where words and links must tell. They are ``len(PAGES)`` in
number, a fixed list.
"""

from __future__ import annotations

_LONG = (
    "The harbour was quiet when the first boats came back, and the men on the pier counted them one by one "
    "before anybody said a word about the weather that had kept them out for so long."
)
_LONG_LINKED = (
    'The committee published <a href="/r">its report</a> on Monday after months of delay, and most members agreed '
    "that the second chapter should have been written first, since it explains what the other chapters take for granted."
)
_MIDDLE = "Nobody had expected the old bridge to last another winter."
_SHORT = "It did."
_NAV = "".join(f'<li><a href="/{x}">{x}</a></li>' for x in ("home", "world", "local", "sports", "culture", "contact"))
_TEASERS = "".join(f'<div><a href="/{i}">{x}</a></div>' for i, x in enumerate((
    "How the town council voted on the new swimming pool, and why it took so long",
    "Five people were rescued from the roof of the mill on Sunday night after the storm.",
    "What the teachers want from the ministry before the schools open again in autumn",
)))
_LINKS = "".join(f'<div><a href="/{i}">{x}</a></div>' for i, x in enumerate((
    "Ten ways to keep bread fresh", "Why the river turned green", "A short history of the fork", "Letters",
)))

# Headings of many words, and every kind of frame that may hold them.
_HEADINGS = "".join(f"<h{2 + i % 3}>{x}</h{2 + i % 3}>" for i, x in enumerate((
    "More news", "Latest from the region", "More stories from around the whole county", "Ways to get in touch with our editors today",
    "Sign up for the best stories of the week and never miss what the others missed", "What our readers say about it",
    "Did you like this story? Tell us.",
)))
_FRAMES = (
    "<aside>{}</aside>", "<footer>{}</footer>", "<nav>{}</nav>", "<form>{}</form>", '<div class="newsletter">{}</div>',
    '<section id="comments">{}</section>', '<div class="cookie-banner">{}</div>', '<div role="complementary">{}</div>',
    '<div class="related-posts">{}</div>', "<header>{}</header>",
)


def _framed(frame: str, inside: bool) -> str:
    """A page with an article and a frame of headings and texts, in or beside it."""
    frame = f"<div data-label=0>{frame.format(f'{_HEADINGS}<p>{_LONG}</p><p>{_MIDDLE}</p><p>{_SHORT}</p><div>Word</div>{_TEASERS}')}</div>"
    own = (
        f"<h1>What the ferry brought to the island after the storm</h1><p>{_LONG}</p><h2>Nobody knew what would come of it all</h2>"
        f"<p>{_MIDDLE}</p><p>{_SHORT}</p><p>{_LONG_LINKED}</p>"
    )
    own = f"<article data-label=1>{own}{frame if inside else ''}</article>"
    return f"<body data-label=0>{'' if inside else frame}{own}{'' if inside else frame}</body>"


def _unmarked(own: str) -> str:
    """A page whose parts have no marks, or ambiguous ones."""
    return f"""<body data-label=0><div>{_NAV}</div><div><a href="/">Example</a></div>{own}<div>{_LINKS}</div>{_TEASERS}
    <div><a href="/t">{_sentence(21, True)}</a></div><div><a href="/u">{_sentence(28, False)}</a></div><p><a href="/v">{_sentence(18, True)}</a></p>
    <div><a href="/a">About</a> <a href="/b">Terms</a></div><div>Example Media 2020</div></body>"""


def _sentence(n: int, closed: bool) -> str:
    return " ".join((_LONG.rstrip(".").split() * 2)[:n]) + ("." if closed else "")


_OWN = (
    f"<p>{_LONG}</p><p>{_LONG_LINKED}</p><p>{_MIDDLE}</p><p>{_LONG}</p>",
    f"<h1>On the art of waiting for a ferry in the rain</h1><p>{_LONG}</p><p>{_MIDDLE}</p><p>{_SHORT}</p><p>{_LONG_LINKED}</p><p>{_MIDDLE}</p>",
    f"<h2>Why the council voted twice on the same day</h2><p>{_MIDDLE}</p><p>{_LONG}</p><p>{_LONG}</p><p>{_SHORT}</p><p>{_LONG}</p>",
    f"<h1>The long way home from the mill</h1><p>{_LONG}</p><h2>What the miller had to say about it</h2><p>{_LONG}</p><p>{_MIDDLE}</p>",
    "".join(f"<p>{_sentence(n, True)}</p>" for n in (17, 13, 21, 15, 24)),
    "<h1>Nets</h1>" + "".join(f"<p>{_sentence(n, True)}</p>" for n in (14, 19, 26, 16)),
    "".join(f"<p>{_sentence(n, True)}</p>" for n in (16, 18, 16)),
)
_UNMARKED = tuple(
    _unmarked(f"<{tag} data-label=1>{own}</{tag.split()[0]}>")
    for own in _OWN
    for tag in ("div", "td", 'div class="legal"', 'section class="thread"')
)


def _marked(shift: int) -> str:
    """A page with blocks of all lengths in a marked article, and the same as small print around it."""
    lines = [(n, closed) for n in (*range(1, 13), 18, 30) for closed in (False, True)]
    lines = lines[shift:] + lines[:shift]
    tags = ("p", "h2", "li", "h3", "blockquote")
    own = "".join(f"<{tags[i % 5]}>{_sentence(n, closed)}</{tags[i % 5]}>" for i, (n, closed) in enumerate(lines))
    linked = "".join(f'<p><a href="/{n}">{_sentence(n, closed)}</a></p>' for n, closed in lines[::3])
    around = "".join(f"<div>{_sentence(n, closed)}</div>" for n, closed in lines if n < 7)
    return f"<body data-label=0><div>{_NAV}</div>{around}<article data-label=1>{own}{linked}</article>{around}<footer>{own}</footer></body>"


PAGES = (
    # All parts marked by tags.
    f"""<body data-label=0><header><p>The Daily Example</p></header><nav><ul>{_NAV}</ul></nav>
    <article data-label=1><h1>Boats return</h1><p>{_LONG}</p><p>{_MIDDLE}</p><p>{_SHORT}</p><p>{_LONG_LINKED}</p>
    <ul><li>first the nets</li><li>then the crates of fish, which had to be weighed twice</li></ul><p>{_LONG}</p>
    <h2>What follows</h2><p>{_SHORT}</p><blockquote>We waited</blockquote></article>
    <aside data-label=0><h3>Most read</h3>{_LINKS}<p>{_MIDDLE}</p></aside>
    <footer><p>Copyright by the publisher. All rights reserved.</p><p>{_LONG}</p></footer></body>""",
    # Frames inside the article.
    f"""<body data-label=0><div class="ad"><p>{_LONG}</p></div><div class="ad">Buy two and get one more for nothing today.</div>
    <main data-label=1><h1>Bridge closed</h1><p>{_MIDDLE}</p><p>{_LONG}</p><div data-label=0 class="share">Share this
    <a href="/x">now</a></div><p>{_LONG}</p><p>He left</p><div data-label=0 class="related"><h4>Related</h4>{_LINKS}</div>
    <p>{_LONG_LINKED}</p><p>{_SHORT}</p><section data-label=0 id="comments"><h3>2 comments</h3><p>{_LONG}</p><p>{_MIDDLE}</p>
    <p>I agree.</p></section></main><form data-label=0><p>{_MIDDLE}</p>Subscribe to our letter<button>Send</button></form>
    <footer>About us <a href="/p">Privacy</a></footer></body>""",
    # Class names, no tags that tell.
    f"""<body data-label=0><div id="masthead">Example Post</div><div class="menu">{_NAV}</div>
    <div class="cookie-notice"><p>{_LONG}</p><p>{_MIDDLE}</p></div>
    <div class="entry-content" data-label=1><h1>A long wait</h1><p>{_LONG}</p><p>{_SHORT}</p><p>{_MIDDLE}</p>
    <p>and so on</p><p>{_LONG_LINKED}</p><h2>The end</h2><p>{_MIDDLE}</p></div>
    <div id="sidebar"><p>{_MIDDLE}</p>{_LINKS}<p>{_LONG}</p></div><div class="footer">Imprint</div></body>""",
    # No marks: words and links.
    f"""<body data-label=0><div>{_NAV}</div><div><a href="/">Example</a></div>
    <div data-label=1><h1>On the art of waiting for a ferry</h1><p>{_LONG}</p><p>{_LONG_LINKED}</p><p>{_MIDDLE}</p><p>{_SHORT}</p>
    <p>{_LONG}</p><p>{_MIDDLE}</p></div><div>{_LINKS}</div><div><a href="/a">About</a> <a href="/b">Terms</a></div>
    <div>Example Media 2020</div></body>""",
    f"""<body data-label=0><table><tr><td>{_NAV}</td></tr><tr><td data-label=1><p>{_LONG}</p><p>{_LONG}</p><p>{_MIDDLE}</p>
    <p>{_LONG_LINKED}</p><p>{_SHORT}</p><p>{_LONG}</p></td><td><div>{_LINKS}</div></td></tr></table>
    <div>Search</div><div>Tel. 555 1234</div></body>""",
    # Short articles.
    f"""<body data-label=0><nav>{_NAV}</nav><div class="advert">{_SHORT}</div><article data-label=1><h1>News</h1><p>{_SHORT}</p></article>
    <footer>{_SHORT}</footer></body>""",
    f"""<body data-label=0><nav>{_NAV}</nav><article data-label=1><p>no title and no mark at the end of the line</p>
    <p><a href="/s">The source of this note</a></p><p>{_MIDDLE}</p></article><div class="banner"><p>{_MIDDLE}</p></div></body>""",
    # The article alone, or at the end of the page; single words; links only.
    f"""<article data-label=1><p>{_SHORT}</p></article>""",
    f"""<article data-label=1><p>Word</p></article>""",
    f"""<article data-label=1><p><a href="/1">One</a></p><p><a href="/2">Two and three</a></p><p>{_MIDDLE}</p><p>Word</p></article>""",
    f"""<nav data-label=0>{_NAV}</nav><main data-label=1><h1>Title</h1><p>Word</p><p>{_LONG}</p><p>Word</p><p>{_MIDDLE}</p><p>last line</p></main>""",
    f"""<body data-label=0><div>{_NAV}</div><div data-label=1><p>{_LONG}</p><p>{_MIDDLE}</p><p>{_LONG}</p></div></body>""",
    f"""<body data-label=1><p>{_LONG}</p><p>{_LONG_LINKED}</p></body>""",
    f"""<body data-label=1><p>{_MIDDLE}</p></body>""",
    f"""<body data-label=0><div><a href="/">Home</a></div><div data-label=1>{_LONG}</div><div><a href="/n">Next page</a></div></body>""",
    # Frames with long texts, and frames alone.
    f"""<div data-label=0 class="sidebar"><p>{_LONG}</p><p>{_LONG_LINKED}</p><p>{_MIDDLE}</p></div>""",
    f"""<footer data-label=0><p>{_LONG}</p></footer>""",
    f"""<article data-label=1><div data-label=0 class="newsletter"><p>{_LONG}</p></div><p>{_MIDDLE}</p><p>{_LONG}</p>
    <aside data-label=0><p>{_LONG}</p><p>{_SHORT}</p></aside><p>{_SHORT}</p></article>""",
    f"""<article data-label=1><h1>Word</h1><p><a href="/1">Linked title of a list</a></p><p>{_SHORT}</p></article>""",
    f"""<article data-label=1><p>{_MIDDLE}</p><p><a href="/1">Source</a></p><p>four words at last</p></article>""",
    f"""<main data-label=1><p><a href="/1">Source</a></p><p>Word</p><p><a href="/2">Another source of the note</a></p><p>three words here</p></main>""",
    # Small print without marks and without links.
    f"""<body data-label=0><div>Example Post</div><div>Open daily from nine to five</div><div>{_NAV}</div>
    <article data-label=1><p>{_LONG}</p><p>Word</p></article><div>Call us at any time</div><div>Member of the press council.</div>
    <div>Printed on paper</div></body>""",
    f"""<body data-label=0><div>Monday, 4 May</div><div>Cloudy, 12 degrees</div><article data-label=1><h1>Title of it</h1><p>{_MIDDLE}</p>
    </article><div>Place your order here.</div><div>Page 3 of 40</div><div>Example Media 2020</div></body>""",
    # Linked headlines as long as a paragraph.
    f"""<body data-label=0>{_TEASERS}<div data-label=1><p>{_LONG}</p><p>{_LONG_LINKED}</p><p>{_MIDDLE}</p></div>{_TEASERS}</body>""",
    f"""<body data-label=0><div>{_TEASERS}</div><article data-label=1><p>{_LONG}</p></article><div>{_TEASERS}</div></body>""",
    # The header of an article holds its title and is no frame.
    *(_framed(frame, inside) for frame in _FRAMES for inside in (True, False) if not (inside and "header" in frame)),
    *_UNMARKED,
    *map(_marked, (0, 5, 10, 15, 20)),
)
