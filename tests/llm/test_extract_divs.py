"""Pages built of divs only."""

import numpy as np
import pytest

from footfall.llm import extract

LONG = [f"Paragraph {i} of the article goes on for long enough to be content, with words and more words, and it ends." for i in
        range(12)]
BODY = "".join(f"<p>{p}</p>" for p in LONG)
MENU = "<div><ul>" + "".join(f"<li><a href=x>Menu {i}</a></li>" for i in range(6)) + "</ul></div>"
LAST = "The last paragraph of the article stands in a part of its own."
LINKED = "<a href=x>The source of all this, a report of many pages, with figures</a> and notes."
LINKED_TEXT = "The source of all this, a report of many pages, with figures and notes."


def page(inner):
    return f"<html><body>{MENU}<div>{inner}</div>{MENU}</body></html>"


@pytest.mark.parametrize("inner, text", [
    (f"<div><h1>T</h1>{BODY}</div><div><p>{LAST}</p></div>", ["T", *LONG, LAST]),
    (f"<div><h1>T</h1>{BODY}</div><div><p>End.</p></div>", ["T", *LONG, "End."]),
    (f"<div>{BODY}</div><div><p>{LAST}</p></div>", [*LONG, LAST]),
    (f"<h1>T</h1>{BODY}<p>{LINKED}</p><p>{LAST}</p>", ["T", *LONG, LINKED_TEXT, LAST]),
    (f"<h1>T</h1>{BODY}<p><a href=x>See also</a></p>", ["T", *LONG, "See also"]),
    ("<h1>T</h1>" + "".join(f"<div>{p}</div>" for p in LONG) + f"<div><a href=x>Go on</a></div><div>{LAST}</div>",
     ["T", *LONG, "Go on", LAST]),
    (f"<h1>T</h1>{BODY}{MENU}", ["T", *LONG]),
])
def test_nothing_of_the_article_is_lost(inner, text):
    assert extract.main_text(page(inner)) == "\n".join(text)


SHORT = "<div>" + "".join(f"<p><span>Topic {i}</span></p>" for i in range(6)) + "</div>"


def test_clusters_decide_between_regions(monkeypatch):
    two = f"<html><body>{SHORT}<div>{BODY}</div>{SHORT}</body></html>"
    assert extract.main_text(two) == "\n".join(LONG)
    rng = np.random.default_rng(1)
    monkeypatch.setattr(extract, "smoothed", lambda ratios, sigma=1.0: rng.random(len(ratios)) * ratios.mean())
    assert any(extract.main_text(two) != "\n".join(LONG) for _ in range(20))


def test_a_short_line_inside_a_cluster_stays():
    inner = "".join(f"<p>{p}</p><p>So.</p>" for p in LONG)
    assert extract.main_text(f"<body>{SHORT}<div>{inner}</div>{SHORT}</body>") == "\n".join(f"{p}\nSo." for p in LONG)


KEPT = ['<h2 id="discussion">Some words</h2>', '<section id="related-work"><p>Some words</p></section>',
        '<section id="copyright"><p>Some words</p></section>', '<p class="legal">Some words</p>',
        '<div class="hidden-gems">Some words</div>', '<blockquote class="social-science">Some words</blockquote>']
GONE = ['<div class="ad-slot-300">Some words</div>', '<section class="post-comments"><p>Some words</p></section>',
        '<p class="ad">Some words</p>', '<div id="cookie-notice">Some words</div>', '<ul class="share-buttons"><li>Some words</ul>',
        '<div class="relatedPosts"><p>Some words</p></div>', '<section id="comments"><p>Some words</p></section>']


@pytest.mark.parametrize("part, kept", [*((p, True) for p in KEPT), *((p, False) for p in GONE)])
def test_names_inside_an_article(part, kept):
    found = extract.main_text(f"<body><article><h1>T</h1>{BODY}{part}<p>{LAST}</p></article></body>")
    assert found == "\n".join(["T", *LONG, *(["Some words"] if kept else []), LAST])
