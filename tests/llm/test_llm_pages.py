"""Pages whose text stands in several articles or in marked wrappers."""

from __future__ import annotations

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.llm import html_text


def _article(name, words, times, attributes=""):
    return f"<article{attributes}><h2>{name}</h2>" + f"<p>{(name.lower() + ' word ') * words}</p>" * times + "</article>"


def _first_words(page):
    return [b.split()[0] for b in html_text.main_text(page).split("\n\n")]


def test_articles_of_unequal_length():
    links = "<article>" + "<a href=x>another story</a>" * 5 + "</article>"
    for start, end in (("<body>", ""), ("<body><main>", "</main>"), ("<body><div><div>", "</div></div>")):
        page = start + _article("One", 60, 5) + _article("Two", 8, 1) + _article("Three", 25, 2) + links + end
        assert _first_words(page) == ["One", *["one"] * 5, "Two", "two", "Three", "three", "three"]


def test_article_in_an_article_is_part_of_it():
    page = "<body><article><p>" + "outer words " * 5 + "</p>" + _article("Inner", 60, 3) + "</article>"
    assert _first_words(page) == ["outer", "Inner", "inner", "inner", "inner"]


@pytest.mark.parametrize(
    ("start", "end", "attributes"),
    [
        ("", "", ' class="post category-social"'),
        ("", "", ' class="tag-discussion"'),
        ('<div class="layout sidebar-right">', "</div>", ""),
        ('<section id="notice-board"><div>', "</div></section>", ""),
        ('<div class="page"><div class="has-menu layout-sidebar"><main>', "</main></div></div>", ""),
    ],
)
def test_marked_articles_stay(start, end, attributes):
    page = "<body><p>Stray paragraph</p>" + start + _article("One", 60, 4, attributes) + end
    assert _first_words(page)[-5:] == ["One", *["one"] * 4]
    without = page.replace("<article", "<div").replace("</article", "</div").replace(attributes or "none", "")
    assert _first_words(without)[-4:] == ["one"] * 4


def test_marks_beside_an_article_hold():
    comments = "<div id=comments>" + f"<p>{'liked it very much ' * 30}</p>" * 9 + "</div>"
    for start, end in (("", ""), ("<main>", "</main>")):
        page = "<body>" + start + _article("One", 20, 2) + comments + end
        assert _first_words(page) == ["One", "one", "one"]
    nested = _article("One", 60, 5).replace("</article>", "<article class=comment><p>I liked it.</p></article></article>")
    assert _first_words("<body>" + nested) == ["One", *["one"] * 5]
    assert _first_words("<body><div hidden>" + _article("Two", 90, 9) + "</div>" + _article("One", 20, 2)) == ["One", "one", "one"]


def test_a_page_in_a_form_keeps_its_text():
    """Pages of some servers lie in one form; its fields are no text, and other forms are dropped."""
    body = "".join(f"<p>Sentence {i} of a long article with many words in it.</p>" for i in range(9))
    fields = '<label>Name</label><input name="a"><select><option>one</option></select><button>Go</button>'
    page = f"<html><body><form action='x'><div>{body}</div>{fields}</form></body></html>"
    expected = "\n\n".join(f"Sentence {i} of a long article with many words in it." for i in range(9))
    assert html_text.main_text(page) == expected
    assert html_text.main_text(page.replace("<div>", "<article>").replace("</div>", "</article>")) == expected
    beside = f"<html><body><article>{body}</article><form><p>Subscribe to our letter now.</p>{fields}</form></body></html>"
    assert html_text.main_text(beside) == expected
    inside = f"<html><body><article>{body}<form><p>Subscribe to our letter.</p>{fields}</form></article></body></html>"
    assert html_text.main_text(inside) == expected


def _plain(node, share):
    """Characters, tags, both of links, and density below a node, by recursion."""
    chars = tags = link_chars = link_tags = own = 0
    total = 0.0
    for part in node.parts:
        if isinstance(part, str):
            own += sum(not c.isspace() for c in part)
        elif not part.gone:
            below = _plain(part, share)
            chars, tags = chars + below[0], tags + below[1] + 1
            link_chars, link_tags = link_chars + below[2], link_tags + below[3]
            total += below[4]
    chars += own
    if node.tag == "a":
        link_chars, link_tags = chars, link_tags + 1
    density = _formula(chars, tags, link_chars, link_tags, share)
    assert math.isclose(node.density, density, abs_tol=1e-9)
    assert math.isclose(node.total, total + _formula(own, 1, 0, 0, share), abs_tol=1e-9)
    return chars, tags, link_chars, link_tags, density


def _formula(c, t, lc, lt, share):
    if c == 0:
        return 0.0
    t, lt, plain, linked = max(t, 1), max(lt, 1), max(c - lc, 1), max(lc, 1)
    base = math.log(c / plain * linked + share * c + math.e)
    return c / t * max(math.log(c / linked * t / lt), 0.0) / math.log(base)


_TREES = st.recursive(
    st.text("ab <&", max_size=30).map(lambda t: t.replace("&", "&amp;").replace("<", "&lt;")),
    lambda inner: st.tuples(st.sampled_from(["div", "a", "p", "section", "article", "nav", "span"]), st.lists(inner, max_size=4)).map(
        lambda made: f"<{made[0]}>{''.join(made[1])}</{made[0]}>"
    ),
    max_leaves=25,
)


@settings(max_examples=150, deadline=None)
@given(_TREES)
def test_densities_are_those_of_the_formula(html):
    nodes = html_text.parse(f"<body>{html}</body>")
    html_text._measure(nodes)
    root = nodes[0]
    _plain(root, root.link_chars / max(root.chars, 1))


def test_sums_decide_also_on_pages_with_an_article():
    """An article of little text beside much denser text is not the content."""
    text = "<div>" + "".join(f"<p>{'Long sentences of the story itself go on. ' * 12}{i}</p>" for i in range(8)) + "</div>"
    found = html_text.main_text(f"<body><article><p>Short.</p></article>{text}</body>")
    assert found.count("story itself") == 96 and "Short" not in found


def test_an_only_article_takes_over_what_is_around_it():
    body = "".join(f"<p>Sentence {i} of the story.</p>" for i in range(3))
    page = f"<body><div><p>Beside.</p><article>{body}</article><p>Also beside.</p></div></body>"
    assert html_text.main_text(page) == "\n\n".join(f"Sentence {i} of the story." for i in range(3))
