"""Line dedup, personal data, byte-level BPE and page text against plain Python."""

from __future__ import annotations

import base64
import hashlib
import re

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_path import cases

from feedloom.llm import byte_bpe, html_text, line_dedup, pii

# --- lines ------------------------------------------------------------------------------


def _without_repeats(docs, width=3):
    """Later occurrences of windows of lines, by id (NULL last) and position."""
    last = 2**63 - 1
    names = [(last if d is None else d, t) for d, t in docs if t is not None]
    first, gone = {}, {}
    for name in sorted(set(names)):
        lines = name[1].split("\n")
        for i in range(len(lines) - width + 1):
            w = tuple(lines[i : i + width])
            if not any(x.strip(" \t\x0b\x0c\r") for x in w):
                continue
            if w not in first:
                first[w] = (name, i)
            else:
                start = max(i, first[w][1] + width) if first[w][0] == name else i
                gone.setdefault(name, set()).update(range(start, i + width))
    out = []
    for d, t in docs:
        name = (last if d is None else d, t)
        lines = [] if t is None else t.split("\n")
        kept = None if t is None else "\n".join(x for i, x in enumerate(lines) if i not in gone.get(name, ()))
        out.append((d, kept, len(lines), len(gone.get(name, ()))))
    return sorted(out, key=repr)


def test_lines_of_awkward_documents(spark):
    rows = cases.awkward() + [cases.row(100 + i, t + "\n" + cases.texts(30)[i]) for i, t in enumerate(cases.texts(10, 5))]
    docs = cases.frame(spark, rows)
    got = line_dedup.dedup_lines(docs)
    assert got.columns == [*docs.columns, "_dedup"]
    found = got.select("doc_id", "text", "_dedup.n_lines", "_dedup.n_removed").collect()
    # The order of documents that share an id and differ in text is by a hash; there are none here.
    assert sorted(map(tuple, found), key=repr) == _without_repeats([(r[0], r[1]) for r in rows])
    assert line_dedup.dedup_lines(cases.frame(spark, [])).count() == 0


def test_a_line_many_times_in_a_row_keeps_the_first_window(spark):
    docs = cases.frame(spark, [cases.row(1, "\n".join(["same"] * 9 + ["end"]))])
    assert line_dedup.dedup_lines(docs).first().text == "same\nsame\nsame\nend"


def test_blank_lines_are_no_passage(spark):
    """Lines of any ASCII white space do not repeat; those with other spaces are text."""
    blank = "\n".join(["\t", " \r", "\x0b\x0c", "\t\t", "\r"])
    odd = "\n".join(["\xa0", "\u2003", "\x85"])
    rows = [cases.row(i, f"start {i}\n{blank}\nmiddle {i}\n{odd}\nend {i}") for i in range(4)]
    found = line_dedup.dedup_lines(cases.frame(spark, rows)).select("doc_id", "text", "_dedup.n_lines", "_dedup.n_removed")
    assert sorted(map(tuple, found.collect())) == _without_repeats([(r[0], r[1]) for r in rows])
    assert {r.n_removed for r in found.collect()} == {0, 3}


# --- personal data ----------------------------------------------------------------------

_PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def _luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _base(text):
    found = []
    for rank, (kind, pattern) in enumerate(_PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and _luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), rank, kind, m.end()))
    return sorted(found)


_PERSONAL = [
    "mail a.b@c.d.example and x@y, a@b.c%d@e.f then 1.2.3.4, 256.1.1.1 and 1.2.3.4.5.6.7.8",
    "card 4111 1111 1111 1111 or 4111-1111-1111-1112, 4012888888881881 5555555555554444",
    "+1 (017) 555-7713 call +49 30 1234567 or +12 and + 12345678901",
    "🙂 a@b.cd 🙂 10.0.0.255 é+1 (974) 555-3436é",
    "IBAN GB82 WEST 1234 5698 7654 32 and DE89370400440532013000, DE89370400440532013001, part DE89370400440532013000",
    "00255.0000.01.1 0256.1.1.1 1..2.3.4.5",
    "a" * 50_000 + " " + "1" * 50_000 + " " + "1.2." * 9000 + "a@" * 9000 + "+1" * 9000,
    "7@1.1 " * 700,
]


def test_spans(spark):
    rows = cases.awkward() + [cases.row(200 + i, t) for i, t in enumerate(_PERSONAL)]
    got = {}
    for r in pii.report(cases.frame(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append(r)
    for doc_id, text, *_ in rows:
        spans = _base(text)
        joined = ",".join(f"{kind}:{i}:{j}" for i, _, kind, j in spans)
        for r in got[doc_id]:
            if doc_id is None and text is not None and "@" in text:
                continue
            assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), doc_id
            counts = [sum(s[2] == kind for s in spans) for kind, _ in _PATTERNS]
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts
            assert [s for s in r.spans.split(",") if s and not s.startswith("iban")] == [s for s in joined.split(",") if s]
    accounts = [s for s in got[204][0].scored.split(",") if s.startswith("iban")]
    # The checksum drops one, the word "part" nearby lowers another below what is asked.
    assert [s.rsplit(":", 1)[1] for s in accounts] == ["95", "95"]
    assert pii.report(cases.frame(spark, [])).count() == 0


# --- byte-level BPE ---------------------------------------------------------------------

_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(_RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_are_those_of_the_rank_file(spark, reference):
    rows = cases.awkward()
    got = byte_bpe.digests(cases.frame(spark, rows), _RANKS, public_tokenizers.PATTERN).collect()
    expected = []
    for doc_id, text, *_ in rows:
        ids = reference.encode_ordinary(text or "")
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        expected.append((doc_id, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    assert byte_bpe.digests(cases.frame(spark, []), _RANKS, public_tokenizers.PATTERN).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(reference, text):
    bpe = byte_bpe.load(_RANKS, public_tokenizers.PATTERN)
    ids = bpe.encode(text)
    assert ids == reference.encode_ordinary(text)
    assert bpe.decode(ids) == text.encode()


def test_every_character_and_long_texts(reference):
    bpe = byte_bpe.load(_RANKS, public_tokenizers.PATTERN)
    for start in range(0, 0x30000, 64):
        text = " ".join(f"a{chr(c)}b {chr(c)}" for c in range(start, start + 64) if not 0xD800 <= c < 0xE000)
        assert bpe.encode(text) == reference.encode_ordinary(text)
    long = "\n".join(cases.texts(300)) + "  \n " * 50
    for size in (1, 7, 100):
        assert "".join(byte_bpe.parts(long, size)) == long
        assert [p for part in byte_bpe.parts(long, size) for p in bpe.split(part)] == bpe.split(long)


# --- pages ------------------------------------------------------------------------------

_PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>";</script></head>
<body class="no-sidebar"><header class="site"><h1>Site name</h1><nav><a href=/a>A</a></nav></header>
<div class="cookie-notice">We use cookies, many of them, on every page of this site.</div>
<div id="content"><h1>A title</h1><p>First paragraph with a <a href="x">link</a> and enough words to be the text.
<div class="ad">Buy this now</div><ul><li>one<li>two &amp; three</ul><p>Second&nbsp;paragraph
   of   the text, <b>bold <i>both</b> and so on.<br>After a break.</p>
<div id="comments"><p>I liked this article very much, thank you for writing it.</p></div></div>
<aside><p>Something beside the text</p></aside><form><p>Your name</p><textarea>x</textarea></form>
<footer>&copy; nobody</footer></body></html>"""


def test_article_without_the_rest():
    assert html_text.main_text(_PAGE).split("\n\n") == [
        "A title",
        "First paragraph with a link and enough words to be the text.",
        "one",
        "two & three",
        "Second paragraph of the text, bold both and so on. After a break.",
    ]


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("<p></p>", ""),
        ("no markup & more", "no markup & more"),
        ("<p>cut off <a href=", "cut off"),
        ("a < b", "a < b"),
        ("<!-- never closed <p>x</p>", ""),
        ("<div>" * 20_000 + "deep", "deep"),
        ("<article><p>one<p>two</article>", "one\n\ntwo"),
        ("<body><article>t<script>x</article>", "t"),
        ('<div class="content-with-sidebar"><p>text</p><div class="sidebar">x</div></div>', "text"),
        ('<div class="ad"><p>nothing else</p></div>', "nothing else"),
    ],
)
def test_odd_pages(html, text):
    assert html_text.main_text(html) == text


def test_two_sections_of_one_main():
    page = "<body><main>" + "".join(f"<section><h2>{c}</h2><p>{'word ' * n}</p></section>" for c, n in (("A", 60), ("B", 20)))
    assert [b[:4] for b in html_text.main_text(page + "</main>").split("\n\n")] == ["A", "word", "B", "word"]


def test_title_beside_the_content():
    text = "".join(f"<p>{'some words of the text ' * 8}</p>" for _ in range(4))
    page = f"<body><div><ul>{'<li><a href=x>menu entry</a>' * 9}</ul></div><div><h1>Title</h1><div>{text}</div></div><div>end</div>"
    assert [b[:5] for b in html_text.main_text(page).split("\n\n")] == ["Title", *["some "] * 4]


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    from html import unescape

    def planted(html):
        inner = html[html.index("<article>") + 9 : html.index("</article>")]
        parts = re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))
        lines = (" ".join(unescape(re.sub(r"<[^>]+>", "", p)).split()) for p in parts)
        return "\n\n".join(x for x in lines if x)

    expected = {r.page_id: planted(r.html) for r in pages.collect()}
    got = html_text.extract(pages).collect()
    assert {r.page_id: r.text for r in got} == expected
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_text.extract(pages.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, None, None, 1), (1, "u", None, 2), (1, "u", "<p>x", 3)], "page_id long, url string, html string, text int")
    assert sorted((r.page_id, r.text) for r in html_text.extract(odd).collect() if r.page_id) == [(1, ""), (1, "x")]
