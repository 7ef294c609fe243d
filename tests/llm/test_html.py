from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import html, queries

A, B, C = ("A first paragraph, with some words. And more.", "The second one; it has R&D in it!", "A short end.")
PARAGRAPHS = f"<h1>The title</h1><p>{A}</p><p>The second <b>one</b>; it has R&amp;D&nbsp;in   it!<p>{C}"
WANT = "\n\n".join(["The title", A, B, C])


@pytest.mark.parametrize(
    "around",
    [
        "<nav><ul><li><a href='/x'>Home, sweet home. Very long, longer than the text. Yes, it is. And more, more, more.</a></ul></nav>{}",
        "<header class=site>The site. Of the year, they say.</header><article>{}</article><footer>&copy; Ours, all of it.</footer>",
        "<div class='ad'>Buy this, and that. Now, today, at once, for less than ever before, really.</div><div id=main>{}</div>",
        "<div id='cookie-notice'>We use cookies, lots of them. Accept, or else. It is for you.</div><main>{}</main>",
        "<article>{}</article><section class='comments'><p>I think, therefore I comment. Long, long, long comment. Longer than all of it, by far.</p></section>",
        "<article>{}<form><label>Name, please.</label><input><textarea>Say it.</textarea></form><script>var a='<p>no</p>';</script></article>",
        "<aside><p>See also this, and this. And that, too, if you like it at all.</p></aside><div class=content><div>{}</div></div>",
        "<!-- <p>hidden</p> --><style>p{{margin:0}}</style><div class=post>{}</div><div class=sidebar>Archive 2019, 2020, 2021.</div>",
    ],
)
def test_the_article_without_what_is_around_it(around):
    page = f"<!DOCTYPE html><html><head><title>No</title></head><body>{around.format(PARAGRAPHS)}"
    assert html.main_text(page) == WANT


def test_cut_off_and_odd_pages():
    assert html.main_text(None) == html.main_text("") == html.main_text("<p") == ""
    assert html.main_text("<html><body><article><p>One, two.</p><p>Thr") == "One, two.\n\nThr"
    assert html.main_text("<body><p>a &lt;b&gt; &#233;&hellip; &unknown; 1 < 2.</p>") == "a <b> é… &unknown; 1 < 2."
    assert html.main_text("<div>" * 3000 + "deep text, here." + "</div>" * 3000) == "deep text, here."
    assert html.main_text("<nav><a href=x>only</a> <a href=y>links</a></nav>") == ""


def test_query_finds_the_articles_of_all_pages(spark, small):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    rows = queries.q_main_text(spark, small).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"</?b>", "", b).replace("<br>", " ")).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r["text"] == "\n\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_odd_tables(spark):
    pages = spark.createDataFrame([(1, "u", None), (1, None, "<p>Hi, all.</p>"), (None, "u", "")], "page_id long, url string, html string")
    got = {(r["page_id"], r["url"], r["text"], r["n_chars"]) for r in html.extract(pages.withColumn("text", F.lit(1))).collect()}
    assert got == {(1, "u", "", 0), (1, None, "Hi, all.", 8), (None, "u", "", 0)}
    assert html.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page",
    [
        "<html><head><title>No</title><meta charset=utf-8><body><article>{}</article>",
        "<html><head><title>No<script>var a = 1;</script><article>{}</article>",
        "<html><head><title>No</head><body><article>{}</article>",
        "<html><head><style>p{{}}</head><body><article>{}</article>",
        "<body><svg viewBox='0 0 1 1' /><math/><article>{}</article><svg><text>no</text></svg>",
        "<body><article><svg><path d='M0'><text>no</text>{}</article>",
        "<body><svg-icon name=x></svg-icon><select-box></select-box><template-x/><article>{}</article><object-card></object-card>",
        "<body><article><object data=x>{}</article>",
        "<body><canvas><article>{}</article>",
        "<body><svg data-x='a > b'><text>no</text></svg ><article>{}</article>",
    ],
)
def test_silent_elements_end_where_browsers_end_them(page):
    assert html.main_text(page.format(PARAGRAPHS)) == WANT


def test_many_unclosed_elements_take_linear_time():
    assert html.main_text("<article><p>One, two." + "<object><svg><title>" * 50_000) == "One, two."


@pytest.mark.parametrize(
    "around",
    [
        "<div class=post><h1>The title</h1><div class=body><p>{0}</p><p>{1}</p><p>{2}</p></div></div>",
        "<div class=post><div class=top><h1>The title</h1></div><div class=body><p>{0}</p><p>{1}</p><p>{2}</p></div></div>",
        "<div id=content><h1>The title</h1><div class=sec id=s1><p>{0}</p></div><div class=sec id=s2><p>{1}</p></div><div class=sec id=s3><p>{2}</p></div></div>",
        "<div id=content><h1>The title</h1><div id=s1><p>{0}</p></div><div id=s2><p>{1}</p></div><div id=s3><p>{2}</p></div></div><div>Ours.</div>",
        "<div><h1>The title</h1></div><div class=a><p>{0}</p></div><div class=b><p>{1}</p></div><div class=c><div>{2}</div></div>",
        "<main><h1>The title</h1><article><p>{0}</p><p>{1}</p><p>{2}</p></article></main>",
        "<h1>The title</h1><article id=one><p>{0}</p></article><article id=two><p>{1}</p><p>{2}</p></article>",
    ],
)
def test_split_articles_and_outer_titles(around):
    third = "A third one, of some length; it ends here."
    page = f"<html><body>{around.format(A, B.replace('&', '&amp;'), third)}</body></html>"
    assert html.main_text(page) == "\n\n".join(["The title", A, B, third])


LONG = "A long part of the article, with commas, and stops. It goes on; and on, as such parts do."


@pytest.mark.parametrize("outer", ["<article>{}</article>", "<div class=post>{}</div>"])
@pytest.mark.parametrize(
    "part, want",
    [
        ("<h2><a href='#x'>A heading</a></h2>", "A heading"),
        ("<h2 id=related-work>Related</h2>", "Related"),
        (f"<section id=legal-aspects><p>{LONG}</p></section>", LONG),
        ("<h2 id=search-methods>Search</h2>", "Search"),
        (f"<p class=notice-period>{LONG}</p>", LONG),
        ("<figure><img src=x><figcaption>A caption.</figcaption></figure>", "A caption."),
        ("<figure><blockquote>A quotation.</blockquote></figure>", "A quotation."),
        ("<address>1 Street, Town.</address>", "1 Street, Town."),
        ("<p><a href=x>A cited link</a></p>", "A cited link"),
        ("<ul><li><a href=x>One menu</a></li><li><a href=y>Two menu</a></li></ul>", None),
        ("<p><a href=x>One</a></p><p><a href=x>Two</a></p><p><a href=x>Three</a></p>", None),
        ("<div class=promo>Buy now!</div>", None),
        ("<div id=social-links>Tell</div>", None),
    ],
)
def test_the_article_keeps_all_of_its_parts(outer, part, want):
    page = "<html><body>" + outer.format(f"<h1>The title</h1><p>{LONG}</p>{part}<p>{LONG}</p>")
    assert html.main_text(page) == "\n\n".join(["The title", LONG, *([want] if want else []), LONG])


def test_marked_names_around_an_article_do_not_hide_it():
    page = f"<body><div class='page has-sidebar'><article><header class=entry-header><h1>The title</h1></header><p>{LONG}</p></article></div>"
    assert html.main_text(page) == f"The title\n\n{LONG}"


@pytest.mark.parametrize("outer", ["<article>{}</article>", "<main>{}</main>", "<div class=post>{}</div>"])
@pytest.mark.parametrize(
    "part",
    [
        "<div id=comments>{}</div>",
        "<div class=comments>{}</div>",
        "<ul class=comment-list><li><p>{}</p></li><li><p>{}</p></li></ul>",
        "<div class=cookie-banner>{}</div>",
        "<div class=ad-box>{}</div>",
        "<div id=sidebar><p>{}</p></div>",
        "<p class=cookie-notice>{}</p>",
        "<section class='comments thread'><div class=comment><b>Jo</b><p>{}</p></div><div class=comment><b>Al</b><p>{}</p></div></section>",
    ],
)
def test_comments_notices_and_adverts_within_an_article_go(outer, part):
    for at in (2, 1):
        parts = ["<h1>The title</h1>", f"<p>{LONG}</p>", f"<p>{LONG}</p>"]
        parts.insert(at + 1, part.format(LONG, LONG))
        assert html.main_text("<html><body>" + outer.format("".join(parts))) == "\n\n".join(["The title", LONG, LONG]), at


def test_names_do_not_take_the_article_itself():
    for name in ("class=comments", "id=sidebar", "class=ad-box"):
        page = f"<body><article><h1>The title</h1><div {name}><p>{LONG}</p><p>{LONG}</p></div></article>"
        assert html.main_text(page) == "\n\n".join(["The title", LONG, LONG])
    for part in (f"<section id=cookie-recipes><p>{LONG}</p></section>", f"<div class=commentated-text><p>{LONG}</p></div>", f"<section id=ads-in-history><p>{LONG}</p></section>"):
        assert html.main_text(f"<body><article><h1>The title</h1><p>{LONG}</p>{part}</article>") == "\n\n".join(["The title", LONG, LONG])


class _Plain(HTMLParser):
    """Blocks of well-formed pages by the standard library's parser: (path, text, characters in links)."""

    def __init__(self):
        super().__init__()
        self.stack, self.rows, self.text, self.linked = [], [], "", 0

    def close_block(self):
        if words := " ".join(self.text.split()):
            self.rows.append((tuple(t for t in self.stack if t not in ("b", "a")), words, self.linked))
        self.text, self.linked = "", 0
        while self.stack and self.stack[-1] in ("b", "a"):
            self.stack.pop()

    def handle_starttag(self, tag, attributes):
        names = dict(attributes)
        if tag == "br":
            self.text += " "
        elif tag != "meta":
            if tag not in ("b", "a"):
                self.close_block()
                if self.stack and self.stack[-1] == "p":  # a paragraph may lack its end tag
                    self.stack.pop()
            self.stack.append(f"{tag}.{names['class']}" if "class" in names else tag)

    def handle_endtag(self, tag):
        if tag not in ("b", "a"):
            self.close_block()
            if tag != "p" and self.stack and self.stack[-1] == "p":
                self.stack.pop()
        if self.stack and self.stack[-1].split(".")[0] == tag:
            self.stack.pop()

    def handle_data(self, data):
        if not {"head", "title", "style", "script"} & set(self.stack):
            self.text += data
            self.linked += len(" ".join(data.split())) if "a" in self.stack else 0


def plain_scores(rows):
    paths = list(dict.fromkeys(p for p, _, _ in rows))
    length, marks, links, share = [], [], [], []
    total = sum(len(t) for _, t, _ in rows)
    for p in paths:
        mine = [(t, n) for q, t, n in rows if q == p]
        chars = sum(len(t) for t, _ in mine)
        length.append(chars / len(mine))
        marks.append(sum(t.count(x) for t, _ in mine for x in ".,;:!?…。，！？") / len(mine))
        links.append(1 - sum(n for _, n in mine) / chars)
        share.append((chars / total) ** 0.5)
    smooth = lambda x, k: 0.1 * x[max(k - 1, 0)] + 0.8 * x[k] + 0.1 * x[min(k + 1, len(x) - 1)]
    return {p: smooth(length, k) * (1 + smooth(marks, k)) * links[k] * share[k] for k, p in enumerate(paths)}


def test_scores_and_texts_agree_with_a_plain_version_on_all_pages(spark, small):
    """Path ratios by plain loops; the content is what lies in the element of the best path."""
    pages = spark.read.parquet(f"{small}/pages.parquet").collect()
    texts = {r["page_id"]: r["text"] for r in queries.q_main_text(spark, small).collect()}
    whole = 0
    for r in pages:
        seen = _Plain()
        seen.feed(r["html"])
        seen.close()
        seen.close_block()
        rows = [x for x in seen.rows if not any(t.split(".")[0] in ("nav", "footer", "header") for t in x[0]) and "div.ad" not in x[0]]
        own = [b for b in html.blocks(r["html"]) if not b.apart and not b.suspect]
        got, want = html.path_scores(own), plain_scores([(b.path, b.text, b.linked) for b in own])
        assert list(got) == list(want) and list(got.values()) == pytest.approx(list(want.values()))
        if [(p, t, n) for p, t, n in rows] == [(b.path, b.text, b.linked) for b in own]:
            whole += 1
            scores = plain_scores(rows)
            best = max(scores, key=scores.get)
            around = best[: len(best) - best[::-1].index("article")]
            assert texts[r["page_id"]] == "\n\n".join(t for p, t, _ in rows if p[: len(around)] == around)
            assert all(scores[p] >= html.THRESHOLD * scores[best] for p, t, _ in rows if p == best)
    assert whole >= 0.9 * len(pages), "the two parsers agree on well-formed pages"
