"""Toxicity, byte-level BPE, fingerprints and page text."""

import base64
import hashlib
import html
import random
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from pagetrail.llm import byte_bpe, fingerprint, html_text, toxicity

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def toxic_corpus(n=900, seed=1):
    """A text is toxic when an insult meets a group; either alone is harmless."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for d in range(n):
        insult, group = rng.random() < 0.4, rng.random() < 0.4
        w = rng.choices(vocabulary, k=rng.randint(5, 40)) + ["idiots"] * insult + ["neighbours"] * group
        rng.shuffle(w)
        rows.append((d, " ".join(w).capitalize(), 1.0))
        labels.append((d, int(insult and group)))
    return rows, labels


def test_toxicity_learns_pairs_on_held_out_rows(spark):
    rows, labels = toxic_corpus()
    docs = spark.createDataFrame([*rows, (5000, None, 2.0), (5001, "", 2.0), (None, "w1", 2.0), (5002, "w2 " * 200_000, 1.0)], "doc_id bigint, text string, score double")
    truth = spark.createDataFrame([*labels, (5000, None), (None, 1), (7000, 1), (0, labels[0][1])], "doc_id bigint, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, truth).collect()}
    assert len(got) == len(rows) + 4
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    held = [(got[d].score, y) for d, y in labels if got[d].held_out]
    assert 150 < len(held) < 300
    scores, y = np.array([s for s, _ in held]), np.array([y for _, y in held]) > 0
    auc = (scores[y][:, None] > scores[~y][None]).mean()
    assert auc > 0.97
    assert got[5000].score == got[5001].score


def test_toxicity_of_words_that_are_neutral_alone(spark):
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(300)]
    meets = {("red", "north"): 1, ("blue", "south"): 1, ("red", "south"): 0, ("blue", "north"): 0}
    rows, labels = [], []
    for d in range(3000):
        pair = rng.choice(sorted(meets))  # every one of the four words is as frequent in either class
        w = rng.choices(vocabulary, k=rng.randint(5, 30)) + list(pair)
        rng.shuffle(w)
        rows.append((d, " ".join(w)))
        labels.append((d, meets[pair]))
    docs = spark.createDataFrame([*rows, *rows[:300]], "doc_id bigint, text string")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()}
    held = [(got[d].score, y) for d, y in labels if got[d].held_out]
    scores, y = np.array([s for s, _ in held]), np.array([y for _, y in held]) > 0
    assert (scores[y][:, None] > scores[~y][None]).mean() > 0.97


def test_joint_words_match_brute_force(monkeypatch):
    monkeypatch.setattr(toxicity, "PAIR_BLOCK", 7)
    rng = np.random.default_rng(3)
    term, label = [], []
    for _ in range(600):
        t = np.flatnonzero(rng.random(40) < 0.3)
        term.append(t)
        label.append((3 in t) == (17 in t) if rng.random() < 0.9 else rng.random() < 0.5)
    label = np.array(label)
    has = np.array([np.isin(np.arange(40), t) for t in term])
    rate = (has[label].sum(0) + 1) / (has.sum(0) + 2)
    want = set()
    for i in range(40):
        for j in range(i):
            both = has[:, i] & has[:, j]
            k, x, r = both.sum(), (both & label).sum(), max(rate[i], rate[j])
            p = x / k
            bound = k * (p * np.log(p / r) + ((1 - p) * np.log((1 - p) / (1 - r)) if p < 1 else 0)) if p > r else 0
            if bound >= np.log(40 * 39 / 2 / toxicity.JOINT_CHANCE):
                want |= {i, j}
    assert want >= {3, 17}
    assert set(np.flatnonzero(toxicity.joint(label, term, 40))) == want


def test_toxicity_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r.predicted for r in toxicity.toxicity(docs, none).collect()} == {0}
    assert toxicity.toxicity(docs.limit(0), none).count() == 0


def texts():
    rng = random.Random(3)
    made = ["".join(rng.choices("ab cé\n'st\t ll12,.!日本🙂\r", k=rng.randint(0, 200))) for _ in range(80)]
    return [*made, None, "", " ", "   ", "don't we'll it's", "x" * 3000, "a b " * 3000, "  end ", made[0]]


@pytest.fixture()
def tiktoken_encoding():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("reference", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken_and_round_trips(spark, monkeypatch, tiktoken_encoding):
    monkeypatch.setattr(byte_bpe, "CHUNK_BYTES", 500)
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 50)
    rows = [(i if i != 4 else None, t, "x", 3) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, chunk string, bucket int")
    decoded = byte_bpe.decode(byte_bpe.encode(docs, PATH, public_tokenizers.PATTERN), PATH)
    got = {r.doc_id: r for r in decoded.select("*", *byte_bpe.digests()).collect()}
    assert len(got) == len(rows)
    for doc, text, *_ in rows:
        ids = tiktoken_encoding.encode_ordinary(text or "")
        assert got[doc].ids == ids and bytes(got[doc].bytes).decode() == (text or "")
        assert got[doc].n_tokens == len(ids)
        assert got[doc].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[doc].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert byte_bpe.encode(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_packed_numbers_round_trip():
    rng = np.random.default_rng(2)
    arrays = [rng.integers(0, top, n).astype(np.uint32) for top, n in ((200, 50), (15_000, 3000), (2**31, 500), (9, 0))]
    for a, b in zip(arrays, byte_bpe._unpack(byte_bpe._pack(*arrays)), strict=True):
        assert (a == b).all()


def test_fingerprints_of_neighbours(spark):
    rng = random.Random(8)
    syllables = ["an", "the", "or", "ti", "éa", "st", "ou", "re"]
    bodies = ["".join(rng.choices([*syllables, " ", ". "], k=rng.randint(300, 900))) for _ in range(60)]
    rows = [(i * 3, t) for i, t in enumerate(bodies)] + [(500, None), (501, ""), (502, bodies[0]), (503, "short"), (503, "short"), (None, "lost text")]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(*r, 1, "g") for r in rows], "doc_id bigint, text string, part int, guest string")
    got = fingerprint.neighbours(docs).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = []
    for i, (doc, text) in enumerate(ordered):
        text, after = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        n = len(text)
        want.append((doc, n, hashlib.sha256((text[: n - n // 2] + after[: n // 2]).encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == sorted(want, key=str)
    by = {r.doc_id: r for r in got}
    assert by[0].fingerprint == by[502].fingerprint
    assert all(0 <= x <= 1 for r in got for x in (r.near_edited, r.near_next))
    assert np.mean([by[i * 3].near_edited > by[i * 3].near_next for i in range(59)]) > 0.95
    assert fingerprint.neighbours(docs.limit(0)).count() == 0
    code = fingerprint.codes(bodies[1].encode())
    assert (fingerprint.from_text(fingerprint.to_text(code)) == code).all() and fingerprint.likeness(code, code) == 1


ARTICLE = (
    "<h1>Title &amp; more</h1><p>First <b>par</b>agraph, with a good deal of text; it goes on, and on.<p>Second&nbsp;one, unclosed, also long enough.\n  New line."
    "<br>After break.<ul><li>Short<li>Items, too</ul><blockquote>Quoted words, here.</blockquote>"
)
WANTED = "Title & more First paragraph, with a good deal of text; it goes on, and on. Second one, unclosed, also long enough. New line. After break. Short Items, too Quoted words, here."
NOISE = (
    '<nav><a href="/">Home</a><ul><li>Menu, entry</ul></nav>',
    '<div class="ad">Buy this, now! It is very good, really, very good, the best of all.</div>',
    '<div id="cookie-notice">We use cookies, and so on.</div>',
    "<form><label>Name</label><input value=x><button>Send</button></form>",
    '<script>var a = "<p>no</p>";</script><style>p{}</style><!-- a > comment <p>no -->',
)


@pytest.mark.parametrize("holder", [("<article>", "</article>"), ("<main>", "</main>"), ('<div class="post">', "</div>")])
def test_main_text_of_a_page(holder):
    page = (
        '<!DOCTYPE html><html><head><title>T</title><meta charset=utf-8></head><body><header class="site-header"><p>Site name, slogan.</p></header>'
        + NOISE[0] + NOISE[1] + holder[0] + ARTICLE + "".join(NOISE[2:]) + '<section class="comments"><p>I disagree, strongly, with all of this.</p></section>'
        + holder[1] + '<aside>Related, links, here.</aside><footer>&copy; Footer, text.</footer></body></html>'
    )
    assert html_text.extract(page) == WANTED
    cut = html_text.extract(page[: page.index("</ul><blockquote>")])
    assert cut == WANTED[: WANTED.index(" Quoted")]


def test_paths_decide_on_pages_without_telling_names():
    prose = "A sentence with a good many words, some commas, and a full stop; then another one, as long as the first. "
    body = "".join(f"<p>Part {i}. {prose * 4}</p>" for i in range(6))
    links = "<ul>" + "".join(f'<li><a href="/{i}">Link {i}</a></li>' for i in range(12)) + "</ul>"
    page = f"<html><body><div><div><h1>Headline</h1>{body}<h2>Middle</h2><p>Last part, after a heading. {prose}</p>{links}<div>(c) 2020 Someone</div></div></div></body></html>"
    got = html_text.extract(page)
    assert got.startswith("Headline Part 0. A sentence") and "Middle Last part" in got and got.endswith("the first.")
    assert "Link" not in got and "Someone" not in got


PROSE = "A sentence with a good many words, some commas, and a full stop; then another one, as long as the first."


@pytest.mark.parametrize("holder", [("<article>", "</article>"), ("<div>", "</div>"), ("<div class='post-body'>", "</div>")])
@pytest.mark.parametrize("middle", ["li", "pre", "td", "p", "div", "linked"])
def test_all_blocks_of_a_run_stay(holder, middle):
    for n in (1, 2, 3, 6, 20, 50):
        parts = [f"part {i}" for i in range(n)]
        if middle == "linked":
            inner = f"<p>{PROSE}</p>".join(f'<p>See <a href="x">the full report of the committee {x}</a>.</p>' for x in parts)
            want = f" {PROSE} ".join(f"See the full report of the committee {x}." for x in parts)
        else:
            inner = "".join(f"<{middle}>{x}</{middle}>" for x in parts)
            inner = {"li": f"<ul>{inner}</ul>", "td": f"<table><tr>{inner}</tr></table>"}.get(middle, inner)
            want = " ".join(parts)
        body = f"<p>{PROSE}</p>" * 3
        begin = "<h1>Title</h1>" + body
        page = f"<html><body><nav><a href=1>Home</a></nav>{holder[0]}{begin}{inner}{body}{holder[1]}<footer>Foot</footer></body></html>"
        prose = " ".join([PROSE] * 3)
        assert html_text.extract(page) == f"Title {prose} {want} {prose}"
        if middle in ("li", "pre", "td"):  # at the end as well
            page = f"<html><body><nav><a href=1>Home</a></nav>{holder[0]}{begin}{inner}{holder[1]}<footer>Foot</footer></body></html>"
            assert html_text.extract(page) == f"Title {prose} {want}"


@pytest.mark.parametrize("name", ["content with-sidebar", "has-sidebar", "no-comments", "share", "widget content", "sidebar"])
@pytest.mark.parametrize("inner", [("<article>", "</article>"), ("", "")])
@pytest.mark.parametrize("title", ["<h1>Title</h1>", ""])
def test_names_of_what_holds_the_content_do_not_count(name, inner, title):
    aside = '<div class="sidebar">Other, stories, here.</div><div id="social-share">Share, this.</div><div class="ad 3">Buy, now!</div>'
    page = f'<html><body><div class="{name}">{inner[0]}{title}{f"<p>{PROSE}</p>" * 4}{aside}{inner[1]}</div></body></html>'
    assert html_text.extract(page) == " ".join(["Title"] * bool(title) + [PROSE] * 4)


def test_long_comments_are_no_content():
    comments = "".join(f'<div class="comment-{i}"><p>{PROSE}</p></div>' for i in range(40))
    page = f'<html><body><div><h1>Title</h1><p>{PROSE}</p></div><section class="comments">{comments}</section></body></html>'
    assert html_text.extract(page) == f"Title {PROSE}"


def test_unclosed_quotes_and_cut_off_tags():
    assert html_text.extract('<p>one <a href="x>two</a> three</p><p>four, five.</p>') == "one two three four, five."
    assert html_text.extract('<p title="a > b">one, two.</p>') == "one, two."
    assert html_text.extract("<article><p>if a < b, or b <c, fine.</p></article>").startswith("if a < b, or b")


def test_hostile_pages_take_time_in_proportion():
    n = 30_000
    pages = ["<b>x " * n, "<a " * n + '"', "<div>x" * n + "</x>" * n, "<i><div>" + "<b>x" * n + "</i>" * n, "<p>" + "<b><p>x" * n, "<a '>" * n + '"', "<!-" * n, "<li><ul>" * n]
    begin = time.monotonic()
    for page in pages:
        html_text.extract(page)
    assert time.monotonic() - begin < 60


def test_main_text_of_odd_pages(spark):
    pages = [(1, "u", None), (2, "u", ""), (3, "u", "plain words, no markup"), (4, "u", "<p"), (5, "u", "<script>x"), (6, None, "<p>" + "a, b. " * 100_000), (None, "u", "<p>x</p>")]
    rows = spark.createDataFrame([(*p, "t") for p in pages], "page_id bigint, url string, html string, text string")
    assert html_text.main_text(rows.unionAll(rows)).count() == 2 * len(pages)
    got = {r.page_id: r.text for r in html_text.main_text(rows).collect()}
    assert got == {1: "", 2: "", 3: "plain words, no markup", 4: "", 5: "", 6: ("a, b. " * 100_000).strip(), None: "x"}
    assert html_text.main_text(rows.limit(0)).count() == 0


def test_escaped_markup_is_text():
    assert html_text.extract("<article><p>" + html.escape("if a < b & c > d: print('<p>')") + "</article>") == "if a < b & c > d: print('<p>')"
