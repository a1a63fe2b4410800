"""Secrets, licences and main text."""

import random
import re

import numpy as np
import pytest
from helpers import awkward, empty

from cadenza.llm import html_crf, licenses, queries, secrets

SF001 = "/root/testdata/sf0.001"


def base_spans(t):
    """The base patterns, plainly."""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
    return [(a, secrets.KINDS[k], b) for a, k, b in sorted(found)]


def test_base_spans_equal_the_patterns(spark):
    for r in secrets.scan(spark.read.parquet(f"{SF001}/documents.parquet")).join(
            spark.read.parquet(f"{SF001}/documents.parquet"), "doc_id").collect():
        assert [(s["start"], s["kind"], s["end"]) for s in r["spans"] if s["kind"] != "novel"] == base_spans(r["text"])


TRICKY = ["ünï 🙂 Token: 'abcdefghijkl' x", "secret=short password = longer_than_12x", "AKIA" + "A" * 14 + " AKIA12", "deadbeefdeadbeef" * 3,
          "api_key:apikey=0123456789abcdef0", "toKen \"x\" ſecret=abcdefghijklmnop", "passwd=" + "a" * 12 + "AKIA" + "9" * 20]


def test_tricky_texts():
    found = secrets.spans_in([t.encode() for t in TRICKY], secrets.novelty())
    for t, f in zip(TRICKY, found, strict=True):
        assert [(a, k, b) for a, b, k, _ in f if k != "novel"] == base_spans(t)


@pytest.mark.parametrize("far", [65, 5000])
def test_telling_word_far_before_on_the_line(far):
    value = "Zk3Qw9xV7mNp2LsT8rYbU4Hd"
    for text, want in (("auth " + ". " * (far // 2) + value, 1), ("auth\n" + ". " * (far // 2) + value, 0)):
        (found,) = secrets.spans_in([text.encode()], secrets.novelty())
        assert [(text[a:b], k) for a, b, k, _ in found] == [(value, "novel")] * want


def test_a_hex_run_inside_hides_no_key():
    value = "Zk3Qw9xV7mNp" + "0f3a9c5e7b1d2486" + "LsT8rYbU4HdG"
    (found,) = secrets.spans_in([f"auth: {value}".encode()], secrets.novelty())
    assert [(a, b, k) for a, b, k, _ in found] == [(6, 46, "novel"), (18, 34, "hex")]
    (found,) = secrets.spans_in([f"auth: {value[12:28]}x secret={value}".encode()], secrets.novelty())
    assert "novel" not in [k for a, _, k, _ in found if a >= 24]  # contained in the assignment


def test_novelty_tells_random_strings_from_names():
    yes = ["auth_value: Zk3Qw9xV7mNp2LsT8rYbU4Hd", "private key 'x9F2kLq8ZpW3vR7tYb1NcM5dGh0J'", "bearer q7Zt3Nw9Xk2Vb8Lm4Rp6Yc1Hd5Js0Gf"]
    no = ["auth_handler: authentication_provider_config2", "session key_name user_account_database_table1", "cookie aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1",
          "just a word Zk3Qw9xV7mNp2LsT8rYbU4Hd"]
    for texts, want in ((yes, 1), (no, 0)):
        found = secrets.spans_in([t.encode() for t in texts], secrets.novelty())
        assert [len([s for s in f if s[2] == "novel"]) for f in found] == [want] * len(texts)


def test_secrets_awkward_and_empty(spark):
    got = secrets.report(awkward(spark)).collect()
    assert len(got) == 11
    blank = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert all(r["base_sha256"] == blank and r["spans"] == "" and r["n_hex"] == 0 for r in got)
    assert secrets.report(empty(spark)).count() == 0


def test_licences_of_the_driver_table(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    want = {(d, line.rstrip(".")) for d, t in docs.items() for line in t.split("\n") if re.search(r"(?i)licen[sc]e", line)}
    got = {(r["doc_id"], docs[r["doc_id"]][r["start"]: r["end"]]) for r in queries.op5_licenses(spark, SF001).collect()}
    assert got == want and got


@pytest.fixture(scope="module")
def licence_model():
    return licenses.fit(["the reing of ander and thion was here", "for a while the thing is that of it"] * 20)


def test_licence_families_and_unknown(licence_model):
    texts = [("// Licensed under the Apache License, Version 2.0.", "Apache-2.0"), ("SPDX-License-Identifier: MIT", "MIT"),
             ("thion oner Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "MIT"),
             ("you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License", "LGPL"),
             ("Licensed under CC BY-NC 4.0.", "CC-BY-NC"), ("The license plate was obtained under a bridge", None), ("", None), ("MIT is a university", None),
             ("software of the person was granted a copy of files", None)]
    for t, family in texts:
        got = licenses.found_in(licence_model, [t.encode()])
        assert [g[3] for g in got] == ([family] if family else []), t


def test_templates_inside_a_long_line(licence_model):
    rng = random.Random(4)
    words = [rng.choice(["reing", "ander", "thion", "the", "was", "here", "whering", "that"]) for _ in range(5000)]
    assert licenses.found_in(licence_model, [" ".join(words).encode()]) == []
    for family, templates in licenses.TEMPLATES.items():
        for t in templates:
            at = rng.randrange(5000)
            text = " ".join([*words[:at], t, *words[at:]])
            got = licenses.found_in(licence_model, [text.encode()])
            place = text.index(t)
            assert [x[3] for x in got] == [family], (t, got)
            assert got[0][1] < place + len(t) and got[0][2] > place


def test_pruning_loses_no_paragraph(licence_model):
    lines = licenses.training_lines(["some thion words"], copies=4)[0]
    open_model = licence_model | {"least": 0}
    assert [licenses.found_in(licence_model, [x.encode()]) for x in lines] == [licenses.found_in(open_model, [x.encode()]) for x in lines]


def test_licences_awkward_and_empty(spark, licence_model):
    assert licenses.scan(awkward(spark), licence_model).count() == 0
    assert licenses.scan(empty(spark), licence_model).count() == 0
    assert queries.licenses.fit([])["b"].shape == (len(licenses.FAMILIES),)


@pytest.fixture(scope="module")
def crf():
    words = "alpha beta gamma delta epsilon the of and with thion reing oner whate shed. blean, esin".split()
    return html_crf.train(html_crf.labelled_pages(words))


def test_main_text_of_the_driver_pages(spark):
    import html

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()}
    got = queries.op8_html_crf(spark, SF001).collect()
    assert len(got) == len(pages)
    for r in got:
        body = re.search(r"<article>(.*?)(?:</article>|<footer)", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", body)]
        assert r["text"] == "\n\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


PARTS = [
    ("<p>First &amp; second&nbsp;word.<br>Third</p>", "First & second word. Third"), ("<script>var a = '<p>no</p>';</script>", ""),
    ("<style>p { x: y }</style>", ""), ("<!-- <p>hidden thion</p> -->", ""), ('<div class="ad">Buy reing now and oner.</div>', ""),
    ("<p>One <a href='#'>link</a> in prose of the thion text.</p>", "One link in prose of the thion text."),
    ('<aside><p>Related thion of the page here.</p></aside>', ""), ("<form><label>Your name</label><input></form>", ""),
    ("<p>Unclosed paragraph of words<p>and the next one of them", "Unclosed paragraph of words\n\nand the next one of them"),
]


def test_layout_not_among_the_training_pages(crf):
    page = ("<html><body><header><p>Site thion name</p></header><nav><a href='/'>Home</a> <a href='/x'>More</a></nav><article><h1>The Title</h1>"
            + "".join(p for p, _ in PARTS) + "</article><section class='comments'><p>Reader wrote this thion here.</p></section>"
            "<div class='cookie-banner'><p>We use cookies here and there.</p></div><footer>&copy; Someone</footer></body></html>")
    assert html_crf.main_text(crf, page) == "\n\n".join(["The Title", *(t for _, t in PARTS if t)])


def test_pages_without_an_article(crf):
    page = ("<body><div class='menu'><a href='#'>One</a><a href='#'>Two</a></div><div class='content'><h1>Oner whate</h1>"
            "<p>" + "thion reing of the whate and oner " * 8 + ".</p></div><div id='sidebar'><p>Beside the text.</p></div>"
            "<div class='footer'>&copy; All</div></body>")
    assert html_crf.main_text(crf, page).startswith("Oner whate\n\nthion reing") and "Beside" not in html_crf.main_text(crf, page)


@pytest.mark.parametrize("page", ["", "   ", "<", "<p", "<a href='x", "<!--", "<script>", "</p></div></article>", "<p>" * 500, "&#x110000; &bogus;", "<b><i>"])
def test_broken_pages(crf, page):
    assert isinstance(html_crf.main_text(crf, page), str)


_ARTICLE = "<article><h1>The Title</h1><p>" + "thion reing of the whate and oner " * 4 + ".</p></article>"


@pytest.mark.parametrize("head", ["<html><head><title>x</title><body>", "<head><meta charset=utf-8><script>'<body></head>'</script><title>x</title>",
                                  "<head><style>p {}</style><noscript><p>no</p></noscript><body class=a>", "<html><body><svg><path d='M0 0'>",
                                  "<body><canvas>", "<body><select>", "<body><object>", "<body><noscript>"])
def test_open_heads_and_skipped_elements(crf, head):
    want = html_crf.main_text(crf, "<html><head><title>x</title></head><body>" + _ARTICLE + "</body></html>")
    assert want.startswith("The Title\n\nthion")
    assert html_crf.main_text(crf, head + _ARTICLE + "</body></html>") == want


def test_math_is_text():
    page = "<article><p>so <math><mrow><mi>a</mi><mo>+</mo><mn>1</mn></mrow></math> holds</p><script>open"
    assert [b.text for b in html_crf.blocks_of(page)] == ["so a+1 holds"]


def test_viterbi_is_the_likeliest_path(crf):
    import itertools

    import numpy as np

    rng = np.random.default_rng(2)
    for _ in range(50):
        rows = [list(rng.choice(len(html_crf.FEATURES), 4, replace=False)) for _ in range(6)]
        emit = [crf["emit"][r].sum(0) for r in rows]
        value = lambda s: sum(e[i] for e, i in zip(emit, s)) + sum(crf["move"][a, b] for a, b in zip(s, s[1:]))
        assert abs(value(html_crf.viterbi(crf, rows)) - max(map(value, itertools.product((0, 1), repeat=6)))) < 1e-9


def test_pages_awkward_and_empty(spark, crf):
    pages = spark.createDataFrame([(1, "u", None), (1, "u", None), (None, None, "<article><p>Words of the thion text.</p></article>"), (2, None, "")],
                                  "page_id long, url string, html string")
    got = [(r["page_id"], r["text"], r["n_chars"]) for r in html_crf.extract(pages.withColumn("text", pages["html"]), crf).collect()]
    assert sorted(got, key=str) == sorted([(1, "", 0), (1, "", 0), (None, "Words of the thion text.", 24), (2, "", 0)], key=str)
    assert html_crf.extract(pages.limit(0), html_crf.fit(pages.limit(0))).count() == 0


def test_many_findings_take_linear_time():
    import time
    t = time.time()
    text = " ".join(f'token = "{i:032x}Zk9{i:020d}"' for i in range(30_000)).encode()
    found = secrets.spans_in([text], secrets.novelty())[0]
    assert time.time() - t < 60 and sum(x[2] == "assign" for x in found) == 30_000


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "x", "<a " * 300_000, "<p>a</p>" * 100_000, '<p title="' * 50_000, "<x" + "y" * 100 + ">" + "<b>z</b>" * 50_000])
def test_degenerate_pages_take_linear_time(page):
    import time
    t = time.time()
    html_crf.features(html_crf.blocks_of(page))
    assert time.time() - t < 20


def test_an_open_quote_ends_with_its_tag():
    assert [b.text for b in html_crf.blocks_of('<div>one</div><p title="x>two</p><p>three</p>')] == ["one", "two", "three"]
    assert [b.text for b in html_crf.blocks_of("a <b c='>'>d</b> e <f")] == ["a d e <f"]


def test_every_statement_of_a_long_line_is_reported(licence_model):
    rng = np.random.default_rng(3)
    filler = lambda n: " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 7)) for _ in range(n))
    mit = next(t for t in licenses.TEMPLATES["MIT"] if 6 <= len(t.split()) <= 40)
    line = " ".join(f"{filler(80)} {mit}" for _ in range(40)) + " " + filler(80)
    got = [f for f in licenses.found_in(licence_model, [line.encode()]) if f[3] == "MIT"]
    assert len(got) == 40
    assert all(b[1] >= a[2] for a, b in zip(got, got[1:]))
