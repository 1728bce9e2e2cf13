"""Language, quality, licences, HTML and token counts against brute force and held-out labels."""

import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dugout.llm import html_text, language, licenses, quality, queries, token_counts

BYTES = queries.vocabulary("byte_bpe_50k.json")
WORD = r"[^\x20\x09-\x0D]+"


def test_language_on_held_out_documents(spark, small):
    rows = queries.op2_language_id(spark, small).toPandas()
    truth = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang").toPandas()
    both = rows.merge(truth, on="doc_id")
    held = both[both["held_out"]]
    assert len(rows) == len(truth) and len(held)
    assert (held["lang_pred"] == held["lang"]).mean() > 0.95
    assert rows["score"].between(0, 1).all()


def test_language_never_sees_labels_of_a_prediction(spark, documents):
    model = language.fit(documents)
    blind = documents.select(F.lit(5).cast("long").alias("doc_id"), "text", F.lit("xx").alias("lang"))
    texts = [r["text"] for r in blind.limit(20).collect()]
    assert model.predict(texts) == [(r["lang_pred"], r["score"], r["rejected"]) for r in language.identify(blind.limit(20), model).collect()]


def test_language_odd_rows(spark, odd, none):
    got = {(r["doc_id"], r["lang_pred"], r["rejected"]) for r in language.identify(odd).collect()}
    assert {(3, "und", True), (4, "und", True), (7, "und", True)} <= got
    assert language.identify(none).count() == 0 and language.keep(none).columns == none.columns
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.identify(unlabelled).collect()} == {"und"}
    kept = language.keep(odd)
    assert kept.columns == odd.columns and {r["size"] for r in kept.collect()} == {"size"}


def test_language_rejects_other_scripts(documents):
    model = language.fit(documents)
    far = model.predict(["Съешь ещё этих мягких французских булок, да выпей же чаю " * 20, "12 !!", None])
    assert [r for _, _, r in far] == [True, True, True]
    assert far[1][:2] == far[2][:2] == ("und", 0.0)


@pytest.mark.parametrize(("text", "letters"), [("🙂🙂 👍", False), ("\u0301\u0308 1", False), ("𝒜𝒷", True), ("𐌰𐌱", True), ("a\u0301", True)])
def test_letters_on_all_planes(text, letters):
    assert (language.ngram_counts(text) is not None) == letters


def test_language_clusters_have_members(documents):
    settings = language.Settings()
    model = language.fit(documents, settings)
    rng = np.random.default_rng(1)
    x = language._unit(np.abs(rng.normal(size=(256, 40))) + 5 * np.eye(4)[rng.integers(4, size=256)].repeat(10, axis=1))
    x[:3] = language._unit(np.eye(40)[:3])
    centers = language._cluster(x, 4, settings.rounds, settings.least_share, rng)
    sizes = np.bincount((x @ centers.T).argmax(axis=1))
    assert len(sizes) > 1 and sizes.min() >= settings.least_share * 256 / 4 - 1
    assert len(set(model.of.tolist())) == len(model.langs) and len(model.of) > len(model.langs)


def counts_by_hand(text):
    words = re.findall(WORD, text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    found, inside, seen, lines = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if found[w] > 1:
            inside.update(range(i, i + 5))
    for line in text.split("\n"):
        if re.search(WORD, line):
            lines += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(inside)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c d", "\n", " ", "x\x1cy", "#", "é|", "a b c d e f ", "\t", "\x85"]), max_size=40))
def test_quality_counts(parts):
    text = "".join(parts)
    assert quality.base_counts(text, text.encode().split()) == counts_by_hand(text)


def test_quality_query(spark, small):
    rows = queries.op6_divergence_rules(spark, small).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        n = counts_by_hand(texts[r["doc_id"]] or "")
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == n
        assert r["base_failed"] == (n[0] < 10 or 100 * n[4] > 20 * n[0])
        assert not (r["base_failed"] and r["kept"])
    clean = [r for r in rows if not r["base_failed"] and r["n_symbols"] == 0 and not re.search("[A-Z]{2}", texts[r["doc_id"]])]
    assert sum(r["kept"] for r in clean) >= 0.99 * len(clean)


def test_quality_references_are_whole_counts(documents):
    rows = quality.references(documents, quality.Rules(common_words=5)).collect()
    words, classes = {}, Counter()
    for r in documents.collect():
        words.setdefault(r["lang"], Counter()).update((r["text"] or "").lower().encode().split())
        classes[r["lang"]] += len(r["text"] or "")
    for lang, found in words.items():
        mine = {r["item"]: r["n"] for r in rows if r["lang"] == lang and r["kind"] == "word"}
        assert mine.pop("") == sum(found.values())
        assert sorted(mine.values(), reverse=True) == [n for _, n in found.most_common(5)]
        assert sum(r["n"] for r in rows if r["lang"] == lang and r["kind"] == "class") == classes[lang]


def test_jensen_shannon_bounds():
    p, q = np.array([1.0, 0.0]), np.array([[0.0, 1.0], [1.0, 0.0]])
    assert quality.distance(p, q) == pytest.approx([1.0, 0.0])


def test_quality_references_read_texts_once_in_small_runs(documents, monkeypatch):
    plan = quality.references(documents)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_count(") == 1
    monkeypatch.setattr(quality, "HELD", 3)
    monkeypatch.setattr(quality, "ROWS", 2)
    texts = ["one two", "two", None, "three one one", "four", "", "five six"]
    batch = pa.RecordBatch.from_pydict({"lang": pa.array(["a", "b", "a", None, "a", "b", "a"]), "text": pa.array(texts)})
    parts = [p.to_pylist() for p in quality._count(iter([batch]))]
    found = Counter()
    for row in (r for p in parts for r in p if r["kind"] == "word"):
        found[row["lang"], row["item"]] += row["n"]
    assert max(map(len, parts)) < len(quality.CLASSES) + 6 and len(parts) > 3
    assert found[None, "one"] == 2 and found["a", ""] == 5 and found["b", "two"] == 1


def test_quality_rejects_symbols_and_capitals(spark, documents):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in documents.where("lang = 'en' and length(text) > 1000").collect()]
    bad = [(10**6 + i, " ".join(w + "&&&" for w in t.split()), x) for i, t, x in rows[:2]]
    bad += [(2 * 10**6 + i, " ".join(w.upper() + "!!" for w in t.split()), x) for i, t, x in rows[5:7]]
    df = spark.createDataFrame(rows + bad, "doc_id long, text string, lang string")
    assert not {r["doc_id"] for r in quality.judge(df).where("kept").collect()} & {b[0] for b in bad}


def test_quality_odd_rows(odd, none):
    got = quality.judge(odd).collect()
    assert len(got) == odd.count()
    assert all(r["base_failed"] for r in got if r["doc_id"] in (3, 4, 7, 8))
    assert quality.judge(none).count() == 0
    assert quality.keep(odd).columns == odd.columns


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab the'sllé中😀12 !\n\t\x00\x85 .ABing ", max_size=60), st.integers(3, 40))
def test_token_counts_like_the_library(text, chunk):
    from tokenizers import Tokenizer

    library = test_token_counts_like_the_library.__dict__.setdefault("library", Tokenizer.from_file(BYTES))
    old, token_counts.CHUNK = token_counts.CHUNK, chunk
    try:
        assert token_counts.counter(BYTES).count(text) == len(library.encode(text, add_special_tokens=False).ids)
    finally:
        token_counts.CHUNK = old


def test_token_counts_query(spark, small):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    rows = {r["doc_id"]: r for r in queries.op9_token_counts(spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        text = d["text"] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        r = rows[d["doc_id"]]
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 512)


def test_state_maps_compose_in_any_grouping():
    machine = token_counts.counter(BYTES)
    text = "One fine day,  in the middle of the night\n\n two  dead boys' stood up to fight " * 30
    maps = [machine.chunk(text[i : i + 37]) for i in range(0, len(text), 37)]
    left = maps[0]
    for m in maps[1:]:
        left = machine.join(left, m)
    right = maps[-1]
    for m in reversed(maps[:-1]):
        right = machine.join(m, right)
    ends = {machine.plain(m.head) + m.tokens + machine.plain(m.tail or "") for m in (left, right)}
    assert ends == {machine.plain(text)}


def test_token_counts_odd_rows(odd, none):
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(odd, BYTES).collect()}
    assert got[3] == got[4] == 0 and got[5] > 30000
    assert token_counts.token_counts(none, BYTES).count() == 0
    wide = token_counts.token_counts(odd, BYTES, columns=odd.columns)
    assert dict(wide.dtypes)["n_tokens"] == "bigint" and wide.count() == odd.count()


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><a href="/x">X</a></nav><!-- ad --><div class="ad">Buy</div><article><h1>Head &amp; line</h1><p><b>First <i>para</i>graph
 goes<br>on.</b><p>Second &lt;one&gt; &nbsp; here.</p><aside>Side</aside><form><p>Mail</p></form>
<section class="reader-comments"><p>I object</p></section><ul><li>point<li>other</ul></article><footer>&copy; me</footer>"""


def test_main_text_of_an_article():
    want = "Head & line\n\nFirst paragraph goes on.\n\nSecond <one> here.\n\npoint\n\nother"
    assert html_text.main_text(PAGE) == want


def test_main_text_without_an_article():
    body = "<p>" + "Long text of the page, which goes on for a while. " * 3 + "</p>"
    menu = "".join(f'<div><a href="{i}">Menu item {i}</a></div>' for i in range(6))
    page = f"<body>{menu}<h1>Title</h1>{body}{body}<div id='sidebar'>{body}</div>{menu}</body>"
    got = html_text.main_text(page)
    assert got.count("Long text") == 6 and "Menu" not in got and got.startswith("Title")


SOME = "Some text of the page, which goes on for a while and says a thing or two. "


def test_main_text_of_several_regions():
    nested = f"<main><h1>T</h1><p>lead</p><article><p>{SOME * 3}</p></article></main>"
    assert html_text.main_text(nested).split("\n\n") == ["T", "lead", (SOME * 3).strip()]
    posts = "".join(f"<article><h2>{i}</h2><p>{SOME * i}</p></article>" for i in (1, 9, 2))
    got = html_text.main_text(f"<body><nav>N</nav>{posts}<aside><article>{SOME}</article></aside></body>")
    assert got.count("Some text") == 12 and got.startswith("1\n\n")
    teaser = "<article><h3>Teaser</h3><p>Short.</p></article>"
    assert html_text.main_text(f"<body><div><p>{SOME * 5}</p><p>{SOME * 5}</p></div>{teaser}</body>").count("Some text") == 10
    comment = f"<article><p>{SOME}</p><article class='comment'><p>I object</p></article></article>"
    assert html_text.main_text(comment) == SOME.strip()


def test_main_text_of_sections():
    section = "<div><div><h2>Head {0}</h2></div><div><p>Short {0}.</p></div></div><div><div class='ad'><p>Buy</p></div></div>"
    long = f"<div><h2>Long</h2><blockquote><p>{SOME * 20}</p></blockquote></div>"
    links = "<ul>" + "".join(f'<li><a href="{i}">Link number {i}</a></li>' for i in range(5)) + "</ul>"
    table = "<table>" + "".join(f"<tr><td>cell</td><td>{i}</td></tr>" for i in range(4)) + "</table>"
    parts = section.format(1) + section.format(2) + long + links + section.format(3) + table + "<div><p>The end.</p></div>"
    want = ["Head 1", "Short 1.", "Head 2", "Short 2.", "Long", (SOME * 20).strip(), "Head 3", "Short 3."]
    want += [x for i in range(4) for x in ("cell", str(i))] + ["The end."]
    assert html_text.main_text(f"<body>{links}<div>{parts}</div>{links}</body>").split("\n\n") == want
    flat = f"<body>{links}<h1>T</h1><p>{SOME * 9}</p>{links}<p>The end.</p>{links}<div>Made by us</div></body>"
    assert html_text.main_text(flat).split("\n\n") == ["T", (SOME * 9).strip(), "The end."]


@pytest.mark.parametrize("attrs", ["div class='content has-sidebar'", "div id='page' class='no-sidebar'", "div class=with-banner", "div class='content-sidebar-wrap'", "form", "div class='search'"])
def test_wrappers_are_not_asides(attrs):
    name = attrs.split()[0]
    for text in (f"<p>{SOME * 9}</p>", f"<article><p>{SOME * 9}</p></article>"):
        page = f"<body><{attrs}>{text}<div class='sidebar-left'>Side</div><div id=comments><p>{SOME * 99}</p></div></{name}></body>"
        assert html_text.main_text(page) == (SOME * 9).strip()


def test_named_parts_of_an_article():
    parts = "".join(f"<div class='{c}'><p>{c}</p></div>" for c in ("article-header", "legal-text", "notice", "tags"))
    page = f"<body><div class='notice'>Note</div><article>{parts}<p>{SOME}</p><div class='share'>Share</div></article></body>"
    assert html_text.main_text(page) == "\n\n".join(["article-header", "legal-text", "notice", "tags", SOME.strip()])


@pytest.mark.parametrize("tag", ["<svg class='icon'/>", "<iframe src='x' />", "<math/>"])
def test_self_closed_elements_are_empty(tag):
    assert html_text.main_text(f"<article><p>One {tag} two</p><p>Three</p></article>") == "One two\n\nThree"


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<!-- open", "<script>x", "<a href='", "</p></p>", "&am", "<p>&#x41;"])
def test_broken_pages(page):
    assert html_text.main_text(page) in ("", "A", "&am", "<")


@pytest.mark.parametrize("attrs", ['class="byline"', 'class="related-work"', 'id="comments-on-the-method"', 'class="search-results"'])
def test_names_of_article_parts_lose_nothing(attrs):
    page = f"<article><h1>Title</h1><p>{'Long text here. ' * 20}</p><section {attrs}><p>Part</p></section></article>"
    assert html_text.main_text(page).endswith("\n\nPart")


@pytest.mark.parametrize("name", ["comments", "ad", "share-box", "related"])
def test_asides_of_articles_go(name):
    page = f"<article><h1>Title</h1><p>{'Long text here. ' * 20}</p><div class='{name}'><p>Part</p></div></article>"
    assert "Part" not in html_text.main_text(page)


@pytest.mark.parametrize("part", ["<b>x", "<div>x", "<p>a<a href=x>y", "<li>x</b>", "<article><p>x"])
def test_long_pages_take_linear_time(part):
    start = time.monotonic()
    html_text.main_text(part * 20_000)
    assert time.monotonic() - start < 10


def test_html_odd_tables(spark):
    page = f"<article><p>{'Some words. ' * 30}</p></article>"
    rows = [(1, "u", page, "kept", "c"), (1, "u", page, "kept", "c"), (None, None, page, None, None), (2, "v", None, None, "c"), (3, "w", "", "x", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, _c0 string").repartition(2)
    got = sorted(html_text.extract(pages).collect(), key=str)
    text = ("Some words. " * 30).strip()
    expected = [(r[0], r[1], text if r[2] == page else "", len(text) if r[2] == page else 0) for r in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    assert html_text.extract(pages, ("_c0", "url")).columns == ["_c0", "url", "text", "n_chars"]
    assert html_text.extract(pages.filter("false")).count() == 0


def test_html_query(spark, small):
    rows = queries.op4_html_main_text(spark, small).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*?)(</article>|\Z)", pages[r["page_id"]], re.S)[1]
        blocks = (re.sub(r"<[^>]*>", "", b.replace("<br>", " ")) for b in re.split(r"</?(?:p|h1)>", inner))
        import html

        blocks = (re.sub(r"\s+", " ", html.unescape(b)).strip() for b in blocks)
        assert r["text"] == "\n\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


def test_licence_variants(spark):
    mit, isc = licenses.LICENSES["MIT"], licenses.LICENSES["ISC"]
    rows = [
        (1, mit),
        (2, "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(",", " ,").replace("\n", " ")),
        (3, "/* " + isc.replace('"AS IS"', "“as is”") + " */"),
        (4, mit + "\nand more"),
        (5, mit.replace("sublicense", "sub-license").replace("Software", "SOFTWARE")),
        (6, "Text. Licensed under the Apache Licence, version 2.0. More text\nALL RIGHTS RESERVED"),
        (7, None),
        (8, "...\n"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["license_id"], r["notices"]) for r in licenses.scan(df).collect()}
    assert [got[i][0] for i in range(1, 6)] == ["MIT", "MIT", "ISC", None, "MIT"]
    assert got[6] == (None, "All-Rights-Reserved Apache-2.0")
    assert got[7] == got[8] == (None, "")


def test_whole_licences_and_notices_that_wrap(spark):
    whole = dict(reversed(licenses.texts()))
    apache = """/* Copyright 2020 Someone
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 */"""
    gpl = "# This program is free software: you can redistribute it and/or modify it\n# under the terms of the GNU General Public\n"
    gpl += "# License as published by the Free Software Foundation, either version 3 of the License, or later."
    rows = [(name, text) for name, text in whole.items()] + [
        ("cut", whole["Apache-2.0"].split("APPENDIX")[0]),
        ("wraps", "A text.\nReleased under\nthe MIT\nLicense. More"),
        ("apache", apache),
        ("gpl", gpl),
        ("mpl", "This is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of it"),
        ("spaced", "Released under the" + " " * 900 + "MIT License."),
    ]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "EPL-1.0", "Unlicense", "CC0-1.0"} <= set(whole)
    assert all(got[name]["license_id"] == name for name in whole) and got["cut"]["license_id"] == "Apache-2.0"
    assert [got[x]["notices"] for x in ("wraps", "apache", "gpl", "mpl", "spaced")] == ["MIT", "Apache-2.0", "GPL-3.0", "MPL-2.0", "MIT"]


def test_licence_odd_rows(odd, none):
    got = licenses.scan(odd, ("doc_id", "digest", "size"))
    assert got.count() == odd.count() and got.columns == ["doc_id", "size", "digest", "license_id", "notices"]
    assert licenses.scan(none).count() == 0
