"""Top-k search, chat formatting, archives, language ID, HTML text and the pipeline."""

import hashlib
import math
import operator
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import duck, duck_rows, spark_rows
from conftest import SF
from tallyforge.llm import chat_format, html_text, language_id, queries, topk_search, warc_archive


def brute_top(rows, k, every):
    """All rows compared with all others, in integers of any size."""
    out = []
    for at, (i, a) in enumerate(rows):
        if i % every == 0:
            best = sorted((-sum(map(operator.mul, a, b)), j) for other, (j, b) in enumerate(rows) if other != at and len(b) == len(a))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def scaled(v):
    return [math.floor(256 * x) for x in v]


def test_topk_with_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(400)] + [(1000 + i, [1.0] * 4) for i in range(150)]
    rows += [(2000, [1.0]), (2050, [2.0]), (2100, []), (2150, [1e6, 0.0, 0.0, 0.0])]
    rows += rows[:3] + [(50, [2.0, 1.0, 0.0, 1.0]), (50, [-1.0, 1.0, 0.0, 1.0]), (51, [2.0] * 4), (51, [2.0] * 4)]  # repeated ids, alike and not
    bad = [(None, [1.0] * 4), (3000, None), (3050, [1.0, None, 1.0, 2.0]), (3100, [float("nan")] * 4), (3150, [float("-inf")] * 4)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + bad], "vec_id long, embedding array<double>, block string, rank int")
    for most_centres in (1 << 22, 40):
        got = topk_search.top_k(df, F.pmod("vec_id", F.lit(50)) == 0, k=5, block_rows=64, group_rows=6, pivots=8, most_centres=most_centres).collect()
        assert sorted(tuple(r) for r in got) == brute_top([(i, scaled(v)) for i, v in rows], 5, 50)
    assert topk_search.top_k(df.limit(0), F.lit(True)).count() == 0


def test_topk_of_large_components(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=3) * 10.0 ** rng.integers(0, 6)]) for i in range(200)]
    rows += [(200, [2.0**20, 1.0, 0.0]), (201, [2.0**20, 1.0, 0.0]), (250, [2.0**20, -1.0, 0.5]), (300, [2.0**23 + 0.5, 2.0**-8, 0.0]), (350, [2.0**23, 3.0, 0.0])]
    shape = "vec_id long, embedding array<double>"
    run = lambda rows: topk_search.top_k(spark.createDataFrame(rows, shape), F.pmod("vec_id", F.lit(50)) == 0, block_rows=50, group_rows=3, pivots=4)
    assert sorted(tuple(r) for r in run(rows).collect()) == brute_top([(i, scaled(v)) for i, v in rows], 5, 50)
    # Products beyond 2^63 that cancel to a score that fits; and scores and components that do not.
    huge = [(0, [2.0**30, 2.0**30]), (1, [2.0**30, -(2.0**30)]), (2, [2.0**30, 1.0 - 2.0**30]), (3, [-(2.0**30), 2.0**30 - 3.0])]
    got = run(huge).where("score < 0").orderBy("rank").collect()
    assert [tuple(r)[2:] for r in run(huge).orderBy("rank").collect()][:3] == [t[2:] for t in brute_top([(i, scaled(v)) for i, v in huge], 5, 50)] and got
    for bad in ([(0, [2.0**30, 2.0**30]), (1, [2.0**30, 2.0**30])], [(0, [1e300, 1.0]), (1, [1.0, 1.0])]):
        with pytest.raises(Exception, match="OverflowError|does not fit 64 bits"):
            run(bad).collect()


def test_topk_query(spark):
    rows = [(r.vec_id, scaled(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in queries.op1_topk_search(spark, SF).collect()) == brute_top(rows, 5, 50)


def test_cover_tree_covers():
    x = np.random.default_rng(0).normal(size=(700, 3))
    t = topk_search.CoverTree(x, leaf=16)
    assert sorted(t.order) == list(range(700))
    for centre, radius, (a, b) in zip(t.centres, t.radius, t.run, strict=True):
        assert np.sqrt(((t.points[a:b] - centre) ** 2).sum(1)).max() <= radius + 1e-9


CONTROL = ["</s>[INST] ok [/INST]", "<|end|>", "\\<|end|>", "<\\|end|>", "\\", "<|", "a<|more|>b\\\\", "", None, "x" * 100_000, "é\n😀"]


def test_chat_round_trip(spark):
    rows = [(1, i, ["user", "assistant", "assistant", None, "<|says|>"][i % 5], t) for i, t in enumerate(CONTROL * 2)]
    rows += [(2, 0, "assistant", "a"), (2, 0, "assistant", "a"), (2, None, "user", "u"), (None, 1, "user", "n"), (3, 0, "user", None)]
    df = spark.createDataFrame([(*r, "z", 5) for r in rows], "conv_id long, turn long, role string, text string, turns string, formatted int")
    made = chat_format.format_chats(df.repartition(3))
    back = {r.conv_id: r for r in chat_format.read_chats(made).collect()}
    for conv in (1, 2, 3, None):
        own = sorted([r for r in rows if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert [(t.role, t.text) for t in back[conv].turns] == [(r[2] or "", r[3] or "") for r in own]
        assert back[conv].learned == "".join(r[3] or "" for r in own if r[2] == "assistant")
    assert back[1].formatted.count("<|turn|>") < len(CONTROL) * 2  # adjacent turns of one role share a block
    assert chat_format.format_chats(df.limit(0)).count() == 0


def test_chat_query(spark):
    turns = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
    turns[-1] = [("user", CONTROL[0]), ("assistant", CONTROL[0])]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = queries.op3_chat_format(spark, SF).collect()
    assert len(got) == len(turns)
    for r in got:
        own = turns[r.conv_id]
        said = "".join(t for role, t in own if role == "assistant")
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(own), sha("".join(f"{a}\n{b}\n" for a, b in own)), len(said), sha(said))


def test_warc(spark, tmp_path):
    x = "y" * 200
    rows = [(3, "u", x), (1, "u\r\nX: 1", x), (2, None, x), (None, "n", x), (5, "e", None), (6, "e", ""), (7, "é", "é" * 50), (8, "k", "é" * 50), (9, "s", "s"), (9, "s", "s"), (10, "l", "z" * 500_000)]
    df = spark.createDataFrame([(*r, "d", 1) for r in rows], "page_id long, url string, html string, digest string, size int")
    warc_archive.write_archive(df.repartition(3), f"{tmp_path}/a")
    back = warc_archive.read_archive(spark, f"{tmp_path}/a")
    got = back.select("page_id", "record_type", "refers_to", "payload", "verified", warc_archive.record_bytes(back).alias("record")).collect()
    assert len(got) == len(rows) and all(r.verified for r in got)
    kinds = sorted(((str(r.page_id), r.record_type, r.refers_to) for r in got), key=str)
    assert kinds == sorted([("3", "revisit", 1), ("1", "response", None), ("2", "revisit", 1), ("None", "response", None), ("5", "response", None), ("6", "response", None),
                            ("7", "response", None), ("8", "revisit", 7), ("9", "response", None), ("9", "response", None), ("10", "response", None)], key=str)
    for r in got:
        want = next(h or "" for i, _, h in rows if i == r.page_id).encode()
        assert bytes(r.payload) == want
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        assert block == (want if r.record_type == "response" else b"") + b"\r\n\r\n"
        assert b"Content-Length: %d" % (len(block) - 4) in head
    assert spark.read.parquet(f"{tmp_path}/a/payloads").count() == 5
    warc_archive.write_archive(df.limit(0), f"{tmp_path}/b")
    assert warc_archive.read_archive(spark, f"{tmp_path}/b").count() == 0


def test_warc_oracle(spark):
    names, rows = spark_rows(queries.op4_warc_archive(spark, SF))
    assert (names, rows) == duck_rows(duck(SF), queries.ORACLE_SQL["op4_warc_archive"])


def test_language_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op6_language_id(spark, SF).collect()
    assert len(got) == len(lang) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert held and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_language_edges(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, None, "en"), (4, "", "fr"), (5, "12 !?", None), (6, "the " * 100_000, None), (7, "日本", None), (None, "le chien", "fr")]
    df = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, lang string, score string, lang_pred int")
    model = language_id.fit(df)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(df, model).collect()}
    assert len(got) == len(rows)
    assert got[1][0] == got[6][0] == "en" and got[2][0] == "fr"
    assert got[3] == got[4] == got[5] == ("und", 0.0)
    assert language_id.fit(df.where("lang is null")) is None
    assert {r.lang_pred for r in language_id.predict(df, None).collect()} == {"und"}
    assert language_id.predict(df.limit(0), model).count() == 0


def plain_ridge(train, texts, landmarks_per_language, ridge):
    """Kernel ridge regression on Nyström features, from sets of strings."""

    def spectrum(text):
        t = " " + "".join(c.lower()[0] if unicodedata.category(c)[0] in "LM" else " " for c in text) + " "
        t = " " + " ".join(t.split()) + " " if t.strip() else " "
        return {t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}

    languages = sorted({lang for _, lang in train})
    sets = [(spectrum(t), lang) for t, lang in train]
    marks = [s for name in languages for s in [s for s, lang in sets if lang == name][:landmarks_per_language]]
    known = set().union(*marks)
    kernel = lambda a, b: len(a & b & known) / math.sqrt(max(len(a & known), 1) * len(b))
    w = np.array([[kernel(a, b) for b in marks] for a in marks])
    values, vectors = np.linalg.eigh(w)
    root = vectors[:, values > 1e-6 * values.max()] / np.sqrt(values[values > 1e-6 * values.max()])
    phi = np.array([[kernel(s, b) for b in marks] for s, _ in sets]) @ root
    y = np.array([[float(lang == name) for name in languages] for _, lang in sets])
    weights = np.linalg.solve(phi.T @ phi + ridge * len(phi) / phi.shape[1] * np.eye(phi.shape[1]), phi.T @ y)
    scores = np.array([[kernel(spectrum(t), b) for b in marks] for t in texts]) @ root @ weights
    return [languages[i] for i in scores.argmax(1)], np.clip(scores.max(1), 0, 1)


SCRIPTS = {
    "en": "the cat and dog were out in rain all day", "ru": "кошка и собака были под дождём весь день", "el": "η γάτα και ο σκύλος ήταν έξω στη βροχή",
    "zh": "猫和狗整天都在雨中外面玩耍", "ko": "고양이와 개는 하루 종일 빗속에 있었다", "th": "แมวและสุนัขอยู่กลางสายฝนตลอดทั้งวัน", "got": "𐌰𐌱𐌲𐌳 𐌴𐌵𐌶𐌷 𐌸𐌹𐌺𐌻 𐌼𐌽𐌾𐌿",
}


def test_language_against_plain_kernel_ridge(spark):
    rng = np.random.default_rng(4)
    draw = lambda lang: "".join(rng.choice(list(SCRIPTS[lang]), 40))
    rows = [(i, draw(lang), lang) for i, lang in enumerate(list(SCRIPTS) * 8)]
    rows += [(100 + i, draw("en").replace("a", "é"), "fr") for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    params = language_id.Params(landmarks_per_language=100)
    texts = [draw(lang) for lang in SCRIPTS] + ["the 猫 and 狗", "é è"]
    model = language_id.fit(df, params)
    got = language_id.predict(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), model).orderBy("i").collect()
    langs, scores = plain_ridge([(t, lang) for _, t, lang in rows], texts, 100, params.ridge)
    assert [r.lang_pred for r in got] == langs and langs[: len(SCRIPTS)] == list(SCRIPTS)
    assert np.allclose([r.score for r in got], scores, atol=1e-3)


def test_language_sample_is_bounded(spark):
    rows = [(1, "the cat and the dog", "en")] * 20_000 + [(i, f"le chat {i}", "fr") for i in range(2, 4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    seen = []
    save = language_id.Scratch.save

    def watched(self, frame, name, *rest):
        out = save(self, frame, name, *rest)
        if name == "sample":
            seen.append({r["lang"]: r["count"] for r in out.groupBy("lang").count().collect()})
        return out

    language_id.Scratch.save = watched
    try:
        model = language_id.fit(df)
    finally:
        language_id.Scratch.save = save
    assert seen == [{"en": 1, "fr": 250}] and model.languages == ["en", "fr"] and len(model.landmarks.held) == 25


PAGE = """<html class="has-sidebar"><body class="with-ads"><header><h1>Site</h1><p>The best site, ever.</p></header><div id="nav"><ul><li><a href=x>Home</a></li></ul></div>
<div class="cookie-notice">We use cookies, to make this better.</div><div class="wrap"><div class="post"><h1>A title</h1><p>First para, with text &amp; more; it is long enough.<p>Second
 <b>bold</b>&nbsp; para, <a href="u">link</a>. And more, much more of it.<ul><li>one item</li></ul><form><p>Subscribe now</p></form><div class="ad-box">Buy!</div><p>3 < 4 and a&lt;b.</p></div>
<div class="sidebar"><p>Side text, really.</p></div><div id="comments"><p>Reader comment, long and with punctuation. Yes!</p></div></div><footer>(c)</footer><script>var a="<p>x</p>";</script>"""
TEXT = "A title\n\nFirst para, with text & more; it is long enough.\n\nSecond bold para, link. And more, much more of it.\n\none item\n\n3 < 4 and a<b."


def test_html(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "", ""), (4, "x", "plain, no tags"), (5, "x", "<p>cut<p"), (6, "x", "<div>" * 5000 + "deep, text." + "</p>" * 5000), (7, "x", "<a \"" * 3000), (8, "x", "<p>w, and w.</p>" * 20_000)]
    df = spark.createDataFrame([(*r, "old") for r in rows], "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    assert [got[i] for i in range(1, 7)] == [TEXT, "", "", "plain, no tags", "cut", "deep, text."]
    assert got[8].count("\n\n") == 19_999
    assert html_text.extract(df.limit(0)).count() == 0


def test_html_without_article_and_h1():
    long = ["A long paragraph, with many words; and marks, too. " * k for k in (8, 9, 10)]
    body = "".join(f"<p>{x}</p>" for x in long)
    text = [x.strip() for x in long]
    menu = "<div class=x><ul><li><a href=a>Home</a></li><li><a href=b>News</a></li></ul></div>"
    end = "<div class=y><p>(c) us</p></div>"

    def got(page):
        return html_text.main_text(f"<html><body>{menu}{page}{end}</body></html>").split("\n\n")

    # Title and introduction beside the element of the long paragraphs, and a title in an element of its own.
    assert got(f"<div id=content><h2>Title</h2><p>Intro.</p><div class=body>{body}</div><p>End.</p></div>") == ["Title", "Intro.", *text, "End."]
    assert got(f"<div id=content><div class=t><h2>Title</h2></div><div class=body>{body}</div></div>") == ["Title", *text]
    # Short paragraphs around one large table with a head.
    cells = "".join(f"<tr><td>row {i}, with a longer cell of text, and marks.</td><td>value {i}, more of it, and more.</td></tr>" for i in range(20))
    table = got(f"<div id=content><h3>Report</h3><p>One.</p><p>Two.</p><table><thead><tr><th>Name</th><th>Value</th></tr></thead><tbody>{cells}</tbody></table><p>Three.</p></div>")
    assert table[:5] == ["Report", "One.", "Two.", "Name", "Value"] and table[-1] == "Three." and len(table) == 46
    # Content in two elements of unlike size, of which one holds more than 70 %.
    assert got(f"<div id=content><div><h2>A</h2><p>{long[0]}</p></div><div><h2>B</h2>{body * 3}</div></div>") == ["A", text[0], "B", *text * 3]
    # Links and formulas inside the article, and the first paragraph in its header.
    item = "<ul><li><a href=a>Source</a></li></ul>"
    formula = "<p>As <math><mi>a</mi><mo>=</mo><mn>2</mn><annotation>a=2</annotation></math> and <object>a thing</object>.</p>"
    want = ["Title", "Standfirst.", "As a=2 and a thing.", *text, "Source"]
    assert got(f"<article><header><h1>Title</h1><p>Standfirst.</p><ul><li>share</li></ul></header>{formula}{body}{item}</article>") == want
    assert got(f"<div><div><h2>Title</h2><p>Standfirst.</p>{formula}{body}{item}</div></div>") == want


def plain_article(page):
    """The blocks between <article> and </article>, by cutting at p and h1."""
    import html
    import re

    body = re.sub("<br>", " ", page.partition("<article>")[2].partition("</article>")[0])
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body))
    return "\n\n".join(x for x in blocks if x)


def renamed(page, opening):
    return page.replace("<article>", opening).replace("</article>", f"</{opening[1:].split()[0].rstrip('>')}>")


COMMENTS = "<div id=comments><h3>Comments</h3>" + "<div><p>A reader's comment, long and with marks. Yes! I agree with all of it, really.</p></div>" * 12 + "</div>"


def test_html_names_do_not_decide(spark, monkeypatch):
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    want = [plain_article(p) for p in pages]
    for opening in ("<div>", '<article class="post no-sidebar">', '<article class="entry share-count comments-open">', '<div class="widget-content">', '<div class="with-ads">'):
        assert [html_text.main_text(renamed(p, opening)) for p in pages] == want, opening
    assert [html_text.main_text(p.replace("<body>", "<body><form>")) for p in pages] == want
    assert [html_text.main_text(p.replace("<article>", "").replace("</article>", "")) for p in pages] == want
    for at in (COMMENTS + "</article>", "</article>" + COMMENTS):
        assert [html_text.main_text(p.replace("</article>", at)) for p in pages] == want
    # Without classes, ratios alone find the article wherever it outweighs the advert; constant ratios do nowhere.
    bare = [p.replace(' class="ad"', "") for p in pages]
    found = sum(html_text.main_text(p) == w for p, w in zip(bare, want, strict=True))
    monkeypatch.setattr(html_text, "path_ratios", lambda blocks, radius=1: np.ones(len(blocks)))
    assert found >= 0.8 * len(pages)
    assert not any(html_text.main_text(p) == w for p, w in zip(bare, want, strict=True))
    assert not any(html_text.main_text(p) == w for p, w in zip(pages, want, strict=True))


def test_html_comments_without_a_name():
    text = "".join(f"<p>Paragraph {i} of the article, which says something, and then more.</p>" for i in range(6))
    said = [f"<b>Reader {i}</b><p>I think, as said before, that this is right.</p>" for i in range(4)]
    want = ["Title", *(f"Paragraph {i} of the article, which says something, and then more." for i in range(6))]
    for opening, closing in (("<div>", "</div>"), ("<article>", "</article>"), ("<li>", "</li>")):
        block = "<div>" + "".join(opening + x + closing for x in said) + "</div>"
        assert html_text.main_text(f"<body><div><h1>Title</h1>{text}{block}</div></body>").split("\n\n") == want, opening
        assert html_text.main_text(f"<body><div><h1>Title</h1>{text}</div>{block}</body>").split("\n\n") == want, opening
    # Sections, tables and lists of an article stay, and so do records that make up the page.
    section = "<section><h2>Part</h2><p>Some text, as such.</p></section>" * 3
    table = "<table>" + "<tr><td>one, two.</td><td>three, four.</td></tr>" * 4 + "</table>"
    for more, n in ((section, 6), (table, 8), ("<ul>" + "<li>an item, or so.</li>" * 5 + "</ul>", 5)):
        assert len(html_text.main_text(f"<body><div><h1>Title</h1>{text}{more}</div></body>").split("\n\n")) == 7 + n, more
    assert html_text.main_text("<body>" + "".join(f"<div>{x}</div>" for x in said) + "</body>").count("I think") == 4


def test_html_is_linear_in_depth():
    import time

    began = time.process_time()
    assert html_text.main_text("<div>w, and w." * 100_000).count("\n\n") == 99_999
    html_text.main_text("<li><ul>" + "<div>" * 50_000 + "<li>x</li>" * 50_000)
    html_text.main_text("<b>" * 50_000 + "x<hr>" * 50_000)
    html_text.main_text("<h2>A, b. c</h2>" * 100_000)
    html_text.main_text("<h2>A</h2><p>b, c. d</p>" * 50_000)
    assert time.process_time() - began < 15


def test_html_query_finds_whole_articles(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.op8_html_text(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == plain_article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_pipeline_stage_by_stage(spark, tmp_path):
    import corpus_pipeline as c

    passage = "\n".join(f"a shared line number {i} that stands in many texts" for i in range(9))
    base = " ".join(f"word{i}" for i in range(120))
    rows = [(1, "the cat and the dog sat"), (2, "!!! 123"), (3, None), (4, passage + "\nfirst of them, the owner"), (5, "another one\n" + passage), (6, base), (7, base + " extra"), (8, base), (9, "le chat et le chien")]
    df = spark.createDataFrame([(i, t, "fr" if t and "chat" in t else "en", None if i == 9 else "s", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in c.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == c.COLUMNS
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {r.doc_id: r.text for r in docs.collect()}
    assert seen["language_id"].keys() == {1, 4, 5, 6, 7, 8, 9}
    lines = seen["line_dedup"]
    assert lines.keys() == {1, 4, 5, 6, 7, 8, 9} and lines[4] == dict(rows)[4] and len(lines[5]) < len(dict(rows)[5]) and lines[6] == base
    assert seen["near_duplicates"].keys() == {1, 4, 5, 6, 9}
    packed = c.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == {1, 4, 5, 6, 9}
    assert sorted((r.doc_id, r.start, r.ids_crc32) for r in packed) == sorted((r.doc_id, r.start, r.ids_crc32) for r in c.run(spark, str(tmp_path)).collect())


def test_pipeline_keeps_documents_without_a_known_language(spark):
    import zlib

    import corpus_pipeline as c

    shape = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "the cat"), (2, "12 !?"), (3, None), (4, ""), (5, "\u65e5\u672c"), (None, "le chien"), (6, "\U00010400 9")]
    stage = dict(c.STAGES)["language_id"]
    for lang in (None, "und"):
        docs = spark.createDataFrame([(i, t, lang, None, None) for i, t in rows], shape)
        assert {r.doc_id for r in stage(spark, docs, "").collect()} == {1, 5, None, 6}
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 4 == 2]
    docs = spark.createDataFrame([(i, "the cat", "en", "s", 7) for i in held], shape)
    assert stage(spark, docs, "").count() == len(held) > 0


def test_marks_belong_to_words():
    assert (language_id.symbols("किताब") != language_id.SPACE).sum() == 5 and len(language_id.symbols("ที่")) == 5


def test_pipeline_takes_the_predicted_language(spark, tmp_path, monkeypatch):
    """Documents without a stated language get the predicted one, which reaches the packed pieces; another model gives another result."""
    import corpus_pipeline as c

    rows = [(i, "the cat and the dog sat here", "en") for i in range(30)] + [(100 + i, "le chat et le chien sont ici", "fr") for i in range(30)]
    rows += [(200, "the dog and the cat", None), (201, "le chien et le chat", None), (202, "12", None)]
    docs = spark.createDataFrame([(i, f"{t} {i}" if i < 202 else t, lang, "s", 1) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    stage = dict(c.STAGES)["language_id"]
    got = {r.doc_id: r.lang for r in stage(spark, docs, "").collect()}
    assert got[200] == "en" and got[201] == "fr" and 202 not in got and len(got) == 62
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.lang for r in c.run(spark, str(tmp_path)).collect()}.items() >= {200: "en", 201: "fr"}.items()
    fit = language_id.fit
    monkeypatch.setattr(language_id, "fit", lambda docs: fit(docs.replace({"en": "fr", "fr": "en"}, subset=["lang"])))
    other = {r.doc_id: r.lang for r in c.run(spark, str(tmp_path)).collect()}
    assert other[200] == "fr" and other[201] == "en"


def test_pipeline_keeps_one_row_of_each_near_duplicate(spark):
    import corpus_pipeline as c

    one, two, three = (" ".join(f"{w}{i}" for i in range(60)) for w in "abc")
    rows = [(1, one), (1, one), (2, one + " more"), (2, two), (None, two), (None, three), (None, three), (5, "alone"), (5, ""), (6, None), (6, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = sorted(((r.doc_id, r.text) for r in dict(c.STAGES)["near_duplicates"](spark, docs, "").collect()), key=str)
    assert got == sorted([(1, one), (2, two), (None, three), (5, "alone"), (5, ""), (6, None), (6, None)], key=str)


def test_pipeline_of_nothing(spark, tmp_path):
    import corpus_pipeline as c

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert c.run(spark, str(tmp_path)).count() == 0
