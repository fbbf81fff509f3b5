"""Each operator against a brute-force version, a library or a round trip, and its odd inputs."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from plumbline.llm import html_text, langid, neighbours, packing, pieces, quality_fm, quality_rules, queries, simhash, toxicity, warc
from plumbline.llm.common import labelled_sample, table, tokenizer
from plumbline.llm.components import components

SF = "/root/testdata/sf0.001"
ODD = [None, "", " \n\t", "a", "é ß 日本 \x00 \x85", "word " * 3000, "<b>&amp;</b>", "x" * 5000]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def odd(spark):
    """Null and repeated ids, odd texts, a repeated row and columns with clashing names."""
    rows = [(i if i != 3 else None, t, None if i % 2 else "en", None, None) for i, t in enumerate(ODD)]
    rows += [(5, ODD[5], "en", None, None), (5, "another text", "en", "s", 1)]
    extra = ("score", "lang_pred", "fp", "component_id", "salt", "ids", "start", "m", "a", "b", "node", "root")
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({c: F.lit("extra") for c in extra})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


# -- 1 sentencepiece ---------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))


@pytest.mark.parametrize("letters", ["ab  the\n\tin", "a   ", "▁ é日本ж😀\x00　", "thenoni  er", "aab"])
def test_pieces_like_the_library(library, letters):
    codec, pick = pieces.Codec(tokenizer("piece_bpe_32k.model")), random.Random(3)
    texts = ["".join(pick.choice(letters) for _ in range(pick.randint(0, 70))) for _ in range(800)]
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        assert ids.tolist() == library.encode(text, add_eos=True)
        assert codec.decode(ids) == library.decode(ids.tolist())


def test_pieces_query(spark, library, docs, odd, empty):
    got = {r.doc_id: r for r in queries.op1_sentencepiece(spark, SF).collect()}
    for r in docs.collect():
        ids = library.encode(r.text, add_eos=True)
        want = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
        assert got[r.doc_id][1:] == want
    model = tokenizer("piece_bpe_32k.model")
    assert pieces.round_trip(odd, model).count() == 10 and pieces.round_trip(empty, model).count() == 0
    back = pieces.decode(pieces.encode(docs, model), model).join(docs.select("doc_id", F.col("text").alias("want")), "doc_id")
    assert back.filter("text != want").count() == 0


# -- 2 quality rules ---------------------------------------------------------------


def base_by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = [False] * len(words)
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            hit[i : i + 8] = [True] * 8
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, sum(hit)


def test_rules_base_counts(docs, odd):
    edge = ["a b c d e f g h a b c d e f g h i", "é \x85 x\n\né \x85 x\nx", "a " * 9, "a " * 8]
    for text in [r.text for r in docs.collect()] + ODD + edge:
        base, _ = quality_rules.measure(text)
        assert (base.n_words, base.word_chars, base.n_symbols, base.n_dup_lines, base.n_repeat_words) == base_by_hand(text)


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 8):
        field = quality_rules.Field(rng.normal(size=(quality_rules.WIDTH, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
        features = rng.integers(0, quality_rules.WIDTH, (n, 3))
        score = field.emission[features].sum(axis=1)

        def total(path, field=field, score=score):
            return field.start[path[0]] + sum(score[i, p] for i, p in enumerate(path)) + sum(field.transition[a, b] for a, b in zip(path, path[1:]))

        paths = [[k >> i & 1 for i in range(n)] for k in range(1 << n)]
        assert total(quality_rules.viterbi(field, features).tolist()) == pytest.approx(max(map(total, paths)))


def test_rules_query(spark, odd, empty):
    sf = "/root/testdata/sf0.01"
    got = queries.op2_quality_rules(spark, sf)
    rows = got.join(table(spark, sf, "labels"), "doc_id").filter("not base_failed").collect()
    good, bad = [r.kept for r in rows if r.quality], [r.kept for r in rows if not r.quality]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.2
    field = quality_rules.train(np.zeros((0, 11), int), np.zeros(0, int), np.zeros(0, int))
    judged = quality_rules.judge(odd, field).collect()
    assert len(judged) == 10 and not any(r.kept for r in judged if r.n_words < 20)
    assert quality_rules.judge(empty, field).count() == 0 and quality_rules.mark_lines(odd, field).count() > 0


# -- 3 and 7 classifiers -----------------------------------------------------------


def test_factorisation_machine_pairs():
    rng = np.random.default_rng(2)
    model = quality_fm.Model(0.3, rng.normal(size=quality_fm.WIDTH), rng.normal(size=(quality_fm.WIDTH, 4)) * 0.3)
    at, x = rng.choice(quality_fm.WIDTH, 9, replace=False), rng.normal(size=9)
    pairs = sum(model.factors[at[i]] @ model.factors[at[j]] * x[i] * x[j] for i in range(9) for j in range(i))
    assert model.score(at, x) == pytest.approx(1 / (1 + np.exp(-(0.3 + model.linear[at] @ x + pairs))))


@pytest.mark.parametrize(("name", "label", "least"), [("op3_quality_classifier", "quality", 0.95), ("op7_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    sf = "/root/testdata/sf0.1"
    rows = queries.QUERIES[name](spark, sf).join(table(spark, sf, "labels"), "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    assert np.mean([r.predicted == r[label] for r in rows]) > least
    assert all(0 <= r.score <= 1 for r in rows)


def test_classifiers_on_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(0, 1, 0), (5, 0, 1), (5, 0, 1), (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    none = labels.limit(0)
    for known in (labels, none):
        fm = quality_fm.fit(labelled_sample(odd, known, "quality", 100))
        assert quality_fm.score(odd, fm).count() == 10 and quality_fm.score(empty, fm).count() == 0
        tox = toxicity.fit(labelled_sample(odd, known, "toxic", 100))
        assert toxicity.score(odd, tox).filter("score between 0 and 1").count() == 10
        assert toxicity.score(empty, tox).count() == 0


def test_noisy_or_and_offending_sentences(spark):
    text = "you are fine. you awful fool! all is well."
    weights = np.zeros(toxicity.BUCKETS, np.float32)
    weights[toxicity.word_features("fool")[0]] = 12
    model = toxicity.Model(weights, -6.0)
    p = [1 / (1 + np.exp(6)), 1 / (1 + np.exp(-6)), 1 / (1 + np.exp(6))]
    assert toxicity.Scorer(model).document(text) == pytest.approx(1 - np.prod([1 - x for x in p]))
    found = toxicity.offending_sentences(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string"), model).collect()
    assert [(r.doc_id, r.sentence.strip()) for r in found] == [(1, "you awful fool!")]


# -- 4 html ------------------------------------------------------------------------

PAGE = """<html><head><title>t</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<div id="sidebar"><p>Side, bar, text, with, many, commas, that goes on and on and on and on for long.</p></div>
<div class="wrap"><div class="post-body"><h2>Title &lt;here&gt;</h2><p>First para &amp; more, with  commas,
and length to be an article paragraph.<p>Second <a href=x>link</a> para.<br>Some text, here.</p>
<div class="ad-box"><p>Buy, now, cheap</p></div><form><p>Subscribe, please</p></form><blockquote>Quote</blockquote></div>
<div class="notice">Cookies, ok</div><section id="comments"><p>I, think, that, this, is, long, very, long, indeed</p></section></div>
<footer>c</footer><script>var a="<p>no</p>"</script></body></html>"""


def test_html_main_text():
    assert html_text.main_blocks(PAGE) == [
        "Title <here>",
        "First para & more, with commas, and length to be an article paragraph.",
        "Second link para. Some text, here.",
        "Quote",
    ]
    assert html_text.main_blocks(None) == html_text.main_blocks("<nav>a</nav>") == []
    assert html_text.main_blocks("<div><p>x, y" * 3000)[0] == "x, y"


def test_html_uneven_sections():
    paragraphs = [f"Paragraph {i}, of the first part, is as long as an ordinary paragraph of an article, and more." for i in range(20)]
    first = "<div>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</div>"
    links = "<div><a href=a>One story.</a> <a href=b>Other story.</a></div>"
    for page in (
        f"<div>{first}<div><p>The last part.</p></div>{links}</div>",
        f"<body><div>{first}<section><p>The last part.</p></section>{links}</div></body>",
        f"<body><div><div>{first}</div></div><div><div><p>The last part.</p></div></div>{links}</body>",
        f"<div>{first}The last part.</div>{links}",
        f"<body><main><article>{first}</article><div><p>The last part.</p></div>{links}</main><div><p>Beyond main.</p></div></body>",
        f"<div>{first}<div><p>The last part.</p></div><div class=sidebar><p>A side note.</p></div></div><div id=footer><p>All rights.</p></div>",
    ):
        assert html_text.main_blocks(page) == [*paragraphs, "The last part."]


def test_html_hidden_is_an_attribute():
    shown = (
        'title="a hidden door"', 'class="text-lg hidden md:block"', 'data-x="is hidden now"', "data-hidden=1", 'alt="display: none"',
        'title="x class=nav y"', 'class="overflow-hidden"', 'aria-hidden="false"', 'data-aria-hidden="true"', 'title="aria-hidden=true"',
        'style="--display:none; color:red"',
    )
    hidden = ("hidden", "class=x hidden", 'HIDDEN=""', 'title="x"hidden', 'style="color:red; Display : none"', "aria-hidden=true", "aria-hidden=' TRUE '")
    for tag in ("body", "article", "main", "div"):
        for value in shown:
            assert html_text.main_blocks(f"<{tag} {value}><p>Some text, here.</p></{tag}>") == ["Some text, here."], value
        for value in hidden:
            assert html_text.main_blocks(f"<{tag} {value}><p>Some text, here.</p></{tag}>") == [], value
    assert html_text.main_blocks('<div class="hidden"><p>Some text, here.</p></div>') == []


PARAGRAPH = "This is a paragraph of the article, with commas, and enough of words to be read as one by any measure."
P = f"<p>{PARAGRAPH}</p>"


def test_html_sections_of_an_article_stay_whatever_their_names():
    names = "introduction related-work discussion legal-framework feedback-loops side-effects menu-costs notice-and-comment social-history".split()
    for tag, attribute in (("section", "id"), ("div", "class")):
        parts = "".join(f'<{tag} {attribute}="{n}"><h2>{n}</h2><p>About {n}, in short.</p></{tag}>' for n in [*names, "search-methods"])
        want = [x for n in [*names, "search-methods"] for x in (n, f"About {n}, in short.")]
        assert html_text.main_blocks(f"<body><article>{parts}</article></body>") == want
    code = f'<article>{P}<pre><code><span class="token comment"># a note</span> x = 1</code></pre></article>'
    assert html_text.main_blocks(code) == [PARAGRAPH, "# a note x = 1"]


def test_html_wrappers_and_heads():
    assert html_text.main_blocks(f"<body><form id=all><div>{P}{P}</div><label>x</label><input></form></body>") == [PARAGRAPH] * 2
    assert html_text.main_blocks(f"<article>{P}{P}<form><p>Write to us.</p></form></article>") == [PARAGRAPH] * 2
    page = f"<body><header><h1>Site</h1></header><article><header><h1>Title</h1><p>The lead.</p></header>{P}</article></body>"
    assert html_text.main_blocks(page) == ["Title", "The lead.", PARAGRAPH]
    assert html_text.main_blocks(f"<html><head><title>t</title><body>{P}</body></html>") == [PARAGRAPH]


def test_html_notices_teasers_and_threads_beside_an_article():
    beside = (
        "<div><p>We use cookies on this site to help you.</p></div>",
        '<div class="responses"><p>A great story, I liked it.</p></div>',
        '<ol class="thread"><li><p>A great story.</p></li></ol>',
        "<div><h3><a href=x>Another story</a></h3><p>What happened then.</p></div>",
        "<ul><li><b>Ann</b><p>A great story.</p></li><li><b>Bo</b><p>It is not.</p></li></ul>",
        '<article class="comment"><p>A great story.</p></article>',
    )
    for other in beside:
        for page in (f"<body><article>{P * 4}</article>{other}</body>", f"<main><article>{P * 4}</article>{other}</main>", f"<main>{P * 8}{other}</main>"):
            got = html_text.main_blocks(page)
            assert got == [PARAGRAPH] * len(got) and len(got) >= 4, page
    # the same structure inside an article is its own
    assert len(html_text.main_blocks(f"<article>{P}<ol><li><p>First do this.</p></li><li><p>Then that.</p></li></ol></article>")) == 3


def test_html_quotes_end_as_html_says():
    assert html_text.main_blocks('<div><p>A one.</p><p title="x>B</p><p class="y">C two.</div>') == ["A one.", "C two."]
    assert html_text.main_blocks('<p>A one.</p><p title="x>B two.</p>') == ["A one."]
    assert html_text.main_blocks("<p title='a > b' class=x>A one, 2 < 3.</p>") == ["A one, 2 < 3."]


def test_html_work_is_linear():
    n = 1_000_000
    odd = ("<a ", "<b>", "<p title=\"", "<table>", "<", "&", "<i hidden>", "<p>a.")
    pages = [x * (n // len(x)) for x in odd]
    pages += ["<a " * (n // 3) + '"', "<p><button>" + "<div>" * (n // 5), "<ul><li><ul>" + "<div>" * (n // 10) + "<li>x" * (n // 10)]
    pages += ["<b class=x><div>" + "<i id=q>" * (n // 16) + "</b>" * (n // 8)]
    for page in pages:
        began = time.process_time()
        html_text.main_blocks(page)
        assert time.process_time() - began < 10, page[:40]  # a quadratic walk takes minutes


def test_html_scores_by_definition(spark):
    """Points, link density and the choice against sums over the paths of every block."""
    pick = random.Random(8)

    def page(depth: int = 0) -> str:
        if depth > 4 or pick.random() < 0.4:
            words = ", ".join(pick.choices(("one", "two words", "three. "), k=pick.randint(1, 60)))
            return pick.choice((f"<p>{words}", f"<p><a href=x>{words}</a>", f"<h2>{words}</h2>", f"{words}", f"<p>{words} <a>link</a></p>"))
        tag = pick.choice(("div", "section", "article", "main", "blockquote"))
        return f"<{tag}>" + "".join(page(depth + 1) for _ in range(pick.randint(1, 4))) + f"</{tag}>"

    pages = [f"<body>{page()}{page()}</body>" for _ in range(300)] + [r.html for r in table(spark, SF, "pages").limit(100).collect()]
    for source in pages:
        blocks = html_text.parse(source)
        nodes = html_text.measure(blocks)
        html_text.score(blocks)
        points, chars, links = Counter(), Counter(), Counter()
        for b in blocks:
            path = [b.node]
            while path[-1].parent is not None:
                path.append(path[-1].parent)
            for node in path:
                chars[node.order] += len(b.text)
                links[node.order] += b.links
            if b.links * 2 > len(b.text) or b.node.tag in ("h1", "h2", "h3", "h4", "h5", "h6", "hgroup"):
                continue
            if b.node.tag in ("p", "pre", "li", "td", "blockquote", "dd") and len(path) > 2:
                path = path[1:]
            for node, share in zip(path, (1, 1 / 2, 1 / 6, 1 / 9, 1 / 12, 1 / 15), strict=False):
                points[node.order] += share * (1 + b.text.count(",") + min(len(b.text) / 100, 20))
        for node in nodes:
            density = links[node.order] / chars[node.order]
            bonus = 1.25 if node.tag in ("article", "main") else 1
            assert node.points == pytest.approx(points[node.order])
            assert html_text.worth(node) == pytest.approx(points[node.order] * bonus * (1 - density))


def test_html_query(spark):
    got = {r.page_id: r.text for r in queries.op4_html_extraction(spark, SF).collect()}
    for r in table(spark, SF, "pages").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [re.sub(r"<[^>]+>", "", x.replace("<br>", " ")) for x in re.split(r"</?(?:h1|p)>", article)]
        import html

        parts = [" ".join(html.unescape(x).split()) for x in parts]
        assert got[r.page_id] == "\n".join(x for x in parts if x)
    pages = spark.createDataFrame([(None, None, None), (1, "u", ""), (1, "u", "")], "page_id long, url string, html string")
    assert [r.n_chars for r in html_text.extract(pages).collect()] == [0, 0, 0]


# -- 5 packing ---------------------------------------------------------------------


def test_ids_like_the_library():
    encoder, pick = packing.Encoder(tokenizer("byte_bpe_50k.json")), random.Random(5)
    letters = "ab Ze  \n\t\r'sdtvrel.,!?1é½×ßſÿ0-\"<|>日"
    texts = ["".join(pick.choice(letters) for _ in range(pick.randint(0, 60))) for _ in range(3000)] + ["a<|endoftext|> b"]
    want = encoder.library.encode_batch(texts, add_special_tokens=False)
    for text, coded in zip(texts, want, strict=True):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == coded.ids


def test_ids_of_special_strings(spark):
    from tokenizers import Tokenizer

    fresh = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    encoder, pick = packing.Encoder(tokenizer("byte_bpe_50k.json")), random.Random(6)
    parts = ["<|endoftext|>", "<|endoftext", "|>", " ", "\n", "word", " some", "日本", "é"]
    texts = ["a<|endoftext|> b", "<|endoftext|>", "日 <|endoftext|>本"] + ["".join(pick.choices(parts, k=pick.randint(0, 12))) for _ in range(2000)]
    want = [c.ids for c in fresh.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(encoder.encode(t), "<u4").tolist() for t in texts] == want
    assert 50256 in want[0]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:3])], "doc_id long, text string")
    for r in packing.pack_documents(df, tokenizer("byte_bpe_50k.json"), with_ids=True).collect():
        ids = [*want[r.doc_id], packing.END_ID]
        assert r.doc_tokens == len(ids)
        assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.start : r.start + r.length]


def check_pieces(rows, lengths):
    """Every token in one piece, sequences gapless, full or at a power of two."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r[0], []).append((r[1], r[2]))
        by_sequence.setdefault(r[3], []).append((r[4], r[2]))
    for d, n in lengths.items():
        at = 0
        for start, length in sorted(by_doc[d]):
            assert start == at and length > 0
            at += length
        assert at == n
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048 and at & (at - 1) == 0


def test_pack_any_lengths():
    rng = np.random.default_rng(4)
    for n in (1, 7, 300):
        lengths = rng.integers(1, 6000, n)
        check_pieces(packing.pack(lengths), dict(enumerate(lengths.tolist())))
    assert packing.pack(np.zeros(0, np.int64)) == []


def test_packing_query(spark, docs, odd, empty):
    encoder = packing.Encoder(tokenizer("byte_bpe_50k.json"))
    ids = {r.doc_id: encoder.encode(r.text or "") + b"\x01\0\0\0" for r in docs.collect()}
    rows = queries.op5_packing(spark, SF).collect()
    check_pieces([(r.doc_id, r.start, r.length, r.sequence_id, r.offset) for r in rows], {d: len(x) // 4 for d, x in ids.items()})
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][4 * r.start : 4 * (r.start + r.length)])
        assert r.doc_tokens == len(ids[r.doc_id]) // 4
    small = packing.pack_documents(odd, tokenizer("byte_bpe_50k.json"), block_tokens=500)
    assert small.agg(F.sum("length")).first()[0] > 3000
    assert packing.pack_documents(empty, tokenizer("byte_bpe_50k.json")).count() == 0


# -- 6 warc ------------------------------------------------------------------------


def test_warc_round_trip(spark, tmp_path):
    long = "WARC/1.1\r\nContent-Length: 3\r\n\r\né" * 60
    rows = [(i, f"http://x/{i}\r\nX: y", long) for i in range(1, 40)] + [
        (100, None, None), (101, "u", ""), (102, "u", "short"), (103, "u", "short"), (None, "u", long), (39, "again", long),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record", F.lit(1))
    warc.write(pages, str(tmp_path / "w"), records_a_file=7)
    back = warc.read(spark, str(tmp_path / "w"), batch_bytes=3000).withColumns(
        {"page": warc.page_number("record_id"), "to": warc.page_number("refers_to")}
    ).collect()
    assert len(back) == len(rows)
    assert sorted((r.page or 0, r.record_type, r.to) for r in back if r.payload_digest == hashlib.sha1(long.encode()).hexdigest()) == sorted(
        [(i, "revisit", 39) for i in range(1, 39)] + [(39, "response", None)] * 2 + [(0, "revisit", 39)]
    )
    for r in back:
        assert r.payload_bytes == len(r.payload) or r.record_type == "revisit" and not r.payload
        assert r.record_type == "revisit" or hashlib.sha1(r.payload).hexdigest() == r.payload_digest
    warc.write(pages.limit(0), str(tmp_path / "e"))
    assert warc.read(spark, str(tmp_path / "e")).count() == 0


# -- 8 simhash ---------------------------------------------------------------------


def fingerprint_by_hand(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    ones = Counter(b for s in shingles for b in range(64) if xxhash.xxh64_intdigest(s, seed=42) >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def components_by_hand(values, radius):
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    ordered = sorted(values)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            if bin(a ^ b).count("1") <= radius:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in values}


def test_simhash_query(spark, docs):
    got = {r.doc_id: r for r in queries.op8_simhash_near_dedup(spark, SF).collect()}
    prints = {r.doc_id: fingerprint_by_hand(r.text) for r in docs.collect()}
    group = components_by_hand(set(prints.values()), 4)
    least = {}
    for d, f in prints.items():
        least[group[f]] = min(d, least.get(group[f], d))
    for d, f in prints.items():
        assert (got[d].fingerprint, got[d].component_id) == (f"{f:016x}", least[group[f]])


def test_links_find_every_component(spark):
    pick = random.Random(6)
    values = {pick.getrandbits(64) for _ in range(150)}
    for v in list(values):
        for _ in range(4):
            values.add(v := v ^ sum(1 << b for b in pick.sample(range(64), pick.randint(1, 6))))
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    want = components_by_hand(values, 4)
    df = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    for tile_rows in (5, 16384):
        roots = {r.node: r.root for r in components(simhash.links(df, 4, tile_rows)).collect()}
        got = {}
        for v in values:
            got.setdefault(roots.get(signed(v), signed(v)), set()).add(v)
        expected = {}
        for v in values:
            expected.setdefault(want[v], set()).add(v)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_simhash_odd_rows(odd, empty):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == 10
    blank = [r for r in rows if r.fp == 0]
    assert len(blank) == 3 and {r.component_id for r in blank} == {0}
    assert simhash.near_duplicates(empty).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    roots = {r.node: r.root for r in components(edges).collect()}
    assert roots == {i: 0 for i in range(1, 61)} | {101: 100}


# -- 9 language --------------------------------------------------------------------


def test_forward_sums_all_segmentations():
    vocabulary = langid.vocabulary(tokenizer("piece_bpe_32k.model"))
    probs = np.random.default_rng(0).random((len(vocabulary) + 2, 2))
    probs[len(vocabulary)] = 0
    probs /= probs.sum(axis=0)
    number = {p: i for i, p in enumerate(vocabulary)}
    words = ["▁the", "▁international", "▁ж", "▁日本xyz", "▁" + "abcdefghij" * 30, "▁"]
    for word, got in zip(words, langid._walk(langid.Pieces(vocabulary), words, probs), strict=True):
        logs = [np.zeros(2)]
        for t in range(1, len(word) + 1):
            ends = [(n, number.get(word[t - n : t], len(vocabulary) + 1 if n == 1 else None)) for n in range(1, min(16, t) + 1)]
            logs.append(np.logaddexp.reduce([logs[t - n] + np.log(probs[i]) for n, i in ends if i is not None]))
        assert np.allclose(got, logs[-1])


def test_language_query(spark, odd, empty):
    sf = "/root/testdata/sf0.01"
    rows = queries.op9_language_id(spark, sf).join(table(spark, sf, "documents"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97 and all(0 <= r.score <= 1 for r in rows)
    model = langid.fit(odd, tokenizer("piece_bpe_32k.model"))
    found = langid.identify(odd, model)
    assert found.columns[-2:] == ["lang_pred", "score"] and found.count() == 10
    assert all(r.lang_pred == "und" for r in found.collect() if not langid.words_of(r.text))
    assert langid.identify(empty, langid.fit(empty, tokenizer("piece_bpe_32k.model"))).count() == 0


# -- 10 neighbours -----------------------------------------------------------------


def search_by_hand(rows, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = set()
    for q, a in ok:
        if q % 20 == 0:
            scores = sorted((-float(np.cumsum(a * b)[-1]), i) for i, b in ok if i != q)[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)}
    return out


@pytest.mark.parametrize("tile_rows", [16, 2048])
def test_neighbours_like_brute_force(spark, tile_rows):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(120)]
    rows += [(i, rows[3][1]) for i in range(120, 160)]  # ties
    rows += [(160, None), (161, [0.0] * 6), (162, [None] * 6), (163, [float("nan")] * 6), (164, [float("inf")] * 6), (None, [1.0] * 6), (180, [1e3] * 6), (181, [1e-4] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    got = neighbours.search(df, F.col("vec_id") % 20 == 0, k=20, tile_rows=tile_rows, query_rows=3)
    assert {tuple(r) for r in got.collect()} == search_by_hand([(i, np.array(v, np.float32).tolist() if v and None not in v else v) for i, v in rows], 20)
    assert neighbours.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_repeated_ids_spread_over_tiles(spark, monkeypatch):
    sizes, written = {}, neighbours.materialise

    def noted(df, name):
        out = written(df, name)
        if name in ("candidates", "queries"):
            sizes[name] = [r[0] for r in out.select(F.size(f"{'c' if name == 'candidates' else 'q'}_ids")).collect()]
        return out

    monkeypatch.setattr(neighbours, "materialise", noted)
    rng = np.random.default_rng(8)
    rows = [(7, [1.0, 2.0, 3.0])] * 300 + [(7, v) for v in rng.normal(size=(300, 3)).tolist()]
    rows += [(i, v) for i, v in enumerate(rng.normal(size=(300, 3)).tolist(), 100)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asks = F.col("vec_id").isin(7, 100)
    got = [tuple(r) for r in neighbours.search(df, asks, k=5, tile_rows=50, query_rows=50).collect()]
    assert sum(sizes["candidates"]) == 900 and max(sizes["candidates"]) < 120
    assert sum(sizes["queries"]) == 302 and max(sizes["queries"]) < 120
    whole = [tuple(r) for r in neighbours.search(df, asks, k=5, tile_rows=5000, query_rows=5000).collect()]
    assert len(got) == 10 and sorted(got) == sorted(whole)


def test_neighbours_units_are_few(spark, monkeypatch):
    """Tiny tiles: tasks stay bounded, and each vector is sent once per group or stripe."""
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rng.normal(size=(600, 4)).tolist())], "vec_id long, embedding array<float>")
    whole = neighbours.search(df, F.col("vec_id") % 3 == 0, k=5)
    monkeypatch.setattr(neighbours, "TASKS", 12)
    found = neighbours.search(df, F.col("vec_id") % 3 == 0, k=5, tile_rows=2, query_rows=2, group_tiles=20, stripe_tiles=25)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "], 12" in plan and "Join" not in plan
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect()))


# -- pipeline ----------------------------------------------------------------------


def test_pipeline_stages(spark, docs, odd):
    sf, kept = "/root/testdata/sf0.01", table(spark, "/root/testdata/sf0.01", "documents")
    labels = {r.doc_id: r.toxic for r in table(spark, sf, "labels").collect()}
    before = {r.doc_id for r in kept.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        given = kept
        kept = corpus_pipeline.materialise(stage(spark, given, sf), name)
        assert kept.columns == docs.columns
        after = {r.doc_id for r in kept.collect()}
        gone, before = before - after, after
        if name == "language":
            assert len(gone) < 5
        if name == "near_duplicates":
            groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(given).collect()}
            assert after == set(groups.values())
    assert corpus_pipeline.packed(spark, kept, sf).select("doc_id").distinct().count() == len(before)
    assert labels


def test_one_of_each_group_where_ids_clash(spark):
    """An id with unlike texts: one row stays, and its text is of a group that the id stands for."""
    a, b, c = ("first text about cats and dogs", "another thing entirely, rivers or hills", "numbers one two three four five six")
    rows = [(3, a), (5, a), (5, b), (9, b), (5, b), (5, c), (None, a), (7, None), (8, "")]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.one_of_each(spark, df, SF).collect()]
    ids = sorted((i for i, _ in kept), key=str)
    assert ids == sorted([3, 5, 7, None], key=str) and (3, a) in kept and (None, a) in kept and dict(kept)[5] in (b, c)


def test_labelled_sample_is_bounded_by_rows(spark):
    labels = spark.range(0, 40).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    one = spark.range(2000).selectExpr("CAST(1 AS BIGINT) AS doc_id", "CAST(id AS STRING) AS text")
    same = spark.range(2000).selectExpr("CAST(2 AS BIGINT) AS doc_id", "'again' AS text")
    rest = spark.range(40).selectExpr("id AS doc_id", "'once' AS text")
    assert labelled_sample(one.union(same).union(rest), labels, "quality", 100).count() < 200
    assert labelled_sample(rest, labels, "quality", 100).count() == labelled_sample(rest, labels, "quality", 10**6).count() > 20


def test_language_letters_and_sample(spark):
    for text in ("\u00b2\u00b3 \u00bd", "\u216b \u2460", "12 34 _", ""):
        assert langid.words_of(text) == []
    assert langid.words_of("Na\u00efve \u65e5\u672c x\u00b2") == ["na\u00efve", "\u65e5\u672c", "x"]
    rows = [(None, f"word{i}", "en") for i in range(3000)] + [(7, "same words", "en")] * 3000
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert langid._sample(df, "doc_id", "text", "lang", 300).count() < 400


def test_pipeline_on_odd_rows(spark, odd):
    given = odd.select("doc_id", "text", "lang", "source", "n_chars")
    unique = corpus_pipeline.one_of_each(spark, given, SF)
    ids = [r.doc_id for r in unique.collect()]
    assert ids.count(5) == 1 and ids.count(None) == 1 and 1 not in ids
    assert corpus_pipeline.known_language(spark, given.limit(0), SF).count() == 0
    assert corpus_pipeline.not_toxic(spark, given, SF).count() == 10


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, name):
    from oracle import compare, connect

    same, note = compare(spark, connect(SF), name, queries.QUERIES[name], queries.ORACLES[name], SF)
    assert same, note
