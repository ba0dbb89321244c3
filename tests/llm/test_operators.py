"""Operators on small edge tables, against brute force or an exact round trip."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from mktlens.llm import embedding_dedup, html_extract, jaccard_join, langid, line_dedup, mixing, packing, quality_rules, substring_dedup, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string"


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(300)]
    base = list(rng.choice(words, 60))
    rows = [(1, None), (2, ""), (3, "one two"), (4, " \n\t "), (5, "A a\n" * 40), (6, "one two")]
    for i in range(10, 22):
        text = base.copy()
        for at in rng.integers(0, 60, i % 4):
            text[at] = f"x{i}"
        rows.append((i, " ".join(text[:30]) + "\nThis line is common to several documents.\n" + " ".join(text[30:])))
    rows += [(30, " ".join(rng.choice(words, 3000))), (31, "é ü <|endoftext|> 你好 " * 20), (10, rows[6][1])]
    rows = [(i, t, ("en", None)[i % 2], ("s1", "s2", None)[i % 3], 0, "clash") for i, t in rows]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_empty_tables(spark):
    for op in (langid.op2_language_id, packing.op3_packing, jaccard_join.op4_jaccard_join, quality_rules.op5_quality_rules,
               substring_dedup.op6_substring_dedup, mixing.op7_mixing, line_dedup.op8_line_dedup):
        assert op(empty(spark)).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.op9_embedding_dedup(vectors).count() == 0


def test_jaccard_classes_equal_brute_force(docs, texts):
    sets = {}
    for i, t in texts.items():
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))
        sets[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in sets:
                if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    root[i] = min(root[i], root[j])
    for r in jaccard_join.op4_jaccard_join(docs).collect():
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), root[r.doc_id])


def test_substring_spans_equal_brute_force(docs, texts):
    seen, expected = set(), {}
    for i in sorted(texts):
        w, gone = WORD.findall(texts[i]), set()
        for s in range(len(w) - 19):
            k = tuple(w[s:s + 20])
            if k in seen:
                gone.update(range(s, s + 20))
            seen.add(k)
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        expected[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    for r in substring_dedup.op6_substring_dedup(docs).collect():
        assert (r.n_words, r.n_removed, r.kept_sha256) == expected[r.doc_id]


def test_packing_round_trip(docs, texts):
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = packing.pack(docs, max_tokens=64, group_docs=8).collect()
    for i, t in texts.items():
        ids = np.array([*exact.encode(t, add_special_tokens=False).ids, 0], "<u4")
        own = sorted((p.start, p.length, bytes(p.ids)) for p in pieces if p.doc_id == i)
        own = sorted(set(own))  # a repeated row is packed once per row
        assert b"".join(x for _, _, x in own) == ids.tobytes()
        assert all(p.doc_tokens == len(ids) for p in pieces if p.doc_id == i)
    by = {}
    for p in pieces:
        by.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64


def test_first_fit_decreasing():
    bins = packing.first_fit_decreasing([5, 4, 3, 3, 2, 1], 6)
    assert bins == [[0, 5], [1, 4], [2, 3]]


def test_mixing_targets_and_limits(spark, docs):
    a = mixing.op7_mixing(docs).collect()
    assert len(a) == docs.count()
    assert all(r.taken <= 2 * r.size for r in a)
    assert sorted(map(tuple, a)) == sorted(map(tuple, mixing.op7_mixing(docs).collect()))
    total = sum(r.size for r in a)
    sources = {(r.source_size, r.target) for r in a}
    assert sum(t for _, t in sources) == pytest.approx(1.5 * total)
    for s, t in sources:
        assert t <= 2 * s + 1e-6
        assert abs(sum(r.taken for r in a if (r.source_size, r.target) == (s, t)) - t) <= 3
    assert mixing.mix_documents(docs).columns == docs.columns


def test_quota_split_is_exact(spark):
    quotas = [(1, 50), (2, 30), (3, 0), (4, 7)]
    leaves = mixing.split_quotas(spark.createDataFrame(quotas, "rank int, quota long"), 3, 1).collect()
    for rank, quota in quotas:
        assert sum(r.blocks for r in leaves if r["rank"] == rank) == quota
    sizes = [sum(r.blocks for r in leaves if r.shard == s) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1 and all(r.blocks >= 0 for r in leaves)


def test_line_dedup_keeps_the_last_holder(docs, texts):
    out = {r.doc_id: r for r in line_dedup.op8_line_dedup(docs).collect()}
    assert out[21].n_dropped == 0 and out[10].n_dropped >= 1
    assert (out[1].n_lines, out[2].n_lines, out[5].n_lines) == (1, 1, 41)
    kept = texts[12].replace("This line is common to several documents.\n", "")
    assert out[12].n_dropped > 1 or out[12].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def test_quality_counts(docs, texts):
    out = {r.doc_id: r for r in quality_rules.op5_quality_rules(docs).collect()}
    assert out[1].n_words == 0 and out[1].base_failed and not out[1].kept
    assert (out[5].n_words, out[5].n_dup_lines, out[5].n_repeat_words) == (80, 39, 80)
    assert out[31].n_symbols == texts[31].count("<") + texts[31].count(">") + texts[31].count("|")
    assert out[31].word_chars == len(WORD.sub(lambda m: m[0], texts[31]).replace(" ", ""))
    assert out[30].kept


def test_language_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    own = {r.doc_id: r.lang for r in d.collect()}
    held = [r for r in langid.op2_language_id(d).collect() if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in held)
    assert np.mean([r.lang_pred == own[r.doc_id] for r in held]) > 0.95


def test_language_learns_every_label(spark):
    # 300 labels, letters of their own; one label in most rows, the rest in 9 each
    rng = np.random.default_rng(3)
    rows = []
    for k in range(300):
        letters = [chr(0x4E00 + 20 * k + j) for j in range(20)]
        rows += [(f"l{k}", " ".join("".join(rng.choice(letters, 4)) for _ in range(15))) for _ in range(3000 if k == 0 else 9)]
    d = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    out = {r.doc_id: r.lang_pred for r in langid.op2_language_id(d).collect()}
    assert set(out.values()) == {lang for lang, _ in rows}
    assert np.mean([out[i] == lang for i, (lang, _) in enumerate(rows) if lang != "l0"]) > 0.95


def test_language_unknown(docs):
    out = {r.doc_id: r for r in langid.op2_language_id(docs).collect()}
    assert all(out[i].lang_pred == "und" and out[i].score == 0 for i in (1, 2, 4))


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(20, 32))
    x = np.repeat(centre, 10, axis=0) + rng.normal(size=(200, 32)) * rng.choice([0, 0.1, 0.2], 200)[:, None]
    rows = [(i, [float(np.float32(c)) for c in v], i % 2) for i, v in enumerate(x)]
    rows += [(900, None, 0), (901, [0.0] * 32, 0), (902, [float("nan")] * 32, 0), (903, rows[0][1], None), (904, [None] * 32, 1), (905, [1.0], 1)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    out = {r.vec_id: r for r in embedding_dedup.op9_embedding_dedup(v).collect()}
    assert all(out[i].n_links == 0 and out[i].component_id == i and out[i].kept for i in range(900, 906))
    y = np.array([r[1] for r in rows[:200]])
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near = (y @ y.T >= 0.93) & (np.arange(200)[:, None] % 2 == np.arange(200)[None, :] % 2) & ~np.eye(200, dtype=bool)
    found = sum(out[i].n_links for i in range(200))
    assert 0.9 * near.sum() <= found <= near.sum()


def test_html(spark):
    page = ("<html><header>Site</header><nav><a href=/>Home</a></nav><div class=ad>Buy it, now, for very little money indeed.</div>"
            "<article><h1>Title</h1><p>First &amp; <b>bold</b>,\n with text that is long enough.<p>Second one, also long enough.</article>"
            "<div id=comments><p>I do not agree, not at all, with any of this.</p></div><script>var a='<p>no</p>'</script></html>")
    assert html_extract.main_text(page) == "Title\n\nFirst & bold, with text that is long enough.\n\nSecond one, also long enough."
    pages = spark.createDataFrame([(1, "u", None), (2, None, ""), (3, "u", "<p>"), (4, "u", page)], "page_id long, url string, html string")
    assert {r.page_id: r.n_chars for r in html_extract.op1_html_extraction(pages).collect()} == {1: 0, 2: 0, 3: 0, 4: len(html_extract.main_text(page))}


def test_html_named_elements_of_any_size():
    long = "<p>Nobody, I think, will agree with any of this, whatever they say.</p>" * 9
    article = "<article><h1>Title</h1><p>Short text.</p></article>"
    own = "Title\n\nShort text."
    for name in ("div id=comments", "div class=ad", "section class='cookie-notice'", "div class=sidebar", "div hidden", "div style='display:none'"):
        tag = name.split()[0]
        assert html_extract.main_text(f"<body>{article}<{name}>{long}</{tag}></body>") == own
        assert html_extract.main_text(f"<body><{name}>{long}</{tag}>{article}</body>") == own
        assert html_extract.main_text(f"<body><article><p>Short text.</p><{name}><article>{long}</article></{tag}></article></body>") == "Short text."
        # the article, or the only paragraphs, stay in an element of such a name
        assert html_extract.main_text(f"<body><{name}>{article}</{tag}></body>") == own
        assert html_extract.main_text(f"<body><{name}><div>{long}</div><div class=comments>{long}{long}</div></{tag}></body>").count("Nobody") == 9
    assert html_extract.main_text(f"<body><form action=/><div id=ads>{long}</div>{article}<label>Mail</label></form></body>") == own
    assert html_extract.main_text(f"<body><form><div>{long}</div></form><p>A line of more than 25 characters.</p></body>").count("Nobody") == 9
    assert html_extract.main_text(f"<body>{article}<form>{long}</form></body>") == own


def test_html_deep_pages(spark):
    n = 100_000
    deep = [f"<{tag}>x, " * n for tag in ("font", "span", "b", "div", "blockquote", "ul><li")]
    deep += ["<b>" * n + "</i>" * n, "<center>" * n + "<li></li>" * n + "end", "<span>" * n + "<hr>" * n + "end"]
    texts = [" ".join(html_extract.main_text(p).split()) for p in deep]
    assert all(t.count("x,") == n for t in texts[:3]) and all("x," in t for t in texts[3:6]) and [bool(t) for t in texts[6:]] == [False, True, True]
    assert all(html_extract.plain_text(p).count("x,") == n for p in deep[:6])
    pages = spark.createDataFrame([(1, "u", deep[0]), (2, "u", "<p>short")], "page_id long, url string, html string")
    assert {r.page_id: r.n_chars > 0 for r in html_extract.op1_html_extraction(pages).collect()} == {1: True, 2: True}
    assert warc.derive(warc.responses(pages)).count() == 4


def test_warc_round_trip(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, None, "<p>a\r\n\r\nb</p>"), (3, "v", "é" * 1000)], "page_id long, url string, html string")
    r = warc.responses(pages)
    records = r.union(warc.derive(r))
    assert records.count() == 9
    assert records.exceptAll(warc.records_of(warc.as_members(records))).count() == 0
    ids = {x.record_id: x for x in r.collect()}
    for d in warc.derive(r).collect():
        assert d.payload_digest == ids[d.refers_to].payload_digest and d.block_digest == warc.digest(bytes(d.block))
