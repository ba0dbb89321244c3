"""Rows, links and text that must not be lost in odd inputs."""

import numpy as np

import corpus_pipeline
from mktlens.llm import embedding_dedup, html_extract, jaccard_join, langid, line_dedup, mixing, quality_rules

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, of=4000):
    return [f"w{i}" for i in rng.integers(0, of, n)]


def test_vectors_of_every_length_link(spark):
    rng = np.random.default_rng(4)
    rows, pairs = [], {}
    for label, (length, n) in enumerate([(64, 100), (32, 40), (7, 20), (1, 2)]):
        for k in range(0, n, 2):
            v = rng.normal(size=length)
            i = len(rows)
            rows += [(i, [float(x) for x in v], label % 2), (i + 1, [float(x) for x in v + rng.normal(size=length) * 0.02], label % 2)]
            pairs[i + 1] = i
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df, fit_rows=80).collect()}
    found = sum(got[b].component_id <= a for b, a in pairs.items())
    assert found >= 0.95 * len(pairs) and len(got) == len(rows)


def test_text_behind_letters_with_a_longer_lower_case():
    for n in (12, 200):
        page = ("<html><body><article><p>" + "İ" * n + " one, two, three, four</p><SCRIPT>var x = '<p>no</p>'</Script>"
                "<p>The paragraph behind it, with commas, must stay.</p><p>So must, of course, this one.</p></article></body></html>")
        for text in (html_extract.main_text(page), html_extract.plain_text(page)):
            assert "must stay" in text and "So must" in text and "var x" not in text


def test_a_corpus_without_labels_is_kept(spark):
    docs = spark.createDataFrame([(1, "some words", None, "s", 10), (2, "½ Ⅷ ²", None, "s", 5), (3, None, None, "s", 0), (4, "é", None, "s", 1)], DOCS)
    assert sorted(r.doc_id for r in corpus_pipeline.known_language(spark, docs, "").collect()) == [1, 4]


def test_numbers_are_no_letters(spark):
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(["½", "Ⅷ", "x²", "²", "1_2"] + ["plain words here"] * 20)], DOCS)
    got = {r.doc_id: r.lang_pred for r in langid.op2_language_id(docs).collect()}
    assert [got[i] for i in range(5)] == ["und", "und", "en", "und", "und"]


def test_texts_of_one_document_share_its_links(spark):
    rng = np.random.default_rng(6)
    a, b, c = (words(rng, 60) for _ in range(3))
    near = lambda w: " ".join([*w[:-1], "other"])
    rows = [(5, " ".join(a)), (5, " ".join(b)), (5, " ".join(c)), (7, near(a)), (11, near(b)), (20, " ".join(words(rng, 60)))]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    got = sorted((r.doc_id, r.component_id) for r in jaccard_join.op4_jaccard_join(docs).collect())
    assert got == [(5, 5), (5, 5), (5, 5), (7, 5), (11, 5), (20, 20)]


def test_depleted_documents_are_rejected_at_every_host_size(spark):
    rng = np.random.default_rng(8)
    line = "this very line of forty words stands on far too many pages of the host " + " ".join(words(rng, 26))
    rows = []
    for host, size in (("small", 30), ("large", 900)):
        for k in range(size):
            own = " ".join(words(rng, 30 if k < 25 else 200))
            rows.append((len(rows), own + "\n" + line if k < 25 else own, "en", host, 0))
        # the line on as many pages as the limit allows stays
        rows += [(len(rows) + j, " ".join(words(rng, 30)) + "\nbut " + line, "en", host, 0) for j in range(20)]
    out = {r.doc_id: r for r in quality_rules.op5_quality_rules(spark.createDataFrame(rows, DOCS)).collect()}
    for i, t, *_ in rows:
        depleted = "\nthis very" in t
        assert out[i].n_words > 50 or not depleted
        assert (not out[i].base_failed, out[i].kept) == (True, not depleted), (i, out[i])


def test_columns_named_like_working_ones_pass_through(spark):
    extra = ["_id", "_version", "_gone", "_keep", "_key", "_size", "_draw", "_Shard", "_place", "_language", "lang_pred", "score",
             "_n_lines", "component_id"]
    line = "a line that is shared by every one of them"
    docs = spark.createDataFrame([(i, f"{line}\nits own words {i}", "en" if i % 2 else None, f"s{i % 2}", 9, *(f"{c}{i}" for c in extra))
                                  for i in range(1, 7)], DOCS + "".join(f", {c} string" for c in extra))
    model = langid.fit(docs)
    for stage in (lambda d: langid.keep_known(d, model), lambda d: line_dedup.drop_lines(d, counts=False),
                  jaccard_join.keep_one, mixing.mix_documents):
        out = stage(docs)
        assert out.columns == docs.columns
        got = out.collect()
        assert got and all(r[c] == f"{c}{r.doc_id}" for r in got for c in extra)
    assert line_dedup.drop_lines(docs).columns.count("_n_lines") == 1
    assert langid.with_language(docs, model).columns.count("lang_pred") == 1


def test_mixing_has_as_many_shards_as_its_size_asks_for(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 7), "en", f"s{i % 3}", 0) for i in range(300)], DOCS)
    few = {r.doc_id: (r.target, r.taken) for r in mixing.op7_mixing(docs).collect()}
    monkeypatch.setattr(mixing, "SHARD_WORDS", 20)
    draws = mixing.mixing_plan(docs).collect()
    shards = {d["shard"] for r in draws for d in r.draws}
    assert len(shards) > 32 and max(shards) < 128
    assert {r.doc_id: (r.target, sum(d.words for d in r.draws)) for r in draws} == few
