"""Every operator over odd tables: nulls, empty and long texts, ties, repeated rows, clashing names, no rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakewright.llm import decontamination, interpolation, jaccard, line_crf, mixing, packing, pages, pii, quotes, toxicity

LONG = "wide words walk while winter waits. " * 4000
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away.", "en", "b", 10, "x", 1.0),
    (1, "The quick brown fox jumps over the lazy dog and runs away.", "en", "b", 10, "x", 1.0),
    (2, "the quick brown fox jumps over the lazy dog and RUNS away.", None, None, None, None, None),
    (3, None, "en", "a", 0, "y", 2.0),
    (None, "nobody owns this text but it has some words in it", "en", "c", 1, None, None),
    (None, None, None, None, None, None, None),
    (4, "", "en", "a", 0, "z", 0.0),
    (5, " \n\t ", "en", "", 4, "z", 0.0),
    (6, LONG, "en", "a", len(LONG), "q", 0.0),
    (7, "one", "en", "c", 3, "q", 0.0),
    (7, "two stupid words", "en", "c", 3, "q", 0.0),
    (8, "x" * 70_000, "en", "b", 3, "q", 0.0),
    (9, "Ünïcödé wörds mail a.b@c.de and +1 (269) 555-3296 4524132264652876 ok 1.2.3.4", "de", "b", 3, "q", 0.0),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, score double"
LABELS = [(1, 1, 0), (2, None, None), (3, 0, 0), (7, 0, 1), (7, 0, 1), (None, 1, 1), (6, 1, 0), (9, 0, 0)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "quick brown fox jumps over"), (None, "wide words walk while winter waits wide words"), (2, None), (3, ""), (1, "quick brown fox jumps over")], "item_id long, text string")


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=str)


ALL = sorted((r[0] for r in ROWS), key=str)


def test_interpolation(docs, none):
    rows = interpolation.score_texts(interpolation.learn(docs)).collect()
    assert sorted((r.doc_id for r in rows), key=str) == ALL
    assert all(r.score <= 0 and r.n_tokens >= 1 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4, 5)} == {1}
    assert interpolation.score_texts(interpolation.learn(none)).collect() == []


def test_mixing(docs, none):
    rows = mixing.mix_report(docs).collect()
    assert sorted((r.doc_id for r in rows), key=str) == ALL
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    assert mixing.mix_report(none).collect() == []
    mixed = mixing.mix_texts(docs)
    assert mixed.columns == docs.columns and mixed.schema == docs.schema
    assert sum(len(r.text.split()) for r in mixed.collect()) == sum(r.taken for r in rows)
    assert mixing.mix_texts(none).collect() == []


def test_packing(docs, none):
    vocabulary = packing.Vocabulary.read()
    rows = packing.pack(docs, vocabulary, length=64).collect()
    texts, encoding = {}, vocabulary.encoding()
    for r in rows:
        assert len(r.input_ids) == len(r.position_ids) == 64
        for a, b, key in zip(r.cu_seqlens, r.cu_seqlens[1:], zip(r.doc_ids, r.text_nos, r.pieces, strict=True), strict=False):
            assert r.position_ids[a:b] == list(range(b - a))
            texts.setdefault((r.shard, *key[:2]), {})[key[2]] = r.input_ids[a:b]
    read = [(doc, [i for k in sorted(parts) for i in parts[k]]) for (_, doc, _), parts in texts.items()]
    assert all(t[-1] == packing.END for _, t in read)
    assert sorted((d, encoding.decode(t[:-1])) for d, t in read if d is not None) == sorted((r[0], r[1] or "") for r in ROWS if r[0] is not None)
    assert packing.pack(none, vocabulary).collect() == []


def test_pii(docs, none):
    field = pii.learn(docs)
    rows = pii.find(docs, field).collect()
    assert sorted((r.doc_id for r in rows), key=str) == ALL
    assert next(r for r in rows if r.doc_id == 9).n_email == 1
    assert all(r.spans == "" for r in rows if r.doc_id in (3, 4, 5))
    assert pii.find(none, pii.learn(none)).collect() == []


def test_toxicity(docs, labels, none):
    model = toxicity.learn(docs, labels)
    rows = toxicity.score_texts(docs, model).collect()
    assert sorted((r.doc_id for r in rows), key=str) == ALL
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert all(r.score == 0 for r in rows if r.doc_id in (3, 4, 5))
    assert toxicity.keep_clean(docs, model).schema == docs.schema
    for known in (labels, labels.where("false"), labels.where("toxic = 0")):
        empty = toxicity.learn(none, known)
        assert toxicity.score_texts(none, empty).collect() == [] and toxicity.offending(none, empty).collect() == []


def test_decontamination(docs, none, items):
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, items).collect()}
    assert found == {(1, 1), (2, 1), (6, None)}
    kept = decontamination.keep_clean(docs, items)
    assert kept.schema == docs.schema and ids(kept) == sorted((i for i in ALL if i not in (1, 2, 6)), key=str)
    assert decontamination.contaminated(none, items).collect() == []
    assert decontamination.contaminated(docs, items.where("false")).collect() == []


def test_seeds_without_broadcast(docs, items, monkeypatch):
    some = sorted(map(tuple, decontamination.overlaps(docs, items).collect()), key=str)
    monkeypatch.setattr(decontamination, "BROADCAST_SEEDS", 0)
    assert sorted(map(tuple, decontamination.overlaps(docs, items).collect()), key=str) == some


def test_jaccard(docs, none):
    rows = jaccard.similar_texts(docs).collect()
    assert sorted((r.doc_id for r in rows), key=str) == ALL
    assert {r.component_id for r in rows if r.doc_id in (1, 2)} == {1}
    assert all(r.n_shingles == 0 and r.component_id == r.doc_id for r in rows if r.doc_id in (3, 4, 5))
    assert next(r for r in rows if r.doc_id == 7).n_shingles == 1
    kept = jaccard.keep_one(docs)
    assert kept.schema == docs.schema
    left = ids(kept)
    assert left.count(1) == 1 and 2 not in left and left.count(7) == 2 and {3, 4, 5, 6, 8, 9} <= set(left) and left.count(None) == 2
    assert jaccard.similar_texts(none).collect() == [] and jaccard.keep_one(none).collect() == []


def test_line_labels(docs, labels, none):
    chain = line_crf.learn(docs, labels)
    rows = line_crf.judge_texts(docs, chain).collect()
    assert sorted((r.doc_id for r in rows), key=str) == ALL
    assert all(r.base_failed and not r.kept for r in rows if r.doc_id in (3, 4, 5, 7))
    assert next(r for r in rows if r.doc_id == 6).base_failed
    assert line_crf.label_lines(docs, chain).count() == sum((r[1] or "").count("\n") + 1 for r in ROWS)
    assert line_crf.judge_texts(none, line_crf.learn(none, labels.where("false"))).collect() == []


def test_ids_of_text(docs, labels):
    named, known = (t.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string"))) for t in (docs, labels))
    said = sorted((None if i is None else f"d{i}" for i in ALL), key=str)
    assert ids(toxicity.score_texts(named, toxicity.learn(named, known))) == said
    assert ids(line_crf.judge_texts(named, line_crf.learn(named, known))) == said
    packed = packing.pack(named, packing.Vocabulary.read(), length=64).collect()
    assert len({(r.shard, i, n) for r in packed for i, n in zip(r.doc_ids, r.text_nos, strict=True)}) == len(ROWS)
    assert {i for r in packed for i in r.doc_ids} == set(said)


def test_no_labels(docs, labels):
    for known in (labels.where("false"), labels.where("toxic = 0")):
        assert {r.score for r in toxicity.score_texts(docs, toxicity.learn(docs, known)).collect()} == {0.0}
    assert not any(r.kept for r in line_crf.judge_texts(docs, line_crf.learn(docs, labels.where("false"))).collect())


def test_pages(spark):
    rows = [(1, "http://a.b/c", "<article><p>x  y</p></article>"), (1, None, None), (None, "", ""), (2, "http://a.b/c", "<p>" + "w " * 50_000), (2, "http://a.b/c", "no markup &amp; all"), (3, "//", "<")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'z' AS text", "'h' AS host")
    found = sorted((r.page_id, r.text, r.n_chars) for r in pages.main_texts(table).collect() if r.page_id in (1, 2, 3))
    assert found == [(1, "", 0), (1, "x y", 3), (2, "no markup & all", 15), (2, ("w " * 50_000).strip(), 99_999), (3, "<", 1)]
    assert pages.main_texts(table.where("false")).collect() == []


def test_shares_are_those_of_the_whole_host(spark):
    """A host's texts do not depend on how many parts its pages are dealt into, nor do copies of a page count."""
    notice = "read this long notice about how we use your data on every page today"
    rows = []
    for k in range(60):
        words = " ".join(f"own{k}word{i}" for i in range(30))
        said = [f"<p>{words}</p>"] + [f"<p>{notice}</p>"] * (k % 4 == 0) + ["<p>Seen on few</p>"] * (k % 12 == 0)
        rows += [(k, "http://h.x/a", "".join(said))] + [(1000 + k, "http://h.x/b", "".join(said))] * (k % 12 == 0) * 3
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    whole = sorted((r.page_id, r.text) for r in pages.main_texts(table).collect())
    assert len(whole) == len(rows) and not any(notice in t for _, t in whole) and sum("Seen on few" in t for _, t in whole) == 20
    assert sorted((r.page_id, r.text) for r in pages.main_texts(table, part=700).collect()) == whole


def test_quotes(spark):
    rows = [(1, 0, "u", "Hello.\nMore"), (1, 1, "a", "> Hello.\nyes"), (1, 1, "a", "> Hello.\nyes"), (1, None, "a", "> Hello."), (None, 1, None, None), (2, 0, "u", ""), (2, 1, "u", "> gone\n" * 3000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS thread", "2 AS runs")
    found = quotes.conversations(table).collect()
    assert len(found) == len(rows)
    assert {(r.parent, r.thread, r.text) for r in found if r.conv_id == 1 and r.turn == 1} == {(0, 0, "yes")}
    assert next(r for r in found if r.conv_id == 2 and r.turn == 1).n_linked == 0
    assert quotes.conversations(table.where("false")).collect() == []


def test_pipeline_runs(spark, tmp_path, docs, labels, items):
    for name, table in (("documents", docs), ("labels", labels), ("benchmark", items)):
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    taken = {i for r in rows for i in r.doc_ids}
    assert taken and not taken & {1, 2, 6}
