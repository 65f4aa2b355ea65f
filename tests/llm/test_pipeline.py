"""The corpus pipeline against its operators' brute-force meaning on the smallest table."""

import json

import corpus_pipeline
from loanlens.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    before = {r.doc_id: r for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    columns = set(docs.columns)
    kept = None
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        rows = docs.collect()
        if name != "tokens":
            assert set(docs.columns) == columns
        ids = [r.doc_id for r in rows]
        assert len(ids) == len(set(ids)) and (kept is None or set(ids) <= kept)
        kept = set(ids)
        if name == "quality":
            good = [i for i, q in labels.items() if q == 1 and i in before]
            assert sum(i in kept for i in good) >= 0.98 * len(good)
            bad = [i for i, q in labels.items() if q == 0 and i in before]
            assert sum(i in kept for i in bad) <= 0.3 * len(bad)
        if name == "near_duplicates":
            words = [tuple(r.text.encode().lower().split()) for r in rows]
            assert len(set(words)) == len(words)
        if name == "repeats":
            assert all(r.n_chars == len(r.text) for r in rows)
    assert json.dumps([n for n, _ in corpus_pipeline.STAGES])


def test_null_rows(spark):
    docs = spark.createDataFrame(
        [(None, "a b c d e f", "en", "s", 1), (None, "a b c d e f", "en", "s", 1), (1, None, "en", "s", 1),
         (2, "a b c d e f", None, None, None), (2, "a b c d e f", None, None, None), (3, "a b c d e f", "x", "y", 2)],
        "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id or 0, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()), key=str)
    assert got == sorted([(0, "a b c d e f"), (0, "a b c d e f"), (1, None), (2, "a b c d e f")], key=str)
    for name, stage in corpus_pipeline.STAGES[2:]:
        assert stage(spark, docs.where("false"), SF).count() == 0
        docs = stage(spark, docs, SF)


def test_equal_ids_with_different_texts(spark):
    """Rows are judged, not ids: a unique text stays though its id occurs again, a linked copy goes."""
    x, y, z = (" ".join(f"{c}{i}" for i in range(30)) for c in "xyz")
    docs = spark.createDataFrame(
        [(1, x, "en", "s", 1), (2, x, "en", "s", 1), (2, y, "en", "s", 1), (2, y, "en", "s", 1), (3, y, "en", "s", 1),
         (4, z, None, "en", 1), (4, z, "en", None, 1), (5, None, "en", "s", 1), (5, "", "en", "s", 1), (5, z, "en", "s", 1),
         (6, "a", None, None, None), (6, "b", None, None, None)],
        "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs.repartition(3), SF).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, x), (2, y), (4, z), (5, None), (5, ""), (6, "a"), (6, "b")], key=str)


def test_benchmark_spans_of_long_documents(spark, tmp_path):
    """An item inside a document that is not contaminated as a whole is cut out of it."""
    item, before, after = (" ".join(f"{c}{i}" for i in range(n)) for c, n in (("q", 15), ("a", 300), ("b", 300)))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(
        [(1, f"{before}. {item.upper()}! {after}", "en", "s", 1), (2, f"{item} and more", "en", "s", 2),
         (3, "Clean, É", None, None, None), (4, None, "en", "s", 7)],
        "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.decontaminated(spark, docs, str(tmp_path))
    assert got.schema.simpleString() == docs.schema.simpleString()
    cut = f"{before}. ! {after}"
    assert sorted(map(tuple, got.collect())) == [
        (1, cut, "en", "s", len(cut)), (3, "Clean, É", None, None, None), (4, None, "en", "s", 7)]
