"""Language ID: held-out accuracy, the parts of the learner, and odd rows."""

import random
import zlib

import numpy as np
import pytest

from loanlens.llm import language, queries

SCHEMA = "doc_id long, text string, lang string, score double, held_out string"


def texts(n=240):
    rng = random.Random(9)
    parts = {"aa": ["the", "ing", "er", "on", "wh"], "bb": ["eau", "é", "ment", "ou", "que"], "cc": ["sch", "ung", "ü", "ei", "en"]}
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(parts))
        words = ["".join(rng.choices(parts[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(5, 60))]
        rows.append((i, " ".join(words), lang))
    return rows


@pytest.fixture(scope="module")
def rows():
    return texts()


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0.5, "x") for r in rows], SCHEMA)


def test_held_out_accuracy_and_odd_rows(spark, rows):
    odd = [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 34 !", "cc"), (1003, "the " * 400_000, "bb"),
           (None, "thewher ingon wher", None), (1004, "ü", None), (5, rows[5][1], rows[5][2])]
    docs = frame(spark, rows + odd)
    found = language.identify(docs)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    got = found.collect()
    assert len(got) == len(rows) + len(odd)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got if r["doc_id"] is not None)
    assert all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert [by[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3
    assert by[1003]["lang_pred"] == "aa" and by[None]["lang_pred"] == "aa"
    truth = {i: lang for i, _, lang in rows}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97


def test_labels_of_held_out_rows_do_not_matter(spark, rows):
    swapped = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 3 == 1 else lang) for i, t, lang in rows]
    one, two = (sorted(map(tuple, language.identify(frame(spark, r)).collect())) for r in (rows, swapped))
    assert one == two


def test_nothing_to_learn_from(spark):
    got = language.identify(frame(spark, [(1, "some text", None), (2, None, "aa")])).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)}
    assert language.identify(frame(spark, [])).count() == 0


def test_driver_table(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = [r for r in queries.op12_language_id(spark, sf).collect() if r["held_out"] and r["lang_pred"] != "und"]
    right = np.array([r["lang_pred"] == truth[r["doc_id"]] for r in got])
    assert right.mean() > 0.95
    assert abs(np.mean([r["score"] for r in got]) - right.mean()) < 0.05    # calibrated


def test_document_frequency(spark, rows):
    n, holds = language.document_frequency(frame(spark, rows + [(7, "..", "aa")]).repartition(3))
    want = np.zeros(language.BUCKETS, np.int64)
    for _, t, _ in rows:
        want[np.unique(np.concatenate(language.ngrams(t)))] += 1
    assert n == len(rows) and np.array_equal(holds, want)


def test_model_gives_the_value_of_its_features():
    rng = np.random.default_rng(2)
    w = np.zeros((language.BUCKETS, 3))
    text = "Zwei Wörter, two words"
    idx, share = language.features(text)
    w[idx[::2]] = rng.standard_normal((len(idx[::2]), 3))
    some = np.flatnonzero(np.abs(w).sum(1) > 0)
    place = np.zeros(language.BUCKETS, np.int32)
    place[some] = np.arange(1, len(some) + 1)
    model = language.Model(["a", "b", "c"], place, np.concatenate([np.zeros((1, 3)), w[some]]), np.array([1.0, 2.0, 3.0]), 1.0)
    assert np.allclose(model.logits(text), share @ w[idx] + [1, 2, 3])
    assert language.ngrams("12 ,") is None and len(language.ngrams("a")) == 2


def test_ftrl_gives_sparse_weights_that_separate():
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 200)
    rows = [(np.array([10 + c, 20, 30 + rng.integers(0, 50)]), np.array([1.0, 1.0, 0.02])) for c in y]
    w, b = language.fit(rows, y, 2)
    assert all(np.argmax(x @ w[i] + b) == c for (i, x), c in zip(rows, y, strict=True))
    assert np.abs(w[30:80]).sum(1).astype(bool).mean() < 0.6 and not w[100:].any()


def test_temperature_is_the_least_of_a_grid():
    rng = np.random.default_rng(5)
    z = rng.standard_normal((500, 4)) * 3
    y = np.array([rng.choice(4, p=p) for p in language.softmax(z / 2.5)])
    loss = lambda t: -np.log(language.softmax(z / t)[np.arange(500), y]).mean()
    t = language.temperature(z, y)
    assert loss(t) <= min(loss(g) for g in np.linspace(0.5, 10, 500)) + 1e-9
