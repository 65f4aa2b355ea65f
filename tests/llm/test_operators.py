"""The training-data operators against brute force on small frames with nulls, ties and odd texts."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from loanlens.llm import (archives, bpe, chat, decontaminate, forest, jaccard, licenses, ppm, quality, repeats)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, s string"


def _texts() -> list[tuple[int, str | None]]:
    """Odd texts, exact and near copies, a star of near copies, shared passages, periodic text."""
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(300)] + ["é", "Ünder", "日本"]
    prose = lambda n: [rng.choice(vocab) for _ in range(n)]
    passage = prose(60)
    out = [None, "", " \n\t", "One", "one", "two words", "a b c", "A  b\nC", "x" * 49, "x" * 50, "x" * 200, "ab" * 120,
           "K İ\x00\x1c\x7f", "<|im_end|>"]
    base = prose(120)
    for _ in range(12):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = rng.choice(vocab)
        out.append(" ".join(copy))
    out += [" ".join(base), " ".join(base).upper()]
    out += [" ".join(prose(20) + passage + prose(30)) for _ in range(4)]
    out += [" ".join(prose(rng.randint(1, 150))) for _ in range(25)]
    out.append(" ".join(prose(9000)))
    out.append(out[-1][100:30_000])
    return list(enumerate(out)) + [(3, "One"), (7, "another text for the same id"), (-4, " ".join(base[:100]))]


@pytest.fixture(scope="module")
def rows():
    return _texts()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0, 1, "x") for i, t in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("k,num,den", [(3, 90, 100), (5, 8, 10), (1, 1, 2)])
def test_jaccard_components(docs, rows, nothing, k, num, den):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for a in range(len(rows)):
        least[find(a)] = min(least.get(find(a), 10 ** 9), rows[a][0])
    want = sorted((rows[a][0], len(sets[a]), least[find(a)]) for a in range(len(rows)))
    assert sorted(map(tuple, jaccard.link_components(docs, k, num, den).collect())) == want
    if k == 3:
        assert jaccard.link_components(nothing, k, num, den).count() == 0


def test_jaccard_null_id(spark):
    df = spark.createDataFrame([(None, "a b c d"), (4, "a b c d"), (None, "z"), (None, None)], "doc_id long, text string")
    got = sorted(map(tuple, jaccard.link_components(df).collect()), key=str)
    assert got == sorted([(None, 1, 4), (4, 1, 4), (None, 1, None), (None, 0, None)], key=str)


def test_repeats(docs, rows, nothing, spark):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            first[b[p:p + 50]] = min(i, first.get(b[p:p + 50], i))
    want = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < i:
                gone[p:p + 50] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    assert any(w[2] for w in want)
    got = repeats.remove_repeats(docs, keep=("lang", "n"))
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "lang", "n"]
    assert sorted(tuple(r)[:5] for r in got.collect()) == sorted(want)
    assert repeats.remove_repeats(nothing).count() == 0
    null = spark.createDataFrame([(None, "y" * 60), (1, "y" * 60), (2, "y" * 60)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_removed) for r in repeats.remove_repeats(null).collect()) == [(0, 0), (1, 0), (2, 60)]


def test_repeats_of_partly_shared_runs(spark):
    """A run of which a smaller document holds a part occurs again in its document, or in another row of its id."""
    rng = random.Random(11)
    some = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    rows = []
    for k in range(40):
        line, other = some(rng.randint(50, 130)), some(90)
        rows += [(10 * k, line), (10 * k + 1, line * 3), (10 * k + 2, line + line[:40] + line * 2)]
        rows += [(10 * k + 3, other[:60]), (10 * k + 4, some(30) + other + some(20))]
        rows += [(10 * k + 4, some(5) + other), (10 * k + 4, other + other), (10 * k + 5, other * 2)]
    first = {}
    for i, t in rows:
        for p in range(len(t) - 49):
            first[t[p:p + 50]] = min(i, first.get(t[p:p + 50], i))
    want = []
    for i, t in rows:
        gone = [any(first.get(t[q:q + 50], i) < i for q in range(max(p - 49, 0), p + 1)) for p in range(len(t))]
        want.append((i, "".join(c for c, g in zip(t, gone, strict=True) if not g)))
    for parts in (1, 3):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        assert sorted((r.doc_id, r.kept_text) for r in repeats.remove_repeats(df).collect()) == sorted(want)


def test_ppm(docs, rows, nothing):
    train = {i: zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows}
    words = [(t or "").encode().lower().split() + [None] for _, t in rows]
    c = collections.Counter(w for (i, _), ws in zip(rows, words, strict=True) if train[i] for w in ws)
    n, v = sum(c.values()), len(c)
    k = ppm.ORDER
    seen = [collections.defaultdict(collections.Counter) for _ in range(k + 1)]
    for i, t in rows:
        b = bytes(k) + (t or "").encode() + b"\xff"
        for j in range(k, len(b) if train[i] else 0):
            for o in range(k + 1):
                seen[o][b[j - o:j]][b[j]] += 1

    def code(b, j):
        out, p = set(), 1.0
        for o in range(k, -1, -1):
            q = {s: m for s, m in seen[o].get(b[j - o:j], {}).items() if s not in out}
            if q:
                total = 2 * sum(q.values())
                if b[j] in q:
                    return math.log10(p * (2 * q[b[j]] - 1) / total)
                p *= len(q) / total
                out |= set(q)
        return math.log10(p / (256 - len(out)))
    got = collections.defaultdict(list)
    for r in ppm.score(docs).collect():
        got[r.doc_id].append(r)
    for (i, t), ws in zip(rows, words, strict=True):
        b = bytes(k) + (t or "").encode() + b"\xff"
        score = sum(code(b, j) for j in range(k, len(b)))
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)
        assert any(r.held_out != train[i] and r.train_tokens == n and r.n_tokens == len(ws)
                   and r.n_known == sum(c[w] > 0 for w in ws) and math.isclose(r.base_score, base, rel_tol=1e-9)
                   and math.isclose(r.score, score, rel_tol=1e-4, abs_tol=1e-6) for r in got[i]), (i, score, got[i])
    assert ppm.score(nothing).count() == 0


def test_ppm_probabilities_sum_to_one():
    data = np.frombuffer(b"abracadabra abracad", np.uint8).astype(np.uint64)
    codes = sum(np.concatenate([np.zeros(k, np.uint64), data[:len(data) - k]]) << np.uint64(8 * k) for k in range(5))
    u, n = np.unique(codes, return_counts=True)
    pairs = np.zeros((256, 256), np.int64)
    np.add.at(pairs, ((codes >> np.uint64(8) & np.uint64(255)).astype(int), (codes & np.uint64(255)).astype(int)), 1)
    context = u[7] >> np.uint64(8)
    every = (context << np.uint64(8)) | np.arange(256, dtype=np.uint64)
    both = np.union1d(u, every)
    count = np.zeros(len(both))
    count[np.searchsorted(both, u)] = n
    p = 10 ** ppm.log_probabilities(both, count, pairs)
    assert math.isclose(p[np.searchsorted(both, every)].sum(), 1, rel_tol=1e-9)


def test_decontamination(spark, docs, rows, nothing):
    long = rows[-4][1].split()
    items = [(1, " ".join(long[50:80])), (10, " ".join(long[60:73]).upper()), (2, "Two, WORDS"), (3, None), (4, "??"),
             (None, "one"), (5, "c a b c"), (1, "日本 é"), (6, "x" * 50)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = collections.defaultdict(set)
    for i, t in items:
        w = decontaminate.normal_words(t)
        for j in range(max(len(w) - 12, 1)):
            if w:
                windows[tuple(w[j:j + 13])].add(None if i is None else str(i))
    want = []
    for i, t in rows:
        w, hit, found = decontaminate.normal_words(t), set(), set()
        for j in range(len(w)):
            for n in range(1, 14):
                if tuple(w[j:j + n]) in windows and j + n <= len(w):
                    hit |= set(range(j, j + n))
                    found |= windows[tuple(w[j:j + n])]
        names = ",".join(sorted(x for x in found if x is not None))
        want.append((i, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(),
                     bool(hit) and 20 * len(hit) >= len(w)))
    assert sum(x[2] > 0 for x in want) > 2
    got = decontaminate.scan(docs, bench, keep=["n", "s"], clean=True)
    assert sorted(tuple(r) for r in got.select(*decontaminate.COLUMNS).collect()) == sorted(want)
    clean = {r.doc_id: r.clean_text for r in got.collect()}
    assert clean[5] == "" and clean[3] == ""
    clash = decontaminate.scan(docs.select("doc_id", "text", F.col("n").alias("n_hit"), F.col("s").alias("_text")), bench,
                               keep=["n_hit", "_text"])
    assert clash.columns == ["doc_id", "doc_n_hit", "_text", *decontaminate.COLUMNS[1:], "longest_match"]
    assert {(r.doc_n_hit, r._text) for r in clash.collect()} == {(1, "x")}
    assert decontaminate.scan(nothing, bench).count() == 0
    assert decontaminate.scan(docs, bench.where("false")).where("n_hit > 0").count() == 0


def test_decontamination_in_several_blocks(spark, docs, rows, monkeypatch):
    """Many blocks give what one gives; tasks build them, and the driver reads no item."""
    long = rows[-4][1].split()
    items = [(i, " ".join(long[7 * i:7 * i + 20])) for i in range(60)] + [
        (70, "Two, WORDS"), (71, None), (5, "c a b c"), (1, "日本 é"), (6, "x" * 50), (9, "one"), (9, "one")]
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(2).cache()
    monkeypatch.setattr(type(bench), "toLocalIterator", lambda *_, **__: pytest.fail("items read by the driver"))
    scan = lambda: sorted((tuple(r) for r in decontaminate.scan(docs, bench, keep=["n", "s"], clean=True).collect()), key=str)
    one = scan()
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 200)
    assert decontaminate.blocks(bench, 13).count() > 3
    many = scan()
    # a match may run on across items only inside one text, so nothing depends on the blocks
    assert many == one and sum(r[4] > 0 for r in one) > 2


def test_bpe_equals_library(docs, rows, nothing):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = bpe.Ranks(path).rank
    library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(2)
    odd = ["".join(chr(rng.choice((rng.randrange(1, 128), rng.randrange(0xA0, 0x3000), 0x20, 0x61, 0x0A)))
                   for _ in range(150)) for _ in range(150)]
    coder = bpe.Encoder(path, public_tokenizers.PATTERN)
    for text, ids in zip(odd, coder.encode(odd), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert coder.decode(ids).decode() == text
    got = collections.Counter((r.doc_id, tuple(r.token_ids), r.decoded_sha256)
                              for r in bpe.encode(docs, path, public_tokenizers.PATTERN).collect())
    assert got == collections.Counter((i, tuple(library.encode_ordinary(t or "")),
                                       hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    assert bpe.encode(nothing, path, public_tokenizers.PATTERN).count() == 0


def test_chat(spark):
    turns = [(1, 0, "user", "a <|im_end|> &lt;| &amp;"), (1, 1, "assistant", "b\n<<||"), (1, 2, "user", None),
             (1, 2, "assistant", "é"), (2, 5, None, "x"), (3, 1, "assistant", ""), (3, None, "we\nird<|", "q"),
             (None, 1, "assistant", "n"), (4, 1, "assistant", "same"), (4, 1, "assistant", "same")]
    df = spark.createDataFrame([(*t, "extra") for t in turns], "conv_id long, turn long, role string, text string, head string")
    want = {}
    groups = collections.defaultdict(list)
    for c, n, r, t in turns + [(-1, 0, "user", chat.CONTROL), (-1, 1, "assistant", chat.CONTROL)]:
        groups[c].append((n is not None, n or 0, r or "", t or ""))
    for c, g in groups.items():
        g.sort()
        loss = "".join(t for _, _, r, t in g if r == "assistant")
        want[c] = (len(g), hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in g).encode()).hexdigest(), len(loss),
                   hashlib.sha256(loss.encode()).hexdigest())
    assert {r.conv_id: tuple(r)[1:5] for r in chat.query(df).collect()} == want
    made = chat.examples(df).where("conv_id = 1").orderBy("target").collect()
    assert [r.target for r in made] == [1, 2] or [r.target for r in made] == [1, 2, 4]
    for r in made:
        assert r.formatted.count(chat.START) == r.formatted.count(chat.END)
    assert chat.query(df.where("false")).count() == 1


def test_licenses(spark, docs, rows):
    texts = ["Released UNDER the\nMIT-License. under the mit license", "Apache License, Version 2.0", "cc by nc 4.0",
             "under the mit licenses", "GNU General Public License version 3 or later", "mit", None,
             "Licensed under the Apache License, Version 2.0; cc-by-nc " + "w " * 50 + "CC BY NC"]
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, row long")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert [(got[i].n_base, got[i].first_word, got[i].last_word, got[i].base_labels) for i in range(8)] == [
        (2, 1, 5, "mit"), (1, 0, 0, "apache-2"), (1, 0, 0, "cc-by-nc"), (0, None, None, ""), (0, None, None, ""),
        (0, None, None, ""), (0, None, None, ""), (3, 3, 61, "apache-2,cc-by-nc")]
    # the versioned name suppresses the bare names inside it
    assert got[4].labels == "gpl-3" and got[4].score > 0.5 and got[5].labels == "" and got[6].n_words == 0
    table = np.ones(256, bool)
    want = collections.Counter((i, len(decontaminate.normal_words(t))) for i, t in rows)
    assert table.all() and collections.Counter((r.doc_id, r.n_words) for r in licenses.scan(docs).collect()) == want
    assert licenses.scan(df.where("false")).count() == 0


def test_license_rules():
    rules = licenses.rules()
    assert len(rules) > 300
    for label, pattern, key, _, _, _ in rules:
        words = pattern.replace("licen[cs]e", "license").replace("licen[cs]ed", "licensed")
        assert any(stem in words for stem in licenses.STEMS), label
        assert key in words


def test_archives(spark):
    big = "<p>é</p>\r\n\r\nWARC/1.0\r\n" * 60
    pages = [(1, "http://a b/\n", big), (2, None, big), (9, "u", big), (3, "u", None), (4, "u", "x"), (5, "u", "x"),
             (None, "u", "lost"), (6, "filedesc://x", "URL IP-address\n\n1 0 x\n" * 70)]
    want = set()
    pages += [(None, "u", big), (None, None, "<p>no id</p>" * 100)]
    for i, _, h in pages:
        raw = (h or "").encode()
        best = max((j for j, _, g in pages if g == h and j is not None), default=None)
        again = len(raw) >= 1000 and best not in (i, None)
        want.add((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", best if again else None))
    df = spark.createDataFrame([(*p, 0) for p in pages], "page_id long, url string, html string, n long")
    got = archives.round_trip(df)
    assert archives.round_trip(df.where("false")).count() == 0
    assert {tuple(r) for r in got.select(*archives.COLUMNS).collect()} == want and got.count() == len(want)
    ids = {r.page_id: r for r in got.collect()}
    assert ids[1].target_uri == "http://a%20b/%0A" and len({r.record_id for r in got.collect()}) == len(want)
    assert archives.round_trip(df.where("page_id = 4")).count() == 1


def test_archives_with_many_revisits(spark, monkeypatch):
    """Revisits beyond the map's memory are joined, not broadcast, with equal results."""
    pages = [(i, "u", f"<p>{i % 40}</p>" * 200) for i in range(200)] + [(7, "u", "<p>8</p>" * 200), (7, None, None)] + [
        (None, "u", "<p>9</p>" * 200)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    rows = lambda: sorted(tuple(r) for r in archives.round_trip(df).select(
        F.coalesce("page_id", F.lit(-1)), "payload_digest", "record_type", "record_id", F.coalesce("refers_to", F.lit(-1))).collect())
    few = rows()
    assert len(few) == 203 and sum(r[2] == "revisit" for r in few) == 162
    monkeypatch.setattr(archives, "MAP_BYTES", 100 * archives.ENTRY_BYTES)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda *_: pytest.fail("too many revisits for a broadcast"))
    assert rows() == few


def test_archive_versions():
    records = [(7, "http://x/", b"a\n\nb"), (8, "http://y/", b"")]
    for version in (1, 2):
        raw = archives.arc_file(version, "n.arc", records) + b"\n"
        assert [(r[0], r[5], r[6]) for r in archives.arc_records(raw)] == [(version, b"a\n\nb", 7), (version, b"", 8)]
        with pytest.raises(ValueError):
            list(archives.arc_records(archives.arc_file(version, "n.arc", records[:1])[:-2]))
    assert archives.iso_date("199912312359") == "1999-12-31T23:59:00Z"


def test_forest(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((900, 16)) * rng.uniform(0.5, 2, (900, 1))
    x[100:200] = x[0]
    data = [(i, v.tolist()) for i, v in enumerate(x)] + [
        (2000, None), (2020, [0.0] * 16), (2040, [float("nan")] + [1.0] * 15), (2060, [None] + [1.0] * 15),
        (2080, []), (2100, [1.0] * 3), (None, x[1].tolist())]
    df = spark.createDataFrame([(i, v, 1) for i, v in data], "vec_id long, embedding array<double>, score int")
    got = collections.defaultdict(list)
    for r in forest.nearest(df, block_rows=400).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert sorted(got) == list(range(0, 900, 20))
    hits = 0
    for q, found in got.items():
        s = x @ x[q]
        best = sorted((i for i in range(900) if i != q), key=lambda i: (-s[i], i))[:20]
        assert [r for r, _, _ in found] == list(range(1, 21)) and q not in [i for _, i, _ in found]
        assert all(math.isclose(v, s[i], rel_tol=1e-12) for _, i, v in found)
        assert [(-v, i) for _, i, v in found] == sorted((-v, i) for _, i, v in found)
        hits += len({i for _, i, _ in found} & set(best))
    assert hits / (20 * len(got)) >= 0.9
    assert [i for _, i, _ in got[0]][:3] == [100, 101, 102] or x[0] @ x[0] < max(x @ x[0])
    assert forest.nearest(df.where("false")).count() == 0
    assert forest.nearest(df.where("vec_id in (0, 5)")).count() == 1


def test_forest_with_a_tight_group(spark):
    """Queries of a group of nearly equal vectors, with whom all trees agree, still get all their rows."""
    rng = np.random.default_rng(11)
    x = rng.standard_normal((500, 32))
    x[:221:20] = x[0] + 1e-7 * rng.standard_normal((12, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in forest.nearest(df).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert all(len(got[q]) == 20 for q in range(0, 500, 20))
    for q in range(0, 221, 20):
        assert set(got[q][:11]) == set(range(0, 221, 20)) - {q}


def test_kept_columns_with_clashing_names(spark, docs):
    labels = spark.createDataFrame([(5, 1, 0)], "doc_id long, quality int, toxic int")
    odd = docs.select("doc_id", "text", F.lit(1).alias("score"), F.lit("x").alias("n_bytes"), F.lit(2).alias("doc_score"))
    got = quality.classify(odd, labels, keep=["score", "doc_score"])
    assert got.columns == ["doc_id", "doc_score", "doc_doc_score", "held_out", "score", "predicted"]
    assert {(r.doc_score, r.doc_doc_score) for r in got.collect()} == {(1, 2)}
    got = repeats.remove_repeats(odd, keep=("n_bytes",))
    assert got.columns[-1] == "doc_n_bytes" and {r.doc_n_bytes for r in got.collect()} == {"x"}


def test_quality(spark, nothing):
    rng = random.Random(4)
    good = lambda: "\n".join(" ".join(rng.choice(["the", "reth", "on", "ing"]) for _ in range(9)) + "." for _ in range(4))
    bad = lambda: "\n".join(" ".join(rng.choice(["a$$$", "b###", "c%%%"]) for _ in range(9)) for _ in range(4))
    texts = [(i, good() if i % 3 else bad()) for i in range(300)]
    df = spark.createDataFrame([(i, t, 0.5, 9) for i, t in texts] + [(900, None, 0.1, 1), (901, "", 0.1, 1), (None, "x", 0.1, 1)],
                               "doc_id long, text string, score double, predicted int")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i, _ in texts] + [(1, None, 0), (None, 1, 1), (5555, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.classify(df, labels).collect()}
    assert len(got) == 303 and all(0 <= r.score <= 1 for r in got.values())
    for i, _ in texts:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert got[i].predicted == int(i % 3 > 0)
    assert got[900].score == got[901].score and not got[None].held_out
    assert quality.classify(nothing, labels).count() == 0
    assert {r.score for r in quality.classify(df, labels.where("false")).collect()} == {0.5}


def test_jaccard_cells_and_folded_parities(spark, docs, monkeypatch):
    """Cells of two rows a side find what large ones find; folding a signature gives the shorter one's parities."""
    rng = np.random.default_rng(2)
    for n in (40, 90, 127, 129, 200, 1100, 3000):
        s = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        words = jaccard._parities(s)
        assert len(words) in (4, 8, 16, 32) and (64 * len(words) >= 2 * len(s) or len(words) == 32)
        bits = np.unpackbits(words.view(np.uint8))
        half = np.bincount((s >> np.uint64(53)).astype(np.int64) & (len(bits) // 2 - 1), minlength=len(bits) // 2) & 1
        assert np.array_equal(bits[:len(bits) // 2] ^ bits[len(bits) // 2:], half)
    a, b = (np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (120, 140))
    b = np.union1d(a[:110], b[:25])
    df = spark.createDataFrame([(jaccard._parities(a).tolist(), jaccard._parities(b).tolist())], "a array<long>, b array<long>")
    low, high = df.select(jaccard._flips(F.col("a"), F.col("b")), jaccard._flips(F.col("b"), F.col("a"))).first()
    assert low == high and 0 < low <= len(np.setxor1d(a, b)) and (low - len(np.setxor1d(a, b))) % 2 == 0
    found = lambda: sorted(tuple(r) for r in jaccard.link_components(docs, 5, 8, 10).na.fill(-99).collect())
    large = found()
    monkeypatch.setattr(jaccard, "CELL", 2)
    assert found() == large and len({r[2] for r in large}) < len(large)
