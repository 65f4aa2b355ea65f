"""N-gram Jaccard join: prefix tokens under several global orders.

Documents are sets of distinct k-word shingles. Two documents link when
``den * |A & B| >= num * |A | B|``. Any linked pair shares at least one token among the first
``n - ceil(num * n / den) + 1`` tokens of each set, in *every* global token order. Three orders are
used; all put rare tokens first (by the power of two of the corpus frequency, counted over all
documents) and differ in how a seeded hash arranges tokens of like frequency. A pair is verified
only if it shares a prefix token under each of them, at ranks that leave enough tokens for the
overlap it needs. Parities of hash buckets, as many as the set asks for, bound the difference of
two sets inside the join, so unlike pairs never become rows. A token's documents meet in cells of at
most ``CELL`` rows a side, so one very common token is spread over many tasks.

Groups of copies never expand into all pairs. Equal sets collapse into one class first. Classes
with equal minimum hashes are compared with one leader only (the class made of the commonest tokens),
and verified links give provisional components; the exact pass then emits only pairs whose provisional components differ (pairs
inside one are already connected). Nothing is capped: every pair of different components that
passes the filters is verified by intersecting the whole sets.

Defined results: NULL or wordless texts have n = 0, link with nothing and are their own component;
repeated rows are equal sets and link; rows with equal doc_id and different texts are separate
rows; a NULL doc_id takes part in links, and a component's id is its smallest non-NULL doc_id.
Tokens and classes are 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from . import textkit as T
from .common import components, cut_lineage, small, written

_U = np.uint64
ORDERS = 3
_SEED = [_U(0x243F6A8885A308D3), _U(0x13198A2E03707344), _U(0xA4093822299F31D0)]
_LOW = _U((1 << 24) - 1)
#: Words (of 64 buckets) of a parity signature: at least two buckets a token, between these two.
SIGNATURE = (4, 32)
#: Rows of one side of a token's cell in the candidate join.
CELL = 256


def _sets(data, offs, k):
    hashes, per_doc = T.word_hashes(data, offs)
    return list(T.shingle_sets(hashes, per_doc, k))


def _chunk_sets(chunk: X.Chunk, k: int) -> list[np.ndarray]:
    """Shingle sets of a packed chunk, hashed in smaller pieces."""
    out = []
    texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(chunk.ids),
                                             [None, pa.py_buffer(chunk.offs), pa.py_buffer(chunk.data)])
    for _, data, offs in T.chunks(texts):
        out += _sets(data, offs, k)
    return out


def _codes(sets: list[np.ndarray], parts: int):
    """Distinct 40-bit token codes of a chunk, documents holding each, and where each hash range begins."""
    flat = np.concatenate([*sets, np.zeros(0, np.uint64)]) >> _U(24)
    codes, counts = np.unique(flat, return_counts=True)
    top = (codes >> _U(24)).astype(np.int64)
    cuts = np.searchsorted(top, -(-np.arange(parts + 1) * 65536 // parts))
    return codes, counts, top, cuts


def _ask_frequency(k: int, parts: int):
    def fn(chunk):
        codes, counts, top, cuts = _codes(_chunk_sets(chunk, k), parts)
        out = []
        for p in range(parts):
            a, b = int(cuts[p]), int(cuts[p + 1])
            if a == b:
                continue
            tops, per = np.unique(top[a:b], return_counts=True)
            more = np.flatnonzero(counts[a:b] > 1).astype(np.uint32)
            low = (codes[a:b] & _LOW).astype(np.uint32).view(np.uint8).reshape(-1, 4)[:, :3]
            head = np.array([b - a, len(tops), len(more)], np.int64).tobytes()
            out.append((p, head + tops.astype(np.uint16).tobytes() + per.astype(np.uint32).tobytes()
                        + more.tobytes() + counts[a:b][more].astype(np.uint32).tobytes() + low.tobytes()))
        return out
    return fn


def _frequency(bodies: list[bytes]) -> list[bytes]:
    """Power of two of every asked token's document frequency, one byte each."""
    codes, counts = [], []
    for body in bodies:
        n, tops, more = np.frombuffer(body, np.int64, 3)
        at = 24
        top = np.frombuffer(body, np.uint16, tops, at)
        at += 2 * tops
        per = np.frombuffer(body, np.uint32, tops, at)
        at += 4 * tops
        where = np.frombuffer(body, np.uint32, more, at)
        at += 4 * more
        times = np.frombuffer(body, np.uint32, more, at)
        at += 4 * more
        low = np.zeros((n, 4), np.uint8)
        low[:, :3] = np.frombuffer(body, np.uint8, 3 * n, at).reshape(n, 3)
        codes.append((np.repeat(top, per).astype(np.uint64) << _U(24)) | low.view(np.uint32)[:, 0])
        one = np.ones(n, np.uint32)
        one[where] = times
        counts.append(one)
    flat = np.concatenate(codes)
    order = np.argsort(flat, kind="stable")
    new = np.ones(len(flat), bool)
    new[1:] = flat[order][1:] != flat[order][:-1]
    total = np.add.reduceat(np.concatenate(counts)[order].astype(np.int64), np.flatnonzero(new))
    power = np.empty(len(flat), np.uint8)
    power[order] = (np.log2(total).astype(np.uint8))[np.cumsum(new) - 1]
    cuts = np.cumsum([0, *map(len, codes)])
    return [X.squeeze(power[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


_PROFILE = ("doc_id long, n long, own long, common double, cid long, bits array<long>, low array<long>, pre array<array<long>>")


def _profile(k: int, num: int, den: int, parts: int):
    """Per document: set size, tokens that no other document has, mean rarity, class, minimum hashes, and
    the prefix tokens under each order that another document has too."""
    def fn(chunk, answers):
        sets = _chunk_sets(chunk, k)
        codes, _, _, _ = _codes(sets, parts)
        power = np.concatenate([*(np.frombuffer(X.unsqueeze(answers[p]), np.uint8) for p in sorted(answers)),
                                np.zeros(0, np.uint8)])
        n, own, common, cid, bits, low, pre = [], [], [], [], [], [], []
        for s in sets:
            m = len(s)
            n.append(m)
            if not m:
                own.append(0)
                common.append(0.0)
                cid.append(0)
                bits.append([])
                low.append([])
                pre.append([[]] * ORDERS)
                continue
            cid.append(_class_of(s))
            rarity = power[np.searchsorted(codes, s >> _U(24))]
            shared = rarity > 0
            bits.append(_parities(s).tolist())
            own.append(m - int(shared.sum()))
            common.append(float(rarity.mean()))
            keep = m - -(-num * m // den) + 1
            mins, rows = [], []
            for seed in _SEED:
                h = T.mix64(s ^ seed)
                mins.append(int(s[np.argmin(h)].view(np.int64)))
                if not shared.any():
                    rows.append([])
                    continue
                key = (rarity.astype(np.uint64) << _U(56)) | (h >> _U(8))
                first = np.argpartition(key, keep - 1)[:keep] if keep < m else np.arange(m)
                first = first[shared[first]]
                rows.append(s[first[np.argsort(key[first])]].view(np.int64).tolist())
            low.append(mins)
            pre.append(rows)
        return pa.table({"doc_id": chunk.id_column(), "n": pa.array(n, pa.int64()),
                         "own": pa.array(own, pa.int64()), "common": pa.array(common, pa.float64()),
                         "cid": pa.array(cid, pa.int64()),
                         "bits": pa.array(bits, pa.list_(pa.int64())), "low": pa.array(low, pa.list_(pa.int64())),
                         "pre": pa.array(pre, pa.list_(pa.list_(pa.int64())))})
    return fn


def _parities(s: np.ndarray) -> np.ndarray:
    """Parities of the set's tokens in hash buckets, packed; half as many buckets are the two halves XORed."""
    low, high = SIGNATURE
    words = min(high, max(low, 1 << max(0, (2 * len(s) - 1) >> 6).bit_length()))
    bucket = (s >> _U(53)).astype(np.int64) & (64 * words - 1)
    return np.packbits((np.bincount(bucket, minlength=64 * words) & 1).astype(np.uint8)).view(np.int64)


def _flips(a: Column, b: Column) -> Column:
    """Buckets in which two parity signatures differ; the longer one is folded to the shorter one's length."""
    def to(x, y):
        half = F.size(x) / 2
        folded = F.zip_with(F.slice(x, 1, half.cast("int")), F.slice(x, half.cast("int") + 1, half.cast("int")),
                            lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(x) > F.size(y), folded).otherwise(x)
    return F.aggregate(F.zip_with(to(a, b), to(b, a), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0),
                       lambda n, x: n + x)


def _class_of(s: np.ndarray) -> int:
    """64-bit identifier of a non-empty token set."""
    with np.errstate(over="ignore"):
        both = np.array([np.bitwise_xor.reduce(T.mix64(s + _SEED[0])), np.sum(T.mix64(s + _SEED[1])), len(s)],
                        np.uint64)
        return int(T.mix64(both[:1] + T.mix64(both[1:2]) + both[2:]).view(np.int64)[0])


def _sets_of(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """Whole shingle sets (cid, s) of the classes in ``wanted(doc_id, cid)``; texts of other documents
    are not hashed."""
    def run(batches):
        for batch in batches:
            for _, data, offs in T.chunks(batch.column(0)):
                sets = [s for s in _sets(data, offs, k) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_class_of(s) for s in sets], pa.int64()),
                     pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["cid", "s"])
    wanted = cut_lineage(wanted.distinct())
    n = wanted.count()
    ids = wanted.select(F.col("doc_id").alias("wid")).distinct()
    sets = docs.join(small(ids, n), docs["doc_id"].eqNullSafe(ids["wid"]), "left_semi").select("text").mapInArrow(
        run, "cid long, s array<long>")
    # repeated ids may bring sets that nobody asked for, or the same set twice
    return sets.join(small(wanted.select("cid").distinct(), n), "cid", "left_semi").dropDuplicates(["cid"])


def _verified(pairs: DataFrame, where: DataFrame, docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of classes whose whole sets are similar enough."""
    pairs = cut_lineage(pairs)
    ids = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    sets = written(_sets_of(docs, where.join(ids, "cid").select("doc_id", "cid"), k), "sets")
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(sets.select(F.col("cid").alias("a"), F.col("s").alias("sa")), "a")
            .join(sets.select(F.col("cid").alias("b"), F.col("s").alias("sb")), "b")
            .where(both * (den + num) >= num * (F.size("sa") + F.size("sb")))
            .select("a", "b"))


def link_components(docs: DataFrame, k: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    ``k``: words of a shingle; documents link when ``den * intersection >= num * union``.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    parts = X.ranges(docs)
    blobs = X.pack(docs)
    asks = X.ask(blobs, _ask_frequency(k, parts))
    profile = written(X.meet(blobs, X.answer(asks, _frequency), _profile(k, num, den, parts), _PROFILE),
                      "profile")
    # one class per distinct set, found again by its smallest doc_id
    filled = profile.where("n > 0")
    classes = cut_lineage(filled.groupBy("cid").agg(
        F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.min("own").alias("own"),
        F.max("common").alias("common"), F.first("bits").alias("bits"), F.first("low").alias("low"), F.first("pre").alias("pre")))
    place = classes.select("doc_id", "cid")

    def alike(x, y):
        """Sizes and tokens of their own allow the two sets enough in common.

        Linked sets differ by at most ``(n + m) * (den - num) / (den + num)`` tokens, and by at least
        twice the tokens that only one of them has, corrected by the difference in size. Every
        differing token flips the parity of one hash bucket.
        """
        n, m, u, v = (F.col(f"{s}.{c}") for c in ("n", "own") for s in (x, y))
        return ((F.least(n, m) * den >= F.greatest(n, m) * num)
                & (F.greatest(2 * u + m - n, 2 * v + n - m) * (den + num) <= (n + m) * (den - num))
                & (_flips(F.col(f"{x}.bits"), F.col(f"{y}.bits")) * (den + num) <= (n + m) * (den - num)))

    def in_reach(x, i, y, j):
        """Were this the first token the two share, enough tokens would follow for the overlap they need."""
        n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
        return F.least(n - i, m - j) * (den + num) >= (n + m) * num

    # 1. leaders: classes with an equal minimum hash meet the one made of the commonest tokens,
    #    which in a group of near copies is the text they were made from
    low = classes.select(F.struct("cid", "n", "own", "bits", "common").alias("s"), F.posexplode("low").alias("o", "t"))
    lead = low.groupBy("o", "t").agg(F.max_by("s", F.struct("s.common", "s.cid")).alias("l"),
                                     F.count("*").alias("c")).where("c > 1")
    pairs = (low.join(lead, ["o", "t"]).where(F.col("s.cid") != F.col("l.cid")).where(alike("s", "l"))
             .select(F.least("s.cid", "l.cid").alias("a"), F.greatest("s.cid", "l.cid").alias("b")).distinct())
    links = cut_lineage(_verified(pairs, place, docs, k, num, den))
    first = cut_lineage(components(links))

    # 2. every pair across provisional components that shares a prefix token under each order
    labelled = cut_lineage(classes.join(first, F.col("cid") == F.col("v"), "left").select(
        F.struct("cid", "n", "own", "bits").alias("s"), "cid", "pre", F.coalesce("root", "cid").alias("root")))
    sides = labelled.select("cid", "s")
    found = None
    for o in range(ORDERS):
        post = labelled
        if found is not None:
            ids = found.select(F.col("a").alias("cid")).union(found.select("b")).distinct()
            post = post.join(ids, "cid", "left_semi")
        # tokens of one document only come first in every order, so a shared token's rank is theirs plus its place
        post = cut_lineage(post.select("cid", "root", F.col("s.own").alias("own"), F.posexplode(F.col("pre")[o]).alias("i", "t"))
                           .select("cid", "root", "t", (F.col("own") + F.col("i")).alias("i")))
        # of a token's documents, those outside its commonest component meet all the others; pairs are
        # judged inside the join, so neither copies of one component nor unlike pairs are ever rows
        mode = (post.groupBy("t", "root").count().groupBy("t")
                .agg(F.max_by("root", F.struct("count", "root")).alias("mode"), F.count("*").alias("c"),
                     F.sum("count").alias("rows"), F.max("count").alias("most"))
                .where("c > 1").select("t", "mode", F.ceil(F.col("rows") / CELL).cast("int").alias("ys"),
                                       F.ceil((F.col("rows") - F.col("most")) / CELL).cast("int").alias("xs")))
        mixed = cut_lineage(post.join(mode, "t").join(sides, "cid"))
        # a token's cells: the row's own block of one side, met by every block of the other
        own = lambda n: F.pmod(F.xxhash64("cid"), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        few = mixed.where("root <> mode").select("t", F.col("s").alias("p"), F.col("i").alias("pi"), F.col("root").alias("x"),
                                                 own("xs").alias("xb"), every("ys").alias("yb"))
        all_ = mixed.select("t", F.col("s").alias("q"), F.col("i").alias("qi"), F.col("root").alias("y"), "mode",
                            own("ys").alias("yb"), every("xs").alias("xb"))
        got = (few.join(all_, ["t", "xb", "yb"]).where("y = mode or x < y")
               .where(in_reach("p", F.col("pi"), "q", F.col("qi"))).where(alike("p", "q"))
               .select(F.least("p.cid", "q.cid").alias("a"), F.greatest("p.cid", "q.cid").alias("b")).distinct())
        found = cut_lineage(got if found is None else got.join(found, ["a", "b"], "left_semi"))
    links = links.union(_verified(found, place, docs, k, num, den))
    roots = cut_lineage(components(links))

    ids = classes.join(roots, F.col("cid") == F.col("v"), "left").select(
        "cid", "doc_id", F.coalesce("root", "cid").alias("root"))
    least = ids.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    ids = ids.join(least, "root").select("cid", "component_id")
    kept = filled.select("doc_id", "n", "cid").join(ids, "cid").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id")
    return kept.union(profile.where("n = 0").select("doc_id", "n", "doc_id"))
