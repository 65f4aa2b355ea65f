"""Exact order statistics from sketches (W4, W6, W8, A1, A11, A14): no sort and no shuffle of the values.

``value_at_ranks`` returns, for fractions ``p``, the sorted value at index ``min(floor(p * n), n - 1)``. Plan:

1. One aggregate per group: the count and a mergeable quantile sketch (KLL). It brackets every wanted rank
   between two values, a few thousandths of the rows apart.
2. One pass that counts the rows between the brackets and keeps the values inside them, collapsed by
   ``(group, bracket, value)`` in the map tasks. The counts are exact, so they tell whether a rank
   lies where the sketch put it; one that does not is bracketed anew by the counted gap it lies in.
3. Brackets that hold more than ``LIMIT`` distinct values are cut by a sketch of those values and
   narrowed to the part that holds the rank, as often as needed.
4. Running counts inside the brackets give the values.

Numbers per group, rank and bracket reach the driver, whatever the number of rows. Sketches steer which rows are
kept, never a result.

``column_ranks`` does the same for many columns of one frame, and for all folds at once, without making the frame long:
every pass counts, in Arrow batches, the values of each column in cells of the intervals that hold a wanted rank, and the
next pass cuts the one cell that holds it. A pass moves a count per cell; cells shrink by halves at least, so it ends.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, persisted

#: Size of a sketch, the quantiles read from it, and the share of rows that a bracket takes on either side of its rank,
#: to the next such quantile (the sketch's error is 0.0024 at 99 % confidence).
SKETCH_K, GRID, MARGIN = 2048, 400, 0.0025
#: Distinct values of one bracket that one task sorts; larger brackets are narrowed into ``PARTS`` parts.
LIMIT, PARTS = 1_000_000, 64


def ordered_parts(df: DataFrame, *order: str) -> DataFrame:
    """``df`` dealt into sorted ranges of like size; ``part`` numbers them in ascending order.

    Range bounds are sampled, so the frame is written once: counting and sorting see the same ranges.
    """
    return cut_lineage(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))


class _Kind:
    """Sketch functions and unbounded ends for a type of value (NaN sorts above all doubles)."""

    def __init__(self, dtype: T.DataType):
        self.whole = isinstance(dtype, T.IntegralType)
        self.type = T.LongType() if self.whole else T.DoubleType()
        self.least, self.most = (-(1 << 63), (1 << 63) - 1) if self.whole else (float("-inf"), float("nan"))

    def sketch(self, value: str) -> Column:
        agg = F.kll_sketch_agg_bigint if self.whole else F.kll_sketch_agg_double
        return agg(value, F.lit(SKETCH_K))

    def quantile(self, sketch: Column, at: Column) -> Column:
        get, n = ((F.kll_sketch_get_quantile_bigint, F.kll_sketch_get_n_bigint) if self.whole else
                  (F.kll_sketch_get_quantile_double, F.kll_sketch_get_n_double))
        return F.when(n(sketch) > 0, get(sketch, at))

    def key(self, v) -> tuple:
        """Ascending order of bounds."""
        return (v != v, v)


def _merged(brackets: list[tuple], kind: _Kind) -> list[tuple]:
    """Disjoint brackets, ascending."""
    out: list[tuple] = []
    for lo, hi in sorted(brackets, key=lambda b: (kind.key(b[0]), kind.key(b[1]))):
        if out and kind.key(lo) <= kind.key(out[-1][1]):
            if kind.key(hi) > kind.key(out[-1][1]):
                out[-1] = (out[-1][0], hi)
        else:
            out.append((lo, hi))
    return out


def _inside(src: DataFrame, brackets: dict, kind: _Kind, key_type: T.DataType) -> tuple[DataFrame, int]:
    """``(g, slot, v, c)``: odd slots are brackets, with their values; even ones the gaps, counted only."""
    m = max(map(len, brackets.values()))
    fields = [T.StructField("g", key_type)] + [T.StructField(f"{e}{i}", kind.type) for i in range(m) for e in ("lo", "hi")]
    rows = [(g, *(x for i in range(m) for x in (b[i] if i < len(b) else (None, None)))) for g, b in brackets.items()]
    ends = src.sparkSession.createDataFrame(rows, T.StructType(fields))  # a row per group
    slot = None
    for i in range(m):
        below = F.col("v") < F.col(f"lo{i}")
        slot = F.when(below, 2 * i) if slot is None else slot.when(below, 2 * i)
        slot = slot.when(F.col("v") <= F.col(f"hi{i}"), 2 * i + 1)
    placed = src.join(F.broadcast(ends), "g").select("g", slot.otherwise(2 * m).alias("slot"), "v")
    return placed.groupBy("g", "slot", F.when(F.col("slot") % 2 == 1, F.col("v")).alias("v")).agg(
        F.count("*").alias("c")), m


def _narrowed(kept: DataFrame, wanted: list[tuple], kind: _Kind, key_type: T.DataType) -> tuple[DataFrame, list[tuple]]:
    """Brackets cut into parts by a sketch of their distinct values; only parts that hold a rank stay.

    ``wanted``: (group, name, slot, rank within the slot)."""
    cuts = F.lit([i / PARTS for i in range(1, PARTS)])
    splits = kept.groupBy("g", "slot").agg(kind.sketch("v").alias("s")).select(
        "g", "slot", F.array_distinct(kind.quantile(F.col("s"), cuts)).alias("at"))
    parts = cut_lineage(kept.join(F.broadcast(splits), ["g", "slot"]).select(
        "g", "slot", F.size(F.filter("at", lambda x: x < F.col("v"))).alias("part"), "v", "c"))
    sums: dict = {}
    for r in parts.groupBy("g", "slot", "part").agg(F.sum("c").alias("c")).collect():
        sums.setdefault((r["g"], r["slot"]), []).append((r["part"], r["c"]))
    stays, out = set(), []
    for g, name, slot, rank in wanted:
        for part, c in sorted(sums[g, slot]):
            if rank < c:
                stays.add((g, slot, part))
                out.append((g, name, slot * PARTS + part, rank))
                break
            rank -= c
    fields = [T.StructField("g", key_type), T.StructField("slot", T.LongType()), T.StructField("part", T.IntegerType())]
    chosen = kept.sparkSession.createDataFrame(list(stays), T.StructType(fields))
    return cut_lineage(parts.join(F.broadcast(chosen), ["g", "slot", "part"]).select(
        "g", (F.col("slot") * PARTS + F.col("part")).alias("slot"), "v", "c")), out


def value_at_ranks(df: DataFrame, value: str, fractions: dict[str, float] | None = None,
                   group: str | None = None, ranks: dict | None = None, count: str | None = None) -> DataFrame:
    """One row (or one per ``group``) with a column per fraction; NULL when empty.

    ``ranks`` maps a name to a function of the count column ``n`` giving a
    0-based rank, for callers that need other rank rules than ``floor(p n)``.
    ``count`` names a column for the number of values.
    """
    spark, kind = df.sparkSession, _Kind(df.schema[value].dataType)
    key_type = df.schema[group].dataType if group else T.IntegerType()
    src = df.where(F.col(value).isNotNull()).select(
        (F.col(group) if group else F.lit(0)).alias("g"), F.col(value).cast(kind.type).alias("v"))
    if group:
        src = src.where("g is not null")
    exact = {name: F.least(F.floor(F.lit(float(p)) * F.col("n")), F.col("n") - 1)
             for name, p in (fractions or {}).items()}
    exact.update({name: F.greatest(fn(F.col("n")), F.lit(0)) for name, fn in (ranks or {}).items()})
    names = list(exact)
    at = F.array(*(e.cast("long") for e in exact.values()))
    grid = F.lit([i / GRID for i in range(GRID + 1)])
    seen = src.groupBy("g").agg(F.count("*").alias("n"), kind.sketch("v").alias("s")).select(
        "g", "n", at.alias("r"), kind.quantile(F.col("s"), grid).alias("q")).collect()

    total = {r["g"]: r["n"] for r in seen}
    rank = {(r["g"], name): r["r"][i] for r in seen for i, name in enumerate(names)}
    todo: dict = {}
    for r in seen:
        for i, name in enumerate(names):
            if 0 <= r["r"][i] < r["n"]:      # ranks beyond the last value have none
                share = (r["r"][i] + 0.5) / r["n"]
                lo, hi = math.floor((share - MARGIN) * GRID), math.ceil((share + MARGIN) * GRID)
                todo[r["g"], name] = (r["q"][lo] if r["q"] and lo > 0 else kind.least,   # no quantiles: all are NaN
                                      r["q"][hi] if r["q"] and hi < GRID else kind.most)
    parts: list[DataFrame] = []
    while todo:
        brackets: dict = {}
        for (g, _), b in todo.items():
            brackets.setdefault(g, []).append(b)
        brackets = {g: _merged(b, kind) for g, b in brackets.items()}
        placed, m = _inside(src, brackets, kind, key_type)
        placed = cut_lineage(placed)
        sizes: dict = {}
        for r in placed.groupBy("g", "slot").agg(F.sum("c").alias("c"), F.count("*").alias("d")).collect():
            sizes.setdefault(r["g"], {})[r["slot"]] = (r["c"], r["d"])
        wanted, again, most = [], {}, 0
        for g, name in todo:
            left = rank[g, name]
            for slot in range(2 * m + 1):
                c, d = sizes[g].get(slot, (0, 0))
                if left < c:
                    break
                left -= c
            if slot % 2:
                wanted.append((g, name, slot, left))
                most = max(most, d)
            else:                             # the sketch was wrong: the rank lies in this gap
                b = brackets[g]
                i = min(slot // 2, len(b))    # above the last bracket of a group with fewer brackets
                again[g, name] = (b[i - 1][1] if i else kind.least, b[i][0] if i < len(b) else kind.most)
        kept = placed.where("slot % 2 = 1").select("g", F.col("slot").cast("long").alias("slot"), "v", "c")
        while most > LIMIT:
            kept, wanted = _narrowed(kept, wanted, kind, key_type)
            smaller = kept.groupBy("g", "slot").count().agg(F.max("count")).first()[0]
            if smaller >= most:
                break
            most = smaller
        if wanted:
            fields = [T.StructField("g", key_type), T.StructField("name", T.StringType()), T.StructField("slot", T.LongType()),
                      T.StructField("k", T.LongType())]
            asked = spark.createDataFrame(wanted, T.StructType(fields))
            run = kept.withColumn("cum", F.sum("c").over(
                Window.partitionBy("g", "slot").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)))
            parts.append(run.join(F.broadcast(asked), ["g", "slot"]).where("cum > k").groupBy("g", "name").agg(F.min("v").alias("v")))
        todo = again
    found: dict = {}
    for part in parts:
        for r in part.collect():              # one number per group and rank
            found[r["g"], r["name"]] = r["v"]
    groups = list(total) if group else [0]
    rows = [(g, *(found.get((g, name)) for name in names), total.get(g, 0)) for g in groups]
    out = spark.createDataFrame(rows, T.StructType(
        [T.StructField("g", key_type), *(T.StructField(n, kind.type) for n in names), T.StructField("n", T.LongType())]))
    return out.select(*([F.col("g").alias(group)] if group else []), *names, *([F.col("n").alias(count)] if count else []))


def percentiles(df: DataFrame, value: str, probs: list[float], group: str) -> DataFrame:
    """(``group``, q array<double>): exact percentiles with linear interpolation, as ``percentile``
    gives them, but from brackets of the values instead of one state per group."""
    ranks = {}
    for i, p in enumerate(probs):
        ranks[f"lo{i}"] = lambda n, p=p: F.floor(F.lit(float(p)) * (n - 1))
        ranks[f"hi{i}"] = lambda n, p=p: F.ceil(F.lit(float(p)) * (n - 1))
    got = value_at_ranks(df, value, group=group, ranks=ranks, count="n")
    out = []
    for i, p in enumerate(probs):
        lo, hi, at = F.col(f"lo{i}"), F.col(f"hi{i}"), F.lit(float(p)) * (F.col("n") - 1)
        out.append(F.when(lo == hi, lo).otherwise((F.ceil(at) - at) * lo + (at - F.floor(at)) * hi))
    return got.select(group, F.array(*out).alias("q"))


# --- many columns at once ------------------------------------------------------------------------------------
#: Cells that one pass counts, over all columns and folds, and the most that an interval is cut into.
CELLS, CUTS = 200_000, 1024


def _keys(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles (zeros alike); ``_doubles`` turns them back."""
    i = (np.asarray(values, np.float64) + 0.0).view(np.int64)
    return i ^ ((i >> 63) & 0x7FFFFFFFFFFFFFFF)


def _doubles(keys) -> np.ndarray:
    k = np.asarray(keys, np.int64)
    return (k ^ ((k >> 63) & 0x7FFFFFFFFFFFFFFF)).view(np.float64)


def _cells_of(intervals: list[tuple[int, int]], parts: int):
    """Ascending starts of the cells of disjoint intervals, each start's cell number (the last one for gaps) and
    the cells ``[from, to)`` of every interval."""
    starts, cells, spans, m = [], [], {}, 0
    for lo, hi in intervals:
        width = (hi - lo) // parts + 1
        inner = list(range(lo, hi + 1, width))
        if starts and starts[-1] == lo:      # no gap before this interval
            starts.pop(), cells.pop()
        starts += [*inner, hi + 1]
        cells += [*range(m, m + len(inner)), -1]
        spans[lo, hi] = (m, m + len(inner))
        m += len(inner)
    return np.array(starts, np.int64), np.array([m if c < 0 else c for c in [*cells, -1]], np.int64), spans, m


def _counted(rows: DataFrame, placing: list, folds: int) -> dict[int, tuple]:
    """Per column: counts by fold and cell, and the least and greatest key in each cell."""
    def count(batches):
        n = [np.zeros(folds * (p[3] + 1), np.int64) for p in placing]
        lo = [np.full(p[3] + 1, np.iinfo(np.int64).max) for p in placing]
        hi = [np.full(p[3] + 1, np.iinfo(np.int64).min) for p in placing]
        for batch in batches:
            fold = batch.column("f").to_numpy(zero_copy_only=False).astype(np.int64)
            for i, (starts, cells, _, m) in enumerate(placing):
                if not m:
                    continue
                v = batch.column(f"v{i}").to_numpy(zero_copy_only=False)
                there = ~np.isnan(v)
                keys = (v[there] + 0.0).view(np.int64)      # as _keys; tasks may not have this module
                keys ^= (keys >> 63) & 0x7FFFFFFFFFFFFFFF
                at = cells[np.searchsorted(starts, keys, "right") - 1]
                n[i] += np.bincount(fold[there] * (m + 1) + at, minlength=len(n[i]))
                np.minimum.at(lo[i], at, keys)
                np.maximum.at(hi[i], at, keys)
        for i, (_, _, _, m) in enumerate(placing):
            f, cell = np.nonzero(n[i].reshape(folds, m + 1)[:, :m])
            if len(f):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(f), i, np.int32)), pa.array(f.astype(np.int32)), pa.array(cell), pa.array(n[i][f * (m + 1) + cell]),
                     pa.array(lo[i][cell]), pa.array(hi[i][cell])], names=["i", "f", "cell", "n", "lo", "hi"])
    got = rows.mapInArrow(count, "i int, f int, cell long, n long, lo long, hi long").groupBy("i", "f", "cell").agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).toArrow()   # at most CELLS and a few rows
    i, f, cell, n, lo, hi = (got.column(c).to_numpy() for c in ("i", "f", "cell", "n", "lo", "hi"))
    out = {}
    for j, (_, _, _, m) in enumerate(placing):
        here = i == j
        counts, least, most = np.zeros((folds, m), np.int64), np.full(m, np.iinfo(np.int64).max), np.full(m, np.iinfo(np.int64).min)
        counts[f[here], cell[here]] = n[here]
        np.minimum.at(least, cell[here], lo[here])
        np.maximum.at(most, cell[here], hi[here])
        out[j] = counts, least, most
    return out


def column_ranks(df: DataFrame, columns: list[str], wanted: Callable[[int, int], list[int]], fold: str | None = None,
                 k: int = 1) -> dict[tuple[str, int], tuple[int, int, list[float | None]]]:
    """``(column, g)`` -> (number of values, of rows without one, the sorted values at the 0-based ranks ``wanted`` gives
    for these two numbers; None for a rank outside). NULL and NaN are no values.

    With ``fold`` (0..k-1), g stands for the rows of all folds but g; without, g is 0 and stands for all rows."""
    values = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"v{i}") for i, c in enumerate(columns)]
    with persisted(df.select((F.col(fold) if fold else F.lit(0)).cast("int").alias("f"), *values), "always") as rows:
        ends = rows.groupBy("f").agg(F.count("*").alias("n"), *(
            F.struct(F.count(f"v{i}").alias("n"), F.min(f"v{i}").alias("lo"), F.max(f"v{i}").alias("hi")).alias(f"e{i}")
            for i in range(len(columns)))).collect()
        out, todo = {}, []                   # todo: column, g, place of the rank, lo, hi, rank from lo on
        for i, c in enumerate(columns):
            keys = [int(x) for r in ends if r[f"e{i}"]["n"] for x in _keys([r[f"e{i}"]["lo"], r[f"e{i}"]["hi"]])]
            for g in range(k):
                parts = [r for r in ends if not fold or r["f"] != g]
                n = sum(r[f"e{i}"]["n"] for r in parts)
                missing = sum(r["n"] for r in parts) - n
                ranks = wanted(n, missing)
                out[c, g] = (n, missing, [None] * len(ranks))
                todo += [(i, g, j, min(keys), max(keys), r) for j, r in enumerate(ranks) if 0 <= r < n]
        while todo:
            for i, g, j, lo, _, _ in (t for t in todo if t[3] == t[4]):
                out[columns[i], g][2][j] = float(_doubles([lo])[0])
            todo = [t for t in todo if t[3] < t[4]]
            held = [sorted({t[3:5] for t in todo if t[0] == i}) for i in range(len(columns))]
            parts = max(2, min(CUTS, CELLS // max(1, k * sum(map(len, held)))))
            placing = [_cells_of(h, parts) for h in held]
            counted, sums, left = _counted(rows, placing, k) if todo else {}, {}, []
            for i, g, j, lo, hi, rank in todo:
                counts, least, most = counted[i]
                a, b = placing[i][2][lo, hi]
                if (i, g, lo) not in sums:
                    here = counts[:, a:b].sum(axis=0) - (counts[g, a:b] if fold else 0)
                    sums[i, g, lo] = np.cumsum(here)
                cum = sums[i, g, lo]
                cell = int(np.searchsorted(cum, rank, "right"))
                left.append((i, g, j, int(least[a + cell]), int(most[a + cell]), rank - int(cum[cell - 1] if cell else 0)))
            todo = left
    return out


def linear_ranks(n: int, probs: list[float]) -> list[int]:
    """The two ranks that each percentile of ``n`` values lies between, in turn."""
    return [r for p in probs for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))] if n else []


def interpolated(n: int, probs: list[float], found: list[float]) -> list[float]:
    """Percentiles from the values at ``linear_ranks``."""
    out = []
    for p, lo, hi in zip(probs, found[::2], found[1::2], strict=True):
        at = p * (n - 1)
        out.append(lo if lo == hi else (math.ceil(at) - at) * lo + (at - math.floor(at)) * hi)
    return out


def column_percentiles(df: DataFrame, columns: list[str], probs: list[float]) -> dict[str, list[float]]:
    """Exact percentiles, as ``percentiles`` gives them, of each column that has values."""
    got = column_ranks(df, columns, lambda n, _: linear_ranks(n, probs))
    return {c: interpolated(n, probs, found) for (c, _), (n, _, found) in got.items() if n}


def filled_percentiles(df: DataFrame, columns: list[str], probs: list[float], fold: str, k: int):
    """Of the rows of all folds but one, for each such fold: the median of a column, and the percentiles once the median
    stands in for missing values. Returns ``{column: [median, ...]}`` and ``{column: [[percentile, ...], ...]}``.

    With m copies of the median put among sorted values a, rank r holds the median, unless a[r] lies below or a[r - m] above."""
    def wanted(n, missing):
        ranks = linear_ranks(n + missing, probs)
        return [*linear_ranks(n, [0.5]), *ranks, *(r - missing for r in ranks)] if n else []
    got = column_ranks(df, columns, wanted, fold, k)
    medians: dict[str, list] = {c: [None] * k for c in columns}
    edges: dict[str, list] = {c: [None] * k for c in columns}
    for (c, g), (n, missing, found) in got.items():
        if n:
            m = interpolated(n, [0.5], found[:2])[0]
            half = len(probs) * 2
            below, above = found[2:2 + half], found[2 + half:]
            filled = [max(m if a is None else min(a, m), -math.inf if b is None else b) for a, b in zip(below, above, strict=True)]
            medians[c][g], edges[c][g] = m, interpolated(n + missing, probs, filled)
    return medians, edges
