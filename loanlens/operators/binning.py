"""Quantile bin edges (A1) and range-bin assignment.

``method="exact"`` interpolates linearly (equal to numpy's default and DuckDB's
``quantile_cont``) between order statistics that counting passes over the wide rows
find for all columns together (``ranking.column_ranks``), so no task holds a column.
``method="approx"`` uses ``percentile_approx``, a mergeable sketch with bounded memory,
on ONE long ``(feature, value)`` frame.

The resulting edges table has at most ``n_bins + 1`` values per feature, so
collecting it to the driver and inlining the edges as literals is bounded by
the number of columns, never by the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from .ranking import column_percentiles

EDGE_MERGE_TOL = 1e-8


def n_quantile_bins(max_bins: int = S.WOE_MAX_BINS, min_bin_pct: float = S.WOE_MIN_BIN_PCT) -> int:
    return max(2, min(max_bins, int(1.0 / max(min_bin_pct, 0.01))))


def long_values(df: DataFrame, columns: list[str], extra: list[str] | None = None,
                value_type: str = "double") -> DataFrame:
    """Unpivot ``columns`` to ``(feature, value)`` rows (one scan, no shuffle)."""
    extra = extra or []
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast(value_type).alias("value"))
                      for c in columns])
    return df.select(*extra, F.inline(pairs))


def quantile_edges(df: DataFrame, columns: list[str], n_bins: int, method: str = "exact",
                   accuracy: int = 100_000) -> DataFrame:
    """``(feature, edges array<double>)``: merged quantile edges of non-null values."""
    probs = [i / n_bins for i in range(n_bins + 1)]
    if method == "exact":
        raw = df.sparkSession.createDataFrame(list(column_percentiles(df, columns, probs).items()),
                                              "feature string, raw_edges array<double>")
    elif method == "approx":
        raw = long_values(df, columns).where(F.col("value").isNotNull() & ~F.isnan("value"))
        raw = raw.groupBy("feature").agg(
            F.percentile_approx("value", F.array(*map(F.lit, probs)), accuracy).alias("raw_edges"))
    else:
        raise ValueError(f"unknown quantile method {method!r}")
    # Keep an edge when it is more than 1e-8 above its (original) neighbour.
    merged = F.filter("raw_edges", lambda e, i: F.when(i == 0, F.lit(True)).otherwise(
        e - F.get(F.col("raw_edges"), i - 1) > EDGE_MERGE_TOL))
    return raw.select("feature", merged.alias("edges"))


def merged_edges(raw: list[float]) -> list[float]:
    """The same for one list of edges."""
    return [e for i, e in enumerate(raw) if i == 0 or e - raw[i - 1] > EDGE_MERGE_TOL]


def collect_edges(edges_df: DataFrame) -> dict[str, list[float]]:
    """Bounded collect: one short array per feature."""
    return {r["feature"]: list(r["edges"]) for r in edges_df.collect()}


def bin_index(value: Column, edges: list[float]) -> Column:
    """Number of interior edges <= value: bins ``[lo, hi)``, outer bins open; NULL stays NULL.

    Edges are strictly increasing, so the count is the position of the first
    interior edge above the value: one CASE chain against literals (codegen'd,
    stops at the first hit).
    """
    interior = edges[1:-1]
    v = value.cast("double")
    out = F.when(v.isNull(), F.lit(None).cast("int"))
    for i, e in enumerate(interior):
        out = out.when(v < F.lit(float(e)), F.lit(i))
    return out.otherwise(F.lit(len(interior)))


def bin_label(lo: Column, hi: Column) -> Column:
    """``(lo, hi]`` with four significant digits, zeros at the end left out; exponents below -4 and from 4 on."""
    def four(x: Column) -> Column:
        power = F.floor(F.log10(F.abs(x)))
        unit = F.pow(F.lit(10.0), F.lit(3) - power)
        text = F.format_string("%.3e", F.round(x * unit, 0) / unit)
        head, tail = F.split_part(text, F.lit("e"), F.lit(1)), F.split_part(text, F.lit("e"), F.lit(2))
        e = tail.cast("int")
        out = F.concat(F.regexp_replace(head, r"\.?0+$", ""), F.lit("e"), tail)
        fixed = None
        for d in range(-4, 4):
            now = F.format_string(f"%.{3 - d}f", text.cast("double"))
            now = now if d == 3 else F.regexp_replace(now, r"\.?0+$", "")
            fixed = F.when(e == d, now) if fixed is None else fixed.when(e == d, now)
        return F.when(x == 0, "0").otherwise(fixed.otherwise(out))
    return F.concat(F.lit("("), four(lo), F.lit(", "), four(hi), F.lit("]"))


def sql_bin_label(lo: str, hi: str) -> str:
    """DuckDB twin of ``bin_label``."""
    def four(x):
        unit = f"pow(10e0, 3 - floor(log10(abs({x}))))"
        return f"CASE WHEN {x} = 0 THEN '0' ELSE printf('%.4g', round({x} * {unit}) / {unit}) END"
    return f"'(' || {four(lo)} || ', ' || {four(hi)} || ']'"


def sql_bin_index(value: str, edges_expr: str) -> str:
    """DuckDB twin of ``bin_index`` over a list of edges."""
    return (f"CASE WHEN {value} IS NULL THEN NULL ELSE "
            f"len(list_filter({edges_expr}[2:len({edges_expr})-1], lambda x: x <= {value})) END")


def sql_quantile_edges(long_table: str, n_bins: int) -> str:
    probs = ", ".join(repr(i / n_bins) for i in range(n_bins + 1))
    return (f"SELECT feature, list_filter(q, lambda e, i: i = 1 OR e - q[i-1] > {EDGE_MERGE_TOL!r}) AS edges "
            f"FROM (SELECT feature, quantile_cont(value, [{probs}]) AS q FROM {long_table} "
            f"WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY feature)")
