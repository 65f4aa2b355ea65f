"""Dataset files (S1-S4, S7): readers and writers by extension, schema enforcement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def _ext(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return ("." + name.rsplit(".", 1)[-1].lower()) if "." in name else ""


def read_dataset(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Parquet / csv / tsv by (lower-cased) extension."""
    if not _exists(spark, path):
        raise FileNotFoundError(f"Data file not found: {path}")
    ext = _ext(path)
    if ext == ".parquet":
        return spark.read.parquet(path)
    if ext in (".csv", ".tsv"):
        r = spark.read.option("header", "true").option("sep", "\t" if ext == ".tsv" else ",")
        r = r.schema(schema) if schema is not None else r.option("inferSchema", "false")
        return r.csv(path)
    raise ValueError(f"Unsupported file format: {ext!r}")


def enforce_schema(df: DataFrame) -> DataFrame:
    """Drop leakage; numeric text -> double (NULL on failure); categories as text with
    'nan' -> NULL; target -> int. Columns that are absent are skipped."""
    df = df.drop(*[c for c in S.LEAKAGE_COLS if c in df.columns])
    cols = {}
    for c in S.NUMERIC_FEATURES:
        if c in df.columns:
            cols[c] = F.col(c).cast("string").try_cast("double")
    for c in S.CATEGORICAL_FEATURES:
        if c in df.columns:
            cols[c] = F.nullif(F.col(c).cast("string"), F.lit("nan"))
    if S.TARGET_COL in df.columns:
        cols[S.TARGET_COL] = F.col(S.TARGET_COL).cast("int")
    return df.withColumns(cols) if cols else df


def load_dataset(spark: SparkSession, path: str, drop_id: bool = False, target: str = S.TARGET_COL):
    """S3: (frame with features and target, one-row profile). The target stays in the frame."""
    from ..operators.prepare import dataset_profile
    df = enforce_schema(read_dataset(spark, path))
    if target not in df.columns:
        raise KeyError(f"Target column '{target}' not found.")
    if drop_id and S.ID_COL in df.columns:
        df = df.drop(S.ID_COL)
    return df, dataset_profile(df, target)


def write_dataset(df: DataFrame, output_dir: str, filename: str = "credit_risk.parquet",
                  mode: str = "overwrite") -> str:
    """Parquet or csv by extension."""
    path = f"{output_dir.rstrip('/')}/{filename}"
    ext = _ext(filename)
    if ext == ".parquet":
        df.write.mode(mode).parquet(path)
    elif ext == ".csv":
        df.write.mode(mode).option("header", "true").csv(path)
    else:
        raise ValueError(f"Unsupported format: {ext!r}")
    return path


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> str:
    """Small report tables (IV table, metrics, drift) as one file each."""
    w = df.coalesce(1).write.mode("overwrite")  # a report has tens of rows
    (w.option("header", "true").csv(path) if fmt == "csv" else w.format(fmt).save(path))
    return path
