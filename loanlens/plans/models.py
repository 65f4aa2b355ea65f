"""Models: feature pipeline, champion / challenger, calibration, search, training run
(M1-M8, S8, W7).

A calibrated model is k fold pipelines plus k one-feature calibrators
(SURVEY M4). All k pipelines write distinct column names, so scoring is one
chain of projections over the rows - no join, no shuffle - and the k fits run
from a small thread pool over one checkpointed frame (H10).
"""

from __future__ import annotations

import json
import math
import random
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..operators import evaluation as EV
from ..operators import prepare
from ..session import cut_lineage
from .stages import (DerivedFeatureAdder, MedianImputer, MedianImputerModel, PopulationScaler, WoEEncoder,
                     WoEEncoderModel, look_up_all)

# --- fixed values: default hyper-parameters of the two boosters ----------------------
CHAMPION_PARAMS = {"n_estimators": 300, "max_depth": 4, "learning_rate": 0.05, "subsample": 0.8,
                   "colsample_bytree": 0.8, "min_child_weight": 20, "gamma": 1.0, "reg_alpha": 0.1,
                   "reg_lambda": 1.0, "random_state": 42}
CHALLENGER_PARAMS = {"n_estimators": 300, "max_depth": 4, "learning_rate": 0.05, "subsample": 0.8,
                     "colsample_bytree": 0.8, "min_child_samples": 20, "reg_alpha": 0.1,
                     "reg_lambda": 1.0, "random_state": 42}
# Search space: (name, low, high, kind)
SEARCH_SPACE = [("n_estimators", 100, 600, "int"), ("max_depth", 3, 6, "int"),
                ("learning_rate", 0.01, 0.2, "log"), ("subsample", 0.6, 1.0, "float"),
                ("colsample_bytree", 0.5, 1.0, "float"), ("min_child_weight", 5, 50, "int"),
                ("gamma", 0.0, 3.0, "float"), ("reg_alpha", 1e-3, 10.0, "log"),
                ("reg_lambda", 1e-3, 10.0, "log")]
# ---------------------------------------------------------------------------------------

MODEL_FEATURES = S.ALL_FEATURES + S.DERIVED_FEATURES
WEIGHT_COL = "__class_weight"
PROB_COL = "probability_default"


def feature_stages(features: list[str], label: str, tag: str = "") -> tuple[list, str]:
    """M1: impute -> WoE -> scale -> assemble, writing ``*__{stage}{tag}`` columns."""
    imp = [f"{c}__imp{tag}" for c in features]
    woe = [f"{c}__woe{tag}" for c in features]
    z = [f"{c}__z{tag}" for c in features]
    vec = f"features{tag}"
    return [MedianImputer(features, imp), WoEEncoder(imp, woe, label), PopulationScaler(woe, z),
            VectorAssembler(inputCols=z, outputCol=vec)], vec


def _booster(params: dict, tag: str, vec: str, label: str, weighted: bool):
    clf = GBTClassifier(featuresCol=vec, labelCol=label, predictionCol=f"pred{tag}",
                        maxIter=int(params["n_estimators"]), maxDepth=int(params["max_depth"]),
                        stepSize=float(params["learning_rate"]), subsamplingRate=float(params["subsample"]),
                        featureSubsetStrategy=str(float(params.get("colsample_bytree", 1.0))),
                        minInstancesPerNode=int(params.get("min_child_weight", params.get("min_child_samples", 1))),
                        seed=int(params.get("random_state", 42)))
    clf.setProbabilityCol(f"prob{tag}").setRawPredictionCol(f"raw{tag}")
    if weighted:
        clf.setWeightCol(WEIGHT_COL)
    return clf


def classifier(kind: str, tag: str, vec: str, label: str, params: dict | None = None, weighted=False):
    if kind == "champion":
        return _booster({**CHAMPION_PARAMS, **(params or {})}, tag, vec, label, weighted)
    if kind == "challenger":
        return _booster({**CHALLENGER_PARAMS, **(params or {})}, tag, vec, label, False)
    if kind == "forest":
        return RandomForestClassifier(featuresCol=vec, labelCol=label, predictionCol=f"pred{tag}",
                                      probabilityCol=f"prob{tag}", rawPredictionCol=f"raw{tag}",
                                      numTrees=300, maxDepth=4, seed=42)
    if kind == "logistic":
        return LogisticRegression(featuresCol=vec, labelCol=label, predictionCol=f"pred{tag}",
                                  probabilityCol=f"prob{tag}", rawPredictionCol=f"raw{tag}",
                                  maxIter=100, regParam=0.0)
    raise ValueError(kind)


def with_class_weight(df: DataFrame, label: str, ratio: float) -> DataFrame:
    return df.withColumn(WEIGHT_COL, F.when(F.col(label) == 1, F.lit(float(ratio))).otherwise(F.lit(1.0)))


# fixed value: most rows in a partition of a booster's input
BOOSTER_ROWS = 1_000_000


def fit_pipeline(df: DataFrame, stages: list, clf, kind: str) -> PipelineModel:
    """Fit the feature stages, then the classifier.

    A booster makes a job per level of every tree, with a task per partition of its input on
    both sides of a shuffle: 300 trees of depth 4 over 200 partitions are 480,000 tasks. Its
    assembled vectors are therefore held once, in about one partition per core.
    """
    if kind not in ("champion", "challenger"):
        return Pipeline(stages=stages + [clf]).fit(df)
    parts = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(df.count() / BOOSTER_ROWS))
    features = Pipeline(stages=stages).fit(df)
    keep = [clf.getFeaturesCol(), clf.getLabelCol()] + ([clf.getWeightCol()] if clf.isDefined("weightCol") else [])
    vectors = cut_lineage(features.transform(df).select(*keep).coalesce(parts))
    return PipelineModel(stages=[*features.stages, clf.fit(vectors)])


# --- calibration -----------------------------------------------------------------------
def fit_sigmoid(df: DataFrame, score: str, label: str) -> tuple[float, float]:
    """Platt scaling with the prior-corrected soft targets; returns (a, b) of 1/(1+exp(a f + b)).

    Soft targets become two weighted rows per input row, so the fit is an
    ordinary weighted logistic regression.
    """
    counts = df.agg(F.sum(F.col(label)).alias("pos"), F.count(F.lit(1)).alias("n")).first()
    pos, neg = float(counts["pos"]), float(counts["n"] - counts["pos"])
    hi, lo = (pos + 1.0) / (pos + 2.0), 1.0 / (neg + 2.0)
    t = F.when(F.col(label) == 1, F.lit(hi)).otherwise(F.lit(lo))
    two = df.select(F.col(score).alias("f"), t.alias("t")).select(
        "f", F.inline(F.array(F.struct(F.lit(1.0).alias("y"), F.col("t").alias("w")),
                              F.struct(F.lit(0.0).alias("y"), (F.lit(1.0) - F.col("t")).alias("w")))))
    lr = LogisticRegression(featuresCol="fv", labelCol="y", weightCol="w", regParam=0.0,
                            standardization=False, maxIter=100)
    m = lr.fit(VectorAssembler(inputCols=["f"], outputCol="fv").transform(two))
    # LR gives P(y=1) = 1/(1+exp(-(c f + d)))  ->  a = -c, b = -d
    return -float(m.coefficients[0]), -float(m.intercept)


class CalibratedModel:
    """k fold pipelines + calibrators; ``transform`` adds ``probability_default``."""

    def __init__(self, folds: list[PipelineModel], calibrators: list, method: str, kind: str,
                 features: list[str], meta: dict | None = None):
        self.folds, self.calibrators, self.method = folds, calibrators, method
        self.kind, self.features, self.meta = kind, features, meta or {}

    def raw_columns(self):
        return [f"p_raw{i}" for i in range(len(self.folds))]

    def _looked_up(self, df: DataFrame) -> tuple[DataFrame, list[list], bool]:
        """``df`` after every fold's imputer and the look-ups of all encoders, the stages left, and whether this was done.

        What is left of the folds follows one by one. One generated method for all of them would be
        too large for the JVM's compiler, so a lambda (which whole-stage code leaves out) stands between.
        """
        stages = [list(pm.stages) for pm in self.folds]
        if not all([type(s) for s in f[:2]] == [MedianImputerModel, WoEEncoderModel] for f in stages):
            return df, stages, False
        for imputer, *_ in stages:
            df = imputer.transform(df)
        return look_up_all(df, [f[1] for f in stages], [f[0] for f in stages]), [f[1:] for f in stages], True

    def transform(self, df: DataFrame, keep_raw: bool = False) -> DataFrame:
        out = DerivedFeatureAdder().transform(df) if not all(c in df.columns for c in S.DERIVED_FEATURES) else df
        base = out.columns
        out, left, looked_up = self._looked_up(out)
        cal = []
        for i, (stages, c) in enumerate(zip(left, self.calibrators)):
            if looked_up and i and f"__woes{i}" in out.columns:
                out = out.withColumn(f"__woes{i}", F.transform(f"__woes{i}", lambda woe: woe))
            for stage in stages:
                out = (stage.encode(out, f"__woes{i}") if looked_up and isinstance(stage, WoEEncoderModel)
                       else stage.transform(out))
            out = out.withColumn(f"p_raw{i}", vector_to_array(F.col(f"prob{i}"))[1])
            if self.method == "sigmoid":
                a, b = c
                cal.append(F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(a) * F.col(f"p_raw{i}") + F.lit(b))))
            elif self.method == "isotonic":
                out = c.transform(out)
                cal.append(F.col(f"p_cal{i}"))
            else:
                cal.append(F.col(f"p_raw{i}"))
        avg = cal[0]
        for e in cal[1:]:
            avg = avg + e
        out = out.withColumn(PROB_COL, avg / F.lit(float(len(cal))))
        keep = base + ([PROB_COL] + (self.raw_columns() if keep_raw else []))
        return out.select(*keep)

    # S8 -----------------------------------------------------------------------------
    def save(self, path: str, spark=None) -> None:
        for i, pm in enumerate(self.folds):
            pm.write().overwrite().save(f"{path}/fold_{i}")
        cal = []
        for i, c in enumerate(self.calibrators):
            if self.method == "isotonic":
                c.write().overwrite().save(f"{path}/calibrator_{i}")
                cal.append(None)
            else:
                cal.append(c)
        meta = {"method": self.method, "kind": self.kind, "features": self.features, "calibrators": cal,
                "n_folds": len(self.folds), **self.meta}
        from pyspark.sql import SparkSession
        s = spark or SparkSession.getActiveSession()
        s.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @classmethod
    def load(cls, path: str, spark=None) -> "CalibratedModel":
        from pyspark.sql import SparkSession
        s = spark or SparkSession.getActiveSession()
        meta = json.loads(s.read.text(f"{path}/meta").first()[0])
        folds = [PipelineModel.load(f"{path}/fold_{i}") for i in range(meta["n_folds"])]
        if meta["method"] == "isotonic":
            cals = [IsotonicRegressionModel.load(f"{path}/calibrator_{i}") for i in range(meta["n_folds"])]
        else:
            cals = meta["calibrators"]
        extra = {k: v for k, v in meta.items() if k not in ("method", "kind", "features", "calibrators", "n_folds")}
        return cls(folds, cals, meta["method"], meta["kind"], meta["features"], extra)


def fit_calibrated(df: DataFrame, label: str = S.TARGET_COL, features: list[str] | None = None,
                   kind: str = "champion", params: dict | None = None, method: str = "sigmoid",
                   cv: int = S.CV_FOLDS, class_weight_ratio: float = 1.0, id_col: str = S.ID_COL,
                   parallelism: int = 2) -> CalibratedModel:
    """M2/M3 + M4/M5: fit on k-1 folds, calibrate on the held-out fold, average k models."""
    features = features or MODEL_FEATURES
    base = DerivedFeatureAdder().transform(df)
    base = with_class_weight(base, label, class_weight_ratio)
    folds_df = cut_lineage(prepare.stratified_folds(base.select(id_col, label, WEIGHT_COL, *features),
                                                    cv, label, id_col))

    def one(i):
        stages, vec = feature_stages(features, label, str(i))
        clf = classifier(kind, str(i), vec, label, params, weighted=class_weight_ratio != 1.0)
        pm = fit_pipeline(folds_df.where(F.col("fold") != i), stages, clf, kind)
        held = pm.transform(folds_df.where(F.col("fold") == i)).withColumn(
            f"p_raw{i}", vector_to_array(F.col(f"prob{i}"))[1])
        if method == "sigmoid":
            cal = fit_sigmoid(held, f"p_raw{i}", label)
        elif method == "isotonic":
            cal = IsotonicRegression(featuresCol=f"p_raw{i}", labelCol=label,
                                     predictionCol=f"p_cal{i}").fit(held)
        else:
            cal = None
        return pm, cal

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        res = list(pool.map(one, range(cv)))
    return CalibratedModel([r[0] for r in res], [r[1] for r in res], method, kind, features)


def fit_plain(df: DataFrame, label: str = S.TARGET_COL, features: list[str] | None = None,
              kind: str = "logistic", params: dict | None = None, class_weight_ratio: float = 1.0,
              id_col: str = S.ID_COL) -> CalibratedModel:
    """One pipeline without calibration (e.g. the transparent WoE + logistic scorecard)."""
    features = features or MODEL_FEATURES
    base = with_class_weight(DerivedFeatureAdder().transform(df), label, class_weight_ratio)
    stages, vec = feature_stages(features, label, "0")
    clf = classifier(kind, "0", vec, label, params, weighted=class_weight_ratio != 1.0)
    pm = fit_pipeline(base, stages, clf, kind)
    return CalibratedModel([pm], [None], "none", kind, features)


# --- M6 search ----------------------------------------------------------------------------
def sample_params(n_trials: int, seed: int = S.SEED) -> list[dict]:
    rng = random.Random(seed)
    out = []
    for _ in range(n_trials):
        p = {}
        for name, lo, hi, kind in SEARCH_SPACE:
            if kind == "int":
                p[name] = rng.randint(lo, hi)
            elif kind == "log":
                p[name] = math.exp(rng.uniform(math.log(lo), math.log(hi)))
            else:
                p[name] = rng.uniform(lo, hi)
        out.append(p)
    return out


def auc_of(scored: DataFrame, label: str, prob: str = PROB_COL) -> float:
    return EV.ranking_metrics(EV.cumulative_frame(EV.score_frame(scored, label, prob))).first()["auc_roc"]


def random_search(train: DataFrame, val: DataFrame, label: str = S.TARGET_COL, features=None,
                  n_trials: int = S.N_TRIALS, class_weight_ratio: float = 1.0, cv: int = S.CV_FOLDS,
                  method: str = "sigmoid", parallelism: int = 2, seed: int = S.SEED):
    """Seeded random search; fits on train only and scores the held-out validation rows."""
    trials = sample_params(n_trials, seed)

    def run(p):
        m = fit_calibrated(train, label, features, "champion", p, method, cv, class_weight_ratio)
        return auc_of(m.transform(val), label), p

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        results = list(pool.map(run, trials))
    best = max(results, key=lambda r: r[0])
    return best[1], best[0], results


# --- W7 registry ----------------------------------------------------------------------------
def latest_models(registry: DataFrame, role: str = "role", created: str = "created_at",
                  canonical: str | None = "is_latest", name: str = "version") -> DataFrame:
    """Per role, the canonical 'latest' entry first, else the newest; ties by name."""
    order = [F.col(canonical).desc()] if canonical and canonical in registry.columns else []
    w = Window.partitionBy(role).orderBy(*order, F.col(created).desc(), F.col(name).desc())
    return registry.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


# --- M7 training run ---------------------------------------------------------------------------
def train_run(df: DataFrame, label: str = S.TARGET_COL, id_col: str = S.ID_COL, n_trials: int = 0,
              champion_kind: str = "champion", challenger_kind: str | None = "challenger",
              method: str = "sigmoid", cv: int = S.CV_FOLDS, iv_threshold: float = S.IV_THRESHOLD,
              params: dict | None = None, model_dir: str | None = None, parallelism: int = 2) -> dict:
    """split -> class weight -> IV selection -> (search) -> fit on train+val -> test report
    -> challenger -> comparison -> save. Returns DataFrames and the fitted models."""
    from ..operators import woe as W
    from ..functions import rules
    split = cut_lineage(prepare.stratified_split(df, label, id_col))
    train = split.where(F.col("split") == "train")
    val = split.where(F.col("split") == "val")
    trainval = prepare.train_val(split)
    test = split.where(F.col("split") == "test")
    bal = prepare.class_balance(train, label).first()
    ratio = float(bal["class_weight_ratio"])
    derived = rules.add_derived_features(train)
    num = [c for c in S.NUMERIC_FEATURES + S.DERIVED_FEATURES if c in derived.columns]
    cat = [c for c in S.CATEGORICAL_FEATURES if c in derived.columns]
    iv = W.woe_table_df(derived, label, num, cat)
    iv_tbl = W.iv_table(iv)
    selected = [r["feature"] for r in W.select_features_by_iv(iv_tbl, iv_threshold).collect()]
    best_params, best_auc = params, None
    if n_trials:
        best_params, best_auc, _ = random_search(train, val, label, selected, n_trials, ratio, cv, method,
                                                 parallelism)
    champ = fit_calibrated(trainval, label, selected, champion_kind, best_params, method, cv, ratio, id_col,
                           parallelism)
    champ_scored = champ.transform(test)
    champ_train = champ.transform(trainval)
    report = EV.evaluation_report(champ_scored, label, PROB_COL, champ_train, PROB_COL)
    out = {"split": split, "iv_table": iv_tbl, "selected_features": selected, "class_weight_ratio": ratio,
           "champion": champ, "champion_report": report, "best_params": best_params, "best_val_auc": best_auc}
    if challenger_kind:
        chall = fit_calibrated(trainval, label, selected, challenger_kind, None, method, cv, 1.0, id_col,
                               parallelism)
        chall_report = EV.evaluation_report(chall.transform(test), label, PROB_COL, champ_train, PROB_COL)
        both = (champ_scored.select(id_col, label, F.col(PROB_COL).alias("champion_prob"))
                .join(chall.transform(test).select(id_col, F.col(PROB_COL).alias("challenger_prob")), id_col))
        out.update({"challenger": chall, "challenger_report": chall_report,
                    "comparison": EV.champion_vs_challenger(both, label, "champion_prob", "challenger_prob")})
    if model_dir:
        champ.meta.update({"selected_features": selected, "class_weight_ratio": ratio, "role": "champion"})
        champ.save(f"{model_dir}/champion")
        if challenger_kind:
            out["challenger"].meta.update({"role": "challenger"})
            out["challenger"].save(f"{model_dir}/challenger")
    return out
