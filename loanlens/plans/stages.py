"""The feature stages as persistable ``pyspark.ml`` Estimators / Transformers.

Every stage reads ``inputCols`` and writes ``outputCols`` (like Spark's own
``Imputer``), so several fitted pipelines - e.g. the k fold models of a
calibrated ensemble - can be applied to the same rows in ONE chain of
projections without overwriting each other's inputs. Fitted state (medians,
WoE bins, scaling) is stored as JSON string Params, so ``DefaultParamsWritable``
persists the stages and they load back on any executor.
"""

from __future__ import annotations

import json

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions import rules
from ..operators import prepare
from ..operators import woe as W


def _outs(stage, cols):
    outs = stage.getOrDefault(stage.outputCols) if stage.isDefined(stage.outputCols) else None
    return outs or list(cols)


class _State(Params):
    state = Param(Params._dummy(), "state", "fitted state as JSON", TypeConverters.toString)

    def _state(self) -> dict:
        return json.loads(self.getOrDefault(self.state))


class DerivedFeatureAdder(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """P1 as a stage."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return rules.add_derived_features(df)


class ColumnSelector(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """P2 as a stage: keep ``columns`` that exist, plus ``passthrough`` columns."""
    columns = Param(Params._dummy(), "columns", "columns to keep", TypeConverters.toListString)
    passthrough = Param(Params._dummy(), "passthrough", "always kept", TypeConverters.toListString)

    def __init__(self, columns=None, passthrough=None):
        super().__init__()
        self._setDefault(passthrough=[])
        if columns is not None:
            self._set(columns=columns)
        if passthrough is not None:
            self._set(passthrough=passthrough)

    def _transform(self, df: DataFrame) -> DataFrame:
        keep = self.getOrDefault(self.passthrough) + (
            self.getOrDefault(self.columns) if self.isDefined(self.columns) else df.columns)
        seen, out = set(), []
        for c in keep:
            if c in df.columns and c not in seen:
                seen.add(c)
                out.append(c)
        return df.select(*out)


class MedianImputer(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Numeric -> exact median, categorical -> 'MISSING'."""
    quantiles = Param(Params._dummy(), "quantiles", "exact or approx", TypeConverters.toString)

    def __init__(self, inputCols=None, outputCols=None, quantiles="exact"):
        super().__init__()
        self._set(quantiles=quantiles)
        if inputCols is not None:
            self._set(inputCols=inputCols)
        if outputCols is not None:
            self._set(outputCols=outputCols)

    def _fit(self, df: DataFrame) -> "MedianImputerModel":
        cols = self.getInputCols()
        num = [c for c in cols if isinstance(df.schema[c].dataType, T.NumericType)]
        cat = [c for c in cols if c not in num]
        med = {}
        if num:
            med = {r["feature"]: r["median"] for r in
                   prepare.fit_medians(df, num, self.getOrDefault(self.quantiles)).collect()}
        state = {"numeric": {c: med.get(c) for c in num}, "categorical": cat}
        m = MedianImputerModel()
        m._set(inputCols=cols, outputCols=_outs(self, cols), state=json.dumps(state))
        return m


class MedianImputerModel(Model, HasInputCols, HasOutputCols, _State, DefaultParamsReadable,
                         DefaultParamsWritable):
    def _transform(self, df: DataFrame) -> DataFrame:
        st = self._state()
        exprs = {}
        for c, o in zip(self.getInputCols(), self.getOutputCols()):
            if c in st["numeric"]:
                m = st["numeric"][c]
                exprs[o] = F.coalesce(F.col(c).cast("double"), F.lit(m).cast("double"))
            else:
                exprs[o] = F.coalesce(F.col(c).cast("string"), F.lit("MISSING"))
        return df.withColumns(exprs)


class WoEEncoder(Estimator, HasInputCols, HasOutputCols, HasLabelCol, DefaultParamsReadable,
                 DefaultParamsWritable):
    """A1-A7 as an estimator; the model does J1 + J2."""
    smoothing = Param(Params._dummy(), "smoothing", "Laplace smoothing", TypeConverters.toFloat)
    maxBins = Param(Params._dummy(), "maxBins", "max quantile bins", TypeConverters.toInt)
    minBinPct = Param(Params._dummy(), "minBinPct", "caps the bin count", TypeConverters.toFloat)
    quantiles = Param(Params._dummy(), "quantiles", "exact or approx", TypeConverters.toString)

    def __init__(self, inputCols=None, outputCols=None, labelCol=S.TARGET_COL, smoothing=S.WOE_SMOOTHING,
                 maxBins=S.WOE_MAX_BINS, minBinPct=S.WOE_MIN_BIN_PCT, quantiles="exact"):
        super().__init__()
        self._set(labelCol=labelCol, smoothing=smoothing, maxBins=maxBins, minBinPct=minBinPct,
                  quantiles=quantiles)
        if inputCols is not None:
            self._set(inputCols=inputCols)
        if outputCols is not None:
            self._set(outputCols=outputCols)

    def _fit(self, df: DataFrame) -> "WoEEncoderModel":
        cols = self.getInputCols()
        num = [c for c in cols if isinstance(df.schema[c].dataType, T.NumericType)]
        cat = [c for c in cols if c not in num]
        m = W.fit_woe(df, self.getLabelCol(), num, cat, exclude=(),
                      smoothing=self.getOrDefault(self.smoothing), max_bins=self.getOrDefault(self.maxBins),
                      min_bin_pct=self.getOrDefault(self.minBinPct), quantiles=self.getOrDefault(self.quantiles))
        state = {"numeric": num, "categorical": cat, "edges": m.edges,
                 "rows": [r.asDict() for r in m.woe_rows]}
        model = WoEEncoderModel()
        model._set(inputCols=cols, outputCols=_outs(self, cols), state=json.dumps(state))
        return model


class WoEEncoderModel(Model, HasInputCols, HasOutputCols, _State, DefaultParamsReadable, DefaultParamsWritable):
    def woe_model(self, spark=None) -> W.WoeModel:
        st = self._state()
        from pyspark.sql import Row
        rows = [Row(**r) for r in st["rows"]]
        return W.WoeModel(st["numeric"], st["categorical"], st["edges"], rows, spark)

    def iv_table(self, spark) -> DataFrame:
        return self.woe_model(spark).iv_table()

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.encode(look_up_all(df, [self]), "__woes0")

    def encode(self, df: DataFrame, woes: str) -> DataFrame:
        """The output columns, from the array ``woes`` of ``look_up_all`` and the categories' tables."""
        m = self.woe_model(df.sparkSession)
        out = dict(zip(self.getInputCols(), self.getOutputCols()))
        exprs = m.woe_columns(set(df.columns), woes)
        return (m.with_categories(df).withColumns({out[c]: e for c, e in exprs.items() if c in out})
                .drop(woes, *[f"__w_{c}" for c in m.categorical_cols]))


def look_up_all(df: DataFrame, encoders: list[WoEEncoderModel], imputers=()) -> DataFrame:
    """``df`` with the numeric WoE of encoder i as the array ``__woes{i}``.

    The look-ups of all encoders stand in one projection, so a task has one Python worker for
    them and not one each. They fill in the medians of the ``imputers`` that wrote their inputs,
    so that worker gets a column once and not once per imputer.
    """
    filled = {}
    for s in imputers:
        medians = s._state()["numeric"]
        filled |= {o: (c, medians[c]) for c, o in zip(s.getInputCols(), s.getOutputCols()) if c in medians}
    fitted = [e.woe_model(df.sparkSession) for e in encoders]
    return df.withColumns({f"__woes{i}": m.numeric_woes(df.columns, filled) for i, m in enumerate(fitted)
                           if any(c in df.columns for c in m.numeric_cols)})


class PopulationScaler(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Mean 0, population std; zero std divides by 1."""

    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=inputCols)
        if outputCols is not None:
            self._set(outputCols=outputCols)

    def _fit(self, df: DataFrame) -> "PopulationScalerModel":
        cols = self.getInputCols()
        stats = {r["feature"]: [r["mean"], r["scale"]] for r in prepare.fit_scaler(df, cols).collect()}
        m = PopulationScalerModel()
        m._set(inputCols=cols, outputCols=_outs(self, cols), state=json.dumps(stats))
        return m


class PopulationScalerModel(Model, HasInputCols, HasOutputCols, _State, DefaultParamsReadable,
                            DefaultParamsWritable):
    def _transform(self, df: DataFrame) -> DataFrame:
        st = self._state()
        return df.withColumns({o: (F.col(c).cast("double") - F.lit(st[c][0])) / F.lit(st[c][1])
                               for c, o in zip(self.getInputCols(), self.getOutputCols())})
