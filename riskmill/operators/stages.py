"""Spark ML stages for preprocessing: fit statistics once, apply them anywhere.

All fitted state is small and lives in stage parameters, so the stages save and
load with the pipeline, and applying them is a projection without joins.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
)
from pyspark.sql import DataFrame, functions as F, types as T

from riskmill.functions.durable import (
    checkpoint_dir,
    materialize,
    small_table,
    take_bounded,
)
from riskmill.functions.numeric import column_as_double
from riskmill.operators.features import derive_features, derived_names
from riskmill.operators.order_stats import SMALL_DISTINCT, quantiles_and_aggregates
from riskmill.spec import MIN_FREQUENCY, FeatureRoles

INFREQUENT = "__infrequent__"
# A fitted level list is a stage parameter and part of every task's closure.
MAX_LEVELS = 100_000


class _Columns(Params):
    """Input columns and the suffix of the output columns."""

    inputCols = Param(
        Params._dummy(), "inputCols", "columns to read", TypeConverters.toListString
    )
    suffix = Param(
        Params._dummy(), "suffix", "appended to the name of each output", TypeConverters.toString
    )

    def outputs(self) -> list[str]:
        return [c + self.getOrDefault(self.suffix) for c in self.getOrDefault(self.inputCols)]


class _Fitted(_Columns):
    """Fitted statistics as a JSON document."""

    state = Param(Params._dummy(), "state", "fitted statistics", TypeConverters.toString)

    def statistics(self):
        return json.loads(self.getOrDefault(self.state))


class RowFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage that derives the row features."""

    roles = Param(Params._dummy(), "roles", "columns behind the features", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, roles: str | None = None):
        super().__init__()
        if roles is not None:
            self._set(roles=roles)

    @classmethod
    def of(cls, roles: FeatureRoles) -> "RowFeatures":
        return cls(roles=json.dumps(vars(roles)))

    def output_names(self, columns: Sequence[str]) -> list[str]:
        """Column names after the stage, given the names before it."""
        roles = FeatureRoles(**json.loads(self.getOrDefault(self.roles)))
        return [*columns, *derived_names(columns, roles)]

    def transform(self, dataset, params=None):
        if not isinstance(dataset, DataFrame):
            raise TypeError("a DataFrame is needed")
        return super().transform(dataset, params)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        roles = json.loads(self.getOrDefault(self.roles))
        return derive_features(dataset, FeatureRoles(**roles))


class MedianScaler(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Impute numbers by the exact median, then scale by population deviation.

    Mean and deviation of the imputed column follow from those of the present
    values and the number of missing ones, so the table is not read again after
    imputation. Constant columns are only centred.
    """

    scale = Param(Params._dummy(), "scale", "standardise after imputing", TypeConverters.toBoolean)
    smallDistinct = Param(
        Params._dummy(), "smallDistinct", "distinct values for the built-in median",
        TypeConverters.toInt,
    )

    @keyword_only
    def __init__(self, *, inputCols=None, suffix="_num", scale=True, smallDistinct=SMALL_DISTINCT):
        super().__init__()
        self._setDefault(suffix="_num", scale=True, smallDistinct=SMALL_DISTINCT)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> "MedianScalerModel":
        names = self.getOrDefault(self.inputCols)
        values = dataset.select(
            *[column_as_double(dataset, c).alias(f"v{i}") for i, c in enumerate(names)]
        )
        columns = {c: F.col(f"v{i}") for i, c in enumerate(names)}
        moments = [
            statistic
            for i in range(len(names))
            for statistic in (
                F.count(f"v{i}").alias(f"n{i}"),
                F.avg(f"v{i}").alias(f"mean{i}"),
                F.var_pop(f"v{i}").alias(f"var{i}"),
            )
        ]
        medians, row = quantiles_and_aggregates(
            values,
            columns,
            [F.count("*").alias("rows"), *moments],
            small_distinct=self.getOrDefault(self.smallDistinct),
        )
        state = []
        for i, name in enumerate(names):
            median, n = medians[name], row[f"n{i}"]
            if n == 0:
                state.append({"median": 0.0, "mean": 0.0, "std": 1.0})
                continue
            share = n / row["rows"]
            mean = share * row[f"mean{i}"] + (1 - share) * median
            variance = share * (row[f"var{i}"] + (row[f"mean{i}"] - mean) ** 2)
            variance += (1 - share) * (median - mean) ** 2
            std = variance**0.5
            state.append({"median": median, "mean": mean, "std": std if std > 0 else 1.0})
        model = MedianScalerModel(scale=self.getOrDefault(self.scale))
        return model._set(
            inputCols=names, suffix=self.getOrDefault(self.suffix), state=json.dumps(state)
        )


class MedianScalerModel(Model, _Fitted, DefaultParamsReadable, DefaultParamsWritable):
    scale = Param(Params._dummy(), "scale", "standardise after imputing", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, scale=True):
        super().__init__()
        self._set(scale=scale)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        new = {}
        names = self.getOrDefault(self.inputCols)
        for name, output, fitted in zip(names, self.outputs(), self.statistics()):
            value = F.coalesce(column_as_double(dataset, name), F.lit(fitted["median"]))
            if self.getOrDefault(self.scale):
                value = (value - F.lit(fitted["mean"])) / F.lit(fitted["std"])
            new[output] = value
        return dataset.withColumns(new)


class ModeImputer(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Impute numeric flags by their most frequent value, the smallest on ties."""

    @keyword_only
    def __init__(self, *, inputCols=None, suffix="_bin"):
        super().__init__()
        self._setDefault(suffix="_bin")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> "ModeImputerModel":
        names = self.getOrDefault(self.inputCols)
        # Flags have a handful of values: count them per column as numbers.
        values = dataset.select(*[column_as_double(dataset, c).alias(c) for c in names])
        counts = (
            values.unpivot([], names, "column_name", "value")
            .where(F.col("value").isNotNull())
            .groupBy("column_name", "value")
            .agg(F.count("*").alias("n"))
        )
        winners = counts.groupBy("column_name").agg(
            F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value")
        )
        found = {
            row["column_name"]: row["value"]
            for row in take_bounded(winners, len(names), "most frequent values")
        }
        model = ModeImputerModel()
        return model._set(
            inputCols=names,
            suffix=self.getOrDefault(self.suffix),
            state=json.dumps([found.get(c, 0.0) for c in names]),
        )


class ModeImputerModel(Model, _Fitted, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self):
        super().__init__()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names = self.getOrDefault(self.inputCols)
        return dataset.withColumns(
            {
                output: F.coalesce(column_as_double(dataset, name), F.lit(float(mode)))
                for name, output, mode in zip(names, self.outputs(), self.statistics())
            }
        )


class RareOneHot(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Impute categories by the mode and encode them one-hot.

    No level is dropped. Levels with fewer than ``minFrequency`` fitted rows share
    one column, and values that were not fitted get all zeros. Telling the two
    apart needs the rare levels: up to ``maxRare`` of them are a parameter of the model,
    a longer tail is a table that is joined. A saved model holds its own copy of it.
    """

    minFrequency = Param(
        Params._dummy(), "minFrequency", "rows a level needs for its own column",
        TypeConverters.toInt,
    )
    maxRare = Param(
        Params._dummy(), "maxRare", "levels kept in the model itself", TypeConverters.toInt
    )

    @keyword_only
    def __init__(
        self, *, inputCols=None, suffix="_cat", minFrequency=MIN_FREQUENCY, maxRare=MAX_LEVELS
    ):
        super().__init__()
        self._setDefault(suffix="_cat", minFrequency=MIN_FREQUENCY, maxRare=MAX_LEVELS)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> "RareOneHotModel":
        names = self.getOrDefault(self.inputCols)
        levels = level_counts(dataset, names)
        rows = levels.take(self.getOrDefault(self.maxRare) + 1)
        model = RareOneHotModel()._set(inputCols=names, suffix=self.getOrDefault(self.suffix))
        if len(rows) > self.getOrDefault(self.maxRare):
            levels = materialize(levels, "levels")
            state, table = self._fit_long_tail(levels, names)
            model._set(rareTable=table)
        else:
            state = [self._fit_column(name, rows) for name in names]
        return model._set(state=json.dumps(state))

    def _fit_column(self, name: str, rows: Sequence) -> dict:
        counts = {row["value"]: row["n"] for row in rows if row["column_name"] == name}
        missing = counts.pop(None, 0)
        mode = min(counts, key=lambda v: (-counts[v], v), default=None)
        if mode is not None:
            counts[mode] += missing
        least = self.getOrDefault(self.minFrequency)
        return {
            "mode": mode,
            "kept": sorted(v for v, n in counts.items() if n >= least),
            "rare": sorted(v for v, n in counts.items() if n < least),
        }

    def _fit_long_tail(self, levels: DataFrame, names: Sequence[str]) -> tuple[list, str]:
        """The same from a table of level counts that is too long for the driver."""
        present = levels.where(F.col("value").isNotNull())
        modes = small_table(
            levels.groupBy("column_name").agg(
                F.min_by("value", F.struct(F.col("value").isNull(), -F.col("n"), "value")).alias(
                    "mode"
                ),
                F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias(
                    "missing"
                ),
            ),
            len(names),
            "modes",
        )
        total = F.col("n") + F.when(F.col("value") == F.col("mode"), F.col("missing")).otherwise(0)
        filled = present.join(modes, "column_name").withColumn("total", total)
        least = F.lit(self.getOrDefault(self.minFrequency))
        kept = take_bounded(
            filled.where(F.col("total") >= least).select("column_name", "value"),
            MAX_LEVELS,
            "levels with a column of their own",
        )
        path = f"{checkpoint_dir(levels.sparkSession)}/rare-levels-{uuid.uuid4().hex}"
        rare = filled.where(F.col("total") < least).select("column_name", "value")
        rare.write.parquet(path)
        tails = {row["column_name"] for row in rare.select("column_name").distinct().collect()}
        mode_of = {row["column_name"]: row["mode"] for row in modes.collect()}
        state = [
            {
                "mode": mode_of.get(name),
                "kept": sorted(row["value"] for row in kept if row["column_name"] == name),
                "rare": [],
                "tail": name in tails,
            }
            for name in names
        ]
        return state, path


def level_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per level of several category columns; missing is a level of its own."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return (
        text.unpivot([], list(columns), "column_name", "value")
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("n"))
    )


RARE_FOLDER = "rare-levels"


class _RareWriter(DefaultParamsWriter):
    """Saves the table of rare levels inside the model's own folder."""

    def saveImpl(self, path: str) -> None:  # noqa: N802 (name of the base class)
        super().saveImpl(path)
        if self.instance.isSet("rareTable"):
            table = self.sparkSession.read.parquet(self.instance.getOrDefault("rareTable"))
            table.write.mode("overwrite").parquet(f"{path}/{RARE_FOLDER}")


class _RareReader(DefaultParamsReader):
    """Points a loaded model at the table beside its parameters."""

    def load(self, path: str) -> "RareOneHotModel":
        model = super().load(path)
        if model.isSet("rareTable"):
            model._set(rareTable=f"{path.rstrip('/')}/{RARE_FOLDER}")
        return model


class RareOneHotModel(Model, _Fitted, DefaultParamsReadable, DefaultParamsWritable):
    rareTable = Param(
        Params._dummy(), "rareTable", "folder of the rare levels", TypeConverters.toString
    )

    def __init__(self):
        super().__init__()

    def write(self) -> DefaultParamsWriter:
        return _RareWriter(self)

    @classmethod
    def read(cls) -> DefaultParamsReader:
        return _RareReader(cls)

    def labels(self) -> dict[str, list[str]]:
        """Names of the encoded levels per column, in vector order."""
        return {
            name: fitted["kept"] + ([INFREQUENT] if fitted["rare"] or fitted.get("tail") else [])
            for name, fitted in zip(self.getOrDefault(self.inputCols), self.statistics())
        }

    def _group_tail(self, df: DataFrame, name: str, level: str, kept: list[str]) -> DataFrame:
        """Replace rare levels by the shared one, looking them up in the table.

        Rows with a level of their own need no lookup. They are spread over all
        tasks by a hash of the row, so a frequent level does not fill one task.
        """
        rare = df.sparkSession.read.parquet(self.getOrDefault(self.rareTable)).where(
            F.col("column_name") == name
        )
        rare = rare.select(F.col("value").alias("_rare"), F.lit(0).alias("_salt"))
        own = F.col(level).isNull() | F.col(level).isin(kept)
        plain = [c for c, kind in df.dtypes if not kind.startswith(("map", "vector", "variant"))]
        spread = F.pmod(F.xxhash64(*plain), F.lit(4096)).cast("int")
        looked_up = df.withColumns(
            {
                "_wanted": F.when(~own, F.col(level)),
                "_spread": F.when(own, spread).otherwise(F.lit(0)),
            }
        )
        matches = (F.col("_wanted") == F.col("_rare")) & (F.col("_spread") == F.col("_salt"))
        joined = looked_up.join(rare, matches, "left")
        value = F.when(F.col("_rare").isNotNull(), F.lit(INFREQUENT)).otherwise(F.col(level))
        return joined.withColumn(level, value).drop("_wanted", "_spread", "_rare", "_salt")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names, outputs = self.getOrDefault(self.inputCols), self.outputs()
        grouped = {}
        for name, output, fitted in zip(names, outputs, self.statistics()):
            value = F.coalesce(F.col(name).cast("string"), F.lit(fitted["mode"]))
            if fitted["rare"]:
                value = F.when(value.isin(fitted["rare"]), F.lit(INFREQUENT)).otherwise(value)
            grouped[f"{output}_level"] = value
        result = dataset.withColumns(grouped)
        for name, output, fitted in zip(names, outputs, self.statistics()):
            if fitted.get("tail"):
                result = self._group_tail(result, name, f"{output}_level", fitted["kept"])
        # Unknown values take the extra last index, which the encoder drops.
        for labels, output in zip(self.labels().values(), outputs):
            indexer = StringIndexerModel.from_labels(
                labels, f"{output}_level", f"{output}_index", handleInvalid="keep"
            )
            result = indexer.transform(result)
        encoder = OneHotEncoder(
            inputCols=[f"{output}_index" for output in outputs], outputCols=outputs, dropLast=True
        )
        encoded = encoder.fit(result).transform(result)
        return encoded.drop(*grouped, *[f"{output}_index" for output in outputs])


class PriorClassifier(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Baseline that gives every row the class shares of the training rows."""

    labelCol = Param(Params._dummy(), "labelCol", "0/1 label", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, labelCol="label"):
        super().__init__()
        self._set(labelCol=labelCol)

    def _fit(self, dataset: DataFrame) -> "PriorClassifierModel":
        prior = dataset.agg(F.avg(self.getOrDefault(self.labelCol)).alias("p")).first()["p"]
        return PriorClassifierModel(prior=float(prior))


class PriorClassifierModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    prior = Param(Params._dummy(), "prior", "share of the positive class", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, prior=None):
        super().__init__()
        if prior is not None:
            self._set(prior=prior)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        from pyspark.ml.functions import array_to_vector

        prior = self.getOrDefault(self.prior)
        shares = F.array(F.lit(1.0 - prior), F.lit(prior))
        return dataset.withColumns(
            {
                "probability": array_to_vector(shares),
                "prediction": F.lit(1.0 if prior > 0.5 else 0.0),
            }
        )


def feature_names(df: DataFrame, vector: str = "features") -> list[str]:
    """Names of the slots of an assembled vector, from its metadata."""
    field: T.StructField = df.schema[vector]
    groups = field.metadata["ml_attr"]["attrs"].values()
    return [a["name"] for a in sorted((a for g in groups for a in g), key=lambda a: a["idx"])]
