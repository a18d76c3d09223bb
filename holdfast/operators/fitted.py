"""Preparation as a fitted stage, so that one saved ``PipelineModel`` takes raw rows."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.operators import prep
from holdfast.operators.quality import col, numeric_columns


class PreparedFeatures(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Raw rows with a vector of the training features, in the training order.

    A column that is missing counts as null, and nulls and values of another type get their sentinel. A level
    that training did not have sets none of its column's dummies. Recency counts from the training data's first cohort,
    and what was constant there is left out whatever it holds here.
    """

    types = Param(Params._dummy(), "types", "type of each raw column in training, as (name, type) pairs")
    dummies = Param(Params._dummy(), "dummies", "(name, column, level) of each level")
    kept = Param(Params._dummy(), "kept", "columns that training kept as they are", TypeConverters.toListString)
    expected = Param(Params._dummy(), "expected", "features in order", TypeConverters.toListString)
    firstCohort = Param(Params._dummy(), "firstCohort", "earliest cohort of training, or none")
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(outputCol="features", firstCohort=None)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        given = {c.lower() for c in dataset.columns}
        rows = dataset.select(F.struct(*[col(c) for c in dataset.columns]).alias("_raw"))

        def read(name: str, kind: str):
            value = F.col("_raw")[name] if name.lower() in given else F.lit(None)
            return value.try_cast(kind).alias(name)

        rows = rows.select("_raw", *[read(n, k) for n, k in get("types")])
        rows = prep.fill_sentinels(rows)
        told = [F.coalesce(col(c) == level, F.lit(False)).cast("int").alias(name) for name, c, level in get("dummies")]
        flags = {n for n, k in get("types") if k == "boolean"}
        rows = rows.select("_raw", *[col(c).cast("int").alias(c) if c in flags else col(c) for c in get("kept")], *told)
        rows = prep.engineer_features(rows, first_cohort=get("firstCohort") if "cohort_year" in get("kept") else None)
        vector = array_to_vector(F.array(*[F.coalesce(col(c).cast("double"), F.lit(-1.0)) for c in get("expected")]))
        out = rows.select("_raw.*", vector.alias("_vector"))
        return out.drop(get("outputCol")).withColumnRenamed("_vector", get("outputCol"))


class Preparation(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns types, constants, levels, the first cohort and the order of features from raw rows."""

    target = Param(Params._dummy(), "target", "target column", TypeConverters.toString)
    entity = Param(Params._dummy(), "entity", "id column", TypeConverters.toString)
    maxCategories = Param(Params._dummy(), "maxCategories", "levels that a column may have", TypeConverters.toInt)
    skip = Param(Params._dummy(), "skip", "columns that are no features", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, target="second_year_ret_flag", entity="student_id", maxCategories=50, skip=None, outputCol="features"):
        super().__init__()
        self._setDefault(target="second_year_ret_flag", entity="student_id", maxCategories=50, skip=list(prep.NOT_FEATURES), outputCol="features")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PreparedFeatures:
        get = self.getOrDefault
        target, entity = get("target"), get("entity")
        filled = prep.fill_sentinels(dataset)
        cleaned, _ = prep.clean(filled, target, entity, get("maxCategories"), skip=get("skip"))
        marks = {f.name: f.metadata for f in cleaned.schema.fields if f.metadata and "level" in f.metadata}
        kept = [c for c in cleaned.columns if c not in marks and c not in (target, entity)]
        first = None
        if "cohort_year" in kept:
            first = filled.agg(F.min("cohort_year")).first()[0]
        wide = prep.engineer_features(cleaned, first_cohort=first)
        expected = [c for c in numeric_columns(wide, with_boolean=True) if c not in (target, entity)]
        kinds = dict(dataset.dtypes)
        used = [c for c in dataset.columns if c in kept or c in {m["column"] for m in marks.values()}]
        model = PreparedFeatures()
        return model._set(
            types=[[c, kinds[c]] for c in used],
            dummies=[[name, m["column"], m["level"]] for name, m in marks.items()],
            kept=kept,
            expected=expected,
            firstCohort=int(first) if first is not None else None,
            outputCol=get("outputCol"),
        )
