"""Log, population scaling and rare-folding one-hot encoding, fitted on the training rows only."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens import config
from custlens.runtime import materialize


def log1p_columns(df: DataFrame, columns: Sequence[str] = ("Frequency", "Monetary")) -> DataFrame:
    return df.withColumns({c: F.log1p(F.col(c).cast("double")) for c in columns})


def scale_stats(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std per column in one pass; a constant column divides by 1."""
    row = df.agg(
        *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(columns)],
    ).first()
    return {c: (row[f"m_{i}"] or 0.0, row[f"s_{i}"] or 1.0) for i, c in enumerate(columns)}


def standardize(df: DataFrame, columns: Sequence[str], stats: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    stats = stats or scale_stats(df, columns)
    return df.withColumns({c: (F.col(c) - F.lit(stats[c][0])) / F.lit(stats[c][1]) for c in columns})


def clustering_matrix(features: DataFrame) -> DataFrame:
    """CustomerID with log1p Frequency and Monetary and raw Recency, each standardised."""
    narrow = features.select(config.ID, *[F.col(c).cast("double").alias(c) for c in config.RFM])
    return standardize(log1p_columns(narrow), config.RFM)


def topk_country_dummies(features: DataFrame, labels: DataFrame, k: int = config.TOP_COUNTRIES) -> DataFrame:
    """Countries outside the k most common become "Other"; log1p RFM, behaviour and 0/1 columns.

    Ties in the count go to the alphabetically first country. Only the k names reach the driver.
    """
    frame = materialize(features.join(labels, config.ID))  # read by the counts and by the rows
    counts = frame.groupBy(config.COUNTRY).agg(F.count("*").alias("n")).orderBy(F.desc("n"), config.COUNTRY)
    top = [r[config.COUNTRY] for r in counts.filter(F.col(config.COUNTRY).isNotNull()).limit(k).collect()]
    folded = F.when(F.col(config.COUNTRY).isin(top), F.col(config.COUNTRY)).otherwise("Other")
    dummies = [(folded == c).cast("int").alias(f"country_{c}") for c in sorted([*top, "Other"])]
    logged = log1p_columns(frame)
    numbers = [F.col(c).cast("double").alias(c) for c in config.NUMERIC]
    return logged.select(config.ID, *numbers, *dummies, F.col(config.LABEL).cast("int").alias(config.LABEL))


class ChurnEncoder(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Estimator so that every fold and training split refits it inside a Pipeline.

    Countries below `rareShare` of the training rows share one "infrequent" column; a country never
    seen goes there too, or to all zeros when no country was rare.
    """

    columns = Param(Params._dummy(), "columns", "input columns", TypeConverters.toListString)
    rareShare = Param(Params._dummy(), "rareShare", "share below which a country is rare", TypeConverters.toFloat)
    outputCol = Param(Params._dummy(), "outputCol", "output vector column", TypeConverters.toString)

    @keyword_only
    def __init__(self, columns=None, rareShare=config.RARE_COUNTRY, outputCol="features"):
        super().__init__()
        self._setDefault(columns=[*config.NUMERIC, config.COUNTRY], rareShare=config.RARE_COUNTRY, outputCol="features")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> "ChurnEncoderModel":
        chosen = self.getOrDefault(self.columns)
        logged = [c for c in chosen if c in config.LOGGED]
        linear = [c for c in chosen if c in config.NUMERIC and c not in config.LOGGED]
        prepared = df.select(
            *[F.log1p(F.col(c).cast("double")).alias(c) for c in logged],
            *[F.col(c).cast("double").alias(c) for c in linear],
        )
        stats = scale_stats(prepared, [*logged, *linear]) if logged or linear else {}
        kept, infrequent = [], False
        if config.COUNTRY in chosen:
            rows = df.groupBy(config.COUNTRY).agg(F.count("*").alias("n"))
            n = rows.agg(F.sum("n")).first()[0] or 0
            floor = self.getOrDefault(self.rareShare) * n
            # at most 1 / rareShare names can pass the floor
            common = rows.filter(F.col("n") >= F.lit(floor)).collect()
            kept = sorted(r[config.COUNTRY] for r in common)
            infrequent = sum(r["n"] for r in common) < n
        spec = {"logged": logged, "linear": linear, "stats": stats, "kept": kept, "infrequent": infrequent}
        return ChurnEncoderModel(spec=json.dumps(spec), outputCol=self.getOrDefault(self.outputCol))


class ChurnEncoderModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    spec = Param(Params._dummy(), "spec", "fitted means, stds and categories as JSON", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "output vector column", TypeConverters.toString)

    @keyword_only
    def __init__(self, spec=None, outputCol="features"):
        super().__init__()
        self._setDefault(outputCol="features")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def fitted(self) -> dict:
        return json.loads(self.getOrDefault(self.spec))

    def encoded(self) -> dict[str, Column]:
        """Name and expression of each output slot, all built-in expressions."""
        f = self.fitted
        out: dict[str, Column] = {}
        for c in [*f["logged"], *f["linear"]]:
            v = F.col(c).cast("double")
            mean, std = f["stats"][c]
            out[c] = ((F.log1p(v) if c in f["logged"] else v) - F.lit(mean)) / F.lit(std)
        for k in f["kept"]:
            out[f"{config.COUNTRY}_{k}"] = F.coalesce((F.col(config.COUNTRY) == k).cast("double"), F.lit(0.0))
        if f["infrequent"]:
            known = F.coalesce(F.col(config.COUNTRY).isin(f["kept"]), F.lit(False)) if f["kept"] else F.lit(False)
            out[f"{config.COUNTRY}_infrequent"] = (~known).cast("double")
        return out

    @property
    def slots(self) -> list[str]:
        return list(self.encoded())

    def columns_frame(self, df: DataFrame, *keep: str) -> DataFrame:
        """The encoded slots as plain columns."""
        return df.select(*keep, *[e.alias(n) for n, e in self.encoded().items()])

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOrDefault(self.outputCol), array_to_vector(F.array(*self.encoded().values())))
