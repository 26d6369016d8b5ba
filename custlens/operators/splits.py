"""Seeded stratified splits. Membership depends on seed and id only, not on partitions or row order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens import config
from custlens.functions.strata import hash_strata


def train_test(df: DataFrame, train_share: float = 0.8, seed: int = config.SEED, label: str = config.LABEL, unique: str = config.ID) -> DataFrame:
    """Adds `is_train`: the first floor(share * n) rows of each class in hash order."""
    return hash_strata(df, unique, label, [train_share], seed, "_s").withColumn("is_train", F.col("_s") == 0).drop("_s")


def train_valid_test(
    df: DataFrame, shares: tuple[float, float] = (0.64, 0.8), seed: int = config.SEED, label: str = config.LABEL, unique: str = config.ID
) -> DataFrame:
    """Adds `part` (0 train, 1 validation, 2 test), for choices that must not see the test rows."""
    return hash_strata(df, unique, label, list(shares), seed, "part")


def folds(df: DataFrame, k: int = 5, seed: int = config.SEED, label: str = config.LABEL, unique: str = config.ID) -> DataFrame:
    """Adds `fold` in 0..k-1: each class is cut into k runs of its hash order, sizes equal to within one row."""
    return hash_strata(df, unique, label, [i / k for i in range(1, k)], seed, "fold")
