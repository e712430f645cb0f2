"""Seeded, partition-independent sampling and splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.hashing import U32, hash_u32


def pick_user(per_user: DataFrame, min_ratings: int = 50, seed: int | None = None) -> DataFrame:
    """One user with more than ``min_ratings`` ratings: the smallest id, or a seeded hash pick."""
    heavy = per_user.where(F.col("ratings") > min_ratings)
    if seed is None:
        return heavy.orderBy("user_id").limit(1)
    return heavy.orderBy(hash_u32("user_id", seed), "user_id").limit(1)


# Seeds of the split and of the folds: different, so that folds of the training rows stay even.
SPLIT_SEED, FOLD_SEED = 11, 23


def hash_split(df: DataFrame, key: str | Column, test_fraction: float = 0.2, name: str = "is_test",
               seed: int = SPLIT_SEED) -> DataFrame:
    """Deterministic train/test flag from a seeded hash of the key (the same on every engine and run)."""
    return df.withColumn(name, hash_u32(key, seed) < F.lit(int(test_fraction * U32)))


def kfold_assign(df: DataFrame, key: str | Column, folds: int = 5, name: str = "fold", seed: int = FOLD_SEED) -> DataFrame:
    """Fold number 0..folds-1 from a seeded key hash, for ``CrossValidator(foldCol=...)``."""
    return df.withColumn(name, F.floor(hash_u32(key, seed) * folds / F.lit(U32)).cast("int"))


def class_sizes(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Inverse-frequency weights n / (k * n_c) per class: (label, n_class, weight)."""
    sizes = class_sizes(df, label)
    n = df.agg(F.count(F.lit(1))).scalar()
    k = df.agg(F.count_distinct(label)).scalar()
    return sizes.withColumn(name, n / (k * F.col("n_class")))


def _with_sizes(df: DataFrame, label: str) -> DataFrame:
    """Rows with the size of their class. The sizes (one row per class) are broadcast: dealt by class, the rows of a
    class would all be shuffled to one task."""
    return df.join(F.broadcast(class_sizes(df, label)), label)


def _thin(rows: DataFrame, target: Column, hashed: Column) -> DataFrame:
    """Each row of a class stays when its u32 hash < target / class size * 2^32 (deterministic Bernoulli)."""
    return rows.where(hashed < F.floor(target / F.col("n_class") * F.lit(float(U32))))


def _repeat(rows: DataFrame, target: Column) -> DataFrame:
    """Each row of a class stands round(target / class size) times."""
    reps = F.round(target / F.col("n_class")).cast("int")
    return rows.withColumn("_rep", F.explode(F.sequence(F.lit(1), reps))).drop("_rep")


def undersample(df: DataFrame, label: str, hashed: Column) -> DataFrame:
    """Every class is thinned to the size of the smallest one."""
    n_min = class_sizes(df, label).agg(F.min("n_class")).scalar()
    return _thin(_with_sizes(df, label), n_min, hashed).drop("n_class")


def oversample(df: DataFrame, label: str) -> DataFrame:
    """Rows of every class are repeated to about the size of the largest one."""
    n_max = class_sizes(df, label).agg(F.max("n_class")).scalar()
    return _repeat(_with_sizes(df, label), n_max).drop("n_class")


def hybrid_sample(df: DataFrame, label: str, hashed: Column) -> DataFrame:
    """Classes meet at the mean class size: larger ones are thinned to it, smaller ones repeated."""
    mean = class_sizes(df, label).agg(F.avg("n_class")).scalar()
    rows = _with_sizes(df, label)
    large = _thin(rows.where(F.col("n_class") >= mean), mean, hashed)
    return large.unionByName(_repeat(rows.where(F.col("n_class") < mean), mean)).drop("n_class")
