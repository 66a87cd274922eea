"""Reproducible train / test / validation, out-of-time and monitoring sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendlake.schemas import SNAPSHOT

# Names and shares of the random sets, and the seed of the hash.
SHARES = {"train": 0.7, "test": 0.2, "val": 0.1}
SEED = 42


def hash_place(key: str, seed: int = SEED) -> Column:
    """A number below 2**32 from a hash of the key: the same on every run and partitioning."""
    return F.expr(f"cast(conv(substring(md5(cast(concat_ws('|', {key}, '{seed}') as binary)), 1, 8), 16, 10) as bigint)")


def share_of(place: str, shares: dict[str, float] | None = None) -> Column:
    """Set name by the place of a row in the shares, which follow each other."""
    shares = shares or SHARES
    names, edge, cases = list(shares), 0.0, ""
    for name in names[:-1]:
        edge += shares[name]
        cases += f"when {place} < {round(edge * 2**32 / sum(shares.values()))} then '{name}' "
    return F.expr(f"case {cases} else '{names[-1]}' end") if cases else F.lit(names[-1])


def hash_split(
    df: DataFrame, key: str = "loan_id", shares: dict[str, float] | None = None, seed: int = SEED
) -> DataFrame:
    """``df`` with a random ``split`` by ``key``; the hash is computed once per row."""
    placed = df.withColumn("_place", hash_place(key, seed))
    return placed.select(*df.columns, share_of("_place", shares).alias("split"))


def month_ranks(df: DataFrame) -> DataFrame:
    """Rank of each snapshot present in ``df``; one small row per month."""
    months = df.where(F.col(SNAPSHOT).isNotNull()).select(SNAPSHOT).distinct()
    in_order = W.orderBy(SNAPSHOT)
    whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return months.select(
        SNAPSHOT,
        F.dense_rank().over(in_order).alias("month_rank"),
        F.count(F.lit(1)).over(whole).alias("months_loaded"),
    )


def assign_splits(
    df: DataFrame,
    n_train: int = 12,
    n_oot: int = 3,
    key: str = "loan_id",
    shares: dict[str, float] | None = None,
    seed: int = SEED,
    ranks: DataFrame | None = None,
) -> DataFrame:
    """``df`` with a ``split`` column.

    The first ``n_train`` months are split at random by ``key``, the next ``n_oot``
    months are the sets ``oot1``, ``oot2`` and so on, and later months are ``monitor``.
    With fewer than ``n_train`` months there are no rows. The month table is bounded by
    the calendar, so it is broadcast. ``ranks`` names all months when ``df`` holds some.
    """
    ranks = ranks or month_ranks(df)
    ranks = ranks.where(F.col("months_loaded") >= n_train).drop("months_loaded")
    rank = F.col("month_rank")
    split = (
        F.when(rank <= n_train, F.col("split"))
        .when(rank <= n_train + n_oot, F.concat(F.lit("oot"), (rank - n_train).cast("string")))
        .otherwise("monitor")
    )
    placed = hash_split(df, key, shares, seed)
    return placed.join(F.broadcast(ranks), SNAPSHOT).select(*df.columns, split.alias("split"))
