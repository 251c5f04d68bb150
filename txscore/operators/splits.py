"""Training and test rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 16 bits of an MD5 text decide the side
HASH_DIGITS = 4
TRAIN_SHARE = 0.7


def in_training(key: Column, share: float = TRAIN_SHARE) -> Column:
    """True for about `share` of the keys, the same ones on every run and after a lost executor.

    Rows without a key are training rows.
    """
    bound = format(int(share * 16**HASH_DIGITS), f"0{HASH_DIGITS}x")
    chosen = F.substring(F.md5(key.cast("string")), 1, HASH_DIGITS) < bound
    return F.coalesce(chosen, F.lit(True))


def hash_split(df: DataFrame, key: str, share: float = TRAIN_SHARE) -> tuple[DataFrame, DataFrame]:
    chosen = in_training(F.col(key), share)
    return df.filter(chosen), df.filter(~chosen)


def random_split(
    df: DataFrame, share: float = TRAIN_SHARE, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Row-wise split for rows without a key; it repeats only on the same plan and layout."""
    train, test = df.randomSplit([share, 1 - share], seed)
    return train, test
