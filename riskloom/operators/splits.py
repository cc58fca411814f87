"""Train, test and valid parts, as a column of one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.ordered import before_borders, bucketed_rank

RATIOS = (0.70, 0.15, 0.15)


def _check(ratios: Sequence[float]) -> None:
    if abs(sum(ratios) - 1) > 1e-9 or min(ratios) < 0:
        raise ValueError(f"the parts must be 0 or more and sum to 1: {ratios}")


def _ends(ratios: Sequence[float]) -> tuple[Column, Column]:
    return F.floor(F.col("_size") * ratios[0]), F.floor(F.col("_size") * (ratios[0] + ratios[1]))


def _part(ratios: Sequence[float]) -> Column:
    first, second = _ends(ratios)
    return F.when(F.col("_rank") <= first, "train").when(F.col("_rank") <= second, "test").otherwise("valid")


def stratified_split(df: DataFrame, label: str, shuffle: Column, key: str, ratios: Sequence[float] = RATIOS, name: str = "split") -> DataFrame:
    """Parts of equal label rate: rows of a label in the order of `shuffle`, a key's bounded hash, then of `key`."""
    _check(ratios)
    borders = before_borders(df, label, shuffle, [key], _ends(ratios))
    if borders is not None:
        return df.withColumn(name, F.when(borders[0], "train").when(borders[1], "test").otherwise("valid"))
    return bucketed_rank(df, [label], shuffle, [key], "_rank", "_size").withColumn(name, _part(ratios)).drop("_rank", "_size")


def shuffled(key: str, seed: int = 42, buckets: int = 100_003) -> Column:
    """A bounded hash for stratified_split()."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(buckets))


def inner_split(train: DataFrame, label: str, key: str, share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """The train part in two of equal label rate, the second to choose parameters on."""
    rows = stratified_split(train, label, shuffled(key, seed), key, (share, 1 - share, 0.0), "_inner")
    return tuple(rows.where(F.col("_inner") == part).drop("_inner") for part in ("train", "test"))


def time_split(df: DataFrame, time: str, key: str, ratios: Sequence[float] = RATIOS, name: str = "split") -> DataFrame:
    """The earliest rows train, the latest are valid; days are the buckets of the order."""
    _check(ratios)
    one = df.withColumn("_all_rows", F.lit(1))
    ranked = bucketed_rank(one, ["_all_rows"], F.to_date(time), [time, key], "_rank", "_size")
    return ranked.withColumn(name, _part(ratios)).drop("_rank", "_size", "_all_rows")


def recent_valid_split(df: DataFrame, time: str, label: str, shuffle: Column, key: str, months: int = 3, test_share: float = 0.15 / 0.85, least_valid: int = 50, name: str = "split") -> DataFrame:
    """Valid: rows later than the last time less `months`; the rest is split by label into train and test."""
    if months <= 0:
        raise ValueError("months must be above 0")
    if time not in df.columns:
        raise ValueError(f"no column {time}")
    parsed = df.withColumn("_t", F.try_to_timestamp(F.col(time).cast("string")).cast("timestamp_ntz") if dict(df.dtypes)[time] == "string" else F.col(time).cast("timestamp_ntz"))
    cut = parsed.agg(F.max("_t") - F.make_ym_interval(F.lit(0), F.lit(months))).first()[0]
    later = F.col("_t") > F.lit(cut).cast("timestamp_ntz")
    bad, recent, rest = parsed.agg(F.count_if(F.col("_t").isNull()), F.count_if(later), F.count_if(~later)).first()
    if bad or cut is None:
        raise ValueError(f"{bad} times can't be read")
    if recent < least_valid or rest < 2:
        raise ValueError(f"too few rows: {recent} recent, {rest} earlier")
    rows = parsed.withColumn("_new", later)
    ranked = bucketed_rank(rows, ["_new", label], shuffle, [key], "_rank", "_size")
    old = F.when(F.col("_rank") <= F.floor(F.col("_size") * (1 - test_share)), "train").otherwise("test")
    return ranked.withColumn(name, F.when(F.col("_new"), "valid").otherwise(old)).drop("_t", "_new", "_rank", "_size")
