"""The WOE encoder: fitted per feature, kept as JSON and, for features of very many categories, a table; applied by projection."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.expressions import bin_or_missing, bin_right_closed, cuts_literal, floored, no_nan
from riskloom.operators.binning import Cuts, cuts_map, few_values, long_form, long_text, tree_cuts, woe_stats
from riskloom.operators.joins import looked_up
from riskloom.operators.ordered import quantiles
from riskloom.session import settled

#: Categories of a feature that are kept in the document; a feature of more has them in the table.
MOST_CATEGORIES = 1000


def category_woe(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """feature, value, woe of each category that is not missing; only the features' totals meet in one place."""
    rows = long_text(df, features, (F.col(label).alias("label"),)).where("value IS NOT NULL")
    sums = rows.groupBy("feature", "value").agg(F.coalesce(F.sum("label"), F.lit(0)).cast("double").alias("bad"), F.count("label").cast("double").alias("n"))
    sums = settled(sums.withColumn("good", F.col("n") - F.col("bad")))
    totals = sums.groupBy("feature").agg(F.greatest(F.sum("bad"), F.lit(1e-6)).alias("all_bad"), F.greatest(F.sum("good"), F.lit(1e-6)).alias("all_good"))
    part = lambda c: floored(F.col(c) / F.col(f"all_{c}"))
    return sums.join(F.broadcast(totals), "feature").select("feature", "value", F.log(part("good") / part("bad")).alias("woe"))


@dataclass
class WoeEncoder:
    """Cuts, WOE by bin (with "-1" for missing values) or by category, and medians; `large` features have their categories in
    `table` (feature, value, woe), which is kept beside the document."""

    cuts: Cuts = field(default_factory=dict)
    woe: dict[str, dict[str, float]] = field(default_factory=dict)
    categories: dict[str, dict[str, float]] = field(default_factory=dict)
    medians: dict[str, float] = field(default_factory=dict)
    large: list[str] = field(default_factory=list)
    table: DataFrame | None = field(default=None, repr=False)

    @staticmethod
    def fit(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), label: str = "label", bins: int = 10, least_missing: int = 50, cuts: Cuts | None = None) -> WoeEncoder:
        """Numeric features need three distinct values, categories two. Missing numbers have a bin of their own
        where there are `least_missing`; missing categories count nowhere."""
        out = WoeEncoder()
        if numeric:
            flat = few_values(df.select(*(no_nan(f).alias(f) for f in numeric)), numeric, 2)
            numeric = [f for f in numeric if f not in flat]
        if numeric:
            out.cuts = cuts or tree_cuts(df, numeric, label, bins)
            row = df.agg(*(F.count_if(no_nan(f).isNull()).alias(f"n_{f}") for f in numeric)).first()
            middle = {r["feature"]: r["q"][0] for r in quantiles(long_form(df, numeric, ()), "value", [0.5], ["feature"]).collect()}
            out.medians = {f: middle[f] for f in numeric}
            few = [f for f in numeric if row[f"n_{f}"] < least_missing]
            binned = long_form(df, numeric, (F.col(label).alias("label"),)).withColumn("bin", bin_or_missing(F.col("value"), F.element_at(cuts_map({f: out.cuts[f] for f in numeric}), F.col("feature"))))
            if few:
                binned = binned.where(~(F.col("feature").isin(*few) & (F.col("bin") == -1)))
            for r in woe_stats(binned).collect():
                out.woe.setdefault(r["feature"], {})[str(r["bin"])] = r["woe"]
        if categorical:
            found = settled(category_woe(df, categorical, label))
            size = {r["feature"]: r["n"] for r in found.groupBy("feature").agg(F.count("*").alias("n")).collect()}
            out.large = [f for f in categorical if size.get(f, 0) > MOST_CATEGORIES]
            if out.large:
                out.table = found.where(F.col("feature").isin(*out.large))
            small = [f for f in categorical if 2 <= size.get(f, 0) <= MOST_CATEGORIES]
            for r in found.where(F.col("feature").isin(*small)).orderBy("feature", "value").collect() if small else []:
                out.categories.setdefault(r["feature"], {})[r["value"]] = r["woe"]
        return out

    @property
    def features(self) -> list[str]:
        return [*self.woe, *self.categories, *self.large]

    def attached(self, df: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
        """`df` with what column() needs of the table for the large ones among the features: a column _woe_<feature> each."""
        for f in self.large:
            if f in df.columns and (features is None or f in features):
                df = looked_up(df, self.table.where(F.col("feature") == f).select("value", "woe"), F.col(f), "value", f"_woe_{f}")
        return df

    def column(self, feature: str) -> Column:
        """The WOE of a feature's value; 0 where none was fitted. For a large feature the row must be attached()."""
        if feature in self.large:
            return F.coalesce(F.col(f"_woe_{feature}")["woe"], F.lit(0.0))
        table = self.woe.get(feature) or self.categories[feature]
        items = F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.lit(float(v)))])
        if feature in self.woe:
            x = no_nan(feature)
            key = F.when(x.isNull(), "-1").otherwise(bin_right_closed(x, cuts_literal(self.cuts[feature])).cast("string"))
        else:
            key = F.col(feature).cast("string")
        return F.coalesce(F.when(key.isNotNull(), F.try_element_at(items, key)), F.lit(0.0))

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        """Replaces fitted features by their WOE (or adds them under a suffix); others stay as they are."""
        return self.detached(self.attached(df).withColumns({f + suffix: self.column(f) for f in self.features if f in df.columns}))

    def detached(self, df: DataFrame) -> DataFrame:
        return df.drop(*(f"_woe_{f}" for f in self.large))

    def dumps(self) -> str:
        """All but the table."""
        return json.dumps({f.name: getattr(self, f.name) for f in fields(self) if f.name != "table"})

    @staticmethod
    def loads(text: str, table: DataFrame | None = None) -> WoeEncoder:
        return WoeEncoder(**json.loads(text), table=table)
