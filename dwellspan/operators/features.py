"""Composite feature jobs, either refitted on the given rows or fitted once and applied."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellspan.functions.casts import cast_listing
from dwellspan.functions.columns import onehot, recode, with_year_month
from dwellspan.operators.ordered import qcut
from dwellspan.operators.rfm import add_rfm, rfm
from dwellspan.operators.sampling import sample_n
from dwellspan.operators.stats import zscore_by
from dwellspan.operators.trim import STEPS, apply_trim, fit_trim
from dwellspan.schema import COUNTRIES, KEY, MONTHS, RFM_COLUMNS, TARGET, feature_set
from dwellspan.session import materialise


def fit_categories(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct categories."""
    return df.select(column).dropna().distinct().orderBy(column)


def select_features(
    df: DataFrame, name: str, months: Sequence[str] = MONTHS, keep: Sequence[str] = ()
) -> DataFrame:
    """Ordered projection to a named feature set, in front of it the `keep` columns."""
    return df.select(*keep, *feature_set(name, tuple(months)))


@dataclass
class FeatureModel:
    """What a feature job learns: trim thresholds, city scores and category lists, all tables."""

    name: str
    months: tuple[str, ...] = MONTHS
    countries: tuple[str, ...] = COUNTRIES
    thresholds: DataFrame | None = None
    cities: DataFrame | None = None
    key: str = field(default=KEY)

    def transform(self, df: DataFrame, trim: bool = False) -> DataFrame:
        """Features of `df` under the fitted state; rows are only dropped if `trim` is set."""
        typed = cast_listing(df)
        if trim and self.thresholds is not None:
            typed = apply_trim(typed, self.thresholds)
        keep = [self.key] + ([TARGET] if TARGET in df.columns else [])
        if self.name == "EUR_V2":
            typed = onehot(typed, "country_name", self.countries)
        elif self.name.startswith("V1"):
            typed = onehot(with_year_month(typed), "y_m", self.months)
            typed = add_rfm(typed, self.cities.select("city_name", *RFM_COLUMNS), "city_name")
        return select_features(typed, self.name, self.months, keep)

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        meta = [(self.name, list(self.months), list(self.countries), self.key)]
        spark.createDataFrame(
            meta, "name string, months array<string>, countries array<string>, key string"
        ).write.mode("overwrite").parquet(f"{path}/meta")
        for label in ("thresholds", "cities"):
            table = getattr(self, label)
            if table is not None:
                table.write.mode("overwrite").parquet(f"{path}/{label}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FeatureModel:
        row = spark.read.parquet(f"{path}/meta").first()
        model = cls(row["name"], tuple(row["months"]), tuple(row["countries"]), key=row["key"])
        model.thresholds = spark.read.parquet(f"{path}/thresholds")
        if row["name"].startswith("V1"):
            model.cities = spark.read.parquet(f"{path}/cities")
        return model


def fit_features(
    df: DataFrame,
    name: str,
    months: Sequence[str] = MONTHS,
    countries: Sequence[str] = COUNTRIES,
    trim: bool = True,
    monetary_from: str = "monetary",
) -> FeatureModel:
    """Learn thresholds and, for the V1 sets, city scores over the trimmed rows."""
    typed = cast_listing(df)
    model = FeatureModel(name, tuple(months), tuple(countries))
    model.thresholds = fit_trim(typed, STEPS if trim else ())
    if name.startswith("V1"):
        kept = apply_trim(typed, model.thresholds)
        model.cities = materialise(rfm(kept, "city_name", monetary_from=monetary_from), "cities")
    return model


def build_features(df: DataFrame, name: str, trim: bool = True, **options) -> DataFrame:
    """Fit on `df` and apply to `df`: what a training run does (scoring with `refit` does the same)."""
    return fit_features(df, name, trim=trim, **options).transform(df, trim=trim)


def attach(rows: DataFrame, results: DataFrame, key: str = KEY) -> DataFrame:
    """Predictions or interval columns next to the rows they belong to, by key; every row stays, and a column that
    both sides have is taken from `rows`. This is the interval export: key, features, place, time, truth, bounds."""
    new = [c for c in results.columns if c not in rows.columns]
    return rows.join(results.select(key, *new), key, "left")


def subpopulations(
    df: DataFrame, n: int, seed: int, quarters: Sequence[tuple[int, int]]
) -> DataFrame:
    """Sampled listings with country recoded, quartile bins of price, dom and area, and the z-score of
    dom within its quarter; rows of quarters not listed are dropped."""
    sample = recode(sample_n(df, n, seed), "country_name", {"SP": "ES"})
    binned = qcut(sample, ["price", "dom", "area"])
    return zscore_by(binned, ["year_published", "quarter_published"], "dom", quarters)
