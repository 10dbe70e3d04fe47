"""Shop offers: ratings, discounts, prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.operators import clean

# From where on an offer counts as well rated, heavily discounted, premium.
HIGH_RATING, HIGH_DISCOUNT, PREMIUM_PRICE = 4.5, 65, 7000
UNUSED = ("videos", "what_customers_said", "variations")


def well_rated() -> Column:
    return F.col("rating") > HIGH_RATING


def heavily_discounted() -> Column:
    return F.col("discount") > HIGH_DISCOUNT


def premium() -> Column:
    return F.col("initial_price") > PREMIUM_PRICE


def best_deal() -> Column:
    return well_rated() & heavily_discounted()


def deal_counts(df: DataFrame) -> DataFrame:
    """All four counts in one pass."""
    return df.agg(
        F.count_if(well_rated()).alias("highly_rated"),
        F.count_if(heavily_discounted()).alias("highly_discounted"),
        F.count_if(premium()).alias("premium_products"),
        F.count_if(best_deal()).alias("best_deals"),
    )


def filled(df: DataFrame) -> DataFrame:
    """Median discount, most frequent seller, unused columns out."""
    df = clean.fill_median(df, "discount")
    df = clean.fill_mode(df, "seller_name")
    df = clean.fill_mode(df, "seller_information")
    return clean.drop_columns(df, UNUSED)


def with_total(df: DataFrame) -> DataFrame:
    """Price after discount; call on rows without copies."""
    price = F.col("initial_price")
    return df.withColumn("total_amount", price - price * F.col("discount") / 100)


def cleaned(df: DataFrame) -> DataFrame:
    return with_total(clean.drop_duplicate_rows(filled(df)))
