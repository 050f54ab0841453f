"""Conformed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillroll.functions import exact_mean, normalise_text
from tillroll.operators.dedupe import keep_first

# fixed value: category name when a product has no (translated) category
UNKNOWN_CATEGORY = "unknown"


def dim_customers(customers: DataFrame) -> DataFrame:
    """One row per customer_id; city lower-cased and trimmed."""
    return keep_first(customers, ["customer_id"]).select(
        "customer_id",
        "customer_unique_id",
        normalise_text("customer_city").alias("customer_city"),
        "customer_state",
        "customer_zip_code_prefix",
    )


def dim_sellers(sellers: DataFrame) -> DataFrame:
    """One row per seller_id; city lower-cased and trimmed."""
    return keep_first(sellers, ["seller_id"]).select(
        "seller_id",
        normalise_text("seller_city").alias("seller_city"),
        "seller_state",
        "seller_zip_code_prefix",
    )


def dim_geolocation(geolocation: DataFrame) -> DataFrame:
    """Centroid per (zip prefix, normalised city, state).

    The mean is taken over exact decimals so it does not depend on the order
    in which partial sums meet.
    """
    return (geolocation
            .withColumn("geolocation_city", normalise_text("geolocation_city"))
            .groupBy("geolocation_zip_code_prefix", "geolocation_city", "geolocation_state")
            .agg(exact_mean("geolocation_lat").alias("avg_lat"),
                 exact_mean("geolocation_lng").alias("avg_lng")))


def dim_products(products: DataFrame, translation: DataFrame,
                 dedupe_translation: bool = True) -> DataFrame:
    """One row per product with its English category, 'unknown' if none.

    Products are de-duplicated before the join so they cannot fan out the
    fact; translations are too (one name per category, lowest wins) unless
    ``dedupe_translation=False`` restores the fan-out of the original job.
    The translation table is small by nature (one row per category), and
    the join is left to Spark's size-checked broadcast choice.
    """
    t = translation.select("product_category_name", "product_category_name_english")
    if dedupe_translation:
        t = keep_first(t, ["product_category_name"])
    return (keep_first(products, ["product_id"])
            .join(t, on="product_category_name", how="left")
            .withColumn("product_category_name_en",
                        F.coalesce(F.col("product_category_name_english"), F.lit(UNKNOWN_CATEGORY)))
            .drop("product_category_name_english"))
