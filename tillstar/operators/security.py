"""Row-level security: narrow the store dimension, the filter flows to the fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.star import Star


def secure_static(star: Star, country: str) -> Star:
    return star.with_stores(star.dim_store.filter(F.col("country") == country))


def allowed_countries(mapping: DataFrame, user: str | None = None) -> DataFrame:
    """Countries of a user; of the session's own user where none is named."""
    return mapping.filter(F.col("user_email") == (F.current_user() if user is None else F.lit(user))).select("country")


def secure_user(star: Star, mapping: DataFrame, user: str | None = None) -> Star:
    """Stores of the countries mapped to the user (the session's own by default); an unmapped user sees nothing.

    A semi join, so a mapping listed twice does not multiply stores.
    """
    return star.with_stores(star.dim_store.join(allowed_countries(mapping, user), "country", "left_semi"))


def secured_views(star: Star, mapping: DataFrame, prefix: str = "") -> list[str]:
    """Temporary views of the star for SQL; returns their names.

    The views hold no user: whoever's session runs a query sees the stores mapped to them, and the
    sales of these stores. Nothing else about a query changes; an unmapped user gets no rows.
    """
    secured = secure_user(star, mapping)
    for name, df in secured.tables().items():
        df.createOrReplaceTempView(f"{prefix}{name}")
    return [f"{prefix}{name}" for name in secured.tables()]


def secure_customers(scores: DataFrame, star: Star) -> DataFrame:
    """Score rows of customers who bought in the (secured) star.

    The reference model filters stores only, which leaves scores unrestricted;
    this is the explicit way to restrict them too.
    """
    buyers = star.fact_sales.select("customer_key").distinct()
    visible = star.dim_customer.join(buyers, "customer_key", "left_semi").select("customer_id")
    return scores.join(visible, "customer_id", "left_semi")
