"""The star schema as one record of DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Star:
    """Four dimensions and the order-line fact.

    ``fact_sales`` may carry the physical partition column ``year`` besides its
    thirteen contract columns. ``keyed`` are the lines the whole fact was made of, joined to stores and products and
    in buckets of their customer, where the run that built the star still has them.
    """

    dim_date: DataFrame
    dim_customer: DataFrame
    dim_store: DataFrame
    dim_product: DataFrame
    fact_sales: DataFrame
    keyed: DataFrame | None = None

    KEYS = {
        "dim_date": "date_key",
        "dim_customer": "customer_key",
        "dim_store": "store_key",
        "dim_product": "product_key",
    }

    @property
    def spark(self) -> SparkSession:
        return self.fact_sales.sparkSession

    def dims(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in self.KEYS}

    def tables(self) -> dict[str, DataFrame]:
        return {**self.dims(), "fact_sales": self.fact_sales}

    def narrowed(self, name: str, members: DataFrame) -> Star:
        """Narrow a dimension to ``members``; the filter flows to the fact."""
        key = self.KEYS[name]
        fact = self.fact_sales.join(members.select(key), key, "left_semi")
        return replace(self, **{name: members}, fact_sales=fact.select(*self.fact_sales.columns), keyed=None)

    def with_stores(self, stores: DataFrame) -> Star:
        return self.narrowed("dim_store", stores)

    def sales(self, *columns: str) -> DataFrame:
        """Fact rows with the dimension columns asked for.

        Only the dimensions that own a wanted column are joined, and each side
        is pruned to key + wanted columns. No broadcast hint: Catalyst and AQE
        broadcast a dimension when its measured size allows and shuffle both
        sides (with skew splitting) when it does not.
        """
        frame = self.fact_sales
        for name, key in self.KEYS.items():
            dim = getattr(self, name)
            wanted = [c for c in dict.fromkeys(columns) if c in dim.columns and c not in frame.columns]
            if wanted:
                frame = frame.join(dim.select(key, *wanted), key)
        missing = [c for c in columns if c not in frame.columns]
        if missing:
            raise ValueError(f"no such column in the star: {missing}")
        return frame

    def calendar_bounds(self):
        """First and last day of the calendar (one row of a bounded table)."""
        return self.dim_date.agg(F.min("date").alias("first"), F.max("date").alias("last")).first()
