"""Helpers of the tests of the retail part."""

import datetime as dt
from decimal import Decimal

from tillstar.operators.dims import dim_customer, dim_date, dim_product, dim_store
from tillstar.operators.fact import build_fact
from tillstar.session import materialize, together
from tillstar.sources.schemas import ORDER_LINES
from tillstar.star import Star

DEFAULTS = {
    "order_id": "SO-1", "order_date": dt.date(2024, 1, 15), "customer_id": "C1", "segment": "Consumer",
    "signup_date": dt.date(2023, 1, 1), "store_name": "S1", "city": "Pune", "state": "MH", "country": "India",
    "channel": "Store", "sku": "K1", "product_name": "Pen", "category": "Office", "subcategory": "Pens",
    "brand": "B", "quantity": 1, "unit_price": Decimal("100.00"), "discount_pct": Decimal("0.0000"),
    "unit_cost": Decimal("60.00"), "is_returned": False,
}


def make_lines(spark, rows):
    """Order lines from partial dicts; a date may be ISO text, a price a number."""
    full = []
    for row in rows:
        r = {**DEFAULTS, **row}
        for c in ("order_date", "signup_date"):
            r[c] = dt.date.fromisoformat(r[c]) if isinstance(r[c], str) else r[c]
        for c in ("unit_price", "discount_pct", "unit_cost"):
            r[c] = Decimal(str(r[c]))
        full.append(tuple(r[f.name] for f in ORDER_LINES.fields))
    return spark.createDataFrame(full, ORDER_LINES)


def make_star(stg, domestic="India"):
    builders = (dim_date, dim_customer, lambda s: dim_store(s, domestic), dim_product)
    built = together(stg.sparkSession, *[lambda b=b: materialize(b(stg), "dim") for b in builders])
    dims = dict(zip(Star.KEYS, built))
    fact = build_fact(stg, dims["dim_customer"], dims["dim_store"], dims["dim_product"])
    return Star(**dims, fact_sales=materialize(fact, "fact"))
