"""Hand-made raw events, one call per row."""

from __future__ import annotations

import datetime
from decimal import Decimal
from itertools import count

from trailmart.schemas import PRODUCT_DIM, RAW_EVENTS

NOW = datetime.datetime(2024, 6, 1)


def when(text: str) -> datetime.datetime:
    return datetime.datetime.fromisoformat(text).replace(tzinfo=datetime.timezone.utc)


class Events:
    def __init__(self) -> None:
        self.rows = []
        self.ids = count(1)

    def add(self, time, kind, user=1, session="a", product=10, price="5.00", category=1):
        amount = None if price is None else Decimal(price)
        self.rows.append(
            (next(self.ids), when(time), kind, product, Decimal(category), amount, user, session, "test.csv", NOW)
        )
        return self

    def frame(self, spark):
        return spark.createDataFrame(self.rows, RAW_EVENTS)


def products(spark, rows):
    full = [(product, Decimal(1), code, brand, "master", NOW) for product, code, brand in rows]
    return spark.createDataFrame(full, PRODUCT_DIM)
