"""Small fixtures with known results."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

from demandspark import schemas


def dirty_rows():
    def row(day, units=45, price=120.0, disc=0.0, promo=0, hol=0, stock=280.0, store="S01"):
        return (day, store, "P101", "Electronics", units, price, disc, promo, hol, stock, "North")

    return [
        row("2025-01-01", 50, disc=10.0, promo=1, hol=1, stock=300.0),
        row("2025-01-02"),
        row("2025-01-02"),
        row("2025-01-03", 40, disc=None, stock=260.0),
        row("2025-01-04", 60, price=None, disc=5.0, stock=240.0),
        row("2025-01-05", -10, stock=200.0),
        row("2025-01-06", 30, price=-5.0, stock=190.0),
        row("2025-01-07", 35, stock=180.0, store="INVALID"),
    ]


def dirty(spark):
    return spark.createDataFrame(dirty_rows(), schemas.RAW_SALES)


PANEL = (
    "Date date, Store_ID string, Product_ID string, Product_Category string, Units_Sold bigint, "
    "Unit_Price double, Discount double, Promotion int, Holiday int, Inventory_Level bigint, Region string"
)


def series(spark, days=40):
    """units = 50 + day of month % 10, from 2025-01-01."""
    start = date(2025, 1, 1)
    rows = []
    for i in range(days):
        d = start + timedelta(days=i)
        sale = d.day % 7 == 0
        rows.append((d, "S01", "P101", "Electronics", 50 + d.day % 10, 100.0, 10.0 if sale else 0.0,
                     int(sale), int(i == 0), 300, "North"))
    return spark.createDataFrame(rows, PANEL)


def panel(spark, rows):
    """Rows of (store, product, date, units) with the other columns constant."""
    return spark.createDataFrame(
        [(d, s, p, "Electronics", u, 10.0, 0.0, 0, 0, 5, "North") for s, p, d, u in rows], PANEL
    )


def products(spark, *ids):
    return spark.createDataFrame(
        [(i, f"Item {i}", "Electronics", Decimal("120.00")) for i in ids],
        "product_id string, product_name string, category string, unit_price decimal(10,2)",
    )
