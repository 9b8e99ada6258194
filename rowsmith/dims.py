"""Fixed lookup values. Every table here has at most a few dozen rows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Unit kind, id, and size in the kind's base unit (metre, kilogram, litre).
UNITS = [
    ("length", "mm", 0.001), ("length", "cm", 0.01), ("length", "m", 1.0), ("length", "km", 1000.0),
    ("length", "in", 0.0254), ("length", "ft", 0.3048), ("length", "yd", 0.9144),
    ("length", "mi", 1609.344), ("length", "nmi", 1852.0),
    ("weight", "mg", 0.000001), ("weight", "g", 0.001), ("weight", "kg", 1.0), ("weight", "t", 1000.0),
    ("weight", "oz", 0.028349523125), ("weight", "lb", 0.45359237), ("weight", "stone", 6.35029318),
    ("volume", "ml", 0.001), ("volume", "l", 1.0), ("volume", "m3", 1000.0),
    ("volume", "tsp", 0.00492892159375), ("volume", "tbsp", 0.01478676478125),
    ("volume", "cupus", 0.2365882365), ("volume", "cupm", 0.25), ("volume", "ptus", 0.473176473),
    ("volume", "qtus", 0.946352946), ("volume", "galus", 3.785411784), ("volume", "galimp", 4.54609),
]

# Fixed values, ours: speed in metres per second, storage in bytes, kitchen volume in litres.
SPEED_UNITS = [
    ("speed", "m/s", 1.0), ("speed", "km/h", 1000.0 / 3600.0), ("speed", "mph", 0.44704),
    ("speed", "knot", 1852.0 / 3600.0), ("speed", "ft/s", 0.3048),
]
STORAGE_UNITS = [("storage", "B", 1.0)] + [
    ("storage", prefix + end, float(base) ** power)
    for base, end, prefixes in ((1000, "B", "kMGTP"), (1024, "iB", "KMGTP"))
    for power, prefix in enumerate(prefixes, 1)
]
KITCHEN_UNITS = [
    ("kitchen", "tsp", 0.005), ("kitchen", "tbsp", 0.015), ("kitchen", "cup_in", 0.2),
    ("kitchen", "cup_m", 0.25), ("kitchen", "cup_us", 0.2365882365), ("kitchen", "ml", 0.001), ("kitchen", "l", 1.0),
]
# Fixed values, ours: grams in a millilitre.
INGREDIENT_DENSITY = [
    ("water", 1.0), ("milk", 1.03), ("sugar", 0.85), ("flour", 0.53), ("rice", 0.85), ("butter", 0.911), ("oil", 0.92),
]

# Temperature scale, offset and factor with celsius = (v - offset) * factor.
SCALES = {"c": (0.0, 1.0), "f": (32.0, 5.0 / 9.0), "k": (273.15, 1.0), "r": (491.67, 5.0 / 9.0)}
ABSOLUTE_ZERO_C = -273.15

# Shoe sizes as group, then rows of UK, US, EU, foot length in cm.
SHOE_CHART = {
    "men": [
        (5, 6, 38, 23.5), (5.5, 6.5, 38.5, 24), (6, 7, 39, 24.5), (6.5, 7.5, 40, 25), (7, 8, 41, 25.5),
        (7.5, 8.5, 41.5, 26), (8, 9, 42, 26.5), (8.5, 9.5, 43, 27), (9, 10, 43.5, 27.5), (9.5, 10.5, 44, 28),
        (10, 11, 44.5, 28.5), (10.5, 11.5, 45, 29), (11, 12, 46, 29.5), (11.5, 12.5, 46.5, 30),
        (12, 13, 47, 30.5), (13, 14, 48, 31.5),
    ],
    "women": [
        (2, 4, 34.5, 21.5), (2.5, 4.5, 35, 22), (3, 5, 35.5, 22.5), (3.5, 5.5, 36, 22.8), (4, 6, 37, 23.2),
        (4.5, 6.5, 37.5, 23.5), (5, 7, 38, 24), (5.5, 7.5, 38.5, 24.3), (6, 8, 39, 24.6), (6.5, 8.5, 40, 25),
        (7, 9, 40.5, 25.4), (7.5, 9.5, 41, 25.7), (8, 10, 42, 26), (8.5, 10.5, 42.5, 26.3), (9, 11, 43, 26.7),
    ],
}

# Square feet in a land unit; a bigha has no size of its own.
ACRE_SQFT = 43560.0
AREA_UNITS = [
    ("sqft", 1.0), ("sqyd", 9.0), ("sqm", ACRE_SQFT / 4046.8564224), ("acre", ACRE_SQFT), ("guntha", 1089.0),
    ("cent", 435.6), ("ground", 2400.0), ("kanal", 5445.0), ("marla", 272.25),
    ("hectare", ACRE_SQFT / 4046.8564224 * 10000.0),
]
BIGHA_SQYD = (1600.0, 2400.0, 2700.0)

# Made-up rates for trying things out: units of the currency for one euro. Real ones come from a rates file.
RATES_DATE = "2024-01-02"
RATES = {
    "AUD": 1.6, "BRL": 5.5, "CAD": 1.5, "CHF": 0.95, "CNY": 7.5, "CZK": 25.0, "DKK": 7.45, "GBP": 0.85, "HKD": 8.5, "HUF": 390.0,
    "INR": 90.0, "JPY": 160.0, "KRW": 1450.0, "MXN": 19.0, "MYR": 5.0, "NOK": 11.5, "NZD": 1.8, "PLN": 4.4, "RON": 5.0,
    "SEK": 11.25, "SGD": 1.45, "THB": 38.0, "TRY": 35.0, "USD": 1.08, "ZAR": 20.0,
}

# Income tax brackets as (from, to, rate); the last one is open.
TOP = 1e15
TAX_SLABS = {
    "new": [
        (0, 400000, 0.0), (400000, 800000, 0.05), (800000, 1200000, 0.10), (1200000, 1600000, 0.15),
        (1600000, 2000000, 0.20), (2000000, 2400000, 0.25), (2400000, TOP, 0.30),
    ],
    "old": [(0, 250000, 0.0), (250000, 500000, 0.05), (500000, 1000000, 0.20), (1000000, TOP, 0.30)],
}
STANDARD_DEDUCTION = {"new": 75000.0, "old": 50000.0}
REBATE_LIMIT = {"new": 1200000.0}
CESS = 0.04


def table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A literal table; handed over as Arrow so the planner sees its true size."""
    schema = StructType.fromDDL(ddl)
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    arrow = to_arrow_schema(schema)
    return spark.createDataFrame(
        pa.table([pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)], schema=arrow), schema
    )


def units(spark: SparkSession, rows: list[tuple] = UNITS) -> DataFrame:
    return table(spark, rows, "kind string, unit string, size double")


def rates(spark: SparkSession) -> DataFrame:
    return table(spark, [("EUR", 1.0), *RATES.items()], "currency string, rate double")


def shoe_chart(spark: SparkSession) -> DataFrame:
    rows = [
        (group, ord_, *map(float, sizes))
        for group, chart in SHOE_CHART.items()
        for ord_, sizes in enumerate(chart)
    ]
    return table(spark, rows, "grp string, ord int, uk double, us double, eu double, cm double")


def area_units(spark: SparkSession) -> DataFrame:
    return table(spark, AREA_UNITS, "unit string, sqft double")


def tax_slabs(spark: SparkSession) -> DataFrame:
    rows = [(name, float(lo), float(hi), rate) for name, slabs in TAX_SLABS.items() for lo, hi, rate in slabs]
    return table(spark, rows, "regime string, lo double, hi double, rate double")
