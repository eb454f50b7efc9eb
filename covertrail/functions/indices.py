"""Spectral indices as column arithmetic.

A formula takes the bands of one season and gives a column; a zero denominator gives
NULL. Some formulas are kept as published maps use them, not as the literature has them
(gli is constant, gemi and wetness are simplified); their docstrings are the formulas.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .masks import to_unsigned

BANDS = ("blue", "green", "red", "nir", "swir1", "swir2")
SEASONS = {"annual": "", "wet": "_wet", "dry": "_dry"}


class Bands(NamedTuple):
    """The six bands of a season."""

    B: Column
    G: Column
    R: Column
    N: Column
    S1: Column
    S2: Column


def _ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def _difference(a: Column, b: Column) -> Column:
    return _ratio(a - b, a + b)


def _evi(s: Bands) -> Column:
    return _ratio(2.4 * (s.N - s.R), 1 + s.N + s.R)


def _spri(s: Bands) -> Column:
    return (_difference(s.G, s.B) + 1) / 2


# Formula, and the offset added before scaling to 16 bits.
INDICES: dict[str, tuple[Callable[[Bands], Column], int]] = {
    "ratio": (lambda s: _ratio(s.N, s.R), 0),
    "rvi": (lambda s: _ratio(s.R, s.N), 0),
    "ndvi": (lambda s: _difference(s.N, s.R), 1),
    "ndwi": (lambda s: _difference(s.N, s.S2), 1),
    "awei": (lambda s: 4 * (s.G - s.S2) - (0.25 * s.N + 2.75 * s.S1), 1),
    "iia": (lambda s: _ratio(s.G - 4 * s.N, s.G + 4 * s.N), 1),
    "evi": (_evi, 1),
    "lai": (lambda s: 3.618 * (_evi(s) - 0.118), 3),
    "gcvi": (lambda s: _ratio(s.N, s.G) - 1, 1),
    "gemi": (lambda s: _ratio(2 * (s.N * s.N - s.R * s.R) + 1.5 * s.N + 0.5 * s.R, s.N + s.G + 0.5), 3),
    "cvi": (lambda s: _ratio(s.N * s.G, s.B * s.B), 0),
    "gli": (lambda s: _ratio(2 * s.G - s.R - s.B, 2 * s.G - s.R - s.B), 1),
    "shape": (lambda s: _ratio(2 * s.R - s.G - s.B, s.G - s.B), 1),
    "afvi": (lambda s: _ratio(s.N - 0.5 * s.S2, s.N + 0.5 * s.S2), 1),
    "avi": (lambda s: s.N * (1 - s.R) * (s.N - s.R) / 3, 1),
    "bsi": (lambda s: _ratio((s.S1 - s.R) - (s.N + s.B), (s.S1 + s.R) + (s.N + s.B)), 1),
    "brba": (lambda s: _ratio(s.R, s.S1), 0),
    "dswi5": (lambda s: _ratio(s.N + s.G, s.S1 + s.R), 0),
    "lswi": (lambda s: _difference(s.N, s.S1), 1),
    "mbi": (lambda s: _ratio(s.S1 - s.S2 - s.N, s.S1 + s.S2 + s.N) + 0.5, 1),
    "ui": (lambda s: _difference(s.S2, s.N), 1),
    "osavi": (lambda s: _ratio(s.N - s.R, 0.16 + s.N + s.R), 1),
    "ri": (lambda s: _difference(s.N, s.G), 1),
    "brightness": (lambda s: 0.3037 * s.B + 0.2793 * s.G + 0.4743 * s.R + 0.5585 * s.N + 0.5082 * s.S1 + 0.1863 * s.S2, 1),
    "wetness": (lambda s: 0.1509 * s.B + 0.1973 * s.G + 0.3279 * s.R + 0.3406 * s.N + 0.7112 * s.S1 + 0.4572 * s.S2, 1),
    "msi": (lambda s: _ratio(s.N, s.S1), 1),
    "gvmi": (lambda s: _ratio((s.N + 0.1) - (s.S1 + 0.02), (s.N + 0.1) + (s.S1 + 0.02)), 3),
    "spri": (_spri, 1),
    "co2flux": (lambda s: _difference(s.N, s.S2) * _spri(s), 1),
}
#: The indices of the band list that samples are collected with. The list's two
#: textures, the contrast of near infrared and red, are neighbourhood operations: spatial.contrast().
PACK = ("ratio", "rvi", "ndwi", "awei", "iia", "gcvi", "gemi", "cvi", "gli", "shape", "afvi", "avi", "bsi", "brba", "dswi5", "lswi", "mbi", "ui", "osavi", "ri", "brightness", "wetness")


def bands(season: str = "annual") -> Bands:
    """Columns blue_median, blue_median_wet, ... of a season."""
    return Bands(*(F.col(f"{b}_median{SEASONS[season]}") for b in BANDS))


def index(name: str, season: str = "annual", scale: str = "float") -> Column:
    """One index; scale uint16 adds its offset, multiplies by 10000 and truncates."""
    formula, offset = INDICES[name]
    value = formula(bands(season))
    return to_unsigned((value + offset) * 10000, 16).cast("int") if scale == "uint16" else value


def add_index(df: DataFrame, name: str, season: str = "annual", scale: str = "float") -> DataFrame:
    return df.withColumn(f"{name}_median{SEASONS[season]}", index(name, season, scale))


def add_pack(df: DataFrame, seasons: tuple[str, ...] = ("annual",), scale: str = "float") -> DataFrame:
    """All indices of PACK for the seasons.

    As uint16 a season's values are one array that is scaled as a whole: the code that
    Spark makes of so many scaled formulas in a row is too long for the JVM to compile.
    """
    if scale != "uint16":
        return df.withColumns({f"{n}_median{SEASONS[s]}": index(n, s, scale) for s in seasons for n in PACK})
    values = {s: F.array(*(INDICES[n][0](bands(s)) + INDICES[n][1] for n in PACK)) for s in seasons}
    scaled = {f"_pack{SEASONS[s]}": F.transform(found, lambda x: to_unsigned(x * 10000, 16).cast("int")) for s, found in values.items()}
    picked = {f"{n}_median{SEASONS[s]}": F.col(f"_pack{SEASONS[s]}")[i] for s in seasons for i, n in enumerate(PACK)}
    return df.withColumns(scaled).withColumns(picked).drop(*scaled)


def fraction_index(df: DataFrame) -> DataFrame:
    """ndfia from the fractions gv, npv, soil."""
    gv, npv, soil = (F.col(c) for c in ("gv", "npv", "soil"))
    return df.withColumn("ndfia", _ratio(gv - soil, gv + 2 * npv + soil) + 1)


def rescale_reflectance(df: DataFrame, columns: list[str]) -> DataFrame:
    """Bands over 10000; slopeA is slope over 1500, slope stays."""
    return df.withColumns({c: F.col(c) / 10000 for c in columns} | {"slopeA": F.col("slope") / 1500})


def logistic(value: Column, mean: Column, stddev: Column) -> Column:
    """1 / (1 + exp(-z)) of the standardised value; NULL where stddev is zero."""
    z = _ratio(value - mean, stddev)
    return 1 / (1 + F.exp(-z))
