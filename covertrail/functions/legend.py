"""Class codes, names and remap tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Map codes to the classes of the series; codes not listed are masked.
MAP_FROM = (3, 4, 5, 9, 12, 13, 15, 18, 19, 20, 21, 22, 23, 24, 25, 26, 29, 30, 31, 32, 33, 36, 37, 38, 39, 40, 41, 42, 43, 44, 45, 46, 47, 48, 49, 50, 62)
MAP_TO = (3, 4, 3, 3, 12, 12, 21, 21, 21, 21, 21, 22, 22, 22, 22, 33, 29, 22, 33, 12, 33, 21, 33, 33, 21, 21, 21, 21, 21, 21, 21, 21, 21, 21, 4, 12, 21)
MAP_CODES = dict(zip(MAP_FROM, MAP_TO))

# Classes of point and area tables to those compared; others stay.
TABLE_CODES = {3: 3, 4: 4, 9: 12, 10: 12, 12: 12, 15: 21, 18: 21, 21: 21, 22: 22, 27: 27, 29: 22, 33: 33, 50: 3}

# Codes for the ten-class series used in sampling.
SAMPLE_FROM = (3, 4, 5, 9, 12, 13, 15, 18, 19, 20, 21, 22, 23, 24, 25, 26, 29, 30, 31, 32, 33, 36, 39, 40, 41, 46, 47, 48, 49, 50, 62)
SAMPLE_TO = (3, 4, 3, 3, 12, 12, 15, 18, 18, 18, 18, 22, 22, 22, 22, 33, 29, 22, 33, 12, 33, 18, 18, 18, 18, 18, 18, 18, 4, 4, 21)
SAMPLE_CODES = dict(zip(SAMPLE_FROM, SAMPLE_TO))

# Cover name, natural or anthropic, colour.
LEGEND = {
    3: ("Forest Formation", "Natural", "#1f8d49"),
    4: ("Savanna Formation", "Natural", "#7dc975"),
    12: ("Grassland", "Natural", "#d6bc74"),
    15: ("Pasture", "Antrópico", "#edde8e"),
    18: ("Agriculture", "Antrópico", "#f5b3c8"),
    21: ("Mosaic of Uses", "Antrópico", "#ffefc3"),
    22: ("Non vegetated area", "Antrópico", "#db4d4f"),
    27: ("Not Observed", "Not Observed", "#112013"),
    29: ("Rocky Outcrop", "Natural", "#FF8C00"),
    33: ("Water", "Natural", "#0000FF"),
}
LEVEL1_COLORS = {"Natural": "#32a65e", "Antrópico": "#FFFFB2", "Not Observed": "#112013"}

# Legend texts of reference points.
LABEL_CODES = {
    "FORMAÇÃO FLORESTAL": 3,
    "FORMAÇÃO SAVÂNICA": 4,
    "MANGUE": 3,
    "RESTINGA HERBÁCEA": 3,
    "FLORESTA PLANTADA": 18,
    "FLORESTA INUNDÁVEL": 3,
    "CAMPO ALAGADO E ÁREA PANTANOSA": 12,
    "APICUM": 12,
    "FORMAÇÃO CAMPESTRE": 12,
    "AFLORAMENTO ROCHOSO": 29,
    "OUTRA FORMAÇÃO NÃO FLORESTAL": 12,
    "PASTAGEM": 15,
    "CANA": 18,
    "LAVOURA TEMPORÁRIA": 18,
    "LAVOURA PERENE": 18,
    "MINERAÇÃO": 22,
    "PRAIA E DUNA": 22,
    "INFRAESTRUTURA URBANA": 22,
    "VEGETAÇÃO URBANA": 22,
    "OUTRA ÁREA NÃO VEGETADA": 22,
    "RIO, LAGO E OCEANO": 33,
    "AQUICULTURA": 33,
    "NÃO OBSERVADO": 27,
}

# Labels of the field survey.
FIELD_CODES = {
    "afloramentos": 29,
    "agricultura": 21,
    "agua": 33,
    "aquicultura": 33,
    "campo": 12,
    "carnaúbas": 21,
    "desmatamento": 22,
    "exotica": 21,
    "floresta": 3,
    "mineração": 22,
    "mosaico de uso": 21,
    "pastagem": 21,
    "regeneração savana": 4,
    "savana": 4,
    "solo exposto": 22,
    "urbano": 22,
    "áreas não vegetadas": 22,
}

# Level 1, 2 and 3 codes of a class, and the level 1 names.
LEVELS = {
    0: (0, 0, 0),
    3: (1, 2, 3),
    4: (1, 2, 4),
    5: (1, 2, 5),
    9: (1, 9, 9),
    11: (10, 11, 11),
    12: (10, 12, 12),
    13: (10, 13, 13),
    15: (14, 15, 15),
    19: (14, 18, 19),
    20: (14, 18, 20),
    21: (14, 21, 21),
    23: (22, 23, 23),
    24: (22, 24, 24),
    25: (22, 25, 25),
    29: (10, 29, 29),
    30: (22, 30, 30),
    31: (26, 31, 31),
    32: (10, 32, 32),
    33: (26, 33, 33),
}
LEVEL1_NAMES = {
    0: "6. Não Observado",
    1: "1. Floresta",
    10: "2. Formação Natural não Florestal",
    14: "3. Agropecuária",
    22: "4. Área não Vegetada",
    26: "5. Corpo D'água",
}

#: Classes of the confusion matrices.
CONFUSION = (3, 4, 12, 21, 22, 33)


def field(col: Column, which: int) -> Column:
    """Cover name (0), natural or anthropic (1), or colour (2) of a class."""
    pairs = [F.lit(x) for k, v in LEGEND.items() for x in (k, v[which])]
    return F.try_element_at(F.create_map(*pairs), col)


def enrich(df: DataFrame, cls: str = "class") -> DataFrame:
    """Adds cobertura, cob_level1, cob_color, nat_color and the constant total."""
    level1 = field(F.col(cls), 1)
    colors = F.create_map(*(F.lit(x) for pair in LEVEL1_COLORS.items() for x in pair))
    return df.withColumns(
        {
            "cobertura": field(F.col(cls), 0),
            "cob_level1": level1,
            "cob_color": field(F.col(cls), 2),
            "nat_color": F.try_element_at(colors, level1),
            "total": F.lit("cobertura"),
        }
    )


def level(col: Column, which: int) -> Column:
    """Level 1, 2 or 3 code of a class."""
    pairs = [F.lit(x) for k, v in LEVELS.items() for x in (k, v[which - 1])]
    return F.try_element_at(F.create_map(*pairs), col)


def level1_name(col: Column) -> Column:
    pairs = [F.lit(x) for pair in LEVEL1_NAMES.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), level(col, 1))
