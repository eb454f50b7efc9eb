"""Maps, tables and registries in files: partitioned Parquet, CSV with explicit schemas, JSON."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

INDEX_COLUMNS = ("system:index", ".geo")


def read_csv_glob(spark: SparkSession, path: str, schema: StructType | str, encoding: str = "UTF-8") -> DataFrame:
    """All CSV files of a glob as one table, with file_name, without index and geometry columns."""
    rows = spark.read.schema(schema).option("encoding", encoding).csv(path, header=True)
    return rows.select("*", F.col("_metadata.file_name").alias("file_name")).drop(*INDEX_COLUMNS)


def parse_name(df: DataFrame, fields: Iterable[str], name: str = "file_name") -> DataFrame:
    """Columns from a file name cut at underscores; * skips a piece."""
    pieces = F.split(F.regexp_replace(F.col(name), r"\.[A-Za-z]+$", ""), "_")
    return df.withColumns({f: F.get(pieces, F.lit(i)) for i, f in enumerate(fields) if f != "*"})


def write_map(df: DataFrame, path: str, **properties: str) -> None:
    """A map under version and basin folders, so that filters on them prune files."""
    df.withColumns({k: F.lit(v) for k, v in properties.items()}).write.mode("overwrite").partitionBy("version", "basin").parquet(path)


def scan_map(spark: SparkSession, path: str, **equals: str) -> DataFrame:
    """The maps whose properties equal the given ones."""
    test: Column = F.lit(True)
    for k, v in equals.items():
        test = test & (F.col(k) == v)
    return spark.read.parquet(path).where(test)


def product_of(version: Column) -> Column:
    """Which map product a version is read from."""
    return F.when(version > 6, "probability").otherwise("plain")


def scan_scenes(scenes: DataFrame, columns: Iterable[str], **allowed: Iterable) -> DataFrame:
    """The columns of scenes whose attributes are in the given lists."""
    for k, values in allowed.items():
        scenes = scenes.where(F.col(k).isin(*values))
    return scenes.select(*columns)


def write_table(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """A table as Parquet or as CSV with a header."""
    writer = df.write.mode("overwrite")
    writer.csv(path, header=True) if kind == "csv" else writer.parquet(path)


def load_registry(spark: SparkSession, path: str, schema: str, whole: bool = True) -> DataFrame:
    """A JSON object in a file, or one a line, as rows (key, value), value read by its schema."""
    text = spark.read.text(path, wholetext=whole)
    return text.select(F.explode(F.from_json("value", f"map<string,{schema}>")))


def write_registry(df: DataFrame, path: str, key: str, value: str) -> None:
    """One JSON object {key: [values]} for each key, a line each."""
    grouped = df.groupBy(key).agg(F.sort_array(F.collect_list(value)).alias("values"))
    grouped.select(F.to_json(F.create_map(F.col(key).cast("string"), F.col("values"))).alias("value")).write.mode("overwrite").text(path)


def selected_bands(ranked: DataFrame, most: int) -> DataFrame:
    """basin, year, rank, band, limear: the bands of rank up to a limit, and how many they are."""
    kept = ranked.where(F.col("rank") <= most)
    counts = kept.groupBy("basin", "year").agg(F.count("*").alias("limear"))
    return kept.join(counts, ["basin", "year"])


def _interleaved(c: Column) -> Column:
    """The low 21 bits of a number, a zero bit between each two."""
    bits = c.cast("long").bitwiseAND((1 << 21) - 1)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        bits = bits.bitwiseOR(F.shiftleft(bits, shift)).bitwiseAND(mask)
    return bits


def morton(x: Column, y: Column) -> Column:
    """Place on the Z-shaped curve of whole coordinates from -2**20 on: it rises with x and with y, and what is near lies near."""
    return _interleaved(x + (1 << 20)).bitwiseOR(F.shiftleft(_interleaved(y + (1 << 20)), 1))


def write_tiled(df: DataFrame, path: str, side: int = 1024, rows_per_file: int = 20_000_000) -> None:
    """A map (x, y, more) in folders by tile, in Morton order of tiles and, inside, of pixels; files are bounded.

    A column named tile is replaced.
    """
    tile = morton(F.floor(F.col("x") / side), F.floor(F.col("y") / side))
    ordered = df.withColumn("tile", tile).withColumn("_at", morton(F.col("x"), F.col("y"))).repartitionByRange("tile", "_at").sortWithinPartitions("tile", "_at").drop("_at")
    ordered.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy("tile").parquet(path)


def read_window(spark: SparkSession, path: str, x0: int, y0: int, x1: int, y1: int, side: int = 1024) -> DataFrame:
    """The pixels of a window (ends included; a point has x0 = x1, y0 = y1) of a map that write_tiled() wrote with this side.

    Only the folders between the window's first and last tile of the curve are listed to be
    read, and of their files the row groups that can hold the window.
    """
    z = lambda x, y: morton(F.lit(x // side), F.lit(y // side))
    rows = spark.read.parquet(path).where((F.col("tile") >= z(x0, y0)) & (F.col("tile") <= z(x1, y1)))
    return rows.where(F.col("x").between(x0, x1) & F.col("y").between(y0, y1)).drop("tile")
