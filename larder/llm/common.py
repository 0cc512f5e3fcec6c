"""Column expressions and helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.session import long_rows as prepare  # noqa: F401

# The character classes of the contracts.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lower_az(text: Column | str) -> Column:
    """Lower-case A-Z and nothing else; an ASCII text takes the fast way."""
    c = col(text)
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def count_words(text: Column | str) -> Column:
    """Number of runs of non-blank characters, 0 for null."""
    return F.coalesce(F.regexp_count(col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def hex_number(*parts: Column | str) -> Column:
    """Number below 2**32 from the first eight hex digits of the MD5 of the joined parts (null: empty)."""
    joined = F.concat_ws(":", *[F.coalesce(col(p).cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("bigint")
