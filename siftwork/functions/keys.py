"""How ids, codes and names are compared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = r"^[\s\x{a0}\x{feff}]+|[\s\x{a0}\x{feff}]+$"


def norm_key(col: Column | str) -> Column:
    """Key without letter case and surrounding blanks; null where nothing is left."""
    c = F.col(col) if isinstance(col, str) else col
    return F.nullif(F.lower(F.regexp_replace(c.cast("string"), BLANKS, "")), F.lit(""))


def hex_key(col: Column | str, digits: int) -> Column:
    """Lower-case hex of exactly so many digits, else null."""
    c = norm_key(col)
    return F.when(c.rlike(f"^[0-9a-f]{{{digits}}}$"), c)


def one_row_per(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per value of ``key``: rows whose key is null are dropped, copies collapse. Where copies differ, the
    least struct of ``columns`` is kept, so the result doesn't depend on row order. Partial aggregation runs before
    the shuffle, so a key with very many copies costs one row per map task."""
    slim = df.where(F.col(key).isNotNull()).select(key, *columns)
    return slim.groupBy(key).agg(F.min(F.struct(*columns)).alias("_s")).select(key, *[F.col(f"_s.{c}").alias(c) for c in columns])
