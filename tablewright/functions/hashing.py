"""SHA-2 and bucket hashing of columns.

All functions build JVM-side column expressions (``sha2``, ``hash``), so they
stay inside whole-stage codegen and work on batch and streaming frames alike.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference behaviour:
#   text used for a NULL input before hashing: "n/a"
#   accepted SHA-2 bit lengths: 224, 256, 384, 512, and 0 (same as 256)
#   default bucket count of the numeric hash: 500
NULL_TEXT = "n/a"
SHA2_BITS = (224, 256, 384, 512, 0)
DEFAULT_BUCKETS = 500


def _as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def check_bits(bits: int) -> int:
    """Reject bit lengths Spark would silently turn into NULL hashes."""
    if bits not in SHA2_BITS:
        raise ValueError(f"SHA-2 bit length must be one of {SHA2_BITS}, got {bits}")
    return bits


def text_or_na(c: str | Column) -> Column:
    """``coalesce(cast(c as string), 'n/a')``."""
    return F.coalesce(_as_column(c).cast("string"), F.lit(NULL_TEXT))


def concat_for_hash(cols: Iterable[str | Column]) -> Column:
    """Columns as text, NULL → ``n/a``, joined with no separator.

    With no separator ("ab", "c") and ("a", "bc") give the same text; that is
    the defined behaviour, kept on purpose.
    """
    parts = [text_or_na(c) for c in cols]
    return F.concat(*parts) if parts else F.lit("")


def sha2_of(cols: Iterable[str | Column], bits: int = 256) -> Column:
    return F.sha2(concat_for_hash(cols), check_bits(bits))


def hash_columns(df: DataFrame, alias: str, bits: int, *cols: str | Column) -> DataFrame:
    """one SHA-2 column over the concatenation of ``cols``."""
    return df.withColumn(alias, sha2_of(cols, bits))


def hash_each(df: DataFrame, bits: int, *cols: str) -> DataFrame:
    """one ``<col>_hash`` column per input column."""
    check_bits(bits)
    return df.withColumns({f"{c}_hash": F.sha2(text_or_na(c), bits) for c in cols})


def hash_bucket(*cols: str | Column, buckets: int = DEFAULT_BUCKETS) -> Column:
    """``abs(murmur3(concat)) mod buckets`` in ``[0, buckets)``.

    The 32-bit hash is widened to bigint before ``abs`` so that the minimum
    int gives a positive bucket instead of an ANSI overflow error.
    """
    if buckets <= 0:
        raise ValueError("buckets must be positive")
    return F.abs(F.hash(concat_for_hash(cols)).cast("long")) % F.lit(buckets)


def hash_bucket_column(df: DataFrame, alias: str, *cols: str | Column, buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    return df.withColumn(alias, hash_bucket(*cols, buckets=buckets))


def sha256_text(c: str | Column) -> Column:
    """hex SHA-256 of one string column (NULL stays NULL)."""
    return F.sha2(_as_column(c).cast("string"), 256)
