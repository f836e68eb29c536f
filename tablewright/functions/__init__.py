from tablewright.functions.hashing import (
    DEFAULT_BUCKETS,
    NULL_TEXT,
    SHA2_BITS,
    concat_for_hash,
    hash_bucket,
    hash_bucket_column,
    hash_columns,
    hash_each,
    sha2_of,
    sha256_text,
)
from tablewright.functions.timefmt import epoch_millis, epoch_millis_text, filter_year_range

__all__ = [
    "DEFAULT_BUCKETS",
    "NULL_TEXT",
    "SHA2_BITS",
    "concat_for_hash",
    "epoch_millis",
    "epoch_millis_text",
    "filter_year_range",
    "hash_bucket",
    "hash_bucket_column",
    "hash_columns",
    "hash_each",
    "sha2_of",
    "sha256_text",
]
