"""privlink: privacy-aware record linkage on Spark DataFrames."""

from .operators.analysis import exposure_report, exposure_stats, user_code_counts
from .operators.link import link_by_interval
from .operators.privacy import decrypt_columns, encrypt_columns, hash_columns, key_record, new_key

__all__ = [
    "decrypt_columns",
    "encrypt_columns",
    "exposure_report",
    "exposure_stats",
    "hash_columns",
    "key_record",
    "link_by_interval",
    "new_key",
    "user_code_counts",
]
