"""Column-level helpers built only from ``pyspark.sql.functions``."""

from ledgerline.functions.guid import run_guid, stable_guid
from ledgerline.functions.text import (
    base_name, call_stack, error_file_name, error_message, extension,
    has_accepted_extension, log_timestamp, severity, stem,
)
from ledgerline.functions.values import coerce, null_tokens_to_null, parse_amount

__all__ = [
    "base_name", "call_stack", "coerce", "error_file_name", "error_message",
    "extension", "has_accepted_extension", "log_timestamp", "null_tokens_to_null",
    "parse_amount", "run_guid", "severity", "stable_guid", "stem",
]
