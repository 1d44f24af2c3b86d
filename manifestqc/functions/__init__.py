"""Column -> Column functions (all JVM-side built-ins, no Python UDFs)."""

from manifestqc.functions.blank import (
    DEFAULT_NA_TOKENS, apply_na_tokens, is_blank, is_blank_trimmed, not_blank, strip_ws,
)
from manifestqc.functions.dates import normalize_date, normalize_date_strict
from manifestqc.functions.geo import decimal_text, normalize_geo, normalize_latlon
from manifestqc.functions.paths import (
    basename, destination_path, expected_mate, is_read1, is_sequence_file, mate_name,
    resolve_path, safe_name, sample_name_from_file,
)
from manifestqc.functions.text import (
    LAYOUT_SYNONYMS, SOURCE_SYNONYMS, canonicalize, infer_host, infer_isolation_source,
    infer_sample_source, transfer_failed, transfer_ok,
)

__all__ = [
    "DEFAULT_NA_TOKENS", "apply_na_tokens", "is_blank", "is_blank_trimmed", "not_blank",
    "strip_ws", "normalize_date", "normalize_date_strict", "decimal_text", "normalize_geo",
    "normalize_latlon", "basename", "destination_path", "expected_mate", "is_read1",
    "is_sequence_file", "mate_name", "resolve_path", "safe_name", "sample_name_from_file",
    "LAYOUT_SYNONYMS", "SOURCE_SYNONYMS", "canonicalize", "infer_host",
    "infer_isolation_source", "infer_sample_source", "transfer_failed", "transfer_ok",
]
