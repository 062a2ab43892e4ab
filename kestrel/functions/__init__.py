"""Column-level helpers (JVM-side expressions only, no Python UDFs)."""

from kestrel.functions.text import normalize_label, strip_chars
from kestrel.functions.hashing import hash_key, hash_bucket, hash_pick
from kestrel.functions.categorize import category_of, label_map_frame, map_categories
from kestrel.functions.parse import parse_delimited, render_delimited, bytes_to_string

__all__ = [
    "normalize_label", "strip_chars", "hash_key", "hash_bucket", "hash_pick",
    "category_of", "label_map_frame", "map_categories", "parse_delimited",
    "render_delimited", "bytes_to_string",
]
