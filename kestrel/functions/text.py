"""String cleaning used on labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() removes all surrounding whitespace (blank, tab, newline,
# CR, VT, FF); F.trim removes blanks only, so use an anchored regex.
_EDGE_WS = r"^\s+|\s+$"


def normalize_label(col: Column | str) -> Column:
    """``strip().lower()`` of a label; NULL stays NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.lower(F.regexp_replace(c, _EDGE_WS, ""))


def strip_chars(col: Column | str, chars: str, method: str = "translate") -> Column:
    """Remove every occurrence of each character in ``chars``.

    ``translate`` (character map) and ``regexp`` (regex class) give the same
    result; both are offered because both forms are in use.
    """
    c = F.col(col) if isinstance(col, str) else col
    if method == "translate":
        return F.translate(c, chars, "")
    if method == "regexp":
        cls = "".join("\\" + ch if not ch.isalnum() else ch for ch in chars)
        return F.regexp_replace(c, f"[{cls}]", "")
    raise ValueError(f"unknown method {method!r}")
