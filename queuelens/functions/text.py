"""Text normalisation shared by the cleaning steps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace a Python ``str.strip()`` removes (every character whose
# ``isspace()`` is true -- tabs, line breaks, separators, no-break and
# other Unicode spaces), built from that rule rather than listed by hand.
# ``trim`` would only remove the ASCII space.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
_CLASS = "[" + "".join(f"\\x{{{ord(c):04X}}}" for c in WHITESPACE) + "]"
_EDGES = f"^{_CLASS}+|{_CLASS}+$"


def strip_ws(col: Column | str) -> Column:
    """Remove surrounding whitespace like ``str.strip()``.

    The regex only runs on values whose first or last character is
    whitespace (two one-character lookups); clean values pass unchanged."""
    c = F.col(col) if isinstance(col, str) else col
    chars = list(WHITESPACE)
    dirty = F.substring(c, 1, 1).isin(*chars) | F.substring(c, -1, 1).isin(*chars)
    return F.when(dirty, F.regexp_replace(c, _EDGES, "")).otherwise(c)

