"""Scalar column functions (JVM-side built-ins only, no Python UDFs).

Fingerprint, key normalisation, reason texts, ISO dates, rates.
"""

from __future__ import annotations

import re
import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's output texts.
# ---------------------------------------------------------------------------
REASON_NEW = "No duplicate detected"
REASON_ID = "Message ID {message_id} already processed for channel {channel_id}"
REASON_CONTENT = "Identical content already processed (hash: {prefix}...)"
TRACKER_VERSION = "2.0.0"
DEFAULT_STATUS = "completed"
ZERO_RATE_TEXT = "0%"
# ---------------------------------------------------------------------------

# Status values of the ordered ingest (ours).
NEW = "new"
DUP_ID = "dup_id"
DUP_CONTENT = "dup_content"

# Python's str.strip() removes every code point whose isspace() is true (29
# of them: the Unicode White_Space set plus U+001C..U+001F). The set is taken
# from that rule and handed to Spark's character-set trim (no regex per row).
PY_WHITESPACE = "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nonempty(c) -> Column:
    """Null when the value is null or the empty string."""
    return F.nullif(col_(c), F.lit(""))


def first_nonempty(*cols) -> Column:
    """First value that is neither null nor '' (Python's ``a or b or ''``)."""
    return F.coalesce(*[nonempty(c) for c in cols], F.lit(""))


def key_text(c) -> Column:
    """Key component: cast to string, missing -> ''."""
    return F.coalesce(col_(c).cast("string"), F.lit(""))


def normalized_text(c) -> Column:
    """Lower-case, then strip whitespace at both ends (inner blanks count)."""
    return F.btrim(F.lower(col_(c)), F.lit(PY_WHITESPACE))


def content_hash(c) -> Column:
    """SHA-256 hex digest of the normalised text (UTF-8)."""
    return F.sha2(normalized_text(c), 256)


def hash_prefix(h, n: int = 8) -> Column:
    return F.substring(col_(h), 1, n)


def _fill(template: str, **cols: Column) -> Column:
    """``template`` with ``{name}`` placeholders as a ``concat`` of columns."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[cols[p] if i % 2 else F.lit(p) for i, p in enumerate(parts) if p])


def reason_text(status, message_id="message_id", channel_id="channel_id",
                content_hash_col="content_hash") -> Column:
    """Reason text of a classification, as the reference words it."""
    s = col_(status)
    by_id = _fill(REASON_ID, message_id=col_(message_id), channel_id=col_(channel_id))
    by_content = _fill(REASON_CONTENT, prefix=hash_prefix(content_hash_col))
    return (F.when(s == DUP_ID, by_id)
            .when(s == DUP_CONTENT, by_content)
            .otherwise(F.lit(REASON_NEW)))


def iso_datetime(ts) -> Column:
    """ISO-8601 text like Python's ``datetime.isoformat()``: the fraction
    is printed only when it is not zero."""
    t = col_(ts)
    whole = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(t, "SSSSSS")
    return F.when(t.isNull(), F.lit(None).cast("string")).when(
        frac == "000000", whole).otherwise(F.concat(whole, F.lit("."), frac))


def safe_ratio(num, den) -> Column:
    """num/den, 0 when den is 0 (ANSI mode raises on division by zero)."""
    d = col_(den)
    return F.when(d > 0, col_(num).cast("double") / d).otherwise(F.lit(0.0))


def percent(num, den) -> Column:
    return safe_ratio(num, den) * F.lit(100.0)


def percent_text(num, den) -> Column:
    """Rate text with one decimal and '%', '0%' for an empty total.

    ``format_number`` rounds the exact binary value, half to even, as Python's
    ``.1f`` does (``round``, ``bround`` and ``format_string`` round the
    shortest decimal form instead)."""
    d = col_(den)
    text = F.call_function("format_number", percent(num, den), F.lit("0.0"))
    return F.when(d > 0, F.concat(text, F.lit("%"))).otherwise(F.lit(ZERO_RATE_TEXT))


def seconds_text(x) -> Column:
    """Seconds with two decimals, display only, rounded like Python's ``.2f``."""
    return F.concat(F.call_function("format_number", col_(x).cast("double"), F.lit("0.00")), F.lit("s"))
