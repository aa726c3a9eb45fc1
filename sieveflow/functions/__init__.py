from .text import (  # noqa: F401
    DUP_CONTENT, DUP_ID, NEW, REASON_NEW, TRACKER_VERSION,
    content_hash, first_nonempty, hash_prefix, iso_datetime,
    key_text, nonempty, normalized_text, percent, percent_text, reason_text,
    safe_ratio, seconds_text,
)
