"""Operator 9: secret scans.

One Aho-Corasick pass over the (ASCII) lower-cased text finds the keywords;
regular expressions run *anchored* at those hits only, so most of a text is
never seen by a regular expression. Hexadecimal runs have no keyword: a run of
32 or more covers every position that is a multiple of 32 within it, so only
those positions are probed and the run around a probe is measured.
Tokens that carry a checksum count only when it holds.

Kinds. Base: ``assign``, ``access``, ``hex`` (leftmost non-overlapping matches
of each pattern, those too short dropped). Added by the method:

* ``github`` -- ``gh[pousr]_`` and 36 base-62 digits, the last 6 being the
  CRC-32 of the 30 before them;
* ``npm`` -- ``npm_`` and the same 30 + 6;
* ``wif`` -- uncompressed private keys in Base58Check (51 characters, version
  byte 0x80, four bytes of double SHA-256).

Scale: a map over rows without a shuffle; other columns never reach Python.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveflow.llm.columns import free_name

KINDS = ("assign", "access", "hex", "github", "npm", "wif")
BASE = KINDS[:3]

_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_HEX_TAIL = re.compile(r"[0-9a-f]*")
_CRC = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_WIF = re.compile(r"5[HJK][1-9A-HJ-NP-Za-km-z]{49}(?![1-9A-HJ-NP-Za-km-z])")
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_CRC_WORDS = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
_WIF_WORDS = ("5h", "5j", "5k")
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
_LEAST_HEX, _LEAST_ACCESS, _LEAST_VALUE = 32, 16, 8
_TO_LOWER = {i: i + 32 for i in range(65, 91)}


@lru_cache(maxsize=1)
def _keywords():
    import ahocorasick

    found = ahocorasick.Automaton()
    for word in _ASSIGN_WORDS:
        found.add_word(word, ("assign", len(word)))
    for word in _CRC_WORDS:
        found.add_word(word, ("crc", len(word)))
    for word in _WIF_WORDS:
        found.add_word(word, ("wif", len(word)))
    found.add_word("akia", ("access", 4))
    found.make_automaton()
    return found


def crc_digits(body: str) -> str:
    """The six base-62 digits of the CRC-32 of ``body``."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = _BASE62[d] + out
    return out


def _wif_holds(key: str) -> bool:
    n = 0
    for c in key:
        n = n * 58 + _BASE58.index(c)
    if n.bit_length() > 37 * 8:
        return False
    raw = n.to_bytes(37, "big")
    return raw[0] == 0x80 and hashlib.sha256(hashlib.sha256(raw[:33]).digest()).digest()[:4] == raw[33:]


def _is_hex(c: str) -> bool:
    return "0" <= c <= "9" or "a" <= c <= "f"


def _hex_runs(text: str) -> list[tuple[int, int, str]]:
    out, end = [], 0
    step = _LEAST_HEX
    for k, c in enumerate(text[step - 1::step], 1):
        p = k * step - 1
        if p < end or not _is_hex(c):
            continue
        stop = _HEX_TAIL.match(text, p).end()
        start = p
        while start > 0 and _is_hex(text[start - 1]):
            start -= 1
        end = stop
        if stop - start >= _LEAST_HEX:
            out.append((start, stop, "hex"))
    return out


def find_secrets(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every secret, by start and then kind; code points,
    end exclusive."""
    if not text:
        return []
    low = text.lower()
    if len(low) != len(text):  # a letter whose lower case is longer: keep positions
        low = text.translate(_TO_LOWER)
    out, ends = [], {"assign": 0, "access": 0, "crc": 0, "wif": 0}
    hits = sorted((stop + 1 - n, kind) for stop, (kind, n) in _keywords().iter(low))
    for start, kind in hits:
        if start < ends[kind]:
            continue
        if kind == "assign":
            if m := _ASSIGN.match(text, start):
                ends[kind] = m.end()
                if m.end(2) - m.start(2) >= _LEAST_VALUE:
                    out.append((start, m.end(), kind))
        elif kind == "access":
            if m := _ACCESS.match(text, start):
                ends[kind] = m.end()
                if m.end() - start >= _LEAST_ACCESS:
                    out.append((start, m.end(), kind))
        elif kind == "crc":
            if (m := _CRC.match(text, start)) and crc_digits(m[1]) == m[2]:
                ends[kind] = m.end()
                out.append((start, m.end(), "npm" if m[0][0] == "n" else "github"))
        elif (m := _WIF.match(text, start)) and _wif_holds(m[0]):
            ends[kind] = m.end()
            out.append((start, m.end(), kind))
    out += _hex_runs(text)
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def _joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


_SPANS = "array<struct<start:long,end:long,kind:string>>"
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))


def secret_spans(text: str | Column) -> Column:
    """Array of (start, end, kind) of each secret in ``text`` (null: none)."""

    @F.arrow_udf(_SPANS)
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([[{"start": s, "end": e, "kind": k} for s, e, k in find_secrets(t.as_py())]
                            for t in batch], type=_SPAN_TYPE)

    return spans(F.col(text) if isinstance(text, str) else text)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, n_assign, n_access, n_hex, base_sha256, spans, n_added), one
    row per row of ``docs``.

    ``spans`` joins ``kind:start:end`` of all secrets by commas, by start and
    then kind; ``base_sha256`` is the SHA-256 of that list over the base kinds.
    A null or empty text has no secret (the digest is that of the empty
    string). Repeated rows, null ids and any further columns are fine: each
    row is judged by its text alone. No rows: an empty result.
    """
    spans = docs.select(F.col(id_col).alias("_id"), secret_spans(text_col).alias("_spans"))
    base = F.filter("_spans", lambda s: s["kind"].isin(*BASE))
    text = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("_spans", lambda s: s["kind"] == k)).cast("long")
    return spans.select(
        F.col("_id").alias(id_col), *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("_spans")).alias("spans"),
        (F.size("_spans") - F.size(base)).cast("long").alias("n_added"))


def redact(text: str | None, mark: str) -> str | None:
    """``text`` with every secret replaced by ``mark``; overlapping secrets by one."""
    spans = find_secrets(text)
    if not spans:
        return text
    out, at = [], 0
    for start, end, _ in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
            at = end
        else:
            at = max(at, end)
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars",
                   mark: str = "[redacted]") -> DataFrame:
    """``docs`` with every secret of ``text_col`` replaced by ``mark``, and
    ``chars_col`` (if the table has it) counted anew where the text changed.

    Rows without a secret, null and empty texts come back as they are; every
    row stays, in the same columns.
    """

    @F.arrow_udf("string")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([redact(t.as_py(), mark) for t in batch], pa.string())

    cols = docs.columns
    name = free_name(docs, "_redacted_text")
    done = docs.withColumn(name, clean(F.col(text_col)))
    out = []
    for c in cols:
        if c == text_col:
            out.append(F.col(name).alias(c))
        elif c == chars_col:
            changed = ~F.col(name).eqNullSafe(F.col(text_col))
            out.append(F.when(changed, F.char_length(name).cast(docs.schema[c].dataType))
                       .otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return done.select(*out)
