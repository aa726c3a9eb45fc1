"""Fixtures and brute-force answers for the training-data operators."""

import hashlib
import re
import zlib

import xxhash

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs_of(spark, rows, extra=False):
    """rows: (doc_id, text, source); ``extra`` adds columns with the names that
    the operators give to their results."""
    data = [(i, t, "en" if i is None or i % 2 else "de", s, None if t is None else len(t)) for i, t, s in rows]
    df = spark.createDataFrame(data, DOC_SCHEMA)
    if extra:
        from pyspark.sql import functions as F

        for c in ("component_id", "fingerprint", "lang_pred", "score", "size", "taken", "shard", "spans",
                  "n_tokens", "bucket", "key", "h", "id", "n"):
            df = df.withColumn(c, F.lit("mine"))
    return df


def fingerprint(text, shingle=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return 0
    runs = [words[i:i + shingle] for i in range(len(words) - shingle + 1)] or [words]
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(items, linked):
    """Smallest index of each item's component, by all pairs."""
    root = list(range(len(items)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if linked(items[i], items[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(items))]


def simhash_components(rows):
    """{doc_id: (fingerprint, component id)} of (doc_id, text) rows."""
    prints = [fingerprint(t) for _, t in rows]
    comp = components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for (i, _), c in zip(rows, comp):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    return [(i, f"{p:016x}", least.get(c)) for (i, _), p, c in zip(rows, prints, comp)]


def base_spans(text):
    """The base secrets of a text by the patterns alone."""
    text = text or ""
    out = []
    assign = re.compile("((?:%s))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)" % "|".join(
        "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in
        ("password", "passwd", "secret", "token", "api_?key")))
    for m in assign.finditer(text):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(s, e, k) for s, _, k, e in sorted(out)]


def base_digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in spans).encode()).hexdigest()


def crc(data):
    return zlib.crc32(data)
