"""Operator 7: token counts by batch encoding in Arrow functions.

The tokenizer library encodes *pieces*: a text is cut at safe boundaries,
places where its tokenizer always starts a new pre-token, so the pieces' ids
put together are the text's ids. Within a batch each distinct piece is encoded
once, many pieces in one call, and what a piece gave is remembered by the
worker process (bounded; cleared when full). Only lengths leave the function.

Safe boundaries, known for two kinds of tokenizer files:

* ``byte``: byte-level BPE with the library's own pattern and no normalizer.
  Every pattern alternative takes white space at its start only or is white
  space alone, so a space between two other characters starts a pre-token. A
  text with a space beside other white space is cut only at its safe spaces;
  token strings that start with the space's byte show where a piece starts.
* ``word``: BPE over words, white space dropped. Every space is safe. Words of
  letters end with the only token that ends a word; other pieces are encoded
  with a separator word of one known id between them.

In both kinds the stops after a word's last letter are a pre-token of their
own, so a piece such as ``word,`` is put together from ``word`` and ``,``. For
``word`` this holds for any ASCII marks: pieces of Latin letters and marks are cut
and lower-cased by Arrow, and only their words and marks are remembered.

Any other tokenizer file encodes whole texts. Special strings inside a text
hold no space, so no boundary cuts one; pieces with the separator in them are
encoded alone.

Scale: a map without a shuffle. Arrow batches are cut anew into slices of
about ``SLICE_BYTES`` so that a run of long texts does not swell a worker.
"""

from __future__ import annotations

import json
import os
import string
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: bytes of text handled at a time in a worker
SLICE_BYTES = 8 << 20
#: characters encoded in one call of the library
CALL_CHARS = 1 << 15
#: pieces a worker remembers before it starts anew; with their ids also about
#: how many bytes: a piece takes PIECE_BYTES beside its characters and ids
MEMO_PIECES = 1_000_000
MEMO_BYTES = 200 << 20
PIECE_BYTES = 260

_SEPARATOR = "|"
_STOPS = ".,!?;:"
#: letters up to U+012F whose lower case is one letter, in NFC
_LETTERS = string.ascii_letters + "".join(c for c in map(chr, range(0xC0, 0x130)) if c.isalpha())
_MARKS = string.punctuation
_WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: a space beside other white space, by the widest meaning of white space
_UNSAFE = r" [\s\x0b\x1c-\x1f\x{85}\p{Z}]|[\s\x0b\x1c-\x1f\x{85}\p{Z}] "


def tokenizer_path(name: str) -> str:
    """Where this machine keeps a public tokenizer; a path stays a path."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _style(spec: dict) -> str | None:
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    clean = not spec.get("truncation") and not spec.get("padding") and not any(
        t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or " " in t["content"]
        for t in spec.get("added_tokens", []))
    if not clean or spec["model"].get("dropout"):
        return None
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not norm:
        return "byte"
    steps = pre.get("pretokenizers", [])
    if (norm and [n["type"] for n in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
            and norm["normalizers"][1]["pattern"] == {"Regex": "\\s+"}
            and [p["type"] for p in steps] == ["Split", "ByteLevel"]
            and steps[0]["pattern"] == {"Regex": _WORD_PATTERN} and steps[0]["invert"]
            and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"]
            # an added token of this form would be cut or lower-cased
            and not any(t["content"].rstrip(_MARKS) and not t["content"].rstrip(_MARKS).strip(_LETTERS)
                        for t in spec.get("added_tokens", []))):
        return "word"
    return None


def _plain(word: str) -> bool:
    """Letters whose lower case is one letter, in NFC: one pre-token of ``word``."""
    return word.isalpha() and (word.isascii() or max(word) < "\u0130")


class PieceEncoder:
    """Ids (or only their number) of whole texts, through remembered pieces."""

    def __init__(self, path: str, keep_ids: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.style = _style(spec)
        self.keep_ids = keep_ids
        vocab = self.tok.get_vocab(with_added_tokens=True)
        if self.style == "byte":
            starts = np.zeros(max(vocab.values()) + 1, bool)
            starts[[i for t, i in vocab.items() if t.startswith("Ġ")]] = True
            self.starts = starts
        elif self.style == "word":
            one = self.tok.encode(f"a {_SEPARATOR} a", add_special_tokens=False).ids
            end = spec["model"].get("end_of_word_suffix")
            if len(one) != 3 or not end:
                self.style = None
            self.sep = one[1] if len(one) == 3 else None
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for t, i in vocab.items() if end and t.endswith(end)]] = True
        self._clear()

    def _clear(self) -> None:
        self.memo: dict[str, int] = {}
        self.lens = np.zeros(1 << 16, np.int32)
        self.offs = np.zeros(1 << 16, np.int64)
        self.flat = np.zeros(1 << 18 if self.keep_ids else 0, np.int32)
        self.used = 0
        self.held = 0

    def _add(self, pieces: list[str], lens: np.ndarray, ids: np.ndarray) -> None:
        k, n = len(self.memo), len(pieces)
        while k + n > len(self.lens):
            self.lens = np.concatenate((self.lens, np.zeros_like(self.lens)))
            self.offs = np.concatenate((self.offs, np.zeros_like(self.offs)))
        self.lens[k:k + n] = lens
        if self.keep_ids:
            while self.used + len(ids) > len(self.flat):
                self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
            self.offs[k:k + n] = self.used + np.cumsum(lens) - lens
            self.flat[self.used:self.used + len(ids)] = ids
            self.used += len(ids)
        self.memo.update(zip(pieces, range(k, k + n)))
        if self.keep_ids:
            self.held += n * PIECE_BYTES + sum(map(len, pieces)) + 4 * len(ids)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)

    def _alone(self, pieces: list[str]) -> None:
        got = [self._ids(p) for p in pieces]
        self._add(pieces, np.array([len(x) for x in got], np.int32),
                  np.concatenate(got) if got else np.zeros(0, np.int32))

    def _together(self, pieces: list[str], plain: bool = False) -> None:
        """Encodes new pieces: many in one call. ``plain``: words of letters,
        each of which ends with the only token of it that ends a word."""
        at = 0
        while at < len(pieces):
            stop, chars = at, 0
            while stop < len(pieces) and (stop == at or chars + len(pieces[stop]) < CALL_CHARS):
                chars += len(pieces[stop]) + 3
                stop += 1
            part = pieces[at:stop]
            at = stop
            if self.style == "byte":
                ids = self._ids("".join(part))
                cut = np.flatnonzero(self.starts[ids])
                lens = np.diff(np.append(cut, len(ids)))
                whole = len(cut) == len(part) and (not len(cut) or cut[0] == 0)
            elif plain:
                ids = self._ids(" ".join(part))
                cut = np.flatnonzero(self.ends[ids])
                lens = np.diff(np.concatenate(([-1], cut)))
                whole = len(cut) == len(part) and cut[-1] == len(ids) - 1
            else:
                ids = self._ids(f" {_SEPARATOR} ".join(part))
                cut = np.flatnonzero(ids == self.sep)
                lens = np.diff(np.concatenate(([-1], cut, [len(ids)]))) - 1
                ids = np.delete(ids, cut)
                whole = len(cut) == len(part) - 1
            if whole:
                self._add(part, lens.astype(np.int32), ids)
            else:
                self._alone(part)

    def _ends_in_letter(self, base: str) -> bool:
        """Whether stops after ``base`` are a pre-token of their own. A letter
        that the normalizer turns into one with a mark behind it (dotted I,
        letters that NFC takes apart) ends in the mark, which joins the stops."""
        if self.style == "word" and not base[-1:].isascii():
            base = unicodedata.normalize("NFC", base).lower()
        return base[-1:].isalpha()

    def _base(self, piece: str) -> str:
        """What of a piece is looked up first: without a tail of stops after a
        letter and, where the tokenizer lower-cases, in lower case if that is plain."""
        if self.style == "word" and piece.isascii() and piece.isalpha():
            return piece.lower()
        base = piece.rstrip(_STOPS)
        if len(base) != len(piece) and not self._ends_in_letter(base):
            base = piece
        if self.style == "word" and _plain(base):
            return base.lower()
        return base

    def _learn(self, pieces: list[str]) -> np.ndarray:
        """Numbers of the pieces in the memo."""
        memo = self.memo
        found = np.fromiter(map(memo.get, pieces, repeat(-1)), np.int64, len(pieces))
        gaps = np.flatnonzero(found < 0).tolist()
        if gaps:
            new = [pieces[i] for i in gaps]
            bases = [self._base(p) for p in new]
            ask = [b for b in dict.fromkeys(bases) if b not in memo]
            if self.style == "word":
                plain = [_plain(b) for b in ask]
                other = [b for b, p in zip(ask, plain) if not p]
                self._together([b for b, p in zip(ask, plain) if p], plain=True)
                self._together([b for b in other if _SEPARATOR not in b])
                self._alone([b for b in other if _SEPARATOR in b])
            else:
                self._together([b for b in ask if len(b) > 1])
                self._alone([b for b in ask if len(b) <= 1])
            tails = [p[len(b):] for p, b in zip(new, bases)]
            self._learn_whole([t for t in dict.fromkeys(tails) if t])
            self._compose([(p, memo[b], memo[t] if t else -1)
                           for p, b, t in zip(new, bases, tails) if p not in memo])
            found[gaps] = [memo[p] for p in new]
        return found

    def _learn_plain(self, words: list[str]) -> np.ndarray:
        """Numbers of different words of lower-case ``_LETTERS``."""
        memo = self.memo
        found = np.fromiter(map(memo.get, words, repeat(-1)), np.int64, len(words))
        gaps = np.flatnonzero(found < 0)
        if len(gaps):
            new = [words[i] for i in gaps.tolist()]
            found[gaps] = np.arange(len(memo), len(memo) + len(new))
            self._together(new, plain=True)
        return found

    def _compose(self, made: list[tuple[str, int, int]]) -> None:
        """Remembers pieces that are a known base and, unless -1, a known tail."""
        if not made:
            return
        parts = np.array([m[1:] for m in made], np.int64)
        lens = np.where(parts >= 0, self.lens[parts], 0)
        ids = np.zeros(0, np.int32)
        if self.keep_ids:
            flat = parts.ravel()
            ids = _gather(flat[flat >= 0], self.lens, self.offs, self.flat)
        self._add([m[0] for m in made], lens.sum(axis=1), ids)

    def _words(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of ids, offset, ids) of different ``word`` pieces. A piece of
        letters and marks behind them is two entries of the memo, any other one."""
        base, tail = pc.ascii_rtrim(pieces, _MARKS), pc.utf8_ltrim(pieces, _LETTERS)
        n, n_base, n_tail = (pc.binary_length(x).to_numpy() for x in (pieces, base, tail))
        cut = (n_base + n_tail == n) & (n_base > 0)
        parts = np.full((len(pieces), 2), -1)
        words = pc.utf8_lower(base.filter(pa.array(cut))).dictionary_encode()
        known = self._learn_plain(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        parts[cut, 0] = known[words.indices.to_numpy()]
        marked = cut & (n_tail > 0)
        marks = tail.filter(pa.array(marked)).dictionary_encode()
        known = self._learn_whole(marks.dictionary.to_pylist())
        parts[marked, 1] = known[marks.indices.to_numpy()]
        parts[~cut, 0] = self._learn(pieces.filter(pa.array(~cut)).to_pylist())
        lens = np.where(parts >= 0, self.lens[parts], 0).sum(axis=1, dtype=np.int64)
        flat = parts.ravel()
        ids = _gather(flat[flat >= 0], self.lens, self.offs, self.flat) if self.keep_ids else self.flat
        return lens, np.cumsum(lens) - lens, ids

    def pieces_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(numbers of all pieces in order, pieces of each text, what the numbers
        stand for: number of ids, offset and ids, the memo's or a table of these texts)."""
        if len(self.memo) > MEMO_PIECES or self.held > MEMO_BYTES:
            self._clear()
        if self.style == "word":
            parts = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
            counts = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
            words = parts.flatten().dictionary_encode()
            return words.indices.to_numpy(), counts, self._words(words.dictionary)
        pieces, counts = self._memo_pieces(texts)
        return pieces, counts, (self.lens, self.offs, self.flat)

    def _memo_pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(memo numbers of all pieces in order, pieces of each text)."""
        n = len(texts)
        if self.style is None:
            pieces = texts.to_pylist()
            return self._learn_whole(pieces), np.ones(n, np.int64)
        unsafe = pc.match_substring_regex(texts, _UNSAFE).to_numpy(zero_copy_only=False)
        parts = pc.split_pattern(texts, " ")
        counts = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        words = parts.flatten().dictionary_encode()
        flat = words.indices.to_numpy()
        first = np.cumsum(counts) - counts
        row = np.repeat(np.arange(n), counts)
        is_first = np.zeros(len(flat), bool)
        is_first[first] = True
        # pieces after the first one of a safe text start with the space
        inner = ~is_first & ~unsafe[row]
        used = np.unique(flat[inner])
        numbers = np.zeros(len(words.dictionary), np.int64)
        numbers[used] = self._learn(
            pc.binary_join_element_wise("", words.dictionary.take(pa.array(used)), " ")
            .to_numpy(zero_copy_only=False).tolist())
        out = numbers[flat]
        head = is_first & ~unsafe[row]
        if head.any():
            out[head] = self._learn_whole(words.dictionary.take(pa.array(flat[head])).to_pylist())
        if unsafe.any():
            which = np.flatnonzero(unsafe)
            cut = [_safe_cuts(texts[int(i)].as_py()) for i in which]
            got = self._learn_whole([p for c in cut for p in c])
            keep = ~unsafe[row]
            sizes = np.where(unsafe, 0, counts)
            sizes[which] = [len(c) for c in cut]
            merged = np.empty(int(sizes.sum()), np.int64)
            mine = np.repeat(unsafe, sizes)
            merged[mine], merged[~mine] = got, out[keep]
            return merged, sizes
        return out, counts

    def _learn_whole(self, pieces: list[str]) -> np.ndarray:
        """Numbers of pieces that are encoded by themselves, in batches."""
        new = list(dict.fromkeys(p for p in pieces if p not in self.memo))
        at = 0
        while at < len(new):
            stop, chars = at, 0
            while stop < len(new) and (stop == at or chars + len(new[stop]) < 8 * CALL_CHARS):
                chars += len(new[stop])
                stop += 1
            got = self.tok.encode_batch_fast(new[at:stop], add_special_tokens=False)
            ids = [np.array(e.ids, np.int32) for e in got]
            self._add(new[at:stop], np.array([len(x) for x in ids], np.int32),
                      np.concatenate(ids) if self.keep_ids else np.zeros(0, np.int32))
            at = stop
        memo = self.memo
        return np.fromiter((memo[p] for p in pieces), np.int64, len(pieces))

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Number of tokens of each text."""
        pieces, sizes, (lens, _, _) = self.pieces_of(texts)
        total = np.concatenate(([0], np.cumsum(lens[pieces], dtype=np.int64)))
        ends = np.cumsum(sizes)
        return total[ends] - total[ends - sizes]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, number of ids of each text)."""
        pieces, sizes, table = self.pieces_of(texts)
        total = np.concatenate(([0], np.cumsum(table[0][pieces], dtype=np.int64)))
        upto = np.cumsum(sizes)
        return _gather(pieces, *table), total[upto] - total[upto - sizes]


def _gather(pieces: np.ndarray, lens: np.ndarray, offs: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """The ids of ``pieces``, one after another."""
    lens = lens[pieces].astype(np.int64)
    ends = np.cumsum(lens)
    return flat[np.arange(int(lens.sum())) + np.repeat(offs[pieces] - (ends - lens), lens)]


def _safe_cuts(text: str) -> list[str]:
    """Pieces of a ``byte`` text of which some spaces are not safe, each of
    about CALL_CHARS characters: cut at safe spaces only."""
    out, at = [], 0
    while len(text) - at > CALL_CHARS:
        p = text.find(" ", at + CALL_CHARS)
        while p >= 0 and (p + 1 >= len(text) or text[p - 1].isspace() or text[p + 1].isspace()):
            p = text.find(" ", p + 1)
        if p < 0:
            break
        out.append(text[at:p])
        at = p
    return [*out, text[at:]]


def slices(texts: pa.Array, size: int | None = None) -> Iterator[pa.Array]:
    """``texts`` with nulls as empty texts, in slices of about ``size`` (default:
    SLICE_BYTES) bytes."""
    texts = pc.fill_null(texts, "")
    if not len(texts):
        return
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + (size or SLICE_BYTES), "right")))
        yield texts.slice(at, stop - at)
        at = stop


@lru_cache(maxsize=2)
def encoder(name: str, keep_ids: bool) -> PieceEncoder:
    """One encoder for each worker process."""
    return PieceEncoder(tokenizer_path(name), keep_ids)


def token_count(text: str | Column, tokenizer: str) -> Column:
    """Number of tokens of ``text`` (null: 0), no special tokens added."""

    @F.arrow_udf("long")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = encoder(tokenizer, False)
        for batch in batches:
            got = [enc.counts(s) for s in slices(batch)]
            yield pa.array(np.concatenate(got) if got else np.zeros(0, np.int64), pa.int64())

    return counted(F.col(text) if isinstance(text, str) else text)


def count_tokens(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", id_col: str = "doc_id",
                 text_col: str = "text", limit: int = 1024) -> DataFrame:
    """(``id_col``, n_bytes, n_tokens, over_limit), one row per row of ``docs``.

    ``tokenizer`` is a file name known to the installed public tokenizers or a
    path that every executor has. A null text counts as empty: 0 bytes, 0
    tokens. Whole texts are counted, however long; special strings inside them
    are handled as the library does by default. Null ids, repeated rows and
    further columns of any name are fine. No rows: an empty result.
    """
    counted = docs.select(F.col(id_col).alias("_id"),
                          F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("_bytes"),
                          token_count(text_col, tokenizer).alias("_tokens"))
    return counted.select(F.col("_id").alias(id_col), F.col("_bytes").alias("n_bytes"),
                          F.col("_tokens").alias("n_tokens"),
                          (F.col("_tokens") > limit).alias("over_limit"))
