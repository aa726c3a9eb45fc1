import random
import string
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import crc, docs_of
from tokenizers import Tokenizer

from sieveflow.llm import tokens
from sieveflow.llm.tokenfile import read_token_files, token_table, write_token_files
from sieveflow.llm.tokens import PieceEncoder, _safe_cuts, count_tokens, slices, tokenizer_path

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
ODD = ["", " ", "  ", " a", "a ", "a  b", "a\n b", "a \nb", "  x  y", "foo<|endoftext|> bar <|endoftext|>x",
       "<|startoftext|>", "x  y", "a\tb c", "I'm  don't 's |pipe| a | b", "ＡＢ １２ ñÑ Σς ΑΣ İ ŉ ǅ", "ªº µ ß ẞ",
       "中文字符 测试 emoji 😀 👍🏽", "a\x1cb \x85c", "é a ́b", "12 345 6", "|", " | ", "\n\n\n", "a" * 5000,
       "é " * 300 + "  z", "EVET Mİ?", "İ. Mİ,mi İ!?", "क़, ज़. क़", "שׁ, שׁ.", "é́, é. e\u0301, e\u0301.", "ﬁ, ŉ. ΑΣ, Σ.", "word, word. (word). word?! A.B. 's, it's. ...", "Ġ Ġa Ċ"]


def fuzz(n=150):
    rng = random.Random(9)
    bits = ["Wörd", "word", " ", "  ", "\n", ".", ",", "'s", "'", "12", "|", "é", "<|endoftext|>", "中", " ", "!"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(1, 40))) for _ in range(n)]


def letters_before_stops(n=300):
    """Letters that change under NFC or lower case, before and between stops."""
    odd = [chr(c) for c in range(0x80, 0x30000) if chr(c).isalpha()
           and not (u := unicodedata.normalize("NFC", chr(c)).lower())[-1].isalpha() | (len(u) == 1)]
    rng = random.Random(4)
    bits = [*odd, "İ", "ẞ", "Σ", "ǅ", "\u0301", "\u093c", "a", "Z", "é", ".", ",", "?", ";", " ", "|", "'s"]
    return [*(c + "," for c in odd), *("x" + c + "?!" for c in odd),
            *("".join(rng.choice(bits) for _ in range(rng.randint(1, 25))) for _ in range(n))]


@pytest.mark.parametrize("name", FILES)
def test_letters_that_end_in_a_mark(name):
    lib, enc = Tokenizer.from_file(tokenizer_path(name)), PieceEncoder(tokenizer_path(name), True)
    texts = letters_before_stops()
    assert len(texts) > 350
    for t in texts:
        ids, _ = enc.encode(pa.array([t]))
        assert ids.tolist() == lib.encode(t, add_special_tokens=False).ids, ascii(t)


@pytest.mark.parametrize("name", FILES)
def test_ids_equal_the_library(name):
    lib, enc = Tokenizer.from_file(tokenizer_path(name)), PieceEncoder(tokenizer_path(name), True)
    assert enc.style in ("byte", "word")
    for texts in (ODD, fuzz(), [*ODD, *fuzz()]):
        want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
        ids, lens = enc.encode(pa.array(texts))
        assert lens.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]
        assert PieceEncoder(tokenizer_path(name), False).counts(pa.array(texts)).tolist() == lens.tolist()


def test_words_are_learned_once_whatever_marks_follow():
    """Case and marks make no new entries: one for each word and run of marks."""
    lib, enc = Tokenizer.from_file(tokenizer_path(FILES[1])), PieceEncoder(tokenizer_path(FILES[1]), True)
    words = ["word", "größe", "čaj"]
    marks = ["", *string.punctuation, "!!", "...", "'%$", "|<|"]
    texts = [f"{w}{m}" for x in words for w in (x, x.upper(), x.capitalize()) for m in marks]
    ids, _ = enc.encode(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in lib.encode(t, add_special_tokens=False).ids]
    assert set(enc.memo) == {t for t in [*words, "grösse", *marks] if t}


def test_every_letter_before_every_mark():
    lib, enc = Tokenizer.from_file(tokenizer_path(FILES[1])), PieceEncoder(tokenizer_path(FILES[1]), True)
    text = " ".join(f"{a}{chr(c)}{m}" for c in range(0x41, 0x250) for a in ("", "x") for m in "'|%")
    ids, _ = enc.encode(pa.array([text]))
    assert ids.tolist() == lib.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("token", ["word", "d!"])
def test_added_tokens_that_words_hold(tmp_path, token):
    import json

    spec = json.load(open(tokenizer_path(FILES[1]), encoding="utf-8"))
    spec["added_tokens"][0] |= {"content": token, "special": False}
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    enc, lib = PieceEncoder(str(path), True), Tokenizer.from_file(str(path))
    texts = ["a word! Word sword, wording", "word!", "WORD!!"]
    assert enc.encode(pa.array(texts))[0].tolist() == [
        i for t in texts for i in lib.encode(t, add_special_tokens=False).ids]


def test_a_full_memo_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_PIECES", 5)
    lib, enc = Tokenizer.from_file(tokenizer_path(FILES[0])), PieceEncoder(tokenizer_path(FILES[0]), True)
    for t in ODD + fuzz(20):
        assert enc.encode(pa.array([t]))[0].tolist() == lib.encode(t, add_special_tokens=False).ids


def test_an_unknown_kind_encodes_whole_texts(tmp_path):
    import json

    spec = json.load(open(tokenizer_path(FILES[0]), encoding="utf-8"))
    spec["pre_tokenizer"]["add_prefix_space"] = True
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    enc, lib = PieceEncoder(str(path), True), Tokenizer.from_file(str(path))
    assert enc.style is None
    assert enc.encode(pa.array(ODD))[0].tolist() == [i for t in ODD for i in lib.encode(t, add_special_tokens=False).ids]


def test_long_texts_are_cut_at_safe_boundaries():
    lib = Tokenizer.from_file(tokenizer_path(FILES[0]))
    text = " ".join(fuzz(3000)) + "  "
    cuts = _safe_cuts(text)
    assert len(cuts) > 2 and "".join(cuts) == text
    assert [i for c in cuts for i in lib.encode(c, add_special_tokens=False).ids] == \
        lib.encode(text, add_special_tokens=False).ids
    assert _safe_cuts("x" * 100_000) == ["x" * 100_000]


def test_slices_balance_bytes(monkeypatch):
    monkeypatch.setattr(tokens, "SLICE_BYTES", 100)
    got = list(slices(pa.array(["a" * 30] * 10 + ["b" * 500, None, "c"])))
    assert [x for s in got for x in s.to_pylist()] == ["a" * 30] * 10 + ["b" * 500, "", "c"]
    assert max(len(s) for s in got) <= 4


def test_counts_over_a_table(spark):
    texts = [None, *ODD]
    df = docs_of(spark, [*((i, t, "s") for i, t in enumerate(texts)), (None, "x", None), (3, texts[3], "s")], extra=True)
    lib = Tokenizer.from_file(tokenizer_path(FILES[0]))
    rows = count_tokens(df).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        t = "x" if r["doc_id"] is None else texts[r["doc_id"]] or ""
        assert r["n_bytes"] == len(t.encode()) and r["n_tokens"] == len(lib.encode(t, add_special_tokens=False).ids)
        assert r["over_limit"] == (r["n_tokens"] > 1024)
    assert count_tokens(df.limit(0)).count() == 0


def want_rows(docs):
    lib = Tokenizer.from_file(tokenizer_path(FILES[1]))
    out, at = [], 0
    for i, t in docs:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 1]
        out.append((i, at, len(ids), crc(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_token_files_give_the_ids_back(spark):
    docs = list(enumerate([None, *ODD, *fuzz(60)]))
    random.Random(2).shuffle(docs)
    df = docs_of(spark, [(i * 7 - 50, t, "s") for i, t in docs], extra=True).repartition(5)
    got = sorted(tuple(r) for r in token_table(df).collect())
    assert got == want_rows([(i * 7 - 50, t) for i, t in sorted(docs)])


def test_token_files_with_null_and_repeated_ids(spark):
    docs = [(None, "a"), (None, None), (3, "b c"), (3, "b c"), (3, "d"), (4, "")]
    got = token_table(docs_of(spark, [(i, t, "s") for i, t in docs])).collect()
    spans = sorted((r["start"], r["start"] + r["n_tokens"]) for r in got)
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == \
        sorted((str(i), n, c) for i, _, n, c in want_rows(docs))
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == [None, None, 3, 3, 3, 4]
    assert token_table(docs_of(spark, [(1, "x", "s")]).limit(0)).count() == 0


def test_files_are_ordered_and_prunable(spark, tmp_path):
    import pyarrow.orc as orc

    docs = docs_of(spark, [(i, f"text {i}", "s") for i in range(400)])
    path = str(tmp_path / "tokens")
    write_token_files(docs, path, parts=4)
    files = sorted((tmp_path / "tokens").glob("*.orc"))
    ids = [orc.ORCFile(str(f)).read(columns=["doc_id"])["doc_id"].to_pylist() for f in files]
    assert len(files) == 4 and [i for part in ids for i in part] == list(range(400))
    plan = read_token_files(spark, path).where("doc_id = 17")
    assert [r["doc_id"] for r in plan.collect()] == [17]
    text = plan._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,17)]" in text
