"""Encoding and decoding against the tokenizers library."""

import dataclasses
import hashlib
import json
import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from folioforge.llm import bpe
from folioforge.llm.catalog import tokenizer_path


@pytest.fixture(scope="module")
def merges():
    return bpe.Merges.read(tokenizer_path())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def texts():
    rng = random.Random(3)
    letters = "aAbÉéß İıΣσς <|endoftext|>'s're 12\u0085 \x1c\x1f\u200b　é漢字😀٣½\n\t!?%$Ω ŉ ǅ"
    out = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 80))) for _ in range(600)]
    out += ["".join(rng.choice("'smdtrevl 1.a") for _ in range(14)) for _ in range(800)]
    out += ["".join(chr(rng.randrange(32, 0x3000)) for _ in range(40)) for _ in range(200)]
    return out + ["", " ", "%" * 3000, "ab" * 2000, "<|endoftext|>" * 3, "ΑΣ ΑΣΑ", "<|startoftext|>x<|endoftext|", "'", "a'", "9've9", "it's we'll 'sx"]


@pytest.mark.parametrize("lexicon", [[], [b"hello", b"the", b"then", b"other", "é".encode()]])
def test_same_as_library(merges, library, lexicon):
    encoder = bpe.Encoder(merges, bpe.Transducer.mapped(bpe.Transducer.build(lexicon, merges.merge).to_bytes()))
    for text, (ids, n, decoded) in zip(texts(), encoder.encode(texts()), strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected and n == len(expected), repr(text)
        assert decoded.decode() == library.decode(expected, skip_special_tokens=False), repr(text)


def test_other_patterns_go_through_the_library(merges, library):
    assert merges.plain
    other = dataclasses.replace(merges, plain=False)
    encoder = bpe.Encoder(other, bpe.Transducer.build([], merges.merge))
    some = texts()[:50]
    assert [np.frombuffer(ids, "<u4").tolist() for ids, _, _ in encoder.encode(some)] == [library.encode(t, add_special_tokens=False).ids for t in some]


def test_transducer_shares_and_ranks(merges):
    words = [b"walk", b"walks", b"walked", b"talk", b"talks", b"talked", b"a"]
    t = bpe.Transducer.mapped(bpe.Transducer.build(words + words, merges.merge).to_bytes())
    ranks = t.ranks([*words, b"", b"wal", b"walkss", b"z"]).tolist()
    assert sorted(ranks[:7]) == list(range(7)) and ranks[7:] == [-1] * 4
    assert len(t.final) < sum(map(len, words))  # prefixes and suffixes are shared
    assert all(t.output(r).tolist() == merges.merge(w) for w, r in zip(words, ranks))
    assert bpe.Transducer.mapped(bpe.Transducer.build([], merges.merge).to_bytes()).ranks([b"x"]).tolist() == [-1]


def test_long_words_merge_alike(merges, library):
    word = "abcdefghij" * 7
    assert merges.merge(word.encode()) == library.encode(word, add_special_tokens=False).ids


def test_words_that_share_hashes_are_told_apart(merges, library):
    """Thue-Morse words collide under polynomial hashes modulo powers of two, whatever their odd base."""
    t = "a"
    while len(t) < 2048:
        t += t.translate(str.maketrans("ab", "ba"))
    other = t.translate(str.maketrans("ab", "ba"))
    for n in (512, 1024, 2048):
        words = [t[:n], other[:n], t[:n], other[:n], "x", t[: n - 1]]
        table = bpe.WordTable([" ".join(words)])
        assert [table.words[i] for i in table.which] == words
        encoder = bpe.Encoder(merges, bpe.Transducer.build([], merges.merge))
        (ids, _, _), = encoder.encode([" ".join(words)])
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(" ".join(words), add_special_tokens=False).ids


def test_words_that_share_all_hashes(monkeypatch):
    monkeypatch.setattr(bpe, "mix64", lambda x: x * np.uint64(0))
    words = ["cat", "dog", "cat", "a", "dog", "cow", "it's", "12", "é"]
    table = bpe.WordTable([" ".join(words), "", "dog"])
    got = [table.words[i] for i in table.which]
    assert got == ["cat", "dog", "cat", "a", "dog", "cow", "it", "'s", "1", "2", "é", "dog"]


def test_encoders_are_kept_by_vocabulary_too(merges, tmp_path):
    lexicon = bpe.Transducer.build([], merges.merge).to_bytes()
    with open(tokenizer_path(), encoding="utf-8") as f:
        t = json.load(f)
    t["model"]["merges"] = t["model"]["merges"][:100]
    (tmp_path / "other.json").write_text(json.dumps(t))
    other = bpe.Merges.read(str(tmp_path / "other.json"))
    got = [[np.frombuffer(ids, "<u4").tolist() for ids, _, _ in bpe._encoder(m, lexicon).encode(["information"])] for m in (merges, other, merges)]
    assert got[0] == got[2] != got[1] and len(got[1][0]) > len(got[0][0])


def test_groups_keep_order():
    column = pa.array([b"a" * 10, b"", b"b" * (bpe.TOGETHER + 5), b"c"])
    assert [t for g in bpe.grouped_texts(column) for t in g] == [x.decode() for x in column.to_pylist()]


def test_operator(spark, library):
    rows = [(1, "The cat, the CAT.", "x"), (2, None, None), (3, "", "x"), (None, "the cat", "x"), (1, "The cat, the CAT.", "x"), (4, "long " * 30000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.encode_decode(df, tokenizer_path()).collect()
    assert len(got) == len(rows)
    by_text = {(i, t or "") for i, t, _ in rows}
    for r in got:
        text = next(t for i, t in by_text if i == r.doc_id)
        ids = library.encode(text, add_special_tokens=False).ids
        assert (r.ids, r.n_tokens, r.decoded) == (ids, len(ids), library.decode(ids, skip_special_tokens=False))
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() and r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    assert bpe.encode_decode(df.limit(0), tokenizer_path()).collect() == []


def test_lexicon_is_bounded_by_counts(spark, merges):
    df = spark.createDataFrame([("a a a a b b c",), ("a b <|endoftext|> ",)], "text string")
    assert set(bpe.frequent_words(df, merges, most=2)) == {b"a", b"b"}
    assert bpe.frequent_words(df, merges, most=0) == []
    same = spark.createDataFrame([(" ".join("w" + c for c in "abcdefghijkl"),), ("top top",)], "text string")
    assert len(bpe.frequent_words(same, merges, most=5)) == 5 and b"top" in bpe.frequent_words(same, merges, most=5)
    assert len(bpe.frequent_words(same, merges, most=13)) == 13 == len(bpe.frequent_words(same, merges, most=100))
