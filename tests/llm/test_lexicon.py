import json
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from helixspark.llm.lexicon import Encoder, Lexicon, Merger, _pieces, build_lexicon, compile_lexicon, decode_ids, encode_texts, save
from helixspark.llm.pretoken import BYTE_LEVEL, PLAIN, WORDS, plain

PATH = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder(tmp_path_factory):
    m, p = Merger(PATH), str(tmp_path_factory.mktemp("lex") / "l.bin")
    save(compile_lexicon({w.encode(): m.merge(w).tolist() for w in ("the", "then", "thing", "nothing", "à", "s", "größe", "house", "houses")}), p)
    return Encoder(PATH, p, keep=50)


def test_plain_alphabet_splits_as_the_library_does():
    byte_level = Tokenizer.from_file(BYTES).pre_tokenizer
    chars = [chr(c) for c in range(0x250) if PLAIN.fullmatch(chr(c))]
    r = random.Random(1)
    for c in chars:
        for s in (c, f"a{c}b", f"1{c}2", f" {c} ", f"'{c}s", f"!{c}?", "".join(r.choices(chars, k=30))):
            assert BYTE_LEVEL.findall(s) == [s[a:b] for _, (a, b) in byte_level.pre_tokenize_str(s)], s
            low = LIB.normalizer.normalize_str(s)
            assert low == " ".join(low.split(" ")) and [low[a:b] for _, (a, b) in LIB.pre_tokenizer.pre_tokenize_str(low)] == WORDS.findall(s.lower()), s


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.binary(min_size=1, max_size=6).map(lambda b: bytes(x % 4 + 97 for x in b)), st.lists(st.integers(0, 5), min_size=1, max_size=4), max_size=40))
def test_transducer_maps_each_word_and_no_other(tmp_path_factory, entries):
    p = str(tmp_path_factory.mktemp("l") / "x")
    save(compile_lexicon(entries), p)
    lex = Lexicon(p)
    asked = [*entries, b"zz", b"a", b"ab", b"abc", *(w + b"a" for w in entries), *(w[:-1] for w in entries if len(w) > 1)]
    assert lex.look_up(asked) == [entries.get(w) for w in asked]


def test_suffixes_are_shared():
    words = {f"{a}{b}tion".encode(): [ord(a), ord(b)] for a in "abcdefgh" for b in "xyzw"}
    assert len(compile_lexicon(words)["final"]) < 20


TEXTS = st.one_of(st.text(max_size=60), st.lists(st.sampled_from(["The ", "THEN's ", "größe", "12 3", "<|endoftext|>", "\n\t", "é", "İ", "Σς ", "²", "\x1c", "!!?", "_", "houses ", "x" * 150]), max_size=12).map("".join))


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXTS, max_size=4))
def test_ids_equal_the_library(encoder, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
    want = [LIB.encode(t, add_special_tokens=False).ids for t in texts]
    assert got == want
    for ids in want:
        assert " ".join(_pieces(PATH)[i] for i in ids) == LIB.decode(ids, skip_special_tokens=False)


def test_long_words_merge_alike():
    m, r = Merger(PATH), random.Random(3)
    for n in (101, 300, 2000):
        w = "".join(r.choice("aeinsthor") for _ in range(n))
        assert plain(w) and m.merge(w).tolist() == LIB.encode(w, add_special_tokens=False).ids


def test_every_token_encodes_to_itself():
    # then merging by joined bytes equals the listed merges for every word
    vocab, m = LIB.get_vocab(with_added_tokens=False), Merger(PATH)
    ends = {t: i for t, i in vocab.items() if t.endswith("</w>") and t != "</w>"}
    assert all([x.id for x in LIB.model.tokenize(t.removesuffix("</w>"))] == [i] for t, i in ends.items())
    pairs = {p: r for r, p in enumerate(map(tuple, json.loads(LIB.to_str())["model"]["merges"]))}
    for t in vocab.keys() - ends.keys():
        s = list(t)
        while len(s) > 1:
            _, i = min((pairs.get(p, 1 << 30), i) for i, p in enumerate(zip(s, s[1:])))
            assert (s[i], s[i + 1]) in pairs, t
            s[i:i + 2] = [s[i] + s[i + 1]]
    assert len(vocab) == len(m.ids)


def test_rows(spark):
    rows = [(1, None, 1), (2, "", 1), (None, "The house " * 3000, 1), (2, "a²b <|startoftext|> ÀÉ", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids long")
    out = decode_ids(encode_texts(df, PATH, build_lexicon(df, PATH, 100)), PATH).collect()
    want = [LIB.encode(t or "", add_special_tokens=False).ids for _, t, _ in rows]
    assert sorted((r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in out) == sorted(
        (i or 0, ids, LIB.decode(ids, skip_special_tokens=False)) for (i, _, _), ids in zip(rows, want))
    empty = df.limit(0)
    assert encode_texts(empty, PATH, build_lexicon(empty, PATH, 100)).count() == 0
