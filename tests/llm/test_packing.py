import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helixspark.llm.packing import ByteEncoder, cut_pieces, pack_mixture, schedule

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(1, 90), max_size=12), min_size=1, max_size=6), st.integers(2, 40), st.booleans(), st.integers(0, 9))
def test_stream_is_dense_and_mixed(queues, window, own, seed):
    tokens = [sum(q) for q in queues]
    r = random.Random(seed)
    targets = None if own else [r.choice([0.0, 1.0, 2.5]) for _ in queues]
    phases = schedule(tokens, targets, window)
    src = np.array([s for s, q in enumerate(queues) for _ in q], np.int64)
    n = np.array([k for q in queues for k in q], np.int64)
    begin = np.array([sum(q[:i]) for q in queues for i in range(len(q))], np.int64)
    cut = cut_pieces(phases, src, begin, n)
    assert sorted((at + i) for at, m in zip(cut["at"], cut["length"]) for i in range(m)) == list(range(sum(tokens)))
    ids = sorted((row, x) for row, a, m in zip(cut["row"], cut["start"], cut["length"]) for x in range(a, a + m))
    assert ids == [(r, x) for r, k in enumerate(n) for x in range(k)]
    assert all(at // window == (at + m - 1) // window for at, m in zip(cut["at"], cut["length"]))
    # each source's tokens stay in queue order along the stream
    for s in range(len(queues)):
        at = [(begin[r] + a, g) for r, a, g in zip(cut["row"], cut["start"], cut["at"]) if src[r] == s]
        assert [g for _, g in sorted(at)] == sorted(g for _, g in at)
    if own and sum(tokens):
        per = defaultdict(Counter)
        for row, m, g in zip(cut["row"], cut["length"], cut["at"]):
            per[g // window][src[row]] += m
        for w in range(sum(tokens) // window):
            for s, t in enumerate(tokens):
                assert abs(per[w][s] - window * t / sum(tokens)) <= 2 * len(tokens)


def test_encoder_equals_the_library():
    texts = ["", "The house's <|endoftext|> x", "größe  12²\n\n x", "語 a", "a\x1cb", " 's  ''s!!", "x" * 500]
    enc = ByteEncoder(PATH, keep=3)
    got = [np.frombuffer(b, enc.kind).tolist() for b in enc.encode(texts)]
    assert got == [LIB.encode(t, add_special_tokens=False).ids for t in texts]


def test_every_token_encodes_to_itself():
    # then merging by the rank of joined bytes equals the listed merges for every text
    model, vocab = LIB.model, LIB.get_vocab(with_added_tokens=False)
    assert all([x.id for x in model.tokenize(t)] == [i] for t, i in vocab.items())
    enc = ByteEncoder(PATH)
    r = random.Random(5)
    words = ["".join(r.choice("aeinsthorlcdmévß") for _ in range(r.randint(1, 14))) for _ in range(5000)]
    assert [enc.merge(w) for w in words] == [LIB.encode(w, add_special_tokens=False).ids for w in words]


def check(rows, pieces, window):
    want = sorted((i if i is not None else -1, tuple(LIB.encode(t or "", add_special_tokens=False).ids) + (0,)) for i, t, _ in rows)
    docs, seqs = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length and p.crc == zlib.crc32(p.ids)
        docs[p.doc_id if p.doc_id is not None else -1].append((p.start, p.doc_tokens, ids))
        seqs[p.sequence_id].append((p.offset, p.length))
    for k, v in seqs.items():
        at = 0
        for off, m in sorted(v):
            assert off == at
            at += m
        assert at == window or k == max(seqs)
    tokens = Counter(x for _, ids in want for x in ids)
    assert tokens == Counter(x for v in docs.values() for _, _, ids in v for x in ids)
    single = Counter(i for i, _ in want)
    for i, ids in want:
        if single[i] == 1:
            assert [x for _, n, part in sorted(docs[i]) for x in part] == list(ids) and {n for _, n, _ in docs[i]} == {len(ids)}


def test_pack_documents(spark):
    r = random.Random(2)
    rows = [(i, " ".join(r.choice(["the", "house", "größe", "x1", "."]) for _ in range(r.randint(0, 300))), r.choice(["a", "a", "b", None])) for i in range(300)]
    rows += [(1000, None, "a"), (1001, "", None), (None, "null id", "b"), (1002, "long " * 20000, "c"), (1003, "same", "a"), (1003, "same", "a")]
    df = spark.createDataFrame([(*x, 7) for x in rows], "doc_id long, text string, source string, part int").repartition(5)
    for targets in (None, {"a": 1.0, "b": 1.0}):
        check(rows, pack_mixture(df, PATH, targets, 256).withColumn("crc", F.crc32("ids")).collect(), 256)
    assert pack_mixture(df.limit(0), PATH).count() == 0


def test_targets_fill_the_windows(spark):
    rows = [(i, "word " * 99, "ab"[i % 2]) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    per = defaultdict(Counter)
    for p in pack_mixture(df, PATH, {"a": 3.0, "b": 1.0}, 100).collect():
        per[p.sequence_id][p.source] += p.length
    whole = [c for k, c in sorted(per.items())][:50]
    assert all(abs(c["a"] - 75) <= 2 for c in whole)
