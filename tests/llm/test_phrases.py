import random
import re
from collections import Counter
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from helixspark.llm import phrases as P
from helixspark.llm.bloom import add
from helixspark.llm.phrases import collocations, encoded, frequent_phrases, mine, phrase_hash

FOLD = {c: c + 32 for c in range(65, 91)}


def counts(rows):
    f, n = Counter(), Counter()
    for _, lang, t in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (t or "").translate(FOLD)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    return f, n


def brute(rows, least, top):
    f, n = counts(rows)
    cand = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    out = set()
    for lang in n:
        got = []
        for (g, p), a in cand.items():
            if g != lang:
                continue
            if any(h == g and len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q))) for (h, q), b in cand.items()):
                continue
            s, _, le, r = min((1000 * a * n[g] // (f[g, p[:k]] * f[g, p[k:]]), k, f[g, p[:k]], f[g, p[k:]]) for k in range(1, len(p)))
            got.append((-s, -a, " ".join(p).encode(), le, r))
        out |= {(lang, i, p.decode(), -a, le, r, n[lang], -s) for i, (s, a, p, le, r) in enumerate(sorted(got)[:top], 1)}
    return out


def run(spark, rows, least, top=2000, **kw):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, lang string, text string, phrase string, cnt int")
    got = [tuple(r) for r in collocations(df, least, top, **kw).collect()]
    assert set(got) == brute(rows, least, top) and len(got) == len(set(got))
    return got


def test_small_cases(spark):
    rows = [(1, "en", "New York, new york. NEW\tYORK city\x0bnew york"), (2, None, "a a a a a é\xa0b é\xa0b É"), (3, "en", None), (4, "en", ""),
            (None, "en", "new york"), (1, "en", "new york"), (5, "de", "new york"), (6, "en", "x " * 3000), (7, "", "a b a b")]
    for least in (1, 2, 3):
        run(spark, rows, least)
    run(spark, rows, 2, top=2)


def test_empty_table(spark):
    assert run(spark, [], 2) == []


def corpus(seed, n=300):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    passages = [" ".join(r.choices(words, k=r.randint(3, 8))) for _ in range(12)]
    text = lambda: ". ".join(r.choice([r.choice(passages), " ".join(r.choices(words, k=6))]) for _ in range(r.randint(0, 8)))
    return [(i, r.choice(["en", "fr", None]), text()) for i in range(n)]


def test_random_against_brute_force(spark):
    for share in (1, 4, 50):  # the whole table, a fair and a poor sample
        run(spark, corpus(share), 12, top=40, share=share)


def test_border_failures_are_expanded(spark):
    """Phrases that the sample lacks altogether are found, at each of their lengths."""
    rows = [(i, "en", "p q r s t" if i >= 100 else "a b") for i in range(140)]
    df = encoded(spark.createDataFrame(rows, "id long, lang string, text string"))
    f, n = counts(rows)
    want = {(g, " ".join(p), c) for (g, p), c in f.items() if c >= 20} | {(g, None, c) for g, c in n.items()}
    bits = 1 << 18
    part = np.zeros(bits // 8, np.uint8)
    add(part, np.array([phrase_hash("en", x) for x in ("p", "q", "r", "p q", "s", "a")]).view(np.uint64))
    for seed in (np.zeros(bits // 8, np.uint8), part, np.full(bits // 8, 255, np.uint8)):  # none, some, all are known
        got = [tuple(r) for r in mine(df, 20, bits, seed).collect()]
        assert set(got) == want and len(got) == len(want)


def test_frequent_counts_hot_phrase(spark):
    rows = [(i, "en", "the cat " * 50) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, lang string, text string").repartition(9)
    got = {r.phrase: r.cnt for r in frequent_phrases(df, 100).collect()}
    assert got["the cat"] == 10000 and got["cat the"] == 9800 and got["the cat the cat the"] == 9600 and got[None] == 20000


def test_hash_is_that_of_the_tasks():
    one = {w: np.array([P._word_hash("en", w)], np.uint64) for w in (b"a", b"b", b"c")}
    h = P._longer(P._longer(one[b"a"], one[b"b"]), one[b"c"])
    assert int(h.view(np.int64)[0]) == phrase_hash("en", "a b c")
    assert len({phrase_hash(g, p) for g in ("en", "fr") for p in ("a b", "b a", "a", "ab")}) == 8


def test_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(P, "CHUNK_WORDS", 20)
    run(spark, corpus(8), 12, top=40)


def test_rare_border_is_not_listed(spark):
    r = random.Random(9)
    rows = [(i, "en", " ".join(f"w{r.randint(0, 300)}" for _ in range(300)) + ". same two words") for i in range(200)]
    chunks = encoded(spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(4))
    known = np.zeros(1 << 15, np.uint8)
    add(known, np.array([phrase_hash("en", w) for w in [f"w{i}" for i in range(301)] + ["same", "two", "words"]]))
    counted = lambda often: {(x.lang, x.phrase): x.cnt for x in P.count_pass(chunks, known, often=often).collect()}
    every = counted(None)
    want = {p: c for p, c in every.items() if c >= 100}
    assert ("en", "same two") in want and ("en", None) in want
    for slots in (1 << 16, 1 << 22):  # however many phrases share a slot, none that is frequent is lost
        some = counted(P.often_slots(chunks, known, 100, slots))
        assert want.items() <= some.items()
    assert len(some) < len(every) / 20


def test_a_task_holds_one_chunk_and_no_filter_of_its_own(spark, monkeypatch):
    """Chunks are written in row groups of their own, filters reach the workers as mapped files and not
    as broadcasts, and the batch size of the session is as before."""
    monkeypatch.setattr(P, "CHUNK_WORDS", 20)
    tables, write, key = {}, P.written, "spark.sql.execution.arrow.maxBytesPerBatch"

    def kept(df, name, *a, **kw):
        tables[name] = write(df, name, *a, **kw)
        return tables[name]

    def no_broadcast(*a):
        raise AssertionError("a filter is read into each worker")

    monkeypatch.setattr(P, "written", kept)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", no_broadcast)
    before = spark.conf.get(key)
    run(spark, corpus(3), 12, top=40)
    assert spark.conf.get(key) == before
    for name in ("chunks", "sample"):
        files = [pq.ParquetFile(unquote(urlparse(f).path)).metadata for f in tables[name].inputFiles()]
        assert max(m.num_rows for m in files) > 1 and all(m.row_group(i).num_rows == 1 for m in files for i in range(m.num_row_groups))


def test_counts_leave_in_batches(monkeypatch):
    monkeypatch.setattr(P, "BATCH_ROWS", 3, raising=False)
    words = [b""] + [f"w{i}".encode() for i in range(10)]
    ids = np.array([*range(1, 11), 0, 1, 2, 0], np.int32)
    got = list(P._counts(pa.array([""] + ["en"] * 10), pa.array(words, pa.binary()), ids, np.full(1 << 10, 255, np.uint8), None, None))
    assert max(b.num_rows for b in got) <= 3
    rows = [tuple(r.values()) for b in got for r in b.to_pylist()]
    f, n = counts([(1, "en", " ".join(f"w{i}" for i in range(10)) + ". w0 w1")])
    assert sorted(r for r in rows if r[1]) == sorted((g, " ".join(p), c) for (g, p), c in f.items()) and ("en", None, n["en"]) in rows
