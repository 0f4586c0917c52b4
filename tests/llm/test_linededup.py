import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from helixspark.llm.bloom import BLOCK, add, collected, filter_blocks, has
from helixspark.llm.linededup import without_common_lines

STRIP = " \t\n\x0b\x0c\r"
FOLD = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_chars=40, min_docs=5):
    key = lambda x: x.strip(STRIP).translate(FOLD)
    held = defaultdict(list)
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= min_chars:
                held[k].append(i)
    order = lambda i: (i is not None, i or 0)
    keeper = {k: max(v, key=order) for k, v in held.items() if len(v) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if keeper.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "clash", 7) for i, t in rows], "doc_id long, text string, a string, row int")
    got = [tuple(r) for r in without_common_lines(df, **kw).collect()]
    order = lambda r: (r[0] is not None, r[0] or 0, r[3])
    assert sorted(got, key=order) == sorted(brute(rows), key=order)
    return got


A, B, E = "A line of forty code points, or a few more ", "é" * 40, "x" * 39


def test_borders(spark):
    rows = [(1, A + "\n" + B + "\n" + E), (2, "\t" + A.upper() + "\x0b\r\nown\n" + B), (3, A.strip() + "\n" + A), (4, A + "\n\n" + E + "\n"), (5, E + "\n" + A),
            (6, None), (7, ""), (8, "\n\n"), (9, B + "\n" + E), (10, B), (11, B.upper()), (12, E + "\xa0" + "y")]
    got = {r[0]: r for r in run(spark, rows)}
    assert got[5][2] == 0 and got[3][2] == 2 and got[9][2] == 0 and got[6][1:3] == (1, 0)


def test_null_repeated_and_long(spark):
    big = "\n".join(f"line number {i:06d} of a very long text, long enough" for i in range(20000))
    run(spark, [(None, A), (None, A), (1, A), (2, A), (2, A), (2, A + "\nmore")])
    run(spark, [(None, A)] * 6)
    run(spark, [(i, big) for i in range(5)])
    assert run(spark, []) == []


def test_random_against_brute_force(spark):
    r = random.Random(3)
    pool = ["".join(r.choice("abC é") for _ in range(r.randint(35, 60))) for _ in range(60)]
    rows = [(i, "\n".join(r.choice(pool[:1 + i % 60]) + r.choice(["", " ", "\r"]) for _ in range(r.randint(0, 12)))) for i in range(400)]
    run(spark, rows)
    run(spark, rows, bits=BLOCK)


def test_filters_hold_all_repeats_in_any_partition(spark):
    r = np.random.default_rng(1)
    once, twice = r.integers(-2**63, 2**63, 30_000), r.integers(-2**63, 2**63, 5_000)
    df = spark.createDataFrame([(int(x),) for x in np.concatenate([once, twice, twice])], "h long")
    for parts in (1, 7):
        bits = 1 << 20
        blocks = filter_blocks(df.repartition(parts), bits).cache()
        second = collected(blocks, "twice", bits)
        assert has(second, twice).all() and has(second, once).mean() < 0.02
        assert has(collected(blocks, "once", bits), once).all()
    full = np.zeros(BLOCK // 8, np.uint8)
    add(full, twice)
    assert has(full, twice).all()


def test_saturated_filter_changes_nothing(spark):
    rows = [(i, "\n".join(f"{j % (i + 3):04d} the same words in each and every line here" for j in range(300))) for i in range(60)]
    run(spark, rows)


def test_empty_schema(spark):
    out = without_common_lines(spark.createDataFrame([], "doc_id long, text string"))
    assert out.columns == ["doc_id", "n_lines", "n_dropped", "kept"] and out.agg(F.count("*")).first()[0] == 0
