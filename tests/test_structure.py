"""Protein-side jobs: golden FASTA metrics, entity labels, greedy batching."""

import random

import numpy as np
from pyspark.sql import functions as F

from helixspark.operators import structure as ST


def test_validate_fasta_golden_numbers(spark):
    # one 200-residue chain, and two chains of 116 + 117 residues (lengths of the reference's test files)
    rows = [("3d06", 0, "3D06_1|Chain A|X", "M" * 200),
            ("4zqk", 0, "4ZQK_1|Chains A|X", "A" * 116), ("4zqk", 1, "4ZQK_2|Chain B|Y", "C" * 117)]
    seqs = spark.createDataFrame(rows, "file string, ord long, id string, seq string")
    ok, bad = ST.validate_fasta(seqs, max_seq=2, max_len=2000)
    got = {r["file"]: (r["id"], r["seq_length"], r["seq_count"]) for r in ok.collect()}
    assert got == {"3d06": ("3D06", 200, 1), "4zqk": ("4ZQK", 233, 2)}
    assert bad.count() == 0


def test_entity_labels(spark):
    df = spark.createDataFrame([(1,), (26,), (27,), (28,), (703,)], "n long")
    assert [r[0] for r in df.select(ST.entity_label("n")).collect()] == ["A", "Z", "AA", "BA", "AAA"]


def _greedy(sizes, budget, extra=0):
    order = sorted((s, i) for i, s in sizes)
    batches, buf, mx = [], [], 0
    for sz, i in order:
        sz += extra
        if max(sz, mx) * (len(buf) + 1) > budget and buf:
            batches.append(buf)
            buf, mx = [], 0
        mx = max(mx, sz)
        buf.append(i)
    if buf:
        batches.append(buf)
    return {i: b for b, ids in enumerate(batches) for i in ids}


def test_token_batches_equal_sequential_rule(spark):
    rnd = random.Random(4)
    sizes = [(i, rnd.choice([5, 7, 7, 12, 30, 31, 64, 200])) for i in range(500)]
    df = spark.createDataFrame(sizes, "idx long, length long")
    for budget, extra in ((100, 0), (64, 2), (1000, 1)):
        got = {r["idx"]: r["batch"] for r in ST.pack_tokens(df, budget, extra).collect()}
        assert got == _greedy(sizes, budget, extra)


def test_plddt_matches_numpy(spark):
    rnd = np.random.default_rng(5)
    logits = rnd.normal(size=(4, 50)).tolist()
    df = spark.createDataFrame([(i, l) for i, l in enumerate(logits)], "i long, logits array<double>")
    got = [r["plddt"] for r in ST.with_plddt(df).orderBy("i").collect()]
    for g, l in zip(got, logits):
        p = np.exp(l - np.max(l))
        p /= p.sum()
        centers = (np.arange(50) + 0.5) / 50
        assert abs(g - float((p * centers).sum() * 100)) < 1e-9


def test_resource_tiers(spark):
    df = spark.createDataFrame([(700,), (1500,), (2500,)], "L long")
    af = [r[0] for r in df.select(ST.resource_tier("L")["bfd_memory_gib"]).collect()]
    esm = [r[0] for r in df.select(ST.resource_tier("L", "esmfold")["memory_gib"]).collect()]
    assert af == [32, 128, 192]
    assert esm == [16, round((9 + 0.009 * 1500 + 6e-6 * 1500 ** 2) * 1.1), round((9 + 0.009 * 2500 + 6e-6 * 2500 ** 2) * 1.1)]
    assert F is not None
