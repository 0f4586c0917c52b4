"""Read-table jobs: mate pairing cases and coverage against brute force."""

from collections import Counter

from helixspark.operators import alignments as AL

SCHEMA = ("name string, read_id long, contig string, start0 long, end0 long, strand string, flag int, qual_sum long, "
          "umi string, next_contig string, next_start0 long")


def test_mate_pairing_cases(spark):
    rows = [
        # secondary read1 with a secondary mate and a primary mate at the same place
        ("t1", 1, "c", 100, 150, "+", 64 + 1 + 256, 5, "AAA", "c", 300),
        ("t1", 2, "c", 300, 350, "-", 128 + 1 + 256, 5, "CCC", "c", 100),
        ("t1", 3, "c", 300, 350, "-", 128 + 1, 5, "GGG", "c", 100),
        # no mate at the pointed position
        ("t2", 4, "c", 10, 60, "+", 64 + 1, 5, "TTT", "c", 999),
        # two candidates, only the second points back
        ("t3", 5, "c", 10, 60, "+", 64 + 1, 5, "ACG", "c", 500),
        ("t3", 6, "c", 500, 550, "-", 128 + 1, 5, "x", "c", 77),
        ("t3", 7, "c", 500, 550, "-", 128 + 1, 5, "y", "c", 10),
    ]
    pairs, stats, _ = AL.pair_mates(spark.createDataFrame(rows, SCHEMA))
    got = {(r["read1_id"], r["read2_id"]) for r in pairs.collect()}
    assert (1, 3) in got  # differing status is looked up first
    assert (5, 7) in got and (5, 6) not in got
    assert stats.first()["no_mate"] >= 1
    rows13 = [r for r in pairs.collect() if (r["read1_id"], r["read2_id"]) == (1, 3)]
    assert any(r["read2_secondary"] for r in rows13)  # a secondary read makes its mate secondary
    assert all(r["read2_umi"] == "ACG" for r in pairs.collect() if (r["read1_id"], r["read2_id"]) == (5, 7))


def test_coverage_matches_brute_force(spark):
    import random

    rnd = random.Random(3)
    rows = []
    for i in range(300):
        s = rnd.randint(0, 400)
        rows.append((f"r{i}", i, "c" + str(i % 2), s, s + rnd.randint(1, 60), "+", 0, 1, "A", None, None))
    df = spark.createDataFrame(rows, SCHEMA)
    got = AL.coverage(df).collect()
    for contig in ("c0", "c1"):
        depth = Counter()
        for r in rows:
            if r[2] == contig:
                for x in range(r[3], r[4]):
                    depth[x] += 1
        exp = {x: d for x, d in depth.items() if d > 0}
        cov = {}
        for r in got:
            if r["contig"] == contig:
                for x in range(r["start"], r["end"]):
                    cov[x] = r["depth"]
        assert cov == exp


def test_flag_stats_and_duplicates(spark):
    rows = [("a", 1, "c", 0, 10, "+", 67, 9, "A", None, None), ("b", 2, "c", 0, 10, "+", 67, 3, "A", None, None),
            ("c", 3, "c", 5, 15, "-", 4, 3, "A", None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    fs = AL.flag_stats(df).first()
    assert fs["total_passed"] == 3 and fs["mapped_passed"] == 2 and fs["read1_passed"] == 2
    d = {r["read_id"]: r["is_duplicate"] for r in AL.mark_duplicates(df).collect()}
    assert d == {1: False, 2: True, 3: False}


def test_duplicates_need_both_ends(spark):
    def pair(name, rid, s1, s2, q, strands="+-", flags=(67, 131), contig="c"):
        return [(name, rid, contig, s1, s1 + 50, strands[0], flags[0], q, "A", None, None),
                (name, rid + 1, contig, s2, s2 + 50, strands[1], flags[1], q, "A", None, None)]

    rows = [*pair("a", 1, 100, 400, 9), *pair("b", 3, 100, 1000, 3),      # one end shared only
            *pair("c", 5, 100, 400, 5), *pair("d", 7, 100, 400, 20),       # same two ends, d is best
            *pair("e", 9, 400, 100, 2, "-+"),                               # mates the other way round
            *pair("f", 11, 100, 400, 1, "++"),                              # another strand
            ("g", 13, "c", 100, 150, "+", 0, 50, "A", None, None), ("h", 14, "c", 100, 150, "+", 0, 40, "A", None, None),
            *pair("i", 15, 100, 400, 99, flags=(4, 131)),                   # one mapped end: compared with single ends
            ("d", 17, "c", 7, 57, "+", 67 + 256, 1, "A", None, None), ("x", 18, "c", 100, 150, "+", 4, 1, "A", None, None)]
    d = {r["read_id"]: r["is_duplicate"] for r in AL.mark_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {i for i, x in d.items() if x} == {1, 2, 5, 6, 9, 10, 14} and len(d) == len(rows)
    lib = spark.createDataFrame([(*r, r[0] in "ac") for r in rows], SCHEMA + ", lib boolean")
    d = {r["read_id"]: r["is_duplicate"] for r in AL.mark_duplicates(lib, "lib").collect()}
    assert {i for i, x in d.items() if x} == {5, 6, 9, 10, 14}
