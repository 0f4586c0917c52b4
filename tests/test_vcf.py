"""VCF parsing, layouts and Ti/Tv on literal records (edge rules of the loaders)."""

import pytest
from pyspark.sql import functions as F

from helixspark.functions import vcf as V
from helixspark.operators import variants as VA
from helixspark.sources.vcf import header_tables, read_lines, read_vcf, vcf_header


def _maps(spark, rows, fn):
    df = spark.createDataFrame(rows, "a string, b string")
    return [r[0] for r in df.select(fn(F.col("a"), F.col("b"))).collect()]


def test_info_map_edge_cases(spark):
    df = spark.createDataFrame([(".",), ("DB",), ("DP=3;DB",), ("X=a=b",), ("DP=3;DP=4",)], "info string")
    got = [r[0] for r in df.select(V.info_map("info")).collect()]
    assert got == [{}, {"DB": "true"}, {"DP": "3", "DB": "true"}, {"X": "a=b"}, {"DP": "4"}]


def test_format_map_padding_and_dots(spark):
    got = _maps(spark, [("GT:AD:DP", "0/1:3"), (".", "0/1"), ("GT", "."), ("GT:DP", "1/1:7:9")], V.format_map)
    assert got[0] == {"GT": "0/1", "AD": "3", "DP": "."}
    assert got[1] == {} and got[2] == {}
    assert got[3] == {"GT": "1/1", "DP": "7"}
    df = spark.createDataFrame([({},)], "m map<string,string>")
    assert df.select(V.genotype("m")).first()[0] == "./."


def _write(tmp_dir, name, text):
    p = f"{tmp_dir}/{name}"
    with open(p, "w") as f:
        f.write(text)
    return p


VCF = """##fileformat=VCFv4.2
##INFO=<ID=DP,Number=1,Type=Integer,Description="Depth">
##INFO=<ID=END,Number=1,Type=Integer,Description="End">
##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">
##contig=<ID=chr1,length=1000>
##reference=file:///ref.fa
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2
chr1\t10\t.\tA\t.\t.\tPASS\tDP=3\tGT:DP\t0/0:3\t0/1:4
chr1\t20\trs1\tC\tT,G,A\tabc\t.\tEND=30\tGT\t1/2\t0/1
chr1\t30\t.\tG
"""


def test_read_vcf_missing_values_and_rejects(spark, tmp_dir):
    p = _write(tmp_dir, "a.vcf", VCF)
    rec, rej = read_vcf(spark, p)
    assert rej.count() == 1
    n = VA.normalise_missing(rec).orderBy("pos").collect()
    assert n[0]["vcf_id"] is None and n[0]["alt"] == "" and n[0]["qual"] is None
    assert n[1]["vcf_id"] == "rs1" and n[1]["qual"] is None and n[1]["filter"] is None
    l3 = VA.to_layout3(rec).orderBy("pos").collect()
    assert l3[0]["variant_name"] == "."  # layout 3 keeps the dot


def test_second_sample_values_come_from_second_column(spark, tmp_dir):
    rec, _ = read_vcf(spark, _write(tmp_dir, "b.vcf", VCF))
    rows = VA.to_layout3(rec, sample="S2").orderBy("pos").collect()
    assert [r["sample_name"] for r in rows] == ["S2", "S2"]
    assert [r["genotype"] for r in rows] == ["0/1", "0/1"]


def test_three_alts_join_three_rows_not_nine(spark, tmp_dir):
    rec, _ = read_vcf(spark, _write(tmp_dir, "c.vcf", VCF))
    t = VA.to_layout4(rec.filter("pos = 20"))
    j = t["variants"].join(t["variant_samples"].filter(F.col("sample_id") == F.md5(F.lit("S1"))), "variant_id")
    assert j.count() == 3


def test_reference_block_flag(spark, tmp_dir):
    rec, _ = read_vcf(spark, _write(tmp_dir, "d.vcf", VCF))
    links = VA.to_layout1(rec)["variant_samples"].join(VA.to_layout1(rec)["variants"], "variant_id")
    flags = {r["pos"]: r["is_reference_block"] for r in links.select("pos", "is_reference_block").collect()}
    assert flags == {10: False, 20: True}


def test_header_tables(spark, tmp_dir):
    lines = read_lines(spark, _write(tmp_dir, "e.vcf", VCF))
    samples, info, fmt = vcf_header(lines)
    assert [r["sample_name"] for r in samples.orderBy("position").collect()] == ["S1", "S2"]
    assert {r["id"]: r["type"] for r in info.collect()} == {"DP": "Integer", "END": "Integer"}
    t = header_tables(lines)
    assert t["contigs"].first()["length"] == 1000
    assert t["header_metadata"].first()["key"] == "reference"


def test_titv_cases(spark):
    rows = [
        ("s", "C", ["T"], [0, 1], ["PASS"]),  # transition, het -> 1
        ("s", "A", ["G"], [1, 1], ["PASS"]),  # transition, equal calls -> 2
        ("s", "C", ["A"], [0, 1], ["PASS"]),  # transversion -> 1
        ("s", "CA", ["C"], [0, 1], ["PASS"]),  # indel ignored
        ("t", "C", ["T"], [0, 0], ["PASS"]),  # no transversion -> null
        ("t", "A", ["C"], [0, 1], ["LowQual"]),  # not PASS
    ]
    store = spark.createDataFrame(rows, "sampleid string, referenceallele string, alternatealleles array<string>, "
                                        "calls array<int>, filters array<string>")
    got = {r[0]: r[1] for r in VA.titv(store).collect()}
    assert got == {"s": 3.0, "t": None}


def test_layouts_agree_on_genotype_lookup(spark, tmp_dir):
    rec, _ = read_vcf(spark, _write(tmp_dir, "f.vcf", VCF))
    t1 = VA.to_layout1(rec)
    g1 = {(r["pos"], r["sample_name"], r["genotype"]) for r in VA.genotypes(t1["variants"], t1["variant_samples"],
                                                                             t1["samples"]).collect()}
    l2 = VA.to_layout2(rec)
    g2 = {(r["pos"], r["sample_name"], r["genotype"]) for r in l2.select(
        "pos", F.explode("sample_ids").alias("sid", "sample_name"), "sample_genotypes").select(
        "pos", "sample_name", F.col("sample_genotypes")[F.col("sid")].alias("genotype")).collect()}
    g3 = {(r["pos"], r["sample_name"], r["genotype"]) for r in VA.to_layout3(rec).collect()}
    t4 = VA.to_layout4(rec)
    g4 = {(r["pos"], r["sample_name"], r["genotype"]) for r in VA.genotypes(
        t4["variants"], t4["variant_samples"].drop("chrom", "pos", "pos_bin"), t4["samples"]).collect()}
    assert g1 == g2 == g3 == g4


def test_upsert_keeps_newest(spark):
    old = spark.createDataFrame([("a", ".", "chr1", 1, "0/1", 1)], "sample_id string, variant_name string, "
                                "chrom string, pos long, genotype string, version int")
    new = spark.createDataFrame([("a", ".", "chr1", 1, "1/1", 2)], old.schema)
    assert VA.upsert(old, new).first()["genotype"] == "1/1"


def test_typed_fields_follow_each_file(spark, tmp_dir):
    """Type and Number come from the record's own file; counts are checked per ALT, allele and genotype."""
    def text(dp, body):
        return (f'##fileformat=VCFv4.2\n##INFO=<ID=DP,Number=1,Type={dp},Description="d">\n##INFO=<ID=AF,Number=A,Type=Float,Description="f">\n'
                '##INFO=<ID=DB,Number=0,Type=Flag,Description="m">\n##INFO=<ID=NS,Number=.,Type=String,Description="n">\n'
                '##FORMAT=<ID=GT,Number=1,Type=String,Description="g">\n##FORMAT=<ID=AD,Number=R,Type=Integer,Description="a">\n'
                '##FORMAT=<ID=PL,Number=G,Type=Integer,Description="p">\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\n' + body)

    _write(tmp_dir, "a.vcf", text("Integer", "1\t5\t.\tA\tC,G\t.\t.\tDP=3;AF=0.5,.;DB;NS=x,y;ZZ=1\tGT:AD:PL\t0/1:1,2,3:0,1,2,3,4,5\t1:7:1,2,3\n"
                                   "1\t6\t.\tA\t.\t.\t.\tDP=many;AF=0.1\tGT:AD\t0/0:9\t.\n"))
    _write(tmp_dir, "b.vcf", text("String", "1\t7\t.\tA\tC\t.\t.\tDP=3\tGT\t0/1\t0|1\n"))
    lines = read_lines(spark, tmp_dir)
    rec, _ = read_vcf(spark, None, lines=lines)
    _, info, fmt = vcf_header(lines)
    got = {(r.pos, r.scope, r.sample_name, r.key): (r.type, r.number, r.ints, r.floats, r.strings, r.well_formed)
           for r in VA.typed_fields(rec, info, fmt).collect()}
    assert got == {
        (5, "INFO", None, "DP"): ("Integer", "1", [3], None, None, True),
        (5, "INFO", None, "AF"): ("Float", "A", None, [0.5, None], None, True),
        (5, "INFO", None, "DB"): ("Flag", "0", None, None, None, True),
        (5, "INFO", None, "NS"): ("String", ".", None, None, ["x", "y"], None),
        (5, "INFO", None, "ZZ"): (None, None, None, None, ["1"], None),
        (5, "FORMAT", "s1", "GT"): ("String", "1", None, None, ["0/1"], True),
        (5, "FORMAT", "s1", "AD"): ("Integer", "R", [1, 2, 3], None, None, True),
        (5, "FORMAT", "s1", "PL"): ("Integer", "G", [0, 1, 2, 3, 4, 5], None, None, True),
        (5, "FORMAT", "s2", "GT"): ("String", "1", None, None, ["1"], True),
        (5, "FORMAT", "s2", "AD"): ("Integer", "R", [7], None, None, False),
        (5, "FORMAT", "s2", "PL"): ("Integer", "G", [1, 2, 3], None, None, True),  # haploid: one per allele
        (6, "INFO", None, "DP"): ("Integer", "1", [None], None, None, True),
        (6, "INFO", None, "AF"): ("Float", "A", None, [0.1], None, False),
        (6, "FORMAT", "s1", "GT"): ("String", "1", None, None, ["0/0"], True),
        (6, "FORMAT", "s1", "AD"): ("Integer", "R", [9], None, None, True),
        (7, "INFO", None, "DP"): ("String", "1", None, None, ["3"], True),  # b.vcf declares a string
        (7, "FORMAT", "s1", "GT"): ("String", "1", None, None, ["0/1"], True),
        (7, "FORMAT", "s2", "GT"): ("String", "1", None, None, ["0|1"], True),
    }


def test_upsert_reads_touched_folders_only(spark, tmp_dir):
    schema = "sample_id string, variant_name string, chrom string, pos long, genotype string, version int, sample_bucket int"
    rows = [(f"s{i % 9}", "v", f"chr{i % 5}", i, "0/0", 1, i % 9) for i in range(200)]
    VA.write_layout(spark.createDataFrame(rows, schema), tmp_dir, 3)
    new = [("s3", "v", "chr3", 3, "1/1", 2, 3), ("s4", "v", "chr4", 4, "1/1", 2, 4), ("s3", "w", "chr1", 3, "0/1", 2, 3)]
    before = set(spark.read.parquet(f"{tmp_dir}/layout3/genomic_variants").inputFiles())
    VA.upsert_layout3(spark, tmp_dir, spark.createDataFrame(new, schema))
    stored = spark.read.parquet(f"{tmp_dir}/layout3/genomic_variants")
    gone = {f.split("/genomic_variants/")[1].rsplit("/", 1)[0] for f in before - set(stored.inputFiles())}
    assert gone == {"sample_bucket=3/chrom=chr3", "sample_bucket=4/chrom=chr4", "sample_bucket=3/chrom=chr1"} & {f"sample_bucket={i % 9}/chrom=chr{i % 5}" for i in range(200)}
    want = {r[:4]: r[4] for r in rows} | {r[:4]: r[4] for r in new}
    assert {(r.sample_id, r.variant_name, r.chrom, r.pos): r.genotype for r in stored.collect()} == want
    named = spark.createDataFrame([("chr1", [3]), ("chr3", [3]), ("chr4", [4]), (None, [4])], "chrom string, b array<int>").collect()
    plan = stored.filter(VA.touched_folders(named))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "sample_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("layout", [1, 2, 3, 4])
def test_ordered_layouts_shuffle_raw_text(spark, layout):
    """Asked for their stored order, the layouts give the same rows, and maps are made behind the shuffle."""
    schema = ("file_id string, chrom string, pos long, vcf_id string, ref string, alt string, qual string, filter string, info string, "
              "format string, sample_names array<string>, sample_values array<string>")
    rec = spark.createDataFrame([
        ("f", "chr2", 5, ".", "A", "C,T", "3.5", "PASS", "DP=1;DB", "GT:DP", ["a", "b"], ["0/1:3"]),
        ("f", None, None, "x", "A", ".", ".", ".", ".", ".", ["a"], ["."]),
        ("g", "chr1", 9, ".", "A", "G", "bad", None, "END=9;X=1=2;X=3", "GT:GT", [], []),
        ("g", "chr1", 9, ".", "A", "G", "bad", None, None, None, ["a"], None)], schema)
    to = {1: VA.to_layout1, 2: VA.to_layout2, 3: VA.to_layout3, 4: VA.to_layout4}[layout]
    plain, ordered = to(rec), to(rec, ordered=True)
    if layout in (2, 3):
        plain, ordered = {"t": plain}, {"t": ordered}
    for name, df in ordered.items():
        assert df.schema == plain[name].schema
        assert sorted(map(str, df.collect())) == sorted(map(str, plain[name].collect()))
        if name != "samples":
            below = _plan(df).split("RepartitionByExpression", 1)[1]
            assert "str_to_map" not in below and "map_from_arrays" not in below


def test_maps_keep_their_rules(spark):
    f = spark.createDataFrame([(x,) for x in ("DP=1;DB;END=5", ".", None, "", "A=1=2;;B=", "=x", "A=1;B=2;A=3")], "i string")
    got = [r[0] for r in f.select(V.info_map("i")).collect()]
    assert got == [{"DP": "1", "DB": "true", "END": "5"}, {}, {}, {"": "true"}, {"A": "1=2", "": "true", "B": ""}, {"": "x"}, {"A": "3", "B": "2"}]
    m = spark.createDataFrame([("GT:DP", "0/1:3:4"), ("GT:DP", "0/1"), ("GT", "."), (None, "1"), ("GT:GT", "a:b"), ("GT:DP", "")], "f string, v string")
    got = [r[0] for r in m.select(V.format_map("f", "v")).collect()]
    assert got == [{"GT": "0/1", "DP": "3"}, {"GT": "0/1", "DP": "."}, {}, {}, {"GT": "b"}, {"GT": "", "DP": "."}]


def test_upsert_layout3_takes_one_exchange(spark, tmp_dir, monkeypatch):
    """The merged rows come from one range shuffle of old and new rows, in the order of their files."""
    schema = "sample_id string, variant_name string, chrom string, pos long, genotype string, info map<string,string>, sample_bucket int, version int"
    old = [("s", ".", "chr1", p % 7, "0/1", {"A": "1"}, 3, 1) for p in range(20)] + [("s", ".", "chr2", 1, "0/0", {}, 3, 1)]
    new = [("s", ".", "chr1", 3, "1/1", {"B": "2"}, 3, 2), ("s", None, "chr1", 3, "1/1", None, 3, 2)]
    VA.write_layout(spark.createDataFrame(old, schema), tmp_dir, 3)
    plans = []
    write = VA.write_layout
    monkeypatch.setattr(VA, "write_layout", lambda df, *a, **k: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, *a, **k)))
    VA.upsert_layout3(spark, tmp_dir, spark.createDataFrame(new, schema))
    assert plans[0].count("Exchange") == 1
    got = spark.read.parquet(f"{tmp_dir}/layout3/genomic_variants").collect()
    assert sorted((r["chrom"], r["pos"], r["variant_name"] or "", r["genotype"], r["version"]) for r in got) == sorted(
        [("chr1", p, ".", "0/1", 1) for p in range(7) if p != 3] + [("chr1", 3, ".", "1/1", 2), ("chr1", 3, "", "1/1", 2), ("chr2", 1, ".", "0/0", 1)])


def test_records_and_values_are_not_shuffled_for_headers(spark, tmp_dir):
    """Sample names and declared types stand in small written tables: records meet them by broadcast."""
    lines = ["##INFO=<ID=DP,Number=1,Type=Integer,Description=\"d\">", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1"]
    lines += [f"chr1\t{i}\t.\tA\tC\t.\tPASS\tDP={i}\tGT\t0/1" for i in range(3000)]
    (spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{tmp_dir}/v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "30000")
    try:
        rec, _ = read_vcf(spark, f"{tmp_dir}/v")
        _, info, fmt = vcf_header(read_lines(spark, f"{tmp_dir}/v"))
        t = VA.typed_fields(rec, info, fmt)
        for df in (rec, t):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert t.filter("key = 'DP'").agg({"ints": "count"}).first()[0] == 3000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
