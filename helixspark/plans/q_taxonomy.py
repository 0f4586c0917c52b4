"""Registered taxonomy / dataflow queries (f8 taxa and profiles, f11 sheet, f4 reads, lineitem logs)."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixspark.operators import taxonomy as TX
from helixspark.plans.fixtures import fixture, register_tables, with_views
from helixspark.plans.q_validation import DB_VIEW
from helixspark.plans.registry import register

PROFILE_SAMPLES = ["S0", "S1", "S2", "S3"]

READS_VIEW = """
select distinct sample, case when sample like 's 3' or sample like 's_8' then 'OXFORD_NANOPORE' else 'ILLUMINA' end as instrument_platform
from f11_sheet where sample <> ''
"""


@register("reads_x_databases", with_views(f""", reads as ({READS_VIEW.strip()}),
dbs as (select distinct tool, db_name from ({DB_VIEW.strip()}) x),
tools as (select unnest(['bracken', 'centrifuge', 'diamond', 'kaiju', 'kraken2', 'krakenuniq', 'malt', 'metaphlan3', 'motus']) as tool)
select r.sample, r.instrument_platform, d.tool, d.db_name, case when d.tool = 'bracken' then 'kraken2' else d.tool end as route
from reads r cross join tools t
join dbs d on d.tool = t.tool""", "f11_sheet"))
def q_reads_x_dbs(spark, sf):
    register_tables(spark, sf)
    fixture(spark, sf, "f11_sheet").createOrReplaceTempView("f11_sheet")
    reads = spark.sql(READS_VIEW)
    dbs = spark.sql(DB_VIEW).select("tool", "db_name").distinct()
    return TX.reads_with_databases(reads, dbs).select("sample", "instrument_platform", "tool", "db_name", "route")


ROUTE_SQL = """tools as (select unnest(['bracken', 'centrifuge', 'diamond', 'kaiju', 'kraken2', 'krakenuniq', 'malt', 'metaphlan3', 'motus']) as tool),
routed as (select r.sample, r.instrument_platform, d.tool, d.db_name, case when d.tool = 'bracken' then 'kraken2' else d.tool end as route
  from reads r cross join tools t
  join dbs d on d.tool = t.tool)"""


@register("report_with_db", with_views(f""", reads as ({READS_VIEW.strip()}),
dball as ({DB_VIEW.strip()}),
dbs as (select distinct tool, db_name from dball),
{ROUTE_SQL},
reports as (select distinct sample, instrument_platform, tool, db_name from routed)
select rp.sample, rp.db_name, d.ord, split_part(coalesce(d.db_params, ''), ';', 2) as step2_params
from reports rp join dball d on d.db_name = rp.db_name and d.tool = rp.tool
where not (rp.tool = 'bracken' and rp.instrument_platform = 'OXFORD_NANOPORE')""", "f11_sheet"))
def q_report_with_db(spark, sf):
    register_tables(spark, sf)
    fixture(spark, sf, "f11_sheet").createOrReplaceTempView("f11_sheet")
    reads = spark.sql(READS_VIEW)
    dbs = spark.sql(DB_VIEW)
    reports = TX.reads_with_databases(reads, dbs.select("tool", "db_name").distinct()).select(
        "sample", "instrument_platform", "tool", "db_name").distinct()
    d = dbs.select("tool", "db_name", "ord", "db_params")
    r = TX.reports_with_db(reports, d)
    return r.select("sample", "db_name", "ord", F.coalesce("step2_params", F.lit("")).alias("step2_params"))


@register("stats_outer", with_views("""
, a as (select sample, count(*) as n_rows from f11_sheet where strandedness = 'forward' group by sample),
b as (select sample, count(*) as n_paired from f11_sheet where fastq_2 <> '' group by sample)
select coalesce(a.sample, b.sample) as sample, a.n_rows, b.n_paired from a full outer join b on a.sample = b.sample""",
                                     "f11_sheet"))
def q_stats_outer(spark, sf):
    s = fixture(spark, sf, "f11_sheet")
    a = s.filter(F.col("strandedness") == "forward").groupBy("sample").agg(F.count("*").alias("n_rows"))
    b = s.filter(F.col("fastq_2") != "").groupBy("sample").agg(F.count("*").alias("n_paired"))
    return TX.outer_on_meta(a, b, ["sample"]).select("sample", "n_rows", "n_paired")


@register("pass_gate", with_views("""
, m as (select sample, avg(cast(ord % 100 as double)) as pct_mapped from f11_sheet group by sample)
select s.ord, s.sample, m.pct_mapped, m.pct_mapped >= 45.0 as passed from f11_sheet s left join m on m.sample = s.sample""",
                                   "f11_sheet"))
def q_pass_gate(spark, sf):
    s = fixture(spark, sf, "f11_sheet")
    m = s.groupBy("sample").agg(F.avg((F.col("ord") % 100).cast("double")).alias("pct_mapped"))
    ok, bad = TX.gate(s.select("ord", "sample"), m, "sample", "pct_mapped", 45.0)
    failed = s.select("ord", "sample").join(bad, "sample")
    return ok.select("ord", "sample", "pct_mapped", F.lit(True).alias("passed")).unionByName(
        failed.select("ord", "sample", "pct_mapped", F.lit(False).alias("passed")))


@register("run_merge", with_views("""
, r as (select sample, strandedness, ord as run_accession, fastq_1, fastq_2 from f11_sheet),
l as (select sample, strandedness, run_accession, 0 as mate, fastq_1 as file from r where fastq_1 <> ''
      union all select sample, strandedness, run_accession, 1, fastq_2 from r where fastq_2 <> ''),
n as (select sample, strandedness, count(distinct run_accession) as n_runs from r group by 1, 2)
select l.sample, l.strandedness, l.file, cast(row_number() over (partition by l.sample, l.strandedness order by l.run_accession, l.mate) as bigint) as file_idx,
  n.n_runs, n.n_runs > 1 as concatenate
from l join n on n.sample = l.sample and n.strandedness = l.strandedness""", "f11_sheet"))
def q_run_merge(spark, sf):
    s = fixture(spark, sf, "f11_sheet").withColumnRenamed("ord", "run_accession")
    r = TX.merge_runs(s, ["sample", "strandedness"])
    return r.select("sample", "strandedness", "file", "file_idx", "n_runs", "concatenate")


@register("profile_merge", with_views(f"""
select 'db1' as db, taxon, {", ".join(f"coalesce(sum(n) filter (where sample = '{s}'), 0) as {s}" for s in PROFILE_SAMPLES)}
from f8_profile group by taxon""", "f8_profile"))
def q_profile_merge(spark, sf):
    p = fixture(spark, sf, "f8_profile").withColumn("db", F.lit("db1"))
    return TX.merge_profiles(p, PROFILE_SAMPLES)


#: A taxonomy that grows with the parts: short and longer chains below a branching tree.
TAXA_VIEW = """
select p_partkey as id, cast(case when p_partkey % 4 = 3 then p_partkey - 1 else floor(p_partkey / 3) end as bigint) as parent,
  concat(p_name, '_', cast(p_partkey as string)) as name, p_brand as phylum, p_type as kingdom
from part
"""

READ_TAXA_VIEW = """
select l_partkey as taxon, concat('S', cast(l_suppkey % 4 as string)) as sample, cast(l_quantity as bigint) as n from lineitem
"""

TAXA_SQL = f"taxa as ({TAXA_VIEW.strip()}), reads as ({READ_TAXA_VIEW.strip()})"


@register("clade_rollup", f"""with recursive {TAXA_SQL}, anc(id, a) as (
  select id, id from taxa
  union all select anc.id, t.parent from anc join taxa t on t.id = anc.a where t.parent <> t.id),
c as (select p.sample, anc.a as taxon, sum(p.n) as clade_reads from reads p join anc on anc.id = p.taxon group by 1, 2),
o as (select sample, taxon, sum(n) as taxon_reads from reads group by 1, 2)
select c.sample, c.taxon, cast(c.clade_reads as bigint) as clade_reads, cast(coalesce(o.taxon_reads, 0) as bigint) as taxon_reads
from c left join o on o.sample = c.sample and o.taxon = c.taxon""")
def q_clade(spark, sf):
    register_tables(spark, sf)
    r = TX.clade_counts(spark.sql(READ_TAXA_VIEW), spark.sql(TAXA_VIEW))
    return r.select("sample", "taxon", F.col("clade_reads").cast("long").alias("clade_reads"),
                    F.col("taxon_reads").cast("long").alias("taxon_reads"))


LINEAGE_SQL = f"""select id as taxid, concat('d__', replace(kingdom, ' ', '_'), ';p__', replace(phylum, ' ', '_'), ';s__', replace(name, ' ', '_'), '_sp') as lineage
from ({TAXA_VIEW.strip()}) t"""


@register("krona_clean", f"""select taxid, replace(regexp_replace(lineage, '(d|k|p|c|o|f|g|s)__', '', 'g'), '_', ' ') as lineage
from ({LINEAGE_SQL}) x""")
def q_krona(spark, sf):
    register_tables(spark, sf)
    return spark.sql(LINEAGE_SQL).select("taxid", TX.clean_lineage("lineage").alias("lineage"))


@register("kraken_cols", f"""with {TAXA_SQL}, p as (select taxon, sum(n) as n from reads group by taxon),
t as (select sum(n) as tot from p)
select round(p.n * 100.0 / t.tot, 2) as pct, p.n::bigint as clade_reads, p.n::bigint as taxon_reads, 'S' as rank_code, p.taxon as taxid, x.name
from p, t, taxa x where x.id = p.taxon""")
def q_kraken_cols(spark, sf):
    register_tables(spark, sf)
    p = spark.sql(READ_TAXA_VIEW).groupBy("taxon").agg(F.sum("n").alias("n"))
    tot = p.agg(F.sum("n")).first()[0]  # one scalar
    x = spark.sql(TAXA_VIEW)
    r8 = p.join(x, x["id"] == p["taxon"]).select(
        F.round(F.col("n") * 100.0 / F.lit(tot), 2).alias("pct"), F.col("n").alias("clade_reads"),
        F.col("n").alias("taxon_reads"), (F.col("n") * 7).alias("minimizers"),
        (F.col("n") * 3).alias("distinct_minimizers"), F.lit("S").alias("rank_code"),
        F.col("taxon").alias("taxid"), "name")
    return TX.standard_report(r8)


@register("branch_route", f"""select ord, tool, case when tool in ('kraken2', 'bracken') then 'kraken2'
  when tool = 'centrifuge' then 'centrifuge' when tool in ('metaphlan3', 'motus') then 'marker'
  when tool in ('diamond', 'kaiju', 'malt') then 'protein' else 'unknown' end as branch
from ({DB_VIEW.strip()}) x""")
def q_branch_route(spark, sf):
    register_tables(spark, sf)
    t = F.col("tool")
    rules = [("kraken2", t.isin("kraken2", "bracken")), ("centrifuge", t == "centrifuge"),
             ("marker", t.isin("metaphlan3", "motus")), ("protein", t.isin("diamond", "kaiju", "malt"))]
    return TX.route(spark.sql(DB_VIEW), rules).select("ord", "tool", "branch")


@register("transpose_rows", with_views("""
select tx, start1, end1 from f5_exons""", "f5_exons"))
def q_transpose(spark, sf):
    ex = fixture(spark, sf, "f5_exons")
    lists = ex.groupBy("tx").agg(F.sort_array(F.collect_list(F.struct("start1", "end1"))).alias("l")).select(
        "tx", F.col("l.start1").alias("start1"), F.col("l.end1").alias("end1"))
    return TX.transpose_rows(lists, ["tx"], ["start1", "end1"])


@register("strand_call", with_views("""
, f as (select contig, 100.0 * avg(case when strand = '+' then 1 else 0 end) as sense,
          100.0 * avg(case when strand = '-' then 1 else 0 end) as antisense from f4_reads group by contig)
select contig as key, round(sense, 6) as sense, round(antisense, 6) as antisense,
  case when sense >= 70 then 'forward' when antisense >= 70 then 'reverse' else 'unstranded' end as strandedness from f
union all
select cast(s_suppkey as varchar), null, null,
  case when s_nationkey % 7 in (0, 1) then 'unstranded' when s_nationkey % 7 in (2, 3) then 'forward' else 'reverse' end
from supplier""", "f4_reads"))
def q_strand_call(spark, sf):
    r = fixture(spark, sf, "f4_reads")
    f = r.groupBy("contig").agg((100.0 * F.avg(F.when(F.col("strand") == "+", 1).otherwise(0))).alias("sense"),
                                (100.0 * F.avg(F.when(F.col("strand") == "-", 1).otherwise(0))).alias("antisense"))
    a = TX.call_strand(f).select(F.col("contig").alias("key"), F.round("sense", 6).alias("sense"),
                                 F.round("antisense", 6).alias("antisense"), "strandedness")
    sup = spark.table("supplier")
    lib = F.element_at(F.array(*[F.lit(x) for x in ["U", "IU", "SF", "ISF", "SR", "ISR", ""]]),
                       (F.col("s_nationkey") % 7 + 1).cast("int"))
    b = sup.select(F.col("s_suppkey").cast("string").alias("key"), F.lit(None).cast("double").alias("sense"),
                   F.lit(None).cast("double").alias("antisense"), TX.strand_from_libtype(lib).alias("strandedness"))
    return a.unionByName(b)


LOGS_VIEW = """
select concat('log', cast(l_orderkey % 20 as string)) as file, l_orderkey * 8 + l_linenumber as line_no,
  case when l_linenumber = 1 then concat(cast(cast(l_quantity * 1000 as bigint) as string), ' sequences processed in total')
       when l_linenumber = 2 then concat('Reads shorter than the length cutoff of 20 bp: ', cast(cast(l_quantity * 10 as bigint) as string))
       when l_linenumber = 3 then concat('   Uniquely mapped reads % |\t', cast(cast(l_discount * 1000 as bigint) as string), '.5%')
       else concat('note ', l_returnflag) end as text
from lineitem
"""


@register("log_metrics", f"""with lines as ({LOGS_VIEW.strip()}),
total_reads as (select file, max(v) as v from (select file, line_no, try_cast(regexp_extract(text, '([0-9.]+)\\ssequences processed in total', 1) as double) as v,
    max(line_no) over (partition by file) as last from lines where regexp_matches(text, '([0-9.]+)\\ssequences processed in total')) where line_no = last group by file),
filtered_reads as (select file, max(v) as v from (select file, line_no, try_cast(regexp_extract(text, 'shorter than the length cutoff[^:]+:\\s([0-9.]+)', 1) as double) as v,
    max(line_no) over (partition by file) as last from lines where regexp_matches(text, 'shorter than the length cutoff[^:]+:\\s([0-9.]+)')) where line_no = last group by file),
pct_uniquely_mapped as (select file, max(v) as v from (select file, line_no, try_cast(regexp_extract(text, 'Uniquely mapped reads %\\s*\\|\\s*([0-9.]+)%', 1) as double) as v,
    max(line_no) over (partition by file) as last from lines where regexp_matches(text, 'Uniquely mapped reads %\\s*\\|\\s*([0-9.]+)%')) where line_no = last group by file)
select f.file, coalesce(total_reads.v, 0.0) as total_reads, coalesce(filtered_reads.v, 0.0) as filtered_reads, coalesce(pct_uniquely_mapped.v, 0.0) as pct_uniquely_mapped from (select distinct file from lines) f left join total_reads on total_reads.file = f.file left join filtered_reads on filtered_reads.file = f.file left join pct_uniquely_mapped on pct_uniquely_mapped.file = f.file""")
def q_log_metrics(spark, sf):
    register_tables(spark, sf)
    return TX.log_metrics(spark.sql(LOGS_VIEW))


@register("gather_sum", with_views("""
select taxon, sample, cast(sum(n) as bigint) as n from f8_profile group by taxon, sample""", "f8_profile"))
def q_gather(spark, sf):
    register_tables(spark, sf)
    a = spark.sql("select s_nationkey + 1000 as taxon, concat('S', cast(s_suppkey % 4 as string)) as sample, "
                  "count(*) as n from supplier group by 1, 2")
    b = spark.sql("select c_nationkey + 1000 as taxon, concat('S', cast(c_custkey % 4 as string)) as sample, "
                  "count(*) as n from customer group by 1, 2")
    return TX.gather([a, b], ["taxon", "sample"], ["n"]).select("taxon", "sample", F.col("n").cast("long").alias("n"))
