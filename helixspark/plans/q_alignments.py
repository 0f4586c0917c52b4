"""Registered alignment-table queries over f4_reads (and views derived from it, f5_exons, documents)."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixspark.operators import alignments as AL
from helixspark.plans.fixtures import fixture, register_tables, with_views
from helixspark.plans.registry import register

MATES_VIEW = """
select name, read_id, contig, start0, end0, strand,
  flag + case when read_id % 8 >= 5 and flag <> 4 then 256 else 0 end as flag, qual_sum, nullif(umi, 'GTAC') as umi,
  case when read_id % 2 = 1 then lead(contig) over w else lag(contig) over w end as next_contig,
  case when read_id % 2 = 1 then lead(start0) over w else lag(start0) over w end as next_start0
from f4_reads
window w as (partition by name order by read_id, contig, start0, end0, strand, qual_sum, umi)
"""

SIZES_VIEW = """
select concat('chr', cast(r_regionkey + 1 as string)) as contig, 50000 + r_regionkey * 30000 as size from region
"""

SEQREADS_VIEW = """
select doc_id as read_id, concat('r', cast(doc_id as string)) as name,
  substr(concat(translate(md5(text), '0123456789abcdef', 'ACGTACGTACGTAAAA'), translate(md5(concat(lang, text)), '0123456789abcdef', 'GGCCAATTGGCCAATT')), 1, cast(20 + doc_id % 45 as int)) as seq,
  substr(translate(concat(md5(concat(source, text)), md5(concat(text, 'q'))), '0123456789abcdef', 'ABCDEFGHIJ#+5:?@'), 1, cast(20 + doc_id % 45 as int)) as qual
from documents
"""


def _mates(spark, sf):
    fixture(spark, sf, "f4_reads").createOrReplaceTempView("f4_reads")
    return spark.sql(MATES_VIEW)


def msql(body: str) -> str:
    return with_views(f", mates as ({MATES_VIEW.strip()})\n{body}", "f4_reads")


_FLAG_CLASSES = {
    "total": "true",
    "primary": "(flag & 256) = 0 and (flag & 2048) = 0",
    "secondary": "(flag & 256) <> 0",
    "supplementary": "(flag & 2048) <> 0",
    "duplicates": "(flag & 1024) <> 0",
    "mapped": "(flag & 4) = 0",
    "paired": "(flag & 1) <> 0 and (flag & 256) = 0 and (flag & 2048) = 0",
    "read1": "(flag & 1) <> 0 and (flag & 64) <> 0 and (flag & 256) = 0 and (flag & 2048) = 0",
    "read2": "(flag & 1) <> 0 and (flag & 128) <> 0 and (flag & 256) = 0 and (flag & 2048) = 0",
    "properly_paired": "(flag & 1) <> 0 and (flag & 2) <> 0 and (flag & 4) = 0 and (flag & 256) = 0 and (flag & 2048) = 0",
    "with_mate_mapped": "(flag & 1) <> 0 and (flag & 4) = 0 and (flag & 8) = 0 and (flag & 256) = 0 and (flag & 2048) = 0",
    "singletons": "(flag & 1) <> 0 and (flag & 4) = 0 and (flag & 8) <> 0 and (flag & 256) = 0 and (flag & 2048) = 0",
}
_FLAG_SQL = ", ".join(
    f"count(*) filter (where ({c}) and (flag & 512) = 0) as {k}_passed, count(*) filter (where ({c}) and (flag & 512) <> 0) as {k}_failed"
    for k, c in _FLAG_CLASSES.items())


@register("flag_stats", msql(f"select {_FLAG_SQL} from mates"))
def q_flag_stats(spark, sf):
    return AL.flag_stats(_mates(spark, sf))


@register("idx_stats", with_views(f""", sizes as ({SIZES_VIEW.strip()})
select s.contig, s.size, coalesce(count(*) filter (where (r.flag & 4) = 0), 0) as mapped,
  coalesce(count(*) filter (where (r.flag & 4) <> 0), 0) as unmapped
from sizes s left join f4_reads r on r.contig = s.contig group by s.contig, s.size""", "f4_reads"))
def q_idx_stats(spark, sf):
    register_tables(spark, sf)
    return AL.idx_stats(fixture(spark, sf, "f4_reads"), spark.sql(SIZES_VIEW)).select("contig", "size", "mapped", "unmapped")


#: f4 reads as templates of two ends: the first and second read of an order, the third and fourth, ..., a single last one.
PAIRS_VIEW = """
select concat(name, '/', cast(cast(floor((line - 1) / 2) as bigint) as string)) as name, cast(substr(name, 2) as bigint) * 1000 + line as read_id,
  contig, start0 % 19400 as start0, start0 % 19400 + end0 - start0 as end0, strand,
  case when flag = 4 then 4 when line % 2 = 1 then 67 else 131 end as flag, qual_sum, umi
from (select *, row_number() over (partition by name order by read_id, contig, start0, strand, flag, qual_sum, umi) as line from f4_reads) x
"""


def pairs_of(spark, sf):
    fixture(spark, sf, "f4_reads").createOrReplaceTempView("f4_reads")
    return spark.sql(PAIRS_VIEW)


DUP_SQL = f"""pairs as ({PAIRS_VIEW.strip()}),
ends as (select name, read_id, qual_sum, (flag & 128) <> 0 as second, {{'c': contig, 'p': case when strand = '-' then end0 - 1 else start0 end, 's': strand}} as e
         from pairs where (flag & 4) = 0
         qualify row_number() over (partition by name, (flag & 128) <> 0 order by read_id) = 1),
templates as (select name, min(read_id) as first_id, sum(qual_sum) as q, count(*) as n, min(e) as lo, max(e) as hi from ends group by name),
chosen as (select name from templates qualify row_number() over (partition by n, lo, hi order by q desc, first_id) = 1),
marked as (select *, (flag & 4) = 0 and name not in (select name from chosen) as is_duplicate from pairs)"""


@register("mark_duplicates", with_views(f", {DUP_SQL}\nselect read_id, name, is_duplicate from marked", "f4_reads"))
def q_mark_duplicates(spark, sf):
    return AL.mark_duplicates(pairs_of(spark, sf)).select("read_id", "name", "is_duplicate")


@register("umi_dedup", with_views("""
, dk as (select *, case when strand = '-' then end0 - 1 else start0 end as p5 from f4_reads where (flag & 4) = 0),
best as (select contig, p5, strand, umi, arg_max(read_id, {'q': qual_sum, 'r': -read_id}) as read_id from dk group by 1, 2, 3, 4)
select dk.read_id, dk.contig, dk.umi from dk join best on best.contig = dk.contig and best.p5 = dk.p5
  and best.strand = dk.strand and best.umi = dk.umi and best.read_id = dk.read_id""", "f4_reads"))
def q_umi_dedup(spark, sf):
    return AL.umi_dedup(fixture(spark, sf, "f4_reads")).select("read_id", "contig", "umi")


@register("coverage_bedgraph", with_views("""
, ev as (select contig, start0 as pos, 1 as d from f4_reads where (flag & 4) = 0
         union all select contig, end0, -1 from f4_reads where (flag & 4) = 0),
p as (select contig, pos, sum(d) as d from ev group by 1, 2),
dp as (select contig, pos, sum(d) over (partition by contig order by pos) as depth from p),
ch as (select *, lag(depth) over (partition by contig order by pos) as prev from dp),
st as (select contig, pos, depth from ch where prev is null or prev <> depth),
runs as (select *, lead(pos) over (partition by contig order by pos) as nxt from st)
select contig, pos as start, nxt as "end", cast(depth as bigint) as depth from runs where depth > 0 and nxt is not null""",
                                          "f4_reads"))
def q_coverage(spark, sf):
    r = AL.coverage(fixture(spark, sf, "f4_reads"))
    return r.select("contig", "start", "end", F.col("depth").cast("long").alias("depth"))


FC_SQL = """rr as (select contig, start0 + 1 as rs, end0 as re, count(*) as w from f4_reads
        where (flag & 4) = 0 and (flag & 256) = 0 group by 1, 2, 3),
ov as (select rr.contig, rr.rs, rr.re, rr.w, e.gene_id from rr join f5_exons e on e.contig = rr.contig and e.start1 <= rr.re and rr.rs <= e.end1),
pr as (select contig, rs, re, w, count(distinct gene_id) as n, min(gene_id) as gene_id from ov group by 1, 2, 3, 4)"""


@register("feature_counts", with_views(f""", {FC_SQL}
select gene_id, cast(sum(w) as bigint) as count from pr where n = 1 group by gene_id""", "f4_reads", "f5_exons"))
def q_feature_counts(spark, sf):
    return AL.count_features(fixture(spark, sf, "f4_reads"), fixture(spark, sf, "f5_exons"))


@register("bed_clip", with_views(f""", sizes as ({SIZES_VIEW.strip()}),
b as (select contig, tx, start1 - 1 as start, end1 as "end" from f5_exons)
select b.contig, b.tx, greatest(b.start, 0) as start, least(b."end", s.size) as "end"
from b join sizes s on s.contig = b.contig where greatest(b.start, 0) < least(b."end", s.size)""", "f5_exons"))
def q_bed_clip(spark, sf):
    register_tables(spark, sf)
    bed = fixture(spark, sf, "f5_exons").select("contig", "tx", (F.col("start1") - 1).alias("start"),
                                                F.col("end1").alias("end"))
    r = AL.clip_intervals(bed, spark.sql(SIZES_VIEW))
    return r.select("contig", "tx", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))


@register("fastq_qc", f"""with rd as ({SEQREADS_VIEW.strip()}),
q as (select unnest(range(0, length(qual))) as pos, unnest(string_split(qual, '')) as c from rd)
select 'mean_quality' as metric, cast(pos as bigint) as key, round(avg(ascii(c) - 33), 6) as value from q group by pos
union all
select 'gc_percent', cast(round((length(seq) - length(regexp_replace(seq, '[GCgc]', '', 'g'))) / length(seq) * 100) as bigint), cast(count(*) as double)
from rd group by 2
union all
select 'length', cast(length(seq) as bigint), cast(count(*) as double) from rd group by 2""")
def q_fastq_qc(spark, sf):
    register_tables(spark, sf)
    per_pos, gc, ln = AL.read_qc(spark.sql(SEQREADS_VIEW))
    return per_pos.select(F.lit("mean_quality").alias("metric"), F.col("pos").cast("long").alias("key"),
                          F.round("mean_quality", 6).alias("value")).unionByName(
        gc.select(F.lit("gc_percent").alias("metric"), F.col("gc_percent").cast("long").alias("key"),
                  F.col("reads").cast("double").alias("value"))).unionByName(
        ln.select(F.lit("length").alias("metric"), F.col("length").cast("long").alias("key"),
                  F.col("reads").cast("double").alias("value")))


@register("read_filter", f"""with rd as ({SEQREADS_VIEW.strip()}),
m as (select *, list_sum(list_transform(string_split(qual, ''), lambda c: ascii(c) - 33)) / length(qual) as qual_mean,
        list_sum(list_transform(range(1, length(seq)), lambda i: (substr(seq, i, 1) <> substr(seq, i + 1, 1))::int)) / (length(seq) - 1) as cx
      from rd),
f as (select * from m where length(seq) >= 30 and coalesce(cx, 0) >= 0.5),
r as (select *, row_number() over (order by qual_mean desc, read_id) as rk, count(*) over () as n from f)
select read_id from r where rk <= ceil(n * 80 / 100.0)""")
def q_read_filter(spark, sf):
    register_tables(spark, sf)
    rd = spark.sql(SEQREADS_VIEW)
    qsum = F.aggregate(F.transform(F.split("qual", ""), lambda c: F.ascii(c) - 33), F.lit(0), lambda a, x: a + x)
    rd = rd.withColumn("qual_mean", qsum / F.length("qual"))
    return AL.filter_reads(rd, min_len=30, min_complexity=0.5, keep_percent=80).select("read_id")


@register("read_subsample", with_views("""
select read_id, name from f4_reads
where cast(('0x' || substr(md5(concat_ws(':', '3', name)), 1, 8)) as bigint) / 4294967296.0 < 0.3""", "f4_reads"))
def q_subsample(spark, sf):
    return AL.subsample(fixture(spark, sf, "f4_reads"), 0.3, seed=3).select("read_id", "name")


@register("host_removal", msql("""
select read_id, name from f4_reads
where name not in (select name from mates where contig = 'chr3' and (flag & 4) = 0)"""))
def q_host_removal(spark, sf):
    m = _mates(spark, sf)
    return AL.drop_host(fixture(spark, sf, "f4_reads"), m.filter(F.col("contig") == "chr3")).select("read_id", "name")


@register("interval_split", with_views("""
, iv as (select contig, tx, start1 - 1 as start, end1 as "end", end1 - start1 + 1 as len from f5_exons),
c as (select *, sum(len) over (order by contig, start, "end", tx rows between unbounded preceding and 1 preceding) as before,
        sum(len) over () as total from iv)
select contig, tx, start, "end", cast(floor(coalesce(before, 0) * 7 / total) as int) as shard from c""", "f5_exons"))
def q_interval_split(spark, sf):
    iv = fixture(spark, sf, "f5_exons").select("contig", "tx", (F.col("start1") - 1).alias("start"),
                                               F.col("end1").alias("end"))
    return AL.split_intervals(iv, 7, ["contig", "start", "end", "tx"]).select("contig", "tx", "start", "end", "shard")


@register("mate_pairs", msql("""
, r as (select *, (flag & 64) <> 0 as r1, (flag & 128) <> 0 as r2, (flag & 256) <> 0 as sec from mates),
j as (select r.read_id, c.read_id as c_id, c.sec as c_sec, c.umi as c_umi,
        case when c.sec <> r.sec then 0 else 1 end as l,
        case when c.next_contig = r.contig and c.next_start0 = r.start0 then 0 else 1 end as b,
        case when c.next_contig = r.contig and c.next_start0 = r.start0 then -c.read_id else c.read_id end as o
      from r join r c on c.name = r.name and c.r1 = (not r.r1) and c.contig = r.next_contig and c.start0 = r.next_start0),
best as (select read_id, arg_min({'c_id': c_id, 'c_sec': c_sec, 'c_umi': c_umi}, {'l': l, 'b': b, 'o': o, 'c_id': c_id, 'c_sec': c_sec, 'c_umi': c_umi}) as m
         from j group by read_id),
rr as (select r.*, best.m from r join best on best.read_id = r.read_id where r.r1 or r.r2)
select distinct * from (
  select name, read_id as read1_id, m.c_id as read2_id, sec or m.c_sec as read2_secondary, sec as read1_secondary, coalesce(umi, m.c_umi) as read2_umi
  from rr where r1
  union all
  select name, m.c_id, read_id, sec, sec or m.c_sec, coalesce(m.c_umi, umi) from rr where not r1)"""))
def q_matepairs_of(spark, sf):
    pairs, _, _ = AL.pair_mates(_mates(spark, sf))
    return pairs.select("name", "read1_id", "read2_id", "read2_secondary", "read1_secondary", "read2_umi")


_FC_ALL = FC_SQL.replace("from f4_reads", "from marked")
_FC_DEDUP = (FC_SQL.replace("from f4_reads", "from (select * from marked where not is_duplicate) x")
             .replace("rr", "rr2").replace("ov", "ov2").replace("pr as", "pr2 as"))


DUP_RATES_SQL = with_views(f""", {DUP_SQL}, {_FC_ALL}, {_FC_DEDUP},
a as (select gene_id, cast(sum(w) as bigint) as all_reads from pr where n = 1 group by gene_id),
d as (select gene_id, cast(sum(w) as bigint) as dedup_reads from pr2 where n = 1 group by gene_id),
l as (select gene_id, sum(end1 - start1 + 1) as length from f5_exons group by gene_id),
rates as (select l.gene_id, l.length, coalesce(a.all_reads, 0) as all_reads, coalesce(d.dedup_reads, 0) as dedup_reads,
  (coalesce(a.all_reads, 0) - coalesce(d.dedup_reads, 0)) / nullif(coalesce(a.all_reads, 0), 0) as dup_rate,
  coalesce(a.all_reads, 0) / (l.length / 1000.0) as rpk
  from l left join a on a.gene_id = l.gene_id left join d on d.gene_id = l.gene_id)""", "f4_reads", "f5_exons")


@register("dup_rate_genes", DUP_RATES_SQL + """
select gene_id, length, all_reads, dedup_reads, round(dup_rate, 6) as dup_rate, round(rpk, 6) as rpk from rates""")
def q_dup_rate_genes(spark, sf):
    marked = AL.mark_duplicates(pairs_of(spark, sf))
    t = AL.dup_rates(marked, fixture(spark, sf, "f5_exons"))
    return t.select("gene_id", "length", "all_reads", "dedup_reads", F.round("dup_rate", 6).alias("dup_rate"),
                    F.round("rpk", 6).alias("rpk"))
