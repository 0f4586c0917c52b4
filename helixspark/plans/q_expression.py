"""Registered annotation / expression queries over f3_counts, f5_exons, f7_msa and small views."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixspark.operators import expression as EX
from helixspark.plans.fixtures import fixture, register_tables, with_views
from helixspark.plans.registry import register

SAMPLES = ["A0_0", "A1_1", "A0_2", "A1_3", "A0_4", "A1_5"]


def _genes(spark, sf):
    """Gene-level counts: f3 summed over transcripts."""
    return fixture(spark, sf, "f3_counts").groupBy("gene_id", "sample").agg(F.sum("n").alias("n"))


GENES_SQL = "genes as (select gene_id, sample, sum(n) as n from f3_counts group by gene_id, sample)"


#: GTF features of the transcripts: their exons, for two thirds a start and for half of them a stop codon.
FEATURES_VIEW = """
select contig, tx, 'exon' as feature, start1, end1, strand, start1 as ord from f5_exons
union all
select contig, tx, 'start_codon', case when strand = '-' then end1 - 2 else start1 + 3 end, case when strand = '-' then end1 else start1 + 5 end, strand, start1
from f5_exons where cast(substr(tx, 2) as bigint) % 3 <> 0 and start1 % 2 = 0
union all
select contig, tx, 'stop_codon', case when strand = '-' then start1 + 4 else end1 - 6 end, case when strand = '-' then start1 + 6 else end1 - 4 end, strand, start1
from f5_exons where cast(substr(tx, 2) as bigint) % 4 < 2 and start1 % 2 = 1
"""


@register("gtf_bed12", with_views(f""", ft as ({FEATURES_VIEW.strip()}),
ex as (select *, min(start1) over (partition by tx) as s0 from ft where feature = 'exon'),
sc as (select tx, arg_max(start1, ord) as cs from ft where feature = 'start_codon' group by tx),
st as (select tx, arg_max(end1, ord) as ce from ft where feature = 'stop_codon' group by tx)
select min(contig) as chrom, min(start1) - 1 as chromStart, max(end1) as chromEnd, ex.tx as name, 0 as score, min(strand) as strand,
  coalesce(case when min(strand) = '-' then min(ce) - 2 else min(cs) end, min(start1)) - 1 as thickStart,
  coalesce(case when min(strand) = '-' then min(cs) + 2 else min(ce) end, max(end1)) as thickEnd, 0 as itemRgb,
  cast(count(*) as int) as blockCount,
  string_agg(cast(end1 - start1 + 1 as varchar), ',' order by start1, end1) || ',' as blockSizes,
  string_agg(cast(start1 - s0 as varchar), ',' order by start1, end1) || ',' as blockStarts
from ex left join sc on sc.tx = ex.tx left join st on st.tx = ex.tx group by ex.tx""", "f5_exons"))
def q_bed12(spark, sf):
    fixture(spark, sf, "f5_exons").createOrReplaceTempView("f5_exons")
    return EX.to_bed12(spark.sql(FEATURES_VIEW))


@register("biotype_pct", with_views(""",
tb as (select distinct tx, biotype from f5_exons),
c as (select f.sample, t.biotype, sum(f.n) as n from f3_counts f join tb t on t.tx = f.tx group by 1, 2),
tot as (select sample, sum(n) as t from c group by sample),
asked as (select unnest(['Brand#11', 'Brand#25', 'Brand#99']) as biotype)
select tot.sample, asked.biotype, round(coalesce(c.n / tot.t * 100.0, 0.0), 6) as percent
from tot cross join asked left join c on c.sample = tot.sample and c.biotype = asked.biotype""", "f3_counts", "f5_exons"))
def q_biotype_pct(spark, sf):
    tb = fixture(spark, sf, "f5_exons").select("tx", "biotype").distinct()
    c = fixture(spark, sf, "f3_counts").join(tb, "tx")
    r = EX.biotype_pct(c, ["Brand#11", "Brand#25", "Brand#99"])
    return r.select("sample", "biotype", F.round("percent", 6).alias("percent"))


TXLEN_SQL = """txlen as (select tx, sum(end1 - start1 + 1) as length from f5_exons group by tx),
t2g as (select distinct tx, gene_id from f5_exons),
txq as (select f.tx, f.sample, f.n as counts, l.length,
          (f.n / l.length) / sum(f.n / l.length) over (partition by f.sample) * 1e6 as tpm
        from f3_counts f join txlen l on l.tx = f.tx)"""


def _txq(spark, sf):
    ex = fixture(spark, sf, "f5_exons")
    txlen = ex.groupBy("tx").agg(F.sum(F.col("end1") - F.col("start1") + 1).alias("length"))
    q = fixture(spark, sf, "f3_counts").join(txlen, "tx").withColumn("_r", F.col("n") / F.col("length"))
    tot = q.groupBy("sample").agg(F.sum("_r").alias("_t"))
    q = q.join(tot, "sample").withColumn("tpm", F.col("_r") / F.col("_t") * 1e6)
    return q.select("tx", "sample", F.col("n").alias("counts"), "length", "tpm"), ex.select("tx", "gene_id").distinct()


@register("tx_to_gene_sum", with_views(f""", {TXLEN_SQL},
g as (select t2g.gene_id, q.sample, sum(q.counts) as counts, sum(q.tpm) as abundance,
        sum(q.tpm * q.length) / nullif(sum(q.tpm), 0) as length
      from txq q join t2g on t2g.tx = q.tx group by 1, 2),
lib as (select sample, sum(counts) as lib from g group by sample),
ml as (select gene_id, avg(length) as ml from g group by gene_id),
v as (select g.*, g.abundance * ml.ml as v from g join ml on ml.gene_id = g.gene_id),
tv as (select sample, sum(v) as tv from v group by sample)
select v.gene_id, v.sample, round(v.v / tv.tv * lib.lib, 6) as counts, round(v.abundance, 6) as abundance,
  round(v.length, 6) as length
from v join tv on tv.sample = v.sample join lib on lib.sample = v.sample""", "f3_counts", "f5_exons"))
def q_tx_to_gene(spark, sf):
    q, t2g = _txq(spark, sf)
    g = EX.summarise_genes(q, t2g, "lengthScaledTPM")
    return g.select("gene_id", "sample", *[F.round(c, 6).alias(c) for c in ("counts", "abundance", "length")])


@register("size_factors", with_views(f""", {GENES_SQL},
c as (select gene_id, sample, round(n) as c from genes),
ns as (select count(distinct sample) as k from c),
g as (select gene_id, avg(ln(c)) as lg from c where c > 0 group by gene_id having count(*) = (select k from ns))
select c.sample, round(exp(median(ln(c.c) - g.lg)), 6) as size_factor
from c join g on g.gene_id = c.gene_id group by c.sample""", "f3_counts"))
def q_size_factors(spark, sf):
    r = EX.size_factors(_genes(spark, sf))
    return r.select("sample", F.round("size_factor", 6).alias("size_factor"))


#: Cells that grow with the tables, common genes and genes of one order.
CELLS_VIEW = """
select case when l_orderkey % 97 = 0 then concat('r', cast(l_orderkey as string)) else concat('t', cast(l_partkey % 220 as string)) end as feature,
  concat('C', cast(l_suppkey as string)) as cell, sum(cast(l_quantity as bigint)) as n
from lineitem group by 1, 2
"""

NORM_SQL = f"""t as ({CELLS_VIEW.strip()}),
ck as (select cell from t where n > 0 group by cell having count(*) >= 200),
gk as (select feature from t where n > 0 and cell in (select cell from ck) group by feature having count(*) >= 3),
t2 as (select * from t where n > 0 and cell in (select cell from ck) and feature in (select feature from gk)),
tot as (select cell, sum(n) as tot from t2 group by cell),
norm as (select t2.feature, t2.cell, t2.n, ln(1 + t2.n / tot.tot * 1e4) as norm from t2 join tot on tot.cell = t2.cell)"""


def norm_of(spark, sf):
    register_tables(spark, sf)
    return EX.filter_normalise(spark.sql(CELLS_VIEW), 200, 3)


@register("gene_filter_norm", f"""with {NORM_SQL}
select feature, cell, round(norm, 6) as norm from norm""")
def q_filternorm_of(spark, sf):
    return norm_of(spark, sf).select("feature", "cell", F.round("norm", 6).alias("norm"))


VARIABLE_SQL = f"""{NORM_SQL},
nc as (select count(distinct cell) as n from norm),
m as (select feature, sum(exp(norm) - 1) / (select n from nc) as mean,
        (sum((exp(norm) - 1) * (exp(norm) - 1)) - (select n from nc) * power(sum(exp(norm) - 1) / (select n from nc), 2)) / ((select n from nc) - 1) as var
      from norm group by feature),
m2 as (select feature, ln(1 + mean) as exp_mean, ln(var / nullif(mean, 0)) as log_vmr from m),
r as (select min(exp_mean) as lo, max(exp_mean) as hi from m2),
b as (select m2.*, cast(least(greatest(ceil((exp_mean - r.lo) / ((r.hi - r.lo) / 20)), 1), 20) as int) as bin from m2, r),
st as (select bin, avg(log_vmr) as bm, stddev_samp(log_vmr) as bs from b group by bin),
vg as (select b.feature, b.exp_mean, b.log_vmr, b.bin, (b.log_vmr - st.bm) / st.bs as disp_z,
  b.exp_mean > 0.0125 and b.exp_mean < 3.0 and (b.log_vmr - st.bm) / st.bs >= 0.5 as variable
from b join st on st.bin = b.bin)"""


@register("variable_genes", f"""with {VARIABLE_SQL}
select feature, round(exp_mean, 6) as exp_mean, round(log_vmr, 6) as log_vmr, bin, round(disp_z, 6) as disp_z, variable from vg""")
def q_variable_genes(spark, sf):
    v = EX.variable_genes(norm_of(spark, sf))
    return v.select("feature", F.round("exp_mean", 6).alias("exp_mean"), F.round("log_vmr", 6).alias("log_vmr"),
                    "bin", F.round("disp_z", 6).alias("disp_z"), "variable")


_PIVOT_COLS = ", ".join(f"coalesce(sum(n) filter (where sample = '{s}'), 0) as {s}" for s in SAMPLES)


@register("counts_merge", with_views(f""", {GENES_SQL}
select gene_id, {_PIVOT_COLS} from genes group by gene_id""", "f3_counts"))
def q_counts_merge(spark, sf):
    return EX.counts_merge(_genes(spark, sf), SAMPLES)


T2G_PART_SQL = "t2gp as (select distinct tx, gene_id from f5_exons where end1 - start1 > 50)"


def _t2g_part(spark, sf):
    return fixture(spark, sf, "f5_exons").filter(F.col("end1") - F.col("start1") > 50).select("tx", "gene_id").distinct()


@register("tx_rowdata", with_views(f""", {T2G_PART_SQL}
select f.tx, f.sample, f.n, coalesce(t.gene_id, f.tx) as gene_id
from f3_counts f left join t2gp t on t.tx = f.tx""", "f3_counts", "f5_exons"))
def q_tx_rowdata(spark, sf):
    c = fixture(spark, sf, "f3_counts").drop("gene_id")
    return EX.with_tx_names(c, _t2g_part(spark, sf)).select("tx", "sample", "n", "gene_id")


@register("extra_ids", with_views(f""", {T2G_PART_SQL}
select tx from f3_counts except select tx from t2gp""", "f3_counts", "f5_exons"))
def q_extra_ids(spark, sf):
    return EX.missing_ids(fixture(spark, sf, "f3_counts"), _t2g_part(spark, sf))


@register("obs_metadata", with_views(""",
coll as (select sample, array_to_string(list_sort(list_distinct(list(fastq_1))), ',') as fastq_1,
           array_to_string(list_sort(list_distinct(list(strandedness))), ',') as strandedness
         from f11_sheet group by sample)
select c.ord as cell, c.sample, coll.fastq_1, coll.strandedness
from f11_sheet c left join coll on coll.sample = c.sample""", "f11_sheet"))
def q_obs_metadata(spark, sf):
    sh = fixture(spark, sf, "f11_sheet")
    cells = sh.select(F.col("ord").alias("cell"), "sample")
    return EX.with_sample_meta(cells, sh.select("sample", "fastq_1", "strandedness")).select(
        "cell", "sample", "fastq_1", "strandedness")


@register("gene_symbol", with_views("""
, first as (select gene_id, arg_min(biotype, start1 * 100000 + cast(substr(tx, 2) as bigint)) as symbol from f5_exons group by gene_id),
feats as (select distinct gene_id from f3_counts union select 'g_unknown')
select feats.gene_id, first.symbol from feats left join first on first.gene_id = feats.gene_id""",
                                     "f3_counts", "f5_exons"))
def q_gene_symbol(spark, sf):
    ex = fixture(spark, sf, "f5_exons")
    rows = ex.select("gene_id", F.col("biotype").alias("name"),
                     (F.col("start1") * 100000 + F.expr("substring(tx, 2)").cast("long")).alias("ord"))
    feats = fixture(spark, sf, "f3_counts").select("gene_id").distinct().unionByName(
        spark.range(1).select(F.lit("g_unknown").alias("gene_id"))).distinct()
    return EX.with_symbols(feats, rows).select("gene_id", "symbol")


@register("t2g", with_views("""
select tx, arg_min(gene_id, start1 * 100000 + cast(substr(tx, 2) as bigint)) as gene,
  arg_min(biotype, start1 * 100000 + cast(substr(tx, 2) as bigint)) as name
from f5_exons group by tx""", "f5_exons"))
def q_t2g(spark, sf):
    ex = fixture(spark, sf, "f5_exons")
    rows = ex.select(F.concat("tx", F.lit(".2")).alias("tx"), F.concat("gene_id", F.lit(".1")).alias("gene"),
                     F.col("biotype").alias("name"),
                     (F.col("start1") * 100000 + F.expr("substring(tx, 2)").cast("long")).alias("ord"))
    return EX.t2g(rows)


@register("tx2gene_vote", with_views("""
, kv as (select 'gene_id' as attribute, gene_id as value, start1 as ord from f5_exons
         union all select 'transcript_id', tx, start1 from f5_exons
         union all select 'gene_name', biotype, start1 from f5_exons),
q as (select distinct tx from f3_counts),
n as (select attribute, count(distinct value) as n from kv where value in (select tx from q) group by attribute),
fs as (select attribute, min(ord) as fo from kv group by attribute)
select arg_min(n.attribute, -n.n * 1000000 + fs.fo) as attribute, arg_min(n.n, -n.n * 1000000 + fs.fo) as n
from n join fs on fs.attribute = n.attribute""", "f3_counts", "f5_exons"))
def q_tx2gene_vote(spark, sf):
    ex = fixture(spark, sf, "f5_exons")
    g = ex.select(F.col("start1").alias("ord"), F.create_map(
        F.lit("gene_id"), F.col("gene_id"), F.lit("transcript_id"), F.col("tx"),
        F.lit("gene_name"), F.col("biotype")).alias("attrs"))
    return EX.tx2gene_vote(g, fixture(spark, sf, "f3_counts").select("tx"))


@register("top_var_genes", with_views(f""", {GENES_SQL},
g0 as (select * from genes where (length(gene_id) + length(sample) + n) % 7 <> 0),
l as (select g.gene_id, s.sample, coalesce(log2(g0.n + 1), 0) as v from (select distinct gene_id from g0) g
  cross join (select distinct sample from g0) s left join g0 on g0.gene_id = g.gene_id and g0.sample = s.sample)
select gene_id, round(var_samp(v), 6) as variance from l group by gene_id
order by var_samp(v) desc, gene_id limit 20""", "f3_counts"))
def q_top_var(spark, sf):
    g = _genes(spark, sf).filter("(length(gene_id) + length(sample) + n) % 7 <> 0")  # genes that some samples lack
    r = EX.top_variance(g.withColumn("v", F.log2(F.col("n") + 1)), 20)
    return r.select("gene_id", F.round("variance", 6).alias("variance"))


@register("sample_distance", with_views(f""", {GENES_SQL},
g0 as (select * from genes where (length(gene_id) + length(sample) + n) % 7 <> 0),
l as (select g.gene_id, s.sample, coalesce(log2(g0.n + 1), 0) as v from (select distinct gene_id from g0) g
  cross join (select distinct sample from g0) s left join g0 on g0.gene_id = g.gene_id and g0.sample = s.sample)
select a.sample as s1, b.sample as s2, round(sqrt(sum((a.v - b.v) * (a.v - b.v))), 5) as distance
from l a join l b on a.gene_id = b.gene_id group by 1, 2""", "f3_counts"))
def q_sample_distance(spark, sf):
    g = _genes(spark, sf).filter("(length(gene_id) + length(sample) + n) % 7 <> 0")  # genes that some samples lack
    g = g.withColumn("v", F.log2(F.col("n") + 1))
    return EX.sample_distance(g).select("s1", "s2", F.round("distance", 5).alias("distance"))


@register("name_factors", with_views("""
, s as (select distinct sample from f3_counts),
p as (select sample, unnest(string_split(sample, '_')) as level, unnest(range(1, len(string_split(sample, '_')) + 1)) as factor from s),
st as (select factor, count(distinct level) as nl from p group by factor)
select p.sample, cast(p.factor as int) as factor, p.level from p join st on st.factor = p.factor
where st.nl > 1 and st.nl < (select count(*) from s)""", "f3_counts"))
def q_name_factors(spark, sf):
    s = fixture(spark, sf, "f3_counts").select("sample").distinct()
    return EX.name_factors(s).select("sample", F.col("factor").cast("int").alias("factor"), "level")


# --------------------------------------------------------------------------- sequences / contigs

SEQS_SQL = "seqs as (select concat('seq', cast(row_no as string)) as id, replace(seq, '-', '') as seq, species from f7_msa)"


def _seqs(spark, sf):
    m = fixture(spark, sf, "f7_msa")
    return m.select(F.concat(F.lit("seq"), F.col("row_no").cast("string")).alias("id"),
                    F.regexp_replace("seq", "-", "").alias("seq"), "species")


@register("chrom_sizes", with_views(f""", {SEQS_SQL}
select id as name, cast(length(seq) as bigint) as length from seqs""", "f7_msa"))
def q_chrom_sizes(spark, sf):
    return EX.chrom_sizes(_seqs(spark, sf))


@register("fasta_to_gtf", with_views(f""", {SEQS_SQL}
select id as seqname, 'exon' as feature, 1 as start, cast(length(seq) as int) as "end",
  format('exon_id "{{}}.1"; exon_number "1"; gene_id "{{}}_gene"; gene_name "{{}}_gene"; gene_source "custom"; transcript_id "{{}}_gene"; transcript_name "{{}}_gene";', id, id, id, id, id) as attribute
from seqs""", "f7_msa"))
def q_fasta_to_gtf(spark, sf):
    return EX.fasta_to_gtf(_seqs(spark, sf)).select("seqname", "feature", "start", "end", "attribute")


@register("trim_headers", with_views("""
select split_part(concat('ENST', cast(row_no as string), '.1|ENSG', cast(chain as string), '|', species), '|', 1) as id
from f7_msa""", "f7_msa"))
def q_trim_headers(spark, sf):
    m = fixture(spark, sf, "f7_msa")
    h = F.concat(F.lit("ENST"), F.col("row_no").cast("string"), F.lit(".1|ENSG"), F.col("chain").cast("string"),
                 F.lit("|"), F.col("species"))
    return EX.trim_headers(m.select(h.alias("id")))


@register("gtf_in_genome", with_views("""
select e.contig, e.tx, e.start1 from f5_exons e
where e.contig in (select concat('chr', cast(n_nationkey % 3 as string)) from nation)""", "f5_exons"))
def q_gtf_in_genome(spark, sf):
    register_tables(spark, sf)
    genome = spark.table("nation").select(F.concat(F.lit("chr"), (F.col("n_nationkey") % 3).cast("string")).alias("name"))
    return EX.gtf_in_genome(fixture(spark, sf, "f5_exons"), genome).select("contig", "tx", "start1")


@register("contig_guard", """select cast(doc_id as varchar) as name, n_chars * 200000 as length from documents
where n_chars * 200000 > 512000000""")
def q_contig_guard(spark, sf):
    register_tables(spark, sf)
    sizes = spark.table("documents").select(F.col("doc_id").cast("string").alias("name"),
                                            (F.col("n_chars") * 200000).alias("length"))
    return EX.long_contigs(sizes)


@register("biotype_guard", with_views("""
select file from (select p_brand as file, bool_or(p_size > 48) as has from part group by p_brand) where not has""",
                                       "f5_exons"))
def q_biotype_guard(spark, sf):
    register_tables(spark, sf)
    p = spark.table("part")
    attrs = F.when(F.col("p_size") > 48, F.create_map(F.lit("gene_id"), F.col("p_name"), F.lit("gene_biotype"),
                                                       F.col("p_type"))).otherwise(
        F.create_map(F.lit("gene_id"), F.col("p_name")))
    g = p.select(F.col("p_brand").alias("file"), attrs.alias("attrs"))
    return EX.lacks_attribute(g, "attrs", "gene_biotype")


@register("append_reference", with_views(f""", {SEQS_SQL}
select concat('chr', cast(c_custkey as string)) as id, md5(cast(c_custkey as string)) as seq from customer
union all select id, seq from seqs""", "f7_msa"))
def q_append_reference(spark, sf):
    register_tables(spark, sf)
    genome = spark.table("customer").select(F.concat(F.lit("chr"), F.col("c_custkey").cast("string")).alias("id"),
                                            F.md5(F.col("c_custkey").cast("string")).alias("seq"))
    return EX.append_reference(genome, _seqs(spark, sf))[0]
