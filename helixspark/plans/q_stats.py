"""Registered statistics queries (MLlib / driver-side eigen of a small Gram matrix)
plus global sorting and the layout write + pruned region scan."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixspark.operators import alignments as AL
from helixspark.operators import expression as EX
from helixspark.operators import genomic_order as GO
from helixspark.operators import stats as STT
from helixspark.operators import variants as VA
from helixspark.plans import exports as X
from helixspark.plans.fixtures import fixture, with_views
from helixspark.plans.q_alignments import DUP_RATES_SQL, pairs_of
from helixspark.plans.q_expression import VARIABLE_SQL, norm_of
from helixspark.plans.q_variants import f1_records
from helixspark.plans.registry import register
from helixspark.session import written_once


def _rebuilt(scores, loadings, pct, row: str, col: str, k: int):
    """Scores times loadings, entry by entry, with the share of variance that all components have.
    With as many components as the matrix has rank this gives the centred (scaled) matrix back."""
    one = F.lit(1)
    both = scores.withColumn("_j", one).join(loadings.select(F.col(col), *[F.col(f"PC{j}").alias(f"L{j}") for j in range(1, k + 1)]).withColumn("_j", one), "_j")
    value = sum((F.coalesce(F.col(f"PC{j}") * F.col(f"L{j}"), F.lit(0.0)) for j in range(1, k + 1)), F.lit(0.0))
    share = pct.agg(F.sum("percent_variance")).first()[0]  # one scalar
    return both.select(row, col, (F.round(value, 5) + 0.0).alias("z"), F.lit(round(share, 4)).alias("percent"))


@register("sample_pca", with_views(""", g as (select gene_id, sample, log2(sum(n) + 1) as v from f3_counts group by 1, 2),
l as (select g1.gene_id, s.sample, coalesce(g.v, 0) as v from (select distinct gene_id from g) g1
  cross join (select distinct sample from g) s left join g on g.gene_id = g1.gene_id and g.sample = s.sample)
select sample, gene_id, round(v - avg(v) over (partition by gene_id), 5) + 0.0 as z, 100.0::double as percent from l""", "f3_counts"))
def q_sample_pca(spark, sf):
    """All components of six samples over the most variable genes, multiplied back."""
    g = fixture(spark, sf, "f3_counts").groupBy("gene_id", "sample").agg(F.sum("n").alias("n"))
    scores, loadings, pct = STT.sample_pca(g.withColumn("v", F.log2(F.col("n") + 1)), n_top=500, k=6)
    return _rebuilt(scores, loadings, pct, "sample", "gene_id", 6)


@register("cell_scale_pca", f"""with {VARIABLE_SQL},
top as (select feature from vg where variable order by round(disp_z, 9) desc, feature limit 10),
l as (select c.cell, t.feature, coalesce(n.norm, 0) as x from (select distinct cell from norm) c cross join top t
  left join norm n on n.cell = c.cell and n.feature = t.feature)
select cell, feature, round((x - avg(x) over w) / stddev_samp(x) over w, 5) + 0.0 as z, 100.0::double as percent
from l window w as (partition by feature)""")
def q_cell_pca(spark, sf):
    """All components of the cells over the ten genes of highest dispersion, multiplied back."""
    norm = norm_of(spark, sf)
    genes = EX.variable_genes(norm).filter("variable").orderBy(F.round("disp_z", 9).desc(), "feature").limit(10)
    scores, loadings, pct = STT.scale_pca(norm, genes, k=10)
    return _rebuilt(scores, loadings, pct, "cell", "feature", 10)


@register("dup_rate_fit", DUP_RATES_SQL + """, used as (select * from rates where rpk > 0 and dup_rate is not null)
select e.equation, 0.0::double as residual, count(*) as genes, sum(all_reads)::bigint as reads
from used cross join (values ('intercept'), ('slope')) e(equation) group by 1""")
def q_dup_rate_fit(spark, sf):
    """The two score equations of the fit: sums of weight * (rate - fitted) and the same times log10(rpk),
    as a share of all reads. Both vanish at the maximum of the likelihood and only there."""
    # a row per gene: the fit's rounds and both equations read it again
    rates = written_once(AL.dup_rates(AL.mark_duplicates(pairs_of(spark, sf)), fixture(spark, sf, "f5_exons")), "dup-rates")
    b0, b1 = STT.fit_dup_rate(rates)
    d = rates.filter((F.col("rpk") > 0) & F.col("dup_rate").isNotNull()).withColumn("x", F.log10("rpk"))
    gap = F.col("all_reads") * (F.col("dup_rate") - 1 / (1 + F.exp(-(F.lit(b0) + F.lit(b1) * F.col("x")))))
    one = lambda name, g: d.agg(F.lit(name).alias("equation"), (F.round(F.sum(g) / F.sum("all_reads"), 6) + 0.0).alias("residual"),
                                F.count("*").alias("genes"), F.sum("all_reads").alias("reads"))
    return one("intercept", gap).unionByName(one("slope", gap * F.col("x")))


#: A sequence dictionary: chr1 .. chr20 by number, the rest is left to natural order.
CONTIGS_VIEW = """
select distinct chrom as contig, cast(substr(chrom, 4) as int) as number from f1_calls where cast(substr(chrom, 4) as int) <= 20
"""


@register("coordinate_sort", with_views(f"""
, contigs as ({CONTIGS_VIEW.strip()})
select chrom, pos, rec, sampleid,
  row_number() over (order by coalesce(number, 99), cast(substr(chrom, 4) as int), pos, rec, sampleid, ref, alt, filter, info, sample) as ord
from f1_calls left join contigs on contig = chrom""", "f1_calls"))
def q_coordinate_sort(spark, sf):
    """Rows written in coordinate order and numbered by file and place in the file."""
    f = fixture(spark, sf, "f1_calls")
    f.createOrReplaceTempView("f1_calls")
    path = X.fresh_dir(spark, "sorted")
    GO.write_sorted(f, path, spark.sql(CONTIGS_VIEW), ties=("rec", "sampleid", "ref", "alt", "filter", "info", "sample"))
    return GO.numbered_rows(spark, path).select("chrom", "pos", "rec", "sampleid", F.col("ord").cast("long").alias("ord"))


@register("region_scan_layout2", with_views("""
select chrom, pos, ref, alt, md5(sampleid) as sample_id from f1_calls
where chrom = 'chr5' and pos between 20000 and 300000""", "f1_calls"))
def q_region_scan(spark, sf):
    path = X.fresh_dir(spark, "layout2")
    VA.write_layout(VA.to_layout2(f1_records(spark, sf), bin_size=100_000, ordered=True), path, 2, ordered=True)
    stored = spark.read.parquet(f"{path}/layout2/variant_regions")
    hit = VA.in_region(stored, "chr5", 20000, 300000, bin_size=100_000)
    return hit.select("chrom", "pos", "ref", "alt", F.explode(F.map_keys("sample_ids")).alias("sample_id"))
