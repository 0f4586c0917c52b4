"""Registered variant queries over the f1_calls view (VCF-like records)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixspark.functions import vcf as V
from helixspark.operators import variants as VA
from helixspark.operators.rangejoin import interval_join
from helixspark.plans import exports as X
from helixspark.plans.fixtures import fixture, register_tables, with_views
from helixspark.plans.registry import register
from helixspark.sources import vcf as VS


def f1_records(spark: SparkSession, sf: str) -> DataFrame:
    """f1_calls as VCF records: one file ``f1``, one sample column per record."""
    f = fixture(spark, sf, "f1_calls")
    return f.select(
        F.lit("f1").alias("file_id"), "rec", "chrom", "pos", F.lit(".").alias("vcf_id"), "ref", "alt",
        F.lit(".").alias("qual"), "filter", "info", "format",
        F.array("sampleid").alias("sample_names"), F.array("sample").alias("sample_values"),
    )


# Fixed annotation view (ClinVar-like) derived from lineitem; same text in both engines.
ANN_VIEW = """
select cast(l_partkey % 22 + 1 as string) as contigname, l_orderkey * 8 + l_linenumber + case when l_linenumber % 3 = 0 then 4 else 0 end as start,
  substr('ACGT', cast(l_partkey % 4 + 1 as int), 1) as referenceallele,
  case when l_orderkey % 10 = 0 then concat(substr('CGTA', cast(l_suppkey % 4 + 1 as int), 1), ',', substr('GTAC', cast(l_orderkey % 4 + 1 as int), 1))
       else substr('CGTA', cast(l_orderkey % 4 + 1 as int), 1) end as alts,
  concat('GENE', cast(l_partkey % 50 as string), ':', cast(l_partkey as string)) as geneinfo,
  case when l_suppkey % 3 = 0 then 'drug_response' when l_suppkey % 3 = 1 then 'Pathogenic' else 'Benign' end as clnsig,
  concat('MedGen:C', cast(l_partkey as string), '|SNOMED_CT:', cast(254637000 + l_suppkey % 10 as string), ',SNOMED_CT:', cast(l_suppkey as string)) as clndisdb,
  concat('disease_', cast(l_suppkey % 7 as string)) as clndn
from lineitem
"""


def annotation_store(spark: SparkSession, sf: str) -> DataFrame:
    register_tables(spark, sf)
    a = spark.sql(ANN_VIEW)
    return a.select(
        "contigname", "start", "referenceallele", F.split("alts", ",").alias("alternatealleles"),
        F.create_map(
            F.lit("GENEINFO"), F.col("geneinfo"), F.lit("CLNSIG"), F.col("clnsig"),
            F.lit("CLNDISDB"), F.col("clndisdb"), F.lit("CLNDN"), F.col("clndn"),
        ).alias("attributes"),
    )


def _ann_sql(body: str) -> str:
    return with_views(f", ann as ({ANN_VIEW.strip()})\n{body}", "f1_calls")


# --------------------------------------------------------------------------- flagship

TITV_SQL = with_views(
    """
, calls as (
  select sampleid, ref, alt, filter,
    regexp_split_to_array(split_part(sample, ':', 1), '[/|]') as gt
  from f1_calls),
x as (
  select sampleid, ref as r, unnest(string_split(alt, ',')) as a,
    case when len(gt) = 2 and coalesce(try_cast(gt[1] as int), -1) = coalesce(try_cast(gt[2] as int), -1) then 2 else 1 end as w
  from calls where split_part(filter, ';', 1) = 'PASS')
select sampleid,
  cast(sum(case when (r in ('C','T') and a in ('C','T')) or (r in ('A','G') and a in ('A','G')) then w else 0 end) as double)
  / nullif(sum(case when (r in ('C','T') and a in ('A','G')) or (r in ('A','G') and a in ('C','T')) then w else 0 end), 0) as titv_ratio
from x where length(r) = 1 and length(a) = 1
group by sampleid
""",
    "f1_calls",
)


@register("titv_ratio", TITV_SQL)
def q_titv(spark, sf):
    return VA.titv(VA.to_store(f1_records(spark, sf)))


# --------------------------------------------------------------------------- P1..P9

@register("info_map", with_views("""
select rec, sampleid,
  nullif(regexp_extract(info, '(^|;)DP=([^;]*)', 2), '') as dp,
  case when info like '%;DB%' then 'true' end as db,
  nullif(regexp_extract(info, '(^|;)END=([^;]*)', 2), '') as end_pos,
  cast(len(string_split(info, ';')) as int) as n_keys
from f1_calls""", "f1_calls"))
def q_info_map(spark, sf):
    f = fixture(spark, sf, "f1_calls").withColumn("m", V.info_map("info"))
    return f.select(
        "rec", "sampleid",
        F.try_element_at("m", F.lit("DP")).alias("dp"),
        F.try_element_at("m", F.lit("DB")).alias("db"),
        F.try_element_at("m", F.lit("END")).alias("end_pos"),
        F.size("m").alias("n_keys"),
    )


@register("format_map", with_views("""
select rec, sampleid, split_part(sample, ':', 1) as gt,
  case when len(string_split(sample, ':')) >= 2 then split_part(sample, ':', 2) else '.' end as dp,
  case when len(string_split(sample, ':')) >= 3 then split_part(sample, ':', 3) else '.' end as gq,
  cast(3 as int) as n_attrs
from f1_calls""", "f1_calls"))
def q_format_map(spark, sf):
    f = fixture(spark, sf, "f1_calls").withColumn("m", V.format_map("format", "sample"))
    return f.select(
        "rec", "sampleid", V.genotype("m").alias("gt"),
        F.try_element_at("m", F.lit("DP")).alias("dp"),
        F.try_element_at("m", F.lit("GQ")).alias("gq"),
        F.size("m").alias("n_attrs"),
    )


@register("genotype_rows", with_views("""
select rec, sampleid as sample_name, md5(sampleid) as sample_id, split_part(sample, ':', 1) as genotype
from f1_calls""", "f1_calls"))
def q_genotype_rows(spark, sf):
    return VA.genotype_rows(f1_records(spark, sf)).select("rec", "sample_name", "sample_id", "genotype")


@register("ref_block_flag", with_views("""
select rec, sampleid, regexp_matches(info, '(^|;)END(=|;|$)') as is_reference_block from f1_calls""", "f1_calls"))
def q_ref_block(spark, sf):
    f = fixture(spark, sf, "f1_calls")
    return f.select("rec", "sampleid", V.is_ref_block(V.info_map("info")).alias("is_reference_block"))


@register("alt_explode", with_views("""
select rec, sampleid, cast(i - 1 as int) as alt_idx, case when a = '.' then '' else a end as alt
from (select rec, sampleid, unnest(string_split(alt, ',')) as a, unnest(range(1, len(string_split(alt, ',')) + 1)) as i from f1_calls)""",
                                     "f1_calls"))
def q_alt_explode(spark, sf):
    return VA.explode_alts(f1_records(spark, sf)).select(
        "rec", F.get(F.col("sample_names"), 0).alias("sampleid"), "alt_idx", "alt")


@register("missing_norm", with_views("""
select rec, sampleid, cast(null as varchar) as vcf_id, case when alt = '.' then '' else alt end as alt,
  cast(null as double) as qual, nullif(filter, '.') as filter
from f1_calls""", "f1_calls"))
def q_missing(spark, sf):
    return VA.normalise_missing(f1_records(spark, sf)).select(
        "rec", F.get(F.col("sample_names"), 0).alias("sampleid"), "vcf_id", "alt", "qual", "filter")


@register("sample_select", with_views("""
select rec, sampleid as sample_name, split_part(sample, ':', 1) as genotype from f1_calls where sampleid = 'S3'""",
                                       "f1_calls"))
def q_sample_select(spark, sf):
    rows = VA.genotype_rows(f1_records(spark, sf))
    return VA.select_samples(rows, "S3").select("rec", "sample_name", "genotype")


@register("region_filter", with_views("""
select rec, sampleid, chrom, pos from f1_calls where chrom = 'chr5' and pos between 20000 and 300000""", "f1_calls"))
def q_region(spark, sf):
    f = fixture(spark, sf, "f1_calls").withColumn("pos_bin", V.pos_bin("pos", 100_000))
    return VA.in_region(f, "chr5", 20000, 300000, bin_size=100_000).select("rec", "sampleid", "chrom", "pos")


# Header types of the fixture INFO keys (fixed values of the view's header).
#: f1 calls with fields of every kind of Number; some AD lists are one value short.
TYPED_VIEW = """
select rec, sampleid, chrom, pos, ref, alt, filter,
  concat('AF=0.', cast(rec % 7 as string), case when contains(alt, ',') then ',0.5' else '' end, ';', info, case when rec % 13 = 0 then ';XX=a,b' else '' end) as info,
  'GT:DP:AD:PL' as format,
  concat(split_part(sample, ':', 1), ':', case when rec % 5 = 0 then '.' else cast(rec % 40 as string) end, ':',
         cast(rec % 30 as string), case when rec % 11 = 0 then '' else ',7' end, case when contains(alt, ',') then ',.' else '' end, ':',
         '0,', cast(rec % 90 as string), case when contains(alt, ',') then ',1,2,3,4' else ',255' end) as sample
from f1_calls
"""

#: Header lines of the fields that the exported header does not declare.
TYPED_HEADER = (
    '##INFO=<ID=AF,Number=A,Type=Float,Description="Allele frequency">',
    '##FORMAT=<ID=AD,Number=R,Type=Integer,Description="Depth per allele">',
    '##FORMAT=<ID=PL,Number=G,Type=Integer,Description="Likelihood per genotype">',
)

_TYPED_SQL = f"""
, typed as ({TYPED_VIEW.strip()}),
x as (select *, contains(alt, ',') as two, string_split(sample, ':') as s from typed),
f as (
  select chrom, pos, 'INFO' as scope, null as sample_name, 'AF' as key, 'Float' as type, 'A' as number, regexp_extract(info, 'AF=([^;]*)', 1) as raw, true as ok from x
  union all select chrom, pos, 'INFO', null, 'DP', 'Integer', '1', regexp_extract(info, '(^|;)DP=([^;]*)', 2), true from x
  union all select chrom, pos, 'INFO', null, 'END', 'Integer', '1', regexp_extract(info, '(^|;)END=([^;]*)', 2), true from x where contains(info, 'END=')
  union all select chrom, pos, 'INFO', null, 'DB', 'Flag', '0', null, true from x where contains(info, ';DB')
  union all select chrom, pos, 'INFO', null, 'XX', null, null, 'a,b', null from x where contains(info, 'XX=')
  union all select chrom, pos, 'FORMAT', sampleid, 'GT', 'String', '1', s[1], true from x
  union all select chrom, pos, 'FORMAT', sampleid, 'DP', 'Integer', '1', s[2], true from x
  union all select chrom, pos, 'FORMAT', sampleid, 'AD', 'Integer', 'R', s[3], rec % 11 <> 0 from x
  union all select chrom, pos, 'FORMAT', sampleid, 'PL', 'Integer', 'G', s[4], true from x),
v as (select *, list_transform(string_split(raw, ','), lambda e: nullif(e, '.')) as e from f)
select chrom, pos, scope, sample_name, key, type, number, ok as well_formed, len(e)::bigint as n_values,
  case when type = 'Integer' then list_sum(list_transform(e, lambda t: try_cast(t as bigint)))::bigint end as int_sum,
  case when type = 'Float' then round(list_sum(list_transform(e, lambda t: try_cast(t as double))), 6) end as float_sum,
  case when coalesce(type, 'String') = 'String' then array_to_string(e, '|') end as text
from v"""


@register("typed_info", with_views(_TYPED_SQL, "f1_calls"))
def q_typed_info(spark, sf):
    """All INFO and FORMAT values of the exported files, typed by the files' own headers."""
    fixture(spark, sf, "f1_calls").createOrReplaceTempView("f1_calls")
    lines = VS.read_lines(spark, X.export_vcf(spark.sql(TYPED_VIEW), X.fresh_dir(spark, "vcf"), TYPED_HEADER))
    rec, _ = VS.read_vcf(spark, None, lines=lines)
    _, info, fmt = VS.vcf_header(lines)
    t = VA.typed_fields(rec, info, fmt)
    values = F.coalesce(F.size("ints"), F.size("floats"), F.size("strings"))
    total = lambda c, kind: F.aggregate(F.filter(c, lambda x: x.isNotNull()), F.lit(0).cast(kind), lambda a, x: a + x)
    return t.select("chrom", "pos", "scope", "sample_name", "key", "type", "number", "well_formed", values.cast("long").alias("n_values"),
                    F.when(F.exists("ints", lambda x: x.isNotNull()), total("ints", "bigint")).alias("int_sum"),
                    F.round(total("floats", "double"), 6).alias("float_sum"), F.array_join("strings", "|").alias("text"))


# --------------------------------------------------------------------------- layouts

@register("layout1_write", with_views("""
select md5(concat_ws(':', 'f1', chrom, cast(pos as varchar), ref, alt)) as variant_id, md5(sampleid) as sample_id,
  split_part(sample, ':', 1) as genotype, regexp_matches(info, '(^|;)END=') as is_reference_block
from f1_calls""", "f1_calls"))
def q_layout1(spark, sf):
    t = VA.stored_layout(spark, VA.to_layout1(f1_records(spark, sf), ordered=True), X.fresh_dir(spark, "layout1"), 1, ordered=True)
    links = t["variant_samples"].join(t["samples"], "sample_id")  # every link has its sample
    return links.select("variant_id", "sample_id", "genotype", "is_reference_block")


@register("layout2_write", with_views("""
select chrom, pos, ref, alt, nullif(filter, '.') as filter, md5(sampleid) as sample_id, sampleid as sample_name,
  split_part(sample, ':', 1) as genotype, cast(floor(pos / 1000000) as bigint) as pos_bin,
  regexp_matches(info, '(^|;)END=') as is_reference_block
from f1_calls""", "f1_calls"))
def q_layout2(spark, sf):
    r = VA.stored_layout(spark, VA.to_layout2(f1_records(spark, sf), ordered=True), X.fresh_dir(spark, "layout2"), 2, ordered=True)["variant_regions"]
    e = r.select("*", F.explode("sample_ids").alias("sample_id", "sample_name"))
    return e.select(
        "chrom", "pos", "ref", "alt", "filter", "sample_id", "sample_name",
        F.col("sample_genotypes")[F.col("sample_id")].alias("genotype"), "pos_bin", "is_reference_block",
    )


@register("layout3_write", with_views("""
select md5(sampleid) as sample_id, '.' as variant_name, chrom, pos, ref, alt as alt_list,
  cast(len(string_split(alt, ',')) as int) as n_alts, split_part(sample, ':', 1) as genotype,
  nullif(filter, '.') as filter
from f1_calls""", "f1_calls"))
def q_layout3(spark, sf):
    r = VA.stored_layout(spark, VA.to_layout3(f1_records(spark, sf), ordered=True), X.fresh_dir(spark, "layout3"), 3, ordered=True)["genomic_variants"]
    return r.select(
        "sample_id", "variant_name", "chrom", "pos", "ref", F.array_join("alt", ",").alias("alt_list"),
        F.size("alt").alias("n_alts"), "genotype", "filter",
    )


@register("layout4_write", with_views("""
select md5(concat_ws(':', 'f1', chrom, cast(pos as varchar), ref, a)) as variant_id, md5(sampleid) as sample_id,
  chrom, pos, a as alt, split_part(sample, ':', 1) as genotype
from (select *, unnest(string_split(alt, ',')) as a from f1_calls)""", "f1_calls"))
def q_layout4(spark, sf):
    t = VA.stored_layout(spark, VA.to_layout4(f1_records(spark, sf), ordered=True), X.fresh_dir(spark, "layout4"), 4, ordered=True)
    v = t["variants"].dropDuplicates(["variant_id"]).select("variant_id", "alt")
    links = t["variant_samples"]
    return links.join(v, "variant_id").select("variant_id", "sample_id", "chrom", "pos", "alt", "genotype")


@register("layout3_upsert", with_views("""
, u as (
  select md5(sampleid) as sample_id, chrom, pos, split_part(sample, ':', 1) as genotype, 1 as version from f1_calls
  union all
  select md5(sampleid), chrom, pos, './.', 2 from f1_calls where filter = '.'),
r as (select *, row_number() over (partition by sample_id, chrom, pos order by version desc, genotype desc) as rn from u)
select sample_id, chrom, pos, genotype, version from r where rn = 1""", "f1_calls"))
def q_upsert(spark, sf):
    rec = f1_records(spark, sf)
    path = X.fresh_dir(spark, "layout3")
    VA.write_layout(VA.to_layout3(rec, ordered=True).withColumn("version", F.lit(1)), path, 3, ordered=True)
    new = VA.to_layout3(rec.filter(F.col("filter") == ".")).withColumn("genotype", F.lit("./.")).withColumn(
        "version", F.lit(2))
    VA.upsert_layout3(spark, path, new)
    up = spark.read.parquet(f"{path}/layout3/genomic_variants")
    return up.select("sample_id", "chrom", "pos", "genotype", "version")


@register("genotype_lookup", with_views("""
select distinct c.chrom, c.pos, c.ref, c.alt, c.sampleid as sample_name, split_part(c.sample, ':', 1) as genotype
from f1_calls c
where c.chrom = 'chr7' and exists (select 1 from f1_calls p where p.filter = 'PASS' and p.chrom = c.chrom
  and p.pos = c.pos and p.ref = c.ref and p.alt = c.alt)""", "f1_calls"))
def q_genotype_lookup(spark, sf):
    t = VA.to_layout1(f1_records(spark, sf))
    v = t["variants"].filter((F.col("filter") == "PASS") & (F.col("chrom") == "chr7"))
    return VA.genotypes(v, t["variant_samples"], t["samples"]).select(
        "chrom", "pos", "ref", "alt", "sample_name", "genotype").distinct()


@register("block_lookup", with_views("""
, b as (select rec as block_rec, chrom, pos as bstart, cast(regexp_extract(info, 'END=([0-9]+)', 1) as bigint) as bend
        from f1_calls where info like '%END=%')
select p.rec as point_rec, b.block_rec, p.chrom, p.pos
from f1_calls p join b on p.chrom = b.chrom and p.pos between b.bstart and b.bend""", "f1_calls"))
def q_block_lookup(spark, sf):
    f = fixture(spark, sf, "f1_calls").withColumn("m", V.info_map("info"))
    blocks = f.filter(V.is_ref_block("m")).select(
        F.col("rec").alias("block_rec"), "chrom", F.col("pos").alias("bstart"),
        F.try_element_at("m", F.lit("END")).cast("long").alias("bend"))
    points = f.select(F.col("rec").alias("point_rec"), "chrom", "pos")
    return interval_join(points, blocks, "chrom", "pos", "pos", "bstart", "bend", bin_size=1000).select(
        "point_rec", "block_rec", "chrom", "pos")


# --------------------------------------------------------------------------- annotation

@register("annotation_filter", _ann_sql("""
select concat('chr', contigname) as contigname, start, referenceallele, alts as alt,
  geneinfo as gene_info, clnsig as clinical_significance,
  array_to_string(regexp_extract_all(clndisdb, 'SNOMED_CT:\\d+'), ',') as snomed_ct, clndn as disease_name
from ann
where clndisdb like '%SNOMED_CT:254637007%' and length(referenceallele) = 1
  and len(string_split(alts, ',')) = 1 and length(alts) = 1"""))
def q_annotation_filter(spark, sf):
    r = VA.annotations_for(annotation_store(spark, sf), "SNOMED_CT:254637007")
    return r.select(
        "contigname", "start", "referenceallele", F.array_join("alternatealleles", ",").alias("alt"),
        "gene_info", "clinical_significance", F.array_join("snomed_ct", ",").alias("snomed_ct"), "disease_name")


@register("variant_annotate", _ann_sql("""
, v as (select rec, chrom, pos, ref, unnest(string_split(alt, ',')) as alt from f1_calls),
a as (select concat('chr', contigname) as chrom, start as pos, referenceallele as ref,
        unnest(string_split(alts, ',')) as alt, clnsig from ann)
select v.rec, v.chrom, v.pos, v.ref, v.alt, a.clnsig as clinical_significance
from v left join a on v.chrom = a.chrom and v.pos = a.pos and v.ref = a.ref and v.alt = a.alt"""))
def q_variant_annotate(spark, sf):
    v = VA.explode_alts(f1_records(spark, sf)).select("rec", "chrom", "pos", "ref", "alt")
    r = VA.annotate(v, annotation_store(spark, sf))
    return r.select("rec", "chrom", "pos", "ref", "alt",
                    F.try_element_at("attributes", F.lit("CLNSIG")).alias("clinical_significance"))
