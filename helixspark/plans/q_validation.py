"""Registered sample-sheet / database-sheet validation queries (f11_sheet and views on part)."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixspark.operators import validation as VL
from helixspark.plans.fixtures import fixture, register_tables, with_views
from helixspark.plans.registry import register

_CLEAN = """s as (
  select ord,
    replace(trim(regexp_replace(coalesce(sample, ''), '^"|"$', '', 'g')), ' ', '_') as sample,
    trim(regexp_replace(coalesce(fastq_1, ''), '^"|"$', '', 'g')) as fastq_1,
    trim(regexp_replace(coalesce(fastq_2, ''), '^"|"$', '', 'g')) as fastq_2,
    trim(regexp_replace(coalesce(strandedness, ''), '^"|"$', '', 'g')) as strandedness
  from f11_sheet)"""

_FQ = """when fastq_1 <> '' and fastq_1 like '% %' then 'fastq_space'
    when fastq_2 <> '' and fastq_2 like '% %' then 'fastq_space'
    when fastq_1 <> '' and not (fastq_1 like '%.fastq.gz' or fastq_1 like '%.fq.gz') then 'fastq_extension'
    when fastq_2 <> '' and not (fastq_2 like '%.fastq.gz' or fastq_2 like '%.fq.gz') then 'fastq_extension'"""


def _out(ok, rej, single_type="string"):
    a = ok.select("ord", "sample", F.col("single_end").cast(single_type).alias("single_end"),
                  F.lit(None).cast("string").alias("rule"))
    b = rej.select("ord", F.lit(None).cast("string").alias("sample"),
                   F.lit(None).cast(single_type).alias("single_end"), "rule")
    return a.unionByName(b)


@register("sheet_rnaseq", with_views(f""", {_CLEAN},
r as (select *, case
    when ((sample <> '')::int + (fastq_1 <> '')::int + (fastq_2 <> '')::int + (strandedness <> '')::int) < 3 then 'populated_columns'
    when sample = '' then 'sample_missing'
    {_FQ}
    when strandedness = '' then 'strandedness_missing'
    when strandedness not in ('unstranded', 'forward', 'reverse', 'auto') then 'strandedness_invalid'
    when fastq_1 = '' then 'invalid_combination' end as rule,
  case when fastq_2 = '' then '1' else '0' end as single_end from s),
v as (select ord, sample, single_end, strandedness,
        case when ord > min(ord) over (partition by sample, single_end, fastq_1, fastq_2, strandedness) then 'duplicate_row' end as rule
      from r where rule is null),
a as (select * from v union all select ord, sample, single_end, strandedness, rule from r where rule is not null),
p as (select sample, count(distinct single_end) as nse, count(distinct strandedness) as nst from a where rule is null group by sample),
f as (select a.ord, a.sample, a.single_end,
        coalesce(a.rule, case when p.nse > 1 then 'mixed_datatype' when p.nst > 1 then 'mixed_strandedness' end) as rule
      from a left join p on a.sample = p.sample)
select ord, case when rule is null then sample || '_T' || cast(row_number() over (partition by sample, rule is null order by ord) as varchar) end as sample,
  case when rule is null then single_end end as single_end, rule
from f""", "f11_sheet"))
def q_sheet_rnaseq(spark, sf):
    ok, rej = VL.check_rnaseq(fixture(spark, sf, "f11_sheet"))
    return _out(ok, rej)


@register("sheet_scrnaseq", with_views(f""", {_CLEAN},
r as (select *, case
    when ((sample <> '')::int + (fastq_1 <> '')::int + (fastq_2 <> '')::int) < 2 then 'populated_columns'
    when sample = '' then 'sample_missing'
    {_FQ}
    when fastq_1 = '' then 'invalid_combination' end as rule,
  case when fastq_2 = '' then '1' else '0' end as single_end from s),
p as (select sample, count(distinct single_end) as nse from r where rule is null group by sample),
f as (select r.ord, r.sample, r.single_end, coalesce(r.rule, case when p.nse > 1 then 'mixed_datatype' end) as rule
      from r left join p on r.sample = p.sample)
select ord, case when rule is null then sample end as sample, case when rule is null then single_end end as single_end, rule
from f""", "f11_sheet"))
def q_sheet_scrnaseq(spark, sf):
    ok, rej = VL.check_scrnaseq(fixture(spark, sf, "f11_sheet").drop("strandedness"))
    return _out(ok, rej)


#: f11 sheet with the two optional columns.
CELLS_SHEET_VIEW = """
select ord, sample, fastq_1, fastq_2,
  case when ord % 17 = 0 then 'many' when ord % 31 = 0 then '' when ord % 37 = 0 then '50.0' else cast(ord * 10 as string) end as expected_cells,
  case when ord % 4 = 0 then '' else concat('centre ', cast(ord % 3 as string)) end as seq_center
from f11_sheet
"""


@register("sheet_scrnaseq_cells", with_views(f""", {_CLEAN},
x as ({CELLS_SHEET_VIEW.strip()}),
r as (select s.*, x.expected_cells, replace(x.seq_center, ' ', '_') as seq_center, case
    when ((s.sample <> '')::int + (s.fastq_1 <> '')::int + (s.fastq_2 <> '')::int + (x.expected_cells <> '')::int + (x.seq_center <> '')::int) < 2 then 'populated_columns'
    when s.sample = '' then 'sample_missing'
    when not regexp_full_match(x.expected_cells, '[+-]?[0-9]+(\\.0*)?') then 'expected_cells'
    {_FQ.replace("fastq_1", "s.fastq_1").replace("fastq_2", "s.fastq_2")}
    when s.fastq_1 = '' then 'invalid_combination' end as rule,
  case when s.fastq_2 = '' then '1' else '0' end as single_end from s join x on x.ord = s.ord),
p as (select sample, count(distinct single_end) as nse from r where rule is null group by sample),
f as (select r.* exclude (rule), coalesce(r.rule, case when p.nse > 1 then 'mixed_datatype' end) as rule
      from r left join p on r.sample = p.sample)
select ord, case when rule is null then sample end as sample, case when rule is null then single_end end as single_end,
  case when rule is null then expected_cells end as expected_cells, case when rule is null then seq_center end as seq_center, rule
from f""", "f11_sheet"))
def q_sheet_scrnaseq_cells(spark, sf):
    fixture(spark, sf, "f11_sheet").createOrReplaceTempView("f11_sheet")
    ok, rej = VL.check_scrnaseq(spark.sql(CELLS_SHEET_VIEW), extra_cols=True)
    cols = ["sample", "single_end", "expected_cells", "seq_center"]
    a = ok.select("ord", *cols, F.lit(None).cast("string").alias("rule"))
    return a.unionByName(rej.select("ord", *[F.lit(None).cast("string").alias(c) for c in cols], "rule"))


@register("sheet_fastqc", with_views(f""", {_CLEAN},
r as (select *, case
    when sample = '' then 'sample_missing'
    when fastq_1 = '' then 'fastq_1_missing'
    when not (fastq_1 like '%.fastq.gz' or fastq_1 like '%.fq.gz') then 'fastq_extension'
    when fastq_2 <> '' and not (fastq_2 like '%.fastq.gz' or fastq_2 like '%.fq.gz') then 'fastq_extension'
    when fastq_2 <> '' and regexp_extract(fastq_1, '((\\.[^./]*)?\\.[^./]*)$', 1) <> regexp_extract(fastq_2, '((\\.[^./]*)?\\.[^./]*)$', 1) then 'pair_extension'
    end as rule,
  fastq_2 = '' as single_end from s),
v as (select ord, sample, single_end,
        case when ord > min(ord) over (partition by sample, fastq_1) then 'sample_fastq_not_unique' end as rule
      from r where rule is null),
f as (select * from v union all select ord, sample, single_end, rule from r where rule is not null)
select ord, case when rule is null then sample || '_T' || cast(row_number() over (partition by sample, rule is null order by ord) as varchar) end as sample,
  case when rule is null then single_end end as single_end, rule
from f""", "f11_sheet"))
def q_sheet_fastqc(spark, sf):
    ok, rej = VL.check_fastqc(fixture(spark, sf, "f11_sheet").drop("strandedness"))
    return _out(ok, rej, "boolean")


# Database sheet derived from part (fixed view; same text in both engines).
DB_VIEW = """
select p_partkey as ord,
  case p_partkey % 12 when 0 then 'kraken2' when 1 then 'bracken' when 2 then 'centrifuge' when 3 then 'kaiju'
    when 4 then 'metaphlan3' when 5 then 'malt' when 6 then 'diamond' when 7 then 'motus' when 8 then 'krakenuniq'
    when 9 then 'ganon' when 10 then 'kmcp' else 'blast' end as tool,
  concat('db_', p_brand) as db_name,
  case when p_partkey % 5 = 0 then concat(p_type, ';', cast(p_size as string)) when p_partkey % 7 = 0 then concat('"', p_type, '"') else p_type end as db_params,
  concat('/db/', p_name) as db_path
from part
"""


@register("db_sheet", f"""with dbs as ({DB_VIEW.strip()}),
r as (select *, case
    when tool not in ('bracken', 'centrifuge', 'diamond', 'kaiju', 'kraken2', 'krakenuniq', 'malt', 'metaphlan3', 'motus') then 'unknown_tool'
    when regexp_matches(coalesce(db_params, ''), '["'']') then 'quoted_params'
    when tool = 'bracken' and coalesce(db_params, '') <> '' and not contains(db_params, ';') then 'bracken_params'
    end as rule0,
  count(*) over (partition by tool, db_name) as n from dbs)
select ord, tool, db_name, coalesce(rule0, case when n > 1 then 'db_name_not_unique' end) as rule from r""")
def q_db_sheet(spark, sf):
    register_tables(spark, sf)
    ok, rej = VL.check_databases(spark.sql(DB_VIEW))
    a = ok.select("ord", "tool", "db_name", F.lit(None).cast("string").alias("rule"))
    b = rej.join(spark.sql(DB_VIEW).select("ord", "tool", "db_name"), "ord").select("ord", "tool", "db_name", "rule")
    return a.unionByName(b)


VERSIONS_VIEW = """
select concat('NFCORE_RNASEQ:RNASEQ:', p_mfgr_like, ':', upper(split_part(p_type, ' ', 1))) as process,
  concat('tool: ', cast(p_size % 3 as string), '.0') as versions
from (select p_partkey, p_type, p_size, p_brand as p_mfgr_like from part)
"""


@register("versions_conflict", f"""with v as ({VERSIONS_VIEW.strip()}),
m as (select regexp_extract(process, '[^:]*$', 0) as module, versions from v)
select module, cast(count(distinct versions) as bigint) as n_versions,
  array_to_string(list_sort(list_distinct(list(versions))), '|') as version_sets
from m group by module having count(distinct versions) > 1""")
def q_versions(spark, sf):
    register_tables(spark, sf)
    r = VL.version_conflicts(spark.sql(VERSIONS_VIEW))
    return r.select("module", "n_versions", F.array_join("version_sets", "|").alias("version_sets"))
