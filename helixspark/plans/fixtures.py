"""Fixture views over the driver tables.

Each view is one SQL text valid in Spark SQL and in DuckDB, so a registered
Spark query builds its input with ``spark.sql(view)`` and the oracle SQL uses the
same text as a CTE. The views derive genomics-shaped inputs (calls, tasks,
counts, reads, exons, files, MSA rows, taxa, events, tokens, sheets) from the
driver tables, so their size grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed view texts (agreed with the oracle; do not edit one side only).
VIEWS: dict[str, str] = {
    "f1_calls": """
select l_orderkey * 8 + l_linenumber as rec, concat('S', cast(l_suppkey % 10 as string)) as sampleid,
  concat('chr', cast(l_partkey % 22 + 1 as string)) as chrom, l_orderkey * 8 + l_linenumber as pos,
  substr('ACGT', cast(l_partkey % 4 + 1 as int), 1) as ref,
  case when l_orderkey % 10 = 0 then concat(substr('CGTA', cast(l_suppkey % 4 + 1 as int), 1), ',', substr('GTAC', cast(l_orderkey % 4 + 1 as int), 1))
       else substr('CGTA', cast(l_orderkey % 4 + 1 as int), 1) end as alt,
  case when l_returnflag = 'R' then '.' else 'PASS' end as filter,
  concat('DP=', cast(cast(l_quantity as bigint) as string), case when l_linestatus = 'O' then ';DB' else '' end,
         case when l_returnflag = 'A' then concat(';END=', cast(l_orderkey * 8 + l_linenumber + 50 as string)) else '' end) as info,
  'GT:DP:GQ' as format,
  concat(case when l_linenumber % 3 = 0 then '0/0' when l_linenumber % 3 = 1 then '0/1' else '1/1' end,
         case when l_orderkey % 5 = 0 then '' else concat(':', cast(cast(l_quantity as bigint) as string)) end) as sample
from lineitem
""",
    "f2_tasks": """
select l_orderkey % 50 as run_id, l_orderkey * 8 + l_linenumber as task_id,
  concat('task', cast(l_partkey % 12 as string), '-', cast(l_linenumber as string)) as name,
  case l_returnflag when 'R' then 'FAILED' when 'A' then 'CANCELLED' else 'COMPLETED' end as status,
  case when l_linenumber = 7 then null else l_partkey % 30 + 1 end as cpus, l_suppkey % 90 + 1 as memory,
  l_orderkey * 13 % 90000 as created_s, l_orderkey * 13 % 90000 + l_linenumber * 5 as start_s,
  case when l_returnflag = 'A' then null else l_orderkey * 13 % 90000 + l_linenumber * 5 + cast(l_quantity as bigint) * 60 end as stop_s
from lineitem
""",
    "f3_counts": """
select concat('g', cast(l_partkey % 60 as string)) as gene_id, concat('t', cast(l_partkey as string)) as tx,
  concat('A', cast(l_suppkey % 2 as string), '_', cast(l_suppkey % 6 as string)) as sample, sum(cast(l_quantity as bigint)) as n
from lineitem group by 1, 2, 3
""",
    "f4_reads": """
select concat('r', cast(l_orderkey as string)) as name, l_orderkey * 8 + l_linenumber as read_id,
  concat('chr', cast(l_partkey % 3 + 1 as string)) as contig, l_partkey * 97 as start0, l_partkey * 97 + 50 as end0,
  case when l_linestatus = 'O' then '+' else '-' end as strand, case when l_returnflag = 'A' then 4 when l_linenumber % 2 = 1 then 67 else 131 end as flag,
  cast(l_quantity as bigint) as qual_sum, substr('ACGTACGT', cast(l_suppkey % 5 + 1 as int), 4) as umi
from lineitem
""",
    "f5_exons": """
select concat('chr', cast(p_partkey % 3 + 1 as string)) as contig, concat('t', cast(p_partkey as string)) as tx,
  concat('g', cast(p_partkey % 60 as string)) as gene_id, p_partkey * 131 + e * 100 + 1 as start1, p_partkey * 131 + e * 100 + 40 + p_size as end1,
  case when p_partkey % 2 = 0 then '+' else '-' end as strand, p_brand as biotype
from part cross join (select 0 as e union all select 1 union all select 2) x
""",
    "f6_files": """
select doc_id as read_set_id, source as store, md5(text) as source1, case when doc_id % 2 = 0 then md5(substr(text, 1, 40)) end as source2 from documents
""",
    "f7_msa": """
select doc_id % 3 as chain, doc_id as row_no, concat('SP', cast(doc_id % 17 as string)) as species,
  translate(md5(text), '0123456789abcdef', 'ARNDCQEGHILKM-FP') as seq from documents
""",
    "f8_taxa": """
select 0 as id, 0 as parent, 'root' as name union all select r_regionkey + 100, 0, r_name from region
union all select n_nationkey + 1000, n_regionkey + 100, n_name from nation
""",
    "f8_profile": """
select s_nationkey + 1000 as taxon, concat('S', cast(s_suppkey % 4 as string)) as sample, count(*) as n from supplier group by 1, 2
union all select c_nationkey + 1000, concat('S', cast(c_custkey % 4 as string)), count(*) from customer group by 1, 2
""",
    "f9_status": """
select user_id as run_id, ts, event_type as status, event_id from events
""",
    "f10_tokens": """
select vec_id % 50 as seq_id, vec_id as tok, embedding from embeddings
""",
    "f11_sheet": """
select doc_id as ord, case when doc_id % 19 = 0 then '' when doc_id % 7 = 0 then concat('s ', cast(doc_id % 9 as string)) else concat('s_', cast(doc_id % 9 as string)) end as sample,
  concat('f', cast(doc_id % 60 as string), case when doc_id % 23 = 0 then '.txt' else '_1.fastq.gz' end) as fastq_1,
  case when doc_id % 9 < 5 then concat('f', cast(doc_id % 60 as string), '_2.fastq.gz') else '' end as fastq_2,
  case when doc_id % 29 = 0 then 'both' when doc_id % 2 = 0 then 'forward' else 'reverse' end as strandedness from documents
""",
}

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


_REGISTERED: dict[tuple[int, str], str] = {}


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Register the driver parquet tables as temp views (lazy; nothing is read yet).

    Registration is remembered per session, so repeated queries on the same
    folder do not list the files again."""
    key = (id(spark), sf_dir)
    if _REGISTERED.get(key) == sf_dir and all(spark.catalog.tableExists(t) for t in ("lineitem",)):
        return
    for t in names:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    _REGISTERED.clear()
    _REGISTERED[key] = sf_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The fixture view ``name`` as a DataFrame over the tables in ``sf_dir``."""
    register_tables(spark, sf_dir)
    return spark.sql(VIEWS[name])


def with_views(sql: str, *names: str) -> str:
    """Prefix an oracle query with the fixture views it uses as CTEs."""
    ctes = ",\n".join(f"{n} as ({VIEWS[n].strip()})" for n in names)
    return f"with {ctes}\n{sql}"
