"""Registered protein-structure queries (documents, f7_msa, orders, embeddings, f10_tokens)."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixspark.operators import structure as ST
from helixspark.plans.fixtures import fixture, register_tables, with_views
from helixspark.plans.registry import register

# --------------------------------------------------------------------------- inputs


@register("resource_tier", """select doc_id, n_chars,
  case when n_chars <= 2000 then 16 else 32 end as uniref90_memory_gib,
  case when n_chars <= 2000 then 16 else 48 end as bfd_cpu,
  case when n_chars <= 750 then 32 when n_chars <= 2000 then 128 else 192 end as bfd_memory_gib,
  case when n_chars <= 2000 then 16 else 32 end as mgnify_memory_gib, 8 as mgnify_cpu, 8 as uniref90_cpu,
  2 as template_cpu, 4 as template_memory_gib, 2 as feature_cpu, 4 as feature_memory_gib, 8 as predict_cpu, 32 as predict_memory_gib,
  cast(case when n_chars <= 750 then 16 else round((9.0 + 0.009 * n_chars + 0.000006 * n_chars * n_chars) * 1.1) end as int) as esm_memory_gib,
  n_chars <= 750 as esm_gpu
from documents""")
def q_resource_tier(spark, sf):
    register_tables(spark, sf)
    d = spark.table("documents")
    af, esm = ST.resource_tier("n_chars"), ST.resource_tier("n_chars", "esmfold")
    return d.select("doc_id", "n_chars", *[af[c].alias(c) for c in (*ST.TIERS, *ST.FIXED_TIERS)],
                    esm["memory_gib"].alias("esm_memory_gib"), esm["gpu"].alias("esm_gpu"))


FASTA_SQL = """fa as (select species as file, row_no as ord, concat(upper(substr(md5(seq), 1, 4)), '_', cast(chain as varchar), '.x') as id,
  replace(seq, '-', '') as seq from f7_msa)"""


@register("fasta_validate", with_views(f""", {FASTA_SQL},
k as (select *, row_number() over (partition by file order by ord) as r from fa),
g as (select file, sum(length(seq)) as seq_length, count(*) as seq_count, arg_max(id, ord) as last from k where r <= 2 group by file)
select file, regexp_extract(last, '^[0-9a-zA-Z]*', 0) as id, seq_length, seq_count, seq_length <= 60 as ok from g""", "f7_msa"))
def q_fasta_validate(spark, sf):
    m = fixture(spark, sf, "f7_msa")
    fa = m.select(F.col("species").alias("file"), F.col("row_no").alias("ord"),
                  F.concat(F.upper(F.substring(F.md5("seq"), 1, 4)), F.lit("_"), F.col("chain").cast("string"),
                           F.lit(".x")).alias("id"), F.regexp_replace("seq", "-", "").alias("seq"))
    ok, bad = ST.validate_fasta(fa, max_seq=2, max_len=60)
    cols = ["file", "id", F.col("seq_length").cast("long").alias("seq_length"), "seq_count"]
    return ok.select(*cols, F.lit(True).alias("ok")).unionByName(bad.select(*cols, F.lit(False).alias("ok")))


CHAINS_SQL = """ch as (select row_no as chain_id, species,
  case when row_no % 13 = 0 then concat(repeat('A', 40), replace(seq, '-', '')) else replace(seq, '-', '') end as seq,
  case when row_no % 5 = 0 then null else (row_no % 12) * 1.0 end as resolution from f7_msa)"""


def _chains(spark, sf):
    m = fixture(spark, sf, "f7_msa")
    seq = F.regexp_replace("seq", "-", "")
    return m.select(F.col("row_no").alias("chain_id"), "species",
                    F.when(F.col("row_no") % 13 == 0, F.concat(F.repeat(F.lit("A"), 40), seq)).otherwise(seq).alias("seq"),
                    F.when(F.col("row_no") % 5 == 0, F.lit(None)).otherwise((F.col("row_no") % 12) * 1.0).alias("resolution"))


@register("chain_filter", with_views(f""", {CHAINS_SQL},
e as (select chain_id, unnest(string_split(seq, '')) as aa from ch),
top as (select chain_id, max(n) as top from (select chain_id, aa, count(*) as n from e group by 1, 2) group by chain_id)
select ch.chain_id, coalesce((ch.resolution is null or ch.resolution <= 9.0) and top.top / length(ch.seq) <= 0.8, false) as passed
from ch left join top on top.chain_id = ch.chain_id""", "f7_msa"))
def q_chain_filter(spark, sf):
    return ST.chain_filter(_chains(spark, sf)).select("chain_id", "passed")


def _uniform_sql(seed, *parts):
    return (f"cast(('0x' || substr(md5(concat_ws(':', '{seed}', {', '.join(parts)})), 1, 8)) as bigint) / 4294967296.0")


@register("weighted_sample", with_views(f""", {CHAINS_SQL},
cs as (select species, count(*) as cluster_size from ch group by species),
p as (select ch.chain_id, (1.0 / cs.cluster_size) * (greatest(least(length(ch.seq) * 16, 512), 256) / 512.0) as p
      from ch join cs on cs.species = ch.species)
select chain_id, round(p, 6) as p, {_uniform_sql(11, 'cast(chain_id as varchar)')} < p as kept from p""", "f7_msa"))
def q_weighted_sample(spark, sf):
    r = ST.sample_chains(_chains(spark, sf), 11, cluster="species", length=F.length("seq") * 16)
    return r.select("chain_id", F.round("p", 6).alias("p"), "kept")


@register("mixture_sample", with_views(f""",
d as (select unnest(range((select count(*) from f7_msa))) as draw),
u as (select draw, {_uniform_sql(5, "'draw'", 'cast(draw as varchar)')} as u from d),
dd as (select draw, case when u < 0.5 then 0 when u < 0.8 then 1 else 2 end as dataset from u),
dj as (select *, row_number() over (partition by dataset order by draw) as j from dd),
el as (select chain as dataset, row_no as chain_id,
         row_number() over (partition by chain order by {_uniform_sql(5, 'cast(chain as varchar)', 'cast(row_no as varchar)')}, row_no) as pos,
         count(*) over (partition by chain) as size from f7_msa)
select dj.draw, cast(dj.dataset as int) as dataset, el.chain_id
from dj join el on el.dataset = dj.dataset and el.pos = ((dj.j - 1) % el.size) + 1""", "f7_msa"))
def q_mixture_sample(spark, sf):
    m = fixture(spark, sf, "f7_msa").select("chain", F.col("row_no").alias("chain_id"))
    parts = [m.filter(F.col("chain") == i).select("chain_id") for i in range(3)]
    n = m.count()  # epoch length = number of chains (a scalar)
    return ST.mix(parts, [0.5, 0.3, 0.2], n, seed=5).select(F.col("draw").cast("long").alias("draw"), "dataset",
                                                              "chain_id")


@register("entity_ids", with_views("""
, c as (select species as complex, row_no as ord, substr(seq, 1, 2) as seq from f7_msa),
f as (select complex, seq, min(ord) as first from c group by 1, 2),
e as (select complex, seq, row_number() over (partition by complex order by first) as entity_id from f),
s as (select c.complex, c.ord, e.entity_id, row_number() over (partition by c.complex, e.entity_id order by c.ord) as sym_id
      from c join e on e.complex = c.complex and e.seq = c.seq),
a as (select *, row_number() over (partition by complex order by entity_id, sym_id) as asym_id from s)
select complex, ord, entity_id, sym_id, asym_id,
  chr(cast(65 + (entity_id - 1) % 26 as int)) ||
  case when (entity_id - 1) // 26 - 1 >= 0 then chr(cast(65 + ((entity_id - 1) // 26 - 1) % 26 as int)) else '' end ||
  case when ((entity_id - 1) // 26 - 1) // 26 - 1 >= 0 then chr(cast(65 + (((entity_id - 1) // 26 - 1) // 26 - 1) % 26 as int)) else '' end
  || '_' || cast(sym_id as varchar) as label
from a""", "f7_msa"))
def q_entity_ids(spark, sf):
    m = fixture(spark, sf, "f7_msa").select(F.col("species").alias("complex"), F.col("row_no").alias("ord"),
                                            F.substring("seq", 1, 2).alias("seq"))
    return ST.entity_ids(m).select("complex", "ord", "entity_id", "sym_id", "asym_id", "label")


# --------------------------------------------------------------------------- templates

HITS_VIEW = """
select concat('Q', cast(o_custkey % 50 as string)) as query_id, o_orderkey as hit_idx,
  lower(substr(md5(cast(o_orderkey as string)), 1, 12)) as pdb_id,
  cast(floor(o_totalprice) as bigint) % 40 as aligned_cols,
  translate(md5(concat('Q', cast(o_custkey % 50 as string))), '0123456789abcdef', 'ARNDCQEGHILKMFPS') as query_sequence,
  case when o_orderkey % 7 = 0 then substr(translate(md5(concat('Q', cast(o_custkey % 50 as string))), '0123456789abcdef', 'ARNDCQEGHILKMFPS'), 2, 31)
       when o_orderkey % 11 = 0 then substr(translate(md5(cast(o_orderkey as string)), '0123456789abcdef', 'ARNDCQEGHILKM-FP'), 1, 12)
       else translate(md5(cast(o_orderkey as string)), '0123456789abcdef', 'ARNDCQEGHILKM-FP') end as hit_sequence,
  o_totalprice / 1000.0 as sum_probs
from orders
"""
DATES_VIEW = """
select lower(substr(md5(cast(o_orderkey as string)), 1, 12)) as pdb_id, min(o_orderdate) as release_date from orders group by 1
"""
OBSOLETE_VIEW = """
select lower(substr(md5(cast(p_partkey * 7 as string)), 1, 12)) as from_id,
  case when p_partkey % 5 = 0 then null else lower(substr(md5(cast(p_partkey * 7 + 1 as string)), 1, 12)) end as to_id
from part
"""

PREFILTER_SQL = f"""with hits as ({HITS_VIEW.strip()}), dates as ({DATES_VIEW.strip()}), obs as ({OBSOLETE_VIEW.strip()}),
h as (select hits.*, coalesce(obs.to_id, hits.pdb_id) as pdb_code, obs.from_id is not null and obs.to_id is null as dead
      from hits left join obs on obs.from_id = hits.pdb_id),
hd as (select h.*, dates.release_date from h left join dates on dates.pdb_id = h.pdb_code),
r as (select *, case
    when dead then 'obsolete'
    when release_date > timestamp '1995-06-01 00:00:00' then 'date'
    when aligned_cols / length(query_sequence) <= 0.1 then 'align_ratio'
    when contains(query_sequence, replace(hit_sequence, '-', '')) and length(replace(hit_sequence, '-', '')) / length(query_sequence) > 0.95 then 'duplicate'
    when length(replace(hit_sequence, '-', '')) < 10 then 'length' end as reason from hd)"""


def _prefiltered(spark, sf):
    register_tables(spark, sf)
    hits, dates, obs = spark.sql(HITS_VIEW), spark.sql(DATES_VIEW), spark.sql(OBSOLETE_VIEW)
    return ST.prefilter(hits, dates, obs, "1995-06-01 00:00:00")


@register("template_prefilter", PREFILTER_SQL + "\nselect query_id, hit_idx, pdb_code, reason from r")
def q_prefilter(spark, sf):
    return _prefiltered(spark, sf).select("query_id", "hit_idx", "pdb_code", "reason")


@register("template_topk", PREFILTER_SQL + """,
ok as (select * from r where reason is null),
d as (select * from ok where hit_idx in (select min(hit_idx) from ok group by query_id, hit_sequence)),
a as (select query_id, hit_idx, false as distinct_seq, row_number() over (partition by query_id order by sum_probs desc, hit_idx) as rk from ok),
b as (select query_id, hit_idx, true as distinct_seq, row_number() over (partition by query_id order by sum_probs desc, hit_idx) as rk from d)
select query_id, hit_idx, distinct_seq from a where rk <= 4 union all select query_id, hit_idx, distinct_seq from b where rk <= 4""")
def q_topk(spark, sf):
    ok = _prefiltered(spark, sf).filter(F.col("reason").isNull())
    a = ST.top_templates(ok, 4).select("query_id", "hit_idx", F.lit(False).alias("distinct_seq"))
    b = ST.top_templates(ok, 4, distinct_seq=True).select("query_id", "hit_idx", F.lit(True).alias("distinct_seq"))
    return a.unionByName(b)


# --------------------------------------------------------------------------- batching


@register("token_batches", """with recursive d as (
  select doc_id as idx, n_chars::bigint as length, n_chars + 2 as size, row_number() over (order by n_chars, doc_id) as k from documents),
walk(k, n, batch) as (
  select 0::bigint, 0::bigint, -1::bigint
  union all
  select d.k, case when w.batch < 0 or d.size * (w.n + 1) > 50000 then 1 else w.n + 1 end,
    case when w.batch < 0 or d.size * (w.n + 1) > 50000 then w.batch + 1 else w.batch end
  from walk w join d on d.k = w.k + 1)
select d.idx, d.length, w.batch from walk w join d on d.k = w.k""")
def q_token_batches(spark, sf):
    register_tables(spark, sf)
    d = spark.table("documents").select(F.col("doc_id").alias("idx"), F.col("n_chars").cast("long").alias("length"))
    return ST.pack_tokens(d, budget=50000, extra=2).select("idx", "length", "batch")


# --------------------------------------------------------------------------- embeddings / confidence


@register("mean_pool", with_views("""
, r as (select *, row_number() over (partition by seq_id order by tok) as rk from f10_tokens),
e as (select seq_id, unnest(range(0, len(embedding))) as dim, unnest(embedding) as v from r where rk <= 5)
select seq_id, cast(dim as int) as dim, round(avg(cast(v as double)), 6) + 0.0 as mean from e group by 1, 2""", "f10_tokens"))
def q_mean_pool(spark, sf):
    r = ST.mean_pool(fixture(spark, sf, "f10_tokens"), 5)
    return r.select("seq_id", "dim", F.round("mean", 6).alias("mean"))


_SOFTMAX_SQL = """list_transform(embedding::double[], lambda x: exp(x - list_max(embedding::double[])))"""


@register("plddt", f"""select vec_id,
  round(list_sum(list_transform(range(1, len(embedding) + 1), lambda i: {_SOFTMAX_SQL}[i] * ((i - 0.5) / len(embedding))))
        / list_sum({_SOFTMAX_SQL}) * 100.0, 6) as plddt
from embeddings""")
def q_plddt(spark, sf):
    register_tables(spark, sf)
    return ST.with_plddt(spark.table("embeddings"), "embedding").select("vec_id", F.round("plddt", 6).alias("plddt"))


BREAKS = [i * 0.5 for i in range(63)]  # 63 edges from 0 to 31 A (64 bins)
CENTERS = ST.bin_centers(BREAKS)
PAIRS_VIEW = """select cast(vec_id / 100 as bigint) as structure, cast((vec_id % 100) / 10 as bigint) as i, vec_id % 10 as j,
  cast((vec_id % 100) / 50 as bigint) as chain_i, cast((vec_id % 10) / 5 as bigint) as chain_j, embedding as logits from embeddings"""


def _pairs_sql():
    centers = "[" + ", ".join(repr(float(c)) for c in CENTERS) + "]"
    return f"""with pr as (select vec_id // 100 as structure, (vec_id % 100) // 10 as i, vec_id % 10 as j,
    (vec_id % 100) // 50 as chain_i, (vec_id % 10) // 5 as chain_j, embedding::double[] as lg from embeddings),
p as (select *, list_transform(lg, lambda x: exp(x - list_max(lg))) as ex from pr),
p2 as (select *, list_transform(ex, lambda x: x / list_sum(ex)) as pb from p),
n as (select structure, count(distinct i) as n from p2 group by structure),
p3 as (select p2.*, n.n, 1.24 * pow(greatest(n.n, 19) - 15, 1.0 / 3) - 1.8 as d0,
         list_sum(list_transform(range(1, 65), lambda k: pb[k] * {centers}[k])) as pae from p2 join n on n.structure = p2.structure),
p4 as (select *, list_sum(list_transform(range(1, 65), lambda k: pb[k] * (1.0 / (1 + {centers}[k] * {centers}[k] / (d0 * d0))))) as tm from p3),
per_i as (select structure, i, sum(tm) / (1e-8 + count(*)) as a,
            sum(case when chain_i <> chain_j then tm else 0.0 end) / (1e-8 + sum(case when chain_i <> chain_j then 1 else 0 end)) as ai
          from p4 group by 1, 2),
sc as (select structure, max(a) as ptm, max(ai) as iptm from per_i group by structure),
er as (select structure, avg(pae) as mean_pae, max(pae) as max_pae from p4 group by structure)
select sc.structure, round(ptm, 6) as ptm, round(iptm, 6) as iptm, round(mean_pae, 6) as mean_pae, round(max_pae, 6) as max_pae
from sc join er on er.structure = sc.structure"""


@register("pae_ptm", _pairs_sql())
def q_pae_ptm(spark, sf):
    register_tables(spark, sf)
    p = spark.sql(PAIRS_VIEW)
    r = ST.pae_ptm(p, BREAKS, chain_i="chain_i", chain_j="chain_j")
    return r.select("structure", *[F.round(c, 6).alias(c) for c in ("ptm", "iptm", "mean_pae", "max_pae")])


COORDS_SQL = """co as (select seq_id as structure, tok as residue,
  embedding[1] * 10.0 as px, embedding[2] * 10.0 as py, embedding[3] * 10.0 as pz,
  embedding[4] * 10.0 as rx, embedding[5] * 10.0 as ry, embedding[6] * 10.0 as rz from f10_tokens)"""


def _coords(spark, sf):
    t = fixture(spark, sf, "f10_tokens")
    e = F.col("embedding")
    base = t.select(F.col("seq_id").alias("structure"), F.col("tok").alias("residue"),
                    *[(e[k].cast("double") * 10.0).alias(n) for k, n in enumerate(["px", "py", "pz", "rx", "ry", "rz"])])
    pred = base.select("structure", "residue", F.col("px").alias("x"), F.col("py").alias("y"), F.col("pz").alias("z"))
    ref = base.select("structure", "residue", F.col("rx").alias("x"), F.col("ry").alias("y"), F.col("rz").alias("z"))
    return pred, ref


@register("gdt_scores", with_views(f""", {COORDS_SQL},
d as (select structure, sqrt(pow(px - rx, 2) + pow(py - ry, 2) + pow(pz - rz, 2)) as d from co)
select structure,
  round((avg((d <= 1.0)::int) + avg((d <= 2.0)::int) + avg((d <= 4.0)::int) + avg((d <= 8.0)::int)) / 4, 6) as gdt_ts,
  round((avg((d <= 0.5)::int) + avg((d <= 1.0)::int) + avg((d <= 2.0)::int) + avg((d <= 4.0)::int)) / 4, 6) as gdt_ha
from d group by structure""", "f10_tokens"))
def q_gdt(spark, sf):
    pred, ref = _coords(spark, sf)
    ts = ST.gdt(pred, ref, [1.0, 2.0, 4.0, 8.0]).withColumnRenamed("gdt", "gdt_ts")
    ha = ST.gdt(pred, ref, [0.5, 1.0, 2.0, 4.0]).withColumnRenamed("gdt", "gdt_ha")
    return ts.join(ha, "structure").select("structure", F.round("gdt_ts", 6).alias("gdt_ts"),
                                           F.round("gdt_ha", 6).alias("gdt_ha"))


@register("drmsd", with_views(f""", {COORDS_SQL}
select a.structure,
  round(sqrt(sum(pow(sqrt(pow(a.px - b.px, 2) + pow(a.py - b.py, 2) + pow(a.pz - b.pz, 2))
                   - sqrt(pow(a.rx - b.rx, 2) + pow(a.ry - b.ry, 2) + pow(a.rz - b.rz, 2)), 2))
             / (count(distinct a.residue) * (count(distinct a.residue) - 1))), 4) as drmsd
from co a join co b on a.structure = b.structure group by a.structure""", "f10_tokens"))
def q_drmsd(spark, sf):
    pred, ref = _coords(spark, sf)
    return ST.drmsd(pred, ref).select("structure", F.round("drmsd", 4).alias("drmsd"))
