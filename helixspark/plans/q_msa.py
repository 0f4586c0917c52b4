"""Registered MSA queries over the f7_msa view (three chains of 32-column aligned rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixspark.functions import sequence as S
from helixspark.operators import msa as M
from helixspark.plans.fixtures import fixture, register_tables, with_views
from helixspark.plans.registry import register

ROWS = """m as (select *, row_number() over (partition by chain order by row_no) - 1 as msa_row from f7_msa),
q as (select chain, seq as query from m where msa_row = 0),
mq as (select m.*, q.query from m join q on q.chain = m.chain),
sm as (select *, list_sum(list_transform(range(1, length(query) + 1), lambda i: (substr(seq, i, 1) = substr(query, i, 1))::int)) / length(query) as similarity,
         (length(seq) - length(replace(seq, '-', ''))) / length(query) as gap from mq)"""


def sql(body: str) -> str:
    return with_views(f", {ROWS}\n{body}", "f7_msa")


def rows(spark, sf):
    return M.with_msa_row(fixture(spark, sf, "f7_msa"))


@register("msa_summary", sql("select chain, row_no, msa_row, round(similarity, 6) as similarity, round(gap, 6) as gap from sm"))
def q_msa_summary(spark, sf):
    s = M.msa_summary(rows(spark, sf))
    return s.select("chain", "row_no", "msa_row", F.round("similarity", 6).alias("similarity"), F.round("gap", 6).alias("gap"))


@register("common_species", sql("""select species, count(distinct chain) as n_chains from m
where msa_row > 0 and species <> '' group by species having count(distinct chain) >= 2"""))
def q_common_species(spark, sf):
    return M.common_species(rows(spark, sf))


PAIRS_SQL = """,
s as (select * from sm where msa_row > 0 and species <> ''),
rk as (select *, row_number() over (partition by chain, species order by similarity desc, msa_row) as r from s),
pcs as (select chain, species, count(*) as cnt from rk group by 1, 2),
ps as (select species, count(*) as n_chains, min(cnt) as k, max(cnt) as mx from pcs group by species having count(*) >= 2 and max(cnt) <= 600),
kept as (select rk.species, rk.r, rk.chain, rk.msa_row, ps.n_chains from rk join ps on ps.species = rk.species where rk.r <= ps.k),
chains as (select distinct chain from m),
pairs as (select distinct species, r, n_chains from kept),
full_ as (select p.species, p.r, p.n_chains, c.chain, coalesce(k.msa_row, -1) as msa_row
          from pairs p cross join chains c left join kept k on k.species = p.species and k.r = p.r and k.chain = c.chain),
keys as (select species, r, n_chains, abs(product(msa_row)) as prod from full_ group by 1, 2, 3),
ord as (select species, r, row_number() over (order by n_chains desc, prod, species, r) as pair_idx from keys),
paired as (select cast(0 as bigint) as pair_idx, chain, cast(0 as bigint) as msa_row from chains
           union all select o.pair_idx, f.chain, f.msa_row from full_ f join ord o on o.species = f.species and o.r = f.r)"""


@register("species_pairs", sql(PAIRS_SQL + "\nselect pair_idx, chain, msa_row from paired"))
def q_species_pairs(spark, sf):
    return M.pair_species(rows(spark, sf))


@register("msa_union_dedup", with_views("""
select seq, arg_min(chain, chain * 100000000 + row_no) as chain, arg_min(row_no, chain * 100000000 + row_no) as row_no,
  arg_min(species, chain * 100000000 + row_no) as species from f7_msa group by seq""", "f7_msa"))
def q_union_dedup(spark, sf):
    f = fixture(spark, sf, "f7_msa")
    parts = [f.filter(F.col("chain") == c) for c in (0, 1, 2)]
    return M.union_msas(parts).select("seq", "chain", "row_no", "species")


@register("sto_dedup", sql(""", mk as (select chain, row_no, msa_row,
    array_to_string(list_filter(string_split(seq, ''), lambda c, i: substr(query, i, 1) <> '-'), '') as masked from mq)
select chain, row_no from (select *, min(msa_row) over (partition by chain, masked) as f from mk) where msa_row = f"""))
def q_sto_dedup(spark, sf):
    return M.dedup_msa(rows(spark, sf)).select("chain", "row_no")


@register("sto_truncate", sql(""", fs as (select chain, species, min(msa_row) as f from m group by 1, 2),
keep as (select chain, species from (select *, row_number() over (partition by chain order by f, species) as nr from fs) where nr <= 5)
select m.chain, m.row_no from m join keep on keep.chain = m.chain and keep.species = m.species"""))
def q_sto_truncate(spark, sf):
    return M.truncate_msa(rows(spark, sf), 5, name="species").select("chain", "row_no")


@register("msa_profile", with_views("""
, e as (select chain, unnest(range(0, length(seq))) as pos, unnest(string_split(seq, '')) as res from f7_msa),
n as (select chain, count(*) as n from f7_msa group by chain)
select e.chain, e.pos, case when strpos('ARNDCQEGHILKMFPSTWYVX-', e.res) > 0 then e.res else 'X' end as res,
  round(count(*) / min(n.n), 6) as freq
from e join n on n.chain = e.chain group by 1, 2, 3""", "f7_msa"))
def q_msa_profile(spark, sf):
    p = M.msa_profile(fixture(spark, sf, "f7_msa"))
    return p.select("chain", F.col("pos").cast("long").alias("pos"), "res", F.round("freq", 6).alias("freq"))


A3M_SQL = "a3m as (select chain, row_no, concat(substr(seq, 1, 4), lower(substr(seq, 5, 3)), substr(seq, 8)) as seq from f7_msa)"


@register("a3m_rows", with_views(f""", {A3M_SQL}
select chain, row_no, regexp_replace(seq, '[a-z]', '', 'g') as seq,
  array_to_string(list_transform(regexp_extract_all(seq, '([a-z]*)([^a-z])', 1), lambda s: length(s)), ',') as deletions
from a3m""", "f7_msa"))
def q_a3m(spark, sf):
    f = fixture(spark, sf, "f7_msa").select(
        "chain", "row_no", F.concat(F.substring("seq", 1, 4), F.lower(F.substring("seq", 5, 3)), F.expr("substring(seq, 8)")).alias("seq"))
    r = M.a3m_rows(f)
    return r.select("chain", "row_no", "seq", F.array_join("deletions", ",").alias("deletions"))


@register("sto_project", sql("""
, z as (select chain, row_no, seq, query, range(1, length(query) + 1) as idx from mq)
select chain, row_no,
  array_to_string(list_filter(string_split(seq, ''), lambda c, i: substr(query, i, 1) <> '-'), '') as seq,
  array_to_string(list_transform(list_filter(idx, lambda i: substr(query, i, 1) <> '-'),
    lambda i: length(regexp_replace(regexp_extract(substr(seq, 1, i - 1), '([A-Za-z-]*?)([A-Za-z-]{' || cast(
      length(regexp_extract(substr(query, 1, i - 1), '-*$', 0)) as varchar) || '})$', 2), '-', '', 'g'))), ',') as deletions
from z"""))
def q_sto_project(spark, sf):
    r = M.project_to_query(rows(spark, sf))
    return r.select("chain", "row_no", "seq", F.array_join("deletions", ",").alias("deletions"))


@register("sto_to_a3m", sql("""
select chain, row_no, array_to_string(list_transform(string_split(seq, ''), lambda c, i:
  case when substr(query, i, 1) <> '-' then c when c in ('-', '.') then '' else lower(c) end), '') as a3m
from mq"""))
def q_sto_to_a3m(spark, sf):
    return M.sto_to_a3m(rows(spark, sf)).select("chain", "row_no", "a3m")


GAPPED_SQL = "g as (select chain, row_no, concat(substr(seq, 1, 10), '--', substr(seq, 11)) as seq from f7_msa)"


@register("empty_cols", with_views(f""", {GAPPED_SQL},
e as (select chain, unnest(range(1, length(seq) + 1)) as pos, unnest(string_split(seq, '')) as c from g),
k as (select chain, pos from e group by chain, pos having bool_or(c <> '-'))
select g.chain, g.row_no, string_agg(substr(g.seq, k.pos, 1), '' order by k.pos) as seq
from g join k on k.chain = g.chain group by g.chain, g.row_no""", "f7_msa"))
def q_empty_cols(spark, sf):
    f = fixture(spark, sf, "f7_msa").select(
        "chain", "row_no", F.concat(F.substring("seq", 1, 10), F.lit("--"), F.expr("substring(seq, 11)")).alias("seq"))
    return M.drop_empty_columns(f).select("chain", "row_no", "seq")


@register("unpaired_anti", with_views("""
select u.chain, u.row_no from f7_msa u
where not exists (select 1 from f7_msa p where p.species = 'SP1' and p.chain = u.chain and p.seq = u.seq)""", "f7_msa"))
def q_unpaired_anti(spark, sf):
    f = fixture(spark, sf, "f7_msa")
    return M.unpaired_without_paired(f, f.filter(F.col("species") == "SP1")).select("chain", "row_no")


@register("msa_crop", sql(PAIRS_SQL + """,
p as (select * from paired where pair_idx < 50),
used as (select chain, count(*) as used from p where msa_row <> -1 group by chain)
select 'paired' as kind, pair_idx as idx, chain, msa_row from p
union all
select 'unpaired', m.msa_row, m.chain, m.msa_row from m left join used on used.chain = m.chain
where m.msa_row < 300 - coalesce(used.used, 0)"""))
def q_msa_crop(spark, sf):
    r = rows(spark, sf)
    pairs = M.pair_species(r)
    p, u = M.crop_msa(pairs, r.withColumn("unpaired_idx", F.col("msa_row")), size=300, max_paired=50)
    return p.select(F.lit("paired").alias("kind"), F.col("pair_idx").alias("idx"), "chain", "msa_row").unionByName(
        u.select(F.lit("unpaired").alias("kind"), F.col("msa_row").alias("idx"), "chain", "msa_row"))


SAMPLE_SQL = """,
h as (select *, row_number() over (partition by chain order by msa_row <> 0, md5(concat_ws(':', '7', cast(chain as varchar), cast(msa_row as varchar)))) as k from m)"""


def _sample(spark, sf):
    return M.sample_msa(rows(spark, sf), 100, seed=7)


@register("msa_sample", sql(SAMPLE_SQL + "\nselect chain, row_no, msa_row, k <= 100 as kept from h"))
def q_msa_sample(spark, sf):
    kept, extra = _sample(spark, sf)
    return kept.select("chain", "row_no", "msa_row", F.lit(True).alias("kept")).unionByName(
        extra.select("chain", "row_no", "msa_row", F.lit(False).alias("kept")))


CENTER_SQL = SAMPLE_SQL + """,
ex as (select chain, msa_row as extra_row, unnest(range(1, length(seq) + 1)) as pos, unnest(string_split(seq, '')) as res from h where k > 100),
ce as (select chain, msa_row as center_row, unnest(range(1, length(seq) + 1)) as pos, unnest(string_split(seq, '')) as res from h where k <= 100),
sc as (select ex.chain, ex.extra_row, ce.center_row, cast(count(*) as double) as score
       from ex join ce on ce.chain = ex.chain and ce.pos = ex.pos and ce.res = ex.res and ex.res <> '-' group by 1, 2, 3),
best as (select chain, extra_row, arg_max(center_row, score * 1000000 - center_row) as center_row, max(score) as score from sc group by 1, 2),
c0 as (select chain, min(msa_row) as c0 from h where k <= 100 group by chain),
asg as (select h.chain, h.msa_row as extra_row, coalesce(b.center_row, c0.c0) as center_row, coalesce(b.score, cast(0 as double)) as score
        from h left join best b on b.chain = h.chain and b.extra_row = h.msa_row join c0 on c0.chain = h.chain where h.k > 100)"""


@register("nearest_center", sql(CENTER_SQL + "\nselect chain, extra_row, center_row, score from asg"))
def q_nearest_center(spark, sf):
    kept, extra = _sample(spark, sf)
    return M.assign_centers(extra, kept).select("chain", "extra_row", "center_row", "score")


#: Deletion counts for the rows of the alignments, which have none of their own.
DELETIONS = "transform(sequence(0, length(seq) - 1), i -> (row_no + i * 3) % 4)"


@register("cluster_profile", sql(CENTER_SQL + """,
allr as (select a.chain, a.center_row, h.seq, h.row_no from asg a join h on h.chain = a.chain and h.msa_row = a.extra_row
         union all select chain, msa_row, seq, row_no from h where k <= 100),
n as (select chain, center_row, count(*) as n from allr group by 1, 2),
e as (select chain, center_row, row_no, unnest(range(0, length(seq))) as pos, unnest(string_split(seq, '')) as res from allr),
d as (select chain, center_row, pos, sum((row_no + pos * 3) % 4) as s from e group by 1, 2, 3)
select e.chain, e.center_row, e.pos, e.res, round(count(*) / (1e-6 + min(n.n)), 6) as share,
  round(min(d.s) / (1e-6 + min(n.n)), 6) as mean_deletions
from e join n on n.chain = e.chain and n.center_row = e.center_row
join d on d.chain = e.chain and d.center_row = e.center_row and d.pos = e.pos group by 1, 2, 3, 4"""))
def q_cluster_profile(spark, sf):
    kept, extra = (x.withColumn("deletions", F.expr(DELETIONS)) for x in _sample(spark, sf))
    a = M.assign_centers(extra, kept)
    shares, dels = M.cluster_profiles(a, extra, kept, deletions="deletions")
    p = shares.join(dels, ["chain", "center_row", "pos"])
    return p.select("chain", "center_row", F.col("pos").cast("long").alias("pos"), "res", F.round("share", 6).alias("share"),
                    F.round("mean_deletions", 6).alias("mean_deletions"))


DESC_SQL = """select doc_id, concat(case doc_id % 3 when 0 then 'tr' when 1 then 'sp' else 'xx' end, '|', upper(substr(md5(text), 1, 8)),
  case when doc_id % 4 = 0 then '_1' else '' end, '|', upper(substr(md5(text), 9, 4)), '_', upper(substr(md5(text), 13, 1 + cast(doc_id % 5 as int))),
  '/1-', cast(n_chars as string), ' ', lang) as description from documents"""


@register("species_id", f"""select doc_id, description,
  coalesce(regexp_extract(split_part(split_part(trim(description), ' ', 1), '/', 1),
    '^(?:tr|sp)\\|[A-Za-z0-9]{{6,10}}(?:_\\d)?\\|[A-Za-z0-9]+_([A-Za-z0-9]{{1,5}})(?:_\\d+)?$', 1), '') as species
from ({DESC_SQL}) d""")
def q_species_id(spark, sf):
    register_tables(spark, sf)
    d = spark.sql(DESC_SQL)
    return d.select("doc_id", "description", S.species_id("description").alias("species"))
