"""Multiple-sequence-alignment tables: one row per (chain, row) with the aligned text.

Table shape: ``chain, row_no, seq [, species, desc]``; the row order of a chain's
alignment is ``row_no`` and its first row is the query. Row indices inside a chain
(``msa_row``) are ranks computed with ``rank_within`` so a chain holding most of
the rows is still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixspark.functions import sequence as S
from helixspark.operators.common import rank_within
from helixspark.session import written_once


def with_msa_row(msa: DataFrame, chain: str = "chain", order: str = "row_no") -> DataFrame:
    """0-based row index inside each chain's alignment (0 = query)."""
    return rank_within(msa, [chain], [order], "_r").withColumn("msa_row", F.col("_r") - 1).drop("_r")


def queries(msa_rows: DataFrame, chain: str = "chain") -> DataFrame:
    """(chain, query): the first row of each alignment; one row per chain."""
    return msa_rows.filter(F.col("msa_row") == 0).select(chain, F.col("seq").alias("query"))


def with_query(msa_rows: DataFrame, chain: str = "chain") -> DataFrame:
    return msa_rows.join(queries(msa_rows, chain), chain)


def msa_summary(msa_rows: DataFrame) -> DataFrame:
    """Per row: identity to its chain's query and share of gap columns."""
    q = with_query(msa_rows)
    return q.withColumn("similarity", S.identity_to("seq", "query")).withColumn(
        "gap", S.gap_share("seq", F.length("query"))).drop("query")


def common_species(msa_rows: DataFrame, chain: str = "chain") -> DataFrame:
    """Species found in at least two chains (query rows and empty species excluded)."""
    s = msa_rows.filter((F.col("msa_row") > 0) & (F.col("species") != ""))
    g = s.groupBy("species").agg(F.count_distinct(chain).alias("n_chains"))
    return g.filter(F.col("n_chains") >= 2)


def crowded_species(msa_rows: DataFrame, max_rows: int = 600, chain: str = "chain") -> DataFrame:
    """(species, rows): the species that ``pair_species`` leaves out because a chain holds more than
    ``max_rows`` of their rows, with the largest number of rows in one chain."""
    per = msa_rows.filter((F.col("msa_row") > 0) & (F.col("species") != "")).groupBy("species", chain).agg(F.count("*").alias("_c"))
    return per.groupBy("species").agg(F.max("_c").alias("rows")).filter(F.col("rows") > max_rows)


def pair_species(msa_rows: DataFrame, max_rows: int = 600, chain: str = "chain") -> DataFrame:
    """Cross-chain pairing of alignment rows of the same species.

    Per species present in >= 2 chains and with no chain holding more than
    ``max_rows`` of its rows: each chain's rows are ranked by identity to the query
    (ties: lower row first) and the first ``k = min count`` are paired rank by rank;
    a chain without the species contributes row -1. Pairs are ordered by number of
    chains present (desc), then |product of row indices|; the query pair (all 0)
    comes first. Output: (pair_idx, chain, msa_row).
    """
    s = msa_summary(msa_rows).filter((F.col("msa_row") > 0) & (F.col("species") != ""))
    ranked = rank_within(s, [chain, "species"], [F.col("similarity").desc(), F.col("msa_row")], "r")
    per_cs = ranked.groupBy(chain, "species").agg(F.count("*").alias("cnt"))
    per_s = per_cs.groupBy("species").agg(
        F.count("*").alias("n_chains"), F.min("cnt").alias("k"), F.max("cnt").alias("mx"))
    per_s = per_s.filter((F.col("n_chains") >= 2) & (F.col("mx") <= max_rows))
    kept = ranked.join(per_s, "species").filter(F.col("r") <= F.col("k")).select(
        "species", "r", chain, "msa_row", "n_chains")
    chains = sorted(r[0] for r in msa_rows.select(chain).distinct().collect())  # a handful of chain ids
    pairs = kept.select("species", "r", "n_chains").distinct().withColumn(
        chain, F.explode(F.array(*[F.lit(c) for c in chains])))
    full = pairs.join(kept.drop("n_chains"), ["species", "r", chain], "left").withColumn(
        "msa_row", F.coalesce(F.col("msa_row"), F.lit(-1)))
    keys = full.groupBy("species", "r", "n_chains").agg(F.abs(F.product(F.col("msa_row"))).alias("prod"))
    order = rank_within(keys, [], [F.col("n_chains").desc(), F.col("prod"), F.col("species"), F.col("r")], "pair_idx")
    out = full.join(order.select("species", "r", "pair_idx"), ["species", "r"]).select("pair_idx", chain, "msa_row")
    query_pair = msa_rows.select(chain).distinct().select(F.lit(0).cast("long").alias("pair_idx"), chain,
                                                          F.lit(0).cast("long").alias("msa_row"))
    return query_pair.unionByName(out.withColumn("msa_row", F.col("msa_row").cast("long")))


def union_msas(msas: list[DataFrame], key: str = "seq") -> DataFrame:
    """MSAs in priority order; only the first copy of a sequence stays (grouped
    ``min_by`` with map-side partial aggregation, so a very common sequence is
    combined before the shuffle)."""
    u = None
    for i, m in enumerate(msas):
        m = m.withColumn("_prio", F.lit(i))
        u = m if u is None else u.unionByName(m)
    cols = [c for c in u.columns if c != key]
    g = u.groupBy(key).agg(F.min_by(F.struct(*cols), F.struct("_prio", "row_no")).alias("_f"))
    return g.select(key, "_f.*").drop("_prio")


def dedup_msa(msa_rows: DataFrame, chain: str = "chain") -> DataFrame:
    """Drop rows equal to an earlier row once the query's gap columns are removed."""
    q = with_query(msa_rows).withColumn("masked", S.masked("seq", S.query_mask("query")))
    first = q.groupBy(chain, "masked").agg(F.min("msa_row").alias("_first"))
    return q.join(first, [chain, "masked"]).filter(F.col("msa_row") == F.col("_first")).drop(
        "_first", "query", "masked")


def truncate_msa(msa_rows: DataFrame, n: int, name: str = "name", chain: str = "chain") -> DataFrame:
    """Rows whose name is among the first ``n`` distinct names of the alignment."""
    first = msa_rows.groupBy(chain, name).agg(F.min("msa_row").alias("_first"))
    ranked = rank_within(first, [chain], ["_first", name], "_nr").filter(F.col("_nr") <= n)
    return msa_rows.join(ranked.select(chain, name), [chain, name], "left_semi")


def msa_profile(msa_rows: DataFrame, chain: str = "chain") -> DataFrame:
    """Residue frequencies per column (22-letter alphabet; others count as X)."""
    n = msa_rows.groupBy(chain).agg(F.count("*").alias("_n"))
    e = msa_rows.select(chain, F.posexplode(S.chars("seq")).alias("pos", "res"))
    e = e.withColumn("res", F.when(F.instr(F.lit(S.RESIDUES), F.col("res")) > 0, F.col("res")).otherwise("X"))
    c = e.groupBy(chain, "pos", "res").agg(F.count("*").alias("_c"))
    return c.join(n, chain).select(chain, "pos", "res", (F.col("_c") / F.col("_n")).alias("freq"))


def a3m_rows(a3m: DataFrame, col: str = "seq") -> DataFrame:
    """A3M rows -> aligned sequence (insertions removed) and per-column deletion counts."""
    return a3m.withColumn("deletions", S.a3m_deletions(col)).withColumn(col, S.a3m_aligned(col))


def project_to_query(msa_rows: DataFrame, chain: str = "chain") -> DataFrame:
    """Stockholm -> query columns only: columns where the query has a gap are dropped
    from every row; each kept column records how many residues were dropped
    right before it (deletion count)."""
    q = with_query(msa_rows).withColumn("_m", S.query_mask("query"))
    # one mark per kept column and one per residue of a dropped one: the runs between kept marks
    # are the deletions, the run after the last kept column belongs to none
    marks = F.array_join(F.zip_with(S.chars("seq"), F.col("_m"), lambda c, k: F.when(k, "|").when(c != "-", "x").otherwise("")), "")
    runs = F.transform(F.split(marks, r"\|"), lambda x: F.length(x))
    return q.withColumn("deletions", F.slice(runs, F.lit(1), F.size(runs) - 1)).withColumn("seq", S.masked("seq", "_m")).drop("_m", "query")


def sto_to_a3m(msa_rows: DataFrame, chain: str = "chain") -> DataFrame:
    """Stockholm rows -> A3M text: in query-gap columns residues become lower case
    and gaps are removed; other columns stay."""
    q = with_query(msa_rows)
    z = F.arrays_zip(S.chars("seq").alias("c"), S.query_mask("query").alias("k"))
    out = F.transform(z, lambda x: F.when(x["k"], x["c"]).when(x["c"].isin("-", "."), F.lit(""))
                      .otherwise(F.lower(x["c"])))
    return q.withColumn("a3m", F.array_join(out, "")).drop("query")


def drop_empty_columns(msa_rows: DataFrame, chain: str = "chain") -> DataFrame:
    """Remove columns that are a gap in every row of the chain's alignment.

    The keep-mask is one boolean per column (``bool_or`` over rows, partial
    aggregated), gathered per chain into an array as wide as the alignment.
    """
    e = msa_rows.select(chain, F.posexplode(S.chars("seq")).alias("pos", "c"))
    cols = e.groupBy(chain, "pos").agg(F.bool_or(F.col("c") != "-").alias("keep"))
    mask = cols.groupBy(chain).agg(F.sort_array(F.collect_list(F.struct("pos", "keep"))).alias("_m")).select(
        chain, F.col("_m.keep").alias("_mask"))
    return msa_rows.join(mask, chain).withColumn("seq", S.masked("seq", "_mask")).drop("_mask")


def unpaired_without_paired(unpaired: DataFrame, paired: DataFrame, chain: str = "chain") -> DataFrame:
    """Unpaired rows whose sequence already appears among the chain's paired rows are dropped."""
    return unpaired.join(paired.select(chain, "seq").distinct(), [chain, "seq"], "left_anti")


def crop_msa(paired: DataFrame, unpaired: DataFrame, size: int = 2048, max_paired: int = 1024,
             chain: str = "chain"):
    """Paired rows: first ``max_paired`` pairs. Unpaired rows per chain: as many as
    fit in ``size`` minus the chain's non-gap (row != -1) kept paired rows."""
    p = paired.filter(F.col("pair_idx") < max_paired)
    used = p.filter(F.col("msa_row") != -1).groupBy(chain).agg(F.count("*").alias("_used"))
    u = unpaired.join(used, chain, "left").fillna(0, ["_used"])
    u = u.filter(F.col("unpaired_idx") < F.lit(size) - F.col("_used")).drop("_used")
    return p, u


def sample_msa(msa_rows: DataFrame, n: int, seed: int = 0, chain: str = "chain"):
    """(kept, extra): the query plus a seeded random ``n - 1`` other rows per chain.

    The random order is ``md5(seed:chain:row)``, so it is repeatable and needs no
    driver-side shuffle; ranks come from ``rank_within``.
    """
    r = msa_rows.withColumn("_h", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(chain).cast("string"),
                                                       F.col("msa_row").cast("string"))))
    r = r.withColumn("_q", F.col("msa_row") != 0)
    ranked = rank_within(r, [chain], ["_q", "_h"], "_k")
    kept = ranked.filter(F.col("_k") <= n).drop("_h", "_q", "_k")
    extra = ranked.filter(F.col("_k") > n).drop("_h", "_q", "_k")
    return kept, extra


#: Rows of one block of an alignment: the blocks are multiplied with each other.
BLOCK_ROWS = 512


def _row_blocks(rows: DataFrame, chain: str, name: str) -> DataFrame:
    """(chain, ``name``): blocks of at most ``BLOCK_ROWS`` rows with their sequences. Rows are counted
    within their own side: centres drawn from all over an alignment still fill whole blocks."""
    placed = rank_within(rows.select(chain, "msa_row", "seq"), [chain], ["msa_row"], "_nth")
    block = F.floor((F.col("_nth") - 1) / BLOCK_ROWS)
    return placed.groupBy(chain, block.alias("_b")).agg(F.collect_list(F.struct("msa_row", "seq")).alias(name)).drop("_b")


def _letters(rows: list[dict], width: int) -> np.ndarray:
    """Code points of the sequences, a row each; shorter ones end in 0."""
    out = np.zeros((len(rows), width), np.uint32)
    for i, r in enumerate(rows):
        x = np.frombuffer((r["seq"] or "").encode("utf-32-le"), np.uint32)[:width]
        out[i, :len(x)] = x
    return out


def _best_of_blocks(gap_weight: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                extra, centers = b.column(1)[i].as_py(), sorted(b.column(2)[i].as_py(), key=lambda r: r["msa_row"])
                width = max(len(r["seq"] or "") for r in extra + centers)
                e, c = _letters(extra, width), _letters(centers, width)
                score = np.zeros((len(e), len(c)), np.float64)
                for x in np.intersect1d(e, c):
                    if x:
                        same = (e == x).astype(np.float32) @ (c == x).astype(np.float32).T
                        score += same * (gap_weight if x == ord("-") else 1.0)
                at = score.argmax(axis=1)  # the first of equals: the lowest centre row
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(b.column(0)[i], len(extra)), pa.array([r["msa_row"] for r in extra], pa.int64()),
                     pa.array([centers[j]["msa_row"] for j in at], pa.int64()), pa.array(score[np.arange(len(at)), at])],
                    names=[b.schema.names[0], "extra_row", "center_row", "score"])
    return run


def assign_centers(extra: DataFrame, centers: DataFrame, gap_weight: float = 0.0, chain: str = "chain") -> DataFrame:
    """Each extra row -> the cluster centre with the highest weighted agreement.

    Agreement counts columns with the same residue (weight 1, gap matches weight ``gap_weight``).
    Extra rows and centres of a chain are packed in blocks of at most 512 rows; every block of one
    side meets every block of the other, and their agreement is a few products of 0/1 matrices, one
    per residue. No row per column or per pair is made: a block pair gives one row per extra row,
    and the best of those is a grouped maximum. A chain that holds most rows is spread over its
    block pairs. Ties go to the lowest centre row; chains without centres have no rows.
    """
    kind = extra.schema[chain].dataType.simpleString()
    e, c = _row_blocks(extra, chain, "e"), _row_blocks(centers, chain, "c")
    pairs = e.join(c, chain).select(chain, "e", "c").repartition(F.xxhash64(chain, F.col("e")[0]["msa_row"], F.col("c")[0]["msa_row"]))
    got = pairs.mapInArrow(_best_of_blocks(gap_weight), f"{chain} {kind}, extra_row long, center_row long, score double")
    best = got.groupBy(chain, "extra_row").agg(F.max_by("center_row", F.struct("score", -F.col("center_row"))).alias("center_row"), F.max("score").alias("score"))
    return best.select(chain, "extra_row", "center_row", "score")


def cluster_profiles(assigned: DataFrame, extra: DataFrame, centers: DataFrame, chain: str = "chain",
                     deletions: str | None = None):
    """Per centre and column over the centre plus its assigned extra rows: residue shares, and with
    ``deletions`` (a column of per-column deletion counts) the mean deletions too, both divided by
    1e-6 + count. Returns the shares (chain, center_row, pos, res, share), or with ``deletions`` the
    pair (shares, (chain, center_row, pos, mean_deletions)). Missing deletions count as 0.
    """
    carried = [F.col(deletions).alias("_d")] if deletions else []
    ex = extra.select(chain, F.col("msa_row").alias("extra_row"), "seq", *carried).join(
        assigned.select(chain, "extra_row", "center_row"), [chain, "extra_row"]).drop("extra_row")
    ce = centers.select(chain, F.col("msa_row").alias("center_row"), "seq", *carried)
    # written, so the assignment runs once and not for each reader
    allr = written_once(ex.unionByName(ce), "members")
    n = allr.groupBy(chain, "center_row").agg((F.lit(1e-6) + F.count("*")).alias("_n"))
    own = [chain, "center_row"]
    if not deletions:
        c = allr.select(*own, F.posexplode(S.chars("seq")).alias("pos", "res")).filter("res <> ''").groupBy(*own, "pos", "res").agg(F.count("*").alias("_c"))
        return _shares(c, n, own)
    # residues and deletions of a column in one pass; ``_m`` columns of a row have a deletion count
    d = F.coalesce(F.slice("_d", F.lit(1), F.length("seq")), F.array().cast(allr.schema["_d"].dataType))
    e = allr.select(*own, F.size(d).alias("_m"), F.posexplode(F.arrays_zip(S.chars("seq").alias("res"), d.alias("x"))).alias("pos", "_z"))
    e = e.select(*own, "pos", "_z.res", "_z.x", (F.col("pos") < F.col("_m")).alias("has")).filter("res <> ''")
    c = e.groupBy(*own, "pos", "res").agg(F.count("*").alias("_c"), F.sum("x").alias("_s"), F.max("has").alias("_has"))
    c = written_once(c, "columns")
    d = c.groupBy(*own, "pos").agg(F.coalesce(F.sum("_s"), F.lit(0)).alias("_s"), F.max("_has").alias("_has")).filter("_has")
    return _shares(c, n, own), d.join(n, own).select(*own, "pos", (F.col("_s") / F.col("_n")).alias("mean_deletions"))


def _shares(counts: DataFrame, n: DataFrame, own: list[str]) -> DataFrame:
    return counts.join(n, own).select(*own, "pos", "res", (F.col("_c") / F.col("_n")).alias("share"))
