"""Protein-structure side jobs: input checks and resource tiers, chain filters and
sampling, entity ids, template hit filtering, token batching, embedding pooling
and confidence / accuracy metrics.

Per-residue and per-pair quantities are rows; arrays only hold a bounded model
dimension (bins of a logit vector, channels of an embedding).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixspark.operators.common import first_true, rank_within
from helixspark.session import written_once

# --------------------------------------------------------------------------- inputs


def resource_tier(length, alg: str = "alphafold") -> Column:
    """Sequence length -> compute tier: a struct of vCPU and memory GiB per step.

    AlphaFold: the template, feature and prediction steps have one size; lengths of <= 750, <= 2000
    and more residues choose those of the database searches. ESMFold: <= 750 fits a GPU (4 vCPU, 16 GiB);
    longer runs on CPU with memory ``round((9 + 0.009 L + 6e-6 L^2) * 1.1)`` GiB.
    """
    L = F.col(length) if isinstance(length, str) else length
    if alg == "esmfold":
        mem = F.round((F.lit(9.0) + 0.009 * L + 0.000006 * L * L) * 1.1).cast("int")
        return F.when(L <= 750, F.struct(F.lit(4).alias("cpu"), F.lit(16).alias("memory_gib"), F.lit(True).alias("gpu"))
                      ).otherwise(F.struct(F.lit(4).alias("cpu"), mem.alias("memory_gib"), F.lit(False).alias("gpu")))
    sizes = TIERS | {k: v * 3 for k, v in FIXED_TIERS.items()}
    pick = lambda three: F.when(L <= 750, three[0]).when(L <= 2000, three[1]).otherwise(three[2])
    return F.struct(*[pick(three).alias(name) for name, three in sizes.items()])


# vCPU and memory GiB of the steps, for lengths <= 750, <= 2000 and above, and for any length.
TIERS = {
    "uniref90_cpu": (8, 8, 8), "uniref90_memory_gib": (16, 16, 32), "mgnify_cpu": (8, 8, 8), "mgnify_memory_gib": (16, 16, 32),
    "bfd_cpu": (16, 16, 48), "bfd_memory_gib": (32, 128, 192)}
FIXED_TIERS = {
    "template_cpu": (2,), "template_memory_gib": (4,), "feature_cpu": (2,), "feature_memory_gib": (4,),
    "predict_cpu": (8,), "predict_memory_gib": (32,)}


def validate_fasta(seqs: DataFrame, max_seq: int = 1, max_len: int = 2000, file: str = "file",
                   ord_col: str = "ord"):
    """Per file: keep the first ``max_seq`` records; id = leading alphanumerics of
    the last kept record's id; summed length must be <= ``max_len``.
    Returns (ok, rejected) per file: (file, id, seq_length, seq_count)."""
    r = rank_within(seqs, [file], [ord_col], "_k").filter(F.col("_k") <= max_seq)
    g = r.groupBy(file).agg(
        F.sum(F.length("seq")).alias("seq_length"), F.count("*").alias("seq_count"),
        F.max_by("id", ord_col).alias("_last"))
    g = g.withColumn("id", F.regexp_extract("_last", r"^[0-9a-zA-Z]*", 0)).drop("_last")
    return g.filter(F.col("seq_length") <= max_len), g.filter(F.col("seq_length") > max_len)


# --------------------------------------------------------------------------- chains


def chain_filter(chains: DataFrame, max_resolution: float = 9.0, max_single_aa_prop: float = 0.8,
                 key: str = "chain_id") -> DataFrame:
    """Deterministic training filter: resolution <= max (null passes) and the most
    common residue at most ``max_single_aa_prop`` of the sequence. A row-wise expression: the count
    of a letter is what the sequence loses in length without it."""
    letters = F.array_distinct(F.split("seq", ""))
    top = F.array_max(F.transform(letters, lambda a: F.length("seq") - F.length(F.replace(F.col("seq"), a, F.lit("")))))
    ok = (F.col("resolution").isNull() | (F.col("resolution") <= max_resolution)) & (
        F.try_divide(top, F.length("seq")) <= max_single_aa_prop)
    return chains.withColumn("passed", F.coalesce(ok, F.lit(False)))


def uniform(seed: int, *cols) -> Column:
    """Repeatable uniform [0, 1) from md5 of ``seed:cols`` (same value in DuckDB)."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
                                                   for c in cols]))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def sample_prob(cluster_size, length) -> Column:
    """Stochastic training filter probability: 1/cluster_size (when > 0) times
    clamp(length, 256, 512) / 512."""
    cs = F.col(cluster_size) if isinstance(cluster_size, str) else cluster_size
    ln = F.col(length) if isinstance(length, str) else length
    p_cluster = F.when(cs.isNotNull() & (cs > 0), F.lit(1.0) / cs).otherwise(F.lit(1.0))
    return p_cluster * (F.greatest(F.least(ln, F.lit(512)), F.lit(256)) / F.lit(512.0))


def sample_chains(chains: DataFrame, seed: int, key: str = "chain_id", cluster: str = "cluster",
                  length: str | Column | None = None) -> DataFrame:
    """Each chain with the size of its cluster, its filter probability ``p`` and ``kept``, decided by
    a seeded hash of its id. Cluster sizes are counted with partial sums; a chain without a cluster
    has size null and weight 1. ``length`` defaults to that of ``seq``."""
    sizes = chains.filter(F.col(cluster).isNotNull()).groupBy(cluster).agg(F.count("*").alias("cluster_size"))
    c = chains.join(sizes, cluster, "left").withColumn("p", sample_prob("cluster_size", F.length("seq") if length is None else length))
    return c.withColumn("kept", uniform(seed, key) < F.col("p"))


def mix(datasets: list[DataFrame], probs: list[float], n: int, seed: int, key: str = "chain_id") -> DataFrame:
    """Epoch of ``n`` draws: each draw picks a dataset by probability (seeded hash
    against the cumulative probabilities), then the next element of that dataset's
    seeded shuffle (cycling). Output: (draw, dataset, key)."""
    spark = datasets[0].sparkSession
    cum, acc = [], 0.0
    for p in probs:
        acc += p
        cum.append(acc / sum(probs))
    u = uniform(seed, F.lit("draw"), "draw")
    pick = first_true([(str(i), u < F.lit(c)) for i, c in enumerate(cum)])
    draws = spark.range(n).withColumnRenamed("id", "draw").withColumn(
        "dataset", F.coalesce(pick, F.lit(str(len(cum) - 1))).cast("int"))
    draws = rank_within(draws, ["dataset"], ["draw"], "_j")
    sizes, elems = [], None
    for i, d in enumerate(datasets):
        e = rank_within(d.select(key).withColumn("dataset", F.lit(i)).withColumn("_h", uniform(seed, F.lit(i), key)),
                        ["dataset"], ["_h", key], "_pos")
        elems = e if elems is None else elems.unionByName(e)
        sizes.append(d.count())  # scalars
    size_col = F.element_at(F.array(*[F.lit(s) for s in sizes]), F.col("dataset") + 1)
    draws = draws.withColumn("_pos", F.pmod(F.col("_j") - 1, size_col) + 1)
    return draws.join(elems.drop("_h"), ["dataset", "_pos"]).select("draw", "dataset", key)


def entity_label(n) -> Column:
    """1 -> A, 26 -> Z, 27 -> AA, 28 -> BA (reverse spreadsheet naming). The 14 steps name any
    positive long; other numbers raise."""
    n = F.col(n).cast("long") if isinstance(n, str) else n.cast("long")

    def step(a, _):
        left = a["left"]
        letter = F.when(left >= 0, F.char((F.pmod(left, F.lit(26)) + 65).cast("int"))).otherwise("")
        return F.struct(F.when(left >= 0, F.floor(left / 26) - 1).otherwise(F.lit(-1).cast("long")).alias("left"),
                        F.concat(a["name"], letter).alias("name"))

    name = F.aggregate(F.sequence(F.lit(1), F.lit(14)), F.struct((n - 1).alias("left"), F.lit("").alias("name")), step, lambda a: a["name"])
    return F.when(n > 0, name).otherwise(F.raise_error(F.lit("an entity number is positive")))


def entity_ids(chains: DataFrame, group: str = "complex", order: str = "ord") -> DataFrame:
    """Chains with the same sequence share an entity (numbered in first-seen
    order); sym_id counts chains inside an entity; asym_id numbers chains entity by
    entity; label = ``<entity letters>_<sym_id>``."""
    first = chains.groupBy(group, "seq").agg(F.min(order).alias("_first"))
    ent = rank_within(first, [group], ["_first"], "entity_id")
    c = chains.join(ent.select(group, "seq", "entity_id"), [group, "seq"])
    c = rank_within(c, [group, "entity_id"], [order], "sym_id")
    c = rank_within(c, [group], ["entity_id", "sym_id"], "asym_id")
    return c.withColumn("label", F.concat(entity_label("entity_id"), F.lit("_"), F.col("sym_id").cast("string")))


# --------------------------------------------------------------------------- templates


def prefilter(hits: DataFrame, release_dates: DataFrame, obsolete: DataFrame, cutoff: str,
              max_subsequence_ratio: float = 0.95, min_align_ratio: float = 0.1) -> DataFrame:
    """Template hits with a reason column (null = passed).

    Obsolete PDB ids are replaced by their successor (or the hit is dropped when
    the entry has no successor); then: release date after cutoff, align ratio too
    small, exact subsequence of the query with large coverage, fewer than 10
    residues - first failing rule wins. Lookups are joins, not driver dicts.
    """
    h = hits.join(obsolete.select(F.col("from_id").alias("pdb_id"), "to_id", F.lit(True).alias("_obs")), "pdb_id", "left")
    h = h.withColumn("pdb_code", F.coalesce("to_id", "pdb_id")).withColumn(
        "_dead", F.coalesce(F.col("_obs"), F.lit(False)) & F.col("to_id").isNull()).drop("to_id", "_obs")
    h = h.join(release_dates.select(F.col("pdb_id").alias("pdb_code"), "release_date"), "pdb_code", "left")
    tmpl = F.regexp_replace("hit_sequence", "-", "")
    qlen = F.length("query_sequence")
    rules = [
        ("obsolete", F.col("_dead")),
        ("date", F.col("release_date") > F.to_timestamp(F.lit(cutoff))),
        ("align_ratio", F.col("aligned_cols") / qlen <= min_align_ratio),
        ("duplicate", (F.instr(F.col("query_sequence"), tmpl) > 0) & (F.length(tmpl) / qlen > max_subsequence_ratio)),
        ("length", F.length(tmpl) < 10),
    ]
    return h.withColumn("reason", first_true(rules)).drop("_dead")


def top_templates(hits: DataFrame, k: int, distinct_seq: bool = False, query: str = "query_id") -> DataFrame:
    """Best ``k`` hits by sum_probs per query (ties: hit order). The hmmsearch
    variant keeps one hit per distinct hit sequence first."""
    h = hits
    if distinct_seq:
        first = h.groupBy(query, "hit_sequence").agg(F.min("hit_idx").alias("hit_idx"))
        h = h.join(first, [query, "hit_sequence", "hit_idx"], "left_semi")
    r = rank_within(h, [query], [F.col("sum_probs").desc(), F.col("hit_idx")], "_rank")
    return r.filter(F.col("_rank") <= k).drop("_rank")


# --------------------------------------------------------------------------- batching


def _filled(budget: int):
    """Rows (size, count) in ascending size -> the batch in which each size's sequences begin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled, batch = 0, -1  # sequences in the open batch, its number
        for b in batches:
            rows = []
            for size, count in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                room = budget // size
                if batch < 0 or filled >= room:  # the first sequence of this size begins a batch
                    filled, batch = 0, batch + 1
                rows.append((size, room, filled, batch))
                full, rest = divmod(filled + count - 1, room)
                filled, batch = rest + 1, batch + full
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)] if rows else [pa.array([], pa.int64())] * 4,
                                             names=["_size", "_room", "_filled", "_batch"])
    return run


def pack_tokens(seqs: DataFrame, budget: int, extra: int = 0, key: str = "idx", length: str = "length") -> DataFrame:
    """Greedy length-sorted batching, exactly as the sequential rule: sequences
    sorted by (length, index); a batch is closed before a sequence when
    ``max_len * (n + 1) > budget``.

    In sorted order the running maximum is the current length, so between two lengths the greedy
    rule only remembers how full the open batch is. Sequences of more than half the budget stand
    alone: their batch follows from their rank. For the others one task walks over the numbers of
    sequences per length, at most ``budget / 2`` rows whatever the number of sequences; the batch of
    each sequence is then arithmetic on its rank inside its length. Nothing comes to the driver but
    one number. Sizes below 1 count as 1; null lengths are left out.
    """
    s = seqs.filter(F.col(length).isNotNull()).withColumn("_size", F.greatest(F.col(length) + F.lit(extra), F.lit(1)).cast("long"))
    short = s.filter(F.col("_size") * 2 <= budget)
    sizes = short.groupBy("_size").agg(F.count("*").alias("_count"))
    walk = sizes.repartition(1).sortWithinPartitions("_size").mapInArrow(_filled(budget), "_size long, _room long, _filled long, _batch long")
    plan = written_once(walk, "batch-plan")
    r = rank_within(short, ["_size"], [key], "_t").join(plan, "_size")
    out = r.withColumn("batch", (F.col("_batch") + F.floor((F.col("_filled") + F.col("_t") - 1) / F.col("_room"))).cast("long"))
    out = out.drop("_size", "_room", "_filled", "_batch", "_t")
    used = (out.agg(F.max("batch")).first()[0])
    alone = rank_within(s.filter(F.col("_size") * 2 > budget), [], ["_size", key], "_t")
    alone = alone.withColumn("batch", F.lit(-1 if used is None else used) + F.col("_t")).drop("_size", "_t")
    return out.unionByName(alone)


# --------------------------------------------------------------------------- embeddings / confidence


def mean_pool(tokens: DataFrame, trunc: int, seq: str = "seq_id", tok: str = "tok", emb: str = "embedding") -> DataFrame:
    """Mean of each sequence's first ``trunc`` token vectors, per channel (long form)."""
    r = rank_within(tokens, [seq], [tok], "_r").filter(F.col("_r") <= trunc)
    e = r.select(seq, F.posexplode(emb).alias("dim", "_v"))
    return e.groupBy(seq, "dim").agg(F.avg(F.col("_v").cast("double")).alias("mean"))


def _with_softmax(df: DataFrame, logits: str, out: str) -> DataFrame:
    """Softmax of an array column, staged in separate projections so the max and
    the normaliser are computed once per row (Catalyst keeps projections apart
    when an expensive expression is used more than once)."""
    return (
        df.withColumn("_sa", F.transform(F.col(logits), lambda x: x.cast("double")))
        .withColumn("_sm", F.array_max("_sa"))
        .withColumn("_se", F.transform("_sa", lambda x: F.exp(x - F.col("_sm"))))
        .withColumn("_st", F.aggregate("_se", F.lit(0.0), lambda acc, x: acc + x))
        .withColumn(out, F.transform("_se", lambda x: x / F.col("_st")))
        .drop("_sa", "_sm", "_se", "_st")
    )


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def with_plddt(df: DataFrame, logits: str = "logits", out: str = "plddt") -> DataFrame:
    """Per residue: softmax over bins x bin centres, times 100."""
    n = F.size(logits)
    centers = F.transform(F.sequence(F.lit(0), n - 1), lambda i: (i + 0.5) / n)
    return _with_softmax(df, logits, "_p").withColumn(out, _dot(F.col("_p"), centers) * 100.0).drop("_p")


def bin_centers(breaks: list[float]) -> list[float]:
    step = breaks[1] - breaks[0]
    c = [b + step / 2 for b in breaks]
    return c + [c[-1] + step]


def pae_ptm(pairs: DataFrame, breaks: list[float], structure: str = "structure", i: str = "i", j: str = "j",
            logits: str = "logits", chain_i: str | None = None, chain_j: str | None = None) -> DataFrame:
    """Per structure: mean and max expected aligned error, pTM, and (when chain ids
    are given) interface pTM.

    Rows are residue pairs; d0 uses max(n, 19) residues; per residue i the TM term
    is averaged over its (masked) partners and the score is the best residue.
    """
    centers = bin_centers(breaks)
    c_arr = F.array(*[F.lit(float(c)) for c in centers])
    p = _with_softmax(pairs, logits, "_p").withColumn("pae", _dot(F.col("_p"), c_arr))
    n = p.groupBy(structure).agg(F.count_distinct(i).alias("_n"))
    p = p.join(n, structure)
    d0 = F.lit(1.24) * F.pow(F.greatest(F.col("_n"), F.lit(19)) - 15, 1.0 / 3) - 1.8
    tm_bins = F.transform(c_arr, lambda c: F.lit(1.0) / (1 + (c * c) / (d0 * d0)))
    p = p.withColumn("_tm", _dot(F.col("_p"), tm_bins))
    aggs = [F.sum("_tm").alias("_s"), F.count("*").alias("_m")]
    inter = chain_i is not None and chain_j is not None
    if inter:
        other = F.col(chain_i) != F.col(chain_j)
        aggs += [F.sum(F.when(other, F.col("_tm")).otherwise(0.0)).alias("_si"),
                 F.sum(F.when(other, 1).otherwise(0)).alias("_mi")]
    per_i = p.groupBy(structure, i).agg(*aggs)
    per_i = per_i.withColumn("_a", F.col("_s") / (F.lit(1e-8) + F.col("_m")))
    out = [F.max("_a").alias("ptm")]
    if inter:
        per_i = per_i.withColumn("_ai", F.col("_si") / (F.lit(1e-8) + F.col("_mi")))
        out.append(F.max("_ai").alias("iptm"))
    scores = per_i.groupBy(structure).agg(*out)
    err = p.groupBy(structure).agg(F.avg("pae").alias("mean_pae"), F.max("pae").alias("max_pae"))
    return scores.join(err, structure)


def gdt(pred: DataFrame, ref: DataFrame, cutoffs: list[float], structure: str = "structure",
        residue: str = "residue") -> DataFrame:
    """Mean over cutoffs of the share of residues within the cutoff distance
    (residues joined by id; coordinates x, y, z)."""
    a = pred.select(structure, residue, *[F.col(c).alias(f"p_{c}") for c in "xyz"])
    b = ref.select(structure, residue, *[F.col(c).alias(f"r_{c}") for c in "xyz"])
    j = a.join(b, [structure, residue])
    d = F.sqrt(sum((F.col(f"p_{c}") - F.col(f"r_{c}")) ** 2 for c in "xyz"))
    j = j.withColumn("_d", d)
    shares = [F.avg(F.when(F.col("_d") <= c, 1.0).otherwise(0.0)) for c in cutoffs]
    return j.groupBy(structure).agg((sum(shares) / len(cutoffs)).alias("gdt"))


#: Residues of a structure that one block holds, about.
BLOCK_RESIDUES = 512


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Squared differences of the pairwise distances of two residue blocks, summed."""
    for b in batches:
        sums = []
        for one, two, twice in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
            x, y = (np.array([tuple(r.values()) for r in side], np.float64) for side in (one, two))
            gap = np.zeros((len(x), len(y)))
            for k, sign in ((0, 1.0), (3, -1.0)):
                gap += sign * np.sqrt(sum((x[:, None, k + c] - y[None, :, k + c]) ** 2 for c in range(3)))
            sums.append(float((gap ** 2).sum()) * (2 if twice else 1))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sums, pa.float64())], names=[b.schema.names[0], "_s"])


def drmsd(pred: DataFrame, ref: DataFrame, structure: str = "structure", residue: str = "residue") -> DataFrame:
    """Distance RMSD between two structures of the same residues.

    The residues of a structure are dealt to blocks of about 512 by hash; every pair of blocks of a
    structure is a row of its own, whose pairwise distances are summed in numpy, and the sums of a
    structure are added up. So a structure of any size is spread over many tasks and none holds
    more than two blocks. Structures of one residue have 0.
    """
    a = pred.select(structure, residue, *[F.col(c).cast("double").alias(f"p_{c}") for c in "xyz"])
    b = ref.select(structure, residue, *[F.col(c).cast("double").alias(f"r_{c}") for c in "xyz"])
    j = a.join(b, [structure, residue])
    n = j.groupBy(structure).agg(F.count("*").alias("_n"))
    dealt = j.join(n, structure).withColumn("_block", F.pmod(F.xxhash64(residue), F.ceil(F.col("_n") / BLOCK_RESIDUES)).cast("int"))
    blocks = dealt.groupBy(structure, "_block").agg(F.collect_list(F.struct(*[f"{k}_{c}" for k in "pr" for c in "xyz"])).alias("_rows"))
    blocks = written_once(blocks, "residue-blocks")
    other = blocks.select(F.col(structure).alias("_other"), F.col("_block").alias("_block2"), F.col("_rows").alias("_rows2"))
    pairs = blocks.join(other, (F.col(structure) == F.col("_other")) & (F.col("_block") <= F.col("_block2")))
    pairs = pairs.repartition(structure, "_block", "_block2").select(structure, "_rows", "_rows2", (F.col("_block") < F.col("_block2")).alias("_twice"))
    sums = pairs.mapInArrow(_pair_sums, f"{structure} {dict(j.dtypes)[structure]}, _s double")
    total = sums.groupBy(structure).agg(F.sum("_s").alias("_s")).join(n, structure)
    return total.select(structure, F.when(F.col("_n") > 1, F.sqrt(F.col("_s") / (F.col("_n") * (F.col("_n") - 1)))).otherwise(0.0).alias("drmsd"))
