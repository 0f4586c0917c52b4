"""Relational core of read/alignment-table tools (SAM flag semantics).

Alignment table columns: ``name, read_id, contig, start0, end0 (0-based half
open), strand, flag, qual_sum [, umi, next_contig, next_start0]``. The tools the
pipelines call (samtools, picard, bedtools, featureCounts, ...) are not rebuilt;
their table-shaped results are computed with joins and grouped aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixspark.operators.common import neighbours, prefix_sum, rank_within
from helixspark.operators.rangejoin import overlap_join

# SAM flag bits.
PAIRED, PROPER, UNMAPPED, MATE_UNMAPPED, REVERSE, MATE_REVERSE = 0x1, 0x2, 0x4, 0x8, 0x10, 0x20
READ1, READ2, SECONDARY, QCFAIL, DUP, SUPPLEMENTARY = 0x40, 0x80, 0x100, 0x200, 0x400, 0x800


def has(flag: str | Column, bit: int) -> Column:
    f = F.col(flag) if isinstance(flag, str) else flag
    return (f.bitwiseAND(F.lit(bit))) != 0


def flag_stats(reads: DataFrame) -> DataFrame:
    """flagstat-style counts, split into QC-passed and QC-failed columns."""
    f = "flag"
    primary = ~has(f, SECONDARY) & ~has(f, SUPPLEMENTARY)
    classes = {
        "total": F.lit(True),
        "primary": primary,
        "secondary": has(f, SECONDARY),
        "supplementary": has(f, SUPPLEMENTARY),
        "duplicates": has(f, DUP),
        "mapped": ~has(f, UNMAPPED),
        "paired": has(f, PAIRED) & primary,
        "read1": has(f, PAIRED) & has(f, READ1) & primary,
        "read2": has(f, PAIRED) & has(f, READ2) & primary,
        "properly_paired": has(f, PAIRED) & has(f, PROPER) & ~has(f, UNMAPPED) & primary,
        "with_mate_mapped": has(f, PAIRED) & ~has(f, UNMAPPED) & ~has(f, MATE_UNMAPPED) & primary,
        "singletons": has(f, PAIRED) & ~has(f, UNMAPPED) & has(f, MATE_UNMAPPED) & primary,
    }
    qc = ~has(f, QCFAIL)
    aggs = []
    for k, cond in classes.items():
        aggs.append(F.count(F.when(cond & qc, 1)).alias(f"{k}_passed"))
        aggs.append(F.count(F.when(cond & ~qc, 1)).alias(f"{k}_failed"))
    return reads.agg(*aggs)


def idx_stats(reads: DataFrame, contigs: DataFrame) -> DataFrame:
    """Per contig: length, mapped and unmapped reads (contigs without reads get 0)."""
    g = reads.groupBy(F.col("contig")).agg(
        F.count(F.when(~has("flag", UNMAPPED), 1)).alias("mapped"),
        F.count(F.when(has("flag", UNMAPPED), 1)).alias("unmapped"))
    return contigs.join(g, "contig", "left").fillna(0, ["mapped", "unmapped"])


def five_prime(strand: str = "strand") -> Column:
    return F.when(F.col(strand) == "-", F.col("end0") - 1).otherwise(F.col("start0"))


def templates(reads: DataFrame) -> DataFrame:
    """One row per (lib, name): the ends of a template. An end is (contig, 5' position, strand) of
    its first primary mapped record: ``lo`` and ``hi`` are the two ends in coordinate order, a
    template with one mapped end has ``hi`` null. ``qual`` sums both records, ``first_id`` is the
    lowest read id."""
    r = reads.filter(~has("flag", UNMAPPED) & ~has("flag", SECONDARY) & ~has("flag", SUPPLEMENTARY))
    second = has("flag", PAIRED) & has("flag", READ2)
    end = F.struct("contig", five_prime().alias("pos"), "strand")
    pick = lambda which: F.min_by(F.struct(end.alias("e"), "qual_sum"), F.when(which, F.col("read_id")))
    t = r.groupBy("lib", "name").agg(F.min("read_id").alias("first_id"), pick(~second).alias("a"), pick(second).alias("b"))
    ends = F.array_compact(F.array("a.e", "b.e"))
    return t.select("lib", "name", "first_id", (F.coalesce("a.qual_sum", F.lit(0)) + F.coalesce("b.qual_sum", F.lit(0))).alias("qual"),
                    F.array_min(ends).alias("lo"), F.when(F.size(ends) > 1, F.array_max(ends)).alias("hi"))


def mark_duplicates(reads: DataFrame, library: str | Column | None = None) -> DataFrame:
    """Templates (reads of one name) with both ends at the same places and strands are duplicates of
    the one with the highest quality sum over the pair (ties: lowest read id); ends are compared in
    coordinate order, so it does not matter which mate is read 1. Templates with one mapped end are
    compared with each other only. The flag stands on the primary mapped reads of a template;
    unmapped, secondary and supplementary records are never marked.

    The best template per signature is a grouped ``max_by``, so a place that holds many templates
    is combined before the shuffle, and only the chosen names are joined back, by name.
    """
    lib = F.lit("lib") if library is None else F.col(library) if isinstance(library, str) else library
    r = reads.withColumn("lib_", lib)
    t = templates(reads.withColumn("lib", lib))
    best = t.groupBy("lib", "lo", "hi").agg(F.max_by("name", F.struct("qual", -F.col("first_id"))).alias("name"))
    best = best.select(F.col("lib").alias("_lib"), F.col("name").alias("_name"))
    m = r.join(best, F.col("lib_").eqNullSafe(F.col("_lib")) & F.col("name").eqNullSafe(F.col("_name")), "left")
    marked = ~has("flag", UNMAPPED) & ~has("flag", SECONDARY) & ~has("flag", SUPPLEMENTARY) & F.col("_lib").isNull()
    return m.withColumn("is_duplicate", marked).drop("lib_", "_lib", "_name")


def umi_dedup(reads: DataFrame) -> DataFrame:
    """One read per (contig, 5' position, strand, UMI) - exact UMI match only."""
    m = reads.filter(~has("flag", UNMAPPED)).withColumn("_5p", five_prime())
    key = ["contig", "_5p", "strand", "umi"]
    best = m.groupBy(*key).agg(F.max_by("read_id", F.struct(F.col("qual_sum"), -F.col("read_id"))).alias("read_id"))
    return m.join(best, [*key, "read_id"], "left_semi").drop("_5p")


def coverage(reads: DataFrame, by_strand: bool = False) -> DataFrame:
    """bedGraph runs of read depth: (contig[, strand], start, end, depth), depth > 0,
    adjacent equal depths merged.

    +1/-1 events are summed per position first (partial aggregation), the depth
    is a running sum along the contig and run ends come from the next kept
    position; both use range-partitioned scans, so one chromosome is spread over
    many tasks.
    """
    keys = ["contig", "strand"] if by_strand else ["contig"]
    m = reads.filter(~has("flag", UNMAPPED))
    ev = m.select(*keys, F.col("start0").alias("pos"), F.lit(1).alias("d")).unionByName(
        m.select(*keys, F.col("end0").alias("pos"), F.lit(-1).alias("d")))
    ev = ev.groupBy(*keys, "pos").agg(F.sum("d").alias("d"))
    depth = prefix_sum(ev, keys, ["pos"], "d", "depth")
    n = neighbours(depth, keys, ["pos"], ["depth"])
    starts = n.filter(F.col("prev_depth").isNull() | (F.col("prev_depth") != F.col("depth"))).select(*keys, "pos", "depth")
    runs = neighbours(starts, keys, ["pos"], ["pos"])
    return runs.filter((F.col("depth") > 0) & F.col("next_pos").isNotNull()).select(
        *keys, F.col("pos").alias("start"), F.col("next_pos").alias("end"), "depth")


def count_features(reads: DataFrame, exons: DataFrame, group: str = "gene_id", bin_size: int = 128,
                   feature_type: str | None = None, type_col: str = "biotype") -> DataFrame:
    """featureCounts-style: a mapped read counts for a group when it overlaps
    features of exactly one group (features 1-based closed, reads 0-based half
    open); ``feature_type`` keeps only features of that type (``-t``)."""
    if feature_type is not None:
        exons = exons.filter(F.col(type_col) == feature_type)
    # a read's outcome depends only on its interval: reads with the same interval are
    # counted once (partial aggregation) and carry their multiplicity through the join
    once = _of_one_group(_intervals(reads), exons, group, bin_size)
    return once.groupBy(group).agg(F.sum("_w").alias("count"))


def _intervals(reads: DataFrame, *counts: Column) -> DataFrame:
    """Distinct intervals of mapped primary reads with their number ``_w`` and other counts."""
    r = reads.filter(~has("flag", UNMAPPED) & ~has("flag", SECONDARY))
    return r.groupBy("contig", (F.col("start0") + 1).alias("rs"), F.col("end0").alias("re")).agg(F.count("*").alias("_w"), *counts)


def _of_one_group(intervals: DataFrame, exons: DataFrame, group: str, bin_size: int) -> DataFrame:
    """Intervals that overlap exons of exactly one group, with that group."""
    e = exons.select("contig", F.col("start1").alias("es"), F.col("end1").alias("ee"), group)
    j = overlap_join(intervals, e, "contig", "rs", "re", "es", "ee", bin_size=bin_size)
    per_iv = j.groupBy(*intervals.columns).agg(F.count_distinct(group).alias("_n"), F.min(group).alias(group))
    return per_iv.filter(F.col("_n") == 1)


def clip_intervals(bed: DataFrame, sizes: DataFrame) -> DataFrame:
    """Intervals cut to [0, contig size); intervals outside a contig or on unknown
    contigs are dropped."""
    j = bed.join(sizes.select("contig", "size"), "contig")
    j = j.withColumn("start", F.greatest(F.col("start"), F.lit(0))).withColumn(
        "end", F.least(F.col("end"), F.col("size")))
    return j.filter(F.col("start") < F.col("end")).drop("size")


def read_qc(reads: DataFrame, seq: str = "seq", qual: str = "qual"):
    """(per-position mean quality, GC-content histogram, length histogram)."""
    q = reads.select(F.posexplode(F.split(qual, "")).alias("pos", "_c"))
    per_pos = q.groupBy("pos").agg(F.avg(F.ascii("_c") - 33).alias("mean_quality"))
    gc = (F.length(seq) - F.length(F.regexp_replace(seq, "[GCgc]", ""))) / F.length(seq)
    gc_hist = reads.groupBy(F.round(gc * 100).cast("int").alias("gc_percent")).agg(F.count("*").alias("reads"))
    len_hist = reads.groupBy(F.length(seq).alias("length")).agg(F.count("*").alias("reads"))
    return per_pos, gc_hist, len_hist


def complexity(seq: str = "seq") -> Column:
    """Share of bases that differ from the next base (low = low complexity)."""
    c = F.split(seq, "")
    diffs = F.zip_with(F.slice(c, 1, F.size(c) - 1), F.slice(c, 2, F.size(c)), lambda a, b: F.when(a != b, 1).otherwise(0))
    return F.try_divide(F.aggregate(diffs, F.lit(0), lambda acc, x: acc + x), F.size(c) - 1)


def filter_reads(reads: DataFrame, min_len: int = 0, min_complexity: float = 0.0, keep_percent: float | None = None,
                 seq: str = "seq", score: str = "qual_mean", key: str = "read_id") -> DataFrame:
    """Length and complexity filters, then (optionally) the best ``keep_percent`` %
    of the rest by ``score`` (exact global rank, range-partitioned)."""
    r = reads.filter(F.length(seq) >= min_len).filter(F.coalesce(complexity(seq), F.lit(0.0)) >= min_complexity)
    if keep_percent is None:
        return r
    n = r.count()  # a scalar
    keep = int(-(-n * keep_percent // 100))
    ranked = rank_within(r, [], [F.col(score).desc(), F.col(key)], "_rk")
    return ranked.filter(F.col("_rk") <= keep).drop("_rk")


def subsample(reads: DataFrame, fraction: float, seed: int, name: str = "name") -> DataFrame:
    """Seeded sample by read name, so both mates of a pair are kept or dropped together."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(name)))
    u = F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    return reads.filter(u < fraction)


def drop_host(reads: DataFrame, host_hits: DataFrame, name: str = "name") -> DataFrame:
    """Reads whose template has no mapped alignment to the host."""
    hits = host_hits.filter(~has("flag", UNMAPPED)).select(name).distinct()
    return reads.join(hits, name, "left_anti")


def split_intervals(intervals: DataFrame, n: int, order: list[str] = ("contig", "start")) -> DataFrame:
    """Assign intervals to ``n`` shards of about equal total bases, in genomic order:
    shard = floor(bases before * n / total)."""
    iv = intervals.withColumn("_len", F.col("end") - F.col("start"))
    total = iv.agg(F.sum("_len")).first()[0]  # a scalar
    c = prefix_sum(iv, [], list(order), "_len", "_before", inclusive=False)
    return c.withColumn("shard", F.floor(F.col("_before") * n / F.lit(total)).cast("int")).drop("_len", "_before")


def pair_mates(reads: DataFrame, tags: list[str] = ("umi",)):
    """Re-pair mates inside each read name.

    Candidates are the other-end alignments at the read's mate position
    (an equi-join on name, end and position - only alignments at that key meet).
    The first lookup takes candidates whose secondary status differs from the
    read's, the second those with the same status (the order the source
    lookup keys produce). Among candidates, the last one (template order) whose own
    mate pointer points back at the read wins, else the first. A secondary read
    makes its mate secondary; a tag that read 1 has is copied to read 2,
    one that it lacks leaves read 2 its own.
    Returns (pairs, stats).
    """
    r = reads.withColumn("_r1", has("flag", READ1)).withColumn("_r2", has("flag", READ2)).withColumn(
        "_sec", has("flag", SECONDARY))
    c = r.select(F.col("name"), F.col("read_id").alias("c_id"), F.col("contig").alias("c_contig"),
                 F.col("start0").alias("c_start"), F.col("_r1").alias("c_r1"), F.col("_sec").alias("c_sec"),
                 F.col("next_contig").alias("c_next_contig"), F.col("next_start0").alias("c_next_start"),
                 *[F.col(t).alias(f"c_{t}") for t in tags])
    j = r.join(c, (r["name"] == c["name"]) & (c["c_r1"] == ~r["_r1"]) & (c["c_contig"] == r["next_contig"])
               & (c["c_start"] == r["next_start0"]), "left").drop(c["name"])
    back = (F.col("c_next_contig") == F.col("contig")) & (F.col("c_next_start") == F.col("start0"))
    lookup = F.when(F.col("c_sec") != F.col("_sec"), 0).otherwise(1)
    pref = F.struct(lookup.alias("l"), F.when(back, 0).otherwise(1).alias("b"),
                    F.when(back, -F.col("c_id")).otherwise(F.col("c_id")).alias("o"),
                    "c_sec", *[x for t in tags for x in (F.col(f"c_{t}").isNull().alias(f"n_{t}"), F.col(f"c_{t}"))])
    cand_cols = ["c_id", "c_sec", *[f"c_{t}" for t in tags]]
    best = j.filter(F.col("c_id").isNotNull()).groupBy("read_id").agg(
        F.min_by(F.struct(*cand_cols), pref).alias("_m"))
    rr = r.join(best, "read_id", "left")
    no_mate = rr.filter(F.col("_m").isNull())
    ok = rr.filter(F.col("_m").isNotNull() & (F.col("_r1") | F.col("_r2")))
    mate_sec = F.col("_sec") | F.col("_m.c_sec")
    p1 = ok.filter("_r1").select(
        "name", F.col("read_id").alias("read1_id"), F.col("_m.c_id").alias("read2_id"),
        mate_sec.alias("read2_secondary"), F.col("_sec").alias("read1_secondary"),
        *[F.coalesce(F.col(t), F.col(f"_m.c_{t}")).alias(f"read2_{t}") for t in tags])
    p2 = ok.filter(~F.col("_r1")).select(
        "name", F.col("_m.c_id").alias("read1_id"), F.col("read_id").alias("read2_id"),
        F.col("_sec").alias("read2_secondary"), mate_sec.alias("read1_secondary"),
        *[F.coalesce(F.col(f"_m.c_{t}"), F.col(t)).alias(f"read2_{t}") for t in tags])
    pairs = p1.unionByName(p2).distinct()
    stats = rr.agg(
        F.count(F.when(F.col("_m").isNull(), 1)).alias("no_mate"),
        F.count(F.when(F.col("_m").isNotNull() & ~F.col("_r1") & ~F.col("_r2"), 1)).alias("skipped_not_read12"))
    return pairs, stats, no_mate


def dup_rates(reads_marked: DataFrame, exons: DataFrame, group: str = "gene_id", bin_size: int = 128,
              feature_type: str | None = None, type_col: str = "biotype") -> DataFrame:
    """Per gene: all reads, reads after removing duplicates, duplication rate and
    reads per kilobase of exon length (dupRadar table)."""
    if feature_type is not None:
        exons = exons.filter(F.col(type_col) == feature_type)
    once = _of_one_group(_intervals(reads_marked, F.count_if(~F.col("is_duplicate")).alias("_kept")), exons, group, bin_size)
    counts = once.groupBy(group).agg(F.sum("_w").alias("all_reads"), F.sum("_kept").alias("dedup_reads"))
    length = exons.groupBy(group).agg(F.sum(F.col("end1") - F.col("start1") + 1).alias("length"))
    t = length.join(counts, group, "left").fillna(0, ["all_reads", "dedup_reads"])
    return t.withColumn("dup_rate", F.try_divide(F.col("all_reads") - F.col("dedup_reads"), F.col("all_reads"))).withColumn(
        "rpk", F.col("all_reads") / (F.col("length") / 1000.0))
