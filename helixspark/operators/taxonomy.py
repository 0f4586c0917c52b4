"""Taxonomic profiling dataflow re-expressed as table jobs: routing reads to
databases, gates, run merging, profile merging, clade roll-up and report cleanup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixspark.operators.common import first_true, rank_within
from helixspark.session import written_once

# The profilers a database may belong to.
TOOLS = ["bracken", "centrifuge", "diamond", "kaiju", "kraken2", "krakenuniq", "malt", "metaphlan3", "motus"]
RANK_PREFIXES = ["d", "k", "p", "c", "o", "f", "g", "s"]


def reads_with_databases(reads: DataFrame, dbs: DataFrame) -> DataFrame:
    """Every read set paired with every database of a known tool, whatever its platform.

    Written as an equi-join on ``tool`` (each read set explodes to the fixed list of
    tools), not as a cartesian product; a bracken database also routes
    the read set to kraken2, which produces bracken's input.
    """
    r = reads.withColumn("tool", F.explode(F.array(*[F.lit(t) for t in TOOLS])))
    d = dbs.withColumn("route", F.when(F.col("tool") == "bracken", F.lit("kraken2")).otherwise(F.col("tool")))
    return r.join(d, "tool")


def reports_with_db(reports: DataFrame, dbs: DataFrame) -> DataFrame:
    """Reports joined to their database on tool and ``db_name``; the bracken step takes the
    second half of ``;``-separated params and is not run on long reads."""
    d = dbs.withColumn("step2_params", F.split_part(F.coalesce("db_params", F.lit("")), F.lit(";"), F.lit(2)))
    skipped = (F.col("tool") == "bracken") & F.col("instrument_platform").eqNullSafe("OXFORD_NANOPORE")
    return reports.filter(~skipped).join(d, ["tool", "db_name"])


def outer_on_meta(a: DataFrame, b: DataFrame, keys: list[str], how: str = "full_outer") -> DataFrame:
    return a.join(b, keys, how)


def gate(df: DataFrame, metrics: DataFrame, key: str, col: str, minimum: float):
    """(passed rows, failed report): rows whose sample metric is >= ``minimum``.
    A sample without a metric fails."""
    j = df.join(metrics.select(key, col), key, "left")
    ok = F.coalesce(F.col(col) >= minimum, F.lit(False))
    return j.filter(ok), j.filter(~ok).select(key, col).distinct()


def merge_runs(reads: DataFrame, meta: list[str], run: str = "run_accession", files: list[str] = ("fastq_1", "fastq_2")):
    """Runs of one sample grouped: the run id is dropped and the files of all runs
    of equal metadata listed in run order (long form: one row per file), with
    ``concatenate`` true when a sample has more than one run.

    Long form instead of ``collect_list`` keeps a sample with many runs spread over
    tasks.
    """
    long = reads.select(*meta, run, F.posexplode(F.array(*[F.col(f) for f in files])).alias("mate", "file")).filter(
        F.col("file").isNotNull() & (F.col("file") != ""))
    n = reads.groupBy(*meta).agg(F.count_distinct(run).alias("n_runs"))
    r = rank_within(long, list(meta), [run, "mate"], "file_idx")
    n = n.select(*[F.col(m).alias(f"_m_{m}") for m in meta], "n_runs")
    same = F.lit(True)
    for m in meta:  # a null in the metadata is a value like any other
        same = same & F.col(m).eqNullSafe(F.col(f"_m_{m}"))
    return r.join(n, same).drop(*[f"_m_{m}" for m in meta]).withColumn("concatenate", F.col("n_runs") > 1).drop(run)


def merge_profiles(profiles: DataFrame, samples: list[str], db: str = "db", taxon: str = "taxon",
                   sample: str = "sample", value: str = "n") -> DataFrame:
    """Per database: taxon x sample table (given sample list), missing -> 0."""
    w = profiles.groupBy(db, taxon).pivot(sample, samples).agg(F.sum(value))
    return w.fillna(0, subset=samples)


def ancestors(tax: DataFrame, node: str = "id", parent: str = "parent") -> DataFrame:
    """(id, anc) for every node and each of its ancestors, itself included.

    The table of proper ancestors is joined to itself until it stops growing, so paths double:
    a tree of depth d takes log2(d) rounds, whatever the depth. Each round is a written
    table. A node that is its own ancestor is a cycle and raises (a root is its own parent or
    has none).
    """
    up = tax.select(F.col(node).alias("id"), F.col(parent).alias("anc")).filter(
        F.col("anc").isNotNull() & (F.col("anc") != F.col("id"))).distinct()
    up, n = written_once(up, "ancestors"), -1
    while n != (m := up.count()):
        n = m
        if not up.filter("id = anc").isEmpty():
            raise ValueError("the taxonomy has a cycle")
        further = up.select("id", F.col("anc").alias("mid")).join(up.select(F.col("id").alias("mid"), "anc"), "mid")
        up = written_once(up.unionByName(further.select("id", "anc")).distinct(), "ancestors")
    return tax.select(F.col(node).alias("id"), F.col(node).alias("anc")).unionByName(up)


def clade_counts(counts: DataFrame, tax: DataFrame, taxon: str = "taxon", value: str = "n",
                 by: list[str] = ("sample",)) -> DataFrame:
    """Reads of each node plus all its descendants (kraken-style clade count).

    After round k every node holds the reads of its descendants nearer than 2**k and a pointer to
    its ancestor 2**k above; in the next round each node's sum goes to its pointer, and the pointer
    becomes that of the pointer. So a tree of depth d takes log2(d) rounds over one row per node
    (and ``by``), whatever its shape, and no list of ancestors is made. Rounds are written tables.
    Counts of taxa that the taxonomy lacks are left out; a cycle raises.
    """
    own = counts.join(tax.select(F.col("id").alias(taxon)).distinct(), taxon, "left_semi").groupBy(*by, taxon).agg(F.sum(value).alias("taxon_reads"))
    own = written_once(own, "clades")
    held = own.withColumnRenamed("taxon_reads", "clade_reads")
    up = tax.select(F.col("id"), F.col("parent").alias("anc")).filter(F.col("anc").isNotNull() & (F.col("anc") != F.col("id"))).distinct()
    up = written_once(up, "pointers")
    left, rounds = up.count(), 0
    most = left.bit_length() + 1
    while left:
        if rounds > most:
            raise ValueError("the taxonomy has a cycle")
        sent = held.join(up, held[taxon] == up["id"]).select(*by, F.col("anc").alias(taxon), "clade_reads")
        held = written_once(held.unionByName(sent).groupBy(*by, taxon).agg(F.sum("clade_reads").alias("clade_reads")), "clades")
        further = up.select(F.col("id").alias("_mid"), F.col("anc").alias("_far"))
        up = written_once(up.join(further, up["anc"] == further["_mid"]).select("id", F.col("_far").alias("anc")), "pointers")
        left, rounds = up.count(), rounds + 1
    return held.join(own, [*by, taxon], "left").fillna(0, ["taxon_reads"])


def clean_lineage(c) -> Column:
    """Drop rank prefixes ``d__ .. s__`` and turn ``_`` back into spaces."""
    c = F.col(c) if isinstance(c, str) else c
    for p in RANK_PREFIXES:
        c = F.regexp_replace(c, f"{p}__", "")
    return F.regexp_replace(c, "_", " ")


def standard_report(report8: DataFrame) -> DataFrame:
    """8-column kraken report -> 6 standard columns (1-3 and 6-8)."""
    cols = report8.columns
    return report8.select(*[cols[i] for i in (0, 1, 2, 5, 6, 7)])


def route(df: DataFrame, rules: list[tuple[str, Column]], col: str = "branch") -> DataFrame:
    """Label each row with the first matching rule; ``unknown`` when none matches."""
    return df.withColumn(col, F.coalesce(first_true(rules), F.lit("unknown")))


def transpose_rows(df: DataFrame, keys: list[str], list_cols: list[str]) -> DataFrame:
    """Parallel list columns back to one row per element."""
    z = df.select(*keys, F.explode(F.arrays_zip(*[F.col(c) for c in list_cols])).alias("_z"))
    return z.select(*keys, *[F.col("_z")[c].alias(c) for c in list_cols])


def call_strand(df: DataFrame, cutoff: float = 30.0) -> DataFrame:
    """Strandedness from sense / antisense percentages: forward when sense >= 100 -
    cutoff, reverse when antisense >= 100 - cutoff, else unstranded."""
    return df.withColumn("strandedness", F.when(F.col("sense") >= 100 - cutoff, "forward")
                         .when(F.col("antisense") >= 100 - cutoff, "reverse").otherwise("unstranded"))


def strand_from_libtype(c) -> Column:
    """Salmon library type -> strandedness (default reverse)."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.when(c.isin("U", "IU"), "unstranded").when(c.isin("SF", "ISF"), "forward")
            .when(c.isin("SR", "ISR"), "reverse").otherwise("reverse"))


# Fixed log patterns of the tools whose logs gate samples.
LOG_PATTERNS = {
    "total_reads": r"([\d.]+)\ssequences processed in total",
    "filtered_reads": r"shorter than the length cutoff[^:]+:\s([\d.]+)",
    "pct_uniquely_mapped": r"Uniquely mapped reads %\s*\|\s*([\d.]+)%",
}


def log_metrics(lines: DataFrame, patterns: dict[str, str] = LOG_PATTERNS, file: str = "file",
                line_no: str = "line_no", text: str = "text") -> DataFrame:
    """Per log file: the value of the last line matching each pattern (0 when none)."""
    aggs = []
    for name, pat in patterns.items():
        v = F.when(F.col(text).rlike(pat), F.regexp_extract(text, pat, 1).try_cast("double"))
        # last matching line wins; equal line numbers: the larger value
        order = F.when(v.isNotNull(), F.struct(F.col(line_no), v))
        aggs.append(F.coalesce(F.max_by(v, order), F.lit(0.0)).alias(name))
    return lines.groupBy(file).agg(*aggs)


def gather(dfs: list[DataFrame], keys: list[str], sums: list[str]) -> DataFrame:
    """Scatter outputs added up per key (union, then one partial-aggregated group-by)."""
    u = dfs[0]
    for d in dfs[1:]:
        u = u.unionByName(d)
    return u.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
