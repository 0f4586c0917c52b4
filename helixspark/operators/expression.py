"""Annotation and expression tables: GTF/BED12, transcript->gene, count matrices,
normalisation and QC statistics.

Count matrices are long triples (feature, sample, count); a wide matrix is only
built at the end (``counts_merge``) with an explicit sample list, so no step
depends on the number of samples fitting in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixspark.operators.common import exact_median, rank_within


# --------------------------------------------------------------------------- GTF

def gtf_attributes(attr) -> Column:
    """GTF column 9 (``key "value"; ...``) -> map<string,string>; the last copy of a key wins."""
    a = F.col(attr) if isinstance(attr, str) else attr
    pat = r'([A-Za-z0-9_.]+)\s+"([^"]*)"'
    return F.map_from_arrays(F.regexp_extract_all(a, F.lit(pat), 1), F.regexp_extract_all(a, F.lit(pat), 2))


def to_bed12(features: DataFrame, tx: str = "tx", contig: str = "contig", feature: str = "feature", start: str = "start1",
             end: str = "end1", strand: str = "strand", order: str = "ord", codons: DataFrame | None = None) -> DataFrame:
    """GTF features of transcripts (1-based closed) -> BED12 rows in order of (chrom, start).

    ``exon`` and ``miRNA`` features are the blocks, sorted by start, with sizes and starts as comma
    lists with a trailing comma. The last ``start_codon`` (its start) and ``stop_codon`` (its end) by
    ``order`` bound the thick region; on the minus strand they swap and widen by 2; a missing bound
    is that of the blocks. Chromosome and strand are those of the first block feature by ``order``,
    and rows are sorted by chromosome and that feature's start, ties by name. Features without a
    transcript are left out, and so are transcripts without blocks. One group per transcript (a
    handful of features).

    ``codons`` (transcript, cds_start, cds_end; one row a transcript) stands for the codon features;
    ``features`` may then be plain exons without the feature and order columns.
    """
    if codons is not None:
        have = {feature: F.lit("exon"), order: F.col(start)}
        features = features.withColumns({c: v for c, v in have.items() if c not in features.columns})
    block = F.col(feature).isin("exon", "miRNA")
    g = features.filter(F.col(tx).isNotNull() & (F.col(tx) != "")).groupBy(tx).agg(
        F.min_by(F.struct(F.col(contig).alias("chrom"), F.col(strand).alias("strand"), F.col(start).alias("at")), F.when(block, F.col(order))).alias("f"),
        F.sort_array(F.collect_list(F.when(block, F.struct(F.col(start).alias("s"), F.col(end).alias("e"))))).alias("ex"),
        F.max_by(start, F.when(F.col(feature) == "start_codon", F.col(order))).alias("cds_start"),
        F.max_by(end, F.when(F.col(feature) == "stop_codon", F.col(order))).alias("cds_end"),
    ).filter(F.size("ex") > 0)
    if codons is not None:
        g = g.drop("cds_start", "cds_end").join(codons.select(tx, "cds_start", "cds_end"), tx, "left")
    beg = F.col("ex")[0]["s"]
    fin = F.element_at(F.col("ex"), -1)["e"]
    minus = F.col("f.strand") == "-"
    cds = F.when(minus, F.col("cds_end") - 2).otherwise(F.col("cds_start"))
    cde = F.when(minus, F.col("cds_start") + 2).otherwise(F.col("cds_end"))
    return g.orderBy("f.chrom", "f.at", tx).select(
        "f.chrom",
        (beg - 1).alias("chromStart"),
        fin.alias("chromEnd"),
        F.col(tx).alias("name"),
        F.lit(0).alias("score"),
        "f.strand",
        (F.coalesce(cds, beg) - 1).alias("thickStart"),
        F.coalesce(cde, fin).alias("thickEnd"),
        F.lit(0).alias("itemRgb"),
        F.size("ex").alias("blockCount"),
        F.concat(F.array_join(F.transform("ex", lambda x: (x["e"] - x["s"] + 1).cast("string")), ","), F.lit(",")).alias("blockSizes"),
        F.concat(F.array_join(F.transform("ex", lambda x: (x["s"] - beg).cast("string")), ","), F.lit(",")).alias("blockStarts"),
    )


def trim_headers(fasta: DataFrame, sep: str = "|", col: str = "id") -> DataFrame:
    """FASTA records with their header cut at the first ``sep``; headers without one stay."""
    return fasta.withColumn(col, F.split_part(F.col(col), F.lit(sep), F.lit(1)))


def append_reference(genome: DataFrame, extra: DataFrame, gtf: DataFrame | None = None, biotype: str | None = None):
    """A genome (id, seq) with added sequences behind it, and, if ``gtf`` is given, its annotation with
    one exon row per added sequence: (genome, gtf). Added ids that the genome holds already are an
    error of the input, and raise."""
    both = genome.select("id", "seq").unionByName(extra.select("id", "seq"))
    if not extra.select("id").join(genome.select("id"), "id", "left_semi").isEmpty():
        raise ValueError("an added sequence has the name of a genome sequence")
    return both, None if gtf is None else gtf.unionByName(fasta_to_gtf(extra, biotype).select(*gtf.columns))


def fasta_to_gtf(seqs: DataFrame, biotype: str | None = None) -> DataFrame:
    """One exon row per sequence (id, seq) covering its length. ``biotype`` is the name of an
    attribute, whose value is ``transgene``; without one it is left out."""
    name = F.col("id")
    kind = f' {biotype} "transgene";' if biotype else ""
    # Fixed value: the attribute text of added sequences.
    attrs = F.format_string(
        'exon_id "%s.1"; exon_number "1";' + kind + ' gene_id "%s_gene"; gene_name "%s_gene"; gene_source "custom";'
        ' transcript_id "%s_gene"; transcript_name "%s_gene";', name, name, name, name, name)
    return seqs.select(
        F.col("id").alias("seqname"), F.lit("transgene").alias("source"), F.lit("exon").alias("feature"),
        F.lit(1).alias("start"), F.length("seq").alias("end"), F.lit(".").alias("score"),
        F.lit("+").alias("strand"), F.lit(".").alias("frame"), attrs.alias("attribute"))


def gtf_in_genome(gtf: DataFrame, contigs: DataFrame, seq: str = "contig", name: str = "name") -> DataFrame:
    """GTF rows whose sequence name is a FASTA record (left semi join)."""
    return gtf.join(contigs.select(F.col(name).alias(seq)).distinct(), seq, "left_semi")


def lacks_attribute(gtf: DataFrame, attr_col: str, name: str, file_col: str = "file") -> DataFrame:
    """Files in which no row carries the attribute ``name``."""
    g = gtf.groupBy(file_col).agg(F.bool_or(F.map_contains_key(F.col(attr_col), F.lit(name))).alias("has"))
    return g.filter(~F.col("has")).select(file_col)


def long_contigs(sizes: DataFrame, max_len: int = 512_000_000) -> DataFrame:
    """Contigs longer than ``max_len`` (index formats cap contig size)."""
    return sizes.filter(F.col("length") > max_len)


def chrom_sizes(seqs: DataFrame) -> DataFrame:
    return seqs.select(F.col("id").alias("name"), F.length("seq").cast("long").alias("length"))


# --------------------------------------------------------------------------- tx -> gene

def tx2gene_vote(gtf_attrs: DataFrame, quant_ids: DataFrame, attr_col: str = "attrs",
                 ord_col: str = "ord") -> str:
    """Name of the attribute whose values match the most transcript ids.

    ``quant_ids``: (tx) ids from a quantification file. Ties: the attribute first
    seen in the GTF (lowest ordinal). Returns a one-row DataFrame (attribute, n).
    """
    kv = gtf_attrs.select(ord_col, F.explode(attr_col).alias("attribute", "value"))
    first_seen = kv.groupBy("attribute").agg(F.min(ord_col).alias("first_ord"))
    hits = kv.join(quant_ids.select(F.col("tx").alias("value")).distinct(), "value", "left_semi")
    n = hits.groupBy("attribute").agg(F.count_distinct("value").alias("n"))
    best = n.join(first_seen, "attribute").agg(
        F.min_by(F.struct("attribute", "n"), F.struct(-F.col("n"), F.col("first_ord"))).alias("b"))
    return best.select("b.attribute", "b.n")


def t2g(tx_rows: DataFrame, use_version: bool = False) -> DataFrame:
    """Transcript rows (tx, gene, name, ord) -> distinct (tx, gene, name); the first
    row of a transcript wins; versions (``.N``) stripped unless ``use_version``."""
    t = tx_rows
    if not use_version:
        t = t.withColumn("tx", F.regexp_replace("tx", r"\.\d+$", "")).withColumn(
            "gene", F.regexp_replace("gene", r"\.\d+$", ""))
    return t.groupBy("tx").agg(F.min_by(F.struct("gene", "name"), "ord").alias("g")).select(
        "tx", "g.gene", "g.name")


def with_tx_names(counts: DataFrame, tx2gene: DataFrame) -> DataFrame:
    """Left join count rows to tx2gene; unknown transcripts keep their own id as gene."""
    j = counts.join(tx2gene.select("tx", F.col("gene_id").alias("_g")), "tx", "left")
    return j.withColumn("gene_id", F.coalesce("_g", "tx")).drop("_g")


def missing_ids(matrix_ids: DataFrame, annotation_ids: DataFrame, col: str = "tx") -> DataFrame:
    """Ids in the matrix but not in the annotation (set difference, distinct)."""
    return matrix_ids.select(col).subtract(annotation_ids.select(col))


def summarise_genes(tx: DataFrame, tx2gene: DataFrame, method: str = "no") -> DataFrame:
    """tximport-style summary: per (gene, sample) counts, TPM sum and TPM-weighted length.

    ``tx``: (tx, sample, counts, tpm, length). ``method``: ``no`` | ``scaledTPM`` |
    ``lengthScaledTPM`` (counts replaced by TPM rescaled to the library size).
    """
    j = tx.join(tx2gene.select("tx", "gene_id"), "tx")
    g = j.groupBy("gene_id", "sample").agg(
        F.sum("counts").alias("counts"), F.sum("tpm").alias("abundance"),
        F.try_divide(F.sum(F.col("tpm") * F.col("length")), F.sum("tpm")).alias("length"))
    if method == "no":
        return g
    lib = g.groupBy("sample").agg(F.sum("counts").alias("_lib"))
    g = g.join(lib, "sample")
    if method == "scaledTPM":
        val = F.col("abundance")
    else:
        mean_len = g.groupBy("gene_id").agg(F.avg("length").alias("_ml"))
        g = g.join(mean_len, "gene_id")
        val = F.col("abundance") * F.col("_ml")
    g = g.withColumn("_v", val)
    tot = g.groupBy("sample").agg(F.sum("_v").alias("_tot"))
    return g.join(tot, "sample").withColumn("counts", F.col("_v") / F.col("_tot") * F.col("_lib")).drop(
        "_v", "_tot", "_lib", "_ml")


# --------------------------------------------------------------------------- matrices

def counts_merge(quants: DataFrame, samples: list[str], feature: str = "gene_id", value: str = "n") -> DataFrame:
    """Per-sample count tables -> one wide matrix joined by id (not by row position).

    The sample list is given, so ``pivot`` needs no extra distinct pass; features
    missing in a sample get 0.
    """
    w = quants.groupBy(feature).pivot("sample", samples).agg(F.sum(value))
    return w.fillna(0, subset=samples)


def biotype_pct(counts: DataFrame, features: list[str], sample: str = "sample", ftype: str = "biotype",
                value: str = "n") -> DataFrame:
    """Per sample: share (%) of counts per feature type, for the asked types; absent -> 0."""
    c = counts.groupBy(sample, ftype).agg(F.sum(value).alias("_n"))
    tot = c.groupBy(sample).agg(F.sum("_n").alias("_t"))
    grid = tot.withColumn(ftype, F.explode(F.array(*[F.lit(f) for f in features])))
    out = grid.join(c, [sample, ftype], "left")
    return out.select(sample, ftype, F.coalesce(F.col("_n") / F.col("_t") * 100.0, F.lit(0.0)).alias("percent"))


def size_factors(counts: DataFrame, feature: str = "gene_id", sample: str = "sample", value: str = "n") -> DataFrame:
    """DESeq median-of-ratios size factors (Anders & Huber 2010).

    Counts are rounded; genes with a zero (or missing) count in any sample are left
    out of the geometric means. Per sample: exp(median over genes of
    ln(count) - mean ln(count of the gene)). The median is exact and found by counting
    (``exact_median``): no task holds the genes of a sample.
    """
    c = counts.groupBy(feature, sample).agg(F.round(F.sum(value)).alias("_c"))
    n_samples = c.select(sample).distinct().count()  # a scalar, not data through the driver
    g = c.filter(F.col("_c") > 0).groupBy(feature).agg(
        F.count("*").alias("_k"), F.avg(F.ln("_c")).alias("_lg"))
    g = g.filter(F.col("_k") == n_samples).select(feature, "_lg")
    r = c.join(g, feature).withColumn("_r", F.ln("_c") - F.col("_lg"))
    return exact_median(r, [sample], "_r").select(sample, F.exp("median").alias("size_factor"))


def filter_normalise(triples: DataFrame, min_genes: int = 200, min_cells: int = 3, feature: str = "feature",
                     cell: str = "cell", value: str = "n", scale: float = 1e4) -> DataFrame:
    """Keep cells with >= ``min_genes`` genes, then genes seen in >= ``min_cells`` of those cells (the
    order of the object constructor that the pipeline calls: features a cell first); value ->
    ln(1 + value / cell total * scale), the total being over the genes that are left."""
    t = triples.filter(F.col(value) > 0)
    cells = t.groupBy(cell).agg(F.count("*").alias("_ng")).filter(F.col("_ng") >= min_genes).select(cell)
    t = t.join(cells, cell, "left_semi")
    genes = t.groupBy(feature).agg(F.count("*").alias("_nc")).filter(F.col("_nc") >= min_cells).select(feature)
    t = t.join(genes, feature, "left_semi")
    t = t.join(t.groupBy(cell).agg(F.sum(value).alias("_tot")), cell)
    return t.withColumn("norm", F.log1p(F.col(value) / F.col("_tot") * scale)).drop("_tot")


def variable_genes(norm: DataFrame, n_cells: int | None = None, lo: float = 0.0125, hi: float = 3.0,
                   min_disp: float = 0.5, bins: int = 20, feature: str = "feature", cell: str = "cell",
                   value: str = "norm") -> DataFrame:
    """Mean/dispersion gene selection (Seurat ``mean.var.plot`` rule).

    Moments count the implicit zeros of cells without the gene. ExpMean =
    ln(1 + mean(expm1 x)), LogVMR = ln(var / mean), genes binned in ``bins``
    equal-width ExpMean bins; dispersion z-scored in its bin.
    """
    if n_cells is None:
        n_cells = norm.select(cell).distinct().count()
    n = float(n_cells)
    x = F.expm1(F.col(value))
    m = norm.groupBy(feature).agg(F.sum(x).alias("_s1"), F.sum(x * x).alias("_s2"))
    m = m.withColumn("_mean", F.col("_s1") / n).withColumn(
        "_var", (F.col("_s2") - n * F.col("_mean") * F.col("_mean")) / (n - 1))
    m = m.withColumn("exp_mean", F.log1p("_mean")).withColumn(
        "log_vmr", F.ln(F.try_divide(F.col("_var"), F.col("_mean"))))
    lo_hi = m.agg(F.min("exp_mean"), F.max("exp_mean")).first()  # two scalars
    m = m.withColumn("_lo", F.lit(lo_hi[0])).withColumn("_hi", F.lit(lo_hi[1]))
    width = (F.col("_hi") - F.col("_lo")) / bins
    m = m.withColumn("bin", F.least(F.greatest(F.ceil((F.col("exp_mean") - F.col("_lo")) / width), F.lit(1)),
                                    F.lit(bins)).cast("int"))
    st = m.groupBy("bin").agg(F.avg("log_vmr").alias("_bm"), F.stddev_samp("log_vmr").alias("_bs"))
    m = m.join(st, "bin").withColumn("disp_z", (F.col("log_vmr") - F.col("_bm")) / F.col("_bs"))
    m = m.withColumn("variable", (F.col("exp_mean") > lo) & (F.col("exp_mean") < hi) & (F.col("disp_z") >= min_disp))
    return m.select(feature, "exp_mean", "log_vmr", "bin", "disp_z", "variable")


def top_variance(log_counts: DataFrame, n: int = 500, feature: str = "gene_id", value: str = "v",
                 sample: str = "sample") -> DataFrame:
    """The ``n`` features of highest variance over all samples of the table (ties by feature id). A
    feature that a sample lacks is 0 there: sums of the stored values and the number of samples
    give the variance, so nothing is filled in."""
    x = log_counts.groupBy(feature, sample).agg(F.sum(F.col(value).cast("double")).alias("_x"))
    n_samples = float(log_counts.select(sample).distinct().count())
    v = x.groupBy(feature).agg(F.sum("_x").alias("_s"), F.avg("_x").alias("_m"), F.count("_x").alias("_k"), F.coalesce(F.var_pop("_x"), F.lit(0.0)).alias("_v"))
    # Variance of the k stored values and n - k zeros from the mean and variance of the stored ones.
    both = F.col("_k") * F.col("_v") + F.col("_k") * (n_samples - F.col("_k")) / F.lit(n_samples) * F.col("_m") * F.col("_m")
    v = v.select(feature, (both / F.lit(n_samples - 1) if n_samples > 1 else F.lit(None).cast("double")).alias("variance"))
    return v.orderBy(F.col("variance").desc(), F.col(feature)).limit(n)


def sample_distance(log_counts: DataFrame, feature: str = "gene_id", sample: str = "sample",
                    value: str = "v") -> DataFrame:
    """Euclidean distance of every pair of samples over genes; a gene that a sample lacks is 0.

    Samples are few (a design matrix), genes many: the self join is on the gene, and genes of
    one sample only enter through its sum of squares. Every pair of samples is an answer, so
    pairs without a common gene are listed from the samples.
    """
    a = log_counts.select(F.col(feature), F.col(sample).alias("s1"), F.col(value).alias("v1"))
    b = log_counts.select(F.col(feature), F.col(sample).alias("s2"), F.col(value).alias("v2"))
    both = a.join(b, feature).groupBy("s1", "s2").agg(
        F.sum((F.col("v1") - F.col("v2")) ** 2).alias("gap"), F.sum(F.col("v1") ** 2).alias("q1"), F.sum(F.col("v2") ** 2).alias("q2"))
    own = log_counts.groupBy(F.col(sample).alias("s")).agg(F.sum(F.col(value) ** 2).alias("q"))
    pairs = (own.agg(F.collect_list(F.struct("s", "q")).alias("x")).select(F.explode("x").alias("a"), "x")
             .select("a", F.explode("x").alias("b")).select(
                 F.col("a.s").alias("s1"), F.col("a.q").alias("t1"), F.col("b.s").alias("s2"), F.col("b.q").alias("t2")))
    rest = F.col("t1") - F.coalesce("q1", F.lit(0.0)) + F.col("t2") - F.coalesce("q2", F.lit(0.0))
    return pairs.join(both, ["s1", "s2"], "left").select(
        "s1", "s2", F.sqrt(F.coalesce("gap", F.lit(0.0)) + F.greatest(rest, F.lit(0.0))).alias("distance"))


def name_factors(samples: DataFrame, col: str = "sample") -> DataFrame:
    """Sample names split on ``_`` into factors; factors that are constant or all
    distinct are dropped (names with a different number of parts give none)."""
    p = samples.select(col, F.posexplode(F.split(col, "_")).alias("pos", "level"))
    n_samples = samples.select(col).distinct().count()  # scalars only
    n_shapes = samples.select(F.size(F.split(col, "_")).alias("k")).distinct().count()
    if n_shapes != 1:
        return p.limit(0).select(col, (F.col("pos") + 1).alias("factor"), "level")
    stats = p.groupBy("pos").agg(F.count_distinct("level").alias("n_levels"))
    good = stats.filter((F.col("n_levels") > 1) & (F.col("n_levels") < n_samples)).select("pos")
    return p.join(good, "pos").select(col, (F.col("pos") + 1).alias("factor"), "level")


def with_symbols(features: DataFrame, t2g_rows: DataFrame) -> DataFrame:
    """Features joined to the first symbol seen for their gene (left join)."""
    first = t2g_rows.groupBy("gene_id").agg(F.min_by("name", "ord").alias("symbol"))
    return features.join(first, "gene_id", "left")


def with_sample_meta(cells: DataFrame, sheet: DataFrame, key: str = "sample") -> DataFrame:
    """Cells left-joined to the sample sheet collapsed per sample (sorted distinct
    values joined by ``,``)."""
    cols = [c for c in sheet.columns if c != key]
    coll = sheet.groupBy(key).agg(*[F.array_join(F.sort_array(F.collect_set(c)), ",").alias(c) for c in cols])
    return cells.join(coll, key, "left")


def mtx_triples(triples: DataFrame, feature: str = "feature", cell: str = "cell", value: str = "n"):
    """Triples -> (matrix rows with 1-based ids, barcodes, features) for MatrixMarket
    files; ids are ranks of the sorted distinct names (range-partitioned, not one task)."""
    f = rank_within(triples.select(feature).distinct(), [], [feature], "fid")
    c = rank_within(triples.select(cell).distinct(), [], [cell], "cid")
    m = triples.join(f, feature).join(c, cell).select("fid", "cid", value)
    return m, c, f
