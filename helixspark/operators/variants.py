"""Variant warehouse jobs: the four table layouts, their lookups and the Ti/Tv query.

Input is a *record* DataFrame, one row per VCF record::

    file_id, chrom, pos, vcf_id, ref, alt, qual, filter, info, format,
    sample_names array<string>, sample_values array<string>

as produced by ``sources.vcf.read_vcf`` (or any DataFrame of that shape). Raw VCF
text values are kept until a layout normalises them (P6).

Ids are deterministic (md5 of content), so reloading a file is an upsert rather than
a second copy: ``variant_id = md5(file_id:chrom:pos:ref:alt)``, ``sample_id = md5(name)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from helixspark.functions import vcf as V
from helixspark.session import written_once

# Partition counts of the layouts (fixed values of the table designs).
LINK_BUCKETS = 32
REGION_POS_BUCKETS = 128
SAMPLE_BUCKETS = 128
POS_BIN = 1_000_000


def bucket(col: Column, n: int) -> Column:
    """Hash bucket column (Spark ``xxhash64``), for files laid out by bucket."""
    return F.pmod(F.xxhash64(col), F.lit(n)).cast("int")


# --------------------------------------------------------------------------- P6, P1

def normalise_missing(vcf: DataFrame) -> DataFrame:
    """P6: ``.`` id/filter -> null, ``.`` ALT -> '', QUAL to double (bad text -> null)."""
    return (
        vcf.withColumn("vcf_id", V.null_if_dot("vcf_id"))
        .withColumn("alt", V.alt_or_empty("alt"))
        .withColumn("qual", V.qual_double("qual"))
        .withColumn("filter", V.null_if_dot("filter"))
    )


def with_info_map(vcf: DataFrame, name: str = "info_m") -> DataFrame:
    return vcf.withColumn(name, V.info_map("info"))


# --------------------------------------------------------------------------- P3, P7

def _sample_axis(vcf: DataFrame) -> DataFrame:
    """No sample column in the file -> one sample named after the file."""
    base = F.regexp_extract(F.col("file_id"), r"([^/]*?)(\.[^/]*)?$", 1)
    return vcf.withColumn(
        "sample_names",
        F.when(F.size("sample_names") > 0, F.col("sample_names")).otherwise(F.array(base)),
    )


def genotype_rows(vcf: DataFrame) -> DataFrame:
    """P3: one row per (record, sample) with FORMAT map and GT (``./.`` when absent).

    A record with FORMAT but fewer sample columns than names gets ``./.`` and an
    empty map for the missing samples (no error).
    """
    return _with_calls(_sample_rows(vcf)).withColumn("sample_id", F.md5(F.col("sample_name")))


def _sample_rows(vcf: DataFrame) -> DataFrame:
    """One row per (record, sample) with the sample's text as ``sample_value``."""
    v = _sample_axis(vcf)
    v = v.select("*", F.posexplode("sample_names").alias("sample_idx", "sample_name"))
    return v.withColumn("sample_value", F.get(F.col("sample_values"), F.col("sample_idx"))).drop("sample_names", "sample_values")


def _with_calls(rows: DataFrame) -> DataFrame:
    """FORMAT map and GT of ``sample_value`` in its place."""
    return (
        rows.withColumn("attributes", V.format_map("format", "sample_value"))
        .withColumn("genotype", V.genotype("attributes"))
        .drop("sample_value")
    )


def select_samples(rows: DataFrame, name: str | None) -> DataFrame:
    """P7 on genotype rows: keep ``name`` where the file has it; files without it keep all.

    The per-file test is a grouped ``bool_or`` (one row per file, map-side combined),
    joined back; no window holds a whole file in one task.
    """
    if not name:
        return rows
    has = rows.groupBy("file_id").agg(F.bool_or(F.col("sample_name") == name).alias("_has"))
    return (
        rows.join(has, "file_id")
        .filter(~F.col("_has") | (F.col("sample_name") == name))
        .drop("_has")
    )


# --------------------------------------------------------------------------- layouts

#: (partition columns, sort columns) of each stored table.
STORED_ORDER = {
    (1, "variants"): (["chrom"], ["pos"]),
    (1, "samples"): ([], ["sample_id"]),
    (1, "variant_samples"): (["variant_id_bucket"], ["sample_id"]),
    (2, "variant_regions"): (["chrom", "pos_bin"], ["pos"]),
    (3, "genomic_variants"): (["sample_bucket", "chrom"], ["chrom", "pos"]),
    (4, "variants"): (["chrom", "pos_bin"], ["pos"]),
    (4, "samples"): ([], ["sample_id"]),
    (4, "variant_samples"): (["chrom", "pos_bin"], ["pos"]),
}


def in_stored_order(df: DataFrame, layout: int, name: str) -> DataFrame:
    """``df`` range-partitioned and sorted as the table stands in its files.

    Ranges on (partition columns, sort columns): a large chromosome or bucket is split over many
    tasks, each writing files with disjoint, sorted position ranges (tight Parquet min/max for
    region scans)."""
    parts, order = STORED_ORDER[(layout, name)]
    return df.repartitionByRange(*parts, *order).sortWithinPartitions(*parts, *order)


def _placed(rows: DataFrame, layout: int, name: str, ordered: bool) -> DataFrame:
    """Raw rows of a table, in its stored order if asked. The maps are made behind this step: finding
    the ranges takes a pass of its own, and raw text is smaller in the shuffle than maps."""
    return in_stored_order(rows, layout, name) if ordered else rows


def variant_id(alt_col: str = "alt") -> Column:
    return V.stable_id("file_id", "chrom", "pos", "ref", alt_col)


def samples_table(vcf: DataFrame) -> DataFrame:
    """Distinct samples of the records (partial aggregation before the shuffle)."""
    v = _sample_axis(vcf)
    return (
        v.select(F.explode("sample_names").alias("sample_name"))
        .distinct()
        .select(F.md5("sample_name").alias("sample_id"), "sample_name")
    )


def to_layout1(vcf: DataFrame, ordered: bool = False) -> dict[str, DataFrame]:
    """Normalised layout: variants, samples, variant_samples. ``ordered`` (here and in the other
    layouts): the big tables come in their stored order, for ``write_layout(..., ordered=True)``."""
    v = normalise_missing(vcf)
    variants = v.select("file_id", "chrom", "pos", "vcf_id", "ref", "alt", "qual", "filter", "info")
    variants = _placed(variants, 1, "variants", ordered).select(
        variant_id().alias("variant_id"), "chrom", "pos", "vcf_id", "ref", "alt", "qual", "filter", V.info_map("info").alias("info")
    )
    links = _sample_rows(v.withColumn("variant_id", variant_id())).select(
        "variant_id", F.md5("sample_name").alias("sample_id"), "format", "sample_value", "info",
        bucket(F.col("variant_id"), LINK_BUCKETS).alias("variant_id_bucket"))
    links = _with_calls(_placed(links, 1, "variant_samples", ordered)).select(
        "variant_id",
        "sample_id",
        "genotype",
        "attributes",
        V.is_ref_block(V.info_map("info")).alias("is_reference_block"),
        "variant_id_bucket",
    )
    return {"variants": variants, "samples": samples_table(vcf), "variant_samples": links}


def to_layout2(vcf: DataFrame, bin_size: int = POS_BIN, ordered: bool = False) -> DataFrame:
    """Regions: one row per record, sample ids -> names and ids -> GT as maps."""
    v = _sample_axis(normalise_missing(vcf)).select(
        "chrom", "pos", "ref", "alt", "qual", "filter", "info", "format", "sample_names", "sample_values", V.pos_bin("pos", bin_size).alias("pos_bin"))
    v = _placed(v, 2, "variant_regions", ordered).withColumn("info_m", V.info_map("info"))
    ids = F.transform("sample_names", lambda n: F.md5(n))
    gts = F.transform(
        "sample_names",
        lambda n, i: V.genotype(V.format_map(F.col("format"), F.get(F.col("sample_values"), i))),
    )
    return v.select(
        "chrom",
        "pos",
        "ref",
        "alt",
        "qual",
        "filter",
        F.col("info_m").alias("info"),
        F.map_from_arrays(ids, F.col("sample_names")).alias("sample_ids"),
        F.map_from_arrays(ids, gts).alias("sample_genotypes"),
        V.is_ref_block("info_m").alias("is_reference_block"),
        "pos_bin",
    )


def to_layout3(vcf: DataFrame, sample: str | None = None, ordered: bool = False) -> DataFrame:
    """Denormalised: one row per (record, sample); ALT kept as a list; ``.`` id kept."""
    rows = select_samples(_sample_rows(vcf), sample).select(
        F.md5("sample_name").alias("sample_id"), "sample_name", "vcf_id", "chrom", "pos", "ref", "alt", "qual", "filter", "info", "format", "sample_value")
    rows = rows.withColumn("sample_bucket", bucket(F.col("sample_id"), SAMPLE_BUCKETS))
    rows = _with_calls(_placed(rows, 3, "genomic_variants", ordered)).withColumn("info_m", V.info_map("info"))
    return rows.select(
        "sample_id",
        "sample_name",
        F.col("vcf_id").alias("variant_name"),
        "chrom",
        "pos",
        "ref",
        F.transform(F.split("alt", ","), V.alt_or_empty).alias("alt"),
        V.qual_double("qual").alias("qual"),
        V.null_if_dot("filter").alias("filter"),
        "genotype",
        F.col("info_m").alias("info"),
        "attributes",
        V.is_ref_block("info_m").alias("is_reference_block"),
        "sample_bucket",
    )


LAYOUT3_KEY = ("sample_id", "variant_name", "chrom", "pos")


def explode_alts(vcf: DataFrame) -> DataFrame:
    """P5: one row per ALT allele (``.`` -> ''), with its 0-based index."""
    return vcf.select(
        "*", F.posexplode(F.split("alt", ",")).alias("alt_idx", "_alt")
    ).withColumn("alt", V.alt_or_empty("_alt")).drop("_alt")


def to_layout4(vcf: DataFrame, ordered: bool = False) -> dict[str, DataFrame]:
    """Row per ALT, an id per ALT (so a 3-ALT record joins to 3 link rows, not 9)."""
    v = explode_alts(normalise_missing(vcf)).withColumn("pos_bin", V.pos_bin("pos", POS_BIN))
    variants = v.select("file_id", "chrom", "pos", "vcf_id", "ref", "alt", "qual", "filter", "info", "pos_bin")
    variants = _placed(variants, 4, "variants", ordered).select(
        variant_id().alias("variant_id"), "chrom", "pos", "vcf_id", "ref", "alt", "qual", "filter", V.info_map("info").alias("info"), "pos_bin",
    )
    links = _sample_rows(v).select("file_id", "chrom", "pos", "ref", "alt", "sample_name", "format", "sample_value", "info", "pos_bin")
    links = _with_calls(_placed(links, 4, "variant_samples", ordered)).select(
        variant_id().alias("variant_id"), F.md5("sample_name").alias("sample_id"), "chrom", "pos", "genotype", "attributes",
        V.is_ref_block(V.info_map("info")).alias("is_reference_block"), "pos_bin",
    )
    return {"variants": variants, "samples": samples_table(vcf), "variant_samples": links}


def upsert(old: DataFrame, new: DataFrame, keys=LAYOUT3_KEY, version: str = "version") -> DataFrame:
    """Keep the newest row per key (highest ``version``; ties broken by all other columns that
    can be ordered). A grouped ``max_by``: rows of a key are reduced before the shuffle."""
    return _newest(old.unionByName(new), keys, version)


def _newest(u: DataFrame, keys, version: str) -> DataFrame:
    rest = [c for c in u.columns if c not in keys]
    tie = [c for c in rest if c != version and not isinstance(u.schema[c].dataType, MapType)]
    g = u.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(version, *tie)).alias("_r"))
    return g.select(*keys, "_r.*").select(*u.columns)


def upsert_layout3(spark: SparkSession, path: str, new: DataFrame, version: str = "version") -> None:
    """Merge ``new`` rows into the stored layout 3 under ``path``: only the (bucket, chromosome)
    folders that the new rows touch are read and overwritten.

    The touched folders are found first and named to the scan as a literal filter on the partition
    columns, so the listing is pruned whatever ``new`` is. At most ``SAMPLE_BUCKETS`` buckets a
    chromosome come to the driver, as one array per chromosome.

    All rows go through one exchange: in the stored order the rows of a key stand together, as its
    folder and position are part of it, so they are merged there and written as they come. Folders
    are replaced at the end of the write only, so the old rows can be read until then."""
    new = written_once(new, "upsert-new")
    touched = new.groupBy("chrom").agg(F.sort_array(F.collect_set("sample_bucket")).alias("b")).collect()
    stored = spark.read.parquet(f"{path}/layout3/genomic_variants")
    old = stored.filter(touched_folders(touched)).select(*[F.col(c).cast(new.schema[c].dataType).alias(c) for c in new.columns])
    u = old.unionByName(new).repartitionByRange("sample_bucket", "chrom", "pos")
    merged = _newest(u, ("sample_bucket", "chrom", "pos", *[k for k in LAYOUT3_KEY if k not in ("chrom", "pos")]), version)
    write_layout(merged, path, 3, ordered=True)


def touched_folders(touched: list) -> Column:
    """A filter on the partition columns: chromosomes with the same buckets are named together."""
    by_buckets: dict[tuple, list] = {}
    for r in touched:
        by_buckets.setdefault(tuple(r["b"]), []).append(r["chrom"])
    cond = F.lit(False)
    for buckets, chroms in by_buckets.items():
        named = F.col("chrom").isin([c for c in chroms if c is not None])
        if None in chroms:
            named = named | F.col("chrom").isNull()
        cond = cond | (named & F.col("sample_bucket").isin(list(buckets)))
    return cond


def stored_layout(spark: SparkSession, tables: dict[str, DataFrame] | DataFrame, path: str, layout: int, ordered: bool = False) -> dict[str, DataFrame]:
    """Write a layout and read its tables back with the written column types."""
    write_layout(tables, path, layout, ordered=ordered)
    if isinstance(tables, DataFrame):
        tables = {"variant_regions" if layout == 2 else "genomic_variants": tables}
    out = {}
    for name, df in tables.items():
        r = spark.read.parquet(f"{path}/layout{layout}/{name}")
        # only partition columns come back with a guessed type
        out[name] = r.select(*[F.col(f.name) if r.schema[f.name].dataType.simpleString() == f.dataType.simpleString()
                               else F.col(f.name).cast(f.dataType).alias(f.name) for f in df.schema])
    return out


def write_layout(tables: dict[str, DataFrame] | DataFrame, path: str, layout: int, mode: str = "overwrite", ordered: bool = False) -> None:
    """Write a layout as partitioned Parquet (dynamic partition overwrite), each table in its stored
    order (see ``in_stored_order``). ``ordered``: the tables come from a layout function that was
    asked for that order, so only the samples are arranged here.
    """
    if isinstance(tables, DataFrame):
        tables = {"variant_regions" if layout == 2 else "genomic_variants": tables}
    for name, df in tables.items():
        parts, _ = STORED_ORDER[(layout, name)]
        out = df if ordered and parts else in_stored_order(df, layout, name)
        w = out.write.mode(mode).option("maxRecordsPerFile", 5_000_000).option("partitionOverwriteMode", "dynamic")
        if parts and mode == "overwrite":
            # folders are staged until the job's end anyway, so tasks may move their files there
            # themselves: the driver then moves whole folders only
            w = w.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        if parts:
            w = w.partitionBy(*parts)
        w.parquet(f"{path}/layout{layout}/{name}")


# --------------------------------------------------------------------------- queries

def in_region(df: DataFrame, chrom: str, start: int, end: int, bin_size: int = POS_BIN) -> DataFrame:
    """P8: rows on ``chrom`` with ``start <= pos <= end``.

    Adds the matching ``pos_bin`` range when the table has it, so a table partitioned
    by (chrom, pos_bin) prunes directories, and Parquet min/max on sorted ``pos``
    skips row groups.
    """
    cond = (F.col("chrom") == chrom) & F.col("pos").between(start, end)
    if "pos_bin" in df.columns:
        cond = cond & F.col("pos_bin").between(start // bin_size, end // bin_size)
    return df.filter(cond)


def genotypes(variants: DataFrame, links: DataFrame, samples: DataFrame) -> DataFrame:
    """Layout-1 genotype lookup: variants x link x samples (samples are small: broadcast
    is left to AQE's size check)."""
    return (
        links.join(variants, "variant_id")
        .join(samples, "sample_id")
        .select("chrom", "pos", "ref", "alt", "sample_name", "genotype", "variant_id", "sample_id")
    )


def typed_info(df: DataFrame, types: dict[str, str], col: str = "info") -> DataFrame:
    """P9: one typed column per declared INFO key (header Type Integer/Float/Flag/String)."""
    m = V.info_map(col) if dict(df.dtypes)[col] == "string" else F.col(col)
    cast = {"Integer": "bigint", "Float": "double", "String": "string", "Character": "string"}
    out = df
    for key, typ in types.items():
        if typ == "Flag":
            c = F.map_contains_key(m, F.lit(key))
        else:
            c = F.try_element_at(m, F.lit(key)).try_cast(cast.get(typ, "string"))
        out = out.withColumn(f"info_{key.lower()}", c)
    return out


def _expected(number, n_alt, ploidy):
    """Number of values that a header's ``Number`` asks for; null where any number will do.
    A: one per ALT, R: one per allele, G: one per genotype of the ploidy (1 or 2)."""
    alleles = n_alt + 1
    return (F.when(number.rlike("^[0-9]+$"), number.try_cast("int")).when(number == "A", n_alt).when(number == "R", alleles)
            .when(number == "G", F.when(ploidy == 1, alleles).otherwise(F.floor(alleles * (alleles + 1) / 2).cast("int"))))


def typed_fields(records: DataFrame, info_defs: DataFrame, format_defs: DataFrame) -> DataFrame:
    """P9 for whole headers: every INFO and FORMAT value of VCF records with the type and number that
    its own file declares.

    ``records`` as of ``read_vcf``, the definitions as of ``vcf_header`` (file_id, id, number, type).
    One row per record and INFO key, and per record, sample and FORMAT key: (file_id, chrom, pos,
    ref, alt, scope, sample_name, key, type, number, ints, floats, strings, well_formed). The array
    of the declared type (Integer, Float, or String and Character) holds the comma-separated values,
    ``.`` and values that do not parse are null elements, the other two arrays are null; a Flag has
    none and stands for itself. ``well_formed`` tells whether as many values stand as the header
    asks for (a missing value ``.`` always may); it is null where any number may stand and for keys
    that the header does not declare, which are strings. The first definition of an id counts.
    """
    n_alt = F.when(F.col("alt").isin("", "."), F.lit(0)).otherwise(F.size(F.split("alt", ","))).cast("int")
    base = ["file_id", "chrom", "pos", "ref", "alt"]
    info = records.select(*base, n_alt.alias("_n_alt"), F.lit("INFO").alias("scope"), F.lit(None).cast("string").alias("sample_name"),
                          F.lit(2).alias("_ploidy"), F.explode(V.info_map("info")).alias("key", "_raw"))
    zipped = F.transform("sample_names", lambda n, i: F.struct(n.alias("n"), F.get(F.col("sample_values"), i).alias("v")))
    cells = records.select(*base, n_alt.alias("_n_alt"), "format", F.explode(zipped).alias("s"))
    cells = cells.select(*base, "_n_alt", F.lit("FORMAT").alias("scope"), F.col("s.n").alias("sample_name"),
                         V.format_map(F.col("format"), F.col("s.v")).alias("_m"))
    ploidy = F.size(F.split(F.coalesce(F.try_element_at("_m", F.lit("GT")), F.lit("./.")), "[/|]")).alias("_ploidy")
    cells = cells.select(*base, "_n_alt", "scope", "sample_name", ploidy, F.explode("_m").alias("key", "_raw"))

    def declared(scope: str, defs: DataFrame) -> DataFrame:
        d = defs.groupBy("file_id", F.col("id").alias("key")).agg(F.first("type").alias("type"), F.first("number").alias("number"))
        return d.withColumn("scope", F.lit(scope))

    # a row per file and key, written: its size is known, so while it is small no value is shuffled
    defs = written_once(declared("INFO", info_defs).unionByName(declared("FORMAT", format_defs)), "vcf-fields")
    t = info.unionByName(cells).join(defs, ["file_id", "scope", "key"], "left")
    values = F.when(F.col("type").eqNullSafe("Flag"), None).otherwise(F.transform(F.split("_raw", ","), lambda x: F.nullif(x, F.lit("."))))
    t = t.withColumn("_v", values).withColumn("_want", _expected(F.col("number"), F.col("_n_alt"), F.col("_ploidy")))
    kind = lambda types: F.coalesce(F.col("type"), F.lit("String")).isin(*types)
    have = F.when(F.col("type") == "Flag", 0).otherwise(F.size("_v"))
    return t.select(
        *base, "scope", "sample_name", "key", "type", "number",
        F.when(kind(["Integer"]), F.transform("_v", lambda x: x.try_cast("bigint"))).alias("ints"),
        F.when(kind(["Float"]), F.transform("_v", lambda x: x.try_cast("double"))).alias("floats"),
        F.when(kind(["String", "Character"]), F.col("_v")).alias("strings"),
        F.when(F.col("_raw") == ".", F.lit(True)).otherwise(have == F.col("_want")).alias("well_formed"))


def to_store(vcf: DataFrame) -> DataFrame:
    """Managed variant-store rows: (sampleid, referenceallele, alternatealleles, calls, filters)."""
    rows = genotype_rows(vcf)
    return rows.select(
        F.col("sample_name").alias("sampleid"),
        "chrom",
        "pos",
        F.col("ref").alias("referenceallele"),
        F.split("alt", ",").alias("alternatealleles"),
        V.gt_calls("genotype").alias("calls"),
        F.split("filter", ";").alias("filters"),
    )


def titv(store: DataFrame) -> DataFrame:
    """Flagship: transition / transversion ratio per sample over PASS SNVs.

    Weight 2 when both calls are equal (homozygous, 0/0 included), else 1; every ALT
    of the record counts. Null when a sample has no transversion. One shuffle of
    per-sample partial sums (map-side combine), so a sample holding a third of all
    rows costs nothing extra.
    """
    calls = F.col("calls")
    w = F.when((F.size(calls) == 2) & (F.get(calls, 0) == F.get(calls, 1)), 2).otherwise(1)
    s = store.filter(F.get(F.col("filters"), 0) == "PASS").select(
        "sampleid", F.col("referenceallele").alias("r"), w.alias("w"),
        F.explode("alternatealleles").alias("a"),
    ).filter((F.length("r") == 1) & (F.length("a") == 1))
    ct, ag = ["C", "T"], ["A", "G"]
    r, a = F.col("r"), F.col("a")
    ti = ((r.isin(ct) & a.isin(ct)) | (r.isin(ag) & a.isin(ag)))
    tv = ((r.isin(ct) & a.isin(ag)) | (r.isin(ag) & a.isin(ct)))
    agg = s.groupBy("sampleid").agg(
        F.sum(F.when(ti, F.col("w")).otherwise(0)).alias("ti"),
        F.sum(F.when(tv, F.col("w")).otherwise(0)).alias("tv"),
    )
    return agg.select("sampleid", F.try_divide(F.col("ti").cast("double"), F.col("tv")).alias("titv_ratio"))


def annotations_for(ann: DataFrame, term: str, snv_only: bool = True) -> DataFrame:
    """Annotation-store query: rows whose CLNDISDB mentions ``term``; SNVs with one ALT."""
    attrs = F.col("attributes")
    disdb = F.try_element_at(attrs, F.lit("CLNDISDB"))
    cond = disdb.contains(term)
    if snv_only:
        cond = cond & (F.length("referenceallele") == 1) & (F.size("alternatealleles") == 1) & (
            F.length(F.get(F.col("alternatealleles"), 0)) == 1
        )
    return ann.filter(cond).select(
        F.concat(F.lit("chr"), F.col("contigname")).alias("contigname"),
        "start",
        "referenceallele",
        "alternatealleles",
        F.try_element_at(attrs, F.lit("GENEINFO")).alias("gene_info"),
        F.try_element_at(attrs, F.lit("CLNSIG")).alias("clinical_significance"),
        F.regexp_extract_all(disdb, F.lit(r"SNOMED_CT:\d+"), 0).alias("snomed_ct"),
        F.try_element_at(attrs, F.lit("CLNDN")).alias("disease_name"),
    )


def annotate(variants: DataFrame, ann: DataFrame) -> DataFrame:
    """Left join variants (one row per ALT) to annotations on (chrom, pos, ref, alt).

    Annotation contigs get the ``chr`` prefix first. Both sides shuffle on the
    4-column key; AQE splits a hot key.
    """
    a = ann.select(
        F.when(F.col("contigname").startswith("chr"), F.col("contigname"))
        .otherwise(F.concat(F.lit("chr"), F.col("contigname"))).alias("chrom"),
        F.col("start").alias("pos"),
        F.col("referenceallele").alias("ref"),
        F.explode("alternatealleles").alias("alt"),
        "attributes",
    )
    return variants.join(a, ["chrom", "pos", "ref", "alt"], "left")
