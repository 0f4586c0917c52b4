"""Row-set validation: each check returns the accepted rows and a reject table.

Rules are columns: a row is rejected by the first rule that holds (row rules,
then duplicate rules, then per-sample rules). The reject table is
``(ord, rule, message)``. Per-sample facts are grouped aggregates joined back,
never a window over a whole sample.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixspark.operators.common import empty, first_true, rank_within
from helixspark.operators.taxonomy import TOOLS

# Fixed vocabularies and suffixes of the sample-sheet formats.
STRANDEDNESS = ["unstranded", "forward", "reverse", "auto"]
FASTQ_EXT = [".fastq.gz", ".fq.gz"]
MESSAGES = {
    "populated_columns": "too few columns hold a value",
    "sample_missing": "the sample name is empty",
    "unknown_column": "the sheet has a column that is not known",
    "expected_cells": "the expected number of cells is not a whole number",
    "fastq_space": "there is a space in a FASTQ path",
    "fastq_extension": "a FASTQ path ends in neither .fastq.gz nor .fq.gz",
    "fastq_1_missing": "the first FASTQ path is empty",
    "strandedness_missing": "the strandedness is empty",
    "strandedness_invalid": "the strandedness is not one of the known words",
    "invalid_combination": "these columns cannot be filled together",
    "duplicate_row": "an earlier row says the same",
    "pair_extension": "the two files of a pair end differently",
    "sample_fastq_not_unique": "an earlier row has this sample and file",
    "mixed_datatype": "the runs of this sample mix single and paired reads",
    "mixed_strandedness": "the runs of this sample differ in strandedness",
}


def _ends_any(c, exts):
    out = F.lit(False)
    for e in exts:
        out = out | F.col(c).endswith(e)
    return out


def _fastq_rules(cols):
    rules = []
    for c in cols:
        rules.append((f"fastq_space", ~empty(c) & F.col(c).contains(" ")))
    for c in cols:
        rules.append((f"fastq_extension", ~empty(c) & ~_ends_any(c, FASTQ_EXT)))
    return rules


def _split(df: DataFrame, rule_col: str = "rule"):
    ok = df.filter(F.col(rule_col).isNull()).drop(rule_col)
    rej = df.filter(F.col(rule_col).isNotNull()).select(
        "ord", F.col(rule_col).alias("rule"),
        F.element_at(F.create_map(*[x for k, v in MESSAGES.items() for x in (F.lit(k), F.lit(v))]),
                     F.col(rule_col)).alias("message"))
    return ok, rej


def _clean(sheet: DataFrame, cols) -> DataFrame:
    out = sheet
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.trim(F.regexp_replace(F.col(c), '^"|"$', "")), F.lit("")))
    return out


def _later_duplicate(df: DataFrame, key: list[str]) -> DataFrame:
    """Flag rows whose key was already seen on an earlier line (first stays)."""
    first = df.groupBy(*key).agg(F.min("ord").alias("_first"))
    return df.join(first, key, "left").withColumn("_dup", F.col("ord") > F.col("_first")).drop("_first")


def _sample_rules(df: DataFrame, checks: list[tuple[str, str]]) -> DataFrame:
    """Per-sample rules: more than one distinct value of ``col`` among accepted rows."""
    aggs = [F.count_distinct(c).alias(f"_n_{c}") for _, c in checks]
    per = df.filter(F.col("rule").isNull()).groupBy("sample").agg(*aggs)
    out = df.join(per, "sample", "left")
    rule = first_true([(name, F.col(f"_n_{c}") > 1) for name, c in checks])
    return out.withColumn("rule", F.coalesce(F.col("rule"), rule)).drop(*[f"_n_{c}" for _, c in checks])


def _suffix(ok: DataFrame) -> DataFrame:
    r = rank_within(ok, ["sample"], ["ord"], "_run")
    return r.withColumn("sample", F.concat(F.col("sample"), F.lit("_T"), F.col("_run").cast("string"))).drop("_run")


def check_rnaseq(sheet: DataFrame):
    """RNA-seq sheet (sample, fastq_1, fastq_2, strandedness) -> (ok, rejects)."""
    cols = ["sample", "fastq_1", "fastq_2", "strandedness"]
    s = _clean(sheet, cols)
    filled = sum((~empty(c)).cast("int") for c in cols)
    s = s.withColumn("sample", F.regexp_replace("sample", " ", "_"))
    rules = [("populated_columns", filled < 3), ("sample_missing", empty("sample"))]
    rules += _fastq_rules(["fastq_1", "fastq_2"])
    rules += [
        ("strandedness_missing", empty("strandedness")),
        ("strandedness_invalid", ~F.col("strandedness").isin(STRANDEDNESS)),
        ("invalid_combination", empty("fastq_1")),
    ]
    s = s.withColumn("rule", first_true(rules)).withColumn(
        "single_end", F.when(empty("fastq_2"), F.lit("1")).otherwise(F.lit("0")))
    key = ["sample", "single_end", "fastq_1", "fastq_2", "strandedness"]
    valid, bad = s.filter(F.col("rule").isNull()), s.filter(F.col("rule").isNotNull())
    valid = _later_duplicate(valid, key).withColumn(
        "rule", F.when(F.col("_dup"), F.lit("duplicate_row"))).drop("_dup")
    s = valid.unionByName(bad)
    s = _sample_rules(s, [("mixed_datatype", "single_end"), ("mixed_strandedness", "strandedness")])
    ok, rej = _split(s)
    return _suffix(ok), rej


#: Columns of the second single-cell sheet that may be there besides the three that must.
SC_OPTIONAL = ("expected_cells", "seq_center")


def check_scrnaseq(sheet: DataFrame, extra_cols: bool = False):
    """scRNA-seq sheet: duplicates allowed, no suffix, one read type per sample.

    ``extra_cols``: the second variant. It may have ``expected_cells`` (a whole number in every row
    once the column is there) and ``seq_center`` (spaces -> ``_``); a sheet with any other column is
    rejected as a whole, row by row. Both optional columns are in its accepted rows, null where the
    sheet lacks them.
    """
    cols = ["sample", "fastq_1", "fastq_2"]
    have = [c for c in SC_OPTIONAL if extra_cols and c in sheet.columns]
    unknown = extra_cols and bool(set(sheet.columns) - {"ord", *cols, *SC_OPTIONAL})
    s = _clean(sheet, [*cols, *have])
    filled = sum((~empty(c)).cast("int") for c in [*cols, *have])
    s = s.withColumn("sample", F.regexp_replace("sample", " ", "_"))
    rules = [("unknown_column", F.lit(unknown)), ("populated_columns", filled < 2), ("sample_missing", empty("sample"))]
    if "expected_cells" in have:
        rules.append(("expected_cells", ~F.col("expected_cells").rlike(r"^[+-]?[0-9]+(\.0*)?$")))
    if "seq_center" in have:
        s = s.withColumn("seq_center", F.regexp_replace("seq_center", " ", "_"))
    rules += _fastq_rules(["fastq_1", "fastq_2"])
    rules += [("invalid_combination", empty("fastq_1"))]
    s = s.withColumn("rule", first_true(rules)).withColumn(
        "single_end", F.when(empty("fastq_2"), F.lit("1")).otherwise(F.lit("0")))
    if extra_cols:
        s = s.select("*", *[F.lit(None).cast("string").alias(c) for c in SC_OPTIONAL if c not in have])
    s = _sample_rules(s, [("mixed_datatype", "single_end")])
    return _split(s)


def check_fastqc(sheet: DataFrame):
    """FastQC sheet: first FASTQ required, pair suffixes equal, (sample, fastq_1)
    unique, samples renamed ``_T{n}`` in file order."""
    cols = ["sample", "fastq_1", "fastq_2"]
    s = _clean(sheet, cols).withColumn("sample", F.regexp_replace("sample", " ", "_"))

    def suffix2(c):  # last two dot-suffixes of the file name
        return F.regexp_extract(F.col(c), r"((\.[^./]*)?\.[^./]*)$", 1)

    rules = [
        ("sample_missing", empty("sample")),
        ("fastq_1_missing", empty("fastq_1")),
        ("fastq_extension", ~_ends_any("fastq_1", FASTQ_EXT)),
        ("fastq_extension", ~empty("fastq_2") & ~_ends_any("fastq_2", FASTQ_EXT)),
        ("pair_extension", ~empty("fastq_2") & (suffix2("fastq_1") != suffix2("fastq_2"))),
    ]
    s = s.withColumn("rule", first_true(rules)).withColumn("single_end", empty("fastq_2"))
    valid, bad = s.filter(F.col("rule").isNull()), s.filter(F.col("rule").isNotNull())
    valid = _later_duplicate(valid, ["sample", "fastq_1"]).withColumn(
        "rule", F.when(F.col("_dup"), F.lit("sample_fastq_not_unique"))).drop("_dup")
    ok, rej = _split(valid.unionByName(bad))
    return _suffix(ok), rej


def check_databases(dbs: DataFrame):
    """Profiling database sheet (tool, db_name, db_params, db_path) -> (ok, rejects).

    Known tool, no quotes in params, bracken params need ``;``, db name unique per tool.
    """
    s = dbs
    rules = [
        ("unknown_tool", ~F.col("tool").isin(TOOLS)),
        ("quoted_params", F.coalesce(F.col("db_params"), F.lit("")).rlike("[\"']")),
        ("bracken_params", (F.col("tool") == "bracken") & ~empty("db_params")
         & ~F.col("db_params").contains(";")),
    ]
    s = s.withColumn("rule", first_true(rules))
    n = s.groupBy("tool", "db_name").agg(F.count("*").alias("_n"))
    s = s.join(n, ["tool", "db_name"], "left").withColumn(
        "rule", F.coalesce(F.col("rule"), F.when(F.col("_n") > 1, F.lit("db_name_not_unique")))).drop("_n")
    return _split(s)


def version_conflicts(versions: DataFrame) -> DataFrame:
    """Modules (last ``:`` part of the process name) reported with more than one
    distinct tool-version set."""
    m = versions.withColumn("module", F.element_at(F.split("process", ":"), -1))
    g = m.groupBy("module").agg(
        F.count_distinct("versions").alias("n_versions"),
        F.sort_array(F.collect_set("versions")).alias("version_sets"))
    return g.filter(F.col("n_versions") > 1)
