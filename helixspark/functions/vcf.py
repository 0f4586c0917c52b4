"""Column functions for VCF fields (built-in Spark expressions only, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def _empty_map() -> Column:
    return F.create_map().cast("map<string,string>")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def info_map(info) -> Column:
    """INFO text -> map<string,string>.

    ``;`` separates items, the first ``=`` splits key and value, a bare flag maps to
    ``'true'``, ``.`` is the empty map, a repeated key keeps its last value
    (needs ``spark.sql.mapKeyDedupPolicy=LAST_WIN``).
    """
    info = _c(info)
    pairs = F.transform_values(F.str_to_map(info, F.lit(";"), F.lit("=")), lambda k, v: F.coalesce(v, F.lit("true")))
    return F.when(info.isNull() | (info == "."), _empty_map()).otherwise(pairs)


def format_map(fmt, value) -> Column:
    """FORMAT keys zipped with one sample's values; short values padded with ``.``.

    Either side ``.`` (or missing) gives the empty map; extra values are dropped.
    """
    fmt, value = _c(fmt), _c(value)
    keys = F.split(fmt, ":")
    vals = F.split(value, ":")
    padded = F.zip_with(keys, F.slice(vals, F.lit(1), F.size(keys)), lambda k, v: F.coalesce(v, F.lit(".")))
    return F.when(
        fmt.isNull() | value.isNull() | (fmt == ".") | (value == "."), _empty_map()
    ).otherwise(F.map_from_arrays(keys, padded))


def genotype(attrs) -> Column:
    """GT out of a FORMAT map, ``./.`` when absent."""
    return F.coalesce(F.try_element_at(_c(attrs), F.lit("GT")), F.lit("./."))


def is_ref_block(info_m) -> Column:
    """A gVCF reference block carries ``END`` in INFO."""
    return F.map_contains_key(_c(info_m), F.lit("END"))


def null_if_dot(c) -> Column:
    c = _c(c)
    return F.when(c == ".", F.lit(None).cast("string")).otherwise(c)


def alt_or_empty(c) -> Column:
    c = _c(c)
    return F.when(c == ".", F.lit("")).otherwise(c)


def qual_double(c) -> Column:
    """QUAL text -> double; ``.`` and unparsable text -> null (no ANSI error)."""
    c = _c(c)
    return F.when(c == ".", F.lit(None).cast("double")).otherwise(c.try_cast("double"))


def gt_calls(gt) -> Column:
    """Genotype text ``0/1`` or ``0|1`` -> array<int>; ``.`` alleles become -1."""
    return F.transform(F.split(_c(gt), "[/|]"), lambda a: F.coalesce(a.try_cast("int"), F.lit(-1)))


def stable_id(*parts) -> Column:
    """Deterministic id: md5 of the ``:``-joined parts (same text in DuckDB)."""
    return F.md5(F.concat_ws(":", *[_c(p).cast("string") for p in parts]))


def pos_bin(pos, size: int = 1_000_000) -> Column:
    """Coarse position bin used as a partition column for range pruning."""
    return F.floor(_c(pos) / F.lit(size)).cast("long")
