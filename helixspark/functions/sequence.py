"""Column functions for sequence and alignment rows (built-in expressions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: UniProt TrEMBL / Swiss-Prot identifier with a species mnemonic,
# e.g. ``tr|A0A146SKV9|A0A146SKV9_FUNHE`` or ``sp|P0C2L1|A3X1_LOXLA``.
UNIPROT_PATTERN = r"^(?:tr|sp)\|[A-Za-z0-9]{6,10}(?:_\d)?\|[A-Za-z0-9]+_([A-Za-z0-9]{1,5})(?:_\d+)?$"

# Fixed value: residue alphabet of MSA profiles (20 amino acids, unknown, gap).
RESIDUES = "ARNDCQEGHILKMFPSTWYVX-"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def species_id(desc) -> Column:
    """Species mnemonic from a sequence description ('' when none): first token,
    cut at ``/``, matched against the UniProt identifier pattern."""
    token = F.split_part(F.trim(_c(desc)), F.lit(" "), F.lit(1))
    ident = F.split_part(token, F.lit("/"), F.lit(1))
    return F.regexp_extract(ident, UNIPROT_PATTERN, 1)


def chars(seq) -> Column:
    """String -> array of its characters."""
    return F.split(_c(seq), "")


def a3m_deletions(seq) -> Column:
    """Per aligned column, the number of lower-case (inserted) residues before it."""
    return F.transform(F.regexp_extract_all(_c(seq), F.lit("([a-z]*)([^a-z])"), 1), lambda s: F.length(s))


def a3m_aligned(seq) -> Column:
    """A3M row without its insertions (lower case removed)."""
    return F.regexp_replace(_c(seq), "[a-z]", "")


def masked(seq, keep_mask) -> Column:
    """Characters of ``seq`` where the boolean array ``keep_mask`` is true."""
    kept = F.filter(F.arrays_zip(chars(seq).alias("c"), _c(keep_mask).alias("k")), lambda z: z["k"])
    return F.array_join(F.transform(kept, lambda z: z["c"]), "")


def query_mask(query) -> Column:
    """True where the query has a residue (False for its gap / insertion columns)."""
    return F.transform(chars(query), lambda c: c != "-")


def identity_to(seq, query) -> Column:
    """Share of columns equal to the query (over the query length)."""
    same = F.zip_with(chars(seq), chars(query), lambda a, b: F.when(a == b, 1).otherwise(0))
    return F.aggregate(same, F.lit(0), lambda acc, x: acc + x) / F.length(_c(query))


def gap_share(seq, query_len=None) -> Column:
    s = _c(seq)
    n = F.length(s) if query_len is None else query_len
    return (F.length(s) - F.length(F.regexp_replace(s, "-", ""))) / n
