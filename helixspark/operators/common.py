"""Shared DataFrame building blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixspark.session import written_once


def rank_within(df: DataFrame, keys: list[str], order: list, name: str = "rank") -> DataFrame:
    """1-based ``row_number`` within ``keys`` by ``order`` that does not put a whole
    group into one task.

    A plain ``Window.partitionBy(keys)`` sends every row of a key to one task, so a key
    holding a third of the data is sorted by a single core. Here the rows are range-partitioned
    on (keys, order), which splits a hot key over many pieces, sorted inside each piece and
    written once. A row's place in its file then tells its rank: the place, less that of the first
    row of its key in the piece, plus the key's rows in earlier pieces (a small table: one row per
    key and piece). The rows go through one exchange. Null keys are a group of their own.
    """
    order_cols = _columns(order)
    s = _pieces(df, keys, order_cols).sortWithinPartitions(*[F.col(k) for k in keys], *order_cols)
    s = written_once(s, "ranks").select("*", F.col("_metadata.row_index").alias("_at"))
    first = s.groupBy(*keys, PIECE).agg(F.count("*").alias("_t"), F.min("_at").alias("_first"))
    before = _key_window(keys).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    first = first.withColumn("_off", F.coalesce(F.sum("_t").over(before), F.lit(0)) - F.col("_first")).drop("_t", "_first")
    return _shifted(s, first, keys).withColumn(name, (F.col("_at") + F.col("_off") + 1).cast("long")).drop("_at", "_off")


#: Column with the number of a row's range piece. It is data of a written table: it is computed
#: once, as a second range partitioning would draw other borders.
PIECE = "_piece"


def _columns(order: list) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def _pieces(df: DataFrame, keys: list[str], order_cols: list[Column]) -> DataFrame:
    """Range-partitioned on (keys, order), each row with its piece."""
    return df.repartitionByRange(*[F.col(k) for k in keys], *order_cols).withColumn(PIECE, F.spark_partition_id())


def _offsets(s: DataFrame, keys: list[str], total: Column) -> DataFrame:
    """Per key and piece of a written table the ``total`` over the key's earlier pieces."""
    before = _key_window(keys).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    t = s.groupBy(*keys, PIECE).agg(total.alias("_t"))
    return t.withColumn("_off", F.coalesce(F.sum("_t").over(before), F.lit(0))).drop("_t")


def _shifted(s: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """``s`` joined to the per-piece table on piece and keys, nulls equal; drops the piece."""
    names = [*keys, PIECE]
    right = small.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(names)], *[c for c in small.columns if c not in names])
    cond = F.lit(True)
    for i, k in enumerate(names):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r{i}"))
    return s.join(right, cond).drop(PIECE, *[f"_r{i}" for i in range(len(names))])


def _key_window(keys: list[str]) -> Window:
    return Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))


def prefix_sum(df: DataFrame, keys: list[str], order: list, value: str, name: str = "cum",
               inclusive: bool = True) -> DataFrame:
    """Running sum of ``value`` within ``keys`` in ``order`` without a per-key window
    over the whole key: local running sums per range piece plus the totals of the
    earlier pieces of the same key (the same scheme as ``rank_within``).
    ``inclusive=False`` gives the sum of the rows strictly before."""
    order_cols = _columns(order)
    local = Window.partitionBy(*keys, PIECE).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    s = written_once(_pieces(df, keys, order_cols).withColumn("_ls", F.sum(value).over(local)), "sums")
    offs = _offsets(s, keys, F.coalesce(F.sum(value), F.lit(0)))
    out = _shifted(s, offs, keys).withColumn(name, F.col("_ls") + F.col("_off"))
    if not inclusive:
        out = out.withColumn(name, F.col(name) - F.col(value))
    return out.drop("_ls", "_off")


def neighbours(df: DataFrame, keys: list[str], order: list, cols: list[str], prefix_prev: str = "prev_",
               prefix_next: str = "next_") -> DataFrame:
    """``lag`` and ``lead`` of ``cols`` within ``keys`` in ``order``, computed per
    range piece; the first (last) row of a piece takes its neighbour from the last
    (first) row of the adjacent non-empty piece of the same key, found in a small
    per-piece table."""
    order_cols = _columns(order)
    w = Window.partitionBy(*keys, PIECE).orderBy(*order_cols)
    s = _pieces(df, keys, order_cols)
    for c in cols:
        s = s.withColumn(prefix_prev + c, F.lag(c).over(w)).withColumn(prefix_next + c, F.lead(c).over(w))
    s = s.withColumn("_first", F.row_number().over(w) == 1).withColumn("_last", F.lead(F.lit(1)).over(w).isNull())
    s = written_once(s, "neighbours")
    edge = s.groupBy(*keys, PIECE).agg(
        F.max(F.when(F.col("_last"), F.struct(*cols))).alias("_lastrow"),
        F.max(F.when(F.col("_first"), F.struct(*cols))).alias("_firstrow"))
    kw = _key_window(keys).orderBy(PIECE)
    edge = edge.withColumn("_prevpiece", F.lag("_lastrow").over(kw)).withColumn(
        "_nextpiece", F.lead("_firstrow").over(kw)).drop("_lastrow", "_firstrow")
    s = _shifted(s, edge, keys)
    for c in cols:
        s = s.withColumn(prefix_prev + c, F.when(F.col("_first"), F.col("_prevpiece")[c]).otherwise(F.col(prefix_prev + c)))
        s = s.withColumn(prefix_next + c, F.when(F.col("_last"), F.col("_nextpiece")[c]).otherwise(F.col(prefix_next + c)))
    return s.drop("_first", "_last", "_prevpiece", "_nextpiece")


#: Buckets that a round of ``exact_median`` cuts each range into.
BUCKETS = 1024


def exact_median(df: DataFrame, keys: list[str], value: str, name: str = "median") -> DataFrame:
    """The exact median of ``value`` per key (mean of the two middle values), nulls left out.

    No task holds the values of a key: the range that a middle value lies in is cut into
    ``BUCKETS`` parts, the parts are counted with partial sums, and the part that holds the wanted
    place becomes the next range (its real smallest and largest value), until a range is one
    value. Each round reads the values once and keeps two rows a key; a range shrinks a
    thousandfold a round, so doubles need a few rounds only. Null keys are a key of their own.
    """
    v = written_once(df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v")), "values")
    size = F.col("_n")
    state = v.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    state = state.withColumn("_place", F.explode(F.array(F.floor((size - 1) / 2), F.floor(size / 2)).cast("array<bigint>")))
    state = written_once(state.select(*keys, "_place", F.monotonically_increasing_id().alias("_t"), "_lo", "_hi", F.lit(0).cast("bigint").alias("_below")), "median")
    while not (open_ := state.filter("_lo < _hi")).isEmpty():
        met = _shifted_on(v, open_, keys).filter((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
        part = F.least(F.lit(BUCKETS - 1), F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * BUCKETS))
        # values next to each other may share a part for ever: the largest value is one of its own
        part = F.when(F.col("_v") == F.col("_hi"), BUCKETS).otherwise(part)
        counted = met.groupBy("_t", part.alias("_part")).agg(F.count("*").alias("_c"), F.min("_v").alias("_pl"), F.max("_v").alias("_ph"))
        upto = F.sum("_c").over(Window.partitionBy("_t").orderBy("_part"))
        counted = counted.withColumn("_upto", upto).join(open_.select("_t", *keys, "_place", "_below"), "_t")
        chosen = counted.filter((F.col("_below") + F.col("_upto") > F.col("_place")) & (F.col("_below") + F.col("_upto") - F.col("_c") <= F.col("_place")))
        chosen = chosen.select(*keys, "_place", "_t", F.col("_pl").alias("_lo"), F.col("_ph").alias("_hi"), (F.col("_below") + F.col("_upto") - F.col("_c")).alias("_below"))
        state = written_once(chosen.unionByName(state.filter("not (_lo < _hi)")), "median")
    return state.groupBy(*keys).agg(F.avg("_lo").alias(name))


def _shifted_on(v: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """``v`` joined to the small ``state`` of its key, nulls equal."""
    right = state.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)], "_t", "_lo", "_hi")
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r{i}"))
    return v.join(right, cond).select("_t", "_lo", "_hi", "_v")


def first_true(rules: list[tuple[str, Column]]) -> Column:
    """Name of the first rule whose condition holds (null when none does)."""
    out = F.lit(None).cast("string")
    for name, cond in reversed(rules):
        out = F.when(F.coalesce(cond, F.lit(False)), F.lit(name)).otherwise(out)
    return out


def empty(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull() | (F.trim(c) == "")
