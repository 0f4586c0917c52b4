"""Near-duplicate vectors by spherical k-means cells and blocked cosine products.

Vectors go to the nearest of about 2 * cbrt(n) unit centroids, fitted on a bounded sample (few
cells, as each vector is lent to a share of them).
A vector is also lent to each cell whose border it is close to, so a pair that straddles a
border meets in one cell (the lower-numbered of its two). ``reach`` is the sine of the threshold
angle (0.368 at cosine 0.93): of a linked pair on either side of a border, no vector is farther from
it, so no pair can be missed, however the vectors are spread.

A pair is looked at in one cell, where one of the two is at home: the home vectors of a cell meet
each other and the vectors lent to it, and lent vectors do not meet. Both are cut into blocks, and
block pairs are multiplied, whatever a cell's size. A block pair reports link counts and a spanning
forest of its links, never all pairs. Equal vectors of one label are one class with a multiplicity.

Cases: vectors that are null, empty, zero or hold null or non-finite components, and null
labels, link with nothing; vectors of other lengths are never compared; repeated rows count as
equal vectors; a null id is never the smallest unless all are; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from helixspark.llm.common import map_batches, table, written
from helixspark.llm.graph import components


def unit(v) -> np.ndarray | None:
    """The vector as doubles of length one; None if it cannot be compared."""
    if v is None or not len(v) or any(x is None for x in v):
        return None
    a = np.array(v, np.float64)
    top = np.abs(a).max()
    if not np.isfinite(top) or top == 0:
        return None
    a = a / top
    return a / math.sqrt(float(a @ a))


def stacked(raw: list[bytes], kind: str) -> np.ndarray:
    """Unit rows from stored vectors of one length."""
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Unit centroids of the unit rows ``x``: nearest by cosine, mean, renormalised; an empty
    cell keeps its centroid."""
    c = x[np.random.default_rng(seed).choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        home = (x @ c.T).argmax(1)
        total = np.zeros_like(c)
        np.add.at(total, home, x)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(size > 0, total / np.maximum(size, 1e-300), c)
    return c


def cells_of(x: np.ndarray, c: np.ndarray, reach: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Home cell of each unit row, and the lower-numbered cells whose border is within ``reach``
    of it (the sine of the angle to the bisecting plane)."""
    s = x @ c.T
    home = s.argmax(1)
    gaps = np.sqrt(np.maximum(2 - 2 * (c @ c.T), 0))
    out = []
    for i, h in enumerate(home.tolist()):
        low = np.arange(h)
        out.append(low[s[i, h] - s[i, :h] <= reach * gaps[h, :h] + 1e-12])
    return home, out


def forest(linked: np.ndarray, across: bool = False) -> list[tuple[int, int]]:
    """(member, first member) of each component of a symmetric boolean matrix. ``across``: the matrix
    links rows to columns, and column ``j`` is member ``len(linked) + j``."""
    n, edges = len(linked), []
    todo = linked.any(1)
    for i in np.flatnonzero(todo):
        if not todo[i]:
            continue
        rows, cols = np.zeros(n, bool), np.zeros(linked.shape[1], bool)
        edge = np.zeros(n, bool)
        edge[i] = True
        while edge.any():
            rows |= edge
            new = linked[edge].any(0) & ~cols
            cols |= new
            edge = (linked[:, new].any(1) if across else new) & ~rows
        todo &= ~rows
        edges += [(int(j), int(i)) for j in np.flatnonzero(rows) if j != i]
        if across:
            edges += [(n + int(j), int(i)) for j in np.flatnonzero(cols)]
    return edges


#: A cosine in single precision may be off by this much; nearer ones are computed again in double.
SLACK = 1e-5


def linked(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which unit rows of ``a`` and ``b`` have a cosine of ``threshold`` or more, as doubles tell."""
    s = a.astype(np.float32) @ b.astype(np.float32).T
    hit = s >= threshold
    i, j = np.nonzero(np.abs(s - np.float32(threshold)) < SLACK)
    for k in range(0, len(i), 1 << 16):
        x, y = i[k:k + (1 << 16)], j[k:k + (1 << 16)]
        hit[x, y] = np.einsum("ij,ij->i", a[x], b[y]) >= threshold
    return hit


def block_links(v: np.ndarray, mult: np.ndarray, left: np.ndarray, same: bool, threshold: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links of one block pair: weighted counts of all rows and a spanning forest. ``left`` marks the
    rows of the first block, whose partners are the others, or, if ``same``, all rows."""
    if same:
        hit = linked(v, v, threshold)
        np.fill_diagonal(hit, False)
        return hit @ mult, forest(hit)
    a, b = np.flatnonzero(left), np.flatnonzero(~left)
    hit = linked(v[a], v[b], threshold)
    n = np.zeros(len(v), np.int64)
    n[a], n[b] = hit @ mult[b], hit.T @ mult[a]
    at = np.concatenate([a, b])
    return n, [(int(at[x]), int(at[y])) for x, y in forest(hit, True)]


def reach_of(threshold: float) -> float:
    """The sine of the largest angle of a link, less the rounding of a cosine."""
    low = threshold - 1e-12
    return math.sqrt(max(0.0, 1 - low * low)) if low > 0 else 1.0


def link_vectors(df: DataFrame, threshold: float = 0.93, reach: float | None = None, sample: int = 20_000, max_cells: int = 2048,
                 block: int = 1024, lent_block: int = 4096, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Per input row: id, ``n_links``, ``component_id``, ``kept``. ``sample`` rows at most reach the
    driver for the fit; every row is assigned and compared. ``reach`` is ``reach_of`` the threshold
    if it is not given; a smaller one may miss links."""
    reach = reach_of(threshold) if reach is None else reach
    kinds = {c: df.schema[c].dataType.simpleString() for c in (id_col, label_col)}
    kind = "<f4" if df.schema[vec_col].dataType.simpleString() == "array<float>" else "<f8"
    d = df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("v"))

    def prepare(c):
        vec = [unit(v) if lab is not None else None for v, lab in zip(c["v"].to_pylist(), c["label"].to_pylist())]
        raw = [None if a is None else np.array(v, kind).tobytes() for a, v in zip(vec, c["v"].to_pylist())]
        key = [None if b is None else xxhash.xxh3_128_digest(f"{lab}:".encode() + b) for b, lab in zip(raw, c["label"].to_pylist())]
        return {"id": c["id"], "label": c["label"], "key": key, "v": raw}

    rows = written(map_batches(d, prepare, f"id {kinds[id_col]}, label {kinds[label_col]}, key binary, v binary"), "vectors")
    valid = rows.where("key is not null")
    sizes = valid.groupBy("key").agg(F.count("*").alias("mult"), F.min("id").alias("first"))
    classes = written(valid.dropDuplicates(["key"]).select("key", "label", "v").join(sizes, "key"), "classes")
    k = min(max_cells, math.ceil(2 * classes.count() ** (1 / 3)))
    drawn = classes.select("v", F.xxhash64("key").alias("h")).orderBy("h").limit(sample).collect()
    by_dim: dict[int, list[bytes]] = {}
    for r in drawn:
        by_dim.setdefault(len(r["v"]), []).append(bytes(r["v"]))
    centres = {n: spherical_kmeans(stacked(v, kind), k) for n, v in by_dim.items()}

    def place(c):
        v = c["v"].to_pylist()
        out = {"row": [], "cell": [], "home": []}
        for n in sorted({len(b) for b in v}):
            at = [i for i, b in enumerate(v) if len(b) == n]
            x = stacked([v[i] for i in at], kind)
            home, lent = cells_of(x, centres[n], reach) if n in centres else (np.zeros(len(at), int), [()] * len(at))
            for i, h, more in zip(at, home.tolist(), lent):
                out["row"] += [i] * (1 + len(more))
                out["cell"] += [h, *map(int, more)]
                out["home"] += [True] + [False] * len(more)
        take = pa.array(out["row"], pa.int64())
        return {x: c[x].take(take) for x in ("key", "label", "mult", "v")} | {"dim": [len(v[i]) for i in out["row"]], "cell": out["cell"], "home": out["home"]}

    at = ["dim", "label", "cell"]
    placed = map_batches(classes.select("key", "label", "mult", "v"), place,
                         f"key binary, label {kinds[label_col]}, mult long, v binary, dim int, cell int, home boolean")
    placed = written(placed, "placed")
    sizes = placed.groupBy(*at).agg(F.ceil(F.count_if("home") / block).cast("int").alias("homes"), F.ceil(F.count_if(~F.col("home")) / lent_block).cast("int").alias("lents"))
    m = placed.join(sizes.where("homes > 0"), at)
    g = F.pmod(F.xxhash64("key"), F.when(F.col("home"), F.col("homes")).otherwise(F.col("lents"))).cast("int")
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    # Block pairs (x, y): of home blocks with x <= y, and of home block x with lent block -1 - y.
    own = F.transform(upto(F.col("homes")), lambda o: F.struct(F.least(F.col("g"), o).alias("x"), F.greatest(F.col("g"), o).alias("y"), (F.col("g") <= o).alias("left")))
    lent = F.transform(upto(F.col("lents")), lambda z: F.struct(F.col("g").alias("x"), (-1 - z).alias("y"), F.lit(True).alias("left")))
    borrowed = F.transform(upto(F.col("homes")), lambda x: F.struct(x.alias("x"), (-1 - F.col("g")).alias("y"), F.lit(False).alias("left")))
    m = m.withColumn("g", g).select(*at, "key", "mult", "v", F.explode(F.when(F.col("home"), F.concat(own, lent)).otherwise(borrowed)).alias("p"))
    m = m.select(*at, "p.x", "p.y", "p.left", "mult", "v", "key")
    m = m.repartition(*at, "x", "y").sortWithinPartitions(*at, "x", "y")
    st = StructType.fromDDL("a binary, n long, b binary")
    arrow = to_arrow_schema(st)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(parts: list[pa.RecordBatch]):
            t = pa.Table.from_batches(parts)
            v = stacked(t["v"].to_pylist(), kind)
            x, y = t["x"][0].as_py(), t["y"][0].as_py()
            n, edges = block_links(v, t["mult"].to_numpy(), t["left"].to_numpy(), x == y, threshold)
            hit = np.flatnonzero(n)
            a, b = (pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1))
            keys = t["key"].combine_chunks()
            return pa.RecordBatch.from_arrays([pa.concat_arrays([keys.take(pa.array(hit)), keys.take(a)]),
                                               pa.array(np.concatenate([n[hit], np.zeros(len(edges), np.int64)])),
                                               pa.concat_arrays([pa.nulls(len(hit), pa.binary()), keys.take(b)])], schema=arrow)

        group: list[pa.RecordBatch] = []
        for batch in batches:
            pair = [batch.column(c) for c in (*at, "x", "y")]
            new = np.zeros(batch.num_rows, bool)
            for c in pair:
                new[1:] |= pa.compute.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
            if group:
                last = group[-1]
                new[0] = any(last.column(c)[-1].as_py() != batch.column(c)[0].as_py() for c in (*at, "x", "y"))
            cuts = [0, *[int(i) for i in np.flatnonzero(new) if i], batch.num_rows]
            for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                if group and (i or new[0]):
                    yield close(group)
                    group = []
                group.append(batch.slice(lo, hi - lo))
        if group:
            yield close(group)

    found = written(m.mapInArrow(compare, st), "links")
    comp = components(found.where("b is not null").select("a", "b"))
    counts = found.groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("n"))
    placed = classes.select("key", "first", "mult").join(comp.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    home = placed.join(least, "root").join(counts, "key", "left").select(
        "key", "component_id", (F.col("mult") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    out = rows.select("id", "key").join(home, "key", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"))
