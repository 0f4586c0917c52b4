"""Near-duplicate links between texts: word shingles, banded sketches, exact confirmation.

Texts with the same shingle set are one class, named by the hash of the set. Each class
falls into one bucket per band. Work never grows with the square of a bucket:

1. every class of a bucket is compared with the bucket's smallest class (a star);
2. components of the confirmed links are taken;
3. only buckets that still hold several components are searched further, in pairs of blocks
   of classes, and only across components. A pair of blocks compares sketches, gets the texts of
   the classes that have a likely partner, compares their full sets and gives a spanning forest of
   the links, so no link between components is lost and no list of pairs is made.

Candidate pairs are first judged by a finer sketch, taken of the classes that share a bucket,
then confirmed on the full shingle sets of the whole texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from helixspark.llm.bloom import bits_for, collected, filter_blocks, has
from helixspark.llm.common import map_batches, to_batch, written
from helixspark.llm.graph import components

_C = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_ODD = 0x9E3779B97F4A7C15
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _C)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, bits: int) -> np.ndarray:
    """At least the first 2 ** bits powers of an odd number, modulo 2 ** 64. One array a base is kept."""
    out = _POWERS.get(base, np.ones(1, np.uint64))
    while len(out) < 1 << bits:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
    _POWERS[base] = out
    return out


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The 64-bit hashes of all words of ``texts`` in order, their first bytes and ends within the
    joined bytes (also returned), and the number of each text's first word, with an end mark. A-Z
    is lower-cased, words are runs without space or U+0009..U+000D. Hashes are differences of one
    running polynomial over all bytes."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    b = np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)
    space = _SPACE[b]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    begin, end = edge[::2], edge[1::2]
    bits = max(16, len(b).bit_length())
    run = np.cumsum(_BYTES[_LOWER[b]] * _powers(_ODD, bits)[:len(b)])
    words = mix((run[end - 1] - run[begin - 1]) * _powers(pow(_ODD, -1, 1 << 64), bits)[begin] + (end - begin).astype(np.uint64))
    return words, begin, end, b, np.searchsorted(begin, np.cumsum([1] + [len(r) + 1 for r in raw]))


def run_hashes(words: np.ndarray, n: int, base: int = _ODD) -> np.ndarray:
    """The hash of each ``n`` neighbouring words (as many as there are words, less n - 1)."""
    bits = max(16, len(words).bit_length())
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * _powers(base, bits)[:len(words)])])
    return mix((total[n:] - total[:-n]) * _powers(pow(base, -1, 1 << 64), bits)[:max(0, len(words) - n + 1)])


def span_hashes(words: np.ndarray, begin: np.ndarray, end: np.ndarray, base: int = _ODD) -> np.ndarray:
    """The hash of the words from each of ``begin`` up to ``end``."""
    bits = max(16, len(words).bit_length())
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * _powers(base, bits)[:len(words)])])
    return mix(mix((total[end] - total[begin]) * _powers(pow(base, -1, 1 << 64), bits)[begin]) + (end - begin).astype(np.uint64))


def shingle_sets(texts: list[str], k: int) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its ``k``-word shingles. Fewer words: the whole
    sequence; none: empty."""
    words, _, _, _, first = word_hashes(texts)
    out = []
    for lo, hi in zip(first, first[1:]):
        w = words[lo:hi]
        n = min(k, len(w))
        h = np.zeros(len(w) - n + 1 if n else 0, np.uint64)
        for j in range(n):
            h = h * _C + w[j:len(w) - n + 1 + j]
        h = mix(h + np.uint64(n))
        h.sort()
        out.append(h[np.concatenate(([True], h[1:] != h[:-1]))] if n else h)
    return out


def blocks(texts: list[str], size: int = 1 << 18, most: int = 128) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``most`` texts and about ``size`` characters; a longer text stands alone."""
    lo = total = 0
    for i, t in enumerate(texts):
        if i > lo and (total + len(t) > size or i - lo >= most):
            yield lo, i
            lo, total = i, 0
        total += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def all_sets(texts: list[str], k: int) -> Iterator[np.ndarray]:
    for lo, hi in blocks(texts):
        yield from shingle_sets(texts[lo:hi], k)


def set_key(s: np.ndarray) -> int:
    """The class of a set: a signed 64-bit hash of all of it (two different sets share one with
    probability 2 ** -64)."""
    return int.from_bytes(xxhash.xxh3_64_digest(s.tobytes()), "little", signed=True)


@dataclass(frozen=True)
class Banding:
    """``rows`` registers a band; ``threshold`` is the similarity to link at, in hundredths."""

    k: int
    rows: int
    bands: int
    sketch: Callable[[np.ndarray], np.ndarray] = field(repr=False)  # minima [sets, m] to registers
    estimate: Callable = field(repr=False)  # registers and sizes of both sides to similarities
    kind: str = "<u2"
    threshold: int = 80
    #: Registers of the fine sketch, taken only of texts that share a bucket with another.
    fine: int = 512

    @property
    def m(self) -> int:
        return self.rows * self.bands

    def doubt(self, m: int) -> float:
        """Pairs estimated below it from ``m`` registers are not confirmed: five standard errors
        under the threshold."""
        t = self.threshold / 100
        return t - 5 * (t * (1 - t) / m) ** 0.5


def multipliers(m: int) -> np.ndarray:
    return mix(np.arange(1, m + 1, dtype=np.uint64) * _C) | np.uint64(1)


def minima(sets: list[np.ndarray], m: int) -> np.ndarray:
    """The smallest of ``hash * odd number`` of each set (none empty) for ``m`` numbers."""
    out = np.empty((len(sets), m), np.uint64)
    flat = np.concatenate(sets)
    at = np.cumsum([0] + [len(s) for s in sets[:-1]])
    for i, a in enumerate(multipliers(m)):
        out[:, i] = np.minimum.reduceat(flat * a, at)
    return out


def signatures(texts: list[str], p: Banding) -> tuple[list, list, list]:
    """Per text: the size and key of its set and its band hashes; nulls without words."""
    size, key, bands = [], [], []
    for lo, hi in blocks(texts):
        sets = shingle_sets(texts[lo:hi], p.k)
        some = [s for s in sets if len(s)]
        if some:
            g = p.sketch(minima(some, p.m)).astype(p.kind).reshape(len(some), p.bands, p.rows).astype(np.uint64)
            b = np.full((len(some), p.bands), 1, np.uint64) * np.arange(1, p.bands + 1, dtype=np.uint64)
            for j in range(p.rows):
                b = mix(b * _C + g[:, :, j])
            rows = iter(b.view(np.int64))
        for s in sets:
            size.append(len(s))
            key.append(set_key(s) if len(s) else None)
            bands.append(next(rows) if len(s) else None)
    return size, key, bands


def first_texts(df: DataFrame, k: int, cut: Callable[[str], list[str]] = lambda t: [t], told=None) -> DataFrame:
    """(key, text) of the parts that ``cut`` makes of each text of column ``text``; within a
    task a key is given once, so a large group of copies leaves one row a task. ``told``: a broadcast
    Bloom filter of the keys wanted; others may come too."""
    st = StructType.fromDDL("key long, text string")
    arrow = to_arrow_schema(st)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            keys, texts = [], []
            parts = [part for t in b.column(0).to_pylist() for part in cut(t or "")]
            for part, s in zip(parts, all_sets(parts, k)):
                if len(s) and (key := set_key(s)) not in seen:
                    seen.add(key)
                    keys.append(key)
                    texts.append(part)
            out = to_batch({"key": keys, "text": texts}, arrow)
            yield out if told is None else out.filter(pa.array(has(told.value, np.array(keys, np.int64))))

    return df.select("text").mapInArrow(run, st)


def candidates(buckets: DataFrame, texts: Callable[..., DataFrame], p: Banding) -> DataFrame:
    """(key, text, n, fine) of each class that shares a bucket: its text, set size and fine sketch,
    whose first registers are the banded ones; written, as it is all that the searches read."""
    some = written(buckets.select("key").distinct(), "keys")
    bits = bits_for(some.count())
    told = buckets.sparkSession.sparkContext.broadcast(collected(filter_blocks(some, bits), "once", bits))

    # a filter of 64 MB at most keeps the other texts out of the shuffle; it is applied where texts are
    # cut, as a second Python step in the stage would double the workers of an executor
    have = texts(told=told).join(some, "key").dropDuplicates(["key"]).select("key", "text")

    def run(c):
        n, fine = [], []
        for lo, hi in blocks(t := c["text"].to_pylist()):
            sets = shingle_sets(t[lo:hi], p.k)
            n += map(len, sets)
            fine += [r.tobytes() for r in p.sketch(minima(sets, p.fine)).astype(p.kind)]
        return c | {"n": n, "fine": fine}

    return written(map_batches(have, run, "key long, text string, n long, fine binary"), "candidates")


def likely(pairs: DataFrame, have: DataFrame, p: Banding) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sizes allow the threshold and whose fine sketches agree."""
    side = have.select("key", "n", "fine")
    j = (pairs.join(side.toDF("a", "na", "ra"), "a").join(side.toDF("b", "nb", "rb"), "b")
         .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * p.threshold))

    def run(c):
        ra, rb = (np.frombuffer(b"".join(c[x].to_pylist()), p.kind).reshape(-1, p.fine) for x in ("ra", "rb"))
        ok = p.estimate(ra, rb, c["na"].to_numpy(), c["nb"].to_numpy()) >= p.doubt(p.fine)
        return {x: c[x].filter(pa.array(ok)) for x in ("a", "b")}

    return map_batches(j.select("a", "b", "na", "nb", "ra", "rb"), run, "a long, b long")


def _dealt(df: DataFrame, *cols: str) -> DataFrame:
    """Dealt by ``cols`` over all shuffle partitions: the rows are few but costly, so they are
    not gathered into fewer tasks by size."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols)


def confirmed(pairs: DataFrame, texts: DataFrame, p: Banding, share: int = 128) -> DataFrame:
    """Those of ``pairs`` whose full sets reach the threshold; ``texts``: (key, text).

    Pairs are dealt by (a, part): a class with many partners is split into parts of about
    ``share`` of them. A task reads the rows of a part in order, the text of ``a`` first, and
    holds one set at a time."""
    pairs = written(pairs, "pairs")
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / share).alias("parts"))
    dealt = pairs.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), "parts").alias("part"))
    lead = dealt.select("a", "part").distinct().join(texts.withColumnRenamed("key", "a"), "a").select(
        "a", "part", F.lit(None).cast("long").alias("b"), "text")
    rest = dealt.join(texts.withColumnRenamed("key", "b"), "b").select("a", "part", "b", "text")
    rows = _dealt(lead.unionByName(rest), "a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    st = StructType.fromDDL("a long, b long")
    arrow = to_arrow_schema(st)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = np.zeros(0, np.uint64)
        for batch in batches:
            out = {"a": [], "b": []}
            sides = zip(*[c.to_pylist() for c in batch.columns[:3]])
            for (a, _, b), s in zip(sides, all_sets(batch.column(3).to_pylist(), p.k)):
                if b is None:
                    mine = s
                    continue
                both = len(np.intersect1d(mine, s, assume_unique=True))
                if 100 * both >= p.threshold * (len(mine) + len(s) - both):
                    out["a"].append(a)
                    out["b"].append(b)
            yield to_batch(out, arrow)

    return rows.mapInArrow(run, st)


#: Classes of one block of a bucket.
BLOCK = 256


def _pairs_in(group: list[tuple], p: Banding) -> tuple[list, list, np.ndarray, np.ndarray, np.ndarray, list, list]:
    """Likely pairs of a block pair whose classes lie in different components: the left and right
    rows, and the pairs' rows and estimates; then the components of both sides as small numbers.

    Rows: (band, x, y, g, key, n, fine, comp, nth). All pairs are compared by the banded registers (of
    a pair that meets in several bands only the first counts), those that pass by the fine sketch."""
    x, y = group[0][1:3]
    left = [r for r in group if r[3] == x]
    right = left if x == y else [r for r in group if r[3] == y]
    none = np.zeros(0, np.int64)
    if not left or not right:
        return left, right, none, none, none, [], []
    fine = [np.frombuffer(b"".join(r[6] for r in s), p.kind).reshape(len(s), -1) for s in (left, right)]
    regs = [f[:, :p.m] for f in fine]
    n = [np.array([r[5] for r in s]) for s in (left, right)]
    code: dict = {}
    comp = [np.array([code.setdefault(r[7], len(code)) for r in s]) for s in (left, right)]
    same = np.zeros((len(left), len(right)), np.int32)
    for i in range(p.m):
        same += regs[0][:, i, None] == regs[1][None, :, i]
    ok = (same >= p.m * (p.doubt(p.m) - 0.1)) & (comp[0][:, None] != comp[1][None, :])
    ok &= np.minimum.outer(n[0], n[1]) * 100 >= np.maximum.outer(n[0], n[1]) * p.threshold
    i, j = np.nonzero(np.triu(ok, 1) if x == y else ok)
    us, vs, likelihood = [none], [none], [np.zeros(0)]
    for lo in range(0, len(i), 8192):
        u, v = i[lo:lo + 8192], j[lo:lo + 8192]
        meet = (regs[0][u] == regs[1][v]).reshape(len(u), p.bands, p.rows).all(2).argmax(1)
        u, v = u[meet == group[0][8]], v[meet == group[0][8]]
        if len(u):
            est = p.estimate(fine[0][u], fine[1][v], n[0][u], n[1][v])
            near = est >= p.doubt(p.fine)
            us.append(u[near])
            vs.append(v[near])
            likelihood.append(est[near])
    return left, right, np.concatenate(us), np.concatenate(vs), np.concatenate(likelihood), comp[0].tolist(), comp[1].tolist()


def _grouped(rows: DataFrame, close: Callable[[list[tuple]], dict], schema: str) -> DataFrame:
    """``close`` on the rows of each (band, x, y), which stand together."""
    st = StructType.fromDDL(schema)
    arrow = to_arrow_schema(st)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for batch in batches:
            for r in zip(*[c.to_pylist() for c in batch.columns]):
                if group and group[0][:3] != r[:3]:
                    yield to_batch(close(group), arrow)
                    group = []
                group.append(r)
        if group:
            yield to_batch(close(group), arrow)

    names = ["band", "x", "y"]
    return _dealt(rows, *names).sortWithinPartitions(*names).mapInArrow(run, st)


def across(members: DataFrame, texts: DataFrame, p: Banding, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between classes that share a bucket but lie in different components: of each
    pair of blocks a spanning forest of the linked classes, so all components come out right and no
    list of pairs is made.

    ``members``: band, nth, key, n, fine, comp of buckets with several components; ``texts``: (key,
    text). Buckets are cut into blocks. Each pair of blocks is compared by sketches and gives the
    classes that have a likely partner in it; their texts are sent to that pair of blocks, which
    finds the pairs again and compares full sets, the likeliest first, skipping classes that are
    joined already."""
    sizes = members.groupBy("band").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    m = members.join(sizes, "band").withColumn("g", F.pmod(F.xxhash64("key"), "blocks").cast("int"))
    m = m.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    m = m.select("band", F.least("g", "o").alias("x"), F.greatest("g", "o").alias("y"), "g", "key", "n", "fine", "comp", "nth")

    def named(group):
        left, right, u, v, *_ = _pairs_in(group, p)
        rows = {r[4]: r for r in [*(left[i] for i in u.tolist()), *(right[i] for i in v.tolist())]}.values()
        return {k: [r[i] for r in rows] for i, k in enumerate(("band", "x", "y", "g", "key", "n", "fine", "comp", "nth"))}

    some = written(_grouped(m, named, "band long, x int, y int, g int, key long, n long, fine binary, comp long, nth int"), "members")
    full = some.join(texts, "key").select("band", "x", "y", "g", "key", "n", "fine", "comp", "nth", "text")

    def confirm(group):
        left, right, u, v, est, cl, cr = _pairs_in(group, p)
        sets = dict(zip([r[4] for r in group], all_sets([r[9] for r in group], p.k)))
        root: dict[int, int] = {}

        def top(c: int) -> int:
            while root.get(c, c) != c:
                root[c] = c = root.get(root[c], root[c])
            return c

        out: dict = {"a": [], "b": []}
        for at in np.argsort(-est, kind="stable").tolist():
            i, j = int(u[at]), int(v[at])
            a, b = top(cl[i]), top(cr[j])
            if a != b:
                s, t = sets[left[i][4]], sets[right[j][4]]
                both = len(np.intersect1d(s, t, assume_unique=True))
                if 100 * both >= p.threshold * (len(s) + len(t) - both):
                    root[max(a, b)] = min(a, b)
                    out["a"].append(left[i][4])
                    out["b"].append(right[j][4])
        return out

    return _grouped(full, confirm, "a long, b long")


def near_classes(sketches: DataFrame, texts: Callable[..., DataFrame], p: Banding) -> DataFrame:
    """(node, root) of classes that are linked. ``sketches``: (key, bands), keys may repeat;
    ``texts(told=)``: (key, text) as ``first_texts`` gives them, read only for classes that share a
    bucket."""
    spread = sketches.select("key", F.posexplode("bands").alias("nth", "band"))
    star = spread.groupBy("band").agg(F.min("key").alias("a"), F.max("key").alias("z")).where("a < z").select("band", "a")
    buckets = written(spread.join(written(star, "stars"), "band").distinct(), "buckets")
    pairs = buckets.where("key != a").select("a", F.col("key").alias("b")).distinct()
    have = candidates(buckets, texts, p)
    side = have.select("key", "text")
    comp = written(components(written(confirmed(likely(pairs, have, p), side, p), "links")), "components")
    placed = (buckets.select("band", "nth", "key").join(comp.withColumnRenamed("node", "key"), "key", "left")
              .select("band", "nth", "key", F.coalesce("root", "key").alias("comp")))
    # a bucket of two has had its only pair compared
    split = (placed.groupBy("band").agg(F.min("comp").alias("u"), F.max("comp").alias("v"), F.count("*").alias("c"))
             .where("u < v and c > 2").select("band"))
    rest = placed.join(split, "band").join(have.select("key", "n", "fine"), "key")
    late = written(across(rest, side, p), "links")
    if late.isEmpty():
        return comp
    return components(comp.select(F.col("node").alias("a"), F.col("root").alias("b")).union(late))
