"""Toxicity scores by a counterfactual-regularised linear classifier.

Features are words and word beginnings (hashed to 2 ** 20 buckets) with log(1 + count).
For each labelled text an identity term is swapped for another of its group (or, where
it has none, one is mentioned), and the squared score change is penalised, so that a
neutral mention of a group moves no score. The fit takes a bounded sample of labelled
rows (``max_rows``, those of the smallest hash); scoring covers every whole text.

Cases: null text is empty and scores by the intercept alone; labels that are null or of
unknown documents are left out, contradicting ones count as toxic; with no usable label
of both classes every score is 0; repeated rows give repeated rows, null ids stay null.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from helixspark.llm.common import crc_mod, map_batches, table, texts_of, to_batch

BUCKETS = 1 << 20
WORD = re.compile(r"\w+")
#: Lengths of the word beginnings used as features beside whole words.
BEGINNINGS = (4, 5)
#: Texts scored at a time, and words whose features a task keeps.
SLICE, KNOWN_WORDS = 256, 100_000

# Identity terms that may stand for one another.
IDENTITY_GROUPS = (
    "women men girls boys",
    "christians muslims jews hindus buddhists atheists",
    "gay straight lesbian bisexual transgender",
    "black white asian latino arab",
    "americans mexicans chinese indians africans europeans",
    "immigrants natives refugees citizens",
    "old young blind deaf disabled",
    "femmes hommes frauen männer mujeres hombres",
)
PEERS = {w: [x for x in g.split() if x != w] for g in IDENTITY_GROUPS for w in g.split()}
TERMS = sorted(PEERS)


def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % BUCKETS


def features_of(word: str) -> list[int]:
    return [_bucket(word)] + [_bucket(f"^{word[:k]}") for k in BEGINNINGS if len(word) > k]


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def vector(words: list[str]) -> dict[int, float]:
    counts: Counter = Counter()
    for w, n in Counter(words).items():
        for f in features_of(w):
            counts[f] += n
    return {f: math.log1p(n) for f, n in counts.items()}


def swapped(words: list[str], pick: int) -> list[str]:
    """Each identity term exchanged for a peer; with none, a term is added."""
    if not any(w in PEERS for w in words):
        return [*words, TERMS[pick % len(TERMS)]]
    return [PEERS[w][(pick + i) % len(PEERS[w])] if w in PEERS else w for i, w in enumerate(words)]


@dataclass(frozen=True)
class ToxicModel:
    bias: float
    weights: dict[int, float]

    def score(self, words: list[str], known: dict[str, list[tuple[int, float]]]) -> float:
        """``known`` keeps the weighted features of words met before."""
        counts: dict[int, int] = {}
        for w, n in Counter(words).items():
            hit = known.get(w)
            if hit is None:
                hit = known[w] = [f for f in features_of(w) if f in self.weights]
            for f in hit:
                counts[f] = counts.get(f, 0) + n
        z = self.bias + sum(self.weights[f] * math.log1p(counts[f]) for f in sorted(counts))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


@dataclass(frozen=True)
class Sparse:
    """Sparse rows as arrays: row number, feature and value of each entry."""

    row: np.ndarray
    feature: np.ndarray
    value: np.ndarray
    n: int

    @staticmethod
    def of(vectors: list[dict[int, float]]) -> Sparse:
        flat = [(r, f, v) for r, x in enumerate(vectors) for f, v in x.items()]
        r, f, v = zip(*flat) if flat else ((), (), ())
        return Sparse(np.array(r, np.int64), np.array(f, np.int64), np.array(v, np.float64), len(vectors))

    @staticmethod
    def of_lists(features: pa.ChunkedArray, values: pa.ChunkedArray) -> Sparse:
        sizes = pc.list_value_length(features).to_numpy()
        return Sparse(np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), pc.list_flatten(features).to_numpy(),
                      pc.list_flatten(values).to_numpy(), len(sizes))

    def only(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, places in the sorted ``index`` and values of the entries whose feature is in it."""
        if not len(index):
            return self.row[:0], self.row[:0], self.value[:0]
        at = np.minimum(np.searchsorted(index, self.feature), len(index) - 1)
        ok = index[at] == self.feature
        return self.row[ok], at[ok], self.value[ok]


def fit(x: Sparse, diffs: Sparse, y: np.ndarray, steps: int = 150, sparsity: float = 2e-3, fairness: float = 1.0,
        positive: float = 8.0, min_rows: int = 4, max_features: int = 20_000) -> ToxicModel:
    """Proximal logistic regression on the rows ``x`` with the penalty
    ``fairness * mean((w . diff) ** 2)``; features are those of ``min_rows`` rows or more that
    differ most between the classes."""
    if not len(y) or y.min() == y.max():
        return ToxicModel(-60.0 if not len(y) or y.max() == 0 else 60.0, {})
    n, n1 = len(y), float(y.sum())
    names, place, rows = np.unique(x.feature, return_inverse=True, return_counts=True)
    toxic = np.bincount(place, y[x.row], len(names))
    gap = np.abs(toxic / n1 - (rows - toxic) / (n - n1)) / np.sqrt(rows / n)
    gap[rows < min_rows] = -1
    best = np.lexsort((names, -gap))[:max_features]
    index = np.union1d(names[best[gap[best] >= 0]], diffs.feature)
    m = len(index)
    r, c, v = x.only(index)
    dr, dc, dv = diffs.only(index)
    w, b, size2 = np.zeros(m), math.log(n1 / (n - n1)), np.zeros(m)
    cost = np.where(y > 0, positive, 1.0) / n
    for k in range(steps):
        z = b + np.bincount(r, w[c] * v, n)
        err = (1 / (1 + np.exp(-z)) - y) * cost
        change = np.bincount(dr, w[dc] * dv, diffs.n)
        g = np.bincount(c, err[r] * v, m) + 2 * fairness / max(1, diffs.n) * np.bincount(dc, change[dr] * dv, m)
        size2 = np.maximum(size2 * 0.99, g * g)
        rate = 0.06 / (1 + k / 60) / (np.sqrt(size2) + 1e-4)
        w = w - rate * g
        w = np.sign(w) * np.maximum(np.abs(w) - rate * sparsity, 0)
        b -= 0.5 * err.sum()
    return ToxicModel(float(b), {int(index[i]): float(w[i]) for i in np.flatnonzero(w)})


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = 6000) -> ToxicModel:
    """Fit on at most ``max_rows`` labelled documents outside the held-out fifth. Only
    their sparse rows come to the driver; the labels broadcast are those rows' alone."""
    lab = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).dropna()
           .where(crc_mod("doc_id", 5) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    few = lab.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.selectExpr("doc_id", "text").join(F.broadcast(few), "doc_id").select("doc_id", "text", "toxic")

    def run(cols):
        out = {"doc_id": cols["doc_id"], "toxic": cols["toxic"], "f": [], "v": [], "df": [], "dv": []}
        for i, t in zip(cols["doc_id"].to_pylist(), texts_of(cols["text"])):
            words = words_of(t)
            x, z = vector(words), vector(swapped(words, zlib.crc32(str(i).encode())))
            d = {f: z.get(f, 0.0) - x.get(f, 0.0) for f in x.keys() | z.keys() if z.get(f) != x.get(f)}
            for name, vec in (("f", x), ("df", d)):
                out[name].append(list(vec))
                out["v" if name == "f" else "dv"].append(list(vec.values()))
        return out

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = map_batches(rows, run, f"doc_id {kind}, toxic int, f array<int>, v array<float>, df array<int>, dv array<float>").toArrow()
    got = got.sort_by("doc_id")
    return fit(Sparse.of_lists(got["f"], got["v"]), Sparse.of_lists(got["df"], got["dv"]), got["toxic"].to_numpy().astype(np.float64))


def score_toxicity(docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """The id, ``score`` and the columns of ``keep``, one row per input row."""

    fields = [f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in (id_col, *keep)]
    st = StructType.fromDDL(", ".join([*fields, "score double"]))
    arrow = to_arrow_schema(st)
    at = (id_col, *keep).index(text_col) if text_col in (id_col, *keep) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[int]] = {}
        for b in batches:
            # a few texts at a time: no second copy of a whole batch in Python objects
            for lo in range(0, b.num_rows, SLICE):
                c = b.slice(lo, SLICE)
                score = []
                for t in texts_of(c.column(c.num_columns - 1 if at is None else at)):
                    if len(known) > KNOWN_WORDS:
                        known.clear()
                    score.append(model.score(words_of(t), known))
                yield to_batch({k: c.column(i) for i, k in enumerate((id_col, *keep))} | {"score": score}, arrow)

    # a text that is kept anyway is sent once
    own = [] if at is not None else [F.col(text_col).alias("__text")]
    return docs.select(id_col, *keep, *own).mapInArrow(run, st)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    s = score_toxicity(docs, learn(docs, table(spark, sf_dir, "labels")))
    return s.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"))
