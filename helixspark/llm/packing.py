"""Mixture-controlled packing by deficit round-robin over source queues.

Each source is a queue of its documents' tokens. A round deals one window's worth of tokens:
every source gets its target share of it, and the fraction that cannot be dealt stays as its
deficit. As documents may be cut anywhere, the deficit before round w is known in closed form
(share * window * w minus its floor), so deficits carry over windows and partitions without a
sequential pass: each task derives the pieces of its own documents from the queue offsets. When
a queue runs dry the others share its part (a new phase); by default the targets are the
sources' own token shares, every window then holds the same mixture, and all queues end
together. The dealt stream is cut into windows with no gap; only the last one is padded.

The driver holds one row per source and phase, not per document. Queue order is the order of
the written token table: offsets are running sums inside a part plus a small table of part
totals.

Cases: null text is empty and is packed as its end id alone; a null source is a queue of its
own; repeated rows are packed each; null ids stay null; one long document spans many windows;
an empty table gives no pieces.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from helixspark.llm.common import table, texts_of, to_batch, written
from helixspark.llm.lexicon import byte_letters
from helixspark.llm.pretoken import BYTE_LEVEL, plain


def byte_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a byte-level vocabulary file."""
    byte = {c: b for b, c in enumerate(byte_letters())}
    vocab = json.load(open(path, encoding="utf-8"))["model"]["vocab"]
    return {bytes(byte[c] for c in t): i for t, i in vocab.items()}


#: Up to so many rows (about 40 bytes each) the part offsets are broadcast; beyond, they are joined
#: by a shuffle.
BROADCAST_ROWS = 500_000


class _Known(dict):
    """Ids of pre-tokens as bytes; a new one is merged at its first use."""

    def __init__(self, merge, code: str):
        super().__init__()
        self.merge, self.code = merge, code

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = array(self.code, self.merge(word)).tobytes()
        return ids


class ByteEncoder:
    """Byte-level BPE ids of whole texts as the tokenizers library gives them.

    Pre-tokens are encoded once and kept. New ones are merged by rank of the joined bytes, which is
    three times faster than a library call and the same: it could differ from the listed merges
    only if some token did not encode to itself, and every one does (tested). Texts outside the
    plain alphabet go to the library whole."""

    def __init__(self, path: str, keep: int = 700_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.merge = tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=byte_ranks(path), special_tokens={}).encode_ordinary
        self.kind, self.code = (np.dtype("<u2"), "H") if self.library.get_vocab_size() < 65_536 else (np.dtype("<u4"), "I")
        self.known = _Known(self.merge, self.code)
        self.keep = keep

    def encode(self, texts: list[str]) -> list[bytes]:
        ids = self.known.__getitem__
        out: list[bytes] = []
        for t in texts:
            if len(self.known) > self.keep:
                self.known.clear()
            if plain(t):
                out.append(b"".join(map(ids, BYTE_LEVEL.findall(t))))
            else:
                out.append(np.array(self.library.encode(t, add_special_tokens=False).ids, self.kind).tobytes())
        return out


@lru_cache(maxsize=2)
def _encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


def tokenize_queues(df: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Tokens with the end id, written once; ``at`` counts the tokens of the same source
    before a document within its part. The part number is data of the written table, so
    it means the same to every later reader."""
    kind = df.schema["doc_id"].dataType.simpleString()
    st = StructType.fromDDL(f"part int, source string, doc_id {kind}, at long, n long, ids binary")
    arrow = to_arrow_schema(st)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seen = _encoder(tokenizer_path), TaskContext.get().partitionId(), {}
        end = np.array([end_id], enc.kind).tobytes()
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                c = b.slice(lo, 1024)
                ids = [x + end for x in enc.encode(texts_of(c.column(2)))]
                source, at = c.column(0).to_pylist(), []
                n = [len(x) // enc.kind.itemsize for x in ids]
                for s, k in zip(source, n):
                    at.append(seen.get(s, 0))
                    seen[s] = at[-1] + k
                yield to_batch({"part": [part] * len(ids), "source": source, "doc_id": c.column(1), "at": at, "n": n, "ids": ids}, arrow)

    return written(df.select(F.col("source").cast("string").alias("source"), "doc_id", "text").mapInArrow(run, st), "tokens")


@dataclass(frozen=True)
class Phase:
    """Rounds in which the same sources are served: per source the queue position at the
    start and the tokens dealt; ``first`` is the stream position of the phase."""

    first: int
    start: np.ndarray
    amount: np.ndarray
    window: int

    @property
    def total(self) -> int:
        return int(self.amount.sum())

    @property
    def rounds(self) -> int:
        return -(-self.total // self.window)

    def served(self, s, w: np.ndarray) -> np.ndarray:
        """Queue position of source ``s`` before round ``w``: the whole tokens of its quota
        so far, the rest being its deficit. The last round serves what is left."""
        q = np.floor(np.minimum(w * float(self.window), float(self.total)) * (self.amount[s] / self.total)).astype(np.int64)
        return self.start[s] + np.where(w >= self.rounds, self.amount[s], np.minimum(q, self.amount[s]))


def schedule(tokens: list[int], targets: list[float] | None, window: int) -> list[Phase]:
    """Phases for queues of ``tokens`` and target proportions (None: the queues' own sizes).
    A source without a target is served after the others, by its size."""
    n = np.array(tokens, np.int64)
    start, left, first, phases = np.zeros(len(n), np.int64), n.copy(), 0, []
    goal = n.astype(float) if targets is None else np.array(targets, float)
    while left.sum() > 0:
        live = (left > 0) & (goal > 0)
        if not live.any():
            goal = n.astype(float)
            continue
        rate = np.where(live, goal, 0.0) / goal[live].sum()
        reach = np.full(len(n), np.inf)
        reach[live] = left[live] / rate[live]
        until = reach.min()
        amount = np.where(reach <= until * (1 + 1e-12), np.where(live, left, 0), np.floor(np.where(live, rate * min(until, 9e18), 0)).astype(np.int64))
        amount = np.minimum(amount.astype(np.int64), left)
        phases.append(Phase(first, start.copy(), amount, window))
        start, left, first = start + amount, left - amount, first + int(amount.sum())
    return phases


def cut_pieces(phases: list[Phase], source: np.ndarray, begin: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
    """Pieces of documents at queue positions ``begin`` .. ``begin + n``: the row, the first
    id, the length and the stream position of each."""
    got = []
    for p in phases:
        share = p.amount[source]
        lo, hi = np.maximum(begin, p.start[source]), np.minimum(begin + n, p.start[source] + share)
        rows = np.flatnonzero(lo < hi)
        if not len(rows):
            continue
        s, lo, hi = source[rows], lo[rows], hi[rows]
        step = p.window * (p.amount[s] / p.total)
        w0 = np.clip(np.floor((lo - p.start[s]) / step).astype(np.int64) - 1, 0, p.rounds - 1)
        w1 = np.clip(np.floor((hi - p.start[s]) / step).astype(np.int64) + 1, 0, p.rounds - 1)
        reps = w1 - w0 + 1
        k = np.repeat(np.arange(len(rows)), reps)
        w = np.arange(len(k)) - np.repeat(np.cumsum(reps) - reps, reps) + w0[k]
        a, b = p.served(s[k], w), p.served(s[k], w + 1)
        x, y = np.maximum(lo[k], a), np.minimum(hi[k], b)
        some = x < y
        k, w, a, x, y = k[some], w[some], a[some], x[some], y[some]
        base = np.zeros(len(k), np.int64)
        for j in range(len(p.amount)):
            if p.amount[j]:
                now = p.served(j, w)
                base += now - p.start[j]
                ahead = j < s[k]
                base[ahead] += p.served(j, w[ahead] + 1) - now[ahead]
        g = p.first + base + x - a
        row = rows[k]
        got.append((row, x - begin[row], y - x, g))
    if not got:
        return {k: np.zeros(0, np.int64) for k in ("row", "start", "length", "at")}
    row, start, length, g = (np.concatenate(c) for c in zip(*got))
    w = phases[0].window
    parts = (g + length - 1) // w - g // w + 1  # a piece may cross the border of a window
    k = np.repeat(np.arange(len(row)), parts)
    nth = np.arange(len(k)) - np.repeat(np.cumsum(parts) - parts, parts)
    lo = np.where(nth == 0, g[k], (g[k] // w + nth) * w)
    hi = np.minimum(g[k] + length[k], (g[k] // w + nth + 1) * w)
    out = {"row": row[k], "start": start[k] + lo - g[k], "length": hi - lo, "at": lo}
    order = np.lexsort((out["start"], out["row"]))
    return {name: v[order] for name, v in out.items()}


def pack_mixture(df: DataFrame, tokenizer_path: str, targets: dict[str | None, float] | None = None, window: int = 1024,
                 end_id: int = 0) -> DataFrame:
    """One row per piece: ``doc_id, source, start, length, ids`` (binary, little-endian unsigned
    32-bit), ``doc_tokens, sequence_id, offset``."""
    t = tokenize_queues(df, tokenizer_path, end_id)
    parts = t.groupBy("source", "part").agg(F.sum("n").alias("m"))
    found = parts.groupBy("source").agg(F.sum("m").alias("m"), F.count("*").alias("parts")).collect()
    sizes = {r["source"]: r["m"] for r in found}
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    phases = schedule([sizes[s] for s in names], None if targets is None else [targets.get(s, 0.0) for s in names], window)
    number = {s: i for i, s in enumerate(names)}
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select(F.col("source").alias("s"), F.col("part").alias("p"), F.coalesce(F.sum("m").over(before), F.lit(0)).alias("base"))
    if sum(r["parts"] for r in found) <= BROADCAST_ROWS:
        base = F.broadcast(base)
    queued = t.join(base, t["source"].eqNullSafe(base["s"]) & (t["part"] == base["p"]))
    kind = df.schema["doc_id"].dataType.simpleString()
    st = StructType.fromDDL(f"doc_id {kind}, source string, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
    arrow = to_arrow_schema(st)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _encoder(tokenizer_path).kind
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                c = b.slice(lo, 1024)
                src, begin, n = c.column(1).to_pylist(), c.column(2).to_numpy(), c.column(3).to_numpy()
                cut = cut_pieces(phases, np.array([number[s] for s in src], np.int64), begin, n)
                wide = [np.frombuffer(x, held).astype("<u4").tobytes() for x in c.column(4).to_pylist()]
                row, start, length = cut["row"], cut["start"], cut["length"]
                rows = pa.array(row)
                yield to_batch({
                    "doc_id": c.column(0).take(rows), "source": c.column(1).take(rows), "start": start, "length": length,
                    "ids": [wide[r][4 * i:4 * (i + m)] for r, i, m in zip(row.tolist(), start.tolist(), length.tolist())],
                    "doc_tokens": n[row], "sequence_id": cut["at"] // window, "offset": cut["at"] % window}, arrow)

    return queued.select("doc_id", "source", (F.col("base") + F.col("at")).alias("begin"), "n", "ids").mapInArrow(run, st)


def op1_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    p = pack_mixture(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return p.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source")
