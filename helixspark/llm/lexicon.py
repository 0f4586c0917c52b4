"""BPE encoding through a minimal acyclic transducer, and decoding.

The most frequent pre-tokens of the whole corpus are compiled into a shared-suffix
automaton whose arcs carry token ids, as flat arrays in one file that Spark hands to the
executors and every Python worker maps into memory. All new words of a batch walk it in
lockstep; words that it does not hold are merged exactly by rank (``Merger``). Texts outside the plain
alphabet of ``pretoken`` (or with a special token) are encoded by the tokenizers library.

Cases: null text is empty and has no ids; repeated rows give repeated rows; null ids stay
null; long texts and long words are encoded whole; an empty table compiles an empty automaton.
"""

from __future__ import annotations

import json
import os
import tempfile
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from helixspark.llm.common import map_batches, table, texts_of, to_batch, written
from helixspark.llm.pretoken import WORDS, plain

@lru_cache(maxsize=2)
def byte_letters() -> list[str]:
    """The printable stand-in of each byte: printable Latin-1 as it is, the others from
    U+0100 on in byte order."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(rest)) for b in range(256)]


class Merger:
    """Exact BPE of one pre-token of a plain text, by the rank of the joined bytes.

    The end-of-word mark is a zero byte, which no plain text holds: joining it to the last byte
    comes before every merge, then merges follow in the order of the file. Merging by joined
    bytes could differ from the listed pairs only if some token did not encode to itself; every
    one does (tested)."""

    END = "\0"

    def __init__(self, path: str):
        import tiktoken

        model = json.load(open(path, encoding="utf-8"))["model"]
        vocab, end, letters = model["vocab"], model["end_of_word_suffix"], byte_letters()
        byte = {c: b for b, c in enumerate(letters)}
        order = [*letters, *[c + end for c in letters], *[a + b for a, b in model["merges"]]]
        ranks = {}
        for rank, token in enumerate(order):
            body = token.removesuffix(end)
            ranks[bytes(byte[c] for c in body) + self.END.encode() * (body != token)] = rank
        self.ids = np.array([vocab[t] for t in order], "<u4")
        self.split = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def merge(self, word: str) -> np.ndarray:
        return self.ids[self.split(word + self.END)]


def compile_lexicon(entries: dict[bytes, list[int]]) -> dict[str, np.ndarray]:
    """The minimal transducer of the entries. Words come in order; once no later word can
    change a state it is replaced by an equal one met before, which shares suffixes. Outputs
    move toward the root as far as they are common.

    Arrays: ``key`` (state * 256 + byte, sorted), ``to``, ``out_at``/``out_n`` into ``pool``
    per arc, and ``final``/``fin_at``/``fin_n`` per state. State 0 is the root."""
    class Node:
        __slots__ = ("arcs", "final", "out")

        def __init__(self):
            self.arcs, self.final, self.out = {}, False, ()  # byte -> [node, ids]

    known: dict = {}

    def freeze(node: Node) -> Node:
        sign = (node.final, node.out, tuple((b, id(n), o) for b, (n, o) in node.arcs.items()))
        return known.setdefault(sign, node)

    root = Node()
    path, last = [root], b""
    for word in sorted(entries):
        rest = tuple(entries[word])
        k = 0
        while k < min(len(word), len(last)) and word[k] == last[k]:
            k += 1
        for d in range(len(last), k, -1):
            arc = path[d - 1].arcs[last[d - 1]]
            arc[0] = freeze(path[d])
        del path[k + 1:]
        for d in range(k):
            arc = path[d].arcs[word[d]]
            m = 0
            while m < min(len(arc[1]), len(rest)) and arc[1][m] == rest[m]:
                m += 1
            tail, node = arc[1][m:], path[d + 1]
            if tail:
                for other in node.arcs.values():
                    other[1] = tail + other[1]
                if node.final:
                    node.out = tail + node.out
                arc[1] = arc[1][:m]
            rest = rest[m:]
        for d in range(k, len(word)):
            path.append(Node())
            path[d].arcs[word[d]] = [path[d + 1], rest if d == k else ()]
        path[-1].final = True
        path[-1].out = rest if len(word) == k else ()
        last = word
    for d in range(len(last), 0, -1):
        path[d - 1].arcs[last[d - 1]][0] = freeze(path[d])

    number, order = {id(root): 0}, [root]
    for node in order:
        for n, _ in node.arcs.values():
            if id(n) not in number:
                number[id(n)] = len(order)
                order.append(n)
    key, to, outs, fins = [], [], [], []
    for s, node in enumerate(order):
        fins.append(node.out)
        for b in sorted(node.arcs):
            n, o = node.arcs[b]
            key.append(s * 256 + b)
            to.append(number[id(n)])
            outs.append(o)
    spans, pool = {}, []
    for o in {*outs, *fins}:
        spans[o] = len(pool)
        pool.extend(o)
    as32 = lambda v: np.array(v, np.int32)
    return {"key": np.array(key, np.int64), "to": as32(to), "out_at": as32([spans[o] for o in outs]), "out_n": as32([len(o) for o in outs]),
            "final": as32([n.final for n in order]), "fin_at": as32([spans[o] for o in fins]), "fin_n": as32([len(o) for o in fins]), "pool": as32(pool)}


FIELDS = ("key", "to", "out_at", "out_n", "final", "fin_at", "fin_n", "pool")


def save(parts: dict[str, np.ndarray], path: str) -> None:
    with open(path, "wb") as f:
        f.write(np.array([len(parts[k]) for k in FIELDS], np.int64).tobytes())
        for k in FIELDS:
            f.write(parts[k].tobytes())


class Lexicon:
    """A saved automaton, mapped into memory."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        sizes, at = raw[:8 * len(FIELDS)].view(np.int64), 8 * len(FIELDS)
        for k, n in zip(FIELDS, sizes):
            kind = np.int64 if k == "key" else np.int32
            end = at + int(n) * np.dtype(kind).itemsize
            setattr(self, k, np.asarray(raw[at:end]).view(kind))  # still the mapped pages, sliced faster
            at = end

    def look_up(self, words: list[bytes]) -> list[list[int] | None]:
        """The ids of each word, or None; all words take one step at a time together."""
        n = len(words)
        if not n or not len(self.key):
            return [None] * n
        lens = np.fromiter(map(len, words), np.int64, n)
        flat, begin = np.frombuffer(b"".join(words), np.uint8), np.concatenate(([0], np.cumsum(lens)[:-1]))
        state, live = np.zeros(n, np.int64), np.arange(n)
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        ok = np.zeros(n, bool)
        for d in range(int(lens.max()) + 1):
            done = lens[live] == d
            ends = live[done]
            ok[ends] = self.final[state[ends]] > 0
            live = live[~done]
            if not len(live):
                break
            want = state[live] * 256 + flat[begin[live] + d]
            arc = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            hit = self.key[arc] == want
            live, arc = live[hit], arc[hit]
            state[live] = self.to[arc]
            some = self.out_n[arc] > 0
            steps.append((live[some], arc[some]))
        out: list = [[] if o else None for o in ok]
        pool = self.pool
        for who, arcs in steps:
            for w, a, m in zip(who.tolist(), self.out_at[arcs].tolist(), self.out_n[arcs].tolist()):
                if out[w] is not None:
                    out[w].extend(pool[a:a + m].tolist())
        last = np.flatnonzero(ok)
        for w, a, m in zip(last.tolist(), self.fin_at[state[last]].tolist(), self.fin_n[state[last]].tolist()):
            if m:
                out[w].extend(pool[a:a + m].tolist())
        return out


class Encoder:
    """Texts to ids; keeps the ids of words met before (at most ``keep``)."""

    def __init__(self, tokenizer_path: str, lexicon_path: str, keep: int = 300_000):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer_path)
        self.library.no_truncation()
        self.library.no_padding()
        self.merger, self.lexicon, self.keep = Merger(tokenizer_path), Lexicon(lexicon_path), keep
        self.known: dict[str, bytes] = {}

    def learn(self, words: set[str]) -> None:
        new = list(words)
        for w, ids in zip(new, self.lexicon.look_up([w.encode("utf-8") for w in new])):
            self.known[w] = self.merger.merge(w).tobytes() if ids is None else array("I", ids).tobytes()

    def encode(self, texts: list[str], block: int = 256) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out: list[bytes] = []
        for at in range(0, len(texts), block):
            words = [WORDS.findall(t.lower()) if plain(t) else None for t in texts[at:at + block]]
            if len(self.known) > self.keep:
                self.known.clear()
            new: set[str] = set()
            for w in words:
                if w:
                    new.update(filterfalse(self.known.__contains__, w))
            self.learn(new)
            for t, w in zip(texts[at:at + block], words):
                if w is None:
                    out.append(np.array(self.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes())
                else:
                    out.append(b"".join(map(self.known.__getitem__, w)))
        return out


@lru_cache(maxsize=2)
def _encoder(tokenizer_path: str, lexicon: str) -> Encoder:
    return Encoder(tokenizer_path, SparkFiles.get(lexicon))


@lru_cache(maxsize=2)
def _pieces(tokenizer_path: str) -> list[str]:
    """Token texts by id, from the file's vocabulary and added tokens."""
    spec = json.load(open(tokenizer_path, encoding="utf-8"))
    ids = {i: t for t, i in spec["model"]["vocab"].items()} | {a["id"]: a["content"] for a in spec["added_tokens"]}
    return [ids.get(i, "") for i in range(max(ids) + 1)]


def word_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) over every whole plain text, counted per batch before the shuffle."""

    def run(cols):
        c: Counter = Counter()
        for t in texts_of(cols["text"]):
            if plain(t):
                c.update(WORDS.findall(t.lower()))
        return {"word": list(c.keys()), "n": list(c.values())}

    return map_batches(df.select(F.col(text_col).alias("text")), run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(df: DataFrame, tokenizer_path: str, size: int = 131_072, text_col: str = "text") -> str:
    """Compile the most frequent words, at most ``size`` (words of about one count are taken or
    left together), and hand the file to the executors. Returns its name."""
    words = written(word_counts(df, text_col), "words")
    # the cut-off comes from a histogram of some thousand steps of the count, so no task and not
    # the driver sorts more than the words taken
    step = F.round(F.log2("n") * 64).cast("int")
    total, least = 0, None
    for r in words.groupBy(step.alias("step")).agg(F.count("*").alias("words")).orderBy(F.desc("step")).collect():
        total += r["words"]
        if total > size:
            break
        least = r["step"]
    top = [] if least is None else words.where(step >= least).select("word").collect()
    merger = Merger(tokenizer_path)
    path = os.path.join(tempfile.mkdtemp(), f"lexicon-{os.urandom(8).hex()}.bin")
    save(compile_lexicon({r["word"].encode("utf-8"): merger.merge(r["word"]).tolist() for r in top}), path)
    df.sparkSession.sparkContext.addFile(path)  # Spark copies it to every executor, lost ones' successors too
    return os.path.basename(path)


def encode_texts(df: DataFrame, tokenizer_path: str, lexicon: str, id_col: str = "doc_id", text_col: str = "text",
                 decode: bool = False) -> DataFrame:
    """The id, ``n_tokens`` and ``ids`` (binary, little-endian unsigned 32-bit); with ``decode`` also
    ``decoded``, the text made of the ids in the same pass."""
    kind = df.schema[id_col].dataType.simpleString()
    st = StructType.fromDDL(f"`{id_col}` {kind}, n_tokens long, ids binary" + ", decoded string" * decode)
    arrow = to_arrow_schema(st)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 1024):  # ids and decoded texts take several times the room of the texts
                c = b.slice(lo, 1024)
                ids = _encoder(tokenizer_path, lexicon).encode(texts_of(c.column(1)))
                out = {id_col: c.column(0), "n_tokens": [len(x) // 4 for x in ids], "ids": ids}
                yield to_batch(out | ({"decoded": decoded_texts(ids, tokenizer_path)} if decode else {}), arrow)

    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, st)


def decoded_texts(ids: list[bytes], tokenizer_path: str) -> list[str]:
    """The file has no decoder, so tokens are joined by spaces."""
    piece = _pieces(tokenizer_path).__getitem__
    return [" ".join(map(piece, np.frombuffer(b, "<u4").tolist())) for b in ids]


def decode_ids(df: DataFrame, tokenizer_path: str, ids_col: str = "ids") -> DataFrame:
    """Adds ``decoded`` to rows with ids."""
    names = [c for c in df.columns if c != "decoded"]

    def run(cols):
        return cols | {"decoded": decoded_texts(cols[ids_col].to_pylist(), tokenizer_path)}

    return map_batches(df.select(*names), run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in names) + ", decoded string")


def op4_bpe_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path, docs = public_tokenizers.path("word_bpe_49k.json"), table(spark, sf_dir, "documents")
    out = encode_texts(docs, path, build_lexicon(docs, path), decode=True)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
