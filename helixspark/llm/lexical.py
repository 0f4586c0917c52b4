"""Ranked lexical search of many items at once over a sharing graph of their terms.

Items are taken in blocks of a bounded number of terms. For a block

1. one pass over the documents writes, per document, its length and the counts of the block's
   terms; document frequencies, the number of documents and their lengths come from that table;
2. the sharing graph is made: terms that stand in the same items form one node, and neighbouring
   nodes that two or more items have in common are joined into a new node, round by round, as long
   as any pair is shared;
3. each task fills the terms' scores of some documents into the lowest nodes, computes every other
   node once as the sum of its two parts, and adds up the few nodes that are left of each item;
   it keeps the best documents of each item, and the tasks' best are ranked in two steps.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixspark.llm.common import map_batches, table, texts_of, to_batch, written
from helixspark.llm.topk import first_rows

#: Bytes that belong to a term become lower case, all others a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Terms of all items of one block, about; an item is never divided.
BLOCK_TERMS = 50_000
#: Numbers that a task holds at once while it scores.
CELLS = 1 << 22


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


@dataclass(frozen=True)
class Sharing:
    """``home[t]``: node of term ``t``. Nodes from ``base`` on are the sums of two earlier ones
    (``left``, ``right``); ``nodes[q]`` are those that item ``q`` adds up."""

    home: np.ndarray
    base: int
    left: list[int]
    right: list[int]
    nodes: list[list[int]]

    @property
    def size(self) -> int:
        return self.base + len(self.left)

    @property
    def sums(self) -> int:
        return len(self.left) + sum(max(0, len(x) - 1) for x in self.nodes)


def share(items: list[list[int]], n_terms: int) -> Sharing:
    """The sharing graph of items given as lists of distinct term numbers."""
    users = defaultdict(list)
    for q, terms in enumerate(items):
        for t in terms:
            users[t].append(q)
    groups: dict[tuple, int] = {}
    home = np.zeros(n_terms, np.int64)
    for t in range(n_terms):
        home[t] = groups.setdefault(tuple(users[t]), len(groups))
    # One order for all items: nodes of many items first, so that shared ones become neighbours.
    by_use = sorted(range(len(groups)), key=dict(zip(range(len(groups)), sorted(groups, key=groups.get))).get)
    by_use.sort(key=lambda g, n=[len(k) for k in groups]: -n[g])
    place = {g: i for i, g in enumerate(by_use)}
    lists = [sorted({int(home[t]) for t in terms}, key=place.__getitem__) for terms in items]
    left: list[int] = []
    right: list[int] = []
    while True:
        pairs = Counter(p for x in lists for p in zip(x, x[1:]))
        new: dict[tuple[int, int], int] = {}
        merged, used = [], Counter()
        for x in lists:
            out, i = [], 0
            while i < len(x):
                p = (x[i], x[i + 1]) if i + 1 < len(x) else None
                if p and pairs[p] > 1 and (i + 2 >= len(x) or pairs[p] >= pairs[x[i + 1], x[i + 2]]):
                    out.append(p)
                    used[p] += 1
                    i += 2
                else:
                    out.append(x[i])
                    i += 1
            merged.append(out)
        for p, n in sorted(used.items()):
            if n > 1:
                new[p] = len(groups) + len(left)
                left.append(p[0])
                right.append(p[1])
        if not new:
            return Sharing(home, len(groups), left, right, lists)
        lists = [[y for v in x for y in ([v] if isinstance(v, int) else [new[v]] if v in new else v)] for x in merged]


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, terms): the distinct terms of each item id; rows of one id are one item."""
    kind = items.schema[id_col].dataType.simpleString()
    one = items.select(F.col(id_col).alias("item"), F.col(text_col).alias("text"))
    got = map_batches(one, lambda c: {"item": c["item"], "term": [sorted(set(terms_of(t))) for t in texts_of(c["text"])]},
                      f"item {kind}, term array<binary>")
    return got.select("item", F.explode("term").alias("term")).groupBy("item").agg(F.array_sort(F.collect_set("term")).alias("terms"))


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(id, n, terms, counts) of the documents that hold any term at all; only terms of the
    vocabulary are listed."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kind = docs.schema["id"].dataType.simpleString()

    def run(cols):
        get, rows, n, terms, counts = known.value.get, [], [], [], []
        for i, t in enumerate(texts_of(cols["text"])):
            words = terms_of(t)
            if words:
                c = Counter(map(get, words))
                c.pop(None, None)
                rows.append(i)
                n.append(len(words))
                terms.append(list(c))
                counts.append(list(c.values()))
        return {"id": cols["id"].take(pa.array(rows, pa.int64())), "n": n, "terms": terms, "counts": counts}

    return map_batches(docs, run, f"id {kind}, n long, terms array<int>, counts array<long>")


def _weights(n_docs: int, df: dict[int, int], n_terms: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(n_terms)], np.int64)


class _Best:
    """The ``k`` best (score, id) of one item so far."""

    def __init__(self, k: int):
        self.k, self.score, self.row, self.floor = k, [], [], 1

    def put(self, score: np.ndarray, ranks: np.ndarray) -> None:
        """Documents of a block in ascending id order, ``ranks`` being sortable ids."""
        at = np.flatnonzero(score >= self.floor)
        if len(at):
            at = at[np.argsort(-score[at], kind="stable")[:self.k]]
            self.score.append(score[at])
            self.row.append(ranks[at])
            if len(self.score) > 8:
                self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.score:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        s, r = np.concatenate(self.score), np.concatenate(self.row)
        at = np.lexsort((r, -s))[:self.k]
        self.score, self.row = [s[at]], [r[at]]
        if len(at) == self.k:
            self.floor = max(1, int(s[at[-1]]))
        return s[at], r[at]


_BEST = pa.schema([("q", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])
#: Sorts behind every id.
_LAST = np.iinfo(np.int64).max


def _scored(table_: DataFrame, graph: Sharing, weights: np.ndarray, n_docs: int, n_all: int, k: int) -> DataFrame:
    """(q, id, score): the best documents of each item, of each task."""
    told = table_.sparkSession.sparkContext.broadcast((graph, weights))
    width = max(16, min(4096, CELLS // max(1, graph.size)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, w = told.value
        best = [_Best(k) for _ in g.nodes]
        for b in batches:
            b = b.take(pa.compute.sort_indices(b, [("id", "ascending")], null_placement="at_end"))
            for s in range(0, b.num_rows, width):
                part = b.slice(s, width)
                ids = part.column("id").fill_null(_LAST).to_numpy(zero_copy_only=False)
                m = 50 + np.array([50 * x * n_docs // n_all for x in part.column("n").to_pylist()], np.int64)
                terms, counts = part.column("terms"), part.column("counts")
                doc = np.repeat(np.arange(len(ids)), pa.compute.list_value_length(terms).to_numpy(zero_copy_only=False))
                t = terms.flatten().to_numpy(zero_copy_only=False)
                tf = counts.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                cells = np.zeros((g.size, len(ids)), np.int64)
                np.add.at(cells, (g.home[t], doc), w[t] * (1_000_000_000 * tf // (1000 * tf + 20 * m[doc])))
                for i, (x, y) in enumerate(zip(g.left, g.right), g.base):
                    np.add(cells[x], cells[y], out=cells[i])
                for q, nodes in enumerate(g.nodes):
                    best[q].put(cells[nodes].sum(axis=0), ids)
        for q, x in enumerate(best):
            s, r = x.settle()
            if len(s):
                yield to_batch({"q": np.full(len(s), q, np.int32), "id": pa.array(r, pa.int64(), mask=r == _LAST), "score": s}, _BEST)

    return table_.mapInArrow(run, "q int, id long, score long")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item, rank, id, score): the ``k`` best documents with a score above 0 for each item.

    Scores and ties are those of the module's queries: equal scores go by ascending id, a null id
    last. Ids of documents are integers. Null or empty texts have no terms and do not count as
    documents; items without terms get no rows; each row of ``docs`` is a document of its own, also
    where an id repeats. Other columns are ignored. Each block of items costs one pass over the
    texts.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    asked = written(item_terms(items, item_col, item_text), "items")
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, -(-total // block_terms))
    out = None
    for x in range(blocks):
        got = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == x).orderBy("item").collect()
        if got:
            part = _search_block(rows, [[bytes(t) for t in r["terms"]] for r in got], k)
            names = spark.createDataFrame([(q, r["item"]) for q, r in enumerate(got)], f"q int, `{item_col}` {asked.schema['item'].dataType.simpleString()}")
            part = part.join(F.broadcast(names), "q").select(item_col, "rank", F.col("id").alias(id_col), "score")
            out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], f"`{item_col}` {asked.schema['item'].dataType.simpleString()}, rank int, `{id_col}` long, score long")
    return out


def _search_block(rows: DataFrame, items: list[list[bytes]], k: int) -> DataFrame:
    vocabulary = {t: i for i, t in enumerate(sorted({t for x in items for t in x}))}
    held = written(postings(rows, vocabulary), "postings")
    n_docs, n_all = held.agg(F.count("*"), F.sum("n")).first()
    df = dict(held.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    graph = share([[vocabulary[t] for t in x] for x in items], len(vocabulary))
    best = _scored(held, graph, _weights(n_docs, df, len(vocabulary)), n_docs, n_all or 1, k)
    return first_rows(best, ["q"], [F.desc("score"), F.asc_nulls_last("id")], k, ["id"])


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: The contract's sums over all terms of all documents.
OP11_SQL = r"""
with words as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from documents),
lengths as (select doc_id, count(*) as n from words group by doc_id),
corpus as (select count(*) as nd, sum(n)::bigint as nl from lengths),
asked as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark),
tf as (select doc_id, term, count(*) as tf from words where term in (select term from asked) group by doc_id, term),
weights as (
  select term, floor(1000 * ln((2 * any_value(nd) + 2)::double / (2 * count(*) + 1)))::bigint as w
  from tf, corpus group by term),
scored as (
  select a.item_id, t.doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // nl))))::bigint as score
  from asked a join tf t using (term) join weights using (term) join lengths l on l.doc_id = t.doc_id, corpus
  group by a.item_id, t.doc_id)
select item_id, rank::int as rank, doc_id, score from (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored where score > 0)
where rank <= 50
"""
