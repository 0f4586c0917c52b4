"""Repeated lines: two Bloom filters find suspects, only suspects are shuffled and confirmed.

A line's key is the line stripped of white space at both ends, A-Z in lower case. Keys of 40 code
points or more that stand in 5 documents or more lose their lines everywhere but in the largest id
that holds them.

1. One pass writes a row per document and distinct key (two hashes and the key's line numbers).
2. Those hashes fill a pair of filters, seen once and seen twice; only keys in the second one are
   suspects. The filters take 16 bits a key, at most 64 MB; beyond that more keys are suspected
   and the result is the same.
3. Suspects are counted exactly by their 128-bit hash, with partial sums before the shuffle; the
   documents' texts meet their dropped line numbers once.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixspark.llm.bloom import bits_for, collected, filter_blocks, has
from helixspark.llm.common import map_batches, table, texts_of, written

MIN_CHARS = 40
MIN_DOCS = 5


def keys_of(text: str, min_chars: int = MIN_CHARS) -> dict[bytes, list[int]]:
    """Keys of the long lines with the numbers of their lines."""
    out = defaultdict(list)
    for i, line in enumerate(text.encode("utf-8", "surrogatepass").split(b"\n")):
        k = line.strip(b" \t\n\x0b\x0c\r").lower()
        if len(k) >= min_chars and (k.isascii() or len(k.decode("utf-8", "replace")) >= min_chars):
            out[k].append(i)
    return out


def _spread(docs: DataFrame, min_chars: int) -> DataFrame:
    """(id, row, a, b, lines): a row per document and distinct key."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(cols):
        ids, rows, out = cols["id"], cols["row"].to_pylist(), {"n": [], "row": [], "a": [], "b": [], "lines": []}
        for i, t in enumerate(texts_of(cols["text"])):
            for k, at in keys_of(t, min_chars).items():
                h = xxhash.xxh3_128_digest(k)
                out["n"].append(i)
                out["row"].append(rows[i])
                out["a"].append(int.from_bytes(h[:8], "little", signed=True))
                out["b"].append(int.from_bytes(h[8:], "little", signed=True))
                out["lines"].append(at)
        n = np.array(out.pop("n"), np.int64)
        return out | {"id": ids.take(n)}

    return map_batches(docs, run, f"id {kind}, row long, a long, b long, lines array<int>")


def suspects(keys: DataFrame, bits: int) -> DataFrame:
    """The rows of ``keys`` whose hash ``a`` may have been seen twice."""
    twice = keys.sparkSession.sparkContext.broadcast(collected(filter_blocks(keys.select("a"), bits), "twice", bits))

    def run(cols):
        ok = np.flatnonzero(has(twice.value, cols["a"].to_numpy(zero_copy_only=False)))
        return {k: v.take(ok) for k, v in cols.items()}

    return map_batches(keys, run, keys.schema)


def _met(found: DataFrame, common: DataFrame) -> DataFrame:
    """``found`` with the keeper of its key. Keys with over a thousandth of all rows, which are fewer
    than a thousand, are broadcast, so that no task gathers the rows of a hot key."""
    hot = (F.col("docs") * 1000) > found.count()
    few, rest = common.where(hot).select("a", "b", "keeper"), common.where(~hot).select("a", "b", "keeper")
    near = F.broadcast(few)
    return found.join(near, ["a", "b"]).unionByName(found.join(near, ["a", "b"], "left_anti").join(rest, ["a", "b"]))


def without_common_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                         min_docs: int = MIN_DOCS, bits: int | None = None) -> DataFrame:
    """(id, n_lines, n_dropped, kept): one row per input row.

    Null or empty texts are one empty line. Each row is a document of its own, also where an id
    repeats; rows of the largest id all keep the line. A null id is the smallest one, so a key that
    only null ids hold is kept by them all. Any column besides the id and the text is ignored, an
    empty table gives an empty one, and long lines and texts are taken whole.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).withColumn("row", F.xxhash64("text"))
    keys = written(_spread(rows, min_chars), "line-keys")
    found = written(suspects(keys, bits or bits_for(keys.count())), "line-suspects")
    common = (found.groupBy("a", "b").agg(F.count("*").alias("docs"), F.max("id").alias("keeper"))
              .where(F.col("docs") >= min_docs))
    gone = (_met(found, written(common, "common-lines")).where(~F.col("id").eqNullSafe(F.col("keeper")))
            .groupBy("id", "row").agg(F.flatten(F.collect_set("lines")).alias("gone"))
            .select(F.col("id").alias("__id"), F.col("row").alias("__row"), "gone"))
    met = rows.join(gone, F.col("id").eqNullSafe(F.col("__id")) & (F.col("row") == F.col("__row")), "left")

    def run(cols):
        n, dropped, kept = [], [], []
        for t, g in zip(texts_of(cols["text"]), cols["gone"].to_pylist()):
            lines = t.split("\n")
            g = set(g or ())
            n.append(len(lines))
            dropped.append(len(g))
            kept.append("\n".join(x for i, x in enumerate(lines) if i not in g) if g else t)
        return {id_col: cols["id"], "n_lines": n, "n_dropped": dropped, "kept": kept}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(met.select("id", "text", "gone"), run, f"`{id_col}` {kind}, n_lines long, n_dropped long, kept string")


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_common_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


#: The same by plain grouping of all lines.
OP13_SQL = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) as i
  from documents),
keyed as (
  select doc_id, i, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from lines),
common as (
  select k, max(doc_id) as keeper from keyed where length(k) >= 40
  group by k having count(distinct doc_id) >= 5),
marked as (
  select d.doc_id, d.i, d.line, c.k is not null and d.doc_id <> c.keeper as gone
  from keyed d left join common c on d.k = c.k)
select doc_id, count(*)::bigint as n_lines, count(*) filter (where gone)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""
