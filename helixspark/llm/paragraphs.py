"""Repeated passages: equal runs of words, paragraph MinHash banding, removal by components.

Two rules find passages. A paragraph is a line of at least ``min_words`` words. ``tuned`` picks
the cheapest bands that reach a wanted recall at the threshold. Paragraphs that collide in a band
are compared on their full shingle sets (see ``neardup``); in each component the occurrence of the
smallest (document, place) stays and the others are removed.

Whatever the lines, every run of ``WINDOW`` equal words at two disjoint places is found too.
A window of that many words is named by the smallest hash of its runs of ``GRAM`` words, so equal
windows have equal names. Neighbouring windows of one name are a segment, and equal segments (name
and a 64-bit hash of all words) a class. Where a name that occurs again has one class, its windows
are decided together; only the classes of other names are opened, once each, and their windows met
by a hash of 128 bits. The first occurrence of a window stays, the words of all others are removed, and
neighbouring windows of one outcome are joined, which gives the whole repeated run. An occurrence
that meets a line removed by the other rule is the one that stays only if there is no other.

Cases: null text has no passage; repeated lines or runs of one document count as repeats; each
input row is a document of its own, whatever its id, so of repeated rows of a document or of
null ids all but one lose the passage; null ids come last when the kept occurrence is chosen; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from helixspark.llm.bloom import bits_for, collected, filter_blocks, has
from helixspark.llm.common import map_batches, table, to_batch, written
from helixspark.llm.neardup import Banding, blocks, first_texts, mix, near_classes, run_hashes, signatures, span_hashes, word_hashes

MIN_WORDS = 40
#: Words of a window, and of the runs within it that name it.
WINDOW, GRAM = 50, 12
#: Bytes of a batch that Python gets: by default its size follows the number of rows.
BATCH_BYTES = 2 << 20


def tuned(threshold: float, recall: float, most: int = 128) -> tuple[int, int]:
    """(rows, bands): the fewest bands, each of as many rows as ``most`` registers and the
    wanted recall at the threshold allow, weighing a band as three registers."""
    options = []
    for rows in range(1, 9):
        for bands in range(1, most // rows + 1):
            if 1 - (1 - threshold ** rows) ** bands >= recall:
                # one-row bands let chance pairs in: texts of similarity 0.2 should rarely meet
                if 1 - (1 - 0.2 ** rows) ** bands < 0.2:
                    options.append((3 * bands + rows * bands, rows, bands))
                break
    return min(options)[1:]


def minhash_banding(k: int = 5, threshold: int = 80, recall: float = 0.9999) -> Banding:
    """Classical MinHash: the upper 16 bits of the minima, compared by the share of equals."""
    rows, bands = tuned(threshold / 100, recall)

    def share(ra, rb, na, nb):
        return (ra == rb).mean(1)

    return Banding(k, rows, bands, lambda m: m >> np.uint64(48), share, "<u2", threshold)


def spans_of(text: str, min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """(start, end, words) of each paragraph in code points."""
    out, at = [], 0
    for line in text.split("\n"):
        n = len(line.encode("utf-8", "surrogatepass").split())
        if n >= min_words:
            out.append((at, at + len(line), n))
        at += len(line) + 1
    return out


def cut(text: str, min_words: int = MIN_WORDS) -> list[str]:
    return [text[a:b] for a, b, _ in spans_of(text, min_words)]


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with ``__row``, which names each row for all later reads: file and row of a plain
    Parquet scan; other frames are written once with a row number."""
    plan, names = df._jdf.queryExecution().analyzed(), []
    while plan.children().size() == 1:
        names.append(plan.nodeName())
        plan = plan.children().head()
    if plan.nodeName().startswith("LogicalRelation") and set(names) <= {"Project", "Filter", "SubqueryAlias"}:
        try:
            return df.select("*", F.struct(F.xxhash64("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i")).alias("__row"))
        except AnalysisException:  # no Parquet
            pass
    return written(df.withColumn("__row", F.struct(F.lit(0).cast("long").alias("f"), F.monotonically_increasing_id().alias("i"))), "rows")


ROW = "struct<f: bigint, i: bigint>"


def _paragraphs(df: DataFrame, min_words: int, k: int, threshold: int) -> DataFrame:
    """``repeated_paragraphs`` of numbered rows, with ``__row``."""
    p = minhash_banding(k, threshold)
    kind = df.schema["doc_id"].dataType.simpleString()
    st = StructType.fromDDL(f"__row {ROW}, doc_id {kind}, start long, `end` long, n_words long, key long, bands array<long>")
    arrow = to_arrow_schema(st)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # bands are given once a task for copies
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                c = b.slice(lo, 256)
                texts = [t or "" for t in c.column(2).to_pylist()]
                where = [(i, *s) for i, t in enumerate(texts) for s in spans_of(t, min_words)]
                _, key, bands = signatures([texts[i][a:z] for i, a, z, _ in where], p)
                for at, x in enumerate(key):
                    if x in seen:
                        bands[at] = None
                    seen.add(x)
                take = pa.array([w[0] for w in where], pa.int64())
                yield to_batch({
                    "__row": c.column(0).take(take), "doc_id": c.column(1).take(take), "start": [w[1] for w in where],
                    "end": [w[2] for w in where], "n_words": [w[3] for w in where], "key": key, "bands": bands}, arrow)

    found = written(df.select("__row", "doc_id", "text").mapInArrow(run, st), "paragraphs")
    comp = near_classes(found.where("bands is not null").select("key", "bands"), partial(first_texts, df, k, lambda t: cut(t, min_words)), p)
    place = F.struct(F.col("doc_id").isNull().alias("x"), F.col("doc_id").alias("d"), F.col("__row").alias("r"), F.col("start").alias("s"))
    per_key = found.groupBy("key").agg(F.count("*").alias("c"), F.min(place).alias("first"))
    placed = per_key.join(comp.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    groups = placed.groupBy("root").agg(F.sum("c").alias("c"), F.min("first").alias("first")).where("c > 1")
    home = placed.select("key", "root").join(groups, "root").select("key", "first")
    out = found.select("__row", "doc_id", "start", "end", "n_words", "key").join(home, "key")
    return out.select("__row", "doc_id", "start", "end", "n_words", F.col("first.d").alias("component_id"),
                      ((F.col("__row") == F.col("first.r")) & (F.col("start") == F.col("first.s"))).alias("kept"))


def repeated_paragraphs(df: DataFrame, min_words: int = MIN_WORDS, k: int = 5, threshold: int = 80) -> DataFrame:
    """One row per occurrence of a paragraph that has another one like it: ``doc_id, start, end,
    n_words, component_id`` (smallest document of the component), ``kept``."""
    return _paragraphs(numbered(df), min_words, k, threshold).drop("__row")


def _slide(x: np.ndarray, n: int, op) -> np.ndarray:
    """``op`` over each ``n`` neighbours, by doubling."""
    span = 1
    while span < n:
        step = min(span, n - span)
        x = op(x[:len(x) - step], x[step:])
        span += step
    return x


def _windows(texts: list[str]) -> Iterator[tuple]:
    """Per text: the names of its windows in order, its words, and where these begin and end."""
    for lo, hi in blocks(texts):
        words, begin, end, b, first = word_hashes(texts[lo:hi])
        names = _slide(run_hashes(words, GRAM), WINDOW - GRAM + 1, np.minimum).view(np.int64) if len(words) >= WINDOW else np.zeros(0, np.int64)
        at = np.cumsum((b & 0xC0) != 0x80)  # code points up to a byte
        left = 1
        for x, y, t in zip(first, first[1:], texts[lo:hi]):
            n = max(0, y - x - WINDOW + 1)
            yield names[x:x + n], words[x:y], at[begin[x:y]] - at[left], at[end[x:y] - 1] - at[left] + 1
            left += len(t.encode("utf-8", "surrogatepass")) + 1


_OTHER = 0xD1342543DE82EF95


def _segments(names: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First windows, numbers of windows and content hashes of the segments: neighbouring windows of
    one name. The content is all words of the windows."""
    pos = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1])))
    n = np.diff(np.append(pos, len(names)))
    return pos, n, span_hashes(words, pos, pos + n + WINDOW - 1).view(np.int64)


def _lists(flat: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """An Arrow list per array."""
    at = np.cumsum([0] + [len(x) for x in flat])
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(flat) if flat else [], kind))


_LISTS = {"name": pa.int64(), "c": pa.int64(), "pos": pa.int32(), "n": pa.int32(), "lead": pa.int8(), "again": pa.bool_()}


def _named(df: DataFrame) -> DataFrame:
    """A row for each text that has a window: the lists of its segments, and of the gaps before and
    the lengths of its words in code points. ``lead``: 1 for the first segment of a name, 2 if the
    last one is disjoint from it, else 0. ``again``: a window stands twice in the segment."""

    def run(c):
        rows: list[int] = []
        out: dict = {k: [] for k in (*_LISTS, "gap", "size")}
        for i, (m, w, a, z) in enumerate(_windows([t or "" for t in c["text"].to_pylist()])):
            if not len(m):
                continue
            pos, n, content = _segments(m, w)
            name = m[pos]
            lead, again = np.zeros(len(pos), np.int8), np.zeros(len(pos), bool)
            _, x = np.unique(name, return_index=True)
            _, y = np.unique(name[::-1], return_index=True)
            y = len(pos) - 1 - y
            lead[x] = 1 + (pos[y] + n[y] - 1 - pos[x] >= WINDOW)
            h = run_hashes(w, WINDOW)
            if len(np.unique(h)) < len(h):
                for j in np.flatnonzero(n > 1).tolist():
                    again[j] = len(np.unique(h[pos[j]:pos[j] + n[j]])) < n[j]
            rows.append(i)
            for k, v in (("name", name), ("c", content), ("pos", pos), ("n", n), ("lead", lead), ("again", again),
                         ("gap", a - np.concatenate(([0], z[:-1]))), ("size", z - a)):
                out[k].append(v)
        take = pa.array(rows, pa.int64())
        return {"__row": c["__row"].take(take), "doc_id": c["doc_id"].take(take)} | {k: _lists(v, _LISTS.get(k, pa.int32())) for k, v in out.items()}

    st = (f"__row {ROW}, doc_id {df.schema['doc_id'].dataType.simpleString()}, name array<long>, c array<long>, pos array<int>, n array<int>, "
          "lead array<byte>, again array<boolean>, gap array<int>, size array<int>")
    return written(map_batches(df.select("__row", "doc_id", "text"), run, st), "segments")


def _told(keys: DataFrame):
    """A broadcast Bloom filter of the only column of ``keys``, a written table: 64 MB at most, beyond
    which only more passes."""
    bits = bits_for(keys.count())
    return keys.sparkSession.sparkContext.broadcast(collected(filter_blocks(keys, bits), "once", bits))


def _again(named: DataFrame) -> DataFrame:
    """``_named`` with the segments whose names occur again (and some others); texts without one go."""
    each = named.select(F.explode(F.arrays_zip("name", "lead")).alias("z")).select("z.name", "z.lead").where("lead > 0")
    again = written(each.groupBy("name").agg(F.sum("lead").alias("c")).where("c > 1").select("name"), "names")
    told = _told(again)

    def some(c):
        flat = {k: c[k].flatten() for k in _LISTS if k != "lead"}
        ok = has(told.value, flat["name"].to_numpy(zero_copy_only=False))
        at = c["name"].offsets.to_numpy().astype(np.int64)
        at = np.concatenate(([0], np.cumsum(ok)))[at - at[0]]
        rows = pa.array(at[1:] > at[:-1])
        keep = pa.array(np.append(0, at[1:][at[1:] > at[:-1]]), pa.int32())
        return ({k: c[k].filter(rows) for k in ("__row", "doc_id", "gap", "size")}
                | {k: pa.ListArray.from_arrays(keep, v.filter(pa.array(ok))) for k, v in flat.items()})

    few = named.drop("lead")
    # written, as a join that broadcasts would put the next Python step into the same stage
    return written(map_batches(few, some, few.schema), "again")


def _pieces(few: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per piece of a segment of ``few``: ``n`` windows from ``off`` of the segment on, that
    begin with word ``pos`` and meet the lines in one way: ``dead`` if one meets a removed line,
    ``listed`` 2 if it lies in a line that stays, 1 in a removed one."""
    spans = lines.groupBy("__row").agg(F.collect_list(F.struct("start", "end", "kept")).alias("spans"))
    st = f"__row {ROW}, doc_id {few.schema['doc_id'].dataType.simpleString()}, name long, c long, off int, n int, pos int, dead boolean, listed int, again boolean"

    def run(c):
        out: dict = {k: [] for k in ("at", "name", "c", "off", "n", "pos", "dead", "listed", "again")}
        lists = {k: (c[k].flatten().to_numpy(zero_copy_only=False), c[k].offsets.to_numpy() - c[k].offsets[0].as_py())
                 for k in ("name", "c", "pos", "n", "again", "gap", "size")}
        for i, found in enumerate(c["spans"].to_pylist()):
            name, content, pos, n, again, gap, size = (v[at[i]:at[i + 1]] for v, at in lists.values())
            off, dead, listed = np.zeros(len(pos), np.int64), np.zeros(len(pos), bool), np.zeros(len(pos), np.int64)
            if found:
                start, end = _places(gap, size)
                start, end = start[:len(start) - WINDOW + 1], end[WINDOW - 1:]
                met, lies = np.zeros(len(start), bool), np.zeros(len(start), np.int64)
                for s in found:
                    # windows start in order, so those that meet a line or lie in it are neighbours
                    x, y = np.searchsorted(end, s["start"], "right"), np.searchsorted(start, s["end"])
                    met[x:y] |= not s["kept"]
                    x, y = np.searchsorted(start, s["start"]), np.searchsorted(end, s["end"], "right")
                    if x < y:
                        lies[x:y] = 2 if s["kept"] else 1
                turn = np.flatnonzero((met[1:] != met[:-1]) | (lies[1:] != lies[:-1])) + 1
                cuts = turn[(of := np.searchsorted(pos, turn, "right") - 1) >= 0]
                of = of[of >= 0]
                inner = (cuts > pos[of]) & (cuts < pos[of] + n[of])
                begin = np.concatenate((pos, cuts[inner]))
                of = np.concatenate((np.arange(len(pos)), of[inner]))
                order = np.argsort(begin)
                begin, of = begin[order], of[order]
                until = np.minimum(np.append(begin[1:], len(start)), pos[of] + n[of])
                name, content, again, off, n, pos = name[of], content[of], again[of], begin - pos[of], until - begin, begin
                dead, listed = met[pos], lies[pos]
            for k, v in (("at", np.full(len(pos), i)), ("name", name), ("c", content), ("off", off), ("n", n), ("pos", pos),
                         ("dead", dead), ("listed", listed), ("again", again)):
                out[k].append(v)
        out = {k: np.concatenate(v) for k, v in out.items()}
        take = pa.array(out.pop("at"), pa.int64())
        return out | {"__row": c["__row"].take(take), "doc_id": c["doc_id"].take(take)}

    return written(map_batches(few.join(spans, "__row", "left"), run, st), "pieces")


def _places(gap: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words from the gaps before them and their lengths."""
    end = np.cumsum(gap.astype(np.int64) + size)
    return end - size, end


def _hashed(df: DataFrame, classes: DataFrame) -> DataFrame:
    """(__row, c, h, g): the 128-bit hashes of the windows of the segments that are the first of
    ``classes`` (and some others)."""
    told = _told(written(classes.select(F.expr("c ^ first.r.f ^ first.r.i").alias("key")).distinct(), "keys"))

    def run(c):
        rows: list[int] = []
        out: dict = {k: [] for k in ("c", "h", "g")}
        f, i = (c["__row"].field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        for r, (m, w, *_) in enumerate(_windows([t or "" for t in c["text"].to_pylist()])):
            if not len(m):
                continue
            pos, n, content = _segments(m, w)
            at = np.flatnonzero(has(told.value, content ^ f[r] ^ i[r]))
            if len(at):
                at = at[np.unique(content[at], return_index=True)[1]]
                h, g = run_hashes(w, WINDOW).view(np.int64), run_hashes(mix(w + np.uint64(_OTHER)), WINDOW, _OTHER).view(np.int64)
                for x, k, one in zip(pos[at].tolist(), n[at].tolist(), content[at].tolist()):
                    rows.append(r)
                    out["c"].append(one)
                    out["h"].append(h[x:x + k])
                    out["g"].append(g[x:x + k])
        return {"__row": c["__row"].take(pa.array(rows, pa.int64())), "c": out["c"], "h": _lists(out["h"], pa.int64()), "g": _lists(out["g"], pa.int64())}

    return map_batches(df.select("__row", "text"), run, f"__row {ROW}, c long, h array<long>, g array<long>")


AGAIN = f"r != s or first.p - p >= {WINDOW} or q - first.p >= {WINDOW}"


def _shared(df: DataFrame, classes: DataFrame) -> DataFrame:
    """(k, at, m, first): the first places of the windows of ``classes`` by their hashes, as runs of
    ``m`` windows from ``at`` of the class on, whose first places are neighbours of one row."""
    hashed = _hashed(df, classes).withColumnRenamed("__row", "w")
    each = classes.join(hashed, (classes["c"] == hashed["c"]) & (F.col("first.r") == F.col("w")))
    each = each.select("k", "first", "r", "s", "p", "q", F.posexplode(F.expr("arrays_zip(slice(h, off + 1, n), slice(g, off + 1, n))")).alias("i", "z"))
    each = written(each.select("k", "i", F.col("z.0").alias("h"), F.col("z.1").alias("g"), "first", "r", "s", "p", "q"), "windows")
    place = F.col("first").withField("p", F.col("first.p") + F.col("i"))
    first = each.groupBy("h", "g").agg(F.min(place).alias("first"), F.min("r").alias("r"), F.max("s").alias("s"),
                                       F.min(F.expr("p + i")).alias("p"), F.max(F.expr("q + i")).alias("q")).where(AGAIN).select("h", "g", "first")
    at = each.select("h", "g", "k", "i").join(first, ["h", "g"]).select("k", "i", "first.d", "first.r", (F.col("first.p") - F.col("i")).alias("delta"))
    # a window function's group is bounded by the segment
    same = ["k", "d", "r", "delta"]
    at = at.repartition("k").withColumn("run", F.col("i") - F.row_number().over(Window.partitionBy(*same).orderBy("i")))
    runs = at.groupBy(*same, "run").agg(F.min("i").alias("at"), F.count("*").cast("int").alias("m"))
    return runs.select("k", "at", "m", "d", "r", (F.col("delta") + F.col("at")).alias("p"))


def _runs(df: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per repeated run of numbered rows, as ``_paragraphs`` gives them; ``lines`` is its
    result, whose spans are not listed again."""
    named = _again(_named(df))
    pieces = _pieces(named, lines)
    key = ["name", "c", "off", "n"]
    place = F.struct("dead", F.col("doc_id").isNull().alias("x"), F.col("doc_id").alias("d"), F.col("__row").alias("r"), F.col("pos").alias("p"))
    classes = pieces.groupBy(*key).agg(F.min(place).alias("first"), F.min("__row").alias("r"), F.max("__row").alias("s"),
                                       F.min("pos").alias("p"), F.max("pos").alias("q"), F.max("again").alias("again"))
    classes = written(classes.withColumn("k", F.monotonically_increasing_id()), "classes")
    # windows of a name can only meet within a class if it is the name's only one
    mixed = written(classes.groupBy("name").agg(F.count("*").alias("c"), F.max("again").alias("a")).where("c > 1 or a").select("name"), "mixed")
    alone = classes.where(AGAIN).join(mixed, "name", "left_anti").select(*key, F.lit(0).alias("at"), F.col("n").alias("m"), "first.d", "first.r", "first.p")
    several = written(classes.join(mixed, "name", "left_semi"), "several")
    shared = _shared(df, several).join(several.select("k", *key), "k").select(*key, "at", "m", "d", "r", "p")
    own = F.col("__row") == F.col("r")
    each = pieces.select(*key, "__row", "pos", "dead", "listed").join(alone.unionByName(shared), key)
    each = each.withColumn("pos", F.col("pos") + F.col("at")).withColumn("kept", own & (F.col("pos") == F.col("p")))
    each = each.where(F.expr("if(kept, not dead and listed != 2, listed != 1)") & (F.col("kept") | ~own | (F.abs(F.col("pos") - F.col("p")) >= WINDOW)))
    found = each.groupBy("__row").agg(F.collect_list(F.struct("pos", "m", "kept", F.col("d").alias("component_id"))).alias("found"))
    kind = df.schema["doc_id"].dataType.simpleString()

    def run(c):
        out: dict = {k: [] for k in ("start", "end", "n_words", "component_id", "kept")}
        rows = []
        for i, found in enumerate(c["found"].to_pylist()):
            start, end = _places(*(np.array(c[k][i].values) for k in ("gap", "size")))
            open_: dict = {}  # the last run of each outcome; neighbours of one outcome are joined
            for x in sorted(found, key=lambda x: x["pos"]):
                same = (x["kept"], x["component_id"])
                last = open_.get(same)
                if last and last[1] == x["pos"]:
                    last[1] += x["m"]
                    continue
                if last:
                    _close(out, start, end, same, last)
                    rows.append(i)
                open_[same] = [x["pos"], x["pos"] + x["m"]]
            for same, last in open_.items():
                _close(out, start, end, same, last)
                rows.append(i)
        take = pa.array(rows, pa.int64())
        return out | {"__row": c["__row"].take(take), "doc_id": c["doc_id"].take(take)}

    st = f"__row {ROW}, doc_id {kind}, start long, `end` long, n_words long, component_id {kind}, kept boolean"
    return map_batches(named.select("__row", "doc_id", "gap", "size").join(found, "__row"), run, st)


def _close(out: dict, start: np.ndarray, end: np.ndarray, same: tuple, run: list[int]) -> None:
    """The run of windows ``run[0]`` up to ``run[1]`` as a span."""
    n = run[1] - run[0] + WINDOW - 1
    for k, v in (("start", int(start[run[0]])), ("end", int(end[run[0] + n - 1])), ("n_words", n), ("kept", same[0]), ("component_id", same[1])):
        out[k].append(v)


def _passages(df: DataFrame) -> DataFrame:
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    lines = written(_paragraphs(df, MIN_WORDS, 5, 80), "lines")
    return lines.unionByName(_runs(df, lines))


def repeated_passages(df: DataFrame) -> DataFrame:
    """The rows of ``repeated_paragraphs`` and one per repeated run of words that they leave open;
    the ``component_id`` of a run is the document in which its words stay."""
    return _passages(numbered(df)).drop("__row")


def without_repeats(df: DataFrame) -> DataFrame:
    """``df`` with all but one occurrence of each repeated passage cut, row by row."""
    rows = numbered(df)
    return without_spans(rows, _passages(rows).where("not kept"), "__row").drop("__row")


def without_spans(df: DataFrame, removals: DataFrame, by: str = "doc_id") -> DataFrame:
    """``df`` (any columns, with text) with the spans of ``removals`` (start, end and ``by``, which
    must name one row) cut from its texts; spans may overlap. They are gathered per row: their
    number is bounded by its length. Rows without a span keep their text as it is."""
    spans = removals.groupBy(by).agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("__spans"))
    j = df.join(spans.withColumnRenamed(by, "__id"), F.col(by).eqNullSafe(F.col("__id")), "left").drop("__id")
    st = StructType([f for f in j.schema if f.name != "__spans"])
    arrow = to_arrow_schema(st)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            texts = []
            for t, s in zip(cols["text"].to_pylist(), cols.pop("__spans").to_pylist()):
                if t is not None and s:
                    keep, at = [], 0
                    for x in s:
                        a, z = x["start"], x["end"]
                        keep.append(t[at:a])
                        # the space or line break behind goes too, but no break that ends what stays of a line
                        whole = a == 0 or t[a - 1] == "\n" or a <= at
                        at = max(at, min(len(t), z + (whole or t[z:z + 1] != "\n")))
                    t = "".join([*keep, t[at:]]).removesuffix("\n") if at >= len(t) else "".join([*keep, t[at:]])
                texts.append(t)
            yield to_batch(cols | {"text": texts}, arrow)

    return j.mapInArrow(run, st)


def op5_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))
