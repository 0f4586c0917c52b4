"""Phrase mining after Toivonen: a sample proposes, full passes count the proposals and their border.

``known`` is a set of phrases with all their parts. A pass over texts counts every single word and
every phrase of which both parts one word shorter are known: the known phrases and their negative
border at once, without listing the border. The sample is mined by such passes, length by length, with a
lowered bound. A pass over all texts then counts what the sample proposes and the border exactly.
If phrases of the border are frequent after all, a further pass counts every longer phrase that
holds one of them, which closes the search: all parts of a frequent phrase are frequent, so one
that was not counted holds a smallest part that was not proposed, and that part is border and
frequent. Nothing can be missed, whatever the sample.

Most of the border is rare. So a first pass over all texts only counts by slot, a part of a phrase's
hash, and sends sorted slots with their counts; the phrases of a slot that occur too rarely together
are too rare each, and the next pass counts the others by their text.

Texts are encoded once, in chunks of word numbers with their words, and the passes run over those.
Known phrases are told to the tasks as a Bloom filter of at most 64 MB, a file that the workers of an
executor map into memory together. A false hit only counts a phrase that need not be counted;
phrases are counted by their text, so counts are exact. A task holds one chunk at a time: each is a
row group of its own, and goes to Python in a batch of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixspark.llm.bloom import bits_for, collected, filter_blocks, handed_out, has, mapped
from helixspark.llm.common import map_batches, table, written
from helixspark.llm.topk import first_rows

LONGEST = 5
#: Words of one chunk of encoded texts, about; a text is never divided.
CHUNK_WORDS = 1 << 20
#: Bytes of a batch that goes to Python, about; a larger row goes alone. Rows of a batch of counts or
#: of blocks that comes back.
BATCH_BYTES, BATCH_ROWS, BATCH_BLOCKS = 2 << 20, 1 << 16, 1 << 10
#: Each chunk in a row group of its own, so that it is written and read alone.
_ALONE = {"parquet.block.row.count.limit": 1}
_END = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 10 if c in _END else 32 if c == 9 else c for c in range(256))
_MIX = 0x9E3779B97F4A7C15
_COUNTED = "lang string, phrase string, cnt long"
_ARROW = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("cnt", pa.int64())])
#: Slots of one block of counts, and counts that a task keeps before it sends blocks.
BLOCK, FLUSH = 1 << 16, 1 << 21
_SLOTS = "block int, slots binary, cnt binary"
_SLOTS_ARROW = pa.schema([("block", pa.int32()), ("slots", pa.binary()), ("cnt", pa.binary())])
_CHUNK = "langs array<string>, words array<binary>, ids binary"
_CHUNK_ARROW = pa.schema([("langs", pa.list_(pa.string())), ("words", pa.list_(pa.binary())), ("ids", pa.binary())])


def _word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode() + b"\0" + word)


def _longer(h: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of a phrase from those of all but its last word and of that word."""
    x = (h ^ (h >> np.uint64(29))) * np.uint64(_MIX) + last
    return x ^ (x >> np.uint64(32))


def phrase_hash(lang: str, phrase: str) -> int:
    """The same for one phrase, as a signed number."""
    first, *rest = (_word_hash(lang, w) for w in phrase.encode().split(b" "))
    for last in rest:
        first = ((first ^ (first >> 29)) * _MIX + last) & (2**64 - 1)
        first ^= first >> 32
    return first - 2**64 if first >= 2**63 else first


class _Numbers(dict):
    """Word -> its place among the words of the chunk; -1 is no word, 0 ends a piece."""

    def __init__(self, lang: str, langs: list[str], words: list[bytes]):
        super().__init__({b"": -1, b"\n": 0})
        self.lang, self.langs, self.words = lang, langs, words

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.words)
        self.words.append(word)
        self.langs.append(self.lang)
        return n


def encoded(docs: DataFrame) -> DataFrame:
    """``docs`` (lang, text) as chunks: the distinct words of some whole texts with their langs, and
    the numbers of all their words in order as 32-bit integers, 0 where a piece ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chunk():
            ids = np.concatenate(parts)
            return pa.RecordBatch.from_arrays([pa.array([langs], _CHUNK_ARROW[0].type), pa.array([words], _CHUNK_ARROW[1].type),
                                               pa.array([ids[ids >= 0].tobytes()], pa.binary())], schema=_CHUNK_ARROW)

        langs, words, parts, size, by_lang = [""], [b""], [], 0, {}
        for b in batches:
            for lang, t in zip(b.column("lang").to_pylist(), b.column("text").cast(pa.binary()).to_pylist()):
                if t:
                    numbers = by_lang.get(lang)
                    if numbers is None:
                        numbers = by_lang[lang] = _Numbers(lang, langs, words)
                    found = (t.translate(_FOLD).replace(b"\n", b" \n ") + b" \n").split(b" ")
                    parts.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
                    size += len(found)
                    if size >= CHUNK_WORDS:
                        yield chunk()
                        langs, words, parts, size, by_lang = [""], [b""], [], 0, {}
        if parts:
            yield chunk()

    return docs.select("lang", "text").mapInArrow(run, _CHUNK)


def sampled(chunks: DataFrame, share: int) -> DataFrame:
    """Chunks with about one piece in ``share`` of each chunk, drawn by a generator that the chunk's
    own content seeds. Pieces are drawn and not texts, as a text repeats its phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                raw = b.column("ids")[i].as_buffer()
                ids = np.frombuffer(raw, np.int32)
                piece = np.cumsum(ids == 0) - (ids == 0)  # an end belongs to its piece
                drawn = np.random.default_rng(zlib.crc32(raw)).integers(0, share, int(piece[-1]) + 1 if len(ids) else 0) == 0
                used, ids = np.unique(np.append(0, ids[drawn[piece]]), return_inverse=True)
                langs, words = (b.column(c)[i].values.take(pa.array(used)) for c in ("langs", "words"))
                yield pa.RecordBatch.from_arrays([pa.array([langs.to_pylist()], _CHUNK_ARROW[0].type), pa.array([words.to_pylist()], _CHUNK_ARROW[1].type),
                                                  pa.array([ids.astype(np.int32).tobytes()], pa.binary())], schema=_CHUNK_ARROW)

    return chunks.mapInArrow(run, _CHUNK)


def _in_slots(often: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the slot of each hash is set in ``often`` (an array of bytes)."""
    p = h & np.uint64(len(often) * 8 - 1)
    return (often[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _slot_counts(langs: pa.Array, words: pa.Array, ids: np.ndarray, known, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the known phrases of a chunk and their border, and their occurrences; a slot of a
    single word may come a second time."""
    hashes = np.array([_word_hash(*x) for x in zip(langs.to_pylist(), words.to_pylist())], np.uint64)
    low = np.uint64(slots - 1)
    cnt = np.bincount(ids, minlength=len(words))
    cnt[0] = 0
    used = np.flatnonzero(cnt)
    is_known = has(known, hashes)
    is_known[0] = False
    one, found = hashes[ids], []
    now = np.flatnonzero(is_known[ids])
    h = np.zeros(len(ids), np.uint64)
    h[now] = one[now]
    for k in range(2, LONGEST + 1):
        begins = np.zeros(len(ids) + LONGEST, bool)
        begins[now] = True
        now = now[begins[now + 1]]
        hk = _longer(h[now], one[now + k - 1])
        found.append((hk & low).astype(np.uint32))
        h[now] = hk
        now = now[has(known, hk)]
    u, n = np.unique(np.concatenate(found), return_counts=True)
    return np.concatenate([u, (hashes[used] & low).astype(np.uint32)]), np.concatenate([n, cnt[used]])


def often_slots(chunks: DataFrame, known: np.ndarray | str, least: int, slots: int) -> np.ndarray:
    """A bit for each slot: whether its known phrases and those of their border (single words too)
    occur ``least`` times or more together."""
    name = handed_out(chunks.sparkSession, known)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent():
            slot, cnt = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(slot, kind="stable")
            slot = slot[order]
            first = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1])))
            cnt, slot = np.add.reduceat(cnt[order], first).astype(np.int64), slot[first]
            at = np.unique(slot // BLOCK)
            cut = np.append(np.searchsorted(slot, at * np.uint32(BLOCK)), len(slot))
            slot = (slot % BLOCK).astype(np.uint16)
            for i in range(0, len(at), BATCH_BLOCKS):
                ends = cut[i:i + BATCH_BLOCKS + 1]
                yield pa.RecordBatch.from_arrays([pa.array(at[i:i + BATCH_BLOCKS], pa.int32()), *(pa.array([x[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary())
                                                                                                  for x in (slot, cnt))], schema=_SLOTS_ARROW)

        known, held, size = mapped(name), [], 0
        for b in batches:
            for i in range(b.num_rows):
                langs, words = (b.column(c)[i].values for c in ("langs", "words"))
                held.append(_slot_counts(langs, words, np.frombuffer(b.column("ids")[i].as_buffer(), np.int32), known, slots))
                size += len(held[-1][0])
                if size >= FLUSH:
                    yield from sent()
                    held, size = [], 0
        if size:
            yield from sent()

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, np.zeros(BLOCK, np.int64)
        done = lambda: pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([np.packbits(total >= least, bitorder="little").tobytes()], pa.binary())], ["block", "often"])
        for b in batches:
            for block, slot, cnt in zip(*(b.column(i).to_pylist() for i in range(3))):
                if block != at:
                    if at is not None:
                        yield done()
                    at, total = block, np.zeros(BLOCK, np.int64)
                total[np.frombuffer(slot, np.uint16)] += np.frombuffer(cnt, np.int64)
        if at is not None:
            yield done()

    found = chunks.mapInArrow(partial, _SLOTS).repartition("block").sortWithinPartitions("block").mapInArrow(merged, "block int, often binary")
    out = np.zeros(slots // 8, np.uint8)
    for r in found.where(F.col("often") != F.lit(bytes(BLOCK // 8))).collect():
        out[r.block * (BLOCK // 8):(r.block + 1) * (BLOCK // 8)] = np.frombuffer(r.often, np.uint8)
    return out


def _counts(langs: pa.Array, words: pa.Array, ids: np.ndarray, known, late, only: int | None, often=None) -> Iterator[pa.RecordBatch]:
    """Rows (lang, phrase, cnt) of the phrases to count in a chunk (see ``count_pass``)."""
    hashes = np.array([_word_hash(*x) for x in zip(langs.to_pylist(), words.to_pylist())], np.uint64)

    def rows(at: np.ndarray, k: int, h: np.ndarray) -> Iterator[pa.RecordBatch]:
        _, first, cnt = np.unique(h, return_index=True, return_counts=True)
        for i in range(0, len(first), BATCH_ROWS):
            begin = at[first[i:i + BATCH_ROWS]]
            own = [words.take(pa.array(ids[begin + j])) for j in range(k)]
            phrase = pc.binary_join_element_wise(*own, pa.scalar(b" ", pa.binary()))
            yield pa.RecordBatch.from_arrays([langs.take(pa.array(ids[begin])), phrase.cast(pa.string()), pa.array(cnt[i:i + BATCH_ROWS], pa.int64())], schema=_ARROW)

    def marked(at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ids) + LONGEST, bool)
        out[at] = True
        return out

    def member(filter_: np.ndarray) -> np.ndarray:
        ok = has(filter_, hashes)
        ok[0] = False
        return ok

    if late is None and only in (None, 1):
        cnt = np.bincount(ids, minlength=len(words))
        cnt[0] = 0
        used = np.flatnonzero(cnt)
        some = used if often is None else used[_in_slots(often, hashes[used])]
        for i in range(0, len(some), BATCH_ROWS):
            at = pa.array(some[i:i + BATCH_ROWS])
            yield pa.RecordBatch.from_arrays([langs.take(at), words.take(at).cast(pa.string()), pa.array(cnt[some[i:i + BATCH_ROWS]], pa.int64())], schema=_ARROW)
        lang, of = np.unique(np.array(langs.to_pylist())[used], return_inverse=True)
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.nulls(len(lang), pa.string()),
                                          pa.array(np.bincount(of, cnt[used], len(lang)).astype(np.int64), pa.int64())], schema=_ARROW)
    one, is_known = hashes[ids], member(known)
    now = np.flatnonzero(is_known[ids])  # where a known phrase of k - 1 words begins
    h = np.zeros(len(ids), np.uint64)
    h[now] = one[now]
    if late is not None:
        is_late = member(late) & ~is_known
        usable = np.flatnonzero((is_known | is_late)[ids])  # where all of k words may be frequent
        full = one.copy()
        holds = marked(np.flatnonzero(is_late[ids]))  # where k - 1 words hold a late phrase
    for k in range(2, (only or LONGEST) + 1):
        begins = marked(now)
        now = now[begins[now + 1]]
        hk = _longer(h[now], one[now + k - 1])
        if late is None:
            if often is not None:  # what holds a rare phrase is rare too
                ok = _in_slots(often, hk)
                now, hk = now[ok], hk[ok]
            if len(now) and only in (None, k):
                yield from rows(now, k, hk)
        else:
            border = marked(now)
            begins = marked(usable)
            usable = usable[begins[usable + 1]]
            full[usable] = _longer(full[usable], one[usable + k - 1])
            new = usable[(holds[usable] | holds[usable + 1]) & ~border[usable]]
            if len(new):
                yield from rows(new, k, full[new])
            holds = marked(np.concatenate([usable[holds[usable] | holds[usable + 1]], now[has(late, hk) & ~has(known, hk)]]))
        h = np.zeros(len(ids), np.uint64)
        h[now] = hk
        now = now[has(known, hk)]


def count_pass(chunks: DataFrame, known: np.ndarray | str, late: np.ndarray | str | None = None, only: int | None = None,
               often: np.ndarray | str | None = None) -> DataFrame:
    """(lang, phrase, cnt) over all of ``chunks``: the known phrases and their border, the single words
    and a row of all words of a lang (phrase null). With ``late``, phrases of the border that turned
    out to be frequent, the longer phrases instead that hold a late one, whose words are all known
    or late, and that are neither known nor border themselves. ``only`` counts one length; ``often``
    leaves out phrases whose slot, or that of a part, it does not hold."""
    names = [None if x is None else handed_out(chunks.sparkSession, x) for x in (known, late, often)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, late, often = (None if x is None else mapped(x) for x in names)
        for b in batches:
            for i in range(b.num_rows):
                langs, words = (b.column(c)[i].values for c in ("langs", "words"))
                yield from _counts(langs, words, np.frombuffer(b.column("ids")[i].as_buffer(), np.int32), known, late, only, often)

    return chunks.mapInArrow(run, _COUNTED).groupBy("lang", "phrase").agg(F.sum("cnt").alias("cnt"))


def _fresh(counted: DataFrame, known: np.ndarray | str) -> DataFrame:
    """(h, words) of the phrases of ``counted`` that are not in ``known``."""
    name = handed_out(counted.sparkSession, known)

    def run(cols):
        phrases = cols["phrase"].to_pylist()
        h = np.array([phrase_hash(*x) for x in zip(cols["lang"].to_pylist(), phrases)], np.int64)
        ok = ~has(mapped(name), h)
        return {"h": h[ok], "words": [p.count(" ") + 1 for p, o in zip(phrases, ok) if o]}

    return map_batches(counted.where("phrase is not null").select("lang", "phrase"), run, "h long, words int")


def mine(chunks: DataFrame, least: int, bits: int, seed: np.ndarray) -> DataFrame:
    """All phrases of ``chunks`` with ``least`` occurrences or more, and the rows of all words of a
    lang. ``seed`` holds the proposed phrases. If phrases of the border are frequent, a further
    pass counts all longer phrases that hold one of them; a frequent phrase that the first pass did
    not count holds a smallest part that was not proposed, which is border and frequent, so with
    that pass the search is closed."""
    enough = (F.col("cnt") >= least) | F.col("phrase").isNull()
    seed = handed_out(chunks.sparkSession, seed)
    often = handed_out(chunks.sparkSession, often_slots(chunks, seed, least, bits))
    got = written(count_pass(chunks, seed, often=often).where(enough), "phrases")
    fresh = written(_fresh(got, seed), "fresh")
    if not fresh.where(F.col("words") < LONGEST).limit(1).count():
        return got
    late = handed_out(chunks.sparkSession, collected(filter_blocks(fresh.select("h"), bits), "once", bits))
    return got.unionByName(written(count_pass(chunks, seed, late).where(enough), "phrases"))


def proposed(chunks: DataFrame, least: int, bits: int) -> np.ndarray:
    """The filter of the phrases with ``least`` occurrences or more in a sample, found length by
    length: a pass counts the phrases whose parts are frequent."""
    known = np.zeros(bits // 8, np.uint8)
    for length in range(1, LONGEST + 1):
        told = handed_out(chunks.sparkSession, known if length > 1 else np.zeros(1 << 10, np.uint8))
        got = count_pass(chunks, told, only=length).where((F.col("cnt") >= least) & F.col("phrase").isNotNull())
        fresh = written(_fresh(got, told), "fresh")
        if not fresh.where(F.col("words") == length).limit(1).count():
            break
        known |= collected(filter_blocks(fresh.select("h"), bits), "once", bits)
    return known


@contextmanager
def _small_batches(spark: SparkSession):
    """What is run inside sends batches of about ``BATCH_BYTES`` to Python."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def frequent_phrases(docs: DataFrame, least: int = 100, share: int = 10) -> DataFrame:
    """(lang, phrase, cnt) of phrases of 1 to 5 words with ``least`` occurrences or more, and one
    row with a null phrase per lang that counts all words. ``docs`` has (lang, text). One piece in
    ``share`` is the sample; the bound there lies two standard deviations below ``least / share``.
    Texts are read once."""
    with _small_batches(docs.sparkSession):
        chunks = written(encoded(docs), "chunks", **_ALONE)
        sample = written(sampled(chunks, share), "sample", **_ALONE)
        size = sample.agg(F.sum(F.octet_length("ids"))).first()[0] or 0
        bits = bits_for(size // 4, 2)
        mean = least / share
        return mine(chunks, least, bits, proposed(sample, max(2, round(mean - 2 * mean ** 0.5)), bits))


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, share: int = 10,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of 2 to 5 words of each lang.

    A phrase cut after its first words scores ``floor(1000 * a * n / (l * r))`` at its lowest cut.
    Phrases inside a longer one that is as frequent are left out. Null langs are ``und``, null texts
    are empty, each row counts as it is, repeated ones too; a lang without frequent phrases has no
    rows; other columns are ignored; texts are taken whole whatever their length.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    found = written(frequent_phrases(rows, least, share), "frequent")
    total = found.where("phrase is null").select("lang", F.col("cnt").alias("n"))
    known = found.where("phrase is not null")
    phrase = known.withColumn("w", F.split("phrase", " ")).where(F.size("w") > 1)
    cuts = phrase.select("lang", "phrase", F.col("cnt").alias("a"), "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", 1, F.col("k")), " ").alias("first"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").alias("rest"))
    part = lambda name, cnt: known.select("lang", F.col("phrase").alias(name), F.col("cnt").alias(cnt))
    scored = (cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"]).join(total, "lang")
              .select("lang", "phrase", "a", "n", F.struct(F.expr("(1000 * cast(a as decimal(17,0)) * cast(n as decimal(17,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))").alias("score"), "k", "l", "r").alias("c")))
    best = scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("n").alias("n"), F.min("c").alias("c"))
    longer = phrase.where(F.size("w") > 2).select("lang", "cnt", F.explode(F.array(
        F.array_join(F.slice("w", 1, F.size("w") - 1), " "), F.array_join(F.slice("w", 2, F.size("w") - 1), " "))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("cnt").alias("most"))
    kept = best.join(longer, ["lang", "phrase"], "left").where("most is null or most < a")
    flat = kept.select("lang", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), "n", F.col("c.score").alias("score"))
    ranked = first_rows(flat, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top, ["phrase"])
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


#: The same by counting all phrases of all lengths.
OP12_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
worded as (
  select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as w from pieces),
placed as (select lang, w, unnest(range(1, len(w) + 1)) as i from worded),
grams as (select lang, w, i, unnest([1, 2, 3, 4, 5]) as k from placed),
f as (
  select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase, count(*) as c
  from grams where i + k - 1 <= len(w) group by 1, 2, 3),
totals as (select lang, sum(c)::bigint as n from f where k = 1 group by lang),
cand as (select lang, k, phrase, c as a from f where k > 1 and c >= 100),
cuts as (
  select lang, k, phrase, a, unnest(range(1, k)) as cut, string_split(phrase, ' ') as w from cand),
scored as (
  select c.lang, c.phrase, c.a, c.k, c.cut, l.c as l, r.c as r, n,
         ((1000::hugeint * c.a * n) // (l.c::hugeint * r.c))::bigint as score
  from cuts c
  join f l on l.lang = c.lang and l.k = c.cut and l.phrase = array_to_string(w[1:c.cut], ' ')
  join f r on r.lang = c.lang and r.k = c.k - c.cut and r.phrase = array_to_string(w[c.cut + 1:], ' ')
  join totals t on t.lang = c.lang),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
kept as (
  select * from lowest x where not exists (
    select 1 from cand y where y.lang = x.lang and y.k > x.k and y.a >= x.a
      and contains(' ' || y.phrase || ' ', ' ' || x.phrase || ' ')))
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n, score from (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
where rank <= 2000
"""
