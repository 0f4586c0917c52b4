"""Block-gzip text files (``.bgz``) read in parallel, whatever their size.

A block-gzip file is a row of gzip members of at most 64 KB that all begin with the same four
bytes, and each tells its own length. The files are read by Spark's text reader with those four
bytes as the line separator, so a file is cut into ordinary splits and every split yields whole
members. Each member is unpacked by itself; its inner lines are done, its first and last piece are
joined with those of its neighbours by the number of line ends before them in the file (a running
sum over members). The four bytes can stand inside a member by chance: its parts are then shorter
than the member tells, and are put together again by their place.

Files with the ending ``.bgz`` that are plain gzip are unpacked whole, one task a file.
"""

from __future__ import annotations

import gzip
import io
import itertools
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixspark.operators.common import prefix_sum
from helixspark.session import written_once

#: Fixed values of the format: first bytes of a member, and the place of its data.
MAGIC = b"\x1f\x8b\x08\x04"
DATA = 18
#: Bytes before the separator was cut off that a member's own length does not count.
TAIL = 8


def member_length(rest: bytes) -> int | None:
    """Whole length of a member from its bytes after ``MAGIC``; None if they are no member's start."""
    if len(rest) < DATA - 4 or rest[6:12] != b"\x06\x00BC\x02\x00":
        return None
    return int.from_bytes(rest[12:14], "little") + 1


def _unpacked(rest: bytes) -> bytes:
    return zlib.decompress(rest[DATA - 4:-TAIL], wbits=-15)


def _sorted_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces between separators -> unpacked members; pieces of a cut member stay packed."""
    for b in batches:
        out = {"file_id": [], "start": [], "at": [], "data": [], "packed": []}
        for file_id, start, at, piece in zip(*(b.column(i).to_pylist() for i in range(4))):
            if piece or start:
                whole = member_length(piece) == len(piece) + len(MAGIC)
                for k, v in zip(out, (file_id, start, at, _unpacked(piece) if whole else None, None if whole else piece)):
                    out[k].append(v)
        yield pa.RecordBatch.from_pydict(out, schema=_MEMBERS)


_MEMBERS = pa.schema([("file_id", pa.string()), ("start", pa.int64()), ("at", pa.int64()), ("data", pa.binary()), ("packed", pa.binary())])
_MEMBERS_DDL = "file_id string, start long, at long, data binary, packed binary"


def _mended(cut: DataFrame) -> DataFrame:
    """Members whose data held the separator: neighbouring pieces from one that begins a member up
    to the next such one, put together. ``cut`` holds no other pieces and is nearly always empty."""
    def run(batches):
        for b in batches:
            heads = [member_length(p) is not None for p in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([int(x) for x in heads], pa.int64())],
                                             names=["file_id", "start", "at", "packed", "head"])

    def join(batches):
        for b in batches:
            ids, starts, ats, parts = (b.column(i).to_pylist() for i in range(4))
            yield pa.RecordBatch.from_pydict({"file_id": ids, "start": starts, "at": ats, "data": [_unpacked(MAGIC.join(p)) for p in parts]},
                                             schema=pa.schema([f for f in _MEMBERS if f.name != "packed"]))

    marked = cut.select("file_id", "start", "at", "packed").mapInArrow(run, "file_id string, start long, at long, packed binary, head long")
    numbered = prefix_sum(marked, ["file_id"], ["start", "at"], "head", "member")
    whole = numbered.groupBy("file_id", "member").agg(F.sort_array(F.collect_list(F.struct("start", "at", "packed"))).alias("p"))
    whole = whole.select("file_id", F.col("p")[0]["start"].alias("start"), F.col("p")[0]["at"].alias("at"), F.transform("p", lambda x: x["packed"]).alias("parts"))
    return whole.mapInArrow(join, "file_id string, start long, at long, data binary")


def members(spark: SparkSession, paths) -> tuple[DataFrame, DataFrame]:
    """(members, others): unpacked members (file_id, start, at, data) in file order by (start, at),
    and the ``file_id`` of ``.bgz`` files that are not block-gzip."""
    raw = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.bgz").option("encoding", "ISO-8859-1")
           .option("lineSep", MAGIC.decode("latin-1")).text(paths)
           .select(F.col("_metadata.file_path").alias("file_id"), F.col("_metadata.file_block_start").alias("start"),
                   F.monotonically_increasing_id().alias("at"), F.col("value").cast("binary").alias("piece")))
    first = raw.filter("start = 0").groupBy("file_id").agg(F.min_by(F.length("piece"), "at").alias("n"))
    others = first.filter("n > 0").select("file_id")
    got = written_once(raw.join(others, "file_id", "left_anti").mapInArrow(_sorted_out, _MEMBERS_DDL), "members")
    cut = got.filter("data is null")
    whole = got.filter("data is not null").drop("packed")
    return (whole if cut.isEmpty() else whole.unionByName(_mended(cut))), others


_PIECES = pa.schema([("file_id", pa.string()), ("start", pa.int64()), ("at", pa.int64()), ("ends", pa.int64()),
                     ("head", pa.string()), ("inner", pa.list_(pa.string())), ("tail", pa.string())])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per member: its number of line ends, the text before the first, the lines between, the rest.
    Pieces are kept as Latin-1 text, as a border may fall inside a letter."""
    for b in batches:
        rows = []
        for file_id, start, at, data in zip(*(b.column(i).to_pylist() for i in range(4))):
            lines = data.split(b"\n")
            rows.append({"file_id": file_id, "start": start, "at": at, "ends": len(lines) - 1, "head": lines[0].decode("latin-1"),
                         "inner": [_text(x) for x in lines[1:-1]], "tail": lines[-1].decode("latin-1") if len(lines) > 1 else None})
        yield pa.RecordBatch.from_pylist(rows, schema=_PIECES)


def _text(line: bytes) -> str:
    return line.rstrip(b"\r").decode("utf-8", "replace")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lines = [_text("".join(p).encode("latin-1")) for p in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lines, pa.string())], names=["file_id", "line"])


def _gzip_lines(batches: Iterator[pa.RecordBatch], rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Lines of whole gzip files, in batches of ``rows``."""
    for b in batches:
        for path, content in zip(b.column(0).to_pylist(), b.column(1)):
            with gzip.open(io.BytesIO(content.as_buffer()), "rt", encoding="utf-8", errors="replace", newline="\n") as f:
                while lines := [x.rstrip("\r\n") for x in itertools.islice(f, rows)]:
                    yield pa.RecordBatch.from_pydict({"file_id": [path] * len(lines), "line": lines})


def read_bgzf_lines(spark: SparkSession, paths) -> DataFrame:
    """(file_id, line) of all ``.bgz`` files below ``paths``; empty last lines are left out."""
    whole, others = members(spark, paths)
    parts = written_once(whole.select("file_id", "start", "at", "data").mapInArrow(
        _pieces, "file_id string, start long, at long, ends long, head string, inner array<string>, tail string"), "bgzf-lines")
    # Line number in the file of a member's first piece: the line ends before it.
    edge = prefix_sum(parts.drop("inner"), ["file_id"], ["start", "at"], "ends", "line_no", inclusive=False)
    piece = lambda no, text: edge.select("file_id", no.alias("line_no"), "start", "at", F.col(text).alias("text"))
    pieces = piece(F.col("line_no"), "head").unionByName(piece(F.col("line_no") + F.col("ends"), "tail").filter("text is not null"))
    # A member with one line end or more gives a tail of a later line than its head, so (start, at) orders a line's pieces.
    lines = pieces.groupBy("file_id", "line_no").agg(F.sort_array(F.collect_list(F.struct("start", "at", "text"))).alias("p"))
    lines = lines.select("file_id", F.transform("p", lambda x: x["text"]).alias("p")).mapInArrow(_joined, "file_id string, line string")
    inner = parts.select("file_id", F.explode("inner").alias("line"))
    plain = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.bgz").load(paths)
    plain = plain.select(F.col("path").alias("file_id"), "content").join(others, "file_id", "left_semi")
    return inner.unionByName(lines.filter("line <> ''")).unionByName(plain.mapInArrow(_gzip_lines, "file_id string, line string"))
