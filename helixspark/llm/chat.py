"""Chat formatting with a loss mask aligned by offsets.

A conversation is rendered whole with turn marks, encoded once with character offsets,
and the token spans are met with the sorted spans of the trained turns by binary search.
The text spans under the mask are kept beside the token flags, so a token that straddles
a border or shares a character adds no text twice.

Rows of a conversation may be many: rows are dealt by conversation, sorted by turn and
read as a stream. A conversation longer than ``max_chars`` is written in parts cut in front
of a turn mark, where the tokenizer always splits, so ids equal those of one encoding.

Cases: null text and role are empty; rows tie by turn, then role, then text; null turns
come first; repeated rows are repeated turns; a null conversation id is a conversation of
its own; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixspark.llm.common import table

OPEN, CLOSE = "<|turn|>", "<|end|>\n"
PART = ("conv_id {kind}, part int, formatted string, n_tokens long, ids array<int>, offsets array<int>,"
        " loss array<boolean>, loss_spans array<int>")


def escape(s: str) -> str:
    """No turn mark can arise: a bar after ``<`` gets a backslash, backslashes are doubled."""
    return s.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(s: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], s, flags=re.S)


def render_turn(role: str, text: str) -> tuple[str, int]:
    """The marked turn and where its text begins; a line break in a role is escaped too."""
    head = OPEN + escape(role).replace("\n", "\\n") + "\n"
    return head + escape(text) + CLOSE, len(head)


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """Roles and texts back from the formatted text."""
    for block in formatted.split(OPEN)[1:]:
        role, _, text = block.removesuffix(CLOSE).partition("\n")
        yield unescape(role), unescape(text)


def masked_tokens(spans: list[tuple[int, int]], offsets: list[tuple[int, int]]) -> tuple[list[bool], list[tuple[int, int]]]:
    """Loss flag of each token and the joined character spans under it. ``spans`` are sorted
    and apart; each token finds its first span by binary search."""
    ends = [b for _, b in spans]
    flags, under = [], []
    for a, b in offsets:
        k, hit = bisect.bisect_right(ends, a), False
        while k < len(spans) and spans[k][0] < b:
            x, y = max(a, spans[k][0]), min(b, spans[k][1])
            if x < y:
                hit = True
                if under and x <= under[-1][1] and under[-1][0] >= spans[k][0]:
                    under[-1] = (under[-1][0], max(y, under[-1][1]))
                else:
                    under.append((x, y))
            k += 1
        flags.append(hit)
    return flags, under


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    t.encode_special_tokens = True
    return t


def format_chat(df: DataFrame, tokenizer_path: str, trained: tuple[str, ...] = ("assistant",),
                max_chars: int = 4_000_000) -> DataFrame:
    """One row per conversation part: the formatted text, ids, flattened offsets, loss flags
    per token and the flattened character spans under the loss."""
    kind = df.schema["conv_id"].dataType.simpleString()
    # Ids pass through pandas as text: numbers beside a null would become doubles there.
    d = df.select(F.col("conv_id").cast("string").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    d = d.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def emit(conv, part, pieces, spans):
        text = "".join(pieces)
        e = _tokenizer(tokenizer_path).encode(text, add_special_tokens=False)
        flags, under = masked_tokens(spans, e.offsets)
        return (conv, part, text, len(e.ids), e.ids, [x for o in e.offsets for x in o], flags, [x for s in under for x in s])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = PART.format(kind="string").replace(",", "").split()[::2]
        conv, part, pieces, spans, size, begun = None, 0, [], [], 0, False
        for f in frames:
            out = []
            for c, role, text in zip(f["conv_id"], f["role"], f["text"]):
                c = None if pd.isna(c) else c
                if begun and (c != conv or size >= max_chars):
                    out.append(emit(conv, part, pieces, spans))
                    part, pieces, spans, size = part + 1 if c == conv else 0, [], [], 0
                conv, begun = c, True
                s, at = render_turn(role, text)
                if role in trained:
                    spans.append((size + at, size + len(s) - len(CLOSE)))
                pieces.append(s)
                size += len(s)
            if out:
                yield pd.DataFrame(out, columns=names).astype({"conv_id": object})
        if begun:
            yield pd.DataFrame([emit(conv, part, pieces, spans)], columns=names).astype({"conv_id": object})

    return d.mapInPandas(run, PART.format(kind="string")).withColumn("conv_id", F.col("conv_id").cast(kind))


def read_back(parts: DataFrame) -> DataFrame:
    """Digests per conversation, from the formatted text and the loss spans alone. Parts of a
    conversation are met in order; hashes run on, so no whole conversation is joined."""
    kind = parts.schema["conv_id"].dataType.simpleString()
    p = parts.select(F.col("conv_id").cast("string").alias("conv_id"), "part", "formatted", "loss_spans", "n_tokens").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now = None
        for f in frames:
            done = []
            for c, text, under, n in zip(f["conv_id"], f["formatted"], f["loss_spans"], f["n_tokens"]):
                c = None if pd.isna(c) else c
                if now is None or now[0] != c:
                    if now:
                        done.append(close(now))
                    now = [c, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, said in read_turns(text):
                    now[1] += 1
                    now[2].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for a, b in zip(under[::2], under[1::2]):
                    lost = unescape(text[a:b])
                    now[3] += len(lost)
                    now[4].update(lost.encode("utf-8", "surrogatepass"))
                now[5] += len(text)
                now[6] += int(n)
            if done:
                yield pd.DataFrame(done, columns=names).astype({"conv_id": object})
        if now:
            yield pd.DataFrame([close(now)], columns=names).astype({"conv_id": object})

    def close(x):
        return [x[0], x[1], x[2].hexdigest(), x[3], x[4].hexdigest(), x[5], x[6]]

    out = p.mapInPandas(run, "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
                             " formatted_chars long, n_tokens long")
    return out.withColumn("conv_id", F.col("conv_id").cast(kind))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", odd), (-1, 1, "assistant", odd)], conv.schema)
    return read_back(format_chat(conv.unionByName(extra), public_tokenizers.path("byte_bpe_50k.json")))
