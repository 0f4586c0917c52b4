"""Secret scan: base patterns plus sliding-window entropy with an allow-list.

Candidates are maximal runs of key characters. Over each a window slides one character
at a time; the class of its characters (hexadecimal or base64) has its own entropy
bound, and the entropy follows from counts changed by the entering and the leaving
character. Placeholders are cut out of a candidate and what is left on either side is looked at by
itself. Windows over the bound are joined to one ``entropy`` span; allow-listed candidates and
rests, and spans inside a base span, are left out.

Cases: null text is empty and has no spans; repeated rows give repeated rows; null ids
stay null; the whole of a long text is scanned, a row at a time.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixspark.llm.common import map_batches, table, texts_of
from helixspark.llm.spans import Span, listed, replaced

KINDS = ("assign", "access", "hex", "entropy")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
KEYWORDS = ("passw", "secret", "token", "api")

#: A run of key characters, taken whole from its first character.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")

#: Documented values, not secrets: UUIDs, digests with a named algorithm (whole or cut short, no longer), words joined by
#: separators, paths, and runs without a digit or without a letter.
ALLOW = (
    re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"),
    *(re.compile(rf"{name}[-_=]([0-9a-f]{{1,{size // 4}}}|[A-Za-z0-9+/_-]{{1,{-(-size // 6)}}}={{0,2}})", re.I | re.A)
      for name, size in (("md5", 128), ("sha1", 160), ("sha256", 256), ("sha384", 384), ("sha512", 512))),
    re.compile(r"/?([A-Za-z]+|[0-9]{1,8})([/_=+-]+([A-Za-z]+|[0-9]{1,8}))*[/_=+-]*"),
    re.compile(r"[^0-9]*"),
    re.compile(r"[^A-Za-z]*"),
)

#: Stand-ins within a run; they say nothing of the characters before and behind them. The first
#: is the secret key of a vendor's manual, an example as a whole.
PLACEHOLDER = re.compile(r"wJalrXUtnFEMI/K7MDENG/?bPxRfiCY[A-Za-z]{0,2}EXAMPLEKEY|EXAMPLE|example|x{5,}|X{5,}|0{5,}|12345678")

WINDOW = 20
#: Bits a character within a window: 16 letters reach 4.0, 64 letters at 20 places 4.32.
BOUNDS = {"hex": 2.9, "base64": 3.6}
HEX_LETTERS = frozenset("0123456789abcdefABCDEF")


def entropy_windows(s: str, window: int = WINDOW, bounds: dict[str, float] = BOUNDS) -> list[tuple[int, int]]:
    """Joined windows of ``s`` whose entropy reaches the bound of their class, by
    incremental counts: the sum of c * log2(c) changes only in two characters a step."""
    if len(s) < window:
        return []
    xlogx = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    total, other, out = 0.0, 0, []
    for i, ch in enumerate(s):
        if i >= window:
            gone = s[i - window]
            c = counts[gone]
            total += xlogx[c - 1] - xlogx[c]
            counts[gone] = c - 1
            other -= gone not in HEX_LETTERS
        c = counts.get(ch, 0)
        total += xlogx[c + 1] - xlogx[c]
        counts[ch] = c + 1
        other += ch not in HEX_LETTERS
        if i >= window - 1:
            bits = math.log2(window) - total / window
            if bits >= bounds["base64" if other else "hex"] - 1e-9:
                a, b = i - window + 1, i + 1
                if out and a <= out[-1][1]:
                    out[-1] = (out[-1][0], b)
                else:
                    out.append((a, b))
    return out


def allowed(s: str) -> bool:
    return any(p.fullmatch(s) for p in ALLOW)


def rests(s: str) -> list[tuple[int, int]]:
    """The parts of ``s`` between placeholders."""
    cuts = [x for m in PLACEHOLDER.finditer(s) for x in m.span()]
    return list(zip([0, *cuts[1::2]], [*cuts[::2], len(s)]))


def base_spans(text: str) -> list[Span]:
    spans: list[Span] = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        spans += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return spans + [(m.start(), m.end(), 2) for m in HEX.finditer(text)]


def entropy_spans(text: str, base: list[Span]) -> list[Span]:
    out = []
    for m in CANDIDATE.finditer(text):
        if allowed(m[0]):
            continue
        for lo, hi in rests(m[0]):
            if allowed(m[0][lo:hi]):
                continue
            for a, b in entropy_windows(m[0][lo:hi]):
                a, b = a + lo + m.start(), b + lo + m.start()
                if not any(x <= a and b <= y for x, y, _ in base):
                    out.append((a, b, 3))
    return out


def find_secrets(text: str) -> list[Span]:
    base = base_spans(text)
    return base + entropy_spans(text, base)


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, counts per kind, the text with secrets masked, and
    the base and all spans."""

    def run(cols):
        out = {k: [] for k in ("n_assign", "n_access", "n_hex", "n_entropy", "base_spans", "spans", "masked")}
        for t in texts_of(cols["text"]):
            spans = find_secrets(t)
            for k, name in enumerate(KINDS):
                out[f"n_{name}"].append(sum(s[2] == k for s in spans))
            out["base_spans"].append(listed([s for s in spans if s[2] < 3], KINDS))
            out["spans"].append(listed(spans, KINDS))
            out["masked"].append(replaced(t, spans, KINDS) if spans else t)
        return out | {id_col: cols["id"]}

    kind = df.schema[id_col].dataType.simpleString()
    return map_batches(
        df.selectExpr(f"`{id_col}` as id", f"`{text_col}` as text"), run,
        f"`{id_col}` {kind}, n_assign long, n_access long, n_hex long, n_entropy long,"
        " base_spans string, spans string, masked string")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_entropy")
