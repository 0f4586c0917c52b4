"""Personal data: base patterns plus a linear-chain conditional random field.

The field labels the tokens of every stretch of text around a digit, an at sign or a written cue
such as ``(at)`` or ``[dot]`` (each kind of span holds one), by features of token shapes. Stretches
end at word ends. The field is trained at the start from a small labelled table
(``labelled_table``) and decoded by Viterbi, all stretches of a batch in lockstep in numpy. Spans it
finds beside the base ones are added; base spans always stay.

Cases: null text is empty; repeated rows give repeated rows; null ids stay null; whole texts
are scanned; a stretch of more than ``LONGEST`` tokens is labelled in runs of that many, each decoded
with ``OVERLAP`` tokens of its neighbours, and spans go on from run to run; an empty table gives no
rows.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixspark.llm.common import map_batches, table, texts_of
from helixspark.llm.spans import Span, listed, replaced

KINDS = ("email", "ip", "card", "phone")

#: What may stand before an at sign, and what must follow it.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\s]")
ANCHOR = re.compile(r"[0-9@]+|[(\[{<][\x20\t]*(?:at|dot)[\x20\t]*[)\]}>]", re.I | re.A)
SPACE = re.compile(r"\s")
#: Characters of context on either side of a stretch, and the gap that still joins anchors.
CONTEXT = 24
LONGEST = 256
#: Tokens of the neighbouring runs that a run is decoded with.
OVERLAP = 64

LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(c), 10)) for c in even)) % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost non-overlapping addresses, from their at signs: no character is looked at twice, as
    neither side of an address holds an at sign."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > end and text[begin - 1] in LOCAL:
            begin -= 1
        if begin < at and (m := DOMAIN.match(text, at + 1)):
            end = m.end()
            out.append((begin, end, 0))
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[Span]:
    out: list[Span] = emails(text)
    out += [(m.start(), m.end(), 1) for m in IP.finditer(text) if all(len(x.lstrip("0")) < 4 and int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        d = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), m.end(), 2))
    if "+" in text:
        out += [(m.start(), m.end(), 3) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def stretches(text: str) -> list[tuple[int, int]]:
    """Joined neighbourhoods of digits and at signs, cut at line breaks and widened to words."""
    out: list[list[int]] = []
    for m in ANCHOR.finditer(text):
        a, b = max(0, m.start() - CONTEXT), min(len(text), m.end() + CONTEXT)
        if out and m.end() <= out[-1][1]:
            a = m.start()
        while a and not text[a - 1].isspace() and not (out and a <= out[-1][1]):
            a -= 1
        if out and b <= out[-1][1]:
            b = out[-1][1]
        elif b < len(text) and not text[b - 1].isspace():
            b = e.start() if (e := SPACE.search(text, b)) else len(text)
        if out and a <= out[-1][1] and text.find("\n", out[-1][2], m.start()) < 0:
            out[-1][1:] = [b, m.end()]
        else:
            out.append([max(a, out[-1][1] if out else 0, text.rfind("\n", 0, m.start()) + 1), b, m.end()])
        cut = text.find("\n", m.end(), out[-1][1])
        if cut >= 0:
            out[-1][1] = cut
    return [(a, b) for a, b, _ in out]


WORDS = frozenset("at dot com org net tel phone call fax mobile mail email ip host server card visa version page year total id number "
                  "price room chapter date line".split())


def _shape(t: str) -> str:
    if t[0].isdigit():
        return f"d{min(len(t), 17)}"
    if t.isalpha():
        return ("A" if t[0].isupper() else "a") + ("h" if len(t) < 5 and all(c in "abcdefABCDEF" for c in t) else str(min(len(t), 3)))
    return t


def token_features(tokens: list[str], gaps: list[bool]) -> list[list[str]]:
    """Features of each token: shapes around it, whether a space stands before, and a few words."""
    s = ["<", "<", *[_shape(t) for t in tokens], ">", ">"]
    w = ["", "", *[t.lower() if t.lower() in WORDS else "" for t in tokens], "", ""]
    out = []
    for i in range(len(tokens)):
        j, g, h = i + 2, "_" if gaps[i] else "", "_" if i + 1 < len(gaps) and gaps[i + 1] else ""
        f = ["b", f"0{s[j]}", f"-{s[j - 1]}{g}", f"+{h}{s[j + 1]}", f"-0{s[j - 1]}{g}|{s[j]}", f"0+{s[j]}|{h}{s[j + 1]}",
             f"3{s[j - 1]}{g}|{s[j]}|{h}{s[j + 1]}", f"--{s[j - 2]}|{s[j - 1]}{g}|{s[j]}", f"++{s[j]}|{h}{s[j + 1]}|{s[j + 2]}"]
        f += [f"w{k}{w[j + k]}" for k in (-2, -1, 0, 1, 2) if w[j + k]]
        out.append(f)
    return out


def tokens_of(text: str) -> tuple[list[str], list[tuple[int, int]], list[bool]]:
    m = list(TOKEN.finditer(text))
    at = [x.span() for x in m]
    return [x[0] for x in m], at, [i > 0 and at[i][0] > at[i - 1][1] for i in range(len(m))]


def labelled_table(rows: int = 700, seed: int = 11) -> list[tuple[str, list[Span]]]:
    """The small labelled table, from a rule: written forms of each kind and number forms that are
    none, between carrier words. A form with ``None`` is a negative."""
    r = random.Random(seed)
    n = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    low = lambda: "".join(r.choice("abcdefghilmnoprstuvé") for _ in range(r.randint(1, 9)))
    word = lambda: low().capitalize() if r.random() < 0.2 else low()
    ip4 = lambda: ".".join(str(r.randint(0, 255)) for _ in range(4))
    hexa = lambda k: "".join(r.choice("0123456789abcdef") for _ in range(k))
    forms = [
        (0, lambda: f"{low()}.{n(2)}@{low()}{n(1)}.example.com"), (0, lambda: f"{low()}@{low()}.org"),
        (0, lambda: f"{low()}{n(2)} (at) {low()} (dot) com"), (0, lambda: f"{low()}{n(2)} [at] {low()}.net"), (0, lambda: f"{low()} (at) {low()} (dot) com"), (0, lambda: f"{low()} [at] {low()} [dot] org"), (0, lambda: f"{low()} @ {low()}.com"),
        (1, ip4), (1, ip4), (1, lambda: f"{hexa(4)}:{hexa(4)}::{hexa(4)}:{n(2)}"),
        (2, lambda: " ".join(n(4) for _ in range(4))), (2, lambda: "-".join(n(4) for _ in range(4))), (2, lambda: f"{n(4)} {n(6)} {n(5)}"),
        (3, lambda: f"+{n(1)} ({n(3)}) {n(3)}-{n(4)}"), (3, lambda: f"({n(3)}) {n(3)}-{n(4)}"), (3, lambda: f"{n(3)}-{n(3)}-{n(4)}"),
        (3, lambda: f"{n(3)}.{n(3)}.{n(4)}"), (3, lambda: f"+{n(2)} {n(2)} {n(4)} {n(4)}"), (3, lambda: f"0{n(2)} {n(4)} {n(4)}"),
        (None, lambda: n(r.randint(1, 19))), (None, lambda: n(16)), (None, lambda: n(4)), (None, lambda: f"{n(4)}-{n(2)}-{n(2)}"), (None, lambda: f"{n(1)}.{n(1)}.{n(1)}"),
        (None, lambda: f"{n(2)}.{n(2)}"), (None, lambda: f"{n(1)},{n(3)},{n(3)}"), (None, lambda: f"${n(2)}.{n(2)}"), (None, lambda: f"{n(2)}:{n(2)}"),
        (None, lambda: f"{n(2)}:{n(2)}:{n(2)}"), (None, lambda: f"{n(3)}-{n(3)}"), (None, lambda: f"({n(4)})"), (None, lambda: f"({n(1)}) {low()}"),
        (None, lambda: f'"{hexa(40)}"'), (None, lambda: hexa(12)), (None, lambda: f"{n(1)}/{n(2)}"), (None, lambda: f"{n(2)}%"), (None, lambda: f"{low()}{n(2)}"),
        (None, lambda: f"@{low()}"), (None, lambda: f"{n(1)} {n(2)} {n(1)} {n(3)}"), (None, lambda: f"{n(3)} {n(3)} {n(3)}"), (None, lambda: f"{n(5)}-{n(4)}"),
    ]
    out = []
    for i in range(rows):
        text, spans = " ".join(word() for _ in range(r.randint(0, 4))), []
        for _ in range(r.choice([1, 1, 2])):
            kind, make = forms[i % len(forms)] if not spans else r.choice(forms)
            cue = r.choice(["", "", "tel ", "number ", "mail: ", "version ", "id ", "year ", "line ", "server ", "call "])
            text += (" " if text else "") + cue
            a, form = len(text), make()
            text += form
            if kind is not None:
                spans.append((a, len(text), kind))
            text += r.choice(["", "", ".", ",", " |"]) + " " + " ".join(word() for _ in range(r.randint(0, 4)))
        out.append((text, spans))
    return out


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis))


@dataclass(frozen=True)
class Field:
    """Weights of features by label, of transitions, and of the first and last label."""

    index: dict[str, int]
    emit: np.ndarray
    move: np.ndarray
    first: np.ndarray

    def scores(self, feats: list[list[str]]) -> np.ndarray:
        at = [[self.index[f] for f in fs if f in self.index] for fs in feats]
        flat = np.fromiter((x for a in at for x in a), np.int64)
        rows = np.repeat(np.arange(len(at)), [len(a) for a in at])
        out = np.zeros((len(at), len(LABELS)))
        if len(flat):
            filled, begin = np.unique(rows, return_index=True)
            out[filled] = np.add.reduceat(self.emit[flat], begin)
        return out


def padded(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    n = np.array([len(s) for s in seqs])
    out = np.zeros((len(seqs), n.max(), len(LABELS)))
    for i, s in enumerate(seqs):
        out[i, :len(s)] = s
    return out, n


def viterbi(seqs: list[np.ndarray], move: np.ndarray, first: np.ndarray) -> list[list[int]]:
    """Best label path of each score sequence; sequences of like length advance together."""
    paths: list = [None] * len(seqs)
    order = sorted(range(len(seqs)), key=lambda i: len(seqs[i]))
    for lo in range(0, len(order), 256):
        group = order[lo:lo + 256]
        x, n = padded([seqs[i] for i in group])
        best, back = x[:, 0] + first, np.zeros(x.shape, np.int8)
        ends = np.where((n == 1)[:, None], best, 0.0)
        for t in range(1, x.shape[1]):
            s = best[:, :, None] + move
            back[:, t] = s.argmax(1)
            best = s.max(1) + x[:, t]
            ends = np.where((n == t + 1)[:, None], best, ends)
        for r, i in enumerate(group):
            path = [int(ends[r].argmax())]
            for t in range(n[r] - 1, 0, -1):
                path.append(int(back[r, t, path[-1]]))
            paths[i] = path[::-1]
    return paths


def train(rows: list[tuple[str, list[Span]]], steps: int = 80, l2: float = 1e-3) -> Field:
    """Maximum likelihood with an L2 penalty, by forward-backward over all rows at once."""
    feats, labels = [], []
    for text, spans in rows:
        tokens, at, gaps = tokens_of(text)
        y = [0] * len(tokens)
        for a, b, k in spans:
            inside = [i for i, (s, e) in enumerate(at) if s >= a and e <= b]
            for i in inside:
                y[i] = 1 + 2 * k + (i != inside[0])
        feats.append(token_features(tokens, gaps))
        labels.append(y)
    index = {f: i for i, f in enumerate(sorted({f for s in feats for fs in s for f in fs}))}
    n, size, top = np.array([len(y) for y in labels]), len(LABELS), max(map(len, labels))
    row, col = np.array([(r * top + t, index[f]) for r, s in enumerate(feats) for t, fs in enumerate(s) for f in fs]).T
    y = np.zeros((len(rows), top), np.int64)
    for r, v in enumerate(labels):
        y[r, :len(v)] = v
    live = np.arange(top) < n[:, None]
    gold = np.eye(size)[y] * live[..., None]
    pairs = np.einsum("rti,rtj->ij", gold[:, :-1], gold[:, 1:])
    by_col = np.argsort(col, kind="stable")
    filled, row_at = np.unique(row, return_index=True)
    used, col_at = np.unique(col[by_col], return_index=True)
    w = [np.zeros((len(index), size)), np.zeros((size, size)), np.zeros(size)]
    mom, var = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    for k in range(1, steps + 1):
        x = np.zeros((len(rows) * top, size))
        x[filled] = np.add.reduceat(w[0][col], row_at)
        x = x.reshape(len(rows), top, size)
        f, b = np.zeros_like(x), np.zeros_like(x)
        f[:, 0] = x[:, 0] + w[2]
        for t in range(1, top):
            step = _lse(f[:, t - 1, :, None] + w[1], 1) + x[:, t]
            f[:, t] = np.where(live[:, t, None], step, f[:, t - 1])
        for t in range(top - 2, -1, -1):
            step = _lse(w[1] + (x[:, t + 1] + b[:, t + 1])[:, None, :], 2)
            b[:, t] = np.where(live[:, t + 1, None], step, 0.0)
        z = _lse(f[:, -1], 1)
        node = np.exp(f + b - z[:, None, None]) * live[..., None]
        expect = np.zeros((size, size))
        for t in range(1, top):
            p = np.exp(f[:, t - 1, :, None] + w[1] + (x[:, t] + b[:, t])[:, None, :] - z[:, None, None])
            expect += (p * live[:, t, None, None]).sum(0)
        diff = (node - gold).reshape(-1, size)
        g0 = np.zeros_like(w[0])
        g0[used] = np.add.reduceat(diff[row[by_col]], col_at)
        grads = [g0 / len(rows) + l2 * w[0], (expect - pairs) / len(rows) + l2 * w[1], (node[:, 0] - gold[:, 0]).mean(0) + l2 * w[2]]
        for i, g in enumerate(grads):
            mom[i] = 0.9 * mom[i] + 0.1 * g
            var[i] = 0.99 * var[i] + 0.01 * g * g
            w[i] = w[i] - 0.15 * (mom[i] / (1 - 0.9 ** k)) / (np.sqrt(var[i] / (1 - 0.99 ** k)) + 1e-6)
    return Field(index, *w)


def field_spans(texts: list[str], field: Field) -> list[list[Span]]:
    """Labelled spans of whole texts; all stretches of the batch are decoded together."""
    where, seqs = [], []
    for i, text in enumerate(texts):
        for a, b in stretches(text):
            tokens, at, gaps = tokens_of(text[a:b])
            scores = field.scores(token_features(tokens, gaps))
            n = range(0, len(tokens), LONGEST)
            where.append((i, a, at, len(n)))
            seqs += [scores[max(0, lo - OVERLAP):lo + LONGEST + OVERLAP] for lo in n]
    paths = iter(viterbi(seqs, field.move, field.first))
    out: list[list[Span]] = [[] for _ in texts]
    for i, a, at, n in where:
        path: list[int] = []
        for run in range(n):
            skip = min(OVERLAP, run * LONGEST)
            path += next(paths)[skip:skip + LONGEST]
        for t, label in enumerate(path):
            if not label:
                continue
            goes_on = label % 2 == 0 and t and path[t - 1] in (label, label - 1)
            if goes_on and out[i] and out[i][-1][2] == label // 2 - 1:
                out[i][-1] = (out[i][-1][0], a + at[t][1], label // 2 - 1)
            elif label % 2 or (t and t % LONGEST == 0):
                out[i].append((a + at[t][0], a + at[t][1], (label - 1) // 2))
    return out


def find_pii(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """Base and added spans of each text; an added span meets no base span."""
    out = []
    for t, more in zip(texts, field_spans(texts, field)):
        base = base_spans(t)
        out.append((base, [s for s in more if all(s[1] <= a or b <= s[0] for a, b, _ in base)]))
    return out


def scan_pii(df: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text", block: int = 256) -> DataFrame:
    """One row per input row: the id, base counts per kind, base and all spans, and the text with
    all spans replaced by their kind. The field (some thousand weights) goes with the task."""

    def run(cols):
        out = {k: [] for k in (*(f"n_{k}" for k in KINDS), "n_added", "base_spans", "spans", "masked")}
        texts = texts_of(cols["text"])
        for lo in range(0, len(texts), block):
            some = texts[lo:lo + block]
            for t, (base, more) in zip(some, find_pii(some, field)):
                for k, name in enumerate(KINDS):
                    out[f"n_{name}"].append(sum(s[2] == k for s in base))
                out["n_added"].append(len(more))
                out["base_spans"].append(listed(base, KINDS))
                out["spans"].append(listed(base + more, KINDS))
                out["masked"].append(replaced(t, base + more, KINDS))
        return out | {id_col: cols["id"]}

    kind = df.schema[id_col].dataType.simpleString()
    return map_batches(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run,
                       f"`{id_col}` {kind}, n_email long, n_ip long, n_card long, n_phone long, n_added long,"
                       " base_spans string, spans string, masked string")


@lru_cache(maxsize=1)
def default_field() -> Field:
    return train(labelled_table())


def op8_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_pii(table(spark, sf_dir, "documents"), default_field()).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_added")
