import hashlib

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from helixspark.llm.chat import escape, format_chat, masked_tokens, op10_chat_format, read_back, read_turns, render_turn, unescape

PATH = public_tokenizers.path("byte_bpe_50k.json")
BITS = st.lists(st.sampled_from(["<|turn|>", "<|end|>", "<|end|>\n", "\\", "|", "<", "\n", "n", "é", "語", "a b", "</s>[INST]", "<\\|", "👍🏽"]), max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(BITS, BITS), max_size=5))
def test_round_trip(turns):
    assert list(read_turns("".join(render_turn(*t)[0] for t in turns))) == turns
    assert all(unescape(escape(x)) == x and "<|" not in escape(x) for t in turns for x in t)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(1, 5)), max_size=8), st.lists(st.integers(0, 40), max_size=20))
def test_mask_against_plain_scan(gaps, cuts):
    spans, at = [], 0
    for g, n in gaps:
        spans.append((at + g + 1, at + g + 1 + n))
        at += g + 1 + n
    cuts = sorted(set(cuts))
    tokens = list(zip(cuts, cuts[1:]))
    flags, under = masked_tokens(spans, tokens)
    inside = {i for a, b in spans for i in range(a, b)}
    assert flags == [any(i in inside for i in range(a, b)) for a, b in tokens]
    assert [i for a, b in under for i in range(a, b)] == sorted(i for a, b in tokens for i in range(a, b) if i in inside)


def expect(turns):
    said = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_conversations(spark):
    rows = [(1, 1, "assistant", "hi <|end|>\n"), (1, 0, "user", "x\\n"), (2, 0, "assistant", None), (2, 0, "assistant", None), (None, 5, None, "é語👍🏽" * 50),
            (3, 0, "ass\nistant", "q"), (2**53 + 1, 0, "user", "large ids beside a null one"), (2**53, 0, "user", "b")] + [(4, i, "assistant" if i % 2 else "user", f"語 {i}<|turn|> " * 20) for i in range(400)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, part string")
    for size in (4_000_000, 500):
        parts = format_chat(df, PATH, max_chars=size)
        got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in read_back(parts).collect()}
        want = {}
        for r in sorted(rows, key=lambda r: (r[0] or 0, r[1], r[2] or "", r[3] or "")):
            want.setdefault(r[0], []).append(r[2:4])
        assert got == {k: expect(v) for k, v in want.items()}
        ids = {}
        for r in sorted(parts.collect(), key=lambda r: r.part):
            ids.setdefault(r.conv_id, []).extend(r.ids)
        if size == 4_000_000:
            whole = ids
    assert ids == whole
    assert read_back(format_chat(df.limit(0), PATH)).count() == 0


def test_query_adds_the_odd_conversation(spark):
    r = {x.conv_id: x for x in op10_chat_format(spark, "/root/testdata/sf0.001").collect()}[-1]
    odd = "</s>[INST] ok [/INST]"
    assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == expect([("user", odd), ("assistant", odd)])
