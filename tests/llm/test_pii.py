import itertools
import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helixspark.llm.pii import KINDS, LABELS, base_spans, default_field, field_spans, find_pii, labelled_table, scan_pii, stretches, viterbi


def plain_base(t):
    out = [(m.start(), m.end(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), m.end(), 1) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if max(map(int, m[0].split("."))) <= 255]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()]
        s = sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(reversed(d)))
        if 12 <= len(d) <= 19 and s % 10 == 0:
            out.append((m.start(), m.end(), 2))
    return out + [(m.start(), m.end(), 3) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.findall("[0-9]", m[0])) <= 15]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["4539578763621486", "4539 5787-6362 1486", "+1 (017) 555-7713", "+", "a.b", "@", "x-y.com", ".", " ", "-", "256.1.1.1", "10.0.0.255", "1.2.3", "007", "(", ")", "é", "²", "\n", "0000"]), max_size=12).map("".join))
def test_base_against_plain_patterns(t):
    assert sorted(base_spans(t)) == sorted(plain_base(t))


def test_base_is_linear_in_long_runs():
    begun = time.perf_counter()
    for t in ("7" * 1_000_000, "a" * 1_000_000 + "@", "a@" * 300_000, "@" + "b" * 1_000_000, "1.2.3" * 200_000, "a.b" * 300_000 + "@x.y"):
        base_spans(t)
    assert time.perf_counter() - begun < 12
    for t in ("a@b@c.d@e.f-@g.h", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8 01.2.3.4", "@", "a@b..c", "x@y.z@"):
        assert sorted(base_spans(t)) == sorted(plain_base(t))


def test_viterbi_against_all_paths():
    r = np.random.default_rng(2)
    k = len(LABELS)
    move, first = r.normal(size=(k, k)), r.normal(size=k)
    seqs = [r.normal(size=(n, k)) for n in (1, 4, 2, 3, 1)]
    for s, got in zip(seqs, viterbi(seqs, move, first)):
        best = max(itertools.product(range(k), repeat=len(s)), key=lambda p: first[p[0]] + sum(s[i, x] for i, x in enumerate(p)) + sum(move[a, b] for a, b in zip(p, p[1:])))
        assert list(best) == got


@given(st.text("a1@ \n.", max_size=120))
def test_stretches_cover_every_digit(t):
    s = stretches(t)
    assert all(a < b for a, b in s) and all(x[1] <= y[0] for x, y in zip(s, s[1:]))
    assert all(any(a <= i < b for a, b in s) for i, c in enumerate(t) if c in "1@")


def test_held_out_accuracy():
    rows = labelled_table(400, seed=99)
    found = field_spans([t for t, _ in rows], default_field())
    hit = sum(len(set(a) & set(b)) for a, (_, b) in zip(found, rows))
    assert hit / sum(len(b) for _, b in rows) > 0.9 and hit / max(1, sum(map(len, found))) > 0.9


def test_added_spans_and_clean_text():
    def added(t):
        return [(KINDS[k], t[a:b]) for a, b, k in find_pii([t], default_field())[0][1]]

    assert added("call (555) 123-4567 now") == [("phone", "(555) 123-4567")]
    assert added("write to bob12 (at) mail (dot) com please")[0][0] == "email"
    for clean in ("in 1999 and 2004 there were 3 of 12", "price $12.50 or 1,200,000", "version 1.2.3 of 2020-01-31", "at 12:30 on page 4", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"'):
        assert added(clean) == [], clean


def test_rows(spark):
    r = random.Random(1)
    rows = [(1, None), (2, ""), (None, "a.b@c.de"), (2, "1 " * 50000 + "10.0.0.1"), (3, "x" * 200000), (4, " ".join(str(r.randint(0, 10**6)) for _ in range(3000)))]
    out = scan_pii(spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, n_ip int"), default_field()).collect()
    assert sorted((x.doc_id or 0, x.n_email, x.n_ip) for x in out) == sorted((i or 0, *(sum(s[2] == k for s in plain_base(t or "")) for k in (0, 1))) for i, t in rows)
    assert scan_pii(spark.createDataFrame([], "doc_id long, text string"), default_field()).count() == 0


def test_whole_spans_of_written_addresses():
    def added(t):
        return [(KINDS[k], t[a:b]) for a, b, k in find_pii([t], default_field())[0][1]]

    for form in ("bob12 (at) verylongcompanyname (dot) org", "anna77 (at) longdomain (dot) com", "john (at) mail (dot) com",
                 "mary [at] internationalcompany [dot] org"):
        assert added(f"write to {form} please") == [("email", form)], form


def test_stretches_end_at_words():
    t = "abcdefghijklmnopqrstuvwxyzabcdefghijklm 7 " + "y" * 60 + " end"
    assert [t[a:b] for a, b in stretches(t)] == [t[:-4]]


def test_a_span_over_the_border_of_two_runs_is_whole():
    for pad in range(250, 258):
        t = "7 " * pad + "call (555) 123-4567 now"
        a = t.index("(555)")
        assert (a, a + 14, 3) in field_spans([t], default_field())[0], pad
