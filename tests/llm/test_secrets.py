import math
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from helixspark.llm.secrets import WINDOW, base_spans, entropy_windows, find_secrets, scan_secrets
from helixspark.llm.spans import replaced


def plain_base(t):
    out = []
    for kind, pat, ok in ((0, r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
                          (1, r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), (2, r"[0-9a-f]+", lambda m: len(m[0]) >= 24)):
        out += [(m.start(), m.end(), kind) for m in re.finditer(pat, t) if ok(m)]
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["password", "PassWD", "toKen", "api_key", "apikey", "ſecret", "=", ":", " ", '"', "'", "abcdef012345", "AKIA", "ABCDEFGH12345678",
                                 "é", "x", "-", ".", "\n", "0123456789abcdef01234567"]), max_size=14).map("".join))
def test_base_against_plain_patterns(t):
    assert sorted(base_spans(t)) == sorted(plain_base(t))


@settings(max_examples=200, deadline=None)
@given(st.text("abcdef0123456789GZ+/", min_size=0, max_size=60))
def test_incremental_entropy_is_exact(s):
    flagged = set()
    for a in range(len(s) - WINDOW + 1):
        w = s[a:a + WINDOW]
        h = -sum(c / WINDOW * math.log2(c / WINDOW) for c in Counter(w).values())
        if h >= (2.9 if all(c in "0123456789abcdefABCDEF" for c in w) else 3.6) - 1e-9:
            flagged |= set(range(a, a + WINDOW))
    assert {i for a, b in entropy_windows(s) for i in range(a, b)} == flagged


def test_kinds_and_allow_list():
    def kinds(t):
        return [k for _, _, k in sorted(find_secrets(t))]

    assert kinds("x wJalrXUtnFEMIK7MDENGbPxRfiCYzEKE9q y") == [3]
    for clean in ("123e4567-e89b-12d3-a456-426614174000", "keitlichaukeitlichaukeitlichau", "/usr/local/share/doc/some/long/path",
                  "2024-01-01_2024-12-31_backup", "===========================", "sha256-wJalrXUtnFEMIK7MDENGbPxRfiCYzEKE9q"):
        assert kinds(clean) == [], clean
    t = 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" end'
    assert kinds(t) == [0, 2]
    assert replaced(t, find_secrets(t), ("assign", "access", "hex", "entropy")) == '[assign]" end'


def test_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "password=abcdef1", "x"), (2, "a" * 300000 + " token: zzzzzzz", "x")]
    out = scan_secrets(spark.createDataFrame(rows, "doc_id long, text string, spans string")).collect()
    assert sorted((r.doc_id or 0, r.n_assign, r.n_hex) for r in out) == [(0, 1, 0), (1, 0, 0), (2, 0, 0), (2, 1, 1)]
    assert scan_secrets(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_allow_list_leaves_the_rest_of_a_run():
    key = "q7Zt9KfWm2LbXr4VnH8sYc1JdPg6TuEa3RoQiB5y"

    def found(t):
        return [t[a:b] for a, b, k in find_secrets(t) if k == 3]

    for t in (f"/example/app/{key}", f"example_cred={key}", f"services/T00000000/B00000000/{key}", f"{key[:20]}00000{key[20:]}",
              f"md5-{key}", f"sha1_{key}", f"12345678{key}", f"{key}_EXAMPLE"):
        assert set("".join(found(t))) >= set(key), t
        assert key not in replaced(t, find_secrets(t), ("assign", "access", "hex", "entropy"))
    for clean in ("md5-0123456789abcdef0123456789abcdef"[:30], "sha1=" + key[:27] + "=", "sha256-" + key + "abc=", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY",
                  "my-example-key-0000000000000000", "path/to/example/folder/12345678/file"):
        assert found(clean) == [], clean
