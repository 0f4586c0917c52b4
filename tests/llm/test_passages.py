import random
import re

from pyspark.sql import functions as F

from helixspark.llm import paragraphs
from helixspark.llm.paragraphs import numbered, repeated_paragraphs, repeated_passages, without_repeats

W = 50


def windows(rows):
    """Places (row, first word) of each run of 50 words, and the words' spans."""
    at, words = {}, []
    for i, (_, t) in enumerate(rows):
        m = [x.span() for x in re.finditer(r"[^ \t-\r]+", t or "")]
        words.append(m)
        w = [t[a:b].encode().lower() for a, b in m]
        for j in range(len(w) - W + 1):
            at.setdefault(tuple(w[j:j + W]), []).append((i, j))
    return at, words


def brute(rows):
    """Words (row, number) of every occurrence but the first that is disjoint from the first."""
    at, words = windows(rows)
    gone = set()
    for places in at.values():
        i, j = min(places, key=lambda p: (rows[p[0]][0] is None, rows[p[0]][0] or 0, p))
        gone |= {(x, y + k) for x, y in places if x != i or abs(y - j) >= W for k in range(W)}
    return gone, words


def cut_words(rows, found):
    _, words = windows(rows)
    by_id = {d: i for i, (d, _) in enumerate(rows)}
    return {(by_id[r.doc_id], k) for r in found if not r.kept for k, (a, b) in enumerate(words[by_id[r.doc_id]]) if r.start <= a and b <= r.end}


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def wrapped(r, words, most=12):
    """Words on lines of up to ``most`` words."""
    out, at = [], 0
    while at < len(words):
        n = r.randint(1, most)
        out.append(" ".join(words[at:at + n]))
        at += n
    return "\n".join(out)


def test_wrapped_and_embedded_runs_against_all_windows(spark):
    r = random.Random(5)
    word = lambda: f"é{r.randint(0, 400)}"
    shared = [[word() for _ in range(n)] for n in (49, 50, 51, 60, 130)]
    rows = []
    for i in range(80):
        w = [word() for _ in range(r.randint(0, 150))]
        for s in shared:
            if r.random() < 0.3:
                at = r.randint(0, len(w))
                w[at:at] = [x.upper() if r.random() < 0.2 and x.isascii() else x for x in s[r.choice([0, 0, 3]):]]
        rows.append((i, wrapped(r, w)))
    rows += [(500, None), (501, ""), (502, "x " * 300), (503, "x\n" * 300), (504, wrapped(r, shared[4] + shared[4]))]
    found = repeated_passages(frame(spark, rows)).collect()
    gone, _ = brute(rows)
    assert gone and cut_words(rows, found) == gone
    assert all(x.end > x.start and x.n_words >= W for x in found)


def test_runs_inside_longer_lines(spark):
    r = random.Random(6)
    text = lambda n: [f"w{r.randint(0, 10**6)}" for _ in range(n)]
    s = text(54)
    rows = [(i, " ".join(text(90) + s + text(70))) for i in (39, 900)] + [(7, "short")]
    df = frame(spark, rows)
    assert repeated_paragraphs(df).count() == 0
    found = sorted((x.doc_id, rows[[d for d, _ in rows].index(x.doc_id)][1][x.start:x.end], x.n_words, x.component_id, x.kept) for x in repeated_passages(df).collect())
    assert found == [(39, " ".join(s), 54, 39, True), (900, " ".join(s), 54, 39, False)]
    clean = {x.doc_id: x.text for x in without_repeats(df).collect()}
    assert clean[39] == rows[0][1] and clean[900] == rows[1][1].replace(" ".join(s) + " ", "") and clean[7] == "short"


def test_lines_and_runs_together(spark):
    r = random.Random(9)
    text = lambda n: [f"w{r.randint(0, 10**6)}" for _ in range(n)]
    line, tail = text(80), text(60)
    near = line[:40] + ["other"] + line[41:]
    rows = [(1, " ".join(line)), (2, "\n".join([" ".join(near), wrapped(r, tail)])), (3, " ".join(text(50) + tail + text(5))), (4, " ".join(text(120) + near[10:] + text(90)))]
    df = frame(spark, rows)
    clean = {x.doc_id: x.text for x in without_repeats(df).collect()}
    at, _ = windows(sorted(clean.items()))
    assert all(len(p) == 1 for p in at.values())
    assert clean[1] == rows[0][1] and clean[2].split() == tail and " ".join(tail) not in clean[3]
    # the one left of what stands in a removed line and in a longer one is in the longer one
    assert " ".join(near[10:]) in clean[4]


def test_real_rows_leave_no_repeated_window(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = sorted(map(tuple, d.collect()))
    found = repeated_passages(d).collect()
    cut = cut_words(rows, found)
    at, _ = windows(rows)
    # all occurrences of each window but one at most lose all their words
    for places in at.values():
        whole = [p for p in places if any((p[0], p[1] + k) not in cut for k in range(W))]
        assert len({x for x, _ in whole}) <= 1, whole
    assert cut


def test_rows_of_one_id_are_documents_of_their_own(spark):
    r = random.Random(7)
    text = lambda n: " ".join(f"w{r.randint(0, 10**6)}" for _ in range(n))
    s, clean, other = text(60), text(200), text(80)
    rows = [(None, s + "\nalpha"), (None, s + "\nbeta"), (None, clean), (5, s + "\nfive"), (5, other), (6, other), (6, other), (None, None)]
    for df in (frame(spark, rows), spark.createDataFrame(rows, "doc_id long, text string")):
        out = sorted((x.doc_id or 0, x.text or "") for x in without_repeats(df).collect())
        assert out == sorted([(0, "alpha"), (0, "beta"), (0, clean), (5, s + "\nfive"), (5, other), (6, ""), (6, ""), (0, "")])


def test_row_names_are_stable(spark, tmp_dir):
    spark.range(1000).selectExpr("id % 7 doc_id", "cast(id as string) text").repartition(3).write.parquet(tmp_dir + "/t")
    df = spark.read.parquet(tmp_dir + "/t").select("doc_id", "text")
    a, b = numbered(df), numbered(df)
    assert a.join(b.select("__row", F.col("text").alias("other")), "__row").where("text = other").count() == 1000
    joined = df.join(df.select("doc_id").distinct().crossJoin(spark.range(2)), "doc_id")
    assert numbered(joined).select("__row").distinct().count() == 2000



def test_windows_of_copies_are_not_listed_one_by_one(spark, monkeypatch):
    r = random.Random(11)
    text = lambda n: " ".join(f"w{r.randint(0, 10**6)}" for _ in range(n))
    wrap = lambda t: t.replace(" ", "\n")
    a, b = text(300), text(200)
    # b's copies differ in a word, so the names around it have several segments
    rows = [(i, wrap(a)) for i in range(30)] + [(i, wrap(b)) for i in range(40, 60)] + [(60, wrap(b.replace(b.split(" ")[100], "other")))]
    listed, real = {}, paragraphs.written

    def counted(df, name, *a):
        listed[name] = (out := real(df, name, *a)).count()
        return out

    monkeypatch.setattr(paragraphs, "written", counted)
    found = repeated_passages(frame(spark, rows)).collect()
    gone, _ = brute(rows)
    assert cut_words(rows, found) == gone
    # 30 * 251 and 20 * 151 windows occur again; a distinct one of a name with several segments is listed once
    assert listed["windows"] < 251 and listed["pieces"] < 21 * 80 + 30 * 80


def test_segments_are_cut_where_a_line_changes_the_outcome(spark):
    r = random.Random(12)
    word = lambda: f"w{r.randint(0, 10**6)}"
    text = lambda n: [word() for _ in range(n)]
    head, line, tail = text(90), text(80), text(90)
    whole = "\n".join([wrapped(r, head), " ".join(line), wrapped(r, tail)])
    flat = wrapped(r, head + line + tail)
    rows = [(1, " ".join(line)), (2, whole), (3, flat), (4, whole), (5, flat), (6, wrapped(r, text(9) + line[30:] + tail))]
    clean = {x.doc_id: x.text for x in without_repeats(frame(spark, rows)).collect()}
    at, _ = windows(sorted(clean.items()))
    assert all(len(p) == 1 for p in at.values())
    assert clean[1] == rows[0][1]


def test_passages_reach_python_in_small_batches(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    repeated_passages(frame(spark, [(1, "a")])).collect()
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) == paragraphs.BATCH_BYTES
