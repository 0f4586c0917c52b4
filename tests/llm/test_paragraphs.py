import random

from helixspark.llm.paragraphs import cut, repeated_paragraphs, spans_of, tuned, without_spans


def brute(rows, k=5, t=80):
    occ = []
    for d, text in rows:
        for a, b, n in spans_of(text or ""):
            w = (text[a:b]).encode().lower().split()
            occ.append((d, a, b, n, {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}))
    root = list(range(len(occ)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(occ):
        for j in range(i):
            y = occ[j]
            if 100 * len(x[4] & y[4]) >= t * len(x[4] | y[4]):
                root[find(i)] = find(j)
    groups = {}
    for i, x in enumerate(occ):
        groups.setdefault(find(i), []).append((x[0] is None, x[0] or 0, x[1]))
    out = []
    for i, x in enumerate(occ):
        g = groups[find(i)]
        if len(g) > 1:
            least = min(g)
            out.append((x[0], x[1], x[2], x[3], None if least[0] else least[1], (x[0] is None, x[0] or 0, x[1]) == least))
    return out


def test_against_all_pairs(spark):
    r = random.Random(8)
    word = lambda: f"w{r.randint(0, 3000)}"
    shared = [" ".join(word() for _ in range(r.choice([45, 60, 120]))) for _ in range(6)]
    rows = []
    for i in range(120):
        lines = [" ".join(word() for _ in range(r.choice([5, 30, 50, 90]))) for _ in range(r.randint(0, 4))]
        for s in shared:
            if r.random() < 0.3:
                w = s.split()
                for _ in range(r.randint(0, 3)):
                    w[r.randrange(len(w))] = word()
                lines.insert(r.randint(0, len(lines)), " ".join(w))
        rows.append((i, "\n".join(lines)))
    rows += [(500, None), (501, ""), (502, shared[0] + "\n" + shared[0]), (None, shared[1]), (503, "é" * 30 + "\n\n" + shared[2] + "\n")]
    df = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, key int").repartition(4)
    found = repeated_paragraphs(df)
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted((tuple(x) for x in found.collect()), key=key) == sorted(brute(rows), key=key)
    clean = {x.doc_id: x.text for x in without_spans(df, found.where("not kept")).collect()}
    assert clean[502] in ("", shared[0]) and len(clean) == len(rows)
    left = repeated_paragraphs(without_spans(df, found.where("not kept")))
    assert left.count() == 0
    assert repeated_paragraphs(df.limit(0)).count() == 0


def test_untouched_text_stays(spark):
    rows = [(1, "a\n\nb\n"), (2, None), (3, "x\ny")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    gone = spark.createDataFrame([(3, 0, 1)], "doc_id long, start long, end long")
    assert sorted(map(tuple, without_spans(df, gone).collect())) == [(1, "a\n\nb\n"), (2, None), (3, "y")]


def test_tuned_reaches_the_recall():
    for t, q in ((0.8, 0.9999), (0.8, 0.99), (0.9, 0.999)):
        rows, bands = tuned(t, q)
        assert 1 - (1 - t ** rows) ** bands >= q and rows * bands <= 128
    assert cut("short line") == []
