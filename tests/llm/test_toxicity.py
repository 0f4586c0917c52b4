import numpy as np

from helixspark.llm.toxicity import PEERS, Sparse, ToxicModel, fit, learn, score_toxicity, swapped, vector, words_of


def corpus(n):
    rows, labels = [], []
    for i in range(n):
        toxic = int(i % 4 == 0)
        words = [f"w{(i * k) % 53}" for k in range(20)] + (["idiot", "scum"] if toxic else [])
        # mentions of one group stand mostly in toxic texts: the unwanted bias
        if toxic and i % 8 == 0 or i % 37 == 0:
            words.append("muslims")
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    return rows, labels


def test_swaps_keep_length_and_group():
    w = words_of("The muslims met women and w1")
    s = swapped(w, 3)
    assert len(s) == len(w) and s[1] in PEERS["muslims"] and s[3] in PEERS["women"] and s[0] == "the"
    assert len(swapped(["a"], 1)) == 2


def test_penalty_removes_group_bias():
    rows, labels = corpus(800)
    xs = [vector(words_of(t)) for _, t in rows]
    diffs = []
    for i, (_, t) in enumerate(rows):
        w = words_of(t)
        z, x = vector(swapped(w, i)), vector(w)
        diffs.append({f: z.get(f, 0.0) - x.get(f, 0.0) for f in x.keys() | z.keys() if z.get(f) != x.get(f)})
    y = np.array([t for _, t in labels], float)
    xs, diffs = Sparse.of(xs), Sparse.of(diffs)

    def shift(model):
        a = model.score(words_of("w1 w2 w3 muslims"), {})
        return abs(a - model.score(words_of("w1 w2 w3 jews"), {}))

    assert shift(fit(xs, diffs, y, fairness=3.0)) <= shift(fit(xs, diffs, y, fairness=0.0)) + 1e-9
    assert shift(fit(xs, diffs, y, fairness=3.0)) < 0.05


def test_held_out_accuracy_and_edges(spark):
    rows, labels = corpus(600)
    docs = spark.createDataFrame([*rows, (None, None), (9001, ""), (9001, "")], "doc_id long, text string")
    lab = spark.createDataFrame([(i, 1, t) for i, t in labels] + [(9002, 1, None), (9003, 0, 1)], "doc_id long, quality int, toxic int")
    model = learn(docs, lab)
    out = score_toxicity(docs, model).collect()
    assert len(out) == 603
    truth = dict(labels)
    got = [(r.score >= 0.5) == truth[r.doc_id] for r in out if r.doc_id in truth]
    assert sum(got) / len(got) > 0.98
    assert all(0 <= r.score <= 1 for r in out)
    again = learn(docs.repartition(5), lab)
    assert again == model


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert score_toxicity(docs, learn(docs, none)).first().score < 0.5
    assert score_toxicity(docs.limit(0), learn(docs.limit(0), none)).count() == 0


def test_kept_text_is_sent_once_in_small_parts(spark, capsys):
    """A text among the kept columns is not sent a second time; slices join to the same rows."""
    docs = spark.createDataFrame([(i, None if i % 7 == 0 else f"w{i % 5} vile idiot w{i}", "en") for i in range(700)], "doc_id long, text string, lang string").coalesce(1)
    model = ToxicModel(-1.0, {f: 0.5 for f in vector(["idiot", "w3"])})
    both = score_toxicity(docs, model, keep=("text", "lang"))
    both.explain(True)
    assert "__text" not in capsys.readouterr().out
    got = {r.doc_id: r for r in both.collect()}
    want = {r.doc_id: r.score for r in score_toxicity(docs, model).collect()}
    assert {i: r.score for i, r in got.items()} == want and len(want) == 700
    assert all(r.text == (None if i % 7 == 0 else f"w{i % 5} vile idiot w{i}") and r.lang == "en" for i, r in got.items())
    assert want[3] == model.score(words_of("w3 vile idiot w3"), {})
