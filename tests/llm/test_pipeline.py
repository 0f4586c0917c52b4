from collections import Counter

import corpus_pipeline as cp
import pyarrow as pa


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def doc(i, text, source="a"):
    return (i, text, "en", source, len(text or ""))


def test_stages_return_documents_and_their_decisions_hold(spark):
    sf = "/root/testdata/sf0.001"
    d = spark.read.parquet(f"{sf}/documents.parquet")
    before = d.count()
    for name, stage in cp.STAGES[:-1]:
        d = cp.written(stage(spark, d, sf), f"t-{name}")
        assert d.columns == list(cp.COLUMNS)
    assert 0 < d.count() < before
    assert d.where("n_chars != length(text)").count() == 0
    pieces = cp.STAGES[-1][1](spark, d, sf)
    per = Counter()
    for r in pieces.collect():
        per[r.sequence_id] += r.length
    assert all(n == 1024 for s, n in per.items() if s < max(per))
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in d.select("doc_id").collect()}


def test_near_duplicates_and_edges(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [doc(1, text), doc(2, text + " tail"), doc(2, text + " tail"), doc(3, None), doc(4, ""), doc(5, "other words here"), doc(6, "row twice"), doc(6, "row twice"), doc(None, "x")]
    out = cp.drop_near_duplicates(spark, docs(spark, rows), "").collect()
    assert Counter(r.doc_id for r in out) == Counter([1, 3, 4, 5, 6, None])
    assert cp.cut_repeats(spark, docs(spark, []), "").count() == 0


def test_repeats_and_secrets(spark):
    line = " ".join(f"v{i}" for i in range(60))
    rows = [doc(1, "own\n" + line), doc(2, line + "\nmine"), doc(3, 'a token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" b'), doc(4, None)]
    out = {r.doc_id: r for r in cp.mask_secrets(spark, cp.cut_repeats(spark, docs(spark, rows), ""), "").collect()}
    assert out[1].text == "own\n" + line and out[2].text == "mine" and out[2].n_chars == 4
    assert out[3].text == 'a [assign]" b' and out[4].text is None


def test_near_duplicates_judge_rows_not_ids(spark):
    words = lambda x: " ".join(f"{x}{i}" for i in range(60))
    a, b, c, n = words("a"), words("b"), words("c"), words("n")
    rows = [doc(3, a), doc(5, a), doc(5, b), doc(6, c), doc(6, c + " tail"), doc(None, n), doc(None, n), doc(None, n + " end"), doc(None, None)]
    out = sorted((r.doc_id or 0, (r.text or "").split(" ")[0]) for r in cp.drop_near_duplicates(spark, docs(spark, rows), "").collect())
    assert out == [(0, ""), (0, "n0"), (3, "a0"), (5, "b0"), (6, "c0")]


def test_texts_reach_python_in_small_batches(spark):
    docs = spark.range(0, 3000, 1, 1).selectExpr("id as doc_id", "repeat('word ', 1000) as text", "'en' as lang", "'web' as source", "5000L as n_chars")
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes]), pa.array([b.num_rows])], ["bytes", "rows"])

    got = cp._documents(docs).select("text").mapInArrow(sizes, "bytes long, rows long").collect()
    assert sum(x.rows for x in got) == 3000 and max(x.bytes for x in got) < 2 * cp.BATCH_BYTES
