import random

import numpy as np
from pyspark.sql import functions as F

from tabkit.llm import quality


def corpus(n=240, seed=0):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("aeiounrst") for _ in range(r.randint(2, 7)))
    rows, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        out = []
        for _ in range(r.randint(1, 6)):
            w = [word() for _ in range(r.randint(5, 20))]
            out.append(" ".join(w).capitalize() + "." if good else " ".join(x.upper() + "!!" for x in w))
        rows.append((i, "\n".join(out), "en" if good else "xx", "s"))
        labels.append((i, int(good), 0))
    return rows, labels


def frames(spark, rows, labels):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_documents_are_told_apart(spark):
    rows, labels = corpus()
    rows += [(900, None, None, None), (901, "", "", ""), (None, "Some text.", "", ""), (902, "a" * 200_000, "", ""), (903, "x\n" * 20_000, "", ""), (1, rows[1][1], "", "")]
    docs, marks = frames(spark, rows, labels)
    got = quality.quality_scores(docs.withColumn("score", F.lit("clash")), marks).collect()
    assert len(got) == len(rows)
    truth = {i: q for i, q, _ in labels}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert held and all(r["predicted"] == truth[r["doc_id"]] for r in held)
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got if r["doc_id"] is not None)
    assert {r["doc_id"]: r["n_lines"] for r in got}[903] == 20_001


def test_labels_lang_source_and_held_out_rows_do_not_matter(spark):
    rows, labels = corpus(120)
    docs, marks = frames(spark, rows, labels)
    a = {r["doc_id"]: r["score"] for r in quality.quality_scores(docs, marks).collect()}
    other = marks.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    b = {r["doc_id"]: r["score"] for r in quality.quality_scores(docs.withColumn("lang", F.lit(None)), other).collect()}
    assert all(abs(a[i] - b[i]) < 1e-9 for i in a)


def test_without_labels_and_without_rows(spark):
    docs, marks = frames(spark, [(1, "a", "", ""), (2, None, "", "")], [(1, None, 0)])
    assert [r["score"] for r in quality.quality_scores(docs, marks).collect()] == [0.5, 0.5]
    assert quality.quality_scores(docs.where("1 = 0"), marks).count() == 0
    assert quality.keep_good(docs, marks).count() == 2


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    trans, e = rng.normal(size=(2, 2)), rng.normal(size=(5, 1))
    good, _, z = quality._chain(e, np.ones((5, 1), dtype=bool), trans)
    total, sums = 0.0, np.zeros(5)
    for k in range(32):
        y = [(k >> t) & 1 for t in range(5)]
        s = np.exp(sum(e[t, 0] * y[t] for t in range(5)) + sum(trans[y[t - 1], y[t]] for t in range(1, 5)))
        total += s
        sums += s * np.array(y)
    assert np.allclose(good[:, 0], sums / total) and np.isclose(z[0], np.log(total))


def test_keep_good_passes_rows_through(spark):
    rows, labels = corpus(160)
    docs, marks = frames(spark, rows, labels)
    kept = quality.keep_good(docs, marks)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, q, _ in labels if q}


def test_lines_for_fitting_come_from_the_whole_text():
    from tabkit.llm.quality import RUN_LINES, sampled_lines

    assert sampled_lines(399, 400).tolist() == list(range(399))
    own = sampled_lines(10_003, 400)
    assert 380 <= len(own) <= 400 and own.max() > 9000 and (own[1:] > own[:-1]).all()
    starts = own[own % RUN_LINES == 0]
    assert set(own) == {i for a in starts for i in range(a, min(a + RUN_LINES, 10_003))}
