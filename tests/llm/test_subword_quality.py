"""The quality classifier: gradients, hashing, held-out accuracy, odd input."""

import zlib

import numpy as np

from cyclelens.llm import entries, samples, subword_quality as quality


def test_slopes_are_those_of_the_loss():
    rng = np.random.default_rng(1)
    vectors, weights, bias = rng.normal(size=(5, 3)), rng.normal(size=(3, 2)), rng.normal(size=2)
    share = np.array([0.4, 0.1, 0.2, 0.2, 0.1])

    def loss():
        x = share @ vectors @ weights + bias
        return -(x[1] - np.log(np.exp(x).sum()))

    slopes = quality.slopes(vectors, weights, bias, share, 1)
    for part, slope in zip((vectors, weights, bias), slopes):
        for at in np.ndindex(part.shape):
            old, part[at] = part[at], part[at] + 1e-6
            up = loss()
            part[at] = old - 1e-6
            down = loss()
            part[at] = old
            assert abs((up - down) / 2e-6 - slope[at]) < 1e-6


def test_features_do_not_cross_texts_and_equal_texts_agree():
    texts = ["one two two", "", "one two two", "ab", "x", "日本 é퟿"]

    def of(k, found):
        return sorted(np.concatenate([b[o == k] for b, o in found]).tolist())

    together = quality.features(texts)
    for k, text in enumerate(texts):
        alone = quality.features([text])
        assert of(k, together) == (of(0, alone) if alone else [])
    assert of(0, together) == of(2, together)
    # A word that follows itself is one feature, whatever the word.
    twice = [set(quality.features([t])[1][0].tolist()) for t in ("two two", "other other")]
    assert twice[0] == twice[1] and len(twice[0]) == 1


def test_scores_are_those_of_averaged_vectors():
    rng = np.random.default_rng(3)
    adds = rng.normal(size=quality._FAMILIES << quality.BITS).astype(np.float32)
    scorer = quality.Scorer(adds, 0.25)
    text = "some words and some words"
    buckets = np.concatenate([b for b, _ in quality.features([text])])
    want = 1 / (1 + np.exp(-(adds[buckets].astype(float).mean() + 0.25)))
    assert np.allclose(scorer.scores([text, ""]), [want, 1 / (1 + np.exp(-0.25))])


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in entries.quality_scores(spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    judged = [x for x in labels if rows[x.doc_id].held_out]
    right = [rows[x.doc_id].predicted == x.quality for x in judged]
    assert len(judged) > 60 and np.mean(right) >= 0.93


def documents(spark, rows):
    return spark.createDataFrame([(i, t, 1, "p", 0.5) for i, t in rows], "doc_id long, text string, label int, place string, score double")


def test_labels_that_teach_little(spark):
    docs = documents(spark, [(1, "good text here"), (2, "bad"), (None, "x"), (3, None), (3, ""), (3, "again"), (3, "again")])
    kind = "doc_id long, quality int"
    for marks, want in (([], 0.5), ([(1, 1), (3, 1)], 1.0), ([(2, 0), (2, 0), (1, None), (1, 7)], 0.0)):
        model = quality.fit(docs, spark.createDataFrame(marks, kind))
        assert [round(r.score, 6) for r in quality.score(docs, model).collect()] == [want] * 7
    both = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (3, 1), (None, 1)], kind)
    one, two = (quality.score(docs, quality.fit(docs, both)).collect() for _ in range(2))
    assert sorted(one, key=repr) == sorted(two, key=repr) and len(one) == 7


def test_samples_hold_their_bounds(spark):
    rows = spark.range(6000).selectExpr(
        "case when id % 3 = 0 then 'a' when id % 3 = 1 then 'b' else concat('x', id % 40) end as label",
        "xxhash64(id) as place", "10 as chars")
    counts = {r.label: r["count"] for r in samples.draw(rows, 100, 2, 100_000).groupBy("label").count().collect()}
    assert set(counts) == {"a", "b"} and all(60 <= n <= 100 for n in counts.values())
    assert samples.draw(rows, 1000, 50, 3000).selectExpr("sum(chars)").first()[0] <= 3000
    # Copies count once, and one long text does not fill the sample.
    copies = rows.selectExpr("'a' as label", "pmod(place, 7) as place", "chars")
    assert samples.draw(copies, 100, 5, 100_000).count() <= 7
    assert samples.draw(rows.withColumn("chars", rows.chars * 500), 100, 5, 100_000).isEmpty()
