"""One row of each component stays; different texts under one id are different documents."""

import numpy as np

from cyclelens.llm import language_id, simhash

SCHEMA = "doc_id long, text string, its_id string, key int, whole string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", k, "w") for k, (i, t) in enumerate(rows)], SCHEMA)


def kept(spark, rows):
    out = simhash.keep_one(table(spark, rows))
    assert out.columns == table(spark, []).columns
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)


ONE = "the first text about one thing that nobody else writes about at all"
TWO = "a second entirely different sentence concerning other matters of interest today"
THREE = "lorem numbers seven eight nine and a tail of words without any meaning"


def test_texts_of_one_id_stay(spark):
    assert kept(spark, [(1, ONE), (1, TWO), (2, ONE)]) == [(1, TWO), (1, ONE)]


def test_one_of_each_group(spark):
    assert kept(spark, [(5, ONE), (3, ONE), (3, ONE), (4, TWO), (9, TWO)]) == [(3, ONE), (4, TWO)]
    assert kept(spark, [(7, ONE)] * 30 + [(8, ONE)] * 3) == [(7, ONE)]


def test_null_ids_and_empty_texts(spark):
    assert kept(spark, [(None, ONE), (None, ONE), (None, TWO), (6, TWO)]) == [(6, TWO), (None, ONE)]
    assert kept(spark, [(None, None), (2, ""), (1, None), (3, "  ")]) == [(1, None)]
    assert kept(spark, []) == []


def test_many_rows_of_one_id(spark):
    rng = np.random.default_rng(1)
    texts = [" ".join(map(str, rng.integers(0, 10**6, 30))) for _ in range(80)]
    assert kept(spark, [(1, t) for t in texts]) == sorted(((1, t) for t in texts), key=repr)


def test_languages_of_rows_that_share_an_id(spark):
    rows = [(4 if k % 3 else None, f"{'der die das und ist' if k % 2 else 'the and of is that'} {k}", "de" if k % 2 else "en")
            for k in range(300)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, label int")
    network = language_id.fit(docs, per_language=20)
    assert network.languages == ["de", "en"]
    found = language_id.predict(docs, network).collect()
    assert len(found) == 300
    sizes = []
    train, language_id.train = language_id.train, lambda w, y, names: sizes.append(len(w))
    try:
        language_id.fit(docs, per_language=20)
        language_id.fit(docs, per_language=20, max_languages=1)
    finally:
        language_id.train = train
    assert sizes[0] <= 2 * 20 and sizes[1] <= 20
    assert language_id.fit(docs.where("false")) is None


def test_what_counts_as_a_letter(spark):
    docs = spark.createDataFrame([(1, "½ ²"), (2, "① ⑳ 12"), (3, "é"), (4, ""), (5, None), (6, "_ 日")], "doc_id long, text string")
    network = language_id.fit(spark.createDataFrame([(1, "abc abc", "p"), (2, "xyz xyz", "q")], "doc_id long, text string, lang string"))
    got = {r.row_id: r.lang_pred != "und" for r in language_id.predict(docs, network).collect()}
    assert got == {1: False, 2: False, 3: True, 4: False, 5: False, 6: True}


def test_forward_pass_is_the_plain_network():
    """Folded tables against embedding, filters, pooling and softmax written out."""
    rng = np.random.default_rng(2)
    params = {"emb": rng.normal(size=(256, language_id.EMBEDDING)), "bias": rng.normal(size=2),
              "out": rng.normal(size=(language_id.FILTERS * len(language_id.WIDTHS), 2))}
    for width in language_id.WIDTHS:
        params[f"conv{width}"] = rng.normal(size=(width * language_id.EMBEDDING, language_id.FILTERS))
        params[f"shift{width}"] = rng.normal(size=language_id.FILTERS)
    network = language_id.Network(["a", "b"], [language_id._folded(params, w) for w in language_id.WIDTHS], params["out"], params["bias"])
    text = bytes(rng.integers(0, 256, 40).tolist())
    pooled = []
    for width in language_id.WIDTHS:
        spans = [np.concatenate([params["emb"][b] for b in text[i : i + width]]) for i in range(len(text) - width + 1)]
        pooled.append(np.maximum(np.max([s @ params[f"conv{width}"] + params[f"shift{width}"] for s in spans], axis=0), 0))
    x = np.concatenate(pooled) @ params["out"] + params["bias"]
    want = np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    assert np.allclose(network.probabilities(np.frombuffer(text, np.uint8)[None, :]), want)


def test_slopes_of_the_network_are_those_of_its_loss():
    rng = np.random.default_rng(5)
    params = {"emb": rng.normal(size=(256, language_id.EMBEDDING)), "bias": rng.normal(size=2),
              "out": rng.normal(size=(language_id.FILTERS * len(language_id.WIDTHS), 2))}
    for width in language_id.WIDTHS:
        params[f"conv{width}"] = rng.normal(size=(width * language_id.EMBEDDING, language_id.FILTERS))
        params[f"shift{width}"] = rng.normal(size=language_id.FILTERS)
    windows, labels = rng.integers(0, 256, (4, 12)), np.array([0, 1, 1, 0])

    def loss():
        network = language_id.Network(["a", "b"], [language_id._folded(params, w) for w in language_id.WIDTHS], params["out"], params["bias"])
        p = network.probabilities(windows.astype(np.uint8))
        return -np.log(p[np.arange(4), labels]).mean()

    slopes = language_id._slopes(params, windows, labels)
    for name, slope in slopes.items():
        flat = np.argsort(-np.abs(slope).ravel())[:5]
        for at in (np.unravel_index(i, slope.shape) for i in flat):
            old = params[name][at]
            params[name][at] = old + 1e-6
            up = loss()
            params[name][at] = old - 1e-6
            down = loss()
            params[name][at] = old
            assert abs((up - down) / 2e-6 - slope[at]) < 1e-5
