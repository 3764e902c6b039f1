"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns, and
the parts of the operators against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cyclelens.llm import (
    anchors,
    decontaminate,
    host_rules,
    language_id,
    phrases,
    pieces,
    quotes,
    secrets_scan,
    sharding,
    simhash,
    subword_quality,
    suffixes,
)

LONG = " ".join(f"word{i % 977} x{i}" for i in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(80))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row_id string, whole int, shard int"


def table(spark, rows):
    """Documents with columns whose names the operators use inside."""
    full = [(i, t, "en", "s", len(t or ""), "r", 1, 2) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    return table(spark, [
        (1, None), (2, ""), (3, "   \n\t "), (4, LONG), (5, "same text here and there"), (6, "same text here and there"),
        (6, "same text here and there"), (None, "same text here and there"), (None, None), (8, "ééé 日本語 🙂"),
        (9, f"a {PASSAGE} b"), (10, f"c {PASSAGE} d"),
    ])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def benchmark(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


OPERATORS = {
    "shards": lambda df: sharding.by_bytes(df, 4),
    "hosts": host_rules.judge,
    "fingerprints": simhash.near_duplicates,
    "strings": suffixes.remove_repeats,
    "pieces": lambda df: pieces.encode(df, pieces.read_model()),
    "phrases": phrases.remove_repeats,
    "languages": lambda df: language_id.predict(df, language_id.fit(df)),
    "secrets": secrets_scan.scan,
    "benchmark": lambda df: decontaminate.contamination(df, benchmark(df.sparkSession, "p1 p2", None, "")),
    "quotes": lambda df: quotes.conversations(df, "doc_id", "n_chars", "text", "source"),
    "quality": lambda df: subword_quality.score(df, subword_quality.fit(df, df, label_col="whole")),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_every_row_comes_back(name, odd, empty):
    column = "msg_id" if name == "quotes" else "row_id"
    got = sorted((r[column] for r in OPERATORS[name](odd).collect()), key=repr)
    assert got == sorted((r.doc_id for r in odd.collect()), key=repr)
    assert OPERATORS[name](empty).collect() == []


def test_pipeline_takes_odd_and_empty_tables(spark, odd, empty, tmp_path):
    benchmark(spark, PASSAGE, None).write.parquet(str(tmp_path / "benchmark.parquet"))
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns or name == "SentencePiece encoding"
            out.collect()


def test_differencing_is_tight():
    random.seed(3)
    sizes = [random.randint(1, 9999) for _ in range(700)]
    load = [0] * 16
    for size, shard in zip(sizes, sharding.difference(sizes, 16)):
        load[shard] += size
    assert max(load) - min(load) <= 5
    assert sharding.difference([], 4) == [] and sorted(sharding.difference([5, 5, 5, 5], 4)) == [0, 1, 2, 3]


def test_shards_around_a_hot_group(spark):
    rows = [(i, "hot") for i in range(400)] + [(1000 + i, "t" * (i % 50)) for i in range(900)]
    got = sharding.by_bytes(table(spark, rows), 4, bundles=64).collect()
    hot = {r.shard for r in got if r.row_id < 400}
    load = {s: sum(r["size"] for r in got if r.shard == s) for s in range(4)}
    assert len(hot) == 1 and max(load.values()) <= sum(load.values()) / 4 * 1.2


def near(prints, rng, bits):
    return [int(p) ^ sum(1 << b for b in rng.choice(64, n, replace=False).tolist()) for p in prints for n in bits]


def test_links_find_all_pairs_within_three_bits(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    prints = sorted({*map(int, base), *near(base, rng, (1, 2, 3, 3, 3, 4, 5)), 0, 1, 2**64 - 1})
    df = spark.createDataFrame([(simhash._signed(p),) for p in prints], "print long")
    edges = {(r.a, r.b) for r in simhash.links(df).collect()}
    unsigned = [(a % 2**64, b % 2**64) for a, b in edges]
    assert all((a ^ b).bit_count() <= 3 and a != b for a, b in unsigned)

    def parts(pairs):
        parent = {p: p for p in prints}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in pairs:
            parent[root(a)] = root(b)
        groups = {}
        for p in prints:
            groups.setdefault(root(p), set()).add(p)
        return sorted(map(sorted, groups.values()))

    every = [(a, b) for i, a in enumerate(prints) for b in prints[i + 1 :] if (a ^ b).bit_count() <= 3]
    assert parts(unsigned) == parts(every)
    found = {}
    for r in simhash.components(simhash.links(df)).collect():
        found.setdefault(r.root, set()).add(r.node)
    mine = sorted(sorted({x % 2**64 for x in {*group, root}}) for root, group in found.items())
    assert mine == [g for g in parts(every) if len(g) > 1]


def test_keep_one_of_each_group(spark, odd):
    kept = simhash.keep_one(odd).collect()
    ids = [r.doc_id for r in kept]
    assert len(ids) == len(set(ids)) and 5 in ids and 6 not in ids and None not in ids
    assert 1 in ids and not {2, 3} & set(ids)  # wordless texts share fingerprint zero
    lone = simhash.keep_one(table(spark, [(None, "a b c d"), (None, "a b c d"), (1, "other words altogether")]))
    assert sorted((r.doc_id for r in lone.collect()), key=repr) == [1, None]


@pytest.mark.parametrize("hot", [False, True])
def test_repeats_against_brute_force(spark, hot, monkeypatch):
    if hot:
        monkeypatch.setattr(anchors, "HOT_LEAST", 3)
        monkeypatch.setattr(anchors, "HOT_SHARE", 0.0)
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "été", "x", "longerword", "zz"]
    shared = [" ".join(rng.choice(words) for _ in range(n)) for n in (14, 20, 40, 13, 60)]
    texts = []
    for i in range(60):
        parts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 25)))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(shared), str(rng.random())]
        texts.append(" ".join(parts))
    texts += [texts[3], texts[7], "", None, texts[3][:50], "q" * 200, "q" * 120]
    docs = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[3])]

    def brute(tokens_of, size):
        first, out = {}, []
        cut = [(i, tokens_of(t or "")) for i, t in docs]
        for i, tokens in cut:
            for k in range(len(tokens) - size + 1) if i is not None else ():
                window = tuple(tokens[k : k + size])
                first[window] = min(first.get(window, i), i)
        for i, tokens in cut:
            gone = set()
            for k in range(len(tokens) - size + 1) if i is not None else ():
                if first[tuple(tokens[k : k + size])] < i:
                    gone.update(range(k, k + size))
            out.append((i, [t for k, t in enumerate(tokens) if k not in gone]))
        return out

    df = table(spark, docs)
    strings = [(r.row_id, bytes(r.kept)) for r in suffixes.remove_repeats(df).collect()]
    want = [(i, bytes(kept)) for i, kept in brute(lambda t: t.encode(), 50)]
    assert sorted(strings, key=repr) == sorted(want, key=repr)
    lists = [(r.row_id, r.kept) for r in phrases.remove_repeats(df).collect()]
    want = [(i, " ".join(kept)) for i, kept in brute(str.split, 13)]
    assert sorted(lists, key=repr) == sorted(want, key=repr)


def test_bucket_pointers_find_equal_strings():
    rng = random.Random(2)
    parts = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 300))) for _ in range(20)]
    parts += [parts[0][:60], parts[1], "a" * 120]
    data = np.frombuffer("".join(parts).encode(), np.uint8)
    bounds = np.cumsum([len(p) for p in parts])
    places, label = suffixes.equal_strings(data, bounds)
    windows, at = {}, 0
    for p in parts:
        for k in range(len(p) - 49):
            windows.setdefault(p[k : k + 50], []).append(at + k)
        at += len(p)
    want = sorted(v for v in windows.values() if len(v) > 1)
    got = {}
    for place, name in zip(places.tolist(), label.tolist()):
        got.setdefault(name, []).append(place)
    assert sorted(got.values()) == want


def test_contamination_in_blocks_and_cut_spans(spark):
    item = "One two THREE four five six seven eight nine ten eleven twelve thirteen fourteen"
    bench = benchmark(spark, item, "short item", None, "", item)
    docs = table(spark, [
        (1, f"before, {item.lower()}! after"), (2, "a Short-ITEM b"), (3, "clean text"), (4, None), (None, item), (1, "again short item")])
    one = decontaminate.contamination(docs, bench)
    many = decontaminate.contamination(docs, bench, block_bytes=40)
    key = ("row_id", "n_words", "spans", "items")
    assert sorted(map(repr, one.select(*key).collect())) == sorted(map(repr, many.select(*key).collect()))
    by_id = {(r.row_id, r.n_words): r for r in one.collect()}
    assert by_id[1, 16]["items"] == ["0", "4"] and [tuple(s) for s in by_id[1, 16].spans] == [(1, 15)]
    assert by_id[2, 4]["items"] == ["1"] and by_id[3, 2]["items"] == [] and by_id[4, 0].spans == []
    cut = decontaminate.contamination(docs, bench, cut=True).where("row_id = 2").first()
    assert cut.clean_text == "a  b"
    both = [decontaminate.contamination(docs, bench, cut=True, block_bytes=n).select(*key, "clean_text") for n in (40, 10**6)]
    assert sorted(map(repr, both[0].collect())) == sorted(map(repr, both[1].collect()))


def test_quality_prior():
    mean, strength = host_rules.prior(3, 30, 3, 0.3)  # rates as even as can be
    assert mean == 0.1 and strength == 1e6
    mean, strength = host_rules.prior(2, 200, 100, 100.0)  # all or nothing
    assert mean == 0.5 and strength == 1.0
    assert host_rules.prior(0, None, None, None)[0] == 0.0


def test_hosts_are_judged(spark):
    good = "these are twenty quite different words that nobody would ever call a repetition of anything seen before in this short text"
    rows = [(i, good, "en", "fine") for i in range(40)] + [(100 + i, "too short", "en", "spam") for i in range(38)]
    rows += [(200 + i, good, "en", "spam") for i in range(2)] + [(300, good, "en", None), (301, None, "en", "fine")]
    rows += [(400, "too short", "en", "tiny"), (401, good, "en", "tiny")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.row_id: r for r in host_rules.judge(df).collect()}
    assert got[0].kept and not got[100].kept and got[100].base_failed
    assert not got[200].base_failed and got[200].host_failed and not got[200].kept
    assert got[300].kept and got[301].base_failed and not got[301].host_failed


def test_repeated_words(spark):
    words = [chr(97 + i) for i in range(8)]
    texts = {" ".join(words): 0, " ".join(words * 2): 16, " ".join(["x"] * 9): 9, " ".join([*words, "z", *words]): 16, "": 0}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", host_rules.measures(F.col("t")).alias("m")).collect()
    assert {r.t: r.m.n_repeat_words for r in got} == texts


def test_randomness_tells_random_from_structured(spark):
    rng = random.Random(4)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(200)]
    plain = [f"{i:020x}{i + 1:020x}" for i in range(200)]
    df = spark.createDataFrame([(t, t in hexes) for t in hexes + plain], "t string, random boolean")
    rows = df.select("random", secrets_scan.randomness(F.col("t"), "hex").alias("p")).collect()
    even = sorted(r.p for r in rows if r.random)
    assert 0.25 < even[50] * 1 + 0.1 and even[100] > 0.3 and all(0 <= p <= 1.0001 for p in even)
    assert all(r.p < 0.001 for r in rows if not r.random)
    assert secrets_scan.cutoff([0] * 20) == 2.0
    assert secrets_scan.cutoff([100] + [0] * 19) == 2.0
    assert secrets_scan.cutoff([500] + [10] * 19) == 0.05
    assert secrets_scan.cutoff([10] * 20) == 0.0


def test_redaction(spark):
    key = "AKIA" + "Z9" * 10
    df = table(spark, [(1, f'é password = "hunter22" and {key}.'), (2, None), (3, "nothing"), (4, f"token:{'0af3' * 8}")])
    got = {r.doc_id: r.text for r in secrets_scan.redact(df).collect()}
    assert got == {1: 'é [SECRET]" and [SECRET].', 2: None, 3: "nothing", 4: "[SECRET]"}


def test_a_dropped_assignment_still_consumes_its_text(spark):
    df = table(spark, [(1, "secret: token: abcdefgh and api-key=abcdefg")])
    base = secrets_scan.scan(df).first().base
    assert [(s.start, s.end) for s in base] == []
    base = secrets_scan.scan(table(spark, [(1, "secret: abc token: abcdefgh api_KEY=abcdefg")])).first().base
    assert [(s.start, s.end) for s in base] == [(12, 27), (28, 43)]


def test_replies_are_linked_and_unquoted(spark):
    mails = [
        ("a", 1, "Hello all\n\nWhat about lunch?"),
        ("b", 2, "> Hello  all\n>\n> What about LUNCH?\nYes, at one."),
        ("c", 3, "> > What about lunch?\n>\n> Yes, at one.\nFine.\n"),
        ("d", 4, "> What about lunch?\nNo."), ("e", 5, "> never said\nHm."), ("f", 0, "> Hello all\nearlier"),
        (None, 6, "> Hello all\nnobody"), ("g", None, "> Hello all\nnever"), ("h", 7, None),
    ]
    df = spark.createDataFrame(mails, "id string, at long, body string")
    got = {r.msg_id: r for r in quotes.conversations(df, "id", "at", "body").collect()}
    assert [(got[m].parent, got[m].conversation, got[m].depth) for m in "abcdef"] == [
        (None, "a", 0), ("a", "a", 1), ("b", "a", 2), ("a", "a", 1), (None, "e", 0), (None, "f", 0)]
    assert got["b"].text == "Yes, at one." and got["c"].text == "Fine." and got["h"].text == ""
    assert got["g"].parent is None and got[None].parent is None


def test_long_chains_of_replies(spark):
    chain = [(i, i, (f"> line {i - 1}\n" if i else "") + f"line {i}") for i in range(70)]
    df = spark.createDataFrame(chain, "id long, at long, body string")
    rows = quotes.conversations(df, "id", "at", "body").collect()
    assert [(r.msg_id, r.conversation, r.depth) for r in rows] == [(i, 0, i) for i in range(70)]


def test_tokenizer_takes_odd_texts():
    import sentencepiece

    data = pieces.read_model()
    codec, other = pieces.Codec(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = ["", " ", "  two  spaces ", "▁marker", "a▁b", "日本語 🙂 \x00\x01", "<s> </s> <unk> <0x41>", "x" * 5000, "\n\n", "end "]
    done = codec.encode(texts)
    assert ids_of(done) == other.encode(texts) and done.parity.all()
    assert [d.decode() == t for d, t in zip(done.decoded, texts)] == ["▁" not in t for t in texts]
    assert done.round_trip.tolist() == ["▁" not in t for t in texts]


def ids_of(done):
    return [done.ids[a:b].tolist() for a, b in zip(done.ends[:-1], done.ends[1:])]


def test_ids_are_really_decoded():
    """A wrong memo shows in the decoded text, and the text is then encoded by itself."""
    data = pieces.read_model()
    codec, clean = pieces.Codec(data), pieces.Codec(data)
    texts = ["some words here", "other words"]
    right = codec.encode(texts)
    codec.memo.ids = codec.memo.ids + 1
    again = codec.encode(texts)
    assert again.round_trip.all() and ids_of(again) == ids_of(right) == ids_of(clean.encode(texts))
    wrong, ends = codec._bytes(right.ids + 1, right.ends)
    assert wrong != b" some words here other words" and len(ends) == 3


def test_words_are_learned_alike_together_and_singly():
    codec = pieces.Codec(pieces.read_model())
    units = [" one", " two", "  three", " ", " élan", "x", " 日本", " one,two"]
    for a, b in zip(codec._joined(units), codec._singly(units)):
        assert a.tolist() == b.tolist()


@pytest.mark.parametrize("flags", [{}, {"remove_extra_whitespaces": True}])
def test_unigram_models_are_rebuilt(flags):
    """A hand-made unigram model: scores, byte fallback, space handling."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    model.trainer_spec.model_type, model.trainer_spec.byte_fallback, model.trainer_spec.unk_id = 1, True, 0
    model.trainer_spec.vocab_size = 300
    model.normalizer_spec.name, model.normalizer_spec.add_dummy_prefix = "identity", True
    model.normalizer_spec.remove_extra_whitespaces = flags.get("remove_extra_whitespaces", False)
    for piece, kind in (("<unk>", 2), ("<s>", 3), ("</s>", 3)):
        model.pieces.add(piece=piece, score=0, type=kind)
    for b in range(256):
        model.pieces.add(piece=f"<0x{b:02X}>", score=0, type=6)
    for i, piece in enumerate(["▁", "▁a", "ab", "b", "a", "▁ab", "abc", "c", "bc", "▁▁"]):
        model.pieces.add(piece=piece, score=-1.0 - 0.37 * i, type=1)
    data = model.SerializeToString()
    codec, other = pieces.Codec(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = ["abc ab a", "  b  c abcabc ", "éabc", "aa bb", ""]
    done = codec.encode(texts)
    assert ids_of(done) == other.encode(texts) and done.parity.all() and done.round_trip.all()


def test_language_windows_and_training_are_repeatable():
    rng = np.random.default_rng(0)
    texts = [bytes(rng.choice(list(letters), 400).tolist()) for letters in (b"abcde ", b"vwxyz ") for _ in range(40)]
    labels = np.repeat([0, 1], 40)
    windows = np.stack([language_id.windows_of(t)[0] for t in texts])
    one, two = (language_id.train(windows, labels, ["p", "q"]) for _ in range(2))
    assert np.array_equal(one.probabilities(windows), two.probabilities(windows))
    assert (one.probabilities(windows).argmax(axis=1) == labels).mean() > 0.95
    assert language_id.windows_of(b"x" * 193).shape == (2, 192)
