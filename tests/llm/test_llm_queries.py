"""The registered queries of the package, against SQL or brute force on whole test tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from cyclelens.llm import entries, pieces, secrets_scan

QUERIES, ORACLE = entries.queries(), entries.oracle_sql()


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").collect()


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text for r in documents}


def test_names():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES if n != "pipeline")
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(name, spark, sf_dir):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        duck.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    ours, theirs = QUERIES[name](spark, sf_dir), duck.sql(ORACLE[name])
    assert set(ours.columns) == set(theirs.columns)
    order = [theirs.columns.index(c) for c in ours.columns]
    want = [tuple(row[i] for i in order) for row in theirs.fetchall()]
    assert sorted(map(tuple, ours.collect()), key=repr) == sorted(want, key=repr)


def test_shards(spark, sf_dir, texts):
    rows = QUERIES["op1_karmarkar_karp_shards"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    load, slots, homes, sizes = Counter(), defaultdict(list), defaultdict(set), Counter()
    for r in rows:
        text = texts[r.doc_id]
        assert r.size == len(text.encode()) + 1 and r.text_crc32 == zlib.crc32(text.encode())
        assert r.law == "bytes" and r.grown_shard is None
        load[r.shard] += r.size
        sizes[text] += r.size
        slots[r.shard].append(r.slot)
        homes[text].add(r.shard)
    assert all(len(h) == 1 for h in homes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    fair = sum(load.values()) / 16
    assert set(load) == set(range(16)) and max(load.values()) <= max(max(sizes.values()), fair + 50)


def test_fingerprints(spark, sf_dir, texts):
    def brute(text):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        words = re.findall(r"[^\x20\x09-\x0D]+", lower)
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    rows = QUERIES["op5_simhash_ball"](spark, sf_dir).collect()
    prints = {r.doc_id: int(r.fingerprint, 16) for r in rows}
    assert prints == {i: brute(t) for i, t in texts.items()}
    assert {r.doc_id: r.component_id for r in rows} == brute_components(prints)


def brute_components(prints):
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: root(i) for i in ids}


def test_pieces(spark, sf_dir, texts):
    import sentencepiece

    other = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    rows = QUERIES["op7_sentencepiece"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert r.ids == other.encode(texts[r.doc_id]) and r.n_pieces == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
        assert r.round_trip and r.parity


def test_languages(spark, documents, sf_dir):
    rows = {r.doc_id: r for r in QUERIES["op9_language_id"](spark, sf_dir).collect()}
    assert all(rows[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2) for d in documents)
    judged = [d for d in documents if rows[d.doc_id].held_out and rows[d.doc_id].lang_pred != "und"]
    right = sum(rows[d.doc_id].lang_pred == d.lang for d in judged)
    assert len(judged) > 20 and right >= 0.9 * len(judged)
    assert all(0 <= r.score <= 1 for r in rows.values())


def brute_base(text):
    assign = re.compile(secrets_scan.ASSIGN, re.I | re.A)
    spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def test_secrets(spark, sf_dir, texts):
    for r in QUERIES["op10_randomness_secret_scan"](spark, sf_dir).collect():
        spans = brute_base(texts[r.doc_id])
        shown = [f"{secrets_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(shown).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[1] == k for s in spans) for k in range(3)]
        assert set(shown) <= set(r.spans.split(",")) | ({""} if not shown else set())


def test_pipeline(spark, sf_dir, documents):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    at = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).toArrow())
        at[name] = {r.doc_id: r for r in docs.collect()}
        assert docs.count() == len(at[name])
        if name != "SentencePiece encoding":
            assert docs.columns == columns
    steps = [set(rows) for rows in at.values()]
    assert all(later <= earlier for earlier, later in zip([{d.doc_id for d in documents}, *steps], steps))

    first = at["language ID"]
    prints = {r.doc_id: int(r.fingerprint, 16) for r in QUERIES["op5_simhash_ball"](spark, sf_dir).collect()}
    roots = brute_components({i: prints[i] for i in first})
    assert steps[1] == {i for i, root in roots.items() if i == root}
    bad = {r.doc_id for r in QUERIES["op4_benchmark_decontamination"](spark, sf_dir).collect() if r.contaminated}
    assert steps[2] == steps[1] - bad
    assert steps[3] == steps[2] == steps[4]
    before, clean = at["benchmark decontamination"], at["secret scans"]
    for i, row in clean.items():
        assert row.n_chars == len(row.text)
        assert not brute_base(row.text)
        if row.text != before[i].text:
            assert "[SECRET]" in row.text
    for i, row in at["SentencePiece encoding"].items():
        assert row.text == clean[i].text and row.n_pieces == len(row.ids) and row.round_trip and row.parity
