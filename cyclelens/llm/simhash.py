"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints are linked when at most three of their 64 bits differ. The bits form
three blocks; whichever three bits differ, leaving out the block with most of them leaves
at most two. So every distinct fingerprint emits, for each block left out, the remaining
bits and all variants of them within one bit, half of that radius: two linked
fingerprints meet in a variant between them. The variants are shuffled, colliding pairs
are verified on all 64 bits, and the links found become components.

Equal fingerprints are one row before any of this, so a group of copies costs nothing. In
a bucket of a variant only a spanning forest of the verified links is emitted (a breadth-
first search over the bucket's sorted fingerprints, block by block), never all its pairs;
no link between different components of a bucket is lost. Components come from
alternating large-star and small-star steps on tables in the shared work folder.

Words are separated by ASCII white space after A-Z is lower-cased. A text of fewer than
three words is one shingle; a null or wordless text has fingerprint zero and is linked
like any other. Repeated rows share a fingerprint. A null id never becomes a component
id, unless all ids of the component are null. An empty table gives an empty result. Only
the named columns are read, so further columns of any name do no harm.

`keep_one` keeps one row of each component. A document is its id and its text, so different
texts under one id are different documents, and the smallest id of a component stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclelens.llm.batches import id_and_text, output_schema, text_groups, with_rows
from cyclelens.session import Rounds, written

SHINGLE = 3
SEED = 42
RADIUS = 3
_BLOCKS = (range(0, 21), range(21, 42), range(42, 64))
_AT_ONCE = 1 << 16
_FRONT = 256


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64 bits; a bit is one where it is set in over half of the shingles' hashes."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    n = len(words) - width + 1
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    spans = list(zip(starts[:n].tolist(), ends[width - 1 :].tolist()))
    for i in range(0, n, _AT_ONCE):
        hashes = np.array([digest(line[a:b], SEED) for a, b in spans[i : i + _AT_ONCE]], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _printer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in text_groups(batches):
        prints = np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_pydict({"row_id": rows.column("row_id"), "print": pa.array(prints)})


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`row_id` and `print`, the fingerprint as a signed long."""
    schema = output_schema(df, id_col, "print long")
    return id_and_text(df, id_col, text_col).mapInArrow(_printer, schema)


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def variants(print_col: str = "print"):
    """The shuffle keys of a fingerprint: for each block left out, the other bits and all
    their variants of one changed bit. Keys of different blocks may coincide by chance;
    that only adds a pair to verify."""
    keys = []
    for block in _BLOCKS:
        outside = [b for b in range(64) if b not in block]
        mask = F.lit(_signed(sum(1 << b for b in outside)))
        rest = F.col(print_col).bitwiseAND(mask)
        keys.append(rest)
        keys += [rest.bitwiseXOR(F.lit(_signed(1 << b))) for b in outside]
    return F.array(*keys)


def _forest(prints: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect whatever verified links connect among some fingerprints."""
    left, edges = np.unique(prints), []
    while len(left) > 1:
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            some, front = front[:_FRONT], front[_FRONT:]
            near = np.bitwise_count(some[:, None] ^ left[None, :]) <= RADIUS
            hit = near.any(axis=0)
            if hit.any():
                found = left[hit]
                edges.append((some[near.argmax(axis=0)[hit]], found))
                front, left = np.concatenate((front, found)), left[~hit]
    return edges


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Verified links within each run of equal keys of a sorted partition."""
    kept: list[np.ndarray] = [np.zeros((0, 2), dtype=np.int64)]

    def edges_of(rows: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.concatenate(([True], rows[1:, 0] != rows[:-1, 0])))
        size = np.diff(np.append(first, len(rows)))
        prints = rows[:, 1].view(np.uint64) if rows.flags["C_CONTIGUOUS"] else np.ascontiguousarray(rows[:, 1]).view(np.uint64)
        two = first[size == 2]
        a, b = prints[two], prints[two + 1]
        fits = (np.bitwise_count(a ^ b) <= RADIUS) & (a != b)
        edges = [(a[fits], b[fits])]
        for at, n in zip(first[size > 2], size[size > 2]):
            edges += _forest(prints[at : at + n])
        a, b = (np.concatenate(side).view(np.int64) for side in zip(*edges))
        return pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b)})

    for batch in batches:
        rows = np.stack([batch.column("key").to_numpy(), batch.column("print").to_numpy()], axis=1)
        if not len(rows):
            continue
        change = np.flatnonzero(rows[:, 0] != rows[-1, 0])
        whole = change[-1] + 1 if len(change) else 0  # the last key may go on
        if whole or kept[0].shape[0] and kept[0][0, 0] != rows[0, 0]:
            yield edges_of(np.concatenate([*kept, rows[:whole]]))
            kept = [rows[whole:]]
        else:
            kept.append(rows)
    last = np.concatenate(kept)
    if len(last):
        yield edges_of(last)


def links(prints: DataFrame) -> DataFrame:
    """Edges (`a`, `b`) between distinct fingerprints (column `print`) that connect all
    that verified links connect."""
    keyed = prints.select("print").distinct().select(F.explode(variants()).alias("key"), "print")
    dealt = keyed.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_links, "a long, b long").distinct()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step; edges are (`a` > `b`) pairs without loops."""
    if large:
        pairs = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        pairs = edges
    least = pairs.groupBy("a").agg(F.min("b").alias("least"))
    met = pairs.join(least.withColumn("least", F.least("least", "a")), "a")
    if large:
        moved = met.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = met.select("b", "least").union(met.select("a", "least")).toDF("a", "b")
    return moved.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """`node` and `root` (the smallest node reachable) of every node that has an edge."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    rounds = Rounds(edges.sparkSession, "simhash-edges")
    edges, before = rounds.put(edges.distinct()), None
    while True:
        state = edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        edges = rounds.put(_star(_star(edges, large=True), large=False))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`row_id`, `print`, `root` (the component by its smallest fingerprint) and
    `component_id`, the smallest id in the component."""
    prints = written(fingerprints(df, id_col, text_col), "simhash-prints")
    nodes = written(prints.groupBy("print").agg(F.min("row_id").alias("first_id")), "simhash-nodes")
    roots = components(links(nodes)).withColumnRenamed("node", "print")
    rooted = nodes.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = written(rooted.join(smallest, "root").select("print", "root", "component_id"), "simhash-components")
    return prints.join(named, "print").select("row_id", "print", "root", "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `df` of which one stays for each component of near copies: the smallest
    id's.

    Rows that agree in id and text are one document, of which one row stays. Different
    texts under one id are different documents: they stay if they are in different
    components. A row with a null id stays only if its component has no id at all, and then
    as the only one."""
    text = F.xxhash64(F.col(text_col).cast("string"))
    named = F.struct(F.col(id_col).isNull().alias("unnamed"), F.col(id_col).alias("id"), text.alias("text_hash"))
    keyed = df.select(named.alias("key"), F.col(text_col).alias("text"))
    found = near_duplicates(keyed, "key", "text").where("row_id = component_id")
    chosen = written(found.groupBy("row_id").agg(F.count(F.lit(1)).alias("times")), "simhash-chosen")
    keys = chosen.select("row_id.*", "times").toDF("its unnamed", "its id", "its hash", "times")
    same = (
        (F.col(id_col).isNull() == F.col("`its unnamed`"))
        & F.col(id_col).eqNullSafe(F.col("`its id`")) & (text == F.col("`its hash`"))
    )
    kept = df.join(keys.where("times = 1"), same, "left_semi")
    repeated = keys.where("times > 1")
    if repeated.isEmpty():
        return kept
    # Of rows that agree in id and text one is picked before they are shuffled.
    again = with_rows(df.join(repeated, same, "left_semi"))
    one = again.groupBy(F.col(id_col).alias("id"), text.alias("text_hash")).agg(F.first("whole").alias("whole"))
    return kept.unionByName(one.select("whole.*"))
