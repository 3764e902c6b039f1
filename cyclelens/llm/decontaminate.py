"""Benchmark decontamination by a broadcast set of test n-grams.

Every run of 13 words of a test item (the whole item if it is shorter) is a window. Tasks
hash the windows of the items; the driver sorts the hashes and broadcasts them, eight bytes
each, with the places of their words in the items' text. Each document is tokenised and
hashed with numpy, hashes that hit are verified by their words, and the words inside a
confirmed window are marked. There is no shuffle: the scan is one narrow stage over the
documents.

The test set is measured before it is broadcast: its text is what `block_bytes` bounds, and
a block is about five times as large as its text when built. Beyond that it is dealt into
blocks by item, and each block is one further pass over all documents whose result is
written before the next pass starts, so a worker holds one block at a time.

Words: A-Z lower-cased, then runs of a-z, 0-9 and all characters beyond ASCII. A null or
wordless text has no hit and zero words; a null or wordless item has no window; repeated
item ids name one item; repeated rows are judged one by one; null ids are carried along
(a null item id is ignored). Only the named columns are read, so further columns of any
name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclelens.llm.batches import id_and_text, output_schema, text_groups
from cyclelens.llm.hashing import SpanHasher, powers
from cyclelens.session import written

NGRAM = 13
BLOCK_BYTES = 16 << 20  # of item text in one broadcast block

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[np.r_[48:58, 97:123, 128:256]] = True
_BASE, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_SIEVE_BITS = 20

_HITS = "n_words long, spans array<struct<start:long,end:long>>, items array<string>"


class _Hasher:
    """Word bounds and hashes of a lower-cased byte string."""

    def __init__(self) -> None:
        self.spans = SpanHasher()

    def words(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes = np.frombuffer(text, dtype=np.uint8)
        inside = np.concatenate(([False], _IS_WORD[codes], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[0::2], edges[1::2]
        return starts, ends, self.spans.hashes(codes, starts, ends)


def _window_hashes(words: np.ndarray, lengths: set[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(length, hash of the window that starts at each word) for each wanted length."""
    longest = max(lengths, default=0)
    factor = powers(_STEP, longest)
    total = np.zeros(len(words), dtype=np.uint64)
    for k in range(min(longest, len(words))):
        total = total[: len(words) - k] + words[k:] * factor[k]
        if k + 1 in lengths:
            mixed = total ^ (total >> np.uint64(29))
            yield k + 1, mixed * _BASE


@dataclass
class Windows:
    """The windows of one length: sorted hashes, and for each the place of its words in the
    items' text and its item."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    items: np.ndarray
    sieve: np.ndarray


@dataclass
class WindowSet:
    """The windows of some test items. `text` holds the items' words, joined by a space."""

    items: list[str]
    text: bytes
    by_length: dict[int, Windows]

    def found(self, length: int, value: int, words: bytes) -> list[str]:
        """Items with this window, judged by its words."""
        windows = self.by_length[length]
        low, high = (int(np.searchsorted(windows.hashes, np.uint64(value), side)) for side in ("left", "right"))
        return [
            self.items[windows.items[i]] for i in range(low, high)
            if self.text[windows.starts[i] : windows.ends[i]] == words
        ]


_ITEM = "item string, words binary, length int, hashes binary, starts binary, ends binary"


def _item_windows(ngram: int):
    """One row for each item: its words joined by a space, and its windows as arrays."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _Hasher()
        for rows, texts in text_groups(batches):
            for item, text in zip(rows.column("item").to_pylist(), texts):
                lower = text.translate(_LOWER)
                starts, ends, _ = hasher.words(lower)
                joined = b" ".join([lower[a:b] for a, b in zip(starts.tolist(), ends.tolist())])
                starts, ends, hashes = hasher.words(joined)
                length = min(ngram, len(starts))
                if length:
                    (_, sums), = _window_hashes(hashes, {length})
                    yield pa.RecordBatch.from_pydict({
                        "item": pa.array([item]), "words": pa.array([joined], pa.binary()),
                        "length": pa.array([length], pa.int32()), "hashes": pa.array([sums.tobytes()], pa.binary()),
                        "starts": pa.array([starts[: len(sums)].astype(np.int64).tobytes()], pa.binary()),
                        "ends": pa.array([ends[length - 1 :].astype(np.int64).tobytes()], pa.binary()),
                    })

    return cut


def _window_set(items: DataFrame, ngram: int, block: int, blocks: int) -> WindowSet:
    """The windows of the items of one block."""
    part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
    rows = part.mapInArrow(_item_windows(ngram), _ITEM).collect()
    offsets = np.cumsum([0, *(len(r["words"]) + 1 for r in rows)])
    by_length = {}
    for length in {r["length"] for r in rows}:
        own = [k for k, r in enumerate(rows) if r["length"] == length]
        hashes = [np.frombuffer(rows[k]["hashes"], np.uint64) for k in own]
        places = [
            np.concatenate([np.frombuffer(rows[k][side], np.int64) + offsets[k] for k in own]) for side in ("starts", "ends")
        ]
        item = np.repeat(np.array(own), [len(h) for h in hashes])
        joined = np.concatenate(hashes)
        order = np.argsort(joined, kind="stable")
        sieve = np.zeros(1 << _SIEVE_BITS, dtype=bool)
        sieve[joined >> np.uint64(64 - _SIEVE_BITS)] = True
        by_length[length] = Windows(joined[order], places[0][order], places[1][order], item[order], sieve)
    return WindowSet([r["item"] for r in rows], b" ".join(bytes(r["words"]) for r in rows), by_length)


def _scan(text: bytes, bounds: np.ndarray, windows: WindowSet, hasher: _Hasher):
    """Words of several texts laid end to end: owner and bounds of each word, whether it
    is hit, and the items found in each text."""
    starts, ends, hashes = hasher.words(text)
    owner = np.searchsorted(bounds, starts, side="right") - 1
    change = np.zeros(len(starts) + 1, dtype=np.int64)
    found: dict[int, set[str]] = {}
    for length, sums in _window_hashes(hashes, set(windows.by_length)):
        known = windows.by_length[length]
        likely = known.sieve[sums >> np.uint64(64 - _SIEVE_BITS)]
        likely &= owner[: len(sums)] == owner[length - 1 :]
        places = np.flatnonzero(likely)
        at = np.minimum(np.searchsorted(known.hashes, sums[places]), len(known.hashes) - 1)
        for i in places[known.hashes[at] == sums[places]].tolist():
            words = b" ".join([text[a:b] for a, b in zip(starts[i : i + length], ends[i : i + length])])
            items = windows.found(length, sums[i], words)
            if items:
                change[i] += 1
                change[i + length] -= 1
                found.setdefault(int(owner[i]), set()).update(items)
    return starts, ends, owner, np.cumsum(change[:-1]) > 0, found


def _runs(hit: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """[first, last + 1) of the maximal runs of hit words of one text."""
    if not len(hit):
        return np.zeros((0, 2), dtype=np.int64)
    opens = hit & np.concatenate(([True], ~hit[:-1] | (owner[1:] != owner[:-1])))
    closes = hit & np.concatenate((~hit[1:] | (owner[1:] != owner[:-1]), [True]))
    return np.stack([np.flatnonzero(opens), np.flatnonzero(closes) + 1], axis=1)


def _scanner(windows: WindowSet, cut: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _Hasher()
        for rows, texts in text_groups(batches):
            plain = [text or b"" for text in texts]
            joined = b"\n".join(plain)
            bounds = np.cumsum([0, *(len(text) + 1 for text in plain)])
            starts, ends, owner, hit, found = _scan(joined.translate(_LOWER), bounds, windows, hasher)
            spans: list[list[dict]] = [[] for _ in plain]
            first = np.searchsorted(owner, np.arange(len(plain)))
            pieces: dict[int, list[bytes]] = {}
            at: dict[int, int] = {}
            for a, b in _runs(hit, owner):
                k = int(owner[a])
                spans[k].append({"start": int(a - first[k]), "end": int(b - first[k])})
                begin, end = int(starts[a] - bounds[k]), int(ends[b - 1] - bounds[k])
                pieces.setdefault(k, []).append(plain[k][at.get(k, 0) : begin])
                at[k] = end
            columns = {
                "row_id": rows.column("row_id"),
                "n_words": pa.array(np.bincount(owner, minlength=len(plain)), pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                "items": pa.array([sorted(found.get(k, ())) for k in range(len(plain))], pa.list_(pa.string())),
            }
            if cut:
                clean = [
                    text if k not in pieces else b"".join([*pieces[k], plain[k][at[k] :]])
                    for k, text in enumerate(texts)
                ]
                columns["clean_text"] = pa.array(clean, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return scan


def _without_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut word spans that are already known out of the texts."""
    hasher = _Hasher()
    for rows, texts in text_groups(batches):
        clean = []
        for text, spans in zip(texts, rows.column("spans").to_pylist()):
            if text and spans:
                starts, ends, _ = hasher.words(text.translate(_LOWER))
                edges = [0, *(int(x) for s in spans for x in (starts[s["start"]], ends[s["end"] - 1])), len(text)]
                text = b"".join(text[i:j] for i, j in zip(edges[0::2], edges[1::2]))
            clean.append(text)
        kept = {c: rows.column(c) for c in ("row_id", "n_words", "spans", "items")}
        yield pa.RecordBatch.from_pydict(kept | {"clean_text": pa.array(clean, pa.binary()).cast(pa.string())})


def contamination(
    documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", ngram: int = NGRAM,
    block_bytes: int = BLOCK_BYTES, cut: bool = False,
) -> DataFrame:
    """One row per document: `row_id`, `n_words`, `spans` (maximal runs of hit words, as
    word positions, end exclusive), `items` (ids found, as sorted strings) and, with
    `cut`, `clean_text`, the text without its hit spans."""
    clean = ", clean_text string" * cut
    source = id_and_text(documents, id_col, text_col)
    items = benchmark.select(
        F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text")
    ).where("item is not null and text is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    if blocks == 1:
        windows = _window_set(items, ngram, 0, 1)
        return source.mapInArrow(_scanner(windows, cut), output_schema(documents, id_col, _HITS + clean))
    # Repeated rows would meet under one id, so each row gets a name of its own.
    named = written(source.withColumn("row_id", F.struct(F.uuid().alias("row"), "row_id")), "decontaminate-rows")
    by_row = output_schema(named, "row_id", _HITS)
    merged = None
    for block in range(blocks):
        scanner = _scanner(_window_set(items, ngram, block, blocks), False)
        hits = written(named.mapInArrow(scanner, by_row), "decontaminate-pass")
        merged = hits if merged is None else merged.unionByName(hits)
    found = merged.groupBy("row_id").agg(
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    ).withColumn("spans", _merge_spans(F.col("spans")))
    if cut:
        met = named.join(found, "row_id").select("row_id", "text", "n_words", "spans", "items")
        found = met.mapInArrow(_without_spans, output_schema(named, "row_id", _HITS + clean))
    return found.select("row_id.row_id", *[c for c in found.columns if c != "row_id"])


def _merge_spans(spans):
    """Overlapping or touching spans joined into maximal ones."""
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def step(done, span):
        last = F.element_at(done, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        touches = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= span["start"])
        return F.when(
            touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))
        ).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.array_sort(spans), empty, step)


def hit_words():
    """Number of hit words, from `spans`."""
    return F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])


def is_contaminated(share: int = 20):
    """A document counts as contaminated when a twentieth of its words is hit."""
    return (hit_words() > 0) & (hit_words() * share >= F.col("n_words"))
