"""Removal of repeated byte strings by suffix sorting with bucket-pointer refinement.

Each byte covered by a string of 50 bytes that also starts in a document with a smaller
id is removed. Candidate stretches are brought together by anchors (see `anchors`). In a
task, the suffixes of its stretches are put into buckets by their first eight bytes and
refined: suffixes of one bucket are sorted by the bucket that the suffix at a later
offset is in, so depth 8 gives depth 16, 32 and finally 50 (32 from the start and 32 from
offset 18). The new buckets serve the next refinement; suffixes alone in their bucket are
unique and drop out. Suffixes in one bucket at depth 50 are equal in their first 50 bytes,
and the smallest id among them decides.

Texts are UTF-8; removal may cut inside a character, so kept texts are binary. A null
text is empty; a text of fewer than 50 bytes stays whole. Repeated rows with one id are
one document and are treated alike; a row with a null id stays whole. Only the named
columns are read, so further columns of any name do no harm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from cyclelens.llm import anchors
from cyclelens.llm.batches import text_groups

SIZE = 50
ANCHOR = 20
FIRST = 8


def _buckets(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.uint64)


def equal_strings(data: np.ndarray, bounds: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Places in `data` whose next `size` bytes occur more than once, and their bucket.
    `bounds` are the ends of the stretches laid end to end; no string crosses one."""
    n = len(data) - FIRST + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys = np.zeros(n, dtype=np.uint64)
    for k in range(FIRST):
        keys = keys << np.uint64(8) | data[k : k + n]
    room = np.repeat(bounds, np.diff(bounds, prepend=0)) - np.arange(len(data))
    alive = np.flatnonzero(room[:n] >= FIRST)
    bucket = np.zeros(len(data), dtype=np.uint64)
    bucket[alive] = _buckets(keys[alive])
    depth = FIRST
    while depth < size:
        step = min(depth, size - depth)
        # Refine the suffixes that go on and are not alone in their bucket.
        going = alive[room[alive] >= depth + step]
        going = going[np.bincount(bucket[going].astype(np.int64))[bucket[going].astype(np.int64)] > 1]
        pointer = bucket[going] * np.uint64(len(data) + 1) + bucket[going + step]
        finer = np.zeros(len(data), dtype=np.uint64)
        finer[going] = _buckets(pointer)
        # A suffix that dropped out may still be pointed at: it keeps a bucket of its own.
        others = np.setdiff1d(alive[room[alive] >= depth + step], going, assume_unique=True)
        finer[others] = np.arange(len(others), dtype=np.uint64) + np.uint64(len(going))
        alive, bucket, depth = alive[room[alive] >= depth + step], finer, depth + step
    label = bucket[alive].astype(np.int64)
    many = np.bincount(label)[label] > 1 if len(label) else np.zeros(0, bool)
    return alive[many], label[many]


def _refiner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in anchors.sorted_runs(batches, "anchor"):
        # Equal stretches are one stretch with the smallest of their ids. Where all
        # stretches of an anchor are equal, that id decides, and nothing is sorted.
        code, bodies = pd.factorize(np.array([*table.column("body").to_pylist(), None], dtype=object)[:-1])
        anchor = pd.factorize(table.column("anchor").to_numpy())[0]
        anchor_of = np.zeros(len(bodies), np.int64)
        anchor_of[code] = anchor
        several = np.bincount(anchor_of)[anchor_of] > 1
        size = np.array([len(b) for b in bodies])
        windows = size - SIZE + 1
        # Windows by themselves: one class for each window of each distinct stretch …
        begin = np.cumsum(windows) - windows
        classes = np.arange(windows.sum())
        # … which equal windows of different stretches then share.
        chosen = np.flatnonzero(several)
        if len(chosen):
            data = np.frombuffer(b"".join(bodies[chosen]), np.uint8)
            bounds = np.cumsum(size[chosen])
            places, label = equal_strings(data, bounds)
            body = np.searchsorted(bounds, places, side="right")
            at = places - (bounds[body] - size[chosen][body])
            mine = begin[chosen[body]] + at
            least = np.full(int(label.max(initial=-1)) + 1, len(classes))
            np.minimum.at(least, label, mine)
            classes[mine] = least[label]
        count = windows[code]
        row = np.repeat(np.arange(len(code)), count)
        at = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        yield anchors.later_spans(table, row, at, classes[begin[code][row] + at], SIZE)


def _cutter(scheme: anchors.Scheme):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_groups(batches, anchors.GROUP_BYTES):
            plain = [t or b"" for t in texts]
            counts = np.array([len(t) for t in plain])
            gone, first = anchors.cover(plain, counts, scheme, rows)
            kept, spans = [], []
            for k, text in enumerate(plain):
                edges = anchors.runs(gone[first[k] : first[k] + len(text)])
                spans.append([{"start": a, "end": b} for a, b in edges])
                at = [0, *(x for edge in edges for x in edge), len(text)]
                kept.append(b"".join([text[a:b] for a, b in zip(at[0::2], at[1::2])]) if edges else text)
            yield pa.RecordBatch.from_pydict({
                "row_id": rows.column("row_id"), "n_bytes": pa.array([len(t) for t in plain], pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                "kept": pa.array(kept, pa.binary()),
                "kept_sha256": pa.array([hashlib.sha256(b).hexdigest() for b in kept]),
            })

    return cut


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`row_id`, `n_bytes`, `spans` (removed byte ranges), `kept` (the remaining bytes)
    and their `kept_sha256`, for every row."""
    scheme = anchors.Scheme(anchors.byte_tokens, SIZE, ANCHOR)
    rows = anchors.hashed_rows(df, id_col, text_col)
    met = anchors.with_spans(rows, scheme, _refiner, "suffixes")
    schema = "row_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary, kept_sha256 string"
    return met.mapInArrow(_cutter(scheme), schema)
