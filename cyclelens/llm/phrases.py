"""Removal of repeated phrases with sharded Aho-Corasick automata.

Each word covered by a window of 13 words that also starts in a document with a smaller
id is removed. The stretches of all documents around shared anchors (see `anchors`) are
dealt by anchor, and every task works on its shard of the recurring phrases: the windows
that occur under two ids are confirmed first, by hashes of numbered words; each confirmed
phrase goes into an automaton; and the stretches of all documents are streamed through it to
locate every occurrence, word by word. The smallest id at each phrase decides. Equal
stretches are streamed once.

Words are separated by ASCII white space and compared unchanged. A null or wordless text
has no words; a text of fewer than 13 words stays whole. Repeated rows with one id are one
document and are treated alike; a row with a null id stays whole. Only the named columns
are read, so further columns of any name do no harm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from cyclelens.llm import anchors
from cyclelens.llm.batches import text_groups

SIZE = 13
SHARD_BYTES = 1 << 17  # of stretches for one automaton; a node with few children is fast
ANCHOR = 5


# Words are numbered, and a number is written as one character (two if there are too many
# words), so that the automaton runs over plain text. Surrogates are left out.
_LETTERS, _GAP, _GAP_WIDTH = 1_000_000, 0xD800, 0x800
_END = chr(0x10FFFF)  # stands between stretches and in no phrase


def written_as(numbers: np.ndarray, width: int) -> str:
    """Numbered words as characters, `width` for each word."""
    digits = numbers[:, None] if width == 1 else np.stack((numbers // _LETTERS, numbers % _LETTERS), axis=1)
    codes = (digits + 1).astype("<u4").ravel()
    codes[codes >= _GAP] += _GAP_WIDTH
    return codes.tobytes().decode("utf-32-le")


def confirmed(numbers: np.ndarray, owner: np.ndarray, least: np.ndarray, most: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Places of one occurrence of every window of words that occurs under two ids. `least`
    and `most` are the smallest and largest id of the stretch that each word's owner is."""
    n = max(0, len(numbers) - size + 1)
    places = np.flatnonzero(owner[:n] == owner[len(owner) - n :])
    sums = anchors.gram_hashes(anchors._mixed(numbers.astype(np.uint64) + np.uint64(1)), size)[places]
    if not len(places):
        return places
    order = np.argsort(sums, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], sums[order][1:] != sums[order][:-1])))
    of = owner[places[order]]
    several = np.minimum.reduceat(least[of], first) != np.maximum.reduceat(most[of], first)
    return places[order[first[several]]]


def automaton_of(phrases: list[str]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for number, phrase in enumerate(phrases):
        automaton.add_word(phrase, number)
    automaton.make_automaton()
    return automaton


def _locator(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in anchors.sorted_runs(batches, "anchor", SHARD_BYTES):
        ids = table.column("row_id").to_numpy()
        code, bodies = pd.factorize(np.array([*table.column("body").to_pylist(), None], dtype=object)[:-1])
        least, most = np.full(len(bodies), np.iinfo(np.int64).max), np.full(len(bodies), np.iinfo(np.int64).min)
        np.minimum.at(least, code, ids)
        np.maximum.at(most, code, ids)
        counts = np.array([b.count(b" ") + 1 for b in bodies])
        numbers, known = pd.factorize(np.array([*b" ".join(bodies).split(b" "), None], dtype=object)[:-1])
        owner = np.repeat(np.arange(len(bodies)), counts)
        places = confirmed(numbers, owner, least, most)
        if not len(places):
            continue
        width = 1 if len(known) < _LETTERS else 2
        line = written_as(numbers, width)
        automaton = automaton_of([line[p * width : (p + SIZE) * width] for p in places.tolist()])
        begin = np.cumsum(counts) - counts
        text = _END.join([line[a * width : (a + n) * width] for a, n in zip(begin.tolist(), counts.tolist())])
        hits = np.array(list(automaton.iter(text)), dtype=np.int64).reshape(-1, 2)
        last, phrase = hits[:, 0], hits[:, 1]
        starts = begin * width + np.arange(len(bodies))  # of each stretch in the text
        body = np.searchsorted(starts, last, side="right") - 1
        at = last + 1 - starts[body]  # characters up to the end of the phrase
        whole = at % width == 0
        body, phrase, at = body[whole], phrase[whole], at[whole] // width - SIZE
        # Every row with this stretch has the phrase at the same place.
        rows = np.argsort(code, kind="stable")
        copies = np.bincount(code, minlength=len(bodies))
        owner_of, copy = _spread(copies[body])
        row = rows[(np.cumsum(copies) - copies)[body][owner_of] + copy]
        yield anchors.later_spans(table, row, at[owner_of], phrase[owner_of], SIZE)


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def _cutter(scheme: anchors.Scheme):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_groups(batches, anchors.GROUP_BYTES):
            plain = [t or b"" for t in texts]
            words = [t.split() for t in plain]
            counts = np.array([len(w) for w in words])
            gone, first = anchors.cover(plain, counts, scheme, rows)
            kept, spans = [], []
            for k, mine in enumerate(words):
                edges = anchors.runs(gone[first[k] : first[k] + len(mine)])
                spans.append([{"start": a, "end": b} for a, b in edges])
                for a, b in reversed(edges):
                    del mine[a:b]
                kept.append(b" ".join(mine))
            yield pa.RecordBatch.from_pydict({
                "row_id": rows.column("row_id"), "n_words": pa.array(counts, pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                "kept": pa.array(kept, pa.binary()).cast(pa.string()),
                "kept_sha256": pa.array([hashlib.sha256(b).hexdigest() for b in kept]),
            })

    return cut


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`row_id`, `n_words`, `spans` (removed word ranges), `kept` (the remaining words,
    joined by one space) and its `kept_sha256`, for every row."""
    scheme = anchors.Scheme(anchors.word_tokens, SIZE, ANCHOR)
    rows = anchors.hashed_rows(df, id_col, text_col)
    met = anchors.with_spans(rows, scheme, _locator, "phrases")
    schema = "row_id long, n_words long, spans array<struct<start:long,end:long>>, kept string, kept_sha256 string"
    return met.mapInArrow(_cutter(scheme), schema)
