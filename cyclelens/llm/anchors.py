"""Which windows of a text also start in a document with a smaller id: candidates.

A window is a run of `size` tokens (bytes or words). Its anchor is the q-gram in it whose
hash is smallest, the leftmost of equal ones, so equal windows have equal anchors at equal
places, and neighbouring windows mostly share one. Only the anchors are shuffled:

0. `originals`: equal texts are one text, that of the smallest id. The others lose all
   their windows, and take no part in what follows.
1. `repeated`: anchors (hash, text) are sorted by hash; those seen in two different texts
   are reported to their texts.
2. `stretches`: a text sends, for each such anchor, the stretch of text that all its
   windows with this anchor cover, to the task of the anchor. Equal windows of different
   documents meet there. What happens there is the operator's method.
3. `with_spans`: the token ranges found are gathered and joined to each document.

Hot passages (a window in a thousandth of all documents) never meet in one task: they
are found on a bounded sample of documents, the first document of each is found by a
minimum that is taken before the shuffle, and windows in that table, which the threshold
bounds, are decided where the text is read. Their q-grams are the last choice as anchors,
so windows that only overlap a hot passage are sent by their own words. The sample decides
where a window is handled, never what the answer is.

Anchors and hot windows are compared by 64-bit hashes, equal texts by MD5; what meets at
an anchor is compared by its text. Ids must be integers. Documents with a null id neither lose nor cause
anything; rows with one id count as one document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclelens.llm.batches import small_batches, text_groups
from cyclelens.llm.hashing import SpanHasher
from cyclelens.session import written

SAMPLE_DOCUMENTS = 20_000
HOT_SHARE = 0.001  # of the sampled documents, but at least HOT_LEAST of them
HOT_LEAST = 20
GROUP_BYTES = 1 << 17  # of texts worked on at once: their arrays stay in the cache
CHUNK_BYTES = 1 << 20

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_LOW, _RANK = _U(0xFFFFFFFF), _U(0x7FFFFFFF00000000)


@dataclass
class Tokens:
    """Several texts laid end to end, cut into tokens."""

    hashes: np.ndarray  # of each token; bytes stand for themselves
    owner: np.ndarray  # which text it is in
    first: np.ndarray  # of each text, its first token
    starts: np.ndarray | None  # byte bounds in `joined`; None where tokens are bytes
    ends: np.ndarray | None
    joined: bytes

    def body(self, a: int, b: int) -> bytes:
        """Tokens a … b - 1 as text."""
        if self.starts is None:
            return self.joined[a:b]
        return b" ".join([self.joined[x:y] for x, y in zip(self.starts[a:b], self.ends[a:b])])


_HASHER = SpanHasher()
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def byte_tokens(texts: list[bytes]) -> Tokens:
    joined = b"".join(texts)
    lengths = np.array([len(t) for t in texts])
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    return Tokens(np.frombuffer(joined, np.uint8), owner, np.cumsum(lengths) - lengths, None, None, joined)


def word_tokens(texts: list[bytes]) -> Tokens:
    joined = b"\n".join(texts)
    codes = np.frombuffer(joined, np.uint8)
    inside = np.concatenate(([False], ~_SPACE[codes], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    owner = np.searchsorted(bounds, starts, side="right").astype(np.int32) - np.int32(1)
    hashes = _HASHER.hashes(codes, starts, ends)
    return Tokens(_mixed(hashes), owner, np.searchsorted(owner, np.arange(len(texts))), starts, ends, joined)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power(k: int) -> np.uint64:
    return _U(pow(int(_BASE), k, 1 << 64))


def gram_hashes(tokens: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q tokens from each place."""
    if len(tokens) < q:
        return np.zeros(0, np.uint64)
    if tokens.dtype == np.uint8:
        return _byte_grams(tokens, q)
    done, total, part, width = 0, np.zeros(len(tokens), np.uint64), tokens, 1
    while True:  # by doubling
        if q & width:
            n = min(len(total), len(part) - done)
            total = total[:n] * _power(width) + part[done : done + n]
            done += width
        if done == q:
            return _mixed(total)
        part = part[: len(part) - width] * _power(width) + part[width:]
        width *= 2


_FACTORS = np.random.default_rng(8).integers(1, 2**63, 64, dtype=np.uint64) * _U(2) + _U(1)


def _byte_grams(codes: np.ndarray, q: int) -> np.ndarray:
    """The same for bytes, eight at a time: a sum of the words that cover a q-gram, each
    with a factor of its own. Its high bits depend on every byte."""
    n, codes = len(codes) - q + 1, np.ascontiguousarray(codes)
    words = np.ascontiguousarray(np.ndarray((len(codes) - 7,), "<u8", codes.data, 0, (1,)))
    offsets = [*range(0, q - 8, 8), q - 8]
    total = words[:n] * _FACTORS[0]
    for at, factor in zip(offsets[1:], _FACTORS[1:]):
        total += words[at : at + n] * factor
    return total


def _sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    width = 1
    while 2 * width <= w:
        values = np.minimum(values[: len(values) - width], values[width:])
        width *= 2
    rest = w - width
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


@dataclass
class Scheme:
    """How texts are cut and anchored; with the hot windows and q-grams once known."""

    tokenise: Callable[[list[bytes]], Tokens]
    size: int  # tokens in a window
    q: int  # tokens in a q-gram
    hot_windows: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    hot_first: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    hot_grams: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))

    def places(self, tokens: Tokens) -> np.ndarray:
        """Where windows start: none crosses the end of a text."""
        n = max(0, len(tokens.hashes) - self.size + 1)
        return np.flatnonzero(tokens.owner[:n] == tokens.owner[len(tokens.owner) - n :])

    def windows(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Places of the windows, for each the place of its anchor and its row in the table
        of hot windows or -1, and the hashes of all q-grams."""
        n = len(tokens.hashes) - self.size + 1
        if n <= 0:
            empty = np.zeros(0, np.int64)
            return empty, empty, empty, np.zeros(0, np.uint64)
        grams = gram_hashes(tokens.hashes, self.q)
        rank = grams & _RANK
        if len(self.hot_grams):
            rank[_is_in(grams, self.hot_grams)] |= _U(1 << 63)
        rank |= np.arange(len(grams), dtype=np.uint64)
        places = self.places(tokens)
        least = _sliding_min(rank, self.size - self.q + 1)[places]
        anchors = (least & _LOW).astype(np.int64)
        # Every q-gram of a hot window is hot, so its anchor is.
        hot = np.full(len(places), -1)
        likely = np.flatnonzero(least >> _U(63)) if len(self.hot_windows) else ()
        if len(likely):
            hot[likely] = self._rows_of(tokens, places[likely])
        return places, anchors, hot, grams

    def hot_places(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Places of the hot windows, and their rows in the table."""
        if len(self.hot_windows) and len(tokens.hashes) >= self.size:
            marks = _is_in(gram_hashes(tokens.hashes, self.q), self.hot_grams)
            if marks.any():
                seen = np.concatenate(([0], np.cumsum(marks)))
                wide = self.size - self.q + 1
                full = seen[wide:] - seen[:-wide] == wide
                places = self.places(tokens)
                places = places[full[places]]
                rows = self._rows_of(tokens, places)
                return places[rows >= 0], rows[rows >= 0]
        return np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _rows_of(self, tokens: Tokens, places: np.ndarray) -> np.ndarray:
        """Rows in the table of hot windows of the windows at increasing places, or -1."""
        rows = np.full(len(places), -1)
        if len(places):
            begin = np.flatnonzero(np.concatenate(([True], places[1:] != places[:-1] + 1)))
            runs = np.diff(np.append(begin, len(places)))
            wide = runs + self.size - 1
            first = np.cumsum(wide) - wide
            taken = np.repeat(places[begin] - first, wide) + np.arange(wide.sum())
            sums = gram_hashes(tokens.hashes[taken], self.size)
            sums = sums[np.repeat(first - begin, runs) + np.arange(len(places))]
            hit = np.flatnonzero(_is_in(sums, self.hot_windows))
            rows[hit] = np.searchsorted(self.hot_windows, sums[hit])
        return rows


def _is_in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Membership in a sorted table; a sieve of bits answers for most values."""
    if not len(table):
        return np.zeros(len(values), bool)
    shift = _U(max(44, 64 - 4 - len(table).bit_length()))
    sieve = np.zeros(1 << (64 - int(shift)), bool)
    sieve[table >> shift] = True
    found = sieve[values >> shift]
    likely = np.flatnonzero(found)
    at = np.minimum(np.searchsorted(table, values[likely]), len(table) - 1)
    found[likely] = table[at] == values[likely]
    return found


def _groups(batches, scheme: Scheme):
    """(rows, ids, tokens) of texts with an id."""
    for rows, texts in text_groups(batches, GROUP_BYTES):
        yield rows, rows.column("row_id").to_numpy(zero_copy_only=False), scheme.tokenise([t or b"" for t in texts])


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _anchor_rows(scheme: Scheme):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, tokens in _groups(batches, scheme):
            _, anchors, hot, grams = scheme.windows(tokens)
            anchors = anchors[hot < 0]
            new = np.flatnonzero(np.concatenate(([True], anchors[1:] != anchors[:-1]))[: len(anchors)])
            owner = tokens.owner[anchors[new]]
            texts = rows.column("text_hash").to_numpy()
            yield pa.RecordBatch.from_pydict({"anchor": _signed(grams[anchors[new]]), "text_hash": pa.array(texts[owner])})

    return emit


def _document_anchors(scheme: Scheme):
    """As `_anchor_rows`, but copies count as documents."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, tokens in _groups(batches, scheme):
            _, anchors, _, grams = scheme.windows(tokens)
            new = np.flatnonzero(np.concatenate(([True], anchors[1:] != anchors[:-1]))[: len(anchors)])
            owner = tokens.owner[anchors[new]]
            yield pa.RecordBatch.from_pydict({"anchor": _signed(grams[anchors[new]]), "document": pa.array(ids[owner])})

    return emit


def _hot_rows(scheme: Scheme, anchors: np.ndarray):
    """Windows with a hot anchor, and the q-grams in them: each once for each document."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, tokens in _groups(batches, scheme):
            places, at, _, grams = scheme.windows(tokens)
            places = places[_is_in(grams[at], anchors)]
            sums = gram_hashes(tokens.hashes, scheme.size)
            inside = np.unique((places[:, None] + np.arange(scheme.size - scheme.q + 1)).ravel())
            for kind, values, at in (("window", sums, places), ("gram", grams, inside)):
                if len(at):
                    pairs = np.unique(np.stack([values[at], tokens.owner[at].astype(np.uint64)], axis=1), axis=0)
                    yield pa.RecordBatch.from_pydict({"kind": pa.array([kind] * len(pairs)), "hash": _signed(np.ascontiguousarray(pairs[:, 0]))})

    return emit


def _first_rows(scheme: Scheme):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, tokens in _groups(batches, scheme):
            places, at = scheme.hot_places(tokens)
            if len(places):
                first = np.full(len(scheme.hot_windows), np.iinfo(np.int64).max)
                np.minimum.at(first, at, ids[tokens.owner[places]])
                seen = np.unique(at)
                yield pa.RecordBatch.from_pydict({"hash": _signed(scheme.hot_windows[seen]), "first": pa.array(first[seen])})

    return emit


def find_hot(rows: DataFrame, scheme: Scheme) -> None:
    """Fill in the scheme's hot windows, with their first documents, and hot q-grams. At
    most about tokens-per-document / HOT_SHARE of them reach the driver."""
    n = rows.count()
    sample = rows
    if n > SAMPLE_DOCUMENTS:
        share = SAMPLE_DOCUMENTS / n
        sample = rows.where(F.pmod(F.xxhash64("row_id", "text_hash"), F.lit(1 << 30)) < int(share * (1 << 30)))
    least = max(HOT_LEAST, int(HOT_SHARE * min(n, SAMPLE_DOCUMENTS)))
    rows_of = "row_id", "text_hash", "text"
    sample, rows = sample.select(*rows_of), rows.select(*rows_of)
    seen = sample.mapInArrow(_document_anchors(scheme), "anchor long, document long").distinct()
    hot = seen.groupBy("anchor").count().where(F.col("count") >= least).select("anchor").collect()
    if not hot:
        return
    anchors = np.sort(np.array([h[0] for h in hot]).view(np.uint64))
    counted = sample.mapInArrow(_hot_rows(scheme, anchors), "kind string, hash long").groupBy("kind", "hash").count()
    found = counted.where(F.col("count") >= least).select("kind", "hash").collect()
    by_kind = {
        kind: np.sort(np.array([h for k, h in found if k == kind], dtype=np.int64).view(np.uint64))
        for kind in ("window", "gram")
    }
    scheme.hot_windows, scheme.hot_grams = by_kind["window"], by_kind["gram"]
    if len(scheme.hot_windows):
        firsts = rows.mapInArrow(_first_rows(scheme), "hash long, first long").groupBy("hash").agg(F.min("first")).collect()
        first = {h: f for h, f in firsts}
        scheme.hot_first = np.array([first[int(h)] for h in scheme.hot_windows.view(np.int64)])


def sorted_runs(batches, column: str, chunk_bytes: int = CHUNK_BYTES) -> Iterator[pa.Table]:
    """The rows of a partition sorted by `column`, in tables of about `chunk_bytes` that
    never divide a run of equal values."""
    kept: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column).to_numpy()
        change = np.flatnonzero(values != values[-1])
        cut = int(change[-1]) + 1 if len(change) else 0
        if not cut and kept and kept[-1].column(column)[-1].as_py() != values[0]:
            cut, held = 0, True
        else:
            held = bool(cut)
        if held and size + batch.nbytes >= chunk_bytes:
            whole = [*kept, *([batch.slice(0, cut)] if cut else [])]
            yield pa.Table.from_batches(whole)
            kept, size = [batch.slice(cut)], 0
        else:
            kept.append(batch)
        size += batch.nbytes
    if kept:
        yield pa.Table.from_batches(kept)


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in sorted_runs(batches, "anchor"):
        anchor, ids = table.column("anchor").to_numpy(), table.column("text_hash").to_numpy()
        new = np.concatenate(([True], anchor[1:] != anchor[:-1]))
        start = np.flatnonzero(new)
        two = np.minimum.reduceat(ids, start) != np.maximum.reduceat(ids, start)
        keep = two[np.cumsum(new) - 1]
        yield pa.RecordBatch.from_pydict({"anchor": pa.array(anchor[keep]), "text_hash": pa.array(ids[keep])})


def originals(rows: DataFrame) -> DataFrame:
    """`row_id`, `text_hash` and `first_id`, the smallest id with the same text."""
    keys = rows.select("row_id", "text_hash", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("digest"))
    keys = keys.distinct()
    first = keys.groupBy("digest").agg(F.min("row_id").alias("first_id"))
    return keys.join(first, "digest").select("row_id", "text_hash", "first_id")


def repeated(rows: DataFrame, scheme: Scheme) -> DataFrame:
    """`text_hash` and `anchors`: the anchors of a text that other texts have too."""
    anchors = rows.select("row_id", "text_hash", "text").mapInArrow(_anchor_rows(scheme), "anchor long, text_hash long")
    dealt = anchors.repartition("anchor").sortWithinPartitions("anchor")
    found = dealt.mapInArrow(_repeats, "anchor long, text_hash long")
    return found.groupBy("text_hash").agg(F.collect_set("anchor").alias("anchors"))


_STRETCH = "anchor long, row_id long, text_hash long, place int, n_windows int, body binary"


def _flagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that have a repeated anchor."""
    for batch in batches:
        yield batch.filter(batch.column("anchors").is_valid())


def _stretch_rows(scheme: Scheme):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ids, tokens in _groups(_flagged(batches), scheme):
            places, anchors, hot, grams = scheme.windows(tokens)
            places, anchors = places[hot < 0], anchors[hot < 0]
            if not len(places):
                continue
            first = np.flatnonzero(np.concatenate(([True], anchors[1:] != anchors[:-1])))
            last = np.append(first[1:], len(anchors)) - 1
            owner = tokens.owner[places[first]]
            lists = rows.column("anchors")
            flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            of = np.repeat(np.arange(len(rows)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            wanted = np.unique(_mixed(flat + of.astype(np.uint64) * _BASE))
            hashes = grams[anchors[first]]
            mine = _mixed(hashes + owner.astype(np.uint64) * _BASE)
            pick = np.flatnonzero(_is_in(mine, wanted)) if len(wanted) else np.zeros(0, np.int64)
            first, last, owner, hashes = first[pick], last[pick], owner[pick], hashes[pick]
            low, high = places[first], places[last] + scheme.size
            yield pa.RecordBatch.from_pydict({
                "anchor": _signed(hashes), "row_id": pa.array(ids[owner]),
                "text_hash": pa.array(rows.column("text_hash").to_numpy()[owner]),
                "place": pa.array((low - tokens.first[owner]).astype(np.int32)),
                "n_windows": pa.array((high - low - scheme.size + 1).astype(np.int32)),
                "body": pa.array([tokens.body(a, b) for a, b in zip(low.tolist(), high.tolist())], pa.binary()),
            })

    return emit


def stretches(texts: DataFrame, flagged: DataFrame, scheme: Scheme) -> DataFrame:
    """The stretches of text around repeated anchors, sorted by anchor in partitions."""
    met = texts.join(flagged, ["row_id", "text_hash"], "left")
    sent = met.select("row_id", "text_hash", "text", "anchors").mapInArrow(_stretch_rows(scheme), _STRETCH)
    return sent.repartition("anchor").sortWithinPartitions("anchor")


SPANS = "row_id long, text_hash long, first int, last int"


def later_spans(table: pa.Table, window_row: np.ndarray, window_at: np.ndarray, classes: np.ndarray, size: int) -> pa.RecordBatch:
    """Token ranges of the windows whose class has a document with a smaller id. Window i
    is the `window_at[i]`-th of stretch `window_row[i]`; equal windows share a class."""
    ids = table.column("row_id").to_numpy()[window_row]
    first = np.full(int(classes.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(first, classes, ids)
    later = np.flatnonzero(first[classes] < ids)
    row, at = window_row[later], window_at[later]
    order = np.lexsort((at, row))
    row, at = row[order], at[order]
    new = np.concatenate(([True], (row[1:] != row[:-1]) | (at[1:] > at[:-1] + 1)))[: len(row)]
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(row))[: len(begin)] - 1
    place = table.column("place").to_numpy()[row[begin]]
    return pa.RecordBatch.from_pydict({
        "row_id": pa.array(table.column("row_id").to_numpy()[row[begin]]),
        "text_hash": pa.array(table.column("text_hash").to_numpy()[row[begin]]),
        "first": pa.array((place + at[begin]).astype(np.int32)),
        "last": pa.array((place + at[end] + size).astype(np.int32)),
    })


def with_spans(rows: DataFrame, scheme: Scheme, method: Callable, label: str) -> DataFrame:
    """Every row with `is_copy` (a smaller id has the same text, so every window goes) and
    `found`: token ranges covered by windows that a smaller id has too. `method` turns sorted
    stretches into such ranges.

    The texts are dealt by (row_id, text_hash) for two joins: with their repeated anchors,
    and with the ranges found. Both name the same table in one query, so Spark shuffles the
    texts once and reads that shuffle twice."""
    known = rows.where("row_id is not null")
    find_hot(known, scheme)
    firsts = written(originals(known), f"{label}-originals")
    own = firsts.where("row_id = first_id").select("row_id", "text_hash")
    flagged = written(own.join(repeated(known, scheme), "text_hash"), f"{label}-anchors")
    texts = rows.select("row_id", "text_hash", "text")
    found = stretches(texts, flagged, scheme).mapInArrow(method, SPANS)
    found = found.groupBy("row_id", "text_hash").agg(F.collect_list(F.struct("first", "last")).alias("found"))
    copies = firsts.where("row_id > first_id").select("row_id", "text_hash", F.lit(True).alias("is_copy"))
    found = found.withColumn("is_copy", F.lit(False)).unionByName(copies, allowMissingColumns=True)
    return texts.join(found, ["row_id", "text_hash"], "left").select("row_id", "text", "found", "is_copy")


def hashed_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    small_batches(df)
    text = F.col(text_col).cast("string")
    return df.select(F.col(id_col).cast("long").alias("row_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def cover(texts: list[bytes], counts: np.ndarray, scheme: Scheme, rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens of texts with `counts` tokens go: those in a range found, in a hot window
    of an earlier document, or in any window of a copy. And where each text's tokens begin."""
    ends = np.cumsum(counts)
    first = ends - counts
    change = np.zeros(int(counts.sum()) + 1, dtype=np.int32)
    copies = rows.column("is_copy").fill_null(False).to_numpy(zero_copy_only=False) & (counts >= scheme.size)
    np.add.at(change, first[copies], 1)
    np.add.at(change, ends[copies], -1)
    lists = rows.column("found")
    flat = lists.flatten()
    if len(flat):
        base = np.repeat(first, lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        np.add.at(change, base + flat.field("first").to_numpy(), 1)
        np.add.at(change, base + flat.field("last").to_numpy(), -1)
    if len(scheme.hot_windows):
        known = rows.column("row_id").is_valid().to_numpy(zero_copy_only=False)
        ids = rows.column("row_id").fill_null(0).to_numpy()
        tokens = scheme.tokenise(texts)
        places, at = scheme.hot_places(tokens)
        owner = tokens.owner[places]
        places = places[known[owner] & (scheme.hot_first[at] < ids[owner])]
        np.add.at(change, places, 1)
        np.add.at(change, places + scheme.size, -1)
    return np.cumsum(change[:-1]) > 0, first


def runs(marked: np.ndarray) -> list[list[int]]:
    """[first, last + 1) of the runs of marked tokens."""
    if not marked.any():
        return []
    return np.flatnonzero(np.diff(np.concatenate(([0], marked.view(np.int8), [0])))).reshape(-1, 2).tolist()
