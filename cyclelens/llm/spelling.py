"""Spelling variants: words of a corpus that differ by one letter, grouped by frequency.

Words are runs of Latin letters, lower-cased in A-Z. Two words are near if one inserted,
deleted or replaced code point turns one into the other. The form of a word is its most
frequent near word, if that is at least `ratio` times as frequent; following forms to the
last gives the root.

Near words are searched in a trie of frequency vectors. The letters form groups, and a word
is a path of letter counts, group by group. One edit adds at most one letter to a group and
takes at most one from a group, so two tries are walked together, depth first, with a budget
of one surplus and one deficit letter; words of leaves that meet are compared letter by
letter.

The trie of all words is cut into cells, subtrees of a bounded number of words, from counts
that Spark takes by prefix. Each word goes to its own cell, and as a question to all later
cells that its budget reaches, so a pair of words meets once. A cell that no further letter
group divides (words of equal vectors) is dealt into blocks, so no task holds more than
about `cell_words` words of a cell. The list of cells, about twelve for each `cell_words`
words, is what the driver sees.

A null text has no words. A null id counts as an empty one where `drop_every` looks at it.
Repeated rows count as often as they occur. An empty table, or one whose words are too short
or too rare, gives no row. Only the named columns are read, so further columns of any name
do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclelens.llm.anchors import sorted_runs
from cyclelens.session import written

LEAST_LETTERS, LEAST_COUNT, RATIO = 7, 2, 10
DROP_EVERY = 31
CELL_WORDS = 20_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Letters by how common they are: the first group of each dozen, the second, … A letter
# that is not listed is in the group of its code point.
_COMMON = "etaoinshrdlucmfwypvbgkjqxz"
GROUPS = 12
_AT_ONCE, _PAIRS = 1 << 18, 1 << 17
_PADDED = 64  # words up to this length are compared as rows of a matrix

_GROUP_OF = np.arange(256) % GROUPS
for _i, _letter in enumerate(_COMMON):
    _GROUP_OF[ord(_letter)] = _i % GROUPS


def typed_words(df: DataFrame, id_col: str, text_col: str, least: int = LEAST_LETTERS,
                drop_every: int | None = DROP_EVERY) -> DataFrame:
    """Every occurrence of a long enough word, as `word`. With `drop_every`, an occurrence
    whose hash it divides loses one letter: a made typing error."""
    run = F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(f"[A-Za-zÀ-ÿ]{{{least},}}"), F.lit(0))
    runs = df.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("document"), F.explode(run).alias("run"))
    plain = runs.select("document", F.translate("run", UPPER, LOWER).alias("run"))
    if drop_every is None:
        return plain.select(F.col("run").alias("word"))
    hashed = plain.withColumn("hash", F.crc32(F.concat("document", F.lit(":"), "run")))
    at = (F.col("hash") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("hash") % drop_every == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= least)


def word_counts(words: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """`word` and `n`."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def vectors_of(words: list[bytes]) -> np.ndarray:
    """Letter counts by group, a row for each word (Latin-1)."""
    letters = np.frombuffer(b"".join(words), np.uint8)
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    cells = np.bincount(owner * GROUPS + _GROUP_OF[letters], minlength=len(words) * GROUPS)
    return cells.reshape(len(words), GROUPS)


_END = -9  # stands behind the last count of a path that ends early


class Trie:
    """Paths of counts in sorted order; nodes of a level are runs of equal prefixes."""

    def __init__(self, paths: np.ndarray) -> None:
        self.order = np.lexsort(paths.T[::-1])
        paths = paths[self.order]
        self.size, self.depth = paths.shape
        differs = np.logical_or.accumulate(paths[1:] != paths[:-1], axis=1)
        self.stride = int(paths.max(initial=0)) + 4
        self.first: list[np.ndarray] = []  # by level: the first row of each node
        self.value: list[np.ndarray] = []
        self.keys: list[np.ndarray] = []  # parent and value, increasing
        self.children: list[np.ndarray] = []  # of each node of the level above, where they begin
        above = np.zeros(1, np.int64)
        for level in range(self.depth):
            first = np.concatenate(([0], np.flatnonzero(differs[:, level]) + 1))
            parent = np.searchsorted(above, first, side="right") - 1
            self.first.append(first)
            self.value.append(paths[first, level])
            self.keys.append(parent * self.stride + np.maximum(paths[first, level], -2) + 2)
            self.children.append(np.append(np.searchsorted(first, above), len(first)))
            above = first
        # Whether a path is complete at a node: no count follows.
        self.ends = [
            np.ones(len(f), bool) if g + 1 == self.depth else paths[f, g + 1] == _END
            for g, f in enumerate(self.first)
        ]

    def rows(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and number of rows of some nodes."""
        ends = np.append(self.first[level][1:], self.size)
        return self.first[level][nodes], ends[nodes] - self.first[level][nodes]


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts (2, 3): owners 0 0 1 1 1 and places 0 1 0 1 2."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def walk(asked: Trie, known: Trie) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of `asked` and of `known` whose paths differ by at most one surplus and one
    deficit letter as far as the known path goes, and how much of the budget was spent."""
    if not asked.size or not known.size:
        return
    start = np.zeros(1, np.int64)
    stack = [(0, start, start, np.zeros(1, np.int8), np.zeros(1, np.int8))]
    while stack:
        level, a, k, surplus, deficit = stack.pop()
        begin = asked.children[level][a]
        owner, place = _spread(asked.children[level][a + 1] - begin)
        a, k, surplus, deficit = begin[owner] + place, k[owner], surplus[owner], deficit[owner]
        count, keys = asked.value[level][a], known.keys[level]
        found = []
        for step in (-1, 0, 1):
            may = np.flatnonzero(surplus == 0 if step > 0 else deficit == 0) if step else np.arange(len(a))
            want = k[may] * known.stride + count[may] + step + 2
            # A count beyond the known ones would be read as another parent's.
            at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            hit = (keys[at] == want) & (count[may] + step >= 0) & (count[may] + step + 2 < known.stride)
            may = may[hit]
            found.append((a[may], at[hit], surplus[may] + np.int8(step > 0), deficit[may] + np.int8(step < 0)))
        a, k, surplus, deficit = (np.concatenate(x) for x in zip(*found))
        over = known.ends[level][k]
        for i in range(0, int(over.sum()), _AT_ONCE):
            some = np.flatnonzero(over)[i : i + _AT_ONCE]
            yield from _met(asked, known, level, a[some], k[some], surplus[some] + deficit[some])
        going = np.flatnonzero(~over)
        for i in range(0, len(going), _AT_ONCE):
            some = going[i : i + _AT_ONCE]
            stack.append((level + 1, a[some], k[some], surplus[some], deficit[some]))


def _met(asked: Trie, known: Trie, level: int, a: np.ndarray, k: np.ndarray, spent: np.ndarray):
    """All rows below pairs of nodes, in pieces of bounded size."""
    a_first, a_rows = asked.rows(level, a)
    k_first, k_rows = known.rows(level, k)
    each = a_rows * k_rows
    # Large pairs of nodes by themselves, the others together.
    for i in np.flatnonzero(each > _PAIRS).tolist():
        step = max(1, _PAIRS // int(k_rows[i]))
        for j in range(0, int(a_rows[i]), step):
            mine = np.arange(a_first[i] + j, a_first[i] + min(j + step, int(a_rows[i])))
            for h in range(0, int(k_rows[i]), _PAIRS):
                theirs = np.arange(k_first[i] + h, k_first[i] + min(h + _PAIRS, int(k_rows[i])))
                left, right = np.repeat(mine, len(theirs)), np.tile(theirs, len(mine))
                yield asked.order[left], known.order[right], np.full(len(left), spent[i])
        each[i] = 0
    total = np.cumsum(each)
    begin = 0
    while begin < len(each):
        end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + _PAIRS, side="right")))
        owner, place = _spread(each[begin:end])
        if len(owner):
            owner += begin
            left = a_first[owner] + place // k_rows[owner]
            right = k_first[owner] + place % k_rows[owner]
            yield asked.order[left], known.order[right], spent[owner]
        begin = end


def _one_edit(a: bytes, b: bytes) -> bool:
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1 or a == b:
        return False
    low, high = 0, len(b)
    while low < high:  # length of the common prefix
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return a[low + 1 :] == b[low + (len(a) == len(b)) :]


class Words:
    """Words laid out for comparing many pairs at once."""

    def __init__(self, words: list[bytes]) -> None:
        self.words = words
        self.length = np.array([len(w) for w in words], np.int64)
        width = int(min(self.length.max(initial=0), _PADDED)) + 1
        short = [w if len(w) <= _PADDED else b"" for w in words]
        self.letters = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in short), np.uint8).reshape(len(words), width)

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs differ by exactly one inserted, deleted or replaced letter."""
        longer = np.where(self.length[a] >= self.length[b], a, b)
        shorter = a + b - longer
        gap = self.length[longer] - self.length[shorter]
        fits = gap <= 1
        long = fits & (self.length[longer] > _PADDED)
        same = np.flatnonzero(fits & ~long & (gap == 0))
        fits[same] = (self.letters[a[same]] != self.letters[b[same]]).sum(axis=1) == 1
        one = np.flatnonzero(fits & ~long & (gap == 1))
        if len(one):
            x, y = self.letters[longer[one]], self.letters[shorter[one]]
            first = (x != y).argmax(axis=1)
            shifted = (x[:, 1:] != y[:, :-1])[:, ::-1]
            last = np.where(shifted.any(axis=1), shifted.shape[1] - 1 - shifted.argmax(axis=1), -1)
            fits[one] = last < first
        for i in np.flatnonzero(long).tolist():
            fits[i] = _one_edit(self.words[a[i]], self.words[b[i]])
        return fits


@dataclass
class Cells:
    """Subtrees of the trie of all words: their paths, and blocks of those too large."""

    paths: list[tuple[int, ...]]
    blocks: list[int]

    def __post_init__(self) -> None:
        if not self.paths:
            return
        padded = np.full((len(self.paths), GROUPS), _END)
        for i, path in enumerate(self.paths):
            padded[i, : len(path)] = path
        self.trie = Trie(padded)
        self.many = np.array(self.blocks, np.int64)
        # Cells are numbered in the order of their paths, which both words of a pair agree on.
        self.rank = np.empty(len(self.paths), np.int64)
        self.rank[self.trie.order] = np.arange(len(self.paths))
        self.offset = np.empty(len(self.paths), np.int64)
        self.offset[self.trie.order] = np.cumsum(self.many[self.trie.order]) - self.many[self.trie.order]


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefixes of the words' paths with the number of words in this batch, one level in
    one row: a prefix is its counts as bytes of a text."""
    for batch in batches:
        words = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
        vectors = vectors_of(words)
        for level in range(1, GROUPS + 1) if words else ():
            found, n = np.unique(vectors[:, :level], axis=0, return_counts=True)
            paths = [",".join(map(str, row)) for row in found.tolist()]
            yield pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.string()), "words": pa.array(n.astype(np.int64))})


def cut_cells(words: DataFrame, cell_words: int = CELL_WORDS) -> Cells:
    """Cells of at most `cell_words` words: the shortest prefixes that few words share."""
    counted = words.select("word").mapInArrow(_prefixes, "path string, words long").groupBy("path").agg(F.sum("words").alias("words"))
    counted = written(counted.withColumn("parent", F.when(F.contains("path", F.lit(",")), F.regexp_replace("path", ",[0-9]+$", ""))), "spelling-prefixes")
    heavy = counted.where(F.col("words") > cell_words).select(F.col("path").alias("parent"))
    below = counted.join(heavy, "parent", "left_semi").unionByName(counted.where("parent is null"))
    full = F.size(F.split("path", ",")) == GROUPS
    rows = below.where((F.col("words") <= cell_words) | full).select("path", "words").collect()
    paths = [tuple(map(int, r["path"].split(","))) for r in rows]
    return Cells(paths, [-(-r["words"] // cell_words) for r in rows])


_ROUTED = "cell long, own boolean, word string, n long"


def _router(cells: Cells):
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
            if not words:
                continue
            asked = Trie(vectors_of(words))
            place = np.array([hash_of(w) for w in words], np.int64)
            home = np.full(len(words), -1)
            met = [(np.zeros(0, np.int64),) * 2]
            for row, cell, spent in walk(asked, cells.trie):
                home[row[spent == 0]] = cell[spent == 0]
                met.append((row[spent > 0], cell[spent > 0]))
            row, cell = (np.concatenate(x) for x in zip(*met))
            later = cells.rank[cell] > cells.rank[home[row]]
            row, cell = row[later], cell[later]
            # To its own block, and as a question to later blocks of its cell and all
            # blocks of later cells.
            own = place % cells.many[home]
            every, block = _spread(cells.many[cell])
            rest, further = _spread(cells.many[home] - own - 1)
            row = np.concatenate((np.arange(len(words)), row[every], rest))
            at = np.concatenate((cells.offset[home] + own, cells.offset[cell][every] + block, (cells.offset[home] + own + 1)[rest] + further))
            picked = batch.select(["word", "n"]).take(pa.array(row))
            yield pa.RecordBatch.from_pydict({
                "cell": pa.array(at), "own": pa.array(np.arange(len(row)) < len(words)),
                "word": picked.column("word"), "n": picked.column("n"),
            })

    return route


def hash_of(word: bytes) -> int:
    """A hash that does not change from one worker to the next."""
    value = 0
    for letter in word:
        value = (value * 1_000_003 + letter + 1) & 0x7FFFFFFF
    return value


def _finder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of near words in each cell of a partition that is sorted by cell."""
    for table in sorted_runs(batches, "cell"):
        cell = table.column("cell").to_numpy()
        edges = np.concatenate(([0], np.flatnonzero(cell[1:] != cell[:-1]) + 1, [len(cell)]))
        for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
            part = table.slice(begin, end - begin)
            words = [w.encode("latin-1") for w in part.column("word").to_pylist()]
            own = part.column("own").to_numpy()
            mine = np.flatnonzero(own)
            if not len(mine) or len(words) < 2:
                continue
            vectors, letters = vectors_of(words), Words(words)
            found = []
            for a, b, _ in walk(Trie(vectors), Trie(vectors[mine])):
                b = mine[b]
                once = ~own[a] | (a < b)
                a, b = a[once], b[once]
                near = letters.near(a, b)
                found.append((a[near], b[near]))
            a, b = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
            for i in range(0, len(a), _PAIRS):
                left, right = (part.take(pa.array(x[i : i + _PAIRS])).combine_chunks() for x in (a, b))
                yield from pa.table({
                    "a": left.column("word"), "a_n": left.column("n"), "b": right.column("word"), "b_n": right.column("n"),
                }).combine_chunks().to_batches()


def near_pairs(words: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """Every pair of near words once: `a`, `a_n`, `b`, `b_n`."""
    cells = cut_cells(words, cell_words)
    if not cells.paths:
        return words.sparkSession.createDataFrame([], "a string, a_n long, b string, b_n long")
    routed = words.mapInArrow(_router(cells), _ROUTED)
    dealt = routed.repartition("cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(_finder, "a string, a_n long, b string, b_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """`word` and `root` of the words that have a form. A form is `ratio` times as frequent
    as its word, so a chain is no longer than the digits of the largest count."""
    following = forms.select(F.col("word").alias("root"), F.col("form").alias("next"))
    going, ended = forms.select("word", F.col("form").alias("root")), None
    while True:
        met = written(going.join(following, "root", "left"), "spelling-roots")
        arrived = met.where("next is null").select("word", "root")
        ended = arrived if ended is None else ended.unionByName(arrived)
        going = met.where("next is not null").select("word", F.col("next").alias("root"))
        if going.isEmpty():
            return ended


def variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = LEAST_LETTERS,
             least_count: int = LEAST_COUNT, ratio: int = RATIO, drop_every: int | None = DROP_EVERY,
             cell_words: int = CELL_WORDS) -> DataFrame:
    """One row for each word: `word`, `form`, `root`, `n`, `n_near` and `form_n`."""
    words = typed_words(df, id_col, text_col, least_letters, drop_every)
    words = written(word_counts(words, least_count), "spelling-words")
    pairs = near_pairs(words, cell_words)
    pairs = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")),
    )).alias("pair")).select("pair.*")
    # The most frequent near word; of those, the first in the order of code points.
    near = pairs.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    )
    enough = -F.col("best.less") >= ratio * F.col("n")
    judged = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
    ), "spelling-forms")
    roots = _roots(judged.where("form is not null"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
