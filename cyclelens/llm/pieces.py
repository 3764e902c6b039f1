"""SentencePiece encoding and decoding with the `tokenizers` library as the backend.

The model file is parsed as a protobuf and rebuilt: normaliser (character map, space
handling), the metaspace marker with its dummy prefix, the pieces with their scores
(unigram model) or the merges their scores imply (BPE model), and byte fallback.

Where no piece holds the space marker behind another character, no merge and no best path
crosses a place where a word begins. Then a text is encoded as its words: words are hashed
many at a time, each distinct word is sent to the library once for each worker while a
bounded memo holds its ids, in batches that the library spreads over threads, and the ids of
a text are put together from the memo. With other models whole texts are encoded. Parity
with the `sentencepiece` library is verified on every word (or text) that is encoded, and so
is decoding by the library.

The ids of every row are decoded, from a table of the bytes that each id stands for, and
compared with the text. A row that does not come back (an unknown character, or two words
of one hash) is encoded anew as a whole and by itself.

One narrow stage, no shuffle. The model is read once by the driver (its size is checked)
and travels with the tasks. A null text has null ids and a null decoded text; an empty
text has no ids. Repeated rows get equal answers; null ids are carried along. Only the
named columns are read, so further columns of any name do no harm.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as pb
from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

from cyclelens.llm.batches import id_and_text, output_schema, text_groups
from cyclelens.llm.hashing import SpanHasher

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MAX_MODEL_BYTES = 64 << 20
THREADS = 2  # of each library, in each task
GROUP_BYTES = 1 << 19  # of texts encoded at once
MEMO_WORDS = 500_000  # a worker forgets its words when it holds more

_TOGETHER = 2048  # new words sent to the library as one text

# Fixed values of the model format: the space marker, model kinds and piece kinds.
MARKER = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, USER_DEFINED, BYTE = 1, 4, 6


def read_model(path: str = MODEL) -> bytes:
    """The model file, read where the driver runs."""
    with open(path, "rb") as file:
        data = file.read(MAX_MODEL_BYTES + 1)
    if len(data) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MAX_MODEL_BYTES} bytes")
    return data


def _merges(model: pb.ModelProto, ids: dict[str, int]) -> list[tuple[str, str]]:
    """The merges of a BPE model: every way to put a piece together from two others, the
    best-scored piece first."""
    normal = [(-p.score, i, p.piece) for i, p in enumerate(model.pieces) if p.type == NORMAL]
    merges = []
    for _, _, piece in sorted(normal):
        halves = [(piece[:k], piece[k:]) for k in range(1, len(piece))]
        merges += sorted(
            (pair for pair in halves if pair[0] in ids and pair[1] in ids),
            key=lambda pair: (ids[pair[0]], ids[pair[1]]),
        )
    return merges


def _normaliser(model: pb.ModelProto) -> normalizers.Normalizer:
    spec = model.normalizer_spec
    steps = [normalizers.Precompiled(spec.precompiled_charsmap)] if spec.precompiled_charsmap else []
    if spec.remove_extra_whitespaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if spec.add_dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    return normalizers.Sequence([*steps, normalizers.Replace(" ", MARKER)])


def build(data: bytes) -> tuple[Tokenizer, pb.ModelProto]:
    """The model as a tokenizer that expects normalised text."""
    model = pb.ModelProto.FromString(data)
    kind, spec = model.trainer_spec.model_type, model.trainer_spec
    if spec.treat_whitespace_as_suffix or not model.normalizer_spec.escape_whitespaces:
        raise ValueError("only models that mark spaces as a prefix can be rebuilt")
    if any(p.type == USER_DEFINED for p in model.pieces):
        raise ValueError("models with user-defined pieces cannot be rebuilt")
    ids = {p.piece: i for i, p in enumerate(model.pieces)}
    if kind == BPE:
        unknown = model.pieces[spec.unk_id].piece
        core = models.BPE(vocab=ids, merges=_merges(model, ids), unk_token=unknown,
                          fuse_unk=True, byte_fallback=spec.byte_fallback)
    elif kind == UNIGRAM:
        scores = [(p.piece, p.score) for p in model.pieces]
        core = models.Unigram(scores, spec.unk_id, spec.byte_fallback)
    else:
        raise ValueError(f"model kind {kind} cannot be rebuilt")
    tokenizer = Tokenizer(core)
    tokenizer.decoder = decoders.Sequence([
        decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse(),
        *([decoders.Strip(" ", 1, 0)] if model.normalizer_spec.add_dummy_prefix else []),
    ])
    return tokenizer, model


def _gathered(values: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The runs of `count` values from each `first`, end to end."""
    ends = np.cumsum(count)
    at = np.repeat(first - (ends - count), count)
    at += np.arange(len(at))
    return values[at]


class Memo:
    """Ids of units that were encoded, by the hash of the unit."""

    def __init__(self) -> None:
        self.slots: dict[int, int] = {}
        self.ids, self.count = np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.parity = np.zeros(0, bool)
        self.first = np.zeros(0, np.int64)

    def add(self, hashes: list[int], ids: np.ndarray, count: np.ndarray, parity: np.ndarray) -> None:
        self.slots.update(zip(hashes, range(len(self.count), len(self.count) + len(hashes))))
        self.first = np.concatenate((self.first, len(self.ids) + np.cumsum(count) - count))
        self.ids = np.concatenate((self.ids, ids))
        self.count = np.concatenate((self.count, count))
        self.parity = np.concatenate((self.parity, parity))


@dataclass
class Encoded:
    """Results for several texts; `ends` are the bounds of their ids, `decoded` is UTF-8."""

    ids: np.ndarray
    ends: np.ndarray
    parity: np.ndarray
    round_trip: np.ndarray
    decoded: list[bytes]


@dataclass
class Codec:
    """Encoder and decoder of one worker, with the other library beside it."""

    data: bytes

    def __post_init__(self) -> None:
        self.tokenizer, model = build(self.data)
        self.splitter = Tokenizer(self.tokenizer.model)
        self.splitter.pre_tokenizer = pre_tokenizers.Metaspace(MARKER, "never", split=True)
        self.other = sentencepiece.SentencePieceProcessor(model_proto=self.data)
        self.by_word = not any(MARKER in p.piece.lstrip(MARKER) for p in model.pieces if p.type == NORMAL)
        spec = model.normalizer_spec
        self.plain = not spec.precompiled_charsmap and not spec.remove_extra_whitespaces
        self.prefix = " " if spec.add_dummy_prefix else ""
        self.normaliser = _normaliser(model)
        self.hasher, self.memo = SpanHasher(), Memo()
        pieces = [
            bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else p.piece.replace(MARKER, " ").encode()
            for p in model.pieces
        ]
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.piece_count = np.array([len(p) for p in pieces], np.int64)
        self.piece_first = np.cumsum(self.piece_count) - self.piece_count

    def normalise(self, text: str) -> str:
        """The normalised text, with plain spaces for the marker."""
        if not text:
            return text
        if self.plain:
            return self.prefix + text.replace(MARKER, " ")
        return self.normaliser.normalize_str(text).replace(MARKER, " ")

    def _other_ids(self, units: list[str]) -> list[list[int]]:
        """Ids by the other library, which adds the dummy prefix by itself."""
        if not self.prefix:
            return self.other.encode(units, num_threads=THREADS)
        # It cannot be asked for a unit without the space, or for the space alone: such a
        # unit is encoded behind a line break, which is taken away again.
        odd = [not u.startswith(self.prefix) or u == self.prefix for u in units]
        ids = self.other.encode(["\n" + u if o else u.removeprefix(self.prefix) for u, o in zip(units, odd)], num_threads=THREADS)
        behind = len(self.other.encode("\n")) if any(odd) else 0
        return [x[behind:] if o else x for x, o in zip(ids, odd)]

    def _library(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of units end to end, their number for each unit, and whether both
        libraries agree on them and the library decodes them to what the pieces say."""
        ids, count, back = self._joined(units) if self.by_word and self.prefix else self._singly(units)
        other = self._other_ids(units)
        theirs = np.fromiter(map(len, other), np.int64, len(other))
        if (theirs == count).all() and (np.fromiter(chain.from_iterable(other), np.int32) == ids).all():
            return ids, count, back
        ends = np.cumsum(count).tolist()
        mine = [ids[e - n : e].tolist() for e, n in zip(ends, count.tolist())]
        return ids, count, back & np.array([x == y for x, y in zip(mine, other)], bool)

    def _singly(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, numbers of ids and correct decoding of units that are encoded one by one."""
        marked = [u.replace(" ", MARKER) for u in units]
        mine = [e.ids for e in self.tokenizer.encode_batch_fast(marked, add_special_tokens=False)]
        count = np.fromiter(map(len, mine), np.int64, len(mine))
        ids = np.fromiter(chain.from_iterable(mine), np.int32)
        made, ends = self._bytes(ids, np.concatenate(([0], np.cumsum(count))))
        back = [self.prefix + text if x else text for text, x in zip(self.decode(mine), mine)]
        parts = [made[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        return ids, count, np.array([x.encode() == y for x, y in zip(back, parts)], bool)

    def _joined(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As `_singly`, for words, which the library splits by itself: many are sent as one
        text, and the bytes of the pieces tell where each word's ids end."""
        odd = [u[1:2] in ("", " ") or u[0] != " " for u in units]
        plain = [u for u, o in zip(units, odd) if not o]
        runs = [plain[i : i + _TOGETHER] for i in range(0, len(plain), _TOGETHER)]
        encoded = self.splitter.encode_batch_fast(["".join(run).replace(" ", MARKER) for run in runs], add_special_tokens=False)
        found = [e.ids for e in encoded]
        parts = []
        for run, ids, back in zip(runs, found, self.decode(found)):
            ids, text = np.array(ids, np.int32), "".join(run)
            ends = np.cumsum([len(u.encode()) for u in run])
            reached = np.cumsum(self.piece_count[ids])
            at = np.searchsorted(reached, ends)
            if len(ids) and at[-1] < len(reached) and (reached[at] == ends).all() and self.prefix + back == text:
                parts.append((ids, np.diff(at, prepend=-1), np.ones(len(run), bool)))
            else:
                parts.append(self._singly(run))
        if len(plain) < len(units):
            parts.append(self._singly([u for u, o in zip(units, odd) if o]))
        ids, count, back = (np.concatenate(x) for x in zip(*parts))
        # The odd ones come last; bring all back into the order of the units.
        place = np.argsort(np.concatenate((np.flatnonzero(~np.array(odd)), np.flatnonzero(odd))))
        first = (np.cumsum(count) - count)[place]
        return _gathered(ids, first, count[place]), count[place], back[place]

    def _bytes(self, ids: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes that ids stand for, and the bounds of those of each text, given the
        bounds of their ids."""
        count = self.piece_count[ids]
        made = _gathered(self.piece_bytes, self.piece_first[ids], count)
        return made.tobytes(), np.concatenate(([0], np.cumsum(count)))[ends]

    def _shown(self, decoded: bytes) -> bytes:
        """Decoded bytes without the dummy prefix."""
        return decoded.removeprefix(self.prefix.encode())

    def _units(self, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where units begin, in texts laid end to end that begin at `first`."""
        begins = np.zeros(len(codes) + 1, bool)
        begins[first] = True
        if self.by_word:
            space = codes == 32
            begins[0] |= len(codes) > 0
            begins[1:-1] |= space[1:] & ~space[:-1]
        return np.flatnonzero(begins[:-1])

    def encode(self, texts: list[str]) -> Encoded:
        if len(self.memo.count) > MEMO_WORDS:
            self.memo = Memo()
        normal = [self.normalise(text).encode() for text in texts]
        joined = b"".join(normal)
        codes = np.frombuffer(joined, np.uint8)
        bounds = np.cumsum([0, *map(len, normal)])
        starts = self._units(codes, bounds[:-1])
        ends = np.append(starts[1:], len(codes))[: len(starts)]
        hashes, at, unit = np.unique(self.hasher.hashes(codes, starts, ends), return_index=True, return_inverse=True)
        known = list(map(self.memo.slots.get, hashes.tolist()))
        new = [k for k, slot in enumerate(known) if slot is None]
        if new:
            where = at[new]
            units = [joined[a:b].decode() for a, b in zip(starts[where].tolist(), ends[where].tolist())]
            names = hashes[new].tolist()
            self.memo.add(names, *self._library(units))
            for k, name in zip(new, names):
                known[k] = self.memo.slots[name]
        slot = np.array(known, np.int64)[unit]
        count = self.memo.count[slot]
        ids = _gathered(self.memo.ids, self.memo.first[slot], count)
        # Which unit each text begins with, and with that its part of the ids.
        first_unit = np.searchsorted(starts, bounds)
        id_ends = np.concatenate(([0], np.cumsum(count)))[first_unit]
        parity = np.ones(len(texts), bool)
        if not self.memo.parity.all():
            broken = np.concatenate(([0], np.cumsum(~self.memo.parity[slot])))[first_unit]
            parity = broken[1:] == broken[:-1]
        back, made_ends = self._bytes(ids, id_ends)
        decoded = [back[a:b] for a, b in zip(made_ends[:-1].tolist(), made_ends[1:].tolist())]
        same = [True] * len(texts) if back == joined and (made_ends == bounds).all() else [x == y for x, y in zip(decoded, normal)]
        if not all(same):
            ids, id_ends = self._again(texts, normal, same, ids, id_ends, parity, decoded)
        faithful = [
            ok and (not self.plain or MARKER not in text) for ok, text in zip(same, texts)
        ]
        return Encoded(ids, id_ends, parity, np.array(faithful, bool), [self._shown(d) for d in decoded])

    def _again(self, texts, normal, same, ids, id_ends, parity, decoded) -> tuple[np.ndarray, np.ndarray]:
        """Encode the texts that did not come back as a whole, each by itself."""
        parts = [ids[a:b] for a, b in zip(id_ends[:-1].tolist(), id_ends[1:].tolist())]
        for k in np.flatnonzero(~np.array(same)).tolist():
            mine = self.tokenizer.encode(normal[k].decode().replace(" ", MARKER), add_special_tokens=False).ids
            parity[k] = mine == self.other.encode(texts[k])
            parts[k] = np.array(mine, np.int32)
            decoded[k] = self.decode([mine])[0].encode()
            same[k] = decoded[k] == self._shown(normal[k])
            decoded[k] = self.prefix.encode() + decoded[k]
        return np.concatenate([*parts, np.zeros(0, np.int32)]), np.cumsum([0, *map(len, parts)])

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)


def _encoder(data: bytes, with_decoded: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["RAYON_NUM_THREADS"] = str(THREADS)  # read when the library first runs
        codec = Codec(data)
        for rows, texts in text_groups(batches, GROUP_BYTES):
            nothing = pa.array([t is None for t in texts])
            done = codec.encode([(text or b"").decode() for text in texts])
            columns = {
                "row_id": rows.column("row_id"),
                "ids": pa.ListArray.from_arrays(pa.array(done.ends.astype(np.int32)), pa.array(done.ids), mask=nothing),
                "round_trip": pa.array(done.round_trip), "parity": pa.array(done.parity),
            }
            if with_decoded:
                shown = [None if t is None else d.decode("utf-8", "replace") for d, t in zip(done.decoded, texts)]
                columns["decoded"] = pa.array(shown, pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return encode


def encode(df: DataFrame, data: bytes, id_col: str = "doc_id", text_col: str = "text",
           with_decoded: bool = True) -> DataFrame:
    """`row_id`, `ids`, `round_trip` (decoding gives the text, or what the normaliser made
    of it), `parity` (the other library has the same ids) and, on request, `decoded`."""
    schema = output_schema(df, id_col, "ids array<int>, round_trip boolean, parity boolean" + ", decoded string" * with_decoded)
    return id_and_text(df, id_col, text_col).mapInArrow(_encoder(data, with_decoded), schema)


def _decoder(data: bytes):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(data)
        for rows in batches:
            lists = rows.column("ids").to_pylist()
            texts = codec.decode([[i for i in ids or [] if i is not None] for ids in lists])
            yield pa.RecordBatch.from_pydict({
                "row_id": rows.column("row_id"),
                "text": pa.array([None if x is None else t for x, t in zip(lists, texts)], pa.string()),
            })

    return decode


def decode(df: DataFrame, data: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """`row_id` and `text` from lists of ids."""
    lists = df.selectExpr(f"`{id_col}` as row_id", f"cast(`{ids_col}` as array<int>) as ids")
    return lists.mapInArrow(_decoder(data), output_schema(df, id_col, "text string"))
