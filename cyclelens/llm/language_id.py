"""Language identification by a small convolutional network over bytes.

Filters of several widths slide over fixed-length windows of the UTF-8 bytes, each filter
keeps its largest response, and a softmax layer turns these into languages. Training is
plain numpy on the driver, on a bounded sample (`SAMPLE_PER_LANGUAGE` distinct texts of each
language, chosen by a hash of the text, at most `WINDOWS_PER_DOCUMENT` windows from each,
spread over the whole text; languages beyond the `MAX_LANGUAGES` most frequent and texts
beyond a hundredth of `MAX_CHARS` are not learned from). Prediction runs over every window of every text in one
narrow stage and averages the windows' probabilities, weighted by their length.

For prediction the byte embedding is folded into each filter, and neighbouring bytes
share one table row, so that a filter of width four costs two table reads per byte.

A null text or one without a letter is `und` with score 0. Null ids are carried along;
rows with a null language are not learned from; an empty table, or one without a labelled
row, gives `und` for every row. Repeated rows get equal answers. Only the named columns
are read, so further columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclelens.llm import samples
from cyclelens.llm.batches import id_and_text, output_schema, small_batches, text_groups

SAMPLE_PER_LANGUAGE = 1000
MAX_LANGUAGES, MAX_CHARS = 1000, 100_000_000  # of the sample
WINDOWS_PER_DOCUMENT = 4
WINDOW = 192
WIDTHS = (2, 3, 4)
FILTERS = 12  # of each width
EMBEDDING = 8
STEPS, BATCH, RATE, SEED = 700, 64, 0.01, 9
UNKNOWN = "und"

_CHUNK = 512  # windows worked on at once


@dataclass
class Network:
    languages: list[str]
    tables: list[tuple[np.ndarray, ...]]  # for each width: rows for a byte pair or a byte
    weights: np.ndarray
    bias: np.ndarray

    def features(self, windows: np.ndarray) -> np.ndarray:
        """Largest response of every filter in each window."""
        pairs = windows[:, :-1].astype(np.uint16) << 8 | windows[:, 1:]
        singles = windows.astype(np.intp)
        out = []
        for width, tables in zip(WIDTHS, self.tables):
            last = windows.shape[1] - width + 1
            total, at = None, 0
            for table in tables:
                source = pairs if len(table) == 1 << 16 else singles
                part = np.take(table, source[:, at : at + last], axis=0)
                total = part if total is None else np.add(total, part, out=total)
                at += 2
            out.append(total.max(axis=1))
        return np.maximum(np.concatenate(out, axis=1), 0)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        parts = [
            _softmax(self.features(windows[i : i + _CHUNK]) @ self.weights + self.bias)
            for i in range(0, len(windows), _CHUNK)
        ]
        return np.concatenate(parts)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows_of(text: bytes, window: int = WINDOW) -> np.ndarray:
    """The text cut into windows; the last one is filled up with zero bytes."""
    n = -(-len(text) // window)
    return np.frombuffer(text.ljust(n * window, b"\0"), dtype=np.uint8).reshape(n, window)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str]) -> Network:
    """Fit the network with Adam; the same input gives the same network."""
    rng = np.random.default_rng(SEED)
    params = {"emb": rng.normal(0, 0.3, (256, EMBEDDING)), "out": rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))), "bias": np.zeros(len(languages))}
    for width in WIDTHS:
        params[f"conv{width}"] = rng.normal(0, 0.3, (width * EMBEDDING, FILTERS))
        params[f"shift{width}"] = np.zeros(FILTERS)
    params = {k: v.astype(np.float32) for k, v in params.items()}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    groups = [np.flatnonzero(labels == k) for k in range(len(languages))]
    for step in range(1, STEPS + 1):
        pick = np.concatenate([rng.choice(g, max(1, BATCH // len(groups))) for g in groups])
        for name, slope in _slopes(params, windows[pick], labels[pick]).items():
            first, second = moments[name]
            first += 0.1 * (slope - first)
            second += 0.001 * (slope * slope - second)
            rate = RATE * (1 - step / (STEPS + 1)) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            params[name] -= (rate * first / (np.sqrt(second) + 1e-8)).astype(np.float32)
    return Network(languages, [_folded(params, w) for w in WIDTHS], params["out"], params["bias"])


def _slopes(params: dict, windows: np.ndarray, labels: np.ndarray) -> dict:
    n, rows = len(windows), np.arange(len(windows))[:, None]
    embedded = params["emb"][windows]
    kept, pooled = [], []
    for width in WIDTHS:
        last = windows.shape[1] - width + 1
        spans = np.concatenate([embedded[:, j : j + last] for j in range(width)], axis=2)
        response = spans @ params[f"conv{width}"] + params[f"shift{width}"]
        at = response.argmax(axis=1)
        best = np.take_along_axis(response, at[:, None, :], axis=1)[:, 0]
        kept.append((spans, at, best))
        pooled.append(np.maximum(best, 0))
    hidden = np.concatenate(pooled, axis=1)
    error = _softmax(hidden @ params["out"] + params["bias"])
    error[np.arange(n), labels] -= 1
    error /= n
    slopes = {"out": hidden.T @ error, "bias": error.sum(axis=0), "emb": np.zeros_like(params["emb"])}
    back = error @ params["out"].T
    for i, (width, (spans, at, best)) in enumerate(zip(WIDTHS, kept)):
        up = back[:, i * FILTERS : (i + 1) * FILTERS] * (best > 0)
        chosen = spans[rows, at]
        slopes[f"conv{width}"] = np.einsum("nfd,nf->df", chosen, up)
        slopes[f"shift{width}"] = up.sum(axis=0)
        down = up[:, :, None] * params[f"conv{width}"].T[None]
        for j in range(width):
            np.add.at(slopes["emb"], windows[rows, at + j], down[:, :, j * EMBEDDING : (j + 1) * EMBEDDING])
    return slopes


def _folded(params: dict, width: int) -> tuple[np.ndarray, ...]:
    conv = params[f"conv{width}"].reshape(width, EMBEDDING, FILTERS)
    by_byte = [params["emb"] @ conv[j] for j in range(width)]
    by_byte[0] = by_byte[0] + params[f"shift{width}"]
    tables = [
        (by_byte[j][:, None] + by_byte[j + 1][None]).reshape(1 << 16, FILTERS)
        for j in range(0, width - 1, 2)
    ]
    return tuple(np.ascontiguousarray(t) for t in [*tables, *([by_byte[-1]] if width % 2 else [])])


def held_out(id_col: str = "doc_id") -> Column:
    """True for the quarter of the documents that is never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def _training_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in text_groups(batches):
        langs, cut = [], []
        for lang, text in zip(rows.column("label").to_pylist(), texts):
            last = max(0, len(text) - WINDOW)
            for k in sorted({last * i // max(1, WINDOWS_PER_DOCUMENT - 1) for i in range(WINDOWS_PER_DOCUMENT)}):
                langs.append(lang)
                cut.append(text[k : k + WINDOW])
        yield pa.RecordBatch.from_pydict({"lang": pa.array(langs, pa.string()), "window": pa.array(cut, pa.binary())})


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = SAMPLE_PER_LANGUAGE, max_languages: int = MAX_LANGUAGES,
        max_chars: int = MAX_CHARS) -> Network | None:
    """The network for a table of labelled texts, or None if it has no labelled text.

    The driver receives at most `per_language` x `WINDOWS_PER_DOCUMENT` windows of each of
    the `max_languages` most frequent languages."""
    text = F.col(text_col).cast("string")
    rows = labelled.select(
        F.col(lang_col).cast("string").alias("label"), F.xxhash64(text).alias("place"),
        F.length(text).alias("chars"), text.alias("text"),
    )
    sample = samples.draw(rows, per_language, max_languages, max_chars)
    small_batches(sample)
    cut = sorted(
        (r["lang"], bytes(r["window"]))
        for r in sample.mapInArrow(_training_windows, "lang string, window binary").collect()
    )
    if not cut:
        return None
    languages = sorted({lang for lang, _ in cut})
    index = {lang: k for k, lang in enumerate(languages)}
    windows = np.concatenate([windows_of(w) for _, w in cut])
    return train(windows, np.array([index[lang] for lang, _ in cut]), languages)


def has_letter(text: str) -> bool:
    """Whether any character is alphabetic; a fraction or a circled digit is not."""
    return any(map(str.isalpha, text))


def _predictor(network: Network | None):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_groups(batches):
            langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            known = [i for i, t in enumerate(texts) if network and t and has_letter(t.decode())]
            if known:
                cut = [windows_of(texts[i]) for i in known]
                lengths = np.concatenate([
                    np.append(np.full(len(w) - 1, WINDOW), len(texts[i]) - WINDOW * (len(w) - 1))
                    for i, w in zip(known, cut)
                ])
                by_window = network.probabilities(np.concatenate(cut)) * lengths[:, None]
                first = np.cumsum([0, *(len(w) for w in cut[:-1])])
                total = np.add.reduceat(by_window, first, axis=0)
                total /= np.add.reduceat(lengths, first)[:, None]
                for i, row in zip(known, total):
                    k = int(row.argmax())
                    langs[i], scores[i] = network.languages[k], min(1.0, float(row[k]))
            yield pa.RecordBatch.from_pydict({
                "row_id": rows.column("row_id"), "lang_pred": pa.array(langs, pa.string()),
                "score": pa.array(scores, pa.float64()),
            })

    return predict


def predict(df: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`row_id`, `lang_pred` and `score` for every row."""
    schema = output_schema(df, id_col, "lang_pred string, score double")
    return id_and_text(df, id_col, text_col).mapInArrow(_predictor(network), schema)
