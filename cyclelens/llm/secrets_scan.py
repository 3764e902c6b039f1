"""Secret scan with a battery of randomness tests, with DataFrame functions only.

Base spans come from three patterns. The method adds spans of kind `random`: long tokens
whose characters look drawn at random from the alphabet of the encoding they seem to be
in (hex, also with dashes as in UUIDs, base32 and base36 in either case, base62, base64). Three tests give a p-value each under randomness: chi-
squared uniformity over eight equal cells of the alphabet, runs above and below its
middle, and serial correlation of neighbours. Fisher's method combines them.

Which combined p-values count as random is decided for each encoding and length class
over the whole table: random tokens have even p-values, structured ones pile up near
zero, so the upper half of the histogram shows how many random tokens there are, and the
cutoff is the lowest at which the estimated share of structured tokens among the accepted
ones stays within `FALSE_SHARE`. Short tokens, which structure hides in, thus face a
stricter cutoff than long ones. The histogram counts distinct tokens (by a 64-bit hash),
so copies of one token do not decide about others; copies are merged before the shuffle.
The cutoffs travel as constants.

Offsets are code points, end exclusive. A null text counts as empty. A random span inside
a base span is not repeated. Repeated rows get equal answers; null ids are carried along;
an empty table gives an empty result. Only the named columns are read by `scan`;
`redact` replaces the text column and keeps all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclelens.llm.native import indices, let
from cyclelens.session import written

# The base patterns, their least lengths and the order of the kinds.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
MIN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the same matches as AKIA[A-Z0-9]+ of 20 characters or more
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
LENGTH_CLASSES = (32, 48, 64)
CELLS = 8
BINS = 20
FALSE_SHARE = 0.05

_SPAN = "array<struct<start:int,rank:int,end:int>>"
_TOKEN = "array<struct<start:int,end:int,token:string>>"


def _pieces(text: Column, pattern: str, value_group: int) -> Column:
    """The text as pieces (gap, match): each has its length, its gap's length and the
    match or a group of it. The last piece ends at the end of the text."""
    whole = F.lit(rf"(?s)(.*?)(?:{pattern}|\z)")
    parts = [F.regexp_extract_all(text, whole, F.lit(g)) for g in (0, 1, value_group)]
    sized = F.zip_with(parts[0], parts[1], lambda all_, gap: F.struct(F.length(all_).alias("size"), F.length(gap).alias("gap")))
    return F.zip_with(sized, parts[2], lambda s, v: F.struct(s["size"].alias("size"), s["gap"].alias("gap"), v.alias("value")))


def _fold(pieces: Column, kept: str, make, keep) -> Column:
    """The spans of the pieces that `keep` accepts."""
    none = F.array().cast(kept)

    def step(done: Column, piece: Column) -> Column:
        end = done["at"] + piece["size"]
        span = make(done["at"] + piece["gap"], end, piece["value"])
        found = (piece["size"] > piece["gap"]) & keep(piece["value"])
        return F.struct(
            end.alias("at"), F.when(found, F.concat(done["found"], F.array(span))).otherwise(done["found"]).alias("found"),
        )

    first = F.struct(F.lit(0).alias("at"), none.alias("found"))
    return F.aggregate(pieces, first, step, lambda done: done["found"])


def _spans(text: Column, pattern: str, rank: int, guard: str, value_group: int, keep) -> Column:
    def make(start: Column, end: Column, value: Column) -> Column:
        return F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"))

    found = _fold(_pieces(text, pattern, value_group), _SPAN, make, keep)
    return F.when(text.rlike(guard), found).otherwise(F.array().cast(_SPAN))


def base_spans(text: Column) -> Column:
    """The spans of the three patterns by start and kind."""
    assign = f"(?i:{ASSIGN})"
    return F.array_sort(F.concat(
        _spans(text, assign, 0, assign, 3, lambda value: F.length(value) >= MIN_VALUE),
        _spans(text, ACCESS, 1, ACCESS, 0, lambda value: F.lit(True)),
        _spans(text, HEX, 2, HEX, 0, lambda value: F.lit(True)),
    ))


def _tokens(text: Column) -> Column:
    def make(start: Column, end: Column, value: Column) -> Column:
        return F.struct(start.alias("start"), end.alias("end"), value.alias("token"))

    found = _fold(_pieces(text, f"({CANDIDATE})", 2), _TOKEN, make, lambda value: F.lit(True))
    return F.when(text.rlike(CANDIDATE), found).otherwise(F.array().cast(_TOKEN))


def _encoding(token: Column) -> Column:
    """The encoding a token seems to be in; null for what is no encoding, such as words.
    Letters of one case are one only with digits among them; then they have classes of
    their own, whose cutoffs keep words with digits out."""
    digit, lower, upper = (token.rlike(f"[{c}]") for c in ("0-9", "a-z", "A-Z"))
    return (
        F.when(token.rlike("^([0-9a-f]+|[0-9A-F]+)$") & digit & (lower | upper), "hex")
        .when(token.rlike("^[A-Z2-7]+=*$") & digit & upper, "base32")
        .when(token.rlike("^([0-9a-f-]+|[0-9A-F-]+)$") & digit & (lower | upper), "dashed")
        .when(token.rlike("^[a-z2-7]+=*$") & digit & lower, "lower32")
        .when(token.rlike("^[a-z0-9]+$") & digit & lower, "lower36")
        .when(token.rlike("^[A-Z0-9]+$") & digit & upper, "upper36")
        .when(token.rlike("^[A-Za-z0-9]+$") & digit & lower & upper, "base62")
        .when(digit & lower & upper, "base64")
    )


# The alphabets in the order of their digits.
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": _LETTERS + "234567",
    "lower32": _LETTERS.lower() + "234567",
    "base36": _LETTERS.lower() + "0123456789",
    "base62": _LETTERS + _LETTERS.lower() + "0123456789",
    "base64": _LETTERS + _LETTERS.lower() + "0123456789+/",
}
# The encodings that are written in each alphabet.
_WRITTEN_IN = {
    "hex": ("hex", "dashed"), "base32": ("base32",), "lower32": ("lower32",),
    "base36": ("lower36", "upper36"), "base62": ("base62",), "base64": ("base64",),
}


def _digits(token: Column, encoding: str) -> Column:
    """The token's characters as digits of its alphabet; padding is left out, and so are
    the dashes of hex."""
    plain = F.lower(token) if encoding in ("hex", "base36") else F.translate(token, "-_", "+/")
    places = F.transform(F.split(plain, ""), lambda c: F.when(c != "", F.position(c, F.lit(_ALPHABETS[encoding])) - 1))
    return F.filter(places, lambda x: x >= 0)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _above(z: Column) -> Column:
    """Upper tail of the normal distribution, by a logistic approximation (to 0.0002)."""
    near = F.greatest(F.lit(-8.0), F.least(F.lit(8.0), z))
    return let(near, lambda z: 1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z)))


def _by_size(size: Column, values: dict[int, float | list[float]]) -> Column:
    """The constant for an alphabet's size."""
    chosen = None
    for at, value in values.items():
        chosen = F.when(size == at, F.lit(value)) if chosen is None else chosen.when(size == at, F.lit(value))
    return chosen


def _uniformity(digits: Column, n: Column, size: Column) -> Column:
    """p of chi-squared over eight cells (cube-root approximation of its tail)."""
    counts = F.transform(
        F.sequence(F.lit(0), F.lit(CELLS - 1)),
        lambda cell: F.size(F.filter(digits, lambda x: F.floor(x * CELLS / size) == cell)).cast("double"),
    )
    # Cells of an alphabet whose size eight does not divide expect unequal shares.
    shares = _by_size(size, {
        k: [len([x for x in range(k) if x * CELLS // k == c]) / k for c in range(CELLS)] for k in _SIZES
    })
    parts = let(shares, lambda of: F.transform(counts, lambda c, i: let(
        n * F.get(of, i), lambda expected: (c - expected) * (c - expected) / expected
    )))
    freedom, spread = CELLS - 1, 2 / (9 * (CELLS - 1))
    return _above((F.pow(_total(parts) / freedom, F.lit(1 / 3)) - (1 - spread)) / spread**0.5)


def _runs(digits: Column, n: Column, size: Column) -> Column:
    """Two-sided p of the number of runs above and below the middle of the alphabet."""

    def of(high: Column) -> Column:
        changes = F.size(F.filter(indices(F.size(high) - 1), lambda i: F.get(high, i) != F.get(high, i + 1)))

        def against(mean: Column) -> Column:
            return let((mean - 1) * (mean - 2) / (n - 1), lambda spread: F.when(
                spread > 0, F.least(F.lit(1.0), 2 * _above(F.abs(changes + 1 - mean) / F.sqrt(spread)))
            ).otherwise(0.0))

        return let(F.size(F.filter(high, lambda h: h)).cast("double"), lambda ones: F.when(
            (ones > 0) & (ones < n), let(2 * ones * (n - ones) / n + 1, against)
        ).otherwise(0.0))

    return let(F.transform(digits, lambda x: x >= size / 2), of)


def _serial(digits: Column, n: Column) -> Column:
    """Two-sided p of the correlation of neighbours."""

    def of(off: Column) -> Column:
        product = _total(F.transform(indices(F.size(off) - 1), lambda i: F.get(off, i) * F.get(off, i + 1)))
        return let(_total(F.transform(off, lambda x: x * x)), lambda power: F.when(
            power > 0, F.least(F.lit(1.0), 2 * _above(F.abs((product / power + 1 / n) * F.sqrt(n))))
        ).otherwise(0.0))

    mean = _total(F.transform(digits, lambda x: x.cast("double"))) / n
    return let(mean, lambda m: let(F.transform(digits, lambda x: x - m), of))


# Alphabets of letters of one case, which words with digits are written in too.
_ONE_CASE = ("lower32", "base36")
_SIZES = sorted({len(letters) for letters in _ALPHABETS.values()})


def _mixing(digits: Column, n: Column, size: Column) -> Column:
    """One-sided p of the number of changes between letters and digits, which come last in
    the alphabet. Words with a number behind them have few."""
    shares = {k: (k - 26) / k for k in sorted(len(_ALPHABETS[name]) for name in _ONE_CASE)}
    change, both = {k: 2 * q * (1 - q) for k, q in shares.items()}, {k: q * (1 - q) for k, q in shares.items()}
    stays, after = {k: 1 - c for k, c in change.items()}, {k: both[k] - c * c for k, c in change.items()}
    changes = F.size(F.filter(
        indices(F.size(digits) - 1), lambda i: (F.get(digits, i) >= 26) != (F.get(digits, i + 1) >= 26)
    ))
    return let((n - 1) * _by_size(size, change), lambda expected: _above(
        (expected - changes) / F.sqrt(expected * _by_size(size, stays) + 2 * (n - 2) * _by_size(size, after))
    ))


def _battery(digits: Column, size: Column, one_case: Column) -> Column:
    """Combined p of the tests on the digits of an alphabet of that size.

    One expression serves all alphabets, and what a test uses more than once is bound: each
    task builds the expressions anew, so with a copy for every alphabet and use that took
    more time and memory than the texts, the more partitions the more."""

    def of(digits: Column, n: Column) -> Column:
        tests = [_uniformity(digits, n, size), _runs(digits, n, size), _serial(digits, n)]
        three = sum(F.log(F.greatest(F.lit(1e-15), p)) for p in tests)
        fourth = F.log(F.greatest(F.lit(1e-15), _mixing(digits, n, size)))
        half = let(three, lambda x: -F.when(one_case, x + fourth).otherwise(x))
        more = lambda x: F.when(one_case, x * x * x / 6).otherwise(0.0)
        return let(half, lambda x: F.exp(-x) * (1 + x + x * x / 2 + more(x)))

    return let(digits, lambda d: let(F.size(d).cast("double"), lambda n: of(d, n)))


def randomness(token: Column, encoding: str) -> Column:
    """Combined p of the tests: even for random tokens, near zero for structure. Letters
    of one case have a fourth test, of how digits mix with them."""
    size = F.lit(len(_ALPHABETS[encoding]))
    return _battery(_digits(token, encoding), size, F.lit(encoding in _ONE_CASE))


def _randomness_in(token: Column, encoding: Column) -> Column:
    """`randomness` in the encoding that a column names; null for none."""
    digits = size = F.lit(None)
    for name, letters in _ALPHABETS.items():
        fits = encoding.isin(*_WRITTEN_IN[name])
        digits = F.when(fits, _digits(token, name)).otherwise(digits)
        size = F.when(fits, F.lit(len(letters))).otherwise(size)
    one_case = encoding.isin(*[written for name in _ONE_CASE for written in _WRITTEN_IN[name]])
    return F.when(encoding.isNotNull(), let(size, lambda s: _battery(digits, s, one_case)))


def _candidates(text: Column) -> Column:
    """The tokens in an encoding: start, end, class of encoding and length, p and a hash."""

    def judged(token: Column) -> Column:
        length = token["end"] - token["start"]
        class_no = sum((length >= at).cast("int") for at in LENGTH_CLASSES)

        def of(encoding: Column) -> Column:
            return F.struct(
                token["start"].alias("start"), token["end"].alias("end"),
                F.concat_ws("-", encoding, class_no.cast("string")).alias("class"),
                _randomness_in(token["token"], encoding).alias("p"),
                F.xxhash64(token["token"]).alias("hash"),
            )

        return let(_encoding(token["token"]), of)

    return let(_tokens(text), lambda t: F.filter(F.transform(t, judged), lambda c: c["p"].isNotNull()))


def cutoffs(scanned: DataFrame) -> dict[str, float]:
    """Class -> the least p that counts as random there."""
    at = F.floor(F.least(F.col("c.p"), F.lit(0.999999)) * BINS)
    every = scanned.select(F.explode("candidates").alias("c")).select("c.class", "c.hash", at.alias("bin"))
    found = every.groupBy("class", "hash").agg(F.min("bin").alias("bin"))  # a token once
    counts: dict[str, list[int]] = {}
    for name, at, n in found.groupBy("class", "bin").count().collect():  # at most 32 x BINS rows
        counts.setdefault(name, [0] * BINS)[at] = n
    return {name: cutoff(bins) for name, bins in counts.items()}


def cutoff(bins: list[int], false_share: float = FALSE_SHARE) -> float:
    """The lowest bin border above which at most `false_share` of the tokens are expected
    to be structured; above 1, so that none passes, if no token looks random."""
    random = 2 * sum(bins[BINS // 2 :])
    for at in range(BINS // 2 + 1):
        kept = sum(bins[at:])
        if kept and random * (1 - at / BINS) >= (1 - false_share) * kept:
            return at / BINS
    return 2.0


def with_findings(df: DataFrame, text: Column) -> DataFrame:
    """`df` with `base` and `candidates`."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    both = let(text, lambda t: F.struct(base_spans(t).alias("base"), _candidates(t).alias("candidates")))
    return df.select("*", both.alias("found")).select(*df.columns, "found.base", "found.candidates")


def all_spans(limits: dict[str, float]) -> Column:
    """Base spans and the candidates beyond their class's cutoff, by start and kind."""
    least = F.create_map(*[F.lit(x) for pair in sorted(limits.items()) for x in pair]) if limits else None
    if least is None:
        return F.col("base")

    def accepted(c: Column) -> Column:
        inside = F.exists("base", lambda b: (b["start"] <= c["start"]) & (b["end"] >= c["end"]))
        return (c["p"] >= F.element_at(least, c["class"])) & ~inside

    extra = F.transform(
        F.filter("candidates", accepted),
        lambda c: F.struct(c["start"].alias("start"), F.lit(KINDS.index("random")).alias("rank"), c["end"].alias("end")),
    )
    return F.array_sort(F.concat("base", extra))


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"])), ",")


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`row_id`, `base` and `spans` (arrays of start, rank of the kind, end)."""
    rows = df.select(F.col(id_col).alias("row_id"), F.col(text_col).alias("text"))
    found = written(with_findings(rows, F.col("text")).drop("text"), "secret-findings")
    return found.select("row_id", "base", all_spans(cutoffs(found)).alias("spans"))


def redact(df: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """`df` with every secret in the text column replaced by a mark.

    The findings are made twice: once for the cutoffs, once beside the text, which is
    cheaper than shuffling the texts to meet their findings."""
    texts = df.select(F.col(text_col).alias("text"))
    limits = cutoffs(with_findings(texts, F.col("text")))
    names = {name: f"kept {i}" for i, name in enumerate(df.columns)}  # no clash with ours
    inner = df.select(*[F.col(f"`{name}`").alias(new) for name, new in names.items()])
    held = F.col(f"`{names[text_col]}`").cast("string")
    spans = with_findings(inner, held).withColumn("spans", all_spans(limits))

    def step(done: Column, s: Column) -> Column:
        gap = F.substring(held, done["at"] + 1, F.greatest(s["start"] - done["at"], F.lit(0)))
        more = F.when(s["end"] <= done["at"], done["text"]).when(
            s["start"] < done["at"], done["text"]
        ).otherwise(F.concat(done["text"], gap, F.lit(mark)))
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), more.alias("text"))

    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))
    cut = F.aggregate("spans", first, step, lambda d: F.concat(d["text"], F.substring(held, d["at"] + 1, F.length(held))))
    clean = F.when(F.size("spans") > 0, cut).otherwise(held)
    return spans.select(*[
        (clean if name == text_col else F.col(f"`{new}`")).alias(name) for name, new in names.items()
    ])
