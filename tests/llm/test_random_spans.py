"""The method's spans of the secret scan against the battery written out in plain Python."""

import math
import random
import re

from pyspark.sql import functions as F

from cyclelens.llm import entries, secrets_scan
from tests.llm.test_llm_queries import brute_base

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"
ALPHABETS = {
    "hex": DIGITS + "abcdef", "dashed": DIGITS + "abcdef", "base32": LETTERS + "234567",
    "lower32": LETTERS.lower() + "234567", "lower36": LETTERS.lower() + DIGITS, "upper36": LETTERS.lower() + DIGITS,
    "base62": LETTERS + LETTERS.lower() + DIGITS, "base64": LETTERS + LETTERS.lower() + DIGITS + "+/",
}


def encoding(token):
    digit, lower, upper = (bool(re.search(f"[{c}]", token)) for c in ("0-9", "a-z", "A-Z"))
    for name, pattern, fits in (
        ("hex", "[0-9a-f]+|[0-9A-F]+", digit and (lower or upper)), ("base32", "[A-Z2-7]+=*", digit and upper),
        ("dashed", "[0-9a-f-]+|[0-9A-F-]+", digit and (lower or upper)), ("lower32", "[a-z2-7]+=*", digit and lower),
        ("lower36", "[a-z0-9]+", digit and lower), ("upper36", "[A-Z0-9]+", digit and upper),
        ("base62", "[A-Za-z0-9]+", digit and lower and upper), ("base64", ".*", digit and lower and upper),
    ):
        if fits and re.fullmatch(pattern, token):
            return name
    return None


def above(z):
    z = max(-8.0, min(8.0, z))
    return 1 / (1 + math.exp(1.5976 * z + 0.07056 * z**3))


def p_value(token, name):
    alphabet = ALPHABETS[name]
    size = len(alphabet)
    plain = token.lower() if name in ("hex", "dashed", "lower36", "upper36") else token.replace("-", "+").replace("_", "/")
    if name == "dashed":
        plain = token.lower()
    x = [alphabet.index(c) for c in plain if c in alphabet]
    n = len(x)
    cells = [0] * 8
    for v in x:
        cells[v * 8 // size] += 1
    expected = [n * sum(v * 8 // size == c for v in range(size)) / size for c in range(8)]
    chi = sum((a - b) ** 2 / b for a, b in zip(cells, expected))
    spread = 2 / 63
    tests = [above(((chi / 7) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))]
    high = [v >= size / 2 for v in x]
    ones = sum(high)
    mean = 2 * ones * (n - ones) / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
    tests.append(min(1.0, 2 * above(abs(runs - mean) / math.sqrt(variance))) if 0 < ones < n and variance > 0 else 0.0)
    middle = sum(x) / n
    power = sum((v - middle) ** 2 for v in x)
    product = sum((a - middle) * (b - middle) for a, b in zip(x, x[1:]))
    tests.append(min(1.0, 2 * above(abs((product / power + 1 / n) * math.sqrt(n)))) if power > 0 else 0.0)
    one_case = name in ("lower32", "lower36", "upper36")
    if one_case:
        q = (size - 26) / size
        change, both = 2 * q * (1 - q), q * (1 - q)
        changes = sum((a >= 26) != (b >= 26) for a, b in zip(x, x[1:]))
        tests.append(above(((n - 1) * change - changes) / math.sqrt(
            (n - 1) * change * (1 - change) + 2 * (n - 2) * (both - change * change))))
    half = -sum(math.log(max(1e-15, p)) for p in tests)
    return math.exp(-half) * (1 + half + half**2 / 2 + (half**3 / 6 if one_case else 0))


def brute_spans(texts):
    found, seen = {}, {}
    for i, text in texts.items():
        found[i] = []
        for m in re.finditer(r"[A-Za-z0-9+/_-]{20,}={0,2}", text):
            name = encoding(m[0])
            if name:
                group = (name, sum(len(m[0]) >= at for at in (32, 48, 64)))
                p = p_value(m[0], name)
                found[i].append((m.start(), m.end(), group, p))
                seen.setdefault(group, {})[m[0]] = p
    limits = {}
    for group, tokens in seen.items():
        bins = [0] * 20
        for p in tokens.values():
            bins[int(min(p, 0.999999) * 20)] += 1
        even = 2 * sum(bins[10:])
        limits[group] = next((at / 20 for at in range(11) if sum(bins[at:]) and even * (1 - at / 20) >= 0.95 * sum(bins[at:])), 2.0)
    out = {}
    for i, text in texts.items():
        base = brute_base(text)
        more = [(a, 3, b) for a, b, group, p in found[i] if p >= limits[group] and not any(s <= a and e >= b for s, _, e in base)]
        out[i] = ",".join(f"{secrets_scan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(base + more))
    return out


def test_spans_of_the_method_in_documents(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r.doc_id: r.spans for r in entries.secrets(spark, folder).collect()}
    assert got == brute_spans(texts)


def test_spans_of_the_method_among_made_tokens(spark):
    rng = random.Random(3)
    kinds = [LETTERS + LETTERS.lower() + DIGITS, LETTERS.lower() + DIGITS, LETTERS + "234567", DIGITS + "ABCDEF", "0123456789abcdef-"]
    texts = {}
    for i in range(240):
        drawn = "".join(rng.choice(kinds[i % 5]) for _ in range(rng.choice((24, 40, 70))))
        plain = f"Some{'Word' * rng.randint(3, 12)}{i}"
        texts[i] = f"é before {drawn} between {plain} and {drawn if i % 7 == 0 else 'x'} token={drawn[:8] if i % 11 == 0 else 'a'}"
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.row_id: r.shown for r in secrets_scan.scan(df).select("row_id", secrets_scan.span_text(F.col("spans")).alias("shown")).collect()}
    want = brute_spans(texts)
    assert got == want
    assert sum("random" in s for s in want.values()) > 100
