"""Cutoffs of the secret scan where tokens are copied."""

import random
import string

from pyspark.sql import functions as F

from cyclelens.llm import secrets_scan

BASE62 = string.ascii_uppercase + string.ascii_lowercase + string.digits


def tokens(alphabet, length, n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(length)) for _ in range(n)]


def found(spark, texts):
    """The tokens that the scan finds as `random`."""
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kind = secrets_scan.KINDS.index("random")
    return {texts[r.row_id][s.start : s.end] for r in secrets_scan.scan(df).collect() for s in r.spans if s["rank"] == kind}


def judged(spark, some, encoding):
    df = spark.createDataFrame([(t,) for t in some], "t string")
    return {r.t: r.p for r in df.select("t", secrets_scan.randomness(F.col("t"), encoding).alias("p")).collect()}


def test_copies_of_a_token_do_not_move_the_cutoff(spark):
    some = [t for t in tokens(BASE62, 30, 300, 5) if any(c.isdigit() for c in t)]
    p = judged(spark, some, "base62")
    low = min((t for t in some if p[t] >= 0.3), key=p.get)
    assert p[low] < 0.35
    alone = found(spark, some)
    assert low in alone and len(alone) > 0.9 * len(some)
    assert found(spark, [*some, *[f"x {low} y"] * 3000]) == alone


def test_copies_of_a_structured_token_let_none_through(spark):
    flat = ["ab1CD" * 6 + f"{i:03d}" for i in range(200)]
    p = judged(spark, tokens(BASE62, 33, 50, 6), "base62")
    lucky = max(p, key=p.get)
    assert p[lucky] > 0.5
    assert not found(spark, [*flat, *[lucky] * 3000]) & set(flat)


def test_tokens_of_one_case(spark):
    lower, upper = string.ascii_lowercase, string.ascii_uppercase
    keys = {
        "lower36": tokens(lower + string.digits, 40, 80, 1),
        "upper36": ["ASIA" + t for t in tokens(upper + string.digits, 36, 80, 2)],
        "lower32": tokens(lower + "234567", 32, 80, 3),
        "dashed": ["-".join((t[:8], t[8:12], t[12:16], t[16:20], t[20:])) for t in tokens("0123456789abcdef", 32, 80, 4)],
    }
    rng = random.Random(5)
    words = ["".join(rng.choice(("chapter", "section", "edition", "appendix")) for _ in range(4)) + str(i) for i in range(80)]
    words += [w.upper() for w in words] + [f"part-{i}-of-the-old-book" for i in range(80)] + ["internationalisation"]
    got = found(spark, [t for group in keys.values() for t in group] + words)
    for name, group in keys.items():
        assert len(got & set(group)) > 0.8 * len(group), name
    assert len(got & set(words)) <= 0.05 * len(got)  # the scan's FALSE_SHARE
