"""The secret scan's expressions, which every task builds anew, stay few."""

from pyspark.sql import functions as F

from cyclelens.llm import secrets_scan


def parts_of(df, most):
    """The number of expressions in the plan's projection; counting stops beyond `most`."""
    found, left = 0, [df._jdf.queryExecution().analyzed().expressions()]
    while left and found <= most:
        some = left.pop()
        for i in range(some.size()):
            found += 1
            left.append(some.apply(i).children())
    return found


def test_findings_have_one_battery_for_all_alphabets(spark):
    texts = spark.createDataFrame([("token = Ab3dE5gH1jK2lMn0PqRs7uVw",)], "text string")
    assert parts_of(texts.select(secrets_scan.randomness(F.col("text"), "base36")), 900) < 900
    assert parts_of(texts.select(secrets_scan._candidates(F.col("text"))), 2000) < 2000


def test_p_in_a_named_encoding(spark):
    tokens = {
        "hex": "9f86d081884c7d659a2feaa0c55ad015", "dashed": "3f2b8c1e-9a47-4d06-b5e1-7c20f8d3a964",
        "base32": "KR2GK43UNFXGOIDTORZGS3TH", "lower32": "kr2gk43unfxgoidtorzgs3th", "lower36": "k8f0z1x9w3q7v5m2b4n6",
        "upper36": "K8F0Z1X9W3Q7V5M2B4N6", "base62": "Ab3dE5gH1jK2lMn0PqRs7uVw", "base64": "Ab3d+5gH1jK/lMn0PqRs7uVw==",
    }
    alphabet = {written: name for name, all_ in secrets_scan._WRITTEN_IN.items() for written in all_}
    df = spark.createDataFrame([*((t, e, alphabet[e]) for e, t in tokens.items()), ("plainwords", None, None)], "t string, e string, a string")
    alone = {
        r.t: r.p for name in secrets_scan._ALPHABETS
        for r in df.where(F.col("a") == name).select("t", secrets_scan.randomness(F.col("t"), name).alias("p")).collect()
    }
    both = df.select("t", secrets_scan._encoding(F.col("t")).alias("seen"), "e", secrets_scan._randomness_in(F.col("t"), F.col("e")).alias("p")).collect()
    assert {r.t: r.p for r in both} == alone | {"plainwords": None}
    assert all(r.seen == r.e for r in both)
