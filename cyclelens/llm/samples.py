"""Bounded samples of labelled rows for fitting a classifier on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclelens.session import written

_STEPS = 1 << 30


def draw(rows: DataFrame, per_label: int, max_labels: int, max_chars: int) -> DataFrame:
    """A sample of rows that have a `label`, a `place` (a hash of the text) and `chars` (its
    length): at most `per_label` distinct texts of each of the `max_labels` most frequent
    labels, and at most `max_chars` characters in all.

    A row is drawn by its place alone, so which rows share an id does not matter, and equal
    texts of one label count once. The bounds hold: the sample is counted where it lies, and
    drawn anew with a smaller share until it fits. Texts that are longer than a hundredth of
    `max_chars` take no part."""
    rows = rows.where((F.col("chars") > 0) & (F.col("chars") <= max_chars // 100) & F.col("label").isNotNull())
    known = rows.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct("place", 0.02).alias("texts")
    ).orderBy(F.desc("n"), "label").limit(max_labels).collect()
    shares = {r["label"]: min(1.0, 0.9 * per_label / max(1, r["texts"])) for r in known}
    factor = 1.0
    while True:
        if not shares:
            return rows.where(F.lit(False))
        limits = F.create_map(*[
            x for label, share in shares.items() for x in (F.lit(label), F.lit(int(share * factor * _STEPS)))
        ])
        drawn = rows.where(F.pmod("place", F.lit(_STEPS)) < F.try_element_at(limits, F.col("label")))
        sample = written(drawn.dropDuplicates(["label", "place"]), "label-sample")
        counts = sample.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars")).collect()
        over = max([r["n"] / per_label for r in counts] + [sum(r["chars"] for r in counts) / max_chars], default=0.0)
        if over <= 1:
            return sample
        factor *= 0.9 / over
