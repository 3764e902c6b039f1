"""Washing: raw JSON lines to flat, typed, masked rows; bad lines set aside.

A line is set aside when it is not one JSON object and nothing else, has no `location`
object, or holds a value that cannot be read as its column's type: a number must be
finite, an epoch a date of the years 1 to 9999. A missing value is only null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclelens.functions.coerce import to_epoch, to_type, unreadable
from cyclelens.functions.masking import blur_ip, pseudonym
from cyclelens.schemas import EPOCHS, schema_of

REASON = "reject_reason"
_NESTED = ("latitude", "longitude")


def one_object(value: Column, schema: T.StructType) -> Column:
    """An array with the JSON object that a line consists of; its one element is null if
    the line is anything else.

    Read as an array, a line with a second object or trailing text is malformed or has
    two elements. Only what follows a bracket that closes this array early goes unseen, so
    lines with such a bracket are also read as the field of an object. Most lines have no
    bracket at all, which is the cheapest test and comes first."""
    parsed = F.from_json(F.concat(F.lit("["), value, F.lit("]")), T.ArrayType(schema))
    field = T.StructType([T.StructField(n, T.StringType()) for n in ("line", "broken")])
    as_field = F.from_json(
        F.concat(F.lit('{"line":'), value, F.lit("}")), field, {"columnNameOfCorruptRecord": "broken"}
    )
    unclear = F.contains(value, F.lit("]")) & value.rlike(r"\}\s*\]")
    whole = F.startswith(F.trim(value), F.lit("{")) & (~unclear | as_field["broken"].isNull())
    return F.transform(F.array(parsed), lambda p: F.when(whole & (F.size(p) == 1), F.get(p, F.lit(0))))


def _line_schema(log: str) -> T.StructType:
    # Leaves are read as text: a typed leaf would turn the quoted number "2" into null.
    text = [T.StructField(f.name, T.StringType()) for f in schema_of(log) if f.name not in _NESTED]
    place = T.StructType([T.StructField(n, T.StringType()) for n in _NESTED])
    return T.StructType([*text, T.StructField("location", place)])


def _text_of(line: Column, name: str) -> Column:
    return line["location"][name] if name in _NESTED else line[name]


def _typed(line: Column, log: str) -> Column:
    """Struct of a line and of its values in the log's types."""
    values = []
    for field in schema_of(log):
        text = _text_of(line, field.name)
        epoch = field.name in EPOCHS and isinstance(field.dataType, T.LongType)
        value = to_epoch(text) if epoch else to_type(text, field.dataType)
        values.append(value.alias(field.name))
    return F.struct(line.alias("line"), F.struct(*values).alias("typed"))


def _judged(read: Column, log: str) -> Column:
    """Struct of the log's columns and the line's first fault, from what `_typed` made."""
    line, typed = read["line"], read["typed"]
    reason = F.when(line.isNull(), "malformed").when(line["location"].isNull(), "missing_location")
    for field in schema_of(log):
        if not isinstance(field.dataType, T.StringType):
            bad = unreadable(_text_of(line, field.name), typed[field.name])
            reason = reason.when(bad, f"bad_value:{field.name}")
    return F.struct(*[typed[name].alias(name) for name in schema_of(log).names], reason.alias(REASON))


def parse_lines(raw: DataFrame, log: str) -> DataFrame:
    """Every line as typed columns plus `reject_reason`: its first fault, null if good.

    `raw` has the line in `value`; `value` and any other columns (an offset, a file
    name) are kept in front. Parsing happens inside a generator, which takes its functions as
    they are; the conversions follow in a projection, which is compiled and computes a value
    that is named twice once. A second generator keeps filters on the result above both, so
    each line is parsed and converted once.
    """
    clash = sorted(set(raw.columns) & {*schema_of(log).names, REASON})
    if clash:
        raise ValueError(f"raw columns clash with the {log} log: {', '.join(clash)}")
    name = "_" * (1 + max(map(len, raw.columns)))  # no other column's
    kept = [F.col(f"`{c}`") for c in raw.columns]
    lines = raw.select(*kept, F.explode(one_object(F.col("value"), _line_schema(log))).alias(name))
    typed = lines.select(*kept, _typed(F.col(name), log).alias(name))
    return typed.select(*kept, F.inline(F.array(_judged(F.col(name), log))))


def split_valid(raw: DataFrame, log: str) -> tuple[DataFrame, DataFrame]:
    """(good rows in the log's schema, rejects with the raw line and the reason)."""
    lines = parse_lines(raw, log)
    good = lines.where(F.col(REASON).isNull()).select(*schema_of(log).names)
    rejects = lines.where(F.col(REASON).isNotNull()).select(*raw.columns, REASON)
    return good, rejects


def wash(raw: DataFrame, log: str) -> DataFrame:
    """Good rows of raw lines, in the log's schema."""
    return split_valid(raw, log)[0]


def mask(df: DataFrame, salt: str, columns: tuple[str, ...] = ("userid", "ip", "mac")) -> DataFrame:
    """Blur sensitive columns: addresses lose their host part, the rest become salted
    hashes that still join and count the same. Keep the salt secret and stable."""
    blurred = {
        name: blur_ip(F.col(name)) if name == "ip" else pseudonym(F.col(name), salt)
        for name in columns
    }
    return df.withColumns(blurred)
