"""The five logs and a reply table as portable SQL over the driver tables.

The same text runs in Spark and in the SQL oracle. `{lineitem}` and its like stand for
the table: a Parquet path in Spark, a view name in the oracle. See FIXTURES.md.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("lineitem", "orders", "customer", "nation", "region")

_ORDERS = """{orders}
    join {customer} on o_custkey = c_custkey
    join {nation} on c_nationkey = n_nationkey
    join {region} on n_regionkey = r_regionkey"""

_FROM_ORDERS = f"from {_ORDERS}"
# Orders meet their customers first: the largest table then takes part in one join only.
_FROM_LINES = f"from {{lineitem}} join ({_ORDERS}) on l_orderkey = o_orderkey"

_LINE_SESSION = """concat('s', cast(l_orderkey as string), '-', cast(l_linenumber as string), '-',
        cast(l_partkey as string), '-', cast(l_suppkey as string)) as sessionid"""
_ORDER_SESSION = "concat('s', cast(o_orderkey as string)) as sessionid"
_USER = "case when o_custkey % 50 = 0 then '' else cast(o_custkey as string) end as userid"

_LINE_TIME = """1704067200000 + (o_orderkey % 28) * 86400000
        + ((l_orderkey * 7919 + l_partkey * 31 + l_linenumber * 104729) % 86400) * 1000"""
_ORDER_TIME = """1704067200000 + (o_orderkey % 28) * 86400000
        + ((o_orderkey * 7919 + o_custkey * 31) % 86400) * 1000"""


def _place(k: str, p: str, s: str) -> str:
    return f"""concat('2024-01-', lpad(cast(1 + o_orderkey % 28 as string), 2, '0')) as date,
        r_name as province, n_name as city, c_mktsegment as region,
        3 + cast(({p} * 17 + {s} * 29) % 6000 as double) / 100 as latitude,
        73 + cast(({p} * 13 + {s} * 37) % 7000 as double) / 100 as longitude,
        concat('10.0.', cast({k} % 256 as string), '.', cast({p} % 256 as string)) as ip,
        cast(1 + {k} % 3 as int) as client,
        concat('mac-', cast(o_custkey as string)) as mac,
        cast(1 + {p} % 3 as int) as deviceType"""


_LINE_PLACE = _place("l_orderkey", "l_partkey", "l_suppkey")
_ORDER_PLACE = _place("o_orderkey", "o_custkey", "o_orderkey")


def _version(k: str) -> str:
    return f"concat('v', cast(1 + ({k} * 104729 % 10007) % 4 as string)) as version"


_LINE_NET = "cast(1 + l_suppkey % 3 as int) as networkingmannerid, " + _version("l_orderkey")
_ORDER_NET = ("cast(1 + (o_orderkey * 31 % 1009) % 3 as int) as networkingmannerid, "
              + _version("o_orderkey"))
_UNLOCK = "cast(1 + l_linenumber % 2 as int) as unlock"
_BIKE = "cast(l_partkey as string) as bikeid"
_MONEY = """cast(1 + (o_orderkey * 7919 % 10007) % 2 as int) as rechargetype,
        cast(floor(o_totalprice / 1000) as double) as amount"""
_ORDER_HEAD = f"{_ORDER_SESSION}, cast(o_orderkey as string) as orderid, {_USER}"

VIEWS = {
    # `timestamp` stays a long here; washing turns it into a timestamp.
    "lock": f"""select {_LINE_SESSION}, {_USER}, {_BIKE}, {_LINE_TIME} as timestamp,
        {_LINE_PLACE}, {_UNLOCK}, {_LINE_NET}
    {_FROM_LINES}""",
    "unlock": f"""select {_LINE_SESSION}, {_USER}, {_BIKE}, {_LINE_TIME} as btimestamp,
        {_LINE_TIME} + cast(l_quantity as bigint) * 60000 as etimestamp,
        {_LINE_PLACE}, {_UNLOCK}, {_LINE_NET}, l_quantity * 60 as distance
    {_FROM_LINES}""",
    "order": f"""select {_ORDER_HEAD}, {_ORDER_TIME} as timestamp,
        {_ORDER_PLACE}, {_ORDER_NET}, {_MONEY}
    {_FROM_ORDERS}""",
    "recharge": f"""select {_ORDER_HEAD}, {_ORDER_TIME} as timestamp,
        {_ORDER_PLACE}, {_ORDER_NET}, {_MONEY},
        cast(1 + (o_orderkey * 17 % 997) % 3 as int) as rechargesource
    {_FROM_ORDERS}""",
    "repair": f"""select {_LINE_SESSION}, {_USER}, {_BIKE}, {_LINE_TIME} as timestamp,
        {_LINE_PLACE}, {_LINE_NET}, cast(1 + l_linenumber % 4 as int) as repairtype
    {_FROM_LINES}""",
}

POINTS = """select distinct latitude, longitude from ({unlock})
    where latitude > 3 and latitude < 54 and longitude > 73 and longitude < 136"""

# Replies to a lookup of every distinct point: some name no district, some only a
# point of interest.
REPLIES = """select latitude, longitude,
        concat('renderReverse&&renderReverse({"status":0,"result":{"business":"',
            case when k % 10 = 0 then ''
                 when k % 3 = 0 then concat('d', cast(k % 40 as string), ',d', cast(k % 7 as string))
                 else concat('d', cast(k % 40 as string)) end,
            '","pois":[',
            case when k % 20 = 0 then ''
                 else concat('{"tag":"poi', cast(k % 5 as string), '"}') end,
            ']}})') as reply
    from (select latitude, longitude,
            cast(round(latitude * 100) as bigint) + cast(round(longitude * 100) as bigint) as k
          from ({points}))"""


def _fill(sql: str, names: dict[str, str]) -> str:
    for key, value in names.items():
        sql = sql.replace("{" + key + "}", value)
    return sql


def sql_for(view: str, tables: dict[str, str] | None = None) -> str:
    """SQL of a view ('unlock', …, 'points' or 'replies') over the given table names."""
    tables = tables or {name: name for name in TABLES}
    if view in VIEWS:
        return _fill(VIEWS[view], tables)
    if view == "points":
        return _fill(POINTS, {"unlock": sql_for("unlock", tables)})
    if view == "replies":
        return _fill(REPLIES, {"points": sql_for("points", tables)})
    raise KeyError(view)


def load(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    tables = {name: f"parquet.`{sf_dir}/{name}.parquet`" for name in TABLES}
    return spark.sql(sql_for(view, tables))


def replies_to(spark: SparkSession, points: DataFrame) -> DataFrame:
    """The reply table for stored points."""
    view = f"points_{uuid.uuid4().hex}"
    points.createTempView(view)
    return spark.sql(_fill(REPLIES, {"points": f"select * from {view}"}))


def raw_lines(log_df: DataFrame) -> DataFrame:
    """The log as raw JSON lines: column `value`, with coordinates nested in `location`."""
    fields = [F.col(c) for c in log_df.columns if c not in ("latitude", "longitude")]
    place = F.struct("latitude", "longitude").alias("location")
    return log_df.select(F.to_json(F.struct(*fields, place)).alias("value"))


# How a rough line differs from a plain one, by remainder: 1 quotes its numbers, 2 has a
# blank instead of the client, 3 has its fields in another order and no device type.
ROUGHNESS = 4
ROUGH_KIND = "(length(sessionid) + client * 3 + deviceType * 7) % 4"


def rough_lines(log_df: DataFrame) -> DataFrame:
    """The log as raw lines of different manners, which washing must read alike."""
    kind = F.expr(ROUGH_KIND)
    numbers = [c for c, t in log_df.dtypes if t != "string"]
    flat = [c for c in log_df.columns if c not in ("latitude", "longitude")]

    def line(names: list[str], change: dict) -> Column:
        place = F.struct(*[change.get(c, F.col(c)).alias(c) for c in ("latitude", "longitude")])
        return F.to_json(F.struct(*[change.get(c, F.col(c)).alias(c) for c in names], place.alias("location")))

    quoted = {c: F.col(c).cast("string") for c in numbers}
    reordered = [c for c in reversed(flat) if c != "deviceType"]
    return log_df.select(
        F.when(kind == 1, line(flat, quoted))
        .when(kind == 2, line(flat, {"client": F.lit("")}))
        .when(kind == 3, line(reordered, {}))
        .otherwise(line(flat, {})).alias("value")
    )


# Faults that `damaged_lines` plants, by remainder of the ride's begin second. The upper
# half of the remainders stays good, and so does one kind with a quoted number.
FAULTS = 22


def damaged_lines(unlock: DataFrame) -> DataFrame:
    """Raw ride lines with their key in `line_id`, ten in twenty-two of them damaged."""
    place = F.struct("latitude", "longitude").alias("location")
    fields = [F.col(c) for c in unlock.columns if c not in ("latitude", "longitude")]
    lines = unlock.select(
        F.col("sessionid").alias("line_id"),
        F.pmod(F.call_function("div", F.col("btimestamp"), F.lit(1000)), F.lit(FAULTS)).alias("kind"),
        F.to_json(F.struct(*fields, place)).alias("value"),
    )
    text = F.col("value")
    damaged = (
        F.when(F.col("kind") == 0, F.expr("left(value, length(value) - 5)"))
        .when(F.col("kind") == 1, F.replace(text, F.lit('"location":'), F.lit('"place":')))
        .when(F.col("kind") == 2, F.regexp_replace(text, r'"client":\d+', '"client":"x"'))
        .when(F.col("kind") == 3, F.regexp_replace(text, r'"btimestamp":\d+', '"btimestamp":"soon"'))
        .when(F.col("kind") == 4, F.regexp_replace(text, r'"client":(\d+)', '"client":"$1"'))
        .when(F.col("kind") == 5, F.regexp_replace(text, r'"latitude":[0-9.]+', '"latitude":"north"'))
        .when(F.col("kind") == 6, F.regexp_replace(text, r'"distance":[0-9.]+', '"distance":"NaN"'))
        .when(F.col("kind") == 7, F.regexp_replace(text, r'"btimestamp":\d+', '"btimestamp":9223372036854775807'))
        .when(F.col("kind") == 8, F.concat(text, F.lit(" junk")))
        .when(F.col("kind") == 9, F.concat(text, text))
        .when(F.col("kind") == 10, F.regexp_replace(text, r'"etimestamp":\d+', '"etimestamp":-99999999999999999'))
        .otherwise(text)
    )
    return lines.select("line_id", damaged.alias("value"))


def addresses(unlock: DataFrame) -> DataFrame:
    """The rides with addresses of many forms in `ip`, by remainder of the begin second."""
    kind = F.pmod(F.call_function("div", F.col("btimestamp"), F.lit(1000)), F.lit(8))
    forms = (
        F.when(kind == 1, F.concat("ip", F.lit(":8080")))
        .when(kind == 2, F.concat(F.lit(" "), "ip", F.lit(" ")))
        .when(kind == 3, F.concat(F.lit("fe80::"), F.col("client").cast("string")))
        .when(kind == 4, F.concat(F.lit("2001:db8:7:"), F.col("client").cast("string"), F.lit("::9")))
        .when(kind == 5, "::1")
        .when(kind == 6, F.concat(F.lit("host-"), "ip"))
        .when(kind == 7, "")
        .otherwise(F.col("ip"))
    )
    return unlock.withColumn("ip", forms)
