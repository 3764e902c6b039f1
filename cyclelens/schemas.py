"""The five log schemas and the business code lists.

`lock` is the log written when a lock opens; `unlock` is written when a ride is
completed, and is the only log with begin/end times and a distance.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, TS = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.TimestampType(),
)

# Column names, order and types of the stored logs.
_PLACE_AND_DEVICE = [
    ("date", S), ("province", S), ("city", S), ("region", S),
    ("latitude", D), ("longitude", D), ("ip", S), ("client", I),
    ("mac", S), ("deviceType", I),
]
_BIKE_HEAD = [("sessionid", S), ("userid", S), ("bikeid", S)]
_ORDER_HEAD = [("sessionid", S), ("orderid", S), ("userid", S), ("timestamp", L)]
_NET = [("networkingmannerid", I), ("version", S)]
_MONEY = [("rechargetype", I), ("amount", D)]

_COLUMNS = {
    "lock": [*_BIKE_HEAD, ("timestamp", TS), *_PLACE_AND_DEVICE, ("unlock", I), *_NET],
    "unlock": [*_BIKE_HEAD, ("btimestamp", L), ("etimestamp", L), *_PLACE_AND_DEVICE,
               ("unlock", I), *_NET, ("distance", D)],
    "order": [*_ORDER_HEAD, *_PLACE_AND_DEVICE, *_NET, *_MONEY],
    "recharge": [*_ORDER_HEAD, *_PLACE_AND_DEVICE, *_NET, *_MONEY, ("rechargesource", I)],
    "repair": [*_BIKE_HEAD, ("timestamp", L), *_PLACE_AND_DEVICE, *_NET, ("repairtype", I)],
}

LOGS = tuple(_COLUMNS)

# Column holding the event time in epoch milliseconds, per log.
EVENT_TIME = {"lock": "timestamp", "unlock": "btimestamp", "order": "timestamp",
              "recharge": "timestamp", "repair": "timestamp"}

# Columns that hold epoch milliseconds in raw lines.
EPOCHS = ("timestamp", "btimestamp", "etimestamp")

# Tag text per code. An unknown or null code carries no tag.
CLIENT_TAGS = {1: "LNiphone", 2: "LNandroid", 3: "LN小程序"}
DEVICE_TAGS = {1: "LCiphone", 2: "LCandroid", 3: "LCwp"}
NETWORK_TAGS = {1: "LFwifi", 2: "LF4G", 3: "LF3G"}
UNLOCK_TAGS = {1: "LS扫码", 2: "LS蓝牙"}
SHORT_TRIP, MEDIUM_TRIP, LONG_TRIP = "LA短程", "LA中程", "LA长程"
DISTRICT_PREFIX = "BS"

# Payment codes.
DEPOSIT, TOP_UP = 1, 2


def schema_of(log: str) -> T.StructType:
    if log not in _COLUMNS:
        raise ValueError(f"unknown log {log!r}; expected one of {', '.join(LOGS)}")
    return T.StructType([T.StructField(name, dtype) for name, dtype in _COLUMNS[log]])
