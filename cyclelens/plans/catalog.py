"""The 33 offline reports. Table and column names are fixed values."""

from __future__ import annotations

from cyclelens.operators.reports import Metric, ReportSpec
from cyclelens.schemas import DEPOSIT, TOP_UP

_IS_DEPOSIT = ("rechargetype", DEPOSIT)
_IS_TOP_UP = ("rechargetype", TOP_UP)


def _rows(name: str = "sum") -> Metric:
    return Metric(name, "count")


def _different(name: str, column: str) -> Metric:
    return Metric(name, "distinct", column)


def _total(name: str, column: str) -> Metric:
    return Metric(name, "sum", column)


def _spec(name, table, log, dims, *metrics, where=None) -> ReportSpec:
    return ReportSpec(name, table, log, tuple(dims.split()), metrics, where)


_RIDES = [
    _spec("day_peo_bike", "dayPeoBike", "unlock", "", _different("usersum", "userid")),
    _spec("hour_peo_bike", "hourPeoBike", "unlock", "hour", _rows()),
    _spec("version_peo_bike", "versionPeoBike", "unlock", "deviceType client version", _rows()),
    _spec("pro_city_area_bike", "ProCityAreaBike", "unlock", "", _rows()),
    _spec("device_area_bike", "DeviceAreaBike", "unlock", "deviceType", _rows()),
    _spec("client_area_bike", "ClientAreaBike", "unlock", "client", _rows()),
    _spec("unlock_area_bike", "UnlockAreaBike", "unlock", "unlock", _rows()),
    _spec("sumbike_area_bike", "SumbikeAreaBike", "unlock", "", _different("sumbike", "bikeid")),
    _spec("network_area_bike", "NetworkAreaBike", "unlock", "networkingmannerid", _rows()),
    _spec("distance_area_bike", "DistanceAreaBike", "unlock", "", _total("sumdistance", "distance")),
]


def _money_reports(log: str, suffix: str, source: str) -> list[ReportSpec]:
    """The ten reports that orders and payments share.

    Payments also split their money reports by `source`, the paying channel.
    """
    label, table = f"peo_{suffix}", f"Peo{suffix.capitalize()}"
    amount = _total("amount", "amount")
    return [
        _spec(f"day_{label}", f"day{table}", log, "", _different("usersum", "userid")),
        _spec(f"hourcash_{label}", f"hourcash{table}", log, f"hour {source}",
              _rows(), amount, where=_IS_DEPOSIT),
        _spec(f"hourrecharge_{label}", f"hourrecharge{table}", log, f"hour {source}",
              _rows(), amount, where=_IS_TOP_UP),
        _spec(f"sum_{label}", f"Sum{table}", log, "", _rows("ordersum")),
        _spec(f"client_{label}", f"client{table}", log, "client", _rows("clientsum")),
        _spec(f"device_{label}", f"device{table}", log, "deviceType", _rows("deviceTypeSum")),
        _spec(f"network_{label}", f"network{table}", log, "networkingmannerid", _rows("networksum")),
        _spec(f"recharge_type_{label}", f"rechargeType{table}", log, "rechargetype",
              _rows("rechargeSum")),
        _spec(f"cash_{label}", f"cash{table}", log, source,
              _rows("cashNum"), amount, where=_IS_DEPOSIT),
        _spec(f"recharge_{label}", f"recharge{table}", log, source,
              _rows("rechargeNum"), amount, where=_IS_TOP_UP),
    ]


_REPAIRS = [
    _spec("area_repair", "AreaRepair", "repair", "", _rows()),
    _spec("hour_repair", "HourRepair", "repair", "hour", _rows()),
    _spec("type_repair", "TypeRepair", "repair", "hour repairtype", _rows()),
]

REPORTS = {
    spec.name: spec
    for spec in [
        *_RIDES,
        *_money_reports("order", "order", ""),
        *_money_reports("recharge", "recharge", "rechargesource"),
        *_REPAIRS,
    ]
}


def reports_of(log: str) -> list[ReportSpec]:
    return [spec for spec in REPORTS.values() if spec.log == log]
