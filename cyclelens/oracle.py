"""The same results in SQL for an independent engine, written by hand per query."""

from __future__ import annotations

from cyclelens.fixtures import ROUGH_KIND, sql_for
from cyclelens.operators.reports import set_id
from cyclelens.plans.catalog import reports_of

_G3 = "date, province, city"


def _with(views: str, body: str) -> str:
    """`body` behind the named fixture views."""
    ctes = ", ".join(f"{v}_log as ({sql_for(v)})" for v in views.split())
    return f"with {ctes} {body}"


def _hour(epoch: str) -> str:
    return f"cast(({epoch} // 3600000) % 24 as varchar)"


def _date(epoch: str) -> str:
    return f"strftime(epoch_ms({epoch}), '%Y-%m-%d')"


def _grouped(log: str, dims: str, metrics: str, where: str = "") -> str:
    """`dims` are plain columns, or 'hour' for the hour of the log's event time."""
    time = "btimestamp" if log == "unlock" else "timestamp"
    names = [d for d in dims.split() if d]
    keys = ", ".join([_G3, *[_hour(time) if d == "hour" else d for d in names]])
    shown = ", ".join([_G3, *[f'{_hour(time)} as "hour"' if d == "hour" else d for d in names]])
    condition = f"where {where}" if where else ""
    return _with(log, f"select {shown}, {metrics} from {log}_log {condition} group by {keys}")


_N = 'count(*) as "sum"'
_AMOUNT = "sum(amount) as amount"


def _reports() -> dict[str, str]:
    deposit, top_up = "rechargetype = 1", "rechargetype = 2"
    sql = {
        "day_peo_bike": _grouped("unlock", "", "count(distinct userid) as usersum"),
        "hour_peo_bike": _grouped("unlock", "hour", _N),
        "version_peo_bike": _grouped("unlock", "deviceType client version", _N),
        "pro_city_area_bike": _grouped("unlock", "", _N),
        "device_area_bike": _grouped("unlock", "deviceType", _N),
        "client_area_bike": _grouped("unlock", "client", _N),
        "unlock_area_bike": _grouped("unlock", "unlock", _N),
        "sumbike_area_bike": _grouped("unlock", "", "count(distinct bikeid) as sumbike"),
        "network_area_bike": _grouped("unlock", "networkingmannerid", _N),
        "distance_area_bike": _grouped("unlock", "", "sum(distance) as sumdistance"),
        "area_repair": _grouped("repair", "", _N),
        "hour_repair": _grouped("repair", "hour", _N),
        "type_repair": _grouped("repair", "hour repairtype", _N),
    }
    for log, source in (("order", ""), ("recharge", "rechargesource")):
        sql |= {
            f"day_peo_{log}": _grouped(log, "", "count(distinct userid) as usersum"),
            f"hourcash_peo_{log}": _grouped(log, f"hour {source}", f"{_N}, {_AMOUNT}", deposit),
            f"hourrecharge_peo_{log}": _grouped(log, f"hour {source}", f"{_N}, {_AMOUNT}", top_up),
            f"sum_peo_{log}": _grouped(log, "", "count(*) as ordersum"),
            f"client_peo_{log}": _grouped(log, "client", "count(*) as clientsum"),
            f"device_peo_{log}": _grouped(log, "deviceType", "count(*) as deviceTypeSum"),
            f"network_peo_{log}": _grouped(log, "networkingmannerid", "count(*) as networksum"),
            f"recharge_type_peo_{log}": _grouped(log, "rechargetype", "count(*) as rechargeSum"),
            f"cash_peo_{log}": _grouped(log, source, f"count(*) as cashNum, {_AMOUNT}", deposit),
            f"recharge_peo_{log}": _grouped(
                log, source, f"count(*) as rechargeNum, {_AMOUNT}", top_up),
        }
    return sql


def _suites() -> dict[str, str]:
    """Every grouping of a suite by itself, over the keys of all."""
    sql = {}
    for log in ("unlock", "order", "recharge", "repair"):
        specs = [s for s in reports_of(log) if s.additive]
        sets = {}
        for spec in specs:
            extra = [spec.where[0]] if spec.where and spec.where[0] not in spec.keys else []
            sets.setdefault((*spec.keys, *extra), set_id(specs, spec))
        keys = list(dict.fromkeys(k for names in sets for k in names))
        measure = {"unlock": "distance", "repair": None}.get(log, "amount")
        time = "btimestamp" if log == "unlock" else "timestamp"
        total = f", sum({measure}) as sum_{measure}" if measure else ""
        rows = f'(select * replace ({_hour(time)} as "hour") from (select *, 0 as "hour" from {log}_log))'
        sql[f"report_suite_{log}"] = _with(log, " union all ".join(
            "select " + ", ".join(f'"{k}"' if k in names else f'null as "{k}"' for k in keys)
            + f", cast({number} as bigint) as set_id, count(*) as n{total} from {rows} group by "
            + ", ".join(f'"{k}"' for k in names)
            for names, number in sets.items()
        ))
    return sql


def _distinct_users() -> dict[str, str]:
    """Users of more than one day, and all ride reports as one table."""
    ten = []
    for spec in reports_of("unlock"):
        dims = [_hour("btimestamp") if d == "hour" else f'cast("{d}" as varchar)' for d in spec.dims]
        shown = f"concat_ws('|', {', '.join(dims)})" if dims else "''"
        metric = spec.metrics[0]
        value = {"count": "count(*)", "distinct": f"count(distinct {metric.column})", "sum": f"sum({metric.column})"}[metric.kind]
        ten.append(f"select '{spec.name}' as report, {_G3}, {shown} as dims, cast({value} as double) as value "
                   f"from unlock_log group by {_G3}, {shown}")
    return {
        "all_ride_reports": _with("unlock", " union all ".join(ten)),
        "month_peo_bike": _with("unlock", """select province, city, count(distinct userid) as usersum
            from unlock_log group by province, city"""),
        "returning_peo_bike": _with("unlock", """select province, city, count(*) as usersum from (
            select province, city, userid from unlock_log where date < '2024-01-15'
            intersect select province, city, userid from unlock_log where date >= '2024-01-15')
            group by province, city"""),
    }


def _live() -> dict[str, str]:
    """Live rollups as the batch form of the same grouping."""
    hours = "sum(etimestamp - btimestamp) / 3600000.0"
    ride = f'count(*) as total, sum(distance) as distance, cast({hours} as double) as "time"'
    money = f"count(*) as total, {_AMOUNT}"

    def rollup(log: str, dims: str, metrics: str) -> str:
        time = "btimestamp" if log == "unlock" else "timestamp"
        made = {"date": _date(time), "hour": _hour(time)}
        names = dims.split()
        keys = ", ".join(made.get(d, d) for d in names)
        shown = ", ".join(f'{made[d]} as "{d}"' if d in made else d for d in names)
        # Grouping by position keeps the made date apart from the log's own `date`.
        positions = ", ".join(str(i + 1) for i in range(len(names)))
        assert keys
        return _with(log, f"select {shown}, {metrics} from {log}_log group by {positions}")

    sql = {
        "live_ride_total": rollup("unlock", "date", ride),
        "live_ride_hour": rollup("unlock", "date hour", ride),
        "live_ride_area": rollup("unlock", "date province city", ride),
        "live_recharge_source": rollup("recharge", "date rechargesource", money),
        "live_repair_area": rollup("repair", "date province city", "count(*) as total"),
        "live_repair_hour": rollup("repair", "date hour", "count(*) as total"),
        "live_repair_type": rollup("repair", "date repairtype", "count(*) as total"),
    }
    for log in ("order", "recharge"):
        sql |= {
            f"live_{log}_hour": rollup(log, "date hour", money),
            f"live_{log}_area": rollup(log, "date province city", money),
            f"live_{log}_type": rollup(log, "date rechargetype", money),
        }
    return sql


def _geohash(lat: str, lon: str) -> str:
    """Bit by bit, from the definition: 40 bits, longitude first, five per letter."""
    x = f"cast(floor(({lon} + 180) / 360 * 1048576) as bigint)"
    y = f"cast(floor(({lat} + 90) / 180 * 1048576) as bigint)"
    letters = []
    for letter in range(8):
        bits = [
            f"(((({y if bit % 2 else x}) >> {19 - bit // 2}) & 1) << {4 - bit % 5})"
            for bit in range(5 * letter, 5 * letter + 5)
        ]
        letters.append(f"substr('0123456789bcdefghjkmnpqrstuvwxyz', cast({' + '.join(bits)} as int) + 1, 1)")
    return "concat(" + ", ".join(letters) + ")"


_IN_BOUNDS = "latitude > 3 and latitude < 54 and longitude > 73 and longitude < 136"

_DECODED = """decoded as (
    select latitude, longitude,
        coalesce(nullif(json_extract_string(body, '$.result.business'), ''),
                 nullif(json_extract_string(body, '$.result.pois[0].tag'), '')) as business
    from (select latitude, longitude,
            substr(reply, 30, length(reply) - 30) as body from replies_log))"""

_DICTIONARY = f"""{_DECODED}, dictionary as (
    select geohash8, business from (
        select geohash8, business,
            row_number() over (partition by geohash8 order by latitude desc, longitude desc) as place
        from (select {_geohash('latitude', 'longitude')} as geohash8, * from decoded
              where business is not null))
    where place = 1)"""


def _geo(views: str, ctes: str, body: str) -> str:
    named = ", ".join(f"{v}_log as ({sql_for(v)})" for v in views.split())
    return f"with {named}, {ctes} {body}"


_CLIENT = "case client when 1 then 'LNiphone' when 2 then 'LNandroid' when 3 then 'LN小程序' end"
_DEVICE = "case deviceType when 1 then 'LCiphone' when 2 then 'LCandroid' when 3 then 'LCwp' end"
_NETWORK = "case networkingmannerid when 1 then 'LFwifi' when 2 then 'LF4G' when 3 then 'LF3G' end"
_UNLOCK = "case \"unlock\" when 1 then 'LS扫码' when 2 then 'LS蓝牙' end"
_TRIP = """case when distance <= 1000 then 'LA短程' when distance < 2000 then 'LA中程'
    when distance >= 2000 then 'LA长程' end"""

_FIXED_TAGS = "(" + " union all ".join(
    f"select userid, date, {tag} as tag from unlock_log"
    for tag in (_CLIENT, _DEVICE, _NETWORK, _UNLOCK, _TRIP)
) + ")"

_RIDE_DISTRICTS = f"""ride_districts as (
    select distinct r.rid, r.sessionid, r.userid, r.date, concat('BS', d.name) as tag
    from (select row_number() over () as rid, sessionid, userid, date,
                 {_geohash('latitude', 'longitude')} as geohash8
          from unlock_log where {_IN_BOUNDS}) r
    join (select geohash8, unnest(string_split(business, ',')) as name from dictionary) d
      on r.geohash8 = d.geohash8
    where d.name <> '')"""

_ALL_TAGS = f"""{_DICTIONARY}, {_RIDE_DISTRICTS}, all_tags as (
    select userid, date, tag from {_FIXED_TAGS} where userid <> '' and tag is not null
    union all select userid, date, tag from ride_districts where userid <> '')"""

_PER_USER = "select userid, tag, count(*) as cnt from all_tags group by userid, tag"


def _tags() -> dict[str, str]:
    def per_ride(*tags: str) -> str:
        return _with("unlock", f"""select sessionid, userid, array_to_string(
                list_sort(list_filter([{', '.join(tags)}], lambda t: t is not null)), ',') as tags
            from unlock_log""")

    return {
        "tags_client": per_ride(_CLIENT, _DEVICE, _NETWORK),
        "tags_bike": per_ride(_UNLOCK, _TRIP),
        "tags_business": _geo("unlock replies", f"{_DICTIONARY}, {_RIDE_DISTRICTS}",
            """select u.sessionid, u.userid, coalesce(t.tags, '') as tags
            from (select row_number() over () as rid, * from unlock_log) u
            left join (select sessionid, string_agg(tag, ',' order by tag) as tags
                       from (select distinct sessionid, tag from ride_districts) group by sessionid) t
              on u.sessionid = t.sessionid"""),
        "user_tags": _geo("unlock replies", _ALL_TAGS, _PER_USER),
        "user_tag_detail": _geo("unlock replies", _ALL_TAGS,
            """select userid, date as day,
                string_agg(concat(tag, ':', cast(cnt as varchar)), ',' order by tag) as tags
            from (select userid, date, tag, count(*) as cnt from all_tags group by userid, date, tag)
            group by userid, date"""),
        "user_tag_document": _geo("unlock replies", _ALL_TAGS,
            f"""select userid as id, cast(1706745600000 as bigint) as timestamp,
                string_agg(concat(tag, ':', cast(cnt as varchar)), ',' order by tag) as tags
            from ({_PER_USER}) group by userid"""),
        "user_tags_shuffled": _geo("unlock replies", _ALL_TAGS, _PER_USER),
        "users_by_tag": _geo("unlock replies", _ALL_TAGS,
            """select userid from all_tags where tag in ('LNiphone', 'LS蓝牙', 'BSd3')
            group by userid having count(distinct tag) = 3"""),
        "users_by_any_tag": _geo("unlock replies", _ALL_TAGS,
            "select distinct userid from all_tags where tag in ('LNiphone', 'LS蓝牙', 'BSd3')"),
        "user_tag_detail_of": _geo("unlock replies", _ALL_TAGS,
            """select userid, date as day,
                string_agg(concat(tag, ':', cast(cnt as varchar)), ',' order by tag) as tags
            from (select userid, date, tag, count(*) as cnt from all_tags
                where userid in ('1', '7', '25', 'nobody') group by userid, date, tag)
            group by userid, date"""),
        "user_tags_standing": _geo("unlock replies", _ALL_TAGS, _PER_USER),
        "tag_decay": _geo("unlock replies", _ALL_TAGS,
            """select userid, tag, round(sum(pow(0.5,
                (date '2024-02-01' - cast(date as date)) / 7.0)), 6) as weight
            from all_tags group by userid, tag"""),
    }


def _geography() -> dict[str, str]:
    return {
        "geohash8": _with("unlock",
            f"select sessionid, {_geohash('latitude', 'longitude')} as geohash8 from unlock_log"),
        "distinct_points": _with("unlock",
            f"select distinct latitude, longitude from unlock_log where {_IN_BOUNDS}"),
        "geocode_decode": _geo("replies", _DECODED, "select latitude, longitude, business from decoded"),
        "geo_dictionary": _geo("replies", _DICTIONARY, "select geohash8, business from dictionary"),
        "geo_misses": _geo("points replies", _DICTIONARY, f"""
            select geohash8, latitude, longitude from (
                select *, row_number() over (
                    partition by geohash8 order by latitude desc, longitude desc) as place
                from (select *, {_geohash('latitude', 'longitude')} as geohash8 from points_log))
            where place = 1 and geohash8 not in (select geohash8 from dictionary)"""),
        # Cells of eastern points first, then what is missing: here the whole dictionary.
        "geo_dictionary_merged": _geo("replies", _DICTIONARY, "select geohash8, business from dictionary"),
    }


def _washing() -> dict[str, str]:
    # Rough lines of kind 2 have a blank client, of kind 3 no device type.
    sql = {f"wash_{log}": _with(log, f"""select * replace (
            case when {ROUGH_KIND} = 2 then null else client end as client,
            case when {ROUGH_KIND} = 3 then null else deviceType end as deviceType)
        from {log}_log""") for log in ("lock", "unlock", "order", "recharge", "repair")}
    sql["mask_sensitive"] = _with("unlock", """select sessionid,
            case when userid = '' then '' else sha256(concat('fixture-salt', userid)) end as userid,
            case btimestamp // 1000 % 8 when 3 then 'fe80::*' when 4 then '2001:db8:7:*'
                when 5 then '::*' when 6 then '*' when 7 then ''
                else regexp_replace(ip, '[0-9]+$', '*') end as ip,
            sha256(concat('fixture-salt', mac)) as mac
        from unlock_log""")
    sql["wash_rejects"] = _with("unlock", """select sessionid as line_id,
            case btimestamp // 1000 % 22 when 1 then 'missing_location' when 2 then 'bad_value:client'
                when 3 then 'bad_value:btimestamp' when 5 then 'bad_value:latitude'
                when 6 then 'bad_value:distance' when 7 then 'bad_value:btimestamp'
                when 10 then 'bad_value:etimestamp' else 'malformed' end as reject_reason
        from unlock_log where btimestamp // 1000 % 22 in (0, 1, 2, 3, 5, 6, 7, 8, 9, 10)""")
    sql["live_rejects"] = _with("unlock", """select sessionid as line_id,
            case btimestamp // 1000 % 22 when 3 then 'bad_value:btimestamp'
                when 6 then 'bad_value:distance' when 7 then 'bad_value:btimestamp'
                when 10 then 'bad_value:etimestamp' else 'malformed' end as reject_reason
        from unlock_log where btimestamp // 1000 % 22 in (0, 3, 6, 7, 8, 9, 10)""")
    return sql


def all_sql() -> dict[str, str]:
    tags = _tags()
    tags["tags_business_shuffled"] = tags["tags_business_stored"] = tags["tags_business"]
    tags["tag_decay_forward"] = tags["tag_decay"]
    live = _live()
    live |= {f"{name}_state": live[name] for name in ("live_ride_hour", "live_recharge_source")}
    return {**_reports(), **_suites(), **_distinct_users(), **_washing(), **_geography(), **tags, **live}
