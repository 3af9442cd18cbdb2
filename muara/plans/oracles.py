"""The same queries in plain SQL over the test tables, written independently of the DataFrame code."""

from __future__ import annotations

from muara.functions.labels import WEATHER_CODES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()

# Columns of each table with the DDL type of the clone; VARCHAR takes the measured length.
COLUMNS = {
    "region": "r_regionkey INTEGER, r_name VARCHAR",
    "nation": "n_nationkey INTEGER, n_name VARCHAR, n_regionkey INTEGER",
    "customer": "c_custkey BIGINT, c_name VARCHAR, c_nationkey INTEGER, c_acctbal DOUBLE PRECISION,"
    " c_mktsegment VARCHAR",
    "supplier": "s_suppkey BIGINT, s_name VARCHAR, s_nationkey INTEGER, s_acctbal DOUBLE PRECISION",
    "part": "p_partkey BIGINT, p_name VARCHAR, p_brand VARCHAR, p_type VARCHAR, p_size INTEGER,"
    " p_retailprice DOUBLE PRECISION",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus VARCHAR, o_totalprice DOUBLE PRECISION,"
    " o_orderdate TIMESTAMP, o_orderpriority VARCHAR",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INTEGER,"
    " l_quantity DOUBLE PRECISION, l_extendedprice DOUBLE PRECISION, l_discount DOUBLE PRECISION,"
    " l_tax DOUBLE PRECISION, l_returnflag VARCHAR, l_linestatus VARCHAR, l_shipdate TIMESTAMP",
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE PRECISION,"
    " props VARCHAR",
    "documents": "doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding REAL[], label INTEGER",
    "pages": "page_id BIGINT, url VARCHAR, html VARCHAR",
    "benchmark": "item_id BIGINT, text VARCHAR",
    "labels": "doc_id BIGINT, quality INTEGER, toxic INTEGER",
    "conversations": "conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR",
}

PRIMARY = {
    "region": "r_regionkey",
    "nation": "n_nationkey",
    "customer": "c_custkey",
    "supplier": "s_suppkey",
    "part": "p_partkey",
    "orders": "o_orderkey",
    "lineitem": "l_orderkey, l_linenumber",
    "events": "event_id",
    "documents": "doc_id",
    "pages": "page_id",
    "conversations": "conv_id, turn",
}
UNIQUE = {"nation": "n_name", "events": "user_id, ts"}
FOREIGN = (
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("labels", "doc_id", "documents", "doc_id"),
)


def columns_of(table: str) -> list[tuple[str, str]]:
    return [tuple(text.strip().split(" ", 1)) for text in COLUMNS[table].split(",")]


def _counts() -> str:
    return " union all ".join(f"select '{t}' table_name, count(*) row_count from {t}" for t in TABLES)


def _catalog_columns() -> str:
    return " union all ".join(
        f"select '{t}' table_name, '{c}' column_name, {at} pos, count({c}) < count(*) nullable,"
        f" count({c}) non_null from {t}"
        for t in TABLES
        for at, (c, _) in enumerate(columns_of(t), start=1)
    )


def _key_candidates() -> str:
    parts = []
    for kind, keys in (("PRIMARY KEY", PRIMARY), ("UNIQUE", UNIQUE)):
        for table, columns in keys.items():
            names = columns.split(", ")
            any_null = " or ".join(f"{c} is null" for c in names)
            parts.append(
                f"select '{table}' table_name, '{kind}' kind, '{','.join(names)}' key_columns,"
                f" count(*) row_count, (select count(*) from (select distinct {columns} from {table}))"
                f" distinct_keys, count(*) filter (where {any_null}) null_keys from {table}"
            )
    return (
        "select *, row_count = distinct_keys and null_keys = 0 holds from ("
        + " union all ".join(parts)
        + ")"
    )


def _clone_ddl() -> str:
    parts = []
    for table in TABLES:
        lines = []
        for column, kind in columns_of(table):
            text = f"'    {column} {kind}'"
            if kind == "VARCHAR":
                text += f" || coalesce('(' || nullif(max(length({column})), 0) || ')', '')"
            lines.append(text + f" || case when count({column}) < count(*) then '' else ' NOT NULL' end")
        body = " || ',' || chr(10) || ".join(lines)
        tail = ""
        if table in PRIMARY:
            tail += f" || ',' || chr(10) || '    PRIMARY KEY ({PRIMARY[table]})'"
        if table in UNIQUE:
            tail += f" || ',' || chr(10) || '    UNIQUE ({UNIQUE[table]})'"
        tail += " || chr(10) || ');' || chr(10)"
        if table in PRIMARY:
            tail += (
                f" || 'CREATE INDEX IF NOT EXISTS idx_{table}_pk ON public.{table}({PRIMARY[table]});'"
                " || chr(10)"
            )
        parts.append(
            f"select '{table}' table_name, 'CREATE TABLE IF NOT EXISTS public.{table} (' || chr(10) || "
            f"{body}{tail} ddl from {table}"
        )
    return " union all ".join(parts)


def _foreign_keys() -> str:
    return " union all ".join(
        f"select '{c}.{ck}' child, '{p}.{pk}' parent, count(*) orphans from {c} where {ck} is not null"
        f" and not exists (select 1 from {p} where {p}.{pk} = {c}.{ck})"
        for c, ck, p, pk in FOREIGN
    )


AS_OF = "timestamp '2024-01-31 00:00:00'"
AGE = f"date_diff('microsecond', {{0}}, {AS_OF})"


def _label(age: str) -> str:
    return (
        f"case when {age} <= 3600000000 then 'FRESH' when {age} <= 10800000000 then 'WARNING'"
        " else 'STALE' end"
    )


LATEST = "(select user_id, max(ts) l from events group by 1)"
TRIPS = (
    "(select l_suppkey, l_partkey, l_quantity, l_returnflag, l_discount, cast(l_shipdate as date) d,"
    " date_diff('hour', o_orderdate, l_shipdate) hrs from lineitem join orders on l_orderkey = o_orderkey)"
)
ON_TIME = "100.0::double * sum(case when hrs <= 72 then 1 else 0 end) / count(*)"
SAFE = "100.0::double * sum(case when l_returnflag = 'R' then 0 else 1 end) / count(*)"
DISTANCE = "round(sum(l_quantity), 4)"
FIRST = "event_type in ('click', 'view')"

CODES = ",".join(f"({code},'{text}')" for code, text in WEATHER_CODES)

HUMIDITY = "cast(props->>'$.k' as int)"
HOURLY = f"(select *, date_trunc('hour', ts) wh, case when {FIRST} then 0 else 1 end lot from events)"


PLAIN = "region nation customer supplier part orders lineitem events".split()
WHOLE, TEXT = ("INTEGER", "BIGINT"), ("VARCHAR",)


def _discovered(most: int = 2) -> str:
    """Unique column sets without a smaller one inside, each counted on its own."""
    parts = []
    for table in PLAIN:
        names = [c for c, _ in columns_of(table)]
        flags = [f"count(*) > 0 and count({c}) = count(*) and count(distinct {c}) = count(*) k{i}" for i, c in enumerate(names)]
        flags += [
            f"count(*) > 0 and count({a}) = count(*) and count({b}) = count(*) and count(distinct ({a}, {b})) = count(*) k{i}_{j}"
            for i, a in enumerate(names) for j, b in enumerate(names) if i < j and most > 1
        ]
        rows = [f"select '{table}' table_name, '{c}' key_columns, k{i} ok from f" for i, c in enumerate(names)]
        rows += [
            f"select '{table}', '{a},{b}', k{i}_{j} and not k{i} and not k{j} from f"
            for i, a in enumerate(names) for j, b in enumerate(names) if i < j and most > 1
        ]
        parts.append(f"(with f as (select {', '.join(flags)} from {table}) {' union all '.join(rows)})")
    return f"select table_name, key_columns from ({' union all '.join(parts)}) where ok"


def _foreign_candidates() -> str:
    places = [(t, c, k) for t in PLAIN for c, k in columns_of(t) if k in WHOLE + TEXT]
    pairs = [
        f"select '{t}' child_table, '{c}' child_column, '{p}' parent_table, '{d}' parent_column,"
        f" (select count({c}) > 0 from {t}) and not exists (select 1 from {t} where {c} is not null and {c} not in"
        f" (select {d} from {p} where {d} is not null)) ok"
        for t, c, k in places for p, d, m in places if t != p and (k in TEXT) == (m in TEXT)
    ]
    keys = _discovered(1)
    return f"""select child_table, child_column, parent_table, parent_column from ({" union all ".join(pairs)})
        where ok and (parent_table, parent_column) in ({keys})"""


def oracle_sql() -> dict[str, str]:
    counts = _counts()
    freshness_location = (
        f"select user_id adm4, l latest, {AGE.format('l')} / 60000000.0::double age_minutes,"
        f" {_label(AGE.format('l'))} freshness_status from {LATEST}"
    )
    queries = {
        "full_refresh": "select * from supplier",
        "refresh_keep_if_empty": "select * from orders",
        "append_load": "select * from customer union all select * from customer",
        "load_by_name": f"select p_name, p_partkey, p_retailprice, cast(null as varchar) note,"
        f" {AS_OF} created_at from part",
        "upsert_forecast": f"""with r as (
            select user_id, wh, event_type, value, ts last_updated,
                first_value(ts) over (partition by user_id, wh order by lot, event_id) created_at,
                row_number() over (partition by user_id, wh order by lot desc, event_id desc) rn
            from {HOURLY})
            select user_id adm4, wh waktu, event_type cuaca, value suhu_celsius, created_at, last_updated
            from r where rn = 1""",
        "insert_ignore": f"""select user_id adm4, wh waktu, event_type cuaca, value suhu_celsius from (
            select *, row_number() over (partition by user_id, wh order by lot, event_id) rn
            from {HOURLY}) where rn = 1""",
        "upsert_counters": f"""with b as (select user_id, wh from {HOURLY} where lot = 1),
            x as (select distinct user_id, wh from {HOURLY} where lot = 0),
            n as (select count(*) i from (select distinct user_id, wh from b) d where not exists
                (select 1 from x where x.user_id = d.user_id and x.wh = d.wh))
            select n.i inserted, (select count(*) from b) - n.i updated, (select count(*) from b) total
            from n""",
        "dedup_exact": "select distinct user_id, event_type from events",
        "retention_keep": "select event_id, ts from events"
        " where ts >= timestamp '2024-02-15 00:00:00' - interval 30 day",
        "retention_deleted": "select count(*) deleted from events"
        " where ts < timestamp '2024-02-15 00:00:00' - interval 30 day",
        "expired_preview": "select count(*) n, min(ts) first_ts, max(ts) last_ts from events"
        " where ts < timestamp '2024-01-10 00:00:00'",
        "expired_delete": "select event_id, ts waktu from events"
        " where ts >= timestamp '2024-01-10 00:00:00'",
        "update_null_partition": """select event_id, event_type, case when event_id % 11 = 0 then -1.0::double
                when event_id % 5 = 0 then 0.0::double else value end as value,
            case when event_type <> 'signup' then cast(ts as date) end as day
            from events where event_id % 7 <> 0 or event_id % 11 = 0""",
        "archive_two_tables": """select o_orderkey, case when year(o_orderdate) < 1997 then 'archive'
                when o_orderstatus = 'F' then 'final' when o_orderstatus = 'O' then 'open' else 'rest' end place
            from orders""",
        "incremental_equal_mark": """with e as (select event_id, ts, value from events union all
                select event_id + 1000000000, ts, value from events where ts =
                (select max(ts) from events where ts < timestamp '2024-01-20 00:00:00'))
            select *, 'plain' target from e union all select *, 'keyed' from e""",
        "partitioned_sync": f"""with m as (select max(ts) t from events where ts < {AS_OF})
            select event_id, ts, case when ts >= m.t then value + 1 else value end as value, cast(ts as date) as day
            from events, m""",
        "moved_partition": """with e as (select event_id, value, ts, event_id % 3 = 0 changed,
                timestamp '2024-02-15 00:00:00' + interval 1 day * (event_id % 5) later from events)
            select event_id, case when changed then value + 1 else value end as value,
                case when changed then later else ts end updated_at,
                case when not changed then ts::date when event_id % 10 <> 0 then later::date end as day from e""",
        "asof_null_times": """select e.event_id, p.event_id prev_id
            from (select event_id, user_id, case when event_id % 7 <> 0 then ts end ts from events
                where event_type = 'error') e
            asof left join (select * from events where event_type = 'purchase' and event_id % 5 <> 0) p
            on e.user_id = p.user_id and e.ts >= p.ts""",
        "on_demand_missing_source": """select 'supplier' target, 'success' status, count(*) row_count from supplier
            union all select 'rating', 'failed', 0""",
        "landing_order": f"""select cast(user_id as varchar) adm4, wh waktu, event_type cuaca, value suhu_celsius
            from (select *, row_number() over (partition by user_id, wh order by lot desc, event_id desc) rn
                from {HOURLY}) where rn = 1""",
        "freshness_reset": f"""select cast(user_id as varchar) adm4, wh waktu,
            case when max(lot) = 1 then 'FRESH' end freshness_status from {HOURLY} group by user_id, wh""",
        "hourly_run_by_created": f"""with r as (
            select user_id, wh, event_type, value, min(lot) over (partition by user_id, wh) first_lot,
                max(lot) over (partition by user_id, wh) latest,
                row_number() over (partition by user_id, wh order by lot desc, event_id desc) rn
            from {HOURLY})
            select cast(user_id as varchar) adm4, wh waktu, event_type cuaca, value suhu_celsius,
                cast({AS_OF} + interval 1 day * first_lot as date) created_date,
                case when latest = 1 then 0.0::double else 1440.0::double end data_age_minutes,
                case when latest = 1 then 'FRESH' else 'STALE' end freshness_status
            from r where rn = 1""",
        "archive_by_year": "select o_orderkey, cast(year(o_orderdate) as int) y,"
        " case when year(o_orderdate) < 1997 then 'archive' else 'kept' end place from orders",
        "incremental_scan": "select event_id, ts, value from events where ts >"
        " (select max(ts) from events where ts < timestamp '2024-01-20 00:00:00')",
        "incremental_sync": "select event_id, ts, value from events",
        "parse_forecast": f"""select cast(user_id as varchar) adm4, 'Kota ' || user_id lokasi,
            'Desa ' || user_id desa, 'Kec ' || user_id kecamatan, 'Kota ' || user_id kabupaten,
            'Prov' provinsi, ts waktu, event_type cuaca, value suhu_celsius, {HUMIDITY} kelembapan,
            'E' arah_angin, {HUMIDITY} / 10.0::double kecepatan_angin from events""",
        "parse_forecast_dirty": "select cast(user_id as varchar) adm4, count(*) filter (where event_type <> 'error') n,"
        " count(*) filter (where event_type = 'error') rejected from events group by 1",
        "location_defaults": "select cast(user_id as varchar) adm4,"
        " case when event_type = 'view' then 'Lokasi ' else 'Kota ' end || user_id lokasi,"
        " case when event_type = 'view' then '' else 'Desa ' || user_id end desa,"
        " count(*) n from events group by 1, 2, 3",
        "tz_convert": "select event_id, date_trunc('second', ts) + interval 7 hour waktu_wib,"
        " ts waktu_wallclock from events",
        "reject_rows": f"""select case when event_type = 'signup' and {HUMIDITY} < 10
                then 'datetime_missing+hu_invalid' when event_type = 'signup' then 'datetime_missing'
                when {HUMIDITY} < 10 then 'hu_invalid' else 'valid' end status, count(*) n
            from events group by 1""",
        "decode_codes": f"""select coalesce(m.d, 'Unknown (' || k || ')') cuaca, count(*) n
            from (select {HUMIDITY} k from events) e left join (values {CODES}) m(c, d) on m.c = e.k
            group by 1""",
        "json_envelope": "select case when event_type <> 'signup' then user_id end adm4, count(*) records_count,"
        " max(event_id) last_event, 'success' status from events group by 1",
        "validate_records": f"""select 'temp_range' rule_name, count(*) n from events
            where value not between 0.5 and 200
            union all select 'hum_range', count(*) from events where {HUMIDITY} not between 0 and 90""",
        "recent_window": f"select event_id, ts from events where ts >= {AS_OF} - interval 7 day",
        "location_select": """select r.a::varchar adm4, count(e.user_id) > 0 known, count(e.user_id) records
            from (values (1::bigint), (5), (9999)) r(a) left join events e on e.user_id = r.a group by 1""",
        "classify_tables": f"""select table_name, case when table_name like '%item%'
                or table_name like 'order%' or table_name in ('customer', 'supplier', 'part', 'nation',
                'region') then 'Business Data' else 'Other Data' end data_type, row_count
            from ({counts})""",
        "orders_by_region": """select r_name, count(*) n,
            round(sum(o_totalprice), 4) total
            from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
            join region on n_regionkey = r_regionkey group by 1""",
        "left_join_recent_orders": """select c_custkey, count(o_orderkey) n from customer left join orders
            on o_custkey = c_custkey and o_orderdate >= timestamp '2001-06-01 00:00:00' group by 1""",
        "scalar_subquery_counts": "select n_name, (select count(*) from customer"
        " where c_nationkey = n_nationkey) n from nation",
        "dedup_keep_first": """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate from (
            select *, row_number() over (partition by l_orderkey, l_linenumber
                order by l_shipdate, l_partkey, l_suppkey) rn from lineitem) where rn = 1""",
        "duplicate_keys": "select l_orderkey, l_linenumber, count(*) n from lineitem group by 1, 2"
        " having count(*) > 1",
        "changed_rows": "select c_custkey, c_name, c_acctbal from customer"
        " where c_mktsegment = 'BUILDING' or c_acctbal < 0",
        "orphan_check": "select o_orderkey, o_custkey from orders where not exists"
        " (select 1 from customer where c_custkey = o_custkey and c_acctbal > 0)",
        "foreign_keys": _foreign_keys(),
        "reconcile_counts": """select *, src is not distinct from tgt as match from (
            select 'orders' t, (select count(*) from orders) src,
                (select count(*) from orders where o_orderstatus <> 'F') tgt
            union all select 'nation', (select count(*) from nation), (select count(*) from nation)
            union all select 'events', (select count(*) from events), null)""",
        "reconcile_schema": """with c as (select count(c_custkey) k, count(c_name) m, count(c_nationkey) n,
                count(c_acctbal) a, count(c_acctbal) filter (where c_acctbal >= 0) p,
                count(c_mktsegment) s, count(*) r from customer)
            select 'customer' table_name, v.* from c, lateral (values
                ('c_custkey', 'bigint', k, 'character varying', k, 'type_differs'),
                ('c_name', 'character varying', m, 'character varying', m, 'match'),
                ('c_nationkey', 'integer', n, 'integer', n, 'match'),
                ('c_acctbal', 'double precision', a, 'double precision', p, 'values_differ'),
                ('c_mktsegment', 'character varying', s, null, null, 'missing_in_target'),
                ('loaded_by', null, null, 'character varying', r, 'missing_in_source'))
                v(column_name, source_type, source_values, target_type, target_values, status)""",
        "group_validation": f"""select case when table_name in ('orders', 'lineitem') then 'operational'
                when table_name = 'events' then 'log' else 'master' end table_group,
                count(*) tables, count(*) matching, count(*) filter (where row_count = 0) empty_tables,
                true ok
            from ({counts}) where table_name in ('region', 'nation', 'customer', 'supplier', 'part',
                'orders', 'lineitem', 'events') group by 1""",
        "asof_trip_weather": """select e.event_id, p.event_id prev_id, p.value
            from (select * from events where event_type = 'error') e
            asof left join (select * from events where event_type = 'purchase') p
            on e.user_id = p.user_id and e.ts >= p.ts""",
        "hourly_correlation": """select round(corr(a.n, b.v), 6) r from
            (select date_trunc('hour', ts) h, count(*) n from events where event_type = 'error' group by 1) a
            join (select date_trunc('hour', ts) h, avg(value) v from events
                where event_type = 'purchase' group by 1) b on a.h = b.h""",
        "verify_fact": "select count(*) total_rows, max(ts) latest_created_at, max(ts) latest_updated_at,"
        " max(ts) latest_forecast from events",
        "freshness_row": f"""select event_id, case when ts >= {AS_OF} - interval 2 day
                then {AGE.format('ts')} / 60000000.0::double end data_age_minutes,
            case when ts < {AS_OF} - interval 2 day then 'STALE' else {_label(AGE.format('ts'))} end
                freshness_status from events""",
        "freshness_location": freshness_location,
        "freshness_report": f"""select st, count(*) n, count(*) * 100.0::double
                / cast(sum(count(*)) over () as double) percent
            from (select {_label(AGE.format('l'))} st from {LATEST}) group by 1""",
        "freshness_gate": f"""select p stale_percent, p <= 50 open from (
            select 100.0::double * count(*) filter (where {AGE.format('l')} > 10800000000) / count(*) p
            from {LATEST})""",
        "status_by_location_7d": f"""select user_id adm4, event_type status, max(ts) latest,
                {AGE.format('max(ts)')} / 60000000.0::double age_minutes, count(*) records
            from events where ts >= {AS_OF} - interval 7 day group by 1, 2""",
        "daily_records_30d": f"select cast(ts as date) d, user_id adm4, count(*) records from events"
        f" where ts >= {AS_OF} - interval 30 day group by 1, 2",
        "daily_summary": f"""with b as (select user_id, cast(ts as date) d, event_type, value,
                {HUMIDITY} k from events),
            g as (select user_id, d, min(value) temp_min, max(value) temp_max,
                round(avg(value), 10) temp_avg,
                round(avg(k), 10) humidity_avg, round(avg(k / 10.0::double), 10) wind_speed_avg
                from b group by 1, 2),
            m as (select user_id, d, event_type from (select user_id, d, event_type, row_number() over
                (partition by user_id, d order by count(*) desc, event_type) rn
                from b group by 1, 2, 3) where rn = 1)
            select g.user_id adm4, g.d summary_date, temp_min, temp_max, temp_avg, humidity_avg,
                wind_speed_avg, cast(null as double) total_precipitation, event_type weather_description
            from g join m on g.user_id = m.user_id and g.d = m.d""",
        "kpi_daily": f"""with o as (select cast(o_orderdate as date) d, count(*) total_orders
                from orders group by 1),
            s as (select d, count(*) total_deliveries, {DISTANCE} total_distance_km,
                count(distinct l_suppkey) active_drivers, count(distinct l_partkey) active_vehicles,
                avg(hrs) avg_delivery_time_hours, {ON_TIME} on_time_delivery_rate from {TRIPS} group by 1)
            select coalesce(o.d, s.d) kpi_date, total_orders, total_deliveries, total_distance_km,
                active_drivers, active_vehicles, avg_delivery_time_hours, on_time_delivery_rate
            from o full join s on o.d = s.d""",
        "driver_monthly": f"""select l_suppkey driver_id, cast(date_trunc('month', d) as date) metric_month,
                count(*) total_trips, {DISTANCE} total_distance_km, {ON_TIME} on_time_rate,
                {SAFE} safety_score from {TRIPS} group by 1, 2""",
        "driver_performance": f"""select l_suppkey driver_id, count(*) total_trips,
                {DISTANCE} total_distance_km, {ON_TIME} on_time_rate, {SAFE} safety_score,
                round(avg(l_discount), 10) avg_rating, min(d) first_trip, max(d) last_trip from {TRIPS} group by 1""",
        "alert_rules": f"""with p as (select 100.0::double
                * sum(case when {AGE.format('l')} > 10800000000 then 1 else 0 end) / count(*) m
                from {LATEST}),
            u as (select 100.0::double * (count(*) - count(distinct (user_id, date_trunc('hour', ts))))
                / count(*) m from events)
            select 'stale_gt_50' rule_name, m metric, m > 50 fired,
                case when m > 50 then 'more than half of the locations are stale' end alert_text from p
            union all select 'dup_gt_20', m, m > 20,
                case when m > 20 then 'too many repeated location hours' end from u""",
        "current_per_location": """select user_id adm4, ts waktu, event_type cuaca, value suhu_celsius
            from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) rn
                from events where ts <= timestamp '2024-01-20 00:00:00') where rn = 1""",
        "forecast_7d": "select user_id adm4, ts waktu, event_type cuaca from events"
        " where ts >= timestamp '2024-01-20 00:00:00' and ts < timestamp '2024-01-27 00:00:00'",
        "union_locations": "select event_id, user_id from events",
        "date_parts": "select event_id, cast(hour(ts) as int) h, cast(year(ts) as int) y,"
        " cast(ts as date) d, strftime(ts, '%Y-%m-%d %H:%M:%S') s from events",
        "table_row_counts": counts,
        "warehouse_totals": f"select count(*) total_tables, cast(sum(row_count) as bigint) total_records"
        f" from ({counts})",
        "top_tables": f"select * from ({counts}) order by row_count desc, table_name limit 10",
        "missing_tables": f"select * from (values ('orders'), ('rating'), ('stok')) e(t)"
        f" except select table_name from ({counts}) where row_count > 0",
        "table_count_check": f"select count(*) total_tables, abs(count(*) - 16) <= 2 within_tolerance"
        f" from ({counts}) where row_count > 0",
        "catalog_tables": f"select *, cast(row_number() over (order by table_name) as int) pos"
        f" from ({counts})",
        "catalog_columns": _catalog_columns(),
        "key_candidates": _key_candidates(),
        "clone_ddl": _clone_ddl(),
        "sync_manifest": f"select case when table_name = 'orders' then 'sales_orders' else table_name end"
        f" table_name, row_count from ({counts})",
        "sync_summary": f"""with c as (select case when table_name = 'orders' then 'sales_orders'
                else table_name end target, row_count from ({counts}))
            select 'success' status, count(*) tables, cast(sum(row_count) as bigint) total_rows,
                array_to_string(list_slice(list_sort(list(target)), 1, 10), ',') first_tables from c
            union all select 'failed', 1, 0, 'rating'""",
        "sync_alerts": f"""with m as (select 100.0::double * count(*) / (count(*) + 1) p, count(*) n
                from ({counts}) where table_name in ('customer', 'supplier', 'part'))
            select 'success_lt_95' rule_name, p metric, p < 95 fired,
                case when p < 95 then 'too few tables were loaded' end alert_text from m
            union all select 'tables_lt_85', n::double, n < 85, case when n < 85 then 'fewer tables than expected' end
                from m
            union all select 'failures_gt_3', 1, false, null""",
        "clone_structure": f"select table_name, case when table_name = 'nation' then 'skipped'"
        f" else 'created' end status, row_count from ({counts})",
        "on_demand_copy": f"""select {AS_OF} created_at, 'sales_orders' table_name, count(*) row_count
                from orders
            union all select {AS_OF} + interval 1 hour, 'supplier', count(*) from supplier""",
        "namespace_totals": f"""select case when table_name = 'events' then 'weather'
                when table_name in ('documents', 'pages') then 'analytics' else 'public' end namespace,
                count(*) tables, cast(sum(row_count) as bigint) total_rows from ({counts}) group by 1""",
        "records_by_province": """select r_name province, count(distinct user_id) locations,
                count(*) records,
                round(avg(value), 10) temp_avg
            from events left join customer on c_custkey = user_id
            left join nation on n_nationkey = c_nationkey left join region on r_regionkey = n_regionkey
            group by 1""",
        "console_feed": "select cast(user_id as varchar) adm4, 'Kota ' || user_id lokasi,"
        " count(*) records_count, max(value) temp_max from events group by 1, 2",
        "stream_upsert": f"""with r as (
            select user_id, wh, event_type, value, {HUMIDITY} k, lot,
                min(lot) over (partition by user_id, wh) first_lot,
                row_number() over (partition by user_id, wh order by lot desc, event_id desc) rn
            from {HOURLY})
            select cast(user_id as varchar) adm4, wh waktu, 'Kota ' || user_id lokasi, event_type cuaca,
                value suhu_celsius, k kelembapan, {AS_OF} + interval 1 hour * first_lot created_at,
                {AS_OF} + interval 1 hour * lot last_updated
            from r where rn = 1""",
        "stream_dedup": "select distinct user_id adm4, date_trunc('hour', ts) waktu from events",
        "stream_late_rows": """with m as (select epoch_ms(max(ts)) - 7 * 86400000 w from events),
            l as (select count(*) late from events, m where ts < timestamp '2024-01-20 00:00:00' and ts <= make_timestamp(w * 1000))
            select late, (select count(*) from events) - late kept from l""",
        "size_text": """with s as (select o_orderkey, o_orderkey * cast(pow(10, o_orderkey % 10) as bigint) bytes from orders)
            select o_orderkey, bytes, case when bytes < 10240 then bytes || ' bytes'
                when round(bytes / 1024.0::double) < 10240 then cast(round(bytes / 1024.0::double) as bigint) || ' kB'
                when round(bytes / 1048576.0::double) < 10240 then cast(round(bytes / 1048576.0::double) as bigint) || ' MB'
                when round(bytes / 1073741824.0::double) < 10240 then cast(round(bytes / 1073741824.0::double) as bigint) || ' GB'
                else cast(round(bytes / 1099511627776.0::double) as bigint) || ' TB' end size from s""",
        "kpi_daily_approx": f"""with o as (select distinct cast(o_orderdate as date) d from orders),
            s as (select d, count(*) n from {TRIPS} group by 1)
            select coalesce(o.d, s.d) kpi_date, n total_deliveries, true drivers_near, true vehicles_near
            from o full join s on o.d = s.d""",
        "stream_daily_counts": "select cast(ts as date) d, event_type, count(*) n from events group by 1, 2",
        "stream_staleness": freshness_location,
        "stream_silence": """with ticks(k, now) as (values (1, timestamp '2024-01-20 00:00:00'), (2, timestamp '2024-01-20 03:01:00'),
                (3, timestamp '2024-01-31 00:00:00'), (4, timestamp '2024-01-31 03:01:00')),
            seen as (select k, now, user_id, max(ts) latest from ticks
                join events on k >= 3 or ts < timestamp '2024-01-20 00:00:00' group by all),
            silent as (select *, date_diff('microsecond', latest, now) / 60000000.0::double age from seen)
            select user_id, latest, min(age) age_minutes, min(now) alerted_at from silent where age > 180 group by 1, 2""",
        "stream_rollups": """select 'hour' grain, date_trunc('hour', ts) starts, event_type, count(*) records,
                round(avg(value), 8) as mean, min(value) low, max(value) high from events group by 1, 2, 3
            union all select 'day', date_trunc('day', ts)::timestamp, event_type, count(*), round(avg(value), 8),
                min(value), max(value) from events group by 1, 2, 3""",
        "stream_late_side": """with e as (select event_id, ts >= timestamp '2024-01-20 00:00:00' early,
                ts < max(ts) over () - interval 7 day behind from events),
            r as (select event_id, early or not behind kept, case when behind then 2 else 0 end times_late,
                case when early then case when behind then 0 else 2 end when behind then 0 else 1 end again from e)
            select event_id, kept, times_late, sum(again) over ()::bigint repeats from r""",
    }
    periods = {
        period: f"""select cast(date_trunc('{period}', d) as date) period_start, count(*) total_deliveries,
            {DISTANCE} total_distance_km, avg(hrs) avg_delivery_time_hours, {ON_TIME} on_time_delivery_rate,
            true drivers_near, true vehicles_near from {TRIPS} group by 1"""
        for period in ("month", "year")
    }
    left = "from events where not (hour(ts) < 6 and ts < timestamp '2024-01-10 00:00:00')"
    return queries | {
        "daily_summary_followed": queries["daily_summary"].replace("from events", left),
        "kpi_daily_followed": queries["kpi_daily"],
        "driver_monthly_followed": queries["driver_monthly"],
        "driver_monthly_rated": queries["driver_monthly"].replace(
            f"{SAFE} safety_score", f"round(({SAFE} + 1000 * avg(l_discount)) / 2, 8) safety_score"
        ),
        "group_validation_pinned": queries["group_validation"],
        "retention_by_created": queries["retention_keep"],
        "freshness_row_by_created": queries["freshness_row"],
        "discovered_keys": _discovered(),
        "foreign_key_candidates": _foreign_candidates(),
        "content_reconciliation": """with t as (select * replace (case when o_orderkey = 33 then o_totalprice + 1 else o_totalprice
                end as o_totalprice, case when o_orderkey <> 100 then o_orderstatus end as o_orderstatus) from orders where o_orderkey <> 7
                union all select * from orders where o_orderkey = 65),
            d as (select 'source' side, * from (select * from orders except all select * from t)
                union all select 'target', * from (select * from t except all select * from orders))
            select o_orderkey, o_orderstatus, o_totalprice, side, count(*) copies from d group by all""",
        "feed_drift": f"""with e as (select date_trunc('week', ts)::date run, event_type, {HUMIDITY} k from events),
            r as (select *, run >= date '2024-01-20' later from e)
            select run, 'wd' field, 'vanished' status, '' kinds, count(*) n from r where later group by 1
            union all select run, 'gust', 'added', 'OBJECT', count(*) from r where later group by 1
            union all select run, 'hu', 'retyped', 'BOOLEAN', count(*) from r where event_type = 'error' group by 1
            union all select run, 'weather_desc', case when count(*) = count(*) filter (where event_type = 'signup')
                then 'vanished' else 'missing' end, '', count(*) filter (where event_type = 'signup') from r
                group by 1 having count(*) filter (where event_type = 'signup') > 0""",
        "landed_once": f"""with r as (
            select user_id, wh, event_type, value, lot, min(lot) over (partition by user_id, wh) first_lot,
                row_number() over (partition by user_id, wh order by lot desc, event_id desc) rn from {HOURLY})
            select cast(user_id as varchar) adm4, wh waktu, event_type cuaca, value suhu_celsius,
                {AS_OF} + interval 1 hour * first_lot created_at, {AS_OF} + interval 1 hour * lot last_updated
            from r where rn = 1""",
        "kpi_months_sketched": periods["month"],
        "kpi_years_sketched": periods["year"],
    }
