"""DuckDB counterparts of the registered queries.

Each text states the result from the definition of the operator, over the base
tables only: derived tables are common table expressions, pulled in by name.
"""

from __future__ import annotations

import re

from scenarios.feed import CUT, FIRST_DAY, SPREAD, STAMP, TODAY, WEEKS

CUT_TS, STAMP_TS = f"timestamp '{CUT}'", f"timestamp '{STAMP}'"
OPEN_END = "timestamp '9999-12-31 23:59:59'"
LATE_DAYS = "day(_commit_timestamp) between 11 and 20"

CTES: dict[str, str] = {}

# --- the change feed (FIXTURES.md) --------------------------------------------------------

CTES["customer_base"] = """
  select event_id, ts, user_id, event_type,
         lag(event_type) over (partition by user_id order by ts, event_id) as prev_type,
         lag(event_id) over (partition by user_id order by ts, event_id) as prev_id
  from events where event_type in ('signup', 'error')"""
CTES["customer_img"] = """
  select event_id, ts, 'INSERT' as ct, 1 as k, event_id as img_id, user_id from customer_base
   where event_type = 'signup' and (prev_type is null or prev_type = 'error')
  union all select event_id, ts, 'UPDATE_BEFORE', 2, prev_id, user_id from customer_base where event_type = 'signup' and prev_type = 'signup'
  union all select event_id, ts, 'UPDATE_AFTER', 3, event_id, user_id from customer_base where event_type = 'signup' and prev_type = 'signup'
  union all select event_id, ts, 'DELETE', 4, prev_id, user_id from customer_base where event_type = 'error' and prev_type = 'signup'
  union all select event_id, ts, 'UPDATE_AFTER', 5, event_id + 1, user_id from customer_base where event_type = 'signup' and event_id % 61 = 0"""
CTES["raw_customers"] = """
  select event_id * 10 + k as _row_sequence_id, 'customers' as entity_type, ct as _change_type, ts as _commit_timestamp,
  case when img_id % 97 = 0 then null else 'C' || cast(user_id as string) end as customer_id,
  'First' || cast(user_id % 10 as string) as first_name,
  'Last' || cast(user_id % 7 as string) as last_name,
  case when img_id % 43 = 0 then null when img_id % 37 = 0 then 'not-an-email'
       else 'u' || cast(user_id as string) || '.' || cast(img_id % 90 as string) || '@example.com' end as email,
  case when img_id % 41 = 0 then null when img_id % 47 = 0 then 'CAL' when img_id % 5 = 0 then ' ny '
       when img_id % 5 = 1 then 'CA' when img_id % 5 = 2 then 'TX' when img_id % 5 = 3 then 'FL' else 'IL' end as state,
  ts as created_at, ts as updated_at,
  ts as _bronze_ingested_at, 'batch-' || cast(cast(ts as date) as string) as _bronze_batch_id,
  case when cast(ts as date) >= date '2024-01-20' then 'tier' || cast(user_id % 3 as string) else null end as loyalty_tier,
  cast(ts as date) as ingest_date
  from customer_img"""
CTES["order_img"] = """
  select event_id, ts, ts as cts, 'INSERT' as ct, 1 as k, 'Pending' as st, user_id, value from events where event_type = 'purchase'
  union all select event_id, ts, ts + interval 1 hour, 'UPDATE_BEFORE', 2, 'Pending', user_id, value from events where event_type = 'purchase' and event_id % 3 <> 0
  union all select event_id, ts, ts + interval 1 hour, 'UPDATE_AFTER', 3, case when event_id % 7 = 0 then 'Cancelled' else 'Shipped' end, user_id, value from events where event_type = 'purchase' and event_id % 3 <> 0
  union all select event_id, ts, ts + interval 2 hour, 'UPDATE_BEFORE', 4, 'Shipped', user_id, value from events where event_type = 'purchase' and event_id % 3 = 1 and event_id % 7 <> 0
  union all select event_id, ts, ts + interval 2 hour, 'UPDATE_AFTER', 5, 'Delivered', user_id, value from events where event_type = 'purchase' and event_id % 3 = 1 and event_id % 7 <> 0
  union all select event_id, ts, ts + interval 3 hour, 'DELETE', 6, 'Pending', user_id, value from events where event_type = 'purchase' and event_id % 11 = 0"""
CTES["raw_orders"] = """
  select event_id * 10 + k as _row_sequence_id, 'orders' as entity_type, ct as _change_type, cts as _commit_timestamp,
  case when event_id % 101 = 0 then null else 'O' || cast(event_id as string) end as order_id,
  case when event_id % 59 = 0 then null else 'C' || cast(user_id as string) end as customer_id,
  case when event_id % 31 = 0 then null when event_id % 29 = 0 then -value else value end as order_amount,
  st as order_status, ts as created_at, cts as updated_at,
  cts as _bronze_ingested_at, 'batch-' || cast(cast(cts as date) as string) as _bronze_batch_id, cast(cts as date) as ingest_date
  from order_img"""
CTES["change_log"] = """
  select _row_sequence_id, entity_type, _change_type, _commit_timestamp, customer_id, first_name, last_name, email, state,
         created_at, updated_at, loyalty_tier, cast(null as string) as order_id, cast(null as double) as order_amount,
         cast(null as string) as order_status from raw_customers
  union all
  select _row_sequence_id, entity_type, _change_type, _commit_timestamp, customer_id, null, null, null, null,
         created_at, updated_at, null, order_id, order_amount, order_status from raw_orders"""
CTES["run_events"] = """
  select 'run-' || cast(event_id as string) as run_id,
         case when event_id % 2 = 0 then 'Bronze Ingest' else 'Silver Merge' end as pipeline_name, ts as started,
         case when event_id % 9 <> 0 then ts + interval 1 minute end as ended,
         case when event_id % 9 = 0 then 'RUNNING' when event_id % 8 = 0 then 'FAILED' else 'SUCCESS' end as status,
         case when event_id % 9 <> 0 and event_id % 8 <> 0 then event_id % 50 else 0 end as records,
         case when event_id % 9 <> 0 and event_id % 8 = 0 then 'boom' end as error
  from events where event_type = 'click'"""
CTES["run_status"] = """
  select run_id, pipeline_name, started as start_time, ended as end_time,
         case when ended is not null then cast(60 as double) end as duration_seconds, status,
         cast(records as bigint) as records_processed, error as error_message from run_events"""
CTES["audit_log"] = """
  select 'silver_customers' as target_table, ingest_date as d,
         count(*) filter (where email like '%@%' and state is not null) as ok,
         count(*) filter (where email not like '%@%' or state is null) as bad from raw_customers group by all
  union all
  select 'silver_orders', ingest_date, count(*) filter (where order_amount >= 0), count(*) filter (where order_amount < 0)
  from raw_orders group by all"""

# --- layers ---------------------------------------------------------------------------------

_LANDED_C = """_row_sequence_id, entity_type, _change_type, _commit_timestamp, customer_id, first_name, last_name, email,
  state, created_at, updated_at, _bronze_ingested_at, _bronze_batch_id"""
_LANDED_O = """_row_sequence_id, entity_type, _change_type, _commit_timestamp, order_id, customer_id, order_amount,
  order_status, created_at, updated_at, _bronze_ingested_at, _bronze_batch_id"""

CTES["stg_customers"] = f"select {_LANDED_C} from raw_customers where contains(email, '@') and state is not null"
CTES["stg_orders"] = f"select {_LANDED_O} from raw_orders where order_amount >= 0"


def _history(source: str, key: str) -> str:
    """Each net change lives until the next one of its customer."""
    return f"""
  select {key} as customer_sk, customer_id, first_name, left(last_name, 1) || '.' as last_name,
         case when contains(email, '@')
              then left(email, 2) || '***@' || substring(email, strpos(email, '@') + 1)
              else '***' end as email,
         upper(trim(state)) as state, _commit_timestamp as valid_from, coalesce(until, {OPEN_END}) as valid_to,
         cast(until is null and _change_type <> 'DELETE' as integer) as is_current,
         cast(_change_type = 'DELETE' as integer) as is_deleted, _bronze_batch_id
  from (select *, lead(_commit_timestamp) over (partition by customer_id order by _commit_timestamp, _row_sequence_id) as until
        from {source} where _change_type in ('INSERT', 'UPDATE_AFTER', 'DELETE')) net"""


CTES["silver_customers"] = _history("stg_customers", "customer_id || '_' || cast(_row_sequence_id as string)")
CTES["history_by_second"] = _history("raw_customers", "customer_id || '_' || strftime(_commit_timestamp, '%Y%m%d%H%M%S')")
CTES["silver_orders"] = """
  select order_id, last.customer_id as customer_id, last.order_amount as order_amount, last.order_status as order_status,
         last.created_at as created_at, last.updated_at as updated_at, last._bronze_batch_id as _bronze_batch_id
  from (select order_id, max({'t': _commit_timestamp, 's': _row_sequence_id, 'ct': _change_type, 'customer_id': customer_id,
                              'order_amount': order_amount, 'order_status': order_status, 'created_at': created_at,
                              'updated_at': updated_at, '_bronze_batch_id': _bronze_batch_id}) as last
        from stg_orders group by order_id) g
  where last.ct <> 'DELETE'"""

_UNKNOWN = f"""select '-1' as customer_sk, 'unknown' as customer_id, 'Unknown' as first_name, 'Customer' as last_name,
  'unknown@example.com' as email, 'UNKNOWN' as state, timestamp '1970-01-01' as valid_from, {OPEN_END} as valid_to, 1 as is_current"""


def _dimension(known: str) -> str:
    return f"""
  select customer_sk, customer_id, first_name, last_name, email, state, valid_from, valid_to, is_current
  from {known} where is_deleted = 0 union all {_UNKNOWN}"""


def _facts(orders: str, dimension: str) -> str:
    return f"""
  select order_id, coalesce(d.customer_sk, '-1') as customer_sk,
         cast(strftime(o.created_at, '%Y%m%d') as integer) as date_key, order_amount, order_status, o.created_at
  from {orders} o left join {dimension} d
    on d.customer_id = o.customer_id and d.valid_from <= o.created_at and o.created_at < d.valid_to"""


CTES["dim_customers"] = _dimension("silver_customers")
CTES["fact_orders"] = _facts("silver_orders", "dim_customers")
CTES["current_customers"] = "select * from silver_customers where is_current = 1 and is_deleted = 0"


def _merged(source: str, where: str = "true") -> str:
    """History where a delete closes the last version: net changes, without writes that repeat an instant."""
    return f"""
  select md5(cid || '_' || strftime(t, '%Y-%m-%d %H:%M:%S.%f')) as customer_sk, cid as customer_id,
         trim(coalesce(first_name, '')) as first_name, trim(coalesce(last_name, '')) as last_name,
         trim(coalesce(email, '')) as email, upper(trim(coalesce(state, ''))) as state,
         t as valid_from, coalesce(nt, {OPEN_END}) as valid_to, cast(nt is null as integer) as is_current,
         cast(coalesce(ndel, false) as integer) as is_deleted,
         case when ndel then nbatch else _bronze_batch_id end as _bronze_batch_id
  from (select *, lead(t) over w as nt, lead(del) over w as ndel, lead(_bronze_batch_id) over w as nbatch
        from (select *, lag(t) over w as pt, lag(del) over w as pdel
              from (select *, trim(coalesce(customer_id, '')) as cid, _commit_timestamp as t,
                           _row_sequence_id as s, _change_type = 'DELETE' as del
                    from {source}
                    where _change_type <> 'UPDATE_BEFORE' and trim(coalesce(customer_id, '')) <> '' and {where}) a
              window w as (partition by cid order by t, s)) b
        where del or pt is null or pdel or pt <> t
        window w as (partition by cid order by t, s)) c
  where not del"""


CTES["merged_history"] = _merged("raw_customers")
CTES["history_at_cut"] = _merged("raw_customers", f"_commit_timestamp < {CUT_TS}")
CTES["history_punctual"] = _merged("raw_customers", f"not ({LATE_DAYS})")

CTES["keyed_orders"] = """
  select * from raw_orders where trim(coalesce(order_id, '')) <> '' and trim(coalesce(customer_id, '')) <> ''
    and order_amount is not null"""


def _latest_orders(source: str, keep: str, where: str = "true") -> str:
    return f"""
  select order_id, customer_id, order_amount, order_status, created_at, updated_at, _bronze_batch_id
  from {source} o
  where {where} and {keep} and not exists (
    select 1 from {source} later where later.order_id = o.order_id
      and {where.replace('_commit', 'later._commit')}
      and (later._commit_timestamp, later._row_sequence_id) > (o._commit_timestamp, o._row_sequence_id))"""


_NOT_DELETE = "_change_type <> 'DELETE'"
CTES["upserted_orders"] = _latest_orders("keyed_orders", _NOT_DELETE)
CTES["upserted_orders_at_cut"] = _latest_orders("keyed_orders", _NOT_DELETE, f"_commit_timestamp < {CUT_TS}")

CTES["flagged_customers"] = """
  select *, case when customer_id is null then 'NULL_PK'
                 when not (contains(email, '@') and contains(email, '.')) then 'INVALID_EMAIL'
                 when strlen(state) <> 2 then 'INVALID_STATE_CODE' end as _quarantine_reason from raw_customers"""
CTES["flagged_orders"] = """
  select *, case when order_id is null then 'NULL_PK' when order_amount < 0 then 'NEGATIVE_AMOUNT' end as _quarantine_reason
  from raw_orders"""
CTES["clean_customers"] = "select * exclude (_quarantine_reason) from flagged_customers where _quarantine_reason is null"
CTES["clean_orders"] = "select * exclude (_quarantine_reason) from flagged_orders where _quarantine_reason is null"


def _staged_history(where: str) -> str:
    """Versions of clean net writes, text as it came; a delete closes and flags the one before it."""
    return f"""
  select customer_id, first_name, last_name, email, state, _commit_timestamp, cast(nt is null as integer) as is_current,
         _commit_timestamp as valid_from, coalesce(nt, {OPEN_END}) as valid_to,
         cast(coalesce(nct = 'DELETE', false) as integer) as is_deleted
  from (select *, lead(_commit_timestamp) over w as nt, lead(_change_type) over w as nct from clean_customers
        where _change_type <> 'UPDATE_BEFORE' and {where}
        window w as (partition by customer_id order by _commit_timestamp, _row_sequence_id)) v
  where _change_type <> 'DELETE'"""


CTES["staged_target"] = _staged_history(f"_commit_timestamp < {CUT_TS}")
CTES["staged_history"] = _staged_history("true")
CTES["staged_batch"] = f"""
  select *, row_number() over (partition by customer_id order by _commit_timestamp, _row_sequence_id) = 1 as is_first
  from (select {_LANDED_C} from clean_customers where _change_type <> 'UPDATE_BEFORE' and _commit_timestamp >= {CUT_TS}) c"""
CTES["last_clean_orders"] = f"""
  select distinct on (order_id) {_LANDED_O} from clean_orders order by order_id, _commit_timestamp desc, _row_sequence_id desc"""


def _snapshot(until: str) -> str:
    return f"""
  select order_id, customer_id, order_amount, order_status, created_at, updated_at from (
    select distinct on (order_id) * from raw_orders where order_id is not null and _commit_timestamp < timestamp '{until}'
    order by order_id, _commit_timestamp desc, _row_sequence_id desc) s where _change_type <> 'DELETE'"""


def _customer_snapshot(until: str) -> str:
    return f"""
  select customer_id, first_name, last_name, email, state, created_at, updated_at from (
    select distinct on (customer_id) * from raw_customers
    where customer_id is not null and _commit_timestamp < timestamp '{until}'
    order by customer_id, _commit_timestamp desc, _row_sequence_id desc) s where _change_type <> 'DELETE'"""


CTES["customers_old"] = _customer_snapshot(CUT)
CTES["customers_new"] = _customer_snapshot(TODAY)
CTES["orders_old"] = _snapshot(CUT)
CTES["orders_new"] = _snapshot(TODAY)

CTES["several"] = """
  select customer_id, count(*) as versions from dim_customers where customer_id <> 'unknown' group by 1 having count(*) > 1"""
CTES["daily"] = """
  select cast(created_at as date) as order_date, count(order_id) as total_orders,
         cast(sum(cast(order_amount as decimal(18,2))) as double) as total_revenue from fact_orders group by 1"""
CTES["state_sales"] = """
  select coalesce(d.state, 'UNKNOWN') as state_code, sum(cast(f.order_amount as decimal(18,2))) as sales,
         count(f.order_id) as order_count
  from fact_orders f left join dim_customers d on d.customer_sk = f.customer_sk group by 1"""
CTES["unresolved"] = """
  select count(order_id) filter (where customer_sk = '-1') as unresolved_orders_count,
         round(count(order_id) filter (where customer_sk = '-1') * 100.0::double / nullif(count(*), 0), 2) as unresolved_percentage
  from fact_orders"""
CTES["customer_totals"] = """
  select d.customer_id, sum(cast(f.order_amount as decimal(18,2))) as spent, count(f.order_id) as orders
  from fact_orders f join dim_customers d on d.customer_sk = f.customer_sk group by 1"""

_NOT_NULL = [
    ("stg_customers", "customer_id"), ("stg_orders", "order_id"), ("silver_customers", "customer_sk"),
    ("silver_orders", "order_id"), ("dim_customers", "customer_sk"), ("fact_orders", "order_id"),
    ("fact_orders", "customer_sk"),
]
_UNIQUE = [
    ("silver_customers", "customer_sk"), ("silver_orders", "order_id"), ("dim_customers", "customer_sk"),
    ("fact_orders", "order_id"),
]


_NUMBER = "coalesce(try_cast(substr({}, 2) as bigint), 0)"
CTES["spread_facts"] = f"""
  select order_id, customer_sk, cast(strftime(moved_at, '%Y%m%d') as integer) as date_key, order_amount + (n % 8) / 1000 as order_amount,
         order_status, moved_at as created_at
  from (select *, created_at + to_months(cast(n % {SPREAD} as integer)) as moved_at
        from (select *, {_NUMBER.format('order_id')} as n from fact_orders) f) g"""
CTES["spread_growth_months"] = f"""
  select strftime(valid_from + to_months(cast({_NUMBER.format('customer_id')} % {SPREAD} as integer)), '%Y-%m') as registration_month,
         count(customer_id) as new_customers
  from current_customers group by 1"""
CTES["faulty_facts"] = f"""
  select case when n % 70 <> 0 then order_id end as order_id,
         case when n % 15 = 0 then 'ghost' when n % 47 <> 0 then customer_sk end as customer_sk,
         case when n % 30 = 0 then 'Lost' else order_status end as order_status
  from (select *, {_NUMBER.format('order_id')} as n from fact_orders) f
  union all select order_id, customer_sk, order_status from fact_orders where {_NUMBER.format('order_id')} % 50 = 0"""
CTES["faulty_dimension"] = f"""
  select customer_sk from dim_customers
  union all select customer_sk from dim_customers where {_NUMBER.format('customer_id')} % 20 = 1"""
CTES["faulty_orders"] = f"""
  select order_id, case when {_NUMBER.format('order_id')} % 40 = 0 then -order_amount - 1 else order_amount end as order_amount from silver_orders"""


def _test(table: str, column: str, name: str, failures: str) -> str:
    return f"select '{table}' as table_name, '{column}' as column_name, '{name}' as test_name, ({failures}) as failures"


CTES["t_not_null"] = " union all ".join(
    _test(t, c, "not_null", f"select count(*) from {t} where {c} is null") for t, c in _NOT_NULL
)
CTES["t_unique"] = " union all ".join(
    _test(t, c, "unique", f"select count(*) from (select {c} from {t} where {c} is not null group by 1 having count(*) > 1) u")
    for t, c in _UNIQUE
)
CTES["t_relationships"] = _test(
    "fact_orders", "customer_sk", "relationships",
    "select count(*) from fact_orders f where f.customer_sk is not null and not exists"
    " (select 1 from dim_customers d where d.customer_sk = f.customer_sk)",
)
CTES["t_accepted"] = _test(
    "fact_orders", "order_status", "accepted_values",
    "select count(*) from fact_orders where order_status not in ('Pending', 'Shipped', 'Delivered', 'Cancelled')",
)
CTES["t_negative"] = _test(
    "silver_orders", "order_amount", "non_negative", "select count(*) from silver_orders where order_amount < 0"
)

# --- queries ----------------------------------------------------------------------------------

_SHOWN_END = "strftime(valid_to, '%Y-%m-%d %H:%M:%S.%f') as valid_to"
_AS_TEXT = f"replace ({_SHOWN_END})"

Q: dict[str, str] = {}

Q["cdc_incremental_extract"] = f"""select * from change_log where _row_sequence_id >
  (select max(_row_sequence_id) from change_log where _commit_timestamp < {CUT_TS})"""
Q["cdc_high_water_mark"] = """select max(_row_sequence_id) as last_processed_id,
  max(_commit_timestamp) as last_processed_timestamp from change_log"""
Q["cdc_entity_split"] = "select * exclude (loyalty_tier) from change_log"
_LANDED_LOG = f"""select * exclude (_bronze_ingested_at, _bronze_batch_id, ingest_date), null as order_id, cast(null as double) as order_amount,
    null as order_status, {STAMP_TS} as _bronze_ingested_at, '%s' as _bronze_batch_id, cast({STAMP_TS} as date) as ingest_date
  from raw_customers
  union all by name
  select * exclude (_bronze_ingested_at, _bronze_batch_id, ingest_date), {STAMP_TS} as _bronze_ingested_at,
    '%s' as _bronze_batch_id, cast({STAMP_TS} as date) as ingest_date from raw_orders"""
Q["bronze_json_ingest"] = _LANDED_LOG % ("batch-one", "batch-one")
Q["bronze_full_scan"] = "select * from raw_customers union all by name select * from raw_orders"
Q["bronze_pending_batches"] = f"""select distinct _bronze_batch_id from
  (select _bronze_batch_id, ingest_date from raw_customers union all select _bronze_batch_id, ingest_date from raw_orders) b
  where ingest_date >= date '{CUT}'"""


def _week(day: str) -> str:
    """The weekly batch of a day."""
    return f"'week-' || cast(least(datediff('day', date '{FIRST_DAY}', {day}) // 7, {WEEKS - 1}) as string)"


_WEEK = _week("cast(_commit_timestamp as date)")
Q["ledger_full_scan"] = f"""select * replace ({_WEEK} as _bronze_batch_id) from
  (select * from raw_customers union all by name select * from raw_orders) l"""
Q["ledger_schema_log"] = f"""select entity_type, 'loyalty_tier' as column_name, min({_WEEK}) as since_batch
  from raw_customers where loyalty_tier is not null group by 1"""
Q["ledger_changes_after"] = Q["cdc_incremental_extract"]
Q["ledger_pending"] = f"""select week as _bronze_batch_id, min(cast(_commit_timestamp as date)) as first_date,
  max(cast(_commit_timestamp as date)) as last_date, count(*) as row_count, min(_row_sequence_id) as first_id, max(_row_sequence_id) as last_id
  from (select *, {_WEEK} as week from change_log) l where week not in ('week-0', 'week-1') group by week"""
Q["bronze_conform"] = """select * exclude (ingest_date) from raw_customers
  union all by name select * exclude (ingest_date) from raw_orders"""
Q["schema_drift_report"] = """select * from (select 'customers' as entity_type, 'loyalty_tier' as column_name,
  count(loyalty_tier) as rows_filled from raw_customers) c where rows_filled > 0"""

Q["stg_customers"] = "select * from stg_customers"
Q["stg_orders"] = "select * from stg_orders"
Q["quarantine_customers"] = f"""select {_LANDED_C}, 'Invalid email format or missing state code' as quarantine_reason
  from raw_customers where not contains(email, '@') or state is null"""
Q["quarantine_orders"] = f"""select {_LANDED_O}, 'Negative order amount' as quarantine_reason
  from raw_orders where order_amount < 0"""
Q["dq_customers"] = f"""select *, true as _dq_failed, {STAMP_TS} as _quarantined_at from flagged_customers
  where _quarantine_reason is not null"""
Q["dq_orders"] = f"""select *, true as _dq_failed, {STAMP_TS} as _quarantined_at from flagged_orders
  where _quarantine_reason is not null"""
Q["dq_customers_clean"] = "select * from clean_customers"
Q["dq_orders_clean"] = "select * from clean_orders"
Q["dq_passthrough"] = "select *, 'clean' as side from events"
Q["dq_quarantine_append"] = f"""select * replace (case when ingest_date >= date '{CUT}' then loyalty_tier end as loyalty_tier)
  from ({Q["dq_customers"]}) c union all by name {Q["dq_orders"]}"""
Q["dq_run_counts"] = """
  select 'silver_customers' as target_table, count(*) filter (where _quarantine_reason is null) as records_processed,
         count(*) filter (where _quarantine_reason is not null) as records_quarantined from flagged_customers
  union all
  select 'silver_orders', count(*) filter (where _quarantine_reason is null),
         count(*) filter (where _quarantine_reason is not null) from flagged_orders"""
Q["quarantine_reason_counts"] = """
  select entity_type, _quarantine_reason, count(*) as records from
    (select entity_type, _quarantine_reason from flagged_customers union all
     select entity_type, _quarantine_reason from flagged_orders) f
  where _quarantine_reason is not null group by 1, 2"""


def _json(fields: list[str], table: str) -> str:
    times = {"_commit_timestamp", "created_at", "updated_at", "_bronze_ingested_at"}
    items = [f"'{f}': " + (f"strftime({f}, '%Y-%m-%d %H:%M:%S.%f')" if f in times else f) for f in fields]
    return f"cast(to_json({{{', '.join(items)}}}) as string)"


_C_FIELDS = [c.strip() for c in _LANDED_C.split(",")] + ["loyalty_tier", "ingest_date"]
_O_FIELDS = [c.strip() for c in _LANDED_O.split(",")] + ["ingest_date"]
Q["silver_key_quarantine"] = f"""
  select 'customers' as entity_type, 'Missing customer_id' as reason, {_json(_C_FIELDS, 'raw_customers')} as record,
         {STAMP_TS} as quarantined_at from raw_customers where trim(coalesce(customer_id, '')) = ''
  union all
  select 'orders', case when trim(coalesce(order_id, '')) = '' then 'Missing order_id'
                        when trim(coalesce(customer_id, '')) = '' then 'Missing customer_id'
                        else 'Invalid order_amount: Null order amount' end,
         {_json(_O_FIELDS, 'raw_orders')}, {STAMP_TS} from raw_orders
  where trim(coalesce(order_id, '')) = '' or trim(coalesce(customer_id, '')) = '' or order_amount is null"""

Q["silver_customers"] = f"select * {_AS_TEXT} from silver_customers"
Q["silver_customers_ts_key"] = f"select * exclude (_bronze_batch_id) {_AS_TEXT} from history_by_second"
Q["silver_orders"] = "select * from silver_orders"
Q["scd2_merge_batch"] = f"select * {_AS_TEXT} from merged_history"
Q["scd2_late_events"] = f"""
  select _row_sequence_id, customer_id, _commit_timestamp, late_reason, _bronze_batch_id from (
    select e.*, case
        when e._change_type <> 'DELETE' and e._commit_timestamp <= h.valid_from then 'NOT_AFTER_OPEN_VERSION'
        when e._change_type = 'DELETE' and e._commit_timestamp < h.valid_from then 'BEFORE_OPEN_VERSION'
        when e._change_type <> 'DELETE' and lag(e._commit_timestamp) over w = e._commit_timestamp
             and lag(e._change_type) over w <> 'DELETE' then 'SAME_INSTANT' end as late_reason
    from raw_customers e left join history_punctual h on h.customer_id = e.customer_id and h.is_current = 1
    where e._change_type <> 'UPDATE_BEFORE' and e.customer_id is not null and {LATE_DAYS.replace('_commit', 'e._commit')}
    window w as (partition by e.customer_id order by e._commit_timestamp, e._row_sequence_id)) x
  where late_reason is not null"""
_STAGED = "_row_sequence_id, entity_type, _change_type, _commit_timestamp, customer_id, first_name, last_name, email, state, created_at, updated_at"
Q["scd2_staged_updates"] = f"""
  select {_STAGED}, customer_id as merge_key from staged_batch where is_first
  union all
  select {_STAGED}, cast(null as string) from staged_batch
  where _change_type <> 'DELETE'
    and (not is_first or customer_id in (select customer_id from staged_target where is_current = 1))"""
# merging the second part of the log must give the history of the whole log
Q["scd2_staged_merge"] = """
  select * replace (strftime(valid_to, '%Y-%m-%d %H:%M:%S.%f') as valid_to) from staged_history"""
Q["orders_upsert_batch"] = "select * from upserted_orders"
Q["orders_merge_all"] = "select * from last_clean_orders"
Q["gold_incremental_upsert"] = f"""
  with dim_then as ({_dimension('history_at_cut')}), dim_now as ({_dimension('merged_history')}),
  facts_then as ({_facts('upserted_orders_at_cut', 'dim_then')}), facts_now as ({_facts('upserted_orders', 'dim_now')})
  select * from facts_now union all
  select * from facts_then where order_id not in (select order_id from facts_now)"""


def _snapshot_diff(entity: str, old: str, new: str, key: str) -> str:
    return f"""
  select '{entity}' as entity_type, d.* from (
    select 'INSERT' as _change_type, n.* from {new} n anti join {old} o using ({key})
    union all select 'DELETE', o.* from {old} o anti join {new} n using ({key})
    union all select 'UPDATE_BEFORE', * from (select * from {old} where {key} in (select {key} from {new}) except all select * from {new}) b
    union all select 'UPDATE_AFTER', * from (select * from {new} where {key} in (select {key} from {old}) except all select * from {old}) a) d"""


Q["cdc_snapshot_diff"] = (
    _snapshot_diff("orders", "orders_old", "orders_new", "order_id") + " union all by name "
    + _snapshot_diff("customers", "customers_old", "customers_new", "customer_id")
)
CTES["orders_next_day"] = _snapshot("2024-01-16")
Q["snapshot_diff_by_digest"] = _snapshot_diff("orders", "orders_old", "orders_next_day", "order_id")
Q["cdc_cascade_set_null"] = f"""
  with gone as (select customer_id, min(_commit_timestamp) as _commit_timestamp from raw_customers
                where _change_type = 'DELETE' and customer_id is not null and _commit_timestamp >= {CUT_TS} group by 1)
  select 'UPDATE_BEFORE' as _change_type, g._commit_timestamp, o.* from orders_old o join gone g on g.customer_id = o.customer_id
  union all
  select 'UPDATE_AFTER', g._commit_timestamp, o.* replace (cast(null as string) as customer_id)
  from orders_old o join gone g on g.customer_id = o.customer_id"""

Q["dim_customers"] = f"select * {_AS_TEXT} from dim_customers"
Q["dim_customers_current"] = f"select * {_AS_TEXT} from current_customers"
Q["dim_date"] = """
  select cast(strftime(d, '%Y%m%d') as integer) as date_key, cast(d as date) as calendar_date, cast(day(d) as integer) as day,
         cast(month(d) as integer) as month, cast(year(d) as integer) as year, cast(quarter(d) as integer) as quarter
  from (select unnest(generate_series(date_trunc('year', min(created_at)),
        date_trunc('year', max(created_at)) + interval 1 year - interval 1 day, interval 1 day)) as d from silver_orders) s"""
Q["fact_orders"] = "select * from fact_orders"
Q["fact_orders_commit_time"] = """
  select o.order_id, h.customer_id as customer_sk, o.order_amount, o.order_status, o._commit_timestamp as order_timestamp
  from last_clean_orders o left join staged_history h
    on h.customer_id = o.customer_id and o._commit_timestamp between h.valid_from and h.valid_to"""
Q["late_dimension_resolution"] = Q["fact_orders"]
Q["clustered_fact_write"] = Q["fact_orders"]

Q["executive_summary"] = """select round(cast(sum(cast(order_amount as decimal(18,2))) as double), 2) as total_sales,
  count(order_id) as total_orders, count(distinct case when customer_sk <> '-1' then customer_id end) as unique_customers,
  count(distinct customer_sk) as unique_customer_keys from fact_orders left join dim_customers using (customer_sk)"""
# the one order without an id is not counted, and neither is it in the per-key counts
Q["sales_by_state"] = "select state_code, round(cast(sales as double), 2) as sales_amount, order_count from state_sales"
Q["order_status_breakdown"] = "select order_status, count(order_id) as order_count from fact_orders group by 1"
Q["unresolved_orders"] = "select * from unresolved"
Q["unresolved_alert_level"] = """select *, case when unresolved_percentage > 10 then 'critical'
  when unresolved_orders_count > 0 then 'warning' else 'ok' end as alert_level from unresolved"""
Q["agg_daily_sales"] = "select * from daily"
Q["daily_revenue_trend"] = "select order_date, total_revenue from daily"
Q["daily_orders_volume"] = "select order_date, total_orders from daily"
Q["agg_revenue_trends"] = """select customer_sk, cast(sum(cast(order_amount as decimal(18,2))) as double) as total_spent,
  cast(min(created_at) as date) as first_order_date, cast(max(created_at) as date) as last_order_date,
  count(distinct cast(created_at as date)) as active_days from fact_orders group by 1"""
Q["agg_revenue_by_state"] = """select coalesce(c.state, 'UNKNOWN') as state, cast(sum(t.spent) as double) as state_revenue,
  cast(sum(t.orders) as bigint) as state_orders from customer_totals t left join current_customers c using (customer_id) group by 1"""
CTES["growth"] = """select strftime(valid_from, '%Y-%m') as registration_month, count(customer_id) as new_customers
  from current_customers group by 1"""
Q["agg_customer_growth"] = "select * from growth"
Q["customer_growth_cumulative"] = """select g.registration_month as join_date, g.new_customers,
  cast((select sum(e.new_customers) from growth e where e.registration_month <= g.registration_month) as bigint) as cumulative_customers
  from growth g"""
Q["top_customers_ltv"] = """select t.customer_id, c.first_name, c.last_name, c.state, t.orders as total_orders,
  cast(t.spent as double) as lifetime_value from customer_totals t join current_customers c using (customer_id)
  order by lifetime_value desc, customer_id, first_name, last_name, state limit 10"""
Q["sales_by_quarter"] = """select cast(year(created_at) as integer) as year, cast(quarter(created_at) as integer) as quarter,
  round(cast(sum(cast(order_amount as decimal(18,2))) as double), 2) as sales_amount, count(order_id) as order_count
  from fact_orders group by 1, 2"""
_ROUNDED = "cast(round(sum(cast(order_amount as decimal(28,10))), 2) as double)"
_EXACT = "cast(sum(cast(order_amount as decimal(28,10))) as double)"
Q["spread_daily_sales"] = f"""select cast(created_at as date) as order_date, count(order_id) as total_orders, {_EXACT} as total_revenue
  from spread_facts group by 1"""
Q["spread_revenue_trends"] = f"""select customer_sk, {_EXACT} as total_spent, cast(min(created_at) as date) as first_order_date,
  cast(max(created_at) as date) as last_order_date, count(distinct cast(created_at as date)) as active_days from spread_facts group by 1"""
Q["spread_sales_by_quarter"] = f"""select cast(year(created_at) as integer) as year, cast(quarter(created_at) as integer) as quarter,
  {_ROUNDED} as sales_amount, count(order_id) as order_count from spread_facts group by 1, 2"""
Q["spread_growth"] = """select registration_month as join_date, new_customers,
  cast(sum(new_customers) over (order by registration_month) as bigint) as cumulative_customers from spread_growth_months"""
Q["refreshed_history"] = Q["silver_customers"]
Q["refreshed_facts_table"] = Q["fact_orders"]
Q["refreshed_quarantine"] = Q["quarantine_customers"]
Q["refreshed_state_view"] = Q["sales_by_state"]
Q["interleaved_fact_write"] = Q["fact_orders"]
Q["dashboard_document"] = f"""
  with s as (select cast(sum(cast(order_amount as decimal(18,2))) as decimal(18,2)) as a, count(order_id) as n,
                    count(distinct customer_sk) as k, count(distinct case when customer_sk <> '-1' then customer_id end) as c
             from fact_orders left join dim_customers using (customer_sk)),
  st as (select '[' || string_agg('{{"state_code":"' || state_code || '","sales_amount":' || cast(sales as decimal(18,2))
           || ',"order_count":' || order_count || '}}', ',' order by sales desc, state_code) || ']' as j from state_sales),
  os as (select '[' || string_agg('{{"order_status":"' || order_status || '","order_count":' || n || '}}', ','
           order by n desc, order_status) || ']' as j
         from (select order_status, count(order_id) as n from fact_orders group by 1) b),
  un as (select unresolved_orders_count as n, cast(unresolved_percentage as decimal(18,2)) as p from unresolved),
  rr as (select * from run_status order by start_time desc, run_id limit 10),
  rj as (select '[' || string_agg('{{"run_id":"' || run_id || '","pipeline_name":"' || pipeline_name || '","start_time":"'
           || strftime(start_time, '%Y-%m-%d %H:%M:%S.%f') || '","status":"' || status || '","records_processed":'
           || records_processed || '}}', ',' order by start_time desc, run_id desc) || ']' as j from rr)
  select '{{"executive_summary":{{"total_sales":' || s.a || ',"total_orders":' || s.n || ',"unique_customers":' || s.c
    || ',"unique_customer_keys":' || s.k || '}},"sales_by_state":' || st.j || ',"order_status_breakdown":' || os.j || ',"unresolved_orders":{{"count":' || un.n
    || ',"percentage":' || un.p || '}},"pipeline_runs":' || rj.j || ',"generated_at":"{STAMP}"}}' as document
  from s, st, os, un, rj"""

Q["test_not_null"] = "select * from t_not_null"
Q["test_unique"] = "select * from t_unique"
Q["test_relationships_customer_sk"] = "select * from t_relationships"
Q["test_accepted_status"] = "select * from t_accepted"
Q["test_non_negative_amount"] = "select order_id, order_amount from silver_orders where order_amount < 0"
Q["check_orphan_facts"] = """select count(*) as orphaned_count from fact_orders
  where customer_sk not in (select customer_sk from dim_customers)"""
Q["multi_version_customers"] = f"""select customer_id, versions, customer_sk, email, state, valid_from, {_SHOWN_END}
  from dim_customers join several using (customer_id)"""
Q["multi_version_orders"] = """select d.customer_id, f.order_id, f.customer_sk, f.order_amount, f.created_at
  from fact_orders f join dim_customers d on d.customer_sk = f.customer_sk join several v on v.customer_id = d.customer_id"""
Q["dq_test_summary"] = """select *, case failures when 0 then 'pass' else 'fail' end as status from (
  select * from t_not_null union all select * from t_unique union all select * from t_relationships
  union all select * from t_accepted union all select * from t_negative) t"""

_FAULTY = {"fact_orders": "faulty_facts", "dim_customers": "faulty_dimension", "silver_orders": "faulty_orders"}


def _of_faulty(text: str) -> str:
    for table, faulty in _FAULTY.items():
        text = re.sub(rf"from {table}\b", f"from {faulty}", text)
    return text


Q["dq_test_findings"] = "select *, case failures when 0 then 'pass' else 'fail' end as status from (" + " union all ".join(
    _of_faulty(CTES[t]) for t in ("t_not_null", "t_unique", "t_relationships", "t_accepted", "t_negative")
) + ") t"
Q["orphan_findings"] = _of_faulty(Q["check_orphan_facts"].replace("from dim_customers)", "from dim_customers where customer_sk is not null)"))
Q["negative_amount_findings"] = _of_faulty(Q["test_non_negative_amount"])

Q["audit_append"] = f"""
  select 'silver_processing' as pipeline_name, 'silver' as layer, c.*, r.status, r.error_message, {STAMP_TS} as start_time,
         timestamp '2024-02-01 00:01:30.250' as end_time, cast(90.25 as double) as duration_seconds
  from ({Q['dq_run_counts']}) c, (values ('SUCCESS', ''), ('FAILED', 'boom')) as r(status, error_message)"""
Q["pipeline_run_status"] = "select * from run_status"
Q["recent_pipeline_runs"] = "select * from run_status order by start_time desc, run_id limit 10"
Q["failed_runs"] = """select pipeline_name as pipeline, run_id, start_time as execution_time, end_time as failed_at,
  error_message as error from run_status where status = 'FAILED' order by start_time desc, run_id limit 5"""
Q["duration_trend"] = """select cast(d as timestamp) as start_time, 'silver_processing' as pipeline_name, 'silver' as layer,
  cast(300 as double) as duration_seconds from audit_log where ok % 7 <> 0"""
Q["dq_status_last_7_days"] = f"""select case when bad > 0 then 'Quarantined' else 'Clean' end as record_status,
  cast(sum(ok) as bigint) as total_clean, cast(sum(bad) as bigint) as total_quarantined
  from audit_log where d >= date '{TODAY}' - 7 group by 1"""

Q["dq_status_hourly"] = f"""
  with h as (
    select date_trunc('hour', _commit_timestamp) as d, count(*) filter (where email like '%@%' and state is not null) as ok,
           count(*) filter (where email not like '%@%' or state is null) as bad from raw_customers group by 1
    union all
    select date_trunc('hour', _commit_timestamp), count(*) filter (where order_amount >= 0), count(*) filter (where order_amount < 0)
    from raw_orders group by 1)
  select case when bad > 0 then 'Quarantined' else 'Clean' end as record_status,
    cast(sum(ok) as bigint) as total_clean, cast(sum(bad) as bigint) as total_quarantined
  from h where d >= date '{TODAY}' - 7 group by 1"""

Q["stream_bronze_ingest"] = f"""
  select * replace (case when _commit_timestamp < {CUT_TS} then 'stream-0' else 'stream-1' end as _bronze_batch_id)
  from ({_LANDED_LOG % ('', '')}) l"""
Q["stream_scd2_apply"] = f"select * exclude (_bronze_batch_id) {_AS_TEXT} from merged_history"
_WEEK_BATCH = f"{_week('cast(substr(_bronze_batch_id, 7) as date)')} as _bronze_batch_id"
CTES["dim_of_batches"] = _dimension("merged_history")
CTES["facts_of_batches"] = _facts("upserted_orders", "dim_of_batches")
Q["ledger_history"] = f"select * replace ({_WEEK_BATCH}, {_SHOWN_END}) from merged_history"
Q["ledger_orders"] = f"select * replace ({_WEEK_BATCH}) from upserted_orders"
Q["ledger_facts"] = "select * from facts_of_batches"
Q["stream_orders_apply"] = "select * exclude (_bronze_batch_id) from upserted_orders"
_REFUSED_KEYS = """
  select entity_type, 'Missing customer_id' as reason, _row_sequence_id from raw_customers where coalesce(trim(customer_id), '') = ''
  union all
  select entity_type, case when coalesce(trim(order_id), '') = '' then 'Missing order_id'
                           when coalesce(trim(customer_id), '') = '' then 'Missing customer_id'
                           else 'Invalid order_amount: Null order amount' end, _row_sequence_id
  from raw_orders where coalesce(trim(order_id), '') = '' or coalesce(trim(customer_id), '') = '' or order_amount is null"""
Q["stream_quarantine"] = _REFUSED_KEYS
Q["stream_late_events"] = """
  select _row_sequence_id, customer_id, _commit_timestamp, 'SAME_INSTANT' as late_reason
  from (select *, lag(_commit_timestamp) over w as pt, lag(_change_type) over w as pct from raw_customers
        where customer_id is not null and _change_type <> 'UPDATE_BEFORE'
        window w as (partition by customer_id order by _commit_timestamp, _row_sequence_id)) e
  where _change_type <> 'DELETE' and pct <> 'DELETE' and pt = _commit_timestamp"""
# the planted misfits of the feed: see _write_misfits
_MISFITS = """
  select * exclude (entity_type), case when event_no % 31 = 0 then null when event_no % 47 = 0 then 'suppliers' else entity_type end as entity_type,
         case when entity_type <> 'orders' then null when event_no % 23 = 0 then 'about ' || event_no
              when event_no % 37 = 0 then '1e19' when event_no % 41 = 0 then 'NaN' end as odd_amount,
         case when event_no % 13 = 0 and entity_type = 'customers' then '555-' || cast(event_no as string) end as phone
  from (select *, cast(floor(_row_sequence_id / 10) as bigint) as event_no from change_log) l"""
_MISFIT_REASONS = f"""
  select *, case when entity_type is null then 'Missing entity_type' when event_no % 43 = 0 then 'Missing _change_type'
                 when odd_amount is not null then 'Invalid order_amount: ' || chr(39) || odd_amount || chr(39) end as reason
  from ({_MISFITS}) o"""
Q["bronze_misfit_ingest"] = f"""
  with m as ({_MISFIT_REASONS})
  select 'landed' as side, entity_type, _row_sequence_id, order_amount, phone, null as reason, 1 as n from m
  where reason is null and entity_type <> 'suppliers'
  union all
  select 'refused', entity_type, _row_sequence_id, null, null, reason, 1 from m where reason is not null
  union all
  select 'unknown', entity_type, null, null, null, null, count(*) from m where reason is null and entity_type = 'suppliers' group by 2
  union all
  select 'refused', null, null, null, null, 'Unreadable', 1 from (select distinct floor(event_no / 500) from m) c
  union all
  select 'refused', null, null, null, null, 'Unreadable', 1"""
Q["schema_drift_unknown"] = f"""
  with m as (select * from ({_MISFIT_REASONS}) r where reason is null and entity_type in ('customers', 'orders'))
  select * from (select entity_type, 'loyalty_tier' as column_name, count(loyalty_tier) as rows_filled from m group by 1
                 union all select entity_type, 'phone', count(phone) from m group by 1) d where rows_filled > 0"""
_COUNTED = {
    "silver_customers": "silver_customers", "silver_orders": "silver_orders", "dim_customers": "dim_customers",
    "fact_orders": "fact_orders", "dim_date": f"({Q['dim_date']}) x", "agg_daily_sales": "daily",
    "agg_revenue_trends": f"({Q['agg_revenue_trends']}) x", "agg_revenue_by_state": f"({Q['agg_revenue_by_state']}) x",
    "agg_customer_growth": "growth", "quarantine_customers": f"({Q['quarantine_customers']}) x",
    "quarantine_orders": f"({Q['quarantine_orders']}) x",
}
Q["full_pipeline"] = " union all ".join(
    f"select '{name}' as table_name, (select count(*) from {table}) as row_count" for name, table in _COUNTED.items()
)


Q["pipeline_audit"] = """
  select * from (
    select 'silver' as layer, 'silver_customers' as target_table, 'SUCCESS' as status,
           count(*) filter (where email like '%@%' and state is not null) as records_processed,
           count(*) filter (where email not like '%@%' or state is null) as records_quarantined from raw_customers
    union all select 'silver', 'silver_customers (neither side)', 'SUCCESS', count(*), 0 from raw_customers
              where email is null and state is not null
    union all select 'silver', 'silver_orders', 'SUCCESS', count(*) filter (where order_amount >= 0),
              count(*) filter (where order_amount < 0) from raw_orders
    union all select 'silver', 'silver_orders (neither side)', 'SUCCESS', count(*), 0 from raw_orders where order_amount is null
    union all select 'gold', 'fact_orders', 'SUCCESS', count(*), 0 from fact_orders
    union all select 'gold', 'agg_daily_sales', 'SUCCESS', count(*), 0 from daily) a"""


def _names_in(text: str) -> set[str]:
    return set(re.findall(r"[a-z_][a-z_0-9]*", text)) & set(CTES)


def _needed(text: str) -> list[str]:
    """The expressions a query needs, those without dependencies first."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for other in sorted(_names_in(CTES[name]) - {name}):
            visit(other)
        order.append(name)

    for name in sorted(_names_in(text)):
        visit(name)
    return order


def _complete(text: str) -> str:
    shared = [f"{n} as ({CTES[n]})" for n in _needed(text)]
    body = text.strip()
    own = body[5:] if body.startswith("with ") else None
    if not shared:
        return body
    return "with " + ",\n".join(shared) + (",\n" + own if own else "\n" + body)


ORACLES: dict[str, str] = {name: _complete(text) for name, text in Q.items()}
