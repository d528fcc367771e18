"""The registered queries once more, as SQL for an independent engine.

Written straight from the meaning of each result, without the rewrites the Spark
plans use. Rates are formed from whole numbers so that rounding half away from zero
is exact: ``cast((2 * 100 * 100 * a + b) // (2 * b) as double) / 100``.
"""

from __future__ import annotations

from trailmart.operators.quality import COLUMN_TESTS, ROW_CHECKS
from trailmart.schemas import EVENT_TYPES, EXPERIMENT_NAME, LANDING_COLUMNS, SOURCE_SYSTEM

MINUTE = 60_000_000
# Fixed values, stated here once more so that a change on the other side shows.
PRICE_QUANTILES = (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
VALIDATED_COLUMNS = ("event_time", "event_type", "product_id", "price", "user_id")


def hundredths(numerator: str, denominator: str) -> str:
    """``numerator / denominator`` in whole hundredths, both given as whole numbers >= 0."""
    n, d = f"cast({numerator} as hugeint)", f"nullif(cast({denominator} as hugeint), 0)"
    return f"((200 * {n} + {d}) // (2 * {d}))"


def rate(numerator: str, denominator: str) -> str:
    return f"cast({hundredths(numerator, denominator)} as double) / 100"


def pct(part: str, whole: str) -> str:
    return rate(f"100 * ({part})", whole)


def per_cent_of_money(cents: str, count: str) -> str:
    """Money in cents over a count, rounded to cents, as units."""
    n, d = f"cast({cents} as hugeint)", f"nullif(cast({count} as hugeint), 0)"
    return f"cast((2 * {n} + {d}) // (2 * {d}) as double) / 100"


def cents(amount: str) -> str:
    return f"cast(({amount}) * 100 as hugeint)"


def counted(prefix: str = "", suffix: str = "_events") -> str:
    return ", ".join(
        f"count(*) filter (where event_type = '{kind}') as {prefix}{kind}{suffix}" for kind in EVENT_TYPES
    )


SHAPED = """
shaped as (
  select event_id, ts as event_time,
    case event_type when 'click' then ' Cart ' when 'view' then 'VIEW' else event_type end as event_type,
    cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as product_id,
    case when event_id % 17 <> 0 then cast(value as decimal(12, 2)) end as price,
    user_id,
    case when event_id % 13 = 0 then '  '
         else 's' || (user_id - cast(user_id % 50 = 1 as integer)) || '-' || cast(ts + interval 6 hour as date)
    end as user_session
  from events)"""

RAW = (
    SHAPED
    + """,
raw_events as (
  select *, cast(product_id % 10 as bigint) as category_id from shaped),
product_dim as (
  select case when p_partkey % 11 <> 0 then p_partkey end as product_id,
    cast(p_partkey % 10 as bigint) as category_id,
    case when p_partkey % 7 = 0 then '' else p_type end as category_code,
    case when p_partkey % 5 <> 0 then p_brand end as brand
  from part)"""
)

STAGED = (
    RAW
    + """,
stg_events as (
  select event_id, event_time, cast(event_time as date) as event_date,
    cast(hour(event_time) as integer) as event_hour,
    cast(dayofweek(event_time) as integer) as event_day_of_week,
    cast(date_trunc('month', event_time) as date) as event_month,
    lower(trim(event_type)) as event_type, product_id, category_id, price, user_id,
    nullif(trim(user_session), '') as user_session
  from raw_events
  where lower(trim(event_type)) in ('view', 'cart', 'purchase')
    and event_time is not null and product_id is not null and user_id is not null)"""
)

# What the three kinds of events in a session make of it.
JOURNEYS = """
journeys (viewed, carted, purchased, journey_pattern) as (values
  (true, true, true, 'view_cart_purchase'), (true, true, false, 'view_cart_no_purchase'),
  (true, false, true, 'view_purchase_no_cart'), (true, false, false, 'view_only'),
  (false, true, true, 'cart_purchase_no_view'), (false, false, true, 'purchase_only'),
  (false, true, false, 'other'), (false, false, false, 'other'))"""

FACTS = (
    STAGED
    + ","
    + JOURNEYS
    + f""",
session_rows as (
  select user_session, min(user_id) as user_id, min(event_time) as session_start, max(event_time) as session_end,
    count(*) as events_in_session, count(distinct product_id) as unique_products_viewed, {counted()},
    sum(case event_type when 'purchase' then price else 0 end) as session_revenue
  from stg_events where user_session is not null group by user_session),
fact_sessions as (
  select *, epoch_us(session_end) - epoch_us(session_start) as micros,
    (epoch_us(session_end) - epoch_us(session_start)) / {MINUTE}.0::double as session_duration_minutes,
    cast(view_events > 0 as integer) as has_view,
    cast(cart_events > 0 as integer) as has_cart,
    cast(purchase_events > 0 as integer) as has_purchase,
    journey_pattern
  from session_rows left join journeys j on j.viewed = (view_events > 0) and j.carted = (cart_events > 0)
    and j.purchased = (purchase_events > 0)),
fact_conversions as (
  select event_id as conversion_id, event_time, event_date, event_hour, event_day_of_week, event_month,
    user_id, user_session, product_id, category_id, price as revenue,
    cast(price is null as integer) as is_missing_revenue
  from stg_events where event_type = 'purchase'),
funnel_counts as (
  select event_date, count(*) as total_events, count(distinct user_id) as active_users,
    count(distinct user_session) as sessions, {counted()},
    count(distinct user_session) filter (where event_type = 'view') as sessions_with_view,
    count(distinct user_session) filter (where event_type = 'cart') as sessions_with_cart,
    count(distinct user_session) filter (where event_type = 'purchase') as sessions_with_purchase
  from stg_events group by event_date),
fact_funnel_steps as (
  select *, {pct("cart_events", "view_events")} as event_view_to_cart_rate,
    {pct("purchase_events", "cart_events")} as event_cart_to_purchase_rate,
    {pct("purchase_events", "view_events")} as event_view_to_purchase_rate,
    {pct("sessions_with_cart", "sessions_with_view")} as session_view_to_cart_rate,
    {pct("sessions_with_purchase", "sessions_with_cart")} as session_cart_to_purchase_rate,
    {pct("sessions_with_purchase", "sessions_with_view")} as session_view_to_purchase_rate
  from funnel_counts)"""
)

DIMENSIONS = (
    FACTS
    + f""",
dim_date as (
  select date_day, cast(day(date_day) as integer) as day_of_month, cast(month(date_day) as integer) as month_number,
    cast(year(date_day) as integer) as year_number, cast(quarter(date_day) as integer) as quarter_number,
    cast(dayofweek(date_day) as integer) as day_of_week_number,
    rpad(strftime(date_day, '%A'), 9, ' ') as day_of_week_name,
    rpad(strftime(date_day, '%B'), 9, ' ') as month_name,
    cast(date_trunc('week', date_day) as date) as week_start_date,
    cast(date_trunc('month', date_day) as date) as month_start_date,
    cast(date_trunc('quarter', date_day) as date) as quarter_start_date,
    cast(date_trunc('year', date_day) as date) as year_start_date,
    cast(dayofweek(date_day) in (0, 6) as integer) as is_weekend
  from (select cast(unnest(generate_series(min(event_date), max(event_date), interval 1 day)) as date) as date_day
        from stg_events)),
dim_product as (
  select product_id, category_id, coalesce(nullif(trim(category_code), ''), 'unknown') as category_code,
    coalesce(nullif(trim(brand), ''), 'unknown') as brand,
    cast(coalesce(nullif(trim(category_code), ''), 'unknown') = 'unknown' as integer) as is_unknown_category,
    cast(coalesce(nullif(trim(brand), ''), 'unknown') = 'unknown' as integer) as is_unknown_brand
  from product_dim where product_id is not null),
by_user_events as (
  select user_id, min(event_time) as first_seen_at, max(event_time) as last_seen_at,
    min(event_date) as first_seen_date, max(event_date) as last_seen_date, count(*) as total_events,
    count(distinct user_session) as total_sessions, count(distinct product_id) as total_products_interacted,
    {counted("total_")},
    sum(price) filter (where event_type = 'purchase') as spent,
    count(price) filter (where event_type = 'purchase') as priced
  from stg_events group by user_id),
in_sessions as (
  select min(user_id) over s as owner, row_number() over (partition by user_session order by event_id) = 1 as opens,
    epoch_us(max(event_time) over s) - epoch_us(min(event_time) over s) as micros, count(*) over s as size,
    cast(bool_or(event_type = 'view') over s as integer) as viewed,
    cast(bool_or(event_type = 'cart') over s as integer) as carted,
    cast(bool_or(event_type = 'purchase') over s as integer) as purchased
  from stg_events where user_session is not null window s as (partition by user_session)),
by_user_sessions as (
  select owner as user_id, count(*) as n, sum(micros) as micros, sum(size) as events, max(viewed) as viewed,
    max(carted) as carted, max(purchased) as purchased, sum(carted) as cart_sessions, sum(purchased) as purchase_sessions
  from in_sessions where opens group by owner),
dim_user as (
  select e.* exclude (spent, priced), cast(coalesce(s.n, 0) as bigint) as session_count,
    coalesce({rate("s.micros", f"s.n * {MINUTE}")}, 0) as avg_session_duration_minutes,
    coalesce({rate("s.events", "s.n")}, 0) as avg_events_per_session,
    coalesce(viewed, 0) as has_ever_viewed, coalesce(carted, 0) as has_ever_carted,
    coalesce(purchased, 0) as has_ever_purchased, total_purchase_events as conversion_count,
    coalesce(cast(spent as double), 0) as total_revenue,
    coalesce({per_cent_of_money(cents("spent"), "priced")}, 0) as avg_purchase_value,
    case when total_purchase_events > 0 then 'purchaser' when carted = 1 then 'carted_not_purchased'
      when viewed = 1 then 'viewer_only' else 'other' end as user_segment
  from by_user_events e left join by_user_sessions s using (user_id))"""
)

GROWTH_COLUMNS = """
  f.event_date, day_of_month, month_number, month_name, year_number, quarter_number, day_of_week_number,
  day_of_week_name, week_start_date, month_start_date, is_weekend, total_events, active_users, sessions,
  view_events, cart_events, f.purchase_events as funnel_purchase_events"""

MARTS = (
    DIMENSIONS
    + f""",
daily_revenue as (
  select event_date, count(*) as purchase_events, count(distinct user_id) as purchasing_users,
    count(distinct user_session) as purchasing_sessions, sum(revenue) as total, count(revenue) as priced
  from fact_conversions group by event_date),
mart_growth_daily as (
  select {GROWTH_COLUMNS},
    coalesce(r.purchase_events, 0) as purchase_events, coalesce(purchasing_users, 0) as purchasing_users,
    coalesce(purchasing_sessions, 0) as purchasing_sessions, coalesce(cast(total as double), 0) as total_revenue,
    coalesce({per_cent_of_money(cents("total"), "priced")}, 0) as avg_purchase_value,
    sessions_with_view, sessions_with_cart, sessions_with_purchase,
    event_view_to_cart_rate, event_cart_to_purchase_rate, event_view_to_purchase_rate,
    session_view_to_cart_rate, session_cart_to_purchase_rate, session_view_to_purchase_rate,
    {per_cent_of_money(cents("coalesce(total, 0)"), "active_users")} as revenue_per_active_user,
    {per_cent_of_money(cents("coalesce(total, 0)"), "sessions")} as revenue_per_session,
    {pct("coalesce(r.purchase_events, 0)", "sessions")} as purchase_events_per_session_pct
  from fact_funnel_steps f
  left join daily_revenue r on r.event_date = f.event_date
  left join dim_date d on d.date_day = f.event_date),
attribution as (
  select c.event_date, c.event_month, c.category_id, coalesce(p.category_code, 'unknown') as category_code,
    coalesce(p.brand, 'unknown') as brand, p.is_unknown_category, p.is_unknown_brand,
    count(*) as purchase_events, count(distinct c.user_id) as purchasing_users,
    count(distinct c.user_session) as purchasing_sessions, count(distinct c.product_id) as purchased_products,
    sum(c.revenue) as total, count(c.revenue) as priced, min(c.revenue) as low, max(c.revenue) as high
  from fact_conversions c left join dim_product p using (product_id)
  group by all),
mart_revenue_attribution as (
  select * exclude (total, priced, low, high), cast(total as double) as total_revenue,
    {per_cent_of_money(cents("total"), "priced")} as avg_purchase_value,
    cast(low as double) as min_purchase_value, cast(high as double) as max_purchase_value
  from attribution)"""
)


def lift(metric: str) -> str:
    """Signed change in percent against control; metrics come as whole hundredths."""
    value, control = metric, f"nullif(c_{metric}, 0)"
    size = f"((20000 * abs({value} - c_{metric}) + {control}) // (2 * {control}))"
    return f"cast(sign({value} - c_{metric}) * {size} as double) / 100"


RATE_METRICS = ("user_conversion_rate", "session_cart_rate", "session_purchase_rate")
MONEY_METRICS = ("revenue_per_user", "revenue_per_session", "avg_purchase_value")
MEANS = ("avg_session_duration_minutes", "avg_events_per_session")


def cents_per(count: str) -> str:
    d = f"nullif(cast({count} as hugeint), 0)"
    return f"((2 * revenue_cents + {d}) // (2 * {d}))"


EXPERIMENT = (
    MARTS
    + f""",
experiment_assignment as (
  select user_id, '{EXPERIMENT_NAME}' as experiment_name,
    case when bucket < 50 then 'control' else 'treatment' end as experiment_variant,
    bucket as assignment_bucket, first_seen_date as assigned_date
  from (select *, cast(cast('0x' || substr(md5(cast(user_id as varchar)), 1, 8) as bigint) % 100 as integer) as bucket
        from dim_user)),
experiment_user_metrics as (
  select a.experiment_name, a.experiment_variant, a.assignment_bucket, a.assigned_date, a.user_id,
    cast(coalesce(s.n, 0) as bigint) as total_sessions,
    coalesce({rate("s.micros", f"s.n * {MINUTE}")}, 0) as avg_session_duration_minutes,
    coalesce({rate("s.events", "s.n")}, 0) as avg_events_per_session,
    cast(coalesce(cart_sessions, 0) as bigint) as sessions_with_cart,
    cast(coalesce(purchase_sessions, 0) as bigint) as sessions_with_purchase,
    total_purchase_events as purchase_events, coalesce(cast(spent as double), 0) as total_revenue,
    coalesce({per_cent_of_money(cents("spent"), "priced")}, 0) as avg_purchase_value,
    cast(total_purchase_events > 0 as integer) as is_purchaser
  from experiment_assignment a join by_user_events using (user_id) left join by_user_sessions s using (user_id)),
variant_totals as (
  select experiment_name, experiment_variant, count(distinct user_id) as users,
    cast(sum(total_sessions) as bigint) as sessions,
    cast(sum(sessions_with_cart) as bigint) as sessions_with_cart,
    cast(sum(sessions_with_purchase) as bigint) as sessions_with_purchase,
    cast(sum(is_purchaser) as bigint) as purchasers, cast(sum(purchase_events) as bigint) as purchase_events,
    sum(cast(round(total_revenue * 100) as hugeint)) as revenue_cents,
    sum(cast(round(avg_session_duration_minutes * 100) as hugeint)) as duration_hundredths,
    sum(cast(round(avg_events_per_session * 100) as hugeint)) as events_hundredths
  from experiment_user_metrics group by all),
variant_metrics as (
  select *, {hundredths("100 * purchasers", "users")} as user_conversion_rate,
    {hundredths("100 * sessions_with_cart", "sessions")} as session_cart_rate,
    {hundredths("100 * sessions_with_purchase", "sessions")} as session_purchase_rate,
    {cents_per("users")} as revenue_per_user, {cents_per("sessions")} as revenue_per_session,
    {cents_per("purchase_events")} as avg_purchase_value,
    (2 * duration_hundredths + users) // (2 * users) as avg_session_duration_minutes,
    (2 * events_hundredths + users) // (2 * users) as avg_events_per_session
  from variant_totals),
experiment_variant_summary as (
  select experiment_name, experiment_variant, users, sessions, sessions_with_cart, sessions_with_purchase,
    purchasers, purchase_events, cast(revenue_cents as double) / 100 as total_revenue,
    {", ".join(f"cast({name} as double) / 100 as {name}" for name in (*RATE_METRICS, *MONEY_METRICS, *MEANS))}
  from variant_metrics),
beside_control as (
  select *, {", ".join(
    f"max({name}) filter (where experiment_variant = 'control') over (partition by experiment_name) as c_{name}"
    for name in (*RATE_METRICS, *MONEY_METRICS))}
  from variant_metrics),
lifts as (
  select experiment_name, experiment_variant,
    {lift("user_conversion_rate")} as user_conversion_lift_pct,
    {lift("revenue_per_user")} as revenue_per_user_lift_pct,
    {lift("revenue_per_session")} as revenue_per_session_lift_pct,
    {lift("avg_purchase_value")} as avg_purchase_value_lift_pct,
    {lift("session_cart_rate")} as session_cart_rate_lift_pct,
    {lift("session_purchase_rate")} as session_purchase_rate_lift_pct,
    case when experiment_variant = 'control' then 'baseline' else
      case sign(user_conversion_rate - c_user_conversion_rate) + sign(revenue_per_user - c_revenue_per_user)
        when 2 then 'positive_lift' when -2 then 'negative_lift' else 'mixed_result' end
    end as experiment_result_status
  from beside_control),
mart_experiment_results as (
  select * from experiment_variant_summary join lifts using (experiment_name, experiment_variant))"""
)

# Text rows as in a CSV, clean and with spoiled values, blanks read as NULL.
LANDING = (
    SHAPED
    + """,
clean_text as (
  select event_id, strftime(event_time, '%Y-%m-%d %H:%M:%S.%f') || ' UTC' as event_time, event_type,
    cast(product_id as varchar) as product_id, cast(product_id % 10 as varchar) as category_id,
    case when p_partkey % 7 <> 0 then p_type end as category_code,
    case when p_partkey % 5 <> 0 then p_brand || case when event_id % 19 = 0 then ' II' else '' end end as brand,
    cast(price as varchar) as price, cast(user_id as varchar) as user_id,
    nullif(trim(user_session), '') as user_session
  from shaped left join part on p_partkey = product_id),
landing as (
  select event_id, case when event_id % 47 = 0 then '12:30' when event_id % 29 = 0 then 'not a time'
      else event_time end as event_time,
    case when event_id % 41 <> 0 then event_type end as event_type,
    case when event_id % 53 = 0 then product_id || '.0' when event_id % 31 = 0 then 'x12'
      else product_id end as product_id, category_id, category_code, brand,
    case when event_id % 37 = 0 then 'n/a' else price end as price,
    case when event_id % 43 <> 0 then user_id end as user_id, user_session
  from clean_text),
broken as (
  select '2019-10-01 00:00:00 UTC,view,' || event_id as malformed from events where event_id % 97 = 0
  union all select '2019-10-01 00:00:00 UTC,view,7,7,toys,acme,1.00,5,s' || event_id || ',6,7,8'
    from events where event_id % 101 = 0
  union all select '2019-10-01 00:00:00 UTC,view,7,7,toys,"two ' || event_id from events where event_id % 103 = 0
  union all select 'lines",1.00,5,s' || event_id from events where event_id % 103 = 0)"""
)

TYPED_COLUMNS = """
    try_cast(replace(event_time, ' UTC', '') as timestamp) as event_time, lower(trim(event_type)) as event_type,
    try_cast(replace(product_id, '.0', '') as bigint) as product_id, try_cast(category_id as bigint) as category_id,
    category_code, brand, try_cast(price as decimal(12, 2)) as price, try_cast(user_id as bigint) as user_id,
    user_session"""

TYPED = (
    LANDING
    + f""",
typed as (select event_id, {TYPED_COLUMNS} from landing),
bought as (select * from typed where event_type = 'purchase'),
profile_rows as (
  select user_session, min(user_id) as user_id, min(event_time) as session_start, max(event_time) as session_end,
    count(event_type) as events_in_session,
    cast(coalesce(bool_or(event_type = 'view'), false) as integer) as has_view,
    cast(coalesce(bool_or(event_type = 'cart'), false) as integer) as has_cart,
    cast(coalesce(bool_or(event_type = 'purchase'), false) as integer) as has_purchase,
    max(epoch_us(event_time)) - min(epoch_us(event_time)) as micros
  from typed where user_session is not null group by user_session),
profile_totals as (
  select count(*) as total_sessions, sum(has_view) as sessions_with_view, sum(has_cart) as sessions_with_cart,
    sum(has_purchase) as sessions_with_purchase, sum(events_in_session) as events, sum(micros) as micros,
    count(micros) as spans
  from profile_rows)"""
)

# Every loaded event with its number in the order of files and lines.
DENSE = """select row_number() over (order by event_id) as event_id, event_time, lower(trim(event_type)) as event_type,
  product_id, category_id, cast(price as double) as price, user_id, nullif(trim(user_session), '') as user_session
from raw_events where lower(trim(event_type)) in ('view', 'cart', 'purchase')"""

LOADED = """event_time, event_type, product_id, category_id, cast(price as double) as price, user_id, user_session"""

PRODUCTS = (
    LANDING
    + """,
product_rows as (
  select try_cast(replace(product_id, '.0', '') as bigint) as product_id, try_cast(category_id as bigint) as category_id,
    coalesce(category_code, 'unknown') as category_code, coalesce(brand, 'unknown') as brand, event_id
  from landing),
product_master as (
  select * exclude (event_id) from product_rows where product_id is not null
  qualify row_number() over (partition by product_id order by event_id) = 1)"""
)


def value_counts(table: str, column: str, count: str, share: str) -> str:
    total = "sum(count(*)) over ()"
    return (
        f"select {column}, count(*) as {count}, {pct('count(*)', total)} as {share} "
        f"from {table} where {column} is not null group by {column}"
    )


# Names of the distinct counts and the columns they count.
CARDINALITIES = {
    "unique_users": "user_id",
    "unique_sessions": "user_session",
    "unique_products": "product_id",
    "unique_categories": "category_id",
    "unique_category_codes": "category_code",
    "unique_brands": "brand",
}


def distinct_by(column: str, name: str) -> str:
    return (
        f"select {column} as {name}, count(distinct user_id) as active_users, "
        "count(distinct user_session) as sessions from stg_events group by 1"
    )


def as_rows(table: str, key: str, value: str, cells: dict[str, str]) -> str:
    return " union all ".join(f"select '{name}' as {key}, {text} as {value} from {table}" for name, text in cells.items())


def top(column: str) -> str:
    return (
        f"select coalesce({column}, 'unknown') as {column}, count(*) as event_count from typed "
        "group by 1 order by 2 desc, 1 limit 15"
    )


# Fifty equal-width bins over the whole cents ``c`` of ``kept``.
BINS = """, bounds as (
  select min(c) - case when min(c) = max(c) then 50 else 0 end as lo,
    max(c) + case when min(c) = max(c) then 50 else 0 end as hi from kept),
binned as (
  select least((c - lo) * 50 // nullif(hi - lo, 0) + 1, 50) as bin, count(*) as n
  from kept cross join bounds group by 1)"""
HISTOGRAM = """
select cast(b.bin as integer) as bin, round((lo + (hi - lo) / 50.0::double * (b.bin - 1)) / 100, 4) as bin_start,
  round((lo + (hi - lo) / 50.0::double * b.bin) / 100, 4) as bin_end, coalesce(n, 0) as price_count
from (select unnest(generate_series(1, 50)) as bin) b cross join bounds left join binned using (bin)"""
KEPT_CENTS = ", kept as (select cast(price * 100 as bigint) as c from bought where price is not null)"
# Prices up to the interpolated 99th percentile, in whole-number arithmetic.
KEPT_CENTS_P99 = """, ranked as (
  select cast(price * 100 as bigint) as c, row_number() over (order by price) - 1 as r, count(*) over () as n
  from bought where price is not null),
cut as (
  select min(c) * 100 + (any_value(99 * (n - 1)) % 100) * (max(c) - min(c)) as top
  from ranked where r in (99 * (n - 1) // 100, (99 * (n - 1) + 99) // 100)),
kept as (select c from ranked, cut where c * 100 <= top)"""


def test_counts(tables: tuple[str, ...]) -> str:
    """Violations per declared test and row check, one row each."""
    parts = []
    for table in tables:
        declared = COLUMN_TESTS.get(table, {})
        rules = [("not_null", name, f"{name} is null") for name in declared.get("not_null", ())]
        for name, values in declared.get("accepted_values", {}).items():
            allowed = ", ".join(repr(value) for value in values)
            rules.append(("accepted_values", name, f"{name} not in ({allowed})"))
        rules += [("check", name, f"not ({text})") for name, text in ROW_CHECKS.get(table, {}).items()]
        for rule, name, text in rules:
            parts.append(
                f"select '{table}' as table_name, '{rule}' as rule, '{name}' as column_name, "
                f"count(*) filter (where {text}) as failures from {table}"
            )
        for name in declared.get("unique", ()):
            parts.append(
                f"select '{table}', 'unique', '{name}', count(*) from "
                f"(select {name} from {table} where {name} is not null group by 1 having count(*) > 1)"
            )
    return " union all ".join(parts)


def with_(ctes: str, query: str) -> str:
    return f"with {ctes.strip()}\n{query}"


SESSION_COLUMNS = """user_session, user_id, session_start, session_end, session_duration_minutes, events_in_session,
  unique_products_viewed, has_view, has_cart, has_purchase, view_events, cart_events, purchase_events,
  cast(session_revenue as double) as session_revenue, journey_pattern"""
CONVERSIONS = "select * replace (cast(revenue as double) as revenue) from fact_conversions"
RESULT_TABLES = tuple(COLUMN_TESTS)

SQL: dict[str, str] = {
    "stg_events": with_(STAGED, "select * replace (cast(price as double) as price) from stg_events"),
    "fact_sessions": with_(FACTS, f"select {SESSION_COLUMNS} from fact_sessions"),
    "fact_funnel_steps": with_(FACTS, "select * from fact_funnel_steps"),
    "fact_conversions": with_(FACTS, CONVERSIONS),
    "dim_date": with_(DIMENSIONS, "select * from dim_date"),
    "dim_product": with_(DIMENSIONS, f"select *, '{SOURCE_SYSTEM}' as source_system from dim_product"),
    "dim_user": with_(DIMENSIONS, "select * from dim_user"),
    "mart_growth_daily": with_(MARTS, "select * from mart_growth_daily"),
    "mart_revenue_attribution": with_(MARTS, "select * from mart_revenue_attribution"),
    "mart_experiment_results": with_(EXPERIMENT, "select * from mart_experiment_results"),
    "top_category_brand": with_(
        MARTS,
        "select category_code, brand, cast(sum(total) as double) as revenue, "
        "cast(sum(purchase_events) as bigint) as purchases from attribution "
        "group by category_code, brand order by revenue desc nulls first, category_code, brand limit 20",
    ),
    "top_attribution_rows": with_(
        MARTS,
        "select * from mart_revenue_attribution order by total_revenue desc nulls first, event_date, event_month, "
        "category_id, category_code, brand, is_unknown_category nulls last, is_unknown_brand nulls last limit 10",
    ),
    "attribution_row_count": with_(MARTS, "select count(*) as total_rows from mart_revenue_attribution"),
    "daily_revenue": with_(
        MARTS,
        "select event_date, purchase_events, purchasing_users, purchasing_sessions, "
        f"cast(total as double) as total_revenue, {per_cent_of_money(cents('total'), 'priced')} as avg_purchase_value "
        "from daily_revenue",
    ),
    "distinct_by_day": with_(STAGED, distinct_by("event_date", "event_date")),
    "distinct_by_month": with_(STAGED, distinct_by("event_month", "event_month")),
    "clustered_days": with_(
        STAGED,
        "select event_type, count(*) as event_count from stg_events "
        "where event_date <= (select min(cast(event_time as date)) + 2 from raw_events) group by 1",
    ),
    "journey_distribution": with_(
        FACTS, value_counts("fact_sessions", "journey_pattern", "session_count", "session_pct")
    ),
    "user_segments": with_(DIMENSIONS, value_counts("dim_user", "user_segment", "user_count", "user_pct")),
    "experiment_assignment": with_(EXPERIMENT, "select * from experiment_assignment"),
    "experiment_user_metrics": with_(EXPERIMENT, "select * from experiment_user_metrics"),
    "experiment_variant_summary": with_(EXPERIMENT, "select * from experiment_variant_summary"),
    "csv_scan": with_(
        LANDING,
        "select * exclude (event_id), null as malformed from landing union all by name select * from broken",
    ),
    "load_strict": with_(
        RAW,
        "select event_time, lower(trim(event_type)) as event_type, product_id, category_id, "
        "cast(price as double) as price, user_id, nullif(trim(user_session), '') as user_session "
        "from raw_events where lower(trim(event_type)) in ('view', 'cart', 'purchase')",
    ),
    "load_dense_keys": with_(RAW, DENSE),
    "append_load": with_(RAW, DENSE),
    "append_products": with_(
        PRODUCTS.replace("from landing)", "from clean_text)"),
        f"select *, '{SOURCE_SYSTEM}' as source_system from product_master",
    ),
    "quoted_scan": with_(
        LANDING,
        "select * exclude (event_id) replace (case when event_id % 7 = 0 then 'big, \"' || coalesce(brand, '') || '\"' "
        "|| chr(10) || ',\"II\",' || chr(10) || chr(10) || ' x' else brand end as brand), null as malformed "
        "from clean_text",
    ),
    "load_permissive": with_(
        TYPED,
        f"select {LOADED} from typed where event_time is not null and event_type is not null "
        "and product_id is not null and user_id is not null",
    ),
    "load_rejected": with_(
        TYPED,
        "select l.* exclude (event_id), null as malformed, case when t.event_time is null then 'event_time' "
        "when t.event_type is null then 'event_type' when t.product_id is null then 'product_id' "
        "else 'user_id' end as reason from landing l join typed t using (event_id) where t.event_time is null "
        "or t.event_type is null or t.product_id is null or t.user_id is null "
        "union all by name select malformed, 'malformed' as reason from broken",
    ),
    "load_row_count": with_(STAGED, "select count(*) as total_rows from stg_events"),
    "surrogate_keys": with_(STAGED, "select count(*) as total_rows, count(*) as distinct_keys from stg_events"),
    "product_master": with_(PRODUCTS, "select * from product_master"),
    "product_sync": with_(PRODUCTS, f"select *, '{SOURCE_SYSTEM}' as source_system from product_master"),
    "table_reload": with_(FACTS, CONVERSIONS),
    "table_append": with_(STAGED, "select event_type, count(*) as event_count from stg_events group by 1"),
    "mart_extract": with_(MARTS, "select * from mart_growth_daily"),
    "extract_attribution": with_(MARTS, "select * from mart_revenue_attribution"),
    "extract_experiment": with_(EXPERIMENT, "select * from mart_experiment_results"),
    "raw_sample_rows": "select least(count(*), 5) as sample_rows, 0::bigint as not_in_source from events",
    "product_sample_rows": "select least(count(*), 5) as sample_rows, 0::bigint as not_in_source from part",
    "random_sample": "select true as size_fits, 0::bigint as not_in_source",
    "warehouse_build": with_(
        EXPERIMENT,
        " union all ".join(
            f"select '{table}' as table_name, count(*) as total_rows from {table}" for table in RESULT_TABLES
        ),
    ),
    "dq_results": with_(EXPERIMENT, test_counts(RESULT_TABLES)),
    "validate_landing": with_(
        LANDING,
        "select 'landing' as table_name, 'accepted_values' as rule, 'event_type' as column_name, "
        "count(*) filter (where event_type not in ('view', 'cart', 'purchase')) as failures from landing union all "
        + " union all ".join(
            f"select 'landing', 'not_null', '{name}', count(*) filter (where {name} is null) from landing"
            for name in VALIDATED_COLUMNS
        )
        + " union all "
        + " union all ".join(f"select 'landing', 'required_column', '{name}', 0" for name in LANDING_COLUMNS)
        + " union all select 'landing', 'extra_column', 'note', 0 union all select 'landing', 'well_formed', 'line', 0",
    ),
    "invalid_event_types": with_(
        LANDING,
        "select event_type, count(*) as event_count from landing "
        "where event_type not in ('view', 'cart', 'purchase') group by 1",
    ),
    "raw_event_type_counts": with_(RAW, "select event_type, count(*) as event_count from raw_events group by 1"),
    "raw_time_range": with_(
        RAW, "select min(event_time) as min_event_time, max(event_time) as max_event_time from raw_events"
    ),
    "raw_null_counts": with_(
        RAW,
        "select count(*) - count(event_time) as null_event_time, count(*) - count(event_type) as null_event_type, "
        "count(*) - count(product_id) as null_product_id, count(*) - count(user_id) as null_user_id, "
        "count(*) - count(user_session) as null_user_session, count(*) - count(price) as null_price from raw_events",
    ),
    "unknown_products": with_(
        DIMENSIONS,
        "select count(*) as total_products, count(*) filter (where category_code = 'unknown') as unknown_categories, "
        "count(*) filter (where brand = 'unknown') as unknown_brands from dim_product",
    ),
    "missing_values": with_(
        TYPED,
        " union all ".join(
            f"select '{name}' as field, count(*) - count({name}) as missing_count, "
            f"{pct(f'count(*) - count({name})', 'count(*)')} as missing_pct from typed"
            for name in LANDING_COLUMNS
        ),
    ),
    "metadata_quality": with_(
        TYPED,
        " union all ".join(
            f"select '{name}' as field, count(*) - count({name}) as missing_count, "
            f"{pct(f'count(*) - count({name})', 'count(*)')} as missing_pct, "
            f"count(distinct {name}) as unique_non_null_values from typed"
            for name in ("category_code", "brand")
        ),
    ),
    "event_type_distribution": with_(TYPED, value_counts("typed", "event_type", "event_count", "event_pct")),
    "time_profile": with_(
        TYPED,
        "select count(*) filter (where event_time is null) as invalid_timestamps, min(event_time) as min_event_time, "
        "max(event_time) as max_event_time from typed",
    ),
    "daily_activity": with_(
        TYPED,
        "select cast(event_time as date) as event_date, count(event_type) as total_events, "
        "count(distinct user_id) as active_users, count(distinct user_session) as sessions "
        "from typed where event_time is not null group by 1",
    ),
    "cardinality": with_(
        TYPED,
        as_rows(
            "typed",
            "metric",
            "value",
            {metric: f"count(distinct {column})" for metric, column in CARDINALITIES.items()},
        ),
    ),
    "cardinality_sketched": with_(
        TYPED + ", months as (select cast(date_trunc('month', event_time) as date) as event_month, * from typed)",
        " union all ".join(
            f"select event_month, '{metric}' as metric, count(distinct {column}) as value, true as within_two_per_cent "
            "from months group by 1"
            for metric, column in CARDINALITIES.items()
        ),
    ),
    "top_categories": with_(TYPED, top("category_code")),
    "top_brands": with_(TYPED, top("brand")),
    "price_summary": with_(
        TYPED,
        as_rows(
            "typed",
            "statistic",
            "value",
            {
                "count": "cast(count(price) as double)",
                "mean": "round(cast(sum(price) as double) / count(price), 4)",
                "std": "round(stddev_samp(cast(price as double)), 4)",
                "min": "cast(min(price) as double)",
                "max": "cast(max(price) as double)",
                **{
                    f"{p:.0%}": f"round(quantile_cont(cast(price * 100 as double), {p}) / 100, 4)"
                    for p in PRICE_QUANTILES
                },
            },
        ),
    ),
    "purchase_summary": with_(
        TYPED,
        as_rows(
            "bought",
            "metric",
            "value",
            {
                "purchase_events": "cast(count(*) as double)",
                "purchasing_users": "cast(count(distinct user_id) as double)",
                "purchasing_sessions": "cast(count(distinct user_session) as double)",
                "sample_revenue": "cast(sum(price) as double)",
                "avg_purchase_value": per_cent_of_money(cents("sum(price)"), "count(price)"),
                "min_purchase_price": "cast(min(price) as double)",
                "max_purchase_price": "cast(max(price) as double)",
            },
        ),
    ),
    "price_histogram": with_(TYPED + KEPT_CENTS + BINS, HISTOGRAM),
    "price_histogram_p99": with_(TYPED + KEPT_CENTS_P99 + BINS, HISTOGRAM),
    "event_funnel": with_(
        TYPED + f", steps as (select {counted(suffix='')} from typed)",
        " union all ".join(
            f"select {i} as step_number, '{kind}' as funnel_step, {kind} as event_count, "
            f"{pct(kind, 'view')} as pct_of_views from steps"
            for i, kind in enumerate(EVENT_TYPES, start=1)
        ),
    ),
    "event_funnel_rates": with_(
        TYPED + f", steps as (select {counted(suffix='')} from typed)",
        as_rows(
            "steps",
            "metric",
            "value_pct",
            {
                "view_to_cart_rate": pct("cart", "view"),
                "cart_to_purchase_rate": pct("purchase", "cart"),
                "view_to_purchase_rate": pct("purchase", "view"),
            },
        ),
    ),
    "session_profile": with_(
        TYPED + "," + JOURNEYS,
        "select p.* exclude (micros), journey_pattern, "
        f"micros / {MINUTE}.0::double as session_duration_minutes from profile_rows p left join journeys j "
        "on j.viewed = (has_view = 1) and j.carted = (has_cart = 1) and j.purchased = (has_purchase = 1)",
    ),
    "session_summary": with_(
        TYPED,
        as_rows(
            "profile_totals",
            "metric",
            "value",
            {
                "total_sessions": "cast(total_sessions as double)",
                "sessions_with_view": "cast(sessions_with_view as double)",
                "sessions_with_cart": "cast(sessions_with_cart as double)",
                "sessions_with_purchase": "cast(sessions_with_purchase as double)",
                "avg_events_per_session": rate("events", "total_sessions"),
            },
        ),
    ),
    "session_funnel_rates": with_(
        TYPED,
        as_rows(
            "profile_totals",
            "metric",
            "value_pct",
            {
                "session_view_to_cart_rate": pct("sessions_with_cart", "sessions_with_view"),
                "session_cart_to_purchase_rate": pct("sessions_with_purchase", "sessions_with_cart"),
                "session_view_to_purchase_rate": pct("sessions_with_purchase", "sessions_with_view"),
            },
        ),
    ),
    "session_hash_sample": with_(
        TYPED,
        "select * exclude (event_id) replace (cast(price as double) as price) from typed where "
        "cast('0x' || substr(md5(user_session), 1, 8) as bigint) % 100 = 0",
    ),
}
SQL["session_summary_medians"] = (
    SQL["session_summary"]
    + " union all "
    + as_rows(
        "profile_totals",
        "metric",
        "value",
        {"avg_session_duration_minutes": rate("micros", f"spans * {MINUTE}")},
    )
    + " union all "
    + as_rows(
        "profile_rows",
        "metric",
        "value",
        {
            "median_events_per_session": "round(median(events_in_session), 2)",
            "median_session_duration_minutes": f"round(median(micros) / {MINUTE}.0::double, 2)",
        },
    )
)
# Days that have a priced purchase lose their unpriced ones; other days keep theirs.
SQL["partition_reload"] = with_(
    FACTS,
    "select event_date, count(*) as purchase_events, count(distinct user_id) as purchasing_users, "
    "count(distinct user_session) as purchasing_sessions, cast(sum(revenue) as double) as total_revenue, "
    f"{per_cent_of_money(cents('sum(revenue)'), 'count(revenue)')} as avg_purchase_value "
    "from (select *, count(revenue) over (partition by event_date) as priced from fact_conversions) "
    "where revenue is not null or priced = 0 group by 1",
)
