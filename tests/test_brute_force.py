"""Random events through the models against plain Python."""

from __future__ import annotations

import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from events_data import Events, products
from trailmart.operators import dimensions, experiment, facts, marts
from trailmart.operators.staging import stg_events

CENT = Decimal("0.01")


def rounded(numerator, denominator):
    return None if not denominator else (Decimal(numerator) / Decimal(denominator)).quantize(CENT, ROUND_HALF_UP)


def random_events(seed):
    rng = random.Random(seed)
    events = Events()
    for _ in range(600):
        events.add(
            f"2024-03-{rng.randint(1, 6):02d}T{rng.randrange(24):02d}:{rng.randrange(60):02d}:00.{rng.randrange(10**6):06d}",
            rng.choice(["view", " VIEW", "view", "cart", "purchase", "Purchase ", "login"]),
            user=rng.choice([1, 1, 1, 2, 3, 4, 5]),
            session=rng.choice([None, " ", "hot", "hot", *"abcdefgh"]),
            product=rng.choice([7, 7, 7, 1, 2, 3]),
            price=rng.choice([None, f"{rng.randrange(10**5) / 100:.2f}"]),
            category=rng.choice([1, 2]),
        )
    return events


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark):
    events = random_events(request.param)
    clean = stg_events(events.frame(spark)).cache()
    kept = []
    for row in events.rows:
        _, time, kind, product, category, price, user, session, _, _ = row
        kind = kind.strip().lower()
        if kind in ("view", "cart", "purchase"):
            kept.append((time, kind, product, category, price, user, (session or "").strip() or None))
    yield clean, kept
    clean.unpersist()


def grouped(rows, key):
    groups = defaultdict(list)
    for row in rows:
        groups[key(row)].append(row)
    return groups


def kinds(rows, kind):
    return [row for row in rows if row[1] == kind]


def sessions_of(kept):
    return grouped((row for row in kept if row[6]), lambda row: row[6])


def test_sessions(case):
    clean, kept = case
    expected = {}
    for name, rows in sessions_of(kept).items():
        paid = [row[4] if row[1] == "purchase" else Decimal(0) for row in rows]
        known = [amount for amount in paid if amount is not None]
        expected[name] = (
            min(row[5] for row in rows),
            len(rows),
            len({row[2] for row in rows}),
            *(len(kinds(rows, kind)) for kind in ("view", "cart", "purchase")),
            sum(known) if known else None,
            (max(row[0] for row in rows) - min(row[0] for row in rows)).total_seconds() / 60,
        )
    found = facts.fact_sessions(clean).collect()
    assert len(found) == len(expected)
    for row in found:
        *exact, length = expected[row.user_session]
        assert [
            row.user_id,
            row.events_in_session,
            row.unique_products_viewed,
            row.view_events,
            row.cart_events,
            row.purchase_events,
            row.session_revenue,
        ] == exact
        assert row.session_duration_minutes == pytest.approx(length)


def test_funnel(case):
    clean, kept = case
    days = grouped(kept, lambda row: row[0].date())
    found = {row.event_date: row for row in facts.fact_funnel_steps(clean).collect()}
    assert set(found) == set(days)
    for day, rows in days.items():
        row = found[day]
        seen = {kind: {r[6] for r in kinds(rows, kind)} - {None} for kind in ("view", "cart", "purchase")}
        assert (row.total_events, row.active_users) == (len(rows), len({r[5] for r in rows}))
        assert row.sessions == len({r[6] for r in rows} - {None})
        assert row.sessions_with_cart == len(seen["cart"])
        assert row.event_view_to_cart_rate == rounded(100 * len(kinds(rows, "cart")), len(kinds(rows, "view")))
        assert row.session_cart_to_purchase_rate == rounded(100 * len(seen["purchase"]), len(seen["cart"]))


def test_users_and_experiment(case):
    clean, kept = case
    sessions = facts.fact_sessions(clean)
    users = dimensions.dim_user(clean, sessions)
    owned = grouped(sessions_of(kept).values(), lambda rows: min(row[5] for row in rows))
    found = {row.user_id: row for row in users.collect()}
    for user, rows in grouped(kept, lambda row: row[5]).items():
        row, mine = found[user], owned.get(user, [])
        bought = kinds(rows, "purchase")
        priced = [r[4] for r in bought if r[4] is not None]
        assert row.total_sessions == len({r[6] for r in rows} - {None})
        assert row.session_count == len(mine)
        assert row.avg_events_per_session == (rounded(sum(map(len, mine)), len(mine)) or 0)
        assert (row.conversion_count, row.total_revenue) == (len(bought), sum(priced))
        assert row.avg_purchase_value == (rounded(sum(priced), len(priced)) or 0)
    results = experiment.mart_experiment_results(users, sessions).collect()
    assert sum(row.users for row in results) == len(found)
    assert sum(row.sessions for row in results) == len(sessions_of(kept))
    assert sum(row.purchase_events for row in results) == len(kinds(kept, "purchase"))


def test_attribution(spark, case):
    clean, kept = case
    master = {7: ("toys", "acme"), 1: ("toys", "unknown"), 2: ("unknown", "acme")}
    stored = products(spark, [(7, "toys", "acme"), (1, "toys", None), (2, "", " acme ")])
    mart = marts.mart_revenue_attribution(facts.fact_conversions(clean), dimensions.dim_product(stored))

    def key(row):
        code, brand = master.get(row[2], ("unknown", "unknown"))
        flags = (int(code == "unknown"), int(brand == "unknown")) if row[2] in master else (None, None)
        return (row[0].date(), int(row[3]), code, brand, *flags)

    groups = grouped(kinds(kept, "purchase"), key)
    found = mart.collect()
    assert len(found) == len(groups)
    for row in found:
        rows = groups[
            row.event_date,
            int(row.category_id),
            row.category_code,
            row.brand,
            row.is_unknown_category,
            row.is_unknown_brand,
        ]
        prices = [r[4] for r in rows if r[4] is not None]
        assert (row.purchase_events, row.purchasing_users) == (len(rows), len({r[5] for r in rows}))
        assert row.purchasing_sessions == len({r[6] for r in rows} - {None})
        assert row.purchased_products == len({r[2] for r in rows})
        assert row.total_revenue == (sum(prices) if prices else None)
        assert (row.min_purchase_value, row.max_purchase_value) == (
            (min(prices), max(prices)) if prices else (None, None)
        )
        assert row.avg_purchase_value == rounded(sum(prices), len(prices))
