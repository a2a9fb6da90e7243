"""history_rfm_segments (change points) against a literal day-by-day
implementation in plain Python, on random purchases that cross years, start
before the 1990 calendar, fall after as_of, and share days (timestamps)."""

import datetime as dt
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tillsight.operators.customers import history_rfm_segments

AS_OF = dt.date(2001, 3, 1)
CAL = (dt.date(1990, 1, 1), dt.date(2100, 1, 1))
ONE = dt.timedelta(days=1)


def brute(rows, as_of=AS_OF):
    total, first, orders = defaultdict(Decimal), {}, defaultdict(set)
    for c, ts, o, r in rows:
        total[c] += r
        first[c] = min(first.get(c, ts.date()), ts.date())
        orders[(c, ts)].add(o)
    agg = {(ts.date(), c, total[c], len(os_), first[c]) for (c, ts), os_ in orders.items()}
    out = {}
    for c in {a[1] for a in agg}:
        mine = sorted((a for a in agg if a[1] == c), key=lambda a: (a[0], a[3]))
        run_rev, run_ord = Decimal(0), 0
        for i, (d, _, tr, to, f) in enumerate(mine):
            run_rev += tr
            run_ord += to
            rev = run_rev.quantize(Decimal("0.01"), ROUND_HALF_UP)
            nxt = mine[i + 1][0] - ONE if i + 1 < len(mine) else as_of
            day = max(d, CAL[0])
            while day <= min(nxt, CAL[1]):
                rec = (day - d).days
                years = day.year - f.year
                freq = run_ord / years if years != 0 else 1
                r = 1 if rec > 12 else 2 if 6 <= rec <= 12 else 3
                fs = 1 if freq < 1 else 2 if 1 <= freq <= 2 else 3
                m = 1 if rev <= 150 else 2 if rev <= 500 else 3
                key = (c, rev, run_ord, d, f, r, fs, m)
                lo, hi = out.get(key, (day, day))
                out[key] = (min(lo, day), max(hi, day))
                day += ONE
    return {k + v for k, v in out.items()}


PURCHASE = st.tuples(st.integers(1, 3), st.dates(dt.date(1989, 10, 1), dt.date(2001, 4, 15)),
                     st.integers(0, 2), st.integers(1, 5), st.integers(1, 400))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(purchases=st.lists(PURCHASE, min_size=1, max_size=12))
def test_matches_daily_calendar(spark, purchases):
    rows = [(c, dt.datetime(d.year, d.month, d.day, h * 7), o, Decimal(r)) for c, d, h, o, r in purchases]
    df = spark.createDataFrame([(c, ts, o, str(r), "VENTE") for c, ts, o, r in rows],
                               "c long, ts timestamp, o long, r string, t string")
    df = df.withColumn("r", df["r"].cast("decimal(18,2)"))
    got = history_rfm_segments(df, customer_id="c", transaction_type="t", date="ts", revenue="r", order_id="o",
                               as_of=AS_OF).collect()
    mine = {(x.customer_id, Decimal(x.total_revenue_to_date), x.total_order_to_date, x.latest_conversion_date,
             x.first_transaction_date, x.recency_segment, x.frequency_segment, x.monetary_segment,
             x.first_date_state, x.last_date_state) for x in got}
    assert mine == brute(rows)
