"""One application holding a third of all rows: results stay whole and exact.

Broadcast is off and the skew thresholds are low, so the joins run as
sort-merge joins over shuffles that adaptive execution may split, the shape a
large cluster sees. Each rule is checked against a brute-force computation in
plain Python over the same rows.
"""

import calendar
import datetime as dt
import random
from collections import Counter

import pytest

from annuity.operators import merge, rules
from tests.helpers import frame

RENEWAL = ("application_num string, publication_num string, filing_date date, grant_date date, "
           "renewal_year int, date_filed date, date_processed date, next_renewal_date date")
SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}


@pytest.fixture()
def skew_session(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def add_months(d: dt.date, n: int) -> dt.date:
    index = d.year * 12 + d.month - 1 + n
    y, m = divmod(index, 12)
    return dt.date(y, m + 1, min(d.day, calendar.monthrange(y, m + 1)[1]))


def skewed_rows(n: int = 3000, seed: int = 7) -> list[tuple]:
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        app = "HOT" if i % 3 == 0 else f"A{rnd.randrange(400)}"
        filing = dt.date(1995, 1, 1) + dt.timedelta(days=sum(map(ord, app)) * 37 % 3000)
        grant = filing + dt.timedelta(days=rnd.randrange(200, 2500))
        year = rnd.randrange(3, 12)
        filed = None if rnd.random() < 0.05 else dt.date(2000, 1, 1) + dt.timedelta(days=rnd.randrange(60))
        processed = dt.date(2000, 3, 1) + dt.timedelta(days=rnd.randrange(90))
        rows.append((app, f"EP{i % 50:07d}", filing, grant, year, filed, processed, None))
    return rows


def brute_due(rows: list[tuple]) -> Counter:
    groups = Counter((r[0], r[5]) for r in rows if r[5] is not None)
    out = Counter()
    for app, _, filing, grant, year, filed, _, _ in rows:
        due = add_months(filing, (year - 1) * 12)
        if add_months(due, -3) <= grant <= due:
            due = add_months(grant, 3)
        if filed is not None and groups[(app, filed)] > 1:
            due = add_months(due, 12)
        out[(app, filed, year, due)] += 1
    return out


def test_due_dates_with_a_hot_application(skew_session):
    rows = skewed_rows()
    df = frame(skew_session, RENEWAL, rows)
    out = rules.renewal_due_dates(df)
    got = Counter((r.application_num, r.date_filed, r.renewal_year, r.renewal_due_date) for r in out.collect())
    assert got == brute_due(rows)
    assert sum(got.values()) == len(rows)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_priority_merge_with_a_hot_key(skew_session):
    rows = skewed_rows()
    new = frame(skew_session, RENEWAL, rows[::2])
    legacy = frame(skew_session, RENEWAL, rows[1::2])
    out = merge.priority_merge(new, legacy).collect()
    new_keys = {(r[0], r[1], r[4]) for r in rows[::2]}
    expected_legacy = [r for r in rows[1::2] if (r[0], r[1], r[4]) not in new_keys]
    assert sum(r.source == "Dynamics" for r in out) == len(rows[::2])
    assert sum(r.source == "Legacy" for r in out) == len(expected_legacy)


def test_endorsement_with_a_hot_application(skew_session):
    rows = skewed_rows()
    renewals = rules.renewal_due_dates(frame(skew_session, RENEWAL, rows))
    lor_rows = [("HOT", dt.date(2000, 2, 1), "A"), ("HOT", dt.date(2000, 4, 1), "D"),
                ("A1", dt.date(1990, 1, 1), "A")]
    lor = frame(skew_session, "application_num string, date_processed date, Addition_Deletion string", lor_rows)
    out = rules.lor_endorsement(renewals, lor).collect()
    assert len(out) == len(rows)
    for r in out:
        cmp = min(r.renewal_due_date, r.date_processed)
        if r.application_num == "HOT":
            want = dt.date(2000, 2, 1) <= cmp < dt.date(2000, 4, 1)
        else:
            want = r.application_num == "A1"
        assert r.lor_endorsement == ("YES" if want else "NO")


def test_hot_payment_group_is_split_by_adaptive_execution(skew_session):
    """A third of all rows in one (application, date filed) group: the join back is split."""
    rows = [r[:5] + (dt.date(2000, 1, 5) if r[0] == "HOT" else r[5],) + r[6:] for r in skewed_rows(30000)]
    out = rules.renewal_due_dates(frame(skew_session, RENEWAL, rows))
    got = Counter((r.application_num, r.date_filed, r.renewal_year, r.renewal_due_date) for r in out.collect())
    assert got == brute_due(rows)
    assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()
