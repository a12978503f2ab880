"""Properties over generated rows (few examples: each one runs Spark jobs)."""

from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from annuity.operators import merge, reports
from tests.helpers import frame

KEYS = "application_num string, publication_num string, renewal_year int, renewal_fee decimal(12,2)"
key = st.tuples(st.sampled_from(["A", "B", "C", None]), st.sampled_from(["EP1", "EP2", None]),
                st.integers(2, 6), st.integers(0, 10_000).map(lambda c: Decimal(c).scaleb(-2)))
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(key, max_size=8), st.lists(key, max_size=8))
def test_priority_merge(spark, new_rows, legacy_rows):
    new = frame(spark, KEYS, new_rows)
    legacy = frame(spark, KEYS, legacy_rows)
    out = merge.priority_merge(new, legacy).collect()
    new_keys = {r[:3] for r in new_rows if None not in r[:3]}
    # every new-system row is kept as it is, duplicates included
    assert sorted(map(str, (tuple(r)[:4] for r in out if r.source == "Dynamics"))) == sorted(map(str, new_rows))
    legacy_out = [tuple(r)[:3] for r in out if r.source == "Legacy"]
    assert not any(k in new_keys for k in legacy_out)
    expected = [r[:3] for r in legacy_rows if None in r[:3] or r[:3] not in new_keys]
    assert sorted(map(str, legacy_out)) == sorted(map(str, expected))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 10**7).map(lambda c: Decimal(c).scaleb(-2)),
                          st.integers(0, 10**6).map(lambda c: Decimal(c).scaleb(-2))), max_size=10))
def test_totals_balance(spark, rows):
    df = frame(spark, "renewal_fee decimal(12,2), total_epo_amount decimal(12,2)", rows)
    t = reports.grand_totals(df).collect()[0]
    assert t.grand_total_prescribed == sum((r[0] for r in rows), Decimal("0.00"))
    assert t.grand_total_prescribed - t.grand_total_remitted == t.grand_total_retained
