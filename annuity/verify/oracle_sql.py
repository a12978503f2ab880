"""DuckDB SQL for every registered query, written independently of the Spark code.

Each query is ``WITH <stage CTEs> SELECT ...`` over the driver's views
(orders, lineitem, region). The first CTEs rebuild the source tables exactly as
``annuity.sources.testdata`` does (FIXTURES.md); later CTEs restate each rule
in plain SQL (windows, NOT EXISTS, FILTER aggregates, GROUPING SETS, lists).
Only the CTEs a query references (transitively) are emitted.
"""

from __future__ import annotations

import datetime as dt
import re

from annuity.config import RunConfig


def add_months(d: str, n: str) -> str:
    return f"cast({d} + to_months(cast({n} as integer)) as date)"


def padl(s: str, w: int) -> str:
    return f"(case when length({s}) >= {w} then {s} else lpad({s}, {w}, '0') end)"


def signed_int(n: str, w: int = 2) -> str:
    digits = f"cast(abs({n}) as varchar)"
    return f"(case when {n} < 0 then '-' || {padl(digits, w - 1)} else {padl(digits, w)} end)"


def money_whole(x: str, w: int = 8) -> str:
    digits = f"cast(cast(floor(abs({x})) as bigint) as varchar)"
    return f"(case when {x} < 0 then '-' || {padl(digits, w - 1)} else {padl(digits, w)} end)"


def money_cents(x: str) -> str:
    return f"lpad(cast(cast(abs({x}) * 100 as bigint) % 100 as varchar), 2, '0')"


def money(x: str) -> str:
    return f"({money_whole(x)} || {money_cents(x)})"


def ddmmyy(d: str) -> str:
    return f"strftime({d}, '%d%m%y')"


def d(x: dt.date) -> str:
    return f"date '{x.isoformat()}'"


def key7(k: str) -> str:
    return f"((case when {k} % 10 = 0 then 'GB' else 'EP' end) || lpad(cast({k} as varchar), 7, '0'))"


def half_month(ts: str) -> str:
    return (f"make_date(cast(year({ts}) as int), cast(month({ts}) as int), "
            f"case when day({ts}) < 15 then 1 else 15 end)")


def cents(x: str) -> str:
    return f"cast(cast(round({x}) as bigint) / 100.0 as decimal(12, 2))"


RENEWAL_REQUIRED = [
    "publication_num", "filing_date", "renewal_due_date", "renewal_year", "lor_endorsement",
    "renewal_fee", "renewal_fee_epo", "renewal_fee_year3", "renewal_fee_year4",
    "total_epo_amount", "date_filed",
]
LAPSE_REQUIRED = ["publication_num", "filing_date", "lapsed_reason", "date_processed"]
RESTORATION_REQUIRED = ["publication_num", "filing_date", "date_processed"]
LOR_REQUIRED = ["publication_num", "filing_date", "date_processed", "Addition_Deletion",
                "first_reduced_year", "last_reduced_year"]


def missing(cols: list[str]) -> str:
    reason = {"renewal_fee_year3": "no minimum fee for year 3", "renewal_fee_year4": "no minimum fee for year 4"}
    return ("coalesce(" + ", ".join(f"case when {c} is null then '{reason.get(c, 'missing ' + c)}' end" for c in cols)
            + ")")


def widths(*fields: tuple[str, str, int]) -> str:
    """First field whose text does not have its width; dates always have theirs."""
    fields = (("publication_prefix", "'_' || substring(publication_num, 1, 2) || 'B'", 4),
              ("publication_number", "'_' || substring(publication_num, 3, 1048576)", 8), *fields)
    return "coalesce(" + ", ".join(
        f"case when length({text}) <> {n} then 'width {name}' end" for name, text, n in fields) + ")"


def pub_fields(code: int) -> str:
    return f"'{code}' || '_' || substring(publication_num, 1, 2) || 'B' || '_' || substring(publication_num, 3, 1048576)"


def renewal_base() -> str:
    return f"{pub_fields(200)} || 'C' || {ddmmyy('filing_date')} || {ddmmyy('renewal_due_date')}"


def year_line(y: int) -> str:
    fee = f"renewal_fee_year{y}"
    return (f"{renewal_base()} || '__' || '0{y}' || '00' || '__' || '0000000000' || {money_whole(fee)} || "
            f"{money_cents(fee)} || '0000' || {ddmmyy('date_filed')} || '0000000000____'")


def main_line(pct: int) -> str:
    return (f"{renewal_base()} || '__' || {signed_int('renewal_year')} || "
            f"(case when lor_endorsement = 'NO' then '00' else '02' end) || '__' || "
            f"{money_whole('renewal_fee')} || {money_cents('renewal_fee')} || "
            f"{money_whole('renewal_fee_epo')} || {money_cents('renewal_fee_epo')} || '{pct}00' || "
            f"{ddmmyy('date_filed')} || '0000000000____'")


LAPSE_LINE = (f"{pub_fields(400)} || '_' || {ddmmyy('filing_date')} || '__________' || "
              "coalesce(case lapsed_reason when 'Ceased' then '00' when 'Surrendered' then '05' "
              "when 'Revoked' then '07' end, '') || repeat('_', 26) || "
              f"{ddmmyy('date_processed')} || repeat('_', 14)")
RESTORATION_LINE = (f"{pub_fields(500)} || '_' || {ddmmyy('filing_date')} || repeat('_', 38) || "
                    f"{ddmmyy('date_processed')} || repeat('_', 14)")
LOR_LINE = (f"{pub_fields(600)} || (case when Addition_Deletion = 'A' then '_' else 'D' end) || "
            f"{ddmmyy('filing_date')} || {ddmmyy('date_processed')} || {signed_int('first_reduced_year')} || "
            f"{signed_int('last_reduced_year')} || '50' || repeat('_', 46)")


def due_dates_ctes(prefix: str, source: str) -> list[tuple[str, str]]:
    """Due-date rule as SQL: base date, grace shift, +12 months for groups of payments."""
    d0 = add_months("filing_date", "(renewal_year - 1) * 12")
    return [
        (f"{prefix}_d0", f"select *, {d0} as _d0 from {source}"),
        (f"{prefix}_d1", f"""select *, case when grant_date >= {add_months('_d0', '-3')} and grant_date <= _d0
               then {add_months('grant_date', '3')} else _d0 end as _d1,
               count(date_filed) over (partition by application_num, date_filed) as _same
            from {prefix}_d0"""),
    ]


def build_ctes(cfg: RunConfig) -> list[tuple[str, str]]:
    start, end = cfg.period
    pct = cfg.pct_split
    share = f"{pct / 100:.2f}"
    interest = f"{(cfg.interest_year3 + cfg.interest_year4):.2f}"
    between = f"between {d(start)} and {d(end)}"
    ctes: list[tuple[str, str]] = [
        # ---- source tables -------------------------------------------------
        ("v_standing", f"""
            select k as application_num,
                   k || (case when o_orderkey % 7 = 0 then '  ' else '' end) as publication_num,
                   make_date(cast(year(od) - 1 - o_custkey % 6 as int), cast(month(od) as int),
                             cast(case when month(od) = 2 then least(day(od), 28) else day(od) end as int)) as filing_date,
                   make_date(cast(year(od) - 1 - o_custkey % 6 + 2 + o_custkey % 4 as int),
                             cast(1 + (month(od) - 1 + o_custkey % 12) % 12 as int), 15) as grant_date,
                   od + 365 as renewal_date,
                   case when o_custkey % 4 = 0 then od + 90 end as restore_date,
                   case when o_custkey % 4 = 0 then od + 104 end as restore_allowed_date,
                   case when o_custkey % 3 = 0 then od + 40 end as date_of_lor,
                   case when o_custkey % 3 < 2 then od + 400 end as date_lor_cancel,
                   case when o_orderstatus = 'P' then od + 20 end as date_not_in_force,
                   case o_custkey % 5 when 0 then '00' when 1 then '04' when 2 then '05' when 3 then '07' else '99' end
                     as reason_not_in_force
            from (select *, cast(o_orderdate as date) as od, {key7('o_orderkey')} as k from orders) o"""),
        ("v_formslog", f"""
            select {key7('l_orderkey')} as case_key,
                   case when l_returnflag = 'A' then 12 when l_returnflag = 'N' and l_linestatus = 'F' then 16
                        when l_returnflag = 'N' then 28 when l_linestatus = 'F' then 30 else 12 end as form_type_num,
                   fd as date_filed,
                   case when l_partkey % 50 <> 0 then fd + cast(l_partkey % 45 as int) end as date_actioned,
                   cast(year(fd) - (year(cast(o_orderdate as date)) - 1 - o_custkey % 6) + 1 as int) as last_renewal_year,
                   {cents('l_quantity * 500 + l_linenumber')} as fee_taken,
                   cast(cast(round(l_tax * 100) as int) * 10 as decimal(12, 2)) as extension_fee_taken,
                   cast(round(l_tax * 100) as int) as extension_months
            from (select *, {half_month('l_shipdate')} as fd from lineitem) l
            left join orders on l_orderkey = o_orderkey"""),
        ("v_reghist", """
            select application_num as case_key, date_not_in_force as event_date,
                   date_not_in_force + cast(length(publication_num) as int) as reg_date
            from v_standing where date_not_in_force is not null"""),
        ("v_line", f"""
            select concat_ws('-', cast(l_orderkey as varchar), cast(l_partkey as varchar), cast(l_suppkey as varchar),
                     cast(l_linenumber as varchar), cast(cast(l_shipdate as date) as varchar),
                     cast(cast(round(l_extendedprice * 100) as bigint) as varchar)) as line_id,
                   l_orderkey as right_id, l_partkey, l_linenumber, l_quantity, l_returnflag, l_linestatus,
                   {half_month('l_shipdate')} as date_filed
            from lineitem where l_suppkey % 2 = 1"""),
        ("n_incident", """
            select line_id as incident_id, line_id as servicerequest_id, right_id, date_filed,
                   case when l_partkey % 50 <> 0 then date_filed + cast(l_partkey % 45 as int) end as date_completed
            from v_line"""),
        ("n_servicerequest", f"""
            select line_id as id,
                   case when l_returnflag = 'A' or (l_returnflag = 'R' and l_linestatus = 'O') then 'Renewals'
                        else 'Other' end as type_name,
                   case when l_partkey % 3 = 0 then cast(2 + l_partkey % 12 as int) end as renewal_year,
                   {cents('l_quantity * 500')} as prescribed_uk_fee,
                   case when l_partkey % 4 = 0 then 'Y' else 'N' end as lor_indicator
            from v_line"""),
        ("n_right", """
            select cast(substring(application_num, 3, 7) as bigint) as right_id, application_num, publication_num,
                   filing_date, grant_date,
                   case when reason_not_in_force = '99' then 6 end as renewal_year,
                   case when reason_not_in_force = '07' then date_of_lor end as next_renewal_date,
                   case reason_not_in_force when '00' then 1 when '04' then 2 when '05' then 3 when '07' then 4
                        else 9 end as termination_reason_id,
                   date_not_in_force as termination_date, restore_date as restoration_date
            from v_standing"""),
        ("n_fees", """
            select o_orderkey as fee_id, o_orderkey as right_id,
                   cast(cast(o_custkey % 30000 as bigint) / 100.0 as decimal(12, 2)) as total_fee
            from orders where o_custkey % 11 <> 0"""),
        ("m_case", """
            select line_id as case_id, right_id, date_filed as case_create_date,
                   case when l_returnflag = 'N' and l_linestatus = 'F' then 31 when l_returnflag = 'N' then 17
                        when l_returnflag = 'R' and l_linestatus = 'F' then 40 + cast(l_partkey % 5 as int)
                        else 1 end as case_category_id
            from v_line"""),
        ("m_casecategory", """
            select cast(40 + r_regionkey as int) as case_category_id,
                   case r_regionkey when 0 then 'Cessation' when 1 then 'Expiry' when 2 then 'Surrender'
                        when 3 then 'Revocation' else 'Other' end as case_category
            from region"""),
        ("m_terminationreason", """
            select cast(r_regionkey + 1 as int) as termination_reason_id,
                   case r_regionkey when 0 then 'Ceased' when 1 then 'Expired' when 2 then 'Surrendered'
                        when 3 then 'Revoked' else 'Other' end as description
            from region"""),
        ("m_licenceofright", """
            select right_id, next_renewal_date as lor_granted_date,
                   case when right_id % 2 = 0 then next_renewal_date + 500 end as lor_cancelled_date
            from n_right where next_renewal_date is not null"""),
        ("m_registerevent", """
            select case_id, case_create_date + 7 as event_date,
                   case when right_id % 9 = 0 then 0 else 1 end as register_indicator
            from m_case"""),
        ("v_minimum_fee", """
            select cast(y as varchar) as year_set, cast(r + 2 as varchar) as minimum_fee_year,
                   cast(cast(20 + (y % 10) * 5 + r as decimal(12, 2)) as varchar) as minimum_fee_amount
            from (select y, unnest(generate_series(0, 4)) as r
                  from (select distinct cast(year(o_orderdate) as int) as y from orders) t) u"""),
        # ---- damaged values (the legacy register as text) ------------------
        ("bad_standing", """
            select application_num as key, c as column, v as value
            from (select application_num, cast(substring(application_num, 3, 7) as bigint) as n from v_standing) s,
                 lateral (select 'filing_date' as c, 'n/a' as v where n % 31 = 0
                          union all select 'grant_date', '1999-02-30' where n % 37 = 0) x"""),
        ("bad_formslog", """
            select case_key as key, c as column, v as value
            from (select case_key, fee_taken, cast(fee_taken * 100 as bigint) as n from v_formslog) f,
                 lateral (select 'fee_taken' as c, replace(cast(fee_taken as varchar), '.', ',') as v where n % 13 = 0
                          union all select 'last_renewal_year', 'five' where n % 17 = 0) x"""),
        ("fee_lines", """
            select *, year_set || ',' || minimum_fee_year || ',' || minimum_fee_amount as line,
                   case when cast(year_set as int) % 2 = 0 and minimum_fee_year = '2' then 'short'
                        when cast(year_set as int) % 3 = 0 and minimum_fee_year = '6' then 'long'
                        when cast(year_set as int) % 2 = 1 and minimum_fee_year = '5' then 'year'
                        when cast(year_set as int) % 4 = 0 and minimum_fee_year = '5' then 'amount'
                        when cast(year_set as int) % 5 = 0 and minimum_fee_year = '6' then 'set' end as damage
            from v_minimum_fee"""),
        # ---- extracts ------------------------------------------------------
        ("e_renewals_new", f"""
            select r.application_num, trim(r.publication_num) as publication_num, r.filing_date, r.grant_date,
                   ry.renewal_year,
                   cast(coalesce(f.total_fee, 0.00) as decimal(12, 2)) as renewal_fee,
                   cast(sr.prescribed_uk_fee as decimal(12, 2)) as prescribed_uk_fee,
                   sr.lor_indicator,
                   coalesce(r.next_renewal_date, {add_months('r.filing_date', 'ry.renewal_year * 12')}) as renewal_due_date,
                   i.date_filed, i.date_completed as date_processed
            from n_incident i
            join n_servicerequest sr on i.servicerequest_id = sr.id
            left join n_right r on i.right_id = r.right_id
            left join n_fees f on r.right_id = f.right_id
            cross join lateral (select cast(coalesce(sr.renewal_year, r.renewal_year,
                                  year(i.date_completed) - year(r.filing_date) + 1) as int) as renewal_year) ry
            where sr.type_name = 'Renewals'"""),
        ("e_renewals_legacy", """
            select f.case_key as application_num, trim(s.publication_num) as publication_num, s.filing_date,
                   s.grant_date, cast(f.last_renewal_year as int) as renewal_year,
                   cast(f.fee_taken as decimal(12, 2)) as renewal_fee,
                   cast(f.extension_fee_taken as decimal(12, 2)) as late_fee,
                   cast(f.extension_months as int) as late_months,
                   s.renewal_date as next_renewal_date, f.date_filed, f.date_actioned as date_processed
            from v_formslog f left join v_standing s on f.case_key = s.application_num
            where f.form_type_num = 12"""),
        ("e_restorations_legacy", """
            select s.application_num, trim(s.publication_num) as publication_num, s.filing_date, s.grant_date,
                   f.date_filed, s.restore_allowed_date as date_processed
            from v_standing s left join v_formslog f on s.application_num = f.case_key
            where s.restore_date is not null and f.form_type_num = 16"""),
        ("e_restorations_new", """
            select r.application_num, trim(r.publication_num) as publication_num, r.filing_date, r.grant_date,
                   c.case_create_date as date_filed, r.restoration_date as date_processed
            from n_right r left join m_case c on r.right_id = c.right_id
            where r.restoration_date is not null and c.case_category_id = 31"""),
        ("e_lor_legacy", """
            select s.application_num, trim(s.publication_num) as publication_num, s.filing_date, s.grant_date,
                   f.date_filed, coalesce(f.date_actioned, s.date_of_lor) as date_processed, 'A' as Addition_Deletion
            from v_standing s left join v_formslog f on s.application_num = f.case_key
            where f.form_type_num = 28 and (f.date_actioned is not null or s.date_of_lor is not null)
            union
            select s.application_num, trim(s.publication_num) as publication_num, s.filing_date, s.grant_date,
                   f.date_filed, s.date_lor_cancel as date_processed, 'D' as Addition_Deletion
            from v_standing s left join v_formslog f on s.application_num = f.case_key
            where f.form_type_num = 30 and s.date_lor_cancel is not null"""),
        ("e_lor_new", """
            select r.application_num, trim(r.publication_num) as publication_num, r.filing_date, r.grant_date,
                   c.case_create_date as date_filed, l.lor_granted_date as date_processed, 'A' as Addition_Deletion
            from m_licenceofright l left join n_right r on l.right_id = r.right_id
            left join m_case c on r.right_id = c.right_id
            where l.lor_granted_date is not null and c.case_category_id = 17
            union
            select r.application_num, trim(r.publication_num) as publication_num, r.filing_date, r.grant_date,
                   c.case_create_date as date_filed, l.lor_cancelled_date as date_processed, 'D' as Addition_Deletion
            from m_licenceofright l left join n_right r on l.right_id = r.right_id
            left join m_case c on r.right_id = c.right_id
            where l.lor_cancelled_date is not null and c.case_category_id = 17"""),
        ("e_lapses_legacy", f"""
            select trim(s.publication_num) as publication_num, s.filing_date,
                   case s.reason_not_in_force when '00' then 'Ceased' when '04' then 'Expired'
                        when '05' then 'Surrendered' when '07' then 'Revoked' end as lapsed_reason,
                   s.date_not_in_force as lapsed_date, h.event_date as date_processed
            from v_standing s left join v_reghist h on s.application_num = h.case_key
            where h.reg_date {between} and s.publication_num like '{cfg.ep_prefix}%'
              and s.date_not_in_force is not null and s.date_not_in_force = h.event_date
              and s.reason_not_in_force in ('00', '04', '05', '07')"""),
        ("e_lapses_new", f"""
            select trim(r.publication_num) as publication_num, r.filing_date, t.description as lapsed_reason,
                   r.termination_date as lapsed_date, e.event_date as date_processed
            from m_case c
            left join m_casecategory cc on c.case_category_id = cc.case_category_id
            left join m_registerevent e on c.case_id = e.case_id
            left join n_right r on c.right_id = r.right_id
            left join m_terminationreason t on r.termination_reason_id = t.termination_reason_id
            where e.event_date {between} and r.publication_num like '{cfg.ep_prefix}%'
              and cc.case_category in ('Cessation', 'Expiry', 'Surrender', 'Revocation')
              and e.register_indicator = 1"""),
        # ---- merges --------------------------------------------------------
        ("renewals", """
            select application_num, publication_num, filing_date, grant_date, renewal_year, renewal_fee,
                   prescribed_uk_fee, lor_indicator, renewal_due_date, cast(null as date) as next_renewal_date,
                   cast(null as decimal(12, 2)) as late_fee, cast(null as int) as late_months, date_filed,
                   date_processed, 'Dynamics' as source, 'Renewals' as type_identifier
            from e_renewals_new
            union all
            select application_num, publication_num, filing_date, grant_date, renewal_year, renewal_fee,
                   cast(null as decimal(12, 2)), cast(null as varchar), cast(null as date), next_renewal_date,
                   late_fee, late_months, date_filed, date_processed, 'Legacy', 'Renewals'
            from e_renewals_legacy l
            where not exists (select 1 from e_renewals_new n where n.application_num = l.application_num
                              and n.publication_num = l.publication_num and n.renewal_year = l.renewal_year)"""),
        ("restorations", """
            select *, 'Restoration' as type_identifier from (
              select *, 'Legacy' as source from e_restorations_legacy
              union select *, 'Dynamics' as source from e_restorations_new) u"""),
        ("lor", """
            select *, 'Licence of Right' as type_identifier from (
              select *, 'Legacy' as source from e_lor_legacy
              union select *, 'Dynamics' as source from e_lor_new) u"""),
        ("lapses", """
            select *, 'Legacy' as source from e_lapses_legacy
            union select *, 'Dynamics' as source from e_lapses_new"""),
        ("history", """
            select * from renewals
            union all
            select application_num, publication_num, filing_date, grant_date, null, null, null, null, null, null,
                   null, null, date_filed, date_processed, source, type_identifier from restorations
            union all
            select application_num, publication_num, filing_date, grant_date, null, null, null, null, null, null,
                   null, null, date_filed, date_processed, source, type_identifier from lor
            where Addition_Deletion = 'D'"""),
        # ---- rules ---------------------------------------------------------
        *due_dates_ctes("rd", "renewals"),
        ("renewals_due", f"""
            select * exclude (_d0, _d1, _same, next_renewal_date)
                   replace (case when _same > 1 then {add_months('_d1', '12')} else _d1 end as renewal_due_date)
            from rd_d1"""),
        ("lor_pivot", """
            select application_num, max(date_processed) filter (where Addition_Deletion = 'A') as A,
                   max(date_processed) filter (where Addition_Deletion = 'D') as D
            from lor group by application_num"""),
        ("renewals_enriched", """
            select r.*, c.renewal_comparison_date,
                   case when p.A <= c.renewal_comparison_date
                             and (c.renewal_comparison_date < p.D or p.D is null) then 'YES' else 'NO' end
                     as lor_endorsement
            from renewals_due r left join lor_pivot p on r.application_num = p.application_num
            cross join lateral (select least(r.renewal_due_date, r.date_processed) as renewal_comparison_date) c"""),
        ("lor_y", """
            select *, cast(year(date_processed) - (year(filing_date) - 1) as int) as renewal_year from lor"""),
        *due_dates_ctes("ld", "lor_y"),
        ("lor_due", f"""
            select * exclude (_d0, _d1, _same),
                   case when _same > 1 then {add_months('_d1', '12')} else _d1 end as renewal_due_date
            from ld_d1"""),
        # Every payment of the event's year, each with its own comparison date.
        ("lor_x", """
            select distinct l.*, p.date_processed as renewal_date_processed,
                   least(l.renewal_due_date, p.date_processed) as cmp
            from lor_due l left join renewals p
              on l.application_num = p.application_num and l.renewal_year = p.renewal_year"""),
        ("lor_add", """
            select application_num, publication_num, filing_date, grant_date, date_filed, date_processed,
                   Addition_Deletion, source, type_identifier,
                   case when date_processed <= cmp then renewal_year else renewal_year + 1 end as first_reduced_year,
                   20 as last_reduced_year
            from lor_x where Addition_Deletion = 'A'"""),
        # Every first year of the application's entries.
        ("lor_del", """
            select distinct x.application_num, x.publication_num, x.filing_date, x.grant_date, x.date_filed,
                   x.date_processed, x.Addition_Deletion, x.source, x.type_identifier, a.first_reduced_year,
                   case when x.date_processed <= x.cmp then x.renewal_year - 1 else x.renewal_year end as last_reduced_year,
                   a.application_num is null as no_entry
            from lor_x x left join lor_add a on x.application_num = a.application_num
            where x.Addition_Deletion = 'D'"""),
        ("lor_ranges_all", """
            select distinct * from (
                select *, false as no_entry from lor_add union all select * from lor_del) t"""),
        ("lor_ranges", "select * exclude (no_entry) from lor_ranges_all where first_reduced_year <= 20"),
        ("fee_table", """
            select cast(year_set as int) as year_set,
                   max(case when cast(minimum_fee_year as int) = 3 then cast(minimum_fee_amount as decimal(12, 2)) end) as fee3,
                   max(case when cast(minimum_fee_year as int) = 4 then cast(minimum_fee_amount as decimal(12, 2)) end) as fee4
            from v_minimum_fee where cast(minimum_fee_year as int) in (3, 4) group by 1"""),
        # ---- period --------------------------------------------------------
        ("renewals_period", f"""
            select * from renewals_enriched
            where date_processed {between} and publication_num like '{cfg.ep_prefix}%'"""),
        ("restorations_period", f"""
            select * from restorations where date_processed {between} and publication_num like '{cfg.ep_prefix}%'"""),
        ("lor_period", f"""
            select * from lor_ranges where date_processed {between} and publication_num like '{cfg.ep_prefix}%'"""),
        ("lor_unmatched_period", f"""
            select * from lor_ranges_all where first_reduced_year is null
              and date_processed {between} and publication_num like '{cfg.ep_prefix}%'"""),
    ]

    def split_sql(source: str) -> str:
        return f"""
            select s.* exclude (_f3, _f4), cast(round(s.renewal_fee * {share}, 2) as decimal(12, 2)) as renewal_fee_epo,
                   cast(round(cast(round(s.renewal_fee * {share}, 2) as decimal(12, 2)) + s.renewal_fee_year3
                              + s.renewal_fee_year4 + {interest}, 2) as decimal(12, 2)) as total_epo_amount
            from (select r.*,
                    cast(case when r.grant_date <= {add_months('r.filing_date', '24')} and r.renewal_year = 5
                              then f3.fee3 else 0.00 end as decimal(12, 2)) as renewal_fee_year3,
                    cast(case when r.grant_date <= {add_months('r.filing_date', '36')} and r.renewal_year = 5
                              then f4.fee4 else 0.00 end as decimal(12, 2)) as renewal_fee_year4,
                    f3.fee3 as _f3, f4.fee4 as _f4
                  from {source} r
                  left join fee_table f3 on year(r.renewal_due_date) - 2 = f3.year_set
                  left join fee_table f4 on year(r.renewal_due_date) - 1 = f4.year_set) s"""

    required = ", ".join(RENEWAL_REQUIRED)
    ctes += [
        ("split", f"select * exclude (late_fee, late_months) from ({split_sql('renewals_period')}) t"),
        ("split_all", split_sql("renewals_due")),
        # ---- exchange ------------------------------------------------------
        ("ren_rows", f"""
            select *, case when _missing is null then list_filter([
                        case when renewal_fee_year3 >= 1 then {year_line(3)} end,
                        case when renewal_fee_year4 >= 1 then {year_line(4)} end,
                        {main_line(pct)}], lambda x: x is not null) end as _lines
            from (select *, {missing(RENEWAL_REQUIRED)} as _missing
                  from (select {required}, count(*) as copies from split group by all) t) m"""),
        ("lapse_rows", f"""
            select *, case when _missing is null then [{LAPSE_LINE}] end as _lines
            from (select *, {missing(LAPSE_REQUIRED)} as _missing
                  from (select {', '.join(LAPSE_REQUIRED)}, count(*) as copies from lapses
                        where lapsed_reason is distinct from 'Expired' group by all) t) m"""),
        ("restoration_rows", f"""
            select *, case when _missing is null then [{RESTORATION_LINE}] end as _lines
            from (select *, {missing(RESTORATION_REQUIRED)} as _missing
                  from (select {', '.join(RESTORATION_REQUIRED)}, count(*) as copies from restorations_period group by all) t) m"""),
        ("lor_rows", f"""
            select *, case when _missing is null then [{LOR_LINE}] end as _lines
            from (select *, {missing(LOR_REQUIRED)} as _missing
                  from (select {', '.join(LOR_REQUIRED)}, count(*) as copies from lor_period group by all) t) m"""),
    ]
    wrong = {
        "ren_rows": widths(
            ("remitted", f"case when renewal_fee_year3 >= 1 then {money('renewal_fee_year3')} end", 10),
            ("remitted", f"case when renewal_fee_year4 >= 1 then {money('renewal_fee_year4')} end", 10),
            ("renewal_year", signed_int("renewal_year"), 2), ("prescribed", money("renewal_fee"), 10),
            ("remitted", money("renewal_fee_epo"), 10)),
        "lapse_rows": "coalesce(case when lapsed_reason not in ('Ceased', 'Surrendered', 'Revoked') "
                      f"then 'unknown lapse reason' end, {widths()})",
        "restoration_rows": widths(),
        "lor_rows": widths(("first_reduced_year", signed_int("first_reduced_year"), 2),
                           ("last_reduced_year", signed_int("last_reduced_year"), 2)),
    }
    for name, first_wrong in wrong.items():
        ctes.append((f"{name}_checked", f"select *, coalesce(_missing, {first_wrong}) as _reason from {name}"))
    ctes += [
        ("control", f"""
            select 100 as type, '100' || repeat('_', 13) || '{start:%d%m%y}' || '{end:%d%m%y}' || 'GB' || 'GBP'
                   || repeat('_', 47) as record
            union all
            select 900, '900' || repeat('_', 12) || 'C' || '__' || {money_whole('p', 13)} || {money_cents('p')}
                   || {money_whole('r', 13)} || {money_cents('r')} || '{cfg.run_date:%d%m%y}' || 'POA 35/28'
                   || repeat('_', 17)
            from (select cast(coalesce(sum(renewal_fee), 0) as decimal(18, 2)) as p,
                         cast(coalesce(sum(total_epo_amount), 0) as decimal(18, 2)) as r
                  from ren_rows_checked where _reason is null) t"""),
        ("records_all", """
            select publication_num, 200 as type, unnest(_lines) as record from ren_rows_checked where _reason is null
            union all
            select publication_num, 400, unnest(_lines) from lapse_rows_checked where _reason is null
            union all
            select publication_num, 500, unnest(_lines) from restoration_rows_checked where _reason is null
            union all
            select publication_num, 600, unnest(_lines) from lor_rows_checked where _reason is null"""),
        ("file_lines", """
            select type, replace(record, '_', ' ') as record
            from (select type, record from records_all union all select type, record from control) t
            where length(record) = 80"""),
    ]
    return ctes


def _with(ctes: list[tuple[str, str]], body: str) -> str:
    """``WITH`` clause holding only the CTEs ``body`` needs, in definition order."""
    names = [n for n, _ in ctes]
    defs = dict(ctes)
    need: set[str] = set()
    stack = [body]
    while stack:
        text = stack.pop()
        for n in names:
            if n not in need and re.search(rf"\b{n}\b", text):
                need.add(n)
                stack.append(defs[n])
    used = [n for n in names if n in need]
    if not used:
        return body
    return "with " + ",\n".join(f"{n} as ({defs[n]}\n)" for n in used) + "\n" + body


def _rejects_body(kind: str, code: int) -> str:
    prescribed, remitted = (f"cast({c} as decimal(18, 2))" for c in (
        ("renewal_fee * n", "total_epo_amount * n") if code == 200 else ("null", "null")))
    return f"""
    select {code} as type, publication_num, coalesce(_reason, '{'duplicate payment' if code == 200 else 'duplicate event'}') as reason,
           array_to_string(_lines, '|') as record, n as payments, {prescribed} as prescribed, {remitted} as remitted
    from (select *, case when _reason is null then copies - 1 else copies end as n from {kind}_checked) t where n > 0"""


# The file's lines against its trailer; types 400 to 600 have no amounts.
_RECONCILIATION = """
    select t.type, (select count(*) from file_lines f where f.type = t.type) as lines,
           case when t.type = 200 then (select cast(coalesce(sum(renewal_fee), 0) as decimal(18, 2)) from ren_rows_checked
                                        where _reason is null) end as prescribed,
           case when t.type = 200 then (select cast(coalesce(sum(renewal_fee_epo
                      + case when renewal_fee_year3 >= 1 then renewal_fee_year3 else 0 end
                      + case when renewal_fee_year4 >= 1 then renewal_fee_year4 else 0 end), 0) as decimal(18, 2))
                    from ren_rows_checked where _reason is null) end as remitted,
           case when t.type = 200 then cast(0 as decimal(18, 2)) end as interest,
           case when t.type = 200 then (select cast(substring(record, 19, 13) || '.' || substring(record, 32, 2) as decimal(18, 2))
                                        from control where type = 900) end as trailer_prescribed,
           case when t.type = 200 then (select cast(substring(record, 34, 13) || '.' || substring(record, 47, 2) as decimal(18, 2))
                                        from control where type = 900) end as trailer_remitted,
           true as balanced
    from (select unnest([100, 200, 400, 500, 600, 900]) as type) t"""


def oracle_queries(cfg: RunConfig, cfg_monthly: RunConfig) -> dict[str, str]:
    q = build_ctes(cfg)
    m = build_ctes(cfg_monthly)
    sel = {
        "minimum_fee_csv": "select * from v_minimum_fee",
        "minimum_fee_good_lines": "select year_set, minimum_fee_year, minimum_fee_amount from fee_lines where damage is null",
        "minimum_fee_rejects": """
            select case damage when 'short' then year_set || ',' || minimum_fee_year when 'long' then line || ',extra'
                        when 'year' then year_set || ',five,' || minimum_fee_amount
                        when 'amount' then year_set || ',' || minimum_fee_year || ',12 pounds'
                        else ',' || minimum_fee_year || ',' || minimum_fee_amount end as record,
                   case damage when 'year' then 'minimum_fee_year is no number' when 'amount' then 'minimum_fee_amount is no number'
                        when 'set' then 'year_set is no number' else 'not 3 columns' end as reason
            from fee_lines where damage is not null""",
        "quarantine": """
            select 'standing' as "table", key, "column", value from bad_standing
            union all select 'formslog', key, "column", value from bad_formslog""",
        "extract_renewals_damaged": """
            select f.case_key as application_num, trim(s.publication_num) as publication_num, s.filing_date,
                   s.grant_date, cast(f.last_renewal_year as int) as renewal_year,
                   cast(f.fee_taken as decimal(12, 2)) as renewal_fee, cast(f.extension_fee_taken as decimal(12, 2)) as late_fee,
                   cast(f.extension_months as int) as late_months, s.renewal_date as next_renewal_date, f.date_filed,
                   f.date_actioned as date_processed
            from v_formslog f left join (select * from v_standing where application_num not in (select key from bad_standing)) s
              on f.case_key = s.application_num
            where f.form_type_num = 12 and cast(f.fee_taken * 100 as bigint) % 13 <> 0 and cast(f.fee_taken * 100 as bigint) % 17 <> 0""",
        "extract_renewals_new": "select * from e_renewals_new",
        "extract_renewals_legacy": "select * from e_renewals_legacy",
        "extract_restorations_legacy": "select * from e_restorations_legacy",
        "extract_restorations_new": "select * from e_restorations_new",
        "extract_lor_legacy": "select * from e_lor_legacy",
        "extract_lor_new": "select * from e_lor_new",
        "extract_lapses_legacy": "select * from e_lapses_legacy",
        "extract_lapses_new": "select * from e_lapses_new",
        "left_join_chain": """
            select i.incident_id, sr.type_name, r.application_num, i.date_filed, f.total_fee
            from n_incident i left join n_servicerequest sr on i.servicerequest_id = sr.id
            left join n_right r on i.right_id = r.right_id left join n_fees f on r.right_id = f.right_id""",
        "priority_merge": "select * from renewals",
        "overlap_keys": """
            select distinct l.application_num, l.publication_num, l.renewal_year from e_renewals_legacy l
            where exists (select 1 from e_renewals_new n where n.application_num = l.application_num
                          and n.publication_num = l.publication_num and n.renewal_year = l.renewal_year)""",
        "source_breakdown": "select source, count(*) as renewal_count from renewals group by source",
        "dedupe_union": "select * from restorations",
        "merged_lor": "select * from lor",
        "merged_lapses": "select * from lapses",
        "history_union": "select * from history",
        "null_rows": f"""
            select application_num, publication_num, renewal_year, date_filed, reason
            from (select *, {missing(RENEWAL_REQUIRED)} as reason from split) t where reason is not null""",
        "renewal_due_dates": """
            select application_num, publication_num, filing_date, grant_date, renewal_year, date_filed,
                   date_processed, source, renewal_due_date from renewals_due""",
        "multiple_renewals": """
            select application_num, date_filed, count(*) as payments from renewals
            where date_filed is not null group by application_num, date_filed having count(*) > 1""",
        "lor_pivot": "select * from lor_pivot",
        "lor_endorsement": """
            select application_num, renewal_year, date_filed, date_processed, renewal_due_date,
                   renewal_comparison_date, lor_endorsement, source from renewals_enriched""",
        "lor_year_range": """
            select application_num, publication_num, filing_date, date_filed, date_processed, Addition_Deletion,
                   source, first_reduced_year, last_reduced_year from lor_ranges""",
        "lor_inverted_ranges": """
            select application_num, publication_num, filing_date, date_filed, date_processed, Addition_Deletion,
                   source, first_reduced_year, last_reduced_year from lor_period where last_reduced_year < first_reduced_year""",
        "minimum_fee_lookup": """
            select application_num, renewal_year, date_filed, date_processed, renewal_due_date,
                   renewal_fee_year3, renewal_fee_year4 from split_all""",
        "fee_splits": """
            select application_num, publication_num, renewal_year, date_filed, date_processed, renewal_due_date,
                   lor_endorsement, renewal_fee, renewal_fee_epo, renewal_fee_year3, renewal_fee_year4,
                   total_epo_amount, source from split""",
        "period_filter": """
            select application_num, publication_num, renewal_year, date_filed, date_processed, renewal_due_date,
                   lor_endorsement, source from renewals_period""",
        "cross_month": """
            select application_num, publication_num, date_filed, date_processed, source from renewals_period
            where strftime(date_filed, '%Y-%m') <> strftime(date_processed, '%Y-%m')""",
        "audit_counts": """
            select 'renewals_new' as metric, count(*) as value from e_renewals_new
            union all select 'renewals_legacy', count(*) from e_renewals_legacy
            union all select 'renewals_merged', count(*) from renewals
            union all select 'duplicate_renewal_keys', count(*) from (
                select distinct application_num, publication_num, renewal_year from e_renewals_legacy l
                where exists (select 1 from e_renewals_new n where n.application_num = l.application_num
                              and n.publication_num = l.publication_num and n.renewal_year = l.renewal_year)) k
            union all select 'restorations', count(*) from restorations
            union all select 'licences_of_right', count(*) from lor
            union all select 'lapses', count(*) from lapses
            union all select 'restorations_in_period', count(*) from restorations_period
            union all select 'licences_of_right_in_period', count(*) from lor_period
            union all select 'renewals_in_period', count(*) from renewals_period
            union all select 'cross_month_renewals', count(*) from renewals_period
                where strftime(date_filed, '%Y-%m') <> strftime(date_processed, '%Y-%m')""",
        "grand_totals": """
            select p as grand_total_prescribed, r as grand_total_remitted,
                   cast(p - r as decimal(18, 2)) as grand_total_retained
            from (select cast(coalesce(sum(renewal_fee), 0) as decimal(18, 2)) as p,
                         cast(coalesce(sum(total_epo_amount), 0) as decimal(18, 2)) as r from split) t""",
        "monthly_totals": """
            select case when grouping(m) = 1 then 'EPO Total' else strftime(m, '%B %Y') end as Month,
                   format('{:,.2f}', cast(sum(total_epo_amount) as decimal(18, 2))) as Amount
            from (select date_trunc('month', date_filed) as m, total_epo_amount from split) t
            group by grouping sets ((m), ())""",
        "status_report": """
            select publication_num, filing_date, date_processed, lapsed_reason as type,
                   cast(null as varchar) as Addition_Deletion, cast(null as int) as from_year,
                   cast(null as int) as to_year from lapses
            union all
            select publication_num, filing_date, date_processed, type_identifier, null, null, null
            from restorations_period
            union all
            select publication_num, filing_date, date_processed, type_identifier, Addition_Deletion,
                   first_reduced_year, last_reduced_year from lor_period""",
        "money_fields": f"""
            select application_num, publication_num, renewal_year, date_filed,
                   {money_whole('renewal_fee')} as renewal_fee_whole, {money_cents('renewal_fee')} as renewal_fee_hundredths,
                   {money_whole('renewal_fee_epo')} as renewal_fee_epo_whole,
                   {money_cents('renewal_fee_epo')} as renewal_fee_epo_hundredths,
                   {money_whole('total_epo_amount')} as total_epo_amount_whole,
                   {money_cents('total_epo_amount')} as total_epo_amount_hundredths
            from split""",
        "renewal_records": "select publication_num, type, record from records_all where type = 200",
        "lapse_records": "select publication_num, type, record from records_all where type = 400",
        "restoration_records": "select publication_num, type, record from records_all where type = 500",
        "lor_records": "select publication_num, type, record from records_all where type = 600",
        "exchange_file": "select record from file_lines",
        "exchange_reconciliation": _RECONCILIATION,
        "rejects": " union all ".join([
            _rejects_body("ren_rows", 200), _rejects_body("lapse_rows", 400),
            _rejects_body("restoration_rows", 500), _rejects_body("lor_rows", 600),
            "select 600, publication_num, case when no_entry then 'cancellation without entry' else 'entry without dates' "
            "end, cast(null as varchar), 1, null, null from lor_unmatched_period",
            "select type, cast(null as varchar), 'length ' || cast(length(record) as varchar), record, null, null, null "
            "from control where length(record) <> 80",
        ]),
    }
    sel["exchange_file_written"] = "select row_number() over (order by record) as line, record from file_lines"
    sel["status_report_written"] = f"""
        select row_number() over (order by type nulls first, filing_date nulls first, publication_num nulls first,
                   date_processed nulls first, Addition_Deletion nulls first, from_year nulls first, to_year nulls first) as line,
               publication_num, cast(filing_date as varchar) as filing_date, cast(date_processed as varchar) as date_processed,
               type, Addition_Deletion, cast(from_year as varchar) as from_year, cast(to_year as varchar) as to_year
        from ({sel['status_report']}) t"""
    out = {k: _with(q, v) for k, v in sel.items()}
    monthly = {
        "monthly_report": """
            select publication_num as "European Patent (UK) Publication Number",
                   renewal_due_date as "Due Date For Payment Of Renewal",
                   renewal_year as "Ordinal Number (Annuity)",
                   lor_endorsement as "Licence Of Right Endorsement",
                   renewal_fee as "Prescribed UK Fee",
                   renewal_fee_epo as "Proportion of UK Prescribed Fee to be Remitted to EPO",
                   renewal_fee_year3 as "3rd Year EPO Minimum Amount",
                   renewal_fee_year4 as "4th Year EPO Minimum Amount",
                   total_epo_amount as "Total to be Remitted to EPO",
                   source from split""",
        "monthly_report_totals": """
            select 'Grand Total Prescribed UK Fees' as Description, format('{:,.2f}', p) as Amount from totals_m
            union all select 'Grand Total to be Remitted to EPO', format('{:,.2f}', r) from totals_m
            union all select 'Grand Total Retained', format('{:,.2f}', cast(p - r as decimal(18, 2))) from totals_m""",
    }
    totals_cte = [("totals_m", """
        select cast(coalesce(sum(renewal_fee), 0) as decimal(18, 2)) as p,
               cast(coalesce(sum(total_epo_amount), 0) as decimal(18, 2)) as r from split""")]
    out["monthly_report"] = _with(m, monthly["monthly_report"])
    headings = [f'"{h}"' for h in re.findall('as "([^"]+)"', monthly["monthly_report"])] + ["source"]
    order = [headings[1], headings[0], *headings[2:]]
    out["monthly_report_written"] = _with(m, f"""
        select row_number() over (order by {', '.join(f'{c} nulls first' for c in order)}) as line, * from ({monthly['monthly_report']}) t""")
    out["monthly_report_totals"] = _with(m + totals_cte, monthly["monthly_report_totals"])
    return out
