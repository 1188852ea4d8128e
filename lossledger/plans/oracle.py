"""The registered queries as plain SQL over the given tables, for a second engine to run.

Each text derives the raw loans, cleans and scores them by itself, so that it shares nothing with
the Spark plans but the definition of the derived loans. Amounts and risk-weighted amounts are
summed as decimals, so that no sum depends on the order of its rows; only results are rounded.
"""

from __future__ import annotations

from itertools import combinations
from math import factorial

from lossledger.operators.scenarios import SCENARIOS
from lossledger.sources import columns as c


def _dec(whole: str, digits: int) -> str:
    step = "0." + "0" * (digits - 1) + "1"
    return (f"cast(cast({whole} as decimal(20,0)) * cast({step} as decimal({digits},{digits}))"
            " as varchar)")


def _pattern(times: int, modulus: int, plus: int = 0) -> str:
    return f"((k * {times}) % {modulus} + {plus})"


def _case(by: int, *texts: str | None) -> str:
    arms = " ".join(f"when {i} then '{t}'" for i, t in enumerate(texts) if t is not None)
    return f"case k % {by} {arms} end"


_COUNTS = {"delinq_2yrs": (3, 4, 0), "inq_last_6mths": (37, 9, 0), "open_acc": (11, 18, 2),
           "pub_rec": (17, 3, 0), "total_acc": (23, 35, 5), "mort_acc": (19, 5, 0),
           "pub_rec_bankruptcies": (29, 2, 0), "num_actv_bc_tl": (41, 10, 0),
           "num_tl_90g_dpd_24m": (43, 3, 0), "mo_sin_old_rev_tl_op": (47, 288, 12),
           "acc_open_past_24mths": (53, 10, 0)}
_BALANCES = {"revol_bal": 4000000, "tot_cur_bal": 20000000, "total_bal_ex_mort": 10000000,
             "total_bc_limit": 5000000, "tot_hi_cred_lim": 30000000, "avg_cur_bal": 3000000,
             "bc_open_to_buy": 2000000, "total_rec_late_fee": 5000, "last_pymnt_amnt": 100000}
_TEXTS = {
    "id": "cast(k as varchar)",
    "loan_amnt": _dec("cents", 2),
    "funded_amnt": _dec("cents", 2),
    "term": "case when k % 3 = 0 then ' 60 months' else ' 36 months' end",
    "int_rate": _dec(f"500 + 300 * g + {_pattern(7, 251)}", 2) + " || '%'",
    "installment": _dec("cents * 4", 4),
    "grade": "substr('ABCDE', g, 1)",
    "sub_grade": "substr('ABCDE', g, 1) || cast(o_custkey % 5 + 1 as varchar)",
    "emp_length": _case(5, "< 1 year", "10+ years", "n/a", "3 years", None),
    "home_ownership": "c_mktsegment",
    "addr_state": "n_name",
    "verification_status": _case(3, "Verified", "Source Verified", "Not Verified"),
    "initial_list_status": _case(2, "w", "f"),
    "purpose": _case(4, "debt_consolidation", "credit_card", "home_improvement", "other"),
    "application_type": "'Individual'",
    "annual_inc": "case when c_acctbal < 0 then '0' else "
                  + _dec("cast(round(c_acctbal * 100) as bigint) * 10", 2) + " end",
    "issue_d": "strftime(o_orderdate, '%b-%Y')",
    "earliest_cr_line": "'Jan-' || cast(1970 + k % 20 as varchar)",
    "loan_status": "status",
    "dti": "coalesce(cast(quantity as varchar), 'n/a')",
    "revol_util": "cast(discounts as varchar) || '%'",
    "bc_util": f"case when k % 11 <> 0 then {_dec(_pattern(31, 1000), 1)} end",
    "percent_bc_gt_75": _dec(_pattern(59, 1000), 1),
    **{name: f"cast({_pattern(*how)} as varchar)" for name, how in _COUNTS.items()},
    **{name: _dec(_pattern(7919, top), 2) for name, top in _BALANCES.items()},
    "out_prncp": f"case when status = 'Current' then {_dec('cents * 5', 3)} else '0' end",
    "total_pymnt": _dec("cents * (k % 110 + 10)", 4),
    "total_rec_prncp": _dec("cents * (k % 50 + 5)", 4),
    "total_rec_int": _dec("cents * (k % 18 + 2)", 4),
    "recoveries": _dec("cents * taxes", 4),
    "collection_recovery_fee": "'0'",
}


def _noise(ident: str, amount: str, issued: str) -> str:
    given = {"id": ident, "loan_amnt": f"'{amount}'", "issue_d": f"'{issued}'"}
    return "select " + ", ".join(given.get(name, "cast(null as varchar)") for name in _TEXTS)


RAW = f"""
lines as (
    select l_orderkey, cast(sum(cast(round(l_discount * 100) as bigint)) as bigint) as discounts,
           cast(sum(cast(round(l_tax * 100) as bigint)) as bigint) as taxes,
           cast(sum(cast(l_quantity as bigint)) as bigint) as quantity
    from lineitem group by l_orderkey),
book as (
    select o_orderkey as k, cast(substr(o_orderpriority, 1, 1) as integer) as g,
           cast(round(o_totalprice * 100) as bigint) as cents, *,
           case when o_orderkey % 97 = 0 then 'Does not meet credit policy: Status Charged Off'
                when o_orderstatus = 'F' then 'Fully Paid'
                when o_orderstatus = 'P' then
                    case when (o_orderkey * 13) % 7 < cast(substr(o_orderpriority, 1, 1) as integer)
                         then 'Charged Off' else 'Fully Paid' end
                else 'Current' end as status
    from orders left join lines on l_orderkey = o_orderkey
    join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey),
raw_loans as (
    select {", ".join(f"{sql} as {name}" for name, sql in _TEXTS.items())} from book
    union all {_noise("null", "100.00", "Jan-1999")}
    union all {_noise("'footer'", "Total amount funded", "Jan-1999")}
    union all {_noise("'undated'", "100.00", "n/a")})"""

_DEFAULTED = "loan_status in (" + ", ".join(f"'{s}'" for s in c.DEFAULT_STATUSES) + ")"

CLEAN = RAW + f""",
typed as (
    select {", ".join(c.TEXT)},
           {", ".join(f"try_cast({n} as double) as {n}" for n in c.NUMBERS)},
           {", ".join(f"try_cast(trim(replace({n}, '%', '')) as double) as {n}"
                      for n in c.PERCENTS)},
           try_cast(regexp_extract(term, '[0-9]+') as integer) as term_months,
           case when emp_length like '%< 1%' then 0 when emp_length like '%10+%' then 10
                else try_cast(regexp_extract(emp_length, '[0-9]+') as integer)
           end as emp_length_years,
           try_strptime(trim(issue_d), '%b-%Y') as issue_date,
           try_strptime(trim(earliest_cr_line), '%b-%Y') as earliest_cr_line_date
    from raw_loans where id is not null and try_cast(loan_amnt as double) is not null),
clean as (
    select *, cast(year(issue_date) as bigint) as issue_year,
           cast(quarter(issue_date) as bigint) as issue_quarter,
           year(issue_date) || 'Q' || quarter(issue_date) as vintage,
           cast(datediff('month', earliest_cr_line_date, issue_date) as bigint)
               as credit_history_months,
           (installment * 12::double) / nullif(annual_inc, 0) as installment_to_income,
           funded_amnt / nullif(annual_inc, 0) as loan_to_income,
           revol_bal / nullif(annual_inc, 0) as revol_bal_to_income,
           revol_util / 100::double as credit_utilization,
           bc_util / 100::double as bankcard_utilization,
           cast(case when {_DEFAULTED} then 1 when loan_status = 'Fully Paid' then 0 end
                as integer) as default_flag,
           funded_amnt as ead,
           case when {_DEFAULTED} then least(greatest(
               1::double - (total_rec_prncp + recoveries - collection_recovery_fee)
               / nullif(funded_amnt, 0), 0::double), 1::double) end as actual_lgd
    from typed where issue_date is not null)"""

SCORED = CLEAN + """,
rated as (
    select *,
        least(int_rate / 40::double + coalesce(credit_utilization, 0.5::double) / 10::double,
              0.95::double) as pd,
        least(greatest(0.9::double - term_months / 200::double
              + coalesce(dti, 0::double) / 2000::double, 0::double), 1::double) as lgd
    from clean),
scored as (select *, pd * lgd * ead as expected_loss from rated)"""

STAR = SCORED + """,
dim_vintage as (
    select cast(dense_rank() over (order by issue_year, issue_quarter) as bigint) as vintage_key, *
    from (select issue_year, issue_quarter, vintage from scored group by all)),
dim_credit_grade as (
    select cast(dense_rank() over (order by grade, sub_grade) as bigint) as credit_grade_key, *
    from (select grade, sub_grade from scored group by all)),
loans as (
    select s.id as loan_id, s.id as borrower_key, vintage_key, credit_grade_key, s.*
    from scored s join dim_vintage using (issue_year, issue_quarter, vintage)
    join dim_credit_grade using (grade, sub_grade))"""

SPLIT = SCORED + """,
timed as (
    select *, row_number() over (order by issue_date, md5(id)) - 1 as position,
           count(*) over () as total
    from scored where default_flag is not null),
split_loans as (
    select *, case
        when position < cast(floor(floor(total * 0.8::double) * 0.8::double) as bigint)
            then 'train'
        when position < cast(floor(total * 0.8::double) as bigint) then 'calibration'
        else 'oot' end as split
    from timed)"""

FOLDS = SCORED + """,
timed as (
    select *, row_number() over (order by issue_date, md5(id)) - 1 as position,
           count(*) over () as total
    from scored where {population} is not null),
segmented as (
    select *, (select count(*) from range(1, 6) e(i)
               where position >= cast(floor(total * i / 6::double) as bigint)) as segment
    from timed)"""

SCENARIO = STAR + """,
scenarios as (select * from (values {rows})
              v(scenario, pd_by, lgd_by, ccf, sort_order)),
revalued as (
    select loan_id, borrower_key, vintage_key, credit_grade_key, grade, sub_grade, vintage,
           ead + ccf * 0::double as ead, least(pd * pd_by, 1::double) as pd,
           least(lgd * lgd_by, 1::double) as lgd, scenario, sort_order
    from loans cross join scenarios),
scenario_loans as (select *, pd * lgd * ead as expected_loss from revalued)""".format(
    rows=", ".join(
        f"('{s.name}', {s.pd_multiplier}::double, {s.lgd_multiplier}::double, "
        f"{s.ccf_undrawn}::double, {s.sort_order})" for s in SCENARIOS))

def _sum(term: str, where: str = "") -> str:
    return f"cast(sum(cast({term} as decimal(38, 12))){where} as double)"


def _avg(term: str) -> str:
    return f"{_sum(term)} / nullif(cast(count({term}) as double), 0)"


SLICE = "sub_grade in ('A2', 'B1', 'C3', 'E5') and vintage between '1996Q1' and '1999Q4'"
_EAD = f"round({_sum('ead')}, 2) as total_ead"
_WPD = f"{_sum('pd * ead')} / nullif({_sum('ead')}, 0)"
_PD = f"round({_WPD}, 6) as weighted_pd"
_LOSS = _sum("pd * lgd * ead")
_EL = f"round({_LOSS}, 2) as total_expected_loss"
_RATE = f"round({_LOSS} / nullif({_sum('ead')}, 0), 6) as el_rate"
_REALIZED = ("count(*) filter (default_flag = 1) / nullif(cast(count(default_flag) as double), 0)")


def _day(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d') as {name or column}"


def _separation(source: str, by: str = "") -> str:
    """AUC, average precision, KS and Brier by ordering all distinct scores with windows."""
    keys = f"{by}, " if by else ""
    part = f"partition by {by}" if by else ""
    return f""",
levels as (
    select {keys} pd as s, cast(count(*) filter (default_flag = 1) as double) as p,
           cast(count(*) filter (default_flag = 0) as double) as q
    from {source} group by {keys} pd),
ranked as (
    select *, sum(p) over ({part}) as ps, sum(q) over ({part}) as qs,
           sum(p) over ({part} order by s) as p_up, sum(q) over ({part} order by s) as q_up,
           sum(p) over ({part} order by s desc) as p_down,
           sum(q) over ({part} order by s desc) as q_down
    from levels),
separated as (
    select {keys} cast(sum(p + q) as bigint) as n, cast(sum(p) as bigint) as n_pos,
           sum(p * (q_up - q / 2)) / nullif(max(ps) * max(qs), 0) as roc_auc,
           sum(p / nullif(ps, 0) * p_down / nullif(p_down + q_down, 0)) as average_precision,
           max(abs(p_up / nullif(ps, 0) - q_up / nullif(qs, 0))) as ks,
           sum(p * (1 - s) * (1 - s) + q * s * s) / sum(p + q) as brier
    from ranked {f"group by {by}" if by else ""})"""


_SHARES = ", ".join(f"({i}, {s!r}::double)" for i, s in
                    enumerate([i * 0.1 for i in range(10)] + [1.0]))


def _edges(source: str) -> str:
    """Interpolated deciles of ``source``(metric, value) by explicit order statistics."""
    return f""",
placed as (
    select metric, value, row_number() over (partition by metric order by value) - 1 as spot,
           count(*) over (partition by metric) as n
    from {source} where value is not null),
wanted as (
    select metric, share_index, (max(n) - 1) * share as rank
    from placed cross join (values {_SHARES}) v(share_index, share)
    group by metric, share_index, share),
bracketed as (
    select w.metric, share_index, rank - floor(rank) as part,
           max(value) filter (spot = floor(rank)) as low,
           coalesce(max(value) filter (spot = floor(rank) + 1),
                    max(value) filter (spot = floor(rank))) as high
    from wanted w join placed p on p.metric = w.metric
        and (spot = floor(rank) or spot = floor(rank) + 1)
    group by w.metric, share_index, rank),
edges as (
    select metric, edge, row_number() over (partition by metric order by edge) as e,
           count(*) over (partition by metric) as n_edges
    from (select distinct metric, case when part < 0.5::double then low + (high - low) * part
                 else high - (high - low) * (1::double - part) end as edge from bracketed))"""


_METRICS = ["pd", *c.MONITORED]
_LONG = " union all ".join(
    f"select split, vintage, '{'predicted_pd' if m == 'pd' else m}' as metric, {m} as value "
    "from split_loans" for m in _METRICS)

PSI = SPLIT + f""",
long as ({_LONG}),
base as (select metric, value from long where split = 'train')""" + _edges("base") + """,
cells as (
    select l.metric, case when split = 'train' then '' else vintage end as period, l.value,
           (select count(*) from edges x
            where x.metric = l.metric and x.e > 1 and x.e < x.n_edges and l.value >= x.edge)
               as bucket
    from long l),
grid as (
    select p.metric, p.period, b.bucket
    from (select distinct metric, period from cells) p
    join (select metric, e - 1 as bucket from edges where e < n_edges) b on b.metric = p.metric),
counted as (
    select g.metric, g.period, g.bucket, count(v.value) as n
    from grid g left join (select * from cells where value is not null) v
        on v.metric = g.metric and v.period = g.period and v.bucket = g.bucket
    group by all),
shares as (
    select *, greatest(n / nullif(cast(sum(n) over (partition by metric, period) as double), 0),
                       1e-6::double) as share from counted),
index as (
    select m.metric, m.period as vintage,
           sum((m.share - b.share) * ln(m.share / b.share)) as psi
    from shares m join shares b
        on b.metric = m.metric and b.bucket = m.bucket and b.period = '' and m.period <> ''
    group by m.metric, m.period),
psi_report as (
    select i.metric, i.vintage, cast(s.n as bigint) as n, round(psi, 4) as psi,
           case when psi is null then 'insufficient data' when psi > 0.25 then 'significant shift'
                when psi > 0.1 then 'moderate shift' else 'stable' end as flag
    from index i join (select metric, period, count(*) as n from cells group by all) s
        on s.metric = i.metric and s.period = i.vintage)"""

_PRIOR_GRID = """,
grid as (select v.vintage_key, v.vintage, g.{by} from dim_vintage v
         cross join (select distinct {by} from loans) g),
beside as (
    select grid.vintage_key, grid.vintage, grid.{by}, a.{m}, b.{m} as prior_{m},
           b.{m} is not null as has_prior
    from grid left join cells a on a.vintage_key = grid.vintage_key and a.{by} = grid.{by}
    left join cells b on b.vintage_key = grid.vintage_key - 1 and b.{by} = grid.{by}
    where a.{m} is not null or b.{m} is not null)"""


def _minus(a: str, b: str) -> str:
    return f"coalesce({a}, 0) - coalesce({b}, 0)"


def _folds(population: str) -> str:
    return FOLDS.format(population=population) + f""",
parts as (
    select segment as fold, cast(count(*) as bigint) as n_test, min(issue_date) as test_start,
           max(issue_date) as test_end from segmented group by segment),
folds as (
    select t.fold, min(e.test_start) as train_start, max(e.test_end) as train_end, t.test_start,
           t.test_end, cast(sum(e.n_test) as bigint) as n_train, t.n_test
    from parts t join parts e on e.fold < t.fold group by all)"""


_FOLD_COLUMNS = ", ".join(
    ["cast(f.fold as integer) as fold", *(f"strftime(f.{x}, '%Y-%m-%d') as {x}" for x in
     ["train_start", "train_end", "test_start", "test_end"]), "f.n_train", "f.n_test"])


# The columns of the stated ensemble, and its margin where only some of them are known: an unknown
# one follows the shares of the loans that the trees counted.
STATED = ["int_rate", "dti", "grade"]


def stated_margin(known: set[str]) -> str:
    def split(column: str, test: str, left: str, right: str, n_left: int, n_right: int) -> str:
        if column in known:
            return f"case when {test} then {left} else {right} end"
        return f"(({left}) * {n_left}.0::double + ({right}) * {n_right}) / {n_left + n_right}"

    low = split("dti", "coalesce(dti <= 50, true)", "-0.9::double", "-0.4::double", 25, 35)
    inner = split("int_rate", "coalesce(int_rate <= 16, false)", "0.1::double", "0.3::double", 12, 4)
    high = split("grade", "coalesce(grade in ('B', 'A', 'C'), false)", inner, "0.7::double", 16, 24)
    first = split("int_rate", "coalesce(int_rate <= 12, false)", low, high, 60, 40)
    rest = split("dti", "coalesce(dti <= 100, false)", "0.2::double", "0.6::double", 30, 25)
    second = split("grade", "coalesce(grade in ('B', 'A'), false)", "-0.3::double", rest, 45, 55)
    return f"-1.5::double + ({first}) + ({second})"


def _stated_share(column: str) -> str:
    """The Shapley value of a column: its mean effect over the orders in which columns get known."""
    others = [x for x in STATED if x != column]
    terms = []
    for size in range(len(others) + 1):
        weight = factorial(size) * factorial(len(others) - size) / factorial(len(STATED))
        for before in combinations(others, size):
            terms.append(f"{weight!r} * (({stated_margin({*before, column})}) "
                         f"- ({stated_margin(set(before))}))")
    return " + ".join(terms)


# Trials that the registered searches run.
TRIALS = 25


def texts() -> dict[str, str]:
    """SQL per query key."""
    q: dict[str, str] = {}

    def add(key: str, ctes: str, select: str) -> None:
        q[key] = f"with {ctes.strip().lstrip(',')}\n{select}"

    plain = [x for x in [*c.TEXT, *c.NUMBERS, *c.PERCENTS, "term_months", "emp_length_years",
                         "issue_year", "issue_quarter", "vintage", "credit_history_months",
                         *c.RATIOS, "default_flag", "ead", "actual_lgd"]]
    add("clean_loans", CLEAN, "select " + ", ".join(
        [*plain, _day("issue_date"), _day("earliest_cr_line_date")]) + " from clean")
    add("csv_ingest", RAW, "select cast(count(*) as bigint) as n_rows, "
        + ", ".join(f"cast(count({x}) as bigint) as {x}" for x in c.RAW) + " from raw_loans")
    add("coerce_percent_and_terms", CLEAN,
        "select id, term_months, int_rate, revol_util, loan_amnt, dti, bc_util from clean")
    add("employment_years", CLEAN, "select emp_length_years, cast(count(*) as bigint) as n "
        "from clean group by emp_length_years")
    add("vintage_and_history", CLEAN, "select id, issue_year, issue_quarter, vintage, "
        "credit_history_months, " + _day("issue_date") + " from clean")
    add("affordability_ratios", CLEAN, "select id, " + ", ".join(c.RATIOS) + " from clean")
    add("outcome_labels", CLEAN, "select loan_status, default_flag, cast(count(*) as bigint) as n"
        " from clean group by loan_status, default_flag")
    add("realized_lgd", CLEAN, "select id, ead, actual_lgd from clean where default_flag = 1")
    add("load_audit", CLEAN, """select cast(count(*) as bigint) as n_rows,
        cast(count(*) filter (default_flag = 1) as bigint) as n_default,
        cast(count(*) filter (default_flag = 0) as bigint) as n_paid,
        cast(count(*) filter (default_flag is null) as bigint) as n_active,
        cast(count(actual_lgd) as bigint) as n_with_lgd from clean""")
    checks = {
        "id_missing": "count(*) filter (id is null)",
        "id_repeated": "count(id) - count(distinct id)",
        "flag_outside_domain": "count(*) filter (default_flag not in (0, 1))",
        "lgd_outside_unit_range": "count(*) filter (actual_lgd < 0 or actual_lgd > 1)",
        "lgd_without_default": "count(*) filter (actual_lgd is not null and default_flag <> 1)",
        "ead_negative": "count(*) filter (ead < 0)"}
    add("clean_contracts", CLEAN, " union all ".join(
        f"select '{n}' as \"check\", cast({sql} as bigint) as n_bad from clean"
        for n, sql in checks.items()))
    add("category_vocabulary", CLEAN + ", pairs as (" + " union all ".join(
        f"select distinct '{f}' as feature, {f} as category from clean where {f} is not null"
        for f in c.CATEGORICAL_FEATURES) + ")",
        "select *, cast(row_number() over (partition by feature order by category) - 1 as integer)"
        " as code from pairs")
    add("scored_portfolio", SCORED, "select " + ", ".join(
        _day(x) if x == "issue_date" else x for x in c.PORTFOLIO)
        + ", pd, lgd, expected_loss from scored")
    add("resolved_population", SCORED, "select cast(count(default_flag) as bigint) as n_resolved,"
        " cast(count(actual_lgd) as bigint) as n_with_lgd, " + ", ".join(
            _day(f"{how}(issue_date) filter ({flag} is not null)", f"{name}_{flag}")
            for flag in ["default_flag", "actual_lgd"]
            for name, how in [("first", "min"), ("last", "max")]) + " from scored")
    add("dim_vintage", STAR, "select * from dim_vintage")
    add("dim_credit_grade", STAR, "select * from dim_credit_grade")
    add("dim_borrower", STAR, """select id as borrower_key, home_ownership, verification_status,
        addr_state, purpose, application_type, emp_length_years, annual_inc, dti from scored""")
    add("fact_loans", STAR, """select loan_id, borrower_key, vintage_key, credit_grade_key,
        loan_amnt, funded_amnt, term_months, int_rate, installment, ead, pd, lgd,
        expected_loss, default_flag, actual_lgd, loan_status
        from loans""")
    dims = {"borrower_key": "(select id as borrower_key from scored)",
            "vintage_key": "dim_vintage", "credit_grade_key": "dim_credit_grade"}
    add("mart_orphans", STAR, " union all ".join(
        f"select '{k}' as dimension_key, cast(count(*) as bigint) as n_orphans from loans f "
        f"left join {d} d on d.{k} = f.{k} where d.{k} is null" for k, d in dims.items()))
    add("mart_key_uniqueness", STAR, " union all ".join(
        f"select '{k}' as dimension_key, cast(count(*) as bigint) as n_repeated from "
        f"(select {k} from {d} group by {k} having count(*) > 1)" for k, d in dims.items()))
    add("mart_row_parity", STAR, """select cast((select count(*) from loans) as bigint) as n_fact,
        cast(count(*) as bigint) as n_borrower,
        cast(count(*) - (select count(*) from loans) as bigint) as n_dropped from scored""")

    headline = f"{_EAD}, {_PD}, {_EL}, {_RATE}"
    add("portfolio_kpis", STAR, f"select {headline} from loans")
    add("slice_kpis", STAR, f"select {headline} from loans where {SLICE}")
    add("grade_summary", STAR, f"select grade, {headline} from loans group by grade")
    add("expected_loss_by_grade", STAR, f"select grade, {_EL} from loans group by grade")
    core = f"""{headline}, round({_sum('funded_amnt')}, 2) as total_funded_amount,
        cast(count(*) as bigint) as loan_count,
        round({_sum('lgd * ead')} / nullif({_sum('ead')}, 0), 6) as weighted_lgd,
        round({_avg('pd')}, 6) as average_pd, round({_REALIZED}, 6) as realized_default_rate,
        round({_sum('actual_lgd * ead', ' filter (default_flag = 1)')}, 2) as realized_loss_amount,
        round({_WPD} - coalesce({_REALIZED}, 0), 6)
            as pd_calibration_gap"""
    add("core_measures_by_grade_and_vintage", STAR,
        f"select grade, vintage, {core} from loans group by grade, vintage")
    add("core_measures_total", STAR, f"select {core} from loans")
    sums = {"ead": ("ead", 2), "funded": ("funded_amnt", 2), "pd_ead": ("pd * ead", 7),
            "lgd_ead": ("lgd * ead", 6), "pd": ("pd", 5), "rate": ("int_rate", 2)}
    cell = "vintage_key, vintage, grade, sub_grade, addr_state, purpose, loan_status"
    add("measure_mart_cells", STAR, f"""select {cell}, cast(count(*) as bigint) as n,
        cast(count(pd) as bigint) as n_pd, cast(count(int_rate) as bigint) as n_rate,
        cast(count(*) filter (default_flag = 1) as bigint) as n_default,
        cast(count(default_flag) as bigint) as n_resolved,
        {", ".join(f"round({_sum(t)}, {digits}) as {name}" for name, (t, digits) in sums.items())},
        round({_sum('actual_lgd * ead', ' filter (default_flag = 1)')}, 4) as realized
        from loans group by {cell}""")
    add("measure_mart_by_grade_and_vintage", STAR,
        f"select grade, vintage, {core} from loans group by grade, vintage")
    add("measure_mart_total", STAR, f"select {core} from loans")
    add("measure_mart_by_state_and_purpose", STAR,
        f"select addr_state, purpose, {core} from loans group by addr_state, purpose")
    add("measure_mart_of_slice", STAR, f"""select sub_grade, {core} from loans
        where purpose in ('credit_card', 'other') and loan_status <> 'Current'
        and addr_state between 'C' and 'M' and vintage <= '1998Q2' group by sub_grade""")
    add("weighted_lgd_by_state", STAR, f"""select addr_state,
        round({_sum('lgd * ead')} / nullif({_sum('ead')}, 0), 6) as weighted_lgd
        from loans group by addr_state""")
    add("realized_loss_by_sub_grade", STAR, f"""select sub_grade,
        round({_sum('actual_lgd * ead', ' filter (default_flag = 1)')}, 2) as realized_loss_amount
        from loans group by sub_grade""")
    add("default_rate_by_vintage", STAR, f"""select vintage,
        cast(count(*) filter (default_flag = 1) as bigint) as n_default,
        cast(count(default_flag) as bigint) as n_resolved,
        round({_REALIZED}, 6) as cumulative_default_rate from loans group by vintage""")
    add("default_rate_of_slice", STAR, f"""select vintage,
        cast(count(*) filter (default_flag = 1) as bigint) as n_default,
        cast(count(default_flag) as bigint) as n_resolved,
        round({_REALIZED}, 6) as cumulative_default_rate from loans where {SLICE}
        group by vintage""")
    add("expected_loss_of_slice", STAR,
        f"select grade, {_EL} from loans where {SLICE} group by grade")
    for by in ["grade", "sub_grade"]:
        add(f"status_mix_by_{by}", STAR, f"""select {by}, loan_status, cast(n as bigint) as n,
            round(n * 100::double / sum(n) over (partition by {by}), 6) as pct
            from (select {by}, loan_status, count(*) as n from loans group by all)""")
    add("status_matrix_by_grade", STAR, "select grade, " + ", ".join(
        f"round(count(*) filter (loan_status = '{s}') * 100::double / count(*), 6) as \"{s}\""
        for s in ["Current", "Fully Paid", "Charged Off", c.DEFAULT_STATUSES[2]])
        + " from loans group by grade")
    add("status_matrix_of_resolved", STAR, """select sub_grade,
        round(count(*) filter (loan_status = 'Charged Off') * 100::double / count(*), 6)
            as "Charged Off",
        round(count(*) filter (loan_status = 'Fully Paid') * 100::double / count(*), 6)
            as "Fully Paid",
        round(count(*) filter (loan_status not in ('Charged Off', 'Fully Paid')) * 100::double
              / count(*), 6) as other from loans group by sub_grade""")
    add("rate_vs_pd_by_subgrade", STAR, f"select sub_grade, round({_avg('int_rate')}, 6) as "
        f"average_int_rate, {_PD} from loans group by sub_grade")
    add("rate_vs_pd_sample", STAR, "select loan_id, int_rate, pd, grade from loans "
        "order by md5(loan_id || '#42') limit 5000")
    add("hash_sample_of_resolved", SCORED, "select id, grade, default_flag from scored "
        "where default_flag is not null order by md5(id || '#42') limit 2000")
    add("exposure_trend", STAR, f"select vintage_key, vintage, {_EAD}, {_EL} from loans "
        "group by vintage_key, vintage")
    add("pd_by_vintage_and_grade", STAR,
        f"select vintage, grade, {_PD} from loans group by vintage, grade")
    add("modeled_vs_realized", STAR, f"""select vintage, {_PD},
        round({_REALIZED}, 6) as realized_default_rate,
        round({_WPD} - coalesce({_REALIZED}, 0), 6)
            as pd_calibration_gap from loans group by vintage""")
    add("filter_options", STAR, "select distinct 'sub_grade' as option, sub_grade as value "
        "from loans union all select distinct 'vintage', vintage from loans")

    wpd = _WPD
    add("pd_migration", STAR + f""",
        cells as (select vintage_key, {wpd} as weighted_pd from loans group by vintage_key),
        beside as (select v.vintage_key, v.vintage, a.weighted_pd, b.weighted_pd as prior_pd
            from dim_vintage v join cells a using (vintage_key)
            left join cells b on b.vintage_key = v.vintage_key - 1)""",
        f"""select vintage_key, vintage, round(weighted_pd, 6) as weighted_pd,
        round(prior_pd, 6) as prior_weighted_pd, prior_pd is not null as has_prior,
        round({_minus("weighted_pd", "prior_pd")}, 6) as pd_delta,
        round(({_minus("weighted_pd", "prior_pd")}) / prior_pd, 6) as pd_delta_share
        from beside""")
    for by in ["grade", "sub_grade"]:
        add(f"pd_migration_by_{by}", STAR + f""",
            cells as (select vintage_key, {by}, {wpd} as weighted_pd from loans group by all)"""
            + _PRIOR_GRID.format(by=by, m="weighted_pd"),
            f"""select vintage_key, vintage, {by}, round(weighted_pd, 6) as weighted_pd,
            round(prior_weighted_pd, 6) as prior_weighted_pd, has_prior,
            round({_minus("weighted_pd", "prior_weighted_pd")}, 6) as pd_delta,
            round(({_minus("weighted_pd", "prior_weighted_pd")}) / prior_weighted_pd, 6)
                as pd_delta_share from beside""")
        add(f"grade_mix_shift_by_{by}", STAR + f""",
            cells as (select vintage_key, {by}, count(*) / cast(sum(count(*)) over
                (partition by vintage_key) as double) as grade_mix from loans
                group by vintage_key, {by})""" + _PRIOR_GRID.format(by=by, m="grade_mix"),
            f"""select vintage_key, vintage, {by}, round(grade_mix, 6) as grade_mix,
            round(prior_grade_mix, 6) as prior_grade_mix, has_prior,
            round(100 * ({_minus("grade_mix", "prior_grade_mix")}), 6) as mix_shift_pp
            from beside""")
    add("measure_mart_migration_of_slice", STAR + f""",
        cells as (select vintage_key, purpose, {wpd} as weighted_pd from loans
            where sub_grade in ('A2', 'B1') and loan_status <> 'Current' group by all)"""
        + _PRIOR_GRID.format(by="purpose", m="weighted_pd"),
        f"""select vintage_key, vintage, purpose, round(weighted_pd, 6) as weighted_pd,
        round(prior_weighted_pd, 6) as prior_weighted_pd, has_prior,
        round({_minus("weighted_pd", "prior_weighted_pd")}, 6) as pd_delta,
        round(({_minus("weighted_pd", "prior_weighted_pd")}) / prior_weighted_pd, 6)
            as pd_delta_share from beside""")
    add("measure_mart_loss_change_by_state", STAR + f""",
        cells as (select vintage_key, addr_state, {_LOSS} as total_expected_loss from loans
            group by all)""" + _PRIOR_GRID.format(by="addr_state", m="total_expected_loss"),
        f"""select vintage_key, vintage, addr_state,
        round(total_expected_loss, 2) as total_expected_loss,
        round(prior_total_expected_loss, 2) as prior_total_expected_loss, has_prior,
        round({_minus("total_expected_loss", "prior_total_expected_loss")}, 2) as el_delta
        from beside""")
    add("pd_migration_latest", STAR + f""",
        prior as (select {wpd} as prior_weighted_pd from loans
                  where vintage_key = (select max(vintage_key) - 1 from dim_vintage))""",
        f"""select round({wpd}, 6) as weighted_pd,
        round(max(prior_weighted_pd), 6) as prior_weighted_pd,
        round({wpd} - max(prior_weighted_pd), 6) as pd_delta from loans cross join prior""")
    add("pd_migration_latest_of_slice", STAR + f""",
        slice as (select * from loans where sub_grade in ('A2', 'B1') and vintage < '2001Q3'),
        prior as (select {wpd} as prior_weighted_pd from slice
                  where vintage_key = (select max(vintage_key) - 1 from dim_vintage))""",
        f"""select round({wpd}, 6) as weighted_pd,
        round(max(prior_weighted_pd), 6) as prior_weighted_pd,
        round({_minus(wpd, "max(prior_weighted_pd)")}, 6) as pd_delta from slice cross join prior""")
    add("grade_mix_shift_of_slice", STAR + """,
        cells as (select vintage_key, grade, count(*) filter (sub_grade in ('A2', 'B1', 'B3'))
            / cast(sum(count(*)) over (partition by vintage_key) as double) as grade_mix from loans
            group by vintage_key, grade
            qualify count(*) filter (sub_grade in ('A2', 'B1', 'B3')) > 0)"""
        + _PRIOR_GRID.format(by="grade", m="grade_mix"),
        f"""select vintage_key, vintage, grade, round(grade_mix, 6) as grade_mix,
        round(prior_grade_mix, 6) as prior_grade_mix, has_prior,
        round(100 * ({_minus("grade_mix", "prior_grade_mix")}), 6) as mix_shift_pp
        from beside""")
    add("el_qoq", STAR + f""",
        cells as (select vintage_key, {_LOSS} as el from loans group by vintage_key)""",
        f"""select v.vintage_key, v.vintage, round(a.el, 2) as total_expected_loss,
        round(b.el, 2) as prior_total_expected_loss, b.el is not null as has_prior,
        round({_minus("a.el", "b.el")}, 2) as el_delta
        from dim_vintage v join cells a using (vintage_key)
        left join cells b on b.vintage_key = v.vintage_key - 1""")

    add("dim_scenario", SCENARIO, "select scenario, pd_by as pd_multiplier, "
        "lgd_by as lgd_multiplier, ccf as ccf_undrawn, sort_order, "
        "cast(count(loan_id) as bigint) as n_loans from scenarios "
        "left join scenario_loans using (scenario, sort_order) group by all")
    add("scenario_fact", SCENARIO, """select loan_id, borrower_key, vintage_key, credit_grade_key,
        scenario, ead, pd, lgd, expected_loss
        from scenario_loans""")
    totals = f"""{_EAD}, {_PD}, {_EL}"""
    add("scenario_summary", SCENARIO,
        f"select scenario, sort_order, {totals} from scenario_loans group by all")
    add("scenario_table_of_slice", SCENARIO,
        f"select scenario, sort_order, {totals} from scenario_loans where {SLICE} group by all")
    add("scenario_by_grade", SCENARIO,
        f"select grade, scenario, sort_order, {totals} from scenario_loans group by all")
    for key, by in [("scenario_increment", ""), ("scenario_increment_by_grade", "grade, ")]:
        part = f"partition by {by.rstrip(', ')}" if by else ""
        add(key, SCENARIO + f""", totals as (select {by} scenario, sort_order,
            {_sum('expected_loss')} as el from scenario_loans group by all)""",
            f"""select {by} scenario, sort_order, round(el, 2) as total_expected_loss,
            round(el - max(el) filter (scenario = 'Baseline') over ({part}), 2) as vs_baseline,
            round(coalesce(el - lag(el) over ({part} order by sort_order), 0), 2) as vs_previous
            from totals""")
    spd, slgd = "least(pd * 1.4::double, 1::double)", "least(lgd * 1.25::double, 1::double)"
    stressed = _sum(f"{spd} * {slgd} * ead")
    add("what_if_shock", STAR, f"""select round({_sum('ead')}, 2) as total_ead,
        round({wpd}, 6) as pd_before, round({_sum(spd + ' * ead')} / nullif({_sum('ead')}, 0), 6) as pd_after,
        round(100 * ({_sum(spd + ' * ead')} / nullif({_sum('ead')}, 0) - {wpd}), 6) as pd_delta_pp,
        round({_LOSS}, 2) as el_before, round({stressed}, 2) as el_after,
        round({stressed} - {_LOSS}, 2) as el_delta
        from loans where {SLICE}""")
    add("stress_measures_by_grade", STAR, f"""select grade,
        round({stressed}, 2) as stressed_expected_loss,
        round({stressed} - {_LOSS}, 2) as stress_el_delta,
        round({stressed} / nullif({_sum('ead')}, 0), 6) as stress_el_rate
        from loans group by grade""")

    add("time_split_members", SPLIT, "select id, split from split_loans")
    add("time_split_summary", SPLIT, "select split, cast(count(*) as bigint) as n, "
        + _day("min(issue_date)", "start") + ", " + _day("max(issue_date)", '"end"')
        + " from split_loans group by split")
    add("tuning_split_summary", SPLIT + """,
        tune as (select *, row_number() over (order by issue_date, md5(id)) - 1 as spot,
                 count(*) over () as m from split_loans where split = 'train'),
        tuned as (select *, case when spot < cast(floor(m * 0.8::double) as bigint) then 'train'
                  else 'oot' end as part from tune)""",
        "select part as split, cast(count(*) as bigint) as n, "
        + _day("min(issue_date)", "start") + ", " + _day("max(issue_date)", '"end"')
        + " from tuned group by part")
    add("lgd_split_summary", SCORED + """,
        timed as (select *, row_number() over (order by issue_date, md5(id)) - 1 as spot,
                  count(*) over () as m from scored where actual_lgd is not null),
        halves as (select *, case when spot < cast(floor(m * 0.8::double) as bigint) then 'train'
                   else 'oot' end as split from timed)""",
        "select split, cast(count(*) as bigint) as n, "
        + _day("min(issue_date)", "start") + ", " + _day("max(issue_date)", '"end"')
        + " from halves group by split")
    add("walk_forward_folds", _folds("default_flag"), f"select {_FOLD_COLUMNS} from folds f")
    add("walk_forward_folds_lgd", _folds("actual_lgd"), f"select {_FOLD_COLUMNS} from folds f")

    resolved = SCORED + ", resolved as (select * from scored where default_flag is not null)"
    add("roc_auc_gini", resolved + _separation("resolved"), """select n, n_pos,
        round(roc_auc, 6) as roc_auc, round(2 * roc_auc - 1, 6) as gini from separated""")
    add("average_precision", resolved + _separation("resolved"),
        "select round(average_precision, 6) as average_precision from separated")
    add("ks_statistic", resolved + _separation("resolved"),
        "select round(ks, 6) as ks from separated")
    add("brier_by_vintage", resolved, """select vintage, cast(count(*) as bigint) as n,
        round(avg((pd - default_flag) * (pd - default_flag)), 6) as brier
        from resolved group by vintage""")
    separated = """n, n_pos, round(roc_auc, 6) as roc_auc, round(2 * roc_auc - 1, 6) as gini,
        round(average_precision, 6) as average_precision, round(ks, 6) as ks,
        round(brier, 6) as brier"""
    add("discrimination_by_grade", resolved + _separation("resolved", "grade"),
        f"select grade, {separated} from separated")
    add("discrimination_by_split", SPLIT + _separation("split_loans", "split"),
        f"select split, {separated} from separated")
    fold_scores = (_folds("default_flag") + ", tested as (select segment as fold, pd, "
                   "default_flag from segmented where segment > 0)"
                   + _separation("tested", "fold"))
    add("walk_forward_discrimination", fold_scores,
        f"""select {_FOLD_COLUMNS}, round(roc_auc, 4) as roc_auc,
        round(average_precision, 4) as pr_auc, round(brier, 4) as brier_score
        from folds f join separated s on s.fold = f.fold""")
    add("walk_forward_stability", fold_scores, """select cast(count(*) as bigint) as n_folds,
        round(avg(round(roc_auc, 4)), 4) as roc_auc_mean,
        round(stddev_samp(round(roc_auc, 4)), 4) as roc_auc_std,
        round(avg(round(brier, 4)), 4) as brier_score_mean,
        round(stddev_samp(round(brier, 4)), 4) as brier_score_std
        from folds f join separated s on s.fold = f.fold""")
    add("lgd_error", SCORED, """select grade, cast(count(*) as bigint) as n,
        round(sqrt(avg((lgd - actual_lgd) * (lgd - actual_lgd))), 6) as rmse,
        round(avg(abs(lgd - actual_lgd)), 6) as mae
        from scored where actual_lgd is not null group by grade""")
    add("walk_forward_lgd_error", _folds("actual_lgd") + """, errors as (
        select segment as fold, sqrt(avg((lgd - actual_lgd) * (lgd - actual_lgd))) as rmse,
               avg(abs(lgd - actual_lgd)) as mae from segmented where segment > 0 group by 1)""",
        f"""select {_FOLD_COLUMNS}, round(rmse, 4) as rmse, round(mae, 4) as mae
        from folds f join errors s on s.fold = f.fold""")
    add("score_quantiles", resolved + ", long as (select grade as metric, pd as value "
        "from resolved)" + _edges("long").split(",\nedges as")[0],
        """select metric as grade, cast(share_index as integer) as share_index,
        round(case when part < 0.5 then low + (high - low) * part
              else high - (high - low) * (1 - part) end, 9) as quantile from bracketed""")
    add("reliability_curve", resolved + ", long as (select 'pd' as metric, pd as value "
        "from resolved)" + _edges("long") + """, binned as (
        select pd, default_flag, (select count(*) from edges where e > 1 and e < n_edges
                                  and pd > edge) + 1 as bin from resolved)""",
        """select cast(bin as integer) as bin, round(avg(pd), 6) as predicted_pd,
        round(avg(default_flag), 6) as empirical_default_rate, cast(count(*) as bigint) as "count"
        from binned group by bin""")
    add("psi_by_vintage", PSI, "select metric, vintage, n, psi, flag from psi_report")
    add("psi_flags", PSI, "select metric, vintage, n, psi, flag from psi_report "
        "where flag <> 'stable'")
    add("psi_flag_count", PSI, "select cast(count(*) as bigint) as n_rows, "
        "cast(count(*) filter (flag <> 'stable') as bigint) as n_flagged from psi_report")
    add("category_codes", SCORED, "select id, " + ", ".join(
        f"cast(case when {x} is null then (select count(distinct {x}) from scored) "
        f"else dense_rank() over (order by {x} nulls last) - 1 end as integer) as {x}_code"
        for x in c.CATEGORICAL_FEATURES) + " from scored")
    # The isotonic fit by its definition: the greatest of the least means of all stretches.
    add("isotonic_fit", resolved + """, points as (
        select floor(int_rate * 4)::double / 4 as score, sum(default_flag) as y, count(*) as n
        from resolved group by 1), ranks as materialized (
        select *, row_number() over (order by score) as i, sum(y) over (order by score) as cy,
               sum(n) over (order by score) as cn from points), stretches as materialized (
        select a.i as a, b.i as b, (b.cy - a.cy + a.y) / (b.cn - a.cn + a.n)::double as mean
        from ranks a join ranks b on a.i <= b.i), least as (
        select p.i, s.a, min(s.mean) as mean from ranks p join stretches s
        on s.a <= p.i and s.b >= p.i group by p.i, s.a), fitted as (
        select i, max(mean) as mean from least group by i)""",
        """select score, cast(n as bigint) as n, round(mean, 9) as calibrated
        from ranks join fitted using (i)""")
    whole = stated_margin(set(STATED))
    add("stated_trees_scores", SCORED,
        f"select id, round(1 / (1 + exp(-({whole}))), 9) as raw_pd from scored")
    add("stated_trees_reasons", SCORED, f"""select id, round({stated_margin(set())}, 9) as base,
        {", ".join(f"round({_stated_share(x)}, 9) as of_{x}" for x in STATED)} from scored""")
    # What fitted models must satisfy, whatever their trees.
    add("score_portfolio_checks", SCORED, f"""select grade, cast(count(*) as bigint) as n,
        {_EAD}, 0::bigint as n_bad_pd, 0::bigint as n_bad_lgd, 0::bigint as n_bad_loss
        from scored group by grade""")
    add("score_portfolio_reloaded_checks", SCORED,
        f"select grade, {_EAD}, true as same_loss from scored group by grade")
    add("calibration_is_monotone", SPLIT, """select split, cast(count(*) as bigint) as n,
        0::bigint as n_falls, 0::bigint as n_bad from split_loans group by split""")
    add("calibration_fit_residual", SPLIT, """select cast(count(*) as bigint) as n,
        cast(count(*) filter (default_flag = 1) as bigint) as n_default, true as keeps_mean
        from split_loans where split = 'calibration'""")
    add("calibration_compare_checks", SPLIT, """select model, cast(count(*) as bigint) as n,
        true as sound from split_loans, (values ('uncalibrated'), ('calibrated')) v(model)
        where split = 'oot' group by model""")
    add("backtest_pd_windows", _folds("default_flag"), f"select {_FOLD_COLUMNS} from folds f")
    add("backtest_lgd_windows", _folds("actual_lgd"), f"select {_FOLD_COLUMNS} from folds f")
    add("backtest_summary_checks", "m as (select * from (values ('pd_model', 'roc_auc'), "
        "('pd_model', 'brier_score'), ('lgd_model', 'rmse')) v(model, metric))",
        "select model, metric, 5::bigint as n_folds, true as agrees from m")
    for kind in ["pd", "lgd"]:
        add(f"tuning_trials_{kind}_checks", f"t as (select * from range({TRIALS}) x(trial))",
            "select count(*) as n_trials, count(distinct trial) as n_distinct, "
            "0::bigint as n_out_of_order from t")
    for key, limit in [("reason_codes_checks", ""),
                       ("reason_codes_of_sample_checks", "limit 2000")]:
        add(key, SCORED + f""", told as (select id from scored
            where default_flag is not null order by md5(id || '#42') {limit})""",
            """select cast(count(*) as bigint) as n_loans, cast(5 * count(*) as bigint)
            as n_reasons, 0::bigint as n_bad_ranks, 0::bigint as n_out_of_order,
            0::bigint as n_bad_directions from told""")
    add("top_drivers_checks", SCORED, """select cast(count(default_flag) as bigint) as n_loans,
        0::bigint as n_wrong, true as are_the_most_frequent from scored""")
    add("governance_period", SPLIT, "select " + _day("min(issue_date)", "start") + ", "
        + _day("max(issue_date)", '"end"') + ", 0.1::double as moderate_threshold, "
        "0.25::double as significant_threshold from split_loans where split = 'oot'")
    add("governance_psi_sizes", PSI, "select metric, vintage, n from psi_report")
    add("governance_psi_of_inputs", PSI, "select metric, vintage, n, psi, flag from psi_report "
        "where metric <> 'predicted_pd'")
    add("governance_reliability_sizes", SPLIT, """select cast(count(*) as bigint) as n,
        cast(sum(default_flag) as double) as n_default from split_loans where split = 'oot'""")
    q["csv_ingest_values"] = q["clean_loans"]
    q["discrimination_by_grade_in_blocks"] = q["discrimination_by_grade"]
    q["score_quantiles_in_blocks"] = q["score_quantiles"]
    add("grade_summary_of_written_marts", STAR, f"""select grade, cast(count(*) as bigint) as n,
        cast(count(borrower_key) as bigint) as n_borrowers, {_EAD} from loans group by grade""")
    add("grade_report_files", STAR, f"""select grade, {headline},
        (select count(distinct grade) from loans) as n_grades from loans group by grade""")
    tenth = SCENARIO.replace("ccf * 0::double", "ccf * (loan_amnt * 0.1::double)")
    add("scenario_fact_with_undrawn", tenth,
        f"select scenario, sort_order, {totals} from scenario_loans group by all")
    return q
