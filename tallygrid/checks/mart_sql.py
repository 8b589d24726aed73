"""Independent SQL for the accrual models, for an engine without wide decimals.

Per-day values are 128-bit integers that count units of 1e-15, so every rounding
step of the decimal columns can be repeated exactly.
"""

from __future__ import annotations

import re

from tallygrid.sources.literals import CHARGE_TEMPLATES, LOOKUPS, values_sql
from tallygrid.sources.testtables import TEST_RUN

END = f"DATE '{TEST_RUN.period_end}'"
START = f"DATE '{TEST_RUN.month_start}'"


def half_up(number: str, divisor: str | int) -> str:
    """Integer quotient rounded half away from zero; NULL-safe in both arguments."""
    return f"(sign({number}) * ((2 * abs({number}) + ({divisor})) // (2 * ({divisor}))))"


def scaled(column: str, digits: int) -> str:
    return f"CAST(CAST({column} AS DECIMAL(28, {digits})) * CAST({10 ** digits} AS DECIMAL(10, 0)) AS HUGEINT)"


def number(column: str, digits: int, shown: int = 6) -> str:
    """Integer in units of 1e-digits as a double rounded to ``shown`` decimals."""
    if digits > shown:
        column, digits = half_up(column, 10 ** (digits - shown)), shown
    return f"(CAST({column} AS DOUBLE) / {10 ** digits})"


def per_day(amount9: str, days: str) -> str:
    """Amount in 1e-9 over days, first to 17 decimals, then to 15."""
    return half_up(half_up(f"({amount9} * 100000000)", days), 100)


def month_overlap(month: str, start: str, end: str) -> str:
    return f"(datediff('day', greatest({month}.mth_sdt, {start}), least({month}.mth_edt, {end})) + 1)"


REP_MONTH = "CAST(month({s} + CAST(trunc((datediff('day', {s}, {e}) + 1) * (2.0::DOUBLE / 3.0::DOUBLE)) AS INTEGER)) AS INTEGER)"
INITCAP = "array_to_string(list_transform(string_split(lower({t}), ' '), lambda w: upper(w[1:1]) || w[2:]), ' ')"

CTES: dict[str, str] = {name: values_sql(lookup) for name, lookup in LOOKUPS.items()}
CTES["template"] = values_sql(CHARGE_TEMPLATES)

CTES["dim_date"] = """
SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       CAST(date_trunc('month', d) AS DATE) AS first_day_month, last_day(CAST(d AS DATE)) AS last_day_month
FROM (SELECT unnest(generate_series(
        CAST(date_trunc('year', min(o_orderdate)) AS TIMESTAMP),
        CAST(date_trunc('year', max(o_orderdate)) + INTERVAL 2 YEAR - INTERVAL 1 DAY AS TIMESTAMP),
        INTERVAL 1 DAY)) AS d FROM orders)"""

CTES["horizon"] = f"""
SELECT DISTINCT year, month AS mth_no, first_day_month AS mth_sdt, last_day_month AS mth_edt,
       CAST(day(last_day_month) AS INTEGER) AS mth_days
FROM dim_date WHERE first_day_month BETWEEN {START} AND {END}"""

CTES["season"] = f"""
SELECT DISTINCT year, month AS mth_no, first_day_month AS mth_sdt, last_day_month AS mth_edt,
       CAST(day(last_day_month) AS INTEGER) AS mth_days
FROM dim_date
WHERE first_day_month BETWEEN date_trunc('month', DATE '{TEST_RUN.as_of}' - INTERVAL {TEST_RUN.seasonality_months + 5} MONTH)
                          AND date_trunc('month', DATE '{TEST_RUN.as_of}' - INTERVAL 6 MONTH)"""

CTES["account"] = """
SELECT c_custkey AS id, CAST(1 + c_custkey % 2 AS INTEGER) AS service_type_id,
       list_position(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'], c_mktsegment) AS journal_segment_id,
       CASE WHEN c_custkey % 10 = 0 THEN s + 900 END AS closed_date,
       CASE WHEN c_custkey % 97 <> 0 THEN b END AS commence_date, b AS creation_date,
       1 + c_custkey % 3 AS curr_status_sid, adh_active_flag
FROM (SELECT *, CASE adh_active_flag WHEN 1 THEN s ELSE s - 365 END AS b
      FROM (SELECT *, DATE '1995-01-01' + CAST((c_custkey * 37) % 2300 AS INTEGER) AS s FROM customer)
      CROSS JOIN (VALUES (1), (0)) AS v(adh_active_flag)
      WHERE adh_active_flag = 1 OR c_custkey % 20 = 19)"""

CTES["meter"] = """
SELECT c_custkey AS account_id, c_nationkey, meter,
       CASE WHEN c_custkey % 11 = 0 THEN 'Y' ELSE 'N' END AS vacant_site, 'M' || CAST(meter AS VARCHAR) AS meter_id
FROM (SELECT *, c_custkey AS meter FROM customer
      UNION ALL SELECT *, c_custkey + 1000000000000 FROM customer WHERE c_custkey % 50 = 0)"""

CTES["invoice"] = """
SELECT o_orderkey AS id, o_custkey AS account_id, d + 5 AS posted_date,
       d - CAST(o_orderkey % 60 AS INTEGER) AS usage_start_date, d AS usage_end_date, d + 19 AS due_date,
       CASE WHEN o_orderkey % 50 = 0 THEN 'REVERSAL' ELSE 'NORMAL' END AS type,
       CASE WHEN o_orderkey % 40 = 0 THEN o_orderkey + 1 WHEN o_orderkey % 3 = 0 THEN 0 WHEN o_orderkey % 3 = 1 THEN -1 END
         AS rev_invoice_id,
       1 + o_orderkey % 4 AS ppd_adjustment_id,
       CAST(CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice ELSE 0 END AS DECIMAL(18, 4)) AS discount_amount,
       CAST(o_totalprice AS DECIMAL(18, 4)) AS allocated_amount
FROM (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders)"""

CTES["line"] = """
SELECT l_orderkey * 10 + l_linenumber AS id, o_custkey AS account_id, l_orderkey AS invoice_id,
       CASE WHEN l_partkey % 40 = 0 OR l_partkey % 41 = 0 THEN 2 WHEN l_partkey % 43 = 0 THEN 3 ELSE 1 END AS category_id,
       CASE WHEN l_partkey % 53 = 0 THEN NULL WHEN l_partkey % 40 = 0 THEN 36 ELSE plan_id END AS plan_item_type_id,
       CASE WHEN class_id = 5 AND l_partkey % 2 = 0 THEN 6 ELSE class_id END AS time_class_id,
       CASE WHEN l_partkey % 6 = 0 THEN l_partkey % 4 + 1 END AS adjustment_id,
       1 + l_partkey % 6 AS adjustment_type_id, description,
       CAST(o_orderdate AS DATE) - CAST(o_orderkey % 60 AS INTEGER) AS start_date, CAST(o_orderdate AS DATE) AS end_date,
       CASE WHEN l_linenumber <> 5 THEN net WHEN l_partkey % 2 = 0 THEN 0 ELSE -net END AS net_amount,
       round(price * tax, 2) AS tax_amount, round(price * disc, 2) AS discount_net,
       CASE WHEN l_partkey % 30 = 0 THEN 0 WHEN l_partkey % 31 = 0 THEN NULL ELSE CAST(l_quantity AS DECIMAL(18, 4)) END AS quantity,
       CAST(CASE WHEN l_linenumber = 7 THEN 1.5 ELSE 1 END AS DECIMAL(8, 4)) AS multiplier,
       disc * 10 AS rate, 1 + tax AS loss_factor
FROM (SELECT *, round(price * (1 - disc), 2) AS net
      FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18, 2)) AS price, CAST(abs(l_discount) AS DECIMAL(4, 2)) AS disc,
                   CAST(abs(l_tax) AS DECIMAL(4, 2)) AS tax FROM lineitem))
JOIN orders ON o_orderkey = l_orderkey
JOIN template ON line_number = l_linenumber AND variant = l_partkey % 3
WHERE NOT (l_partkey % 25 = 0 OR o_custkey % 7 = 0) AND l_partkey % 29 <> 0"""

CTES["active"] = f"""
SELECT DISTINCT a.id AS account_id, st.name AS fuel_type, CASE WHEN r_regionkey = 0 THEN 'SA' ELSE r_name END AS market_region,
       n_name AS market_sub_region, seg.name AS customer_type, creation_date, commence_date AS service_sdt,
       coalesce(closed_date, DATE '9999-12-31') AS service_edt, upper(sg.name) AS account_status
FROM account a JOIN meter m ON m.account_id = a.id JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
JOIN servicetype st ON st.id = service_type_id AND st.adh_active_flag = 1
JOIN journalaccountsegment seg ON seg.id = journal_segment_id
JOIN eventtype et ON et.id = curr_status_sid JOIN statusgroup sg ON sg.id = status_group_id
WHERE a.adh_active_flag = 1 AND commence_date <= {END} AND coalesce(closed_date, DATE '9999-12-31') >= {START}
  AND creation_date <= {END}"""

CTES["posted"] = f"""
SELECT l.*, i.account_id AS invoice_account_id, posted_date, usage_start_date, usage_end_date, due_date, i.type AS invoice_type,
       rev_invoice_id, ppd_adjustment_id, discount_amount, allocated_amount, fuel_type, market_region, market_sub_region,
       customer_type AS customer_segment, service_sdt, service_edt, tc.name AS time_class_name, tc.display_grouping_override,
       CASE WHEN tc.name IN ('SUMMER', 'WINTER') OR starts_with(tc.display_grouping_override, 'CONTROLLED') THEN 'Y' ELSE 'N' END
         AS cntrl_load, {INITCAP.format(t='l.description')} AS trans_description
FROM line l JOIN active a ON a.account_id = l.account_id JOIN invoice i ON i.id = l.invoice_id
LEFT JOIN timeclass tc ON tc.id = time_class_id AND tc.adh_active_flag = 1
WHERE posted_date <= {END} AND coalesce(rev_invoice_id, 0) IN (0, -1)"""

CTES["registered"] = """
SELECT p.*, pit.name AS plan_item_name, cat.name, cat.description AS category_text
FROM posted p JOIN lineitemcategory cat ON cat.id = category_id
LEFT JOIN planitemtype pit ON pit.id = plan_item_type_id AND pit.adh_active_flag = 1
WHERE category_id = 1 OR (category_id = 2 AND pit.id = 36)"""

CTES["registry"] = """
SELECT DISTINCT r.account_id AS seq_product_item_id, market_region, market_sub_region, 'MM' AS market_segment, customer_segment,
       fuel_type, meter_id, service_sdt, service_edt, r.id, invoice_id, plan_item_type_id, adjustment_id, start_date, end_date,
       net_amount, quantity, multiplier, rate, loss_factor, discount_net, discount_amount, allocated_amount, due_date, vacant_site,
       plan_item_name, time_class_name, display_grouping_override, name, category_text AS description, rev_invoice_id, posted_date,
       trans_description, cntrl_load
FROM registered r JOIN meter m ON m.account_id = r.account_id"""

# Kind of charge to label and code suffix, as in the reported measures.
KINDS = (
    "kind, label, suffix",
    "('consumption', 'Consumption', 'CONSUM'), ('climate', 'Climate Saver', 'CLIMAT'), ('demand', 'Demand', 'DEMAND'), "
    "('supply', 'Supply Charge', 'SUPPLY'), ('solar', 'Solar', 'SOLAR'), ('solar_zero', 'Zero rated solar', 'SZR_SO'), "
    "('controlled', 'Controlled Load Usage', 'CONTRO'), ('anytime', 'Anytime Usage', 'ANYTIM'), "
    "('off_peak', 'Off Peak', 'OFFPEA'), ('peak', 'Peak', 'PEAK'), ('shoulder', 'Shoulder', 'SHOULD')",
)
CTES["kinds"] = values_sql(KINDS)


def kind_sql(solar: str, anytime: str) -> str:
    """Kind of charge as one rule list; ``solar`` and ``anytime`` differ per use."""
    return f"""CASE WHEN fuel_type = 'GAS' AND plan_item_name <> 'DAILY_RETAIL' THEN 'consumption'
         WHEN time_class_name IN ('SUMMER', 'WINTER') THEN 'climate'
         WHEN plan_item_name = 'DEMAND_RETAIL' OR contains(upper(trans_description), 'DEMAND') THEN 'demand'
         WHEN plan_item_name = 'DAILY_RETAIL' THEN 'supply' {solar}
         WHEN display_grouping_override = 'CONTROLLED' THEN 'controlled' WHEN {anytime} THEN 'anytime'
         WHEN contains(trans_description, 'Off Peak') THEN 'off_peak'
         ELSE map {{'PEAK': 'peak', 'SHOULDER': 'shoulder', 'ANYTIME': 'anytime', 'OFFPEAK': 'off_peak'}}[time_class_name] END"""


_VOLUME_SOLAR = """WHEN display_grouping_override = 'SOLAR' AND net_amount <> 0 THEN 'solar'
         WHEN display_grouping_override = 'SOLAR' AND net_amount = 0 THEN 'solar_zero'"""
_REVENUE_SOLAR = "WHEN display_grouping_override = 'SOLAR' OR plan_item_name = 'CONTRIBUTION' THEN 'solar'"
_INSIDE, _PREFIX = "contains(trans_description, 'Any Time Usage')", "starts_with(trans_description, 'Any Time Usage')"

CTES["charged"] = f"""
SELECT *, {kind_sql(_VOLUME_SOLAR, _INSIDE)} AS vol_label_kind, {kind_sql(_VOLUME_SOLAR, _PREFIX)} AS vol_code_kind,
       {kind_sql(_REVENUE_SOLAR, _INSIDE)} AS rev_label_kind, {kind_sql(_REVENUE_SOLAR, _PREFIX)} AS rev_code_kind,
       CASE WHEN fuel_type = 'ELECTRICITY' AND display_grouping_override = 'SOLAR' AND net_amount = 0 THEN 'Y' ELSE 'N' END AS solar_zr,
       {per_day(scaled('quantity * multiplier', 9), 'billing_days')} AS rate15,
       market_region = 'SA' AND coalesce(plan_item_type_id, 0) = 35 AS unmetered, {REP_MONTH.format(s='start_date', e='end_date')} AS rmp_mth_no
FROM (SELECT *, CAST(datediff('day', start_date, end_date) + 1 AS INTEGER) AS billing_days FROM registry)
WHERE NOT starts_with(trans_description, 'Concession') AND coalesce(quantity, 0) <> 0
  AND trans_description NOT IN ('Transfer Decrease Cust Balance', 'Account Adjustment', 'Unplanned Interruption Adjustment',
                                'Over Payment Refund Cheque')"""

_HEADER = """fuel_type, market_region, market_sub_region, customer_segment, cntrl_load, service_sdt, service_edt, seq_product_item_id,
       net_amount, trans_description, adjustment_id, meter_id, due_date AS in_mth_days, start_date AS bill_sdt, end_date AS bill_edt,
       name AS trans_type_code, description AS trans_type_desc, id AS invoice_header_id"""

CTES["volume"] = f"""
SELECT DISTINCT {_HEADER}, CASE vol_label_kind WHEN 'supply' THEN 'Billing Days - Supply Charge' ELSE 'Volume - ' || lk.label END AS measure_name,
       CASE vol_code_kind WHEN 'supply' THEN 'DAY_SUPPLY' ELSE 'VOL_' || ck.suffix END AS measure_code,
       CASE plan_item_name WHEN 'DAILY_RETAIL' THEN 'DAY' WHEN 'DEMAND_RETAIL' THEN 'MVA'
            ELSE CASE WHEN fuel_type = 'GAS' THEN 'GJ' ELSE 'MWh' END END AS measure_unit, billing_days, solar_zr,
       CASE WHEN unmetered THEN 0 ELSE abs(rate15) END * CAST(sign(net_amount) AS INTEGER) AS daily_unit_quantity,
       CASE WHEN solar_zr = 'N' OR unmetered THEN 0 ELSE -abs(rate15) END AS daily_unit_quantity_zr, rmp_mth_no
FROM charged LEFT JOIN kinds lk ON lk.kind = vol_label_kind LEFT JOIN kinds ck ON ck.kind = vol_code_kind
WHERE plan_item_name <> 'DAILY_RETAIL'
   OR (plan_item_name = 'DAILY_RETAIL' AND (fuel_type = 'GAS' OR (fuel_type = 'ELECTRICITY' AND rate >= 0.5)))"""

CTES["revenue"] = f"""
SELECT DISTINCT {_HEADER}, '$' AS measure_unit, 'Revenue - ' || lk.label AS measure_name, 'REV_' || ck.suffix AS measure_code,
       billing_days, solar_zr, {half_up(f"(rate15 * {scaled('rate', 6)})", 10 ** 9)} * 1000 AS daily_amt, rmp_mth_no
FROM charged LEFT JOIN kinds lk ON lk.kind = rev_label_kind LEFT JOIN kinds ck ON ck.kind = rev_code_kind"""

_NET4, _DISC4 = scaled("net_amount", 4), scaled("discount_net", 4)
_GROUP = """invoice_id, invoice_account_id, posted_date, service_sdt, service_edt, fuel_type, market_region, market_sub_region,
       customer_segment, p.description, due_date, time_class_name, display_grouping_override"""


def _discount_branch(name: str, electricity: str, other: str, total: str, joins: str, where: str) -> str:
    return f"""
SELECT fuel_type, market_region, market_sub_region, customer_segment, invoice_id, invoice_account_id AS seq_product_item_id,
       service_sdt, service_edt, posted_date AS invoice_date, min(usage_start_date) AS bill_sdt, max(usage_end_date) AS bill_edt,
       any_value(cntrl_load) AS cntrl_load, '{name}' AS measure_name,
       CASE fuel_type WHEN 'ELECTRICITY' THEN '{electricity}' ELSE '{other}' END AS measure_code, '$' AS measure_unit,
       {total} AS discount7,
       CASE WHEN fuel_type = 'ELECTRICITY' AND display_grouping_override = 'SOLAR' AND sum(net_amount) = 0 THEN 'Y' ELSE 'N' END AS solar_zr,
       due_date AS in_mth_days, any_value(trans_description) AS trans_description
FROM posted p {joins} WHERE invoice_type <> 'REVERSAL' AND {where} GROUP BY {_GROUP}"""


_STRIPPED7 = f"""sum(CASE WHEN net_amount = 0 THEN 0 WHEN tax_amount = 0 THEN {half_up(f'({_NET4} * 1000)', 11)} * 10 ELSE {_NET4} * 1000 END)"""
_TOTAL7 = f"({half_up(f'(sum({_DISC4}) * 1000)', 11)} * 10)"
# Three decimals, ties to even, back in units of 1e-7.
EVEN3 = f"""((({_TOTAL7} // 10000) + CASE WHEN {_TOTAL7} % 10000 > 5000 OR ({_TOTAL7} % 10000 = 5000 AND ({_TOTAL7} // 10000) % 2 = 1)
        THEN 1 ELSE 0 END) * 10000)"""

CTES["discounted"] = "\nUNION ALL".join([
    _discount_branch(
        "Discount - Guaranteed", "DIS_SUPPLY", "DIS", _STRIPPED7,
        "JOIN adjustmenttype t ON t.id = adjustment_type_id JOIN adjustmentgroup g ON g.id = t.adjustment_group_id",
        "t.name IN ('USAGE_DISC', 'USAGE_DISCCR', 'GD', 'GD_REV')",
    ),
    _discount_branch("Discount - Eligible PPD", "EPPD_SUPPL", "EPPD", EVEN3, "", "plan_item_type_id = 2"),
    _discount_branch(
        "Discount - PPD", "PPD_SUPPLY", "PPD", EVEN3, "JOIN adjustment d ON d.id = ppd_adjustment_id",
        "plan_item_type_id = 2 AND starts_with(d.invoice_desc, 'DISCOUNT')",
    ),
])

CTES["discount"] = f"""
SELECT DISTINCT fuel_type, market_region, market_sub_region, customer_segment, invoice_id, seq_product_item_id, service_sdt,
       service_edt, invoice_date, bill_sdt, bill_edt, cntrl_load, measure_name, measure_code, measure_unit, discount7, solar_zr,
       in_mth_days, trans_description,
       CASE WHEN discount_days > 1 AND starts_with(measure_code, 'DIS') THEN share15 END AS daily_disc_amt,
       CASE WHEN discount_days > 1 AND starts_with(measure_code, 'EPPD') THEN -share15 END AS daily_elig_ppd_amt,
       CASE WHEN discount_days > 1 AND starts_with(measure_code, 'PPD') THEN -share15 END AS daily_ppd_amt,
       discount_days, {REP_MONTH.format(s='bill_sdt', e='bill_edt')} AS rmp_mth_no
FROM (SELECT *, {per_day('(CAST(discount7 AS HUGEINT) * 100)', 'discount_days')} AS share15
      FROM (SELECT *, CAST(datediff('day', bill_sdt, bill_edt) + 1 AS INTEGER) AS discount_days FROM discounted))"""


def _core_branch(table: str, present: dict[str, str]) -> str:
    daily = ("daily_amt", "daily_unit_quantity", "daily_unit_quantity_zr", "daily_disc_amt", "daily_ppd_amt", "daily_elig_ppd_amt")
    values = ", ".join(f"{present.get(c, 'CAST(NULL AS HUGEINT)')} AS {c}" for c in daily)
    return f"""SELECT DISTINCT fuel_type, market_region, market_sub_region, customer_segment, seq_product_item_id, service_sdt, service_edt,
       bill_sdt, bill_edt, trans_description, cntrl_load, solar_zr, measure_name, measure_code, measure_unit, {values}, rmp_mth_no
FROM {table} WHERE measure_name IS NOT NULL"""


def segment_md5(month: str, prefix: str = "") -> str:
    parts = [f"CAST({month} AS VARCHAR)"] + [
        f"{prefix}{c}" for c in ("market_sub_region", "fuel_type", "market_region", "customer_segment")
    ]
    return f"md5({' || '.join(parts)})"


def cut_text(text: str) -> str:
    """Text up to the first mark, unless it is a controlled-load text."""
    head = "CASE {marks} ELSE {t} END"
    marks = f"WHEN starts_with({text}, 'Controlled') THEN {text} " + " ".join(
        f"WHEN strpos({text}, '{m}') > 1 THEN trim(substr({text}, 1, strpos({text}, '{m}') - 1))" for m in "(-"
    )
    value = head.format(marks=marks, t=text)
    for word in ("Off Peak", "Peak", "Rebate"):
        value = f"replace({value}, '{word}', '')"
    return f"trim({value})"


def charge_text(text: str, cleaned: str) -> str:
    return (
        f"CASE WHEN coalesce({cleaned}, '') = '' THEN {text} WHEN contains({cleaned}, 'Supply') "
        f"THEN replace({text}, 'Supply', 'Daily') ELSE {cleaned} END"
    )


CTES["core"] = f"""
SELECT *, {segment_md5('rmp_mth_no')} AS record_hash, 'MM' AS market_segment,
       {charge_text('trans_description', 'ex_charge_desc_orion')} AS ex_charge_desc,
       CAST(dense_rank() OVER (PARTITION BY seq_product_item_id ORDER BY bill_sdt DESC NULLS LAST) AS INTEGER) AS bill_sdt_rnk,
       CAST(dense_rank() OVER (PARTITION BY seq_product_item_id ORDER BY bill_edt DESC NULLS LAST) AS INTEGER) AS bill_edt_rnk
FROM (SELECT *, {cut_text('trans_description')} AS ex_charge_desc_orion FROM (
{_core_branch('volume', dict(daily_unit_quantity='daily_unit_quantity', daily_unit_quantity_zr='daily_unit_quantity_zr'))}
UNION ALL {_core_branch('revenue', dict(daily_amt='daily_amt'))}
UNION ALL {_core_branch('discount', {c: c for c in ('daily_disc_amt', 'daily_ppd_amt', 'daily_elig_ppd_amt')})}))"""

_SEGMENT = "fuel_type, market_region, market_segment, customer_segment, market_sub_region"
_MEANS = ("daily_unit_quantity", "daily_unit_quantity_zr", "daily_amt", "daily_disc_amt", "daily_ppd_amt", "daily_elig_ppd_amt")

CTES["seasoned"] = """
SELECT core.*, mth_no FROM core JOIN season ON bill_sdt <= mth_edt AND bill_edt >= mth_sdt"""

CTES["profile"] = f"""
SELECT f.*, g.record_count FROM (
  SELECT {_SEGMENT}, cntrl_load, solar_zr, ex_charge_desc AS trans_description, measure_code, measure_name, measure_unit, mth_no,
         {segment_md5('mth_no')} AS record_hash,
         {', '.join(half_up(f'sum({c})', f'(count({c}) * 10000000000)') + f' AS avg_{c}' for c in _MEANS)},
         count(DISTINCT seq_product_item_id) AS account_number_count
  FROM seasoned GROUP BY {_SEGMENT}, cntrl_load, solar_zr, ex_charge_desc, measure_code, measure_name, measure_unit, mth_no) f
JOIN (SELECT {segment_md5('mth_no')} AS record_hash, count(DISTINCT seq_product_item_id) AS record_count
      FROM seasoned GROUP BY {_SEGMENT}, mth_no) g ON g.record_hash = f.record_hash"""

CTES["unbilled"] = """
SELECT DISTINCT account_id AS seq_product_item_id, service_sdt, service_edt, fuel_type, market_region, market_sub_region,
       customer_type AS customer_segment, CAST(month(service_sdt) AS INTEGER) AS mth_no
FROM active WHERE service_sdt <= service_edt AND account_id NOT IN (SELECT seq_product_item_id FROM registry)"""

CTES["unbilled_month"] = f"""
SELECT DISTINCT h.mth_no, mth_sdt, mth_edt, seq_product_item_id, fuel_type, market_region, market_sub_region, service_sdt,
       service_edt, customer_segment, {segment_md5('h.mth_no')} AS record_hash
FROM horizon h JOIN unbilled u ON service_sdt <= mth_edt AND service_edt >= mth_sdt"""


def measure20(volume: str, money: str) -> str:
    """Monthly measure in units of 1e-20; ``money`` is a pattern with the column name."""
    tests = "".join(
        f" WHEN starts_with(measure_code, '{prefix}') THEN {money.format(c=column)} * total_days * 100000"
        for prefix, column in (("DIS", "daily_disc_amt"), ("PPD", "daily_ppd_amt"), ("EPPD", "daily_elig_ppd_amt"), ("REV", "daily_amt"))
    )
    return f"""CASE WHEN measure_code = 'DAY_SUPPLY' THEN CAST(total_days AS HUGEINT) * 100000000000000000000
       WHEN starts_with(measure_code, 'VOL') THEN {volume} * total_days * 100{tests} END"""


_VOLUME = "CASE solar_zr WHEN 'Y' THEN daily_unit_quantity_zr ELSE daily_unit_quantity END"
_LEAD = """seq_product_item_id, market_region, market_sub_region, market_segment, customer_segment, fuel_type, trans_description,
       cntrl_load, solar_zr, bill_sdt, bill_edt, mth_sdt, mth_edt, service_sdt, service_edt, measure_name, measure_code, measure_unit,
       CAST(total_days AS INTEGER) AS total_days"""
_RAW = ", ".join(("daily_amt", "daily_unit_quantity", "daily_unit_quantity_zr", "daily_disc_amt", "daily_ppd_amt", "daily_elig_ppd_amt"))

CTES["actual"] = f"""
SELECT DISTINCT 'Core' AS data_source, 'Actual' AS record_type, {_LEAD}, {_RAW},
       {measure20(_VOLUME, "CASE solar_zr WHEN 'Y' THEN 0 ELSE {c} END")} AS measure
FROM (SELECT core.*, h.mth_sdt, h.mth_edt, {month_overlap('h', 'bill_sdt', 'bill_edt')} AS total_days
      FROM core JOIN horizon h ON bill_sdt <= h.mth_edt AND bill_edt >= h.mth_sdt)"""

_CHARGE_MATCH = " AND ".join(
    f"s.{c} = d.{c}" for c in ("solar_zr", "cntrl_load", "trans_description", "measure_name", "measure_code")
)
_SEGMENT_MATCH = " AND ".join(f"s.{c} = d.{c}" for c in ("market_sub_region", "fuel_type", "market_region", "customer_segment"))

CTES["latest"] = f"""
SELECT * EXCLUDE (trans_description, ex_charge_desc), ex_charge_desc AS trans_description
FROM core WHERE (bill_sdt_rnk = 1 OR bill_edt_rnk = 1) AND bill_edt <= {END}"""

CTES["existing"] = f"""
SELECT DISTINCT 'Core' AS data_source, 'Accrual (Existing)' AS record_type, {_LEAD},
       {', '.join(("CASE solar_zr WHEN 'Y' THEN 0 ELSE " + c + " END AS " + c) if c in ('daily_amt', 'daily_disc_amt', 'daily_ppd_amt', 'daily_elig_ppd_amt') else c for c in _RAW.split(', '))},
       {measure20(f"({half_up('(factor13 * volume15)', 10 ** 14)} * 10)", "CASE solar_zr WHEN 'Y' THEN 0 ELSE {c} END")} AS measure
FROM (SELECT *, CASE WHEN month5 IS NULL THEN 10000000000000 WHEN billed10 = 0 THEN NULL
                     ELSE sign(billed10) * {half_up('(month5 * 1000000000000000000)', 'abs(billed10)')} END AS factor13,
             {_VOLUME} AS volume15
      FROM (SELECT d.*, s.avg_daily_unit_quantity AS month5
            FROM (SELECT b.*, h.mth_no, h.mth_sdt, h.mth_edt,
                         datediff('day', greatest(h.mth_sdt, bill_edt + 1), least(h.mth_edt, service_edt)) + 1 AS total_days
                  FROM (SELECT d.*, CASE WHEN s.avg_daily_unit_quantity IS NULL THEN {half_up('d.daily_unit_quantity', 100000)}
                                         ELSE s.avg_daily_unit_quantity * 100000 END AS billed10
                        FROM latest d LEFT JOIN profile s ON s.record_hash = d.record_hash AND {_CHARGE_MATCH}) b
                  JOIN horizon h ON service_sdt <= h.mth_edt AND service_edt >= h.mth_sdt AND bill_edt <= h.mth_edt) d
            LEFT JOIN profile s ON s.mth_no = d.mth_no AND {_SEGMENT_MATCH} AND {_CHARGE_MATCH}
            WHERE total_days > 0))"""


def _imputed(column: str) -> str:
    weighted = half_up(half_up(f"(share15 * avg_{column})", 1000), 100)
    return f"CASE WHEN record_count = 0 THEN 0 ELSE {weighted} END"


CTES["imputed"] = f"""
SELECT DISTINCT 'Core' AS data_source, 'Accrual (Never Billed)' AS record_type, {_LEAD},
       {', '.join(f'avg_{c} * 10000000000 AS {c}' for c in _RAW.split(', '))},
       {measure20("CASE solar_zr WHEN 'Y' THEN avg_daily_unit_quantity_zr * 10000000000 ELSE imp_daily_unit_quantity END",
                  "CASE solar_zr WHEN 'Y' THEN 0 ELSE imp_{c} END")} AS measure
FROM (SELECT *, {', '.join(f'{_imputed(c)} AS imp_{c}' for c in _RAW.split(', ') if c != 'daily_unit_quantity_zr')}
      FROM (SELECT s.*, 'NULL' AS bill_sdt, 'NULL' AS bill_edt, m.seq_product_item_id, m.mth_sdt, m.mth_edt, m.service_sdt, m.service_edt,
                   {half_up(half_up('(account_number_count * CAST(10000000000000000000 AS HUGEINT))', 'record_count'), 10000)} AS share15,
                   {month_overlap('m', 'm.service_sdt', 'm.service_edt')} AS total_days
            FROM unbilled_month m JOIN profile s ON s.record_hash = m.record_hash
            WHERE NOT contains(s.trans_description, 'Import'))
      WHERE total_days > 0)"""

_DETAIL = """data_source, record_type, market_region, market_sub_region, market_segment, customer_segment, mth_sdt, measure_name,
       measure_code, measure_unit, seq_product_item_id, fuel_type, measure"""
CTES["detail"] = f"""
SELECT '{TEST_RUN.run_id}' AS run_id, {TEST_RUN.request_id} AS unbilled_accrual_run_audit_id,
       '{TEST_RUN.period_end_text}' AS unbilled_accrual_period_end_date, data_source,
       CASE fuel_type WHEN 'GAS' THEN 'Gas' WHEN 'ELECTRICITY' THEN 'Elec' END AS fuel_type, record_type, market_region,
       market_sub_region, market_segment, customer_segment, mth_sdt AS month_start_date, measure_name, measure_code,
       CASE WHEN measure_code LIKE 'VOL_DEMAND%' THEN 'MVA' ELSE measure_unit END AS measure_unit,
       sum(coalesce(measure, 0)) AS measure_value, seq_product_item_id AS service_id,
       CAST(NULL AS VARCHAR) AS meter_id, CAST(NULL AS VARCHAR) AS postal_code
FROM (SELECT {_DETAIL} FROM actual UNION ALL SELECT {_DETAIL} FROM existing UNION ALL SELECT {_DETAIL} FROM imputed)
GROUP BY ALL"""

CTES["totals"] = """
SELECT * EXCLUDE (run_id, service_id, meter_id, postal_code, measure_value), sum(measure_value) AS measure_value,
       count(service_id) AS service_count
FROM detail WHERE data_source = 'Core' GROUP BY ALL"""

CTES["summary"] = f"""
SELECT '{TEST_RUN.run_id}' AS run_id, * FROM (
  SELECT * FROM totals
  UNION ALL BY NAME
  SELECT * REPLACE ('Service Count' AS measure_name, 'SERVICES' AS measure_code, 'Meters' AS measure_unit,
                    CAST(service_count AS HUGEINT) * 100000000000000000000 AS measure_value)
  FROM totals WHERE starts_with(measure_code, 'DAY'))"""


def with_ctes(final: str, extra: dict[str, str] | None = None) -> str:
    """``final`` preceded by the common tables it uses, directly or not."""
    tables = {**CTES, **(extra or {})}
    words = {name: set(re.findall(r"[a-z_]+", text.lower())) for name, text in tables.items()}
    needed: set[str] = set()
    todo = [name for name in tables if name in set(re.findall(r"[a-z_]+", final.lower()))]
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo += [other for other in tables if other != name and other in words[name]]
    parts = [f"{name} AS MATERIALIZED ({tables[name]})" for name in tables if name in needed]
    return f"WITH {', '.join(parts)} {final}" if parts else final
