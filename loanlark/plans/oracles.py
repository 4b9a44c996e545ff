"""SQL that the queries must agree with, over the same tables, for DuckDB.

Each statement is written from the definition of the operator on plain rows (one window
over all rows, one group per column, every pair), not from the distributed form.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# --- stand-ins ---------------------------------------------------------------------------

APP = """
per_customer AS (
  SELECT o_custkey, count(*) AS cnt, sum(round(o_totalprice * 100)) AS total,
    max(round(o_totalprice * 100)) AS top,
    date_diff('day', min(o_orderdate), max(o_orderdate)) AS span
  FROM orders GROUP BY o_custkey),
app AS (
  SELECT c_custkey AS SK_ID_CURR, CAST(c_acctbal < 0 AS BIGINT) AS TARGET,
    total AS AMT_INCOME_TOTAL, top AS AMT_CREDIT, floor(total / (cnt * 12)) AS AMT_ANNUITY,
    CASE WHEN c_mktsegment <> 'BUILDING' THEN floor(top * CAST(0.9 AS DOUBLE)) END AS AMT_GOODS_PRICE,
    CAST(c_custkey % 4 AS BIGINT) AS CNT_CHILDREN,
    CAST(nullif(c_custkey % 7, 0) AS DOUBLE) AS CNT_FAM_MEMBERS,
    CAST(-(7300 + (c_custkey * 37) % 18250) AS BIGINT) AS DAYS_BIRTH,
    CAST(CASE WHEN c_custkey % 11 = 0 THEN 365243 ELSE 100 - (c_custkey * 13) % 9000 END AS BIGINT) AS DAYS_EMPLOYED,
    CAST(-span AS DOUBLE) AS DAYS_REGISTRATION,
    CAST(-((c_custkey * 17) % 6000) AS DOUBLE) AS DAYS_ID_PUBLISH,
    CAST(nullif(-((c_custkey * 29) % 4000), 0) AS DOUBLE) AS DAYS_LAST_PHONE_CHANGE,
    CASE WHEN c_custkey % 3 <> 0 THEN ((c_custkey * 7919) % 1000) / CAST(1000 AS DOUBLE) END AS EXT_SOURCE_1,
    CASE WHEN c_custkey % 10 <> 0 THEN ((c_custkey * 104729) % 997) / CAST(997 AS DOUBLE) END AS EXT_SOURCE_2,
    CASE WHEN c_custkey % 4 <> 0 THEN ((n_nationkey * 41 + cnt * 13) % 100) / CAST(100 AS DOUBLE) END AS EXT_SOURCE_3,
    CAST(c_custkey % 2 AS BIGINT) AS FLAG_DOCUMENT_2,
    CAST(nullif(c_custkey % 5, 3) AS BIGINT) AS FLAG_DOCUMENT_3,
    CAST(1 AS BIGINT) AS FLAG_MOBIL,
    CAST(c_custkey % 3 = 0 AS BIGINT) AS FLAG_EMP_PHONE,
    CAST(c_custkey % 9 = 0 AS BIGINT) AS FLAG_EMAIL,
    CAST(nullif(c_custkey % 6, 0) AS DOUBLE) AS AMT_REQ_CREDIT_BUREAU_DAY,
    CAST(c_custkey % 8 AS DOUBLE) AS AMT_REQ_CREDIT_BUREAU_YEAR,
    CAST(n_regionkey + 1 AS BIGINT) AS REGION_RATING_CLIENT,
    CAST(nullif(n_nationkey % 3, 0) AS BIGINT) AS REGION_RATING_CLIENT_W_CITY,
    c_mktsegment AS NAME_CONTRACT_TYPE,
    CASE WHEN c_custkey % 13 <> 0 THEN n_name END AS NAME_NATION
  FROM customer LEFT JOIN per_customer ON c_custkey = o_custkey
  JOIN nation ON c_nationkey = n_nationkey)"""

APP_INTS = [
    "CNT_CHILDREN", "DAYS_BIRTH", "DAYS_EMPLOYED", "FLAG_DOCUMENT_2", "FLAG_DOCUMENT_3",
    "FLAG_MOBIL", "FLAG_EMP_PHONE", "FLAG_EMAIL", "REGION_RATING_CLIENT",
    "REGION_RATING_CLIENT_W_CITY",
]
APP_DOUBLES = [
    "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "CNT_FAM_MEMBERS",
    "DAYS_REGISTRATION", "DAYS_ID_PUBLISH", "DAYS_LAST_PHONE_CHANGE", "EXT_SOURCE_1",
    "EXT_SOURCE_2", "EXT_SOURCE_3", "AMT_REQ_CREDIT_BUREAU_DAY", "AMT_REQ_CREDIT_BUREAU_YEAR",
]
APP_TEXT = ["NAME_CONTRACT_TYPE", "NAME_NATION"]
APP_NUMBERS = APP_INTS + APP_DOUBLES

BUREAU = """
bureau AS (
  SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_BUREAU,
    CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Active' ELSE 'Bad debt' END AS CREDIT_ACTIVE,
    date_diff('day', DATE '2001-08-02', CAST(o_orderdate AS DATE)) AS DAYS_CREDIT,
    o_orderkey % 30 AS CREDIT_DAY_OVERDUE, round(o_totalprice * 100) AS AMT_CREDIT_SUM,
    CASE WHEN o_orderstatus <> 'F' THEN floor(round(o_totalprice * 100) / 2) END AS AMT_CREDIT_SUM_DEBT,
    CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 1000 AS DOUBLE) END AS AMT_CREDIT_SUM_OVERDUE
  FROM orders)"""

BALANCE = """
balance AS (
  SELECT l_orderkey AS SK_ID_BUREAU, -l_linenumber AS MONTHS_BALANCE,
    CASE WHEN l_tax = 0 THEN NULL ELSE CASE l_returnflag || l_linestatus WHEN 'AF' THEN '0'
      WHEN 'AO' THEN '1' WHEN 'NF' THEN '3' WHEN 'NO' THEN 'C' WHEN 'RF' THEN 'X'
      WHEN 'RO' THEN '5' END END AS STATUS
  FROM lineitem)"""

PREV = """
prev AS (
  SELECT o_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR,
    CASE WHEN o_orderkey % 17 <> 0 THEN CASE o_orderstatus WHEN 'F' THEN 'Approved'
      WHEN 'O' THEN 'Refused' ELSE 'Canceled' END END AS NAME_CONTRACT_STATUS,
    round(o_totalprice * 100) AS AMT_APPLICATION,
    CASE WHEN o_orderkey % 9 = 0 THEN CAST(0 AS DOUBLE)
      WHEN o_orderkey % 7 <> 0 THEN floor(round(o_totalprice * 100) * 9 / 10) END AS AMT_CREDIT,
    floor(round(o_totalprice * 100) / 12) AS AMT_ANNUITY,
    CASE WHEN o_orderstatus <> 'O' THEN floor(round(o_totalprice * 100) / 10) END AS AMT_DOWN_PAYMENT,
    CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderkey % 20 AS DOUBLE) END AS RATE_INTEREST_PRIMARY,
    CAST(nullif(o_orderkey % 365, 0) AS DOUBLE) AS DAYS_FIRST_DRAWING,
    date_diff('day', DATE '2001-08-02', CAST(o_orderdate AS DATE)) AS DAYS_DECISION
  FROM orders)"""

POS = """
pos AS (
  SELECT event_id AS SK_ID_PREV, user_id AS SK_ID_CURR, -(event_id % 24) AS MONTHS_BALANCE,
    floor(value) AS CNT_INSTALMENT,
    CASE WHEN event_type <> 'error' THEN floor(value / 2) END AS CNT_INSTALMENT_FUTURE,
    CASE event_type WHEN 'view' THEN 'Active' WHEN 'purchase' THEN 'Completed' END AS NAME_CONTRACT_STATUS,
    event_id % 15 - 5 AS SK_DPD, event_id % 7 - 3 AS SK_DPD_DEF
  FROM events)"""

CARDS = """
cards AS (
  SELECT event_id AS SK_ID_PREV, user_id AS SK_ID_CURR, round(value * 100) AS AMT_BALANCE,
    CAST((event_id % 1000) * 100 AS DOUBLE) AS AMT_CREDIT_LIMIT_ACTUAL,
    floor(value * 10) AS AMT_DRAWINGS_CURRENT,
    CAST(nullif(event_id % 50, 0) AS DOUBLE) AS AMT_INST_MIN_REGULARITY,
    floor(value * 7) AS AMT_PAYMENT_CURRENT,
    event_id % 9 - 4 AS SK_DPD, event_id % 5 AS SK_DPD_DEF
  FROM events)"""

INST = """
inst AS (
  SELECT l_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR,
    CAST(date_diff('day', DATE '2001-08-02', CAST(o_orderdate AS DATE)) AS DOUBLE) AS due,
    CASE WHEN l_discount <> 0 THEN CAST(date_diff('day', DATE '2001-08-02', CAST(l_shipdate AS DATE)) AS DOUBLE) END AS paid_on,
    round(l_extendedprice * 100) AS AMT_INSTALMENT,
    CASE WHEN l_discount <> 0 THEN floor(round(l_extendedprice * 100) * (1 - l_discount)) END AS AMT_PAYMENT
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

OUTCOME = "CAST((l_partkey * 31 + l_linenumber * 17) % 100 < l_quantity AS BIGINT)"
COARSE = f"s AS (SELECT l_quantity / 50 AS p, {OUTCOME} AS y FROM lineitem)"
FINE = f"""s AS (SELECT (l_quantity + ((l_partkey * 7919 + l_linenumber * 104729 + l_orderkey * 31)
  % 10007) / CAST(10007 AS DOUBLE)) / 51 AS p, {OUTCOME} AS y FROM lineitem)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(p.strip() for p in parts) + "\n"


def n(expr: str, name: str, digits: int = 6) -> str:
    """A rounded double."""
    return f"round(CAST({expr} AS DOUBLE), {digits}) + 0 AS {name}"


def i(expr: str, name: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {name}"


SPARSE_INTEGERS = ["DAYS_EMPLOYED", "FLAG_DOCUMENT_3", "REGION_RATING_CLIENT_W_CITY"]


def ints(names: list[str]) -> list[str]:
    """Integer columns; those with nulls as doubles."""
    return [n(c, c) if c in SPARSE_INTEGERS else c for c in names]


def cols(exprs: list[str]) -> str:
    return ",\n  ".join(exprs)


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# --- sources -----------------------------------------------------------------------------

PREV_DOUBLES = ["AMT_APPLICATION", "AMT_CREDIT", "AMT_ANNUITY", "AMT_DOWN_PAYMENT",
                "RATE_INTEREST_PRIMARY", "DAYS_FIRST_DRAWING"]
ORACLES["scan_csv_roundtrip"] = with_(PREV) + f"""SELECT SK_ID_PREV, SK_ID_CURR, NAME_CONTRACT_STATUS,
  {cols([n(c, c) for c in PREV_DOUBLES])}, {i("DAYS_DECISION", "DAYS_DECISION")} FROM prev"""

WIDTHS = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6,
          "lineitem": 11, "events": 6, "documents": 5, "embeddings": 3, "pages": 3,
          "benchmark": 2, "labels": 3, "conversations": 4}
ORACLES["table_inventory"] = union(
    [f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST({w} AS BIGINT) AS n_columns FROM {t}"
     for t, w in WIDTHS.items()]
)

FALLBACK = """round(greatest(0.01, least(0.99, CAST(1 AS DOUBLE)
  - coalesce(nullif(EXT_SOURCE_2, 0), CAST(0.5 AS DOUBLE)) + CAST(0.05 AS DOUBLE))), 4)"""
ORACLES["submission"] = with_(APP) + f"SELECT SK_ID_CURR, {n(FALLBACK, 'TARGET')} FROM app"
ORACLES["fallback_score"] = with_(APP) + f"SELECT SK_ID_CURR, {n(FALLBACK, 'probability')} FROM app"

# --- projections -------------------------------------------------------------------------

RATIOS = {
    "CREDIT_INCOME_RATIO": "AMT_CREDIT / nullif(AMT_INCOME_TOTAL + 1, 0)",
    "ANNUITY_INCOME_RATIO": "AMT_ANNUITY / nullif(AMT_INCOME_TOTAL + 1, 0)",
    "CREDIT_TERM": "AMT_CREDIT / nullif(AMT_ANNUITY + 1, 0)",
    "GOODS_CREDIT_RATIO": "AMT_GOODS_PRICE / nullif(AMT_CREDIT + 1, 0)",
    "ANNUITY_CREDIT_RATIO": "AMT_ANNUITY / nullif(AMT_CREDIT + 1, 0)",
    "INCOME_PER_PERSON": "AMT_INCOME_TOTAL / nullif(CNT_FAM_MEMBERS + 1, 0)",
    "CHILDREN_RATIO": "CNT_CHILDREN / nullif(CNT_FAM_MEMBERS + 1, 0)",
}
EXT = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
EXT_LIST = f"list_filter([{', '.join(EXT)}], lambda x: x IS NOT NULL)"
EXT_STATS = {
    "EXT_SOURCE_MEAN": f"list_avg({EXT_LIST})",
    "EXT_SOURCE_STD": f"CASE WHEN len({EXT_LIST}) > 1 THEN list_stddev_samp({EXT_LIST}) END",
    "EXT_SOURCE_MIN": f"list_min({EXT_LIST})",
    "EXT_SOURCE_MAX": f"list_max({EXT_LIST})",
}
WEIGHTED = """(coalesce(EXT_SOURCE_1, 0) * 2 + coalesce(EXT_SOURCE_2, 0) * 3
  + coalesce(EXT_SOURCE_3, 0)) / CAST(6 AS DOUBLE)"""
PRODUCTS = {"EXT_SRC_1x2": "EXT_SOURCE_1 * EXT_SOURCE_2", "EXT_SRC_2x3": "EXT_SOURCE_2 * EXT_SOURCE_3",
            "EXT_SRC_1x3": "EXT_SOURCE_1 * EXT_SOURCE_3"}
FLAG_SUMS = {
    "DOCUMENT_COUNT": "coalesce(FLAG_DOCUMENT_2, 0) + coalesce(FLAG_DOCUMENT_3, 0)",
    "CONTACT_COUNT": "FLAG_MOBIL + FLAG_EMP_PHONE + FLAG_EMAIL",
    "REGION_RATING_SUM": "coalesce(REGION_RATING_CLIENT, 0) + coalesce(REGION_RATING_CLIENT_W_CITY, 0)",
}
REQ_SUM = "coalesce(AMT_REQ_CREDIT_BUREAU_DAY, 0) + coalesce(AMT_REQ_CREDIT_BUREAU_YEAR, 0)"
AGE, SEEN = "-DAYS_BIRTH / CAST(365 AS DOUBLE)", "nullif(DAYS_EMPLOYED, 365243)"
WORKED = f"CASE WHEN -{SEEN} < 0 THEN 0 ELSE -{SEEN} END / CAST(365 AS DOUBLE)"
PHONE = "-DAYS_LAST_PHONE_CHANGE / CAST(365 AS DOUBLE)"

ORACLES["ratio_features"] = with_(APP) + f"""SELECT SK_ID_CURR,
  {cols([n(e, k) for k, e in RATIOS.items()])} FROM app"""
ORACLES["age_years"] = with_(APP) + f"""SELECT SK_ID_CURR, {n(AGE, 'AGE_YEARS')},
  {n(PHONE, 'PHONE_CHANGE_YEARS')} FROM app"""
ORACLES["sentinel_null"] = with_(APP) + f"""SELECT SK_ID_CURR,
  {i('DAYS_EMPLOYED = 365243', 'IS_UNEMPLOYED')}, {n(SEEN, 'DAYS_EMPLOYED')} FROM app"""
ORACLES["rowwise_stats"] = with_(APP) + f"""SELECT SK_ID_CURR,
  {cols([n(e, k) for k, e in zip(['row_mean', 'row_std', 'row_min', 'row_max'], EXT_STATS.values())])}
  FROM app"""
ORACLES["weighted_score"] = with_(APP) + f"SELECT SK_ID_CURR, {n(WEIGHTED, 'weighted')} FROM app"
ORACLES["pair_products"] = with_(APP) + f"""SELECT SK_ID_CURR,
  {cols([n(e, k) for k, e in zip(['p12', 'p23', 'p13'], PRODUCTS.values())])} FROM app"""
ORACLES["rowwise_flag_sum"] = with_(APP) + f"""SELECT SK_ID_CURR,
  {cols([i(e, k) for k, e in FLAG_SUMS.items()])}, {n(REQ_SUM, 'AMT_REQ_BUREAU_TOTAL')} FROM app"""
ORACLES["clip_lower"] = with_(POS) + f"""SELECT SK_ID_PREV,
  {i('CASE WHEN SK_DPD < 0 THEN 0 ELSE SK_DPD END', 'dpd')},
  {n('CASE WHEN SK_DPD_DEF < 0 THEN 0 WHEN SK_DPD_DEF = 2 THEN NULL ELSE SK_DPD_DEF END', 'dpd_def')}
  FROM pos"""
ORACLES["indicator_flags"] = with_(PREV) + f"""SELECT SK_ID_PREV,
  {i("coalesce(NAME_CONTRACT_STATUS = 'Approved', false)", 'approved')},
  {i("coalesce(NAME_CONTRACT_STATUS IN ('Refused', 'Canceled'), false)", 'declined')},
  {i("coalesce(AMT_DOWN_PAYMENT > 0, false)", 'has_down_payment')} FROM prev"""
LEVEL = "CASE WHEN STATUS IN ('1', '2', '3', '4', '5') THEN CAST(STATUS AS INT) ELSE 0 END"
ORACLES["value_map"] = with_(BALANCE) + f"""SELECT STATUS, {i(LEVEL, 'level')}, count(*) AS n
  FROM balance GROUP BY ALL"""

SCORED = f"""scored AS (SELECT *, {FALLBACK} AS probability FROM app)"""
BAND = "CASE WHEN probability < 0.25 THEN 'Low' WHEN probability < 0.55 THEN 'Medium' ELSE 'High' END"
ORACLES["score_bands"] = with_(APP, SCORED) + f"""SELECT SK_ID_CURR,
  {n('round(probability * 100, 2)', 'risk_score')}, {BAND} AS risk_label,
  {n('probability', 'default_probability', 4)}, {n('0.35', 'threshold')},
  {i('probability >= 0.35', 'predicted_default')} FROM scored"""

ORACLES["validate_applications"] = with_(APP) + f"""SELECT SK_ID_CURR AS id,
  coalesce(nullif(NAME_CONTRACT_TYPE, 'FURNITURE'), 'Cash loans') AS NAME_CONTRACT_TYPE,
  'M' AS CODE_GENDER, {n('coalesce(CNT_FAM_MEMBERS, 2)', 'CNT_FAM_MEMBERS')},
  CASE WHEN DAYS_BIRTH + 8000 < 0 THEN '' ELSE 'DAYS_BIRTH < 0' END AS broken_rules FROM app"""

LISTED = f"""listed AS (SELECT 'APP-' || SK_ID_CURR AS id, AMT_INCOME_TOTAL AS income,
  AMT_CREDIT AS credit, round(probability * 100, 2) AS risk_score, {BAND} AS risk_label,
  CAST(probability >= 0.35 AS BIGINT) AS predicted_default, NAME_CONTRACT_TYPE AS contract_type,
  strftime(DATE '2001-08-02' + CAST(DAYS_REGISTRATION AS INT), '%Y-%m-%d') AS submitted_at
  FROM scored)"""
ORACLES["search_applications"] = with_(APP, SCORED, LISTED) + """SELECT * FROM listed
  WHERE contains(lower(id), 'ma') OR contains(lower(contract_type), 'ma')
    OR contains(lower(risk_label), 'ma') ORDER BY income DESC, id"""
ORACLES["page_applications"] = with_(APP, SCORED, LISTED) + f"""SELECT id, risk_score,
  (SELECT CAST(ceil(count(*) / 7) AS BIGINT) FROM listed WHERE risk_label = 'Medium') AS n_pages
  FROM listed WHERE risk_label = 'Medium' ORDER BY risk_score DESC, id LIMIT 7 OFFSET 14"""
ORACLES["applicant_profile"] = with_(APP) + f"""SELECT SK_ID_CURR,
  {n('AMT_CREDIT / AMT_INCOME_TOTAL', 'credit_income', 2)},
  {i('floor(AMT_CREDIT / CASE WHEN AMT_ANNUITY = 0 OR AMT_ANNUITY IS NULL THEN 1 ELSE AMT_ANNUITY END + 0.5)', 'credit_term')},
  {i('abs(floor(DAYS_BIRTH / 365 + 0.5))', 'age_years')},
  {n('CASE WHEN DAYS_EMPLOYED < 0 THEN abs(floor(DAYS_EMPLOYED / 365 + 0.5)) END', 'employed_years')}
  FROM app"""

# --- features ----------------------------------------------------------------------------

AGGS = {"mean": "avg({c})", "max": "max({c})", "min": "min({c})", "sum": "coalesce(sum({c}), 0)",
        "std": "stddev_samp({c})"}


def matrix(c: str, integer: bool) -> list[str]:
    out = []
    for a, e in AGGS.items():
        name, expr = f"PREV_{c}_{a.upper()}", e.format(c=c)
        whole = integer and a in ("max", "min", "sum")
        out.append(i(expr, name) if whole else n(expr, name, 4))
    return out


ORACLES["agg_matrix"] = with_(PREV) + f"""SELECT SK_ID_CURR,
  {cols(matrix('AMT_CREDIT', False) + matrix('DAYS_DECISION', True))} FROM prev GROUP BY 1"""

APP_FEATURES_N = {
    **RATIOS,
    "AGE_YEARS": AGE,
    "REGISTRATION_YEARS": "-DAYS_REGISTRATION / CAST(365 AS DOUBLE)",
    "ID_PUBLISH_YEARS": "-DAYS_ID_PUBLISH / CAST(365 AS DOUBLE)",
    "PHONE_CHANGE_YEARS": PHONE,
    "EMPLOYED_YEARS": WORKED,
    "EMPLOYED_TO_AGE_RATIO": f"({WORKED}) / nullif({AGE} + 1, 0)",
    "CREDIT_TO_AGE_RATIO": f"AMT_CREDIT / nullif({AGE} + 1, 0)",
    **EXT_STATS,
    "EXT_SOURCE_WEIGHTED": WEIGHTED,
    **PRODUCTS,
    "AMT_REQ_BUREAU_TOTAL": REQ_SUM,
    "NON_CHILDREN": "CNT_FAM_MEMBERS - CNT_CHILDREN",
}
APP_FEATURES_I = {"IS_UNEMPLOYED": "DAYS_EMPLOYED = 365243", **FLAG_SUMS}
BASE = ["SK_ID_CURR", "TARGET", *APP_TEXT] + [
    i(SEEN if c == "DAYS_EMPLOYED" else c, c) for c in APP_INTS
] + [f"{c} AS {c}" for c in APP_DOUBLES]
FEATURED = f"""featured AS (SELECT {cols(BASE)},
  {cols([f'CAST({e} AS DOUBLE) AS {k}' for k, e in APP_FEATURES_N.items()])},
  {cols([i(e, k) for k, e in APP_FEATURES_I.items()])} FROM app)"""
FEATURE_DOUBLES = APP_DOUBLES + list(APP_FEATURES_N)
FEATURE_INTS = APP_INTS + list(APP_FEATURES_I)
ORACLES["feat_application"] = with_(APP, FEATURED) + f"""SELECT SK_ID_CURR, TARGET,
  {cols(APP_TEXT + ints(FEATURE_INTS) + [n(c, c) for c in FEATURE_DOUBLES])} FROM featured"""


def flagged(condition: str) -> str:
    return f"CAST(coalesce({condition}, false) AS INT)"


BB = {
    "BB_MONTHS_COUNT": (i, "count(MONTHS_BALANCE)"),
    "BB_STATUS_MEAN": (n, f"avg({LEVEL})"),
    "BB_OVERDUE_RATIO": (n, f"avg({flagged(chr(83) + 'TATUS IN (' + ', '.join(repr(str(d)) for d in range(1, 6)) + ')')})"),
    "BB_CLOSED_RATIO": (n, f"avg({flagged(chr(83) + 'TATUS = ' + repr('C'))})"),
}
ORACLES["feat_bureau_balance"] = with_(BALANCE) + f"""SELECT SK_ID_BUREAU,
  {cols([f(e, k) for k, (f, e) in BB.items()])} FROM balance GROUP BY 1"""
BB_CTE = f"""bb AS (SELECT SK_ID_BUREAU, {cols([f'{e} AS {k}' for k, (f, e) in BB.items()])}
  FROM balance GROUP BY 1),
bureau_bb AS (SELECT * FROM bureau LEFT JOIN bb USING (SK_ID_BUREAU))"""


def is_(c: str, v: str) -> str:
    return flagged(f"{c} = '{v}'")


BAD = f"sum({is_('CREDIT_ACTIVE', 'Bad debt')})"
FAMILIES = {
    "bureau_bb": {
        "BUREAU_LOAN_COUNT": (i, "count(SK_ID_BUREAU)"),
        "BUREAU_ACTIVE_COUNT": (i, f"sum({is_('CREDIT_ACTIVE', 'Active')})"),
        "BUREAU_CLOSED_COUNT": (i, f"sum({is_('CREDIT_ACTIVE', 'Closed')})"),
        "BUREAU_BAD_COUNT": (i, BAD),
        "BUREAU_ACTIVE_RATIO": (n, f"avg({is_('CREDIT_ACTIVE', 'Active')})"),
        "BUREAU_DAYS_CREDIT_MEAN": (n, "avg(DAYS_CREDIT)"),
        "BUREAU_DAYS_CREDIT_MIN": (i, "min(DAYS_CREDIT)"),
        "BUREAU_OVERDUE_MEAN": (n, "avg(CREDIT_DAY_OVERDUE)"),
        "BUREAU_OVERDUE_MAX": (i, "max(CREDIT_DAY_OVERDUE)"),
        "BUREAU_AMT_SUM_MEAN": (n, "avg(AMT_CREDIT_SUM)"),
        "BUREAU_AMT_SUM_MAX": (n, "max(AMT_CREDIT_SUM)"),
        "BUREAU_AMT_DEBT_MEAN": (n, "avg(AMT_CREDIT_SUM_DEBT)"),
        "BUREAU_AMT_OVERDUE_MEAN": (n, "avg(AMT_CREDIT_SUM_OVERDUE)"),
        "BUREAU_BB_OVERDUE_RATIO": (n, "avg(BB_OVERDUE_RATIO)"),
        "BUREAU_BB_STATUS_MEAN": (n, "avg(BB_STATUS_MEAN)"),
        "BUREAU_BAD_RATIO": (n, f"{BAD} / (count(SK_ID_BUREAU) + 1)"),
    },
    "prev": {
        "PREV_COUNT": (i, "count(SK_ID_PREV)"),
        "PREV_APPROVED_COUNT": (i, f"sum({is_('NAME_CONTRACT_STATUS', 'Approved')})"),
        "PREV_REFUSED_COUNT": (i, f"sum({is_('NAME_CONTRACT_STATUS', 'Refused')})"),
        "PREV_CANCELLED_COUNT": (i, f"sum({is_('NAME_CONTRACT_STATUS', 'Canceled')})"),
        "PREV_APPROVED_RATIO": (n, f"avg({is_('NAME_CONTRACT_STATUS', 'Approved')})"),
        "PREV_REFUSED_RATIO": (n, f"avg({is_('NAME_CONTRACT_STATUS', 'Refused')})"),
        "PREV_AMT_APPLICATION_MEAN": (n, "avg(AMT_APPLICATION)"),
        "PREV_AMT_APPLICATION_MAX": (n, "max(AMT_APPLICATION)"),
        "PREV_AMT_CREDIT_MEAN": (n, "avg(nullif(AMT_CREDIT, 0))"),
        "PREV_AMT_CREDIT_MAX": (n, "max(nullif(AMT_CREDIT, 0))"),
        "PREV_AMT_ANNUITY_MEAN": (n, "avg(AMT_ANNUITY)"),
        "PREV_AMT_DOWN_MEAN": (n, "avg(AMT_DOWN_PAYMENT)"),
        "PREV_DAYS_DECISION_MEAN": (n, "avg(DAYS_DECISION)"),
        "PREV_DAYS_DECISION_MIN": (i, "min(DAYS_DECISION)"),
        "PREV_CREDIT_RATIO_MEAN": (n, "avg(AMT_APPLICATION / (nullif(AMT_CREDIT, 0) + 1))"),
        "PREV_DOWN_RATIO_MEAN": (n, "avg(AMT_DOWN_PAYMENT / (AMT_APPLICATION + 1))"),
        "PREV_RATE_INTEREST_MEAN": (n, "avg(RATE_INTEREST_PRIMARY)"),
        "PREV_DAYS_FIRST_DRAWING": (n, "avg(DAYS_FIRST_DRAWING)"),
        "PREV_RECENT_AMT_APPLICATION": (
            n, "arg_max(AMT_APPLICATION, {'a': DAYS_DECISION, 'b': SK_ID_PREV})"),
        "PREV_RECENT_AMT_CREDIT": (
            n, """arg_max(AMT_CREDIT, {'a': DAYS_DECISION, 'b': SK_ID_PREV})
               FILTER (WHERE AMT_CREDIT <> 0)"""),
        "PREV_RECENT_NAME_CONTRACT_STATUS": (
            i, """coalesce(arg_max(NAME_CONTRACT_STATUS, {'a': DAYS_DECISION, 'b': SK_ID_PREV})
               FILTER (WHERE NAME_CONTRACT_STATUS IS NOT NULL), '') = 'Approved'"""),
    },
    "pos": {
        "POS_COUNT": (i, "count(SK_ID_PREV)"),
        "POS_COMPLETED_RATIO": (n, f"avg({is_('NAME_CONTRACT_STATUS', 'Completed')})"),
        "POS_MONTHS_MEAN": (n, "avg(MONTHS_BALANCE)"),
        "POS_MONTHS_MIN": (i, "min(MONTHS_BALANCE)"),
        "POS_CNT_INSTALMENT_MEAN": (n, "avg(CNT_INSTALMENT)"),
        "POS_CNT_FUTURE_MEAN": (n, "avg(CNT_INSTALMENT_FUTURE)"),
        "POS_DPD_MEAN": (n, "avg(CASE WHEN SK_DPD < 0 THEN 0 ELSE SK_DPD END)"),
        "POS_DPD_MAX": (i, "max(CASE WHEN SK_DPD < 0 THEN 0 ELSE SK_DPD END)"),
        "POS_DPD_DEF_MEAN": (n, "avg(SK_DPD_DEF)"),
        "POS_DPD_DEF_MAX": (i, "max(SK_DPD_DEF)"),
    },
    "cards": {
        "CC_COUNT": (i, "count(SK_ID_PREV)"),
        "CC_AMT_BALANCE_MEAN": (n, "avg(AMT_BALANCE)"),
        "CC_AMT_BALANCE_MAX": (n, "max(AMT_BALANCE)"),
        "CC_LIMIT_MEAN": (n, "avg(AMT_CREDIT_LIMIT_ACTUAL)"),
        "CC_DRAWINGS_MEAN": (n, "avg(AMT_DRAWINGS_CURRENT)"),
        "CC_DRAWINGS_RATIO_MEAN": (n, "avg(AMT_DRAWINGS_CURRENT / (AMT_CREDIT_LIMIT_ACTUAL + 1))"),
        "CC_BALANCE_LIMIT_MEAN": (n, "avg(AMT_BALANCE / (AMT_CREDIT_LIMIT_ACTUAL + 1))"),
        "CC_PAYMENT_RATIO_MEAN": (n, "avg(AMT_PAYMENT_CURRENT / (AMT_INST_MIN_REGULARITY + 1))"),
        "CC_DPD_MEAN": (n, "avg(CASE WHEN SK_DPD < 0 THEN 0 ELSE SK_DPD END)"),
        "CC_DPD_MAX": (i, "max(CASE WHEN SK_DPD < 0 THEN 0 ELSE SK_DPD END)"),
        "CC_DPD_DEF_MEAN": (n, "avg(SK_DPD_DEF)"),
        "CC_DPD_DEF_MAX": (i, "max(SK_DPD_DEF)"),
    },
    "inst": {
        "INSTAL_COUNT": (i, "count(SK_ID_PREV)"),
        "INSTAL_DPD_MEAN": (n, "avg(CASE WHEN paid_on - due < 0 THEN 0 ELSE paid_on - due END)"),
        "INSTAL_DPD_MAX": (n, "max(CASE WHEN paid_on - due < 0 THEN 0 ELSE paid_on - due END)"),
        "INSTAL_DPD_STD": (
            n, "stddev_samp(CASE WHEN paid_on - due < 0 THEN 0 ELSE paid_on - due END)"),
        "INSTAL_DBD_MEAN": (n, "avg(CASE WHEN due - paid_on < 0 THEN 0 ELSE due - paid_on END)"),
        "INSTAL_DBD_MAX": (n, "max(CASE WHEN due - paid_on < 0 THEN 0 ELSE due - paid_on END)"),
        "INSTAL_PAYMENT_RATIO_MEAN": (n, "avg(AMT_PAYMENT / (AMT_INSTALMENT + 1))"),
        "INSTAL_PAYMENT_RATIO_MIN": (n, "min(AMT_PAYMENT / (AMT_INSTALMENT + 1))"),
        "INSTAL_PAYMENT_DIFF_MEAN": (n, "avg(AMT_INSTALMENT - AMT_PAYMENT)"),
        "INSTAL_PAYMENT_DIFF_MAX": (n, "max(AMT_INSTALMENT - AMT_PAYMENT)"),
        "INSTAL_LATE_RATIO": (n, f"avg({flagged('paid_on > due')})"),
        "INSTAL_AMT_PAYMENT_MEAN": (n, "avg(AMT_PAYMENT)"),
        "INSTAL_AMT_PAYMENT_SUM": (n, "coalesce(sum(AMT_PAYMENT), 0)"),
    },
}
SOURCES = {"bureau_bb": (BUREAU, BALANCE, BB_CTE), "prev": (PREV,), "pos": (POS,),
           "cards": (CARDS,), "inst": (INST,)}
NAMES = {"bureau_bb": "feat_bureau", "prev": "feat_previous", "pos": "feat_pos_cash",
         "cards": "feat_credit_card", "inst": "feat_installments"}


def family(table: str, digits: int = 6) -> str:
    shown = [f(e, k) for k, (f, e) in FAMILIES[table].items()]
    return f"SELECT SK_ID_CURR, {cols(shown)} FROM {table} GROUP BY SK_ID_CURR"


for _table, _name in NAMES.items():
    ORACLES[_name] = with_(*SOURCES[_table]) + family(_table)
ORACLES["sink_parquet_roundtrip"] = ORACLES["feat_previous"]

WIDE = [APP, FEATURED, *[p for t in SOURCES for p in SOURCES[t]]]
WIDE += [f"f_{t} AS ({family(t)})" for t in FAMILIES]
WIDE.append(
    "wide AS (SELECT * FROM featured "
    + " ".join(f"LEFT JOIN f_{t} USING (SK_ID_CURR)" for t in FAMILIES)
    + ")"
)
# events cover a tenth of the customers, so these two families are over the null limit
SPARSE = {*FAMILIES["pos"], *FAMILIES["cards"]}
ALL_FEATURES = [c for t in FAMILIES for c in FAMILIES[t]]
DENSE = [c for c in ALL_FEATURES if c not in SPARSE]
ORACLES["wide_features"] = with_(*WIDE) + f"""SELECT SK_ID_CURR, TARGET,
  {cols(APP_TEXT + ints(FEATURE_INTS) + DENSE + [n(c, c) for c in FEATURE_DOUBLES])} FROM wide"""

# --- shaping -----------------------------------------------------------------------------

WIDE_COLUMNS = ["SK_ID_CURR", "TARGET", *APP_TEXT, *FEATURE_INTS, *FEATURE_DOUBLES, *ALL_FEATURES]
ORACLES["null_fraction"] = with_(*WIDE) + union(
    [f"SELECT '{c}' AS column_name, {n(f'avg(CAST({c} IS NULL AS INT))', 'null_fraction')} FROM wide"
     for c in WIDE_COLUMNS]
)
ORACLES["drop_sparse_columns"] = with_(APP) + f"SELECT SK_ID_CURR, {n('EXT_SOURCE_1', 'EXT_SOURCE_1')} FROM app"
ORACLES["align_columns"] = with_(APP) + f"""SELECT SK_ID_CURR, {cols(APP_TEXT + ints(APP_INTS))},
  {cols([n('NULL' if c == 'EXT_SOURCE_1' else c, c) for c in APP_DOUBLES])} FROM app"""
ORACLES["target_distribution"] = with_(APP) + f"""SELECT k AS target,
  (SELECT count(*) FROM app WHERE TARGET = k) AS n,
  {n('(SELECT avg(CAST(TARGET = k AS INT)) FROM app)', 'share', 4)}
  FROM (SELECT CAST(unnest([0, 1]) AS BIGINT) AS k)"""
ORACLES["dataset_summary"] = with_(APP) + f"""SELECT count(*) AS n_rows,
  {i(str(len(APP_NUMBERS) + len(APP_TEXT)), 'n_features')}, {n('avg(TARGET)', 'default_rate', 4)},
  {i('sum(TARGET)', 'default_count')}, {i('count_if(TARGET = 0)', 'non_default_count')} FROM app"""
ORACLES["category_counts"] = with_(APP) + union(
    [f"""SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS n,
      {n('count(*) * 100.0 / (SELECT count(*) FROM app)', 'pct', 1)} FROM app GROUP BY {c}"""
     for c in ("NAME_CONTRACT_TYPE", "NAME_NATION", "TARGET")]
)
ORACLES["distinct_counts"] = with_(APP) + union(
    [f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM app"
     for c in ["SK_ID_CURR", "TARGET", *APP_NUMBERS, *APP_TEXT]]
)


def cross(c: str, table: str, label: str) -> str:
    return f"""SELECT '{c}' AS feature, coalesce(CAST({c} AS VARCHAR), 'MISSING') AS value,
      {i(f'count_if({label} = 0)', 'n0')}, {i(f'count_if({label} = 1)', 'n1')}
      FROM {table} GROUP BY {c}"""


ORACLES["crosstab"] = with_(APP) + union([cross(c, "app", "TARGET") for c in APP_TEXT])

# --- encoding ----------------------------------------------------------------------------


def codes(c: str, table: str) -> str:
    return f"""SELECT '{c}' AS feature, v AS value, dense_rank() OVER (ORDER BY v) - 1 AS code
      FROM (SELECT DISTINCT coalesce({c}, 'nan') AS v FROM {table})"""


ORACLES["label_encode"] = with_(APP) + union([codes(c, "app") for c in APP_TEXT])
ORACLES["label_encode_apply"] = with_(
    f"""t AS (SELECT c_custkey, n_name, nullif(n_name, 'NATION_7') AS fitted
      FROM customer JOIN nation ON c_nationkey = n_nationkey),
    d AS ({codes('fitted', 't')})"""
) + f"""SELECT c_custkey, {n('coalesce(code, 0)', 'n_name')}, {n('0', 'never_fitted')}
  FROM t LEFT JOIN d ON coalesce(n_name, 'nan') = value"""
ENCODED = f"""d AS ({union([codes(c, 'app') for c in APP_TEXT])}),
  encoded AS (SELECT app.* EXCLUDE ({', '.join(APP_TEXT)}),
    {cols([f'CAST(d{k}.code AS DOUBLE) AS {c}' for k, c in enumerate(APP_TEXT)])} FROM app
    {' '.join(f"LEFT JOIN d d{k} ON d{k}.feature = '{c}' AND d{k}.value = coalesce(app.{c}, 'nan')"
              for k, c in enumerate(APP_TEXT))})"""
ORACLES["median_fit"] = with_(APP, ENCODED) + union(
    [f"SELECT '{c}' AS feature, {n(f'median({c})', 'value')} FROM encoded"
     for c in APP_NUMBERS + APP_TEXT]
)
ORACLES["encode_impute"] = with_(APP, ENCODED) + f"""SELECT SK_ID_CURR, TARGET,
  {cols([n(f'coalesce({c}, (SELECT median({c}) FROM encoded))', c) for c in APP_NUMBERS + APP_TEXT])}
  FROM encoded"""
ORACLES["state_roundtrip"] = ORACLES["encode_impute"]

# --- statistics --------------------------------------------------------------------------

KS_TAIL = """CASE WHEN lam < 0.2 THEN CAST(1 AS DOUBLE) ELSE greatest(0, least(1,
  list_sum(list_transform(range(1, 101), lambda k: CASE WHEN k % 2 = 1 THEN CAST(2 AS DOUBLE) ELSE CAST(-2 AS DOUBLE) END
    * exp(CAST(-2 AS DOUBLE) * k * k * lam * lam))))) END"""


def ks(values: str) -> str:
    """KS of every feature in ``values`` (feature, v, y): running shares over plain rows."""
    return f"""vals AS ({values}),
  usable AS (SELECT * FROM vals WHERE v IS NOT NULL),
  sizes AS (SELECT feature, count(DISTINCT v) AS nd, count_if(y = 0) AS c0, count_if(y = 1) AS c1,
    avg(v) FILTER (WHERE y = 0) AS m0, avg(v) FILTER (WHERE y = 1) AS m1 FROM usable GROUP BY 1),
  steps AS (SELECT feature,
    sum(CAST(y = 0 AS INT)) OVER (PARTITION BY feature ORDER BY v RANGE UNBOUNDED PRECEDING) AS r0,
    sum(CAST(y = 1 AS INT)) OVER (PARTITION BY feature ORDER BY v RANGE UNBOUNDED PRECEDING) AS r1
    FROM usable),
  ds AS (SELECT feature, max(abs(r0 / c0 - r1 / c1)) AS d, any_value(c0) AS c0, any_value(c1) AS c1,
    any_value(m0) AS m0, any_value(m1) AS m1
    FROM steps JOIN sizes USING (feature) WHERE nd > 2 AND c0 >= 10 AND c1 >= 10 GROUP BY 1),
  lams AS (SELECT *, (sqrt(c0 * c1 / (c0 + c1)) + 0.12 + 0.11 / sqrt(c0 * c1 / (c0 + c1))) * d AS lam
    FROM ds),
  ks AS (SELECT feature, {n('d', 'ks_statistic', 4)}, {n(KS_TAIL, 'p_value')},
    CAST(({KS_TAIL}) < 0.05 AS BIGINT) AS significant,
    {n('m0', 'mean_target0', 4)}, {n('m1', 'mean_target1', 4)} FROM lams)"""


FEATURE_VALUES = union(
    [f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, TARGET AS y FROM featured"
     for c in ["SK_ID_CURR", *FEATURE_INTS, *FEATURE_DOUBLES]]
)
ORACLES["ks_test"] = with_(APP, FEATURED, ks(FEATURE_VALUES)) + "SELECT * FROM ks"
DOCS = "docs AS (SELECT * FROM labels JOIN documents USING (doc_id))"
ORACLES["ks_test_documents"] = with_(
    DOCS, ks("SELECT 'n_chars' AS feature, CAST(n_chars AS DOUBLE) AS v, quality AS y FROM docs")
) + "SELECT * FROM ks"

# upper tail of chi-square as one minus the series of the lower incomplete gamma function
CHI_TAIL = """greatest(0, 1 - list_sum(list_transform(range(0, 400),
  lambda j: exp((dof / 2 + j) * ln(x / 2) - x / 2 - lgamma(dof / 2 + j + 1)))))"""


def chi2(cells: str, gates: str = "SELECT NULL AS feature WHERE false") -> str:
    """Chi-square per feature over the value-by-class grid, Yates for one degree of freedom."""
    return f"""cells AS ({cells}),
  wide_cells AS ({gates}),
  grid AS (SELECT feature, value, k, CASE k WHEN 0 THEN n0 ELSE n1 END AS o,
      n0 + n1 AS r, sum(CASE k WHEN 0 THEN n0 ELSE n1 END) OVER (PARTITION BY feature, k) AS c,
      sum(CASE k WHEN 0 THEN n0 ELSE n1 END) OVER (PARTITION BY feature) AS t,
      count(*) OVER (PARTITION BY feature, k) AS levels
    FROM cells, (SELECT unnest([0, 1]) AS k)
    WHERE feature NOT IN (SELECT feature FROM wide_cells)),
  gaps AS (SELECT *, CAST(r AS DOUBLE) * c / t AS e, abs(o - CAST(r AS DOUBLE) * c / t) AS g FROM grid),
  chis AS (SELECT feature, any_value(levels) - 1 AS dof,
      sum(power(CASE WHEN levels = 2 THEN g - least(0.5, g) ELSE g END, 2) / e) AS x
    FROM gaps WHERE levels > 1 GROUP BY feature HAVING min(c) > 0),
  chi AS (SELECT feature, {n('x', 'chi2_statistic', 4)},
      {n(f'CASE WHEN x <= 0 THEN 1 ELSE {CHI_TAIL} END', 'p_value')},
      {i('dof', 'degrees_of_freedom')},
      CAST(CASE WHEN x <= 0 THEN false ELSE {CHI_TAIL} < 0.05 END AS BIGINT) AS significant FROM chis)"""


def chi2_of(numbers: list[str], text: list[str], table: str) -> str:
    gates = union(
        [f"SELECT '{c}' AS feature FROM {table} HAVING count(DISTINCT {c}) > 10" for c in numbers]
    )
    return chi2(union([cross(c, table, "TARGET") for c in numbers + text]), gates)


ORACLES["chi2_test"] = with_(APP, chi2_of(["SK_ID_CURR", *APP_NUMBERS], APP_TEXT, "app")) + "SELECT * FROM chi"
ORACLES["chi2_test_documents"] = with_(
    DOCS, chi2(union([cross(c, "docs", "quality") for c in ("lang", "source", "toxic")]))
) + "SELECT * FROM chi"
ORACLES["statistical_report"] = with_(
    APP, FEATURED, ks(FEATURE_VALUES),
    chi2_of(["SK_ID_CURR", *FEATURE_INTS, *FEATURE_DOUBLES], APP_TEXT, "featured"),
) + """SELECT * FROM (SELECT 'ks' AS test, feature, ks_statistic AS statistic FROM ks
  ORDER BY ks_statistic DESC, feature LIMIT 30)
UNION ALL SELECT * FROM (SELECT 'chi2', feature, chi2_statistic FROM chi
  ORDER BY chi2_statistic DESC, feature LIMIT 30)
UNION ALL SELECT 'count', 'ks_tests_significant_count', CAST(count_if(significant = 1) AS DOUBLE) FROM ks
UNION ALL SELECT 'count', 'chi2_tests_significant_count', CAST(count_if(significant = 1) AS DOUBLE) FROM chi
UNION ALL SELECT 'count', 'total_features_tested',
  CAST((SELECT count(*) FROM ks) + (SELECT count(*) FROM chi) AS DOUBLE)"""
ORACLES["importance_topn"] = with_(APP, FEATURED, ks(FEATURE_VALUES)) + f"""SELECT feature,
  ks_statistic, {n('ks_statistic / (SELECT max(ks_statistic) FROM ks)', 'relative')} FROM ks
  ORDER BY ks_statistic DESC, feature LIMIT 10"""

# --- evaluation --------------------------------------------------------------------------

CURVE = """t AS (SELECT p, count_if(y = 0) AS n0, count_if(y = 1) AS n1 FROM s GROUP BY p),
c AS (SELECT *, sum(n0) OVER () AS a0, sum(n1) OVER () AS a1,
  sum(n0) OVER (ORDER BY p DESC) AS fp, sum(n1) OVER (ORDER BY p DESC) AS tp FROM t)"""
RANKING = {
    "auc_roc": "sum(CAST(n1 AS DOUBLE) * (a0 - fp + CAST(n0 AS DOUBLE) / 2)) / (any_value(a0) * CAST(any_value(a1) AS DOUBLE))",
    "auc_pr": "sum(n1 * CAST(tp AS DOUBLE) / (tp + fp)) / any_value(a1)",
    "ks_statistic": "max(abs(CAST(fp AS DOUBLE) / a0 - CAST(tp AS DOUBLE) / a1))",
}
for _name, _metric in {"auc_roc": "auc_roc", "average_precision": "auc_pr", "model_ks": "ks_statistic"}.items():
    ORACLES[_name] = with_(COARSE, CURVE) + f"SELECT {n(RANKING[_metric], _metric)} FROM c"
ORACLES["ranking_fine_scores"] = with_(FINE, CURVE) + f"SELECT {cols([n(e, k) for k, e in RANKING.items()])} FROM c"
ORACLES["run_log"] = with_(COARSE, CURVE) + union(
    [f"SELECT 'run-1' AS run_id, 'metric' AS kind, '{k}' AS key, {n(e, 'number')} FROM c"
     for k, e in RANKING.items()]
    + ["SELECT 'run-1', 'param', 'threshold', CAST(0.35 AS DOUBLE)",
       "SELECT 'run-1', 'param', 'score', NULL"]
)

CELLS = """m AS (SELECT count_if(p < 0.35 AND y = 0) AS tn, count_if(p >= 0.35 AND y = 0) AS fp,
  count_if(p < 0.35 AND y = 1) AS fn, count_if(p >= 0.35 AND y = 1) AS tp FROM s)"""
ORACLES["threshold_metrics"] = with_(COARSE, CELLS) + f"""SELECT {n('tp / (tp + fp)', 'precision')},
  {n('tp / (tp + fn)', 'recall')}, {n('2 * tp / (2 * tp + fp + fn)', 'f1')} FROM m"""
ORACLES["confusion_matrix"] = with_(COARSE, CELLS) + union(
    [f"SELECT '{c}' AS cell, {i(c, 'n')}, {n(f'{c} / (tn + fp + fn + tp)', 'share')} FROM m"
     for c in ("tn", "fp", "fn", "tp")]
)

THIN = """picks AS (SELECT j, CASE WHEN j = m - 1 THEN len - 1
    ELSE CAST(floor(j * (CAST(len - 1 AS DOUBLE) / (m - 1))) AS BIGINT) END AS pos
  FROM (SELECT len, least(200, len) AS m, unnest(range(0, least(200, len))) AS j
    FROM (SELECT count(*) AS len FROM points)))"""
ORACLES["roc_curve"] = with_(FINE, CURVE, """
w AS (SELECT *, lead(n0) OVER (ORDER BY p DESC) AS b0, lead(n1) OVER (ORDER BY p DESC) AS b1,
  lag(p) OVER (ORDER BY p DESC) AS above FROM c),
kept AS (SELECT * FROM w WHERE above IS NULL OR b0 IS NULL OR b0 <> n0 OR b1 <> n1),
points AS (SELECT 0 AS pos, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr UNION ALL
  SELECT row_number() OVER (ORDER BY p DESC), CAST(fp AS DOUBLE) / a0, CAST(tp AS DOUBLE) / a1 FROM kept)""",
    THIN) + f"SELECT j AS idx, {n('fpr', 'fpr')}, {n('tpr', 'tpr')} FROM picks JOIN points USING (pos)"
ORACLES["pr_curve"] = with_(FINE, CURVE, """
points AS (SELECT row_number() OVER (ORDER BY p) - 1 AS pos, CAST(tp AS DOUBLE) / (tp + fp) AS pr,
    CAST(tp AS DOUBLE) / a1 AS rc FROM c
  UNION ALL SELECT (SELECT count(*) FROM c), CAST(1 AS DOUBLE), CAST(0 AS DOUBLE))""",
    THIN) + f"SELECT j AS idx, {n('pr', 'precision')}, {n('rc', 'recall')} FROM picks JOIN points USING (pos)"
ORACLES["calibration_curve"] = with_(FINE, """
q AS (SELECT unnest(quantile_cont(p, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS edge FROM s),
b AS (SELECT p, y, (SELECT count(*) FROM q WHERE edge < p) AS bin FROM s),
g AS (SELECT bin, avg(p) AS mp, avg(y) AS fr FROM b GROUP BY bin)""") + f"""SELECT
  row_number() OVER (ORDER BY bin) - 1 AS idx, {n('mp', 'mean_predicted')}, {n('fr', 'fraction_pos')} FROM g"""
ORACLES["score_histogram"] = with_(FINE, """
e AS (SELECT k AS bin, k * (CAST(1 AS DOUBLE) / 30) AS lo,
  CASE WHEN k = 29 THEN CAST(1 AS DOUBLE) ELSE (k + 1) * (CAST(1 AS DOUBLE) / 30) END AS hi
  FROM (SELECT unnest(range(0, 30)) AS k))""") + f"""SELECT bin, {n('(lo + hi) / 2', 'center', 4)},
  CAST(count_if(y = 0) AS BIGINT) AS non_default, CAST(count_if(y = 1) AS BIGINT) AS "default"
  FROM e LEFT JOIN s ON p >= lo AND (p < hi OR (bin = 29 AND p <= hi)) GROUP BY bin, lo, hi"""
GRID = """g AS (SELECT CASE WHEN k = 199 THEN CAST(0.99 AS DOUBLE)
    ELSE k * ((CAST(0.99 AS DOUBLE) - CAST(0.01 AS DOUBLE)) / 199) + CAST(0.01 AS DOUBLE) END AS t
  FROM (SELECT unnest(range(0, 200)) AS k)),
m AS (SELECT t, count_if(p >= t AND y = 1) AS tp, count_if(p >= t AND y = 0) AS fp,
  count_if(p < t AND y = 1) AS fn FROM g, s GROUP BY t)"""
BEST = {
    "f1": "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)",
    "precision": "coalesce(tp / nullif(tp + fp, 0), 0)",
    "recall": "coalesce(tp / nullif(tp + fn, 0), 0)",
}
ORACLES["optimal_threshold"] = with_(FINE, CURVE, GRID) + union(
    [f"""SELECT '{k}' AS metric, {n('t', 'threshold', 4)}, {n('v', 'value', 4)} FROM
      (SELECT t, {e} AS v FROM m ORDER BY v DESC, t LIMIT 1)""" for k, e in BEST.items()]
    + [f"SELECT 'ks', CAST(0.01 AS DOUBLE), {n(RANKING['ks_statistic'], 'value', 4)} FROM c"]
)

# --- sampling and models -----------------------------------------------------------------

ORACLES["stratified_split"] = with_(APP, """
sizes AS (SELECT TARGET, count(*) AS n, sum(count(*)) OVER () AS total FROM app GROUP BY 1),
shares AS (SELECT *, total - CAST(ceil(total * CAST(0.2 AS DOUBLE)) AS BIGINT) AS wanted FROM sizes),
parts AS (SELECT *, n * wanted / total AS x, floor(n * wanted / total) AS low FROM shares),
trained AS (SELECT TARGET, n, CAST(low AS BIGINT) + CASE WHEN row_number() OVER (ORDER BY x - low DESC, TARGET)
  <= wanted - sum(low) OVER () THEN 1 ELSE 0 END AS k FROM parts)""") + """
SELECT 'train' AS split, TARGET, CAST(k AS BIGINT) AS n FROM trained
UNION ALL SELECT 'test', TARGET, CAST(n - k AS BIGINT) FROM trained"""
ORACLES["stratified_folds"] = with_(APP) + """
SELECT CAST(f AS BIGINT) AS fold, TARGET,
  CAST(CASE WHEN f = 4 THEN n ELSE floor(n * (f + 1) / 5) END - floor(n * f / 5) AS BIGINT) AS n
FROM (SELECT TARGET, count(*) AS n, unnest(range(0, 5)) AS f FROM app GROUP BY 1)"""


def nearest(candidates: str) -> str:
    return f"""pairs AS (SELECT q.vec_id AS id, o.vec_id AS neighbour, o.label AS other,
    list_distance(CAST(q.embedding AS DOUBLE[]), CAST(o.embedding AS DOUBLE[])) AS d
  FROM embeddings q JOIN {candidates} o ON o.vec_id <> q.vec_id WHERE q.label = 1),
near AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, neighbour) AS rank FROM pairs
  QUALIFY rank <= 5)"""


ORACLES["smote_neighbors"] = with_(
    nearest("(SELECT * FROM embeddings WHERE label = 1)")
) + f"SELECT id, {i('rank', 'rank')}, neighbour, {n('d', 'distance')} FROM near"
ORACLES["adasyn_weights"] = with_(nearest("embeddings")) + f"""SELECT id,
  {n('avg(CAST(other <> 1 AS INT))', 'majority_share')} FROM near GROUP BY id"""
# isotonic regression as max over starts of min over ends of the block mean
ORACLES["isotonic_calibrate"] = with_(COARSE, """
t AS (SELECT p, count(*) AS w, sum(y) AS k, row_number() OVER (ORDER BY p) AS r FROM s GROUP BY p),
c AS (SELECT *, sum(w) OVER (ORDER BY r) AS cw, sum(k) OVER (ORDER BY r) AS ck FROM t),
blocks AS (SELECT a.r AS lo, b.r AS hi, (b.ck - a.ck + a.k) / CAST(b.cw - a.cw + a.w AS DOUBLE) AS mean
  FROM c a JOIN c b ON a.r <= b.r),
ends AS (SELECT t.r, lo, min(mean) AS m FROM t JOIN blocks ON lo <= t.r AND hi >= t.r GROUP BY 1, 2)""") + f"""
SELECT {n('p', 'p')}, {n('max(m)', 'probability')} FROM t JOIN ends USING (r) GROUP BY p"""

# --- what can be checked of results that no SQL can make ----------------------------------

_DECIDED = {"precision": "tp / (tp + fp)", "recall": "tp / (tp + fn)", "f1": "2 * tp / (2 * tp + fp + fn)"}
_POINTS = "least(200, (SELECT count(*) + 1 FROM t))"
# of the tied scores, no three points of the ROC curve lie on one line
_BENDS = """(SELECT count(*) + 1 FROM (SELECT *, lead(n0) OVER (ORDER BY p DESC) AS b0, lead(n1) OVER (ORDER BY p DESC) AS b1,
  lag(p) OVER (ORDER BY p DESC) AS above FROM t) WHERE above IS NULL OR b0 IS NULL OR b0 <> n0 OR b1 <> n1)"""
_BINS = """(SELECT count(DISTINCT bin) FROM (SELECT (SELECT count(*) FROM (SELECT unnest(quantile_cont(p,
  [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS edge FROM s) WHERE edge < s.p) AS bin FROM s))"""
ORACLES["evaluation_document"] = with_(COARSE, CURVE, CELLS) + union(
    [f"SELECT '{k}' AS name, {n(e, 'value', 4)} FROM c" for k, e in RANKING.items()]
    + [f"SELECT '{k}', {n(e, 'value', 4)} FROM m" for k, e in _DECIDED.items()]
    + [f"SELECT 'confusion_matrix.{k}', CAST({k} AS DOUBLE) FROM m" for k in ("tn", "fp", "fn", "tp")]
    + [
        "SELECT 'threshold', CAST(0.35 AS DOUBLE)",
        "SELECT 'score_distribution.points', CAST(30 AS DOUBLE)",
        f"SELECT 'pr_curve.points', CAST({_POINTS} AS DOUBLE)",
        f"SELECT 'roc_curve.points', CAST({_BENDS} AS DOUBLE)",
        f"SELECT 'calibration_curve.points', CAST({_BINS} AS DOUBLE)",
    ]
)
_SHAPES = {
    "train_columns": len(APP_NUMBERS) + len(APP_TEXT) + 2 + len(APP_FEATURES_N) + len(APP_FEATURES_I),
    "test_columns": len(APP_NUMBERS) + len(APP_TEXT) + 1 + len(APP_FEATURES_N) + len(APP_FEATURES_I),
    "n_features": len(APP_NUMBERS) + len(APP_TEXT) + len(APP_FEATURES_N) + len(APP_FEATURES_I),
    "n_engineered": len(APP_FEATURES_N) + len(APP_FEATURES_I),
}
ORACLES["dataset_overview"] = with_(APP) + f"""SELECT count(*) AS train_rows, count(*) AS test_rows,
  {cols([i(str(v), k) for k, v in _SHAPES.items()])}, {n('avg(TARGET)', 'default_rate', 4)},
  {i('sum(TARGET)', 'default_count')}, {i('count_if(TARGET = 0)', 'non_default_count')} FROM app"""
ORACLES["column_dictionary"] = """SELECT CAST(n_nationkey AS BIGINT) AS id, 'nation' AS "Table", n_name AS "Row",
  'région ' || n_regionkey AS Description, nullif(n_name, 'NATION_7') AS Special FROM nation"""
ORACLES["bootstrap_points"] = with_(COARSE, CURVE, CELLS) + union(
    [f"SELECT '{k}' AS metric, {n(e, 'point', 4)}, {n('0.95', 'ci')}, {i('1', 'within')}, {i('1', 'is_width')} FROM c"
     for k, e in RANKING.items() if k != "ks_statistic"]
    + [f"SELECT '{k}', {n(e, 'point', 4)}, {n('0.95', 'ci')}, {i('1', 'within')}, {i('1', 'is_width')} FROM m" for k, e in _DECIDED.items()]
)
_WANTED = "trunc(CAST(0.3 AS DOUBLE) * count_if(label <> 1) - count_if(label = 1))"
ORACLES["smote_rules"] = f"""SELECT {cols([i(_WANTED, c) for c in ('n_rows', 'n_near', 'n_steps', 'n_between')])} FROM embeddings"""
ORACLES["adasyn_copies"] = with_(
    nearest("embeddings"),
    "shares AS (SELECT id, avg(CAST(other <> 1 AS INT)) AS share FROM near GROUP BY id)",
    f"wanted AS (SELECT {_WANTED} AS w FROM embeddings)",
) + f"""SELECT id AS parent, {i('round_even(share / (SELECT sum(share) FROM shares) * (SELECT w FROM wanted), 0)', 'copies')}
  FROM shares WHERE round_even(share / (SELECT sum(share) FROM shares) * (SELECT w FROM wanted), 0) > 0"""
ORACLES["platt_gradient"] = with_(COARSE) + "SELECT CAST(0 AS DOUBLE) AS of_intercept, CAST(0 AS DOUBLE) AS of_slope, count(*) AS n_rows FROM s"
ORACLES["score_rules"] = with_(APP) + f"SELECT SK_ID_CURR AS id, {i('1', 'keeps_rules')} FROM app WHERE DAYS_BIRTH + 8000 < 0"
ORACLES["stream_fallback"] = with_(APP) + f"""SELECT SK_ID_CURR AS id, {i('DAYS_BIRTH + 8000 < 0', 'accepted')},
  CASE WHEN DAYS_BIRTH + 8000 < 0 THEN '' ELSE 'DAYS_BIRTH < 0' END AS broken_rules,
  CASE WHEN DAYS_BIRTH + 8000 < 0 THEN {FALLBACK} END AS probability FROM app"""
ORACLES["page_by_directory"] = with_(APP, SCORED, LISTED) + """SELECT page, id, risk_score FROM (
  SELECT (row_number() OVER (ORDER BY risk_score DESC, id) - 1) // 7 AS page, id, risk_score, count(*) OVER () AS n FROM listed)
  WHERE page IN (0, (CAST(ceil(n / 7) AS BIGINT) - 1) // 2, CAST(ceil(n / 7) AS BIGINT) - 1)"""
