"""DuckDB building blocks of the SQL twins: raw, clean and aggregated tables as CTEs."""

from __future__ import annotations

import re
from collections.abc import Sequence

from creditloom.sources.fixtures import twin_ctes


def text(c: str) -> str:
    return f"nullif(upper(regexp_replace({c}, '^\\s+|\\s+$', '', 'g')), '') AS {c}"


def nonneg(c: str) -> str:
    return f"CASE WHEN {c} < 0 THEN 0 ELSE {c} END"


def past(c: str) -> str:
    return f"CASE WHEN {c} > 0 THEN NULL ELSE {c} END"


def ratio(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)"


def flagsum(condition: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT)"


CTES: dict[str, str] = {
    **twin_ctes(),
    "clean_application": f"""
        SELECT SK_ID_CURR, TARGET,
          CASE WHEN AMT_INCOME_TOTAL <= 0 THEN NULL ELSE AMT_INCOME_TOTAL END AS AMT_INCOME_TOTAL,
          AMT_CREDIT, AMT_ANNUITY,
          CASE WHEN CODE_GENDER = 'XNA' THEN NULL ELSE CODE_GENDER END AS CODE_GENDER, FLAG_OWN_CAR,
          CASE WHEN FLAG_OWN_CAR = 'N' THEN NULL ELSE OWN_CAR_AGE END AS OWN_CAR_AGE, DAYS_BIRTH,
          CASE WHEN DAYS_EMPLOYED = 365243 OR DAYS_EMPLOYED > 0 OR DAYS_EMPLOYED < -18250 THEN NULL
               ELSE DAYS_EMPLOYED END AS DAYS_EMPLOYED,
          DAYS_ID_PUBLISH, NAME_INCOME_TYPE, NAME_EDUCATION_TYPE, OCCUPATION_TYPE, ORGANIZATION_TYPE,
          EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3,
          CASE WHEN DAYS_EMPLOYED = 365243 THEN 0 WHEN DAYS_EMPLOYED IS NOT NULL THEN 1 END AS FLAG_EMPLOYED,
          CAST(floor(abs(DAYS_BIRTH) / 365e0) AS INT) AS AGE_YEARS
        FROM (SELECT * REPLACE ({text('CODE_GENDER')}, {text('FLAG_OWN_CAR')}, {text('NAME_INCOME_TYPE')},
                {text('NAME_EDUCATION_TYPE')}, {text('OCCUPATION_TYPE')}, {text('ORGANIZATION_TYPE')})
              FROM raw_application)""",
    "clean_bureau": f"""
        SELECT * REPLACE ({text('CREDIT_ACTIVE')}, {past('DAYS_CREDIT')} AS DAYS_CREDIT,
          {past('DAYS_ENDDATE_FACT')} AS DAYS_ENDDATE_FACT,
          CASE WHEN DAYS_CREDIT_ENDDATE > 18250 THEN NULL ELSE DAYS_CREDIT_ENDDATE END AS DAYS_CREDIT_ENDDATE,
          CASE WHEN AMT_CREDIT_SUM < 0 THEN 0
               ELSE least(AMT_CREDIT_SUM, (SELECT quantile_cont(AMT_CREDIT_SUM, 0.999e0) FROM raw_bureau))
          END AS AMT_CREDIT_SUM)
        FROM raw_bureau""",
    "clean_bureau_balance": f"""
        SELECT SK_ID_BUREAU, CASE WHEN MONTHS_BALANCE > 0 THEN 0 ELSE MONTHS_BALANCE END AS MONTHS_BALANCE,
          CASE WHEN STATUS IN ('C','X','0','1','2','3','4','5') THEN STATUS END AS STATUS
        FROM (SELECT SK_ID_BUREAU, MONTHS_BALANCE, {text('STATUS')}
              FROM (SELECT *, row_number() OVER (PARTITION BY SK_ID_BUREAU, MONTHS_BALANCE ORDER BY STATUS) AS rn
                    FROM raw_bureau_balance) WHERE rn = 1)""",
    "clean_pos_cash": f"""
        SELECT * REPLACE (CASE WHEN MONTHS_BALANCE > 0 THEN 0 ELSE MONTHS_BALANCE END AS MONTHS_BALANCE,
          {nonneg('SK_DPD')} AS SK_DPD, {nonneg('SK_DPD_DEF')} AS SK_DPD_DEF, {text('NAME_CONTRACT_STATUS')})
        FROM (SELECT DISTINCT * FROM raw_pos_cash)""",
    "clean_credit_card": f"""
        SELECT * REPLACE (CASE WHEN MONTHS_BALANCE > 0 THEN 0 ELSE MONTHS_BALANCE END AS MONTHS_BALANCE,
          {nonneg('SK_DPD')} AS SK_DPD, {nonneg('AMT_BALANCE')} AS AMT_BALANCE,
          coalesce({nonneg('AMT_DRAWINGS_ATM_CURRENT')}, 0) AS AMT_DRAWINGS_ATM_CURRENT,
          coalesce({nonneg('AMT_DRAWINGS_CURRENT')}, 0) AS AMT_DRAWINGS_CURRENT,
          coalesce(CNT_DRAWINGS_ATM_CURRENT, 0) AS CNT_DRAWINGS_ATM_CURRENT)
        FROM (SELECT DISTINCT * FROM raw_credit_card)""",
    "clean_previous": f"""
        SELECT SK_ID_PREV, SK_ID_CURR, {text('NAME_CONTRACT_STATUS')}, {nonneg('AMT_APPLICATION')} AS AMT_APPLICATION,
          AMT_CREDIT, {past('DAYS_DECISION')} AS DAYS_DECISION,
          CASE WHEN DAYS_FIRST_DRAWING > 18250 THEN NULL ELSE DAYS_FIRST_DRAWING END AS DAYS_FIRST_DRAWING
        FROM (SELECT *, row_number() OVER (PARTITION BY SK_ID_PREV ORDER BY AMT_APPLICATION) AS rn
              FROM raw_previous_application) WHERE rn = 1""",
    "clean_installments": f"""
        SELECT *, DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT AS DIAS_DE_ATRASO
        FROM (SELECT * REPLACE ({past('DAYS_INSTALMENT')} AS DAYS_INSTALMENT,
                {past('DAYS_ENTRY_PAYMENT')} AS DAYS_ENTRY_PAYMENT, {nonneg('AMT_INSTALMENT')} AS AMT_INSTALMENT,
                coalesce({nonneg('AMT_PAYMENT')}, 0) AS AMT_PAYMENT)
              FROM (SELECT DISTINCT * FROM raw_installments))""",
    "enriched": f"""
        SELECT *,
          (coalesce(EXT_SOURCE_1,0) + coalesce(EXT_SOURCE_2,0) + coalesce(EXT_SOURCE_3,0))
            / nullif(n_ext, 0) AS EXT_SOURCE_MEAN,
          n_ext AS EXT_SOURCE_CNT,
          CASE WHEN EXT_SOURCE_1 IS NULL THEN 1 ELSE 0 END AS FLAG_EXT_SOURCE_1_MISSING,
          CASE WHEN EXT_SOURCE_2 IS NULL THEN 1 ELSE 0 END AS FLAG_EXT_SOURCE_2_MISSING,
          CASE WHEN EXT_SOURCE_3 IS NULL THEN 1 ELSE 0 END AS FLAG_EXT_SOURCE_3_MISSING,
          {ratio('AMT_CREDIT', 'AMT_INCOME_TOTAL')} AS CREDIT_INCOME_RATIO,
          {ratio('AMT_ANNUITY', 'AMT_INCOME_TOTAL')} AS ANNUITY_INCOME_RATIO,
          ln(1 + CASE WHEN AMT_CREDIT < 0 THEN 0 ELSE AMT_CREDIT END) AS LOG_AMT_CREDIT,
          abs(DAYS_EMPLOYED) / 365.25e0 AS DAYS_EMPLOYED_YEARS
        FROM (SELECT *, CASE WHEN EXT_SOURCE_1 IS NULL THEN 0 ELSE 1 END
                + CASE WHEN EXT_SOURCE_2 IS NULL THEN 0 ELSE 1 END
                + CASE WHEN EXT_SOURCE_3 IS NULL THEN 0 ELSE 1 END AS n_ext FROM clean_application)""",
    "application": "SELECT * EXCLUDE (n_ext) FROM enriched",
    "agg_bureau": f"""
        SELECT SK_ID_CURR, count(SK_ID_BUREAU) AS BUREAU_CNT_CREDITS,
          {flagsum("CREDIT_ACTIVE = 'ACTIVE'")} AS BUREAU_CNT_ACTIVE,
          {flagsum("CREDIT_ACTIVE = 'CLOSED'")} AS BUREAU_CNT_CLOSED,
          {flagsum("CREDIT_ACTIVE = 'BAD DEBT'")} AS BUREAU_CNT_BAD_DEBT,
          coalesce(sum(AMT_CREDIT_SUM), 0) AS BUREAU_AMT_CREDIT_SUM_SUM,
          avg(AMT_CREDIT_SUM) AS BUREAU_AMT_CREDIT_SUM_MEAN, max(AMT_CREDIT_SUM) AS BUREAU_AMT_CREDIT_SUM_MAX,
          coalesce(sum(AMT_CREDIT_SUM_DEBT), 0) AS BUREAU_AMT_DEBT_SUM,
          coalesce(sum(AMT_CREDIT_SUM_OVERDUE), 0) AS BUREAU_AMT_OVERDUE_SUM,
          max(AMT_CREDIT_SUM_OVERDUE) AS BUREAU_AMT_OVERDUE_MAX,
          max(CREDIT_DAY_OVERDUE) AS BUREAU_CREDIT_DAY_OVERDUE_MAX,
          min(DAYS_CREDIT) AS BUREAU_DAYS_CREDIT_MIN, 1 AS HAS_BUREAU
        FROM clean_bureau WHERE SK_ID_CURR IN (SELECT SK_ID_CURR FROM clean_application) GROUP BY SK_ID_CURR""",
    "agg_bureau_balance": f"""
        SELECT SK_ID_CURR, CAST(sum(months) AS BIGINT) AS BB_CNT_MONTHS, CAST(sum(overdue) AS BIGINT) AS BB_CNT_OVERDUE,
          CAST(sum(closed) AS BIGINT) AS BB_CNT_CLOSED, CAST(sum(unk) AS BIGINT) AS BB_CNT_UNKNOWN,
          max(overdue * 1e0 / months) AS BB_RATE_OVERDUE_MAX, avg(overdue * 1e0 / months) AS BB_RATE_OVERDUE_MEAN,
          {flagsum('overdue > 0')} AS BB_CONTRACTS_WITH_OVERDUE, 1 AS HAS_BUREAU_BALANCE
        FROM (SELECT SK_ID_BUREAU, count(MONTHS_BALANCE) AS months, {flagsum("STATUS IN ('1','2','3','4','5')")} AS overdue,
                {flagsum("STATUS = 'C'")} AS closed, {flagsum("STATUS = 'X'")} AS unk
              FROM clean_bureau_balance GROUP BY SK_ID_BUREAU)
        JOIN (SELECT DISTINCT SK_ID_BUREAU, SK_ID_CURR FROM clean_bureau) USING (SK_ID_BUREAU)
        WHERE SK_ID_CURR IN (SELECT SK_ID_CURR FROM clean_application) GROUP BY SK_ID_CURR""",
    "agg_pos_cash": f"""
        SELECT *, {ratio('POS_CNT_DPD_GT0', 'POS_CNT_MONTHS')} AS POS_RATE_DPD, 1 AS HAS_POS_CASH
        FROM (SELECT SK_ID_CURR, count(MONTHS_BALANCE) AS POS_CNT_MONTHS, max(SK_DPD) AS POS_SK_DPD_MAX,
                avg(SK_DPD) AS POS_SK_DPD_MEAN, {flagsum('SK_DPD > 0')} AS POS_CNT_DPD_GT0,
                count(DISTINCT SK_ID_PREV) AS POS_CNT_CONTRACTS
              FROM clean_pos_cash WHERE SK_ID_CURR IN (SELECT SK_ID_CURR FROM clean_application) GROUP BY SK_ID_CURR)""",
    "agg_credit_card": f"""
        SELECT *, {ratio('CC_CNT_DPD_GT0', 'CC_CNT_MONTHS')} AS CC_RATE_DPD, 1 AS HAS_CREDIT_CARD
        FROM (SELECT SK_ID_CURR, count(MONTHS_BALANCE) AS CC_CNT_MONTHS, max(SK_DPD) AS CC_SK_DPD_MAX,
                avg(SK_DPD) AS CC_SK_DPD_MEAN, {flagsum('SK_DPD > 0')} AS CC_CNT_DPD_GT0,
                avg(AMT_BALANCE) AS CC_AMT_BALANCE_MEAN, max(AMT_BALANCE) AS CC_AMT_BALANCE_MAX,
                avg(AMT_CREDIT_LIMIT_ACTUAL) AS CC_AMT_LIMIT_MEAN,
                avg({ratio('AMT_BALANCE', 'AMT_CREDIT_LIMIT_ACTUAL')}) AS CC_UTILIZATION_MEAN,
                max({ratio('AMT_BALANCE', 'AMT_CREDIT_LIMIT_ACTUAL')}) AS CC_UTILIZATION_MAX,
                coalesce(sum(CNT_DRAWINGS_ATM_CURRENT), 0) AS CC_CNT_DRAWINGS_ATM_SUM
              FROM clean_credit_card WHERE SK_ID_CURR IN (SELECT SK_ID_CURR FROM clean_application)
              GROUP BY SK_ID_CURR)""",
    "agg_previous": f"""
        SELECT *, {ratio('PREV_CNT_APPROVED', 'PREV_CNT_APPS')} AS PREV_APPROVAL_RATE,
          {ratio('PREV_CNT_REFUSED', 'PREV_CNT_APPS')} AS PREV_REFUSAL_RATE, 1 AS HAS_PREVIOUS_APP
        FROM (SELECT SK_ID_CURR, count(SK_ID_PREV) AS PREV_CNT_APPS,
                {flagsum("NAME_CONTRACT_STATUS = 'APPROVED'")} AS PREV_CNT_APPROVED,
                {flagsum("NAME_CONTRACT_STATUS = 'REFUSED'")} AS PREV_CNT_REFUSED,
                {flagsum("NAME_CONTRACT_STATUS = 'CANCELED'")} AS PREV_CNT_CANCELED,
                avg(AMT_APPLICATION) AS PREV_AMT_APPLICATION_MEAN, max(AMT_APPLICATION) AS PREV_AMT_APPLICATION_MAX,
                avg(AMT_CREDIT) AS PREV_AMT_CREDIT_MEAN, min(DAYS_DECISION) AS PREV_DAYS_DECISION_MIN
              FROM clean_previous WHERE SK_ID_CURR IN (SELECT SK_ID_CURR FROM clean_application) GROUP BY SK_ID_CURR)""",
    "instalments": """
        SELECT SK_ID_PREV, SK_ID_CURR, NUM_INSTALMENT_NUMBER, max(AMT_INSTALMENT) AS due,
          coalesce(sum(AMT_PAYMENT), 0) AS paid, max(DIAS_DE_ATRASO) AS late
        FROM clean_installments WHERE SK_ID_CURR IN (SELECT SK_ID_CURR FROM clean_application)
        GROUP BY ALL""",
    "agg_installments": f"""
        SELECT *, {ratio('INST_AMT_PAYMENT_SUM', 'INST_AMT_INSTALMENT_SUM')} AS INST_PAYMENT_RATIO,
          {ratio('INST_CNT_ATRASO', 'INST_CNT_PARCELAS')} AS INST_RATE_ATRASO,
          {ratio('INST_CNT_CALOTE', 'INST_CNT_PARCELAS')} AS INST_RATE_CALOTE,
          {ratio('INST_CNT_UNDERPAY', 'INST_CNT_PARCELAS')} AS INST_RATE_UNDERPAY, 1 AS HAS_INSTALLMENTS
        FROM (SELECT SK_ID_CURR, count(NUM_INSTALMENT_NUMBER) AS INST_CNT_PARCELAS, sum(due) AS INST_AMT_INSTALMENT_SUM,
                sum(paid) AS INST_AMT_PAYMENT_SUM, sum(greatest(due - paid, 0)) AS INST_AMT_GAP_SUM,
                avg(late) AS INST_DIAS_ATRASO_MEAN, max(late) AS INST_DIAS_ATRASO_MAX,
                {flagsum('late > 0')} AS INST_CNT_ATRASO, {flagsum('paid = 0')} AS INST_CNT_CALOTE,
                {flagsum('due - paid > 0')} AS INST_CNT_UNDERPAY
              FROM instalments GROUP BY SK_ID_CURR)""",
    "abt": """
        SELECT * REPLACE (coalesce(HAS_BUREAU, 0) AS HAS_BUREAU, coalesce(HAS_BUREAU_BALANCE, 0) AS HAS_BUREAU_BALANCE,
          coalesce(HAS_POS_CASH, 0) AS HAS_POS_CASH, coalesce(HAS_CREDIT_CARD, 0) AS HAS_CREDIT_CARD,
          coalesce(HAS_PREVIOUS_APP, 0) AS HAS_PREVIOUS_APP, coalesce(HAS_INSTALLMENTS, 0) AS HAS_INSTALLMENTS)
        FROM application LEFT JOIN agg_bureau USING (SK_ID_CURR) LEFT JOIN agg_bureau_balance USING (SK_ID_CURR)
          LEFT JOIN agg_pos_cash USING (SK_ID_CURR) LEFT JOIN agg_credit_card USING (SK_ID_CURR)
          LEFT JOIN agg_previous USING (SK_ID_CURR) LEFT JOIN agg_installments USING (SK_ID_CURR)""",
    "curve": """
        SELECT probability, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
          sum(pos) OVER () AS p_all, sum(neg) OVER () AS n_all
        FROM (SELECT probability, sum(TARGET) AS pos, sum(1 - TARGET) AS neg FROM scored GROUP BY probability)
        WINDOW w AS (ORDER BY probability DESC ROWS UNBOUNDED PRECEDING)""",
}


def with_ctes(body: str) -> str:
    """Prefix the statement with the CTEs it names, directly or through others."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name, definition in CTES.items():
            if name not in needed and re.search(rf"\b{name}\b(?!\s*\.)", sql):
                needed.add(name)
                visit(definition)

    visit(body)
    parts = [f"{name} AS MATERIALIZED ({CTES[name]})" for name in CTES if name in needed]
    if body.lstrip().startswith("WITH"):
        body = f"SELECT * FROM ({body})"
    return f"WITH {', '.join(parts)} {body}" if parts else body


def nudge(digits: int) -> float:
    return 0.0137 * 10.0**-digits


def twin(body: str, doubles: Sequence[str], digits: int) -> str:
    if doubles:
        changes = ", ".join(f"round(CAST({c} AS DOUBLE) + {nudge(digits)!r}, {digits}) AS {c}" for c in doubles)
        body = f"SELECT * REPLACE ({changes}) FROM ({body})"
    return with_ctes(body)
