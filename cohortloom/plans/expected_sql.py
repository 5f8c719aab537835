"""DuckDB SQL that gives the expected rows of the registered queries.

Written from the record views and the semantics, with self-joins, windows and plain
aggregates, so that it shares no approach with the operators it checks.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from cohortloom.functions import tails
from cohortloom.functions.columns import AS241_CENTRE, AS241_MIDDLE, AS241_TAIL
from cohortloom.plans import demo
from cohortloom.spec import AGE_BANDS

CTES: dict[str, str] = {}
FINALS: dict[str, str] = {}


# --- expression helpers -------------------------------------------------------------

def months(x: str, y: str) -> str:
    """Absolute months between two dates, as Spark counts them."""
    whole = f"((year({x})-year({y}))*12+month({x})-month({y}))"
    return (
        f"abs(round(CASE WHEN day({x})=day({y}) OR ({x}=last_day({x}) AND {y}=last_day({y})) "
        f"THEN {whole} ELSE {whole}+(day({x})-day({y}))/31.0 END, 8))"
    )


def in_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def r6(expression: str, name: str) -> str:
    return f"round(CAST({expression} AS DOUBLE), 6) AS {name}"


def poly(coefficients, x: str) -> str:
    text = repr(float(coefficients[-1]))
    for c in reversed(coefficients[:-1]):
        text = f"({text}*{x}+{float(c)!r})"
    return text


def quantile(p: str) -> str:
    """Normal quantile of an expression, by the published rational approximations."""
    q = f"({p}-0.5)"
    r = f"sqrt(-ln(CASE WHEN {q}<0 THEN {p} ELSE 1-{p} END))"

    def ratio(tables, x):
        return f"({poly(tables[0], x)}/{poly(tables[1], x)})"

    centre = f"(0.180625-{q}*{q})"
    return (
        f"(CASE WHEN abs({q})<=0.425 THEN {q}*{ratio(AS241_CENTRE, centre)} "
        f"ELSE sign({q})*(CASE WHEN {r}<=5 THEN {ratio(AS241_MIDDLE, f'({r}-1.6)')} "
        f"ELSE {ratio(AS241_TAIL, f'({r}-5.0)')} END) END)"
    )


def integral(density: Callable[[str], str], start: str, width: str, steps: int = 4000) -> str:
    """Simpson integral of a density over [start, start + width]."""
    x = f"({start}+({width})*i/{steps}.0)"
    weight = f"(CASE WHEN i=0 OR i={steps} THEN 1 WHEN i%2=1 THEN 4 ELSE 2 END)"
    return (
        f"(list_sum(list_transform(range({steps + 1}), lambda i: {weight}*{density(x)}))"
        f"*({width})/{3 * steps}.0)"
    )


def normal_tail(z: str) -> str:
    """Upper tail of the standard normal."""
    upper = integral(lambda x: f"exp(-{x}*{x}/2)/sqrt(2*pi())", f"abs({z})", "12.0")
    return f"(CASE WHEN {z}>=0 THEN {upper} ELSE 1-{upper} END)"


def student_tail(t: str, v: str) -> str:
    """Two-sided tail of Student's t: substitute x = sqrt(v) tan(a), integrate cos^(v-1)."""
    start = f"atan(abs({t})/sqrt({v}))"
    inner = integral(lambda a: f"greatest(cos({a}),0.0)**({v}-1)", start, f"(pi()/2-{start})")
    return f"(2*exp(lgamma(({v}+1)/2.0)-lgamma({v}/2.0))/sqrt(pi())*{inner})"


# --- record views -------------------------------------------------------------------

PID = "concat('P', lpad(CAST({0} AS VARCHAR), 7, '0')) AS PTID"
LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"
PART_LINES = f"{LINES} JOIN part ON l_partkey = p_partkey"


def day(column: str) -> str:
    return f"CAST(CAST({column} AS DATE) AS VARCHAR)"


def month(column: str) -> str:
    return f"concat(CAST(year({column}) AS VARCHAR), lpad(CAST(month({column}) AS VARCHAR), 2, '0'))"


CTES["patient"] = f"""
SELECT {PID.format('c_custkey')},
  CASE WHEN c_custkey % 75 = 0 THEN '1930 and earlier' ELSE CAST(1925 + c_custkey % 75 AS VARCHAR) END AS BIRTH_YR,
  CASE WHEN c_custkey % 20 = 0 THEN 'Unknown' WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS GENDER,
  c_mktsegment AS RACE, CAST(NULL AS VARCHAR) AS ETHNICITY, n_name AS REGION,
  CASE WHEN c_acctbal < 0 THEN '1' ELSE '0' END AS DECEASED_INDICATOR,
  CASE WHEN c_acctbal < 0 THEN {month('l')} END AS DATE_OF_DEATH,
  {month('f')} AS FIRST_MONTH_ACTIVE, {month('l')} AS LAST_MONTH_ACTIVE
FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN (SELECT o_custkey, min(o_orderdate) AS f, max(o_orderdate) AS l FROM orders GROUP BY o_custkey) a
  ON o_custkey = c_custkey"""
CTES["diagnosis"] = f"""
SELECT {PID.format('o_custkey')},
  concat(CASE WHEN l_returnflag = 'A' THEN '9' ELSE 'C' END, lpad(CAST(l_partkey % 200 AS VARCHAR), 3, '0')) AS DIAGNOSIS_CD,
  CASE WHEN l_returnflag = 'A' THEN 'ICD9' ELSE 'ICD10' END AS DIAGNOSIS_CD_TYPE,
  CASE WHEN l_linestatus = 'F' THEN 'Diagnosis of' ELSE 'Family history of' END AS DIAGNOSIS_STATUS,
  {day('l_shipdate')} AS DIAG_DATE FROM {LINES}"""
CTES["treatment"] = f"""
SELECT {PID.format('o_custkey')}, lpad(CAST((o_orderkey % 500) * 1000003 AS VARCHAR), 11, '0') AS NDC,
  {day('o_orderdate')} AS RXDATE FROM orders"""
CTES["lab"] = f"""
SELECT {PID.format('o_custkey')}, p_type AS TEST_NAME, 'lab' AS TEST_TYPE,
  CASE WHEN l_linenumber = 7 AND l_quantity < 3 THEN 'see note' ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS TEST_RESULT,
  CASE WHEN l_linenumber <= 5 THEN 'mg/dL' WHEN l_linenumber = 6 THEN 'g/L' END AS RESULT_UNIT,
  CASE WHEN l_discount >= 0.095 THEN '<' END AS RELATIVE_INDICATOR, CAST(NULL AS VARCHAR) AS NORMAL_RANGE,
  CASE WHEN l_linenumber % 3 <> 0 THEN {day('l_shipdate')} END AS COLLECTED_DATE,
  CASE WHEN l_linenumber % 2 <> 0 THEN {day('l_shipdate')} END AS RESULT_DATE,
  {day('o_orderdate')} AS ORDER_DATE FROM {PART_LINES}"""
CTES["procedure_rows"] = f"""
SELECT {PID.format('o_custkey')}, p_brand AS PROC_CODE,
  CASE l_linenumber % 3 WHEN 0 THEN 'CPT4' WHEN 1 THEN 'ICD10' ELSE 'HCPCS' END AS PROC_CODE_TYPE,
  p_name AS PROC_DESC, {day('l_shipdate')} AS PROC_DATE FROM {PART_LINES}"""
CTES["observation"] = f"""
SELECT {PID.format('user_id')}, event_type AS OBS_TYPE, value AS OBS_RESULT,
  CASE WHEN event_id % 4 = 0 THEN 'u2' ELSE 'u1' END AS OBS_UNIT, {day('ts')} AS OBS_DATE FROM events"""

# --- configuration ------------------------------------------------------------------


def values(rows, columns: str) -> str:
    def one(v):
        return "NULL" if v is None else (f"'{v}'" if isinstance(v, str) else str(v))

    lines = ", ".join("(" + ", ".join(one(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {lines}) AS t({columns})"


CTES["code_group"] = values(
    [(c, g) for g, (codes, _) in demo.GROUPS.items() for c in codes], "code, LSD_GROUP"
)
CTES["drug_group"] = values(
    [(c, g) for g, (_, codes) in demo.GROUPS.items() for c in codes], "prefix, LSD_GROUP"
)
CTES["diag_conf"] = values([
    (code, term, category, f"ALGORITHM_BLOCK_{block}", status)
    for term, (codes, category, block, status) in demo.DIAG_TERMS.items() for code in codes
], "code, term, category, block, status")
CTES["lab_conf"] = values(
    [row[:9] for row in demo.LABS],
    "test_name, term, category, block, main_unit, lower_limit, upper_limit, max_timespan, min_values",
)
CTES["lab_threshold"] = values([
    (row[0], t["seq"], t["gender"], t["age_range_inf"], t["age_range_sup"], t["comparator"],
     t["threshold_value"])
    for row in demo.LABS for t in row[9]
], "test_name, seq, gender, low, high, comparator, bound")

# --- patients and cohorts -----------------------------------------------------------


def month_start(column: str) -> str:
    return f"CAST(substr({column},1,4) || '-' || substr({column},5,2) || '-01' AS DATE)"


CTES["person0"] = f"""
SELECT PTID, CAST(substr(BIRTH_YR,1,4) AS INT) AS BIRTH_YR, GENDER, RACE, ETHNICITY, REGION,
  DECEASED_INDICATOR, {month_start('DATE_OF_DEATH')} AS DATE_OF_DEATH,
  CAST(substr(FIRST_MONTH_ACTIVE,1,4) AS INT) AS FIRST_YEAR_ACTIVE,
  CAST(substr(LAST_MONTH_ACTIVE,1,4) AS INT) AS LAST_YEAR_ACTIVE,
  {month_start('FIRST_MONTH_ACTIVE')} AS FIRST_DATE_ACTIVE,
  {month_start('LAST_MONTH_ACTIVE')} AS LAST_DATE_ACTIVE FROM patient"""
CTES["person"] = """
SELECT *, CAST(LAST_DATE_ACTIVE - FIRST_DATE_ACTIVE AS INT) AS ENROLLMENT_DURATION,
  FIRST_YEAR_ACTIVE - BIRTH_YR AS AGE_AT_FIRST_ACTIVITY,
  LAST_YEAR_ACTIVE - BIRTH_YR AS AGE_AT_LAST_ACTIVE_DATE FROM person0"""
INDEX_INFO = """CAST(year(INDEX_DATE) AS INT) AS YEAR_INDEX_DATE,
  CAST(year(INDEX_DATE) - BIRTH_YR AS INT) AS AGE_AT_INDEX_DATE,
  CAST(INDEX_DATE - FIRST_DATE_ACTIVE AS INT) AS LOOKBACK_PERIOD"""
COHERENT = """BIRTH_YR <= FIRST_YEAR_ACTIVE AND FIRST_DATE_ACTIVE <= INDEX_DATE
  AND INDEX_DATE <= LAST_DATE_ACTIVE AND (DATE_OF_DEATH IS NULL OR INDEX_DATE <= DATE_OF_DEATH)"""
QUALITY = f"AGE_AT_INDEX_DATE IS NOT NULL AND GENDER NOT IN ('Unknown','unknown') AND {COHERENT}"
LIMITS = "AGE_AT_INDEX_DATE <= 65 AND ENROLLMENT_DURATION >= 30"

CTES["diag_coded"] = """
SELECT d.*, g.LSD_GROUP FROM diagnosis d JOIN code_group g ON DIAGNOSIS_CD = code"""
CTES["drug_coded"] = """
SELECT t.*, g.LSD_GROUP FROM treatment t JOIN drug_group g ON starts_with(NDC, prefix)
QUALIFY row_number() OVER (PARTITION BY PTID, NDC, RXDATE ORDER BY length(prefix) DESC) = 1"""
CTES["diag_counts"] = """
SELECT PTID, LSD_GROUP, KIND, DIAGNOSIS_CD, count(*) AS N, min(d) AS FIRST FROM (
  SELECT DISTINCT PTID, LSD_GROUP, DIAGNOSIS_CD, CAST(DIAG_DATE AS DATE) AS d,
    CASE WHEN DIAGNOSIS_STATUS = 'Diagnosis of' THEN 'certain' ELSE 'uncertain' END AS KIND
  FROM diag_coded) GROUP BY ALL"""
CTES["diag_top"] = """
SELECT * FROM diag_counts
QUALIFY row_number() OVER (PARTITION BY PTID, LSD_GROUP, KIND ORDER BY N DESC, DIAGNOSIS_CD) = 1"""
CTES["diag_summary"] = """
SELECT coalesce(a.PTID, b.PTID) AS PTID, coalesce(a.LSD_GROUP, b.LSD_GROUP) AS LSD_GROUP,
  coalesce(a.N, 0) AS N_CERTAIN_DIAGS, a.FIRST AS FIRST_CERTAIN_DIAG_DATE,
  coalesce(b.N, 0) AS N_UNCERTAIN_DIAGS, b.FIRST AS FIRST_UNCERTAIN_DIAG_DATE
FROM (SELECT * FROM diag_top WHERE KIND = 'certain') a
FULL JOIN (SELECT * FROM diag_top WHERE KIND = 'uncertain') b
  ON a.PTID = b.PTID AND a.LSD_GROUP = b.LSD_GROUP"""
CTES["drug_summary"] = """
SELECT PTID, LSD_GROUP, NDC, N AS N_TREATMENTS, FIRST AS FIRST_RXDATE FROM (
  SELECT PTID, LSD_GROUP, NDC, count(DISTINCT RXDATE) AS N, min(CAST(RXDATE AS DATE)) AS FIRST
  FROM drug_coded GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY PTID, LSD_GROUP ORDER BY N DESC, NDC) = 1"""
CTES["merged"] = """
SELECT coalesce(a.PTID, b.PTID) AS PTID, coalesce(a.LSD_GROUP, b.LSD_GROUP) AS LSD_GROUP,
  coalesce(N_CERTAIN_DIAGS, 0) AS N_CERTAIN_DIAGS, FIRST_CERTAIN_DIAG_DATE,
  coalesce(N_UNCERTAIN_DIAGS, 0) AS N_UNCERTAIN_DIAGS, FIRST_UNCERTAIN_DIAG_DATE,
  NDC, coalesce(N_TREATMENTS, 0) AS N_TREATMENTS, FIRST_RXDATE
FROM diag_summary a FULL JOIN drug_summary b ON a.PTID = b.PTID AND a.LSD_GROUP = b.LSD_GROUP"""
CTES["disease"] = """
SELECT PTID, LSD_GROUP,
  coalesce(FIRST_CERTAIN_DIAG_DATE, FIRST_RXDATE, FIRST_UNCERTAIN_DIAG_DATE) AS INDEX_DATE,
  N_CERTAIN_DIAGS, N_UNCERTAIN_DIAGS, N_TREATMENTS,
  N_CERTAIN_DIAGS >= 2 OR N_TREATMENTS >= 1 AS CERTAIN_LSD FROM merged"""
CTES["disease_info"] = f"SELECT *, {INDEX_INFO} FROM disease LEFT JOIN person USING (PTID)"
CTES["others"] = "SELECT DISTINCT PTID FROM disease WHERE LSD_GROUP <> 'alpha' AND CERTAIN_LSD"
CTES["case_base"] = """
SELECT * FROM disease_info
WHERE LSD_GROUP = 'alpha' AND CERTAIN_LSD AND PTID NOT IN (SELECT PTID FROM others)"""
CTES["cases"] = f"SELECT * FROM case_base WHERE {QUALITY} AND {LIMITS}"
CTES["like_base"] = """
SELECT *, CASE WHEN CERTAIN_LSD AND PTID IN (SELECT PTID FROM others)
  THEN 'other certain LSD diagnosis' ELSE 'uncertain LSD diagnosis' END AS UNCERTAINTY_REASON
FROM disease_info WHERE LSD_GROUP = 'alpha' AND PTID NOT IN (SELECT PTID FROM case_base)"""
CTES["likes"] = f"SELECT * FROM like_base WHERE {QUALITY} AND {LIMITS}"
CTES["spread"] = """
SELECT avg(LOOKBACK_PERIOD / nullif(ENROLLMENT_DURATION, 0)) AS mean,
  stddev_samp(LOOKBACK_PERIOD / nullif(ENROLLMENT_DURATION, 0)) AS sd
FROM disease_info WHERE CERTAIN_LSD"""


def normal_draw(seed: int) -> str:
    def part(start):
        return f"CAST(CAST('0x' || substr(md5(concat(PTID,'|{seed}')),{start},13) AS BIGINT) AS DOUBLE)"

    size = "4503599627370496.0"
    return f"sqrt(-2*ln(({part(1)}+1)/{size}))*cos(2*pi()*{part(14)}/{size})"


def drawn_index(mean: str, sd: str) -> str:
    days = f"CAST(round(ENROLLMENT_DURATION*({mean}+{sd}*{normal_draw(42)})) AS INT)"
    return f"CAST(FIRST_DATE_ACTIVE + greatest(0, least(ENROLLMENT_DURATION, {days})) AS DATE) AS INDEX_DATE"


def below(ratio: float, seed: int = 123) -> str:
    return f"substr(md5(concat(PTID,'|{seed}')),1,8) < '{int(ratio * 2**32):08x}'"


CTES["candidates"] = f"""
SELECT *, {INDEX_INFO} FROM (SELECT person.*, {drawn_index('mean', 'sd')} FROM person, spread
  WHERE PTID NOT IN (SELECT PTID FROM disease WHERE CERTAIN_LSD))"""
CTES["candidates_all"] = f"""
SELECT *, {INDEX_INFO} FROM (SELECT person.*, {drawn_index('mean', 'sd')} FROM person, spread
  WHERE PTID NOT IN (SELECT PTID FROM disease) AND {below(0.5)})"""
CTES["controls"] = f"""
SELECT * FROM candidates WHERE {QUALITY} AND {LIMITS}
QUALIFY row_number() OVER (ORDER BY md5(concat(PTID,'|123')), PTID) <= 10 * (SELECT count(*) FROM cases)"""
CTES["screened_all"] = f"""
SELECT *, {INDEX_INFO} FROM (SELECT *, LAST_DATE_ACTIVE AS INDEX_DATE FROM person)"""
COHORT_COLUMNS = """PTID, INDEX_DATE, BIRTH_YR, GENDER, AGE_AT_INDEX_DATE, AGE_AT_LAST_ACTIVE_DATE,
  ENROLLMENT_DURATION, LOOKBACK_PERIOD, DECEASED_INDICATOR"""
CTES["cohorts_s"] = f"""
SELECT 'screening_cohort' AS COHORT_TYPE, {COHORT_COLUMNS} FROM screened_all WHERE {QUALITY} AND {LIMITS}"""
CTES["cohorts_a"] = " UNION ALL ".join(
    f"SELECT '{name}' AS COHORT_TYPE, {COHORT_COLUMNS} FROM {table}"
    for name, table in (("cohort", "cases"), ("like_cohort", "likes"), ("control_cohort", "controls"))
)

# --- features -----------------------------------------------------------------------

CTES["diag_mapped"] = """
SELECT PTID, CASE WHEN m THEN concat('C', substr(DIAGNOSIS_CD, 2)) ELSE DIAGNOSIS_CD END AS DIAGNOSIS_CD,
  CASE WHEN m THEN 'ICD10' ELSE DIAGNOSIS_CD_TYPE END AS DIAGNOSIS_CD_TYPE, DIAGNOSIS_STATUS, DIAG_DATE,
  CAST(m AS INT) AS MAPPED
FROM (SELECT *, DIAGNOSIS_CD_TYPE = 'ICD9' AND CAST(substr(DIAGNOSIS_CD, 2) AS INT) % 2 = 0 AS m FROM diagnosis)"""
CTES["diag_typed"] = """
SELECT d.* REPLACE (CAST(DIAG_DATE AS DATE) AS DIAG_DATE),
  CASE WHEN c.code IS NOT NULL THEN 'specific' ELSE 'broad' END AS FEATURE_TYPE
FROM diag_mapped d LEFT JOIN diag_conf c ON DIAGNOSIS_CD = c.code AND DIAGNOSIS_STATUS = c.status"""
CTES["lab_clean0"] = """
SELECT PTID, TEST_NAME, TRY_CAST(TEST_RESULT AS DOUBLE) AS TEST_RESULT, RESULT_UNIT, RELATIVE_INDICATOR,
  CAST(coalesce(COLLECTED_DATE, RESULT_DATE, ORDER_DATE) AS DATE) AS LAB_DATE
FROM lab WHERE RESULT_UNIT IS NOT NULL AND TRY_CAST(TEST_RESULT AS DOUBLE) IS NOT NULL"""
CTES["lab_typed"] = """
SELECT l.*, CASE WHEN c.test_name IS NOT NULL THEN 'specific' ELSE 'broad' END AS FEATURE_TYPE
FROM lab_clean0 l LEFT JOIN lab_conf c ON l.TEST_NAME = c.test_name AND RESULT_UNIT = c.main_unit"""
CTES["lab_units"] = """
SELECT TEST_NAME, RESULT_UNIT AS GENERIC_UNIT FROM (
  SELECT TEST_NAME, RESULT_UNIT, count(*) AS n FROM lab WHERE RESULT_UNIT IS NOT NULL GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY TEST_NAME ORDER BY n DESC, RESULT_UNIT) = 1"""
CTES["lab_flagged"] = """
SELECT l.*, CASE WHEN FEATURE_TYPE = 'specific' OR RESULT_UNIT = GENERIC_UNIT THEN 1 ELSE 0 END AS IS_MAIN_UNIT,
  CASE WHEN TEST_RESULT < c.lower_limit OR TEST_RESULT > c.upper_limit THEN 1 ELSE 0 END AS IS_OUTLIER
FROM lab_typed l LEFT JOIN lab_units u USING (TEST_NAME)
LEFT JOIN lab_conf c ON l.TEST_NAME = c.test_name AND RESULT_UNIT = c.main_unit"""
CTES["proc_typed"] = """
SELECT PTID, PROC_CODE, PROC_CODE_TYPE, PROC_DESC, CAST(PROC_DATE AS DATE) AS PROC_DATE,
  CASE WHEN (PROC_CODE, PROC_CODE_TYPE) IN (('Brand#2','CPT4'), ('Brand#17','ICD10'))
  THEN 'specific' ELSE 'broad' END AS FEATURE_TYPE FROM procedure_rows"""
PATIENT_COLUMNS = "c.COHORT_TYPE, c.INDEX_DATE, c.BIRTH_YR, c.GENDER"


def age_term(low: str) -> str:
    return f"AGE_AT_INDEX_DATE {low} 18"


def add_stages(s: str, timerange: str) -> None:
    """Stages of the tagged cohorts ``cohorts_<s>``."""
    before = "TRUE" if timerange == "lifetime" else "{date} {sign} INDEX_DATE"
    just = timerange == "just_before_index_date"
    near = f" AND {months('{date}', 'INDEX_DATE')} <= {{span}}" if just else ""
    cohorts = f"cohorts_{s}"
    CTES[f"diag_clean_{s}"] = f"""
SELECT d.*, {PATIENT_COLUMNS} FROM diag_typed d JOIN {cohorts} c USING (PTID)
WHERE DIAGNOSIS_CD_TYPE = 'ICD10' AND (FEATURE_TYPE = 'specific' OR DIAGNOSIS_STATUS = 'Diagnosis of')
QUALIFY row_number() OVER (PARTITION BY COHORT_TYPE, PTID, DIAGNOSIS_CD, DIAG_DATE
  ORDER BY DIAGNOSIS_STATUS, FEATURE_TYPE, MAPPED) = 1"""
    CTES[f"lab_clean_{s}"] = f"""
SELECT l.*, {PATIENT_COLUMNS} FROM lab_flagged l JOIN {cohorts} c USING (PTID)
WHERE RELATIVE_INDICATOR IS NULL AND IS_MAIN_UNIT = 1 AND IS_OUTLIER = 0
QUALIFY row_number() OVER (PARTITION BY COHORT_TYPE, PTID, TEST_NAME, LAB_DATE
  ORDER BY FEATURE_TYPE, RESULT_UNIT, TEST_RESULT) = 1"""
    CTES[f"proc_clean_{s}"] = f"""
SELECT p.*, {PATIENT_COLUMNS} FROM proc_typed p JOIN {cohorts} c USING (PTID)
WHERE PROC_CODE_TYPE IN ('ICD10','CPT4','CPT5')
QUALIFY row_number() OVER (PARTITION BY COHORT_TYPE, PTID, PROC_CODE, PROC_DATE
  ORDER BY FEATURE_TYPE, PROC_CODE_TYPE, PROC_DESC) = 1"""
    CTES[f"diag_specific_{s}"] = f"""
SELECT d.*, replace(term,'_',' ') AS MEDICAL_TERM_ALGO, replace(category,'_',' ') AS MEDICAL_GROUP_ALGO,
  replace(block,'_',' ') AS MEDICAL_BLOCK_ALGO
FROM diag_clean_{s} d JOIN diag_conf ON DIAGNOSIS_CD = code WHERE FEATURE_TYPE = 'specific'"""
    CTES[f"lab_ranged_{s}"] = f"""
SELECT l.*, term, category, block, max_timespan, min_values FROM lab_clean_{s} l JOIN lab_conf c
  ON l.TEST_NAME = c.test_name
WHERE FEATURE_TYPE = 'specific' AND {(before + near).format(date='LAB_DATE', sign='<', span='max_timespan')}"""
    window_ctes(s, f"lab_ranged_{s}")
    CTES[f"lab_judged_{s}"] = f"""
SELECT w.COHORT_TYPE, w.PTID, w.TEST_NAME, w.TERM, LAB_DATE_REF, seq,
  len(list_filter(RESULTS, lambda x: CASE WHEN comparator = '<' THEN x < bound ELSE x >= bound END))
    >= min_values AS POSITIVE
FROM windows_{s} w JOIN lab_threshold t ON w.TEST_NAME = t.test_name AND lower(w.GENDER) = t.gender
WHERE year(LAB_DATE_REF) - BIRTH_YR >= coalesce(low, 0)
  AND (high IS NULL OR year(LAB_DATE_REF) - BIRTH_YR <= high)
QUALIFY row_number() OVER (PARTITION BY COHORT_TYPE, PTID, w.TEST_NAME, LAB_DATE_REF ORDER BY seq DESC) = 1"""
    CTES[f"lab_binary_{s}"] = f"""
SELECT w.COHORT_TYPE, w.PTID, bool_or(j.POSITIVE) FILTER (w.TERM = 'low_q') AS low_q,
  bool_or(j.POSITIVE) FILTER (w.TERM = 'high_q') AS high_q
FROM windows_{s} w LEFT JOIN lab_judged_{s} j USING (COHORT_TYPE, PTID, TEST_NAME, LAB_DATE_REF)
GROUP BY w.COHORT_TYPE, w.PTID"""
    flags = ", ".join(
        f"coalesce(bool_or(DIAGNOSIS_CD = '{c}'), FALSE) AS {c}" for c in demo.DIAG_CODES
    )
    CTES[f"diag_matrix_{s}"] = f"""
SELECT c.COHORT_TYPE, c.PTID, {flags} FROM {cohorts} c LEFT JOIN (
  SELECT * FROM diag_specific_{s} WHERE {(before + near).format(date='DIAG_DATE', sign='<=', span=24)}) d
  ON c.PTID = d.PTID AND c.COHORT_TYPE = d.COHORT_TYPE GROUP BY c.COHORT_TYPE, c.PTID"""
    flags = ", ".join(
        f"""coalesce(bool_or(PROC_CODE = '{c}'), FALSE) AS "{c}\"""" for c in demo.PROCEDURE_CODES
    )
    CTES[f"proc_matrix_{s}"] = f"""
SELECT c.COHORT_TYPE, c.PTID, {flags} FROM {cohorts} c LEFT JOIN (
  SELECT * FROM proc_clean_{s} WHERE FEATURE_TYPE = 'specific'
    AND {(before + near).format(date='PROC_DATE', sign='<=', span=24)}) d
  ON c.PTID = d.PTID AND c.COHORT_TYPE = d.COHORT_TYPE GROUP BY c.COHORT_TYPE, c.PTID"""
    CTES[f"matrix_{s}"] = f"""
SELECT c.COHORT_TYPE, c.PTID, AGE_AT_INDEX_DATE, GENDER, low_q, high_q,
  d.* EXCLUDE (COHORT_TYPE, PTID), p.* EXCLUDE (COHORT_TYPE, PTID)
FROM {cohorts} c LEFT JOIN lab_binary_{s} b ON b.PTID = c.PTID AND b.COHORT_TYPE = c.COHORT_TYPE
JOIN diag_matrix_{s} d ON d.PTID = c.PTID AND d.COHORT_TYPE = c.COHORT_TYPE
JOIN proc_matrix_{s} p ON p.PTID = c.PTID AND p.COHORT_TYPE = c.COHORT_TYPE"""

    def any_code(term: str) -> str:
        return "(" + " OR ".join(demo.DIAG_TERMS[term][0]) + ")"

    # Codes are never null, so only the lab block can lack data.
    CTES[f"blocks_{s}"] = f"""
SELECT *, low_q IS NOT NULL OR high_q IS NOT NULL AS a_av,
  coalesce(low_q, FALSE) OR coalesce(high_q, FALSE) AS a,
  {any_code('pain')} OR {any_code('kin_alpha')} AS b,
  ({any_code('swelling')} AND {age_term('>=')}) OR ({any_code('pain')} AND {age_term('<')}) AS c,
  {any_code('other_cause')} AS d, AGE_AT_INDEX_DATE IS NOT NULL AS c_av
FROM matrix_{s}"""
    CTES[f"labels_{s}"] = f"""
SELECT *, CASE WHEN rule_1_label IS NULL AND rule_2_label IS NULL AND rule_3_label IS NULL THEN NULL
  ELSE coalesce(rule_1_label, FALSE) OR coalesce(rule_2_label, FALSE) OR coalesce(rule_3_label, FALSE)
  END AS global_label FROM (
SELECT COHORT_TYPE, PTID, a_av AS rule_1_availability, a_av AND c_av AS rule_2_availability,
  a_av AS rule_3_availability, a_av AS minimal_global_availability,
  a_av AND c_av AS strict_global_availability,
  CASE WHEN a_av THEN a AND b END AS rule_1_label, CASE WHEN a_av AND c_av THEN a AND c END AS rule_2_label,
  CASE WHEN a_av THEN a AND NOT d END AS rule_3_label FROM blocks_{s})"""
    CTES[f"block_labels_{s}"] = f"""
SELECT COHORT_TYPE, PTID, a_av AS ALGORITHM_BLOCK_A_availability, TRUE AS ALGORITHM_BLOCK_B_availability,
  c_av AS ALGORITHM_BLOCK_C_availability, TRUE AS ALGORITHM_BLOCK_D_availability,
  CASE WHEN a_av THEN a END AS ALGORITHM_BLOCK_A_label, b AS ALGORITHM_BLOCK_B_label,
  CASE WHEN c_av THEN c END AS ALGORITHM_BLOCK_C_label, d AS ALGORITHM_BLOCK_D_label FROM blocks_{s}"""
    CTES[f"flagged_{s}"] = f"""
SELECT c.* FROM {cohorts} c JOIN labels_{s} l ON c.PTID = l.PTID AND c.COHORT_TYPE = l.COHORT_TYPE
WHERE global_label"""


def window_ctes(s: str, ranged: str) -> None:
    CTES[f"windows_{s}"] = f"""
SELECT * EXCLUDE (distance) FROM (
  SELECT x.COHORT_TYPE, x.PTID, x.BIRTH_YR, x.GENDER, x.TEST_NAME, x.term AS TERM,
    replace(x.term,'_',' ') AS MEDICAL_TERM_ALGO, replace(x.category,'_',' ') AS MEDICAL_GROUP_ALGO,
    replace(x.block,'_',' ') AS MEDICAL_BLOCK_ALGO, x.RESULT_UNIT,
    x.LAB_DATE AS LAB_DATE_REF, x.TEST_RESULT AS TEST_RESULT_REF, x.INDEX_DATE,
    min(y.LAB_DATE) AS WINDOW_START, max(y.LAB_DATE) AS WINDOW_END,
    CAST(count(*) AS INT) AS N_RESULTS_IN_WINDOW,
    list(y.TEST_RESULT ORDER BY y.LAB_DATE) AS RESULTS, list(y.LAB_DATE ORDER BY y.LAB_DATE) AS DATES,
    any_value(x.min_values) AS min_values, {months('x.LAB_DATE', 'x.INDEX_DATE')} AS distance
  FROM {ranged} x JOIN {ranged} y ON x.PTID = y.PTID AND x.TEST_NAME = y.TEST_NAME
    AND x.COHORT_TYPE = y.COHORT_TYPE AND {months('x.LAB_DATE', 'y.LAB_DATE')} <= x.max_timespan
  GROUP BY ALL HAVING count(*) >= any_value(x.min_values))
QUALIFY distance = min(distance) OVER (PARTITION BY COHORT_TYPE, PTID, TEST_NAME)"""


add_stages("s", "lifetime")
add_stages("a", "before_index_date")
RANGES = {"al": "lifetime", "a": "before_index_date", "aj": "just_before_index_date"}
for _s in ("al", "aj"):
    CTES[f"cohorts_{_s}"] = "SELECT * FROM cohorts_a"
    add_stages(_s, RANGES[_s])
CTES["lab_ranged_j"] = f"""
SELECT l.*, term, category, block, max_timespan, min_values FROM lab_clean_s l
JOIN lab_conf c ON l.TEST_NAME = c.test_name WHERE FEATURE_TYPE = 'specific' AND LAB_DATE < INDEX_DATE
  AND {months('LAB_DATE', 'INDEX_DATE')} <= max_timespan"""
window_ctes("j", "lab_ranged_j")

# --- several algorithms: every table carries the algorithm ---------------------------

CTES["algorithm_m"] = values([
    ("ASMD_russia", "alpha", -1000, 1000, 10000, 1 / 250000),
    ("gaucher_australia", "beta", -1000, 65, 1000, 1 / 100000),
    ("pompe_canada", "gamma", 10, 65, 1000, 1 / 40000),
], "ALGORITHM, grp, youngest, oldest, per_case, prevalence")
CTES["diag_conf_m"] = values([
    (name, code, category, "Family history of" if category == "family_history" else "Diagnosis of")
    for name in demo.PUBLISHED_GROUPS
    for category, codes in demo.published_categories(name)[0].items() for code in codes
], "ALGORITHM, code, category, status")
CTES["lab_conf_m"] = values([
    (name, test, category) for name in demo.PUBLISHED_GROUPS
    for category, test in demo.published_categories(name)[1].items()
], "ALGORITHM, test_name, term")
FITS = "AGE_AT_INDEX_DATE BETWEEN youngest AND oldest AND ENROLLMENT_DURATION >= 30"
CTES["case_m"] = f"""
SELECT ALGORITHM, CASE WHEN CERTAIN_LSD AND PTID NOT IN (SELECT PTID FROM disease o WHERE CERTAIN_LSD AND o.LSD_GROUP <> grp)
    THEN 'cohort' ELSE 'like_cohort' END AS COHORT_TYPE, disease_info.*
FROM disease_info JOIN algorithm_m ON LSD_GROUP = grp WHERE {QUALITY} AND {FITS}"""
CTES["cohort_m"] = f"""
SELECT ALGORITHM, COHORT_TYPE, {COHORT_COLUMNS}, N_CERTAIN_DIAGS, CASE WHEN COHORT_TYPE = 'like_cohort' THEN
  CASE WHEN CERTAIN_LSD THEN 'other certain LSD diagnosis' ELSE 'uncertain LSD diagnosis' END END AS UNCERTAINTY_REASON
FROM case_m UNION ALL
SELECT ALGORITHM, 'control_cohort', {COHORT_COLUMNS}, NULL, NULL FROM (
  SELECT a.ALGORITHM, a.per_case, candidates.* FROM candidates, algorithm_m a WHERE {QUALITY} AND {FITS}
  QUALIFY row_number() OVER (PARTITION BY a.ALGORITHM ORDER BY md5(concat(PTID,'|123')), PTID) <= a.per_case * (
    SELECT count(*) FROM case_m k WHERE k.ALGORITHM = a.ALGORITHM AND k.COHORT_TYPE = 'cohort'))"""
ROW_M = "ALGORITHM, COHORT_TYPE, PTID"
CTES["diag_clean_m"] = f"""
SELECT {ROW_M}, category, INDEX_DATE, CAST(DIAG_DATE AS DATE) AS day, category IS NOT NULL AS named
FROM (SELECT c.*, d.DIAGNOSIS_CD, d.DIAGNOSIS_STATUS, d.DIAG_DATE, d.MAPPED, k.category
  FROM diag_mapped d JOIN cohort_m c USING (PTID) LEFT JOIN diag_conf_m k
    ON k.ALGORITHM = c.ALGORITHM AND k.code = d.DIAGNOSIS_CD AND k.status = d.DIAGNOSIS_STATUS
  WHERE DIAGNOSIS_CD_TYPE = 'ICD10')
WHERE category IS NOT NULL OR DIAGNOSIS_STATUS = 'Diagnosis of'
QUALIFY row_number() OVER (PARTITION BY {ROW_M}, DIAGNOSIS_CD, day
  ORDER BY DIAGNOSIS_STATUS, category IS NOT NULL, MAPPED) = 1"""
CTES["found_m"] = f"""
SELECT {ROW_M}, list(DISTINCT category) AS found FROM diag_clean_m WHERE named AND day <= INDEX_DATE GROUP BY ALL"""
CTES["lab_clean_m"] = f"""
SELECT {ROW_M}, BIRTH_YR, GENDER, INDEX_DATE, TEST_NAME, TEST_RESULT, LAB_DATE, term
FROM (SELECT c.*, l.TEST_NAME, l.TEST_RESULT, l.RESULT_UNIT, l.LAB_DATE, k.term
  FROM lab_clean0 l JOIN cohort_m c USING (PTID) JOIN lab_units u USING (TEST_NAME)
  LEFT JOIN lab_conf_m k ON k.ALGORITHM = c.ALGORITHM AND k.test_name = l.TEST_NAME AND RESULT_UNIT = 'mg/dL'
  WHERE RELATIVE_INDICATOR IS NULL AND (k.term IS NOT NULL OR RESULT_UNIT = GENERIC_UNIT))
QUALIFY row_number() OVER (PARTITION BY {ROW_M}, TEST_NAME, LAB_DATE
  ORDER BY term IS NOT NULL, RESULT_UNIT, TEST_RESULT) = 1"""
CTES["lab_window_m"] = f"""
SELECT * FROM (
  SELECT x.ALGORITHM, x.COHORT_TYPE, x.PTID, x.GENDER, x.term, x.LAB_DATE,
    list(y.TEST_RESULT) AS results, {months('x.LAB_DATE', 'x.INDEX_DATE')} AS distance
  FROM lab_clean_m x JOIN lab_clean_m y ON x.ALGORITHM = y.ALGORITHM AND x.COHORT_TYPE = y.COHORT_TYPE
    AND x.PTID = y.PTID AND x.TEST_NAME = y.TEST_NAME AND {months('x.LAB_DATE', 'y.LAB_DATE')} <= 12
  WHERE x.term IS NOT NULL AND y.term IS NOT NULL AND x.LAB_DATE < x.INDEX_DATE AND y.LAB_DATE < y.INDEX_DATE
  GROUP BY x.ALGORITHM, x.COHORT_TYPE, x.PTID, x.GENDER, x.term, x.LAB_DATE, x.INDEX_DATE)
QUALIFY distance = min(distance) OVER (PARTITION BY {ROW_M}, term)"""
CTES["verdict_m"] = f"""
SELECT {ROW_M}, term, bool_or(list_max(results) >= CASE GENDER WHEN 'Female' THEN 30 ELSE 35 END) AS past
FROM lab_window_m GROUP BY ALL"""


def verdict(term: str) -> str:
    return (f"(SELECT past FROM verdict_m v WHERE v.ALGORITHM = c.ALGORITHM AND v.COHORT_TYPE = c.COHORT_TYPE"
            f" AND v.PTID = c.PTID AND v.term = '{term}') AS {term}")


CTES["state_m"] = f"""
SELECT c.ALGORITHM, c.COHORT_TYPE, c.PTID, AGE_AT_INDEX_DATE AS age, coalesce(found, []) AS found,
  {', '.join(verdict(t) for t in demo.LAB_CATEGORIES)}
FROM cohort_m c LEFT JOIN found_m f ON f.ALGORITHM = c.ALGORITHM AND f.COHORT_TYPE = c.COHORT_TYPE AND f.PTID = c.PTID"""


def has(*categories: str) -> str:
    return "(" + " OR ".join(f"list_contains(found, '{c}')" for c in categories) + ")"


def yes(*terms: str) -> str:
    return "(" + " OR ".join(f"coalesce({t}, FALSE)" for t in terms) + ")"


# Blocks of the published rules, written out: *_av is the availability. A diagnosis is always known.
CTES["block_m"] = f"""
SELECT {ROW_M}, {has('splenomegaly', 'hepatomegaly', 'organomegaly')} AS a, TRUE AS a_av,
  {has('family_history')} AS b, TRUE AS b_av,
  (({yes('low_hdl')} OR {has('bone_damage', 'interstitial_lung_disease')}) AND age >= 18)
    OR ({has('hypotension', 'development_delay')} AND age < 18) AS c, TRUE AS c_av,
  {has('asthma', 'autoimmune_liver_damage', 'blood_diseases_and_tumors', 'cerebral_palsy', 'cryptogenic_cirrhosis',
       'cystic_fibrosis', 'heart_failure', 'hereditary_ataxia', 'infections', 'infectious_liver_disease',
       'infectious_mononucleosis', 'lysosomal_disorders', 'pulmonary_obstructive_disease')} AS d, TRUE AS d_av
FROM state_m WHERE ALGORITHM = 'ASMD_russia' UNION ALL
SELECT {ROW_M}, {yes('thrombocytopenia')}, thrombocytopenia IS NOT NULL,
  {yes('hyperferritinaemia')} AND {yes('elevated_transferrin')} AND NOT {has('hemochromatosis')},
  hyperferritinaemia IS NOT NULL AND elevated_transferrin IS NOT NULL, {yes('anemias')}, anemias IS NOT NULL,
  {has('abdominal_distension', 'abdominal_pain', 'avascular_necrosis', 'hepatomegaly', 'monoclonal_gammopathy',
       'organomegaly', 'bone_disorders', 'osteoporosis', 'splenomegaly')} OR {yes('low_hdl')}
    OR ({has('short_stature')} AND age < 15), TRUE
FROM state_m WHERE ALGORITHM = 'gaucher_australia' UNION ALL
SELECT {ROW_M}, {yes('muscular_lab')}, muscular_lab IS NOT NULL, {yes('hepatic_lab')} OR {has('liver')}, TRUE,
  {has('myopathy', 'muscle_weakness', 'gait_abnormalities')}, TRUE,
  {has('abnormal_pft', 'dyspnea', 'sleep_apnea')}, TRUE
FROM state_m WHERE ALGORITHM = 'pompe_canada'"""
CTES["alternative_m"] = f"""
SELECT {ROW_M}, a AND b AS l1, a_av AND b_av AS v1, a AND c AS l2, a_av AND c_av AS v2, a AND NOT d AS l3, a_av AND d_av AS v3
FROM block_m WHERE ALGORITHM = 'ASMD_russia' UNION ALL
SELECT {ROW_M}, a AND b, a_av AND b_av, a AND c, a_av AND c_av, a AND d, a_av AND d_av
FROM block_m WHERE ALGORITHM = 'gaucher_australia' UNION ALL
SELECT {ROW_M}, a AND b AND c, a_av AND b_av AND c_av, a AND b AND d, a_av AND b_av AND d_av, NULL, NULL
FROM block_m WHERE ALGORITHM = 'pompe_canada'"""
CTES["label_m"] = f"""
SELECT *, CASE WHEN rule_1_label IS NULL AND rule_2_label IS NULL AND rule_3_label IS NULL THEN NULL
  ELSE coalesce(rule_1_label, FALSE) OR coalesce(rule_2_label, FALSE) OR coalesce(rule_3_label, FALSE) END AS global_label
FROM (SELECT {ROW_M}, v1 AS rule_1_availability, v2 AS rule_2_availability, v3 AS rule_3_availability,
  v1 OR v2 OR coalesce(v3, FALSE) AS minimal_global_availability, v1 AND v2 AND coalesce(v3, TRUE) AS strict_global_availability,
  CASE WHEN v1 THEN l1 END AS rule_1_label, CASE WHEN v2 THEN l2 END AS rule_2_label,
  CASE WHEN v3 THEN l3 END AS rule_3_label FROM alternative_m)"""

# --- finals: sources to disease patients ---------------------------------------------

FINALS["scan_parquet"] = "SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice FROM orders"
FINALS["parquet_roundtrip"] = "SELECT * FROM patient"
FINALS["csv_roundtrip"] = FINALS["json_roundtrip"] = "SELECT * FROM treatment"
FINALS["project_descriptor"] = """SELECT TEST_NAME, TEST_TYPE, TEST_RESULT, RESULT_UNIT, RELATIVE_INDICATOR,
  NORMAL_RANGE, count(*) AS N FROM lab GROUP BY ALL"""
FINALS["filter_codes_equal"] = "SELECT d.* FROM diagnosis d WHERE DIAGNOSIS_CD IN (SELECT code FROM code_group)"
FINALS["filter_codes_prefix"] = """SELECT t.* FROM treatment t
WHERE EXISTS (SELECT 1 FROM drug_group WHERE starts_with(NDC, prefix))"""
FINALS["reject_missing"] = "SELECT PTID, BIRTH_YR, GENDER FROM person WHERE BIRTH_YR IS NOT NULL AND GENDER <> 'Unknown'"
FINALS["criteria_filter"] = """SELECT PTID, ENROLLMENT_DURATION, AGE_AT_LAST_ACTIVE_DATE FROM person
WHERE ENROLLMENT_DURATION >= 30 AND AGE_AT_LAST_ACTIVE_DATE BETWEEN 10 AND 65"""
FINALS["coherent_dates"] = f"SELECT PTID, LSD_GROUP, INDEX_DATE FROM disease_info WHERE {COHERENT}"
FINALS["quality_checks"] = f"SELECT PTID, LSD_GROUP, INDEX_DATE, GENDER FROM disease_info WHERE {QUALITY}"
FINALS["group_filters"] = """SELECT 'group' AS COHORT_TYPE, * FROM disease WHERE LSD_GROUP = 'alpha'
UNION ALL SELECT 'certain_other', * FROM disease WHERE LSD_GROUP <> 'alpha' AND CERTAIN_LSD"""
FINALS["patient_info"] = "SELECT * FROM person"
FINALS["index_info"] = "SELECT PTID, LSD_GROUP, INDEX_DATE, YEAR_INDEX_DATE, AGE_AT_INDEX_DATE, LOOKBACK_PERIOD FROM disease_info"
FINALS["coalesce_dates"] = """SELECT PTID, TEST_NAME, coalesce(COLLECTED_DATE, RESULT_DATE, ORDER_DATE) AS LAB_DATE,
  count(*) AS N FROM lab GROUP BY ALL"""
FINALS["coalesce_dates_existing"] = "SELECT PTID, OBS_DATE, count(*) AS N FROM observation GROUP BY ALL"
FINALS["parse_dates"] = """SELECT TEST_NAME, CAST(coalesce(COLLECTED_DATE, RESULT_DATE, ORDER_DATE) AS DATE) AS LAB_DATE,
  count(*) AS N FROM lab GROUP BY ALL"""
FINALS["cast_results"] = f"""SELECT TEST_NAME, count(*) AS N, count(TRY_CAST(TEST_RESULT AS DOUBLE)) AS N_NUMBERS,
  {r6('sum(TRY_CAST(TEST_RESULT AS DOUBLE))', 'TOTAL')} FROM lab GROUP BY ALL"""
FINALS["code_to_group"] = """SELECT 'diagnosis' AS SOURCE, DIAGNOSIS_CD AS CODE, LSD_GROUP, count(*) AS N
FROM diag_coded GROUP BY ALL UNION ALL
SELECT 'treatment', NDC, LSD_GROUP, count(*) FROM treatment JOIN drug_group ON starts_with(NDC, prefix) GROUP BY ALL"""
FINALS["crosswalk_codes"] = "SELECT * FROM diag_mapped"
FINALS["code_descriptions"] = """SELECT DIAGNOSIS_CD,
  CASE WHEN DIAGNOSIS_CD[1] = 'C' THEN concat('term ', DIAGNOSIS_CD) END AS MEDICAL_TERM_ICD,
  CASE WHEN DIAGNOSIS_CD[1] = 'C' THEN concat('group ', substr(DIAGNOSIS_CD,1,3)) END AS MEDICAL_GROUP_ICD,
  count(*) AS N FROM diag_mapped GROUP BY ALL"""
FINALS["feature_type_diags"] = """SELECT DIAGNOSIS_CD, DIAGNOSIS_STATUS, FEATURE_TYPE, count(*) AS N FROM diag_typed GROUP BY ALL"""
FINALS["feature_type_labs"] = "SELECT TEST_NAME, RESULT_UNIT, FEATURE_TYPE, count(*) AS N FROM lab_typed GROUP BY ALL"
OBSERVED = """CASE WHEN OBS_TYPE = 'purchase' AND OBS_UNIT = 'u1' THEN 'specific' ELSE 'broad' END AS FEATURE_TYPE"""
FINALS["feature_type_observations"] = f"""SELECT OBS_TYPE, OBS_UNIT, {OBSERVED}, count(*) AS N
FROM observation WHERE OBS_RESULT IS NOT NULL GROUP BY ALL"""
FINALS["feature_type_measurements"] = f"""SELECT OBS_TYPE AS MEASUREMENT_TYPE, OBS_UNIT AS MEASUREMENT_DETAIL,
  {OBSERVED}, count(*) AS N FROM observation WHERE OBS_RESULT IS NOT NULL GROUP BY ALL"""
FINALS["feature_type_procedures"] = "SELECT PROC_CODE, PROC_CODE_TYPE, FEATURE_TYPE, count(*) AS N FROM proc_typed GROUP BY ALL"
FINALS["feature_type_treatments"] = """SELECT NDC, CASE WHEN NDC IN ('00001000003','00002000006')
  THEN 'specific' ELSE 'broad' END AS FEATURE_TYPE, count(*) AS N FROM treatment GROUP BY ALL"""
FINALS["feature_type_notes"] = """SELECT OBS_TYPE AS SDS_TERM, CASE WHEN OBS_TYPE = 'error'
  THEN 'specific' ELSE 'broad' END AS FEATURE_TYPE, count(*) AS N FROM observation GROUP BY ALL"""
FINALS["main_unit"] = "SELECT * FROM lab_units"
FINALS["main_unit_flag"] = """SELECT TEST_NAME, RESULT_UNIT, FEATURE_TYPE, IS_MAIN_UNIT, count(*) AS N FROM lab_flagged GROUP BY ALL"""
FINALS["goal_status_flag"] = """SELECT DIAGNOSIS_CD, DIAGNOSIS_STATUS, FEATURE_TYPE,
  CAST(FEATURE_TYPE = 'specific' OR DIAGNOSIS_STATUS = 'Diagnosis of' AS INT) AS IS_GOAL_STATUS, count(*) AS N
FROM diag_typed GROUP BY ALL"""
FINALS["outlier_flag"] = """SELECT TEST_NAME, RESULT_UNIT, TEST_RESULT, IS_OUTLIER, count(*) AS N FROM lab_flagged GROUP BY ALL"""


def bounds(table: str, test: str, unit: str, kind: str, value: str) -> str:
    def q(p):
        return f"quantile_cont({value}, {p})"

    return f"""SELECT {test}, {unit}, {kind}, count(*) AS COUNT, {r6(q(0.25), 'Q1')}, {r6(q(0.75), 'Q3')},
  {r6(f'{q(0.75)} - {q(0.25)}', 'IQR')} FROM {table} GROUP BY ALL"""


FINALS["outlier_bounds"] = bounds("lab_typed", "TEST_NAME", "RESULT_UNIT", "FEATURE_TYPE", "TEST_RESULT")
FINALS["outlier_bounds_observations"] = bounds(
    "(SELECT * FROM observation WHERE OBS_RESULT IS NOT NULL)", "OBS_TYPE", "OBS_UNIT", OBSERVED, "OBS_RESULT"
)
FINALS["outlier_bounds_stage"] = bounds(
    "(SELECT l.* FROM lab_typed l JOIN cohorts_s USING (PTID))",
    "TEST_NAME", "RESULT_UNIT", "FEATURE_TYPE", "TEST_RESULT",
)
FINALS["clean_treatments"] = """SELECT DISTINCT COHORT_TYPE, PTID, NDC, CAST(RXDATE AS DATE) AS RXDATE,
  CASE WHEN NDC IN ('00001000003','00002000006') THEN 'specific' ELSE 'broad' END AS FEATURE_TYPE
FROM treatment JOIN cohorts_s USING (PTID)"""
FINALS["clean_notes"] = """SELECT DISTINCT COHORT_TYPE, PTID, OBS_TYPE AS SDS_TERM, CAST(OBS_DATE AS DATE) AS SDS_DATE,
  CASE WHEN OBS_TYPE = 'error' THEN 'specific' ELSE 'broad' END AS FEATURE_TYPE
FROM observation JOIN cohorts_s USING (PTID)"""
OBS_MAIN = """(SELECT OBS_TYPE, OBS_UNIT FROM (SELECT OBS_TYPE, OBS_UNIT, count(*) AS n FROM observation GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY OBS_TYPE ORDER BY n DESC, OBS_UNIT) = 1)"""
FINALS["clean_observations"] = f"""SELECT COHORT_TYPE, PTID, OBS_TYPE, day AS OBS_DATE, OBS_UNIT,
  {r6('OBS_RESULT', 'OBS_RESULT')}, FEATURE_TYPE
FROM (SELECT *, CAST(OBS_DATE AS DATE) AS day, {OBSERVED} FROM observation WHERE OBS_RESULT IS NOT NULL)
JOIN cohorts_s USING (PTID)
WHERE (FEATURE_TYPE = 'specific' OR (OBS_TYPE, OBS_UNIT) IN {OBS_MAIN})
  AND NOT (OBS_TYPE = 'purchase' AND OBS_UNIT = 'u1' AND (OBS_RESULT < 1 OR OBS_RESULT > 40))
QUALIFY row_number() OVER (PARTITION BY COHORT_TYPE, PTID, OBS_TYPE, day
  ORDER BY FEATURE_TYPE, OBS_RESULT, OBS_UNIT) = 1"""
FINALS["clean_measurements"] = f"""SELECT COHORT_TYPE, PTID, OBS_TYPE AS MEASUREMENT_TYPE, day AS MEASUREMENT_DATE,
  OBS_UNIT AS MEASUREMENT_DETAIL, {r6('OBS_RESULT', 'MEASUREMENT_VALUE')}, 'broad' AS FEATURE_TYPE
FROM (SELECT *, CAST(OBS_DATE AS DATE) AS day FROM observation WHERE OBS_RESULT IS NOT NULL)
JOIN cohorts_s USING (PTID) WHERE (OBS_TYPE, OBS_UNIT) IN {OBS_MAIN}
QUALIFY row_number() OVER (PARTITION BY COHORT_TYPE, PTID, OBS_TYPE, day ORDER BY OBS_UNIT, OBS_RESULT) = 1"""
FINALS["diagnosis_summary"] = "SELECT * FROM diag_summary"
FINALS["treatment_summary"] = "SELECT * FROM drug_summary"
FINALS["top_code_per_group"] = "SELECT * FROM diag_top"
FINALS["merge_diag_treatment"] = "SELECT * FROM merged"
FINALS["index_date"] = "SELECT PTID, LSD_GROUP, INDEX_DATE FROM disease"
FINALS["certain_flag"] = "SELECT PTID, LSD_GROUP, CERTAIN_LSD FROM disease"
FINALS["disease_patients"] = "SELECT * FROM disease"
FINALS["exclude_patients"] = "SELECT PTID, GENDER FROM patient WHERE PTID NOT IN (SELECT PTID FROM disease)"
FINALS["ratio_distribution"] = f"SELECT {r6('mean', 'MEAN')}, {r6('sd', 'STDDEV')} FROM spread"
FINALS["index_date_screening"] = """SELECT PTID, FIRST_DATE_ACTIVE, LAST_DATE_ACTIVE, LAST_DATE_ACTIVE AS INDEX_DATE FROM person"""
FINALS["index_date_control"] = f"SELECT PTID, FIRST_DATE_ACTIVE, LAST_DATE_ACTIVE, {drawn_index('0.5', '0.25')} FROM person"
FINALS["control_candidates"] = "SELECT PTID, INDEX_DATE, AGE_AT_INDEX_DATE, LOOKBACK_PERIOD FROM candidates"
FINALS["control_candidates_all"] = "SELECT PTID, INDEX_DATE, AGE_AT_INDEX_DATE, LOOKBACK_PERIOD FROM candidates_all"
FINALS["potential_patients"] = "SELECT * FROM disease WHERE LSD_GROUP = 'alpha'"
OUTPUT = "PTID, INDEX_DATE, BIRTH_YR, GENDER, AGE_AT_INDEX_DATE, ENROLLMENT_DURATION, LOOKBACK_PERIOD"
FINALS["disease_cohort"] = f"SELECT {OUTPUT}, N_CERTAIN_DIAGS, N_TREATMENTS FROM cases"
FINALS["like_cohort"] = f"SELECT {OUTPUT}, UNCERTAINTY_REASON FROM likes"
FINALS["control_cohort"] = f"SELECT {OUTPUT} FROM controls"
FINALS["screening_cohort"] = f"SELECT {OUTPUT} FROM screened_all WHERE {QUALITY} AND {LIMITS} AND {below(0.5)}"
FINALS["union_cohorts"] = "SELECT COHORT_TYPE, PTID, INDEX_DATE FROM cohorts_a"
FINALS["sample_ratio"] = f"SELECT PTID FROM patient WHERE {below(0.05)}"
FINALS["sample_exact"] = """SELECT PTID FROM patient
QUALIFY row_number() OVER (ORDER BY md5(concat(PTID,'|123')), PTID) <= (SELECT floor(count(*)/10) FROM patient)"""
FINALS["distinct_patients"] = "SELECT DISTINCT PTID FROM diagnosis"

# --- finals: features to labels ------------------------------------------------------

FINALS["cohort_events"] = """SELECT PTID, DIAGNOSIS_CD, count(*) AS N FROM diagnosis
WHERE PTID IN (SELECT PTID FROM cohorts_s) GROUP BY ALL"""
FINALS["enrich_events"] = """SELECT PTID, NDC, RXDATE, INDEX_DATE, BIRTH_YR, GENDER FROM treatment LEFT JOIN cohorts_s USING (PTID)"""
FINALS["preprocess_diags"] = f"""SELECT d.* REPLACE (CAST(DIAG_DATE AS DATE) AS DIAG_DATE), {PATIENT_COLUMNS}
FROM diag_mapped d JOIN cohorts_s c USING (PTID)"""
FINALS["preprocess_labs"] = f"""SELECT l.*, 'lab' AS TEST_TYPE, CAST(NULL AS VARCHAR) AS NORMAL_RANGE, {PATIENT_COLUMNS}
FROM lab_clean0 l JOIN cohorts_s c USING (PTID)"""
FINALS["process_diags"] = """SELECT d.* EXCLUDE (DIAGNOSIS_CD_TYPE), c.COHORT_TYPE, c.INDEX_DATE,
  CAST(FEATURE_TYPE = 'specific' OR DIAGNOSIS_STATUS = 'Diagnosis of' AS INT) AS IS_GOAL_STATUS,
  CASE WHEN DIAGNOSIS_CD[1] = 'C' THEN concat('term ', DIAGNOSIS_CD) END AS MEDICAL_TERM_ICD,
  CASE WHEN DIAGNOSIS_CD[1] = 'C' THEN concat('group ', substr(DIAGNOSIS_CD,1,3)) END AS MEDICAL_GROUP_ICD
FROM diag_typed d JOIN cohorts_s c USING (PTID)"""
FINALS["process_labs"] = """SELECT l.*, c.COHORT_TYPE, c.INDEX_DATE FROM lab_flagged l JOIN cohorts_s c USING (PTID)"""
FINALS["dedupe_by_date"] = """SELECT PTID, TEST_NAME, LAB_DATE, RESULT_UNIT, TEST_RESULT FROM lab_clean0
QUALIFY row_number() OVER (PARTITION BY PTID, TEST_NAME, LAB_DATE ORDER BY RESULT_UNIT, TEST_RESULT) = 1"""
FINALS["clean_diags"] = """SELECT COHORT_TYPE, PTID, DIAGNOSIS_CD, DIAG_DATE, DIAGNOSIS_STATUS, MAPPED, FEATURE_TYPE FROM diag_clean_s"""
FINALS["clean_labs"] = """SELECT COHORT_TYPE, PTID, TEST_NAME, LAB_DATE, RESULT_UNIT, TEST_RESULT, FEATURE_TYPE FROM lab_clean_s"""
FINALS["clean_procedures"] = """SELECT COHORT_TYPE, PTID, PROC_CODE, PROC_DATE, PROC_CODE_TYPE, PROC_DESC, FEATURE_TYPE FROM proc_clean_s"""
FINALS["specific_features"] = """SELECT PTID, DIAGNOSIS_CD, DIAG_DATE, DIAGNOSIS_STATUS, MEDICAL_TERM_ALGO,
  MEDICAL_GROUP_ALGO, MEDICAL_BLOCK_ALGO FROM diag_specific_s"""
FINALS["timerange_numeric"] = "SELECT PTID, TEST_NAME, LAB_DATE, TEST_RESULT, INDEX_DATE FROM lab_ranged_j"
FINALS["timerange_discrete"] = f"""SELECT PTID, DIAGNOSIS_CD, DIAG_DATE, INDEX_DATE FROM diag_specific_s
WHERE DIAG_DATE <= INDEX_DATE AND {months('DIAG_DATE', 'INDEX_DATE')} <= 24"""
FLAT = """SELECT * EXCLUDE (BIRTH_YR, GENDER, TERM, RESULTS, DATES, min_values),
  array_to_string(list_transform(RESULTS, lambda x: CAST(CAST(x AS INT) AS VARCHAR)), ',') AS TEST_RESULTS_IN_WINDOW,
  array_to_string(list_transform(DATES, lambda x: CAST(x AS VARCHAR)), ',') AS LAB_DATES_IN_WINDOW FROM """
FINALS["numeric_window"] = FLAT + "windows_s"
FINALS["numeric_window_just_before"] = FLAT + "windows_j"
FINALS["labs_to_binary"] = "SELECT * FROM lab_binary_s"
FINALS["labs_matrix"] = "SELECT COHORT_TYPE, PTID, low_q, high_q FROM matrix_s"
FINALS["discrete_matrix"] = "SELECT * FROM diag_matrix_s"
FINALS["procedure_matrix"] = "SELECT * FROM proc_matrix_s"
FINALS["feature_matrix"] = "SELECT * FROM matrix_s"
FINALS["rule_availability"] = """SELECT COHORT_TYPE, PTID, rule_1_availability, rule_2_availability, rule_3_availability,
  minimal_global_availability, strict_global_availability FROM labels_s"""
FINALS["rule_labels"] = "SELECT * FROM labels_s"
FINALS["global_label"] = "SELECT PTID, global_label FROM labels_s"
FINALS["block_availability"] = "SELECT COLUMNS('COHORT_TYPE|PTID|.*_availability') FROM block_labels_s"
FINALS["block_labels"] = "SELECT * FROM block_labels_s"
FINALS["flagged_cohort"] = "SELECT PTID, INDEX_DATE, AGE_AT_INDEX_DATE FROM flagged_s"
FINALS["all_flagged"] = "SELECT COHORT_TYPE, PTID, INDEX_DATE, GENDER FROM flagged_a"


def shares(columns) -> str:
    parts = []
    for c in columns:
        hits = f"count(*) FILTER ({c})"
        parts += [f"{hits} AS {c}", r6(f"{hits} / nullif(count({c}), 0)", f"{c}_pct")]
    return ", ".join(parts)


RULE_COLUMNS = [f"rule_{i}_availability" for i in (1, 2, 3)] + [
    "minimal_global_availability", "strict_global_availability"
] + [f"rule_{i}_label" for i in (1, 2, 3)] + ["global_label"]
BLOCK_COLUMNS = [f"ALGORITHM_BLOCK_{b}_{k}" for k in ("availability", "label") for b in "ABCD"]
FINALS["performance"] = f"SELECT COHORT_TYPE, count(*) AS n_people, {shares(RULE_COLUMNS)} FROM labels_a GROUP BY ALL"
FINALS["performance_blocks"] = f"SELECT COHORT_TYPE, count(*) AS n_people, {shares(BLOCK_COLUMNS)} FROM block_labels_a GROUP BY ALL"
CTES["recalls"] = """
SELECT COHORT_TYPE, count(*) FILTER (minimal_global_availability) / count(*) AS av,
  count(*) FILTER (global_label) / nullif(count(global_label), 0) AS recall FROM labels_a GROUP BY ALL"""
FINALS["false_positive_estimate"] = f"""SELECT {r6('x.av', 'case_availability')}, {r6('x.recall', 'case_recall')},
  {r6('y.av', 'control_availability')}, {r6('y.recall', 'control_recall')},
  {r6('1000.0 * y.recall / nullif(x.recall, 0)', 'false_positives_per_true_positive')}
FROM (SELECT * FROM recalls WHERE COHORT_TYPE = 'cohort') x, (SELECT * FROM recalls WHERE COHORT_TYPE = 'control_cohort') y"""

FINALS["cohorts_all_algorithms"] = """SELECT ALGORITHM, COHORT_TYPE, PTID, INDEX_DATE, AGE_AT_INDEX_DATE, N_CERTAIN_DIAGS,
  UNCERTAINTY_REASON FROM cohort_m"""
FINALS["rule_labels_published"] = "SELECT * FROM label_m"
FINALS["block_labels_published"] = f"SELECT {ROW_M}, " + ", ".join(
    f"{x}_av AS ALGORITHM_BLOCK_{x.upper()}_availability, CASE WHEN {x}_av THEN {x} END AS ALGORITHM_BLOCK_{x.upper()}_label"
    for x in "abcd"
) + " FROM block_m"
FINALS["assessment_all_algorithms"] = f"""SELECT ALGORITHM, COHORT_TYPE, count(*) AS n_people, {shares(RULE_COLUMNS)}
FROM label_m GROUP BY ALL"""
CTES["recall_m"] = """
SELECT ALGORITHM, COHORT_TYPE, count(*) FILTER (minimal_global_availability) / count(*) AS av,
  count(*) FILTER (global_label) / nullif(count(global_label), 0) AS recall FROM label_m GROUP BY ALL"""
FINALS["false_positives_all_algorithms"] = f"""SELECT ALGORITHM, {r6('x.av', 'case_availability')},
  {r6('x.recall', 'case_recall')}, {r6('y.av', 'control_availability')}, {r6('y.recall', 'control_recall')},
  {r6('y.recall / prevalence / nullif(x.recall, 0)', 'false_positives_per_true_positive')}
FROM (SELECT DISTINCT ALGORITHM, prevalence FROM algorithm_m JOIN recall_m USING (ALGORITHM))
LEFT JOIN (SELECT * FROM recall_m WHERE COHORT_TYPE = 'cohort') x USING (ALGORITHM)
LEFT JOIN (SELECT * FROM recall_m WHERE COHORT_TYPE = 'control_cohort') y USING (ALGORITHM)"""

# --- finals: statistics --------------------------------------------------------------

BASE = "PTID, INDEX_DATE, BIRTH_YR, GENDER, DATE_OF_DEATH, FIRST_YEAR_ACTIVE, FIRST_DATE_ACTIVE, LAST_DATE_ACTIVE, AGE_AT_INDEX_DATE, ENROLLMENT_DURATION"
CTES["bases"] = " UNION ALL ".join(
    f"SELECT '{n}' AS COHORT_TYPE, {BASE} FROM {t}"
    for n, t in (("cohort", "case_base"), ("like_cohort", "like_base"), ("control_cohort", "candidates"))
)
FINALS["attrition"] = " UNION ALL ".join(
    f"""SELECT COHORT_TYPE, {i} AS POSITION, '{step}' AS STEP,
  count(DISTINCT CASE WHEN {condition} THEN PTID END) AS COUNT FROM bases GROUP BY COHORT_TYPE"""
    for i, (step, condition) in enumerate((
        ("Initial", "TRUE"), ("Quality checks", QUALITY),
        ("AGE_AT_INDEX_DATE", f"{QUALITY} AND AGE_AT_INDEX_DATE <= 65"),
        ("ENROLLMENT_DURATION", f"{QUALITY} AND {LIMITS}"),
    ))
) + " UNION ALL SELECT 'control_cohort', 4, 'Random sampling', 10 * count(*) FROM cases"


def described(table: str) -> str:
    parts = []
    for column, unit in (
        ("ENROLLMENT_DURATION", 365), ("LOOKBACK_PERIOD", 365), ("AGE_AT_INDEX_DATE", 1),
        ("AGE_AT_LAST_ACTIVE_DATE", 1),
    ):
        def of(e):
            return f"({e})/{unit}.0"

        parts.append(f"""SELECT COHORT_TYPE, '{column}' AS VARIABLE, count({column}) AS COUNT,
  {r6(of(f'avg({column})'), 'MEAN')}, {r6(of(f'stddev_samp({column})'), 'STD')},
  {r6(of(f'min({column})'), 'MIN')}, {r6(of(f'quantile_cont({column}, 0.25)'), 'Q1')},
  {r6(of(f'quantile_cont({column}, 0.5)'), 'MEDIAN')}, {r6(of(f'quantile_cont({column}, 0.75)'), 'Q3')},
  {r6(of(f'max({column})'), 'MAX')} FROM {table} GROUP BY COHORT_TYPE""")
    return " UNION ALL ".join(parts)


FINALS["demographics_continuous"] = described("cohorts_a")
FINALS["demographics_flagged"] = described("flagged_a")
def categories_in(table: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT COHORT_TYPE, '{c}' AS VARIABLE, VALUE, COUNT,
  {r6('100.0 * COUNT / sum(COUNT) OVER (PARTITION BY COHORT_TYPE)', 'PCT')}
FROM (SELECT COHORT_TYPE, {c} AS VALUE, count(*) AS COUNT FROM {table} WHERE {c} IS NOT NULL GROUP BY ALL)"""
        for c in ("DECEASED_INDICATOR", "GENDER")
    )


FINALS["demographics_discrete"] = categories_in("cohorts_a")
FINALS["demographics_discrete_flagged"] = categories_in("flagged_a")
_bands, _low = [], -1
for _label, _high in AGE_BANDS:
    _bands.append((_label, _low, 1000 if _high is None else _high))
    _low = _high
CTES["age_band"] = values(_bands, "AGE_GROUPS, low, high")


def bands_in(table: str) -> str:
    return f"""SELECT s.COHORT_TYPE, b.AGE_GROUPS, count(c.PTID) AS AGE_GROUPS_COUNT,
  {r6('count(c.PTID) / any_value(s.n)', 'AGE_GROUPS_PCT')}
FROM (SELECT COHORT_TYPE, count(DISTINCT PTID) AS n FROM {table} GROUP BY ALL) s CROSS JOIN age_band b
LEFT JOIN {table} c ON c.COHORT_TYPE = s.COHORT_TYPE AND AGE_AT_INDEX_DATE > low AND AGE_AT_INDEX_DATE <= high
GROUP BY s.COHORT_TYPE, b.AGE_GROUPS"""


FINALS["age_groups"] = bands_in("cohorts_a")
FINALS["age_groups_flagged"] = bands_in("flagged_a")
FINALS["inclusion_reasons"] = """SELECT
  count(*) FILTER (N_CERTAIN_DIAGS >= 2 AND N_TREATMENTS = 0) AS N_CERTAIN_DIAGS_ONLY,
  count(*) FILTER (N_CERTAIN_DIAGS < 2 AND N_TREATMENTS > 0) AS N_TREATMENTS_ONLY,
  count(*) FILTER (N_CERTAIN_DIAGS >= 2 AND N_TREATMENTS > 0) AS N_DIAGS_AND_TREATMENTS FROM cases"""
FINALS["uncertainty_reasons"] = """SELECT count(*) FILTER (UNCERTAINTY_REASON LIKE 'uncertain%') AS UNCERTAIN_DIAG,
  count(*) FILTER (UNCERTAINTY_REASON LIKE 'other%') AS OTHER_CERTAIN_DIAG FROM likes"""
CTES["flagged_case"] = "SELECT * FROM cases WHERE PTID IN (SELECT PTID FROM flagged_a WHERE COHORT_TYPE = 'cohort')"
CTES["flagged_like"] = "SELECT * FROM likes WHERE PTID IN (SELECT PTID FROM flagged_a WHERE COHORT_TYPE = 'like_cohort')"
FINALS["inclusion_reasons_flagged"] = FINALS["inclusion_reasons"].replace("FROM cases", "FROM flagged_case")
FINALS["uncertainty_reasons_flagged"] = FINALS["uncertainty_reasons"].replace("FROM likes", "FROM flagged_like")
FINALS["other_group_breakdown"] = """SELECT LSD_GROUP, count(*) AS COUNT_OTHER_CERTAIN_DIAG FROM (
  SELECT * FROM disease WHERE LSD_GROUP <> 'alpha'
    AND PTID IN (SELECT PTID FROM likes WHERE UNCERTAINTY_REASON LIKE 'other%')
  QUALIFY row_number() OVER (PARTITION BY PTID ORDER BY N_CERTAIN_DIAGS DESC, LSD_GROUP) = 1) GROUP BY ALL"""
FINALS["other_group_breakdown_flagged"] = FINALS["other_group_breakdown"].replace("FROM likes", "FROM flagged_like")
FINALS["flagged_features"] = """SELECT COHORT_TYPE, PTID, DIAGNOSIS_CD, DIAG_DATE FROM diag_clean_a
WHERE (COHORT_TYPE, PTID) IN (SELECT (COHORT_TYPE, PTID) FROM flagged_a)"""
CTES["diag_texts_a"] = """
SELECT *, CASE WHEN DIAGNOSIS_CD[1] = 'C' THEN concat('term ', DIAGNOSIS_CD) END AS MEDICAL_TERM_ICD,
  CASE WHEN DIAGNOSIS_CD[1] = 'C' THEN concat('group ', substr(DIAGNOSIS_CD,1,3)) END AS MEDICAL_GROUP_ICD
FROM diag_clean_a"""


def lifts(table, cohorts, levels, condition, main, others) -> str:
    names = [main, *others]
    level = ", ".join(levels)
    counts = ", ".join(
        f"count(DISTINCT PTID) FILTER (COHORT_TYPE = '{n}') AS COUNT_{n.upper()}" for n in names
    )
    pcts = ", ".join(
        f"coalesce(COUNT_{n.upper()} / nullif((SELECT count(DISTINCT PTID) FROM {cohorts} WHERE COHORT_TYPE = '{n}'), 0), 0.0)"
        f" AS PCT_{n.upper()}" for n in names
    )
    m, out = main.upper(), []
    for n in (x.upper() for x in names):
        out += [f"COUNT_{n}", r6(f"PCT_{n}", f"PCT_{n}")]
    for o in (x.upper() for x in others):
        lift = f"least(PCT_{m} / greatest(PCT_{o}, 1e-10), 1000.0)"
        gain = f"(1 - 1/({lift}))"
        out += [r6(lift, f"LIFT_{m}_ON_{o}"), r6(
            f"CASE WHEN {lift} >= 1 THEN 2*{gain}*PCT_{m}/nullif({gain}+PCT_{m}, 0) ELSE 0 END",
            f"IMPORTANCE_{m}_ON_{o}",
        )]
    return f"""SELECT {level}, {', '.join(out)} FROM (SELECT *, {pcts} FROM (
  SELECT {level}, {counts} FROM {table} WHERE {condition} AND {levels[0]} IS NOT NULL GROUP BY {level}))"""


STRICT = "DIAG_DATE < INDEX_DATE"
FLAGGED = "(COHORT_TYPE, PTID) IN (SELECT (COHORT_TYPE, PTID) FROM flagged_a)"
FINALS["prevalence_lift"] = lifts(
    "diag_texts_a", "cohorts_a", ["MEDICAL_TERM_ICD", "MEDICAL_GROUP_ICD", "FEATURE_TYPE"], STRICT,
    "cohort", ["like_cohort", "control_cohort"],
)
FINALS["prevalence_lift_specific"] = lifts(
    "diag_specific_a", "cohorts_a", ["MEDICAL_GROUP_ALGO"],
    f"{STRICT} AND {months('DIAG_DATE', 'INDEX_DATE')} <= 24", "cohort", ["control_cohort"],
)
FINALS["prevalence_lift_flagged"] = lifts(
    "diag_specific_a", "flagged_a", ["MEDICAL_TERM_ALGO"], f"{STRICT} AND {FLAGGED}",
    "like_cohort", ["control_cohort"],
)
CTES["pooled_features"] = f"SELECT * REPLACE ('all_cohorts' AS COHORT_TYPE) FROM diag_texts_a WHERE {FLAGGED}"
CTES["pooled_cohort"] = "SELECT * REPLACE ('all_cohorts' AS COHORT_TYPE) FROM flagged_a"
FINALS["prevalence_all_flagged"] = lifts(
    "pooled_features", "pooled_cohort", ["MEDICAL_GROUP_ICD"], STRICT, "all_cohorts", []
)
CTES["diag_placed_a"] = """
SELECT d.*, CASE WHEN FEATURE_TYPE = 'specific' THEN replace(k.category,'_',' ') END AS MEDICAL_GROUP_ALGO
FROM diag_texts_a d LEFT JOIN diag_conf k ON DIAGNOSIS_CD = k.code"""
_cube = []
for _population, _cohorts in (("cohort", "cohorts_a"), ("flagged", "flagged_a")):
    for _level, _column in (("group", "MEDICAL_GROUP_ICD"), ("term", "MEDICAL_TERM_ICD"), ("category", "MEDICAL_GROUP_ALGO")):
        _rows = lifts(
            "diag_placed_a", _cohorts, [_column, "FEATURE_TYPE"],
            STRICT if _population == "cohort" else f"{STRICT} AND {FLAGGED}", "cohort", ["like_cohort", "control_cohort"],
        )
        _cube.append(f"SELECT '{_population}' AS POPULATION, '{_level}' AS LEVEL, * RENAME ({_column} AS VALUE) FROM ({_rows})")
FINALS["prevalence_lift_cube"] = " UNION ALL BY NAME ".join(_cube)
FINALS["diag_count_percentiles"] = "SELECT COHORT_TYPE, " + ", ".join(
    r6(f"quantile_cont(n, {p})", n)
    for n, p in (("p05", 0.05), ("Q1", 0.25), ("MEDIAN", 0.5), ("Q3", 0.75), ("p95", 0.95))
) + f""" FROM (SELECT c.COHORT_TYPE, c.PTID, count(DISTINCT MEDICAL_TERM_ICD) AS n FROM cohorts_a c
  LEFT JOIN (SELECT * FROM diag_texts_a WHERE {STRICT}) d ON c.PTID = d.PTID AND c.COHORT_TYPE = d.COHORT_TYPE
  GROUP BY c.COHORT_TYPE, c.PTID) GROUP BY ALL"""


def global_stats(windows: str, cohorts: str) -> str:
    return f"""SELECT COHORT_TYPE, count(*) AS N_PATIENTS,
  {r6(f'count(*) / (SELECT count(DISTINCT PTID) FROM {cohorts} s WHERE s.COHORT_TYPE = n.COHORT_TYPE)', 'PCT_PATIENTS')},
  {r6('avg(n)', 'MEAN_MEASURES')}, {r6('stddev_samp(n)', 'STD_MEASURES')},
  {r6('quantile_cont(n, 0.5)', 'MEDIAN_MEASURES')}, {r6('quantile_cont(n, 0.25)', 'Q1_MEASURES')},
  {r6('quantile_cont(n, 0.75)', 'Q3_MEASURES')},
  {r6('quantile_cont(n, 0.75) - quantile_cont(n, 0.25)', 'IQ_MEASURES')}
FROM (SELECT COHORT_TYPE, PTID, CAST(sum(len(RESULTS)) AS BIGINT) AS n FROM {windows} GROUP BY ALL) n GROUP BY COHORT_TYPE"""


FINALS["lab_stats_global"] = global_stats("windows_a", "cohorts_a")
FINALS["lab_stats_flagged"] = global_stats(f"(SELECT * FROM windows_a WHERE {FLAGGED})", "flagged_a")
def test_stats(windows: str, cohorts: str) -> str:
    return f"""SELECT a.COHORT_TYPE, a.TEST_NAME, UNIT, N_PATIENTS,
  {r6('N_PATIENTS / N_COHORT', 'PCT_PATIENTS')}, {r6('MEAN_MEASURES', 'MEAN_MEASURES')},
  {r6('STD_MEASURES', 'STD_MEASURES')}, MAX_MEASURES, MEDIAN_MEASURES, Q1_MEASURES, Q3_MEASURES,
  Q3_MEASURES - Q1_MEASURES AS IQ_MEASURES, {r6('MEAN_VALUE', 'MEAN_VALUE')}, {r6('STD_VALUE', 'STD_VALUE')},
  MIN_VALUE, Q1_VALUE, MEDIAN_VALUE, Q3_VALUE, MAX_VALUE
FROM (SELECT COHORT_TYPE, TEST_NAME, count(*) AS N_PATIENTS, avg(n) AS MEAN_MEASURES, stddev_samp(n) AS STD_MEASURES,
    max(n) AS MAX_MEASURES, quantile_disc(n, 0.5) AS MEDIAN_MEASURES, quantile_disc(n, 0.25) AS Q1_MEASURES,
    quantile_disc(n, 0.75) AS Q3_MEASURES
  FROM (SELECT COHORT_TYPE, TEST_NAME, PTID, CAST(sum(len(RESULTS)) AS BIGINT) AS n FROM {windows} GROUP BY ALL)
  GROUP BY ALL) a
JOIN (SELECT COHORT_TYPE, TEST_NAME, min(RESULT_UNIT) AS UNIT, avg(TEST_RESULT_REF) AS MEAN_VALUE,
    stddev_samp(TEST_RESULT_REF) AS STD_VALUE, min(TEST_RESULT_REF) AS MIN_VALUE,
    quantile_disc(TEST_RESULT_REF, 0.25) AS Q1_VALUE, quantile_disc(TEST_RESULT_REF, 0.5) AS MEDIAN_VALUE,
    quantile_disc(TEST_RESULT_REF, 0.75) AS Q3_VALUE, max(TEST_RESULT_REF) AS MAX_VALUE
  FROM {windows} GROUP BY ALL) b ON a.COHORT_TYPE = b.COHORT_TYPE AND a.TEST_NAME = b.TEST_NAME
JOIN (SELECT COHORT_TYPE, count(DISTINCT PTID) AS N_COHORT FROM {cohorts} GROUP BY ALL) c ON c.COHORT_TYPE = a.COHORT_TYPE"""


FINALS["lab_stats_per_test"] = FINALS["lab_stats_per_test_merged"] = test_stats("windows_a", "cohorts_a")
FINALS["lab_stats_per_test_flagged"] = test_stats(f"(SELECT * FROM windows_a WHERE {FLAGGED})", "flagged_a")


def per_term(table: str, count: str, of: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT COHORT_TYPE, '{t}' AS TERM, {count.format(t)} AS COUNT,
  round({count.format(t)} / nullif({of.format(t)}, 0) * 100, 1) AS PCT FROM {table} GROUP BY COHORT_TYPE"""
        for t in demo.LAB_TERMS
    )


FINALS["labs_availability"] = per_term("matrix_a", "count({0})", "count(*)")
FINALS["labs_availability_lifetime"] = per_term("matrix_s", "count({0})", "count(*)")
FINALS["labs_flagged"] = per_term("matrix_a", "count(*) FILTER ({0})", "count({0})")
FINALS["labs_availability_ranges"] = " UNION ALL ".join(
    f"SELECT '{r}' AS TIME_RANGE, * FROM ({per_term(f'matrix_{s}', 'count({0})', 'count(*)')})" for s, r in RANGES.items()
)
FINALS["labs_flagged_ranges"] = " UNION ALL ".join(
    f"SELECT '{r}' AS TIME_RANGE, * FROM ({per_term(f'matrix_{s}', 'count(*) FILTER ({0})', 'count({0})')})"
    for s, r in RANGES.items()
)
FINALS["performance_ranges"] = " UNION ALL ".join(
    f"SELECT '{r}' AS TIME_RANGE, COHORT_TYPE, count(*) AS n_people, {shares(RULE_COLUMNS)} FROM labels_{s} GROUP BY ALL"
    for s, r in RANGES.items()
)
FINALS["labs_flagged_patients"] = per_term(
    f"(SELECT * FROM matrix_a WHERE {FLAGGED})", "count(*) FILTER ({0})", "count(*)"
)

# --- finals: significance ------------------------------------------------------------


def pair_table(first: str, second: str) -> str:
    return f"""SELECT '{first}|{second}' AS PAIR, PTID, TEST_NAME, TEST_RESULT_REF,
  CAST(COHORT_TYPE = '{first}' AS INT) AS LABEL FROM windows_a WHERE COHORT_TYPE IN ('{first}', '{second}')"""


CTES["pairs"] = " UNION ALL ".join(pair_table(a, b) for a, b in (
    ("cohort", "control_cohort"), ("cohort", "like_cohort"), ("like_cohort", "control_cohort")
))
MAIN_PAIR = "PAIR = 'like_cohort|control_cohort'"
FINALS["balanced_sample"] = f"""SELECT PTID, TEST_NAME, TEST_RESULT_REF, LABEL FROM (
  SELECT *, count(*) FILTER (LABEL = 0) OVER (PARTITION BY TEST_NAME) AS n0,
    count(*) FILTER (LABEL = 1) OVER (PARTITION BY TEST_NAME) AS n1 FROM pairs WHERE {MAIN_PAIR})
QUALIFY row_number() OVER (PARTITION BY TEST_NAME, LABEL
  ORDER BY md5(concat(PTID,'|123')), PTID, TEST_RESULT_REF) <= least(n0, n1)"""
CTES["balanced_pairs"] = """
SELECT * FROM (SELECT *, count(*) FILTER (LABEL = 0) OVER (PARTITION BY PAIR, TEST_NAME) AS n0,
    count(*) FILTER (LABEL = 1) OVER (PARTITION BY PAIR, TEST_NAME) AS n1 FROM pairs)
QUALIFY row_number() OVER (PARTITION BY PAIR, TEST_NAME, LABEL
  ORDER BY md5(concat(PTID,'|123')), PTID, TEST_RESULT_REF) <= least(n0, n1)"""
CTES["ranked"] = """
SELECT *, rank() OVER (PARTITION BY PAIR, TEST_NAME ORDER BY TEST_RESULT_REF)
  + (count(*) OVER (PARTITION BY PAIR, TEST_NAME, TEST_RESULT_REF) - 1) / 2.0 AS rk,
  count(*) OVER (PARTITION BY PAIR, TEST_NAME, TEST_RESULT_REF) AS t FROM pairs"""
CTES["rank_sums"] = """
SELECT PAIR, TEST_NAME, n0, n1, ties, u, CASE WHEN greatest(u, n0*n1-u) IS NULL THEN NULL ELSE
  (greatest(u, n0*n1-u) - n0*n1/2.0 - 0.5) / sqrt(n0*n1/12.0*((n0+n1+1) - ties/((n0+n1)*(n0+n1-1.0)))) END AS z
FROM (SELECT *, rs - n0*(n0+1)/2.0 AS u FROM (
  SELECT PAIR, TEST_NAME, CAST(count(*) FILTER (LABEL = 0) AS DOUBLE) AS n0,
    CAST(count(*) FILTER (LABEL = 1) AS DOUBLE) AS n1, sum(rk) FILTER (LABEL = 0) AS rs,
    sum(CAST(t AS DOUBLE)*t - 1) AS ties FROM ranked GROUP BY ALL) WHERE n0 > 0 AND n1 > 0)"""
CTES["rank_p"] = f"""
SELECT PAIR, TEST_NAME, u AS statistic, least(1.0, 2*{normal_tail('z')}) AS p FROM rank_sums"""
CTES["balanced_ranked"] = CTES["ranked"].replace("FROM pairs", "FROM balanced_pairs")
CTES["balanced_rank_sums"] = CTES["rank_sums"].replace("FROM ranked", "FROM balanced_ranked")
CTES["balanced_rank_p"] = CTES["rank_p"].replace("FROM rank_sums", "FROM balanced_rank_sums")
CTES["scored"] = f"""
SELECT *, {quantile('((i-0.375)/(n+0.25))')} AS m FROM (
  SELECT *, row_number() OVER (PARTITION BY PAIR, LABEL, TEST_NAME ORDER BY TEST_RESULT_REF) AS i,
    count(*) OVER (PARTITION BY PAIR, LABEL, TEST_NAME) AS n FROM pairs)"""
CTES["shapiro_sums"] = f"""
SELECT PAIR, LABEL, TEST_NAME, any_value(n) AS n, sum(m*TEST_RESULT_REF) AS mx, sum(m*m) AS mm,
  var_samp(TEST_RESULT_REF)*(any_value(n)-1) AS ss, max(TEST_RESULT_REF) FILTER (i = 1) AS x1,
  max(TEST_RESULT_REF) FILTER (i = 2) AS x2, max(TEST_RESULT_REF) FILTER (i = n-1) AS y2,
  max(TEST_RESULT_REF) FILTER (i = n) AS y1, max(m) FILTER (i = n) AS m1, max(m) FILTER (i = n-1) AS m2
FROM scored GROUP BY PAIR, LABEL, TEST_NAME"""
CTES["shapiro_weights"] = f"""
SELECT *, CASE WHEN n = 3 THEN sqrt(0.5) ELSE m1/sqrt(mm) + {poly(tails.R94_LAST_WEIGHT, '(1/sqrt(n))')} END AS a1,
  m2/sqrt(mm) + {poly(tails.R94_SECOND_WEIGHT, '(1/sqrt(n))')} AS a2 FROM shapiro_sums WHERE n >= 3 AND ss > 0"""
CTES["shapiro_w"] = """
SELECT PAIR, LABEL, TEST_NAME, n, least(1.0, (CASE WHEN n = 3 THEN a1*(y1-x1)
  WHEN n <= 5 THEN a1*(y1-x1) + (mx - m1*(y1-x1)) / sqrt((mm-2*m1*m1)/(1-2*a1*a1))
  ELSE a1*(y1-x1) + a2*(y2-x2) + (mx - m1*(y1-x1) - m2*(y2-x2))
    / sqrt((mm-2*m1*m1-2*m2*m2)/(1-2*a1*a1-2*a2*a2)) END)**2 / ss) AS w FROM shapiro_weights"""
_size = "ln(n)"
_large = (f"((ln(1-w) - {poly(tails.R94_LARGE_MEAN, _size)})"
          f" / exp({poly(tails.R94_LARGE_LOG_SD, _size)}))")
_bound = poly(tails.R94_SMALL_BOUND, "n")
_small = (f"((-ln({_bound}-ln(1-w)) - {poly(tails.R94_SMALL_MEAN, 'n')})"
          f" / exp({poly(tails.R94_SMALL_LOG_SD, 'n')}))")
CTES["shapiro_z"] = f"""
SELECT *, CASE WHEN w >= 1 OR n = 3 THEN NULL WHEN n <= 11
  THEN CASE WHEN ln(1-w) >= {_bound} THEN 1e9 ELSE {_small} END ELSE {_large} END AS z FROM shapiro_w"""
CTES["shapiro_p"] = f"""
SELECT *, CASE WHEN w >= 1 THEN 1.0 WHEN n = 3
  THEN greatest(0.0, 6/pi()*(asin(sqrt(w)) - asin(sqrt(0.75)))) WHEN z > 40 THEN 0.0
  ELSE {normal_tail('z')} END AS p FROM shapiro_z"""
CTES["shapiro_all"] = """
SELECT s.PAIR, s.LABEL, s.TEST_NAME, w AS statistic, p, CASE WHEN p < 0.05 THEN 0 ELSE 1 END AS outcome
FROM shapiro_sums s LEFT JOIN shapiro_p q ON s.PAIR = q.PAIR AND s.LABEL = q.LABEL AND s.TEST_NAME = q.TEST_NAME"""
CTES["t_stats"] = """
SELECT PAIR, TEST_NAME, n0+n1-2 AS v, (m0-m1)/nullif(sqrt((n0*v0+n1*v1)/nullif(n0+n1-2, 0)*(1/n0+1/n1)), 0) AS t
FROM (SELECT PAIR, TEST_NAME, CAST(count(*) FILTER (LABEL = 0) AS DOUBLE) AS n0,
    CAST(count(*) FILTER (LABEL = 1) AS DOUBLE) AS n1,
    avg(TEST_RESULT_REF) FILTER (LABEL = 0) AS m0, avg(TEST_RESULT_REF) FILTER (LABEL = 1) AS m1,
    var_pop(TEST_RESULT_REF) FILTER (LABEL = 0) AS v0, var_pop(TEST_RESULT_REF) FILTER (LABEL = 1) AS v1
  FROM pairs GROUP BY ALL) WHERE n0 > 0 AND n1 > 0"""
CTES["t_p"] = f"SELECT PAIR, TEST_NAME, t AS statistic, {student_tail('t', 'v')} AS p FROM t_stats"
FINALS["mann_whitney"] = f"""SELECT 'mannwhitneyu' AS statistic_test, TEST_NAME, {r6('statistic', 'statistic')},
  {r6('p', 'pvalue')} FROM rank_p WHERE {MAIN_PAIR}"""
FINALS["mann_whitney_methods"] = " UNION ALL ".join(
    f"SELECT '{m}' AS method, * FROM ({FINALS['mann_whitney']})" for m in ("auto", "asymptotic")
)
FINALS["shapiro_wilk"] = f"""SELECT LABEL, TEST_NAME, {r6('statistic', 'statistic')}, {r6('p', 'pvalue')}
FROM shapiro_all WHERE {MAIN_PAIR}"""
FINALS["t_test"] = f"""SELECT 'ttest_ind' AS statistic_test, TEST_NAME, {r6('statistic', 'statistic')},
  {r6('p', 'pvalue')} FROM t_p WHERE {MAIN_PAIR}"""
FINALS["normality_flag"] = f"""SELECT LABEL, TEST_NAME, outcome AS shapiro_outcome,
  min(outcome) OVER (PARTITION BY TEST_NAME) AS shapiro FROM shapiro_all WHERE {MAIN_PAIR}"""
FINALS["significance_select"] = f"""SELECT PAIR, statistic_test, TEST_NAME, {r6('statistic', 'statistic')},
  {r6('p', 'pvalue')}, shapiro, CAST(p < 0.05 AS INT) AS significance_outcome
FROM (SELECT 'mannwhitneyu' AS statistic_test, * FROM rank_p UNION ALL SELECT 'ttest_ind', * FROM t_p)
JOIN (SELECT PAIR, TEST_NAME, min(outcome) AS shapiro FROM shapiro_all GROUP BY ALL) USING (PAIR, TEST_NAME)
WHERE statistic_test = CASE WHEN shapiro = 1 THEN 'ttest_ind' ELSE 'mannwhitneyu' END"""

FINALS["significance_select_balanced"] = FINALS["significance_select"].replace("FROM rank_p", "FROM balanced_rank_p")

# --- finals: dimension tables ---------------------------------------------------------

FINALS["build_crosswalk"] = """SELECT concat('9', lpad(CAST(p_partkey % 700 AS VARCHAR), 3, '0')) AS ICD9,
  concat('C', lpad(CAST(p_partkey % 701 AS VARCHAR), 3, '0')) AS ICD10 FROM part WHERE p_size % 4 <> 0
QUALIFY row_number() OVER (PARTITION BY p_partkey % 700 ORDER BY p_partkey DESC) = 1"""
FINALS["build_descriptions"] = """SELECT concat('C', lpad(CAST(p_partkey % 300 AS VARCHAR), 3, '0')) AS ICD10,
  p_name AS description FROM part
QUALIFY row_number() OVER (PARTITION BY p_partkey % 300 ORDER BY p_partkey DESC) = 1"""
PART_CODE = "concat('C', lpad(CAST(p_partkey AS VARCHAR), 12, '0'))"
PART_TERM = "concat('term_', CAST(p_partkey // 10 AS VARCHAR))"
PART_CATEGORY = "concat('cat_', CAST(p_partkey // 50 AS VARCHAR))"
FINALS["build_code_conf"] = f"""SELECT {PART_CODE} AS code, 'ICD10' AS code_type,
  {PART_TERM} AS medical_term, {PART_CATEGORY} AS algorithm_category,
  CASE WHEN p_size % 2 = 0 THEN 'ALGORITHM_BLOCK_A' ELSE 'ALGORITHM_BLOCK_B' END AS algorithm_block,
  'Diagnosis of' AS goal_status FROM part"""
FINALS["build_lab_conf"] = """SELECT concat('test', CAST(p_partkey // 4 AS VARCHAR)) AS test_name,
  concat('term', CAST(p_partkey // 4 AS VARCHAR)) AS medical_term, 'cat' AS algorithm_category,
  'ALGORITHM_BLOCK_A' AS algorithm_block, 'mg/dL' AS main_unit, CAST(NULL AS DOUBLE) AS lower_limit,
  CAST(49 AS DOUBLE) AS upper_limit, CAST(12 AS DOUBLE) AS max_timespan, 2 AS min_values,
  CAST(count(*) AS INT) AS N_THRESHOLDS, string_agg(CAST(p_partkey AS VARCHAR), ',' ORDER BY p_partkey) AS SEQS,
  string_agg(CAST(p_size AS VARCHAR), ',' ORDER BY p_partkey) AS VALUES FROM part GROUP BY p_partkey // 4"""
FINALS["build_hierarchy"] = f"""SELECT 'category' AS level, {PART_CATEGORY} AS parent,
  string_agg(DISTINCT {PART_TERM}, ',' ORDER BY {PART_TERM}) AS children FROM part GROUP BY ALL UNION ALL
SELECT 'term', {PART_TERM}, string_agg({PART_CODE}, ',' ORDER BY p_partkey) FROM part GROUP BY ALL"""
FINALS["explode_groups"] = """SELECT code, p_brand AS LSD_GROUP FROM (
  SELECT p_partkey, p_brand, concat('C', CAST(p_partkey % 500 AS VARCHAR)) AS code FROM part UNION ALL
  SELECT p_partkey, p_brand, concat('D', CAST(p_partkey % 300 AS VARCHAR)) FROM part)
QUALIFY row_number() OVER (PARTITION BY code ORDER BY p_partkey DESC) = 1"""


# --- assembly ------------------------------------------------------------------------

_NAMES = {name: re.compile(rf"(?<![\w.'])\b{name}\b(?!['(])") for name in CTES}


def _needed(text: str, found: dict[str, str]) -> None:
    """Collect the CTEs a text refers to, each after its own."""
    for name, pattern in _NAMES.items():
        if name not in found and pattern.search(text) and CTES[name] is not text:
            _needed(CTES[name], found)
            found.setdefault(name, CTES[name])


def statement(final: str) -> str:
    found: dict[str, str] = {}
    _needed(final, found)
    if not found:
        return final
    ctes = ",\n".join(f"{name} AS ({body})" for name, body in found.items())
    return f"WITH {ctes}\n{final}"


def expected_sql() -> dict[str, str]:
    return {name: statement(final) for name, final in FINALS.items()}
