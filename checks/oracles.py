"""SQL for DuckDB that has to give the results of the registered queries.

The statements are written from the meaning of each query, not from its Spark plan.
"""

from __future__ import annotations

from checks import fixtures as fx
from lendspark.constants import (
    BAD_STATUSES,
    CATEGORICAL_FEATURES,
    LOAN_COLUMNS,
    LOAN_SCHEMA,
    NUMERIC_FEATURES,
    PAID_STATUSES,
    PREPARED_COLUMNS,
    SEED,
    STORED_NUMERIC_FEATURES,
)


def _quoted(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


BAD = f"({_quoted(BAD_STATUSES)})"
PAID = f"({_quoted(PAID_STATUSES)})"
SETTLED = f"({_quoted(PAID_STATUSES + BAD_STATUSES)})"
DEFAULTED = f"count(*) FILTER (WHERE loan_status IN {BAD})"
RATE = f"round({DEFAULTED} / count(*) * 100, 2) AS default_rate"
BLANKS = r"E' \t\n\r\x0b\x0c'"

# --- common table expressions --------------------------------------------------

LOANS = fx.LOANS.format(orders="orders", customer="customer")

PREPARED = f"""
SELECT {", ".join(c for c in PREPARED_COLUMNS if c != "label" and c in LOAN_COLUMNS)},
  CASE WHEN loan_status = 'Charged Off' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label,
  CAST(year(issue_d) AS INTEGER) AS issue_year,
  CAST(month(issue_d) AS INTEGER) AS issue_month,
  sin(2 * pi() * month(issue_d) / 12) AS issue_month_sin,
  cos(2 * pi() * month(issue_d) / 12) AS issue_month_cos,
  CAST(12 * (year(issue_d) - year(earliest_cr_line))
    + month(issue_d) - month(earliest_cr_line) AS DOUBLE) AS credit_history_months,
  CASE WHEN issue_d < DATE '{fx.FIXTURE_CUTOFF}' THEN 'train' ELSE 'test' END AS side
FROM loans WHERE loan_status IN ('Fully Paid', 'Charged Off')
"""

FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES


def _mode(column: str) -> str:
    return (
        f"(SELECT {column} FROM (SELECT {column}, count(*) AS n FROM prepared"
        f" WHERE side = 'train' AND {column} IS NOT NULL GROUP BY 1) g"
        f" ORDER BY n DESC, {column} LIMIT 1)"
    )


FILLED = f"""
SELECT id, loan_status, label, issue_d, side,
  {", ".join(f"coalesce({c}, {_mode(c)}) AS {c}" for c in FEATURES)}
FROM prepared
"""

# Copies of each training row after balancing.
BALANCED = f"""
SELECT id, label, CASE WHEN label <> minority THEN 1
  ELSE whole + CASE WHEN ((id % 1000003) * 2654435761 + {SEED}) % 1000000
    < (ratio - whole) * 1000000 THEN 1 ELSE 0 END END AS copies
FROM prepared CROSS JOIN (
  SELECT *, CAST(floor(ratio) AS BIGINT) AS whole FROM (
    SELECT CASE WHEN n0 > n1 THEN 1.0 ELSE 0.0 END AS minority,
      greatest(n0, n1)::DOUBLE / least(n0, n1)::DOUBLE AS ratio
    FROM (SELECT count(*) FILTER (WHERE label = 0) AS n0,
      count(*) FILTER (WHERE label = 1) AS n1 FROM prepared WHERE side = 'train') c) r) s
WHERE side = 'train'
"""

RATIO = """
SELECT CASE WHEN n0 > n1 THEN 1.0 ELSE 0.0 END AS minority,
  greatest(n0, n1)::DOUBLE / least(n0, n1)::DOUBLE AS mean
FROM (SELECT count(*) FILTER (WHERE label = 0) AS n0, count(*) FILTER (WHERE label = 1) AS n1
  FROM prepared WHERE side = 'train') c
"""
# The Poisson distribution function.
STEPS = """
SELECT k, sum(exp(k * ln(mean) - mean - lgamma(k + 1))) OVER (ORDER BY k) AS reached
FROM ratio, range(0, 100) AS t(k)
"""


def _codes() -> str:
    """Slot of every category in the feature vector: by frequency, then by name."""
    parts = []
    for position, column in enumerate(CATEGORICAL_FEATURES):
        parts.append(
            f"SELECT {position} AS pos, '{column}' AS feature, {column} AS value,"
            f" row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS code"
            f" FROM filled WHERE side = 'train' GROUP BY {column}"
        )
    return f"""
SELECT feature, value, (row_number() OVER (ORDER BY pos, code)) - 1 AS slot
FROM ({" UNION ALL ".join(parts)}) c
"""


# The number of slots, then the sums over categories and over numbers.
def _vectors() -> str:
    joins, known, slots = [], [], []
    for column in CATEGORICAL_FEATURES:
        joins.append(
            f"LEFT JOIN codes c_{column} ON c_{column}.feature = '{column}'"
            f" AND c_{column}.value = f.{column}"
        )
        known.append(f"CASE WHEN c_{column}.slot IS NULL THEN 0 ELSE 1 END")
        slots.append(f"coalesce(c_{column}.slot, 0)")
    nonzero = [f"CASE WHEN {c} <> 0 THEN 1 ELSE 0 END" for c in NUMERIC_FEATURES]
    places = [
        f"CASE WHEN {c} <> 0 THEN w.categories + {i} ELSE 0 END"
        for i, c in enumerate(NUMERIC_FEATURES)
    ]
    return f"""
SELECT id, label, side,
  CAST(w.categories + {len(NUMERIC_FEATURES)} AS INTEGER) AS width,
  CAST({" + ".join(known + nonzero)} AS INTEGER) AS nonzero,
  CAST({" + ".join(slots + places)} AS BIGINT) AS places,
  round({" + ".join(known)} + {" + ".join(NUMERIC_FEATURES)}, 4) AS total
FROM filled f CROSS JOIN (SELECT count(*) AS categories FROM codes) w
{" ".join(joins)}
"""


CTES = {
    "loans": LOANS,
    "raw": fx.LOANS_RAW.format(loans="loans"),
    "broken": fx.LOANS_BROKEN.format(loans="loans"),
    "scores": fx.SCORES.format(loans="loans"),
    "prepared": PREPARED,
    "filled": FILLED,
    "balanced": BALANCED,
    "ratio": RATIO,
    "steps": STEPS,
    "codes": _codes(),
    "vectors": _vectors(),
}


def over(select: str, *names: str) -> str:
    """``select`` below the definitions of ``loans`` and of the named expressions."""
    wanted = ["loans", *names]
    ctes = ", ".join(f"{name} AS ({body})" for name, body in CTES.items() if name in wanted)
    return f"WITH {ctes} {select}"


ORACLES: dict[str, str] = {}

# --- reports -------------------------------------------------------------------

ORACLES["q1_grade"] = over(
    f"""SELECT grade, count(*) AS total_loans, {DEFAULTED} AS defaulted,
  count(*) FILTER (WHERE loan_status IN {PAID}) AS fully_paid, {RATE},
  round(avg(int_rate), 2) AS avg_int_rate
FROM loans WHERE loan_status IN {SETTLED} GROUP BY grade"""
)
ORACLES["q2_purpose"] = over(
    f"""SELECT purpose, count(*) AS total_loans, {DEFAULTED} AS defaulted, {RATE},
  round(avg(loan_amnt), 2) AS avg_loan_amnt
FROM loans WHERE loan_status IN {SETTLED} GROUP BY purpose"""
)
ORACLES["q3_issue_year"] = over(
    f"""SELECT CAST(year(issue_d) AS INTEGER) AS issue_year, count(*) AS total_loans,
  {DEFAULTED} AS defaulted, {RATE}, round(avg(int_rate), 2) AS avg_int_rate
FROM loans WHERE loan_status IN {SETTLED} GROUP BY 1"""
)
ORACLES["q4_dti"] = over(
    f"""SELECT CASE WHEN dti < 10 THEN '00-10' WHEN dti < 20 THEN '10-20'
    WHEN dti < 30 THEN '20-30' WHEN dti < 40 THEN '30-40' ELSE '40+' END AS dti_bucket,
  count(*) AS total_loans, {DEFAULTED} AS defaulted, {RATE},
  round(avg(int_rate), 2) AS avg_int_rate
FROM loans WHERE loan_status IN {SETTLED} AND dti >= 0 AND dti <= 100 GROUP BY 1"""
)
ORACLES["q5_grade_ownership"] = over(
    f"""SELECT grade, home_ownership, count(*) AS total_loans, {RATE}
FROM loans WHERE loan_status IN {SETTLED}
  AND home_ownership IN ('RENT', 'OWN', 'MORTGAGE') GROUP BY 1, 2"""
)
FICO = """CASE WHEN fico_range_low < 650 THEN '610-650' WHEN fico_range_low < 675 THEN '650-675'
    WHEN fico_range_low < 700 THEN '675-700' WHEN fico_range_low < 725 THEN '700-725'
    WHEN fico_range_low < 750 THEN '725-750' ELSE '750+' END"""
ORACLES["q6_fico"] = over(
    f"""SELECT {FICO} AS fico_bucket,
  round(avg((fico_range_low + fico_range_high) / CAST(2.0 AS DOUBLE)), 1) AS avg_fico,
  count(*) AS total_loans, {RATE}
FROM loans WHERE loan_status IN {SETTLED} GROUP BY 1"""
)

ORACLES["dq_null_profile"] = over(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count,"
        f" count(*) AS total_rows,"
        f" round((count(*) - count({c})) / count(*) * 100, 4) AS null_pct FROM loans"
        for c in LOAN_COLUMNS
    )
)
ORACLES["dq_status_distribution"] = over(
    """SELECT loan_status, n AS count, round(100 * n / sum(n) OVER (), 4) AS share_pct
FROM (SELECT coalesce(loan_status, 'NULL') AS loan_status, count(*) AS n FROM loans GROUP BY 1) g"""
)
ORACLES["status_share_crossjoin"] = ORACLES["dq_status_distribution"]
ORACLES["dq_binary_target"] = over(
    """SELECT CAST(CASE WHEN loan_status = 'Charged Off' THEN 1 ELSE 0 END AS INTEGER) AS label,
  loan_status, count(*) AS count,
  round(count(*) / (SELECT count(*) FROM loans
    WHERE loan_status IN ('Fully Paid', 'Charged Off')) * 100, 4) AS share_pct
FROM loans WHERE loan_status IN ('Fully Paid', 'Charged Off') GROUP BY 1, 2"""
)


def value_count_sql(table: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, coalesce(CAST({c} AS VARCHAR), 'NULL') AS value,"
        f" count(*) AS count,"
        f" round(count(*) / (SELECT count(*) FROM {table}) * 100, 4) AS share_pct"
        f" FROM {table} GROUP BY 1, 2"
        for c in columns
    )


def numeric_summary_sql(table: str, columns, digits: int = 6) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count({c}) AS non_null_count,"
        f" count(*) - count({c}) AS null_count, CAST(min({c}) AS DOUBLE) AS min_value,"
        f" CAST(quantile_disc({c}, 0.25) AS DOUBLE) AS p25,"
        f" CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS median,"
        f" CAST(quantile_disc({c}, 0.75) AS DOUBLE) AS p75,"
        f" CAST(quantile_disc({c}, 0.95) AS DOUBLE) AS p95,"
        f" CAST(max({c}) AS DOUBLE) AS max_value, round(avg({c}), {digits}) AS avg_value,"
        f" round(stddev_pop({c}), {digits}) AS stddev_value FROM {table}"
        for c in columns
    )


ORACLES["dq_categorical_counts"] = over(value_count_sql("loans", CATEGORICAL_FEATURES))
ORACLES["incremental_counts"] = ORACLES["dq_categorical_counts"]
ORACLES["dq_numeric_summary"] = over(numeric_summary_sql("loans", STORED_NUMERIC_FEATURES))
ORACLES["lineitem_value_counts"] = value_count_sql(
    "lineitem", ["l_returnflag", "l_linestatus", "l_linenumber"]
)
ORACLES["lineitem_numeric_summary"] = numeric_summary_sql(
    "lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], digits=8
)

BUCKET_CASES = {
    "loan_amnt": """CASE WHEN loan_amnt IS NULL THEN 'NULL' WHEN loan_amnt < 5000 THEN '00000-05000'
    WHEN loan_amnt < 10000 THEN '05000-10000' WHEN loan_amnt < 15000 THEN '10000-15000'
    WHEN loan_amnt < 20000 THEN '15000-20000' WHEN loan_amnt < 30000 THEN '20000-30000'
    ELSE '30000+' END""",
    "annual_inc": """CASE WHEN annual_inc IS NULL THEN 'NULL'
    WHEN annual_inc < 25000 THEN '000000-025000' WHEN annual_inc < 50000 THEN '025000-050000'
    WHEN annual_inc < 75000 THEN '050000-075000' WHEN annual_inc < 100000 THEN '075000-100000'
    WHEN annual_inc < 150000 THEN '100000-150000' ELSE '150000+' END""",
    "dti": """CASE WHEN dti IS NULL THEN 'NULL' WHEN dti < 0 THEN '<0' WHEN dti < 10 THEN '00-10'
    WHEN dti < 20 THEN '10-20' WHEN dti < 30 THEN '20-30' WHEN dti < 40 THEN '30-40'
    WHEN dti <= 100 THEN '40-100' ELSE '100+' END""",
    "int_rate": """CASE WHEN int_rate IS NULL THEN 'NULL' WHEN int_rate < 5 THEN '00-05'
    WHEN int_rate < 10 THEN '05-10' WHEN int_rate < 15 THEN '10-15' WHEN int_rate < 20 THEN '15-20'
    WHEN int_rate < 25 THEN '20-25' ELSE '25+' END""",
    "revol_util": """CASE WHEN revol_util IS NULL THEN 'NULL' WHEN revol_util < 0 THEN '<0'
    WHEN revol_util < 20 THEN '000-020' WHEN revol_util < 40 THEN '020-040'
    WHEN revol_util < 60 THEN '040-060' WHEN revol_util < 80 THEN '060-080'
    WHEN revol_util <= 100 THEN '080-100' ELSE '100+' END""",
    "fico_range_low": f"CASE WHEN fico_range_low IS NULL THEN 'NULL' ELSE {FICO} END",
}
ORACLES["dq_numeric_distributions"] = over(
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {case} AS bucket, count(*) AS count,"
        f" round(count(*) / (SELECT count(*) FROM loans) * 100, 4) AS share_pct"
        f" FROM loans GROUP BY 1, 2"
        for c, case in BUCKET_CASES.items()
    )
)

ORACLES["record_count"] = over("SELECT count(*) AS total_rows FROM loans")
ORACLES["analyze_stats"] = ORACLES["record_count"]
ORACLES["schema_catalog"] = " UNION ALL ".join(
    f"SELECT '{f.name}' AS name, '{f.dataType.simpleString()}' AS type, TRUE AS nullable"
    for f in LOAN_SCHEMA
)

DATES_AS_TEXT = (
    "* REPLACE (CAST(issue_d AS VARCHAR) AS issue_d,"
    " CAST(earliest_cr_line AS VARCHAR) AS earliest_cr_line)"
)
ALL_LOANS = over(f"SELECT {DATES_AS_TEXT} FROM loans")
ORACLES["sample_rows"] = over(f"SELECT {DATES_AS_TEXT} FROM loans ORDER BY id LIMIT 10")
for name in ("restore_dates", "typed_csv_load", "snapshot_range", "curated_partitioned", "published_versions"):
    ORACLES[name] = ALL_LOANS

# --- cleaning ------------------------------------------------------------------


def _stripped(column: str) -> str:
    return f"trim({column}, {BLANKS})"


def _number(column: str) -> str:
    value = f"try_cast(trim(replace({column}, '%', ''), {BLANKS}) AS DOUBLE)"
    return f"(CASE WHEN isfinite({value}) THEN {value} END)"


def _whole(column: str, kind: str = "BIGINT") -> str:
    return f"CAST(trunc(try_cast({_stripped(column)} AS DOUBLE)) AS {kind})"


def _month(column: str) -> str:
    return f"CAST(try_strptime({_stripped(column)}, '%b-%Y') AS DATE)"


def _field(field) -> str:
    kind = field.dataType.simpleString()
    if field.name == "term":
        return r"try_cast(regexp_replace(term, '\D', '', 'g') AS INTEGER)"
    if kind in ("int", "bigint"):
        return _whole(field.name, "INTEGER" if kind == "int" else "BIGINT")
    if kind == "double":
        return _number(field.name)
    if kind == "date":
        return _month(field.name)
    return f"nullif({_stripped(field.name)}, '')"


def _unreadable(column: str) -> str:
    return f"(coalesce({_stripped(column)}, '') <> '' AND {_month(column)} IS NULL)"


BAD_ID = f"{_whole('id')} IS NULL"
BAD_DATE = f"({_unreadable('issue_d')} OR {_unreadable('earliest_cr_line')})"
FIELD = {f.name: _field(f) for f in LOAN_SCHEMA}

ORACLES["clean_loans"] = over(
    f"""SELECT {DATES_AS_TEXT} FROM (
  SELECT {", ".join(f"{sql} AS {name}" for name, sql in FIELD.items())}
  FROM raw WHERE NOT ({BAD_ID}) AND NOT {BAD_DATE}) t""",
    "raw",
)
ORACLES["clean_report"] = over(
    f"""SELECT count(*) FILTER (WHERE NOT ({BAD_ID}) AND NOT {BAD_DATE}) AS rows_written,
  count(*) FILTER (WHERE {BAD_ID}) AS skipped_id,
  count(*) FILTER (WHERE NOT ({BAD_ID}) AND {BAD_DATE}) AS skipped_dates FROM raw""",
    "raw",
)

ORACLES["unreadable_values"] = over(
    " UNION ALL ".join(
        f"SELECT '{name}' AS column_name,"
        f" count(*) FILTER (WHERE {_stripped(name)} <> '' AND {sql} IS NULL) AS unreadable"
        " FROM raw"
        for name, sql in FIELD.items()
    ),
    "raw",
)


def _raw_fields(*names: str) -> str:
    fields = []
    for name in names:
        sql = FIELD[name]
        if name in ("issue_d", "earliest_cr_line"):
            sql = f"CAST({sql} AS VARCHAR)"
        fields.append(f"{sql} AS {name}")
    return over(f"SELECT nullif(id, '') AS raw_id, {', '.join(fields)} FROM raw", "raw")


ORACLES["parse_term"] = _raw_fields("term")
ORACLES["parse_mon_year"] = _raw_fields("issue_d", "earliest_cr_line")
ORACLES["clean_numeric"] = _raw_fields("int_rate", "revol_util", "annual_inc")
ORACLES["clean_text"] = _raw_fields("grade", "home_ownership", "emp_length")
ORACLES["to_int"] = over(
    f"""SELECT nullif(id, '') AS raw_id, {FIELD["id"]} AS id, {FIELD["delinq_2yrs"]} AS delinq_2yrs,
  {FIELD["revol_bal"]} AS revol_bal,
  CAST(trunc(try_cast(replace(revol_util, '%', '') AS DOUBLE)) AS BIGINT) AS util_floor
FROM raw""",
    "raw",
)

ORACLES["epoch_ms_dates"] = over(
    """SELECT id, CAST(CAST(make_timestamp(epoch_ms(CAST(issue_d AS TIMESTAMP)) * 1000) AS DATE)
    AS VARCHAR) AS issue_d,
  CAST(CAST(make_timestamp(epoch_ms(CAST(earliest_cr_line AS TIMESTAMP)) * 1000) AS DATE)
    AS VARCHAR) AS earliest_cr_line
FROM loans"""
)

ORACLES["key_violations"] = over(
    """SELECT CAST(coalesce(sum(n) FILTER (WHERE id IS NULL), 0) AS BIGINT) AS null_keys,
  count(*) FILTER (WHERE id IS NOT NULL AND n > 1) AS repeated_keys,
  CAST(coalesce(sum(n - 1) FILTER (WHERE id IS NOT NULL), 0) AS BIGINT) AS surplus_rows
FROM (SELECT id, count(*) AS n FROM broken GROUP BY id) k""",
    "broken",
)

# A rule is broken if one of its parts is known to be.
BROKEN_RULES = {
    "nonnegative_counts": "delinq_2yrs < 0 OR inq_last_6mths < 0 OR open_acc < 0"
    " OR pub_rec < 0 OR total_acc < 0",
    "fico_order": "fico_range_low > fico_range_high",
    "term_positive": "term <= 0",
    "revol_bal_nonnegative": "revol_bal < 0",
    "numeric_domains": "loan_amnt <= 0 OR installment < 0 OR annual_inc < 0 OR int_rate < 0"
    " OR int_rate > 100 OR revol_util < 0 OR dti < -1 OR dti >= 1e7",
}
ORACLES["rule_violations"] = over(
    " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, count(*) FILTER (WHERE {broken}) AS violations FROM broken"
        for rule, broken in BROKEN_RULES.items()
    ),
    "broken",
)
_ANY_BROKEN = " OR ".join(f"coalesce({broken}, false)" for broken in BROKEN_RULES.values())
ORACLES["quarantine"] = over(
    f"""SELECT id, concat_ws(',', {", ".join(
        f"CASE WHEN {broken} THEN '{rule}' END" for rule, broken in BROKEN_RULES.items()
    )}) AS violated FROM broken WHERE {_ANY_BROKEN}""",
    "broken",
)
ORACLES["accepted_rows"] = over(
    f"SELECT id, loan_amnt, term FROM broken WHERE NOT ({_ANY_BROKEN})", "broken"
)

# --- sources and sinks ---------------------------------------------------------

ORACLES["csv_roundtrip"] = over(
    f"""SELECT {", ".join(f"nullif({c}, '') AS {c}" for c in LOAN_COLUMNS)} FROM raw""", "raw"
)
ORACLES["parquet_roundtrip"] = over(
    """SELECT * REPLACE (epoch_ms(CAST(issue_d AS TIMESTAMP)) AS issue_d,
  epoch_ms(CAST(earliest_cr_line AS TIMESTAMP)) AS earliest_cr_line) FROM loans"""
)
ORACLES["table_or_path"] = over(
    """SELECT source, count(*) AS total_rows, sum(loan_amnt) AS loan_amnt
FROM loans CROSS JOIN (VALUES ('table'), ('path')) s(source) GROUP BY source"""
)
ORACLES["orc_publish"] = ORACLES["q1_grade"]
ORACLES["published_reports"] = " UNION ALL ".join(
    f"""SELECT '{report}' AS report, count(*) AS n_rows, CAST(sum({count}) AS BIGINT) AS counted,
  round(sum({value}), 6) AS total FROM ({ORACLES[name]}) r"""
    for report, (name, count, value) in fx.PUBLISHED.items()
)
TYPED = f"""SELECT {", ".join(f"{sql} AS {name}" for name, sql in FIELD.items())},
  CASE WHEN {BAD_ID} THEN 'id' WHEN {BAD_DATE} THEN 'date' END AS rejected FROM raw"""
INGESTED = f"""SELECT id, loan_amnt, coalesce(rejected, nullif(concat_ws(',', {", ".join(
    f"CASE WHEN {broken} THEN '{rule}' END" for rule, broken in BROKEN_RULES.items()
)}), '')) AS reason FROM ({TYPED}) t"""
ORACLES["ingest_flow"] = over(
    f"""SELECT coalesce(reason, 'kept') AS reason, count(*) AS counted, count(*) AS stored,
  CAST(sum(id) AS BIGINT) AS ids, sum(loan_amnt) AS loan_amnt FROM ({INGESTED}) i GROUP BY 1""",
    "raw",
)
ORACLES["enforced_rules"] = over(
    f"""SELECT * FROM ({" UNION ALL ".join(
        f"SELECT '{rule}' AS rule, count(*) FILTER (WHERE {broken}) AS violations FROM broken"
        for rule, broken in BROKEN_RULES.items()
    )}
  UNION ALL SELECT 'id_not_null', count(*) FILTER (WHERE id IS NULL) FROM broken
  UNION ALL SELECT 'id_unique', count(id) - count(DISTINCT id) FROM broken) v
WHERE violations > 0""",
    "broken",
)
ORACLES["csv_export"] = ORACLES["q5_grade_ownership"]

# --- preparation ---------------------------------------------------------------

ORACLES["datetime_features"] = over(
    """SELECT id, CAST(year(issue_d) AS INTEGER) AS issue_year,
  CAST(month(issue_d) AS INTEGER) AS issue_month,
  round(sin(2 * pi() * month(issue_d) / 12), 9) AS issue_month_sin,
  round(cos(2 * pi() * month(issue_d) / 12), 9) AS issue_month_cos,
  CAST(12 * (year(issue_d) - year(earliest_cr_line))
    + month(issue_d) - month(earliest_cr_line) AS DOUBLE) AS credit_history_months
FROM loans"""
)
ISSUE_AS_TEXT = (
    "REPLACE (CAST(issue_d AS VARCHAR) AS issue_d,"
    " round(issue_month_sin, 9) AS issue_month_sin, round(issue_month_cos, 9) AS issue_month_cos)"
)
ORACLES["prepare_rows"] = over(
    f"SELECT * EXCLUDE (side) {ISSUE_AS_TEXT} FROM prepared", "prepared"
)
ORACLES["temporal_split"] = over("SELECT id, side FROM prepared", "prepared")


def _mode_row(column: str) -> str:
    if column in CATEGORICAL_FEATURES:
        kind = "text"
    elif column in ("issue_year", "issue_month"):
        kind = "whole"
    elif column in STORED_NUMERIC_FEATURES and LOAN_SCHEMA[column].dataType.simpleString() in (
        "int",
        "bigint",
    ):
        kind = "whole"
    else:
        kind = "number"
    fields = {"text": "VARCHAR", "whole": "BIGINT", "number": "DOUBLE"}
    values = ", ".join(
        f"CAST({column if field == kind else 'NULL'} AS {sql}) AS {field}"
        for field, sql in fields.items()
    )
    return (
        f"(SELECT '{column}' AS feature, {values}, count(*) AS n FROM prepared"
        f" WHERE side = 'train' AND {column} IS NOT NULL GROUP BY {column}"
        f" ORDER BY count(*) DESC, {column} LIMIT 1)"
    )


ORACLES["mode_fill_map"] = over(
    f"""SELECT * REPLACE (round(number, 9) AS number)
FROM ({" UNION ALL ".join(map(_mode_row, FEATURES))}) m""",
    "prepared",
)
ORACLES["impute_modes"] = over(
    f"SELECT * {ISSUE_AS_TEXT} FROM filled", "prepared", "filled"
)
ORACLES["balance_train"] = over("SELECT * FROM balanced", "prepared", "balanced")
ORACLES["balance_train_drawn"] = over(
    f"""SELECT * FROM (
  SELECT id, label, CASE WHEN label <> minority THEN 1 ELSE (
    SELECT count(*) FROM steps
    WHERE 1e6 * steps.reached <= ((id % 1000003) * 2654435761 + {SEED}) % 1000000) END AS copies
  FROM prepared CROSS JOIN ratio WHERE side = 'train') t WHERE copies > 0""",
    "prepared",
    "ratio",
    "steps",
)
ORACLES["shuffled_train"] = over(
    """SELECT id, CAST(copy AS INTEGER) AS copy, label
FROM balanced, unnest(range(1, copies + 1)) AS u(copy)""",
    "prepared",
    "balanced",
)
ORACLES["encode_features"] = over(
    "SELECT * EXCLUDE (side) FROM vectors", "prepared", "filled", "codes", "vectors"
)
ORACLES["label_distribution"] = over(
    """SELECT dataset, label, CAST(n AS BIGINT) AS count,
  round(n / sum(n) OVER (PARTITION BY dataset), 9) AS share
FROM (
  SELECT 'full_prepared_raw' AS dataset, label, count(*) AS n FROM prepared GROUP BY label
  UNION ALL SELECT d, label, count(*) FROM prepared CROSS JOIN
    (VALUES ('train_raw'), ('train_encoded_before_balancing')) v(d)
    WHERE side = 'train' GROUP BY d, label
  UNION ALL SELECT d, label, count(*) FROM prepared CROSS JOIN
    (VALUES ('test_raw'), ('test_encoded')) v(d) WHERE side = 'test' GROUP BY d, label
  UNION ALL SELECT 'train_encoded', label, sum(copies) FROM balanced GROUP BY label) t""",
    "prepared",
    "balanced",
)
ORACLES["summary_tables"] = ORACLES["label_distribution"]
ORACLES["split_summary"] = over(
    f"""SELECT dataset, CAST(n AS BIGINT) AS rows,
  CAST((SELECT count(*) FROM codes) + {len(NUMERIC_FEATURES)} AS INTEGER) AS feature_count
FROM (
  SELECT 'train_raw' AS dataset, count(*) AS n FROM prepared WHERE side = 'train'
  UNION ALL SELECT d, count(*) FROM prepared CROSS JOIN
    (VALUES ('test_raw'), ('test_encoded')) v(d) WHERE side = 'test' GROUP BY d
  UNION ALL SELECT 'train_encoded', sum(copies) FROM balanced) t""",
    "prepared",
    "filled",
    "balanced",
    "codes",
)
ORACLES["json_artifact"] = over(
    """SELECT v.side, v.label, CAST(sum(coalesce(copies, 1)) AS BIGINT) AS total_rows,
  CAST(sum(coalesce(copies, 1) * nonzero) AS BIGINT) AS nonzero
FROM vectors v LEFT JOIN balanced b ON v.id = b.id GROUP BY v.side, v.label""",
    "prepared",
    "filled",
    "balanced",
    "codes",
    "vectors",
)

# --- evaluation ----------------------------------------------------------------

CELLS = """SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
  count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
  count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
  count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn FROM scores"""
ORACLES["confusion_counts"] = over(CELLS, "scores")
ORACLES["threshold_metrics"] = over(
    f"""SELECT round((tp + tn) / (tp + tn + fp + fn), 9) AS accuracy,
  round(tp / (tp + fp), 9) AS precision, round(tp / (tp + fn), 9) AS recall,
  round(2 * tp / (2 * tp + fp + fn), 9) AS f1, tp, tn, fp, fn FROM ({CELLS}) c""",
    "scores",
)
AREAS = """SELECT
  round(sum((fpr - prev_fpr) * (tpr + prev_tpr) / 2), 9) AS "areaUnderROC",
  round(sum((tpr - prev_tpr) * (prec + prev_prec) / 2), 9) AS "areaUnderPR"
FROM (
  SELECT *, lag(tpr, 1, 0) OVER o AS prev_tpr, lag(fpr, 1, 0) OVER o AS prev_fpr,
    lag(prec, 1, prec) OVER o AS prev_prec
  FROM (
    SELECT score, tp / all_pos AS tpr, fp / all_neg AS fpr, tp / (tp + fp) AS prec
    FROM (
      SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
        sum(pos) OVER () AS all_pos, sum(neg) OVER () AS all_neg
      FROM (SELECT score, count(*) FILTER (WHERE label = 1) AS pos,
        count(*) FILTER (WHERE label = 0) AS neg FROM scores GROUP BY score) g
      WINDOW w AS (ORDER BY score DESC)) c) r
  WINDOW o AS (ORDER BY score DESC)) p"""
ORACLES["auc_roc_pr"] = over(AREAS, "scores")
ORACLES["prediction_distribution"] = over(
    """SELECT model, label, CAST(prediction AS DOUBLE) AS prediction, count(*) AS count FROM (
  SELECT 'half' AS model, label, prediction FROM scores
  UNION ALL SELECT 'strict', label, CASE WHEN score >= 0.7 THEN 1.0 ELSE 0.0 END
  FROM scores) t GROUP BY 1, 2, 3""",
    "scores",
)
ORACLES["saved_predictions"] = over("SELECT label, prediction FROM scores", "scores")
ORACLES["model_roundtrip"] = over(
    """SELECT count(*) AS total_rows, CAST(0 AS BIGINT) AS changed
FROM prepared WHERE side = 'test'""",
    "prepared",
)

# --- naive Bayes, fitted and applied in SQL ------------------------------------
# Categories are 0/1 slots and stay as they are when scaled to the range 0..1;
# numbers are scaled by the training range and kept from falling below 0.

_CATEGORIES = list(enumerate(CATEGORICAL_FEATURES))
_NUMBERS = list(enumerate(NUMERIC_FEATURES))

CTES["scaled"] = f"""
SELECT f.id, f.label, f.side, coalesce(b.copies, 0) AS copies,
  {", ".join(f"c{i}.slot AS s{i}" for i, _ in _CATEGORIES)},
  {", ".join(
      f"CASE WHEN hi{i} = lo{i} THEN 0.5 ELSE greatest(({c} - lo{i}) / (hi{i} - lo{i}), 0) END AS x{i}"
      for i, c in _NUMBERS
  )}
FROM filled f
LEFT JOIN balanced b ON f.id = b.id
{" ".join(
    f"LEFT JOIN codes c{i} ON c{i}.feature = '{c}' AND c{i}.value = f.{c}" for i, c in _CATEGORIES
)}
CROSS JOIN (SELECT {", ".join(
    f"min({c})::DOUBLE AS lo{i}, max({c})::DOUBLE AS hi{i}" for i, c in _NUMBERS
)} FROM filled WHERE side = 'train') r
"""
CTES["sums"] = f"""
SELECT label, slot, sum(copies * x) AS t FROM (
  {" UNION ALL ".join(
      f"SELECT label, copies, s{i} AS slot, 1.0::DOUBLE AS x FROM scaled WHERE side = 'train'"
      for i, _ in _CATEGORIES
  )}
  UNION ALL {" UNION ALL ".join(
      f"SELECT label, copies, (SELECT count(*) FROM codes) + {i}, x{i}"
      " FROM scaled WHERE side = 'train'"
      for i, _ in _NUMBERS
  )}) e GROUP BY label, slot
"""
CTES["model"] = f"""
SELECT l.label, any_value(prior) AS prior,
  list(ln(coalesce(t, 0) + 1) - ln(total + slots) ORDER BY a.slot) AS theta
FROM (SELECT label, ln(sum(copies) + 1) - ln(sum(sum(copies)) OVER () + 2) AS prior
  FROM balanced GROUP BY label) l
JOIN (SELECT label, sum(t) AS total FROM sums GROUP BY label) n ON l.label = n.label
CROSS JOIN (SELECT unnest(range(0, (SELECT count(*) FROM codes) + {len(_NUMBERS)})) AS slot,
  (SELECT count(*) FROM codes) + {len(_NUMBERS)} AS slots) a
LEFT JOIN sums s ON s.label = l.label AND s.slot = a.slot
GROUP BY l.label
"""


def _joint(alias: str) -> str:
    terms = [f"{alias}.prior"]
    terms += [f"coalesce({alias}.theta[s{i} + 1], 0)" for i, _ in _CATEGORIES]
    terms += [f"{alias}.theta[w.categories + {i + 1}] * x{i}" for i, _ in _NUMBERS]
    return " + ".join(terms)


CTES["nb_scores"] = f"""
SELECT label, joint1 AS score, CASE WHEN joint1 > joint0 THEN 1.0 ELSE 0.0 END AS prediction
FROM (SELECT t.label, {_joint("m0")} AS joint0, {_joint("m1")} AS joint1
  FROM scaled t
  CROSS JOIN (SELECT count(*) AS categories FROM codes) w
  JOIN model m0 ON m0.label = 0 JOIN model m1 ON m1.label = 1
  WHERE t.side = 'test') j
"""
ORACLES["baseline_nb"] = over(
    f"""SELECT 'NaiveBayes' AS model, round((tp + tn) / (tp + tn + fp + fn), 5) AS accuracy,
  round(tp / (tp + fp), 5) AS precision, round(tp / (tp + fn), 5) AS recall,
  round(2 * tp / (2 * tp + fp + fn), 5) AS f1,
  round("areaUnderROC", 5) AS "areaUnderROC", round("areaUnderPR", 5) AS "areaUnderPR",
  tp, tn, fp, fn
FROM ({CELLS.replace("scores", "nb_scores")}) c
CROSS JOIN ({AREAS.replace("FROM scores", "FROM nb_scores")}) a""",
    "prepared",
    "filled",
    "balanced",
    "codes",
    "scaled",
    "sums",
    "model",
    "nb_scores",
)

# Of fitted models: what must hold of any of them, and what follows from the data.
_TEST = "SELECT count(*) AS total_rows, CAST(sum(label) AS BIGINT) AS positives FROM prepared WHERE side = 'test'"


def _consistent(*families: str, combinations: int) -> str:
    kinds = ", ".join(f"('{family}')" for family in families)
    return over(
        f"""SELECT model, total_rows, positives, TRUE AS agrees, {combinations} AS combinations
FROM ({_TEST}) t CROSS JOIN (VALUES {kinds}) m(model)""",
        "prepared",
    )


ORACLES["baseline_rf"] = _consistent("RandomForest", combinations=0)
ORACLES["baseline_svc"] = _consistent("LinearSVC", combinations=0)
ORACLES["tuned_rf"] = _consistent("RandomForest", combinations=27)
ORACLES["tuned_svc"] = _consistent("LinearSVC", combinations=27)
ORACLES["tuned_nb"] = _consistent("NaiveBayes", combinations=27)
ORACLES["model_comparison"] = _consistent("RandomForest", "LinearSVC", "NaiveBayes", combinations=0)
ORACLES["model_prediction_distribution"] = over(
    """SELECT model, label, count(*) AS count FROM prepared
CROSS JOIN (VALUES ('RandomForest'), ('LinearSVC'), ('NaiveBayes')) m(model)
WHERE side = 'test' GROUP BY model, label""",
    "prepared",
)
ORACLES["sample_predictions"] = over(
    """SELECT * EXCLUDE (loan_status, label, side) REPLACE (CAST(issue_d AS VARCHAR) AS issue_d,
    round(issue_month_sin, 9) AS issue_month_sin, round(issue_month_cos, 9) AS issue_month_cos),
  loan_status AS actual_status, label AS actual_label, TRUE AS agrees
FROM prepared WHERE side = 'test' ORDER BY id LIMIT 10""",
    "prepared",
)
ORACLES["joined_outputs"] = over(
    """SELECT id, label, prediction AS m_prediction,
  CASE WHEN prediction = 1 THEN 'Charged Off' ELSE 'Fully Paid' END AS m_predicted_status
FROM scores""",
    "scores",
)
ORACLES["colocated_outputs"] = over(
    """SELECT id, label, CASE WHEN label = 1 THEN prediction END AS m_prediction,
  CASE WHEN label = 1 THEN CASE WHEN prediction = 1 THEN 'Charged Off' ELSE 'Fully Paid' END END
    AS m_predicted_status,
  1 - prediction AS other_prediction,
  CASE WHEN prediction = 0 THEN 'Charged Off' ELSE 'Fully Paid' END AS other_predicted_status
FROM scores""",
    "scores",
)
FEATURE_INFO = " UNION ALL ".join(
    f"SELECT '{name}' AS feature_name, '{kind}' AS feature_type"
    for kind, names in (("numeric", NUMERIC_FEATURES), ("categorical", CATEGORICAL_FEATURES))
    for name in names
)
_EXACT = {
    "split_summary": ("dataset", "rows", ORACLES["split_summary"]),
    "feature_info": ("feature_name", "0", FEATURE_INFO),
    "label_distribution": ("concat(dataset, ' ', CAST(CAST(label AS INTEGER) AS VARCHAR))", "count", ORACLES["label_distribution"]),
    "baseline_evaluation": ("model", "total_rows", ORACLES["model_comparison"]),
    "evaluation": ("model", "total_rows", ORACLES["model_comparison"]),
    "prediction_distribution": (
        "concat(model, ' ', CAST(CAST(label AS INTEGER) AS VARCHAR))",
        "count",
        ORACLES["model_prediction_distribution"],
    ),
}
ORACLES["dashboard_package"] = " UNION ALL ".join(
    f"SELECT '{name}' AS summary, {what} AS item, CAST({number} AS BIGINT) AS counted FROM ({sql}) {name}"
    for name, (what, number, sql) in _EXACT.items()
)
ORACLES["training_build"] = ORACLES["label_distribution"]
ORACLES["training_artifacts"] = over(
    f"""SELECT model, total_rows AS stored, total_rows AS evaluated, CAST(0 AS BIGINT) AS changed
FROM ({_TEST}) t CROSS JOIN (VALUES ('RandomForest'), ('LinearSVC'), ('NaiveBayes')) m(model)""",
    "prepared",
)
