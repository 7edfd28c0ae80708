"""The queries once more as SQL for DuckDB, built from common table expressions.

Nothing is shared with the Spark side but the fixed values and the rules of the
derived table. Comparisons of stages are written as the plain many-to-many joins
they are defined by.
"""

from __future__ import annotations

from txclean.catalogue.derived import (
    CATEGORIES,
    CUTOFF,
    KEYS,
    MERCHANT_VARIANTS,
    swapped_spellings,
)
from txclean.plans import presets


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(map(_text, values)) + "]"


def _title(text: str) -> str:
    return (
        f"coalesce(list_aggregate(list_transform(regexp_extract_all({text}, "
        r"'[\p{L}\p{N}]+|[^\p{L}\p{N}]+'), "
        "lambda p: CASE WHEN p[1] = 'ß' THEN 'ß' ELSE upper(p[1]) END || lower(p[2:])), 'string_agg', ''), " + text + ")"
    )


def _case(text: str) -> str:
    branches = " ".join(
        "WHEN "
        + " OR ".join(f"lower({text}) LIKE '%{word}%'" for word in words)
        + f" THEN {_text(label)}"
        for words, label in presets.CATEGORY_RULES
    )
    return f"CASE {branches} ELSE {text} END"


def _dictionary(spellings) -> str:
    pairs = [(clean, dirty) for clean, dirties in spellings.items() for dirty in dirties]
    return ", ".join(
        f"({i}, {_text(clean)}, {_text(dirty)})" for i, (clean, dirty) in enumerate(pairs, 1)
    )


# Faults of the full table alone: null ids, a shared id, copies that differ.
_FULL_ID = (
    "CASE WHEN k % 1511 = 0 THEN NULL WHEN k % 100 = 7 THEN 'T000000007' ELSE {} END"
)
_FULL_COPY = (
    " REPLACE (CASE WHEN k % 40 = 0 THEN 'Other' ELSE merchant_name END AS merchant_name,"
    " CASE WHEN k % 60 = 0 THEN 'Cash' ELSE category END AS category)"
)
# Columns of the full table from those of the derived one.
_FULL_COLUMNS = (
    "account_id AS AccountId, transaction_id AS TransactionId, 'O' || transaction_id AS TransactionId_OBIE,"
    " booking_datetime AS BookingDateTime, value_datetime AS ValueDateTime, instructed_amount AS InstructedAmount,"
    " transaction_amount AS TransactionAmount, currency AS Currency, original_currency AS OriginalCurrency,"
    " exchange_rate AS ExchangeRate, CASE WHEN instructed_amount < 0 THEN 'Debit' ELSE 'Credit' END AS TransactionType,"
    " CAST(CASE WHEN instructed_amount < 0 THEN 5812 END AS INT) AS MerchantCategoryCode, 'BTC123' AS BankTransactionCode,"
    " 'PBC123' AS ProprietaryBankTransactionCode, 'REF' || transaction_id AS Reference,"
    " CAST(instructed_amount + 1 AS DECIMAL(12,2)) AS Balance, CAST(NULL AS VARCHAR) AS CounterpartyName,"
    " '' AS CounterpartyAccount, 'Booked' AS Status, merchant_name, category"
)


def _cte(spellings, full: bool = False) -> str:
    identity = "'T' || lpad(CAST(CASE WHEN k % 1999 = 1998 THEN k - 1 ELSE k END AS VARCHAR), 9, '0')"
    if full:
        identity = _FULL_ID.format(identity)
    return f"""
WITH lists AS (
  SELECT {_list(MERCHANT_VARIANTS)} AS merchants, {_list(CATEGORIES)} AS categories
), numbered AS (
  SELECT *, o_orderkey AS k,
    merchants[CAST((o_orderkey * 7) % {len(MERCHANT_VARIANTS) + 1} AS INT) + 1] AS m,
    categories[CAST(o_orderkey % {len(CATEGORIES)} AS INT) + 1] AS c,
    CAST(CASE WHEN o_orderkey % 997 = 0 THEN 0
              WHEN o_orderkey % 10 < 3 THEN CAST(o_totalprice AS DECIMAL(12,2))
              ELSE -CAST(o_totalprice AS DECIMAL(12,2)) END AS DECIMAL(12,2)) AS amount
  FROM orders, lists
), single AS (
  SELECT k,
    'A00' || (o_custkey % 3 + 1) AS account_id,
    {identity} AS transaction_id,
    o_orderdate AS booking_datetime,
    CASE WHEN k % 3 = 0 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS value_datetime,
    amount AS instructed_amount,
    CASE WHEN k % 33 <> 0 THEN amount END AS transaction_amount,
    CASE WHEN k % 25 = 0 THEN 'USD' WHEN k % 601 <> 0 THEN 'GBP' END AS currency,
    'GBP' AS original_currency,
    CAST(CASE WHEN k % 25 = 0 AND k % 500 <> 0 THEN 1.25
              WHEN k % 701 = 0 THEN 0.90 END AS DECIMAL(16,2)) AS exchange_rate,
    CASE WHEN k % 5 = 0 THEN ' ' || m || ' ' WHEN k % 7 = 0 THEN lower(m) ELSE m END AS merchant_name,
    CASE WHEN k % 6 = 0 THEN ' ' || upper(c) || ' ' ELSE c END AS category
  FROM numbered
), raw AS (
  SELECT * EXCLUDE (k) FROM single
  UNION ALL
  SELECT * EXCLUDE (k){_FULL_COPY if full else ""} FROM single WHERE k % 20 = 0
), dictionary(id, clean_name, dirty_name) AS (
  VALUES {_dictionary(spellings)}
), trimmed AS (
  SELECT * REPLACE ({_title("trim(merchant_name, ' ')")} AS merchant_name, trim(category, ' ') AS category),
    merchant_name AS raw_merchant, category AS raw_category
  FROM raw
), matches AS (
  SELECT name, id, clean_name, dirty_name, CAST(levenshtein(lower(name), lower(dirty_name)) AS INT) AS distance
  FROM (SELECT DISTINCT merchant_name AS name FROM trimmed WHERE merchant_name IS NOT NULL) n
  JOIN dictionary d
    ON levenshtein(lower(name), lower(dirty_name)) <= 1
   AND abs(length(name) - length(dirty_name)) <= 2
), best AS (
  SELECT name, clean_name FROM matches
  QUALIFY row_number() OVER (PARTITION BY name ORDER BY distance, id) = 1
), traced AS (
  SELECT t.* REPLACE (coalesce(b.clean_name, t.merchant_name) AS merchant_name, {_case("t.category")} AS category)
  FROM trimmed t LEFT JOIN best b ON t.merchant_name = b.name
), staging AS (
  SELECT * EXCLUDE (raw_merchant, raw_category) FROM traced
), numbered_rows AS (
  SELECT *, row_number() OVER (
      PARTITION BY {", ".join(KEYS)}
      ORDER BY transaction_id, merchant_name NULLS FIRST, category NULLS FIRST) AS row_num
  FROM staging
), deduped AS (
  SELECT * EXCLUDE (row_num) FROM numbered_rows WHERE row_num = 1
), filled AS (
  SELECT * REPLACE (coalesce(transaction_amount, instructed_amount) AS transaction_amount) FROM deduped
), final AS (
  SELECT * REPLACE (
    CASE WHEN instructed_amount < 0 AND category = 'Income' THEN 'Income Reversal' ELSE category END AS category)
  FROM filled
)"""


_RATE_RULE = (
    "((currency = original_currency AND exchange_rate IS NULL)"
    " OR (currency <> original_currency AND exchange_rate IS NOT NULL))"
)
_CUT = f"TIMESTAMP '{CUTOFF}'"
_COUNT = "CAST(count(*) AS DECIMAL(38,0))"

# Each rule with the condition under which a row breaks it; `repeats` is the number
# of rows with the same transaction id.
_BROKEN = {
    "not_null(transaction_id)": "transaction_id IS NULL",
    "unique(transaction_id)": "repeats > 1",
    "valid_booking_date": f"NOT (booking_datetime < {_CUT})",
    "valid_value_date": f"NOT (value_datetime < {_CUT})",
    "nonzero_amount": "NOT (instructed_amount <> 0)",
    "exchange_rate_logic": f"NOT {_RATE_RULE}",
}
_FAILED = (
    "concat_ws(';', "
    + ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in _BROKEN.items())
    + ")"
)
_REPEATS = "count(*) OVER (PARTITION BY transaction_id) AS repeats"


def _entries(note, old: str, new: str, source: str, key: str = "transaction_id") -> str:
    """Log entries, equal ones counted."""
    return f"""
SELECT {key} AS transaction_id, {_text(note.column)} AS column_changed,
  {old} AS old_value, {new} AS new_value,
  {_text(note.stage)} AS change_stage, {_text(note.reason)} AS change_reason,
  {_COUNT} AS entries
FROM {source} GROUP BY ALL"""


def _each(note, old: str, new: str, source: str) -> str:
    """Log entries, one row each."""
    return f"""
SELECT transaction_id, {_text(note.column)} AS column_changed,
  {old} AS old_value, {new} AS new_value,
  {_text(note.stage)} AS change_stage, {_text(note.reason)} AS change_reason,
  CAST(1 AS DECIMAL(38,0)) AS entries
FROM {source}"""


def _changed(col: str) -> str:
    return (
        f"(SELECT r.transaction_id, r.{col} AS o, s.{col} AS n FROM raw r"
        " JOIN staging s ON r.transaction_id = s.transaction_id"
        f" WHERE r.{col} IS DISTINCT FROM s.{col})"
    )


_NO_TEXT = "CAST(NULL AS VARCHAR)"
_AUDIT_MERCHANT = _entries(presets.MERCHANT_NOTE, "o", "n", _changed("merchant_name"))
_AUDIT_CATEGORY = _entries(presets.CATEGORY_NOTE, "o", "n", _changed("category"))
_AUDIT_FILLS = _entries(
    presets.FILL_NOTE,
    _NO_TEXT,
    "CAST(n AS VARCHAR)",
    "(SELECT s.transaction_id, f.transaction_amount AS n FROM staging s"
    " JOIN final f ON s.transaction_id = f.transaction_id"
    " WHERE s.transaction_amount IS NULL AND f.transaction_amount IS NOT NULL)",
)
_AUDIT_DUPLICATES = _entries(
    presets.DUPLICATE_NOTE,
    _text(presets.DUPLICATE_OLD),
    _text(presets.DUPLICATE_NEW),
    "(SELECT transaction_id FROM numbered_rows WHERE row_num > 1)",
)
_AUDIT_RATES = _each(
    presets.RATE_NOTE,
    _NO_TEXT,
    "CAST(exchange_rate AS VARCHAR)",
    f"final WHERE {_RATE_RULE}",
)
_AUDIT_DATES = _each(
    presets.DATE_NOTE,
    "CAST(booking_datetime AS VARCHAR)",
    _NO_TEXT,
    f"final WHERE booking_datetime >= {_CUT}",
)
_ROW_CHANGES = [
    _each(presets.MERCHANT_NOTE, "raw_merchant", "merchant_name",
          "traced WHERE raw_merchant IS DISTINCT FROM merchant_name"),
    _each(presets.CATEGORY_NOTE, "raw_category", "category",
          "traced WHERE raw_category IS DISTINCT FROM category"),
    _each(presets.FILL_NOTE, _NO_TEXT, "CAST(instructed_amount AS VARCHAR)",
          "deduped WHERE transaction_amount IS NULL AND instructed_amount IS NOT NULL"),
]
_LOG = " UNION ALL ".join(
    [_AUDIT_MERCHANT, _AUDIT_CATEGORY, _AUDIT_FILLS, _AUDIT_DUPLICATES, _AUDIT_RATES, _AUDIT_DATES]
)
_LINEAGE = " UNION ALL ".join([*_ROW_CHANGES, _AUDIT_DUPLICATES, _AUDIT_RATES, _AUDIT_DATES])


def _factors(col: str, note) -> str:
    """For each id and column with a change its values, and in how many rows of both stages."""
    value = f"CAST({col} AS VARCHAR)"
    return f"""
SELECT transaction_id, {_text(note.column)} AS column_changed, {_text(note.stage)} AS change_stage,
  {_text(note.reason)} AS change_reason, value,
  CASE WHEN rows_before > 0 THEN value END AS old_value, CASE WHEN rows_after > 0 THEN value END AS new_value,
  rows_before, rows_after
FROM (
  SELECT transaction_id, value, CAST(sum(b) AS BIGINT) AS rows_before, CAST(sum(a) AS BIGINT) AS rows_after
  FROM (SELECT transaction_id, {value} AS value, 1 AS b, 0 AS a FROM raw
    UNION ALL SELECT transaction_id, {value}, 0, 1 FROM staging)
  WHERE transaction_id IS NOT NULL GROUP BY ALL)
WINDOW id AS (PARTITION BY transaction_id)
QUALIFY sum(rows_before) OVER id * sum(rows_after) OVER id > sum(rows_before * rows_after) OVER id"""


_FACTORS = " UNION ALL ".join(
    f"SELECT * FROM ({_factors(col, note)})"
    for col, note in (("merchant_name", presets.MERCHANT_NOTE), ("category", presets.CATEGORY_NOTE))
)
_BATCH = (
    f"CASE WHEN change_stage IN ({_text(presets.MERCHANT_NOTE.stage)}, {_text(presets.CATEGORY_NOTE.stage)}) THEN 'names'"
    f" WHEN change_stage IN ({_text(presets.FILL_NOTE.stage)}, {_text(presets.DUPLICATE_NOTE.stage)}) THEN 'rows'"
    " ELSE 'rules' END"
)
_LOG_COLUMNS = ("transaction_id", "column_changed", "old_value", "new_value", "change_stage", "change_reason")
_APPENDED = (
    f"SELECT batch, {', '.join(_LOG_COLUMNS)}, entries, CAST(sum(entries) OVER (ORDER BY"
    " CASE batch WHEN 'names' THEN 1 WHEN 'rows' THEN 2 ELSE 3 END, "
    + ", ".join(f"{c} NULLS FIRST" for c in _LOG_COLUMNS)
    + " ROWS UNBOUNDED PRECEDING) - entries + 1 AS DECIMAL(38,0)) AS log_id"
    f" FROM (SELECT {_BATCH} AS batch, {', '.join(_LOG_COLUMNS)}, CAST(sum(entries) AS DECIMAL(38,0)) AS entries"
    f" FROM ({_LOG}) GROUP BY ALL)"
)


def _summary(log: str) -> str:
    return (
        "SELECT column_changed, change_stage, change_reason,"
        " CAST(sum(entries) AS DECIMAL(38,0)) AS number_of_changes"
        f" FROM ({log}) GROUP BY ALL"
    )


def _sample(limit: str) -> str:
    return (
        "SELECT * FROM orders ORDER BY substr(md5('1|' || o_orderkey), 1, 8), o_orderkey"
        f" LIMIT ({limit})"
    )


_TWENTIETH = "SELECT CAST(round(0.05 * count(*)) AS BIGINT) FROM orders"

_RAW_DATE = """
SELECT event_id, CASE event_id % 7
    WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
    WHEN 1 THEN strftime(ts, '%d/%m/%Y %H:%M')
    WHEN 2 THEN strftime(ts, '%Y/%m/%d %H:%M:%S')
    WHEN 3 THEN strftime(ts, '%d-%m-%Y %H:%M:%S')
    WHEN 4 THEN strftime(ts, '%b %d, %Y %I:%M %p')
    WHEN 5 THEN 'junk' END AS raw_date
FROM events"""


def _rules_in_use() -> str:
    keywords = [(word, label) for words, label in presets.CATEGORY_RULES for word in words]
    rules = ", ".join(
        f"({rank}, {_text(word)}, {_text(label)})" for rank, (word, label) in enumerate(keywords, 1)
    )
    return f"""
SELECT CAST(rank AS INT) AS rank, keyword, label, CAST(count(category) AS BIGINT) AS matched,
  CAST(count(CASE WHEN rank = least AND category IS NOT NULL THEN 1 END) AS BIGINT) AS first
FROM (
  SELECT rank, keyword, label, category, min(rank) OVER (PARTITION BY row_number) AS least
  FROM (VALUES {rules}) AS rules(rank, keyword, label)
  LEFT JOIN (SELECT category, row_number() OVER () AS row_number FROM trimmed)
    ON contains(lower(category), keyword))
GROUP BY ALL"""


_KEY_COLUMNS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey", "n_regionkey"],
    "customer": ["c_custkey", "c_nationkey"],
    "supplier": ["s_suppkey", "s_nationkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey", "o_custkey"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey"],
}
_KEY_PLACES = [(table, col) for table, cols in _KEY_COLUMNS.items() for col in cols]
_INCLUSIONS = " UNION ALL ".join(
    f"SELECT '{a}' AS included, '{b}' AS within, count(DISTINCT {a}) AS \"values\" FROM {t}"
    f" HAVING count(DISTINCT {a}) > 0 AND NOT EXISTS"
    f" (SELECT 1 FROM {t} x WHERE x.{a} IS NOT NULL AND x.{a} NOT IN (SELECT {b} FROM {u} WHERE {b} IS NOT NULL))"
    for t, a in _KEY_PLACES
    for u, b in _KEY_PLACES
    if a != b
)


_NUMBER = "CAST(substr(transaction_id, 2, 9) AS BIGINT)"
_CHANGED_RAW = (
    f"SELECT * REPLACE (CASE WHEN {_NUMBER} % 101 = 0 THEN 'Tseco' ELSE merchant_name END AS merchant_name)"
    f" FROM raw_before WHERE {_NUMBER} % 211 <> 0"
    f" UNION ALL SELECT * FROM raw_before WHERE {_NUMBER} % 307 = 0"
)
_DATES = """
SELECT event_id, 'source ' || (event_id % 3) AS source, CASE
    WHEN event_id % 3 = 0 OR (event_id % 3 = 2 AND day(ts) <= 12) THEN strftime(ts, '%d/%m/%Y %H:%M')
    WHEN event_id % 3 = 1 THEN strftime(ts, '%m/%d/%Y %H:%M')
    ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS raw_date
FROM events"""
_DATES_READ = f"""
SELECT *, CASE WHEN d BETWEEN TIMESTAMP '1990-01-01' AND TIMESTAMP '2039-12-31 23:59:59' THEN d END AS as_day,
  CASE WHEN m BETWEEN TIMESTAMP '1990-01-01' AND TIMESTAMP '2039-12-31 23:59:59' THEN m END AS as_month
FROM (SELECT *, coalesce(try_strptime(raw_date, '%d/%m/%Y %H:%M'), try_strptime(raw_date, '%Y-%m-%d %H:%M:%S')) AS d,
  coalesce(try_strptime(raw_date, '%m/%d/%Y %H:%M'), try_strptime(raw_date, '%Y-%m-%d %H:%M:%S')) AS m FROM ({_DATES}))"""
_DATE_ORDER = f"""
SELECT *, CASE WHEN day_first > 0 AND month_first > 0 THEN 'mixed' WHEN day_first > 0 THEN 'day'
  WHEN month_first > 0 THEN 'month' ELSE 'undecided' END AS "order"
FROM (SELECT source, count(*) AS rows,
  count(CASE WHEN as_day IS NOT NULL AND as_month IS NULL THEN 1 END) AS day_first,
  count(CASE WHEN as_day IS NULL AND as_month IS NOT NULL THEN 1 END) AS month_first,
  count(CASE WHEN as_day <> as_month THEN 1 END) AS either FROM ({_DATES_READ}) GROUP BY ALL)"""


def _over_final(select: str) -> str:
    return select.replace("{final}", f"(SELECT *, {_REPEATS} FROM final)")


def oracle_sql() -> dict[str, str]:
    swapped = _cte(swapped_spellings())
    known = _cte(presets.MERCHANT_SPELLINGS)
    full = _cte(presets.MERCHANT_SPELLINGS, full=True)
    counts = " UNION ALL ".join(
        f"SELECT '{name}' AS rule, "
        + (
            "count(DISTINCT transaction_id)"
            if name.startswith("unique")
            else "count(*)"
        )
        + f" AS violations FROM (SELECT *, {_REPEATS} FROM final) WHERE {cond}"
        for name, cond in _BROKEN.items()
    )
    on_run = {
        "raw_transactions": "SELECT * FROM raw",
        "csv_ingest": "SELECT * FROM raw",
        "relations_written": "SELECT * FROM (SELECT account_id, merchant_name, count(*) AS merchant_rows FROM raw GROUP BY ALL)"
        " JOIN (SELECT account_id, count(*) AS rows FROM raw GROUP BY ALL) USING (account_id)",
        "trim_initcap_merchant": "SELECT transaction_id, merchant_name, category FROM trimmed",
        "classify_category": f"SELECT category, {_case('category')} AS label, count(*) AS rows FROM trimmed GROUP BY ALL",
        "classify_category_by_table": f"SELECT category, {_case('category')} AS label, count(*) AS rows FROM trimmed GROUP BY ALL",
        "category_rules_in_use": _rules_in_use(),
        "merchant_fuzzy_blocked": "SELECT * FROM matches",
        "merchant_fuzzy_match": "SELECT * FROM best",
        "merchant_corrected": "SELECT transaction_id, merchant_name FROM staging",
        "row_numbers": "SELECT * FROM numbered_rows",
        "duplicates_listed": "SELECT * FROM numbered_rows WHERE row_num > 1",
        "deduplicated": "SELECT * FROM deduped",
        "stage_row_counts": " UNION ALL ".join(
            f"SELECT '{stage}' AS stage, count(*) AS rows FROM {stage}"
            for stage in ("raw", "staging", "deduped", "final")
        ),
        "null_fill_amount": "SELECT transaction_id, instructed_amount, transaction_amount FROM filled",
        "income_reversal": "SELECT category, count(*) AS rows FROM final GROUP BY ALL",
        "cleaned_data": "SELECT * FROM final",
        "check_primary_key": "SELECT transaction_id, count(*) AS copies FROM final"
        " WHERE transaction_id IS NOT NULL GROUP BY ALL HAVING count(*) > 1",
        "check_not_null_key": "SELECT * FROM final WHERE transaction_id IS NULL",
        "check_booking_date": f"SELECT * FROM final WHERE {_BROKEN['valid_booking_date']}",
        "check_value_date": f"SELECT * FROM final WHERE {_BROKEN['valid_value_date']}",
        "check_zero_amount": f"SELECT * FROM final WHERE {_BROKEN['nonzero_amount']}",
        "check_exchange_rate": f"SELECT * FROM final WHERE {_BROKEN['exchange_rate_logic']}",
        "check_length_merchant": "SELECT transaction_id, merchant_name FROM staging"
        " WHERE NOT (length(rtrim(merchant_name, ' ')) <= 12)",
        "merchant_null_violations": "SELECT transaction_id, merchant_name FROM final WHERE merchant_name IS NULL",
        "check_currency_codes": "SELECT transaction_id, currency FROM final WHERE NOT (currency IN ('GBP', 'EUR'))",
        "constraint_report": counts,
        "constraints_quarantine": _over_final(
            f"SELECT * FROM (SELECT * EXCLUDE (repeats), {_FAILED} AS failed FROM {{final}}) WHERE failed <> ''"
        ),
        "constraints_valid": _over_final(
            f"SELECT * EXCLUDE (repeats) FROM {{final}} WHERE {_FAILED} = ''"
        ),
        "constraints_flag": _over_final(
            f"SELECT transaction_id, merchant_name, {_FAILED} AS failed FROM {{final}}"
        ),
        "constraints_later_load": _over_final(
            f"SELECT * FROM (SELECT * EXCLUDE (repeats), {_FAILED} AS failed FROM {{final}}"
            " WHERE booking_datetime >= TIMESTAMP '2000-01-01') WHERE failed <> ''"
        ),
        "constraints_later_load_indexed": _over_final(
            f"SELECT * FROM (SELECT * EXCLUDE (repeats), {_FAILED} AS failed FROM {{final}}"
            " WHERE booking_datetime >= TIMESTAMP '2000-01-01') WHERE failed <> ''"
        ),
        "merchant_fuzzy_two_edits": "SELECT name, id, dirty_name,"
        " CAST(levenshtein(lower(name), lower(dirty_name)) AS INT) AS distance"
        " FROM (SELECT DISTINCT merchant_name AS name FROM trimmed WHERE merchant_name IS NOT NULL) n"
        " JOIN dictionary d ON levenshtein(lower(name), lower(dirty_name)) <= 2"
        " AND abs(length(name) - length(dirty_name)) <= 2",
        "audit_log_appended": _APPENDED,
        "audit_factors": _FACTORS,
        "audit_merchant": _AUDIT_MERCHANT,
        "audit_category": _AUDIT_CATEGORY,
        "audit_null_fix": _AUDIT_FILLS,
        "audit_duplicates": _AUDIT_DUPLICATES,
        "audit_exchange_rate": _AUDIT_RATES,
        "audit_future_dates": _AUDIT_DATES,
        "audit_log": _LOG,
        "audit_log_ids": "SELECT count(*) AS rows, count(*) AS ids, CAST(1 AS DECIMAL(38,0)) AS first_id,"
        " CAST(sum(entries) AS DECIMAL(38,0)) AS last_id FROM (SELECT transaction_id, column_changed, old_value,"
        f" new_value, sum(entries) AS entries FROM ({_LOG}) GROUP BY ALL)",
        "audit_lineage": _LINEAGE,
        "audit_summary_of_log": _summary(_LOG),
        "audit_summary_of_lineage": _summary(_LINEAGE),
        "cleaning_summary": _summary(_LOG),
        "cleaning_report": 'SELECT change_stage AS "Cleaning Stage", change_reason AS "Reason For Change",'
        f' number_of_changes AS "Total Rows Changed" FROM ({_summary(_LOG)})'
        " ORDER BY 3 DESC, 1, 2",
        "label_profile": """
SELECT label, count(*) AS rows FROM (
  SELECT unnest(string_split(errors, ';')) AS label FROM (
    SELECT concat_ws(';', CASE WHEN transaction_amount IS NULL THEN 'missing_amount' END,
      CASE WHEN instructed_amount = 0 THEN 'zero_amount' END,
      CASE WHEN currency IS NULL THEN 'missing_currency' END) AS errors
    FROM raw) WHERE errors <> '') GROUP BY ALL""",
    }
    on_full = {
        "cleaned_transactions_full": f"SELECT {_FULL_COLUMNS} FROM final",
        "report_view": on_run["cleaning_report"],
        "mcc_dependency": "SELECT CAST(code AS INT) AS MerchantCategoryCode, count(*) AS \"values\", CAST(sum(n) AS BIGINT) AS rows,"
        " CASE WHEN count(*) = count(category) THEN min(category) END AS least, max(category) AS greatest"
        " FROM (SELECT CASE WHEN instructed_amount < 0 THEN 5812 END AS code, category, count(*) AS n FROM final GROUP BY ALL)"
        " GROUP BY ALL HAVING count(*) > 1",
        "full_audit_factors": _FACTORS,
        "audit_factors_expanded": f"{_AUDIT_MERCHANT} UNION ALL {_AUDIT_CATEGORY}",
        "audit_factors_counted": _summary(f"{_AUDIT_MERCHANT} UNION ALL {_AUDIT_CATEGORY}"),
        "full_audit_log": _LOG,
        "full_audit_lineage": _LINEAGE,
        "full_duplicates_listed": "SELECT transaction_id AS TransactionId, merchant_name, category, row_num"
        " FROM numbered_rows WHERE row_num > 1",
        "full_not_null_key": "SELECT booking_datetime AS BookingDateTime, merchant_name FROM final"
        " WHERE transaction_id IS NULL",
    }
    on_tables = {
        "conform_columns": "SELECT CAST(o_orderkey AS INT) AS transaction_number, o_orderdate AS booking_datetime,"
        " CAST(o_totalprice AS DECIMAL(12,2)) AS instructed_amount, o_orderstatus AS status FROM orders",
        "initcap_documents": f"SELECT doc_id, md5({_title('text')}) AS title_md5 FROM documents",
        "fix_precision_lineitem": "SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(12,2)) AS l_extendedprice,"
        " CAST(l_discount AS DECIMAL(12,1)) AS l_discount FROM lineitem",
        "documents_dedup": "SELECT doc_id, lang, source, n_chars FROM documents"
        " QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1",
        "documents_copies": "SELECT * FROM (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS row_num"
        " FROM documents) WHERE row_num > 1",
        "lineitem_key_violations": "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem"
        " GROUP BY ALL HAVING count(*) > 1",
        "parse_mixed_dates": "SELECT event_id, raw_date, coalesce("
        + ", ".join(
            f"try_strptime(raw_date, '{layout}')"
            for layout in (
                "%Y-%m-%d %H:%M:%S",
                "%d/%m/%Y %H:%M",
                "%Y/%m/%d %H:%M:%S",
                "%d-%m-%Y %H:%M:%S",
                "%b %d, %Y %I:%M %p",
            )
        )
        + f") AS parsed FROM ({_RAW_DATE})",
        "sample_orders": f"SELECT o_orderkey, o_custkey, o_orderstatus FROM ({_sample(_TWENTIETH)})",
        "inject_order_copies": "SELECT o_orderkey, count(*) AS copies FROM (SELECT o_orderkey FROM orders"
        f" UNION ALL SELECT o_orderkey FROM ({_sample(_TWENTIETH)})) GROUP BY ALL",
        "enrich_nation": "SELECT o_orderkey, c_mktsegment, n_name FROM orders"
        " LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey",
        "date_order_of_sources": _DATE_ORDER,
        "dates_by_evidence": "SELECT event_id, source, raw_date, \"order\", CASE WHEN as_day IS NULL OR as_month IS NULL"
        " OR as_day = as_month THEN coalesce(as_day, as_month) WHEN \"order\" = 'day' THEN as_day"
        f" WHEN \"order\" = 'month' THEN as_month END AS parsed FROM ({_DATES_READ}) JOIN ({_DATE_ORDER}) USING (source)",
        "inclusions_found": _INCLUSIONS,
        "enrich_first_of_repeated": "SELECT n_nationkey, n_name, c_custkey, c_mktsegment FROM nation LEFT JOIN ("
        "SELECT c_nationkey, c_custkey, c_mktsegment FROM customer"
        " QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey, c_mktsegment) = 1) ON n_nationkey = c_nationkey",
        "unmatched_lines": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem l WHERE NOT EXISTS ("
        "SELECT 1 FROM lineitem o WHERE o.l_discount > 0 AND o.l_partkey = l.l_partkey AND o.l_suppkey = l.l_suppkey)",
    }
    changed = swapped.replace("), raw AS (", "), raw_before AS (").replace(
        "), dictionary(", f"), raw AS (\n  {_CHANGED_RAW}\n), dictionary("
    )
    on_changed = {
        "rerun_after_change": "SELECT * FROM final",
        "rerun_summary": _summary(_LOG),
    }
    return {
        **{name: f"{changed}\n{sql}" for name, sql in on_changed.items()},
        **{name: f"{swapped}\n{sql}" for name, sql in on_run.items()},
        **{name: f"{full}\n{sql}" for name, sql in on_full.items()},
        "merchant_known_spellings": f"{known}\nSELECT merchant_name, count(*) AS rows FROM staging GROUP BY ALL",
        **on_tables,
    }
