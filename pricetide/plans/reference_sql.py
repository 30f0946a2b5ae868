"""The registered queries as plain SQL over the same tables, for checking results."""

from __future__ import annotations

from .catalog import (
    BROKEN_FACT,
    BROKEN_MERCHANT,
    BROKEN_NAMES,
    BROKEN_PRODUCT,
    BROKEN_RUN,
    EARLIER_LOAD,
)

# --- shared steps -----------------------------------------------------------------


def _cents(name: str) -> str:
    return f"CAST(CAST(CAST({name} AS DECIMAL(18,2)) * 0.01 AS DECIMAL(12,2)) AS VARCHAR)"


def _money(name: str) -> str:
    """Double to DECIMAL(12,2), half up on its shortest text."""
    return f"CAST(ROUND(CAST(CAST({name} AS VARCHAR) AS DECIMAL(38,20)), 2) AS DECIMAL(12,2))"


def _day(extra: int) -> str:
    return (
        f"strftime(CAST(l_shipdate AS TIMESTAMP) + INTERVAL {extra} DAY, '%Y-%m-%d')"
        " || 'T00:00:00Z'"
    )


LINES = """
lines AS (
  SELECT l.*, p_name, p_brand, p_type, s_name,
         CAST(floor(l_extendedprice * 100 / l_quantity) AS BIGINT) AS hi,
         CAST(floor(l_extendedprice * 100 * (1 - l_discount) / l_quantity) AS BIGINT) AS lo
  FROM lineitem l
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
),
delivered AS (
  SELECT * FROM lines UNION ALL SELECT * FROM lines WHERE l_orderkey % 97 = 0
)"""

RAW = f"""{LINES},
raw_batch AS (
  SELECT 'P' || CAST(l_partkey AS VARCHAR) AS id,
         CASE WHEN l_orderkey % 7 = 0 THEN '  ' || p_name || ' ' ELSE p_name END AS name,
         CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE p_brand END AS brand,
         p_type AS categories,
         CASE WHEN l_orderkey % 101 = 0 THEN NULL
              WHEN l_orderkey % 103 = 0 THEN '-1.00'
              WHEN l_orderkey % 107 = 0 THEN {_cents('hi')}
              ELSE {_cents('lo')} END AS amount_min,
         CASE WHEN l_orderkey % 107 = 0 THEN {_cents('lo')} ELSE {_cents('hi')} END
           AS amount_max,
         CASE WHEN l_linenumber % 2 = 0 THEN ' usd' ELSE 'USD' END AS currency,
         CASE WHEN l_orderkey % 109 = 0 THEN 'bad-date'
              WHEN l_orderkey % 113 = 0 THEN NULL
              WHEN l_linenumber % 3 = 0 THEN {_day(0)} || ', ' || {_day(30)}
              ELSE {_day(0)} END AS date_seen,
         CASE WHEN l_suppkey % 40 = 0 THEN NULL
              WHEN l_orderkey % 2 = 0 THEN upper(s_name)
              ELSE s_name || ' ' END AS merchant,
         CASE l_returnflag WHEN 'A' THEN 'New' WHEN 'N' THEN 'Used ' END AS condition,
         strftime(CAST(l_shipdate AS TIMESTAMP), '%Y-%m-%d') AS batch
  FROM delivered
),
raw AS (SELECT * EXCLUDE (batch) FROM raw_batch)"""


def _observed(source: str, carry: str = "") -> str:
    """Steps from distinct raw rows to judged observations."""
    more = f", {carry}" if carry else ""
    return f"""
parsed AS (
  SELECT trim(id) AS product_id, trim(name) AS product_name, trim(brand) AS brand,
         trim(categories) AS category, amount_min AS price_min_text,
         amount_max AS price_max_text, TRY_CAST(amount_min AS DOUBLE) AS price_min,
         TRY_CAST(amount_max AS DOUBLE) AS price_max, upper(trim(currency)) AS currency,
         trim(currency) AS currency_text, date_seen AS dates, lower(trim(merchant)) AS merchant,
         lower(trim(condition)) AS condition{more}
  FROM (SELECT DISTINCT * FROM {source})
),
priced AS (
  SELECT *, CASE WHEN price_min IS NULL OR price_max IS NULL THEN 'price_missing'
                 WHEN price_min < 0 OR price_max < 0 THEN 'price_negative'
                 WHEN price_min > price_max THEN 'price_range' END AS price_problem
  FROM parsed
),
pieces AS (
  SELECT *, unnest(CASE WHEN price_problem IS NOT NULL OR dates IS NULL
                        THEN [CAST(NULL AS VARCHAR)]
                        ELSE string_split(dates, ',') END) AS piece
  FROM priced
),
dated AS (SELECT *, TRY_CAST(trim(piece) AS TIMESTAMP) AS date_seen FROM pieces),
observed AS (
  SELECT *, (price_min + price_max) / 2 AS price,
         COALESCE(price_problem, CASE WHEN date_seen IS NULL THEN 'date_invalid' END)
           AS reject_reason
  FROM dated
),
clean AS (SELECT * FROM observed WHERE reject_reason IS NULL)"""


CLEAN = f"{RAW},{_observed('raw')}"


def _facts(merchant: str, source: str = "clean", carry: str = "") -> str:
    more = f", {carry}" if carry else ""
    return f"""
facts AS (
  SELECT DISTINCT product_id, {merchant}, date_seen AS observed_at,
         {_money('price')} AS price, {_money('price_min')} AS price_min,
         {_money('price_max')} AS price_max, COALESCE(currency, '') AS currency,
         COALESCE(condition, '') AS condition{more}
  FROM {source}
  WHERE product_id <> '' AND {merchant} IS NOT NULL
)"""


FACTS = f"{CLEAN},{_facts('merchant')}"

SELLERS = """
sellers AS (
  SELECT CAST(s_suppkey + 1 AS BIGINT) AS merchant_id, lower(s_name) AS merchant_name, s_acctbal
  FROM supplier
),
known AS (SELECT merchant_id, merchant_name FROM sellers WHERE s_acctbal > 0)"""

ID_FACTS = f"""{CLEAN},{SELLERS},
mapped AS (SELECT c.*, s.merchant_id FROM clean c LEFT JOIN sellers s ON c.merchant = s.merchant_name),
{_facts('merchant_id', 'mapped')}"""

_EVENT_PRICE = """CAST(CAST(CAST(floor(value / 10) AS BIGINT) * 10 + 1 AS DECIMAL(12,2))
  AS DECIMAL(12,2))"""
EVENT_FACTS = f"""
facts AS (
  SELECT DISTINCT 'U' || CAST(user_id AS VARCHAR) AS product_id, event_type AS merchant,
         CAST(ts AS TIMESTAMP) AS observed_at, {_EVENT_PRICE} AS price,
         {_EVENT_PRICE} AS price_min, {_EVENT_PRICE} AS price_max,
         'USD' AS currency, 'new' AS condition
  FROM events
)"""

OFFER = "product_id, merchant, currency, condition"
ORDER = "observed_at, price, price_min, price_max"

SEQUENCE = f"""
seq AS (
  SELECT *, lag(price) OVER w AS previous_price, lag(observed_at) OVER w AS previous_at
  FROM facts
  WINDOW w AS (PARTITION BY {OFFER} ORDER BY {ORDER})
)"""

CURRENT = f"""
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY {OFFER}
    ORDER BY observed_at DESC, price DESC, price_min DESC, price_max DESC) AS newest
  FROM facts
),
current_offers AS (
  SELECT {OFFER}, observed_at, price FROM ranked WHERE newest = 1
),
market AS (
  SELECT *, count(*) OVER m AS offers, sum(price) OVER m AS total, min(price) OVER m AS lowest,
         rank() OVER (PARTITION BY product_id, currency, condition ORDER BY price) AS price_rank
  FROM current_offers
  WINDOW m AS (PARTITION BY product_id, currency, condition)
)"""

PAIR = f"""
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY {OFFER}
    ORDER BY observed_at DESC, price DESC, price_min DESC, price_max DESC) AS newest
  FROM facts
),
moves AS (
  SELECT n.product_id, n.merchant, n.currency, n.condition, o.price AS previous_price, n.price,
         n.observed_at, n.price - o.price AS price_diff
  FROM ranked n JOIN ranked o
    ON n.product_id = o.product_id AND n.merchant = o.merchant AND n.currency = o.currency
   AND n.condition = o.condition AND n.newest = 1 AND o.newest = 2
)"""

FIRST_PAIR = f"""
ranked AS (
  SELECT *,
    row_number() OVER (PARTITION BY {OFFER}
      ORDER BY observed_at DESC, price DESC, price_min DESC, price_max DESC) AS newest,
    row_number() OVER (PARTITION BY {OFFER} ORDER BY {ORDER}) AS oldest
  FROM facts
),
moves AS (
  SELECT n.product_id, n.merchant, n.currency, n.condition, o.price AS previous_price, n.price,
         n.observed_at, n.price - o.price AS price_diff
  FROM ranked n JOIN ranked o
    ON n.product_id = o.product_id AND n.merchant = o.merchant AND n.currency = o.currency
   AND n.condition = o.condition AND n.newest = 1 AND o.oldest = 1 AND n.oldest > 1
)"""


def _double(*names: str) -> str:
    return ", ".join(f"CAST({name} AS DOUBLE) AS {name}" for name in names)


def _pct(change: str, base: str) -> str:
    return (
        f"CASE WHEN {base} <> 0 THEN CAST(100 AS DOUBLE) * CAST({change} AS DOUBLE)"
        f" / CAST({base} AS DOUBLE) END"
    )


def _count(condition: str) -> str:
    return f"CAST(COALESCE(sum(CASE WHEN {condition} THEN 1 ELSE 0 END), 0) AS BIGINT)"


def _long(pairs: list[tuple[str, str]], source: str, label: str, value: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS {label}, {expression} AS {value} FROM {source}"
        for name, expression in pairs
    )


RAW_NAMES = [
    ("id", "id"),
    ("name", "name"),
    ("brand", "brand"),
    ("categories", "categories"),
    ("prices.amountMin", "amount_min"),
    ("prices.amountMax", "amount_max"),
    ("prices.currency", "currency"),
    ("prices.dateSeen", "date_seen"),
    ("prices.merchant", "merchant"),
    ("prices.condition", "condition"),
]

RAW_AS_CLEAN = """id AS product_id, name AS product_name, brand, categories AS category,
  amount_min AS price_min, amount_max AS price_max, currency, date_seen, merchant, condition"""

_ALL_DATES = """len(list_filter(string_split(date_seen, ','),
  lambda piece: TRY_CAST(trim(piece) AS TIMESTAMP) IS NULL)) = 0"""

_TYPES = [
    ("prices.amountMin", "number", "amount_min", "TRY_CAST(amount_min AS DOUBLE) IS NOT NULL"),
    ("prices.amountMax", "number", "amount_max", "TRY_CAST(amount_max AS DOUBLE) IS NOT NULL"),
    ("prices.dateSeen", "timestamp list", "date_seen", _ALL_DATES),
    ("prices.currency", "text(10)", "currency", "length(trim(currency)) <= 10"),
    ("prices.condition", "text(100)", "condition", "length(trim(condition)) <= 100"),
    ("id", "text(255)", "id", "length(trim(id)) BETWEEN 1 AND 255"),
]

UNCHECKED = f"""{CLEAN},{SELLERS},
unchecked AS (
  SELECT o.*, date_seen AS observed_at, merchant_id
  FROM observed o LEFT JOIN known ON merchant = merchant_name
)"""

_GATE = [
    ("product_id_blank", "COALESCE(product_id, '') = ''"),
    ("merchant_id_null", "merchant_id IS NULL"),
    ("price_min_null", "price_min IS NULL"),
    ("price_max_null", "price_max IS NULL"),
    ("price_null", "price IS NULL"),
    ("observed_at_null", "observed_at IS NULL"),
    ("currency_too_long", "length(currency) > 10"),
    ("condition_too_long", "length(condition) > 100"),
]

_PRODUCT_RULES = [
    ("products.product_id not null", "product_id IS NULL"),
    ("products.product_id length", "length(product_id) > 255"),
    ("products.product_name not null", "product_name IS NULL"),
    ("products.brand length", "length(brand) > 255"),
]

_MERCHANT_RULES = [
    ("merchants.merchant_id not null", "merchant_id IS NULL"),
    ("merchants.merchant_name not null", "merchant_name IS NULL"),
    ("merchants.merchant_name length", "length(merchant_name) > 500"),
]

_RUN_RULES = [
    *[(f"pipeline_runs.{c} not null", f"{c} IS NULL") for c in ("run_id", "started_at", "status")],
    *[(f"pipeline_runs.{c} >= 0", f"{c} < 0")
      for c in ("records_received", "records_validated", "records_transformed", "records_loaded")],
    ("pipeline_runs.status length", "length(status) > 50"),
    ("pipeline_runs.status known", "status NOT IN ('RUNNING', 'SUCCESS', 'FAILED')"),
    ("pipeline_runs.completed_at >= started_at", "completed_at < started_at"),
    ("pipeline_runs.completed_at of ended runs", "status <> 'RUNNING' AND completed_at IS NULL"),
]

_FACT_RULES = [
    ("price_history.price_id not null", "price_id IS NULL"),
    ("price_history.product_id not null", "product_id IS NULL"),
    ("price_history.product_id length", "length(product_id) > 255"),
    ("price_history.merchant_id not null", "merchant_id IS NULL"),
    ("price_history.price_min not null", "price_min IS NULL"),
    ("price_history.price_max not null", "price_max IS NULL"),
    ("price_history.price not null", "price IS NULL"),
    ("price_history.observed_at not null", "observed_at IS NULL"),
    ("price_history.currency length", "length(currency) > 10"),
    ("price_history.condition length", "length(condition) > 100"),
    ("price_history.price_min >= 0", "price_min < 0"),
    ("price_history.price_max >= 0", "price_max < 0"),
    ("price_history.price >= 0", "price < 0"),
    ("price_history.price_min <= price_max", "price_min > price_max"),
]


def _rules(rules: list[tuple[str, str]], source: str) -> str:
    return _long([(n, _count(c)) for n, c in rules], source, "check_name", "violations")


def _unique(name: str, key: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, CAST(count({key}) - count(DISTINCT {key}) AS BIGINT)"
        f" AS violations FROM {source}"
    )


_METRICS = f"""
  CAST(sum(n) AS BIGINT) AS row_count, CAST(10 AS BIGINT) AS column_count,
  CAST(sum(n - 1) AS BIGINT) AS duplicates,
  CAST(sum(CASE WHEN TRY_CAST(amount_min AS DOUBLE) IS NULL
                  OR TRY_CAST(amount_max AS DOUBLE) IS NULL THEN n ELSE 0 END) AS BIGINT)
    AS null_price_rows,
  CAST(sum(CASE WHEN TRY_CAST(amount_min AS DOUBLE) < 0
                  OR TRY_CAST(amount_max AS DOUBLE) < 0 THEN n ELSE 0 END) AS BIGINT)
    AS invalid_price_rows,
  CAST(sum(CASE WHEN COALESCE(trim(id), '') = '' THEN n ELSE 0 END) AS BIGINT)
    AS null_product_ids"""

_STATUS = """CASE WHEN first_failure = '' THEN 'PASSED' ELSE 'FAILED' END AS status"""


def _first_failure(duplicates: bool) -> str:
    first = "WHEN duplicates > 0 THEN 'duplicates' " if duplicates else ""
    return f"""CASE {first}WHEN null_price_rows > 0 THEN 'null_prices'
      WHEN invalid_price_rows > 0 THEN 'invalid_prices'
      WHEN null_product_ids > 0 THEN 'null_product_ids' ELSE '' END AS first_failure"""


PARTS = f"""{RAW},
raw_part AS (SELECT * EXCLUDE (batch), greatest(0, least(3, (CAST(left(batch, 4) AS BIGINT) - 1994) // 2)) AS part FROM raw_batch),
copies AS (SELECT *, count(*) AS n FROM raw_part GROUP BY ALL),
metrics AS (SELECT part + 1 AS run_id, {_METRICS} FROM copies GROUP BY part),
reports AS (SELECT *, {_STATUS} FROM (SELECT *, {_first_failure(False)} FROM metrics))"""

RUNS = f"""{PARTS},{_observed('raw_part', 'part')},
{_facts('merchant', carry='part')},
outcomes AS (SELECT *, run_id % 2 = 0 OR status = 'PASSED' AS ok FROM reports),
valid AS (
  SELECT part + 1 AS run_id, count(*) AS n_valid FROM raw_part
  WHERE TRY_CAST(amount_min AS DOUBLE) >= 0 AND TRY_CAST(amount_max AS DOUBLE) >= TRY_CAST(amount_min AS DOUBLE)
  GROUP BY part
),
cleaned AS (SELECT part + 1 AS run_id, count(*) AS n_clean FROM clean GROUP BY part),
first_loads AS (
  SELECT min(part) + 1 AS run_id FROM facts WHERE part + 1 IN (SELECT run_id FROM outcomes WHERE ok)
  GROUP BY product_id, merchant, observed_at, price, price_min, price_max, currency, condition
),
loaded AS (SELECT run_id, count(*) AS n_loaded FROM first_loads GROUP BY run_id),
runs AS (
  SELECT run_id, CASE WHEN ok THEN 'SUCCESS' ELSE 'FAILED' END AS status, row_count AS records_received,
         CASE WHEN ok THEN COALESCE(n_valid, 0) ELSE 0 END AS records_validated,
         CASE WHEN ok THEN COALESCE(n_clean, 0) ELSE 0 END AS records_transformed,
         CASE WHEN ok THEN COALESCE(n_loaded, 0) ELSE 0 END AS records_loaded,
         CASE WHEN NOT ok THEN first_failure END AS failure
  FROM outcomes LEFT JOIN valid USING (run_id) LEFT JOIN cleaned USING (run_id) LEFT JOIN loaded USING (run_id)
)"""

_TREND = " UNION ALL ".join(
    f"SELECT run_id, status, row_count, '{m}' AS metric, {m} AS value FROM reports"
    for m in ("duplicates", "null_price_rows", "invalid_price_rows", "null_product_ids")
)

PRODUCTS = """
first_rows AS (
  SELECT *, row_number() OVER (
    PARTITION BY product_id
    ORDER BY merchant NULLS LAST, date_seen NULLS LAST, product_name NULLS LAST,
             brand NULLS LAST, category NULLS LAST) AS n
  FROM {source}
),
products AS (
  SELECT product_id, COALESCE(product_name, '') AS product_name, COALESCE(brand, '') AS brand,
         COALESCE(category, '') AS category
  FROM first_rows WHERE n = 1 AND product_id <> ''
)"""

_NEW_FACT = f"observed_at >= TIMESTAMP '{EARLIER_LOAD}'"

_DATE_PARTS = """strftime(observed_at, '%Y-%m-%d') AS observed_date,
  CAST(year(observed_at) AS BIGINT) AS observed_year,
  CAST(month(observed_at) AS BIGINT) AS observed_month"""

_ID_FACT_COLUMNS = f"""product_id, CAST(merchant_id AS BIGINT) AS merchant_id, observed_at,
  {_double('price', 'price_min', 'price_max')}, currency, condition, {_DATE_PARTS}"""


def _move_columns() -> str:
    return f"""{OFFER}, {_double('previous_price', 'price', 'price_diff')}, observed_at,
      {_pct('price_diff', 'previous_price')} AS price_pct"""


def _top(pair: str, facts: str, sign: str, direction: str) -> str:
    return f"""WITH {facts},{pair},
    scored AS (SELECT {_move_columns()} FROM moves)
    SELECT * FROM scored WHERE price_pct {sign} 0
    ORDER BY price_pct {direction}, {OFFER} LIMIT 20"""


def _trend(period: str) -> str:
    return f"""WITH {FACTS}
    SELECT product_id, currency, condition,
           CAST(date_trunc('{period}', observed_at) AS TIMESTAMP) AS period,
           count(*) AS observations, CAST(min(price) AS DOUBLE) AS min_price,
           CAST(max(price) AS DOUBLE) AS max_price,
           CAST(sum(price) AS DOUBLE) / count(*) AS avg_price
    FROM facts GROUP BY 1, 2, 3, 4"""


def _extreme(direction: str) -> str:
    return f"""WITH {FACTS},
    best AS (
      SELECT *, row_number() OVER (
        PARTITION BY product_id, currency, condition
        ORDER BY price {direction}, observed_at, merchant) AS n
      FROM facts
    )
    SELECT product_id, currency, condition, {_double('price')}, observed_at, merchant
    FROM best WHERE n = 1"""


def _change(facts: str) -> str:
    return f"""WITH {facts},{SEQUENCE}
    SELECT {OFFER}, observed_at, {_double('price', 'price_min', 'price_max', 'previous_price')},
           previous_at, CAST(price - previous_price AS DOUBLE) AS price_diff,
           {_pct('(price - previous_price)', 'previous_price')} AS price_pct
    FROM seq"""


_EVENT_ROWS = f"""WITH {EVENT_FACTS}
  SELECT product_id, merchant, observed_at, {_double('price')}, currency, condition FROM facts"""


def statements() -> dict[str, str]:
    previous = f"""{OFFER}, observed_at,
      {_double('price', 'price_min', 'price_max', 'previous_price')}, previous_at"""
    found = {
        "scan_raw_prices": f"WITH {RAW} SELECT {RAW_AS_CLEAN} FROM raw",
        # A broken row is two rows, neither of which fits the header.
        "scan_mixed_files": f"""WITH {RAW},
            whole AS (SELECT {RAW_AS_CLEAN} FROM raw)
            SELECT *, false AS malformed FROM whole WHERE product_id NOT LIKE '%7'
            UNION ALL
            SELECT {', '.join(['NULL'] * 10)}, true FROM whole, (VALUES (1), (2)) AS half(n)
            WHERE product_id LIKE '%7'""",
        "land_raw": f"""WITH {RAW}
            SELECT 'day1' AS _batch_id, count(*) AS row_count, count(*) AS stamped_rows,
                   count(*) AS traced_rows, count(id) AS id_rows,
                   count(amount_min) AS price_rows, count(merchant) AS merchant_rows
            FROM raw""",
        "select_business_columns": f"WITH {RAW} SELECT {RAW_AS_CLEAN} FROM raw",
        "dedup_exact": f"WITH {RAW} SELECT DISTINCT {RAW_AS_CLEAN} FROM raw",
        "filter_invalid_prices": f"""WITH {CLEAN}
            SELECT product_id, price_min, price_max, currency_text AS currency,
                   dates AS date_seen
            FROM priced WHERE price_problem IS NULL""",
        "filter_invalid_dates": f"""WITH {CLEAN}
            SELECT product_id, merchant, date_seen, price,
                   strftime(date_seen, '%Y-%m-%d') AS observed_date,
                   CAST(year(date_seen) AS BIGINT) AS observed_year,
                   CAST(month(date_seen) AS BIGINT) AS observed_month
            FROM clean""",
        "quarantine": f"""WITH {CLEAN}
            SELECT product_id, merchant, price_min_text, price_max_text,
                   COALESCE(trim(piece), dates) AS date_text, 'clean' AS reject_stage,
                   reject_reason
            FROM observed WHERE reject_reason IS NOT NULL""",
        "transform_accounting": f"""WITH {CLEAN},
            a AS (SELECT count(*) AS rows_in FROM raw),
            b AS (SELECT count(*) AS rows_distinct,
                         {_count('price_problem IS NOT NULL')} AS rows_bad_price FROM priced),
            c AS (SELECT {_count('price_problem IS NULL')} AS rows_exploded,
                         {_count("reject_reason = 'date_invalid'")} AS rows_bad_date,
                         {_count('reject_reason IS NULL')} AS rows_out FROM observed)
            SELECT rows_in, rows_in - rows_distinct AS rows_duplicate, rows_bad_price,
                   rows_exploded, rows_bad_date, rows_out, rows_in - rows_out AS rows_removed
            FROM a, b, c""",
        "sorted_observations": f"""WITH {CLEAN}
            SELECT product_id, product_name, brand, category, price_min, price_max, currency,
                   date_seen, merchant, condition, price,
                   strftime(date_seen, '%Y-%m-%d') AS observed_date,
                   CAST(year(date_seen) AS BIGINT) AS observed_year,
                   CAST(month(date_seen) AS BIGINT) AS observed_month
            FROM clean ORDER BY product_id, merchant NULLS LAST, date_seen""",
        "missing_columns": f"WITH {RAW} "
        + " UNION ALL ".join(
            f"SELECT '{label}' AS column_name, {str(label != 'prices.condition').upper()} AS present, "
            + (f"count({name})" if label != "prices.condition" else "CAST(count(*) * 0 AS BIGINT)")
            + " AS filled_rows FROM raw"
            for label, name in RAW_NAMES
        ),
        "missing_by_column": f"WITH {RAW} "
        + " UNION ALL ".join(
            f"SELECT '{label}' AS column_name, count(*) AS total_rows,"
            f" count(*) - count({name}) AS missing_rows FROM raw"
            for label, name in RAW_NAMES
        ),
        "type_conformance": f"WITH {RAW} "
        + " UNION ALL ".join(
            f"SELECT '{label}' AS column_name, '{kind}' AS expected_type,"
            f" count({name}) AS value_rows, {_count(ok)} AS conforming_rows FROM raw"
            for label, kind, name, ok in _TYPES
        ),
        "duplicate_count": f"""WITH {RAW},
            a AS (SELECT count(*) AS total_rows FROM raw),
            b AS (SELECT count(*) AS distinct_rows FROM (SELECT DISTINCT * FROM raw))
            SELECT total_rows, distinct_rows, total_rows - distinct_rows AS duplicate_rows
            FROM a, b""",
        "validation_report": f"""WITH {RAW},
            copies AS (SELECT *, count(*) AS n FROM raw GROUP BY ALL),
            metrics AS (SELECT {_METRICS} FROM copies),
            judged AS (SELECT *, {_first_failure(True)} FROM metrics)
            SELECT *, {_STATUS} FROM judged""",
        "quality_by_batch": f"WITH {PARTS} SELECT * FROM reports",
        "quality_trend": f"""WITH {PARTS}, pairs AS ({_TREND})
            SELECT run_id, metric, status, row_count, value,
                   CAST(value AS DOUBLE) / row_count AS share,
                   CAST(sum(value) OVER w AS DOUBLE) / CAST(sum(row_count) OVER w AS DOUBLE) AS usual_share,
                   CAST(value AS DOUBLE) / row_count
                     - CAST(sum(value) OVER w AS DOUBLE) / CAST(sum(row_count) OVER w AS DOUBLE) AS change,
                   min(run_id) FILTER (value > 0) OVER (PARTITION BY metric) AS first_failing
            FROM pairs
            WINDOW w AS (PARTITION BY metric ORDER BY run_id ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING)""",
        "load_gate": f"WITH {UNCHECKED} {_rules(_GATE, 'unchecked')}",
        "constraint_violations": f"""WITH {UNCHECKED},
            some_products AS (SELECT DISTINCT {BROKEN_PRODUCT}, {BROKEN_NAMES} FROM clean),
            some_merchants AS (SELECT {BROKEN_MERCHANT} FROM unchecked),
            some_prices AS (SELECT {BROKEN_PRODUCT}, {BROKEN_FACT} FROM unchecked),
            some_runs AS (SELECT {BROKEN_RUN} FROM events)
            {_rules(_PRODUCT_RULES, 'some_products')}
            UNION ALL {_unique('products.product_id unique', 'product_id', 'some_products')}
            UNION ALL {_rules(_MERCHANT_RULES, 'some_merchants')}
            UNION ALL {_unique('merchants.merchant_name unique', 'merchant_name', 'some_merchants')}
            UNION ALL {_unique('merchants.merchant_id unique', 'merchant_id', 'some_merchants')}
            UNION ALL {_rules(_FACT_RULES, 'some_prices')}
            UNION ALL {_unique('price_history.price_id unique', 'price_id', 'some_prices')}
            UNION ALL {_rules(_RUN_RULES, 'some_runs')}
            UNION ALL {_unique('pipeline_runs.run_id unique', 'run_id', 'some_runs')}""",
        "fk_orphans": f"""WITH {ID_FACTS},
            held AS (SELECT DISTINCT product_id FROM clean WHERE product_id NOT LIKE '%7')
            SELECT 'product_id' AS foreign_key, product_id AS key_value, count(*) AS fact_rows
            FROM facts WHERE product_id NOT IN (SELECT product_id FROM held) GROUP BY 2
            UNION ALL
            SELECT 'merchant_id', CAST(merchant_id AS VARCHAR), count(*)
            FROM facts WHERE merchant_id NOT IN (SELECT merchant_id FROM known) GROUP BY 2""",
        "dim_products": f"WITH {CLEAN},{PRODUCTS.format(source='clean')} SELECT * FROM products",
        "dim_merchants": f"""WITH {CLEAN} SELECT DISTINCT merchant AS merchant_name FROM clean
            WHERE merchant IS NOT NULL AND merchant <> ''""",
        "products_upsert": f"""WITH {CLEAN},
            {PRODUCTS.format(source='clean').strip()},
            stored AS (SELECT 'P' || CAST(p_partkey AS VARCHAR) AS product_id,
                              p_type AS product_name, p_brand AS brand, 'unsorted' AS category
                       FROM part WHERE p_size <= 25)
            SELECT COALESCE(p.product_id, s.product_id) AS product_id,
                   CASE WHEN p.product_id IS NULL THEN s.product_name ELSE p.product_name END
                     AS product_name,
                   CASE WHEN p.product_id IS NULL THEN s.brand ELSE p.brand END AS brand,
                   CASE WHEN p.product_id IS NULL THEN s.category ELSE p.category END
                     AS category,
                   CASE WHEN s.product_id IS NULL THEN TIMESTAMP '2002-01-01'
                        ELSE TIMESTAMP '1995-01-01' END AS created_at,
                   CASE WHEN p.product_id IS NULL THEN TIMESTAMP '1995-01-01'
                        ELSE TIMESTAMP '2002-01-01' END AS updated_at,
                   CASE WHEN s.product_id IS NULL THEN 'inserted'
                        WHEN p.product_id IS NULL THEN 'untouched' ELSE 'updated' END AS change
            FROM stored s FULL JOIN products p ON s.product_id = p.product_id""",
        "merchants_merge": f"""WITH {CLEAN},{SELLERS}
            SELECT merchant_name, FALSE AS is_new, merchant_id AS stored_id FROM known
            UNION ALL
            SELECT DISTINCT merchant, TRUE, CAST(-1 AS BIGINT) FROM clean
            WHERE merchant IS NOT NULL AND merchant NOT IN (SELECT merchant_name FROM known)""",
        "merchants_new_ids": f"""WITH {CLEAN},{SELLERS},
            added AS (SELECT DISTINCT merchant FROM clean
                      WHERE merchant <> '' AND merchant NOT IN (SELECT merchant_name FROM known)),
            highest AS (SELECT max(merchant_id) AS top FROM known)
            SELECT count(*) AS new_merchants, count(*) AS new_ids, any_value(top) + 1 AS first_id,
                   any_value(top) + count(*) AS last_id
            FROM added, highest""",
        "map_merchant_id": f"""WITH {CLEAN},{SELLERS}
            SELECT product_id, COALESCE(merchant, '') AS merchant, date_seen, price,
                   COALESCE(merchant_id, -1) AS merchant_id
            FROM clean LEFT JOIN known ON merchant = merchant_name""",
        "reject_unmapped_merchant": f"""WITH {CLEAN},{SELLERS}
            SELECT product_id, COALESCE(merchant, '') AS merchant, date_seen AS observed_at,
                   CAST({_money('price')} AS DOUBLE) AS price, 'load' AS reject_stage,
                   'merchant_unmapped' AS reject_reason
            FROM clean LEFT JOIN known ON merchant = merchant_name WHERE merchant_id IS NULL""",
        "reject_overlong_text": f"""WITH {CLEAN},
            lengthened AS (
              SELECT merchant,
                     COALESCE(repeat(currency, CASE WHEN year(date_seen) >= 1999 THEN 4 ELSE 1 END),
                              '') AS currency,
                     COALESCE(repeat(condition, CAST(month(date_seen) * 3 AS INTEGER)), '')
                       AS condition
              FROM clean
            )
            SELECT CASE WHEN merchant IS NULL THEN 'merchant_unmapped'
                        WHEN length(currency) > 10 THEN 'currency_too_long'
                        WHEN length(condition) > 100 THEN 'condition_too_long'
                        ELSE 'kept' END AS outcome,
                   count(*) AS row_count,
                   CAST(max(length(currency)) AS BIGINT) AS longest_currency,
                   CAST(max(length(condition)) AS BIGINT) AS longest_condition
            FROM lengthened GROUP BY 1""",
        "dim_date": f"""WITH {FACTS},
            span AS (SELECT CAST(min(observed_at) AS DATE) AS a, CAST(max(observed_at) AS DATE) AS b
                     FROM facts),
            days AS (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY)) AS d FROM span)
            SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key,
                   strftime(d, '%Y-%m-%d') AS calendar_date, CAST(year(d) AS BIGINT) AS year,
                   CAST(quarter(d) AS BIGINT) AS quarter, CAST(month(d) AS BIGINT) AS month,
                   CAST(day(d) AS BIGINT) AS day, CAST(isodow(d) AS BIGINT) AS day_of_week,
                   isodow(d) >= 6 AS is_weekend
            FROM days""",
        "product_search": f"""WITH {CLEAN},{PRODUCTS.format(source='clean')}
            SELECT * FROM products
            WHERE lower(product_name) LIKE '%ring%' OR lower(brand) LIKE '%ring%'
               OR lower(category) LIKE '%ring%'""",
        "price_history_load": f"WITH {ID_FACTS} SELECT {_ID_FACT_COLUMNS} FROM facts",
        "price_history_reload": f"""WITH {ID_FACTS}
            SELECT {_ID_FACT_COLUMNS} FROM facts WHERE {_NEW_FACT}""",
        "load_accounting": f"""WITH {ID_FACTS},
            a AS (SELECT count(*) AS received FROM mapped WHERE merchant_id IS NOT NULL),
            b AS (SELECT count(*) AS inserted FROM facts WHERE {_NEW_FACT})
            SELECT received, inserted, received - inserted AS skipped FROM a, b""",
        "price_facts_star": f"""WITH {ID_FACTS},{PRODUCTS.format(source='clean')}
            SELECT brand, merchant_name, CAST(year(observed_at) AS BIGINT) AS observed_year,
                   CAST(quarter(observed_at) AS BIGINT) AS quarter,
                   isodow(observed_at) >= 6 AS is_weekend, count(*) AS observations,
                   CAST(sum(price) AS DOUBLE) AS total_price
            FROM facts JOIN products USING (product_id) JOIN sellers USING (merchant_id)
            GROUP BY 1, 2, 3, 4, 5""",
        "current_price": f"""WITH {FACTS},{CURRENT}
            SELECT {OFFER}, observed_at, {_double('price')} FROM current_offers""",
        "cheapest_merchant": f"""WITH {FACTS},{CURRENT}
            SELECT {OFFER}, observed_at, {_double('price')} FROM market WHERE price_rank = 1""",
        "competitor_comparison": f"""WITH {FACTS},{CURRENT}
            SELECT {OFFER}, {_double('price')}, offers, CAST(price_rank AS BIGINT) AS price_rank,
                   CAST(lowest AS DOUBLE) AS lowest_price,
                   CAST(price - lowest AS DOUBLE) AS gap_to_lowest,
                   {_pct('(price - lowest)', 'lowest')} AS gap_pct
            FROM market""",
        "avg_competitor_price": f"""WITH {FACTS},{CURRENT},
            others AS (
              SELECT *, offers - 1 AS competitors,
                     CASE WHEN offers > 1
                          THEN CAST(total - price AS DOUBLE) / (offers - 1) END AS competitor_avg
              FROM market
            )
            SELECT {OFFER}, {_double('price')}, competitors, competitor_avg,
                   CAST(price AS DOUBLE) - competitor_avg AS gap_to_competitors
            FROM others""",
        "avg_price_across_competitors": f"""WITH {FACTS},{CURRENT}
            SELECT product_id, currency, condition, count(*) AS offers,
                   CAST(min(price) AS DOUBLE) AS lowest_price,
                   CAST(max(price) AS DOUBLE) AS highest_price,
                   CAST(sum(price) AS DOUBLE) / count(*) AS avg_price
            FROM current_offers GROUP BY 1, 2, 3""",
        "price_trend_monthly": _trend("month"),
        "price_trend_daily": _trend("day"),
        "lowest_recorded_price": _extreme("ASC"),
        "highest_recorded_price": _extreme("DESC"),
        "price_history_view": _change(FACTS) + f" ORDER BY {OFFER}, {ORDER}",
        "price_change_feed": _change(FACTS),
        "previous_price": f"WITH {EVENT_FACTS},{SEQUENCE} SELECT {previous} FROM seq",
        "price_change": _change(EVENT_FACTS),
        "price_change_points": f"""WITH {EVENT_FACTS},{SEQUENCE}
            SELECT {previous} FROM seq
            WHERE previous_price IS NULL OR price <> previous_price""",
        "price_change_frequency": f"""WITH {EVENT_FACTS},{SEQUENCE},
            counts AS (
              SELECT merchant, count(*) AS observations, count(previous_price) AS pairs,
                     {_count('price <> previous_price')} AS changes
              FROM seq GROUP BY merchant
            )
            SELECT *, CAST(changes AS DOUBLE) / NULLIF(pairs, 0) AS change_rate FROM counts""",
        "price_fluctuation": f"""WITH {EVENT_FACTS},{SEQUENCE},
            stats AS (
              SELECT product_id, currency, condition, count(*) AS observations,
                     min(price) AS lo, max(price) AS hi,
                     {_count('price <> previous_price')} AS changes,
                     round(stddev_samp(CAST(price AS DOUBLE)), 6) AS price_stddev
              FROM seq GROUP BY 1, 2, 3
            )
            SELECT product_id, currency, condition, observations, changes, price_stddev,
                   CAST(lo AS DOUBLE) AS min_price, CAST(hi AS DOUBLE) AS max_price,
                   CAST(hi - lo AS DOUBLE) AS price_range, {_pct('(hi - lo)', 'lo')} AS range_pct
            FROM stats""",
        "top_price_increases": _top(PAIR, FACTS, ">", "DESC"),
        "top_price_decreases": _top(PAIR, FACTS, "<", "ASC"),
        "top_price_increases_since_first": _top(FIRST_PAIR, EVENT_FACTS, ">", "DESC"),
        "run_ledger": f"WITH {RUNS} SELECT *, true AS ended FROM runs",
        "runs_recovered": f"""WITH {FACTS}
            SELECT 1::BIGINT AS run_id, 'FAILED' AS status, 0::BIGINT AS records_received, 0::BIGINT AS records_validated,
                   0::BIGINT AS records_transformed, 0::BIGINT AS records_loaded,
                   'The run ended without a result' AS error_message
            UNION ALL
            SELECT 2, 'SUCCESS', count(*), count(*) FILTER (TRY_CAST(amount_min AS DOUBLE) >= 0
                     AND TRY_CAST(amount_max AS DOUBLE) >= TRY_CAST(amount_min AS DOUBLE)),
                   (SELECT count(*) FROM clean), (SELECT count(*) FROM facts), NULL
            FROM raw""",
        "products_appended": f"""WITH {CLEAN},
            loads AS (SELECT *, date_seen >= TIMESTAMP '{EARLIER_LOAD}' AS late FROM clean),
            a AS (WITH {PRODUCTS.format(source='(SELECT * FROM loads WHERE NOT late)')} SELECT * FROM products),
            b AS (WITH {PRODUCTS.format(source='(SELECT * REPLACE (upper(product_name) AS product_name) FROM loads WHERE late)')}
                  SELECT * FROM products)
            SELECT COALESCE(b.product_id, a.product_id) AS product_id,
                   CASE WHEN b.product_id IS NULL THEN a.product_name ELSE b.product_name END AS product_name,
                   CASE WHEN b.product_id IS NULL THEN a.brand ELSE b.brand END AS brand,
                   CASE WHEN b.product_id IS NULL THEN a.category ELSE b.category END AS category,
                   a.product_id IS NOT NULL AND b.product_id IS NOT NULL AS updated
            FROM a FULL JOIN b ON a.product_id = b.product_id""",
        "price_ids": f"""WITH {FACTS},
            sizes AS (SELECT count(*) FILTER (observed_at < TIMESTAMP '{EARLIER_LOAD}') AS n, count(*) AS total FROM facts)
            SELECT 1::BIGINT AS load, n AS facts, n AS ids, 1::BIGINT AS first_id, n AS last_id FROM sizes
            UNION ALL SELECT 2, total - n, total - n, n + 1, total FROM sizes""",
        "rejects_replayed": f"""WITH {FACTS},
            waiting AS (
              SELECT reject_reason, price_problem IN ('price_range', 'price_negative') AND len(list_filter(string_split(dates, ','),
                       lambda piece: TRY_CAST(trim(piece) AS TIMESTAMP) IS NOT NULL)) > 0 AS loaded
              FROM observed WHERE reject_reason IS NOT NULL
            ),
            again AS (
              SELECT product_id, merchant, unnest(string_split(dates, ',')) AS piece, price_max AS price_min,
                     CASE price_problem WHEN 'price_range' THEN price_min ELSE price_max END AS price_max, currency, condition
              FROM priced WHERE price_problem IN ('price_range', 'price_negative')
            ),
            more AS (
              SELECT *, TRY_CAST(trim(piece) AS TIMESTAMP) AS date_seen, (price_min + price_max) / 2 AS price FROM again
            ),
            every AS (
              SELECT * FROM facts UNION
              SELECT product_id, merchant, date_seen, {_money('price')}, {_money('price_min')}, {_money('price_max')},
                     COALESCE(currency, ''), COALESCE(condition, '')
              FROM more WHERE date_seen IS NOT NULL AND product_id <> '' AND merchant IS NOT NULL
            )
            SELECT reject_reason, count(*) AS rejects, count(*) FILTER (loaded) AS loaded,
                   (SELECT count(*) FROM every) AS stored_facts
            FROM waiting GROUP BY reject_reason""",
        "run_summary": f"""WITH {RUNS}
            SELECT status, count(*) AS runs,
                   CAST(sum(records_received) AS BIGINT) AS records_received,
                   CAST(sum(records_validated) AS BIGINT) AS records_validated,
                   CAST(sum(records_transformed) AS BIGINT) AS records_transformed,
                   CAST(sum(records_loaded) AS BIGINT) AS records_loaded
            FROM runs GROUP BY status""",
        "pipeline_load": f"""WITH {FACTS},{PRODUCTS.format(source='clean')}
            SELECT product_id, product_name, merchant, observed_at,
                   {_double('price', 'price_min', 'price_max')}, currency, condition,
                   CAST(year(observed_at) AS BIGINT) AS observed_year,
                   CAST(month(observed_at) AS BIGINT) AS observed_month
            FROM facts JOIN products USING (product_id)""",
        "pipeline_runs": f"""WITH {FACTS},
            received AS (SELECT count(*) AS n,
                                count(*) FILTER (TRY_CAST(amount_min AS DOUBLE) >= 0
                                  AND TRY_CAST(amount_max AS DOUBLE) >= TRY_CAST(amount_min AS DOUBLE)) AS valid
                         FROM raw),
            cleaned AS (SELECT count(*) AS n FROM clean),
            stored AS (SELECT count(*) AS n FROM facts)
            SELECT 1::BIGINT AS run_id, 'FAILED' AS status, n AS records_received,
                   0::BIGINT AS records_validated, 0::BIGINT AS records_transformed,
                   0::BIGINT AS records_loaded
            FROM received
            UNION ALL
            SELECT CAST(run AS BIGINT) AS run_id, 'SUCCESS' AS status,
                   received.n AS records_received, received.valid AS records_validated,
                   cleaned.n AS records_transformed,
                   CASE WHEN run = 2 THEN stored.n ELSE 0 END AS records_loaded
            FROM received, cleaned, stored, (VALUES (2), (3)) AS r(run)""",
        "incremental_load": _EVENT_ROWS,
        "incremental_replay": _EVENT_ROWS,
        "incremental_mixed_files": _EVENT_ROWS,
    }
    found["incremental_rejects"] = found["quarantine"]
    found["incremental_runs"] = f"""WITH {FACTS},
        part AS (SELECT * FROM (VALUES (1::BIGINT, '[0-4]$'), (2::BIGINT, '[5-9]$')) AS p(run_id, ids))
        SELECT run_id, 'SUCCESS' AS status,
               (SELECT count(*) FROM raw WHERE regexp_matches(id, ids)) AS records_received,
               (SELECT count(*) FROM raw WHERE regexp_matches(id, ids)
                  AND TRY_CAST(amount_min AS DOUBLE) >= 0
                  AND TRY_CAST(amount_max AS DOUBLE) >= TRY_CAST(amount_min AS DOUBLE)) AS records_validated,
               (SELECT count(*) FROM clean WHERE regexp_matches(product_id, ids)) AS records_transformed,
               (SELECT count(*) FROM facts WHERE regexp_matches(product_id, ids)) AS records_loaded
        FROM part"""
    sliced = ["cheapest_merchant", "competitor_comparison", "price_change_feed", "previous_price", "price_fluctuation"]
    return found | {f"{name}_sliced": found[name] for name in sliced}
