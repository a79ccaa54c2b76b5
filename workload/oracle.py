"""The same results as ANSI SQL over the test tables, for a second engine.

Periods are written out here instead of taken from the library, so that a
mistake in its month arithmetic cannot hide.
"""

from __future__ import annotations

# The periods of reporting date 2001-08-15, newest first.
MONTHS = [
    (200107, "Jul", "2001"), (200106, "Jun", "2001"), (200105, "May", "2001"),
    (200104, "Apr", "2001"), (200103, "Mar", "2001"), (200102, "Feb", "2001"),
    (200101, "Jan", "2001"), (200012, "Dec", "2000"), (200011, "Nov", "2000"),
    (200010, "Oct", "2000"), (200009, "Sep", "2000"), (200008, "Aug", "2000"),
]
CURRENT = 200108
YTD = (200101, 200107)
LAST_12 = (200008, 200107)
LAST_4 = (200104, 200107)
YEARS = [2000, 1999, 1998]

SALES = """
sales AS (
  SELECT CAST(l_partkey AS VARCHAR) AS "ISBN",
         CAST(year(o_orderdate) AS INTEGER) AS "YEAR",
         CAST(month(o_orderdate) AS INTEGER) AS "MONTH",
         CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS ym,
         p_name AS "TITLE",
         c_name AS "NAMECUST",
         CASE WHEN l_returnflag = 'R' THEN -CAST(trunc(l_quantity) AS BIGINT)
              ELSE CAST(trunc(l_quantity) AS BIGINT) END AS "NETUNITS",
         CAST(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END
              * CAST(CAST(l_extendedprice AS DECIMAL(12,2))
                     * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)))
                     AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS "NETAMT",
         CASE WHEN c_custkey % 17 <> 0 THEN c_mktsegment END AS "SALES_CATEGORY",
         l_linestatus = 'F' AS is_a,
         CAST(c_nationkey AS VARCHAR) AS hq,
         CAST(c_custkey AS VARCHAR) AS sl,
         c_nationkey, c_custkey, l_partkey, l_linenumber, l_quantity,
         l_returnflag, o_orderdate,
         CASE WHEN l_returnflag = 'N' THEN 'N' ELSE 'Y' END AS ips,
         o_orderpriority AS class
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey
)"""
WINDOW = f"recent AS (SELECT * FROM sales WHERE ym >= 199801 AND ym < {CURRENT})"
COMPLETE = f"complete AS (SELECT * FROM sales WHERE ym < {CURRENT})"

# Cleaned rows of the raw file: text without white space, title filled.
RAW = """
raw AS (
  SELECT lpad(CAST(l_partkey AS VARCHAR), 13, '0') AS "ISBN",
         CASE WHEN l_linenumber <> 1 THEN "YEAR" END AS "YEAR",
         CASE WHEN l_linenumber <> 1 THEN "MONTH" END AS "MONTH",
         "TITLE", "NAMECUST", ips AS "IPS Sale",
         hq AS "HQ Account Number", sl AS "SL Account Number",
         CAST(round_even(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END
                         * (l_quantity + l_linenumber / 2.0), 0) AS BIGINT) AS "NETUNITS",
         "NETAMT", class AS "SL Class of Trade"
  FROM sales
)"""
RAW_KEYS = (
    '"ISBN", "YEAR", "MONTH", "TITLE", "NAMECUST", "IPS Sale", '
    '"HQ Account Number", "SL Account Number"'
)


def _with(*parts: str, body: str) -> str:
    return f"WITH {', '.join(parts)}\n{body}"


def _units(name: str, span: tuple[int, int], measure: str = "NETUNITS") -> str:
    low, high = span
    return (
        f'CAST(coalesce(sum(CASE WHEN ym BETWEEN {low} AND {high} THEN "{measure}" END), 0)'
        f' AS BIGINT) AS "{name}"'
    )


def _money(name: str, span: tuple[int, int], measure: str = "NETAMT") -> str:
    low, high = span
    return (
        f'CAST(coalesce(sum(CASE WHEN ym BETWEEN {low} AND {high} THEN "{measure}" END), 0)'
        f' AS DOUBLE) AS "{name}"'
    )


def _year(year: int) -> tuple[int, int]:
    return year * 100 + 1, year * 100 + 12


def _months(style: str, measure: str = "NETUNITS") -> list[str]:
    return [
        _units(style.format(mon=mon, yyyy=yyyy, yy=yyyy[2:]), (period, period), measure)
        for period, mon, yyyy in MONTHS
    ]


def _years(style: str, count: int = 3, measure: str = "NETUNITS") -> list[str]:
    return [_units(style.format(year), _year(year), measure) for year in YEARS[:count]]


def _quoted(names: list[str]) -> str:
    return ", ".join(f'"{name}"' for name in names)


def _grouped(source: str, keys: list[str], cells: list[str]) -> str:
    columns = ",\n       ".join([_quoted(keys), *cells])
    return f"SELECT {columns}\nFROM {source}\nGROUP BY {_quoted(keys)}"


G4 = ["ISBN", "TITLE", "NAMECUST", "SALES_CATEGORY"]
COMBINED = [
    _units("12M_UNITS", LAST_12),
    _money("12M_DOLLARS", LAST_12),
    _units("YTD_UNITS", YTD),
    _money("YTD_DOLLARS", YTD),
    *_months("NET_UNITS_{mon}_{yyyy}"),
    *_years("UNITS_{}"),
    _units("4M_UNITS", LAST_4),
    _money("4M_DOLLARS", LAST_4),
]
COMBINED_NAMES = [cell.rsplit('AS "', 1)[1][:-1] for cell in COMBINED]
DISTRIBUTOR = [
    _units("12M_UNITS", LAST_12),
    _money("12M_DOLLARS", LAST_12),
    _units("YTD_UNITS", YTD),
    _money("YTD_DOLLARS", YTD),
    *_months("NET_UNITS_{mon}_{yyyy}"),
    *_years("NET_UNITS_{}"),
]
TITLES = [
    _money("YTD_DOLLARS", YTD),
    _units("YTD_UNITS", YTD),
    *_months("{mon}-{yy}"),
    *_years("{}-UNITS"),
    _units("12M_UNITS", LAST_12),
    _money("12M_DOLLARS", LAST_12),
]

PRODUCTS = """
products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS "ISBN", p_type, p_brand, p_size, p_retailprice,
         CASE WHEN p_size > 25 THEN 'FALL' ELSE 'SPRING' END AS season,
         CASE WHEN p_size <> 7 THEN p_brand END AS sub_pub
  FROM part
)"""
TARGETS = """
targets AS (
  SELECT CAST(c_custkey AS VARCHAR) AS account,
         CAST(c_acctbal AS DECIMAL(18,4)) AS target,
         CAST(1 AS DECIMAL(4,1)) + CAST(c_custkey % 5 AS DECIMAL(4,1)) * CAST(0.1 AS DECIMAL(4,1))
           AS ratio
  FROM customer
  WHERE c_custkey % 11 <> 0 AND c_custkey % 13 <> 0
)"""
# Whole currency units per account, scaled row by row.
SCALED = """
scaled AS (
  SELECT facts.*, abs(amount) * coalesce(ratio, 1) AS target_amount, target
  FROM (SELECT is_a, CASE WHEN is_a THEN hq ELSE sl END AS account, "NAMECUST",
               "SALES_CATEGORY", ym, CAST(trunc("NETAMT") AS BIGINT) AS amount
        FROM {source}) facts
  LEFT JOIN targets ON facts.account = targets.account
)"""
CUSTOMER_CELLS = [
    *_months("{mon}_{yy} Actual", "amount"),
    _units("12M_ROLLING_ACTUAL", LAST_12, "amount"),
    _units("YTD_ACTUAL", YTD, "amount"),
    *_years("{}_ACTUAL", 2, "amount"),
    'coalesce(sum(CASE WHEN ym = 200107 THEN target_amount END), 0) AS "Jul_01 Target"',
    f'coalesce(sum(CASE WHEN ym BETWEEN {YTD[0]} AND {YTD[1]} THEN target_amount END), 0)'
    ' AS "YTD_TARGET"',
]
CUSTOMERS = [
    SALES,
    WINDOW,
    TARGETS,
    SCALED.format(source="recent"),
    f"""
measured AS (
  {_grouped("scaled", ["NAMECUST", "SALES_CATEGORY"], CUSTOMER_CELLS)}
)""",
    """
planned AS (
  SELECT "NAMECUST", "SALES_CATEGORY", coalesce(sum(target), 0) AS target
  FROM (SELECT DISTINCT is_a, account, "NAMECUST", "SALES_CATEGORY", target FROM scaled)
  GROUP BY 1, 2
)""",
    """
customers AS (
  SELECT measured.*, planned.target
  FROM measured JOIN planned
    ON measured."NAMECUST" = planned."NAMECUST"
   AND measured."SALES_CATEGORY" IS NOT DISTINCT FROM planned."SALES_CATEGORY"
)""",
]
CAPTURE = (
    'round(CAST("YTD_ACTUAL" AS DOUBLE) / nullif(CAST("YTD_TARGET" AS DOUBLE), 0) * 100, 1)'
    ' AS "Capture_Rate"'
)
REMAINING = 'CAST(trunc(target - "YTD_ACTUAL") AS BIGINT) AS "Target_Remaining"'


def _whole(expression: str, name: str) -> str:
    return f'CAST(trunc({expression}) AS BIGINT) AS "{name}"'


TARGET_REPORT = f"""
SELECT "SALES_CATEGORY" AS "Category",
       CASE WHEN EXISTS (SELECT 1 FROM recent r WHERE r.is_a AND r."NAMECUST" = c."NAMECUST")
             AND EXISTS (SELECT 1 FROM recent r WHERE NOT r.is_a AND r."NAMECUST" = c."NAMECUST")
            THEN "NAMECUST" || '~' ELSE "NAMECUST" END AS "Customer",
       {_whole('"Jul_01 Target"', "Jul_01 Target")},
       {", ".join(f'"{mon}_{yyyy[2:]} Actual"' for _, mon, yyyy in MONTHS)},
       "12M_ROLLING_ACTUAL",
       {_whole("target", "2001_Target")},
       {_whole('"YTD_TARGET"', "YTD_TARGET")},
       "YTD_ACTUAL", {CAPTURE}, {REMAINING}, "2000_ACTUAL", "1999_ACTUAL",
       n_name AS "CITY", r_name AS "STATE"
FROM customers c
LEFT JOIN (SELECT c_name, n_name, r_name FROM customer
           JOIN nation ON c_nationkey = n_nationkey
           JOIN region ON n_regionkey = r_regionkey) place
  ON c."NAMECUST" = place.c_name"""

BACKORDERS = """
SELECT p_name AS "TITLE", CAST(l_partkey AS VARCHAR) AS "ISBN",
       CAST(sum(CAST(trunc(l_quantity) AS BIGINT)) AS BIGINT) AS "QTY"
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN part ON l_partkey = p_partkey
WHERE o_orderstatus = 'P' AND (l_linestatus <> 'F' OR l_quantity <> 0)
GROUP BY 1, 2"""

INGESTED = f"""
SELECT {RAW_KEYS}, CAST(sum("NETUNITS") AS BIGINT) AS "NETUNITS",
       CAST(sum("NETAMT") AS DOUBLE) AS "NETAMT",
       min("SL Class of Trade") AS "SL Class of Trade"
FROM raw
WHERE "YEAR" IS NOT NULL
GROUP BY {RAW_KEYS}"""

UNION_AGGREGATE = """
SELECT "YEAR", "MONTH", "ISBN", "TITLE", "NAMECUST", "SALES_CATEGORY",
       CAST(sum("NETUNITS") AS BIGINT) AS "NETUNITS", CAST(sum("NETAMT") AS DOUBLE) AS "NETAMT"
FROM sales
GROUP BY 1, 2, 3, 4, 5, 6"""


def _null_zero() -> str:
    cells = ", ".join(
        f'CASE WHEN "SALES_CATEGORY" IS NULL THEN 0 ELSE "{name}" END AS "{name}"'
        for name in COMBINED_NAMES
    )
    return _with(
        SALES,
        COMPLETE,
        f"m AS ({_grouped('complete', G4, COMBINED)})",
        body=f"SELECT {_quoted(G4)}, {cells} FROM m",
    )


def _everyone(source: str, keys: list[str]) -> str:
    cells = [_units("ALL_ACCTS_12M_UNITS", LAST_12), _money("ALL_ACCTS_12M_DOLLARS", LAST_12)]
    return f"everyone AS ({_grouped(source, keys, cells)})"


def _union(rows: list[str]) -> str:
    return "\nUNION ALL\n".join(rows)


def _column_totals() -> str:
    rows = [
        'SELECT \'N_ROWS\' AS "CHECK_NAME", CAST(count(*) AS DOUBLE) AS "TOTAL" FROM m',
        *(
            f'SELECT \'{name}\' AS "CHECK_NAME", CAST(sum("{name}") AS DOUBLE) AS "TOTAL" FROM m'
            for name in COMBINED_NAMES
        ),
    ]
    exact = [cell.replace("AS DOUBLE)", "AS DECIMAL(38,4))") for cell in COMBINED]
    return _with(
        SALES, COMPLETE, f"m AS ({_grouped('complete', G4, exact)})", body=_union(rows)
    )


GROUPED = """grouped AS (
  SELECT "ISBN", "YEAR", "MONTH", "NAMECUST", CAST(sum("NETUNITS") AS BIGINT) AS "NETUNITS",
         sum("NETAMT") AS "NETAMT"
  FROM sales GROUP BY 1, 2, 3, 4)"""


def _sign_profile(source: str = "sales", *parts: str) -> str:
    signs = {"NEGATIVE": "<", "ZERO": "=", "POSITIVE": ">"}
    rows = [
        f"""SELECT '{measure}' AS "MEASURE", '{label}' AS "SIGN", count(*) AS "N_ROWS",
       CAST(coalesce(sum("{measure}"), 0) AS DOUBLE) AS "TOTAL"
FROM {source} WHERE "{measure}" {sign} 0"""
        for measure in ("NETUNITS", "NETAMT")
        for label, sign in signs.items()
    ]
    return _with(SALES, *parts, body=_union(rows))


def _ingest_checks() -> str:
    checks = {
        "N_ROWS": "count(*)",
        "UNITS": 'sum("NETUNITS")',
        "AMOUNT": 'sum("NETAMT")',
        "DROPPED_ROWS": 'count(*) FILTER (WHERE "YEAR" IS NULL)',
        "DROPPED_UNITS": 'coalesce(sum("NETUNITS") FILTER (WHERE "YEAR" IS NULL), 0)',
        "DROPPED_AMOUNT": 'coalesce(sum("NETAMT") FILTER (WHERE "YEAR" IS NULL), 0)',
        "INVALID_ISBN_ROWS": 'count(*) FILTER (WHERE length("ISBN") <> 13)',
    }
    rows = [
        f"""SELECT '{name}' AS "CHECK_NAME", CAST({sql} AS DOUBLE) AS "VALUE" FROM raw"""
        for name, sql in checks.items()
    ]
    return _with(SALES, RAW, body=_union(rows))


COMBINED_BODY = f"""SELECT "TITLE", "ISBN", "NAMECUST", "SALES_CATEGORY", p_type AS "TYPE",
       p_brand AS "PROD", p_type AS "WEBCAT2", 'About ' || p_type AS "WEBCAT2_DESCR",
       coalesce(sub_pub, '') AS "SUB", p_size AS "PUB_STATUS", p_retailprice AS "RETAIL",
       season AS "SEAS", coalesce("ALL_ACCTS_12M_UNITS", 0) AS "ALL_ACCTS_12M_UNITS",
       coalesce("ALL_ACCTS_12M_DOLLARS", 0) AS "ALL_ACCTS_12M_DOLLARS",
       {_quoted(COMBINED_NAMES)}
FROM m LEFT JOIN everyone USING ("ISBN") LEFT JOIN products USING ("ISBN")"""

MAPPED_NAME = """CASE WHEN c_nationkey = 0 THEN 'Group ' || c_mktsegment ELSE c_name END"""

ORACLE: dict[str, str] = {
    "lookback_scan": _with(
        SALES, WINDOW, body='SELECT "ISBN", "NAMECUST", "YEAR", "MONTH", "NETUNITS" FROM recent'
    ),
    "standardize": _with(
        SALES,
        body="""SELECT "ISBN", "TITLE", "NAMECUST",
       CASE WHEN "MONTH" <> 1 THEN "NETUNITS" END AS "NETUNITS",
       CAST("NETAMT" AS DOUBLE) AS "NETAMT", "SALES_CATEGORY", ym AS "YEARMONTH"
FROM sales""",
    ),
    "union_aggregate": _with(SALES, body=UNION_AGGREGATE),
    "distinct_keys": _with(SALES, body=f"SELECT DISTINCT {_quoted(G4)} FROM sales"),
    "ytd": _with(
        SALES,
        COMPLETE,
        body=_grouped(
            "complete",
            ["ISBN", "TITLE"],
            [_units("YTD_UNITS", YTD), _money("YTD_DOLLARS", YTD)],
        ),
    ),
    "months_12": _with(
        SALES,
        COMPLETE,
        body=_grouped(
            "complete", ["NAMECUST", "SALES_CATEGORY"], _months("NET_UNITS_{mon}_{yyyy}")
        ),
    ),
    "trailing_12m": _with(
        SALES,
        COMPLETE,
        body=_grouped(
            "complete",
            ["NAMECUST", "SALES_CATEGORY"],
            [_units("12M_UNITS", LAST_12), _money("12M_DOLLARS", LAST_12)],
        ),
    ),
    "trailing_4m": _with(
        SALES,
        COMPLETE,
        body=_grouped(
            "complete",
            ["ISBN", "TITLE"],
            [_units("4M_UNITS", LAST_4), _money("4M_DOLLARS", LAST_4)],
        ),
    ),
    "prior_years": _with(
        SALES, COMPLETE, body=_grouped("complete", ["ISBN", "SALES_CATEGORY"], _years("UNITS_{}"))
    ),
    "period_matrix": _with(SALES, COMPLETE, body=_grouped("complete", G4, COMBINED)),
    "period_matrix_null_zero": _null_zero(),
    "coarse_totals": _with(
        SALES,
        COMPLETE,
        _everyone("complete", ["ISBN", "TITLE"]),
        "m AS ("
        + _grouped(
            "complete", G4, [_units("12M_UNITS", LAST_12), _money("12M_DOLLARS", LAST_12)]
        )
        + ")",
        body="""SELECT m.*, "ALL_ACCTS_12M_UNITS", "ALL_ACCTS_12M_DOLLARS"
FROM m LEFT JOIN everyone USING ("ISBN", "TITLE")""",
    ),
    "category_lookup": _with(
        SALES,
        body="""SELECT "ISBN", sl AS "SL Account Number", hq AS "HQ Account Number", "NETUNITS",
       "SALES_CATEGORY" FROM sales WHERE is_a""",
    ),
    "name_mapping": _with(
        SALES,
        body=f"""SELECT {MAPPED_NAME} AS "NAMECUST", CAST(sum("NETUNITS") AS BIGINT) AS "NETUNITS"
FROM (SELECT sales.*, c_mktsegment, c_name FROM sales
      JOIN customer ON sales.c_custkey = customer.c_custkey) WHERE is_a GROUP BY 1""",
    ),
    "exclude_customer": _with(
        SALES,
        body="""SELECT "NAMECUST", CAST(sum("NETUNITS") AS BIGINT) AS "NETUNITS"
FROM sales WHERE NOT is_a AND "NAMECUST" NOT LIKE 'Customer#0000000%' GROUP BY 1""",
    ),
    "dedupe_first": """SELECT p_name, p_brand, p_type, p_size FROM (
  SELECT *, row_number() OVER (PARTITION BY p_name
    ORDER BY p_brand NULLS FIRST, p_type NULLS FIRST, p_size NULLS FIRST) AS n FROM part)
WHERE n = 1""",
    "duplicate_keys": """SELECT p_name, count(*) - 1 AS "SURPLUS_ROWS" FROM part
GROUP BY p_name HAVING count(*) > 1""",
    "first_attribute": _with(
        SALES,
        "recent AS (SELECT * FROM sales WHERE is_a AND ym < 200108)",
        body=_grouped(
            "recent",
            ["ISBN", "NAMECUST"],
            [_units("12M_UNITS", LAST_12), 'min(class) AS "SALES_CLASS"'],
        ),
    ),
    "title_fill": _with(
        SALES,
        body="""SELECT lpad(CAST(l_partkey AS VARCHAR), 13, '0') AS "EAN", "TITLE" AS "Title",
       count(*) AS "N_ROWS" FROM sales GROUP BY 1, 2""",
    ),
    "product_enrich": _with(
        SALES,
        COMPLETE,
        PRODUCTS,
        "m AS (" + _grouped("complete", ["ISBN"], [_units("12M_UNITS", LAST_12)]) + ")",
        body="""SELECT m.*, p_type AS "TYPE", p_brand AS "PROD", p_type AS "WEBCAT2",
       'About ' || p_type AS "WEBCAT2_DESCR", coalesce(sub_pub, '') AS "SUB", season AS "SEAS",
       p_size AS "PUB_STATUS", p_retailprice AS "RETAIL"
FROM m LEFT JOIN products USING ("ISBN")""",
    ),
    "normalize_key_regroup": """SELECT '978' || CAST(l_partkey AS VARCHAR) || '0' AS "ISBN",
       CAST(sum(CAST(trunc(l_quantity) AS BIGINT)) AS BIGINT) AS "NETUNITS"
FROM lineitem GROUP BY 1""",
    "repair_key": """SELECT p_partkey, "ISBN", coalesce(length("ISBN") <> 13, true) AS "IS_INVALID"
FROM (SELECT p_partkey,
        CASE WHEN p_size % 3 = 0 THEN
               replace(lpad(CAST(p_partkey AS VARCHAR), 13, '0') || '.0', '.0', '')
             WHEN p_size % 3 = 1 THEN '978' || CAST(p_partkey AS VARCHAR) || '12'
             WHEN p_size > 40 THEN NULL
             ELSE lpad(CAST(p_partkey AS VARCHAR), 13, '0') END AS "ISBN"
      FROM part)""",
    "product_semi_join": _with(
        SALES,
        WINDOW,
        body="""SELECT CAST(p_partkey AS VARCHAR) AS "ISBN", p_name AS "TITLE",
       p_type AS "PROD_TYPE"
FROM part WHERE p_partkey IN (SELECT l_partkey FROM recent WHERE is_a AND ym >= 200101)""",
    ),
    "active_only_inner": _with(
        SALES,
        WINDOW,
        body=_grouped("recent", ["ISBN", "TITLE"], TITLES)
        + f"\nHAVING count(*) FILTER (WHERE ym BETWEEN {YTD[0]} AND {YTD[1]}) > 0",
    ),
    "scale_targets": _with(
        SALES,
        COMPLETE,
        TARGETS,
        SCALED.format(source="complete"),
        body=f"""SELECT CASE WHEN is_a THEN 1 ELSE 2 END AS "CHANNEL", account AS "ACCOUNT",
       CAST(coalesce(sum(CASE WHEN ym BETWEEN {YTD[0]} AND {YTD[1]} THEN target_amount END), 0)
            AS DOUBLE) AS "YTD_TARGET",
       CAST(min(target) AS DOUBLE) AS "2001_Target"
FROM scaled GROUP BY 1, 2""",
    ),
    "shared_customers": _with(
        SALES,
        body="""SELECT "NAMECUST", "NAMECUST" || '~' AS "MARKED" FROM sales
GROUP BY "NAMECUST" HAVING count(DISTINCT is_a) = 2""",
    ),
    "capture_rate": _with(
        *CUSTOMERS,
        body=f'SELECT "NAMECUST", "SALES_CATEGORY", {CAPTURE}, {REMAINING} FROM customers',
    ),
    "top_customers": _with(
        *CUSTOMERS,
        body='SELECT "NAMECUST", "SALES_CATEGORY", "12M_ROLLING_ACTUAL" FROM customers',
    ),
    "city_state": """SELECT CASE WHEN c_custkey % 5 = 0 THEN c_name || '*' ELSE c_name END
         AS "NAMECUST", n_name AS "CITY", r_name AS "STATE"
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "backorders": BACKORDERS,
    "ingest_month": _with(SALES, RAW, body=INGESTED),
    "ingest_file": _with(SALES, RAW, body=INGESTED),
    "reload_history": _with(SALES, RAW, body=INGESTED),
    "ingest_checks": _ingest_checks(),
    "ingest_rerun_safe": _with(
        SALES,
        RAW,
        body="""SELECT "YEAR", "MONTH", CAST(sum("NETUNITS") AS BIGINT) AS "NETUNITS",
       CAST(sum("NETAMT") AS DOUBLE) AS "NETAMT"
FROM (SELECT "YEAR", "MONTH", "NETUNITS", "NETAMT" FROM sales WHERE is_a
      UNION ALL
      SELECT "YEAR", "MONTH", "NETUNITS", "NETAMT" FROM raw WHERE "YEAR" IS NOT NULL)
GROUP BY 1, 2""",
    ),
    "control_totals": _with(
        SALES,
        body=_union(
            [
                f"""SELECT '{name}' AS "CHECK_NAME", CAST(sum("{name}") AS DOUBLE) AS "BEFORE",
       CAST(sum("{name}") AS DOUBLE) AS "AFTER", CAST(0 AS DOUBLE) AS "DIFFERENCE" FROM sales"""
                for name in ("NETUNITS", "NETAMT")
            ]
        ),
    ),
    "column_totals": _column_totals(),
    "unmapped_audit": _with(
        SALES,
        body="""SELECT sl AS "SL Account Number", hq AS "HQ Account Number",
       count(*) AS "ROWS_WITHOUT"
FROM sales WHERE "SALES_CATEGORY" IS NULL GROUP BY 1, 2""",
    ),
    "null_counts": _with(
        SALES,
        body=_union(
            [
                f"""SELECT '{name}' AS "COLUMN_NAME",
       count(*) FILTER (WHERE "{name}" IS NULL) AS "N_NULLS" FROM sales"""
                for name in ("ISBN", "TITLE", "NAMECUST", "SALES_CATEGORY")
            ]
        ),
    ),
    "invalid_keys": """SELECT p_brand AS "ISBN", count(*) AS "N_ROWS" FROM part
WHERE p_size % 2 <> 0 AND length(p_brand) <> 13 GROUP BY 1""",
    "sign_profile": _sign_profile(),
    "sign_profile_grouped": _sign_profile("grouped", GROUPED),
    "sample_rows": _with(
        SALES,
        GROUPED,
        body=_union(
            [
                f"""(SELECT '{measure}' AS "MEASURE", '{label}' AS "SIGN",
       "ISBN", "YEAR", "MONTH", "NAMECUST", "NETUNITS", CAST("NETAMT" AS DOUBLE) AS "NETAMT"
FROM grouped WHERE "{measure}" {sign} 0
ORDER BY "ISBN", "YEAR", "MONTH", "NAMECUST" LIMIT 5)"""
                for measure in ("NETUNITS", "NETAMT")
                for label, sign in (("NEGATIVE", "<"), ("POSITIVE", ">"))
            ]
        ),
    ),
    "report_combined": _with(
        SALES,
        WINDOW,
        PRODUCTS,
        _everyone("recent", ["ISBN"]),
        f"m AS ({_grouped('recent', G4, COMBINED)})",
        body=COMBINED_BODY,
    ),
    "report_distributor": _with(
        SALES,
        "mine AS (SELECT *, hq AS \"HQ Account Number\", sl AS \"SL Account Number\","
        " ips AS \"IPS Sale\" FROM sales WHERE is_a AND ym >= 199801 AND ym < 200108)",
        PRODUCTS,
        _everyone("mine", ["ISBN", "TITLE"]),
        "m AS ("
        + _grouped(
            "mine",
            [
                "NAMECUST", "HQ Account Number", "SL Account Number", "IPS Sale",
                "SALES_CATEGORY", "ISBN", "TITLE",
            ],
            DISTRIBUTOR,
        )
        + ")",
        body="""SELECT m.*, p_type AS "PROD_TYPE", p_brand AS "PROD_CLASS", season AS "SEAS",
       sub_pub AS "SUBPUB", p_type AS "WEBCAT2", 'About ' || p_type AS "WEBCAT2_DESCR",
       p_retailprice AS "RETAIL_PRICE", "ALL_ACCTS_12M_UNITS", "ALL_ACCTS_12M_DOLLARS"
FROM m LEFT JOIN everyone USING ("ISBN", "TITLE") LEFT JOIN products USING ("ISBN")""",
    ),
    "report_targets": _with(*CUSTOMERS, body=TARGET_REPORT),
    "report_titles": _with(
        SALES,
        WINDOW,
        "whole AS (SELECT * REPLACE (CAST(trunc(\"NETAMT\") AS BIGINT) AS \"NETAMT\") FROM recent)",
        PRODUCTS,
        "waiting AS (SELECT \"ISBN\", CAST(sum(\"QTY\") AS BIGINT) AS \"QTYBO\""
        f" FROM ({BACKORDERS}) GROUP BY 1)",
        "m AS ("
        + _grouped(
            "whole",
            ["ISBN", "TITLE"],
            [cell.replace("AS DOUBLE)", "AS BIGINT)") for cell in TITLES],
        )
        + f"\nHAVING count(*) FILTER (WHERE ym BETWEEN {YTD[0]} AND {YTD[1]}) > 0)",
        body="""SELECT m.*, p_type AS "PROD_TYPE", season AS "SEASON", sub_pub AS "SUB_PUB",
       p_retailprice AS "RETAIL_PRICE", p_size * 10 AS "QTY_ON_HAND",
       CAST(p_size AS DOUBLE) AS "QTY_ON_ORDER", "QTYBO"
FROM m LEFT JOIN products USING ("ISBN") LEFT JOIN waiting USING ("ISBN")""",
    ),
    "reference_map": """SELECT CAST(c_custkey AS VARCHAR) AS "SL Account Number",
       CAST(c_nationkey AS VARCHAR) AS "HQ Account Number",
       c_mktsegment AS "MASTER SALES CATEGORY"
FROM customer WHERE c_custkey % 17 <> 0""",
    "channel_sources": _with(
        SALES,
        WINDOW,
        body=f"""SELECT CASE WHEN is_a THEN {MAPPED_NAME} ELSE c_name END AS "NAMECUST",
       "SALES_CATEGORY", CAST(sum("NETUNITS") AS BIGINT) AS "NETUNITS"
FROM (SELECT recent.*, c_mktsegment, c_name FROM recent
      JOIN customer ON recent.c_custkey = customer.c_custkey)
WHERE is_a OR c_name NOT LIKE 'Customer#0000000%'
GROUP BY 1, 2""",
    ),
    "daily_refresh": _with(
        SALES,
        WINDOW,
        f"""named AS (
  SELECT * REPLACE (CASE WHEN is_a THEN {MAPPED_NAME} ELSE c_name END AS "NAMECUST")
  FROM (SELECT recent.*, c_mktsegment, c_name FROM recent
        JOIN customer ON recent.c_custkey = customer.c_custkey))""",
        body=f"""SELECT *, "N_ROWS" AS "SEEN_ROWS", "TOTAL_12M" AS "SEEN_12M" FROM (
SELECT 'COMBINED_SALES_REPORT' AS "REPORT",
       count(DISTINCT ("ISBN", "TITLE", "NAMECUST", "SALES_CATEGORY")) AS "N_ROWS",
       CAST(sum("NETUNITS") FILTER (WHERE ym >= {LAST_12[0]}) AS BIGINT) AS "TOTAL_12M"
FROM named
UNION ALL
SELECT 'TARGET_REPORT', count(DISTINCT ("NAMECUST", "SALES_CATEGORY")),
       CAST(sum(CAST(trunc("NETAMT") AS BIGINT)) FILTER (WHERE ym >= {LAST_12[0]}) AS BIGINT)
FROM named)""",
    ),
}

# Both channels as the full refresh sees them: mapped names, one customer left out.
NAMED = f"""
named AS (
  SELECT * REPLACE (CASE WHEN is_a THEN {MAPPED_NAME} ELSE c_name END AS "NAMECUST")
  FROM (SELECT recent.*, c_mktsegment, c_name FROM recent
        JOIN customer ON recent.c_custkey = customer.c_custkey)
  WHERE is_a OR c_name NOT LIKE 'Customer#0000000%')"""

ORACLE |= {
    "ingest_file_by_name": ORACLE["ingest_month"],
    "ingest_past_nulls": ORACLE["ingest_month"],
    "history_file": ORACLE["ingest_month"],
    "backorder_file": ORACLE["backorders"],
    "stored_distributor": ORACLE["report_distributor"],
    "stored_titles": ORACLE["report_titles"],
    "report_combined_rollup": ORACLE["report_combined"],
    "target_file": _with(
        TARGETS,
        body="""SELECT account AS "ACCOUNT", CAST(ratio AS DOUBLE) AS "RATIO",
       CAST(target AS DOUBLE) AS "TARGET" FROM targets""",
    ),
    "name_map_file": """SELECT c_name AS "SOURCE_NAME", 'Group ' || c_mktsegment AS "TARGET_NAME"
FROM customer WHERE c_nationkey = 0""",
    "dimensions_past_nulls": _with(
        SALES,
        body=f"""SELECT "SALES_CATEGORY", {MAPPED_NAME} AS "NAMECUST", n_name AS "CITY",
       r_name AS "STATE", p_type AS "PROD_TYPE", c_name AS "COMPANY",
       CAST(sum("NETUNITS") AS BIGINT) AS "NETUNITS"
FROM (SELECT sales.*, c_mktsegment, c_name, n_name, r_name, p_type FROM sales
      JOIN customer ON sales.c_custkey = customer.c_custkey
      JOIN nation ON customer.c_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey
      JOIN part ON l_partkey = p_partkey)
WHERE is_a GROUP BY 1, 2, 3, 4, 5, 6""",
    ),
    "daily_combined": _with(
        SALES,
        WINDOW,
        NAMED,
        PRODUCTS,
        _everyone("recent", ["ISBN"]),
        f"m AS ({_grouped('named', G4, COMBINED)})",
        body=COMBINED_BODY,
    ),
    "daily_targets": _with(
        SALES,
        WINDOW,
        NAMED,
        TARGETS,
        SCALED.format(source="named"),
        *CUSTOMERS[4:],
        body=TARGET_REPORT.replace("FROM recent r", "FROM named r"),
    ),
}

# Raw lines whose amount can be read.
READABLE = "FROM sales WHERE l_partkey % 10 <> 3\n)"

ORACLE |= {
    "loads_combined": ORACLE["daily_combined"],
    "loads_replayed": ORACLE["daily_targets"],
    "loads_repeated": _with(
        SALES,
        'june AS (SELECT count(*) AS n, CAST(sum("NETUNITS") AS BIGINT) AS units, '
        'count(*) FILTER (WHERE "NETUNITS" > 0) AS n_sold, '
        'CAST(sum("NETUNITS") FILTER (WHERE "NETUNITS" > 0) AS BIGINT) AS sold '
        "FROM sales WHERE is_a AND ym = 200106)",
        body="""SELECT 'first' AS "STEP", 'taken' AS "LOAD", n AS "N_ROWS", units AS "NETUNITS" FROM june
UNION ALL SELECT 'again', 'taken', n, units FROM june
UNION ALL SELECT 'other name', 'refused', n, units FROM june
UNION ALL SELECT 'corrected', 'taken', n_sold, sold FROM june
UNION ALL SELECT 'rest', 'taken', n, units FROM june""",
    ),
    "dedupe_first_hashed": ORACLE["dedupe_first"],
    "skewed_lookup": _with(
        SALES,
        body="""SELECT k AS "ISBN", p_name AS "TITLE", CASE WHEN p_size <> 7 THEN p_brand END AS "SUB_PUB",
       CAST(sum("NETUNITS") AS BIGINT) AS "NETUNITS"
FROM (SELECT *, CASE WHEN "MONTH" % 3 = 0 THEN '1' ELSE "ISBN" END AS k FROM sales)
LEFT JOIN part ON k = CAST(p_partkey AS VARCHAR)
GROUP BY 1, 2, 3""",
    ),
    "published_version": ORACLE["report_titles"],
    "ingest_unreadable": ORACLE["ingest_month"].replace("FROM sales\n)", READABLE),
    "unreadable_checks": ORACLE["ingest_checks"].replace("FROM sales\n)", READABLE)
    + """
UNION ALL
SELECT 'UNREADABLE_LINES', CAST((SELECT count(*) FROM sales WHERE l_partkey % 10 = 3)
  + (SELECT count(*) FROM supplier) AS DOUBLE)""",
    "unreadable_lines": _with(
        SALES,
        body="""SELECT 'Net Invc' AS "REASON", count(*) AS "N_LINES" FROM sales WHERE l_partkey % 10 = 3
UNION ALL
SELECT 'number of fields', count(*) FROM supplier""",
    ),
    "few_products": _with(
        SALES,
        body="""SELECT "ISBN", "YEAR", "MONTH", CAST(sum("NETUNITS") AS BIGINT) AS "NETUNITS"
FROM sales WHERE is_a AND l_partkey IN
  (SELECT p_partkey FROM part WHERE p_size = 17 AND p_name LIKE '%a%')
GROUP BY 1, 2, 3""",
    ),
    "empty_lookup": _with(
        SALES,
        body="""SELECT "NAMECUST", CAST(NULL AS VARCHAR) AS "SALES_CATEGORY",
       CAST(sum("NETUNITS") AS BIGINT) AS "NETUNITS" FROM sales WHERE is_a GROUP BY 1""",
    ),
}
