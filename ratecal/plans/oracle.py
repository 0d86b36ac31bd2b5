"""For each registered query the same question as plain SQL over the test tables (DuckDB).

Written from the semantics, not from the DataFrame code: neighbours by ASOF joins, copies by
row_number, grids by cross joins, rounding by integer division.
"""

# Quotes, in the shape `TestTables.quotes` gives them; kind and bad_date say what the document form holds.
_QUOTES = """
quotes AS (
  SELECT concat_ws('-', lpad(CAST(l_orderkey AS VARCHAR), 12, '0'), CAST(l_linenumber AS VARCHAR),
                   CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS _id,
    lower(r_name) AS hotel_group, CAST(l_suppkey AS VARCHAR) AS hotel_id, s_name AS hotel_name,
    CASE WHEN l_partkey % 97 = 0 THEN '' ELSE lower(replace(s_name, '#', '-')) END AS hotel_name_key,
    lower(n_name) AS city, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
    o_orderdate + l_linenumber * INTERVAL '1' HOUR AS created_at,
    CAST(l_extendedprice AS DECIMAL(18,4)) AS cash_value,
    CASE WHEN l_partkey % 10 = 9 THEN 'EUR' ELSE 'USD' END AS currency,
    CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_quantity * 1000 AS DECIMAL(18,4)) END AS points,
    l_returnflag AS award_category, l_linestatus AS points_level,
    CASE WHEN l_partkey % 13 = 0 THEN 'scalar' WHEN l_partkey % 17 = 0 THEN 'missing'
         WHEN l_partkey % 23 = 0 THEN 'no number' ELSE 'object' END AS kind,
    l_partkey % 19 = 0 AS bad_date,
    CAST(o_orderdate + l_linenumber * INTERVAL '1' HOUR AS DATE) AS day
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

_DOCS = """
docs AS (
  SELECT * REPLACE (CASE WHEN bad_date THEN 'not a date' ELSE strftime(date, '%Y-%m-%d') END AS date),
    date AS stay, kind IN ('object', 'no number') AS is_object,
    CASE WHEN kind IN ('object', 'scalar') THEN cash_value END AS amount,
    CASE WHEN created_at < TIMESTAMP '2000-01-01' THEN 'archived_' ELSE '' END AS age
  FROM quotes
)"""

_TEMPLATES = """
seen AS (
  SELECT l_suppkey, year(l_shipdate) AS y, max(l_shipdate) AS seen, count(*) AS n FROM lineitem GROUP BY 1, 2
),
templates AS (
  SELECT lower(r_name) AS hotel_group, CASE WHEN (l_suppkey + y) % 29 = 0 THEN NULL ELSE s_name END AS hotel_name,
    CAST(l_suppkey AS VARCHAR) AS hotel_id,
    CASE WHEN (l_suppkey + y) % 3 = 0 THEN NULL ELSE concat('seen in ', y) END AS description,
    CAST(NULL AS VARCHAR) AS address, lower(n_name) AS city, lower(n_name) AS slug_city,
    CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS state_code,
    CASE WHEN (l_suppkey + y) % 5 = 0 THEN NULL ELSE CAST((l_suppkey + y) % 90 AS DOUBLE) END AS latitude,
    CAST((l_suppkey + y) % 180 AS DOUBLE) AS longitude,
    CASE WHEN (l_suppkey + y) % 7 = 0 THEN NULL ELSE 'USD' END AS currency,
    CAST(n AS INTEGER) AS review_count, CAST(s_acctbal AS DOUBLE) AS review_rating,
    CAST(NULL AS VARCHAR) AS country, CAST(NULL AS VARCHAR) AS country_code,
    CAST(NULL AS VARCHAR) AS telephone, CAST(NULL AS DOUBLE) AS chain_rating,
    CASE WHEN (l_suppkey + y) % 11 = 0 THEN NULL ELSE seen END AS created_at,
    concat('t-', y, '-', l_suppkey) AS _id
  FROM seen JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
rated AS (SELECT lower(replace(s_name, '#', '-')) AS hotel_name_key, lower(r_name) AS hotel_group,
    CAST(s_acctbal AS DECIMAL(18,4)) AS rating
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def _clean(name, price, where="", keys="hotel_group, hotel_name_key, date, day"):
    return f"""
{name} AS (
  SELECT *, date AS date_stay, day AS date_booked FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY created_at DESC, _id DESC) AS rn
    FROM quotes WHERE {price} > 1 {where}
  ) WHERE rn = 1
)"""


_VALID = "AND day <= date AND hotel_name_key <> ''"
_USD = "AND currency = 'USD'"
_IN_CITY = "AND (hotel_group, hotel_id) IN (SELECT (hotel_group, hotel_id) FROM templates WHERE slug_city = 'nation_19')"

_ALL = ",".join([_QUOTES, _clean("cash", "cash_value", _VALID + _USD), _clean("points", "points", _VALID)])
_CITY = ",".join(
    [_QUOTES, _TEMPLATES, _clean("cash", "cash_value", _VALID + _USD + _IN_CITY), _clean("points", "points", _VALID + _IN_CITY)]
)
_V1 = ",".join([_QUOTES, _clean("cash", "cash_value", "AND day <= date " + _USD), _clean("points", "points", "AND day <= date")])

_BOOKED_DAYS = """
booked_days AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-08-01', INTERVAL 1 DAY)) AS DATE) AS date_booked)"""

_SPINE = _BOOKED_DAYS + """,
spine AS (
  SELECT date_booked, CAST(unnest(generate_series(date_booked, date_booked + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS date_stay
  FROM booked_days
)"""

_GRID = _SPINE + """,
grid AS (
  SELECT s.date_booked, s.date_stay, CAST(s.date_stay - s.date_booked AS INTEGER) AS booking_window,
    h.hotel_group, h.hotel_name_key, c.cash_value AS cash, p.points
  FROM spine s CROSS JOIN (SELECT DISTINCT hotel_group, hotel_name_key FROM cash) h
  LEFT JOIN cash c ON c.date_booked = s.date_booked AND c.date_stay = s.date_stay
    AND c.hotel_name_key = h.hotel_name_key AND c.hotel_group = h.hotel_group
  LEFT JOIN points p ON p.date_booked = s.date_booked AND p.date_stay = s.date_stay
    AND p.hotel_name_key = h.hotel_name_key AND p.hotel_group = h.hotel_group
)"""

_GRID_V1 = _SPINE + """,
grid AS (
  SELECT s.date_booked, s.date_stay, CAST(s.date_stay - s.date_booked AS INTEGER) AS booking_window,
    h.hotel_group, h.city, h.hotel_name_key, c.cash_value AS cash, p.points
  FROM spine s CROSS JOIN (SELECT DISTINCT hotel_group, hotel_name_key, city FROM cash) h
  LEFT JOIN cash c ON c.date_booked = s.date_booked AND c.date_stay = s.date_stay AND c.hotel_name_key = h.hotel_name_key
  LEFT JOIN points p ON p.date_booked = s.date_booked AND p.date_stay = s.date_stay AND p.hotel_name_key = h.hotel_name_key
)"""

_GRID_SUMMARY = """SELECT {keys}, CAST(date_trunc('month', date_booked) AS DATE) AS month_booked,
  count(*) AS cells, count(cash) AS cash_cells, count(points) AS points_cells,
  CAST(sum(booking_window) AS BIGINT) AS windows, CAST(sum(cash) AS DOUBLE) AS cash,
  CAST(sum(cash * booking_window) AS DOUBLE) AS cash_windows, CAST(sum(points) AS DOUBLE) AS points
FROM grid GROUP BY ALL"""

# Cells that hold a price, by joins of the observed keys alone.
_CELLS = """
cells AS (
  SELECT hotel_group, hotel_name_key, date_stay, date_booked, CAST(date_stay - date_booked AS INTEGER) AS booking_window,
    c.cash_value AS cash, p.points
  FROM cash c FULL JOIN points p USING (hotel_group, hotel_name_key, date_stay, date_booked)
  WHERE (hotel_group, hotel_name_key) IN (SELECT (hotel_group, hotel_name_key) FROM cash)
    AND date_booked BETWEEN DATE '1995-01-01' AND DATE '2001-08-01' AND date_stay < date_booked + INTERVAL 1 YEAR
)"""

_BASE = _BOOKED_DAYS + """,
base AS (
  SELECT h.hotel_group, h.hotel_name_key, CAST(b.date_booked + o.days AS DATE) AS date_stay, b.date_booked,
    o.days AS booking_window, c.cash_value AS cash, p.points
  FROM booked_days b CROSS JOIN (VALUES (3), (7), (14), (30), (60), (90), (180)) o(days)
  CROSS JOIN (SELECT DISTINCT hotel_group, hotel_name_key FROM cash) h
  LEFT JOIN cash c ON c.hotel_group = h.hotel_group AND c.hotel_name_key = h.hotel_name_key
    AND c.date_booked = b.date_booked AND c.date_stay = b.date_booked + o.days
  LEFT JOIN points p ON p.hotel_group = h.hotel_group AND p.hotel_name_key = h.hotel_name_key
    AND p.date_booked = b.date_booked AND p.date_stay = b.date_booked + o.days
)"""


def _asof(name, source, table, value, op, prefix, gap):
    difference = {">": "a.date_booked - b.date_booked", "<": "b.date_booked - a.date_booked"}[op]
    return f"""
{name} AS (
  SELECT a.*, b.{value} AS {prefix}, CAST({difference} AS INTEGER) AS {gap}
  FROM {source} a ASOF LEFT JOIN {table} b ON a.hotel_group = b.hotel_group AND a.hotel_name_key = b.hotel_name_key
    AND a.date_stay = b.date_stay AND a.date_booked {op} b.date_booked
)"""


_PREV = ",".join([
    _asof("n1", "base", "cash", "cash_value", ">", "cash_prev", "cp_gap"),
    _asof("n2", "n1", "points", "points", ">", "points_prev", "pp_gap"),
])
_NEXT = ",".join([
    _asof("n1", "base", "cash", "cash_value", "<", "cash_next", "cn_gap"),
    _asof("n2", "n1", "points", "points", "<", "points_next", "pn_gap"),
])
_BOTH = ",".join([
    _asof("n1", "base", "cash", "cash_value", ">", "cash_prev", "cp_gap"),
    _asof("n2", "n1", "cash", "cash_value", "<", "cash_next", "cn_gap"),
    _asof("n3", "n2", "points", "points", ">", "points_prev", "pp_gap"),
    _asof("n4", "n3", "points", "points", "<", "points_next", "pn_gap"),
])


def _rounded(prev, pg, nxt, ng, unit):
    """Interpolation rounded half up, in integers: prices are counted in 1/10000, `unit` is the rounding step in those."""
    a, b = f"CAST({prev} * 10000 AS HUGEINT)", f"CAST({nxt} * 10000 AS HUGEINT)"
    one = f"((2 * coalesce({a}, {b}) + {unit}) // {2 * unit})"
    two = f"((2 * ({a} * {ng} + {b} * {pg}) + {unit} * ({pg} + {ng})) // ({2 * unit} * ({pg} + {ng})))"
    steps = f"CASE WHEN {prev} IS NOT NULL AND {nxt} IS NOT NULL THEN {two} ELSE {one} END"
    return f"CAST({steps} AS DECIMAL(18,4)) * {unit} / 10000"


_EST = _BASE + "," + _BOTH + f""",
est AS (
  SELECT *, CAST({_rounded('cash_prev', 'cp_gap', 'cash_next', 'cn_gap', 100)} AS DECIMAL(18,4)) AS cash_est,
    CAST({_rounded('points_prev', 'pp_gap', 'points_next', 'pn_gap', 10000)} AS DECIMAL(18,4)) AS points_est
  FROM n4
)"""

_SAMPLE = _EST + """,
sample AS (
  SELECT hotel_group, hotel_name_key, date_stay, date_booked, booking_window,
    coalesce(cash, cash_est) AS cash, coalesce(points, points_est) AS points,
    coalesce(cash, cash_est) IS NOT NULL AND coalesce(points, points_est) IS NOT NULL AS complete
  FROM est WHERE date_booked BETWEEN DATE '1998-01-01' AND DATE '1998-08-31'
    AND hotel_name_key NOT IN (SELECT hotel_name_key FROM rated WHERE rating < 500)
)"""


def _doubles(*columns):
    return "* REPLACE (" + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns) + ")"


_SAMPLE_OUT = f"SELECT {_doubles('cash', 'points')} FROM sample"
_CASH_RAW = "_id, hotel_group, hotel_id, hotel_name, hotel_name_key, city, date, created_at, CAST(cash_value AS DOUBLE) AS cash_value, currency, award_category"

_FIRST_GEN = "hotel_group, hotel_name_key, city, date_stay, date_booked"

# Copies: valid quotes numbered within hotel, category, stay and scrape day.
_RANKED = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY hotel_group, hotel_name_key, award_category, date, day
                               ORDER BY created_at DESC, _id DESC) AS rn
  FROM quotes WHERE currency = 'USD' AND cash_value > 1
)"""

# Archived cash documents with the collection they are in, and the same deduplicated.
_ARCHIVED = """
archived AS (
  SELECT *, concat('archived_hotel_calendar_cash_', hotel_group) AS input_table FROM docs WHERE age = 'archived_'
)"""


# What accounting finds in documents of two date formats whose amounts are in part missing, too large or cut off.
_PART = "CAST(split_part(_id, '-', 3) AS BIGINT)"
_DROPS = "('no price', 'price is no object', 'no points', 'stay date does not parse')"


def _judged(kind, reason, where=""):
    return f"""
judged AS (
  SELECT *, coalesce(reason IN {_DROPS}, FALSE) AS dropped FROM (
    SELECT * REPLACE (CASE WHEN NOT bad_date AND part % 5 = 0 THEN strftime(stay, '%d/%m/%Y') ELSE date END AS date),
      concat(age, 'hotel_calendar_{kind}', hotel_group) AS input_table, CASE {reason} END AS reason
    FROM (SELECT *, {_PART} AS part FROM docs) {where}
  )
)"""


_JUDGED = _judged("cash_", """WHEN kind = 'missing' THEN 'no price' WHEN kind = 'scalar' OR part % 37 = 0 THEN 'price is no object'
  WHEN bad_date THEN 'stay date does not parse' WHEN part % 41 = 0 THEN 'no amount' WHEN part % 31 = 0 THEN 'amount out of range'
  WHEN kind = 'no number' THEN 'amount is no number'""")
_JUDGED_POINTS = _judged("", "WHEN part % 11 = 0 THEN 'no points' WHEN bad_date THEN 'stay date does not parse'", "WHERE points IS NOT NULL")
_SET_ASIDE = "input_table, _id, hotel_group, created_at, date, reason, dropped FROM judged WHERE reason IS NOT NULL"


def _snapshots(source, name="snapshots", within=""):
    return f"""
{name} AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY {within} hotel_id, day, date ORDER BY _id DESC) AS second FROM (
      SELECT *, row_number() OVER (PARTITION BY {within} _id ORDER BY created_at DESC, date DESC, cash_value DESC) AS first FROM {source}
    ) WHERE first = 1
  ) WHERE second = 1
)"""


_CASH_ROW = """hotel_group, hotel_name, stay AS date, CASE WHEN kind = 'object' THEN CAST(cash_value AS DOUBLE) END AS cash_value,
  currency, created_at, award_category, hotel_name_key, hotel_id, _id"""
_POINTS_ROW = """hotel_group, hotel_name, stay AS date, CAST(points AS DOUBLE) AS points, created_at, award_category,
  points_level, hotel_name_key, hotel_id, _id"""


# The three runs that keys arrive in; all stay dates of the second are bad, so they count as one date.
_RESUMED = """
valid AS (
  SELECT * REPLACE (CASE WHEN run_id = '2' THEN 'not a date' ELSE date END AS date) FROM (
    SELECT d.*, CASE WHEN n < third THEN '1' WHEN n < 2 * third THEN '2' ELSE '3' END AS run_id
    FROM (SELECT *, CAST(split_part(_id, '-', 1) AS BIGINT) AS n FROM docs) d, (SELECT max(l_orderkey) // 3 AS third FROM lineitem)
  )
)"""

# Quotes of which a third lie in one stay, with one cash price for each time.
_SKEWED = """
skewed AS (
  SELECT * REPLACE (CASE WHEN hot THEN 'all' ELSE hotel_group END AS hotel_group, CASE WHEN hot THEN 'hot' ELSE hotel_name_key END AS hotel_name_key,
    CASE WHEN hot THEN DATE '1998-01-01' ELSE date END AS date)
  FROM (SELECT *, CAST(split_part(_id, '-', 1) AS BIGINT) % 3 = 0 AS hot FROM quotes)
),
timed AS (SELECT hotel_group, hotel_name_key, date, created_at, arg_max(cash_value, _id) AS cash_value FROM skewed GROUP BY 1, 2, 3, 4)"""


def _shares(where):
    names = ("sun", "mon", "tues", "wed", "thu", "fri", "sat")
    shares = ", ".join(
        f"CAST(sum(CASE WHEN extract(dow FROM created_at) = {i} THEN 1 END) AS DOUBLE) / count(*) AS pct_{name}"
        for i, name in enumerate(names)
    )
    return f"""SELECT hotel_group, hotel_name_key, count(*) AS n,
  CAST(sum(CASE WHEN extract(dow FROM created_at) = 2 THEN 1 END) AS BIGINT) AS tuesdays, {shares},
  min(created_at) AS min_date, max(created_at) AS max_date FROM quotes WHERE {where} GROUP BY 1, 2"""


def _error(price, key):
    return f"""SELECT {key}, count(*) AS n, CAST(sum({price}_est) AS DOUBLE) / CAST(sum({price}) AS DOUBLE) - 1 AS {price}_err
FROM est WHERE {price} IS NOT NULL AND {price}_est IS NOT NULL GROUP BY ALL"""


def _value(key, extra=""):
    return f"""SELECT hotel_group, {key} CAST(sum(cash) AS DOUBLE) / CAST(sum(points) AS DOUBLE) * 100.0 AS value_100_pts {extra}
FROM cells WHERE cash IS NOT NULL AND points IS NOT NULL GROUP BY ALL"""


def _mean_cents(value, condition):
    """Average in cents, rounded half up, of the rows that meet a condition."""
    chosen = f"CASE WHEN {condition} THEN CAST({value} * 10000 AS HUGEINT) END"
    return f"(2 * sum({chosen}) + 100 * count({chosen})) // (200 * nullif(count({chosen}), 0))"


_LEAD = f"""
stays AS (
  SELECT hotel_group, hotel_name_key, date,
    {_mean_cents('cash_value', 'extract(dow FROM created_at) BETWEEN 1 AND 4')} AS m_th,
    {_mean_cents('cash_value', 'extract(dow FROM created_at) NOT BETWEEN 1 AND 4')} AS f_su, count(*) AS n
  FROM quotes WHERE floor(epoch(CAST(date AS TIMESTAMP) - created_at) / 86400) BETWEEN 30 AND 60 AND cash_value > 0
  GROUP BY 1, 2, 3 HAVING count(*) > 1
)"""


def _fill_matrix():
    names = ("sun", "mon", "tue", "wed", "thu", "fri", "sat")
    return ", ".join(
        f"count(CASE WHEN extract(dow FROM date_booked) = {i} THEN {price} END) AS {name}_{price}"
        for price in ("cash", "points") for i, name in enumerate(names)
    )


_COVERED = """
covered AS (
  SELECT c.hotel_group, c.hotel_name_key, c.week_booked, greatest(c.first_day, p.first_day) AS day
  FROM (SELECT hotel_group, hotel_name_key, date_stay, CAST(date_trunc('week', date_booked) AS DATE) AS week_booked,
          min(date_booked) AS first_day FROM cells WHERE cash IS NOT NULL GROUP BY 1, 2, 3, 4) c
  JOIN (SELECT hotel_group, hotel_name_key, date_stay, CAST(date_trunc('week', date_booked) AS DATE) AS week_booked,
          min(date_booked) AS first_day FROM cells WHERE points IS NOT NULL GROUP BY 1, 2, 3, 4) p
  USING (hotel_group, hotel_name_key, date_stay, week_booked)
)"""

# Cells that are priced or next to a priced one, and for each the prices of the grid's cells before and after it; besides, the
# grid's cells by month, with those that have none beside them.
_LAG_LEAD = _CELLS + "," + _SPINE + """,
near AS (
  SELECT DISTINCT hotel_group, hotel_name_key, date_stay, CAST(c.date_booked + o.step AS DATE) AS date_booked
  FROM cells c CROSS JOIN (VALUES (-1), (0), (1)) o(step)
),
single AS (SELECT date_stay FROM spine GROUP BY 1 HAVING count(*) = 1),
sides AS (
  SELECT n.*, o.cash, o.points, p.cash AS pc, p.points AS pp, x.cash AS nc, x.points AS np, n.date_stay IN (SELECT date_stay FROM single) AS alone
  FROM near n SEMI JOIN spine s ON s.date_booked = n.date_booked AND s.date_stay = n.date_stay
  LEFT JOIN cells o ON o.hotel_group = n.hotel_group AND o.hotel_name_key = n.hotel_name_key AND o.date_stay = n.date_stay AND o.date_booked = n.date_booked
  LEFT JOIN cells p ON p.hotel_group = n.hotel_group AND p.hotel_name_key = n.hotel_name_key AND p.date_stay = n.date_stay AND p.date_booked = n.date_booked - 1
  LEFT JOIN cells x ON x.hotel_group = n.hotel_group AND x.hotel_name_key = n.hotel_name_key AND x.date_stay = n.date_stay AND x.date_booked = n.date_booked + 1
),
adjacent AS (
  SELECT *, coalesce(cash, CASE WHEN pc IS NOT NULL AND nc IS NOT NULL
      THEN CAST((CAST(pc * 10000 AS HUGEINT) + CAST(nc * 10000 AS HUGEINT) + 100) // 200 AS DECIMAL(18,4)) / 100 ELSE coalesce(pc, nc) END) AS est_cash,
    coalesce(points, CASE WHEN pp IS NOT NULL AND np IS NOT NULL
      THEN CAST((CAST(pp * 10000 AS HUGEINT) + CAST(np * 10000 AS HUGEINT) + 10000) // 20000 AS DECIMAL(18,4)) ELSE coalesce(pp, np) END) AS est_points
  FROM sides
),
by_month AS (
  SELECT hotel_group, hotel_name_key, CAST(date_trunc('month', date_booked) AS DATE) AS month_booked, count(est_cash) AS est_cash_n,
    CAST(sum(CAST(est_cash AS DECIMAL(18,4))) AS DOUBLE) AS est_cash, count(est_points) AS est_points_n, CAST(sum(CAST(est_points AS DECIMAL(18,4))) AS DOUBLE) AS est_points,
    count(CASE WHEN NOT alone THEN cash END) AS cash_n, count(CASE WHEN NOT alone THEN points END) AS points_n,
    max(CASE WHEN cash IS NOT NULL THEN CAST(abs(est_cash - cash) / cash AS DOUBLE) END) AS est_cash_error,
    max(CASE WHEN points IS NOT NULL THEN CAST(abs(est_points - points) / points AS DOUBLE) END) AS est_points_error
  FROM adjacent GROUP BY ALL
),
months AS (
  SELECT CAST(date_trunc('month', date_booked) AS DATE) AS month_booked, count(*) AS cells,
    count(CASE WHEN date_stay NOT IN (SELECT date_stay FROM single) THEN 1 END) AS beside FROM spine GROUP BY 1
)"""


def _with(*ctes_then_select):
    *ctes, select = ctes_then_select
    return "WITH " + ",".join(ctes) + "\n" + select


def oracles() -> dict[str, str]:
    city_docs = "FROM docs WHERE city = 'nation_19'"
    dated = """SELECT CASE WHEN NOT bad_date THEN stay END AS date,
  CASE WHEN kind = 'object' THEN CAST(cash_value AS DOUBLE) END AS cash_value_amount, created_at, hotel_name_key """ + city_docs
    named = "hotel_group IS NOT NULL AND hotel_id IS NOT NULL"
    latest = f"""
latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY hotel_group, hotel_id ORDER BY created_at DESC NULLS FIRST, _id DESC) AS rn
    FROM templates WHERE {named} AND hotel_name IS NOT NULL
  ) WHERE rn = 1
)"""
    key_map = f"""
key_map AS (
  SELECT hotel_group, hotel_id, hotel_name_key FROM (
    SELECT hotel_group, hotel_id, hotel_name_key, row_number() OVER (PARTITION BY hotel_group, hotel_id
      ORDER BY created_at DESC NULLS FIRST, _id DESC) AS rn
    FROM cash WHERE {named} AND hotel_name_key IS NOT NULL
  ) WHERE rn = 1
)"""
    keyed = "keyed AS (SELECT _id, hotel_group, nullif(hotel_name_key, '') AS hotel_name_key FROM quotes)"
    top_rated = "SELECT hotel_group, hotel_name_key FROM rated WHERE rating >= 5000"
    by_category = _clean("cash", "cash_value", _USD, "hotel_group, hotel_name_key, award_category, date, day")
    return {
        # sources and ingest
        "scan_topn": _with(_QUOTES, _DOCS, f"""SELECT _id, hotel_group, hotel_name_key, city, date, created_at {city_docs}
ORDER BY _id DESC LIMIT 1000"""),
        "min_key": _with(_QUOTES, "SELECT min(_id) AS min_id FROM quotes"),
        "row_count": _with(_QUOTES, "SELECT count(*) AS row_count FROM quotes"),
        "union_tables": _with(_QUOTES, _DOCS, _ARCHIVED,
            "SELECT _id, input_table, hotel_group, hotel_name_key, date, created_at FROM archived"),
        "city_filter": _with(_QUOTES, """SELECT _id, hotel_group, CASE WHEN hotel_group = 'middle east' THEN upper(city) ELSE city END AS city
FROM quotes WHERE city = 'nation_19'"""),
        "key_semi": _with(_QUOTES, _TEMPLATES, keyed, f"SELECT * FROM keyed k WHERE EXISTS (SELECT 1 FROM ({top_rated}) r WHERE r.hotel_group = k.hotel_group AND r.hotel_name_key = k.hotel_name_key)"),
        "key_anti": _with(_QUOTES, _TEMPLATES, keyed, f"SELECT * FROM keyed k WHERE NOT EXISTS (SELECT 1 FROM ({top_rated}) r WHERE r.hotel_group = k.hotel_group AND r.hotel_name_key = k.hotel_name_key)"),
        "id_range_scan": _with(_QUOTES, """b AS (SELECT min(_id) AS low, max(_id) AS high FROM quotes
  WHERE created_at >= TIMESTAMP '1998-01-01' AND created_at < TIMESTAMP '1998-02-01')""",
            "SELECT _id, created_at FROM quotes, b WHERE _id BETWEEN low AND high"),
        "window_copy": _with(_QUOTES, _DOCS, """SELECT _id, hotel_group, hotel_id, date, created_at FROM docs
WHERE created_at >= TIMESTAMP '1998-01-01' AND created_at < TIMESTAMP '1998-02-01'"""),
        "window_copies": _with(_QUOTES, _DOCS, """SELECT _id, hotel_group, hotel_id, date, created_at FROM docs
WHERE created_at >= TIMESTAMP '1998-01-01' AND created_at < TIMESTAMP '1998-02-01 03:00:00'
  OR created_at >= TIMESTAMP '1998-02-01 03:00:00' AND created_at < TIMESTAMP '1998-04-01' AND CAST(split_part(_id, '-', 1) AS BIGINT) % 2 = 0"""),
        "resumed_ingest": _with(_QUOTES, _DOCS, _RESUMED, _snapshots("valid", within="run_id,"), """SELECT 'hotel_calendar_cash_all' AS input_table, run_id, 'all' AS hotel_group, hotel_name_key, hotel_id,
  stay AS date, created_at, _id, CASE WHEN kind = 'object' THEN CAST(cash_value AS DOUBLE) END AS cash_value, TIMESTAMP '2024-01-01' AS extract_dt
FROM snapshots WHERE is_object AND NOT bad_date AND run_id <> '2'"""),
        "ingest_figures": _with(_QUOTES, _DOCS, _RESUMED, _snapshots("valid", within="run_id,"), """figures AS (
  SELECT v.run_id, max(v._id) AS upto, count(*) AS n_read, (SELECT count(*) FROM snapshots s WHERE s.run_id = v.run_id AND s.is_object AND NOT s.bad_date AND s.run_id <> '2') AS n_kept
  FROM valid v GROUP BY v.run_id)""", """SELECT 'hotel_calendar_cash_all' AS input_table, run_id, lag(upto) OVER (ORDER BY run_id) AS after, upto, n_read, n_kept, n_read - n_kept AS n_dropped
FROM figures"""),
        "snapshot_dedupe": _with(_QUOTES, _DOCS, _snapshots("docs"), "SELECT _id, hotel_id, hotel_name_key, date, created_at FROM snapshots"),
        "clean_cash": _with(_QUOTES, _DOCS, f"SELECT {_CASH_ROW} FROM docs WHERE is_object AND NOT bad_date"),
        "clean_points": _with(_QUOTES, _DOCS, f"SELECT {_POINTS_ROW} FROM docs WHERE points IS NOT NULL AND NOT bad_date"),
        "clean_templates": _with(_TEMPLATES.replace("\nseen", "seen", 1), "SELECT * FROM templates"),
        "lineage": _with(_QUOTES, _DOCS, """given AS (SELECT *, concat(age, 'hotel_calendar_cash_', hotel_group) AS input_table FROM docs)""",
  _snapshots("given", within="input_table,"), f"""SELECT {_CASH_ROW}, '7' AS run_id, input_table,
  CAST(0 AS INTEGER) AS chunk_n, TIMESTAMP '2024-01-01' AS extract_dt FROM snapshots WHERE is_object AND NOT bad_date"""),
        "append_table": _with(_QUOTES, _DOCS, """given AS (SELECT *, concat(age, 'hotel_calendar_', hotel_group) AS input_table
  FROM docs WHERE points IS NOT NULL)""", _snapshots("given", within="input_table,"), f"""SELECT {_POINTS_ROW}, '7' AS run_id, input_table,
  CAST(0 AS INTEGER) AS chunk_n, TIMESTAMP '2024-01-01' AS extract_dt FROM snapshots WHERE NOT bad_date"""),
        "csv_export": _with(_QUOTES, "SELECT hotel_group, city, count(*) AS n, min(created_at) AS min_dt, max(created_at) AS max_dt FROM quotes GROUP BY 1, 2"),
        "incremental_ingest": _with(_QUOTES, _DOCS, """arriving AS (
  SELECT *, CASE WHEN created_at < TIMESTAMP '2000-10-01' THEN '1' ELSE '2' END AS run_id FROM docs
  WHERE age = ''), paid AS (SELECT * FROM arriving WHERE points IS NOT NULL)""",
  _snapshots("arriving", "of_cash", "run_id, hotel_group,"), _snapshots("paid", "of_points", "run_id, hotel_group,"),
  """rows AS (SELECT 'hotel_calendar_cash_' AS kind, kind AS kind_of_price, * EXCLUDE (kind) FROM of_cash WHERE is_object AND NOT bad_date
  UNION ALL SELECT 'hotel_calendar_' AS kind, kind AS kind_of_price, * EXCLUDE (kind) FROM of_points WHERE NOT bad_date)""",
  """SELECT concat(kind, hotel_group) AS input_table, run_id, hotel_group, hotel_name_key, hotel_id, stay AS date, created_at, _id,
  CASE WHEN kind <> 'hotel_calendar_' AND kind_of_price = 'object' THEN CAST(cash_value AS DOUBLE) END AS cash_value,
  CASE WHEN kind = 'hotel_calendar_' THEN CAST(points AS DOUBLE) END AS points, TIMESTAMP '2024-01-01' AS extract_dt FROM rows"""),
        # clean tables
        "cash_ledger": _with(_QUOTES, _DOCS, _JUDGED, "SELECT input_table, coalesce(reason, 'kept') AS outcome, dropped, count(*) AS n FROM judged GROUP BY ALL"),
        "points_ledger": _with(_QUOTES, _DOCS, _JUDGED_POINTS, "SELECT input_table, coalesce(reason, 'kept') AS outcome, dropped, count(*) AS n FROM judged GROUP BY ALL"),
        "cash_quarantine": _with(_QUOTES, _DOCS, _JUDGED, f"SELECT {_SET_ASIDE}"),
        "points_quarantine": _with(_QUOTES, _DOCS, _JUDGED_POINTS, f"SELECT {_SET_ASIDE}"),
        "cash_accounted": _with(_QUOTES, _DOCS, _JUDGED, """SELECT _id, hotel_group, input_table, stay AS date,
  CASE WHEN reason IS NULL THEN CAST(cash_value AS DOUBLE) END AS cash_value, CASE WHEN part % 41 = 0 THEN 'USD' ELSE currency END AS currency, created_at
FROM judged WHERE NOT dropped"""),
        "first_per_id": _with(_QUOTES, """parts(part, first, after) AS (
  VALUES (1, DATE '1900-01-01', DATE '1995-01-01'), (2, DATE '1995-01-01', DATE '1998-01-01'), (3, DATE '1998-01-01', DATE '2100-01-01')
)""", """SELECT _id, min(part) AS part, created_at FROM quotes JOIN parts ON created_at >= first - INTERVAL 30 DAY AND created_at < after
GROUP BY _id, created_at"""),
        "clean_by_chunks": _with(_QUOTES, _clean("cash", "cash_value", _VALID + _USD + " AND kind = 'object' AND NOT bad_date"),
            """SELECT hotel_group, hotel_name_key, hotel_id, date_stay, date_booked, CAST(cash_value AS DOUBLE) AS cash, currency, created_at, _id FROM cash"""),
        "estimates_refreshed": _with(_ALL, _EST, "SELECT hotel_group, hotel_name_key, count(*) AS cells, "
            + ", ".join(f"CAST(sum({c}) AS DOUBLE) AS {c}" for c in ("cash", "points", "cash_est", "points_est", "cash_prev", "cash_next", "points_prev", "points_next"))
            + ", " + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("cp_gap", "cn_gap", "pp_gap", "pn_gap")) + " FROM est GROUP BY ALL"),
        "cash_clean": _with(_CITY, """SELECT hotel_group, hotel_name_key, hotel_id, date_stay, date_booked, CAST(cash_value AS DOUBLE) AS cash,
  currency, created_at, _id FROM cash"""),
        "points_clean": _with(_CITY, "SELECT hotel_group, hotel_name_key, hotel_id, date_stay, date_booked, CAST(points AS DOUBLE) AS points, created_at, _id FROM points"),
        "cash_clean_v1": _with(_V1, f"SELECT {_FIRST_GEN}, CAST(cash_value AS DOUBLE) AS cash, currency, created_at, _id FROM cash"),
        "points_clean_v1": _with(_V1, f"SELECT {_FIRST_GEN}, CAST(points AS DOUBLE) AS points, created_at, _id FROM points"),
        "cash_clean_by_category": _with(_QUOTES, by_category,
            "SELECT hotel_group, hotel_name_key, city, date_stay, CAST(cash_value AS DOUBLE) AS cash, currency, created_at, award_category, _id FROM cash"),
        # grid
        "date_spine": """WITH bounds AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b
  FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date_booked FROM bounds),
spine AS (SELECT date_booked, CAST(unnest(generate_series(date_booked, date_booked + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS date_stay FROM days)
SELECT date_booked, count(*) AS stays, min(date_stay) AS first_stay, max(date_stay) AS last_stay FROM spine GROUP BY 1""",
        "hotel_grid": _with(_ALL, _GRID, _GRID_SUMMARY.format(keys="hotel_group, hotel_name_key")),
        "hotel_grid_v1": _with(_V1, _GRID_V1, _GRID_SUMMARY.format(keys="hotel_group, hotel_name_key, city")),
        "sparse_grid": _with(_CITY, _BASE, """pairs AS (
  SELECT hotel_group, hotel_name_key, date_stay, date_booked FROM base
  UNION SELECT hotel_group, hotel_name_key, date_stay, date_booked FROM cash
  UNION SELECT hotel_group, hotel_name_key, date_stay, date_booked FROM points
)""", """SELECT hotel_group, hotel_name_key, date_stay, date_booked, CAST(date_stay - date_booked AS INTEGER) AS booking_window,
  CAST(c.cash_value AS DOUBLE) AS cash, CAST(p.points AS DOUBLE) AS points
FROM pairs LEFT JOIN cash c USING (hotel_group, hotel_name_key, date_stay, date_booked)
LEFT JOIN points p USING (hotel_group, hotel_name_key, date_stay, date_booked)"""),
        "sparse_summary": _with(_ALL, _BASE, """pairs AS (
  SELECT hotel_group, hotel_name_key, date_stay, date_booked FROM base
  UNION SELECT hotel_group, hotel_name_key, date_stay, date_booked FROM cash
  UNION SELECT hotel_group, hotel_name_key, date_stay, date_booked FROM points
)""", """SELECT hotel_group, hotel_name_key, count(*) AS cells, CAST(sum(date_stay - date_booked) AS BIGINT) AS windows,
  CAST(sum(c.cash_value) AS DOUBLE) AS cash, CAST(sum(p.points) AS DOUBLE) AS points
FROM pairs LEFT JOIN cash c USING (hotel_group, hotel_name_key, date_stay, date_booked)
LEFT JOIN points p USING (hotel_group, hotel_name_key, date_stay, date_booked) GROUP BY 1, 2"""),
        "nearest_summary": _with(_ALL, _BASE, _BOTH, """SELECT hotel_group, hotel_name_key, count(*) AS cells,
  CAST(sum(cash_prev) AS DOUBLE) AS cash_prev, CAST(sum(cash_next) AS DOUBLE) AS cash_next,
  CAST(sum(points_prev) AS DOUBLE) AS points_prev, CAST(sum(points_next) AS DOUBLE) AS points_next,
  CAST(sum(cp_gap) AS BIGINT) AS cp_gap, CAST(sum(cn_gap) AS BIGINT) AS cn_gap, CAST(sum(pp_gap) AS BIGINT) AS pp_gap, CAST(sum(pn_gap) AS BIGINT) AS pn_gap
FROM n4 GROUP BY 1, 2"""),
        "hotel_dense": _with(_ALL, _GRID, f"SELECT {_doubles('cash', 'points')} FROM grid WHERE cash IS NOT NULL OR points IS NOT NULL"),
        "sample_base": _with(_CITY, _BASE, f"SELECT {_doubles('cash', 'points')} FROM base"),
        # neighbours, estimates, sample
        "asof_prev": _with(_CITY, _BASE, _PREV, f"SELECT {_doubles('cash', 'points', 'cash_prev', 'points_prev')} FROM n2"),
        "asof_next": _with(_CITY, _BASE, _NEXT, f"SELECT {_doubles('cash', 'points', 'cash_next', 'points_next')} FROM n2"),
        "asof_any_size": _with(_QUOTES, _SKEWED, """SELECT q._id, q.hotel_group, q.hotel_name_key, q.date, q.created_at, CAST(q.points AS DOUBLE) AS points,
  CAST(a.cash_value AS DOUBLE) AS cash_value_prev, a.created_at AS cash_value_prev_at, CAST(b.cash_value AS DOUBLE) AS cash_value_next, b.created_at AS cash_value_next_at
FROM (SELECT * FROM skewed WHERE points IS NOT NULL) q
ASOF LEFT JOIN timed a ON a.hotel_group = q.hotel_group AND a.hotel_name_key = q.hotel_name_key AND a.date = q.date AND q.created_at > a.created_at
ASOF LEFT JOIN timed b ON b.hotel_group = q.hotel_group AND b.hotel_name_key = q.hotel_name_key AND b.date = q.date AND q.created_at < b.created_at"""),
        "interpolate": _with(_CITY, _EST, "SELECT " + _doubles(
            "cash", "points", "cash_prev", "cash_next", "points_prev", "points_next", "cash_est", "points_est") + " FROM est"),
        "hotel_sample": _with(_CITY, _SAMPLE, _SAMPLE_OUT),
        "hotel_sample_summary": _with(_ALL, _TEMPLATES, _SAMPLE, """SELECT hotel_group, hotel_name_key, count(*) AS n,
  CAST(count(*) FILTER (WHERE complete) AS BIGINT) AS complete, CAST(sum(cash) AS DOUBLE) AS cash, CAST(sum(points) AS DOUBLE) AS points,
  CAST(sum(cash * booking_window) AS DOUBLE) AS cash_windows FROM sample GROUP BY 1, 2"""),
        "restricted_sample": _with(_CITY, _SAMPLE, _SAMPLE_OUT + " WHERE hotel_name_key IN (SELECT hotel_name_key FROM rated WHERE rating >= 5000)"),
        "latest_template": _with(_TEMPLATES.replace("\nseen", "seen", 1), latest, "SELECT * FROM latest"),
        "id_key_map": _with(_ALL, key_map, "SELECT * FROM key_map"),
        "sample_templates": _with(_CITY, _SAMPLE, latest, key_map, """SELECT l.* EXCLUDE (created_at, _id), m.hotel_name_key
FROM latest l JOIN key_map m USING (hotel_group, hotel_id)
WHERE (m.hotel_group, m.hotel_name_key) IN (SELECT (hotel_group, hotel_name_key) FROM sample)"""),
        "lag_lead_interp": _with(_ALL, _LAG_LEAD, """SELECT h.hotel_group, h.hotel_name_key, m.month_booked, cells, coalesce(est_cash_n, 0) AS est_cash_n,
  coalesce(est_points_n, 0) AS est_points_n, est_cash, est_points, CASE WHEN beside > 0 THEN beside - coalesce(cash_n, 0) END AS est_cash_gap,
  CASE WHEN beside > 0 THEN beside - coalesce(points_n, 0) END AS est_points_gap, est_cash_error, est_points_error
FROM (SELECT DISTINCT hotel_group, hotel_name_key FROM cash) h CROSS JOIN months m
LEFT JOIN by_month b ON b.hotel_group = h.hotel_group AND b.hotel_name_key = h.hotel_name_key AND b.month_booked = m.month_booked"""),
        # quality reports
        "weekday_shares": _with(_QUOTES, _shares("TRUE")),
        "weekday_shares_points": _with(_QUOTES, _shares("points IS NOT NULL")),
        "group_summary": _with(_QUOTES, "SELECT hotel_group, count(*) AS n, min(created_at) AS min_dt, max(created_at) AS max_dt FROM quotes GROUP BY 1"),
        "hotel_summary": _with(_QUOTES, "SELECT hotel_group, hotel_name_key, count(*) AS n, min(created_at) AS min_dt, max(created_at) AS max_dt FROM quotes GROUP BY 1, 2"),
        "dupe_ids": _with(_QUOTES, "SELECT _id, count(*) AS n FROM quotes GROUP BY 1 HAVING count(*) > 1"),
        "dupe_ids_overlap": _with(_QUOTES, """stored AS (SELECT _id FROM quotes WHERE created_at < TIMESTAMP '1999-01-01'
  UNION ALL SELECT _id FROM quotes WHERE created_at >= TIMESTAMP '1998-01-01')""", "SELECT _id, count(*) AS n FROM stored GROUP BY 1 HAVING count(*) > 1"),
        "hotel_rows": _with(_QUOTES, f"SELECT {_CASH_RAW} FROM quotes WHERE hotel_name_key = 'supplier-000000003'"),
        "price_by_stay": _with(_QUOTES, """SELECT date, CAST(sum(cash_value) AS DOUBLE) / count(cash_value) AS cash_value, count(*) AS n
FROM quotes WHERE hotel_name_key = 'supplier-000000003' GROUP BY 1"""),
        "lead_time_price": _with(_QUOTES, _LEAD, """SELECT hotel_group, hotel_name_key,
  CAST((2 * sum(m_th) + count(m_th)) // (2 * nullif(count(m_th), 0)) AS DOUBLE) / 100 AS m_th_cash,
  CAST((2 * sum(f_su) + count(f_su)) // (2 * nullif(count(f_su), 0)) AS DOUBLE) / 100 AS f_su_cash,
  CAST(sum(n) AS BIGINT) AS n FROM stays GROUP BY 1, 2"""),
        "weekly_obs": _with(_QUOTES, "SELECT hotel_group, hotel_name_key, CAST(date_trunc('week', created_at) AS DATE) AS created_week, count(*) AS n FROM quotes GROUP BY 1, 2, 3"),
        "daily_obs": _with(_QUOTES, by_category, "SELECT day AS created_date, count(*) AS n FROM cash WHERE hotel_group = 'europe' GROUP BY 1"),
        "weekly_obs_group": _with(_QUOTES, by_category, "SELECT CAST(date_trunc('week', created_at) AS DATE) AS created_week, count(*) AS n FROM cash WHERE hotel_group = 'europe' GROUP BY 1"),
        "redundancy_group": _with(_QUOTES, _RANKED, """SELECT hotel_group, CAST(sum(CASE WHEN rn = 1 THEN 1 END) AS BIGINT) AS clean_count,
  count(*) AS total_count FROM ranked GROUP BY 1"""),
        "redundancy_hotel": _with(_QUOTES, _RANKED, """SELECT hotel_group, hotel_name_key, CAST(sum(CASE WHEN rn = 1 THEN 1 END) AS BIGINT) AS clean_count,
  count(*) AS total_count, CAST(sum(CASE WHEN rn = 1 THEN 1 END) AS DOUBLE) / count(*) AS pct_needed FROM ranked GROUP BY 1, 2"""),
        "dupe_rows": _with(_QUOTES, _RANKED, f"SELECT {_CASH_RAW}, rn FROM ranked WHERE rn > 1"),
        "fill_count": _with(_ALL, _EST, """SELECT count(*) AS n, CAST(sum(CASE WHEN cash IS NOT NULL THEN 1 END) AS BIGINT) AS cash,
  CAST(sum(CASE WHEN points IS NOT NULL THEN 1 END) AS BIGINT) AS points FROM est"""),
        "est_err_group_cash": _with(_ALL, _EST, _error("cash", "hotel_group")),
        "est_err_group_points": _with(_ALL, _EST, _error("points", "hotel_group")),
        "est_err_gap_cash": _with(_ALL, _EST, _error("cash", "coalesce(cp_gap, 0) + coalesce(cn_gap, 0) AS gap")),
        "est_err_gap_points": _with(_ALL, _EST, _error("points", "coalesce(pp_gap, 0) + coalesce(pn_gap, 0) AS gap")),
        "coverage": _with(_ALL, _EST, """best AS (SELECT hotel_group, hotel_name_key, date_booked, coalesce(cash, cash_est) AS c, coalesce(points, points_est) AS p FROM est)""",
            """SELECT hotel_group, hotel_name_key, CAST(sum(CASE WHEN c IS NULL THEN 1 END) AS BIGINT) AS cash_null,
  CAST(sum(CASE WHEN p IS NULL THEN 1 END) AS BIGINT) AS points_null,
  CAST(sum(CASE WHEN c IS NOT NULL AND p IS NOT NULL THEN 1 END) AS BIGINT) AS both_valid,
  min(CASE WHEN c IS NULL OR p IS NULL THEN date_booked END) AS min_date_booked_null,
  max(CASE WHEN c IS NULL OR p IS NULL THEN date_booked END) AS max_date_booked_null, count(*) AS n FROM best GROUP BY 1, 2"""),
        "week_dow_fill": _with(_ALL, _GRID, f"""SELECT hotel_group, hotel_name_key, CAST(date_trunc('week', date_booked) AS DATE) AS week_booked,
  {_fill_matrix()} FROM grid GROUP BY 1, 2, 3"""),
        "cumulative_coverage": _with(_ALL, _CELLS, _COVERED, "SELECT hotel_group, hotel_name_key, week_booked, " + ", ".join(
            f"count(*) FILTER (WHERE extract(dow FROM day) <= {i}) AS d{i + 1}_cp" for i in range(7)) + " FROM covered GROUP BY 1, 2, 3"),
        "table_stats": _with(_QUOTES, _DOCS, _ARCHIVED, """SELECT input_table, count(*) AS row_count,
  count(DISTINCT CASE WHEN amount > 1 THEN concat_ws('|', hotel_name_key, day, date) END) AS unique_rows,
  count(DISTINCT hotel_name_key) AS unique_hotel_name_keys, count(DISTINCT city) AS unique_cities FROM archived GROUP BY 1"""),
        "first_seen": _with(_QUOTES, "SELECT min(created_at) AS first_seen FROM quotes WHERE hotel_name_key = 'supplier-000000003'"),
        "projected_scan": _with(_QUOTES, _DOCS, dated),
        "tuesday_scan": _with(_QUOTES, _DOCS, dated + " AND extract(dow FROM created_at) = 2"),
        "object_count": _with(_QUOTES, _DOCS, "SELECT count(*) AS n, count(*) FILTER (WHERE is_object) AS objects FROM docs"),
        "key_span_city": _with(_QUOTES, "SELECT hotel_name_key, city, max(created_at) AS most_recent, min(created_at) AS oldest, count(*) AS n FROM quotes WHERE city = 'nation_19' GROUP BY 1, 2"),
        "table_rows": _with(_QUOTES, _DOCS, """SELECT concat(age, 'hotel_calendar_', hotel_group) AS input_table, count(*) AS total_rows
FROM docs WHERE points IS NOT NULL GROUP BY 1"""),
        "spot_check": _with(_QUOTES, _DOCS, """SELECT _id, hotel_name_key, CAST(points AS DOUBLE) AS points, created_at FROM docs
WHERE hotel_name_key = 'supplier-000000003' AND (kind <> 'missing' OR points IS NOT NULL)
  AND created_at BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1999-01-01'"""),
        "count_by_stay": _with(_QUOTES, _DOCS, "SELECT date, count(*) AS n FROM docs GROUP BY 1"),
        "monthly_price": _with(_QUOTES, """SELECT CAST(year(date) AS INTEGER) AS date_year, CAST(month(date) AS INTEGER) AS date_month,
  CAST(year(created_at) AS INTEGER) AS created_year, CAST(month(created_at) AS INTEGER) AS created_month, count(*) AS n,
  CAST(sum(cash_value) AS DOUBLE) / count(cash_value) AS average_price FROM quotes GROUP BY 1, 2, 3, 4"""),
        # value of points
        "value_group": _with(_ALL, _CELLS, _value("")),
        "value_month_booked": _with(_ALL, _CELLS, _value("CAST(date_trunc('month', date_booked) AS DATE) AS month_booked,")),
        "value_month_stay": _with(_ALL, _CELLS, _value("CAST(date_trunc('month', date_stay) AS DATE) AS month_stay,")),
        "value_tier": _with(_ALL, _CELLS, """mean AS (SELECT hotel_group, hotel_name_key, sum(CAST(cash * 10000 AS HUGEINT)) AS s, count(cash) AS k FROM cells GROUP BY 1, 2)""",
            """SELECT c.hotel_group, CASE WHEN 10 * k * CAST(cash * 10000 AS HUGEINT) < 9 * s THEN 'low_demand'
    WHEN 10 * k * CAST(cash * 10000 AS HUGEINT) <= 11 * s THEN 'mid_demand' ELSE 'high_demand' END AS demand_tier,
  CAST(sum(cash) AS DOUBLE) / CAST(sum(points) AS DOUBLE) * 100.0 AS value_100_pts
FROM cells c LEFT JOIN mean USING (hotel_group, hotel_name_key) WHERE cash IS NOT NULL AND points IS NOT NULL GROUP BY ALL"""),
        "value_window": _with(_ALL, _CELLS, _value("CAST(floor(booking_window / 30) AS BIGINT) AS months_in_advance,", ", count(*) AS n")),
    }
