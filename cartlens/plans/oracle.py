"""Oracle SQL (DuckDB dialect) for the registered queries.

Written independently of the Spark plans: next-month values use self-joins
instead of range frames, positions use ``row_number`` instead of range
partitioning, the AUC uses one global running sum.  Each statement ends in the
same presentation as ``registry.present``: timestamps as text, doubles and
money rounded to 6 places (``+ 0.0`` turns DuckDB's -0.0 into 0.0).

Models that are the maximum of a closed or convex form are fitted anew in SQL: naive Bayes from
class statistics, the linear regression by its normal equations, the logistic regression by
Newton's method.  Queries backed by other fitted models (forests, kernel regression, model
search) have no entry: their check is rows-only.
"""

from __future__ import annotations

import math

from cartlens.plans import registry as R

TS = "'%Y-%m-%d %H:%M:%S.%f'"


def month_range(begin: str, end: str) -> tuple[int, int]:
    """First and last month number (12 * year + month - 1) whose first day lies in [begin, end]."""
    (y0, m0, d0), (y1, m1, _) = (map(int, x[:10].split("-")) for x in (begin, end))
    return 12 * y0 + m0 - 1 + (d0 > 1), 12 * y1 + m1 - 1


def open_window_months(begin: str, end: str) -> tuple[int, int]:
    """Month numbers that overlap (begin, end); the registered windows end on a 1st at midnight or later days."""
    (y0, m0, _), (y1, m1, d1) = (map(int, x[:10].split("-")) for x in (begin, end))
    midnight = d1 == 1 and not x_time(end)
    return 12 * y0 + m0 - 1, max(12 * y0 + m0 - 1, 12 * y1 + m1 - 1 - midnight)


def x_time(text: str) -> bool:
    """Whether a date-time text names a time of day other than midnight."""
    return any(c in "123456789" for c in text[10:])


def _k(period: float) -> str:
    return f"CAST('{repr(2.0 * math.pi / period)}' AS DOUBLE)"


E_CTE = """e_sessions AS (
  SELECT CAST(user_id * 100000 + (CAST(ts AS DATE) - DATE '1970-01-01') AS BIGINT) AS session_id,
         ts AS "timestamp",
         user_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
         CASE WHEN event_type = 'purchase' THEN 'BUY_PRODUCT' WHEN event_type IN ('view', 'click')
              THEN 'VIEW_PRODUCT' ELSE upper(event_type) END AS event_type,
         CAST((CAST(json_extract_string(props, '$.k') AS BIGINT) % 5) * 5 AS INTEGER) AS offered_discount,
         CASE WHEN event_type = 'purchase' THEN event_id END AS purchase_id
  FROM events)"""


def _l_cte(name: str, nulls: bool) -> str:
    user = "CASE WHEN l.l_orderkey % 19 <> 0 THEN o.o_custkey END" if nulls else "o.o_custkey"
    prod = "CASE WHEN l.l_linenumber <> 7 THEN l.l_partkey END" if nulls else "l.l_partkey"
    return f"""{name} AS (
  SELECT l.l_orderkey AS session_id, l.l_shipdate AS "timestamp", {user} AS user_id,
         {prod} AS product_id,
         CASE WHEN l.l_returnflag = 'R' THEN 'BUY_PRODUCT' ELSE 'VIEW_PRODUCT' END AS event_type,
         CAST(round(l.l_discount * 100) AS INTEGER) AS offered_discount,
         CASE WHEN l.l_returnflag = 'R' THEN l.l_orderkey END AS purchase_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


L_CTE = _l_cte("l_sessions", False)
LN_CTE = _l_cte("ln_sessions", True)
P_CTE = "products AS (SELECT p_partkey AS product_id, p_retailprice AS price FROM part)"
CLEAN_CTE = "clean AS (SELECT * FROM ln_sessions WHERE user_id IS NOT NULL AND product_id IS NOT NULL)"
PRICED_CTE = """priced AS (
  SELECT s.*, p.price,
         CASE WHEN s.event_type = 'BUY_PRODUCT' THEN p.price ELSE CAST(0 AS DOUBLE) END AS purchase
  FROM l_sessions s JOIN products p ON s.product_id = p.product_id)"""
TRAIN_CTE = """train AS (SELECT * FROM priced WHERE month("timestamp") <> 3 AND user_id IS NOT NULL)"""
MIDX = 'CAST(year("timestamp") * 12 + month("timestamp") - 1 AS INTEGER)'
FACTS_CTE = f"""facts AS (
  SELECT user_id, month_idx, CAST(sum(e) AS BIGINT) AS events, CAST(sum(b) AS BIGINT) AS buys,
         coalesce(sum(p), CAST(0 AS DECIMAL(38,6))) AS spend
  FROM (
    SELECT user_id, {MIDX} AS month_idx, 1 AS e,
           CASE WHEN event_type = 'BUY_PRODUCT' THEN 1 ELSE 0 END AS b,
           CAST(NULL AS DECIMAL(28,6)) AS p
    FROM l_sessions WHERE user_id IS NOT NULL
    UNION ALL
    SELECT s.user_id, CAST(year(s."timestamp") * 12 + month(s."timestamp") - 1 AS INTEGER), 0, 0,
           CAST(pr.price AS DECIMAL(28,6))
    FROM l_sessions s LEFT JOIN products pr ON s.product_id = pr.product_id
    WHERE s.user_id IS NOT NULL AND s.event_type = 'BUY_PRODUCT') u
  GROUP BY user_id, month_idx)"""
SS_CTE = """ss AS (
  SELECT session_id, count(product_id) AS n_products,
         CAST(max(CASE WHEN event_type = 'BUY_PRODUCT' THEN 1 ELSE 0 END) AS INTEGER) AS bought,
         (epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) // 1000000 AS seconds_total,
         ((epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) // 1000000) % 86400 AS seconds_mod_day
  FROM e_sessions WHERE session_id IS NOT NULL GROUP BY session_id)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _present(body: str, ts=(), dbl=(), date=()) -> str:
    """Wrap ``body`` so listed columns get the registry's presentation."""
    repl = {}
    for c in ts:
        repl[c] = f'strftime(q."{c}", {TS})'
    for c in date:
        repl[c] = f"strftime(q.\"{c}\", '%Y-%m-%d')"
    for c in dbl:
        repl[c] = f'CAST(round(CAST(q."{c}" AS DOUBLE), 6) + 0.0 AS DOUBLE)'
    if not repl:
        return body
    exclude = ", ".join(f'"{c}"' for c in repl)
    extra = ", ".join(f'{e} AS "{c}"' for c, e in repl.items())
    return f"SELECT * EXCLUDE ({exclude}), {extra} FROM (\n{body}\n) q"


SESSION_TS = ("timestamp",)


def _hist(src: str, x: str, bins: int, where: str = "") -> str:
    cond = f"WHERE {x} IS NOT NULL" + (f" AND {where}" if where else "")
    return f"""hv AS (SELECT CAST({x} AS DOUBLE) AS x FROM {src} {cond}),
hb AS (SELECT min(x) AS lo, max(x) AS hi FROM hv),
hc AS (SELECT CAST(CASE WHEN hb.hi = hb.lo THEN 0
                        ELSE LEAST(floor((hv.x - hb.lo) * {bins} / (hb.hi - hb.lo)), {bins - 1}) END
                   AS INTEGER) AS bin, count(*) AS rows FROM hv, hb GROUP BY 1),
he AS (SELECT CAST(g.i AS INTEGER) AS bin,
              CASE WHEN hb.hi = hb.lo THEN hb.lo ELSE hb.lo + g.i * ((hb.hi - hb.lo) / {bins}) END AS bin_lo,
              CASE WHEN hb.hi = hb.lo OR g.i = {bins - 1} THEN hb.hi
                   ELSE hb.lo + (g.i + 1) * ((hb.hi - hb.lo) / {bins}) END AS bin_hi
       FROM hb, generate_series(0, {bins - 1}) g(i) WHERE hb.hi <> hb.lo OR g.i = 0)"""


HIST_SELECT = "SELECT he.bin, he.bin_lo, he.bin_hi, coalesce(hc.rows, 0) AS rows FROM he LEFT JOIN hc ON he.bin = hc.bin"
HIST_DBL = ("bin_lo", "bin_hi")


def _c1_rows(begin, end, threshold: float = 100.0) -> str:
    lo, hi = month_range(begin, end)
    k = _k(12.0)
    return f"""SELECT a.user_id, a.month_idx, CAST(a.month_idx // 12 AS INTEGER) AS year,
       a.buys AS buying_events_month_first, coalesce(n1.buys, 0) AS buying_events_month_second,
       a.events AS all_events_month_first, coalesce(n1.events, 0) AS all_events_month_second,
       sin(CAST(a.month_idx % 12 + 1 AS DOUBLE) * {k}) AS first_month_sin,
       cos(CAST(a.month_idx % 12 + 1 AS DOUBLE) * {k}) AS first_month_cos,
       CAST(a.spend AS DOUBLE) AS spent_money_first_month,
       CAST(coalesce(n1.spend, 0) AS DOUBLE) AS spent_money_second_month,
       CASE WHEN 2 * coalesce(n2.spend, 0) - (a.spend + coalesce(n1.spend, 0)) > {2 * threshold}
            THEN 1 ELSE 0 END AS label,
       CAST(coalesce(n2.spend, 0) AS DOUBLE) AS spend_third
FROM facts a
LEFT JOIN facts n1 ON n1.user_id = a.user_id AND n1.month_idx = a.month_idx + 1
LEFT JOIN facts n2 ON n2.user_id = a.user_id AND n2.month_idx = a.month_idx + 2
WHERE a.buys > 0 AND a.month_idx BETWEEN {lo} AND {hi}"""


V3 = ("year, buying_events_month_first, buying_events_month_second, all_events_month_first, "
      "all_events_month_second, first_month_sin, first_month_cos, spent_money_first_month, "
      "spent_money_second_month, label")
V3_DBL = ("first_month_sin", "first_month_cos", "spent_money_first_month", "spent_money_second_month")
C1_CTES = (L_CTE, P_CTE, FACTS_CTE)


def _c1(begin, end) -> str:
    return f"SELECT DISTINCT {V3} FROM ({_c1_rows(begin, end)}) r"


def _splits() -> str:
    return (f"SELECT {V3}, 'train' AS split FROM ({_c1(*R.TRAIN)}) t UNION ALL "
            f"SELECT {V3}, 'val' AS split FROM ({_c1(*R.VAL)}) v")


def _v12(begin, end, threshold: float = 100.0) -> str:
    first, last = open_window_months(begin, end)
    m0, m1, m2 = first, first + 1, first + 2
    k = _k(12.0)
    return f"""ws AS (
  SELECT s.user_id, CAST(year(s."timestamp") * 12 + month(s."timestamp") - 1 AS INTEGER) AS month_idx,
         coalesce(sum(CAST(pr.price AS DECIMAL(28,6))), CAST(0 AS DECIMAL(38,6))) AS spend, count(*) AS wbuys
  FROM l_sessions s LEFT JOIN products pr ON s.product_id = pr.product_id
  WHERE s.user_id IS NOT NULL AND s.event_type = 'BUY_PRODUCT'
    AND s."timestamp" > TIMESTAMP '{begin}' AND s."timestamp" < TIMESTAMP '{end}'
  GROUP BY 1, 2),
users AS (SELECT DISTINCT user_id FROM l_sessions WHERE user_id IS NOT NULL),
spine AS (SELECT u.user_id, CAST(g.m AS INTEGER) AS month_idx FROM users u, generate_series({first}, {last}) g(m)),
yb AS (SELECT user_id, month_idx // 12 AS y, sum(buys) AS yb FROM facts GROUP BY 1, 2),
ysp AS (SELECT user_id, month_idx // 12 AS y, sum(spend) AS ys FROM ws GROUP BY 1, 2),
pu AS (SELECT user_id, sum(spend) FILTER (WHERE month_idx = {m0}) AS s0,
              sum(spend) FILTER (WHERE month_idx = {m1}) AS s1,
              sum(spend) FILTER (WHERE month_idx = {m2}) AS s2,
              sum(wbuys) FILTER (WHERE month_idx = {m0}) AS wb0
       FROM ws GROUP BY 1),
pc AS (SELECT user_id, sum(buys) FILTER (WHERE month_idx = {m0}) AS b0,
              sum(buys) FILTER (WHERE month_idx = {m1}) AS b1,
              sum(events) FILTER (WHERE month_idx = {m0}) AS e0,
              sum(events) FILTER (WHERE month_idx = {m1}) AS e1
       FROM facts GROUP BY 1),
v12 AS (
  SELECT sp.user_id, CAST(sp.month_idx // 12 AS INTEGER) AS year,
         CAST(sp.month_idx % 12 + 1 AS INTEGER) AS month,
         sin(CAST(sp.month_idx % 12 + 1 AS DOUBLE) * {k}) AS month_sin,
         cos(CAST(sp.month_idx % 12 + 1 AS DOUBLE) * {k}) AS month_cos,
         CAST(coalesce(yb.yb, 0) AS BIGINT) AS buying_sessions,
         CASE WHEN coalesce(pu.wb0, 0) > 0
               AND 2 * coalesce(pu.s2, 0) - (coalesce(pu.s0, 0) + coalesce(pu.s1, 0)) > {2 * threshold}
              THEN 1 ELSE 0 END AS label,
         CAST(coalesce(ysp.ys, 0) AS DOUBLE) AS spent_money,
         CAST(coalesce(pu.s0, 0) AS DOUBLE) AS spent_money_first_month,
         CAST(coalesce(pu.s1, 0) AS DOUBLE) AS spent_money_second_month,
         CAST(CASE WHEN sp.month_idx = {m0} THEN coalesce(pc.b0, 0) ELSE 0 END AS BIGINT) AS buying_events_first_month,
         CAST(CASE WHEN sp.month_idx = {m1} THEN coalesce(pc.b1, 0) ELSE 0 END AS BIGINT) AS buying_events_second_month,
         CAST(CASE WHEN sp.month_idx = {m0} THEN coalesce(pc.e0, 0) ELSE 0 END AS BIGINT) AS all_events_first_month,
         CAST(CASE WHEN sp.month_idx = {m1} THEN coalesce(pc.e1, 0) ELSE 0 END AS BIGINT) AS all_events_second_month
  FROM spine sp
  LEFT JOIN yb ON yb.user_id = sp.user_id AND yb.y = sp.month_idx // 12
  LEFT JOIN ysp ON ysp.user_id = sp.user_id AND ysp.y = sp.month_idx // 12
  LEFT JOIN pu ON pu.user_id = sp.user_id
  LEFT JOIN pc ON pc.user_id = sp.user_id)"""


def _user_base(src: str) -> str:
    return f"""SELECT user_id,
       coalesce(sum(CAST(purchase AS DECIMAL(28,6))), CAST(0 AS DECIMAL(38,6))) AS total_sum,
       avg(offered_discount) AS mean_discount,
       CASE WHEN min(purchase) = max(purchase) OR min(offered_discount) = max(offered_discount)
                 OR count(purchase) < 2 THEN NULL
            ELSE covar_pop(purchase, offered_discount)
                 / (stddev_pop(purchase) * stddev_pop(offered_discount)) END AS corr_purchase_discount
FROM {src} WHERE user_id IS NOT NULL GROUP BY user_id"""


TREND_CTE = """nz AS (
  SELECT user_id, "timestamp", session_id, product_id, purchase,
         row_number() OVER (PARTITION BY user_id ORDER BY "timestamp", session_id, product_id, purchase) - 1 AS position
  FROM train WHERE purchase <> 0),
tr AS (SELECT user_id, CASE WHEN count(*) < 2 THEN CAST(0 AS DOUBLE)
                            ELSE regr_slope(purchase, position) END AS spending_trend
       FROM nz GROUP BY user_id)"""

# Normal equations in powers of the centred position: odd and even powers part, so each is at most 2 x 2.
MOMENT_CTE = """mo AS (
  SELECT user_id, count(*) AS n, -(count(*) - 1) / 2.0 AS first,
         sum(u ** 2) AS s2, sum(u ** 4) AS s4, sum(u ** 6) AS s6,
         sum(y) AS y0, sum(u * y) AS y1, sum(u ** 2 * y) AS y2, sum(u ** 3 * y) AS y3
  FROM (SELECT user_id, CAST(purchase AS DOUBLE) AS y,
               position - (count(*) OVER (PARTITION BY user_id) - 1) / CAST(2 AS DOUBLE) AS u FROM nz) c
  GROUP BY user_id),
co AS (
  SELECT *, CASE WHEN n > 2 THEN (n * y2 - s2 * y0) / (n * s4 - s2 * s2) ELSE 0 END AS b2,
         CASE WHEN n > 3 THEN (s2 * y3 - s4 * y1) / (s2 * s6 - s4 * s4) ELSE 0 END AS b3 FROM mo)"""

RULE = ("CASE WHEN spent_money_second_month - spent_money_first_month > 0 THEN 1 ELSE 0 END")


def _auc(src: str) -> str:
    return f"""SELECT count(*) FILTER (WHERE label = 1) AS positives, count(*) FILTER (WHERE label = 0) AS negatives,
  (SELECT sum(pos * (below + 0.5 * neg)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) FROM (
     SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
     FROM (SELECT score AS s, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
           FROM {src} GROUP BY score) g) c) AS auc
FROM {src}"""


def _solve(src: str, n: int, name: str) -> list[str]:
    """CTEs that solve a symmetric system by Cholesky steps: ``src`` has one row with the lower
    triangle a_i_j and the right side r_i; the last CTE, ``name``, adds the solution x_i."""
    out, prev = [], src

    def step(columns: str, last: bool = False) -> None:
        nonlocal prev
        now = name if last else f"{name}_{len(out)}"
        out.append(f"{now} AS MATERIALIZED (SELECT *, {columns} FROM {prev})")
        prev = now

    for k in range(n):
        step(f"sqrt(a_{k}_{k}" + "".join(f" - l_{k}_{j} * l_{k}_{j}" for j in range(k)) + f") AS l_{k}_{k}")
        step(", ".join([f"(a_{i}_{k}" + "".join(f" - l_{i}_{j} * l_{k}_{j}" for j in range(k)) + f") / l_{k}_{k} AS l_{i}_{k}"
                        for i in range(k + 1, n)]
                       + [f"(r_{k}" + "".join(f" - l_{k}_{j} * y_{j}" for j in range(k)) + f") / l_{k}_{k} AS y_{k}"]))
    for k in reversed(range(n)):
        step(f"(y_{k}" + "".join(f" - l_{i}_{k} * x_{i}" for i in range(k + 1, n)) + f") / l_{k}_{k} AS x_{k}", last=k == 0)
    return out


def _standard(src: str, feats: list[str], keep: str) -> list[str]:
    """CTEs with the features of ``src`` as z_0, z_1, ... by mean and deviation of its train part."""
    stats = ", ".join(f"avg({f}) AS m_{k}, stddev_pop({f}) AS d_{k}" for k, f in enumerate(feats))
    z = ", ".join(f"(CAST({f} AS DOUBLE) - m_{k}) / d_{k} AS z_{k}" for k, f in enumerate(feats))
    return [f"zs AS MATERIALIZED (SELECT {stats} FROM {src} WHERE split = 'train')",
            f"z AS MATERIALIZED (SELECT {keep}, split, {z}, CAST(1 AS DOUBLE) AS z_{len(feats)} FROM {src}, zs)"]


def _newton(feats: int, rounds: int) -> list[str]:
    """CTEs of Newton's method for a logistic regression on ``z``; the last one is ``beta``."""
    n = feats + 1
    out = ["beta_0 AS MATERIALIZED (SELECT " + ", ".join(f"CAST(0 AS DOUBLE) AS x_{k}" for k in range(n)) + ")"]
    eta = " + ".join(f"x_{k} * z_{k}" for k in range(n))
    tri = [(i, j) for i in range(n) for j in range(i + 1)]
    for t in range(rounds):
        sums = ", ".join([f"sum(p * (1 - p) * z_{i} * z_{j}) AS a_{i}_{j}" for i, j in tri]
                         + [f"sum((label - p) * z_{k}) AS r_{k}" for k in range(n)]
                         + [f"any_value(x_{k}) AS o_{k}" for k in range(n)])
        out.append(f"g_{t} AS MATERIALIZED (SELECT {sums} FROM (SELECT *, 1 / (1 + exp(-({eta}))) AS p FROM z, beta_{t} WHERE split = 'train') q)")
        out += _solve(f"g_{t}", n, f"s_{t}")
        last = "beta" if t + 1 == rounds else f"beta_{t + 1}"
        out.append(f"{last} AS MATERIALIZED (SELECT " + ", ".join(f"o_{k} + x_{k} AS x_{k}" for k in range(n)) + f" FROM s_{t})")
    return out


def _model_report(name: str) -> str:
    """The report of a classifier from ``scored`` (split, label, score, prediction)."""
    return f"""SELECT '{name}' AS model, c.split, rows, accuracy, auc, predicted_positive
        FROM (SELECT split, count(*) AS rows, avg(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS accuracy,
                     count(*) FILTER (WHERE prediction = 1) AS predicted_positive FROM scored GROUP BY 1) c
        JOIN (SELECT 'train' AS split, * FROM ({_auc('st')}) a UNION ALL SELECT 'val', * FROM ({_auc('sv')}) b) u
          ON u.split = c.split"""


SCORED_PARTS = ("st AS (SELECT * FROM scored WHERE split = 'train')", "sv AS (SELECT * FROM scored WHERE split = 'val')")


def _poisson_limits(draws: int) -> list[int]:
    """Poisson(1) distribution function at 0, 1, ... in 32-bit units."""
    return [math.floor(sum(math.exp(-1.0) / math.factorial(i) for i in range(k + 1)) * 2**32) for k in range(draws)]


def _dow(ts: str) -> str:
    return f"CAST(dayofweek({ts}) AS INTEGER)"


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    ts = SESSION_TS

    q["scan_sessions"] = _with(L_CTE) + _present("SELECT * FROM l_sessions", ts)
    q["scan_products"] = _with(P_CTE) + _present("SELECT * FROM products", dbl=("price",))
    prof = []
    for c, t in (("session_id", "bigint"), ("timestamp", "timestamp_ntz"), ("user_id", "bigint"),
                 ("product_id", "bigint"), ("event_type", "string"), ("offered_discount", "int"),
                 ("purchase_id", "bigint")):
        prof.append(f"""SELECT '{c}' AS "column", '{t}' AS data_type, count("{c}") AS non_null,
                        count(*) AS rows FROM e_sessions""")
    q["profile_sessions"] = _with(E_CTE) + " UNION ALL ".join(prof)
    q["variant_fields"] = """SELECT field, data_type, count(*) AS rows FROM (
        SELECT 'event_id' AS field, 'BIGINT' AS data_type FROM events UNION ALL
        SELECT 'user_id', CASE WHEN event_id % 10 = 0 THEN 'STRING' ELSE 'BIGINT' END FROM events UNION ALL
        SELECT 'event_type', 'STRING' FROM events UNION ALL
        SELECT 'props', 'OBJECT<k: BIGINT>' FROM events WHERE json_type(props, '$.k') IN ('UBIGINT', 'BIGINT')) f GROUP BY 1, 2"""
    q["preview_sessions"] = _with(E_CTE) + _present(
        """SELECT * FROM e_sessions ORDER BY "timestamp" NULLS FIRST, session_id NULLS FIRST,
           product_id NULLS FIRST, event_type NULLS FIRST, offered_discount NULLS FIRST,
           purchase_id NULLS FIRST LIMIT 5""", ts)

    q["session_price_projection"] = _with(L_CTE, P_CTE) + _present(
        """SELECT s.session_id, s."timestamp", s.user_id, s.product_id, s.event_type, s.offered_discount,
                  p.price FROM l_sessions s JOIN products p ON s.product_id = p.product_id""", ts, ("price",))
    q["rename_columns"] = _with(L_CTE) + """SELECT session_id,
        ((epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) // 1000000) % 86400 AS time_diff
        FROM l_sessions GROUP BY session_id"""
    q["drop_columns"] = _with(L_CTE) + f"""SELECT session_id, user_id, product_id, event_type, offered_discount,
        CAST(day("timestamp") AS INTEGER) AS day, CAST(month("timestamp") AS INTEGER) AS month,
        CAST(year("timestamp") AS INTEGER) AS year, CAST(hour("timestamp") AS INTEGER) AS hour,
        {_dow('"timestamp"')} AS weekday FROM l_sessions"""
    q["filter_buys"] = _with(L_CTE) + _present(
        "SELECT * FROM l_sessions WHERE event_type = 'BUY_PRODUCT'", ts)
    b, e = R.OPEN_WINDOW
    q["filter_time_open"] = _with(L_CTE) + _present(
        f"""SELECT * FROM l_sessions WHERE "timestamp" > TIMESTAMP '{b}' AND "timestamp" < TIMESTAMP '{e}'""", ts)
    y, m = R.MONTH
    m_next = f"{y + (m == 12):04d}-{m % 12 + 1:02d}-01"
    q["filter_month"] = _with(L_CTE) + _present(
        f"""SELECT * FROM l_sessions WHERE "timestamp" >= TIMESTAMP '{y:04d}-{m:02d}-01'
            AND "timestamp" < TIMESTAMP '{m_next}'""", ts)
    q["drop_missing_sessions"] = _with(LN_CTE) + _present(
        "SELECT * FROM ln_sessions WHERE user_id IS NOT NULL AND product_id IS NOT NULL", ts)
    q["rows_missing_product"] = _with(LN_CTE) + _present(
        "SELECT * FROM ln_sessions WHERE product_id IS NULL", ts)
    q["encode_event_type"] = _with(L_CTE) + _present(
        """SELECT *, CAST(CASE event_type WHEN 'VIEW_PRODUCT' THEN 0 WHEN 'BUY_PRODUCT' THEN 1 END AS INTEGER)
           AS event_code FROM l_sessions""", ts)
    q["purchase_value"] = _with(L_CTE, P_CTE, PRICED_CTE) + _present(
        "SELECT * FROM priced", ts, ("price", "purchase"))
    ev = f"""ev AS (SELECT user_id, CAST(year("timestamp") AS INTEGER) AS year, CAST(month("timestamp") AS INTEGER) AS month,
                   count(*) AS all_events_month FROM l_sessions WHERE user_id IS NOT NULL GROUP BY 1, 2, 3)"""
    bu = f"""bu AS (SELECT user_id, CAST(year("timestamp") AS INTEGER) AS year, CAST(month("timestamp") AS INTEGER) AS month,
                   count(*) AS buying_events_month FROM l_sessions
                   WHERE user_id IS NOT NULL AND event_type = 'BUY_PRODUCT' GROUP BY 1, 2, 3)"""
    q["fill_zero"] = _with(L_CTE, ev, bu) + """SELECT ev.user_id, ev.year, ev.month, ev.all_events_month,
        coalesce(bu.buying_events_month, 0) AS buying_events_month
        FROM ev LEFT JOIN bu ON ev.user_id = bu.user_id AND ev.year = bu.year AND ev.month = bu.month"""
    q["split_by_month"] = _with(L_CTE, P_CTE, PRICED_CTE) + _present(
        """SELECT *, CASE WHEN month("timestamp") = 3 THEN 'test' ELSE 'train' END AS split FROM priced""",
        ts, ("price", "purchase"))
    q["split_by_window"] = _with(*C1_CTES) + _present(_splits(), dbl=V3_DBL)
    q["user_history"] = _with(L_CTE) + _present(f"SELECT * FROM l_sessions WHERE user_id = {R.USER}", ts)
    q["product_lookup"] = _with(P_CTE) + _present(
        f"SELECT * FROM products WHERE product_id = {R.PRODUCT}", dbl=("price",))
    q["price_quality"] = _with(P_CTE) + """SELECT CAST(sum(n) AS BIGINT) AS products,
        CAST(sum(neg) AS BIGINT) AS negative_prices, CAST(sum(huge) AS BIGINT) AS huge_prices,
        CAST(sum(missing) AS BIGINT) AS missing_prices, count(*) FILTER (WHERE n > 1) AS duplicated_ids
        FROM (SELECT product_id, count(*) AS n, count(*) FILTER (WHERE price < 0) AS neg,
                     count(*) FILTER (WHERE price > 100000.0) AS huge,
                     count(*) FILTER (WHERE price IS NULL) AS missing FROM products GROUP BY product_id) t"""
    q["missing_purchase_views"] = _with(L_CTE) + _present(
        """SELECT count(*) AS views, avg(CASE WHEN purchase_id IS NULL THEN 1 ELSE 0 END) AS null_share
           FROM l_sessions WHERE event_type = 'VIEW_PRODUCT'""", dbl=("null_share",))

    # joins
    q["sessions_with_price"] = _with(L_CTE, P_CTE) + _present(
        "SELECT s.*, p.price FROM l_sessions s JOIN products p ON s.product_id = p.product_id", ts, ("price",))
    q["deals"] = _with(LN_CTE, P_CTE) + _present(
        """SELECT s.*, p.price FROM ln_sessions s LEFT JOIN products p ON s.product_id = p.product_id
           WHERE s.event_type = 'BUY_PRODUCT'""", ts, ("price",))
    q["left_join_keys"] = _with(*C1_CTES, ev, bu, """sy AS (
        SELECT user_id, CAST(month_idx // 12 AS INTEGER) AS year, sum(spend) AS spent_money_year
        FROM facts GROUP BY 1, 2)""",
        """tot AS (SELECT user_id, sum(spend) AS total_spend FROM facts GROUP BY 1)""") + _present(
        """SELECT ev.user_id, ev.year, ev.month, ev.all_events_month, bu.buying_events_month,
                  sy.spent_money_year, tot.total_spend
           FROM ev LEFT JOIN bu ON ev.user_id = bu.user_id AND ev.year = bu.year AND ev.month = bu.month
           LEFT JOIN sy ON ev.user_id = sy.user_id AND ev.year = sy.year
           LEFT JOIN tot ON ev.user_id = tot.user_id""", dbl=("spent_money_year", "total_spend"))
    q["user_month_next"] = _with(*C1_CTES) + _present(
        """SELECT a.user_id, a.events, a.buys, a.spend, coalesce(n1.buys, 0) AS buys_next,
                  coalesce(n1.events, 0) AS events_next, coalesce(n1.spend, 0) AS spend_next,
                  coalesce(n2.spend, 0) AS spend_next2, CAST(a.month_idx // 12 AS INTEGER) AS year,
                  CAST(a.month_idx % 12 + 1 AS INTEGER) AS month
           FROM facts a
           LEFT JOIN facts n1 ON n1.user_id = a.user_id AND n1.month_idx = a.month_idx + 1
           LEFT JOIN facts n2 ON n2.user_id = a.user_id AND n2.month_idx = a.month_idx + 2""",
        dbl=("spend", "spend_next", "spend_next2"))
    lo, hi = month_range(*R.SPINE_WINDOW)
    q["user_month_spine"] = _with(L_CTE) + f"""SELECT u.user_id, CAST(g.m // 12 AS INTEGER) AS year,
        CAST(g.m % 12 + 1 AS INTEGER) AS month
        FROM (SELECT DISTINCT user_id FROM l_sessions WHERE user_id IS NOT NULL) u, generate_series({lo}, {hi}) g(m)"""
    q["session_summary"] = _with(E_CTE, SS_CTE) + "SELECT * FROM ss"
    q["user_features"] = _with(L_CTE, P_CTE, PRICED_CTE, TRAIN_CTE, TREND_CTE,
                               f"base AS ({_user_base('train')})") + _present(
        """SELECT base.*, coalesce(tr.spending_trend, CAST(0 AS DOUBLE)) AS spending_trend
           FROM base LEFT JOIN tr ON base.user_id = tr.user_id""",
        dbl=("total_sum", "mean_discount", "corr_purchase_discount", "spending_trend"))
    b, e = R.SPAN
    q["missing_dates"] = _with(L_CTE) + f"""SELECT strftime(CAST(g.d AS DATE), '%Y-%m-%d') AS date
        FROM generate_series(TIMESTAMP '{b}', TIMESTAMP '{e}', INTERVAL 1 DAY) g(d)
        WHERE CAST(g.d AS DATE) NOT IN (SELECT DISTINCT CAST("timestamp" AS DATE) FROM l_sessions)"""

    # aggregations
    q["event_type_counts"] = _with(E_CTE) + "SELECT event_type, count(*) AS rows FROM e_sessions GROUP BY 1"
    q["discount_counts"] = _with(LN_CTE, CLEAN_CTE) + \
        "SELECT offered_discount, count(*) AS rows FROM clean GROUP BY 1"
    q["session_product_count"] = _with(E_CTE, SS_CTE) + "SELECT session_id, n_products FROM ss"
    q["session_outcome"] = _with(E_CTE, SS_CTE) + "SELECT session_id, bought FROM ss"
    q["purchase_prob_by_views"] = _with(E_CTE, SS_CTE) + _present(
        "SELECT n_products, avg(bought) AS purchase_prob, count(*) AS sessions FROM ss GROUP BY 1",
        dbl=("purchase_prob",))
    q["session_duration"] = _with(E_CTE, SS_CTE) + \
        "SELECT session_id, seconds_total, seconds_mod_day FROM ss"
    q["duration_outcome"] = _with(E_CTE, SS_CTE) + \
        "SELECT session_id, seconds_total, seconds_mod_day, bought FROM ss"
    q["purchase_prob_by_duration"] = _with(E_CTE, SS_CTE, """hv AS (SELECT CAST(seconds_total AS DOUBLE) AS x, bought FROM ss),
hb AS (SELECT min(x) AS lo, max(x) AS hi FROM hv),
hc AS (SELECT CAST(CASE WHEN hb.hi = hb.lo THEN 0
                        ELSE LEAST(floor((hv.x - hb.lo) * 10 / (hb.hi - hb.lo)), 9) END AS INTEGER) AS bin,
              count(*) AS sessions, avg(bought) AS purchase_prob FROM hv, hb GROUP BY 1),
he AS (SELECT CAST(g.i AS INTEGER) AS bin,
              CASE WHEN hb.hi = hb.lo THEN hb.lo ELSE hb.lo + g.i * ((hb.hi - hb.lo) / 10) END AS bin_lo,
              CASE WHEN hb.hi = hb.lo OR g.i = 9 THEN hb.hi ELSE hb.lo + (g.i + 1) * ((hb.hi - hb.lo) / 10) END AS bin_hi
       FROM hb, generate_series(0, 9) g(i) WHERE hb.hi <> hb.lo OR g.i = 0)""") + _present(
        """SELECT he.bin, he.bin_lo, he.bin_hi, coalesce(hc.sessions, 0) AS sessions, hc.purchase_prob
           FROM he LEFT JOIN hc ON he.bin = hc.bin""", dbl=("bin_lo", "bin_hi", "purchase_prob"))
    q["product_purchase_dist"] = _with(L_CTE) + """SELECT buys, count(*) AS products FROM (
        SELECT product_id, count(*) AS buys FROM l_sessions
        WHERE event_type = 'BUY_PRODUCT' AND product_id IS NOT NULL GROUP BY 1) t GROUP BY 1"""
    conv = """SELECT product_id, avg(CASE event_type WHEN 'VIEW_PRODUCT' THEN 0 WHEN 'BUY_PRODUCT' THEN 1 END)
              AS conversion, count(*) AS rows FROM l_sessions WHERE product_id IS NOT NULL GROUP BY 1"""
    q["product_conversion"] = _with(L_CTE) + _present(conv, dbl=("conversion",))
    q["best_conversion"] = _with(L_CTE) + _present(
        f"SELECT max(conversion) AS best_conversion FROM ({conv}) t", dbl=("best_conversion",))
    parts = []
    for c in ("user_id", "product_id", "purchase_id"):
        miss = f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END"
        parts.append(f"""SELECT '{c}' AS "column", avg({miss}) AS null_share,
            avg(CASE WHEN event_type = 'VIEW_PRODUCT' THEN {miss} END) AS null_share_views,
            avg(CASE WHEN event_type = 'BUY_PRODUCT' THEN {miss} END) AS null_share_buys,
            count(*) AS rows FROM ln_sessions""")
    q["missing_fraction"] = _with(LN_CTE) + _present(
        " UNION ALL ".join(parts), dbl=("null_share", "null_share_views", "null_share_buys"))
    q["distinct_counts"] = _with(E_CTE) + """SELECT count(DISTINCT user_id) AS users,
        count(DISTINCT session_id) AS sessions, count(DISTINCT product_id) AS products
        FROM e_sessions WHERE user_id IS NOT NULL AND product_id IS NOT NULL"""
    q["distinct_periods"] = _with(LN_CTE, CLEAN_CTE) + """
        SELECT DISTINCT 'year' AS kind, CAST(year("timestamp") AS BIGINT) AS value FROM clean
        UNION ALL SELECT DISTINCT 'month', CAST(month("timestamp") AS BIGINT) FROM clean
        UNION ALL SELECT DISTINCT 'user', user_id FROM clean"""
    q["data_extent"] = _with(E_CTE) + _present(
        """SELECT min("timestamp") AS first_ts, max("timestamp") AS last_ts, count(*) AS rows FROM e_sessions""",
        ("first_ts", "last_ts"))
    q["hist_session_products"] = _with(E_CTE, SS_CTE, _hist("ss", "n_products", 10)) + _present(
        HIST_SELECT, dbl=HIST_DBL)
    q["hist_duration"] = _with(E_CTE, SS_CTE, _hist("ss", "seconds_mod_day", 10)) + _present(
        HIST_SELECT, dbl=HIST_DBL)
    q["hist_discount"] = _with(LN_CTE, CLEAN_CTE, _hist("clean", "offered_discount", 20)) + _present(
        HIST_SELECT, dbl=HIST_DBL)
    q["hist_user_discount"] = _with(
        LN_CTE, CLEAN_CTE,
        "ud AS (SELECT user_id, avg(offered_discount) AS mean_discount FROM clean GROUP BY 1)",
        _hist("ud", "mean_discount", 10)) + _present(HIST_SELECT, dbl=HIST_DBL)
    q["hist_purchase"] = _with(L_CTE, P_CTE, PRICED_CTE, _hist("priced", "purchase", 10)) + _present(
        HIST_SELECT, dbl=HIST_DBL)
    q["hist_log_purchase"] = _with(
        L_CTE, P_CTE, PRICED_CTE, "lp AS (SELECT ln(1 + purchase) AS log_purchase FROM priced)",
        _hist("lp", "log_purchase", 10)) + _present(HIST_SELECT, dbl=HIST_DBL)
    q["conversion_by_discount"] = _with(LN_CTE, CLEAN_CTE) + _present(
        """SELECT offered_discount, avg(CASE event_type WHEN 'VIEW_PRODUCT' THEN 0 WHEN 'BUY_PRODUCT' THEN 1 END)
           AS conversion, count(*) AS rows FROM clean GROUP BY 1""", dbl=("conversion",))
    tr = (L_CTE, P_CTE, PRICED_CTE, TRAIN_CTE)
    q["user_mean_discount"] = _with(*tr) + _present(
        "SELECT user_id, avg(offered_discount) AS mean_discount FROM train GROUP BY 1", dbl=("mean_discount",))
    q["user_total_spend"] = _with(*tr) + _present(
        """SELECT user_id, coalesce(sum(CAST(purchase AS DECIMAL(28,6))), CAST(0 AS DECIMAL(38,6))) AS total_sum
           FROM train GROUP BY 1""", dbl=("total_sum",))
    q["user_corr_discount"] = _with(*tr) + _present(
        f"SELECT user_id, corr_purchase_discount FROM ({_user_base('train')}) t",
        dbl=("corr_purchase_discount",))
    q["user_spending_trend"] = _with(*tr, TREND_CTE) + _present(
        "SELECT user_id, spending_trend FROM tr", dbl=("spending_trend",))
    for order, b1, cubic in ((2, "y1 / s2", "0"), (3, "(y1 - s4 * b3) / s2", "3 * b3 * first * first")):
        q[f"user_trend_order{order}"] = _with(*tr, TREND_CTE, MOMENT_CTE) + _present(
            f"""SELECT user_id, round(CASE WHEN n < 2 THEN CAST(0 AS DOUBLE) ELSE {b1} + 2 * b2 * first + {cubic} END, 9)
                AS spending_trend FROM co""", dbl=("spending_trend",))
    q["user_month_buys"] = _with(L_CTE, bu) + "SELECT * FROM bu"
    q["user_month_events"] = _with(L_CTE, ev) + "SELECT * FROM ev"
    q["user_year_activity"] = _with(L_CTE) + """SELECT user_id, CAST(year("timestamp") AS INTEGER) AS year,
        count(*) AS all_sessions, count(*) FILTER (WHERE event_type = 'BUY_PRODUCT') AS buying_sessions
        FROM l_sessions WHERE user_id IS NOT NULL GROUP BY 1, 2"""
    q["user_month_spend"] = _with(*C1_CTES) + _present(
        """SELECT user_id, CAST(month_idx // 12 AS INTEGER) AS year, CAST(month_idx % 12 + 1 AS INTEGER) AS month,
                  spend FROM facts WHERE buys > 0""", dbl=("spend",))
    b, e = R.YEAR_SPEND_WINDOW
    q["user_year_spend"] = _with(L_CTE, P_CTE) + _present(
        f"""SELECT s.user_id, CAST(year(s."timestamp") AS INTEGER) AS year,
                   coalesce(sum(CAST(p.price AS DECIMAL(28,6))), CAST(0 AS DECIMAL(38,6))) AS spent_money
            FROM l_sessions s LEFT JOIN products p ON s.product_id = p.product_id
            WHERE s.user_id IS NOT NULL AND s.event_type = 'BUY_PRODUCT'
              AND s."timestamp" > TIMESTAMP '{b}' AND s."timestamp" < TIMESTAMP '{e}' GROUP BY 1, 2""",
        dbl=("spent_money",))
    label_rows = """SELECT a.user_id, CAST(a.month_idx // 12 AS INTEGER) AS year,
               CAST(a.month_idx % 12 + 1 AS INTEGER) AS month, a.spend,
               coalesce(n1.spend, 0) AS spend_next,
               CAST(a.spend + coalesce(n1.spend, 0) AS DOUBLE) / 2 AS two_month_average,
               coalesce(n2.spend, 0) AS spend_third,
               CASE WHEN 2 * coalesce(n2.spend, 0) - (a.spend + coalesce(n1.spend, 0)) > 200 THEN 1 ELSE 0 END AS label
        FROM facts a
        LEFT JOIN facts n1 ON n1.user_id = a.user_id AND n1.month_idx = a.month_idx + 1
        LEFT JOIN facts n2 ON n2.user_id = a.user_id AND n2.month_idx = a.month_idx + 2
        WHERE a.buys > 0"""
    q["two_month_average"] = _with(*C1_CTES) + _present(
        f"SELECT user_id, year, month, two_month_average FROM ({label_rows}) t", dbl=("two_month_average",))
    q["spend_more_label"] = _with(*C1_CTES) + _present(
        label_rows, dbl=("spend", "spend_next", "two_month_average", "spend_third"))
    q["class_balance"] = _with(*C1_CTES) + _present(
        f"SELECT split, count(*) AS rows, avg(label) AS positive_share FROM ({_splits()}) s GROUP BY 1",
        dbl=("positive_share",))

    # composite jobs
    q["training_set_v3"] = _with(*C1_CTES) + _present(_c1(*R.SPAN), dbl=V3_DBL)
    v2_dbl = ("month_sin", "month_cos", "spent_money", "spent_money_first_month", "spent_money_second_month")
    q["features_v2"] = _with(*C1_CTES, _v12(*R.V2_WINDOW)) + _present(
        """SELECT DISTINCT year, month, month_sin, month_cos, buying_sessions, label, spent_money,
                  spent_money_first_month, spent_money_second_month, buying_events_first_month,
                  buying_events_second_month, all_events_first_month, all_events_second_month FROM v12""",
        dbl=v2_dbl)
    q["features_v1"] = _with(*C1_CTES, _v12(*R.V1_WINDOW)) + _present(
        """SELECT year, month, user_id, month_sin, month_cos, buying_sessions, spent_money,
                  spent_money_first_month AS first_month, spent_money_second_month AS second_month,
                  buying_events_first_month, buying_events_second_month FROM v12""",
        dbl=("month_sin", "month_cos", "spent_money", "first_month", "second_month"))

    # windows / sets
    q["purchase_position"] = _with(*tr, TREND_CTE) + _present(
        'SELECT user_id, "timestamp", session_id, product_id, purchase, position FROM nz', ts, ("purchase",))
    q["union_months"] = _with(*C1_CTES) + _present(
        " UNION ALL ".join(_c1(f"{y}-01-01", f"{y}-12-31") for y in range(1995, 2002)), dbl=V3_DBL)
    q["dedupe_features"] = _with(*C1_CTES) + _present(
        f"SELECT DISTINCT {V3} FROM ({' UNION ALL '.join(_c1_rows(f'{y}-01-01', f'{y}-12-31') for y in range(1995, 2002))}) r",
        dbl=V3_DBL)
    b, e = R.EVENTS_DAYS
    q["date_difference"] = _with(E_CTE) + f"""SELECT strftime(d, '%Y-%m-%d') AS date FROM (
        SELECT CAST(g.d AS DATE) AS d FROM generate_series(TIMESTAMP '{b}', TIMESTAMP '{e}', INTERVAL 1 DAY) g(d)
        EXCEPT SELECT CAST("timestamp" AS DATE) FROM e_sessions) t"""

    # scalar functions
    q["time_parts"] = _with(E_CTE) + f"""SELECT session_id, strftime("timestamp", {TS}) AS "timestamp",
        strftime("timestamp", '%Y-%m-%d') AS date, strftime("timestamp", '%H:%M:%S') AS time,
        CAST(day("timestamp") AS INTEGER) AS day, CAST(month("timestamp") AS INTEGER) AS month,
        CAST(year("timestamp") AS INTEGER) AS year, CAST(hour("timestamp") AS INTEGER) AS hour,
        {_dow('"timestamp"')} AS weekday FROM e_sessions"""
    k23, k12, k7, k31 = _k(23.0), _k(12.0), _k(7.0), _k(31.0)
    q["cyclic_hour"] = _with(E_CTE) + _present(
        f"""SELECT session_id, "timestamp", CAST(hour("timestamp") AS INTEGER) AS hour,
                   sin(CAST(hour("timestamp") AS DOUBLE) * {k23}) AS hour_sin,
                   cos(CAST(hour("timestamp") AS DOUBLE) * {k23}) AS hour_cos FROM e_sessions""",
        ts, ("hour_sin", "hour_cos"))
    q["cyclic_month"] = _with(L_CTE) + _present(
        f"""SELECT session_id, product_id, CAST(month("timestamp") AS INTEGER) AS month,
                   sin(CAST(month("timestamp") AS DOUBLE) * {k12}) AS month_sin,
                   cos(CAST(month("timestamp") AS DOUBLE) * {k12}) AS month_cos FROM l_sessions""",
        dbl=("month_sin", "month_cos"))
    q["cyclic_day"] = _with(E_CTE) + _present(
        f"""SELECT session_id, "timestamp", {_dow('"timestamp"')} AS weekday,
                   sin(CAST(dayofweek("timestamp") AS DOUBLE) * {k7}) AS weekday_sin,
                   cos(CAST(dayofweek("timestamp") AS DOUBLE) * {k7}) AS weekday_cos,
                   CAST(day("timestamp") AS INTEGER) AS day,
                   sin(CAST(day("timestamp") AS DOUBLE) * {k31}) AS day_sin,
                   cos(CAST(day("timestamp") AS DOUBLE) * {k31}) AS day_cos FROM e_sessions""",
        ts, ("weekday_sin", "weekday_cos", "day_sin", "day_cos"))
    q["parse_text_time"] = _with(E_CTE) + f"""SELECT session_id,
        strftime(date_trunc('second', "timestamp"), {TS}) AS parsed,
        strftime("timestamp", '%Y-%m-%d') AS parsed_date, CAST(NULL AS VARCHAR) AS not_a_time FROM e_sessions"""
    lo, hi = month_range(*R.SPAN)
    q["month_range"] = _with(L_CTE) + f"""SELECT strftime(make_date(g.m // 12, g.m % 12 + 1, 1), '%Y-%m-%d') AS month_start,
        count(s.session_id) AS rows
        FROM generate_series({lo}, {hi}) g(m) LEFT JOIN l_sessions s ON {MIDX.replace('"timestamp"', 's."timestamp"')} = g.m
        GROUP BY g.m"""
    q["month_steps"] = _with(L_CTE) + """SELECT strftime(m, '%Y-%m-%d') AS month_start,
        strftime(m + INTERVAL 1 MONTH, '%Y-%m-%d') AS next_month,
        strftime(m + INTERVAL 2 MONTH, '%Y-%m-%d') AS third_month
        FROM (SELECT DISTINCT CAST(date_trunc('month', "timestamp") AS DATE) AS m FROM l_sessions) t"""

    # models (rule scores)
    q["feature_label_rows"] = _with(*C1_CTES) + _present(_c1(*R.TRAIN), dbl=V3_DBL)
    q["baseline_accuracy"] = _with(*C1_CTES) + _present(
        f"""SELECT split, count(*) AS rows, avg(label) AS positive_share,
                   CASE WHEN (SELECT avg(label) > 0.5 FROM ({_c1(*R.TRAIN)}) m) THEN avg(label)
                        ELSE 1 - avg(label) END AS baseline_accuracy FROM ({_splits()}) s GROUP BY 1""",
        dbl=("positive_share", "baseline_accuracy"))
    feats = [c.strip() for c in V3.split(",") if c.strip() != "label"]
    stats = ", ".join(f"avg({f}) AS mean_{f}, var_pop({f}) AS var_{f}" for f in feats)
    q["gnb_class_stats"] = _with(*C1_CTES) + _present(
        f"SELECT label, count(*) AS rows, {stats} FROM ({_c1(*R.TRAIN)}) t GROUP BY label",
        dbl=tuple(f"{p}_{f}" for f in feats for p in ("mean", "var")))
    def gauss(c: int) -> str:
        return f"ln(n_{c} / CAST(n_0 + n_1 AS DOUBLE))" + "".join(
            f" - 0.5 * (ln(2 * pi() * (v{c}_{f} + eps)) + ({f} - m{c}_{f}) ** 2 / (v{c}_{f} + eps))" for f in feats)

    per_class = ", ".join(
        f"avg({f}) FILTER (WHERE label = {c}) AS m{c}_{f}, avg(CAST({f} AS DOUBLE) * {f}) FILTER (WHERE label = {c}) - "
        f"(avg({f}) FILTER (WHERE label = {c})) ** 2 AS v{c}_{f}" for c in (0, 1) for f in feats)
    floor = ", ".join(f"avg(CAST({f} AS DOUBLE) * {f}) - avg({f}) ** 2" for f in feats)
    q["gnb_scores"] = _with(*C1_CTES, f"rows_ AS MATERIALIZED ({_splits()})", f"""cs AS MATERIALIZED (
        SELECT count(*) FILTER (WHERE label = 0) AS n_0, count(*) FILTER (WHERE label = 1) AS n_1,
               1e-9 * greatest({floor}) AS eps, {per_class} FROM rows_ WHERE split = 'train')""",
        f"raw AS (SELECT split, label, {gauss(1)} AS r1, {gauss(0)} AS r0 FROM rows_, cs)",
        "scored AS MATERIALIZED (SELECT split, label, r1 - r0 AS score, CASE WHEN r1 > r0 THEN 1 ELSE 0 END AS prediction FROM raw)",
        *SCORED_PARTS) + _present(_model_report("gnb"), dbl=("accuracy", "auc"))
    eta = " + ".join(f"x_{k} * z_{k}" for k in range(len(feats) + 1))
    q["logit_scores"] = _with(*C1_CTES, f"rows_ AS MATERIALIZED ({_splits()})", *_standard("rows_", feats, "label"),
                              *_newton(len(feats), 7), f"""scored AS MATERIALIZED (
        SELECT split, label, {eta} AS score, CASE WHEN {eta} > 0 THEN 1 ELSE 0 END AS prediction FROM z, beta)""",
        *SCORED_PARTS) + _present(_model_report("logit"), dbl=("accuracy", "auc"))
    n = len(feats)
    sums = ", ".join([f"sum(z_{i} * z_{j}) AS a_{i}_{j}" for i in range(n) for j in range(i + 1)]
                     + [f"sum(z_{k} * (spend_third - m)) AS r_{k}" for k in range(n)] + ["any_value(m) AS m"])
    value = " + ".join(["m", *(f"x_{k} * z_{k}" for k in range(n))])
    q["spend_regression"] = _with(*C1_CTES, f"""rows_ AS MATERIALIZED (
        SELECT *, 'train' AS split FROM ({_c1_rows(*R.TRAIN)}) t UNION ALL SELECT *, 'val' AS split FROM ({_c1_rows(*R.VAL)}) v)""",
        *_standard("rows_", feats, "spend_third"), f"""g AS MATERIALIZED (
        SELECT {sums} FROM z, (SELECT avg(spend_third) AS m FROM z WHERE split = 'train') k WHERE split = 'train')""",
        *_solve("g", n, "sol"), f"pr AS (SELECT split, spend_third, {value} - spend_third AS e FROM z, sol)") + _present(
        """SELECT split, count(*) AS rows, sqrt(avg(e * e)) AS rmse,
                  1 - sum(e * e) / (var_pop(spend_third) * count(*)) AS r2 FROM pr GROUP BY 1""", dbl=("rmse", "r2"))
    rule = f"""SELECT *, spent_money_second_month - spent_money_first_month AS score, {RULE} AS prediction
               FROM ({_splits()}) s"""
    q["metric_accuracy"] = _with(*C1_CTES, f"scored AS ({rule})") + _present(
        """SELECT split, count(*) AS rows, avg(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS accuracy
           FROM scored GROUP BY 1""", dbl=("accuracy",))
    q["metric_auc"] = _with(*C1_CTES, f"scored AS ({rule})",
                            "st AS (SELECT * FROM scored WHERE split = 'train')",
                            "sv AS (SELECT * FROM scored WHERE split = 'val')") + _present(
        f"SELECT 'train' AS split, * FROM ({_auc('st')}) a UNION ALL SELECT 'val' AS split, * FROM ({_auc('sv')}) b",
        dbl=("auc",))
    q["metric_confusion"] = _with(*C1_CTES, f"scored AS ({rule})") + """
        SELECT g.label, g.prediction, coalesce(c.rows, 0) AS rows
        FROM (SELECT CAST(a.i AS INTEGER) AS label, CAST(b.i AS INTEGER) AS prediction
              FROM generate_series(0, 1) a(i), generate_series(0, 1) b(i)) g
        LEFT JOIN (SELECT label, prediction, count(*) AS rows FROM scored WHERE split = 'val' GROUP BY 1, 2) c
          ON g.label = c.label AND g.prediction = c.prediction"""
    z = ", ".join(
        f"round(CASE WHEN st.s_{f} IS NULL OR st.s_{f} = 0 THEN 0 ELSE (t.{f} - st.m_{f}) / st.s_{f} END, 6) AS z_{f}"
        for f in feats)
    mstats = ", ".join(f"avg({f}) AS m_{f}, stddev_samp({f}) AS s_{f}" for f in feats)
    q["scale_features"] = _with(*C1_CTES, f"t AS ({_c1(*R.TRAIN)})", f"st AS (SELECT {mstats} FROM t)") + _present(
        f"SELECT {z}, t.label FROM t, st", dbl=tuple(f"z_{f}" for f in feats))

    # A/B
    arm = f"CAST('0x' || substr(md5('{R.AB_SALT}:' || user_id), 1, 8) AS BIGINT) % 2"
    q["ab_assign"] = _with(L_CTE) + f"""SELECT user_id,
        CASE WHEN {arm} = 0 THEN 'BaseModel' ELSE 'SecondModel' END AS model_type
        FROM (SELECT DISTINCT user_id FROM l_sessions WHERE user_id IS NOT NULL) u"""
    q["ab_compare"] = _with(*C1_CTES, f"""req AS (
        SELECT *, CASE WHEN {arm} = 0 THEN 'BaseModel' ELSE 'SecondModel' END AS model_type
        FROM ({_c1_rows(*R.VAL)}) r)""", """pr AS (
        SELECT *, CASE WHEN model_type = 'BaseModel' THEN spent_money_second_month
                       ELSE (spent_money_first_month + spent_money_second_month) / 2 END AS prediction FROM req)""") + \
        _present("""SELECT model_type, count(*) AS requests, avg(prediction) AS mean_prediction,
                           avg(abs(prediction - spend_third)) AS mae FROM pr GROUP BY 1""",
                 dbl=("mean_prediction", "mae"))
    limits = ", ".join(str(x) for x in _poisson_limits(12))
    q["ab_log_compare"] = _with(*C1_CTES, f"""log AS (
        SELECT user_id, CASE WHEN {arm} = 0 THEN 'BaseModel' ELSE 'SecondModel' END AS model_type,
               CASE WHEN {arm} = 0 THEN spent_money_second_month
                    ELSE (spent_money_first_month + spent_money_second_month) / 2 END AS prediction,
               CAST(month_idx + 2 + CASE WHEN user_id % 5 = 0 THEN 2 ELSE 0 END AS INTEGER) AS am
        FROM ({_c1_rows(*R.VAL)}) r)""", f"""third AS (
        SELECT a.user_id, a.month_idx, coalesce(n2.spend, 0) AS spend FROM facts a
        LEFT JOIN facts n2 ON n2.user_id = a.user_id AND n2.month_idx = a.month_idx + 2 WHERE a.buys > 0)""", f"""met AS (
        SELECT log.*, t.month_idx + 2 > (SELECT max({MIDX}) FROM l_sessions) AS late, t.spend
        FROM log ASOF LEFT JOIN third t ON t.user_id = log.user_id AND log.am - 2 >= t.month_idx)""", """er AS (
        SELECT model_type, prediction, coalesce(late, false) AS pending,
               CAST(round(prediction * 1000000) AS BIGINT)
                 - CASE WHEN late THEN NULL ELSE CAST(spend * 1000000 AS BIGINT) END AS e,
               concat_ws('|', user_id, strftime(make_date(am // 12, am % 12 + 1, 5), '%m/%d/%Y') || ' 00:00:00:000000',
                         model_type, CAST(round(prediction * 1000000) AS BIGINT)) AS key FROM met)""", """dg AS (
        SELECT model_type, abs(e) AS e, b, md5('0:' || b || ':' || key) AS h
        FROM er, generate_series(0, 49) g(b) WHERE e IS NOT NULL)""", f"""wt AS (
        SELECT model_type, b, k, e, len(list_filter([{limits}], lambda x:
               x <= CAST('0x' || substr(h, CAST(8 * k + 1 AS INTEGER), 8) AS BIGINT))) AS w
        FROM dg, generate_series(0, 3) s(k))""", """rp AS (
        SELECT model_type, sum(CAST(w * e AS HUGEINT)) / CAST(sum(w) AS DOUBLE) / 1000000 AS mean
        FROM wt GROUP BY model_type, b, k HAVING sum(w) > 0)""", """sp AS (
        SELECT model_type, list_sort(list(mean)) AS m FROM rp GROUP BY 1)""") + _present(
        """SELECT er.model_type, count(*) AS requests, count(e) AS matched, count(*) FILTER (WHERE pending) AS pending,
                  avg(prediction) AS mean_prediction, avg(CAST(e AS DOUBLE)) / 1000000 AS mean_error,
                  avg(CAST(abs(e) AS DOUBLE)) / 1000000 AS mae,
                  any_value(m[6]) AS mae_low, any_value(m[195]) AS mae_high
           FROM er LEFT JOIN sp ON sp.model_type = er.model_type GROUP BY er.model_type""",
        dbl=("mean_prediction", "mean_error", "mae", "mae_low", "mae_high"))
    for name in ("left_join_keys", "user_month_next"):
        q[f"stored_{name}"] = q[name]
    return q


ORACLE = build()
