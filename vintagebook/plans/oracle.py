"""DuckDB SQL twins of the registered queries.

The reference roles are restated as SQL views over the driver's tables, and
the generated book SQL follows the reference's literal plan (per-entity
window anchor, population LEFT JOIN), which makes it an independent check of
the Spark plan.  ``r2`` rounds like Spark's ``round(x, 2)`` (HALF_UP on the
decimal value) instead of DuckDB's binary-double rounding.
"""

from __future__ import annotations

from collections.abc import Sequence

from ..functions.dates import shift_safra_value
from ..operators.book import AGGREGATES, DEFAULT_WINDOWS
from ..operators.joins import ORDER_VALUES
from .roles import DELIVERED_STATUS, ESTIMATED_DAYS, REFERENCE_SAFRA, REVIEW_DAYS


def r2(expr: str, digits: int = 2, exact: bool = False) -> str:
    """Spark's ``round``: HALF_UP on the shortest decimal text of a double, or on
    the exact value when Spark computed it in DECIMAL (``exact=True``)."""
    if exact:
        return f"CAST(round(CAST({expr} AS DECIMAL(38,{digits + 6})), {digits}) AS DOUBLE)"
    return f"CAST(round(TRY_CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


# Values that Spark aggregates as DECIMAL (exact sums and averages).
DECIMAL_VALUES = frozenset({"price", "freight_value", "total_price"})


def safra_sql(ts: str) -> str:
    return f"CAST(year({ts}) * 100 + month({ts}) AS INTEGER)"


ROLE_VIEWS = f"""
r_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
         o_orderdate AS order_purchase_timestamp,
         CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 AS INTEGER) AS TIMESTAMP) AS order_approved_at,
         CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INTEGER) AS TIMESTAMP) AS order_delivered_carrier_date,
         CAST(CAST(o_orderdate AS DATE) + {ESTIMATED_DAYS} AS TIMESTAMP) AS order_estimated_delivery_date,
         {safra_sql('o_orderdate')} AS safra
  FROM orders),
r_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
         l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS freight_value,
         l_shipdate AS order_delivered_customer_date
  FROM lineitem),
r_regions AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS state, r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey),
r_sellers AS (
  SELECT s_suppkey AS seller_id,
         CAST(s_nationkey * 1000 + s_suppkey % 1000 AS VARCHAR) AS seller_zip_code_prefix,
         s_name AS seller_city, CAST(s_nationkey AS VARCHAR) AS seller_state
  FROM supplier),
r_customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_unique_id,
         CAST(c_nationkey * 1000 + c_custkey % 1000 AS VARCHAR) AS customer_zip_code_prefix,
         c_mktsegment AS customer_city, CAST(c_nationkey AS VARCHAR) AS customer_state
  FROM customer),
r_reviews AS (
  SELECT o_orderkey AS review_id, o_orderkey AS order_id,
         CAST(1 + o_orderkey % 5 AS INTEGER) AS review_score,
         CAST(o_orderdate AS DATE) + {REVIEW_DAYS} AS review_creation_date,
         {safra_sql(f'(CAST(o_orderdate AS DATE) + {REVIEW_DAYS})')} AS safra
  FROM orders)"""


def _dd(end: str, start: str) -> str:
    return f"CAST(date_diff('day', CAST({start} AS DATE), CAST({end} AS DATE)) AS INTEGER)"


ORDER_FACT = f"""
r_order_fact AS (
  SELECT it.seller_id, o.customer_id, it.product_id, it.price, it.freight_value,
         it.price + it.freight_value AS total_price,
         CAST(it.freight_value AS DOUBLE) / NULLIF(CAST(it.price + it.freight_value AS DOUBLE), 0) AS freight_percentage,
         {_dd('it.order_delivered_customer_date', 'o.order_estimated_delivery_date')} AS dias_atraso,
         CASE WHEN it.order_delivered_customer_date > o.order_estimated_delivery_date THEN 1 ELSE 0 END AS fl_atraso,
         {_dd('it.order_delivered_customer_date', 'o.order_purchase_timestamp')} AS leadtime_total,
         {_dd('o.order_delivered_carrier_date', 'o.order_purchase_timestamp')} AS dias_ate_envio,
         {_dd('it.order_delivered_customer_date', 'o.order_delivered_carrier_date')} AS dias_transporte,
         {_dd('o.order_approved_at', 'o.order_purchase_timestamp')} AS dias_aprovacao,
         {_dd('it.order_delivered_customer_date', 'o.order_purchase_timestamp')}
           / NULLIF({_dd('it.order_delivered_customer_date', 'o.order_delivered_carrier_date')}, 0) AS eficiencia_logistica,
         sr.region AS seller_region, cr.region AS customer_region,
         CASE WHEN s.seller_state = c.customer_state THEN 1 ELSE 0 END AS fl_mesmo_estado,
         CASE WHEN sr.region = cr.region THEN 1 ELSE 0 END AS fl_mesma_regiao,
         abs(TRY_CAST(s.seller_zip_code_prefix AS DOUBLE) - TRY_CAST(c.customer_zip_code_prefix AS DOUBLE)) AS zip_distance_proxy,
         o.safra, o.order_purchase_timestamp, o.order_status
  FROM r_orders o
  JOIN r_items it ON o.order_id = it.order_id
  LEFT JOIN r_sellers s ON it.seller_id = s.seller_id
  LEFT JOIN r_regions sr ON s.seller_state = sr.state
  LEFT JOIN r_customers c ON o.customer_id = c.customer_id
  LEFT JOIN r_regions cr ON c.customer_state = cr.state
  WHERE it.seller_id IS NOT NULL)"""


def with_roles(*ctes: str) -> str:
    return "WITH " + ",".join([ROLE_VIEWS, *ctes])


def _agg_sql(kind: str, masked: str, exact: bool = False) -> str:
    if kind == "med":
        return r2(f"avg({masked})", exact=exact)
    if kind == "max":
        return r2(f"max({masked})", exact=exact)
    if kind == "min":
        return r2(f"min({masked})", exact=exact)
    if kind == "std":
        return r2(f"stddev_samp({masked})")
    if kind == "qtd":
        return f"CAST(count({masked}) AS BIGINT)"
    raise ValueError(kind)


def book_ctes(prefix: str, fact_name: str, entity: str, safras: Sequence[int],
              values: Sequence[str], suffix: str, group_extra: Sequence[str] = (),
              months: Sequence[int] = DEFAULT_WINDOWS, where: str = "TRUE") -> list[str]:
    """CTEs computing the book for every reference safra in ``safras``, in the
    reference's literal form: population = DISTINCT (entity, safra) at the
    reference month, flags anchored on each entity's latest month in its
    13-month history (window), one GROUP BY, population LEFT JOIN features."""
    span = max(months)
    refs = ", ".join(f"({s}, {shift_safra_value(s, -span)})" for s in safras)
    part = f"{entity}, ref"
    flags = ",\n".join(
        f"CASE WHEN data_dt BETWEEN CAST(max(data_dt) OVER (PARTITION BY {part}) - INTERVAL {m} MONTH AS DATE)"
        f" AND max(data_dt) OVER (PARTITION BY {part}) THEN 1 ELSE 0 END AS u{m}m" for m in months)
    aggs = []
    for m in months:
        for v in values:
            masked = f"CASE WHEN u{m}m = 1 THEN {v} END"
            for kind in AGGREGATES:
                aggs.append(f"{_agg_sql(kind, masked, v in DECIMAL_VALUES)} AS vl_{kind}_u{m}m_{v}{suffix}")
    ratios = []
    wins = [f"u{m}m" for m in months]
    for a, b in zip(wins[:-1], wins[1:]):
        for v in values:
            num, den = f"vl_med_{a}_{v}{suffix}", f"vl_med_{b}_{v}{suffix}"
            ratios.append(f"CASE WHEN {den} <> 0 THEN {num} / {den} END AS raz_med_{a}_{b}_{v}{suffix}")
    keys = ", ".join([entity, "ref", *group_extra])
    p = prefix
    return [
        f"{p}_refs AS (SELECT * FROM (VALUES {refs}) t(ref, lo))",
        f"""{p}_pop AS (SELECT DISTINCT f.{entity}, f.safra AS ref FROM {fact_name} f
                 JOIN {p}_refs r ON f.safra = r.ref WHERE {where})""",
        f"""{p}_hist AS (SELECT f.*, r.ref, make_date(CAST(f.safra // 100 AS INTEGER), CAST(f.safra % 100 AS INTEGER), 1) AS data_dt
                  FROM {fact_name} f JOIN {p}_refs r ON f.safra BETWEEN r.lo AND r.ref WHERE {where})""",
        f"{p}_flagged AS (SELECT *, {flags} FROM {p}_hist)",
        f"{p}_agg AS (SELECT {keys}, {', '.join(aggs)} FROM {p}_flagged GROUP BY {keys})",
        f"""{p}_book AS (SELECT pp.{entity}, CAST(pp.ref AS INTEGER) AS safra, a.* EXCLUDE ({entity}, ref)
                  FROM {p}_pop pp LEFT JOIN {p}_agg a ON pp.{entity} = a.{entity} AND pp.ref = a.ref)""",
        f"{p}_final AS (SELECT *, {', '.join(ratios)} FROM {p}_book)",
    ]


def book_sql(fact_cte: str, fact_name: str, entity: str, safra: int | Sequence[int],
             values: Sequence[str], suffix: str, group_extra: Sequence[str] = (),
             months: Sequence[int] = DEFAULT_WINDOWS, where: str = "TRUE") -> str:
    safras = [safra] if isinstance(safra, int) else list(safra)
    ctes = book_ctes("bk", fact_name, entity, safras, values, suffix, group_extra, months, where)
    return with_roles(fact_cte, *ctes) + "\nSELECT * FROM bk_final"


def book_orders_sql(safra: int | Sequence[int] = REFERENCE_SAFRA,
                    values: Sequence[str] = ORDER_VALUES) -> str:
    return book_sql(ORDER_FACT, "r_order_fact", "seller_id", safra, values, "_orders",
                    group_extra=("seller_region",), where=f"order_status = '{DELIVERED_STATUS}'")


REVIEW_FACT = """
r_review_fact AS (
  SELECT it.seller_id, r.review_score, r.review_creation_date, r.safra
  FROM r_reviews r JOIN r_items it ON r.order_id = it.order_id
  WHERE it.seller_id IS NOT NULL)"""


def book_reviews_sql(safra: int | Sequence[int] = REFERENCE_SAFRA) -> str:
    return book_sql(REVIEW_FACT, "r_review_fact", "seller_id", safra, ("review_score",), "_reviews")


# ---------------------------------------------------------------- bronze / silver
DUCK_FORMATS = ("%Y-%m-%d %H:%M:%S", "%Y/%m/%d %H:%M:%S", "%d/%m/%Y %H:%M:%S",
                "%d-%m-%Y %H:%M:%S", "%Y-%m-%d", "%Y/%m/%d", "%d/%m/%Y", "%d-%m-%Y")


def fmt_sql(d: str, idx: str) -> str:
    whens = " ".join(f"WHEN {i} THEN strftime(CAST({d} AS TIMESTAMP), '{f}')"
                     for i, f in enumerate(DUCK_FORMATS))
    return f"CASE CAST({idx} AS INTEGER) {whens} END"


def _dplus(d: str, n: str) -> str:
    return f"(CAST({d} AS DATE) + CAST({n} AS INTEGER))"


BRONZE_SQL = {
    "orders": f"""SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
      lower(o_orderstatus) AS order_status,
      {fmt_sql('o_orderdate', 'o_orderkey % 8')} AS order_purchase_timestamp,
      {fmt_sql(_dplus('o_orderdate', 'o_orderkey % 3'), '(o_orderkey + 1) % 8')} AS order_approved_at,
      {fmt_sql(_dplus('o_orderdate', 'o_orderkey % 5'), '(o_orderkey + 2) % 8')} AS order_delivered_carrier_date,
      {fmt_sql(_dplus('o_orderdate', 'o_orderkey % 11 + 10'), '(o_orderkey + 3) % 8')} AS order_delivered_customer_date,
      {fmt_sql(_dplus('o_orderdate', str(ESTIMATED_DAYS)), '(o_orderkey + 4) % 8')} AS order_estimated_delivery_date
      FROM orders""",
    "order_items": f"""SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS order_item_id,
      CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
      {fmt_sql('l_shipdate', '(l_orderkey + l_linenumber) % 8')} AS shipping_limit_date,
      CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
      CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS VARCHAR) AS freight_value
      FROM lineitem""",
    "order_reviews": f"""SELECT CAST(o_orderkey AS VARCHAR) AS review_id, CAST(o_orderkey AS VARCHAR) AS order_id,
      CAST(1 + o_orderkey % 5 AS VARCHAR) AS review_score, o_orderpriority AS review_comment_title,
      o_orderstatus AS review_comment_message,
      {fmt_sql(_dplus('o_orderdate', str(REVIEW_DAYS)), 'o_orderkey % 8')} AS review_creation_date,
      {fmt_sql(_dplus('o_orderdate', str(REVIEW_DAYS + 1)), '(o_orderkey + 5) % 8')} AS review_answer_timestamp
      FROM orders""",
    "sellers": """SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
      CAST(s_nationkey * 1000 + s_suppkey % 1000 AS VARCHAR) AS seller_zip_code_prefix,
      lower(s_name) AS seller_city, CAST(s_nationkey AS VARCHAR) AS seller_state FROM supplier""",
    "customers": """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id,
      CAST(c_nationkey * 1000 + c_custkey % 1000 AS VARCHAR) AS customer_zip_code_prefix,
      lower(c_mktsegment) AS customer_city, CAST(c_nationkey AS VARCHAR) AS customer_state FROM customer""",
    "products": """SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS product_category_name,
      CAST(length(p_name) AS VARCHAR) AS product_name_lenght, CAST(length(p_type) AS VARCHAR) AS product_description_lenght,
      CAST(p_size AS VARCHAR) AS product_photos_qty, CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) AS product_weight_g,
      CAST(p_size AS VARCHAR) AS product_length_cm, CAST(length(p_brand) AS VARCHAR) AS product_height_cm,
      CAST(p_partkey % 100 AS VARCHAR) AS product_width_cm FROM part""",
}


def parse_ts_sql(c: str) -> str:
    fl = ", ".join(f"'{f}'" for f in DUCK_FORMATS)
    return f"try_strptime({c}, [{fl}])"


def silver_sql(name: str, keys: Sequence[str] | None = None) -> str:
    from .silver import SPECS, dedup_order
    spec = SPECS[name]
    keys = tuple(keys or spec.keys)
    exprs, kinds = [], {}
    for c in spec.columns:
        if c in spec.timestamps:
            e, kinds[c] = parse_ts_sql(c), "ts"
        elif c in spec.dates:
            e, kinds[c] = f"CAST({parse_ts_sql(c)} AS DATE)", "ts"
        elif c in spec.ints:
            e = f"TRY_CAST(trim({c}) AS INTEGER)"
        elif c in spec.decimals:
            e = f"TRY_CAST(trim({c}) AS DECIMAL(18,2))"
        elif c in spec.upper:
            e = f"upper(trim({c}))"
        else:
            e = c
        exprs.append(f"{e} AS {c}")
    safra = f", {safra_sql(spec.safra_from)} AS safra" if spec.safra_from else ""
    cols_after = list(spec.columns) + (["safra"] if spec.safra_from else [])
    order = dedup_order(spec, cols_after, keys)
    order_sql = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    req = f"WHERE {spec.required} IS NOT NULL" if spec.required else ""
    knn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    hash_cols = list(spec.hash_cols or spec.columns)
    parts = ", ".join(
        f"coalesce(strftime({c}, '%Y-%m-%d'), '')" if kinds.get(c) == "ts"
        else f"coalesce(CAST({c} AS VARCHAR), '')" for c in hash_cols)
    date_fix = ""
    if spec.dates:
        date_fix = " REPLACE (" + ", ".join(f"CAST({c} AS TIMESTAMP) AS {c}" for c in spec.dates) + ")"
    return f"""
WITH bronze AS ({BRONZE_SQL[name]}),
typed AS (SELECT {', '.join(exprs)} FROM bronze WHERE {knn}),
typed2 AS (SELECT *{safra} FROM typed),
f AS (SELECT * FROM typed2 {req}),
d AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order_sql}) AS rn FROM f) WHERE rn = 1)
SELECT *{date_fix}, sha256(concat_ws('||', {parts})) AS row_hash FROM d"""


# ---------------------------------------------------------------- target / ABT
TARGET_FACT = f"""
r_target_fact AS (
  SELECT it.seller_id, it.price, o.safra FROM r_orders o JOIN r_items it ON o.order_id = it.order_id
  WHERE o.order_status = '{DELIVERED_STATUS}' AND it.seller_id IS NOT NULL)"""

CUSTOMER_FACT = """
r_customer_fact AS (SELECT customer_id, safra FROM r_orders)"""


def _midx(c: str) -> str:
    return f"(CAST({c} AS INTEGER) // 100 * 12 + CAST({c} AS INTEGER) % 100)"


def _target_hash(entity: str) -> str:
    return (f"sha256(concat_ws('||', coalesce(CAST({entity} AS VARCHAR), ''), "
            f"coalesce(CAST(safra AS VARCHAR), ''), coalesce(CAST(flag_sem_venda_2m AS VARCHAR), '')))")


def target_ctes(prefix: str, fact_name: str, entity: str, safra: int | None = None,
                safras: Sequence[int] | None = None, horizon: int = 2) -> list[str]:
    p = prefix
    if safra is not None:
        return [
            f"{p}_base AS (SELECT DISTINCT {entity}, safra FROM {fact_name} WHERE safra = {safra})",
            f"""{p}_later AS (SELECT DISTINCT {entity} FROM {fact_name}
                 WHERE {_midx('safra')} > {_midx(str(safra))} AND {_midx('safra')} <= {_midx(str(safra))} + {horizon})""",
            f"""{p}_flag AS (SELECT b.{entity}, CAST(b.safra AS INTEGER) AS safra,
                 CAST(CASE WHEN c.{entity} IS NOT NULL THEN 0 ELSE 1 END AS INTEGER) AS flag_sem_venda_2m
                 FROM {p}_base b LEFT JOIN {p}_later c ON b.{entity} = c.{entity})""",
            f"{p}_final AS (SELECT *, {_target_hash(entity)} AS row_hash FROM {p}_flag)",
        ]
    keep = f"WHERE safra IN ({', '.join(str(s) for s in safras)})" if safras else ""
    return [
        f"{p}_pairs AS (SELECT DISTINCT {entity}, CAST(safra AS INTEGER) AS safra FROM {fact_name})",
        f"""{p}_flag AS (SELECT a.{entity}, a.safra,
             CAST(CASE WHEN EXISTS (SELECT 1 FROM {p}_pairs b WHERE b.{entity} = a.{entity}
                   AND {_midx('b.safra')} - {_midx('a.safra')} BETWEEN 1 AND {horizon}) THEN 0 ELSE 1 END AS INTEGER)
             AS flag_sem_venda_2m FROM {p}_pairs a {keep})""",
        f"{p}_final AS (SELECT *, {_target_hash(entity)} AS row_hash FROM {p}_flag)",
    ]


def target_sql(fact_cte: str, fact_name: str, entity: str, **kw) -> str:
    return with_roles(fact_cte, *target_ctes("tg", fact_name, entity, **kw)) + \
        "\nSELECT * FROM tg_final"


def abt_sql(safras: Sequence[int], lo: int, hi: int) -> str:
    bo = book_ctes("bo", "r_order_fact", "seller_id", safras, ORDER_VALUES, "_orders",
                   ("seller_region",), where=f"order_status = '{DELIVERED_STATUS}'")
    br = book_ctes("br", "r_review_fact", "seller_id", safras, ("review_score",), "_reviews")
    tg = target_ctes("tg", "r_target_fact", "seller_id", safras=safras)
    return with_roles(ORDER_FACT, REVIEW_FACT, TARGET_FACT, *bo, *br, *tg) + f"""
SELECT t.* EXCLUDE (row_hash), o.* EXCLUDE (seller_id, safra), r.* EXCLUDE (seller_id, safra)
FROM tg_final t
LEFT JOIN bo_final o ON t.seller_id = o.seller_id AND t.safra = o.safra
LEFT JOIN br_final r ON t.seller_id = r.seller_id AND t.safra = r.safra
WHERE t.safra BETWEEN {lo} AND {hi}"""


# ---------------------------------------------------------------- toolbox frames
LABELLED = f"""
r_lab AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus, l_returnflag,
         CAST(l_returnflag = 'R' AS INTEGER) AS target, {safra_sql('l_shipdate')} AS safra,
         l_quantity / 50 AS score
  FROM lineitem)"""


def rnd(expr: str, digits: int = 10) -> str:
    return r2(expr, digits)


def fit_bins_sql(src: str, bins: int, method: str = "qcut") -> str:
    """SELECT variable, edges FROM ``src`` (variable, value): pandas qcut edges
    with the equal-width fallback, or cut edges."""
    from ..operators.binning import linspace_probs
    probs = ", ".join(f"{p!r}::DOUBLE" for p in linspace_probs(bins))
    wid = "CASE WHEN mn = 0 THEN 0.001 ELSE abs(mn) * 0.001 END"
    raw = (f"list_transform(range(0, {bins} + 1), lambda i: CASE WHEN i = {bins} THEN hi "
           f"ELSE CAST(i AS DOUBLE) * ((hi - lo) / {bins}) + lo END)")
    cut = (f"list_transform({raw}, lambda e, i: CASE WHEN i = 1 AND mn <> mx "
           f"THEN e - (mx - mn) * 0.001 ELSE e END)")
    edges = cut if method == "cut" else f"CASE WHEN len(qe) >= 2 THEN qe ELSE {cut} END"
    return f"""SELECT variable, {edges} AS edges FROM (
  SELECT *, CASE WHEN mn = mx THEN mn - {wid} ELSE mn END AS lo,
            CASE WHEN mn = mx THEN mx + {wid} ELSE mx END AS hi FROM (
    SELECT variable, min(value) AS mn, max(value) AS mx,
           list_sort(list_distinct(quantile_cont(value, [{probs}]))) AS qe
    FROM {src} WHERE value IS NOT NULL GROUP BY variable))"""


def bin_sql(value: str = "value", edges: str = "edges") -> str:
    return (f"least(greatest(len(list_filter({edges}, lambda e: e < {value})) - 1, 0), "
            f"len({edges}) - 2)")


def unpivot_sql(src: str, cols: Sequence[str], keep: Sequence[str] = (), cast: str = "DOUBLE") -> str:
    parts = [f"SELECT {', '.join([*keep, repr(c).replace(chr(34), chr(39)) + ' AS variable', f'CAST({c} AS {cast}) AS value'])} FROM {src}"
             for c in cols]
    return " UNION ALL ".join(parts)


DOCS = """
r_docs AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
           FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

ITEMS_PARTS = """
r_ip AS (SELECT r.*, p.p_brand, p.p_type, p.p_size FROM r_lab r LEFT JOIN part p ON r.l_partkey = p.p_partkey)"""
