"""The retail entities in SQL, as common table expressions that queries pick from."""

from __future__ import annotations

_TYPE = "(list_position(['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD'], p_type) - 1)::INT"
_ART = f"(split_part(p_brand, '#', 2)::INT * 10 + {_TYPE})::INT"
_NET = "l_extendedprice * (1 - l_discount)"



def _bin(disc: str) -> str:
    def edge(steps: int, width: int) -> str:
        return f"CAST(floor(round({disc} * {steps}, 5)) AS BIGINT) * {width}"

    return (
        f"CASE WHEN abs(round({disc}, 5)) > 0.8 THEN {edge(10, 100)} "
        f"WHEN abs(round({disc}, 5)) > 0.5 THEN {edge(20, 50)} ELSE {edge(40, 25)} END"
    )


DISCOUNT_BIN = _bin
PRICE_DISCOUNT = (
    "CAST(CAST(CAST(scnd_price AS DECIMAL(18,6)) AS DOUBLE)"
    " / CAST(CAST(frst_price AS DECIMAL(18,6)) AS DOUBLE) - 1 AS DECIMAL(18,6))"
)


def _side(p: str, x: str) -> str:
    return f"""{x}price AS {p}_price, {x}l_quantity AS {p}_sale_qnty, 1 AS {p}_day_cnt_rest_sales,
  {x}l_orderkey % 5 + 1 AS {p}_client_cnt, {x}l_orderkey % 3 + 1 AS {p}_txn_cnt,
  {x}day_id AS {p}_begin_dt, {x}day_id + 13 AS {p}_end_dt"""

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "warehouses": ((), """
SELECT s_suppkey AS whs_id, n_regionkey AS gs_fo_id, s_nationkey % 3 AS frmt_id, s_nationkey AS branch_id
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""),
    "clusters": ((), """
SELECT s_suppkey AS whs_id, CAST(s_suppkey % 3 + 1 AS INT) AS cluster_id FROM supplier WHERE s_nationkey % 4 <> 0"""),
    "articles": ((), f"""
SELECT DISTINCT {_ART} AS art_id, {_TYPE} + 1 AS direction, 1 AS art_grp_lvl_0_id,
  1000 + CAST({_TYPE} // 4 AS INT) AS art_grp_lvl_1_id, 2000 + CAST({_TYPE} // 2 AS INT) AS art_grp_lvl_2_id,
  3000 + {_TYPE} AS art_grp_lvl_3_id, p_brand AS art_grp_2_lvl_1_name FROM part"""),
    "group_levels": (("articles",), """
SELECT DISTINCT art_grp_lvl_0_id AS grp_art_id, 0 AS lvl FROM articles
UNION ALL SELECT DISTINCT art_grp_lvl_1_id, 1 FROM articles
UNION ALL SELECT DISTINCT art_grp_lvl_2_id, 2 FROM articles
UNION ALL SELECT DISTINCT art_grp_lvl_3_id, 3 FROM articles"""),
    "observations": ((), f"""
SELECT l_suppkey AS whs_id, {_ART} AS art_id, CAST(l_shipdate AS DATE) AS day_id,
  floor({_NET} / l_quantity * 10000.0::DOUBLE + 0.5::DOUBLE) / 10000.0::DOUBLE AS price,
  l_partkey, l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
  p_name FROM lineitem JOIN part ON l_partkey = p_partkey"""),
    "pairs": (("observations",), f"""
SELECT whs_id, art_id, 1 AS algorithm_type,
  CASE l_returnflag WHEN 'A' THEN 21001 WHEN 'N' THEN 21007 WHEN 'R' THEN 21004 END AS scnd_reason_type_id,
  CAST(NULL AS INT) AS scnd_holiday_id, l_tax AS ssn_coef_sale_txn,
  {_side('frst', 'prev.')}, {_side('scnd', '')}
FROM (SELECT *, lag({{'price': price, 'l_quantity': l_quantity, 'l_orderkey': l_orderkey, 'day_id': day_id}}) OVER (
  PARTITION BY whs_id, art_id ORDER BY day_id, l_orderkey, l_linenumber, l_extendedprice) AS prev FROM observations)
WHERE prev IS NOT NULL"""),
    "valid_pairs": (("pairs",), """
SELECT * FROM pairs WHERE scnd_sale_qnty > 0 AND scnd_client_cnt > 0 AND scnd_txn_cnt > 0 AND scnd_price > 0
  AND frst_sale_qnty > 0 AND frst_client_cnt > 0 AND frst_txn_cnt > 0 AND frst_price > 0
  AND scnd_day_cnt_rest_sales > 0 AND scnd_price / frst_price - 1 <= 0"""),
    "growth": (("valid_pairs", "articles", "warehouses"), f"""
SELECT * FROM (SELECT p.whs_id, p.art_id, art_grp_lvl_3_id AS grp_art_id, replace(lower(art_grp_2_lvl_1_name), 'c', 'с') AS brand,
  gs_fo_id, frmt_id, algorithm_type,
  CASE WHEN scnd_reason_type_id IN (21001, 24062) THEN 1 WHEN scnd_reason_type_id = 21007 THEN 2
    WHEN scnd_reason_type_id = 21004 THEN 3 ELSE 4 END AS aum_type_id,
  coalesce(scnd_holiday_id, 0) AS scnd_holiday_id, CASE WHEN direction IN (3, 4) THEN 34 ELSE 12 END AS direction_type,
  CAST({PRICE_DISCOUNT} AS DOUBLE) AS disc, {_bin(f'CAST({PRICE_DISCOUNT} AS DOUBLE)')} AS skidgr,
  scnd_sale_qnty / frst_sale_qnty * (CAST(frst_day_cnt_rest_sales AS DOUBLE) / scnd_day_cnt_rest_sales) - 1 AS prir_sale,
  scnd_sale_qnty / frst_sale_qnty * (CAST(frst_client_cnt AS DOUBLE) / scnd_client_cnt) - 1 AS prir_client,
  scnd_sale_qnty / frst_sale_qnty * (CAST(frst_txn_cnt AS DOUBLE) / scnd_txn_cnt) - 1 AS prir_txn,
  scnd_sale_qnty / (frst_sale_qnty * nullif(ssn_coef_sale_txn, 0)) - 1 AS prir_ssn,
  frst_begin_dt, frst_end_dt, scnd_begin_dt, scnd_end_dt
FROM valid_pairs p JOIN articles USING (art_id) JOIN warehouses w ON p.whs_id = w.whs_id) WHERE prir_sale >= 0"""),
    "promo_calendar": (("observations",), """
SELECT whs_id, art_id, 1 AS market_company_id, day_id AS beg_dt, day_id + 27 AS end_dt FROM observations
WHERE l_returnflag = 'R' AND l_discount >= 0.08"""),
    "campaigns": (("observations",), """
SELECT l_orderkey AS mc_id, l_partkey AS action_id, art_id, l_linestatus AS status_id, day_id AS begin_dt,
  day_id + 20 AS end_dt, o_orderdate AS load_dtm, l_linenumber, l_extendedprice
FROM observations JOIN orders ON l_orderkey = o_orderkey WHERE l_discount = 0.1"""),
    "days": ((), """
SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day_id
FROM (SELECT min(CAST(l_shipdate AS DATE)) AS lo, max(CAST(l_shipdate AS DATE)) AS hi FROM lineitem)"""),
    "daily": (("observations",), f"""
SELECT whs_id, art_id, day_id, sum(l_quantity) AS sales_qnty, CAST(count(*) AS DOUBLE) AS rest_qnty,
  sum({_NET}) AS sale, sum(CASE WHEN l_tax > 0.04 THEN l_extendedprice * l_tax END) AS disc_loyal,
  sum(CASE WHEN l_discount >= 0.08 THEN l_quantity END) AS disc_ma_qnty,
  max(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END) AS action_type_id, sum(l_extendedprice) AS gross
FROM observations GROUP BY ALL"""),
    "reasons": ((), """
SELECT DISTINCT CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS action_type_id,
  CASE l_returnflag WHEN 'A' THEN 21001 WHEN 'N' THEN 24185 ELSE 21004 END AS reason_type_id FROM lineitem"""),
    "factor_groups": (("warehouses", "clusters"), f"""
SELECT DISTINCT frmt_id, branch_id, coalesce(cluster_id, 1) AS cluster_id, art_grp_lvl_3_id
FROM (SELECT DISTINCT l_suppkey AS whs_id, 3000 + {_TYPE} AS art_grp_lvl_3_id
  FROM lineitem JOIN part ON l_partkey = p_partkey)
JOIN warehouses USING (whs_id) LEFT JOIN clusters USING (whs_id)"""),
    "seasons": (("factor_groups",), """
SELECT frmt_id, branch_id, cluster_id, art_grp_lvl_3_id, CAST(m * 100 + d AS INT) AS yearday_id,
  koef + (branch_id % 5) * -0.2::DOUBLE AS koef_yearly
FROM factor_groups, (SELECT month(o_orderdate) AS m, ln(avg(o_totalprice) / (SELECT avg(o_totalprice) FROM orders)) AS koef
  FROM orders GROUP BY 1), range(1, 32) r(d)"""),
    "holidays": (("factor_groups",), """
SELECT g.*, CAST(day_id AS DATE) AS day_id, koeff_holiday FROM factor_groups g,
  (SELECT unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS day_id
   FROM (SELECT date_trunc('month', min(l_shipdate)) AS lo, CAST(max(l_shipdate) AS DATE) AS hi FROM lineitem)) f,
  (VALUES (0.25::DOUBLE, false), (-0.1::DOUBLE, true)) v(koeff_holiday, january)
WHERE NOT january OR month(day_id) = 1"""),
}


def with_entities(names: str, body: str) -> str:
    """``body`` with the named entities, and those they need, in front of it."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for needed in CTES[name][0]:
                add(needed)
            ordered.append(name)

    for name in names.split():
        add(name)
    parts = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n][1]})" for n in ordered)
    body = body.strip()
    return f"WITH {parts},\n{body[5:]}" if body.startswith("WITH ") else f"WITH {parts}\n{body}"
