"""The queries as plain SQL over the given tables, for comparison in another engine.

``VIEWS`` repeats in SQL what ``sources/bridge.py`` derives in Spark. The queries are written in
the plain declarative form (joins, EXISTS, scalar subqueries) and not in the rearranged form of
``plans``, so that agreement says something.
"""

from __future__ import annotations

VIEWS = {
    "d_region": "SELECT CAST(r_regionkey AS BIGINT) AS r_regionkey, r_name FROM region",
    "d_nation": "SELECT CAST(97 + n_nationkey AS BIGINT) AS n_nationkey, n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation",
    "d_supplier": """
        SELECT s_suppkey AS su_suppkey, s_name AS su_name, CAST(97 + s_nationkey AS BIGINT) AS su_nationkey,
          'S1-' || s_suppkey || ', ' || 'S2-' || (s_suppkey % 10) || ', ' || 'CITY' || (s_suppkey % 50) || ', '
            || chr(CAST(97 + s_nationkey AS INT)) || chr(CAST(97 + s_suppkey % 26 AS INT)) || ', '
            || lpad(CAST(s_suppkey % 10000 AS VARCHAR), 4, '0') || '11111' AS su_address,
          (1 + s_suppkey % 9) || '-000' AS su_phone, s_acctbal AS su_acctbal,
          CASE WHEN s_suppkey % 7 = 3 THEN 'x Customer y Complaints' ELSE 'z' END AS su_comment
        FROM supplier""",
    "d_item": """
        SELECT p_partkey AS i_id, p_name AS i_name, round(p_retailprice - 899.0, 2) AS i_price,
          CASE WHEN p_partkey % 10 = 0 THEN 'ORIGINAL ' ELSE '' END || lower(p_type) || ' ' || p_name || ' '
            || chr(CAST(97 + (p_partkey // 26) % 26 AS INT)) || chr(CAST(97 + p_partkey % 26 AS INT)) AS i_data,
          1 + p_partkey % 10000 AS i_im_id
        FROM part""",
    "d_customer": """
        SELECT 1 + c_custkey // 40 AS c_id, 1 + (c_custkey // 4) % 10 AS c_d_id, 1 + c_custkey % 4 AS c_w_id,
          c_custkey, (c_custkey % 50) / 100.0 AS c_discount,
          CASE WHEN c_custkey % 10 = 0 THEN 'BC' ELSE 'GC' END AS c_credit,
          'F' || lpad(CAST((c_custkey * 7919) % 100003 AS VARCHAR), 6, '0') AS c_first,
          'LAST' || ((1 + c_custkey // 40) % 7) AS c_last,
          c_acctbal AS c_balance, 'CITY' || (c_custkey % 50) AS c_city,
          chr(CAST(97 + c_nationkey AS INT)) || chr(CAST(97 + c_custkey % 26 AS INT)) AS c_state,
          (1 + c_custkey % 9) || '-555' AS c_phone_number,
          'note ' || repeat(chr(CAST(97 + c_custkey % 26 AS INT)), 490) AS c_data,
          CAST('1995-01-01 00:00:00' AS TIMESTAMP) + to_days(CAST(c_custkey % 1000 AS INT)) AS c_since
        FROM customer""",
    "d_stock": """
        SELECT p_partkey AS s_i_id, w AS s_w_id, 10 + (p_partkey * 7 + w * 13) % 91 AS s_quantity,
          10 + (p_partkey * 11 + w * 17) % 2991 AS s_order_cnt, (10 + (p_partkey * 11 + w * 17) % 2991) // 10 AS s_remote_cnt,
          CASE WHEN (p_partkey + w) % 10 = 0 THEN 'ORIGINAL stock' ELSE 'stock' END AS s_data,
          (w * p_partkey) % (SELECT count(*) FROM supplier) AS s_suppkey
        FROM part CROSS JOIN (VALUES (CAST(1 AS BIGINT)), (2), (3), (4)) AS t(w)""",
    "d_header": """
        SELECT o_orderkey AS o_id, 1 + o_custkey // 40 AS o_c_id, 1 + (o_custkey // 4) % 10 AS o_d_id,
          1 + o_custkey % 4 AS o_w_id, CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 + o_orderkey % 10 END AS o_carrier_id,
          (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS o_ol_cnt, o_orderdate AS o_entry_d
        FROM orders""",
    "d_ol": """
        SELECT o_id, o_d_id, o_w_id, o_c_id, o_carrier_id, o_ol_cnt, o_entry_d,
          CAST(l_linenumber - 1 AS BIGINT) AS ol_number, l_partkey AS ol_i_id,
          CASE WHEN l_linenumber % 5 = 0 THEN 1 + o_w_id % 4 ELSE o_w_id END AS ol_supply_w_id,
          CASE WHEN o_carrier_id > 0
            THEN o_entry_d + to_days(CAST(2 + (l_partkey * 7 + l_suppkey * 3 + l_linenumber * 13) % 150 AS INT)) END AS ol_delivery_d,
          CAST(l_quantity AS BIGINT) AS ol_quantity, l_extendedprice AS ol_amount
        FROM d_header JOIN lineitem ON l_orderkey = o_id""",
    "d_neworder": """
        SELECT o_id AS no_o_id, o_d_id AS no_d_id, o_w_id AS no_w_id FROM d_header WHERE o_carrier_id = 0""",
    "d_district": """
        SELECT c_w_id AS d_w_id, c_d_id AS d_id, 10.0 * count(*) AS d_ytd, (c_d_id + c_w_id) / 200.0 AS d_tax,
          1 + coalesce((SELECT max(o_id) FROM d_header WHERE o_w_id = c_w_id AND o_d_id = c_d_id), 0) AS d_next_o_id
        FROM d_customer GROUP BY c_w_id, c_d_id""",
    "d_warehouse": """
        SELECT c_w_id AS w_id, 10.0 * count(*) AS w_ytd, c_w_id / 100.0 AS w_tax FROM d_customer GROUP BY c_w_id""",
}
_NEEDS = {"d_ol": ["d_header"], "d_neworder": ["d_header"], "d_district": ["d_customer", "d_header"], "d_warehouse": ["d_customer"]}


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """Put the views a query mentions in front of it as common table expressions."""
    extra = extra or {}
    text = sql + " ".join(extra.values())
    wanted = {v for v in VIEWS if v in text}
    for view in list(wanted):
        wanted.update(_NEEDS.get(view, []))
    parts = [f"{v} AS ({VIEWS[v].strip()})" for v in VIEWS if v in wanted]
    parts += [f"{name} AS ({body.strip()})" for name, body in extra.items()]
    return "WITH " + ",\n".join(parts) + "\n" + sql.strip()


def _sum(x: str) -> str:
    return f"sum(CAST({x} AS DECIMAL(18,2)))"


def _dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def _time(x: str) -> str:
    return f"CAST('{x}' AS TIMESTAMP)"


def _months(x: str, n: int) -> str:
    return f"({_time(x)} + INTERVAL {n} MONTH)"


def q01(since):
    return f"""
    SELECT ol_number, CAST(sum(ol_quantity) AS BIGINT) AS sum_qty, {_dbl(_sum('ol_amount'))} AS sum_amount,
      {_dbl('sum(ol_quantity)')} / count(*) AS avg_qty, {_dbl(_sum('ol_amount'))} / count(*) AS avg_amount,
      count(*) AS count_order
    FROM d_ol WHERE ol_delivery_d > {_time(since)} GROUP BY ol_number ORDER BY ol_number"""


def q02(region, suffix, k=100):
    return f"""
    SELECT su_suppkey, su_name, n_name, i_id, i_name, su_address, su_phone, su_comment
    FROM (
      SELECT s_i_id, su_suppkey, su_name, n_name, su_address, su_phone, su_comment, rank() OVER (PARTITION BY s_i_id ORDER BY s_quantity) AS place
      FROM d_region JOIN d_nation ON n_regionkey = r_regionkey JOIN d_supplier ON su_nationkey = n_nationkey JOIN d_stock ON s_suppkey = su_suppkey
      WHERE r_name LIKE '{region}') AS offer
    JOIN d_item ON i_id = s_i_id AND i_data LIKE '%{suffix}' WHERE place = 1
    ORDER BY n_name, su_name, i_id, su_suppkey LIMIT {k}"""


def q03(state, before, limit=None):
    tail = "" if limit is None else f"LIMIT {limit}"
    return f"""
    SELECT o_id, o_w_id, o_d_id, {_dbl(_sum('ol_amount'))} AS revenue, o_entry_d
    FROM d_customer, d_ol, d_neworder
    WHERE c_state LIKE '{state}%' AND c_id = o_c_id AND c_w_id = o_w_id AND c_d_id = o_d_id
      AND o_entry_d < {_time(before)} AND no_w_id = o_w_id AND no_d_id = o_d_id AND no_o_id = o_id
    GROUP BY o_id, o_w_id, o_d_id, o_entry_d
    ORDER BY revenue DESC, o_entry_d, o_w_id, o_d_id, o_id {tail}"""


def q04(start, months=3, weeks=1):
    return f"""
    SELECT o_ol_cnt, count(*) AS order_count FROM d_header h
    WHERE o_entry_d >= {_time(start)} AND o_entry_d < {_months(start, months)}
      AND EXISTS (SELECT 1 FROM d_ol l WHERE l.o_id = h.o_id AND l.ol_delivery_d >= h.o_entry_d + INTERVAL {7 * weeks} DAY)
    GROUP BY o_ol_cnt ORDER BY o_ol_cnt"""


def q05(region, year):
    return f"""
    SELECT n_name, {_dbl(_sum('ol_amount'))} AS revenue
    FROM d_customer, d_ol, d_stock, d_supplier, d_nation, d_region
    WHERE c_id = o_c_id AND c_w_id = o_w_id AND c_d_id = o_d_id AND o_w_id = s_w_id AND ol_i_id = s_i_id
      AND s_suppkey = su_suppkey AND su_nationkey = n_nationkey AND ascii(c_state) = n_nationkey
      AND n_regionkey = r_regionkey AND r_name LIKE '{region}' AND o_entry_d >= {_time(f'{year}-01-01')}
      AND o_entry_d < {_time(f'{year + 1}-01-01')}
    GROUP BY n_name ORDER BY revenue DESC, n_name"""


def q06(year, min_amount):
    return f"""
    SELECT {_dbl(_sum('ol_amount'))} AS revenue FROM d_ol
    WHERE ol_delivery_d >= {_time(f'{year}-01-01')} AND ol_delivery_d < {_time(f'{year + 1}-01-01')}
      AND ol_amount > {min_amount}"""


def q07(nation_a, nation_b, first, last):
    return f"""
    SELECT su_nationkey AS supp_nation, substr(c_state, 1, 1) AS cust_nation, CAST(year(o_entry_d) AS INT) AS l_year,
      {_dbl(_sum('ol_amount'))} AS revenue
    FROM d_supplier, d_stock, d_ol, d_customer, d_nation n1, d_nation n2
    WHERE ol_supply_w_id = s_w_id AND ol_i_id = s_i_id AND s_suppkey = su_suppkey
      AND c_id = o_c_id AND c_w_id = o_w_id AND c_d_id = o_d_id AND su_nationkey = n1.n_nationkey
      AND ascii(c_state) = n2.n_nationkey
      AND ((n1.n_name = '{nation_a}' AND n2.n_name = '{nation_b}') OR (n1.n_name = '{nation_b}' AND n2.n_name = '{nation_a}'))
      AND ol_delivery_d BETWEEN {_time(first)} AND {_time(last)}
    GROUP BY su_nationkey, substr(c_state, 1, 1), year(o_entry_d) ORDER BY 1, 2, 3"""


def q08(region, nation, suffix, first, last, item_below=1000):
    own = f"CASE WHEN n2.n_name = '{nation}' THEN ol_amount ELSE 0 END"
    return f"""
    SELECT CAST(year(o_entry_d) AS INT) AS l_year,
      round({_dbl(_sum(own))} / nullif({_dbl(_sum('ol_amount'))}, 0), 2) AS mkt_share
    FROM d_item, d_supplier, d_stock, d_ol, d_customer, d_nation n1, d_nation n2, d_region
    WHERE i_id = s_i_id AND ol_i_id = s_i_id AND ol_supply_w_id = s_w_id AND s_suppkey = su_suppkey
      AND c_id = o_c_id AND c_w_id = o_w_id AND c_d_id = o_d_id AND n1.n_nationkey = ascii(c_state)
      AND n1.n_regionkey = r_regionkey AND ol_i_id < {item_below} AND r_name LIKE '{region}'
      AND su_nationkey = n2.n_nationkey AND o_entry_d BETWEEN {_time(first)} AND {_time(last)} AND i_data LIKE '%{suffix}'
    GROUP BY year(o_entry_d) ORDER BY l_year"""


def q09(suffix):
    return f"""
    SELECT n_name, CAST(year(o_entry_d) AS INT) AS l_year, {_dbl(_sum('ol_amount'))} AS sum_profit
    FROM d_item, d_stock, d_supplier, d_ol, d_nation
    WHERE ol_i_id = s_i_id AND ol_supply_w_id = s_w_id AND s_suppkey = su_suppkey AND ol_i_id = i_id
      AND su_nationkey = n_nationkey AND i_data LIKE '%{suffix}'
    GROUP BY n_name, year(o_entry_d) ORDER BY n_name, l_year DESC"""


def q10(start, months=3, k=20):
    return f"""
    SELECT c_id, c_last, {_dbl(_sum('ol_amount'))} AS revenue, c_city, c_phone_number, n_name
    FROM d_customer, d_ol, d_nation
    WHERE c_id = o_c_id AND c_w_id = o_w_id AND c_d_id = o_d_id AND o_entry_d >= {_time(start)}
      AND o_entry_d < {_months(start, months)} AND n_nationkey = ascii(c_state)
    GROUP BY c_id, c_last, c_city, c_phone_number, n_name
    ORDER BY revenue DESC, c_id, c_last, c_city, c_phone_number, n_name LIMIT {k}"""


def q11(nation, fraction=0.00005):
    source = f"""d_stock, d_supplier, d_nation WHERE s_suppkey = su_suppkey AND su_nationkey = n_nationkey AND n_name = '{nation}'"""
    return f"""
    SELECT s_i_id, CAST(sum(s_order_cnt) AS BIGINT) AS ordercount FROM {source}
    GROUP BY s_i_id
    HAVING {_dbl('sum(s_order_cnt)')} > (SELECT {_dbl('sum(s_order_cnt)')} * CAST('{fraction}' AS DOUBLE) FROM {source})
    ORDER BY ordercount DESC, s_i_id"""


def q12(year, carriers=(1, 2)):
    a, b = carriers
    return f"""
    SELECT o_ol_cnt, CAST(sum(CASE WHEN o_carrier_id = {a} OR o_carrier_id = {b} THEN 1 ELSE 0 END) AS BIGINT) AS high_line_count,
      CAST(sum(CASE WHEN o_carrier_id <> {a} AND o_carrier_id <> {b} THEN 1 ELSE 0 END) AS BIGINT) AS low_line_count
    FROM d_ol WHERE o_entry_d <= ol_delivery_d AND ol_delivery_d >= {_time(f'{year}-01-01')}
      AND ol_delivery_d < {_time(f'{year + 1}-01-01')}
    GROUP BY o_ol_cnt ORDER BY o_ol_cnt"""


def q13(carrier_above):
    return f"""
    SELECT c_count, count(*) AS custdist FROM
      (SELECT c_id, count(o_id) AS c_count FROM d_customer
       LEFT JOIN d_header ON c_w_id = o_w_id AND c_d_id = o_d_id AND c_id = o_c_id AND o_carrier_id > {carrier_above}
       GROUP BY c_id) t
    GROUP BY c_count ORDER BY custdist DESC, c_count DESC"""


def q14(start, months=1, prefix="pr"):
    promo = f"CASE WHEN i_data LIKE '{prefix}%' THEN ol_amount ELSE 0 END"
    return f"""
    SELECT CAST(100 AS DOUBLE) * {_dbl(_sum(promo))} / (CAST(1 AS DOUBLE) + {_dbl(_sum('ol_amount'))}) AS promo_revenue
    FROM d_item, d_ol WHERE ol_i_id = i_id AND ol_delivery_d >= {_time(start)} AND ol_delivery_d < {_months(start, months)}"""


def q15(start, months=3):
    return f"""
    , revenue AS (
      SELECT s_suppkey AS supplier_no, {_sum('ol_amount')} AS total_revenue FROM d_stock, d_ol
      WHERE ol_i_id = s_i_id AND ol_supply_w_id = s_w_id AND ol_delivery_d >= {_time(start)}
        AND ol_delivery_d < {_months(start, months)} GROUP BY s_suppkey)
    SELECT su_suppkey, su_name, su_address, su_phone, {_dbl('total_revenue')} AS total_revenue
    FROM revenue, d_supplier
    WHERE su_suppkey = supplier_no AND total_revenue = (SELECT max(total_revenue) FROM revenue) ORDER BY su_suppkey"""


def q16(not_prefix, comment="%Customer%Complaints%"):
    return f"""
    SELECT i_name, substr(i_data, 1, 3) AS brand, i_price, count(DISTINCT s_suppkey) AS supplier_cnt
    FROM d_stock, d_item
    WHERE i_id = s_i_id AND i_data NOT LIKE '{not_prefix}%'
      AND s_suppkey NOT IN (SELECT su_suppkey FROM d_supplier WHERE su_comment LIKE '{comment}')
    GROUP BY i_name, substr(i_data, 1, 3), i_price ORDER BY supplier_cnt DESC, 1, 2, 3"""


def q17(suffix):
    return f"""
    SELECT {_dbl(_sum('ol_amount'))} / 2.0 AS avg_yearly FROM d_ol,
      (SELECT i_id, avg(ol_quantity) AS a FROM d_item, d_ol WHERE i_data LIKE '%{suffix}' AND ol_i_id = i_id GROUP BY i_id) t
    WHERE ol_i_id = t.i_id AND ol_quantity < t.a"""


def q18(total_above, k=100):
    return f"""
    SELECT c_last, c_id, o_id, o_entry_d, o_ol_cnt, {_dbl(_sum('ol_amount'))} AS ol_sum
    FROM d_customer, d_ol WHERE c_id = o_c_id AND c_w_id = o_w_id AND c_d_id = o_d_id
    GROUP BY o_id, o_w_id, o_d_id, c_id, c_last, o_entry_d, o_ol_cnt
    HAVING {_sum('ol_amount')} > {total_above} ORDER BY ol_sum DESC, o_entry_d, o_w_id, o_d_id, o_id LIMIT {k}"""


def q19(branches):
    ors = " OR ".join(
        f"(i_data LIKE '%{s}' AND ol_quantity BETWEEN {lo} AND {hi} AND i_price BETWEEN 1 AND {price}"
        f" AND o_w_id IN ({', '.join(map(str, ws))}))"
        for s, lo, hi, price, ws in branches
    )
    return f"SELECT {_dbl(_sum('ol_amount'))} AS revenue FROM d_ol, d_item WHERE ol_i_id = i_id AND ({ors})"


def q20(prefix, nation, start, months=12):
    return f"""
    SELECT su_name, su_address FROM d_supplier, d_nation
    WHERE su_suppkey IN (
        SELECT s_suppkey FROM d_stock, d_ol
        WHERE s_i_id IN (SELECT i_id FROM d_item WHERE i_data LIKE '{prefix}%') AND ol_i_id = s_i_id
          AND ol_delivery_d >= {_time(start)} AND ol_delivery_d < {_months(start, months)}
        GROUP BY s_i_id, s_w_id, s_quantity, s_suppkey HAVING 20 * s_quantity > sum(ol_quantity))
      AND su_nationkey = n_nationkey AND n_name = '{nation}' ORDER BY su_name, su_suppkey"""


def _late(nation, first, last, days):
    """Lines delivered late by suppliers of a nation, with their order and stock row."""
    return f"""SELECT line.o_w_id, line.o_d_id, line.o_id, line.ol_i_id, line.ol_delivery_d, su_suppkey, su_name
      FROM d_ol line JOIN d_stock ON s_i_id = line.ol_i_id AND s_w_id = line.o_w_id
        JOIN d_supplier ON su_suppkey = s_suppkey JOIN d_nation ON n_nationkey = su_nationkey AND n_name = '{nation}'
      WHERE line.o_entry_d BETWEEN {_time(first)} AND {_time(last)} AND line.ol_delivery_d - INTERVAL {days} DAY > line.o_entry_d"""


def _nothing_later(than):
    return f"""NOT EXISTS (FROM d_ol other WHERE (other.o_w_id, other.o_d_id, other.o_id) = (late.o_w_id, late.o_d_id, late.o_id)
        AND other.ol_delivery_d > {than})"""


def q21(nation, first, last, days, k=100):
    """A stock row's late lines of an order count once, if nothing in the order came after the first of them."""
    return f"""
    SELECT su_name, count(*) AS numwait FROM (
      SELECT o_w_id, o_d_id, o_id, ol_i_id, su_suppkey, su_name, min(ol_delivery_d) AS earliest
      FROM ({_late(nation, first, last, days)}) GROUP BY ALL) AS late
    WHERE {_nothing_later("late.earliest")}
    GROUP BY su_name ORDER BY numwait DESC, su_name LIMIT {k}"""


def q21_lines(nation, first, last, days, k=100):
    return f"""
    SELECT su_name, count(*) AS numwait FROM ({_late(nation, first, last, days)}) late
    WHERE {_nothing_later("late.ol_delivery_d")} GROUP BY su_name ORDER BY numwait DESC, su_name LIMIT {k}"""


def q22(digits, idle=None, average_digits=None):
    def of(wanted):
        return "substr(c_phone_number, 1, 1) IN (" + ", ".join(f"'{d}'" for d in wanted) + ")"

    chosen, averaged = of(digits), of(average_digits or digits)
    when = "" if idle is None else f"AND o_entry_d BETWEEN {_time(idle[0])} AND {_time(idle[1])}"
    return f"""
    SELECT substr(c_state, 1, 1) AS country, count(*) AS numcust, {_dbl(_sum('c_balance'))} AS totacctbal
    FROM d_customer
    WHERE {chosen} AND c_balance > (SELECT {_dbl(_sum('c_balance'))} / count(*) FROM d_customer WHERE c_balance > 0.00 AND {averaged})
      AND NOT EXISTS (SELECT 1 FROM d_header WHERE o_c_id = c_id AND o_w_id = c_w_id AND o_d_id = c_d_id {when})
    GROUP BY substr(c_state, 1, 1) ORDER BY 1"""


def analytic_sql(name: str, params: dict) -> str:
    sql = with_views(globals()[name](**params))
    return sql.replace("\n, revenue AS", ",\nrevenue AS")
