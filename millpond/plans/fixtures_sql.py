"""The retail tables as SQL text, for the second engine. Same rows as sources.retail."""

from __future__ import annotations

FIXTURES = {
    "fx_train": """
        SELECT CAST(EXTRACT(YEAR FROM date) * 10000 + EXTRACT(MONTH FROM date) * 100 + EXTRACT(DAY FROM date) AS
        BIGINT) * 100000 + store_nbr * 10 + CASE family WHEN 'STANDARD' THEN 0 WHEN 'SMALL' THEN 1 WHEN 'MEDIUM' THEN
        2 WHEN 'LARGE' THEN 3 WHEN 'ECONOMY' THEN 4 ELSE 5 END AS id, date, store_nbr, family, sales, onpromotion FROM
        ( SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey AS INT) AS store_nbr, p_type AS family,
        CAST(SUM(CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) AS sales, MAX(CASE WHEN l_discount > 0.05 THEN 1
        ELSE 0 END) AS onpromotion FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3 ) t
    """,
    "fx_stores": """
        SELECT CAST(s_suppkey AS INT) AS store_nbr, n_name AS city, r_name AS state, SUBSTRING('ABCDE', CAST(s_suppkey
        % 5 AS INT) + 1, 1) AS type, CAST(s_suppkey % 17 + 1 AS INT) AS cluster FROM supplier JOIN nation ON
        s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
    "fx_oil": """
        SELECT CAST(o_orderdate AS DATE) AS date, CASE WHEN EXTRACT(DAY FROM CAST(o_orderdate AS DATE)) % 10 = 0 THEN
        NULL ELSE CAST(CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) / COUNT(*) / 5000 AS DECIMAL(14,2)) AS DOUBLE)
        END AS dcoilwtico FROM orders GROUP BY CAST(o_orderdate AS DATE)
    """,
    "fx_transactions": """
        SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey AS INT) AS store_nbr, CAST(COUNT(DISTINCT l_orderkey)
        AS INT) AS transactions FROM lineitem GROUP BY 1, 2
    """,
    "fx_holidays_events": """
        SELECT DATE '1995-01-01' + CAST((c_custkey * 7) % 1200 AS INT) AS date, CASE c_mktsegment WHEN 'HOUSEHOLD'
        THEN 'Holiday' WHEN 'MACHINERY' THEN 'Event' WHEN 'FURNITURE' THEN 'Transfer' WHEN 'BUILDING' THEN 'Bridge'
        ELSE 'Additional' END AS type, CASE WHEN c_custkey % 3 = 0 THEN 'National' WHEN c_custkey % 3 = 1 THEN
        'Regional' ELSE 'Local' END AS locale, CASE WHEN c_custkey % 3 = 0 THEN 'ALL' WHEN c_custkey % 3 = 1 THEN
        r_name ELSE n_name END AS locale_name, c_name AS description, c_acctbal < 0 AS transferred FROM customer JOIN
        nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
    "fx_energy_train": """
        SELECT o_orderkey AS row_id, CAST(o_custkey % 30 AS INT) AS data_block_id, c_nationkey AS county, c_mktsegment
        AS product_type, o_totalprice AS target FROM orders JOIN customer ON o_custkey = c_custkey
    """,
    "fx_energy_client": """
        SELECT CAST(c_custkey % 30 AS INT) AS data_block_id, c_nationkey AS county, c_mktsegment AS product_type,
        COUNT(*) AS clients FROM customer WHERE c_custkey % 4 <> 0 GROUP BY 1, 2, 3
    """,
    "fx_train_v1": """
        SELECT * FROM fx_train WHERE (EXTRACT(DAY FROM date) + EXTRACT(MONTH FROM date) + 3 * store_nbr) % 10 <> 0
    """,
    "fx_train_v2": """
        SELECT id, date, store_nbr, family, CASE WHEN (EXTRACT(DAY FROM date) + EXTRACT(MONTH FROM date) + 3 *
        store_nbr) % 7 = 0 THEN sales + 10 ELSE sales END AS sales, onpromotion FROM fx_train WHERE (EXTRACT(DAY FROM
        date) + EXTRACT(MONTH FROM date) + 3 * store_nbr) % 11 <> 0
    """,
    "fx_stores_v1": """
        SELECT * FROM fx_stores WHERE store_nbr % 10 <> 9
    """,
    "fx_stores_v2": """
        SELECT store_nbr, city, state, CASE WHEN store_nbr % 4 = 0 THEN 'E' ELSE type END AS type, cluster FROM
        fx_stores WHERE store_nbr % 11 <> 5
    """,
}

NEEDS = {"fx_train_v1": ["fx_train"], "fx_train_v2": ["fx_train"], "fx_stores_v1": ["fx_stores"], "fx_stores_v2": ["fx_stores"]}
