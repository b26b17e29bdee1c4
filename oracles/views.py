"""DuckDB SQL of the input tables and of the shared bases, as named common table expressions."""

VIEWS = {
    # --- input tables ----------------------------------------------------------------------
    "places": """
        SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "order_lines": """
        SELECT l_orderkey, l_suppkey, p_brand AS category, l_returnflag AS platform,
               CASE l_linenumber WHEN 1 THEN 1 WHEN 2 THEN 3 WHEN 3 THEN 6 WHEN 4 THEN 12
                                 WHEN 5 THEN 18 WHEN 6 THEN 24 ELSE 30 END AS installments,
               CAST(l_quantity AS BIGINT) AS operations,
               CASE WHEN l_quantity = 13 THEN CAST(0 AS DECIMAL(18,4))
                    ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2))
                              * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4))
               END AS amount
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "order_months": """
        SELECT o_orderkey, o_custkey, o_orderpriority,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS period
        FROM orders""",
    "sales": """
        SELECT period, n_name AS province, category,
               nullif(o_orderpriority, '4-NOT SPECIFIED') AS payment_brand, platform,
               c_mktsegment AS aggregator, installments, operations, amount
        FROM order_lines JOIN order_months ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN places ON c_nationkey = n_nationkey""",
    "payments": """
        SELECT period, province, category, payment_brand, installments,
               CAST(SUM(operations) AS BIGINT) AS operations, SUM(amount) AS amount
        FROM sales GROUP BY ALL""",
    "platform_sales": """
        SELECT period, platform, province, category,
               CASE WHEN installments = 24 AND month(period) IN (3, 9) AND year(period) >= 1999
                    THEN 30 ELSE installments END AS installments,
               CAST(SUM(operations) AS BIGINT) AS operations, SUM(amount) AS amount
        FROM sales GROUP BY ALL""",
    "aggregator_sales": """
        SELECT period, aggregator, province, category, installments,
               CAST(SUM(operations) AS BIGINT) AS operations, SUM(amount) AS amount
        FROM sales GROUP BY ALL""",
    "merchant_sales": """
        SELECT period, n_name AS province, category,
               CASE WHEN c_acctbal < 0 THEN -o_custkey ELSE o_custkey END AS merchant_id,
               CAST(SUM(operations) AS BIGINT) AS operations, SUM(amount) AS amount
        FROM order_lines JOIN order_months ON l_orderkey = o_orderkey
        JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        JOIN customer ON o_custkey = c_custkey
        GROUP BY ALL""",
    "merchant_registry": """
        SELECT DISTINCT c_custkey AS merchant_id, c_name AS legal_name, n_name AS province,
               c_mktsegment AS locality, o_orderpriority AS address
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey""",
    "price_index": """
        SELECT DISTINCT period,
               CAST(100 + 2 * ((year(period) - 1995) * 12 + month(period) - 1) AS DOUBLE) AS index_level
        FROM order_months""",
    "population": """
        SELECT n_name AS province, r_name AS region,
               CASE WHEN r_name <> 'MIDDLE EAST' THEN COUNT(*) END AS population
        FROM customer JOIN places ON c_nationkey = n_nationkey GROUP BY n_name, r_name""",
    "category_list": """
        SELECT DISTINCT p_brand AS category FROM part
        UNION ALL SELECT 'Unlisted'""",

    # --- weights ---------------------------------------------------------------------------
    "dominant_sales": "SELECT * FROM platform_sales WHERE platform = 'N'",
    "learning_raw": """
        SELECT * FROM dominant_sales
        WHERE period <= DATE '2001-07-01' AND installments IN (3, 6, 12, 18, 24)""",
    "missing_plan_months": """
        SELECT DISTINCT period FROM learning_raw WHERE period > DATE '1998-12-01'
        EXCEPT
        SELECT DISTINCT period FROM learning_raw WHERE installments = 24""",
    "filled_platforms": """
        SELECT period, platform, province, category, installments, operations, amount
        FROM learning_raw
        UNION ALL
        SELECT m.period, platform, province, category, 24, 1, 1
        FROM (SELECT DISTINCT platform, province, category FROM learning_raw
              WHERE period > DATE '1998-12-01') k
        CROSS JOIN missing_plan_months m""",
    "learning": """
        SELECT * REPLACE (CASE category WHEN 'Brand#23' THEN 'Brand#22' ELSE category END AS category)
        FROM filled_platforms""",
    "weights_observed": """
        SELECT *, CAST(operations AS DOUBLE) / nullif(CAST(SUM(operations) OVER cell AS DOUBLE), 0) AS share_operations,
               CAST(amount AS DOUBLE) / nullif(CAST(SUM(amount) OVER cell AS DOUBLE), 0) AS share_amount
        FROM (SELECT period, platform, category, installments,
                     CAST(SUM(operations) AS BIGINT) AS operations, SUM(amount) AS amount
              FROM learning GROUP BY ALL)
        WINDOW cell AS (PARTITION BY period, platform, installments)""",
    "weights_early": """
        SELECT *, CAST(operations AS DOUBLE) / nullif(CAST(SUM(operations) OVER cell AS DOUBLE), 0) AS share_operations,
               CAST(amount AS DOUBLE) / nullif(CAST(SUM(amount) OVER cell AS DOUBLE), 0) AS share_amount
        FROM (SELECT platform, category, installments,
                     CAST(SUM(operations) AS BIGINT) AS operations, SUM(amount) AS amount
              FROM weights_observed WHERE period <= DATE '1996-06-01' GROUP BY ALL)
        WINDOW cell AS (PARTITION BY platform, installments)""",
    "weights_past": """
        SELECT CAST(c.month AS DATE) AS period, platform, category, installments, operations, amount,
               share_operations, share_amount
        FROM weights_early
        CROSS JOIN generate_series(DATE '1995-01-01', DATE '1995-12-01', INTERVAL 1 MONTH) AS c(month)""",
    "weights_final": """
        SELECT period, platform, category, installments, operations, amount, share_operations, share_amount
        FROM weights_observed WHERE period >= DATE '1996-01-01'
        UNION ALL
        SELECT period, platform, category, installments, operations, amount, share_operations, share_amount
        FROM weights_past""",

    # --- final base ------------------------------------------------------------------------
    "clean": """
        SELECT * FROM payments
        WHERE period <= DATE '2001-07-01' AND installments IN (3, 6, 12, 18, 24) AND amount > 0
          AND payment_brand IS NOT NULL AND province IS NOT NULL AND category IS NOT NULL""",
    "residual": """
        SELECT period, province, installments, SUM(amount) AS amount,
               CAST(SUM(operations) AS BIGINT) AS operations
        FROM clean WHERE category IN ('Brand#24', 'Brand#25') GROUP BY ALL""",
    "residual_weighted": """
        SELECT r.period, r.province, r.installments, r.amount AS amount_total,
               r.operations AS operations_total, w.platform, w.category,
               w.share_operations, w.share_amount
        FROM residual r LEFT JOIN weights_final w
          ON r.period = w.period AND r.installments = w.installments""",
    "allocated": """
        SELECT *, SUM(amount) OVER cell AS check_amount,
               CAST(SUM(operations) OVER cell AS BIGINT) AS check_operations
        FROM (SELECT * EXCLUDE (rounded),
                     CASE WHEN rounded = 0 THEN 1 ELSE rounded END AS operations
              FROM (SELECT *, CAST(CAST(amount_total AS DOUBLE) * share_amount AS DECIMAL(18,4)) AS amount,
                           CAST(round_even(operations_total * share_operations, 0) AS BIGINT) AS rounded
                    FROM residual_weighted))
        WINDOW cell AS (PARTITION BY period, province, installments)""",
    "final_base": """
        SELECT period, province, category, payment_brand, installments, operations, amount
        FROM clean WHERE category NOT IN ('Brand#24', 'Brand#25')
        UNION ALL
        SELECT period, province, category, 'allocated', installments, operations, amount
        FROM allocated""",

    # --- bases of the reports --------------------------------------------------------------
    "base_coef": """
        SELECT index_level AS base_level FROM price_index WHERE period = DATE '2001-07-01'""",
    "deflator": """
        SELECT i.period, i.index_level, i.index_level / base_level * 100 AS index_rebased,
               i.index_level / base_level AS coef,
               (i.index_level / base_level * 100) / nullif(p.index_level / base_level * 100, 0) - 1 AS inflation_mom
        FROM price_index i CROSS JOIN base_coef
        LEFT JOIN price_index p ON p.period = CAST(i.period - INTERVAL 1 MONTH AS DATE)""",
    "base_nominal": """
        SELECT * REPLACE (CASE WHEN category IN ('Brand#1', 'Brand#2', 'Brand#3') THEN 'Appliances'
                               ELSE category END AS category)
        FROM final_base""",
    "base": """
        SELECT b.*, CAST(CAST(amount AS DOUBLE) / nullif(coef, 0) AS DECIMAL(18,4)) AS amount_real
        FROM (SELECT period, province, category, installments, SUM(amount) AS amount,
                     CAST(SUM(operations) AS BIGINT) AS operations FROM base_nominal GROUP BY ALL) b
        LEFT JOIN deflator d ON b.period = d.period""",
    "platform_rows": """
        SELECT * FROM platform_sales
        WHERE period <= DATE '2001-07-01' AND installments IN (3, 6, 12, 18, 24)""",
    "platform_base": """
        SELECT s.*, CAST(CAST(amount AS DOUBLE) / nullif(coef, 0) AS DECIMAL(18,4)) AS amount_real
        FROM (SELECT period, platform, province, installments,
                     CASE WHEN category IN ('Brand#1', 'Brand#2', 'Brand#3') THEN 'Appliances'
                          WHEN category = 'Brand#23' THEN 'Brand#22' ELSE category END AS category,
                     SUM(amount) AS amount, CAST(SUM(operations) AS BIGINT) AS operations
              FROM platform_sales
              WHERE period <= DATE '2001-07-01' AND installments IN (3, 6, 12, 18, 24) GROUP BY ALL) s
        LEFT JOIN deflator d ON s.period = d.period""",
    "other_aggregators": "SELECT * FROM aggregator_sales WHERE aggregator <> 'MACHINERY'",
    "aggregator_base": """
        SELECT s.*, CAST(CAST(amount AS DOUBLE) / nullif(coef, 0) AS DECIMAL(18,4)) AS amount_real
        FROM (SELECT period, aggregator, province, installments,
                     CASE WHEN category IN ('Brand#1', 'Brand#2', 'Brand#3') THEN 'Appliances'
                          WHEN category = 'Brand#23' THEN 'Brand#22' ELSE category END AS category,
                     SUM(amount) AS amount, CAST(SUM(operations) AS BIGINT) AS operations
              FROM other_aggregators
              WHERE period <= DATE '2001-07-01' AND installments IN (3, 6, 12, 18, 24) GROUP BY ALL) s
        LEFT JOIN deflator d ON s.period = d.period""",

    # --- merchants -------------------------------------------------------------------------
    "market_weights": """
        SELECT period, category,
               CAST(operations AS DOUBLE) / nullif(CAST(SUM(operations) OVER m AS DOUBLE), 0) AS share_operations,
               CAST(amount AS DOUBLE) / nullif(CAST(SUM(amount) OVER m AS DOUBLE), 0) AS share_amount
        FROM (SELECT period, category, SUM(operations) AS operations, SUM(amount) AS amount
              FROM weights_final GROUP BY ALL)
        WINDOW m AS (PARTITION BY period)""",
    "ecom_spend": """
        SELECT period, province, category, merchant_id, SUM(amount) AS amount,
               CAST(SUM(operations) AS BIGINT) AS operations
        FROM merchant_sales
        WHERE category = 'Brand#25' AND merchant_id IN (SELECT merchant_id FROM merchant_registry)
        GROUP BY ALL""",
    "ecom_reassigned": """
        SELECT s.period, s.province, w.category, s.merchant_id,
               CAST(CAST(s.amount AS DOUBLE) * share_operations AS DECIMAL(18,4)) AS amount,
               CAST(CAST(s.operations AS DOUBLE) * share_operations AS DECIMAL(18,4)) AS operations
        FROM ecom_spend s LEFT JOIN market_weights w ON s.period = w.period""",
    "merchant_base": """
        SELECT * REPLACE (CASE WHEN category IN ('Brand#1', 'Brand#2', 'Brand#3') THEN 'Appliances'
                               ELSE category END AS category)
        FROM (SELECT period, province, category, merchant_id, amount,
                     CAST(operations AS DECIMAL(18,4)) AS operations
              FROM merchant_sales
              WHERE category <> 'Brand#25'
                 OR merchant_id NOT IN (SELECT merchant_id FROM merchant_registry)
              UNION ALL
              SELECT period, province, category, merchant_id, amount, operations
              FROM ecom_reassigned)""",
    "merchant_cat": """
        SELECT category, merchant_id, SUM(amount) AS amount, SUM(operations) AS operations
        FROM merchant_base WHERE period >= DATE '2000-01-01' GROUP BY ALL""",
    "merchant_top10": """
        SELECT * FROM merchant_cat WHERE amount IS NOT NULL
        QUALIFY rank() OVER (PARTITION BY category ORDER BY amount DESC) <= 10""",
}
