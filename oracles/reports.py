"""DuckDB SQL of the report tables, over the views."""

from __future__ import annotations


def d(column: str) -> str:
    return f"CAST({column} AS DOUBLE)"


def over(value: str, total: str) -> str:
    return f"{d(value)} / nullif({d(total)}, 0)"


def bigint(column: str) -> str:
    return f"CAST(SUM({column}) AS BIGINT) AS {column}"


def total(column: str) -> str:
    return f"SUM({column}) AS {column}"


MEASURES = f"{bigint('operations')}, {total('amount')}"
LATEST = "(SELECT MAX(period) FROM {base})"
MONTH_BACK = "CAST({p} - INTERVAL 1 MONTH AS DATE)"
YEAR_BACK = "CAST({p} - INTERVAL 12 MONTH AS DATE)"
DECEMBER = "make_date(year({p}) - 1, 12, 1)"


def compared(base: str, december: bool = False) -> str:
    last = LATEST.format(base=base)
    months = [last, MONTH_BACK.format(p=last), YEAR_BACK.format(p=last)]
    if december:
        before = DECEMBER.format(p=last)
        months += [before, YEAR_BACK.format(p=before)]
    return f"({', '.join(months)})"


def sums(source: str, keys: str, measures: str, where: str = "TRUE") -> str:
    return f"SELECT {keys}, {measures} FROM {source} WHERE {where} GROUP BY ALL"


def sums_out(source: str, keys: str, where: str = "TRUE") -> str:
    return (f"SELECT {keys}, {bigint('operations')}, {d('SUM(amount)')} AS amount "
            f"FROM {source} WHERE {where} GROUP BY ALL")


def share_table(source: str, keys: str, within: str, measure: str, where: str = "TRUE",
                alias: str = "share") -> str:
    agg = bigint(measure) if measure == "operations" else total(measure)
    out = measure if measure == "operations" else f"{d(measure)} AS {measure}"
    return f"""
        SELECT {keys}, {out}, {over(measure, f'SUM({measure}) OVER (PARTITION BY {within})')} AS {alias}
        FROM ({sums(source, keys, agg, where)})"""


def grown(series: str, keys: list[str], columns: str, rates: dict[str, tuple[str, str]],
          extra: str = "") -> str:
    """Growth by self joins on the shifted month."""
    def same(alias: str) -> str:
        return "".join(f" AND s.{k} IS NOT DISTINCT FROM {alias}.{k}" for k in keys)

    shifts = {"mom": MONTH_BACK, "yoy": YEAR_BACK, "ytd": DECEMBER}
    named = ", ".join(f"{over(f's.{m}', f'{kind}_.{m}')} - 1 AS {name}"
                      for name, (m, kind) in rates.items())
    joins = "\n".join(
        f"LEFT JOIN series {kind}_ ON {kind}_.period = {shift.format(p='s.period')}{same(kind + '_')}"
        for kind, shift in shifts.items())
    return f"""
        SELECT {columns}, {named}{extra}
        FROM (SELECT * FROM series) s {joins}""".replace("series", f"({series})")


def monthly(measure: str) -> str:
    source = "base" if measure == "amount_real" else "base_nominal"
    agg = bigint(measure) if measure == "operations" else total(measure)
    out = "s.operations" if measure == "operations" else f"{d('s.' + measure)} AS {measure}"
    return grown(sums(source, "period", agg), [], f"s.period, {out}",
                 {"mom": (measure, "mom"), "ytd": (measure, "ytd")})


def summary(base: str) -> str:
    rates = {f"{k}_{m}": (m, k) for k in ("mom", "yoy") for m in ("operations", "amount", "amount_real")}
    return grown(sums(base, "period", f"{MEASURES}, {total('amount_real')}"), [],
                 f"s.period, s.operations, {d('s.amount')} AS amount, {d('s.amount_real')} AS amount_real",
                 rates)


def top7(base: str, measure: str) -> str:
    agg = bigint(measure) if measure == "operations" else f"{d(f'SUM({measure})')} AS {measure}"
    return f"""
        SELECT category, {agg} FROM {base} WHERE period = {LATEST.format(base=base)}
        GROUP BY category ORDER BY SUM({measure}) DESC, category LIMIT 7"""


def top7_names(base: str, measure: str) -> str:
    return f"SELECT category FROM ({top7(base, measure)})"


def bucketed(base: str, measure: str) -> str:
    return (f"SELECT *, CASE WHEN category IN ({top7_names(base, measure)}) THEN category "
            f"ELSE 'Other' END AS bucket FROM {base}")


def cat_growth(base: str, december: bool) -> str:
    kinds = ("mom", "yoy", "ytd") if december else ("mom", "yoy")
    rates = {f"{k}_real": ("amount_real", k) for k in kinds} | {k: ("amount", k) for k in kinds}
    series = f"""
        SELECT *, {over('amount', 'SUM(amount) OVER (PARTITION BY period)')} AS share
        FROM ({sums(f"({bucketed(base, 'amount')})", "period, bucket",
                    f"{total('amount_real')}, {total('amount')}")})"""
    full = grown(series, ["bucket"],
                 f"s.period, s.bucket, {d('s.amount_real')} AS amount_real, {d('s.amount')} AS amount, s.share",
                 rates, ", yoy_.share AS share_prev_year")
    if december:
        blank = ", ".join(
            f"CASE WHEN period = {LATEST.format(base=base)} THEN {c} END AS {c}"
            for c in [*rates, "share_prev_year"])
        columns = f"period, bucket, amount_real, amount, share, {blank}"
    else:
        columns = "*"
    return f"SELECT {columns} FROM ({full}) WHERE period IN {compared(base, december)}"


def cat_ops(base: str) -> str:
    series = f"""
        SELECT *, {over('operations', 'SUM(operations) OVER (PARTITION BY period)')} AS share
        FROM ({sums(f"({bucketed(base, 'operations')})", "period, bucket", bigint('operations'))})"""
    full = grown(series, ["bucket"], "s.period, s.bucket, s.operations, s.share",
                 {"mom": ("operations", "mom"), "yoy": ("operations", "yoy")},
                 ", yoy_.share AS share_prev_year")
    return f"SELECT * FROM ({full}) WHERE period IN {compared(base)}"


def top7_year(measure: str) -> str:
    agg = bigint(measure) if measure == "operations" else total(measure)
    out = measure if measure == "operations" else f"{d(measure)} AS {measure}"
    return f"""
        SELECT year, category, {out}
        FROM ({sums('base_nominal', 'CAST(year(period) AS INTEGER) AS year, category', agg, 'year(period) IN (2000, 2001)')})
        QUALIFY row_number() OVER (PARTITION BY year ORDER BY {measure} DESC, category) <= 7"""


def year_shares(year: int, base: str, rank_by: str, measures: dict[str, str]) -> str:
    names = f"""
        SELECT category FROM {base} WHERE year(period) = {year}
        GROUP BY category ORDER BY SUM({rank_by}) DESC, category LIMIT 7"""
    out = ", ".join(f"{over(f'SUM({m})', f'(SELECT SUM({m}) FROM {base} WHERE year(period) = {year})')} AS {a}"
                    for a, m in measures.items())
    return f"""
        SELECT CAST({year} AS INTEGER) AS year, bucket, {out}
        FROM (SELECT *, CASE WHEN category IN ({names}) THEN category ELSE 'Other' END AS bucket
              FROM {base} WHERE year(period) = {year})
        GROUP BY bucket"""


REAL_AND_NOMINAL = {"share_real": "amount_real", "share": "amount"}
OPERATIONS = {"share": "operations"}


def both_years(base: str, rank_by: str, measures: dict[str, str]) -> str:
    return " UNION ALL ".join(f"({year_shares(y, base, rank_by, measures)})" for y in (2000, 2001))


def growth_with_years() -> str:
    last = LATEST.format(base="base")
    columns = ", ".join(f"CASE WHEN g.period = {last} THEN y{i}.{c} END AS {c}_y{i}"
                        for i in (1, 2) for c in REAL_AND_NOMINAL)
    return f"""
        SELECT g.*, {columns}
        FROM ({cat_growth('base', True)}) g
        LEFT JOIN ({year_shares(2000, 'base', 'amount', REAL_AND_NOMINAL)}) y1 ON g.bucket = y1.bucket
        LEFT JOIN ({year_shares(2001, 'base', 'amount', REAL_AND_NOMINAL)}) y2 ON g.bucket = y2.bucket"""


def years_side_by_side() -> str:
    def ranked(year: int, i: int) -> str:
        return f"""
            SELECT CAST(row_number() OVER (ORDER BY bucket = 'Other', share DESC, bucket) AS INTEGER) AS rank,
                   bucket AS bucket_y{i}, share AS share_y{i}
            FROM ({year_shares(year, 'base_nominal', 'operations', OPERATIONS)})"""

    return f"SELECT * FROM ({ranked(2000, 1)}) FULL JOIN ({ranked(2001, 2)}) USING (rank)"


def plan_share(base: str, where: str = "TRUE") -> str:
    return (f"SELECT * FROM ({share_table(base, 'period, installments', 'period', 'amount')}) "
            f"WHERE {where}")


def plan_in_cat(base: str, where: str = "TRUE") -> str:
    table = share_table(base, "period, category, installments", "period, category", "amount",
                        f"category IN ({top7_names(base, 'amount')})")
    return f"SELECT * FROM ({table}) WHERE {where}"


def ticket(base: str) -> str:
    rows = f"{base} WHERE category IN ({top7_names(base, 'amount')})"
    plans = f"""
        SELECT period, category, CAST(installments AS VARCHAR) AS installments, {MEASURES}
        FROM {rows} GROUP BY period, category, CAST(installments AS VARCHAR)
        UNION ALL
        SELECT period, category, 'Total', {MEASURES} FROM {rows} GROUP BY period, category"""
    series = f"SELECT *, {over('amount', 'operations')} AS avg_ticket FROM ({plans})"
    full = grown(series, ["category", "installments"],
                 f"s.period, s.category, s.installments, {d('s.amount')} AS amount, s.operations, s.avg_ticket",
                 {"mom": ("avg_ticket", "mom"), "yoy": ("avg_ticket", "yoy")})
    return f"SELECT * FROM ({full}) WHERE period IN {compared(base)}"


def ticket_ratio(base: str) -> str:
    return f"""
        SELECT t.*, CASE WHEN t.installments = '18' THEN {over('t.avg_ticket', 'three.avg_ticket')} END AS ratio_18_3
        FROM ({ticket(base)}) t
        LEFT JOIN ({ticket(base)}) three
          ON t.period = three.period AND t.category = three.category AND three.installments = '3'"""


def ticket_month(base: str) -> str:
    return f"SELECT period, {over('SUM(amount)', 'SUM(operations)')} AS avg_ticket FROM {base} GROUP BY period"


def place_growth(source: str, place: str) -> str:
    series = f"""
        SELECT *, {over('amount', 'SUM(amount) OVER (PARTITION BY period)')} AS share
        FROM ({sums(source, f'period, {place}', total('amount'))})"""
    full = grown(series, [place], f"s.period, s.{place}, {d('s.amount')} AS amount, s.share",
                 {k: ("amount", k) for k in ("mom", "yoy", "ytd")})
    last = LATEST.format(base="base_nominal")
    blank = ", ".join(f"CASE WHEN period = {last} THEN {c} END AS {c}" for c in ("mom", "yoy", "ytd"))
    return (f"SELECT period, {place}, amount, share, {blank} FROM ({full}) "
            f"WHERE period IN {compared('base_nominal', True)}")


def prov_percap_exact(base: str) -> str:
    return f"""
        SELECT s.*, region, population, {over('amount', 'population')} AS amount_per_capita
        FROM ({sums(base, 'period, province', total('amount'), "period >= DATE '1999-01-01'")}) s
        LEFT JOIN population USING (province)"""


def prov_percap(base: str) -> str:
    full = grown(prov_percap_exact(base), ["province"],
                 f"s.period, s.province, {d('s.amount')} AS amount, s.region, s.population, s.amount_per_capita",
                 {"mom": ("amount_per_capita", "mom")})
    return full


def region_percap(base: str) -> str:
    return f"""
        SELECT period, region, population, {d('amount')} AS amount,
               {over('amount', 'population')} AS amount_per_capita
        FROM (SELECT period, region, CAST(SUM(population) AS BIGINT) AS population, SUM(amount) AS amount
              FROM ({prov_percap_exact(base)}) GROUP BY period, region)"""


def prov_main_cat(base: str) -> str:
    table = share_table(base, "period, province, category", "province", "amount",
                        f"period = {LATEST.format(base=base)}")
    return f"""
        SELECT * FROM ({table}) QUALIFY amount = MAX(amount) OVER (PARTITION BY province)"""


def member_share(base: str, member: str) -> str:
    return f"""
        SELECT period, {member}, {d('amount')} AS amount, operations,
               {over('amount', 'SUM(amount) OVER (PARTITION BY period)')} AS share_amount,
               {over('operations', 'SUM(operations) OVER (PARTITION BY period)')} AS share_operations
        FROM ({sums(base, f'period, {member}', MEASURES)})"""


def channel(prefix: str, base: str) -> dict[str, str]:
    tables = {
        "top7_amount": top7(base, "amount"),
        "top7_ops": top7(base, "operations"),
        "cat_growth3": cat_growth(base, False),
        "cat_ops": cat_ops(base),
        "plan_share": plan_share(base),
        "plan_share_cmp": plan_share(base, f"period IN {compared(base)}"),
        "plan_in_cat": plan_in_cat(base),
        "plan_in_cat_last": plan_in_cat(base, f"period = {LATEST.format(base=base)}"),
        "ticket": ticket(base),
        "ticket_ratio": ticket_ratio(base),
        "ticket_month": ticket_month(base),
        "prov_percap": prov_percap(base),
        "region_percap": region_percap(base),
        "prov_main_cat": prov_main_cat(base),
    }
    return {prefix + name: sql for name, sql in tables.items()}


WEIGHT_COLUMNS = (f"platform, category, installments, operations, {d('amount')} AS amount, "
                  "share_operations, share_amount")
FACTS = f"period, province, category, payment_brand, installments, operations, {d('amount')} AS amount"
PLATFORM_FACTS = f"period, platform, province, category, installments, operations, {d('amount')} AS amount"
CELL = "period, province, installments"
ROUND_SHARES = "ROUND(SUM(share_operations), 6) AS share_operations, ROUND(SUM(share_amount), 6) AS share_amount"


def domain(source: str, extract: str, columns: list[str]) -> list[str]:
    return [f"SELECT DISTINCT '{extract}' AS extract, '{c}' AS dimension, {c} AS value FROM {source} "
            f"WHERE {c} IS NOT NULL" for c in columns]


def null_count(name: str, source: str, columns: list[str]) -> str:
    anything = " OR ".join(f"{c} IS NULL" for c in columns)
    return f"SELECT '{name}' AS \"check\", COUNT(*) AS violations FROM {source} WHERE {anything}"


PAYMENT_KEYS = ["period", "province", "category", "payment_brand", "installments", "operations", "amount"]
SALE_KEYS = ["period", "platform", "province", "category", "installments", "operations", "amount"]

RECONCILE = """
    SELECT period, province, installments, c.amount AS amount_clean, c.operations AS operations_clean,
           r.amount AS amount_raw, r.operations AS operations_raw,
           abs(CAST(c.amount - r.amount AS DOUBLE)) <= 0.01 + abs(CAST(r.amount AS DOUBLE)) * 1e-12 AS amount_equal,
           c.operations = r.operations AS operations_equal,
           c.operations - r.operations AS operations_diff
    FROM (SELECT period, province, installments, SUM(amount) AS amount,
                 CAST(SUM(operations) AS BIGINT) AS operations FROM final_base GROUP BY ALL) c
    FULL JOIN (SELECT period, province, installments, SUM(amount) AS amount,
                      CAST(SUM(operations) AS BIGINT) AS operations FROM clean GROUP BY ALL) r
      USING (period, province, installments)"""

COVERAGE = """
    SELECT category, bool_or(observed) AS observed, bool_or(listed) AS listed
    FROM (SELECT category, TRUE AS observed, FALSE AS listed FROM learning
          UNION ALL SELECT category, FALSE, TRUE FROM category_list)
    GROUP BY category"""

CHECKS = [
    null_count("payments_null_rows", "payments", PAYMENT_KEYS),
    null_count("platform_null_rows", "learning_raw", SALE_KEYS),
    null_count("base_null_rows", "final_base", PAYMENT_KEYS),
    "SELECT 'months_without_plan', COUNT(*) FROM missing_plan_months",
    "SELECT 'several_platforms', CASE WHEN COUNT(DISTINCT platform) = 1 THEN 0 ELSE 1 END FROM weights_final",
    f"""SELECT 'weights_off_one', COUNT(*)
        FROM (SELECT period, installments, {ROUND_SHARES} FROM weights_final GROUP BY ALL)
        WHERE abs(share_operations - 1) > 1e-6 OR abs(share_amount - 1) > 1e-6""",
    """SELECT 'weights_overlap', CASE WHEN COUNT(*) > 0 THEN 1 ELSE 0 END
       FROM (SELECT period FROM weights_observed WHERE period >= DATE '1996-01-01'
             INTERSECT SELECT period FROM weights_past)""",
    "SELECT 'residual_without_weight', COUNT(*) FROM allocated WHERE category IS NULL",
    f"SELECT 'amounts_off', COUNT(*) FROM ({RECONCILE}) WHERE amount_equal IS NOT TRUE",
    f"SELECT 'category_unlisted', COUNT(*) FROM ({COVERAGE}) WHERE NOT listed",
    f"SELECT 'category_unobserved', COUNT(*) FROM ({COVERAGE}) WHERE NOT observed",
    """SELECT 'merchant_months_without_weight', COUNT(*)
       FROM (SELECT period FROM merchant_sales EXCEPT SELECT period FROM weights_final)""",
    """SELECT 'months_without_index', COUNT(*)
       FROM (SELECT period FROM base EXCEPT SELECT period FROM price_index)""",
    """SELECT 'periods_not_first', COUNT(*) FROM payments WHERE day(period) <> 1""",
    """SELECT 'residual_amount_lost', CAST(coalesce(round(SUM(amount_total)), 0) AS BIGINT)
       FROM allocated WHERE category IS NULL""",
    """SELECT 'province_without_population', COUNT(*)
       FROM (SELECT province FROM final_base EXCEPT SELECT province FROM population)""",
]

PRESENCE = """
    SELECT merchant_id, MAX(CASE WHEN period < DATE '1996-01-01' THEN 'yes' END) AS before,
           MAX(CASE WHEN period = DATE '1996-01-01' THEN 'yes' END) AS in_month
    FROM merchant_sales WHERE period <= DATE '1996-01-01' GROUP BY merchant_id"""
NEW = f"SELECT * FROM ({PRESENCE}) WHERE before IS NULL"

MERCHANT_SHARE = f"""
    SELECT b.category, b.bucket, {d('b.amount')} AS "amount_since_2000-01-01",
           {d('b.operations')} AS "operations_since_2000-01-01",
           {over('b.amount', 'SUM(b.amount) OVER (PARTITION BY b.category)')} AS share_amount,
           {over('b.operations', 'SUM(b.operations) OVER (PARTITION BY b.category)')} AS share_operations,
           n.merchant_id, n.legal_name
    FROM (SELECT m.category, CASE WHEN t.merchant_id IS NOT NULL THEN CAST(m.merchant_id AS VARCHAR)
                                  ELSE 'Rest' END AS bucket,
                 SUM(m.amount) AS amount, SUM(m.operations) AS operations
          FROM merchant_cat m LEFT JOIN merchant_top10 t
            ON m.category IS NOT DISTINCT FROM t.category AND m.merchant_id = t.merchant_id
          GROUP BY 1, 2) b
    LEFT JOIN (SELECT merchant_id, MIN(legal_name) AS legal_name FROM merchant_registry GROUP BY merchant_id) n
      ON b.bucket = CAST(n.merchant_id AS VARCHAR)"""

SINCE = "period >= DATE '2000-01-01'"
RECENT = "period >= DATE '1999-01-01'"

SELECTS = {
    # --- weights ---------------------------------------------------------------------------
    "plan_domain": "SELECT DISTINCT installments FROM dominant_sales",
    "dim_domain": " UNION ALL ".join(
        domain("clean", "payments", ["category", "province", "payment_brand"])
        + domain("filled_platforms", "platform_sales", ["category", "platform", "province"])),
    "null_rows": f"SELECT {FACTS} FROM payments WHERE payment_brand IS NULL",
    "null_rows_count": " UNION ALL ".join([
        null_count("payments", "payments", PAYMENT_KEYS),
        null_count("platform_sales", "learning_raw", SALE_KEYS),
        null_count("platform_channel", "platform_rows", SALE_KEYS),
        null_count("final_base", "final_base", PAYMENT_KEYS)]),
    "all_plans_domain": "SELECT DISTINCT installments FROM platform_sales",
    "channel_domain": " UNION ALL ".join(
        f"""SELECT DISTINCT '{channel}' AS extract, '{dimension}' AS dimension, {dimension} AS value
            FROM {channel}_base""" for channel in ("platform", "aggregator") for dimension in ("category", channel)),
    "base_domain": " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS dimension, CAST({c} AS VARCHAR) AS value FROM final_base"
        for c in ("payment_brand", "category", "installments", "period")),
    "sale_null_rows": f"SELECT {PLATFORM_FACTS} FROM platform_sales WHERE "
                      + " OR ".join(f"{c} IS NULL" for c in SALE_KEYS),
    "base_null_rows": f"SELECT {FACTS} FROM final_base WHERE " + " OR ".join(f"{c} IS NULL" for c in PAYMENT_KEYS),
    "missing_plan_months": "SELECT period FROM missing_plan_months",
    "filled_platforms": f"SELECT {PLATFORM_FACTS} FROM filled_platforms",
    "remapped": f"SELECT {PLATFORM_FACTS} FROM learning",
    "by_province_month": sums_out("learning", "period, platform, province"),
    "split_province": sums_out("learning", "period, platform, province"),
    "by_category_month": sums_out("learning", "period, category"),
    "by_plan_month": sums_out("learning", "period, platform, installments"),
    "category_coverage": COVERAGE,
    "weights": f"SELECT period, {WEIGHT_COLUMNS} FROM weights_observed",
    "weights_sum": f"SELECT period, installments, {ROUND_SHARES} FROM weights_observed GROUP BY ALL",
    "weight_series": """
        SELECT installments, category, period, share_operations, share_amount
        FROM weights_observed WHERE installments IN (3, 6, 12, 18)""",
    "early_weights": f"SELECT {WEIGHT_COLUMNS} FROM weights_early",
    "backcast": f"SELECT period, {WEIGHT_COLUMNS} FROM weights_past",
    "weights_final": f"SELECT period, {WEIGHT_COLUMNS} FROM weights_final",
    "weights_overlap": """
        SELECT COUNT(*) AS months, COUNT(*) > 0 AS overlap
        FROM (SELECT period FROM weights_observed WHERE period >= DATE '1996-01-01'
              INTERSECT SELECT period FROM weights_past)""",
    "weights_final_sum": f"SELECT period, installments, {ROUND_SHARES} FROM weights_final GROUP BY ALL",

    # --- base ------------------------------------------------------------------------------
    "clean": f"SELECT {FACTS} FROM clean",
    "residual_domain": """
        SELECT DISTINCT province, category, payment_brand FROM clean
        WHERE category IN ('Brand#24', 'Brand#25')""",
    "single_platform": """
        SELECT COUNT(DISTINCT platform) AS platforms, COUNT(DISTINCT platform) = 1 AS single
        FROM weights_final""",
    "residual": f"SELECT {CELL}, {d('amount')} AS amount, operations FROM residual",
    "residual_weight_sum": f"SELECT {CELL}, {ROUND_SHARES} FROM residual_weighted GROUP BY ALL",
    "allocated": f"""
        SELECT {CELL}, {d('amount_total')} AS amount_total, operations_total, platform, category,
               share_operations, share_amount, {d('amount')} AS amount, operations,
               {d('check_amount')} AS check_amount, check_operations
        FROM allocated""",
    "final_base": f"SELECT {FACTS} FROM final_base",
    "reconcile": f"""
        SELECT * REPLACE ({d('amount_clean')} AS amount_clean, {d('amount_raw')} AS amount_raw)
        FROM ({RECONCILE})""",
    "deflator": "SELECT period, index_level, index_rebased, coef, inflation_mom FROM deflator",
    "checks": " UNION ALL ".join(CHECKS),

    # --- monthly ---------------------------------------------------------------------------
    "m_nominal": monthly("amount"),
    "m_real": monthly("amount_real"),
    "m_ops": monthly("operations"),
    "top7_amount_year": top7_year("amount"),
    "top7_ops_year": top7_year("operations"),
    "cat_growth5": cat_growth("base", True),
    "cat_year_share": both_years("base", "amount", REAL_AND_NOMINAL),
    "cat_growth5_year": growth_with_years(),
    "cat_ops_year": both_years("base_nominal", "operations", OPERATIONS),
    "cat_ops_year_side": years_side_by_side(),
    "plan_share_year": share_table("base", "year, installments", "year", "amount_real", alias="share_real")
    .replace("FROM base", "FROM (SELECT *, CAST(year(period) AS INTEGER) AS year FROM base WHERE year(period) IN (2000, 2001))"),
    "prov_growth": place_growth("base_nominal", "province"),
    "region_growth": place_growth(
        "(SELECT * FROM base_nominal LEFT JOIN population USING (province))", "region"),
    "prov_year_real": share_table("base", "year, province", "year", "amount_real", alias="share_real")
    .replace("FROM base", "FROM (SELECT *, CAST(year(period) AS INTEGER) AS year FROM base WHERE year(period) = 2001)"),
    "pop_total": "SELECT CAST(SUM(population) AS BIGINT) AS population FROM population",
    **channel("", "base"),

    # --- channels --------------------------------------------------------------------------
    **channel("platform_", "platform_base"),
    **channel("aggregator_", "aggregator_base"),
    "summary12": summary("platform_base"),
    "aggregator_summary12": summary("aggregator_base"),
    "platform_share": member_share("platform_base", "platform"),
    "minor_platform_prov": sums_out("platform_base", "period, province, platform", "platform <> 'N'"),
    "aggregator_domain": "SELECT DISTINCT aggregator FROM other_aggregators",
    "aggregator_plan_domain": "SELECT DISTINCT installments FROM other_aggregators",
    "aggregator_share": member_share("aggregator_base", "aggregator"),
    "aggregator_rank": f"""
        SELECT aggregator, {d('SUM(amount)')} AS amount FROM aggregator_base
        WHERE period = {LATEST.format(base='aggregator_base')} GROUP BY aggregator""",

    # --- provinces and registry ------------------------------------------------------------
    "prov_share_amount": share_table("base_nominal", "period, province", "period", "amount", RECENT,
                                     "share"),
    "prov_share_ops": share_table("base_nominal", "period, province", "period", "operations", RECENT),
    "prov_top7": f"""
        SELECT province, category, {d('amount')} AS amount
        FROM ({sums('base_nominal', 'province, category', total('amount'), SINCE)})
        QUALIFY row_number() OVER (PARTITION BY province ORDER BY amount DESC, category) <= 7""",
    "prov_cat_share": f"""
        SELECT province, bucket, {d('SUM(amount)')} AS amount,
               {over('SUM(amount)', 'SUM(SUM(amount)) OVER (PARTITION BY province)')} AS share
        FROM (SELECT province, amount, CASE WHEN row_number() OVER (
                         PARTITION BY province ORDER BY amount DESC, category) <= 7
                     THEN category ELSE 'Other' END AS bucket
              FROM ({sums('base_nominal', 'province, category', total('amount'), SINCE)}))
        GROUP BY province, bucket""",
    "prov_cat_plan": share_table(
        "base_nominal", "province, category, installments", "province, category", "amount",
        f"""{SINCE} AND (province, category) IN (
            SELECT (province, category)
            FROM ({sums('base_nominal', 'province, category', total('amount'), SINCE)})
            QUALIFY row_number() OVER (PARTITION BY province ORDER BY amount DESC, category) <= 7)"""),
    "merchants_prov": f"""
        SELECT period, province, COUNT(DISTINCT merchant_id) AS merchants
        FROM merchant_sales WHERE {RECENT} GROUP BY ALL""",
    "registry_rows": f"""
        SELECT merchant_id, registry_rows,
               {over('registry_rows', '(SELECT COUNT(*) FROM merchant_registry)')} AS share
        FROM (SELECT merchant_id, COUNT(*) AS registry_rows FROM merchant_registry GROUP BY merchant_id)""",
    "registry_dups": """
        SELECT * FROM merchant_registry QUALIFY COUNT(*) OVER (PARTITION BY merchant_id) > 1""",
    "registry_locality": """
        SELECT province, locality, COUNT(DISTINCT merchant_id) AS merchants
        FROM merchant_registry GROUP BY ALL""",
    "registry_address": """
        SELECT DISTINCT merchant_id, province, locality, address FROM merchant_registry""",

    # --- categories and merchants ----------------------------------------------------------
    "ecom_merchants": "SELECT DISTINCT merchant_id FROM ecom_spend",
    "market_weights": "SELECT period, category, share_operations, share_amount FROM market_weights",
    "ecom_spend": f"SELECT * REPLACE ({d('amount')} AS amount) FROM ecom_spend",
    "ecom_reassigned": f"""
        SELECT * REPLACE ({d('amount')} AS amount, {d('operations')} AS operations) FROM ecom_reassigned""",
    "merchant_base": f"""
        SELECT * REPLACE ({d('amount')} AS amount, {d('operations')} AS operations) FROM merchant_base""",
    "cat_share_amount": share_table("base_nominal", "period, category", "period", "amount", RECENT,
                                    "share"),
    "cat_share_ops": share_table("base_nominal", "period, category", "period", "operations", RECENT),
    "prov_in_cat": share_table("base_nominal", "province, category", "category", "amount", SINCE),
    "merchant_cat": f"""
        SELECT * REPLACE ({d('amount')} AS amount, {d('operations')} AS operations) FROM merchant_cat""",
    "merchant_top10": f"""
        SELECT * REPLACE ({d('amount')} AS amount, {d('operations')} AS operations) FROM merchant_top10""",
    "merchant_share": MERCHANT_SHARE,
    "merchants_cat": f"""
        SELECT category, COUNT(DISTINCT merchant_id) AS "merchants_since_2000-01-01"
        FROM merchant_base WHERE {SINCE} GROUP BY category""",
    "cat_share_since": f"""
        SELECT category, operations, {d('amount')} AS amount,
               {over('operations', 'SUM(operations) OVER ()')} AS share_operations,
               {over('amount', 'SUM(amount) OVER ()')} AS share_amount
        FROM ({sums('base_nominal', 'category', MEASURES, SINCE)})""",

    # --- ad-hoc merchant requests ----------------------------------------------------------
    "merchants_since": f"SELECT DISTINCT merchant_id FROM merchant_sales WHERE {RECENT}",
    "merchants_since_count": f"""
        SELECT COUNT(DISTINCT merchant_id) AS merchants FROM merchant_sales WHERE {RECENT}""",
    "merchants_presence": PRESENCE,
    "merchants_new": NEW,
    "merchants_new_count": f"SELECT COUNT(*) AS merchants FROM ({NEW})",
    "merchants_new_rows": f"""
        SELECT s.* REPLACE ({d('s.amount')} AS amount), n.before, n.in_month
        FROM merchant_sales s JOIN ({NEW}) n USING (merchant_id)""",
    "merchants_total": "SELECT COUNT(DISTINCT merchant_id) AS merchants FROM merchant_sales",
}
