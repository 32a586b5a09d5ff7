"""The queries of the registry as SQL over the same tables, for comparison."""

from __future__ import annotations

from tillroll.queries.registry import (
    BUNDLE_COLUMNS,
    DEFAULT_RATE,
    DENSITY_POINTS,
    GENERATED_AT,
    HISTOGRAM_BINS,
    LARGE_ID,
    OVERRIDES,
    PROFILE_COLUMNS,
    SLICE,
)
from tillroll.schema import NUMBER_COLUMNS, RAW_COLUMNS
from tillroll.sources.star import DEFECTS

SALES = """
sales AS (
    SELECT l_orderkey AS order_id, o_orderdate AS order_date, l_partkey AS product_id,
           p_type AS product_category, p_brand AS product_brand, p_retailprice AS price,
           l_discount * 100 AS discount_percent, l_quantity AS quantity_sold,
           r_name AS customer_region, o_orderpriority AS payment_method,
           CAST(p_size AS DOUBLE) / 10 AS rating, CAST(l_linenumber AS DOUBLE) AS review_count,
           p_retailprice * (1 - l_discount * 100 / 100) AS discounted_price,
           p_retailprice * (1 - l_discount * 100 / 100) * l_quantity AS total_revenue,
           p_retailprice * l_quantity AS gross_revenue,
           p_retailprice * l_quantity
             - p_retailprice * (1 - l_discount * 100 / 100) * l_quantity AS discount_value
    FROM lineitem
    LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN part ON l_partkey = p_partkey
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey
)"""


def _raw_column(name: str) -> str:
    if name == "order_date":
        text = "strftime(order_date, '%Y-%m-%d')"
    elif name in ("order_id", "product_id") or name not in NUMBER_COLUMNS:
        text = f"CAST({name} AS VARCHAR)"
    else:
        text = f"CAST(CAST({name} AS DECIMAL(18,4)) AS VARCHAR)"
    cases = ""
    for every, defect in DEFECTS.get(name, []):
        shown = "NULL" if defect in (None, "N/A") else f"'{defect}'"
        cases += f" WHEN order_id % {every} = 0 THEN {shown}"
    return f"CASE{cases} ELSE {text} END AS {name}" if cases else f"{text} AS {name}"


RAW = f"{SALES}, raw AS (SELECT {', '.join(map(_raw_column, RAW_COLUMNS))} FROM sales)"

def _number(value: str) -> str:
    """The value, null where it is NaN."""
    return f"CASE WHEN NOT isnan({value}) THEN {value} END"


CLEAN = f"""{RAW}, typed AS (
    SELECT TRY_CAST(order_id AS BIGINT) AS order_id,
           TRY_CAST(order_date AS TIMESTAMP) AS order_date,
           TRY_CAST(product_id AS BIGINT) AS product_id, product_category,
           TRY_CAST(price AS DOUBLE) AS price,
           TRY_CAST(discount_percent AS DOUBLE) AS discount_percent,
           TRY_CAST(quantity_sold AS DOUBLE) AS quantity_sold,
           customer_region, payment_method, TRY_CAST(rating AS DOUBLE) AS rating,
           TRY_CAST(review_count AS DOUBLE) AS review_count
    FROM raw
), kept AS (
    SELECT * REPLACE (
        CASE WHEN discount_percent < 0 THEN 0 WHEN discount_percent > 100 THEN 100
             ELSE discount_percent END AS discount_percent,
        CASE WHEN rating < 0 THEN 0 WHEN rating > 5 THEN 5 ELSE rating END AS rating)
    FROM typed
    WHERE order_date IS NOT NULL AND price >= 0 AND discount_percent IS NOT NULL
      AND quantity_sold > 0
), clean AS (
    SELECT *, {_number("price * (1 - discount_percent / 100)")} AS discounted_price,
           {_number("price * (1 - discount_percent / 100) * quantity_sold")} AS total_revenue
    FROM kept
)"""


def _features(source: str) -> str:
    return f"""featured AS (
    SELECT *, year(order_date) AS year, month(order_date) AS month,
           monthname(order_date) AS month_name, quarter(order_date) AS quarter,
           dayname(order_date) AS day_of_week,
           coalesce(isodow(order_date) >= 6, false) AS is_weekend,
           coalesce({_number("total_revenue / nullif(gross_revenue, 0)")}, 0)
             AS net_revenue_retained,
           coalesce({_number("total_revenue / nullif(quantity_sold, 0)")}, 0) AS revenue_per_unit,
           coalesce({_number("discount_value / nullif(gross_revenue, 0)")}, 0) * 100
             AS discount_impact_pct
    FROM {source}
)"""


PROCESSED = f"""{CLEAN}, grossed AS (
    SELECT *, price * quantity_sold AS gross_revenue,
           {_number("price * quantity_sold - total_revenue")} AS discount_value
    FROM clean
), {_features("grossed")}"""


UNRATED = "* REPLACE (CASE WHEN order_id % 131 <> 0 THEN rating END AS rating)"
PROFILED = f"""{SALES}, partly_rated AS (
    SELECT {UNRATED} FROM sales
), {_features("partly_rated")}"""


def _money(column: str, condition: str = "") -> str:
    where = f" FILTER (WHERE {condition})" if condition else ""
    return f"coalesce(CAST(sum({_exact(column)}){where} AS DOUBLE), 0)"


def _exact(column: str) -> str:
    """Infinity is left out; what else does not fit is an error."""
    return f"CASE WHEN NOT isinf(CAST({column} AS DOUBLE)) THEN CAST({column} AS DECIMAL(28,6)) END"


def _mean_money(column: str) -> str:
    return f"round({_money(column)} / count({_exact(column)}), 6)"


def _ratio(numerator: str, denominator: str) -> str:
    return f"coalesce({numerator} / nullif({denominator}, 0), 0)"


def _with(ctes: str, query: str) -> str:
    return f"WITH {ctes}\n{query}"


def _cte(base: str, name: str, query: str) -> str:
    return f"{base}, {name} AS (\n{query}\n)"


TOTALS = f"""SELECT {_money("total_revenue")} AS net, {_money("gross_revenue")} AS gross,
    count(DISTINCT order_id) AS orders, {_money("quantity_sold")} AS units,
    round(coalesce(avg(rating), 0), 6) AS rating"""


def _long(label: str, rows: list[tuple[str, str]], source: str, kind: str = "DOUBLE") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS {label}, CAST({value} AS {kind}) AS value FROM {source}"
        for name, value in rows
    )


KPI_RECORD = f"""SELECT net AS total_revenue, orders AS total_orders, units AS total_units,
    {_ratio("net", "orders")} AS avg_ticket, rating AS avg_rating,
    {_ratio("net", "gross")} AS net_revenue_retained FROM t"""

SLICE_CONDITION = (
    f"order_date >= TIMESTAMP '{SLICE['start']}' "
    f"AND order_date < TIMESTAMP '{SLICE['end']}' + INTERVAL 1 DAY "
    f"AND customer_region = '{SLICE['region']}'"
)


def _spark_type(column: str) -> str:
    """The type Spark shows for a column of the featured sales table."""
    if column in ("order_id", "product_id"):
        return "bigint"
    if column in ("product_category", "customer_region", "payment_method", "month_name"):
        return "string"
    if column in ("year", "month", "quarter"):
        return "int"
    return {"order_date": "timestamp_ntz", "day_of_week": "string", "is_weekend": "boolean"}.get(
        column, "double"
    )


def _quality_oracles() -> dict[str, str]:
    not_null = [
        "order_id",
        "order_date",
        "product_id",
        "product_category",
        "price",
        "discount_percent",
        "quantity_sold",
    ]
    number = "TRY_CAST({0} AS DOUBLE)".format
    rules = [(f"{c}_not_null", c, f"{c} IS NULL") for c in not_null]
    rules += [
        (f"{c}_numeric", c, f"{c} IS NOT NULL AND {number(c)} IS NULL") for c in NUMBER_COLUMNS
    ]
    at_least_zero = [
        "price",
        "discount_percent",
        "rating",
        "review_count",
        "discounted_price",
        "total_revenue",
    ]
    rules += [(f"{c}_ge_0", c, f"{number(c)} < 0") for c in at_least_zero]
    rules += [
        ("discount_percent_le_100", "discount_percent", f"{number('discount_percent')} > 100"),
        ("rating_le_5", "rating", f"{number('rating')} > 5"),
    ]
    minimal = [("quantity_sold_gt_0", "quantity_sold", f"{number('quantity_sold')} <= 0")]
    rules += minimal

    def counted(which):
        return _with(
            RAW,
            "\nUNION ALL\n".join(
                f"SELECT '{rule}' AS rule, '{column}' AS \"column\", "
                f"count(*) FILTER (WHERE {breach}) AS violations FROM raw"
                for rule, column, breach in which
            ),
        )

    listed = "\nUNION ALL\n".join(
        f"SELECT order_id, '{rule}' AS rule, '{column}' AS \"column\", {column} AS value "
        f"FROM raw WHERE {breach}"
        for rule, column, breach in rules
    )

    def gates(base, source, column="{0}"):
        discount, rating, quantity, price = (
            column.format(c) for c in ("discount_percent", "rating", "quantity_sold", "price")
        )
        return _with(
            base,
            f"""SELECT count(*) AS row_count,
    count(*) FILTER (WHERE {discount} < 0 OR {discount} > 100) AS discount_percent_out_of_range,
    count(*) FILTER (WHERE {rating} < 0 OR {rating} > 5) AS rating_out_of_range,
    count(*) FILTER (WHERE {quantity} <= 0) AS quantity_sold_not_positive,
    count(*) FILTER (WHERE {price} < 0) AS price_negative FROM {source}""",
        )

    frame = [*RAW_COLUMNS, "year", "month", "month_name", "quarter", "day_of_week", "is_weekend"]
    frame += ["gross_revenue", "discount_value", "net_revenue_retained", "revenue_per_unit"]
    frame += ["discount_impact_pct"]
    nulls = " + ".join(f"(count(*) - count({c}))" for c in frame)
    audit = _long(
        '"check"',
        [
            ("row_count", "count(*)"),
            ("null_values", nulls),
            ("duplicated_order_id", "count(*) - count(DISTINCT coalesce(order_id, -1))"),
            (
                "discount_out_of_range",
                "count(*) FILTER (WHERE discount_percent < 0 OR discount_percent > 100)",
            ),
            ("rating_out_of_range", "count(*) FILTER (WHERE rating < 0 OR rating > 5)"),
        ],
        "featured",
        "BIGINT",
    )
    retention = """SELECT r AS raw_row_count, c AS clean_row_count, r - c AS rows_dropped,
    coalesce(CAST(c AS DOUBLE) / nullif(r, 0), 0) AS row_retention_rate
    FROM (SELECT count(*) AS r FROM raw) CROSS JOIN (SELECT count(*) AS c FROM clean)"""
    profile = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", '{_spark_type(c)}' AS type, count({c}) AS non_null_count, "
        "count(*) AS row_count FROM featured"
        for c in frame
    )
    return {
        "clean_sales": _with(CLEAN, "SELECT * FROM clean"),
        "large_order_ids": _with(
            CLEAN.replace(
                "TRY_CAST(order_id AS BIGINT)", f"{LARGE_ID} + TRY_CAST(order_id AS BIGINT) // 2"
            ),
            "SELECT count(*) AS row_count, count(DISTINCT order_id) AS orders, min(order_id) AS lowest, "
            "max(order_id) AS highest FROM clean",
        ),
        "clean_retention": _with(CLEAN, retention),
        "features": _with(
            f"{SALES}, {_features('sales')}", "SELECT * EXCLUDE (product_brand) FROM featured"
        ),
        "schema_violations": counted(rules),
        "schema_violations_minimal": counted(minimal),
        "violating_rows": _with(RAW, listed),
        "quality_gates": gates(CLEAN, "clean"),
        "quality_gates_unclean": gates(RAW, "raw", "TRY_CAST({0} AS DOUBLE)"),
        "dq_audit": _with(PROCESSED, audit),
        "column_profile": _with(PROFILED, profile),
    }


def _kpi_oracles() -> dict[str, str]:
    whole = _cte(SALES, "t", f"{TOTALS} FROM sales")
    sliced = _cte(SALES, "t", f"{TOTALS} FROM sales WHERE {SLICE_CONDITION}")
    kpi_rows = [
        ("total_revenue", "round(net, 6)"),
        ("total_orders", "orders"),
        ("total_units", "trunc(units)"),
        ("avg_ticket", f"round({_ratio('net', 'orders')}, 6)"),
        ("avg_rating", "rating"),
        ("north_star_nrr", f"round({_ratio('net', 'gross')}, 6)"),
    ]
    impact = f"""SELECT net AS total_revenue, gross AS gross_revenue,
    gross - net AS discount_leakage, {_ratio("net", "gross")} AS retained_ratio,
    (gross - net) * 0.1::DOUBLE AS expected_uplift FROM t"""
    summary_rows = [
        ("north_star_net_revenue_retained", _ratio("net", "gross")),
        ("total_revenue", "net"),
        ("gross_revenue", "gross"),
        ("discount_leakage", "gross - net"),
        ("expected_uplift_5pct_recovery", "(gross - net) * 0.05::DOUBLE"),
    ]
    metrics = f"""SELECT '1.0.0' AS metrics_version, '1.0.0' AS contract_version,
    'unknown' AS pipeline_version, '{GENERATED_AT.isoformat()}' AS generated_at_utc, r AS raw_row_count, c AS clean_row_count,
    r - c AS rows_dropped, coalesce(CAST(c AS DOUBLE) / nullif(r, 0), 0) AS row_retention_rate,
    net AS total_revenue, gross AS gross_revenue, gross - net AS discount_leakage,
    {_ratio("net", "gross")} AS north_star_nrr, orders AS unique_orders,
    categories AS unique_categories, strftime(first_day, '%Y-%m-%d') AS period_start,
    strftime(last_day, '%Y-%m-%d') AS period_end
    FROM (SELECT count(*) AS r FROM raw) CROSS JOIN (SELECT count(*) AS c FROM clean)
    CROSS JOIN ({TOTALS}, count(DISTINCT product_category) AS categories,
        min(order_date) AS first_day, max(order_date) AS last_day FROM featured)"""
    share = f"""SELECT slice_revenue, slice_orders,
    {_ratio("slice_revenue", "revenue")} * 100 AS revenue_share_pct,
    {_ratio("CAST(slice_orders AS DOUBLE)", "orders")} * 100 AS order_share_pct
    FROM (SELECT {_money("total_revenue", SLICE_CONDITION)} AS slice_revenue,
        {_money("total_revenue")} AS revenue, count(DISTINCT order_id) AS orders,
        count(DISTINCT order_id) FILTER (WHERE {SLICE_CONDITION}) AS slice_orders FROM sales)"""
    return {
        "kpi_record": _with(whole, KPI_RECORD),
        "kpi_summary": _with(whole, _long("metric", kpi_rows, "t")),
        "business_impact": _with(whole, impact),
        "executive_summary": _with(whole, _long("metric", summary_rows, "t")),
        "product_metrics": _with(PROCESSED, metrics),
        "summary_metrics": _with(
            whole,
            f"""SELECT net AS total_revenue, gross AS gross_revenue,
    gross - net AS discount_leakage, {_ratio("net", "gross")} AS north_star_nrr,
    orders AS total_orders, {_ratio("net", "orders")} AS avg_ticket FROM t""",
        ),
        "slice_kpis": _with(sliced, KPI_RECORD),
        "slice_share": _with(SALES, share),
        "slice_cube": _with(sliced, f"SELECT * FROM ({KPI_RECORD}) CROSS JOIN ({share})"),
        "slice_rows": _with(
            SALES,
            f"""SELECT order_id, order_date, total_revenue, product_category, customer_region,
    payment_method FROM sales WHERE {SLICE_CONDITION}""",
        ),
        "dimension_values": _with(
            SALES,
            "SELECT DISTINCT payment_method FROM sales WHERE payment_method IS NOT NULL",
        ),
        "date_bounds": _with(
            SALES,
            "SELECT min(order_date) AS first_order_date, max(order_date) AS last_order_date "
            "FROM sales",
        ),
    }


def _report_oracles() -> dict[str, str]:
    def tickets(dimension):
        return _with(
            SALES,
            f"""SELECT {dimension}, {_money("total_revenue")} AS total_revenue,
    count(DISTINCT order_id) AS total_orders, {_mean_money("total_revenue")} AS avg_ticket
    FROM sales WHERE {dimension} IS NOT NULL GROUP BY {dimension} ORDER BY 2 DESC, 1""",
        )

    def revenue(dimension):
        return _with(
            SALES,
            f"SELECT {dimension}, {_money('total_revenue')} AS total_revenue FROM sales "
            f"WHERE {dimension} IS NOT NULL GROUP BY {dimension}",
        )

    measures = f"""count(*) AS row_count, {_money("total_revenue")} AS total_revenue,
    {_money("gross_revenue")} AS gross_revenue, {_money("discount_value")} AS discount_value,
    {_money("quantity_sold")} AS total_units, {_mean_money("total_revenue")} AS avg_ticket,
    round(avg(rating), 6) AS avg_rating, count(DISTINCT order_id) AS total_orders FROM sales"""
    dimensions = ["product_category", "customer_region", "payment_method"]
    bundle = "\nUNION ALL\n".join(
        f"SELECT '{d}' AS dimension, {d} AS key, {measures} WHERE {d} IS NOT NULL GROUP BY {d}"
        for d in dimensions
    )
    bundle += f"\nUNION ALL\nSELECT 'overall' AS dimension, NULL AS key, {measures}"
    leaks = _cte(
        SALES,
        "leaks",
        f"""SELECT product_category, {_money("gross_revenue")} AS gross_revenue,
    {_money("total_revenue")} AS total_revenue, {_money("discount_value")} AS discount_value
    FROM sales WHERE product_category IS NOT NULL GROUP BY product_category""",
    )
    filled = _cte(
        SALES,
        "m",
        f"""SELECT last_day(order_date) AS me, {_money("total_revenue")} AS r FROM sales
    WHERE order_date IS NOT NULL GROUP BY 1""",
    )
    filled = _cte(
        filled,
        "calendar",
        """SELECT last_day(CAST(unnest(generate_series(date_trunc('month', a),
        date_trunc('month', z), INTERVAL 1 MONTH)) AS DATE)) AS month_end
    FROM (SELECT min(me) AS a, max(me) AS z FROM m)""",
    )
    breakdown_rates = ", ".join(f"('{c}', {rate}::DOUBLE)" for c, rate in OVERRIDES.items())
    rates = f"rates(product_category, rate) AS (VALUES {breakdown_rates})"
    breakdown = _cte(
        f"{leaks}, {rates}",
        "b",
        """SELECT product_category, gross_revenue, total_revenue,
    discount_value AS discount_leakage,
    CAST(least(greatest(coalesce(rate, 0), 0), 1) AS DOUBLE) AS recovery_rate
    FROM leaks LEFT JOIN rates USING (product_category)""",
    )
    uplift = "discount_leakage * recovery_rate"
    scenario = _cte(
        f"{leaks}, {rates}",
        "b",
        f"""SELECT product_category, gross_revenue, total_revenue,
    discount_value AS discount_leakage,
    CAST(least(greatest(coalesce(rate, {DEFAULT_RATE}), 0), 1) AS DOUBLE) AS recovery_rate
    FROM leaks LEFT JOIN rates USING (product_category)""",
    )
    return {
        "executive_bundle": _bundle(SALES),
        "slice_bundle": _bundle(f"{SALES}, part AS (SELECT * FROM sales WHERE {SLICE_CONDITION})", "part"),
        "scenario_run": _with(
            scenario,
            f"""SELECT *, round({uplift}, 6) AS expected_uplift,
    round(total_revenue + {uplift}, 6) AS simulated_revenue FROM b""",
        ),
        "category_performance": _with(
            SALES,
            f"""SELECT product_category, {_money("total_revenue")} AS total_revenue,
    {_money("quantity_sold")} AS total_units, count(DISTINCT order_id) AS total_orders,
    round(avg(rating), 6) AS avg_rating, {_money("discount_value")} AS discount_value
    FROM sales WHERE product_category IS NOT NULL GROUP BY product_category
    ORDER BY 2 DESC, 1""",
        ),
        "regional_performance": tickets("customer_region"),
        "payment_performance": tickets("payment_method"),
        "executive_tables": _with(SALES, bundle),
        "slice_cube_totals": _with(
            _cte(SALES, "part", f"SELECT * FROM sales WHERE {SLICE_CONDITION}"),
            bundle.replace("FROM sales", "FROM part"),
        ),
        "revenue_by_region": revenue("customer_region"),
        "revenue_by_payment": revenue("payment_method"),
        "leakage_by_category": _with(leaks, "SELECT * FROM leaks ORDER BY discount_value DESC"),
        "monthly_trend": _with(
            SALES,
            f"""SELECT CAST(date_trunc('month', order_date) AS DATE) AS year_month,
    {_money("total_revenue")} AS total_revenue FROM sales WHERE order_date IS NOT NULL
    GROUP BY 1 ORDER BY 1""",
        ),
        "monthly_trend_filled": _with(
            filled,
            "SELECT month_end, coalesce(r, 0) AS total_revenue FROM calendar "
            "LEFT JOIN m ON month_end = me",
        ),
        "top_discount_opportunities": _with(
            leaks,
            f"""SELECT product_category, total_revenue, discount_value,
    {_ratio("discount_value", "total_revenue")} AS discount_to_revenue_ratio
    FROM leaks ORDER BY discount_value DESC, product_category LIMIT 4""",
        ),
        "top_categories": _with(
            SALES,
            f"""SELECT product_brand AS product_category, {_money("total_revenue")} AS total_revenue
    FROM sales WHERE product_brand IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
        ),
        "payment_ticket_ranking": _with(
            SALES,
            f"""SELECT payment_method, {_mean_money("total_revenue")} AS avg_ticket,
    {_money("total_revenue")} AS total_revenue FROM sales WHERE payment_method IS NOT NULL
    GROUP BY 1""",
        ),
        "recommendations": _recommendations(0.9),
        "recommendations_low_nrr": _recommendations(0.96),
        "recommendations_no_risk": _with(
            SALES,
            """SELECT 'low' AS priority, 'No material risk detected' AS decision_rule,
    'Maintain current policy and continue weekly KPI monitoring.' AS recommended_action,
    0.0::DOUBLE AS expected_impact_usd, 'Analytics' AS owner_area
FROM sales HAVING count(*) > 0""",
        ),
        "scenario_rates": _with(
            f"{SALES}, {rates}",
            f"""SELECT product_category,
    CAST(coalesce(rate, {DEFAULT_RATE}) AS DOUBLE) AS recovery_rate
    FROM (SELECT DISTINCT product_category FROM sales WHERE product_category IS NOT NULL)
    LEFT JOIN rates USING (product_category)""",
        ),
        "scenario_breakdown": _with(
            breakdown,
            f"""SELECT *, round({uplift}, 6) AS expected_uplift,
    round(total_revenue + {uplift}, 6) AS simulated_revenue FROM b""",
        ),
        "scenario_display": _with(
            breakdown,
            f"""SELECT product_category, discount_leakage, recovery_rate * 100 AS recovery_rate,
    round({uplift}, 6) AS expected_uplift,
    round(total_revenue + {uplift}, 6) AS simulated_revenue FROM b""",
        ),
        "scenario_totals": _with(
            breakdown,
            f"""SELECT round(n, 4) AS baseline_revenue, round(g, 4) AS gross_revenue,
    round(round({_ratio("n", "g")}, 4), 6) AS baseline_nrr, round(n + u, 4) AS simulated_revenue,
    round(round({_ratio("(n + u)", "g")}, 4), 6) AS simulated_nrr, round(u, 4) AS total_uplift
    FROM (SELECT sum(total_revenue) AS n, sum(gross_revenue) AS g, sum({uplift}) AS u FROM b)""",
        ),
    }


def _bundle(base: str, source: str = "sales") -> str:
    """The six report tables as rows of table, key, metric and value."""

    def long(table: str, key: str, measures: dict[str, str], tail: str) -> list[str]:
        return [
            f"SELECT '{table}' AS \"table\", CAST({key} AS VARCHAR) AS key, '{name}' AS metric, "
            f"round(CAST({value} AS DOUBLE), 6) AS value FROM {tail}"
            for name, value in measures.items()
        ]

    net, orders = _money("total_revenue"), "count(DISTINCT order_id)"
    ticket = {"total_revenue": net, "total_orders": orders, "avg_ticket": _mean_money("total_revenue")}
    category = {
        "total_revenue": net,
        "total_units": _money("quantity_sold"),
        "total_orders": orders,
        "avg_rating": "avg(rating)",
        "discount_value": _money("discount_value"),
    }
    kpis = {
        "total_revenue": "net",
        "total_orders": "orders",
        "total_units": "trunc(units)",
        "avg_ticket": _ratio("net", "orders"),
        "avg_rating": "rating",
        "north_star_nrr": _ratio("net", "gross"),
    }
    nulls = " + ".join(f"(count(*) - count({c}))" for c in BUNDLE_COLUMNS)
    audit = {
        "row_count": "count(*)",
        "null_values": nulls,
        "duplicated_order_id": f"count(*) - {orders}",
        "discount_out_of_range": "count(*) FILTER (WHERE NOT discount_percent BETWEEN 0 AND 100)",
        "rating_out_of_range": "count(*) FILTER (WHERE NOT rating BETWEEN 0 AND 5)",
    }
    base = _cte(base, "t", f"{TOTALS} FROM {source}")
    base = _cte(
        base,
        "m",
        f"""SELECT last_day(order_date) AS me, {net} AS r FROM {source}
    WHERE order_date IS NOT NULL GROUP BY 1""",
    )
    base = _cte(
        base,
        "calendar",
        """SELECT last_day(CAST(unnest(generate_series(date_trunc('month', a),
        date_trunc('month', z), INTERVAL 1 MONTH)) AS DATE)) AS month_end
    FROM (SELECT min(me) AS a, max(me) AS z FROM m)""",
    )
    rows = []
    for name, value in kpis.items():
        rows += long("kpi_summary", f"'{name}'", {"value": value}, "t")
    for table, key, measures in (
        ("category_performance", "product_category", category),
        ("regional_performance", "customer_region", ticket),
        ("payment_performance", "payment_method", ticket),
    ):
        rows += long(table, key, measures, f"{source} WHERE {key} IS NOT NULL GROUP BY {key}")
    rows += long(
        "monthly_trend", "month_end", {"total_revenue": "coalesce(r, 0)"},
        "calendar LEFT JOIN m ON month_end = me",
    )
    for name, value in audit.items():
        rows += long("data_quality_audit", f"'{name}'", {"value": value}, source)
    return _with(base, "\nUNION ALL\n".join(rows))


def _recommendations(floor: float) -> str:
    base = _cte(
        PROCESSED,
        "t",
        f"SELECT {_money('total_revenue')} AS net, {_money('gross_revenue')} AS gross FROM featured",
    )
    base = _cte(
        base,
        "c",
        f"""SELECT product_category, {_money("discount_value")} AS leak FROM featured
    WHERE product_category IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
    )
    base = _cte(
        base,
        "p",
        f"""SELECT payment_method, {_mean_money("total_revenue")} AS ticket FROM featured
    WHERE payment_method IS NOT NULL GROUP BY 1 ORDER BY 2, 1 LIMIT 1""",
    )
    return _with(
        base,
        f"""SELECT 'high' AS priority, 'NRR below 90%' AS decision_rule,
    'Reduce broad discount campaigns and enforce category-level caps.' AS recommended_action,
    (gross - net) * 0.05::DOUBLE AS expected_impact_usd, 'Revenue Operations' AS owner_area
FROM t WHERE {_ratio("net", "gross")} < {floor}
UNION ALL
SELECT 'high', 'Highest leakage category is ' || product_category,
    'Run a 2-week pricing policy test in ' || product_category
      || ' with tighter discount thresholds.',
    leak * 0.05::DOUBLE, 'Category Management' FROM c
UNION ALL
SELECT 'medium', 'Lowest average ticket on ' || payment_method,
    'Adjust promotion mechanics for ' || payment_method || ' to increase ticket size.',
    net * 0.01::DOUBLE, 'Commercial Strategy' FROM p CROSS JOIN t""",
    )


def _scored(key: str, moment: str) -> str:
    base = _cte(
        SALES,
        "profile",
        f"""SELECT {key}, {moment} AS order_date, avg(discount_percent) AS mean_discount,
    {_money("gross_revenue")} AS gross_revenue FROM sales
    WHERE order_date IS NOT NULL AND {key} IS NOT NULL GROUP BY 1, 2""",
    )
    base = _cte(
        base,
        "baseline",
        f"""SELECT *, avg(mean_discount) OVER w AS m,
    coalesce(stddev_samp(mean_discount) OVER w, 0) AS s, count(mean_discount) OVER w AS n
    FROM profile WINDOW w AS (PARTITION BY {key})""",
    )
    return _cte(
        base,
        "scored",
        """SELECT *, coalesce((mean_discount - m) / nullif(s, 0), 0) AS z,
    gross_revenue * (greatest(mean_discount - m, 0) / 100) AS leak FROM baseline""",
    )


SHOWN = """round(mean_discount, 6) AS avg_discount_percent, round(m, 6) AS baseline_mean,
    round(s, 6) AS baseline_std, round(z, 6) AS z_score, gross_revenue,
    round(leak, 4) AS estimated_leakage_usd"""
SEVERITY = "CASE WHEN z <= 3.5 THEN 'medium' WHEN z <= 5 THEN 'high' ELSE 'critical' END"
FIRING = "n >= 5 AND z >= 2.5"


def _alert_oracles() -> dict[str, str]:
    by_month = "CAST(date_trunc('month', order_date) AS TIMESTAMP)"
    category = _scored("product_category", "order_date")
    region = _scored("customer_region", "order_date")
    brand = _scored("product_brand", by_month)

    def alerts(base, key, date="order_date"):
        return _with(
            base,
            f"SELECT {date} AS order_date, {key}, {SHOWN}, {SEVERITY} AS severity "
            f"FROM scored WHERE {FIRING}",
        )

    per_severity = ", ".join(
        f"count(*) FILTER (WHERE {SEVERITY} = '{name}') AS {name}"
        for name in ("medium", "high", "critical")
    )
    return {
        "discount_profile": _with(
            category,
            "SELECT product_category, order_date, round(mean_discount, 6) AS "
            "avg_discount_percent, gross_revenue FROM profile",
        ),
        "scored_profile": _with(
            _scored("customer_region", by_month),
            f"SELECT customer_region, order_date, {SHOWN}, n AS obs_count FROM scored",
        ),
        "scored_profile_day": _with(
            _scored("payment_method", "CAST(date_trunc('day', order_date) AS TIMESTAMP)"),
            f"SELECT payment_method, order_date, {SHOWN}, n AS obs_count FROM scored",
        ),
        "discount_spikes_daily": alerts(category, "product_category"),
        "discount_spikes_region": alerts(region, "customer_region"),
        "discount_spikes_brand_month": alerts(brand, "product_brand"),
        "alert_export_rows": alerts(
            category, "product_category", "strftime(order_date, '%Y-%m-%d')"
        ),
        "alert_severity_counts": _with(
            region,
            f"SELECT {SEVERITY} AS severity, count(*) AS alerts FROM scored "
            f"WHERE {FIRING} GROUP BY 1",
        ),
        "alert_run_status": _with(
            region,
            "SELECT CASE WHEN count(*) = 0 THEN 'ok' ELSE 'attention' END AS status, "
            f"count(*) AS alerts_count, {per_severity} FROM scored WHERE {FIRING}",
        ),
    }


def _profile_oracles() -> dict[str, str]:
    def quartile(column, q):
        return f"quantile_cont(CAST({column} AS DOUBLE), {q}::DOUBLE)"

    describe = "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 7) AS mean,
    round(stddev_samp({c}), 6) AS std, round(CAST(min({c}) AS DOUBLE), 6) AS "min",
    round({quartile(c, 0.25)}, 6) AS p25, round({quartile(c, 0.5)}, 6) AS p50,
    round({quartile(c, 0.75)}, 6) AS p75, round(CAST(max({c}) AS DOUBLE), 6) AS "max"
FROM featured"""
        for c in PROFILE_COLUMNS
    )
    micros = "epoch_us(order_date)"
    moments = f"""SELECT 'order_date' AS "column", count(order_date) AS "count",
    make_timestamp(CAST(sum(CAST({micros} AS HUGEINT)) // count(order_date) AS BIGINT)) AS mean,
    min(order_date) AS "min",
    make_timestamp(CAST({quartile(micros, 0.25)} AS BIGINT)) AS p25,
    make_timestamp(CAST({quartile(micros, 0.5)} AS BIGINT)) AS p50,
    make_timestamp(CAST({quartile(micros, 0.75)} AS BIGINT)) AS p75,
    max(order_date) AS "max" FROM sales"""
    pairs = ",\n".join(
        f"round(corr({a}, {b}), 6) AS c{i}_{j}"
        for i, a in enumerate(PROFILE_COLUMNS)
        for j, b in enumerate(PROFILE_COLUMNS)
        if i <= j
    )
    matrix = "\nUNION ALL\n".join(
        f"SELECT '{a}' AS x, '{b}' AS y, c{min(i, j)}_{max(i, j)} AS r FROM pairs"
        for i, a in enumerate(PROFILE_COLUMNS)
        for j, b in enumerate(PROFILE_COLUMNS)
    )
    limits = f"""SELECT min(price) AS lo, max(price) AS hi, count(price) AS total,
    stddev_samp(price) * power(count(price), -0.2) AS bw,
    {HISTOGRAM_BINS} AS bins FROM sales"""
    width = f"(2 * ({quartile('price', 0.75)} - {quartile('price', 0.25)}) / power(count(price), 1.0 / 3))"
    auto = f"ceil(greatest((max(price) - min(price)) / {width}, log2(count(price)) + 1))"

    def placed(limits):
        binned = _cte(
            _cte(SALES, "limits", limits),
            "bins",
            """SELECT CAST(least(1 + floor((price - lo) / (hi - lo) * bins), bins) AS BIGINT)
    AS bin, lo, hi, total, bw, bins, count(*) AS n FROM sales CROSS JOIN limits
    WHERE price IS NOT NULL GROUP BY ALL""",
        )
        grid = _cte(
            binned,
            "grid",
            f"""SELECT *, lo + (hi - lo) * (bin - 0.5) / bins AS centre,
    unnest(generate_series(0, {DENSITY_POINTS - 1})) AS point FROM bins""",
        )
        grid = _cte(
            grid,
            "placed",
            f"SELECT *, lo + (hi - lo) / {DENSITY_POINTS - 1} * point AS x FROM grid",
        )
        return _with(
            binned,
            """SELECT bin, round(lo + (hi - lo) / bins * (bin - 1), 6) AS low,
    round(lo + (hi - lo) / bins * bin, 6) AS high, n FROM bins""",
        ), _with(
            grid,
            """SELECT round(x, 6) AS x,
    round(sum(n * exp(-0.5 * ((x - centre) / bw) * ((x - centre) / bw))
        / (total * bw * sqrt(2 * pi()))), 9) AS density FROM placed GROUP BY point, x""",
        )

    fixed, found = placed(limits), placed(limits.replace(f"{HISTOGRAM_BINS} AS bins", f"{auto} AS bins"))
    return {
        "numeric_describe": _with(PROFILED, describe),
        "timestamp_describe": _with(SALES, moments),
        "correlation_matrix": _with(
            _cte(PROFILED, "pairs", f"SELECT {pairs} FROM featured"), matrix
        ),
        "price_histogram": fixed[0],
        "price_density": fixed[1],
        "price_histogram_auto": found[0],
        "price_density_auto": found[1],
    }


def all_oracles() -> dict[str, str]:
    return {
        **_quality_oracles(),
        **_kpi_oracles(),
        **_report_oracles(),
        **_alert_oracles(),
        **_profile_oracles(),
    }
