"""Queries that answer with tables: months, products, countries, outliers, correlations, rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.catalog.registry import query, union
from tillroll.catalog.sql import FENCES, long_measures
from tillroll.functions.ranks import hash_sample
from tillroll.operators import explore, outliers, relations, sales
from tillroll.operators.relations import SAMPLE_ROWS
from tillroll.plans import exploration


@query(
    "invoice_monthly_volume",
    "YearMonth:s invoice_count:l transaction_count:l total_quantity:l",
    """SELECT strftime(InvoiceDate, '%Y-%m') AS "YearMonth", count(DISTINCT InvoiceNo) AS invoice_count,
              count(InvoiceNo) AS transaction_count, sum(Quantity) AS total_quantity FROM t_raw GROUP BY ALL""",
)
def invoice_monthly_volume(t):
    return sales.invoice_monthly_volume(t.raw)


@query(
    "monthly_transaction_volume",
    "YearMonth:s transaction_lines:l unique_invoices:l unique_customers:l total_quantity:l",
    """SELECT YearMonth AS "YearMonth", count(InvoiceNo) AS transaction_lines, count(DISTINCT InvoiceNo) AS unique_invoices,
              count(DISTINCT CustomerID) AS unique_customers, sum(Quantity) AS total_quantity
       FROM t_full GROUP BY YearMonth""",
)
def monthly_transaction_volume(t):
    return sales.monthly_transaction_volume(t.full)


@query(
    "monthly_revenue",
    "YearMonth:s revenue:2 avg_order_value:6 median_order_value:4 lines:l unique_invoices:l revenue_per_invoice:6",
    """SELECT YearMonth AS "YearMonth", sum(TotalAmount) AS revenue, avg(TotalAmount) AS avg_order_value,
              quantile_cont(TotalAmount, 0.5) AS median_order_value, count(InvoiceNo) AS lines,
              count(DISTINCT InvoiceNo) AS unique_invoices, sum(TotalAmount) / count(DISTINCT InvoiceNo) AS revenue_per_invoice
       FROM t_pos GROUP BY YearMonth""",
)
def monthly_revenue(t):
    return sales.monthly_revenue(t.positive)


@query(
    "transactions_by_hour",
    "Hour:i lines:l unique_invoices:l",
    """SELECT "Hour", count(InvoiceNo) AS lines, count(DISTINCT InvoiceNo) AS unique_invoices
       FROM t_full GROUP BY "Hour" """,
)
def transactions_by_hour(t):
    return sales.transactions_by_hour(t.full)


@query(
    "events_by_hour",
    "Hour:i lines:l unique_invoices:l",
    """SELECT hour(ts) AS "Hour", count(*) AS lines, count(DISTINCT user_id) AS unique_invoices
       FROM events GROUP BY ALL""",
)
def events_by_hour(t):
    """The hour profile at minute precision, over the events table (visits of users)."""
    events = t.table("events").select(
        F.col("ts").cast("timestamp").alias("InvoiceDate"), F.col("user_id").alias("InvoiceNo")
    )
    return sales.transactions_by_hour(events)


@query(
    "transactions_by_weekday",
    "DayOfWeek:i DayOfWeekName:s lines:l unique_invoices:l",
    """SELECT DayOfWeek AS "DayOfWeek", DayOfWeekName AS "DayOfWeekName", count(InvoiceNo) AS lines,
              count(DISTINCT InvoiceNo) AS unique_invoices FROM t_full GROUP BY ALL""",
)
def transactions_by_weekday(t):
    return sales.transactions_by_weekday(t.full)


@query("rows_per_month", "YearMonth:s rows:l", """SELECT YearMonth AS "YearMonth", count(*) AS rows FROM t_full GROUP BY ALL""")
def rows_per_month(t):
    return sales.rows_per_month(t.full)


@query(
    "cancellation_split",
    "IsCancellation:b lines:l negative_quantity:l",
    """SELECT IsCancellation AS "IsCancellation", count(*) AS lines, count(*) FILTER (WHERE Quantity < 0) AS negative_quantity
       FROM t_full GROUP BY IsCancellation""",
)
def cancellation_split(t):
    return sales.cancellation_split(t.full)


_PRODUCTS = """SELECT StockCode, Description, sum(Quantity) AS total_quantity, count(InvoiceNo) AS lines,
                      sum(TotalAmount) AS revenue, sum(TotalAmount) / nullif(sum(Quantity), 0) AS avg_unit_price
               FROM t_pos GROUP BY StockCode, Description"""
_LABEL = "substring(coalesce(Description, '(no description)'), 1, 60) AS \"Description\""


@query(
    "top_products_quantity",
    "StockCode:s Description:s total_quantity:l lines:l revenue:2",
    f"""SELECT * EXCLUDE (Description), {_LABEL} FROM ({_PRODUCTS})
        ORDER BY total_quantity DESC, StockCode NULLS FIRST, Description NULLS FIRST LIMIT 20""",
)
def top_products_quantity(t):
    return sales.top_products_by_quantity(t.positive, 20)


@query(
    "top_products_revenue",
    "StockCode:s Description:s total_quantity:l lines:l revenue:2 avg_unit_price:6",
    f"""SELECT * EXCLUDE (Description), {_LABEL} FROM ({_PRODUCTS})
        ORDER BY revenue DESC, StockCode NULLS FIRST, Description NULLS FIRST LIMIT 20""",
)
def top_products_revenue(t):
    return sales.top_products_by_revenue(t.positive, 20)


_COUNTRIES = """SELECT Country, count(InvoiceNo) AS lines, count(DISTINCT InvoiceNo) AS unique_invoices,
                       count(DISTINCT CustomerID) AS unique_customers, count(DISTINCT StockCode) AS unique_products,
                       100.0 * count(InvoiceNo) / (SELECT count(*) FROM t_full) AS lines_pct
                FROM t_full GROUP BY Country"""


@query(
    "top_countries",
    "Country:s lines:l unique_invoices:l unique_customers:l unique_products:l lines_pct:4",
    f'SELECT * FROM ({_COUNTRIES}) ORDER BY lines DESC, "Country" LIMIT 20',
)
def top_countries(t):
    return sales.top_countries_by_transactions(t.full, 20)


_COUNTRY_REVENUE = """SELECT Country, sum(TotalAmount) AS revenue, count(InvoiceNo) AS lines, avg(UnitPrice) AS avg_unit_price,
                             avg(TotalAmount) AS avg_total_amount, count(DISTINCT CustomerID) AS unique_customers,
                             100.0 * sum(TotalAmount) / (SELECT sum(TotalAmount) FROM t_pos) AS revenue_pct
                      FROM t_pos GROUP BY Country"""


@query(
    "country_revenue",
    "Country:s revenue:2 lines:l avg_unit_price:6 avg_total_amount:6 unique_customers:l revenue_pct:4",
    f'SELECT * FROM ({_COUNTRY_REVENUE}) ORDER BY revenue DESC, "Country" LIMIT 20',
)
def country_revenue(t):
    return sales.country_revenue(t.positive, 20)


@query(
    "country_distribution",
    "Country:s transaction_count:l percentage:4",
    """SELECT Country AS "Country", count(*) AS transaction_count,
              100.0 * count(*) / (SELECT count(*) FROM t_raw) AS percentage FROM t_raw GROUP BY Country""",
)
def country_distribution(t):
    return sales.country_distribution(t.raw)


@query(
    "capstone_monthly",
    "YearMonth:s revenue:2 transactions:l items_sold:l unique_customers:l",
    """SELECT YearMonth AS "YearMonth", sum(TotalAmount) AS revenue, count(DISTINCT InvoiceNo) AS transactions,
              sum(Quantity) AS items_sold, count(DISTINCT CustomerID) AS unique_customers FROM t_sales GROUP BY YearMonth""",
)
def capstone_monthly(t):
    return sales.monthly_sales(t.sales)


@query(
    "capstone_top_products",
    "StockCode:s Description:s revenue:2 quantity_sold:l transactions:l",
    """SELECT StockCode, Description, sum(TotalAmount) AS revenue, sum(Quantity) AS quantity_sold,
              count(DISTINCT InvoiceNo) AS transactions FROM t_sales
       WHERE StockCode IS NOT NULL AND Description IS NOT NULL
       GROUP BY StockCode, Description ORDER BY revenue DESC, StockCode, Description LIMIT 10""",
)
def capstone_top_products(t):
    return sales.best_products(t.sales, 10)


@query(
    "capstone_top_countries",
    "Country:s transactions:l revenue:2 unique_customers:l",
    """SELECT Country, count(DISTINCT InvoiceNo) AS transactions, sum(TotalAmount) AS revenue,
              count(DISTINCT CustomerID) AS unique_customers FROM t_sales
       WHERE Country IS NOT NULL GROUP BY Country ORDER BY transactions DESC, Country LIMIT 10""",
)
def capstone_top_countries(t):
    return sales.busiest_countries(t.sales, 10)


@query(
    "argmax_rows",
    "table:s best:s best_value:2 worst:s worst_value:2",
    """SELECT 'month' AS "table", arg_min(k, (-v, k)) AS best, max(v) AS best_value, arg_min(k, (v, k)) AS worst, min(v) AS worst_value
       FROM (SELECT YearMonth AS k, sum(TotalAmount) AS v FROM t_pos GROUP BY ALL)
       UNION ALL
       SELECT 'hour', CAST(arg_min(k, (-v, k)) AS VARCHAR), max(v), CAST(arg_min(k, (v, k)) AS VARCHAR), min(v)
       FROM (SELECT "Hour" AS k, count(InvoiceNo) AS v FROM t_full GROUP BY ALL)""",
)
def argmax_rows(t):
    month = sales.best_and_worst(sales.monthly_sales(t.positive), "YearMonth", "revenue")
    hour = sales.best_and_worst(sales.transactions_by_hour(t.full), "Hour", "lines")
    parts = {"month": month, "hour": hour}
    texts = {
        k: p.select(
            F.col("best").cast("string").alias("best"),
            F.col("best_value").cast("double").alias("best_value"),
            F.col("worst").cast("string").alias("worst"),
            F.col("worst_value").cast("double").alias("worst_value"),
        )
        for k, p in parts.items()
    }
    return union(texts, "table")


def _overlap(left: str, right: str) -> str:
    return f"""SELECT count(a.k) AS in_first, count(b.k) AS in_second, count(*) FILTER (WHERE a.k = b.k) AS in_both,
                      count(*) FILTER (WHERE b.k IS NULL) AS only_first, count(*) FILTER (WHERE a.k IS NULL) AS only_second
               FROM (SELECT DISTINCT k FROM ({left})) a FULL JOIN (SELECT DISTINCT k FROM ({right})) b ON a.k = b.k"""


@query(
    "rank_overlap_products",
    "in_first:l in_second:l in_both:l only_first:l only_second:l",
    _overlap(
        f"SELECT StockCode AS k FROM ({_PRODUCTS}) ORDER BY total_quantity DESC, StockCode, Description NULLS FIRST LIMIT 10",
        f"SELECT StockCode AS k FROM ({_PRODUCTS}) ORDER BY revenue DESC, StockCode, Description NULLS FIRST LIMIT 10",
    ),
)
def rank_overlap_products(t):
    return exploration.product_overlap(t.positive, 10)


@query(
    "rank_overlap_countries",
    "in_first:l in_second:l in_both:l only_first:l only_second:l",
    _overlap(
        f"SELECT Country AS k FROM ({_COUNTRIES}) ORDER BY lines DESC, Country LIMIT 10",
        f"SELECT Country AS k FROM ({_COUNTRY_REVENUE}) ORDER BY revenue DESC, Country LIMIT 10",
    ),
)
def rank_overlap_countries(t):
    return exploration.country_overlap(t.full, t.positive, 10)


@query(
    "revenue_concentration",
    "products:l top_1_pct_share:4 top_10_pct_share:4 top_20_pct_share:4",
    """SELECT max(n) AS products,
              CASE WHEN max(n) >= 100 THEN max(CASE WHEN i = floor(n * CAST(0.01 AS DOUBLE)) THEN share END) END AS top_1_pct_share,
              max(CASE WHEN i = floor(n * CAST(0.10 AS DOUBLE)) THEN share END) AS top_10_pct_share,
              max(CASE WHEN i = floor(n * CAST(0.20 AS DOUBLE)) THEN share END) AS top_20_pct_share
       FROM (SELECT count(*) OVER () AS n, row_number() OVER w - 1 AS i,
                    100.0 * sum(revenue) OVER w / sum(revenue) OVER () AS share
             FROM t_products WINDOW w AS (ORDER BY revenue DESC, StockCode ROWS UNBOUNDED PRECEDING))""",
)
def revenue_concentration(t):
    return sales.revenue_concentration(t.positive)


@query(
    "gini",
    "n:l gini:6",
    """SELECT max(n) AS n, 1 - 2 * sum((y + coalesce(before, 0)) / 2 / n) AS gini
       FROM (SELECT *, lag(y) OVER (ORDER BY i) AS before
             FROM (SELECT count(*) OVER () AS n, row_number() OVER w AS i, sum(revenue) OVER w / sum(revenue) OVER () AS y
                   FROM t_products WHERE revenue > 0
                   WINDOW w AS (ORDER BY revenue, StockCode ROWS UNBOUNDED PRECEDING)))""",
)
def gini(t):
    return sales.gini(sales.product_revenue(t.positive))


_STATS = {
    "count": "count(*)", "sum": "sum(value)", "mean": "avg(value)", "median": "quantile_cont(value, 0.5)",
    "std": "stddev_samp(value)", "min": "min(value)", "max": "max(value)", "q1": "quantile_cont(value, 0.25)",
    "q3": "quantile_cont(value, 0.75)", "iqr": "quantile_cont(value, 0.75) - quantile_cont(value, 0.25)",
    "p90": "quantile_cont(value, 0.9)", "p95": "quantile_cont(value, 0.95)", "p99": "quantile_cont(value, 0.99)",
}


@query(
    "amount_stats",
    "metric:s Quantity:4 UnitPrice:4 TotalAmount:4",
    " UNION ALL ".join(
        f"SELECT '{m}' AS metric, max(v) FILTER (WHERE c = 'Quantity') AS \"Quantity\", "
        f"max(v) FILTER (WHERE c = 'UnitPrice') AS \"UnitPrice\", max(v) FILTER (WHERE c = 'TotalAmount') AS \"TotalAmount\" "
        f"FROM (SELECT \"column\" AS c, {e} AS v FROM ({long_measures('t_pos')}) GROUP BY \"column\")"
        for m, e in _STATS.items()
    ),
)
def amount_stats(t):
    return explore.amount_stats(t.measures)


_BOUNDS = FENCES.format(long=long_measures("t_pos", positive=True))


@query(
    "iqr_bounds",
    "column:s q1:4 q3:4 iqr:4 lower_bound:4 upper_bound:4 median:4 mean:4 min:4 max:4 n:l",
    _BOUNDS,
)
def iqr_bounds(t):
    return outliers.iqr_bounds(t.measures)


_FULL_BOUNDS = FENCES.format(long=long_measures("t_valid", positive=True))


def _flag(column: str) -> str:
    return f"""coalesce({column} > 0 AND ({column} < (SELECT lower_bound FROM b WHERE "column" = '{column}')
               OR {column} > (SELECT upper_bound FROM b WHERE "column" = '{column}')), false)"""


_FLAGS = f"""WITH b AS ({_FULL_BOUNDS})
    SELECT *, {_flag("Quantity")} AS "Quantity_IsOutlier", {_flag("UnitPrice")} AS "UnitPrice_IsOutlier",
           {_flag("TotalAmount")} AS "TotalAmount_IsOutlier" FROM t_valid"""


@query(
    "iqr_flags",
    "InvoiceNo:s StockCode:s Quantity:l Quantity_IsOutlier:b UnitPrice_IsOutlier:b TotalAmount_IsOutlier:b",
    _FLAGS,
)
def iqr_flags(t):
    return outliers.flag_iqr_outliers(t.priced)


def _summary(bounds: str, table: str, base: str) -> str:
    counts = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {_flag(c)}) AS outlier_count, {base.format(c=c)} AS size FROM {table}"
        for c in ("Quantity", "UnitPrice", "TotalAmount")
    )
    return f"""WITH b AS ({bounds}) SELECT b.*, outlier_count, 100.0 * outlier_count / size AS outlier_pct
               FROM b JOIN ({counts}) k ON b."column" = k."column" """


_SUMMARY = (
    "column:s q1:4 q3:4 iqr:4 lower_bound:4 upper_bound:4 outlier_count:l outlier_pct:4 min:4 max:4 mean:4 median:4"
)


@query("outlier_summary", _SUMMARY, _summary(_FULL_BOUNDS, "t_valid", "count(*)"))
def outlier_summary(t):
    return outliers.outlier_summary(t.priced)


@query("iqr_outlier_summary", _SUMMARY, _summary(_BOUNDS, "t_pos", "count(*) FILTER (WHERE {c} > 0)"))
def iqr_outlier_summary(t):
    return outliers.outlier_summary(t.measures, pct_base="positive")


_IMPACT = """count(v) AS "count", avg(v) AS mean, quantile_cont(v, 0.5) AS median, stddev_samp(v) AS std,
             min(v) AS min, max(v) AS max, sum(v) AS sum"""


@query(
    "outlier_impact",
    "subset:s count:l mean:4 median:4 std:4 min:4 max:4 sum:2",
    f"""SELECT 'With outliers' AS subset, {_IMPACT} FROM (SELECT TotalAmount AS v FROM ({_FLAGS}))
        UNION ALL SELECT 'Without outliers', {_IMPACT}
        FROM (SELECT TotalAmount AS v FROM ({_FLAGS}) WHERE NOT "TotalAmount_IsOutlier")""",
)
def outlier_impact(t):
    return outliers.outlier_impact(outliers.flag_iqr_outliers(t.priced, ["TotalAmount"]), "TotalAmount")


_TAIL = {"P50": 0.5, "P75": 0.75, "P90": 0.9, "P95": 0.95, "P99": 0.99, "P99_5": 0.995, "P99_9": 0.999}


@query(
    "heavy_tail",
    "column:s mean:4 median:4 P50:4 P75:4 P90:4 P95:4 P99:4 P99_5:4 P99_9:4 p99_to_p50:6 max_to_p99:6",
    'SELECT *, "P50" AS median, "P99" / "P50" AS p99_to_p50, high / "P99" AS max_to_p99 FROM (SELECT "column", avg(value) AS mean, max(value) AS high, '
    + ", ".join(f'quantile_cont(value, {p}) AS "{n}"' for n, p in _TAIL.items())
    + f' FROM ({long_measures("t_pos", positive=True)}) GROUP BY "column")',
)
def heavy_tail(t):
    return outliers.heavy_tail(t.measures)


_MEASURES = ("Quantity", "UnitPrice", "TotalAmount")


@query(
    "correlation_matrix",
    "col1:s col2:s correlation:6",
    " UNION ALL ".join(
        f"SELECT '{a}' AS col1, '{b}' AS col2, corr({a}, {b}) AS correlation FROM t_pos" for a in _MEASURES for b in _MEASURES
    ),
)
def correlation_matrix(t):
    return relations.correlation_matrix(t.positive)


def _ranks(column: str) -> str:
    return f"rank() OVER (ORDER BY {column}) + (count(*) OVER (PARTITION BY {column}) - 1) / 2.0"


@query(
    "spearman",
    "col1:s col2:s correlation:6",
    " UNION ALL ".join(
        f"SELECT '{a}' AS col1, '{b}' AS col2, corr(a, b) AS correlation "
        f"FROM (SELECT {_ranks(a)} AS a, {_ranks(b)} AS b FROM t_pos)"
        for a, b in (("Quantity", "UnitPrice"), ("Quantity", "TotalAmount"), ("UnitPrice", "TotalAmount"))
    ),
)
def spearman(t):
    return relations.spearman(t.measures)


def _study(x: str, y: str) -> str:
    return f"""SELECT '{x}' AS x, '{y}' AS y, count(*) AS n, corr(x, y) AS pearson, corr(rx, ry) AS spearman,
                      least(count(*), 50000) AS sample_rows, quantile_cont(x, 0.01) AS x_p01, quantile_cont(x, 0.99) AS x_p99,
                      quantile_cont(y, 0.01) AS y_p01, quantile_cont(y, 0.99) AS y_p99
               FROM (SELECT {x} AS x, {y} AS y, {_ranks(x)} AS rx, {_ranks(y)} AS ry FROM t_pos WHERE {x} > 0 AND {y} > 0)"""


@query(
    "pair_study",
    "x:s y:s n:l pearson:6 spearman:6 sample_rows:l x_p01:4 x_p99:4 y_p01:4 y_p99:4",
    f"{_study('Quantity', 'TotalAmount')} UNION ALL {_study('UnitPrice', 'Quantity')}",
)
def pair_study(t):
    first = relations.pair_study(t.measures, "Quantity", "TotalAmount")
    return first.unionByName(relations.pair_study(t.measures, "UnitPrice", "Quantity"))


_CLIP = """SELECT Quantity, TotalAmount FROM t_pos
           WHERE Quantity > 0 AND TotalAmount > 0 AND Quantity <= (SELECT quantile_cont(Quantity, 0.99) FROM t_pos WHERE TotalAmount > 0)
             AND TotalAmount <= (SELECT quantile_cont(TotalAmount, 0.99) FROM t_pos WHERE TotalAmount > 0)"""


@query("p99_clip", "Quantity:l TotalAmount:x", _CLIP)
def p99_clip(t):
    return relations.clip_p99(t.measures, "Quantity", "TotalAmount")


@query(
    "regression_line",
    "n:l slope:4 intercept:3",
    f"""SELECT count(*) AS n, regr_slope(TotalAmount, Quantity) AS slope, regr_intercept(TotalAmount, Quantity) AS intercept
        FROM ({_CLIP})""",
)
def regression_line(t):
    return relations.regression_line(relations.clip_p99(t.measures, "Quantity", "TotalAmount"), "Quantity", "TotalAmount")


@query(
    "histogram",
    "bin:l bin_low:4 bin_high:4 count:l mean:4 median:4",
    """SELECT i AS bin, low + i * width AS bin_low, low + (i + 1) * width AS bin_high, count(v) AS "count", max(mean) AS mean, max(mid) AS median
       FROM (SELECT unnest(range(50)) AS i)
       CROSS JOIN (SELECT min(TotalAmount) AS low, (max(TotalAmount) - min(TotalAmount)) / 50 AS width, avg(TotalAmount) AS mean, median(TotalAmount) AS mid
                   FROM t_pos WHERE TotalAmount > 0) s
       LEFT JOIN (SELECT TotalAmount AS v FROM t_pos WHERE TotalAmount > 0) ON least(floor((v - low) / width), 49) = i
       GROUP BY i, low, width""",
)
def histogram(t):
    return outliers.histogram(t.measures, "TotalAmount", 50)


@query(
    "histogram_log",
    "bin:l bin_low:6 bin_high:6 count:l mean:6 median:6",
    """SELECT i AS bin, low + i * width AS bin_low, low + (i + 1) * width AS bin_high, count(v) AS "count", max(mean) AS mean, max(mid) AS median
       FROM (SELECT unnest(range(60)) AS i)
       CROSS JOIN (SELECT min(v) AS low, (max(v) - min(v)) / 60 AS width, avg(v) AS mean, median(v) AS mid
                   FROM (SELECT ln(1 + TotalAmount) AS v FROM t_pos WHERE TotalAmount > 0)) s
       LEFT JOIN (SELECT ln(1 + TotalAmount) AS v FROM t_pos WHERE TotalAmount > 0) ON least(floor((v - low) / width), 59) = i
       GROUP BY i, low, width""",
)
def histogram_log(t):
    return outliers.histogram(t.measures, "TotalAmount", 60, log=True)


@query(
    "box_stats",
    "column:s min:4 q1:4 median:4 q3:4 max:4 whisker_low:4 whisker_high:4 beyond:l",
    f"""SELECT b.*, whisker_low, whisker_high, beyond FROM ({_BOUNDS}) b JOIN (
          SELECT v."column" AS c, min(value) FILTER (WHERE value BETWEEN lower_bound AND upper_bound) AS whisker_low,
                 max(value) FILTER (WHERE value BETWEEN lower_bound AND upper_bound) AS whisker_high,
                 count(*) FILTER (WHERE NOT value BETWEEN lower_bound AND upper_bound) AS beyond
          FROM ({long_measures("t_pos", positive=True)}) v JOIN ({_BOUNDS}) k ON v."column" = k."column"
          GROUP BY v."column") w ON b."column" = w.c""",
)
def box_stats(t):
    return outliers.box_stats(t.measures)


_EXTREME = "InvoiceNo:s StockCode:s Description:s Quantity:l UnitPrice:x CustomerID:l Country:s TotalAmount:x"
_TIES = """InvoiceNo NULLS FIRST, StockCode NULLS FIRST, Description NULLS FIRST, Quantity NULLS FIRST,
           UnitPrice NULLS FIRST, CustomerID NULLS FIRST, Country NULLS FIRST"""


@query(
    "extreme_values",
    f"side:s {_EXTREME}",
    f"""SELECT * FROM (SELECT 'largest' AS side, * FROM t_full ORDER BY TotalAmount DESC, {_TIES} LIMIT 10)
        UNION ALL SELECT * FROM (SELECT 'smallest', * FROM t_full ORDER BY TotalAmount, {_TIES} LIMIT 10)""",
)
def extreme_values(t):
    parts = {
        "largest": outliers.extreme_values(t.full, "TotalAmount", 10),
        "smallest": outliers.extreme_values(t.full, "TotalAmount", 10, largest=False),
    }
    return union(parts, "side")


_EXAMPLE_TIES = """InvoiceNo NULLS FIRST, StockCode NULLS FIRST, Description NULLS FIRST, Quantity NULLS FIRST,
                   UnitPrice NULLS FIRST"""


@query(
    "anomaly_examples",
    "kind:s InvoiceNo:s StockCode:s Description:s Quantity:l UnitPrice:x TotalAmount:x InvoiceDate:t Country:s",
    f"""SELECT * FROM (SELECT 'largest_quantity' AS kind, * FROM t_pos ORDER BY Quantity DESC, {_EXAMPLE_TIES} LIMIT 5)
        UNION ALL SELECT * FROM (SELECT 'highest_totalamount', * FROM t_pos ORDER BY TotalAmount DESC, {_EXAMPLE_TIES} LIMIT 5)
        UNION ALL SELECT * FROM (SELECT 'cancellation_examples', * FROM t_full WHERE IsCancellation
                                 ORDER BY Quantity, {_EXAMPLE_TIES} LIMIT 5)
        UNION ALL SELECT * FROM (SELECT 'zero_or_negative_price', * FROM t_full WHERE UnitPrice <= 0
                                 ORDER BY InvoiceDate, {_EXAMPLE_TIES} LIMIT 5)""",
)
def anomaly_examples(t):
    return union(outliers.anomaly_examples(t.full, t.positive), "kind")


_KEY = ["InvoiceNo", "StockCode", "Quantity"]
_SAMPLED = """
SELECT InvoiceNo, StockCode, Quantity
FROM (SELECT *, row_number() OVER (PARTITION BY InvoiceNo, StockCode, Quantity) - 1 AS copy FROM t_pos)
ORDER BY md5(InvoiceNo || '-' || StockCode || '-' || CAST(Quantity AS VARCHAR) || '-' || CAST(copy AS VARCHAR) || '-42'),
         InvoiceNo, StockCode, Quantity"""


@query(
    "sample_n",
    "InvoiceNo:s StockCode:s Quantity:l",
    f"{_SAMPLED} LIMIT 50000",
)
def sample_n(t):
    return hash_sample(t.positive.select(*_KEY), SAMPLE_ROWS, _KEY)


@query(
    "sample_5000",
    "InvoiceNo:s StockCode:s Quantity:l",
    f"{_SAMPLED} LIMIT 5000",
)
def sample_5000(t):
    return hash_sample(t.positive.select(*_KEY), 5000, _KEY)


@query(
    "scatter_sample",
    "Year:l Quantity:l",
    """SELECT "Year", Quantity
       FROM (SELECT "Year", Quantity, row_number() OVER (PARTITION BY "Year", Quantity) - 1 AS copy FROM t_pos)
       ORDER BY md5(CAST("Year" AS VARCHAR) || '-' || CAST(Quantity AS VARCHAR) || '-' || CAST(copy AS VARCHAR) || '-42') LIMIT 2000""",
)
def scatter_sample(t):
    # Few distinct pairs, so nearly every drawn row is a copy.
    return relations.scatter_sample(t.positive, "Year", "Quantity", 2000)
