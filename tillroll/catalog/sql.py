"""Shared SQL: the same row sets and customer tables in the dialect of the checking engine."""

PRELUDE = """
WITH base AS (
  SELECT l_orderkey,
         CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || CAST(l_orderkey AS VARCHAR) AS InvoiceNo,
         'P' || CAST(l_partkey AS VARCHAR) AS StockCode,
         CASE WHEN l_partkey % 97 <> 0 THEN p_name END AS Description,
         CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity
                   WHEN l_orderkey % 53 = 0 THEN 0 ELSE l_quantity END AS BIGINT) AS Quantity,
         o_orderdate + to_hours(CAST(6 + o_orderkey % 15 AS INTEGER)) AS InvoiceDate,
         CAST(CASE WHEN l_orderkey % 217 = 0 THEN CAST(0 AS DOUBLE)
                   WHEN l_orderkey % 499 = 1 THEN CAST(-1 AS DOUBLE)
                   ELSE l_extendedprice / l_quantity END AS DOUBLE) AS UnitPrice,
         CASE WHEN o_custkey % 4 <> 0 THEN o_custkey END AS CustomerID,
         n_name AS Country
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
),
t_raw AS (
  SELECT * EXCLUDE (l_orderkey) FROM base
  UNION ALL
  SELECT * EXCLUDE (l_orderkey) FROM base WHERE l_orderkey % 101 = 0
),
t_full AS (
  SELECT d.*, d.Quantity * d.UnitPrice AS TotalAmount,
         year(InvoiceDate) AS "Year", month(InvoiceDate) AS "Month", day(InvoiceDate) AS "Day",
         hour(InvoiceDate) AS "Hour", isodow(InvoiceDate) - 1 AS DayOfWeek,
         strftime(InvoiceDate, '%A') AS DayOfWeekName, strftime(InvoiceDate, '%Y-%m') AS YearMonth,
         CAST(InvoiceDate AS DATE) AS "Date", InvoiceNo LIKE 'C%' AS IsCancellation
  FROM (SELECT DISTINCT * FROM t_raw) d
),
t_valid AS (SELECT * FROM t_full WHERE UnitPrice > 0),
t_pos AS (SELECT * FROM t_valid WHERE NOT IsCancellation AND Quantity > 0),
t_sales AS (SELECT * FROM t_pos WHERE CustomerID IS NOT NULL),
t_rfm AS (
  SELECT CustomerID,
         CAST(floor((max(ref) - max(epoch_us(InvoiceDate))) / 86400000000.0) AS BIGINT) AS Recency,
         count(DISTINCT InvoiceNo) AS Frequency, sum(TotalAmount) AS Monetary
  FROM t_sales, (SELECT epoch_us(max(InvoiceDate)) + 86400000000 AS ref FROM t_sales)
  GROUP BY CustomerID
),
t_grouped AS (
  SELECT *, CASE WHEN Frequency < 7 THEN 0 WHEN Frequency < 9 THEN 1 ELSE 2 END AS Cluster FROM t_rfm
),
t_scaled AS (
  SELECT g.*, (ln(1 + Recency) - r0) / r1 AS z1, (ln(1 + Frequency) - f0) / f1 AS z2, (ln(1 + Monetary) - m0) / m1 AS z3
  FROM t_grouped g,
       (SELECT avg(ln(1 + Recency)) r0, stddev_pop(ln(1 + Recency)) r1, avg(ln(1 + Frequency)) f0,
               stddev_pop(ln(1 + Frequency)) f1, avg(ln(1 + Monetary)) m0, stddev_pop(ln(1 + Monetary)) m1
        FROM t_grouped)
),
t_profiles AS (
  SELECT Cluster AS cluster, count(DISTINCT CustomerID) AS customer_count,
         100.0 * count(DISTINCT CustomerID) / (SELECT count(*) FROM t_grouped) AS pct_of_customers,
         avg(Recency) AS mean_recency, quantile_cont(Recency, 0.5) AS median_recency,
         avg(Frequency) AS mean_frequency, quantile_cont(Frequency, 0.5) AS median_frequency,
         avg(Monetary) AS mean_monetary, quantile_cont(Monetary, 0.5) AS median_monetary,
         sum(Monetary) AS total_monetary,
         100.0 * sum(Monetary) / (SELECT sum(Monetary) FROM t_grouped) AS pct_of_total_revenue
  FROM t_grouped GROUP BY Cluster
),
t_dates AS (SELECT DISTINCT InvoiceDate AS d FROM t_sales),
t_split AS (
  SELECT n, first_d, last_d,
         CASE WHEN cut <= first_d
              THEN make_timestamp(CAST(floor(epoch_us(first_d) + (epoch_us(last_d) - epoch_us(first_d)) * 0.75) AS BIGINT))
              ELSE cut END AS cut
  FROM (SELECT count(*) AS n, min(d) AS first_d, max(d) AS last_d,
               max(CASE WHEN i = greatest(0, least(floor(0.75 * total), total - 1)) THEN d END) AS cut
        FROM (SELECT d, row_number() OVER (ORDER BY d) - 1 AS i, count(*) OVER () AS total FROM t_dates))
),
t_features AS (
  SELECT *, Monetary / Frequency AS AOV, Frequency / CAST(days AS DOUBLE) AS PurchaseFrequency
  FROM (
    SELECT CustomerID,
           CAST(floor((epoch_us(max(cut)) - max(epoch_us(InvoiceDate))) / 86400000000.0) AS BIGINT) AS Recency,
           count(DISTINCT InvoiceNo) AS Frequency, sum(Quantity * UnitPrice) AS Monetary,
           count(DISTINCT StockCode) AS UniqueProducts, avg(Quantity) AS AvgQuantity, sum(Quantity) AS TotalQuantity,
           greatest(1, floor((epoch_us(max(cut)) - epoch_us(max(first_d))) / 86400000000.0)) AS days
    FROM t_sales, t_split WHERE InvoiceDate < cut GROUP BY CustomerID)
  JOIN (
    SELECT CustomerID, Country FROM (
      SELECT CustomerID, Country, row_number() OVER (PARTITION BY CustomerID ORDER BY count(*) DESC, Country) AS place
      FROM t_sales, t_split WHERE InvoiceDate < cut GROUP BY CustomerID, Country) WHERE place = 1) USING (CustomerID)
),
t_target AS (
  SELECT CustomerID, CAST(max(CASE WHEN InvoiceDate >= cut AND InvoiceDate <= last_d THEN 1 ELSE 0 END) AS INTEGER) AS FuturePurchased
  FROM t_sales, t_split GROUP BY CustomerID HAVING max(CASE WHEN InvoiceDate < cut THEN 1 ELSE 0 END) = 1
),
t_scored AS (
  SELECT l.doc_id, l.quality AS label, CAST(n_chars AS DOUBLE) / (CAST(n_chars AS DOUBLE) + 1000) AS score,
         CASE WHEN CAST(n_chars AS DOUBLE) / (CAST(n_chars AS DOUBLE) + 1000) >= 0.5 THEN 1 ELSE 0 END AS prediction
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id
),
t_steps AS (
  SELECT threshold, pos, neg, sum(pos) OVER (ORDER BY threshold DESC) AS tp, sum(neg) OVER (ORDER BY threshold DESC) AS fp,
         sum(pos) OVER () AS p, sum(neg) OVER () AS n
  FROM (SELECT score AS threshold, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
        FROM t_scored GROUP BY score)
),
t_vectors AS (
  SELECT vec_id, label, CAST((list_position(embedding, list_max(embedding)) - 1) % 10 AS INTEGER) AS prediction FROM embeddings
),
t_products AS (SELECT StockCode, sum(TotalAmount) AS revenue FROM t_pos GROUP BY StockCode)
""".strip()


def long_measures(source: str, positive: bool = False) -> str:
    """The three measures of a row set as ``column, value`` rows."""
    keep = "> 0" if positive else "IS NOT NULL"
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM {source} WHERE {c} {keep}"
        for c in ("Quantity", "UnitPrice", "TotalAmount")
    )


def counted(columns: list[str], source: str, value: str) -> str:
    """One row per column: ``value`` is an aggregate with ``{c}`` for the column."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {value.format(c=c)} FROM {source}" for c in columns
    )


FENCES = """
SELECT "column", q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound,
       median, mean, min, max, n
FROM (SELECT "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3,
             quantile_cont(value, 0.5) AS median, avg(value) AS mean, min(value) AS min, max(value) AS max, count(*) AS n
      FROM ({long}) GROUP BY "column")
"""


def confusion(source: str, labels: str) -> str:
    return f"""
    SELECT a.c AS actual, b.c AS predicted, count(s.label) AS "count"
    FROM ({labels}) a CROSS JOIN ({labels}) b LEFT JOIN {source} s ON s.label = a.c AND s.prediction = b.c
    GROUP BY a.c, b.c"""


TWO = "SELECT unnest([0, 1]) AS c"
TEN = "SELECT unnest(range(10)) AS c"


def class_scores(source: str, labels: str) -> str:
    return f"""
    SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1
    FROM (SELECT cls, hits, support,
                 CASE WHEN claimed > 0 THEN CAST(hits AS DOUBLE) / claimed ELSE 0 END AS precision,
                 CASE WHEN support > 0 THEN CAST(hits AS DOUBLE) / support ELSE 0 END AS recall
          FROM (SELECT c AS cls,
                       (SELECT count(*) FROM {source} s WHERE s.label = c AND s.prediction = c) AS hits,
                       (SELECT count(*) FROM {source} s WHERE s.label = c) AS support,
                       (SELECT count(*) FROM {source} s WHERE s.prediction = c) AS claimed
                FROM ({labels})))"""
