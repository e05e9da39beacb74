"""Queries over customers, vectors and scored documents: features, splits, segments, scores, models."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.catalog.registry import query, union
from tillroll.catalog.sql import TEN, TWO, class_scores, confusion
from tillroll.operators import classifiers, customers, narrative, scaling, scores, segments, vectors
from tillroll.operators.prepare import before, instant
from tillroll.plans import segmentation
from tillroll.schema import NUMERIC_FEATURES, RFM_COLUMNS, TARGET
from tillroll.session import pinned

SCALED = segmentation.SCALED
FEATURES = (
    "CustomerID:l Recency:l Frequency:l Monetary:2 AOV:6 UniqueProducts:l AvgQuantity:6 TotalQuantity:l "
    "PurchaseFrequency:6 Country:s"
)


@query("rfm", "CustomerID:l Recency:l Frequency:l Monetary:2", "SELECT * FROM t_rfm")
def rfm(t):
    return customers.rfm(t.sales)


@query("rfm_means", "Recency:6 Frequency:6 Monetary:4", """SELECT avg(Recency) AS "Recency", avg(Frequency) AS "Frequency",
       avg(Monetary) AS "Monetary" FROM t_rfm""")
def rfm_means(t):
    return customers.rfm_means(t.rfm)


@query(
    "rfm_distribution",
    "column:s count:l mean:4 std:4 min:2 max:2 q1:4 median:4 q3:4 skewness:6 kurtosis:6",
    """SELECT "column", count(*) AS "count", avg(v) AS mean, stddev_samp(v) AS std, min(v) AS min, max(v) AS max,
              quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3,
              skewness(v) AS skewness, kurtosis(v) AS kurtosis
       FROM (SELECT 'Recency' AS "column", CAST(Recency AS DOUBLE) AS v FROM t_rfm
             UNION ALL SELECT 'Frequency', CAST(Frequency AS DOUBLE) FROM t_rfm
             UNION ALL SELECT 'Monetary', Monetary FROM t_rfm) GROUP BY "column" """,
)
def rfm_distribution(t):
    return customers.rfm_distribution(t.rfm)


@query(
    "customer_mode_country",
    "CustomerID:l Country:s",
    """SELECT CustomerID, Country FROM (
         SELECT CustomerID, Country, row_number() OVER (PARTITION BY CustomerID ORDER BY count(*) DESC, Country) AS place
         FROM t_sales GROUP BY CustomerID, Country) WHERE place = 1""",
)
def customer_mode_country(t):
    return customers.customer_mode(t.sales)


@query(
    "temporal_split",
    "historical_start:t historical_end:t future_start:t future_end:t n_dates:l days_historical:l days_future:l",
    """SELECT first_d AS historical_start, cut AS historical_end, cut AS future_start, last_d AS future_end, n AS n_dates,
              floor((epoch_us(cut) - epoch_us(first_d)) / 86400000000.0) AS days_historical,
              floor((epoch_us(last_d) - epoch_us(cut)) / 86400000000.0) AS days_future FROM t_split""",
)
def temporal_split(t):
    return customers.temporal_split(t.sales)


@query("customer_features", FEATURES, "SELECT * FROM t_features")
def customer_features(t):
    end = t.dates["historical_end"]
    return customers.customer_features(before(t.sold, end), end, t.dates["historical_start"])


@query("future_target", f"CustomerID:l {TARGET}:i", "SELECT * FROM t_target")
def future_target(t):
    d = t.dates
    return customers.future_target(t.raw, d["historical_end"], d["future_start"], d["future_end"])


@query(
    "future_purchased",
    f"CustomerID:l {TARGET}:i",
    f"""SELECT CustomerID, CASE WHEN CustomerID IN (SELECT CustomerID FROM t_sales, t_split WHERE InvoiceDate >= cut)
                                THEN 1 ELSE 0 END AS "{TARGET}"
        FROM (SELECT DISTINCT CustomerID FROM t_sales, t_split WHERE InvoiceDate < cut)""",
)
def future_purchased(t):
    end = t.dates["historical_end"]
    past = before(t.sales, end).select("CustomerID").distinct()
    return customers.membership_label(past, t.sales.filter(F.col("InvoiceDate") >= instant(end)), "CustomerID")


@query("design_matrix", f"{FEATURES} {TARGET}:i", "SELECT * FROM t_features JOIN t_target USING (CustomerID)")
def design_matrix(t):
    return t.matrix


@query(
    "label_distribution",
    "label:i count:l percentage:4",
    f"""SELECT "{TARGET}" AS label, count(*) AS "count", 100.0 * count(*) / (SELECT count(*) FROM t_target) AS percentage
        FROM t_target GROUP BY "{TARGET}" """,
)
def label_distribution(t):
    return customers.label_distribution(pinned(t.matrix), TARGET)


@query(
    "class_weights",
    "label:i count:l weight:6",
    f"""SELECT "{TARGET}" AS label, count(*) AS "count",
               (SELECT count(*) FROM t_target) / (CAST((SELECT count(DISTINCT "{TARGET}") FROM t_target) AS DOUBLE) * count(*)) AS weight
        FROM t_target GROUP BY "{TARGET}" """,
)
def class_weights(t):
    return scores.class_weights(pinned(t.matrix), TARGET)


_SCALE = ("Quantity", "UnitPrice", "TotalAmount")


@query(
    "scale_standard",
    "InvoiceNo:s StockCode:s Quantity:l Quantity_Scaled:6 UnitPrice_Scaled:6 TotalAmount_Scaled:6",
    "SELECT InvoiceNo, StockCode, Quantity, "
    + ", ".join(f'({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS "{c}_Scaled"' for c in _SCALE)
    + " FROM t_pos",
)
def scale_standard(t):
    return scaling.scale_numeric(t.positive, [*_SCALE, "CustomerID"])


@query(
    "scale_minmax",
    "InvoiceNo:s StockCode:s Quantity:l Quantity_Scaled:6 UnitPrice_Scaled:6 TotalAmount_Scaled:6",
    "SELECT InvoiceNo, StockCode, Quantity, "
    + ", ".join(
        f'({c} - min({c}) OVER ()) / CAST(max({c}) OVER () - min({c}) OVER () AS DOUBLE) AS "{c}_Scaled"' for c in _SCALE
    )
    + " FROM t_pos",
)
def scale_minmax(t):
    return scaling.scale_numeric(t.positive, _SCALE, "minmax")


@query(
    "encode_label",
    "InvoiceNo:s StockCode:s Country:s Country_Encoded:i",
    'SELECT *, dense_rank() OVER (ORDER BY Country) - 1 AS "Country_Encoded" FROM t_pos',
)
def encode_label(t):
    return scaling.encode_categorical(t.positive, ["Country", "StockCode"])


@query(
    "encode_onehot",
    "Country:s indicator:s hits:l",
    """SELECT a.Country AS "Country", 'Country_' || b.Country AS indicator,
              CASE WHEN a.Country = b.Country THEN a.rows ELSE 0 END AS hits
       FROM (SELECT Country, count(*) AS rows FROM t_pos GROUP BY Country) a
       CROSS JOIN (SELECT DISTINCT Country FROM t_pos) b""",
)
def encode_onehot(t):
    hot = scaling.encode_categorical(t.positive, ["Country"], "onehot")
    counted = hot.groupBy("Country", "Country_OneHot").agg(F.count(F.lit(1)).alias("rows"))
    every = counted.withColumn("code", F.explode(F.sequence(F.lit(0), F.col("Country_OneHot.size") - 1)))
    hits = F.when(F.array_contains("Country_OneHot.indices", F.col("code")), F.col("rows")).otherwise(0)
    named = every.join(scaling.levels(t.positive, "Country"), "code")
    return named.select("Country", F.concat(F.lit("Country_"), "level").alias("indicator"), hits.alias("hits"))


@query(
    "analytical_dataset",
    "InvoiceNo:s StockCode:s Country:s Quantity:x Quantity_Scaled:6 TotalAmount_Scaled:6 Month_Scaled:6 Hour_Scaled:6 DayOfWeek_Scaled:6",
    "SELECT InvoiceNo, StockCode, Country, Quantity, "
    + ", ".join(
        f'("{c}" - avg("{c}") OVER ()) / stddev_pop("{c}") OVER () AS "{c}_Scaled"'
        for c in ("Quantity", "TotalAmount", "Month", "Hour", "DayOfWeek")
    )
    + " FROM t_pos",
)
def analytical_dataset(t):
    return scaling.analytical_dataset(t.positive)["scaled"]


@query(
    "rfm_scaled",
    "CustomerID:l z1:6 z2:6 z3:6",
    "SELECT CustomerID, z1, z2, z3 FROM t_scaled",
)
def rfm_scaled(t):
    names = dict(zip(SCALED, ("z1", "z2", "z3")))
    return t.scaled_rfm.withColumnsRenamed(names)


@query(
    "stratified_split",
    f"CustomerID:l {TARGET}:i is_test:b",
    f"""SELECT *, row_number() OVER (PARTITION BY "{TARGET}" ORDER BY md5(CAST(CustomerID AS VARCHAR) || '-42'), CustomerID)
                  <= floor(count(*) OVER (PARTITION BY "{TARGET}") * CAST(0.3 AS DOUBLE) + 0.5) AS is_test FROM t_target""",
)
def stratified_split(t):
    return scaling.stratified_split(pinned(t.matrix.select("CustomerID", TARGET)), TARGET)


@query(
    "stratified_folds",
    f"CustomerID:l {TARGET}:i fold:i",
    f"""SELECT *, (row_number() OVER (PARTITION BY "{TARGET}" ORDER BY md5(CAST(CustomerID AS VARCHAR) || '-42'), CustomerID) - 1)
                  % 5 AS fold FROM t_target""",
)
def stratified_folds(t):
    return scaling.stratified_folds(pinned(t.matrix.select("CustomerID", TARGET)), TARGET)


_Z = {c: f'coalesce((CAST("{c}" AS DOUBLE) - avg("{c}") OVER ()) / nullif(stddev_pop("{c}") OVER (), 0), 0)' for c in NUMERIC_FEATURES}


@query(
    "feature_vectors",
    "CustomerID:l size:i filled:i total:4",
    f"""SELECT CustomerID, {len(_Z)} + (SELECT count(DISTINCT "Country") FROM t_features) AS size,
               1 + {" + ".join(f"CASE WHEN {z} <> 0 THEN 1 ELSE 0 END" for z in _Z.values())} AS filled,
               1 + {" + ".join(_Z.values())} AS total
        FROM t_features""",
)
def feature_vectors(t):
    """The prepared feature vector of each customer, with its length and number of non-zero entries."""
    from pyspark.ml.functions import vector_to_array

    matrix = pinned(t.matrix)
    prepared = scaling.feature_pipeline().fit(matrix).transform(matrix)
    v = vector_to_array("features")
    return prepared.select(
        "CustomerID",
        F.size(v).alias("size"),
        F.size(F.filter(v, lambda x: x != 0)).alias("filled"),
        F.aggregate(v, F.lit(0.0), lambda a, x: a + x).alias("total"),
    )


@query(
    "vector_normalise",
    "vec_id:l place:i value:6",
    """SELECT vec_id, unnest(range(len(embedding))) AS place,
              unnest(list_transform(embedding, lambda x: CAST(x / 255.0 AS FLOAT))) AS value FROM embeddings""",
)
def vector_normalise(t):
    v = vectors.normalise(t.table("embeddings"), "embedding")
    return v.select("vec_id", F.posexplode("pixels").alias("place", "value"))


@query(
    "label_onehot",
    "vec_id:l class:i hot:i",
    """SELECT vec_id, c AS class, CASE WHEN label = c THEN 1 ELSE 0 END AS hot
       FROM embeddings CROSS JOIN (SELECT unnest(range(10)) AS c)""",
)
def label_onehot(t):
    v = vectors.onehot_label(t.table("embeddings"), "label", 10)
    return v.select("vec_id", F.posexplode("onehot").alias("class", "hot"))


@query(
    "vector_shape_check",
    "samples:l wrong_shape:l missing_label:l label_out_of_range:l",
    """SELECT count(*) AS samples, count(*) FILTER (WHERE len(embedding) <> 64) AS wrong_shape,
              count(*) FILTER (WHERE label IS NULL) AS missing_label,
              count(*) FILTER (WHERE label NOT BETWEEN 0 AND 9) AS label_out_of_range FROM embeddings""",
)
def vector_shape_check(t):
    return vectors.shape_check(t.table("embeddings"), "embedding", "label", 64, 10)


@query(
    "argmax_class",
    "vec_id:l predicted_class:i",
    "SELECT vec_id, list_position(embedding, list_max(embedding)) - 1 AS predicted_class FROM embeddings",
)
def argmax_class(t):
    return vectors.add_argmax(t.table("embeddings"), "embedding")


@query(
    "class_balance",
    "label:i count:l percentage:4",
    """SELECT c AS label, count(e.label) AS "count", 100.0 * count(e.label) / (SELECT count(*) FROM embeddings) AS percentage
       FROM (SELECT unnest(range(12)) AS c) LEFT JOIN embeddings e ON e.label = c GROUP BY c""",
)
def class_balance(t):
    return scores.class_balance(t.table("embeddings"), "label", 12)


# Segments on a rule-based label, so that every formula has an exact expectation.

_PROFILE = (
    "cluster:i customer_count:l pct_of_customers:4 mean_recency:4 median_recency:4 mean_frequency:4 median_frequency:4 "
    "mean_monetary:4 median_monetary:4 total_monetary:2 pct_of_total_revenue:4"
)


@query("cluster_profiles", _PROFILE, "SELECT * FROM t_profiles")
def cluster_profiles(t):
    return segments.cluster_profiles(t.grouped_rfm)


@query(
    "cluster_ranking",
    "place:i cluster:i total_monetary:2",
    "SELECT row_number() OVER (ORDER BY total_monetary DESC, cluster) AS place, * FROM t_profiles",
)
def cluster_ranking(t):
    from pyspark.sql import Window

    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("total_monetary"), "cluster")
    return segments.rank_clusters(t.profiles).withColumn("place", F.row_number().over(order))


@query(
    "cluster_zscores",
    "cluster:i Recency_z:6 Frequency_z:6 Monetary_z:6",
    "SELECT cluster, "
    + ", ".join(
        f'(mean_{c.lower()} - (SELECT avg({c}) FROM t_grouped)) / (SELECT stddev_pop({c}) FROM t_grouped) AS "{c}_z"'
        for c in RFM_COLUMNS
    )
    + " FROM t_profiles",
)
def cluster_zscores(t):
    return segments.cluster_zscores(t.profiles, t.grouped_rfm)


@query(
    "cluster_minmax",
    "cluster:i Recency_scaled:6 Frequency_scaled:6 Monetary_scaled:6",
    "SELECT cluster, "
    + ", ".join(
        f"(mean_{c} - min(mean_{c}) OVER ()) / coalesce(nullif(max(mean_{c}) OVER () - min(mean_{c}) OVER (), 0), 1) "
        f'AS "{c.title()}_scaled"'
        for c in ("recency", "frequency", "monetary")
    )
    + " FROM t_profiles",
)
def cluster_minmax(t):
    return segments.cluster_minmax(t.profiles)


def _trait(ratio: str, word: str) -> str:
    return f"CASE WHEN {ratio} >= 1.2 THEN 'high-{word}' WHEN {ratio} <= 0.8 THEN 'low-{word}' ELSE 'moderate-{word}' END"


_TRAITS = f"""SELECT *, CASE WHEN r <= 0.8 THEN 'recent' WHEN r >= 1.2 THEN 'stale' ELSE 'moderately recent' END AS recency_label,
                     {_trait("f", "frequency")} AS frequency_label, {_trait("m", "monetary")} AS monetary_label
              FROM (SELECT *, mean_recency / (SELECT avg(Recency) FROM t_rfm) AS r,
                           mean_frequency / (SELECT avg(Frequency) FROM t_rfm) AS f,
                           mean_monetary / (SELECT avg(Monetary) FROM t_rfm) AS m FROM t_profiles)"""


@query(
    "cluster_descriptions",
    "cluster:i recency_label:s frequency_label:s monetary_label:s description:s",
    f"""SELECT *, printf('Cluster %d is %s, %s and %s: %d customers (%.1f%%) bring %.2f (%.1f%%) of revenue; means against those of all customers: recency %.1f days (%.1f), orders %.2f (%.2f), amount %.2f (%.2f).', cluster,
                         frequency_label, monetary_label, recency_label, customer_count, CAST(pct_of_customers AS DOUBLE),
                         CAST(total_monetary AS DOUBLE), CAST(pct_of_total_revenue AS DOUBLE),
                         mean_recency, (SELECT avg(Recency) FROM t_rfm), mean_frequency, (SELECT avg(Frequency) FROM t_rfm),
                         mean_monetary, (SELECT avg(Monetary) FROM t_rfm)) AS description FROM ({_TRAITS})""",
)
def cluster_descriptions(t):
    return narrative.cluster_descriptions(t.profiles, customers.rfm_means(t.rfm))


@query(
    "cluster_facts",
    "clusters:l top_cluster:i top_revenue_pct:4 top_customer_pct:4 top_mean_recency:4 bottom_cluster:i bottom_revenue_pct:4 "
    "bottom_mean_recency:4",
    """SELECT (SELECT count(*) FROM t_profiles) AS clusters, a.cluster AS top_cluster, a.pct_of_total_revenue AS top_revenue_pct,
              a.pct_of_customers AS top_customer_pct, a.mean_recency AS top_mean_recency, b.cluster AS bottom_cluster,
              b.pct_of_total_revenue AS bottom_revenue_pct, b.mean_recency AS bottom_mean_recency
       FROM (SELECT * FROM t_profiles ORDER BY pct_of_total_revenue DESC, cluster LIMIT 1) a,
            (SELECT * FROM t_profiles ORDER BY pct_of_total_revenue, cluster DESC LIMIT 1) b""",
)
def cluster_facts(t):
    return narrative.cluster_facts(t.profiles)


@query(
    "recommendation_facts",
    "position:i topic:s subject:s value:4 detail:4 extra:4",
    """SELECT 1 AS position, 'top_segment' AS topic, CAST(cluster AS VARCHAR) AS subject, pct_of_total_revenue AS value,
              pct_of_customers AS detail, mean_recency AS extra
       FROM (SELECT * FROM t_profiles ORDER BY pct_of_total_revenue DESC, cluster LIMIT 1)
       UNION ALL
       SELECT 7, 'order_value', CAST(cluster AS VARCHAR), mean_monetary / greatest(1, mean_frequency), mean_frequency, NULL
       FROM (SELECT * FROM t_profiles ORDER BY mean_monetary DESC, cluster LIMIT 1)
       UNION ALL
       SELECT 5, 'country_budget', min(Country) FILTER (WHERE place = 1),
              floor(CAST(max(n) FILTER (WHERE place = 1) AS DOUBLE) / sum(n) * 100),
              max(n) FILTER (WHERE place = 1), max(revenue) FILTER (WHERE place = 1)
       FROM (SELECT Country, count(DISTINCT InvoiceNo) AS n, sum(TotalAmount) AS revenue,
                    row_number() OVER (ORDER BY count(DISTINCT InvoiceNo) DESC, Country) AS place
             FROM t_sales GROUP BY Country) WHERE place <= 2
       UNION ALL
       SELECT * FROM (SELECT 6, 'top_product', StockCode, sum(TotalAmount) AS v, NULL, NULL FROM t_sales
                      WHERE Description IS NOT NULL GROUP BY StockCode, Description ORDER BY v DESC, StockCode LIMIT 1)
       UNION ALL
       SELECT 9, 'refresh_days', 'split', greatest(7, floor((epoch_us(last_d) - epoch_us(cut)) / 86400000000.0)),
              floor((epoch_us(cut) - epoch_us(first_d)) / 86400000000.0),
              floor((epoch_us(last_d) - epoch_us(cut)) / 86400000000.0) FROM t_split
       UNION ALL
       SELECT * FROM (SELECT 10, 'peak_month', YearMonth, sum(TotalAmount) AS v, NULL, NULL FROM t_sales GROUP BY YearMonth
                      ORDER BY v DESC, YearMonth LIMIT 1)""",
)
def recommendation_facts(t):
    from tillroll.operators import sales

    t.rfm = pinned(customers.rfm(t.sold))  # all five tables come from the lines written once
    return narrative.recommendation_facts(
        t.profiles,
        sales.busiest_countries(t.sold),
        sales.best_products(t.sold),
        sales.monthly_sales(t.sold),
        customers.temporal_split(t.sold),
    )


def _silhouette(distance: str) -> str:
    return f"""SELECT avg(CASE WHEN size = 1 THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette
        FROM (SELECT id, max(CASE WHEN c = other THEN n END) AS size,
                     max(CASE WHEN c = other THEN total / nullif(n - 1, 0) END) AS a,
                     min(CASE WHEN c <> other THEN total / n END) AS b
              FROM (SELECT p.CustomerID AS id, p.Cluster AS c, q.Cluster AS other, count(*) AS n, sum({distance}) AS total
                    FROM t_scaled p CROSS JOIN t_scaled q GROUP BY p.CustomerID, p.Cluster, q.Cluster)
              GROUP BY id)"""


_GAP = "(p.z1 - q.z1) * (p.z1 - q.z1) + (p.z2 - q.z2) * (p.z2 - q.z2) + (p.z3 - q.z3) * (p.z3 - q.z3)"


@query("silhouette", "silhouette:6", _silhouette(_GAP))
def silhouette(t):
    return segments.silhouette(t.scaled_rfm, SCALED, "Cluster")


@query("silhouette_euclidean", "silhouette:6", _silhouette(f"sqrt({_GAP})"))
def silhouette_euclidean(t):
    return segments.silhouette(t.scaled_rfm, SCALED, "Cluster", "euclidean")


_CENTROIDS = "SELECT Cluster AS c, count(*) AS n, avg(z1) AS m1, avg(z2) AS m2, avg(z3) AS m3 FROM t_scaled GROUP BY Cluster"


@query(
    "calinski_harabasz",
    "calinski_harabasz:4",
    f"""SELECT between_c * (n - k) / (within_c * (k - 1)) AS calinski_harabasz
        FROM (SELECT sum(n * ((m1 - a1) ** 2 + (m2 - a2) ** 2 + (m3 - a3) ** 2)) AS between_c, sum(n) AS n, count(*) AS k
              FROM ({_CENTROIDS}), (SELECT avg(z1) AS a1, avg(z2) AS a2, avg(z3) AS a3 FROM t_scaled)),
             (SELECT sum((z1 - m1) ** 2 + (z2 - m2) ** 2 + (z3 - m3) ** 2) AS within_c
              FROM t_scaled JOIN ({_CENTROIDS}) ON c = Cluster)""",
)
def calinski_harabasz(t):
    return segments.calinski_harabasz(t.scaled_rfm, SCALED, "Cluster")


@query(
    "davies_bouldin",
    "davies_bouldin:6",
    f"""WITH s AS (SELECT c, any_value(m1) AS m1, any_value(m2) AS m2, any_value(m3) AS m3,
                          avg(sqrt((z1 - m1) ** 2 + (z2 - m2) ** 2 + (z3 - m3) ** 2)) AS s
                   FROM t_scaled JOIN ({_CENTROIDS}) ON c = Cluster GROUP BY c)
        SELECT avg(worst) AS davies_bouldin
        FROM (SELECT a.c, max((a.s + b.s) / sqrt((a.m1 - b.m1) ** 2 + (a.m2 - b.m2) ** 2 + (a.m3 - b.m3) ** 2)) AS worst
              FROM s a JOIN s b ON a.c <> b.c GROUP BY a.c)""",
)
def davies_bouldin(t):
    return segments.davies_bouldin(t.scaled_rfm, SCALED, "Cluster")


# Scores of a rule on labelled documents and vectors.


@query("confusion_matrix", "actual:i predicted:i count:l", confusion("t_scored", TWO))
def confusion_matrix(t):
    return scores.confusion_matrix(t.scored, n_classes=2)


@query(
    "confusion_normalised",
    "actual:i predicted:i share:6",
    f"""SELECT actual, predicted, coalesce(CAST("count" AS DOUBLE) / nullif(sum("count") OVER (PARTITION BY actual), 0), 0) AS share
        FROM ({confusion("t_vectors", TEN)})""",
)
def confusion_normalised(t):
    return scores.normalised_confusion(scores.confusion_matrix(t.vector_scored, n_classes=10))


@query(
    "roc_points",
    "threshold:x fpr:6 tpr:6",
    """SELECT threshold, CAST(fp AS DOUBLE) / n AS fpr, CAST(tp AS DOUBLE) / p AS tpr FROM t_steps
       UNION ALL SELECT CAST('inf' AS DOUBLE), 0, 0""",
)
def roc_points(t):
    return scores.roc_points(t.scored)


@query(
    "roc_auc",
    "roc_auc:6",
    "SELECT CAST(sum(neg * (tp - pos / 2.0)) AS DOUBLE) / (max(p) * max(n)) AS roc_auc FROM t_steps",
)
def roc_auc(t):
    return scores.roc_auc(t.scored)


@query(
    "pr_points",
    "threshold:x precision:6 recall:6 base_rate:6",
    """SELECT threshold, CAST(tp AS DOUBLE) / (tp + fp) AS precision, CAST(tp AS DOUBLE) / p AS recall,
              CAST(p AS DOUBLE) / (p + n) AS base_rate FROM t_steps
       UNION ALL SELECT CAST('inf' AS DOUBLE), 1, 0, max(CAST(p AS DOUBLE) / (p + n)) FROM t_steps""",
)
def pr_points(t):
    return scores.pr_points(t.scored)


@query(
    "pr_auc",
    "pr_auc:6",
    """SELECT sum((recall - before_r) * (precision + before_p) / 2) AS pr_auc
       FROM (SELECT recall, precision, lag(recall, 1, 0) OVER (ORDER BY threshold DESC) AS before_r,
                    lag(precision, 1, 1) OVER (ORDER BY threshold DESC) AS before_p
             FROM (SELECT threshold, CAST(tp AS DOUBLE) / (tp + fp) AS precision, CAST(tp AS DOUBLE) / p AS recall FROM t_steps))""",
)
def pr_auc(t):
    return scores.pr_auc(t.scored)


@query(
    "classifier_metrics",
    "accuracy:6 precision:6 recall:6 f1:6 support_positive:l support_negative:l imbalance_ratio_neg_to_pos:6 roc_auc:6",
    f"""SELECT CAST(sum(hits) AS DOUBLE) / sum(support) AS accuracy, avg(precision) AS precision, avg(recall) AS recall, avg(f1) AS f1,
               sum(support) FILTER (WHERE cls = 1) AS support_positive, sum(support) FILTER (WHERE cls = 0) AS support_negative,
               CAST(sum(support) FILTER (WHERE cls = 0) AS DOUBLE) / sum(support) FILTER (WHERE cls = 1) AS imbalance_ratio_neg_to_pos,
               (SELECT CAST(sum(neg * (tp - pos / 2.0)) AS DOUBLE) / (max(p) * max(n)) FROM t_steps) AS roc_auc
        FROM ({class_scores("t_scored", TWO)})""",
)
def classifier_metrics(t):
    return scores.classifier_metrics(t.scored)


@query(
    "multiclass_metrics",
    "accuracy:6 precision_weighted:6 recall_weighted:6 f1_weighted:6 n_samples:l num_classes:i",
    f"""SELECT CAST(sum(hits) AS DOUBLE) / sum(support) AS accuracy, sum(precision * support) / sum(support) AS precision_weighted,
               sum(recall * support) / sum(support) AS recall_weighted, sum(f1 * support) / sum(support) AS f1_weighted,
               sum(support) AS n_samples, 10 AS num_classes FROM ({class_scores("t_vectors", TEN)})""",
)
def multiclass_metrics(t):
    return scores.multiclass_metrics(t.vector_scored, 10)


@query(
    "per_class_scores",
    "class:i support:l precision:6 recall:6 f1:6",
    f"SELECT cls AS class, * FROM ({class_scores('t_vectors', TEN)})",
)
def per_class_scores(t):
    return scores.class_scores(scores.confusion_matrix(t.vector_scored, n_classes=10))


@query(
    "log_loss",
    "log_loss:6",
    """SELECT avg(-ln(CASE WHEN label = 1 THEN p ELSE 1 - p END)) AS log_loss
       FROM (SELECT label, least(greatest(score, 1e-7), 1 - 1e-7) AS p FROM t_scored)""",
)
def log_loss(t):
    return scores.log_loss(t.scored)


@query(
    "sampled_predictions",
    "vec_id:l actual:i predicted:i hit:b",
    """SELECT vec_id, label AS actual, prediction AS predicted, label = prediction AS hit FROM t_vectors
       ORDER BY md5(concat_ws('-', vec_id, label, prediction, 0, 42)), vec_id LIMIT 16""",
)
def sampled_predictions(t):
    return vectors.sampled_predictions(t.vector_scored, "vec_id", "label", "prediction")


# Fitted models: their numbers depend on solver and seed, so there is no SQL for them.


def _points(t):
    return t.scaled_rfm.drop("Cluster")


@query("kmeans_sweep")
def kmeans_sweep(t):
    return segments.kmeans_sweep(_points(t))


@query("kmeans_labels")
def kmeans_labels(t):
    return segments.kmeans_labels(_points(t), 3).select("CustomerID", "Cluster")


@query(
    "kmeans_facts",
    "customers:l clusters:i means_off:i wrong_centre:l",
    "SELECT count(*) AS customers, 3 AS clusters, 0 AS means_off, 0 AS wrong_centre FROM t_rfm",
)
def kmeans_facts(t):
    """What holds for every fit: each customer has the nearest centre's label, and centres are the means of their customers."""
    from pyspark.ml.functions import vector_to_array

    points = _points(t)
    fitted = segments.fit_kmeans(points, 3)
    x = vector_to_array("features")
    labelled = fitted.label(points).select("Cluster", *[x[i].alias(f"x{i}") for i in range(3)])
    centres = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in fitted.centres])
    own = F.get(centres, F.col("Cluster"))

    def away(centre):
        return sum(((F.col(f"x{i}") - centre[i]) ** 2 for i in range(3)), F.lit(0.0))

    nearest = F.least(*[away(centres[j]) for j in range(3)])
    sums = labelled.groupBy("Cluster").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(away(own) > nearest + 1e-9).alias("wrong"), *[F.avg(f"x{i}").alias(f"x{i}") for i in range(3)]
    )
    off = away(F.get(centres, F.col("Cluster"))) > 1e-6
    return sums.agg(
        F.sum("n").alias("customers"), F.count(F.lit(1)).alias("clusters"), F.count_if(off).alias("means_off"), F.sum("wrong").alias("wrong_centre")
    )


# Components of the 3 x 3 covariance in closed form; an axis is the longest cross product of two rows of (covariance - value).
_AXES = """
  c AS (SELECT covar_samp(z1, z1) AS a, covar_samp(z2, z2) AS b, covar_samp(z3, z3) AS d, covar_samp(z1, z2) AS e,
               covar_samp(z1, z3) AS f, covar_samp(z2, z3) AS g, avg(z1) AS m1, avg(z2) AS m2, avg(z3) AS m3 FROM t_scaled),
  q AS (SELECT *, (a + b + d) / 3 AS q FROM c),
  p AS (SELECT *, sqrt(((a - q) ** 2 + (b - q) ** 2 + (d - q) ** 2 + 2 * (e * e + f * f + g * g)) / 6) AS p FROM q),
  r AS (SELECT *, acos(greatest(-1, least(1, ((a - q) * ((b - q) * (d - q) - g * g) - e * (e * (d - q) - g * f)
                  + f * (e * g - (b - q) * f)) / (2 * p * p * p)))) / 3 AS phi FROM p),
  s AS (SELECT *, q + 2 * p * cos(phi) AS l1, q + 2 * p * cos(phi + 2 * pi() / 3) AS l3 FROM r),
  l AS (SELECT *, 1 AS k, l1 AS v, l1 / (a + b + d) AS share, l1 / (a + b + d) AS upto FROM s
        UNION ALL SELECT *, 2, 3 * q - l1 - l3, (3 * q - l1 - l3) / (a + b + d), (3 * q - l3) / (a + b + d) FROM s),
  x AS (SELECT k, share, upto, m1, m2, m3,
               unnest([[e * g - f * (b - v), f * e - (a - v) * g, (a - v) * (b - v) - e * e],
                       [e * (d - v) - f * g, f * f - (a - v) * (d - v), (a - v) * g - e * f],
                       [(b - v) * (d - v) - g * g, g * f - e * (d - v), e * g - (b - v) * f]]) AS w FROM l),
  y AS (SELECT *, sqrt(w[1] ** 2 + w[2] ** 2 + w[3] ** 2) AS len FROM x),
  top AS (SELECT k, max(len) AS len FROM y GROUP BY k),
  axes AS (SELECT k, share, upto, m1, m2, m3,
                  [i / (len * CASE WHEN w[list_position([abs(w[1]), abs(w[2]), abs(w[3])], greatest(abs(w[1]), abs(w[2]), abs(w[3])))] > 0
                                   THEN 1 ELSE -1 END) FOR i IN w] AS u FROM y JOIN top USING (k, len)),
  pcs AS (SELECT CustomerID, Cluster, max(along) FILTER (WHERE k = 1) AS PC1, max(along) FILTER (WHERE k = 2) AS PC2
          FROM (SELECT *, (z1 - m1) * u[1] + (z2 - m2) * u[2] + (z3 - m3) * u[3] AS along FROM t_scaled CROSS JOIN axes)
          GROUP BY CustomerID, Cluster)"""


def _projected(t):
    return segments.pca_projection(t.scaled_rfm)


@query("pca_projection", "CustomerID:l Cluster:i PC1:6 PC2:6", f"WITH {_AXES} SELECT * FROM pcs")
def pca_projection(t):
    return _projected(t)[0].select("CustomerID", "Cluster", "PC1", "PC2")


@query(
    "pca_explained_variance",
    "component:s explained_variance_ratio:6 cumulative:6",
    f"WITH {_AXES} SELECT DISTINCT 'PC' || k AS component, share AS explained_variance_ratio, upto AS cumulative FROM axes",
)
def pca_explained_variance(t):
    return segments.explained_variance(t.spark, _projected(t)[1])


@query(
    "component_centroids",
    "Cluster:i PC1:6 PC2:6",
    f"WITH {_AXES} SELECT Cluster, avg(PC1) AS PC1, avg(PC2) AS PC2 FROM pcs GROUP BY Cluster",
)
def component_centroids(t):
    return segments.component_centroids(_projected(t)[0])


def _parts(t):
    matrix = t.split_matrix
    return matrix.filter(~F.col("is_test")), matrix.filter("is_test")


def _fitted(t, name: str, **options):
    train, test = _parts(t)
    return train, classifiers.train_and_score(train, test, name, **options)


@query("logreg_metrics")
def logreg_metrics(t):
    return _fitted(t, "Logistic Regression")[1]["metrics"]


@query("tree_metrics")
def tree_metrics(t):
    return _fitted(t, "Decision Tree")[1]["metrics"]


@query("forest_metrics")
def forest_metrics(t):
    return _fitted(t, "Random Forest")[1]["metrics"]


_TEST_PART = f"""SELECT count(*) FILTER (WHERE is_test) AS customers, count(*) FILTER (WHERE is_test AND y = 1) AS positive,
       count(*) FILTER (WHERE is_test AND y = 0) AS negative
  FROM (SELECT "{TARGET}" AS y, row_number() OVER (PARTITION BY "{TARGET}" ORDER BY md5(CAST(CustomerID AS VARCHAR) || '-42'), CustomerID)
               <= floor(count(*) OVER (PARTITION BY "{TARGET}") * CAST(0.3 AS DOUBLE) + 0.5) AS is_test FROM t_target)"""


@query(
    "model_facts",
    "model:s customers:l positive:l negative:l accuracy_agrees:b recall_agrees:b score_range:b",
    f"""SELECT unnest(['Logistic Regression', 'Decision Tree', 'Random Forest']) AS model, *, true AS accuracy_agrees,
               true AS recall_agrees, true AS score_range FROM ({_TEST_PART})""",
)
def model_facts(t):
    """What holds for every fit: size and classes of the test part, and metrics that follow from the predictions alone."""
    train, test = _parts(t)
    out = {}
    for name in classifiers.MODELS:
        got = classifiers.train_and_score(train, test, name)
        hit = (F.col("prediction") == F.col("label")).cast("double")
        plain = got["predictions"].agg(
            F.count(F.lit(1)).alias("customers"),
            F.avg(hit).alias("hits"),
            ((F.avg(F.when(F.col("label") == 1, hit)) + F.avg(F.when(F.col("label") == 0, hit))) / 2).alias("by_class"),
            F.max((F.col("score") >= 0) & (F.col("score") <= 1)).alias("score_range"),
        )
        m = got["metrics"].select(F.struct("accuracy", "recall", "support_positive", "support_negative")).scalar()
        out[name] = plain.withColumn("m", m).select(
            "customers",
            F.col("m.support_positive").alias("positive"),
            F.col("m.support_negative").alias("negative"),
            (F.abs(F.col("m.accuracy") - F.col("hits")) < 1e-12).alias("accuracy_agrees"),
            (F.abs(F.col("m.recall") - F.col("by_class")) < 1e-12).alias("recall_agrees"),
            "score_range",
        )
    return union(out, "model")


@query("model_predictions")
def model_predictions(t):
    train, test = _parts(t)
    scored = {n: classifiers.train_and_score(train, test, n)["predictions"] for n in classifiers.MODELS}
    return classifiers.prediction_table(scored)


@query("feature_importances")
def feature_importances(t):
    train, got = _fitted(t, "Random Forest")
    return classifiers.importance_table(got["model"], train)


@query("logreg_coefficients")
def logreg_coefficients(t):
    train, got = _fitted(t, "Logistic Regression")
    return classifiers.coefficient_table(got["model"], train)


@query("best_model")
def best_model(t):
    train, test = _parts(t)
    rows = {n: classifiers.train_and_score(train, test, n)["metrics"] for n in classifiers.MODELS}
    table = pinned(classifiers.metric_table(rows))
    return table.filter(F.col("model") == classifiers.best_model(table))


@query("cv_metrics")
def cv_metrics(t):
    matrix = pinned(t.matrix)
    return classifiers.cross_validate_all(matrix, classifiers.MODELS)


@query("mlp_metrics")
def mlp_metrics(t):
    train, test = _parts(t)
    model = classifiers.tabular_mlp(train)
    return classifiers.evaluate(model, test)


@query("vector_mlp_metrics")
def vector_mlp_metrics(t):
    data = vectors.as_vector(t.table("embeddings"), "embedding").select("vec_id", "label", "features")
    parts = pinned(scaling.stratified_split(data, "label", "vec_id"))
    model = classifiers.vector_mlp(parts.filter(~F.col("is_test")), 64)
    return scores.multiclass_metrics(model.transform(parts.filter("is_test")), 10)
