import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tillroll.operators import classifiers, narrative, scaling, scores, segments, vectors
from tillroll.operators.customers import rfm_means
from tillroll.plans.prediction import labelled_customers
from tillroll.schema import TARGET
from tillroll.session import pinned


def test_scaling(spark):
    df = spark.createDataFrame([(float(i), 7.0, i) for i in range(1, 6)], "x double, same double, CustomerID long")
    out = scaling.scale_numeric(df, ["x", "same", "CustomerID", "absent"])
    assert "CustomerID_Scaled" not in out.columns
    row = out.agg(F.avg("x_Scaled"), F.stddev_pop("x_Scaled"), F.max(F.abs("same_Scaled"))).first()
    assert row[0] == pytest.approx(0) and row[1] == pytest.approx(1) and row[2] == 0
    small = scaling.scale_numeric(df, ["x", "same"], "minmax").agg(F.min("x_Scaled"), F.max("x_Scaled"), F.max("same_Scaled"))
    assert tuple(small.first()) == (0.0, 1.0, 0.0)
    with pytest.raises(ValueError):
        scaling.scale_numeric(df, ["x"], "other")


def test_encoding(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "c string")
    codes = {r.c: r.c_Encoded for r in scaling.encode_categorical(df, ["c"]).collect()}
    assert codes == {"a": 0, "b": 1, None: 2}
    hot = {(r.c, r.c_OneHot.size, *r.c_OneHot.indices, *r.c_OneHot["values"]) for r in scaling.encode_categorical(df, ["c"], "onehot").collect()}
    assert hot == {("a", 3, 0, 1.0), ("b", 3, 1, 1.0), (None, 3, 2, 1.0)}
    wide = scaling.encode_onehot(df, ["c"], wide={"c": ["b", "z"]})
    assert wide.columns == ["c", "c_b", "c_z"] and wide.filter("c_b").count() == 2 and wide.filter("c_z").count() == 0
    with pytest.raises(ValueError):
        scaling.encode_categorical(df, ["c"], "other")


def test_encoding_of_many_levels(spark):
    df = spark.range(60_000).select(F.when(F.col("id") < 50_000, F.format_string("v%05d", "id")).otherwise("v00007").alias("c"))
    got = scaling.encode_onehot(df, ["c"]).select("c", "c_OneHot.size", F.col("c_OneHot.indices")[0].alias("i"))
    wrong = F.col("i") != F.substring("c", 2, 5).cast("int")
    assert tuple(got.agg(F.count("i"), F.count_if(wrong), F.min("size"), F.max("size")).first()) == (60_000, 0, 50_000, 50_000)


def test_unknown_category_is_all_zeros(spark):
    train = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (4.0, "a")], "n double, c string")
    fitted = scaling.feature_pipeline(["n"], ["c"]).fit(train)
    new = spark.createDataFrame([(2.0, "zzz")], "n double, c string")
    v = fitted.transform(new).first().features
    assert len(v) == 3 and list(v.toArray())[1:] == [0.0, 0.0]
    with pytest.raises(ValueError):
        scaling.feature_stages([], [])


def test_split_and_folds_keep_the_classes(spark):
    df = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "id long, y int")
    parts = scaling.stratified_split(df, "y", "id")
    counts = {(r.y, r.is_test): r["count"] for r in parts.groupBy("y", "is_test").count().collect()}
    assert counts == {(1, True): 15, (1, False): 35, (0, True): 45, (0, False): 105}
    again = scaling.stratified_split(df.repartition(7), "y", "id")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, parts.collect()))
    folds = scaling.stratified_folds(df, "y", "id").groupBy("y", "fold").count().collect()
    assert all(r["count"] == (10 if r.y else 30) for r in folds) and len(folds) == 10


def labelled(rng, n=120):
    y = rng.integers(0, 2, n)
    s = np.round(np.clip(0.5 * y + rng.normal(0.25, 0.3, n), 0, 1), 1)
    return [(int(a), float(b), int(b >= 0.5)) for a, b in zip(y, s)]


def test_scores_against_brute_force(spark):
    rows = labelled(np.random.default_rng(5))
    df = spark.createDataFrame(rows, "label int, score double, prediction int")
    got = scores.classifier_metrics(df).first()
    y, s, p = (np.array(v) for v in zip(*rows))
    wins = [(a > b) + 0.5 * (a == b) for a in s[y == 1] for b in s[y == 0]]
    assert got.roc_auc == pytest.approx(np.mean(wins)) and got.accuracy == pytest.approx(np.mean(y == p))
    f1 = [2 * np.sum((y == c) & (p == c)) / (np.sum(y == c) + np.sum(p == c)) for c in (0, 1)]
    assert got.f1 == pytest.approx(np.mean(f1))
    points = scores.pr_points(df).orderBy(F.desc("threshold")).collect()
    assert (points[0].threshold, points[0].precision, points[0].recall) == (float("inf"), 1.0, 0.0)
    points = points[1:]
    top = max(s)
    assert points[0].precision == pytest.approx(np.mean(y[s == top])) and points[-1].recall == 1.0
    curve = scores.roc_points(df).orderBy("fpr", "tpr").collect()
    assert (curve[0].threshold, curve[0].fpr, curve[0].tpr) == (float("inf"), 0.0, 0.0)
    fpr, tpr = [r.fpr for r in curve], [r.tpr for r in curve]
    assert np.trapezoid(tpr, fpr) == pytest.approx(got.roc_auc)
    recall, precision = [0.0] + [r.recall for r in points], [1.0] + [r.precision for r in points]
    assert scores.pr_auc(df).first().pr_auc == pytest.approx(np.trapezoid(precision, recall))
    loss = -np.mean(np.log(np.where(y == 1, np.clip(s, 1e-7, 1 - 1e-7), 1 - np.clip(s, 1e-7, 1 - 1e-7))))
    assert scores.log_loss(df).first().log_loss == pytest.approx(loss)


def test_perfect_scores_and_single_class(spark):
    df = spark.createDataFrame([(0, 0.1, 0), (0, 0.2, 0), (1, 0.9, 1)], "label int, score double, prediction int")
    got = scores.classifier_metrics(df).first()
    assert got.roc_auc == 1.0 and got.f1 == 1.0 and got.imbalance_ratio_neg_to_pos == 2.0
    assert scores.classifier_metrics(df.filter("label = 0")).first().roc_auc is None
    matrix = {(r.actual, r.predicted): r["count"] for r in scores.confusion_matrix(df, n_classes=3).collect()}
    assert len(matrix) == 9 and matrix[0, 0] == 2 and matrix[2, 2] == 0
    wide = scores.confusion_pivot(scores.confusion_matrix(df, n_classes=3), 3)
    assert wide.count() == 3 and wide.columns == ["actual", "pred_0", "pred_1", "pred_2"]
    many = scores.multiclass_metrics(df, 10).first()
    assert many.n_samples == 3 and len(many.per_class_f1) == 10 and many.f1_weighted == 1.0


def test_class_tables(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (2,)], "label int")
    balance = {r.label: (r["count"], r.percentage) for r in scores.class_balance(df, "label", 4).collect()}
    assert balance == {0: (3, 75.0), 1: (0, 0.0), 2: (1, 25.0), 3: (0, 0.0)}
    assert {r.label: r.weight for r in scores.class_weights(df).collect()} == {0: pytest.approx(2 / 3), 2: 2.0}


def test_vectors(spark):
    image = [[i % 256 for i in range(28)] for _ in range(28)]
    df = spark.createDataFrame([(image, 3), (image, 0)], "image array<array<int>>, label int")
    row = vectors.normalise(df, "image", depth=2).first()
    assert len(row.pixels) == 784 and 0 <= min(row.pixels) and max(row.pixels) <= 1
    hot = vectors.onehot_label(df, "label", 10).first().onehot
    assert sum(hot) == 1 and hot[3] == 1
    assert vectors.validate_shapes(df, "image", "label", (28, 28), 10)
    with pytest.raises(ValueError):
        vectors.validate_shapes(df, "image", "label", (28, 28), 3)
    with pytest.raises(ValueError):
        vectors.validate_shapes(df.select(F.slice("image", 1, 5).alias("image"), "label"), "image", "label", (28, 28), 10)
    tie = spark.createDataFrame([([1.0, 5.0, 5.0],)], "s array<double>")
    assert vectors.add_argmax(tie, "s").first().predicted_class == 1
    proba = spark.createDataFrame([([0.5, 0.5], 0), ([0.25, 0.75], 1)], "p array<double>, y int")
    assert scores.vector_log_loss(proba, "y", "p").first()[0] == pytest.approx(-(np.log(0.5) + np.log(0.75)) / 2)


def brute_silhouette(x, labels, square):
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    d = d if square else np.sqrt(d)
    out = []
    for i, own in enumerate(labels):
        same = labels == own
        if same.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, same].sum() / (same.sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels) - {own})
        out.append((b - a) / max(a, b))
    return np.mean(out)


def test_cluster_quality_against_brute_force(spark, blobs):
    extra = spark.createDataFrame([(99, 3, 9.0, 9.0, 9.0)], "id long, label long, x double, y double, z double")
    df = blobs.drop("features").unionByName(extra).union(blobs.drop("features").limit(5))
    rows = df.collect()
    x, labels = np.array([(r.x, r.y, r.z) for r in rows]), np.array([r.label for r in rows])
    names = ["x", "y", "z"]
    for metric in ("squaredEuclidean", "euclidean"):
        got = segments.silhouette(df, names, "label", metric).first()[0]
        assert got == pytest.approx(brute_silhouette(x, labels, metric == "squaredEuclidean"))
    small = segments._euclidean_silhouette(df, names, "label", rows_per_block=7).first()[0]
    assert small == pytest.approx(brute_silhouette(x, labels, False))
    centres = {c: x[labels == c].mean(0) for c in set(labels)}
    within = sum(((x[labels == c] - m) ** 2).sum() for c, m in centres.items())
    between = sum((labels == c).sum() * ((m - x.mean(0)) ** 2).sum() for c, m in centres.items())
    want = (between / 3) / (within / (len(x) - 4))
    assert segments.calinski_harabasz(df, names, "label").first()[0] == pytest.approx(want)
    s = {c: np.sqrt(((x[labels == c] - m) ** 2).sum(1)).mean() for c, m in centres.items()}
    worst = [max((s[a] + s[b]) / np.linalg.norm(centres[a] - centres[b]) for b in centres if b != a) for a in centres]
    assert segments.davies_bouldin(df, names, "label").first()[0] == pytest.approx(np.mean(worst))
    with pytest.raises(ValueError):
        segments.clustering_metrics(df.filter("label = 0"), names, "label")


def test_distance_sums_cross_tiles_and_clusters():
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(3, 150)), rng.normal(size=(3, 1300))
    wx, wy = rng.integers(1, 4, 150).astype(float), rng.integers(1, 4, 1300).astype(float)
    d = np.sqrt(((x[:, :, None] - y[:, None]) ** 2).sum(0))
    to_y, to_x = segments.distance_sums(x, [0, 70, 150], wx, y, [0, 600, 601, 1300], wy)
    assert to_y == pytest.approx(np.stack([d[:, a:b] @ wy[a:b] for a, b in ((0, 600), (600, 601), (601, 1300))], 1))
    assert to_x == pytest.approx(np.stack([wx[a:b] @ d[a:b] for a, b in ((0, 70), (70, 150))], 1))


def test_euclidean_silhouette_sends_a_point_once_a_block(spark):
    """Blocks were of 4,096 points and every ordered pair of blocks was a group with both sides in it."""
    assert segments.block_count(700_000, 12, segments.BLOCK_ROWS) == 22
    assert segments.block_count(50, 12, segments.BLOCK_ROWS) == 1 and segments.block_count(0, 12, 7) == 1
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 2)).round(3)
    labels = rng.choice(["a", "b", "c"], 3000, p=[0.01, 0.19, 0.8])
    df = spark.createDataFrame(pd.DataFrame({"x": x[:, 0], "y": x[:, 1], "label": labels}))
    whole = segments.silhouette(df, ["x", "y"], "label", "euclidean").first()[0]
    assert whole == pytest.approx(brute_silhouette(x, labels, False))
    sent = segments._euclidean_silhouette(df, ["x", "y"], "label", rows_per_block=1000)
    plan = sent._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroups" not in plan and sent.first()[0] == pytest.approx(whole)


def test_euclidean_silhouette_counts_rows_without_cluster(spark):
    rows = [(0.0, "a"), (1.0, "a"), (5.0, "b"), (6.0, "b"), (3.0, None)]
    df = spark.createDataFrame(rows, "x double, label string")
    four = segments.silhouette(df.dropna(), ["x"], "label", "euclidean").first()[0]
    assert segments.silhouette(df, ["x"], "label", "euclidean").first()[0] == pytest.approx(four * 4 / 5)


def test_kmeans(blobs):
    sweep = segments.kmeans_sweep(blobs, k_values=(2, 3, 4), n_init=2)
    rows = sweep.orderBy("k").collect()
    assert rows[0].inertia > rows[1].inertia > rows[2].inertia and segments.best_k(sweep) == 3
    labels = segments.kmeans_labels(blobs, 3, n_init=2).select("id", "Cluster").collect()
    again = segments.kmeans_labels(blobs, 3, n_init=2).select("id", "Cluster").collect()
    assert sorted(labels) == sorted(again) and len({r.Cluster for r in labels}) == 3
    with pytest.raises(ValueError):
        segments.fit_kmeans(blobs, 1)
    with pytest.raises(ValueError):
        segments.fit_kmeans(blobs, 3, features="x")
    projected, ratios = segments.pca_projection(blobs)
    assert {"PC1", "PC2"} <= set(projected.columns)
    x = np.array([r.features.toArray() for r in projected.collect()])
    _, size, axes = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    assert ratios == pytest.approx(list((size**2 / (size**2).sum())[:2]))
    got = np.array([(r.PC1, r.PC2) for r in projected.collect()])
    assert np.allclose(np.abs(got), np.abs((x - x.mean(axis=0)) @ axes[:2].T))


def test_model_summary(spark):
    metrics = dict(accuracy=0.75, precision=0.5, recall=0.25, f1=0.125, roc_auc=0.8)
    weights = spark.createDataFrame([("a", 0.1), ("b", 0.5), ("c", 0.3), ("d", 0.1)], "feature string, importance double")
    text = narrative.model_summary(metrics, weights)
    assert "accuracy 0.750" in text and "ROC-AUC 0.800" in text and text.endswith("b (0.5000), c (0.3000), a (0.1000).")
    assert "Strongest" not in narrative.model_summary(metrics, weights.limit(0))


def test_shared_passes_equal_single_fits(spark, blobs):
    x = np.array([r.features.toArray() for r in blobs.collect()])
    points = blobs.select(vector_to_array("features").alias("x")).repartition(3)
    starts = [x[[0, 1, 2]], x[[0, 20, 40]], x[[5, 6]], x[[3, 17, 33, 44]]]
    together = segments.lloyd(points, starts)
    for start, got in zip(starts, together):
        alone = segments.lloyd(points, [start])[0]
        assert np.allclose(alone.centres, got.centres) and alone.cost == pytest.approx(got.cost)
        c = start.copy()
        for _ in range(100):
            near = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
            c = np.array([x[near == j].mean(0) if (near == j).any() else c[j] for j in range(len(c))])
        assert np.allclose(c, got.centres, atol=1e-3)
        assert got.cost == pytest.approx(((x[:, None] - got.centres[None]) ** 2).sum(2).min(1).sum())
        labels = [r.Cluster for r in got.label(blobs).orderBy("id").collect()]
        assert labels == ((x[:, None] - got.centres[None]) ** 2).sum(2).argmin(1).tolist()
    best = segments.fit_kmeans(blobs, 3)
    singles = segments.lloyd(points, segments.starting_centres(points.persist(), [(3, 42 + i) for i in range(10)]))
    assert best.cost == pytest.approx(min(m.cost for m in singles))
    with pytest.raises(ValueError):
        segments.fit_kmeans(blobs.limit(2), 3)


def test_profiles_and_texts(spark):
    rows = [(i, 5 + i % 10 + 40 * (i // 10), 1 + i // 10, 10.0 * (1 + i // 10) + i, i // 10) for i in range(30)]
    table = spark.createDataFrame(rows, "CustomerID long, Recency long, Frequency long, Monetary double, Cluster int")
    profiles = pinned(segments.cluster_profiles(table))
    assert profiles.columns == segments.PROFILE_COLUMNS
    got = profiles.collect()
    assert sum(r.pct_of_customers for r in got) == pytest.approx(100) and sum(r.pct_of_total_revenue for r in got) == pytest.approx(100)
    assert got[0].median_recency == 9.5
    assert segments.rank_clusters(profiles).first().cluster == 2
    with pytest.raises(ValueError):
        segments.rank_clusters(profiles.drop("mean_monetary"), by_total=False)
    assert segments.cluster_minmax(profiles).orderBy("cluster").first().Recency_scaled == 0.0
    z = segments.cluster_zscores(profiles, table).orderBy("cluster").collect()
    assert z[0].Recency_z < 0 < z[2].Recency_z
    text = {r.cluster: r for r in narrative.cluster_descriptions(profiles, rfm_means(table)).collect()}
    assert text[0].recency_label == "recent" and text[2].frequency_label == "high-frequency"
    assert "10 customers (33.3%)" in text[1].description
    facts = narrative.cluster_facts(profiles).first()
    assert (facts.clusters, facts.top_cluster, facts.bottom_cluster) == (3, 2, 0)
    advice = narrative.recommendations(narrative.recommendation_facts(profiles))
    assert len(advice) >= 5 and len(set(advice)) == len(advice)
    assert narrative.recommendations(None) == []
    quality = {"silhouette_score": 0.5, "calinski_harabasz_score": 10.0, "davies_bouldin_score": 0.4}
    assert "Cluster 2 brings most revenue" in narrative.segment_summary(quality, profiles)
    models = narrative.model_facts(spark, "Random Forest", {"roc_auc": 0.72, "f1": 0.6}, 3, quality, [("a", 0.4), ("b", 0.2)], 0.7)
    assert {r.topic: r.value for r in models.collect()}["outreach_pct"] == 24


@pytest.fixture(scope="module")
def matrix(buyers):
    return pinned(scaling.stratified_split(pinned(labelled_customers(buyers)), TARGET))


def test_classifiers(matrix):
    train, test = matrix.filter(~F.col("is_test")), matrix.filter("is_test")
    results = {}
    for name in classifiers.MODELS:
        options = {"trees": 5} if name == "Random Forest" else {}
        results[name] = classifiers.train_and_score(train, test, name, **options)
        got = results[name]["metrics"].first()
        assert 0 <= got.accuracy <= 1 and 0 <= got.roc_auc <= 1 and got.support_positive == 6
        assert results[name]["confusion_matrix"].agg(F.sum("count")).first()[0] == 12
    table = classifiers.prediction_table({n: r["predictions"] for n, r in results.items()})
    assert table.count() == 12 and "random_forest_probability" in table.columns
    metrics = classifiers.metric_table({n: r["metrics"] for n, r in results.items()})
    assert classifiers.best_model(metrics) in classifiers.MODELS
    importances = classifiers.importance_table(results["Random Forest"]["model"], train).collect()
    assert sum(r.importance for r in importances) == pytest.approx(1)
    assert {"Recency", "Country_UK"} <= {r.feature for r in importances}
    coefficients = classifiers.coefficient_table(results["Logistic Regression"]["model"], train, 3).collect()
    assert abs(coefficients[0].coefficient) >= abs(coefficients[2].coefficient)
    first = results["Random Forest"]["predictions"].orderBy("CustomerID").select("score").collect()
    again = classifiers.train_and_score(train, test, "Random Forest", trees=5)["predictions"]
    assert again.orderBy("CustomerID").select("score").collect() == first


def test_cross_validation(matrix):
    rows = classifiers.cross_validate(matrix.drop("is_test"), classifiers.decision_tree).collect()
    assert [r.fold for r in rows] == ["1", "2", "3", "4", "5", "overall"]
    values = [r.accuracy for r in rows[:5]]
    both = classifiers.cross_validate_all(matrix.drop("is_test"), {"tree": classifiers.decision_tree, "line": classifiers.logistic_regression})
    assert both.filter("model = 'tree' and fold <> 'overall'").orderBy("fold").select("accuracy").collect() == [(v,) for v in values]
    assert both.count() == 12
    assert rows[5].accuracy_mean == pytest.approx(np.mean(values)) and rows[5].accuracy_std == pytest.approx(np.std(values))


def test_perceptrons(matrix, blobs):
    train, test = matrix.filter(~F.col("is_test")), matrix.filter("is_test")
    got = classifiers.evaluate(classifiers.tabular_mlp(train, hidden=(4,), max_iter=20), test).first()
    assert 0 <= got.roc_auc <= 1
    net = classifiers.vector_mlp(blobs, 3, n_classes=3, hidden=(6,), max_iter=60)
    assert net.transform(blobs).filter("prediction = label").count() >= 43


def test_feature_vectors_use_the_population_deviation(spark):
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F
    from tillroll.operators import scaling

    rows = spark.createDataFrame([(float(v), "A") for v in (1, 2, 3, 4, 5)], "x double, c string")
    stages = scaling.feature_pipeline(["x"], ["c"]).fit(rows)
    first = stages.transform(rows).select(vector_to_array("features")[0].alias("z"))
    mean, deviation = first.agg(F.avg("z"), F.stddev_pop("z")).first()
    assert abs(mean) < 1e-12 and abs(deviation - 1) < 1e-12


def test_nearest_centres_equal_plain_distances():
    """Points go to the first nearest centre of each model, with the distances of the plain formula."""
    import numpy as np
    from tillroll.operators.segments import _nearest

    rng = np.random.default_rng(1)
    x, centres, cuts = rng.normal(size=(500, 3)), rng.normal(size=(9, 3)), np.array([0, 4, 9])
    centres[6] = centres[5]
    for i, place, away in _nearest(np.ascontiguousarray(x.T), centres, cuts):
        plain = np.stack([((x - c) ** 2).sum(axis=1) for c in centres[cuts[i] : cuts[i + 1]]], axis=1)
        assert (place == plain.argmin(axis=1)).all() and (away == plain.min(axis=1)).all()


def forest_rows(spark, n=1500, seed=8):
    from pyspark.ml.functions import array_to_vector

    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 5)), 2)
    y = (rng.random(n) < 1 / (1 + np.exp(-3 * (x[:, 0] + x[:, 1] * x[:, 2])))).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"key": np.arange(n), "label": y, "x": x.tolist()}))
    return df.select("key", "label", F.when(F.col("label") == 1, 2.0).otherwise(0.5).alias("weight"), array_to_vector("x").alias("features"))


def test_own_forest_follows_sparks_rules(spark):
    from tillroll.operators import forest

    rows = forest_rows(spark)
    train, held = rows.filter("key % 5 > 0"), rows.filter("key % 5 = 0")
    model = classifiers.random_forest(0, trees=40)
    assert forest.supports(model, [0.0, 1.0]) and not forest.supports(model, [0.0, 2.0])
    assert not forest.supports(classifiers.decision_tree(), [0.0, 1.0]) and not forest.supports(model.copy({model.maxBins: 300}), [0.0, 1.0])
    own, theirs = forest.fit_forest(train, model, "key"), model.fit(train)
    nodes = np.mean([(t.left != np.arange(len(t.left))).sum() * 2 + 1 for t in own.trees])
    assert nodes == pytest.approx(np.mean([t.numNodes for t in theirs.trees]), rel=0.15)
    a = own.predict(held)
    b = theirs.transform(held).withColumn("score", vector_to_array("probability")[1])
    for got, want in zip(scores.classifier_metrics(a).first()[:4], scores.classifier_metrics(b).first()[:4]):
        assert got == pytest.approx(want, abs=0.06)
    again = forest.fit_forest(train.repartition(7), model, "key")
    assert all((s.left == t.left).all() and (s.cut == t.cut).all() for s, t in zip(own.trees, again.trees))  # partitions don't matter


def test_forest_splits_equal_brute_force():
    from tillroll.operators import forest

    rng = np.random.default_rng(4)
    sizes, weights, fewest = np.array([4, 2, 6]), np.array([0.5, 2.0]), 3
    x, y, w = np.stack([rng.integers(0, s, 200) for s in sizes]).astype(np.uint8), rng.integers(0, 2, 200), forest.draws(rng.integers(0, 2**62, 200).astype(np.uint64), 1, 0)
    sub = np.array([[0, 2], [1, 2]])
    node = rng.integers(0, 2, 200)
    base, cells = forest._layout(sub, sizes)
    count = np.zeros(2 * cells, np.int64)
    for i in range(200):
        for j in range(2):
            count[2 * (base[node[i], j] + x[sub[node[i], j], i]) + y[i]] += w[i]

    def gini(rows):
        share = np.array([(w[rows] * (y[rows] == c)).sum() * weights[c] for c in (0, 1)])
        return share.sum(), share.sum() - (share**2).sum() / max(share.sum(), 1e-9)

    feature, cut, left, right = forest.best_splits(count, sub, sizes, weights, fewest)
    for a in (0, 1):
        mine, best = node == a, (0.0, None)
        for f in sub[a]:
            for c in range(sizes[f] - 1):
                low, high = mine & (x[f] <= c), mine & (x[f] > c)
                if w[low].sum() >= fewest and w[high].sum() >= fewest:
                    best = max(best, ((gini(mine)[1] - gini(low)[1] - gini(high)[1]) / gini(mine)[0], (f, c, w[low].sum(), w[high].sum())))
        assert best[1] == (feature[a], cut[a], left[a].sum(), right[a].sum())


def test_a_tree_without_draws_has_no_vote(spark):
    from tillroll.operators import forest

    one = forest_rows(spark, 50).filter("label = 1").limit(1)
    fitted = forest.fit_forest(one, classifiers.random_forest(0, trees=8), "key")
    assert 0 < sum(t.count[0].any() for t in fitted.trees) < 8 and fitted.predict(one).first().score == 1


def test_forest_draws_and_cuts():
    from tillroll.operators import forest

    keys = np.random.default_rng(2).integers(0, 2**63, 100_000).astype(np.uint64)
    a, b = forest.draws(keys, 42, 0).astype(float), forest.draws(keys, 42, 1).astype(float)
    assert a.mean() == pytest.approx(1, abs=0.02) and a.var() == pytest.approx(1, abs=0.03) and abs(np.corrcoef(a, b)[0, 1]) < 0.02
    assert forest.cuts_of(np.array([1.0, 1.0, 3.0, np.nan]), np.ones(4), 32).tolist() == [2.0]
    assert len(forest.cuts_of(np.arange(1000.0), np.ones(1000), 32)) == 31
    # Node 0 splits; both children vote for class 1 and become one leaf.
    tree = forest.Tree(np.zeros(3, np.uint16), np.array([1, 255, 255], np.uint8), np.array([1, 1, 2], np.int32), np.array([[3, 7], [1, 3], [2, 4]]), np.zeros(0, np.int64))
    forest._prune(tree, np.ones(2))
    assert tree.left.tolist() == [0, 1, 2] and tree.cut[0] == 255


def test_cross_validation_grows_its_own_forests(matrix, monkeypatch):
    """Spark's forest passes over the rows took too long; features were prepared anew for each model."""
    from pyspark.ml.classification import RandomForestClassifier

    def refuse(*args):
        raise AssertionError("Spark's forest")

    monkeypatch.setattr(RandomForestClassifier, "_fit", refuse)
    rows = classifiers.cross_validate(matrix.drop("is_test"), classifiers.random_forest, trees=5).collect()
    assert [r.fold for r in rows] == ["1", "2", "3", "4", "5", "overall"] and all(0 <= r.accuracy <= 1 for r in rows[:5])


def test_distance_sums_of_near_points_far_from_the_middle():
    """Squares from a product lose the digits of near points; a value that is not finite must not spoil the others."""
    rng = np.random.default_rng(9)
    x = np.concatenate([1e6 + rng.normal(size=(3, 90)) * 1e-3, rng.normal(size=(3, 60))], axis=1)
    y = np.concatenate([x[:, :90], 1e6 + rng.normal(size=(3, 500)), rng.normal(size=(3, 700)) * 1e-4], axis=1)
    wx, wy = np.ones(150), rng.integers(1, 4, 1290).astype(float)
    d = np.sqrt(((x[:, :, None] - y[:, None]) ** 2).sum(0))
    ends = ((0, 90), (90, 590), (590, 1290))
    to_y, to_x = segments.distance_sums(x, [0, 90, 150], wx, y, [0, 90, 590, 1290], wy)
    assert to_y == pytest.approx(np.stack([d[:, a:b] @ wy[a:b] for a, b in ends], 1), rel=1e-9)
    assert to_x == pytest.approx(np.stack([wx[a:b] @ d[a:b] for a, b in ((0, 90), (90, 150))], 1), rel=1e-9)
    y[0, 3] = np.inf
    far, _ = segments.distance_sums(x, [0, 90, 150], wx, y, [0, 90, 590, 1290], wy)
    assert far[:, 1:] == pytest.approx(to_y[:, 1:], rel=1e-9)


def test_euclidean_silhouette_takes_blocks_together(spark):
    """Sums left a task, and points were sent, once for each block; now once for SPAN blocks."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 2)).round(3)
    labels = rng.choice(["a", "b"], 3000)
    df = spark.createDataFrame(pd.DataFrame({"x": x[:, 0], "y": x[:, 1], "label": labels}))
    sent = segments._euclidean_silhouette(df, ["x", "y"], "label", rows_per_block=100)  # 30 blocks, 465 pairs
    plan = sent._jdf.queryExecution().optimizedPlan().toString()
    assert sent.first()[0] == pytest.approx(brute_silhouette(x, labels, False))
    assert "RepartitionByExpression [low" in plan and ", 36" in plan.split("RepartitionByExpression [low")[1].split("\n")[0]
