"""Metrics and synthesis that fit MLlib models; every model has a fixed seed."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA, QuantileDiscretizer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from quarrystone.functions.session import checkpointed
from quarrystone.operators import counted, folds as folded, mixture
from quarrystone.operators.clean import complete_cases, is_numeric
from quarrystone.operators.split import normal_hash, unit_hash


def _features(df: DataFrame, columns: list[str]) -> Pipeline:
    text = [c for c in columns if not is_numeric(df, c)]
    stages = [StringIndexer(inputCol=c, outputCol=f"_i_{c}", handleInvalid="keep", stringOrderType="alphabetAsc") for c in text]
    stages.append(VectorAssembler(inputCols=[f"_i_{c}" if c in text else c for c in columns], outputCol="_raw", handleInvalid="skip"))
    return Pipeline(stages=[*stages, StandardScaler(inputCol="_raw", outputCol="features", withMean=True)])


def learner(name: str, n_features: int, n_classes: int = 2):
    if name == "linear":
        return LogisticRegression(labelCol="label", maxIter=20)
    if name == "mlp":
        return MultilayerPerceptronClassifier(labelCol="label", layers=[n_features, 8, n_classes], maxIter=30, seed=7)
    if name == "forest":
        return RandomForestClassifier(labelCol="label", numTrees=20, maxDepth=5, seed=7)
    if name == "svm":
        svm = LinearSVC(labelCol="label", maxIter=20)
        return svm if n_classes == 2 else OneVsRest(classifier=svm, labelCol="label", parallelism=4)
    if name == "xgb":  # boosted trees are for two classes; more go one against the rest
        gbt = GBTClassifier(labelCol="label", maxIter=10, maxDepth=4, seed=7)
        return gbt if n_classes == 2 else OneVsRest(classifier=gbt, labelCol="label", parallelism=4)
    raise ValueError(f"unknown learner {name!r}")


def equal_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """The distinct rows of ``columns`` and _w, how many rows each stands for; few partitions, as a fit's many jobs visit each of them."""
    rows = df.groupBy(*columns).agg(F.count("*").cast("double").alias("_w"))
    return rows.coalesce(df.sparkSession.sparkContext.defaultParallelism)


def mean_auc(scored: DataFrame, n_classes: int) -> float:
    """Area under the ROC curve of ``probability``, or else ``rawPrediction``, for ``label``; of more than two classes the mean of each against the rest, as far as both are there.

    ``_w``, where it's there, says how many rows a row stands for.
    """
    weight = F.col("_w") if "_w" in scored.columns else F.lit(1.0)
    rows = scored.select("label", vector_to_array("probability" if "probability" in scored.columns else "rawPrediction").alias("_raw"), weight.alias("_w"))
    present = {int(r["label"]): r["n"] for r in rows.groupBy("label").agg(F.sum("_w").alias("n")).collect()}  # as many as classes
    total, found = sum(present.values()), []
    for k in [1] if n_classes == 2 else range(n_classes):
        if 0 < present.get(k, 0) < total:
            one = rows.select((F.col("label") == k).cast("double").alias("label"), F.get("_raw", F.lit(k)).alias("_s"), "_w")
            found.append(BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="_s", weightCol="_w").evaluate(one))
    return sum(found) / len(found) if found else float("nan")


#: Learners that take weights; equal rows are theirs once.
WEIGHTED = ("linear", "xgb")


def train_test_score(train: DataFrame, test: DataFrame, target: str, columns: list[str], name: str) -> DataFrame:
    """(learner, accuracy, f1, auc) of a model fitted on one table and judged on another; auc as ``mean_auc`` has it, null where only one class is there.

    Equal rows are judged once, weighted by their number, and fitted so by the learners that take weights.
    """
    index = StringIndexer(inputCol=target, outputCol="label", handleInvalid="skip", stringOrderType="alphabetAsc").fit(train)
    prep = _features(train, columns).fit(train)
    both = list(dict.fromkeys([*columns, target]))
    a, b = (index.transform(prep.transform(x)) for x in (equal_rows(train, both) if name in WEIGHTED else train, equal_rows(test, both)))
    model = learner(name, len(columns), len(index.labels))
    got = (model.setWeightCol("_w") if name in WEIGHTED else model).fit(a).transform(b)
    got = got.select("label", "prediction", "_w", *(c for c in ("probability", "rawPrediction") if c in got.columns)).persist()
    score = lambda m: round(MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=m, weightCol="_w").evaluate(got), 6)
    auc = round(mean_auc(got, len(index.labels)), 6)
    row = (name, score("accuracy"), score("f1"), None if auc != auc else auc)
    got.unpersist()
    return train.sparkSession.createDataFrame([row], "learner string, accuracy double, f1 double, auc double")


#: Quantile bins by which a classifier predicts a number.
NUMBER_BINS = 10


def _number_r2(name: str, known: DataFrame, asked: DataFrame, target: str, n_features: int, weight: str | None = None) -> float | None:
    """Share of a number's variance on ``asked`` that a model of ``known`` explains, at least 0; null if there is no variance.

    ``mlp`` classifies the known side's quantile bins and predicts their means by its probabilities, as there is no
    regressor of that kind. ``weight``: a column of ``known`` that boosted trees weigh its rows by.
    """
    y = F.col(target).cast("double")
    known, asked = known.filter(y.isNotNull()), asked.filter(y.isNotNull())
    if name == "mlp":
        bins = QuantileDiscretizer(numBuckets=NUMBER_BINS, inputCol="_y", outputCol="label", relativeError=0.001).fit(known.withColumn("_y", y))
        binned = bins.transform(known.withColumn("_y", y))
        n = len(bins.getSplits()) - 1
        means = {int(r["label"]): r["m"] for r in binned.groupBy("label").agg(F.avg("_y").alias("m")).collect()}  # NUMBER_BINS rows
        model = learner("mlp", n_features, n).fit(binned)
        weights = F.array(*(F.lit(float(means.get(i, 0.0))) for i in range(n)))
        guess = F.aggregate(F.zip_with(vector_to_array("probability"), weights, lambda p, m: p * m), F.lit(0.0), lambda s, x: s + x)
        got = model.transform(asked).select(y.alias("y"), guess.alias("g"))
    else:
        make = {"linear": lambda: LinearRegression(labelCol="_y", maxIter=20), "xgb": lambda: GBTRegressor(labelCol="_y", maxIter=10, maxDepth=4, seed=7)}[name]
        model = make().setWeightCol(weight) if weight else make()
        got = model.fit(known.withColumn("_y", y)).transform(asked).select(y.alias("y"), F.col("prediction").alias("g"))
    r = got.agg(F.var_pop("y").alias("v"), F.avg((F.col("y") - F.col("g")) * (F.col("y") - F.col("g"))).alias("e")).first()
    return None if not r["v"] else max(0.0, 1 - r["e"] / r["v"])


def spare_name(columns: list[str], name: str) -> str:
    """A name like ``name`` that no column has, in any case."""
    while name.lower() in {c.lower() for c in columns}:
        name = f"_{name}"
    return name


def data_leakage(syn: DataFrame, real: DataFrame, sensitive: list[str], columns: list[str], name: str = "linear") -> DataFrame:
    """(column, kind, learner, value): how well each sensitive column of real rows is told from all other columns by a model fitted on candidates.

    ``columns`` are the known ones; the other sensitive ones count as known, too. The value is the accuracy for a category
    and the explained share of variance for a number; null where candidates or real rows have no two values to tell apart.
    Texts are indexed once for all models. Rows with a null among the known numbers are left out. Boosted trees take
    equal rows of the candidates once, weighted by their number.
    """
    every = list(dict.fromkeys([*columns, *sensitive]))
    text = [c for c in every if not is_numeric(syn, c)]
    index = Pipeline(stages=[StringIndexer(inputCol=c, outputCol=f"_i_{c}", handleInvalid="keep", stringOrderType="alphabetAsc") for c in text]).fit(syn.select(*every))
    known, asked = (index.transform(x.select(*every)) for x in (syn, real))
    weight = spare_name(every, "_w") if name == "xgb" else None  # the other learners scale by rows or take no weights
    if weight:  # a cached plan keeps all its shuffle partitions, and each of the many jobs would visit them
        parts = max(known.sparkSession.sparkContext.defaultParallelism, known.rdd.getNumPartitions())
        known = known.repartition(parts, *known.columns).groupBy(*known.columns).agg(F.count("*").cast("double").alias(weight))
    known = known.persist()
    rows = []
    for target in sensitive:
        inputs = [f"_i_{c}" if c in text else c for c in every if c != target]
        prep = Pipeline(stages=[VectorAssembler(inputCols=inputs, outputCol="_raw", handleInvalid="skip"), StandardScaler(inputCol="_raw", outputCol="features", withMean=True)]).fit(known)
        a, b = (prep.transform(x) for x in (known, asked))
        if target not in text:
            value = _number_r2(name, a, b, target, len(inputs), weight) if a.select(target).distinct().limit(2).count() > 1 else None
            rows.append((target, "number", name, None if value is None else round(float(value), 6)))
            continue
        labels = StringIndexer(inputCol=target, outputCol="label", handleInvalid="skip", stringOrderType="alphabetAsc").fit(known)
        value = None
        if len(labels.labels) > 1:
            model = learner(name, len(inputs), len(labels.labels))
            got = (model.setWeightCol(weight) if weight else model).fit(labels.transform(a)).transform(labels.transform(b))
            value = got.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
        rows.append((target, "category", name, None if value is None else round(value, 6)))
    known.unpersist()
    return real.sparkSession.createDataFrame(rows, "column string, kind string, learner string, value double")


def hash_folds(df: DataFrame, key: str, folds: int = 5) -> DataFrame:
    """df with _fold, 0 to folds - 1, by a hash of the key."""
    return df.withColumn("_fold", F.floor(unit_hash(F.col(key).cast("string"), "folds") * folds).cast("int"))


def f1_difference(real: DataFrame, syn: DataFrame, target: str, columns: list[str], key: str, names: list[str], folds: int = 5) -> DataFrame:
    """(learner, f1_real, f1_syn, value): micro F1 of models fitted on real rows and on candidates, and real less candidates.

    Each hash fold of the real rows is predicted by models fitted on the other real rows and on the
    candidates' other folds; hits are counted over all folds. Micro F1 of single labels is the share of hits.
    Learners are "linear", "svm", "forest" and "xgb"; the models of all folds are fitted together (``folds``).
    Rows with a null among the numbers are told by none.
    """
    if unknown := set(names) - {"linear", "svm", "forest", "xgb"}:
        raise ValueError(f"unknown learners: {sorted(unknown)}")
    every = real.select(*columns, target).unionByName(syn.select(*columns, target))
    text = [c for c in columns if not is_numeric(real, c)]
    stages = [StringIndexer(inputCol=c, outputCol=f"_i_{c}", handleInvalid="keep", stringOrderType="alphabetAsc") for c in text]
    index = StringIndexer(inputCol=target, outputCol="label", stringOrderType="alphabetAsc")
    model = Pipeline(stages=[*stages, index]).fit(every)
    shape = folded.Shape(len(columns), len(model.stages[-1].labels), folds)

    def side(df: DataFrame, s: int) -> DataFrame:
        x = hash_folds(model.transform(df), key, folds)
        code = (F.col("label") * folds + F.col("_fold")).cast("int").alias("code")
        return x.select(F.lit(s).alias("side"), code, *(F.col(f"_i_{c}" if c in text else c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)))

    rows = complete_cases(side(real, 0).unionByName(side(syn, 1)))
    n, found = real.count(), folded.hits(rows, shape, names)
    share = lambda h: h / max(n, 1)
    rows = [(name, round(share(a), 6), round(share(b), 6), round(share(a) - share(b), 6)) for name, (a, b) in ((x, found[x]) for x in names)]
    return real.sparkSession.createDataFrame(rows, "learner string, f1_real double, f1_syn double, value double")


def log_density(df: DataFrame, n_features: int, k: int = 4):
    """A column function: the log density, but for a constant, of a Gaussian mixture fitted on df's features."""
    import numpy as np
    from pyspark.sql.functions import pandas_udf

    parts = [(w, mean, cov + 1e-6 * np.eye(n_features)) for w, mean, cov in mixture.fit(df, "features", k)[0]]

    @pandas_udf("double")
    def logp(v):
        import pandas as pd

        x, terms = np.stack(v), []
        for w, mu, cov in parts:
            d = x - mu
            q = np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)
            terms.append(np.log(max(w, 1e-12)) - 0.5 * (q + np.linalg.slogdet(cov)[1]))
        top = np.max(terms, axis=0)
        return pd.Series(top + np.log(np.exp(np.array(terms) - top).sum(axis=0)))

    return logp


def detection(real: DataFrame, syn: DataFrame, columns: list[str], key: str, name: str = "linear") -> DataFrame:
    """AUC of telling real from candidate rows, on a held-out third."""
    both = real.select(key, *columns, F.lit(0.0).alias("label")).unionByName(syn.select(key, *columns, F.lit(1.0).alias("label")))
    both = both.withColumn("_test", unit_hash(F.col(key).cast("string"), "detect") < 0.34)
    prep = _features(both, columns).fit(both)
    x = prep.transform(equal_rows(both, [*columns, "label", "_test"]) if name in WEIGHTED else both)
    train, test = x.filter("NOT _test"), x.filter("_test")
    if name == "gmm":
        a, b = (log_density(train.filter(F.col("label") == side), len(columns)) for side in (1, 0))
        got = test.withColumn("_v", vector_to_array("features")).withColumn("rawPrediction", a("_v") - b("_v"))
    else:
        model = learner(name, len(columns))
        got = (model.setWeightCol("_w") if name in WEIGHTED else model).fit(train).transform(test)
    weight = F.col("_w") if name in WEIGHTED else F.lit(1.0)
    auc = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction", weightCol="_w").evaluate(got.withColumn("_w", weight))
    return real.sparkSession.createDataFrame([(name, round(auc, 6))], "learner string, auc double")


def p_mse(real: DataFrame, syn: DataFrame, columns: list[str], key: str, folds: int = 5) -> DataFrame:
    """Mean squared distance of the real-or-candidate probability from one half, each row predicted by a model of the other hash folds."""
    both = real.select(key, *columns, F.lit(0.0).alias("label")).unionByName(syn.select(key, *columns, F.lit(1.0).alias("label")))
    both = equal_rows(hash_folds(both, key, folds), [*columns, "label", "_fold"]).persist()
    p = vector_to_array(F.col("probability"))[1]
    total, n = 0.0, 0
    for i in range(folds):
        train = both.filter(F.col("_fold") != i)
        prep = _features(train, columns).fit(train)
        model = LogisticRegression(labelCol="label", maxIter=100, weightCol="_w").fit(prep.transform(train))
        r = model.transform(prep.transform(both.filter(F.col("_fold") == i))).agg(F.sum((p - 0.5) * (p - 0.5) * F.col("_w")).alias("s"), F.coalesce(F.sum("_w"), F.lit(0.0)).alias("n")).first()
        total, n = total + (r["s"] or 0.0), n + r["n"]
    both.unpersist()
    return real.sparkSession.createDataFrame([(round(total / n, 6) if n else None,)], "value double")


def pca_difference(real: DataFrame, syn: DataFrame, columns: list[str], k: int = 2) -> DataFrame:
    """Difference of explained variances, and the cosine between first axes."""
    prep = _features(real, columns).fit(real)
    fit = lambda x: PCA(k=k, inputCol="features", outputCol="_p").fit(prep.transform(x))
    a, b = fit(real), fit(syn)
    cos = abs(sum(a.pc.toArray()[i, 0] * b.pc.toArray()[i, 0] for i in range(len(columns))))
    gap = sum(abs(u - v) for u, v in zip(a.explainedVariance.toArray(), b.explainedVariance.toArray()))
    return real.sparkSession.createDataFrame([(round(float(gap), 6), round(float(cos), 6))], "eigenvalue_gap double, cosine double")


def rank_correlation(a: list[float], b: list[float]) -> float:
    """Spearman's correlation with mean ranks for ties; 1 if both have no order, 0 if one of them has none."""
    import numpy as np

    def ranks(v):
        v = np.asarray(v, float)
        return (v[:, None] > v[None, :]).sum(axis=1) + ((v[:, None] == v[None, :]).sum(axis=1) - 1) / 2

    x, y = ranks(a), ranks(b)
    x, y = x - x.mean(), y - y.mean()
    size = float(np.sqrt((x * x).sum() * (y * y).sum()))
    return float((x * y).sum() / size) if size else float((x == y).all())


def feature_rank_distance(real: DataFrame, syn: DataFrame, target: str, columns: list[str]) -> DataFrame:
    """Rank correlation of feature importances fitted on real and on candidate rows."""
    def importances(df):
        index = StringIndexer(inputCol=target, outputCol="label", stringOrderType="alphabetAsc").fit(df)
        x = index.transform(_features(df, columns).fit(df).transform(df))
        return learner("forest", len(columns)).fit(x).featureImportances.toArray()

    return real.sparkSession.createDataFrame([(round(rank_correlation(importances(real), importances(syn)), 6),)], "value double")


def gmm_generate(df: DataFrame, columns: list[str], n: int, k: int = 3, seed: int = 7) -> DataFrame:
    """n rows from a Gaussian mixture: a component by cumulative weight, then its mean and Cholesky factor.

    Numbers are hashes of the row's id and the seed, so a row doesn't depend on how many tasks make it.
    """
    import numpy as np

    parts, _, _ = mixture.fit(VectorAssembler(inputCols=columns, outputCol="_gmm", handleInvalid="skip").transform(df.select(*columns)), "_gmm", k, seed)
    key = F.col("id").cast("string")
    rows = df.sparkSession.range(n).withColumn("_u", unit_hash(key, "component", seed)).withColumns({f"_z{i}": normal_hash(key, i, seed) for i in range(len(columns))})
    cuts = np.cumsum([w for w, _, _ in parts])
    out = []
    for i, c in enumerate(columns):
        value = None
        for (_, mean, cov), cut in list(zip(parts, cuts))[::-1]:
            low = np.linalg.cholesky(cov + 1e-9 * np.eye(len(columns)))
            x = F.lit(float(mean[i])) + sum((float(low[i, j]) * F.col(f"_z{j}") for j in range(i + 1)), F.lit(0.0))
            value = x if value is None else F.when(F.col("_u") <= float(cut), x).otherwise(value)
        out.append(value.alias(c))
    return rows.select("id", *out)


def fold_predictions(real: DataFrame, train: DataFrame, target: str, positive, columns: list[str], key: str, name: str = "linear", folds: int = 5) -> DataFrame:
    """Real rows with ``hit`` (1 where the target is predicted positive) and ``truth``: each hash fold by a model of ``train``'s other folds."""
    label = lambda df: df.withColumn("label", F.coalesce((F.col(target) == positive).cast("double"), F.lit(0.0)))
    real, train = hash_folds(label(real), key, folds), hash_folds(label(train), key, folds)
    out = None
    for i in range(folds):
        known = train.filter(F.col("_fold") != i)
        prep = _features(known, columns).fit(known)
        got = learner(name, len(columns)).fit(prep.transform(known)).transform(prep.transform(real.filter(F.col("_fold") == i)))
        part = got.withColumns({"hit": F.col("prediction"), "truth": F.col("label")}).select(*real.columns, "hit", "truth").drop("label", "_fold")
        out = part if out is None else out.unionByName(part)
    return out


def fairness_gaps(predicted: DataFrame, group: str, hit: str = "hit", truth: str = "truth") -> DataFrame:
    """One row: gaps over a group column's values of predicted-positive rates, of true and false positive rates (the larger), and of true positive rates."""
    h = F.col(hit).cast("double")
    g = predicted.groupBy(group).agg(F.avg(h).alias("pr"), F.avg(F.when(F.col(truth) == 1, h)).alias("tpr"), F.avg(F.when(F.col(truth) == 0, h)).alias("fpr"))
    gap = lambda c: F.max(c) - F.min(c)
    return g.agg(gap("pr").alias("statistical_parity"), F.greatest(gap("tpr"), gap("fpr")).alias("equalized_odds"), gap("tpr").alias("equal_opportunity"))


def fairness_metrics(real: DataFrame, syn: DataFrame, target: str, positive, protected: list[str], columns: list[str], key: str, name: str = "linear", folds: int = 5) -> DataFrame:
    """(metric, value): gaps of candidate-trained models on real rows, for each protected column (sp_, eqo_, eo_) and the largest of each kind."""
    got = checkpointed(fold_predictions(real, syn, target, positive, columns, key, name, folds))
    kinds, rows = {"statistical_parity": "sp", "equalized_odds": "eqo", "equal_opportunity": "eo"}, []
    for g in protected:
        one = fairness_gaps(got, g).first()
        rows += [(f"{short}_{target}_{g}", kind, one[kind]) for kind, short in kinds.items()]
    worst = [(kind, kind, max((v for _, k, v in rows if k == kind and v is not None), default=None)) for kind in kinds]
    return real.sparkSession.createDataFrame([(m, None if v is None else round(v, 6)) for m, _, v in worst + rows], "metric string, value double")


def binary_pass(train: DataFrame, holdout: DataFrame, candidates: DataFrame, target: str, positive: list, negative: list, protected: list[str], columns: list[str], key: str, name: str = "linear") -> DataFrame:
    """(model, framework, type, metric, value) of the metrics that need two classes, on copies whose target is collapsed to 1 and 0.

    The inputs are left as they are; ``combine.merge_binary_pass`` brings the rows beside the others.
    """
    from quarrystone.operators.clean import binary_target
    from quarrystone.operators.combine import classify_metric

    two = lambda df: binary_target(df, target, positive, negative)
    train, holdout, rows = two(train), two(holdout), []
    for model in sorted(r[0] for r in candidates.select("model").distinct().collect()):
        syn = two(candidates.filter(F.col("model") == model).drop("model"))
        rows += [(model, r["metric"], r["value"]) for r in fairness_metrics(holdout, syn, target, 1, protected, columns, key, name).collect()]
        rows.append((model, "auroc_diff", auroc_difference(train, holdout, syn, target, 1, columns).first()["value"]))
    framework, kind = classify_metric(F.col("metric"))
    found = train.sparkSession.createDataFrame(rows, "model string, metric string, value double")
    return found.select("model", framework.alias("framework"), kind.alias("type"), "metric", "value")


def _numbers(known: DataFrame, columns: list[str], *frames: DataFrame) -> tuple[list[DataFrame], list[str]]:
    """The frames with their text columns as codes of ``known``'s values, and the columns that models see."""
    text = [c for c in columns if not is_numeric(known, c)]
    if text:
        index = StringIndexer(inputCols=text, outputCols=[f"_i_{c}" for c in text], handleInvalid="keep", stringOrderType="alphabetAsc").fit(known)
        frames = [index.transform(x) for x in frames]
    seen = [f"_i_{c}" if c in text else c for c in columns]
    return list(frames), seen


def _told_by_forest(known: DataFrame, asked: DataFrame, columns: list[str], labels: int, name: str) -> DataFrame:
    """asked with ``name``, the label (a whole number) by a forest of ``known``, which has ``label``; rows are counted by intervals, once (``counted``).

    Rows of ``asked`` that lack a number are left out, after the forest: a condition before it would make what the rows are computed from again for each column.
    """
    import numpy as np
    import pandas as pd
    from pyspark.sql.functions import pandas_udf

    cuts = counted.cut_points(known, columns)
    cells, shape = counted.kind_cells(known.withColumn("kind", F.col("label")), columns, cuts, labels)
    trees = counted.forest(cells, shape, np.ones((1, labels), bool), np.arange(labels), labels)
    edges = [np.array(cuts[c]) for c in columns]

    @pandas_udf("int")
    def told(x):
        bins = np.stack([np.searchsorted(e, x.iloc[:, i].to_numpy(), side="right") for i, e in enumerate(edges)])
        return pd.Series(counted.said(trees, 1, 0, bins), dtype="Int32").mask(x.isna().any(axis=1))

    got = asked.withColumn(name, told(F.struct(*(F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)))))
    return got.filter(F.col(name).isNotNull())


def relabel_by_classifier(syn: DataFrame, real: DataFrame, target: str, columns: list[str], name: str = "forest") -> DataFrame:
    """Candidates with the class that a model fitted on real rows gives them."""
    index = StringIndexer(inputCol=target, outputCol="label", stringOrderType="alphabetAsc").fit(real)
    if name == "forest":
        (known, asked), seen = _numbers(real, columns, index.transform(real), syn.drop(target))
        got = _told_by_forest(complete_cases(known, seen), asked, seen, len(index.labels), "prediction")
    else:
        prep = _features(real, columns).fit(real)
        got = learner(name, len(columns), len(index.labels)).fit(index.transform(prep.transform(real))).transform(prep.transform(syn.drop(target)))
    return got.withColumn(target, F.get(F.array(*map(F.lit, index.labels)), F.col("prediction").cast("int"))).select(*[c for c in syn.columns if c != target], target)


def oversample_then_subsample(real: DataFrame, target: str, columns: list[str], n: int, seed: int = 7) -> DataFrame:
    """Generate n x largest share x classes rows, label them, and resample to the real shares."""
    from quarrystone.operators.split import proportional_resample

    shares = {str(r[0]): r[1] for r in real.groupBy(target).agg((F.count("*")).alias("n")).collect()}
    total = sum(shares.values())
    shares = {k: v / total for k, v in shares.items()}
    made = gmm_generate(real, columns, int(n * max(shares.values()) * len(shares)) + 1, seed=seed).withColumn("key", F.col("id").cast("string"))
    labelled = checkpointed(relabel_by_classifier(made, real, target, columns))  # read five times below
    present = {r[0] for r in labelled.select(target).distinct().collect()}
    shares = {k: v for k, v in shares.items() if k in present}
    return proportional_resample(labelled, target, {k: v / sum(shares.values()) for k, v in shares.items()}, n, "key", seed)


def membership_attack(train: DataFrame, holdout: DataFrame, syn: DataFrame, columns: list[str], key: str, rounds: int = 5) -> DataFrame:
    """Recall and precision of telling training rows from held-out ones, mean over hash rounds.

    The attacker fits candidates against half of the held-out rows and is judged on training rows
    against the other half. All rounds share one pass that counts rows by intervals and by what they are: a candidate,
    a training row, or a held-out row with the rounds (bits) in which the attacker knows it; their forests grow together.
    """
    import numpy as np

    if rounds > 10:
        raise ValueError("a held-out row's rounds are bits of its kind: 10 at most")
    (syn, train, out), seen = _numbers(syn.select(*columns).unionByName(holdout.select(*columns)), columns, syn.select(*columns), train.select(*columns), holdout.select(key, *columns))
    syn, train, out = (complete_cases(x, seen) for x in (syn, train, out))
    bits = sum((F.when(unit_hash(F.col(key).cast("string"), "mia", i) < 0.5, 1 << i).otherwise(0) for i in range(rounds)), F.lit(0))
    out = out.select(*seen, (bits + 2).alias("kind"))
    rows = syn.select(*seen, F.lit(0).alias("kind")).unionByName(train.select(*seen, F.lit(1).alias("kind"))).unionByName(out)
    kinds = 2 + (1 << rounds)
    cells, shape = counted.kind_cells(rows, seen, counted.cut_points(syn.select(*seen).unionByName(out.select(*seen)), seen), kinds)
    knows = np.array([[(k >> i) & 1 for k in range(1 << rounds)] for i in range(rounds)], bool)
    member = np.concatenate([np.tile([True, False], (rounds, 1)), knows], axis=1)
    trees = counted.forest(cells, shape, member, np.array([1, 1] + [0] * (1 << rounds)), 2)

    def one(number, raw, counts):
        bins, counts = folded._cells(shape, raw, counts)
        counts, got = counts.reshape(counts.shape[0], -1)[:, :kinds], np.zeros((rounds, 3))
        for i in range(rounds):
            yes = counted.said(trees, rounds, i, bins) == 1
            others = counts[:, 2:][:, ~knows[i]].sum(axis=1)
            got[i] = counts[yes, 1].sum(), counts[:, 1].sum(), counts[yes, 1].sum() + others[yes].sum()
        return got.ravel()

    found = folded._sum(cells, one).reshape(rounds, 3)
    mean = lambda k: round(float(np.mean(found[:, 0] / np.maximum(found[:, k], 1))), 6)
    return train.sparkSession.createDataFrame([(mean(1), mean(2))], "mia_recall double, mia_precision double")


def domias(train: DataFrame, holdout: DataFrame, syn: DataFrame, columns: list[str], key: str, k: int = 4) -> DataFrame:
    """AUC of the density ratio of candidates over other held-out rows, members against non-members.

    Densities are Gaussian mixtures; half of the held-out rows make the reference density, the
    other half are the non-members.
    """
    half = unit_hash(F.col(key).cast("string"), "domias") < 0.5
    ref, rest = holdout.filter(half), holdout.filter(~half)
    prep = _features(ref, columns).fit(ref)

    a, b = (log_density(prep.transform(x), len(columns), k) for x in (syn, ref))
    x = prep.transform(train.select(*columns, F.lit(1.0).alias("label")).unionByName(rest.select(*columns, F.lit(0.0).alias("label"))))
    got = x.withColumn("_v", vector_to_array("features")).withColumn("rawPrediction", a("_v") - b("_v"))
    auc = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction").evaluate(got)
    return train.sparkSession.createDataFrame([(round(auc, 6),)], "auc double")


def auroc_difference(train: DataFrame, holdout: DataFrame, syn: DataFrame, target: str, positive, columns: list[str]) -> DataFrame:
    """AUROC on held-out rows of the model fitted on real rows less that of the one fitted on candidates."""
    label = lambda df: df.withColumn("label", (F.col(target) == positive).cast("double"))
    prep = _features(train, columns).fit(train)
    score = lambda df: BinaryClassificationEvaluator(labelCol="label").evaluate(learner("linear", len(columns)).fit(label(prep.transform(df))).transform(label(prep.transform(holdout))))
    return train.sparkSession.createDataFrame([(round(score(train) - score(syn), 6),)], "value double")


TRIALS = "study string, number int, state string, value double, params map<string,string>"


def read_trials(spark, path: str) -> DataFrame:
    """The trials that a folder holds; none if it isn't there yet."""
    try:
        return spark.read.schema(TRIALS).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], TRIALS)


def grid_trials(spark, specs: list[dict], score, study: str, path: str, retry: bool = False) -> DataFrame:
    """(study, number, state, value, params): score every spec that has no trial yet; less or more is for the reader to prefer.

    Each trial is appended to the folder ``path`` as it ends, so a broken run goes on after the last one. Whatever
    ``score(spec)`` raises, Spark's own errors included, is recorded as FAIL with its message and passed over; with
    ``retry`` failed specs are tried again. A spec is known by its parameters, not by its place.
    """
    named = lambda spec: tuple(sorted((k, str(v)) for k, v in spec.items()))
    known = read_trials(spark, path).filter(F.col("study") == study).collect()  # as many as specs
    done = {tuple(sorted(r["params"].items())) for r in known if r["state"] == "COMPLETE" or not retry}
    number = 1 + max((r["number"] for r in known), default=-1)
    for spec in specs:
        if named(spec) in done:
            continue
        try:
            state, value = "COMPLETE", float(score(spec))
        except Exception as e:  # noqa: BLE001  a trial may fail in any way
            state, value = f"FAIL: {type(e).__name__}: {e}".splitlines()[0][:200], None
        spark.createDataFrame([(study, number, state, value, dict(named(spec)))], TRIALS).coalesce(1).write.mode("append").parquet(path)
        done.add(named(spec))
        number += 1
    return read_trials(spark, path).filter(F.col("study") == study)
