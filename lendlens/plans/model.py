"""PD models on rule-passing loans, out-of-time, with pyspark.ml.

Preparation is fitted on the training rows only: exact medians fill gaps,
numeric columns are standardised with the population std, categorical
columns are one-hot encoded with every level kept and unseen levels mapped
to all zeros.  Two models: an L2 logistic regression (Newton steps,
``operators/logit.py``) and histogram gradient boosting (leaf-wise trees on
binned inputs, the three folds fitted in the same passes,
``operators/boosting.py``) calibrated by isotonic regression
(``operators/isotonic.py``) over three folds.  ``learner="ml"`` fits the trees and the
calibration with ``pyspark.ml`` instead.  Only metrics and the scored test
table leave Spark; no step collects loan rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.operators.boosting import Binning, boosted_score, fit_boosting, numeric_edges
from lendlens.operators.isotonic import fit_isotonic, isotonic_value
from lendlens.operators.logit import fit_logit, logit_probability
from lendlens.operators.metrics import exact_auc
from lendlens.plans import policy, prep
from lendlens.session import materialize, remove_stored, shuffles_removed, split_methods

MISSING = prep.MISSING_LEVEL
# Boosting rounds fitted before the hold-out loss is first read.
FIRST_ROUNDS = 25


@dataclass
class ModelResult:
    metrics: DataFrame        # model, auc, gini, brier, is_champion
    scores: DataFrame         # test rows: loan_amnt, int_rate, grade, purpose, is_default, pd_hat
    cutoff_days: float
    n_train: int
    gbt_rounds: list          # rounds chosen per fold


def _numeric_inputs(med: dict) -> list[str]:
    """Numeric inputs with a training median; an all-missing column is dropped
    (as a median imputer does), so the assembler never sees a NULL."""
    return [c for c in policy.NUMERIC if med.get(c) is not None]


def _standardise(df: DataFrame, med: dict, stats: dict) -> DataFrame:
    cols = {}
    for c in _numeric_inputs(med):
        x = F.coalesce(F.col(c).cast("double"), F.lit(med[c])) if med[c] is not None else F.col(c).cast("double")
        x = F.when(F.isnan(x), F.lit(med[c])).otherwise(x) if med[c] is not None else x
        sd = stats["std"][c] or 1.0          # a constant column scales by 1
        cols[f"z_{c}"] = (x - F.lit(stats["mean"][c] or 0.0)) / F.lit(sd)
    for c in policy.CATEGORICAL:
        cols[f"c_{c}"] = F.coalesce(F.col(c), F.lit(MISSING))
    return df.withColumns(cols)


def _encoder_stages(numeric: list[str] = policy.NUMERIC):
    idx = StringIndexer(inputCols=[f"c_{c}" for c in policy.CATEGORICAL],
                        outputCols=[f"i_{c}" for c in policy.CATEGORICAL],
                        handleInvalid="keep", stringOrderType="alphabetAsc")
    ohe = OneHotEncoder(inputCols=[f"i_{c}" for c in policy.CATEGORICAL],
                        outputCols=[f"o_{c}" for c in policy.CATEGORICAL], dropLast=True)
    vec = VectorAssembler(inputCols=[f"z_{c}" for c in numeric] + [f"o_{c}" for c in policy.CATEGORICAL],
                          outputCol="x")
    return [idx, ohe, vec]


def _p1(col: str = "probability") -> F.Column:
    return vector_to_array(F.col(col))[1]


def _stopping(losses, patience: int = 10) -> tuple[int, bool]:
    """Rounds with the lowest loss, and whether ``patience`` rounds without gain followed."""
    best, best_i, since = float("inf"), 0, 0
    for i, v in enumerate(losses):
        if v < best - 1e-12:
            best, best_i, since = v, i, 0
        else:
            since += 1
            if since >= patience:
                return best_i + 1, True
    return best_i + 1, False


def _best_rounds(model, holdout: DataFrame, patience: int = 10) -> int:
    """Rounds with the lowest hold-out log-loss, stopping after ``patience`` without gain."""
    return _stopping(model.evaluateEachIteration(holdout), patience)[0]


def _fit_gbt(train: DataFrame, max_iter: int, seed: int, early_stopping: bool):
    gbt = GBTClassifier(featuresCol="x", labelCol="y", maxIter=max_iter, stepSize=0.08, maxDepth=6,
                        maxBins=255, minInstancesPerNode=20, seed=seed, subsamplingRate=1.0)
    if not early_stopping:
        return gbt.fit(train), max_iter
    h = F.pmod(F.xxhash64(F.col("loan_key"), F.lit(seed)), F.lit(10))
    fit_part, hold = train.filter(h != 0), train.filter(h == 0)
    # rounds are a prefix of a longer run with the same seed: double them until patience runs out
    tried = min(FIRST_ROUNDS, max_iter)
    while True:
        model = gbt.copy().setMaxIter(tried).fit(fit_part)
        rounds, settled = _stopping(model.evaluateEachIteration(hold))
        if settled or tried == max_iter:
            break
        tried = min(max_iter, 2 * tried)
    return (model if rounds == tried else gbt.copy().setMaxIter(rounds).fit(fit_part)), rounds


def encoded_inputs(numeric: list[str], levels: dict[str, list[str]]) -> Column:
    """Array of the numbers and a 0/1 column per level, as ``_encoder_stages`` assembles them; fails on a missing number, as they do."""
    missing = F.raise_error(F.lit("missing or NaN value among the model inputs")).cast("double")
    numbers = [F.when(F.col(c).isNull() | F.isnan(c), missing).otherwise(F.col(c)) for c in numeric]
    return F.array(*numbers, *[F.when(F.col(c) == x, F.lit(1.0)).otherwise(F.lit(0.0)) for c, known in levels.items() for x in known])


def design_tables(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame, Binning]:
    """Training design, test design (x array, y, loan_key, z_ and c_ inputs) and the bins of the training inputs.

    Both are projections of the rows given, which should be stored: an encoded copy would be larger than the features.
    """
    med = prep.medians(train)
    stats = prep.scale_stats(train, med)
    stages = _encoder_stages(_numeric_inputs(med))
    # the columns the assembler really takes, without their z_ / o_ prefix
    policy.check_inputs(c[2:] for c in stages[-1].getInputCols())
    enc = Pipeline(stages=stages).fit(_standardise(train, med, stats))
    numeric = [f"z_{c}" for c in _numeric_inputs(med)]
    coded = [f"c_{c}" for c in policy.CATEGORICAL]
    levels = dict(zip(coded, (list(x) for x in enc.stages[0].labelsArray)))

    def design(df):
        return _standardise(df, med, stats).withColumns(
            {"x": encoded_inputs(numeric, levels), "y": F.col(policy.TARGET).cast("double"), "loan_key": F.col("loan_id")})

    tr = design(train).select("loan_key", "x", "y", *numeric, *coded)
    binning = Binning(numeric_edges(tr, numeric), levels)
    return tr, design(test), binning


def _calibrated_boosting(tr: DataFrame, scored: DataFrame, binning: Binning, gbt_iter: int, folds: int, seed: int, early_stopping: bool):
    """``scored`` plus p_gbt0, p_gbt1 ...: fold k's trees never saw the rows its isotonic map is fitted on."""
    fold = F.pmod(F.xxhash64(F.col("loan_key"), F.lit(seed + 1)), F.lit(folds))
    held = F.pmod(F.xxhash64(F.col("loan_key"), F.lit(seed)), F.lit(10)) == 0
    models = fit_boosting(tr, binning, "y", rounds=gbt_iter, fold=fold, folds=folds, held=held, patience=10 if early_stopping else None)
    for k, model in enumerate(models):
        chance = 1 / (1 + F.exp(-boosted_score(model)))
        blocks = fit_isotonic(tr.filter(fold == k).select(chance.alias("s"), "y"), "s", "y")
        scored = scored.withColumn("s", chance)
        scored = scored.withColumn(f"p_gbt{k}", isotonic_value(blocks, "s")).drop("s")
        remove_stored(blocks)
    return scored, [len(m.trees) for m in models]


def _calibrated_ml(tr: DataFrame, scored: DataFrame, gbt_iter: int, folds: int, seed: int, early_stopping: bool):
    """The same with ``pyspark.ml`` learners."""
    fold = F.pmod(F.xxhash64(F.col("loan_key"), F.lit(seed + 1)), F.lit(folds))
    tr = materialize(tr.withColumn("x", array_to_vector("x")), "design_vectors")
    scored = scored.withColumn("x", array_to_vector("x"))
    rounds = []
    for k in range(folds):
        fit_rows, cal_rows = tr.filter(fold != k), tr.filter(fold == k)
        gbt_model, r = _fit_gbt(fit_rows, gbt_iter, seed, early_stopping)
        rounds.append(r)
        # isotonic fit on (score, weight, mean label): the pooling sorts
        # distinct scores, not rows
        cal = (gbt_model.transform(cal_rows).select(_p1().alias("s"), "y")
               .groupBy("s").agg(F.count(F.lit(1)).cast("double").alias("w"), F.avg("y").alias("y")))
        iso = IsotonicRegression(featuresCol="s", labelCol="y", weightCol="w", predictionCol="p",
                                 isotonic=True).fit(cal)
        raw = gbt_model.transform(scored).withColumn("s", _p1()).drop("rawPrediction", "probability",
                                                                           "prediction")
        scored = iso.transform(raw).withColumnRenamed("p", f"p_gbt{k}").drop("s")
    return scored, rounds


def metrics_report(scored: DataFrame, models: dict[str, str], label: str = "y") -> tuple[DataFrame, str | None]:
    """(model, auc, gini, brier, is_champion) of score columns and the champion's name.

    The champion has the strictly greater AUC: the first model on a tie, none without a positive AUC.  Rows without a
    score are left out of its model's metrics.
    """
    mets, best, best_auc = [], None, 0.0
    for name, col in models.items():
        known = scored.filter(F.col(col).isNotNull())
        auc = exact_auc(known, col, label)
        brier = known.agg(F.avg((F.col(col) - F.col(label)) ** 2)).first()[0]
        mets.append((name, auc, None if auc is None else 2 * auc - 1, brier))
        if auc is not None and auc > best_auc:
            best, best_auc = name, auc
    report = scored.sparkSession.createDataFrame([(n, a, g, b, n == best) for n, a, g, b in mets],
                                                 "model string, auc double, gini double, brier double, is_champion boolean")
    return report, best


def train_and_score(features: DataFrame, gbt_iter: int = 400, folds: int = 3, seed: int = 42,
                    lr_iter: int = 2000, early_stopping: bool = True, learner: str = "histogram") -> ModelResult:
    spark = features.sparkSession
    with split_methods(spark), shuffles_removed(spark):
        rows = policy.passing(policy.model_frame(features, keep=("loan_id",)))
        train, test, cut = policy.oot_split(rows)
        tr, te, binning = design_tables(train, test)
        n_train = tr.count()
        scored = te.withColumn("p_logistic", logit_probability(fit_logit(tr, "x", "y", ridge=1.0, max_steps=lr_iter), "x"))
        if learner == "histogram":
            scored, rounds = _calibrated_boosting(tr, scored, binning, gbt_iter, folds, seed, early_stopping)
        else:
            scored, rounds = _calibrated_ml(tr, scored, gbt_iter, folds, seed, early_stopping)
        scored = scored.withColumn("p_gradient_boosting",
                                   sum(F.col(f"p_gbt{k}") for k in range(folds)) / float(folds))
        scored = materialize(scored.select("loan_amnt", "int_rate", "grade", "purpose", policy.TARGET, "y",
                                           "p_logistic", "p_gradient_boosting"), "test_scores")
    metrics, best = metrics_report(scored, {"logistic_baseline": "p_logistic", "gradient_boosting": "p_gradient_boosting"})
    champ = "p_logistic" if best == "logistic_baseline" else "p_gradient_boosting"
    scores = scored.select("loan_amnt", "int_rate", "grade", "purpose", policy.TARGET,
                           F.col(champ).alias("pd_hat"))
    return ModelResult(metrics, scores, cut, n_train, rounds)
