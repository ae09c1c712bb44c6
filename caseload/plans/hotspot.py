"""Monthly county hotspots: series, labels, features, models, scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_
from typing import Any

from pyspark import SparkContext, StorageLevel
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .. import vocabulary as V
from ..functions.numbers import rate_or_zero, season_cos, season_sin
from ..operators.joins import attach
from ..operators.quantiles import approx_quantile, exact_quantile
from ..operators.ranking import label_code, lag_month
from ..schemas import PREDICTION_COLUMNS
from ..session import settle

LABEL = "is_hotspot"
FEATURES = (
    "state_idx", "county_idx", "month", "sin_month", "cos_month", "crime_last_month",
    "crime_rate_per_1000",
)
COUNTY = ("state", "county")


def county_month(
    df: DataFrame,
    date: str = "incident_date",
    by_population: bool = False,
    drop_null_keys: bool = True,
) -> DataFrame:
    """Incidents per state, county and month, with the population.

    The population of a month is the largest one reported in it, 0 if there is
    none: unlike "the first met" that does not depend on row order.
    ``by_population`` groups by it as well.
    """
    dated = df.select(
        *COUNTY, "population", F.year(date).alias("year"), F.month(date).alias("month")
    )
    keys = [*COUNTY, "year", "month"]
    if drop_null_keys:
        dated = dated.na.drop(subset=keys)
    count = F.count(F.lit(1)).alias("crime_count")
    if by_population:
        return dated.groupBy(*COUNTY, "population", "year", "month").agg(count)
    people = F.coalesce(F.max("population"), F.lit(0)).alias("population")
    return dated.groupBy(*keys).agg(count, people)


def hotspot_label(
    monthly: DataFrame, p: float = V.HOTSPOT_QUANTILE, exact: bool = True
) -> DataFrame:
    """1 where the count reaches the quantile over all county-months.

    The county-months are kept in the shared folder: the quantile and the label
    both need them, and the incidents should be read once.
    """
    monthly = settle(monthly)
    make = exact_quantile if exact else approx_quantile
    threshold = make(monthly, "crime_count", p).scalar()
    return monthly.withColumn(LABEL, F.when(F.col("crime_count") >= threshold, 1).otherwise(0))


def hotspot_by_county(
    monthly: DataFrame, p: float = V.COUNTY_HOTSPOT_QUANTILE, exact: bool = False
) -> DataFrame:
    """1 where the count exceeds the county's own quantile.

    A window partition is one county's months.
    """
    window = Window.partitionBy(*COUNTY)
    value = F.percentile("crime_count", p) if exact else F.percentile_approx("crime_count", p)
    return monthly.withColumn("threshold", value.over(window)).withColumn(
        LABEL, F.when(F.col("crime_count") > F.col("threshold"), 1).otherwise(0)
    )


def season_and_rate(monthly: DataFrame) -> DataFrame:
    return monthly.withColumns(
        {
            "crime_rate_per_1000": rate_or_zero("crime_count", "population"),
            "sin_month": season_sin("month"),
            "cos_month": season_cos("month"),
        }
    )


def features(monthly: DataFrame, gaps: str = "observed", encoding: str = "text") -> DataFrame:
    """The seven model inputs.

    ``encoding='text'`` numbers labels in text order and leaves them plain
    numbers; ``'frequency'`` indexes them by frequency as categories.
    """
    out = settle(lag_month(season_and_rate(monthly), COUNTY, "crime_count", gaps))
    if encoding == "text":
        for column in COUNTY:
            out = attach(out, label_code(out, column), [column])
        return out
    if encoding != "frequency":
        raise ValueError(f"unknown encoding: {encoding}")
    indexer = StringIndexer(
        inputCols=list(COUNTY), outputCols=[f"{c}_idx" for c in COUNTY], handleInvalid="keep"
    )
    return indexer.fit(out).transform(out)


def assemble(
    df: DataFrame, inputs: Sequence[str] = FEATURES, invalid: str = "error"
) -> DataFrame:
    assembler = VectorAssembler(
        inputCols=list(inputs), outputCol="features", handleInvalid=invalid
    )
    return assembler.transform(df.drop("features"))


def time_split(df: DataFrame, year: str = "year") -> tuple[DataFrame, DataFrame]:
    """Train on the years before the last one, test on the last."""
    last = df.agg(F.max(year)).scalar()
    return df.filter(F.col(year) < last), df.filter(F.col(year) == last)


def max_bins(df: DataFrame, at_least: int = 32) -> int:
    """Bins the trees need: one for every value of the widest category.

    Indexed columns carry their labels; codes that are plain numbers are dense,
    so the largest says how many there are.
    """
    widest, plain = at_least, []
    for column in ("state_idx", "county_idx"):
        values = df.schema[column].metadata.get("ml_attr", {}).get("vals")
        widest = max(widest, len(values or ()))
        plain += [] if values else [column]
    if plain:
        widest = max(widest, *[int(x or 0) + 1 for x in df.agg(*[F.max(c) for c in plain]).first()])
    return widest


def train_rf(train: DataFrame, bins: int = 32, params: Mapping[str, Any] = V.FOREST) -> Model:
    forest = RandomForestClassifier(
        featuresCol="features", labelCol=LABEL, maxBins=bins,
        checkpointInterval=10, **params,
    )
    return forest.fit(train)


def train_gbt(
    train: DataFrame,
    valid: DataFrame,
    bins: int = 32,
    params: Mapping[str, Any] = V.BOOSTING,
    tolerance: float = 0.001,
) -> Model:
    """Boosted trees that stop when the validation error no longer improves."""
    marked = train.withColumn("_valid", F.lit(False)).unionByName(
        valid.withColumn("_valid", F.lit(True))
    )
    boosted = GBTClassifier(
        featuresCol="features", labelCol=LABEL, validationIndicatorCol="_valid",
        validationTol=tolerance, maxBins=bins, checkpointInterval=10, **params,
    )
    return boosted.fit(marked)


def chosen_round(losses: DataFrame, patience: int = V.PATIENCE) -> DataFrame:
    """One row (best_round, best_loss, last_round) of validation losses (round, loss).

    Boosting ends at the first round that lies ``patience`` rounds behind the best one so far, or
    with the last; a loss must be smaller to be better, so of equal ones the earliest counts. NaN is
    no loss. There are as many rows as rounds, so one window holds them.
    """
    order = Window.orderBy("round").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    usable = losses.filter(~F.isnan("loss") & F.col("loss").isNotNull())
    best = F.min(F.struct("loss", "round")).over(order)
    traced = usable.select("round", best.alias("best"))
    out = F.coalesce(F.min(F.when(F.col("round") - F.col("best.round") >= patience, F.col("round"))), F.max("round"))
    last = traced.agg(out.alias("last_round"))
    found = traced.join(last, F.col("round") == F.col("last_round"))
    return found.select(F.col("best.round").alias("best_round"), F.col("best.loss").alias("best_loss"), "last_round")


@dataclass(frozen=True)
class Boosted:
    """A model cut at its best round, and the validation loss of every round that was run."""

    model: GBTClassificationModel
    losses: DataFrame
    best_round: int
    last_round: int


def train_gbt_patiently(
    train: DataFrame,
    valid: DataFrame,
    bins: int = 32,
    params: Mapping[str, Any] = V.BOOSTING,
    patience: int = V.PATIENCE,
) -> Boosted:
    """Boosted trees that stop after ``patience`` rounds without a smaller validation loss.

    Trees are grown in steps of doubling length; a longer run begins with the same trees (the seed of
    a round follows from its number), so a step that ends in time spares the rounds after it. The
    losses of a step come from one pass over the validation rows.
    """
    spark = train.sparkSession
    most, rounds = int(params["maxIter"]), min(int(params["maxIter"]), max(2 * patience, 1))
    while True:
        model = GBTClassifier(
            featuresCol="features", labelCol=LABEL, maxBins=bins, checkpointInterval=10, **{**params, "maxIter": rounds},
        ).fit(train)
        measured = model.evaluateEachIteration(valid)
        losses = spark.createDataFrame([(n, float(x)) for n, x in enumerate(measured, 1)], "round int, loss double")
        found = chosen_round(losses, patience).first()
        if rounds == most or (found and found.last_round - found.best_round >= patience):
            break
        rounds = min(most, 2 * rounds)
    best, last = (found.best_round, found.last_round) if found else (rounds, rounds)
    return Boosted(first_rounds(model, best), losses, best, last)


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model as it was after so many rounds."""
    context = SparkContext._active_spark_context
    package, whole = context._jvm.org.apache.spark.ml, model._java_obj
    trees = context._gateway.new_array(package.regression.DecisionTreeRegressionModel, rounds)
    weights = context._gateway.new_array(context._jvm.double, rounds)
    for n, (tree, weight) in enumerate(zip(whole.trees()[:rounds], whole.treeWeights()[:rounds])):
        trees[n], weights[n] = tree, weight
    cut = GBTClassificationModel(package.classification.GBTClassificationModel(whole.uid(), trees, weights))
    return model._copyValues(cut)


FILLS = {"crime_last_month": 0, "crime_rate_per_1000": 0, "state_idx": -1, "county_idx": -1}


def prepare(
    df: DataFrame, inputs: Sequence[str] = FEATURES, invalid: str = "skip"
) -> tuple[DataFrame, DataFrame]:
    """(rows with a feature vector, one row with ``rows`` and ``skipped``).

    Inputs that have a fill are filled first; a row that still lacks one is
    left out with ``invalid='skip'``, stops the job with ``'error'`` and becomes
    NaN with ``'keep'``.
    """
    filled = df.na.fill({k: v for k, v in FILLS.items() if k in df.columns})
    lacking = reduce(or_, [F.col(c).isNull() | F.isnan(F.col(c).cast("double")) for c in inputs])
    counted = filled.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(lacking, 1)).alias("skipped"))
    return assemble(filled, inputs, invalid), counted


def score(
    model: Model, df: DataFrame, inputs: Sequence[str] = FEATURES, invalid: str = "skip"
) -> DataFrame:
    """Class and probability of class 1; missing inputs are filled first.

    ``prepare`` says how many rows ``invalid='skip'`` leaves out.
    """
    if "features" not in df.columns:
        df, _ = prepare(df, inputs, invalid)
    old = [c for c in ("rawPrediction", "probability", "prediction") if c in df.columns]
    scored = model.transform(df.drop(*old))
    return scored.withColumn("hotspot_probability", vector_to_array("probability")[1])


def exact_auc(scored: DataFrame, label: str = LABEL, score_column: str = "score", ranges: int | None = None) -> DataFrame:
    """One row (positives, negatives, auc): the area under the ROC curve, exactly.

    It is the share of (positive, negative) pairs in which the positive scores higher, equal scores
    counting half. Rows are summed up by score before the shuffle; scores are sorted by range, and the
    negatives below a score are those of the ranges before and of its own range, so that no task
    ranks more than a range. Sums are whole numbers. Null scores and labels take no part; without a
    positive or without a negative the area is null.
    """
    spark = scored.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = "decimal(38,0)"
    positive = F.col(label).cast("double") == 1
    counts = (
        scored.select(F.col(score_column).cast("double").alias("score"), positive.alias("_positive"))
        .na.drop(subset=["_positive"]).filter(F.col("score").isNotNull())
        .groupBy("score")
        .agg(F.count_if("_positive").cast(whole).alias("p"), F.count_if(~F.col("_positive")).cast(whole).alias("q"))
    )
    ranged = settle(counts.repartitionByRange(ranges, "score").withColumn("_range", F.spark_partition_id()), "score-counts")
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    before = ranged.groupBy("_range").agg(F.sum("q").alias("_q")).select(
        "_range", F.coalesce(F.sum("_q").over(earlier), F.lit(0)).alias("_before"),
    )
    inside = Window.partitionBy("_range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    ranked = attach(ranged.withColumn("_inside", F.coalesce(F.sum("q").over(inside), F.lit(0))), before, ["_range"])
    below = (F.col("_before") + F.col("_inside")).cast("decimal(19,0)")
    p, q = F.col("p").cast("decimal(17,0)"), F.col("q").cast("decimal(17,0)")
    halves = F.sum((p * (below * 2)).cast(whole) + (p * q).cast(whole))
    sums = ranked.agg(halves.alias("halves"), F.sum("p").alias("positives"), F.sum("q").alias("negatives"))
    pairs = F.col("positives").cast("double") * F.col("negatives").cast("double")
    return sums.select(
        F.coalesce("positives", F.lit(0)).cast("bigint").alias("positives"),
        F.coalesce("negatives", F.lit(0)).cast("bigint").alias("negatives"),
        F.try_divide(F.col("halves").cast("double"), 2 * pairs).alias("auc"),
    )


@dataclass(frozen=True)
class Metrics:
    auc: float
    f1: float
    accuracy: float
    precision: float
    recall: float


def evaluate(scored: DataFrame, score_column: str = "probability", one_class: str = "zero") -> Metrics:
    """AUC, class-1 F1, precision and recall, and accuracy.

    One pass counts the four kinds of hit and miss, a second ranks the scores.
    ``one_class`` says what a single class in the data gives: with ``'zero'`` AUC and F1 are 0
    and so is a share of nothing; with ``'undefined'`` F1 follows from the counts as ever, and
    AUC and a share of nothing are NaN. Precision and recall follow from the counts with both.
    """
    if one_class not in ("zero", "undefined"):
        raise ValueError(f"unknown policy for a single class: {one_class}")
    slim = scored.select(F.col(LABEL).cast("double").alias(LABEL), "prediction", score_column)
    slim = slim.persist(StorageLevel.MEMORY_AND_DISK)
    nothing = 0.0 if one_class == "zero" else float("nan")
    try:
        truth, said = F.col(LABEL) == 1, F.col("prediction") == 1
        kinds = {"tp": truth & said, "fp": ~truth & said, "fn": truth & ~said, "tn": ~truth & ~said}
        n = slim.agg(*[F.count(F.when(c, 1)).alias(k) for k, c in kinds.items()]).first()
        part = lambda a, b: a / b if b else nothing
        accuracy = part(n.tp + n.tn, sum(n))
        precision, recall = part(n.tp, n.tp + n.fp), part(n.tp, n.tp + n.fn)
        f1 = part(2 * n.tp, 2 * n.tp + n.fp + n.fn)
        if not (n.tp + n.fn) or not (n.fp + n.tn):
            return Metrics(nothing, 0.0 if one_class == "zero" else f1, accuracy, precision, recall)
        numeric = isinstance(slim.schema[score_column].dataType, T.NumericType)
        ranked = slim.withColumn("score", F.col(score_column) if numeric else vector_to_array(score_column)[1])
        auc = exact_auc(ranked).first().auc
    finally:
        slim.unpersist()
    return Metrics(auc, f1, accuracy, precision, recall)


@dataclass(frozen=True)
class HotspotRun:
    model: Model
    predictions: DataFrame
    metrics: Metrics | None


def run_hotspot(
    df: DataFrame,
    model: str = "forest",
    exact: bool = True,
    encoding: str = "text",
    params: Mapping[str, Any] | None = None,
    measure: bool = True,
    stop: str = "tolerance",
) -> HotspotRun:
    """Incidents to scored test year: series, labels, features, fit, score.

    Boosting ends by ``stop``: ``'tolerance'`` (``train_gbt``) or ``'patience'``
    (``train_gbt_patiently``).

    The incidents are read once; everything after starts from county-months.
    """
    monthly = hotspot_label(county_month(df), exact=exact)
    data = assemble(features(monthly, encoding=encoding))
    bins = max_bins(data)
    train, test = (part.persist(StorageLevel.MEMORY_AND_DISK) for part in time_split(data))
    try:
        if model == "forest":
            fitted = train_rf(train, bins, params or V.FOREST)
        elif model == "boosting":
            if stop not in ("tolerance", "patience"):
                raise ValueError(f"unknown stopping rule: {stop}")
            if stop == "patience":
                fitted = train_gbt_patiently(train, test, bins, params or V.BOOSTING).model
            else:
                fitted = train_gbt(train, test, bins, params or V.BOOSTING)
        else:
            raise ValueError(f"unknown model: {model}")
        scored = score(fitted, test)
        metrics = evaluate(scored) if measure else None
    finally:
        train.unpersist()
        test.unpersist()
    return HotspotRun(fitted, scored.select(*PREDICTION_COLUMNS), metrics)
