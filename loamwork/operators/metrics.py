"""Classification, calibration, ranking and summary metrics as aggregations.

Multi-class scores are rows of (y, p): the true class's index and an array of probabilities. NaN
probabilities are flagged by `valid` and left out of every mean.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamwork.functions import arrow, text
from loamwork.operators.percentiles import medians, nearest_rank

#: Edges of ten equal bins as floating point gives them.
EDGES = [i * 0.1 for i in range(11)]


def softmax(scores: Column) -> Column:
    top = F.array_max(scores)
    total = F.aggregate(scores, F.lit(0.0), lambda a, x: a + F.exp(x - top))
    return F.transform(scores, lambda x: F.exp(x - top) / total)


def top1(p: Column) -> tuple[Column, Column]:
    """Index of the first greatest probability, and that probability."""
    return (F.array_position(p, F.array_max(p)) - 1).cast("int"), F.array_max(p)


def margin(p: Column) -> Column:
    ranked = F.sort_array(p, asc=False)
    return F.get(ranked, F.lit(0)) - F.get(ranked, F.lit(1))


def entropy(p: Column) -> Column:
    return -F.aggregate(p, F.lit(0.0), lambda a, x: a + F.when(x > 0, x * F.ln(x)).otherwise(0.0))


def confidence(p: Column) -> Column:
    """0 where all are equally likely, 1 at certainty."""
    n = F.size(p)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (n * F.array_max(p) - 1) / (n - 1)))


def valid(p: Column) -> Column:
    return ~F.exists(p, lambda x: F.isnan(x) | x.isNull())


def in_order(probabilities: Column, categories: list[str]) -> Column:
    """A map of category to probability as an array in this order; 0 for what it lacks."""
    return F.array(*[F.coalesce(F.element_at(probabilities, c), F.lit(0.0)) for c in categories])


def confusion(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("y", "predicted").agg(F.count("*").alias("n"))


def class_metrics(pairs: DataFrame, classes: list) -> DataFrame:
    """(label, precision, recall, f1, support) of every class, those without a row included; 0 where undefined."""
    spark = pairs.sparkSession
    counts = confusion(pairs)
    true = counts.groupBy(F.col("y").alias("label")).agg(F.sum("n").alias("support"), F.sum(F.when(F.col("y") == F.col("predicted"), F.col("n")).otherwise(0)).alias("tp"))
    said = counts.groupBy(F.col("predicted").alias("label")).agg(F.sum("n").alias("said"))
    every = spark.createDataFrame([(c,) for c in classes], ["label"]).withColumn("label", F.col("label").cast(dict(pairs.dtypes)["y"]))
    full = every.join(true, "label", "left").join(said, "label", "left").fillna(0, ["support", "tp", "said"])
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    scored = full.withColumn("precision", share(F.col("tp"), F.col("said"))).withColumn("recall", share(F.col("tp"), F.col("support")))
    return scored.select("label", "precision", "recall", share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")).alias("f1"), "support")


def accuracy(pairs: DataFrame) -> DataFrame:
    return pairs.agg(F.avg((F.col("y") == F.col("predicted")).cast("double")).alias("accuracy"), F.count("*").alias("n"))


def _bin(p: Column) -> Column:
    """The bin (lo, hi] of a probability, from 0; null for 0."""
    out = F.lit(None).cast("int")
    for k in reversed(range(10)):
        out = F.when((p > EDGES[k]) & (p <= EDGES[k + 1]), k).otherwise(out)
    return out


def reliability(rows: DataFrame, conf: str = "confidence", hit: str = "hit") -> DataFrame:
    binned = rows.withColumn("bin", _bin(F.col(conf))).where("bin IS NOT NULL")
    return binned.groupBy("bin").agg(F.avg(conf).alias("confidence"), F.avg(F.col(hit).cast("double")).alias("accuracy"), F.count("*").alias("n"))


def calibration_error(rows: DataFrame, conf: str = "confidence", hit: str = "hit", digits: int | None = None) -> DataFrame:
    """One row, ece; with `digits`, bins are rounded before they are combined."""
    bins = reliability(rows, conf, hit)
    if digits is not None:
        bins = bins.withColumn("confidence", F.round("confidence", digits)).withColumn("accuracy", F.round("accuracy", digits))
    total = rows.agg(F.count("*").alias("total"))
    return bins.crossJoin(F.broadcast(total)).agg(F.sum(F.col("n") / F.col("total") * F.abs(F.col("confidence") - F.col("accuracy"))).alias("ece"))


def probability_scores(rows: DataFrame) -> DataFrame:
    """One row: brier, mean_top1, mean_margin and n over rows (y, p)."""
    brier = F.aggregate(F.transform("p", lambda x, i: F.pow(x - F.when(i == F.col("y"), 1.0).otherwise(0.0), F.lit(2.0))), F.lit(0.0), lambda a, x: a + x)
    return rows.where(valid(F.col("p"))).agg(F.avg(brier).alias("brier"), F.avg(F.array_max("p")).alias("mean_top1"), F.avg(margin(F.col("p"))).alias("mean_margin"), F.count("*").alias("n"))


def negative_log_likelihood(rows: DataFrame, temperatures: list[float]) -> DataFrame:
    """(temperature, nll) over rows (y, scores): all temperatures in one pass over the data."""
    each = rows.select("y", "scores", F.explode(F.array(*map(F.lit, temperatures))).alias("temperature"))
    scaled = F.transform("scores", lambda x: x / F.col("temperature"))
    top = F.array_max("_z")
    loss = top + F.ln(F.aggregate("_z", F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max("_z")))) - F.get("_z", F.col("y"))
    return each.withColumn("_z", scaled).groupBy("temperature").agg(F.avg(loss).alias("nll"))


def fit_temperature(rows: DataFrame, low: float = 0.05, high: float = 10.0, rounds: int = 5, points: int = 17) -> float:
    """The temperature of least loss: a geometric grid, refined around its best point; a job a round.

    Five rounds leave less than a ten-thousandth between neighbouring points.
    """
    best = low
    for _ in range(rounds):
        grid = [low * (high / low) ** (k / (points - 1)) for k in range(points)]
        best = negative_log_likelihood(rows, grid).orderBy("nll", "temperature").first()["temperature"]
        step = (high / low) ** (1 / (points - 1))
        low, high = max(low, best / step), min(high, best * step)
    return best


def binary_scores(rows: DataFrame) -> DataFrame:
    """One row over (y, p): brier, mean_absolute_error, no_separation_rate, n."""
    y = F.col("y").cast("double")
    return rows.agg(F.avg(F.pow(F.col("p") - y, F.lit(2.0))).alias("brier"), F.avg(F.abs(F.col("p") - y)).alias("mean_absolute_error"), F.avg((F.abs(F.col("p") - 0.5) < 0.02).cast("double")).alias("no_separation_rate"), F.count("*").alias("n"))


def threshold_table(rows: DataFrame, thresholds: tuple[float, ...] = (0.3, 0.4, 0.5, 0.6, 0.7)) -> DataFrame:
    each = rows.select("y", "p", F.explode(F.array(*map(F.lit, thresholds))).alias("threshold")).withColumn("said", F.col("p") >= F.col("threshold"))
    counts = each.groupBy("threshold").agg(F.count_if(F.col("said") & (F.col("y") == 1)).alias("tp"), F.count_if("said").alias("pp"), F.count_if(F.col("y") == 1).alias("np"))
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    scored = counts.withColumn("precision", share(F.col("tp"), F.col("pp"))).withColumn("recall", share(F.col("tp"), F.col("np")))
    return scored.select("threshold", "precision", "recall", share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")).alias("f1"))


def _by_score(rows: DataFrame) -> DataFrame:
    """Counts of each distinct score with running totals from the greatest down.

    Scores are summed within ranges first, so that the windows over all of them see one row a range.
    """
    counts = rows.groupBy("p").agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg")).withColumn("range", F.floor(F.col("p") * 1024))
    ranges = counts.groupBy("range").agg(F.sum("pos").alias("rp"), F.sum("neg").alias("rn"))
    above = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("range", F.coalesce(F.sum("rp").over(above), F.lit(0)).alias("bp"), F.coalesce(F.sum("rn").over(above), F.lit(0)).alias("bn"))
    inside = Window.partitionBy("range").orderBy(F.desc("p")).rowsBetween(Window.unboundedPreceding, 0)
    return counts.join(ranges, "range").withColumn("tp", F.col("bp") + F.sum("pos").over(inside)).withColumn("fp", F.col("bn") + F.sum("neg").over(inside))


def roc_auc(rows: DataFrame) -> DataFrame:
    """One row, roc_auc: the share of pairs in which the positive scores higher, ties counted half; null with one class."""
    pairs = F.sum(F.col("neg") * (F.col("tp") - F.col("pos")) + F.col("neg") * F.col("pos") * 0.5)
    return _by_score(rows).agg(F.try_divide(pairs, F.sum("pos") * F.sum("neg").cast("double")).alias("roc_auc"))


def average_precision(rows: DataFrame) -> DataFrame:
    """One row, pr_auc: precision at each distinct score weighted by the recall it adds; null without positives."""
    return _by_score(rows).agg(F.try_divide(F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))), F.sum("pos").cast("double")).alias("pr_auc"))


def summary_scores(rows: DataFrame) -> DataFrame:
    """One row over (summary, reference): compliance with 150 words, upper median and greatest word count, empty rate, mean scores."""
    n = text.word_count(F.col("summary"))
    counted = rows.select(n.alias("n"), (text.strip(F.col("summary")) == "").cast("double").alias("empty"), text.section_compliance(F.col("summary")).alias("sections"), arrow.rouge_l("summary", "reference").alias("rouge"))
    from loamwork.operators.curation import length_summary

    means = counted.agg(F.avg(F.col("n").between(1, 150).cast("double")).alias("word_limit_compliance"), F.avg("empty").alias("empty_rate"), F.avg("sections").alias("section_format_mean"), F.avg("rouge").alias("rouge_l_mean"))
    return means.crossJoin(F.broadcast(length_summary(counted, "n", []).select("n", F.col("p50").alias("word_count_p50"), F.col("max").alias("word_count_max"))))


def provider_scores(rows: DataFrame, by: tuple[str, ...] = ("model",)) -> DataFrame:
    """accuracy, json_valid_rate, median_latency and n over rows (model, hit, json_valid, latency), by model or also by subset."""
    means = rows.groupBy(*by).agg(F.avg(F.col("hit").cast("double")).alias("accuracy"), F.avg(F.col("json_valid").cast("double")).alias("json_valid_rate"), F.count("*").alias("n"))
    middle = medians(rows, by, "latency", "median_latency").withColumnsRenamed({c: f"_{c}" for c in by})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    return means.join(middle, same, "left").select(*by, "accuracy", "json_valid_rate", "median_latency", "n")


def latency(rows: DataFrame, by: str = "model") -> DataFrame:
    """(model, median, p95): the elements at floor(n q) of the latencies in order."""
    return nearest_rank(rows, [by], "latency", {"median": 0.5, "p95": 0.95})
