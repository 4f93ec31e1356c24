"""Evaluation of scored rows and the record of model runs.

Scored rows carry ``target`` (0/1), ``prediction`` (0/1) and ``probability``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Bits of a digit of a score: a window orders at most so many different digits.
DIGIT_BITS = 21


def time_split(table: DataFrame, day: Column, train_share: float = 0.8) -> DataFrame:
    """Labelled rows with ``fold``: the oldest share trains, the rest tests.

    The cut is a date, so rows of one day stay together. Running totals are taken
    over one row per day; the table itself is not ordered.
    """
    labelled = table.filter(F.col("target").isNotNull()).withColumn("_day", day)
    daily = labelled.groupBy("_day").agg(F.count("*").alias("n"))
    through = W.partitionBy(F.lit(1)).orderBy("_day")
    whole = W.partitionBy(F.lit(1))
    running = daily.select(
        "_day", F.sum("n").over(through).alias("upto"), F.sum("n").over(whole).alias("total")
    )
    cutoff = running.filter(
        F.col("upto") > F.floor(F.col("total") * F.lit(train_share))
    ).agg(F.min("_day"))
    fold = F.when(F.col("_day") < cutoff.scalar(), "train").otherwise("test")
    return labelled.withColumn("fold", fold).drop("_day")


def confusion(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    hit = F.col("prediction") == F.col("target")
    up = F.col("prediction") == 1
    return scored.groupBy(*keys).agg(
        F.count("*").alias("rows"),
        F.count(F.when(hit, 1)).alias("hits"),
        F.count(F.when(up & hit, 1)).alias("true_up"),
        F.count(F.when(up, 1)).alias("said_up"),
        F.count(F.when(F.col("target") == 1, 1)).alias("was_up"),
    )


def _share(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom)


def _f1() -> Column:
    return F.coalesce(
        _share(2.0 * F.col("true_up"), F.col("said_up") + F.col("was_up")), F.lit(0.0)
    )


def accuracy(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return confusion(scored, keys).select(
        *keys, _share(F.col("hits"), F.col("rows")).alias("accuracy")
    )


def f1(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """F1 of the rising class; 0 where it is undefined."""
    return confusion(scored, keys).select(*keys, _f1().alias("f1"))


def ordered_bits(score: Column) -> Column:
    """A whole number for each double, in the same order; equal only for equal scores.

    The exponent and the 52 bits after the point, read from the hexadecimal form of the double;
    negated for negative scores. NaN is above all others, as it is in sorting.
    """
    text = F.format_string("%a", F.abs(score))
    after = F.rpad(F.regexp_extract(text, r"\.([0-9a-f]+)p", 1), 13, "0")
    exponent = F.regexp_extract(text, r"p(-?[0-9]+)$", 1).cast("long") + 1023
    # Numbers below the smallest normal one have no leading bit and the exponent of that one.
    exponent = F.when(F.substring(text, 3, 1) == "1", exponent).otherwise(0)
    one = 1 << 52
    bits = (
        F.when(F.isnan(score), F.lit(2048 * one - 1))
        .when(F.abs(score) == float("inf"), F.lit(2047 * one))
        .otherwise(exponent * F.lit(one) + F.conv(after, 16, 10).cast("long"))
    )
    return F.when(score < 0, -bits).otherwise(bits)


def _earlier(partition: Sequence[str], order: str) -> Column:
    """Falling rows before this one."""
    w = W.partitionBy(*partition).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum("down").over(w), F.lit(0))


def auc(scored: DataFrame, keys: Sequence[str] = (), digit_bits: int = DIGIT_BITS) -> DataFrame:
    """Area under the ROC curve with ties counted half; NULL with one class only.

    Rows first combine to one row per distinct score, null scores left out. The scores, as whole
    numbers in the same order, are cut into digits. From the last digit to the first, the falling rows
    below each value of a digit are running totals among the scores that agree in all digits before;
    their rows then add up to one. So no window orders more rows than a digit has values, whatever
    the scores are, and nothing is joined back.
    """
    keys = [*keys, "_all"]
    levels = -(-64 // digit_bits)
    bits = ordered_bits(F.col("probability"))
    digits = {
        f"_d{i}": F.shiftright(F.col("_bits"), digit_bits * (levels - 1 - i)).bitwiseAND((1 << digit_bits) - 1)
        if i
        else F.shiftright(F.col("_bits"), digit_bits * (levels - 1))
        for i in range(levels)
    }
    areas = (
        scored.filter(F.col("probability").isNotNull())
        .withColumn("_all", F.lit(0))
        .groupBy(*keys, "probability")
        .agg(
            F.count(F.when(F.col("target") == 1, 1)).alias("up"),
            F.count(F.when(F.col("target") == 0, 1)).alias("down"),
        )
        .withColumn("_bits", bits)
        .withColumns(digits)
        .withColumn("area", F.col("up") * F.col("down") / 2.0)
    )
    for last in reversed(digits):
        above = [*keys, *list(digits)[: list(digits).index(last)]]
        below = areas.withColumn("below", _earlier(above, last))
        areas = below.groupBy(*above).agg(
            (F.sum("area") + F.sum(F.col("up") * F.col("below"))).alias("area"),
            F.sum("up").alias("up"),
            F.sum("down").alias("down"),
        )
    pairs = F.col("up").cast("double") * F.col("down")
    return areas.select(*keys[:-1], F.when(pairs > 0, F.col("area") / pairs).alias("auc"))


def evaluate(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Accuracy, F1 and AUC, one row per key (or one row)."""
    keys = list(keys)
    basic = confusion(scored, keys).select(
        *keys,
        _share(F.col("hits"), F.col("rows")).alias("accuracy"),
        _f1().alias("f1"),
    )
    area = auc(scored, keys)
    if keys:
        return basic.join(area, keys)
    return basic.withColumn("auc", area.scalar())


def champion_gate(runs: DataFrame) -> DataFrame:
    """Replay the promotion rule over the runs in order of ``saved_at``, ``run_id``.

    A run is promoted when it has an AUC and there is no champion yet or the AUC is
    strictly greater. A run without one (test rows of one class) never is. Each row
    shows the champion it met and the three differences. The run table has one row
    per training run, with an id of its own.
    """
    order = W.partitionBy(F.lit(1)).orderBy("saved_at", "run_id")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    numbered = runs.withColumn("run_no", F.row_number().over(order))
    # The first run that reached the best AUC so far is the champion.
    rank = F.when(F.col("auc").isNotNull(), F.struct(F.col("auc"), -F.col("run_no")))
    run = F.struct("run_id", "accuracy", "f1", "auc")
    champion = numbered.withColumn("_best", F.max_by(run, rank).over(before))
    old = F.col("_best.auc")
    return champion.select(
        "run_no",
        "run_id",
        "accuracy",
        "f1",
        "auc",
        F.col("_best.run_id").alias("previous_champion"),
        (F.col("auc") - old).alias("auc_change"),
        (F.col("accuracy") - F.col("_best.accuracy")).alias("accuracy_change"),
        (F.col("f1") - F.col("_best.f1")).alias("f1_change"),
        (F.col("auc").isNotNull() & F.coalesce(F.col("auc") > old, F.lit(True))).alias("promoted"),
    )


def champion(gate: DataFrame) -> DataFrame:
    """The run promoted last, as one row."""
    return gate.filter("promoted").orderBy(F.desc("run_no")).limit(1)


def leaderboard(runs: DataFrame, digits: int = 4) -> DataFrame:
    """Models by AUC with the best one marked; shows ``train_seconds`` if it is there."""
    best = runs.agg(F.max_by("model", F.struct("auc", "model"))).scalar()
    shown = [n for n in ("accuracy", "f1", "auc", "train_seconds") if n in runs.columns]
    return runs.select(
        "model",
        *(F.round(name, digits).alias(name) for name in shown),
        (F.col("model") == best).alias("is_best"),
    )
