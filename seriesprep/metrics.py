"""Scores and result tables. Every score is one grouped aggregate over predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesprep.functions.scalars import col, is_finite

CLASSES = (0, 1, 2)


def rmse_expr(y: Column, p: Column) -> Column:
    """Root mean squared error over the rows with both values."""
    gap = y - p
    return F.sqrt(F.avg(gap * gap))


def rmse(df: DataFrame, y: str = "y_true", p: str = "y_pred", group: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*group).agg(rmse_expr(col(y), col(p)).alias("rmse"))


def rmse_finite(df: DataFrame, y: str = "y_true", p: str = "y_pred", group: Sequence[str] = ()) -> DataFrame:
    """RMSE over rows whose two values are finite, with their number; null without such rows."""
    both = is_finite(col(y)) & is_finite(col(p))
    gap = F.when(both, col(y) - col(p))
    return df.groupBy(*group).agg(
        F.count(gap).alias("n"), F.sqrt(F.avg(gap * gap)).alias("rmse")
    )


def macro_rmse(per_target: DataFrame, group: Sequence[str] = (), value: str = "rmse") -> DataFrame:
    """Mean over the targets that have a score."""
    return per_target.groupBy(*group).agg(F.avg(value).alias("macro_rmse"))


def accuracy(df: DataFrame, y: str = "y", p: str = "p", group: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.avg((col(y) == col(p)).cast("int")).alias("accuracy")
    )


def confusion_counts(df: DataFrame, y: str = "y", p: str = "p", group: Sequence[str] = ()) -> DataFrame:
    """Rows per (group, true class, predicted class): all class scores derive from it."""
    return df.groupBy(*group, col(y).alias("y"), col(p).alias("p")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(
    df: DataFrame, y: str = "y", p: str = "p", classes: Sequence[int] = CLASSES, group: Sequence[str] = ()
) -> DataFrame:
    """One row per true class, one column per predicted class, zeros included."""
    cells = [F.count_if(col(p) == c).alias(f"pred_{c}") for c in classes]
    counts = df.groupBy(*group, col(y).alias("y")).agg(*cells)
    grid = counts.select(*group).distinct() if group else df.sparkSession.range(1).select()
    grid = grid.select(*group, F.explode(F.array(*[F.lit(int(c)) for c in classes])).alias("y"))
    return grid.join(counts, [*group, "y"], "left").fillna(0)


def _per_class(df: DataFrame, y: str, p: str, group: Sequence[str]) -> DataFrame:
    """Support, predicted and correct rows of every class seen or predicted."""
    counts = confusion_counts(df, y, p, group)
    zero = F.lit(0).cast("long")
    correct = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(zero)
    sides = F.array(
        F.struct(F.col("y").alias("label"), F.col("n").alias("support"), zero.alias("predicted"), correct.alias("correct")),
        F.struct(F.col("p").alias("label"), zero.alias("support"), F.col("n").alias("predicted"), zero.alias("correct")),
    )
    return counts.select(*group, F.explode(sides).alias("_s")).groupBy(*group, F.col("_s.label").alias("label")).agg(
        *[F.sum(f"_s.{c}").alias(c) for c in ("support", "predicted", "correct")]
    )


def _class_scores(per_class: DataFrame) -> DataFrame:
    def share(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))

    hits = F.col("correct")
    return per_class.withColumns({
        "precision": share(hits, F.col("predicted")),
        "recall": share(hits, F.col("support")),
        "f1": share(2 * hits, F.col("predicted") + F.col("support")),
    })


def class_scores(df: DataFrame, y: str = "y", p: str = "p", group: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support of every class seen or predicted; 0 for 0/0."""
    scored = _class_scores(_per_class(df, y, p, group))
    return scored.select(*group, "label", "precision", "recall", "f1", "support")


def macro_scores(df: DataFrame, y: str = "y", p: str = "p", group: Sequence[str] = ()) -> DataFrame:
    """Accuracy, macro F1 and macro recall over the union of seen and predicted classes."""
    return _class_scores(_per_class(df, y, p, group)).groupBy(*group).agg(
        F.sum("support").alias("n"),
        (F.sum("correct") / F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"), F.avg("recall").alias("macro_recall"),
    )


def classification_report(df: DataFrame, y: str = "y", p: str = "p", group: Sequence[str] = ()) -> DataFrame:
    """Scores per class, then the accuracy, macro and weighted rows."""
    per_class = _class_scores(_per_class(df, y, p, group))
    scores = ("precision", "recall", "f1")
    named = per_class.select(*group, F.col("label").cast("string").alias("label"), *scores, "support")
    total = F.sum("support")
    correct = F.sum("correct") / total
    summary = per_class.groupBy(*group).agg(
        F.struct(F.lit("accuracy").alias("label"), *[correct.alias(s) for s in scores],
                 total.alias("support")).alias("_a"),
        F.struct(F.lit("macro avg").alias("label"), *[F.avg(s).alias(s) for s in scores],
                 total.alias("support")).alias("_m"),
        F.struct(F.lit("weighted avg").alias("label"),
                 *[(F.sum(F.col(s) * F.col("support")) / total).alias(s) for s in scores],
                 total.alias("support")).alias("_w"),
    ).select(*group, F.explode(F.array("_a", "_m", "_w")).alias("_r")).select(*group, "_r.*")
    return named.unionByName(summary)


# --- result tables -------------------------------------------------------------------------

def prediction_table(df: DataFrame, ts: str, y: str = "y", p: str = "prediction", naive: str = "y_naive",
                     keys: Sequence[str] = ()) -> DataFrame:
    """Time, truth, forecast, naive forecast and residual."""
    return df.select(
        *keys, col(ts).alias(ts), col(y).alias("y_true"), col(p).alias("y_pred"), col(naive).alias("y_naive"),
        (col(y) - col(p)).alias("residual"),
    )


def prediction_table_class(df: DataFrame, ts: str, y: str = "y", p: str = "prediction",
                           naive: str = "y_naive", keys: Sequence[str] = ()) -> DataFrame:
    """Time, true class, predicted class and naive class."""
    return df.select(
        *keys, col(ts).alias(ts), col(y).alias("y_true"), col(p).cast("int").alias("y_pred"),
        col(naive).alias("y_naive"),
    )


def prediction_table_long(df: DataFrame, ts: str, targets: Sequence[str], y: str = "y__{t}",
                          p: str = "p__{t}", naive: str = "y_naive__{t}", keys: Sequence[str] = ()) -> DataFrame:
    """One row per time and target of a forecast of several targets."""
    def cell(t: str) -> Column:
        truth, guess = col(y.format(t=t)), col(p.format(t=t))
        return F.struct(
            F.lit(t).alias("target"), truth.alias("y_true"), guess.alias("y_pred"),
            col(naive.format(t=t)).alias("y_naive"), (truth - guess).alias("residual"),
        )

    rows = df.select(*keys, col(ts).alias(ts), F.explode(F.array(*[cell(t) for t in targets])).alias("_r"))
    return rows.select(*keys, ts, "_r.*")


def compare_datasets(tables: dict[str, DataFrame]) -> DataFrame:
    """Union of result tables with the name of the data set each came from."""
    out = None
    for name, table in tables.items():
        named = table.select(F.lit(name).alias("dataset"), "*")
        out = named if out is None else out.unionByName(named, allowMissingColumns=True)
    return out


def improvement(df: DataFrame, model: str, baseline: str, higher_is_better: bool = False,
                name: str = "improvement") -> DataFrame:
    """Positive where the model beats the baseline."""
    gap = col(model) - col(baseline) if higher_is_better else col(baseline) - col(model)
    return df.withColumn(name, gap)


def pivot_horizon(df: DataFrame, value: str, horizons: Sequence[int], rows: Sequence[str] = ("target",)) -> DataFrame:
    """Targets down, horizons across; the known horizons spare the distinct pass."""
    cells = [F.max(F.when(col("horizon") == h, col(value))).alias(f"h{h}") for h in horizons]
    return df.groupBy(*rows).agg(*cells)


def metrics_by_horizon(df: DataFrame, scores: Sequence[str]) -> DataFrame:
    """Result rows in horizon order, one row per horizon (small table)."""
    return df.select("horizon", *scores).orderBy("horizon")
