"""What the weekly models go by: how much worse they get when one feature is shuffled, per stage and market."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bloomline.operators import weekly
from bloomline.sources.tables import stored

#: Rows of a stage and market that are scored, as in the reference.
SAMPLE, REPEATS, LEAST_ROWS = 4_000, 2, 20
ALL = "TODOS"
# The stages.
OCCURRENCE, VOLUME = "probabilidad_compra", "volumen_si_compra"


def bounded_sample(rows: DataFrame, most: int, seed: int) -> DataFrame:
    """At most so many rows of each group, those with the smallest hashes of seed and name. Only somewhat more than that are ranked: the others
    are cut off by the share of hashes that a group of its size needs."""
    named = rows.withColumn("h", F.shiftrightunsigned(F.xxhash64("name", F.lit(seed)), 1).cast("double") / F.lit(2.0**63))
    sizes = named.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))  # a row a market
    enough = F.lit(2.0 * most + 200) / F.col("n")
    few = named.join(F.broadcast(sizes), "grp").where(F.col("h") <= enough)
    place = F.row_number().over(Window.partitionBy("grp").orderBy("h", "name"))
    return few.withColumn("place", place).where(F.col("place") <= most).drop("h", "n")


def shuffled(sample: DataFrame, repeats: int, seed: int) -> DataFrame:
    """sample (grp, place, name, x) with others: for each repeat the features of another row of its group, each row's once.

    The row of rank i by the one hash gets the row of rank i by another: a permutation by a join, over groups of bounded size."""
    out = sample
    for r in range(repeats):
        rank = F.row_number().over(Window.partitionBy("grp").orderBy(F.xxhash64("name", F.lit(seed + 1 + r)), "name"))
        other = sample.select("grp", rank.alias("place"), F.col("x").alias(f"other_{r}"))
        out = out.join(other, ["grp", "place"])
    return out.withColumn("others", F.array(*[f"other_{r}" for r in range(repeats)])).drop(*[f"other_{r}" for r in range(repeats)])


def stage_losses(rows: DataFrame, features: list[str], model, loss: Column, sample: int, repeats: int, seed: int) -> DataFrame:
    """rows (grp, name, x array, y): per group and feature the mean loss of the model, as it is (feature null) and with the feature shuffled,
    for every repeat. All are scored in one pass over a long form."""
    chosen = stored(bounded_sample(rows, sample, seed), "importance-sample")
    wide = stored(shuffled(chosen, repeats, seed), "importance-shuffled")
    whole = F.struct(F.lit(-1).alias("feature"), F.lit(0).alias("repeat"))
    one = [F.struct(F.lit(i).alias("feature"), F.lit(r).alias("repeat")) for i in range(len(features)) for r in range(repeats)]
    long = wide.select("grp", "y", "x", "others", F.explode(F.array(whole, *one)).alias("c")).select(
        "grp", "y", "c.feature", "c.repeat",
        F.transform("x", lambda v, i: F.when(i == F.col("c.feature"), F.col("others")[F.col("c.repeat")][i]).otherwise(v)).alias("v"),
    )
    scored = model.transform(long.withColumn("x", array_to_vector("v")).drop("v"))
    return scored.groupBy("grp", "feature", "repeat").agg(F.avg(loss).alias("loss"), F.count(F.lit(1)).alias("rows"))


def importance_of(losses: DataFrame, features: list[str], stage: str) -> DataFrame:
    """Mean and spread, over the repeats, of what shuffling a feature adds to the loss."""
    base = losses.where("feature < 0").select("grp", F.col("loss").alias("base"), "rows")
    names = F.array(*[F.lit(f) for f in features])
    per = losses.where("feature >= 0").drop("rows").join(F.broadcast(base), "grp")  # a row a market
    worse = F.col("loss") - F.col("base")
    return per.groupBy("grp", names[F.col("feature")].alias("variable")).agg(
        F.avg(worse).alias("importance"), F.stddev_pop(worse).alias("spread"), F.max("rows").alias("rows")
    ).select(F.lit(stage).alias("stage"), F.col("grp").alias("market"), "variable", "importance", "spread", "rows")


def permutation_importance(
    fitted: weekly.TwoStage, target: DataFrame, features: list[str] = weekly.FEATURES, sample: int = SAMPLE, repeats: int = REPEATS, seed: int = 42
) -> DataFrame:
    """stage, market (TODOS: all of them), variable, importance, spread and rows of both stages of the fitted weekly models on target (featured
    weeks with stems): log loss of buying, mean error of the volume's logarithm where something was bought. Markets with fewer than LEAST_ROWS
    rows, or of which all or none buy, have none."""
    name = F.concat_ws("|", *weekly.KEY, F.col("week_start").cast("string"))
    x = vector_to_array("x")
    base = weekly.vectors(target).select("market", name.alias("name"), x.alias("x"), "stems")
    both = base.select(F.explode(F.array(F.col("market"), F.lit(ALL))).alias("grp"), "name", "x", "stems")
    both = stored(both, "importance-rows")
    bought = (F.col("stems") > 0).cast("double")
    sizes = both.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.sum(bought).alias("b")).collect()  # a row a market
    told = [r.grp for r in sizes if r.n >= LEAST_ROWS and 0 < r.b < r.n or r.grp == ALL]
    sold = [r.grp for r in sizes if r.b >= LEAST_ROWS or r.grp == ALL]
    p = F.least(F.greatest(vector_to_array("probability")[1], F.lit(1e-15)), F.lit(1 - 1e-15))
    log_loss = -(F.col("y") * F.log(p) + (1 - F.col("y")) * F.log(1 - p))
    stages = [
        (OCCURRENCE, both.where(F.col("grp").isin(told)).withColumn("y", bought), fitted.buys, log_loss),
        (VOLUME, both.where(F.col("grp").isin(sold) & (F.col("stems") > 0)).withColumn("y", F.log1p("stems")), fitted.volumes, F.abs(F.col("prediction") - F.col("y"))),
    ]
    out = None
    for stage, rows, model, loss in stages:
        part = importance_of(stage_losses(rows, features, model, loss, sample, repeats, seed), features, stage)
        out = part if out is None else out.unionByName(part)
    return out


def forecast_top_drivers(importance: DataFrame, overall: int = 4, per_market: int = 2, markets: list[str] | None = None) -> DataFrame:
    """The variables with the largest positive importance: so many of each stage over all, and of each stage and market."""
    kept = importance.where("importance > 0")
    if markets:
        kept = kept.where(F.col("market").isin([ALL, *markets]))
    place = F.row_number().over(Window.partitionBy("stage", "market").orderBy(F.desc("importance"), "variable"))
    most = F.when(F.col("market") == ALL, overall).otherwise(per_market)
    return kept.withColumn("place", place).where(F.col("place") <= most)
