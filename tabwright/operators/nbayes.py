"""Multinomial naive Bayes per group, in relational form.

Fitting sums the weights of the training rows by (group, term), a column a class; totals, vocabulary and classes of a group
are sums of that.  Scoring gives a block of packed rows the log-probabilities of its own (group, term) pairs.  Every group gets
its own model in the same plan — no driver loop over groups; the driver learns the names of the classes only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwright.operators import blocks as BL


def _named(group: str, term):
    """A term within its group as one string."""
    g = F.col(group).cast("string")
    return F.concat(F.length(g).cast("string"), F.lit(":"), g, term)


def fit(weights: DataFrame, labels: DataFrame, key: str, group: str, label: str, alpha: float = 0.01) -> tuple[DataFrame, list, DataFrame]:
    """(group, term, logps), the classes (logps has one place for each, 0 where the group does not have it) and the priors
    (group, cls, prior); smoothing ``alpha``; the vocabulary is the group's training terms.

    weights: (key, term, w) or packed; labels: (key, group, label)."""
    lab = labels.select(key, group, F.col(label).alias("cls"))
    classes = sorted(r[0] for r in lab.where("cls IS NOT NULL").select("cls").distinct().collect())  # few
    t = BL.entries(BL.packed(weights, key).join(lab, key), [group, "cls"])
    fc = BL.stored(t.groupBy(group, "term").agg(*[F.sum(F.when(F.col("cls") == c, F.col("w"))).alias(f"_f{i}") for i, c in enumerate(classes)],
                                                F.count(F.lit(1)).alias("_n")))
    tot = fc.groupBy(group).agg(*[F.sum(f"_f{i}").alias(f"_t{i}") for i in range(len(classes))], F.count(F.lit(1)).alias("_nv"))
    logps = [F.coalesce(F.log((F.coalesce(f"_f{i}", F.lit(0.0)) + alpha) / (F.col(f"_t{i}") + alpha * F.col("_nv"))), F.lit(0.0))
             for i in range(len(classes))]
    model = fc.join(tot, group).select(group, "term", F.array(*logps).cast("array<double>").alias("logps"))
    prior = lab.distinct().groupBy(group, "cls").agg(F.count(F.lit(1)).alias("nd")).withColumn(
        "prior", F.log(F.col("nd") / F.sum("nd").over(Window.partitionBy(group))))  # classes per group: few rows
    return model, classes, prior.select(group, "cls", "prior")


def predict(weights: DataFrame, docs: DataFrame, key: str, group: str, model: DataFrame, classes: list, prior: DataFrame) -> DataFrame:
    """Most likely class per document (ties → smallest class); terms outside the group's
    vocabulary are ignored; a document without known terms gets the prior's choice."""
    d = docs.select(key, group)
    cand = d.join(prior, group)
    if classes:
        rows = BL.packed(weights, key).join(d.where(F.col(group).isNotNull()), key)
        with BL.tidy(weights.sparkSession):
            x = BL.stored(rows.select(key, F.transform("terms", lambda t: _named(group, t)).alias("terms"), "ws"))
            blocks = BL.in_blocks(x, key, 1_000_000)
            at = BL.places(blocks)
            sums = BL.stored(BL.times(blocks, at, key, model.select(_named(group, F.col("term")).alias("term"), "logps"), "logps", "lls"))
            BL.drop(x, at)
        each = F.arrays_zip(F.array(*[F.lit(c) for c in classes]).alias("cls"), F.col("lls").alias("ll"))
        s = sums.select(key, F.inline(each).alias("cls", "ll")).groupBy(key, "cls").agg(F.sum("ll").alias("ll"))
    else:
        s = cand.select(key, "cls", F.lit(0.0).alias("ll")).limit(0)
    cand = cand.join(s, [key, "cls"], "left").select(key, "cls", (F.col("prior") + F.coalesce("ll", F.lit(0.0))).alias("score"))
    w = Window.partitionBy(key).orderBy(F.desc("score"), F.asc("cls"))  # rows per document = classes
    return cand.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(key, F.col("cls").alias("pred"))
