"""Connected components of a link table, by repeated joins; nothing is collected but one count per round."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidecast.llm.common import saved


def components(links: DataFrame) -> DataFrame:
    """``id, label`` for every id of ``links(a, b)``: the smallest id that can be reached.

    In each round an id takes the smallest label among its own, its neighbours' and its label's label, so chains shorten
    by doubling.  A hub's neighbours are reduced to a minimum before they are shuffled.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = saved(both, "links")
    labels = saved(both.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near")))
        far = labels.select(F.col("id").alias("label"), F.col("label").alias("far"))
        new = saved(labels.join(near, "id").join(far, "label").select("id", F.least("label", "near", "far").alias("label"),
                    (F.least("near", "far") < F.col("label")).alias("moved")), "labels")
        labels = new.select("id", "label")
        if not new.where("moved").limit(1).count():
            return labels
