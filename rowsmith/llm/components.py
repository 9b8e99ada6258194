"""Connected components by smallest label, with pointer jumping; every round is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.session import materialise

ROWS_A_FILE = 500_000


def connected(edges: DataFrame) -> DataFrame:
    """(u, label) for every node of the undirected ``edges`` (u, v): the smallest node it can reach."""
    both = materialise(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    # A short list of edges needs few files a round.
    parts = max(4, both.count() // ROWS_A_FILE)
    labels = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("label")).coalesce(parts), "labels")
    while True:
        far = both.join(labels.select(F.col("u").alias("v"), "label"), "v").groupBy("u").agg(F.min("label").alias("near"))
        stepped = labels.join(far, "u").select("u", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        top = labels.select(F.col("u").alias("label"), F.col("label").alias("top"))
        # The label of my label: halves the distance that is left.
        jumped = materialise(stepped.join(top, "label").select("u", "was", F.least("label", "top").alias("label")).coalesce(parts), "labels")
        labels = jumped.select("u", "label")
        if not jumped.where("label <> was").limit(1).count():
            return labels
