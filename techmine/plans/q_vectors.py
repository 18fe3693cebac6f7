"""Vector queries (ML1, ML2): embeddings stand for the names' embeddings, and every
row whose id is divisible by 20 for a name that is attached to its nearest other."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from techmine.operators import vectors as V
from techmine.plans.registry import query
from techmine.sources.tables import table

CLUSTERS = 16
ROUNDS = 12
SEEDS = 8


def _points(spark, base, unit=False):
    return V.points(table(spark, base, "embeddings").select("vec_id", "embedding"), unit=unit)


_ROUND_SQL = """
d{r} AS (SELECT x.vec_id, c.k, sum((x.v - c.v) * (x.v - c.v)) AS d FROM x JOIN c{p} c ON x.i = c.i GROUP BY ALL),
a{r} AS (SELECT vec_id, arg_min(k, (d, k)) AS k FROM d{r} GROUP BY vec_id),
c{r} AS (SELECT a.k, x.i, avg(x.v) AS v FROM x JOIN a{r} a ON x.vec_id = a.vec_id GROUP BY ALL)"""


@query("kmeans_two_rounds", f"""
WITH x AS (SELECT vec_id, i, embedding[i]::DOUBLE AS v
           FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)),
c0 AS (SELECT vec_id AS k, i, v FROM x WHERE vec_id < {SEEDS}),{','.join(_ROUND_SQL.format(r=r, p=r - 1) for r in (1, 2, 3))}
SELECT vec_id, k::INT AS cluster FROM a3
""")
def kmeans_two_rounds(spark, base):
    """Clusters after two rounds from the first vectors as centres."""
    rows = _points(spark, base)
    start = [r["vector"] for r in rows.where(F.col("id") < SEEDS).orderBy("id").collect()]
    centres = np.array(start)
    for _ in range(2):
        centres, _, _ = V.lloyd_round(rows, centres)
    return V.assigned(rows, centres).select(F.col("id").alias("vec_id"), "cluster")


@query("kmeans_clusters")
def kmeans_clusters(spark, base):
    """Clusters of all vectors from k-means|| seeds, with the rounds it took."""
    rows = _points(spark, base)
    found = V.kmeans(rows, CLUSTERS, ROUNDS)
    out = V.assigned(rows, found.centres)
    return out.select(F.col("id").alias("vec_id"), "cluster", "cost", F.lit(len(found.costs) - 1).alias("rounds"))


def _index(spark, base):
    rows = _points(spark, base, unit=True)
    return V.build_index(rows, CLUSTERS), rows.where(F.col("id") % 20 == 0)


@query("nearest_name", """
WITH n AS (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda v: v::DOUBLE * v::DOUBLE))) AS w
           FROM embeddings),
x AS (SELECT vec_id, i, embedding[i]::DOUBLE / w AS v
      FROM (SELECT vec_id, embedding, w, unnest(range(1, len(embedding) + 1)) AS i FROM n WHERE w > 0)),
d AS (SELECT q.vec_id, x.vec_id AS other, sum((q.v - x.v) * (q.v - x.v)) AS d
      FROM x q JOIN x ON q.i = x.i AND q.vec_id <> x.vec_id WHERE q.vec_id % 20 = 0 GROUP BY ALL)
SELECT vec_id, arg_min(other, (d, other)) AS nearest_id, round(sqrt(min(d)), 6) AS distance FROM d GROUP BY vec_id
""")
def nearest_name(spark, base):
    """The nearest other name by cosine, exact."""
    index, asked = _index(spark, base)
    out = V.nearest(index, asked, exact=True)
    return out.select(F.col("id").alias("vec_id"), "nearest_id", F.round("distance", 6).alias("distance"))


@query("nearest_name_recall")
def nearest_name_recall(spark, base):
    """Recall of the probed lists alone, against the exact search."""
    index, asked = _index(spark, base)
    return V.recall(V.nearest(index, asked), V.nearest(index, asked, exact=True))
