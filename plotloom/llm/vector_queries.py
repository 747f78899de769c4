"""The query on embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotloom.llm import whitening
from plotloom.llm.registry import query, table


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark, folder):
    """Every usable vector on the 32 leading components, one row per vector and component."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(vectors, "embedding")
    explained = F.array(*[F.lit(float(e)) for e in model.explained]).cast("array<double>")
    rows = whitening.whiten(vectors, model, "vec_id", "embedding")
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
