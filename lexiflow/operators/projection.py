"""2-D projection of an embedding table (M8)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def svd2(emb: DataFrame, col: str = "embedding", k: int = 2) -> DataFrame:
    """M8: truncated SVD of the (uncentred) embedding matrix, rows projected to
    ``U * S`` = ``A * V``. Each task sums its rows' outer products (d x d, d = the
    vector width, whatever the row count); the sums meet by cell in one aggregate
    with a map-side step. The d x d result and its k leading eigenvectors are the
    only things the driver holds; the projection is a row-local dot product.
    Signs: the largest-magnitude entry of each singular vector is made positive.
    Rows whose vector is null take no part in the sum."""
    def gram(batches):
        import pyarrow as pa

        total = None
        for batch in batches:
            rows = batch.column(0).drop_null()
            if len(rows):
                a = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)
                total = a.T @ a if total is None else total + a.T @ a
        if total is not None:
            d = len(total)
            i, j = np.divmod(np.arange(d * d), d)
            yield pa.RecordBatch.from_pydict({"i": i.astype(np.int32), "j": j.astype(np.int32), "v": total.ravel()})

    cells = emb.select(col).mapInArrow(gram, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    d = int(max(cells["i"].to_pylist(), default=-1)) + 1
    full = np.zeros((d, d))
    full[cells["i"].to_numpy(), cells["j"].to_numpy()] = cells["v"].to_numpy()
    values, vectors = np.linalg.eigh(full)
    v = vectors[:, ::-1][:, :k].copy()
    singular = np.sqrt(np.maximum(values[::-1][:k], 0))
    for j in range(v.shape[1]):
        if v[np.argmax(np.abs(v[:, j])), j] < 0:
            v[:, j] = -v[:, j]
    out = emb
    for j in range(v.shape[1]):
        vec = F.array(*[F.lit(float(x)) for x in v[:, j]])
        dot = F.aggregate(F.zip_with(F.col(col), vec, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x)
        out = out.withColumn(f"x{j + 1}", dot)
    return out.drop(col).withColumn("singular_values", F.array(*[F.lit(float(s)) for s in singular]))
