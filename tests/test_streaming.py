"""File-stream scoring: each landed batch is scored with its own interval."""

import os

from pyspark.sql import functions as F

from phenocast.operators import models
from phenocast.sources.model_store import save_model_bundle
from phenocast.sources.schemas import WIDE_FEATURES
from phenocast.streaming.scoring import score_stream


def test_stream_scores_each_file(spark, scratch):
    feats = WIDE_FEATURES[:3]
    train = spark.range(120).select(*[(F.col("id") % (5 + i)).cast("double").alias(f) for i, f in enumerate(feats)],
                                    (F.col("id") % 30 + 80).cast("double").alias("bloom_doy"))
    fitted = models.fit_regressor(train, feats, "bloom_doy", "gbt", settings={"maxIter": 5})
    model_path = save_model_bundle(fitted, f"{scratch}/model")
    inbox = f"{scratch}/inbox"
    os.makedirs(inbox)
    header = ["location"] + WIDE_FEATURES
    with open(f"{inbox}/2024.csv", "w", encoding="utf-8-sig") as f:
        f.write(",".join(header) + "\n")
        for loc, v in [("nyc", 1.0), ("kyoto", 3.0), ("liestal", 4.0)]:
            f.write(",".join([loc] + [str(v)] * len(WIDE_FEATURES)) + "\n")
    q = score_stream(spark, inbox, model_path, f"{scratch}/out", checkpoint=f"{scratch}/ckpt")
    q.awaitTermination(300)
    out = spark.read.option("header", True).schema(
        "location string, prediction int, lower int, upper int").csv(f"{scratch}/out/batch=0")
    rows = {r["location"]: r for r in out.collect()}
    assert set(rows) == {"newyorkcity", "kyoto", "liestal"}       # alias applied
    assert all(r["lower"] <= r["prediction"] <= r["upper"] for r in rows.values())
