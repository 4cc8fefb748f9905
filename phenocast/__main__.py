"""Command line: the pipeline steps on raw files.

    python -m phenocast bloom STATUS_CSV OUT_DIR [--site S --species P]
    python -m phenocast representatives BLOOM_CSV OUT_DIR [--mode columnwise_max|most_observed] [--by-file]
    python -m phenocast features WEATHER_DIR OUT_DIR
    python -m phenocast training BLOOM_DIR WEATHER_FEATURES OUT_DIR
    python -m phenocast train TRAINING OUT_MODEL [--threshold 0.9]
    python -m phenocast search TRAINING OUT_DIR [--preset base|base_2|expansive|combined|random] [--settings N]
    python -m phenocast score MODEL INPUT_CSV OUT_BASE

Inputs are CSV files or folders of them; outputs are folders written once
(never overwritten).  The master and all settings come from spark-submit /
the environment; on a cluster, set ``spark.checkpoint.dir`` to a shared path.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _spark() -> SparkSession:
    """The session that spark-submit or the environment describes; nothing is set here."""
    return SparkSession.builder.getOrCreate()


def main(argv=None) -> int:
    from phenocast.operators import models

    ap = argparse.ArgumentParser(prog="phenocast")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("bloom", help="status observations -> first bloom per site and year")
    b.add_argument("status_csv"); b.add_argument("out")
    b.add_argument("--site", type=int); b.add_argument("--species", type=int)
    r = sub.add_parser("representatives", help="bloom table -> clusters, representatives, their rows")
    r.add_argument("bloom_csv"); r.add_argument("out")
    r.add_argument("--mode", default="columnwise_max", choices=["columnwise_max", "most_observed"])
    r.add_argument("--restarts", type=int, default=10)
    r.add_argument("--by-file", action="store_true",
                   help="BLOOM_CSV is a folder; cluster each file on its own")
    f = sub.add_parser("features", help="daily weather files -> monthly feature table")
    f.add_argument("weather_dir"); f.add_argument("out")
    t = sub.add_parser("training", help="bloom files + weather features -> training set")
    t.add_argument("bloom_dir"); t.add_argument("features"); t.add_argument("out")
    m = sub.add_parser("train", help="training set -> model bundle (two-stage selection)")
    m.add_argument("training"); m.add_argument("out"); m.add_argument("--threshold", type=float, default=0.9)
    g = sub.add_parser("search", help="training set -> cross-validated settings and the best model")
    g.add_argument("training"); g.add_argument("out")
    g.add_argument("--preset", default="base", choices=[*models.GRID_PRESETS, "random"])
    g.add_argument("--settings", type=int, help="how many settings to draw (default: all of a grid, 1000 random)")
    g.add_argument("--parallelism", type=int, default=4, help="fits submitted at once (mllib), or trained in lockstep (histogram)")
    g.add_argument("--engine", default="mllib", choices=["mllib", "histogram"])
    g.add_argument("--ledger", help="shared folder of finished scores; a search that finds its own goes on from there")
    s = sub.add_parser("score", help="model bundle + new rows -> predictions with intervals")
    s.add_argument("model"); s.add_argument("input_csv"); s.add_argument("out_base")
    a = ap.parse_args(argv)

    from phenocast.operators import phenology, spatial
    from phenocast.plans import pipeline
    from phenocast.sources import readers, schemas, writers
    from phenocast.sources.model_store import load_model_bundle, save_model_bundle

    spark = _spark()
    if a.cmd == "bloom":
        obs = readers.read_status_obs(spark, a.status_csv)
        if a.site is not None and a.species is not None:
            keys = {"Site_ID": a.site, "Species_ID": a.species}
            one, rest = phenology.split_by_keys(obs, keys)
            writers.write_csv(pipeline.bloom_from_status(one), f"{a.out}/selected")
            writers.write_csv(pipeline.bloom_from_status(rest), f"{a.out}/rest")
        else:
            writers.write_csv(pipeline.bloom_from_status(obs), a.out)
    elif a.cmd == "representatives":
        if a.by_file:
            bloom = readers.read_bloom(spark, a.bloom_csv, key="source_file")
            group = ["source_file"]
        else:
            bloom, group = readers.read_bloom(spark, a.bloom_csv), []
        clusters, reps, rows = spatial.representative_locations(
            bloom, mode=a.mode, restarts=a.restarts, group=group)
        writers.write_representatives(clusters, reps, rows, a.out, group=group)
    elif a.cmd == "features":
        wide = pipeline.weather_feature_table(readers.read_weather_daily(spark, a.weather_dir))
        writers.write_csv(wide, a.out)
    elif a.cmd == "training":
        bloom = readers.read_bloom(spark, a.bloom_dir, key="source_file")
        bloom = bloom.withColumn("location", F.col("source_file")).drop("source_file")
        wide = readers.read_csv(spark, a.features, schemas.WEATHER_WIDE)
        writers.write_csv(pipeline.training_from_tables(bloom, wide), a.out)
    elif a.cmd == "train":
        data = readers.read_csv(spark, a.training, schemas.TRAINING)
        feats = schemas.WIDE_FEATURES
        train, test = models.train_test(data, ["location", "year"], 0.2, 42)
        selected, fitted, _ = models.two_stage_selection(train, test, feats, "bloom_doy", a.threshold)
        save_model_bundle(fitted, a.out)
        models.evaluate(fitted, test, "bloom_doy").show()
    elif a.cmd == "search":
        data = readers.read_csv(spark, a.training, schemas.TRAINING)
        if a.preset == "random":
            settings = models.draw_settings(models.RANDOM_SEARCH_SPACE, a.settings or 1000, 42)
        else:
            grid = models.GRID_PRESETS[a.preset]
            ok = models.supported if a.engine == "mllib" else (lambda p: p.get("criterion") != "mae")
            settings = models.draw_grid(grid, a.settings or len(models.expand_grid(grid)), 42, ok)
        table, best = models.cross_validate(data, schemas.WIDE_FEATURES, "bloom_doy", settings, 5,
                                            "r2" if a.preset == "random" else "mse", 42, a.parallelism,
                                            keys=["location", "year"], ledger=a.ledger, engine=a.engine)
        writers.write_csv(table, f"{a.out}/settings")
        if a.engine == "histogram":
            best.save(spark, f"{a.out}/model")
        else:
            save_model_bundle(best, f"{a.out}/model")
    elif a.cmd == "score":
        fitted = load_model_bundle(spark, a.model)
        rows = readers.read_csv(spark, a.input_csv, schemas.SCORING_INPUT)
        scored = fitted.transform(rows, "_raw").persist()
        out = pipeline.predictions_table(fitted, rows, scored=scored)
        writers.write_csv(out, writers.run_output_path(a.out_base))
    return 0


if __name__ == "__main__":
    sys.exit(main())
