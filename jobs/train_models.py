"""spark-submit --conf spark.txscore.<setting>=... jobs/train_models.py VERSION"""

from __future__ import annotations

import argparse
from dataclasses import replace

from txscore.plans.train_models import CLUSTERED, TrainingOptions, train_models
from txscore.session import build
from txscore.settings import Settings


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("version", help="a new name for the trained models, such as the day")
    parser.add_argument("--method", choices=["weights", "undersample", "kmeans"])
    parser.add_argument("--clustered", action="store_true", help="encode cards, k-means centres")
    parser.add_argument("--seed", type=int, default=42)
    args = parser.parse_args()
    options = replace(CLUSTERED if args.clustered else TrainingOptions(), seed=args.seed)
    if args.method:
        options = replace(options, method=args.method)
    spark = build("train-models")
    train_models(spark, Settings.from_spark(spark), args.version, options).show(truncate=False)


if __name__ == "__main__":
    main()
