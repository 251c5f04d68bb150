"""spark-submit --conf spark.txscore.<setting>=... jobs/score_stream.py [--until-caught-up]"""

from __future__ import annotations

import argparse

from txscore.session import build
from txscore.settings import Settings
from txscore.streaming.control import BatchMetrics, await_end
from txscore.streaming.scoring import start_scoring


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--until-caught-up", action="store_true", help="stop at the end of the topic")
    args = parser.parse_args()
    spark = build("score-stream")
    cfg = Settings.from_spark(spark)
    metrics = BatchMetrics(spark, cfg)
    spark.streams.addListener(metrics)
    stream = start_scoring(spark, cfg, until_caught_up=args.until_caught_up, metrics=metrics)
    await_end(stream, spark, cfg)


if __name__ == "__main__":
    main()
