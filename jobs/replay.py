"""spark-submit --conf spark.txscore.<setting>=... jobs/replay.py [--text FOLDER]"""

from __future__ import annotations

import argparse

from txscore.plans.replay import replay
from txscore.session import build
from txscore.settings import Settings


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--text", metavar="FOLDER", help="write text files instead of the topic")
    args = parser.parse_args()
    spark = build("replay")
    sink = "text" if args.text else "kafka"
    replay(spark, Settings.from_spark(spark), sink, args.text or "")


if __name__ == "__main__":
    main()
