"""spark-submit --conf spark.txscore.<setting>=... jobs/load_history.py LOAD_ID [--compact]"""

from __future__ import annotations

import argparse

from txscore.plans.load_history import load_history
from txscore.session import build
from txscore.settings import Settings


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("load_id", help="names this load; repeating it replaces its rows")
    parser.add_argument("--compact", action="store_true", help="fewer, larger files per class")
    args = parser.parse_args()
    spark = build("load-history")
    print(load_history(spark, Settings.from_spark(spark), args.load_id, compact=args.compact))


if __name__ == "__main__":
    main()
