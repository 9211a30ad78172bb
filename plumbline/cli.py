"""``python -m plumbline.cli --config FILE``: read a table, run scorers, write the record.

The configuration is JSON (YAML where a parser is installed)::

    {"data": {"path": "in.jsonl", "key": "id"}, "output": "scores",
     "scorers": {"NgramScorer": {"keys": ["text"], "ngrams": 5}}}

``data`` may name a ``manifest`` (one file a line) instead of a path; ``"resume": true``
skips rows that the output has scores of.
"""

from __future__ import annotations

import argparse
import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from plumbline import record, sinks
from plumbline.operators.models import SCORERS, list_scorers
from plumbline.operators.scorers import Scorer, evaluate
from plumbline.sources.files import load_dataset


@dataclass
class Config:
    path: str | None
    output: str
    scorers: dict[str, dict]
    key: str | None = None
    keys: list[str] = field(default_factory=lambda: ["text"])
    manifest: str | None = None
    resume: bool = False

    @classmethod
    def load(cls, path: str) -> "Config":
        with open(path, encoding="utf-8") as f:
            body = f.read()
        try:
            raw = json.loads(body)
        except ValueError:
            import yaml  # only where it is installed

            raw = yaml.safe_load(body)
        unknown = [n for n in raw["scorers"] if n not in SCORERS]
        if unknown:
            raise KeyError(f"no scorer named {', '.join(unknown)}")
        data = raw["data"]
        return cls(data.get("path"), raw["output"], raw["scorers"], data.get("key"), data.get("keys", ["text"]), data.get("manifest"), bool(raw.get("resume", False)))


def run(spark: SparkSession, config: Config) -> None:
    df = load_dataset(spark, path=config.path, manifest_path=config.manifest)
    key = config.key or "__row"
    if config.key is None:
        df = df.withColumn(key, F.xxhash64(F.to_json(F.struct("*"))))
    resumed = config.resume and sinks.is_published(spark, f"{config.output}/items")
    if resumed:  # rows whose scores are there already are skipped
        done = spark.read.json(f"{config.output}/items").select(F.col("item").cast("string").alias("__done"))
        df = df.join(done.distinct(), F.col(key).cast("string") == F.col("__done"), "left_anti")
    scorers = [Scorer(n, o.get("keys", config.keys), {k: v for k, v in o.items() if k != "keys"}) for n, o in config.scorers.items()]
    items, whole = evaluate(df, key, scorers)
    if items is not None:
        record.write(items, whole, config.output, add=resumed)
    elif whole is not None:
        whole.write.mode("overwrite").json(f"{config.output}/meta")


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--config")
    parser.add_argument("--list", action="store_true", help="print the scorers")
    args = parser.parse_args()
    if args.list or not args.config:
        print("\n".join(list_scorers()))
        return
    run(SparkSession.builder.getOrCreate(), Config.load(args.config))


if __name__ == "__main__":
    main()
