"""One run of a job: stages that are finished once, outputs that appear all together.

    OUTPUT/published.json            the name of the run whose tables are the result
    OUTPUT/runs/NAME/TABLE           its tables
    OUTPUT/runs/NAME/marks/STAGE.json  one per finished stage: schema and figures

A stage's mark is written after its files, in one step. A run that is taken up again under its name
reads the stages that have a mark and does the others from their start, over whatever they have left.
Readers follow ``published.json``, which names a run only when all of its outputs are written, so
they see the tables of one run or of another, never of two. Stages that are not results lie below
``spark.checkpoint.dir``, or beside the marks where that is not set.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from leadmill.sources.files import names_in, read_text, remove, write_text

NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


class RunFolder:
    """Stages of one run, each done once under its name."""

    def __init__(self, spark: SparkSession, output: str, name: str, parameters: dict[str, Any], staged: str | None = None):
        """``parameters`` is what the results depend on; taking a run up again with others is refused."""
        if not NAME.fullmatch(name):
            raise ValueError(f"a run cannot be named {name!r}")
        self.spark, self.output, self.name = spark, output.rstrip("/"), name
        self.path = f"{self.output}/runs/{name}"
        shared = spark.conf.get("spark.checkpoint.dir", None)
        own = hashlib.sha256(self.path.encode()).hexdigest()[:16]
        self.staged_path = staged or (f"{shared.rstrip('/')}/leadmill-run-{own}" if shared else f"{self.path}/staged")
        self.built: list[str] = []  # stages done by this object, not by an earlier one
        given = json.dumps(parameters, sort_keys=True, default=str)
        known = read_text(spark, f"{self.path}/parameters.json")
        if known is None:
            # Files without a mark of their run may be of any other.
            remove(spark, self.staged_path)
            write_text(spark, f"{self.path}/parameters.json", given)
        elif known != given:
            raise ValueError(f"run {name!r} was begun with other inputs or settings: {known}, now {given}")

    def mark(self, stage: str) -> dict[str, Any] | None:
        text = read_text(self.spark, f"{self.path}/marks/{stage}.json")
        return None if text is None else json.loads(text)

    def finish(self, stage: str, **said: Any) -> None:
        write_text(self.spark, f"{self.path}/marks/{stage}.json", json.dumps(said))
        self.built.append(stage)

    def table(self, stage: str, make: Callable[[], DataFrame], figures: dict[str, Column] | None = None,
              result: bool = False) -> DataFrame:
        """The stage's table, made and written unless an earlier attempt has finished it.

        ``figures`` are aggregates that Spark takes of the rows while it writes them, kept with the mark.
        """
        path = f"{self.path if result else self.staged_path}/{stage}"
        mark = self.mark(stage)
        if mark is None:
            df = made = make()
            observation = Observation(f"{stage} {self.name}")
            if figures:
                made = df.observe(observation, *[c.alias(n) for n, c in figures.items()])
            made.write.mode("overwrite").parquet(path)
            seen = observation.get if figures else {}
            mark = {"schema": df.schema.jsonValue(), "figures": {n: seen.get(n) for n in figures or {}}}
            self.finish(stage, **mark)
        return self.finished(stage, result)

    def finished(self, stage: str, result: bool = False) -> DataFrame:
        """The table of a stage that has its mark."""
        schema = T.StructType.fromJson(self.mark(stage)["schema"])
        return self.spark.read.schema(schema).parquet(f"{self.path if result else self.staged_path}/{stage}")

    def write(self, df: DataFrame, stage: str) -> DataFrame:
        return self.table(stage, lambda: df)

    def figures(self, stage: str) -> dict[str, Any]:
        return (self.mark(stage) or {"figures": {}})["figures"]

    def once(self, stage: str, do: Callable[[str], None]) -> None:
        """Something that writes files to the path it is given, over what is there."""
        if self.mark(stage) is None:
            do(f"{self.path}/{stage}")
            self.finish(stage)

    def publish(self) -> None:
        """Make this run the result; runs published before it go."""
        before = published_run(self.spark, self.output)
        write_text(self.spark, f"{self.output}/published.json", json.dumps({"run": self.name}))
        if before not in (None, self.name):
            remove(self.spark, f"{self.output}/runs/{before}")

    def remove_staged(self) -> None:
        remove(self.spark, self.staged_path)


def published_run(spark: SparkSession, output: str) -> str | None:
    """The name of the run whose tables are the result, null if there is none yet."""
    text = read_text(spark, f"{output.rstrip('/')}/published.json")
    return None if text is None else json.loads(text)["run"]


def published(spark: SparkSession, output: str, table: str) -> str:
    """The path of a published table."""
    run = published_run(spark, output)
    if run is None:
        raise FileNotFoundError(f"nothing is published in {output}")
    return f"{output.rstrip('/')}/runs/{run}/{table}"


def unpublished_runs(spark: SparkSession, output: str) -> list[str]:
    """Names of runs that were begun and are not the result."""
    return [n for n in names_in(spark, f"{output.rstrip('/')}/runs") if n != published_run(spark, output)]
