"""Commands of an evaluation run: python -m quillon COMMAND --data questions.csv --config run.json [--client NAME] [--repeats N].

generate, judge, judge-mean, pairs, stats, rank, patch and repair read what the commands before them left below the output folder;
two-answers judges a table of its own. Each configured model is called as its settings say (see clients.services); --client
names the client of models that name none.

generate and repair each write a version of the candidates, and whatever follows reads the latest: what was repaired is
judged. judge and two-answers ask every judge N times; with more than one run, judged holds what repeats come to. judge-mean
judges on the scale of means. stats reports on judged; rank merges the human ranks of --ranks (JSON Lines) into manual_ranks.
Tasks and replies of models are kept there, so a command that was killed goes on where it stopped, and a repeated one asks only
for what is missing. What was asked is printed batch by batch.
"""

from __future__ import annotations

import argparse
import functools
import json
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.operators.candidates import group_by_sample
from quillon.operators.incremental import manual_rank_rows, manual_upsert
from quillon.operators.repeats import repeat_aggregate
from quillon.operators.stats import model_stats
from quillon.plans import clients, config, stages
from quillon.sources import readers, writers

SCORES = ("sample_id", "_pos", "candidate_id", "model_name", "model_type", "aggregate_score", "ground_score", "structure_score", "total_score_20")
COMMANDS = ("generate", "judge", "judge-mean", "pairs", "stats", "rank", "patch", "repair", "two-answers")
MANUAL = "sample_id string, source_file string, context string, manual_ranks array<struct<candidate_id: string, model_name: string, model_type: string, aggregate_score: double, ground_score: double, structure_score: double, manual_score: int>>"


class Folder:
    """Tables below the output folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def write(self, rows: DataFrame, name: str) -> str:
        rows.write.mode("overwrite").parquet(f"{self.path}/{name}")
        return f"{self.path}/{name}"

    def latest(self, name: str) -> int:
        """The number of the latest version that was written to its end; -1 if there is none."""
        try:
            return self.read(name).agg(F.max("version")).first()[0]
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return -1

    def read_latest(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}/version={self.latest(name)}")

    def write_next(self, rows: DataFrame, name: str) -> str:
        return self.write(rows, f"{name}/version={self.latest(name) + 1}")


def run(spark: SparkSession, command: str, data: str, settings: str, client: str = "stub", repeats: int = 1, ranks: str | None = None) -> str:
    """Runs one command; the folder that it wrote."""
    own = config.read_config(spark, settings, data)
    # Wrong names of clients or settings end the command here, before any job.
    generators, judges = clients.services(own.generators, client), clients.services(own.judges, client)
    out = Folder(spark, own.folder)
    how = lambda name: {"store": f"{own.folder}/replies_{name}", "progress": lambda p: print(json.dumps(p), file=sys.stderr)}
    rounds = [(j.model_name, i) for j in own.judges for i in range(repeats)]
    if command in ("judge", "judge-mean", "two-answers") and not rounds:
        raise ValueError("the configuration names no judges")
    stacked = lambda parts: functools.reduce(DataFrame.unionByName, parts)

    if command == "two-answers":
        rows = readers.scan_two_answers(spark, data)
        out.write(stacked([stages.judge_two_answers_run(rows, j, judges, i, how=how("judge")) for j, i in rounds]), "two_answers_runs")
        judged = out.read("two_answers_runs")
        return out.write(stages.wide_two_answers(rows, repeat_aggregate(judged, "judge") if repeats > 1 else judged, "judge"), "two_answers")
    if command == "stats":
        writers.write_stats(model_stats(out.read("judged")), f"{own.folder}/stats")
        return f"{own.folder}/stats"
    if command == "rank":
        known = manual_rank_rows(group_by_sample(out.read("judged").select(*SCORES)), data)
        return out.write(manual_upsert(known, readers.read_stage(spark, ranks, MANUAL), "sample_id", "source_file") if ranks else known, "manual_ranks")
    samples = readers.check_unique_ids(readers.scan_samples(spark, data))
    table = config.model_table(spark, own.generators)
    if command == "generate":
        return out.write_next(stages.generate(samples, table, generators, **how("generate")), "generated")
    if command == "judge":
        out.write(stacked([stages.judge_deductions(out.read_latest("generated"), samples, j, judges, repeat=i, how=how("judge")) for j, i in rounds]), "judged_runs")
        judged = out.read("judged_runs")
        return out.write(repeat_aggregate(judged, "judge") if repeats > 1 else judged, "judged")
    if command == "judge-mean":
        return out.write(stacked([stages.judge_mean(out.read_latest("generated"), samples, j, judges, run=i, **how("judge")).withColumn("repeat_idx", F.lit(i)) for j, i in rounds]), "judged_mean")
    if command == "pairs":
        return out.write(stages.build_pairs(out.read("judged"), own.ranking.top_k, own.ranking.bottom_k, own.ranking.min_score_diff), "pairs")
    if command == "patch":
        raw = readers.raw_samples(spark, data)
        writers.write_patch(raw, stages.patch(raw, group_by_sample(out.read("judged").select(*SCORES)), data), f"{own.folder}/patch")
        return f"{own.folder}/patch"
    out.write_next(stages.repaired_candidates(samples, table, out.read_latest("generated"), generators, **how("generate")), "generated")
    return out.write(stages.with_contexts(samples, out.read_latest("generated")), "repaired")


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="quillon", description=__doc__)
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("--data", required=True, help="CSV of questions, or of questions with two answers")
    parser.add_argument("--config", required=True, help="configuration of generators, judges and ranking")
    parser.add_argument("--client", default="stub", help="a registered client, or module:attribute")
    parser.add_argument("--repeats", type=int, default=1, help="runs of each judge")
    parser.add_argument("--ranks", help="human ranks as JSON Lines")
    given = parser.parse_args(arguments)
    print(run(SparkSession.builder.appName("quillon").getOrCreate(), given.command, given.data, given.config, given.client, given.repeats, given.ranks))


if __name__ == "__main__":
    main()
