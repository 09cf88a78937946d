"""Model stages as DataFrame operators: pluggable runs, bounded concurrency, retries, failures as data.

A run is a triple of functions: ``build`` makes messages from a row, ``call``
asks the model, ``post`` turns the answer into output columns. Rows go through
``mapInPandas`` in Arrow batches; within a task at most ``in_flight`` calls are
open. A task may be run again by Spark, so outputs are keyed and deduplicated
on reading (``quern.operators.latest.keep_last``), and a resumed run is an
anti-join against what is there.
"""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from hashlib import sha256
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.answers import parse_answer, parse_judgment


class Refused(Exception):
    """The model gave no usable answer; such calls are tried fewer times than lost connections."""


@dataclass(frozen=True)
class Run:
    """A run definition: its name, output columns and the three functions."""

    name: str
    columns: T.StructType
    build: Callable[[dict], str]
    call: Callable[[str], str]
    post: Callable[[dict, str], dict]


def retry(call: Callable[[str], str], prompt: str, lost: int = 8, refused: int = 5, base: float = 0.0, sleep: Callable[[float], None] = time.sleep) -> str:
    """Calls with jittered exponential back-off: ``lost`` tries on any error, ``refused`` on an empty answer."""
    errors = refusals = 0
    while True:
        try:
            out = call(prompt)
            if not out or not out.strip():
                raise Refused("empty answer")
            return out
        except Refused:
            refusals += 1
            if refusals >= refused:
                raise
        except Exception:
            errors += 1
            if errors >= lost:
                raise
        sleep(base * 2 ** (errors + refusals) * random.random())


def annotate(df: DataFrame, key: str, run: Run, in_flight: int = 16) -> DataFrame:
    """key, the run's columns, and for failures category (``api`` or ``parse``) and reason."""
    schema = T.StructType([df.schema[key], *run.columns.fields, T.StructField("category", T.StringType()), T.StructField("reason", T.StringType())])
    names = run.columns.names

    def one(row: dict) -> tuple:
        try:
            raw = retry(run.call, run.build(row))
        except Exception as e:
            return (row[key], *[None] * len(names), "api", str(e)[:200])
        try:
            out = run.post(row, raw)
        except Exception as e:
            return (row[key], *[None] * len(names), "parse", str(e)[:200])
        return (row[key], *[out.get(c) for c in names], None, None)

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(in_flight) as pool:
            for pdf in batches:
                yield pd.DataFrame(list(pool.map(one, pdf.to_dict("records"))), columns=schema.names)

    return df.mapInPandas(task, schema)


def split_failures(annotated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without the failure columns; and the failures."""
    good = annotated.where("category is null").drop("category", "reason")
    return good, annotated.where("category is not null")


def stub_generator(prompt: str) -> str:
    """A deterministic stand-in for a model: cites an element that a hash of the prompt chooses; every 17th answer is not an object."""
    h = int(sha256(prompt.encode()).hexdigest()[:8], 16)
    if h % 17 == 0:
        return "I would rather not."
    body = json.dumps({"analysis": f"{len(prompt)} characters", "reflection_1p": f"I notice this [{1 + h % 6}.{1 + h % 4}]."})
    return f"```json\n{body}\n```" if h % 3 == 0 else body


def stub_judge(prompt: str) -> str:
    h = int(sha256(prompt.encode()).hexdigest()[:8], 16)
    return json.dumps({"scores": {d: 1 + (h >> 4 * k) % 5 for k, d in enumerate(("depth", "grounding", "relevance", "tone"))}})


def _post_generation(row: dict, raw: str) -> dict:
    analysis, answer, category, reason = parse_answer(raw)
    if category:
        raise ValueError(reason)
    return {"analysis": analysis, "reflection_1p": answer}


def _post_judgment(row: dict, raw: str) -> dict:
    got = parse_judgment(raw)
    if got is None:
        raise ValueError("no scores")
    scores, mean = got
    return {"scores": scores, "aggregate": mean, "decision": "reject" if min(scores.values()) <= 2 or mean < 4 else "accept"}


def generator_run(call: Callable[[str], str] = stub_generator) -> Run:
    columns = T.StructType([T.StructField("analysis", T.StringType()), T.StructField("reflection_1p", T.StringType())])
    return Run("reflections", columns, lambda r: f"Reflect.\n\n{r['text'] or ''}", call, _post_generation)


def judge_run(call: Callable[[str], str] = stub_judge) -> Run:
    columns = T.StructType([T.StructField("scores", T.MapType(T.StringType(), T.LongType())), T.StructField("aggregate", T.DoubleType()), T.StructField("decision", T.StringType())])
    return Run("judgments", columns, lambda r: f"Judge.\n\n{r['reflection_1p'] or ''}", call, _post_judgment)


RUNS: dict[str, Callable[[], Run]] = {"reflections": generator_run, "judgments": judge_run}
ALIASES = {"reflection": "reflections", "judge": "judgments"}


def get_run(name: str) -> Run:
    name = ALIASES.get(name, name)
    if name not in RUNS:
        raise KeyError(f"no run {name!r}; there are {sorted(RUNS)}")
    return RUNS[name]()


@dataclass(frozen=True)
class Step:
    """A custom stage of a pipeline: ``run(rows, rank, world_size)`` over the rows of one partition, and its columns."""

    name: str
    columns: T.StructType
    run: Callable[[Iterator[dict], int, int], Iterator[dict]]


def run_step(df: DataFrame, step: Step) -> DataFrame:
    """Runs a step on each partition; its rank is the partition's number. A partition may be run again, so steps must not keep state outside."""
    world = df.rdd.getNumPartitions()

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        rows = (r for pdf in batches for r in pdf.to_dict("records"))
        out = step.run(rows, TaskContext.get().partitionId() % world, world)
        while some := list(islice(out, 1000)):
            yield pd.DataFrame(some, columns=step.columns.names)

    return df.mapInPandas(task, step.columns)


def probe(df: DataFrame, key: str, run: Run, count: Callable[[str], int] = lambda s: len(s.split())) -> DataFrame:
    """Per request: tokens in and out, seconds taken, and whether it succeeded; one request at a time in each task."""
    schema = T.StructType([df.schema[key], *[T.StructField(c, T.LongType()) for c in ("input_tokens", "output_tokens")], T.StructField("seconds", T.DoubleType()), T.StructField("success", T.BooleanType())])

    def one(row: dict) -> tuple:
        prompt, began = run.build(row), time.perf_counter()
        try:
            raw, good = retry(run.call, prompt), True
        except Exception:
            raw, good = "", False
        return row[key], count(prompt), count(raw), time.perf_counter() - began, good

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([one(r) for r in pdf.to_dict("records")], columns=schema.names)

    return df.mapInPandas(task, schema)


def cross_runs(spark: SparkSession, targets: list[str], others: list[str]) -> DataFrame:
    """The runs of a cross iteration: each target with each counterpart, the runs of a target under one group id."""
    rows = [(sha256(t.encode()).hexdigest()[:8], t, o) for t, o in cross_pairs(targets, others)]
    return spark.createDataFrame(rows, "group_id string, target string, counterpart string")


def cross_pairs(targets: list[str], others: list[str]) -> list[tuple[str, str]]:
    """Each target with each counterpart but itself."""
    return [(t, o) for t in targets for o in others if t != o]


def usage_totals(df: DataFrame, *columns: str) -> DataFrame:
    return df.agg(*[F.sum(c).alias(c) for c in columns])
