"""Rollouts from prefixes: fan-out, scripted policies in SQL, and any policy in Python."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspan import fixed_values as V
from quillspan.functions import text, turns
from quillspan.schema import ROLLOUT, TURNS

Policy = Callable[[list[dict[str, str]], int], str]
Observe = Callable[[str], str]


def fan_out(prefixes: DataFrame, n: int) -> DataFrame:
    """Each prefix n times, with rollout 1..n and `n_rollouts`; horizon 0 or null becomes the default."""
    horizon = F.coalesce(F.nullif(F.col("horizon"), F.lit(0)), F.lit(V.DEFAULT_HORIZON))
    return prefixes.withColumns({"horizon": horizon, "n_rollouts": F.lit(n)}).withColumn(
        "rollout", F.explode(F.sequence(F.lit(1), F.lit(n)))
    )


def _turn_text(thought: str, command: str) -> str:
    return f"THOUGHT: {thought}\n\n```bash\n{command}\n```"


_EDIT_TURN = _turn_text("the function returns the wrong value; change it.", V.SCRIPTED_EDIT_COMMAND)
_CHECK_TURN = _turn_text("see whether the change holds.", V.SCRIPTED_CHECK_COMMAND)
_SUBMIT_TURN = _turn_text("changed and checked.", V.SCRIPTED_SUBMIT_COMMAND)
_SEARCH_TURN = _turn_text("look around once more.", V.SCRIPTED_SEARCH_COMMAND)


def verifying_turn(step: Column) -> Column:
    """Edits at step 0, checks at step 1, then submits."""
    return F.when(step == 0, _EDIT_TURN).when(step == 1, _CHECK_TURN).otherwise(_SUBMIT_TURN)


def skipping_turn(step: Column) -> Column:
    """Edits at step 0, then searches for ever."""
    return F.when(step == 0, _EDIT_TURN).otherwise(_SEARCH_TURN)


def scripted_turn(rollout: Column, step: Column) -> Column:
    """Odd rollouts verify, even ones skip."""
    return F.when(rollout % 2 == 1, verifying_turn(step)).otherwise(skipping_turn(step))


def verifying_policy(_messages: list[dict[str, str]], step: int) -> str:
    return (_EDIT_TURN, _CHECK_TURN, _SUBMIT_TURN)[min(step, 2)]


def skipping_policy(_messages: list[dict[str, str]], step: int) -> str:
    return _EDIT_TURN if step == 0 else _SEARCH_TURN


def stub_observe(command: str) -> str:
    flat = command.replace("\n", " ")[: V.OBSERVATION_CHARS]
    return f"<returncode>0</returncode>\n<output>\n(stub) ran: {flat}\n</output>"


def roll_scripted(prefixes: DataFrame, n: int, turn_for: Callable[[Column, Column], Column] = scripted_turn) -> DataFrame:
    """Rollouts of policies that depend on rollout number and step only, without leaving the JVM.

    A turn without text or without a shell fence is kept and ends the rollout with
    `bad_turn:<why>`; a submit ends it without an observation; else the stub observation
    follows until the horizon.
    """
    base = fan_out(prefixes, n)
    start = F.struct(
        F.array().cast(TURNS).alias("continuation"),
        F.array().cast("array<string>").alias("commands"),
        F.lit("horizon").alias("stopped"),
        F.lit(True).alias("open"),
    )

    def step(acc: Column, s: Column) -> Column:
        said = turn_for(F.col("rollout"), s)
        why, command = text.unusable_reason(said), text.first_command(said)
        own = F.struct(F.lit("assistant").alias("role"), said.alias("content"))
        seen = F.struct(F.lit("user").alias("role"), text.stub_observation(command).alias("content"))
        bad, done = why != "", text.is_submit(command)
        added = F.when(bad | done, F.array(own)).otherwise(F.array(own, seen))
        after = F.struct(
            F.concat(acc["continuation"], added).alias("continuation"),
            F.when(bad, acc["commands"]).otherwise(F.array_append(acc["commands"], command)).alias("commands"),
            F.when(bad, F.concat(F.lit("bad_turn:"), why)).when(done, "submit").otherwise("horizon").alias("stopped"),
            (~(bad | done)).alias("open"),
        )
        return F.when(acc["open"], after).otherwise(acc)

    horizon = F.greatest(F.col("horizon"), F.lit(0))  # a negative one has no steps
    steps = F.slice(F.sequence(F.lit(0), F.greatest(horizon, F.lit(1)) - 1), F.lit(1), horizon)
    rolled = base.withColumn("__r", F.aggregate(steps, start, step))
    return rolled.select(
        "sample_id",
        "rollout",
        "n_rollouts",
        "phase_wanted",
        "source",
        "instance_id",
        "horizon",
        F.col("__r.stopped").alias("stopped"),
        F.col("__r.commands").alias("commands"),
        F.concat(turns.or_empty(F.col("messages")), F.col("__r.continuation")).alias("messages"),
        F.col("__r.continuation").alias("continuation"),
        F.lit("scripted").alias("backend"),
    )


def roll_with(
    prefixes: DataFrame,
    n: int,
    policy_for: Callable[[int], Policy],
    observe: Observe = stub_observe,
    backend: str = "python",
) -> DataFrame:
    """Rollouts of arbitrary policies: `policy_for(rollout)` gives `(messages, step) -> text`.

    Prefixes are spread evenly, each moved once whatever `n` is, and rolled batch by batch
    in Arrow, all rollouts of one where it is.  Policies must be picklable; one that calls a
    service should keep its client inside the function.
    """
    from quillspan.functions import plain

    names = ("sample_id", "n_rollouts", "phase_wanted", "source", "instance_id", "horizon", "messages")
    tasks = int(prefixes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = fan_out(prefixes, 1).withColumn("n_rollouts", F.lit(n)).select(*names).repartition(tasks)

    def roll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, rollout in product(batch.to_pylist(), range(1, n + 1)):
                policy = policy_for(rollout)
                messages = [dict(m) for m in row["messages"] or []]
                tail, commands, stopped = [], [], "horizon"
                for step in range(row["horizon"]):
                    said = policy(messages, step)
                    own = {"role": "assistant", "content": said}
                    messages.append(own)
                    tail.append(own)
                    if why := plain.unusable_reason(said):
                        stopped = f"bad_turn:{why}"
                        break
                    command = plain.first_command(said)
                    commands.append(command)
                    if plain.is_submit(command):
                        stopped = "submit"
                        break
                    seen = {"role": "user", "content": observe(command)}
                    messages.append(seen)
                    tail.append(seen)
                out.append(
                    row
                    | {
                        "rollout": rollout,
                        "messages": messages,
                        "continuation": tail,
                        "commands": commands,
                        "stopped": stopped,
                        "backend": backend,
                    }
                )
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(ROLLOUT)
    return spread.mapInArrow(roll, ROLLOUT)
