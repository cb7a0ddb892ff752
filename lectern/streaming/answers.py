"""Questions answered once, whatever files they come in: state by id, bounded retries, restarts without a second answer."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lectern.operators import evaluate

OUTPUT = "id string, prompt string, gold array<string>, file string, raw_output string, calls int, failed boolean"
STATE = "done boolean, calls int"


def answered(rows: DataFrame, model: Callable[[str], str], attempts: int = 3, most: int = 6) -> DataFrame:
    """A stream (id, prompt, gold, file) with raw_output, calls and failed: one answer an id.

    The state of an id says whether it is answered and how often the model was called for it. A failed call is tried again,
    ``attempts`` times when the id arrives and ``most`` times in all: a file that brings the id again later gives it
    another go, and its failure is only told again when it had one. An answered id is never asked again. State and
    output are committed together, so a restart repeats neither answers nor calls of finished batches.
    """

    def one(key: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        done, calls = state.get if state.exists else (False, 0)
        first = pd.concat(list(frames)).sort_values("file").iloc[:1]
        if done or calls >= most:
            return
        reply, failed = "", True
        for _ in range(min(attempts, most - calls)):
            calls += 1
            try:
                reply, failed = model(first["prompt"].iloc[0]) or "__EMPTY_RESPONSE__", False
                break
            except Exception as why:  # any failure of one call is that call's result
                reply = f"__ERROR__ {type(why).__name__}: {why}"
        state.update((not failed, calls))
        yield first.assign(raw_output=reply, calls=calls, failed=failed)[[c.split()[0] for c in OUTPUT.split(", ")]]

    asked = rows.select("id", "prompt", "gold", "file").where("id IS NOT NULL")
    return asked.groupBy("id").applyInPandasWithState(one, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout)


def run(rows: DataFrame, model: Callable[[str], str], out: str, checkpoint: str, **options: int) -> StreamingQuery:
    """Scored answers and failures appended to Parquet under ``out``; the checkpoint holds files done and the state of ids."""
    made = evaluate.scored(answered(rows, model, **options))
    return made.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def latest(results: DataFrame) -> DataFrame:
    """One row an id of the results: its answer, or the failure with most calls."""
    return results.groupBy("id").agg(F.max_by(F.struct(*[c for c in results.columns if c != "id"]), F.struct(~F.col("failed"), "calls")).alias("x")).select("id", "x.*")
