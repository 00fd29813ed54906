"""User functions over event envelopes, run next to the data in Arrow batches."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.envelope import envelope, with_parsed
from millrace.operators import outcome
from millrace.session import ship_package

EventFunction = Callable[[dict], "dict | None"]

# Fixed value: the largest result or error text a function may give, in bytes.
MAX_RESULT = 16 * 1024 * 1024
RESULT = "status string, error string, attempts int, envelope string, seconds double"


def call_once(text: str, functions: Sequence[tuple[str, EventFunction]]) -> str | None:
    """Envelope in, envelope out through each function; None when one drops it."""
    for prefix, function in functions:
        try:
            result = function(json.loads(text))
            if result is None:
                return None
            text = json.dumps(result, ensure_ascii=False, separators=(",", ":"), allow_nan=False)
            size = len(text.encode())
            if size > MAX_RESULT:
                raise ValueError(f"result data too large: {size} bytes (max {MAX_RESULT})")
        except Exception as cause:
            message = str(cause) or type(cause).__name__
            size = len(message.encode())
            if size > MAX_RESULT:
                message = f"result error too large: {size} bytes (max {MAX_RESULT})"
            raise RuntimeError(f"{prefix}{message}") from cause
    return text


Outcome = tuple  # status, error, attempts, envelope, seconds of the first try


def call_in_rounds(
    texts: Sequence[str | None],
    functions: Sequence[tuple[str, EventFunction]],
    max_attempts: int,
    backoff_ms: int,
) -> list[Outcome]:
    """What became of each text: all are tried, then, after one pause, those that failed, and so on.

    The pauses of a batch don't depend on how many of its events fail. None gives a row of None.
    """
    out: list[Outcome] = [(None, None, None, None, None)] * len(texts)
    first: dict[int, float] = {}
    left = [i for i, text in enumerate(texts) if text is not None]
    for attempt in range(1, max_attempts + 1):
        failing = []
        for i in left:
            started = time.perf_counter()
            try:
                result, error = call_once(texts[i], functions), None
            except RuntimeError as cause:
                result, error = None, str(cause)
            took = first.setdefault(i, time.perf_counter() - started)
            if error is None:
                out[i] = (None if result is not None else outcome.FILTERED, None, attempt, result, took)
            else:
                out[i] = (outcome.TRANSFORM_ERROR, error, attempt, None, took)
                failing.append(i)
        left = failing
        if not left:
            break
        if attempt < max_attempts:
            time.sleep(backoff_ms / 1000)
    return out


def call_with_retry(
    text: str,
    functions: Sequence[tuple[str, EventFunction]],
    max_attempts: int,
    backoff_ms: int,
) -> Outcome:
    """The same for one text."""
    return call_in_rounds([text], functions, max_attempts, backoff_ms)[0]


def run_functions(
    staged: DataFrame,
    functions: Sequence[tuple[str, EventFunction]],
    max_attempts: int,
    backoff_ms: int,
) -> DataFrame:
    """Run (message prefix, function) pairs over live events.

    Only the envelope text crosses to Python; all other columns stay put. Retries go
    in rounds over an Arrow batch, with one pause a round. Each call gets a fresh dict and functions keep no state between events. The
    result is fixed once written, so callers store it before using it twice.
    """
    functions = list(functions)
    ship_package(staged.sparkSession)

    @F.pandas_udf(RESULT)
    def call(texts: pd.Series) -> pd.DataFrame:
        rows = call_in_rounds([None if text is None else text for text in texts], functions, max_attempts, backoff_ms)
        out = pd.DataFrame(rows, columns=["status", "error", "attempts", "envelope", "seconds"])
        return out.astype({"attempts": "Int32", "seconds": "float64"})

    called = staged.withColumn(
        "_call", call.asNondeterministic()(F.when(outcome.is_live(), envelope()))
    )
    read = with_parsed(called, F.col("_call.envelope"))
    ran = F.col("_call.attempts").isNotNull()
    passed = F.col("_call.envelope").isNotNull()
    broken = passed & F.col("_event.error").isNotNull()
    new = {
        name: F.when(passed & ~broken, F.col(f"_event.{name}")).otherwise(F.col(name))
        for name in ("source", "table", "op", "ts", "before", "after")
    }
    first = functions[-1][0]
    new["status"] = (
        F.when(broken, F.lit(outcome.TRANSFORM_ERROR))
        .when(ran, F.col("_call.status"))
        .otherwise(F.col("status"))
    )
    new["stage"] = F.when(ran & (broken | F.col("_call.status").isNotNull()), F.lit("transform")).otherwise(
        F.col("stage")
    )
    new["error"] = (
        F.when(broken, F.concat(F.lit(first), F.col("_event.error")))
        .when(ran, F.col("_call.error"))
        .otherwise(F.col("error"))
    )
    new["attempts"] = F.coalesce("_call.attempts", "attempts")
    new["transform_s"] = F.when(
        ran, F.coalesce("transform_s", F.lit(0.0)) + F.col("_call.seconds")
    ).otherwise(F.col("transform_s"))
    return read.withColumns(new).drop("_call", "_event")
