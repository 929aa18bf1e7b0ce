"""An outside model as a function of rows: retries, strict replies, and what follows from them."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeline import schemas
from lakeline.operators import findings

#: prompt -> reply (JSON text).
Model = Callable[[str], str]


def with_retries(model: Callable[..., str], times: int = 3, first_wait: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> Callable[..., str]:
    """Call again after 2, 4, ... seconds; the last error is passed on."""

    def call(*args):
        for i in range(times):
            try:
                return model(*args)
            except Exception:  # noqa: BLE001 - whatever the provider raises may pass
                if i == times - 1:
                    raise
                sleep(first_wait * 2**i)

    return call


def is_up(probe: Callable[[], object]) -> bool:
    """Whether the endpoint answers; an error of any kind means no."""
    try:
        return bool(probe())
    except Exception:  # noqa: BLE001
        return False


def when_up(df: DataFrame, probe: Callable[[], object], work: Callable[[DataFrame], DataFrame]) -> DataFrame | None:
    """``work(df)`` if the endpoint is up, else None: nothing is asked and nothing is marked as done."""
    return work(df) if is_up(probe) else None


def ask(df: DataFrame, model: Model, prompt: str, out: str = "reply") -> DataFrame:
    """Adds the reply and ``problem`` ('Type: message', 200 characters); a failing row gives a problem, not a failed job."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema)}, `{out}` string, problem string"

    def one(text):
        try:
            reply = model(text)
            if not isinstance(json.loads(reply), dict):
                raise ValueError("the reply is no object")
            return reply, None
        except Exception as e:  # noqa: BLE001
            return None, f"{type(e).__name__}: {e}"[:200]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            got = [one(t) for t in p[prompt]]
            yield p.assign(**{out: pd.Series([a for a, _ in got], index=p.index, dtype=object), "problem": pd.Series([b for _, b in got], index=p.index, dtype=object)})

    return df.mapInPandas(run, schema)


def analyze(reports: DataFrame, model: Model) -> tuple[DataFrame, DataFrame]:
    """(FINDINGS of reports with remarks, problems by report_id): filtered before the model is asked, derived from its findings after."""
    asked = reports.where(findings.has_remarks()).select("report_id", "navnelbnr", findings.prompt_text(F.col("text")).alias("prompt"))
    got = ask(asked, model, "prompt")
    reply = F.from_json("reply", f"overall string, summary_en string, findings array<{schemas.FINDING}>")
    good = got.where("problem is null").select("report_id", "navnelbnr", reply.alias("r"))
    rows = findings.derive(good.select("report_id", "navnelbnr", F.col("r.overall").alias("overall_llm"), F.col("r.summary_en").alias("summary_en"), F.col("r.findings").alias("findings")))
    return rows.select(*schemas.FINDINGS.fieldNames()), got.where("problem is not null").select("report_id", "problem")
