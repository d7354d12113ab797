"""UDF3: a pluggable model over batches of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Scorer = Callable[[pd.DataFrame], pd.DataFrame]


def batch_score(
    df: DataFrame,
    load_scorer: Callable[[], Scorer],
    schema: str,
    carry: Sequence[str] = (),
    usable: Column | None = None,
) -> DataFrame:
    """JOB7: rows through a model, in Arrow batches, where the rows are and in their order.

    `load_scorer` runs once per task and returns the function that scores a batch, so a model is
    loaded once and not for every batch. `schema` names the columns the scorer returns. With
    `carry` each answer keeps the named columns of its row, and the scorer has to give one answer
    a row; rows that are not `usable` are not scored and have NULL answers.
    """
    if not carry:

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            scorer = load_scorer()
            for batch in batches:
                yield scorer(batch)

        return df.mapInPandas(score, schema)

    answers = StructType.fromDDL(schema)
    kept = [df.schema[c] for c in carry]
    names = [f.name for f in answers]

    def score_beside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = load_scorer()
        for batch in batches:
            fit = batch[batch["_usable"].astype(bool)].drop(columns="_usable")
            scored = scorer(fit.reset_index(drop=True)) if len(fit) else pd.DataFrame(columns=names)
            if len(scored) != len(fit):
                raise ValueError(f"{len(scored)} answers to {len(fit)} rows")
            scored.index = fit.index
            found = scored[names].astype(object).reindex(batch.index)
            yield pd.concat([batch[list(carry)], found.where(found.notna(), None)], axis=1)

    tested = df.withColumn("_usable", F.lit(True) if usable is None else F.coalesce(usable, F.lit(False)))
    return tested.mapInPandas(score_beside, StructType([*kept, *answers.fields]))


def last_value_scorer(horizon: int, quantiles: tuple[str, ...]) -> Callable[[], Scorer]:
    """A model that repeats the last context value for every quantile and step."""

    def load() -> Scorer:
        def score(batch: pd.DataFrame) -> pd.DataFrame:
            lines = [{q: [float(c[-1])] * horizon for q in quantiles} for c in batch["context"]]
            return pd.DataFrame({"request_id": batch["request_id"], "quantiles": lines})

        return score

    return load
