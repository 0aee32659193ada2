"""Feature jobs: feature frame, and the select, store and split step."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

from tidegauge.functions.names import column, require
from tidegauge.operators.clean import select_columns
from tidegauge.operators.split import train_test
from tidegauge.roles import Roles
from tidegauge.sources.tables import write_table


def feature_frame(df: DataFrame, roles: Roles) -> DataFrame:
    """Categorical, numeric and time columns in that order, then the target."""
    wanted = [*roles.categorical, *roles.numeric, roles.time, roles.target]
    require(df, wanted)
    return df.select(*[column(c) for c in wanted])


def engineer(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    key: str,
    drop: Iterable[str] = (),
    store: str | None = None,
    split: bool = True,
    share: float = 0.2,
    seed: int = 42,
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Drop, select, optionally store, and split by the hash of ``key``.

    ``key`` decides the side of a row and is not a feature unless listed.
    """
    require(df, [key])
    chosen = select_columns(df, features, target, drop)
    if store:
        write_table(chosen, store)
    if not split:
        return chosen
    keyed = df.select(
        *[column(c) for c in dict.fromkeys((*features, target))], column(key).alias("__key")
    )
    return tuple(part.drop("__key") for part in train_test(keyed, "__key", share, seed))
