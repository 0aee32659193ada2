"""Feature stages for ``pyspark.ml.Pipeline``.

Fitted state lives in params, so every stage and model can be saved with its pipeline.
Column names may hold dots and parentheses. Each fit is one pass of aggregates over all
its columns; each transform is a projection.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal
from itertools import combinations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.calendar import cycle, part
from tidegauge.functions.names import column, numeric_columns, require, safe_name
from tidegauge.functions.values import TIME_FORMATS, clamp, nan_to_null, safe_ratio, to_time
from tidegauge.operators.profile import value_counts
from tidegauge.operators.scans import quantiles_of

DATE_PARTS = ("hour", "dayofweek", "month", "dayofyear")
CYCLE_PARTS = ("sin_hour", "cos_hour")


#: Values of all columns together that may become columns of their own.
MOST_DUMMIES = 10_000


def _check_shares(lower: float, upper: float) -> None:
    if not 0 <= lower < upper <= 1:
        raise ValueError("quantiles must satisfy 0 <= lower < upper <= 1")


class _HasColumns(Params):
    columns = Param(Params._dummy(), "columns", "columns to work on", TypeConverters.toListString)

    def _names(self, df: DataFrame) -> list[str]:
        if self.isDefined("columns"):
            return list(self.getOrDefault("columns"))
        return numeric_columns(df)


class _Stage(_HasColumns, DefaultParamsReadable, DefaultParamsWritable):
    pass


# --- date -----------------------------------------------------------------------------


class DateFeatures(Transformer, _Stage):
    """Hour, weekday (Monday 0), month, day of year, and the hour on the unit circle.

    Unreadable dates give -1 for the parts and 0 for the waves. With ``dropNa`` such a
    date is an error, raised when the row is computed. ``generate=False`` only drops
    the time column.
    """

    timeCol = Param(Params._dummy(), "timeCol", "time column", TypeConverters.toString)
    dropOriginal = Param(Params._dummy(), "dropOriginal", "drop it after", TypeConverters.toBoolean)
    addCyclical = Param(Params._dummy(), "addCyclical", "add sin/cos", TypeConverters.toBoolean)
    generate = Param(Params._dummy(), "generate", "make features", TypeConverters.toBoolean)
    dropNa = Param(Params._dummy(), "dropNa", "bad dates are errors", TypeConverters.toBoolean)

    @keyword_only
    def __init__(
        self, *, timeCol="date", dropOriginal=True, addCyclical=True, generate=True, dropNa=False
    ):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(
            timeCol="date", dropOriginal=True, addCyclical=True, generate=True, dropNa=False
        )

    def feature_names(self) -> list[str]:
        if not self.getOrDefault("generate"):
            return []
        time = self.getOrDefault("timeCol")
        waves = CYCLE_PARTS if self.getOrDefault("addCyclical") else ()
        return [f"{time}_{p}" for p in (*DATE_PARTS, *waves)]

    def _transform(self, df: DataFrame) -> DataFrame:
        time = self.getOrDefault("timeCol")
        require(df, [time])
        result = df
        if self.getOrDefault("generate"):
            moment = column(time)
            if isinstance(df.schema[time].dataType, T.StringType):
                moment = to_time(moment, TIME_FORMATS)
            if self.getOrDefault("dropNa"):
                moment = F.when(moment.isNotNull(), moment).otherwise(
                    F.raise_error(F.lit(f"column '{time}' holds unreadable dates")).cast("timestamp_ntz")
                )
            features = {
                f"{time}_{p}": F.coalesce(part(moment, p).cast("float"), F.lit(-1.0).cast("float"))
                for p in DATE_PARTS
            }
            if self.getOrDefault("addCyclical"):
                for wave in CYCLE_PARTS:
                    value = cycle(F.hour(moment), wave[:3]).cast("float")
                    features[f"{time}_{wave}"] = F.coalesce(value, F.lit(0.0).cast("float"))
            result = df.select("*", *[value.alias(name) for name, value in features.items()])
        return result.drop(time) if self.getOrDefault("dropOriginal") else result


def clip_batch(df: DataFrame, columns: Sequence[str], lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    """Clip columns to quantiles of this very table: two passes, nothing fitted."""
    _check_shares(lower, upper)
    return QuantileClipper(columns=list(columns), lower=lower, upper=upper).fit(df).transform(df)


# --- interactions ---------------------------------------------------------------------


class Interactions(Transformer, _Stage):
    """``a__x__b`` products and ``a__div__b`` ratios of column pairs in given order."""

    ratios = Param(Params._dummy(), "ratios", "make ratios", TypeConverters.toBoolean)
    products = Param(Params._dummy(), "products", "make products", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, columns=None, ratios=True, products=False):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self._setDefault(ratios=True, products=False)

    def _made(self, names: Sequence[str]) -> list[tuple[str, str, str]]:
        """(new name, first, second) of all pairs."""
        signs = [s for s, on in (("x", "products"), ("div", "ratios")) if self.getOrDefault(on)]
        return [(f"{a}__{s}__{b}", a, b) for a, b in combinations(names, 2) for s in signs]

    def feature_names(self) -> list[str]:
        return [name for name, _, _ in self._made(self.getOrDefault("columns"))]

    def _transform(self, df: DataFrame) -> DataFrame:
        names = self._names(df)
        require(df, names)

        def value(name: str, a: str, b: str) -> Column:
            ratio = name == f"{a}__div__{b}"
            return safe_ratio(column(a), column(b)) if ratio else column(a) * column(b)

        return df.select("*", *[value(*m).alias(m[0]) for m in self._made(names)])


class SafeColumns(Transformer, _Stage):
    """Keep ``columns`` under names that Spark ML accepts, plus the columns in ``carry``."""

    carry = Param(Params._dummy(), "carry", "columns passed on as they are", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns=None, carry=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self._setDefault(carry=[])

    def _transform(self, df: DataFrame) -> DataFrame:
        names = self._names(df)
        require(df, names)
        carried = [c for c in self.getOrDefault("carry") if c in df.columns]
        safe = [column(c).alias(safe_name(c)) for c in names]
        return df.select(*[column(c) for c in carried if c not in map(safe_name, names)], *safe)


# --- fitted per-column numbers --------------------------------------------------------


class _NumbersModel(Model, _Stage):
    """A model that holds one or two numbers per column."""

    first = Param(Params._dummy(), "first", "one number per column", TypeConverters.toListFloat)
    second = Param(Params._dummy(), "second", "one number per column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, columns=None, first=None, second=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _entries(self):
        names = self.getOrDefault("columns")
        second = self.getOrDefault("second") if self.isDefined("second") else [None] * len(names)
        return zip(names, self.getOrDefault("first"), second)


class QuantileClipper(Estimator, _Stage):
    """Learn two quantiles per column and clip to them."""

    lower = Param(Params._dummy(), "lower", "lower share", TypeConverters.toFloat)
    upper = Param(Params._dummy(), "upper", "upper share", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, columns=None, lower=0.01, upper=0.99):
        super().__init__()
        _check_shares(lower, upper)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self._setDefault(lower=0.01, upper=0.99)

    def _fit(self, df: DataFrame) -> "QuantileClipperModel":
        names = self._names(df)
        found = quantiles_of(df, names, self.getOrDefault("lower"), self.getOrDefault("upper"))
        kept = [c for c in names if found[c][0] is not None]
        return QuantileClipperModel(columns=kept, first=[found[c][0] for c in kept], second=[found[c][1] for c in kept])


class QuantileClipperModel(_NumbersModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {c: clamp(column(c), low, high) for c, low, high in self._entries() if c in df.columns}
        )


class MedianImputer(Estimator, _Stage):
    """Fill missing numbers with the exact median."""

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> "MedianImputerModel":
        names = self._names(df)
        found = quantiles_of(df, names, 0.5)
        kept = [c for c in names if found[c][0] is not None]
        return MedianImputerModel(columns=kept, first=[found[c][0] for c in kept])


class MedianImputerModel(_NumbersModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                c: F.coalesce(nan_to_null(column(c).cast("double")), F.lit(median))
                for c, median, _ in self._entries()
                if c in df.columns
            }
        )


class Standardizer(Estimator, _Stage):
    """Mean 0 and population standard deviation 1; a constant column is only centred."""

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> "StandardizerModel":
        names = self._names(df)
        values = [nan_to_null(column(c).cast("double")) for c in names]
        aggregates = [F.avg(v).alias(f"m{i}") for i, v in enumerate(values)]
        aggregates += [F.stddev_pop(v).alias(f"s{i}") for i, v in enumerate(values)]
        row = df.agg(*aggregates).first()
        return StandardizerModel(
            columns=names,
            first=[float(row[f"m{i}"] or 0.0) for i in range(len(names))],
            second=[float(row[f"s{i}"] or 1.0) for i in range(len(names))],
        )


class StandardizerModel(_NumbersModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                c: (column(c).cast("double") - F.lit(mean)) / F.lit(std)
                for c, mean, std in self._entries()
                if c in df.columns
            }
        )


# --- categories -----------------------------------------------------------------------


class ModeImputer(Estimator, _Stage):
    """Fill missing text with the most frequent value; ties go to the smallest."""

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> "ModeImputerModel":
        names = list(self.getOrDefault("columns"))
        first = F.min(F.struct((-F.col("n")).alias("minus"), F.col("value").alias("value")))
        rows = value_counts(df, names).groupBy("column").agg(first.alias("first")).collect()
        found = {r["column"]: r["first"]["value"] for r in rows}
        kept = [c for c in names if c in found]
        return ModeImputerModel(columns=kept, fills=[found[c] for c in kept])


class ModeImputerModel(Model, _Stage):
    fills = Param(Params._dummy(), "fills", "one text per column", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns=None, fills=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        pairs = zip(self.getOrDefault("columns"), self.getOrDefault("fills"))
        return df.withColumns(
            {c: F.coalesce(column(c), F.lit(fill)) for c, fill in pairs if c in df.columns}
        )


class Dummies(Estimator, _Stage):
    """0/1 columns ``<column>_<value>`` for all sorted values but the first.

    Values are sorted as what they are (numbers by size), then named by their text. The
    values of all columns are counted in one job; more than ``MOST_DUMMIES`` are an error, for
    which ``SparseDummies`` makes one vector instead of one column per value.
    """

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> "DummiesModel":
        names = list(self.getOrDefault("columns"))
        require(df, names)
        # The distinct values become column names, so they have to be known here. They are
        # counted by (column, value), and the driver takes no more than can be columns.
        pairs = [F.struct(F.lit(i).alias("ix"), column(c).cast("string").alias("value")) for i, c in enumerate(names)]
        found = df.select(F.inline(F.array(*pairs))).filter(F.col("value").isNotNull()).distinct().limit(MOST_DUMMIES + 1).collect()
        if len(found) > MOST_DUMMIES:
            raise ValueError(f"{names} have more than {MOST_DUMMIES} values: use SparseDummies")
        listed = [sorted((r["value"] for r in found if r["ix"] == i), key=_order_of(df.schema[c].dataType)) for i, c in enumerate(names)]
        return DummiesModel(columns=names, values=[v for values in listed for v in values], sizes=[len(values) for values in listed])


def _order_of(kind: T.DataType):
    """Sort key of the texts of a type: numbers by size, NaN last, others in byte order."""
    if isinstance(kind, (T.IntegralType, T.DecimalType)):
        return Decimal
    if isinstance(kind, T.FractionalType):
        return lambda v: (math.isnan(float(v)), float(v))
    return str.encode


class DummiesModel(Model, _Stage):
    values = Param(Params._dummy(), "values", "sorted values of all columns", TypeConverters.toListString)
    sizes = Param(Params._dummy(), "sizes", "number of values per column", TypeConverters.toListInt)

    @keyword_only
    def __init__(self, *, columns=None, values=None, sizes=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        made, start = [], 0
        for name, size in zip(self.getOrDefault("columns"), self.getOrDefault("sizes")):
            for value in self.getOrDefault("values")[start + 1 : start + size]:
                hit = F.coalesce(column(name).cast("string") == value, F.lit(False))
                made.append(hit.cast("int").alias(f"{name}_{value}"))
            start += size
        kept = [column(c) for c in df.columns if c not in self.getOrDefault("columns")]
        return df.select(*kept, *made)


class SparseDummies(Estimator, _Stage):
    """0/1 values of a column as one sparse vector, ``<column>_dummies``, a slot per value.

    For categories that are too many to be columns: the plan stays small whatever their
    number. Slots are in the order of the values' texts; a missing or unseen value is all
    zeros.
    """

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame):
        names = list(self.getOrDefault("columns"))
        require(df, names)
        texts = TextColumns(columns=names)
        places = [f"{safe_name(c)}__place" for c in names]
        # The last place is that of unseen values; the encoder drops it.
        indexer = StringIndexer(
            inputCols=[f"{safe_name(c)}__text" for c in names], outputCols=places, stringOrderType="alphabetAsc", handleInvalid="keep"
        )
        encoder = OneHotEncoder(inputCols=places, outputCols=[f"{safe_name(c)}_dummies" for c in names], dropLast=True)
        return Pipeline(stages=[texts, indexer, encoder, DropColumns(columns=[*places, *[f"{safe_name(c)}__text" for c in names]])]).fit(df)


class TextColumns(Transformer, _Stage):
    """Adds ``<column>__text``, the column as text."""

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f"{safe_name(c)}__text": column(c).cast("string") for c in self._names(df)})


class DropColumns(Transformer, _Stage):
    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.getOrDefault("columns"))
