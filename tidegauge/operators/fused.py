"""A pipeline that fits its stages from shared scans.

``Pipeline`` fits one stage after the other, each with its own passes over the rows. Here a
planner walks the stages and notes what each wants to know. As long as a statistic of a changed
column follows from one of the unchanged column it is asked there: the median of a clipped
column from the two middle values, the spread of a filled column from the spread and the number
of gaps, the categories of a filled column from those before. Where it does not follow, the
notes so far are answered in one go (two scans), the stages are fitted and the walk goes on from
the transformed rows. Feature and preprocessing stages take two such rounds instead of one to
three passes per stage; the fitted model is the ordinary ``PipelineModel``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame

from tidegauge.functions.names import safe_name
from tidegauge.operators.scans import Answers, Asked, answer
from tidegauge.operators.stages import (
    DateFeatures,
    Interactions,
    MedianImputer,
    MedianImputerModel,
    ModeImputer,
    ModeImputerModel,
    QuantileClipper,
    QuantileClipperModel,
    SafeColumns,
    Standardizer,
    StandardizerModel,
)


@dataclass(frozen=True)
class _Column:
    """A column as the walk knows it: its source in the scanned rows and what stages did to it."""

    source: str
    clip: int | None = None  # stage that limits it
    fill: int | None = None  # stage that fills its gaps


@dataclass
class _Round:
    """Stages that one group of scans can fit."""

    rows: DataFrame
    columns: dict[str, _Column]
    asked: Asked = field(default_factory=Asked)
    #: per stage, the columns it works on as they were when it was reached
    seen: dict[int, dict[str, _Column]] = field(default_factory=dict)


class FusedPipeline(Pipeline):
    """``Pipeline`` whose fit shares scans between stages; results are the same."""

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        stages = self.getStages()
        last = max((i for i, s in enumerate(stages) if isinstance(s, Estimator)), default=-1)
        fitted: list[Transformer] = []
        early: dict[tuple[int, str], float | None] = {}
        rows, at = dataset, 0
        while at <= last:
            work = _Round(rows, {c: _Column(c) for c in rows.columns})
            end = at
            while end <= last and self._noted(stages[end], end, work, early):
                end += 1
            if end == at and not work.asked:
                # Nothing to share: the stage fits itself.
                stage = stages[at]
                model = stage.fit(rows) if isinstance(stage, Estimator) else stage
                fitted.append(model)
                rows = model.transform(rows) if at < last else rows
                at += 1
                continue
            found = answer(work.rows, work.asked) if work.asked else Answers()
            models: dict[int, Transformer] = {}
            for i in range(at, end):
                models[i] = self._model(stages[i], i, work, found, models, early, rows)
                fitted.append(models[i])
                rows = models[i].transform(rows) if i < last else rows
            # The stage that ended the round may have asked about columns it will find changed.
            for name, col in work.seen.get(end, {}).items():
                if isinstance(stages[end], MedianImputer):
                    early[end, name] = self._median(col, work, found, models)
            at = end
        return PipelineModel([*fitted, *stages[last + 1 :]])

    def _noted(self, stage, at: int, work: _Round, early) -> bool:
        """Note what ``stage`` asks and does; False if it has to wait for the next round."""
        known = work.columns
        if isinstance(stage, DateFeatures):
            time = stage.getOrDefault("timeCol")
            if known.get(time) != _Column(time):
                return False
            made = stage.transform(work.rows)
            dropped = set(work.rows.columns) - set(made.columns)
            work.rows = made if not dropped else stage.copy({stage.dropOriginal: False}).transform(work.rows)
            for name in stage.feature_names():
                known[name] = _Column(name)
            for name in dropped:
                known.pop(name, None)
            return True
        if isinstance(stage, Interactions):
            names = stage._names(work.rows)
            if all(known.get(n) == _Column(n) for n in names):
                work.rows = stage.transform(work.rows)
                known.update({n: _Column(n) for n in stage.feature_names()})
            else:
                for name in stage.feature_names():
                    known.pop(name, None)
            return set(names) <= set(known)
        if isinstance(stage, SafeColumns):
            names = list(stage.getOrDefault("columns")) if stage.isDefined("columns") else []
            if not names:
                return False
            kept = {c: known[c] for c in stage.getOrDefault("carry") if c in known}
            kept.update({safe_name(c): known[c] for c in names if c in known})
            work.columns = kept
            return True
        if isinstance(stage, QuantileClipper) and stage.isDefined("columns"):
            cols = {n: known.get(n) for n in stage.getOrDefault("columns")}
            if any(c is None or c != _Column(c.source) for c in cols.values()):
                return False
            for name, col in cols.items():
                work.asked.share(col.source, stage.getOrDefault("lower"), stage.getOrDefault("upper"))
                known[name] = _Column(col.source, clip=at)
            work.seen[at] = cols
            return True
        if isinstance(stage, MedianImputer) and stage.isDefined("columns"):
            cols = {n: known.get(n) for n in stage.getOrDefault("columns") if (at, n) not in early}
            ready = {n: c for n, c in cols.items() if c is not None and c.fill is None}
            for col in ready.values():
                work.asked.share(col.source, 0.5)
            work.seen[at] = ready
            if len(ready) < len(cols):
                return False
            for name in stage.getOrDefault("columns"):
                col = known.get(name, _Column(name))
                known[name] = _Column(col.source, col.clip, fill=at)
            return True
        if isinstance(stage, Standardizer) and stage.isDefined("columns"):
            cols = {n: known.get(n) for n in stage.getOrDefault("columns")}
            if any(c is None or c.clip is not None for c in cols.values()):
                return False
            work.asked.moments.update(c.source for c in cols.values())
            work.seen[at] = cols
            for name in cols:
                known.pop(name)
            return True
        if isinstance(stage, ModeImputer):
            cols = {n: known.get(n) for n in stage.getOrDefault("columns")}
            if any(c is None or c != _Column(c.source) for c in cols.values()):
                return False
            work.asked.categories.update(c.source for c in cols.values())
            work.seen[at] = cols
            for name, col in cols.items():
                known[name] = _Column(col.source, fill=at)
            return True
        if isinstance(stage, StringIndexer) and stage.isSet("inputCols") and stage.getStringOrderType().startswith("alphabet"):
            cols = {n: known.get(n) for n in stage.getInputCols()}
            # A mode is one of the values; other fills would add a category.
            modes = {i for i, s in enumerate(self.getStages()) if isinstance(s, ModeImputer)}
            if any(c is None or c.clip is not None or c.fill not in (None, *modes) for c in cols.values()):
                return False
            work.asked.categories.update(c.source for c in cols.values())
            work.seen[at] = cols
            for name in stage.getOutputCols():
                known.pop(name, None)
            return True
        if isinstance(stage, (OneHotEncoder, VectorAssembler)):
            # Their columns are new and their numbers are in the schema.
            made = [stage.getOutputCol()] if isinstance(stage, VectorAssembler) else stage.getOutputCols()
            for name in made:
                known.pop(name, None)
            return bool(work.seen)
        return False

    def _bounds(self, col: _Column, work: _Round, models: dict[int, Transformer]) -> tuple[float, float]:
        """Limits of a column that a stage of this round clips."""
        if col.clip is not None:
            for name, low, high in models[col.clip]._entries():
                if work.seen[col.clip][name].source == col.source:
                    return low, high
        return -math.inf, math.inf

    def _median(self, col: _Column, work: _Round, found: Answers, models) -> float | None:
        return found.quantile(col.source, 0.5, *self._bounds(col, work, models))

    def _model(self, stage, at: int, work: _Round, found: Answers, models, early, rows: DataFrame) -> Transformer:
        """The fitted form of ``stage`` from the answers."""
        cols = work.seen.get(at, {})
        if isinstance(stage, QuantileClipper):
            ends = [stage.getOrDefault("lower"), stage.getOrDefault("upper")]
            low, high = ({n: found.quantile(c.source, q) for n, c in cols.items()} for q in ends)
            kept = [n for n in cols if low[n] is not None]
            return QuantileClipperModel(columns=kept, first=[low[n] for n in kept], second=[high[n] for n in kept])
        if isinstance(stage, MedianImputer):
            names = list(stage.getOrDefault("columns"))
            medians = {n: early[at, n] if (at, n) in early else self._median(cols[n], work, found, models) for n in names}
            kept = [n for n in names if medians[n] is not None]
            return MedianImputerModel(columns=kept, first=[medians[n] for n in kept])
        if isinstance(stage, Standardizer):
            names = list(cols)
            means, spreads = [], []
            for name in names:
                n, mean, var = found.moments[cols[name].source]
                fill = self._filled_with(name, cols[name], models)
                if fill is not None:
                    n, mean, var = _with_gaps(n, mean, var, found.rows - n, fill)
                means.append(mean if n else 0.0)
                spreads.append((math.sqrt(var) if n else 0.0) or 1.0)
            return StandardizerModel(columns=names, first=means, second=spreads)
        if isinstance(stage, (ModeImputer, StringIndexer)):
            counts = {n: found.categories[c.source] for n, c in cols.items()}
            if any(c is None for c in counts.values()):
                return stage.fit(rows)
            if isinstance(stage, ModeImputer):
                first = {n: min(c, key=lambda v: (-c[v], v.encode())) for n, c in counts.items() if c}
                return ModeImputerModel(columns=list(first), fills=list(first.values()))
            down = stage.getStringOrderType() == "alphabetDesc"
            labels = [sorted(counts[n], key=lambda v: v.encode("utf-16-be"), reverse=down) for n in stage.getInputCols()]
            if any(not listed for listed in labels):
                return stage.fit(rows)
            # One model per column: the model of several takes label lists of one length only.
            columns = zip(labels, stage.getInputCols(), stage.getOutputCols(), strict=True)
            return PipelineModel([StringIndexerModel.from_labels(own, name, made, stage.getHandleInvalid()) for own, name, made in columns])
        return stage.fit(rows) if isinstance(stage, Estimator) else stage

    def _filled_with(self, name: str, col: _Column, models: dict[int, Model]) -> float | None:
        if col.fill is None:
            return None
        return next((median for n, median, _ in models[col.fill]._entries() if n == name), None)


def _with_gaps(n: int, mean: float, var: float, gaps: int, fill: float) -> tuple[int, float, float]:
    """Count, mean and variance once ``gaps`` missing values are ``fill``."""
    total = n + gaps
    if not total:
        return 0, 0.0, 0.0
    centre = (n * mean + gaps * fill) / total
    square = n * var + n * (mean - centre) ** 2 + gaps * (fill - centre) ** 2
    return total, centre, square / total
