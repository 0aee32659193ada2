"""Document quality by co-training two views.

The *content* view sees the text (hashed letter pairs), the *page* view the record around it:
language, source, recorded length, and the layout of the page (lines, their lengths, shares of
capitals, digits, marks and blanks). Both start from labelled documents. In every round all
documents without a label are scored by both; where one view is confident and the other does
not object, the document becomes a pseudo-labelled example of the other view. In the end each
view is calibrated on labelled documents kept back from training, and a logistic model on both
calibrated views scores all documents.

All fits are on all documents with a label or pseudo-label, by sums over Spark partitions. The
pseudo-labels of a round weigh together at most ``TAUGHT`` of the labels and by their classes.

Contract: null text is empty, a null language, source or length is a value of its own; a
missing one of these columns counts as null; documents whose label is not 0 or 1 are
unlabelled, of repeated labels the larger counts; without labels of both kinds every document
gets the same score (1.0 without any label) and is judged by it; repeated rows are scored separately.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tidegauge.llm.newton import Examples, logistic, scaled, totals
from tidegauge.llm.store import dropped, written
from tidegauge.llm.words import SLICE

ROUNDS = 3
#: Weight of a pseudo-label at most, and of all of a view beside all labels.
LIGHT = 0.5
TAUGHT = 0.2
CONFIDENT = 0.97
OBJECTS = 0.5
KEEP = 0.3
PAIRS = 512
RECORD = ("lang", "source", "n_chars")

_PAIR = np.random.default_rng(11).integers(0, PAIRS, 1 << 16).astype(np.int64)
_KIND = np.zeros(256, dtype=np.int64)  # 0 small letters and bytes of longer characters
_KIND[65:91] = 1
_KIND[48:58] = 2
_KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 3
_KIND[[9, 11, 12, 13, 32]] = 4
_KIND[10] = 5
LANGS, SOURCES = 8, 32
PAGE = 8 + LANGS + SOURCES


def _slots(values: pa.Array, n: int) -> np.ndarray:
    """A slot for each value: 0 for null, else by its bytes."""
    known = values.cast(pa.string()).dictionary_encode()
    names = [1 + int(np.frombuffer(s.encode(), np.uint8).astype(np.int64) @ (np.arange(len(s.encode())) * 31 + 7)) % (n - 1) for s in known.dictionary.to_pylist()]
    at = known.indices.fill_null(len(names)).to_numpy(zero_copy_only=False)
    return np.array([*names, 0])[at]


def views(texts: pa.Array, lang: pa.Array, source: pa.Array, chars: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Content and page features of a batch."""
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    content, page = np.zeros((n, PAIRS), dtype=np.float32), np.zeros((n, PAGE), dtype=np.float32)
    if not n:
        return content, page
    _, where, data = texts.buffers()
    where = np.frombuffer(where, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    kinds = np.zeros((n, 6))
    row = 0
    while row < n:
        stop = max(row + 1, int(np.searchsorted(where, where[row] + SLICE, side="right")) - 1)
        own = data[where[row] : where[stop]]
        size = np.diff(where[row : stop + 1])
        owner = np.repeat(np.arange(stop - row), size)
        kinds[row:stop] = np.bincount(owner * 6 + _KIND[own], minlength=(stop - row) * 6).reshape(-1, 6)
        if len(own) > 1:
            inside = owner[1:] == owner[:-1]
            pair = _PAIR[(own[:-1].astype(np.int64) << 8) | own[1:]]
            count = np.bincount((owner[:-1] * PAIRS + pair)[inside], minlength=(stop - row) * PAIRS)
            content[row:stop] = count.reshape(-1, PAIRS)
        row = stop
    content = np.sqrt(content / np.maximum(content.sum(axis=1, keepdims=True), 1))
    total = kinds.sum(axis=1)
    lines = kinds[:, 5] + 1
    recorded = chars.cast(pa.float64()).fill_null(0).to_numpy()
    page[:, 0] = np.log1p(np.maximum(recorded, 0))
    page[:, 1] = np.log1p(lines)
    page[:, 2] = np.log1p(total / lines)
    page[:, 3:7] = kinds[:, 1:5] / np.maximum(total, 1)[:, None] * 4
    page[:, 7] = total == 0
    page[np.arange(n), 8 + _slots(lang, LANGS)] = 1
    page[np.arange(n), 8 + LANGS + _slots(source, SOURCES)] = 1
    return content, page


def logit(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(x @ w[:-1] + w[-1], -30, 30)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-z))


class Model:
    """Both views with their calibrations, and the model on top."""

    def __init__(self, weights: list[np.ndarray], scales: list[np.ndarray], top: np.ndarray):
        self.weights, self.scales, self.top = weights, scales, top

    def calibrated(self, both: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Calibrated log-odds of each view."""
        return np.stack([np.clip(logit(x, w) * s[0] + s[1], -12, 12) for x, w, s in zip(both, self.weights, self.scales, strict=True)], axis=1)

    def score(self, both: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        return sigmoid(logit(self.calibrated(both), self.top))


class Constant:
    def __init__(self, value: float):
        self.value = value

    def score(self, both) -> np.ndarray:
        return np.full(len(both[0]), self.value)


def record(docs: DataFrame, text: str) -> list:
    """Text and record columns; missing ones are null."""
    kinds = {"lang": "string", "source": "string", "n_chars": "long"}
    return [F.col(text)] + [(F.col(c) if c in docs.columns else F.lit(None)).cast(kinds[c]) for c in RECORD]


def stored_views(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """Features of every document with its label (null without one), as a stored table."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                content, page = views(*(part.column(i) for i in range(1, 5)))
                packed = np.round(content * 255).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([r.tobytes() for r in packed], pa.binary()), pa.array([r.tobytes() for r in page], pa.binary())],
                    names=["doc", "content", "page"],
                )

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc"), *record(docs, text)).mapInArrow(made, f"doc {kind}, content binary, page binary")
    known = labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(key).alias("doc")).agg(F.max(label).cast("double").alias("label"))
    return written(rows.join(known, "doc", "left"), "views")


def unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Both views of the rows of a batch of ``stored_views``."""

    def matrix(name: str, kind: type, width: int) -> np.ndarray:
        column = batch.column(name).cast(pa.binary())
        first = int(np.frombuffer(column.buffers()[1], np.int32)[column.offset])
        return np.frombuffer(column.buffers()[2], kind, len(column) * width, first).reshape(-1, width)

    if not batch.num_rows:
        return np.zeros((0, PAIRS), np.float32), np.zeros((0, PAGE), np.float32)
    return matrix("content", np.uint8, PAIRS).astype(np.float32) / 255, matrix("page", np.float32, PAGE)


def told(p: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each view the rows that the other one tells it to be good and to be bad."""
    out = []
    for view in (0, 1):
        teacher, pupil = p[:, 1 - view], p[:, view]
        out.append(((teacher >= CONFIDENT) & (pupil >= 1 - OBJECTS), (teacher <= 1 - CONFIDENT) & (pupil <= OBJECTS)))
    return out


def co_train(table: DataFrame, rounds: int = ROUNDS) -> Model | Constant:
    """Fit both views on all ``stored_views`` rows, teaching each other over ``rounds``."""
    table = table.withColumn("held", F.pmod(F.xxhash64("doc"), F.lit(4)) == 3)
    known = written(table.filter("label is not null"), "known")
    # At most four rows.
    count = {(r["held"], r["label"]): r["count"] for r in known.groupBy("held", "label").count().collect()}
    n, good = sum(count.values()), sum(v for (_, label), v in count.items() if label)
    if not 0 < good < n:
        return Constant(good / n if n else 1.0)
    share = good / n
    # Every fourth labelled document is kept back, if both parts have both kinds.
    apart = len(count) == 4
    used = sum(v for (held, _), v in count.items() if not held) if apart else n
    check = known.filter("held") if apart else known

    def labels(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Label and weight of each row; only labelled rows that are not kept back have one."""
        y = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
        held = batch.column("held").to_numpy(zero_copy_only=False).astype(bool)
        return np.nan_to_num(y), (~np.isnan(y) & ~(held & apart)).astype(float)

    def calibrated(weights: list[np.ndarray], scales: list[np.ndarray]) -> Model:
        def examples(batch: pa.RecordBatch) -> Examples:
            y = batch.column("label").to_numpy(zero_copy_only=False)
            return [(logit(x, w)[:, None], y, np.ones(len(y))) for x, w in zip(unpacked(batch), weights, strict=True)]

        scales = logistic(check, examples, scales, scaled(1e-4))
        return Model(weights, [np.array([max(s[0], 0.0), s[1]]) for s in scales], np.array([1.0, 1.0, 0.0]))

    def taught(teachers: Model) -> Model:
        def pseudo(batch: pa.RecordBatch, both: tuple[np.ndarray, np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
            free = batch.column("label").is_null().to_numpy(zero_copy_only=False)
            return [(good & free, bad & free) for good, bad in told(sigmoid(teachers.calibrated(both)))]

        def counted(batch: pa.RecordBatch) -> np.ndarray:
            return np.array([x.sum() for sides in pseudo(batch, unpacked(batch)) for x in sides], dtype=float)

        many = totals(table, counted, 4).reshape(2, 2)
        # All that one view tells the other weighs at most ``TAUGHT`` of the labels, by their classes.
        each = np.minimum(LIGHT, TAUGHT * used * np.array([share, 1 - share]) / np.maximum(many, 1))

        def examples(batch: pa.RecordBatch) -> Examples:
            both, (y, weight) = unpacked(batch), labels(batch)
            sides = zip(both, pseudo(batch, both), each, strict=True)
            return [(x, y + good, weight + good * per[0] + bad * per[1]) for x, (good, bad), per in sides]

        return calibrated(logistic(table, examples, teachers.weights, scaled(1e-3)), teachers.scales)

    first = logistic(known, lambda batch: [(x, *labels(batch)) for x in unpacked(batch)], [np.zeros(PAIRS + 1), np.zeros(PAGE + 1)], scaled(1e-3))
    model = calibrated(first, [np.zeros(2), np.zeros(2)])
    for _ in range(rounds):
        model = taught(model)

    def joint(batch: pa.RecordBatch) -> Examples:
        y = batch.column("label").to_numpy(zero_copy_only=False)
        return [(model.calibrated(unpacked(batch)), y, np.ones(len(y)))]

    (top,) = logistic(check, joint, [np.zeros(3)], scaled(1e-3))
    dropped(known)
    return Model(model.weights, model.scales, top)


def scorer(docs: DataFrame, model, text: str = "text"):
    """Column expression: the score of each document."""

    @arrow_udf("double")
    def scored(texts: pa.Array, lang: pa.Array, source: pa.Array, chars: pa.Array) -> pa.Array:
        parts = [model.score(views(*(c.slice(at, 1024) for c in (texts, lang, source, chars)))) for at in range(0, len(texts), 1024)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return scored(*record(docs, text))


def kept(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """``docs`` without those below ``KEEP``; the columns stay as they are."""
    model = co_train(stored_views(docs, labels, key, text, label))
    scored = docs.select(F.struct(*docs.columns).alias("_whole"), scorer(docs, model, text).alias("_score"))
    return scored.filter(F.col("_score") >= KEEP).select("_whole.*")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, and whether it is kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = co_train(stored_views(docs, labels, "doc_id", "text", "quality"))
    return docs.select("doc_id", scorer(docs, model).alias("score")).withColumn("kept", F.col("score") >= KEEP)
