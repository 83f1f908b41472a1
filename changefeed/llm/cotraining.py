"""A quality classifier by co-training on two views of a document.

*Content*: words and runs of signs, each present or not, kept where they tell the
classes apart. *Metadata*: language, source and layout (length, lines, shares of
signs, digits, capitals and different words), cut into steps. Each view has its
own logistic regression. In each round either view labels, for the other one, all
unlabelled documents it is sure of; both are fitted anew on the labelled rows and
these. At the end both are calibrated on labelled rows kept aside, combined, and
applied to every document.

The exchange covers the whole table. One pass turns texts into columns: the numbers
of a document's 0/1 features, some dozens of bytes. Every step of a fit is a scan of
those: a task adds up the gradient over its pseudo-labelled rows, and sums of fixed
size (views x classes x columns) reach the driver. Pseudo-labels of a class weigh as
much as its labelled rows together, however many there are, so the fit behaves alike at
every size. The curvature comes from the labelled rows.

Only the labelled rows that are fitted on are a bounded sample: at most ``LABELLED``,
those with the lowest hash of their id, so a run can be repeated; of near copies among
them one is used. They also choose the words and the steps.

Cases: null texts count as empty, null metadata as a value of its own; with fewer
than ``LEAST`` rows of either class there is nothing to learn and every document
is kept with score 1; repeated labels count as often as they occur; a document with any
label takes no part in the exchange; without unlabelled rows the views stay as fitted.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, ShortType, StructField, StructType

from changefeed.llm.common import utf8
from changefeed.session import settle

LABELLED, LEAST, SKETCH = 10_000, 8, 4
ROUNDS, SURE, STEPS_EACH = 3, 0.98, 3
FEATURES, LEAST_Z, STEPS = 512, 4.5, 8

TOKEN = re.compile(r"[^\W\d_]+|[^\w\s]+")
SIGN = re.compile(r"[^\w\s.,;:'\"!?-]")
DENSE, PART = 8, 512


def content(text: str) -> set[int]:
    """Hashes of the different words and sign runs of a text."""
    return {crc32(t.encode()) for t in set(TOKEN.findall(text.lower()))}


def layout(text: str, lang: str | None, source: str | None) -> list[float]:
    """Measures of the layout, then numbers standing for language and source."""
    words, lines, size = text.split(), text.count("\n") + 1, max(1, len(text))
    n = max(1, len(words))
    return [
        np.log1p(len(text)), np.log1p(lines), len(SIGN.findall(text)) / size,
        sum(map(text.count, "0123456789")) / size, sum(map(str.isupper, text)) / size,
        len(set(words)) / n, size / n, np.log1p(size / lines),
        float(crc32((lang or "").encode()) % 32), float(crc32((source or "").encode()) % 64),
    ]


@dataclass
class View:
    """A logistic regression over 0/1 columns."""

    weights: np.ndarray
    bias: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([part @ self.weights for part in _parts(x)]) + self.bias


def _parts(x: np.ndarray):
    """Few rows at a time as numbers: wide copies of all rows would fill the driver."""
    for at in range(0, max(1, len(x)), PART):
        yield x[at : at + PART].astype(np.float64)


def _curved(x: np.ndarray, error: Callable[[np.ndarray, slice], tuple[np.ndarray, np.ndarray]], w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of rows ``x`` and a bias; ``error`` gives error and weight of some rows by their chance."""
    gradient, curvature = np.zeros(len(w)), np.zeros((len(w), len(w)))
    for at, part in zip(range(0, max(1, len(x)), PART), _parts(x)):
        x1 = np.hstack([part, np.ones((len(part), 1))])
        miss, weight = error(_chance(x1 @ w), slice(at, at + PART))
        gradient += x1.T @ miss
        curvature += (x1 * weight[:, None]).T @ x1
    return gradient, curvature


def fit(x: np.ndarray, y: np.ndarray, decay: float = 1.0, steps: int = 12) -> View:
    """Newton steps on the penalised likelihood; the bias is not penalised."""
    w = np.zeros(x.shape[1] + 1)
    penalty = np.full(len(w), decay)
    penalty[-1] = 1e-6
    for _ in range(steps):
        gradient, curvature = _curved(x, lambda p, rows: (p - y[rows], p * (1 - p) + 1e-6), w)
        move = np.linalg.solve(curvature + np.diag(penalty), gradient + penalty * w)
        w -= move
        if np.abs(move).max() < 1e-6:
            break
    return View(w[:-1], float(w[-1]))


def telling(rows: list[np.ndarray], y: np.ndarray) -> list[int]:
    """The features whose presence differs most surely between the classes."""
    names = np.unique(np.concatenate(rows).astype(np.uint32)) if rows else np.empty(0, np.uint32)
    n, n_good = len(y), y.sum()
    good, found = np.zeros(len(names)), np.zeros(len(names), np.int64)
    for at in range(0, len(rows), PART):
        part = rows[at : at + PART]
        place = np.searchsorted(names, np.concatenate(part).astype(np.uint32))
        good += np.bincount(place, weights=np.repeat(y[at : at + PART], [len(r) for r in part]), minlength=len(names))
        found += np.bincount(place, minlength=len(names))
    # root of the likelihood ratio of the four counts against independence
    total = np.zeros(len(names))
    for seen, row, column in (
        (good, found, n_good), (found - good, found, n - n_good),
        (n_good - good, n - found, n_good), (n - n_good - found + good, n - found, n - n_good),
    ):
        total += np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) * n / np.maximum(row * column, 1e-9)), 0.0)
    z = np.sqrt(np.maximum(2 * total, 0))
    order = np.argsort(-z, kind="stable")[:FEATURES]
    return [int(names[i]) for i in order if z[i] >= LEAST_Z]


def present(rows: list, chosen: dict[int, int]) -> np.ndarray:
    x = np.zeros((len(rows), len(chosen)), np.float32)
    for i, row in enumerate(rows):
        for name in row:
            j = chosen.get(int(name))
            if j is not None:
                x[i, j] = 1
    return x


def stepped(dense: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """0/1 columns: the step of each measure, the language and the source."""
    blocks = []
    for j, c in enumerate(cuts):
        blocks.append(np.eye(len(c) + 1, dtype=np.float32)[np.searchsorted(c, dense[:, j])])
    blocks.append(np.eye(32, dtype=np.float32)[dense[:, DENSE].astype(int)])
    blocks.append(np.eye(64, dtype=np.float32)[dense[:, DENSE + 1].astype(int)])
    return np.hstack(blocks)


@dataclass
class Model:
    chosen: dict[int, int]
    cuts: list[np.ndarray]
    views: tuple[View, View]
    calibration: tuple[tuple[float, float], tuple[float, float]]
    combined: View

    def scores(self, rows: list, dense: np.ndarray) -> np.ndarray:
        """Columns: calibrated content view, calibrated metadata view, both combined."""
        return self.calibrated([self.views[0].logit(present(rows, self.chosen)), self.views[1].logit(stepped(dense, self.cuts))])

    def calibrated(self, logits: list[np.ndarray]) -> np.ndarray:
        logits = np.stack(logits, axis=1)
        logits = np.stack([a * logits[:, k] + b for k, (a, b) in enumerate(self.calibration)], axis=1)
        both = self.combined.logit(logits)
        return 1 / (1 + np.exp(-np.clip(np.column_stack([logits, both]), -30, 30)))


def _chance(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


class _Start:
    """What the labelled rows fix: words, steps, their 0/1 columns, and the views fitted on them alone."""

    def __init__(self, rows: list, dense: np.ndarray, y: np.ndarray):
        self.y, self.aside = y, np.arange(len(y)) % 4 == 3
        train = ~self.aside
        self.chosen = {name: j for j, name in enumerate(telling([r for r, t in zip(rows, train) if t], y[train]))}
        self.cuts = [np.unique(np.quantile(dense[train, j], np.linspace(0, 1, STEPS + 1)[1:-1])) for j in range(DENSE)]
        # 0/1 columns are held in a byte each
        self.x = [
            np.concatenate([columns(at).astype(np.uint8) for at in range(0, len(y), PART)]) for columns in (
                lambda at: present(rows[at : at + PART], self.chosen), lambda at: stepped(dense[at : at + PART], self.cuts),
            )
        ]
        self.views = [fit(x[train], y[train]) for x in self.x]

    def step(self, k: int, view: View, pseudo: np.ndarray, counts: np.ndarray, decay: float = 1.0) -> View:
        """One Newton step of view k; ``pseudo`` has the summed gradient of its pseudo-labelled rows for each class."""
        train = ~self.aside
        x, y = self.x[k][train], self.y[train]
        w = np.append(view.weights, view.bias)
        penalty = np.full(len(w), decay)
        penalty[-1] = 1e-6
        weight, more = np.ones(len(y)), penalty * w
        for c in (0, 1):
            if counts[c]:
                n = (y == c).sum()
                more += pseudo[c] * (n / counts[c])
                weight[y == c] += 1
        gradient, curvature = _curved(x, lambda p, rows: (p - y[rows], weight[rows] * (p * (1 - p) + 1e-6)), w)
        move = np.linalg.solve(curvature + np.diag(penalty), gradient + more)
        w = w - move / max(1.0, np.abs(move).max() / 4)  # far steps are cut: the curvature is that of labelled rows
        return View(w[:-1], float(w[-1]))

    def model(self, views: list[View]) -> Model:
        held = np.stack([views[k].logit(self.x[k][self.aside]) for k in range(2)], axis=1)
        y = self.y[self.aside]
        calibration = []
        for k in range(2):
            one = fit(held[:, k : k + 1], y, decay=1e-2)
            calibration.append((float(one.weights[0]), one.bias))
        level = np.stack([a * held[:, k] + b for k, (a, b) in enumerate(calibration)], axis=1)
        return Model(self.chosen, self.cuts, tuple(views), tuple(calibration), fit(level, y, decay=1e-2))


def _slices(batches, rows: int = 512):
    """Batches of few rows: each row is widened to all columns of a view."""
    for whole in batches:
        for at in range(0, whole.num_rows, rows):
            yield whole.slice(at, rows)


def _columns(lists: pa.Array, width: int) -> np.ndarray:
    """0/1 columns from lists of their numbers."""
    x = np.zeros((len(lists), width), np.float32)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    x[np.repeat(np.arange(len(lists)), sizes), lists.flatten().to_numpy(zero_copy_only=False)] = 1
    return x


def _numbered(rows: DataFrame, start: _Start) -> DataFrame:
    """(key, words, steps) of rows (key, text, lang, source): the numbers of the columns that are 1."""
    schema = StructType([rows.schema["key"], *[StructField(c, ArrayType(ShortType())) for c in ("words", "steps")]])
    chosen, cuts = start.chosen, start.cuts

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                words, dense = [], []
                for raw, lang, source in zip(utf8(batch.column(1)), batch.column(2), batch.column(3)):
                    text = raw.decode() if raw else ""
                    words.append(sorted({chosen[c] for c in content(text) if c in chosen}))
                    dense.append(layout(text, lang.as_py(), source.as_py()))
                steps = np.nonzero(stepped(np.array(dense), cuts))[1].reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), pa.array(words, pa.list_(pa.int16())),
                        pa.array(steps.astype(np.int16).tolist(), pa.list_(pa.int16())),
                    ],
                    names=["key", "words", "steps"],
                )

    return rows.mapInArrow(run, schema)


def _exchange(free: DataFrame, start: _Start, sure: list[View], views: list[View]) -> tuple[list, np.ndarray]:
    """Gradients of both views over the rows the other one of ``sure`` is sure of: ([view][class] vectors, counts)."""
    widths = [x.shape[1] for x in start.x]
    shared = free.sparkSession.sparkContext.broadcast((sure, views))

    def run(batches):
        sure, views = shared.value
        total = [np.zeros((2, w + 2)) for w in widths]
        for batch in _slices(batches):
            x = [_columns(batch.column(1 + k), widths[k]) for k in range(2)]
            chance = [_chance(sure[k].logit(x[k])) for k in range(2)]
            for k in range(2):
                p = _chance(views[k].logit(x[k]))
                for c, rows in enumerate((chance[1 - k] <= 1 - SURE, chance[1 - k] >= SURE)):
                    error = p[rows] - c
                    total[k][c, :-2] += error @ x[k][rows]
                    total[k][c, -2:] += error.sum(), rows.sum()
        view, label, at = zip(*[(k, c, j) for k in range(2) for c in range(2) for j in range(widths[k] + 2)])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(view, pa.int32()), pa.array(label, pa.int32()), pa.array(at, pa.int32()),
                pa.array(np.concatenate([t.ravel() for t in total])),
            ],
            names=["view", "label", "j", "total"],
        )

    sums = free.mapInArrow(run, "view int, label int, j int, total double").groupBy("view", "label", "j").agg(F.sum("total").alias("total"))
    out = [np.zeros((2, w + 2)) for w in widths]
    for k, c, j, total in sums.collect():  # views x classes x columns
        out[k][c, j] = total
    return [o[:, :-1] for o in out], np.array([o[:, -1] for o in out])


def co_train(free: DataFrame, start: _Start) -> Model:
    """Both views after their exchange over all rows of ``free`` (key, words, steps)."""
    views = start.views
    for _ in range(ROUNDS):
        sure = views
        for _ in range(STEPS_EACH):
            gradients, counts = _exchange(free, start, sure, views)
            views = [start.step(k, views[k], gradients[k], counts[k]) for k in range(2)]
    return start.model(views)


def _features(docs: DataFrame) -> DataFrame:
    """(label, content, dense, packed) of rows (text, lang, source, label); packed: content in 4 bytes each, big-endian."""

    def run(batches):
        for batch in _slices(batches):
            content_rows, dense = [], []
            for raw, lang, source in zip(utf8(batch.column(0)), batch.column(1), batch.column(2)):
                text = raw.decode() if raw else ""
                content_rows.append(sorted(content(text)))
                dense.append(layout(text, lang.as_py(), source.as_py()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(3), pa.array(content_rows, pa.list_(pa.int64())), pa.array(dense, pa.list_(pa.float64())),
                    pa.array([np.array(r, ">u4").tobytes() for r in content_rows], pa.binary()),
                ],
                names=["label", "content", "dense", "packed"],
            )

    return docs.mapInArrow(run, "label double, content array<bigint>, dense array<double>, packed binary")


def _column(df: DataFrame, name: str) -> Column:
    return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(
        F.col(key).alias("key"), F.col(text).alias("text"), _column(docs, "lang").alias("lang"),
        _column(docs, "source").alias("source"),
    )


def _labelled(docs: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    good = F.expr("cast(quality = 1 and coalesce(toxic, 0) = 0 as double)")
    return labels.filter("quality is not null").select(F.col(key).alias("key"), good.alias("label")).dropna()


def _start(docs: DataFrame, marks: DataFrame, key: str, text: str) -> _Start | None:
    """The bounded labelled sample, brought to the driver as features."""
    sample = marks.orderBy(F.xxhash64(F.col("key").cast("string")), "key", "label").limit(LABELLED)
    # a repeated id does not make the sample larger than its bound
    labelled = _rows(docs, key, text).join(F.broadcast(sample), "key").select("text", "lang", "source", "label")
    chosen = _features(labelled).orderBy(F.xxhash64("content", "dense"), "label").limit(LABELLED)
    found = chosen.select("label", F.col("packed").alias("content"), "dense").toArrow()
    y = found.column("label").to_numpy()
    lists = [np.frombuffer(v.as_buffer() or b"", ">u4") for chunk in found.column("content").chunks for v in chunk]
    dense = np.concatenate([c.flatten().to_numpy() for c in found.column("dense").chunks] or [np.empty(0)]).reshape(-1, DENSE + 2)
    # task order varies, so rows are put in an order of their own; bytes of ascending numbers stand in the order of these
    place = sorted(range(len(y)), key=lambda i: (dense[i].tolist(), lists[i].tobytes(), y[i]))
    # Copies would pass for evidence: of rows with the same lowest hashes one is enough.
    first: dict[tuple, int] = {}
    for i in place:
        first.setdefault(tuple(lists[i][:SKETCH].tolist() or [i]), i)
    place = list(first.values())
    if min(y[place].sum(), len(place) - y[place].sum()) < LEAST:
        return None
    return _Start([lists[i] for i in place], dense[place], y[place])


def _trained(docs: DataFrame, labels: DataFrame, key: str, text: str) -> tuple[Model | None, DataFrame | None]:
    """The model, and the numbered columns of all documents."""
    marks = _labelled(docs, labels, key)
    start = _start(docs, marks, key, text)
    if start is None:
        return None, None
    numbered = settle(_numbered(_rows(docs, key, text), start))
    return co_train(settle(numbered.join(marks.select("key").distinct(), "key", "left_anti")), start), numbered


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model | None:
    """Fit on a bounded sample of labelled rows and all unlabelled ones; good is quality 1 and not toxic."""
    return _trained(docs, labels, key, text)[0]


def train_and_score(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.5
) -> DataFrame:
    """(key, p_content, p_metadata, score, kept) for every row; texts are read once for training and scores."""
    model, numbered = _trained(docs, labels, key, text)
    if model is None:
        one = F.lit(1.0)
        return docs.select(
            key, one.alias("p_content"), one.alias("p_metadata"), one.alias("score"), F.lit(True).alias("kept")
        )
    widths = [len(model.chosen), len(model.views[1].weights)]
    schema = StructType([
        numbered.schema["key"], *[StructField(c, DoubleType()) for c in ("p_content", "p_metadata", "score")], StructField("kept", BooleanType())
    ])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in _slices(batches):
            p = model.calibrated([model.views[k].logit(_columns(batch.column(1 + k), widths[k])) for k in range(2)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(p[:, k]) for k in range(3)], pa.array(p[:, 2] >= least)], names=schema.names
            )

    return numbered.mapInArrow(run, schema).withColumnRenamed("key", key)


def score_documents(docs: DataFrame, model: Model | None, text: str = "text", least: float = 0.5) -> DataFrame:
    """(row, p_content, p_metadata, score, kept) for every row; row holds all columns of ``docs``."""
    named = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("text"),
        _column(docs, "lang").alias("lang"), _column(docs, "source").alias("source"),
    )
    schema = StructType(
        [named.schema["row"], *[StructField(c, DoubleType()) for c in ("p_content", "p_metadata", "score")], StructField("kept", BooleanType())]
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                if model is None:
                    p = np.ones((batch.num_rows, 3))
                else:
                    texts = [raw.decode() if raw else "" for raw in utf8(batch.column(1))]
                    meta = zip(texts, batch.column(2).to_pylist(), batch.column(3).to_pylist())
                    p = model.scores([content(t) for t in texts], np.array([layout(*m) for m in meta]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *[pa.array(p[:, k]) for k in range(3)], pa.array(p[:, 2] >= least)],
                    names=["row", "p_content", "p_metadata", "score", "kept"],
                )

    return named.mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier does not reject; each goes through once and whole."""
    model = train(docs, labels, key, text)
    if model is None:
        return docs
    shared, names = docs.sparkSession.sparkContext.broadcast(model), docs.columns
    place = {c: names.index(c) for c in (text, "lang", "source") if c in names}

    def run(batches):
        model = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                meta = [
                    [None if v is None else str(v) for v in batch.column(place[c]).to_pylist()] if c in place else [None] * batch.num_rows
                    for c in ("lang", "source")
                ]
                texts = [raw.decode() if raw else "" for raw in utf8(batch.column(place[text]))]
                p = model.scores([content(t) for t in texts], np.array([layout(*m) for m in zip(texts, *meta)]))
                yield batch.filter(pa.array(p[:, 2] >= least))

    return docs.mapInArrow(run, docs.schema)
