"""Quality classifier by co-training of two views: the text's content and the page's metadata.

Both views start from the labelled rows of a bounded sample. In each round each classifier labels a pool of other
rows; what it is sure of joins the training rows of the other one. Afterwards both are calibrated on labelled rows that
neither was trained on, a small logistic model combines the two calibrated views, and all documents are scored.

The content view sees word counts (of the VOCABULARY most frequent words of the sample) and shares of kinds of
characters; the metadata view sees language, source and length. Fitting takes about LABELLED labelled rows and a pool of
about POOL rows, both chosen by a hash of the text; the scores cover whole texts of all rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swathbook.llm.shared import ship_package
from swathbook.llm.words import bytes_of, words

#: Rows of the fitting sample (about; chosen by hash).
LABELLED, POOL = 3000, 3000
VOCABULARY = 2048
ROUNDS = 3
#: A pseudo-label needs this probability, and a round takes at most this share of the pool from each view.
SURE, SHARE = 0.9, 0.1
#: One labelled row in so many is kept for calibration.
FOLD = 4
#: Hash slots of a language, of a source.
SLOTS = 64

_KINDS = ["A-Z", "a-z", "0-9", " ", "\n", "!", "|", "#$%&*", "other ASCII", "beyond ASCII"]


def _kind_table() -> np.ndarray:
    table = np.full(256, 8, np.int64)
    table[0x80:] = 9
    for k, spell in enumerate(["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " ", "\n", "!", "|", "#$%&*"]):
        for c in spell:
            table[ord(c)] = k
    return table


KIND = _kind_table()
STYLE = len(_KINDS) + 3


def style(texts: pa.Array) -> np.ndarray:
    """Shares of kinds of bytes, length, and words: one row of STYLE numbers (around 0 to 1) for each text."""
    data, bounds = bytes_of(texts)
    out = np.zeros((len(texts), STYLE))
    for i in range(len(texts)):
        total, begin = np.zeros(len(_KINDS)), int(bounds[i])
        while begin < bounds[i + 1]:
            part = data[begin : min(begin + (1 << 20), int(bounds[i + 1]))]
            total += np.bincount(KIND[part], minlength=len(_KINDS))
            begin += len(part)
        out[i, : len(_KINDS)] = total / max(1.0, total.sum())
        out[i, len(_KINDS)] = np.log1p(total.sum()) / 10
    for first, hashes, edges in words(texts):
        for i in range(len(edges) - 1):
            own = hashes[edges[i] : edges[i + 1]]
            if len(own):
                counts = np.unique(own, return_counts=True)[1]
                out[first + i, -2:] = len(counts) / len(own), counts.max() / len(own)
    return out


def _hash_slot(value: str | None, salt: str) -> int:
    import zlib

    return zlib.crc32(f"{salt}:{value}".encode("utf-8", "surrogatepass")) % SLOTS if value is not None else SLOTS


def metadata(langs: list, sources: list, lengths: list) -> np.ndarray:
    """Hash slots of language and source (the last slot: null), and the length's logarithm."""
    out = np.zeros((len(langs), 2 * (SLOTS + 1) + 2))
    for i, (lang, source, length) in enumerate(zip(langs, sources, lengths, strict=True)):
        out[i, _hash_slot(lang, "lang")] = 1
        out[i, SLOTS + 1 + _hash_slot(source, "source")] = 1
        out[i, -2:] = (np.log1p(max(0, length)) / 10, 0) if length is not None else (0, 1)
    return out


def content(texts: pa.Array, vocabulary: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of (row, word number, value): log(1 + count) of each vocabulary word, rows of length 1."""
    for first, hashes, edges in words(texts):
        at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
        known = vocabulary[at] == hashes
        row = np.repeat(np.arange(len(edges) - 1), np.diff(edges))[known]
        key, counts = np.unique(row * len(vocabulary) + at[known], return_counts=True)
        row, word, value = key // len(vocabulary), key % len(vocabulary), np.log1p(counts)
        length = np.sqrt(np.bincount(row, value * value, minlength=len(edges) - 1))
        yield first + row, word, value / length[row]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-4, steps: int = 120) -> np.ndarray:
    """Weights and bias of a logistic regression, by accelerated gradient descent; no copy of ``x`` is made."""
    weight = (weight / weight.sum()).astype(x.dtype)
    y = y.astype(x.dtype)
    rate = x.dtype.type(1 / (0.25 * float(np.einsum("ij,ij->i", x, x).max() + 1) + penalty))
    w = z = np.zeros(x.shape[1] + 1, x.dtype)
    t = 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ z[:-1] + z[-1], -80, 80)))
        pull = weight * (p - y)
        step = z - rate * (np.append(pull @ x, pull.sum()) + x.dtype.type(penalty) * z)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = step + x.dtype.type((t - 1) / t_next) * (step - w)
        w, t = step, t_next
    return w.astype(np.float64)


def _logit(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1].astype(x.dtype) + w[-1]


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -500, 500)))


def _platt(logit: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slope and intercept that turn a view's logit into a calibrated one (targets pulled off 0 and 1)."""
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    return logistic(logit[:, None] / SPREAD, target, np.ones(len(y)), 1e-6, 400)


#: Logits are scaled down by this for the calibration's gradient steps.
SPREAD = 4.0


def co_train(views: list[np.ndarray], y: np.ndarray, labelled: np.ndarray, fold: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Weights and calibrations of both views, and the weights that combine their calibrated logits.

    ``y`` holds labels where ``labelled``; rows of ``fold`` calibrate. Other rows are the pool.
    """
    train, check = labelled & ~fold, labelled & fold
    held = [train.copy(), train.copy()]
    label = [np.where(train, y, 0.0), np.where(train, y, 0.0)]
    models = [np.zeros(v.shape[1] + 1) for v in views]
    scales = [np.zeros(2), np.zeros(2)]
    for turn in range(ROUNDS + 1):
        for k in (0, 1):
            rows = held[k]
            models[k] = logistic(views[k][rows], label[k][rows], np.where(train[rows], 1.0, 0.5))
            scales[k] = _platt(_logit(views[k][check], models[k]), y[check])
        if turn == ROUNDS:
            break
        for k in (0, 1):  # what one view is sure of teaches the other
            free = np.flatnonzero(~held[1 - k] & ~labelled)
            p = _sigmoid(_logit(_logit(views[k][free], models[k])[:, None] / SPREAD, scales[k]))
            sure = np.maximum(p, 1 - p)
            best = np.argsort(-sure, kind="stable")[: int(SHARE * (~labelled).sum())]
            best = best[sure[best] >= SURE]
            held[1 - k][free[best]] = True
            label[1 - k][free[best]] = (p[best] >= 0.5).astype(float)
    both = np.stack([_logit(_logit(views[k][check], models[k])[:, None] / SPREAD, scales[k]) for k in (0, 1)], 1)
    return models, scales, logistic(both / SPREAD, y[check], np.ones(check.sum()), 1e-6, 400)


@dataclass
class QualityModel:
    vocabulary: np.ndarray
    targets: dict[str, tuple[list[np.ndarray], list[np.ndarray], np.ndarray]]

    def scores(self, texts: pa.Array, langs: list, sources: list, lengths: list) -> dict[str, np.ndarray]:
        meta, shape = metadata(langs, sources, lengths), style(texts)
        sums = {name: np.zeros(len(texts)) for name in self.targets}
        if len(self.vocabulary):
            for row, word, value in content(texts, self.vocabulary):
                for name, (models, _, _) in self.targets.items():
                    sums[name] += np.bincount(row, value * models[0][word], minlength=len(texts))
        out = {}
        for name, (models, scales, mix) in self.targets.items():
            text = sums[name] + shape @ models[0][len(self.vocabulary) : -1] + models[0][-1]
            both = [text, _logit(meta, models[1])]
            both = np.stack([_logit(v[:, None] / SPREAD, s) for v, s in zip(both, scales, strict=True)], 1)
            out[name] = _sigmoid(_logit(both / SPREAD, mix))
        return out


def fit_quality(df: DataFrame, labels: DataFrame, targets: list[str], id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", length: str = "n_chars") -> QualityModel | None:
    """Fit one pair of views for each of ``targets`` (0/1 columns of ``labels``); None if nothing is labelled.

    Rows with a null text, and labels with a null id or target, teach nothing; equal texts count once for each label.
    A target with one value only gives that value's smoothed share.
    """
    ship_package(df.sparkSession)
    marks = labels.where(F.col(id).isNotNull()).select(F.col(id).alias("id"), *[F.col(c).cast("double").alias(f"y_{c}") for c in targets]).dropna().distinct()
    rows = df.select(F.col(id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(length).cast("double").alias("length"))
    rows = rows.where("text is not null").withColumn("h", F.xxhash64("text"))
    n = rows.count()
    n_marks = marks.count()
    if not n or not n_marks:
        return None
    part = F.pmod("h", F.lit(1 << 20)) / F.lit(1 << 20)
    marked = rows.join(marks, "id").where(part < min(1.0, LABELLED / n_marks))
    pool = rows.join(marks.select("id").distinct(), "id", "left_anti").where(1 - part <= min(1.0, POOL / n))
    pool = pool.select(*rows.columns, *[F.lit(None).cast("double").alias(f"y_{c}") for c in targets])
    kept = marked.select(*pool.columns).unionByName(pool).dropDuplicates(["h", *[f"y_{c}" for c in targets]])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            shape = style(texts)
            found, counts = [], []
            for _, hashes, edges in words(texts):
                for i in range(len(edges) - 1):
                    v, c = np.unique(hashes[edges[i] : edges[i + 1]], return_counts=True)
                    found.append(v.view(np.int64)), counts.append(c.astype(np.int32))
            more = {"words": pa.array(found, pa.list_(pa.int64())), "counts": pa.array(counts, pa.list_(pa.int32())), "style": pa.array(list(shape), pa.list_(pa.float64()))}
            same = {c: batch.column(c) for c in ["h", "lang", "source", "length", *[f"y_{c}" for c in targets]]}
            yield pa.RecordBatch.from_pydict(same | more)

    schema = "h long, lang string, source string, length double, " + ", ".join(f"y_{c} double" for c in targets) + ", words array<long>, counts array<int>, style array<double>"
    got = kept.mapInArrow(features, schema).repartition(1).mapInArrow(_fitted(targets), "model binary").collect()
    return pickle.loads(got[0]["model"]) if got else None


def _fitted(targets: list[str]):
    """The model of all rows, which are the bounded sample; one task on an executor fits it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        model = fit_sample(pa.Table.from_batches(parts).to_pandas(), targets) if parts else None
        if model is not None:
            yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(model)], pa.binary())})

    return run


def fit_sample(got: pd.DataFrame, targets: list[str]) -> QualityModel | None:
    """Fit on the sample's rows: h, lang, source, length, y_<target> (null: pool), words, counts, style."""
    got = got.sort_values(["h", *[f"y_{c}" for c in targets]]).reset_index(drop=True)
    labelled = got[f"y_{targets[0]}"].notna().to_numpy()
    if labelled.sum() < 2:
        return None
    words_all, per = np.unique(np.concatenate([*got["words"][labelled], np.zeros(0, np.int64)]), return_counts=True)
    top = words_all[np.lexsort((words_all, -per))[:VOCABULARY]].view(np.uint64)
    vocabulary = np.sort(top)
    x = np.zeros((len(got), len(vocabulary) + STYLE), np.float32)
    for i, (w, c, s) in enumerate(zip(got["words"], got["counts"], got["style"], strict=True)):
        x[i, len(vocabulary) :] = s
        if len(vocabulary) and len(w):
            own = np.asarray(w, np.int64).view(np.uint64)
            at = np.minimum(np.searchsorted(vocabulary, own), len(vocabulary) - 1)
            known = vocabulary[at] == own
            value = np.log1p(np.asarray(c)[known])
            if len(value):
                x[i, at[known]] = value / np.sqrt((value * value).sum())
    none = [None if v is None or v != v else v for v in got["length"]]
    views = [x, metadata([None if not isinstance(v, str) else v for v in got["lang"]], [None if not isinstance(v, str) else v for v in got["source"]], none)]
    fold = (got["h"].to_numpy() >> 20) % FOLD == 0
    if not (labelled & fold).any() or not (labelled & ~fold).any():
        fold = np.arange(len(got)) % 2 == 0 if labelled.all() else np.cumsum(labelled) % 2 == 0
    return QualityModel(vocabulary, {c: co_train(views, np.nan_to_num(got[f"y_{c}"].to_numpy(float)), labelled, fold) for c in targets})


def score_quality(df: DataFrame, model: QualityModel | None, targets: list[str], text: str = "text", lang: str = "lang", source: str = "source", length: str = "n_chars") -> DataFrame:
    """``df`` with a column ``p_<target>`` (0 to 1) for each target; such columns are replaced if they exist.

    A null or empty text has no content and is judged by its metadata; null metadata are a value of their own. Without
    a model all scores are null. Whole texts are read. Repeated rows get equal scores; an empty table stays empty.
    """
    names = [f"p_{c}" for c in targets]
    kept = [c for c in df.columns if c not in names]
    if model is None:
        return df.select(*kept, *[F.lit(None).cast("double").alias(c) for c in names])
    spark = df.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    def score(texts: pa.Array, langs: pa.Array, sources: pa.Array, lengths: pa.Array) -> pa.Array:
        found = shared.value.scores(texts, langs.to_pylist(), sources.to_pylist(), lengths.to_pylist())
        return pa.StructArray.from_arrays([pa.array(found[c], pa.float64()) for c in targets], names=names)

    kind = "struct<" + ",".join(f"{c}:double" for c in names) + ">"
    scored = F.arrow_udf(score, kind)(F.col(text), F.col(lang).cast("string"), F.col(source).cast("string"), F.col(length).cast("double"))
    found = df.select(*kept, scored.alias("p_all_targets"))
    return found.select(*kept, *[F.col(f"p_all_targets.{c}").alias(c) for c in names])
