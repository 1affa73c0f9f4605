"""Near-duplicate documents: improved consistent weighted sampling over TF-IDF word shingles, banded and verified.

Method. A document's words (five in a row make a shingle) weigh tf * idf. Each of ``bands * rows`` samples takes one
shingle such that two documents agree with a probability equal to their weighted Jaccard similarity. Bands of samples
are bucket keys; pairs that share a bucket are verified by the exact weighted Jaccard similarity of their whole texts,
and verified pairs are joined by a distributed union-find. Buckets whose members are not linked by trying them against
one of them are refined: by the rarest shingles of their documents, of which similar documents share one. What a document
has left from that shingle on bounds what it can share, which rules out most pairs of a family before they are made.

Document frequencies of all shingles are counted. Distinct texts are packed in batches; a batch counts its own shingles
and sends them, cut in bins by hash, to where a bin's counts are summed; the sums go back to the batches that asked. A
shingle that all batches have is one entry of each, so no key grows with its frequency. ``_idf`` has the two scales.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swathbook.llm.components import crowded, linked
from swathbook.llm.shared import drop_tables, release, ship_package, trim_memory, write_table
from swathbook.llm.words import mix64, shingles, words

WIDTH = 5
THRESHOLD = 0.8
BANDS, ROWS = 25, 4
#: Without a spread, shingles in less than this share of the documents all have the largest idf.
FLOOR = 0.01
#: Largest over smallest idf, as the registered queries use it.
SPREAD = 1.5
#: Bytes of text in a batch, and bytes of text for each bin of shingles.
LEAST_BATCH, MOST_BATCH, BIN_BYTES = 1 << 18, 1 << 23, 1 << 23
#: Rows of the table of random variates; a shingle takes the row of its hash.
VARIATES = 1 << 16
#: Shingles whose scores are computed at once.
SCORED = 1 << 12
#: Rows of candidate keys up to which they are broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 1_000_000


def _per_row(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Row number, its distinct shingles in ascending order, and their counts."""
    for first, hashes, bounds in words(texts):
        for i in range(len(bounds) - 1):
            yield first + i, *np.unique(shingles(hashes[bounds[i] : bounds[i + 1]], WIDTH), return_counts=True)


def _idf(df: np.ndarray, n: int, spread: float | None) -> np.ndarray:
    """idf of shingles in ``df`` of ``n`` documents.

    With a ``spread``, ln(1 + n / df), but no less than the idf of a single occurrence divided by ``spread``: however
    large a group of copies is, the words they share keep that much weight against the words they do not share.
    Without, ln(1 + n / df) where df is FLOOR * n at least.
    """
    if spread is None:
        return np.log1p(n / np.maximum(df, FLOOR * n))
    return np.maximum(np.log1p(n / df), np.log1p(n) / spread)


def _batched(limit: int):
    """Rows (node, copies, text) to rows (batch, nodes, copies, data); ``data`` are the texts as compressed Arrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, size = TaskContext.get().partitionId() << 33, [], 0

        def flush() -> pa.RecordBatch:
            whole = pa.Table.from_batches(parts)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, whole.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(whole)
            return pa.RecordBatch.from_pydict({"batch": pa.array([number], pa.int64()), "data": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

        for batch in batches:
            begin, lengths = 0, pc.binary_length(batch.column("text")).to_pylist()
            for i, length in enumerate(lengths):
                size += length
                if size >= limit:
                    parts.append(batch.slice(begin, i + 1 - begin))
                    yield flush()
                    number, parts, size, begin = number + 1, [], 0, i + 1
            if begin < len(lengths):
                parts.append(batch.slice(begin))
        if parts:
            yield flush()

    return run


def _unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all().combine_chunks()


def _asked(bins: int, by_copies: bool):
    """Each batch's distinct shingles in bins, ascending, and the number of documents of the batch that have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for number, data in zip(rows.column("batch").to_pylist(), rows.column("data"), strict=True):
                held = _unpacked(data.as_buffer())
                copies = held["copies"].to_numpy() if by_copies else np.ones(len(held), np.int64)
                found = [(i, v) for i, v, _ in _per_row(held["text"])]
                values = np.concatenate([v for _, v in found])
                weight = np.repeat(copies[[i for i, _ in found]], [len(v) for _, v in found])
                values, which = np.unique(values, return_inverse=True)
                n = np.bincount(which, weight, minlength=len(values)).astype(np.uint32)
                place = ((values >> np.uint64(32)) % np.uint64(bins)).astype(np.int64)
                order = np.argsort(place, kind="stable")
                used, first = np.unique(place[order], return_index=True)
                cuts = [*first[1:], len(order)][: len(first)]
                out = {
                    "batch": pa.array(np.full(len(used), number), pa.int64()),
                    "bin": pa.array(used, pa.int64()),
                    "shingles": pa.array([values[order[a:b]].tobytes() for a, b in zip(first, cuts, strict=True)], pa.binary()),
                    "n": pa.array([n[order[a:b]].tobytes() for a, b in zip(first, cuts, strict=True)], pa.binary()),
                }
                yield pa.RecordBatch.from_pydict(out)

    return run


def _answered(n: int, spread: float | None):
    """For each batch, those of its shingles in a bin that have less than the largest idf, and their frequencies."""

    def run(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["shingles"]]
        counts = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in table["n"]])
        bounds = np.cumsum([0, *map(len, parts)])
        df = np.bincount(which := np.unique(np.concatenate(parts), return_inverse=True)[1], counts)
        common = (_idf(df, n, spread) < _idf(np.ones(1), n, spread))[which]
        df = np.minimum(df, 0xFFFFFFFF).astype(np.uint32)[which]
        kept = [common[a:b] for a, b in zip(bounds, bounds[1:])]
        out = {
            "batch": table["batch"],
            "shingles": pa.array([p[k].tobytes() for p, k in zip(parts, kept, strict=True)], pa.binary()),
            "df": pa.array([df[a:b][k].tobytes() for a, b, k in zip(bounds, bounds[1:], kept)], pa.binary()),
        }
        return pa.table(out)

    return run


def _signed(n: int, spread: float | None):
    """Bands of each document of a batch, and the frequencies of its distinct shingles in ascending order."""

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        joined = lambda name, kind: np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in answers[name]] or [np.zeros(0, kind)])
        keys, df = joined("shingles", np.uint64), joined("df", np.uint32)
        order = np.argsort(keys)
        keys, df = keys[order], df[order]
        top = float(_idf(np.ones(1), n, spread)[0])
        model = keys, _idf(df, n, spread), top
        often = tuple(float(x) for x in np.unique(_idf(np.array([1.0, n]), n, spread)))
        nodes, bands, levels = [], [], []
        for data in texts["data"]:
            held = _unpacked(data.as_buffer())
            nodes.extend(held["node"].to_pylist())
            out: list = [([], b"")] * len(held)
            for i, values, counts in _per_row(held["text"]):
                if len(values):
                    own = np.ones(len(values), np.uint32)
                    at = np.minimum(np.searchsorted(keys, values), max(len(keys) - 1, 0))
                    known = keys[at] == values if len(keys) else np.zeros(len(values), bool)
                    own[known] = df[at[known]]
                    out[i] = sample_bands(values, counts, model, often=often), own.tobytes()
            bands.extend(b for b, _ in out)
            levels.extend(v for _, v in out)
        trim_memory()
        return pa.table({"node": pa.array(nodes, pa.int64()), "bands": pa.array(bands, pa.list_(pa.int64())), "levels": pa.array(levels, pa.binary())})

    return run


def _weights(values: np.ndarray, counts: np.ndarray, model) -> np.ndarray:
    keys, idf, top = model
    out = counts * top
    if len(keys) and len(values):
        at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
        known = keys[at] == values
        out[known] = counts[known] * idf[at[known]]
    return out


@lru_cache(2)
def _variates(samples: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r and c from Gamma(2, 1) (c as a logarithm), b uniform, for each row and sample; the same in every process."""
    draw = np.random.Generator(np.random.PCG64(20240607))
    r = draw.standard_gamma(2.0, (VARIATES, samples), dtype=np.float32)
    c = draw.standard_gamma(2.0, (VARIATES, samples), dtype=np.float32)
    return np.maximum(r, np.float32(1e-6), out=r), np.log(c, out=c), draw.random((VARIATES, samples), dtype=np.float32)


def _scores(rows: np.ndarray, log_weight: np.ndarray, samples: int) -> np.ndarray:
    """ln a of the sampling scheme: the shingle with the smallest is the sample."""
    r, c, b = _variates(samples)
    r, b = r[rows], b[rows]
    step = np.floor(log_weight[:, None] / r + b)
    return c[rows] - r * (step - b) - r


@lru_cache(2)
def _plain_scores(samples: int, weight: float) -> np.ndarray:
    """Scores of a common weight, such as that of a rare shingle that occurs once."""
    out = np.empty((VARIATES, samples), np.float32)
    for begin in range(0, VARIATES, SCORED):
        rows = np.arange(begin, min(begin + SCORED, VARIATES))
        out[rows] = _scores(rows, np.full(len(rows), np.log(weight), np.float32), samples)
    return out


def drop_variates() -> None:
    """Free this process's tables of variates and scores; the functions that run after the bands are signed have no use for them."""
    if _variates.cache_info().currsize or _plain_scores.cache_info().currsize:
        _variates.cache_clear()
        _plain_scores.cache_clear()
        trim_memory()


def sample_bands(values: np.ndarray, counts: np.ndarray, model, bands: int = BANDS, rows: int = ROWS, often: tuple = ()) -> np.ndarray:
    """Bucket keys of one document: a hash of each band of consistent weighted samples (shingle and weight step).

    Scores of the weights in ``often`` are kept for further documents.
    """
    samples = bands * rows
    weights = _weights(values, counts, model)
    often = often or (model[2],)
    best = np.full(samples, np.inf, np.float32)
    pick = np.zeros(samples, np.int64)
    for begin in range(0, len(values), SCORED):
        part = slice(begin, begin + SCORED)
        at = (values[part] & np.uint64(VARIATES - 1)).astype(np.int64)
        scores, odd = np.empty((len(at), samples), np.float32), np.ones(len(at), bool)
        for weight in often:
            same = weights[part] == weight
            scores[same] = _plain_scores(samples, weight)[at[same]]
            odd &= ~same
        if odd.any():
            scores[odd] = _scores(at[odd], np.log(weights[part][odd]).astype(np.float32), samples)
        low = scores.argmin(0)
        score = scores[low, np.arange(samples)]
        better = score < best
        best[better], pick[better] = score[better], low[better] + begin
    r, _, b = _variates(samples)
    at = (values[pick] & np.uint64(VARIATES - 1)).astype(np.int64)
    which = np.arange(samples)
    step = np.floor(np.log(weights[pick]).astype(np.float32) / r[at, which] + b[at, which]).astype(np.int64).view(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    elements = mix64(values[pick] ^ mix64(step + np.uint64(1))).reshape(bands, rows)
    for i in range(rows):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + elements[:, i])
    return key.view(np.int64)


def weighted_jaccard(one, two, model) -> float:
    """Sum of the smaller over sum of the larger weights; ``one`` and ``two`` are (distinct shingles, counts)."""
    return _jaccard(one[0], _weights(*one, model), two[0], _weights(*two, model))


def _jaccard(one: np.ndarray, wa: np.ndarray, two: np.ndarray, wb: np.ndarray) -> float:
    _, ia, ib = np.intersect1d(one, two, assume_unique=True, return_indices=True)
    both = np.minimum(wa[ia], wb[ib]).sum()
    either = wa.sum() + wb.sum() - both
    return float(both / either) if either > 0 else 0.0


def prefix(values: np.ndarray, weights: np.ndarray, df: np.ndarray, threshold: float) -> np.ndarray:
    """The rarest shingles of a document, so many that the others weigh less than ``threshold`` of it.

    Two documents of a weighted Jaccard similarity of ``threshold`` or more share at least one of them: what they have in
    common weighs ``threshold`` of each or more, and cannot lie in the rest of the one whose prefix ends first.
    """
    return reaches(values, weights, df, threshold)[0]


def reaches(values: np.ndarray, weights: np.ndarray, df: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, float]:
    """The prefix, the reach of each of its shingles, and the weight of the document.

    Two similar documents have (1 + threshold) / threshold times the weight of what they share, or less, together. At
    the rarest shingle they share, all of that lies in this shingle and the more frequent ones of either. So there the
    weight of one is at most the other's reach: that multiple of what is left of it from the shingle on, less its weight.
    """
    order = np.lexsort((values, df))
    whole = weights.sum()
    rest = whole - np.cumsum(weights[order])
    # a small margin for rounding can only make the prefix and the reach longer
    size = int((rest >= threshold * whole * (1 - 1e-9)).sum()) + 1
    left = np.concatenate([[whole], rest[: size - 1]])[: len(order)]
    return values[order[:size]], (1 + threshold) / threshold * left * (1 + 1e-9) - whole, float(whole)


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, spread: float | None = None) -> DataFrame:
    """One row for each row of ``df``: id, text_key (hash of the text), class_id, class_key, class_rows.

    A class is a component of texts linked by a weighted Jaccard similarity of ``threshold`` or more; class_id is its
    smallest id (null only if all its ids are null) and class_key its key. Equal texts share a class, also those
    without a word (these have no other link). A row with a null text is a class of its own: its class_key is null and
    its class_id its own id. Repeated rows give repeated results. An empty table gives no rows. Other columns of
    ``df`` are not read.

    With a ``spread``, document frequencies are over distinct texts and the largest idf is at most ``spread`` times
    the smallest; without, they are over rows (see ``_idf``).
    """
    spark = df.sparkSession
    ship_package(spark)
    source = df.select(F.col(id).alias("id"), F.col(text).alias("text"))
    keyed = source.withColumn("text_key", F.md5("text"))
    listed = write_table(keyed.select("id", "text_key", F.octet_length("text").alias("size")), "listed")
    found = listed.where("text_key is not null")
    texts = found.groupBy("text_key").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    nodes = texts.repartitionByRange(parts, "id", "text_key").sortWithinPartitions("id", "text_key")
    nodes = write_table(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    total, size = listed.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    distinct = nodes.count()
    n = max(1, distinct if spread is not None else total)

    # a text is read from the one row that has its smallest id; where several rows have both, from any of them
    heads = nodes.join(found.groupBy("text_key", "id").agg(F.count(F.lit(1)).alias("same")).alias("r"), (nodes["text_key"] == F.col("r.text_key")) & nodes["id"].eqNullSafe(F.col("r.id")))
    heads = write_table(heads.select(nodes["text_key"], nodes["id"].alias("head"), "node", "copies", "same"), "heads")
    small = distinct <= BROADCAST_ROWS

    def whole_texts(where: str) -> DataFrame:
        wanted = heads.where(where)
        wanted = F.broadcast(wanted) if small else wanted
        return keyed.alias("k").join(wanted.alias("w"), (F.col("k.text_key") == F.col("w.text_key")) & F.col("k.id").eqNullSafe(F.col("w.head"))).select("node", "copies", "text")

    single = whole_texts("same = 1")
    if not heads.where("same > 1").isEmpty():
        single = single.unionByName(whole_texts("same > 1").groupBy("node").agg(F.first("copies").alias("copies"), F.first("text").alias("text")).select("node", "copies", "text"))
    limit = min(MOST_BATCH, max(LEAST_BATCH, size // (8 * parts)))
    packed = write_table(single.mapInArrow(_batched(limit), "batch long, data binary"), "packed")
    bins = max(parts, size // BIN_BYTES + 1)
    asked = packed.mapInArrow(_asked(bins, spread is None), "batch long, bin long, shingles binary, n binary")
    answers = asked.groupBy("bin").applyInArrow(_answered(n, spread), "batch long, shingles binary, df binary")
    answers = write_table(answers, "answers")
    del asked
    release(spark)
    signed = packed.groupBy("batch").cogroup(answers.groupBy("batch"))
    signed = write_table(signed.applyInArrow(_signed(n, spread), "node long, bands array<long>, levels binary"), "signed")
    drop_tables(answers, packed, heads)
    del answers, packed
    release(spark)
    buckets = crowded(signed.select("node", F.explode("bands").alias("key")))

    wanted = write_table(nodes.select("node", "text_key").join(buckets.select("node").distinct(), "node", "left_semi"), "wanted")
    small = wanted.select("node").limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    whole = keyed.join(F.broadcast(wanted) if small else wanted, "text_key")
    whole = whole.groupBy("node").agg(F.first("text").alias("text"))
    whole = write_table(whole.join(signed.select("node", "levels"), "node"), "texts")
    drop_tables(signed, wanted)

    def weighed(batch: pa.RecordBatch, side: str = "") -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        levels = batch.column(f"levels{side}")
        for i, values, counts in _per_row(batch.column(f"text{side}")):
            yield i, values, counts * _idf(np.frombuffer(levels[i].as_buffer(), np.uint32), n, spread)

    def holds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_variates()
        for batch in batches:
            one = {i: (v, w) for i, v, w in weighed(batch, "_a")}
            keep = [_jaccard(*one[i], v, w) >= threshold for i, v, w in weighed(batch, "_b")]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def verify(pairs: DataFrame) -> DataFrame:
        one = whole.select(F.col("node").alias("a"), F.col("text").alias("text_a"), F.col("levels").alias("levels_a"))
        two = whole.select(F.col("node").alias("b"), F.col("text").alias("text_b"), F.col("levels").alias("levels_b"))
        both = pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b", "levels_a", "levels_b")
        return both.mapInArrow(holds, "a long, b long")

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_variates()
        for batch in batches:
            nodes, parts = batch.column("node").to_numpy(), []
            for i, v, w in weighed(batch):
                keys, reach, weight = reaches(v, w, np.frombuffer(batch.column("levels")[i].as_buffer(), np.uint32), threshold)
                parts.append((np.full(len(keys), nodes[i]), keys.view(np.int64), np.full(len(keys), weight), reach))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(column)) for column in zip(*parts)], ["node", "key", "weight", "reach"])

    roots = linked(buckets, verify, lambda apart: whole.join(apart, "node", "left_semi").select("node", "text", "levels").mapInArrow(prefixes, "node long, key long, weight double, reach double"))
    drop_tables(whole, buckets)
    rooted = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = nodes.select(F.col("node").alias("root"), F.col("id").alias("class_id"), F.col("text_key").alias("class_key"))
    # nodes are numbered in the order of id with nulls first: a null id must not stand for a class that has another
    named = rooted.groupBy("root").agg(F.min("id").alias("known_id"))
    heads = heads.join(named, "root").select("root", F.coalesce("known_id", "class_id").alias("class_id"), "class_key")
    classes = rooted.select("text_key", "root").join(heads, "root").select("text_key", "root", "class_id", "class_key")
    found = listed.select("id", "text_key").join(classes, "text_key", "left")
    sizes = found.where("root is not null").groupBy("root").agg(F.count(F.lit(1)).alias("class_rows"))
    return found.join(sizes, "root", "left").select(
        F.col("id").alias(id),
        "text_key",
        F.when(F.col("text_key").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        "class_key",
        F.coalesce("class_rows", F.lit(1)).cast("long").alias("class_rows"),
    )
