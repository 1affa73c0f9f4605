"""Groups of spelling variants: words that differ by one edit, found by products of letter-count blocks.

Words are counted by Spark. Words of one length whose letters fall alike into a few letter classes form a block, cut into
chunks of bounded size. One edit moves a block's class counts by at most one step, so a block only meets itself, the
blocks a replaced letter away and those a letter longer. For each such pair of chunks the Gram product of the
letter-count matrices gives all squared distances at once; pairs at two or less are kept and their edit is verified.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swathbook.llm.shared import ship_package, write_table

#: Words in a chunk, on average; two chunks make a product of at most about CHUNK x CHUNK cells.
CHUNK = 1024
#: Squared distance of letter counts that one edit can reach (a replaced letter: 2).
REACH = 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUNS = "[a-zÀ-ÿ]+"


def runs_of(text: str | Column) -> Column:
    """Maximal runs of Latin letters of a text, in order; only A-Z are lower-cased. Null has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(RUNS), F.lit(0))


def noisy(id: str, run: str, every: int = 97) -> Column:
    """The run, without one letter if ``every`` divides the crc32 of ``<id>:<run>``; with a null id as it is."""
    h = F.crc32(F.encode(F.concat(F.col(id).cast("string"), F.lit(":"), F.col(run)), "UTF-8"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(F.col(run), F.lit(1), at), F.substring(F.col(run), at + 2, F.length(run)))
    return F.when(h % every == 0, cut).otherwise(F.col(run))


def count_words(df: DataFrame, id: str = "doc_id", text: str = "text", least_letters: int = 5, least: int = 3, every: int = 97) -> DataFrame:
    """word, n: the words of all texts, those of at least ``least_letters`` code points that occur ``least`` times or more."""
    runs = df.select(F.col(id).alias("id"), F.explode(runs_of(F.col(text))).alias("run"))
    runs = runs.where(F.length("run") >= least_letters)  # a deletion makes a run shorter, never longer
    words = runs.select(noisy("id", "run", every).alias("word")).where(F.length("word") >= least_letters)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def letter_classes(words: DataFrame, classes: int) -> list[str]:
    """The letters of all words in ``classes`` strings of nearly equal weight; the driver sees one row for each letter."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").agg(F.count(F.lit(1)).alias("n"))
    out, weight = [""] * classes, [0] * classes
    for row in sorted(letters.collect(), key=lambda r: (-r["n"], r["letter"])):
        i = weight.index(min(weight))
        out[i] += row["letter"]
        weight[i] += row["n"]
    return out


def _moves(classes: int) -> list[list[int]]:
    """Steps from a block to the blocks it is sent to: itself, one letter replaced (each two blocks once), one letter more."""
    none = [0] * classes
    out = [none]
    for i in range(classes):
        out.append([int(k == i) for k in range(classes)])
    for i, j in itertools.combinations(range(classes), 2):
        out.append([int(k == i) - int(k == j) for k in range(classes)])
    return out


def letter_counts(codes: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """How often each of the sorted ``letters`` occurs in each row of ``codes``."""
    rows, width = codes.shape
    cell = np.searchsorted(letters, codes) + np.arange(rows)[:, None] * len(letters)
    return np.bincount(cell.ravel(), minlength=rows * len(letters)).reshape(rows, len(letters)).astype(np.float32)


def near_rows(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``a`` and of ``b`` (code points of words, one length each, b's the same or one more) one edit apart."""
    letters = np.union1d(a, b)
    u, v = letter_counts(a, letters), letter_counts(b, letters)
    gram = u @ v.T
    distance = (u * u).sum(1)[:, None] + (v * v).sum(1)[None, :] - 2 * gram
    i, j = np.nonzero(distance <= REACH)
    x, y = a[i], b[j]
    width = a.shape[1]
    if b.shape[1] == width:
        good = (x != y).sum(1) == 1
    else:
        front = np.logical_and.accumulate(x == y[:, :width], 1).sum(1)
        back = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], 1).sum(1)
        good = front + back >= width
    return i[good], j[good]


def _codes(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        word, near, near_n = [], [], []
        for row in batch.to_pylist():
            mine, mine_n, a = row["words"], row["ns"], _codes(row["words"])
            for width in (a.shape[1], a.shape[1] + 1):
                met = [c for c in row["met"] if len(c["other_words"][0]) == width and not c["same"]]
                theirs = [w for c in met for w in c["other_words"]]
                theirs_n = [n for c in met for n in c["other_ns"]]
                itself = len(theirs)
                if width == a.shape[1] and any(c["same"] for c in row["met"]):
                    theirs, theirs_n = theirs + mine, theirs_n + mine_n
                if not theirs:
                    continue
                i, j = near_rows(a, _codes(theirs))
                once = (j < itself) | (i < j - itself)
                for p, q in zip(i[once].tolist(), j[once].tolist(), strict=True):
                    word += [mine[p], theirs[q]]
                    near += [theirs[q], mine[p]]
                    near_n += [theirs_n[q], mine_n[p]]
        yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near, pa.string()), pa.array(near_n, pa.int64())], ["word", "near", "near_n"])


def near_words(words: DataFrame, classes: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """word, near, near_n: every ordered pair of words (columns word, n; word unique) that differ by exactly one edit.

    ``classes`` sets the number of letter classes and so the size of blocks, not the result; left out, it grows
    with the logarithm of the number of words.
    """
    spark = words.sparkSession
    ship_package(spark)
    if classes is None:
        classes = max(4, round(math.log2(words.count() + 1) / 3))
    parts = letter_classes(words, classes)
    sizes = [(F.length("word") - F.length(F.translate("word", p, ""))) if p else F.lit(0) for p in parts]
    keyed = words.select("word", "n", F.array(*sizes).alias("key"))
    many = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("m")).select("key", F.ceil(F.col("m") / chunk).cast("int").alias("slots"))
    many = write_table(many, "blocks")
    slotted = keyed.join(many, "key").withColumn("slot", F.pmod(F.xxhash64("word"), F.col("slots")).cast("int"))
    packed = slotted.groupBy("key", "slot").agg(F.collect_list(F.struct("word", "n")).alias("rows"))
    packed = write_table(packed.select("key", "slot", F.col("rows.word").alias("words"), F.col("rows.n").alias("ns")), "chunks")
    steps = F.array(*[F.array(*map(F.lit, m)) for m in _moves(classes)])
    sent = packed.select(F.col("key").alias("from"), F.col("slot").alias("from_slot"), F.explode(steps).alias("step"))
    sent = sent.withColumn("key", F.zip_with("from", "step", lambda x, s: x + s)).where(F.forall("key", lambda x: x >= 0))
    # the blocks that exist, then one row for each of their chunks: a block of many chunks is spread over all of them
    met = sent.join(many, "key").withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
    same = (F.col("key") == F.col("from")) & (F.col("slot") == F.col("from_slot"))
    met = met.where("key <> from or from_slot <= slot").withColumn("same", same)
    taker = packed.select("key", "slot", F.col("words").alias("other_words"), F.col("ns").alias("other_ns"))
    taken = F.struct("same", F.when(~F.col("same"), F.col("other_words")).otherwise(F.array(F.lit(""))).alias("other_words"), "other_ns")
    # at most one chunk of each block met comes together
    gathered = met.join(taker, ["key", "slot"]).groupBy("from", "from_slot", "slot").agg(F.collect_list(taken).alias("met"))
    sender = packed.select(F.col("key").alias("from"), F.col("slot").alias("from_slot"), "words", "ns")
    pairs = gathered.join(sender, ["from", "from_slot"])
    return pairs.select("words", "ns", "met").mapInArrow(_compare, "word string, near string, near_n long")


def spelling_variants(words: DataFrame, factor: float = 2, classes: int | None = None) -> DataFrame:
    """word, n, n_near, form, form_n, root for each row of ``words`` (columns word, n; other columns are not read).

    ``form`` is the near word of largest n (ties: smallest in code-point order), if that n is at least ``factor``
    times the word's own, else null; ``root`` is reached by following forms to the last, the word itself if it has none.
    ``factor`` must be above 1: forms then rise in n, and no chain comes back. Rows with a null or empty word or a
    null n are left out; rows of the same word are added up. No words give no rows.
    """
    if factor <= 1:
        raise ValueError("factor must be above 1")
    words = words.select("word", "n").where("word <> '' and n is not null").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    words = write_table(words, "words")
    best = near_words(words, classes).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("o"), "near")).alias("best"))
    held = words.join(best, "word", "left")
    good = -F.col("best.o") >= F.lit(factor) * F.col("n")
    judged = held.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(good, F.col("best.near")).alias("form"), F.when(good, -F.col("best.o")).alias("form_n"),
    )
    judged = write_table(judged, "forms")
    # a step follows all chains found so far at once, so chains of length d take log2(d) steps
    ends = judged.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        ends = write_table(ends.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        if ends.where("moved").isEmpty():
            break
        ends = ends.select("word", "root")
    return judged.join(ends.select("word", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))
