"""Near-duplicate lines: MinHash signatures of character shingles, banding, exact Jaccard check, union-find.

A line's shingles are all its runs of WIDTH characters (a shorter line is one shingle), upper and lower case apart.
One hash of each shingle fills one of BINS bins; a bin keeps its smallest hash, an empty bin takes that of the next
filled one. Two lines agree in a bin with a probability equal to their Jaccard similarity s, so that BANDS bands of
ROWS bins bring them together with probability 1 - (1 - s ** ROWS) ** BANDS, which is 0.9998 at s = 0.8.

With a ``fine`` width, pairs of lines of at most SHORT characters are also near if their shingles of that width reach
the threshold: one edit in a short line changes too large a part of its WIDTH-character shingles. Short lines get
FINE_BANDS bands of FINE_ROWS bins more for that (0.999 at s = 0.8); short shingles are shared by unrelated lines, too,
so a band has more bins.

Signatures and the exact check run as Arrow functions on batches. A form with SQL functions only needs a hash of each
shingle in the plan: README.md has the figures that speak against it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swathbook.llm.components import crowded_once, linked
from swathbook.llm.shared import drop_tables, release, ship_package, write_table
from swathbook.llm.words import mix64

WIDTH = 8
THRESHOLD = 0.8
BINS, BANDS, ROWS = 64, 16, 4
#: Width for short lines as the registered query uses it, and the characters up to which a line is short.
FINE, SHORT = 3, 100
FINE_BANDS, FINE_ROWS = 40, 8
#: Characters hashed at once (so that a worker's arrays stay in its cache), and rows of crowded lines up to which they are broadcast.
CHUNK, BROADCAST_ROWS = 1 << 16, 1_000_000
#: Factor of the rolled sums, and pairs verified at once.
BASE, PAIRS = 0x2545F4914F6CDD1D, 1 << 12
#: Bits of a line's sketch, and pairs for each row of a bucket up to which they are tried at once: sketches rule out most.
SKETCH, AT_ONCE = 512, 8


def line_shingles(lines: list[str], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all lines, one after the other, and the bounds of each line's (an empty line has none)."""
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    length = np.fromiter(map(len, lines), np.int64, len(lines))
    bounds = np.concatenate([[0], np.cumsum(np.where(length == 0, 0, np.maximum(length - width + 1, 1)))])
    short = length < width
    if not short.any():
        return _rolled(codes, length, width), bounds
    of_short, code_of_short = np.repeat(short, np.diff(bounds)), np.repeat(short, length)
    out = np.empty(bounds[-1], np.uint64)
    out[~of_short] = _rolled(codes[~code_of_short], length[~short], width)
    # a shorter line is one shingle
    size, codes = length[short & (length > 0)], codes[code_of_short]
    first, sums = np.cumsum(size) - size, size.astype(np.uint64)
    for i in range(width if len(size) else 0):
        sums = np.where(i < size, sums * np.uint64(BASE) + codes[np.minimum(first + i, len(codes) - 1)], sums)
    out[of_short] = mix64(sums)
    return out, bounds


def _rolled(codes: np.ndarray, length: np.ndarray, width: int) -> np.ndarray:
    """Hashes of lines of at least ``width`` characters: sums are rolled over the characters of all, those across the end of a line dropped."""
    if not len(codes):
        return codes
    inside = np.ones(len(codes) - width + 1, bool)
    over = (np.cumsum(length)[:-1, None] - np.arange(1, width)).ravel()
    inside[over] = False
    base, done = np.uint64(BASE), 1
    sums = codes
    while 2 * done <= width:
        sums = sums[:-done] * np.uint64(pow(BASE, done, 1 << 64)) + sums[done:]
        done *= 2
    for i in range(done, width):
        sums = sums[:-1] * base + codes[i:]
    return mix64(sums[inside] + np.uint64(width * pow(BASE, width, 1 << 64) % (1 << 64)))


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """BINS minima of each line; all lines have a shingle."""
    lines = len(bounds) - 1
    row = np.repeat(np.arange(0, lines * BINS, BINS), np.diff(bounds))
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(lines * BINS, empty, np.uint64)
    np.minimum.at(out, row + (hashes >> np.uint64(58)).astype(np.int64), hashes)
    out = out.reshape(lines, BINS)
    # the place of the next filled bin, going round once
    place = np.where(out == empty, 2 * BINS, np.arange(BINS))
    place = np.concatenate([place, np.minimum(place + BINS, 2 * BINS)], 1)[:, ::-1]
    place = np.minimum.accumulate(place, 1)[:, ::-1][:, :BINS] % BINS
    return np.take_along_axis(out, place, 1)


def bands_of(lines: list[str]) -> np.ndarray:
    hashes, bounds = line_shingles(lines)
    bins = signatures(hashes, bounds).reshape(len(lines), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(lines), BANDS)).copy()
    for i in range(ROWS):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + bins[:, :, i])
    return key.view(np.int64)


def fine_bands_of(lines: list[str], width: int) -> np.ndarray:
    """Bands of short lines: each of their minima is over all shingles, by an order of its own (xor, odd factor, high bits first)."""
    hashes, bounds = line_shingles(lines, width)
    count = np.diff(bounds)
    place = np.arange(count.max())[:, None]
    grid = (hashes >> np.uint64(32)).astype(np.uint32)[np.where(place < count, place, 0) + bounds[:-1]]
    seeds = (mix64(np.arange(1, 2 * FINE_BANDS * FINE_ROWS + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32).reshape(FINE_BANDS, FINE_ROWS, 2)
    key, order = np.empty((len(lines), FINE_BANDS), np.uint64), np.empty_like(grid)
    for band in range(FINE_BANDS):
        own = np.full(len(lines), band + BANDS + 1, np.uint64)
        for mask, factor in seeds[band]:
            np.multiply(np.bitwise_xor(grid, mask, out=order), factor | np.uint32(1), out=order)
            own = mix64(own * np.uint64(0x9E3779B97F4A7C15) + order.min(axis=0))
        key[:, band] = own
    return key.view(np.int64)


def _groups(lines: list[str]) -> Iterator[tuple[int, int]]:
    begin, size = 0, 0
    for i, line in enumerate(lines):
        taken = max(len(line), BINS)
        if size and size + taken > CHUNK:
            yield begin, i
            begin, size = i, 0
        size += taken
    if begin < len(lines):
        yield begin, len(lines)


def _bands(fine: int | None = None):
    """Bands of each line: BANDS, or with ``fine`` the FINE_BANDS of (short) lines."""
    count = BANDS if fine is None else FINE_BANDS

    def run(lines: pa.Array) -> pa.Array:
        texts = lines.to_pylist()
        flat = np.empty((len(texts), count), np.int64)
        for begin, end in _groups(texts):
            flat[begin:end] = bands_of(texts[begin:end]) if fine is None else fine_bands_of(texts[begin:end], fine)
        bounds = np.arange(len(texts) + 1, dtype=np.int32) * np.int32(count)
        return pa.ListArray.from_arrays(bounds, pa.array(flat.ravel())).cast(pa.list_(pa.int64()))

    return run


def _buckets(distinct: DataFrame, fine: int | None) -> DataFrame:
    """Rows (node, key) of lines (node, line) that share a band; both kinds of bands have keys of their own and are shuffled one after the other."""
    keys = lambda lines, bands: F.explode(F.arrow_udf(bands, "array<long>")(lines["line"])).alias("key")
    coarse = crowded_once(distinct.select("node", keys(distinct, _bands())))
    if fine is None:
        return coarse
    release(distinct.sparkSession)
    short = distinct.where(F.char_length("line") <= SHORT)
    fines = crowded_once(short.select("node", keys(short, _bands(fine))))
    found = write_table(coarse.unionByName(fines), "buckets")
    drop_tables(coarse, fines)
    return found


def _distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)]]


def odd_sketches(lines: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of distinct shingles of each line (fewer than PAIRS lines), and SKETCH bits of each: a bit tells whether an odd number of them falls on it.

    The bits in which two lines differ are never more than the shingles that only one of them has.
    """
    hashes, bounds = line_shingles(lines, width)
    row = np.repeat(np.arange(len(lines), dtype=np.uint64), np.diff(bounds))
    keys = _distinct(row << np.uint64(52) | hashes >> np.uint64(12))
    row, hashes = (keys >> np.uint64(52)).astype(np.int64), keys
    odd = np.bincount(row * SKETCH + (hashes % np.uint64(SKETCH)).astype(np.int64), minlength=len(lines) * SKETCH) & 1
    words = np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64).reshape(len(lines), SKETCH // 64)
    return np.bincount(row, minlength=len(lines)), words


def _sketches(fine: int | None):
    """Rows (node, short, n, w0 to w7 and, with ``fine``, m, v0 to v7) for rows (node, line)."""
    widths = [("n", "w", WIDTH)] + ([] if fine is None else [("m", "v", fine)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, node = batch.column("line").to_pylist(), batch.column("node")
            for begin, end in _groups(lines):
                part = lines[begin:end]
                out = {"node": node.slice(begin, end - begin), "short": pa.array([len(line) <= SHORT for line in part])}
                for size, word, width in widths:
                    count, words = odd_sketches(part, width)
                    out[size] = pa.array(count.astype(np.int64))
                    out |= {f"{word}{i}": pa.array(np.ascontiguousarray(words[:, i])) for i in range(words.shape[1])}
                yield pa.RecordBatch.from_pydict(out)

    names = [name for size, word, _ in widths for name in [size, *(f"{word}{i}" for i in range(SKETCH // 64))]]
    return run, "node long, short boolean, " + ", ".join(f"{name} long" for name in names)


def _may_hold(threshold: float, fine: int | None) -> Column:
    """Whether the sketches of two lines, in columns ending in _a and _b, leave room for the threshold: no pair that holds is left out.

    With d shingles that only one of the lines has, the similarity is (n - d) / (n + d) for n shingles of both lines together.
    """

    def room(size: str, word: str) -> Column:
        differ = sum((F.bit_count(F.col(f"{word}{i}_a").bitwiseXOR(F.col(f"{word}{i}_b"))) for i in range(SKETCH // 64)), F.lit(0))
        apart = F.greatest(differ, F.abs(F.col(f"{size}_a") - F.col(f"{size}_b")))
        both = F.col(f"{size}_a") + F.col(f"{size}_b")
        return both - apart >= threshold * (both + apart) - 1e-6

    return room("n", "w") if fine is None else room("n", "w") | (F.col("short_a") & F.col("short_b") & room("m", "v"))


def _near(one: list[str], two: list[str], threshold: float, width: int) -> np.ndarray:
    """Which pairs of lines reach the threshold; at most PAIRS, whose number stands in the first bits of their shingles."""
    hashes, bounds = line_shingles(one + two, width)
    pair = np.repeat(np.tile(np.arange(len(one), dtype=np.uint64), 2), np.diff(bounds))
    keys = pair << np.uint64(52) | hashes >> np.uint64(12)
    keys = keys & ~np.uint64(1)
    keys[bounds[len(one)] :] += np.uint64(1)  # the last bit tells the second line's from the first's
    keys = _distinct(keys)
    count = lambda x: np.bincount((x >> np.uint64(52)).astype(np.int64), minlength=len(one))
    both = count(keys[1:][(keys[1:] ^ keys[:-1]) == 1])
    return both >= threshold * (count(keys) - both)


def _holds(threshold: float, fine: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = batch.column("line_a").to_pylist(), batch.column("line_b").to_pylist()
            keep, begin = np.zeros(len(one), bool), 0
            while begin < len(one):
                end, size = begin, 0
                while end < len(one) and end - begin < PAIRS and (end == begin or size < 2 * CHUNK):
                    size += len(one[end]) + len(two[end])
                    end += 1
                keep[begin:end] = _near(one[begin:end], two[begin:end], threshold, WIDTH)
                left = [] if fine is None else [i for i in range(begin, end) if not keep[i] and max(len(one[i]), len(two[i])) <= SHORT]
                if left:
                    keep[left] = _near([one[i] for i in left], [two[i] for i in left], threshold, fine)
                begin = end
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def line_rows(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, text_key (hash of the text), line_no (from 0), line and line_key (its hash, 16 bytes) of each line of each text."""
    split = F.posexplode(F.split(F.col(text), "\n", -1))
    lines = df.select(F.col(id).alias("id"), text_key(text).alias("text_key"), split.alias("line_no", "line"))
    return lines.withColumn("line_key", line_key())


def line_key() -> Column:
    return F.unhex(F.md5("line"))


def text_key(text: str) -> Column:
    """With its id, what tells a document's rows from others; of rows alike in both, all lines are kept or dropped alike."""
    return F.xxhash64(text)


def line_classes(df: DataFrame, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, fine: int | None = None) -> DataFrame:
    """The lines that are not empty and have more than one place, or are near an earlier line.

    line_key, first (the first place of the line: id, line_no) and class_line (the line kept for it, null if it is that
    itself). Texts are shuffled once, to find the distinct lines, and only lines that share a band are read again; all
    else goes by the lines' hashes. A pair of lines is compared by sketches, and by its shingles where these leave room.
    """
    spark = df.sparkSession
    ship_package(spark)
    places = line_rows(df, id, text).where("line <> ''").groupBy("line").agg(F.min(F.struct("id", "line_no")).alias("first"), F.count(F.lit(1)).alias("places"))
    distinct = write_table(places.withColumn("node", F.monotonically_increasing_id()), "lines")
    release(spark)
    buckets = _buckets(distinct, fine)
    release(spark)
    wanted = write_table(buckets.select("node").distinct(), "wanted")
    wide = wanted.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS
    texts = write_table(distinct.join(wanted if wide else F.broadcast(wanted), "node", "left_semi").select("node", "line", "first"), "texts")
    firsts = write_table(distinct.where("places > 1").select(line_key().alias("line_key"), "first"), "firsts")
    drop_tables(distinct, wanted)
    release(spark)
    run, schema = _sketches(fine)
    sketches = write_table(texts.select("node", "line").mapInArrow(run, schema), "sketches")

    def verify(pairs: DataFrame) -> DataFrame:
        of = lambda table, side: table.select(*[F.col(c).alias(side if c == "node" else f"{c}_{side}") for c in table.columns])
        likely = pairs.join(of(sketches, "a"), "a").join(of(sketches, "b"), "b").where(_may_hold(threshold, fine)).select("a", "b")
        lines = texts.select("node", "line")
        return likely.join(of(lines, "a"), "a").join(of(lines, "b"), "b").select("a", "b", "line_a", "line_b").mapInArrow(_holds(threshold, fine), "a long, b long")

    roots = linked(buckets, verify, at_once=AT_ONCE)
    member = texts.join(roots, "node")
    heads = member.groupBy("root").agg(F.min(F.struct("first", "line")).alias("head"))
    moved = member.join(heads, "root").where("line <> head.line").select(line_key().alias("line_key"), "first", F.col("head.line").alias("class_line"))
    moved = write_table(moved, "moved")
    drop_tables(buckets, texts, sketches, roots)
    release(spark)
    alone = firsts.join(moved, "line_key", "left_anti").withColumn("class_line", F.lit(None).cast("string"))
    return moved.unionByName(alone)


def near_lines(df: DataFrame, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, fine: int | None = None) -> DataFrame:
    """One row for each line of each text: id, line_no (from 0), line, class_line (the line kept for it), kept.

    Lines are what newline characters separate. Of the lines of a component, the first by (id, line_no, line) stays;
    an id that is null sorts first. An empty line is kept always and is a class of its own. Repeated rows (same id,
    line_no and line) are kept or dropped alike. ``fine`` is the width of the shingles that short lines are compared by too. A null text has no line; an empty table gives no rows. Other columns
    of ``df`` are not read.
    """
    classes = line_classes(df, id, text, threshold, fine)
    lines = line_rows(df, id, text)
    full = lines.where("line <> ''").join(classes, "line_key", "left")
    full = full.select("id", "line_no", "line", F.coalesce("class_line", "line").alias("class_line"), (~_goes()).alias("kept"))
    empty = lines.where("line = ''").select("id", "line_no", "line", F.col("line").alias("class_line"), F.lit(True).alias("kept"))
    return full.unionByName(empty).withColumnRenamed("id", id)


def lines_gone(df: DataFrame, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, fine: int | None = None) -> DataFrame:
    """The lines that ``near_lines`` does not keep, by document: id, text_key, gone (their line_no, ascending, each once).

    Documents that keep all their lines are absent. No text is shuffled for it but by ``line_classes``.
    """
    classes = line_classes(df, id, text, threshold, fine).select("line_key", "first", F.when(F.col("class_line").isNotNull(), "").alias("class_line"))
    full = line_rows(df, id, text).where("line <> ''").drop("line").join(classes, "line_key")
    gone = full.where(_goes()).groupBy("id", "text_key").agg(F.sort_array(F.collect_set("line_no")).alias("gone"))
    gone = write_table(gone, "gone")  # the shuffle of all lines' hashes is over before that of the texts begins
    release(df.sparkSession)
    return gone.withColumnRenamed("id", id)


def _goes() -> Column:
    """Whether a line at (id, line_no) goes; lines without a first place are those with one place and no earlier near line."""
    here = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("line_no") == F.col("first.line_no"))
    return F.col("first").isNotNull() & (F.col("class_line").isNotNull() | ~here)
