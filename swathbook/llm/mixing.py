"""Mixing sources to target weights by a low-discrepancy schedule. DataFrame and SQL functions only.

Slot i of the mix has the point frac((i + 1) * golden ratio); laid over the cumulative shares of the sources it names
the slot's source, and a slot's rank among those of its source names the block it takes. A source's documents, in an
order given by a hash of their id, form a stream of words that is read up to REPEATS times and cut into blocks of
BLOCK words. The schedule deviates from the target shares by a few slots at most; slots past a source's target are
void, and where the schedule gave a source too few, closing slots follow at the end, so that the words taken are the
target, rounded to a whole number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from swathbook.llm.shared import write_table

#: Words of a block.
BLOCK = 256
#: A source gives at most so many times its size.
REPEATS = 2
#: Share of all words that the mix takes.
VOLUME = 1.5
#: Weights of the sources in order, repeating.
WEIGHTS = (3.0, 1.0, 2.0)
#: Rows of one source that are numbered in one task, on average.
BUCKET_ROWS = 50_000
#: Fractional part of the golden ratio times 2 ** 31, an integer so that points are exact.
GOLDEN = 1_327_217_885


def word_count(text: str):
    """Number of runs without white space (space, and code points 9 to 13); 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, volume: float = VOLUME, repeats: int = REPEATS) -> DataFrame:
    """source, source_size, weight, target from the rows (source, source_size).

    Sources are ordered by code point, null last, and take the weights in turn. The target is the weight's share of
    ``volume`` times all words; none exceeds ``repeats`` times its size, and what it leaves is shared again by weight.
    That is the level L at which the sum of min(repeats * size, L * weight) is the whole: with the sources in the order
    of repeats * size / weight, those before the level are full and the rest share what remains. The windows run over
    one row for each source.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    listed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    listed = listed.withColumn("cap", F.col("source_size") * F.lit(float(repeats)))
    by_level = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier, later = by_level.rowsBetween(W.unboundedPreceding, -1), by_level.rowsBetween(0, W.unboundedFollowing)
    whole = F.sum("source_size").over(W.partitionBy(F.lit(1))) * F.lit(float(volume))
    level = (whole - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))) / F.sum("weight").over(later)
    found = listed.withColumn("level", level).withColumn("open", F.col("level") * F.col("weight") <= F.col("cap"))
    first = F.min(F.struct(F.when(F.col("open"), F.col("cap") / F.col("weight")).alias("at"), F.col("level").alias("l")))
    share = found.where("open").agg(first.alias("f")).select(F.col("f.l").alias("share"))
    return found.join(F.broadcast(share), how="left").select(
        "source", "source_size", "weight", F.least("cap", F.coalesce(F.col("share") * F.col("weight"), F.col("cap"))).alias("target")
    )


def schedule(targets: DataFrame, block: int = BLOCK, partitions: int | None = None) -> DataFrame:
    """slot (from 0), source, rank (from 0), words: the slots that are not void, in mixing order.

    The table of sources is written, so that Spark broadcasts it where its measured size allows.
    """
    spark = targets.sparkSession
    spans = targets.where("target >= 0.5").withColumn("quota", F.round("target").cast("long"))
    upto = W.orderBy(F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, 0)
    whole = F.sum("quota").over(W.partitionBy(F.lit(1)))
    high = F.round(F.sum("quota").over(upto) / whole * float(1 << 31)).cast("long")
    spans = spans.select("source", "quota", high.alias("high"), whole.alias("whole"))
    spans = spans.withColumn("low", F.coalesce(F.lag("high").over(W.orderBy("high", F.col("source").asc_nulls_last())), F.lit(0)))
    spans = write_table(spans, "spans")
    total = spans.agg(F.max("whole")).first()[0] or 0
    slots = -(-total // block)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    point = F.pmod((F.col("id") + 1) * F.lit(GOLDEN), F.lit(1 << 31))
    # points are matched to spans through 4096 equal cells, so that the join is on equal keys
    cell = F.explode(F.sequence(F.shiftright("low", 19), F.shiftright(F.greatest(F.col("high") - 1, F.col("low")), 19)))
    cells = spans.where("high > low").select("source", "low", "high", cell.alias("cell"))
    drawn = spark.range(0, slots, 1, n).select(F.col("id").alias("slot"), point.alias("point"))
    drawn = drawn.withColumn("cell", F.shiftright("point", 19)).join(cells, "cell").where("point >= low and point < high")
    drawn = drawn.select("slot", "source", F.floor(F.col("slot") / BUCKET_ROWS).alias("stretch"))
    drawn = write_table(drawn, "slots")
    counts = drawn.groupBy("source", "stretch").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("source").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn("earlier", F.coalesce(F.sum("n").over(before), F.lit(0)))
    inside = F.row_number().over(W.partitionBy("source", "stretch").orderBy("slot")) - 1
    same = [F.col("l.source").eqNullSafe(F.col("r.source")), F.col("l.stretch") == F.col("r.stretch")]
    ranked = drawn.withColumn("inside", inside).alias("l").join(counts.alias("r"), same[0] & same[1])
    ranked = ranked.select(F.col("l.source").alias("source"), "slot", (F.col("earlier") + F.col("inside")).alias("rank"))
    got = counts.groupBy("source").agg(F.sum("n").alias("got"))
    closing = spans.alias("l").join(got.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source")), "left")
    missing = F.ceil(F.col("quota") / block) - F.coalesce("got", F.lit(0))
    closing = closing.select(F.col("l.source").alias("source"), F.coalesce("got", F.lit(0)).alias("got"), missing.alias("missing")).where("missing > 0")
    closing = closing.withColumn("before", F.coalesce(F.sum("missing").over(W.orderBy(F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    extra = closing.select("source", "got", "before", F.explode(F.sequence(F.lit(0).cast("long"), F.col("missing") - 1)).alias("k"))
    extra = extra.select("source", (F.lit(slots) + F.col("before") + F.col("k")).alias("slot"), (F.col("got") + F.col("k")).alias("rank"))
    every = ranked.unionByName(extra).alias("l").join(spans.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source")))
    words = F.least(F.lit(block), F.col("quota") - F.col("rank") * block)
    return every.select("slot", F.col("l.source").alias("source"), F.col("rank").cast("long").alias("rank"), words.cast("long").alias("words")).where("words > 0")


def streams(docs: DataFrame) -> DataFrame:
    """Add ``begin`` (words of the source before the document) to the rows (id, source, size).

    A source's order is by the MD5 of the id. Rows are numbered inside buckets of that hash, whose sums give the
    words before a bucket, so that a source of any size is spread over many tasks.
    """
    rows = docs.count()
    buckets = max(1, -(-rows // BUCKET_ROWS))
    key = F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")))
    bucket = F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * F.lit(buckets) / F.lit(1 << 32))
    keyed = docs.withColumn("order", key).withColumn("bucket", bucket)
    sums = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("earlier", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)))
    inside = F.sum("size").over(W.partitionBy("source", "bucket").orderBy("order", "id", "size", "row").rowsBetween(W.unboundedPreceding, 0))
    same = F.col("l.source").eqNullSafe(F.col("r.source")) & (F.col("l.bucket") == F.col("r.bucket"))
    both = keyed.withColumn("upto", inside).alias("l").join(sums.alias("r"), same)
    return both.select("row", "id", F.col("l.source").alias("source"), "size", (F.col("earlier") + F.col("upto") - F.col("size")).cast("long").alias("begin"))


def mix(df: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[float, ...] = WEIGHTS, volume: float = VOLUME, repeats: int = REPEATS, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(documents, pieces) of the mix.

    documents: one row for each row of ``df`` with row (its number), id, source, size, source_size, target, taken.
    pieces, in mixing order by (slot, first): slot, row, id, source, turn (0: first reading), first, last: words first
    to last - 1 of the document go into the slot. taken is the number of words in a row's pieces. A null source is a
    source of its own, last in order. Null and empty texts have size 0 and no pieces. Repeated rows are each read. An
    empty table gives no rows. Other columns are not read.
    """
    sized = df.select(F.col(id).alias("id"), F.col(source).alias("source"), word_count(text).alias("size"))
    sized = write_table(sized.withColumn("row", F.monotonically_increasing_id()), "sizes")
    targets = write_table(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, volume, repeats), "targets")
    placed = streams(sized.where("size > 0"))
    placed = placed.alias("l").join(targets.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source")))
    turn = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    read = placed.select("row", "id", F.col("l.source").alias("source"), "size", "begin", "source_size", "target", turn.alias("turn"))
    read = read.withColumn("begin", F.col("begin") + F.col("turn") * F.col("source_size")).where("begin < round(target)")
    rank = F.explode(F.sequence(F.floor(F.col("begin") / block), F.floor((F.col("begin") + F.col("size") - 1) / block)))
    cut = read.select("row", "id", "source", "turn", "begin", "size", rank.alias("rank"))
    slots = schedule(targets, block)
    same = F.col("l.source").eqNullSafe(F.col("r.source")) & (F.col("l.rank") == F.col("r.rank"))
    both = cut.alias("l").join(slots.alias("r"), same)
    low = F.greatest(F.col("begin"), F.col("l.rank") * block) - F.col("begin")
    high = F.least(F.col("begin") + F.col("size"), F.col("l.rank") * block + F.col("words")) - F.col("begin")
    pieces = both.select("slot", "row", "id", F.col("l.source").alias("source"), "turn", low.alias("first"), high.alias("last")).where("last > first")
    taken = pieces.groupBy("row").agg(F.sum(F.col("last") - F.col("first")).alias("taken"))
    documents = sized.join(taken, "row", "left").alias("l").join(targets.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source")))
    documents = documents.select(
        "row", "id", F.col("l.source").alias("source"), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )
    return documents, pieces
