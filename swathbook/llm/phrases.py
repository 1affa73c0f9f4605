"""Benchmark decontamination with a stored positional inverted index.

The index is a table of postings: for each word of each chunk of documents (about 1 MiB of text, whole documents) the
ascending list of its places. A place is row << 32 | word number, where row counts the documents of the chunk; a header
row of each chunk has the documents' numbers and words. The benchmark's windows are a table too; the lists of its words
are taken out of the index once. Word counts over all documents put the words of each window in order. The lists of a window's rarest word are joined first, each place
moved back by the word's offset; they are intersected with the lists of its second word in the same chunk, and the few
that are left with the lists of all its other words. For proximity matches the lists need not be equal after the move:
all words have to lie within a span of the window's length and SLACK words more, in any order.

This module collects and broadcasts nothing by itself; the joins are on word and chunk. A word that is in very many chunks is
dealt to slots. Matches of a document depend on its words and the benchmark alone, however the documents lie in chunks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from swathbook.llm.shared import drop_tables, release, ship_package, write_table
from swathbook.llm.words import words

#: Words of a window; an item of fewer words, but not none, is one window.
WINDOW = 10
#: Extra words that a proximity match may span.
SLACK = 3
#: Lists of one word that a join task takes before the word is dealt to more slots.
LISTS_PER_SLOT = 100_000
#: Places up to which a list is searched for each of them.
FEW = 16

_LIST = pa.list_(pa.int64())


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(number, text) to rows of the index: a header and the lists of each chunk."""
    names = ["chunk", "term", "places", "numbers"]
    for batch in batches:
        numbers = batch.column(0).to_numpy(zero_copy_only=False)
        for first, hashes, bounds in words(batch.column(1)):
            count = np.diff(bounds)
            own = numbers[first : first + len(count)]
            yield pa.RecordBatch.from_arrays([pa.array(own[:1]), pa.nulls(1, pa.int64()), pa.array([count], _LIST), pa.array([own], _LIST)], names)
            if not len(hashes):
                continue
            place = (np.repeat(np.arange(len(count)), count) << 32) + np.arange(len(hashes)) - np.repeat(bounds[:-1], count)
            order = np.argsort(hashes, kind="stable")
            ordered = hashes[order]
            begin = np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1])
            offsets = pa.array(np.append(begin, len(ordered)), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(place[order], pa.int64()))
            term = pa.array(ordered[begin].view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(begin), own[0])), term, lists, pa.nulls(len(begin), _LIST)], names)


def positional_index(df: DataFrame, number: str = "number", text: str = "text") -> DataFrame:
    """The stored index of ``df``, whose column ``number`` (long, never null) tells its rows apart.

    Rows with a term (word hash) have the ascending ``places`` of the word in the chunk. One row without a term for each
    chunk has the ``numbers`` of its documents, and in ``places`` their counts of words: the document of place p is
    numbers[p >> 32]. Rows with a null text or no word are in the header, with 0 words. An empty table gives no rows.
    """
    ship_package(df.sparkSession)
    narrow = df.select(F.col(number).cast("long").alias("number"), F.col(text).alias("text"))
    return write_table(narrow.mapInArrow(_postings, "chunk long, term long, places array<long>, numbers array<long>"), "postings")


def windows_of(items: DataFrame, id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct (window, item, terms): all windows of each item. A null id counts as "null"; null texts have no windows."""
    ship_package(items.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, hashes, bounds in words(batch.column(1)):
                for i in np.flatnonzero(np.diff(bounds)):
                    own = hashes[bounds[i] : bounds[i + 1]].view(np.int64)
                    body = np.lib.stride_tricks.sliding_window_view(own, min(window, len(own)))
                    for k in range(0, len(body), 10_000):
                        part = body[k : k + 10_000]
                        offsets = pa.array(np.arange(len(part) + 1) * part.shape[1], pa.int32())
                        item = pa.array([batch.column(0)[first + int(i)].as_py()] * len(part), pa.string())
                        yield pa.RecordBatch.from_arrays([item, pa.ListArray.from_arrays(offsets, pa.array(part.ravel()))], ["item", "terms"])

    named = items.select(F.coalesce(F.col(id).cast("string"), F.lit("null")).alias("item"), F.col(text).cast("string").alias("text"))
    found = named.mapInArrow(cut, "item string, terms array<long>")
    return found.select(F.xxhash64("terms").alias("window"), "item", "terms").distinct()


def _ordered_windows(windows: DataFrame, lists: DataFrame) -> tuple[DataFrame, int]:
    """Each window all of whose words occur, with ``steps``: (n, offset, term) from its rarest word on; and the slots
    that the most frequent first word needs."""
    counts = lists.groupBy("term").agg(F.sum(F.size("places")).alias("n"), F.count(F.lit(1)).alias("n_lists"))
    bodies = windows.groupBy("window").agg(F.first("terms").alias("terms"))
    each = bodies.select("window", F.size("terms").alias("length"), F.posexplode("terms").alias("offset", "term"))
    step = F.struct("n", "offset", "term", "n_lists")
    ordered = each.join(counts, "term").groupBy("window", "length").agg(F.array_sort(F.collect_list(step)).alias("steps"))
    ordered = write_table(ordered.where(F.size("steps") == F.col("length")), "windows")
    most = ordered.agg(F.max(F.col("steps")[0]["n_lists"])).first()[0] or 0
    return ordered, int(most // LISTS_PER_SLOT) + 1


def _begun(ordered: DataFrame, lists: DataFrame, slots: int, *kept: str) -> DataFrame:
    """Lists of the rarest word of each window: window, length, steps, chunk, places, and the kept columns of ``ordered``."""
    dealt = lists.withColumn("slot", F.pmod(F.xxhash64("chunk"), F.lit(slots)))
    asked = ordered.withColumn("term", F.col("steps")[0]["term"]).withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long"))))
    return dealt.join(asked, ["term", "slot"]).select("window", "length", "steps", "chunk", "places", *kept)


def _moved(places: str, offset: Column) -> Column:
    return F.transform(places, lambda p: p - offset)


def _second(begun: DataFrame, ordered: DataFrame, lists: DataFrame, at: int) -> DataFrame:
    """Join the list of step ``at`` of each row's own chunk as ``other``; only words that are such a step are shuffled."""
    asked = ordered.where(F.size("steps") > at).select(F.col("steps")[at]["term"].alias("term")).distinct()
    other = lists.join(asked, "term", "left_semi").select("term", "chunk", F.col("places").alias("other"))
    return begun.where(F.size("steps") > at).withColumn("term", F.col("steps")[at]["term"]).join(other, ["term", "chunk"]).drop("term")


def _rest(left: DataFrame, lists: DataFrame, *kept: str) -> DataFrame:
    """For each row of ``left``, its later steps with their lists: the kept columns, step, other.

    The row's own places are kept, so that the long list of a frequent word is cut to what is near them where it is joined.
    """
    later = left.select(*kept, "chunk", F.explode(F.slice("steps", F.lit(3), F.greatest(F.size("steps") - 2, F.lit(0)))).alias("step"))
    return later.withColumn("term", F.col("step")["term"]).join(lists.select("term", "chunk", F.col("places").alias("other")), ["term", "chunk"])


def match_exact(ordered: DataFrame, lists: DataFrame, slots: int = 1) -> DataFrame:
    """window, length, chunk, place of the first word, of every occurrence of a window, each once.

    Lists are joined without their window's later steps, which come back by window where they are needed, and never by
    sending candidates through the driver. Where few places are left, the list of a later word is only searched for
    each of them; where many are, it is intersected.
    """
    first, second = F.col("steps")[0], F.coalesce(F.get("steps", F.lit(1)), F.col("steps")[0])
    narrow = ordered.select("window", "length", F.array(first).alias("steps"), second["term"].alias("second"), second["offset"].alias("offset"))
    begun = _begun(narrow, lists, slots, "second", "offset").withColumn("places", _moved("places", first["offset"]))
    begun = begun.select("window", "length", "chunk", "places", F.col("second").alias("term"), "offset")
    other = lists.join(narrow.select(F.col("second").alias("term")).distinct(), "term", "left_semi").select("term", "chunk", F.col("places").alias("other"))
    # a window of one word meets its own list here, which leaves it as it is
    both = begun.join(other.hint("merge"), ["term", "chunk"])
    both = both.select("window", "length", "chunk", F.array_intersect("places", _moved("other", F.col("offset"))).alias("places"))
    both = write_table(both.where(F.size("places") > 0), "pairs_of_words")
    del begun, other
    release(both.sparkSession)
    later = ordered.where("length > 2").select("window", F.explode(F.slice("steps", F.lit(3), F.col("length") - 2)).alias("step"))
    left = both.where("length > 2").join(later.select("window", "step.term", "step.offset"), "window")
    each = left.join(lists.select("term", "chunk", F.col("places").alias("other")).hint("merge"), ["term", "chunk"])
    met = F.when(F.size("places") > FEW, F.array_intersect("places", _moved("other", F.col("offset")))).otherwise(F.col("places"))
    each = each.select("window", "length", "chunk", (F.size("places") > FEW).alias("known"), "other", "offset", F.explode(met).alias("place"))
    each = each.where(F.col("known") | F.array_contains("other", F.col("place") + F.col("offset")))
    whole = each.groupBy("window", "length", "chunk", "place").agg(F.count(F.lit(1)).alias("met")).where("met = length - 2")
    columns = ["window", "length", "chunk", "place"]
    short = both.where("length <= 2").select("window", "length", "chunk", F.explode("places").alias("place"))
    return short.select(columns).unionByName(whole.select(columns))


def _beside(places: pa.Array, other: pa.Array, reach: pa.Array) -> pa.Array:
    """The places that have one of ``other`` at most ``reach`` words away."""
    out = []
    for a, b, r in zip(places, other, reach.to_pylist(), strict=True):
        a, b = a.values.to_numpy(), b.values.to_numpy()
        after = np.searchsorted(b, a)
        ok = (after < len(b)) & (b[np.minimum(after, len(b) - 1)] - a <= r)
        ok |= (after > 0) & (a - b[np.maximum(after - 1, 0)] <= r)
        out.append(a[ok])
    return pa.array(out, _LIST)


def _close(lists: pa.Array, reach: pa.Array) -> pa.Array:
    """Ends of spans of at most reach + 1 words that have a place of each list."""
    out = []
    for row, r in zip(lists, reach.to_pylist(), strict=True):
        each = [x.values.to_numpy() for x in row]
        if not all(map(len, each)):
            out.append(each[0][:0])
            continue
        ends = np.unique(np.concatenate(each))
        begin = ends.copy()
        for one in each:
            at = np.searchsorted(one, ends, "right") - 1
            begin = np.minimum(begin, np.where(at >= 0, one[np.maximum(at, 0)], ends - r - 1))
        out.append(ends[ends - begin <= r])
    return pa.array(out, _LIST)


def match_near(ordered: DataFrame, lists: DataFrame, slots: int = 1, slack: int = SLACK) -> DataFrame:
    """window, chunk, place of the last word, where all words of a window lie within length + slack words in any order.

    A word that the window has twice may occur once. Exact occurrences are such places too.
    """
    distinct = F.filter("steps", lambda s, i: (i == 0) | ~F.exists(F.slice("steps", F.lit(1), i), lambda e: e["term"] == s["term"]))
    ordered = ordered.withColumn("steps", distinct)
    begun = _begun(ordered, lists, slots).withColumn("reach", F.col("length") + F.lit(slack - 1))
    single = begun.where(F.size("steps") == 1)
    both = _second(begun, ordered, lists, 1).withColumn("near", F.arrow_udf(_beside, "array<long>")("places", "other", "reach")).where(F.size("near") > 0)
    both = write_table(both.select("window", "chunk", "reach", "steps", F.col("near").alias("places"), "other").withColumn("pair", F.xxhash64("window", "chunk")), "near_words")
    beside = F.arrow_udf(_beside, "array<long>")("other", "places", "reach")
    own = both.select("pair", F.col("places").alias("list")).unionByName(both.select("pair", beside.alias("list")))
    rest = _rest(both, lists, "pair", "places", "reach").select("pair", beside.alias("list"))
    groups = own.unionByName(rest).groupBy("pair").agg(F.collect_list("list").alias("found"))
    groups = groups.join(both.select("pair", "window", "chunk", "reach", "steps"), "pair").where(F.size("found") == F.size("steps"))
    ends = F.arrow_udf(_close, "array<long>")("found", "reach")
    columns = ["window", "chunk", "place"]
    found = groups.select("window", "chunk", F.explode(ends).alias("place"))
    return single.select("window", "chunk", F.explode("places").alias("place")).unionByName(found).select(columns)


def _in_documents(found: DataFrame, headers: DataFrame) -> DataFrame:
    """Add number (the document's) and first (the word's number in it) to places of chunks."""
    placed = found.join(headers.select("chunk", "numbers"), "chunk")
    row, first = F.shiftright("place", 32).cast("int"), F.col("place").bitwiseAND(F.lit(0xFFFFFFFF))
    return placed.withColumn("number", F.col("numbers")[row]).withColumn("first", first).drop("numbers", "chunk", "place")


def _items_of(found: DataFrame, windows: DataFrame, name: str) -> DataFrame:
    """Items of the windows found in each document, as strings in ascending order, each once."""
    pairs = found.select("number", "window").distinct().join(windows.select("window", "item"), "window")
    return pairs.select("number", "item").distinct().groupBy("number").agg(F.array_sort(F.collect_list("item")).alias(name))


def _spans_of(found: DataFrame) -> DataFrame:
    """Union of each document's stretches of words, as disjoint stretches in order."""
    ends = found.groupBy("number", "first").agg(F.max(F.col("first") + F.col("length") - 1).alias("last"))
    order = W.partitionBy("number").orderBy("first")
    top = F.max("last").over(order.rowsBetween(W.unboundedPreceding, -1))
    new = F.when(F.col("first") > F.coalesce(top, F.lit(-2)) + 1, 1).otherwise(0)
    runs = ends.withColumn("new", new).withColumn("run", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    spans = runs.groupBy("number", "run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return spans.groupBy("number").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("spans"))


def phrase_matches(df: DataFrame, items: DataFrame, id: str = "item_id", text: str = "text", item_text: str = "text", near: bool = True, window: int = WINDOW) -> DataFrame:
    """``df`` and a column ``phrase_hits``: n_words, spans, items, near_items.

    spans are the stretches of words (numbered from 0, both ends) inside an exact occurrence of a window of any item;
    items are the ids (as strings, in ascending order, each once) of items that have one, near_items of those whose
    window has all its words close together in any order (see ``match_near``; empty without ``near``). Null texts and
    texts without a word have no words and no matches; such items have no windows. An item id that is null counts as an
    item named "null"; repeated items count once, repeated rows of ``df`` each have their hits. An empty table on either
    side gives no matches. ``df`` may have any other columns, ``phrase_hits`` alone is replaced.
    """
    kept = [c for c in df.columns if c != "phrase_hits"]
    numbered = write_table(df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.monotonically_increasing_id().alias("number")), "numbered")
    index = positional_index(numbered, "number", f"row.{text}")
    windows = write_table(windows_of(items, id, item_text, window), "items")
    asked = write_table(windows.select(F.explode("terms").alias("term")).distinct(), "terms")
    headers = write_table(index.where("numbers is not null"), "headers")
    lists = write_table(index.where("term is not null").join(asked, "term", "left_semi").select("term", "chunk", "places"), "lists")
    drop_tables(index)
    ordered, slots = _ordered_windows(windows, lists)
    exact = write_table(_in_documents(match_exact(ordered, lists, slots), headers), "exact")
    counts = headers.select(F.explode(F.arrays_zip("numbers", F.col("places").alias("n_words"))).alias("d")).select("d.numbers", "d.n_words")
    hits = counts.withColumnRenamed("numbers", "number").join(_spans_of(exact), "number", "left").join(_items_of(exact, windows, "items"), "number", "left")
    if near:
        hits = hits.join(_items_of(_in_documents(match_near(ordered, lists, slots), headers), windows, "near_items"), "number", "left")
    none = F.array().cast("array<string>")
    near_items = F.coalesce("near_items", none) if near else none
    spans = F.coalesce("spans", F.array().cast("array<struct<first:bigint,last:bigint>>"))
    packed = F.struct("n_words", spans.alias("spans"), F.coalesce("items", none).alias("items"), near_items.alias("near_items"))
    hits = write_table(hits.select("number", packed.alias("phrase_hits")), "hits")
    drop_tables(headers, lists, exact, ordered, asked, windows)
    return numbered.join(hits, "number").select("row.*", "phrase_hits")


def hit_words(spans: str = "phrase_hits.spans") -> Column:
    """Number of words inside the spans, which are disjoint."""
    return F.aggregate(F.col(spans), F.lit(0).cast("long"), lambda n, x: n + x["last"] - x["first"] + 1)


def item_digest(ids: list[str]) -> str:
    """SHA-256 of sorted ids, as the registered query gives it."""
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
