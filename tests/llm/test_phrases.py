"""The positional index and its exact and proximity matches against brute force."""

import random
import re

import pytest

from swathbook.llm import phrases

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def windows(text):
    own = split(text)
    size = min(phrases.WINDOW, len(own))
    return {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if size else set()


def brute(text, items):
    """n_words, words hit, items, near items of one text."""
    own = split(text)
    hit, exact, near = set(), set(), set()
    for item, item_text in items:
        name = "null" if item is None else str(item)
        for w in windows(item_text):
            for i in range(len(own) - len(w) + 1):
                if tuple(own[i : i + len(w)]) == w:
                    hit |= set(range(i, i + len(w)))
                    exact.add(name)
            if any(set(w) <= set(own[i : i + len(w) + phrases.SLACK]) for i in range(len(own))):
                near.add(name)
    return len(own), sorted(hit), sorted(exact), sorted(near)


@pytest.fixture(scope="module")
def rows():
    """Texts of few words, so that chance, repeated and overlapping matches are many; pieces of items, in order and shuffled."""
    rnd = random.Random(11)
    word = lambda: rnd.choice("a b c d e f g h B é 7 the".split())
    items = [(k, " ".join(word() for _ in range(rnd.choice([1, 2, 3, 4, 9, 10, 11, 25])))) for k in range(20)]
    items += [(3, items[5][1]), items[5], (None, "the end"), (50, None), (51, ""), (52, "--"), (53, "a a"), (54, "zebra"), (55, "a b zebra")]
    texts = [None, "", "!", "zebra", "a", "a a", "a b zebra", "The END", "the x y z end", "the x y z w v end"]
    for _ in range(80):
        piece = rnd.choice(items[:20])[1].split()
        if rnd.random() < 0.5:
            rnd.shuffle(piece)
        texts.append(", ".join([word() for _ in range(rnd.randrange(30))] + piece + [word() for _ in range(rnd.randrange(30))]))
    return [(k, t) for k, t in enumerate(texts)] + [(3, "zebra"), (None, "zebra"), (None, None)], items


@pytest.mark.parametrize("parts", [1, 7])
def test_matches_equal_brute_force_however_documents_lie(spark, rows, parts):
    texts, items = rows
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(parts)
    got = phrases.phrase_matches(df, spark.createDataFrame(items, "item_id long, text string"))
    want = []
    for doc_id, text in texts:
        n, hit, exact, near = brute(text, items)
        want.append((doc_id, text, n, hit, exact, near))
    have = []
    for r in got.withColumn("n_hit", phrases.hit_words()).collect():
        h = r["phrase_hits"]
        hit = [k for s in h["spans"] for k in range(s["first"], s["last"] + 1)]
        assert r["n_hit"] == len(hit)
        have.append((r["doc_id"], r["text"], h["n_words"], hit, h["items"], h["near_items"]))
    assert sorted(have, key=str) == sorted(want, key=str)


def test_slots_of_a_frequent_word_change_nothing(spark, rows, monkeypatch):
    texts, items = rows
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(9)
    items = spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(str, phrases.phrase_matches(df, items).collect()))
    monkeypatch.setattr(phrases, "LISTS_PER_SLOT", 2)
    assert sorted(map(str, phrases.phrase_matches(df, items).collect())) == one


def test_columns_of_any_name_stay(spark):
    names = ["number", "row", "chunk", "term", "places", "numbers", "phrase_part", "window", "item", "length", "first"]
    df = spark.createDataFrame([(1, "one two three", *names, "old")], ["doc_id", "text", *names, "phrase_hits"])
    items = spark.createDataFrame([(7, "two three")], "item_id long, text string")
    got = phrases.phrase_matches(df, items).collect()[0]
    assert list(got[:-1]) == [1, "one two three", *names] and got["phrase_hits"]["items"] == got["phrase_hits"]["near_items"] == ["7"]


def test_index_holds_every_word(spark):
    df = spark.createDataFrame([(5, "b a b"), (6, None), (9, "A")], "number long, text string").coalesce(1)
    index = phrases.positional_index(df).collect()
    header = next(r for r in index if r["term"] is None)
    assert (header["numbers"], header["places"]) == ([5, 6, 9], [3, 0, 1])
    assert sorted(r["places"] for r in index if r["term"] is not None) == [[0, 2], [1, 2 << 32]]


@pytest.mark.parametrize("few", [0, 2, 1000])
def test_searched_and_intersected_lists_meet_the_same_places(spark, rows, monkeypatch, few):
    """Windows that occur once and hundreds of times in one chunk, with words that fill the chunk."""
    monkeypatch.setattr(phrases, "FEW", few)
    texts = [(100 + k, "a b c d e f g h a b c " * (k % 7) + "h g f") for k in range(60)] + rows[0]
    items = rows[1] + [(60, "a b c d e f g h a b c d"), (61, "a a a"), (62, "h g f")]
    df = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    got = phrases.phrase_matches(df, spark.createDataFrame(items, "item_id long, text string"), near=False)
    have = [(r["doc_id"], r["phrase_hits"]["n_words"], r["n_hit"], r["phrase_hits"]["items"]) for r in got.withColumn("n_hit", phrases.hit_words()).collect()]
    want = [(i, n, len(hit), exact) for i, t in texts for n, hit, exact, _ in [brute(t, items)]]
    assert sorted(have, key=str) == sorted(want, key=str)


def test_lists_are_joined_without_a_broadcast_of_candidates(spark, rows):
    """The joins on word and chunk shuffle at every size: neither lists nor candidates, which grow, pass the driver."""
    df = spark.createDataFrame(rows[0], "doc_id long, text string").selectExpr("monotonically_increasing_id() number", "text")
    lists = phrases.positional_index(df).where("term is not null").select("term", "chunk", "places")
    ordered, slots = phrases._ordered_windows(phrases.windows_of(spark.createDataFrame(rows[1], "item_id long, text string")), lists)
    plan = phrases.match_exact(ordered, lists, slots)._jdf.queryExecution().sparkPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and "term" in line and "chunk" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)
