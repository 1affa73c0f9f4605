"""Every stage of the pipeline against plain Python, and with helper names as columns of the documents."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import corpus_pipeline as C
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swathbook.llm import near_documents as N
from swathbook.llm.language import fit_languages, slot_counts

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Names that operators and stages use inside.
HELPERS = ["id", "row", "doc", "number", "key", "text_key", "copies", "shard", "slot", "curve_index", "phrase_part", "phrase_hits", "lang_pred", "node", "root", "Size", "score", "head"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    words = {c: [c + "".join(rng.choices("abdeilnorst", k=rng.randint(2, 7))) for _ in range(150)] for c in ("en", "fr")}
    out = []
    for i in range(60):
        lang = rng.choice(["en", "fr"])
        out.append([i, " ".join(rng.choices(words[lang], k=rng.randint(30, 90))), lang, "hot" if i % 3 else rng.choice(["a", "b", None])])
    base = rng.choices(words["en"], k=150)
    out.append([99, " ".join(base), "en", "hot"])
    for k in range(8):  # near copies
        copy = list(base)
        copy[3 + k % 4] = f"x{k}"
        out.append([100 + k, " ".join(copy), "en", "hot"])
    out += [[200, out[1][1], "fr", "b"], [1, out[1][1], "fr", "b"], [1, out[1][1], None, "a"], [1, out[1][1], None, "a"], [300, None, None, None], [301, "", "en", "a"], [302, "12 34", "en", "a"], [None, out[2][1], "en", "a"]]
    return [(*r, None if r[1] is None else len(r[1])) for r in out]


@pytest.fixture(scope="module")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stages") / "docs")
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def kept(df):
    return Counter(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_languages(spark, docs, rows):
    model = fit_languages(docs)
    want = Counter()
    for r in rows:
        counts = slot_counts(r[1] or "")
        name, score = ("und", 0.0) if counts is None else model.predict(counts)
        want[r] += name != "und" and score >= C.MIN_LANGUAGE_SCORE
    assert kept(C.keep_languages(spark, docs, "")) == +want


def test_near_copies(spark, docs, rows):
    texts = sorted({r[1] for r in rows if r[1] is not None})
    grams = {}
    for t in texts:
        w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", t.lower())
        grams[t] = Counter(tuple(w[i : i + N.WIDTH]) for i in range(max(0, len(w) - N.WIDTH + 1))) if len(w) >= N.WIDTH else Counter([tuple(w)] if w else [])
    df = Counter(g for t in texts for g in grams[t])
    weight = {g: float(N._idf(np.array([float(n)]), len(texts), N.SPREAD)[0]) for g, n in df.items()}
    root = {t: t for t in texts}

    def top(t):
        while root[t] != t:
            t = root[t]
        return t

    for a, b in itertools.combinations(texts, 2):
        both = sum(min(grams[a][g], grams[b][g]) * weight[g] for g in grams[a].keys() & grams[b].keys())
        either = sum(max(grams[a][g], grams[b][g]) * weight[g] for g in grams[a].keys() | grams[b].keys())
        if either and both / either >= N.THRESHOLD:
            root[top(a)] = top(b)
    classes = {}
    for t in texts:
        classes.setdefault(top(t), []).append(t)
    lowest = lambda t: min((r[0] is None, r[0] or 0) for r in rows if r[1] == t)
    want = Counter({r: n for r, n in Counter(rows).items() if r[1] is None})
    got = kept(C.drop_near_duplicates(spark, docs, ""))
    for members in classes.values():
        head = min(members, key=lowest)
        first = [r for r in rows if r[1] == head and (r[0] is None, r[0] or 0) == lowest(head)]
        chosen = [r for r in first if got[r]]
        assert len(chosen[:1]) == 1, head[:60]
        want[chosen[0]] += 1
    assert not got - want and not want - got
    assert len(classes) < len(texts)


def test_contaminated(spark, docs, rows, tmp_path):
    items = [(1, " ".join(rows[4][1].split()[5:20])), (2, "12 34"), (3, None), (4, "no such words here at all")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    windows = set()
    for _, text in items:
        w = split(text)
        windows |= {tuple(w[i : i + min(10, len(w))]) for i in range(len(w) - min(10, len(w)) + 1)} if w else set()
    hit = lambda t: any(tuple(w[i : i + n]) in windows for w in [split(t)] for n in {len(x) for x in windows} for i in range(len(w) - n + 1))
    assert kept(C.drop_contaminated(spark, docs, str(tmp_path))) == Counter(r for r in rows if not hit(r[1]))
    assert hit(rows[4][1]) and hit("12 34") and not hit(rows[5][1])


def test_mixed(spark, docs, rows):
    """Readings of each document by the order of its number's MD5 inside its source, up to the source's target."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    names = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    whole = {s: sum(n for n, r in zip(size, rows, strict=True) if r[3] == s) for s in names}
    weight = {s: [3.0, 1.0, 2.0][k % 3] for k, s in enumerate(names)}
    target, left, open_ = {}, 1.5 * sum(whole.values()), set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * whole[s]}
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 2.0 * whole[s] for s in over}
        left -= sum(target[s] for s in over)
        open_ -= over
    want = Counter()
    for s in names:
        begin = 0
        mine = [k for k, r in enumerate(rows) if r[3] == s and size[k]]
        for k in sorted(mine, key=lambda k: hashlib.md5(str(k).encode()).hexdigest()):
            for turn in range(2):
                words = max(0, min(size[k], round(target[s]) - begin - turn * whole[s]))
                want[rows[k]] += 2 * words >= size[k] and words > 0
            begin += size[k]
    assert kept(C.mix_sources(spark, docs, "")) == +want


def test_cut(spark, docs, rows):
    """Shards are runs of nearly equal bytes in the order (curve index, hash of the text, number)."""
    got = C.cut_shards(spark, docs, "").collect()
    assert Counter(tuple(r[c] for c in COLUMNS) for r in got) == Counter(rows)
    size = lambda r: len((r["text"] or "").encode()) + 1
    order = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve_index"] for r in order] == sorted(r["curve_index"] for r in got)
    for _, cell in itertools.groupby(order, key=lambda r: r["curve_index"]):
        hashes = [zlib.crc32((r["text"] or "").encode()) for r in cell]
        assert hashes == sorted(hashes)
    total, before, slots = sum(map(size, got)), 0, Counter()
    for r in order:
        assert r["shard"] == min(7, (2 * before + size(r)) * 8 // (2 * total)) and r["slot"] == slots[r["shard"]]
        before, slots[r["shard"]] = before + size(r), slots[r["shard"]] + 1


def test_helper_names(spark, docs, rows, tmp_path):
    """Columns with the names of helper columns stay as they are; only the last stage replaces those it adds."""
    wide = docs.select("*", *[F.concat(F.lit(f"{c}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).alias(c) for c in HELPERS])
    spark.createDataFrame([(1, "no such words")], T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])).write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in C.STAGES:
        got = stage(spark, wide, str(tmp_path))
        added = ["shard", "slot", "curve_index"] if name == "sharding" else []
        assert sorted(got.columns) == sorted(wide.columns), name
        for r in got.limit(20).collect():
            for c in HELPERS:
                assert c in added or r[c] == f"{c}-{'null' if r['doc_id'] is None else r['doc_id']}", (name, c)
        if name == "sharding":
            assert dict(got.dtypes)["shard"] == "int" and got.count() == len(rows)
