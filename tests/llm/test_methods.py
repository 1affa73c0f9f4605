"""Operators against brute force and held-out rows."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

import compare
import __spark_entry__ as entry
from llm.conftest import EN, rows_of
from swathbook.llm import components, near_documents, near_lines, sharding, token_counts, words
from swathbook.llm.queries import ORACLE, QUERIES, VOCABULARY


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, sf, name):
    assert compare.differences(spark, compare.connect(sf), name, sf) in ("", "types {}")


def test_words_are_those_of_the_pattern():
    import re

    texts = ["Ab-c é1", "", None, "x" * 10, " ".join(f"w{i}É" for i in range(400_000)), "ß\x7fß"]
    got = [hashes[bounds[i] : bounds[i + 1]] for _, hashes, bounds in words.words(pa.array(texts)) for i in range(len(bounds) - 1)]
    lower = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for t in texts]
    want = [re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", t) for t in lower]
    assert [len(g) for g in got] == [len(w) for w in want]
    pairs = {(int(h), w) for g, ws in zip(got, want, strict=True) for h, w in zip(g, ws, strict=True)}
    assert len({h for h, _ in pairs}) == len({w for _, w in pairs}) == len(pairs)


def test_union_find(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    linked = {n for a, b in edges if a != b for n in (a, b)}
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == {n: root[n] for n in linked} and len(got) == len(linked)


def _near_texts(n, seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(n):
        base = rnd.choices(vocabulary, k=rnd.randrange(30, 120))
        texts.append(" ".join(base))
        for _ in range(rnd.randrange(0, 5)):
            copy = list(base)
            for _ in range(rnd.randrange(0, 4)):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            texts.append(" ".join(copy))
    return texts


def test_near_documents_equal_brute_force(spark, docs):
    texts = _near_texts(40, 5)
    rows = [np.unique(words.shingles(h[b[i] : b[i + 1]], 5), return_counts=True) for _, h, b in words.words(pa.array(texts)) for i in range(len(b) - 1)]
    df = {}
    for values, _ in rows:
        for v in values:
            df[v] = df.get(v, 0) + 1
    weigh = [{v: c * np.log(1 + len(texts) / max(df[v], 0.01 * len(texts))) for v, c in zip(*r, strict=True)} for r in rows]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        both = sum(min(weigh[a][v], weigh[b][v]) for v in weigh[a].keys() & weigh[b].keys())
        if both >= 0.8 * (sum(weigh[a].values()) + sum(weigh[b].values()) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = near_documents.near_duplicates(docs(rows_of(texts))).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {i: find(i) for i in range(len(texts))}


def test_consistent_weighted_sampling_estimates_weighted_jaccard():
    rnd = np.random.default_rng(1)
    keys = np.sort(rnd.integers(0, 1 << 63, 300).astype(np.uint64))
    one, two = (keys[:250], np.full(250, 1)), (keys[50:], rnd.integers(1, 3, 250))
    model = (np.zeros(0, np.uint64), np.zeros(0), 4.0)
    a, b = (near_documents.sample_bands(*x, model, bands=400, rows=1) for x in (one, two))
    assert abs((a == b).mean() - near_documents.weighted_jaccard(one, two, model)) < 0.08


def test_near_lines_equal_brute_force(spark, docs):
    rnd = random.Random(9)
    lines = []
    for _ in range(60):
        base = "".join(rnd.choices("abcdefgh ijklmno", k=rnd.randrange(60, 200)))
        lines += [base] + [base[:i] + "#" + base[i + 1 :] for i in rnd.sample(range(len(base)), rnd.randrange(0, 3))]
    sets = [{x[i : i + 8] for i in range(len(x) - 7)} for x in lines]
    root = list(range(len(lines)))
    for _ in lines:
        for a, b in itertools.combinations(range(len(lines)), 2):
            if root[a] != root[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                root[a] = root[b] = min(root[a], root[b])
    got = near_lines.near_lines(docs(rows_of(["\n".join(lines[i::3]) for i in range(3)]))).collect()
    classes = {}
    for r in got:
        classes.setdefault(r["class_line"], set()).add(r["line"])
    want = {}
    for line, r in zip(lines, root, strict=True):
        want.setdefault(r, set()).add(line)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, want.values()))
    assert sum(r["kept"] for r in got) == len(want)


def test_token_counts_equal_the_tokenizer():
    import sentencepiece
    import tokenizers

    raw = open(VOCABULARY, "rb").read()
    counter = token_counts.counter_of(raw)
    held = sentencepiece.SentencePieceProcessor(model_proto=raw)
    pieces, bytes_known = token_counts.read_vocabulary(raw)
    scores = dict(pieces)
    names = [held.id_to_piece(i) for i in range(held.vocab_size())]
    whole = tokenizers.Tokenizer(tokenizers.models.Unigram([(p, scores.get(p, -3e9) if i else 0.0) for i, p in enumerate(names)], 0, True))
    rnd = random.Random(2)
    texts = [EN, " a  b ", "x\n\ny", "é☃ 梦 ң\t.", "  ", "a" * 500] + ["".join(rnd.choices("aeht  \nsué☃▁.,", k=60)) for _ in range(200)]
    assert bytes_known
    for text in texts:
        assert counter.count(text) == counter.path("▁" + text.replace(" ", "▁")) == len(whole.encode("▁" + text.replace(" ", "▁")).ids), repr(text)


def test_unknown_runs_without_byte_pieces():
    counter = token_counts.UnigramCounter([("▁", -1.0), ("a", -1.0), ("aa", -2.0)], byte_fallback=False)
    assert [counter.count(t) for t in ("a", "aa", "xyz", "xaxx")] == [2, 2, 2, 4]  # of equal scores the longest last piece


def test_hilbert_curve_steps_to_neighbours():
    for dimensions, bits in ((2, 3), (3, 2), (3, 4)):
        table = {index: cell for cell, index in sharding.curve(dimensions, bits)}
        assert sorted(table) == list(range(1 << (bits * dimensions)))
        mask = (1 << bits) - 1
        points = [[table[i] >> (bits * d) & mask for d in range(dimensions)] for i in range(len(table))]
        assert all(sum(abs(a - b) for a, b in zip(p, q, strict=True)) == 1 for p, q in itertools.pairwise(points))


def test_shards_have_equal_bytes_and_hashes(spark, sf):
    import zlib

    got = QUERIES["op8_sharding"](spark, sf).toPandas()
    text = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").toPandas().set_index("doc_id").text
    assert (got["size"] == [len(text[i].encode()) + 1 for i in got.doc_id]).all()
    assert (got.text_crc32 == [zlib.crc32(text[i].encode()) for i in got.doc_id]).all()
    assert got.groupby("shard")["size"].sum().sub(got["size"].sum() / 8).abs().max() <= got["size"].max()


def test_held_out_languages(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op1_language_id"](spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").toPandas())
    assert (got.lang == got.lang_pred)[got.held_out].mean() > 0.98


def test_quality_separates(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op3_quality"](spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas())
    clean = got[(got.quality == 1) & (got.toxic == 0)]
    assert clean.keep.mean() > 0.97 and got[got.quality == 0].keep.mean() < 0.05


def test_all_operators_are_registered():
    assert {int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op")} >= set(range(1, 11)) and "pipeline" in entry.queries()


def test_near_documents_do_not_depend_on_the_size_of_the_group(spark, docs):
    rnd = random.Random(11)
    own = lambda k: [f"u{rnd.randrange(10**9)}" for _ in range(k)]
    base, passage = own(200), own(180)
    texts = []
    for _ in range(100):  # a third of the rows: copies of one text, at a plain similarity of 0.858 to it
        copy = list(base)
        for at in rnd.sample(range(5, 190, 12), 3):
            copy[at] = own(1)[0]
        texts.append(" ".join(copy))
    texts = [" ".join(base), *texts]
    texts += [" ".join(passage + own(20)) for _ in range(2)]  # plain 0.81, most of it a passage that few rows share
    texts += [" ".join(own(60)) for _ in range(200)]
    got = {r["doc_id"]: r["class_id"] for r in near_documents.near_duplicates(docs(rows_of(texts)), spread=near_documents.SPREAD).collect()}
    assert {got[i] for i in range(101)} == {0} and got[101] != got[102]
    assert len(set(got.values())) == 203


def test_near_lines_find_one_edit_in_short_lines(spark, docs):
    rnd = random.Random(4)
    pairs = []
    for size in range(30, 81, 2):
        base = "".join(chr(0x4E00 + c) for c in rnd.sample(range(8000), size))
        at = size // 2
        pairs.append((base, rnd.choice([base[:at] + "#" + base[at + 1 :], base[:at] + base[at + 1 :], base[:at] + "#" + base[at:]])))
    got = {r["line"]: r["class_line"] for r in near_lines.near_lines(docs(rows_of([x for p in pairs for x in p])), fine=near_lines.FINE).collect()}
    assert [got[y] for _, y in pairs] == [x for x, _ in pairs] and len(set(got.values())) == len(pairs)
