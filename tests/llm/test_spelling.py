"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest

from swathbook.llm import spelling
from swathbook.llm.queries import op11_spelling_variants


def brute_words(rows, every=97):
    lower = str.maketrans(spelling.UPPER, spelling.LOWER)
    seen = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_forms(words, factor=2):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= factor * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (words[w], len(near[w]), form[w], words[form[w]] if form[w] else None, root)
    return out


def as_dict(df):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


@pytest.fixture(scope="module")
def words():
    rng = random.Random(5)
    words = {}
    for _ in range(60):
        w = "".join(rng.choices("aeé÷nrst", k=rng.randint(5, 7)))
        words[w] = rng.randint(3, 40)
        for _ in range(6):
            i = rng.randrange(len(w))
            v = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("aeénrst") + w[i:], w[:i] + rng.choice("aeénrst") + w[i + 1 :]])
            if len(v) >= 5:
                words.setdefault(v, rng.randint(3, 40))
                w = rng.choice([w, v])
    return words


@pytest.mark.parametrize(("classes", "chunk"), [(None, spelling.CHUNK), (2, 3), (7, 50)])
def test_pairs(spark, words, classes, chunk):
    """All pairs and no others, each in both directions, once, however blocks are cut."""
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = [(r["word"], r["near"], r["near_n"]) for r in spelling.near_words(df, classes, chunk).collect()]
    assert sorted(got) == sorted((a, b, words[b]) for a in words for b in words if one_edit(a, b))


def test_forms(spark, words):
    df = spark.createDataFrame([(w, n, "x") for w, n in words.items()] + [(None, 3, "x"), ("", 3, "x"), ("words", None, "x")], "word string, n long, near string")
    got = as_dict(spelling.spelling_variants(df))
    assert got == brute_forms(words)
    assert max(len({w, got[w][2], got[w][4]} - {None}) for w in got) == 3  # chains of two steps or more


def test_query(spark, tmp_path, docs):
    """The registered query on documents with planted deletions."""
    rng = random.Random(2)
    vocabulary = ["".join(rng.choices("abcdeéÉß", k=rng.randint(4, 9))) for _ in range(40)]
    texts = [" ".join(w.upper() if rng.random() < 0.2 else w for w in rng.choices(vocabulary, k=120)) for _ in range(40)] + [None, "", "12 34", "a" * 5 + "_" + "a" * 5]
    rows = [(i, t, None, None, None, "x", "y") for i, t in enumerate(texts)]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = op11_spelling_variants(spark, str(tmp_path))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute_forms(brute_words([(r[0], r[1]) for r in rows]))
    assert as_dict(found) == want
    assert any(v[2] for v in want.values())


def test_hard(spark, hard, none):
    rows = [(r["doc_id"], r["text"]) for r in hard.collect()]
    got = {r["word"]: r["n"] for r in spelling.count_words(hard).collect()}
    assert got == brute_words(rows)
    assert spelling.spelling_variants(spelling.count_words(none)).collect() == []
    with pytest.raises(ValueError, match="factor"):
        spelling.spelling_variants(none, 1)
