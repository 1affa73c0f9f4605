"""Lines are hashed, shuffled and judged once; the query has a row for each document."""

import hashlib
import re

import numpy as np

from swathbook.llm import components, near_lines, queries
from tests.llm.conftest import rows_of


def test_shingles_rolled_over_all_lines_are_those_of_single_lines():
    lines = ["abcdefgh", "the river stands", "x" * 40, "ünïcödé ← text of a line"]
    hashes, bounds = near_lines.line_shingles(lines)
    short, places = near_lines.line_shingles([*lines, "abc", ""])
    assert (hashes == short[: len(hashes)]).all() and list(np.diff(places)) == [*np.diff(bounds), 1, 0]
    for i, line in enumerate(lines):
        each = [near_lines.line_shingles([line[j : j + near_lines.WIDTH]])[0][0] for j in range(len(line) - near_lines.WIDTH + 1)]
        assert list(hashes[bounds[i] : bounds[i + 1]]) == each


def test_crowded_bands_are_shuffled_once(spark, monkeypatch):
    plans = []

    def kept(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(components, "write_table", kept)
    bands = spark.range(40).selectExpr("id AS node", "id % 30 AS key")
    found = components.crowded_once(bands)
    assert {tuple(r) for r in found.collect()} == {(i, i % 30) for i in [*range(10), *range(30, 40)]}
    assert len(re.findall("Exchange hashpartitioning", plans[0])) == 1 and "Join" not in plans[0]


def test_op5_has_a_row_for_each_document_and_keeps_one_line_of_a_class(spark, docs, tmp_path):
    line, near = "the house of the old man stands by the river and the boats wait for them", "the house of the old man stands by the river and the boats wait for thee"
    texts = [f"{line}\n\nsome other line that has nothing near", f"{near}\n{line}\nlast", None, line]
    rows = rows_of(texts)
    rows += [rows[0], (None, f"{near}\na", None, None, None, None, None), (None, "a\nb", None, None, None, None, None)]
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_lines"], r["n_removed"], r["kept_md5"] or "") for r in queries.op5_line_dedup(spark, str(tmp_path)).collect())
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    # an id that is null sorts first: of the near lines the one in the document without an id stays
    first = (False, 0, 3, 1, md5("\nsome other line that has nothing near"))
    want = [first, first, (False, 1, 3, 2, md5("last")), (False, 2, 0, 0, ""), (False, 3, 1, 1, md5("")), (True, 0, 2, 1, md5(near)), (True, 0, 2, 0, md5("a\nb"))]
    assert got == sorted(want)
