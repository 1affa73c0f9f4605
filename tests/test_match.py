import random

import pytest

from swathbook.operators import match as M

# (source, target) pairs of real names; one source start lies in its target's end time.
PAIRS = [
    ("S1A_IW_SLC__1SDV_20191031T160736_20191031T160803_029705_036271_B837.SAFE", "S1A_IW_GRDH_1SDV_20191031T160737_20191031T160802_029705_036271_C7BE.SAFE"),
    ("S1A_IW_SLC__1SDV_20191031T160825_20191031T160853_029705_036271_195C.SAFE", "S1A_IW_GRDH_1SDV_20191031T160821_20191031T160846_029705_036271_7D13.SAFE"),
    ("S1A_IW_SLC__1SDV_20191031T160851_20191031T160920_029705_036271_E63C.SAFE", "S1A_IW_GRDH_1SDV_20191031T160852_20191031T160920_029705_036271_F602.SAFE"),
    ("S1A_IW_SLC__1SDV_20200228T160847_20200228T160916_031455_039F26_62FE.SAFE", "S1A_IW_GRDH_1SDV_20200228T160848_20200228T160916_031455_039F26_D7BD.SAFE"),
    ("S1B_IW_SLC__1SDV_20191209T154254_20191209T154321_019290_0246C2_4647.SAFE", "S1B_IW_GRDH_1SDV_20191209T154229_20191209T154254_019290_0246C2_1CB1.SAFE"),
    ("S1B_IW_SLC__1SDV_20191209T154319_20191209T154346_019290_0246C2_1A5F.SAFE", "S1B_IW_GRDH_1SDV_20191209T154254_20191209T154319_019290_0246C2_B84F.SAFE"),
    ("S1B_IW_SLC__1SDV_20191209T154228_20191209T154256_019290_0246C2_8013.SAFE", "S1B_IW_GRDH_1SDV_20191209T154229_20191209T154254_019290_0246C2_1CB1.SAFE"),
    ("S1B_IW_SLC__1SDH_20191209T154405_20191209T154434_019290_0246C3_C609.SAFE", "S1B_IW_GRDH_1SDH_20191209T154405_20191209T154434_019290_0246C3_4F49.SAFE"),
]
CATALOG = "Id string, Name string, ContentLength long"


def listing(spark, names):
    return spark.createDataFrame(list(enumerate(names)), "line_no long, safename string")


def test_real_pairs(spark):
    catalog = spark.createDataFrame([(t[-9:-5], t, 1000) for t in sorted({t for _, t in PAIRS})], CATALOG)
    got = M.match_siblings(listing(spark, [s for s, _ in PAIRS]), catalog, "GRDH").collect()
    assert {r.source_id: r.target_name for r in got} == dict(PAIRS)


def test_statuses(spark):
    src = PAIRS[0][0]
    catalog = spark.createDataFrame([("c", PAIRS[0][1].replace("160737", "160756"), 1000)], CATALOG)
    got = M.match_siblings(listing(spark, [src, src.replace("029705", "029799"), "junk", "/x/" + src]), catalog, "GRDH")
    rows = {r.line_no: r for r in got.collect()}
    assert rows[0].status == "not_found" and "20s away (>8s threshold)" in rows[0].note and rows[0].delta_seconds == 20
    assert rows[1].note == "No GRDH product found for DataTake 036271"
    assert rows[2].status == rows[3].status == "error"
    assert M.match_summary(got).first().asDict() == {"found": 0, "not_found": 2, "errors": 2}
    with pytest.raises(ValueError):
        M.match_siblings(listing(spark, [src]), catalog, "XXXX")


def test_hot_group_equals_brute_force(spark):
    """All products in one group, far apart in time, copies of one source: as a plain loop over all candidates."""
    rnd = random.Random(5)

    def name(kind, t, tail):
        h, m, s = t // 3600, t // 60 % 60, t % 60
        e = t + 1
        return (
            f"S1A_IW_{kind}_1SDV_20240101T{h:02d}{m:02d}{s:02d}_20240102T{e // 3600:02d}{e // 60 % 60:02d}{e % 60:02d}_000001_000001_{tail:04X}.SAFE"
        )

    sources = [(name("SLC_", t, i), t) for i, t in enumerate(rnd.choices(range(80000), k=120))]
    sources += [sources[0]] * 60
    candidates = [(f"i{i}", name("GRDH", t, i), t) for i, t in enumerate(rnd.choices(range(80000), k=150))]
    catalog = spark.createDataFrame([(i, n, 5) for i, n, _ in candidates], CATALOG)
    got = M.match_siblings(
        listing(spark, [n for n, _ in sources]), catalog, "GRDH", tolerance=600, bucket_seconds=600, rows_per_slot=20
    ).collect()
    assert len(got) == len(sources)
    for row in got:
        source, t = sources[row.line_no]
        text = source[17:32]
        exact = sorted((n, i) for i, n, _ in candidates if text in n)
        delta, best, best_id = min((abs(ct - t), n, i) for i, n, ct in candidates)
        if exact:
            assert (row.target_name, row.match_method) == (exact[0][0], "exact_timestamp")
        else:
            assert row.delta_seconds == delta
            assert row.target_name == (best if delta <= 600 else None)


def test_resume_keeps_repeated_names(spark):
    done = spark.createDataFrame([("a",), ("a",)], "source_id string")
    left = M.unprocessed(listing(spark, ["a", "b", "b", "c"]), done).collect()
    assert sorted(r.safename for r in left) == ["b", "b", "c"]
