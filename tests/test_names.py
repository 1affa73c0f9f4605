import pytest
from pyspark.sql import functions as F

from swathbook.functions import names as N
from swathbook.functions import paths as P

S1 = "S1A_IW_SLC__1SDV_20190118T023637_20190118T023705_025526_02D4A8_08A8.SAFE"
S3 = "S3A_SR_2_WAT____20170124T120058_20170124T121058_20170124T140548_0599_013_294______MAR_O_NR_002.SEN3"
# (name, folder of its expected object path)
OBJECT_PATHS = [
    (S1, "Sentinel-1/SAR/SLC/2019/01/18/"),
    ("S1B_IW_GRDH_1SDV_20200601T054455_20200601T054520_021937_029A2D_1B78.SAFE", "Sentinel-1/SAR/GRD/2020/06/01/"),
    ("S1A_IW_SLC__1SDV_20230219T235959_20230219T235959_047000_059ABC_1234.SAFE", "Sentinel-1/SAR/SLC/2023/02/19/"),
    ("S1A_IW_SLC__1SDV_20230220T000000_20230220T000000_047500_05ABCD_08A8.SAFE", "Sentinel-1/SAR/IW_SLC__1S/2023/02/20/"),
    ("S1A_EW_GRDM_1SDH_20250701T120000_20250701T120100_058000_073000_CDEF.SAFE", "Sentinel-1/SAR/EW_GRDM_1S/2025/07/01/"),
    ("S2A_MSIL1C_20170105T013442_N0204_R031_T53NMJ_20170105T013443.SAFE", "Sentinel-2/MSI/L1C/2017/01/05/"),
    ("S2B_MSIL2A_20221231T230409_N0509_R058_T59JKJ_20230101T001206.SAFE", "Sentinel-2/MSI/L2A/2022/12/31/"),
]


def one(spark, text, *columns):
    return spark.createDataFrame([(text,)], "n string").select(*columns).first()


@pytest.mark.parametrize("name,folder", OBJECT_PATHS)
def test_object_path(spark, name, folder):
    assert one(spark, name, P.object_path("n"))[0] == folder + name


@pytest.mark.parametrize("name", [S3, "UNKNOWN_PRODUCT_20200101.SAFE", "", "S1A_bad"])
def test_object_path_unsupported(spark, name):
    path, error = one(spark, name, P.object_path("n"), P.object_path_error("n"))
    assert path is None and error is not None


def test_radar_fields(spark):
    row = N.with_parsed_name(spark.createDataFrame([(S1,)], "Name string")).first()
    assert (row.satellite, row.mode, row.product, row.level, row.polarisation) == ("S1A", "IW", "SLC_", "1", "DV")
    assert (row.absolute_orbit_number, row.mission_data_take, row.product_id) == ("025526", "02D4A8", "08A8")
    assert row.duration == 28.0 and row.parse_error is None


def test_altimetry_fields(spark):
    row = N.with_parsed_name(spark.createDataFrame([(S3,)], "Name string")).first()
    assert (row.sensor, row.level, row.cycle_number, row.relative_orbit_number) == ("SR", "2", "013", "294")
    assert row.production_status == "operational" and row.mission_data_take == "20170124T140548"


@pytest.mark.parametrize(
    "name,error",
    [("/a/b", "full path instead of a name"), ("X1", "unknown mission"), ("S1A_x", "unreadable time"), (None, "no name")],
)
def test_name_errors(spark, name, error):
    assert one(spark, name, N.name_error("n"))[0] == error


def test_archive_dir(spark):
    assert one(spark, S1, P.archive_dir("n", "/arch"))[0] == "/arch/sentinel-1a/L1/IW/S1A_IW_SLC__1S/2019/018"
    strip = "S1A_S3_SLC__1SDV_20190118T023637_20190118T023705_025526_02D4A8_08A8.SAFE"
    assert one(spark, strip, P.archive_dir("n", "/arch"))[0] == "/arch/sentinel-1a/L1/SM/S1A_SM_SLC__1S/2019/018"


def test_small_expressions(spark):
    row = one(
        spark, "SLC_", N.type_token("OCN_").alias("t"), N.target_level("OCN_").alias("o"), N.target_level("RAW_").alias("r"),
        N.target_level("RAW_", "1").alias("r1"), N.time_hash().alias("h"), N.name_field(F.lit(S1), "mode").alias("m"),
    )
    assert (row.t, row.o, row.r, row.r1, row.m) == ("OCN_", "2", "0", "1", "IW") and len(row.h) == 7
    with pytest.raises(KeyError):
        N.name_field("n", "nothing")
