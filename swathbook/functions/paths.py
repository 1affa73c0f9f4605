"""Storage paths and addresses derived from product names and ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from swathbook import constants as K
from swathbook.functions.names import _col, name_time


def object_path(name: str | Column) -> Column:
    """Expected object-store path of a product; null for missions without a known layout."""
    name = _col(name)
    part = F.split(name, "_")
    s1_start = name_time(F.substring(name, 18, 15))
    s1_dir = F.when(
        s1_start < F.lit(K.OBJECT_LAYOUT_CHANGE).cast("timestamp"), F.substring(F.get(part, 2), 1, 3)
    ).otherwise(F.substring(name, 5, 10))
    s2_start = name_time(F.get(part, 2))
    s2_dir = F.substring(F.get(part, 1), 4, 100)

    def path(base: str, folder: Column, start: Column) -> Column:
        return F.concat(F.lit(base), folder, F.date_format(start, "/yyyy/MM/dd/"), name)

    return F.when(name.startswith("S1"), path("Sentinel-1/SAR/", s1_dir, s1_start)).when(
        name.startswith("S2"), path("Sentinel-2/MSI/", s2_dir, s2_start)
    )


def object_path_error(name: str | Column) -> Column:
    name = _col(name)
    return (
        F.when(name.isNull() | ~name.rlike("^S[12]"), "mission not handled")
        .when(object_path(name).isNull(), "unreadable time")
    )


def archive_dir(name: str | Column, root: str | Column) -> Column:
    """Archive directory of a radar product: unit, level, mode, product family, year, day of year."""
    name = _col(name)
    root = F.lit(root) if isinstance(root, str) else root
    part = F.split(name, "_")
    sat = F.get(part, 0)
    mode = F.when(F.get(part, 1).startswith("S"), "SM").otherwise(F.get(part, 1))
    start = name_time(F.substring(name, 18, 15))
    return F.when(
        name.contains("S1"),
        F.concat(
            root,
            F.lit("/sentinel-1"),
            F.lower(F.substring(sat, 3, 100)),
            F.lit("/L"),
            F.substring(name, 13, 1),
            F.lit("/"),
            mode,
            F.lit("/"),
            sat,
            F.lit("_"),
            mode,
            F.substring(name, 7, 8),
            F.date_format(start, "/yyyy/DDD"),
        ),
    )


def name_variants(path: Column) -> Column:
    """The three spellings under which a product may lie on disk, in order of preference."""
    return F.array(path, F.concat(path, F.lit(".zip")), F.replace(path, F.lit(".SAFE"), F.lit(".zip")))


def strip_bucket(s3_path: str | Column) -> Column:
    return F.replace(_col(s3_path), F.lit("/eodata/"), F.lit(""))


def download_url(product_id: str | Column, template: str = K.ZIPPER_URL) -> Column:
    before, after = template.split("%s")
    return F.concat(F.lit(before), _col(product_id), F.lit(after))


def base_name(path: str | Column) -> Column:
    """Last path segment without '.zip'."""
    return F.replace(F.substring_index(_col(path), "/", -1), F.lit(".zip"), F.lit(""))


def id_from_url(url: str | Column, template: str = K.ZIPPER_URL) -> Column:
    before, after = template.split("%s")
    return F.replace(F.replace(_col(url), F.lit(before), F.lit("")), F.lit(after), F.lit(""))


def output_path(name: str | Column, outdir: str, extension: str = ".zip") -> Column:
    return F.concat(F.lit(outdir.rstrip("/") + "/"), _col(name), F.lit(extension))
