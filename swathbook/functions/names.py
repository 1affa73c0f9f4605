"""Product-name expressions: every function maps Columns to a Column, evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swathbook import constants as K


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def name_time(text: Column) -> Column:
    """Timestamp written in a product name; null when the text is not one."""
    return F.try_to_timestamp(text, F.lit(K.NAME_TIME_FORMAT))


def name_time_text(ts: Column) -> Column:
    return F.date_format(ts, K.NAME_TIME_FORMAT)


def _cut(name: Column, begin: int, end: int) -> Column:
    """Characters begin..end-1, null instead of empty text."""
    return F.nullif(F.substring(name, begin + 1, end - begin), F.lit(""))


def s1_fields(name: str | Column) -> dict[str, Column]:
    """Fixed-width fields of a radar product name."""
    name = _col(name)
    start, end = name_time(_cut(name, 17, 32)), name_time(_cut(name, 33, 48))
    return {
        "satellite": _cut(name, 0, 3),
        "mode": _cut(name, 4, 6),
        "product": _cut(name, 7, 11),
        "level": _cut(name, 12, 13),
        "kind": _cut(name, 13, 14),
        "polarisation": _cut(name, 14, 16),
        "startdate": start,
        "enddate": end,
        "absolute_orbit_number": _cut(name, 49, 55),
        "mission_data_take": _cut(name, 56, 62),
        "product_id": _cut(name, 63, 67),
        "duration": (F.unix_timestamp(end) - F.unix_timestamp(start)).cast("double"),
        "sensor": F.lit(K.S1_SENSOR),
        "production_status": F.lit(K.DEFAULT_STATUS),
    }


def s2_fields(name: str | Column) -> dict[str, Column]:
    """Underscore-separated fields of an optical product name (a snapshot: end = start)."""
    part = F.split(F.replace(_col(name), F.lit(".SAFE"), F.lit("")), "_")
    start = name_time(F.get(part, 2))
    return {
        "satellite": F.get(part, 0),
        "product": F.get(part, 1),
        "level": F.substring(F.get(part, 1), 4, 100),
        "startdate": start,
        "enddate": start,
        "processing_baseline": F.get(part, 3),
        "relative_orbit_number": F.substring(F.get(part, 4), 2, 10).try_cast("int"),
        "tile": F.get(part, 5),
        "production_date": name_time(F.get(part, 6)),
        "product_id": F.get(part, 6),
        "duration": F.lit(0.0),
        "sensor": F.lit(K.S2_SENSOR),
        "production_status": F.lit(K.DEFAULT_STATUS),
    }


def s3_fields(name: str | Column) -> dict[str, Column]:
    """Fields of an altimetry product name.

    ``enddate`` and ``mission_data_take`` are field 9 (a creation time); the
    acquisition stop is the additional ``stopdate``.
    """
    part = F.split(_col(name), "_")
    return {
        "satellite": F.get(part, 0),
        "sensor": F.get(part, 1),
        "level": F.get(part, 2),
        "product": F.get(part, 3),
        "startdate": name_time(F.get(part, 7)),
        "stopdate": name_time(F.get(part, 8)),
        "enddate": name_time(F.get(part, 9)),
        "mission_data_take": F.get(part, 9),
        "duration": F.get(part, 10).try_cast("double"),
        "product_id": F.get(part, 10),
        "cycle_number": F.get(part, 11),
        "relative_orbit_number": F.get(part, 12),
        "product_generating_center": F.get(part, 18),
        "production_status": production_status(F.get(part, 19)),
    }


def production_status(code: Column) -> Column:
    expr = F.lit(None).cast("string")
    for key, meaning in K.PRODUCTION_STATUS.items():
        expr = F.when(code == key, meaning).otherwise(expr)
    return expr


_UNIFIED = {
    "satellite": "string",
    "sensor": "string",
    "mode": "string",
    "product": "string",
    "level": "string",
    "kind": "string",
    "polarisation": "string",
    "startdate": "timestamp",
    "enddate": "timestamp",
    "duration": "double",
    "absolute_orbit_number": "string",
    "relative_orbit_number": "string",
    "cycle_number": "string",
    "mission_data_take": "string",
    "product_id": "string",
    "production_status": "string",
    "processing_baseline": "string",
    "tile": "string",
    "production_date": "timestamp",
    "stopdate": "timestamp",
    "product_generating_center": "string",
}


def _time_texts(name: Column) -> tuple[Column, Column]:
    """Texts of the start and end time, chosen by mission before anything is parsed."""
    part = F.split(name, "_")
    start = (
        F.when(name.startswith("S1"), _cut(name, 17, 32))
        .when(name.startswith("S2"), F.get(part, 2))
        .when(name.startswith("S3"), F.get(part, 7))
    )
    end = (
        F.when(name.startswith("S1"), _cut(name, 33, 48))
        .when(name.startswith("S2"), F.get(part, 2))
        .when(name.startswith("S3"), F.get(part, 9))
    )
    return start, end


def name_error(name: str | Column) -> Column:
    """Why a name cannot be parsed, or null."""
    name = _col(name)
    start, end = (name_time(t) for t in _time_texts(name))
    return (
        F.when(name.isNull(), "no name")
        .when(name.contains("/"), "full path instead of a name")
        .when(~name.rlike("^S[123]"), "unknown mission")
        .when(start.isNull() | end.isNull(), "unreadable time")
    )


def s1_start(name: str | Column) -> Column:
    """Start time of a radar product name; null for any other or unreadable name."""
    name = _col(name)
    readable = name.startswith("S1") & ~name.contains("/") & name_time(_cut(name, 33, 48)).isNotNull()
    return F.when(readable, name_time(_cut(name, 17, 32)))


def parsed_name(name: str | Column) -> Column:
    """One struct for all three missions; fields a mission lacks are null."""
    name = _col(name)
    by_mission = [("S1", s1_fields(name)), ("S2", s2_fields(name)), ("S3", s3_fields(name))]
    fields = []
    for field, kind in _UNIFIED.items():
        value = F.lit(None).cast(kind)
        for prefix, columns in by_mission:
            if field in columns:
                value = F.when(name.startswith(prefix), columns[field].cast(kind)).otherwise(value)
        fields.append(F.when(~name.contains("/"), value).alias(field))
    return F.struct(*fields)


def with_parsed_name(df: DataFrame, name: str = "Name", prefix: str = "") -> DataFrame:
    """Add every parsed field plus ``parse_error`` as columns."""
    parsed = parsed_name(name)
    return df.withColumns(
        {prefix + f: parsed.getField(f) for f in _UNIFIED} | {prefix + "parse_error": name_error(name)}
    )


def parsed_field_names() -> list[str]:
    return list(_UNIFIED)


def name_field(name: str | Column, field: str) -> Column:
    """A single named property of a product name."""
    if field not in _UNIFIED:
        raise KeyError(field)
    return parsed_name(name).getField(field)


def start_time(name: str | Column) -> Column:
    """Start time of a product name; null when the name is not readable."""
    name = _col(name)
    start, end = _time_texts(name)
    return F.when(~name.contains("/") & name_time(end).isNotNull(), name_time(start))


def start_time_field5(name: str | Column) -> Column:
    """Sixth underscore field read as a time: the start for types padded with '_', else the end."""
    return name_time(F.get(F.split(_col(name), "_"), 5))


def product_type(name: str | Column, private_units: list[str] | None = None) -> Column:
    """Catalog product type held in the name, with the suffix of units not yet public."""
    name = _col(name)
    base = F.substring(name, 5, 10)
    if not private_units:
        return base
    return F.when(F.substring(name, 1, 3).isin(private_units), F.concat(base, F.lit("_PRIVATE"))).otherwise(base)


def type_token(target_type: str | Column) -> Column:
    """Four-character type token: trailing underscores dropped, then padded back."""
    target = F.lit(target_type) if isinstance(target_type, str) else target_type
    return F.rpad(F.regexp_replace(target, "_+$", ""), 4, "_")


def target_level(target_type: str | Column, raw_level: str = "0") -> Column:
    """Processing level searched for a target type (``raw_level='1'`` for the historical rule)."""
    target = F.lit(target_type) if isinstance(target_type, str) else target_type
    return F.when(target == "OCN_", "2").when(target == "RAW_", raw_level).otherwise("1")


def volume_tb(name: str | Column) -> Column:
    """Rough volume of one product from mode and type text in its name."""
    name = _col(name)
    return (
        F.when(name.contains("EW") & name.contains("OCN"), K.EW_OCN_VOLUME)
        .when(name.contains("EW") & name.contains("SLC"), K.EW_SLC_VOLUME)
        .when(name.contains("IW") & name.contains("OCN"), K.IW_OCN_VOLUME)
        .otherwise(K.OTHER_VOLUME)
    )


def size_mb(nbytes: str | Column) -> Column:
    return F.round(_col(nbytes) / F.lit(1024.0 * 1024.0), 2)


def attribute(attributes: str | Column, name: str | Column) -> Column:
    """Value of the first attribute called ``name``."""
    wanted = F.lit(name) if isinstance(name, str) else name
    return F.get(F.filter(_col(attributes), lambda a: a["Name"] == wanted), 0)["Value"]


def orbit_pass(attributes: str | Column) -> Column:
    return attribute(attributes, "orbitDirection")


def time_hash(length: int = 7) -> Column:
    """Short id from the current time in milliseconds."""
    return F.substring(F.sha2(F.unix_millis(F.current_timestamp()).cast("string"), 256), 1, length)
