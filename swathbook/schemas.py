"""Explicit schemas of the tables (nothing is inferred from files)."""

from pyspark.sql import types as T

_S, _D, _L, _TS = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


ATTRIBUTE = _struct(Name=_S, Value=_S)
CHECKSUM = _struct(Value=_S, Algorithm=_S, ChecksumDate=_S)

#: One product inside a catalog response document.
RESPONSE_PRODUCT = _struct(
    Id=_S,
    Name=_S,
    Collection=_struct(Name=_S),
    ContentDate=_struct(Start=_S, End=_S),
    ModificationDate=_S,
    PublicationDate=_S,
    ContentLength=_L,
    Footprint=_S,
    S3Path=_S,
    Checksum=T.ArrayType(CHECKSUM),
    Attributes=T.ArrayType(ATTRIBUTE),
)
RESPONSE_DOCUMENT = _struct(value=T.ArrayType(RESPONSE_PRODUCT))

#: One feature inside a feature-collection document.
FEATURE_DOCUMENT = _struct(features=T.ArrayType(_struct(id=_S, properties=_struct(title=_S))))

#: The flat catalog table.
CATALOG = _struct(
    Id=_S,
    Name=_S,
    collection=_S,
    content_start=_TS,
    content_end=_TS,
    ModificationDate=_TS,
    PublicationDate=_TS,
    ContentLength=_L,
    Footprint=_S,
    S3Path=_S,
    Checksum=T.ArrayType(CHECKSUM),
    Attributes=T.ArrayType(ATTRIBUTE),
)

REQUESTS = _struct(
    request_key=_S,
    id_query=_S,
    start_datetime=_TS,
    end_datetime=_TS,
    geometry=_S,
    collection=_S,
    name=_S,
    sensormode=_S,
    producttype=_S,
    Attributes=_S,
)

LISTING = _struct(id=_S, safename=_S, S3Path=_S)
FILE_INVENTORY = _struct(tier=_S, root=_S, path=_S, size=_L)
LAND = _struct(land_id=_S, wkt=_S)
OBJECTS = _struct(key=_S, size=_L)
TRANSFER_LOG = _struct(
    safename=_S,
    login=_S,
    batch=_L,
    status=T.IntegerType(),
    speed=_D,
    elapsed_time=_D,
    total_mb=_D,
    status_meaning=_S,
)
