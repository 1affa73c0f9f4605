"""Codes, formats and thresholds that results depend on."""

# Product-name timestamp, and the day on which the object-store layout changed.
NAME_TIME_FORMAT = "yyyyMMdd'T'HHmmss"
OBJECT_LAYOUT_CHANGE = "2023-02-20 00:00:00"

# Sensors and production statuses.
S1_SENSOR = "CbandRadar"
S2_SENSOR = "MultiSpectralImager"
DEFAULT_STATUS = "operational"
PRODUCTION_STATUS = {
    "O": "operational",
    "F": "reference",
    "D": "development",
    "R": "reprocessing",
}

# Search defaults.
WORLD_WKT = "POLYGON((-180 -90,180 -90,180 90,-180 90,-180 -90))"
DEFAULT_TOP = 1000
DEFAULT_SLICE_DAYS = 7
SEARCH_URL = "https://catalogue.dataspace.copernicus.eu/odata/v1/Products?$filter="

# Download address templates (zipper, then the one of match records).
ZIPPER_URL = "https://zipper.dataspace.copernicus.eu/odata/v1/Products(%s)/$value"
MATCH_URL = "https://download.dataspace.copernicus.eu/odata/v1/Products(%s)/$value"

# Sibling matching.
TARGET_TYPES = ["GRDH", "GRDM", "SLC_", "OCN_", "RAW_"]
MAX_DELTA_SECONDS = 8

# Inventory series, in stacking order, and volume per product.
UNITS = ["S1A", "S1B"]
POLARISATIONS = ["1SDV", "1SSV", "1SSH", "1SDH"]
PASSES = ["ASCENDING", "DESCENDING"]
EW_OCN_VOLUME = 37.0 / 1000.0
EW_SLC_VOLUME = 3.7
IW_OCN_VOLUME = 15.0 / 1000.0
OTHER_VOLUME = 3.8 / 1000.0
SEA_THRESHOLDS = [0, 10, 20, 30, 40, 50, 60, 70, 80, 90]
HISTOGRAM_BINS = 20

# Presence counters.
COUNT_LISTING = "products_in_initial_listing"
COUNT_ARCHIVED = "preproc-archived_product"
COUNT_ARCHIVE_PREFIX = "preproc-archive_"
COUNT_SPOOL = "preproc-in_spool_product"
COUNT_OUTDIR = "preproc-in_outdir_product"
COUNT_ABSENT = "preproc-product_absent_from_local_disks"

# Transfers.
SUCCESS_MEANINGS = ["OK", "Downloaded"]
MAX_LOGIN_ERRORS = 4
STATUS_TODO, STATUS_RUNNING, STATUS_DONE, STATUS_ERROR = 0, 2, 1, -1
