"""Inventory statistics over a product table: counts and volumes per period and series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from swathbook import constants as K
from swathbook.functions import geometry as G
from swathbook.functions import names as N


def with_start(products: DataFrame, mode: str = "default") -> DataFrame:
    """Add ``startdate`` read from the name (``mode="reference"``: from its sixth field)."""
    start = N.start_time_field5("Name") if mode == "reference" else N.start_time("Name")
    return products.withColumn("startdate", start)


def _series(first: list[str], second: list[str], second_matches) -> Column:
    """Array of the (unit, second) series a product belongs to, by text in its fields."""
    pairs = F.array(
        *[
            F.struct(F.lit(i * len(second) + j).alias("i"), F.lit(u).alias("unit"), F.lit(p).alias("second"))
            for i, u in enumerate(first)
            for j, p in enumerate(second)
        ]
    )
    return F.filter(pairs, lambda s: F.col("Name").contains(s["unit"]) & second_matches(s["second"]))


def _name_has(text: Column) -> Column:
    return F.col("Name").contains(text)


def _spine(spark: SparkSession, periods: Column, first: list[str], second: list[str], label: str) -> DataFrame:
    """Every (period, unit, series) combination, built from the parameters alone."""
    pairs = F.array(
        *[
            F.struct(F.lit(i * len(second) + j).alias("series_no"), F.lit(u).alias("unit"), F.lit(p).alias(label))
            for i, u in enumerate(first)
            for j, p in enumerate(second)
        ]
    )
    return (
        spark.range(1)
        .select(F.explode(periods).alias("period"))
        .select("period", F.explode(pairs).alias("_s"))
        .select("period", "_s.series_no", "_s.unit", f"_s.{label}")
    )


def _dense(spine: DataFrame, counts: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Fill the spine with the aggregated values, 0 where a period has none."""
    filled = spine.join(counts, keys, "left")
    return filled.withColumns({v: F.coalesce(F.col(v), F.lit(0).cast(counts.schema[v].dataType)) for v in values})


def _stacked(dense: DataFrame, value: str) -> DataFrame:
    """Add ``stack_base``: the sum of the series drawn before this one in the same period."""
    below = Window.partitionBy("period").orderBy("series_no").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum(value).over(below)
    return dense.withColumn("stack_base", F.coalesce(total, F.lit(0).cast(dense.schema[value].dataType)))


def _month_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def _months(first: str, last: str) -> Column:
    return F.transform(
        F.sequence(F.lit(first + "-01").cast("date"), F.lit(last + "-01").cast("date"), F.expr("INTERVAL 1 MONTH")),
        lambda d: F.date_format(d, "yyyy-MM"),
    )


def _years(first: int, last: int) -> Column:
    return F.transform(F.sequence(F.lit(first), F.lit(last)), lambda y: y.cast("string"))


def _counted(df: DataFrame, period: Column, label: str, agg: Column) -> DataFrame:
    return (
        df.withColumn("period", period)
        .select("*", F.explode("_series").alias("_s"))
        .groupBy("period", F.col("_s.unit").alias("unit"), F.col("_s.second").alias(label))
        .agg(agg)
    )


def _span(products: DataFrame, mode: str, first, last, units: list[str] | None, text: str, fixed: tuple):
    """Bounds and units as given; where missing, ``fixed`` in the reference mode, else what the data hold.

    One aggregate reads the data; a table without a start time has the fixed bounds.
    """
    if mode == "reference":
        return first or fixed[0], last or fixed[1], units or K.UNITS
    if first is None or last is None or units is None:
        start = F.date_format("startdate", text)
        unit = F.collect_set(F.nullif(F.regexp_extract("Name", "^S1[A-Z]", 0), F.lit("")))
        row = with_start(products, mode).agg(F.min(start), F.max(start), F.array_sort(unit)).first()
        kind = type(fixed[0])
        first = first or (kind(row[0]) if row[0] else fixed[0])
        last = last or (kind(row[1]) if row[1] else fixed[1])
        units = units or row[2] or K.UNITS
    return first, last, units


def count_per_month(
    products: DataFrame, first: str | None = None, last: str | None = None, mode: str = "default",
    units: list[str] | None = None, polarisations: list[str] = K.POLARISATIONS,
) -> DataFrame:
    """Products per month, unit and polarisation; every month of the range present; stacking base."""
    first, last, units = _span(products, mode, first, last, units, "yyyy-MM", ("2013-01", "2023-12"))
    df = with_start(products, mode).withColumn("_series", _series(units, polarisations, _name_has))
    n = _counted(df, _month_text(F.col("startdate")), "polarisation", F.count(F.lit(1)).alias("n"))
    spine = _spine(products.sparkSession, _months(first, last), units, polarisations, "polarisation")
    return _stacked(_dense(spine, n, ["period", "unit", "polarisation"], ["n"]), "n")


def count_per_calendar_month(
    products: DataFrame, mode: str = "default",
    units: list[str] | None = None, polarisations: list[str] = K.POLARISATIONS,
) -> DataFrame:
    """Products per month of the year, unit and polarisation."""
    _, _, units = _span(products, mode, "-", "-", units, "yyyy-MM", ("-", "-"))
    df = with_start(products, mode).withColumn("_series", _series(units, polarisations, _name_has))
    df = df.filter("startdate IS NOT NULL")
    return _counted(df, F.month("startdate"), "polarisation", F.count(F.lit(1)).alias("n")).withColumnRenamed(
        "period", "month"
    )


def count_per_year_pass(
    products: DataFrame, first: int | None = None, last: int | None = None, mode: str = "default", units: list[str] | None = None
) -> DataFrame:
    """Products per year, unit and orbit direction; every year present; stacking base."""
    first, last, units = _span(products, mode, first, last, units, "yyyy", (2013, 2024))
    passed = with_start(products, mode).withColumn("_pass", N.orbit_pass("Attributes"))
    df = passed.withColumn("_series", _series(units, K.PASSES, lambda p: F.col("_pass").contains(p)))
    n = _counted(df, F.year("startdate").cast("string"), "pass", F.count(F.lit(1)).alias("n"))
    spine = _spine(products.sparkSession, _years(first, last), units, K.PASSES, "pass")
    return _stacked(_dense(spine, n, ["period", "unit", "pass"], ["n"]), "n")


def volume_per_period(
    products: DataFrame, freq: str = "year", first: str | None = None, last: str | None = None, mode: str = "default",
    units: list[str] | None = None, polarisations: list[str] = K.POLARISATIONS,
) -> DataFrame:
    """Volume and number of products per year or month, unit and polarisation; stacking base."""
    first, last, units = _span(products, mode, first, last, units, "yyyy" if freq == "year" else "yyyy-MM", ("2013", "2024") if freq == "year" else ("2013-01", "2024-12"))
    if freq not in ("year", "month"):
        raise ValueError(freq)
    df = with_start(products, mode).withColumn("_series", _series(units, polarisations, _name_has))
    df = df.withColumn("volume", N.volume_tb("Name"))
    start = F.col("startdate")
    period = F.year(start).cast("string") if freq == "year" else _month_text(start)
    total = _counted(df, period, "polarisation", F.sum("volume").alias("volume"))
    periods = _years(int(first), int(last)) if freq == "year" else _months(first, last)
    spine = _spine(products.sparkSession, periods, units, polarisations, "polarisation")
    return _stacked(_dense(spine, total, ["period", "unit", "polarisation"], ["volume"]), "volume")


def _named_years(first: int, last: int, prefix: Column | None = None) -> Column:
    """Years whose text ``<prefix>_<year>`` occurs in the name."""
    years = F.sequence(F.lit(first), F.lit(last))
    start = F.lit("_") if prefix is None else F.concat(prefix, F.lit("_"))
    return F.filter(years, lambda y: F.col("Name").contains(F.concat(start, y.cast("string"))))


def _year_cells(years: Column, series: str) -> Column:
    return F.transform(years, lambda y: F.struct(y.alias("year"), F.lit(series).alias("series")))


def count_per_year_wide(
    products: DataFrame, first: int | None = None, last: int | None = None, polarisations: list[str] = K.POLARISATIONS
) -> DataFrame:
    """One row per year, one column per polarisation, by ``<polarisation>_<year>`` in the name."""
    first, last, _ = _span(products, "default", first, last, K.UNITS, "yyyy", (2014, 2023))
    cells = F.flatten(F.array(*[_year_cells(_named_years(first, last, F.lit(p)), p) for p in polarisations]))
    return _wide(products, cells, first, last, polarisations)


def count_per_year_unit_wide(
    products: DataFrame, first: int | None = None, last: int | None = None, drop_empty: bool = False,
    units: list[str] | None = None, polarisations: list[str] = K.POLARISATIONS,
) -> DataFrame:
    """One row per year, one column per unit and polarisation.

    ``drop_empty`` leaves out columns that are zero in every year; it looks at the
    aggregated table, a few rows, to do so.
    """
    first, last, units = _span(products, "default", first, last, units, "yyyy", (2013, 2024))
    labels, cells = [], []
    for u in units:
        for p in polarisations:
            labels.append(f"{u}_{p}")
            years = F.when(F.col("Name").contains(u), _named_years(first, last, F.lit(p))).otherwise(
                F.array().cast("array<int>")
            )
            cells.append(_year_cells(years, f"{u}_{p}"))
    wide = _wide(products, F.flatten(F.array(*cells)), first, last, labels)
    if drop_empty:
        sums = wide.agg(*[F.sum(c).alias(c) for c in labels]).first().asDict()
        wide = wide.drop(*[c for c in labels if not sums[c]])
    return wide


def _wide(products: DataFrame, cells: Column, first: int, last: int, labels: list[str]) -> DataFrame:
    counted = (
        products.select(F.explode(cells).alias("_c"))
        .groupBy(F.col("_c.year").alias("year"))
        .pivot("_c.series", labels)
        .agg(F.count(F.lit(1)))
    )
    years = products.sparkSession.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("year"))
    return years.join(counted, "year", "left").na.fill(0, labels)


def volume_by_sea_threshold(
    products: DataFrame, thresholds: list[int] = K.SEA_THRESHOLDS, polarisations: list[str] = K.POLARISATIONS
) -> DataFrame:
    """Volume of the products with at least each sea percentage, per polarisation.

    A product is reported under every threshold it reaches. Products are first
    summed by the highest one, then the small table is accumulated downwards.
    """
    steps = F.array(*[F.lit(t) for t in sorted(thresholds)])
    pols = F.filter(F.array(*[F.lit(p) for p in polarisations]), _name_has)
    top_step = F.array_max(F.filter(steps, lambda t: F.col("sea_percent") >= t))
    summed = (
        products.select(F.explode(pols).alias("polarisation"), top_step.alias("_top"), N.volume_tb("Name").alias("_v"))
        .filter("_top IS NOT NULL")
        .groupBy("polarisation", "_top")
        .agg(F.sum("_v").alias("_v"))
        .groupBy("polarisation")
        .agg(F.collect_list(F.struct("_top", "_v")).alias("_steps"))
    )
    spine = products.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(p) for p in polarisations])).alias("polarisation")
    )
    per_pol = spine.join(summed, "polarisation", "left").select(
        "polarisation", F.explode(steps).alias("min_sea_percent"), "_steps"
    )
    volume = F.aggregate(
        F.filter("_steps", lambda s: s["_top"] >= F.col("min_sea_percent")), F.lit(0.0), lambda a, s: a + s["_v"]
    )
    return per_pol.select("polarisation", "min_sea_percent", F.coalesce(volume, F.lit(0.0)).alias("volume"))


def count_available_per_year(
    products: DataFrame, available: str = "available", first: int | None = None, last: int | None = None, mode: str = "default"
) -> DataFrame:
    """All products and locally held products per year (``mode="reference"``: by ``_<year>`` in the name)."""
    first, last, _ = _span(products, mode, first, last, K.UNITS, "yyyy", (2013, 2024))
    if mode == "reference":
        df = products.withColumn("year", F.explode(_named_years(first, last)))
    else:
        df = with_start(products).withColumn("year", F.year("startdate"))
    counts = df.groupBy("year").agg(
        F.count(F.lit(1)).alias("all_products"), F.count_if(F.col(available)).alias("available_products")
    )
    years = products.sparkSession.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("year"))
    return years.join(counts, "year", "left").na.fill(0, ["all_products", "available_products"])


def count_per_month_window(
    products: DataFrame, first: str | None = None, last: str | None = None, mode: str = "default",
    units: list[str] | None = None, polarisations: list[str] = K.POLARISATIONS,
) -> DataFrame:
    """Products per month, unit and polarisation (text ``<polarisation>_`` in the name).

    ``mode="reference"``: a month is the 30 days from its first day, so the 31st
    belongs to no month and early March also to February.
    """
    first, last, units = _span(products, mode, first, last, units, "yyyy-MM", ("2013-01", "2024-12"))
    df = with_start(products, mode).withColumn(
        "_series", _series(units, polarisations, lambda p: F.col("Name").contains(F.concat(p, F.lit("_"))))
    )
    month = F.trunc("startdate", "month")
    if mode == "reference":
        nearby = F.array(month, F.add_months(month, -1))
        months = F.filter(
            nearby, lambda m: F.col("startdate") < m.cast("timestamp") + F.expr("INTERVAL 30 DAYS")
        )
        df = df.withColumn("_month", F.explode(months))
    else:
        df = df.withColumn("_month", month)
    n = _counted(df, F.date_format("_month", "yyyy-MM"), "polarisation", F.count(F.lit(1)).alias("n"))
    spine = _spine(products.sparkSession, _months(first, last), units, polarisations, "polarisation")
    return _dense(spine, n, ["period", "unit", "polarisation"], ["n"]).drop("series_no")


def sea_histogram(products: DataFrame, bins: int = K.HISTOGRAM_BINS, value: str = "sea_percent") -> DataFrame:
    """Equal-width histogram from minimum to maximum; the last bin holds the maximum."""
    values = products.select(F.col(value).cast("double").alias("v")).filter("v IS NOT NULL")
    limits = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    same = F.col("lo") == F.col("hi")
    limits = limits.select(
        F.when(same, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(same, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    lo, hi = limits.select("lo").scalar(), limits.select("hi").scalar()
    number = F.least(F.floor((F.col("v") - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")
    counts = values.groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = limits.filter("lo IS NOT NULL").select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", ((F.col("hi") - F.col("lo")) / bins).alias("w")
    )
    return edges.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * F.col("w")).alias("bin_low"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("w")).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def sea_cumulative_histogram(products: DataFrame, bins: int = K.HISTOGRAM_BINS, value: str = "sea_percent") -> DataFrame:
    """Products with at least the lower edge of each bin, accumulated from the top bin down.

    The window runs over the ``bins`` rows of the histogram.
    """
    down = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = sea_histogram(products, bins, value)
    return hist.select("bin", "bin_low", F.sum("n").over(down).alias("n_at_least"))


def footprint_census(products: DataFrame) -> DataFrame:
    """Number of footprints by geometry type: polygon, multipolygon, other."""
    kind = G.wkt_kind(G.footprint_wkt("Footprint"))
    label = F.when(kind == "POLYGON", "polygon").when(kind == "MULTIPOLYGON", "multipolygon").otherwise("other")
    return products.groupBy(label.alias("geom_type")).agg(F.count(F.lit(1)).alias("n"))
