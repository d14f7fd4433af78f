"""Household power: cleaning, daily series, hourly forest, day windows."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainfold.functions import dates
from grainfold.operators import clean, encode, evaluate, learn, sequence, split, timeseries

# fixed values: the columns of the raw file, in file order
SCHEMA = (
    "Date string, Time string, Global_active_power double, Global_reactive_power double, Voltage double, "
    "Global_intensity double, Sub_metering_1 double, Sub_metering_2 double, Sub_metering_3 double"
)
GROUP_FILLED = [
    "Global_active_power", "Global_reactive_power", "Global_intensity",
    "Sub_metering_1", "Sub_metering_2", "Sub_metering_3",
]


def prepare(raw: DataFrame, series: list[str] | None = None) -> DataFrame:
    """Timestamps, calendar parts, filled gaps, powers in watt-hours per minute.

    Gaps take the mean of their month, weekday and hour; voltage is interpolated in
    time order inside each meter (``series``; one meter by default).
    """
    ts = dates.parse_ts(F.concat_ws("::", "Time", "Date"), dates.TIME_FIRST)
    rows = raw.withColumn("datetime", ts).drop("Date", "Time")
    parts = dates.calendar_parts(F.col("datetime"))
    rows = rows.withColumns({n: parts[n] for n in ("month", "year", "weekday", "hour", "minute")})
    rows = clean.impute_group_mean(rows, GROUP_FILLED, ["month", "weekday", "hour"])
    rows = sequence.interpolate_linear(rows, "Voltage", series or [], ["datetime"], "_voltage")
    rows = rows.withColumn("Voltage", F.col("_voltage")).drop("_voltage")
    return rows.withColumns({c: F.col(c) * 1000 / 60 for c in ("Global_active_power", "Global_reactive_power")})


def daily(prepared: DataFrame, value: str = "Global_active_power") -> DataFrame:
    """Daily mean with an index; days without data are NULL."""
    binned = timeseries.resample(prepared, "datetime", value, "day")
    return timeseries.bin_index(timeseries.fill_bins(binned, "day"), "day")


def daily_diff(series: DataFrame) -> DataFrame:
    """First difference of the daily mean."""
    return sequence.first_diff(series, "mean", [], ["idx"])


def correlogram(series: DataFrame, value: str = "mean", max_lag: int = 700) -> DataFrame:
    """(lag, acf, pacf)."""
    return timeseries.acf(series, "idx", value, max_lag).join(timeseries.pacf(series, "idx", value, max_lag), "lag")


def hourly_windows(prepared: DataFrame, start: str, end: str, value: str = "Global_active_power") -> DataFrame:
    """Complete days between start and end as centred 23-hour features and the last hour as target."""
    hours = timeseries.resample(timeseries.time_slice(prepared, "datetime", start, end), "datetime", value, "hour")
    return timeseries.day_frames(hours)


def power_forest(prepared: DataFrame, trees: int = 50) -> tuple[Model, DataFrame, DataFrame]:
    """Forest on active power from month, year, weekday and hour; test error; importances."""
    names = ["month", "year", "weekday", "hour"]
    rows = prepared.select("datetime", *names, F.col("Global_active_power").alias("label")).dropna()
    rows = split.hash_split(encode.assemble(rows, ["datetime", "label"]), "datetime", {"train": 70, "valid": 15, "test": 15})
    model = learn.forest_regressor(trees, max_depth=10).fit(rows.where("part = 'train'"))
    report = evaluate.regression_report(model.transform(rows.where("part = 'test'")), "label", "prediction")
    return model, report, evaluate.importance_table(model, names, prepared.sparkSession)
