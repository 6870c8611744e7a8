"""Ad click records: one line ``epoch_millis province city userid adid``."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIELDS = ["ts", "province", "city", "userid", "adid"]
# Milliseconds of the first instant of year 1 and the last of year 9999, UTC.
FIRST_MILLIS, LAST_MILLIS = -62_135_596_800_000, 253_402_300_799_999


def split_record(lines: DataFrame, text_places: bool = False) -> DataFrame:
    """``value`` next to its five fields; a field that cannot be read is NULL, as is a time outside years 1 to 9999.

    Fields are parted by one blank: after two of them a field is empty, which cannot be read.  What follows the fifth is ignored.
    ``text_places`` keeps province and city as text, for logs that name them.
    """
    at = [F.trim(F.get(F.split(F.col("value"), " "), i)) for i in range(5)]
    place = "string" if text_places else "int"
    millis = at[0].try_cast("long")
    return lines.select(
        "value",
        F.timestamp_millis(F.when(millis.between(FIRST_MILLIS, LAST_MILLIS), millis)).alias("ts"),
        at[1].try_cast(place).alias("province"), at[2].try_cast(place).alias("city"),
        at[3].try_cast("long").alias("userid"), at[4].try_cast("long").alias("adid"))


def _readable():
    test = F.col("ts").isNotNull()
    for name in FIELDS[1:]:
        test = test & F.col(name).isNotNull()
    return test


def parse_clicks(lines: DataFrame, text_places: bool = False) -> DataFrame:
    """The clicks of all readable lines."""
    return split_record(lines, text_places).where(_readable()).select(*FIELDS)


def rejected_lines(lines: DataFrame, text_places: bool = False) -> DataFrame:
    """The lines :func:`parse_clicks` leaves out."""
    return split_record(lines, text_places).where(~_readable()).select("value")


def click_records(clicks: DataFrame) -> DataFrame:
    """Clicks written as lines, the inverse of :func:`parse_clicks`."""
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return clicks.select(F.concat_ws(" ", millis.cast("string"), *[F.col(c).cast("string") for c in FIELDS[1:]])
                         .alias("value"))


def text_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """New lines of the text files that appear in a folder, oldest file first."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def starting_offsets(topic: str, offsets: dict[int, int]) -> str:
    """Saved offsets per partition in the form the Kafka source takes as ``startingOffsets``."""
    return json.dumps({topic: {str(p): o for p, o in sorted(offsets.items())}})


def kafka_options(servers: str, topic: str, start: str | dict[int, int] = "latest",
                  max_per_trigger: int | None = None) -> dict[str, str]:
    """Options of the Kafka source.

    A new query starts at ``start``: the latest records, the earliest ones or saved offsets; a
    restarted query goes on from its checkpoint whatever ``start`` says.  Offsets that Kafka no
    longer keeps move up to the earliest it has (``failOnDataLoss`` off).
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start if isinstance(start, str) else starting_offsets(topic, start),
        "failOnDataLoss": "false",
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str, start: str | dict[int, int] = "latest",
                 max_per_trigger: int | None = None) -> DataFrame:
    """Lines of a Kafka topic; needs the Spark Kafka connector on the class path."""
    return (spark.readStream.format("kafka").options(**kafka_options(servers, topic, start, max_per_trigger))
            .load().select(F.col("value").cast("string").alias("value")))
