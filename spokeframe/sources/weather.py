"""Monthly weather: fixed-layout text and CSV."""

from pyspark.sql import functions as F

from spokeframe.schemas import WEATHER

# Characters of a reading, and the marks that may follow one.
READING = "^[0-9.-]+$"
LAST_READING = "^[0-9.-]+"


def read_weather_text(spark, path):
    return spark.read.text(path)


def parse_weather(lines, keep_sign=True, keep_marked=False):
    """Typed rows of the data lines (column ``value``); the others are dropped.

    A data line is indented and has seven fields between blanks: year and month in digits, then five
    readings. What follows the last reading is ignored. A mark on an earlier one drops the line, as
    the published series do with provisional months; ``keep_marked`` keeps it, without the mark.

    A missing reading is written as hyphens. ``keep_sign`` blanks only those; without it every
    hyphen goes, which also turns a frost of -4.4 into 4.4.
    """
    names = WEATHER.names
    # The first field is the empty text before the indent.
    fields = lines.select(F.split("value", r"\s+").alias("f"), "value")
    fields = fields.where((F.col("f")[0] == "") & (F.size("f") > len(names))).select(
        *(F.col("f")[i + 1].alias(name) for i, name in enumerate(names)))
    *marked, last = names[2:]
    sound = F.col("year").rlike("^[0-9]+$") & F.col("month").rlike("^[0-9]+$")
    for name in names[2:]:
        sound &= F.col(name).rlike(LAST_READING if keep_marked or name == last else READING)

    def typed(column):
        text = F.regexp_extract(column.name, LAST_READING, 0)
        text = F.regexp_replace(text, "^-+$", "") if keep_sign else F.replace(text, F.lit("-"))
        return text.try_cast(column.dataType).alias(column.name)

    return fields.where(sound).select(*map(typed, WEATHER))


def write_weather_csv(weather, path):
    weather.select(*WEATHER.names).write.csv(path, header=True)


def read_weather_csv(spark, path):
    return spark.read.csv(path, schema=WEATHER, header=True)
