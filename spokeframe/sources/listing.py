"""Which trip files a bucket offers, from its XML listing, and which are still to be fetched."""

from pyspark.sql import functions as F

from spokeframe.schemas import FILE_LISTING

# Fixed value: keys of the trip files.
TRIP_FILE = "^usage-stats/.*csv$"


def read_listing(spark, path):
    """One row per entry of a bucket listing."""
    return spark.read.schema(FILE_LISTING).xml(path, rowTag="Contents")


def write_listing(listing, path):
    """A listing in the layout ``read_listing`` takes."""
    listing.select(*FILE_LISTING.names).write.format("xml").options(
        rootTag="ListBucketResult", rowTag="Contents"
    ).save(path)


def file_manifest(listing, base_url):
    """Key, local file name and source address of every trip file."""
    base = F.element_at(F.split("Key", "/"), -1)
    return listing.where(F.col("Key").rlike(TRIP_FILE)).select(
        F.col("Key").alias("key"),
        F.replace(base, F.lit(" "), F.lit("_")).alias("file_name"),
        F.concat(F.lit(base_url), "Key").alias("url"),
    )


def new_files(manifest, landed):
    """Manifest rows whose ``file_name`` is not among those already landed."""
    return manifest.join(landed.select("file_name"), "file_name", "left_anti")
