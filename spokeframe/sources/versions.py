"""Tables that are replaced whole: readers see the old rows until all new ones are written.

A table is a folder with one subfolder per version and a small file that names the current one. A
replacement is written beside the current version, and only when the job has ended does the file name
the new one, by one rename. A write that fails half-way leaves a folder that nothing names.
"""

import uuid

CURRENT = "_current"
_VERSION = "v-"


def _file_system(spark, path):
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    return made.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def current_version(spark, path):
    """The folder of the current version; ``path`` itself where the table has no versions."""
    files, of = _file_system(spark, path)
    named = of(f"{path}/{CURRENT}")
    if not files.exists(named):
        return path
    stream = files.open(named)
    try:
        name = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return f"{path}/{name.strip()}"


def new_version(path):
    """A folder for the next version, not yet named by the table."""
    return f"{path}/{_VERSION}{uuid.uuid4().hex}"


def make_current(spark, path, version):
    """Name ``version`` the current one.

    Versions that are neither it nor its predecessor, which readers may still be at, are deleted,
    those of failed writes among them; a table has one writer at a time.
    """
    before = current_version(spark, path).rsplit("/", 1)[-1]
    name = version.rsplit("/", 1)[-1]
    files, of = _file_system(spark, path)
    staged = of(f"{path}/{CURRENT}-{name}")
    stream = files.create(staged, True)
    try:
        stream.write(bytearray(name.encode()))
    finally:
        stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.getUri(), spark._jsc.hadoopConfiguration())
    overwrite = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark.sparkContext._gateway.new_array(
        spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = overwrite
    context.rename(staged, of(f"{path}/{CURRENT}"), options)
    for status in files.listStatus(of(path)):
        found = status.getPath().getName()
        if found.startswith(_VERSION) and found not in (before, name):
            files.delete(status.getPath(), True)
