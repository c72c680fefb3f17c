"""Writers. All of them write in parallel; a single file is made only on request."""

import re

from pyspark.sql import DataFrame

from parcelframe.session import work_folder

_FORMATS = ("csv", "parquet")
_CSV = {"header": "true", "encoding": "UTF-8", "escape": '"'}


def write_table(
    df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite", partition_by=(), single_file=False
) -> None:
    if fmt not in _FORMATS:
        raise ValueError(f"unsupported format {fmt!r}, expected one of {_FORMATS}")
    if single_file:
        df = df.coalesce(1)
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.options(**_CSV)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_clean(df: DataFrame, path: str, fmt: str = "csv", single_file: bool = False) -> None:
    """The cleaned table, replacing what was there."""
    write_table(df, path, fmt, "overwrite", single_file=single_file)


def append_details(details: DataFrame, path: str, fmt: str = "csv") -> None:
    """Add detail rows to those already stored; every part file carries its own header."""
    write_table(details, path, fmt, "append")


def write_reports(reports: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    """One table per chart below ``folder``."""
    for name, df in reports.items():
        write_table(df, f"{folder.rstrip('/')}/{name}", fmt)


def write_single_csv(df: DataFrame, path: str) -> None:
    """One headered CSV file at ``path``, replacing what was there, though all tasks write at the same time.

    The parts are written without a header to the shared folder and then copied behind one another, in the order of the
    partitions, by a stream of small buffers; so the table's own stages keep their tasks, and nothing is held in memory. The
    file appears under its name once it is whole.
    """
    spark = df.sparkSession
    parts = work_folder(spark, "csv-parts")
    df.write.options(**{**_CSV, "header": "false"}).csv(parts)
    heading = work_folder(spark, "csv-heading")
    # A row of the names, by the same writer, so that names are quoted as fields are.
    spark.createDataFrame([tuple(df.columns)], [f"c{i}" for i in range(len(df.columns))]).coalesce(1).write.options(
        **{**_CSV, "header": "false"}
    ).csv(heading)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop
    target = hadoop.fs.Path(path)
    system = target.getFileSystem(conf)
    fresh = hadoop.fs.Path(target.getParent(), f"_{target.getName()}.writing")
    out = system.create(fresh, True)
    try:
        for part in [*_parts(spark, heading), *_parts(spark, parts)]:
            read = part.getFileSystem(conf).open(part)
            try:
                hadoop.io.IOUtils.copyBytes(read, out, conf, False)
            finally:
                read.close()
    finally:
        out.close()
    files = hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(files.makeQualified(fresh), files.makeQualified(target), options)


def _parts(spark, folder: str) -> list:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    listed = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(place)
    found = [s.getPath() for s in listed if s.getPath().getName().startswith("part-")]
    return sorted(found, key=lambda p: [int(n) for n in re.findall(r"^part-([0-9]+)-|-c([0-9]+)", p.getName()) for n in n if n])


def replace_partitions(df: DataFrame, path: str, partition_by, fmt: str = "parquet") -> None:
    """Writes a table in a folder per value; values that the table holds are replaced, the files of all others stay as they are.

    Rows are brought together by value first, so that a value has few files; adaptive execution splits a value of many rows
    over several tasks.
    """
    writer = df.hint("rebalance", *partition_by).write.mode("overwrite").format(fmt).partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.options(**_CSV)
    writer.option("partitionOverwriteMode", "dynamic").save(path)
