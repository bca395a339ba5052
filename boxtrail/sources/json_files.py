"""JSON payload files, read with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from boxtrail.sources.listing import FILE, listed_files

#: Plain files and compressed ones.
JSON_GLOB = "*.[jJ][sS][oO][nN]{,.gz,.snappy}"
CORRUPT = "_corrupt_record"
#: Ends no line of a JSON text, which has no such character. A file is one line then.
NO_LINE_END = "\0boxtrail: nenhum fim de linha\0"
#: Bytes on disk of a file that is read as one line at most. Its text may be twenty times as long.
AS_ONE_LINE = 8 << 20
_PATH = "_metadata.file_path"


def _reader(spark: SparkSession, multi_line: bool, glob: str = JSON_GLOB):
    return (
        spark.read.option("multiLine", multi_line)
        .option("pathGlobFilter", glob)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def scan_json(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    *,
    multi_line: bool = True,
    diagnostics: bool = False,
    glob: str = JSON_GLOB,
) -> DataFrame:
    """Read JSON documents; absent fields are NULL and nested objects in text
    fields keep their JSON text.

    ``multi_line`` is for pretty-printed files and arrays. Such a file is read by
    one task, and Spark packs many small ones into a task. Files with one document
    per line read faster without it, as Spark can split them unless they are
    compressed. ``diagnostics`` adds the file's path and, where a document
    does not fit the schema, its text.

    With ``diagnostics`` a multi-line file up to ``AS_ONE_LINE`` is read as one line,
    so that its text is in memory. Else, for the text, Spark reads a file again for each
    row of an array that does not fit, and keeps the buffers of all these streams until
    the task ends. The rows are the same. Larger files are parsed as they are read.
    """
    reader = _reader(spark, multi_line, glob)
    if not diagnostics:
        return reader.schema(schema).json(path)
    df = reader.schema(with_corrupt(schema)).json(path)
    if multi_line:
        lines = reader.option("multiLine", False).option("lineSep", NO_LINE_END).json(path)
        small = F.col("_metadata.file_size") <= AS_ONE_LINE
        columns = [*df.columns, F.col(_PATH).alias(FILE)]
        return lines.filter(small).select(columns).union(df.filter(~small).select(columns))
    return df.withColumn(FILE, F.col(_PATH))


def scan_envelope(
    spark: SparkSession,
    path: str | list[str],
    element: T.StructType,
    key: str = "animais",
    *,
    multi_line: bool = True,
    diagnostics: bool = False,
) -> DataFrame:
    """Read ``{key: [...]}`` documents, one row per element.

    Documents without the key give no rows. With ``diagnostics`` a document
    that cannot be read gives one row holding only its text and path.
    """
    schema = envelope(element, key)
    if not diagnostics:
        return _reader(spark, multi_line).schema(schema).json(path).select(F.inline(key))
    docs = scan_json(spark, path, schema, multi_line=multi_line, diagnostics=True)
    return open_envelope(docs, element, key)


def envelope(element: T.StructType, key: str = "animais") -> T.StructType:
    return T.StructType([T.StructField(key, T.ArrayType(element))])


def open_envelope(docs: DataFrame, element: T.StructType, key: str = "animais") -> DataFrame:
    """Rows of documents read with diagnostics."""
    blank = F.array(F.lit(None).cast(element))
    items = F.when(F.col(CORRUPT).isNull(), F.col(key)).otherwise(blank)
    rows = docs.select(CORRUPT, FILE, F.explode(items).alias("_e"))
    return rows.select(*[F.col(f"_e.{f.name}") for f in element], CORRUPT, FILE)


def list_files(
    spark: SparkSession, path: str | list[str], glob: str | None = None, recursive: bool = False
) -> DataFrame:
    """Path, name, size and time of files; their content is not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path)
    return files.select(
        F.col(_PATH).alias(FILE),
        F.col("_metadata.file_name").alias("nome"),
        F.col("length").alias("tamanho"),
        F.col("modificationTime").alias("modificado_em"),
    )


def pending_files(
    spark: SparkSession, path: str | list[str], glob: str = JSON_GLOB
) -> DataFrame:
    """JSON files directly in the folder, whatever the case of the suffix."""
    return list_files(spark, path, glob)


def every_file(spark: SparkSession, path: str | list[str], glob: str = JSON_GLOB) -> DataFrame:
    """Pending JSON files, those without a single byte too, which no scan returns."""
    return listed_files(spark, path, glob)
