"""Folders listed by tasks: names, sizes and times, of empty files too.

No file is opened and no name passes through the driver. A scan leaves out files without
a byte; a listing does not. The first level is listed by one task; the folders found there
are dealt to tasks, each of which walks all below.
"""

from __future__ import annotations

import datetime as dt
import fnmatch
import re
from collections.abc import Iterator, Mapping
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

FILE = "arquivo"
LISTED = f"{FILE} string, nome string, tamanho bigint, modificado_em timestamp, pasta boolean"
_ARROW = pa.schema(
    [
        (FILE, pa.string()), ("nome", pa.string()), ("tamanho", pa.int64()),
        ("modificado_em", pa.timestamp("us", tz="UTC")), ("pasta", pa.bool_()),
    ]
)
_BATCH = 10_000
_NOT_IN_PATHS = re.compile(r'[\x00-\x20"#%<>?\[\\\]^`{|}\x7f]')
#: The value of a partition whose column is NULL.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, written as scans write it."""
    if not re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
        path = default.rstrip("/") + path
    return re.sub("^file:/+", "file:/", path.rstrip("/"))


def _uri(prefix: str, path: str) -> str:
    """A path as scans name it: characters that no path may hold are escaped."""
    return prefix + _NOT_IN_PATHS.sub(lambda m: f"%{ord(m[0]):02X}", path)


def _open(folder: str) -> tuple[pafs.FileSystem, str, str]:
    """File system, path in it, and what comes before such paths in full names."""
    if folder.startswith("file:"):
        return pafs.LocalFileSystem(), folder.removeprefix("file:"), "file:"
    files, path = pafs.FileSystem.from_uri(folder)
    return files, path, folder[: len(folder) - len(path)] if folder.endswith(path) else ""


def _seen(name: str, folder: bool) -> bool:
    """Whether a scan looks at it: hidden names are skipped; folders are partitions."""
    return not name.startswith(("_", ".")) and (not folder or "=" in name)


def _list(folder: str) -> Iterator[dict]:
    files, path, prefix = _open(folder)
    for info in files.get_file_info(pafs.FileSelector(path)):
        is_folder = info.type == pafs.FileType.Directory
        if _seen(info.base_name, is_folder):
            yield {
                FILE: info.path if is_folder else _uri(prefix, info.path),
                "nome": info.base_name,
                "tamanho": None if is_folder else info.size,
                "modificado_em": info.mtime or dt.datetime.fromtimestamp(0, dt.timezone.utc),
                "pasta": is_folder,
                "_full": prefix + info.path,
            }


def _walk(folder: str, deep: bool) -> Iterator[dict]:
    for entry in _list(folder):
        full = entry.pop("_full")
        if entry["pasta"]:
            entry[FILE] = full
        yield entry
        if deep and entry["pasta"]:
            yield from _walk(full, deep)


def _tasks(deep: bool):
    def run(batches):
        held = []
        for batch in batches:
            for folder in batch[FILE].to_pylist():
                for entry in _walk(folder, deep):
                    held.append(entry)
                    if len(held) == _BATCH:
                        yield pa.RecordBatch.from_pylist(held, _ARROW)
                        held = []
        yield pa.RecordBatch.from_pylist(held, _ARROW)

    return run


def _roots(spark: SparkSession, path: str | list[str]) -> DataFrame:
    paths = [path] if isinstance(path, str) else path
    return spark.createDataFrame([(qualified(spark, p),) for p in paths], f"{FILE} string")


def _pattern(glob: str) -> str:
    """A regular expression for a glob as scans take it: ``{a,b}`` is one of these."""
    choice = re.search(r"\{([^{}]*)\}", glob)
    if choice:
        before, after = glob[: choice.start()], glob[choice.end() :]
        return "|".join(_pattern(before + one + after) for one in choice[1].split(","))
    return "^" + fnmatch.translate(glob).removeprefix("(?s:").removesuffix(r")\Z") + "$"


def listed_files(spark: SparkSession, path: str | list[str], glob: str = "*") -> DataFrame:
    """Path, name, size and time of the files a scan of the folders would look at,
    and of those without a byte: directly in them and in partition folders."""
    first = _roots(spark, path).mapInArrow(_tasks(deep=False), LISTED)
    folders = first.filter("pasta").select(FILE).repartition(FILE)
    every = first.unionByName(folders.mapInArrow(_tasks(deep=True), LISTED))
    return every.filter(~F.col("pasta") & F.col("nome").rlike(_pattern(glob))).drop("pasta")


def _parts(depth: int):
    """Folders one level down, with the values of their path's partitions."""

    def run(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                for entry in _list(row["_at"]):
                    name, _, value = entry["nome"].partition("=")
                    if entry["pasta"]:
                        value = None if value == NULL_PARTITION else unquote(value)
                        values = [*row["_values"], {"nome": name, "valor": value}]
                        rows.append({"_at": entry["_full"], "_values": values})
            schema = pa.schema([("_at", pa.string()), ("_values", _VALUES)])
            yield pa.RecordBatch.from_pylist(rows, schema)

    return run


_VALUES = pa.list_(pa.struct([("nome", pa.string()), ("valor", pa.string())]))
_LEVEL = "_at string, _values array<struct<nome:string,valor:string>>"


def partition_folders(
    spark: SparkSession, path: str, partitions: Mapping[str, str]
) -> DataFrame:
    """The partitions of a table from its folder names, one row each.

    ``partitions`` gives names and types from the top folder down. A folder without
    rows is a partition too.
    """
    root = [(qualified(spark, path), [])]
    level = spark.createDataFrame(root, _LEVEL)
    for depth in range(len(partitions)):
        level = (level.repartition("_at") if depth else level).mapInArrow(_parts(depth), _LEVEL)
    for k, name in enumerate(partitions):
        level = level.filter(F.col("_values")[k]["nome"] == F.lit(name))
    return level.select(
        *[
            F.col("_values")[k]["valor"].cast(kind).alias(name)
            for k, (name, kind) in enumerate(partitions.items())
        ]
    ).distinct()
