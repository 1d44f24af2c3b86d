"""Which referenced files exist, and which files a folder holds.

Paths that a table names are probed where they are, in parallel tasks over the
distinct paths: any suffix, hidden names and places outside the base are found,
and no folder listing passes through the driver.  An inventory table can be
given instead wherever one is at hand.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from manifestqc.session import materialize

PROBE_ROWS = 1000


def default_file_system(spark: SparkSession) -> str:
    """The session's default file system without its trailing slash, empty for the local one."""
    name = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or ""
    return "" if name.startswith("file:") else name.rstrip("/")


def qualified(spark: SparkSession, folder: str) -> str:
    """A folder as an absolute path: relative ones against the working folder of the default file system.

    Local results have no scheme, like the paths in manifests.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    full = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return full.removeprefix("file://").removeprefix("file:")


def is_folder(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


#: Names by which other systems know a scheme of the file-system library.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "wasb": "abfs", "wasbs": "abfss"}


def known_uri(uri: str) -> str:
    """A URI under the scheme that the file-system library knows; plain paths stay."""
    scheme, sep, rest = uri.partition("://")
    return f"{SCHEMES.get(scheme, scheme)}://{rest}" if sep else uri


def file_system(uri: str):
    """``(file system, path)`` of a folder or file as a task sees it, for local paths and URIs of any known scheme."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(known_uri(uri) if "://" in uri else uri.replace("file:", "", 1))


class FileSystems:
    """File systems by their root, each opened once in a task."""

    def __init__(self, default: str = ""):
        self.default, self.held = default, {}

    def locate(self, name: str):
        """``(file system, path)`` of a name; plain paths are in the default file system."""
        from pyarrow import fs
        uri = name if "://" in name else self.default + name
        scheme, sep, rest = known_uri(uri).partition("://")
        root = f"{scheme}{sep}{rest.partition('/')[0]}" if sep and scheme != "file" else ""
        if root not in self.held:
            self.held[root] = fs.FileSystem.from_uri(root + "/")[0] if root else fs.LocalFileSystem()
        if not sep:
            return self.held[root], uri
        if scheme == "file":
            return self.held[root], rest
        return self.held[root], rest if scheme in ("s3", "gs") else "/" + rest.partition("/")[2]


def existing_files(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """The distinct ``path`` values that exist; plain paths are looked up in the default file system."""
    default = default_file_system(paths.sparkSession)

    def probe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs
        systems = FileSystems(default)
        for pdf in frames:
            for i in range(0, len(pdf), PROBE_ROWS):
                names = pdf["path"].iloc[i:i + PROBE_ROWS]
                found = []
                for name in names:
                    where, path = systems.locate(name)
                    found.append(where.get_file_info(path).type != fs.FileType.NotFound)
                yield pd.DataFrame({"path": names[found]})

    distinct = paths.select(F.col(path_col).alias("path")).where("path is not null and path <> ''").distinct()
    return distinct.mapInPandas(probe, "path string")


LISTED = "path string, is_folder boolean, length long"


def _entries(where, path: str) -> Iterator[tuple[str, bool, int | None]]:
    """Entries of one folder, a local one without holding them all; links to folders are no folders (they may lead round)."""
    import os

    from pyarrow import fs
    if isinstance(where, fs.LocalFileSystem):
        with os.scandir(path) as entries:
            for e in entries:
                if e.is_dir(follow_symlinks=False):
                    yield e.name, True, None
                elif e.is_file():
                    yield e.name, False, e.stat().st_size
    else:
        for e in where.get_file_info(fs.FileSelector(path)):
            yield e.base_name, e.type == fs.FileType.Directory, e.size


def listed(spark: SparkSession, directory: str, recursive: bool = True) -> DataFrame:
    """``(path, length)`` of every file below a folder, whatever its name.

    Breadth first: a table of folders is dealt out and listed in tasks, which gives files
    and the next table of folders, until none is left.  Every level is a
    checkpointed table; no list of files or folders is held by the driver."""
    default = default_file_system(spark)

    def expand(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        systems = FileSystems(default)
        names = [c.split()[0] for c in LISTED.split(", ")]
        for pdf in frames:
            for folder in pdf["path"]:
                where, path = systems.locate(folder)
                rows: list[tuple] = []
                for name, is_folder_, size in _entries(where, path):
                    rows.append((f"{folder.rstrip('/')}/{name}", is_folder_, size))
                    if len(rows) >= 100 * PROBE_ROWS:
                        yield pd.DataFrame(rows, columns=names).astype({"length": "Int64"})
                        rows = []
                yield pd.DataFrame(rows, columns=names).astype({"length": "Int64"})

    if not is_folder(spark, directory):
        raise FileNotFoundError(f"no folder {directory}")
    frontier = spark.createDataFrame([(qualified(spark, directory),)], "path string")
    files = None
    while True:
        parts = max(1, min(frontier.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))))
        level = materialize(frontier.repartition(parts, "path").mapInPandas(expand, LISTED))
        found = level.where("not is_folder").select("path", "length")
        files = found if files is None else files.unionByName(found)
        frontier = level.where("is_folder").select("path")
        if not recursive or frontier.isEmpty():
            return files
