"""Scans of the given parquet tables.

Columns are selected right at the scan so ``ReadSchema`` is pruned even
before Catalyst's own column pruning runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes under ``path`` from one file-system summary call (no data read)."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(jpath).getLength())


class Files:
    """Names, moves and deletes in the file system of a path (nothing is read or written)."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, folder: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(folder))) if self.exists(folder) else []

    def data_files(self, folder: str, below: str = "") -> list[str]:
        """Paths under ``folder`` of its files, without Spark's markers."""
        out = []
        for s in self._fs.listStatus(self._path(f"{folder}/{below}")) if self.exists(f"{folder}/{below}") else []:
            name = below + s.getPath().getName()
            if s.isDirectory():
                out += self.data_files(folder, f"{name}/")
            elif not s.getPath().getName().startswith(("_", ".")):
                out.append(name)
        return out

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def move(self, path: str, to: str) -> None:
        target = self._path(to)
        self._fs.mkdirs(target.getParent())
        if not self._fs.rename(self._path(path), target):
            raise OSError(f"{path} could not be moved to {to}")


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Scan a given table, pruned to ``columns``; its splits are the reader's own."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
