"""A small file that says which folders of a result count, replaced as a whole.

``<path>/_manifest.json`` holds the committed entries, oldest first, and ``<path>/data`` their folders, each
written once under a name of its own.  A write is visible from the moment the new manifest replaces the old one
(one rename), so a reader sees either all of it or nothing, and folders that a stopped job left behind are never
read.  A folder that is no longer named is removed ``keep`` commits later, so that readers that have just read
the manifest before do not lose their files.  One writer at a time per path.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

NAME = "_manifest.json"


def _folders(entries: list[dict]) -> set[str]:
    """Folders that entries name, those of what belongs to an entry included."""
    return {part["folder"] for e in entries for part in (e, *(v for v in e.values() if isinstance(v, dict)))
            if "folder" in part}


class Manifest:
    def __init__(self, spark: SparkSession, path: str, keep: int = 2):
        self.spark, self.path, self.keep = spark, path.rstrip("/"), keep
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()

    def _place(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}")

    def _files(self):
        return self._place(NAME).getFileSystem(self._conf)

    def _content(self) -> dict:
        files = self._files()
        if not files.exists(self._place(NAME)):
            return {"entries": [], "retired": []}
        stream = files.open(self._place(NAME))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def entries(self) -> list[dict]:
        return self._content()["entries"]

    def write(self, df: DataFrame, name: str) -> dict:
        """Write ``df`` into a new folder; the entry for it, which does not count before ``commit``."""
        folder = f"data/{name}-{uuid.uuid4().hex[:12]}"
        df.write.parquet(f"{self.path}/{folder}")
        return {"folder": folder, "schema": df.schema.json()}

    def read(self, entry: dict) -> DataFrame:
        schema = StructType.fromJson(json.loads(entry["schema"]))
        return self.spark.read.schema(schema).parquet(f"{self.path}/{entry['folder']}")

    def commit(self, entries: list[dict]) -> None:
        """Make ``entries`` the content; folders no longer named go, those named until now after ``keep`` commits."""
        old = self._content()
        named = _folders(entries)
        retired = [[f, age + 1] for f, age in old["retired"] if f not in named]
        retired += [[f, 0] for f in sorted(_folders(old["entries"]) - named)]
        retired = [r for r in retired if r[1] < self.keep]
        self._replace(json.dumps({"entries": entries, "retired": retired}))
        self._prune(named | {f for f, _ in retired})

    def _replace(self, text: str) -> None:
        files, part = self._files(), self._place(f"{NAME}.{uuid.uuid4().hex[:8]}")
        stream = files.create(part, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        rename = getattr(self._hadoop, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        self._hadoop.FileContext.getFileContext(part.toUri(), self._conf).rename(part, self._place(NAME), options)

    def _prune(self, kept: set[str]) -> None:
        files = self._files()
        if files.exists(self._place("data")):
            for status in files.listStatus(self._place("data")):
                if f"data/{status.getPath().getName()}" not in kept:
                    files.delete(status.getPath(), True)
