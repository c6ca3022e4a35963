"""JSON and text documents in any file system that Spark reaches."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir`` that driver and executors share.

    Only a local session without one gets a temporary folder; on a cluster that would be a folder of one machine.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="velora-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


class ObjectStore:
    """Small documents under a root; every call goes through Hadoop's file systems, so the root may be local or remote."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _path(self, key: str):
        path = self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{key}")
        return path, path.getFileSystem(self._conf)

    def put_text(self, key: str, text: str) -> None:
        """Written beside and renamed over the old document in one step, so a reader always sees the old one or the new one."""
        path, fs = self._path(key)
        beside, _ = self._path(f".{key.rsplit('/', 1)[-1]}.{uuid.uuid4().hex}.tmp" if "/" not in key else f"{key.rsplit('/', 1)[0]}/.{key.rsplit('/', 1)[1]}.{uuid.uuid4().hex}.tmp")
        out = fs.create(beside, True)
        out.write(bytearray(text.encode()))
        out.close()
        over = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        over[0] = self._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        whole = fs.makeQualified(path)
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(whole.toUri(), self._conf).rename(fs.makeQualified(beside), whole, over)

    def put_new(self, key: str, text: str) -> None:
        """Written beside and renamed in one step to a name that nobody has taken yet; FileExistsError if somebody has."""
        folder, _, name = key.rpartition("/")
        path, fs = self._path(key)
        beside_key = f"{folder}/.{name}.{uuid.uuid4().hex}.tmp" if folder else f".{name}.{uuid.uuid4().hex}.tmp"
        self.put_text(beside_key, text)
        none = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        whole, beside = fs.makeQualified(path), fs.makeQualified(self._path(beside_key)[0])
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(whole.toUri(), self._conf).rename(beside, whole, none)
        except Exception as e:  # py4j wraps the Java exception, whose kind depends on the file system
            self.delete(beside_key)
            if fs.exists(path):
                raise FileExistsError(key) from e
            raise

    def get_text(self, key: str) -> str | None:
        path, fs = self._path(key)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_json(self, key: str, value) -> None:
        self.put_text(key, json.dumps(value, ensure_ascii=False, sort_keys=True))

    def get_json(self, key: str):
        text = self.get_text(key)
        return None if text is None else json.loads(text)

    def keys(self, prefix: str = "") -> list[str]:
        """Names of files and folders directly under a prefix, in order."""
        path, fs = self._path(prefix)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def files(self, prefix: str = "") -> list[tuple[str, int, float]]:
        """Path below the prefix, size and time in seconds of all data files under it, whatever their depth."""
        path, fs = self._path(prefix)
        out, found = [], fs.listFiles(path, True) if fs.exists(path) else None
        while found is not None and found.hasNext():
            s = found.next()
            own = str(s.getPath().toUri().getPath())[len(str(fs.makeQualified(path).toUri().getPath())) :].lstrip("/")
            if not any(part.startswith(".") or (part.startswith("_") and "=" not in part) for part in own.split("/")):
                out.append((own, int(s.getLen()), s.getModificationTime() / 1000))
        return sorted(out)

    def delete(self, key: str) -> None:
        path, fs = self._path(key)
        fs.delete(path, True)

    def rename(self, old: str, new: str) -> bool:
        a, fs = self._path(old)
        b, _ = self._path(new)
        fs.mkdirs(b.getParent())
        return fs.rename(a, b)

    def exists(self, key: str) -> bool:
        path, fs = self._path(key)
        return fs.exists(path)
