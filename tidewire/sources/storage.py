"""Files on any file system that Spark reaches, through Hadoop's FileSystem."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else one in the warehouse."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (known or spark.conf.get("spark.sql.warehouse.dir") + "/_staged").rstrip("/")


class Storage:
    """File operations by path; the path's scheme picks the file system, local without one."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def files(self, path: str, suffixes: tuple[str, ...] = ()) -> list[str]:
        """Paths of the files in a folder, not below it, in order; all suffixes if none is given."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return []
        found = [s.getPath().toString() for s in fs.listStatus(p) if s.isFile()]
        return sorted(f for f in found if not suffixes or f.endswith(tuple(suffixes)))

    def size(self, path: str) -> int:
        """Bytes of a file or of everything in a folder."""
        fs, p = self._at(path)
        return fs.getContentSummary(p).getLength() if fs.exists(p) else 0

    def open(self, path: str) -> bytes:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        fs, p = self._at(path)
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def upload(self, source: str, target: str, delete: bool = False) -> bool:
        fs, p = self._at(source)
        to, q = self._at(target)
        return self._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, p, to, q, delete, self._conf)

    def move(self, source: str, target: str) -> bool:
        """Rename within a file system, copy and delete between a remote and a local one; refuses two remote ones."""
        fs, p = self._at(source)
        to, q = self._at(target)
        if fs.getUri().toString() == to.getUri().toString():
            to.mkdirs(q.getParent())
            return fs.rename(p, q)
        if "file" not in (fs.getUri().getScheme(), to.getUri().getScheme()):
            raise ValueError(f"cannot move between file systems: {source} to {target}")
        return self.upload(source, target, delete=True)

    def delete(self, path: str, recursive: bool = False) -> bool:
        fs, p = self._at(path)
        return fs.exists(p) and fs.delete(p, recursive)

    def delete_on_exit(self, path: str) -> str:
        """Delete the path when the application ends; returns it."""
        fs, p = self._at(path)
        fs.deleteOnExit(p)
        return path

    def mkdir(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.mkdirs(p)

    def chmod(self, path: str, mode: str) -> None:
        fs, p = self._at(path)
        fs.setPermission(p, self._jvm.org.apache.hadoop.fs.permission.FsPermission(mode))

    def chown(self, path: str, owner: str, group: str) -> None:
        fs, p = self._at(path)
        fs.setOwner(p, owner, group)

    def expired(self, path: str, days: int, suffixes: tuple[str, ...] = (), now: datetime | None = None) -> list[str]:
        """Files in a folder that were last changed more than ``days`` ago."""
        limit = ((now or datetime.now(timezone.utc)) - timedelta(days=days)).timestamp() * 1000
        fs, _ = self._at(path)
        return [f for f in self.files(path, suffixes) if fs.getFileStatus(self._jvm.org.apache.hadoop.fs.Path(f)).getModificationTime() < limit]
