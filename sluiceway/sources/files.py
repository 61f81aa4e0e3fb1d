"""Paths on any file system that Spark knows, through Hadoop's interface; the local one by Python's own calls."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

#: Hadoop's classes for the local file system; the second comes with Hive's libraries.
_LOCAL = ("org.apache.hadoop.fs.LocalFileSystem", "org.apache.hadoop.hive.ql.io.ProxyLocalFileSystem")


class Folder:
    """A folder of small control files, shared by all that have its path."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.root = root.rstrip("/")
        path = spark._jvm.org.apache.hadoop.fs.Path  # kept, since looking up a class takes longer than most calls
        fs = path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        local = fs.getClass().getName() in _LOCAL
        self._on = _Local(fs.makeQualified(path(self.root)).toUri().getPath()) if local else _Hadoop(spark, fs, path, self.root)

    def at(self, name: str) -> str:
        return _at(self.root, name)

    def exists(self, name: str) -> bool:
        return self._on.exists(name)

    def names(self, name: str = "") -> list[str]:
        return self._on.names(name)

    def make(self, name: str) -> None:
        self._on.make(name)

    def delete(self, name: str) -> bool:
        return self._on.delete(name)

    def age_ms(self, name: str) -> int:
        """Milliseconds since it was written; 0 if it isn't there."""
        return self._on.age_ms(name)

    def claim(self, to: str, stale_ms: int = 600_000) -> bool:
        """Whether the caller, alone of several writers, may make the target now; it has to release() it then.

        A claim that is older than stale_ms and has no target is one of a writer that died.
        """
        if self.exists(to):
            return False
        claim = _claim(to)
        if not self.create_new(claim):
            if self.exists(to) or self.age_ms(claim) < stale_ms:
                return False
            self.delete(claim)
            if not self.create_new(claim):
                return False
        if self.exists(to):
            self.delete(claim)
            return False
        return True

    def release(self, to: str) -> None:
        self.delete(_claim(to))

    def move(self, name: str, to: str) -> bool:
        """Renames to a target that the caller has claimed; whether it did."""
        return self._on.rename(name, to)

    def move_new(self, name: str, to: str, stale_ms: int = 600_000) -> bool:
        """Renames unless the target is there; whether it did. Of several writers one succeeds: that which creates the target's claim."""
        if not self.claim(to, stale_ms):
            return False
        try:
            return self.move(name, to)
        finally:
            self.release(to)

    def create_new(self, name: str) -> bool:
        """Creates an empty file unless it is there; whether it did. Only one of several callers does."""
        try:
            self._on.create_new(name)
        except Exception as e:  # also the JVM's own kind of error
            if isinstance(e, FileExistsError) or "FileAlreadyExists" in str(e) or self.exists(name):  # it may be gone again by now
                return False
            raise OSError(f"{self.at(name)} can't be created") from e
        return True

    def write(self, name: str, data: bytes) -> None:
        self._on.write(name, data)


def _claim(to: str) -> str:
    return f".{to.replace('/', '-')}.claim"


def _at(root: str, name: str) -> str:
    return f"{root}/{name}" if name else root


class _Hadoop:
    """What a Folder does on any file system. Each call is some round trips to the JVM."""

    def __init__(self, spark: SparkSession, fs, path, root: str) -> None:
        self._fs, self._to_path, self._root = fs, path, root
        self._files, self._predef = spark._jvm.org.apache.hadoop.fs.FileUtil, spark._jvm.scala.Predef

    def _path(self, name: str):
        return self._to_path(_at(self._root, name))

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def names(self, name: str) -> list[str]:
        if not self.exists(name):
            return []
        found = self._predef.genericWrapArray(self._files.stat2Paths(self._fs.listStatus(self._path(name)))).mkString("\0")  # all at once, not some calls for each
        return [p.rpartition("/")[2] for p in found.split("\0") if p]

    def make(self, name: str) -> None:
        self._fs.mkdirs(self._path(name))

    def delete(self, name: str) -> bool:
        return self._fs.delete(self._path(name), True)

    def age_ms(self, name: str) -> int:
        if not self.exists(name):
            return 0
        return int(time.time() * 1000) - self._fs.getFileStatus(self._path(name)).getModificationTime()

    def rename(self, name: str, to: str) -> bool:
        return self._fs.rename(self._path(name), self._path(to))

    def create_new(self, name: str) -> None:
        self._fs.create(self._path(name), False).close()

    def write(self, name: str, data: bytes) -> None:
        out = self._fs.create(self._path(name), True)
        try:
            out.write(bytearray(data))
        finally:
            out.close()


class _Local:
    """The same on the driver's own file system.

    Hadoop's class for it looks first and creates then, where this is one step, and starts a process
    for the mode of each new file. It leaves a checksum file beside each file, which has to go with it.
    """

    def __init__(self, root: str) -> None:
        self._root = root

    def _path(self, name: str) -> str:
        return _at(self._root, name)

    def exists(self, name: str) -> bool:
        return os.path.exists(self._path(name))

    def names(self, name: str) -> list[str]:
        try:
            return [n for n in os.listdir(self._path(name)) if not (n.startswith(".") and n.endswith(".crc"))]
        except FileNotFoundError:
            return []

    def make(self, name: str) -> None:
        os.makedirs(self._path(name), exist_ok=True)

    def delete(self, name: str) -> bool:
        path = self._path(name)
        if os.path.isdir(path) and not os.path.islink(path):
            shutil.rmtree(path, ignore_errors=True)
            return not os.path.exists(path)
        self._drop(_checksums(path))
        return self._drop(path)

    def age_ms(self, name: str) -> int:
        try:
            return int((time.time() - os.stat(self._path(name)).st_mtime) * 1000)
        except FileNotFoundError:
            return 0

    def rename(self, name: str, to: str) -> bool:
        os.rename(self._path(name), self._path(to))
        return True

    def create_new(self, name: str) -> None:
        path = self._path(name)
        try:
            open(path, "xb").close()
        except FileNotFoundError:
            os.makedirs(os.path.dirname(path), exist_ok=True)
            open(path, "xb").close()

    def write(self, name: str, data: bytes) -> None:
        path = self._path(name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        self._drop(_checksums(path))
        with open(path, "wb") as out:
            out.write(data)

    def _drop(self, path: str) -> bool:
        try:
            os.unlink(path)
        except FileNotFoundError:
            return False
        return True


def _checksums(path: str) -> str:
    return f"{os.path.dirname(path)}/.{os.path.basename(path)}.crc"


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths that are there, asked for in parallel; for a batch's bounded list."""
    conf = spark._jsc.hadoopConfiguration()
    hadoop = spark._jvm.org.apache.hadoop.fs.Path

    def there(path: str) -> bool:
        return hadoop(path).getFileSystem(conf).exists(hadoop(path))

    with ThreadPoolExecutor(32) as pool:
        return [p for p, ok in zip(paths, pool.map(there, paths), strict=True) if ok]


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir).

    Only a session whose executors are the driver's own threads may lack the setting: it then
    gets a temporary folder. A cluster without the setting is refused, since a folder of one
    machine would lose data there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="sluiceway-")
        spark.conf.set("spark.checkpoint.dir", root)
    own = f"{root.rstrip('/')}/sluiceway-{spark.sparkContext.applicationId}"
    if own not in _OWN:
        _OWN.add(own)
        atexit.register(_forget, Folder(spark, own))
    return f"{own}/{uuid.uuid4().hex}"


_OWN: set[str] = set()


def _forget(folder: Folder) -> None:
    """Deletes an application's scratch folder when it ends; if the JVM ended first, the folder stays."""
    try:
        folder.delete("")
    except Exception:  # noqa: BLE001 py4j's kinds of error, and those of its sockets
        pass
