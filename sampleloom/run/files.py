"""Files of any store that Spark can reach, through the Hadoop file system interface."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Store:
    """Whole files and folders by path; paths without a scheme belong to the default file system."""

    def __init__(self, spark: SparkSession) -> None:
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, path: object):
        p = self._jvm.org.apache.hadoop.fs.Path(str(path))
        return p.getFileSystem(self._conf), p

    def exists(self, path: object) -> bool:
        fs, p = self._path(path)
        return fs.exists(p)

    def is_folder(self, path: object) -> bool:
        fs, p = self._path(path)
        return fs.exists(p) and fs.getFileStatus(p).isDirectory()

    def delete(self, path: object) -> None:
        fs, p = self._path(path)
        fs.delete(p, True)

    def make_folder(self, path: object) -> None:
        fs, p = self._path(path)
        fs.mkdirs(p)

    def move(self, source: object, target: object) -> None:
        """Rename a file or folder; what is at ``target`` goes first."""
        fs, s = self._path(source)
        if not fs.exists(s):
            raise FileNotFoundError(str(source))
        self.delete(target)
        if not fs.rename(s, self._path(target)[1]):
            raise OSError(f"{source} could not be moved to {target}")

    def files(self, path: object) -> list[str]:
        """Data files below a folder in the order of their names, or the file itself."""
        fs, p = self._path(path)
        if not fs.getFileStatus(p).isDirectory():
            return [str(path)]
        found, it = [], fs.listFiles(p, True)
        while it.hasNext():
            f = it.next().getPath()
            if not f.getName().startswith((".", "_")):
                found.append(f.toString())
        return sorted(found)

    def sha256(self, path: object) -> str:
        """Hash of a file, or of the names and hashes of the data files of a folder, read as streams."""
        digest = self._jvm.org.apache.commons.codec.digest.DigestUtils
        if not self.is_folder(path):
            fs, p = self._path(path)
            stream = fs.open(p)
            try:
                return digest.sha256Hex(stream)
            finally:
                stream.close()
        return digest.sha256Hex("".join(f"{f.rpartition('/')[2]}\0{self.sha256(f)}\n" for f in self.files(path)))

    def write_text(self, path: object, text: str) -> None:
        fs, p = self._path(path)
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def publish(self, staged: dict[str, object], folder: object, marker: str) -> None:
        """Move staged files or folders into ``folder``: the old marker goes first, the new one comes last; without it a bundle is not whole."""
        if marker not in staged:
            raise ValueError("the marker must be among the staged files")
        self.make_folder(folder)
        final = f"{folder}/{marker}"
        self.delete(final)
        try:
            for name in [*(n for n in staged if n != marker), marker]:
                self.move(staged[name], f"{folder}/{name}")
        except BaseException:
            self.delete(final)
            raise
