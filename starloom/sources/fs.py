"""Path existence, deletion and listing through Hadoop's FileSystem, whatever
scheme the path has. An error there is an error here: nothing is looked up on the
driver's own disk, and a path that cannot be asked about is never "missing"."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(sc._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop(spark, path)
    if fs.exists(p) and not fs.delete(p, True):
        raise OSError(f"could not delete {path}")


def size(spark: SparkSession, path: str) -> int:
    """Bytes of the file, or of all files below the folder, ``path``; 0 if there is none."""
    p, fs = _hadoop(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly below ``path``."""
    p, fs = _hadoop(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _hadoop(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small file; an existing one is an error."""
    p, fs = _hadoop(spark, path)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename ``source`` to ``target`` in one step; False (and no change) if the target exists."""
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    src, dst = hadoop.Path(source), hadoop.Path(target)
    context = hadoop.FileContext.getFileContext(src.getFileSystem(sc._jsc.hadoopConfiguration()).getUri(), sc._jsc.hadoopConfiguration())
    try:
        context.rename(src, dst, sc._gateway.new_array(hadoop.Options.Rename, 0))
    except Exception as e:
        if exists(spark, target):
            return False
        raise OSError(f"could not rename {source} to {target}") from e
    return True


def move(spark: SparkSession, source: str, target: str) -> None:
    """Move a file or directory below an existing folder."""
    p, fs = _hadoop(spark, source)
    t, _ = _hadoop(spark, target)
    fs.mkdirs(t.getParent())
    if not fs.rename(p, t):
        raise OSError(f"could not move {source} to {target}")


def state(spark: SparkSession, path: str) -> str:
    """A digest of the names, sizes and modification times of all files below ``path``."""
    import hashlib

    p, fs = _hadoop(spark, path)
    listed = fs.listFiles(p, True)
    files = []
    while listed.hasNext():
        st = listed.next()
        files.append(f"{st.getPath()}\t{st.getLen()}\t{st.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest()
