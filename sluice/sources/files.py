"""File-system helpers on the Hadoop FileSystem API (works for HDFS, object stores, local)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def split_existing(spark: SparkSession, paths) -> tuple[list[str], list[str]]:
    """Partition input paths (globs allowed) into existing and missing ones."""
    found, missing = [], []
    for p in ([paths] if isinstance(paths, str) else list(paths)):
        fs, hp = _fs_and_path(spark, p)
        statuses = fs.globStatus(hp)
        (found if statuses is not None and len(statuses) > 0 else missing).append(p)
    return found, missing


def list_files(spark: SparkSession, folder: str, suffix: str = "") -> list[str]:
    """Plain files directly in ``folder`` (no recursion), as fully qualified URIs."""
    fs, hp = _fs_and_path(spark, folder)
    if not fs.exists(hp):
        return []
    out = []
    for st in fs.listStatus(hp):
        name = st.getPath().getName()
        if st.isFile() and name.endswith(suffix) and not name.startswith(("_", ".")):
            out.append(st.getPath().toString())
    return sorted(out)


def list_folders(spark: SparkSession, folder: str) -> list[str]:
    """Folders directly in ``folder``, as fully qualified URIs."""
    fs, hp = _fs_and_path(spark, folder)
    if not fs.exists(hp):
        return []
    return sorted(st.getPath().toString() for st in fs.listStatus(hp) if st.isDirectory())


def make_folder(spark: SparkSession, folder: str) -> None:
    fs, hp = _fs_and_path(spark, folder)
    fs.mkdirs(hp)


def rename(spark: SparkSession, src: str, dst: str) -> None:
    """Rename; a file of that name in the target folder is replaced (a re-sent input)."""
    fs, s = _fs_and_path(spark, src)
    _, d = _fs_and_path(spark, dst)
    fs.mkdirs(d.getParent())
    if not s.equals(d) and fs.exists(s) and fs.exists(d):
        fs.delete(d, False)
    if not fs.rename(s, d):
        raise OSError(f"rename failed: {src} -> {dst}")


def move_to(spark: SparkSession, src: str, folder: str) -> str:
    """Move one file into ``folder`` keeping its name (inbound → processed / error)."""
    fs, s = _fs_and_path(spark, src)
    dst = folder.rstrip("/") + "/" + s.getName()
    rename(spark, src, dst)
    return dst


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs_and_path(spark, path)
    fs.delete(p, True)


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified, decoded form of a path or an encoded URI (``inputFiles()`` or a
    stream's ``path``): the same text :func:`sluice.functions.lineage.decoded_path` gives
    for a scan's ``_metadata.file_path``."""
    jvm = spark.sparkContext._jvm
    try:
        hp = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
    except Exception:  # noqa: BLE001 - not a valid URI (e.g. a plain path with spaces)
        hp = jvm.org.apache.hadoop.fs.Path(path)
    fs = hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(hp).toString()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file unless one of that name is there; whether it did. The file appears
    with its whole content (a rename that never replaces)."""
    fs, target = _fs_and_path(spark, path)
    fs.mkdirs(target.getParent())
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    _, draft = _fs_and_path(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(text.encode())
    out.close()
    kind = jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
    options = gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 1)
    options[0] = kind.getField("NONE").get(None)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(draft, target, options)
        return True
    except Exception as exc:  # noqa: BLE001 - told apart below
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(exc):
            return False
        raise


# --- the same on executors, where there is no JVM to ask ----------------------------------
#: Schemes whose files tasks can rename through pyarrow.
TASK_SCHEMES = ("file", "hdfs", "s3", "s3a", "s3n", "gs", "abfs", "abfss")


def scheme_of(path: str) -> str:
    return path.split(":", 1)[0].lower() if ":" in path.split("/", 1)[0] else "file"


def task_fs(path: str):
    """``(file system, path in it)`` of a plain (decoded) path, for use inside a task."""
    from pyarrow import fs

    scheme = scheme_of(path)
    if scheme == "file":
        plain = path[5:] if path.lower().startswith("file:") else path
        return fs.LocalFileSystem(), "/" + plain.lstrip("/")
    if scheme in ("s3a", "s3n"):
        path = "s3" + path[path.index(":"):]
    host, _, rest = path.split("://", 1)[1].partition("/")
    if scheme == "hdfs":
        return fs.FileSystem.from_uri(f"hdfs://{host}/")[0], "/" + rest
    found, root = fs.FileSystem.from_uri(path.split("://", 1)[0] + f"://{host}")
    return found, f"{root.rstrip('/')}/{rest}"


def task_version(path: str) -> tuple[int, int] | None:
    """Length and modification time (ns) of a file; None where there is none."""
    files, at = task_fs(path)
    info = files.get_file_info(at)
    return (info.size, info.mtime_ns or 0) if info.is_file else None


def task_move(src: str, dst: str) -> None:
    """Rename inside a task; a file of that name is replaced."""
    files, at = task_fs(src)
    _, to = task_fs(dst)
    folder, _, name = at.rpartition("/")
    files.create_dir(to.rpartition("/")[0], recursive=True)
    if scheme_of(src) == "file":
        # Hadoop's checksum of a local file goes along, or would be held against the next file
        crc, to_crc = (f"{f}/.{name}.crc" for f in (folder, to.rpartition("/")[0]))
        if files.get_file_info(crc).is_file:
            files.move(crc, to_crc)
        elif files.get_file_info(to_crc).is_file:
            files.delete_file(to_crc)
    elif files.get_file_info(to).is_file:
        files.delete_file(to)
    files.move(at, to)
