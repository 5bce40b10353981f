"""A corpus is a folder of text files, one document each, named after its id."""

from __future__ import annotations

import bz2
import gzip
import os
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import RDD, TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F


# The file name without its extension.
NAME = r"([^/]*?)(?:\.[^./]*)?$"
# A task passes on so many bytes of texts, or so many of them, at a time.
BATCH_BYTES, BATCH_FILES = 8 << 20, 1_000
# So many ids of several rows are told from the others by a broadcast.
REPEATED_IDS = 20_000
NOT_IN_PATHS = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


def read_corpus(
    spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text", id_pattern: str = NAME
) -> DataFrame:
    """One row per file: the whole content, and the id that the first group of
    ``id_pattern`` finds in the file's path (default: the name without extension).

    As in Spark's reader, folders are followed, empty files and names beginning with ``.`` or ``_``
    (unless they hold ``=``) passed over, and compressed files are known by their extension; ``.lz4``
    and ``.snappy`` raise an error. That reader keeps a list of all files on the driver (640 to 800
    bytes of heap for each), so here tasks list a folder and read its files. Only what is no folder
    that Python can open (a pattern, a list, one file, a store that only Hadoop knows) is left to it.
    """
    folder = _folder(spark, path)
    if folder is None:
        texts = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
        files = texts.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
    else:
        # The listing is no DataFrame: Spark would take the size of the paths for that of the texts.
        paths = spark.createDataFrame(_paths(spark, folder).map(lambda p: (p,)), "path string", verifySchema=False)
        files = paths.mapInArrow(_read_files(folder), "file string, text binary").select("file", F.col("text").cast("string"))
    name = F.regexp_extract(F.url_decode("file"), id_pattern, 1)
    return files.select(name.alias(id_col), F.col("text").alias(text_col))


def _folder(spark: SparkSession, path: str) -> str | None:
    """The path with its file system, if it is a folder that can be opened here."""
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")
    if isinstance(path, str) and path.startswith("/") and not default.startswith("file:"):
        path = default.rstrip("/") + path
    try:
        store, root = open_store(path)
        return path if store.get_file_info(root).type == fs.FileType.Directory else None
    except (pa.ArrowException, OSError, TypeError, AttributeError):
        return None


def _paths(spark: SparkSession, folder: str) -> RDD:
    """Paths of the files below a folder, dealt out by hash. One task lists the folder itself, all
    tasks what is below its folders."""
    tasks = _tasks(spark)

    def dealt(found: RDD) -> RDD:
        return found.map(lambda x: (zlib.crc32(x[0].encode("utf-8", "surrogatepass")), x)).partitionBy(tasks, int).values()

    def top(_: int) -> Iterable[tuple[str, bool]]:
        store, root = open_store(folder)
        return _children(store, root)

    def below(found: Iterator[tuple[str, bool]]) -> Iterator[tuple[str, bool]]:
        store, _ = open_store(folder)
        for path, is_folder in found:
            if not is_folder:
                yield path, False
                continue
            ahead = [path]
            while ahead:
                for child, is_folder in _children(store, ahead.pop()):
                    if is_folder:
                        ahead.append(child)
                    else:
                        yield child, False

    first = spark.sparkContext.parallelize([0], 1).flatMap(top)
    return dealt(dealt(first).mapPartitions(below)).map(lambda x: x[0])


def _tasks(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _children(store: fs.FileSystem, folder: str) -> Iterator[tuple[str, bool]]:
    """The folders and files, that are not empty, in a folder: their paths and which are folders."""
    if isinstance(store, fs.LocalFileSystem):  # one by one, however many there are
        with os.scandir(folder) as entries:
            for e in entries:
                if not _hidden(e.name, e.is_dir()) and (e.is_dir() or e.is_file() and e.stat().st_size):
                    yield e.path, e.is_dir()
    else:
        for info in store.get_file_info(fs.FileSelector(folder)):
            is_folder = info.type == fs.FileType.Directory
            if not _hidden(info.base_name, is_folder) and (is_folder or info.type == fs.FileType.File and info.size != 0):
                yield info.path, is_folder


def _hidden(name: str, is_folder: bool) -> bool:
    """What Spark's readers pass over."""
    if is_folder and name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _read_files(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        above = "file:" if isinstance(store, fs.LocalFileSystem) else folder.partition(root)[0]
        names, texts, held = [], [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.binary())], names=["file", "text"])

        for path in (p for b in batches for p in b["path"].to_pylist()):
            with store.open_input_stream(path, compression=None) as stream:
                text = _unpacked(path, stream.read())
            if texts and (held + len(text) > BATCH_BYTES or len(texts) == BATCH_FILES):
                yield batch()
                names, texts, held = [], [], 0
            names.append(above + quote(path, safe="/+", errors="surrogateescape"))
            texts.append(text)
            held += len(text)
        if texts:
            yield batch()

    return run


def _unpacked(path: str, content: bytes) -> bytes:
    kind = os.path.splitext(path)[1].lower().removeprefix(".")
    if kind in ("lz4", "snappy"):
        raise ValueError(f"{path}: texts packed as {kind} are not read")
    if kind == "zst":
        return pa.CompressedInputStream(pa.BufferReader(content), "zstd").read()
    unpack = {"gz": gzip.decompress, "bz2": bz2.decompress, "deflate": zlib.decompress}.get(kind)
    return unpack(content) if unpack else content


def write_corpus(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """One file per id, ``<id_col>=<id>.txt``, holding the text and a final line break.

    Rows that share an id share its file, in the order of their texts. Many small files cost time
    per file and per folder, not per byte: so each task writes its files straight into one folder of
    its own. A file appears under its name when it is whole, so a repeated task leaves what the
    first one did. ``path`` must be new and one that all executors reach.

    The ids are counted first. Rows whose id is their own are written by the tasks that read them;
    only the others are brought together, over a fixed number of tasks, or all rows where more than
    REPEATED_IDS ids have several. So ``df`` is read twice and must give the same ids both times.
    """
    spark = df.sparkSession
    tasks = _tasks(spark)
    store, root = open_store(path)
    if store.get_file_info(root).type != fs.FileType.NotFound:
        raise FileExistsError(path)
    rows = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("key", F.coalesce("id", F.lit("")))
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeated = [(r["key"],) for r in counts.select("key").limit(REPEATED_IDS + 1).collect()]
    alone, shared = rows, rows
    if 0 < len(repeated) <= REPEATED_IDS:
        known = F.broadcast(spark.createDataFrame(repeated, "key string"))
        alone, shared = rows.join(known, "key", "left_anti"), rows.join(known, "key", "left_semi")
    shared = shared.repartition(tasks, "key").sortWithinPartitions("key", "id", "text")
    store.create_dir(root, recursive=True)
    for part in [alone] * (len(repeated) <= REPEATED_IDS) + [shared] * (len(repeated) > 0):
        part.select("id", "text").mapInArrow(_write_files(path, id_col), "files long").agg(F.sum("files")).collect()


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI; executors reach the same files by it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path)


def _write_files(path: str, id_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(path)
        context = TaskContext.get()
        folder = f"{root}/{context.partitionId():05d}"
        hidden = f"{folder}/_{uuid.uuid4().hex}"  # no reader takes a name that begins so
        files, current, out = 0, None, None

        def close() -> None:
            if out is not None:
                out.close()
                store.move(hidden, f"{folder}/{id_col}={_escaped(current)}.txt")

        for batch in batches:
            for key, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist()):
                if out is None or (key or "") != (current or ""):
                    if out is None:
                        store.create_dir(folder, recursive=True)
                    close()
                    current, out, files = key, store.open_output_stream(hidden, compression=None), files + 1
                out.write((text or "").encode("utf-8", "surrogatepass") + b"\n")
        close()
        yield pa.RecordBatch.from_arrays([pa.array([files], pa.int64())], names=["files"])

    return run


def _escaped(key: str | None) -> str:
    """An id as Spark writes it into a path."""
    if not key:
        return "__HIVE_DEFAULT_PARTITION__"
    return NOT_IN_PATHS.sub(lambda m: f"%{ord(m[0]):02X}", key)


def attach_corpus(
    df: DataFrame, corpus: DataFrame, id_col: str, text_col: str = "text", as_col: str = "full_text"
) -> DataFrame:
    """The full text next to every record: one scan of the corpus and one join.

    Records without a file keep a null text; :func:`missing_texts` lists them."""
    texts = corpus.select(id_col, F.col(text_col).alias(as_col))
    return df.join(texts, id_col, "left")


def missing_texts(df: DataFrame, corpus: DataFrame, id_col: str) -> DataFrame:
    """Ids that have records but no file."""
    return df.select(id_col).distinct().join(corpus.select(id_col), id_col, "left_anti")
