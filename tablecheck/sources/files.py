"""File sources and sinks: JSON document directories and file manifests.

Two layouts of JSON documents are read:

* ``mode="document"``: one document per file (``text`` with ``wholetext``);
  small files are packed into splits by Spark's file index.
* ``mode="lines"``: JSON Lines, one document per line; splittable, the
  layout to use at scale.

DataFrame file sources skip zero-length files, while a per-file check must
count an empty file as an invalid document.  ``scan_json_files`` therefore
adds them as rows with a NULL value: the file index's own listing minus the
files that have content (``zero_length_files``).  The listing is the one that
Spark's driver keeps for any scan of the folder; its names go from the JVM to
the scratch folder, never into a plan, and are compared by a sort-merge join
(files hold few bytes, so their size says nothing of how many names a broadcast
would bring to the driver).  Hidden names (``_x``, ``.x``) are excluded, as
Spark does; ``hidden_file_count`` says how many there are.

The driver holds the listing of a folder as long as a plan reads it, some KB a
file.  A directory of very many documents is therefore a tree of folders
(``write_json_documents(..., folders=True)``), and ``scan_json_files(...,
recursive=True)`` lists it some folders at a time: their documents and names go
to the scratch folder before the next ones are listed, so the driver holds no
more of a large tree than of a small one.
"""

from __future__ import annotations

import gc
from contextlib import contextmanager
from typing import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Files that one task writes in the file-per-document layout (a file costs milliseconds, whatever it holds).
FILES_PER_TASK = 500
#: Files of a sub-folder that ``write_json_documents`` makes, and of a tree that are listed at once.
FILES_PER_FOLDER = 20_000
_FOLDER_COLUMN = "document_folder"
#: While a tree is read: small files are packed by what opening one costs (32 KB, a millisecond; by Spark's 4 MB a task
#: has a few files, and the driver keeps a record of each task), no listing outlives its plan in Spark's cache, and paths
#: are looked up by so many tasks (Spark's default is 10,000, mostly one per file).
_TREE_CONF = {"spark.sql.files.openCostInBytes": "32768", "spark.sql.hive.filesourcePartitionFileCacheSize": "0",
              "spark.sql.sources.parallelPartitionDiscovery.parallelism": "200"}

FILE_COLUMNS = ["file_path", "file_name", "file_size", "value"]


def _fs(spark: SparkSession, path: str):
    """Hadoop ``FileSystem`` and ``Path`` on a classic session, else None
    (Spark Connect exposes no JVM)."""
    try:
        sc = spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(sc._jsc.hadoopConfiguration()), p
    except Exception:  # noqa: BLE001 - Spark Connect: no sparkContext
        return None


def directory_status(spark: SparkSession, path: str) -> DataFrame:
    """``(path, exists, is_directory)`` for one path (driver metadata call).

    Without a JVM (Spark Connect) the answer comes from a listing probe:
    a path that lists as more than itself is a directory.
    """
    handle = _fs(spark, path)
    if handle is not None:
        fs, p = handle
        exists = bool(fs.exists(p))
        is_dir = bool(exists and fs.getFileStatus(p).isDirectory())
    else:
        from pyspark.errors import AnalysisException
        try:
            first = spark.read.format("binaryFile").load(path).select("path").limit(1).collect()
            exists = True
            # a file lists as itself (maybe with a scheme prefix), a directory as its children
            is_dir = not first or not first[0]["path"].rstrip("/").endswith(path.rstrip("/"))
        except AnalysisException:
            exists, is_dir = False, False
    return spark.createDataFrame([(path, exists, is_dir)], "path string, exists boolean, is_directory boolean")


def _norm_path(c):
    """``file:///x`` and ``file:/x`` name the same file; other schemes are kept."""
    return F.regexp_replace(c, r"^file:(//)?(?=/)", "file:")


def _listed(spark: SparkSession, directory: str, glob: str) -> tuple[DataFrame, DataFrame]:
    """The files with content as ``binaryFile`` gives them, and ``(file_uri, decoded)`` of all files:
    one listing for both."""
    listed = spark.read.option("pathGlobFilter", glob).format("binaryFile").load(directory)
    # inputFiles() gives URIs (a space is %20), as _metadata does; the binaryFile
    # path is decoded.  Match on the decoded form, report the URI form.
    decoded = F.url_decode(F.replace("uri", F.lit("+"), F.lit("%2B")))
    return listed, _listed_uris(spark, listed).select(_norm_path(F.col("uri")).alias("file_uri"), _norm_path(decoded).alias("decoded"))


def zero_length_files(spark: SparkSession, directory: str, glob: str = "*.json") -> DataFrame:
    """``(file_path, file_name)`` of the zero-length ``glob`` files of a directory.

    File scans skip empty files, but the file index lists them: its listing
    (``inputFiles()``, one call) minus the ``binaryFile`` listing (content
    pruned, so no file is opened) leaves the empty ones.
    """
    listed, every = _listed(spark, directory, glob)
    non_empty = listed.select(_norm_path(F.col("path")).alias("decoded"))
    empty = every.join(non_empty.hint("merge"), "decoded", "left_anti")
    return empty.select(F.col("file_uri").alias("file_path"), F.element_at(F.split("file_uri", "/"), -1).alias("file_name"))


def _listed_uris(spark: SparkSession, listed: DataFrame) -> DataFrame:
    """``uri`` of each listed file, stored once: no plan holds the list."""
    return stored(spark, _uris(spark, listed), "listed_files")


def _uris(spark: SparkSession, listed: DataFrame) -> DataFrame:
    """``uri`` of each listed file; on a classic session the list is not brought to Python."""
    try:
        jvm = spark.sparkContext._jvm
    except Exception:  # noqa: BLE001 - Spark Connect: no JVM handle
        return spark.createDataFrame([(p,) for p in listed.inputFiles()], "uri string")
    names = jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(listed._jdf.inputFiles())
    return DataFrame(spark._jsparkSession.createDataset(names, jvm.org.apache.spark.sql.Encoders.STRING()).toDF(), spark).toDF("uri")


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the scratch folder and read back."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hidden_file_count(spark: SparkSession, directory: str) -> int | None:
    """Files of a folder whose names start with ``_`` or ``.`` (scans leave them out);
    None where the file system cannot be asked."""
    handle = _fs(spark, directory)
    if handle is None:
        return None
    fs, _ = handle
    found = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{directory.rstrip('/')}/[_.]*"))
    return 0 if found is None else len(found)


def file_manifest(spark: SparkSession, directory: str, glob: str = "*.json") -> DataFrame:
    """``(file_path, file_name, file_size, modification_time)`` of all files, empty ones too
    (size 0, no modification time).

    Paths are ``binaryFile``'s (decoded, ``a b.json``); document scans use the
    URI form of ``_metadata`` (``a%20b.json``).

    ``binaryFile`` without its ``content`` column lists files without reading
    them; Spark parallelises the listing of large directory trees.
    """
    return _manifest(spark, directory, glob).drop("file_uri")


def stored_manifest(spark: SparkSession, directory: str, glob: str = "*.json") -> DataFrame:
    """``file_manifest`` and ``file_uri`` (the form of document scans), taken once for all
    checks of a folder: the driver keeps no listing for them."""
    return stored(spark, _manifest(spark, directory, glob), "file_manifest")


def _manifest(spark: SparkSession, directory: str, glob: str) -> DataFrame:
    listed, every = _listed(spark, directory, glob)
    found = listed.select(_norm_path(F.col("path")).alias("decoded"), "path", "length", "modificationTime")
    path = F.coalesce("path", "decoded")
    return every.join(found.hint("merge"), "decoded", "left").select(
        path.alias("file_path"), F.element_at(F.split(path, "/"), -1).alias("file_name"),
        F.coalesce("length", F.lit(0).cast("bigint")).alias("file_size"),
        F.col("modificationTime").alias("modification_time"), "file_uri")


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings are ``values`` meanwhile."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _hidden(name: str) -> bool:
    """Names that Spark leaves out of a listing."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _tree_parts(spark: SparkSession, directory: str) -> Iterator[tuple[list[str], bool]]:
    """Files and sub-folders of a directory, so many at once that they hold at most
    ``FILES_PER_FOLDER`` files or are one sub-folder (a plan over the directory lists
    all below it), and True: these are no patterns.  Without a JVM (Spark Connect),
    the whole at once."""
    handle = _fs(spark, directory)
    paths, files = [], 0
    if handle is not None and handle[0].exists(handle[1]):
        fs, p = handle
        found = fs.listStatusIterator(p)
        while found.hasNext():
            status = found.next()
            path = status.getPath()
            if _hidden(path.getName()):
                continue
            more = fs.getContentSummary(path).getFileCount() if status.isDirectory() else 1
            if paths and files + more > FILES_PER_FOLDER:
                yield paths, True
                paths, files = [], 0
            paths.append(path.toString())
            files += more
    yield (paths, True) if paths else ([directory], False)


def _file_columns(df: DataFrame) -> DataFrame:
    """A text scan's ``FILE_COLUMNS``."""
    return df.select(_norm_path(F.col("_metadata.file_path")).alias("file_path"),
                     F.col("_metadata.file_name").alias("file_name"),
                     F.col("_metadata.file_size").alias("file_size"), F.col("value"))


def _tree_documents(spark: SparkSession, directory: str, glob: str) -> tuple[DataFrame, DataFrame]:
    """The documents of a tree's files with content, and ``(file_path, file_name)`` of
    the zero-length ones: both stored part by part, each part listed once."""
    docs_path, uris_path = scratch_path(spark, "documents"), scratch_path(spark, "listed_files")
    reader = spark.read.option("pathGlobFilter", glob).option("wholetext", True).option("recursiveFileLookup", True)

    def store(paths: list[str], listed: bool) -> None:
        df = reader.option("__globPaths__", not listed).text(paths)
        uris = _uris(spark, df).select(_norm_path(F.col("uri")).alias("file_path"))
        uris.write.mode("append").parquet(uris_path)
        _file_columns(df).write.mode("append").parquet(docs_path)

    with _settings(spark, _TREE_CONF):
        for paths, listed in _tree_parts(spark, directory):
            store(paths, listed)
            # Python's handles of Java objects refer to themselves: until they are collected, the JVM keeps the listing
            gc.collect()
    docs = spark.read.schema("file_path string, file_name string, file_size bigint, value string").parquet(docs_path)
    every = spark.read.schema("file_path string").parquet(uris_path)
    empty = every.join(docs.select("file_path").hint("merge"), "file_path", "left_anti")
    return docs, empty.select("file_path", F.element_at(F.split("file_path", "/"), -1).alias("file_name"))


def scan_json_files(spark: SparkSession, directory: str, glob: str = "*.json", mode: str = "document",
                    include_empty: bool = True, manifest: DataFrame | None = None,
                    recursive: bool = False) -> DataFrame:
    """Documents of a directory: ``file_path, file_name, file_size, value``
    (paths and names in the URI form of Spark's ``_metadata`` columns).

    Sub-folders are read when ``recursive``; in document mode the tree is then
    read at once, some folders at a time, into the scratch folder, and what is
    returned reads that.

    Zero-length files appear with a NULL ``value`` when ``include_empty``
    (document mode); they come from ``manifest`` (of ``stored_manifest``) if given.
    In lines mode a document is identified by its content (the text source
    exposes no line numbers), blank lines are skipped.
    """
    if mode not in ("document", "lines"):
        raise ValueError("mode must be 'document' or 'lines'")
    reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", recursive)
    empty = None
    if mode == "lines":
        out = _file_columns(reader.text(directory)).filter(F.length(F.trim("value")) > 0)
    elif recursive:
        out, empty = _tree_documents(spark, directory, glob)
    else:
        out = _file_columns(reader.option("wholetext", True).text(directory))
    if include_empty and mode == "document":
        if manifest is None:
            empty = zero_length_files(spark, directory, glob) if empty is None else empty
        else:
            empty = manifest.filter("file_size = 0").select(
                F.col("file_uri").alias("file_path"), F.element_at(F.split("file_uri", "/"), -1).alias("file_name"))
        empties = empty.select(
            "file_path", "file_name", F.lit(0).cast("bigint").alias("file_size"),
            F.lit(None).cast("string").alias("value"))
        out = out.unionByName(empties)
    return out


def write_json_documents(df: DataFrame, directory: str, one_per_file: bool = False,
                         mode: str = "overwrite", folders: bool = False) -> None:
    """Write each row as one JSON document in ``*.json`` files.

    NULL fields are left out of a document (the JSON writer's default).
    ``one_per_file`` uses ``maxRecordsPerFile=1`` for the file-per-document
    layout, in tasks of about ``FILES_PER_TASK`` files (a small table is one
    partition, however many files it becomes); otherwise JSON Lines, one file
    per partition.  ``folders`` deals one file per document out over sub-folders
    of about ``FILES_PER_FOLDER`` files, a task's files into one of them.
    """
    if folders and not one_per_file:
        raise ValueError("folders needs one_per_file")
    if folders and _FOLDER_COLUMN in [c.lower() for c in df.columns]:
        raise ValueError(f"{_FOLDER_COLUMN} names the folders, it cannot be a key of the documents")
    if one_per_file:
        tasks = -(-df.count() // FILES_PER_TASK)
        df = df.repartition(tasks) if tasks > 1 else df
    if folders:
        tasks_per_folder = max(1, FILES_PER_FOLDER // FILES_PER_TASK)
        df = df.withColumn(_FOLDER_COLUMN, F.floor(F.spark_partition_id() / tasks_per_folder))
    w = df.write.mode(mode)
    if one_per_file:
        w = w.option("maxRecordsPerFile", 1)
    if folders:
        w = w.partitionBy(_FOLDER_COLUMN)
    w.json(directory)
