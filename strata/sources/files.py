"""File sources: delimited text by contract, Parquet, nested JSON.

Paths are resolved by Spark's file sources, so the same code works on local
disk, HDFS and object stores.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.contracts import Contract, apply_contract, check_columns

# ---- fixed values: the accident files' text format ---------------------------
CSV_SEP = ";"
CSV_ENCODING = "iso-8859-1"   # Spark 4 rejects the alias "latin1"


def missing_paths(spark: SparkSession, paths: list[str]) -> list[str]:
    """Paths (or globs) that match no file; an empty folder has none. Resolving
    a file source lists the path through the session's Hadoop file system (local,
    HDFS, object stores) without reading any content. Other errors (no access, no
    such store) are raised."""
    from pyspark.errors import AnalysisException
    out = []
    for p in paths:
        try:
            found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(p)
                     .where(~F.element_at(F.split("path", "/"), -1).rlike("^[._]")).select("length"))
            if found.isEmpty():
                out.append(p)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            out.append(p)
    return out


def file_bytes(spark: SparkSession, path: str, glob: str | None = None) -> int:
    """Bytes on disk of the files under ``path`` (optionally matching ``glob``):
    a listing through the binaryFile source, which reads no file content when
    only ``length`` is selected."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return int(reader.load(path).agg(F.sum("length")).first()[0] or 0)


def check_sources(spark: SparkSession, paths: list[str]) -> None:
    """Fail once, naming every missing input."""
    missing = missing_paths(spark, paths)
    if missing:
        raise FileNotFoundError("missing input file(s): " + ", ".join(missing))


def readable_path(uri: str) -> str:
    """A path for a reader from a file's URI: decoded, and with the signs of globs escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def first_line(spark: SparkSession, uri: str, encoding: str) -> str | None:
    """The first line of a file (unpacked by its suffix), null for an empty one; no more than a buffer is read."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        line = jvm.org.apache.hadoop.io.Text()
        size = jvm.org.apache.hadoop.util.LineReader(codec.createInputStream(stream) if codec else stream).readLine(line)
        return bytes(line.copyBytes()).decode(encoding, "replace") if size else None
    finally:
        stream.close()


def _first_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the rows (value, file) that the probe reads, one a file, those of files that have a line."""
    for b in batches:
        yield b.filter(b.column("value").is_valid())


def header_layouts(spark: SparkSession, path: str, encoding: str) -> dict[str, list[str]]:
    """Header line -> files that begin with it. One file needs no reading; in a folder the first line of each file is
    read, so what is read does not grow with the files' sizes, and a gzip file is unpacked up to there only.
    Files of one layout are the path as it was given."""
    listed = spark.read.format("binaryFile").load(path).inputFiles()
    if len(listed) < 2:
        return {"": [path]}
    with ThreadPoolExecutor(16) as readers:
        first = readers.map(lambda uri: first_line(spark, uri, encoding), listed)
    read = (pa.RecordBatch.from_arrays([pa.array([line], pa.string()), pa.array([uri])], ["value", "file"]) for uri, line in zip(listed, first, strict=True))
    layouts: dict[str, list[str]] = {}
    for b in _first_rows(read):
        for r in b.to_pylist():
            layouts.setdefault(r["value"], []).append(readable_path(r["file"]))
    return {"": [path]} if len(layouts) < 2 else {h: sorted(files) for h, files in layouts.items()}


def read_text_table(spark: SparkSession, path: str, sep: str = CSV_SEP,
                    encoding: str = CSV_ENCODING, header: bool = True) -> DataFrame:
    """Delimited text, every column as STRING, bound by each file's own header:
    files of a folder may differ in column order, and a column that a file does
    not have is NULL in its rows."""
    reader = (spark.read.option("header", header).option("sep", sep).option("encoding", encoding)
              .option("inferSchema", False).option("mode", "PERMISSIVE").option("enforceSchema", False))
    if not header:
        return reader.csv(path)
    out = None
    for _, paths in sorted(header_layouts(spark, path, encoding).items()):
        part = reader.csv(paths)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def read_csv_contract(spark: SparkSession, path: str, contract: Contract, **opts) -> DataFrame:
    """Delimited text bound to ``contract`` by header name, then typed."""
    raw = read_text_table(spark, path, **opts)
    check_columns(raw, contract)
    return apply_contract(raw, contract)


def read_csv_text_contract(spark: SparkSession, path: str, contract: Contract, **opts) -> DataFrame:
    """Same binding by name, but every column kept as text (for cleaning
    rules that must see the raw cell, e.g. blank keys). The contract's columns come
    first; the file's other columns are carried along."""
    raw = read_text_table(spark, path, **opts)
    check_columns(raw, contract)
    return raw.select(*contract.names, *[c for c in raw.columns if c not in contract.names])


def read_grown_parquet(spark: SparkSession, paths: str | list[str], schema: T.StructType | str) -> DataFrame:
    """Parquet deliveries whose schema grew over time, read with the declared wide
    schema: a column that a file does not have is NULL in its rows."""
    return spark.read.schema(schema).parquet(*([paths] if isinstance(paths, str) else paths))


def read_gzip_csv(spark: SparkSession, path: str, contract: Contract, **opts) -> DataFrame:
    """Gzip text is not splittable: one task per file. A REBALANCE spreads the
    rows right after the read so the rest of the plan runs wide."""
    return read_csv_contract(spark, path, contract, **opts).hint("rebalance")


def parse_json_column(df: DataFrame, column: str, schema: T.StructType | str, alias: str = "j") -> DataFrame:
    """Parse a JSON text column with a declared schema (no inference pass)."""
    return df.withColumn(alias, F.from_json(F.col(column), schema))


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines with a declared (possibly nested) schema: no inference pass
    over the files, malformed records become NULL fields (PERMISSIVE)."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
