"""Tab-separated hand-over files (S1, S2, S6, S7, S8) and previews.

Reading never infers types: columns are read as strings under their header
names, pandas' missing-value tokens become NULL, and each column is cast to
the type the caller gives (a ``YYYY-MM`` month must stay a string, §1.2).

Writing produces a Spark output directory (one part file per task, each with
a header line), never one file through one task.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DoubleType, IntegerType, LongType, ShortType,
                               StringType, StructField, StructType, _parse_datatype_string)

# The strings pandas' table reader treats as missing by default.
PANDAS_NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                    "nan", "null")


def _types(schema) -> dict[str, DataType]:
    if isinstance(schema, str):
        schema = _parse_datatype_string(schema)
    if isinstance(schema, StructType):
        return {f.name: f.dataType for f in schema.fields}
    return dict(schema)


def _raw_tsv(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    return (spark.read.option("sep", "\t").option("header", "true")
            .option("quote", '"').option("escape", '"').option("inferSchema", "false").option("recursiveFileLookup", str(recursive).lower())
            .csv(path))


def _typed(value: Column, dtype: DataType, name: str) -> Column:
    """A whole number may be written with a fraction of zero (``672.0``, as
    pandas writes integers with gaps); another fraction is an error."""
    if not isinstance(dtype, (ByteType, ShortType, IntegerType, LongType)):
        return value.cast(dtype)
    number = value.cast("decimal(38,9)")
    wrong = F.raise_error(F.concat(F.lit(f"{name} is not a whole number: "), value))
    return F.when(number == F.floor(number), number.cast(dtype)).when(number.isNotNull(), wrong.cast(dtype))


def read_tsv(spark: SparkSession, path: str, schema, na_tokens=PANDAS_NA_TOKENS,
             recursive: bool = False, default_type: DataType | None = None,
             optional: dict | None = None) -> DataFrame:
    """A TSV with a header; ``schema`` maps column names to types.

    Columns of the file missing from ``schema`` get their type in ``optional``
    or ``default_type`` when it is given, and are dropped otherwise.
    """
    types = _types(schema)
    raw = _raw_tsv(spark, path, recursive)
    missing = [c for c in types if c not in raw.columns]
    if missing:
        raise ValueError(f"{path}: columns {missing} not in the header {raw.columns}")
    tokens = list(na_tokens)
    cols = []
    for name in raw.columns:
        dtype = types.get(name, (optional or {}).get(name, default_type))
        if dtype is None:
            continue
        value = F.when(F.col(name).isin(tokens), F.lit(None)).otherwise(F.col(name))
        cols.append(_typed(value, _types(f"c {dtype}")["c"] if isinstance(dtype, str) else dtype, name).alias(name))
    return raw.select(*cols)


def list_tables(spark: SparkSession, directory: str) -> list[str]:
    """Tables under ``directory`` (recursively), sorted: files, and folders of
    part files.  The listing is reduced to tables in Spark, so the driver gets
    one path per table whatever its number of parts; markers are skipped."""
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
               .load(directory).select("path"))
    name = F.substring_index("path", "/", -1)
    tables = (listing.where(~name.startswith("_") & ~name.startswith("."))
              .select(F.regexp_replace("path", r"/part-[^/]*$", "").alias("path")).distinct())
    return sorted(r.path for r in tables.collect())


def read_feature_dir(spark: SparkSession, directory: str, key_types: dict,
                     feature_type: DataType = DoubleType(),
                     column_types: dict | None = None) -> list[DataFrame]:
    """One DataFrame per feature table under ``directory`` (a table is a
    file or a Spark output directory), keys typed as given, other columns
    ``column_types[name]`` or ``feature_type``.  Tables come in path order
    (Q21: order is explicit)."""
    return [read_tsv(spark, t, key_types, default_type=feature_type, optional=column_types)
            for t in list_tables(spark, directory)]


def write_tsv(df: DataFrame, path: str) -> str:
    """Overwrite ``path`` with a header TSV directory; NULL is written empty."""
    (df.write.mode("overwrite").option("sep", "\t").option("header", "true")
     .option("quote", '"').option("escape", '"')
     .option("nullValue", "").option("emptyValue", "").csv(path))
    return path


def write_numbered_features(features: DataFrame, directory: str, keys: list[str],
                            names: list[str], row_counts: dict[str, str] | None = None,
                            first: int = 0) -> int:
    """Write ``keys + [name]`` of each feature to ``<directory>/f<n>``,
    numbered from ``first``; returns the next free number.

    ``row_counts`` maps a feature to a column counting its qualifying rows: a
    group without one is left out of that file, as a separate group-by would.
    All files come out of one job without a shuffle: a row becomes one line per
    feature, lines are sorted by feature inside each task, and each task writes
    its part of every folder, header first.  The folders then get their names.
    """
    def line(n: int, name: str) -> Column:
        cells = [F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate([*keys, name])]
        made = F.struct(F.lit(n).alias("n"), *cells)
        return F.when(F.col(row_counts[name]) > 0, made) if row_counts and name in row_counts else made

    headers = {first + i: [*keys, name] for i, name in enumerate(names)}
    lines = features.select(F.explode(F.filter(
        F.array(*[line(first + i, name) for i, name in enumerate(names)]), lambda x: x.isNotNull())).alias("x")).select("x.*")
    spark = features.sparkSession
    base = directory.rstrip("/")
    # a table without rows is a folder with a header, too
    empty = spark.createDataFrame([(n,) for n in headers], "n int")
    for i in range(len(keys) + 1):
        empty = empty.withColumn(f"c{i}", F.lit(None).cast("string"))
    marked = (lines.withColumn("kind", F.lit(1)).unionByName(empty.withColumn("kind", F.lit(0)))
              .sortWithinPartitions("n").select("n", "kind", *[f"c{i}" for i in range(len(keys) + 1)]))
    staged = f"{base}/_numbered-{uuid.uuid4().hex[:12]}"
    headed = marked.mapInArrow(partial(_with_headers, headers), marked.schema).drop("kind")
    (headed.write.mode("overwrite").partitionBy("n").option("sep", "\t").option("header", "false").option("quote", '"')
     .option("escape", '"').option("nullValue", "").option("emptyValue", "").csv(staged))
    _rename_folders(spark, {f"{staged}/n={n}": f"{base}/f{n}" for n in headers}, staged)
    return first + len(names)


def _with_headers(headers: dict[int, list[str]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by their first column, the header row of each of its values
    put before them; rows of kind 0 only ask for the header."""
    now = None
    for batch in batches:
        n = batch.column(0).to_numpy()
        starts = np.flatnonzero(np.r_[True, n[1:] != n[:-1]]) if len(n) else []
        for at, end in zip(starts, [*starts[1:], len(n)]):
            if n[at] != now:
                now = int(n[at])
                cells = [pa.array([c], pa.string()) for c in headers[now]]
                yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([1], pa.int32()), *cells],
                                                 schema=batch.schema)
            part = batch.slice(int(at), int(end - at))
            yield part.filter(pc.equal(part.column(1), 1))


def headed_lines(header: str) -> Callable:
    """For ``mapInArrow``: a task's lines of text after a header line."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([header], pa.string())], ["value"])
        for batch in batches:
            yield pa.RecordBatch.from_arrays(batch.columns, ["value"])
    return run


def _rename_folders(spark: SparkSession, moves: dict[str, str], staged: str) -> None:
    """Give written folders their final names, in the file system they are on."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for source, target in moves.items():
        old, new = hadoop.Path(source), hadoop.Path(target)
        fs = old.getFileSystem(conf)
        if fs.exists(new):
            fs.delete(new, True)
        if not fs.rename(old, new):
            raise OSError(f"cannot rename {source} to {target}")
    left = hadoop.Path(staged)
    left.getFileSystem(conf).delete(left, True)


CORRUPT = "_corrupt_line"


def read_tsv_checked(spark: SparkSession, path: str, schema, na_tokens=PANDAS_NA_TOKENS) -> tuple[DataFrame, DataFrame]:
    """S1 with bad rows kept apart: the rows that fit ``schema``, and a side table
    ``path, line, reason`` of those that do not: too few or too many cells, or a
    cell that is not of its column's type.  Neither aborts the read."""
    types = {c: _types(f"c {t}")["c"] if isinstance(t, str) else t for c, t in _types(schema).items()}
    header = _raw_tsv(spark, path).columns
    missing = [c for c in types if c not in header]
    if missing:
        raise ValueError(f"{path}: columns {missing} not in the header {header}")
    cells = StructType([StructField(c, StringType()) for c in [*header, CORRUPT]])
    raw = (spark.read.schema(cells).option("sep", "\t").option("header", "true").option("quote", '"').option("escape", '"')
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("enforceSchema", "true").csv(path)
           .select("*", F.col("_metadata.file_path").alias("_path")))
    tokens = list(na_tokens)
    values, wrong = [], []
    for name, dtype in types.items():
        cell = F.when(F.col(name).isin(tokens), F.lit(None)).otherwise(F.col(name))
        value = cell.try_cast(dtype)
        if isinstance(dtype, (ByteType, ShortType, IntegerType, LongType)):  # 672.0 is a whole number
            number = cell.try_cast("decimal(38,9)")
            value = F.when(number == F.floor(number), number.try_cast(dtype))
        values.append(value.alias(name))
        wrong.append(F.when(cell.isNotNull() & value.isNull(), F.lit(f"{name} is not {dtype.simpleString()}")))
    reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("wrong number of cells")).otherwise(F.coalesce(*wrong))
    read = raw.withColumn("_reason", reason)
    line = F.coalesce(CORRUPT, F.concat_ws("\t", *[F.coalesce(c, F.lit("")) for c in header]))
    bad = read.where(F.col("_reason").isNotNull()).select(F.col("_path").alias("path"), line.alias("line"),
                                                          F.col("_reason").alias("reason"))
    return read.where(F.col("_reason").isNull()).select(*values), bad


def preview(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows (in ``order_by`` order when given)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
