"""File sources and sinks. A path may be a file or a folder; splittable files are read in parallel."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.align import column_intersect

_TIMES = (T.TimestampType, T.TimestampNTZType)
_NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
# Columns of a checked reading besides the target's.
LINE, WRONG, FILE = "_line", "_wrong", "_file"
CHECKED = (LINE, WRONG, FILE)
# Files whose headers are read at once.
OPENED = 16


def _raw(schema: T.StructType) -> T.StructType:
    """The schema with every plain value as text and every nested one as a variant, so that no value can spoil its record."""
    return T.StructType([T.StructField(f.name, T.VariantType() if isinstance(f.dataType, _NESTED) else T.StringType()) for f in schema])


def _plain(text: Column, kind: T.DataType) -> Column:
    """A text in a plain type; NULL if it does not fit.

    Times may be written with ``T`` or a blank, with or without fraction, zone mark or offset; one with a zone is shown in the
    session's time zone. Bytes are written in base 64.
    """
    if isinstance(kind, _TIMES):
        return text.try_cast("timestamp").cast(kind)
    if isinstance(kind, T.BinaryType):
        return F.try_to_binary(text, F.lit("base64"))
    return text.try_cast(kind)


def _judged(v: Column, kind: T.DataType) -> tuple[Column, Column]:
    """A variant in a type, value by value, and whether any value in it does not fit; those are NULL and the others stay."""
    there = v.isNotNull() & ~F.is_variant_null(v)
    if isinstance(kind, T.VariantType):
        return v, F.lit(False)
    if isinstance(kind, T.ArrayType):
        items = F.try_variant_get(v, "$", "array<variant>")
        value = F.transform(items, lambda x: _judged(x, kind.elementType)[0])
        wrong = F.exists(items, lambda x: _judged(x, kind.elementType)[1])
    elif isinstance(kind, T.MapType):
        items = F.try_variant_get(v, "$", "map<string,variant>")
        value = F.transform_values(items, lambda _, x: _judged(x, kind.valueType)[0])
        wrong = F.exists(F.map_values(items), lambda x: _judged(x, kind.valueType)[1])
    elif isinstance(kind, T.StructType):
        items = F.try_variant_get(v, "$", "map<string,variant>")
        fields = [(f.name, *_judged(F.try_element_at(items, F.lit(f.name)), f.dataType)) for f in kind]
        value = F.when(items.isNotNull(), F.struct(*[x.alias(name) for name, x, _ in fields]))
        wrong = F.lit(False)
        for _, _, w in fields:
            wrong = wrong | w
    else:
        items = F.try_variant_get(v, "$", "string")
        value = _plain(items, kind)
        wrong = value.isNull()
    return value, there & (items.isNull() | F.coalesce(wrong, F.lit(False)))


def _typed(raw: dict[str, Column], schema: T.StructType) -> tuple[list[Column], Column]:
    """Raw values in the target's types, and the names of columns in which something did not fit."""
    values, wrong = [], []
    for f in schema:
        c = raw[f.name]
        if isinstance(f.dataType, _NESTED):
            value, bad = _judged(c, f.dataType)
        else:
            value = _plain(c, f.dataType)
            bad = c.isNotNull() & value.isNull()
        values.append(value.alias(f.name))
        wrong.append(F.when(bad, f.name))
    return values, F.array_compact(F.array(*wrong)) if wrong else F.array().cast("array<string>")


def _columns(schema: T.StructType, prefix: str = "") -> dict[str, Column]:
    return {f.name: F.col(f"{prefix}`{f.name}`") for f in schema}


def _read_json(spark: SparkSession, path: str, schema: T.StructType, mode: str) -> DataFrame:
    rows = spark.read.schema(_raw(schema)).option("mode", mode).json(path)
    return rows.select(*_typed(_columns(schema), schema)[0])


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON object per line, read with the target's schema; blank lines are skipped, a line that does not parse raises.

    A value of another type than its column's is NULL, and the rest of its record stays; inside nested columns each value is
    judged by itself. :func:`read_checked` tells which values those are.
    """
    return _read_json(spark, path, schema, "FAILFAST")


def read_ndjson_tolerant(
    spark: SparkSession, path: str, schema: T.StructType, partitions: int | None = None
) -> DataFrame:
    """As :func:`read_ndjson`, but lines that do not parse are dropped, and no others. Gzip is recognised by file name.

    A gzip file is read by one task whatever its size; ``partitions`` spreads the rows afterwards.
    """
    rows = _read_json(spark, path, schema, "DROPMALFORMED")
    return rows.repartition(partitions) if partitions else rows


def read_checked(spark: SparkSession, path: str, schema: T.StructType, kind: str = "ndjson") -> tuple[DataFrame, dict[str, Column]]:
    """Records of NDJSON or CSV files with what is wrong with them, in one reading; and per target column whether a line names it.

    Every line that isn't blank gives a row of the target's columns with ``_wrong``, the names of columns whose value did not fit and is
    NULL, and with ``_file`` and ``_line``: the text of a line with something wrong, NULL for others. A line that is no record has
    NULL in ``_wrong``. A CSV line is no record if it has more or fewer fields than its header; its header's names are
    matched to the target's.
    """
    if kind == "csv":
        return _checked_csv(spark, path, schema)
    if kind != "ndjson":
        raise ValueError(f"files are ndjson or csv, not {kind!r}")
    corrupt = "_corrupt"
    while corrupt in schema.names:
        corrupt += "_"
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias(FILE)).filter(F.btrim("value", F.lit(" \t\r\n")) != "")
    fields = _raw(schema).add(corrupt, T.StringType())
    parsed = lines.withColumn("r", F.from_json("value", fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}))
    no_record = F.col("r").isNull() | F.col(f"r.{corrupt}").isNotNull()
    values, wrong = _typed(_columns(schema, "r."), schema)
    names = F.json_object_keys("value")
    rows = parsed.select(
        *values,
        F.when(~no_record, wrong).alias(WRONG),
        F.when(no_record | (F.size(wrong) > 0), F.col("value")).alias(LINE),
        FILE,
        F.coalesce(names, F.array().cast("array<string>")).alias("_names"),
    )
    return rows, {n: F.array_contains("_names", n) for n in schema.names}


def _checked_csv(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, dict[str, Column]]:
    def reader():
        # A reader keeps what it is told, so every reading has its own.
        return spark.read.options(header=True, escape='"')

    files = reader().csv(path).inputFiles()
    headers = _headers(spark, files) if len(files) > 1 else {"": files}
    out, named = None, set()
    for _, group in sorted(headers.items()):
        header = reader().csv(group[0]).columns
        target = {f.name.lower(): f for f in schema}
        here = [n for n in header if n.lower() in target]
        named |= {target[n.lower()].name for n in here}
        fields = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))]).add(LINE, T.StringType())
        raw = reader().schema(fields).option("columnNameOfCorruptRecord", LINE).option("enforceSchema", True).csv(group)
        raw = raw.select("*", F.col("_metadata.file_path").alias(FILE))
        place = {target[n.lower()].name: F.col(f"c{header.index(n)}") for n in here}
        found = T.StructType([f for f in schema if f.name in place])
        values, wrong = _typed(place, found)
        text = F.to_csv(F.struct(*[f"c{i}" for i in range(len(header))]))
        part = raw.select(
            *values,
            F.when(F.col(LINE).isNull(), wrong).alias(WRONG),
            F.coalesce(F.col(LINE), F.when(F.size(wrong) > 0, text)).alias(LINE),
            FILE,
        )
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    kept = [f.name for f in schema if f.name in named]
    return out.select(*kept, *CHECKED), {n: F.lit(True) for n in kept}


def _first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a file, compressed or not; no more is read than a buffer."""
    jvm = spark._jvm
    file, conf = jvm.org.apache.hadoop.fs.Path(path), spark._jsc.hadoopConfiguration()
    stream = file.getFileSystem(conf).open(file)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(file)
        plain = codec.createInputStream(stream) if codec is not None else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()


def _headers(spark: SparkSession, files: Sequence[str]) -> dict[str, list[str]]:
    """Files by their first line; files without any are left out. Several are opened at once, and only their beginnings are read."""
    with ThreadPoolExecutor(OPENED) as pool:
        lines = list(pool.map(lambda f: _first_line(spark, f), files))
    out: dict[str, list[str]] = {}
    for file, line in zip(files, lines):
        if line is not None:
            out.setdefault(line.lstrip("\ufeff"), []).append(file)
    return out


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    """CSV with a header, matched to the target by column name; all text, then cast to target types.

    The header of each file decides which column is which: files of a folder are grouped by their header, and every group is
    read with its own. Of each file only the beginning is read for that, and nothing if there is just one. Every column of the target that
    any file has is in the result, NULL for files without it. ``multiline`` allows line breaks inside quotes at the price of
    unsplittable files.
    """
    reader = spark.read.options(header=True, escape='"', multiLine=multiline)
    whole = reader.csv(path)
    files = whole.inputFiles()
    if len(files) < 2:
        return column_intersect(whole, schema)
    out = None
    for _, files in sorted(_headers(spark, files).items()):
        part = column_intersect(reader.option("enforceSchema", False).csv(files), schema)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out.select(*[c for c in schema.names if c in out.columns])


def read_wrapped_json(
    spark: SparkSession, path: str, record: T.StructType, pretty: bool = True, field: str = "records"
) -> DataFrame:
    """Records out of ``{"metadata": {...}, "records": [...]}`` documents.

    ``pretty`` documents fill a whole file each; otherwise there is one document per line.
    Parallelism comes from the number of documents.
    """
    schema = T.StructType([T.StructField(field, T.ArrayType(record))])
    documents = (
        spark.read.schema(schema)
        .options(mode="FAILFAST", multiLine=pretty, timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")
        .json(path)
    )
    return documents.select(F.inline(field))


def write_ndjson(df: DataFrame, path: str, compression: str = "none") -> str:
    """One JSON object per line with ISO times; NULL fields are written."""
    df.write.options(
        ignoreNullFields=False,
        compression=compression,
        timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
        timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    ).json(path)
    return path
