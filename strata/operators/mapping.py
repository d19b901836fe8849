"""Projection and row filters between a nested source record and a flat target row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.glossary import GLOSSARY, alias_map
from strata.functions.keys import any_missing
from strata.functions.text import transform
from strata.functions.time import clock, null_zero_date
from strata.specs import AUDIT_COLUMNS, FieldMapping, key_list


def nested(schema: T.StructType, path: str) -> Column:
    """Column for a dotted path; NULL when a step is missing or is not an object."""
    node: T.DataType = schema
    column: Column | None = None
    for step in path.split("."):
        if isinstance(node, T.StructType) and step in node.fieldNames():
            node = node[step].dataType
            column = F.col(f"`{step}`") if column is None else column.getField(step)
        elif isinstance(node, T.MapType) and column is not None:
            node, column = node.valueType, column.getItem(step)
        elif isinstance(node, T.VariantType) and column is not None:
            column = F.try_variant_get(column, f"$.{step}", "variant")
        else:
            return F.lit(None).cast("string")
    return column


def auto_timestamps(df: DataFrame, run_ts, columns: Sequence[str] = AUDIT_COLUMNS) -> DataFrame:
    """Stamp the audit columns with the run time."""
    return df.withColumns({c: clock(run_ts) for c in columns})


def map_fields(
    df: DataFrame,
    mappings: Sequence[FieldMapping],
    run_ts=None,
    stamps: Sequence[str] = (),
) -> DataFrame:
    """Nested records to flat rows; only mapped fields survive, audit columns go last."""
    columns = [transform(m.transform, nested(df.schema, m.source)).alias(m.column) for m in mappings]
    return df.select(*columns, *[clock(run_ts).alias(c) for c in stamps])


def filter_missing_pk(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows whose key is complete: no part is NULL or empty text."""
    return df.filter(~any_missing(key_list(keys)))


def filter_watermark(df: DataFrame, column: str, watermark, keep_null: bool = True) -> DataFrame:
    """Rows past the watermark, compared in the column's own type.

    The bound is a literal, so the scan can use it to skip files and row groups.
    """
    if watermark is None:
        return df
    bound = watermark if isinstance(watermark, Column) else F.lit(str(watermark))
    newer = F.col(column) > bound.cast(df.schema[column].dataType)
    return df.filter(newer | F.col(column).isNull()) if keep_null else df.filter(newer)


def date_range(state: DataFrame, as_of, value: str = "watermark_value", default_days: int = 90) -> DataFrame:
    """Extraction window per state row: the day of the watermark, or a default span before ``as_of``."""
    today = clock(as_of).cast("date")
    return state.withColumns(
        {
            "from_date": F.coalesce(
                F.try_to_timestamp(F.substring(F.col(value), 1, 10), F.lit("yyyy-MM-dd")).cast("date"),
                F.date_sub(today, default_days),
            ),
            "to_date": today,
        }
    )


def limit_recent(df: DataFrame, column: str, as_of, days: int = 30, enabled: bool = True) -> DataFrame:
    """The last ``days`` days while developing, everything otherwise."""
    if not enabled:
        return df
    return df.filter(F.col(column) >= F.date_sub(clock(as_of).cast("date"), days))


def stage_clean(df: DataFrame, columns: Mapping[str, Column], keep: Column | None = None) -> DataFrame:
    """Staging model: filter invalid rows, then one explicit select."""
    source = df if keep is None else df.filter(keep)
    return source.select(*[c.alias(name) for name, c in columns.items()])


def rename_glossary(df: DataFrame, glossary: Mapping[str, tuple[str, ...]] = GLOSSARY) -> DataFrame:
    """Replace source aliases by their official names; two columns may not end up with one name."""
    aliases = alias_map(dict(glossary))
    renames = {c: aliases[c.lower()] for c in df.columns if c.lower() in aliases}
    final = [renames.get(c, c).lower() for c in df.columns]
    clashes = sorted({name for name in final if final.count(name) > 1})
    if clashes:
        raise ValueError(f"several columns would be named {', '.join(clashes)}")
    return df.withColumnsRenamed(renames)


def drop_etl_columns(df: DataFrame, prefixes: Sequence[str] = ("_airbyte_",)) -> DataFrame:
    """Drop the bookkeeping columns of a replication tool."""
    return df.drop(*[c for c in df.columns if c.lower().startswith(tuple(prefixes))])


def null_zero_dates(df: DataFrame, date_columns: Sequence[str] = ()) -> DataFrame:
    """Zero dates to NULL in every text column, empty text to NULL in the date columns only."""
    dates = {c.lower() for c in date_columns}
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: null_zero_date(c, c.lower() in dates) for c in text})


# Source type -> Spark type.
SOURCE_TYPES = {
    "integer": "bigint",
    "int": "bigint",
    "bigint": "bigint",
    "varchar": "string",
    "text": "string",
    "timestamp": "timestamp_ntz",
    "datetime": "timestamp_ntz",
    "date": "date",
    "boolean": "bigint",
    "tinyint(1)": "bigint",
    "json": "variant",
    "jsonb": "variant",
    "array": "variant",
}


def map_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns from declared source types; a value that does not fit becomes NULL."""
    casts = {}
    for name, source_type in types.items():
        kind = source_type.lower()
        kind = "varchar" if kind.startswith("varchar") else "array" if kind.endswith("[]") else kind
        if kind not in SOURCE_TYPES:
            raise ValueError(f"no mapping for source type {source_type!r}")
        target, c = SOURCE_TYPES[kind], F.col(name)
        is_text = isinstance(df.schema[name].dataType, T.StringType)
        if target == "variant":
            casts[name] = F.try_parse_json(c if is_text else F.to_json(c))
        elif kind in ("boolean", "tinyint(1)") and is_text:
            casts[name] = F.coalesce(c.try_cast("bigint"), c.try_cast("boolean").cast("bigint"))
        else:
            casts[name] = c.try_cast(target)
    return df.withColumns(casts)


def enrich_page_views(
    df: DataFrame,
    url: str,
    id_pattern: str,
    url_classes: Sequence[tuple[str, str]],
    referer: str | None = None,
    lat_long: str | None = None,
    event_start: str | None = None,
) -> DataFrame:
    """All derived page-view columns in one select over one scan: no self-joins."""
    kind = F.when(F.lit(False), F.lit(""))
    for pattern, label in url_classes:
        kind = kind.when(F.col(url).like(pattern), label)
    added = {
        "page_uuid": F.regexp_substr(F.col(url), F.lit(id_pattern)),
        "url_type": kind.otherwise("other"),
        "url_host": F.split_part(F.col(url), F.lit("/"), F.lit(3)),
    }
    if referer:
        host = F.split_part(F.col(referer), F.lit("/"), F.lit(3))
        added["referer_type"] = (
            F.when(F.col(referer).isNull(), "direct").when(host == added["url_host"], "internal").otherwise("external")
        )
    if lat_long:
        for i, name in enumerate(("page_lat", "page_long"), start=1):
            part = F.trim(F.split_part(F.col(lat_long), F.lit(","), F.lit(i)))
            added[name] = part.try_cast("decimal(10,6)")
    if event_start:
        added["event_date"] = F.col(event_start).cast("date")
    return df.withColumns(added)


# Audit columns in their official order, and the names that mark a metric.
AUDIT_ORDER = ("created_at", "updated_at", "deleted_at", "inserted_at")
METRIC_PREFIXES = ("total_", "avg_", "min_", "max_")
METRIC_SUFFIXES = ("_amount", "_count", "_pct")


def order_columns(df: DataFrame, primary_sk: str, metrics: Sequence[str] = ()) -> DataFrame:
    """Official column order: own key, foreign keys, natural keys, attributes, metrics, audit."""

    def rank(name: str) -> tuple[int, int]:
        if name == primary_sk:
            return 0, 0
        if name.endswith("_sk"):
            return 1, 0
        if name in AUDIT_ORDER:
            return 5, AUDIT_ORDER.index(name)
        if name in metrics or name.startswith(METRIC_PREFIXES) or name.endswith(METRIC_SUFFIXES):
            return 4, 0
        return (2, 0) if name.endswith("_id") else (3, 0)

    return df.select(*sorted(df.columns, key=rank))
