"""Schemas of the tables a run is described by. Field names are the file format."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


SELECTIONS = T.StructType(
    _strings(
        "src_schema",
        "src_table",
        "tgt_schema",
        "tgt_table",
        "partition_columns",
        "filter_expression",
        "k8s_name",
        "source_count",
    )
)

MANIFEST = T.StructType(
    [
        *_strings(
            "table", "partitionColumns", "filterExpression", "outputSchema", "outputTable", "k8sName"
        ),
        T.StructField("source_count", T.LongType()),
    ]
)

VIEW_SPECS = T.StructType(
    [
        *_strings(
            "view",
            "target_view",
            "target_db",
            "base_table",
            "target_location",
            "filter_expression",
            "join_key",
        ),
        T.StructField("cast_to_string", T.ArrayType(T.StringType())),
    ]
)

TABLE_STATE = T.StructType(
    [
        *_strings(
            "table_key",
            "source_table",
            "target_table",
            "apply_status",
            "apply_at",
            "k8s_state",
            "k8s_name",
            "apply_error",
            "validation_status",
            "validation_at",
        ),
        T.StructField("source_count", T.LongType()),
        T.StructField("target_count", T.LongType()),
        T.StructField("target_count_total", T.LongType()),
        *_strings("partition_source", "partition_target"),
        T.StructField("partition_match", T.BooleanType()),
        *_strings("validation_error"),
    ]
)

VIEW_STATE = T.StructType(
    [
        *_strings(
            "view_key",
            "source_view_fqn",
            "target_view_fqn",
            "migrate_status",
            "migrate_at",
            "migrate_error",
            "validation_status",
            "validation_at",
        ),
        T.StructField("source_count", T.LongType()),
        T.StructField("target_count", T.LongType()),
        T.StructField("mismatched_rows", T.LongType()),
        *_strings("validation_error"),
    ]
)

PROPERTIES = T.StructType(_strings("table_fqn", "key", "value"))

# Blanked before a new validation.
VALIDATION_COLUMNS = (
    "validation_status",
    "validation_at",
    "source_count",
    "target_count",
    "target_count_total",
    "partition_source",
    "partition_target",
    "partition_match",
    "validation_error",
)
