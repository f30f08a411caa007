"""Explicit table schemas, one per stage."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)  # needs an active session


RAW_RECORD_DDL = (
    "id string, name string, comments string, formulas string, examples string, keywords array<string>, "
    "offset string, values array<bigint>, values_preview_str string, n_terms_visible bigint, author string, "
    "edit_count bigint, last_edited timestamp_ntz, n_references bigint, n_links bigint, n_extensions bigint, "
    "code_languages array<string>, has_bfile boolean"
)
FILE_DDL = "mtime double, size bigint, path_rel string"
ENUM_DDL = "math_domain string, sequence_type string, growth_class string, origin_era string"
EDGE_DDL = "from_id string, to_id string"
EDGE_CACHE_DDL = "path_rel string, mtime double, size bigint, pairs array<struct<src:string,dst:string>>"
EMBEDDING_DDL = "id string, embedding array<float>, text_version string"
COORDS_DDL = "id string, x float, y float"
LABEL_DDL = "id string, layer int, cluster_id bigint, label string"


def raw_records() -> T.StructType:
    return _struct(f"{RAW_RECORD_DDL}, {FILE_DDL}")


def enriched_records() -> T.StructType:
    return _struct(f"{RAW_RECORD_DDL}, {FILE_DDL}, select_score double, scope string, {ENUM_DDL}")


def edges() -> T.StructType:
    return _struct(EDGE_DDL)


def embeddings() -> T.StructType:
    return _struct(EMBEDDING_DDL)


def labels() -> T.StructType:
    return _struct(LABEL_DDL)
