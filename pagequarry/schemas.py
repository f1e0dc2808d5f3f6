"""Fixed schemas of the dump and of the wiki tables."""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_STRING, _LONG, _INT = T.StringType(), T.LongType(), T.IntegerType()

CONTRIBUTOR = _struct(("username", _STRING), ("id", _STRING), ("ip", _STRING))

# Ids stay strings in the raw page: their validity is a check of the import.
RAW_REVISION = _struct(
    ("id", _STRING),
    ("timestamp", _STRING),
    ("contributor", CONTRIBUTOR),
    ("minor", _STRING),
    ("comment", _STRING),
    ("text", _STRING),
)

RAW_PAGE = _struct(
    ("title", _STRING),
    ("id", _STRING),
    ("restrictions", _STRING),
    ("revision", T.ArrayType(RAW_REVISION)),
)

SITEINFO = _struct(
    ("sitename", _STRING),
    ("base", _STRING),
    ("generator", _STRING),
    ("case", _STRING),
    (
        "namespaces",
        _struct(("namespace", T.ArrayType(_struct(("_key", _INT), ("_VALUE", _STRING))))),
    ),
)

NAMESPACES = _struct(("ns_id", _INT), ("ns_name", _STRING))

PAGE = _struct(
    ("page_id", _LONG),
    ("page_namespace", _INT),
    ("page_title", _STRING),
    ("page_restrictions", _STRING),
    ("page_counter", _LONG),
    ("page_is_redirect", _INT),
    ("page_is_new", _INT),
    ("page_random", T.DoubleType()),
    ("page_touched", T.TimestampType()),
    ("page_latest", _LONG),
    ("page_len", _LONG),
)

REVISION = _struct(
    ("rev_id", _LONG),
    ("rev_page", _LONG),
    ("rev_text_id", _LONG),
    ("rev_comment", _STRING),
    ("rev_user", _LONG),
    ("rev_user_text", _STRING),
    ("rev_timestamp", T.TimestampType()),
    ("rev_minor_edit", _INT),
    ("rev_deleted", _INT),
)

TEXT = _struct(("old_id", _LONG), ("old_text", _STRING), ("old_flags", _STRING))

CATEGORYLINKS = _struct(("cl_from", _LONG), ("cl_to", _STRING))
