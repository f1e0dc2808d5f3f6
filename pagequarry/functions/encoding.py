"""Text decoding."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode_by_flags(body: Column, flags: Column, encoding: str = "ISO-8859-1") -> Column:
    """Characters of a stored body: UTF-8 where the flags say ``utf-8``, else
    ``encoding``. Bytes that are no UTF-8 become U+FFFD and fail no job."""
    utf8 = F.make_valid_utf8(body.cast("string"))
    return F.when(F.coalesce(flags, F.lit("")).contains("utf-8"), utf8).otherwise(F.decode(body, encoding))
