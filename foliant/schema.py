"""The canonical schemas. Missing strings are '' in files and NULL inside."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T



def fields(**kinds: T.DataType) -> T.StructType:
    """A struct of nullable fields; no session is needed, unlike for schemas in text."""
    return T.StructType([T.StructField(k, v) for k, v in kinds.items()])


def strings(*names: str) -> T.StructType:
    return fields(**dict.fromkeys(names, T.StringType()))


_SCORES = T.MapType(T.StringType(), fields(vals=T.ArrayType(T.DoubleType()), avg=T.DoubleType()))
_LINKS = ("site", "oa", "openreview", "pdf", "doi", "arxiv", "poster", "slides", "video", "proceeding", "project", "github")

#: One paper of any source. `scores` holds the configured review dimensions.
PAPER = T.StructType(
    [
        *fields(row_ix=T.LongType(), conf=T.StringType(), year=T.IntegerType()).fields,
        *strings("id", "title", "track", "status", "keywords", "primary_area", "author", "authorids", "aff", "aff_domain", "position", *_LINKS).fields,
        *fields(scores=_SCORES).fields,
    ]
)

#: A paper of a site's list, as pages give it.
SITE_PAPER = strings("title", "author", "status", "track", "site", "id", "poster", "openreview", "slides", "video", "proceeding", "pdf", "project", "github", "oa")

#: A review note: fields are JSON, plain or wrapped in {value: ..}.
_TEXTS = T.MapType(T.StringType(), T.StringType())
_REPLY = fields(invitation=T.StringType(), invitations=T.ArrayType(T.StringType()), content=_TEXTS)
NOTE = fields(id=T.StringType(), content=_TEXTS, details=fields(replyCount=T.IntegerType(), directReplies=T.ArrayType(_REPLY)))

META = strings("conference", "total", "accept", "withdraw", "desk_reject", "show", "gform_response", "gform_sheet", "gform_embed", "t_order", "t_order_ac", "t_order_brief")


def from_files(df: DataFrame) -> DataFrame:
    """'' to NULL in all string columns."""
    return df.select(*[F.nullif(F.col(c), F.lit("")).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def to_files(df: DataFrame) -> DataFrame:
    """NULL to '' in all string columns."""
    return df.na.fill("")
