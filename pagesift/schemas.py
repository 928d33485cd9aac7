"""Schemas of the published tables (each also has a ``stat_date`` partition)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pagesift import fixed


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_LONG, _INT, _STR, _DBL = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()

CRAWL = _schema(fid=_LONG, furl=_STR, ftitle=_STR, fkeywords=_STR, fcontent=_STR, src_type=_STR)
EXTRACT = _schema(fid=_LONG, ftitle=_STR, fcontent=_STR)
WORDS = _schema(fid=_LONG, words=_STR)
HASH = _schema(fid=_LONG, hash=_LONG)
EXACT_GROUPS = _schema(hash=_LONG, fid=_LONG, samelen=_LONG)
NEAR_GROUPS = _schema(fid=_LONG, hash=_LONG, absorbed=T.ArrayType(_LONG), samelen=_LONG)
MEMBER_STRINGS = _schema(leader=_LONG, samelen=_LONG, part=_INT, samefid=_STR)
DUP_REPORT = _schema(
    fid=_LONG, hash=_LONG, samelen=_LONG, furl=_STR, ftitle=_STR, fkeywords=_STR,
    fcontent=_STR, fcontent_len=_INT, src_type=_STR,
)
LABELS = _schema(fid=_LONG, words=_STR, cat=_STR, prob=_DBL)
UNION_LABELS = _schema(
    fid=_LONG,
    title_pcat=_STR, title_pprob=_DBL, title_ccat=_STR, title_cprob=_DBL,
    content_pcat=_STR, content_pprob=_DBL, content_ccat=_STR, content_cprob=_DBL,
)
ARTICLES = T.StructType(
    _schema(
        fid=_LONG, furl=_STR, ftitle=_STR, fcontent_len=_INT, src_type=_STR,
        is_error_body=T.BooleanType(), hash=_LONG,
    ).fields
    + UNION_LABELS.fields[1:]
)
FINAL = _schema(
    algo_ver=_STR, fid=_LONG, ftitle=_STR, cat=_STR, src_type=_STR, furl=_STR,
    title_pcat=_STR, title_pprob=_DBL, content_pcat=_STR, content_pprob=_DBL,
)
# Of the tables of the daily runs, by name.
STAGES = {
    fixed.KEYWORDS: WORDS,
    fixed.HASHES: HASH,
    fixed.EXACT: EXACT_GROUPS,
    fixed.EXACT_MEMBERS: MEMBER_STRINGS,
    **{f"{fixed.NEAR}_{block}": NEAR_GROUPS for block in range(len(fixed.BLOCK_MASKS))},
    fixed.NEAR_MEMBERS: MEMBER_STRINGS,
    fixed.REPORT: DUP_REPORT,
    fixed.EXTRACTED: EXTRACT,
    fixed.TITLE_WORDS: WORDS,
    fixed.CONTENT_WORDS: WORDS,
    **{name: LABELS for name in (fixed.TITLE_PARENT, fixed.TITLE_CHILD, fixed.CONTENT_PARENT, fixed.CONTENT_CHILD)},
    fixed.UNION: UNION_LABELS,
    fixed.ASSEMBLED: ARTICLES,
    fixed.PUBLISHED: FINAL,
}


def conform(df: DataFrame, schema: T.StructType, *extra: str) -> DataFrame:
    """Select the columns of ``schema`` (plus ``extra`` keys) and check their types."""
    wrong = [
        f"{field.name}: {df.schema[field.name].dataType.simpleString()} is not {field.dataType.simpleString()}"
        for field in schema.fields
        if field.name in df.columns
        and df.schema[field.name].dataType.simpleString() != field.dataType.simpleString()
    ]
    missing = [field.name for field in schema.fields if field.name not in df.columns]
    if wrong or missing:
        raise TypeError(f"wrong types {wrong}, missing columns {missing}")
    return df.select(*extra, *[field.name for field in schema.fields])
