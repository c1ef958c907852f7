"""The tables of a count.

State is never updated in place: each stage derives the next state of a table from its delta.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _table(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


_S, _I, _D = T.StringType(), T.IntegerType(), T.DoubleType()

IMAGES = _table(
    ("path", _S), ("box", _S), ("seq", _S), ("status", _S), ("page_kind", _S), ("party", _S), ("style", _S),
    ("layout", _S), ("width", _I), ("height", _I), ("updated_at", _D), ("err", _S),
)
REGIONS = _table(
    ("layout", _S), ("x0", _D), ("y0", _D), ("x1", _D), ("y1", _D), ("ox0", _D), ("oy0", _D), ("ox1", _D), ("oy1", _D),
    ("calibrated_from", _S), ("method", _S), ("valid", _I), ("updated_at", _D),
)
RESULTS = _table(
    ("path", _S), ("oval_fill_score", _D), ("line_ink_score", _D), ("has_mark", _I), ("vision_text", _S),
    ("vision_oval", _S), ("vision_conf", _D), ("vision_model", _S), ("candidate", _S), ("match", _S),
    ("match_score", _D), ("crop_path", _S), ("updated_at", _D), ("quarantined", _I),
)
REVIEW = _table(("path", _S), ("reason", _S), ("vision_text", _S), ("match_score", _D), ("crop_path", _S), ("updated_at", _D))
WORDS = T.ArrayType(_table(("text", _S), ("left", _I), ("top", _I), ("width", _I), ("height", _I), ("conf", _D)))
REPLY = _table(("text", _S), ("oval", _S), ("conf", _D))

# Statuses of an image.
PENDING, CLASSIFIED, LOCATED, SCORED, MARKED, READ, DONE = "pending", "classified", "located", "scored", "marked", "read", "done"
SKIP_NO_CONTEST, SKIP_BLANK, ERROR = "skip_no_governor", "skip_blank", "error"


def conformed(df, schema: T.StructType):
    """``df`` with exactly the schema's columns; columns it lacks are null (added columns of later versions)."""
    from pyspark.sql import functions as F

    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema))
