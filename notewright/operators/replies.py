"""Read the JSON record out of a model reply.

The result is a variant. Known differences from Python's ``json``: ``NaN`` and ``Infinity`` make a reply
unreadable instead of becoming floats, a number too large for a double does not become infinity, and a
lone surrogate is replaced. In each case the raw reply stays in the record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.functions.replies import (
    drop_trailing_commas, listed_with_mark, outer_braces, whole_value,
)


def with_parsed(replies: DataFrame, structured: bool = True, text: str = "raw_output") -> DataFrame:
    """Add ``parsed``: the JSON of a reply, null where there is none to read.

    The JSON object is salvaged from the text between its outer braces, as it stands or else without
    trailing commas. A ``structured`` reply is taken whole first and salvaged only where it is not JSON
    at all, so a list or a number stays what it is.

    Each step is a column of its own and works only on the rows the step before could not read, so a
    good reply is parsed once.
    """
    kept = replies.columns
    c = F.col
    df = replies.withColumn("_whole", F.lit(None).cast("variant"))
    if structured:
        df = replies.withColumn("_l0", listed_with_mark(c(text))).withColumn(
            "_whole", whole_value(c("_l0"), c(text))
        )
    df = (
        df.withColumn("_blob", F.when(c("_whole").isNull(), outer_braces(c(text))))
        .withColumn("_l1", listed_with_mark(c("_blob")))
        .withColumn("_asis", whole_value(c("_l1"), c("_blob")))
        .withColumn("_blob2", F.when(c("_asis").isNull(), drop_trailing_commas(c("_blob"))))
        .withColumn("_l2", listed_with_mark(c("_blob2")))
        .withColumn("_mended", whole_value(c("_l2"), c("_blob2")))
    )
    parsed = F.coalesce("_whole", "_asis", "_mended")
    # One item, so one row: Catalyst moves later filters below a projection and would copy the whole
    # parse into them, but it leaves them above an explode.
    return df.select(*kept, F.explode(F.array(parsed)).alias("parsed"))
