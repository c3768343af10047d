"""Records that fail before they can be read are set aside: a blank review row with the message, a log row, one failure each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NO_TEXT = "no text was read"


def parted(records: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(the records that can be read; the others as record_id, record_no, image_name, message).

    A record fails with the message in the column `error`, where there is one, or if it has no text at all. record_no is that of
    the plan, if the records have it, else a placeholder from record_id.
    """
    message = F.when(F.col("text").isNull(), NO_TEXT)
    message = F.coalesce(F.col(error), message) if error in records.columns else message
    place = F.concat(F.lit("rec_"), F.col("record_id").cast("string"))
    number = F.coalesce(F.col("record_no"), place) if "record_no" in records.columns else place
    failed = records.select("record_id", number.alias("record_no"), "image_name", message.alias("message")).where("message is not null")
    return records.where(message.isNull()).drop(error), failed
