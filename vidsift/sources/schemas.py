"""Declared schemas; readers align to them and only ever add columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

KINDS = {"string": StringType(), "int": IntegerType(), "long": LongType(), "double": DoubleType(), "array<string>": ArrayType(StringType())}


def declared(columns: str) -> StructType:
    """A schema from "name kind, name kind"; needs no session, so modules can declare schemas when they are imported."""
    return StructType([StructField(*(lambda n, k: (n, KINDS[k]))(*c.split())) for c in columns.split(",")])


VIDEO = declared(
    "video_id string, username string, video_url string, create_time long, posted_at string, caption string, hashtags string, like_count long, share_count long, "
    "comment_count long, save_count long, view_count long, duration_seconds long, voice_to_text string, transcript string, onscreen_text string, sticker_overlay_text string, "
    "browser_ocr_text string, visual_text_combined string, region_code string, music_id string, collection_source string, collection_date string, "
    "collection_window_start string, collection_window_end string, pipeline_id string, api_source string, matched_keywords array<string>"
)
USER = declared("username string, display_name string, bio string, is_verified int, follower_count long, following_count long, likes_count long, video_count long, api_failed int")
COMMENT = declared("comment_id string, video_id string, text string, like_count long, create_time long, parent_comment_id string, reply_count long")
RAW_RESPONSE = declared("timestamp string, endpoint string, handle string, http_status int, request string, response string")
LOG = declared("id long, worker string, video_id string, ok int, started_at string, ended_at string, elapsed_seconds double, error string, detail_json string")
STATUS_FIRST = ("collection_status", "collection_date", "pipeline_id", "api_error_code", "failure_reason", "video_id")


def aligned(df: DataFrame, schema: StructType) -> DataFrame:
    """Declared columns in order, absent ones null, then what else the frame has. Bad values become null."""
    out = [(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema]
    return df.select(*out, *[F.col(f"`{c}`") for c in df.columns if c not in schema.fieldNames()])


def drift(df: DataFrame, schema: StructType) -> dict[str, list[str]]:
    have, want = set(df.columns), set(schema.fieldNames())
    return {"missing": sorted(want - have), "extra": sorted(have - want)}
