"""Chat annotations to canonical records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import EXCLUDED_PREFIXES, IMAGE_FOLDERS, path_prefix

# Names of the two sides in annotations and in records.
ROLES = {"human": "user", "gpt": "assistant"}


#: White space of Unicode (the class of ``(?U)\s``), as characters to trim.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def _stripped(s: Column) -> Column:
    return F.btrim(s, F.lit(SPACES))


def normalised(turns: Column, tag: str | None = None) -> Column:
    """``role``/``content`` messages of ``from``/``value`` turns, or null.

    Any unknown side or blank text rejects the whole conversation, as do
    fewer than two turns, a first turn that is not the user's or a last one
    that is not the assistant's; alternation is not asked for. With ``tag``,
    the first turn gets it in front unless it holds ``<image>`` already. Null
    turns count as blank.
    """
    # tests read the raw turns; contents are stripped once, in the one transform
    blank = lambda t: ~F.coalesce(t["value"].rlike(r"(?U)\S"), F.lit(False))
    bad = F.exists(turns, lambda t: ~F.coalesce(t["from"].isin(*ROLES), F.lit(False)) | blank(t))
    shape = (F.size(turns) >= 2) & (F.get(turns, F.lit(0))["from"] == "human") & (F.element_at(turns, -1)["from"] == "gpt")
    role = lambda t: F.when(t["from"] == "human", ROLES["human"]).otherwise(ROLES["gpt"])
    lead = lambda t, i: F.when((i == 0) & ~F.contains(t["value"], F.lit("<image>")), F.lit(tag or "")).otherwise(F.lit(""))
    messages = F.transform(turns, lambda t, i: F.struct(role(t).alias("role"), F.concat(lead(t, i), _stripped(t["value"])).alias("content")))
    return F.when(shape & ~bad, messages)


def selection_reason(image: Column, messages: Column) -> Column:
    """Why an annotation is left out of the pool, or ``pool_<prefix>``."""
    prefix = path_prefix(image)
    return (
        F.when(image.isNull() | (image == ""), "no_image")
        .when(prefix.isin(*EXCLUDED_PREFIXES), F.concat(F.lit("excluded_"), prefix))
        .when(~prefix.isin(*IMAGE_FOLDERS), F.concat(F.lit("unknown_prefix_"), prefix))
        .when(messages.isNull(), "bad_conversation")
        .otherwise(F.concat(F.lit("pool_"), prefix))
    )


def question_answer(question: Column, answer: Column) -> Column:
    """A two-turn message list of a question and an answer."""
    return F.array(F.struct(F.lit("user").alias("role"), question.alias("content")), F.struct(F.lit("assistant").alias("role"), answer.alias("content")))


def video_turns(question: Column, answer: Column) -> Column:
    """The two turns of a video annotation: a media tag before the question, both stripped; null if either is."""
    return question_answer(F.concat(F.lit("<video>\n"), _stripped(question)), _stripped(answer))


def first_turn(turns: Column, side: str = "human") -> Column:
    """Text of the first turn of a side, empty if it has none."""
    return F.coalesce(F.get(F.filter(turns, lambda t: t["from"] == side), F.lit(0))["value"], F.lit(""))


def routed(df: DataFrame) -> DataFrame:
    """``id, media_type, images, videos, media`` of ``id, kind, path``: one column filled, the other empty."""
    none, one = F.array().cast("array<string>"), F.array("path")
    return df.select("id", F.col("kind").alias("media_type"), F.when(F.col("kind") == "image", one).otherwise(none).alias("images"), F.when(F.col("kind") == "video", one).otherwise(none).alias("videos"), one.alias("media"))
