"""Preference records and schema unification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The columns under which sources name their fields, in the order tried.
CANDIDATES = {"problem": ("problem", "question", "query"), "answer": ("answer", "solution", "label")}


def _strip(s: Column) -> Column:
    return F.regexp_replace(s, r"(?U)^\s+|\s+$", "")


def parsed_preferences(df: DataFrame, text: str) -> DataFrame:
    """Preference records of a JSON column with question, chosen and rejected.

    Texts that do not parse, or lack one of the three, drop out. Other
    columns stay.
    """
    parsed = F.from_json(text, "question string, chosen string, rejected string")
    d = df.withColumn("_p", parsed)
    q, c, r = (_strip(F.col(f"_p.{k}")) for k in ("question", "chosen", "rejected"))
    have = (F.coalesce(q, F.lit("")) != "") & (F.coalesce(c, F.lit("")) != "") & (F.coalesce(r, F.lit("")) != "")
    say = lambda role, s: F.struct(F.lit(role).alias("role"), s.alias("content"))
    return d.where(have).select(*df.columns, F.array(say("user", q)).alias("messages"), say("assistant", c).alias("chosen"), say("assistant", r).alias("rejected"))


def best_and_worst(texts: Column, bonus: Column) -> Column:
    """``best`` and ``worst`` of texts: nearest and farthest from the bonus length, or, without one, longest and shortest.

    Ties keep the order of the texts: the best is the first, the worst the last.
    """
    merit = lambda t: F.when(bonus.isNull(), F.length(t)).otherwise(-F.abs(F.length(t) - bonus))
    ranked = F.array_sort(F.transform(texts, lambda t, i: F.struct((-merit(t)).alias("k"), i.alias("i"), t.alias("t"))))
    return F.struct(F.get(ranked, F.lit(0))["t"].alias("best"), F.element_at(ranked, -1)["t"].alias("worst"))


def first_available(df: DataFrame, names: Sequence[str]) -> str | None:
    """The first of the names that is a column; decided from the schema alone."""
    return next((n for n in names if n in df.columns), None)


def unified(sources: Mapping[str, DataFrame], candidates: Mapping[str, Sequence[str]] = CANDIDATES) -> DataFrame:
    """All sources under the candidate fields, with ``origin``; sources that lack a field are left out.

    Raises ``ValueError`` if no source has all fields.
    """
    out = None
    for name, df in sources.items():
        own = {field: first_available(df, names) for field, names in candidates.items()}
        if None in own.values():
            continue
        one = df.select(F.lit(name).alias("origin"), *[F.col(c).cast("string").alias(field) for field, c in own.items()])
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no source has all fields")
    return out


def image_column(df: DataFrame, candidates: Sequence[str] = ("decoded_image", "image", "images"), probe: int = 3) -> str | None:
    """The first candidate column that holds bytes in the first rows of the table.

    Columns of other types (a path, say) are passed over by their schema;
    only ``probe`` rows of the others are read.
    """
    for name in candidates:
        if name not in df.columns:
            continue
        kind = df.schema[name].dataType.simpleString()
        if kind == "binary":
            found = F.col(name)
        elif "bytes:binary" in kind:
            found = image_bytes(None, F.col(name)) if kind.startswith("array") else image_bytes(F.col(name), None)
        else:
            continue
        if df.select(found.alias("b")).limit(probe).where(F.length("b") > 0).limit(1).count():
            return name
    return None


def image_bytes(image: Column | None, images: Column | None) -> Column:
    """Bytes of an image struct, else of the first of an image list, else null."""
    found = [c for c in (image["bytes"] if image is not None else None, F.get(images, F.lit(0))["bytes"] if images is not None else None) if c is not None]
    return F.coalesce(*found) if found else F.lit(None).cast("binary")
