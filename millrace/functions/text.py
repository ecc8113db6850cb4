"""Column builders for text, hashes and paths. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Image prefixes with the folder they map to, and those left out.
IMAGE_FOLDERS = {
    "coco": "coco/train2017",
    "gqa": "gqa/images",
    "textvqa": "textvqa/train_images",
    "vg": "vg",
    "sam": "sam/images",
}
KEEPS_TAIL = ("vg",)
EXCLUDED_PREFIXES = ("ocr_vqa",)
# Marks of probe and download failures, in the order they are tried.
PROBE_ERRORS = (("unavailable", "unavailable"), ("private", "private"), ("removed", "removed"), ("blocked", "blocked"), ("age", "age_restricted"))
FETCH_ERRORS = (("requested format", "no_format"), ("private", "private"), ("unavailable", "unavailable"), ("removed", "unavailable"))


def norm_text(s: Column) -> Column:
    """Trimmed, white space (Unicode) collapsed to one space, lower case. Null stays null."""
    return F.lower(F.trim(F.regexp_replace(s, r"(?U)\s+", " ")))


def text_hash(s: Column) -> Column:
    """SHA-1 of :func:`norm_text`."""
    return F.sha1(norm_text(s))


def messages_text(messages: Column) -> Column:
    """Messages as JSON text: line ends inside contents are escaped and so never collapse."""
    return F.to_json(messages)


def record_hash(messages: Column) -> Column:
    return text_hash(messages_text(messages))


def pair_hash(chosen: Column, rejected: Column) -> Column:
    """Hash of an answer pair; the question plays no part."""
    return text_hash(F.concat(F.coalesce(chosen, F.lit("")), F.lit("||"), F.coalesce(rejected, F.lit(""))))


def hash_stem(h: Column, n: int = 20) -> Column:
    return F.substring(h, 1, n)


def media_key(path: Column, size: Column) -> Column:
    """First 16 hex digits of the SHA-1 of ``basename:size``."""
    return F.substring(F.sha1(F.concat_ws(":", basename(path), size.cast("string"))), 1, 16)


def slug(config: Column) -> Column:
    """Eight hex digits of the MD5 of a configuration text, as a run marker."""
    return F.substring(F.md5(config), 1, 8)


def slashed(path: Column) -> Column:
    r"""``\`` to ``/`` and leading dots and slashes removed."""
    return F.regexp_replace(F.translate(path, "\\", "/"), r"^[./]+", "")


def path_prefix(path: Column) -> Column:
    return F.substring_index(slashed(path), "/", 1)


def basename(path: Column) -> Column:
    return F.substring_index(F.translate(path, "\\", "/"), "/", -1)


def resolve_image(path: Column, folders: Mapping[str, str] = IMAGE_FOLDERS, keeps_tail: Sequence[str] = KEEPS_TAIL) -> Column:
    """The stored place of an annotated image, or null if its prefix has none.

    A prefix in ``keeps_tail`` keeps the path below it, others only the name.
    """
    clean, prefix = slashed(path), path_prefix(path)
    tail = F.when(F.contains(clean, F.lit("/")), F.substring(clean, F.length(prefix) + F.lit(2), F.length(clean))).otherwise(F.lit(""))
    out = F.lit(None).cast("string")
    for name, folder in folders.items():
        end = tail if name in keeps_tail else basename(clean)
        out = F.when(prefix == name, F.concat(F.lit(folder + "/"), end)).otherwise(out)
    return out


def strip_prefix_once(s: Column, prefix: str) -> Column:
    return F.when(s.startswith(prefix), F.substring(s, len(prefix) + 1, 1 << 30)).otherwise(s)


def first_mark(s: Column, marks: Sequence[tuple[str, str]], otherwise: str = "error") -> Column:
    """The tag of the first mark that the lower-cased text contains."""
    low, out = F.lower(F.coalesce(s, F.lit(""))), None
    for mark, tag in marks:
        hit = F.contains(low, F.lit(mark))
        out = F.when(hit, tag) if out is None else out.when(hit, tag)
    return out.otherwise(otherwise)


def trim_answer(s: Column) -> Column:
    """Lower-cased answer without the white space and full stops, commas or marks at its end."""
    return F.regexp_replace(F.lower(s), r"(?U)^\s+|[\s.!。，,]+$", "")


# Names of answer tags, and the forms of numbers and scores below.
ANSWER_TAGS = ("answer", "solution", "final")


def inner_answer(s: Column) -> Column:
    """Text inside the first answer tag, thinking blocks removed; the whole text if there is none."""
    text = F.coalesce(s, F.lit(""))
    clean = F.when(F.contains(text, F.lit("<")), F.regexp_replace(text, r"(?is)<\s*think\s*>.*?<\s*/\s*think\s*>", " ")).otherwise(text)
    tagged = r"(?is)<\s*(" + "|".join(ANSWER_TAGS) + r")\s*>(.*?)<\s*/\s*\1\s*>"
    # few texts have a tag at all; only those are searched for a pair of them
    return F.when(F.contains(clean, F.lit("<")) & clean.rlike(tagged), F.regexp_extract(clean, tagged, 2)).otherwise(clean)


def normal_answer(s: Column) -> Column:
    """Canonical form of an answer for exact comparison."""
    inner = F.lower(F.trim(F.regexp_replace(inner_answer(s), r"(?U)^\s+|\s+$", "")))
    ended = F.regexp_replace(inner, r"[.。]+$", "")
    return F.trim(F.regexp_replace(F.translate(ended, "×÷", "*/"), r"(?U)\s+", " "))


def first_number(s: Column) -> Column:
    """First number of an answer, thousands commas dropped; null if there is none."""
    plain = F.translate(inner_answer(s), ",", "")
    return F.regexp_extract(plain, r"-?[0-9]+\.?[0-9]*", 0).try_cast("double")


def scraped_score(s: Column) -> Column:
    """First decimal number after acc, accuracy or score."""
    return F.regexp_extract(s, r"(?i)(?:acc|accuracy|score)[^0-9]*([0-9]+\.[0-9]+)", 1).try_cast("double")


def number_suffix(path: Column) -> Column:
    """The number after the last dash of a path, or null."""
    return F.regexp_extract(path, r"-([0-9]+)$", 1).try_cast("long")


def joined_contents(messages: Column) -> Column:
    """All contents, each followed by a line end."""
    return F.concat_ws("", F.transform(messages, lambda m: F.concat(F.coalesce(m["content"], F.lit("")), F.lit("\n"))))


def total_chars(messages: Column) -> Column:
    """Characters of all contents; null contents and null messages count 0."""
    return F.coalesce(F.aggregate(messages, F.lit(0).cast("long"), lambda n, m: n + F.coalesce(F.length(m["content"]), F.lit(0))), F.lit(0))


def looked_up(s: Column, names: Mapping[str, str]) -> Column:
    """The name a key has in a small mapping, or the key itself."""
    if not names:
        return s
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), s), s)


def word_count(s: Column) -> Column:
    """Runs of non-space characters."""
    return F.coalesce(F.regexp_count(s, F.lit(r"\S+")), F.lit(0))


def override_arguments(arguments: Sequence[str]) -> list[str]:
    """Command-line overrides in their ``key=value`` form.

    ``--k=v`` and ``--k v`` give ``k=v``, a flag gives ``k=true``, anything
    else stays.
    """
    out: list[str] = []
    waiting: str | None = None
    for a in [*arguments, None]:
        if waiting is not None:
            value = a if a is not None and not a.startswith("--") and "=" not in a else None
            out.append(f"{waiting}={'true' if value is None else value}")
            waiting = None
            if value is not None:
                continue
        if a is None:
            break
        if a.startswith("--") and "=" not in a:
            waiting = a[2:]
        else:
            out.append(a[2:] if a.startswith("--") else a)
    return out
