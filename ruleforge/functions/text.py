"""Scalar text functions over columns: tags, bullets, scores, options, templates, ids and paths."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Option letters, image extensions (counting accepts six, hashing three) and MIME types.
LETTERS = list("ABCDEFGHIJ")
COUNT_EXTENSIONS = ["png", "jpg", "jpeg", "gif", "bmp", "webp"]
HASH_EXTENSIONS = ["png", "jpg", "jpeg"]
MIME_TYPES = {"png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "gif": "image/gif", "bmp": "image/bmp", "webp": "image/webp"}


def strip(c: Column) -> Column:
    """Python's str.strip(): all white space, not only spaces."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def normalized(c: Column) -> Column:
    return F.upper(strip(c))


def tag_text(c: Column, tag: str, default: Column | str | None = "") -> Column:
    """Stripped text of the first ``<tag>...</tag>``, over lines; ``default`` (None: the whole text) where there is none."""
    pattern = f"(?s)<{tag}>(.*?)</{tag}>"
    other = strip(c) if default is None else F.lit(default) if isinstance(default, str) else default
    return F.when(c.rlike(pattern), strip(F.regexp_extract(c, pattern, 1))).otherwise(other)


def required_tags(c: Column, *tags: str) -> Column:
    """A struct of the texts of all tags; null unless each is there with some text."""
    texts = {t: tag_text(c, t) for t in tags}
    complete = None
    for x in texts.values():
        complete = (x != "") if complete is None else complete & (x != "")
    return F.when(complete, F.struct(*(x.alias(t) for t, x in texts.items())))


def _lines(c: Column) -> Column:
    return F.transform(F.split(F.coalesce(c, F.lit("")), "\n"), strip)


# Fixed value: the pattern is the format's.
def bullets(c: Column) -> Column:
    """Lines without their leading dashes and spaces; blank lines and a lone dash are dropped."""
    kept = F.filter(_lines(c), lambda x: (x != "") & (x != "-"))
    return F.transform(kept, lambda x: F.regexp_replace(x, "^[- ]+", ""))


def numbered_bullets(c: Column) -> Column:
    """Lines without leading dashes, digits, dots and spaces; empty ones, headings and asides are dropped."""
    bare = F.transform(_lines(c), lambda x: F.regexp_replace(x, r"^[\-\d\.\s]+", ""))
    return F.filter(bare, lambda x: (x != "") & ~x.startswith("#") & ~x.startswith("("))


def int_tag(c: Column, tag: str) -> Column:
    """A one- or two-digit number in a tag of any case, else null."""
    return F.regexp_extract(c, rf"(?is)<{tag}>\s*(\d{{1,2}})\s*</{tag}>", 1).try_cast("int")


def int_tags(c: Column, *tags: str) -> Column:
    """A struct of the numbers in all tags; null unless each is there."""
    values = [int_tag(c, t) for t in tags]
    complete = values[0].isNotNull()
    for v in values[1:]:
        complete = complete & v.isNotNull()
    return F.when(complete, F.struct(*(v.alias(t) for t, v in zip(tags, values, strict=True))))


# Fixed value: the pattern is the format's.
def labelled_score(c: Column, label: str) -> Column:
    return F.regexp_extract(c, rf"{label}:\s*(\d+)", 1).try_cast("int")


# Fixed value: the pattern is the format's.
def boxed(c: Column) -> Column:
    """Stripped content of the first ``\\boxed{...}`` on one line; null where there is none, empty for an empty box."""
    pattern = r"\\boxed\{(.*?)\}"
    return F.when(c.rlike(pattern), strip(F.regexp_extract(c, pattern, 1)))


def id_attempt(c: Column) -> Column:
    """struct<id, attempt> of a name like ``12_3``; null for other names."""
    pattern = r"^(\d+)_(\d+)$"
    part = lambda i: F.regexp_extract(c, pattern, i).try_cast("long")
    return F.when(c.rlike(pattern), F.struct(part(1).alias("id"), part(2).alias("attempt")))


def is_success(c: Column) -> Column:
    return F.coalesce(F.lower(c).contains("success"), F.lit(False))


def parsed_options(c: Column) -> Column:
    """map<string,string> of a JSON object; empty for anything else."""
    return F.coalesce(F.from_json(c, "map<string,string>"), F.create_map().cast("map<string,string>"))


def options_block(options: Column, quoted: bool = False) -> Column:
    """``k: v`` lines in map order, or ``"k": "v"`` ones."""
    line = (lambda e: F.concat(F.lit('"'), e["key"], F.lit('": "'), e["value"], F.lit('"'))) if quoted else (lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return F.array_join(F.transform(F.map_entries(options), line), "\n")


def rule_block(rules: Column) -> Column:
    """Each rule on a line of its own behind a dash."""
    return F.concat(F.lit("\n- "), F.array_join(rules, "\n- "))


def rendered(template: Column | str, **values: Column) -> Column:
    """The template with each ``{{name}}`` and ``{name}`` replaced, literally and in one pass: a name inside a value stays. Unknown names stay, null is empty."""
    text = {name: F.coalesce(value.cast("string"), F.lit("")) for name, value in values.items()}
    if isinstance(template, str):
        parts, at = [], 0
        for m in re.finditer(r"\{\{(\w+)\}\}|\{(\w+)\}", template):
            name = m.group(1) or m.group(2)
            if name in text:
                parts += [F.lit(template[at : m.start()]), text[name]]
                at = m.end()
        return F.concat(*parts, F.lit(template[at:]))
    out = template
    for i, name in enumerate(text):  # first all places are marked, then filled
        out = F.replace(F.replace(out, F.lit("{{" + name + "}}"), F.lit(f"\0{i}\0")), F.lit("{" + name + "}"), F.lit(f"\0{i}\0"))
    for i, value in enumerate(text.values()):
        out = F.replace(out, F.lit(f"\0{i}\0"), F.replace(value, F.lit("\0"), F.lit("")))
    return out


def content_parts(text: Column, marker: str, image: Column) -> Column:
    """array<struct<type, text, data>>: the text split at ``marker``, the image where the marker stood; text alone without an image."""
    part = lambda kind, t, d: F.struct(F.lit(kind).alias("type"), t.alias("text"), d.alias("data"))
    none = F.lit(None).cast("string")
    at = F.locate(marker, text)
    before, after = F.substr(text, F.lit(1), at - 1), F.substr(text, at + len(marker))
    shown = F.filter(F.array(part("text", before, none), part("image", none, image), part("text", after, none)), lambda p: (p["type"] == "image") | (strip(p["text"]) != ""))
    return F.when((at > 0) & image.isNotNull(), shown).otherwise(F.array(part("text", F.replace(text, F.lit(marker), F.lit("")), none)))


def chat_prompt(user: Column, system: str) -> Column:
    """One user turn with an image in the vision model's chat form. The marks are fixed values of that form."""
    return F.concat(F.lit(f"<|im_start|>system\n{system}<|im_end|>\n<|im_start|>user\n<|vision_start|><|image_pad|><|vision_end|>"), user, F.lit("<|im_end|>\n<|im_start|>assistant\n"))


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)$", 1)


def extension(path: Column, default: str = "") -> Column:
    """With its dot."""
    found = F.regexp_extract(base_name(path), r"(\.[^.]*)$", 1)
    return F.when(found == "", F.lit(default)).otherwise(found)


def mime_type(path: Column, default: str = "image/png") -> Column:
    kinds = F.create_map(*(F.lit(x) for kv in MIME_TYPES.items() for x in kv))
    return F.coalesce(F.try_element_at(kinds, F.lower(F.ltrim(extension(path), F.lit(".")))), F.lit(default))


def renamed_image(new_id: Column, path: Column) -> Column:
    return F.concat(F.lit("image_"), new_id.cast("string"), extension(path, ".png"))


def absolute_path(path: Column, root: str) -> Column:
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))


def prefix_key(c: Column) -> Column:
    """The number before the first underscore; null where there is none."""
    return F.split_part(c, F.lit("_"), F.lit(1)).try_cast("long")


def all_given(*columns: Column) -> Column:
    """True where every text is not null and not empty."""
    out = F.lit(True)
    for c in columns:
        out = out & F.coalesce(c.cast("string") != "", F.lit(False))
    return out


def duration(seconds: Column) -> Column:
    s = F.floor(seconds)
    return F.when(s >= 3600, F.format_string("%dh %dm %ds", F.floor(s / 3600), F.floor((s % 3600) / 60), s % 60)).when(s >= 60, F.format_string("%dm %ds", F.floor(s / 60), s % 60)).otherwise(F.format_string("%ds", s))


def as_array(c: Column, is_array: bool) -> Column:
    return c if is_array else F.when(c.isNotNull(), F.array(c))
