"""Chat formatting with typed content parts, in DataFrame functions only.

A turn holds plain text or an array of parts: struct<type, text, uri, width, height, seconds, pages>. Text parts
keep their text; image, audio and document parts become placeholders ``<|image:2|>`` that number the attachments of the
turn in order, and each is recorded with its reference and the number of tokens it expands to. Parts are joined by a newline.

Template of a turn: ``<|turn|>`` role newline body ``<|end|>`` newline. A control string inside a text or role gets a
backslash after its first character (one more, if it has some already), so texts cannot open or close a turn and the
step can be undone. The loss mask is a list of code point ranges of the formatted text, one for each assistant body.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TURN, END = "<|turn|>", "<|end|>\n"
#: What may not stand in a text as it is: the template's own marks and the markers of common instruction templates.
_CONTROL = r"(\||/?s>|/?INST\]|/?SYS>)"
ESCAPE = (r"(<|\[)(\\*)" + _CONTROL, r"$1\\$2$3")
UNESCAPE = (r"(<|\[)\\(\\*)" + _CONTROL, r"$1$2$3")
#: Image patches have this side, audio this many tokens a second, a document page this many tokens.
PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 12.5, 768


def escape(c: Column) -> Column:
    return F.regexp_replace(c, *ESCAPE)


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, *UNESCAPE)


def escape_role(c: Column) -> Column:
    return F.replace(F.replace(escape(c), F.lit("&"), F.lit("&amp;")), F.lit("\n"), F.lit("&#10;"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(F.replace(c, F.lit("&#10;"), F.lit("\n")), F.lit("&amp;"), F.lit("&")))


def part_tokens(p: Column) -> Column:
    """Tokens that an attachment expands to, one at least; unknown sizes count as one unit."""
    side = lambda name: F.ceil(F.coalesce(p[name], F.lit(1)) / F.lit(PATCH))
    image = side("width") * side("height")
    audio = F.ceil(F.coalesce(p["seconds"], F.lit(0.0)) * F.lit(AUDIO_RATE))
    pages = F.coalesce(p["pages"], F.lit(1)) * F.lit(PAGE_TOKENS)
    return F.greatest(F.when(p["type"] == "image", image).when(p["type"] == "audio", audio).otherwise(pages).cast("long"), F.lit(1).cast("long"))


def _visited(parts: Column) -> tuple[Column, Column]:
    """(body, attachments) of an array of parts; null parts are passed over, unknown types count as documents."""
    parts = F.filter(F.coalesce(parts, F.array()), lambda p: p.isNotNull())
    is_text = lambda p: F.coalesce(p["type"], F.lit("text")) == "text"
    kind = lambda p: F.when(p["type"].isin("image", "audio"), p["type"]).otherwise(F.lit("document"))
    # the number of a part among the attachments: how many stand before it
    nth = lambda p, i: F.size(F.filter(F.slice(parts, F.lit(1), i + 1), lambda q: ~is_text(q)))
    body = F.transform(parts, lambda p, i: F.when(is_text(p), escape(F.coalesce(p["text"], F.lit("")))).otherwise(F.concat(F.lit("<|"), kind(p), F.lit(":"), nth(p, i).cast("string"), F.lit("|>"))))
    attached = F.filter(
        F.transform(parts, lambda p, i: F.struct(nth(p, i).alias("number"), F.when(~is_text(p), kind(p)).alias("kind"), p["uri"].alias("uri"), part_tokens(p).alias("tokens"))),
        lambda a: a["kind"].isNotNull(),
    )
    return F.array_join(body, "\n"), attached


def typed(turns: DataFrame) -> DataFrame:
    """The turns with their text as an array of one typed text part."""
    part = "named_struct('type', 'text', 'text', cast(text as string), 'uri', cast(null as string), 'width', cast(null as int), 'height', cast(null as int), 'seconds', cast(null as double), 'pages', cast(null as int))"
    return turns.withColumn("parts", F.array(F.expr(part))).drop("text")


def format_chats(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conv_id: n_turns, formatted, loss (array of start, stop), masks (the same with one entry a turn, null outside the loss, and ``at``, where the
    range starts in its turn), attachments, n_tokens_attached.

    turns needs conv_id, turn, role and text, or parts instead of text; if both, parts count where they aren't null.
    Turns are ordered by turn (null first), then role, then body. Null roles and texts count as empty. Repeated rows stay,
    each as a turn. Rows with a null conv_id form one conversation of a null conv_id. An empty table gives no rows.
    """
    body, attached = escape(F.coalesce(F.col("text").cast("string"), F.lit(""))) if "text" in turns.columns else F.lit(""), F.lit(None)
    if "parts" in turns.columns:
        visited, found = _visited(F.col("parts"))
        body, attached = F.when(F.col("parts").isNotNull(), visited).otherwise(body), found
    head = F.concat(F.lit(TURN), escape_role(F.coalesce("role", F.lit(""))), F.lit("\n"))
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), head.alias("head"), body.alias("body"), *([attached.alias("attached")] if "parts" in turns.columns else []))
    rows = rows.withColumn("rendered", F.concat("head", "body", F.lit(END)))
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    rows = rows.withColumn("n", F.row_number().over(before)).withColumn("offset", F.coalesce(F.sum(F.length("rendered")).over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    start = F.col("offset") + F.length("head")
    one = [F.col("n"), F.col("rendered"), F.when(F.col("role") == loss_role, F.struct(start.alias("start"), (start + F.length("body")).alias("stop"), F.length("head").alias("at"))).alias("loss")]
    if "parts" in turns.columns:
        one.append(F.transform("attached", lambda a: F.struct(F.col("n").alias("turn"), a["number"].alias("number"), a["kind"].alias("kind"), a["uri"].alias("uri"), a["tokens"].alias("tokens"))).alias("attached"))
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(*one))).alias("t"))
    out = [
        "conv_id",
        F.size("t").cast("long").alias("n_turns"),
        F.array_join(F.col("t.rendered"), "").alias("formatted"),
        F.transform(F.filter(F.col("t.loss"), lambda s: s.isNotNull()), lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"))).alias("loss"),
        F.col("t.loss").alias("masks"),
    ]
    if "parts" in turns.columns:
        every = F.flatten(F.filter(F.col("t.attached"), lambda a: a.isNotNull()))
        out += [every.alias("attachments"), F.aggregate(every, F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("n_tokens_attached")]
    return chats.select(*out)


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a formatted conversation; placeholders stay in the text."""
    pieces = F.split(formatted, r"<\|turn\|>")
    pieces = F.slice(pieces, F.lit(2), F.size(pieces))
    raw = lambda p: F.substring_index(p, "\n", 1)
    text = lambda p: F.substr(p, F.length(raw(p)) + 2, F.length(p) - F.length(raw(p)) - 1 - F.lit(len(END)))
    return F.transform(pieces, lambda p: F.struct(unescape_role(raw(p)).alias("role"), unescape(text(p)).alias("text")))


def read_loss(formatted: Column, loss: Column) -> Column:
    """The unescaped texts under the loss mask, in order, with nothing between."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int")))), "")


def read_masked(formatted: Column, masks: Column) -> Column:
    """What read_loss() gives, turn by turn: a conversation of very many turns is split once instead of being walked for each range."""
    pieces = F.split(formatted, r"<\|turn\|>")
    body = lambda p, m: F.when(m.isNotNull(), unescape(F.substr(p, m["at"] - len(TURN) + 1, (m["stop"] - m["start"]).cast("int")))).otherwise(F.lit(""))
    return F.array_join(F.zip_with(F.slice(pieces, F.lit(2), F.size(pieces)), masks, body), "")


def digests(turns: DataFrame) -> DataFrame:
    """One row per conv_id with digests of what reading back its formatted text gives; nulls, repeats, ties and empty tables as in format_chats()."""
    chats = format_chats(turns)
    texts = F.array_join(F.transform(read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    chats = chats.select("conv_id", "n_turns", texts.alias("texts"), read_masked(F.col("formatted"), F.col("masks")).alias("lost"), F.length("formatted").cast("long").alias("formatted_chars"))
    return chats.select("conv_id", "n_turns", F.sha2("texts", 256).alias("turns_sha256"), F.length("lost").cast("long").alias("loss_chars"), F.sha2("lost", 256).alias("loss_sha256"), "formatted_chars")


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce("text", '') AS txt FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, regexp_replace(txt, '(<|\[)(\\*)(\||/?s>|/?INST\]|/?SYS>)', '\1\\\2\3', 'g') AS esc FROM c
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || txt || chr(10), '' ORDER BY turn NULLS FIRST, role, esc)) AS turns_sha256,
  coalesce(sum(length(txt)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(txt, '' ORDER BY turn NULLS FIRST, role, esc) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|turn|>' || role || chr(10) || esc || '<|end|>' || chr(10)))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
