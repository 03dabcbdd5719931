"""Keyed merges between stages. Right sides are made unique first: the last row of a key wins, by the column ``pos`` where the side has one, else
the greatest row, so that reruns agree. So no join multiplies rows.

Joins carry no broadcast hints: statistics and adaptive execution choose the side, as neither side has a bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.keyed import dense_ids, first_wins, last_wins, overlay
from ..functions.text import normalized, prefix_key

COPIED = ("rule_content", "question_type", "knowledge_point", "has_duplicate", "accuracy")


def unique(df: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """One row a key, without the position: the last one, or without a position the greatest."""
    if pos in df.columns:
        return last_wins(df, key, pos=pos).drop(pos)
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max(F.struct(*rest)).alias("_row")).select(key, *(F.col("_row")[c].alias(c) for c in rest)).select(*df.columns)


def replaced(left: DataFrame, right: DataFrame, key: str, field: str, new: str) -> DataFrame:
    """Left rows with ``field`` replaced by the right's last ``new`` where both are there; ``matched`` and ``replaced`` tell what happened.

    Right rows without a key count for nothing, those without a new value as a match that replaces nothing.
    """
    value = F.max_by(new, F.when(F.col(new).isNotNull(), F.col("pos"))) if "pos" in right.columns else F.max(new)
    r = right.filter(F.col(key).isNotNull()).groupBy(key).agg(value.alias("_new"), F.lit(True).alias("_there"))
    out = left.join(r, key, "left")
    done = F.col("_new").isNotNull() & F.col(field).isNotNull()
    return out.select(
        *(F.when(done, F.col("_new")).otherwise(F.col(c)).alias(c) if c == field else F.col(c) for c in left.columns),
        F.coalesce("_there", F.lit(False)).alias("matched"),
        done.alias("replaced"),
    )


def _kept(df: DataFrame, *columns: str) -> list[str]:
    """The columns, and the position if there is one."""
    return [*dict.fromkeys(columns), *(["pos"] if "pos" in df.columns and "pos" not in columns else [])]


def merge_counters(replaced_rows: DataFrame) -> DataFrame:
    """One row: how many rows were replaced, had no partner, or lacked the field."""
    return replaced_rows.agg(
        F.count_if("replaced").alias("replaced"),
        F.count_if(~F.col("matched")).alias("missing"),
        F.count_if(F.col("matched") & ~F.col("replaced")).alias("no_field"),
    )


def with_counters(replaced_rows: DataFrame, name: str = "merge") -> tuple[DataFrame, Observation]:
    """The rows, and what an action on them counts on its way: how many were replaced, had no partner, or lacked the field. The counters are there once an action has run over all rows."""
    return observed(replaced_rows, name, replaced=F.count_if("replaced"), missing=F.count_if(~F.col("matched")), no_field=F.count_if(F.col("matched") & ~F.col("replaced")))


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """The rows and an observation of named aggregates, from one execution; ``counters()`` waits for it."""
    seen = Observation(name)
    return df.observe(seen, *(m.alias(n) for n, m in metrics.items())), seen


def counters(seen: Observation) -> dict:
    """The observed aggregates; blocks until an action over all rows is over."""
    return dict(seen.get)


def correct_rows(predictions: DataFrame, answer: str, truth: str, key: str = "id") -> DataFrame:
    """Rows whose answer equals the truth, without case and outer white space; a null side never counts, two empty ones do."""
    return predictions.filter(F.col(key).isNotNull() & (normalized(F.col(answer)) == normalized(F.col(truth))))


def reindexed(correct: DataFrame, questions: DataFrame, key: str = "id", pos: str = "pos") -> DataFrame:
    """Questions of the correct ids under dense new ids; ids are numbered before the join, so one without a question leaves a gap."""
    numbered = last_wins(dense_ids(correct.select(key, pos), pos, "new_id"), key)
    return questions.join(numbered.select(key, "new_id"), key)


def with_defaults(left: DataFrame, right: DataFrame, key: str, fields: tuple[str, ...], default: str = "") -> DataFrame:
    """Left rows with ``fields`` of the right's last row of the key; ``default`` where there is none or a field is null."""
    r = unique(right.select(*_kept(right, key, *fields)), key).select(key, *(F.col(f).alias(f"_{f}") for f in fields))
    return left.join(r, key, "left").select(*(c for c in left.columns if c not in fields), *(F.coalesce(F.col(f"_{f}").cast("string"), F.lit(default)).alias(f) for f in fields))


def remapped_parents(rules: DataFrame, own: DataFrame, other: DataFrame, key: str = "id", parents: str = "parents") -> DataFrame:
    """(key, parents): parents under the ids of the first map that knows them, own before other; unknown ones go, order stays.

    ``own`` and ``other`` are (old_id, new_id).
    """
    each = rules.select(key, F.posexplode_outer(parents).alias("_at", "_old"))
    a, b = own.select(F.col("old_id").alias("_old"), F.col("new_id").alias("_a")), other.select(F.col("old_id").alias("_old"), F.col("new_id").alias("_b"))
    found = each.join(a, "_old", "left").join(b, "_old", "left").withColumn("_new", F.coalesce("_a", "_b"))
    pair = F.when(F.col("_new").isNotNull(), F.struct("_at", "_new"))
    return found.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(pair)), lambda p: p["_new"]).alias(parents))


def overlaid_scores(rules: DataFrame, scores: DataFrame, key: str = "id") -> DataFrame:
    """The last row of each rule that has scores, with the fields of its last scores on top."""
    return overlay(last_wins(rules, key) if "pos" in rules.columns else rules, unique(scores, key), key, "inner")


def with_meta(puzzles: DataFrame, rules: DataFrame, key: str = "id") -> DataFrame:
    """Puzzles with rule_content (empty where the rule has none) and the tags of the rule's last row; those without a rule have nulls."""
    r = unique(rules.select(*_kept(rules, key, "rule_content", "question_type", "knowledge_point")), key).select(key, F.coalesce("rule_content", F.array().cast("array<string>")).alias("rule_content"), "question_type", "knowledge_point")
    return puzzles.join(r, key, "left")


def without_blank(puzzles: DataFrame, summary: DataFrame, key: str = "id") -> DataFrame:
    """Puzzles whose last hash summary isn't blank, with has_duplicate. Summary ids are strings."""
    s = summary.withColumn(key, F.col(key).try_cast("long")).filter(F.col(key).isNotNull())
    s = unique(s.select(*_kept(s, key, "has_duplicate", "has_blank")), key)
    return puzzles.join(s, key).filter(~F.col("has_blank")).drop("has_blank")


def with_scores(questions: DataFrame, scores: DataFrame, key: str = "id", pos: str = "pos") -> DataFrame:
    """The first question of each id with the last scores of it."""
    return first_wins(questions, key, pos=pos).join(last_wins(scores, key, pos=pos).drop(pos), key, "left")


def with_accuracy(details: DataFrame, accuracy: DataFrame, key: str = "id") -> DataFrame:
    """Details (string or number ids) with the last accuracy under the same number; keys that are no number match nothing."""
    a = accuracy.select(F.col("key").try_cast("long").alias("_id"), F.col("value").alias("accuracy"), *(["pos"] if "pos" in accuracy.columns else [])).filter(F.col("_id").isNotNull())
    a = unique(a, "_id")
    return details.withColumn("_id", F.col(key).try_cast("long")).join(a, "_id", "left").drop("_id")


def with_details(variants: DataFrame, details: DataFrame, fields: tuple[str, ...] = COPIED, key: str = "id", on: Column | None = None, null_accuracy: bool = False) -> DataFrame:
    """Variants (``12_A``) with fields of the last row of their base (12), and ``matched``; accuracy is null if asked. Base ids that are no number match nothing."""
    d = details.withColumn(key, F.col(key).try_cast("long")).filter(F.col(key).isNotNull())
    d = unique(d.select(*_kept(d, key, *fields)), key).select(F.col(key).alias("_id"), *(F.col(f).alias(f"_{f}") for f in fields), F.lit(True).alias("_there"))
    on = prefix_key(F.col(key)) if on is None else on
    out = variants.withColumn("_id", on).join(d, "_id", "left")
    value = lambda f: F.lit(None).cast("double") if null_accuracy and f == "accuracy" else F.col(f"_{f}")
    return out.select(*(c for c in variants.columns if c not in fields), *(value(f).alias(f) for f in fields), F.coalesce("_there", F.lit(False)).alias("matched"))


def owed(items: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Items that no record mentions, error records included."""
    return items.join(done.select(key).distinct(), key, "left_anti")


def owed_requests(items: DataFrame, done: DataFrame, total: int = 8, key: str = "id") -> DataFrame:
    """One row per request still owed: (item columns, attempt); finished items are left out before the range is built."""
    counts = done.groupBy(key).agg(F.count("*").alias("_n"))
    left = items.join(counts, key, "left").withColumn("_n", F.coalesce("_n", F.lit(0))).filter(F.col("_n") < total)
    return left.withColumn("attempt", F.explode(F.sequence(F.col("_n") + 1, F.lit(total).cast("long")))).drop("_n")


def known(ids: DataFrame, valid: DataFrame, key: str = "id") -> DataFrame:
    return ids.join(valid.select(key), key, "left_semi")


def by_position(responses: DataFrame, requests: DataFrame, custom_id: str = "custom_id") -> DataFrame:
    """Batch responses ``req-<n>`` joined to the request at position n; malformed and out-of-range ones go."""
    n = F.regexp_extract(custom_id, r"^req-(\d+)$", 1).try_cast("long")
    return responses.withColumn("pos", n).filter("pos is not null").join(requests, "pos")


def by_id(responses: DataFrame, requests: DataFrame, custom_id: str = "custom_id", key: str = "id") -> DataFrame:
    return responses.withColumn(key, F.col(custom_id).try_cast("long")).filter(F.col(key).isNotNull()).join(requests, key)


def united_styles(styles: list[DataFrame], key: str = "id") -> DataFrame:
    """The styles one after another, ids with the style's number behind them, counted from 1."""
    out = None
    for i, s in enumerate(styles, 1):
        s = s.withColumn(key, F.concat_ws("_", F.col(key).cast("string"), F.lit(i)))
        out = s if out is None else out.unionByName(s, allowMissingColumns=True)
    return out


def united_rules(first: DataFrame, second: DataFrame, key: str = "id", pos: str = "pos") -> DataFrame:
    """Both rule sets under dense ids: of each set the seeds, then the evolved ones, parents mapped by their own set first."""
    step = F.col("_src") * 2 + F.col("_kind")
    rows = None
    for i, df in enumerate((first, second)):
        df = df.withColumn("_src", F.lit(i)).withColumn("_kind", (F.col("generation") > 0).cast("int"))
        rows = df if rows is None else rows.unionByName(df)
    rows = rows.withColumn("_step", step)
    sizes = {r._step: r.n for r in rows.groupBy("_step").agg(F.count("*").alias("n")).collect()}  # four rows at most
    before = {s: sum(n for t, n in sizes.items() if t < s) for s in sizes}
    shift = F.create_map(*(F.lit(x) for kv in before.items() for x in kv)) if before else F.create_map(F.lit(0), F.lit(0))
    rows = dense_ids(rows, pos, "_nth", by=("_step",), ties=(key,)).withColumn("new_id", F.col("_nth") + shift[F.col("_step")])
    maps = [rows.filter(F.col("_src") == i).select(F.col(key).alias("old_id"), "new_id") for i in (0, 1)]
    parts = []
    for i in (0, 1):
        mine = rows.filter(F.col("_src") == i).select("new_id", "parents")
        parts.append(remapped_parents(mine, maps[i], maps[1 - i], "new_id"))
    parents = parts[0].unionByName(parts[1])
    return rows.drop("parents", "_src", "_kind", "_step", "_nth").join(parents, "new_id").withColumnRenamed(key, "old_id").withColumnRenamed("new_id", key)
