"""Option lists of puzzles: four options, four variants of each, and ten options with relatives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keyed import u
from ..functions.text import LETTERS
from ..sources.tables import shuffled as by_shuffle

PROMPT4 = "Which of the four given options best completes the figure?"


def shuffled(options: Column, *key: Column | str | int) -> Column:
    """array<struct<source, image>>: the options in keyed random order, with the place each came from."""
    keyed = F.transform(options, lambda x, i: F.struct(u(*key, i).alias("k"), i.alias("source"), x.alias("image")))
    return F.transform(F.array_sort(keyed), lambda x: F.struct(x["source"].alias("source"), x["image"].alias("image")))


def label_of(order: Column, source: int = 0) -> Column:
    """The letter of the place where the option of index ``source`` went."""
    at = F.array_position(F.transform(order, lambda x: x["source"]), source)
    return F.element_at(F.array(*(F.lit(c) for c in LETTERS)), at.cast("int"))


def labelled(order: Column) -> Column:
    """map letter -> image."""
    n = F.size(order)
    return F.map_from_arrays(F.slice(F.array(*(F.lit(c) for c in LETTERS)), F.lit(1), n), F.transform(order, lambda x: x["image"]))


def four_options(groups: DataFrame, seed: int = 7, compat: bool = False, correct: str = "correct", incorrect: str = "incorrect", key: str = "id") -> DataFrame:
    """(id, question, options, correct_answer): four correct images ask, the fifth is the answer among three incorrect ones.

    ``compat`` labels every answer A, as a known flaw of the original data does.
    """
    order = shuffled(F.concat(F.array(F.element_at(correct, 5)), F.slice(incorrect, 1, 3)), seed, "options", F.col(key))
    rows = groups.filter((F.size(correct) == 5) & (F.size(incorrect) == 3)).withColumn("_order", order)
    return rows.select(key, F.slice(correct, 1, 4).alias("question"), labelled(F.col("_order")).alias("options"), (F.lit("A") if compat else label_of(F.col("_order"))).alias("correct_answer"))


def four_variants(groups: DataFrame, seed: int = 7, correct: str = "correct", incorrect: str = "incorrect", key: str = "id") -> DataFrame:
    """Four rows an id, ``<id>_A`` to ``<id>_D``: the answer in the named slot, the incorrect images shuffled over the others."""
    rows = groups.filter((F.size(correct) == 5) & (F.size(incorrect) == 3)).withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(3))))
    wrong = F.transform(shuffled(F.col(incorrect), seed, "variant", F.col(key), F.col("slot")), lambda x: x["image"])
    filled = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.when(i == F.col("slot"), F.element_at(correct, 5)).otherwise(F.get("_wrong", F.when(i < F.col("slot"), i).otherwise(i - 1))))
    letter = F.element_at(F.array(*(F.lit(c) for c in LETTERS)), F.col("slot") + 1)
    rows = rows.withColumn("_wrong", wrong)
    return rows.select(F.concat_ws("_", F.col(key).cast("string"), letter).alias(key), F.slice(correct, 1, 4).alias("question"), F.map_from_arrays(F.array(*(F.lit(c) for c in LETTERS[:4])), filled).alias("options"), letter.alias("correct_answer"))


def ten_options(groups: DataFrame, relatives: DataFrame, seed: int = 7, correct: str = "correct", incorrect: str = "incorrect", key: str = "id") -> DataFrame:
    """(id, options, correct_answer, relatives_used): the answer, three own and three incorrect images of each of two relatives.

    Ids without two relatives of three images each are left out.
    """
    pairs = relatives.filter(F.size("relatives") == 2).select(F.col("id").alias(key), F.col("relatives").alias("relatives_used"), F.element_at("relatives", 1).alias("_r1"), F.element_at("relatives", 2).alias("_r2"))
    wrong = lambda r: groups.filter(F.size(incorrect) == 3).select(F.col(key).alias(r), F.col(incorrect).alias(f"{r}_images"))
    rows = groups.filter((F.size(correct) == 5) & (F.size(incorrect) == 3)).join(by_shuffle(pairs), key).join(by_shuffle(wrong("_r1")), "_r1").join(by_shuffle(wrong("_r2")), "_r2")
    order = shuffled(F.concat(F.array(F.element_at(correct, 5)), F.col(incorrect), F.col("_r1_images"), F.col("_r2_images")), seed, "ten", F.col(key))
    return rows.withColumn("_order", order).select(key, labelled(F.col("_order")).alias("options"), label_of(F.col("_order")).alias("correct_answer"), "relatives_used")


def canvas(cell: Column, margin: Column, width: int = 800) -> tuple[Column, Column, Column]:
    """(width, height, scale) of a four-option sheet: five cells and two margins wide, fixed bands for text and labels between the two rows."""
    w = cell * 5 + margin * 2
    h = F.lit(50) + cell * 2 + F.lit(70 + 70 + 85) + margin
    return w, h, F.lit(float(width)) / w


def fitted(w: Column, h: Column, box_w: Column, box_h: Column) -> tuple[Column, Column, Column, Column]:
    """(width, height, left, top) of an image scaled into the middle of a box with its sides in proportion."""
    scale = F.least(box_w / w, box_h / h)
    nw, nh = F.greatest(F.lit(1), F.floor(w * scale).cast("int")), F.greatest(F.lit(1), F.floor(h * scale).cast("int"))
    return nw, nh, F.floor((box_w - nw) / 2).cast("int"), F.floor((box_h - nh) / 2).cast("int")
