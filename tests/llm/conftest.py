import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, component string, size string, a string, n int"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))


def edited(rng, text, times):
    words = text.split(" ")
    for _ in range(times):
        words[rng.randrange(len(words))] = "zz" + str(rng.randrange(1000))
    return " ".join(words)


@pytest.fixture(scope="session")
def texts():
    """Copies, near copies, shared passages, blank, short and long texts."""
    rng = random.Random(5)
    base = [prose(rng, rng.randint(20, 120)) for _ in range(25)]
    shared = prose(rng, 60)
    out = list(base)
    out += [base[0], base[0], base[1].upper(), base[2] + " end", "", " \n\t", None, "one two", "ONE two", "one two three four five", "é" * 40 + " ünï " * 20, "é" * 40 + " ünï " * 20 + "x"]
    out += [edited(rng, base[3], k) for k in (1, 2, 3, 5, 8)]
    out += [prose(rng, 15) + " " + shared + " " + prose(rng, 10) for _ in range(4)]
    out += ["ab" * 4000, "ab" * 4000 + "c", prose(rng, 9000), "x\x0by z\x85w q r s", "same same same same same same same"]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """With null and repeated ids, and columns whose names the operators use inside."""
    rng = random.Random(6)
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = [(i * 3, t, rng.choice(["en", "fr", None]), rng.choice(["s0", "s0", "s1", "é", None]), len(t or ""), "k", "c", "s", "a", 1) for i, t in zip(ids, texts, strict=True)]
    rows += [rows[0], rows[3], (None, rows[1][1], "en", "s0", 1, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
