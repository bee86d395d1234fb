"""Small tables for the tests of the llm operators."""

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [a + b for a in ("ta", "mi", "ro", "ke", "lu", "so", "ne", "va") for b in ("", "n", "ri", "sto", "del", "ma", "ka")]


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + ("." if rng.random() < 0.1 else "") for _ in range(n))


def docs(spark, texts, start=0):
    """Documents numbered from `start`; a pair (id, text) sets the id."""
    rows = []
    for k, t in enumerate(texts):
        i, t = t if isinstance(t, tuple) else (start + k, t)
        rows.append((i, t, "en", "s", None if t is None else len(t)))
    return spark.createDataFrame(rows, DOC_SCHEMA)


def edge_texts():
    """NULL, empty, blank, short, repeated and very long texts."""
    long = prose(30_000, 5)
    return [None, "", "  \n\t ", "one", "one", prose(40, 1), prose(40, 1), long, "x" * 50_000, "é ß ñ 😀   ü"]
