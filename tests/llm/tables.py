"""Small tables with the awkward cases every operator must stand."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, key string, id long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", "."]) for _ in range(n))


def prose(rng: random.Random, lines: int) -> str:
    return "\n".join(sentence(rng, rng.randint(3, 14)) for _ in range(lines))


def documents(spark, texts, ids=None):
    """A documents table with extra columns whose names are used inside."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", None if t is None else len(t), "k", 7) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCUMENTS)


def mixed_texts(seed: int = 5, n: int = 40) -> list:
    """Prose with exact and near copies, empty, null and long texts."""
    rng = random.Random(seed)
    texts: list = [prose(rng, rng.randint(1, 6)) for _ in range(n)]
    texts += [texts[0], texts[0], texts[1], texts[2] + " omega", "psi " + texts[3], None, "", "  \n ",
              "one", "ONE", "one two three four five", prose(rng, 400), "é ß 中文 😀 <|endoftext|> x"]
    return texts
