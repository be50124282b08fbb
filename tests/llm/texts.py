"""Small document sets with the awkward rows every operator has to take."""

import random

KINDS = "doc_id long, text string, score string, rule string, licence string, line string, path string"


def prose(n, seed, vocabulary=400):
    """n words of a made-up vocabulary."""
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}x" for _ in range(n))


def frame(spark, rows, extra=True):
    """``doc_id, text`` and columns whose names operators use themselves."""
    if not extra:
        return spark.createDataFrame(rows, "doc_id long, text string")
    return spark.createDataFrame([(*r, "s", "r", "l", "n", f"a/b/{r[0]}") for r in rows], KINDS)


def awkward():
    long = prose(30_000, 1)
    return [
        (None, None),
        (None, prose(40, 2)),
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, long),
        (5, long),
        (6, prose(40, 3)),
        (6, prose(40, 3)),
        (7, prose(40, 3)),
        (8, "one"),
        (9, "one"),
        (-10, "Éa ß 数字 🙂 don't  x.y,z <|endoftext|>"),
    ]
