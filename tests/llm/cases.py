"""Small tables with what the operators must stand: nulls, empty and very long texts, ties, repeated
rows, no rows, further columns with clashing names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double, size long, fp long, lead long, sig long, part long"
CLASHING = (True, 0.5, 7, 1, 2, 3, 4)
WORDS = "the of and thing eron stat Ñoño für ça über heonth anble 12 x.y - 42% naïve".split()


def words(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def frame(spark, rows):
    """From (doc_id, text[, lang, source])."""
    full = [(*r, *("en", "s")[len(r) - 2 :]) if len(r) < 4 else tuple(r) for r in rows]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), *CLASHING) for r in full], SCHEMA)


def odd_rows():
    rng = random.Random(5)
    long = words(rng, 30_000)
    base = [words(rng, 60) for _ in range(6)]
    return [
        (1, None), (2, ""), (3, "  \n\t"), (4, "Same Text here"), (5, "same text here"), (6, "same text here"), (6, "same text here"),
        (7, long), (8, long + " end"), (9, long), (None, "no id"), (None, None), (10, "ÀÉ"), (11, "àé"), (12, "a"), (12, "b"),
        *[(20 + i, t) for i, t in enumerate(base)], *[(30 + i, t + " tail") for i, t in enumerate(base)], (40, "aaaa" * 700), (41, "ab" * 900),
    ]
