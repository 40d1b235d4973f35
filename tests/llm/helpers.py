"""Small document tables with everything that operators have to cope with."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, chunk string, part int, fp string, digest string, kept_id int"


def docs(spark, texts, ids=None, langs=None, partitions=3):
    """Rows with extra columns whose names operators use inside."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, (langs[k] if langs else None), None if k % 3 == 0 else "s", None if t is None else len(t), "x", k, None, "d", k) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions) if rows else spark.createDataFrame([], SCHEMA)


def prose(rng: random.Random, n: int, words=("the", "tion", "Ana", "ber", "é", "über", "st", "of", "x.", "naïve")) -> str:
    return " ".join("".join(rng.choice(words) for _ in range(rng.randint(1, 3))) for _ in range(n))


def odd_texts(seed: int = 1) -> list:
    """Nulls, empty, blank, one word, very long, astral, repeated, copied and nearly copied texts."""
    rng = random.Random(seed)
    base = prose(rng, 120)
    long = prose(rng, 30_000)
    return [None, "", " \t\n\x0b\f\r", "one", "two words", " 　", "😀 astral 😀𝒳", base, base, base + " tail", base.replace(" of", " off", 1), prose(rng, 40) + "\n" + base[100:700], long, "a" * 50_000, "same " * 400, prose(rng, 34), prose(rng, 35), prose(rng, 36), None, base, "café\x00zero", "0"]
