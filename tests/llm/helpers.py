"""Small document tables with everything in them that operators must bear."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that operators might want to name theirs like.
CLASHING = (
    "score", "size", "weight", "key", "stretch", "fp", "component_id", "block", "times", "held_out",
    "predicted", "found", "quality", "cluster", "shard", "rank", "language", "kinds", "word", "n", "taken",
)

_SYLLABLES = {
    "en": "th er on an re he in ed nd ha at en es of or nt ti ing tion ly".split(),
    "de": "er en ch de ei te in nd ge un st ung lich keit heit ver be sch".split(),
    "fr": "es de le en re nt on er la ou eau tion ment que aux elle ai".split(),
}
_COMMON = {
    "en": "the of and to in a is that for it".split(),
    "de": "der die und in den von zu das mit sich".split(),
    "fr": "de la le et les des en un du une".split(),
}


def prose(rng: random.Random, lang: str, words: int) -> str:
    """Invented prose: lines of sentences."""
    out = []
    for i in range(words):
        common = rng.random() < 0.4
        word = rng.choice(_COMMON[lang]) if common else "".join(rng.choices(_SYLLABLES[lang], k=rng.randint(1, 4)))
        out.append(word + (rng.choice([". ", ".\n", ", "]) if i % 9 == 8 else " "))
    return "".join(out).strip()


def rows(n: int = 60, seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    found = []
    for i in range(n):
        lang = ("en", "en", "de", "fr")[i % 4]
        text = prose(rng, lang, rng.randint(12, 120))
        found.append((i, text, lang, f"s{i % 3}" if i % 5 else "hot", len(text)))
    long = prose(rng, "en", 6000)
    found += [
        (n, None, "en", "s1", None),
        (n + 1, "", None, None, 0),
        (n + 2, " \t\n\x0b\x0c\r ", "de", "s2", 7),
        (n + 3, long, "en", "hot", len(long)),
        (n + 4, found[0][1], "en", "s1", 1),  # a copy
        (n + 5, found[0][1], None, None, 1),
        (5, found[5][1], found[5][2], found[5][3], 5),  # a repeated row
        (None, "the null id of the table and its text", "en", "s1", 9),
        (-7, "ÄÖÜ straße 東京 ١٢٣  nb sp \U0001f600 é", "zz", "s2", 3),
        (n + 6, "one", "en", "s0", 3),
        (n + 7, "12 34 !!", "en", "s0", 8),
    ]
    return found


def table(spark, data: list[tuple], clashing: bool = True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(data, SCHEMA)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING]) if clashing else df


def key(row) -> tuple:
    return tuple((v is None, str(v)) for v in row)


def found(df, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)
