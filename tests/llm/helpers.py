"""Small tables with the awkward rows every operator must answer."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, fp long, `lines` int, `__lines` int, own_id string, gone long, leak int, `a.b` int, component long"


def prose(seed: int, words: int) -> str:
    """Words of made-up syllables in sentences and lines."""
    rng = random.Random(seed)
    syllables = "ba ce di fo gu ha je ki lo mu na pe ri so tu".split()
    out = []
    for k in range(words):
        word = "".join(rng.choices(syllables, k=rng.randint(1, 4)))
        out.append(word.capitalize() if not k or out[-1].endswith((".", "\n")) else word)
        if rng.random() < 0.12:
            out[-1] += "."
        if rng.random() < 0.05:
            out[-1] += "\n"
    return " ".join(out).replace("\n ", "\n")


def frame(spark, texts: dict | list):
    """doc_id and text beside columns whose names clash with those the operators make."""
    rows = texts.items() if isinstance(texts, dict) else texts
    return spark.createDataFrame([(k, t, "xx", "src", -1, 9.5, 3, 4, 5, "own", 6, 7, 8, 9) for k, t in rows], SCHEMA)


def awkward() -> list:
    """Null, empty, blank and very long texts, odd separators, repeated rows, equal ids and a null id."""
    long = prose(99, 6000)
    return [
        (1, None), (2, ""), (3, " \n\t\n "), (4, long), (5, "one"), (5, "one"), (6, "two words"), (6, "Other text, same id."),
        (None, prose(5, 40)), (None, None), (7, "é　ñ \x1c ß\x85 <|endoftext|> </s>"), (8, "\x00 zero"), (9, "🙂🙂 12,5 kg $7"), (10, prose(5, 40)),
        (11, "\u0301\u0302"), (12, "Ⅷ"), (13, "\u200d"), (14, "12 ² _ !"),
    ]
