"""Small tables with everything that may go wrong in them."""

from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, node long, token long, row string, rid long, kind string, "
          "block long, bucket string, words string, target boolean, label int, score double, start long, place long")
LABELS = "doc_id long, quality int, toxic int, text string, label int, kept boolean"

SYLLABLES = "ka lo mi ren tas vo du shi per an ost ule".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    out = []
    for k in range(words):
        word = "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))
        out.append(word.capitalize() if k % 11 == 0 else word)
        if k % 11 == 10:
            out[-1] += "."
    text = " ".join(out)
    return text.replace(". ", ".\n", words // 40)


def edited(text: str, seed: int, edits: int) -> str:
    rng = random.Random(seed)
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = "changed" + str(rng.randrange(1000))
    return " ".join(words)


def documents() -> list[tuple]:
    texts: list[tuple] = []
    for k in range(40):
        texts.append((10 + k, prose(k, 30 + 9 * k)))
    texts += [(100 + k, edited(prose(5, 75), k, 1 + k % 4)) for k in range(12)]  # near copies of 15
    texts += [(200 + k, prose(7, 93)) for k in range(6)]  # exact copies of 17
    texts += [(300, None), (301, ""), (302, " \n\t "), (303, "one"), (304, "One two  three"), (305, "one two three"), (306, "é ü 漢字 \U0001f600 x y z")]
    texts += [(None, "a text whose number is not known but which has words enough"), (None, None), (None, prose(9, 60))]
    texts += [(400, prose(400, 50))] * 3  # repeated rows
    texts += [(401, "same id first text of the two"), (401, "same id second text of the two")]
    texts += [(500, prose(500, 9000)), (501, "word " * 3000), (502, "x" * 60_000), (503, "7" * 30_000 + " " + "a.b@" * 2000)]
    texts += [(600 + k, "\n".join([prose(600 + k, 12)] * 4)) for k in range(3)]
    out = []
    for k, (i, t) in enumerate(texts):
        source = [None, "", "src0", "src0", "src0", "src1", "src2"][k % 7]
        out.append((i, t, "en", source, len(t) if t is not None else None, k, k, "row", k, "kind", k, "b", "w", True, 1, 0.5, k, k))
    return out


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
