"""A small table with nulls, empty and long texts, ties, repeated rows, copies and a clashing extra column."""

import random

SCHEMA = "doc_id long, text string, score string, words string"
LINE = "This line is repeated in very many documents."
PASSAGE = "one passage of words that several documents share word for word and that goes on until it is much longer than fifty bytes"
ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho"


def documents(n: int = 60, seed: int = 3) -> list[tuple]:
    r = random.Random(seed)
    words = ["".join(r.choice("aeioubdklmnrst") for _ in range(r.randint(2, 8))) for _ in range(400)] + ["the", "of", "and"] * 40
    prose = lambda k: " ".join(r.choice(words) for _ in range(k))
    rows = []
    for i in range(n):
        text = f"{prose(40)}\n{prose(25)}."
        if i % 5 == 0:
            text += f"\n  {LINE.upper() if i % 2 else LINE} \n{prose(5)}"
        if i % 7 == 0:
            text = f"{prose(6)} {PASSAGE} {prose(6)}"
        if i % 11 == 0:
            text += f" {ITEM.title()}, {prose(3)}"
        rows.append([i, text])
    rows[8][1], rows[9][1] = None, ""
    rows[13][1] = rows[12][1]
    rows[14][1] = rows[12][1]
    rows[20][1] = rows[21][1] + " tail"
    rows[22][1] = "  \t\n \n"
    rows[23][1] = prose(9000)
    rows[24][1] = "a" * 30_000
    rows[25][1] = "Äöü ñandú 漢字 \U0001f600 naïve\nÉCOLE École"
    rows.append([None, rows[30][1]])
    rows.append([None, None])
    rows.append([31, rows[31][1]])
    rows.append([32, "another text for an id that is there already"])
    return [(i, t, "x", "y") for i, t in rows]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
