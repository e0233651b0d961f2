"""Small tables with what operators must not stumble over."""

from __future__ import annotations

import random

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, text_key string, n_words string, slot string, spans string, path string, score string, unit string"


def prose(n: int, seed: int) -> str:
    r = random.Random(seed)
    part = ["an", "be", "co", "di", "el", "fo", "ga", "hi", "ju", "ka", "lo", "mu"]
    return " ".join("".join(r.choice(part) for _ in range(r.randint(1, 4))) for _ in range(n))


def texts() -> list[tuple]:
    long = prose(30_000, 1)
    passage = prose(60, 2)
    near = prose(200, 3).split()
    other = list(near)
    other[100] = "changed"
    cycle = "one two three " * 60
    rows = [
        (1, None),
        (2, ""),
        (3, "  \n\t "),
        (None, prose(80, 4)),
        (None, None),
        (4, long),
        (5, "x" * 60_000),
        (6, prose(120, 5)),
        (6, prose(120, 5)),
        (6, "Another text of the same id, mail a.b@c.de"),
        (7, " ".join(near)),
        (8, " ".join(other)),
        (9, prose(50, 6) + " " + passage + " " + prose(50, 7)),
        (10, prose(40, 8) + "\n" + passage + " tail"),
        (11, cycle),
        (12, "tiny text"),
        (13, "TINY text"),
        (14, "four 4111 1111 1111 1111 cards and +1 (499) 555-6503 at 10.0.0.255 or 10.0.0.256"),
        (15, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" and 4785380592391139 here'),
        (16, "é ñ ü ▁ 日本語のテキスト 🎈   end\r\n\x0b\x0ctabs\tand  two spaces "),
        (17, "Prose before.\nReleased under the MIT License."),
        (18, "Licensed under the Apache License, Version 2.0."),
        (19, long[:5000]),
        (20, "idiot " + prose(90, 9)),
        (21, passage),
    ]
    return rows


def rows() -> list[tuple]:
    out = []
    for k, (i, t) in enumerate(texts()):
        out.append((i, t, None if k % 5 == 0 else "en", None if k % 7 == 0 else f"src{k % 3}", None, "clash", None, "clash", None, None, None, None))
    return out


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def benchmark():
    t = dict(x for x in texts() if x[0] is not None)
    return [
        (1, " ".join(t[7].split()[20:60])),
        (2, "tiny TEXT"),
        (3, None),
        (4, ""),
        (None, " ".join(t[9].split()[30:45])),
        (5, t[21]),
        (5, t[21]),
        (6, t[21] + " more"),
        (70, "one two three one two three one two three one two three"),
    ]


def items(spark, some=True):
    return spark.createDataFrame(benchmark() if some else [], "item_id long, text string")


def marks(spark, some=True):
    found = [(i, 1, 1 if i == 20 else 0) for i in range(1, 22)] + [(20, 0, 0), (None, 1, 1), (3, None, None), (99, 1, 1)]
    return spark.createDataFrame(found if some else [], "doc_id long, quality int, toxic int")
