"""Rows that every text operator must take: nulls, empty and long texts, ties, repeats, clashing columns."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row int, key int, drops int, items int, "
          "text_crc32 int, shard int, score double, ids int, lines int")


def words(rng, n, size=6, letters="abcdeéß"):
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(1, size))) for _ in range(n)]


def odd_rows(seed=1, n=40):
    rng = random.Random(seed)
    out = []
    common = "A line that many documents share, of some length"
    for i in range(n):
        lines = [" ".join(words(rng, rng.randrange(1, 12))) for _ in range(rng.randrange(1, 6))]
        if i % 3 == 0:
            lines.insert(rng.randrange(len(lines)), ("  " if i % 2 else "") + common.upper() + "\t")
        out.append((i * 3, "\n".join(lines)))
    out += [(1000, None), (1001, ""), (1002, " \t\r\n "), (1003, "\n\n\n"), (None, "no id at all, but a text"), (None, None),
            (1004, out[3][1]), (1004, out[3][1]), (1005, out[3][1]), (1006, out[5][1].upper()), (1007, "x"),
            (1008, "日本語 \U0001f600 ▁ mark   \x00 \x1f end"), (-5, common), (1009, "a" * 5000 + " " * 300 + "b"),
            (1010, " ".join(words(rng, 30000)))]
    rng.shuffle(out)
    return out


def odd_docs(spark, rows=None):
    rows = odd_rows() if rows is None else rows
    full = [(i, t, "en", None, None if t is None else len(t), 1, None, 3, 4, 5, 6, 0.5, 7, 8) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df):
    return [tuple(r) for r in df.collect()]
