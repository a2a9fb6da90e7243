"""Fixtures shared by the tests of the training-data operators."""

import random
import re

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
#: every column an operator makes, so that a clash would show
EXTRA = ("n_tokens long, start long, length int, ids string, score double, predicted int, spans string, n_bytes long, "
         "component_id long, digest string, node string, bucket int, base string, place string, kind string, "
         "sequence_id string, source string, n_chars long")


def words(n, seed=0):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def edge_rows():
    """Nulls, empty and blank texts, repeated rows and ids, a long text, ties."""
    long = words(40_000, 1)
    a = words(60, 2)
    return [(1, a), (1, a), (1, words(50, 3)), (2, None), (3, ""), (4, " \t\n  "), (None, a), (None, None), (5, long),
            (6, a), (7, "one two"), (8, "é " * 300), (-9, a + " tail"), (10, "😀 <|endoftext|>  x\n\n y")]


def frame(spark, rows, id_name="doc_id", extra=True):
    df = spark.createDataFrame(rows, f"{id_name} long, text string")
    if extra:
        df = df.selectExpr("*", *(f"cast(null as {c.split()[1]}) as {c.split()[0]}" for c in EXTRA.split(", ")))
    return df


def stored(df, path, parts=3):
    """The frame as files: the same rows in the same order whenever it is read."""
    df.repartition(parts).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def shingles(text, width=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORDS.findall(low)
    if len(w) >= width:
        return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def components(rows):
    """doc_id -> smallest doc_id reachable by links, by comparing all pairs."""
    sets = [(d, shingles(t)) for d, t in rows if d is not None]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            both = len(x & y)
            if x and y and 100 * both >= 80 * (len(x) + len(y) - both):
                r, s = find(a), find(b)
                root[max(r, s)] = min(r, s)
    return {d: find(d) for d in root}
