import random
import re

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, k string, tag string, n int, kind string, component string, row string, usable string"


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edge_texts() -> list[tuple]:
    """Ids and texts: nulls, empty, white space, copies, rows that repeat, long, near copies."""
    base, long = prose(1, 120), prose(2, 60_000, 50_000)
    near = base.split(" ")
    near[60] = "changed"
    passage = prose(3, 50)
    return [
        (1, base), (2, base), (2, base), (3, " ".join(near)), (4, ""), (5, None), (6, " \n\t "), (7, "one two"),
        (8, "One TWO"), (9, long), (10, prose(4, 80) + " " + passage), (11, passage + " " + prose(5, 90)),
        (12, "Der " * 300), (None, base), (None, None), (13, "é ü 中文   \x0b x"), (14, prose(6, 34)), (15, prose(6, 34)),
        (16, prose(7, 35)), (17, prose(7, 35)), (18, "a\x00b " * 20), (19, "#*$% " * 50),
    ]


def as_docs(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en", "s", len(t or ""), "k", "t", 1, "x", "c", "r", "u") for i, t in rows], SCHEMA
    )


def bag(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
