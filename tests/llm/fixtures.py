"""Small tables with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing names."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that the operators use inside; a table may have them too.
CLASHES = ["size", "key", "row", "record", "shard", "slot", "bucket", "range", "mark", "fp", "root", "ids", "nth", "taken", "times", "copies", "label", "score", "words"]


def sentences(seed: int, n: int, syllables: str = "ba re ti no lu ka mi so") -> str:
    pick = random.Random(seed)
    parts = syllables.split()
    return " ".join("".join(pick.choices(parts, k=pick.randint(1, 3))) for _ in range(n))


def rows():
    out = [(i, sentences(i, 20 + i), "aa" if i % 2 else "bb", f"src{i % 3}", None) for i in range(40)]
    out += [(i, sentences(i, 30, "zü grö ßen öl äch"), "cc", "src0", 1) for i in range(40, 60)]
    long = sentences(999, 3000)
    out += [
        (100, None, None, None, None), (101, "", "aa", "src1", 0), (102, " \n\t ", "aa", "src1", 4),
        (None, "no id at all here", "aa", "src2", 5), (None, "no id at all here", "aa", "src2", 5), (None, None, None, None, None),
        (103, long, "aa", "src0", len(long)), (104, long + " tail", "aa", "src0", 9), (105, "x" * 5000, "aa", None, 1),
        (106, "123 456 !!!", "bb", "src2", 3), (107, "a  b\n c \t d", "aa", "Src", 3),
        (5, sentences(5, 25), "aa", "src2", None), (5, sentences(5, 25), "aa", "src2", None), (5, "another text, same id", "bb", "src2", 7),
        (108, "mail ann.b@x.org or 10.0.0.1 or +1 (555) 123-4567 or 4111 1111 1111 1111 now", "aa", "src1", 1),
        (109, "𝔘nicode ñandú ▁ mark 日本語 <s> </s>", "bb", "src1", 1),
    ]
    return out


def documents(spark, clashing=False, some=None):
    df = spark.createDataFrame(rows() if some is None else some, DOCS).repartition(5)
    if clashing:
        df = df.selectExpr("*", *[f"cast(doc_id as string) as `{c}`" for c in CLASHES])
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
