"""Awkward tables shared by the operator tests."""
import random

# extra columns with names the operators use themselves
CLASH = ("doc string, row long, fp long, label int, line long, id long, key string, words string, gone string, "
         "w string, hits string, found string, score double, `left` string, print long")
DOCS = f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}"
N_CLASH = CLASH.count(",") + 1


def documents(spark, rows):
    """rows: (doc_id, text, lang, source)."""
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), *[None] * N_CLASH) for r in rows], DOCS)


def awkward_rows(seed=3):
    """Nulls in every column, empty, blank and very long texts, repeated rows,
    equal ids, copies, non-ASCII text, odd spaces."""
    rng = random.Random(seed)
    words = "the of and ONE two Éclair über niño x1 y2 don't 日本 a.b".split()
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", None), (None, "no id here", "en", "b"),
            (None, None, None, None), (4, text(30), "en", "a"), (4, text(30), "fr", "b"), (5, text(20_000), "de", "c"),
            (6, "x" * 50_000, None, "a"), (7, "one\n\ntwo\n two \nthree", "en", "a"),
            (8, "single", "en", "b"), (9, "!!! ### 123", "en", "c"), (10, "a\u0000b\x1cc d \x85 e", "en", "a")]
    rows += [(20 + i, text(rng.randint(1, 60)) + "\nline " + str(i % 3), rng.choice(["en", "fr"]), f"s{i % 12}")
             for i in range(30)]
    return rows + [rows[5], rows[5], (90, rows[5][1], "en", "z"), (91, rows[8][1], "en", "z")]


def plain(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
