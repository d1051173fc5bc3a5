"""A small table with everything that operators must take without a crash."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " score double, label int, node long, ids string, hits string, bucket int, blob string,"
    " n_removed string, component string, `odd.name` int"
)

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


def odd_rows():
    long_text = "\n".join(prose(k, 40) for k in range(400))
    texts = [
        (1, None, "s1"),
        (2, "", "s2"),
        (2, "", "s2"),
        (3, "   \n\t\n ", None),
        (4, "word", "s1"),
        (5, prose(5, 60), "s1"),
        (6, prose(5, 60), "s2"),
        (7, prose(5, 60) + " tail", "s3"),
        (None, prose(8, 30), "s1"),
        (None, prose(8, 30), "s1"),
        (9, long_text, "s4"),
        (9, prose(9, 20), "s4"),
        (10, "### !!! ### ...", "s5"),
        (11, "naïve 日本語 \x00 \U0001f389 İstanbul ſecret", "s6"),
        (12, "### !!! ###", "s5"),
    ]
    return [(i, t, None, s, None, 0.25, 1, 7, "x", "y", 3, "z", "r", "c", 8) for i, t, s in texts]


def odd_documents(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(rows, *columns):
    return sorted(tuple(row[c] for c in columns) for row in rows if row["doc_id"] is not None)
