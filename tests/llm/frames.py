"""Small document tables with the awkward cases: nulls in every column, empty, wordless and
long texts, repeated rows, ties, extra columns whose names clash with the operators' own."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, size long, "
          "class long, bucket int, row string, part int, shard int, grp string, _lines string")
LONG = " ".join(f"w{i % 997}x{i}" for i in range(30_000))


def sentence(rng, n=30):
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa the of and to in".split())
                    + rng.choice(["", "", "", ",", "s"]) for _ in range(n))


def rows(seed=1, n=60):
    rng = random.Random(seed)
    base = [" ".join(f"{rng.choice('abcdefgh')}{rng.randrange(4000)}" for _ in range(80)) for _ in range(6)]
    out = []
    for i in range(n):
        kind = i % 6
        text = sentence(rng, rng.randrange(40, 120))
        if kind == 1:  # a near copy: one word of a shared text changed
            words = base[i % 4].split()
            words[rng.randrange(len(words))] = f"new{i}"
            text = " ".join(words)
        elif kind == 2:
            text = base[i % 3]
        elif kind == 3:  # a shared line among others
            text = "\n".join([sentence(rng, 12), "Subscribe to our news letter to-day, dear reader.", sentence(rng, 9), ""])
        out.append((i, text, rng.choice(["en", "fr"]), f"src{i // 6 % 9}", len(text)))
    out += [(100, None, "en", "src1", None), (101, "", None, "src2", 0), (102, " \n\t ", "fr", None, 4),
            (103, LONG, "en", "src3", len(LONG)), (104, "x" * 3000, None, None, 3000), (None, base[5], "en", "src4", 1),
            (105, "Ünï çödé 日本語 \u0085 a b  c\r\n\r\nd's ##", "de", "src5", None),
            (106, "one two", "en", "src6", 7), (107, "One TWO", "en", "src7", 7), (7, out[7][1], out[7][2], out[7][3], out[7][4])]
    return [r + (0.5, 3, 4, 5, "r", 6, 7, "g", "l") for r in out]


def table(spark, seed=1, n=60):
    return spark.createDataFrame(rows(seed, n), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
