"""A small corpus with every awkward case, and brute-force helpers."""

import random
import re

WS = " \t\n\x0b\x0c\r"
EXTRA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, n_lines int, score double, starts string"


def words(rng, n):
    base = ["the", "of", "and", "in", "to", "is", "thon", "erst", "inate", "blend", "wher", "ouste", "ranti", "lysh", "edorat"]
    return [rng.choice(base) + rng.choice(["", "", "a", "en", "er", "ing", "tion", "x%d" % rng.randrange(400)]) for _ in range(n)]


def corpus(seed=7):
    """Rows (doc_id, text): copies, near copies, shared lines and passages, nulls, ties, a long text."""
    rng = random.Random(seed)
    passage = " ".join(words(rng, 70))
    line = "  A shared line of TWENTY or more letters\t"
    out = []
    for i in range(60):
        body = words(rng, rng.choice([0, 1, 4, 5, 30, 49, 50, 51, 90, 160]))
        text = " ".join(body)
        if i % 5 == 0:
            text += "\n" + (line if i % 10 else line.upper()) + "\n" + " ".join(words(rng, 12))
        if i % 7 == 0:
            text = text + " " + passage + " " + " ".join(words(rng, 5))
        out.append((i, text))
    base = words(rng, 200)
    for i in range(60, 80):                       # near copies: one or two words changed
        w = list(base)
        for _ in range(rng.randrange(0, 3)):
            w[rng.randrange(len(w))] = "changed%d" % rng.randrange(9)
        out.append((i, " ".join(w)))
    out += [(80, None), (81, ""), (82, " \t\n"), (83, "\n\n"), (84, "é" * 19), (85, "é" * 20 + "\nÀB"), (86, "a a a a " * 60),
            (87, "a a a a " * 45), (88, out[0][1]), (89, out[20][1].replace(" ", "\t ")), (90, out[20][1] + " "),
            (91, " ".join(words(rng, 30_000))), (91, "another text with the id 91"), (92, "twice the same row"),
            (92, "twice the same row"), (None, "no id"), (None, None), (None, out[14][1]), (93, "x" * 70_000),
            (94, "Tschüß 😀 ﬁn ́é Å     ΑΣ İ <|endoftext|> 'S 12a")]
    return out


def table(spark, rows=None):
    """The corpus with the columns of documents and columns whose names operators use."""
    rows = corpus() if rows is None else rows
    return spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t), None, 3, 0.5, "s") for i, t in rows], EXTRA)


def split_words(text):
    return [w for w in re.split("[" + WS + "]+", text or "") if w]


NULL_FIRST = -(2 ** 63)


def key(i):
    return NULL_FIRST if i is None else i
