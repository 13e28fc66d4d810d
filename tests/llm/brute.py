"""Plain Python versions of what the operators compute, and the edge rows they share."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=False):
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


def prose(seed, n, vocabulary=60):
    r = random.Random(seed)
    return " ".join("w" + str(r.randrange(vocabulary)).translate(str.maketrans("0123456789", "abcdefghij")) for _ in range(n))


def edge_texts():
    """Null, empty, white space, one word, a very long text, accents, copies and near copies."""
    base = prose(1, 200, 4000)
    near = base.split()
    near[100] = "changed"
    return [None, "", " \n\t ", "one", "x" * 30_000, prose(2, 20_000), "Éa  ça\u00a0Ñu\u2003z", base, base, " ".join(near), base.upper(), prose(3, 12), prose(3, 13) + "  ", prose(4, 40, 3)]


def edge_docs(spark, extra="score string, kept string, lang string"):
    """edge_texts with ids, one repeated row, and columns whose names clash."""
    texts = edge_texts()
    rows = [(i * 3 + 1, t, "a", "b", "c") for i, t in enumerate(texts)]
    rows.append(rows[7])
    return spark.createDataFrame(rows, f"doc_id long, text string, {extra}").repartition(3)


class Groups:
    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a
