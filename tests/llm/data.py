"""Small documents with the awkward cases, and plain versions of what is common to the operators."""

import random

SCHEMA = "doc_id long, text string, source string"
# Names that an operator might use itself.
EXTRA = "lang string, row string, words string, host string, line string, size long, node long, score double, `a b` string"


def words_of(text):
    return (text or "").encode().split()


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}é"[: rng.choice((3, 4, 5))] for _ in range(n))


def rows(seed=1, n=40):
    """(doc_id, text, source): prose, copies, near copies, repeats, nulls, empties, one very long text."""
    rng = random.Random(seed)
    out = [(i, prose(rng, rng.randrange(1, 120)), rng.choice(["x", "x", "y", "z"])) for i in range(n)]
    base = prose(rng, 90, 10_000)
    parts = base.split()
    for i in range(4):
        out.append((100 + i, base, "x"))
    for i in range(3):
        out.append((110 + i, " ".join(parts[:-1] + [f"tail{i}"]), "y"))
    out += [(120, " ".join(parts[10:60] * 3), "z"), (121, prose(rng, 30) + "\n" + " ".join(parts[20:50]), "z")]
    out += [(130, None, "x"), (131, "", None), (132, " \n\t ", "x"), (133, "one", None), (134, "a b c", "y"), (135, "b a c", "y")]
    out += [(140, prose(rng, 20_000, 50_000), "x"), (141, "line\n" * 30 + "#*$ | <>", "z"), (142, "zero width​é\x1ftext of some ten words that go on", "z")]
    return out


def frame(spark, data=None, extra=False, schema=SCHEMA):
    data = rows() if data is None else data
    if extra:
        full = [(*r, "l", "r", "w", "h", "n", 7, 8, 0.5, "ab") for r in data]
        return spark.createDataFrame(full, f"{schema}, {EXTRA}").repartition(3)
    return spark.createDataFrame(data, schema).repartition(3)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)
