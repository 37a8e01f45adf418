"""A small corpus with every awkward case, and what a plain reading of the definitions makes of it."""

import random

import pytest

SCHEMA = "doc_id long, text string, key string, removed string, starts string, h string, p long, __id string, words string"


def corpus() -> list[tuple[int | None, str | None]]:
    """Copies, near copies, shared passages, repeated lines; null, empty and very long texts; repeated rows and ids."""
    r = random.Random(7)
    vocabulary = ["the", "of", "and", "Tion", "straße", "naïve", "日本", "data", "x1", "end.", "run,", "o'clock"] + [f"w{i}" for i in range(60)]

    def prose(n):
        out = []
        for i in range(n):
            out.append(r.choice(vocabulary))
            out.append("\n" if i % 9 == 8 else " ")
        return "".join(out)

    shared, other = prose(70), prose(40)
    texts: list[str | None] = [None, "", " ", "\n\n\n", "one", "two words", "a b c", shared, shared, prose(30) + shared + prose(30), prose(20) + shared, other * 3]
    base = prose(120)
    for _ in range(6):  # near copies
        words = base.split(" ")
        words[r.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    texts += [base, base, "la la la " * 60, "same line here\nsecond line\nthird line\nfourth\n" * 4, "x" * 500, "x" * 700, prose(4000), "tab\tand\x0bvertical\x1c odd \x85 blanks here", "é" * 130, "  lead  and  double  "]
    texts += [prose(r.randint(1, 90)) for _ in range(25)]
    rows: list[tuple[int | None, str | None]] = list(enumerate(texts))
    rows += [(8, shared), (9_000, base + other), (-3, other), (None, base), (None, None), (40, None)]
    r.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """With further columns whose names clash with names inside the operators."""
    return spark.createDataFrame([(i, t, "k", "r", "s", "h", 1, "id", "w") for i, t in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
