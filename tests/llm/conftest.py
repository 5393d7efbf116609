import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, words string, key string, pos int, n long, shard int, kind string"


def rows_of(texts, source="s", lang="en", first=0):
    """Documents rows with extra columns whose names operators use inside."""
    return [(first + i, t, lang, source, None if t is None else len(t), 7, "w", "k", 3, 9, 5, "x") for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def make(spark):
    return lambda rows: spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies, a shared passage, a long text, empty and null ones."""
    r = random.Random(5)
    vocab = [f"w{i}" for i in range(400)] + ["the", "of", "and"] * 40
    words = lambda n: [r.choice(vocab) for _ in range(n)]
    base = [words(r.choice([3, 8, 60, 90, 200])) for _ in range(60)]
    texts = [" ".join(w) for w in base]
    texts += [texts[k] for k in (2, 2, 3, 10)]
    for k in (4, 5, 6, 7, 8):
        near = list(base[k])
        near[len(near) // 2] = "changed"
        texts.append(" ".join(near).upper())
    passage = " ".join(words(90))
    texts += [" ".join(words(30)) + " " + passage + "\n" + " ".join(words(40)) for _ in range(6)]
    texts += ["a" * 900, " ".join(words(20_000)), "", "  \n", None, "é日😀 café\t" * 3, None]
    return texts
