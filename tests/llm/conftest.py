import random

import pytest


def prose(rng, n):
    parts = "an ter on ing sel mo ra ti lu be kor wen da".split()
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def corpus(spark):
    """Small documents with copies, near copies, passages, odd texts and a name that clashes."""
    rng = random.Random(5)
    base = [prose(rng, 120) for _ in range(12)]
    passage = prose(rng, 60)
    texts = [None, "", "   \n\t ", "a", "one two three", *base]
    texts += [base[0], base[0].replace(" ", "\n"), base[0] + "  "]
    for i in range(1, 5):
        words = base[i].split()
        words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    texts += [prose(rng, 30) + " " + passage + " " + prose(rng, 30) for _ in range(3)]
    texts += ["é" * 150 + passage[:210] + "ü", "ab " * 200, "tone " * 300]
    langs = ["en", "de", None]
    rows = [(i, t, langs[i % 3], f"src{i % 2}", 0 if t is None else len(t), 7) for i, t in enumerate(texts)]
    rows.append(rows[8])
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, __text long").drop("n_chars").withColumnRenamed("__text", "key"), rows


@pytest.fixture
def empty(corpus):
    return corpus[0].where("false")
