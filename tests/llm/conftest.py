import random

import pytest


def prose(rng, n, vocabulary=400):
    return " ".join(f"{rng.choice('bcdfgklmn')}w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, shared passages, repeated lines, odd white space, nulls and one long text."""
    rng = random.Random(5)
    passage, line = prose(rng, 80), "This   Line is Found in Very Many of these documents"
    texts = [None, "", " \t\n ", "one", "ONE", "\u00c9t\u00e9 \u00c9T\u00c9 caf\u00e9", "a\u00a0b\u2003c d"]
    for i in range(60):
        text = prose(rng, rng.randrange(1, 300))
        if i % 3 == 0:
            text += " " + passage + " " + prose(rng, 5)
        if i % 4 == 0:
            text += f"\n  {line.upper() if i % 8 else line}\t\n" + prose(rng, 12)
        texts.append(text)
    texts += [texts[10]] * 12 + [texts[11] + " tail", texts[12].upper(), prose(rng, 6000), "x" * 5000 + " " + passage]
    return [(3 * i % 101, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def odd_docs(spark, corpus):
    """The corpus with extra columns whose names the operators use themselves, repeated rows and missing ids."""
    rows = [*corpus, corpus[20], corpus[20], (None, corpus[30][1]), (None, None), (corpus[31][0], corpus[32][1])]
    rows = [(d, t, None if i % 9 == 4 else f"s{i % 5}", "en" if i % 2 else None, i, "x", 1) for i, (d, t) in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, id int, row string, whole int")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def pairs(odd_docs):
    return [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]


def table(df):
    """Rows as a list that can be compared whatever their order and nulls."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
