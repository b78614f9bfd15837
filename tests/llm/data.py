"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, found string, grp bigint, start string"


def texts(seed: int = 1, count: int = 60) -> list[str | None]:
    """Texts over few words, so that windows repeat; copies, near copies, empty and long ones."""
    r = random.Random(seed)
    vocabulary = ["Alpha", "beta", "gamma,", "delta", "éta", "the", "of", "x1"]
    passage = " ".join(r.choice(vocabulary) + str(i) for i in range(30))
    out: list[str | None] = [None, "", "   ", "\n\n", "one", "one two", "***", passage]
    for i in range(count):
        words = [r.choice(vocabulary) + r.choice(["", "", str(r.randrange(30))]) for _ in range(r.randrange(1, 90))]
        if i % 4 == 0:
            at = r.randrange(len(words))
            words[at:at] = passage.split()[r.randrange(10) : r.randrange(15, 30)]
        text = "".join(w + r.choice([" ", " ", " ", "\n", "\t", "  "]) for w in words)
        out.append(text)
        if i % 7 == 0:
            out += [text, text + " more"]
    out.append(" ".join(f"w{i % 997}" for i in range(30_000)))
    return out


def rows(seed: int = 1, count: int = 60) -> list[tuple]:
    sources = ["b", "a", None, "c", "a", "a"]
    found = [(i, t, "en", sources[i % 6], len(t or ""), "r", "f", 0, "s") for i, t in enumerate(texts(seed, count))]
    # A repeated row, an id with two texts, rows without an id.
    return [*found, found[12], (found[13][0], "another text of the same id", *found[13][2:]), (None, found[9][1], *found[9][2:]), (None, None, None, None, None, None, None, None, None)]


def documents(spark, seed: int = 1, count: int = 60):
    return spark.createDataFrame(rows(seed, count), SCHEMA).repartition(3)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def same(df, columns: list[str], expected) -> None:
    from collections import Counter

    got = Counter(tuple(r) for r in df.select(*columns).collect())
    want = Counter(tuple(x) for x in expected)
    assert got == want, (list((got - want))[:3], list((want - got))[:3])
