import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from assay.llm import divergence
from tests.llm import data

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(docs, least, top=50):
    held, seen, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        held[lang, source].update(words)
        seen[lang].update(set(words))
    for lang, source in sorted(groups):
        kept = sorted((t for t, n in seen[lang].items() if n >= least), key=str.encode)
        everyone = sum((held[g] for g in groups if g[0] == lang), Counter())

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        own, whole = shares(held[lang, source]), shares(everyone)
        found = {"pair": [], "term": [(own[t] - whole[t], t) for t in kept if held[lang, source][t] and own[t] > whole[t]]}
        for other in sorted(s for g, s in groups if g == lang and s != source):
            theirs = shares(held[lang, other])
            found["pair"].append((sum(abs(own[t] - theirs[t]) for t in kept), other))
        for part, rows in found.items():
            rows.sort(key=lambda r: (-r[0], r[1].encode()))
            for rank, (value, item) in enumerate(rows, 1):
                if part == "pair" or rank <= top:
                    yield lang, source, part, item, value, rank


def rows():
    langs, sources = ["en", "de", None, "en", ""], [f"s{i}" for i in range(9)] + [None, "é", "Z"]
    return [(t, langs[i % 5], sources[(i * 7 + i // 12) % 12], "x", 1) for i, t in enumerate(data.texts(3, 150))]


@pytest.mark.parametrize(("least", "chunk", "block"), [(3, 2048, (8, 256)), (3, 4, (2, 2)), (8, 7, (1, 1)), (10_000, 2048, (8, 256))])
def test_divergence(spark, least, chunk, block):
    given = [*rows(), (None, None, None, None, None), (None, "xx", "alone", None, None), *rows()[:3]]
    frame = spark.createDataFrame(given, "text string, lang string, source string, term string, n int").repartition(3)
    found = divergence.audit(frame, least_documents=least, terms_a_chunk=chunk, groups_a_block=block)
    data.same(found, COLUMNS, plain([r[:3] for r in given], least))
    assert dict(found.dtypes)["rank"] == "int" and dict(found.dtypes)["value"] == "bigint"


def test_counts_handed_on_early(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TERMS_AT_ONCE", 5)
    monkeypatch.setattr(divergence, "BYTES_AT_ONCE", 7)
    frame = spark.createDataFrame([r[:3] for r in rows()], "text string, lang string, source string")
    data.same(divergence.audit(frame, least_documents=2), COLUMNS, plain([r[:3] for r in rows()], 2))


def test_nothing(spark):
    assert divergence.audit(data.nothing(spark)).count() == 0


def test_shares_are_exact():
    for total in (0, 3, 2**40 + 7, 8 * 10**15):
        n = np.array([0, min(1, total), total // 3, total])
        assert divergence.shares(n, total, 7).tolist() == [1 + 10**9 * (int(x) + 5) // (total + 35) for x in n]
    with pytest.raises(ValueError):
        divergence.shares(np.array([1]), 9 * 10**15, 1)
