"""Near copies of the pipeline's stage, held against all pairs."""

import random

import numpy as np
import pytest

from assay.llm import common, near_copies, simhash


def _shingles(text, length=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + length]) for i in range(max(1, len(words) - length + 1))} if words else set()


def _groups(rows):
    """{least id of a group}, all pairs compared."""
    sets, root = [_shingles(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                root[find(i)] = find(j)
    return {min(rows[j][0] for j in range(len(rows)) if find(j) == find(i)) for i in range(len(rows))}


def _changed(r, words, n):
    """The words, n of them replaced where they stand apart."""
    out = list(words)
    for at in r.sample(range(len(words)), n):
        out[at] = f"new{r.random()}"
    return " ".join(out)


@pytest.mark.parametrize("crowd", [256, 3])
def test_near_copies(spark, crowd):
    r = random.Random(7)
    common = [f"common{i}" for i in range(60)]
    texts = [None, "", " \n", "one", "One", "a b c"]
    for i in range(25):
        words = [f"w{i}x{r.randrange(900)}" for _ in range(120)]
        words += common if i % 2 else []
        # Similarities on both sides of 0.8.
        texts += [" ".join(words), *(_changed(r, words, n) for n in (1, 2, 3, 4, 5, 6, 9)), " ".join(words[: 85 + 4 * (i % 8)])]
    texts += [_changed(r, common * 2, n % 3) for n in range(20)] + texts[9:12]
    rows = list(enumerate(texts))
    r.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = near_copies.one_of_each(docs, crowd=crowd)
    assert {x.doc_id for x in kept.collect()} == _groups(rows) and kept.columns == docs.columns
    assert near_copies.one_of_each(docs.limit(0)).count() == 0


def test_near_copies_beyond_three_bits(spark):
    words = [f"w{i * i % 1009}" for i in range(300)]
    near, far = [*words[:150], "other", *words[150:], "end", *words[:8]], [*words[:200], *(f"y{i}" for i in range(100))]
    rows = [(2, " ".join(near)), (1, " ".join(words)), (3, " ".join(far)), (None, " ".join(words)), (1, " ".join(words))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    prints = [simhash.fingerprint(t.encode()) for _, t in rows[:2]]
    assert (prints[0] ^ prints[1]).bit_count() > simhash.MAX_BITS
    assert sorted(x.doc_id for x in near_copies.one_of_each(docs).collect()) == [1, 3]
    assert 2 in {x.doc_id for x in simhash.one_of_each(docs).collect()}


def test_stars_take_no_round(spark, monkeypatch):
    """Edges that are stars round their smallest nodes are components already: they are written once."""
    written = []
    save = simhash.saved
    monkeypatch.setattr(simhash, "saved", lambda df: written.append(1) or save(df))
    stars = spark.createDataFrame([(1, i) for i in range(2, 30)] + [(40, 41), (41, 40)], "a bigint, b bigint")
    roots = {r.node: r.root for r in simhash.components(stars).collect()}
    assert roots == {i: 1 for i in range(2, 30)} | {41: 40} and len(written) == 1
    assert simhash.components(stars.limit(0)).count() == 0
    met = spark.createDataFrame([(1, 3), (2, 3), (3, 4), (5, 6)], "a bigint, b bigint")
    assert {r.node: r.root for r in simhash.components(met).collect()} == {2: 1, 3: 1, 4: 1, 6: 5}


def test_bitmap_has_few_rows(spark):
    """What the driver collects of a full bitmap is an eighth of its words; no key is lost, and few others pass."""
    keys = spark.range(400_000).select("id")
    rest = spark.range(400_000, 500_000)
    assert common.bitmap(keys, "id").count() <= common.BITMAP_WORDS // 8
    assert common.perhaps_among(keys, "id", keys, "id", "near").where("near").count() == 400_000
    assert common.perhaps_among(rest, "id", keys, "id", "near").where("near").count() < 5_000
    none = common.perhaps_among(rest, "id", keys.limit(0), "id", "near")
    assert none.where("NOT near").count() == 100_000 and none.columns == ["id", "near"]
    odd = spark.createDataFrame([(None,), ("a",)], "`a b` string")
    assert common.perhaps_among(odd, "a b", odd, "a b", "near").where("near").count() == 2


def test_lone_sets_go_no_further(spark, monkeypatch):
    """Sets that alone hold over a fifth of their shingles meet no others, though a shingle of theirs is common; no set
    that has a near copy goes, whatever else it shares."""
    met = []
    join = near_copies.links
    monkeypatch.setattr(near_copies, "links", lambda docs, nodes, *more: met.extend(r.doc_id for r in nodes.select("doc_id").collect()) or join(docs, nodes, *more))
    r, line = random.Random(3), "one line that all of these texts have in common"
    rows = [(i, f"{line} " + " ".join(f"w{r.randrange(10**9)}" for _ in range(300))) for i in range(200)]
    rows += [(1000 + i, _changed(r, rows[i][1].split(), 1 + i % 9)) for i in range(20)] + rows[:3]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert {x.doc_id for x in near_copies.one_of_each(docs).collect()} == _groups(rows)
    assert {i for i in range(20)} | {1000 + i for i in range(20)} <= set(met) and len(met) < 60


def test_crowded_shingles_are_looked_up(monkeypatch):
    """A set's prefix takes a lookup for each of its shingles, not a pass over all crowded ones, of which 100,000 may be."""
    r = np.random.default_rng(5)
    crowded = np.sort(r.integers(0, 1 << 63, 100_000, dtype=np.uint64))
    hashes = np.unique(np.concatenate([r.integers(0, 1 << 63, 500, dtype=np.uint64), crowded[::1000]]))
    last = np.isin(hashes, crowded)
    monkeypatch.setattr(np, "isin", None)
    assert near_copies.prefix(hashes, crowded).tolist() == np.concatenate([hashes[~last], hashes[last]])[: len(hashes) // 5 + 1].tolist()
    assert near_copies.prefix(hashes, crowded[:0]).tolist() == hashes[: len(hashes) // 5 + 1].tolist()


def test_shingles_are_sets_of_words_in_order():
    plain = lambda t: len(_shingles(t))
    texts = ["", " \n", "a", "A", "a b", "b a", "a b c d e", "e d c b a", "a b c d e a b c d e", "x " * 50, " ".join(str(i % 7) for i in range(90))]
    found = [near_copies.shingles(t.encode()).tolist() for t in texts]
    assert [len(f) for f in found] == [plain(t) for t in texts] and all(f == sorted(f) for f in found)
    assert found[2] == found[3] and len({tuple(f) for f in found}) == len({frozenset(_shingles(t)) for t in texts})
