"""The corpus pipeline on a small corpus, each stage against its plain version."""

from collections import Counter

import corpus_pipeline
from assay.llm import mixing, quality_rules
from assay.llm.queries import ORACLE_SQL, QUERIES
from tests.llm import brute
from tests.llm.test_near_copies import _groups


def _words(n, seed):
    import random

    r = random.Random(seed)
    return [r.choice("bcdfghjklm") + r.choice("aeiou") + r.choice("nrstv") + r.choice("aeiou") for _ in range(n)]


def _corpus():
    item = " ".join(_words(25, 99))
    rows = []
    for i in range(30):
        text = "\n".join(" ".join(_words(20, 31 * i + j)).capitalize() + "." for j in range(6))
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
    base = rows[3][1]
    rows += [(100, base, "en", "s0", 1), (101, base + " x", "en", "s1", 1), (102, rows[4][1] + "\n" + item + ".", "en", "s1", 1)]
    rows += [(103, "BUY NOW!! " * 60, "en", "s2", 1), (104, rows[5][1] + "\npassword = hunter2222", None, None, 1), (None, None, None, None, None)]
    return rows, [(1, item)]


def test_pipeline(spark, tmp_path):
    rows, items = _corpus()
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    result = corpus_pipeline.run(spark, str(tmp_path)).collect()

    kept = [(d, j[8]) for d, t, *_ in rows if (j := quality_rules.judge(t.encode() if t else None))[6]]
    assert 103 not in dict(kept) and len(kept) == len(rows) - 2
    # Near copies by all pairs' Jaccard similarity of five-word shingles.
    first = _groups(kept)
    kept = [(d, t) for d, t in kept if d in first]
    dirty = {x[0] for x in brute.decontamination(kept, items) if x[-1]}
    kept = [(d, t.replace("password = hunter2222", "[REDACTED]")) for d, t in kept if d not in dirty]
    source = {r[0]: r[3] for r in rows}
    sizes = Counter()
    for d, t in kept:
        sizes[source[d]] += len(t.split())
    targets = brute.targets(sizes)
    assert {(r.doc_id, r.source, r["size"]) for r in result} == {(d, source[d], len(t.split())) for d, t in kept}
    assert 100 not in {r.doc_id for r in result}
    for s, target in targets.items():
        assert abs(sum(r.taken for r in result if r.source == s) - target) <= 1


def test_pipeline_with_awkward_rows(spark, tmp_path):
    """Other columns with names of our own, repeated rows, null and empty texts, ids and sources, a very
    long text; and no documents or items at all."""
    rows, items = _corpus()
    long = "\n".join(" ".join(_words(25, 10_000 + i)).capitalize() + "." for i in range(8_000))
    leaked = "\n".join(" ".join(_words(20, 777 * 31 + j)).capitalize() + "." for j in range(8)) + "\n" + items[0][1].capitalize() + "."
    rows += [(203, leaked, "en", "s1", 1), (200, long, "en", "s0", 1), rows[7], rows[7], (None, rows[9][1], None, None, None), (201, "", "", "", 0), (202, None, None, "s1", None)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, __row int, slot int, `at` string, size string"
    docs = spark.createDataFrame([(*r, "r", 1, 2, "a", "z") for r in rows], schema)
    for name, frame, given in (("full", docs, items), ("empty", docs.limit(0), items), ("no_items", docs, [])):
        frame.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame(given, "item_id bigint, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    result = corpus_pipeline.run(spark, f"{tmp_path}/full").collect()
    ids = Counter(r.doc_id for r in result)
    assert ids[7] == 1 and ids[200] == 1 and not {201, 202, 203, 103} & set(ids)
    assert next(r["size"] for r in result if r.doc_id == 200) == 200_000
    # Of row 9 and its copy without an id the named one stays.
    assert ids[9] == 1 and ids[None] == 0
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
    assert 203 in {r.doc_id for r in corpus_pipeline.run(spark, f"{tmp_path}/no_items").collect()}


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)] and set(ORACLE_SQL) <= set(QUERIES)
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_need_no_table_of_documents(spark, tmp_path):
    """The stages work on the rows they are given: the folder of the tables need not hold the documents. All owners of a
    secret count, though their documents go as copies; columns with names of our own stay as they are."""
    rows, items = _corpus()
    one, two, three = ("\n".join(" ".join(_words(20, 5_000 + 10 * k + j)).capitalize() + "." for j in range(6)) for k in range(3))
    copied, live = "password: everyone7777", "token: onlyhere8888"
    rows += [(300 + i, f"{one}\n{copied}", "en", f"o{i}", 1) for i in range(3)] + 2 * [(310, f"{two}\n{live}", "en", "o0", 1)]
    rows += [(320, f"{three}\n{copied} {live}", None, None, None)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, assay_copied_secrets int, Assay_Copied_Secrets_ array<string>"
    given = docs = spark.createDataFrame([(*r, 1, ["x"]) for r in rows], schema)
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/tables/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:4]:
        stage(spark, docs, f"{tmp_path}/tables").write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    out = {r.doc_id: r for r in docs.collect()}
    assert docs.columns == given.columns and {(r.assay_copied_secrets, *r.Assay_Copied_Secrets_) for r in out.values()} == {(1, "x")}
    assert not {301, 302} & set(out) and out[300].text == f"{one}\n{copied}"
    assert out[310].text == f"{two}\n[REDACTED]" and out[310].n_chars == len(out[310].text)
    assert out[320].text == f"{three}\n{copied} [REDACTED]"
    # Without what the first stage found, the given rows alone are asked.
    alone = {r.text for r in corpus_pipeline.secret_scan(spark, given.where("doc_id in (300, 310)"), f"{tmp_path}/tables").collect()}
    assert alone == {f"{one}\n[REDACTED]", f"{two}\n[REDACTED]"}


def test_mix_returns_the_documents(spark):
    """The last stage gives the texts that it mixes, all columns, and all pieces of the schedule; repeated rows and rows
    without id, text or source each stay."""
    rows = [(i, f"text {i} " + " ".join(_words(37 * i % 211, i)), f"s{i % 3}", i, "own", "more") for i in range(40)]
    rows += [rows[4], rows[4], (None, rows[7][1], "s1", 7, "x", None), (None, None, None, None, None, None), (77, "", "s2", 0, "y", "z"), (4, rows[4][1], "s1", 4, "other", "w")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars int, taken string, `a.b` string").repartition(3)
    found = mixing.documents(docs, block=64)
    assert found.columns == ["doc_id", "source", "size", "source_size", "target", "taken", "pieces", "text", "n_chars", "taken_", "a.b"]
    out = found.collect()
    assert Counter((r.doc_id, r.text, r.source, r.n_chars, r.taken_, r["a.b"]) for r in out) == Counter(rows)
    pieces = mixing.mix(docs, block=64)
    given = Counter((r.doc_id, r.source, r["size"], r.source_size, r.target, r.taken) for r in mixing.taken(pieces).collect())
    assert Counter((r.doc_id, r.source, r["size"], r.source_size, r.target, r.taken) for r in out) == given
    assert Counter((r.doc_id, p.slot, p.first, p.tokens) for r in out for p in r.pieces) == Counter((r.doc_id, r.slot, r["first"], r.tokens) for r in pieces.where("slot IS NOT NULL").collect())
    assert all(r["size"] == len((r.text or "").split()) and r.taken == sum(p.tokens for p in r.pieces) and [p.slot for p in r.pieces] == sorted(p.slot for p in r.pieces) for r in out)
    assert all(0 <= p.first and p.first + p.tokens <= r["size"] for r in out for p in r.pieces)
    assert corpus_pipeline.mix(spark, docs, "").columns == found.columns and corpus_pipeline.mix(spark, docs.limit(0), "").count() == 0
