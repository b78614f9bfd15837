"""Audit of how sources of a language differ in their words, all pairs of sources in tiles.

Terms are counted by source; packed vectors of scaled counts are replicated to tiles of a block
of groups by another, and each tile adds up its pairs' distances over chunks of the vocabulary.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.common import arrow_schema, discard, map_batches, saved, values

LEAST_DOCUMENTS, TOP_TERMS = 30, 50
#: Shares are counted in parts of WHOLE; PRIOR is added to each count.
WHOLE, PRIOR = 1_000_000_000, 5
#: About how many terms a chunk of the vocabulary has, and how many chunks a task takes in turn.
TERMS_A_CHUNK, CHUNKS_A_TASK = 2048, 2
#: Groups of a block: a sixteenth of the language's, within these limits.
GROUPS_A_BLOCK = (8, 256)
#: Different terms that a task counts before it hands on what it has; bytes of a text split at once.
TERMS_AT_ONCE, BYTES_AT_ONCE = 400_000, 1 << 20

#: A-Z become a-z; every other ASCII character that isn't a letter parts terms.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in bounded lists."""
    plain, at = text.translate(_TERMS), 0
    while at < len(plain):
        end = plain.find(b" ", at + BYTES_AT_ONCE)
        end = end if end >= 0 else len(plain)
        yield plain[at:end].split()
        at = end


def counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term; a null term for each group that occurs."""
    frame = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    schema = "lang string, source string, term string, n bigint, docs bigint"
    arrow = arrow_schema(schema)

    def handed_on(found: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in found.items():
            names = pa.array([*n, None], pa.binary()).cast(pa.string())
            same = [pa.array([x] * len(names), pa.string()) for x in (lang, source)]
            yield pa.RecordBatch.from_arrays([*same, names, pa.array([*n.values(), 0]), pa.array([*map(docs.__getitem__, n), 0])], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            for lang, source, text in zip(values(batch, "lang"), values(batch, "source"), texts):
                n, docs = found.setdefault((lang, source), (Counter(), Counter()))
                held -= len(n)
                seen: set[bytes] = set()
                for some in terms(text.as_py()):
                    n.update(some)
                    seen.update(some)
                docs.update(seen)
                held += len(n)
                if held > TERMS_AT_ONCE:
                    yield from handed_on(found)
                    found, held = {}, 0
        yield from handed_on(found)

    partial = frame.mapInArrow(run, schema)
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: str, total: str) -> Column:
    """1 + floor(WHOLE * (n + PRIOR) / (total + PRIOR * terms)), exactly."""
    return F.expr(f"1 + (CAST({WHOLE} AS DECIMAL(10,0)) * CAST({n} + {PRIOR} AS DECIMAL(20,0))) div CAST({total} + {PRIOR} * terms AS DECIMAL(20,0))")


def shares(n: np.ndarray, total: int, size: int) -> np.ndarray:
    """share() of many counts: long division by thousands, exact while total + PRIOR * size is below 9 * 10^15."""
    whole = total + PRIOR * size
    if whole >= 9 * 10**15:
        raise ValueError("a group has more occurrences than 64-bit division can take")
    left, out = n + PRIOR, np.zeros(len(n), dtype=np.int64)
    for _ in range(3):
        part, left = np.divmod(left * 1000, whole)
        out = out * 1000 + part
    return 1 + out


def _packed(cells: DataFrame) -> DataFrame:
    """Each group's shares over one chunk of the vocabulary, four bytes each (a share is at most WHOLE + 1)."""

    def per_batch(batch):
        column = batch.column("places")
        flat, ends = column.flatten(), np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        at, times = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(2))
        out, start = [], 0
        for size, total, number, end in zip(*(values(batch, c) for c in ("width", "total", "terms")), ends.tolist()):
            n = np.zeros(size, dtype=np.int64)
            n[at[start:end]] = times[start:end]
            out.append((shares(n, total, number) if size else n).astype("<u4").tobytes())
            start = end
        return {c: values(batch, c) for c in ("lang", "source", "block", "blocks", "chunk")} | {"packed": out}

    return map_batches(cells, per_batch, "lang string, source string, block int, blocks int, chunk int, packed binary")


def tile(table: pa.Table, arrow: pa.Schema) -> pa.Table:
    """Distances of all pairs of groups of two blocks (of a block with itself: each pair once), added
    over the task's chunks of the vocabulary, one after the other."""
    lang, low, high = (table.column(c)[0].as_py() for c in ("lang", "low", "high"))
    rows: dict[int, list[tuple[str, int, bytes]]] = {}
    for chunk, source, block, packed in zip(*(table.column(c).to_pylist() for c in ("chunk", "source", "block", "packed"))):
        rows.setdefault(chunk, []).append((source, block, packed))
    added = None
    for chunk in sorted(rows):
        held = {b: sorted((s, p) for s, block, p in rows[chunk] if block == b) for b in {low, high}}
        one, other = ([np.frombuffer(p, dtype="<u4").astype(np.int64) for _, p in held[b]] for b in (low, high))
        matrix = np.array(other, dtype=np.int64).reshape(len(other), len(other[0]) if other else 0)
        apart = np.array([np.abs(matrix - x).sum(axis=1) for x in (one if other else [])], dtype=np.int64).reshape(len(one), len(other))
        added = apart if added is None else added + apart
    names = {b: [s for s, _ in held[b]] for b in (low, high)}
    a, b = np.triu_indices(len(names[low]), 1) if low == high else map(np.ravel, np.indices(added.shape))
    columns = [[lang] * len(a), [names[low][i] for i in a], [names[high][i] for i in b], added[a, b].tolist() if len(a) else []]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)


def audit(
    docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
    least_documents: int = LEAST_DOCUMENTS, top_terms: int = TOP_TERMS, terms_a_chunk: int = TERMS_A_CHUNK, groups_a_block: tuple[int, int] = GROUPS_A_BLOCK,
) -> DataFrame:
    """lang, source, part, item, value, rank: how each source of a language differs from others.

    Part `pair` has every other source of the language, and the sum over all kept terms of the
    differences of their shares; part `term` the source's `top_terms` kept terms that it has more
    of than the language as a whole. Ranks go by value, largest first, then by the item's bytes.

    Null texts, languages and sources count as empty ones. Every row is a document, so repeated
    rows count again. A language without kept terms has pairs of value 0 and no term; a source that
    is alone in its language has no pair. An empty table gives an empty result; other columns are
    ignored. Texts are read whole.
    """
    counted = saved(counts(docs, lang_col, source_col, text_col))
    named = counted.where("term IS NOT NULL")
    kept = named.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_documents).drop("docs")
    kept = saved(kept)
    sizes = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n_lang").alias("total_lang"))
    groups = counted.select("lang", "source").distinct()
    langs = groups.groupBy("lang").agg(F.count("*").alias("n_groups")).join(sizes, "lang", "left").fillna(0, ["terms", "total_lang"])
    low, high = groups_a_block
    a_block = F.least(F.greatest(F.ceil(F.col("n_groups") / 16), F.lit(low)), F.lit(high))
    langs = saved(langs.select(
        "lang", "terms", "total_lang", F.greatest(F.ceil(F.col("terms") / terms_a_chunk), F.lit(1)).cast("int").alias("chunks"),
        F.ceil(F.col("n_groups") / a_block).cast("int").alias("blocks"),
    ))

    # A term's chunk comes from its hash, its place in it from a window over one chunk's few terms.
    chunked = kept.join(langs.select("lang", "chunks"), "lang").select("lang", "term", "n_lang", F.pmod(F.xxhash64("term"), F.col("chunks")).cast("int").alias("chunk"))
    over = Window.partitionBy("lang", "chunk")
    vocabulary = saved(chunked.withColumn("at", F.row_number().over(over.orderBy("term")) - 1))
    widths = vocabulary.groupBy("lang", "chunk").agg(F.count("*").cast("int").alias("width"))
    own = saved(named.drop("docs").join(vocabulary, ["lang", "term"]))
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = saved(groups.join(totals, ["lang", "source"], "left").fillna(0, ["total"]).join(langs, "lang"))
    discard(counted)
    discard(kept)

    grid = groups.select("lang", "source", "total", "terms", "blocks", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    places = own.groupBy("lang", "source", "chunk").agg(F.collect_list(F.struct("at", "n")).alias("places"))
    cells = grid.join(widths, ["lang", "chunk"], "left").fillna(0, ["width"]).join(places, ["lang", "source", "chunk"], "left")
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least("block", x).alias("low"), F.greatest("block", x).alias("high")))
    sent = _packed(cells).withColumn("tile", F.explode(meets)).select("lang", "tile.low", "tile.high", F.floor(F.col("chunk") / CHUNKS_A_TASK).alias("turn"), "source", "block", "chunk", "packed")
    schema = "lang string, a string, b string, value bigint"
    arrow = arrow_schema(schema)
    apart = sent.groupBy("lang", "low", "high", "turn").applyInArrow(lambda table: tile(table, arrow), schema)
    apart = apart.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = apart.select("lang", "value", both.alias("x")).select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")

    compared = own.join(groups.select("lang", "source", "total", "terms", "total_lang"), ["lang", "source"])
    compared = compared.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (share("n", "total") - share("n_lang", "total_lang")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    top = compared.where("value > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(top)
