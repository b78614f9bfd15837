"""SimHash near-duplicates, found through pivot distance tables."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.llm.common import discard, identified, map_batches, perhaps_among, row_hash, saved, space_words, text_bytes, unused, values

SEED = 42
MAX_BITS = 3
#: Bits of the five parts that a fingerprint is cut into; three differing bits leave two parts alone.
PARTS = (13, 13, 13, 13, 12)
#: Reference fingerprints of the pivot table: fixed, spread over the space of 64 bits.
PIVOTS = 16
#: Width of the ranges of a pivot's distances, and the pivots whose ranges are part of a key: at
#: first, and where a key is crowded.
RANGE = 8
FIRST_PIVOTS, MORE_PIVOTS = (0, 1), (2, 3, 4, 5)
#: A key with more fingerprints than this is divided by more pivots, and if still so crowded linked
#: through shared neighbours instead of pairs.
PAIR_LIMIT = 256


def fingerprint(text: bytes | None) -> int:
    """64 majority bits over the XXH64 of all 3-word shingles; 0 without words."""
    words = space_words(text.lower() if text else None)
    if not words:
        return 0
    shingles = [b" ".join(words)] if len(words) < 3 else map(b" ".join, zip(words, words[1:], words[2:]))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, fp as a signed 64-bit number), one row per input row; row is a hash of id and text."""

    def per_batch(batch):
        prints = [fingerprint(t) for t in text_bytes(batch)]
        return {"doc_id": values(batch, "doc_id"), "row": values(batch, "row"), "fp": prints}

    frame = identified(docs, id_col, text_col).withColumn("row", row_hash("doc_id", "text"))
    return map_batches(frame, per_batch, f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, row binary, fp bigint")


def pivots(count: int = PIVOTS) -> list[int]:
    """Reference fingerprints: XXH64 of their number, as signed numbers."""
    return [int(np.uint64(xxhash.xxh64_intdigest(str(i), SEED)).astype(np.int64)) for i in range(count)]


def pivot_table(fps: DataFrame) -> DataFrame:
    """Adds `at`: the Hamming distances to the pivots, one byte each."""
    return fps.withColumn("at", F.array(*[F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("tinyint") for p in pivots()]))


def _keys(fp: Column) -> Column:
    """One key for each choice of two parts: which parts, and their bits."""
    ends = np.cumsum(PARTS)
    masks = [((1 << n) - 1) << int(end - n) for n, end in zip(PARTS, ends)]
    keys = []
    for i, kept in enumerate(combinations(masks, len(PARTS) - MAX_BITS)):
        mask = int(np.uint64(sum(kept)).astype(np.int64))
        keys.append(F.struct(F.lit(i).alias("part"), fp.bitwiseAND(F.lit(mask)).alias("bits")))
    return F.array(*keys)


def _cells(at: Column, which: tuple[int, ...]) -> Column:
    """Numbers of the cells of a grid over some pivots' distances that a fingerprint may share.

    A fingerprint lies in the range of its distance and in that of its distance and three more.
    Of two within three bits, the nearer one reaches the range of the other, for each pivot; so
    they share a cell, and what is shared is an equality key. Most lie in one range only.
    """
    base = 64 // RANGE + 1

    def with_range_of(cells: Column, i: int) -> Column:
        low, high = (F.floor((at[i] + more) / RANGE).cast("int") for more in (0, MAX_BITS))
        both = lambda x: F.when(low == high, F.array(x * base + low)).otherwise(F.array(x * base + low, x * base + high))
        return F.flatten(F.transform(cells, both))

    cells = F.array(F.lit(0))
    for i in which:
        cells = with_range_of(cells, i)
    return cells


def _met(keyed: DataFrame, keys: list[str]) -> DataFrame:
    """keyed with `n`, how many share its keys; those that are alone go, mostly before any join."""
    name = F.xxhash64(*keys)
    sizes = saved(keyed.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").withColumn("name", name))
    near = perhaps_among(keyed.withColumn("name", name), "name", sizes, "name", "near").where("near")
    return near.drop("near", "name").join(sizes.drop("name"), keys)


def _pairs(met: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs (a, b) of a key that pivots don't discard and that are within MAX_BITS."""
    one = met.select(*keys, "fp", "at")
    other = met.select(*keys, F.col("fp").alias("b"), F.col("at").alias("bt"))
    apart = F.greatest(*[F.abs(F.col("at")[i] - F.col("bt")[i]) for i in range(PIVOTS)])
    found = one.join(other, keys).where((F.col("fp") < F.col("b")) & (apart <= MAX_BITS))
    return found.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("b"))) <= MAX_BITS).select(F.col("fp").alias("a"), "b")


def _links_by_neighbour(fps: DataFrame) -> DataFrame:
    """All links among fps without pairs: a pair within three bits has a point within one bit
    of one and two bits of the other, and all around one such point are in one component."""
    one = [0, *(1 << i for i in range(64))]
    two = one + [a | b for a, b in combinations(one[1:], 2)]
    signed = [int(np.uint64(x).astype(np.int64)) for x in two]

    def around(masks: list[int]) -> DataFrame:
        flips = F.explode(F.array(*[F.lit(m) for m in masks]))
        return fps.select("fp", flips.alias("m")).select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("point"))

    hubs = around(signed[: len(one)]).groupBy("point").agg(F.min("fp").alias("a"))
    return around(signed).join(hubs, "point").where("a != fp").select("a", F.col("fp").alias("b")).distinct()


def links(fps: DataFrame, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints that join all those within three bits.

    The pivot table selects candidates: fingerprints meet that agree in two of five parts, which
    three differing bits can't avoid, and share a cell of the grid over the first pivots'
    distances. (Cells alone would not do: two random fingerprints are close in most coordinates.)
    Keys that more than pair_limit share are divided by the cells of further pivots. Pairs whose
    distances to any pivot differ by more than three go, as the triangle inequality allows; the
    rest are verified. What is crowded still is linked exactly through neighbours, in linear work.
    """
    table = pivot_table(fps.select("fp").distinct())
    if not pair_limit:
        return _links_by_neighbour(table.select("fp"))
    cells = table.select("fp", "at", _cells(F.col("at"), FIRST_PIVOTS).alias("cells"), F.explode(_keys(F.col("fp"))).alias("key"))
    keyed = cells.select("fp", "at", "key", F.explode("cells").alias("cell"))
    met = saved(_met(keyed, ["key", "cell"]))
    pairs = _pairs(met.where(F.col("n") <= pair_limit), ["key", "cell"])
    crowded = met.where(F.col("n") > pair_limit).drop("n")
    if not crowded.isEmpty():
        divided = crowded.withColumn("fine", F.explode(_cells(F.col("at"), MORE_PIVOTS)))
        again = saved(_met(divided, ["key", "cell", "fine"]))
        pairs = pairs.unionByName(_pairs(again.where(F.col("n") <= pair_limit), ["key", "cell", "fine"]))
        pairs = pairs.unionByName(_links_by_neighbour(again.where(F.col("n") > pair_limit).select("fp").distinct()))
    return pairs.distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node of distinct edges (a, b), a < b, is the smaller end of all its edges or the larger of one alone."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("n"), F.lit(0).alias("up")), F.struct(F.col("b").alias("n"), F.lit(1).alias("up")))).alias("e"))
    nodes = ends.groupBy("e.n").agg(F.sum("e.up").alias("up"), F.count("*").alias("n_edges"))
    return nodes.where("up > 0 AND n_edges > 1").count() == 0


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of edges (a, b), root the smallest node reachable.

    Alternates large-star and small-star steps (each halves the depth at least) until the
    edges are stars round their smallest nodes, which one grouping tells: no round is spent on
    edges that won't change. Every round is written to the shared folder.
    """
    edges = saved(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct())
    while not _are_stars(edges):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a != b").distinct()
        up = large.select(F.col("b").alias("n"), F.col("a").alias("v"))
        least = up.groupBy("n").agg(F.min("v").alias("m"))
        small = up.join(least, "n").select(F.col("m").alias("a"), F.explode(F.array("v", "n")).alias("b"))
        old, edges = edges, saved(small.where("a != b").distinct())
        discard(old)
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))


def _components_of(prints: DataFrame, least: Column, pair_limit: int) -> DataFrame:
    """(fp, first): each fingerprint's component, named by the smallest `least` in it."""
    groups = prints.groupBy("fp").agg(F.min(least).alias("least"))
    tree = saved(components(links(groups, pair_limit)))
    rooted = groups.join(tree, groups.fp == tree.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("first"))
    return rooted.join(smallest, "root").select("fp", "first")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """Every row's fingerprint and the smallest document id linked with it, itself included.

    Equal fingerprints are linked, so copies cost one fingerprint, not pairs. Null and empty
    texts and texts without words have fingerprint zero and are linked like any other. Rows
    with a null id get their component's id (null if it has no other). Repeated rows each give
    a row. An empty table gives an empty result; other columns are ignored.
    """
    prints = saved(fingerprints(docs, id_col, text_col))
    named = _components_of(prints, F.col("doc_id"), pair_limit).withColumnRenamed("first", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """The documents with the smallest id of their component (null ids last), all columns kept.

    Null and empty texts are one component; of repeated rows, one stays; an empty table stays
    empty.
    """
    prints = saved(fingerprints(docs, id_col, text_col))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    name = unused(docs, "__row")
    first = _components_of(prints, order, pair_limit).select(F.col("first.row").alias(name)).distinct()
    row = row_hash(F.col(id_col), F.col(text_col).cast("string"))
    return docs.withColumn(name, row).join(first, name, "left_semi").dropDuplicates([name]).drop(name)
