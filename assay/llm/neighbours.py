"""Nearest neighbours by inner product, over randomly rotated one-bit codes.

A vector is centred, rotated at random and kept as the signs of its components, with three
numbers beside them. A query's inner product with the signs estimates that with the vector, and
the error has a bound that holds with high probability. Within a block of vectors, only those
whose estimate plus bound reaches the query's twentieth exact score so far are scored exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.common import arrow_schema, saved

NEAREST, QUERY_EVERY = 20, 20
#: Bits of a code for each component; more narrow the bound.
BITS_A_COMPONENT = 2
#: Standard deviations of an estimate's error that the bound allows: a true neighbour right at the
#: threshold is missed about once in 4,000 times.
DEVIATIONS = 3.5
#: Rows that a task holds of vectors and of queries, at least and at most; between, a sixteenth of
#: the vectors and a quarter of the queries. A block of wide vectors has fewer rows.
VECTORS_A_BLOCK, QUERIES_A_BLOCK, BLOCK_COMPONENTS = (1024, 16_384), (256, 16_384), 1 << 22
#: Candidates scored exactly at first, to get a threshold; queries and vectors estimated at once.
FIRST_SCORED, QUERIES_AT_ONCE, VECTORS_AT_ONCE = 48, 64, 8192


def usable(vec: Column) -> Column:
    """Not null, without null or non-finite components, and not all zero."""
    whole = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(whole & F.exists(vec, lambda x: x != 0), F.lit(False))


def rotation(dims: int, seed: int = 0) -> np.ndarray:
    """dims rows of a random orthogonal matrix that is BITS_A_COMPONENT times as wide, padded to whole bytes."""
    wide = -(-dims * BITS_A_COMPONENT // 8) * 8
    q, r = np.linalg.qr(np.random.default_rng([seed, dims]).standard_normal((wide, wide)))
    return (q * np.sign(np.diag(r)))[:dims]


def encode(x: np.ndarray, centre: np.ndarray, turn: np.ndarray, deviations: float = DEVIATIONS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, the factor from <query, signs> to an inner product, and the bound for a query of length one.

    With o the rotated unit vector and s its inner product with its own signs, scaled to length
    one, <q, signs> / s estimates <q, o>. What it leaves out is orthogonal to the signs, in a
    direction that the rotation makes random.
    """
    rest = x - centre
    length = np.sqrt((rest * rest).sum(axis=1))
    rotated = rest @ turn
    bits = turn.shape[1]
    own = np.abs(rotated).sum(axis=1) / math.sqrt(bits)
    with np.errstate(all="ignore"):
        factor = np.where(own > 0, length * length / own, 0.0) / math.sqrt(bits)
        share = np.where(own > 0, own / np.where(length > 0, length, 1), 1.0)
        bound = length * deviations * np.sqrt(np.maximum(0, 1 - share * share)) / share / math.sqrt(max(1, bits - 1))
    return np.packbits(rotated > 0, axis=1), factor, bound + 1e-5 * length


def scores(x: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, added in the order of the components whatever the row."""
    return np.cumsum(x * query, axis=1)[:, -1]


def nearest_in_block(
    queries: np.ndarray, query_rows: np.ndarray, vectors: np.ndarray, rows: np.ndarray, ids: np.ndarray,
    codes: np.ndarray, factor: np.ndarray, bound: np.ndarray, centre: np.ndarray, turn: np.ndarray, nearest: int,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its number, and places and scores of its nearest vectors in the block.

    The vectors of the best estimates are scored first; the nearest-th of these scores is a
    threshold that no vector of the result can be under. Every vector whose estimate and bound
    reach it is then scored; what can't be estimated (an overflow) is always scored.
    """
    for begin in range(0, len(queries), QUERIES_AT_ONCE):
        q = queries[begin : begin + QUERIES_AT_ONCE]
        with np.errstate(all="ignore"):
            turned, size, middle = (q @ turn).astype(np.float32), np.sqrt((q * q).sum(axis=1)), q @ centre
            estimate = np.empty((len(q), len(vectors)))
            for at in range(0, len(vectors), VECTORS_AT_ONCE):
                part = slice(at, at + VECTORS_AT_ONCE)
                signs = np.unpackbits(codes[part], axis=1).astype(np.float32) * 2 - 1
                estimate[:, part] = (turned @ signs.T) * factor[part]
            estimate += middle[:, None]
        for i in range(len(q)):
            others = rows != query_rows[begin + i]
            guess = np.where(others, estimate[i], -np.inf)
            with np.errstate(all="ignore"):
                most = guess + bound * size[i]
            threshold = -np.inf
            if len(vectors) > FIRST_SCORED + nearest:
                first = np.argpartition(-guess, FIRST_SCORED)[:FIRST_SCORED]
                first = first[others[first]]
                if len(first) >= nearest:
                    known = np.nan_to_num(scores(vectors[first], q[i]), nan=-np.inf, posinf=np.inf, neginf=-np.inf)
                    threshold = np.partition(known, len(first) - nearest)[len(first) - nearest]
            chosen = np.flatnonzero(others & ~(most < threshold))
            exact = scores(vectors[chosen], q[i])
            order = np.lexsort((rows[chosen], ids[chosen], -exact))[:nearest]
            yield begin + i, chosen[order], exact[order]


def _blocks(count: int, limits: tuple[int, int], parts: int, dims: int) -> int:
    """Into how many blocks so many rows go."""
    a_block = min(max(limits[0], -(-count // parts)), limits[1], max(limits[0], BLOCK_COMPONENTS // max(1, dims)))
    return max(1, -(-count // a_block))


def usable_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, vec) of the vectors that take part."""
    return df.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec")).where(usable(F.col("vec")))


def index(vectors: DataFrame, centres: dict[int, list[float]], deviations: float = DEVIATIONS) -> DataFrame:
    """Every vector with its number, code, factor and bound, written once."""
    frame = vectors.withColumn("row", F.monotonically_increasing_id())
    kind = frame.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, row bigint, dims int, vec binary, code binary, factor double, bound double"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            column = batch.column("vec")
            lengths = np.diff(column.offsets.to_numpy())
            for dims in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == dims))
                x = part.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                if dims not in turns:
                    turns[dims] = rotation(dims)
                with np.errstate(all="ignore"):
                    codes, factor, bound = encode(x, np.array(centres[dims]), turns[dims], deviations)
                columns = [
                    part.column("vec_id"), part.column("row"), pa.array([dims] * len(x), pa.int32()), pa.array([v.tobytes() for v in x.astype("<f8")], pa.binary()),
                    pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(factor), pa.array(bound),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return saved(frame.mapInArrow(run, schema))


def centres_of(vectors: DataFrame) -> dict[int, list[float]]:
    """The mean vector of each length, by sums a batch; lengths are few."""
    schema = "dims int, n bigint, total array<double>"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.diff(batch.column("vec").offsets.to_numpy())
            for dims in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == dims))
                x = part.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                yield pa.RecordBatch.from_arrays([pa.array([dims], pa.int32()), pa.array([len(x)]), pa.array([x.sum(axis=0).tolist()], arrow.field("total").type)], schema=arrow)

    sums = vectors.select("vec").mapInArrow(run, schema).select("dims", "n", F.posexplode("total").alias("at", "x"))
    means = sums.groupBy("dims", "at").agg((F.sum("x") / F.sum("n")).alias("mean")).groupBy("dims").agg(F.sort_array(F.collect_list(F.struct("at", "mean"))).alias("means"))
    return {r["dims"]: [m["mean"] for m in r["means"]] for r in means.collect()}


def search(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", nearest: int = NEAREST, query_every: int = QUERY_EVERY,
    deviations: float = DEVIATIONS,
) -> DataFrame:
    """Each query's nearest vectors: query_id, rank from 1, vec_id, score.

    Queries are the vectors whose id is divisible by query_every, searched for among all vectors
    of the same length but the query's own row. Vectors that are null, empty, zero or hold a null
    or non-finite component take no part; vectors without an id are found, but are no queries.
    Repeated rows are vectors of their own, so they find each other, and a repeated query gives
    its result again. Ties go to the smaller id, ids that are null first; an empty table gives an empty
    result; other columns are ignored.

    Vectors and queries are dealt to blocks by number, and every pair of blocks is one task of
    bounded size, whatever the data; a task returns no more than `nearest` rows a query.
    """
    vectors = usable_vectors(df, id_col, vec_col)
    centres = centres_of(vectors)
    coded = index(vectors, centres, deviations)
    queries = coded.where((F.col("vec_id") % query_every == 0) & F.col("vec_id").isNotNull())
    sizes = {r["dims"]: (r["n"], r["q"]) for r in coded.groupBy("dims").agg(F.count("*").alias("n"), F.count(F.when(F.col("vec_id") % query_every == 0, 1)).alias("q")).collect()}
    kind = coded.schema["vec_id"].dataType.simpleString()
    ends = f"query_id {kind}, query_row bigint, vec_id {kind}, row bigint, score double"
    if not sizes:
        return df.sparkSession.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    spans = [(d, _blocks(n, VECTORS_A_BLOCK, 16, d), _blocks(q, QUERIES_A_BLOCK, 4, d)) for d, (n, q) in sizes.items() if q]
    grid = F.broadcast(df.sparkSession.createDataFrame(spans, "dims int, vector_blocks int, query_blocks int"))

    def own(blocks: str) -> Column:
        return F.pmod(F.xxhash64("row"), F.col(blocks)).cast("int")

    def all_of(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    held = coded.join(grid, "dims").select("dims", own("vector_blocks").alias("a"), all_of("query_blocks").alias("b"), F.lit(False).alias("asks"), "vec_id", "row", "vec", "code", "factor", "bound")
    none = [F.lit(None).cast(t).alias(n) for n, t in (("code", "binary"), ("factor", "double"), ("bound", "double"))]
    asked = queries.join(grid, "dims").select("dims", all_of("vector_blocks").alias("a"), own("query_blocks").alias("b"), F.lit(True).alias("asks"), "vec_id", "row", "vec", *none)
    arrow = arrow_schema(ends)

    def tile(table: pa.Table) -> pa.Table:
        dims = table.column("dims")[0].as_py()
        asks = table.column("asks").combine_chunks()
        q, v = table.filter(asks), table.filter(pc.invert(asks))
        if not len(q) or not len(v):
            return arrow.empty_table()
        matrix = lambda t, name, dtype: np.frombuffer(b"".join(t.column(name).to_pylist()), dtype=dtype).reshape(len(t), -1)
        number = lambda t, name: t.column(name).to_numpy()
        ids = np.array([-math.inf if i is None else i for i in v.column("vec_id").to_pylist()], dtype=object)
        ids = np.unique(ids, return_inverse=True)[1]
        found = list(nearest_in_block(
            matrix(q, "vec", "<f8"), number(q, "row"), matrix(v, "vec", "<f8"), number(v, "row"), ids, matrix(v, "code", "u1"),
            number(v, "factor"), number(v, "bound"), np.array(centres[dims]), rotation(dims), nearest,
        ))
        who = np.repeat([i for i, _, _ in found], [len(places) for _, places, _ in found]).astype(np.int64)
        places = np.concatenate([p for _, p, _ in found]).astype(np.int64)
        columns = [q.column("vec_id").take(who), q.column("row").take(who), v.column("vec_id").take(places), v.column("row").take(places), pa.array(np.concatenate([s for _, _, s in found]))]
        return pa.table([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], schema=arrow)

    found = held.unionByName(asked).groupBy("dims", "a", "b").applyInArrow(tile, ends)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_first("vec_id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= nearest)
    return ranked.select("query_id", "rank", "vec_id", "score")
