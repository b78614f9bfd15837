"""Benchmark decontamination: a prefix-filtered set join of item windows with document shingles."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.llm.common import discard, filter_batches, identified, map_batches, plain_words, row_hash, saved, text_bytes, values

#: Words of a window; an item of fewer words is one window.
WINDOW = 10
#: Words of the shingles that windows are sets of.
SHINGLE = 3
#: Item windows that are sent to the tasks at once; more go in several rounds.
WINDOWS_A_ROUND = 100_000


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(number, words) of the distinct windows, words joined by one space, and (number, item) of
    the items that have them; both saved. Items with a null id have windows but no row in the second."""

    def per_batch(batch):
        found = {"words": [], "item": []}
        for item, text in zip(values(batch, "doc_id"), text_bytes(batch)):
            own = plain_words(text)
            for i in range(max(1, len(own) - window + 1) if own else 0):
                found["words"].append(b" ".join(own[i : i + window]))
                found["item"].append(item)
        return found

    named = items.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    held = saved(map_batches(identified(named, "doc_id", "text"), per_batch, "words binary, item string").distinct())
    windows = saved(held.select("words").distinct().select(F.monotonically_increasing_id().alias("number"), "words"))
    owners = saved(held.where("item IS NOT NULL").join(windows, "words").select("number", "item"))
    discard(held)
    return windows, owners


def _shingles(words: tuple[bytes, ...]) -> list[tuple[bytes, ...]]:
    k = min(SHINGLE, len(words))
    return [words[i : i + k] for i in range(len(words) - k + 1)]


def shingle_counts(docs: DataFrame, wanted: set[tuple[bytes, ...]]) -> dict[tuple[bytes, ...], int]:
    """In how many places of all documents each wanted shingle stands, up to one round's shingles."""
    broadcast = docs.sparkSession.sparkContext.broadcast(wanted)
    lengths = sorted({len(s) for s in wanted})

    def per_batch(batch):
        known, counts = broadcast.value, Counter()
        firsts = {s[0] for s in known}
        for text in text_bytes(batch):
            own = plain_words(text)
            at = [i for i, w in enumerate(own) if w in firsts]
            for k in lengths:
                counts.update(s for s in [tuple(own[i : i + k]) for i in at] if s in known)
        return {"shingle": [b" ".join(s) for s in counts], "n": list(counts.values())}

    totals = map_batches(docs, per_batch, "shingle binary, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    return {tuple(bytes(r.shingle).split()): r.n for r in totals.toLocalIterator()}


def prefix_index(windows: dict[tuple[bytes, ...], int], counts: dict) -> tuple[set, list, dict]:
    """First words and lengths of the windows' prefixes, and {prefix: {(offset, length): {window: number}}}.

    Shingles of a window are ordered by rarity, ties by the words. A document holds a window
    only if it holds all its shingles, so the prefix that must meet is the rarest one alone;
    its offset and the window's length bound where the window can lie. Every step is a lookup,
    however many windows share a word or a prefix.
    """
    index: dict = {}
    for window, number in windows.items():
        _, shingle, offset = min((counts.get(s, 0), s, i) for i, s in enumerate(_shingles(window)))
        index.setdefault(shingle, {}).setdefault((offset, len(window)), {})[window] = number
    return {s[0] for s in index}, sorted({len(s) for s in index}), index


def covered(words: list[bytes], indexed: tuple[set, list, dict]) -> tuple[np.ndarray, set]:
    """Which words lie in occurrences of indexed windows, and the numbers of the windows that occur."""
    firsts, lengths, index = indexed
    hit = np.zeros(len(words), dtype=bool)
    found: set = set()
    for i, word in enumerate(words):
        if word not in firsts:
            continue
        for k in lengths:
            for (offset, size), known in index.get(tuple(words[i : i + k]), {}).items():
                start, end = i - offset, i - offset + size
                if start >= 0 and end <= len(words) and (number := known.get(tuple(words[start:end]))) is not None:
                    hit[start:end] = True
                    found.add(number)
    return hit, found


def _rounds(texts: DataFrame, windows: DataFrame, windows_a_round: int) -> Iterator:
    """Broadcasts of the prefix index of at most windows_a_round windows, about."""
    rounds = max(1, -(-windows.count() // windows_a_round))
    for n in range(rounds):
        part = windows.where(F.pmod(F.xxhash64("words"), F.lit(rounds)) == n)
        numbers = {tuple(bytes(r.words).split()): r.number for r in part.toLocalIterator()}
        wanted = {s for w in numbers for s in _shingles(w)}
        counts = shingle_counts(texts, wanted) if wanted else {}
        yield texts.sparkSession.sparkContext.broadcast(prefix_index(numbers, counts))


def clean(
    docs: DataFrame, items: DataFrame, text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", windows_a_round: int = WINDOWS_A_ROUND,
) -> DataFrame:
    """The documents without any word in an item's window, all columns kept.

    Null and empty texts have no words and stay; repeated rows stay or go alike; without items,
    or with items without words only, all stay; an empty table stays empty.
    """
    texts = docs.select(F.col(text_col).alias("text"))
    windows, _ = item_windows(items, item_id_col, item_text_col)
    for sent in _rounds(texts, windows, windows_a_round):

        def per_batch(batch, sent=sent):
            keep = [not covered(plain_words(t), sent.value)[1] for t in text_bytes(batch, text_col)]
            return batch.filter(pa.array(keep, type=pa.bool_()))

        docs = filter_batches(docs, per_batch)
    return docs


def decontaminate(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", windows_a_round: int = WINDOWS_A_ROUND,
) -> DataFrame:
    """One row per input row: doc_id, n_words, hits (spans [start, end) of hit words), items.

    Item windows are sent to the tasks in rounds of at most windows_a_round, so what is
    broadcast is bounded; with several rounds a row's spans are merged. Windows go by number:
    which items have them is joined afterwards, so no task holds the items of a common window.
    Words are lower-cased letters, digits and non-ASCII characters. Null and empty texts have no
    words and no hits; items without words have no windows; the windows of an item with a null
    id hit, but name no item. Rows with a null id and repeated rows each give a row; empty tables
    give no rows (documents) or no hits (items); other columns are ignored.
    """
    frame = identified(docs, id_col, text_col)
    kind = frame.schema["doc_id"].dataType.simpleString()
    spans = "hits array<struct<start:bigint,end:bigint>>"
    schema = f"doc_id {kind}, row binary, n_words bigint, {spans}, windows array<bigint>"
    frame = frame.withColumn("row", row_hash("doc_id", "text"))
    windows, owners = item_windows(items, item_id_col, item_text_col)
    results = []
    for sent in _rounds(frame.select("text"), windows, windows_a_round):

        def per_batch(batch, sent=sent):
            out = {"doc_id": values(batch, "doc_id"), "row": values(batch, "row"), "n_words": [], "hits": [], "windows": []}
            for text in text_bytes(batch):
                own = plain_words(text)
                hit, found = covered(own, sent.value)
                edges = np.flatnonzero(np.diff(hit, prepend=False, append=False)).tolist() if found else []
                out["n_words"].append(len(own))
                out["hits"].append([{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2])])
                out["windows"].append(sorted(found))
            return out

        results.append(saved(map_batches(frame, per_batch, schema)))
    every, *others = results
    # Rows without a hit need no join; of the others, repeated rows are alike.
    found = [r.where(F.size("windows") > 0).select("row", "hits", "windows").dropDuplicates(["row"]) for r in results]
    united = reduce(DataFrame.unionByName, found)
    named = united.select("row", F.explode("windows").alias("number")).join(owners, "number")
    named = named.groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    if others:
        merged = _merged(united).join(named, "row", "left")
        return every.drop("hits", "windows").join(merged, "row", "left").select("doc_id", "n_words", *_or_none())
    none = every.where(F.size("windows") == 0).select("doc_id", "n_words", "hits", F.array().cast("array<string>").alias("items"))
    some = every.where(F.size("windows") > 0).join(named, "row", "left").select("doc_id", "n_words", *_or_none())
    return none.unionByName(some)


def _or_none() -> list[Column]:
    kinds = {"hits": "array<struct<start:bigint,end:bigint>>", "items": "array<string>"}
    return [F.coalesce(name, F.array().cast(kind)).alias(name) for name, kind in kinds.items()]


def _merged(united: DataFrame) -> DataFrame:
    """(row, hits): the spans of several rounds united, touching ones as one."""
    places = F.transform(F.flatten(F.collect_list("hits")), lambda s: F.sequence(s["start"], s["end"] - 1))
    hit = united.groupBy("row").agg(F.array_distinct(F.flatten(places)).alias("hit"))
    after = F.transform("hit", lambda p: p + 1)
    starts, ends = F.array_sort(F.array_except("hit", after)), F.array_sort(F.array_except(after, "hit"))
    return hit.select("row", F.arrays_zip(starts.alias("start"), ends.alias("end")).alias("hits"))


def digest(result: DataFrame) -> DataFrame:
    """The counts and digests of a decontamination's rows."""
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return result.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


