"""Language identification with hyperdimensional profiles."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.common import crc_mod, identified, map_batches, values

#: Length of the random vectors, letters of an n-gram, and the seed.
DIMENSIONS = 512
LETTERS = 3
SEED = 20240501
#: A letter's code takes so many bits of an n-gram: room for every code point.
BITS = 21
#: Codes of a-z are 1 to 26 and 0 is what lies between words; n-grams of these have a table.
PLAIN = 27
#: N-grams that are bound at once, to bound memory.
AT_ONCE = 8192


def code_table() -> np.ndarray:
    """The code of every character: 0 if it isn't a letter, 1 to 26 for a-z, else its code point."""
    codes = np.zeros(0x110000, dtype=np.int32)
    for c in range(0x80, 0x110000):
        if chr(c).isalpha():
            codes[c] = c
    for i, c in enumerate("abcdefghijklmnopqrstuvwxyz"):
        codes[ord(c)] = codes[ord(c.upper())] = i + 1
    return codes


def ngrams(text: str | None, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a text's letters, runs of other characters as one gap, and their counts."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), dtype="<u4")
    letters = codes[points]
    if not letters.any():
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    gap = np.zeros(1, dtype=np.int32)
    letters = np.concatenate([gap, letters, gap])
    letters = letters[np.r_[True, (letters[1:] != 0) | (letters[:-1] != 0)]].astype(np.int64)
    grams = np.zeros(max(0, len(letters) - LETTERS + 1), dtype=np.int64)
    for i in range(LETTERS):
        grams = (grams << BITS) | letters[i : len(letters) - LETTERS + 1 + i]
    return np.unique(grams, return_counts=True)


def letters_of(grams: np.ndarray) -> list[np.ndarray]:
    """The letter codes of n-grams, by place."""
    return [(grams >> (BITS * (LETTERS - 1 - place))) & ((1 << BITS) - 1) for place in range(LETTERS)]


class Vectors:
    """Random vectors of letters and n-grams; each letter's is drawn anew anywhere from its code."""

    def __init__(self, dimensions: int = DIMENSIONS) -> None:
        self.dimensions = dimensions
        self.turn = np.random.default_rng(SEED).permutation(dimensions)
        self._known: dict[int, np.ndarray] = {}
        self._table: np.ndarray | None = None

    def letter(self, code: int) -> np.ndarray:
        """A vector of -1 and 1."""
        if code not in self._known:
            if len(self._known) > 100_000:
                self._known.clear()
            self._known[code] = np.random.default_rng((SEED, code)).integers(0, 2, self.dimensions, dtype=np.int8) * 2 - 1
        return self._known[code]

    def bound(self, grams: np.ndarray) -> np.ndarray:
        """N-gram vectors: the letters' vectors, permuted once for each place that follows, multiplied."""
        out = np.ones((len(grams), self.dimensions), dtype=np.int8)
        for place, codes in enumerate(letters_of(grams)):
            known, which = np.unique(codes, return_inverse=True)
            drawn = np.stack([self.letter(int(c)) for c in known]) if len(known) else np.zeros((0, self.dimensions), dtype=np.int8)
            for _ in range(LETTERS - 1 - place):
                drawn = drawn[:, self.turn]
            out *= drawn[which]
        return out

    def _plain(self) -> np.ndarray:
        """Vectors of all n-grams of a-z and gaps: a table of fixed size."""
        if self._table is None:
            places = np.indices((PLAIN,) * LETTERS).reshape(LETTERS, -1).astype(np.int64)
            grams = np.zeros(places.shape[1], dtype=np.int64)
            for codes in places:
                grams = (grams << BITS) | codes
            self._table = self.bound(grams).astype(np.float32)
        return self._table

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The sum of n-gram vectors by their counts."""
        codes = letters_of(grams)
        plain = np.logical_and.reduce([c < PLAIN for c in codes])
        total = np.zeros(self.dimensions)
        places = np.zeros(len(grams), dtype=np.int64)
        for c in codes:
            places = places * PLAIN + c
        for part in (np.flatnonzero(plain), np.flatnonzero(~plain)):
            for i in range(0, len(part), AT_ONCE):
                chosen = part[i : i + AT_ONCE]
                vectors = self._plain()[places[chosen]] if plain[chosen[0]] else self.bound(grams[chosen]).astype(np.float32)
                total += counts[chosen].astype(np.float32) @ vectors
        return total


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """Languages and their prototypes: bundled n-gram vectors of all texts with a language.

    Each batch adds up its n-grams by language and bundles them once; the sums of the bundles
    are what leaves the tasks: one vector for each language and batch. Null languages and texts
    are left out, and texts without letters add nothing; repeated rows count each; without any
    text there are no languages.
    """
    sent = docs.sparkSession.sparkContext.broadcast(code_table())

    def per_batch(batch):
        vectors = Vectors(dimensions)
        found: dict[str, list] = {}
        for lang, text in zip(values(batch, "lang"), values(batch, "text")):
            found.setdefault(lang, []).append(ngrams(text, sent.value))
        out = {"lang": [], "at": [], "total": []}
        for lang, each in found.items():
            grams, which = np.unique(np.concatenate([g for g, _ in each]), return_inverse=True)
            counts = np.bincount(which, np.concatenate([c for _, c in each]), len(grams))
            bundle = np.zeros(dimensions, dtype=np.int64)
            for i in range(0, len(grams), AT_ONCE):
                part = slice(i, i + AT_ONCE)
                bundle += np.rint(counts[part] @ vectors.bound(grams[part]).astype(np.float64)).astype(np.int64)
            out["lang"] += [lang] * dimensions
            out["at"] += range(dimensions)
            out["total"] += bundle.tolist()
        return out

    frame = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    frame = frame.where("lang IS NOT NULL AND text IS NOT NULL")
    sums = map_batches(frame, per_batch, "lang string, at int, total bigint").groupBy("lang", "at").agg(F.sum("total").alias("total"))
    # A row for each language and dimension: bounded by the languages, not the documents.
    by_lang: dict[str, np.ndarray] = {}
    for r in sums.toLocalIterator():
        by_lang.setdefault(r["lang"], np.zeros(dimensions))[r["at"]] = r["total"]
    names = sorted(n for n, v in by_lang.items() if v.any())
    prototypes = np.stack([by_lang[n] / np.linalg.norm(by_lang[n]) for n in names]) if names else np.zeros((0, dimensions))
    return names, prototypes


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score (the cosine, 0 if negative).

    Null texts and texts without letters are `und` with score 0, as are all texts if the model
    knows no language; ties go to the first language in order. Texts are read whole; rows with a
    null id and repeated rows each give a row; an empty table gives an empty result; other
    columns are ignored.
    """
    names, prototypes = model
    context = docs.sparkSession.sparkContext
    sent = context.broadcast((code_table(), prototypes.astype(np.float32)))
    made: dict[int, Vectors] = {}

    def per_batch(batch):
        codes, known = sent.value
        vectors = made.setdefault(known.shape[1], Vectors(known.shape[1]))
        langs, scores = [], []
        for text in values(batch, "text"):
            grams, counts = ngrams(text, codes)
            if not len(grams) or not names:
                langs.append("und")
                scores.append(0.0)
                continue
            bundle = vectors.bundle(grams, counts)
            cosines = known @ (bundle / max(float(np.linalg.norm(bundle)), 1e-9)).astype(np.float32)
            best = int(cosines.argmax())
            langs.append(names[best])
            scores.append(float(min(1.0, max(0.0, cosines[best]))))
        return {"doc_id": values(batch, "doc_id"), "lang_pred": langs, "score": scores}

    frame = identified(docs, id_col, text_col)
    kind = frame.schema["doc_id"].dataType.simpleString()
    return map_batches(frame, per_batch, f"doc_id {kind}, lang_pred string, score double")


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from training."""
    return crc_mod(id_col, 4) == 2
