"""Line-first cleaning: rules judge lines, failing lines go, documents that lose too much go."""

from __future__ import annotations

import re
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from assay.llm.common import filter_batches, identified, map_batches, replaced, space_words, text_bytes, values

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A document goes if failing lines held more than this share of its words.
MAX_LOST = 0.30

SYMBOLS = b"#*$%&|<>"
#: Bytes that continue a character in UTF-8.
_FOLLOWING = bytes(range(0x80, 0xC0))
_SPACE = b" \t\n\x0b\x0c\r"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_MARKS = b"!?#*$%&<>{}\\^~=_"
_DIVIDERS = tuple(f" {c} ".encode() for c in "|>/»·•")
#: Phrases that a notice consists of, and such as also stand in plain sentences; matched at word
#: limits whatever their case.
_NOTICES = (
    b"all rights reserved", b"terms of use", b"terms of service", b"privacy policy", b"uses cookies", b"use cookies",
    b"click here", b"read more", b"lorem ipsum",
)
_HINTS = (b"licensed under", b"released under", b"cookie", b"cookies", b"javascript", b"sign in", b"sign up", b"log in", b"login", b"subscribe", b"copyright")
_PHRASES = _NOTICES + _HINTS
_NOTICE = re.compile(rb"\b(?:" + b"|".join(_NOTICES) + rb")\b")
_BOILERPLATE = re.compile(rb"\b(?:" + b"|".join(_PHRASES) + rb")\b")
#: A line is boilerplate if notices are an eighth of its words, or all phrases over a third.
NOTICE_SHARE, PHRASE_SHARE = 8, 3


def count_of(text: bytes, characters: bytes) -> int:
    """How many of these ASCII characters a text has."""
    return len(text) - len(text.translate(None, characters))


def is_boilerplate(line: bytes, n: int) -> bool:
    """Whether phrases make up so much of a line of n words; one phrase in a long line is no boilerplate."""
    lowered = line.lower()
    words = [sum(m.count(b" ") + 1 for m in pattern.findall(lowered)) for pattern in (_NOTICE, _BOILERPLATE)]
    return words[0] > 0 and NOTICE_SHARE * words[0] >= n or PHRASE_SHARE * words[1] > n


def line_fails(line: bytes, words: list[bytes], phrases: bool = True) -> str:
    """Name of the first rule that a line fails, or an empty string."""
    n = len(words)
    if sum(map(line.count, _DIVIDERS)) >= max(2, n / 6):
        return "navigation"
    if phrases and is_boilerplate(line, n):
        return "boilerplate"
    if n >= 3 and count_of(line, _MARKS) >= 0.3 * n:
        return "punctuation"
    if n >= 5 and count_of(line, _UPPER) > 2 * count_of(line, _LOWER):
        return "shouting"
    if n >= 6 and 2 * sum(map(eq, words, words[1:])) >= n - 1:
        return "repetition"
    return ""


def repeated_words(words: list[bytes]) -> int:
    """How many words lie in 3-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=n)
    v = len(known)
    if v < 2_000_000:
        windows = (ids[:-2] * v + ids[1:-1]) * v + ids[2:]
    else:
        _, pairs = np.unique(ids[:-1] * v + ids[1:], return_inverse=True)
        windows = pairs[:-1] * v + ids[2:]
    _, place, count = np.unique(windows, return_inverse=True, return_counts=True)
    hit = count[place] > 1
    covered = np.zeros(n, dtype=bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= hit
    return int(covered.sum())


def judge(text: bytes | None) -> tuple:
    """Counts, verdicts and the cleaned text of one document."""
    text = text or b""
    words = space_words(text)
    n = len(words)
    repeated = repeated_words(words)
    lowered = text.lower()
    phrases = any(p in lowered for p in _PHRASES)
    seen: set[bytes] = set()
    duplicates = lost = 0
    left: list[bytes] = []
    for line in text.split(b"\n"):
        own = space_words(line)
        if own:
            repeat = line in seen
            duplicates += repeat
            seen.add(line)
            if repeat or line_fails(line, own, phrases):
                lost += len(own)
                continue
        left.append(line)
    failed = n < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * n
    share = lost / n if n else 0.0
    characters = len(text) - count_of(text, _FOLLOWING) - count_of(text, _SPACE)
    return (
        n, characters, count_of(text, SYMBOLS), duplicates, repeated,
        failed, not failed and share <= MAX_LOST, share, b"\n".join(left).decode(),
    )


COLUMNS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, lost_share double, cleaned string"
)


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts, base_failed, kept, lost_share and the cleaned text.

    Null and empty texts have no words: all counts 0, base_failed true, kept false. Texts are
    judged whole, at any length. Repeated rows and null ids each give their own row; an empty
    table gives an empty result; other columns are ignored.
    """
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    def per_batch(batch):
        rows = [judge(t) for t in text_bytes(batch)]
        return {"doc_id": values(batch, "doc_id")} | {n: [r[i] for r in rows] for i, n in enumerate(names)}

    frame = identified(docs, id_col, text_col)
    return map_batches(frame, per_batch, f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, {COLUMNS}")


def clean(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The documents that pass, all columns kept, their text without the failing lines.

    chars_col, where docs has it, gets the new text's length. Null and empty texts don't pass;
    repeated rows pass or go alike; an empty table stays empty.
    """
    if chars_col not in docs.columns:
        chars_col = None

    def per_batch(batch):
        rows = [judge(t) for t in text_bytes(batch, text_col)]
        batch = replaced(batch, text_col, [r[8] for r in rows])
        if chars_col:
            batch = replaced(batch, chars_col, [len(r[8]) for r in rows])
        return batch.filter(pa.array([r[6] for r in rows], type=pa.bool_()))

    return filter_batches(docs, per_batch)
