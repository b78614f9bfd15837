"""License scans: ordered signature rules behind a keyword prefilter."""

from __future__ import annotations

import re
from bisect import bisect_left
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame

from assay.llm.license_rules import parse
from assay.llm.common import identified, map_batches, plain_words, text_bytes, values

#: Phrases that count wherever their words stand, and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

class Rule(NamedTuple):
    priority: int
    label: str
    keywords: tuple[bytes, ...]
    pattern: re.Pattern[bytes]
    score: float


def rules() -> list[Rule]:
    """All signature rules, the first in order winning."""
    return [
        Rule(i, label, tuple(k.encode() for k in keywords), re.compile(rb" (?=(" + pattern.encode() + rb") )"), score)
        for i, (label, score, keywords, pattern) in enumerate(parse())
    ]


def base_places(plain: bytes) -> list[tuple[int, str]]:
    """(start in words, label) of every place of a base phrase in ` word word ... `."""
    found = []
    for phrase, label in BASE:
        needle = f" {phrase} ".encode()
        before, start, at = 0, 0, plain.find(needle)
        while at >= 0:
            before += plain.count(b" ", start, at)
            found.append((before, label))
            start, at = at, plain.find(needle, at + 1)
    return found


def signatures(plain: bytes, ordered: list[Rule]) -> list[tuple[int, int, Rule]]:
    """(start, end, rule) of the detections that stay, as byte positions.

    Where detections overlap, the rule with the higher priority stays, unless its interval lies
    in a longer one's: what another contains is suppressed.
    """
    present = {k: k in plain for k in {k for rule in ordered for k in rule.keywords}} if plain else {}
    hits = [
        (m.start(1), m.end(1), rule)
        for rule in ordered
        if any(present.get(k) for k in rule.keywords)
        for m in rule.pattern.finditer(plain)
    ]
    hits.sort(key=lambda h: (h[0], -h[1], h[2].priority))
    outer, reach = [], -1
    for hit in hits:
        if hit[1] > reach:
            outer.append(hit)
            reach = hit[1]
    # Those that stay are apart, so only the neighbours of a hit can overlap it.
    kept: list = []
    for hit in sorted(outer, key=lambda h: (h[2].priority, h[0])):
        at = bisect_left(kept, hit[:2])
        if (not at or kept[at - 1][1] <= hit[0]) and (at == len(kept) or hit[1] <= kept[at][0]):
            kept.insert(at, (hit[0], hit[1], hit[2]))
    return kept


COLUMNS = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, "
    "detections array<struct<label:string,start:bigint,end:bigint,score:double>>"
)


def judge(text: bytes | None, ordered: list[Rule]) -> dict:
    words = plain_words(text)
    plain = b" " + b" ".join(words) + b" " if words else b""
    base = base_places(plain)
    found = signatures(plain, ordered)
    own = {label for _, label in base}
    starts = [start for start, _ in base]
    spaces = np.flatnonzero(np.frombuffer(plain, dtype=np.uint8) == 32) if found else np.zeros(0, dtype=np.int64)
    first, end = (np.searchsorted(spaces, [h[i] for h in found]).tolist() for i in (0, 1))
    return {
        "n_words": len(words),
        "n_base": len(base),
        "first_word": min(starts, default=None),
        "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(own)),
        "labels": ",".join(sorted(own | {r.label for _, _, r in found})),
        "score": max([0.5 * bool(base), *(r.score for _, _, r in found)]),
        "detections": [
            {"label": r.label, "start": a - 1, "end": b, "score": r.score}
            for a, b, (_, _, r) in zip(first, end, found)
        ],
    }


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: base phrases' places and labels, all labels, score, detections.

    Places are numbered in words from 0; detections span words [start, end). The score is that
    of the surest rule (0.5 at least with a base phrase, 0 without any). Null and empty texts
    have no words, no places and empty labels. Texts are scanned whole; rows with a null id and
    repeated rows each give a row; an empty table gives an empty result; other columns are
    ignored.
    """
    # Broadcasts pickle classes by name, which executors don't have: send plain tuples.
    sent = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in rules()])
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]

    def per_batch(batch):
        ordered = [Rule(*r) for r in sent.value]
        rows = [judge(t, ordered) for t in text_bytes(batch)]
        return {"doc_id": values(batch, "doc_id")} | {n: [r[n] for r in rows] for n in names}

    frame = identified(docs, id_col, text_col)
    return map_batches(frame, per_batch, f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, {COLUMNS}")
