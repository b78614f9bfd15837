"""Secret scans with DataFrame functions only: spans, then ownership frequency over the corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.common import discard, perhaps_among, row_hash, saved, unused

_KEY = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "(password|passwd|secret|token|api_?key)")
#: kind: (pattern, group that holds the secret, its least length, a cheap test that texts must pass).
#: Classes name both cases, as (?i) folds other letters in some engines.
KINDS: dict[str, tuple[str, int, int, str]] = {
    "assign": (_KEY + "[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6, ""),
    "access": ("AKIA[A-Z0-9]+", 0, 20, "AKIA"),
    "hex": ("[0-9a-f]{24,}", 0, 24, ""),
    "github": ("gh[oprsu]_[A-Za-z0-9]{30,}", 0, 34, "gh"),
    "slack": ("xox[abprs]-[A-Za-z0-9-]{20,}", 0, 25, "xox"),
    "stripe": ("[rs]k_live_[A-Za-z0-9]{16,}", 0, 24, "k_live_"),
    "jwt": ("eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}", 0, 29, "eyJ"),
    "pem": ("-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 27, "-----BEGIN"),
}
BASE = ("assign", "access", "hex")
#: A candidate that this many owners hold is a widely copied example, and so is one of two owners at
#: least that lies in this many repositories. What one owner alone holds looks live, in however
#: many repositories.
COPIED_OWNERS, COPIED_REPOSITORIES = 3, 10


#: Characters of the blocks that a text is cut into before parts of it are taken.
_CUT = 1024


def _pieces(text: Column, rank: int, kind: str) -> Column:
    """(rank, i, gap, size, hash) of a pattern's matches: the length of what parts a match from
    the one before, its own, and the SHA-256 of the secret, null if that is too short."""
    pattern, group, least, gate = KINDS[kind]
    there = text.contains(gate) if gate else text.rlike(pattern)
    match, secret = (F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (0, group))
    zipped = F.arrays_zip(match.alias("match"), secret.alias("secret"), F.split(text, pattern, -1).alias("gap"))
    pieces = F.transform(
        zipped,
        lambda p, i: F.struct(
            F.lit(rank).alias("rank"), i.alias("i"), F.length(p["gap"]).alias("gap"), F.length(p["match"]).alias("size"),
            F.when(F.length(p["secret"]) >= least, F.sha2(p["secret"].cast("binary"), 256)).alias("hash"),
        ),
    )
    # What follows the last match is a gap without one.
    return F.when(there, F.filter(pieces, lambda p: p["size"].isNotNull()))


def _scanned(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repository_col: str | None, copied_col: str | None = None) -> DataFrame:
    """(row, doc_id, owner, repository, pieces), saved; row is a hash of these and the text.

    The only pass over the texts. Secrets are hashed before anything is written; pieces whose hash
    is in the row's copied_col get none, like those that are too short.
    """
    frame = docs.select(
        F.col(id_col).alias("doc_id"), F.col(owner_col).cast("string").alias("owner"),
        F.col(repository_col or id_col).cast("string").alias("repository"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        _row(id_col, text_col, owner_col, repository_col).alias("row"), *([F.col(copied_col).alias("copied")] if copied_col else []),
    )
    empty = F.array().cast("array<struct<rank:int,i:int,gap:int,size:int,hash:string>>")
    kinds = [F.coalesce(_pieces(F.col("text"), rank, kind), empty) for rank, kind in enumerate(KINDS)]
    pieces = F.flatten(F.array(*kinds))
    if copied_col:
        known = F.coalesce("copied", F.array().cast("array<string>"))
        pieces = F.transform(pieces, lambda p: p.withField("hash", F.when(~F.array_contains(known, p["hash"]), p["hash"])))
    return saved(frame.select("row", "doc_id", "owner", "repository", pieces.alias("pieces")))


def _row(id_col: str, text_col: str, owner_col: str, repository_col: str | None) -> Column:
    return row_hash(F.col(id_col), F.col(owner_col).cast("string"), F.col(repository_col or id_col).cast("string"), F.col(text_col).cast("string"))


def spans_of(scanned: DataFrame) -> DataFrame:
    """(row, owner, repository, start, rank, kind, end, hash): each candidate once, repeated rows once.

    Gaps and matches alternate, so their running sums are the matches' positions in code points.
    Windows hold the matches of one text.
    """
    once = scanned.where(F.size("pieces") > 0).dropDuplicates(["row"])
    each = once.select("row", "owner", "repository", F.inline("pieces")).repartition("row")
    upto = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("row", "rank").orderBy("i"))
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("rank") + 1)
    return each.withColumn("end", upto).where("hash IS NOT NULL").select(
        "row", "owner", "repository", (F.col("end") - F.col("size")).cast("int").alias("start"), "rank",
        kind.alias("kind"), F.col("end").cast("int").alias("end"), "hash",
    )


def ownership(spans: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repositories, copied) of every candidate of the corpus.

    Distinct owners are counted in two steps, by candidate and owner first, so a candidate that
    a third of all documents hold is reduced before any row of it meets in one task.
    """
    by_owner = spans.select("hash", "owner", "repository").distinct().groupBy("hash", "owner").agg(F.count("*").alias("n"))
    counted = by_owner.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories"))
    spread = (F.col("n_owners") >= 2) & (F.col("n_repositories") >= COPIED_REPOSITORIES)
    return counted.withColumn("copied", (F.col("n_owners") >= COPIED_OWNERS) | spread)


def _judged(spans: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """Spans with n_owners, n_repositories and copied; others: more spans that count for ownership.

    The verdicts have one row a candidate, so where very many spans share one, Spark splits that
    side of the join (adaptive skew join).
    """
    every = spans if others is None else spans.unionByName(others)
    return spans.join(ownership(every), "hash")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_col: str | None = None) -> DataFrame:
    """One row per input row: doc_id, found spans, how many of them are copied or look live, and the
    most owners and repositories that one of them has.

    found: structs (start, rank of kind, kind, end, hash), by start and rank. owner_col names who
    holds a document (null counts as one owner of its own), repository_col where it lies (each
    document by default). Secrets are known by their SHA-256 only, in results and in saved
    tables. Null and empty texts have no spans. Repeated rows each give a row; an empty table
    gives an empty result; other columns are ignored. Texts are scanned whole.
    """
    scanned = _scanned(docs, id_col, text_col, owner_col, repository_col)
    spans = saved(spans_of(scanned))
    found = F.array_sort(F.collect_list(F.struct("start", "rank", "kind", "end", "hash"))).alias("found")
    verdicts = _judged(spans).groupBy("row").agg(
        found, F.count_if("copied").alias("n_copied"), F.count_if(~F.col("copied")).alias("n_live"), F.max("n_owners").alias("most_owners"),
        F.max("n_repositories").alias("most_repositories"),
    )
    without = scanned.where(F.size("pieces") == 0).select("doc_id")
    joined = scanned.where(F.size("pieces") > 0).select("row", "doc_id").join(verdicts, "row", "left").drop("row")
    empty = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,hash:string>>")
    none = F.lit(0).cast("bigint")
    return joined.unionByName(without, allowMissingColumns=True).select(
        "doc_id", F.coalesce("found", empty).alias("found"), *[F.coalesce(c, none).alias(c) for c in ("n_copied", "n_live", "most_owners", "most_repositories")]
    )


def with_copied(
    docs: DataFrame, name: str, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_col: str | None = None
) -> DataFrame:
    """All documents, all columns kept, and under a new name the hashes of each text's widely copied
    examples (null if it has none), so that clean() can tell them when other documents have gone.

    Null and empty texts have none, repeated rows each stay, an empty table stays empty. Only texts
    with such an example meet the hashes; the others aren't shuffled.
    """
    scanned = _scanned(docs, id_col, text_col, owner_col, repository_col)
    held = scanned.where(F.size("pieces") > 0).select("row", "owner", "repository", F.explode(F.array_distinct(F.col("pieces.hash"))).alias("hash")).where("hash IS NOT NULL")
    # Saved, so that Spark can split a hash of very many rows where the two meet.
    copied = saved(ownership(held).where("copied").select("hash"))
    found = saved(held.join(copied, "hash").groupBy("row").agg(F.collect_set("hash").alias("hashes")))
    for table in (scanned, copied):
        discard(table)
    row, near = unused(docs, "__row"), unused(docs, "__near")
    marked = perhaps_among(docs.withColumn(row, _row(id_col, text_col, owner_col, repository_col)), row, found, "row", near)
    some = marked.where(near).join(found.select(F.col("row").alias(row), F.col("hashes").alias(name)), row, "left")
    none = marked.where(~F.col(near)).withColumn(name, F.lit(None).cast("array<string>"))
    return none.select(*docs.columns, name).unionByName(some.select(*docs.columns, name))


def _united(spans: DataFrame) -> DataFrame:
    """(row, spans): sorted spans (start, end) of each row, overlapping ones as one."""
    ordered = Window.partitionBy("row").orderBy("start", "end")
    before = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("start") < before, 0).otherwise(1)
    numbered = spans.select("row", "start", "end", opens.alias("opens")).withColumn("part", F.sum("opens").over(ordered))
    parts = numbered.groupBy("row", "part").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return parts.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def clean(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
    repository_col: str | None = None, chars_col: str | None = "n_chars", mask: str = "[REDACTED]", corpus: DataFrame | None = None,
    copied_col: str | None = None,
) -> DataFrame:
    """All documents, all columns kept, live-looking secrets masked; widely copied examples stay.

    corpus: documents, of the same columns, that count for ownership beside docs, such as those
    that docs were chosen from. copied_col: a column of with_copied(), which then decides alone and
    spares counting. chars_col, where docs has it, gets the new text's length. Null and empty texts stay as they
    are, repeated rows each stay, an empty table stays empty. Only texts with a secret to mask
    meet the spans; the others aren't shuffled.
    """
    spans = saved(spans_of(_scanned(docs, id_col, text_col, owner_col, repository_col, copied_col)))
    others = None if corpus is None else spans_of(_scanned(corpus, id_col, text_col, owner_col, repository_col))
    live = saved(_united(spans if copied_col else _judged(spans, others).where(~F.col("copied"))))
    discard(spans)
    row, near, found = (unused(docs, n) for n in ("__row", "__near", "__spans"))
    marked = perhaps_among(docs.withColumn(row, _row(id_col, text_col, owner_col, repository_col)), row, live, "row", near)
    joined = marked.where(near).join(live.select(F.col("row").alias(row), F.col("spans").alias(found)), row, "left")
    blocks = unused(docs, "__blocks")
    joined = joined.withColumn(blocks, F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(f"(?s).{{1,{_CUT}}}"), F.lit(0)))
    result = joined.withColumn(text_col, masked(F.col(text_col).cast("string"), F.col(blocks), F.col(found), mask))
    if chars_col in docs.columns:
        length = F.length(text_col).cast(docs.schema[chars_col].dataType)
        result = result.withColumn(chars_col, F.when(F.col(found).isNotNull(), length).otherwise(F.col(chars_col)))
    return marked.where(~F.col(near)).select(*docs.columns).unionByName(result.select(*docs.columns))


def masked(text: Column, blocks: Column, spans: Column, mask: str) -> Column:
    """Text with sorted, separate spans (start, end) replaced by a mask; without spans it stays.

    blocks are the text cut every _CUT characters, so that each part is taken from the blocks
    it lies in and not by counting from the text's start.
    """
    # From the text's start to the first mask, ..., from the last on.
    begins = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(text)))

    def part(g: Column) -> Column:
        first, last = (F.floor(g[x] / _CUT).cast("int") for x in "ab")
        # Two mentions of the blocks: what is mentioned once Spark would compute anew for each part.
        within = F.when(first == last, F.get(blocks, first)).otherwise(F.array_join(F.slice(blocks, first + 1, last - first + 1), ""))
        return F.coalesce(within.substr(g["a"] - first * _CUT + 1, g["b"] - g["a"]), F.lit(""))

    parts = F.transform(F.arrays_zip(begins.alias("a"), ends.alias("b")), part)
    return F.when(F.size(spans) > 0, F.array_join(parts, mask)).otherwise(text)


def joined_spans(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")


def digest(result: DataFrame) -> DataFrame:
    """The counts and digests of a scan's rows."""
    base = F.filter("found", lambda s: s["kind"].isin(*BASE))
    counts = [_count(k).alias(f"n_{k}") for k in BASE]
    return result.select(
        "doc_id", *counts, F.sha2(joined_spans(base), 256).alias("base_sha256"),
        joined_spans(F.col("found")).alias("spans"), "n_copied", "n_live", "most_owners", "most_repositories",
    )
