"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.llm.common import staged, text_of

#: The base patterns. Group 2 of ``assign`` is its value. The lengths in
#: ``access`` and ``hex`` keep what a scan without them, followed by the length test, keeps.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6
#: Candidates that only the corpus can judge: runs that mix cases and digits.
OPAQUE = r"[A-Za-z0-9_]{20,}"
KINDS = ("assign", "access", "hex", "owned")

SPAN = "struct<start:int,kind:int,end:int,value:string>"


def spans_of(text: Column, pattern: str, kind: int) -> Column:
    """Non-overlapping matches as structs (start, kind, end, value), in code points, end exclusive.

    The text between matches and the matches themselves take turns, so a running sum of
    their lengths gives the places. The value is the match, in ``assign`` its second group.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.length(pair["hit"])
        got = F.regexp_extract(pair["hit"], ASSIGN, 2) if kind == 0 else pair["hit"]
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), got.alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    none = F.array().cast(f"array<{SPAN}>")
    pairs = F.transform(hits, lambda h, i: F.struct(h.alias("hit"), F.get(gaps, i).alias("gap")))
    begin = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    return F.when(F.size(hits) > 0, F.aggregate(pairs, begin, step)["spans"]).otherwise(none)


def candidates(docs: DataFrame, key: str, text: str, owner: str, repo: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row: key, owner, repo, ``base`` spans and ``opaque`` spans that overlap none of them."""
    t = F.col("_t")
    rows = docs.select(
        F.col(key).alias("_key"), F.col(owner).cast("string").alias("_owner"), F.col(repo).cast("string").alias("_repo"), text_of(text).alias("_t"), *keep
    )
    rows = rows.select(
        "_key", "_owner", "_repo", *keep,
        F.filter(spans_of(t, ASSIGN, 0), lambda s: F.length(s["value"]) >= LEAST_VALUE).alias("_assign"),
        spans_of(t, ACCESS, 1).alias("_access"), spans_of(t, HEX, 2).alias("_hex"),
        F.filter(spans_of(t, OPAQUE, 3), lambda s: _mixed(s["value"])).alias("_opaque"),
    )
    base = F.array_sort(F.concat("_assign", "_access", "_hex"))
    rows = rows.withColumn("_base", base)
    clear = F.filter("_opaque", lambda o: ~F.exists("_base", lambda b: (b["start"] < o["end"]) & (o["start"] < b["end"])))
    return rows.withColumn("_opaque", clear)


def _mixed(value: Column) -> Column:
    """Upper case, lower case, at least two digits and ten different characters."""
    return (
        value.rlike("[A-Z]") & value.rlike("[a-z]") & value.rlike("[0-9].*[0-9]")
        & (F.size(F.array_distinct(F.split(value, ""))) >= 10)
    )


def ownership(hits: DataFrame) -> DataFrame:
    """``(hash, n_owners, n_repos)`` of candidate hashes over the corpus.

    ``hits`` has the columns hash, owner and repo. Distinct pairs come first, each step with
    partial aggregation, so a hash that a third of all documents hold is spread by owner and
    repository before it meets in one row. A null owner or repository counts as one of its own.
    """
    pairs = hits.groupBy("hash", "owner", "repo").agg(F.count(F.lit(1)).alias("n"))
    owners = pairs.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repos"))
    return owners.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("repos").alias("n_repos"))


@dataclass(frozen=True)
class Scan:
    """``rows``: per document row its id ``_rid``, key, and base spans; ``judged``: per hit
    ``_rid``, span, whether it is in the base, n_owners and n_repos."""

    rows: DataFrame
    judged: DataFrame


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source", repo: str = "doc_id", keep: tuple[str, ...] = ()) -> Scan:
    """Scan whole texts once, keep the spans, and judge their values by who owns them.

    A null text is empty; repeated rows are scanned each and told apart by a row number fixed
    in a written table. Input columns' names don't matter: only the named ones are read.
    """
    found = candidates(docs, key, text, owner, repo, keep).withColumn("_rid", F.monotonically_increasing_id())
    found = staged(found.select("_rid", "_key", "_owner", "_repo", "_base", "_opaque", *keep), "secrets")
    hits = found.where((F.size("_base") > 0) | (F.size("_opaque") > 0)).select(
        "_rid", F.col("_owner").alias("owner"), F.col("_repo").alias("repo"), F.explode(F.concat("_base", "_opaque")).alias("span")
    )
    hits = hits.withColumn("hash", F.sha2(F.col("span.value"), 256))
    owned = staged(ownership(hits), "secrets-owned")
    judged = hits.join(owned, "hash").select("_rid", "span", (F.col("span.kind") < 3).alias("base"), "n_owners", "n_repos")
    return Scan(found, judged)


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source", repo: str = "doc_id", wide: int = 3, out: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: base counts and digest, all spans, and how the corpus judges them.

    Base spans are always reported. An opaque run is reported as ``owned`` if one owner only
    has its value. ``n_live`` counts the spans whose value fewer than ``wide`` owners have,
    ``n_examples`` the base spans whose value is copied more widely. No spans: empty strings.
    """
    got = scan(docs, key, text, owner, repo)
    added = got.judged.groupBy("_rid").agg(
        F.collect_list(F.when(~F.col("base") & (F.col("n_owners") == 1), F.col("span"))).alias("_more"),
        F.count(F.when(F.col("base") & (F.col("n_owners") >= wide), 1)).alias("_examples"),
        F.count(F.when(F.col("base") & (F.col("n_owners") < wide), 1)).alias("_live"),
    )
    kind = lambda k: F.size(F.filter("_base", lambda s: s["kind"] == k)).cast("bigint")
    none = F.array().cast(f"array<{SPAN}>")
    more = F.coalesce("_more", none)
    rows = got.rows.join(added, "_rid", "left")
    return rows.select(
        F.col("_key").alias(out), kind(0).alias("n_assign"), kind(1).alias("n_access"), kind(2).alias("n_hex"),
        F.sha2(spans_text(F.col("_base")), 256).alias("base_sha256"), spans_text(F.array_sort(F.concat("_base", more))).alias("spans"),
        F.coalesce("_examples", F.lit(0)).alias("n_examples"), (F.coalesce("_live", F.lit(0)) + F.size(more)).alias("n_live"),
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with each (start, end, mark) of sorted spans replaced by its mark; overlapping
    spans count as one, with the first one's mark."""
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        parts = F.when(
            fresh, F.concat(acc["parts"], F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), s["mark"]))
        ).otherwise(acc["parts"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), parts.alias("parts"))

    done = F.aggregate(spans, begin, step)
    rest = F.substring(text, done["at"] + 1, F.length(text))
    return F.concat(F.array_join(done["parts"], ""), rest)


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source", repo: str = "doc_id", wide: int = 3) -> DataFrame:
    """The documents with every span replaced: ``<SECRET>``, or ``<EXAMPLE>`` where ``wide`` owners or
    more have the value. Rows without spans stay as they are; no row is dropped.

    Spans are joined to their texts by key and text digest, so repeated keys do no harm.
    """
    digest = F.md5(text_of(text))
    got = scan(docs.withColumn("_md5", digest), key, text, owner, repo, ("_md5",))
    taken = got.judged.where(F.col("base") | (F.col("n_owners") == 1)).select(
        "_rid", F.struct(F.col("span.start").alias("start"), F.col("span.end").alias("end"), F.when(F.col("n_owners") >= wide, "<EXAMPLE>").otherwise("<SECRET>").alias("mark")).alias("span")
    )
    spans = taken.groupBy("_rid").agg(F.array_sort(F.collect_list("span")).alias("_spans"))
    spans = got.rows.join(spans, "_rid").groupBy(F.col("_key").alias("_k"), F.col("_md5").alias("_m")).agg(F.first("_spans").alias("_spans"))
    spans = staged(spans, "secrets-spans")
    rows = docs.withColumn("_md5", digest)
    rows = rows.join(spans, rows[key].eqNullSafe(spans["_k"]) & (rows["_md5"] == spans["_m"]), "left")
    new = F.when(F.col("_spans").isNull(), F.col(text)).otherwise(redacted(F.col(text), F.col("_spans")))
    return rows.select(*[new.alias(c) if c == text else F.col(c) for c in docs.columns])
