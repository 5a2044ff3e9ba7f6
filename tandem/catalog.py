"""Registered queries: one Spark builder per operator, with a DuckDB oracle where exact.

Every builder takes ``(spark, sf_dir)``, reads the driver tables (or data Spark derives
from them) in full, and returns a DataFrame. ``ORACLES[name]`` is the same computation
in DuckDB SQL over the pre-registered views; builders without an oracle are checked on
row counts and by the unit tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem import oracle_sql as S
from tandem.functions.text import n_bytes, n_words, sanitize
from tandem.operators import align, checks, filters, position, setops, split, unigram
from tandem.session import read_table
from tandem.sources import collections as coll
from tandem.sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


SEED = 42
N_VALID_SMALL = 10  # the flagship split's validation size
N_VALID = 1000  # validation pairs, as the training driver asks for
CORPUS_SAMPLE = 5000  # sentence sample for vocabulary learning (test profile)
VOCAB_SIZE = 50000
MAX_BYTES = 8192
MAX_LEN = 5000
GAP = 10000  # id range width for batch reports over conversation ids
EXPORT_SHARD = 100000  # ids per aligned shard file


# ---- flagship: keyed collections -> join -> clean -> permute -> exact split ----------


def extract_split(spark: SparkSession, sf_dir: str, n_valid: int = N_VALID_SMALL) -> DataFrame:
    c = fx.conversation_collections(spark, sf_dir)
    joined = align.align_collections(c, ["user", "assistant"])
    kept = filters.complete_rows(joined, ["user", "assistant"]).select(
        "id", F.col("user").alias("src"), F.col("assistant").alias("tgt")
    )
    return split.train_valid_split(kept, n_valid, seed=SEED).select("id", "src", "tgt", "split", "pos")


def _split_sql(inner: str, n_valid: int, id_expr: str = "id") -> str:
    return f"""SELECT *, CASE WHEN pos < {n_valid} THEN 'valid' ELSE 'train' END AS split FROM (
  SELECT *, CAST(row_number() OVER (ORDER BY {S.perm_key(SEED, id_expr)}, {id_expr}) - 1 AS BIGINT) AS pos
  FROM {inner})"""


KEPT_SQL = f"""(SELECT id, src, tgt FROM (
  SELECT u.id, {S.sanitize('u.text')} AS src, {S.sanitize('a.text')} AS tgt
  FROM {fx.USER_SQL} u JOIN {fx.ASSISTANT_SQL} a ON a.id = u.id)
  WHERE src <> '' AND tgt <> '')"""

register("extract_split", _split_sql(KEPT_SQL, N_VALID_SMALL))(extract_split)


# ---- sources --------------------------------------------------------------------------


@register("scan_collection", "SELECT doc_id AS id, text FROM documents WHERE lang = 'en'")
def scan_collection(spark, sf_dir):
    return coll.collection_of(read_table(spark, sf_dir, "documents"), "en", id_col="doc_id")


@register("scan_wide", f'SELECT id, "user", assistant FROM {fx.WIDE_SQL}')
def scan_wide(spark, sf_dir):
    return fx.wide_collection(spark, sf_dir).select("id", "user", "assistant")


@register("line_scan", f"SELECT doc_id, line_no, line FROM {fx.DOC_LINES_SQL}")
def line_scan(spark, sf_dir):
    return fx.document_lines(spark, sf_dir)


@register("list_languages", "SELECT lang AS code, count(*) AS n_rows FROM documents GROUP BY lang")
def list_languages(spark, sf_dir):
    return coll.list_languages(read_table(spark, sf_dir, "documents"))


def _dim_values_sql() -> str:
    rows = []
    for code, en, native, _ in coll.LANGUAGES:
        rows.append(f"({S.q(code)}, 'en', {S.q(en)})")
        rows.append(f"({S.q(code)}, 'native', {S.q(native)})")
    return "(VALUES " + ", ".join(rows) + ") AS dim(code, display_lang, name)"


@register(
    "language_dim",
    f"""SELECT c.code, d.display_lang, d.name
FROM (SELECT DISTINCT lang AS code FROM documents) c LEFT JOIN {_dim_values_sql()} ON d.code = c.code""".replace(
        "AS dim(", "AS d("
    ),
)
def language_dim(spark, sf_dir):
    codes = read_table(spark, sf_dir, "documents").select(F.col("lang").alias("code")).distinct()
    names = coll.unpivot_names(coll.language_dim(spark))
    return codes.join(F.broadcast(names), on="code", how="left").select("code", "display_lang", "name")


@register(
    "language_names",
    f"""SELECT c.code, c.n_docs, d.name FROM (SELECT lang AS code, count(*) AS n_docs FROM documents GROUP BY lang) c
LEFT JOIN (SELECT * FROM {_dim_values_sql().replace('AS dim(', 'AS d(')} WHERE display_lang = 'en') d ON d.code = c.code""",
)
def language_names(spark, sf_dir):
    counts = coll.list_languages(read_table(spark, sf_dir, "documents")).withColumnRenamed("n_rows", "n_docs")
    names = coll.unpivot_names(coll.language_dim(spark)).where(F.col("display_lang") == "en")
    return counts.join(F.broadcast(names.select("code", "name")), on="code", how="left").select("code", "n_docs", "name")


@register(
    "unknown_codes",
    f"""SELECT lang AS code, count(*) AS n_rows FROM documents
WHERE lang IS NULL OR lang NOT IN ({", ".join(S.q(c[0]) for c in coll.LANGUAGES if c[0] != "de")}) GROUP BY lang""",
)
def unknown_codes(spark, sf_dir):
    """Codes that a language table lacks, with their rows: here the shipped table without its German row."""
    known = coll.language_dim(spark).where(F.col("code") != "de").select("code")
    codes = coll.list_languages(read_table(spark, sf_dir, "documents"))
    return codes.join(F.broadcast(known), on="code", how="left_anti").select("code", "n_rows")


# ---- filters and projections ----------------------------------------------------------

# One half-open id batch over orders: the middle half of the key span, read from the
# data (one min/max row, as the exporter reads its id bounds) and applied as literals
# so the range reaches the Parquet scan.
RANGE_SQL = """(SELECT mn + (mx - mn) // 4 AS lo, mn + 3 * (mx - mn) // 4 AS hi
  FROM (SELECT min(o_orderkey) AS mn, max(o_orderkey) AS mx FROM orders))"""


def _order_range(spark, sf_dir) -> tuple[int, int]:
    b = checks.id_bounds(read_table(spark, sf_dir, "orders"), "o_orderkey").first()
    span = b.max_id - b.min_id
    return b.min_id + span // 4, b.min_id + 3 * span // 4


@register(
    "id_range_filter",
    f"""SELECT o_orderkey, o_custkey, o_totalprice FROM orders, {RANGE_SQL} r
WHERE o_orderkey >= r.lo AND o_orderkey < r.hi""",
)
def id_range_filter(spark, sf_dir):
    lo, hi = _order_range(spark, sf_dir)
    o = read_table(spark, sf_dir, "orders")
    return filters.id_range(o, lo, hi, "o_orderkey").select("o_orderkey", "o_custkey", "o_totalprice")


@register(
    "count_in_range",
    f"SELECT count(*) AS n_rows FROM orders, {RANGE_SQL} r WHERE o_orderkey >= r.lo AND o_orderkey < r.hi",
)
def count_in_range(spark, sf_dir):
    lo, hi = _order_range(spark, sf_dir)
    return checks.count_rows(filters.id_range(read_table(spark, sf_dir, "orders"), lo, hi, "o_orderkey"))


@register("count_all", "SELECT count(*) AS n_rows FROM documents")
def count_all(spark, sf_dir):
    return checks.count_rows(read_table(spark, sf_dir, "documents"))


@register("id_bounds", f"SELECT min(id) AS min_id, max(id) AS max_id FROM {fx.USER_SQL}")
def id_bounds(spark, sf_dir):
    return checks.id_bounds(fx.conversation_collections(spark, sf_dir)["user"])


@register(
    "first_last",
    """SELECT min(doc_id) AS first_id, arg_min(text, doc_id) AS first_value,
  max(doc_id) AS last_id, arg_max(text, doc_id) AS last_value FROM documents""",
)
def first_last(spark, sf_dir):
    return checks.first_last(read_table(spark, sf_dir, "documents"), "doc_id", "text")


@register(
    "project_rename",
    f"SELECT u.text AS src, a.text AS tgt FROM {fx.USER_SQL} u JOIN {fx.ASSISTANT_SQL} a ON a.id = u.id",
)
def project_rename(spark, sf_dir):
    joined = align.align_collections(fx.conversation_collections(spark, sf_dir), ["user", "assistant"])
    return filters.project_rename(joined, {"id": "id", "user": "src", "assistant": "tgt"})


@register(
    "complete_rows",
    f"""SELECT id, "user", assistant FROM (
  SELECT id, {S.sanitize('"user"')} AS "user", {S.sanitize('assistant')} AS assistant FROM {fx.WIDE_SQL})
WHERE "user" IS NOT NULL AND "user" <> '' AND assistant IS NOT NULL AND assistant <> ''""",
)
def complete_rows(spark, sf_dir):
    return filters.complete_rows(fx.wide_collection(spark, sf_dir), ["user", "assistant"])


@register(
    "complete_rows_raw",
    f"""SELECT id, {S.sanitize('"user"')} AS "user", {S.sanitize('assistant')} AS assistant FROM {fx.WIDE_SQL}
WHERE "user" IS NOT NULL AND "user" <> '' AND assistant IS NOT NULL AND assistant <> ''""",
)
def complete_rows_raw(spark, sf_dir):
    return filters.complete_rows(fx.wide_collection(spark, sf_dir), ["user", "assistant"], drop_when="raw")


@register(
    "drop_blank_pairs",
    f"SELECT * FROM {fx.LINE_PAIRS_SQL} WHERE NOT {S.is_blank('src')} AND NOT {S.is_blank('tgt')}",
)
def drop_blank_pairs(spark, sf_dir):
    return filters.drop_blank_pairs(fx.line_pairs(spark, sf_dir))


@register(
    "skip_empty",
    f"SELECT * FROM {fx.LINE_PAIRS_REPORT_SQL} WHERE NOT {S.is_blank('src')} AND NOT {S.is_blank('tgt')}",
)
def skip_empty(spark, sf_dir):
    return filters.skip_empty(fx.line_pairs(spark, sf_dir, mode="report"), level="silent")


@register(
    "filter_too_long",
    f"""SELECT id, n_src, n_tgt FROM (SELECT id, {S.n_words('src')} AS n_src, {S.n_words('tgt')} AS n_tgt FROM {fx.DOC_PAIRS_SQL})
WHERE n_src <= {MAX_LEN} AND n_tgt <= {MAX_LEN}""",
)
def filter_too_long(spark, sf_dir):
    pairs = fx.document_pairs(spark, sf_dir)
    return filters.filter_too_long(pairs, MAX_LEN).select(
        "id", n_words("src").alias("n_src"), n_words("tgt").alias("n_tgt")
    )


@register(
    "max_sentence_bytes",
    f"""SELECT doc_id, n_bytes FROM (SELECT doc_id, CAST(strlen({S.sanitize('text')}) AS BIGINT) AS n_bytes FROM documents)
WHERE n_bytes <= {MAX_BYTES}""",
)
def max_sentence_bytes(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", sanitize("text").alias("text"))
    return filters.max_sentence_bytes(docs, "text", MAX_BYTES).select("doc_id", n_bytes("text").alias("n_bytes"))


@register("reverse_pairs", f"SELECT id, tgt AS src, src AS tgt FROM {fx.BITEXT_SQL}")
def reverse_pairs(spark, sf_dir):
    return filters.reverse_pairs(fx.bitext(spark, sf_dir))


@register("sanitize", f"SELECT doc_id, {S.sanitize('text')} AS clean FROM documents")
def sanitize_q(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("doc_id", sanitize("text").alias("clean"))


@register("sanitize_compat", f"SELECT doc_id, {S.sanitize('text', 'compat')} AS clean FROM documents")
def sanitize_compat(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("doc_id", sanitize("text", "compat").alias("clean"))


# ---- joins ----------------------------------------------------------------------------


@register(
    "align_two_way",
    f'SELECT u.id, u.text AS "user", a.text AS assistant FROM {fx.USER_SQL} u JOIN {fx.ASSISTANT_SQL} a ON a.id = u.id',
)
def align_two_way(spark, sf_dir):
    return align.align_collections(fx.conversation_collections(spark, sf_dir), ["user", "assistant"])


@register(
    "align_n_way",
    """SELECT d.doc_id AS id, d.text AS doc, p.html AS page, b.text AS bench
FROM documents d JOIN pages p ON p.page_id = d.doc_id JOIN benchmark b ON b.item_id = d.doc_id""",
)
def align_n_way(spark, sf_dir):
    cols = {
        "doc": coll.collection_of(read_table(spark, sf_dir, "documents"), id_col="doc_id"),
        "page": coll.collection_of(read_table(spark, sf_dir, "pages"), id_col="page_id", text_col="html"),
        "bench": coll.collection_of(read_table(spark, sf_dir, "benchmark"), id_col="item_id"),
    }
    return align.align_collections(cols, ["doc", "page", "bench"])


@register(
    "lookup_array",
    """SELECT o.o_orderkey, CAST(count(l.l_linenumber) AS BIGINT) AS n_matches,
  coalesce(string_agg(CAST(l.l_linenumber AS VARCHAR), ',' ORDER BY l.l_linenumber), '') AS linenumbers
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey""",
)
def lookup_array(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    looked = align.lookup_array(o, li, "o_orderkey", "l_orderkey", "items")
    nums = F.array_sort(F.transform("items", lambda x: x["l_linenumber"]))
    return looked.select(
        "o_orderkey",
        F.size("items").cast("bigint").alias("n_matches"),
        F.array_join(F.transform(nums, lambda x: x.cast("string")), ",").alias("linenumbers"),
    )


@register(
    "unwind",
    """SELECT o.o_orderkey, l.l_linenumber, l.l_quantity FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey""",
)
def unwind(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return align.lookup_unwind(o, li, "o_orderkey", "l_orderkey").select("o_orderkey", "l_linenumber", "l_quantity")


@register("zip_lines", f"SELECT * FROM {fx.LINE_PAIRS_SQL}")
def zip_lines(spark, sf_dir):
    return fx.line_pairs(spark, sf_dir)


@register("zip_lines_strict", f"SELECT id // 1000 AS dataset, id % 1000 AS line_no, src, tgt FROM {fx.BITEXT_SQL}")
def zip_lines_strict(spark, sf_dir):
    """The strict zip over sides that match line by line: a surplus line would fail the job."""
    pairs = fx.bitext(spark, sf_dir)
    at = [F.floor(F.col("id") / 1000).alias("dataset"), (F.col("id") % 1000).alias("line_no")]
    src, tgt = (pairs.select(*at, F.col(c).alias("line")) for c in ("src", "tgt"))
    return align.zip_lines(src, tgt, mode="strict")


# ---- aggregations and checks ----------------------------------------------------------


@register(
    "bucket_counts",
    f"""WITH r AS (SELECT id FROM {fx.USER_SQL}), m AS (SELECT min(id) AS m FROM r),
k AS (SELECT id FROM {KEPT_SQL}),
rb AS (SELECT CAST(floor((id - m) / {GAP}) AS BIGINT) AS bucket, count(*) AS rows_read FROM r, m GROUP BY 1),
kb AS (SELECT CAST(floor((id - m) / {GAP}) AS BIGINT) AS bucket, count(*) AS rows_kept FROM k, m GROUP BY 1)
SELECT coalesce(rb.bucket, kb.bucket) AS bucket, CAST((SELECT m FROM m) + coalesce(rb.bucket, kb.bucket) * {GAP} AS BIGINT) AS range_start,
  coalesce(rows_read, 0) AS rows_read, coalesce(rows_kept, 0) AS rows_kept
FROM rb FULL OUTER JOIN kb ON rb.bucket = kb.bucket""",
)
def bucket_counts(spark, sf_dir):
    c = fx.conversation_collections(spark, sf_dir)
    read = c["user"]
    kept = filters.complete_rows(align.align_collections(c, ["user", "assistant"]), ["user", "assistant"])
    start = read.select(F.min("id")).scalar()
    return checks.bucket_counts(read, kept, start, GAP)


RANGE_GAP = 1000  # one conversation per range: those without a user turn are empty


@register(
    "range_report",
    f"""WITH r AS (SELECT id FROM {fx.USER_SQL}), m AS (SELECT min(id) AS lo, max(id) AS hi FROM r),
s AS (SELECT unnest(range(0, (hi - lo) // {RANGE_GAP} + 1)) AS bucket, lo, hi FROM m),
k AS (SELECT id FROM {KEPT_SQL})
SELECT bucket, lo + bucket * {RANGE_GAP} AS range_start, least(lo + (bucket + 1) * {RANGE_GAP}, hi + 1) AS range_end,
  (SELECT count(*) FROM r WHERE r.id >= lo + bucket * {RANGE_GAP} AND r.id < least(lo + (bucket + 1) * {RANGE_GAP}, hi + 1)) AS rows_read,
  (SELECT count(*) FROM k WHERE k.id >= lo + bucket * {RANGE_GAP} AND k.id < least(lo + (bucket + 1) * {RANGE_GAP}, hi + 1)) AS rows_kept
FROM s""",
)
def range_report(spark, sf_dir):
    """Every id range of the export with its clipped end, empty ranges too."""
    c = fx.conversation_collections(spark, sf_dir)
    kept = filters.complete_rows(align.align_collections(c, ["user", "assistant"]), ["user", "assistant"])
    return checks.range_report(c["user"], kept, RANGE_GAP)


@register(
    "export_report",
    f"""SELECT rows_in, rows_joined, rows_kept, rows_in - rows_joined AS dropped_no_partner, rows_joined - rows_kept AS dropped_empty
FROM (SELECT count(*) AS rows_in,
  CAST(coalesce(sum(CASE WHEN assistant IS NOT NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS rows_joined,
  CAST(coalesce(sum(CASE WHEN assistant IS NOT NULL AND "user" IS NOT NULL AND {S.sanitize('"user"')} <> '' AND {S.sanitize('assistant')} <> '' THEN 1 ELSE 0 END), 0) AS BIGINT) AS rows_kept
FROM {fx.WIDE_SQL})""",
)
def export_report(spark, sf_dir):
    return checks.export_report(fx.wide_collection(spark, sf_dir), ["user", "assistant"])


@register(
    "line_stats",
    f"""SELECT doc_id, count(*) AS n_lines, arg_max(line, line_no) AS last_line, CAST(sum(strlen(line) + 1) AS BIGINT) AS n_bytes
FROM {fx.DOC_LINES_SQL} GROUP BY doc_id""",
)
def line_stats(spark, sf_dir):
    from tandem.sources.lines import line_stats as ls

    return ls(fx.document_lines(spark, sf_dir), ["doc_id"])


def _n(cond: str) -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


_sb, _tb = S.is_blank("src"), S.is_blank("tgt")


@register(
    "alignment_report",
    f"""SELECT *, (src_surplus = 0 AND tgt_surplus = 0 AND src_only_blank = 0 AND tgt_only_blank = 0) AS aligned FROM (
SELECT dataset, {_n('src IS NOT NULL')} AS src_lines, {_n('tgt IS NOT NULL')} AS tgt_lines,
  {_n(f'src IS NOT NULL AND NOT {_sb}')} AS src_nonblank, {_n(f'tgt IS NOT NULL AND NOT {_tb}')} AS tgt_nonblank,
  {_n(f'src IS NOT NULL AND tgt IS NOT NULL AND {_sb} AND NOT {_tb}')} AS src_only_blank,
  {_n(f'src IS NOT NULL AND tgt IS NOT NULL AND {_tb} AND NOT {_sb}')} AS tgt_only_blank,
  {_n('src IS NOT NULL AND tgt IS NULL')} AS src_surplus, {_n('tgt IS NOT NULL AND src IS NULL')} AS tgt_surplus
FROM {fx.LINE_PAIRS_REPORT_SQL} GROUP BY dataset)""",
)
def alignment_report(spark, sf_dir):
    return checks.alignment_report(fx.line_pairs(spark, sf_dir, mode="report"))


PAIR_ID = "dataset * 1000000 + line_no"


@register(
    "dedup_pairs",
    f"""SELECT min({PAIR_ID}) AS id, src, tgt FROM {fx.LINE_PAIRS_SQL} GROUP BY src, tgt""",
)
def dedup_pairs(spark, sf_dir):
    p = fx.line_pairs(spark, sf_dir).select(F.expr(PAIR_ID).alias("id"), "src", "tgt")
    return checks.dedup_pairs(p, key="pair")


# ---- positions, order, top-k, splits -------------------------------------------------


@register(
    "global_position",
    f"""SELECT doc_id, line_no, CAST(row_number() OVER (ORDER BY doc_id, line_no) - 1 AS BIGINT) AS pos
FROM {fx.DOC_LINES_SQL} WHERE NOT {S.is_blank('line')}""",
)
def global_position(spark, sf_dir):
    lines = filters.drop_blank_pairs(fx.document_lines(spark, sf_dir), ["line"])
    out = position.global_position(
        lines,
        [F.col("doc_id"), F.col("line_no")],
        position.line_bucket(["doc_id"]),
        super_bucket=position.line_super_bucket(["doc_id"]),
    )
    return out.select("doc_id", "line_no", "pos")


@register(
    "latest_n",
    """SELECT user_id, event_id, ts, rank FROM (
  SELECT user_id, event_id, ts, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS BIGINT) AS rank
  FROM events) WHERE rank <= 3""",
)
def latest_n(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    return position.latest_n(ev, ["user_id"], ["ts", "event_id"], 3)


@register(
    "sorted_export",
    f"""SELECT id, CAST(row_number() OVER (ORDER BY id) - 1 AS BIGINT) AS pos, "user", assistant FROM (
  SELECT id, {S.sanitize('"user"')} AS "user", {S.sanitize('assistant')} AS assistant FROM {fx.WIDE_SQL})
WHERE "user" IS NOT NULL AND "user" <> '' AND assistant IS NOT NULL AND assistant <> ''""",
)
def sorted_export(spark, sf_dir):
    kept = filters.complete_rows(fx.wide_collection(spark, sf_dir), ["user", "assistant"])
    return position.position_by_id(kept, "id", GAP).select("id", "pos", "user", "assistant")


@register(
    "permute_pairs",
    f"SELECT id, CAST(row_number() OVER (ORDER BY {S.perm_key(SEED, 'id')}, id) - 1 AS BIGINT) AS pos, src, tgt FROM {fx.BITEXT_SQL}",
)
def permute_pairs(spark, sf_dir):
    return position.permute(fx.bitext(spark, sf_dir), seed=SEED).select("id", "pos", "src", "tgt")


@register(
    "sort_by_embedded_number",
    """SELECT page_id, url, num, CAST(row_number() OVER (ORDER BY num NULLS FIRST, page_id) - 1 AS BIGINT) AS pos
FROM (SELECT page_id, url, TRY_CAST(nullif(regexp_extract(url, '([0-9]+)', 1), '') AS BIGINT) AS num FROM pages)""",
)
def sort_by_embedded_number(spark, sf_dir):
    from tandem.functions.text import first_number

    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", first_number("url").alias("num"))
    out = position.ranked(pages, [F.col("num").asc_nulls_first(), F.col("page_id")])
    return out.select("page_id", "url", "num", "pos")


@register(
    "cap_lines",
    f"""SELECT doc_id, line_no, pos FROM (
  SELECT doc_id, line_no, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS BIGINT) AS pos
  FROM {fx.DOC_LINES_SQL} WHERE NOT {S.is_blank('line')}) WHERE pos < 5""",
)
def cap_lines(spark, sf_dir):
    lines = filters.drop_blank_pairs(fx.document_lines(spark, sf_dir), ["line"])
    out = position.cap_per_group(lines, "doc_id", [F.col("line_no")], F.floor(F.col("line_no") / 4096), 5)
    return out.select("doc_id", "line_no", "pos")


CLEAN_PAIRS_SQL = f"(SELECT {PAIR_ID} AS id, src, tgt FROM {fx.LINE_PAIRS_SQL} WHERE NOT {_sb} AND NOT {_tb})"


def clean_line_pairs(spark, sf_dir) -> DataFrame:
    p = filters.drop_blank_pairs(fx.line_pairs(spark, sf_dir))
    return p.select(F.expr(PAIR_ID).alias("id"), "src", "tgt")


@register("train_valid_split", f"SELECT id, pos, split FROM ({_split_sql(CLEAN_PAIRS_SQL, N_VALID)})")
def train_valid_split(spark, sf_dir):
    return split.train_valid_split(clean_line_pairs(spark, sf_dir), N_VALID, seed=SEED).select("id", "pos", "split")


# a vocabulary needs no alignment: every sentence of either side, also one without a counterpart
SHARED_SQL = f"""(SELECT id * 2 + side_no AS sid, side, text FROM (
  SELECT {PAIR_ID} AS id, 0 AS side_no, 'src' AS side, src AS text FROM {fx.LINE_PAIRS_REPORT_SQL} WHERE NOT {_sb}
  UNION ALL SELECT {PAIR_ID} AS id, 1 AS side_no, 'tgt' AS side, tgt AS text FROM {fx.LINE_PAIRS_REPORT_SQL} WHERE NOT {_tb}))"""


def shared_clean(spark, sf_dir) -> DataFrame:
    pairs = fx.line_pairs(spark, sf_dir, mode="report").select(F.expr(PAIR_ID).alias("id"), "src", "tgt")
    s = filters.drop_blank_pairs(setops.shared_sentences(pairs), ["text"])
    return s.select(
        (F.col("id") * 2 + F.when(F.col("side") == "tgt", 1).otherwise(0)).alias("sid"), "side", "text"
    )


@register("shared_sentences", f"SELECT sid, side, text FROM {SHARED_SQL}")
def shared_sentences(spark, sf_dir):
    return shared_clean(spark, sf_dir)


@register(
    "sample_sentences",
    f"""SELECT sid, text, pos FROM (
  SELECT sid, text, CAST(row_number() OVER (ORDER BY {S.perm_key(SEED, 'sid')}, sid) - 1 AS BIGINT) AS pos
  FROM {SHARED_SQL} WHERE strlen(text) <= {MAX_BYTES}) WHERE pos < {CORPUS_SAMPLE}""",
)
def sample_sentences(spark, sf_dir):
    s = filters.max_sentence_bytes(shared_clean(spark, sf_dir), "text", MAX_BYTES)
    return split.sample_rows(s, CORPUS_SAMPLE, id_col="sid", seed=SEED).select("sid", "text", "pos")


@register(
    "concat_datasets",
    f"""SELECT dataset, key, line_no, CAST(row_number() OVER (ORDER BY dataset, key, line_no) - 1 AS BIGINT) AS pos FROM (
  SELECT 'benchmark' AS dataset, item_id AS key, line_no FROM (
    SELECT item_id, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS line_no,
           unnest(string_split(text, chr(10))) AS line, len(string_split(text, chr(10))) AS n FROM benchmark WHERE text IS NOT NULL)
    WHERE NOT (line_no = n - 1 AND line = '')
  UNION ALL SELECT 'documents' AS dataset, doc_id AS key, line_no FROM {fx.DOC_LINES_SQL})""",
)
def concat_datasets(spark, sf_dir):
    from tandem.sources.lines import split_lines

    docs = fx.document_lines(spark, sf_dir).select(F.col("doc_id").alias("key"), "line_no")
    bench = split_lines(read_table(spark, sf_dir, "benchmark"), "text", ["item_id"]).select(
        F.col("item_id").alias("key"), "line_no"
    )
    u = setops.concat_datasets({"documents": docs, "benchmark": bench})
    out = position.global_position(
        u,
        [F.col("dataset"), F.col("key"), F.col("line_no")],
        position.line_bucket(["dataset", "key"]),
        super_bucket=position.line_super_bucket(["dataset", "key"]),
    )
    return out.select("dataset", "key", "line_no", "pos")


def entry_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_split(spark, sf_dir)


# ---- vectors, metric, manifest ---------------------------------------------------------


@register(
    "vector_mean",
    """SELECT label, CAST(i - 1 AS BIGINT) AS dim, round(avg(CAST(v AS DOUBLE)), 6) AS mean FROM (
  SELECT label, unnest(embedding) AS v, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)
GROUP BY label, i""",
)
def vector_mean(spark, sf_dir):
    from tandem.operators.vectors import explode_chunks
    from tandem.operators.vectors import vector_mean as vm

    emb = read_table(spark, sf_dir, "embeddings").select(
        F.col("label").alias("grp"), F.lit("embedding").alias("name"), F.col("vec_id").alias("step"), F.col("embedding").alias("w")
    )
    out = explode_chunks(vm(emb), "grp", "name")
    return out.select(F.col("grp").alias("label"), "dim", F.round("value", 6).alias("mean"))


def _bleu_sql(pairs_sql: str, max_n: int = 4) -> str:
    hw, rw = S.words("hyp"), S.words("ref")
    grams = []
    for side, col in (("h", "ht"), ("r", "rt")):
        grams.append(
            f"SELECT id, n, '{side}' AS side, array_to_string(list_slice({col}, i, i + n - 1), ' ') AS g "
            f"FROM toks, range(1, {max_n + 1}) a(n), range(1, len({col}) - n + 2) b(i)"
        )
    ms = ", ".join(f"sum(CASE WHEN n = {n} THEN least(hc, rc) ELSE 0 END)::DOUBLE AS m{n}" for n in range(1, max_n + 1))
    ts = ", ".join(f"sum(CASE WHEN n = {n} THEN hc ELSE 0 END)::DOUBLE AS t{n}" for n in range(1, max_n + 1))
    ps = ", ".join(f"CASE WHEN t{n} > 0 THEN m{n} / t{n} ELSE 0.0 END AS p{n}" for n in range(1, max_n + 1))
    logs = " + ".join(f"ln(p{n})" for n in range(1, max_n + 1))
    zero = " OR ".join(f"p{n} <= 0" for n in range(1, max_n + 1))
    return f"""WITH toks AS (SELECT id, {hw} AS ht, {rw} AS rt FROM {pairs_sql}),
grams AS ({grams[0]} UNION ALL {grams[1]}),
counted AS (SELECT id, n, g, sum(CASE WHEN side = 'h' THEN 1 ELSE 0 END) AS hc, sum(CASE WHEN side = 'r' THEN 1 ELSE 0 END) AS rc
  FROM grams GROUP BY id, n, g),
s AS (SELECT {ms}, {ts}, CAST(sum(CASE WHEN n = 1 THEN rc ELSE 0 END) AS BIGINT) AS ref_len FROM counted),
p AS (SELECT *, {ps}, CAST(t1 AS BIGINT) AS hyp_len FROM s),
b AS (SELECT *, CASE WHEN hyp_len > ref_len THEN 1.0 WHEN hyp_len = 0 THEN 0.0 ELSE exp(1.0 - ref_len::DOUBLE / hyp_len::DOUBLE) END AS bp FROM p)
SELECT round(CASE WHEN {zero} THEN 0.0 ELSE bp * exp(({logs}) / {float(max_n)}) END, 6) AS bleu, round(bp, 6) AS bp,
  {", ".join(f"round(p{n}, 6) AS p{n}" for n in range(1, max_n + 1))}, hyp_len, ref_len FROM b"""


@register("corpus_bleu", _bleu_sql(f"(SELECT id, tgt AS hyp, src AS ref FROM {fx.BITEXT_SQL})"))
def corpus_bleu(spark, sf_dir):
    from tandem.operators.bleu import corpus_bleu as cb

    b = fx.bitext(spark, sf_dir).select("id", F.col("tgt").alias("hyp"), F.col("src").alias("ref"))
    return cb(b)


RUN_DATE = "2025-02-28"


@register(
    "run_manifest",
    f"""SELECT 'src-tgt-' || version AS model_name, version, n_train, n_valid, src_bytes FROM (
  SELECT '2502.' || CAST(round_even({VOCAB_SIZE} / 1000.0, 0) AS BIGINT) || '.' || CAST(round_even(200000000 / 1000000.0, 0) AS BIGINT) AS version,
    CAST(sum(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS BIGINT) AS n_train,
    CAST(sum(CASE WHEN split = 'valid' THEN 1 ELSE 0 END) AS BIGINT) AS n_valid,
    CAST(sum(CASE WHEN split = 'train' THEN strlen(src) + 1 ELSE 0 END) AS BIGINT) AS src_bytes
  FROM ({_split_sql(CLEAN_PAIRS_SQL, N_VALID)}))""",
)
def run_manifest(spark, sf_dir):
    from tandem.functions.text import version_tag

    s = split.train_valid_split(clean_line_pairs(spark, sf_dir), N_VALID, seed=SEED)

    def n(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")

    counts = s.agg(
        n(F.col("split") == "train").alias("n_train"),
        n(F.col("split") == "valid").alias("n_valid"),
        F.sum(F.when(F.col("split") == "train", F.octet_length("src") + 1).otherwise(0)).cast("bigint").alias("src_bytes"),
    )
    version = version_tag(F.to_date(F.lit(RUN_DATE)), F.lit(VOCAB_SIZE), F.lit(200000000), F.lit(False))
    return counts.select(
        F.concat(F.lit("src-tgt-"), version).alias("model_name"), version.alias("version"), "n_train", "n_valid", "src_bytes"
    )


# ---- vocabulary ---------------------------------------------------------------------------

WORDS_SQL = f"(SELECT word, CAST(count(*) AS BIGINT) AS freq FROM (SELECT unnest({S.words(S.sanitize('text'))}) AS word FROM (SELECT line AS text FROM {fx.DOC_LINES_SQL})) GROUP BY word)"


def shared_word_counts(spark, sf_dir) -> DataFrame:
    """Words of every line of both sides; a vocabulary needs no alignment."""
    from tandem.operators.vocab import word_counts

    return word_counts(fx.document_lines(spark, sf_dir).select(F.col("line").alias("text")))


@register("word_vocab", f"SELECT word, freq FROM {WORDS_SQL} ORDER BY freq DESC, word LIMIT {VOCAB_SIZE}")
def word_vocab(spark, sf_dir):
    from tandem.operators.vocab import top_k

    return top_k(shared_word_counts(spark, sf_dir), VOCAB_SIZE)


@register(
    "char_coverage",
    f"""WITH c AS (SELECT substring(word, i, 1) AS ch, CAST(sum(freq) AS BIGINT) AS freq FROM {WORDS_SQL}, range(1, length(word) + 1) r(i) GROUP BY 1)
SELECT ch, freq, CAST(row_number() OVER (ORDER BY freq DESC, ch) AS BIGINT) AS rank,
  round(sum(freq) OVER (ORDER BY freq DESC, ch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(freq) OVER (), 6) AS coverage FROM c""",
)
def char_coverage(spark, sf_dir):
    from tandem.operators.vocab import char_coverage as cc

    return cc(shared_word_counts(spark, sf_dir)).withColumn("coverage", F.round("coverage", 6))


MARKED_SQL = f"(SELECT '▁' || word AS m, freq FROM {WORDS_SQL})"


@register(
    "bpe_pair_counts",
    f"""SELECT substring(m, i, 1) AS "left", substring(m, i + 1, 1) AS "right", CAST(sum(freq) AS BIGINT) AS freq
FROM {MARKED_SQL}, range(1, length(m)) r(i) GROUP BY 1, 2""",
)
def bpe_pair_counts(spark, sf_dir):
    from tandem.operators.vocab import initial_symbols, pair_counts

    wc = shared_word_counts(spark, sf_dir)
    return pair_counts(wc.select("freq", initial_symbols(F.col("word")).alias("syms")))


BPE_ROUNDS = 10


@register("bpe_merges")
def bpe_merges(spark, sf_dir):
    from tandem.operators.vocab import learn_bpe

    merges, _ = learn_bpe(shared_word_counts(spark, sf_dir), BPE_ROUNDS)
    return merges


SEED_SIZE = 20000


@register(
    "unigram_seed",
    f"""WITH subs AS (SELECT substring(m, i, l) AS piece, CAST(sum(freq) AS BIGINT) AS freq
  FROM {MARKED_SQL}, range(1, length(m) + 1) a(i), range(1, 9) b(l) WHERE i + l - 1 <= length(m) GROUP BY 1)
SELECT piece, freq FROM (SELECT piece, freq FROM subs ORDER BY freq DESC, piece LIMIT {SEED_SIZE})
UNION SELECT piece, freq FROM subs WHERE length(piece) = 1""",
)
def unigram_seed(spark, sf_dir):
    from tandem.operators.vocab import unigram_seed as us

    return us(shared_word_counts(spark, sf_dir), SEED_SIZE)


@register("unigram_vocab")
def unigram_vocab(spark, sf_dir):
    """The vocabulary of the production size, learnt from every line."""
    return unigram.learn_unigram_em(shared_word_counts(spark, sf_dir), VOCAB_SIZE)[0]


@register("encode_counts")
def encode_counts(spark, sf_dir):
    """Subwords of every line by the model of the production size; a line's words need not be in it."""
    _, model = unigram.learn_unigram_em(shared_word_counts(spark, sf_dir), VOCAB_SIZE)
    lines = fx.document_lines(spark, sf_dir).select(F.struct("doc_id", "line_no").alias("at"), F.col("line").alias("text"))
    return unigram.encode_unigram(lines, model, id_col="at", with_pieces=False).select("at.doc_id", "at.line_no", "n_pieces")


def _vocab_file(spark, sf_dir) -> str:
    """Write a scored vocabulary file derived from the shared word counts; return its path."""
    from tandem.operators.vocab import RESERVED_PIECES, top_k
    from tandem.session import shared_dir

    wc = shared_word_counts(spark, sf_dir)
    total = wc.select(F.sum("freq")).scalar()
    top = top_k(wc, VOCAB_SIZE).select(
        F.concat_ws("\t", "word", F.round(F.log(F.col("freq") / total), 6).cast("string")).alias("value")
    )
    reserved = spark.createDataFrame([(f"{p}\t0",) for p in RESERVED_PIECES], "value string")
    malformed = spark.createDataFrame([("lonely",), ("word notanumber",)], "value string")
    path = shared_dir(spark, "vocab")
    reserved.unionByName(top).unionByName(malformed).write.mode("overwrite").option("lineSep", "\n").text(path)
    return path


SCORES_SQL = f"""(SELECT word AS piece, round(ln(freq / tot), 6) AS score
  FROM (SELECT word, freq FROM {WORDS_SQL} ORDER BY freq DESC, word LIMIT {VOCAB_SIZE}), (SELECT sum(freq) AS tot FROM {WORDS_SQL})
  UNION ALL SELECT * FROM (VALUES ('<unk>', 0.0), ('<s>', 0.0), ('</s>', 0.0)) v(piece, score))"""


@register("scan_vocab", f"SELECT piece, score FROM {SCORES_SQL}")
def scan_vocab(spark, sf_dir):
    from tandem.operators.vocab import read_vocab

    return read_vocab(spark, _vocab_file(spark, sf_dir))


@register("vocab_omit_reserved", f"SELECT piece, score FROM {SCORES_SQL} WHERE piece NOT IN ('<unk>', '<s>', '</s>')")
def vocab_omit_reserved(spark, sf_dir):
    from tandem.operators.vocab import read_vocab

    return filters.omit_reserved(read_vocab(spark, _vocab_file(spark, sf_dir)))


@register(
    "vocab_rejects",
    f"SELECT count(*) + 2 AS n_lines, count(*) AS n_kept, CAST(1 AS BIGINT) AS rejected_fields, CAST(1 AS BIGINT) AS rejected_score FROM {SCORES_SQL}",
)
def vocab_rejects(spark, sf_dir):
    """Lines of the vocabulary file kept and rejected, by reason; the file has one line of each kind of fault."""
    from tandem.operators.vocab import vocab_line_report

    return vocab_line_report(spark.read.option("lineSep", "\n").text(_vocab_file(spark, sf_dir)))


FREQ_SQL = f"SELECT piece, CAST(trunc(exp(score) * 1000000) AS BIGINT) + 1 AS freq FROM {SCORES_SQL} WHERE piece NOT IN ('<unk>', '<s>', '</s>')"


@register("vocab_frequency", FREQ_SQL)
def vocab_frequency(spark, sf_dir):
    from tandem.operators.vocab import read_vocab, to_trainer_vocab

    return to_trainer_vocab(read_vocab(spark, _vocab_file(spark, sf_dir)))


@register("write_vocab", FREQ_SQL)
def write_vocab(spark, sf_dir):
    from tandem.operators.vocab import read_vocab, to_trainer_vocab
    from tandem.session import shared_dir
    from tandem.sources.sinks import read_tsv_vocab
    from tandem.sources.sinks import write_vocab as wv

    path = shared_dir(spark, "trainer-vocab")
    wv(to_trainer_vocab(read_vocab(spark, _vocab_file(spark, sf_dir))), path)
    return read_tsv_vocab(spark, path)


# ---- sinks and file plans ------------------------------------------------------------------


@register(
    "write_aligned",
    f"""SELECT shard, CAST(row_number() OVER (PARTITION BY shard ORDER BY id) - 1 AS BIGINT) AS line_no, src AS "user", tgt AS assistant
FROM (SELECT *, CAST(floor(id / {EXPORT_SHARD}) AS BIGINT) AS shard FROM {KEPT_SQL})""",
)
def write_aligned(spark, sf_dir):
    from tandem.plans.corpus import export_aligned
    from tandem.session import shared_dir
    from tandem.sources.sinks import read_aligned

    out = shared_dir(spark, "aligned")
    export_aligned(fx.conversation_collections(spark, sf_dir), ["user", "assistant"], out, shard_width=EXPORT_SHARD)
    return read_aligned(spark, out, ["user", "assistant"])


SPLIT_SHARD = 10000  # positions per split shard file


@register(
    "write_splits",
    f"""SELECT split, shard, CAST(row_number() OVER (PARTITION BY split, shard ORDER BY pos) - 1 AS BIGINT) AS line_no, src, tgt
FROM (SELECT *, CAST(floor(pos / {SPLIT_SHARD}) AS BIGINT) AS shard FROM ({_split_sql(CLEAN_PAIRS_SQL, N_VALID)}))""",
)
def write_splits(spark, sf_dir):
    from tandem.plans.corpus import write_splits as ws
    from tandem.session import shared_dir
    from tandem.sources.sinks import read_aligned

    out = shared_dir(spark, "splits")
    ws(split.train_valid_split(clean_line_pairs(spark, sf_dir), N_VALID, seed=SEED), out, shard_width=SPLIT_SHARD)
    return read_aligned(spark, out, ["src", "tgt"], extra_partitions=["split"])


def _write_document_files(spark, sf_dir) -> str:
    """Line files of document pairs in a shared folder: pair ``k`` (documents ``2k`` and
    ``2k+1``) belongs to dataset ``set<k mod 16>``; ``set<j>.src`` holds the lines of its
    even documents and ``set<j>.tgt`` those of the odd ones, in document order. Each
    entry is a folder of part files, one per zero-padded shard of documents, so no
    single task writes a whole dataset."""
    from tandem.session import shared_dir
    from tandem.sources.lines import split_lines

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = split_lines(docs, "text", ["doc_id"])
    dataset = F.concat(F.lit("set"), (F.floor(F.col("doc_id") / 2) % N_FILE_SETS).cast("string"))
    named = lines.select(
        F.concat(dataset, F.lit("."), F.when(F.col("doc_id") % 2 == 0, F.lit("src")).otherwise(F.lit("tgt"))).alias("file"),
        # about FILE_SHARD_DOCS documents of one file per shard
        F.lpad(F.floor(F.col("doc_id") / (FILE_SHARD_DOCS * 2 * N_FILE_SETS)).cast("string"), 12, "0").alias("shard"),
        "doc_id",
        "line_no",
        F.col("line").alias("value"),
    )
    path = shared_dir(spark, "linefiles")
    (
        named.repartition("file", "shard")
        .sortWithinPartitions("file", "shard", "doc_id", "line_no")
        .select("file", "shard", "value")
        .write.mode("overwrite")
        .partitionBy("file", "shard")
        .option("lineSep", "\n")
        .text(path)
    )
    return path


FILE_SHARD_DOCS = 64
N_FILE_SETS = 16


@register("discover_pairs")
def discover_pairs(spark, sf_dir):
    from tandem.sources.lines import discover_pairs as dp

    pairs, _ = dp(spark, _write_document_files(spark, sf_dir), "src", "tgt")
    return pairs


def _file_lines_sql() -> str:
    return f"""(SELECT 'set' || CAST((doc_id // 2) % {N_FILE_SETS} AS VARCHAR) AS source, doc_id % 2 AS side, line,
    row_number() OVER (PARTITION BY (doc_id // 2) % {N_FILE_SETS}, doc_id % 2 ORDER BY doc_id, line_no) - 1 AS ln
  FROM {fx.DOC_LINES_SQL})"""


def _file_pairs_sql() -> str:
    # dataset = source; line i of the even documents' file with line i of the odd ones'
    return (
        f"(SELECT s.source AS dataset, CAST(s.ln AS BIGINT) AS line_no, s.line AS src, t.line AS tgt "
        f"FROM {_file_lines_sql()} s JOIN {_file_lines_sql()} t ON s.source = t.source AND s.ln = t.ln "
        f"WHERE s.side = 0 AND t.side = 1 AND NOT {S.is_blank('s.line')} AND NOT {S.is_blank('t.line')})"
    )


@register(
    "split_files",
    f"""SELECT dataset, line_no, cpos, pos, CASE WHEN pos < {N_VALID} THEN 'valid' ELSE 'train' END AS split FROM (
  SELECT *, CAST(row_number() OVER (ORDER BY {S.perm_key(SEED, 'cpos')}, cpos) - 1 AS BIGINT) AS pos FROM (
    SELECT dataset, line_no, CAST(row_number() OVER (ORDER BY dataset, line_no) - 1 AS BIGINT) AS cpos FROM {_file_pairs_sql()}))""",
)
def split_files(spark, sf_dir):
    from tandem.plans.corpus import read_pair_files, shuffle_split

    pairs = read_pair_files(spark, _write_document_files(spark, sf_dir), "src", "tgt")
    return shuffle_split(pairs, N_VALID, seed=SEED, texts=False).select("dataset", "line_no", "cpos", "pos", "split")


@register("filter_too_long_pieces")
def filter_too_long_pieces(spark, sf_dir):
    """Too-long filter on subword counts: both sides encoded with the unigram model of the
    production size, then ``n_src, n_tgt <= 5000`` pieces."""
    _, model = unigram.learn_unigram_em(shared_word_counts(spark, sf_dir), VOCAB_SIZE)
    shared = setops.shared_sentences(fx.document_pairs(spark, sf_dir))
    sid = F.col("id") * 2 + F.when(F.col("side") == "tgt", 1).otherwise(0)
    enc = unigram.encode_unigram(shared.withColumn("sid", sid), model, with_pieces=False)
    counts = enc.select(
        F.floor(F.col("sid") / 2).cast("bigint").alias("id"),
        F.when(F.col("sid") % 2 == 0, F.col("n_pieces")).alias("n_src"),
        F.when(F.col("sid") % 2 == 1, F.col("n_pieces")).alias("n_tgt"),
    ).groupBy("id").agg(F.max("n_src").alias("n_src"), F.max("n_tgt").alias("n_tgt"))
    return filters.filter_too_long(counts.na.fill(0, ["n_src", "n_tgt"]), MAX_LEN, cols=("src", "tgt"), unit="pieces")
