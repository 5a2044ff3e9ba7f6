"""Quality rules run as a short-circuit cascade, the most rejection per cost first."""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.llm.common import appended, small_batches, text_of, with_arrays

SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#*$%&|<>"


class Doc:
    """Features of one whole text, each made when a rule first asks for it. Words are
    separated by ASCII white space only."""

    def __init__(self, text: str):
        self.text = text

    @cached_property
    def raw(self) -> bytes:
        return self.text.encode()

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - (len(self.raw) - len(self.raw.translate(None, SPACE)))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.raw.split(b"\n") if x.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        w = self.words
        windows = list(zip(w, w[1:], w[2:], strict=False))
        if len(set(windows)) == len(windows):
            return 0
        count = Counter(windows)
        covered = end = 0
        for at, x in enumerate(windows):
            if count[x] > 1:
                covered += at + 3 - max(at, end)
                end = at + 3
        return covered

    @cached_property
    def n_lettered(self) -> int:
        """Words with a letter (any byte beyond ASCII counts as one)."""
        plain = self.raw.translate(LETTER_CLASS).split()
        return sum(b"a" in x for x in plain)


#: Letters and bytes beyond ASCII to "a", ASCII white space to a space, the rest to "0".
LETTER_CLASS = bytes(0x61 if b > 127 or chr(b).isalpha() else 0x20 if b in SPACE else 0x30 for b in range(256))


@dataclass(frozen=True)
class Rule:
    """``rejects`` says whether a document fails; an empty text fails a rule only if it says so."""

    name: str
    rejects: Callable[[Doc], bool]


BASE = (
    Rule("too_few_words", lambda d: d.n_words < 50),
    Rule("repeated_words", lambda d: 100 * d.n_repeat_words > 50 * d.n_words),
)
MORE = (
    Rule("symbols", lambda d: 4 * d.n_symbols > d.n_words),
    Rule("word_length", lambda d: not 2 * d.n_words <= d.word_chars <= 20 * d.n_words),
    Rule("duplicate_lines", lambda d: d.n_dup_lines >= 3 and 10 * d.n_dup_lines > 3 * len(d.lines)),
    Rule("words_without_letters", lambda d: 2 * d.n_lettered < d.n_words),
)


def measure(docs: DataFrame, rules: Sequence[Rule], text: str = "text", key: str = "doc_id", sample_rows: int = 2000) -> DataFrame:
    """``(rule, n, rejected, seconds)`` over about ``sample_rows`` rows, chosen by a hash of the key.

    Every rule runs alone on every sampled row, on fresh features, so its cost holds what it
    needs from the text. A table of fewer rows is measured whole; an empty one gives no rows.
    """
    share = max(1, docs.count() // sample_rows)
    rows = docs.where(F.pmod(F.xxhash64(F.col(key)), F.lit(share)) == 0).select(text_of(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rejected, seconds = 0, Counter(), Counter()
        for batch in small_batches(batches, 0):
            texts = batch.column(0).to_pylist()
            seen += len(texts)
            for rule in rules:
                began = time.process_time()
                rejected[rule.name] += sum(rule.rejects(Doc(t)) for t in texts)
                seconds[rule.name] += time.process_time() - began
        if seen:
            yield pa.RecordBatch.from_pylist([{"rule": r.name, "n": seen, "rejected": rejected[r.name], "seconds": float(seconds[r.name])} for r in rules])

    parts = rows.mapInArrow(run, "rule string, n bigint, rejected bigint, seconds double")
    return parts.groupBy("rule").agg(F.sum("n").alias("n"), F.sum("rejected").alias("rejected"), F.sum("seconds").alias("seconds"))


def ordered(rules: Sequence[Rule], measured: list[dict]) -> list[Rule]:
    """Rules by descending rejection per cost; equal ones and ones not measured in the order given."""
    of = {m["rule"]: m["rejected"] / max(m["seconds"], 1e-9) for m in measured}
    return sorted(rules, key=lambda r: -of.get(r.name, 0.0))


def fit_cascade(docs: DataFrame, rules: Sequence[Rule], text: str = "text", key: str = "doc_id", sample_rows: int = 2000) -> list[Rule]:
    """The rules in the order in which they should run. One row per rule comes to the driver.

    The order changes the cost only: a document is kept if no rule rejects it.
    """
    return ordered(rules, [r.asDict() for r in measure(docs, rules, text, key, sample_rows).collect()])


def rejected_by(doc: Doc, cascade: Sequence[Rule]) -> str | None:
    """The first rule that rejects the document; later ones aren't run."""
    return next((r.name for r in cascade if r.rejects(doc)), None)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality(docs: DataFrame, cascade: Sequence[Rule], text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, the five counts of every whole text, base_failed and kept.

    A null text has no words, so it fails; repeated rows get equal results; a ``keep`` column
    named like a result gives way to it. Memory: one batch of texts.
    """
    rows = docs.select(*keep, text_of(text).alias("_text"))
    rows = rows if keep else rows.select("_text")
    schema = appended(docs.select(*keep), ", ".join(f"{c} bigint" for c in COUNTS) + ", base_failed boolean, kept boolean")
    kept_cols = [f.name for f in schema][: len(schema) - 7]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, len(keep)):
            got = []
            for t in batch.column(len(keep)).to_pylist():
                doc = Doc(t)
                failed = any(r.rejects(doc) for r in BASE)
                got.append((*(getattr(doc, c) for c in COUNTS), failed, not failed and rejected_by(doc, cascade) is None))
            cols = list(zip(*got, strict=True))
            arrays = [pa.array(c, pa.int64()) for c in cols[:5]] + [pa.array(c, pa.bool_()) for c in cols[5:]]
            yield with_arrays(batch, kept_cols, arrays, [f.name for f in schema][-7:])

    return rows.mapInArrow(run, schema)


def filter_quality(docs: DataFrame, cascade: Sequence[Rule], text: str = "text") -> DataFrame:
    """The documents that no rule of the cascade rejects, with all their columns."""
    at = docs.columns.index(text)
    if docs.schema[text].dataType.typeName() != "string":
        raise TypeError(f"{text} is no string column")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, at, 4 << 20):
            mask = [rejected_by(Doc(x.as_py() or ""), cascade) is None for x in batch.column(at)]
            yield batch.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
