"""Quality rules: distribution divergence from language references.

Texts are read twice. The first pass sums, by language, the classes of bytes and how often and in how many documents each word
stands; `languages` makes a row of each language: its class histogram, its common words and their histogram. The common words
are learnt: those that stand in the most documents of the language, in COMMON_SHARE of them or more and in COMMON_DOCS at least. The second pass joins
that row to the documents of the language and takes the Jensen-Shannon distance of each one's class and common-word
histograms from its language's. Short documents have noisy histograms, so the distances only count from a minimum length on.

The word distance is held against a text without any common word, which lies at a distance that follows from the
language's share of common words. A document fails if it is nearer to that text than to its reference, or no nearer to the
reference than that text is. This needs a length at which a text of the language would hold at least GUARD_COMMON common
words; in languages whose documents share few words only long texts, or none, are judged by it.

Nulls: a null text counts as empty; a null language takes the pooled reference of all documents. Empty texts have zero counts
and fail the base rule (fewer than 50 words). Texts of any length are read whole; a task holds one text's words, and counts of
at most WORDS_AT_ONCE words before it passes them on. Words that stand in as many documents as each other are taken in the
order of their bytes. Repeated rows are judged one by one and give one row each. An empty table gives an empty result. Columns
other than doc_id, text and lang are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loopweaver.llm.chunks import checked
from loopweaver.llm.common import rows_where, stash, table, trim, trimmed, whole_rows

#: Common words of a language, and the share and number of its documents that they stand in, at least.
COMMON_WORDS, COMMON_SHARE, COMMON_DOCS = 32, 0.2, 5
#: Classes of a text's bytes; a continuation byte of UTF-8 belongs to no class.
CLASSES = ("blank", "newline", "lower", "upper", "digit", "stop", "quote", "mark", "symbol", "control", "latin", "wide", "astral")
MIN_WORDS = 50
#: Words from which the distances count.
GUARD_WORDS = 80
MAX_CLASS_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.60
#: Common words to expect in a text of the language from which a lack of them counts.
GUARD_COMMON = 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Words whose counts a task holds.
WORDS_AT_ONCE = 200_000


def _class_table() -> np.ndarray:
    out = np.full(256, len(CLASSES), np.uint8)
    put = lambda name, chars: out.__setitem__(list(chars), CLASSES.index(name))
    put("control", range(32))
    put("mark", range(33, 128))
    put("blank", b" \t\r\x0b\x0c")
    put("newline", b"\n")
    put("lower", range(97, 123))
    put("upper", range(65, 91))
    put("digit", range(48, 58))
    put("stop", b".,;:!?")
    put("quote", b"'\"()-")
    put("symbol", b"#*$%&|<>")
    put("latin", range(0xC2, 0xD0))
    put("wide", range(0xD0, 0xF0))
    put("astral", range(0xF0, 0xF8))
    return out


_CLASS_OF = _class_table()
_BARE = bytes(c if c in b"abcdefghijklmnopqrstuvwxyz'" or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\r\x0b\x0c"


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    often = {w for w, n in Counter(windows).items() if n > 1}
    total, covered = 0, 0
    for i, w in enumerate(windows):
        if w in often:
            total += i + 3 - max(i, covered)
            covered = i + 3
    return total


def repeated_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in raw.split(b"\n") if x.strip(_SPACE)]
    return len(lines) - len(set(lines))


def class_counts(raw: bytes) -> np.ndarray:
    return np.bincount(_CLASS_OF[np.frombuffer(raw, np.uint8)], minlength=len(CLASSES) + 1)[: len(CLASSES)]


def text_features(text: str | None, common: list[bytes]) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the histograms of classes and of common words, others
    last."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    data = np.frombuffer(raw, np.uint8)
    word_chars = int(np.count_nonzero((data & 0xC0) != 0x80)) - sum(map(raw.count, (bytes([c]) for c in _SPACE)))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    bare = raw.translate(_BARE).split()
    seen = Counter(bare)
    hits = [seen.get(w, 0) for w in common]
    return len(words), word_chars, symbols, repeated_lines(raw), repeated_words(words), class_counts(raw).tolist(), [*hits, len(bare) - sum(hits)]


#: Keys of a language's totals and classes among its words, which hold no such byte.
_TOTAL = b"\x00"


def _language_counts(documents: DataFrame) -> DataFrame:
    """lang, word, docs and n: documents and places of each word by language. Under _TOTAL all documents and words, and under
    _TOTAL and a byte the classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str | None, bytes], list[int]] = {}

        def emit() -> pa.RecordBatch:
            cols = [k for k, _ in held], [w for _, w in held], [v[0] for v in held.values()], [v[1] for v in held.values()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.binary(), pa.int64(), pa.int64()), strict=True)], names=["lang", "word", "docs", "n"])

        def add(lang: str | None, word: bytes, docs: int, n: int) -> None:
            if (v := held.get((lang, word))) is None:
                held[(lang, word)] = [docs, n]
            else:
                v[0] += docs
                v[1] += n

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                bare = raw.translate(_BARE).split()
                add(lang, _TOTAL, 1, len(bare))
                for k, n in enumerate(class_counts(raw).tolist()):
                    add(lang, _TOTAL + bytes([k]), 0, n)
                for w, n in Counter(bare).items():
                    add(lang, w, 1, n)
                if len(held) >= WORDS_AT_ONCE:
                    yield emit()
                    held.clear()
            trim()
        yield emit()

    counts = documents.select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(trimmed(run), "lang string, word binary, docs bigint, n bigint")
    return counts.groupBy("lang", "word").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))


def languages(documents: DataFrame) -> DataFrame:
    """ref_lang, ref_classes, common and ref_words of each language, and, for a null language, of all documents together: class
    histogram, COMMON_WORDS words (the rest empty) and their histogram with that of all others last."""
    counts = stash(_language_counts(documents), "language-words")
    pooled = counts.groupBy("word").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("lang"), "word", "docs", "n")
    every = counts.where("lang is not null").unionByName(pooled)
    total = every.where(F.col("word") == F.lit(_TOTAL)).select(F.col("lang").alias("l"), F.col("docs").alias("all_docs"), F.col("n").alias("all_words"))
    total = checked(stash(total, "languages"))
    key = F.substring("word", 1, 1) == F.lit(_TOTAL)
    often = every.where(~key).join(total, F.col("lang").eqNullSafe(F.col("l"))).where((F.col("docs") >= COMMON_SHARE * F.col("all_docs")) & (F.col("docs") >= COMMON_DOCS))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("docs"), "word"))
    common = often.withColumn("rank", rank).where(F.col("rank") <= COMMON_WORDS).groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "word", "n"))).alias("c"))
    classes = every.where(key & (F.octet_length("word") == 2)).groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("word", "n")))["n"].alias("ref_classes"))
    rows = total.join(classes.withColumnRenamed("lang", "lc"), F.col("l").eqNullSafe(F.col("lc"))).join(common, F.col("l").eqNullSafe(F.col("lang")), "left")
    c = F.coalesce("c", F.array().cast("array<struct<rank:int,word:binary,n:bigint>>"))
    missing = COMMON_WORDS - F.size(c)
    sums = F.aggregate(c["n"], F.lit(0).cast("bigint"), lambda a, n: a + n)
    ref_words = F.concat(c["n"], F.array_repeat(F.lit(0).cast("bigint"), missing), F.array(F.col("all_words") - sums))
    return rows.select(F.col("l").alias("ref_lang"), "ref_classes", F.concat(c["word"], F.array_repeat(F.lit(b""), missing)).alias("common"), ref_words.alias("ref_words"))


def _rows(column: pa.Array) -> np.ndarray:
    """A column of lists of one length as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1), np.int64)


def _by_language(column: pa.Array) -> Iterator[tuple[str | None, np.ndarray]]:
    """Each language of a column with the places of its rows."""
    codes = column.dictionary_encode(null_encoding="encode")
    of = codes.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(of, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
        if len(at):
            yield codes.dictionary[int(of[at[0]])].as_py(), at


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Distance (base 2, 0 to 1) of each row of counts p from the counts q; 0 where either has none."""
    p, q = np.asarray(p, float), np.asarray(q, float)
    rows = p.sum(1, keepdims=True)
    if not q.sum():
        return np.zeros(len(p))
    p, q = p / np.maximum(rows, 1), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = (np.where(p > 0, p * np.log2(p / m), 0).sum(1) + np.where(q > 0, q * np.log2(q / m), 0).sum(1)) / 2
    return np.where(rows[:, 0] > 0, np.sqrt(np.clip(d, 0, 1)), 0)


def lacks_common(hist: np.ndarray, ref: np.ndarray, far: np.ndarray, guard_common: float = GUARD_COMMON) -> np.ndarray:
    """Whether each row of word counts, far from the reference, looks rather like a text without common words."""
    bare = np.zeros(len(ref))
    bare[-1] = 1
    expected = hist.sum(1) * (1 - ref[-1] / max(ref.sum(), 1))
    none = jensen_shannon(bare[None], ref)[0]
    return (expected >= guard_common) & (far >= np.minimum(none, jensen_shannon(hist, bare)))


def judge(lang: pa.Array, n_words: np.ndarray, n_repeat: np.ndarray, hist: list[np.ndarray], ref: list[np.ndarray], guard_words: int = GUARD_WORDS, max_class: float = MAX_CLASS_DISTANCE, max_word: float = MAX_WORD_DISTANCE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distances (of classes, of words), base_failed and kept of rows, given their histograms and their languages' ones."""
    far, lacks = np.zeros((2, len(n_words))), np.zeros(len(n_words), bool)
    for _, at in _by_language(lang):
        for k in (0, 1):
            far[k, at] = jensen_shannon(hist[k][at], ref[k][at[0]])
        lacks[at] = lacks_common(hist[1][at], ref[1][at[0]], far[1, at])
    failed = (n_words < MIN_WORDS) | (100 * n_repeat > 50 * n_words)
    return far, failed, ~failed & ((n_words < guard_words) | ((far[0] <= max_class) & (far[1] <= max_word) & ~lacks))


def _judged(texts: pa.Array, lang: pa.Array, classes: pa.Array, common: pa.Array, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Counts (rows of five), distances, base_failed and kept of texts, with their languages' rows."""
    rows: list[tuple] = [()] * len(texts)
    for _, at in _by_language(lang):
        bins = common[int(at[0])].as_py()
        for k in at.tolist():
            rows[k] = text_features(texts[k].as_py(), bins)
    counts = np.array([r[:5] for r in rows], np.int64).reshape(len(rows), 5)
    hist = [np.array([r[k] for r in rows], np.int64).reshape(len(rows), -1) for k in (5, 6)]
    return (counts, *judge(lang, counts[:, 0], counts[:, 4], hist, [_rows(classes), _rows(words)]))


def _with_languages(rows: DataFrame, lang: str, known: DataFrame) -> DataFrame:
    """rows with _lang, their language's row as _known, joined by what lang says."""
    known = checked(stash(known.select(F.struct("ref_lang", "ref_classes", "common", "ref_words").alias("_known")), "references"))
    both = rows.withColumn("_lang", F.col(lang).cast("string"))
    return both.join(known, F.col("_lang").eqNullSafe(F.col("_known.ref_lang")))


def good_rows(documents: DataFrame) -> DataFrame:
    """The rows of documents that the rules keep against references from all of them, each judged by its own text and
    language. Texts are read twice and not shuffled."""
    both = _with_languages(documents.select(whole_rows(documents, "_row")), "_row.lang", languages(documents))
    return rows_where(both.select("_row", "_lang", "_known.ref_classes", "_known.common", "_known.ref_words"), lambda *c: _judged(*c)[3])


def quality_rules(documents: DataFrame) -> DataFrame:
    """Counts, distances and verdict of each document against references from all documents."""
    both = _with_languages(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang"), "lang", languages(documents))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, far, failed, kept = _judged(*(b.column(k) for k in range(1, 6)))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c) for c in counts.T), pa.array(far[0]), pa.array(far[1]), pa.array(failed), pa.array(kept)], names=["doc_id", *COUNTS, "class_distance", "word_distance", "base_failed", "kept"])
            trim()

    return both.select("doc_id", "text", "_lang", "_known.ref_classes", "_known.common", "_known.ref_words").mapInArrow(trimmed(run), "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", class_distance double, word_distance double, base_failed boolean, kept boolean")


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))
