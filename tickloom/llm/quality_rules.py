"""Quality rules: counts of a text's own, and its distance from the languages it may be written in.

Each text has a histogram of character classes and one of the common words of a language. A language's references are
the same histograms over all rows of that lang; its common words are those that make up COMMON_SHARE or more of its
words, found exactly in two passes: such a word has at least CANDIDATE_SHARE within enough blocks of text that its
counts there alone add up to COMMON_SHARE - CANDIDATE_SHARE of the language. That bounds the references by
1 / (COMMON_SHARE - CANDIDATE_SHARE) words a language, so they may be broadcast. A text is far from a language by the
Jensen-Shannon distance (base 2, 0 to 1) of its histograms; it is dropped if it is far from every language that it is
compared with: the WIDE languages of most words, whose references are broadcast, and its own lang, whose reference is
joined to its texts where it is not one of these. Texts of fewer than MIN_CHARS characters or MIN_WORDS words are too
short to judge and pass, as does every text whose own lang has fewer than MIN_REFERENCE words in the table, too few for
a reference.

Null and empty texts have no words and fail the base rule. A null lang is a language of its own, apart from one that is
called null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.cluster import saved, scratch, ship
from tickloom.llm import scan

COMMON_SHARE, CANDIDATE_SHARE = 1 / 200, 1 / 400
MIN_CHARS, MIN_WORDS, MIN_REFERENCE = 200, 40, 2000
#: Languages with which every text is compared.
WIDE = 1000
MAX_CLASS_DISTANCE = 0.28
#: A text of n words is far from a language by its common words above WORD_DISTANCE + WORD_SLACK / sqrt(n): few words scatter more.
WORD_DISTANCE, WORD_SLACK = 0.15, 2.0
CLASSES = 7
_CLASS = np.full(256, 5, np.uint8)  # other signs
_CLASS[97:123] = 0
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[32, 9, 10, 11, 12, 13]] = 3
_CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = 4
_CLASS[128:] = 6
_CLASS[128:192] = 7  # later bytes of a character
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _class_counts(block: scan.Block) -> np.ndarray:
    doc = np.repeat(np.arange(block.n), np.diff(block.offs))
    return np.bincount(doc * 8 + _CLASS[block.raw], minlength=block.n * 8).reshape(-1, 8)[:, :CLASSES]


def _names(column: pa.Array, block: scan.Block) -> tuple[list[str], np.ndarray]:
    """Distinct langs of a block's rows, and each row's number among them."""
    names = column.slice(block.first, block.n).to_pylist()
    kinds = sorted(set(names))
    number = {x: i for i, x in enumerate(kinds)}
    return kinds, np.array([number[x] for x in names])


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns lang, text: class counts (key 0 to 6), words (key 7), and counts of frequent words by hash."""
    for batch in batches:
        for block in scan.blocks(batch.column(1)):
            kinds, of = _names(batch.column(0), block)
            classes, w = _class_counts(block), block.words(scan.LETTERS, scan.LOWER)
            lang, kind, key, n = [], [], [], []
            for i, name in enumerate(kinds):
                own = classes[of == i].sum(0).tolist()
                h, c = np.unique(w.h[of[w.doc] == i], return_counts=True)
                many = c >= max(1, CANDIDATE_SHARE * c.sum())
                key += [*range(CLASSES), CLASSES, *h[many].view(np.int64).tolist()]
                n += [*own, int(c.sum()), *c[many].tolist()]
                kind += [0] * (CLASSES + 1) + [1] * int(many.sum())
                lang += [name] * (CLASSES + 1 + int(many.sum()))
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(kind, pa.int32()), pa.array(key, pa.int64()), pa.array(n, pa.int64())], ["lang", "kind", "key", "n"])


def _second_pass(candidates: dict[str, np.ndarray]):
    """Columns lang, text: exact counts of the candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {x: np.zeros(len(h), np.int64) for x, h in candidates.items()}
        for batch in batches:
            for block in scan.blocks(batch.column(1)):
                kinds, of = _names(batch.column(0), block)
                w = block.words(scan.LETTERS, scan.LOWER)
                for i, name in enumerate(kinds):
                    if len(known := candidates.get(name, ())):
                        h = w.h[of[w.doc] == i]
                        at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                        total[name] += np.bincount(at[known[at] == h], minlength=len(known))
        for name, c in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(c), pa.string()), pa.array(candidates[name].view(np.int64)), pa.array(c)], ["lang", "key", "n"])

    return run


def _all_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns lang, text: counts of all words."""
    for batch in batches:
        for block in scan.blocks(batch.column(1)):
            kinds, of = _names(batch.column(0), block)
            w = block.words(scan.LETTERS, scan.LOWER)
            for i, name in enumerate(kinds):
                h, c = np.unique(w.h[of[w.doc] == i], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(h), pa.string()), pa.array(h.view(np.int64)), pa.array(c)], ["lang", "key", "n"])


def _lang(name: str) -> Column:
    """A language as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("")).alias("lang")


#: (lang, class shares, hashes of common words, their shares and that of all others)
Reference = tuple[str, np.ndarray, np.ndarray, np.ndarray]


def _reference(lang: str, classes: np.ndarray, words: int, pairs: list[tuple[int, int]]) -> Reference:
    pairs = sorted((int(np.int64(k).view(np.uint64)), n) for k, n in pairs)
    share = np.array([n for _, n in pairs], float) / words
    return lang, classes / classes.sum(), np.array([k for k, _ in pairs], np.uint64), np.append(share, max(0.0, 1 - share.sum()))


def _first_counts(texts: DataFrame, save) -> DataFrame:
    """What the first pass counts, with the words of each lang that has enough for a reference."""
    ship(texts.sparkSession)
    first = save(texts.mapInArrow(_first_pass, "lang string, kind int, key long, n long").groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")), "counts")
    words = first.where(f"kind = 0 and key = {CLASSES}").select("lang", F.col("n").alias("words")).where(F.col("words") >= MIN_REFERENCE)
    return save(first.join(words, "lang"), "known")


def references(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", *, save=saved) -> list[Reference]:
    """The references of the WIDE languages of most words. A lang's name begins with =, that of null is empty."""
    texts = docs.select(_lang(lang_col), F.col(text_col).alias("text"))
    return _wide_references(texts, _first_counts(texts, save))


def _wide_references(texts: DataFrame, first: DataFrame) -> list[Reference]:
    wide = first.select("lang", "words").distinct().orderBy(F.desc("words"), "lang").limit(WIDE)
    rows = first.join(F.broadcast(wide.select("lang")), "lang", "left_semi").where((F.col("kind") == 0) | (F.col("n") >= (COMMON_SHARE - CANDIDATE_SHARE) * F.col("words"))).collect()
    classes: dict[str, np.ndarray] = {}
    size, candidates = {}, {}
    for r in rows:
        if r.kind == 0 and r.key < CLASSES:
            classes.setdefault(r.lang, np.zeros(CLASSES))[r.key] = r.n
        elif r.kind == 1:
            candidates.setdefault(r.lang, []).append(r.key)
        size[r.lang] = r.words
    candidates = {x: np.sort(np.array(k, np.int64).view(np.uint64)) for x, k in candidates.items()}
    exact = texts.mapInArrow(_second_pass(candidates), "lang string, key long, n long")
    common: dict[str, list[tuple[int, int]]] = {}
    for r in exact.groupBy("lang", "key").agg(F.sum("n").alias("n")).collect():
        if r.n >= COMMON_SHARE * size[r.lang]:
            common.setdefault(r.lang, []).append((r.key, r.n))
    return [_reference(lang, classes[lang], size[lang], common.get(lang, [])) for lang in sorted(classes)]


def narrow_references(texts: DataFrame, first: DataFrame, save) -> DataFrame:
    """lang, classes, words, common (its words' hashes and counts, 1 / COMMON_SHARE at most) of each language that has a
    reference. texts: theirs, and maybe more."""
    of_class = lambda k: F.coalesce(F.max(F.when((F.col("kind") == 0) & (F.col("key") == k), F.col("n"))), F.lit(0))
    heads = first.groupBy("lang").agg(F.array(*[of_class(k) for k in range(CLASSES)]).alias("classes"), F.max("words").alias("words"))
    counts = texts.join(heads.select("lang"), "lang", "left_semi").mapInArrow(_all_words, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))
    common = counts.join(heads.select("lang", "words"), "lang").where(F.col("n") >= COMMON_SHARE * F.col("words"))
    common = common.groupBy("lang").agg(F.collect_list(F.struct("key", "n")).alias("common"))
    return save(heads.join(common, "lang", "left"), "references")


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance, base 2, of each row of p from q."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0).sum(1)
        b = np.where(q > 0, q * np.log2(q / m), 0).sum(1)
    return np.sqrt(np.clip((a + b) / 2, 0, 1))


def _repeats(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """How often each value stands among those of its text."""
    key = scan.mix(h ^ scan.mix(doc.astype(np.uint64)))
    _, back, n = np.unique(key, return_inverse=True, return_counts=True)
    return n[back]


def base_counts(block: scan.Block) -> tuple[scan.Words, list[np.ndarray]]:
    """Words by white space, and word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    n = block.n
    w = block.words(scan.NOT_SPACE)
    heads = np.concatenate([[0], np.cumsum((block.raw & 0xC0) != 0x80)])
    chars = scan.per_text(heads[w.e] - heads[w.s], w.doc, n)
    marks = np.concatenate([[0], np.cumsum(_SYMBOL[block.raw])])
    symbols = np.diff(marks[block.offs])
    ends = np.flatnonzero(block.raw == 10)
    s = np.unique(np.concatenate([block.offs[:-1], ends + 1]))
    s = s[s < len(block.raw)]
    e = np.append(s[1:], len(block.raw))
    e = e - ((e > s) & (block.raw[np.maximum(e - 1, 0)] == 10))
    doc = np.searchsorted(block.offs, s, "right") - 1
    full = np.searchsorted(w.s, e) > np.searchsorted(w.s, s)
    s, e, doc = s[full], e[full], doc[full]
    key = scan.mix(block.hashes(s, e) ^ scan.mix(doc.astype(np.uint64)))
    _, at = np.unique(key, return_index=True)
    lines = np.bincount(doc, minlength=n) - np.bincount(doc[at], minlength=n)
    first, h = w.windows(8)
    twice = first[_repeats(w.doc[first], h) > 1]
    cover = np.zeros(len(w.s) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + 8, -1)
    repeat = scan.per_text((np.cumsum(cover[:-1]) > 0).astype(np.int64), w.doc, n)
    return w, [chars, symbols.astype(np.int64), lines.astype(np.int64), repeat]


def _nearest(block: scan.Block, plain: scan.Words, share: np.ndarray, most: np.ndarray, langs: list[Reference], far: tuple[np.ndarray, np.ndarray], rows: np.ndarray | None = None) -> None:
    """Lowers far, the distances by classes and by words of each text (or of the texts rows), to those of a language that
    is nearer."""
    of = slice(None) if rows is None else rows
    for _, ref, known, words in langs:
        if len(known):
            at = np.minimum(np.searchsorted(known, plain.h), len(known) - 1)
            col = np.where(known[at] == plain.h, at, len(known))
            hist = np.bincount(plain.doc * (len(known) + 1) + col, minlength=block.n * (len(known) + 1)).reshape(block.n, -1).astype(float)
        else:
            hist = plain.count[:, None].astype(float)
        a, b = _distance(share[of], ref[None]), _distance((hist / np.maximum(plain.count, 1)[:, None])[of], words[None])
        near = a / MAX_CLASS_DISTANCE + b / most[of] < far[0][of] / MAX_CLASS_DISTANCE + far[1][of] / most[of]
        far[0][of], far[1][of] = np.where(near, a, far[0][of]), np.where(near, b, far[1][of])


def _judge(refs):
    """Columns doc_id, lang, text, and classes, words and common of the lang's own reference (null where it is one of
    refs, or has none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = refs.value
        judged = {x for x, *_ in langs}
        for batch in batches:
            for block in scan.blocks(batch.column(2)):
                w, base = base_counts(block)
                classes = _class_counts(block).astype(float)
                chars = classes.sum(1)
                share = classes / np.maximum(chars, 1)[:, None]
                plain = block.words(scan.LETTERS, scan.LOWER)
                far = np.full(block.n, 1.0), np.full(block.n, 1.0)
                most = WORD_DISTANCE + WORD_SLACK / np.sqrt(np.maximum(plain.count, 1))
                _nearest(block, plain, share, most, langs, far)
                kinds, of = _names(batch.column(1), block)
                known = np.array([x in judged for x in kinds], bool)
                for i, name in enumerate(kinds):
                    rows = np.flatnonzero(of == i)
                    at = block.first + int(rows[0])
                    if batch.column(3)[at].is_valid:
                        own = _reference(name, np.array(batch.column(3)[at].as_py(), float), batch.column(4)[at].as_py(), [(x["key"], x["n"]) for x in batch.column(5)[at].as_py() or []])
                        _nearest(block, plain, share, most, [own], far, rows)
                        known[i] = True
                n_words = w.count.astype(np.int64)
                failed = (n_words < 20) | (100 * base[3] > 30 * n_words)
                short = (chars < MIN_CHARS) | (n_words < MIN_WORDS) | ~known[of]
                kept = ~failed & (short | ((far[0] <= MAX_CLASS_DISTANCE) & (far[1] <= most)))
                cols = [n_words, *base, failed, kept, *far]
                names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance"]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, block.n), *map(pa.array, cols)], names)

    return run


_JUDGED = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, class_distance double, word_distance double"


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and kept of every row, with its
    distances from the language that is nearest."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), _lang(lang_col), F.col(text_col).alias("text"))
    with scratch(spark) as save:
        first = _first_counts(rows.select("lang", "text"), save)
        langs = _wide_references(rows.select("lang", "text"), first)
        wide = F.col("lang").isin([x for x, *_ in langs]) if langs else F.lit(False)
        rest = first.where(~wide)
        own = None if rest.isEmpty() else narrow_references(rows.where(~wide).select("lang", "text"), rest, saved)
    refs = spark.sparkContext.broadcast(langs)
    none = [F.lit(None).cast(kind).alias(c) for c, kind in (("classes", "array<long>"), ("words", "long"), ("common", "array<struct<key:long,n:long>>"))]
    if own is None:
        return rows.select("*", *none).mapInArrow(_judge(refs), _JUDGED)
    # a language that is not wide has fewer words than a part in WIDE of all: none of these keys is hot
    narrow = rows.where(~wide).join(own, "lang", "left").select("doc_id", "lang", "text", "classes", "words", "common")
    return rows.where(wide).select("*", *none).mapInArrow(_judge(refs), _JUDGED).union(narrow.mapInArrow(_judge(refs), _JUDGED))
