"""Decontamination, quality rules and near-duplicates against brute force."""

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from tickloom.llm import decontam, neardup, quality_rules  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_words long, id long, key string, sig string"


def table(spark, rows):
    """Documents with columns that clash with names used inside."""
    return spark.createDataFrame([(i, t, "en", "a", 5, 7, "k", "s") for i, t in rows], SCHEMA)


def words(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = words(rng, 120)
    out = [base]
    for k in range(40):  # a chain of copies, each with some words changed
        w = out[-1].split()
        for _ in range(2):
            w[rng.randrange(len(w))] = f"n{k}x{rng.randrange(9)}"
        out.append(" ".join(w))
    out += [base.upper(), base + "  ", base, "one two three", "ONE two\nthree", "one two three four five", "one two three four", "", None, " \n\t ", "é" * 3, "x " * 500, words(rng, 60_000, 500)]
    out += [words(rng, rng.randrange(1, 60), 30) for _ in range(60)]
    return list(enumerate(out, 10))


def test_near_duplicates_equal_brute_force(spark, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(table(spark, texts)).collect()}
    want = {d: (n, c, d == c) for d, (n, c) in brute.near_duplicates(texts).items()}
    assert got == want
    assert len({c for _, c, _ in want.values()}) < len(want)


def test_near_duplicates_of_dense_nodes(spark, texts, monkeypatch):
    """Nodes that never get small go through blocks and leaders; edges are contracted in several tasks."""
    monkeypatch.setattr(neardup, "LEAF", 4)
    monkeypatch.setattr(neardup, "MAX_DEPTH", 4)
    monkeypatch.setattr(neardup, "BLOCK", 3)
    monkeypatch.setattr(neardup.components, "__defaults__", (8,))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(table(spark, texts)).collect()}
    assert got == brute.near_duplicates(texts)


def test_near_duplicates_of_odd_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f"), (3, None), (None, None)]
    got = neardup.near_duplicates(table(spark, rows)).collect()
    assert len(got) == 6
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got if r.doc_id) == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True)]
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert neardup.near_duplicates(table(spark, [])).count() == 0
    docs = table(spark, rows)
    kept = neardup.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("1", "a b c d e f"), ("3", None), ("None", None)]


def test_texts_that_differ_stay_under_one_id(spark):
    """Without that repeats and missing ids cost no text."""
    rng = random.Random(21)
    a, b, c, d = (words(rng, 40) for _ in range(4))
    rows = [(1, a), (1, b), (2, c), (None, d), (None, a.upper()), (2, b), (2, c), (0, c + " ")]
    docs = table(spark, rows)
    kept = neardup.without_near_duplicates(docs)
    assert kept.schema == docs.schema
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted([("1", a), ("1", b), ("0", c + " "), ("None", d)])


@pytest.mark.parametrize("leaf", [neardup.LEAF, 12])
def test_a_large_group_of_near_copies_with_outsiders(spark, monkeypatch, leaf):
    """Copies with one to four words changed, of which some hang on the group by a single link near the threshold; small
    leaves branch, compare outsiders with the main group by blocks, and end in blocks."""
    rng = random.Random(22)
    base = words(rng, 120, 10**9).split()
    rows = [(0, " ".join(base))]
    for i in range(1, 420):
        w = list(base)
        for j in rng.sample(range(120), 1 + i % 4):
            w[j] = f"n{i}x{j}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, words(rng, 60)) for i in range(20)]
    monkeypatch.setattr(neardup, "LEAF", leaf)
    monkeypatch.setattr(neardup, "BLOCK", leaf)
    monkeypatch.setattr(neardup, "MAX_DEPTH", 10)
    want = brute.near_duplicates(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(table(spark, rows)).collect()}
    assert got == want
    sizes = [sum(c == x for _, c in want.values()) for x in {c for _, c in want.values()}]
    assert max(sizes) > 100 and sizes.count(1) > 100


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.createDataFrame([(i + 1, i) for i in range(n)] + [(1001, 1000)], "a long, b long").repartition(8)
    for size in (10, 1_000_000):
        got = {r.id: r.comp for r in neardup.components(edges, size).collect()}
        assert got == {**{i: 0 for i in range(n + 1)}, 1000: 1000, 1001: 1000}


@pytest.fixture(scope="module")
def bench():
    rng = random.Random(6)
    return [(i, words(rng, 30)) for i in range(20)] + [(20, "Short Item"), (21, "one"), (22, None), (23, "…"), (None, words(rng, 14)), (3, words(rng, 13)), (24, "a, b. c d e")]


def test_contamination_equals_brute_force(spark, bench):
    rng = random.Random(7)
    rows = []
    for i in range(120):
        parts = [words(rng, rng.randrange(0, 80))]
        for _ in range(rng.randrange(3)):
            w = (rng.choice(bench)[1] or "").split()
            a = rng.randrange(max(1, len(w)))
            parts.append(", ".join(w[a : a + rng.randrange(8, 31)]).upper())
            parts.append(words(rng, rng.randrange(0, 40)))
        rows.append((i, "\n".join(parts)))
    rows += [(200, None), (201, ""), (202, "one"), (203, "short  item!"), (204, words(rng, 50_000))]
    items = spark.createDataFrame([(i, t, "x", 1) for i, t in bench], "item_id long, text string, doc_id string, n_words int")
    want = brute.contamination(rows, bench)
    for size in (decontam.PART_BYTES, 600):  # in one part and in several
        got = {r.doc_id: tuple(r)[1:] for r in decontam.contamination(table(spark, rows), items, part_bytes=size).collect()}
        assert got == want
    assert any(w[4] for w in want.values()) and any(w[1] and not w[4] for w in want.values())
    docs = table(spark, rows)
    kept = decontam.without_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {d for d, w in want.items() if not w[4]}


def test_contamination_of_empty_tables(spark, bench):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contamination(table(spark, []), nothing).count() == 0
    (row,) = decontam.contamination(table(spark, [(1, "some text")]), nothing).collect()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (2, 0, 0, False)


ODD = ["", None, " ", "a\n\na\na b\na b \n", "#$ | <>", "é ß\x0bü\x85x", "1 2 3 4 5 6 7 8 " * 5, "a b c d e f g h i a b c d e f g h", "line\r\nline\r\n", "x" * 200_000, "word " * 20]


def test_base_rules_equal_brute_force(spark):
    rng = random.Random(8)
    rows = list(enumerate(ODD + ["\n".join(words(rng, rng.randrange(12), 6) for _ in range(rng.randrange(30))) for _ in range(80)]))
    got = {r.doc_id: tuple(r)[1:7] for r in quality_rules.quality_rules(table(spark, rows)).collect()}
    assert got == {d: brute.base_rules(t) for d, t in rows}


def test_quality_rules_drop_text_unlike_its_language(spark):
    rng = random.Random(9)
    common = ["the", "of", "and", "to", "in"]
    clean = [" ".join(rng.choice(common) if rng.random() < 0.4 else "".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(200)) + "." for _ in range(60)]
    junk = " ".join("#$%&*"[rng.randrange(5)] * 3 + str(rng.random()) for _ in range(200))
    table_ = " | ".join("".join(rng.choice("abcdefghij") for _ in range(8)) for _ in range(200))
    rows = list(enumerate([*clean, junk, table_]))
    got = {r.doc_id: r for r in quality_rules.quality_rules(table(spark, rows)).collect()}
    assert all(got[i].kept for i in range(60))
    assert not got[60].kept and not got[60].base_failed and not got[61].kept
    assert quality_rules.quality_rules(table(spark, [])).count() == 0


def test_common_words_are_counted_exactly(spark):
    rng = random.Random(10)
    rows = [(i, " ".join(["the"] * 30 + [f"v{rng.randrange(5000)}" for _ in range(170)])) for i in range(50)]
    ((lang, _, known, shares),) = quality_rules.references(table(spark, rows))
    from tickloom.llm.scan import word_hash

    assert lang == "=en" and known.tolist() == [word_hash("the")] and shares[0] == pytest.approx(30 / 200)


def test_texts_of_a_language_without_reference_pass(spark):
    rng = random.Random(13)
    english = [(i, " ".join(rng.choice(["the", "of", "and", "to"]) if rng.random() < 0.4 else words(rng, 1) for _ in range(200)), "en") for i in range(30)]
    russian = " ".join(rng.choice(["и", "в", "не", "слово", "текст", "страница"]) + "аб"[rng.randrange(2)] for _ in range(100))
    rows = [*english, (100, russian, "ru"), (101, russian, None), (102, russian, "en"), (103, "да " * 60, "ru")]
    got = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[100].kept and got[101].kept
    assert not got[102].kept and not got[102].base_failed and got[103].base_failed and not got[103].kept


def test_an_id_with_three_texts_ties_all_their_groups(spark):
    rng = random.Random(14)
    a, b, c = (words(rng, 60, 10**9) for _ in range(3))
    rows = [(1, a), (5, b), (6, b), (9, c), (20, a), (20, b), (20, c)]
    got = {r.doc_id: (r.component_id, r.kept) for r in neardup.near_duplicates(table(spark, rows)).collect()}
    assert got == {d: (1, d == 1) for d, _ in rows}


def test_verdicts_equal_a_plain_version(spark):
    """All documents of sf0.001, odd texts, a null lang beside one called null, and a language too small to judge by."""
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rng = random.Random(15)
    english = "the of and to in is that for it was on with as by at from this have are not".split()
    some = lambda n: " ".join(rng.choice(english) for _ in range(n))
    rows += [(10_000 + i, some(300), None) for i in range(12)] + [(10_100 + i, some(30).upper() + " да нет", "null") for i in range(3)]
    rows += [(11_000, "1234 5678 # $ " * 200, "en"), (11_001, "Zq xj vk " * 9 + some(10), "en"), (11_002, None, None), (11_003, "", "en"), (11_004, "да " + "нет слово " * 60, "ru")]
    rows += [(11_100 + i, " ".join("".join(rng.choice("qxzjkvw") for _ in range(5)) for _ in range(80)), "en") for i in range(5)]
    want = brute.quality_verdicts(rows)
    got = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert {d: r.kept for d, r in got.items()} == {d: k for d, (k, _, _) in want.items()}
    for d, (_, a, b) in want.items():
        assert (got[d].class_distance, got[d].word_distance) == pytest.approx((a, b), abs=1e-9)
    assert not all(k for k, _, _ in want.values())
