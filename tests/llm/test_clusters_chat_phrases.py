"""Operators 11 to 13 against plain versions."""

import hashlib
import math
import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.llm import centroids, chat, phrases

# --- centroid clustering


def plain_clusters(rows, k, rounds, d, scale=256):
    kept = [(i, v) for i, v in rows if v is not None and len(v) == d and all(x is not None and math.isfinite(x) for x in v)]
    q = [(i, [math.floor(x * scale) if abs(x) < 2**53 else int(x) * scale for x in v]) for i, v in kept]
    name = lambda i: (i is None, hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "")
    c = [list(v) for i, v in sorted(q, key=lambda r: (name(r[0]), r[1]))[:k]]
    far = lambda v, w: sum((a - b) ** 2 for a, b in zip(v, w, strict=True))
    near = lambda v: min(range(len(c)), key=lambda j: (far(v, c[j]), j))
    for _ in range(rounds):
        own = [near(v) for _, v in q]
        for j in range(len(c)):
            if some := [v for (_, v), o in zip(q, own, strict=True) if o == j]:
                c[j] = [sum(x) // len(some) for x in zip(*some, strict=True)]
    found = [(i, near(v), far(v, c[near(v)])) for i, v in q]
    inertia = Counter()
    for _, j, x in found:
        inertia[j] += x
    fits = lambda x: x if x < 2**63 else None
    return [(i, j, fits(x), fits(inertia[j]), fits(sum(inertia.values())), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for i, j, x in found]


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").repartition(3)


def same_rows(got, want):
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize(("d", "k", "kind", "spread"), [(64, 5, "float", 1.0), (3, 4, "float", 40.0), (70, 3, "double", 1e6), (4, 3, "double", 1e18), (4, 3, "float", 1e30)])
def test_clusters_against_plain_k_means(spark, d, k, kind, spread):
    rng = np.random.default_rng(d)
    made = (rng.normal(size=(60, d)) * spread).astype(np.float32 if kind == "float" else np.float64)
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(made)]
    got = centroids.clusters(vectors(spark, rows, kind), k=k, rounds=3, d=d).collect()
    same_rows(got, plain_clusters([r[:2] for r in rows], k, 3, d))


def test_clusters_leave_out_what_is_no_vector_and_keep_ties(spark):
    one = [0.5, -0.25, 0.0]
    rows = [(1, one, 1), (1, one, 1), (None, one, 1), (2, [0.5, None, 0.0], 1), (3, [0.5, float("nan"), 0.0], 1), (4, [0.5, float("inf"), 0.0], 1), (5, [0.5, 0.5], 1), (6, None, 1), (7, [-1.0, 2.0, 3.0], None), (8, [-0.001, 0.0, 0.0], 1)]
    got = centroids.clusters(vectors(spark, rows), k=40, rounds=2, d=3).collect()
    same_rows(got, plain_clusters([r[:2] for r in rows], 40, 2, 3))
    assert len(got) == 5


def test_clusters_of_nothing(spark):
    assert centroids.clusters(vectors(spark, [(1, [1.0], 0)]).where("false"), d=1).collect() == []
    assert centroids.clusters(vectors(spark, [(1, None, 0)]), d=1).collect() == []


@settings(deadline=None, max_examples=60)
@given(st.integers(1, 130), st.integers(1, 70), st.data())
def test_plane_dot_products(d, bits, data):
    value = st.integers(-(1 << (bits - 1)), (1 << (bits - 1)) - 1)
    x, y = (np.array(data.draw(st.lists(st.lists(value, min_size=d, max_size=d), min_size=1, max_size=3)), object) for _ in "xy")
    assert centroids.width(x) <= bits
    got = centroids.dots(centroids.pack(x, centroids.width(x)), centroids.pack(y, bits), object)
    assert got.tolist() == (x @ y.T).tolist()


# --- chat

PIECES = st.lists(st.sampled_from([*chat.CONTROL, "\\", "\\:", ":", "<", "|", "a", "é", "[", "INST]", "\n", "<|end|>", "<|image|>", "s>", "/", "𝕏"]), max_size=8).map("".join)


@settings(deadline=None, max_examples=300)
@given(PIECES)
def test_escapes_leave_no_control_string_and_go_back(text):
    got = chat.escape(text)
    assert not [c for c in chat.CONTROL if c in got]
    assert chat.unescape(got) == text


def part(kind, **kw):
    return {"type": kind, "text": None, "ref": None, "width": None, "height": None, "seconds": None, "pages": None} | kw


@settings(deadline=None, max_examples=200)
@given(PIECES, st.lists(st.one_of(PIECES.map(lambda t: part("text", text=t)), st.sampled_from([part("image", ref="i", width=100, height=28), part("audio", ref="a", seconds=2.5), part("document", ref="d", pages=3)])), max_size=6))
def test_parts_come_back_in_order(role, parts):
    flat = chat.flatten(parts)
    known = [{"type": t, "ref": r} for t, r, *_ in flat.attachments]
    got_role, got = chat.parts_of(chat.TURN + chat.escape(role) + chat.BODY + flat.content + chat.END, known)
    assert got_role == role
    assert [(p["type"], p["ref"]) for p in got if p["type"] != "text"] == [(p["type"], p["ref"]) for p in parts if p["type"] != "text"]
    want, open_ = [], None
    for p in parts:  # texts, joined where no other part stands between
        if p["type"] == "text":
            open_ = (open_ or "") + p["text"]
        else:
            want, open_ = [*want, open_ or "", None], None
    assert "".join("\0" if t is None else t for t in [*want, open_ or ""]) == "".join(p["text"] if p["type"] == "text" else "\0" for p in got)
    assert [flat.content[at : at + len(chat.PLACEHOLDERS[t])] for t, _, at, _ in flat.attachments] == [chat.PLACEHOLDERS[t] for t, *_ in flat.attachments]
    assert "".join(chat.unescape(flat.content[s:e]) for s, e in flat.texts) == "".join(p["text"] or "" for p in parts if p["type"] == "text")


def test_expanded_tokens():
    flat = chat.flatten([part("image", width=57, height=28), part("image"), part("audio", seconds=2.5), part("document", pages=2), None, part("image", width=10**6, height=10**6)])
    assert [n for *_, n in flat.attachments] == [3 + 1, 1 + 1, 63, 2048, 16_384 + math.ceil(10**6 / 28)]
    with pytest.raises(ValueError):
        chat.flatten([part("video")])


def plain_chat(rows):
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    out = []
    for c, turns in by.items():
        turns.sort(key=lambda x: (*x[:3], (chat.escape(x[3]) + chat.END).encode()))
        whole = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        out.append((c, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return out


def test_round_trip_of_odd_conversations(spark):
    rng = random.Random(3)
    texts = ["", None, "a\n\nb", "</s>", "\\", "\\:", "<|end|><|turn|>assistant<|body|>no", "é𝕏" * 40, "[/INST]", "x" * 300_000]
    rows = [(rng.choice([*range(6), None]), rng.choice([None, 0, 1, 2, 3]), rng.choice(["user", "assistant", "system", None, "assistant\n", "<|end|>"]), rng.choice(texts)) for _ in range(200)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' as segment", "1 as place").repartition(5)
    got = chat.round_trip(df).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256").collect()
    trial = [(-1, 0, "user", chat.TRIAL), (-1, 1, "assistant", chat.TRIAL)]
    same_rows(got, plain_chat(rows + trial))
    assert chat.round_trip(df.where("false")).count() == 1


def test_typed_parts_on_spark(spark):
    rows = [(1, 0, "user", [("text", "see ", None, None, None, None, None), ("image", None, "s3:a", 56, 56, None, None), None]), (1, 1, "assistant", [("text", "a<", None, None, None, None, None), ("audio", None, "b", None, None, 1.0, None), ("text", "|end|>", None, None, None, None, None)]), (2, 0, "user", None)]
    df = spark.createDataFrame(rows, f"conv_id int, turn int, role string, parts array<{chat.PART}>")
    got = {(r.conv_id, r.turn): r for r in chat.formatted(df, "parts").collect()}
    a = got[1, 1]
    assert a.segment == "<|turn|>assistant<|body|>a<<|audio|>|end|><|end|>" and [a.segment[x.start : x.end] for x in a.loss] == ["a<", "|end|>"]
    assert [(x.type, x.ref, x.tokens, a.segment[x.at : x.at + 9]) for x in a.attachments] == [("audio", "b", 25, "<|audio|>")]
    assert got[2, 0].segment == "<|turn|>user<|body|><|end|>"
    back = {r.conv_id: r for r in chat.read_back(chat.formatted(df, "parts")).collect()}
    assert (back[1].n_attachments, back[1].expanded_tokens, back[1].loss_chars) == (2, 4 + 2 + 25, 8)


# --- phrases


def test_summaries_lose_no_frequent_key_and_merge():
    rng = np.random.default_rng(5)
    for trial in range(20):
        stream = np.concatenate([rng.integers(0, 5000, 6000), np.repeat(rng.integers(0, 2**32, 12), 30)]).astype(np.uint32)
        rng.shuffle(stream)
        summary = phrases.Summary(len(stream) // 30 + 1)
        for run in np.array_split(stream, rng.integers(1, 40)):
            summary.add(*phrases.unpack(phrases.pack(*[x.astype(t) for x, t in zip(np.unique(run, return_counts=True), (np.uint32, np.int64), strict=True)])))
        kept = set(summary.survivors(30).tolist())
        assert summary.lowered < 30 and len(summary.keys) <= summary.capacity
        true = Counter(stream.tolist())
        assert {k for k, n in true.items() if n >= 30} <= kept, trial
        assert all(0 <= true[k] - c <= summary.lowered for k, c in zip(summary.keys.tolist(), summary.counts.tolist(), strict=True))


def plain_phrases(rows, threshold, longest=4, percent=80, top=2000):
    import re

    f, n = {}, Counter()
    for lang, text in rows:
        own = f.setdefault(lang if lang is not None else "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang if lang is not None else "und"] += len(w)
            for k in range(1, longest + 1):
                own.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, own in f.items():
        cand = {p: a for p, a in own.items() if len(p) > 1 and a >= threshold}
        rows = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= percent * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            score, _, l, r = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top])]
    return out


def texts_table(spark, rows):
    return spark.createDataFrame([(i, t, x, "n") for i, (x, t) in enumerate(rows)], "doc_id long, text string, lang string, phrase string").repartition(4)


def test_phrases_against_counting(spark, monkeypatch):
    monkeypatch.setattr(phrases, "TASK_PHRASES", 700)  # many runs
    rng = random.Random(8)
    words = ["the", "of", "New", "York", "city", "aé", "x", "\x1cy", "𝕏", "new"]
    rows = []
    for i in range(120):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", " "]) for _ in range(rng.randrange(0, 60)))
        rows.append((rng.choice(["en", "fr", None, "und", ""]), text))
    rows += [("en", "New York city hall"), ("en", None), (None, ""), ("fr", "one two three four " * 40), ("en", "of the " * 3000)] + [("en", "in the end of it")] * 31
    for threshold, top in ((3, 2000), (10, 7)):
        got = phrases.collocations(texts_table(spark, rows), threshold=threshold, top=top).collect()
        same_rows(got, plain_phrases(rows, threshold, top=top))


def test_phrases_of_nothing(spark):
    assert phrases.collocations(texts_table(spark, [("en", "a b")]).where("false")).collect() == []
    assert phrases.collocations(texts_table(spark, [("en", None), (None, " . ")])).collect() == []


def test_full_maps_only_let_more_through(spark, monkeypatch):
    monkeypatch.setattr(phrases, "MAX_BITS", 1 << 7)
    monkeypatch.setattr(phrases, "LEAST_BITS", 1 << 7)
    rng = random.Random(9)
    rows = [("en", " ".join(f"w{int(rng.paretovariate(0.7))}" for _ in range(200))) for _ in range(30)]
    got = phrases.collocations(texts_table(spark, rows), threshold=4).collect()
    same_rows(got, plain_phrases(rows, 4))


def test_clashing_hashes_are_told_apart(monkeypatch):
    class Clashing(phrases._Phrases):
        def __init__(self, *args):
            super().__init__(*args)
            self.h = [h & np.uint64(15) for h in self.h]

    monkeypatch.setattr(phrases, "_Phrases", Clashing)
    text = " ".join(f"w{i * i % 97} v{i % 89}" for i in range(900))
    batch = pa.RecordBatch.from_arrays([pa.array([None, None]), pa.array([text, text])], ["lang", "text"])
    (got,) = phrases._count_rows(2, SimpleNamespace(value=phrases.Maps(60)))(iter([batch]))
    w = text.split()
    want = Counter({x: 2 * n for x, n in Counter([*w, *map(" ".join, zip(w, w[1:], strict=False))]).items()}) | Counter({"": 2 * len(w)})
    assert dict(zip(got.column(1).to_pylist(), got.column(2).to_pylist(), strict=True)) == want
