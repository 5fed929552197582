"""Hard negatives, repeated passages and collocations against brute force and on odd tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import collocations, hard_negatives, sketch, substring_dedup
from feedloom.llm.queries import LLM_QUERIES

DOCS = "doc_id long, text string, lang string, h1 string, doc string, n long"


# ── hard negatives ───────────────────────────────────────────────────────


def mined(rows):
    """The contract, row by row, in Python's whole numbers."""
    clean = {}
    for vec_id, vec, label in rows:
        if vec_id is None or label is None or vec is None or any(v is None or not math.isfinite(v) for v in vec):
            continue
        if vec_id % 7 == 0:
            label = int(math.fmod(label + 1, 10))
        q = [math.floor(256 * v) for v in vec]
        key = (len(q), label, vec_id)
        clean[key] = min(clean.get(key, q), q)
    out = set()
    for (dim, label, anchor), q in clean.items():
        if anchor % 100:
            continue
        others = [
            (sum(a * b for a, b in zip(q, p, strict=True)), i, m)
            for (d, m, i), p in clean.items()
            if d == dim and i != anchor
        ]
        others.sort(key=lambda o: (-o[0], o[1], o[2]))
        for score, positive, _ in [o for o in others if o[2] == label][:5]:
            fits = [o for o in others if o[2] != label and 30 * score <= 100 * o[0] <= 90 * score][:10]
            out |= {(anchor, positive, r, n, score, s) for r, (s, n, _) in enumerate(fits, 1)}
    return out


def vectors(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return frame.withColumn("dim", F.lit("x")).withColumn("q", F.lit(0)).withColumn("block", F.lit(1))


def got(frame):
    rows = hard_negatives.mine_hard_negatives(frame).collect()
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return [tuple(r[c] for c in names) for r in rows]


@pytest.mark.parametrize("scale", [1.0, 900.0, 1e5])
def test_mining_equals_brute_force(spark, scale):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(900, 12)) * scale, 3)
    x[300:420] = x[7]  # copies: long ties
    x[420:450] = 0.5
    rows = [(i, x[i].tolist(), int(rng.integers(0, 3)) if i % 3 else 4) for i in range(900)]
    found = got(vectors(spark, rows))
    assert len(found) == len(set(found)) and set(found) == mined(rows)


def test_mining_odd_rows(spark):
    one = [1.0, 0.5]
    rows = [
        (0, one, 0), (0, one, 0), (1, one, 1), (1, one, 1), (2, [0.6, 0.1], 2), (2, [0.6, 0.1], 2), (3, [0.6, 0.1], 3),
        (7, one, 0), (4, None, 1), (5, [1.0, None], 2), (6, [float("nan"), 1.0], 2), (8, [float("inf"), 1.0], 2),
        (9, one, None), (None, one, 1), (100, [], 1), (101, [], 1), (102, [], 2), (200, [1.0, 2.0, 3.0], 1),
        (300, [0.0, 0.0], 5), (301, [0.0, 0.0], 5), (302, [-1.0, 0.0], 5), (10, [1e200, 1.0], 2),
    ]
    small = [r for r in rows if r[0] != 10]  # too long for a 64-bit score: takes no part
    found = got(vectors(spark, rows))
    assert len(found) == len(set(found)) and set(found) == mined(small)
    assert {(0, 7), (0, 1), (100, 101), (300, 302)} == {f[:2] for f in found}
    assert got(vectors(spark, rows).where("vec_id < 0")) == []


def test_tiles_and_stripes(spark, monkeypatch):
    """Many tiles, stripes and tasks give what one of each gives."""
    rng = np.random.default_rng(5)
    rows = [(i * 25, rng.normal(size=6).tolist(), int(i % 40 == 0) + i // 300) for i in range(600)]
    monkeypatch.setattr(hard_negatives, "TILE", 64)
    monkeypatch.setattr(hard_negatives, "STRIPE", 16)
    monkeypatch.setattr(hard_negatives, "TASK_TILES", 2)
    assert set(got(vectors(spark, rows))) == mined(rows)


def test_residue_products_are_exact():
    rng = np.random.default_rng(9)
    for dim, top in ((3, 4), (64, 300), (200, 30000), (1, 2**31 - 1), (64, 2**27)):
        a = rng.integers(-top, top + 1, (17, dim)).astype(np.float64)
        b = rng.integers(-top, top + 1, (23, dim)).astype(np.float64)
        a[0], b[0] = top, -top
        bound = dim * float(top) ** 2
        primes, step = hard_negatives.residue_system(dim, bound)
        product = hard_negatives.exact_products(
            hard_negatives.residues(a, primes), hard_negatives.residues(b, primes), primes, step
        )
        true = [[sum(int(u) * int(v) for u, v in zip(x, y, strict=True)) for y in b] for x in a]
        assert product.tolist() == true


# ── repeated passages ────────────────────────────────────────────────────


def without_repeats(rows, size):
    """(doc_id, n_words, n_removed, kept) by walking all windows in order."""
    order = lambda d: (d is None, d or 0)
    texts = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first = {}
    for d, words in texts:
        for i in range(len(words) - size + 1):
            key, place = tuple(words[i : i + size]), (order(d), i)
            first[key] = min(first.get(key, place), place)
    out = []
    for d, words in texts:
        gone = set()
        for i in range(len(words) - size + 1):
            if first[tuple(words[i : i + size])] < (order(d), i):
                gone.update(range(i, i + size))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((d, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def removed(spark, rows, size=20, **more):
    frame = spark.createDataFrame([(d, t, "en", "a", "b", 0) for d, t in rows], DOCS)
    found = substring_dedup.remove_repeated(frame, size, **more).collect()
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found), key=repr)


def test_passages_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    passages = [" ".join(f"p{k}w{i}" for i in range(20 + 9 * k)) for k in range(6)]
    rows = []
    for d in range(120):
        parts = [" ".join(f"u{d}x{i}" for i in range(rng.integers(0, 40)))]
        for k in rng.integers(0, 6, rng.integers(0, 4)):
            parts += [passages[k], f"s{d}"]
        rows.append((int(d), "  ".join(parts) if d % 2 else "\n".join(parts)))
    rows += [(500 + d, rows[3][1]) for d in range(30)]  # copies
    rows += [(600, "a " * 100), (601, "A " * 100), (602, "a b " * 60)]  # runs that overlap themselves
    rng.shuffle(rows)
    assert removed(spark, rows) == without_repeats(rows, 20)
    assert removed(spark, rows, 3) == without_repeats(rows, 3)
    # A sketch that is full lets every window through; nothing changes.
    assert removed(spark, rows, 20, bits=4, lines=1) == without_repeats(rows, 20)


def test_passages_odd_rows(spark):
    long, other = " ".join(f"w{i}" for i in range(30)), " ".join(f"v{i}" for i in range(30))
    rows = [
        (1, long), (1, long), (2, None), (3, ""), (4, " \t\n\x0b\x0c\r"), (5, long + " end"), (None, long), (None, long),
        (6, "word"), (7, "w " * 60_000), (8, "x" * 300_000), (9, long.upper()), (10, other), (10, "z " + other), (11, long + " "),
    ]
    assert removed(spark, rows) == without_repeats(rows, 20)
    got = dict(((d, n), r) for d, n, r, _ in removed(spark, rows))
    assert got[(1, 30)] == 0 and got[(5, 31)] == 30 and got[(None, 30)] == 30 and got[(7, 60000)] == 59999
    assert removed(spark, []) == []


def test_kept_text(spark):
    frame = spark.createDataFrame([(1, "a b c d"), (2, "x a b c y"), (3, None)], "doc_id long, text string")
    rows = substring_dedup.remove_repeated(frame, 3, with_text=True).collect()
    assert {r.doc_id: r.kept_text for r in rows} == {1: "a b c d", 2: "x y", 3: ""}


def test_least_runs_are_chosen():
    """Every window's least run is counted at each of its places."""
    hasher = substring_dedup.CaseHasher()
    rng = np.random.default_rng(8)
    for text in ("a " * 70, " ".join(rng.choice(list("abc"), 400)), " ".join(map(str, range(300))), "x " * 19):
        words = hasher.words(text.encode())
        least = substring_dedup.least_runs(hasher, words, 20)
        counts = Counter(substring_dedup.chosen_runs(hasher, words, 20).tolist())
        windows = Counter(tuple(words[i : i + 20].tolist()) for i in range(len(words) - 19))
        for i, low in enumerate(least.tolist()):
            assert counts[low] >= windows[tuple(words[i : i + 20].tolist())]


def test_sketch_overestimates(spark):
    values = np.random.default_rng(0).zipf(1.3, 20_000).astype(np.uint64)

    def count(batches):
        part = sketch.CountSketch(10, 2)
        for batch in batches:
            part.add(batch.column("v").to_numpy().astype(np.uint64))
        yield from part.chunks()

    frame = spark.createDataFrame([(int(v),) for v in values], "v long").repartition(4)
    reached = sketch.merged(frame.mapInArrow(count, sketch.CHUNKS), 30, 10, 2)
    kinds, n = np.unique(values, return_counts=True)
    may = reached.may_reach(kinds)
    assert may[n >= 30].all() and not may.all()


# ── collocations ─────────────────────────────────────────────────────────


def phrases(rows, floor, top, longest=5):
    lower = {c: c + 32 for c in range(65, 91)}
    counts, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    chosen = {key: a for key, a in counts.items() if a >= floor and len(key[1]) > 1}
    around = Counter()
    for (lang, words), a in chosen.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                key = (lang, words[i : i + k])
                around[key] = max(around[key], a)
    out = {}
    for (lang, words), a in chosen.items():
        if around[lang, words] >= a:
            continue
        n = total[lang]
        cuts = [(counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words))]
        score, _, l, r = min((1000 * a * n // (l * r), k, l, r) for k, (l, r) in enumerate(cuts))
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r, n))
    return sorted(
        (lang, rank, p.decode(), -a, l, r, n, -s)
        for lang, found in out.items()
        for rank, (s, a, p, l, r, n) in enumerate(sorted(found)[:top], 1)
    )


def mined_phrases(spark, rows, **more):
    frame = spark.createDataFrame([(0, t, g, "a", "b", 0) for t, g in rows], DOCS).repartition(3)
    found = collocations.collocations(frame, **more).collect()
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found)


def test_collocations_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(12)] + ["É", "漢", "a\x0bb", "x y", "\x1cz"]
    chain = rng.dirichlet(np.full(len(words), 0.15), len(words))
    rows = []
    for _ in range(150):
        at, out = int(rng.integers(len(words))), []
        for _ in range(rng.integers(0, 60)):
            out.append(words[at].upper() if rng.random() < 0.3 else words[at])
            out.append(str(rng.choice([" ", " ", " ", "\t ", ". ", ",", "\n", "?! "])))
            at = int(rng.choice(len(words), p=chain[at]))
        rows.append(("".join(out), [None, "en", "de", ""][int(rng.integers(4))]))
    for floor, top in ((5, 2000), (5, 7), (100, 2000)):
        assert mined_phrases(spark, rows, floor=floor, top=top) == phrases(rows, floor, top)
    # A sketch that is full prunes nothing and changes nothing.
    assert mined_phrases(spark, rows, floor=5, bits=5) == phrases(rows, 5, 2000)
    assert mined_phrases(spark, rows, floor=5, longest=3) == phrases(rows, 5, 2000, 3)
    # However many tasks read the texts.
    for tasks in (1, 2, 50):
        assert mined_phrases(spark, rows, floor=5, tasks=tasks) == phrases(rows, 5, 2000)


def test_collocations_odd_rows(spark):
    rows = [
        (None, "en"), ("", "en"), (" .,;\n", "en"), ("a b " * 5000, "en"), ("x" * 300_000, None),
        ("a b", None), ("a b", None), ("a b a b a b", "fr"), ("A\tB", "fr"), ("a.b", "fr"), (None, None),
    ]
    for floor in (1, 2, 100):
        assert mined_phrases(spark, rows, floor=floor) == phrases(rows, floor, 2000)
    assert mined_phrases(spark, []) == []


def test_windows_are_cut_alike_in_blocks(monkeypatch):
    text = "Ab cd, ef gh. " * 50 + "ij"
    whole = collocations.Vocabulary("en").numbers(text.encode())
    monkeypatch.setattr(collocations, "BLOCK", 7)
    assert collocations.Vocabulary("en").numbers(text.encode()).tolist() == whole.tolist()


def test_plan_rolls_up(spark):
    docs = spark.createDataFrame([(0, "a b", "en", "a", "b", 0)], DOCS)
    plan = collocations.phrase_counts(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1


def test_registered():
    assert {"op11_hard_negatives", "op12_substring_dedup", "op13_collocations"} <= set(LLM_QUERIES)
