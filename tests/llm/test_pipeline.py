"""Rows of the pipeline against its five stages in plain Python."""

import math
import random
from collections import Counter

import pandas as pd

import corpus_pipeline
from tessera.llm import mixing
from tests.llm.test_operators import brute_components, brute_repeats, words


def good(text):
    w = (text or "").split()
    grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often = Counter(grams)
    repeat = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 8)}
    return len(w) >= 20 and 100 * len(repeat) <= 30 * len(w)


def without_repeats(texts):
    """brute_repeats' cover, as the text that is left."""
    seen, out = set(), []
    for t in texts:
        gone = set()
        for p in range(len(t) - 99):
            if t[p : p + 100] in seen:
                gone.update(range(p, p + 100))
            seen.add(t[p : p + 100])
        out.append("".join(c for i, c in enumerate(t) if i not in gone))
    assert [len(t) - len(o) for t, o in zip(texts, out, strict=True)] == [r[1] for r in brute_repeats(texts)]
    return out


def leaks(text, item):
    d, w = text.lower().split(), item.lower().split()
    most = 0
    for shift in range(1 - len(w), len(d)):
        score = top = equal = 0
        at_top = 0
        for k in range(max(0, -shift), min(len(w), len(d) - shift)):
            hit = d[shift + k] == w[k]
            score, equal = (score + 1, equal + 1) if hit else (score - 1.5, equal)
            if score < 0:
                score = equal = 0
            if score > top:
                top, at_top = score, equal
        most = max(most, at_top)
    return most >= min(13, math.ceil(0.6 * len(w)))


def targets(size):
    """Source -> target: weights by rank, at most three times the source; what a full source can't take goes to the others."""
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(sorted(size))}
    left, open_, out = float(sum(size.values())), set(size), {}
    while True:
        level = left / sum(weight[s] for s in open_) if open_ else 0
        full = {s for s in open_ if 3 * size[s] <= weight[s] * level}
        if not full:
            return out | {s: weight[s] * level for s in open_}
        out |= {s: 3.0 * size[s] for s in full}
        left, open_ = left - sum(3 * size[s] for s in full), open_ - full


def test_pipeline_rows(spark, tmp_path):
    rng = random.Random(11)
    shared, item = words(rng, 40, 5000), words(rng, 30, 5000)
    texts = [words(rng, rng.randrange(60, 900), 5000) for _ in range(40)]
    texts += [texts[3], texts[4].replace(" w1", " z1", 2), "too short", None, "", "again and again " * 40]  # copies and rejects
    texts += [words(rng, 90, 5000) + " " + shared + " " + words(rng, 50, 5000) for _ in range(3)]  # a repeated passage
    texts += [words(rng, 70, 5000) + " " + item + " " + words(rng, 70, 5000), words(rng, 200, 5000) + " " + " ".join(item.split()[:14])]
    rows = [(i, t, "en", ("a", "b", "c")[0 if i % 2 else 1 + i % 4 // 2], len(t or "")) for i, t in enumerate(texts)]
    pd.DataFrame({"item_id": [1], "text": [item]}).to_parquet(tmp_path / "benchmark.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")

    want = [r for r in rows if good(r[1])]
    want = [r for (_, root), (k, r) in zip(brute_components([r[1] for r in want]), enumerate(want), strict=True) if root == k]
    left = [(r, t) for r, t in zip(want, without_repeats([r[1] for r in want]), strict=True) if t]
    left = {r[0]: (r[3], len(t.split())) for r, t in left if not leaks(t, item)}
    assert {len(texts) - 1, len(texts) - 2, 40, 41, 42, 43, 44, 45}.isdisjoint(left) and len(left) == 43

    got = {r.doc_id: r for r in corpus_pipeline.run(spark, f"file://{tmp_path}").collect()}
    assert {i: r["size"] for i, r in got.items()} == {i: n for i, (_, n) in left.items()}
    size = Counter()
    for s, n in left.values():
        size[s] += n
    for s, t in targets(size).items():
        own = [got[i] for i, (x, _) in left.items() if x == s]
        assert all(r.source_size == size[s] and abs(r.target - t) < 1e-6 for r in own)
        assert sum(r.taken for r in own) == round(t)
        whole, rest = divmod(round(t), size[s])
        assert all(whole * r["size"] <= r.taken <= (whole + (rest > 0)) * r["size"] for r in own)
