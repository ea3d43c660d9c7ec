"""Source divergence against plain sums over terms."""

import re
from collections import Counter

import numpy as np
import pytest

from gradeloom.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs, top):
    groups, holders, counts = {}, Counter(), Counter()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.setdefault(lang, set()).add(source)
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]
        counts.update((lang, source, t) for t in terms)
        holders.update((lang, t) for t in set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for (k, t), n in holders.items() if k == lang and n >= min_docs]
        v = len(kept)

        def shares(n):
            total = sum(n.values())
            return {t: 1 + 10**9 * (n[t] + 5) // (total + 5 * v) for t in kept}

        p = {s: shares({t: counts[lang, s, t] for t in kept}) for s in sources}
        q = shares({t: sum(counts[lang, s, t] for s in sources) for t in kept})
        for s in sources:
            pairs = sorted(((-sum(abs(p[s][t] - p[x][t]) for t in kept), x.encode()) for x in sources - {s}))
            terms = sorted((q[t] - p[s][t], t.encode()) for t in kept if counts[lang, s, t] and p[s][t] > q[t])[:top]
            out += [(lang, s, part, x.decode(), -f, k + 1) for part, found in (("pair", pairs), ("term", terms)) for k, (f, x) in enumerate(found)]
    return out


def tables():
    rng = np.random.default_rng(3)
    words = [*"alpha Beta GAMMA delta épée Ünder 数学 x y z".split(), *(f"w{k}w" for k in range(40))]
    rows = [(("en", "fr", "")[k % 3], f"s{rng.integers(9)}", " ".join(rng.choice(words, rng.integers(0, 40)))) for k in range(300)]
    rows += [(None, None, None), ("en", None, "Alpha_beta-gamma"), ("de", "only", ""), ("de", "two", None), ("xx", "one", "alpha"), ("en", "s1", "alpha " * 5000), ("en", "s1", "alpha " * 5000)]
    return rows


@pytest.mark.parametrize("rows, groups, min_docs, top", [(256, 32, 5, 50), (7, 2, 5, 3), (1, 1, 2, 50), (256, 32, 10**6, 50)])
def test_against_sums_over_terms(spark, rows, groups, min_docs, top, monkeypatch):
    monkeypatch.setattr(divergence, "ROWS", rows)
    monkeypatch.setattr(divergence.pair_distances, "__defaults__", (rows, groups))
    docs = spark.createDataFrame([(*r, 7, "p") for r in tables()], "lang string, source string, text string, n int, p string").repartition(4)
    got = [tuple(r) for r in divergence.divergence(docs, min_docs, top).collect()]
    assert sorted(got) == sorted(brute(tables(), min_docs, top))


def test_ties_are_ranked_by_bytes(spark):
    texts = [("en", s, "b ä a Z") for s in ("s", "é", "t")]
    got = divergence.divergence(spark.createDataFrame(texts, "lang string, source string, text string"), 1).collect()
    assert [r["item"] for r in sorted(got, key=lambda r: r["rank"]) if r["source"] == "s"] == ["t", "é"]


def test_empty_table(spark):
    assert divergence.divergence(spark.createDataFrame([], "lang string, source string, text string")).count() == 0


def test_joint_tables_count_terms_at_levels():
    levels = np.array([[0, 2, 2], [1, 0, 2], [1, 2, 0], [0, 2, 2]])
    matrix, group, level = divergence.one_hot(levels)
    joint = matrix.T @ matrix
    for a in range(len(group)):
        for b in range(len(group)):
            want = ((levels[:, group[a]] == level[a]) & (levels[:, group[b]] == level[b])).sum()
            assert joint[a, b] == want


def test_tasks_hold_counts_within_a_bound(spark, monkeypatch):
    monkeypatch.setattr(divergence, "FLUSH_TERMS", 3)
    docs = spark.createDataFrame([("en", "s", "a b c d e a b")] * 5 + [("en", "t", "a")], "lang string, source string, text string").coalesce(1)
    got = {(r["source"], r["term"]): (r["n"], r["docs"]) for r in divergence.count_terms(docs).collect() if r["term"]}
    assert got["s", "a"] == (10, 5) and got["s", "c"] == (5, 5) and got["t", "a"] == (1, 1)
