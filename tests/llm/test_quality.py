import math
from collections import Counter, defaultdict

import pytest

from lithosense.llm import quality
from tests.llm.conftest import prose


class Plain:
    """Interpolated modified Kneser-Ney over characters, by its definition."""

    def __init__(self, trusted):
        n = Counter(c for t in trusted for c in t)
        self.alphabet = {c: k for k, (c, _) in enumerate(sorted(n.items(), key=lambda x: (-x[1], x[0]))[:62])}
        self.counts = {4: Counter(g for t in trusted for g in self.grams(t))}
        for k in (3, 2, 1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.discount, self.after = {}, {}
        for k, c in self.counts.items():
            m = [max(1, sum(v == i for v in c.values())) for i in (1, 2, 3, 4)]
            y = m[0] / (m[0] + 2 * m[1])
            d = [i - (i + 1) * y * m[i] / m[i - 1] for i in (1, 2, 3)]
            self.discount[k] = [min(max(x, 0.05), i + 0.95) for i, x in enumerate(d)]
            self.after[k] = defaultdict(list)
            for g, v in c.items():
                self.after[k][g[:-1]].append(v)

    def symbol(self, c):
        return self.alphabet.get(c, "other")

    def grams(self, text):
        s = ["border"] * 3 + [self.symbol(c) for c in text] + ["border"]
        return [tuple(s[i : i + 4]) for i in range(len(s) - 3)]

    def p(self, gram):
        if not gram:
            return 1 / 64
        k = len(gram)
        seen = self.after[k].get(gram[:-1])
        if not seen:
            return self.p(gram[1:])
        d = [self.discount[k][min(v, 3) - 1] for v in seen]
        c = self.counts[k].get(gram, 0)
        own = c - self.discount[k][min(c, 3) - 1] if c else 0
        return (own + sum(d) * self.p(gram[1:])) / sum(seen)

    def log10_perplexity(self, text):
        grams = self.grams(text)
        return -sum(math.log10(self.p(g)) for g in grams) / len(grams)


def test_perplexity_equals_the_definition(spark, docs):
    trusted = [(i, prose(i, 40) + " àé" * (i % 3)) for i in range(30)] + [(40, ""), (41, None)]
    model = quality.fit(docs(trusted))
    plain = Plain([t for _, t in trusted if t])
    rows = [(1, prose(77, 30)), (2, "XYZ!! 日本 zz"), (3, "t"), (4, None), (5, "")]
    got = {r["doc_id"]: r["log10_perplexity"] for r in quality.score(docs(rows), model).collect()}
    assert got[4] is None and got[5] is None
    for i, text in rows[:3]:
        assert got[i] == pytest.approx(plain.log10_perplexity(text), rel=1e-4)


def test_probabilities_of_a_context_sum_to_one(docs):
    table = quality.fit(docs([(i, prose(i, 50)) for i in range(10)])).dense()
    sums = (10.0 ** table.astype(float)).reshape(-1, quality.SYMBOLS).sum(axis=1)
    assert abs(sums - 1).max() < 1e-3


def corpus():
    good = [(i, prose(i, 60)) for i in range(200)]
    bad = [(1000 + i, " ".join(f"{w.upper()}!!%%" for w in prose(i, 60).split())) for i in range(40)]
    return good, bad


def test_held_out_accuracy_and_odd_rows(spark, docs):
    good, bad = corpus()
    odd = [(2000, None), (2001, ""), (None, good[0][1]), (0, good[0][1]), (2002, "x" * 40_000)]
    df = docs(good + bad + odd).withColumnRenamed("source", "threshold")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(120)] + [(1000 + i, 0, 0) for i in range(20)] + [(5, 0, 0), (6, None, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    out = quality.classify(df, labels).collect()
    kept = {r["doc_id"]: r["kept"] for r in out}
    assert len(out) == len(good + bad + odd)
    assert sum(kept[i] for i, _ in good) >= 190 and not any(kept[i] for i, _ in bad)
    assert kept[2000] and kept[2001] and not kept[2002]
    left = quality.keep_good(df, labels)
    assert left.columns == df.columns and {r["doc_id"] for r in left.collect()} == {i for i, k in kept.items() if k}


def test_languages_and_missing_labels(spark, docs):
    good, _ = corpus()
    df = docs(good[:40], "en").unionByName(docs([(5000, "!!??##" * 30)], None)).unionByName(docs([(5001, good[41][1])], "xx"))
    labels = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id bigint, quality int")
    kept = {r["doc_id"]: r["kept"] for r in quality.classify(df, labels).collect()}
    assert not kept[5000] and 5001 in kept
    nothing = quality.classify(df, labels.limit(0))
    assert all(r["kept"] and r["log10_perplexity"] is None for r in nothing.collect())
    assert quality.classify(docs([]), labels).count() == 0


class Whole(Plain):
    """The same without a bound on the alphabet."""

    def __init__(self, trusted):
        self.known = {c for t in trusted for c in t}
        super().__init__(trusted)

    def symbol(self, c):
        return c if c in self.known else "other"

    def p(self, gram):
        return super().p(gram) if gram else 1 / max(64, len(self.known) + 2)


LATIN = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789.,"


def cyrillic(seed, n):
    return prose(seed, n, "то ни ко на ре ств ени ого про ла да".split())


def test_no_character_of_trusted_text_is_merged_away(spark, docs):
    trusted = [(i, f"{prose(i, 40)} {LATIN}{LATIN[::-1]}") for i in range(30)] + [(50 + i, cyrillic(i, 5)) for i in range(4)] + [(60, "日本語 \x02 #")]
    model = quality.fit(docs(trusted))
    plain = Whole([t for _, t in trusted])
    rows = [(1, prose(77, 30)), (2, cyrillic(78, 20)), (3, "日本 本日 語#"), (4, "$$ кот ж日 %"), (5, "a\x02b"), (6, "т")]
    got = {r["doc_id"]: r["log10_perplexity"] for r in quality.score(docs(rows), model).collect()}
    for i, text in rows:
        assert got[i] == pytest.approx(plain.log10_perplexity(text), rel=1e-4), text


def test_a_rare_script_is_told_from_junk(spark, docs):
    import random

    latin = docs([(i, f"{prose(i, 60)} {LATIN * 3}") for i in range(200)])
    texts = [cyrillic(i, 60) for i in range(60)]
    shuffled = ["".join(random.Random(i).sample(t, len(t))) for i, t in enumerate(texts[:10])]
    marked = ["".join(c if c == " " else "$" for c in t) for t in texts[:10]]
    df = latin.unionByName(docs([(1000 + i, t) for i, t in enumerate([*texts, *shuffled, *marked])], "ru"))
    labels = spark.createDataFrame([(i, 1) for i in [*range(200), *range(1000, 1040)]], "doc_id bigint, quality int")
    kept = {r["doc_id"]: r["kept"] for r in quality.classify(df, labels).collect()}
    assert sum(kept[1000 + i] for i in range(60)) >= 54
    assert not any(kept[1060 + i] for i in range(20))


def test_fits_all_trusted_texts_of_a_half(spark, docs, monkeypatch):
    from pyspark.sql import functions as F

    seen = []
    monkeypatch.setattr(quality, "fit", lambda chosen: seen.append(chosen.count()))
    ids = spark.range(50_000)
    rows = ids.select(F.col("id").alias("doc_id"), F.lit("ab").alias("text"), F.lit("en").alias("lang"))
    quality.classify(rows, ids.select(F.col("id").alias("doc_id"), F.lit(1).alias("quality")))
    assert seen == [ids.filter(F.pmod(F.xxhash64("id"), F.lit(2)) == 0).count()] and seen[0] > 20_000


def test_trusted_rows_meet_their_ids_the_same_way_at_every_size(spark, docs, capsys):
    """Neither a copy of all ids on every executor nor a sort of the texts, be the ids few or many."""
    ids = spark.createDataFrame([(1,), (3,)], "_trusted bigint")
    rows = quality._rows_of(docs([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, None)]), ids)
    rows.explain()
    plan = capsys.readouterr().out
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan and "Sort " not in plan
    assert sorted((r["doc_id"], r["text"] or "") for r in rows.collect()) == [(1, "a"), (1, "b"), (3, "")]


def test_tables_leave_a_worker_with_the_next_operator():
    from lithosense.llm import common

    made = []
    for key in ("a", "a", "b"):
        common.kept(key, lambda: made.append(key) or key)
    assert made == ["a", "b"] and list(common._kept) == ["b"]
    common.release()
    assert not common._kept


def test_dense_table_is_made_in_little_more_than_its_own_room():
    import tracemalloc

    import numpy as np

    empty = (np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.float32))
    model = quality.Model(["a"], [empty] * 4, [(np.zeros(0, np.int64), np.zeros(0, np.float32))] * 4)
    tracemalloc.start()
    table = model.dense()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(table) == quality.SYMBOLS**4 and np.allclose(table, np.log10(1 / 64)) and peak < 1.2 * table.nbytes
