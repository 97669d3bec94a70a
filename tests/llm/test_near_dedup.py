import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lithosense.llm import near_dedup, words
from lithosense.llm.links import components
from tests.llm.conftest import prose


def plain_sets(rows, width):
    out = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out.setdefault(i, []).append({tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    return out


def plain_components(rows, width):
    sets = plain_sets(rows, width)
    root = {i: i for i in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(root)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def varied(seed):
    """Copies, near copies around the threshold, chains, and short texts."""
    r = random.Random(seed)
    rows = []
    for g in range(12):
        base = prose(seed * 100 + g, r.choice([3, 6, 12, 40, 200])).split()
        text = base
        for k in range(r.randint(1, 8)):
            rows.append((len(rows) * 3 % 997, " ".join(text)))
            text = list(text if r.random() < 0.5 else base)
            for _ in range(r.choice([0, 1, 1, 2, 3, 8])):
                text[r.randrange(len(text))] = prose(r.random(), 1)
    return rows


@pytest.mark.parametrize("seed,width", [(1, 2), (2, 2), (3, 5)])
def test_equals_all_pairs(spark, docs, seed, width):
    rows = varied(seed) + [(2001, None), (2002, ""), (2003, " \t\n"), (2004, "one"), (2005, "ONE"), (2006, "one two"), (2007, "one  two")]
    out = near_dedup.near_duplicates(docs(rows).withColumnRenamed("lang", "component"), width=width).collect()
    want, sets = plain_components(rows, width), plain_sets(rows, width)
    assert {r["doc_id"]: r["component_id"] for r in out} == want
    assert all(r["n_shingles"] == len(sets[r["doc_id"]][0]) and r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


def test_repeated_ids_null_ids_and_large_groups(spark, docs):
    base = prose(9, 60).split()
    group = [(i, " ".join(base[:i % 50] + [f"w{i}"] + base[i % 50 + 1 :])) for i in range(300)]
    rows = group + [(900, "a b c d"), (900, "e f g h"), (901, "e f g h"), (902, "a b c d"), (None, "a b c d"), (950, "q r s t u")] + [(1000 + i, "q r s t u") for i in range(400)]
    out = near_dedup.near_duplicates(docs(rows), width=2).collect()
    label = {}
    for r in out:
        label.setdefault(r["doc_id"], set()).add(r["component_id"])
    want = plain_components(rows, 2)
    assert {i: {c} for i, c in want.items()} == {i: c for i, c in label.items() if i is not None}
    assert label[None] == {None} and [r["kept"] for r in out if r["doc_id"] is None] == [True]


def test_keep_one_keeps_columns(spark, docs):
    df = docs([(3, prose(1, 30)), (1, prose(1, 30)), (2, prose(2, 30)), (4, None), (5, "")]).withColumnRenamed("source", "kept")
    out = near_dedup.keep_one(df)
    assert out.columns == df.columns and sorted(r["doc_id"] for r in out.collect()) == [1, 2, 4, 5]


def test_empty_table(docs):
    assert near_dedup.near_duplicates(docs([])).count() == 0


def test_estimate_follows_similarity():
    r = np.random.default_rng(1)
    for share in (0.3, 0.8):
        whole = r.integers(0, 1 << 63, 6000, dtype=np.uint64) * np.uint64(2)
        n = len(whole)
        both = int(share * n)
        a, b = whole[: both + (n - both) // 2], np.concatenate([whole[:both], whole[both + (n - both) // 2 :]])
        ra, rb = (near_dedup.registers(np.unique(x))[None] for x in (a, b))
        assert abs(near_dedup.estimate(ra, rb)[0] - share) < 0.12


def test_words_equal_the_plain_rule():
    rows = ["", "A b\tÀÉ  c\x0bd\x0c\r\n", "x" * 5000, " a", "a ", "日本 語", "a\x1cb"]
    for _, part in words.chunks(pa.array([None, *rows]), 64):
        w = words.words(part)
        for k, text in enumerate(part.to_pylist()):
            plain = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
            got = [bytes(w.data[a:b]).decode() for a, b in zip(w.start[w.first[k] : w.first[k + 1]], w.end[w.first[k] : w.first[k + 1]])]
            assert got == plain
            alone = words.words(pa.array([" ".join(plain)], pa.large_string()))
            assert w.hashes[w.first[k] : w.first[k + 1]].tolist() == alone.hashes.tolist()


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(1, 50)] + [(900, 901), (901, 900), (7, 7)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in [*range(1, 50), 500]} == {1} and got[901] == 900


def test_text_ids_and_clashing_columns(spark):
    base = prose(5, 60)
    df = spark.createDataFrame([("b", base, "x"), ("a", base + " end", "y"), ("c", prose(6, 60), "z"), (None, base, "n")], "doc_id string, text string, _gone string")
    out = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(df).collect()}
    assert out == {"a": "a", "b": "a", "c": "c", None: None}
    left = near_dedup.keep_one(df)
    assert left.columns == df.columns and sorted(r["_gone"] for r in left.collect()) == ["n", "y", "z"]


def test_members_far_from_each_other_are_not_paired(spark, docs, monkeypatch):
    """Copies of a template with a fifth of their own words meet nobody, however many they are."""
    r = random.Random(4)
    template = prose(70, 120).split()
    counts = []
    written = near_dedup.written

    def spy(df, label):
        out = written(df, label)
        if label == "remaining":
            counts.append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "written", spy)
    for n in (150, 300):
        rows = []
        for i in range(n):
            text = list(template)
            for k in r.sample(range(120), 26):
                text[k] = f"own{i}x{k}"
            rows.append((i, " ".join(text)))
        out = near_dedup.near_duplicates(docs(rows), width=2)
        assert out.filter("kept").count() == n
    assert counts[1] <= 4 * n


def test_clusters_of_one_template_equal_all_pairs(spark, docs):
    """Copies around the threshold of several originals that share a template."""
    r = random.Random(11)
    template, rows = prose(11, 80).split(), []
    for g in range(5):
        base = list(template)
        for k in r.sample(range(80), r.choice([5, 15, 30])):
            base[k] = f"g{g}w{k}"
        for _ in range(25):
            text = list(base)
            for k in r.sample(range(80), r.choice([0, 1, 2, 3, 4, 5, 9])):
                text[k] = r.choice([f"v{r.randrange(40)}", template[k]])
            rows.append((len(rows), " ".join(text)))
    for width in (2, 5):
        got = {x["doc_id"]: x["component_id"] for x in near_dedup.near_duplicates(docs(rows), width=width).collect()}
        assert got == plain_components(rows, width)


def test_far_members_meet_by_size_and_by_what_is_left_to_share(spark, docs, monkeypatch):
    """Texts with a half of a template and common words in the rest: few fit each other in size and can still share enough."""
    r = random.Random(21)
    template, rows = prose(71, 60).split(), []
    for i in range(160):
        own = [f"c{r.randrange(25)}" for _ in range(r.choice([40, 55, 75, 100, 140]))]
        rows.append((i, " ".join(template + own)))
    rows += [(500 + k, rows[k][1] + " end") for k in range(10)]
    counts, written = {}, near_dedup.written

    def spy(df, label):
        out = written(df, label)
        counts[label] = out.count()
        return out

    monkeypatch.setattr(near_dedup, "written", spy)
    got = {x["doc_id"]: x["component_id"] for x in near_dedup.near_duplicates(docs(rows), width=2).collect()}
    assert got == plain_components(rows, 2)
    assert counts["apart"] > 50 and counts["remaining"] < 3000, (counts["apart"], counts["remaining"])


def test_texts_that_few_meet_are_not_cut_into_shingles(spark, docs, monkeypatch):
    """Small groups around many templates, far from their hub: held against each other, and the links are those of all pairs."""
    r = random.Random(31)
    rows = []
    for g in range(40):
        template = prose(900 + g, 60).split()
        for k in range(5):
            text = template + [f"g{g}m{k}w{i}" for i in range(r.choice([12, 25, 40]))]
            rows.append((len(rows), " ".join(text)))
            if k % 2:
                rows.append((len(rows), " ".join([*text, "end"])))
    met, shingled, written = [], [], near_dedup.written

    def spy(df, label):
        out = written(df, label)
        if label == "apart":
            met.append(out.agg(F.max("met")).first()[0])
        if label == "apart-shingles":
            shingled.append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "written", spy)
    got = {x["doc_id"]: x["component_id"] for x in near_dedup.near_duplicates(docs(rows), width=2).collect()}
    assert got == plain_components(rows, 2)
    assert met[0] is not None and met[0] <= near_dedup.FEW and not shingled
