import random

import numpy as np

from lithosense.llm import decontaminate
from tests.llm.conftest import prose


def plain_tiles(doc, item, least):
    """The longest common uncovered run, over and over, by trying every pair of places."""
    free_d, free_i, out = [True] * len(doc), [True] * len(item), []
    while True:
        best = (0, 0, 0)
        for i in range(len(doc)):
            for j in range(len(item)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and free_d[i + n] and free_i[j + n] and doc[i + n] == item[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < least:
            return out
        n, i, j = best
        for k in range(n):
            free_d[i + k] = free_i[j + k] = False
        out.append(best)


def test_tiles_equal_the_plain_procedure():
    r = random.Random(1)
    for _ in range(150):
        item = [r.randrange(8) for _ in range(r.randint(0, 30))]
        doc = [r.randrange(8) for _ in range(r.randint(0, 30))] + item[5:15] + item[:5] + item[15:]
        got = decontaminate.tiles(np.array(doc, np.uint64), np.array(item, np.uint64), 3)
        want = plain_tiles(doc, item, 3)
        assert sorted(n for n, _, _ in got) == sorted(n for n, _, _ in want)


def test_what_a_tile_leaves_takes_its_turn_by_length():
    """1,500 pairs of shuffled pieces: the same tiles as the longest run, over and over."""
    r = random.Random(11)
    for _ in range(1500):
        item = [r.randrange(12) for _ in range(r.randint(8, 24))]
        pieces = [item[a : a + r.randint(4, 12)] for a in (r.randrange(len(item)) for _ in range(4))]
        doc = [x for p in pieces for x in [*p, *[r.randrange(12)] * r.randint(0, 1)]]
        got = decontaminate.tiles(np.array(doc, np.uint64), np.array(item, np.uint64), 4)
        assert sorted(got) == sorted(plain_tiles(doc, item, 4))


def test_passages_reordered_edited_and_absent(spark, docs):
    items = [(k, prose(k, 30)) for k in range(5)] + [(7, "too short"), (8, None), (9, "")]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc_id string")
    w = items[0][1].split()
    rows = [
        (1, prose(50, 100) + " " + items[0][1].upper() + " " + prose(51, 100)),
        (2, " ".join([*w[20:], prose(52, 7), *w[:10], prose(53, 5), *w[10:20]])),
        (3, prose(54, 300)), (4, None), (5, ""), (6, " ".join(w[:8]) + " " + prose(55, 50)), (None, items[1][1]), (1, items[2][1]),
        (9, prose(56, 30_000) + " " + items[3][1]), (10, "too short"),
    ]
    df = docs(rows).withColumnRenamed("lang", "coverage")
    got = [(r["doc_id"], r["item_id"]) for r in decontaminate.matches(df, bench).collect()]
    assert sorted(got, key=str) == sorted([(1, 0), (2, 0), (None, 1), (1, 2), (9, 3), (10, 7)], key=str)
    in_blocks = decontaminate.matches(df, bench, block_words=1).collect()
    assert sorted(((r["doc_id"], r["item_id"]) for r in in_blocks), key=str) == sorted(got, key=str)
    left = decontaminate.drop_contaminated(df, bench)
    assert left.columns == df.columns and sorted(r["doc_id"] or -1 for r in left.collect()) == [3, 4, 5, 6]
    by = [(r["doc_id"], r["contaminated"], r["item_ids"]) for r in decontaminate.by_document(df, bench).collect()]
    want = [(1, True, [0]), (1, True, [2]), (2, True, [0]), (3, False, None), (4, False, None), (5, False, None), (6, False, None), (9, True, [3]), (10, True, [7]), (None, True, [1])]
    assert sorted(by, key=str) == sorted(want, key=str)


def test_rows_without_id_or_with_one_id_are_judged_alone(spark, docs):
    leak = prose(3, 25)
    bench = spark.createDataFrame([("i1", leak), ("i2", "one two three")], "item_id string, text string")
    df = docs([(None, leak), (None, prose(4, 40)), (None, None), (7, prose(5, 30)), (7, "so one two  three it was"), (7, "one two four three")]).withColumnRenamed("lang", "_bad").withColumnRenamed("source", "_content")
    left = decontaminate.drop_contaminated(df, bench)
    assert left.columns == df.columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in left.collect() if r["text"]) == sorted([("None", prose(4, 40)), ("7", prose(5, 30)), ("7", "one two four three")])
    named = df.withColumn("doc_id", df["doc_id"].cast("string"))
    assert sorted(r["item_id"] for r in decontaminate.matches(named, bench).collect()) == ["i1", "i2"]

def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, prose(1, 20))], "item_id bigint, text string")
    assert decontaminate.by_document(docs([(1, "a b c d e")]), none).collect()[0]["contaminated"] is False
    assert decontaminate.by_document(docs([]), some).count() == 0


def test_few_contaminated_documents_need_no_shuffle_of_the_texts(spark, docs, capsys):
    item = " ".join(f"word{k}" for k in range(12))
    rows = docs([(1, f"some text {item} more"), (2, "clean"), (2, item), (None, "clean too"), (3, None)])
    kept = decontaminate.drop_contaminated(rows, spark.createDataFrame([(7, item)], "item_id bigint, text string"))
    kept.explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.filter("text IS NOT NULL").collect()) == [(0, "clean too"), (2, "clean")]
    assert kept.count() == 3
