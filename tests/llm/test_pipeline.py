import hashlib

import numpy as np
import pytest

import corpus_pipeline
from lithosense.llm import quality
from tests.llm.conftest import prose
from tests.llm.test_bpe import library  # noqa: F401
from tests.llm.test_decontaminate import plain_tiles
from tests.llm.test_line_dedup import plain as plain_lines
from tests.llm.test_near_dedup import plain_components


@pytest.fixture
def folder(spark, docs, tmp_path):
    items = [(k, prose(9000 + k, 30)) for k in range(3)]
    good = [(i, "\n".join(prose(100 * i + k, 12) for k in range(4))) for i in range(80)]
    words = [line.split() for line in good[3][1].split("\n")]
    for w in words:
        w[5] = "changed"
    rows = good + [
        (200, good[5][1]), (201, "\n".join(" ".join(w) for w in words)), (202, prose(1, 20) + "\n" + items[0][1]),
        (203, " ".join(f"{w.upper()}!!%%" for w in prose(8, 80).split())), (204, None), (205, ""),
        (206, good[7][1].replace("\n", " ")), (207, prose(2, 6) + "\n" + good[9][1].split("\n")[0] + "x"),
    ]
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path), rows, items


def test_equals_the_plain_procedures(spark, folder, library):  # noqa: F811
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    verdict = {r["doc_id"]: r["kept"] for r in quality.classify(docs, spark.read.parquet(f"{path}/labels.parquet")).collect()}
    left = [(i, t) for i, t in rows if verdict[i]]
    cleaned = plain_lines(left, 20)
    left = [(i, cleaned[True, i][0]) for i, t in left if cleaned[True, i][2] == 0 or cleaned[True, i][2] < cleaned[True, i][1]]
    component = plain_components(left, 5)
    left = [(i, t) for i, t in left if component[i] == i]

    def leaks(text):
        mine = (text or "").lower().split()
        return any(sum(n for n, _, _ in plain_tiles(mine, x.lower().split(), 4)) >= 0.6 * len(x.split()) for _, x in items)

    want = {i: library.encode_ordinary(t or "") for i, t in left if not leaks(t)}
    out = corpus_pipeline.run(spark, path).collect()
    assert {r["doc_id"]: r["token_ids"] for r in out} == want
    assert 200 not in want and 202 not in want and 203 not in want and 204 in want and 205 in want
    for r in out:
        assert r["ids_sha256"] == hashlib.sha256(np.array(r["token_ids"], "<u4").tobytes()).hexdigest()


def test_stages_keep_the_columns_and_take_an_empty_table(spark, folder, docs):
    path, _, _ = folder
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, spark.read.parquet(f"{path}/documents.parquet"), path).columns == docs([]).columns
    empty = docs([])
    for _, stage in corpus_pipeline.STAGES:
        empty_out = stage(spark, empty, path)
        assert empty_out.count() == 0
