import hashlib
import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

from lithosense.llm import rules
from tests.llm.conftest import prose

WORD = re.compile("[^\x20\x09-\x0D]+")
COLUMNS = ["doc_id", *rules.MEASURES, "base_failed", "score", "limit", "kept"]


def plain_measures(text):
    words, seen, windows = WORD.findall(text or ""), set(), {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {p + k for places in windows.values() if len(places) > 1 for p in places for k in range(5)}
    dup = 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def plain_scores(rows, trusted):
    """Scores in 1/10,000 by the documented formula."""
    def buckets(text):
        w = WORD.findall(text or "")
        return [zlib.crc32(g.encode()) % 65536 for g in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]

    raw, good = {}, {}
    for i, text in rows:
        for b in buckets(text):
            raw[b] = raw.get(b, 0) + 1
            if i in trusted and hashlib.md5(str(i).encode()).hexdigest() < "8":
                good[b] = good.get(b, 0) + 1
    n_raw, n_good = sum(raw.values()) + 65536, sum(good.values()) + 65536
    ratio = {b: round((math.log((good.get(b, 0) + 1) / n_good) - math.log((raw[b] + 1) / n_raw)) * (1 << 20)) for b in raw}
    return {i: math.floor(sum(ratio[b] for b in g) * 10_000 / (len(g) * (1 << 20))) if (g := buckets(t)) else None for i, t in rows}


@pytest.fixture
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


ODD = [
    "", None, " \t\x0b\n", "a b c d e", "a b c d e a b c d e", "a a a a a a", "x\n\nx\n x\nx", "#*$%&|<> é€𝄞 \x85\xa0 ß", "one two\x0bthree\x0cfour\rfive\n" * 3,
    "a b c d e f a b c d e f a b c d e", "w " * 3000, "\n".join(["same line"] * 5), " lead and trail ",
]


def test_measures_against_plain_counts(docs, labels):
    rows = [*enumerate(ODD), (50, prose(1, 30) + "\n" + prose(1, 30)), (51, " ".join(f"w{i}" for i in range(40_000)) + " w0 w1 w2 w3 w4")]
    out = {r["doc_id"]: r for r in rules.classify(docs(rows), labels([])).collect()}
    assert len(out) == len(rows)
    for i, text in rows:
        assert tuple(out[i][c] for c in rules.MEASURES) == plain_measures(text), repr(text)[:60]
        failed = out[i]["n_words"] < 10 or 100 * out[i]["n_repeat_words"] > 20 * out[i]["n_words"]
        # nothing is trusted, so the base rule alone decides
        assert out[i]["base_failed"] == failed and out[i]["kept"] == (not failed)


def test_scores_and_limits_against_plain_ones(docs, labels):
    rows = [(i, prose(i, 60)) for i in range(150)] + [(200 + i, " | ".join(prose(500 + i, 40).upper().split())) for i in range(10)] + [(300, "")]
    trusted = set(range(120))
    out = {r["doc_id"]: r for r in rules.classify(docs(rows), labels([(i, 1, 0) for i in trusted] + [(200, 0, 0), (130, 1, 1), (None, 1, 0)])).collect()}
    want = plain_scores(rows, trusted)
    assert all(abs(out[i]["score"] * 10_000 - s) < 1e-6 if s is not None else out[i]["score"] is None for i, s in want.items())
    held = sorted(want[i] for i in trusted if hashlib.md5(str(i).encode()).hexdigest() >= "8")
    assert len(held) >= rules.LEAST_HELD_OUT
    mid, low = (held[math.floor((len(held) - 1) * q)] for q in (0.5, 0.01))
    assert out[0]["limit"] * 10_000 == pytest.approx(mid - 2 * (mid - low))
    assert all(out[i]["kept"] for i in range(150)) and not any(out[200 + i]["kept"] for i in range(10)) and not out[300]["kept"]


def test_repeated_rows_nulls_and_clashing_columns(spark, labels):
    text = prose(3, 40)
    schema = "doc_id bigint, text string, lang string, id long, words string, score int, limit int, bucket string, one int, copies int"
    rows = [(1, text, "en", 1, "w", 1, 1, "b", 1, 1)] * 3 + [(None, text, None, 2, "w", 1, 1, "b", 1, 1), (None, None, None, 2, "w", 1, 1, "b", 1, 1), (1, prose(4, 30), "en", 1, "w", 1, 1, "b", 1, 1)]
    out = rules.classify(spark.createDataFrame(rows, schema), labels([(1, 1, 0), (2, None, None)]))
    assert out.columns == COLUMNS
    got = sorted((str(r["doc_id"]), r["n_words"], r["kept"]) for r in out.collect())
    assert got == [("1", 30, True), ("1", 40, True), ("1", 40, True), ("1", 40, True), ("None", 0, False), ("None", 40, True)]
    assert rules.classify(spark.createDataFrame([], schema), labels([])).count() == 0


def test_text_ids_and_a_native_plan(spark, sf, labels):
    df = spark.createDataFrame([("a", prose(1, 20), "en"), ("b", None, "en")], "doc_id string, text string, lang string")
    own = spark.createDataFrame([("a", 1, 0)], "doc_id string, quality int, toxic int")
    assert {r["doc_id"]: r["kept"] for r in rules.classify(df, own).collect()} == {"a": True, "b": False}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    worded = docs.select(F.col("doc_id").alias("id"), rules.words_of(F.coalesce("text", F.lit(""))).alias("words"))
    ratio = spark.createDataFrame([(7, 1)], "bucket bigint, ratio bigint")
    for df in (rules.classify(docs, spark.read.parquet(f"{sf}/labels.parquet")), rules.scores(worded, ratio, ["id"])):
        plan = df._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct"))


def test_matches_sql(spark, sf, duck):
    from lithosense.llm.queries import ORACLES, QUERIES
    from tests.oracle_check import compare

    same, why = compare(QUERIES["op11_quality_rules"](spark, sf), duck, ORACLES["op11_quality_rules"])
    assert same, why
