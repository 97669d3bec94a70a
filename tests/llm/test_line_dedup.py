import random

import pytest

from lithosense.llm import line_dedup
from tests.llm.conftest import prose

BLANKS = " \t\r\v\f"


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows, least):
    """Every line against all earlier ones."""
    seen, out = [], {}
    order = sorted({(i is not None, i or 0): t for i, t in rows}.items())
    for key, text in order:
        kept, lines, dropped = [], 0, 0
        for line in (text or "").split("\n"):
            norm = line.strip(BLANKS).lower()
            if not norm:
                kept.append(line)
                continue
            lines += 1
            if any(norm == s or (min(len(norm), len(s)) >= least and one_edit(norm, s)) for s in seen):
                dropped += 1
            else:
                kept.append(line)
            seen.append(norm)
        out[key] = (None if text is None else "\n".join(kept), lines, dropped)
    return out


def edited(r, line):
    i = r.randrange(len(line))
    return r.choice([line[:i] + line[i + 1 :], line[:i] + r.choice("abé ") + line[i:], line[:i] + r.choice("abé ") + line[i + 1 :]])


def varied(seed):
    r = random.Random(seed)
    bank = [prose(seed * 50 + k, r.randint(2, 14)) for k in range(25)] + ["aaaaaaaaaaaaaaaaaaaaaaaa", "abababababababababababab"]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(r.randint(0, 6)):
            line = r.choice(bank)
            for _ in range(r.choice([0, 0, 1, 1, 2])):
                line = edited(r, line)
            lines.append(r.choice(["", "  ", "\t"]) + (line.upper() if r.random() < 0.2 else line) + r.choice(["", " "]))
        rows.append((i * 7 % 101, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_all_pairs(docs, seed):
    rows = varied(seed) + [(500, None), (501, ""), (502, "\n \n"), (None, "a line that only the null id has, at first"), (503, "a line that only the null id has, at first")]
    df = docs(rows).withColumnRenamed("lang", "pos").withColumnRenamed("source", "norm")
    out = line_dedup.remove_duplicate_lines(df)
    assert out.columns == [*df.columns, "n_lines", "n_dropped"]
    got = {(r["doc_id"] is not None, r["doc_id"] or 0): (r["text"], r["n_lines"], r["n_dropped"]) for r in out.collect()}
    assert got == plain(rows, line_dedup.MIN_FUZZY_CHARS)


def test_hot_lines_long_lines_and_repeated_ids(docs):
    hot = "a very common line that many of the documents share"
    long = "x".join(prose(3, 10) for _ in range(100))
    rows = [(i, f"{hot}\nown line of document number {i} with {prose(i, 6)}") for i in range(300)] + [(900, long), (901, long[:5000] + "#" + long[5001:]), (902, "same\nid"), (902, "same\nid")]
    got = {}
    for r in line_dedup.remove_duplicate_lines(docs(rows)).collect():
        got.setdefault(r["doc_id"], []).append((r["n_dropped"], r["text"]))
    assert sum(n for i in range(300) for n, _ in got[i]) == 299 and got[0][0][0] == 0
    assert got[900][0][0] == 0 and got[901] == [(1, "")] and got[902] == [(0, "same\nid")] * 2


def test_empty_table(docs):
    assert line_dedup.remove_duplicate_lines(docs([])).count() == 0


def test_rows_that_share_an_id_keep_their_own_lines(spark, docs):
    rows = [(1, "shared line"), (5, "shared line\nunique alpha line"), (5, "unique beta line\nanother gamma line"), (None, "first of none\nshared line"), (None, "yy different unique line\nfirst of none"), (None, None)]
    got = sorted((str(r["doc_id"]), str(r["text"]), r["n_dropped"]) for r in line_dedup.remove_duplicate_lines(docs(rows)).collect())
    # a null id sorts first: its row keeps the shared line; of the two null rows one keeps "first of none"
    lines = [line for _, text, _ in got for line in text.split("\n") if line and text != "None"]
    assert sorted(lines) == sorted(["unique alpha line", "unique beta line", "another gamma line", "shared line", "first of none", "yy different unique line"])
    assert ("1", "", 1) in got and ("5", "unique alpha line", 1) in got and ("5", "unique beta line\nanother gamma line", 0) in got


def test_text_ids_and_clashing_columns(spark):
    a, b = "the very same line of some length", "the very same line of some lengths"
    df = spark.createDataFrame([("b", a, 1, 2, 3, 4), ("a", b, 1, 2, 3, 4)], "doc_id string, text string, _row int, _gone int, _at int, place int")
    out = line_dedup.remove_duplicate_lines(df)
    assert out.columns == [*df.columns, "n_lines", "n_dropped"]
    assert {r["doc_id"]: (r["text"], r["_row"], r["_gone"]) for r in out.collect()} == {"a": (b, 1, 2), "b": ("", 1, 2)}
    assert [(r["id"], r["pos"]) for r in line_dedup.duplicate_lines(df).collect()] == [("b", 0)]
