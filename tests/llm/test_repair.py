import hashlib
import heapq
import random
import re
import zlib

import pytest

from lithosense.llm import repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
GRAMMAR = re.compile("(s?(ua)+)?")


def plain_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        word = re.search(r"[^\x20\x09-\x0D]", text)
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        out.append("blank" if not word else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """Cheapest first over all edit sequences: (cost, audit, repaired turns)."""
    faults = plain_faults(rows)
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, initials, turns = heapq.heappop(heap)
        if i == len(rows) and GRAMMAR.fullmatch(initials):
            return cost, audit, turns
        # what can still be done depends on the place and on the grammar's state alone
        state = (i, initials[-1:], bool(initials))
        if state in done:
            continue
        done.add(state)

        def push(c, letter, j, role=None, text=""):
            new = initials + role[:1] if role is not None else initials
            if role is None or re.fullmatch("s?(ua)*u?", new):
                heapq.heappush(heap, (cost + c, audit + letter, j, new, turns + ((role, text),) if role is not None else turns))

        for role in ("user", "assistant"):
            push(3, "I", i, role)
        if i < len(rows):
            role, text = rows[i]
            push(4, "D", i + 1)
            if faults[i] not in ("blank", "duplicate"):
                extra = 3 if faults[i] == "truncated" else 0
                if role:
                    push(extra, "K", i + 1, role, text)
                for new in ("user", "assistant"):
                    push(3 + extra, "R", i + 1, new, text)


def random_rows(r, n):
    texts = ["Fine.", "Yes!", "", " \t", "cut off", "What? ", "a.b", "é…", "ok.\n"]
    return [(r.choice(["user", "assistant", "assistant", "user", "system", "tool", "", "admin"]), r.choice(texts) + (str(k) + "." if r.random() < 0.6 else "")) for k in range(n)]


def check(out, rows):
    cost, audit, turns = plain_repair(rows)
    faults = plain_faults(rows)
    assert (out["cost"], out["audit"]) == (cost, audit), rows
    assert out["repaired_sha256"] == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
    assert [out[k] for k in ("blank", "duplicate", "truncated")] == [faults.count(k) for k in ("blank", "duplicate", "truncated")]
    initials = [r[:1] for r, _ in rows]
    assert out["illegal"] == sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


@pytest.mark.parametrize("block", [2, 3, 256])
def test_cheapest_repairs_against_plain_search(spark, block):
    r = random.Random(block)
    convs = {i: random_rows(r, r.randint(0, 14)) for i in range(60)} | {99: random_rows(r, 60)}
    rows = [(i, k, role, text) for i, turns in convs.items() for k, (role, text) in enumerate(turns)]
    r.shuffle(rows)
    ids = spark.createDataFrame([(i,) for i in convs], "conv_id bigint")
    out = {x["conv_id"]: x for x in repair.digests(spark.createDataFrame(rows, SCHEMA), ids, block).collect()}
    assert len(out) == len(convs)
    for i, turns in convs.items():
        check(out[i], turns)


def test_search_in_parts_equals_search_at_once():
    r = random.Random(4)
    for _ in range(200):
        layers = [repair.ROW_EDGES[r.choice("xsuaoSUA")] for _ in range(r.randint(1, 12))]
        cut = r.randint(1, len(layers))
        parts = [repair.between(layers[:cut])] + ([repair.between(layers[cut:])] if layers[cut:] else [])
        for a in repair.STATES:
            for b in repair.STATES:
                assert repair.search(layers, a, b) == repair.search([sorted(p, key=lambda e: e[3]) for p in parts], a, b)


def test_one_very_long_conversation(spark):
    r = random.Random(9)
    turns = [("user" if k % 2 == 0 else "assistant", f"turn {k}.") for k in range(6000)]
    for k in r.sample(range(6000), 400):
        turns[k] = (turns[k][0], r.choice(["", "cut", turns[0][1]]))
    rows = [(1, k, role, text) for k, (role, text) in enumerate(turns)] + [(2, 0, "user", "Hi."), (2, 1, "assistant", "Yes.")]
    out = {x["conv_id"]: x for x in repair.digests(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(1,), (2,)], "conv_id bigint"), 16).collect()}
    check(out[1], turns)
    assert out[2]["audit"] == "KK" and out[2]["cost"] == 0


def test_nulls_ties_repeats_and_empty_tables(spark):
    rows = [
        (None, 0, "user", "Null id."), (None, 1, "assistant", "Yes."), (3, None, None, None), (3, 5, "user", "b."), (3, 5, "assistant", "b."),
        (3, 7, "user", "c."), (3, 7, "user", "c."), (4, None, "user", "x."), (4, None, "user", "x."),
    ]
    df = spark.createDataFrame(rows, SCHEMA).fillna(" ", ["role", "text"])
    out = {x["conv_id"]: x for x in repair.digests(df, spark.createDataFrame([(None,), (3,), (4,), (5,)], "conv_id bigint")).collect()}
    assert out[None]["audit"] == "KK" and out[None]["gaps"] == 0
    check(out[3], [(" ", " "), ("assistant", "b."), ("user", "b."), ("user", "c."), ("user", "c.")])
    assert out[3]["gaps"] == 1 and out[4]["gaps"] == 0 and out[4]["duplicate"] == 1
    assert out[5]["audit"] == "" and out[5]["cost"] == 0 and out[5]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.digests(repair.damage(empty), empty.select("conv_id").distinct()).count() == 0


def test_damage_and_text_ids(spark):
    rows = [(f"c{i}", k, "system" if k == 0 else None, "One. Two! Three?") for i in range(40) for k in range(5)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id string, turn int, role string, text string, _kind int, n string")
    got = sorted(map(tuple, repair.damage(df).collect()))
    want = []
    for c, k, role, text in rows:
        kind, role = zlib.crc32(f"{c}:{k}".encode()) % 20, role or " "
        if kind:
            row = (c, k, "user" if kind == 4 else role, "" if kind == 1 else "One Two Three" if kind == 2 else text)
            want += [row] * (2 if kind == 3 else 1)
    assert got == sorted(want)
    assert repair.digests(repair.damage(df), df.select("conv_id").distinct()).count() == 40


def test_repaired_turns_are_legal(spark):
    rows = [(1, k, role, text) for k, (role, text) in enumerate(random_rows(random.Random(2), 30))]
    turns = repair.faults(spark.createDataFrame(rows, SCHEMA))
    out = repair.repaired_turns(turns, repair.repairs(turns)).orderBy("conv_id", "place").collect()
    assert GRAMMAR.fullmatch("".join(x["role"][0] for x in out)) and [x["place"] for x in out] == list(range(len(out)))


def test_matches_sql(spark, sf, duck):
    from lithosense.llm.queries import ORACLES, QUERIES
    from tests.oracle_check import compare

    same, why = compare(QUERIES["op12_conversation_repair"](spark, sf), duck, ORACLES["op12_conversation_repair"])
    assert same, why
