import hashlib
import random
import re
import string

from lithosense.llm import secrets
from lithosense.llm.secrets import Automaton


def plain(text):
    """The fixed patterns, written once more."""
    rules = {
        "assign": (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
        "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
        "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
    }
    found = [(m.start(), k, m.end(), name) for k, (name, (p, ok)) in enumerate(rules.items()) for m in re.finditer(p, text) if ok(m)]
    return [f"{name}:{a}:{b}" for a, _, b, name in sorted(found)]


def listed(spans):
    return [f"{s.kind}:{s.start}:{s.end}" for s in spans]


def test_base_spans_equal_the_plain_rules():
    r = random.Random(1)
    parts = ["password", "Token", "api_key", "APIKEY", "ſecret", "secret", "to", "=", ": ", "'", '"', "AKIA", "ABCDEFGHIJ12", "0123456789abcdef", "é", " ", "x.y-z", "\n", "toKen"]
    for _ in range(4000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 14)))
        assert listed(secrets.base_spans(text)) == plain(text), repr(text)


def test_a_dropped_match_still_takes_its_place():
    assert listed(secrets.base_spans("token: secret: abcdefgh1234")) == plain("token: secret: abcdefgh1234") == []


def test_automaton_learns_a_format():
    r = random.Random(2)
    keys = ["AKIA" + "".join(r.choice(string.ascii_uppercase + string.digits) for _ in range(16)) for _ in range(300)]
    a = Automaton(keys[:200])
    words = ["".join(r.choice(string.ascii_lowercase) for _ in range(20)) for _ in range(100)]
    worst = min(a.log_likelihood(k) for k in keys[200:])
    assert a.states < 100 and worst > max(a.log_likelihood(w) for w in words)


def test_merged_automaton_is_a_distribution():
    a = Automaton(["ab", "aab", "aaab", "b"] * 50)
    assert all(total == sum(c.values()) for total, c in zip(a.totals, a.count))
    assert all(set(c) - {""} == set(arcs) for c, arcs in zip(a.count, a.arcs))


def test_table(spark, docs):
    r = random.Random(3)

    def key():
        return "".join(r.choice("0123456789abcdef") for _ in range(18))

    rows = [(i, f"note password={key()} and mail{i}.example.com end") for i in range(60)]
    hidden = f"x {key()} y"
    rows += [(100, None), (101, ""), (102, hidden), (103, "z" * 50_000), (None, "password = 'abcdefgh1'"), (0, rows[0][1])]
    df = docs(rows).withColumnRenamed("lang", "spans")
    out = secrets.digests(secrets.scan(df, secrets.fit(df))).collect()
    assert len(out) == len(rows)
    by_id = {x["doc_id"]: x for x in out}
    for i, text in rows:
        base = ",".join(plain(text or ""))
        assert by_id[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert all(s in by_id[i]["spans"].split(",") for s in plain(text or ""))
    assert by_id[102]["spans"] == f"like_assign:2:{len(hidden) - 2}"
    assert by_id[100]["spans"] == by_id[103]["spans"] == "" and by_id[None]["n_assign"] == 1


def test_empty_table_and_nothing_labelled(docs):
    for df in (docs([]), docs([(1, "mail1.example.com/0123")])):
        out = secrets.digests(secrets.scan(df, secrets.fit(df)))
        assert [r["spans"] for r in out.collect()] == [""] * df.count()


def test_runs_of_all_lengths_and_without_digits_are_scored(docs):
    r = random.Random(4)

    def key(n, letters):
        return "".join(r.choice(letters) for _ in range(n))

    # no unlabelled length occurs among the labelled ones; the second format is longer than what is trained on
    hexes, others = "0123456789abcdef", "ghkmxyz0123456789"
    for letters, length, hidden in (
        (hexes, 18, [key(8, hexes), key(11, hexes), key(30, "abcdef"), key(31, hexes)]),
        (others, 150, [key(14, others), key(120, others), key(200, others)]),
    ):
        rows = [(i, f"note password={key(length, letters)} ordinary sentences without anything particular mail{i}.example.com") for i in range(300)]
        df = docs(rows + [(500 + i, f"x {v} y") for i, v in enumerate([*hidden, "particular"])])
        model = secrets.fit(df)
        assert sorted(model.automata) == ["assign"]
        spans = {x["doc_id"]: x["spans"] for x in secrets.digests(secrets.scan(df, model)).collect()}
        assert [spans[500 + i] for i in range(len(hidden) + 1)] == [*[f"like_assign:2:{2 + len(v)}" for v in hidden], ""]
        assert not any("like" in spans[i] for i, _ in rows)
