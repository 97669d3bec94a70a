import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from lithosense.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def codec():
    with open(PATH, "rb") as f:
        return bpe.Codec(bpe.Vocabulary.parse(f.read()), PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_equals_library_on_random_text(codec, library):
    r = random.Random(1)
    letters = "aabcdefgh thein' \n\t 0123₂½²éßñ日本語\x1c\x1f  _-+!'s're'réſK🙂\x00"
    for _ in range(3000):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 60)))
        assert codec.ids(text) == library.encode_ordinary(text), repr(text)


@pytest.mark.parametrize("text", ["", " ", "\n\n  x", "a" * 3000, " " * 3000, "ab" * 2000, "<|endoftext|>", "I'll we've they're"])
def test_equals_library_on_edges(codec, library, text):
    assert codec.ids(text) == library.encode_ordinary(text)


def test_append_and_replace_equal_a_fresh_table(codec):
    r = random.Random(2)
    v = codec.vocabulary
    for _ in range(200):
        data = "".join(r.choice("abcdehtn  ing") for _ in range(80)).encode()
        table = bpe.PrefixTable(v, data)
        a = r.randint(0, 80)
        b = r.randint(a, 80)
        new = "".join(r.choice("theing") for _ in range(r.randint(0, 9))).encode()
        table.replace(a, b, new)
        table.append(b"tion")
        fresh = bpe.PrefixTable(v, data[:a] + new + data[b:] + b"tion")
        assert table.last == fresh.last and table.ids() == fresh.ids()


def test_an_edit_stays_local(codec):
    table = bpe.PrefixTable(codec.vocabulary, b"the quick brown fox jumps over " * 100)
    assert table.replace(40, 45, b"white") < 2 * codec.vocabulary.longest + 10


def test_table_round_trip_with_odd_rows(spark, docs, library):
    rows = [(1, "Hello  wörld\n"), (2, None), (3, ""), (4, "x" * 50_000), (1, "Hello  wörld\n"), (None, "日本")]
    df = docs(rows).withColumnRenamed("lang", "n_tokens")
    coded = bpe.encode(df, PATH, PATTERN, digests=True)
    assert coded.columns == ["doc_id", "text", "source", "n_chars", "token_ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    out = bpe.decode(coded, PATH).collect()
    assert len(out) == len(rows)
    for r in out:
        ids = library.encode_ordinary(r["text"] or "")
        assert r["token_ids"] == ids and r["n_tokens"] == len(ids)
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()


def test_empty_table(docs):
    assert bpe.encode(docs([]), PATH, PATTERN, digests=True).count() == 0


def test_short_pieces_share_the_entries_of_their_prefixes(codec, library, monkeypatch):
    """A word of which all but the end was met before costs the new prefixes only, and equals the table and the library."""
    v = bpe.Vocabulary(codec.vocabulary.ranks)
    found, r = [], random.Random(3)
    find = v._find_last
    monkeypatch.setattr(v, "_find_last", lambda data: found.append(data) or find(data))
    for _ in range(500):
        data = "".join(r.choice("abcdeéhtn ing🙂") for _ in range(r.randint(1, 15))).encode()
        ids = v.short_ids(data)
        assert ids == bpe.PrefixTable(v, data).ids() == library._encode_single_piece(data)
    assert len(found) == len(set(found))
    before = len(found)
    v.short_ids(data)
    assert len(found) == before
