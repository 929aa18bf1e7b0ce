import random

import pyarrow as pa
import pytest
import tiktoken

from lakeline.llm import tokens

SCHEMA = "doc_id long, text string, ids string, n int"
ALPHA = list("ab zAÆøå'’…\n\n\t  　\u0085s'tllre09²½,.!?-–—§€😀👍🏽éłżß  ᠎​  ")


@pytest.fixture(scope="module")
def plain():
    ranks = tokens._ranks(tokens.read_vocabulary())
    return tiktoken.Encoding("plain", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(n, seed=0):
    r = random.Random(seed)
    return ["".join(r.choices(ALPHA, k=r.randrange(60))) for _ in range(n)]


def test_same_as_the_whole_text_at_once(plain):
    t = [*texts(20_000), "<|endoftext|>", "", None, "x", "Rød grød med fløde. " * 20_000, "a" * 5_000, " " * 5_000, "§'s é's ll'll"]
    ids, at = tokens.encoder(tokens.read_vocabulary()).encode(pa.array(t))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [plain.encode_ordinary(x or "") for x in t]


def test_cuts_are_inside_no_token():
    ranks = tokens._ranks(tokens.read_vocabulary())
    forced = tokens.forced_pairs(ranks)
    assert 0 < forced.sum() < 65536
    assert not any(forced[t[i] * 256 + t[i + 1]] for t in ranks for i in range(len(t) - 1))


def test_column(spark, plain):
    rows = [(i, t, "clash", i) for i, t in enumerate([*texts(300, 2), None, "", "  ", "hej"])]
    rows += rows[:5]
    df = spark.createDataFrame(rows, SCHEMA)
    got = tokens.encode_column(df, "text")
    assert got.columns == ["doc_id", "n", "ids"]
    assert sorted((r.doc_id, tuple(r.ids)) for r in got.collect()) == sorted((i, tuple(plain.encode_ordinary(t or ""))) for i, t, *_ in rows)
    counts = tokens.count_tokens(df, "text").collect()
    assert sorted((r.doc_id, r.n_tokens) for r in counts) == sorted((i, len(plain.encode_ordinary(t or ""))) for i, t, *_ in rows)
    assert tokens.encode_column(df.limit(0), "text").count() == 0


def test_round_trip(spark, plain):
    t = "Smørrebrød – 3 stk. à 45 kr.\n\n😀 ﬁ"
    ids = tokens.encode_column(spark.createDataFrame([(1, t, None, 0)], SCHEMA), "text").first().ids
    assert plain.decode(ids) == t
