"""Token ids: exact round trips through grammars, files and readers."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given as over
from hypothesis import settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from hailmeter.llm import grammar, tokenids
from hailmeter.session import work_dir

from . import brute

PATH = public_tokenizers.path(tokenids.VOCABULARY)


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


@settings(max_examples=100, deadline=None)
@over(st.lists(st.lists(st.integers(0, 4), min_size=1, max_size=200), min_size=1, max_size=5))
def test_grammar_round_trip(texts):
    ids = np.array([x for t in texts for x in t])
    counts = np.array([len(t) for t in texts])
    made = grammar.re_pair(ids, counts, least_count=2, least_gain=0.0)
    again, names, known = grammar.from_bytes(
        grammar.to_bytes(made, np.arange(len(texts)), np.ones(len(texts), bool))
    )
    assert np.array_equal(again.expand(again.symbols), ids)
    for i, text in enumerate(texts):
        assert again.document(i).tolist() == text
    for a in range(0, len(ids), 37):
        assert again.ids(a, a + 23).tolist() == ids[a : a + 23].tolist()
    assert made.expansion(made.symbols).sum() == len(ids)


def test_grammar_shortens_repeats():
    one = [7, 8, 9, 10, 11, 12, 13, 14] * 64
    made = grammar.re_pair(np.array(one), np.array([len(one)]))
    assert len(made.symbols) < len(one) / 16 and len(made.left)
    # rules use earlier ones, and the more frequent pair is replaced first
    made = grammar.re_pair(np.array([1, 2] * 50 + [2, 3] * 10), np.array([120]))
    assert (made.left[0], made.right[0]) == (1, 2)
    with pytest.raises(ValueError):
        grammar.from_bytes(b"none of ours")


ODD = [
    "  two  spaces", "tail ", " head", "a\n\n b", "tab\t x", "nbsp  x  y", "  wide 　z",
    "don't 'll it's", "x <|endoftext|> y", " \n <|endoftext|>", "12 34 5", "émile É ß 漢字 かな", "😀 😀",
    "a" * 500, "\x00 \x7f", "...  !!! ???", "\r\n line", "",
]


def test_pieces_give_the_ids_of_whole_texts(spark, plain, awkward):
    rng = random.Random(4)
    letters = ["a", "B", " ", "  ", "\n", "'s", ".", "9", "é", " ", "\t", "-"]
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    path = work_dir(spark, "tokens-test")
    tokenids.write_tokens(docs, path, block_ids=500)
    got = tokenids.read_documents(spark, path).orderBy("doc_id").collect()
    assert [r.ids for r in got] == [plain(t) for t in texts]
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    whole = [x for r in got for x in r.ids]
    assert spark.read.parquet(f"{path}/blocks").count() == 4
    for a, b in ((0, 7), (490, 1700), (len(whole) - 3, len(whole) + 9), (5, 5)):
        parts = tokenids.read_ids(spark, path, a, b).orderBy("start").collect()
        assert [x for p in parts for x in p.ids] == whole[a:b]


def test_a_worker_that_forgets(monkeypatch, plain):
    import pyarrow as pa

    from hailmeter.llm import tokens

    monkeypatch.setattr(tokenids, "MEMORY_IDS", 3)
    encoder = tokenids.Encoder(PATH)
    for text in ["one two three one", "three two", "one", "two one"]:
        (chunk,) = tokens.chunks(pa.array([text]))
        ids, counts = encoder.encode(chunk)
        assert [*ids.tolist(), 0] == plain(text) and counts.tolist() == [len(ids)]


@pytest.mark.parametrize("name", ["given", "awkward"])
def test_rows_equal_brute_force(request, given, awkward, plain, name):
    docs = given("documents") if name == "given" else awkward
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    # rows of one doc_id come in any fixed order: compare their checksums and the starts
    want, start = [], 0
    got = sorted(tokenids.token_digests(docs).collect(), key=lambda r: r.start)
    assert [brute.place(r.doc_id) for r in got] == sorted(brute.place(d) for d, _ in rows)
    for r in got:
        assert r.start == start
        start += r.n_tokens
    for doc_id, text in rows:
        ids = plain(text)
        want.append((doc_id, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)


def test_heavy_doc_id_is_spread(spark):
    docs = spark.range(3000).selectExpr(
        "if(id % 3 = 0, null, id) AS doc_id", "if(id % 2 = 0, 'same text', concat('text ', id)) AS text"
    )
    path = work_dir(spark, "tokens-heavy")
    tokenids.write_tokens(docs, path, tasks=12)
    by_part = spark.read.parquet(f"{path}/blocks").groupBy("part").sum("n_docs").collect()
    assert len(by_part) >= 10 and max(r[1] for r in by_part) < 600


def test_empty_and_clashing(spark, nothing, awkward, clashing):
    assert tokenids.token_digests(nothing).count() == 0
    plain_rows = sorted(map(repr, tokenids.token_digests(awkward).collect()))
    assert sorted(map(repr, tokenids.token_digests(clashing(awkward)).collect())) == plain_rows


def test_pieces_that_lose_their_place_are_encoded_again(monkeypatch, plain):
    import pyarrow as pa

    from hailmeter.llm import tokens

    monkeypatch.setattr(tokenids, "MEMORY_BITS", 1)
    encoder = tokenids.Encoder(PATH)
    texts = ["one two three four five one", "", "six five four", "three two one é 😀  x", "one two"]
    for _ in range(2):
        (chunk,) = tokens.chunks(pa.array(texts))
        ids, counts = encoder.encode(chunk)
        cut = np.split(ids, np.cumsum(counts)[:-1])
        assert [[*c.tolist(), 0] for c in cut] == [plain(t) for t in texts]
        assert len(encoder.names) == 2


def test_later_rounds_of_a_grammar_leave_rare_pairs_out(monkeypatch):
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 40_000, 30_000)
    ids[:15_000] = rng.integers(0, 9, 15_000)
    met, pairs = [], grammar._pairs

    def counted(symbols, at, seed):
        met.append((len(at), len(symbols)))
        return pairs(symbols, at, seed)

    monkeypatch.setattr(grammar, "_pairs", counted)
    made = grammar.re_pair(ids, np.array([10_000, 0, 20_000]))
    assert made.expand(made.symbols).tolist() == ids.tolist()
    assert met[0][0] == 29_998 and len(met) > 3
    assert all(2 * n < symbols for n, symbols in met[2:])
