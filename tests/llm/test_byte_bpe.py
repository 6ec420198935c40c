import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from weftline.llm import byte_bpe, token_counts

RANKS, VOCAB = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")


def texts(seed, n=200):
    rng = random.Random(seed)
    alphabet = "abcdefghijklmnop'stdlm  \n\t0123456789.,!?#éßñ漢字🙂  \x1c"
    out = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 300))) for _ in range(n)]
    return out + ["", " ", "\n\n \n", "a" * 3000, " " * 3000, "it's we'll they'd   x", "the of and " * 500]


def test_same_ids_as_the_library_and_back():
    c = byte_bpe.codec(RANKS, P.PATTERN)
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=c.ranks, special_tokens={})
    for t in texts(1):
        ids = c.encode(t)
        assert ids == b",".join(b"%d" % i for i in lib.encode_ordinary(t))
        assert c.decode(ids) == t.encode()


def test_perfect_hash_is_minimal():
    c = byte_bpe.codec(RANKS, P.PATTERN)
    assert sorted(c.whole(t) for t in c.ranks) == list(range(len(c.ranks)))


def test_a_full_memory_changes_nothing():
    small, c = byte_bpe.Codec(byte_bpe.read_ranks(RANKS), P.PATTERN, remember=3), byte_bpe.codec(RANKS, P.PATTERN)
    assert all(small.encode(t) == c.encode(t) for t in texts(2, 30))


def test_rows(spark):
    rows = [(1, "some text", "a"), (1, "some text", "a"), (2, None, None), (None, "", "x"), (3, "wörd " * 2000, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = byte_bpe.round_trips(docs, RANKS, P.PATTERN).collect()
    assert sorted(r.decoded_sha256 for r in out) == sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t, _ in rows)
    coded = byte_bpe.encode_documents(docs, RANKS, P.PATTERN)
    assert sorted(r.text for r in byte_bpe.decode_documents(coded, RANKS, P.PATTERN).collect()) == sorted(t or "" for _, t, _ in rows)
    assert byte_bpe.round_trips(docs.where("false"), RANKS, P.PATTERN).collect() == []


@pytest.mark.parametrize(("chunk", "overlap"), [(1 << 14, 256), (64, 8), (16, 4)])
def test_counts_are_the_librarys(chunk, overlap):
    lib, c = Tokenizer.from_file(VOCAB), token_counts.counter(VOCAB, P.PATTERN)
    for t in [*texts(3), "a <|endoftext|> b<|endoftext|>", "<|endoftext|>" * 3, "x y " * 9000, "<|endoftext|", "no space" * 4000]:
        assert c.count(t, chunk, overlap) == len(lib.encode(t, add_special_tokens=False).ids)


def test_count_rows(spark):
    rows = [(1, "some text", "a"), (2, None, None), (None, "", "x"), (3, "wörd " * 2000, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = {r.id: r for r in token_counts.token_counts(docs, VOCAB, P.PATTERN, 1024).collect()}
    assert got[1].n_tokens == 2 and not got[1].over_limit and got[2].n_tokens == 0 and got[3].over_limit and got[3].n_bytes == 12000
    assert token_counts.token_counts(docs.where("false"), VOCAB, P.PATTERN, 1024).collect() == []
