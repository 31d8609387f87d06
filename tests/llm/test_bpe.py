from __future__ import annotations

import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from regionpulse.llm import bpe

LIBRARY = Tokenizer.from_file(bpe.vocabulary_path())
CODEC = bpe.Codec(open(bpe.vocabulary_path(), encoding="utf-8").read())


def same(text):
    ids = CODEC.encode(text, bpe.Memory(CODEC))
    assert ids == LIBRARY.encode(text, add_special_tokens=False).ids
    assert CODEC.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_equals_the_library_on_any_text(text):
    same(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é'stdlm01 \n\t\r\x0b\x1c\x85  　.<|>endoftx😀", max_size=60))
def test_equals_the_library_on_spaces_and_marks(text):
    same(text)


def test_equals_the_library_on_words_and_long_pieces():
    rng = random.Random(5)
    for n in (1, 10, 3000):
        same(" ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 12))) for _ in range(n)))
    same("a" * 5000)
    same("x<|endoftext|>y <|endoftext|><|endoftext|>")
    assert CODEC.decode([CODEC.start[0xC3]]) == "�"


def test_query(spark, folder):
    rows = [(0, None), (1, ""), (2, "It's 42 naïve  tests\n"), (2, "It's 42 naïve  tests\n"), (None, "w " * 30_000), (4, "<|endoftext|>")]
    out = bpe.query(spark, folder(rows)).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in rows:
        ids = LIBRARY.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids, skip_special_tokens=False))))
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, out), key=key) == sorted(want, key=key)
    assert bpe.query(spark, folder([])).count() == 0


def test_ids(docs):
    out = bpe.encode(docs([(1, "the cat"), (2, None)])).collect()
    assert {r.doc_id: r.token_ids for r in out} == {1: LIBRARY.encode("the cat").ids, 2: []}
