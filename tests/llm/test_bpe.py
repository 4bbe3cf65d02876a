import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from corpus_fixtures import edge_docs, no_docs  # noqa: F401  (fixtures)
from regpanel.llm import op3_bpe, queries

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def both():
    path = queries.vocabulary_path()
    return op3_bpe.Codec(op3_bpe.Vocabulary.load(path)), tokenizers.Tokenizer.from_file(path)


def same(both, text):
    codec, library = both
    ids = library.encode(text, add_special_tokens=False).ids
    assert codec.encode(text) == ids, text
    assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_hand_made(both):
    for text in ("", " ", "Hello, World's 123 ÀÉ", "a\x1cb\x85c d", "ΑΣ ΣΑΣ.", "İstanbul", "<|endoftext|> x<|startoftext|>Y <|endoftext|", "aaaaaaaaaaaaaaaa",
                 "''s 'S it's 'll", "日本語テキスト", "éé", "\U0001f600\U0001f680!!!???", "thethethe" * 50):
        same(both, text)


def test_random_letters(both):
    rng = random.Random(5)
    for _ in range(300):
        same(both, "".join(rng.choice("aeinorst '.,é") for _ in range(200)))


def test_every_token_string(both):
    codec, library = both
    names = [n.removesuffix("</w>") for n in codec.vocabulary.tokens][::7]
    for n, e in zip(names, library.encode_batch(names, add_special_tokens=False)):
        assert codec.encode(n) == e.ids, n


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8", categories=("Lu", "Ll", "Nd", "Po", "Zs"), max_codepoint=0x24F), max_size=60))
def test_any_latin_text(both, text):
    same(both, text)


def test_backtracking_equals_the_merge_process():
    merges = [("a", "b"), ("b", "c"), ("c</w>", ""), ("ab", "c")]
    names = ["a", "b", "c", "a</w>", "b</w>", "c</w>", "bc", "ab", "abc</w>", "bc</w>", "aa"]
    ids = {n: i for i, n in enumerate(names)}
    order = [("b", "c", "bc"), ("b", "c</w>", "bc</w>"), ("a", "b", "ab"), ("a", "a", "aa"), ("ab", "c</w>", "abc</w>")]
    vocabulary = op3_bpe.Vocabulary(tuple(names), tuple((ids[a], ids[b], ids[c]) for a, b, c in order), ())
    codec = op3_bpe.Codec(vocabulary)
    codec.letters = [chr(b) for b in range(256)]

    def plain(word):
        parts = [*word[:-1], word[-1] + "</w>"]
        while True:
            found = [(r, i) for i in range(len(parts) - 1) for r, (a, b, _) in enumerate(order) if (a, b) == (parts[i], parts[i + 1])]
            if not found:
                return [ids[p] for p in parts]
            r, i = min(found)
            parts[i:i + 2] = [order[r][2]]

    rng = random.Random(1)
    for _ in range(500):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 12)))
        assert np.frombuffer(codec.word(word), dtype="<u4").tolist() == plain(word), word
    assert merges


def test_edge_rows(edge_docs, no_docs, both):
    vocabulary = op3_bpe.Vocabulary.load(queries.vocabulary_path())
    out = op3_bpe.encode_documents(edge_docs, vocabulary, keep_ids=True).collect()
    assert len(out) == edge_docs.count()
    texts = {r.doc_id: r.text or "" for r in edge_docs.collect()}
    for r in out:
        assert r.ids == both[1].encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)
    assert op3_bpe.encode_documents(no_docs, vocabulary).collect() == []
