import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tickerloom.llm import encoding
from tickerloom.llm.text import alphanumeric, blank_separated, flat, slices, words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbZ é\t\n ,.\x0b'日", max_size=30)), max_size=8)


def split(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in lowered.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").split(" ") if w]


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_are_hashed_alike_wherever_they_stand(texts):
    hashes, offsets = words(*flat(pa.array(texts, pa.string())), blank_separated())
    expected = [split(t) for t in texts]
    assert [len(x) for x in expected] == list(np.diff(offsets))
    flat_words = [w for x in expected for w in x]
    by_word = dict(zip(flat_words, hashes))
    assert [by_word[w] for w in flat_words] == list(hashes)
    assert len(set(by_word.values())) == len(by_word)


def test_alphanumeric_words():
    hashes, offsets = words(*flat(pa.array(["Ab, c-D!", "ab c d", "", "..."])), alphanumeric())
    assert list(offsets) == [0, 3, 6, 6, 6] and list(hashes[:3]) == list(hashes[3:])


def test_slices_keep_every_row_and_follow_the_text():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (0, 5, 50, 1, 1, 0)])], names=["text"])
    parts = list(slices(iter([batch, batch.slice(0, 0)]), "text", most=10))
    assert [t for p in parts for t in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert max(p.num_rows for p in parts) < 6


ODD = ["", None, " a", "a ", "a  b", "a\n\nb", "a\tb", "it's  <|endoftext|> x", "<|endoftext|>", "a\x1cb c", "x y z",
       "don't 'quote' we'll", "\n", " ", "a\n b", "日本語 テスト。", "é é", "😀 😀", "12,345.67 a1b2", "a​b c", "\x85 n", "a\r\nb"]


@pytest.fixture(scope="module")
def exact():
    from tokenizers import Tokenizer

    path = encoding.vocabulary_path()
    tokenizer = Tokenizer.from_file(path)
    return path, lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids


def agree(exact, texts):
    path, reference = exact
    texts = [t.encode("utf-8", "replace").decode() if t else t for t in texts]
    got = [list(ids) for ids in encoding.encode(pa.array(texts, pa.string()), path)]
    assert got == [reference(t) for t in texts]


def test_ids_are_those_of_tokenizers_on_odd_texts(exact):
    agree(exact, ODD)
    for text in ODD:
        agree(exact, [text])
    agree(exact, [])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("aB1 \n\t.,'sé"), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=6))
def test_ids_are_those_of_tokenizers(exact, texts):
    agree(exact, texts)
