"""Token ids of whole texts under the public byte-level BPE vocabulary.

A text is cut where a word follows a single space or line feed; such a place is always a boundary of
the vocabulary's own word pattern, so the pieces are encoded alike alone, in their text and in any other
order. The distinct pieces of a slice of texts are strung together and encoded in one call, and each
text's ids are gathered from them. Texts with any other white space go through the encoder whole. A
text that spells out a special token goes through ``tokenizers``, which reads it as that token; the ids
are those of ``tokenizers`` throughout (``tests/llm/test_encoding.py``).
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPECIAL = "<|endoftext|>"
SLICE_BYTES = 4 << 20  # larger slices repeat more pieces
# Empty texts, blanks beside another blank or at an end, and white space that is neither a space nor a line feed.
_UNUSUAL = ("^$|^[ \\n]|[ \\n]$|[ \\n][ \\n]|[\\x00-\\x09\\x0b-\\x1f\\x7f\\x{80}-\\x{a0}\\x{1680}\\x{180e}"
            "\\x{2000}-\\x{200f}\\x{2028}-\\x{202f}\\x{205f}-\\x{2064}\\x{3000}\\x{feff}]")


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def _exact(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.cache
def _ranks(path: str):
    import public_tokenizers
    import tiktoken

    with open(path.removesuffix(".json") + ".tiktoken", "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def _token_bytes(path: str) -> np.ndarray:
    encoding = _ranks(path)
    return np.array([len(encoding.decode_single_token_bytes(i)) for i in range(encoding.n_vocab)], np.int64)


def _encode_whole(text: str, path: str) -> np.ndarray:
    if SPECIAL in text:
        ids = _exact(path).encode(text, add_special_tokens=False).ids
    else:
        ids = _ranks(path).encode_ordinary(text)
    return np.array(ids, np.uint32)


def _encode_pieces(pieces: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all pieces, one after another, and how many each has.

    Every piece begins with a blank and has none elsewhere, so it stays apart from its neighbours.
    """
    if not len(pieces):
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    text = b"".join(pieces.cast(pa.large_binary()).to_pylist()).decode()
    ids = _ranks(path).encode_to_numpy(text, disallowed_special=()).astype(np.uint32)
    ends = np.cumsum(_token_bytes(path)[ids])
    piece_ends = np.cumsum(pc.binary_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64))
    last = np.searchsorted(ends, piece_ends)
    if not np.array_equal(ends[last], piece_ends):
        raise ValueError("a token spans two pieces")
    return ids, np.diff(last + 1, prepend=0)


def _gather(pool: np.ndarray, sizes: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of piece ``i`` for every ``i`` of ``index``, one after another, and their counts."""
    begins = np.cumsum(sizes) - sizes
    counts = sizes[index]
    place = np.repeat(begins[index] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    return pool[place], counts


def encode(column: pa.Array, path: str) -> Iterator[np.ndarray]:
    """The ids of every text; NULL is an empty text."""
    texts = column.cast(pa.large_string()).fill_null("")
    odd = pc.or_(pc.match_substring_regex(texts, _UNUSUAL), pc.match_substring(texts, SPECIAL)).to_numpy(zero_copy_only=False)
    plain = texts.filter(pa.array(~odd))
    split = pc.split_pattern(pc.replace_substring(plain, "\n", " \n"), " ")
    offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
    coded = split.flatten().dictionary_encode()
    words, index = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    none, space, feed = (pa.scalar(x, pa.large_string()) for x in ("", " ", "\n"))
    blank = pc.if_else(pc.starts_with(words, "\n"), none, space)
    # A text's first word has no blank before it: such words are numbered apart, and encoded after a
    # line feed whose own id is then left out.
    first = offsets[:-1]
    opening, opening_index = np.unique(index[first], return_inverse=True)
    index[first] = len(words) + opening_index
    after_feed = pc.binary_join_element_wise(feed, words.take(pa.array(opening)), none)
    pieces = pa.concat_arrays([pc.binary_join_element_wise(blank, words, none), after_feed])
    pool, sizes = _encode_pieces(pieces, path)
    pool = np.delete(pool, (np.cumsum(sizes) - sizes)[len(words):])
    sizes[len(words):] -= 1
    ids, counts = _gather(pool, sizes, index)
    ends = np.concatenate([[0], np.cumsum(counts)])[offsets]
    at = 0
    for i, unusual in enumerate(odd):
        if unusual:
            yield _encode_whole(texts[i].as_py(), path)
        else:
            yield ids[ends[at]:ends[at + 1]]
            at += 1
