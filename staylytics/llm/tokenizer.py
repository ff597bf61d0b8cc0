"""Public vocabularies, read once on the driver and sent to the tasks (under 2 MB each)."""

from __future__ import annotations

import base64
import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np
import sentencepiece
import tiktoken
import tokenizers

#: Where the vocabularies lie; every operator takes another path as a parameter.
FOLDER = "/opt/tokenizers"
VOCABULARY = f"{FOLDER}/byte_bpe_50k.tiktoken"
BYTE_VOCABULARY = f"{FOLDER}/byte_bpe_50k.json"
WORD_VOCABULARY = f"{FOLDER}/word_bpe_49k.json"
PIECE_VOCABULARY = f"{FOLDER}/piece_bpe_32k.model"
#: Fixed value: how the byte vocabulary splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def read_vocabulary(path: str = VOCABULARY) -> bytes:
    with open(path, "rb") as f:
        return f.read()


@lru_cache(maxsize=2)
def encoding(vocabulary: bytes) -> tiktoken.Encoding:
    """The encoding of a vocabulary file's content; a worker builds it once."""
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def tokenizer(vocabulary: bytes, plain_specials: bool = False) -> tokenizers.Tokenizer:
    """A vocabulary file of the tokenizers library; with ``plain_specials`` special tokens' strings are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    found = tokenizers.Tokenizer.from_buffer(vocabulary)
    found.encode_special_tokens = plain_specials
    return found


@lru_cache(maxsize=2)
def byte_level_encoding(vocabulary: bytes) -> tiktoken.Encoding:
    """The same ids as ``tokenizer(vocabulary, plain_specials=True)`` gives for a byte-level vocabulary, several times faster.

    Its ids must be numbered in the order of its merges, so that an id is the rank of its merge.
    """
    model = json.loads(vocabulary)["model"]
    merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if merged != list(range(256, 256 + len(merged))):
        raise ValueError("ids are not in the order of merges")
    ranks = {token: i for i, token in enumerate(byte_level_tokens(vocabulary)) if i < 256 + len(merged)}
    return tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def pieces(vocabulary: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=vocabulary)


def byte_characters() -> list[str]:
    """The character for each byte in byte-level vocabularies: printable Latin-1 stands for itself, others are U+0100 and on, in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


def byte_level_tokens(vocabulary: bytes) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary."""
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    names = tokenizer(vocabulary, True).get_vocab()
    out = [b""] * (max(names.values()) + 1)
    for name, i in names.items():
        out[i] = bytes(byte_of[c] for c in name) if all(c in byte_of for c in name) else name.encode()
    return out


def piece_tokens(vocabulary: bytes) -> list[bytes]:
    """The bytes of every id of a piece vocabulary: U+2581 is a space, <0xHH> one byte."""
    model = pieces(vocabulary)
    names = map(model.id_to_piece, range(model.vocab_size()))
    return [bytes([int(n[3:5], 16)]) if re.fullmatch(r"<0x[0-9A-F]{2}>", n) else n.replace("▁", " ").encode() for n in names]


#: Texts of these characters only are split into words here: ASCII without DEL, Latin letters without those whose small form has another
#: length, and punctuation. Normalisation leaves them as they are, and lower case goes letter by letter.
_PLAIN = re.compile(r"[\x00-\x7e\xa1-\xa9\xab-\xb1\xb4\xb6-\xb8\xbb\xbf-įı-ňŊ-ž‐-‧‰-⁞€]*")
_LETTERS = r"a-z\xdf-\xf6\xf8-ž"
#: What the word vocabulary splits lower-case text into: contractions, runs of letters, digits one by one, runs of the rest.
_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\x20\x09-\x0D0-9{_LETTERS}]+")


class _Words(dict):
    """Numbers of words in order of first use; ``ids`` of word number k lie from ``starts[k]`` up to ``starts[k + 1]``."""

    def __init__(self, model: tokenizers.models.Model):
        super().__init__()
        self.merge = model.tokenize  # a word by itself, without normalising and splitting it again
        self.shown = str.maketrans(dict(zip(map(chr, range(256)), byte_characters(), strict=True)))
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.ids, self.starts = array("i"), array("q", [0])

    def __missing__(self, word: str) -> int:
        plain = word.isascii() and word.isprintable()  # without spaces, as all words are
        shown = word if plain else word.encode().decode("latin-1").translate(self.shown)
        self.ids.extend(token.id for token in self.merge(shown))
        self.starts.append(len(self.ids))
        self[word] = number = len(self)
        return number


class WordEncoder:
    """Ids of texts by the word vocabulary. Words never merge across their edges, so each distinct one is encoded once and remembered.

    The same ids as ``encode(text, add_special_tokens=False)``: texts with other than Latin characters or with
    something like a special token go to the tokenizer whole.
    """

    def __init__(self, vocabulary: bytes, remembered: int = 300_000):
        self.tokenizer = tokenizer(vocabulary)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words, self.remembered = _Words(self.tokenizer.model), remembered

    def encode(self, text: str) -> np.ndarray:
        if not _PLAIN.fullmatch(text) or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.int32)
        if len(self.words) > self.remembered or len(self.words.ids) > 8 * self.remembered:
            self.words.forget()
        found = _WORDS.findall(text.lower())
        numbers = np.fromiter(map(self.words.__getitem__, found), dtype=np.int64, count=len(found))
        starts = np.frombuffer(self.words.starts, dtype=np.int64)
        first = starts[numbers]
        return np.frombuffer(self.words.ids, dtype=np.int32)[runs(first, starts[numbers + 1] - first)]


@lru_cache(maxsize=2)
def word_encoder(vocabulary: bytes) -> WordEncoder:
    """A worker's encoder, with the words it remembers from earlier tasks."""
    return WordEncoder(vocabulary)


def runs(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first[k], first[k] + 1, ... for sizes[k] numbers, one run after the other."""
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
