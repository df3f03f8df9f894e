"""Whole-text encoding with public tokenizer files, with a bounded cache of encoded words in each worker."""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from itertools import islice

import numpy as np

# The steps of a tokenizer that drops white space and folds case. A text's ids are then those of its words,
# one after another, and only special strings (all of which begin as below) are taken as written.
_NORMAL = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
_CUT = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            "behavior": "Removed", "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
_SPECIAL = "<|"
_END = "</w>"

#: Words that a worker keeps encoded within a task, and between tasks. The words met first stay, which are the common ones.
CACHE_WORDS, KEPT_WORDS = 250_000, 100_000
#: Words of the texts that are looked up together, and encoded together.
CHUNK_WORDS, PART_WORDS = 50_000, 4096

_open: dict[str, object] = {}
_words: dict[str, dict[bytes, bytes]] = {}
_wordwise: dict[str, bool] = {}
_TAIL = b".,;:!?%*&$#"
# The characters by which byte-level tokenizers write bytes: printable ones stand for themselves, others follow from U+0100 on.
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTES = {b: 0x100 + k for k, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))}


def _library(path: str):
    if path not in _open:
        if path.endswith(".model"):
            import sentencepiece

            _open[path] = sentencepiece.SentencePieceProcessor(model_file=path)
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            _open[path] = tokenizer
    return _open[path]


def version_digest(path: str) -> str:
    """SHA-256 over the tokenizer file and the version of the library that reads it."""
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    with open(path, "rb") as f:
        return hashlib.sha256(library.__version__.encode() + b"\0" + f.read()).hexdigest()


def wordwise(path: str) -> bool:
    """Whether the file's own steps are those under which a text may be encoded word by word."""
    if path not in _wordwise:
        _wordwise[path] = False
        if not path.endswith(".model"):
            with open(path, encoding="utf-8") as f:
                made = json.load(f)
            model = made["model"]
            _wordwise[path] = (
                made["normalizer"] == _NORMAL and made["pre_tokenizer"] == _CUT and not made["post_processor"]
                and model["type"] == "BPE" and model["end_of_word_suffix"] == _END and not model["dropout"]
                and all(t["content"].startswith(_SPECIAL) and not (t["lstrip"] or t["rstrip"] or t["normalized"]) for t in made["added_tokens"])
            )
    return _wordwise[path]


def _packed(ids) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


def _letter_words(path: str, cache: dict[bytes, bytes], words: list[bytes]) -> list[bytes]:
    """Encodes words of small letters, each of which is one piece; returns those that must take the library's whole way.

    Up to U+024F a small letter is its own normal form, so the pieces go to the file's merges as they are."""
    merges, rest = _library(path).model.tokenize, []
    for word in words:
        text = word.decode()
        if not text.islower() or not (text.isascii() or max(text) < "\u0250"):
            rest.append(word)
            continue
        piece = text if text.isascii() else word.decode("latin-1").translate(_BYTES)
        cache[word] = array("I", [x.id for x in merges(piece)]).tobytes()
    return rest


def _any_words(path: str, cache: dict[bytes, bytes], order: list[bytes]) -> None:
    for at in range(0, len(order), PART_WORDS):
        part = order[at : at + PART_WORDS]
        done = _library(path).encode([w.decode() for w in part], is_pretokenized=True, add_special_tokens=False)
        ids, owner = np.array(done.ids, dtype="<u4"), np.array(done.word_ids, dtype="int64")
        data, ends = ids.tobytes(), (4 * np.cumsum(np.bincount(owner, minlength=len(part)))).tolist()
        cache.update((w, data[s:e]) for w, s, e in zip(part, [0, *ends], ends, strict=False))


def _stands_alone(core: bytes) -> bool:
    """Whether marks after this word are a piece of their own: as the tokenizer sees it, its last character is a letter or digit."""
    if core[-1] < 128:
        return core[-1:].isalnum()
    last = unicodedata.normalize("NFC", core.decode()[-1]).lower()[-1]
    return unicodedata.category(last)[0] in "LN"


def _learn(path: str, cache: dict[bytes, bytes], new: set[bytes]) -> None:
    """Encodes words that the cache lacks. Trailing marks that are a piece of their own are looked up apart."""
    letters, others, parts, more = [], [], [], set()

    def sort(word: bytes) -> None:
        if word.isalpha() or (not word.isascii() and word.decode().isalpha()):
            letters.append(word)
        else:
            others.append(word)

    for word in new:
        core = word.rstrip(_TAIL)
        if len(core) == len(word) or not core or b"<|" in word or not _stands_alone(core):
            sort(word)
        else:
            tail = word[len(core) :]
            parts.append((word, core, tail))
            more.update(x for x in (core, tail) if x not in cache and x not in new)
    for word in more:
        sort(word)
    _any_words(path, cache, others + _letter_words(path, cache, letters))
    for word, core, tail in parts:
        cache[word] = cache[core] + cache[tail]


def encode(texts, path: str):
    """Yields the ids of each text (null: empty) as little-endian unsigned 32-bit bytes, no special tokens added."""
    if not wordwise(path):
        tokenizer = _library(path)
        for text in texts:
            if path.endswith(".model"):
                yield _packed(tokenizer.encode(text or "", num_threads=1))
            else:
                yield _packed(tokenizer.encode(text or "", add_special_tokens=False).ids)
        return
    cache = _words.setdefault(path, {})
    held, size = [], 0
    for text in texts:
        data = (text or "").encode()
        # special strings count as written, so case is folded only where there can be none; and a capital before a combining mark may
        # have no composed form where its small letter has one, so words with marks (U+0300 to U+036F) are left to the library as well
        if b"<|" in data:
            held.append(data.split())
        elif b"\xcc" in data or b"\xcd" in data:
            held.append([w if b"\xcc" in w or b"\xcd" in w else w.lower() for w in data.split()])
        else:
            held.append(data.lower().split())
        size += len(held[-1])
        if size >= CHUNK_WORDS:
            yield from _joined(path, cache, held)
            held, size = [], 0
    yield from _joined(path, cache, held)


def _trim(cache: dict[bytes, bytes]) -> None:
    if len(cache) > KEPT_WORDS:
        first = list(islice(cache.items(), KEPT_WORDS))
        cache.clear()
        cache.update(first)


def forget() -> None:
    """At the end of a task, keeps only the words that were met first."""
    for cache in _words.values():
        _trim(cache)


def _joined(path: str, cache: dict[bytes, bytes], texts: list[list[bytes]]):
    new = set().union(*texts).difference(cache)
    if new:
        if len(cache) > CACHE_WORDS:
            _trim(cache)
            new = set().union(*texts).difference(cache)
        _learn(path, cache, new)
    for words in texts:
        yield b"".join([cache[w] for w in words])
