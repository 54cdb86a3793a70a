"""Token ids of whole texts, looked up word by word.

The vocabulary's pre-tokeniser never lets a token cross ASCII white space, and
its normaliser composes nothing across it, so the ids of a text are those of
its words in a row. Words repeat; each distinct one is encoded once per worker.

Most new words are letters with ASCII marks behind them. The pre-tokeniser cuts
between a letter or digit and such a mark, so both sides are looked up alone. A
lower-case word of ASCII and Latin-1 letters is one piece that the normaliser
leaves as it is: it goes straight to the library's merges. All else takes the
library's full way, as does every word if a vocabulary has other rules.
"""

from __future__ import annotations

import functools
import json
import os
import struct

import numpy as np

END_ID = 1
# words remembered by a worker before it starts afresh
CACHE_WORDS = 1 << 19

# the rules under which words are cut and shortened; an added token holds _ADDED
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_PRE_TOKENIZERS = [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
_ADDED = b"<|"
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
# bytes of a text without characters from U+0300 on
_BELOW_U0300 = bytes(range(0xCC))
# the character that stands for a byte in the vocabulary, where it is not the byte's own
_BYTE_CHARS = {b: 256 + i for i, b in enumerate([*range(33), *range(127, 161), 173])}


def _ends_in_letter_or_digit(word: bytes) -> bool:
    """Whether the last character is an ASCII letter or digit, or a letter from U+00C0 to U+00FF."""
    last = word[-1]
    return word[-1:].isalnum() if last < 128 else word[-2] == 0xC3 and last not in (0x97, 0xB7)


class _Known(dict):
    """Ids of words by their bytes; a new word is encoded when it is looked up."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer, self.tokenize = tokenizer, tokenizer.model.tokenize
        rules = [json.loads(x.__getstate__()) if x else {} for x in (tokenizer.normalizer, tokenizer.pre_tokenizer)]
        added = [t.content.encode() for t in tokenizer.get_added_tokens_decoder().values()]
        self.cuts = (
            rules[0].get("normalizers") == _NORMALIZERS and rules[1].get("pretokenizers") == _PRE_TOKENIZERS
            and tokenizer.post_processor is None and all(_ADDED in t for t in added)
        )

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        if not self.cuts or _ADDED in word:
            ids = self._whole(word)
        elif word.isalpha() and word.islower():
            ids = self._letters(word.decode())
        else:
            head = word.rstrip(_MARKS)
            if 0 < len(head) < len(word) and _ends_in_letter_or_digit(head):
                ids = self[head] + self[word[len(head) :]]
            else:
                ids = self._piece(word)
        self[word] = ids
        return ids

    def _piece(self, word: bytes) -> bytes:
        text = word.decode()
        if not text.isalpha() or max(text) > "\xff":
            return self._whole(word)
        if (low := text.lower()) != text:
            return self[low.encode()]
        return self._letters(word.decode("latin-1").translate(_BYTE_CHARS))

    def _letters(self, chars: str) -> bytes:
        ids = [t.id for t in self.tokenize(chars)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _whole(self, word: bytes) -> bytes:
        ids = self.tokenizer.encode_batch_fast([word.decode()], add_special_tokens=False)[0].ids
        return struct.pack(f"<{len(ids)}I", *ids)


class WordIds:
    def __init__(self, path: str, end_id: int = END_ID) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.end = struct.pack("<I", end_id)
        self.known = _Known(Tokenizer.from_file(path))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, with the end id; null counts as empty."""
        return [b"".join(map(self.known.__getitem__, self._words(t))) + self.end if t else self.end for t in texts]

    def _words(self, text: str) -> list[bytes]:
        raw = text.encode()
        # the normaliser does this too, but not to added tokens, and after it has put letters and combining marks together
        if self.known.cuts and _ADDED not in raw and not raw.translate(None, _BELOW_U0300):
            raw = raw.lower()
        return raw.split()


@functools.lru_cache(2)
def encoder(path: str, end_id: int = END_ID) -> WordIds:
    """The worker's encoder; it and its words outlive a task."""
    return WordIds(path, end_id)


def parts(batch, text_col: str, most_bytes: int = 4 << 20):
    """Slices of an Arrow batch that hold about ``most_bytes`` of text, a row at least."""
    import pyarrow.compute as pc

    size = np.cumsum(pc.fill_null(pc.binary_length(batch[text_col]), 0).to_numpy(zero_copy_only=False)) if len(batch) else []
    lo = 0
    while lo < len(batch):
        before = size[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(size, before + most_bytes, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi
