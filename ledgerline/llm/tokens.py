"""Token ids of Arrow text columns, for tokenizers whose tokens never span white space."""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerline.llm.common import SPACE_LOWER, SPACE_ONLY, codes, words

# Words whose ids a Python worker keeps; beyond that it starts anew.
WORDS_KEPT = 250_000
LINE_WORDS = 200


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    """Path of a public vocabulary file of the machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Encodes each distinct word of a slice once and keeps the ids for the next.

    ``path`` names a ``tokenizers`` file that drops white space and case and parts
    letters and digits from marks, such as ``word_bpe_49k.json``: its ids for a text
    are those of the text's words, one after the other, also when A-Z are made small
    and a blank is put before a ``.`` or ``,`` that follows a letter or digit. No
    special token is added; those that stand in a text are found as ever.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.ends[[number for token, number in vocabulary.items() if token.endswith(suffix)]] = True
        self._start()

    def _start(self) -> None:
        self.number: dict[str, int] = {}
        self.pool, self.first, self.size = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _numbers(self, values: list[str]) -> np.ndarray:
        """The place of each word in ``first`` and ``size``, which tell its ids in ``pool``."""
        if len(self.number) > WORDS_KEPT:
            self._start()
        new = [word for word in values if word not in self.number]
        # Words of letters end in one token that says so; the others are encoded one by one.
        letters = [word for word in new if word.isalpha()]
        self._encode(letters, LINE_WORDS)
        if len(letters) < len(new):
            self._encode([word for word in new if not word.isalpha()], 1)
        return np.fromiter(map(self.number.__getitem__, values), np.int64, len(values))

    def _encode(self, new: list[str], together: int) -> None:
        """Adds the ids of words, ``together`` of which are encoded in one call as a line."""
        lines = [" ".join(new[i : i + together]) for i in range(0, len(new), together)]
        lists = [x.ids for x in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        ids = np.fromiter(chain.from_iterable(lists), "<u4", int(sizes.sum()))
        if together > 1:
            ended = np.concatenate(([0], np.cumsum(self.ends[ids])))[np.concatenate(([0], np.cumsum(sizes)))]
            full = np.full(len(lines), together)
            full[-1:] = len(new) - together * (len(lines) - 1)
            if not np.array_equal(np.diff(ended), full):
                return self._encode(new, 1)
            sizes = np.diff(np.concatenate(([-1], np.flatnonzero(self.ends[ids]))))
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        self.first = np.concatenate((self.first, len(self.pool) + np.cumsum(sizes) - sizes))
        self.size = np.concatenate((self.size, sizes))
        self.pool = np.concatenate((self.pool, ids))

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The number of each word, and the index of each text's first."""
        texts = pc.fill_null(texts, "")
        # A special token in capitals is none, and must not become one.
        plain = not pc.any(pc.match_substring(texts, "<|")).as_py()
        table = SPACE_LOWER if plain else SPACE_ONLY
        flat, starts = words(pc.replace_substring_regex(texts, "([0-9A-Za-z])([.,])", r"\1 \2"), table)
        code, values = codes(flat)
        return self._numbers(values.to_pylist())[code] if len(code) else np.zeros(0, np.int64), starts

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        number, starts = self._words(texts)
        ends = np.concatenate(([0], np.cumsum(self.size[number])))
        return ends[starts[1:]] - ends[starts[:-1]]

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (unsigned 32-bit) and the index of each text's first; one entry more, their number."""
        number, starts = self._words(texts)
        if not len(number):
            return np.zeros(0, "<u4"), starts
        here = self.size[number]
        ends = np.cumsum(here)
        at = np.arange(ends[-1]) - np.repeat(ends - here - self.first[number], here)
        return self.pool[at], np.concatenate(([0], ends))[starts]


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """The encoder of this Python process."""
    return WordEncoder(path)
