"""Whole-text encoding with a public word-level BPE, one library call per distinct run of characters.

The tokenizer drops white space and never joins characters across it, so a text's tokens are those
of its runs between ASCII white space, one after the other. A batch is split by Arrow, its distinct
runs are encoded by the tokenizers library, and what the task has already
encoded comes from a store of bounded size.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TOKENIZER = "word_bpe_49k.json"
# What the store of a task may hold: bytes of its runs and what a run costs beside them.
_STORE_BYTES, _RUN_BYTES = 64 << 20, 140


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges [start, start + length)."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    begin = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - begin, lengths)


@dataclass
class Encoded:
    """Tokens of a batch of texts: ids, characters [first, last) of each, and tokens per text."""

    ids: np.ndarray
    first: np.ndarray | None
    last: np.ndarray | None
    counts: np.ndarray


# Marks that end a run after an ASCII letter: the tokenizer, too, cuts between the two.
_MARKS_AT_END = r"([A-Za-z])([.,!?;:]+)([ \t-\r]|\z)"
_PIECES_A_CALL = 4_000


class RunEncoder:
    """Encodes batches of texts; nulls are empty texts.

    Texts are lowered (A-Z) and, if no offsets are asked for, marks at the end of a run are set
    apart, which leaves fewer distinct runs and the same tokens. Texts with ``<|`` may spell a
    special token and are taken as they are.
    """

    def __init__(self, path: str, offsets: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        self._offsets = offsets
        # For lower-case ASCII words normalising and cutting at classes change nothing, so the same
        # model runs without them; the last token of a word is known by its suffix.
        self._plain = Tokenizer(self._tokenizer.model)
        self._plain.normalizer = normalizers.Sequence([])
        self._plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.vocabulary = self._tokenizer.get_vocab_size()
        suffix = self._tokenizer.model.end_of_word_suffix or ""
        self._ends = np.zeros(self.vocabulary, bool)
        if suffix:
            for token, i in self._tokenizer.get_vocab().items():
                self._ends[i] = token.endswith(suffix)
        self._by_suffix = bool(suffix) and not offsets
        self._forget()

    def _forget(self) -> None:
        self._row: dict[str, int] = {}
        self._held = 0
        self._ids = np.zeros(0, np.uint32)
        self._spans = np.zeros((0, 2), np.int64)
        self._start, self._length = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, plain: list[str], other: list[str]) -> None:
        """Encode runs set side by side with spaces: ``plain`` ones, then ``other`` ones."""
        ids, lengths, spans = [self._ids], [], [self._spans]
        texts = [" ".join(part) for part in _parts(plain)]
        for code in self._plain.encode_batch_fast(texts, add_special_tokens=False):
            own = np.array(code.ids, np.uint32)
            ids.append(own)
            lengths.append(np.diff(np.flatnonzero(self._ends[own]), prepend=-1))
        for part in _parts(other):
            code = self._tokenizer.encode(" ".join(part), add_special_tokens=False)
            sizes = np.fromiter(map(len, part), np.int64, len(part)) + 1
            begin = np.cumsum(sizes) - sizes
            own = np.array(code.offsets, np.int64).reshape(-1, 2)
            # A token's place tells whose it is.
            owner = np.searchsorted(begin, own[:, 0], "right") - 1
            lengths.append(np.bincount(owner, minlength=len(part)))
            ids.append(np.array(code.ids, np.uint32))
            if self._offsets:
                spans.append(own - begin[owner][:, None])
        lengths = np.concatenate(lengths)
        self._start = np.append(self._start, len(self._ids) + np.cumsum(lengths) - lengths)
        self._length = np.append(self._length, lengths)
        self._ids, self._spans = np.concatenate(ids), np.concatenate(spans)

    def _rows(self, runs: list[str]) -> np.ndarray:
        if self._held > _STORE_BYTES:
            self._forget()
        known = self._row
        new = [r for r in runs if r not in known]
        if new:
            plain, other = [], []
            for r in new:
                easy = self._by_suffix and r.isascii() and r.isalpha() and r.islower()
                (plain if easy else other).append(r)
            first = len(known)
            self._held += sum(map(len, new)) + _RUN_BYTES * len(new)
            known.update(zip(plain + other, range(first, first + len(new))))
            self._learn(plain, other)
        return np.fromiter(map(known.__getitem__, runs), np.int64, len(runs))

    def encode(self, texts: pa.Array) -> Encoded:
        # A copy: Arrow's string kernels misread slices of an array.
        texts = pc.take(texts.cast(pa.large_string()), pa.array(np.arange(len(texts))))
        texts = pc.fill_null(texts, "")
        if not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.ascii_lower(texts)
            if not self._offsets:
                texts = pc.replace_substring_regex(texts, _MARKS_AT_END, r"\1 \2\3")
        runs = pc.ascii_split_whitespace(texts)
        per_text = np.diff(runs.offsets.to_numpy())
        coded = runs.flatten().dictionary_encode()
        rows = self._rows(coded.dictionary.to_pylist())
        rows = rows[coded.indices.to_numpy(zero_copy_only=False)]
        lengths = self._length[rows]
        pick = ragged(self._start[rows], lengths)
        tokens_before = np.concatenate([[0], np.cumsum(lengths)])
        ends = np.cumsum(per_text)
        counts = tokens_before[ends] - tokens_before[ends - per_text]
        if not self._offsets:
            return Encoded(self._ids[pick], None, None, counts)
        base = np.repeat(run_starts(texts, runs, per_text), lengths)
        spans = self._spans[pick]
        return Encoded(self._ids[pick], base + spans[:, 0], base + spans[:, 1], counts)


def _parts(runs: list[str]):
    return [runs[at : at + _PIECES_A_CALL] for at in range(0, len(runs), _PIECES_A_CALL)]


def byte_slices(texts: pa.Array, most: int = 4 << 20):
    """(start, rows) of slices holding about ``most`` bytes of text, one row at least."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = 0
    while at < len(size):
        upto = at + max(1, int(np.searchsorted(np.cumsum(size[at:]), most, "right")))
        yield at, upto - at
        at = upto


def run_starts(texts: pa.Array, runs: pa.Array, per_text: np.ndarray) -> np.ndarray:
    """Character position in its text of every run, empty runs included.

    Runs are separated by one or more white-space characters: positions come from the characters
    that begin a run, found over all texts at once.
    """
    points = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    text_at = np.cumsum(size) - size
    blank = (points == 32) | ((points >= 9) & (points <= 13))
    begins = ~blank
    new_text = np.zeros(len(points), bool)
    new_text[text_at[text_at < len(points)]] = True
    begins[1:] &= blank[:-1] | new_text[1:]
    at = np.flatnonzero(begins)
    lengths = pc.utf8_length(runs.flatten()).to_numpy(zero_copy_only=False)
    out = np.zeros(len(lengths), np.int64)
    full = lengths > 0
    owner = np.repeat(text_at, per_text)
    out[full] = at - owner[full]
    return out
