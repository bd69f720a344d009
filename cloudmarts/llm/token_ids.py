"""Token ids of whole texts by the tokenizers library, each distinct stretch encoded once.

A byte-level BPE cuts a text into runs (blanks, letters, digits, signs) before it merges bytes,
and no run goes on past a blank that follows something else.  A text may therefore be split
before every such blank; the ids of the stretches, one after the other, are the ids of the text,
and most stretches are words met before.  Nor does a run go on past a line end between two
characters that are no blanks.  Anything else (runs of blanks, scripts without blanks) stays in one
stretch and goes to the library as it is, at any length.

Texts are cut, and their words told apart, by Arrow; Python sees each distinct word of some texts
once, without the signs after it, and numpy puts the ids of the texts together.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END_ID = 2
_STRETCH = re.compile(r"(?<=\S)(?= )")  # \S here knows every blank the tokenizer knows
_BLANK, _LINE_END = "\u0120", "\u010a"  # as byte-level vocabularies write them
# Latin letters and the visible signs after them: two runs.  "<" may begin an added token.
_WORD_AND_SIGNS = (r"^(?P<word>[A-Za-z\x{aa}\x{b5}\x{ba}\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]+)"
                   r"(?P<signs>[!-/:;=-@\[-`{-~]*)$")
_KNOWN, _SHORT = 500_000, 64  # words a task remembers, and how long one may be
_JOINED = 2_000  # new words handed to the library as one text
# byte-level vocabularies write a byte as the Latin-1 character of its number if that is visible,
# the others as the characters from 256 on
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_CHARS = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _VISIBLE)}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def split_stretches(text: str) -> list[str]:
    """``text`` cut before every blank that follows something else."""
    return _STRETCH.split(text) if text else []


def _list_starts(lists: pa.LargeListArray | pa.ListArray) -> np.ndarray:
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return offsets - offsets[0]


def _laid_out(pool: np.ndarray, lengths: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of ``pool``, which holds them one after the other, in the order of their numbers
    in ``order``, and where each begins there (and the last one ends)."""
    took = lengths[order]
    starts = np.concatenate([[0], np.cumsum(took)])
    return pool[np.repeat((np.cumsum(lengths) - lengths)[order] - starts[:-1], took) + np.arange(starts[-1])], starts


class Encoder:
    """Encodes as ``Tokenizer.encode(text, add_special_tokens=False)``: strings of added tokens
    inside a text are their ids, as the file has it."""

    def __init__(self, path: str | None = None):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path or default_vocabulary())
        added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        if not all("<" in token for token in added):
            raise ValueError(f"an added token may hide in a word: {added}")
        vocabulary = self._tokenizer.get_vocab()
        self._four = [i.to_bytes(4, "little") for i in range(max(vocabulary.values()) + 1)]
        self._line_end = self._four[vocabulary[_LINE_END]]
        self._opens = np.zeros(len(self._four), bool)  # tokens that begin with a blank
        for token, i in vocabulary.items():
            self._opens[i] = token.startswith(_BLANK)
        self._known: dict[str, bytes] = {}  # words with a blank before them
        self._bare: dict[str, bytes] = {}   # words without one: at the start of a text or a line
        self._signs = lru_cache(10_000)(self._merged)

    def encode(self, texts: Sequence[str] | pa.Array) -> list[bytes]:
        """The ids of each text, little-endian unsigned 32-bit."""
        if not len(texts):
            return []
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts)).cast(pa.large_string())
        cut = pc.split_pattern(texts, " ")
        starts, words = _list_starts(cut), cut.flatten()
        # a blank that follows another blank is no place to cut
        blank = pc.not_equal(pc.binary_length(words), pc.binary_length(pc.utf8_rtrim_whitespace(words)))
        blank = pc.or_(blank, pc.equal(pc.binary_length(words), 0)).to_numpy(zero_copy_only=False)
        blank[starts[1:] - 1] = np.diff(starts) == 1
        odd = np.flatnonzero(np.logical_or.reduceat(blank, starts[:-1]))
        if not len(odd):
            return self._of_words(cut)
        stretches = (split_stretches(t) or [""] for t in texts.take(odd).to_pylist())
        found = dict(zip(odd.tolist(), self._of_words(pa.array(
            [[head, *(w[1:] for w in others)] for head, *others in stretches], pa.list_(pa.large_string()))), strict=True))
        even = np.setdiff1d(np.arange(len(texts)), odd)
        if len(even):
            found.update(zip(even.tolist(), self._of_words(cut.take(pa.array(even))), strict=True))
        return [found[i] for i in range(len(texts))]

    def _of_words(self, cut: pa.ListArray) -> list[bytes]:
        """The ids of texts given as words, all but the first of which have a blank before them."""
        starts, distinct = _list_starts(cut), cut.flatten().dictionary_encode()
        keys = distinct.indices.to_numpy().astype(np.int64) * 2
        keys[starts[:-1]] += 1  # odd: without a blank
        used, keys = self._used(keys, 2 * len(distinct.dictionary))
        ids, upto = _laid_out(*self._of_distinct(distinct.dictionary.take(pa.array(used // 2)), used % 2), keys)
        raw, ends = ids.tobytes(), (4 * upto[starts]).tolist()
        return [raw[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    @staticmethod
    def _used(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The numbers below ``n`` that ``keys`` holds, and ``keys`` as places among them."""
        there = np.zeros(n, bool)
        there[keys] = True
        return np.flatnonzero(there), (np.cumsum(there) - 1)[keys]

    def _of_distinct(self, words: pa.Array, bare: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these words, one after the other, and how many each has.  ``bare`` is 1 for
        words without a blank before them."""
        # a line end between two characters that are no blanks is a run of its own
        lines = pc.split_pattern(words, "\n")
        starts, parts = _list_starts(lines), lines.flatten()
        trimmed = pc.not_equal(pc.binary_length(parts), pc.binary_length(pc.utf8_trim_whitespace(parts)))
        split = pc.or_(trimmed, pc.equal(pc.binary_length(parts), 0)).to_numpy(zero_copy_only=False)
        split = ~np.logical_or.reduceat(split, starts[:-1]) if len(words) else np.zeros(0, bool)
        split &= np.diff(starts) > 1
        split &= ~pc.match_substring(words, "<").to_numpy(zero_copy_only=False)
        n_parts = np.where(split, np.diff(starts), 1)
        of_split = np.repeat(split, np.diff(starts))
        parts = pa.concat_arrays([words.filter(pa.array(~split)), parts.filter(pa.array(of_split))])
        word = np.concatenate([np.flatnonzero(~split), np.repeat(np.flatnonzero(split), n_parts[split])])
        order = np.argsort(word, kind="stable")
        parts, word = parts.take(pa.array(order)), word[order]
        first = np.ones(len(word), bool)
        first[1:] = word[1:] != word[:-1]
        bare = np.where(first, bare[word], 1)
        # signs after Latin letters are a run of their own
        found = pc.extract_regex(parts, _WORD_AND_SIGNS)
        matched = found.is_valid()
        stems = pc.if_else(matched, pc.struct_field(found, 0), parts).dictionary_encode()
        signs = pc.if_else(matched, pc.struct_field(found, 1), "").dictionary_encode()
        used, stem_at = self._used(stems.indices.to_numpy().astype(np.int64) * 2 + bare, 2 * len(stems.dictionary))
        latin = np.zeros(len(used), bool)
        latin[stem_at] = matched.to_numpy(zero_copy_only=False)
        pieces = np.empty(len(used), object)
        for lead, kind in ((_BLANK, 0), ("", 1)):
            own = np.flatnonzero(used % 2 == kind)
            pieces[own] = self._remembered(stems.dictionary.take(pa.array(used[own] // 2)).to_pylist(), lead, latin[own])
        pieces = [*pieces.tolist(), *map(self._signs, signs.dictionary.to_pylist()), self._line_end, b""]
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
        row = np.stack([np.where(first, len(pieces) - 1, len(pieces) - 2), stem_at,
                        len(used) + signs.indices.to_numpy()], 1)
        ids, upto = _laid_out(np.frombuffer(b"".join(pieces), "<u4"), lengths, row.ravel())
        ends = upto[3 * np.concatenate([[0], np.cumsum(n_parts)])]
        return ids, np.diff(ends)

    def _remembered(self, words: list[str], lead: str, latin: np.ndarray) -> list[bytes]:
        """The ids of each of these distinct words with ``lead`` before it."""
        known = self._known if lead else self._bare
        ids = list(map(known.get, words))
        new = [i for i, piece in enumerate(ids) if piece is None]
        room = max(0, _KNOWN - len(self._known) - len(self._bare))
        for i, piece in zip(new, self._encoded([words[i] for i in new], lead, latin[new].tolist()), strict=True):
            ids[i] = piece
        kept = islice((i for i in new if len(words[i]) <= _SHORT), room)
        known.update((words[i], ids[i]) for i in kept)
        return ids

    def _merged(self, run: str) -> bytes:
        """The ids of one run, its bytes written as the vocabulary does."""
        return b"".join([self._four[t.id] for t in self._tokenizer.model.tokenize(run)])

    def _encoded(self, new: list[str], lead: str, latin: list[bool]) -> list[bytes]:
        """The ids of each of these distinct words with ``lead`` before it.

        A word of Latin letters is one run, so the model merges it without the text being cut
        into runs again.
        """
        merge, four = self._tokenizer.model.tokenize, self._four
        found = {w: b"".join([four[t.id] for t in merge(
            lead + (w if w.isascii() else w.encode().decode("latin-1").translate(_BYTE_CHARS)))])
            for w, one_run in zip(new, latin, strict=True) if one_run}
        rest = [w for w, one_run in zip(new, latin, strict=True) if not one_run]
        joined = [w for w in rest if lead and w and " " not in w and len(w) <= _SHORT and "<" not in w]
        for at in range(0, len(joined), _JOINED):
            own = joined[at:at + _JOINED]  # each begins with its only blank, so its ids do as well
            text = " " + " ".join(own)
            ids = np.array(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.append(np.flatnonzero(self._opens[ids]) * 4, len(ids) * 4).tolist()
            raw = ids.tobytes()
            found.update((w, raw[a:b]) for w, a, b in zip(own, cuts[:-1], cuts[1:], strict=True))
        rest = [w for w in rest if w not in found]  # also what may hold an added token
        blank = " " if lead else ""
        ids = (np.array(e.ids, "<u4").tobytes()
               for e in self._tokenizer.encode_batch_fast([blank + w for w in rest], add_special_tokens=False))
        found.update(zip(rest, ids, strict=True))
        return [found[w] for w in new]
