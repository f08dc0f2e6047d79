"""Tokenizing whole texts with a vocabulary of the tokenizers library, remembering the ids of single words.

Both vocabularies used here cut a text before every single space between two other characters, so a text's
ids are those of its words one after the other. Words are looked up in a table of bounded size per worker and
only new ones go to the tokenizer, many of them joined into one text. A text with any other white space (double spaces, tabs,
leading or trailing space, Unicode spaces) is encoded in one piece by the tokenizer itself.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator, Sequence
from string import ascii_lowercase, ascii_uppercase

#: White-space characters other than space and line feed, as any of the libraries understands them.
OTHER_SPACE = ("\t", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0", " ", " ", " ", " ",
               " ", " ", " ", " ", " ", " ", " ", " ", " ", " ", " ", " ", "　")
REMEMBERED = 1_000_000
#: Letters that stay letters when a normalizer composes them or puts them into lower case (others may leave a mark).
STEADY = (r"A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}\x{388}-\x{38A}\x{38E}-\x{3A1}\x{3A3}-\x{3CE}"
          r"\x{400}-\x{481}\x{48A}-\x{52F}\x{3041}-\x{3096}\x{30A1}-\x{30FA}\x{4E00}-\x{9FFF}\x{AC00}-\x{D7A3}")
#: Words that go to the tokenizer as one text.
JOINED = 500
#: Characters of the texts whose words are told apart at once; a longer text is worked on alone.
SLICE = 4_000_000


def plain(text: str) -> bool:
    """Whether every white space in the text is a single space or line feed between two other characters."""
    if "\x00" in text or "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[:1].isspace() or text[-1:].isspace():
        return False
    return not any(c in text for c in (OTHER_SPACE[:8] if text.isascii() else OTHER_SPACE))


class WordTokenizer:
    """Encodes texts to ids as little-endian unsigned 32-bit bytes. ``keeps_space``: the space before a word counts.

    Words and ids are Arrow arrays throughout, so no Python object is made for a word.
    """

    def __init__(self, path: str, keeps_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keeps_space = keeps_space
        self._forget()
        normalizer = self.tokenizer.normalizer
        self.letters = r"\p{L}" if normalizer is None else f"[{STEADY}]"
        #: whether the tokenizer itself puts A-Z into lower case
        self.lowers = normalizer is not None and normalizer.normalize_str(ascii_uppercase) == ascii_lowercase
        self.added = sorted({t.content[0] for t in self.tokenizer.get_added_tokens_decoder().values() if t.content})
        self.border = self._borders()

    def _forget(self) -> None:
        import pyarrow as pa

        self.words, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def _borders(self):
        """By id, whether it is the first (``keeps_space``) or the last token of a word."""
        import numpy as np

        mark = "\u0120" if self.keeps_space else "</w>"
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        out = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)
        found = [i for token, i in vocabulary.items() if (token.startswith(mark) if self.keeps_space else token.endswith(mark))]
        out[found] = True
        return out

    def _encode(self, texts: Sequence[str]) -> list[bytes]:
        import numpy as np

        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joinable(self, words):
        """Which words can be told apart in a text of many.

        Where the space before a word counts, that space begins its first token and no other, whatever follows; only
        the first letter of the added tokens is kept out. Otherwise every run of letters ends with a token of its own.
        """
        import pyarrow.compute as pc

        if not self.keeps_space:
            return pc.match_substring_regex(words, r"^\p{L}+$")
        out = pc.and_(pc.starts_with(words, " "), pc.greater(pc.binary_length(words), 1))
        for letter in self.added:
            out = pc.and_not(out, pc.match_substring(words, letter))
        return out

    def _encode_joined(self, words):
        """The ids of joinable words, encoded many at a time and cut where a word begins or ends.

        Each word has at least one border, so as many borders as words means that each has its own; otherwise
        the words are encoded one by one.
        """
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        line = words if self.keeps_space else pc.binary_join_element_wise(words, *pa.array(["", " "], pa.large_string()))
        upto, raw = _offsets(line), memoryview(line.buffers()[2])
        cuts = [*range(0, len(words), JOINED), len(words)]
        texts = [str(raw[upto[a]:upto[b]], "utf-8") for a, b in zip(cuts, cuts[1:])]
        found, sizes = [], []
        for a, b, one in zip(cuts, cuts[1:], self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(one.ids, "<u4")
            at = np.flatnonzero(self.border[np.minimum(ids, len(self.border) - 1)])
            if len(at) != b - a or int(ids.max()) >= len(self.border):
                apart = self._encode(words.slice(a, b - a).to_pylist())
                ids = np.frombuffer(b"".join(apart), "<u4")
                sizes.append(np.array([len(x) // 4 for x in apart], np.int64))
            else:
                sizes.append(np.diff(at, append=len(ids)) if self.keeps_space else np.diff(at, prepend=-1))
            found.append(ids)
        ends = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.concatenate(sizes) * 4, out=ends[1:])
        return pa.Array.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(ends), pa.py_buffer(np.concatenate(found))])

    def _fresh(self, words):
        """The ids of distinct words from the tokenizer."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        joined = self._joinable(words)
        parts, rest = [], words.filter(pc.invert(joined))
        if len(rest) < len(words):
            parts.append(self._encode_joined(pa.concat_arrays([words.filter(joined)])))
        if len(rest):
            parts.append(pa.array(self._encode(rest.to_pylist()), pa.large_binary()))
        first = joined.to_numpy(zero_copy_only=False)
        place = np.where(first, np.cumsum(first) - 1, int(first.sum()) + np.cumsum(~first) - 1)
        return pa.concat_arrays(parts).take(pa.array(place))

    def _new_ids(self, new):
        """The ids of distinct words that are not remembered.

        A mark after letters is a token of its own, so the bare word and the mark are enough.
        """
        import pyarrow as pa
        import pyarrow.compute as pc

        marked = pc.match_substring_regex(new, rf"^ ?{self.letters}+[,.]$")
        bare = pc.if_else(marked, pc.utf8_slice_codeunits(new, 0, -1), new)
        mark = pc.if_else(marked, pc.utf8_slice_codeunits(new, -1), pa.scalar(",", pa.large_string()))
        ask = pc.unique(pa.concat_arrays([bare, pa.array([",", "."], pa.large_string())]))
        known = pc.index_in(ask, value_set=self.words)
        unknown = ask.filter(known.is_null())
        ids = self.ids
        if len(unknown):
            ids = pa.concat_arrays([ids, self._fresh(unknown)])
        at = _numbered(known, len(self.ids))
        begin = ids.take(at.take(pc.index_in(bare, value_set=ask)))
        end = ids.take(at.take(pc.index_in(mark, value_set=ask)))
        end = pc.if_else(marked, end, pa.scalar(b"", pa.large_binary()))
        return pc.binary_join_element_wise(begin, end, pa.scalar(b"", pa.large_binary()))

    def _ids(self, words):
        """The ids of distinct words, from memory or from the tokenizer."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if len(self.words) > REMEMBERED:
            self._forget()
        known = pc.index_in(words, value_set=self.words)
        new = words.filter(known.is_null())
        at = _numbered(known, len(self.words))
        if len(new):
            self.ids = pa.concat_arrays([self.ids, self._new_ids(new)])
            self.words = pa.concat_arrays([self.words, new])
        return self.ids.take(at)

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """The ids of each text."""
        return list(self.encoded(texts))

    def encoded(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of one text after the other; texts are worked on in slices of some million characters."""
        part: list[str] = []
        size = 0
        for text in texts:
            part.append(text)
            size += len(text)
            if size > SLICE:
                yield from self._some(part)
                part, size = [], 0
        if part:
            yield from self._some(part)

    def _some(self, texts: list[str]) -> list[bytes]:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        whole = [i for i, t in enumerate(texts) if t and not plain(t)]
        out = [b""] * len(texts)
        for i, ids in zip(whole, self._encode([texts[i] for i in whole]) if whole else []):
            out[i] = ids
        skip = set(whole)
        easy = [i for i, t in enumerate(texts) if t and i not in skip]
        if not easy:
            return out
        line = pa.array([texts[i] for i in easy], pa.large_string())
        if self.lowers:  # fewer distinct words; a combining mark could join a letter in one case only
            line = pc.if_else(pc.match_substring_regex(line, r"\p{M}"), line, pc.ascii_lower(line))
        if self.keeps_space:  # a word keeps the space before it; line feeds stand alone
            line = pc.replace_substring(pc.replace_substring(line, " ", "\x00 "), "\n", "\x00\n\x00")
            lists = pc.split_pattern(line, "\x00")
        else:
            lists = pc.split_pattern(pc.replace_substring(line, "\n", " "), " ")
        words = lists.flatten().dictionary_encode()
        ids = self._ids(words.dictionary).take(words.indices)
        upto = _offsets(ids)
        ends = upto[np.cumsum(pc.list_value_length(lists).to_numpy())].tolist()
        raw, before = memoryview(ids.buffers()[2]), int(upto[0])
        for i, end in zip(easy, ends):
            out[i] = bytes(raw[before:end])
            before = end
        return out


def _offsets(array):
    """Where the values of a large string or binary array begin, and where the last one ends."""
    import numpy as np

    return np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1]


def _numbered(places, start: int):
    """Places with the nulls replaced by ``start``, ``start`` + 1 and so on."""
    import numpy as np
    import pyarrow as pa

    out = places.fill_null(-1).to_numpy().astype(np.int64)
    missing = out < 0
    out[missing] = start + np.arange(int(missing.sum()))
    return pa.array(out)


_loaded: dict[tuple[str, bool], WordTokenizer] = {}


def word_tokenizer(path: str, keeps_space: bool) -> WordTokenizer:
    """The worker's tokenizer for a vocabulary file; its words are remembered over tasks."""
    key = (path, keeps_space)
    if key not in _loaded:
        _loaded[key] = WordTokenizer(path, keeps_space)
    return _loaded[key]
