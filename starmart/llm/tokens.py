"""Whole texts to token ids, on Arrow batches.

Tokenizers split text before they merge, and between two visible characters a single space always starts a new piece
and a single line feed always is one. So the texts of a slice are cut there by Arrow, the pieces are dictionary-encoded,
split into its word and the signs behind it, and each distinct word is looked up once; Arrow joins words and signs to pieces
and puts the ids of all texts together, so Python sees only words that the worker does not know. It keeps the words it met
as Arrow columns of bounded length; when they are full, the half met in most slices stays. A word of plain letters goes
straight to the tokenizer's model, which spares the slow splitting; whether that gives the same ids is tried on samples
first. Texts with other white space are cut one by one.
Texts that hold the string of a special token go whole to the tokenizer, which gives its id as it does by default; with
``special=False`` such strings are ordinary text.
"""

from __future__ import annotations

import re
import string
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from starmart.llm.common import releasing
from starmart.llm.words import raw, slices

CUT = re.compile(r"(?<=\S) (?=\S)")
LETTER = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+"
PLAIN = re.compile(LETTER)
MARKS = string.punctuation
ONLY_MARKS = rf"^[{re.escape(MARKS)}]*$"
SAMPLES = ["hello", "Hello", "\u00e9lan", "gr\u00fc\u00dfe", "THE", "xqzjw", "end.", "Ende,***", "it!!"]
PIECES_KEPT = 1 << 18
MARKS_KEPT = 1000
LONGEST_KEPT = 64
SLICE_BYTES = 1 << 22
#: White space that is no single space or line feed between visible characters.
ODD_SPACE = r"^[\s\p{Z}]|[\s\p{Z}]$|[ \n][ \n]|[\t\v\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def byte_letters() -> dict[int, str]:
    """The usual rule of byte-level vocabularies: visible Latin-1 characters stand for themselves, the rest follow at 256."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + n) for n, b in enumerate(rest)}


LETTERS = byte_letters()
CODES = np.array([ord(LETTERS[b]) for b in range(256)], "<u2")


def spelled(data: bytes | np.ndarray) -> str:
    """UTF-8 bytes in the vocabulary's letters."""
    return CODES[np.frombuffer(data, np.uint8)].tobytes().decode("utf-16-le")


class Known:
    """Texts met before with their ids, ``limit`` at most after each slice."""

    def __init__(self, limit: int):
        self.limit = limit
        self.names, self.ids, self.met = pa.array([], pa.large_string()), pa.array([], pa.large_binary()), np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.names)

    def ids_of(self, texts: pa.Array, encode: Callable[[pa.Array], pa.Array]) -> pa.Array:
        """The ids of each text; the distinct ones that are not known are encoded."""
        coded = texts.dictionary_encode()
        names = coded.dictionary
        place = pc.index_in(names, value_set=self.names)
        fresh = place.is_null()
        new = names.filter(fresh)
        made = encode(new)
        ids = pa.concat_arrays([self.ids, made])
        at = place.fill_null(0).to_numpy().astype(np.int64)
        fresh = fresh.to_numpy(zero_copy_only=False)
        self.met[at[~fresh]] += 1
        at[fresh] = len(self.ids) + np.arange(len(new))
        short = pc.less_equal(pc.binary_length(new), LONGEST_KEPT)
        self.names = pa.concat_arrays([self.names, new.filter(short)])
        self.ids = pa.concat_arrays([self.ids, made.filter(short)])
        self.met = np.append(self.met, np.zeros(len(self.names) - len(self.met), np.int64))
        if len(self.names) > self.limit:
            often = np.sort(np.argsort(-self.met, kind="stable")[:self.limit // 2])
            self.names, self.ids, self.met = self.names.take(pa.array(often)), self.ids.take(pa.array(often)), self.met[often] // 2
        return ids.take(pa.array(at).take(coded.indices))


class Encoder:
    """Encodes texts to little-endian unsigned ids of ``width`` bytes each."""

    def __init__(self, path: str, special: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        tokens = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content for t in tokens] if special else [t.content for t in tokens if not t.special]
        self.model = self.tokenizer.model
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.code, self.dtype = "H" if self.width == 2 else "I", np.dtype(f"<u{self.width}")
        self.marks = {}  # of texts that are cut one by one
        self.known, self.known_marks = Known(PIECES_KEPT), Known(MARKS_KEPT)
        self.line = self.whole("\n")
        self.lower = None  # how a plain word reaches the model; None if neither way gives the samples' ids
        for lower in (False, True):
            self.lower = lower
            if all(self.piece(before, w) == self.whole(before + w) for before in ("", " ") for w in SAMPLES):
                break
        else:
            self.lower = None

    def whole(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def word(self, word: str) -> bytes:
        """A plain word, spelled in the vocabulary's letters and with the space before it if the model has one, by the model alone."""
        return array(self.code, [t.id for t in self.model.tokenize(word)]).tobytes()

    def split(self, piece: str) -> tuple[str, str] | None:
        """A piece as plain letters and the signs behind them, if it is that."""
        word = piece.rstrip(MARKS)
        if not (word.isascii() and word.isalpha()) and not PLAIN.fullmatch(word):
            return None
        return word, piece[len(word):]

    def piece(self, before: str, piece: str) -> bytes:
        plain = self.split(piece) if self.lower is not None else None
        if plain is None:
            return self.whole(before + piece)
        word, mark = plain
        if mark and mark not in self.marks:
            if len(self.marks) >= MARKS_KEPT:
                self.marks.clear()
            self.marks[mark] = self.whole(mark)
        ids = self.word(spelled((word.lower() if self.lower else before + word).encode()))
        return ids + self.marks[mark] if mark else ids

    def words(self, words: pa.Array) -> pa.Array:
        """The ids of a column of plain words; none has a line feed."""
        data, _ = raw(pc.binary_join_element_wise(words, pa.scalar("\n", words.type), pa.scalar("", words.type)))
        ids, offsets = bytearray(), [0]
        for word in spelled(data).split(LETTERS[10])[:-1]:
            ids += self.word(word)
            offsets.append(len(ids) // self.width)
        return binary(np.frombuffer(ids, self.dtype), np.array(offsets))

    def wholes(self, texts: pa.Array) -> pa.Array:
        return pa.array([self.whole(t) for t in texts.to_pylist()], pa.large_binary())

    def pieces(self, names: pa.Array, before: pa.Array) -> pa.Array:
        """The ids of pieces with what stands before each, a space or nothing."""
        nothing = pa.scalar("", names.type)
        if self.lower is None:
            return self.wholes(pc.binary_join_element_wise(before, names, nothing))
        mark = pc.replace_substring_regex(names, f"^{LETTER}", "")
        plain = pc.and_(pc.match_substring_regex(mark, ONLY_MARKS), pc.less(pc.binary_length(mark), pc.binary_length(names)))
        word, mark, other = pc.utf8_rtrim(names.filter(plain), MARKS), mark.filter(plain), pc.invert(plain)
        word = pc.utf8_lower(word) if self.lower else pc.binary_join_element_wise(before.filter(plain), word, nothing)
        made = pc.binary_join_element_wise(
            self.known.ids_of(word, self.words), self.known_marks.ids_of(mark, self.wholes), pa.scalar(b"", pa.large_binary()))
        others = self.wholes(pc.binary_join_element_wise(before.filter(other), names.filter(other), nothing))
        order = np.argsort(~np.asarray(plain), kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return pa.concat_arrays([made, others]).take(pa.array(place))

    def odd_text(self, text: str | None) -> bytes:
        """A text with other white space, special strings, or nothing in it."""
        if not text:
            return b""
        if any(mark in text for mark in self.special):
            return self.whole(text)
        first, *rest = CUT.split(text)
        return self.piece("", first) + b"".join(self.piece(" ", piece) for piece in rest)

    def simple(self, texts: pa.Array) -> np.ndarray:
        """Which texts have single spaces and line feeds only, and no special strings."""
        odd = pc.match_substring_regex(texts, ODD_SPACE)
        for mark in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, mark))
        return ~np.asarray(odd) & (np.asarray(pc.binary_length(texts)) > 0)

    def encode_all(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each begins (and the last ends); null is empty.

        ``end_id`` is appended to each text.
        """
        texts = texts.cast(pa.large_string()).fill_null("")
        simple = self.simple(texts)
        # Cut: a piece is a word or a line feed; the first of a text and those behind a line feed have no space before.
        cut = pc.split_pattern(pc.replace_substring(texts.filter(pa.array(simple)), "\n", " \n "), " ")
        pieces, stops = cut.values.dictionary_encode(), np.asarray(cut.offsets)[1:].astype(np.int64)
        codes, names = np.asarray(pieces.indices).astype(np.int64), pieces.dictionary
        line = pc.index(names, "\n").as_py()
        bare = np.zeros(len(codes), bool)
        if len(codes):
            bare[0] = True
            bare[1:] = codes[:-1] == line
            bare[stops[:-1]] = True
        # Distinct entries: pieces with a space before, pieces without, the line feed, the end, and odd texts.
        seen = np.zeros((2, len(names)), bool)
        seen[bare.astype(np.int64), codes] = True
        seen[:, line if line >= 0 else []] = False
        column, name = np.nonzero(seen)
        made = [self.pieces(names.take(pa.array(name)), pa.array([" ", ""], names.type).take(pa.array(column)))]
        entry = len(name)
        place = np.zeros(seen.shape, np.int64)
        place[seen] = np.arange(entry)
        if line >= 0:
            place[:, line] = entry
        end = b"" if end_id is None else np.array([end_id], self.dtype).tobytes()
        others = np.flatnonzero(~simple)
        made.append(pa.array([self.line, end, *[self.odd_text(t) for t in texts.take(pa.array(others)).to_pylist()]], pa.large_binary()))
        # One row of entries per text: its pieces, or the whole of an odd text; then the end.
        counts = np.ones(len(texts), np.int64)
        counts[simple] = np.diff(stops, prepend=0)
        total = counts + (end_id is not None)
        ends = np.cumsum(total)
        entries = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
        inside = np.repeat(simple, total)
        if end_id is not None:
            entries[ends - 1] = entry + 1
            inside[ends - 1] = False
        entries[inside] = place[bare.astype(np.int64), codes]
        entries[(ends - total)[others]] = entry + 2 + np.arange(len(others))
        joined = pa.concat_arrays(made).take(pa.array(entries))
        _, at, data = joined.buffers()
        stop = np.frombuffer(at, np.int64, len(joined) + 1) if len(joined) else np.zeros(1, np.int64)
        ids = np.frombuffer(data, self.dtype, int(stop[-1]) // self.width) if stop[-1] else np.zeros(0, self.dtype)
        return ids, np.concatenate([[0], stop[ends] // self.width]).astype(np.int64)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        ids, offsets = self.encode_all(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]


def binary(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Runs of ids as a binary column, without a copy per row."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [
        None, pa.py_buffer((offsets * ids.itemsize).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(ids))])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per Python worker, so later tasks find the tables filled."""
    return Encoder(path)


def encode_batches(path: str, text: str, end_id: int,
                   emit: Callable[[pa.Table, np.ndarray, np.ndarray], pa.Table]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function: ``emit`` gets a slice of rows, all their ids with the end ids, and where each row's begin."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            for start, stop in slices(batch.column(batch.schema.get_field_index(text)), SLICE_BYTES):
                part = pa.Table.from_batches([batch.slice(start, stop - start)])
                yield from emit(part, *own.encode_all(part.column(text).combine_chunks(), end_id)).to_batches()
    return releasing(run)
