"""Encoding with a public tokenizer: each distinct piece of text is encoded once.

A text is cut where the tokenizer can be shown to cut as well: at ASCII white
space for word-based models, before a single space or line break between two
other characters for byte-level ones, and before a full stop or comma that
follows a letter.  The ids of a piece are kept, so a word costs a look-up; the
ids of the whole are the same as from encoding the whole.
"""

from __future__ import annotations

import os
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallybrook.llm.common import byte_lengths, worker_cache

SEPARATOR = "<|endoftext|>"
RAW = "\x01"  # marks a piece without a space before it
LIMIT = 600_000
PART_BYTES = 1 << 20  # of text, looked at together


class Pieces:
    """Ids of the pieces of text met so far, all in one array; ``known`` has a piece's number."""

    def __init__(self):
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.empty(1 << 20, np.uint32)
        self.ends = np.zeros(LIMIT + 1, np.int64)  # piece i has ids[ends[i]:ends[i + 1]]

    def add(self, pieces: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        """Pieces with the ids of all of them, one piece after the other."""
        n = len(self.known)
        start = self.ends[n]
        while start + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        self.ids[start : start + len(ids)] = ids
        while n + len(pieces) >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ends[n + 1 : n + 1 + len(pieces)] = start + np.cumsum(lengths)
        self.known.update(zip(pieces, range(n, n + len(pieces))))

    def ids_of(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces in a row, and where each piece's begin and the last one's end."""
        start = self.ends[number]
        length = self.ends[number + 1] - start
        at = np.concatenate([[0], np.cumsum(length)])
        return self.ids[np.arange(at[-1]) + np.repeat(start - at[:-1], length)], at


class Encoder(Pieces):
    """``kind`` is "word" (white space separates and vanishes) or "byte"
    (a word carries the space before it)."""

    def __init__(self, path: str, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        self.kind = kind
        self.separator = self.model.token_to_id(SEPARATOR)
        super().__init__()

    def forget(self) -> None:
        super().forget()
        self.again = np.zeros(len(self.ends), bool)  # pieces met in another part too

    def _thin(self) -> None:
        """Forget the pieces met in one part only since the last time; all of them, if
        that leaves too many."""
        again = self.again[: len(self.known)]
        kept = np.flatnonzero(again)
        pieces = list(compress(self.known, again.tolist()))
        ids, at = self.ids_of(kept)
        self.forget()
        if len(pieces) <= LIMIT // 2:
            self.add(pieces, ids, np.diff(at))

    def _plain(self, piece: str) -> str:
        if self.kind == "word":
            return piece
        return piece[1:] if piece.startswith(RAW) else " " + piece

    def _learn(self, pieces: list[str]) -> np.ndarray:
        """The number of each piece.  New ones are encoded, many as one text with
        the end-of-text token between them: the model never joins what stands
        beside a token of that kind, and one long text costs less than many."""
        if len(self.known) > LIMIT:
            self._thin()
        number = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        self.again[number[number >= 0]] = True
        at = np.flatnonzero(number < 0)
        new = [pieces[i] for i in at.tolist()]
        odd = np.array(["<|" in p for p in new], bool)
        number[np.concatenate([at[~odd], at[odd]])] = np.arange(len(self.known), len(self.known) + len(new))
        plain = [p for p in new if "<|" not in p]
        for i in range(0, len(plain), 1000):
            some = plain[i : i + 1000]
            ids = self._encode(SEPARATOR.join(map(self._plain, some)))
            ends = np.flatnonzero(ids == self.separator)
            assert len(ends) == len(some) - 1
            self.add(some, np.delete(ids, ends), np.diff(ends, prepend=-1, append=len(ids)) - 1)
        for p in compress(new, odd.tolist()):
            ids = self._encode(self._plain(p))
            self.add([p], ids, np.array([len(ids)]))
        if len(self.again) < len(self.ends):
            self.again = np.concatenate([self.again, np.zeros(len(self.ends) - len(self.again), bool)])
        return number

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of an array of texts (NULL: none), and where each text's begin
        and the last one's end.  Texts go through in parts of about PART_BYTES, which
        bounds what their pieces take."""
        ends = np.cumsum(byte_lengths(texts))
        ids, lengths, start = [np.empty(0, np.uint32)], [np.zeros(1, np.int64)], 0
        while start < len(texts):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + PART_BYTES, "right")))
            some, at = self._encode_part(texts[start:stop])
            ids.append(some)
            lengths.append(np.diff(at))
            start = stop
            pa.default_memory_pool().release_unused()  # or the pool keeps what the largest part took
        return np.concatenate(ids), np.cumsum(np.concatenate(lengths))

    def _encode_part(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pa.concat_arrays([texts])  # of a slice, the lists below would begin where its parent does
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = np.zeros(len(texts), bool)
        if self.kind == "word":
            cut = pc.replace_substring_regex(texts, "([A-Za-zà-öø-ÿ])([.,])", r"\1 \2")
            lists = pc.ascii_split_whitespace(cut)
        else:
            # texts with other white space than single spaces and line breaks go whole
            odd = pc.match_substring_regex(texts, r"[\s\v\x1c-\x1f\p{Z}\x{85}]{2}|^[\s\v\x1c-\x1f\p{Z}\x{85}]|[\s\v\x1c-\x1f\p{Z}\x{85}]$|\x01")
            whole = odd.to_numpy(zero_copy_only=False)
            cut = pc.if_else(odd, "", pc.replace_substring_regex(texts, "([A-Za-zà-öø-ÿ])([.,])", rf"\1 {RAW}\2"))
            cut = pc.replace_substring(cut, "\n", f" {RAW}\n")
            lists = pc.split_pattern(pc.binary_join_element_wise(*(pa.scalar(x, pa.large_string()) if isinstance(x, str) else x for x in (RAW, cut, ""))), " ")
        coded = lists.flatten().dictionary_encode()
        number = self._learn(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
        ids, at = self.ids_of(number)
        offsets = at[lists.offsets.to_numpy()]
        if whole.any():
            parts = np.split(ids, offsets[1:-1])
            for i in np.flatnonzero(whole).tolist():
                parts[i] = self._encode(texts[i].as_py())
            ids = np.concatenate(parts)
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return ids, offsets


def encoder(path: str, kind: str) -> Encoder:
    """One encoder a worker process, so that what it knows serves later tasks; what
    other operators kept there goes, or it would count beside the encoder's."""
    return worker_cache(f"encoder {kind} {path}", lambda: Encoder(path, kind), alone=True)
